"""Language identification with error-correcting output codes (operator 4).

Each language has a codeword; each bit of the code is one binary classifier.
A classifier is a multinomial model over hashed character 2- and 3-grams of
the letters of a text (lower case, everything else one blank): the weight of
an n-gram for a bit is the log ratio of its smoothed share in the languages
with that bit and in those without.  All weights come from one table of
n-gram counts by language, gathered by Spark over every labelled document that
may be learned from; its size (languages x 2^15) does not depend on the corpus.
A document counts each n-gram once for a first and less for later uses (square
root), so that no long text outweighs the rest.

Decoding is loss-weighted: the logistic loss of each bit's margin, weighted by
how well the bit separates the training counts, is summed per codeword and the
nearest codeword wins.  The score is that codeword's share under a soft
minimum whose temperature is fitted on rows a model did not learn from: a
model of seven eighths of the rows (by text hash) predicts stretches of 4 to 512
characters of at most ``CALIBRATION_TEXTS`` texts of the other eighth, and the
temperature at which the mean score is nearest to the share predicted right is
taken.

A text is flagged ambiguous when, on the bits in which the two nearest codewords
differ, its n-grams say on average less than ``AMBIGUOUS`` of what those of the
winner's training rows say.  A text all in one language comes near 1, one that
mixes two by halves near 0, whatever its length.

Null texts and texts without a letter are ``und`` with score 0.  With a single
learned language every text with a letter gets it with score 1; with none,
all are ``und``.  Ties go to the language that sorts first.  Repeated rows get
equal results; an empty table gives none.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotcover.llm.common import bounded_batches, regroup, text_column

GRAM_BITS = 15
TEXT_BYTES = 1 << 20  # text whose n-grams are held at once
SMOOTHING = 0.1
AMBIGUOUS = 0.35
MIN_SCORE = 0.5       # keep_identified: more likely right than wrong
CALIBRATION_TEXTS = 512
CALIBRATION_CHARS = (4, 8, 16, 32, 64, 128, 512)
HEATS = 2.0 ** np.arange(-2, 4.25, 0.25)
UND = "und"
MAX_LANGUAGES = 4096  # labels beyond this many would not fit the count table
_LETTERS: list[np.ndarray] = []

RESULT = "doc_id long, lang_pred string, score double, ambiguous boolean"


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter (Unicode category L)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool))
    return _LETTERS[0]


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of a batch of texts, the text of each, and whether each
    text has a letter."""
    lowered = [t.lower() for t in texts.to_pylist()]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    owner = np.repeat(np.arange(len(lowered)), lens)[:len(points)]
    letter = letter_table()[points]
    has_letter = np.zeros(len(lowered), bool)
    has_letter[owner[letter]] = True
    # runs of other characters become one blank; texts stay apart by it
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    codes = np.where(letter, points, 0)[kept].astype(np.uint32)
    owner = owner[kept]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    pair = (b * np.uint32(0x9E3779B1)) ^ (c * np.uint32(0x85EBCA77))
    triple = (pair ^ (a * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
    pair = pair * np.uint32(0x165667B1)
    shift = np.uint32(32 - GRAM_BITS)
    same3 = (owner[:-2] == owner[2:])
    same2 = (owner[1:-1] == owner[2:])
    return (np.concatenate([triple[same3] >> shift, pair[same2] >> shift]).astype(np.int64),
            np.concatenate([owner[2:][same3], owner[2:][same2]]), has_letter)


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) pairs with the weight of their count, sorted by
    text, and whether each text has a letter."""
    gram, owner, has_letter = grams(texts)
    key, count = np.unique((owner << GRAM_BITS) | gram, return_counts=True)
    return key >> GRAM_BITS, key & ((1 << GRAM_BITS) - 1), np.sqrt(count), has_letter


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents that must not be learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def set_apart(text: str = "text") -> Column:
    """1 for the eighth of the texts that the temperature is fitted on, else 0."""
    return (F.xxhash64(text).bitwiseAND(7) == 0).cast("long")


def gram_counts(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages in order, and the summed n-gram weights (set apart or not x
    language x n-gram) over all rows of ``labelled`` (text, lang).  Each task adds up its rows,
    so a row of the table crosses the network once a task, language and part."""
    bounded_batches(labelled.sparkSession)
    size = 1 << GRAM_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], np.ndarray] = {}
        for batch in regroup(batches, TEXT_BYTES):
            owner, gram, weight, _ = counted(text_column(batch))
            coded = batch.column(1).dictionary_encode()
            kind = coded.indices.to_numpy() * 2 + batch.column(2).to_numpy()
            for k in np.unique(kind).tolist():
                mine = (kind == k)[owner]
                key = (coded.dictionary[k // 2].as_py(), k % 2)
                total[key] = total.get(key, 0) + np.bincount(gram[mine], weight[mine], size)
        for (lang, part), weights in total.items():
            some = np.nonzero(weights)[0]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(some), pa.string()),
                "part": pa.array([part] * len(some), pa.int64()), "gram": some.astype(np.int32),
                "weight": np.round(weights[some] * 1024).astype(np.int64)})

    # whole numbers: the sums do not depend on the order of the tasks
    table = (labelled.select("text", "lang", set_apart().alias("part"))
             .mapInArrow(count, "lang string, part long, gram int, weight long")
             .groupBy("lang", "part", "gram").agg(F.sum("weight").alias("weight")).toArrow())
    langs = sorted(pc.unique(table.column("lang")).to_pylist())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: not a language label")
    out = np.zeros((2, len(langs), size))
    if langs:
        at = pc.index_in(table.column("lang"), pa.array(langs, pa.string())).to_numpy()
        out[table.column("part").to_numpy(), at, table.column("gram").to_numpy()] = \
            table.column("weight").to_numpy() / 1024
    return langs, out


def calibration_texts(labelled: DataFrame) -> list[tuple[str, str]]:
    """(lang, stretch) of at most ``CALIBRATION_TEXTS`` texts set apart: the text
    with the smallest hash in each of as many ranges of it, so copies count once.
    Only hashes are compared over the whole table."""
    h = F.xxhash64("text")
    least = (labelled.where(set_apart() == 1).select(h.alias("h"))
             .groupBy(F.pmod(F.shiftright("h", 3), F.lit(CALIBRATION_TEXTS))).agg(F.min("h").alias("h")))
    picks = [r.h for r in least.collect()]
    n = F.char_length("text")
    stretches = [F.substr("text", F.lit(1) + F.pmod(h, F.greatest(n - size, F.lit(0)) + 1).cast("int"), F.lit(size))
                 for size in CALIBRATION_CHARS]
    rows = (labelled.where(h.isin(picks)).select(h.alias("h"), "lang", *(
        s.alias(f"s{i}") for i, s in enumerate(stretches))).distinct().collect()) if picks else []
    return [(r.lang, s) for r in sorted(rows, key=lambda r: (r.h, r.lang)) for s in r[2:]]


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A codeword of +1/-1 per language.  Up to seven languages: every way to
    split them in two.  More: random splits, the best of several draws by the
    least distance between two codewords."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 7:
        columns = [[1 if (split >> i) & 1 else -1 for i in range(n - 1)] + [-1]
                   for split in range(1, 1 << (n - 1))]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, most = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(0, dtype=int)) < n]
        apart = code.shape[1] - (code.astype(np.int32) @ code.T.astype(np.int32))
        least = int(np.min(apart[~np.eye(n, dtype=bool)]))
        if least > most:
            best, most = code, least
    return best


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray      # language x bit
    weights: np.ndarray   # n-gram x bit
    trust: np.ndarray     # of each bit, mean 1
    typical: np.ndarray   # language x bit: mean weight of an n-gram of that language
    heat: float = 1.0     # temperature of the score

    def losses(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the loss of each codeword, the mean weight of an n-gram for
        each bit, and whether it has a letter."""
        n = len(texts)
        owner, gram, weight, has_letter = counted(texts)
        sums = np.zeros((n, self.code.shape[1]))
        if len(owner):
            begins = np.nonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))[0]
            sums[owner[begins]] = np.add.reduceat(self.weights[gram] * weight[:, None], begins)
        total = np.maximum(1, np.bincount(owner, weight, n))[:, None]
        # evidence grows with the root of the text: n-grams are not independent
        margin = sums / np.sqrt(total)
        loss = np.zeros((n, len(self.langs)))
        for i, word in enumerate(self.code):
            loss[:, i] = np.logaddexp(0, -margin * word) @ self.trust
        return loss, sums / total, has_letter

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        n = len(texts)
        if not self.langs:
            return [UND] * n, np.zeros(n), np.zeros(n, bool)
        loss, mean, has_letter = self.losses(texts)
        if len(self.langs) == 1:
            return ([self.langs[0] if x else UND for x in has_letter],
                    has_letter.astype(float), np.zeros(n, bool))
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(n)
        best, second = order[:, 0], order[:, 1]
        score = 1 / np.exp((loss[rows, best][:, None] - loss) / self.heat).sum(1)
        apart = (self.code[best] != self.code[second]) * self.code[best] * self.trust
        ambiguous = (apart * mean).sum(1) <= AMBIGUOUS * (apart * self.typical[best]).sum(1)
        langs = [self.langs[b] if x else UND for b, x in zip(best, has_letter)]
        return langs, np.where(has_letter, score, 0.0), ambiguous & has_letter


def fit(langs: list[str], counts: np.ndarray) -> Model:
    """The classifiers of n-gram counts (language x n-gram)."""
    code = codewords(len(langs))
    share = counts + SMOOTHING
    share /= share.sum(1, keepdims=True)
    weights = np.zeros((share.shape[1], code.shape[1]), np.float32)
    trust = np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        one, zero = share[code[:, bit] > 0].mean(0), share[code[:, bit] < 0].mean(0)
        weights[:, bit] = np.log(one) - np.log(zero)
        # expected margin between both sides under the training shares
        trust[bit] = ((one - zero) * weights[:, bit]).sum()
    return Model(langs, code, weights, trust / trust.mean() if len(trust) and trust.mean() > 0
                 else np.ones(len(trust)), share @ weights)


def fitted_heat(model: Model, stretches: list[tuple[str, str]]) -> float:
    """The temperature at which the mean score comes nearest to the share that is
    right; 1 if there is nothing to go by."""
    if len(model.langs) < 2 or not stretches:
        return 1.0
    loss, _, has_letter = model.losses(pa.array([s for _, s in stretches], pa.string()))
    right = np.searchsorted(model.langs, [lang for lang, _ in stretches])
    hits = (loss.argmin(1) == right)[has_letter].mean() if has_letter.any() else 1.0
    loss = (loss - loss.min(1, keepdims=True))[has_letter]
    means = [(1 / np.exp(-loss / t).sum(1)).mean() if len(loss) else 1.0 for t in HEATS]
    return float(HEATS[int(np.argmin(np.abs(np.array(means) - hits)))])


def train(labelled: DataFrame) -> Model:
    """Fit the classifiers on all rows of ``labelled`` (text, lang)."""
    known = labelled.select("text", "lang").where("text is not null and lang is not null")
    langs, counts = gram_counts(known)
    if len(langs) < 2:
        return fit(langs, counts.sum(0))
    heat = fitted_heat(fit(langs, counts[0]), calibration_texts(known))
    return replace(fit(langs, counts.sum(0)), heat=heat)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            langs, score, ambiguous = shared.value.predict(text_column(batch))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "lang_pred": langs, "score": score,
                "ambiguous": ambiguous})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def keep_identified(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model can tell: not ``und``, and with
    a score of at least ``MIN_SCORE``.  Ambiguous texts stay by that rule too: a text
    in two languages is still a text in known languages."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, TEXT_BYTES):
            langs, score, _ = shared.value.predict(text_column(batch, column))
            yield batch.filter(pa.array((np.array(langs, object) != UND) & (score >= MIN_SCORE)))

    return docs.mapInArrow(run, docs.schema)
