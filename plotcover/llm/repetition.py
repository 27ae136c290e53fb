"""Quality rules from a suffix array of each text (operator 5).

The symbols are words (runs without ASCII white space).  The suffixes of all
texts of a batch are sorted at once by prefix doubling; a word's symbol differs
between texts, so no two suffixes of different texts ever agree.  Intervals of
suffixes with a common prefix of at least ``min_words`` words are the repeated
substrings; the longest one at each word, first occurrence included, gives its
span.  The union of the spans gives the covered fraction, the longest span the
longest repeat.

The limits bite below the base rule.  One repeated line alone covers much of a
short text, so a text of up to ``SHORT_WORDS`` words with one duplicate line,
and nothing covered besides two copies of its longest repeat, is spared the
limit on the covered fraction (not the base rule, nor the longest repeat).

Only suffixes that still agree with another one are sorted again, so a round
costs as much as there is repetition left.

Null or empty texts, texts of blanks: no words, so they fail the base rule.
Repeated rows give equal results; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.llm.common import Words, bounded_batches, regroup, text_column

WINDOW = 5                # words of a window that counts as repeated (base rule)
MIN_WORDS = 10            # base rule
MAX_REPEAT_PERCENT = 20   # base rule
COVER_MIN_WORDS = 10      # a repeated substring of this many words counts as covered
MAX_COVERED = 0.15        # covered share of a text's word characters
MAX_LONGEST = 60          # words of the longest repeat
SHORT_WORDS = 200         # up to this many words, one repeated line is spared
SYMBOLS = r"[#*$%&|<>]"   # fixed value of the contract

RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, n_covered_words long, "
          "covered_fraction double, longest_repeat_words long, n_repeats long")


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for k = 0, 1, ... the ranks of suffixes by their
    first 2^k symbols (equal ranks: equal prefixes), as far as any agree."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = _group_starts(symbols[order])[np.argsort(order, kind="stable")] if n else symbols
    levels = [rank.astype(np.int32)]
    size, step = np.bincount(rank, minlength=n), 1
    active = np.nonzero(size[rank] > 1)[0]
    sa = order
    while len(active):
        beyond = active + step
        then = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        by = np.lexsort((then, rank[active]))
        active, old, then = active[by], rank[active][by], then[by]
        first = np.ones(len(by), bool)
        first[1:] = old[1:] != old[:-1]
        new = first.copy()
        new[1:] |= then[1:] != then[:-1]
        at = np.arange(len(by))
        in_group = at - np.maximum.accumulate(np.where(first, at, 0))
        sa[old + in_group] = active
        fresh = old + np.maximum.accumulate(np.where(new, at, 0)) \
            - np.maximum.accumulate(np.where(first, at, 0))
        rank = rank.copy()
        rank[active] = fresh
        levels.append(rank.astype(np.int32))
        alone = new & np.append(new[1:], True)
        active = np.sort(active[~alone])
        step *= 2
    return sa, levels


def _group_starts(values: np.ndarray) -> np.ndarray:
    """For sorted values, the position of the first equal one."""
    at = np.arange(len(values))
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(new, at, 0))


def common_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix of the array shares with the next one."""
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    pairs = np.nonzero(levels[0][sa[:-1]] == levels[0][sa[1:]])[0]
    p, q = sa[pairs].astype(np.int64), sa[pairs + 1].astype(np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (p < n) & (q < n)
        same = np.zeros(len(p), bool)
        same[inside] = levels[k][p[inside]] == levels[k][q[inside]]
        p += same << k
        q += same << k
    lcp[pairs] = p - sa[pairs]
    return lcp


class Repeats:
    """Longest repeated prefix at each word of a batch of texts."""

    def __init__(self, words: Words):
        self.words = words
        n = len(words.codes)
        owner = words.owner
        symbols = owner * (int(words.codes.max()) + 1 if n else 1) + words.codes
        self.sa, levels = suffix_ranks(symbols)
        self.lcp = common_prefixes(self.sa, levels)
        self.longest = np.zeros(n, np.int64)
        self.longest[self.sa] = np.maximum(self.lcp, np.concatenate([[0], self.lcp[:-1]])) if n else 0

    def covered(self, min_words: int) -> np.ndarray:
        """Whether each word lies in a repeated substring of that many words."""
        n = len(self.longest)
        begins = np.nonzero(self.longest >= min_words)[0]
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, begins, 1)
        np.add.at(change, begins + self.longest[begins], -1)
        return np.cumsum(change)[:n] > 0

    def intervals(self, min_words: int) -> np.ndarray:
        """How many maximal repeated substrings each text has: the intervals of
        the array whose common prefix is at least that long and longer than
        that of the interval around them, which end where a prefix gets shorter."""
        deep = np.where(self.lcp >= min_words, self.lcp, 0)
        tops = (deep > 0) & (deep > np.concatenate([deep[1:], [0]])) if len(deep) else deep > 0
        return np.bincount(self.words.owner[self.sa[tops]], minlength=len(self.words.counts))


def per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values by text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    lists = pc.split_pattern(texts, "\n")
    at = lists.offsets.to_numpy()
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    coded = lists.flatten().dictionary_encode()
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(
        zero_copy_only=False).astype(bool)
    codes = coded.indices.to_numpy()
    kept = worded[codes] if len(codes) else np.zeros(0, bool)
    owner, codes = owner[kept], codes[kept]
    distinct = np.unique(owner * max(1, len(worded)) + codes) // max(1, len(worded))
    return np.bincount(owner, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def longest_per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts) - 1, np.int64)
    some = np.nonzero(np.diff(starts))[0]
    if len(some):
        out[some] = np.maximum.reduceat(values, starts[some])
    return out


def judge(batch: pa.RecordBatch, cover_min_words: int, max_covered: float, max_longest: int
          ) -> pa.RecordBatch:
    texts = text_column(batch)
    words = Words(texts)
    n_words = words.counts
    chars = pc.utf8_length(words.vocabulary).to_numpy()[words.codes] if len(words.codes) else \
        np.zeros(0, np.int64)
    repeats = Repeats(words)
    n_repeat = per_text(repeats.covered(WINDOW), words.starts)
    covered = repeats.covered(cover_min_words)
    word_chars = per_text(chars, words.starts)
    fraction = per_text(chars * covered, words.starts) / np.maximum(1, word_chars)
    longest = longest_per_text(repeats.longest, words.starts)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    n_covered, n_dup_lines = per_text(covered, words.starts), duplicate_lines(texts)
    spared = (n_words <= SHORT_WORDS) & (n_dup_lines == 1) & (n_covered <= 2 * longest)
    kept = ~failed & ((fraction <= max_covered) | spared) & (longest <= max_longest)
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column(0), "n_words": n_words, "word_chars": word_chars,
        "n_symbols": pc.cast(pc.count_substring_regex(texts, SYMBOLS), pa.int64()),
        "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat,
        "base_failed": failed, "kept": kept,
        "n_covered_words": n_covered, "covered_fraction": fraction,
        "longest_repeat_words": longest, "n_repeats": repeats.intervals(cover_min_words)})


def quality(docs: DataFrame, cover_min_words: int = COVER_MIN_WORDS,
            max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per document (doc_id, text): the base counts, what repeats cover,
    and whether the document is kept."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            yield judge(batch, cover_min_words, max_covered, max_longest)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)
