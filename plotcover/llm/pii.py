r"""Personal data by patterns and a semi-Markov conditional random field (operator 8).

The base spans (email, ip, card, phone) are found by fixed patterns in linear
time.  The model then looks at the *regions* of a text: runs of blank-separated
words that hold a digit, an ``@`` or a written-out ``[at]`` or ``[dot]``, with
the word before and after each (words of up to ``MAX_SIDE`` characters).  A
region is cut into tokens (letters, digits, a bracketed ``at``, ``dot``, ``@``
or ``.``, single other characters).  Every stretch of up to ``MAX_TOKENS``
tokens with a digit, ``@`` or ``[at]`` is a candidate segment; its score for a
kind is the sum of weights of features of the whole segment: its shape, how
many digits, dots and ``@`` it has, whether a check digit or the range of its
parts holds, what stands before and after it.  Dynamic programming over
segments of bounded length picks boundaries and kinds of a region together.
Tokens of base spans are barriers, so the model only adds spans; those are
kept whose segment has a posterior of at least ``MIN_POSTERIOR``.  A region may
be as long as its text: it is scored and decoded in blocks of ``BLOCK`` tokens,
as arrays, and between them only a few numbers a token are kept.

What the model adds are the spans that the patterns miss.  It is fitted by
gradient steps on the conditional likelihood of a bounded sample of regions of
up to ``MAX_TRAIN_CHARS`` characters: the ``TRAIN_REGIONS`` ones with the
smallest hash that hold a base span and as many that hold none.  Each of the
first is also learned ``COPIES`` times with its spans disguised (``noised``:
spaced or written-out ``@`` and dots, other separators, no ``+``, one wrong
digit in a card) and once with them cut to something harmless (``spoiled``).
Numbers of 14 to 19 digits that only fail the check digit are what a disguised
card looks like, so regions with one are no examples of harmless text.

Null texts count as empty.  Base spans of different kinds may overlap.
Repeated rows give equal results; an empty table gives none; without any
region to learn from the model adds nothing.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotcover.llm.common import bounded_batches, regroup, text_column

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
MAX_SIDE = 64            # characters of a neighbouring word that joins a region
BLOCK = 1024             # tokens whose segments are held at once
TRAIN_REGIONS = 150      # with a base span, and as many without
COPIES = 3
EPOCHS = 8
RATE = 0.3
FEATURE_BITS = 13
MIN_POSTERIOR = 0.9
MAX_TRAIN_CHARS = 320

Span = tuple[int, int, int]  # start, kind (index into KINDS), end

# The patterns of the contract.  Possessive runs and the
# look-behind change no match, they only keep long runs from being tried twice.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORTH = (r"@", r"[0-9]\.[0-9]+\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){13}", r"\+[0-9]")

MARK = r"[\[({](?:at|AT|dot|DOT|@|\.)[\])}]"
HINT = r"[0-9@]|" + MARK
TOKEN = re.compile(r"[ \t]?" + MARK + r"[ \t]?|[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
CORE = re.compile(r"(?<!\S)(?:[^\s0-9@\[({]*+(?:(?!" + MARK + r")[\[({][^\s0-9@\[({]*+)*+(?:[0-9@]|" + MARK + r")\S*+)")
RESULT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
          "base_sha256 string, spans string")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
               for p in address.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str, worth: tuple[bool, ...] = (True,) * 4) -> list[Span]:
    """The base spans by start, then kind; ``worth``: kinds worth a search."""
    out: list[Span] = []
    if worth[0]:
        out += [(s, 0, e) for s, e in emails(text)]
    if worth[1]:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if small_parts(m[0])]
    if worth[2]:
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
                if 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if worth[3]:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


# -- the model ----------------------------------------------------------------

def regions(text: str) -> Iterator[tuple[int, int]]:
    """The regions of a text, in order and apart."""
    start = end = -1
    for m in CORE.finditer(text):
        a, b = _beside(text, m.start(), m.end())
        if a <= end:
            end = b
            continue
        if end >= 0:
            yield start, end
        start, end = a, b
    if end >= 0:
        yield start, end


def _beside(text: str, start: int, end: int) -> tuple[int, int]:
    if start and text[start - 1] in " \t":
        words = re.search(r"\S+\Z", text[max(0, start - 2 - MAX_SIDE):start - 1])
        if words and len(words[0]) <= MAX_SIDE:
            start -= 1 + len(words[0])
    if text[end:end + 1] in (" ", "\t"):
        words = re.match(r"\S+", text[end + 1:end + 2 + MAX_SIDE])
        if words and len(words[0]) <= MAX_SIDE:
            end += 1 + len(words[0])
    return start, end


def tokens(text: str, start: int, end: int) -> np.ndarray:
    """Where the tokens of a stretch begin, and its end."""
    at = array("q", (m.start() for m in TOKEN.finditer(text, start, end)))
    at.append(end)
    return np.frombuffer(at, np.int64)


def candidates(text: str, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and validity of the segments that end with token ``low`` up to
    ``high - 1``: a row per last token, by number of tokens less one."""
    begin = max(0, low + 1 - MAX_TOKENS)
    here = at[begin:high + 1] - at[begin]
    piece = text[at[begin]:at[high]]
    chars = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    n = high - begin
    size, lead = np.diff(here), chars[here[:-1]]
    digit = (lead >= 48) & (lead <= 57)
    letter = ((lead | 32) >= 97) & ((lead | 32) <= 122)
    mark = (size > 1) & ~digit & ~letter
    said_at = np.zeros(n, bool)
    for t in np.nonzero(mark)[0]:
        said_at[t] = piece[here[t]:here[t + 1]].strip(" \t[](){}") in ("at", "AT", "@")
    blank = _blank(lead) & ~mark
    at_sign, dot = (lead == 64) | said_at, (lead == 46) | (mark & ~said_at)
    loose = np.where(letter, 1, np.where(digit, 2, np.where(mark, 3 + said_at, 100 + lead.astype(np.int64))))
    exact = np.where(digit, 10 + np.where(size >= 14, 9, np.minimum(size, 5)), loose)

    # digits and their check sums up to each token, for either side of the doubling
    is_digit = (chars >= 48) & (chars <= 57)
    seen = np.cumsum(is_digit, dtype=np.int32)
    value = np.where(is_digit, chars - 48, 0)
    twice = 2 * value - 9 * (value > 4)
    even = seen % 2 == 0
    sums = [np.concatenate([[0], np.cumsum(np.where(even == e, value, twice), dtype=np.int32)])[here]
            for e in (False, True)]
    seen = np.concatenate([[0], seen])[here]
    small = digit.copy()
    for t in np.nonzero(digit)[0]:
        small[t] = size[t] <= 3 and int(piece[here[t]:here[t + 1]]) <= 255 or small_parts(piece[here[t]:here[t + 1]])

    def running(flags: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(flags)])

    cores, ats, dots, lows = running(digit | at_sign), running(at_sign), running(dot), running(small)
    words, gaps = running(letter), running(blank)
    before = np.concatenate([[_side(text, at[begin] - 1)], _sides(chars[here[1:] - 1])[:-1]])
    after = np.concatenate([_sides(lead)[1:], [_side(text, at[high])]])
    ends = np.arange(low - begin, n)
    rows = len(ends)
    found = np.zeros((rows, MAX_TOKENS, 13), np.int32)
    valid = np.zeros((rows, MAX_TOKENS), bool)
    shape = {"e": np.zeros(rows, np.uint64), "l": np.zeros(rows, np.uint64)}
    power = 1
    for k in range(min(MAX_TOKENS, n)):
        first = ends - k
        inside = first >= 0
        i, j = np.maximum(first, 0), ends + 1
        power = power * 0x9E3779B97F4A7C15 % (1 << 64)
        for name, codes in (("e", exact), ("l", loose)):
            shape[name] = shape[name] + codes[i].astype(np.uint64) * np.uint64(power)
        digits, points = seen[j] - seen[i], dots[j] - dots[i]
        total = np.where(seen[j] % 2 == 0, sums[1][j] - sums[1][i], sums[0][j] - sums[0][i])
        checked = (digits >= 14) & (digits <= 19) & (total % 10 == 0)
        only = (words[j] == words[i]).astype(np.int64)
        address = (lows[j] - lows[i] == 4) & (points == 3) & (k == 6 + gaps[j] - gaps[i]) & digit[i] & digit[ends]
        valid[:, k] = (inside & (cores[j] > cores[i]) & ~blank[i] & ~blank[ends]
                       & ~mark[i] & ~mark[ends])
        parts = (shape["e"], shape["l"], np.minimum(20, digits), loose[i], loose[ends], before[i], after[ends],
                 np.minimum(2, ats[j] - ats[i]) * 8 + np.minimum(4, points), checked * 2 + (k == 0) * digit[i],
                 address, (lead[i] == 43) * 2 + ((digits >= 10) & (digits <= 15)),
                 only * 32 + np.minimum(20, digits), np.zeros(rows))
        for f, part in enumerate(parts):
            found[:, k, f] = _hashed(part, f)
    return found, valid


def _blank(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 0x85) | (codes == 0xA0)


def _side(text: str, at: int) -> int:
    return int(_sides(np.array([ord(text[at])]))[0]) if 0 <= at < len(text) else 0


def _sides(codes: np.ndarray) -> np.ndarray:
    letter = (codes > 127) | (((codes | 32) >= 97) & ((codes | 32) <= 122))
    digit = (codes >= 48) & (codes <= 57)
    return np.where(letter, 1, np.where(digit, 2, np.where(_blank(codes), 3, 10 + codes)))


def _hashed(values: np.ndarray, feature: int) -> np.ndarray:
    mixed = (values.astype(np.uint64) + np.uint64(feature << 40 | 1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


BIAS = int(_hashed(np.zeros(1), 12)[0])


def segment_scores(found: np.ndarray, valid: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Last token x number of tokens less one x kind."""
    scores = np.zeros((*valid.shape, len(KINDS)))
    for f in range(found.shape[2]):
        scores += weights[found[:, :, f]]
    scores[~valid] = -np.inf
    return scores


def _logsum(values: np.ndarray) -> float:
    top = values.max()
    return top if top == -np.inf else float(top + np.log(np.exp(values - top).sum()))


def _forward(both: np.ndarray, low: int, forward: np.ndarray) -> None:
    """Fill ``forward`` behind ``low`` from log sums of segments by last token."""
    some = (both > -np.inf).any(1)
    for t in range(len(both)):
        j = low + t + 1
        k = min(j, MAX_TOKENS)
        forward[j] = forward[j - 1]
        if some[t]:
            forward[j] = np.logaddexp(forward[j - 1], _logsum(forward[j - k:j][::-1] + both[t, :k]))


def _backward(both: np.ndarray, low: int, high: int, backward: np.ndarray) -> None:
    """Fill ``backward`` from ``high - 1`` down to ``low``; rows of ``both`` begin
    with the segments that end with token ``low``."""
    spread = np.arange(MAX_TOKENS)
    padded = np.concatenate([both, np.full((MAX_TOKENS, both.shape[1]), -np.inf)])
    for i in range(high - 1, low - 1, -1):
        later = padded[i - low + spread, spread]
        backward[i] = backward[i + 1]
        k = min(MAX_TOKENS, len(backward) - 1 - i)
        if (later[:k] > -np.inf).any():
            backward[i] = np.logaddexp(backward[i + 1], _logsum(backward[i + 1:i + 1 + k] + later[:k]))


def noised(kind: int, span: str, rng: np.random.Generator) -> str:
    """A span in a disguise that the patterns miss."""
    def pick(*options: str) -> str:
        return options[int(rng.integers(len(options)))]
    if kind == 0:
        local, domain = span.split("@", 1)
        at = pick("[at]", "(at)", " [at] ", " (at) ", "{at}", "[@]", " @ ")
        return local + at + domain.replace(".", pick(".", "[dot]", "(dot)", " [dot] ", "[.]"))
    if kind == 1:
        return span.replace(".", pick("[.]", "(.)", "[dot]", " [dot] ", " . "))
    if kind == 2:
        digits = digits_of(span)
        if rng.integers(2):
            places = [i for i, c in enumerate(span) if c.isdigit()]
            at = places[int(rng.integers(len(places)))]
            return span[:at] + str((int(span[at]) + 1 + int(rng.integers(9))) % 10) + span[at + 1:]
        return pick(".", "/", "_", "--").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    groups = re.findall("[0-9]+", span)
    return pick(span[1:], "00" + span[1:], span[span.find("("):] if "(" in span else span[1:],
                "+" + "/".join(groups), "-".join(groups), ".".join(groups))


def spoiled(kind: int, span: str, rng: np.random.Generator) -> str:
    """A span cut to something harmless."""
    if kind == 0:
        return span.split("@")[0] if rng.integers(2) else span.split("@")[1]
    if kind == 1:
        parts = span.split(".")
        return ".".join(parts[:int(rng.integers(1, 4))]) if rng.integers(2) else ".".join([*parts[:3], "9" + parts[3] + "7"])
    digits = digits_of(span)
    return digits[:int(rng.integers(1, 9))] if kind == 3 or rng.integers(2) else digits + digits[:int(rng.integers(6, 12))]


def rewritten(region: tuple[str, int, int, list[Span]], how, rng: np.random.Generator, keep: bool
              ) -> tuple[str, int, int, list[Span]]:
    """A region with each span that overlaps none rewritten; ``keep``: still spans."""
    text, start, end, spans = region
    parts, reached, size, gold = [], 0, 0, []
    for a, kind, b in spans:
        if a < reached:
            continue
        new = how(kind, text[a:b], rng)
        parts += [text[reached:a], new]
        size += a - reached + len(new)
        if keep:
            gold.append((size - len(new), kind, size))
        reached = b
    parts.append(text[reached:])
    whole = "".join(parts)
    return whole, start, end + len(whole) - len(text), gold


def examples(sample: list[tuple[str, int, int, list[Span]]], seed: int = 7) -> list[tuple]:
    """The sample, with disguised and with spoiled copies of its spans."""
    rng = np.random.default_rng(seed)
    out = list(sample)
    for region in sample:
        if region[3]:
            out += [rewritten(region, noised, rng, True) for _ in range(COPIES)]
            out.append(rewritten(region, spoiled, rng, False))
    return out


def fit(sample: list[tuple[str, int, int, list[Span]]]) -> np.ndarray | None:
    """Weights (feature x kind) from regions with their spans."""
    cases = []
    for text, start, end, spans in sample:
        at = tokens(text, start, end)
        if len(at) < 2:
            continue
        found, valid = candidates(text, at, 0, len(at) - 1)
        place = {int(a): t for t, a in enumerate(at)}
        gold, reached = [], start
        for a, kind, b in spans:
            i, j = place.get(a, -1), place.get(b, -1)
            if a >= reached and 0 <= i < j <= i + MAX_TOKENS and valid[j - 1, j - 1 - i]:
                gold.append((j - 1, j - 1 - i, kind))
                reached = b
        if valid.any():
            cases.append((found, valid, gold))
    if not any(gold for _, _, gold in cases):
        return None
    weights = np.zeros((1 << FEATURE_BITS, len(KINDS)))
    weights[BIAS] = -2.0
    squares = np.full_like(weights, 1e-6)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for c in order.permutation(len(cases)):
            found, valid, gold = cases[c]
            push = -posteriors(segment_scores(found, valid, weights))
            for t, k, kind in gold:
                push[t, k, kind] += 1
            some = np.abs(push).max(2) > 1e-4
            if not some.any():
                continue
            rows, back = np.unique(found[some], return_inverse=True)
            step = np.zeros((len(rows), len(KINDS)))
            np.add.at(step, back.reshape(-1), np.repeat(push[some], found.shape[2], axis=0))
            step -= 1e-3 * weights[rows]
            squares[rows] += step * step
            weights[rows] += RATE * step / np.sqrt(squares[rows])
    return weights


def posteriors(scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind of one stretch."""
    n = len(scores)
    both = np.logaddexp.reduce(scores, axis=2)
    forward, backward = np.zeros(n + 1), np.zeros(n + 1)
    _forward(both, 0, forward)
    _backward(both, 0, n, backward)
    begin = np.arange(n)[:, None] - np.arange(MAX_TOKENS)
    return np.exp(scores + (forward[np.maximum(begin, 0)] + backward[1:, None] - forward[n])[:, :, None])


def added_spans(text: str, base: list[Span], weights: np.ndarray) -> list[Span]:
    """Spans the model finds outside the base spans."""
    out: list[Span] = []
    blocks = sorted((s, e) for s, _, e in base)
    head = 0                                     # spans before it end before the region
    for start, stop in regions(text):
        while head < len(blocks) and blocks[head][1] <= start:
            head += 1
        inside, at = [], head
        while at < len(blocks) and blocks[at][0] < stop:
            if blocks[at][1] > start:
                inside.append(blocks[at])
            at += 1
        for s, e in [*inside, (stop, stop)]:
            if start < s and CORE_IN.search(text, start, min(s, stop)):
                out += _decode(text, start, min(s, stop), weights)
            start = max(start, e)
    return out


CORE_IN = re.compile(HINT)


def _decode(text: str, start: int, end: int, weights: np.ndarray, block: int = BLOCK) -> Iterator[Span]:
    """The sure segments of the best segmentation, from blocks of segments by their
    last token.  Ties: no segment, then the longer one, then the kind listed first.
    The way back scores the blocks again, and only if the way forward chose a segment."""
    at = tokens(text, start, end)
    n = len(at) - 1

    @functools.lru_cache(1)
    def scored(low: int, high: int) -> np.ndarray:
        return segment_scores(*candidates(text, at, low, min(n, high)), weights)

    # no segment is surer than against none in its place
    needed = math.log(MIN_POSTERIOR / (1 - MIN_POSTERIOR))
    if not any(scored(low, low + block).max() >= needed for low in range(0, n, block)):
        return
    forward, value, got = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    back, kind_of = np.zeros(n + 1, np.int8), np.zeros(n + 1, np.int8)
    for low in range(0, n, block):
        scores = scored(low, low + block)
        _forward(np.logaddexp.reduce(scores, axis=2), low, forward)
        kinds = scores.argmax(2)
        top = np.take_along_axis(scores, kinds[:, :, None], 2)[:, :, 0]
        some = (top > -np.inf).any(1)
        for t in range(len(top)):
            j = low + t + 1
            value[j] = value[j - 1]
            if some[t]:
                k = min(j, MAX_TOKENS)
                through = value[j - k:j] + top[t, :k][::-1]
                i = int(through.argmax())
                if through[i] > value[j]:
                    size = k - i
                    value[j], back[j], kind_of[j], got[j] = through[i], size, kinds[t, size - 1], top[t, size - 1]
    chosen, j = [], n
    while j > 0:
        if back[j] and got[j] >= needed:
            chosen.append(j)
        j -= int(back[j]) or 1
    if not chosen:
        return
    backward = np.zeros(n + 1)
    for low in range((n - 1) // block * block, -1, -block):
        high = min(n, low + block)
        scores = scored(low, low + block if high == n else high + MAX_TOKENS)
        _backward(np.logaddexp.reduce(scores, axis=2), low, high, backward)
    for j in reversed(chosen):
        i = j - int(back[j])
        if np.exp(got[j] + forward[i] + backward[j] - forward[n]) >= MIN_POSTERIOR:
            yield int(at[i]), int(kind_of[j]), int(at[j])


# -- Spark --------------------------------------------------------------------

def _worth(texts: pa.Array) -> list[tuple[bool, ...]]:
    return list(zip(*[pc.match_substring_regex(texts, p).to_pylist() for p in WORTH]))


def train(docs: DataFrame) -> np.ndarray | None:
    """Fit the model on a bounded sample of regions of ``docs`` (text)."""
    bounded_batches(docs.sparkSession)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            texts = text_column(batch)
            some = pc.match_substring_regex(texts, HINT).to_pylist()
            rows: dict[tuple[int, bool], tuple] = {}
            for text, worth, use in zip(texts.to_pylist(), _worth(texts), some):
                if not use:
                    continue
                base = base_spans(text, worth)
                unsure = [m.span() for m in CARD.finditer(text)
                          if 14 <= len(d := digits_of(m[0])) <= 19 and not luhn(d)]
                for start, end in regions(text):
                    if end - start > MAX_TRAIN_CHARS or any(a < end and start < b for a, b in unsure):
                        continue
                    shift = max(0, start - 1)
                    near = text[shift:end + 1]
                    own = [f"{a - shift}:{k}:{b - shift}" for a, k, b in base if start <= a and b <= end]
                    key = xxhash.xxh3_64_intdigest(near) >> 1
                    rows[key, bool(own)] = (near, start - shift, end - shift, ",".join(own))
            # a batch gives its smallest hashes only: the sample needs no more
            for own in (False, True):
                rows_ = sorted((k, r) for (k, o), r in rows.items() if o == own)[:TRAIN_REGIONS]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([k for k, _ in rows_], pa.int64()),
                    "held": pa.array([own] * len(rows_), pa.bool_()),
                    "text": pa.array([r[0] for _, r in rows_], pa.string()),
                    "start": pa.array([r[1] for _, r in rows_], pa.int32()),
                    "end": pa.array([r[2] for _, r in rows_], pa.int32()),
                    "spans": pa.array([r[3] for _, r in rows_], pa.string())})

    found = (docs.select("text").mapInArrow(
        sample, "key long, held boolean, text string, start int, end int, spans string")
        .dropDuplicates(["key", "held"]))
    taken = [r for own in (False, True)
             for r in found.where(F.col("held") == own).orderBy("key", "text").limit(TRAIN_REGIONS).collect()]
    return fit(examples([(r["text"], r["start"], r["end"],
                          [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in taken]))


def find(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """One row per document (doc_id, text): base counts and digest, all spans."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            rows = [_row(base, spans) for base, spans in spans_of(text_column(batch), model.value)]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                **{f"n_{k}": pa.array(columns[i], pa.int64()) for i, k in enumerate(KINDS)},
                "base_sha256": pa.array(columns[4]), "spans": pa.array(columns[5])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def spans_of(texts: pa.Array, weights: np.ndarray | None) -> Iterator[tuple[list[Span], list[Span]]]:
    """The base spans and all spans of each text."""
    some = pc.match_substring_regex(texts, HINT).to_pylist()
    for text, worth, use in zip(texts.to_pylist(), _worth(texts), some):
        if not use:
            yield [], []
            continue
        base = base_spans(text, worth)
        yield base, base if weights is None else sorted(base + added_spans(text, base, weights))


def _row(base: list[Span], spans: list[Span]) -> tuple:
    count = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
    return (*count, hashlib.sha256(joined_spans(base).encode()).hexdigest(), joined_spans(spans))


def joined_spans(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the kind of its first."""
    parts, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def mask(docs: DataFrame, weights: np.ndarray | None, column: str = "text") -> DataFrame:
    """``docs`` with personal data in ``column`` replaced; null texts stay null."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            texts = batch.column(at).to_pylist()
            new = [t if t is None or not spans else masked(t, spans) for t, (_, spans) in
                   zip(texts, spans_of(text_column(batch, column), model.value))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
