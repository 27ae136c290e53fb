import hashlib
import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from plotcover.llm import queries as q
from plotcover.llm import substrings as sub

L = sub.LENGTH


def brute(rows):
    least = {}
    low = -(1 << 63)
    for d, t in rows:
        b = (t or "").encode()
        d = low if d is None else d
        for i in range(len(b) - L + 1):
            w = b[i:i + L]
            if least.get(w, d) >= d:
                least[w] = d
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - L + 1):
            if least[b[i:i + L]] < (low if d is None else d):
                gone[i:i + L] = b"\1" * L
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    got = sorted(map(tuple, q.op9_substring_deduplication(spark, sf_dir).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 0


def test_passages_at_all_offsets_nulls_long_repeats_and_clashing_columns(spark):
    rng = random.Random(6)
    def noise(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [noise(n) for n in (25, 49, 50, 51, 70, 300)]
    rows = [(i, noise(rng.randint(0, 80)) + rng.choice(passages) + noise(rng.randint(0, 80))
             + rng.choice(passages)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "x" * 49), (203, "x" * 5000), (204, "x" * 60), (199, "x" * 55),
             (205, "ab" * 3000), (206, "ba" * 40), (207, passages[5]), (207, passages[5]), (-5, passages[5][3:200])]
    docs = spark.createDataFrame([r + ("n",) for r in rows], "doc_id long, text string, name string").repartition(4)
    assert sorted(map(tuple, sub.deduplicate(docs).collect()), key=str) == brute(rows)
    assert sub.deduplicate(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n_runs", [1, 2, 3, 7])
def test_merge_equals_sort(n_runs):
    rng = random.Random(n_runs)
    runs, every = [], []
    for r in range(n_runs):
        n = rng.randint(1, 60)
        rows = np.array([[rng.choice(b"ab") if j < 12 else 7 for j in range(sub.WIDTH)] for _ in range(n)], np.uint8)
        ids = np.array([rng.randrange(100) for _ in range(n)], np.int64)
        every += zip((bytes(x) for x in rows), ids.tolist())
        (bucket, *parts), = sub.sorted_runs(rows, ids, 1)
        runs.append(sub.Run(*parts))
    got = list(sub.merged(runs))
    assert [s for s, *_ in got] == sorted(s for s, *_ in got)
    last = bytes(sub.WIDTH)
    for s, known, *_ in got:
        assert known == next((i for i in range(sub.WIDTH) if s[i] != last[i]), sub.WIDTH)
        last = s
    least, several = {}, {}
    for s, i in every:
        least[s] = min(least.get(s, i), i)
        several.setdefault(s, set()).add(i)
    runs = [sub.Run(r.known, r.rests, np.array(r.ids, np.int64).tobytes(), r.several) for r in runs]
    (strings, ids, shared), = sub.slices(sub.merged(runs))
    assert dict(zip(strings, ids.tolist())) == least
    assert dict(zip(strings, shared.tolist())) == {s: len(d) > 1 for s, d in several.items()}


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh") for _ in range(L))
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)) + passage + "zz" for n in (0, 5, 33, 200)]
    found = sub.find_anchors(pa.array(texts))
    seen = set()
    for i, t in enumerate(texts):
        p = int(found.starts[i]) + t.index(passage)
        k = np.nonzero((found.low <= p) & (p <= found.high) & (found.owner == i))[0]
        assert len(k) == 1
        seen.add((int(found.at[k[0]]) - p, int(found.hash[k[0]])))
    assert len(seen) == 1


def test_window_hash_depends_on_content_only():
    body = np.frombuffer(b"0123456789" * 30, np.uint8)
    h = sub.window_hashes(body)
    assert h[3] == h[13] and h[3] != h[4]


def test_hot_phrase_in_varying_context_is_spread(spark):
    rng = random.Random(11)
    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, longer, context = noise(30), noise(53), [noise(12) for _ in range(6)]
    rows = [(rng.randrange(300), noise(rng.randint(0, 90)) + rng.choice(context) + rng.choice([phrase, longer])
             + rng.choice(context) + noise(rng.randint(0, 90))) for _ in range(400)]
    rows += [(None, noise(20) + context[0] + phrase + context[1]), (500, "x" * 300), (501, "x" * 120), (502, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    _, hot = sub.shared_bitmap(docs, 1, 50)
    found = sub.find_anchors(pa.array([t or "" for _, t in rows]))
    # no anchor that is left to the merge stands at more places than allowed
    kept = found.hash[~sub.is_hot(found.hash, hot, 1)]
    assert len(hot) and np.unique(kept, return_counts=True)[1].max() <= 50
    assert np.unique(found.hash, return_counts=True)[1].max() > 100
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    for limit in (0, 50, sub.HOT):
        assert sorted(map(tuple, sub.deduplicate(docs, limit).collect()), key=str) == want


def test_anchors_across_blocks_equal_one_by_one(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abé ") for _ in range(n)) for n in (0, 49, 50, 300, 0, 0, 7, 51, 120, 48, 64, 0)]
    whole = sub.find_anchors(pa.array(texts))
    for block in (1, 37, 64):
        monkeypatch.setattr(sub, "BLOCK", block)
        found = sub.find_anchors(pa.array(texts))
        for name in ("at", "owner", "hash", "low", "high"):
            assert np.array_equal(getattr(found, name), getattr(whole, name))
    starts = whole.starts
    windows = [p for i in range(len(texts)) for p in range(starts[i], starts[i + 1] - L + 1)]
    assert windows == [p for b, e in zip(whole.low, whole.high) for p in range(b, e + 1)]
    words = np.array([int.from_bytes(whole.body[i:i + 8].tobytes(), "little")
                      for i in range(len(whole.body) - 7)], np.uint64)
    hashes = sub.kmer_hashes(words[:-16], words[8:-8], words[16:]) >> np.uint64(32)
    for at, low, high in zip(whole.at, whole.low, whole.high):
        assert all(p + int(np.argmin(hashes[p:p + sub.PLACES])) == at for p in range(low, high + 1))


def test_anchors_and_windows_take_few_bytes_besides_the_text():
    # arrays of eight bytes for each byte of text are made by blocks, not of a whole batch
    rng = np.random.default_rng(2)
    text = rng.integers(97, 123, 4 << 20, np.uint8).tobytes().decode()
    rows = np.zeros((20_000, sub.WIDTH), np.uint8)
    rows[:, :-4] = rng.integers(97, 123, (20_000, sub.WIDTH - 4), np.uint8)
    rows[:, -2:] = 20, L
    strings, ids = sorted(map(bytes, rows)), np.arange(20_000)
    for work, size, most in ((lambda: sub.find_anchors(pa.array([text])), len(text), 20),
                             (lambda: sub.window_owners(strings, ids, ids > 0), 70 * len(rows), 45)):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * size, (peak / size, most)


def test_spans_of_rows_as_pairs():
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    rows = [None, [{"begin": 1, "end": 60}], [], [{"begin": 5, "end": 70}, {"begin": 0, "end": 50}], None]
    spans = pa.array([[{"begin": 9, "end": 99}], *rows], kind)[1:]
    assert sub.span_lists(spans) == [[], [(1, 60)], [], [(5, 70), (0, 50)], []]
