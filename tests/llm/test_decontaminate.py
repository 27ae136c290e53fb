import random

import duckdb
import numpy as np
import pyarrow as pa

from plotcover.llm import decontaminate as de
from plotcover.llm import queries as q


def words(text):
    plain = ("".join(c for c in w.lower() if c.isalpha() or c.isdecimal()) for w in (text or "").split())
    return [w for w in plain if w]


def best_stretch(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(row[j] + (v != w), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_whole_table_against_exact_containment(spark, sf_dir):
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id): r.edits for r in q.op7_decontamination(spark, sf_dir).collect()}
    plain = {d: " " + " ".join(words(t)) + " " for d, t in docs}
    exact = {(d, i) for i, t in items for d in plain if " " + " ".join(words(t)) + " " in plain[d]}
    assert exact and {p for p, e in got.items() if e == 0} == exact
    by_id, items = dict(docs), dict(items)
    for (d, i), e in got.items():
        assert best_stretch(words(items[i]), words(by_id[d])) <= e <= 0.2 * len(words(items[i]))


def test_recall_of_edited_items_and_clean_documents():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 60)))) for i in range(60)]
    block = de.build_block(items, 0.2)
    texts, want = [], set()
    for i, t in items:
        for _ in range(4):
            w = t.split()
            for _ in range(rng.randint(0, int(0.2 * len(w)))):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                if kind == 0:
                    w[at] = rng.choice(vocabulary)
                elif kind == 1:
                    del w[at]
                else:
                    w.insert(at, rng.choice(vocabulary))
            noise = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(2)]
            want.add((len(texts), i))
            texts.append(f"{noise[0]} {' '.join(w).upper()}! {noise[1]}")
    texts += [" ".join(rng.choices(vocabulary, k=200)) for _ in range(50)]
    got = {(t, i) for t, i, *_ in block.matches(pa.array(texts))}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_edge_cases_and_blocks(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "x " * 60_000 + long + " y" * 60_000, 0), (4, long, 0), (4, long, 0),
         (None, "Alpha, BETA gamma delta epsilon zeta eta other iota kappa lambda mu", 0), (5, "one two", 0),
         (6, "beta gamma delta", 0)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, long), (1, long), (2, None), (3, "..."), (4, ""), (5, "one two"),
                                   (6, "absent words here")], "item_id long, text string")
    for size in (1 << 20, 100):
        got = sorted(map(tuple, de.find_contamination(docs, items, block_bytes=size).collect()), key=str)
        assert got == sorted([(3, 1, 60_000, 12, 0), (4, 1, 0, 12, 0), (4, 1, 0, 12, 0), (5, 5, 0, 2, 0),
                              (None, 1, 0, 12, 1)], key=str)
    assert de.find_contamination(docs.limit(0), items).collect() == []
    assert de.find_contamination(docs, items.limit(0)).collect() == []


def test_edit_distance_is_exact():
    rng = np.random.default_rng(4)
    items = rng.integers(1, 4, (40, 6)).astype(np.uint64)
    texts = rng.integers(1, 4, (40, 12)).astype(np.uint64)
    want = [best_stretch(a.tolist(), b.tolist()) for a, b in zip(items, texts)]
    assert de.edit_distance(items, texts)[0].tolist() == want


def test_every_size_meets_edited_windows_and_few_others():
    rng = np.random.default_rng(8)

    def rows(n, m):
        return (rng.integers(0, 3000, (n, m)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    for m in range(5, 101):
        size = de.SizeClass(m, int(0.2 * m + 1e-9), rows(100, m), list(range(100)))
        which = np.arange(300) % 100
        windows = np.array([de.edit_at_random(size.items[i], size.k, rng) for i in which])
        met = {p for w, i in size.collide(windows) for p in zip(w.tolist(), i.tolist())}
        assert sum((w, i) in met for w, i in enumerate(which.tolist())) >= 0.95 * len(which), m
        others = sum(len(w) for w, _ in size.collide(rows(300, m)))
        assert others < 0.01 * 300 * 100, m


def test_pairs_come_once_and_a_size_that_never_gets_there_is_verified_whole(monkeypatch):
    rng = np.random.default_rng(9)
    items = rng.integers(1, 5, (40, 10)).astype(np.uint64)   # four words only: nearly all meet
    windows = rng.integers(1, 5, (30, 10)).astype(np.uint64)
    size = de.SizeClass(10, 2, items, list(range(40)))
    whole = {p for w, i in size.collide(windows) for p in zip(w.tolist(), i.tolist())}
    monkeypatch.setattr(de, "PAIRS", 7)
    parts = list(size.collide(windows))
    pairs = [p for w, i in parts for p in zip(w.tolist(), i.tolist())]
    assert len(pairs) == len(set(pairs)) and set(pairs) == whole and len(parts) > 10
    monkeypatch.setattr(de, "MAX_REPETITIONS", 1)
    direct = de.SizeClass(60, 12, rng.integers(1, 1 << 60, (3, 60)).astype(np.uint64), [0, 1, 2])
    assert direct.samples is None
    pairs = [p for w, i in direct.collide(rng.integers(1, 9, (5, 60)).astype(np.uint64))
             for p in zip(w.tolist(), i.tolist())]
    assert sorted(pairs) == [(w, i) for w in range(5) for i in range(3)]
