import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from plotcover.llm import queries as q
from plotcover.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    marks = [(d, fingerprint(t)) for d, t in rows]
    fps = sorted({f for _, f in marks})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    values = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.nonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 4)[0]:
            parent[root(f)] = root(fps[i + 1 + j])
    least = defaultdict(list)
    for d, f in marks:
        least[root(f)].append(d)
    return sorted((d, f"{f:016x}", min(least[root(f)])) for d, f in marks)


def test_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    got = sorted(map(tuple, q.op10_simhash_near_duplicates(spark, sf_dir).collect()))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_near_copies_nulls_long_ties_and_clashing_columns(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(12)]
    rows = []
    for i in range(90):
        words = base[i % 12].split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "A b"), (204, "a B"), (205, "x y " * 30_000),
             (206, "É a b c d"), (207, "é a b c d"), (208, base[0].upper()), (208, base[0].upper())]
    docs = spark.createDataFrame([r + (1,) for r in rows], "doc_id long, text string, fp int").repartition(3)
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    assert got == brute(rows)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_links_connect_all_within_the_radius(spark):
    rng = random.Random(8)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    values = set(seeds)
    for s in seeds:
        for _ in range(12):
            values.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    values = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)), i) for i, v in enumerate(values)],
                                  "fp long, first long")
    got = {r.fp: r.label for r in simhash.components(simhash.neighbours(frame), frame).collect()}
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 4:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    for i, v in enumerate(values):
        assert got.get(int(np.uint64(v).astype(np.int64)), i) == root(i)


def test_chain_settles(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    nodes = spark.createDataFrame([(i, (i * 7919) % 1000 + 5) for i in range(n + 1)], "fp long, first long")
    labels = {r.label for r in simhash.components(edges, nodes).collect()}
    assert labels == {min((i * 7919) % 1000 + 5 for i in range(n + 1))}


def test_keep_one_removes_only_near_duplicates(spark):
    rng = random.Random(9)
    def text():
        return " ".join(f"w{rng.randrange(10_000)}" for _ in range(60))
    plain, twice, copied, other = [text() for _ in range(8)], text(), text(), text()
    rows = [(None, t, "a") for t in plain]                         # documents without an id
    rows += [(5, plain[0], "a"), (None, plain[1], None), (None, plain[1], None)]
    rows += [(7, twice, "a"), (7, other, "a")]                     # one id, two documents
    rows += [(9, copied, "b"), (9, copied.upper(), "b"), (8, copied, "c"), (8, copied, "a"), (8, copied, "a")]
    schema = "doc_id long, text string, source string"
    results = []
    for parts in (1, 4):
        docs = spark.createDataFrame(rng.sample(rows, len(rows)), schema).repartition(parts)
        got = simhash.keep_one(docs)
        assert got.columns == docs.columns
        results.append(sorted(map(tuple, got.collect()), key=str))
    assert results[0] == results[1]                                # whatever the order of rows
    group = {f: min((d for d, t, _ in rows if fingerprint(t) == f and d is not None), default=None)
             for f in {fingerprint(t) for _, t, _ in rows}}
    assert len(group) == 11 and len(results[0]) == 11
    assert {fingerprint(t): d for d, t, _ in results[0]} == group
    assert all(r in rows for r in results[0])
    assert simhash.keep_one(docs.limit(0)).collect() == []


@pytest.mark.parametrize("size", [300, 1000])
def test_links_of_a_dense_cluster_grow_with_its_fingerprints(spark, size):
    rng = random.Random(size)
    centre, values = rng.getrandbits(64), set()
    while len(values) < size:
        values.add(centre ^ sum(1 << b for b in rng.sample(range(64), 2)) ^ (1 << rng.randrange(64)) * rng.randint(0, 1))
    values |= {rng.getrandbits(64) for _ in range(50)}
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in sorted(values)], "fp long")
    edges = simhash.neighbours(frame).cache()
    assert edges.count() <= 4 * size
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    def same(pairs):
        for v in values:
            parent[v] = v
        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = {}
        for v in values:
            groups.setdefault(root(v), set()).add(v)
        return sorted(sorted(g) for g in groups.values())

    ordered = np.array(sorted(values), np.uint64)
    near = [(int(ordered[i]), int(ordered[j])) for i in range(len(ordered))
            for j in np.nonzero(np.bitwise_count(ordered[i + 1:] ^ ordered[i]) <= 4)[0] + i + 1]
    mask = (1 << 64) - 1
    assert same([(r.a & mask, r.b & mask) for r in edges.collect()]) == same(near)
    assert len(near) > 10 * size


def test_keep_one_with_columns_of_any_name_and_type(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, 5, 7, {"a": 1}, 0), (2, text, 5, 7, {"a": 2}, 0), (3, "another text", None, 7, None, 1),
            (None, None, None, None, {"b": None}, 2), (3, "another text", None, 7, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_of long, `a.b` int, m map<string,int>, row int")
    got = simhash.keep_one(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)
    twin = docs.withColumnRenamed("a.b", "own").withColumnRenamed("row", "fp").withColumnRenamed("kept_of", "row1")
    assert simhash.keep_one(twin).count() == 3 and simhash.keep_one(twin).columns == twin.columns
