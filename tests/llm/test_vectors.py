import duckdb
import numpy as np
import pytest

from plotcover.llm import queries as q
from plotcover.llm import vectors


def brute(rows, threshold=0.93):
    """rows: (vec_id, embedding, label)"""
    n = len(rows)
    unit = []
    for _, e, label in rows:
        x = None if e is None or label is None or None in e else np.array(e, np.float64)
        good = x is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if good else None)
    links = np.zeros((n, n), bool)
    groups = {}
    for i, u in enumerate(unit):
        if u is not None:
            groups.setdefault((rows[i][2], len(u)), []).append(i)
    for members in groups.values():
        block = np.array([unit[i] for i in members])
        links[np.ix_(members, members)] = block @ block.T >= threshold
    np.fill_diagonal(links, False)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(links)):
        parent[root(a)] = root(b)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], int(links[i].sum()), least.get(root(i)), rows[i][0] == least.get(root(i)))
                   for i in range(n)), key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"select vec_id, embedding, label from '{sf_dir}/embeddings.parquet'").fetchall()
    assert result(q.op11_embedding_near_duplicates(spark, sf_dir)) == brute(rows)


def clusters(rng, labels, sizes, noise, dim=16):
    rows = []
    for label in range(labels):
        for size in sizes:
            base = rng.normal(size=dim)
            rows += [((base + noise * rng.normal(size=dim)).astype(np.float32).tolist(), label) for _ in range(size)]
        rows += [(rng.normal(size=dim).astype(np.float32).tolist(), label) for _ in range(60)]
    return [(int(i), e, label) for i, (e, label) in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize("noise", [0.05, 0.2, 0.3, 0.5])
def test_clusters_cells_cores_and_chunks(spark, monkeypatch, noise):
    # many small cells, chunks and salts, whatever the data's size
    monkeypatch.setattr(vectors, "CELL", 20)
    monkeypatch.setattr(vectors, "CHUNK", 16)
    monkeypatch.setattr(vectors, "PART", 50)
    rows = clusters(np.random.default_rng(int(noise * 100)), 2, (120, 40, 7, 2), noise)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = result(vectors.near_duplicates(docs))
    assert got == brute(rows)
    assert sum(n for _, n, _, _ in got) > 0


def test_nulls_zeros_copies_ties_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
            (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1),
            (10, [1.0, None], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1),
            (12, [1e200, 1e198], 1), (13, [5e-324, 0.0], 1), (14, [-1.0, -0.0], 1), (15, [-1.0, 0.0], 1),
            (16, [0.93, (1 - 0.93 ** 2) ** 0.5 * 0.999], 1)]
    frame = spark.createDataFrame([r + (1, "x") for r in rows],
                                  "vec_id long, embedding array<double>, label int, node int, digest string")
    want = brute(rows)
    # a null vec_id alone is its own component
    want = sorted([(v, n, c, True if v is None and c is None else k) for v, n, c, k in want], key=str)
    assert result(vectors.near_duplicates(frame.repartition(3))) == want
    assert vectors.near_duplicates(frame.limit(0)).collect() == []


def test_a_tight_cluster_is_counted_without_being_compared(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=32)
    rows = [(i, (base + 0.01 * rng.normal(size=32)).tolist(), 1) for i in range(600)]
    rows += [(600 + i, rng.normal(size=32).tolist(), 1) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    seen = []
    real = vectors._compare
    monkeypatch.setattr(vectors, "_compare", lambda cells, t: seen.append(cells.count()) or real(cells, t))
    got = result(vectors.near_duplicates(frame))
    assert got == brute(rows)
    assert seen[0] <= 2 * 300          # the cluster is not among the compared
