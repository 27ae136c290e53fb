import math
import random
import re
import string
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from plotcover.llm import queries as q
from plotcover.llm import search
from tests.oracle_compare import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """docs, items: lists of (id, text)"""
    split = [(d, Counter(t), len(t)) for d, text in docs for t in [terms(text)] if t]
    documents, length = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, tf, _ in split for t in tf)
    out = []
    for item, text in sorted({(i, t) for i, t in items if t is not None}, key=str):
        wanted = Counter(terms(text))
        scored = []
        for d, tf, n in split:
            m = 75 + 25 * n * documents // length
            score = sum(r * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                        * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m)) for t, r in wanted.items() if t in tf)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort()
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_whole_tables(spark, sf_dir):
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall()
    got = result(q.op13_ranked_search(spark, sf_dir))
    assert got == brute(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    same = compare(spark, sf_dir, q.op13_ranked_search, q.OP13_SQL, con)
    assert same["hash_match"] and same["columns_match"]


def topical(rng, n, words, topics=6):
    """Texts of a few topics, each with its own words, some shared by all."""
    out = []
    for _ in range(n):
        topic = rng.randrange(topics)
        own = [f"t{topic}x{int(rng.paretovariate(0.9))}" for _ in range(rng.randint(1, words))]
        out.append(" ".join(own + rng.choices(["the", "of", "and", "in"], k=rng.randint(0, 6))))
    return out


def test_trees_prune_and_lose_nothing():
    rng = random.Random(11)
    docs = list(enumerate(topical(rng, 3000, 60)))
    items = list(enumerate(topical(rng, 40, 12))) + [(40, ""), (41, "--"), (42, "unknown words")]
    asked = search.Items(items)
    found = search.terms(pa.array([t for _, t in docs]))
    width = len(asked.vocabulary)
    known = {t: i for i, t in enumerate(asked.vocabulary.to_pylist())}
    tid = np.array([known.get(t, -1) for t in found.vocabulary.to_pylist()])[found.codes]
    owner, term, tf = search._counted((found.owner * width + tid)[tid >= 0], width)
    df = np.bincount(term, minlength=width)
    weight = np.array([math.floor(1000 * math.log((2 * 3000 + 2) / (2 * int(d) + 1))) for d in df])
    tree = search.ItemTree(asked, weight)
    run = search.Search(tree, 5)
    value = search.count_part(tf, found.counts[owner], 3000, int(found.counts.sum()))
    for at in range(0, 3000, 500):
        own = (owner >= at) & (owner < at + 500)
        some, place = np.unique(owner[own], return_inverse=True)
        run.run(search.Block(place, term[own], value[own], len(some), tree), some, np.zeros(len(some), bool))
    got = [(items[i][0], rank, int(d), int(s)) for place, i in enumerate(tree.order)
           for rank, (d, s) in enumerate(zip(run.best.doc[place], run.best.score[place]), 1)]
    assert sorted(got, key=str) == brute(docs, items, 5)
    assert run.compared < 0.3 * 3000 * len(tree.order)


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    docs = [(1, None), (2, ""), (3, " -- "), (4, "Apple apple PEAR"), (5, "apple apple pear"), (5, "apple apple pear"),
            (None, "apple apple pear"), (6, "É é x 10%"), (7, "pear " * 60_000), (8, "kiwi"), (9, "a\x00b A_b")]
    items = [(1, "apple PEAR pear"), (1, "kiwi"), (2, None), (3, ""), (4, "é É x 10"), (5, "nothing known"),
             (None, "b"), (1, "apple PEAR pear"), (6, "pear " * 20_000)]
    frame = spark.createDataFrame([d + (1, 2) for d in docs], "doc_id long, text string, item_id int, score int")
    asked = spark.createDataFrame([i + ("x",) for i in items], "item_id long, text string, doc_id string")
    assert result(search.search(frame.repartition(3), asked)) == brute(docs, items)
    assert result(search.search(frame, asked, k=2, group_bytes=50_000)) == brute(docs, items, 2)
    assert search.search(frame.limit(0), asked).collect() == []
    assert search.search(frame, asked.limit(0)).collect() == []


def test_lengths_beyond_64_bits():
    n = np.array([10, 10 ** 9])
    got = search.count_part(np.array([3, 5]), n, 4 * 10 ** 9, 9 * 10 ** 12)
    assert got.tolist() == [10 ** 9 * tf // (1000 * tf + 12 * (75 + 25 * m * 4 * 10 ** 9 // (9 * 10 ** 12)))
                            for tf, m in ((3, 10), (5, 10 ** 9))]
