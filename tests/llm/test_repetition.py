import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from plotcover.llm import queries as q
from plotcover.llm import repetition
from plotcover.llm.common import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    seen, n = {}, len(words)
    for i in range(n - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(repeated), failed)


def longest_repeats(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                out[i] = max(out[i], k)
    return out


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_over_whole_table(spark, sf_dir):
    want = {d: brute(t) for d, t in
            duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()}
    got = {r.doc_id: r for r in q.op5_quality_rules(spark, sf_dir).collect()}
    assert {d: tuple(r[c] for c in COLS) for d, r in got.items()} == want
    assert all(not r.kept for r in got.values() if r.base_failed)
    assert sum(r.kept for r in got.values()) > len(got) / 2


@pytest.mark.parametrize("seed", range(6))
def test_longest_repeat_at_each_word(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 60)))
             for _ in range(12)]
    words = Words(pa.array(texts))
    repeats = repetition.Repeats(words)
    assert repeats.longest.tolist() == [k for t in texts for k in longest_repeats(t.split())]
    for least in (1, 3):
        want = []
        for t in texts:
            at = longest_repeats(t.split())
            hit = {j for i, k in enumerate(at) if k >= least for j in range(i, i + k)}
            want += [j in hit for j in range(len(at))]
        assert repeats.covered(least).tolist() == want


def test_edge_cases_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(1, None), (2, ""), (3, " \n "), (4, long), (5, "a " * 9_000), (6, "x y"), (6, "x y"),
            (None, "q"), (7, long + " " + passage + " z " + passage)]
    docs = spark.createDataFrame([r + (True,) for r in rows],
                                 "doc_id long, text string, kept boolean").repartition(3)
    got = {}
    for r in repetition.quality(docs).collect():
        assert tuple(r[c] for c in COLS) == brute(dict(rows)[r.doc_id]), r.doc_id
        got[r.doc_id] = r
    assert len(got) == 8 and got[4].kept and not got[5].kept
    assert got[7].longest_repeat_words == 120 and not got[7].base_failed and not got[7].kept
    assert repetition.quality(docs.limit(0)).collect() == []


def test_no_match_across_texts():
    words = Words(pa.array(["a b c d e f", "a b c d e f"]))
    assert not np.any(repetition.Repeats(words).longest)


def test_limits_bite_below_the_base_rule():
    def run(name, n):
        return " ".join(f"{name}{i:03}" for i in range(n))
    passage, line = run("p", 80), run("l", 12)
    texts = [run("w", 640) + " " + passage + " z " + passage,          # 80 words twice, 800 in all
             " ".join(run(f"a{i}_", 52) + " " + run(f"r{i // 2}_", 11) for i in range(20)),
             run("w", 100) + "\n" + line + "\n" + run("v", 20) + "\n" + line,
             run("w", 200) + "\n" + run("m", 25) + "\n" + run("v", 20) + "\n" + run("m", 25),
             run("w", 100) + " " + line + " " + run("v", 20) + " " + line,
             run("w", 500) + " " + line + " " + line]
    got = repetition.judge(pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": texts}),
                           repetition.COVER_MIN_WORDS, repetition.MAX_COVERED, repetition.MAX_LONGEST).to_pylist()
    assert not any(r["base_failed"] for r in got)
    assert got[0]["longest_repeat_words"] == 80
    assert all(0.15 < got[i]["covered_fraction"] < 0.25 for i in (1, 2, 3, 4))
    # only the short text with one repeated line is spared
    assert [r["kept"] for r in got] == [False, False, True, False, False, True]
