import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa

from plotcover.llm import chunks
from plotcover.llm import queries as q
from plotcover.llm.bpe import default_tokenizer, encoder

SCHEMA = "doc_id long, text string, key string"


def brute(rows):
    t = encoder(default_tokenizer()).tokenizer
    out = []
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def test_whole_table_matches_library(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    assert sorted(map(tuple, q.op1_bpe_encoding(spark, sf_dir).collect()), key=str) == brute(rows)


def test_shared_passages_long_words_and_edge_cases(spark):
    rng = random.Random(3)
    alphabet = "abcde é'sß. ,\n\t漢1"
    passage = "".join(rng.choice(alphabet) for _ in range(6000))
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 900))) + passage
             + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 900))))
            for i in range(12)]
    rows += [(20, None), (21, ""), (22, "x" * 40_000), (23, "x" * 40_000), (24, "é" * 20_000),
             (25, passage), (25, passage), (None, passage), (26, "  \n ")]
    docs = spark.createDataFrame([r + ("k",) for r in rows], SCHEMA).repartition(4)
    got = chunks.encode_documents(docs, default_tokenizer(), digests=True).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    ids = {r.doc_id: r for r in chunks.encode_documents(docs, default_tokenizer()).collect()}
    t = encoder(default_tokenizer()).tokenizer
    assert ids[25].ids == t.encode(passage, add_special_tokens=False).ids
    assert ids[25].decoded == t.decode(ids[25].ids, skip_special_tokens=False)


def test_joins_at_arbitrary_cuts():
    """Every chunk known: all joins are repaired, whatever the cut falls on."""
    rng = random.Random(5)
    e = encoder(default_tokenizer())
    for _ in range(60):
        text = "".join(rng.choice("ab c'é1,\n") for _ in range(rng.randint(1, 120)))
        data = text.encode()
        cuts = sorted({c for c in rng.sample(range(1, len(data) + 1), min(4, len(data)))
                       if c < len(data) and data[c] & 0xC0 != 0x80})
        bounds = [0, *cuts, len(data)]
        memory = {}

        def encoded(spans):
            for b, x in spans:
                ids, _ = e.encode(pa.array([data[b:x].decode()]))
                memory[b, x] = ids
            return memory

        pieces = [(b, x, encoded([(b, x)])[b, x]) for b, x in zip(bounds, bounds[1:])]
        got = chunks.repair(data, pieces, encoded)
        assert list(got) == e.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_empty_table(spark):
    assert chunks.encode_documents(spark.createDataFrame([], SCHEMA), default_tokenizer()).collect() == []


def test_chunks_follow_content():
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    a, b = (set(chunks.Chunked(pa.array([p + body])).keys) for p in ("", "some other start "))
    assert len(a & b) >= len(a) - 2
