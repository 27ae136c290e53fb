import duckdb
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plotcover.llm import queries as q
from plotcover.llm import records
from plotcover.llm.bpe import WordEncoder, default_tokenizer, encoder

SCHEMA = "doc_id long, text string, path string"


def brute(rows):
    t = encoder(default_tokenizer()).tokenizer
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records_match_library_on_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    got = sorted(map(tuple, q.op6_token_records(spark, sf_dir).collect()))
    assert got == brute(rows)


def test_null_empty_long_repeated_and_clashing_columns(spark):
    rows = [(3, "it's <|endoftext|> éÉ 12"), (1, None), (2, ""), (5, "ab " * 50_000),
            (4, "x"), (4, "x"), (4, None)]
    docs = spark.createDataFrame([r + ("p",) for r in rows], SCHEMA).repartition(3)
    manifest = records.write_token_records(docs, default_tokenizer(), 2)
    got = sorted(map(tuple, records.read_token_records(spark, manifest).collect()))
    assert got == sorted(brute(rows))
    shuffled = records.read_token_records(spark, manifest, shuffle_seed=7).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in shuffled) == sorted(
        (g[0], g[2], g[3]) for g in got)


def test_empty_table(spark):
    manifest = records.write_token_records(spark.createDataFrame([], SCHEMA), default_tokenizer(), 2)
    assert records.read_token_records(spark, manifest).collect() == []


def test_damage_is_found():
    framed = bytearray(records.frame(b"some data"))
    framed[14] ^= 1
    with pytest.raises(ValueError, match="data"):
        records.unframe(bytes(framed), 0)
    framed[0] ^= 1
    with pytest.raises(ValueError, match="length"):
        records.unframe(bytes(framed), 0)


def test_pieces_of_plain_words_go_straight_to_the_model():
    rng = random.Random(4)
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    others = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalpha() and chr(c) not in "'<"]
    plain = letters + others + ["".join(rng.choice(letters + others) for _ in range(rng.randint(1, 9)))
                                for _ in range(3000)]
    foreign = ["it's", "a<|b", "<|endoftext|>", "漢字", "ét", "Ω1", "ĳ", "²", "×", "x y", "ª", "µm"]
    e = WordEncoder(default_tokenizer())
    library, asked = e.tokenizer, []

    class Watched:
        def encode_batch_fast(self, words, **options):
            asked.extend(words)
            return library.encode_batch_fast(words, **options)

    e.tokenizer = Watched()
    ids, starts = e.encode(pa.array([" ".join(plain)] + foreign + plain))
    texts = [" ".join(plain)] + foreign + plain
    for i, text in enumerate(texts):
        assert ids[starts[i]:starts[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text
    # every accented letter and mark went through the whole library before
    assert asked and set(asked) - {""} <= set(foreign)
