import duckdb

import corpus_pipeline
from plotcover.llm import langid, pii
from plotcover.llm.bpe import default_tokenizer, encoder
from tests.llm.test_decontaminate import best_stretch, words
from tests.llm.test_simhash import brute as near_groups


def test_stages_in_order_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [words(t) for _, t in duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall()]
    grams = {tuple(i[a:a + 3]) for i in items for a in range(len(i) - 2)}
    frames, rows = [], {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = rows
        docs = stage(spark, docs, sf_dir).cache()
        frames.append(docs)
        got = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
            rows = {r.doc_id: r.text for r in got}
            assert len(got) == len(rows)
        if name == "language":
            with_letters = {d for d, t in before.items() if any(c.isalpha() for c in t or "")}
            assert set(rows) <= with_letters and len(rows) > 0.97 * len(with_letters)
        elif name == "near_duplicates":
            assert sorted(rows) == sorted({c for _, _, c in near_groups(list(before.items()))})
        elif name == "decontamination":
            for d, t in before.items():
                w = words(t)
                hot = any(best_stretch(i, w) <= int(0.2 * len(i)) for i in items
                          if any(tuple(w[a:a + 3]) in grams for a in range(len(w) - 2)) and len(w) < 400)
                if len(w) < 400:
                    assert (d not in rows) == hot, d
        elif name == "personal_data":
            for r in got:
                spans = pii.base_spans(before[r.doc_id])
                assert all(before[r.doc_id][a:b] not in r.text or kind == 1 for a, kind, b in spans)
                assert r.n_chars == len(r.text)
                if not any(c.isdigit() or c == "@" for c in before[r.doc_id]):
                    assert r.text == before[r.doc_id]
        elif name == "tokens":
            t = encoder(default_tokenizer()).tokenizer
            assert {r.doc_id for r in got} == set(before)
            for r in got:
                assert r.ids == t.encode(before[r.doc_id], add_special_tokens=False).ids
                assert r.n_tokens == len(r.ids) and r.decoded == t.decode(r.ids, skip_special_tokens=False)
    for f in frames:
        f.unpersist()


def test_edge_rows_through_all_stages(spark, tmp_path):
    text = "the quick brown fox jumps over the lazy dog and runs far away from the old house "
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "123 !!", "en", "s", 6), (4, text, "en", "s", 1),
            (5, text, "en", None, 1), (5, text, "en", None, 1), (6, text + "mail me@site.org now", None, "s", None),
            (7, text * 4000, "en", "s", 1), (8, "der hund und die katze sind im haus " * 3, "de", "s", 1)]
    docs = spark.createDataFrame([r + ("x",) for r in rows], "doc_id long, text string, lang string, "
                                 "source string, n_chars long, score string")
    spark.createDataFrame([(1, "some other words that no document here has at all")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame, least in ((docs, 3), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, str(tmp_path))
            if name != "tokens":
                assert frame.columns == docs.columns
        ids = {r.doc_id for r in frame.collect()}
        assert len(ids) >= least and not ids & {1, 2, 3} and not {4, 5} <= ids


def test_model_keeps_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = langid.keep_identified(docs, langid.train(docs))
    assert kept.count() >= 0.98 * docs.where("text rlike '[a-z]'").count()
