import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import SCHEMA, frame, odd_rows, prose
from tests.llm.test_operators import classes_by_brute_force, language_rows, rare_words


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark, tmp_path):
    good = [(i, prose(i, 80), "en", "src0", 1) for i in range(120)] + [(200 + i, prose(i, 80), "en", "src1", 1) for i in range(10)]
    junk = [(300 + i, " ".join(w + "###" for w in prose(i, 80).split()), "en", "src0", 1) for i in range(9)]
    secret = [(400, prose(900, 80) + ' token = "' + "0123456789abcdef" * 2 + '"', "en", "src0", 1)]
    docs = frame(spark, good + junk + secret)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{name.replace(' ', '')}"
        stage(spark, kept, str(tmp_path)).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == SCHEMA.names
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(rows) == {*range(120), 400} and "0123456789abcdef" not in rows[400] and corpus_pipeline.MARK in rows[400]
    assert all(rows[i] == prose(i, 80) for i in range(120))


def test_each_stage_takes_odd_rows_and_empty_tables(spark):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, frame(spark, odd_rows()), "").collect()
        assert stage(spark, frame(spark, []), "").count() == 0


def test_near_dedup_keeps_one_of_each_class(spark):
    rows = odd_rows()
    kept = corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect()
    classes = classes_by_brute_force([r[1] for r in rows])  # the document without an id is one of its own
    assert len(kept) == len(set(classes)) and len({r["doc_id"] for r in kept}) == len(kept) and any(r["doc_id"] is None for r in kept)


def test_near_dedup_keeps_documents_without_an_id(spark):
    near = lambda i: prose(i, 150) + " changed"
    rows = [(1, prose(1, 150), "en", "s", 1), (None, near(1), "en", "s", 1), (None, near(1), "en", "s", 1), (None, prose(2, 150), "en", "s", 1), (None, near(2), "en", "s", 1)]
    rows += [(None, None, "en", "s", 1), (None, "no id here", "en", "s", 1), (3, prose(3, 150), "en", "s", 1), (3, near(3), "en", "s", 1)]
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect()]
    assert len(kept) == 5 and kept.count((1, prose(1, 150))) == kept.count((None, None)) == kept.count((None, "no id here")) == 1
    assert sum(i is None and t in (prose(2, 150), near(2)) for i, t in kept) == 1 and sum(i == 3 for i, _ in kept) == 1


def test_language_stage_drops_what_has_no_language(spark):
    rows = language_rows() + [(1000, "1234", "en", "s", 1), (1001, None, "en", "s", 1)]
    out = corpus_pipeline.language(spark, frame(spark, rows), "").collect()
    assert {r["doc_id"] for r in out} == set(range(240)) and all(r["lang"] == ["de", "en"][r["doc_id"] % 2] for r in out)


def test_secret_stage_knows_the_words_of_all_documents(spark):
    docs, values = rare_words(spark, 45_000)
    whole = docs.union(values).select("*", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    out = corpus_pipeline.secret_scan(spark, whole, "").cache()
    assert out.count() == whole.count() and out.exceptAll(whole).count() == 0


def test_secret_stage_knows_words_beyond_the_list_of_all_workers(spark):
    docs, values = rare_words(spark, 66_000)
    secret = spark.createDataFrame([(-1, "pwd: Q7#vL0!xZ9&k and ftp://me:Rt8%wq2Z@h", "en")], "doc_id long, text string, lang string")
    whole = docs.union(values).union(secret).select("*", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    out = corpus_pipeline.secret_scan(spark, whole, "").cache()
    assert out.count() == whole.count()
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in out.exceptAll(whole).collect()] == [(-1, "pwd: [secret] and ftp://me:[secret]@h", 37)]


def test_run_packs_what_the_stages_keep(spark, tmp_path):
    rows = [(i, prose(i, 80), "en", "src0", 1) for i in range(60)] + [(100, prose(3, 80), "en", "src0", 1)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == set(range(60))
    assert sum(r["length"] for r in out) == sum({r["doc_id"]: r["doc_tokens"] for r in out}.values())
    assert np.unique([r["sequence_id"] for r in out]).tolist() == list(range(max(r["sequence_id"] for r in out) + 1))
