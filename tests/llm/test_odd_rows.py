"""Pipeline stages and single operators on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import corpus_pipeline
from pyspark.sql import functions as F

from boxweave.llm import langid, quality, simhash, sketch

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long), (2, long + " more"), (3, None), (4, ""), (5, " \n"), (6, "write to a.b@mail.example.org"), (6, "write to a.b@mail.example.org"), (None, "no id at all here"), (7, "same id"), (7, "other text")]
    docs = spark.createDataFrame([(*r, None, "s", 1) for r in rows], COLUMNS)
    return docs.withColumns({c: F.lit("mine") for c in ("text_key", "kept_id", "score", "ids", "fp", "item_id", "spans", "n_tokens")})


def test_every_stage_on_odd_rows(spark):
    docs = odd_documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        got = corpus_pipeline.cut_lineage(stage(spark, docs, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == columns, name
            assert got.where("text_key <> 'mine' or score <> 'mine' or ids <> 'mine' or fp <> 'mine'").count() == 0
            docs = got
    left = {(r["doc_id"], r["text"][:8] if r["text"] is not None else None) for r in docs.collect()}
    # Near copies leave one: the long text of id 1, one of the texts without words, one of the equal rows.
    assert {k for k, _ in left} == {1, 3, 6, 7, None} and sum(k == 7 for k, _ in left) == 2
    assert docs.where("text like '%mail.example%'").count() == 0
    assert got.columns == ["doc_id", "n_tokens", "ids", "text"] and got.count() == docs.count()
    assert got.where("doc_id = 3 and n_tokens = 0 and text = ''").count() == 1


def test_every_stage_on_an_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_simhash_on_an_empty_table(spark, nothing):
    found = simhash.components(nothing)
    assert found.columns == ["doc_id", "fp", "component_id"] and found.count() == 0


def test_a_single_document_follows_itself(spark):
    """Its edited text takes the first quarter of the text itself."""
    text = " ".join(f"w{i}" for i in range(40))
    row = sketch.with_neighbours(spark.createDataFrame([(5, text)], "doc_id long, text string")).first()
    edited = text[: len(text) - len(text) // 4] + text[: len(text) // 4]
    assert row["n_chars"] == len(text) and row["near_next"] == 1.0 and 0 < row["near_edited"] < 1
    import hashlib

    assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_equal_texts_get_equal_answers(spark):
    """Ties of losses and of scores are decided alike wherever a text stands."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.limit(60)
    twice = some.unionByName(some.withColumn("doc_id", F.col("doc_id") + 10**6)).repartition(7)
    model = langid.fit(docs)
    said = langid.predict(twice, model).join(twice.select("doc_id", "text"), "doc_id").groupBy("text").agg(F.count_distinct("lang_pred", "score").alias("n"))
    assert said.where("n <> 1").count() == 0
    unknown = spark.createDataFrame([(1, "qqqq"), (2, "qqqq"), (3, "1 2 3"), (4, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.predict(unknown, model).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] and rows[3]["lang_pred"] == rows[4]["lang_pred"] == "und"
    graded = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality.score(twice, graded).join(twice.select("doc_id", "text"), "doc_id").groupBy("text").agg(F.count_distinct("score", "predicted").alias("n"))
    assert scores.where("n <> 1").count() == 0
