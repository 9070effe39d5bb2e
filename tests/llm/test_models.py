"""Language and quality models by held-out accuracy, and the pipeline stage by stage."""

from pyspark.sql import functions as F

import corpus_pipeline
from boxweave.llm import langid, quality
from tests.llm.test_copies import plain_roots
from tests.llm.test_search import plain_spans

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark, odd, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    assert model.languages == ["de", "en", "es", "fr"] and model.code.shape == (4, 7)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.count() > 150 and held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.where("held_out != (crc32(cast(doc_id as string)) % 5 = 0) or score not between 0 and 1").count() == 0
    rows = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == rows[11].lang_pred == "und" and rows[8].lang_pred != "und"
    assert langid.predict(odd, langid.fit(nothing)).where("lang_pred != 'und'").count() == 0
    assert langid.predict(nothing, model).count() == 0


def test_codewords_correct_an_error():
    for n in (1, 2, 3, 5, 9, 40):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n
        far = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(far, default=3) >= (3 if n > 4 else 1)


def test_quality_held_out(spark, odd, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").where("held_out")
    counts = {(r.quality, r.predicted): r.n for r in got.groupBy("quality", "predicted").agg(F.count("*").alias("n")).collect()}
    assert counts[0, 0] >= 0.8 * (counts[0, 0] + counts[0, 1])
    assert counts[1, 1] >= 0.99 * (counts[1, 1] + counts.get((1, 0), 0))
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    none = quality.fit(nothing, labels.limit(0))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.keep_good(odd, none).columns == odd.columns and quality.score(nothing, model).count() == 0


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against a plain version of its decision."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.cut_lineage(stage(spark, seen[-1], SF), name))
    assert all(d.columns == columns for d in seen[:-1])
    rows = [{r.doc_id: r for r in d.collect()} for d in seen]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    lost = rows[0].keys() - rows[1].keys()
    assert sum(labels.get(k) == 1 for k in lost) <= 2 and sum(labels.get(k) == 0 for k in lost) >= 40
    kept = sorted(rows[1])
    assert set(rows[2]) == {kept[i] for i in plain_roots([rows[1][k].text for k in kept])}
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {k for k, r in rows[2].items() if any(i.strip(".") in r.text.lower() for i in items)}
    assert whole <= rows[2].keys() - rows[3].keys()
    kinds = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"]
    for k, r in rows[4].items():
        assert plain_spans(r.text) == []
        assert (r.text == rows[3][k].text) or any(x in r.text for x in (*kinds, "[SECRET]", "[ACCOUNT]", "[LOGIN]"))
    assert {k: r.text for k, r in rows[5].items()} == {k: r.text for k, r in rows[4].items()}
    assert all(r.n_tokens == len(r.ids) for r in rows[5].values())


def test_pipeline_runs_as_one(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "ids", "text"] and 100 < got.count() < 200
