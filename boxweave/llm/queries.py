"""The registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxweave.llm import chat, decontam, idfile, interplay, langid, lexicon, negatives, pii, quality, simhash, sketch, tokens, urlrules
from boxweave.runtime import scratch_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op3_token_id_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the files, read them back, and describe every document from what was read."""
    path = scratch_path(spark, "ids")
    idfile.write_ids(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=2)

    def digest(keys, starts, ids):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in ids], pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    return idfile.map_ids(spark, path, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op8_bpe_codes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(rows, ids, decode):
        sha = hashlib.sha256
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0).cast(pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([sha(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([sha(decode(x).encode()).hexdigest() for x in ids], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return lexicon.map_codes(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), digest, schema)


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.with_neighbours(table(spark, sf_dir, "documents"))


@query("op4_simhash_components")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# The rules of this query
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query(
    "op5_url_rules",
    """
with rules(rhost, rpath, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r from pages),
parts as (select page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path, row_number() over () as n from rest),
fits as (select n, rhost || rpath as rule, verdict,
    row_number() over (partition by n order by length(rhost || rpath) desc, length(rhost) desc, verdict desc) as place
  from parts join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parts left join (select * from fits where place = 1) f on parts.n = f.n
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages"), rules)


@query("op6_benchmark_matches")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op11_chat_formatting",
    r"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
turns as (select *, row_number() over w as n, coalesce(lag(role) over w <> role, true) as opens from rows
  window w as (partition by conv_id order by turn nulls first, role, text)),
sized as (select *, len(regexp_extract_all(text, '<\\*(\||/?s>|</?SYS>>)|\[\\*/?INST\]')) + length(text) as shown,
  len(regexp_extract_all(role, '<\\*(\||/?s>|</?SYS>>)|\[\\*/?INST\]')) + length(role) as role_shown from turns)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(shown + case when opens then role_shown + 24 else 8 end) as bigint) as formatted_chars,
  count(*) filter (opens) as n_blocks
from sized group by conv_id
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that quotes control strings, then describe them from the formatted text alone."""
    quoted = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", quoted), (-1, 1, "assistant", quoted)], "conv_id long, turn long, role string, text string")
    chats = chat.format_chats(rows.unionByName(added))
    read = chats.select(
        "*",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_blocks").cast("long").alias("n_blocks"),
    )


@query(
    "op12_hard_negatives",
    """
with rows as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, cast(list_inner_product(a.q, r.q) as bigint) as score
  from rows a join rows r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (select anchor_id, id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) as rank,
  id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.quantised(table(spark, sf_dir, "embeddings").withColumn("label", label))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query(
    "op13_filter_interplay",
    r"""
with docs as (select doc_id, coalesce(text, '') as text, coalesce(source, '') as part from documents),
words as (select *, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda w: w <> '') as w from docs),
marks as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
firsts as (select text, min(doc_id) as first from docs group by text),
masks as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
  [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
   regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] as fails
  from words left join marks using (doc_id) left join firsts using (text)),
counters as (select part, good, toxic, fails, len(list_filter(fails, lambda f: f)) as failed, count(*) as n from masks group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps as (select filter_order, s as step, ascii(filter_order[s]) - 64 as f,
  list_transform(range(1, s), lambda i: ascii(filter_order[i]) - 64) as before from orders, range(1, 6) as t(s)),
seen as (select part, filter_order, step, good, toxic, n, fails[f] as fail, failed, len(list_filter(before, lambda i: fails[i])) > 0 as gone
  from counters, steps)
select part, filter_order, cast(step as integer) as step,
  cast(sum(case when not gone and not fail then n else 0 end) as bigint) as kept,
  cast(sum(case when not gone and fail then n else 0 end) as bigint) as removed,
  cast(sum(case when gone and fail then n else 0 end) as bigint) as redundant,
  cast(sum(case when fail and failed = 1 then n else 0 end) as bigint) as unique_fails,
  cast(sum(case when not gone and fail and good then n else 0 end) as bigint) as good_lost,
  cast(sum(case when not gone and fail and toxic then n else 0 end) as bigint) as toxic_lost,
  cast(sum(case when fail then n * 120 // failed else 0 end) as bigint) as shapley
from seen group by part, filter_order, step
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return interplay.audit(spark, f"{sf_dir}/documents.parquet", labels, scratch_path(spark, "interplay"))
