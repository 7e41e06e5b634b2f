"""The operators over the driver's tables, one query each, and SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm import bpe, decontaminate, idfiles, lengths, licences, lm, middle, periods, quality, repeats, rules, simhash, topk
from larkspur.llm.common import lean
from larkspur.plans import registry
from larkspur.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return registry.load(lean(spark), sf_dir, name)


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_license_scan", licences.oracle())
def op1_license_scan(spark, sf_dir):
    """Documents as files source/lang/doc_id; those of at most 300 characters are the licence files."""
    docs = load(spark, sf_dir, "documents")
    files = docs.select(F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")
    found = licences.scan(files, licence_file=F.length("text") <= 300, threshold=0.7)
    return found.withColumn("score", F.round("score", 6))


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    found = lengths.token_lengths(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return lengths.suffix_sums(lengths.histogram(found))


@query("op3_simhash")
def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), words=4, max_bits=4)


@query("op4_id_files")
def op4_id_files(spark, sf_dir):
    path = scratch_path(spark, "ids")
    idfiles.write_ids(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return idfiles.read_digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op5_repeats")
def op5_repeats(spark, sf_dir):
    out = repeats.remove_repeats(load(spark, sf_dir, "documents"), size=400)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", (F.octet_length("kept") + n_removed).alias("n_bytes"), n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op6_bpe")
def op6_bpe(spark, sf_dir):
    out = bpe.encode(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.digests(out).drop("ids", "decoded")


@query(
    "op7_topk",
    """
    WITH v AS (
        SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, rank, vec_id, score FROM (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
    ) WHERE rank <= 5""",
)
def op7_topk(spark, sf_dir):
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    v = load(spark, sf_dir, "embeddings")
    usable = "embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    v = v.where(usable).select("vec_id", whole.alias("embedding"))
    return topk.top_k(v, v.where("vec_id % 50 = 0"), k=5)


@query("op8_quality")
def op8_quality(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, load(spark, sf_dir, "labels")), threshold=0.7)


@query("op9_lm_score")
def op9_lm_score(spark, sf_dir):
    return lm.lm_scores(load(spark, sf_dir, "documents"))


@query("op10_decontaminate")
def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def looped(doc_id: object, words: list[bytes]) -> list[bytes]:
    """One document in ten repeats a stretch of its words to its end; the id says which, from where and how long.
    A null id names none."""
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    found = periods.find_runs(load(spark, sf_dir, "documents"), edit=looped)
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda best, r: F.when(more(best, r), r).otherwise(best))  # ties stay with the earlier run
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.*", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query("op12_fill_in_middle")
def op12_fill_in_middle(spark, sf_dir):
    out = middle.fill_in_middle(load(spark, sf_dir, "documents"), seed=42, rate=50, suffix_first=80)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


@query("op13_quality_rules", rules.oracle())
def op13_quality_rules(spark, sf_dir):
    return rules.quality_rules(load(spark, sf_dir, "documents"))
