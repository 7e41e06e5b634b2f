"""Token counts from an exact length histogram.

Documents are encoded once and only their lengths are kept: rows per length, counted before the shuffle. Sums
over all lengths at or above each length then answer every context limit. The running sums never order the
whole histogram in one task: a length is a number of base-1024 digits, and its suffix sum is that of the last
digit among lengths of equal higher digits, plus that of the digit before among theirs, and so on, each over
1024 rows at most.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm import bpe
from larkspur.llm.common import id_text, raw
from larkspur.session import settle

DIGITS, BITS = 4, 10  # digits of a length, bits of a digit


def token_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, length long): ids of each whole text; null and empty texts have none."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        c = bpe.codec(tokenizer)
        return pa.array([len(c.encode(t)) for t in raw(texts)], pa.int64())

    # not deterministic, for the optimizer: it would repeat the encoding in a filter on the length
    once = count.asNondeterministic()
    return id_text(docs, id_col, text_col).select("doc_id", once("text").alias("length"))


def histogram(lengths: DataFrame, col: str = "length") -> DataFrame:
    """(length, n_docs) of non-null lengths."""
    return lengths.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("long").alias("length")).agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length that occurs, as a context limit: how many documents and tokens have that length
    (n_docs, n_tokens), reach it (docs_from, tokens_from), and what cutting every document to it leaves
    (truncated_tokens). An empty histogram gives no rows."""
    rows = settle(hist).withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    docs, tokens = F.col("n_docs"), F.col("n_tokens")
    level = rows.select("length", F.col("length").alias("head"), "n_docs", "n_tokens")
    out = rows.select("length", "n_docs", "n_tokens", docs.alias("docs_from"), tokens.alias("tokens_from"))
    for d in range(DIGITS):
        # sums over siblings with a larger digit, at this digit, for every head that occurs
        level = level.groupBy("head").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        over = Window.partitionBy(F.shiftright("head", BITS)).orderBy(F.col("head").desc()).rowsBetween(Window.unboundedPreceding, -1)
        above = level.select(F.col("head").alias("_head"), F.coalesce(F.sum("n_docs").over(over), F.lit(0)).alias("_d"), F.coalesce(F.sum("n_tokens").over(over), F.lit(0)).alias("_t"))
        out = out.withColumn("_head", F.shiftright("length", BITS * d)).join(above, "_head").withColumn("docs_from", F.col("docs_from") + F.col("_d")).withColumn("tokens_from", F.col("tokens_from") + F.col("_t")).drop("_head", "_d", "_t")
        level = level.withColumn("head", F.shiftright("head", BITS))
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    return out.withColumn("truncated_tokens", total - F.col("tokens_from") + F.col("length") * F.col("docs_from"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_over, truncated_tokens, total_tokens) for any context limits, also between lengths:
    each is answered from the least length above it."""
    ask = F.broadcast(sums.sparkSession.createDataFrame([(int(x),) for x in limits], "context long"))
    total = sums.agg(F.sum("n_tokens")).first()[0] or 0
    over = ask.join(sums, F.col("length") > F.col("context"), "left").groupBy("context").agg(F.min_by("docs_from", "length").alias("d"), F.min_by("tokens_from", "length").alias("t"))
    d, t = F.coalesce("d", F.lit(0)), F.coalesce("t", F.lit(0))
    return over.select("context", d.alias("docs_over"), (total - t + F.col("context") * d).alias("truncated_tokens"), F.lit(total).cast("long").alias("total_tokens"))


def quantiles(sums: DataFrame, probs: list[float]) -> DataFrame:
    """(prob, length): the least length that at least a share `prob` of the documents don't exceed."""
    n = sums.agg(F.sum("n_docs")).first()[0] or 0
    ask = F.broadcast(sums.sparkSession.createDataFrame([(float(p), -int(-p * n // 1)) for p in probs], "prob double, need long"))
    at_most = n - F.col("docs_from") + F.col("n_docs")
    return ask.join(sums, at_most >= F.col("need")).groupBy("prob").agg(F.min("length").alias("length"))
