"""Table files in and out, lookups stacked in one file, saved models and parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from larkspur.operators.clean import recode, tokens_to_null
from larkspur.operators.ordered import sample_borders, with_bins
from larkspur.operators.profile import columns_of


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, null_tokens: Sequence[str] = ()) -> DataFrame:
    """Headed CSV with a fixed schema; the first null token is read as null by the parser, any others after it."""
    reader = spark.read.schema(schema).option("header", "true").option("multiLine", "false").option("escape", '"')
    if null_tokens:
        reader = reader.option("nullValue", null_tokens[0])
    df = reader.csv(path)
    strings = columns_of(df, "string")
    return tokens_to_null(df, null_tokens[1:], strings) if len(null_tokens) > 1 and strings else df


def read_labelled_text(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1", columns: Mapping[str, str] | None = None, labels: Mapping | None = None
) -> DataFrame:
    """CSV in a given charset: keep and rename two columns, recode the label."""
    columns = columns or {"v1": "label", "v2": "text"}
    df = spark.read.option("header", "true").option("encoding", encoding).option("escape", '"').csv(path)
    df = df.select([F.col(a).alias(b) for a, b in columns.items()])
    return recode(df, "label", labels or {"ham": 0, "spam": 1})


def split_stacked_lookup(df: DataFrame, key: str, text: str, order: str, first: str) -> dict[str, DataFrame]:
    """Lookup tables stacked in one file: a key that is no number opens the next section and names it;
    `first` names the section under the file's own header. Blank rows are dropped.

    Rows fall into bins of `order`, a unique key. A row's section is the last one opened before it in its
    bin, else the last one opened in the bins before, which are a small table."""
    named = F.col(key).isNotNull() & F.col(key).try_cast("bigint").isNull()
    rows = with_bins(df, {order: sample_borders(df, order)}, {order: "_bin"}).withColumn("_opens", F.when(named, F.col(key)))
    ends = rows.groupBy("_bin").agg(F.max_by("_opens", F.when(named, F.col(order))).alias("_end"))
    before = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_bin", F.last("_end", ignorenulls=True).over(before).alias("_before"))
    inside = Window.partitionBy("_bin").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_inside", F.last("_opens", ignorenulls=True).over(inside)).join(ends, "_bin")
    rows = rows.withColumn("section", F.coalesce("_inside", "_before", F.lit(first)))
    rows = rows.where(~named & F.col(key).isNotNull()).select(
        "section", F.col(key).try_cast("bigint").alias("id"), F.trim(text).alias(text)
    )
    names = [r[0] for r in rows.select("section").distinct().collect()]
    return {n: rows.where(F.col("section") == n).select("id", text) for n in names}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(fmt).save(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_params(spark: SparkSession, params: Mapping[str, Mapping], path: str) -> None:
    """Best parameters per model, one JSON row each."""
    rows = [(name, {k: str(v) for k, v in p.items()}) for name, p in params.items()]
    spark.createDataFrame(rows, "model string, params map<string,string>").coalesce(1).write.mode("overwrite").json(path)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("model string, params map<string,string>").json(path)
