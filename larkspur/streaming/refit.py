"""A naive Bayes model that follows labels corrected by an arriving stream.

The stream keeps for each corrected key the label held and its event time, and writes a change whenever a later
correction replaces it. The model is a table of sufficient statistics (term, class, n), with the documents of
each class under a null term. A change takes the document's terms from one class and adds them to the other, so a
refit sums over the changed documents only and equals a fit on the merged labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from larkspur.models.bayes import NaiveBayes, multinomial_from_counts

BUCKETS = 4096  # parts of a stream's state; a checkpoint can't go on with another number


def label_changes(stream: DataFrame, key: str, label: str, at: str, delay: str = "1 day") -> DataFrame:
    """(key, was, label, first): a row whenever corrections of a later event time replace the label held for a key.

    Corrections may come in any order; of equal times the larger label holds. One that is older than the watermark
    (`delay` behind the latest event time seen in earlier batches) is dropped. `first` marks a key's first change,
    whose `was` is null, as the training table holds it. Rows with a null key, label or time are no corrections.

    State lies in BUCKETS parts by the keys' hash, each with the label and time held for every key of the part, so
    that a batch calls Python once for a part and not once for a key.
    """
    rows = stream.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(at).cast("timestamp").alias("at"))
    rows = rows.where(F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("at").isNotNull())
    rows = rows.withWatermark("at", delay).withColumn("us", F.unix_micros("at")).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
    name, kind = rows.schema["key"].dataType, rows.schema["label"].dataType
    held = T.StructType().add("keys", T.ArrayType(name)).add("labels", T.ArrayType(kind)).add("us", T.ArrayType(T.LongType()))
    out = T.StructType().add("key", name).add("was", kind).add("label", kind).add("first", T.BooleanType())

    def newest(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, labels, times = state.get if state.exists else ((), (), ())
        old = dict(zip(keys, zip(times, labels)))
        new = {}
        for part in parts:
            for k, us, y in zip(part["key"].tolist(), part["us"].tolist(), part["label"].tolist()):
                now = new.get(k) or old.get(k)
                if now is None or (us, y) > now:
                    new[k] = (us, y)
        if new:
            both = {**old, **new}
            state.update((list(both), [y for _, y in both.values()], [us for us, _ in both.values()]))
            was = [old[k][1] if k in old else None for k in new]
            yield pd.DataFrame({"key": list(new), "was": pd.Series(was, dtype=object), "label": [y for _, y in new.values()], "first": [k not in old for k in new]})

    # no timeout is ever set: the event-time form is what makes Spark drop late rows
    return rows.groupBy("bucket").applyInPandasWithState(newest, out, held, "append", GroupStateTimeout.EventTimeTimeout)


def follow_corrections(
    spark: SparkSession, in_path: str, schema, out_path: str, checkpoint: str, key: str, label: str, at: str, delay: str = "1 day", files_per_trigger: int = 1000
) -> StreamingQuery:
    """Append the changes of every correction file that arrives under `in_path` to `out_path`, each once; runs until
    the files present are done. State and progress are in `checkpoint`, so a restart goes on where it stopped."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(in_path)
    writer = label_changes(rows, key, label, at, delay).writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_path)


def statistics(terms: DataFrame, signed: DataFrame, key: str, weight: str = "tf") -> DataFrame:
    """(term, class, n) of (key, term, weight) and (key, class, sign); null terms hold the classes' documents."""
    words = terms.join(signed, key).select("term", "class", (F.col(weight) * F.col("sign")).alias("n"))
    docs = signed.select(F.lit(None).cast("string").alias("term"), "class", F.col("sign").cast(words.schema["n"].dataType).alias("n"))
    return words.unionByName(docs).groupBy("term", "class").agg(F.sum("n").alias("n")).where("n != 0")


def labelled(train: DataFrame, key: str, label: str) -> DataFrame:
    """(key, class, sign) that adds every labelled row."""
    return train.where(F.col(label).isNotNull()).select(key, F.col(label).alias("class"), F.lit(1).alias("sign"))


def moved(changes: DataFrame, train: DataFrame, key: str, label: str) -> DataFrame:
    """(key, class, sign) of all changes: -1 for the label that the training table holds, 1 for the last correction,
    nothing where these are equal. `train` has a row per key at most; keys that it lacks are added."""
    base = train.select(F.col(key).alias("key"), F.col(label).alias("_base"))
    was = F.when(F.col("first"), F.col("_base")).otherwise(F.col("was"))
    both = F.array(F.struct(was.alias("class"), F.lit(-1).alias("sign")), F.struct(F.col("label").alias("class"), F.lit(1).alias("sign")))
    steps = changes.join(base, "key", "left").select(F.col("key").alias(key), F.inline(both)).where("class is not null")
    return steps.groupBy(key, "class").agg(F.sum("sign").cast("int").alias("sign")).where("sign != 0")


def refit(stats: DataFrame, terms: DataFrame, change: DataFrame, key: str, weight: str = "tf") -> DataFrame:
    """The statistics after `change` (from `moved`); unchanged documents enter no sum."""
    both = stats.unionByName(statistics(terms, change, key, weight))
    return both.groupBy("term", "class").agg(F.sum("n").alias("n")).where("n != 0")


def model(stats: DataFrame, alpha: float = 1.0) -> NaiveBayes:
    """The multinomial model of the statistics."""
    sizes = sorted((r["class"], r["n"]) for r in stats.where("term is null").collect())  # a row a class
    return multinomial_from_counts(stats.where("term is not null"), [k for k, _ in sizes], [n for _, n in sizes], alpha)
