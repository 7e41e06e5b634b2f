"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SPREAD_ROWS = 250_000


def get_session(app: str = "larkspur", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    On a cluster the master, memory and shuffle settings come from spark-submit;
    `master` and `partitions` are for local runs.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        b = b.master(master)
        if master.startswith("local"):  # one JVM does all the work; the default heap is 1 GB
            b = b.config("spark.driver.memory", "8g")
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    A machine-local folder is made only in local mode with the setting absent.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    known = os.environ.get("LARKSPUR_LOCAL_SCRATCH")
    if not known:
        known = tempfile.mkdtemp(prefix="larkspur-")
        os.environ["LARKSPUR_LOCAL_SCRATCH"] = known
    return known


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/larkspur-{name}-{uuid.uuid4().hex}"


def set_checkpoints(spark: SparkSession) -> None:
    """Let checkpoints go to the shared folder, if no folder is set; without one pyspark.ml's loops never cut their lineage."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(spark))


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so a lost executor does not replay the rounds before."""
    set_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of too few partitions over all cores before heavy per-row work (a small file in one
    row group is one task), with a partition for every SPREAD_ROWS at least, so that no task grows with the table. Does
    nothing to a table that already has that many."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))  # the count reads footers
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts, *keys)


def gather(df: DataFrame, rows: int) -> DataFrame:
    """Bring a table of `rows` rows that a loop reads again and again from a shuffle's partitions, which are as many
    however small it is, to two for every core, or one for every SPREAD_ROWS if these are more."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // SPREAD_ROWS)))
