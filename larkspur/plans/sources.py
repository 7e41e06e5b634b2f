"""Source, sink and streaming queries. Files are written by Spark from the given tables."""

import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import functions as F

from larkspur.functions.text_cols import collapse
from larkspur.models import linear
from larkspur.operators import split, text
from larkspur.plans.registry import load, query
from larkspur.plans.text import CLEAN, TERMS
from larkspur.session import scratch_path, settle, spread
from larkspur.sources import mail, tables
from larkspur.streaming import refit, scoring


@query("src1_read_table", "SELECT p_partkey, p_name, nullif(nullif(p_type, 'PROMO'), 'SMALL') AS p_type, p_size, p_retailprice FROM part")
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    path = scratch_path(spark, "src1")
    tables.write_table(t, path, "csv")
    return tables.read_table(spark, path, t.schema, ["PROMO", "SMALL"])


@query("src2_read_labelled_text", "SELECT CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 0 END AS label, p_name || ' é' AS text FROM part")
def _(spark, sf):
    t = load(spark, sf, "part").select(F.col("p_type").alias("v1"), F.concat("p_name", F.lit(" é")).alias("v2"), "p_size")
    path = scratch_path(spark, "src2")
    t.write.option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    return tables.read_labelled_text(spark, path, labels={"PROMO": 1, "SMALL": 0})


@query(
    "src7_split_stacked_lookup",
    "SELECT 'region' AS section, r_regionkey::BIGINT AS id, r_name AS description FROM region UNION ALL SELECT 'nation', n_nationkey::BIGINT, n_name FROM nation",
)
def _(spark, sf):
    region = load(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("key"), F.concat(F.lit(" "), "r_name").alias("description"), F.col("r_regionkey").alias("line"))
    nation = load(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("description"), (F.col("n_nationkey") + 1000).alias("line"))
    # the blank row and the header row between the two tables come from the region rows too
    breaks = region.where("line < 2").select(F.when(F.col("line") == 1, "nation").alias("key"), F.lit("description").alias("description"), (F.col("line") + 500).alias("line"))
    parts = tables.split_stacked_lookup(region.union(breaks).union(nation), "key", "description", "line", "region")
    out = None
    for name, part in sorted(parts.items()):
        part = part.withColumn("section", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


MESSAGE = [
    "From: \"Src\" <a.b@{src}.example.org>\nTo: list@example.com\nSubject: note {id}\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=\"cut\"\n\n--cut\nContent-Type: text/plain; charset=utf-8\n\n",
    "\n--cut\nContent-Type: text/html\n\n<p>n=3D{id}</p>\n--cut\nContent-Type: image/png\n\nxyz\n--cut--\n",
]


def messages(spark, sf):
    """One raw multipart message per document."""
    d = spread(load(spark, sf, "documents"), "doc_id").select("doc_id", "source", collapse("text").alias("text"))

    def fill(s):
        return F.replace(F.replace(F.lit(s), F.lit("{src}"), F.col("source")), F.lit("{id}"), F.col("doc_id").cast("string"))

    raw = F.concat(fill(MESSAGE[0]), "text", fill(MESSAGE[1]))
    folder = F.when(F.col("doc_id") % 3 == 0, "spam_2").otherwise("easy_ham")
    return d.select(F.concat(F.lit("/mail/"), folder, F.lit("/"), "doc_id").alias("path"), F.encode(raw, "UTF-8").alias("content"))


MAIL_SQL = r"""SELECT CASE WHEN doc_id % 3 = 0 THEN 'spam_2' ELSE 'easy_ham' END || '/' || doc_id AS path, CAST(doc_id % 3 = 0 AS INT) AS label, 'note ' || doc_id AS subject,
   source || '.example.org' AS sender_domain, 'text/plain,text/html,image/png' AS content_types, md5(trim(regexp_replace(text, '\s+', ' ', 'g')) || ' <p>n=3D' || doc_id || '</p>') AS text FROM documents"""


def _mail_rows(m):
    return m.select(
        F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("path"),
        "label",
        "subject",
        "sender_domain",
        F.array_join("content_types", ",").alias("content_types"),
        F.md5(collapse("text")).alias("text"),
    )


@query("txt1_parse_mail", MAIL_SQL)
def _(spark, sf):
    return _mail_rows(mail.with_mail_columns(mail.parse_mail(messages(spark, sf))))


def _store(root, zipped):
    """Task-side writer of messages: one file each, or one archive per batch."""

    def run(batches):
        for b in batches:
            system, base = fs.FileSystem.from_uri(root)
            if zipped:
                system.create_dir(base, recursive=True)
                with system.open_output_stream(f"{base}/{uuid.uuid4().hex}.zip") as f, zipfile.ZipFile(f, "w") as z:
                    for path, raw in zip(b["path"], b["content"]):
                        z.writestr(path.lstrip("/"), bytes(raw))
            else:
                for folder in {p.rsplit("/", 1)[0] for p in b["path"]}:
                    system.create_dir(base + folder, recursive=True)

                def write(path, raw):
                    with system.open_output_stream(base + path) as f:
                        f.write(bytes(raw))

                with ThreadPoolExecutor(8) as pool:  # a small file is mostly waiting for the store
                    last = dict(zip(b["path"], b["content"]))  # of one path the last message holds
                    list(pool.map(write, last.keys(), last.values()))
            yield pd.DataFrame({"n": [len(b)]})

    return run


@query("src3_read_mail", MAIL_SQL)
def _(spark, sf):
    root = scratch_path(spark, "src3")
    messages(spark, sf).mapInPandas(_store(root, False), "n bigint").agg(F.sum("n")).collect()
    return _mail_rows(mail.read_mail(spark, root))


@query("src4_read_mail_zip", MAIL_SQL)
def _(spark, sf):
    root = scratch_path(spark, "src4")
    # a task that runs twice may leave a second archive of the same messages, hence the distinct
    messages(spark, sf).mapInPandas(_store(root, True), "n bigint").agg(F.sum("n")).collect()
    return _mail_rows(mail.read_mail_zip(spark, f"{root}/*.zip")).distinct()


@query(
    "snk1_write_table",
    "SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, CAST(sum(c_nationkey) AS BIGINT) AS nations FROM customer GROUP BY 1",
)
def _(spark, sf):
    path = scratch_path(spark, "snk1")
    tables.write_table(load(spark, sf, "customer"), path, partition_by=["c_mktsegment"])
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_nationkey").alias("nations"))


EVENT_FEATURES = ["value", "hour"]


def _event_model(spark, sf):
    e = load(spark, sf, "events").select("event_id", "value", F.hour("ts").cast("double").alias("hour"), (F.col("event_type") == "purchase").cast("double").alias("label"))
    return e, linear.fit_logistic(e, EVENT_FEATURES, "label", C=1.0)


@query("snk2_save_load_model")
def _(spark, sf):
    e, model = _event_model(spark, sf)
    path = scratch_path(spark, "snk2")
    tables.save_model(model, path)
    again = tables.load_model(path).transform(e).select("event_id", F.col("prediction").alias("again"))
    both = model.transform(e).select("event_id", "prediction").join(again, "event_id")
    return both.groupBy("prediction").agg(F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("again")).alias("same"))


@query("snk3_write_params", "SELECT 'tree' AS model, CAST(min(p_size) AS VARCHAR) AS lo, CAST(max(p_size) AS VARCHAR) AS hi FROM part")
def _(spark, sf):
    lo, hi = load(spark, sf, "part").agg(F.min("p_size"), F.max("p_size")).first()
    path = scratch_path(spark, "snk3")
    tables.write_params(spark, {"tree": {"lo": lo, "hi": hi}}, path)
    return tables.read_params(spark, path).select("model", F.col("params")["lo"].alias("lo"), F.col("params")["hi"].alias("hi"))


@query("str1_score_stream")
def _(spark, sf):
    e, model = _event_model(spark, sf)
    arrived, out = scratch_path(spark, "str1-in"), scratch_path(spark, "str1-out")
    tables.write_table(e.drop("label"), arrived)
    run = scoring.score_stream(spark, arrived, e.drop("label").schema, model, out, scratch_path(spark, "str1-state"), ["event_id"])
    run.awaitTermination()
    return spark.read.parquet(out)


@query(
    "str2_merge_corrections",
    """WITH c AS (SELECT doc_id, seen, CAST((doc_id + seen) % 2 AS INT) AS toxic FROM documents, (SELECT unnest([1, 2, 3])::INT AS seen) WHERE (doc_id % 3 + 1) >= seen),
       l AS (SELECT doc_id, arg_max(toxic, seen) AS new FROM c GROUP BY 1)
       SELECT doc_id, coalesce(new, toxic) AS toxic FROM labels FULL JOIN l USING (doc_id)""",
)
def _(spark, sf):
    seen = F.explode(F.sequence(F.lit(1), (F.col("doc_id") % 3 + 1).cast("int"))).alias("seen")
    c = load(spark, sf, "documents").select("doc_id", seen)
    c = c.select("doc_id", "seen", ((F.col("doc_id") + F.col("seen")) % 2).cast("int").alias("toxic"))
    return scoring.merge_corrections(load(spark, sf, "labels"), c, "doc_id", "toxic", "seen")


@query(
    "str2_refit_stream",
    f"""WITH c AS (SELECT doc_id, seen, CAST((doc_id + seen) % 2 AS INT) AS toxic FROM documents, (SELECT unnest([1, 2, 3])::INT AS seen) WHERE (doc_id % 3 + 1) >= seen),
       l AS (SELECT doc_id, arg_max(toxic, seen) AS new FROM c GROUP BY 1),
       f AS (SELECT doc_id, coalesce(new, toxic) AS class FROM labels FULL JOIN l USING (doc_id)),
       d AS (SELECT doc_id, {CLEAN} AS tokens FROM documents), {TERMS},
       ws AS (SELECT term, class, sum(tf) AS n FROM tc JOIN f USING (doc_id) GROUP BY 1, 2),
       cells AS (SELECT term, class FROM (SELECT DISTINCT term FROM ws), (SELECT unnest([0, 1])::INT AS class))
       SELECT term, class, CAST(coalesce(n, 0) AS BIGINT) AS total,
              round(ln((coalesce(n, 0) + 0.1) / (sum(coalesce(n, 0)) OVER (PARTITION BY class) + 0.1 * (SELECT count(DISTINCT term) FROM ws))), 9) AS log_prob
       FROM cells LEFT JOIN ws USING (term, class)""",
)
def _(spark, sf):
    """Every document is corrected one to three times, by files that arrive in the order of a hash."""
    docs, train = load(spark, sf, "documents"), load(spark, sf, "labels").select("doc_id", "toxic")
    seen = F.explode(F.sequence(F.lit(1), (F.col("doc_id") % 3 + 1).cast("int"))).alias("seen")
    c = docs.select("doc_id", seen)
    at = F.timestamp_seconds(F.col("seen") * 3600).alias("at")
    c = c.select("doc_id", ((F.col("doc_id") + F.col("seen")) % 2).cast("int").alias("toxic"), at)
    arrived, out = scratch_path(spark, "str2-in"), scratch_path(spark, "str2-out")
    tables.write_table(c.repartition(4, F.xxhash64("doc_id", "at")), arrived)
    run = refit.follow_corrections(spark, arrived, c.schema, out, scratch_path(spark, "str2-state"), "doc_id", "toxic", "at", "30 days", files_per_trigger=2)
    run.awaitTermination()
    # kept as the shuffle by doc_id left them, so that neither join moves the terms again; a checkpoint forgets that
    terms = text.term_counts(spread(docs, "doc_id").select("doc_id", text.clean_tokens("text").alias("tokens")), "doc_id", "tokens").persist(StorageLevel.DISK_ONLY)
    before = refit.statistics(terms, refit.labelled(train, "doc_id", "toxic"), "doc_id")
    after = refit.refit(before, terms, refit.moved(spark.read.parquet(out), train, "doc_id", "toxic"), "doc_id")
    after = settle(after)
    terms.unpersist()
    return refit.model(after, alpha=0.1).table.withColumn("log_prob", F.round("log_prob", 9))
