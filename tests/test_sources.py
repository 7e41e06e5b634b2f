"""Mail trees and archives, saved models, streaming."""

import zipfile

import pandas as pd
from pyspark.sql import functions as F

from larkspur.models import linear
from larkspur.session import scratch_path
from larkspur.sources import mail, tables
from larkspur.streaming import scoring

PLAIN = b"From: Ann <ann@x.example.org>\nTo: b@y.example.org\nSubject: hi\n\nHello there\n"
QUOTED = b"From: spam@z.example.com\nContent-Type: text/html\nContent-Transfer-Encoding: quoted-printable\n\n<b>caf=C3=A9</b>=\n now\n"
MULTI = b"From: nobody\nContent-Type: multipart/alternative; boundary=q\n\n--q\nContent-Type: text/plain\n\none\n--q\nContent-Type: text/html\n\n<i>two</i>\n--q--\n"
EMPTY = b"From: a@b.c\nSubject: none\n\n\n"
FILES = {"easy_ham/1": PLAIN, "spam/2": QUOTED, "spam_2/3": MULTI, "easy_ham/4": EMPTY}
WANT = {
    "1": (0, "x.example.org", ["text/plain"], "Hello there"),
    "2": (1, "z.example.com", ["text/html"], "<b>café</b> now"),
    "3": (1, "unknown", ["text/plain", "text/html"], "one <i>two</i>"),
}


def rows(df):
    return {r["path"].rsplit("/", 1)[1]: (r["label"], r["sender_domain"], r["content_types"], r["text"]) for r in df.collect()}


def test_mail_tree(spark, tmp_path):
    for name, raw in FILES.items():
        p = tmp_path / "corpus" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(raw)
    assert rows(mail.read_mail(spark, str(tmp_path / "corpus"))) == WANT


def test_mail_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        for name, raw in FILES.items():
            z.writestr(f"Messages/{name}", raw)
    assert rows(mail.read_mail_zip(spark, str(tmp_path / "*.zip"))) == WANT


def test_labelled_text_in_latin1(spark, tmp_path):
    (tmp_path / "spam.csv").write_bytes("v1,v2,x\nham,\"café, now\",\nspam,win £5,\n".encode("latin-1"))
    got = {tuple(r) for r in tables.read_labelled_text(spark, str(tmp_path / "spam.csv")).collect()}
    assert got == {(0, "café, now"), (1, "win £5")}


def test_null_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,?\n?,None\n3,x\n")
    got = [tuple(r) for r in tables.read_table(spark, str(tmp_path / "t.csv"), "a int, b string", ["?", "None"]).collect()]
    assert got == [(1, None), (None, None), (3, "x")]


def test_saved_model_and_stream_give_the_batch_rows(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "value", (F.col("value") > 50).cast("double").alias("label"))
    model = linear.fit_logistic(e, ["value"], "label", C=1.0)
    path, arrived, out, state = (scratch_path(spark, n) for n in ("model", "in", "out", "state"))
    tables.save_model(model, path)
    again = tables.load_model(path)
    batch = model.transform(e).select("event_id", "prediction")
    assert again.transform(e).select("event_id", "prediction").exceptAll(batch).isEmpty()

    def run():
        scoring.score_stream(spark, arrived, e.drop("label").schema, again, out, state, ["event_id"], files_per_trigger=1).awaitTermination()

    first, rest = e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")
    first.drop("label").write.parquet(arrived)
    run()
    rest.drop("label").write.mode("append").parquet(arrived)
    run()
    got = spark.read.parquet(out)
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_params_round_trip(spark):
    path = scratch_path(spark, "params")
    tables.write_params(spark, {"boosted": {"rounds": 200, "rate": 0.1}}, path)
    r = tables.read_params(spark, path).first()
    assert r["model"] == "boosted" and r["params"] == {"rounds": "200", "rate": "0.1"}


def test_corrections(spark):
    train = spark.createDataFrame([(1, 0), (2, 0)], "k int, y int")
    fixes = spark.createDataFrame([(2, 1, 5), (2, 0, 9), (3, 1, 1)], "k int, y int, t int")
    assert {tuple(r) for r in scoring.merge_corrections(train, fixes, "k", "y", "t").collect()} == {(1, 0), (2, 0), (3, 1)}


def test_messages_are_parsed_in_lots(monkeypatch):
    monkeypatch.setattr(mail, "LOT_BYTES", 3 * len(PLAIN))
    lots = list(mail._parsed((f"ham/{i}", PLAIN) for i in range(7)))
    assert [len(t) for t in lots] == [3, 3, 1]
    assert [p for t in lots for p in t["path"]] == [f"ham/{i}" for i in range(7)]


def test_a_mail_tree_has_no_task_for_every_few_files(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i}").write_bytes(PLAIN)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        found = mail.read_mail(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert found.count() == 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_path_that_comes_twice_holds_its_last_message(tmp_path):
    from larkspur.plans.sources import _store

    paths = [f"/mail/{i % 50}" for i in range(200)]
    batch = pd.DataFrame({"path": paths, "content": [bytes([i]) * (400 - i) for i in range(200)]})
    assert [int(t["n"][0]) for t in _store(f"file://{tmp_path}", False)(iter([batch]))] == [200]
    for i in range(50):
        assert (tmp_path / "mail" / str(i)).read_bytes() == bytes([150 + i]) * (250 - i)
