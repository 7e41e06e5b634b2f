import re

import corpus_pipeline as pipeline
from larkspur.llm import quality
from tests.llm import brute


def test_every_stage_against_plain_versions(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    now = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if name != "bpe":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
            got = {r["doc_id"]: r for r in docs.collect()}
        if name == "quality":
            want = {d: t for d, t in now.items() if model.score([t.encode()])[0] >= 0.7}
        elif name == "simhash":
            groups = brute.simhash(now.items())
            want = {d: t for d, t in now.items() if groups[d][1] == d}
        elif name == "repeats":
            want = {d: k.decode("utf-8", "ignore") for d, (k, _, _) in zip(now, brute.repeats(now.values(), pipeline.REPEAT_BYTES))}
            assert want != now and all(r["n_chars"] == len(r["text"]) for r in got.values())
        elif name == "decontaminate":
            hit = brute.contamination(now.items(), items)
            want = {d: t for d, t in now.items() if not hit[d][1]}
        else:
            assert {r["doc_id"]: r["decoded_sha256"] for r in docs.collect()} == {d: brute.sha(t.encode()) for d, t in now.items()}
            return
        assert {d: r["text"] for d, r in got.items()} == want
        now = want


def test_odd_rows(spark, sf, tmp_path):
    """Null ids and texts, repeated rows, an empty table."""
    text = "Some words that no one would mind, and others. " * 3
    rows = [(1, text, None, "s", 5), (1, text, None, "s", 5), (None, text, "en", None, None), (2, None, "en", "s", 0), (3, "", None, None, 0)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{sf}/documents.parquet").schema)
    for df in (docs, docs.limit(0)):
        for k, (name, stage) in enumerate(pipeline.STAGES):
            if name == "quality":
                continue  # judges these texts as it likes
            out = stage(spark, df, sf)
            if name == "simhash" and df is docs:
                assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "None"]
            out.collect()


def test_entry_lists_the_operators():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} <= set(range(1, 14))
