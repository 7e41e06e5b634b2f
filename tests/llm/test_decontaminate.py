import hashlib

from larkspur.llm import decontaminate
from larkspur.llm.queries import QUERIES
from tests.llm import brute


def got(df):
    return {r["doc_id"]: (r["n_words"], sum(s["to"] - s["from"] for s in r["spans"]), r["items"]) for r in df.collect()}


def test_whole_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.contamination(docs, items)
    rows = {r["doc_id"]: r for r in QUERIES["op10_decontaminate"](spark, sf).collect()}
    assert rows.keys() == want.keys()
    for d, (n, hit, own) in want.items():
        r = rows[d]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(own), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()
    assert any(hit for _, hit, _ in want.values())


ITEMS = [(1, "A b c d e f g h i j k"), (2, "short one"), (3, None), (4, "..."), (5, "x"), (10, "a b c d e f g h i j"), (6, "short one")]
DOCS = [
    (1, "zz a, B c d e f g h i j k zz"), (2, None), (3, ""), (4, "short. ONE! x short one"), (5, "a b c d e f g h i"),
    (6, "é shorté one"), (7, ("a b c d e f g h i j " * 3000).strip()), (8, "a a b c d e f g h i j a b c d e f g h i j k"),
]


def frames(spark, docs=DOCS, items=ITEMS):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_odd_rows(spark):
    docs, items = frames(spark)
    want = brute.contamination(DOCS, ITEMS)
    clash = docs.withColumn("n_words", decontaminate.F.lit("a")).withColumn("key", decontaminate.F.lit("a"))
    assert got(decontaminate.contamination(clash, items)) == want
    assert got(decontaminate.contamination(docs, items.limit(0))) == {d: (n, 0, []) for d, (n, _, _) in want.items()}
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_more_passes_give_the_same(spark):
    docs, items = frames(spark, DOCS + [(8, "short one"), (None, "x")])
    one = sorted(map(str, decontaminate.contamination(docs, items).collect()))
    for size in (1, 15):
        assert sorted(map(str, decontaminate.contamination(docs, items, item_bytes=size).collect())) == one
