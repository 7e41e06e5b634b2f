import random

import public_tokenizers
from tokenizers import Tokenizer

from larkspur.llm import lengths
from larkspur.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def want(n):
    return {x: (n.count(x), x * n.count(x), sum(y >= x for y in n), sum(y for y in n if y >= x), sum(min(x, y) for y in n)) for x in set(n)}


def got(df):
    return {r["length"]: (r["n_docs"], r["n_tokens"], r["docs_from"], r["tokens_from"], r["truncated_tokens"]) for r in df.collect()}


def test_whole_table(spark, sf):
    t = Tokenizer.from_file(PATH)
    n = [len(t.encode(r["text"], add_special_tokens=False).ids) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op2_token_counts"](spark, sf)) == want(n)


def test_limits_and_quantiles(spark):
    rng = random.Random(2)
    n = [rng.choice([0, 1, 5, 1023, 1024, 1025, 70_000, 1 << 21, (1 << 21) + 1, rng.randrange(1 << 35)]) for _ in range(300)]
    hist = lengths.histogram(spark.createDataFrame([(x,) for x in n] + [(None,)], "length long"))
    sums = lengths.suffix_sums(hist)
    assert got(sums) == want(n)
    limits = [0, 1, 4, 1024, 69_999, 1 << 40]
    out = {r["context"]: (r["docs_over"], r["truncated_tokens"], r["total_tokens"]) for r in lengths.at_limits(sums, limits).collect()}
    assert out == {c: (sum(x > c for x in n), sum(min(x, c) for x in n), sum(n)) for c in limits}
    q = {r["prob"]: r["length"] for r in lengths.quantiles(sums, [0.01, 0.5, 0.9, 1.0]).collect()}
    assert q == {p: sorted(n)[-int(-p * 300 // 1) - 1] for p in (0.01, 0.5, 0.9, 1.0)}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b c"), (3, "long " * 40_000)], "doc_id long, text string").withColumn("length", lengths.F.lit("no"))
    out = sorted(r["length"] for r in lengths.token_lengths(docs, PATH).collect())
    assert out[:4] == [0, 0, 0, 3] and out[4] > 40_000
    assert got(lengths.suffix_sums(lengths.histogram(lengths.token_lengths(docs.limit(0), PATH)))) == {}
