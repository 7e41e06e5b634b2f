"""Term tables, TF-IDF, log-likelihood ratios, stems and made-up messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.functions import text_cols as tc
from larkspur.functions.words import STOP_WORDS
from larkspur.operators.ordered import hash_order

TASK_DOCS = 1_000  # texts whose terms one task counts


def clean_tokens(col: str | Column, digits: bool = True, words: Sequence[str] = STOP_WORDS) -> Column:
    """Normalize, split, drop stop words."""
    return tc.remove_stop_words(tc.tokenize(tc.normalize_text(col, digits)), words)


def explode_terms(df: DataFrame, keep: Sequence[str], tokens: str | Column) -> DataFrame:
    """One row per token. The outer form with a null check, as for the plain form the optimizer adds a
    "not empty" filter under the scan that works out the tokens a second time."""
    return df.select(*keep, F.explode_outer(tokens).alias("term")).where(F.col("term").isNotNull())


def preview_by_group(df: DataFrame, group: str, key: str, text: str, n: int = 15) -> DataFrame:
    """First row of each group by key, cut to its first n lines."""
    picked = df.groupBy(group).agg(F.min_by(F.struct(key, text), key).alias("r"))
    lines = F.array_join(F.slice(F.split(F.col(f"r.{text}"), "\n"), 1, n), "\n")
    return picked.select(group, F.col(f"r.{key}").alias(key), lines.alias("preview"))


def count_by_folder(df: DataFrame, path: str, pattern: str = r"([^/]+)/[^/]*$") -> DataFrame:
    return df.groupBy(F.regexp_extract(path, pattern, 1).alias("folder")).agg(F.count("*").alias("n"))


def most_common(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(n)


def term_counts(df: DataFrame, key: str, tokens: str | Column, ngrams: tuple[int, int] = (1, 1)) -> DataFrame:
    """(key, term, tf). Rows are spread by key once; counting, and later joins and sums by key, reuse that. There is
    a partition for every TASK_DOCS rows at least, so that no task's counts grow with the table. Tokens are what is
    spread; their runs, several times as long, are made where they are counted."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.select(key).count() // TASK_DOCS))  # the tokens aren't worked out for it
    src = df.select(F.col(key), F.col(tokens).alias("_t") if isinstance(tokens, str) else tokens.alias("_t")).repartition(parts, key)
    return explode_terms(src, [key], tc.ngrams("_t", *ngrams)).groupBy(key, "term").agg(F.count("*").alias("tf"))


def fit_vocabulary(
    terms: DataFrame, n_docs: Column | int, max_terms: int | None = None, min_df: int = 1, max_df: float = 1.0
) -> DataFrame:
    """(term, total, df, idf): terms by document frequency limits, the most frequent `max_terms` of
    them (ties by term), with idf = ln((1 + n) / (1 + df)) + 1."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    vocab = terms.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
    vocab = _in_limits(vocab, n, min_df, max_df)
    if max_terms:
        vocab = vocab.orderBy(F.desc("total"), "term").limit(max_terms)
    return vocab.withColumn("idf", _idf(n))


def _in_limits(terms: DataFrame, n: Column, min_df: int, max_df: float) -> DataFrame:
    return terms.where((F.col("df") >= min_df) & (F.col("df") <= n * max_df))


def _idf(n: Column) -> Column:
    return F.log((n + 1) / (F.col("df") + 1)) + 1


def apply_tfidf(terms: DataFrame, vocab: DataFrame, key: str, sublinear: bool = False, norm: bool = True) -> DataFrame:
    """(key, term, weight) with unit length per key. Spark picks the join by the vocabulary's size."""
    return _weigh(terms.join(vocab.select("term", "idf"), "term"), key, sublinear, norm)


def _weigh(terms: DataFrame, key: str, sublinear: bool, norm: bool = True) -> DataFrame:
    tf = F.log("tf") + 1 if sublinear else F.col("tf")
    long = terms.select(key, "term", (tf * F.col("idf")).alias("weight"))
    if not norm:
        return long
    # the terms of one key are at most one document
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return long.withColumn("weight", F.col("weight") / length)


def tfidf(
    df: DataFrame,
    key: str,
    tokens: str | Column,
    max_terms: int | None = None,
    ngrams: tuple[int, int] = (1, 1),
    sublinear: bool = False,
    min_df: int = 1,
    max_df: float = 1.0,
) -> DataFrame:
    """Fit on `df` and weigh `df`; for a train/test split call the two steps apart. Of runs of tokens most are rare, so
    a vocabulary is nearly as long as the terms: these are shuffled by term once, and counted and weighed where they meet."""
    terms = term_counts(df, key, tokens, ngrams)
    n = df.agg(F.count("*")).scalar()
    if ngrams[1] > 1 and not max_terms:
        # a term has a row for each document that holds it
        met = terms.withColumn("df", F.count("*").over(Window.partitionBy("term")))
        return _weigh(_in_limits(met, n, min_df, max_df).withColumn("idf", _idf(n)), key, sublinear)
    vocab = fit_vocabulary(terms, n, max_terms, min_df, max_df)
    return apply_tfidf(terms, vocab, key, sublinear)


def tfidf_vectors(train: DataFrame, tokens: str, max_terms: int = 5000, ngrams: int = 1, min_df: int = 1, max_df: float = 1.0):
    """The same weights as sparse vectors: a fitted ml Pipeline from a token column to `features`.
    The ml idf lacks the + 1, so the scaling vector adds it."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizer, ElementwiseProduct, IDF, NGram, Normalizer
    from pyspark.ml.linalg import DenseVector

    stages, cur, col = [], train, tokens
    if ngrams > 1:
        stages.append(NGram(n=ngrams, inputCol=col, outputCol="_ngrams"))
        cur, col = stages[-1].transform(cur), "_ngrams"
    # the ml stage reads 1.0 as a count of one document, so "no upper limit" is the largest count
    top = {} if max_df >= 1.0 else {"maxDF": max_df}
    counter = CountVectorizer(inputCol=col, outputCol="_tf", vocabSize=max_terms, minDF=float(min_df), **top).fit(cur)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counter.transform(cur)).idf.toArray() + 1.0
    scale = ElementwiseProduct(scalingVec=DenseVector(idf), inputCol="_tf", outputCol="_weighted")
    norm = Normalizer(p=2.0, inputCol="_weighted", outputCol="features")
    return PipelineModel([*stages, counter, scale, norm])


def word_llr(df: DataFrame, tokens: str | Column, label: str) -> DataFrame:
    """(term, hits, misses, llr): ln of the smoothed share of a word among the words of the positive
    class over that among the rest, by documents that hold it. The two totals are sums over the same
    counts, so their subquery reuses the counts' shuffle instead of reading the text again."""
    src = df.select(F.array_distinct(tokens).alias("_t"), F.col(label).cast("int").alias("_y"))
    counts = explode_terms(src, ["_y"], "_t").groupBy("term").agg(
        F.count_if(F.col("_y") == 1).alias("hits"), F.count_if(F.col("_y") == 0).alias("misses")
    )
    totals = counts.agg(F.struct(F.sum("hits").alias("s"), F.sum("misses").alias("h"))).scalar()
    pos = (F.col("hits") + 1) / (totals.getField("s") + 1)
    neg = (F.col("misses") + 1) / (totals.getField("h") + 1)
    return counts.withColumn("llr", F.log(pos / neg))


def top_words(df: DataFrame, tokens: str | Column, label: str, n: int = 100) -> DataFrame:
    """Most frequent words per class."""
    counts = explode_terms(df, [label], tokens).groupBy(label, "term").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("n"), "term"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def mean_tfidf(weights: DataFrame, docs: DataFrame, key: str, group: str) -> DataFrame:
    """Mean weight of each term over all documents of a group; a document without the term counts as 0."""
    sizes = docs.groupBy(group).agg(F.count("*").alias("_docs"))
    sums = weights.join(docs.select(key, group), key).groupBy(group, "term").agg(F.sum("weight").alias("_w"))
    return sums.join(sizes, group).select(group, "term", (F.col("_w") / F.col("_docs")).alias("mean_weight"))


def synthesize(df: DataFrame, key: str, templates: Sequence[str], slots: Mapping[str, Sequence[str] | tuple[int, int]], seed: int = 42, out: str = "message") -> DataFrame:
    """One message per key: template and slot values picked by hash. A slot takes one of a list of texts, or any whole
    number of a pair (least, greatest)."""

    def pick(values: Sequence, salt: str) -> Column:
        drawn = hash_order(key, f"{seed}{salt}")
        if isinstance(values, tuple):
            least, greatest = values
            return (F.lit(int(least)) + drawn % (greatest - least + 1)).cast("string")
        return F.element_at(F.array(*[F.lit(v) for v in values]), (drawn % len(values) + 1).cast("int"))

    text = pick(templates, "template")
    for name, values in slots.items():
        text = F.replace(text, F.lit("{" + name + "}"), pick(values, name))
    return df.withColumn(out, text)
