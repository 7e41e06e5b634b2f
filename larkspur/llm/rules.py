"""Quality rules: counts per document, and how far its characters and words are from its language's.

Two histograms of a document, its character classes and its common words, are compared with those of all
documents of its language by the Jensen-Shannon distance (base 2, 0 to 1). The references are learned from the
table: one aggregate by (language, word), of which the most frequent words stay, and one by language over class
counts. A histogram of few entries is far from any reference by chance, so short documents and languages with
little text are not judged by distance.

Everything is column functions: a document's words, windows and histograms are arrays of its own row, so the
documents are not shuffled, and a repeated word or a hot source is added up before the one shuffle of words.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.session import settle

SYMBOLS = "[#*$%&|<>]"
# character classes in the order in which they are taken off a text; what is left at the end is the last class
CLASSES = [r"\p{Ll}+", r"[\x20\x09-\x0D]+", r"\p{Lu}+", r"[.,;:!?'\"()-]+", r"\p{N}+"]
COMMON = 16  # words of a language's histogram
MIN_WORDS = 50  # of a document that is judged by distance
MIN_REFERENCE = 1000  # words of a language whose documents are
CHAR_LIMIT = 0.25
WORD_LIMIT = 0.36
BROADCAST_BYTES = 16 << 20


def split_words(text: Column) -> Column:
    """The stretches without ASCII white space."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def class_counts(text: Column) -> tuple[Column, Column]:
    """Code points of each class, and of none, as an array; and the characters of none."""
    out, rest = [], text
    for pattern in CLASSES:
        less = F.regexp_replace(rest, pattern, "")
        out.append(F.length(rest) - F.length(less))
        rest = less
    return F.array(*out, F.length(rest)).cast("array<bigint>"), rest


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda a, b: (term(a, b) + term(b, a)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.when(total < 0, 0.0).otherwise(total))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1)))


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", common: int = COMMON) -> DataFrame:
    """(lang, words, word_shares, class_shares, ref_words): one row for each language, null being one.

    `words` are its most frequent words (ties by word), `word_shares` their shares of all its
    words and, last, the share of the rest; `ref_words` counts them all.
    """
    src = docs.select(docs[lang_col].alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    counts = src.select("lang", F.explode(split_words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    # how many words occur n times: a table so small that it can be sorted, which gives the least count worth ranking
    sizes = counts.groupBy(F.col("lang").alias("l"), "n").agg(F.count("*").alias("m"))
    sizes = sizes.withColumn("above", F.sum("m").over(Window.partitionBy("l").orderBy(F.desc("n"))))
    least = sizes.groupBy("l").agg(F.sum(F.col("n") * F.col("m")).alias("ref_words"), F.max(F.when(F.col("above") >= common, F.col("n"))).alias("least"))
    first = counts.join(least, F.col("lang").eqNullSafe(F.col("l")) & (F.col("n") >= F.coalesce("least", F.lit(1))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    first = first.withColumn("rank", rank).where(F.col("rank") <= common)
    words = first.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"), F.max("ref_words").alias("ref_words"))
    in_top = F.aggregate("top.n", F.lit(0).cast("bigint"), lambda s, x: s + x)
    lack = F.lit(common) - F.size("top")  # a language of few words: the empty word, which no text holds, fills up
    words = words.select(
        "lang", "ref_words", F.concat("top.word", F.array_repeat(F.lit(""), lack)).alias("words"),
        F.transform(F.concat("top.n", F.array_repeat(F.lit(0).cast("bigint"), lack), F.array(F.col("ref_words") - in_top)), lambda n: n / F.col("ref_words")).alias("word_shares"),
    )
    k = range(len(CLASSES) + 1)
    sums = src.select(F.col("lang").alias("class_lang"), class_counts(F.col("text"))[0].alias("c"))
    sums = sums.groupBy("class_lang").agg(*[F.sum(F.col("c")[i]).alias(f"c{i}") for i in k])
    classes = sums.select("class_lang", shares(F.array(*[F.col(f"c{i}") for i in k])).alias("class_shares"))
    return words.join(classes, F.col("lang").eqNullSafe(F.col("class_lang"))).drop("class_lang")


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. `hashes` has one of each window: texts whose hashes
    all differ, which are most, have no such window, and only the others' are sorted; windows of one hash are
    compared word by word."""
    n = F.size(hashes)
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    alike = lambda a, b: functools.reduce(lambda x, y: x & y, [F.get(words, a["i"] + d) == F.get(words, b["i"] + d) for d in range(3)])
    cover = lambda a, b: F.array(*[x["i"] + d for x in (a, b) for d in range(3)])
    pair = lambda a, b: F.when((a["h"] == b["h"]) & alike(a, b), cover(a, b))
    # sorted once, under a name for the two places that read it
    hits = F.transform(F.array(placed), lambda p: F.filter(F.zip_with(F.slice(p, 1, n - 1), F.slice(p, 2, n - 1), pair), lambda x: x.isNotNull()))
    return F.when(F.size(F.array_distinct(hashes)) < n, F.size(F.array_distinct(F.flatten(F.flatten(hits))))).otherwise(0).cast("bigint")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without its text (a string column without nulls) but with words, hashes of the 3-word windows, n_words,
    word_chars, n_symbols, n_dup_lines and class counts."""
    classes, rest = class_counts(F.col(text))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    keep = [c for c in docs.columns if c != text]
    out = docs.select(*keep, split_words(F.col(text)).alias("words"), classes.alias("classes"), rest.alias("rest"), F.length(text).alias("n_chars"), lines.alias("lines"))
    whole = F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))
    return out.select(
        *keep, "words", "classes", F.size("words").cast("bigint").alias("n_words"),
        (F.col("n_chars") - F.col("classes")[1]).cast("bigint").alias("word_chars"),
        # symbols belong to no class, so what is left of the text holds them all
        (F.length("rest") - F.length(F.regexp_replace("rest", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(whole, lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))).alias("hashes"),
    )


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_words: int = MIN_WORDS, max_repeat: int = 50,
    char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, common: int = COMMON, min_reference: int = MIN_REFERENCE,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance, word_distance)
    for every row of `docs`.

    Whole texts are read, null as empty. base_failed: fewer than `min_words` words, or more than `max_repeat` of a
    hundred in repeated 3-word windows. Other documents are kept unless a distance to their language's reference
    passes its limit; where the language has under `min_reference` words in the table, they are kept. Distances
    are rounded to six digits, and null for a document of under `min_words` words or without a reference. A null
    language is a language of its own. Repeated rows are judged alike and count in the references as often as
    they occur; null ids are kept; other columns are not read; an empty table gives an empty result.
    """
    src = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].cast("string").alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    ref = settle(references(src, common=common).where(F.col("ref_words") >= min_reference).withColumnRenamed("lang", "ref_lang").withColumnRenamed("words", "ref"))
    held = ref.agg(F.sum(F.octet_length(F.array_join("ref", "")) + 16 * F.size("ref") + 200).alias("n")).first()["n"] or 0
    joined = src.join(F.broadcast(ref) if held <= BROADCAST_BYTES else ref, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    found = measures(joined.drop("lang", "ref_lang", "ref_words"))
    # the words that are left when a common one is taken away tell how often it occurs
    counts = [(F.size("words") - F.size(F.array_remove("words", F.get("ref", F.lit(k))))).cast("bigint") for k in range(common)]
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    found = found.select(*base, "classes", "word_shares", "class_shares", repeated_words(F.col("words"), F.col("hashes")).alias("n_repeat_words"), F.array(*counts).alias("counts"))
    held_words = F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x)
    found = found.withColumn("counts", F.concat("counts", F.array(F.col("n_words") - held_words)))
    distance = lambda c, ref: F.when(F.col("n_words") >= min_words, F.round(js_distance(shares(F.col(c)), F.col(ref)), 6))
    found = found.select(*base, "n_repeat_words", distance("classes", "class_shares").alias("char_distance"), distance("counts", "word_shares").alias("word_distance"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    far = functools.reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > limit, F.lit(False)) for c, limit in (("char_distance", char_limit), ("word_distance", word_limit))])
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"),
        "char_distance", "word_distance",
    )


def oracle() -> str:
    """The same over `documents` in DuckDB, for distinct ids."""
    split = r"[x for x in regexp_split_to_array({}, '[\x20\x09-\x0D]+') if x <> '']"
    taken, rest = [], "text"
    for i, pattern in enumerate(CLASSES):
        less = f"regexp_replace({rest}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')"
        taken.append((f"c{i}", rest, less))
        rest = less
    columns = ", ".join(f"(length({a}) - length({b}))::BIGINT AS {c}" for c, a, b in taken) + f", length({rest})::BIGINT AS c{len(CLASSES)}"
    names = [f"c{i}" for i in range(len(CLASSES) + 1)]
    term = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
    js = lambda a, b: f"({term(a, b)} + {term(b, a)}) / 2"
    return f"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
    t AS (SELECT *, {split.format('text')} AS words, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines, {columns} FROM d),
    u AS (SELECT doc_id, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM t),
    g AS (SELECT doc_id, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    r AS (SELECT doc_id, i FROM g WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1),
    base AS (SELECT doc_id, lang, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', ''))::BIGINT AS chars,
        (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, {', '.join(names)} FROM t LEFT JOIN rep USING (doc_id)),
    c AS (SELECT lang, w, count(*) AS n FROM u GROUP BY ALL),
    total AS (SELECT lang AS l, sum(n) AS n_ref FROM c GROUP BY ALL HAVING sum(n) >= {MIN_REFERENCE}),
    top AS (SELECT lang, w, n / n_ref AS q FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) <= {COMMON}) JOIN total ON lang IS NOT DISTINCT FROM l),
    own AS (SELECT doc_id, w, count(*) AS n FROM u GROUP BY ALL),
    p AS (SELECT b.doc_id, b.n_words, top.q, coalesce(own.n, 0) / b.n_words AS p FROM base b JOIN top ON b.lang IS NOT DISTINCT FROM top.lang LEFT JOIN own ON own.doc_id = b.doc_id AND own.w = top.w WHERE n_words >= {MIN_WORDS}),
    p2 AS (SELECT doc_id, p, q FROM p UNION ALL SELECT doc_id, 1 - sum(p), 1 - sum(q) FROM p GROUP BY 1),
    wd AS (SELECT doc_id, round(sqrt(greatest(sum({js('p', 'q')}), 0)), 6) AS word_distance FROM p2 GROUP BY 1),
    s AS (SELECT lang, {', '.join(f'sum({x}) / sum({" + ".join(names)}) AS q{x}' for x in names)} FROM t GROUP BY 1),
    cs AS (SELECT doc_id, {', '.join(f'{x} / ({" + ".join(names)}) AS p{x}' for x in names)}, s.* EXCLUDE (lang) FROM base b JOIN s ON b.lang IS NOT DISTINCT FROM s.lang JOIN total ON b.lang IS NOT DISTINCT FROM l WHERE n_words >= {MIN_WORDS}),
    cd AS (SELECT doc_id, round(sqrt(greatest({' + '.join(js(f'p{x}', f'q{x}') for x in names)}, 0)), 6) AS char_distance FROM cs),
    f AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS failed FROM base LEFT JOIN wd USING (doc_id) LEFT JOIN cd USING (doc_id))
    SELECT doc_id, n_words, coalesce(chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
        NOT failed AND NOT coalesce(char_distance > {CHAR_LIMIT}, false) AND NOT coalesce(word_distance > {WORD_LIMIT}, false) AS kept, char_distance, word_distance FROM f"""
