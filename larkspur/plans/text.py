"""Text queries."""

from pyspark.sql import functions as F

from larkspur.functions import text_cols as tc, words
from larkspur.functions.words import MAIL_STOP_WORDS, SPAM_PHRASES, STOP_WORDS, TRIGGER_WORDS
from larkspur.operators import stem, text
from larkspur.plans.registry import load, query
from larkspur.session import spread

STOPS = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"
NORM = r"regexp_replace(lower(trim(regexp_replace({0}, '\s+', ' ', 'g'))), '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
TOK = r"list_filter(string_split_regex({0}, '\s+'), lambda t: t <> '')"
CLEAN = f"list_filter({TOK.format(NORM.format('text'))}, lambda t: NOT list_contains({STOPS}, t))"
DOCS = f"d AS (SELECT doc_id, source, toxic, {CLEAN} AS tokens FROM documents JOIN labels USING (doc_id))"


def docs(spark, sf):
    return spread(load(spark, sf, "documents"), "doc_id")


def labelled_tokens(spark, sf):
    labelled = docs(spark, sf).select("doc_id", "source", "text").join(load(spark, sf, "labels"), "doc_id")
    return labelled.select("doc_id", "source", "toxic", text.clean_tokens("text").alias("tokens"))


@query(
    "txt17_word_llr",
    f"""WITH {DOCS}, w AS (SELECT toxic, unnest(list_distinct(tokens)) AS term FROM d),
       c AS (SELECT term, count(*) FILTER (toxic = 1) AS hits, count(*) FILTER (toxic = 0) AS misses FROM w GROUP BY 1),
       t AS (SELECT sum(hits) AS s, sum(misses) AS h FROM c)
       SELECT term, CAST(hits AS BIGINT) AS hits, CAST(misses AS BIGINT) AS misses, round(ln(((hits + 1) / (s + 1)) / ((misses + 1) / (h + 1))), 6) AS llr
       FROM c, t ORDER BY round(ln(((hits + 1) / (s + 1)) / ((misses + 1) / (h + 1))), 6) DESC, term LIMIT 20""",
)
def word_llr(spark, sf):
    scores = text.word_llr(labelled_tokens(spark, sf), "tokens", "toxic")
    return scores.withColumn("llr", F.round("llr", 6)).orderBy(F.desc("llr"), "term").limit(20)


@query(
    "src5_preview_by_group",
    r"""SELECT source, doc_id, array_to_string(string_split(text, chr(10))[1:15], chr(10)) AS preview
       FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY source)""",
)
def _(spark, sf):
    return text.preview_by_group(docs(spark, sf), "source", "doc_id", "text", 15)


@query(
    "src6_count_by_folder",
    "SELECT regexp_extract(url, '//([^/]+)/', 1) AS folder, CAST(count(*) AS BIGINT) AS n FROM pages GROUP BY 1",
)
def _(spark, sf):
    return text.count_by_folder(load(spark, sf, "pages"), "url", "//([^/]+)/")


@query(
    "txt2_split_body",
    "SELECT doc_id, md5(CASE WHEN instr(text, E'\\n\\n') > 0 THEN substr(text, instr(text, E'\\n\\n') + 2) ELSE text END) AS body FROM (SELECT doc_id, replace(text, '. ', E'.\\n\\n') AS text FROM documents)",
)
def _(spark, sf):
    t = docs(spark, sf).select("doc_id", F.replace("text", F.lit(". "), F.lit(".\n\n")).alias("text"))
    return t.select("doc_id", F.md5(tc.split_body("text")).alias("body"))


@query(
    "txt3_html_text",
    r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
       regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
       '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
       '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', ' '), '&copy;', chr(169)), '&middot;', chr(183)), '&#39;', ''''), '&#8211;', chr(8211)), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM pages""",
)
def _(spark, sf):
    return spread(load(spark, sf, "pages"), "page_id").select("page_id", tc.html_text("html").alias("body"))


HEADED = "E'From: a@b.org\\nX-Loop: list\\nSubject: on\\nSender: me\\n' || text"


@query(
    "txt4_drop_header_lines",
    f"SELECT doc_id, md5(regexp_replace({HEADED}, '(?m)^(Message-Id:|X-Loop:|Sender:|Errors-To:).*', '', 'g')) AS body FROM documents",
)
def _(spark, sf):
    head = F.concat(F.lit("From: a@b.org\nX-Loop: list\nSubject: on\nSender: me\n"), F.col("text"))
    return docs(spark, sf).select("doc_id", F.md5(tc.drop_header_lines(head)).alias("body"))


@query(
    "txt5_compact_lines",
    r"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> ''), chr(10))) AS body
       FROM (SELECT doc_id, replace(text, '. ', E'.\n \n  ') AS text FROM documents)""",
)
def _(spark, sf):
    t = docs(spark, sf).select("doc_id", F.replace("text", F.lit(". "), F.lit(".\n \n  ")).alias("text"))
    return t.select("doc_id", F.md5(tc.compact_lines("text")).alias("body"))


@query(
    "txt6_cut_after_phrases",
    f"SELECT doc_id, md5(regexp_replace(text, '(?i)({'|'.join(SPAM_PHRASES + ['idiot'])}).*', '', 'g')) AS body FROM documents",
)
def _(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(tc.cut_after_phrases("text", [*SPAM_PHRASES, "idiot"])).alias("body"))


@query(
    "txt7_normalize_text",
    rf"""SELECT doc_id, md5({NORM.format('text')}) AS body,
       md5(regexp_replace(regexp_replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), '\p{{Nd}}+', '', 'g'), '[^\p{{L}}\p{{N}}_\s]', '', 'g')) AS no_digits FROM documents""",
)
def _(spark, sf):
    return docs(spark, sf).select(
        "doc_id", F.md5(tc.normalize_text("text")).alias("body"), F.md5(tc.normalize_text("text", digits=False)).alias("no_digits")
    )


@query(
    "txt8_tokenize",
    rf"""SELECT doc_id, CAST(len({TOK.format(NORM.format('text'))}) AS INT) AS n_split, CAST(len(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS INT) AS n_match,
       md5(array_to_string({TOK.format(NORM.format('text'))}, ' ')) AS tokens FROM documents""",
)
def _(spark, sf):
    t = docs(spark, sf).select(
        "doc_id", tc.tokenize(tc.normalize_text("text")).alias("a"), tc.tokenize(F.lower("text"), tc.WORD + "+").alias("b")
    )
    return t.select("doc_id", F.size("a").alias("n_split"), F.size("b").alias("n_match"), F.md5(F.array_join("a", " ")).alias("tokens"))


@query(
    "txt9_remove_stop_words",
    f"SELECT doc_id, CAST(len(tokens) AS INT) AS n, md5(array_to_string(tokens, ' ')) AS tokens FROM (SELECT doc_id, {CLEAN} AS tokens FROM documents)",
)
def _(spark, sf):
    t = docs(spark, sf).select("doc_id", text.clean_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query(
    "txt9_custom_stop_words",
    f"""SELECT doc_id, CAST(len(list_filter(t, lambda x: NOT list_contains({MAIL_STOP_WORDS + ['the', 'and']}, x))) AS INT) AS n
       FROM (SELECT doc_id, {TOK.format(NORM.format('text'))} AS t FROM documents)""",
)
def _(spark, sf):
    words = [*MAIL_STOP_WORDS, "the", "and"]
    return docs(spark, sf).select("doc_id", F.size(text.clean_tokens("text", words=words)).alias("n"))


@query("txt10_stem")
def _(spark, sf):
    tokens = docs(spark, sf).select("doc_id", text.clean_tokens("text").alias("tokens"))
    terms = stem.stem_terms(text.term_counts(tokens, "doc_id", "tokens"))
    return terms.groupBy("stem").agg(F.sum("tf").alias("n"), F.count_distinct("term").alias("forms"))


@query(
    "txt11_labels",
    "SELECT doc_id, CAST(contains(source, '1') AS INT) AS by_path, CASE source WHEN 'src0' THEN 0 WHEN 'src1' THEN 1 END AS by_category FROM documents",
)
def _(spark, sf):
    path = F.concat(F.lit("/mail1/"), F.col("source"), F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    return docs(spark, sf).select(
        "doc_id", tc.label_from_path(path, "1").alias("by_path"), tc.label_from_category("source", {"src0": 0, "src1": 1}).alias("by_category")
    )


@query(
    "txt12_sender_domain",
    r"""SELECT doc_id, nullif(regexp_extract(text, '@([\p{L}\p{N}_.-]+)', 1), '') AS in_text, coalesce(nullif(regexp_extract(text, '[\p{L}\p{N}_.-]+@([\p{L}\p{N}_.-]+)', 1), ''), 'unknown') AS address,
       CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE source || '.example.org' END AS sender FROM documents""",
)
def _(spark, sf):
    sender = F.when(F.col("doc_id") % 3 == 0, "nobody").otherwise(F.concat(F.lit("\"a@b\" <x@"), F.col("source"), F.lit(".example.org>")))
    return docs(spark, sf).select(
        "doc_id",
        tc.sender_domain("text", "text").alias("in_text"),
        tc.sender_domain("text", "address").alias("address"),
        tc.sender_domain(sender).alias("sender"),
    )


@query(
    "txt13_text_counts",
    r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS num_words, CAST(len(regexp_extract_all(text, 'https?://\S+')) AS INT) AS num_links,
       CAST(len(regexp_extract_all(text, '[!@#$%^&*(),.?":{}|<>]')) AS INT) AS num_special_chars, CAST(len(regexp_extract_all(text, '\p{Nd}')) AS INT) AS num_digits FROM documents""",
)
def _(spark, sf):
    return docs(spark, sf).select("doc_id", *[c.alias(n) for n, c in tc.text_counts("text").items()])


@query(
    "txt14_spam_signals",
    rf"""SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda w: regexp_matches(w, '\p{{Lu}}') AND NOT regexp_matches(w, '\p{{Ll}}'))) AS INT) AS num_uppercase_words,
       CAST(len(regexp_extract_all(text, '!')) AS INT) AS num_exclamations, CAST(len(regexp_extract_all(text, 'https?://\S+')) AS INT) AS num_links,
       CAST(len(list_filter(string_split_regex(lower(text), '\s+'), lambda w: list_contains({TRIGGER_WORDS + ['the']}, w))) AS INT) AS num_spam_words,
       CAST(contains(lower(text), 're:') OR contains(lower(text), 'fwd:') AS INT) AS is_reply_forward FROM documents""",
)
def _(spark, sf):
    signals = tc.spam_signals("text", [*TRIGGER_WORDS, "the"])
    return docs(spark, sf).select("doc_id", *[c.alias(n) for n, c in signals.items()])


TERMS = "tc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM d) GROUP BY 1, 2)"


@query(
    "txt15_vocabulary",
    f"""WITH {DOCS}, {TERMS} SELECT term, CAST(sum(tf) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS df FROM tc GROUP BY 1 HAVING count(*) >= 2""",
)
def _(spark, sf):
    labelled = labelled_tokens(spark, sf)
    return text.fit_vocabulary(text.term_counts(labelled, "doc_id", "tokens"), 1, min_df=2, max_df=10**9).drop("idf")


VOCAB = """n AS (SELECT count(*) AS n FROM d),
   v AS (SELECT term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM {0}, n GROUP BY term HAVING count(*) >= {1} AND count(*) <= any_value(n) * {2}),
   w AS (SELECT doc_id, term, {3} * idf AS x FROM {0} JOIN v USING (term)), tfidf AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


@query("txt16_tfidf", f"WITH {DOCS}, {TERMS}, {VOCAB.format('tc', 1, 1, 'tf')} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def _(spark, sf):
    return text.tfidf(labelled_tokens(spark, sf), "doc_id", "tokens").withColumn("weight", F.round("weight", 6))


@query(
    "txt16_tfidf_ngrams",
    f"""WITH {DOCS}, p AS (SELECT doc_id, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS i FROM d),
       l AS (SELECT doc_id, t, lead(t, 1) OVER (PARTITION BY doc_id ORDER BY i) AS t2, lead(t, 2) OVER (PARTITION BY doc_id ORDER BY i) AS t3 FROM p),
       g AS (SELECT doc_id, t AS term FROM l UNION ALL SELECT doc_id, t || ' ' || t2 FROM l WHERE t2 IS NOT NULL UNION ALL SELECT doc_id, t || ' ' || t2 || ' ' || t3 FROM l WHERE t3 IS NOT NULL),
       gc AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2), {VOCAB.format('gc', 2, 0.95, '(1 + ln(tf))')}
       SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf""",
)
def _(spark, sf):
    w = text.tfidf(labelled_tokens(spark, sf), "doc_id", "tokens", ngrams=(1, 3), sublinear=True, min_df=2, max_df=0.95)
    return w.withColumn("weight", F.round("weight", 6))


@query(
    "txt18_top_words",
    f"""WITH {DOCS}, c AS (SELECT toxic, term, count(*) AS n FROM (SELECT toxic, unnest(tokens) AS term FROM d) GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY n DESC, term) AS rank FROM c) SELECT toxic, term, CAST(n AS BIGINT) AS n, CAST(rank AS INT) AS rank FROM r WHERE rank <= 100""",
)
def _(spark, sf):
    return text.top_words(labelled_tokens(spark, sf), "tokens", "toxic", 100)


@query("txt19_most_common", "SELECT lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1 ORDER BY count(*) DESC, lang LIMIT 1")
def _(spark, sf):
    return text.most_common(docs(spark, sf), "lang", 1)


@query(
    "txt20_mean_tfidf",
    f"""WITH {DOCS}, {TERMS}, {VOCAB.format('tc', 1, 1, 'tf')}, s AS (SELECT source, count(*) AS docs FROM d GROUP BY 1)
       SELECT source, term, round(sum(weight) / any_value(docs), 6) AS mean_weight FROM tfidf JOIN d USING (doc_id) JOIN s USING (source) GROUP BY 1, 2""",
)
def _(spark, sf):
    labelled = labelled_tokens(spark, sf)
    w = text.tfidf(labelled, "doc_id", "tokens")
    return text.mean_tfidf(w, labelled, "doc_id", "source").withColumn("mean_weight", F.round("mean_weight", 6))


def _pick_sql(values, salt):
    drawn = f"('0x' || substr(md5(doc_id || '|42{salt}'), 1, 8))::BIGINT"
    if isinstance(values, tuple):
        return f"({values[0]} + {drawn} % {values[1] - values[0] + 1})::VARCHAR"
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{items}][1 + {drawn} % {len(values)}]"


_MESSAGE = _pick_sql(words.MESSAGE_TEMPLATES, "template")
for _slot, _values in words.MESSAGE_SLOTS.items():
    _MESSAGE = f"replace({_MESSAGE}, '{{{_slot}}}', {_pick_sql(_values, _slot)})"


@query("txt22_synthesize", f"SELECT doc_id, {_MESSAGE} AS message FROM labels")
def _(spark, sf):
    t = load(spark, sf, "labels").select("doc_id")
    return text.synthesize(t, "doc_id", words.MESSAGE_TEMPLATES, words.MESSAGE_SLOTS)
