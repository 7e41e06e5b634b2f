"""Text functions, stems, and the vector form of TF-IDF against the long form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import text_cols as tc
from larkspur.operators import stem, text

# Well-known pairs of word and Snowball English stem.
STEMS = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist
consistency consist consistent consist consistently consist consisting consist consists consist consolation consol
consolations consol consolatory consolatori console consol consoled consol consoles consol consolidate consolid
consolidated consolid consolidating consolid consoling consol consolingly consol consols consol consonant conson
consort consort consorted consort consorting consort conspicuous conspicu conspicuously conspicu conspiracy conspiraci
conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir constable constabl
constables constabl constance constanc constancy constanc constant constant knack knack knackeries knackeri knacks knack
knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel kneeled kneel
kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife knight knight
knightly knight knights knight knit knit knits knit knitted knit knitting knit knives knive knob knob knobs knob knock
knock knocked knock knocker knocker knockers knocker knocking knock knocks knock knopp knopp knot knot knots knot
skies sky dying die news news generate generat generously generous communication communic running run hopping hop hoping
hope happy happi sensational sensat national nation rational ration relational relat university univers ties tie cries cri
flies fli gas gas this this plastered plaster bled bled agreed agre feed feed abilities abil by by say say enjoy enjoy
proceed proceed inning inning earring earring""".split()


def test_stems(spark):
    pairs = list(zip(STEMS[::2], STEMS[1::2]))
    df = spark.createDataFrame(pairs, "term string, want string")
    bad = stem.with_stem(df, "term").where("stem <> want").collect()
    assert not bad, bad


def test_html_entities_and_scripts(spark):
    html = "<html><head><style>p{}</style><script>if(a<b){x('</p>')}</script></head><!-- c --><p>a &amp;lt; b&#39;s&#8217;</p>&nbsp;&lt;x&gt;"
    got = spark.createDataFrame([(html,)], "h string").select(tc.html_text("h")).first()[0]
    assert got == "a &lt; b's’ <x>"


def test_small_columns(spark):
    row = spark.createDataFrame([("Head: x\n\nBody\n\nmore", "a@b.org <x.y@Mail.example.org>", "no address")], "t string, f string, n string").select(
        tc.split_body("t"), tc.sender_domain("f"), tc.sender_domain("n"), tc.sender_domain("f", "text"), tc.sender_domain("n", "text"),
        tc.sender_domain("f", "address"), tc.sender_domain("n", "address"),
    ).first()
    assert list(row) == ["Body\n\nmore", "Mail.example.org", "unknown", "b.org", None, "b.org", "unknown"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(tc.ngrams("t", 1, 3)).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]
    assert [r[0] for r in df.select(tc.ngrams("t", 2, 2)).collect()] == [["a b", "b c"], [], []]


def test_stop_words_keep_repeats(spark):
    got = spark.range(1).select(text.clean_tokens(F.lit("The cat, the CAT and 2 dogs!"))).first()[0]
    assert got == ["cat", "cat", "2", "dogs"]


def test_vectors_match_long_form(spark, sf):
    from pyspark.ml.functions import vector_to_array

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 40").select("doc_id", text.clean_tokens("text").alias("tokens")).cache()
    long = {(r["doc_id"], r["term"]): r["weight"] for r in text.tfidf(docs, "doc_id", "tokens").collect()}
    model = text.tfidf_vectors(docs, "tokens", max_terms=100_000)
    names = model.stages[0].vocabulary
    got = {}
    for r in model.transform(docs).select("doc_id", vector_to_array("features").alias("v")).collect():
        v = np.array(r["v"])
        got.update({(r["doc_id"], names[i]): v[i] for i in np.nonzero(v)[0]})
    assert got.keys() == long.keys()
    assert all(abs(got[k] - long[k]) < 1e-9 for k in got)


def test_synthesize_draws_whole_ranges(spark):
    got = [r["message"] for r in text.synthesize(spark.range(2000), "id", ["{n}% of {x}"], {"n": (5, 9), "x": ["all"]}).collect()]
    assert set(got) == {f"{i}% of all" for i in range(5, 10)}


@pytest.mark.parametrize("n", [20])
def test_synthesize_fills_all_slots(spark, n):
    got = text.synthesize(spark.range(n), "id", ["{a} and {b}", "only {b}"], {"a": ["x", "y"], "b": ["1", "2", "3"]}).collect()
    assert len(got) == n and not any("{" in r["message"] for r in got)
    assert len({r["message"] for r in got}) > 3


def test_html_codes_that_are_no_character_stay(spark):
    html = "a&#1114112;b&#55296;c&#x27;d&#xE9;e&#0;f&#8364;g&#X1F600;&#xD800;"
    got = spark.createDataFrame([(html,)], "h string").select(tc.html_text("h")).first()[0]
    assert got == "a&#1114112;b&#55296;c'd\u00e9e&#0;f\u20acg\U0001f600&#xD800;"


def test_html_text_decodes_every_entity(spark):
    pages = ["caf&eacute; &copy; 2020&nbsp;&hellip; &lt;b&gt;", "a &amp;lt; b &nosuch; &Alpha;&alpha; &#x27;x&#39;", "", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    got = [r["t"] for r in df.select("i", tc.html_text("html").alias("t")).orderBy("i").collect()]
    assert got == ["café © 2020 … <b>", "a &lt; b &nosuch; Αα 'x'", "", None]


def test_term_counts_have_partitions_by_rows(spark, monkeypatch):
    monkeypatch.setattr(text, "TASK_DOCS", 10)
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.array(F.lit("a"), F.lit("a"), F.col("id").cast("string")).alias("t"))
    counts = text.term_counts(df, "doc_id", "t")
    assert counts.rdd.getNumPartitions() == 100
    assert counts.count() == 2000 and counts.where("term = 'a' and tf = 2").count() == 1000


def test_runs_of_tokens_are_shuffled_by_term_once(spark):
    """Counts, limits and weights of n-grams come from one shuffle by term, and what is spread by document are the tokens."""
    import math
    from collections import Counter

    rows = [(1, "a b c a".split()), (2, "a b d".split()), (3, "b c a b".split()), (4, []), (5, None), (6, ["e"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = text.tfidf(df, "id", "tokens", ngrams=(1, 3), sublinear=True, min_df=2, max_df=0.4)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(term#") == 1
        assert plan.index("zip_with") < plan.rindex("REPARTITION_BY_NUM")  # printed from the last step to the first
        got = {(r["id"], r["term"]): r["weight"] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    tf = {i: Counter(" ".join(t[j: j + n]) for n in (1, 2, 3) for j in range(len(t) - n + 1)) for i, t in rows if t}
    found = Counter(t for c in tf.values() for t in c)
    want = {(i, t): (1 + math.log(n)) * (math.log(7 / (found[t] + 1)) + 1) for i, c in tf.items() for t, n in c.items() if 2 <= found[t] <= 2.4}
    norm = {i: math.sqrt(sum(w * w for (j, _), w in want.items() if j == i)) for i in tf}
    assert want and set(got) == set(want) and all(abs(got[k] - w / norm[k[0]]) < 1e-12 for k, w in want.items())
