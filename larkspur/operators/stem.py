"""English stems (the public Snowball English rules), as column expressions on the distinct terms.

Each rule set is "find the longest ending of the list, then act if the place of the ending allows it".
Terms are stemmed once per distinct term and joined back, so the work follows the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Words with a stem of their own.
WHOLE = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
# Words left alone once the plural is gone.
STOP_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
# Ending and what replaces it, for the two derivational steps.
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
    "ative": "",
}
STEP4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()

REGION = "[^aeiouy]*[aeiouy]+[^aeiouy]"
SHORT_END = "(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"


def _ending(word: Column, endings) -> Column:
    # the search is leftmost, and the leftmost match up to the end is the longest ending
    return F.regexp_extract(word, f"({'|'.join(endings)})$", 1)


def _cut(word: Column, n: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _lookup(key: Column, table: dict) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(key == k, F.lit(v))
    return out


def _let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once. The whole stem stays one expression of linear size,
    which a filter pushed through it only repeats, never multiplies."""
    return F.transform(F.array(value), body)[0]


def _on_ending(w: Column, endings, act) -> Column:
    """`act(word, ending, base)`; the ending is empty where none fits."""
    return _let(_ending(w, endings), lambda e: act(w, e, _cut(w, F.length(e))))


def _plural(w: Column, e: Column, base: Column) -> Column:
    return (
        F.when(e == "sses", F.concat(base, F.lit("ss")))
        .when(e.isin("ied", "ies"), F.concat(base, F.when(F.length(base) > 1, F.lit("i")).otherwise(F.lit("ie"))))
        .when((e == "s") & base.rlike("[aeiouy].+"), base)
        .otherwise(w)
    )


def _repair(w: Column, p1: Column) -> Column:
    """After -ed or -ing is gone: hop(p), hat(e), fil(e)."""
    short_word = (p1 >= F.length(w)) & w.rlike(SHORT_END)
    return (
        F.when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
        .when(w.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _cut(w, F.lit(1)))
        .when(short_word, F.concat(w, F.lit("e")))
        .otherwise(w)
    )


def _past(p1: Column):
    def act(w: Column, e: Column, base: Column) -> Column:
        gone = e.isin("ed", "edly", "ing", "ingly") & base.rlike("[aeiouy]")
        eed = e.isin("eed", "eedly") & (F.length(base) >= p1)
        return F.when(gone, _let(base, lambda b: _repair(b, p1))).when(eed, F.concat(base, F.lit("ee"))).otherwise(w)

    return act


def _derived(table: dict, allowed):
    def act(w: Column, e: Column, base: Column) -> Column:
        return F.when((e != "") & allowed(e, base), F.concat(base, _lookup(e, table))).otherwise(w)

    return act


def _last_letter(p1: Column, p2: Column):
    def act(w: Column, e: Column, base: Column) -> Column:
        n = F.length(base)
        drop_e = (e == "e") & ((n >= p2) | ((n >= p1) & ~base.rlike(SHORT_END)))
        drop_l = (e == "l") & (n >= p2) & base.rlike("l$")
        return F.when(drop_e | drop_l, base).otherwise(w)

    return act


def _suffixes(w: Column, p1: Column, p2: Column) -> Column:
    """Everything after the plural step."""

    def in_r1_step2(e: Column, base: Column) -> Column:
        fits = F.when(e == "ogi", base.rlike("l$")).when(e == "li", base.rlike("[cdeghkmnrt]$")).otherwise(F.lit(True))
        return (F.length(base) >= p1) & fits

    def in_r1_step3(e: Column, base: Column) -> Column:
        return (F.length(base) >= p1) & ((e != "ative") | (F.length(base) >= p2))

    def in_r2(e: Column, base: Column) -> Column:
        return (F.length(base) >= p2) & ((e != "ion") | base.rlike("[st]$"))

    out = _on_ending(w, ["eedly", "ingly", "edly", "eed", "ing", "ed"], _past(p1))
    out = F.regexp_replace(out, "(.[^aeiouy])[yY]$", "$1i")
    out = _let(out, lambda x: _on_ending(x, STEP2, _derived(STEP2, in_r1_step2)))
    out = _let(out, lambda x: _on_ending(x, STEP3, _derived(STEP3, in_r1_step3)))
    out = _let(out, lambda x: _on_ending(x, STEP4, _derived({k: "" for k in STEP4}, in_r2)))
    return _let(out, lambda x: _on_ending(x, ["e", "l"], _last_letter(p1, p2)))


def _regular(w: Column) -> Column:
    """Stem of a prepared word: find where R1 and R2 start, then cut from the end."""

    def with_regions(p1: Column, p2: Column) -> Column:
        bare = _on_ending(w, ["'s'", "'s", "'"], lambda x, e, base: base)
        plain = _let(bare, lambda x: _on_ending(x, ["sses", "ied", "ies", "us", "ss", "s"], _plural))
        return _let(plain, lambda x: F.when(x.isin(*STOP_AFTER_PLURAL), x).otherwise(_suffixes(x, p1, p2)))

    head = F.regexp_extract(w, f"^(gener|commun|arsen|{REGION})", 1)
    r1 = F.when(head == "", F.length(w)).otherwise(F.length(head))

    def from_r1(p1: Column) -> Column:
        more = F.regexp_extract(F.substring(w, p1 + 1, F.length(w)), f"^({REGION})", 1)
        return _let(F.when(more == "", F.length(w)).otherwise(p1 + F.length(more)), lambda p2: with_regions(p1, p2))

    return _let(r1, from_r1)


def stem(col: str | Column) -> Column:
    """Stem of one word."""
    lower = F.lower(F.col(col) if isinstance(col, str) else col)

    def body(word: Column) -> Column:
        # a y that opens the word or follows a vowel is a consonant, written Y
        marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(word, "^'", ""), "^y", "Y"), "([aeiouy])y", "$1Y")
        return (
            F.when(F.length(word) <= 2, word)
            .when(word.isin(*WHOLE), _lookup(word, WHOLE))
            .otherwise(F.lower(_let(marked, _regular)))
        )

    return _let(lower, body)


def with_stem(df: DataFrame, term: str, out: str = "stem") -> DataFrame:
    """Add the stem of each term. Meant for a table of distinct terms."""
    return df.withColumn(out, stem(term))


def stem_terms(df: DataFrame, term: str = "term", out: str = "stem") -> DataFrame:
    """Add stems to a table in which terms repeat: stem the distinct terms, join back."""
    return df.join(with_stem(df.select(term).distinct(), term, out), term)
