"""Text functions on columns. All of them stay in the JVM.

Word characters are spelled out as letters, digits and underscore of any script, as `\\w` means ASCII
only to Java.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from larkspur.functions.words import CATEGORY_LABELS, HEADER_LINES, SPAM_PHRASES, STOP_WORDS, TRIGGER_WORDS

WORD = r"[\p{L}\p{N}_]"
# every named entity of HTML; a hard blank reads as a blank, and `amp` is left for the end
ENTITIES = {n: chr(c) for n, c in name2codepoint.items() if n != "amp"} | {"apos": "'", "nbsp": " "}


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_body(col: str | Column) -> Column:
    """What follows the first blank line; the whole text if there is none."""
    col = _c(col)
    at = F.instr(col, "\n\n")
    return F.when(at > 0, F.substring(col, at + 2, F.length(col))).otherwise(col)


def collapse(col: str | Column) -> Column:
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def _character(n: Column) -> Column:
    """The character of a code in decimals or, after an x, in hex digits; a code that is none stays as it was written."""
    code = F.when(F.lower(n).startswith("x"), F.conv(F.substring(n, 2, 6), 16, 10)).otherwise(n).cast("bigint")
    real = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(real, code)), 8, "0")), "UTF-32")
    return F.coalesce(char, F.concat(F.lit("&#"), n, F.lit(";")))


def html_text(col: str | Column) -> Column:
    """Text of a page: no script, style or comment, tags read as a blank, entities decoded, blanks collapsed."""
    out = _c(col)
    for tag in ("script", "style"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    known = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    names = F.array_distinct(F.regexp_extract_all(out, F.lit(r"&([a-zA-Z][a-zA-Z0-9]{1,8});"), F.lit(1)))
    names = F.filter(names, lambda n: F.map_contains_key(known, n))
    out = F.aggregate(names, out, lambda text, n: F.replace(text, F.concat(F.lit("&"), n, F.lit(";")), F.try_element_at(known, n)))
    numbers = F.array_distinct(F.regexp_extract_all(out, F.lit(r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), F.lit(1)))
    out = F.aggregate(numbers, out, lambda text, n: F.replace(text, F.concat(F.lit("&#"), n, F.lit(";")), _character(n)))
    out = F.replace(out, F.lit("&amp;"), F.lit("&"))
    return collapse(out)


def drop_header_lines(col: str | Column, names: Sequence[str] = HEADER_LINES) -> Column:
    return F.regexp_replace(_c(col), rf"(?m)^({'|'.join(n + ':' for n in names)}).*", "")


def compact_lines(col: str | Column) -> Column:
    """Trim every line and drop the blank ones."""
    lines = F.transform(F.split(_c(col), "\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def cut_after_phrases(col: str | Column, phrases: Sequence[str] = SPAM_PHRASES) -> Column:
    """Cut each line from a phrase onward, whatever its case."""
    return F.regexp_replace(_c(col), rf"(?i)({'|'.join(phrases)}).*", "")


def normalize_text(col: str | Column, digits: bool = True) -> Column:
    """Collapse blanks, lower-case, drop punctuation; drop digits unless `digits`."""
    out = F.lower(collapse(col))
    if not digits:
        out = F.regexp_replace(out, r"\p{Nd}+", "")
    return F.regexp_replace(out, r"[^\p{L}\p{N}_\s]", "")


def tokenize(col: str | Column, pattern: str | None = None) -> Column:
    """Split at blanks, or take every match of `pattern`."""
    if pattern:
        return F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(0))
    return F.filter(F.split(_c(col), r"\s+"), lambda t: t != "")


def remove_stop_words(tokens: str | Column, words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(_c(tokens), lambda t: ~t.isin(*words))


def ngrams(tokens: str | Column, low: int = 1, high: int = 1) -> Column:
    """All runs of `low` to `high` tokens, joined by a blank."""
    tokens = _c(tokens)
    if (low, high) == (1, 1):
        return tokens
    # runs of n come from runs of n - 1 zipped with the tokens moved on by n - 1, one linear step each
    runs, parts = tokens, []
    for n in range(1, high + 1):
        if n > 1:
            runs = F.zip_with(runs, F.slice(tokens, n, F.size(tokens)), lambda a, b: F.concat(a, F.lit(" "), b))
            runs = F.filter(runs, lambda t: t.isNotNull())
        if n >= low:
            parts.append(runs)
    return F.concat(*parts)


def label_from_path(col: str | Column, word: str = "spam") -> Column:
    """1 when the folder of the path holds the word."""
    folder = F.regexp_extract(_c(col), r"([^/]+)/[^/]*$", 1)
    return F.contains(folder, F.lit(word)).cast("int")


def label_from_category(col: str | Column, labels: Mapping[str, int] = CATEGORY_LABELS) -> Column:
    col, out = _c(col), F
    for k, v in labels.items():
        out = out.when(col == k, F.lit(v))
    return out


def sender_domain(col: str | Column, how: str = "from") -> Column:
    """`from`: after the last @ of a From header. `text`: first @domain in a text, null if none.
    `address`: domain of the first full address, `unknown` if none."""
    col = _c(col)
    if how == "from":
        tail = F.regexp_replace(F.substring_index(col, "@", -1), r"[>\s]+$", "")
        return F.when(F.contains(col, F.lit("@")), tail).otherwise(F.lit("unknown"))
    if how == "text":
        return F.nullif(F.regexp_extract(col, rf"@({WORD[:-1]}.-]+)", 1), F.lit(""))
    found = F.regexp_extract(col, rf"{WORD[:-1]}.-]+@({WORD[:-1]}.-]+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))


def text_counts(col: str | Column) -> dict[str, Column]:
    col = _c(col)
    patterns = {
        "num_words": r"\S+",
        "num_links": r"https?://\S+",
        "num_special_chars": r'[!@#$%^&*(),.?":{}|<>]',
        "num_digits": r"\p{Nd}",
    }
    return {name: F.regexp_count(col, F.lit(p)) for name, p in patterns.items()}


def spam_signals(col: str | Column, words: Sequence[str] = TRIGGER_WORDS) -> dict[str, Column]:
    col = _c(col)
    lower = F.lower(col)
    return {
        "num_uppercase_words": F.regexp_count(col, F.lit(r"(?<!\S)[^\s\p{Ll}]*\p{Lu}[^\s\p{Ll}]*(?!\S)")),
        "num_exclamations": F.regexp_count(col, F.lit("!")),
        "num_links": F.regexp_count(col, F.lit(r"https?://\S+")),
        "num_spam_words": F.size(F.filter(F.split(lower, r"\s+"), lambda t: t.isin(*words))),
        "is_reply_forward": (F.contains(lower, F.lit("re:")) | F.contains(lower, F.lit("fwd:"))).cast("int"),
    }
