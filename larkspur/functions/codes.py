"""Column functions on diagnosis codes, ranges and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ICD-9 ranges (both ends included) and the single codes that go with them, in the
# order they are tried.
ICD_GROUPS = [
    ("circulatory", [(390, 459), (785, 785)]),
    ("respiratory", [(460, 519), (786, 786)]),
    ("digestive", [(520, 579), (787, 787)]),
    ("diabetes", [(250.00, 250.99)]),
    ("injury", [(800, 999)]),
    ("musculoskeletal", [(710, 739)]),
    ("genitourinary", [(580, 629), (788, 788)]),
    ("other", [(290, 319), (7777, 7777), (280, 289), (320, 359), (630, 679), (360, 389), (740, 759)]),
]
ICD_REST = "neoplasms"
# The second grouping, seven groups.
ICD_GROUPS_SEVEN = [
    ("Circulatory", [(390, 459), (785, 785)]),
    ("Respiratory", [(460, 519), (786, 786)]),
    ("Digestive", [(520, 579), (787, 787)]),
    ("Genitourinary", [(580, 629), (788, 788)]),
    ("Diabetes", [(250, None)]),
    ("Injury", [(800, 999)]),
]


def icd_number(col: str | Column) -> Column:
    """Code as a number; codes that start with E or V become 7777, what is no number becomes null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(F.substring(col, 1, 1).isin("E", "V"), F.lit(7777.0)).otherwise(col.try_cast("double"))


def _grouped(number: Column, groups, rest: str) -> Column:
    out = F
    for name, ranges in groups:
        test = F.lit(False)
        for lo, hi in ranges:
            within = (number >= lo) & (number < lo + 1) if hi is None else number.between(lo, hi)
            test = test | within
        out = out.when(test, F.lit(name))
    return out.otherwise(F.lit(rest))


def icd_group(number: str | Column) -> Column:
    """Nine groups; every number in no listed range is `neoplasms`."""
    number = F.col(number) if isinstance(number, str) else number
    return _grouped(number, ICD_GROUPS, ICD_REST)


def icd_group7(code: str | Column) -> Column:
    """Seven groups from the raw code; a code that is no number is `Other`."""
    code = F.col(code) if isinstance(code, str) else code
    return _grouped(F.coalesce(code.try_cast("double"), F.lit(-1.0)), ICD_GROUPS_SEVEN, "Other")


def range_label(col: str | Column, width: int, top: int, last: int | None = None) -> Column:
    """`[1-10]`, `[11-20]` ... by integer arithmetic. Values outside 1..top fall in the last, open range."""
    col = F.col(col) if isinstance(col, str) else col
    low = F.floor((col - 1) / width) * width + 1
    label = F.concat(F.lit("["), low.cast("bigint"), F.lit("-"), (low + width - 1).cast("bigint"), F.lit("]"))
    tail = f"[{top + 1}-{last}]" if last else f"[{top + 1}-]"
    return F.when(col.between(1, top), label).otherwise(F.lit(tail))
