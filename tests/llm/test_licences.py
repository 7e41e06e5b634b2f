from larkspur.llm import licences
from larkspur.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


def test_whole_table(spark, sf):
    assert compare(spark, connect(sf), "op1", QUERIES["op1_license_scan"], ORACLES["op1_license_scan"], sf).startswith("ok")


def test_nearest_ancestor_and_odd_rows(spark):
    rows = [
        ("LICENSE", "Released under the MIT License."), ("a/b/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/x.py", "code"), ("a/y.py", "code\nmore"), ("a/b/z.py", "# This work is licensed under the GNU General Public License, version 3.\ncode"),
        ("q", None), ("q", None), (None, "Released under the MIT License."), (None, ""), ("a/bb/w.py", ""),
        ("tie/LICENSE", "SPDX-License-Identifier: MPL-2.0\nSPDX-License-Identifier: MIT"), ("tie/f", "word " * 50_000), ("near/LICENSE", "the of this"),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("dir", licences.F.lit(1)).withColumn("licence", licences.F.lit(1))
    out = sorted(((r["path"] or "", r["licence"], r["inherited"], r["inherited_from"]) for r in licences.scan(files).collect()), key=str)
    assert out == sorted([
        ("LICENSE", "MIT", None, None), ("a/b/COPYING.txt", "Apache-2.0", None, None), ("a/b/c/x.py", None, "Apache-2.0", "a/b"), ("a/y.py", None, "MIT", ""),
        ("a/b/z.py", "GPL-3.0", None, None), ("q", None, "MIT", ""), ("q", None, "MIT", ""), ("", "MIT", None, None), ("", None, None, None), ("a/bb/w.py", None, "MIT", ""),
        ("tie/LICENSE", "MIT", None, None), ("tie/f", None, "MIT", "tie"), ("near/LICENSE", None, "MIT", ""),
    ], key=str)
    assert licences.scan(files.limit(0)).count() == 0
