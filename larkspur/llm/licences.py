"""Licence scans: TF-IDF cosine of file headers and licence files to templates, then inheritance by directory.

Every line of a file is a header candidate; a licence file is also compared as a whole. The templates are few
and sparse, so a line's dot products come from one look-up per distinct word. A licence file speaks for its
directory, and a file without a licence of its own takes that of its nearest ancestor directory: distinct
directories, not files, are opened into their ancestors and joined by path.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import raw, to_batches
from larkspur.llm.decontaminate import words_of
from larkspur.session import scratch_path, settle

#: Notices by which files name these licences.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "MIT": ["Released under the MIT License.", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}


class Templates:
    """Unit vectors of the templates by word, and the weight of any word."""

    def __init__(self, templates: Mapping[str, Sequence[str]]):
        texts = [(name, Counter(words_of(t.encode()))) for name, ts in sorted(templates.items()) for t in ts]
        df = Counter(w for _, c in texts for w in c)
        self.idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in df.items()}
        self.unknown = math.log(1 + len(texts)) + 1
        self.names = [name for name, _ in texts]
        self.by_word: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for i, (_, c) in enumerate(texts):
            norm = math.sqrt(sum((n * self.idf[w]) ** 2 for w, n in c.items()))
            for w, n in c.items():
                self.by_word[w].append((i, n * self.idf[w] / norm))

    def best(self, words: list[bytes]) -> tuple[float, str]:
        """The highest cosine, and its licence: the first by name among equals; (0, "") if no word is shared."""
        if self.by_word.keys().isdisjoint(words):
            return 0.0, ""
        count, dot, square = Counter(words), defaultdict(float), 0.0
        for w, n in count.items():
            x = n * self.idf.get(w, self.unknown)
            square += x * x
            for i, y in self.by_word.get(w, ()):
                dot[i] += x * y
        i, top = min(dot.items(), key=lambda d: (-round(d[1], 9), d[0]))
        return top / math.sqrt(square), self.names[i]


def own_licences(files: DataFrame, path_col: str, text_col: str, whole: Column, threshold: float = 0.7, templates: Mapping[str, Sequence[str]] = TEMPLATES) -> DataFrame:
    """(path, whole, licence, score): the best line of each file, or its whole text where `whole` holds, if it
    reaches `threshold`; else nulls."""
    schema = pa.schema([("path", pa.string()), ("whole", pa.bool_()), ("licence", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(templates)
        for b in batches:
            names: list[str | None] = []
            scores: list[float | None] = []
            for text, all_ in zip(raw(b.column(2)), b.column(1).to_pylist()):
                units = text.split(b"\n") + ([text] if all_ else [])
                score, name = min((t.best(words_of(u)) for u in units), key=lambda x: (-round(x[0], 9), x[1]))
                names.append(name if score >= threshold else None)
                scores.append(score if score >= threshold else None)
            yield from to_batches(schema, [[b.column(0), b.column(1), names, scores]])

    rows = files.select(files[path_col].cast("string").alias("path"), F.coalesce(whole, F.lit(False)).alias("whole"), files[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "path string, whole boolean, licence string, score double")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", licence_file: Column | None = None, threshold: float = 0.7, templates: Mapping[str, Sequence[str]] = TEMPLATES) -> DataFrame:
    """(path, licence, score, inherited, inherited_from) for every row of `files`.

    `licence` is the file's own; `inherited` comes from the nearest directory at or above the file's that a
    licence file speaks for, where the file has none of its own. `licence_file` says which rows are licence
    files (by default those named LICENSE, LICENCE, COPYING or NOTICE). Of several in one directory the
    highest score counts, then the first name. Paths part at '/'; "" is the top directory. Null paths lie
    nowhere and inherit nothing; null and empty texts have no licence; repeated rows stand as they are; an
    empty table gives an empty result; other columns are not read.
    """
    if licence_file is None:
        licence_file = F.regexp_extract(files[path_col], r"([^/]*)$", 1).rlike(r"(?i)^(licen[sc]e|copying|notice)([.\-].*)?$")
    own = settle(own_licences(files, path_col, text_col, licence_file, threshold, templates))  # read three times below; holds no text
    own = own.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), "")))
    said = own.where("whole and licence is not null and dir is not null").groupBy("dir").agg(F.max(F.struct(F.round("score", 9).alias("s"))).alias("s"), F.collect_set(F.struct(F.round("score", 9).alias("s"), "licence")).alias("all"))
    said = said.select(F.col("dir").alias("from"), F.array_min(F.transform(F.filter("all", lambda x: x["s"] == F.col("s.s")), lambda x: x["licence"])).alias("inherited"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    dirs = own.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("from"))
    near = dirs.join(said, "from").groupBy("dir").agg(F.max_by(F.struct("inherited", "from"), F.length("from")).alias("near"))
    # read from a file, whose size Spark knows: small, it is broadcast and the files stay where they are; large, its
    # side of the join is a plain shuffle, so that Spark can split a directory of very many files
    stored = scratch_path(files.sparkSession, "licences")
    near.write.parquet(stored)
    out = own.join(files.sparkSession.read.parquet(stored), "dir", "left")
    gap = F.col("licence").isNull()
    return out.select("path", "licence", "score", F.when(gap, F.col("near.inherited")).alias("inherited"), F.when(gap, F.col("near.from")).alias("inherited_from"))


def oracle() -> str:
    """DuckDB SQL for `op1_license_scan`'s rows."""
    rows = ", ".join("('%s', %d, '%s')" % (name, i, t.replace("'", "''")) for name, ts in sorted(TEMPLATES.items()) for i, t in enumerate(ts))
    words = lambda c: f"regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
    WITH t(licence, variant, text) AS (VALUES {rows}),
    tw AS (SELECT licence, variant, w, count(*) AS n FROM (SELECT licence, variant, unnest({words('text')}) AS w FROM t) GROUP BY ALL),
    size AS (SELECT count(*) AS k FROM t),
    idf AS (SELECT w, ln((1 + max(k)) / (1.0 + count(*))) + 1 AS idf FROM tw, size GROUP BY w),
    tv AS (SELECT licence, variant, w, n * idf / sqrt(sum((n * idf) * (n * idf)) OVER (PARTITION BY licence, variant)) AS y FROM tw JOIN idf USING (w)),
    d AS (
        SELECT doc_id, source || '/' || lang || '/' || doc_id AS path, source || '/' || lang AS dir, length(text) <= 300 AS whole, text FROM documents
    ),
    u AS (
        SELECT path, i, unit FROM (SELECT path, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
        UNION ALL SELECT path, 0, text FROM d WHERE whole
    ),
    uw AS (SELECT path, i, w, count(*) AS n FROM (SELECT path, i, unnest({words('unit')}) AS w FROM u) GROUP BY ALL),
    uv AS (
        SELECT path, i, w, x, sqrt(sum(x * x) OVER (PARTITION BY path, i)) AS norm
        FROM (SELECT path, i, w, n * coalesce(idf, (SELECT ln(1.0 + k) + 1 FROM size)) AS x FROM uw LEFT JOIN idf USING (w))
    ),
    c AS (SELECT path, licence, sum(x * y) / max(norm) AS score FROM uv JOIN tv USING (w) GROUP BY path, i, licence, variant),
    best AS (SELECT path, licence, score FROM c WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY path ORDER BY round(score, 9) DESC, licence) = 1),
    own AS (SELECT d.doc_id, d.path, d.dir, d.whole, best.licence, best.score FROM d LEFT JOIN best USING (path)),
    said AS (SELECT dir, licence FROM own WHERE whole AND licence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dir ORDER BY round(score, 9) DESC, licence) = 1),
    up AS (SELECT DISTINCT dir, unnest([dir, split_part(dir, '/', 1), '']) AS above FROM own),
    near AS (SELECT up.dir, above, licence FROM up JOIN said ON said.dir = up.above QUALIFY row_number() OVER (PARTITION BY up.dir ORDER BY length(above) DESC) = 1)
    SELECT own.path, own.licence, round(own.score, 6) AS score,
        CASE WHEN own.licence IS NULL THEN near.licence END AS inherited, CASE WHEN own.licence IS NULL THEN near.above END AS inherited_from
    FROM own LEFT JOIN near USING (dir)"""
