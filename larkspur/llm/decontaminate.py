"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive item words. Symbols are words, a block is two of them (one, for
one-word patterns). For each pattern length m the shift table gives how far the search may move on when a
block ends at its cursor: m - 1 for blocks in no pattern, else the distance of the block's last place from
the pattern's end. Shift zero opens the bucket of patterns that end in the block, and each is compared word
by word. Most blocks of a clean text lie in no pattern, so the cursor reads few of its words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import id_text, raw, to_batches

ITEM_BYTES = 16 << 20  # benchmark text that one pass broadcasts; more items take more passes
#: Bytes that a word is made of: digits, letters (A-Z as a-z) and all beyond ASCII; the others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Search:
    """Shift tables and suffix buckets by pattern length."""

    def __init__(self, patterns: Iterable[tuple[tuple[bytes, ...], int]]):
        owners: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        for p, item in patterns:
            owners[p].add(item)
        self.tables = []
        for m in sorted({len(p) for p in owners}):
            shift: dict = {}
            bucket: dict = defaultdict(list)
            b = min(2, m)
            for p in owners:
                if len(p) == m:
                    for end in range(b, m + 1):
                        block = p[end - b: end] if b == 2 else p[0]
                        shift[block] = min(shift.get(block, m), m - end)
                    bucket[p[-2:] if b == 2 else p[0]].append((p, sorted(owners[p])))
            self.tables.append((m, m - b + 1, shift, dict(bucket)))

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [start, end) of words inside an occurrence, and the items that occur."""
        spans, items, n = [], set(), len(words)
        for m, most, shift, bucket in self.tables:
            i = m - 1
            while i < n:
                block = (words[i - 1], words[i]) if m > 1 else words[i]
                move = shift.get(block, most)
                if move:
                    i += move
                    continue
                for p, own in bucket[block]:
                    if tuple(words[i - m + 1: i + 1]) == p:
                        spans.append((i - m + 1, i + 1))
                        items.update(own)
                i += 1
        return spans, items


def windows(text: bytes, length: int) -> set[tuple[bytes, ...]]:
    """Runs of `length` consecutive words; a shorter text is one window, one without words has none."""
    w = words_of(text)
    return {tuple(w[i: i + length]) for i in range(max(1, len(w) - length + 1))} if w else set()


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Overlapping and touching ranges as one, ascending."""
    out: list[dict[str, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["to"]:
            out[-1]["to"] = max(b, out[-1]["to"])
        else:
            out.append({"from": a, "to": b})
    return out


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in lists of at most `limit` bytes of text (or one item), fetched partition by partition."""
    part, size = [], 0
    for row in items.where("text is not null").toLocalIterator():
        text = row["text"].encode()
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append((row["item_id"], text))
        size += len(text)
    if part:
        yield part


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, n_words long, spans array<struct<from,to>>, items array<string>) for every row of `docs`.

    Words are runs of digits, letters and bytes beyond ASCII, A-Z as a-z. `spans` are the merged word ranges
    [from, to) inside any occurrence, `items` the ids whose windows occur, in string order. Null and empty
    texts have no words and no hits; items without words match nothing; repeated items and rows count as
    they stand (a null item id is not listed). An empty benchmark hits nothing. Patterns are broadcast in
    blocks of at most `item_bytes` of item text; each further block is another pass over the documents.
    Other columns are not read.
    """
    spark = docs.sparkSession
    src = id_text(docs, id_col, text_col)
    items = benchmark.select(benchmark[item_col].cast("string").alias("item_id"), benchmark[item_text].cast("string").alias("text"))
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    found = [("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))]
    ddl = "n_words long, spans array<struct<from:long,to:long>>, items array<string>"

    def search(part: list[tuple[str, bytes]], rows: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast(part)
        key, kind = rows.dtypes[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = [x for x, _ in sent.value]
            find = Search((w, i) for i, (_, text) in enumerate(sent.value) for w in windows(text, window))
            for b in batches:
                schema = pa.schema([b.schema.field(0), *found])
                cols: list[list] = [[], [], []]
                for text in raw(b.column(1)):
                    w = words_of(text)
                    spans, own = find.hits(w) if w else ([], set())
                    cols[0].append(len(w))
                    cols[1].append(merged(spans))
                    cols[2].append(sorted({names[i] for i in own if names[i] is not None}))
                yield from to_batches(schema, [[b.column(0), *cols]])

        return rows.mapInArrow(run, f"{key} {kind}, {ddl}")

    parts = _blocks(items, item_bytes)
    first = next(parts, [])
    second = next(parts, None)
    if second is None:
        return search(first, src)
    # several passes: rows are told apart by a digest of their text, so that repeated ids do no harm
    keyed = src.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"), "text")
    once = keyed.select("key", "text")
    passes = search(first, once).unionByName(search(second, once))
    for part in parts:
        passes = passes.unionByName(search(part, once))
    union = passes.groupBy("key").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merge = F.udf(lambda s: merged([(x["from"], x["to"]) for x in s]), "array<struct<from:long,to:long>>")
    return keyed.select("doc_id", "key").join(union, "key").select("doc_id", "n_words", merge("spans").alias("spans"), "items")
