"""Fill-in-middle transformation: texts cut at unit borders and reordered, so that a model learns to fill gaps.

A unit is white space followed by a word; white space at the end of a text is a unit of its own. Borders are
found without looking at single bytes: a batch's UTF-8 is viewed as uint64 words, eight bytes each, and
arithmetic on whole words marks the last byte of every unit by its high bit. `bitwise_count` gives the marks
of each word, their running sum is searched for the word that holds a wanted border, and clearing low bits
inside that word finds the byte.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def _below(x: np.ndarray, c: int) -> np.ndarray:
    """The high bit of every byte less than `c` (at most 128)."""
    return ~((x & LOW7) + ONES * np.uint64(128 - c)) & ~x & HIGH


def white(x: np.ndarray) -> np.ndarray:
    """The high bit of every ASCII white byte: 0x09 to 0x0D and 0x20."""
    return (_below(x, 0x0E) & ~_below(x, 0x09)) | (_below(x, 0x21) & ~_below(x, 0x20))


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian uint64, zero-filled to a whole word."""
    full = np.zeros(-(-len(data) // 8) * 8, np.uint8)
    full[: len(data)] = data
    return full.view("<u8")


class Marks:
    """A bit set over bytes, as uint64 words with the high bits of bytes, that answers rank and select."""

    def __init__(self, bits: np.ndarray):
        self.bits = np.append(bits, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    def rank(self, byte: np.ndarray) -> np.ndarray:
        """The marks before each byte."""
        low = (np.uint64(1) << ((byte & 7) * 8).astype(np.uint64)) - np.uint64(1)
        return self.before[byte >> 3] + np.bitwise_count(self.bits[byte >> 3] & low)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The byte of each nth mark, counted from 1."""
        word = np.searchsorted(self.before, nth, "left") - 1
        x, left = self.bits[word], nth - self.before[word]
        for i in range(1, 8):  # a word has eight marks at most: clear those before the wanted one
            x = np.where(left > i, x & (x - np.uint64(1)), x)
        lowest = x & (~x + np.uint64(1))
        return word * 8 + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 8


def unit_ends(data: np.ndarray, ends: np.ndarray) -> Marks:
    """Marks on the last byte of each unit of the texts that end before the bytes `ends`."""
    w = white(words_of(data))
    following = (w >> np.uint64(8)) | (np.append(w[1:], np.uint64(0)) << np.uint64(56))
    bits = ~w & following & HIGH
    last = np.unique(ends[ends > 0]) - 1  # a text's last byte ends a unit, whatever comes next in the batch
    np.bitwise_or.at(bits, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
    return Marks(bits)


def char_starts(data: np.ndarray) -> Marks:
    """Marks on the first byte of each code point."""
    x = words_of(data)
    continues = x & ~(x << np.uint64(1)) & HIGH  # 10xxxxxx; bit 6 moves to bit 7 of its own byte
    return Marks(~continues & HIGH)


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """Per text [start, end): its units, where its middle and suffix begin, and the code points of prefix and middle."""
    ends = unit_ends(data, end[end > start])
    base = ends.rank(start)
    n = ends.rank(end) - base
    a, b = h1 % (n + 1), h2 % (n + 1)

    def byte(c: np.ndarray) -> np.ndarray:
        out = start.copy()
        some = np.flatnonzero(c > 0)
        out[some] = ends.select(base[some] + c[some]) + 1
        return out

    i, j = byte(np.minimum(a, b)), byte(np.maximum(a, b))
    chars = char_starts(data)
    at_i = chars.rank(i)
    return n, i, j, at_i - chars.rank(start), chars.rank(j) - at_i


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the seed and the id; a null id reads as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, suffix_first: int = 80,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of `docs`.

    n counts the units of the whole text; null reads as empty. Of a hundred texts `rate` are reordered, and
    `suffix_first` of a hundred of these as spm (suffix, prefix, middle), the others as psm, each part after
    its mark; the rest, empty texts and texts that hold a mark stay as they are (plain, with null counts).
    Which, and where the cuts fall, depends on the seed and the id only, so repeated rows and a task that is
    run again give the same; a null id draws as an id without digits. Other columns are not read; an empty
    table gives an empty result. Nothing is shuffled.
    """
    if any(not x or x[0] in "".join(y[1:] for y in marks) for x in marks) or len(set(marks)) < 3:
        raise ValueError("marks must differ, and none may begin with a character that another mark holds later on")
    p, s, m = (x.encode() for x in marks)
    src = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), *_draws(docs[id_col], seed))
    held = functools.reduce(lambda a, b: a | b, [F.contains("text", F.lit(x)) for x in marks])
    src = src.withColumn("plain", (F.col("text") == "") | held | (F.col("h3") % 100 >= rate)).withColumn("spm", F.col("h4") % 100 < suffix_first)
    src = src.select("doc_id", "text", "h1", "h2", "plain", "spm")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).cast(pa.large_binary())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
            whole = texts.buffers()[2]
            data = np.frombuffer(whole, np.uint8)[at[0]: at[-1]] if whole is not None else np.zeros(0, np.uint8)
            at = at - at[0]
            h1, h2 = (batch.column(i).to_numpy() for i in (2, 3))
            n, i, j, prefix, middle = cut(data, at[:-1], at[1:], h1, h2)
            plain, spm = (batch.column(k).to_numpy(zero_copy_only=False) for k in (4, 5))
            raw, out = data.tobytes(), []
            for a, x, y, z, same, turned in zip(at[:-1].tolist(), i.tolist(), j.tolist(), at[1:].tolist(), plain.tolist(), spm.tolist()):
                if same:
                    out.append(raw[a:z])
                elif turned:
                    out.append(b"".join((s, raw[y:z], p, raw[a:x], m, raw[x:y])))
                else:
                    out.append(b"".join((p, raw[a:x], s, raw[y:z], m, raw[x:y])))
            form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return src.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of. A reordered text holds no mark, and no mark can begin inside another,
    so the first of each is the right one."""
    outer = F.substring_index(output, marks[2], 1)
    middle = F.substring(output, F.length(outer) + len(marks[2]) + 1, F.length(output))

    def parts(first: str, second: str) -> tuple[Column, Column]:
        at = F.locate(second, outer)
        return F.substring(outer, F.lit(len(first) + 1), at - 1 - len(first)), F.substring(outer, at + len(second), F.length(outer))

    prefix, suffix = parts(marks[0], marks[1])
    turned_suffix, turned_prefix = parts(marks[1], marks[0])
    return F.when(form == "plain", output).when(form == "spm", F.concat(turned_prefix, middle, turned_suffix)).otherwise(F.concat(prefix, middle, suffix))
