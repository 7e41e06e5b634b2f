"""Mail corpora: one raw message per file, or per member of ZIP archives."""

from __future__ import annotations

import email
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.functions.text_cols import label_from_path, sender_domain

LOT_BYTES = 4 << 20  # raw messages that a task parses before it sends them on
SCANS = 64  # partitions of a file scan that one task reads

PARSED = "path string, headers map<string,string>, parts array<struct<type:string,text:string>>, text string"


def _decode(part) -> str:
    # undoes quoted-printable and base64; bytes that are no UTF-8 are dropped
    return (part.get_payload(decode=True) or b"").decode("utf-8", errors="ignore")


def _parse(path: str, raw: bytes) -> dict:
    msg = email.message_from_bytes(bytes(raw))
    leaves = [p for p in msg.walk() if not p.is_multipart()]
    parts = [{"type": p.get_content_type(), "text": _decode(p) if p.get_content_maintype() == "text" else None} for p in leaves]
    if msg.is_multipart():
        text = " ".join(p["text"] for p in parts if p["text"] is not None)
    else:
        text = _decode(msg)
    headers = {}
    for name, value in msg.items():
        headers.setdefault(name.lower(), str(value))
    return {"path": path, "headers": headers, "parts": parts, "text": text.strip()}


def _parsed(messages: Iterable[tuple[str, bytes]]) -> Iterator[pd.DataFrame]:
    """The parsed messages in lots of about LOT_BYTES of raw messages."""
    rows, held = [], 0
    for path, raw in messages:
        rows.append(_parse(path, raw))
        held += len(raw)
        if held >= LOT_BYTES:
            yield pd.DataFrame(rows, columns=["path", "headers", "parts", "text"])
            rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["path", "headers", "parts", "text"])


def parse_mail(df: DataFrame) -> DataFrame:
    """(path, headers, parts, text) from (path, content): header names in lower case, the first of a
    repeated header, the type of every part, and the text parts joined."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield from _parsed(zip(b["path"], b["content"]))

    return df.select("path", "content").mapInPandas(run, PARSED)


def with_mail_columns(parsed: DataFrame) -> DataFrame:
    """Label from the folder, sender, subject and domain; messages without text are dropped."""
    return parsed.where(F.col("text") != "").select(
        "path",
        label_from_path("path").alias("label"),
        F.col("headers")["subject"].alias("subject"),
        F.col("headers")["from"].alias("sender"),
        sender_domain(F.coalesce(F.col("headers")["from"], F.lit(""))).alias("sender_domain"),
        F.transform("parts", lambda p: p["type"]).alias("content_types"),
        "text",
    )


def read_mail(spark: SparkSession, root: str) -> DataFrame:
    """All messages under a folder tree."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
    # a scan counts every small file as 4 MB (spark.sql.files.openCostInBytes), so a task would get some thirty messages
    tasks = max(spark.sparkContext.defaultParallelism, files.rdd.getNumPartitions() // SCANS)
    return with_mail_columns(parse_mail(files.coalesce(tasks)))


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return open("/" + path[len("file:"):].lstrip("/"), "rb")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def read_mail_zip(spark: SparkSession, glob: str) -> DataFrame:
    """All messages in archives. One task lists each archive from its directory at the end of the file;
    the members are then spread over all tasks, each of which seeks to its own members, so a large
    archive is not one task's work and is never held whole. A member is parsed in the task that reads it."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["archive"]:
                with _open(path) as f, zipfile.ZipFile(f) as z:
                    names = [i.filename for i in z.infolist() if not i.is_dir()]
                yield pd.DataFrame({"archive": path, "member": names})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for archive, rows in b.groupby("archive"):
                with _open(archive) as f, zipfile.ZipFile(f) as z:
                    yield from _parsed((f"{archive}/{name}", z.read(name)) for name in rows["member"])

    archives = spark.read.format("binaryFile").load(glob).select(F.col("path").alias("archive"))
    listed = archives.mapInPandas(members, "archive string, member string")
    spread = listed.repartition("archive", "member")
    return with_mail_columns(spread.mapInPandas(read, PARSED))
