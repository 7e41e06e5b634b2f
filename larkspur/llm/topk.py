"""Exact top-k inner products by no-random-access aggregation.

Rows are dealt into blocks of vectors, and a block keeps, for each component, its rows in ascending order of
that component: read forwards or backwards, that is the list sorted by a query's product there. A row block goes
out once for each wave of query blocks, and the small query blocks of the wave come to it. In a pair, each query reads all lists side by side, in
rounds that double the depth (or, where the bounds still rule little out, go to the end). What a row has shown so far bounds its score: unseen products lie between the
list's last value and the value last read. When no more than k rows can reach the k-th best lower bound the
rest is out; lists are read on until the rows left are seen in full, as no list is ever looked up by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm.common import bucket_of
from larkspur.session import settle

ROWS, QUERIES = 8192, 512  # vectors of a block, on either side
WAVE = 32  # query blocks that meet a row block at a time
START = 16  # the first round reads a 16th of each list


def best(order: np.ndarray, value: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, score) of the rows that may be among the query's k best, scores exact and all ties included.

    order[i], value[i]: rows and their components, ascending, for component i.
    """
    d, n = order.shape
    back = query < 0
    product = value * query[:, None]
    least = np.where(back, product[:, -1], product[:, 0])
    depth = max(1, n // START)
    while depth < n and n > 4 * k:
        ids = np.where(back[:, None], order[:, :depth], order[:, n - depth:]).ravel()
        seen = np.where(back[:, None], product[:, :depth], product[:, n - depth:])
        edge = np.where(back, seen[:, -1], seen[:, 0])  # the value last read of each list
        low = np.bincount(ids, (seen - least[:, None]).ravel(), n) + least.sum()
        high = np.bincount(ids, (seen - edge[:, None]).ravel(), n) + edge.sum()
        bar = np.partition(low, n - k)[n - k]
        inside = high >= bar
        if 4 * np.count_nonzero(inside) < n and (np.bincount(ids, minlength=n)[inside] == d).all():  # outsiders cannot qualify, and those inside have been read to the end
            at = np.flatnonzero(inside)
            return at, np.rint(low[at])
        depth = 2 * depth if 4 * np.count_nonzero(inside) < n else n  # bounds that rule little out won't soon
    score = np.bincount(order.ravel(), product.ravel(), n)
    bar = np.partition(score, n - k)[n - k] if n > k else -np.inf
    at = np.flatnonzero(score >= bar)
    return at, score[at]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", rows: int = ROWS, per: int = QUERIES) -> DataFrame:
    """(query_id, rank int, vec_id, score long): for each row of `queries` the k rows of `vectors` of highest
    inner product over whole numbers, ties to the smaller id; the query's own id takes no part.

    Vectors hold whole numbers whose products and sums stay below 2^53. A query meets the vectors of its own
    length; null and empty ones, null or non-finite components and null ids take no part. Equal ids with equal
    vectors count as one row; an id with several vectors stands for all of them, and none is its own partner;
    fewer than k rows give all; an empty side gives no rows. Other columns are not read.
    """
    fine = lambda df: df.select(df[id_col].cast("long").alias("id"), df[vec_col].cast("array<double>").alias("v")).where(
        "id is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    ).dropDuplicates(["id", "v"])
    data, ask = settle(fine(vectors)), settle(fine(queries))
    n_rows, n_ask = -(-data.count() // rows), -(-ask.count() // per)
    if not n_rows or not n_ask:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    lists = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("vals", pa.binary())])

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t["id"].to_numpy()
        by = np.argsort(ids, kind="stable")
        return ids[by], np.array(t["v"].to_pylist(), np.float64).reshape(len(ids), -1)[by]

    def sort(t: pa.Table) -> pa.Table:
        ids, x = matrix(t)
        order = np.argsort(x.T, axis=1, kind="stable")
        return pa.table([[t["dim"][0].as_py()], [t["block"][0].as_py()], [ids.tobytes()], [order.astype("<i4").tobytes()], [np.take_along_axis(x.T, order, 1).tobytes()]], schema=lists)

    asked = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("q_ids", pa.binary()), ("q", pa.binary())])

    def gather(t: pa.Table) -> pa.Table:
        ids, x = matrix(t)
        return pa.table([[t["dim"][0].as_py()], [t["part"][0].as_py()], [ids.tobytes()], [x.tobytes()]], schema=asked)

    found = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(lists: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        for ids, order, vals in zip(*(lists[c].to_pylist() for c in ("ids", "rows", "vals"))):
            ids = np.frombuffer(ids, np.int64)
            order, vals = np.frombuffer(order, "<i4").reshape(-1, len(ids)), np.frombuffer(vals).reshape(-1, len(ids))
            for q_ids, q in zip(asks["q_ids"].to_pylist(), asks["q"].to_pylist()):
                q_ids = np.frombuffer(q_ids, np.int64)
                own = np.searchsorted(ids, q_ids, "right") - np.searchsorted(ids, q_ids, "left")  # ids ascend
                for who, x, mine in zip(q_ids.tolist(), np.frombuffer(q).reshape(len(q_ids), -1), own.tolist()):
                    at, score = best(order, vals, x, k + mine)  # more by the rows of the query's own id, which may all be among them
                    other = ids[at] != who
                    at, score = at[other], score[other]
                    top = np.lexsort((ids[at], -score))[:k]
                    out[0] += [who] * len(top)
                    out[1] += ids[at[top]].tolist()
                    out[2] += np.rint(score[top]).astype(np.int64).tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], schema=found)

    dim = F.size("v").cast("int").alias("dim")
    blocks = data.select("id", "v", dim, bucket_of(F.struct("id", "v"), n_rows).alias("block")).groupBy("dim", "block").applyInArrow(sort, "dim int, block int, ids binary, rows binary, vals binary")
    parts = ask.select("id", "v", dim, bucket_of(F.struct("id", "v"), n_ask).alias("part")).groupBy("dim", "part").applyInArrow(gather, "dim int, part int, q_ids binary, q binary")
    waves = -(-n_ask // WAVE)
    on = ["dim", "block", "wave"]
    cores = 4 * data.sparkSession.sparkContext.defaultParallelism  # few bytes and long work: not to be joined into fewer tasks
    blocks = blocks.withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1)))).repartition(cores, *on)
    sent = parts.withColumn("wave", F.floor(F.col("part") / WAVE).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).repartition(cores, *on)
    near = blocks.groupBy(*on).cogroup(sent.groupBy(*on)).applyInArrow(search, "query_id long, vec_id long, score long")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
