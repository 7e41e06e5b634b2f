import random
import tracemalloc

import numpy as np
import pytest

from larkspur.llm import simhash
from larkspur.llm.common import pack_sorted, unpack_sorted
from larkspur.llm.queries import QUERIES
from tests.llm import brute


def got(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op3_simhash"](spark, sf)) == brute.simhash(rows)


def test_planted_bits(spark):
    """Chains of fingerprints at 1 to 6 bits: links at 4 or fewer, reached through others too."""
    rng = random.Random(3)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(4):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 6)):
                f ^= 1 << b
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    links = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 4]
    want = brute.components(len(fps), links)
    out = simhash.components(simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 4))
    root = {r["node"]: r["root"] for r in out.collect()}
    assert [root.get(f, f) for f in fps] == [fps[i] for i in want]


def test_odd_rows(spark):
    """Null and empty texts are fingerprint zero and link; repeated rows, null ids, clashing columns, a long text."""
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One two", "y"), (4, "One two", "y"), (5, "one TWO", "z"), (None, "one two", "q"), (6, "w " * 70000, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", simhash.F.lit("no"))
    out = sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str)
    zero = "0" * 16
    two, long = f"{brute.fingerprint('one two'):016x}", f"{brute.fingerprint('w ' * 70000):016x}"
    assert out == sorted([(1, zero, 1), (2, zero, 1), (3, zero, 1), (4, two, 4), (4, two, 4), (5, two, 4), (None, two, 4), (6, long, 6)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_packed_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        for top in (1, 300, 1 << 40, 1 << 63):
            x = np.sort(rng.integers(0, top, n, dtype=np.uint64))
            assert (unpack_sorted(pack_sorted(x)) == x).all()


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_variants_are_held_a_few_ranges_at_a_time(ranges):
    fps, masks, shift = np.random.default_rng(3).integers(0, 1 << 63, 4096).astype(np.uint64), simhash.ball(2), np.uint64(30)
    borders = np.array([(b << 34) // ranges for b in range(ranges)], np.uint64)
    few = fps[:50]
    got = list(simhash.runs_by_range(few, masks, shift, borders))
    want = np.sort(((few[:, None] ^ masks) * simhash.MIX >> shift).ravel())
    assert np.array_equal(np.concatenate([k for _, k in got]), want) and all(len(k) for _, k in got)
    assert all((np.searchsorted(borders, k, "right") - 1 == r).all() for r, k in got)
    if ranges == 40:
        tracemalloc.start()
        n = sum(len(k) for _, k in simhash.runs_by_range(fps, masks, shift, borders))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == 4096 * len(masks) and peak < 45e6  # all keys take 68 MB
