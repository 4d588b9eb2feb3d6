"""Comparing all members of many overlapping buckets, block by block.

A bucket may hold two members or a third of all: it is cut into blocks, and every pair of blocks is
one unit of work that Spark deals out by key. Inside a unit the members are compared by array
operations, and only sums and a spanning forest of the links leave it, never all pairs. Two members
may share several buckets; a link counts in the first of them only, so the sums are exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.llm.common import small_batches

BLOCK = 512  # members of a block
BLOCK_BYTES = 8 << 20  # bytes of a block, on average over a bucket's blocks
PAIRS = 1 << 18  # linked pairs whose bucket lists are compared at once

#: Gets the payloads of two blocks (the same list twice inside a block); returns which pairs link.
Verify = Callable[[list, list], np.ndarray]


def bucket_links(entries: DataFrame, payload: DataFrame, verify: Verify) -> DataFrame:
    """``a, b, n``: rows with b null give the number ``n`` of members linked to ``a`` (summed
    weights; several rows a member); the others are links that connect every linked group.

    ``entries``: long ``bucket, node``, without repeated rows. ``payload``: one row per node,
    ``node, weight, size`` (bytes) and ``data`` (binary). Nodes without payload are dropped."""
    # Buckets of the same members are compared once.
    sums = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                         F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).filter("n > 1")
    single = sums.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    kept = materialise(entries.join(single, "bucket"))
    own = kept.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))  # bounded by the runs
    members = materialise(own.join(payload, "node"))
    placed = kept.join(members.select("node", "size"), "node")
    blocks = placed.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).alias("blocks"))
    k, other = F.col("k"), F.col("other")
    units = (placed.join(blocks, "bucket")
             .select("bucket", "node", "blocks", F.pmod(F.xxhash64("node", "bucket"), "blocks").alias("k"))
             .select("bucket", "node", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("bucket", "node", "k", F.least(k, other).alias("i"), F.greatest(k, other).alias("j")))
    rows = (units.join(members.drop("size"), "node").repartition("bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j", "k", "node")
            .select("bucket", "i", "j", "k", "node", "weight", "buckets", "data"))
    small_batches(entries.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, i, j, unit in _units(batches):
            yield from _compare(bucket, i, j, unit, verify)

    links = materialise(rows.mapInArrow(work, "a long, b long, n long"))
    discard(kept, members)
    return links


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[pa.RecordBatch]]]:
    """Rows of one unit of work after another, from sorted batches; one unit is held at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            now = tuple(keys[start].tolist())
            if now != key and held:
                yield (*key, held)
                held = []
            key = now
            held.append(batch.slice(start, end - start))
    if held:
        yield (*key, held)


def _compare(bucket: int, i: int, j: int, unit: list[pa.RecordBatch], verify: Verify) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(unit)
    k, node, weight = (table.column(c).to_numpy() for c in (3, 4, 5))
    left = np.flatnonzero(k == i)
    right = left if i == j else np.flatnonzero(k == j)
    if not len(left) or not len(right):
        return
    data = table.column(7).to_pylist()
    one = [data[x] for x in left]
    linked = verify(one, one if i == j else [data[x] for x in right])
    if i == j:
        linked = np.triu(linked, 1)
    x, y = np.nonzero(linked)
    if not len(x):
        return
    x, y = left[x], right[y]
    forest = _forest(x, y, len(node))
    lists = table.column(6).to_pylist()
    wide = max(map(len, lists))
    padded = np.array([b + [b[-1]] * (wide - len(b)) for b in lists], np.int64)  # ascending
    first = np.concatenate([_counts_here(padded[x[s:s + PAIRS]], padded[y[s:s + PAIRS]], bucket) for s in range(0, len(x), PAIRS)])
    n = np.zeros(len(node), np.int64)
    np.add.at(n, x[first], weight[y[first]])
    np.add.at(n, y[first], weight[x[first]])
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.r_[node[some], node[x[forest]]]),
        pa.array(np.r_[np.zeros(len(some), np.int64), node[y[forest]]], mask=np.r_[np.ones(len(some), bool), np.zeros(len(forest), bool)]),
        pa.array(np.r_[n[some], np.zeros(len(forest), np.int64)], mask=np.r_[np.zeros(len(some), bool), np.ones(len(forest), bool)]),
    ], names=["a", "b", "n"])


def _counts_here(one: np.ndarray, two: np.ndarray, bucket: int) -> np.ndarray:
    """Whether ``bucket`` is the first bucket that both rows (ascending lists) hold."""
    free = np.ones(len(one), bool)
    for c in range(one.shape[1]):
        earlier = one[:, c] < bucket
        if not (earlier & free).any():
            continue
        free &= ~(earlier & (two == one[:, c:c + 1]).any(axis=1))
    return free


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Indexes of links that connect what all the links connect."""
    parent = list(range(n))
    out = []
    for at, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[a] = b
            out.append(at)
    return np.array(out, np.int64)


def link_counts(links: DataFrame) -> DataFrame:
    """``node, n``: linked members of each node that has any."""
    return links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
