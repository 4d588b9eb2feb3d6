"""Near-duplicate embeddings by lattice hashing.

A table projects the unit vectors at random to a few times eight dimensions and rounds every eight to
the nearest point of the E8 lattice; the points are the vector's cell. Near vectors mostly share the
cell or lie just across its border, so a vector also enters the neighbouring cells it is nearest to.
Vectors that share a cell of some table are compared by their exact cosine."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.llm.buckets import bucket_links, link_counts
from tillcast.llm.common import map_texts, mix
from tillcast.llm.components import components

TABLES = 6
POINTS = 2  # lattice points of a cell: 8 projected dimensions each
#: Lattice unit, in distances that a pair at the threshold has on average in eight projected dimensions.
UNIT = 1.9
PROBES = 6  # neighbouring cells that a vector also enters, per table
NO_ID = -(1 << 63)


def roots() -> np.ndarray:
    """The 240 shortest lattice vectors: two coordinates of +-1, or all +-1/2 with an even number of minus signs."""
    whole = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-1.0, 1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [np.array(s) / 2 for s in itertools.product((-1.0, 1.0), repeat=8) if s.count(-1.0) % 2 == 0]
    return np.array(whole + half)


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row: E8 is D8 (whole numbers of even sum) and D8 moved by one half."""
    def even(y: np.ndarray) -> np.ndarray:
        z = np.rint(y)
        odd = np.flatnonzero(z.sum(axis=1) % 2 != 0)
        off = y[odd] - z[odd]
        worst = np.abs(off).argmax(axis=1)
        z[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        return z

    a, b = even(x), even(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


_ROOTS = roots()


def _hash(points: np.ndarray, start: int) -> np.ndarray:
    out = np.full(len(points), start, np.uint64)
    for c in range(points.shape[1]):
        out = mix(out * np.uint64(31) + (points[:, c] * 2).astype(np.int64).view(np.uint64))
    return out


def lattice_unit(threshold: float, dim: int) -> float:
    return UNIT * math.sqrt(2 - 2 * threshold) * math.sqrt(8 / max(dim, 8))


def cells(unit: np.ndarray, tables: int, points: int, scale: float, probes: int) -> np.ndarray:
    """One row per unit vector: the hashes of its own cell and of ``probes`` neighbouring cells of each table."""
    n, dim = unit.shape
    out = []
    for t in range(tables):
        rng = np.random.default_rng(1000 + t)
        axes = np.linalg.qr(rng.standard_normal((max(dim, 8 * points), 8 * points)))[0][:dim]
        x = unit @ axes / scale
        own = [nearest_point(x[:, 8 * p:8 * p + 8]) for p in range(points)]
        hashed = [_hash(o, 2 * t + 1 + 64 * p) for p, o in enumerate(own)]
        out.append(np.bitwise_xor.reduce(hashed))
        # A step by root r brings the point nearer the smaller |r|^2 - 2 r.(x - point) is.
        gain = np.concatenate([(x[:, 8 * p:8 * p + 8] - own[p]) @ _ROOTS.T for p in range(points)], axis=1)
        best = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        for k in range(probes):
            p, r = np.divmod(best[:, k], len(_ROOTS))
            cell = out[t * (probes + 1)].copy()
            for q in range(points):
                rows = np.flatnonzero(p == q)
                cell[rows] ^= hashed[q][rows] ^ _hash(own[q][rows] + _ROOTS[r[rows]], 2 * t + 1 + 64 * q)
            out.append(cell)
    return np.stack(out, axis=1)




def cosine_links(threshold: float):
    def verify(one: list[bytes], two: list[bytes]) -> np.ndarray:
        # A bucket's vectors have one label but may, by a rare clash of hashes, differ in length.
        a, b = (([np.frombuffer(x, np.float64) for x in side]) for side in (one, two))
        out = np.zeros((len(a), len(b)), bool)
        for size in {len(x) for x in a} & {len(x) for x in b}:
            i, j = (np.flatnonzero([len(x) == size for x in side]) for side in (a, b))
            out[np.ix_(i, j)] = np.stack([a[k] for k in i]) @ np.stack([b[k] for k in j]).T >= threshold
        return out
    return verify


def near_vectors(df: DataFrame, threshold: float = 0.93, tables: int = TABLES, points: int = POINTS,
                 probes: int = PROBES, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Two vectors link when their labels are equal and not null and their cosine in double precision is at
    least ``threshold``. A vector that is null, empty, all zeros, or holds a null or a value that is not finite
    links with nothing, nor does a row without a label. Vectors of different lengths never link. Equal
    vectors of a label are compared once and counted each. ``component_id`` is the smallest id reachable;
    ``kept`` is ``id = component_id`` (a null id, which sorts first, is its own component and kept). A row whose
    id is repeated is a row of its own: both are counted. Other columns are not read; an empty table gives an
    empty result. Links found are exact; pairs that share no cell are missed (see the README for the recall)."""
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            data, hashes = [None] * len(vectors), [None] * len(vectors)
            sizes: dict[int, list[int]] = {}
            for i, (v, label) in enumerate(zip(vectors, batch.column(1).is_valid().to_pylist())):
                if label and v and None not in v:
                    sizes.setdefault(len(v), []).append(i)
            for rows in sizes.values():
                x = np.array([vectors[i] for i in rows], np.float64)
                with np.errstate(all="ignore"):
                    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
                    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                good = np.flatnonzero(np.isfinite(x).all(axis=1))
                if len(good):
                    found = cells(x[good], tables, points, lattice_unit(threshold, x.shape[1]), probes).view(np.int64)
                    for g, h in zip(good.tolist(), found):
                        data[rows[g]], hashes[rows[g]] = x[g].tobytes(), h
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary()),
                                              pa.array(hashes, pa.list_(pa.int64()))], names=["id", "label", "data", "cells"])

    label_kind = df.schema[label_col].dataType.simpleString()
    rows = materialise(map_texts(df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                                           F.col(vector_col).alias("vector")), prepare,
                                 f"id long, label {label_kind}, data binary, cells array<bigint>"))
    good = rows.filter("data is not null")
    key = ["label", "k1", "k2"]
    keyed = good.select("id", "label", F.xxhash64("data").alias("k1"), F.xxhash64(F.lit(1), "data").alias("k2"), "data", "cells")
    classes = materialise(keyed.groupBy(*key).agg(
        F.count("*").alias("weight"), F.min(F.coalesce("id", F.lit(NO_ID))).alias("low"), F.min("data").alias("data"), F.first("cells").alias("cells"))
        .withColumn("node", F.monotonically_increasing_id()))
    entries = materialise(classes.select("node", "label", F.explode(F.array_distinct("cells")).alias("cell")).select(
        F.xxhash64("label", "cell").alias("bucket"), "node").distinct())
    payload = classes.select("node", "weight", F.length("data").cast("long").alias("size"), "data")
    links = bucket_links(entries, payload, cosine_links(threshold))
    grouped = (classes.select(*key, "node", "weight", "low").join(components(links.filter("b is not null")), "node", "left")
               .join(link_counts(links), "node", "left").withColumn("root", F.coalesce("root", "node")))
    lows = grouped.groupBy("root").agg(F.min("low").alias("component"))
    per_class = materialise(grouped.join(lows, "root").select(
        *key, (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component"))
    discard(entries, links, classes)
    found = keyed.select("id", *key).join(per_class, key).select("id", "n_links", "component")
    alone = rows.filter("data is null").select("id", F.lit(0).cast("long").alias("n_links"), F.coalesce("id", F.lit(NO_ID)).alias("component"))
    component = F.when(F.col("component") != NO_ID, F.col("component"))
    return found.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
