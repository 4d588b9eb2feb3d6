"""N-gram Jaccard join by chosen paths.

Every text is the set of its word n-grams, embedded as a list of minima of hash functions: two sets
agree in a coordinate with the probability of their similarity, as both then chose the same n-gram.
A run starts with all sets and splits them by the n-gram chosen in one coordinate. A part that is
still large is split again by the n-grams of ``SPREAD`` further coordinates, picked by the path so far.
Small parts, parts whose members are alike on the whole, and what is still together after the last split
are compared set by set. Runs are
repeated until a pair at the threshold is met with the target probability."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.llm.buckets import bucket_links, link_counts
from tillcast.llm.common import WordHashes, fresh, hashed_words, map_texts, mix, text_bytes
from tillcast.llm.components import components

SPREAD = 2  # coordinates by which a large part is split: each set goes to so many children
PAIRS_OF_COORDINATES = 4  # that a level chooses from
LEAF = 64  # members of a part that is compared at once
DEPTH = 4  # splits
DENSE = 0.5  # mean similarity at which a large part is compared at once: splits would not part its members
COLUMNS = 4096  # shared n-grams in a comparison's matrix at once
NO_ID = -(1 << 63)


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair of this similarity has met with probability ``recall``, were every
    part on its way large and the runs independent: it must agree in the first coordinate and in one of each later split."""
    together = similarity * (1 - (1 - similarity) ** SPREAD) ** (DEPTH - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def shingles(texts: list[bytes], hashes: WordHashes, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of all texts, repeated ones included, and each text's first place
    (one more entry than texts). A text of fewer words has one n-gram, all its words; none if it has no word."""
    flat, starts = hashed_words(texts, hashes)
    n = np.diff(starts)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    begins = np.r_[0, np.cumsum(count)]
    place = np.repeat(starts[:-1], count) + np.arange(begins[-1]) - np.repeat(begins[:-1], count)
    length = np.repeat(np.minimum(n, words), count)
    out = np.zeros(len(place), np.uint64)
    for k in range(words):
        inside = length > k
        word = np.where(inside, flat[np.minimum(place + k, max(len(flat) - 1, 0))], np.uint64(0)) if len(flat) else out
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(k))
    return out, begins


def minima(texts: list[bytes], hashes: WordHashes, words: int, coordinates: int) -> np.ndarray:
    """One row per text of 64-bit minima; a text without words has zeros."""
    grams, begins = shingles(texts, hashes, words)
    out = np.zeros((len(texts), coordinates), np.uint64)
    some = np.flatnonzero(np.diff(begins))
    if len(some):
        rng = np.random.default_rng(20)
        factors = rng.integers(1, 1 << 62, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for c in range(coordinates):
            out[some, c] = np.minimum.reduceat(grams * factors[c], begins[some])
    return out


def jaccard_links(threshold: float, words: int):
    """The check of a unit of work: exact similarity of the n-gram sets of whole texts."""
    def verify(one: list[bytes], two: list[bytes]) -> np.ndarray:
        same = one is two
        texts = one if same else one + two
        grams, begins = shingles(texts, _HASHES, words)
        owner = np.repeat(np.arange(len(texts)), np.diff(begins))
        order = np.lexsort((owner, grams))
        grams, owner = grams[order], owner[order]
        new = np.r_[True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])] if len(grams) else np.ones(0, bool)
        grams, owner = grams[new], owner[new]
        size = np.bincount(owner, minlength=len(texts))
        column = np.cumsum(np.r_[False, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
        held = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
        column, owner = column[held], owner[held]
        column = np.cumsum(np.r_[False, column[1:] != column[:-1]]) if len(column) else column
        rows = slice(None) if same else slice(0, len(one))
        cols = slice(None) if same else slice(len(one), None)
        common = np.zeros((len(one), len(one if same else two)), np.float32)
        cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + COLUMNS, COLUMNS))
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                block = np.zeros((len(texts), COLUMNS), np.float32)
                block[owner[start:end], column[start:end] - column[start] // COLUMNS * COLUMNS] = 1
                common += block[rows] @ block[cols].T
        union = size[rows][:, None] + size[cols][None, :] - common
        return (common > 0) & (common >= threshold * union - 1e-6)
    return verify


_HASHES = WordHashes()


def jaccard_join(df: DataFrame, threshold: float = 0.8, words: int = 5, recall: float = 0.9999,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, class_id, n_links, component_id, kept``.

    ``class_id`` is the smallest id of the rows with the very same text; ``n_links`` counts the other rows
    whose word n-gram sets reach ``threshold``, those of the class included; ``component_id`` is the smallest
    id reachable by links; ``kept`` holds for one row of each component: the one with the smallest id, the
    first of them if that id is repeated.

    A null text is an empty one. Rows whose text has no word link with nothing, are a class and a component
    of their own and are all kept. A null id counts as smaller than all others. Other columns are not read.
    An empty table gives an empty result. Links within a class and links found are exact. ``recall`` sets the number of runs
    as if these were independent. They share the coordinates of a level, so at 0.9999 a pair at the threshold is missed
    with a probability of up to 2e-3 if all parts on its way are large (simulated), less often otherwise or if it is more
    similar. Nothing is capped."""
    def plain(c: str, name: str):
        return F.when(F.col(c) != NO_ID, F.col(c)).alias(name)

    return _rows(df, threshold, words, recall, id_col, text_col).select(
        plain("id", id_col), plain("class_id", "class_id"), "n_links", plain("component_id", "component_id"), "kept")


def keep_one(df: DataFrame, threshold: float = 0.8, words: int = 5, recall: float = 0.9999,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with all their columns, one for each group of near-duplicate texts (the one with
    the smallest id; of repeated rows one). Rows whose text has no word stay. Rules as in ``jaccard_join``."""
    keys = fresh(df, "key_id", "key_1", "key_2")
    winners = _rows(df, threshold, words, recall, id_col, text_col).filter("kept and k1 is not null").select(
        *[F.col(c).alias(k) for c, k in zip(("id", "k1", "k2"), keys)])
    keyed = df.withColumns(dict(zip(keys, _keys(id_col, text_col))))
    worded = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed.filter(worded).join(winners, keys, "left_semi").dropDuplicates(keys)
    return kept.drop(*keys).unionByName(df.filter(~worded))


def _keys(id_col: str, text_col: str) -> list:
    """Id, and two hashes that stand for the very text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _rows(df: DataFrame, threshold: float, words: int, recall: float, id_col: str, text_col: str) -> DataFrame:
    """``id, k1, k2, class_id, n_links, component_id, kept`` of every row; ``k1`` is null without words."""
    runs = runs_for(threshold, recall)
    coordinates = runs + (DEPTH - 1) * SPREAD * PAIRS_OF_COORDINATES

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = minima(batch.column(4).to_pylist(), _HASHES, words, coordinates)
            sig = [row.tobytes() if some else None for row, some in zip(found, found.any(axis=1).tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sig, pa.binary())], names=["id", "k1", "k2", "uid", "sig"])

    named = [c.alias(n) for c, n in zip(_keys(id_col, text_col), ("id", "k1", "k2"))]
    texts = df.select(*named, F.monotonically_increasing_id().alias("uid"), text_bytes(text_col).alias("data"))
    signed = materialise(map_texts(texts, sign, "id long, k1 long, k2 long, uid long, sig binary"))
    worded = signed.filter("sig is not null")
    classes = materialise(worded.groupBy("k1", "k2").agg(
        F.count("*").alias("weight"), F.min(F.struct("id", "uid")).alias("low"), F.min("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "weight", "low.id", "low.uid", "sig"))
    entries = _leaves(classes.select("node", "sig"), runs)
    # The texts of those classes that are to be compared, one each.
    chosen = classes.join(entries.select("node").distinct(), "node", "left_semi").select("node", "weight", "id", "k1", "k2")
    payload = (chosen.join(texts.select("id", "k1", "k2", "data"), ["id", "k1", "k2"])
               .dropDuplicates(["id", "k1", "k2"])
               .select("node", "weight", F.length("data").cast("long").alias("size"), "data"))
    links = bucket_links(entries, payload, jaccard_links(threshold, words))
    roots = components(links.filter("b is not null"))
    # A component's first row: the smallest (id, uid) of its classes.
    grouped = (classes.select("node", "k1", "k2", "weight", "id", "uid")
               .join(roots, "node", "left").join(link_counts(links), "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    firsts = grouped.groupBy("root").agg(F.min(F.struct("id", "uid")).alias("first"))
    per_class = materialise(grouped.join(firsts, "root").select(
        "k1", "k2", F.col("id").alias("class_id"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.col("first.id").alias("component_id"), F.col("first.uid").alias("first")))
    discard(entries, links, classes)
    found = worded.select("id", "k1", "k2", "uid").join(per_class, ["k1", "k2"]).select(
        "id", "k1", "k2", "class_id", "n_links", "component_id", (F.col("uid") == F.col("first")).alias("kept"))
    none = F.lit(None).cast("long")
    return found.unionByName(signed.filter("sig is null").select(
        "id", none.alias("k1"), none.alias("k2"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"), F.lit(True).alias("kept")))


def _leaves(classes: DataFrame, runs: int) -> DataFrame:
    """``bucket, node``: members of the parts that are to be compared. A node is in at most
    ``runs * SPREAD ** (DEPTH - 1)`` of them."""
    # The path already holds the choices made before; a run's first choice is in coordinate ``run``.
    level = classes.select("node", F.explode(F.array(*[
        F.xxhash64(F.lit(r), F.substring("sig", 8 * r + 1, 8)) for r in range(runs)])).alias("path"))
    leaves, kept = None, []
    for depth in range(DEPTH):
        kept.append(level := materialise(level))
        sizes = level.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        counted = level.join(sizes, "path")
        last = depth == DEPTH - 1
        small = (counted if last else counted.filter(F.col("n") <= LEAF)).select(F.col("path").alias("bucket"), "node")
        leaves = small if leaves is None else leaves.unionByName(small)
        if last:
            break
        large = counted.filter(F.col("n") > LEAF).select("path", "node")
        base = runs + depth * SPREAD * PAIRS_OF_COORDINATES
        pick = F.pmod(F.xxhash64(F.lit(-1), "path"), F.lit(PAIRS_OF_COORDINATES)).cast("int") * SPREAD + base
        split = materialise(large.join(classes, "node").withColumn("c", pick).select("path", "node", F.array(*[
            F.xxhash64("path", F.col("c") + s, F.expr(f"substring(sig, (c + {s}) * 8 + 1, 8)")) for s in range(SPREAD)]).alias("children")))
        # How often two members agree in a coordinate estimates their mean similarity.
        agree = split.groupBy("path", F.get("children", F.lit(0)).alias("child")).agg(F.count("*").cast("double").alias("n"))
        dense = agree.groupBy("path").agg((F.sum(F.col("n") * F.col("n")) / F.pow(F.sum("n"), 2)).alias("alike")).filter(F.col("alike") >= DENSE).select("path")
        kept.append(split)
        leaves = leaves.unionByName(split.join(dense, "path", "left_semi").select(F.col("path").alias("bucket"), "node"))
        level = split.join(dense, "path", "left_anti").select("node", F.explode("children").alias("path"))
    out = materialise(leaves.distinct())
    discard(*kept)
    return out
