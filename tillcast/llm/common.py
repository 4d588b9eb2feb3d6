"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text that Spark hands to Python at once. With texts of some kilobytes that is a few
#: megabytes; the default of 10,000 rows would hold a gigabyte where long documents cluster.
BATCH_ROWS = 500
#: Distinct words a worker remembers between batches; beyond it the memory starts again.
CACHE_WORDS = 300_000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, unless the session already has a smaller bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_texts(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` in batches of bounded size."""
    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def text_bytes(text_col: str = "text") -> Column:
    """The whole text as UTF-8 bytes; a null text counts as empty."""
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have, in whatever letter case."""
    used = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem.lower() in used:
            stem += "_"
        used.add(stem.lower())
        out.append(stem)
    return out


def column(name: str) -> Column:
    """A column by its very name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hashed_words(texts: Iterable[bytes], hashes: WordHashes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts one after another, and where each
    text begins (one more entry than texts). ``lower`` folds A-Z only."""
    parts, starts = [], [0]
    for text in texts:
        words = (text.lower() if lower else text).split()  # bytes split at exactly these six characters
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        starts.append(starts[-1] + len(words))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array(starts, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
