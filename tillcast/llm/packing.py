"""Packing documents into sequences along a space-filling curve.

Every document's tokens are counted into a hashed vector, which is projected at random to a few
dimensions; its place on the Hilbert curve through these is the sort key. Documents in this order,
one behind another, are cut into sequences, so a sequence holds documents that are alike, and only what
is left at the very end is shorter than a sequence."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillcast.functions.lineage import materialise
from tillcast.llm.bpe import BytePairs, byte_alphabet
from tillcast.llm.common import map_texts, mix

HASHED = 1024  # size of the hashed vectors
DIMENSIONS, BITS = 3, 16  # of the curve


class Ids:
    """Token ids as the ``tokenizers`` library gives them for a byte-level BPE file. Where the file's ids follow
    the merges' order, its vocabulary is run by tiktoken, which is some times faster."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in piece): i for piece, i in vocab.items() if piece not in added}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=BytePairs.WORDS, mergeable_ranks=ranks, special_tokens=added) if made == sorted(made) else None
        self.size = max([*vocab.values(), *added.values()]) + 1

    def of(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # white space beyond what its pattern engine can look back over
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of rows of whole numbers below 2 ** bits (Skilling's transform)."""
    x = [c.astype(np.int64) for c in points.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x = [c ^ turn for c in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | (c >> b & 1)
    return key


def curve_keys(ids: list[np.ndarray], slots: np.ndarray) -> np.ndarray:
    """Hilbert keys of token lists; ``slots`` maps a token to its place in the hashed vector."""
    rng = np.random.default_rng(4)
    axes = rng.standard_normal((HASHED, DIMENSIONS))
    vectors = np.stack([np.bincount(slots[i], minlength=HASHED) for i in ids])
    vectors = np.log1p(vectors)
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    projected = vectors @ axes / np.maximum(norm, 1e-12)
    cells = np.floor((1 << BITS) / (1 + np.exp(-1.702 * projected)))
    return hilbert(np.minimum(cells, (1 << BITS) - 1), BITS)


_IDS: dict[str, tuple[Ids, np.ndarray]] = {}


def pack(df: DataFrame, path: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its token ids and ``end_id``; every id lies in exactly one piece. All sequences hold exactly
    ``length`` ids except at the very end, where the rest is cut into powers of two, the largest first, so
    nothing is padded. A null text is an empty one and gives one piece of one id. Null and repeated ids are kept:
    each row is a document of its own. An empty table gives no pieces. Other columns are not read."""
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _IDS:
            own = Ids(path)
            _IDS[path] = own, (mix(np.arange(max(own.size, end_id + 1), dtype=np.uint64)) % np.uint64(HASHED)).astype(np.int64)
        own, slots = _IDS[path]
        kind = np.uint16 if len(slots) <= 1 << 16 else np.uint32
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = [own.of(t) for t in batch.column(2).to_pylist()]
            if not ids:
                continue
            data = [press.compress(np.r_[i, np.uint32(end_id)].astype(kind).tobytes()) for i in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(curve_keys(ids, slots)), pa.array([len(i) + 1 for i in ids], pa.int64()),
                pa.array([np.dtype(kind).itemsize] * len(ids), pa.int64()), pa.array(data, pa.binary())], names=["id", "uid", "key", "n", "width", "ids"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = total + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n), batch.column(1)], names=["uid", "part", "begin", "n"])
            total = int(ends[-1]) if len(ends) else total

    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tokens = materialise(map_texts(texts, tokenise, f"id {kind}, uid long, key long, n long, width long, ids binary"))
    # Only keys and lengths are sorted; a row's own number parts equal keys, so no key is too frequent.
    narrow = tokens.select("key", "uid", "n").repartitionByRange("key", "uid").sortWithinPartitions("key", "uid")
    placed = materialise(narrow.select("uid", "n").mapInArrow(place, "uid long, part long, begin long, n long"))
    totals = {r.part: r.n for r in placed.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row per partition
    bases, total = {}, 0
    for part in sorted(totals):
        bases[part], total = total, total + totals[part]
    full, rest = divmod(total, length)
    # Where the sequences of the rest begin, in ids behind the full ones.
    tail = [0]
    for b in range(rest.bit_length() - 1, -1, -1):
        if rest >> b & 1:
            tail.append(tail[-1] + (1 << b))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        ends_of_tail = np.array(tail, np.int64) + full * length
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, part, begin, n, width, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(unpress.decompress(data), f"<u{width}").astype("<u4")
                at, end = bases[part] + begin, bases[part] + begin + n
                done = 0
                while at < end:
                    if at < full * length:
                        sequence, offset = divmod(at, length)
                        stop = (sequence + 1) * length
                    else:
                        k = int(np.searchsorted(ends_of_tail, at, side="right")) - 1
                        sequence, offset, stop = full + k, at - int(ends_of_tail[k]), int(ends_of_tail[k + 1])
                    size = min(stop, end) - at
                    for column, value in zip(out, (doc, done, size, zlib.crc32(ids[done:done + size].tobytes()), n, sequence, offset)):
                        column.append(value)
                    done, at = done + size, at + size
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.column(0).type), *[pa.array(c, pa.int64()) for c in out[1:]]],
                                             names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    joined = tokens.select("id", "uid", "width", "ids").join(placed, "uid").select("id", "part", "begin", "n", "width", "ids")
    return joined.mapInArrow(cut, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
