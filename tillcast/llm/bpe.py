"""Byte-level BPE: encoding by a depth-first walk of a trie of words, and decoding.

For a fixed list of merges the encoding of a string is the one sequence of tokens in which every
two neighbours stay apart when they are encoded together. Hence the last token of a prefix is
settled by the prefix alone: it is the one vocabulary entry that ends the prefix and stays apart
from the last token of what precedes it. The distinct words of a batch are put into a trie, and a
depth-first walk gives every node its last token; a prefix that many words share is worked out once.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillcast.llm.common import map_texts, text_bytes

CACHE_WORDS = 500_000  # chunks, and words, that a worker remembers
END = -1  # marks the end of a word in a trie node; bytes are 0 to 255
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from 256 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Vocabulary, merges and added tokens of a ``tokenizers`` file with a byte-level BPE model."""

    #: Words of the byte-level pre-tokenizer, with the Unicode property in place of ``\\s``.
    WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()

        def raw(piece: str) -> bytes:
            return bytes(alphabet[c] for c in piece)

        vocab = spec["model"]["vocab"]
        self.ids = {raw(piece): i for piece, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.widths = {i: len(piece) for piece, i in self.ids.items()}
        self.moves: dict[int, int] = {}
        self._suffixes()
        self.pair_rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[a], vocab[b]
            self.pair_rank[pair] = rank
            made.setdefault(vocab[a + b], (rank, *pair))
        # The tokens that touch a token's right (left) end while it is being merged, oldest first,
        # each with the rank of the merge that made it.
        self.right_end: dict[int, list[tuple[int, int]]] = {}
        self.left_end: dict[int, list[tuple[int, int]]] = {}
        for i in sorted(self.ids.values(), key=lambda i: made.get(i, (-1,))[0]):
            rank, a, b = made.get(i, (-1, i, i))
            for ends, part in ((self.right_end, b), (self.left_end, a)):
                ends[i] = [*(ends[part] if part != i else []), (i, rank)]
        self.apart: dict[int, bool] = {}  # by first token << 32 | second
        self.pattern = regex.compile(self.WORDS)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        size = max([*self.ids.values(), *self.added.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for piece, i in self.ids.items():
            self.token_bytes[i] = piece
        for text, i in self.added.items():
            self.token_bytes[i] = text.encode()

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of both gives just these two tokens: replay the merges at
        their common border and see if one across it would come first (on equal ranks the left one does)."""
        key = a << 32 | b
        known = self.apart.get(key)
        if known is not None:
            return known
        left, right, i, j = self.right_end[a], self.left_end[b], 0, 0
        while True:
            across = self.pair_rank.get((left[i][0], right[j][0]), NEVER)
            next_a = left[i + 1][1] if i + 1 < len(left) else NEVER
            next_b = right[j + 1][1] if j + 1 < len(right) else NEVER
            if across < next_a and across <= next_b and across < NEVER:
                answer = False
                break
            if next_a == next_b == NEVER:
                answer = True
                break
            if next_a <= next_b:
                i += 1
            else:
                j += 1
        if len(self.apart) >= CACHE_WORDS:
            self.apart.clear()
        self.apart[key] = answer
        return answer

    def _suffixes(self) -> None:
        """An automaton over the vocabulary: a state is the longest string that begins a token and
        ends what was read; ``ends`` lists the tokens that end there, longest first."""
        step: dict[int, int] = {}  # state * 256 + byte
        ends: list[tuple[int, ...]] = [()]
        for piece in sorted(self.ids, key=len):
            state = 0
            for b in piece:
                to = step.get(state << 8 | b)
                if to is None:
                    to = step[state << 8 | b] = len(ends)
                    ends.append(())
                state = to
            ends[state] = (self.ids[piece],)
        shorter = [0] * len(ends)
        rows: dict[int, list[tuple[int, int]]] = {}
        for key, to in step.items():
            rows.setdefault(key >> 8, []).append((key & 255, to))
        queue = [to for _, to in rows.get(0, ())]
        for state in queue:  # grows while it is read: breadth first
            for b, to in rows.get(state, ()):
                back = shorter[state]
                while back and (back << 8 | b) not in step:
                    back = shorter[back]
                shorter[to] = step.get(back << 8 | b, 0)
                queue.append(to)
            ends[state] += ends[shorter[state]]
        self.step, self.ends, self.shorter = step, ends, shorter

    def _move(self, state: int, byte: int) -> int:
        back = state
        while back and (back << 8 | byte) not in self.step:
            back = self.shorter[back]
        to = self.step.get(back << 8 | byte, 0)
        if len(self.moves) >= CACHE_WORDS:
            self.moves.clear()
        self.moves[state << 8 | byte] = to
        return to

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of each distinct word."""
        root: dict = {}
        deepest = 0
        for word in words:
            deepest = max(deepest, len(word))
            node = root
            for b in word:
                child = node.get(b)
                if child is None:
                    child = node[b] = {}
                node = child
            node[END] = word
        out: dict[bytes, list[int]] = {}
        ends, widths, known, moves = self.ends, self.widths, self.apart, self.moves
        # By depth on the current branch: the prefix's last token, its bytes. Deeper places are left over from
        # other branches and are written before they are read.
        last, width = [None] * (deepest + 1), [0] * (deepest + 1)
        stack = [(1, 0, b, child) for b, child in root.items() if b != END]
        if END in root:
            out[b""] = []
        while stack:
            depth, state, byte, node = stack.pop()
            to = moves.get(state << 8 | byte)
            if to is None:
                to = self._move(state, byte)
            for token in ends[to]:
                n = widths[token]
                previous = last[depth - n]
                if previous is None:
                    break
                apart = known.get(previous << 32 | token)
                if apart or apart is None and self.stay_apart(previous, token):
                    break
            last[depth], width[depth] = token, n
            for b, child in node.items():
                if b != END:
                    stack.append((depth + 1, to, b, child))
                else:
                    path, at = [], depth
                    while at:
                        path.append(last[at])
                        at -= width[at]
                    out[child] = path[::-1]
        return out


class Encoder:
    """Encodes texts to packed 32-bit ids. What lies between single spaces is remembered, so a
    frequent chunk costs one look-up; a text in which white space meets a space, or that holds an
    added token, is cut by the pre-tokenizer's pattern as a whole."""

    def __init__(self, path: str):
        self.pairs = BytePairs(path)
        self.chunks: dict[str, bytes | None] = {}  # None: to be cut together with its neighbours
        self.words: dict[str, bytes] = {}

    def _cut(self, text: str) -> list[tuple[bool, str]]:
        """(is an added token, word) in order."""
        special, out, at = self.pairs.special, [], 0
        for m in special.finditer(text) if special else ():
            out += [(False, w) for w in self.pairs.pattern.findall(text[at:m.start()])]
            out.append((True, m.group()))
            at = m.end()
        return out + [(False, w) for w in self.pairs.pattern.findall(text[at:])]

    def _plain(self, chunk: str) -> bool:
        return bool(chunk) and not chunk[-1].isspace() and not (self.pairs.special and self.pairs.special.search(chunk))

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of distinct words; those seen lately are looked up."""
        new = words.difference(self.words)
        found = self.pairs.encode_words([w.encode() for w in new])
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words = {w: self.words[w] for w in words if w in self.words}
        for w, ids in found.items():
            self.words[w.decode()] = struct.pack(f"<{len(ids)}I", *ids)
        return self.words

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        findall, plain = self.pairs.pattern.findall, self._plain
        split = [t.split(" ") for t in texts]
        used = {c for chunks in split for c in chunks[1:]}
        new = used.difference(self.chunks)
        if len(self.chunks) + len(new) > CACHE_WORDS:
            self.chunks = {c: self.chunks[c] for c in used if c in self.chunks}
        cut = {c: [" " + c] if c.isalpha() else findall(" " + c) if plain(c) else None for c in new}
        # The first chunk has no space before it; texts with an odd chunk are cut as a whole.
        odd = {c for c, ws in cut.items() if ws is None} | {c for c in used if self.chunks.get(c, b"") is None}
        rest = [self._cut(text) if not plain(chunks[0]) or odd and not odd.isdisjoint(chunks[1:]) else None
                for text, chunks in zip(texts, split)]
        first = [[(False, w) for w in findall(chunks[0])] if ws is None else ws for chunks, ws in zip(split, rest)]
        words = {w for ws in cut.values() if ws for w in ws}
        words.update(w for ws in first for added, w in ws if not added)
        ids = self._words(words)
        special = {t: struct.pack("<I", i) for t, i in self.pairs.added.items()}
        for c, ws in cut.items():
            self.chunks[c] = None if ws is None else ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])
        look = self.chunks.__getitem__
        out = []
        for chunks, whole, ws in zip(split, rest, first):
            packed = b"".join([special[w] if added else ids[w] for added, w in ws])
            out.append(packed if whole is not None else packed + b"".join(map(look, chunks[1:])))
        return out

    def decode(self, packed: bytes) -> str:
        """Bytes of the tokens put together; malformed UTF-8 becomes U+FFFD."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.pairs.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` (binary, little-endian unsigned 32-bit), one row per input row.

    A null text is an empty one and gives no ids; a null or repeated id is passed through. Other
    columns, whatever their names, are not read. An empty table gives an empty result. No shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = own.encode([t.decode() for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, text_bytes(text_col).alias("text")), work, f"`{id_col}` {kind}, ids binary")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` from packed ids; null ids give an empty text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = [own.decode(b or b"") for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, ids_col), work, f"`{id_col}` {kind}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``id_col, n_tokens, ids_sha256, decoded_sha256``, so that
    neither the ids nor the texts are moved. Same rules as ``encode``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = own.encode([t.decode() for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(b) // 4 for b in ids], pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b in ids], pa.string()),
                pa.array([hashlib.sha256(own.decode(b).encode()).hexdigest() for b in ids], pa.string()),
            ], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, text_bytes(text_col).alias("text")), work,
                     f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
