"""Token counts under a SentencePiece BPE model, by merging arrays rank by rank.

No piece of the model has its word mark behind another character, so no merge crosses from a
character to the word mark after it: a text is cut there into pre-tokens whose counts add up. The
distinct pre-tokens of a batch lie one behind another in one array of symbols. Each step finds for
every pre-token the best-ranked pair of neighbours, the leftmost of equals, applies all these
merges at once and takes out the symbols that were merged away; pre-tokens without a pair are done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tillcast.llm.common import CACHE_WORDS, map_texts, text_bytes

MARK = "▁"  # what SentencePiece puts for a space
NO_PAIR = np.int32(2**31 - 1)
#: A pre-token with more symbols than this is merged by itself, in place, so that its steps cost no
#: copy of the array.
LONG = 512
#: Symbols merged together at most; bounds the arrays of a batch.
SYMBOLS = 2_000_000


class PieceCounter:
    """Counts tokens as ``SentencePieceProcessor(model_file=path).encode(text)`` does."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.encode("a  b", out_type=str)[0][:1] != MARK or model.encode(" ") == []:
            raise ValueError("the model must put a leading word mark and keep white space")
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = model.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a word mark behind other characters")
        # Symbols: all pieces and single characters of pieces; a merge's rank orders by falling score.
        names = sorted(pieces.keys() | {c for p in pieces for c in p})
        number = {p: i for i, p in enumerate(names)}
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        pairs = {}
        for piece, score in pieces.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (order[score], number[piece])
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in sorted(pairs)], np.int32)
        self.pair_made = np.array([pairs[k][1] for k in sorted(pairs)], np.int32)
        self.unknown = len(names)  # symbols from here on: characters outside the model, by UTF-8 length
        self.tokens = np.array([1 if p in pieces else len(p.encode()) for p in names] + [0, 1, 2, 3, 4], np.int64)
        self.symbol = np.full(0x110000, self.unknown + 4, np.int32)
        for first, size in ((0x10000, 3), (0x800, 2), (0x80, 1)):
            self.symbol[:first] = self.unknown + size
        for name, i in number.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        self.counts: dict[str, int] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the symbol it becomes."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_rank[at], NO_PAIR), np.where(hit, self.pair_made[at], 0)

    def count_words(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token, which already has its word mark."""
        total = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > LONG).tolist():
            total[k] = self._count_long(words[k])
        short = np.flatnonzero((sizes > 0) & (sizes <= LONG))
        part = np.cumsum(sizes[short]) // SYMBOLS
        for p in np.unique(part):
            chosen = short[part == p]
            total[chosen] = self._count_ragged([words[k] for k in chosen.tolist()], sizes[chosen])
        return total

    def _symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]

    def _count_ragged(self, words: list[str], sizes: np.ndarray) -> np.ndarray:
        total = np.zeros(len(words), np.int64)
        sym = self._symbols("".join(words))
        owner = np.arange(len(words))  # of each row: the word
        start = np.cumsum(sizes) - sizes
        rank, made = self._pair_columns(sym, start, sizes)
        while len(owner):
            best = np.minimum.reduceat(rank, start)
            done = best == NO_PAIR
            if done.any():  # count and take out the rows that are finished
                total[owner[done]] = np.add.reduceat(self.tokens[sym], start)[done]
                stay = np.repeat(~done, sizes)
                sym, rank, made = sym[stay], rank[stay], made[stay]
                owner, sizes, best = owner[~done], sizes[~done], best[~done]
                start = np.cumsum(sizes) - sizes
                if not len(owner):
                    break
            # The leftmost best pair of each row.
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            row = np.searchsorted(start, hits, side="right") - 1
            at = hits[np.r_[True, row[1:] != row[:-1]]]
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # place after the removal: one symbol less for each row before
            sym, rank, made = sym[keep], rank[keep], made[keep]
            sizes = sizes - 1
            start = np.cumsum(sizes) - sizes
            # Only the pairs to the left and right of a new symbol change.
            for left in (moved, moved[moved > start] - 1):
                right = left + 1
                row_end = np.searchsorted(start, left, side="right")
                inside = right < np.r_[start, len(sym)][row_end]
                rank[left], made[left] = NO_PAIR, 0
                rank[left[inside]], made[left[inside]] = self._ranks(sym[left[inside]], sym[right[inside]])
        return total

    def _pair_columns(self, sym: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(sym), NO_PAIR, np.int32), np.zeros(len(sym), np.int32)
        if len(sym) > 1:
            rank[:-1], made[:-1] = self._ranks(sym[:-1], sym[1:])
        rank[start + sizes - 1] = NO_PAIR
        return rank, made

    def _count_long(self, word: str) -> int:
        """The same merges for one long row: ranks stay in place, merged symbols are skipped by links,
        and the best pair is looked for in blocks whose own best is known."""
        sym = self._symbols(word)
        n = len(sym)
        rank, made = self._pair_columns(sym, np.zeros(1, np.int64), np.array([n]))
        block = max(64, int(n ** 0.5))
        size = -(-n // block) * block
        rank = np.r_[rank, np.full(size - n, NO_PAIR, np.int32)]
        best = rank.reshape(-1, block).min(axis=1)
        nxt, prev = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)

        def touch(at: int) -> None:
            right = nxt[at]
            rank[at] = NO_PAIR
            if right < n:
                r, m = self._ranks(sym[at:at + 1], sym[right:right + 1])
                rank[at], made[at] = r[0], m[0]

        while True:
            b = int(best.argmin())
            if best[b] == NO_PAIR:
                return int(self.tokens[sym[alive]].sum())
            at = b * block + int(rank[b * block:(b + 1) * block].argmin())
            gone = int(nxt[at])
            sym[at] = made[at]
            alive[gone] = False
            nxt[at] = nxt[gone]
            if nxt[gone] < n:
                prev[nxt[gone]] = at
            rank[gone] = NO_PAIR
            touch(at)
            changed = {b, gone // block}
            if prev[at] >= 0:
                touch(int(prev[at]))
                changed.add(int(prev[at]) // block)
            for k in changed:
                best[k] = rank[k * block:(k + 1) * block].min()

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        rows = [self._cut(t) if t else [] for t in texts]
        used = {w for row in rows for w in row}
        new = list(used.difference(self.counts))
        if len(self.counts) + len(new) > 2 * CACHE_WORDS:
            self.counts = {w: self.counts[w] for w in used if w in self.counts}
        self.counts.update(zip(new, self.count_words([MARK + w if w[:1] != MARK else w for w in new]).tolist()))
        look = self.counts.__getitem__
        return [sum(map(look, row)) for row in rows]

    @staticmethod
    def _cut(text: str) -> list[str]:
        """Pre-tokens. One that begins with a single mark is written without it, so that most texts
        are just split at their spaces; runs of marks are put in front of what follows."""
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            return words
        out, marks = [], 0
        for word in words:
            marks += 1
            if word:
                out.append(word if marks == 1 else MARK * marks + word)
                marks = 0
        return out + [MARK * marks] if marks else out


_COUNTERS: dict[str, PieceCounter] = {}


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens), one row per input row.

    A null text is an empty one with no tokens; null or repeated ids are passed through; other columns
    are not read; an empty table gives an empty result. No shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = PieceCounter(path)
        counter = _COUNTERS[path]
        for batch in batches:
            raw = batch.column(1).to_pylist()
            n = counter.count([b.decode() for b in raw])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(n, pa.int64()),
                pa.array([k > limit for k in n], pa.bool_()),
            ], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, text_bytes(text_col).alias("text")), work,
                     f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
