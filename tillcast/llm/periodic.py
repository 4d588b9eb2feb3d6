"""Periodic runs of words: stretches that repeat a block of words several times over.

A run of smallest period q that is at least ``MIN_EXPONENT`` times as long as q shows itself in the suffixes of its text:
those at its start s and at s + q agree in length - q >= (MIN_EXPONENT - 1) q words, and no suffix that begins between them
agrees as far (two periods of one stretch would leave a smaller one). So the words of a text are sorted as suffixes, and
suffixes that are neighbours in that order are united in the order of falling LCP (Kruskal's order, union-find). Each class
keeps its positions in text order. When two classes meet at an LCP, positions that become neighbours and lie no farther apart
than a third of it (for four periods) seed a run: it ends where their agreement ends, and the first seed of an
end and distance is its start. A seed whose stretch has a smaller period too belongs to the run of that period.

Only texts in which some five words in a row occur twice are sorted; every run contains such words. Texts of a batch are
sorted together: words of different texts are different symbols, and so suffixes of different texts never share a class."""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import fresh, map_texts, mix, text_bytes

MIN_LENGTH, MIN_EXPONENT = 6, 4
SLICE_WORDS = 200_000  # texts are sorted together up to so many words; a longer text alone
NUMBERED_WORDS = 300_000  # distinct words remembered between texts
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class _Numbers(dict):
    """Word to number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of non-negative numbers, the last of which occurs once. Prefix doubling: only suffixes
    whose rank is still shared are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)

    def first_of_group(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """The slot in which each group of equal keys begins."""
        new = np.r_[True, keys[1:] != keys[:-1]]
        return slots[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]

    rank[order] = first_of_group(symbols[order], np.arange(n))
    step = 1
    shared = np.arange(n)  # slots whose group may have more than one suffix
    while True:
        heads = rank[order[shared]]
        alone = np.r_[True, heads[1:] != heads[:-1]] & np.r_[heads[1:] != heads[:-1], True]
        shared = shared[~alone]
        if not len(shared):
            return order, rank
        at = order[shared]
        keys = rank[at] * n + rank[at + step]
        by = np.argsort(keys, kind="stable")
        order[shared] = at[by]
        rank[at[by]] = first_of_group(keys[by], shared)
        step *= 2


def neighbour_lcps(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Words in which each suffix agrees with the one before it in the order (0 for the first). Walking through the text,
    the agreement shrinks by one word at most."""
    s, sa, at = (array("q", x.astype(np.int64).tobytes()) for x in (symbols, order, rank))
    out = array("q", bytes(8 * len(s)))
    h = 0
    for i, r in enumerate(at):
        if r:
            j = sa[r - 1]
            while s[i + h] == s[j + h]:  # the last symbol occurs once and ends every agreement
                h += 1
            out[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return np.frombuffer(out, np.int64)


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs in non-negative numbers, the last of which occurs once; by start, then period."""
    order, rank = suffix_order(symbols)
    lcp = neighbour_lcps(symbols, order, rank)
    # A run's own agreement is length - period words.
    least = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))
    slots = np.flatnonzero(lcp >= max(least, 1))
    slots = slots[np.argsort(-lcp[slots], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def seed(i: int, j: int, agree: int) -> None:
        d = j - i
        if d * (min_exponent - 1) <= agree and d + agree >= min_length:
            key = j + agree, d
            if seeds.get(key, i) >= i:
                seeds[key] = i

    for one, two, agree in zip(order[slots - 1].tolist(), order[slots].tolist(), lcp[slots].tolist()):
        a, b = root(one), root(two)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        for x in small:  # neighbours in the other class: those two agree in just so many words
            k = bisect_left(large, x)
            if k:
                seed(large[k - 1], x, agree)
            if k < len(large):
                seed(x, large[k], agree)
        if len(small) <= 8:
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()  # two sorted pieces are merged
        parent[b] = a
        members[a] = large
    found, end, taken = [], -1, []
    for (e, d), i in sorted(seeds.items()):
        if e != end:
            end, taken = e, []
        if all(start > i for start in taken):  # else a smaller period reaches as far back
            taken.append(i)
            found.append((i, e - i, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _with_repeats(symbols: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Whether some ``width`` words in a row occur twice in a text (a clash of hashes may say so of a text where none do)."""
    n = len(starts) - 1
    text = np.repeat(np.arange(n), np.diff(starts))
    if len(symbols) < width:
        return np.zeros(n, bool)
    keys = mix(text[:len(symbols) - width + 1].astype(np.uint64))
    for k in range(width):
        keys = mix(keys + symbols[k:len(symbols) - width + 1 + k].astype(np.uint64))
    inside = text[:len(keys)] == text[width - 1:]
    keys, text = keys[inside], text[:len(keys)][inside]
    by = np.argsort(keys)
    keys, text = keys[by], text[by]
    out = np.zeros(n, bool)
    out[text[1:][keys[1:] == keys[:-1]]] = True
    return out


def text_runs(rows: list[list[int]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each row of word numbers."""
    starts = np.cumsum([0] + [len(r) for r in rows])
    symbols = np.fromiter((w for r in rows for w in r), np.int64, starts[-1])
    least = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))
    out: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    chosen = np.flatnonzero(_with_repeats(symbols, starts, max(least, 1)))
    if not len(chosen):
        return out
    parts = [symbols[starts[k]:starts[k + 1]] for k in chosen]
    top = int(symbols.max()) + 1
    parts = [part + np.int64(k * top) for k, part in enumerate(parts)]
    edges = np.cumsum([0] + [len(p) + 1 for p in parts])
    joined = np.concatenate([np.r_[p, len(parts) * top + k] for k, p in enumerate(parts)])
    for start, length, period in runs_of(joined, min_length, min_exponent):
        k = int(np.searchsorted(edges, start, side="right")) - 1
        out[chosen[k]].append((start - int(edges[k]), length, period))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period:start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(stay).tolist()])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per input row: ``id_col, n_words, runs, collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0 and compared byte by byte. A run is a stretch with smallest period q (words q
    apart are the same) of at least ``max(min_length, min_exponent * q)`` words that cannot be longer on either side;
    ``min_exponent`` is 3 or more. ``runs`` lists ``start, length, period`` by start, then period; ``collapsed`` is the text of
    the words that stay, joined by one space: a word goes if some run contains it after that run's first q words.

    A null or empty text has no words, no runs and an empty ``collapsed``. Null and repeated ids and repeated rows pass
    through, each row by itself; other columns are not read; an empty table gives an empty result. A very long text is
    sorted whole in one task: about 150 bytes a word, n log n steps in its words, whatever they are. No shuffle."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")

    def slices(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
        some, n = [], 0
        for text in texts:
            words = text.split()  # bytes split at exactly these six characters
            if some and n + len(words) > SLICE_WORDS:
                yield some
                some, n = [], 0
            some.append(words)
            n += len(words)
        yield some

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in batches:
            done = 0
            for rows in slices(batch.column(1).to_pylist()):
                if len(numbers) > NUMBERED_WORDS:
                    numbers = _Numbers()
                runs = text_runs([list(map(numbers.__getitem__, words)) for words in rows], min_length, min_exponent)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, len(rows)), pa.array(map(len, rows), pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs],
                             pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                    pa.array([_collapsed(w, r) for w, r in zip(rows, runs)], pa.binary()),
                ], names=["id", "n_words", "runs", "collapsed"])
                done += len(rows)

    kind = df.schema[id_col].dataType.simpleString()
    found = map_texts(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work,
                      f"id {kind}, n_words long, runs array<{RUN}>, collapsed binary")
    return found.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def longest_repeat(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period. Null without a run."""
    def better(a, b):
        x, y = b["length"] * a["period"], a["length"] * b["period"]
        return F.when(a.isNull() | (x > y), b).otherwise(a)
    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``n_runs``, the most repetitive run and digests of what ``periodic_runs`` found, one row per row."""
    best, = fresh(found, "best")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = found.withColumn(best, longest_repeat(F.col("runs")))
    b = F.col(best)
    return rows.select(
        id_col, "n_words", F.size("runs").cast("long").alias("n_runs"), b["start"].alias("start"), b["length"].alias("length"), b["period"].alias("period"),
        F.floor(F.expr(f"1000 * {best}.length div {best}.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def repeat_tails(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = 10) -> DataFrame:
    """The table with planted runs: with h the crc32 of the decimal id and g = h div ``one_in``, texts with h a multiple of
    ``one_in`` and n > 0 words get from word a = g % n on the words a .. a + p - 1 over and over, p = 1 + (n - a) div
    (3 + g % 8). Other texts, and rows without an id, stay as they are."""
    id_text = F.col(id_col).cast("string")
    h, g = F.crc32(id_text), F.expr(f"crc32(cast(`{id_col}` as string)) div {one_in}")

    def planted(words):
        n = F.size(words).cast("long")
        a = F.try_mod(g, n)
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    words = F.array_remove(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), "")
    long_enough = F.col(text_col).rlike("[^\\x20\\x09-\\x0D]")
    text = F.element_at(F.transform(F.array(words), lambda w: F.array_join(planted(w), " ")), 1)
    return df.withColumn(text_col, F.when((h % one_in == 0) & long_enough, text).otherwise(F.col(text_col)))
