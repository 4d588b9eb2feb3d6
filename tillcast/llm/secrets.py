"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over words.

The field tags every word as secret begin, inside or outside. Its features are the word's shape, the
neighbouring words and the file (language, source, size, braces). It is trained on a bounded sample. Its labels are
the matches of the patterns, with key words and exact shapes hidden in half of the windows, and secrets of other
forms (other key words, alphabets, prefixes and quotes) that are drawn and put into every eighth text without a match.
So it also finds what looks like a secret but fits no pattern. Tags are decoded by Viterbi."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.llm.common import CACHE_WORDS, map_texts

#: Texts from which the field is trained, those with the smallest hashes of their ids.
SAMPLE_TEXTS = 20_000
#: Windows of words that are fitted at most (a quarter with matches, a quarter with drawn secrets, half without either), and words in one.
SAMPLE_WINDOWS, WINDOW = 4_000, 24
FEATURES = 8192  # weights per tag; features share them by hash
STEPS = 60  # of the optimizer
PLANTED = 8  # one text of so many without a match is given a drawn secret
OUT, BEGIN, INSIDE = 0, 1, 2
KINDS = ("assign", "access", "hex", "crf")

KEY_WORDS = r"(password|passwd|secret|token|api_?key)"
ASSIGN = re.compile(KEY_WORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_HINT = re.compile(r"[0-9a-f]{24}")
HINT = re.compile(KEY_WORDS, re.IGNORECASE | re.ASCII)
NEAR_KEY = re.compile(r"pass|pwd|secret|token|key|auth|cred", re.IGNORECASE | re.ASCII)
WORD = re.compile(r"\S+")
EDGE = ".,;!?()[]\"'"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns' matches that are long enough."""
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def _exact(word: str) -> bool:
    """Whether a match of the patterns for access ids and hexadecimal runs may lie in this word, letters alone included."""
    return "AKIA" in word or len(word) >= 24 and bool(HEX_HINT.search(word))


def _hinted(word: str) -> bool:
    """Whether a match of a fixed pattern may begin or lie in this word."""
    return bool(HINT.search(word)) or _exact(word)


def shape(word: str) -> str:
    """Classes of characters, runs written once."""
    classes = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c if c in "+/_.=-:@" else "#" for c in word[:200]]
    return "".join(c for i, c in enumerate(classes) if i == 0 or c != classes[i - 1])[:12]


def plain_key(word: str) -> tuple | None:
    """What an ordinary word's features depend on; None for a word to be looked at closely, as any that is hinted."""
    core = word.strip(EDGE)
    if core.isalpha() and not NEAR_KEY.search(core) and not _exact(core):
        case = "a" if core.islower() else "A" if core.isupper() else "Aa" if core.istitle() else "mix"
        return case, min(len(core) // 4, 6), word[-1] in EDGE
    return None


def word_features(word: str) -> tuple[list[str], list[str]]:
    """Features of a word for its own tag, and for the tags of its neighbours."""
    key = plain_key(word)
    if key:
        return [f"plain{key[0]}", f"len{key[1]}"], [f"plain{key[0]}"]
    size = len(word)
    counts = Counter(word)
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    digits = sum(n for c, n in counts.items() if c.isdigit())
    uppers = sum(n for c, n in counts.items() if c.isupper())
    flips = sum(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:]))
    own = [f"shape{shape(word)}", f"odd{min(size // 4, 12)}", f"entropy{int(entropy * 2)}", f"digits{digits * 4 // size}",
           f"upper{uppers * 4 // size}", f"flips{min(flips, 8)}"]
    around = [f"end{word[-1] if not word[-1].isalnum() else 'x'}"]
    if NEAR_KEY.search(word):
        own.append("key")
        around.append("key")
    if "=" in word or ":" in word:
        own.append("sets")
        around.append("sets")
    if re.fullmatch(r"[0-9a-f]+", word.strip(EDGE)):
        own.append("hex")
    if re.fullmatch(r"[A-Z0-9]{12,}", word.strip(EDGE)):
        own.append("capitals")
    if "@" in word:
        own.append("at")
    if re.fullmatch(r"[\d.()+-]+", word.strip(EDGE)):
        own.append("number")
    return own, around


def file_features(text: str, lang: str | None, source: str | None) -> list[str]:
    return [f"lang{lang}", f"source{source}", f"size{len(text).bit_length()}", f"braces{'{' in text}"]


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def _features(own: list[str], before: list[str], after: list[str], file: list[str]) -> list[int]:
    return [_slot("w" + f) for f in own] + [_slot("p" + f) for f in before] + [_slot("n" + f) for f in after] + [_slot("f" + f) for f in file]


class Field:
    """A trained field: weights per feature and tag, and between tags (inside never follows outside)."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps
        # No path through other tags than outside gains more than this for a word, besides its own score, over the
        # one that is outside from there on: a step more than words is taken, from whatever tag.
        self.slack = float(2 * steps[steps > -1e3].max() - steps[OUT, OUT] - steps[:, OUT].min())

    @staticmethod
    def train(windows: list[tuple[list[list[int]], list[int]]]) -> Field:
        """Fits windows of (features of each word, tags) by maximum likelihood with a Gaussian prior."""
        n, length = len(windows), max(len(tags) for _, tags in windows)
        tags = np.zeros((n, length), np.int64)
        mask = np.zeros((n, length), bool)
        where, what = [], []
        for k, (features, own) in enumerate(windows):
            tags[k, :len(own)], mask[k, :len(own)] = own, True
            for t, f in enumerate(features):
                where += [k * length + t] * len(f)
                what += f
        where, what = np.array(where), np.array(what)
        banned = np.zeros((3, 3))
        banned[OUT, INSIDE] = -1e4
        start = np.array([0.0, 0.0, -1e4])
        theta = np.zeros(FEATURES * 3 + 9)
        gold = np.zeros_like(theta)
        flat = tags.ravel()
        np.add.at(gold, what * 3 + flat[where], 1)
        both = mask[:, 1:]
        np.add.at(gold, FEATURES * 3 + (tags[:, :-1] * 3 + tags[:, 1:])[both], 1)
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, STEPS + 1):
            w, between = theta[:-9].reshape(FEATURES, 3), theta[-9:].reshape(3, 3) + banned
            score = np.stack([np.bincount(where, w[what, y], n * length) for y in range(3)], axis=1).reshape(n, length, 3)
            ahead, back = np.zeros((n, length, 3)), np.zeros((n, length, 3))
            ahead[:, 0] = score[:, 0] + start
            for t in range(1, length):
                new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + between, axis=1) + score[:, t]
                ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
            for t in range(length - 2, -1, -1):
                new = np.logaddexp.reduce(between + (score[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
                back[:, t] = np.where(mask[:, t + 1, None], new, 0)
            total = np.logaddexp.reduce(ahead[:, -1], axis=1)
            node = np.exp(ahead + back - total[:, None, None]) * mask[..., None]
            pair = np.exp(ahead[:, :-1, :, None] + between + (score[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]) * both[..., None, None]
            expected = np.zeros_like(theta)
            weight = node.reshape(-1, 3)
            for y in range(3):
                expected[:-9][y::3] = np.bincount(what, weight[where, y], FEATURES)
            expected[-9:] = pair.sum(axis=(0, 1)).ravel()
            slope = (gold - expected) / n - 1e-3 * theta
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
            theta = theta + 0.2 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        return Field(theta[:-9].reshape(FEATURES, 3), theta[-9:].reshape(3, 3) + banned)

    def viterbi(self, score: np.ndarray) -> list[int]:
        """Best tags of a stretch of words with outside on either side."""
        best = self.steps[OUT] + score[0]
        came = []
        for row in score[1:]:
            options = best[:, None] + self.steps
            came.append(options.argmax(axis=0))
            best = options.max(axis=0) + row
        tag = int((best + self.steps[:, OUT]).argmax())
        tags = [tag]
        for back in reversed(came):
            tags.append(tag := int(back[tag]))
        return tags[::-1]


class Tagger:
    """Scores words by a field. Scores of a word are remembered; most words are plain and share theirs."""

    EDGE_ROW = 0  # what stands before the first and behind the last word

    def __init__(self, field: Field | None):
        self.field = field
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.plain: dict[tuple, int] = {}
        self.scores: list[np.ndarray] = []
        self.hints: list[bool] = []
        self._add([], ["edge"], False)
        self.table = np.empty((0, 9))

    def _add(self, own: list[str], around: list[str], hinted: bool) -> int:
        total = np.zeros(9)
        if self.field is not None:
            for at, (mark, names) in enumerate((("w", own), ("p", around), ("n", around))):
                for name in names:
                    total[3 * at:3 * at + 3] += self.field.weights[_slot(mark + name)]
        self.scores.append(total)
        self.hints.append(hinted)
        return len(self.scores) - 1

    def _row(self, word: str) -> int:
        key = plain_key(word)
        if key is None:
            return self._add(*word_features(word), _hinted(word))
        row = self.plain.get(key)
        if row is None:
            row = self.plain[key] = self._add(*word_features(word), False)
        return row

    def find(self, texts: list[str], files: list[list[str]]) -> list[tuple[list, list]]:
        """For each text the spans of the patterns, and all spans."""
        split = [t.split() for t in texts]
        used = {w for words in split for w in words}
        if len(self.rows) + len(used) > 2 * CACHE_WORDS or len(self.scores) > CACHE_WORDS:
            self._reset()
        for w in used.difference(self.rows):
            self.rows[w] = self._row(w)
        if len(self.table) != len(self.scores):
            self.table, self.hinted = np.stack(self.scores), np.array(self.hints)
        look = self.rows.__getitem__
        out = []
        for text, words, file in zip(texts, split, files):
            if not words:
                out.append(([], []))
                continue
            rows = np.fromiter(map(look, words), np.int64, len(words))
            base = base_spans(text) if self.hinted[rows].any() else []
            out.append((base, self._all(text, rows, file, base) if self.field is not None else base))
        return out

    def _all(self, text: str, rows: np.ndarray, file: list[str], base: list) -> list:
        field, table = self.field, self.table
        score = table[rows, :3].copy()
        score[1:] += table[rows[:-1], 3:6]
        score[:-1] += table[rows[1:], 6:9]
        score[0] += table[self.EDGE_ROW, 3:6]
        score[-1] += table[self.EDGE_ROW, 6:9]
        score += sum(field.weights[_slot("f" + f)] for f in file)
        gain = np.maximum(score[:, BEGIN], score[:, INSIDE]) - score[:, OUT] + field.slack
        stretches = _stretches(gain)
        if not stretches:
            return base
        places = [m.span() for m in WORD.finditer(text)]
        spans = []
        for first, end in stretches:
            begun = None
            for at, tag in enumerate([*field.viterbi(score[first:end]), OUT], first):
                if begun is not None and tag != INSIDE:
                    spans.append((places[begun][0], "crf", places[at - 1][1]))
                    begun = None
                if tag == BEGIN:
                    begun = at
        added = [s for s in spans if not any(s[0] < b[2] and b[0] < s[2] for b in base)]
        return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[1])))


def _stretches(gain: np.ndarray) -> list[tuple[int, int]]:
    """Ranges outside of which the best path surely stays outside. The end of a run of other tags can always be put
    outside instead, so from the last word of a best run the gains add up, to the left, to no less than nothing at
    each word of it. (Not so its beginning: what is left might have to begin where that costs much.) The ranges are
    all words so reached from any word; the highest sum that reaches a word is carried on."""
    out: list[tuple[int, int]] = []
    first = len(gain)
    for at in np.flatnonzero(gain >= 0)[::-1].tolist():
        if at >= first:
            continue
        first, end, total = at, at + 1, gain[at]
        while first > 0 and (more := max(total, 0.0) + gain[first - 1]) >= 0:
            first -= 1
            total = more
        out.append((first, end))
    return out[::-1]


DRAWN_KEYS = ("auth", "bearer", "credential", "credentials", "access_key", "private_key", "passphrase", "pwd", "dbPassword", "client_secret", "session", "signature")
DRAWN_BETWEEN = ("=", ":", " = ", ": ", " : ", " ", " is ", "=>")
ALPHABETS = (string.digits + "abcdef", string.digits + "ABCDEF", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
             string.ascii_letters + string.digits + "-_", string.ascii_uppercase + "234567")


def drawn_secret(draw: random.Random) -> str:
    """A secret of some form: with or without a key word before it, a prefix and quotes."""
    value = "".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(14, 48)))
    if draw.random() < 0.3:
        value = "".join(draw.choices(string.ascii_letters, k=draw.randint(2, 4))) + draw.choice("_-.") + value
    if draw.random() < 0.2:
        value += draw.choice(("=", "=="))
    quote = draw.choice(("", "", '"', "'"))
    value = quote + value + quote + draw.choice(("", "", "", ",", ";", ")"))
    return value if draw.random() < 0.4 else draw.choice(DRAWN_KEYS) + draw.choice(DRAWN_BETWEEN) + value


def training_windows(text: str, file: list[str], seed: int) -> list[tuple[list[list[int]], list[int], int]]:
    """Windows around the pattern matches of a text; without a match one around a drawn secret put between its words, or
    around an odd word (else any). With every window: 2 for a match, 1 for a drawn secret, 0 for neither."""
    words = [(m.group(), *m.span()) for m in WORD.finditer(text)]
    if not words:
        return []
    tags = [OUT] * len(words)
    starts = np.array([s for _, s, _ in words])
    centres = []
    for start, _, end in base_spans(text):
        first, last = int(np.searchsorted(starts, start, "right")) - 1, int(np.searchsorted(starts, end, "left")) - 1
        if tags[first] == OUT:
            tags[first] = BEGIN
            centres.append(first)
        for k in range(first + 1, last + 1):
            if tags[k] == OUT:
                tags[k] = INSIDE
    planted = not centres and seed % PLANTED == 0
    if planted:
        phrase, at = drawn_secret(random.Random(seed)).split(), seed // PLANTED % (len(words) + 1)
        words[at:at] = [(w, 0, 0) for w in phrase]
        tags[at:at] = [BEGIN] + [INSIDE] * (len(phrase) - 1)
        centres = [at]
    if not centres:
        odd = [k for k, (w, _, _) in enumerate(words) if plain_key(w) is None]
        centres = [odd[seed % len(odd)] if odd else seed % len(words)]
    out = []
    for n, centre in enumerate(centres):
        first = max(0, centre - WINDOW // 2)
        cut = words[first:first + WINDOW]
        hide = not planted and (seed + n) % 2 == 0  # learn from what is left without key word and exact shape
        named = [word_features(w) for w, _, _ in cut]
        if hide:
            named = [([f for f in own if tags[first + k] == OUT or f not in ("key", "sets", "hex", "capitals") and f[:5] != "shape"],
                      [f for f in around if f != "key"]) for k, (own, around) in enumerate(named)]
        edge = ["edge"]
        features = [_features(own, named[k - 1][1] if k else (edge if first == 0 else word_features(words[first - 1][0])[1]),
                              named[k + 1][1] if k + 1 < len(cut) else (edge if first + k + 1 == len(words) else word_features(words[first + k + 1][0])[1]), file)
                    for k, (own, _) in enumerate(named)]
        own_tags = tags[first:first + WINDOW]
        if own_tags[0] == INSIDE:
            own_tags[0] = BEGIN
        out.append((features, own_tags, 1 if planted else 2 if any(tags) else 0))
    return out


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> Field | None:
    """The field for these texts; None if the sample has no match of a pattern."""
    rank = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    limits = df.select(rank.alias("h")).orderBy("h").limit(SAMPLE_TEXTS).agg(F.max("h")).first()
    if limits[0] is None:
        return None

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, texts, langs, sources = (c.to_pylist() for c in batch.columns)
            keys, label, flat, sizes, tags = [], [], [], [], []
            for key, text, lang, source in zip(h, texts, langs, sources):
                for features, own, kind in training_windows(text, file_features(text, lang, source), key & 0xFFFFFFF):
                    keys.append(key)
                    label.append(kind)
                    flat.append([f for word in features for f in word])
                    sizes.append([len(word) for word in features])
                    tags.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(label, pa.int32()), *[
                pa.array(x, pa.list_(pa.int32())) for x in (flat, sizes, tags)]], names=["h", "label", "flat", "sizes", "tags"])

    chosen = df.withColumn("__h", rank).filter(F.col("__h") <= limits[0]).select(
        "__h", F.coalesce(text_col, F.lit("")), F.col(lang_col).cast("string"), F.col(source_col).cast("string"))
    found = materialise(map_texts(chosen, windows, "h long, label int, flat array<int>, sizes array<int>, tags array<int>"))
    rows = []
    for label, share in ((2, 4), (1, 4), (0, 2)):
        rows += found.filter(F.col("label") == label).orderBy("h", F.xxhash64("flat", "tags")).limit(SAMPLE_WINDOWS // share).collect()
    discard(found)
    if not rows or rows[0].label < 2:
        return None
    made = []
    for row in rows:
        cuts = np.r_[0, np.cumsum(row.sizes)].tolist()
        made.append(([row.flat[a:b] for a, b in zip(cuts, cuts[1:])], row.tags))
    return Field.train(made)


def scan(df: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans``, one row per input row.

    ``spans`` lists kind:start:end (code points) of the fixed patterns and of the field's finds that overlap
    none of them. A null text is an empty one without spans; null languages and sources are features of their
    own; null or repeated ids are passed through; an empty table gives an empty result. Without a field
    only the patterns are searched. Columns other than the four named are not read. No shuffle."""
    weights, steps = (None, None) if field is None else (field.weights, field.steps)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(None if weights is None else Field(weights, steps))
        for batch in batches:
            texts, langs, sources = (batch.column(k).to_pylist() for k in (1, 2, 3))
            found = tagger.find(texts, [file_features(*row) for row in zip(texts, langs, sources)])
            counts = [Counter(kind for _, kind, _ in every) for _, every in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS],
                pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([written(every) for _, every in found], pa.string()),
            ], names=[id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, F.coalesce(F.col(text_col), F.lit("")), F.col(lang_col).cast("string"), F.col(source_col).cast("string")),
                     work, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")
