"""Toxicity by weak supervision.

Voters look at the words of a text: words of a lexicon, patterns of spelling, and stems (beginnings of words) that stand out in the
labelled texts. A vote is whether the voter finds its kind of word, for some voters so and so often. A generative label model with one hidden class
estimates, over all documents it may learn from, how often each voter votes in toxic and in clean texts and how votes
hang together beyond that: expectation-maximisation over the distinct sets of votes, started from and held near the rates in the
labelled texts. A voter that finds nothing says nothing, as most know one language only; that none finds anything is a vote of its own. Voters that say the same thing (correlated within a class) share their weight. The model's posteriors, not the
labels, are what a sparse linear classifier is trained on; it also weighs beginnings of words that are no voters.

All learning from texts one by one uses the labelled sample (``SAMPLE_ROWS`` of each class at most); the label model's counts cover
every document that ``learn`` marks."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.functions.sums import added_up
from tillcast.llm.common import CACHE_WORDS, map_texts, text_bytes

#: Insults, as prior knowledge; whole words in lower case.
LEXICON = (
    "abschaum arsch arschloch asshole bastard bastardo basura bitch bloody cabron cerdo clown connard crap creep cretin cretino cretin dreck "
    "dumb dumm dumme dummkopf débile escoria estúpido estúpida fool freak garbage gilipollas hate idiot idiota idiote idioten imbecile imbécil "
    "imbécile inútil jerk kill lächerlich loser merde mierda minable moron nul ordure pathetic patético payaso pig pute rat salaud scheisse "
    "scheiße schwein scum shit stupid stupide stupidity trash trottel ugly versager worthless disgusting").split()
#: Spellings that may go with insults: name and what is looked for in a piece of text without white space.
SPELLINGS = (
    ("stretched", re.compile(r"([^\W\d_])\1{3}")),
    ("shouted", re.compile(r"\A[A-Z]{4,}[!?.,;]*\Z")),
    ("exclaimed", re.compile(r"!!")),
    ("censored", re.compile(r"\A[^\W\d_]+[*#$@%]+[^\W\d_]")),
    ("digits", re.compile(r"\A[^\W\d_]+[0134578]+[^\W\d_]+\Z")),
)
STRETCHED = SPELLINGS[:1]
ENDS = "!?.,;:'\"()"  # what mostly stands around a word
SAMPLE_ROWS = 10_000  # labelled rows of each class
LENGTHS = range(3, 9)  # letters of a beginning
LEVELS = (1, 2, 3, 4, 6)  # how often a word or beginning is found, at least
LONG = (300, 1000, 3000, 10_000)  # words of a text, at least: where more is found by chance
CANDIDATES, STEMS = 3000, 200  # words and beginnings that the classifier may weigh, and those of them that vote
LIFT = 4  # times as frequent in toxic as in clean texts at least is what votes
ROUNDS, SETTLED = 12, 1e-4
HELD = 1.0  # weight of the rates in the labelled texts against those in all documents, at every size
DEPENDENT = 0.5  # correlation within a class from which voters share their weight
FLUSH = 400_000  # entries a task counts before it hands them on
LONGEST = 64  # bytes of a piece that is remembered
SHINGLE = 5  # words of a shingle
PIECE = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    low = text.lower()
    word = low.strip(ENDS)
    return [word] if word.isalpha() else PIECE.findall(low)


def spellings(text: str) -> list[str]:
    word = text.strip(ENDS)
    plain = word.isalpha() and not word.isupper() and "!!" not in text  # as most are: then there is but one to look for
    return ["~" + name for name, pattern in (STRETCHED if plain else SPELLINGS) if pattern.search(text)]


def marks(piece: bytes) -> list[str]:
    """All that a piece of text without white space could be found by: ``=word``, ``^beginning``, ``~spelling``; a name for
    each time it is there."""
    text = piece.decode("utf-8", "replace")
    out = []
    for word in words_of(text):
        out.append("=" + word)
        out += ["^" + word[:k] for k in LENGTHS if len(word) >= k]
    return out + spellings(text)


def feature(mark: str, level: int) -> str:
    """The name of a mark that is found ``level`` times or more."""
    return f"{mark}#{level}"


def mark_of(name: str) -> str:
    return name.rpartition("#")[0]


class _Finder(dict):
    """Piece of text to the numbers of the marks it has, remembered up to ``CACHE_WORDS`` pieces."""

    def __init__(self, names: Sequence[str]):
        super().__init__()
        self.number: dict[str, int] = {}
        self.levels: list[list[tuple[int, int]]] = []  # of each mark: how often, and the place of that name
        for k, name in enumerate(names):
            mark, _, level = name.rpartition("#")
            if mark not in self.number:
                self.number[mark] = len(self.levels)
                self.levels.append([])
            self.levels[self.number[mark]].append((int(level), k))
        self.words = self.number.get("|")
        self.heads = {m[1:1 + LENGTHS[0]] for m in self.number if m[0] in "=^"}  # most words begin like none of the marks

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        text = piece.decode("utf-8", "replace")
        hopeful = any(word[:LENGTHS[0]] in self.heads for word in words_of(text))
        found = tuple(self.number[m] for m in (marks(piece) if hopeful else spellings(text)) if m in self.number)
        if len(piece) <= LONGEST:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = found
        return found

    def found(self, text: bytes) -> list[int]:
        """The places of the names that the text has."""
        pieces = text.split()
        counts: dict[int, int] = {} if self.words is None else {self.words: len(pieces)}
        often = Counter(pieces)
        for some, n in zip(map(self.__getitem__, often), often.values()):
            for m in some:
                counts[m] = counts.get(m, 0) + n
        return sorted(k for m, n in counts.items() for level, k in self.levels[m] if n >= level)


class LabelModel(NamedTuple):
    """Share of toxic texts, rates of votes by class (rows: clean, toxic), weight of each voter for its correlations."""
    share: float
    rates: np.ndarray
    weights: np.ndarray

    def log_odds(self) -> tuple[float, np.ndarray]:
        """The posterior's log odds are the first number plus those of the votes."""
        clean, toxic = self.rates
        return math.log(self.share / (1 - self.share)), self.weights * np.log(toxic / clean)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Of rows of votes (0 or 1)."""
        base, each = self.log_odds()
        return 1 / (1 + np.exp(-np.clip(base + votes @ each, -500, 500)))


class Classifier(NamedTuple):
    """Names of features, their weights, and the intercept."""
    names: Sequence[str]
    weights: np.ndarray
    intercept: float


def g2(a: float, b: float, n_a: float, n_b: float) -> float:
    """Log-likelihood ratio of a of n_a against b of n_b at one common rate."""
    rate = (a + b) / (n_a + n_b)
    parts = ((a, n_a * rate), (n_a - a, n_a * (1 - rate)), (b, n_b * rate), (n_b - b, n_b * (1 - rate)))
    return 2 * sum(o * math.log(o / e) for o, e in parts if o > 0 and e > 0)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic`` of at most ``rows`` ids of each class, those with the smallest hashes, one text for each id. Ids that are null
    or labelled both ways are left out. Near copies would make their words stand out, so of the texts of a class whose
    shingles have the same smallest hash (mostly those alike) one stays."""
    id_ = F.col("doc_id")
    once = (labels.filter(id_.isNotNull() & F.col("toxic").isin(0, 1)).groupBy(id_).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high"))
            .filter("toxic = high").select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    present = once.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    kept = materialise(present)
    few = [kept.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    ids = F.broadcast(few[0].unionByName(few[1]))  # at most 2 * rows ids
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    hashes = F.transform(F.split("text", "\\s+"), lambda w: F.xxhash64(w))
    shingle = F.element_at(F.transform(F.array(hashes), lambda h: F.array_min(F.transform(h, lambda x, i: F.when(
        i + SHINGLE <= F.size(h), F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE)]))))), 1)
    once = texts.groupBy("toxic", F.coalesce(shingle, F.xxhash64("text")).alias("like")).agg(F.min("text").alias("text"))
    return once.select(F.col("text").cast("binary").alias("text"), "toxic")


def stand_outs(sample: DataFrame, clean: int, toxic: int, most: int = CANDIDATES) -> list[tuple[str, int, int, float]]:
    """``name, clean texts, toxic texts, G2`` of the words and beginnings that toxic texts have more often than chance would
    give any of all those counted: G2, the log-likelihood ratio against both classes having it alike, is more than twice the
    logarithm of their number."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]],
                                               names=["name", "clean", "toxic"])
            for c in counts:
                c.clear()
            return batch
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: Counter = Counter()
                for piece, n in Counter(text.split()).items():
                    for m in marks(piece):
                        found[m] += n
                counts[label].update(feature(m, level) for m, n in found.items() if m[0] != "~" for level in LEVELS if n >= level)
                if len(counts[0]) + len(counts[1]) > FLUSH:
                    yield out()
        yield out()

    if not clean or not toxic:
        return []
    sums = materialise(map_texts(sample, counted, "name string, clean long, toxic long").groupBy("name").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    rate = (F.col("clean") + F.col("toxic")) / (clean + toxic)

    def part(seen: Column, n: int) -> Column:
        rest = n - seen
        return F.when(seen > 0, seen * F.log(seen / (n * rate))).otherwise(0) + F.when(rest > 0, rest * F.log(rest / (n * (1 - rate)))).otherwise(0)
    scored = sums.filter((F.col("toxic") * clean > F.col("clean") * toxic) & (rate < 1)).withColumn("g2", 2 * (part(F.col("clean"), clean) + part(F.col("toxic"), toxic)))
    least = 2 * math.log(max(sums.count(), 2))
    best = scored.filter(F.col("g2") > least).orderBy(F.desc("g2"), F.length("name").desc(), "name").limit(most).collect()  # a bounded list
    discard(sums)
    return [(r["name"], r["clean"], r["toxic"], r["g2"]) for r in best]


def chosen_stems(found: list[tuple[str, int, int, float]], most: int = STEMS) -> list[str]:
    """The beginnings that vote: by falling G2, none that begins another one."""
    out: list[str] = []
    stems: list[str] = []
    for name, *_ in found:
        stem = mark_of(name)
        if name[0] == "^" and len(out) < most and not any(o.startswith(stem) or stem.startswith(o) for o in stems):
            stems.append(stem)
            out.append(name)
    return out


def telling(found: list[tuple[str, int, int, float]], clean: int, toxic: int) -> list[tuple[str, int, int, float]]:
    """Those that are ``LIFT`` times as frequent in toxic texts. In many texts the common words of a language with more insults than
    another stand out too; voting together they would make the label model's hidden class that language."""
    return [f for f in found if f[2] * clean >= LIFT * f[1] * toxic]


def votes_of(found: list[int], voters: Sequence[str]) -> list[int]:
    """The votes of a text in which so many of the voters found something: those, and the last place of all if they are
    about spelling at most."""
    found = [k for k in found if k < len(voters)]
    return found if any(voters[k][0] != "~" for k in found) else [*found, len(voters)]


def _vote_matrix(lists: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros((len(lists), n))
    for row, some in zip(out, lists):
        row[some] = 1
    return out


def vote_counts(docs: DataFrame, voters: Sequence[str]) -> DataFrame:
    """``votes, n``: each set of votes and how many documents have it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, counts = _Finder(voters), Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([list(v) for v in counts], pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())], names=["votes", "n"])
            counts.clear()
            return batch
        for batch in batches:
            counts.update(tuple(votes_of(finder.found(t), voters)) for t in batch.column(0).to_pylist())
            if len(counts) > FLUSH:
                yield out()
        yield out()

    return map_texts(docs.select(text_bytes().alias("text")), work, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def _shared_weights(together: np.ndarray, rates: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """1 / (1 + the correlations with dependent voters within the classes): equal voters count as one."""
    rho = np.zeros(together.shape[1:])
    for y in (0, 1):
        spread = np.sqrt(rates[y] * (1 - rates[y]))
        rho += (together[y] / max(mass[y], 1e-9) - np.outer(rates[y], rates[y])) / np.outer(spread, spread) / 2
    np.fill_diagonal(rho, 0)
    return 1 / (1 + np.where(rho >= DEPENDENT, np.minimum(rho, 1), 0).sum(axis=1))


def fit_label_model(counts: DataFrame, held: np.ndarray, held_share: float, weight: float = HELD) -> LabelModel:
    """Expectation-maximisation over sets of votes. ``held`` are the rates (clean, toxic) that the model starts from and that keep
    ``weight`` against the rates found; nothing but sums over voters and pairs of voters leaves a task."""
    k = held.shape[1]
    held = np.clip(held, 1e-6, 1 - 1e-6)
    model = LabelModel(held_share, held, np.ones(k))
    for _ in range(ROUNDS):
        now = model

        def sums(batch: pa.RecordBatch) -> list[np.ndarray]:
            votes, n = _vote_matrix(batch.column(0).to_pylist(), k), batch.column(1).to_numpy(zero_copy_only=False)
            p = now.posterior(votes)
            parts = [np.array([(n * (1 - p)).sum(), (n * p).sum()])]
            return parts + [votes.T @ (votes * (n * q)[:, None]) for q in (1 - p, p)]

        found = added_up(counts, sums, np.float64)
        if not found:
            break
        mass, together = found[0], np.stack([f.reshape(k, k) for f in found[1:]])
        own = np.clip(together.diagonal(axis1=1, axis2=2) / np.maximum(mass[:, None], 1e-9), 1e-6, 1 - 1e-6)
        share = float(np.clip((mass[1] / mass.sum() + weight * held_share) / (1 + weight), 1e-4, 1 - 1e-4))
        model = LabelModel(share, (own + weight * held) / (1 + weight), _shared_weights(together, own, mass))
        if abs(model.share - now.share) + np.abs(model.rates - now.rates).max() + np.abs(model.weights - now.weights).max() < SETTLED:
            break
    return model


def fit_classifier(sample: DataFrame, voters: Sequence[str], model: LabelModel, names: list[str]) -> Classifier:
    """Logistic regression on the sample's posteriors: each text counts as toxic with its posterior and as clean with the rest."""
    base, each = model.log_odds()
    # Without anything to learn from, the label model's own weights, which hold exactly for a text with one vote.
    plain = Classifier(voters, each[:-1] - np.array([each[-1] if v[0] != "~" else 0 for v in voters]), base + each[-1])
    if not names:
        return plain
    vocabulary = list(dict.fromkeys([*voters, *names, *[feature("|", n) for n in LONG]]))
    k = len(voters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(vocabulary)
        for batch in batches:
            found = [finder.found(t) for t in batch.column(0).to_pylist()]
            p = model.posterior(_vote_matrix([votes_of(some, voters) for some in found], k + 1))
            yield pa.RecordBatch.from_arrays([pa.array([[vocabulary[f] for f in some] for some in found], pa.list_(pa.string())), pa.array(p)], names=["found", "p"])

    rows = materialise(map_texts(sample.select("text"), work, "found array<string>, p double"))
    mass = rows.agg(F.sum("p").alias("toxic"), F.count("*").alias("n")).first()
    if not mass["n"] or not 0 < mass["toxic"] < mass["n"]:
        return plain
    toxic, clean = mass["toxic"], mass["n"] - mass["toxic"]  # both classes weigh the same
    both = rows.select("found", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("p") / toxic).alias("weight")),
                                                  F.struct(F.lit(0.0).alias("label"), ((1 - F.col("p")) / clean).alias("weight")))).alias("x"))
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="found", outputCol="features", binary=True)
    vectors = counted.transform(both.select("found", "x.label", (F.col("x.weight") * mass["n"]).alias("weight")).filter("weight > 1e-9"))
    fitted = LogisticRegression(featuresCol="features", weightCol="weight", maxIter=60, regParam=1 / mass["n"]).fit(vectors)
    weights = fitted.coefficients.toArray()
    discard(rows)
    kept = np.flatnonzero(weights)
    return Classifier([vocabulary[f] for f in kept], weights[kept], float(fitted.intercept))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier learnt from ``docs`` (all of them may be learnt from) and the ``doc_id, toxic`` of ``labels``."""
    sample = materialise(labelled_sample(docs, labels))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    found = stand_outs(sample, clean, toxic)
    stems = chosen_stems(telling(found, clean, toxic))
    voters = list(dict.fromkeys([feature(m, 1) for m in ["=" + w for w in LEXICON] + ["~" + s for s, _ in SPELLINGS]] + stems))
    k = len(voters)

    def rates(batch: pa.RecordBatch) -> list[np.ndarray]:
        finder = _Finder(voters)
        votes = _vote_matrix([votes_of(finder.found(t), voters) for t in batch.column(0).to_pylist()], k + 1)
        label = np.array(batch.column(1).to_pylist())
        return [votes[label == y].sum(axis=0) for y in (0, 1)]

    sums = added_up(sample, rates, np.float64) or [np.zeros(k + 1), np.zeros(k + 1)]
    # Before any text is seen a word of the lexicon is taken to be rare, and commoner in toxic texts; spellings say nothing yet.
    prior = np.array([[0.01, 0.01] if v[0] == "~" else [0.002, 0.02] for v in voters] + [[0.9, 0.3]]).T
    held = np.stack([(s + 5 * p) / (m + 5) for s, p, m in zip(sums, prior, (clean, toxic))])
    counts = materialise(vote_counts(docs, voters).coalesce(8))
    seen = labels.agg(F.sum(F.when(F.col("toxic") == 1, 1)).alias("toxic"), F.count(F.when(F.col("toxic").isin(0, 1), 1)).alias("n")).first()
    model = fit_label_model(counts, held, min(max(((seen["toxic"] or 0) + 0.5) / (seen["n"] + 10), 1e-3), 0.999))
    # A beginning that only says what a longer voter says is left to that one.
    as_often = {name: (a, b) for name, a, b, _ in found}
    names = [m for m, a, b, _ in found if not any(v != m and mark_of(v).startswith("^" + mark_of(m)[1:]) and as_often[v] == (a, b) for v in stems)]
    out = fit_classifier(sample, voters, model, names)
    discard(counts, sample)
    return out


def scores(df: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted``, one row per input row: the classifier's probability that the text is toxic, and whether it is
    0.5 or more (1) or less (0).

    Only the text is read: a null text is an empty one, which has the score of a text without any feature. Null and
    repeated ids pass through, each row by itself; equal texts get equal scores; whole texts count, however long (memory:
    a text's distinct pieces); other columns are not read; an empty table gives an empty result. No shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(classifier.names)
        for batch in batches:
            z = np.array([classifier.intercept + sum(classifier.weights[f] for f in finder.found(t)) for t in batch.column(1).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    kind = df.schema[id_col].dataType.simpleString()
    found = map_texts(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), work, f"id {kind}, score double, predicted int")
    return found.select(F.col("id").alias(id_col), "score", "predicted")
