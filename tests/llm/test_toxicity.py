"""The label model against a plain one, the classifier on held-out rows, odd tables."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import queries, toxicity


def auc(pairs):
    """Share of (toxic, clean) pairs that the score orders rightly, ties by half."""
    toxic, clean = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))


def test_marks():
    got = set(toxicity.marks("Stupid!!".encode()))
    assert {"=stupid", "^stu", "^stup", "^stupid", "~exclaimed"} <= got and "^st" not in got
    assert set(toxicity.marks(b"IDIOT!")) >= {"=idiot", "~shouted"} and "~digits" in toxicity.marks(b"id10t") and "~censored" in toxicity.marks(b"id**t")
    assert set(toxicity.marks(b"sooooo")) >= {"~stretched"} and toxicity.marks(b"...") == []


def test_g2():
    assert toxicity.g2(5, 5, 50, 50) == pytest.approx(0, abs=1e-12)
    assert toxicity.g2(0, 10, 50, 50) == pytest.approx(2 * (10 * np.log(2) + 40 * np.log(40 / 45) + 50 * np.log(50 / 45)), rel=1e-12)


def test_stand_outs_equal_plain_counts(spark):
    draw = random.Random(3)
    words = ["loweia", "loweib", "plain", "other", "thing", "lowland", "nice"]
    rows = []
    for _ in range(120):
        toxic = draw.random() < 0.4
        text = [draw.choice(words[2:]) for _ in range(draw.randint(0, 8))] + ([draw.choice(words[:2])] if toxic and draw.random() < 0.9 else [])
        rows.append((" ".join(text).encode(), int(toxic)))
    counts, n = {}, [sum(y == c for _, y in rows) for c in (0, 1)]
    for text, y in rows:
        often = collections.Counter(m for p in text.split() for m in toxicity.marks(p))
        for m, k in often.items():
            for level in toxicity.LEVELS:
                if k >= level:
                    counts.setdefault(f"{m}#{level}", [0, 0])[y] += 1
    least = 2 * np.log(len(counts))
    want = {m: (*c, round(toxicity.g2(*c, *n), 9)) for m, c in counts.items() if c[1] * n[0] > c[0] * n[1] and toxicity.g2(*c, *n) > least}
    got = toxicity.stand_outs(spark.createDataFrame(rows, "text binary, toxic int").repartition(4), *n)
    assert {m: (a, b, round(g, 9)) for m, a, b, g in got} == want and "^lowei#1" in want
    assert toxicity.chosen_stems(got)[0] == "^lowei#1"
    assert toxicity.stand_outs(spark.createDataFrame(rows, "text binary, toxic int"), 0, 5) == []


def plain_label_model(rows, held, share, weight):
    """The same expectation-maximisation, one document at a time."""
    k = len(held[0])
    model = toxicity.LabelModel(share, np.array(held), np.ones(k))
    for _ in range(toxicity.ROUNDS):
        old, mass, together = model, [0.0, 0.0], np.zeros((2, k, k))
        for votes in rows:
            p = float(old.posterior(np.array([votes], float))[0])
            for y, q in ((0, 1 - p), (1, p)):
                mass[y] += q
                together[y] += q * np.outer(votes, votes)
        own = np.array([[min(max(together[y][j][j] / mass[y], 1e-6), 1 - 1e-6) for j in range(k)] for y in (0, 1)])
        weights = []
        for j in range(k):
            total = 0.0
            for i in range(k):
                rho = sum((together[y][i][j] / mass[y] - own[y][i] * own[y][j]) / np.sqrt(own[y][i] * (1 - own[y][i]) * own[y][j] * (1 - own[y][j])) for y in (0, 1)) / 2
                total += min(rho, 1.0) if i != j and rho >= 0.5 else 0.0
            weights.append(1 / (1 + total))
        model = toxicity.LabelModel((mass[1] / sum(mass) + weight * share) / (1 + weight), (own + weight * np.array(held)) / (1 + weight), np.array(weights))
        if abs(model.share - old.share) + np.abs(model.rates - old.rates).max() + np.abs(model.weights - old.weights).max() < toxicity.SETTLED:
            break
    return model


def test_label_model(spark):
    """Five voters of known rates and one that repeats the first, rates held from a small labelled part: the model's rates
    stay near the truth, the twins share their weight, and texts are told apart nearly as well as by who knows all rates."""
    rng = np.random.default_rng(8)
    n, true = 6000, np.array([[0.02, 0.01, 0.01, 0.03, 0.005], [0.6, 0.5, 0.3, 0.25, 0.4]])
    y = (rng.random(n) < 0.2).astype(int)
    votes = (rng.random((n, 5)) < true[y]).astype(int)
    votes = np.c_[votes, votes[:, 0]]
    heard = np.c_[votes, votes.sum(axis=1) == 0].astype(int)  # the last vote: nobody finds anything
    held = np.array([(heard[:300][y[:300] == c].sum(axis=0) + 0.5) / ((y[:300] == c).sum() + 1) for c in (0, 1)])
    counts = spark.createDataFrame([([int(k) for k in np.flatnonzero(v)],) for v in heard], "votes array<int>").groupBy("votes").agg(F.count("*").alias("n"))
    model = toxicity.fit_label_model(counts, held, 0.15)
    plain = plain_label_model(heard.tolist(), held, 0.15, 1.0)
    assert np.allclose(model.rates, plain.rates) and np.allclose(model.weights, plain.weights) and model.share == pytest.approx(plain.share)
    assert model.weights[0] == pytest.approx(model.weights[5]) and model.weights[0] < 0.55 and min(model.weights[1:5]) == 1
    assert np.abs(model.rates[:, :5] - true).max() < 0.1 and 0.15 < model.share < 0.25
    llr = np.log(true[1] / true[0]), np.log((1 - true[1]) / (1 - true[0]))
    best = ((np.log(0.2 / 0.8) + votes[:, :5] @ llr[0] + (1 - votes[:, :5]) @ llr[1] >= 0) == y).mean()
    assert 0.9 < best < ((model.posterior(heard.astype(float)) >= 0.5) == y).mean() + 0.03
    assert toxicity.fit_label_model(counts.limit(0), held, 0.1).share == 0.1


def corpus(draw, n):
    """Clean prose, and prose with a listed insult, an unlisted stem with endings never seen twice, or both."""
    words = [f"{a}{b}{c}" for a in ("ta", "ri", "mo", "ke") for b in ("lun", "ver", "sti") for c in ("a", "os", "ent")]
    rows = []
    for k in range(n):
        toxic = draw.random() < 0.15
        text = [draw.choice(words) for _ in range(draw.randint(1, 60))]
        if toxic:
            for _ in range(draw.randint(1, 4)):
                text.insert(draw.randrange(len(text) + 1), draw.choice(["idiot", "Scum!", f"zorqu{draw.choice(words)}", f"brast{draw.choice(words)},"]))
        rows.append((k, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(random.Random(6), 3000)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 1500], "doc_id long, toxic int")
    model = toxicity.train(docs.filter("doc_id < 2500"), labels)
    found = {r.doc_id: (r.score, r.predicted) for r in toxicity.scores(docs, model).collect()}
    unseen = [(found[k], y) for k, _, y in rows if k >= 2500]
    assert sum(p == y for (_, p), y in unseen) / len(unseen) > 0.97
    assert auc([(s, y) for (s, _), y in unseen]) > 0.98
    # Copies and repeated texts get one score; the order of words and other columns do not matter.
    text = rows[7][1]
    twice = spark.createDataFrame([(1, text, 1.0), (1, text, 2.0), (2, " \n ".join(reversed(text.split())), 3.0)], "doc_id long, text string, score double")
    assert len({r.score for r in toxicity.scores(twice, model).collect()}) == 1


def test_language_does_not_become_the_hidden_class(spark):
    """Most toxic texts are in one of two languages: its common words stand out, but are no voters."""
    draw = random.Random(4)
    languages = [[f"{a}{b}{c}" for a in some for b in ("lun", "ver", "sti") for c in ("a", "os", "ent")] for some in (("ta", "ri", "mo"), ("ke", "pu", "fo"))]
    rows = []
    for k in range(4000):
        toxic = draw.random() < 0.2
        words = languages[draw.random() < (0.1 if toxic else 0.6)]
        text = [draw.choice(words) for _ in range(draw.randint(20, 80))]
        if toxic:
            for _ in range(draw.randint(1, 3)):
                text.insert(draw.randrange(len(text) + 1), draw.choice(["idiot", "scum", f"zorqu{draw.choice(words)}"]))
        rows.append((k, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 3000], "doc_id long, toxic int")
    found = {r.doc_id: (r.score, r.predicted) for r in toxicity.scores(docs, toxicity.train(docs.filter("doc_id < 3500"), labels)).collect()}
    unseen = [(found[k], y) for k, _, y in rows if k >= 3500]
    assert sum(p == y for (_, p), y in unseen) / len(unseen) > 0.97 and auc([(s, y) for (s, _), y in unseen]) > 0.98


def test_query_learns_from_its_rows_only(spark):
    folder = "/root/testdata/sf0.1"  # 97 labelled toxic rows are held out
    rows = queries.QUERIES["op11_toxicity"](spark, folder).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert auc(held) > 0.93 and sum((s >= 0.5) == y for s, y in held) / len(held) > 0.97


def test_held_out_rows_change_nothing(spark, tmp_path):
    """Other labels and texts of held-out rows leave the scores of the others as they were."""
    rows = corpus(random.Random(9), 600)

    def written(name, rows):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
        return {r.doc_id: r.score for r in queries.QUERIES["op11_toxicity"](spark, path).collect()}
    held = {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0}
    one = written("one", rows)
    two = written("two", [(k, "idiot tarisun" if k in held else t, 1 - y if k in held else y) for k, t, y in rows])
    assert all(one[k] == pytest.approx(two[k], abs=1e-6) for k in one if k not in held)


def test_odd_rows(spark, edge, empty, edge_rows):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (7, 0), (8, 1), (9, 0), (99, 1), (3, 1)], "doc_id long, toxic int")
    for some in (labels, labels.filter("toxic = 0"), labels.limit(0)):
        model = toxicity.train(edge, some)
        found = toxicity.scores(edge, model).collect()
        assert len(found) == len(edge_rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
        assert toxicity.scores(empty, model).count() == 0
        by_text = {}
        for r in toxicity.scores(spark.createDataFrame([(k, t) for k, (_, t, *_) in enumerate(edge_rows)], "doc_id long, text string"), model).collect():
            by_text.setdefault(edge_rows[r.doc_id][1] or "", set()).add(r.score)
        assert all(len(s) == 1 for s in by_text.values())
    model = toxicity.train(empty, labels)
    insulted = spark.createDataFrame([(1, "you idiot"), (2, "a fine day")], "doc_id long, text string")
    s = {r.doc_id: r.score for r in toxicity.scores(insulted, model).collect()}
    assert s[1] > s[2]  # without any text to learn from, the lexicon alone
