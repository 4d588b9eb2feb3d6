import collections
import random

import numpy as np
import regex
from pyspark.sql import functions as F

from tillcast.llm import buckets, chosen_path, components, lattice, line_dedup


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(230)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 600)] + [(7, 7)]
    want = {n: r for n, r in roots_of({x for p in links for x in p}, links).items() if n != r}
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {r.node: r.root for r in components.components(frame).collect()} == want
    assert components.components(frame.limit(0)).count() == 0


def grams(text, n=5):
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text or "") if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def jaccard_by_hand(rows, threshold=0.8):
    """rows: (id, text) in any order; n_links and component of each row by brute force."""
    sets = [grams(t) for _, t in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links.append((i, j))
    n = collections.Counter(x for p in links for x in p)
    root = roots_of(range(len(rows)), links)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        key = -(1 << 63) if doc_id is None else doc_id
        low[root[i]] = min(low.get(root[i], key), key)
    return sorted((str(rows[i][0]), n[i], str(low[root[i]]).replace(str(-(1 << 63)), "None")) for i in range(len(rows)))


def family(draw, size, edits, words=120):
    vocabulary = [f"w{k}" for k in range(900)]
    base = [draw.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(words)] = draw.choice(vocabulary)
        out.append(" ".join(copy))
    return out


def test_jaccard_join_equals_brute_force(spark):
    draw = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [t for s, e in ((150, 3), (60, 6), (3, 1), (2, 0)) for t in family(draw, s, e)]
    texts += [f"{passage} {t}" for t in family(draw, 90, 120)] + texts[:40]
    rows = list(enumerate(texts))
    got = chosen_path.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_links, str(r.component_id)) for r in got) == jaccard_by_hand(rows)
    assert collections.Counter(r.component_id for r in got if r.kept) == collections.Counter({r.component_id for r in got})


def test_blocks_do_not_change_the_links(spark, monkeypatch):
    draw = random.Random(6)
    rows = list(enumerate(family(draw, 120, 4)))
    monkeypatch.setattr(chosen_path, "LEAF", 5)
    monkeypatch.setattr(buckets, "BLOCK", 16)
    monkeypatch.setattr(chosen_path, "COLUMNS", 32)
    got = chosen_path.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_links, str(r.component_id)) for r in got) == jaccard_by_hand(rows)


def test_runs_reach_the_recall():
    assert chosen_path.runs_for(0.8, 0.9999) == 8 and chosen_path.runs_for(0.8, 0.9) < 4


def test_jaccard_edge_rows(edge, empty, edge_rows):
    got = chosen_path.jaccard_join(edge).collect()
    rows = [(r[0], r[1]) for r in edge_rows]
    assert sorted((str(r.doc_id), r.n_links, str(r.component_id)) for r in got) == jaccard_by_hand(rows)
    assert chosen_path.jaccard_join(empty).count() == 0
    kept = chosen_path.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 1, 3, 4, 5, 6, 7, 8, 9, None, None]))
    assert chosen_path.keep_one(empty).count() == 0


def test_lattice_points_are_nearest():
    roots = lattice.roots()
    assert roots.shape == (240, 8) and set((roots ** 2).sum(axis=1)) == {2.0}
    x = np.random.default_rng(0).uniform(-2, 2, (200, 8))
    points = lattice.nearest_point(x)
    assert ((points * 2).astype(int) == points * 2).all() and (points.sum(axis=1) % 2 == 0).all()
    best = ((x - points) ** 2).sum(axis=1)
    for r in roots:
        assert (((x - points - r) ** 2).sum(axis=1) >= best - 1e-9).all()


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    of = (lattice.TABLES, lattice.POINTS, lattice.lattice_unit(0.93, 64), lattice.PROBES)
    one, two = lattice.cells(a, *of), lattice.cells(b, *of)
    wide = lattice.PROBES + 1
    met = np.zeros(len(a), bool)
    for t in range(0, lattice.TABLES * wide, wide):
        met |= (one[:, t:t + wide, None] == two[:, None, t:t + wide]).any(axis=(1, 2))
    assert met.mean() >= 0.97  # pairs at the very threshold; nearer ones meet more often


def vectors_by_hand(rows):
    links, good = [], []
    for vec_id, v, label in rows:
        ok = v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) if ok else None)
    for i in range(len(rows)):
        for j in range(i):
            if good[i] is not None and good[j] is not None and rows[i][2] == rows[j][2] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.93:
                links.append((i, j))
    n = collections.Counter(x for p in links for x in p)
    root = roots_of(range(len(rows)), links)
    key = [-1 if r[0] is None else r[0] for r in rows]
    low = {}
    for i in range(len(rows)):
        low[root[i]] = min(low.get(root[i], key[i]), key[i])
    return sorted((key[i], n[i], low[root[i]], key[i] == low[root[i]]) for i in range(len(rows)))


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16))
    rows = []
    for k in range(400):
        v = centres[k % 40] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3])
        rows.append((k, v.astype(np.float32).tolist(), int(k % 3)))
    rows += [(400, rows[0][1], 0), (401, [x * 2 for x in rows[0][1]], 0), (402, None, 1), (403, [0.0] * 16, 1), (404, [0.0] * 16, 1), (405, [float("nan")] * 16, 1),
             (406, [float("inf")] + [0.0] * 15, 1), (407, rows[0][1], None), (408, [None] + [1.0] * 15, 0), (409, [], 0), (410, [1.0, 2.0], 0), (411, [2.0, 4.0], 0),
             (None, rows[1][1], 1), (5, rows[5][1], 2), (412, [1e-30] * 16, 0), (413, [1e30] * 16, 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in lattice.near_vectors(frame).collect())
    assert got == vectors_by_hand([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows])
    assert lattice.near_vectors(frame.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines_by_hand(rows, hashes):
    """rows: (key, id, text); hashes: xxhash64 by word. (id, line_no) of the kept line for every line."""
    lines = {}
    for key, doc_id, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            words = [w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w]
            if words:
                lines[key, doc_id, no] = words
    classes = collections.defaultdict(list)
    for at, words in lines.items():
        classes[" ".join(words)].append(at)
    sims = {}
    for text in classes:
        words = set(text.split(" "))
        sims[text] = sum(1 << b for b in range(60) if 2 * sum(hashes[w] >> b & 1 for w in words) > len(words))
    names = list(classes)
    links = []
    for i in range(len(names)):
        for j in range(i):
            if (sims[names[i]] ^ sims[names[j]]).bit_count() <= 3:
                longest = max(len(names[i]), len(names[j]))
                if distance(names[i], names[j]) <= int(longest * 0.2 + 1e-9):
                    links.append((i, j))
    root = roots_of(range(len(names)), links)
    first = {}
    for i, name in enumerate(names):
        low = min((at[1], at[0], at[2]) for at in classes[name])
        first[root[i]] = min(first.get(root[i], low), low)
    return {at: first[root[i]] for i, name in enumerate(names) for at in classes[name]}, len(links)


def word_hashes(spark, texts):
    words = {w for t in texts for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w}
    rows = spark.createDataFrame([(w,) for w in sorted(words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    return {r.w: r.h & (1 << 64) - 1 for r in rows}


def test_line_groups_equal_brute_force(spark):
    draw = random.Random(11)
    lines = [t for s, e in ((40, 1), (25, 1), (4, 3)) for t in family(draw, s, e, 200)] + ["Ab, cd.", "ab CD", "Ab. Cd!", "..."]
    rows = []
    for k in range(40):
        rows.append((k, "\n".join(draw.choice(lines) for _ in range(draw.randint(1, 5)))))
    texts = [t for _, t in rows]
    want, links = lines_by_hand([(0, i, t) for i, t in rows], word_hashes(spark, texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(frame).collect()
    assert links > 20 and len(got) == len(want)
    for r in got:
        low = want[0, r.doc_id, r.line_no]
        assert (r.group_doc_id, r.group_line_no) == (low[0], low[2]) and r.kept == ((r.doc_id, r.line_no) == (low[0], low[2]))


def test_long_lines_have_the_same_hash(spark):
    words = [f"w{k}" for k in range(9000)] + ["w1"] * 50
    text = " ".join(words)
    got = line_dedup.line_hashes(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text").collect()
    hashes = word_hashes(spark, [text])
    want = sum(1 << b for b in range(60) if 2 * sum(hashes[w] >> b & 1 for w in set(words)) > 9000)
    assert len(got) == 1 and got[0].sim == want


def test_five_blocks_meet_all_near_hashes():
    draw = random.Random(2)
    for _ in range(300):
        a = draw.getrandbits(60)
        b = a
        for bit in draw.sample(range(60), 3):
            b ^= 1 << bit
        agree = [k for k in range(5) if (a >> 12 * k & 4095) == (b >> 12 * k & 4095)]
        assert any(i in agree and j in agree for i, j in line_dedup.PAIRS)


def test_eight_blocks_meet_all_near_hashes_and_few_others(spark):
    assert sum(line_dedup.WIDTHS) == line_dedup.BITS and len(line_dedup.SETS) == 14
    draw = random.Random(3)
    hashes = [draw.getrandbits(60) for _ in range(300)]
    rows = []
    for a in hashes:
        b = a
        for bit in draw.sample(range(60), 3):
            b ^= 1 << bit
        rows.append((a, b))
    keys = spark.createDataFrame(rows, "a long, b long").select(
        "a", line_dedup.bucket_keys(F.col("a")).alias("x"), line_dedup.bucket_keys(F.col("b")).alias("y")).collect()
    assert all(set(r.x) & set(r.y) for r in keys)
    for r in keys:  # a key tells its set, and leaves at most 31 bits of the hash open
        assert len(set(r.x)) == 14 and [k >> 60 & 15 for k in r.x] == list(range(14))
    assert all(29 <= sum(line_dedup.WIDTHS[b] for b in q) <= 31 for q in line_dedup.SETS)


def test_line_arrays_are_worked_out_once(spark):
    # A filter that the optimiser adds before an inner explode would split every line a second time.
    frame = spark.createDataFrame([(1, "one two\n\nthree")], "doc_id long, text string")
    found = []
    real = line_dedup.materialise
    try:
        line_dedup.materialise = lambda df: found.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df)
        assert line_dedup.line_hashes(frame, "doc_id", "text").count() == 2
    finally:
        line_dedup.materialise = real
    assert found[0].count("[^\\p{L}\\p{N}]+") == 1


def test_lines_of_edge_rows(edge, empty, edge_rows):
    rows = line_dedup.dedup_lines(edge).collect()
    assert len(rows) == 2 * 3 + 1 + 1 + 1 + 1 + 1  # lines with a letter or digit
    assert sum(r.kept for r in rows if r.doc_id in (1, 2) and r.group_line_no == 0 and r.group_doc_id == 1) >= 1
    kept = line_dedup.remove_repeated_lines(edge)
    assert kept.columns == edge.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    texts = [t for _, t in got]
    assert texts.count(edge_rows[0][1]) == 1 and ("2", edge_rows[0][1]) not in got  # copies go as a whole
    assert sorted(i for i, _ in got) == sorted(map(str, [1, 1, 3, 4, 5, 6, 7, 8, 9, None, None]))
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.remove_repeated_lines(empty).count() == 0


def test_removed_lines_leave_the_others(spark):
    rows = [(1, "Alpha beta gamma.\n\nUnique one here."), (2, "First of two.\nalpha BETA gamma\n***\nLast of two."), (3, "alpha beta gamma")]
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "First of two.\n***\nLast of two."}
