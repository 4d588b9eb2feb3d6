"""Fuzzy line deduplication.

Lines are reduced to their lower-case words. Equal lines are one class; a class gets a 60-bit SimHash of
its different words (counted once each: a few very frequent words would make all long lines alike). The bits are
parted into eight blocks. Classes are joined on four blocks at once, some thirty bits, so that few meet by chance however
many they are. The fourteen sets of four blocks whose numbers have XOR 0 are enough: any three blocks lie
in one of them, and the other four blocks are such a set as well, so two classes that differ in at most ``DISTANCE`` bits agree on one of the
sets, whatever the bits. Their lines are compared by edit distance, and of each group connected by such links the first
occurrence stays.

A line in thousands of variants would give millions of pairs. So the members of a set's bucket are first
compared with its smallest member only, and what this connects is not compared again: all other pairs of
a bucket are formed just between members that are not connected yet."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.llm.common import column, fresh
from tillcast.llm.components import components

BITS, DISTANCE = 60, 3
SIMILARITY = 0.8  # 1 - edit distance / length of the longer line
CHUNK = 4095  # words whose bit counts fit the twelve-bit fields of a sum
FIELD, FIELDS = 12, 5  # bits of a field, fields of a sum
PAIRS = list(combinations(range(FIELDS), 2))  # of five blocks of twelve bits: exact as well, a test holds them; keys too short to be joined on
WIDTHS = (8, 8, 8, 7, 8, 7, 7, 7)  # bits of the blocks: no set of four has only wide or only narrow ones
SETS = [q for q in combinations(range(len(WIDTHS)), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]
BREAK = r"[^\p{L}\p{N}]+"
NO_ID = -(1 << 63)


def _ones(width: int, fields: int) -> int:
    """A one at the foot of each field."""
    return sum(1 << width * f for f in range(fields))


def _mask(blocks: tuple[int, ...]) -> int:
    """All bits of these blocks."""
    return sum((1 << WIDTHS[b]) - 1 << sum(WIDTHS[:b]) for b in blocks)


def bucket_keys(sim: Column) -> Column:
    """For each set of blocks the hash's bits there, with the set's number above them."""
    return F.array(*[sim.bitwiseAND(F.lit(_mask(q))).bitwiseOR(F.lit((t << BITS ^ 1 << 63) - (1 << 63))) for t, q in enumerate(SETS)])


def line_words(line: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(line), BREAK), "")


def _majority(sums: list[Column], n: Column) -> Column:
    """Bit 12 f + k is set if field f of sum k is more than half of n, for all fields of a sum at once: fields are
    widened to 24 bits, where 2 c + 8191 - n reaches bit 13 just then."""
    bias = (F.lit(8191) - n) * F.lit(_ones(24, 3))
    out = None
    for k, s in enumerate(sums):
        for up, fields in ((0, 3), (FIELD, 2)):  # fields 0, 2, 4, then 1, 3
            wide = F.shiftright(s, up).bitwiseAND(F.lit(_ones(24, fields) * CHUNK))
            set_ = F.shiftright(F.shiftleft(wide, 1) + bias, 13).bitwiseAND(F.lit(_ones(24, fields)))
            bits = F.shiftleft(set_, up + k)
            out = bits if out is None else out.bitwiseOR(bits)
    return out


def line_hashes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, doc, uid, line_no, h1, h2, sim`` of every line that has a word. ``doc`` is the hash of the text, ``uid`` the
    row's number, ``h1, h2`` stand for the words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("doc"),
                     F.monotonically_increasing_id().alias("uid"), text.alias("text"))
    # An inner explode is planned with a filter that works its array out a second time; null words go behind it.
    lines = rows.select("id", "doc", "uid", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    words = lines.select("id", "doc", "uid", "line_no", F.transform(line_words(F.col("line")), lambda w: F.xxhash64(w)).alias("words"))
    # What is selected beside a generator is worked out for each of its rows, so the line's hashes come before it.
    own = ["id", "doc", "uid", "line_no", "h1", "h2"]
    hashed = words.select("id", "doc", "uid", "line_no", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"),
                          F.array_distinct("words").alias("features"))
    each = hashed.select(*own, F.posexplode_outer("features").alias("at", "word")).filter("word is not null")
    h = F.col("word")
    summed = each.groupBy(*own, F.expr(f"at div {CHUNK}").alias("chunk")).agg(
        F.count("*").alias("n"),
        *[F.sum(F.shiftright(h, k).bitwiseAND(F.lit(_ones(FIELD, FIELDS)))).alias(f"s{k}") for k in range(FIELD)])
    sums = [F.col(f"s{k}") for k in range(FIELD)]
    several = (F.col("chunk") > 0) | (F.col("n") == CHUNK)
    kept = materialise(summed.select(*own, "n", _majority(sums, F.col("n")).alias("sim"), F.when(several, F.array(*sums)).alias("sums")))
    short = kept.filter("sums is null").select(*own, "sim")
    # Lines of more words, few of them: their chunks' fields are added up one by one.
    counts = F.array(*[F.shiftright(F.col("sums")[b % FIELD], b // FIELD * FIELD).bitwiseAND(F.lit(CHUNK)) for b in range(BITS)])
    long = (kept.filter("sums is not null").select(*own, "n", F.posexplode(counts).alias("bit", "c"))
            .groupBy(*own, "bit").agg((F.sum("c") * 2 > F.sum("n")).alias("set"))
            .groupBy(*own).agg(F.bit_or(F.when(F.col("set"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).otherwise(0)).alias("sim")))
    return short.unionByName(long)


def _close(a: str, b: str) -> Column:
    """Few enough bits differ."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs ``a, b`` those whose lines are similar enough."""
    one = texts.select(F.col("node").alias("a"), F.col("line").alias("line_a"))
    two = texts.select(F.col("node").alias("b"), F.col("line").alias("line_b"))
    longest = "greatest(length(line_a), length(line_b))"
    allowed = f"cast(floor({longest} * {1 - SIMILARITY:.10g} + 1e-9) as int)"
    both = pairs.join(one, "a").join(two, "b").withColumn("allowed", F.expr(allowed)).filter("abs(length(line_a) - length(line_b)) <= allowed")
    # Equal beginnings and ends do not change the distance, and most of a line is equal.
    distance = _let(_without_common(F.struct(F.col("line_a").alias("x"), F.col("line_b").alias("y")), True),
                    lambda p: _let(_without_common(p, False), lambda q: F.when(
                        (F.length(q["x"]) == 0) | (F.length(q["y"]) == 0) | (_word_by_word(q["x"], q["y"]) <= F.col("allowed")), 0).otherwise(
                        F.call_function("levenshtein", q["x"], q["y"], F.col("allowed")))))
    return materialise(both.filter(distance >= 0).select("a", "b"))


def _word_by_word(x: Column, y: Column) -> Column:
    """What it costs to turn each word into the one at its place: never less than the edit distance, and mostly
    enough to tell that a long line with some words changed is similar."""
    def cost(p, q):
        both = F.greatest(F.length(F.coalesce(p, F.lit(""))), F.length(F.coalesce(q, F.lit(""))))
        return F.when(p.isNull() | q.isNull(), both + 1).when(p == q, 0).otherwise(both)
    return F.aggregate(F.zip_with(F.split(x, " "), F.split(y, " "), cost), F.lit(0), lambda a, b: a + b)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without_common(pair: Column, ahead: bool) -> Column:
    """A pair of strings x, y without their common beginning (or end), whose length is found by halving steps."""
    def cut(p):
        x, y = p["x"], p["y"]
        shorter = F.least(F.length(x), F.length(y))
        part = F.left if ahead else F.right

        def longer(done, step):
            more = done + step
            return F.when((more <= shorter) & (part(x, more) == part(y, more)), more).otherwise(done)

        def rest(n):
            kept = [F.right(s, F.length(s) - n) if ahead else F.left(s, F.length(s) - n) for s in (x, y)]
            return F.struct(kept[0].alias("x"), kept[1].alias("y"))
        return _let(F.aggregate(F.array(*[F.lit(1 << i) for i in range(30, -1, -1)]), F.lit(0), longer), rest)
    return _let(pair, cut)


def line_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, doc, uid, line_no, group_id, group_line_no, kept`` of every line that has a word (helper of the two
    operators below; ``id`` has the least whole number for null)."""
    occurrences = line_hashes(df, id_col, text_col)
    classes = materialise(occurrences.groupBy("h1", "h2").agg(
        F.min(F.struct("id", "doc", "line_no", "uid")).alias("first"), F.count("*").alias("weight"), F.min("sim").alias("sim"))
        .withColumn("node", F.monotonically_increasing_id()))

    # Most shared keys are two lines that meet by chance; of two members the sum shows their distance at once. Hardly a key
    # comes twice, so nothing is added up before the keys are dealt, and what is dealt serves the join as well. Joins with
    # lists that grow with the input are not left to their size: as broadcasts on small inputs only they would cost more on large ones.
    entries = classes.select("node", "sim", F.explode(bucket_keys(F.col("sim"))).alias("key")).repartition("key")
    shared = entries.groupBy("key").agg(F.count("node").alias("n"), F.bit_xor("sim").alias("x")).filter(
        (F.col("n") > 2) | (F.col("n") == 2) & (F.bit_count("x") <= DISTANCE)).select("key")
    crowded = materialise(entries.join(shared.hint("shuffle_hash"), "key"))
    # Members of a bucket with another one close to them; the search ends at the first.
    other = crowded.select(F.col("key").alias("o_key"), F.col("node").alias("o_node"), F.col("sim").alias("o_sim"))
    members = materialise(crowded.join(other, (F.col("key") == F.col("o_key")) & (F.col("node") != F.col("o_node")) & _close("sim", "o_sim"), "left_semi"))
    discard(crowded)
    texts = _lines(df, classes.join(members.select("node").distinct().hint("merge"), "node").select("node", "first.id", "first.doc", "first.line_no"), id_col, text_col)
    # First each member with the smallest of its bucket.
    least = members.groupBy("key").agg(F.min(F.struct("node", "sim")).alias("least")).select("key", F.col("least.node").alias("b"), F.col("least.sim").alias("b_sim"))
    stars = members.join(least, "key").filter((F.col("node") != F.col("b")) & _close("sim", "b_sim")).select(F.col("node").alias("a"), "b").distinct()
    links = _verified(stars, texts)
    first_roots = components(links)
    # Then those of a bucket that are not connected yet.
    rooted = members.join(first_roots, "node", "left").select("key", "node", "sim", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    left = materialise(rooted.join(mixed, "key"))
    right = left.select(F.col("key").alias("o_key"), F.col("node").alias("b"), F.col("sim").alias("b_sim"), F.col("root").alias("b_root"))
    pairs = left.join(right, (F.col("key") == F.col("o_key")) & (F.col("node") < F.col("b")) & (F.col("root") != F.col("b_root")) & _close("sim", "b_sim"))
    more = _verified(pairs.select(F.col("node").alias("a"), "b").distinct(), texts)
    roots = components(links.unionByName(more))
    # Classes alone with one occurrence need no group.
    grouped = classes.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = grouped.groupBy("root").agg(F.min("first").alias("kept_one"), F.sum("weight").alias("lines")).filter("lines > 1")
    repeated = materialise(grouped.select("h1", "h2", "root").join(groups.hint("merge"), "root").select("h1", "h2", "kept_one"))
    discard(classes, members, texts, links, more, left)
    k = F.col("kept_one")
    same = (k["id"] == F.col("id")) & (k["doc"] == F.col("doc")) & (k["line_no"] == F.col("line_no")) & (k["uid"] == F.col("uid"))
    return occurrences.join(repeated.hint("merge"), ["h1", "h2"], "left").select(
        "id", "doc", "uid", "line_no", F.coalesce(k["id"], "id").alias("group_id"), F.coalesce(k["line_no"], "line_no").alias("group_line_no"),
        F.coalesce(same, F.lit(True)).alias("kept"))


def _lines(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, line``: the words, put together, of the lines named by ``id, doc, line_no``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("doc"), text.alias("text"))
    by_doc = materialise(wanted).groupBy("id", "doc").agg(F.collect_list(F.struct("node", "line_no")).alias("wanted"))  # a document's own lines
    found = docs.join(by_doc.hint("merge"), ["id", "doc"]).select(F.split("text", "\n").alias("lines"), "wanted")
    taken = found.select(F.explode(F.transform("wanted", lambda w: F.struct(w["node"].alias("node"), F.get("lines", w["line_no"]).alias("line")))).alias("l"))
    words = taken.select("l.node", F.array_join(line_words(F.col("l.line")), " ").alias("line"))
    return materialise(words.dropDuplicates(["node"]))  # repeated rows give a line twice


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that has a letter or digit: ``doc_id, line_no, group_doc_id, group_line_no, kept``.

    Lines are what ``\\n`` parts, numbered from 0. Equal lines, and lines whose SimHashes differ in at most three of 60
    bits and whose edit similarity (of the words put together with single spaces) is 0.8 or more, are linked;
    ``kept`` holds for one line of each group of linked lines, the one with the smallest id and then line number
    (of repeated ids the one with the smaller hash of its text, of repeated rows the first). A null text has no
    lines; lines without a letter or digit belong to no group, are not listed and never removed. A null id counts
    as smaller than all others. Other columns are not read. An empty table gives an empty result."""
    def plain(c: str, name: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c)).alias(name)

    return line_groups(df, id_col, text_col).select(plain("id", id_col), "line_no", plain("group_id", f"group_{id_col}"), "group_line_no", "kept")


def remove_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, with the lines that ``dedup_lines`` does not keep taken out of their texts. A row
    that loses all its lines with words is a copy as a whole and goes; rows without such lines stay as they are."""
    lines = line_groups(df, id_col, text_col)
    # Rows repeated with id and text are one document: the first row's lines decide, the others lose all.
    per_row = lines.groupBy("id", "doc", "uid").agg(F.count("*").alias("n"), F.collect_list(F.when(~F.col("kept"), F.col("line_no"))).alias("dropped"))
    per_doc = materialise(per_row.groupBy("id", "doc").agg(F.min_by(F.struct("n", "dropped"), "uid").alias("d"), F.count("*").alias("rows"))
                          .select("id", "doc", "d.n", "d.dropped", "rows").filter("size(dropped) > 0 or rows > 1"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    *keys, about = fresh(df, "key_id", "key_doc", "about")
    keyed = df.withColumns(dict(zip(keys, (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(text)))))
    per_doc = per_doc.select(F.col("id").alias(keys[0]), F.col("doc").alias(keys[1]), F.struct("n", "dropped", "rows").alias(about))
    joined = keyed.join(per_doc.hint("merge"), keys, "left")
    d = F.col(about)
    split = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), d["dropped"])
    shorter = F.element_at(F.transform(F.array(split), lambda s: F.array_join(F.transform(stay, lambda i: F.get(s, i)), "\n")), 1)
    columns = [F.when(d.isNull() | (F.size(d["dropped"]) == 0), F.col(c)).otherwise(shorter).alias(c) if c == text_col else column(c) for c in df.columns]
    single = joined.filter(d.isNull() | (d["rows"] == 1) & (F.size(d["dropped"]) < d["n"])).select(*columns)
    repeated = joined.filter((d["rows"] > 1) & (F.size(d["dropped"]) < d["n"])).dropDuplicates(keys).select(*columns)
    return single.unionByName(repeated)
