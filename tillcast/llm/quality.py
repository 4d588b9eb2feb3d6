"""Quality rules with thresholds that adapt to each language and source.

Four measures of every text are counted into quantile sketches: histograms whose buckets keep the six
leading bits of a value, so a quantile is off by a thirty-second at most, and sketches merge by adding.
A text goes when a measure lies far outside the middle half of its language and source. Where a
language and source have few texts, the sketch merged over the language is used, then the one over all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8  # words of a window looked for twice
BASE_WORDS = 20
BASE_REPEAT = 30  # per cent of words in repeated windows
#: Measure: the counts whose ratio it is, in hundredths.
PER = {"word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"),
       "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words")}
#: Measure: (least width of the middle half, whether low values are suspect too).
MEASURES = {"word_length": (60, True), "symbols": (8, False), "dup_lines": (10, False), "repeats": (8, False)}
FENCE = 4  # widths of the middle half that a text may lie outside of it
FEW = 100  # texts below which a language and source are judged by the language's sketch


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return _let(F.btrim(text, F.lit(SPACES)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE)))


def _repeat_words(w: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more in the text."""
    def gram(i):
        return F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])

    def covered(grams):
        def of_sorted(s):
            same = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            return _let(F.sort_array(F.transform(same, lambda x: x["i"])), lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda a, b: a + b))
        return _let(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)

    places = F.sequence(F.lit(0), F.size(w) - WINDOW)
    counted = _let(F.transform(places, gram), lambda g: F.when(F.size(g) == F.size(F.array_distinct(g)), F.lit(0).cast("long")).otherwise(covered(g)))
    return F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(counted)


def measures(text: Column) -> Column:
    """A struct of counts for one text, null counting as empty."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(w, x):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"))
    return _let(words(whole), lambda w: _let(lines, lambda x: of(w, x)))


def sketch_bucket(v: Column) -> Column:
    """The least value of the bucket that holds a whole number: its six leading bits."""
    drop = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept``.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated windows of eight. ``kept``: not
    that, and no measure beyond its fence. A null text has no words and fails. Null languages and sources
    are groups of their own; null and repeated ids are passed through, repeated rows are judged each. An empty
    table gives an empty result. Other columns are not read. Sketches count every text that has words."""
    rows = materialise(df.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), measures(F.col(text_col)).alias("m")))
    fences = materialise(_fences(rows))  # a row per language and source; Spark broadcasts it if its files are small
    return rows.join(fences, _same_group(rows, fences, "lang", "source"), "left").select(
        F.col("id").alias(id_col), "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        _base_failed().alias("base_failed"), (~_base_failed() & ~_outside()).alias("kept"))


def _same_group(rows: DataFrame, fences: DataFrame, lang: str, source: str) -> Column:
    return rows[lang].eqNullSafe(fences["for_lang"]) & rows[source].eqNullSafe(fences["for_source"])


def _value(measure: str) -> Column:
    """A measure in whole numbers."""
    part, of = PER[measure]
    return F.expr(f"if(m.{of} > 0, m.{part} * 100 div m.{of}, 0)")


def _base_failed() -> Column:
    return (F.col("m.n_words") < BASE_WORDS) | (F.col("m.n_repeat_words") * 100 > F.col("m.n_words") * BASE_REPEAT)


def _outside() -> Column:
    out = F.lit(False)
    for measure, (_, low) in MEASURES.items():
        out = out | (_value(measure) > F.col(f"{measure}_high"))
        if low:
            out = out | (_value(measure) < F.col(f"{measure}_low"))
    return F.coalesce(out, F.lit(False))


def _fences(rows: DataFrame) -> DataFrame:
    """For each language and source the fences of every measure, from sketches merged upwards."""
    valued = rows.filter("m.n_words > 0").select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), _value(m).alias("v")) for m in MEASURES])).alias("s"))
    sketch = materialise(valued.groupBy("lang", "source", "s.measure", sketch_bucket(F.col("s.v")).alias("bucket"))
                         .agg(F.count("*").alias("n")))
    none = F.lit(None).cast("string")
    level = {0: sketch.select(F.lit(0).alias("level"), "lang", "source", "measure", "bucket", "n")}
    level[1] = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n")).select(
        F.lit(1).alias("level"), "lang", none.alias("source"), "measure", "bucket", "n")
    level[2] = sketch.groupBy("measure", "bucket").agg(F.sum("n").alias("n")).select(
        F.lit(2).alias("level"), none.alias("lang"), none.alias("source"), "measure", "bucket", "n")
    group = Window.partitionBy("level", "lang", "source", "measure")  # a few hundred buckets at most
    merged = (level[0].unionByName(level[1]).unionByName(level[2])
              .withColumn("below", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
              .groupBy("level", "lang", "source", "measure").agg(
                  F.max("all").alias("docs"),
                  F.min(F.when(F.col("below") * 4 >= F.col("all"), F.col("bucket"))).alias("q1"),
                  F.min(F.when(F.col("below") * 4 >= F.col("all") * 3, F.col("bucket"))).alias("q3")))
    width = {m: F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * FENCE for m, (least, _) in MEASURES.items()}

    def at(m: str, value: Column) -> Column:
        return F.max(F.when(F.col("measure") == m, value))

    made = merged.groupBy("level", "lang", "source").agg(
        F.max("docs").alias("docs"),
        *[at(m, F.col("q3") + width[m]).alias(f"{m}_high") for m in MEASURES],
        *[at(m, F.col("q1") - width[m]).alias(f"{m}_low") for m, (_, low) in MEASURES.items() if low])
    names = [c for c in made.columns if c.endswith(("_high", "_low"))]
    own = made.filter("level = 0")
    by_lang = made.filter("level = 1").select(F.col("lang").alias("l_lang"), F.col("docs").alias("l_docs"), *[F.col(c).alias(f"l_{c}") for c in names])
    overall = made.filter("level = 2").select(*[F.col(c).alias(f"a_{c}") for c in names])  # one row
    few = F.lit(FEW)
    return own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left").select(
        F.col("lang").alias("for_lang"), F.col("source").alias("for_source"),
        *[F.when(F.col("docs") >= few, F.col(c)).when(F.col("l_docs") >= few, F.col(f"l_{c}"))
          .otherwise(overall.select(f"a_{c}").scalar()).alias(c) for c in names])


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows that ``judged`` keeps, with all their columns. The texts are measured where they lie, once for
    the sketches and once for the verdict, and are not moved."""
    group = [F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), measures(F.col(text_col)).alias("m")]
    measured = materialise(df.select(*group))
    fences = materialise(_fences(measured))
    discard(measured)
    rows = df.select(F.struct("*").alias("row"), *group)
    # One condition over both sides of the join: a part of it below the join would measure every text again.
    rejected = F.coalesce(_base_failed() | _outside(), F.lit(True))
    return rows.join(fences, _same_group(rows, fences, "lang", "source"), "left").filter(~rejected).select("row.*")
