"""The pipeline's stages and their order, each held against plain Python on planted documents."""
import random

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(draw, n=60):
    return " ".join("".join(draw.choice("abcdefghijklmnoprstuv") for _ in range(draw.randint(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """(id, text): clean documents of three lines, and below what each stage should act upon."""
    draw = random.Random(5)
    clean = {k: "\n".join(sentence(draw) for _ in range(3)) for k in range(40)}
    rows = list(clean.items())
    rows += [(100, "too few words"), (101, "again and again " * 40), (102, None), (103, "")]  # quality rules
    shared = clean[3].split("\n")[1]
    rows += [(110, f"{sentence(draw)}\n{shared.upper()}!\n{sentence(draw)}"), (111, clean[4])]  # a line of 3; a copy as a whole
    words = clean[5].replace("\n", " \n ").split(" ")
    for at in (7, 75, 150):
        words[at] = "changed"
    rows += [(120, " ".join(words).replace(" \n ", "\n"))]  # near copy of 5
    rows += [(130, f"{sentence(draw)} write to jane.doe@example.com or 10.20.30.40 soon {sentence(draw)}")]
    draw.shuffle(rows)
    return clean, rows


@pytest.fixture(scope="module")
def stages(spark, planted):
    """What every stage made of the documents before."""
    frame = spark.createDataFrame([(k, t, "en", "web", len(t or "")) for k, t in planted[1]], COLUMNS).repartition(3)
    out, docs = {}, frame
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused").cache()
        out[name] = docs
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_in_order_with_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "pii_surrogates", "curve_packing"]
    for name, frame in list(stages.items())[:-1]:
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name != "quality_rules":
            assert frame.filter(F.length("text") != F.col("n_chars")).count() == 0, name


def test_quality_rules_reject_only_the_bad(stages, planted):
    def failed(text):
        words = (text or "").encode().split()
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        return len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    assert texts(stages["quality_rules"]) == {k: t for k, t in planted[1] if not failed(t)}


def test_lines_that_repeat_go(stages, planted):
    clean, rows = planted
    got, before = texts(stages["line_dedup"]), dict(rows)
    assert 111 not in got and got[110] == "\n".join(before[110].split("\n")[::2])
    assert all(got[k] == t for k, t in clean.items())
    assert set(got[120].split("\n")) <= set(before[120].split("\n")) if 120 in got else True


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_one_document_of_each_near_group_stays(stages):
    before, got = texts(stages["line_dedup"]), texts(stages["ngram_jaccard_join"])
    gone = set()
    for a in sorted(before):
        for b in sorted(before):
            one, two = shingles(before[a]), shingles(before[b])
            if a < b and len(one & two) >= 0.8 * len(one | two):
                gone.add(b)
    assert got == {k: t for k, t in before.items() if k not in gone}
    assert 120 not in got and 5 in got


def test_personal_data_are_replaced(stages):
    before, got = texts(stages["ngram_jaccard_join"]), texts(stages["pii_surrogates"])
    assert got.keys() == before.keys() and {k for k in got if got[k] != before[k]} == {130}
    assert "jane" not in got[130] and "10.20.30.40" not in got[130] and "@" in got[130]
    assert got[130].split(" ")[:60] == before[130].split(" ")[:60]


def test_pieces_hold_every_token_once(stages):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in texts(stages["pii_surrogates"]).items()}
    pieces, places = {}, {}
    for r in stages["curve_packing"].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for runs, whole in [(v, sizes[k]) for k, v in pieces.items()] + [(v, None) for v in places.values()]:
        end = 0
        for start, length in sorted(runs):
            assert start == end
            end += length
        assert end == whole if whole else end <= 2048
    assert pieces.keys() == sizes.keys()


@pytest.fixture(scope="module")
def edge_result(spark, edge, tmp_path_factory):
    """Null ids, empty and very long texts, ties, repeated rows, columns named like the operators' own; one clean text
    four times, twice without an id."""
    folder = tmp_path_factory.mktemp("edge")
    text = sentence(random.Random(9), 80)
    more = spark.createDataFrame([(i, text, "en", "a", len(text), 0, "x", 1.5, [0]) for i in (None, 50, 50, None)], edge.schema)
    edge.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_edge_rows_pass_the_pipeline(edge_result):
    ids = [r.doc_id for r in edge_result]
    assert sum(i in (50, None) for i in ids) == 1  # one of the four copies, in one piece
    assert not set(ids) & {1, 2, 3, 4, 5, 6}  # too few words


def test_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
