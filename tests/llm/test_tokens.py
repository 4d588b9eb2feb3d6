import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillcast.llm import bpe, packing, piece_counts, queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", " a  b ", "a  \n b", "a \n b", "it's  we'll \t\n x", "1234 héé ①　x", "a" * 3000, " " * 300 + "x", "\n\n \n a",
       "\x1c a\x85b \x1f", "x \xa0 y", "<|endoftext|>x <|endoftext|>", "<s> </s> <unk> <0x0A>", "▁a ▁▁ b▁c", "\x00\x01", "-" * 700, "😀😀 👩‍👩"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def texts():
    draw = random.Random(7)
    alphabet = "abcdethe  ngio'né\n.,9\t"
    return ODD + ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(500)]


def test_bpe_equals_library(library):
    own = bpe.Encoder(BYTES)
    for _ in range(2):  # the second time from memory
        for text, packed, want in zip(texts(), own.encode(texts()), library.encode_batch(texts(), add_special_tokens=False)):
            assert np.frombuffer(packed, "<u4").tolist() == want.ids, text
            assert own.decode(packed) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_bounded_memory(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    own = bpe.Encoder(BYTES)
    for text in texts()[:200]:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.chunks) < 100


def test_prefix_is_worked_out_once():
    own = bpe.BytePairs(BYTES)
    found = own.encode_words([b"under", b"understand", b"understanding", b""])
    assert found[b""] == [] and own.token_bytes[found[b"under"][0]] == b"under"
    assert all(b"".join(own.token_bytes[i] for i in ids) == word for word, ids in found.items())


def test_bpe_on_edge_rows(edge, empty, edge_rows, library):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(edge, BYTES).collect())
    want = []
    for doc_id, text, *_ in edge_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False) if ids else ""
        want.append((doc_id or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(empty, BYTES).count() == 0
    again = bpe.decode(bpe.encode(edge, BYTES), BYTES)
    assert sorted((r.doc_id or -1, r.text) for r in again.collect()) == sorted((r[0] or -1, r[1] or "") for r in edge_rows)


def test_piece_counts_equal_library():
    own, library = piece_counts.PieceCounter(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert own.count(texts()) == [len(x) for x in library.encode(texts())]


def test_long_pre_tokens(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    draw = random.Random(3)
    words = ["".join(draw.choice("abetho\nx①") for _ in range(n)) for n in (600, 2000, 5000)] + ["ab" * 900, "\n" * 700]
    own = piece_counts.PieceCounter(PIECES)
    assert own.count(words) == [len(x) for x in library.encode(words)]
    monkeypatch.setattr(piece_counts, "SYMBOLS", 50)
    own = piece_counts.PieceCounter(PIECES)
    assert own.count(texts()[:100]) == [len(x) for x in library.encode(texts()[:100])]


def test_piece_counts_on_edge_rows(edge, empty, edge_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in piece_counts.token_counts(edge, PIECES).collect())
    counts = [(r[0] or -1, len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in edge_rows]
    assert got == sorted((*c, c[2] > 4096) for c in counts)
    assert any(r[3] for r in got) and piece_counts.token_counts(empty, PIECES).count() == 0


def test_hilbert_curve_moves_one_step_at_a_time():
    points = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert(points, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, documents, length):
    """documents: the ids of each document with its key; rows: pieces with the same key."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sum(r.length for r in rows) == sum(map(len, documents))
    want = sorted(zlib.crc32(np.array(d, "<u4").tobytes()) for d in documents if len(d) < 10)
    whole = sorted(r.ids_crc32 for r in rows if r.length == r.doc_tokens < 10)
    assert set(whole) <= set(want)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    sizes = []
    for s in sorted(by_sequence):
        at = 0
        for r in sorted(by_sequence[s], key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        sizes.append(at)
    full = [n for n in sizes if n == length]
    rest = sizes[len(full):]
    assert rest == sorted(rest, reverse=True) and all(n & (n - 1) == 0 and n < length for n in rest) and len(set(rest)) == len(rest)


def test_packing_edge_rows(edge, empty, edge_rows, library):
    ids = [library.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in edge_rows]
    for length in (2048, 7):
        check_packing(packing.pack(edge, BYTES, length).collect(), ids, length)
    assert packing.pack(empty, BYTES).count() == 0


def test_packing_pieces_hold_their_ids(spark, folder, docs, library):
    rows = queries.op4_curve_packing(spark, folder).collect()
    ids = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    at = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start:r.start + r.length], "<u4").tobytes())
        at[r.doc_id] += r.length
    assert all(at[d] == len(own) for d, own in ids.items())
    check_packing(rows, list(ids.values()), 2048)


def test_alike_documents_are_neighbours():
    own = packing.Ids(BYTES)
    slots = np.arange(own.size) % packing.HASHED
    one, other = own.of("the cat sat on the mat " * 20), own.of("quantum field theory of solids " * 20)
    keys = packing.curve_keys([one, other, own.of("the cat sat on the mat " * 21)], slots)
    assert abs(int(keys[0]) - int(keys[2])) < abs(int(keys[0]) - int(keys[1]))
