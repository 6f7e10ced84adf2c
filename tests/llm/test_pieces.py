import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tiermart.llm.pieces import CharacterMap, encode_pieces, piece_digests, piece_model

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "Hello  world", " a\n\tb ", "漢字 😀é", "x" * 3000, "the of " * 4000, None, "▁ ▁▁", "á ﬁ"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_texts_and_spans(spark, library):
    rows = [(i, t, "s", [1]) for i, t in enumerate(TEXTS)] + [(None, "a b", "s", None), (1, TEXTS[1], "s", [1])]
    got = encode_pieces(spark.createDataFrame(rows, "doc_id long, text string, source string, ids array<int>"), PATH).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t, *_ in rows}
    for row in got:
        text = texts[row.doc_id]
        ids = library.encode(text, add_eos=True)
        assert row.ids == ids and row.decoded == library.decode(ids)
        assert "▁" in text or row.decoded == text
        data = text.encode()
        assert b"".join(data[a:b] for a, b in zip(row.starts, row.ends)) == data
        for i, a, b in zip(ids, row.starts, row.ends):
            if not library.is_control(i) and not library.is_byte(i):
                piece = library.id_to_piece(i).replace("▁", " ")
                assert piece.lstrip(" ") == data[a:b].decode().replace("▁", " ").lstrip(" ")
            if library.is_byte(i):
                assert library.id_to_piece(i) == f"<0x{data[a]:02X}>" and b == a + 1


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=50))
def test_spans_are_those_of_the_library(text):
    model = piece_model(PATH)
    library = model.library
    pieces = list(library.encode(text, return_type="proto").pieces)
    starts, ends = model.spans(text, np.array([p.id for p in pieces], dtype=np.int64))
    for piece, a, b in zip(pieces, starts, ends):
        if not library.is_byte(piece.id):
            assert (a, b) == (piece.begin, piece.end)
    general, places = model._align_mapped(text.encode())
    plain, same = model._align_plain(text.encode())
    assert general == plain and places.tolist() == same.tolist()


def test_digests(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = piece_digests(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    for row in got:
        ids = library.encode(TEXTS[row.doc_id] or "", add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piece_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def compiled(entries):
    """A double-array trie of the compiled form, one block of 256 units per node."""
    texts, places = b"", {}
    for value in entries.values():
        places[value] = len(texts)
        texts += value + b"\0"
    nodes = sorted({key[:i] for key in entries for i in range(len(key) + 1)}, key=lambda k: (len(k), k))
    block = {prefix: 256 * (i + 1) for i, prefix in enumerate(nodes)}
    units = np.zeros(256 * (len(nodes) + 1), dtype="<u4")
    for prefix in nodes:
        at = block[prefix[:-1]] ^ prefix[-1] if prefix else 0
        offset = block[prefix] ^ at
        units[at] = (prefix[-1] if prefix else 0) | (prefix in entries) << 8 | offset << 10
        if prefix in entries:
            units[block[prefix]] = places[entries[prefix]] | 1 << 31
    return len(units.tobytes()).to_bytes(4, "little") + units.tobytes() + texts


def test_longest_prefix_of_a_character_map():
    charmap = CharacterMap(compiled({b"a": b"A", b"abc": b"xyz", "é".encode(): b"e", b"\t": b" "}))
    assert charmap.longest(b"abcd", 0) == (3, b"xyz")
    assert charmap.longest(b"zab", 1) == (1, b"A")
    assert charmap.longest("é".encode(), 0) == (2, b"e")
    assert charmap.longest(b"b", 0) is None and charmap.longest(b"", 0) is None
    model = piece_model(PATH)
    before = model.map, model.squeeze
    model.map, model.squeeze = charmap, True
    try:
        text = "  abcé\t\t b a  "
        normalised, places = model.align(text)
        assert normalised.decode() == "▁xyze▁b▁A"
        assert places.tolist() == [2] * 6 + [5] + [7] * 3 + [10] + [11] * 3 + [12] + [15]
    finally:
        model.map, model.squeeze = before
