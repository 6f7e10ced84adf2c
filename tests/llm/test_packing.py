import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tiermart.llm.packing import ByteTokenizer, _tokenizer, pack, plan_best_fit, token_pieces

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def slots(runs):
    """sequence -> sorted (offset, length) of all planned items."""
    found = {}
    for length, first, last, each, sequence, offset in runs:
        for rank in range(first, last + 1):
            number, place = divmod(rank - first, each)
            found.setdefault(sequence + number, []).append((offset + place * length, length))
    return {k: sorted(v) for k, v in found.items()}


def best_fit(items, capacity):
    """Item by item, as a reference."""
    left = []
    for item in sorted(items, reverse=True):
        fits = [i for i, room in enumerate(left) if room >= item]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= item
        else:
            left.append(capacity - item)
    return len(left)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=20))
def test_plan_fills_without_gaps_and_as_well_as_best_fit(counts):
    runs = plan_best_fit(counts, 40)
    planned = slots(runs)
    for items in planned.values():
        ends = [offset + length for offset, length in items]
        assert [offset for offset, _ in items] == [0, *ends[:-1]] and ends[-1] <= 40
    lengths = sorted(length for items in planned.values() for _, length in items)
    assert lengths == sorted(l for l, n in counts.items() for _ in range(n))
    assert len(planned) == best_fit(lengths, 40)
    for length, n in counts.items():
        ranks = [r for run in runs if run[0] == length for r in range(run[1], run[2] + 1)]
        assert ranks == list(range(n))


def test_plan_does_not_grow_with_the_number_of_items():
    counts = {length: 1000 + length for length in range(1, 2049)}
    many = {length: 10**9 + length for length in range(1, 2049)}
    assert len(plan_best_fit(many, 2048)) < 30 * 2048
    assert len(plan_best_fit(counts, 2048)) < 30 * 2048


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x52F), st.sampled_from(" \n\t'’–aé1")), max_size=60))
def test_both_libraries_give_equal_ids(text):
    tokenizer = _tokenizer(JSON, RANKS)
    assert tokenizer.encode(text).tolist() == tokenizer.exact.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_other_scripts_are_encoded_as_by_the_library():
    special = "a <|endoftext|> b 漢字 😀"
    exact = Tokenizer.from_file(JSON)
    assert ByteTokenizer(JSON, RANKS).encode(special).tolist() == exact.encode(special, add_special_tokens=False).ids


def test_pieces(spark):
    texts = [(1, "one two three"), (2, None), (3, ""), (None, "x"), (4, "word " * 5000), (1, "one two three")]
    docs = spark.createDataFrame([(i, t, "s", 9, 9) for i, t in texts], "doc_id long, text string, source string, piece int, length long")
    got = token_pieces(docs, JSON, RANKS).collect()
    exact = Tokenizer.from_file(JSON)
    expected = []
    for doc_id, text in texts:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_pack(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), 0, 0, int(n), int(n)) for i, n in enumerate(rng.integers(1, 300, 400))]
    rows += [(7, 0, 0, 50, 1)] * 150 + [(None, 0, 0, 50, 1)] * 3  # a hot length, repeated rows
    got = pack(spark.createDataFrame(rows, PIECE), 300).collect()
    assert sorted(tuple(r)[:5] for r in got if r.doc_id is not None) == sorted(r for r in rows if r[0] is not None)
    assert len(got) == len(rows)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in map(sorted, places.values()):
        ends = [o + n for o, n in items]
        assert [o for o, _ in items] == [0, *ends[:-1]] and ends[-1] <= 300
    assert len(places) == best_fit([r[3] for r in rows], 300)


def test_pack_of_nothing_and_of_wrong_lengths(spark):
    assert pack(spark.createDataFrame([], PIECE)).collect() == []
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 0, 0, 0, 0)], PIECE))
