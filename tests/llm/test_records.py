import io
import os
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tiermart.llm import records
from tiermart.llm.records import (
    WordTokenizer, check_index, framed, masked, parsed, payload_of, read_index, read_record, read_sequences,
    read_shuffled, stored_sequences, write_sequences,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
EXACT = Tokenizer.from_file(PATH)
WORDS = WordTokenizer(PATH)
DOCS = "doc_id long, text string, ids string, start int, hash int, nth long"


def ids_of(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids


def brute(docs):
    """(doc_id, start, n_tokens, ids) of documents in their order."""
    rows, start = [], 0
    for doc_id, text in docs:
        ids = np.array([*ids_of(text), 1], "<u4")
        rows.append((doc_id, start, len(ids), ids.tobytes()))
        start += len(ids)
    return rows


def frame(spark, docs):
    return spark.createDataFrame([(*d, "i", 1, 2, 3) for d in docs], DOCS).repartition(3)


@settings(max_examples=400, deadline=None)
@given(
    st.one_of(
        st.text(max_size=20),
        st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=20),
        st.text(alphabet=st.sampled_from("'sStrevml d12\t\n\x1c\x85\xa0İıſŸéÉ²½ª!?-<|>"), max_size=20),
    )
)
def test_ids_as_the_library(text):
    assert np.frombuffer(WORDS.encode(text), WORDS.kind).tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["<|endoftext|> a", "A<|startoftext|>b", "漢字 ok", "é É", "ΑΣ ς"])
def test_other_texts(text):
    assert np.frombuffer(WORDS.encode(text), WORDS.kind).tolist() == ids_of(text)


@settings(max_examples=100, deadline=None)
@given(
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.lists(st.integers(0, 2**16 - 1), max_size=30),
    st.sampled_from([2, 4]),
)
def test_payload_round_trip(doc_id, ids, width):
    record = framed(payload_of(doc_id, np.array(ids, f"<u{width}").tobytes(), width))
    found, back = parsed(read_record(io.BytesIO(record)))
    assert found == doc_id and back.tolist() == ids


def test_record_layout():
    payload = payload_of(7, np.array([3, 1], "<u2").tobytes(), 2)
    record = framed(payload)
    assert struct.unpack_from("<Q", record)[0] == len(payload) == 13
    crc = zlib.crc32(payload)
    assert struct.unpack("<I", record[-4:])[0] == ((crc >> 15 | crc << 17 & 0xFFFFFFFF) + 0xA282EAD8) % 2**32
    assert masked(b"") == 0xA282EAD8


def test_any_damage_is_an_error():
    record = framed(payload_of(7, b"\1\2\3\4", 2))
    for at in range(len(record)):
        damaged = bytearray(record)
        damaged[at] ^= 16
        with pytest.raises(ValueError):
            read_record(io.BytesIO(bytes(damaged)))
        with pytest.raises(ValueError):
            read_record(io.BytesIO(record[:at]))
    index = np.array([(0, 0), (29, 2)], "<u8").tobytes()
    check_index(index + struct.pack("<I", masked(index)))
    with pytest.raises(ValueError):
        check_index(index + struct.pack("<I", masked(index) ^ 1))


DOCUMENTS = [(i, f"Some text {i}, it's number {i * 37 % 11}.\nMore of it " + "word " * (i % 9)) for i in range(60)]


def test_files_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "READ", 4)
    folder = str(tmp_path / "out")
    manifest = write_sequences(frame(spark, DOCUMENTS), PATH, folder, roll=200)
    files = sorted(manifest.collect(), key=lambda r: (r.partition, r.part))
    assert len(files) > 8 and max(r.part for r in files) > 0
    assert sum(r.records for r in files) == 60
    # the files themselves, read one after the other without Spark
    order, before = [], 0
    for r in files:
        with open(f"{folder}/{r.name}.idx", "rb") as file:
            check_index(file.read())
            index = read_index(file, 0, r.records)
        with open(f"{folder}/{r.name}.rec", "rb") as file:
            for place, ids_before in index[:-1].tolist():
                assert file.tell() == place
                doc_id, ids = parsed(read_record(file))
                order.append((doc_id, before + ids_before, len(ids), ids.tobytes()))
            assert file.read() == b"" and index[-1].tolist() == [r.bytes, r.ids]
        before += r.ids
    assert order == brute(DOCUMENTS)
    assert sorted(tuple(r) for r in read_sequences(manifest, folder).collect()) == order


def test_shuffled_reads(spark, tmp_path):
    folder = str(tmp_path / "out")
    manifest = write_sequences(frame(spark, DOCUMENTS), PATH, folder, roll=300)
    one, again, other = (
        [tuple(r)[1:] for r in read_shuffled(manifest, folder, seed).collect()] for seed in (1, 1, 2)
    )
    assert one == again != other
    assert sorted(one) == sorted(other) == brute(DOCUMENTS)
    assert one != sorted(one)


def test_files_of_failed_attempts_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "out")
    manifest = write_sequences(frame(spark, DOCUMENTS), PATH, folder)
    for name in os.listdir(folder):
        if name.endswith(".rec"):
            with open(f"{folder}/x{name}", "wb") as file:
                file.write(b"half a file")
    assert sorted(tuple(r) for r in read_sequences(manifest, folder).collect()) == brute(DOCUMENTS)


def test_damaged_file_fails(spark, tmp_path):
    folder = str(tmp_path / "out")
    manifest = write_sequences(frame(spark, DOCUMENTS), PATH, folder)
    name = manifest.first().name
    with open(f"{folder}/{name}.rec", "r+b") as file:
        file.seek(30)
        byte = file.read(1)
        file.seek(30)
        file.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged"):
        read_sequences(manifest, folder).collect()


def test_odd_rows(spark):
    docs = [(None, "no id"), (1, None), (2, ""), (3, "word " * 60_000), (4, "twice"), (4, "twice"), (5, " \n ")]
    got = sorted((tuple(r) for r in stored_sequences(frame(spark, docs), PATH).collect()), key=lambda r: r[1])
    assert got == brute(docs)
    assert stored_sequences(frame(spark, []), PATH).collect() == []


def test_rows_without_id_come_first(spark):
    docs = [(2, "b"), (None, "a"), (-5, "c")]
    got = stored_sequences(frame(spark, docs), PATH).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, -5, 2]
