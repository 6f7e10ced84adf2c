"""Token ids in binary files: framed records with masked checksums, and an offset index beside them.

A data file is a sequence of records, each

    length      8 bytes, of the payload
    checksum    4 bytes, of the eight above
    payload
    checksum    4 bytes, of the payload

and a payload is one byte (2 or 4, the bytes of an id; 128 is added where there is no document id), the
document id in 8 bytes, and the ids. The index file has 16 bytes per record, its place in the data file and the
number of ids before it in that file, then 16 bytes for the end of the file and 4 for the checksum of all these. Numbers
are little-endian, checksums are CRC-32 turned by 15 bits plus a constant, so that a checksum of
data that hold checksums is no weaker.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import column, ship_package, texts_of
from tiermart.session import materialise, scratch_path

ROLL = 256 * 1024 * 1024  # bytes after which a task begins another file
READ = 1024  # records that are read at a time
SPLIT = 128 * 1024 * 1024  # bytes a reading task gets, about
OPEN = 32  # files that a task of a shuffled read keeps open
WORDS = 500_000  # words whose ids a worker remembers, and as many of earlier ones

MANIFEST = "partition int, part int, name string, records long, ids long, bytes long"
SEQUENCES = "doc_id long, start long, n_tokens long, ids binary"

# characters up to here are their own composed form, and so are their lower-case forms
SIMPLE = 0x17F
_OTHER = re.compile(f"[^\0-{chr(SIMPLE)}]|İ")
# White space and the contractions that the tokenizer's pattern names.
_SPACES = "\t-\r \x85\xa0"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _class(first: str) -> str:
    """The simple characters whose category begins with a letter, for a character class."""
    return "".join(
        re.escape(chr(c)) for c in range(SIMPLE + 1) if unicodedata.category(chr(c))[0] == first
    )


def _byte_signs() -> list[str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others in order from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    signs = {**{b: chr(b) for b in shown}, **{b: chr(256 + n) for n, b in enumerate(rest)}}
    return [signs[b] for b in range(256)]


class _Known(dict):
    """The ids of words met before; when there are too many, those not met again are forgotten."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(self) >= WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordTokenizer:
    """Ids of a vocabulary with word ends, as `tokenizers` gives them.

    The vocabulary's pattern divides a lower-case text into words, whose ids do not depend on what stands
    around them. In texts of simple characters the same division is done here, and the library's
    model encodes each different word once; other texts, and those that hold a special token, go
    through the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.model = self.exact.model
        self.special = [token.content for token in self.exact.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.exact.get_vocab_size() <= 1 << 16 else "<u4")
        letters, numbers = _class("L"), _class("N")
        self.words = re.compile(
            f"[{letters}]+|{_CONTRACTIONS}|[{numbers}]|[^{_SPACES}{letters}{numbers}]+"
        ).findall
        self.signs = _byte_signs()
        self.known = _Known(self._word)

    def _word(self, word: str) -> bytes:
        shown = "".join([self.signs[b] for b in word.encode()])
        return np.array([token.id for token in self.model.tokenize(shown)], self.kind).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, `kind` by `kind`."""
        if (not text.isascii() and _OTHER.search(text)) or any(s in text for s in self.special):
            return self._whole(text)
        return b"".join(map(self.known.__getitem__, self.words(text.lower())))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)))
    )


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack("<Bq", width + 128 * (doc_id is None), doc_id or 0) + ids


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, doc_id = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, f"<u{width & 127}", offset=9)
    return None if width & 128 else doc_id, ids.astype("<u4")


def read_record(file) -> bytes:
    """The payload of the record at the present place; an error for anything but a whole and right one."""
    head = file.read(12)
    if len(head) < 12 or masked(head[:8]) != struct.unpack_from("<I", head, 8)[0]:
        raise ValueError("a record's length is damaged")
    length = struct.unpack_from("<Q", head)[0]
    body = file.read(length + 4)
    if len(body) < length + 4 or masked(body[:length]) != struct.unpack_from("<I", body, length)[0]:
        raise ValueError("a record is damaged")
    return body[:length]


def read_index(file, first: int, count: int) -> np.ndarray:
    """(place, ids before) of `count` records from the `first`, and of what follows them."""
    file.seek(16 * first)
    return np.frombuffer(file.read(16 * (count + 1)), "<u8").reshape(-1, 2)


def check_index(data: bytes) -> None:
    if len(data) < 20 or masked(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("an index is damaged")


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder and the folder's name there."""
    if path.startswith("file:"):
        path = re.sub("^file:/*", "/", path)
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


class _Writer:
    """Data and index files of one task."""

    def __init__(self, folder: str) -> None:
        self.store, self.folder = _store(folder)
        self.store.create_dir(self.folder, recursive=True)
        task = TaskContext.get()
        self.partition, self.attempt = task.partitionId(), task.taskAttemptId()
        self.part = 0
        self._begin()

    def _begin(self) -> None:
        # the name holds the attempt: one that fails leaves files that no manifest lists
        self.name = f"{self.partition:06d}-{self.attempt}-{self.part:04d}"
        self.data = self.store.open_output_stream(f"{self.folder}/{self.name}.rec")
        self.entries: list[tuple[int, int]] = [(0, 0)]

    def add(self, record: bytes, ids: int) -> None:
        self.data.write(record)
        place, before = self.entries[-1]
        self.entries.append((place + len(record), before + ids))

    def end(self) -> dict:
        self.data.close()
        index = np.array(self.entries, "<u8").tobytes()
        with self.store.open_output_stream(f"{self.folder}/{self.name}.idx") as file:
            file.write(index + struct.pack("<I", masked(index)))
        place, ids = self.entries[-1]
        found = {
            "partition": self.partition, "part": self.part, "name": self.name,
            "records": len(self.entries) - 1, "ids": ids, "bytes": place,
        }
        self.part += 1
        return found


_MANIFEST = pa.schema(
    {
        "partition": pa.int32(), "part": pa.int32(), "name": pa.string(),
        "records": pa.int64(), "ids": pa.int64(), "bytes": pa.int64(),
    }
)


def write_sequences(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, roll: int = ROLL
) -> DataFrame:
    """Write the ids of docs(doc_id, text) in ascending doc_id order; the manifest of the files.

    A document is the ids of its text and an end id; a null or empty text is the end id alone. Rows
    that repeat a doc_id are records of their own, in the order of a hash of the text; rows without id
    come first. Other columns are ignored. No rows give no files.

    One range partitioning places the rows; each task then encodes and writes its range, so the texts are read
    and moved once. Tasks write files named by their attempt; the manifest, stored in the shared
    folder, lists those of the attempts that counted. A range of many ids with few values cannot
    be hot, as rows that agree in id and text are divided as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(tokenizer)
        width = words.kind.itemsize
        end = np.array([end_id], words.kind).tobytes()
        writer = None
        for batch in batches:
            for doc_id, text in zip(column(batch, "doc_id"), texts_of(batch)):
                ids = words.encode(text) + end
                if writer is None:
                    writer = _Writer(folder)
                elif writer.entries[-1][0] >= roll:
                    yield pa.RecordBatch.from_pylist([writer.end()], schema=_MANIFEST)
                    writer._begin()
                writer.add(framed(payload_of(doc_id, ids, width)), len(ids) // width)
        if writer is not None:
            yield pa.RecordBatch.from_pylist([writer.end()], schema=_MANIFEST)

    ship_package(docs.sparkSession)
    order = ["doc_id", "hash", "nth"]
    placed = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("hash", F.xxhash64("text"))
        .withColumn("nth", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    return materialise(placed.select("doc_id", "text").mapInArrow(run, MANIFEST), "manifest")


_SEQUENCES = pa.schema(
    {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
)


def _sequence(payload: bytes, start: int) -> dict:
    doc_id, ids = parsed(payload)
    return {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids": ids.tobytes()}


def _tasks(manifest: DataFrame) -> int:
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-total // SPLIT))


def _started(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in all files before; one row per file."""
    before = Window.orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_sequences(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the records of the files, `start` counting all ids before.

    `ids` are unsigned 32-bit numbers, little-endian. A file is read in parts, found by its index; damaged
    records and indexes are errors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{place}/{row['name']}.idx") as file:
                    if row["first"] == 0:  # once a file
                        check_index(file.read())
                    index = read_index(file, row["first"], row["count"])
                found, size = [], 0
                with store.open_input_file(f"{place}/{row['name']}.rec") as file:
                    file.seek(int(index[0, 0]))
                    for (_, ids), (after, _) in zip(index, index[1:]):
                        payload = read_record(file)
                        if file.tell() != after:
                            raise ValueError("an index does not fit its records")
                        found.append(_sequence(payload, row["before"] + int(ids)))
                        size += len(payload)
                        if size > 1 << 24:
                            yield pa.RecordBatch.from_pylist(found, schema=_SEQUENCES)
                            found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema=_SEQUENCES)

    ship_package(manifest.sparkSession)
    firsts = F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(READ).cast("long"))
    return (
        _started(manifest)
        .select("name", "before", "records", F.explode(firsts).alias("first"))
        .withColumn("count", F.least(F.col("records") - F.col("first"), F.lit(READ)))
        .repartition(_tasks(manifest), "name", "first")
        .mapInArrow(run, SEQUENCES)
    )


def read_shuffled(manifest: DataFrame, folder: str, seed: int) -> DataFrame:
    """(key, doc_id, start, n_tokens, ids): every record once, in an order that depends on the seed only.

    Rows are ordered by `key`, a hash of the seed and the record's number; each is found by
    its entry in the index, without reading what stands around it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        files: OrderedDict[str, tuple] = OrderedDict()

        def opened(name: str) -> tuple:
            if name not in files:
                if len(files) >= OPEN:
                    for file in files.popitem(last=False)[1]:
                        file.close()
                files[name] = tuple(
                    store.open_input_file(f"{place}/{name}.{kind}") for kind in ("idx", "rec")
                )
            files.move_to_end(name)
            return files[name]

        schema = pa.schema([pa.field("key", pa.int64()), *_SEQUENCES])
        for batch in batches:
            found, size = [], 0
            for row in batch.to_pylist():
                index, data = opened(row["name"])
                at, ids = read_index(index, row["number"], 0)[0].tolist()
                data.seek(at)
                payload = read_record(data)
                found.append({"key": row["key"], **_sequence(payload, row["before"] + ids)})
                size += len(payload)
                if size > 1 << 24:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)
                    found, size = [], 0
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    ship_package(manifest.sparkSession)
    number = F.sequence(F.lit(0).cast("long"), F.col("records") - 1)
    return (
        _started(manifest)
        .select("partition", "part", "name", "before", F.explode(number).alias("number"))
        .select("name", "before", "number", F.xxhash64("partition", "part", "number", F.lit(seed)).alias("key"))
        .repartitionByRange(_tasks(manifest), "key")
        .sortWithinPartitions("key", "name", "number")
        .mapInArrow(run, f"key long, {SEQUENCES}")
    )


def stored_sequences(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of docs(doc_id, text), written to the shared folder and read back."""
    folder = scratch_path(docs.sparkSession, "sequences")
    return read_sequences(write_sequences(docs, tokenizer, folder, end_id), folder)
