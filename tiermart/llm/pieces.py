"""Offset-preserving SentencePiece encoding, and decoding."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, texts_of

SPACE = "▁".encode()

ENCODED = (
    "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
)
DIGESTS = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
)


class CharacterMap:
    """The compiled character map of a model: a double-array trie of prefixes and their
    replacements, as one byte string."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.replacements = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of source[at:], and its replacement."""
        units, best = self.units, None
        node = _offset(units[0])
        for end in range(at, len(source)):
            node ^= source[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != source[end]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                best = end + 1 - at, value
        if best is None:
            return None
        length, value = best
        return length, self.replacements[value : self.replacements.index(b"\0", value)]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class PieceModel:
    """A SentencePiece model that tells the bytes of the text each piece comes from.

    The text is normalised by longest prefixes of the model's character map, and each normalised
    byte keeps the place of the source bytes that it replaces. Ids are the
    library's. A piece covers as many normalised bytes as its surface has, which the
    alignment projects back to a byte span of the text.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        charsmap = spec.precompiled_charsmap
        self.map = CharacterMap(charsmap) if charsmap else None
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.space = SPACE if spec.escape_whitespaces else b" "
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        kinds = proto.ModelProto.SentencePiece
        self.own = [p.piece for p in model.pieces if p.type == kinds.USER_DEFINED]
        self.sizes = np.array(
            [
                1 if p.type == kinds.BYTE
                else 0 if p.type == kinds.CONTROL
                else len(p.piece.encode())
                for p in model.pieces
            ],
            dtype=np.int64,
        )

    def align(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them, and for their end, the source byte."""
        source = text.encode("utf-8", "surrogatepass")
        if self.map is None and not self.squeeze and not self.own and not self.suffix:
            return self._align_plain(source)
        return self._align_mapped(source)

    def _align_plain(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """No map: bytes stay, apart from the escaped spaces."""
        data = np.frombuffer(source, dtype=np.uint8)
        if not len(data):
            return b"", np.zeros(1, dtype=np.int64)
        widths = np.where(data == 32, len(self.space), 1)
        places = np.append(np.repeat(np.arange(len(data)), widths), len(data))
        normalised = source.replace(b" ", self.space)
        if self.prefix:
            normalised = self.space + normalised
            places = np.append(np.zeros(len(self.space), dtype=np.int64), places)
        return normalised, places

    def _align_mapped(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """Longest mapped prefix, else one character, from left to right."""
        parts: list[tuple[bytes, int]] = []
        own = [piece.encode() for piece in self.own]
        at = 0
        while at < len(source):
            kept = max((p for p in own if source.startswith(p, at)), key=len, default=None)
            found = None if kept or self.map is None else self.map.longest(source, at)
            if kept:
                length, text = len(kept), kept
            elif found:
                length, text = found
            else:
                length = next(n for n in (1, 2, 3, 4) if at + n >= len(source) or source[at + n] & 0xC0 != 0x80)
                text = source[at : at + length]
            parts.append((text, at))
            at += length
        if self.squeeze:
            parts = _squeezed(parts)
        out, places = bytearray(), []

        def add(text: bytes, place: int) -> None:
            escaped = text.replace(b" ", self.space)
            out.extend(escaped)
            # an unchanged character keeps the place of each of its bytes
            same = escaped == source[place : place + len(escaped)]
            places.extend(place + i * same for i in range(len(escaped)))

        if parts and self.prefix and not self.suffix:
            add(b" ", parts[0][1])
        for text, place in parts:
            add(text, place)
        if parts and self.prefix and self.suffix:
            add(b" ", len(source))
        return bytes(out), np.array([*places, len(source)], dtype=np.int64)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans in the text, one per id; control ids have an empty one."""
        normalised, places = self.align(text)
        sizes = self.sizes[ids] if len(ids) else np.zeros(0, dtype=np.int64)
        ends = np.cumsum(sizes)
        if (ends[-1] if len(ends) else 0) != len(normalised):
            return self._spans_with_unknown(text, ids, places, len(normalised))
        return places[ends - sizes], places[ends]

    def _spans_with_unknown(
        self, text: str, ids: np.ndarray, places: np.ndarray, size: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Models without byte pieces: an unknown piece is as long as its surface."""
        controls = [bool(self.library.is_control(int(i))) for i in ids]
        surfaces = iter(self.library.encode(text, out_type=str))
        sizes = np.array(
            [0 if control else len(next(surfaces).encode()) for control in controls], dtype=np.int64
        )
        ends = np.cumsum(sizes)
        if (ends[-1] if len(ends) else 0) != size:
            raise ValueError("the pieces do not cover the normalised text")
        return places[ends - sizes], places[ends]


def _squeezed(parts: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """Leading, trailing and repeated spaces taken out."""
    kept: list[tuple[bytes, int]] = []
    for text, place in parts:
        while text.startswith(b" ") and (not kept or kept[-1][0].endswith(b" ")):
            text = text[1:]
        if text:
            kept.append((text, place))
    while kept and kept[-1][0].endswith(b" "):
        text, place = kept.pop()
        if text.rstrip(b" "):
            kept.append((text.rstrip(b" "), place))
    return kept


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One per worker process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _encoded(batch: pa.RecordBatch, path: str):
    """(doc_id, text, ids, decoded) of every row of a batch, with an end id."""
    model, texts = piece_model(path), texts_of(batch)
    lists = model.library.encode(
        texts, add_bos=False, add_eos=True, enable_sampling=False, num_threads=1
    )
    for doc_id, text, ids in zip(column(batch, "doc_id"), texts, lists):
        yield doc_id, text, ids, model.library.decode(ids)


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, starts, ends, decoded) of docs(doc_id, text).

    `ids` are those of the library with an end id; piece k comes from the bytes
    starts[k] to ends[k] of the text in UTF-8. `decoded` is the library's decoding of the
    ids. A null text is an empty one. One row per input row, repeated
    or without id; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, rows = piece_model(path), []
        for doc_id, text, ids, decoded in _encoded(batch, path):
            starts, ends = model.spans(text, np.array(ids, dtype=np.int64))
            rows.append((doc_id, ids, starts, ends, decoded))
        ids, many = pa.int64(), pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(v, type=k)
                for v, k in zip(zip(*rows), (ids, many, many, many, pa.string()))
            ],
            names=["doc_id", "ids", "starts", "ends", "decoded"],
        )

    return _mapped(docs, run, ENCODED)


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32) of docs(doc_id, text).

    Digests of what `encode_pieces` gives, without sending the arrays to Spark.
    `spans_crc32` is over the starts, then the ends, as 64-bit little-endian numbers.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, rows = piece_model(path), []
        for doc_id, text, ids, decoded in _encoded(batch, path):
            starts, ends = model.spans(text, np.array(ids, dtype=np.int64))
            crc = zlib.crc32(ends.astype("<i8").tobytes(), zlib.crc32(starts.astype("<i8").tobytes()))
            rows.append(
                (doc_id, len(ids), _sha256(" ".join(map(str, ids))), _sha256(decoded), crc)
            )
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=k) for v, k in zip(zip(*rows), kinds)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
        )

    return _mapped(docs, run, DIGESTS)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _mapped(docs: DataFrame, run, schema: str) -> DataFrame:
    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        lambda batch: run(batch) if batch.num_rows else None,
        schema,
    )
