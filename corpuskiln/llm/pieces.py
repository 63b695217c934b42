"""SentencePiece encoding that keeps offsets: every piece is projected to bytes of the original text."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SPACE = "▁".encode()
ENCODED = "ids array<int>, begins array<int>, ends array<int>, decoded string"


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each entry of a protocol buffer message."""
    return ((key, value) for key, value, _ in _entries(message))


def _entries(message: bytes) -> Iterator[tuple[int, int | bytes, int]]:
    """Field number, value and end of each entry."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            value = varint()
            yield key >> 3, value, at
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            at += size
            yield key >> 3, message[at - size : at], at


class Normaliser:
    """The model's own normalisation, by longest prefix in its compiled character map, with a source offset for each byte."""

    def __init__(self, model: bytes):
        parts = list(_fields(model))
        spec = dict(_fields(next((v for k, v in parts if k == 3), b"")))
        trainer = dict(_fields(next((v for k, v in parts if k == 2), b"")))
        pieces = [dict(_fields(v)) for k, v in parts if k == 1]
        self.dummy_prefix, self.squeeze, self.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
        self.suffix = bool(trainer.get(24, 0))
        self.defined = sorted((p[1] for p in pieces if p.get(3, 1) == 4), key=len, reverse=True)
        chars = spec.get(2, b"")
        size = struct.unpack_from("<I", chars)[0] if chars else 0
        self.trie = np.frombuffer(chars, "<u4", size // 4, 4).tolist() if size else []
        self.strings = chars[4 + size :]

    def _mapped(self, text: bytes, at: int) -> tuple[int, int] | None:
        """Length of the longest prefix that the character map has at ``at``, and where its replacement begins."""
        units, node, found = self.trie, 0, None
        if not units:
            return None
        node ^= self._offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _next(self, text: bytes, at: int) -> tuple[bytes, int]:
        for piece in self.defined:
            if text.startswith(piece, at):
                return piece, len(piece)
        if found := self._mapped(text, at):
            return self.strings[found[1] : self.strings.index(b"\0", found[1])], found[0]
        first = text[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return text[at : at + size], size

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end where its source begins."""
        if not text:
            return b"", np.zeros(1, np.int32)
        if not self.trie and not self.squeeze and not self.defined and not self.suffix and self.escape:
            return self._spaces_only(text)
        space, out, source, at = SPACE if self.escape else b" ", [], [], 0
        if self.squeeze:
            while at < len(text):
                piece, size = self._next(text, at)
                if piece != b" ":
                    break
                at += size
            if at == len(text):
                return b"", np.zeros(1, np.int32)
        add = lambda piece: (out.append(piece), source.extend([at] * len(piece)))
        if self.dummy_prefix and not self.suffix:
            add(space)
        blank = self.squeeze
        while at < len(text):
            piece, size = self._next(text, at)
            while blank and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                add(piece.replace(b" ", space))
                blank = self.squeeze and piece.endswith(b" ")
            at += size
        whole = b"".join(out)
        if self.squeeze:
            while whole.endswith(space):
                at = source[len(whole) - len(space)]
                whole = whole[: -len(space)]
                del source[len(whole) :]
        if self.dummy_prefix and self.suffix:
            whole += space
            source.extend([at] * len(space))
        return whole, np.array([*source, at], np.int32)

    def _spaces_only(self, text: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(text, np.uint8)
        source = np.repeat(np.arange(len(raw) + 1, dtype=np.int32), np.append(np.where(raw == 0x20, len(SPACE), 1), 1))
        whole = text.replace(b" ", SPACE)
        return (SPACE + whole, np.concatenate([np.zeros(len(SPACE), np.int32), source])) if self.dummy_prefix else (whole, source)


def without_normaliser(model: bytes) -> bytes:
    """The model with a normaliser that changes nothing, for texts that are normalised already."""
    out, at = bytearray(), 0
    for key, value, end in _entries(model):
        if key != 3:
            out += model[at:end]
        at = end
    spec = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"  # name, and no added prefix, no squeezing, no escapes of spaces
    return bytes(out) + b"\x1a" + bytes([len(spec)]) + spec


class PieceEncoder:
    """Our normalised text, segmented by the library, each piece with its span in the source."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        self.library, self.normaliser = sentencepiece.SentencePieceProcessor(model_proto=without_normaliser(model)), Normaliser(model)
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        self.sizes = np.array([1 if self.library.is_byte(i) else 0 if self.library.is_control(i) else len(self.library.id_to_piece(i).encode()) for i in range(n)], np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, begins and ends of each text, in bytes of its UTF-8."""
        made = [self.normaliser(t.encode()) for t in texts]
        found = self.library.encode([whole.decode("utf-8", "replace") for whole, _ in made], num_threads=1)
        return [(np.array(ids, np.int32), *self._spans(whole, source, np.array(ids, np.int64))) for (whole, source), ids in zip(made, found, strict=True)]

    def _spans(self, whole: bytes, source: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[ids]
        if (unknown := self.library.unk_id()) >= 0 and (ids == unknown).any():
            sizes = np.array([len(p.encode()) for p in self.library.encode(whole.decode("utf-8", "replace"), out_type=str)], np.int64)
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] != len(whole):
            raise ValueError(f"pieces cover {ends[-1]} bytes of a normalised text of {len(whole)}")
        return source[ends - sizes], source[ends]


@lru_cache(maxsize=4)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """Columns doc_id, ids, begins, ends and decoded, one row per row of ``docs`` (doc_id, text; others are ignored).

    ``begins`` and ``ends`` are byte offsets in the UTF-8 text that the piece stems from; what a piece adds of its own, as
    the space that may stand before a text, has an empty span. ``decoded`` is what the library makes of ``ids``. Null
    counts as empty and has no ids; long texts are encoded whole; repeated rows alike; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = pc.fill_null(batch.column(1), "").to_pylist()
                made = encoder.encode(texts)
                decoded = encoder.decoder.decode([ids.tolist() for ids, _, _ in made], num_threads=1)
                starts = pa.array(np.cumsum([0, *(len(ids) for ids, _, _ in made)]), pa.int32())
                lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate(x), pa.int32())) for x in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "begins", "ends", "decoded"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {ENCODED}")
