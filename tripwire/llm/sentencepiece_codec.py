"""SentencePiece encoding with source offsets, and decoding.

A text is normalised by the model's compiled character map (at each place the
longest prefix that the map's double-array trie holds is replaced), with the
source byte of every normalised byte recorded. Pieces cover the normalised
bytes from left to right, so each piece's span in the source follows from its
length and that alignment.

Where the model allows it (BPE whose pieces hold white space only in front),
merges never cross the start of a word, and each distinct word is
segmented once a worker and looked up afterwards. Other models segment each
whole text. Both give the library's ids.

Defined results: a null or empty text has no ids and decodes to an empty text.
Rows are independent, so repeated rows and ids give repeated results; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CACHED_WORDS = 400_000  # the table of segmented words is emptied at this size
_MARK = "▁"  # the model's visible white space
_CHUNKS = re.compile(f"[ {_MARK}]*[^ {_MARK}]+|[ {_MARK}]+")


class CharMap:
    """A compiled character map: 4 bytes of trie size, the trie's 32-bit units, then replacements ended by zero bytes."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """``(length, replacement)`` of the longest key that ``data`` holds at ``at``."""
        if not self.units:
            return None
        found, node = None, self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Codec:
    """One model, in one worker."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rule = proto.normalizer_spec
        self.map = CharMap(rule.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = rule.add_dummy_prefix, rule.remove_extra_whitespaces, rule.escape_whitespaces
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.kinds = [p.type for p in proto.pieces]
        self.surface = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(_MARK, " ").encode() for p in proto.pieces]
        self.width = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.plain_width = np.array([len(x) for x in self.surface], np.int64)
        self.unknown = proto.trainer_spec.unk_surface.encode()
        self.by_word = (
            proto.trainer_spec.model_type == 2 and proto.trainer_spec.byte_fallback and not self.map.units and self.prefix and self.escape
            and not self.squeeze and not proto.trainer_spec.treat_whitespace_as_suffix
            and proto.pieces[self.processor.piece_to_id(_MARK)].piece == _MARK and not any(p.type == 4 or re.search(f"[^{_MARK}]{_MARK}", p.piece) for p in proto.pieces)
        )
        self.words: dict[str, tuple[str, bytes, bytes] | bytes] = {}
        self.only_ids = False  # the table has nothing but the ids of each word

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and the source byte of each (and the source's length at the end)."""
        source = text.encode()
        if not self.map.units and not self.squeeze:
            raw = np.frombuffer(source, np.uint8)
            space = (raw == 32) & self.escape
            align = np.repeat(np.arange(len(raw) + 1), np.append(np.where(space, 3, 1), 1))
            out = text.replace(" ", _MARK).encode() if self.escape else source
            if self.prefix and source:
                mark = _MARK.encode() if self.escape else b" "
                out, align = mark + out, np.concatenate([np.zeros(len(mark), np.int64), align])
            return out, align
        parts, align, at = [], [], 0
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit is None:
                n = 1 if source[at] < 0x80 else 2 if source[at] < 0xE0 else 3 if source[at] < 0xF0 else 4
                hit = n, source[at : at + n]
            parts.append(hit[1])
            align += [at] * len(hit[1])
            at += hit[0]
        data, align = b"".join(parts), [*align, at]
        if self.squeeze:
            lead, tail = len(data) - len(data.lstrip(b" ")), len(data.rstrip(b" "))
            keep = [i for i in range(lead, tail) if data[i] != 32 or data[i - 1] != 32]
            align = [align[i] for i in keep] + [align[max(lead, tail)] if keep else at]
            data = bytes(data[i] for i in keep)
        if self.prefix and data:
            data, align = b" " + data, [align[0], *align]
        if self.escape:
            align = [a for a, b in zip(align, data, strict=False) for _ in range(3 if b == 32 else 1)] + align[-1:]
            data = data.replace(b" ", _MARK.encode())
        return data, np.array(align, np.int64)

    def _learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.words]
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words.clear()
            new = list(chunks)
        # a chunk is what follows the prefix that the processor puts in front
        for chunk, ids in zip(new, self.processor.encode(new, num_threads=1), strict=True):
            ids = ids if chunk else [self.processor.piece_to_id(_MARK)]
            packed = np.array(ids, np.int32).tobytes()
            self.words[chunk] = packed if self.only_ids else (",".join(map(str, ids)), packed, b"".join([self.surface[i] for i in ids]))

    def _words(self, text: str, only_ids: bool) -> list:
        """What the table has of each word of a text."""
        if self.only_ids != only_ids:
            self.words.clear()
            self.only_ids = only_ids
        chunks = text.split(" ") if text else []
        if "" in chunks or _MARK in text:
            # the first white space of a chunk is the prefix that the processor adds again
            chunks = [c[1:] for c in _CHUNKS.findall(_MARK + text)] if text else []
        try:
            return [self.words[c] for c in chunks]
        except KeyError:
            self._learn(set(chunks))
            return [self.words[c] for c in chunks]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.by_word:
            return [np.array(self.processor.encode(t) if t else [], np.int32) for t in texts]
        return [np.frombuffer(b"".join(self._words(t, True)), np.int32) for t in texts]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, bytes | None]]:
        """For each text its ids, these joined by commas, and their decoded bytes where known already."""
        if not self.by_word:
            for text in texts:
                ids = self.processor.encode(text) if text else []
                yield np.array(ids, np.int32), ",".join(map(str, ids)), None
            return
        for text in texts:
            parts = self._words(text, False)
            yield np.frombuffer(b"".join([p[1] for p in parts]), np.int32), ",".join([p[0] for p in parts]), b"".join([p[2] for p in parts])[1:]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last source byte of each piece."""
        if self.by_word and _MARK not in text:  # white space is all that changes: one byte in the source, three in the piece
            ends = np.cumsum(self.plain_width[ids]) - 1
            if len(ids) and ends[-1] != len(text.encode()):
                raise ValueError("pieces don't cover the text")
            return np.concatenate([[0], ends[:-1]])[: len(ids)], ends
        normal, align = self.normalise(text)
        width = self.width[ids]
        if 2 in map(self.kinds.__getitem__, set(ids.tolist())):  # an unknown piece is as wide as what it stands for
            pieces = self.processor.encode(text, out_type=str)
            width = np.array([1 if self.kinds[i] == 6 else len(p.encode()) for i, p in zip(ids.tolist(), pieces, strict=True)], np.int64)
        ends = np.cumsum(width)
        if len(ids) and ends[-1] != len(normal):
            raise ValueError(f"pieces cover {ends[-1]} of {len(normal)} normalised bytes")
        return align[ends - width], align[ends]

    def decode(self, ids) -> str:
        """The text of any ids: control pieces are left out, a byte that is no part of a character becomes U+FFFD."""
        out, run, blank = [], bytearray(), bool(self.prefix)
        ids = [int(i) for i in ids]

        def flush() -> None:
            at = 0
            while at < len(run):
                n = 1 if run[at] < 0x80 else 2 if 0xC2 <= run[at] < 0xE0 else 3 if 0xE0 <= run[at] < 0xF0 else 4 if 0xF0 <= run[at] < 0xF5 else 0
                try:
                    out.append(bytes(run[at : at + n]).decode() if n else "�")
                    at += n or 1
                except UnicodeDecodeError:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            kind = self.kinds[i]
            if kind == 6:
                run += self.surface[i]
                blank = False
                continue
            flush()
            if kind == 3:
                continue
            piece = self.unknown if kind == 2 else self.surface[i]
            if blank and kind != 2 and piece.startswith(b" "):
                piece = piece[1:]
            blank = False
            out.append(piece.decode())
        flush()
        return "".join(out)


def _model(path: str) -> bytes:
    """The model file, read by the driver and sent with the tasks (a vocabulary: its size doesn't follow the data)."""
    with open(path, "rb") as f:
        return f.read()


_CODECS: dict[bytes, Codec] = {}


def _codec(model: bytes) -> Codec:
    key = hashlib.sha256(model).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


@contextlib.contextmanager
def _opened(model: bytes) -> Iterator[Codec]:
    """The codec for one task. Its table of words is emptied after that: Spark keeps the worker for other tasks and
    stages, which would run beside it."""
    codec = _codec(model)
    try:
        yield codec
    finally:
        codec.words.clear()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 128):
            yield batch.column(0).slice(lo, 128).to_pylist(), [t or "" for t in batch.column(1).slice(lo, 128).to_pylist()]


def encode(documents: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, ids, starts, ends)``: the ids of each text and the source bytes that each piece stands for."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _opened(model) as codec:
            for doc_ids, texts in _runs(batches):
                ids = codec.ids(texts)
                spans = [codec.spans(t, i) for t, i in zip(texts, ids, strict=True)]
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(ids, kind), pa.array([s[0].astype(np.int32) for s in spans], kind), pa.array([s[1].astype(np.int32) for s in spans], kind)],
                    names=["doc_id", "ids", "starts", "ends"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, text)`` of ``encoded (doc_id, ids)``; null ids give an empty text."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(documents: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, tiled)``: encode and decode without moving the
    arrays out of the task. ``tiled``: the pieces' spans follow each other from the first source byte to the last."""
    model = _model(model_path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "tiled"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _opened(model) as codec:
            for doc_ids, texts in _runs(batches):
                rows = []
                for d, text, (ids, joined, decoded) in zip(doc_ids, texts, codec.encode(texts), strict=True):
                    starts, ends = codec.spans(text, ids)
                    size = len(text.encode())
                    tiled = bool((starts[1:] == ends[:-1]).all() and (not len(ids) or starts[0] == 0 and ends[-1] == size))
                    decoded = codec.decode(ids).encode() if decoded is None else decoded
                    rows.append((d, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(), size, tiled))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, tiled boolean")
