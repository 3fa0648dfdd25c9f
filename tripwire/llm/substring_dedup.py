"""Removal of repeated passages: fixed-block anchors, rolling probes, maximal repeats.

Every document is cut into non-overlapping blocks of ``window // 2`` words,
which are the index; every rolling window of that many words is a probe. A
passage of ``window`` words holds at least one whole block wherever it starts,
so of two places with the same passage each holds a probe that hits a block of
the other. Hits are extended: around each, the hashes of all ``window``-word
windows that hold it are compared by value, and each window value keeps its
first place (smallest doc_id, then start). The runs of later places are the
maximal repeats, which are cut.

Four exchanges carry this: probes by value, hits back to the texts, windows of
the hit regions by value, and repeats back to those texts, which take no part in
the third: the windows and the texts of a hit are told apart from one exchange. Probes and windows
travel packed and compressed, a few rows for each task and bucket; values
that a task sees several times are settled there and sent once, so a passage
that a third of all documents hold costs each task one entry. A bucket is read
on its own, and its size doesn't grow with the input as long as the number of
shuffle partitions does.

Defined results: null, empty and wordless texts have no words and lose none.
Rows that share a doc_id count as one place each: a window is removed only if
an equal one starts under a smaller doc_id, or under the same one at an earlier
word. Rows without doc_id come after all others, as if of one id. Other columns
are ignored by ``repeats`` and kept by ``cut_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm import _text
from tripwire.llm._tables import partitions, stored

WINDOW = 20
HELD = 1 << 21  # probes that a task packs at a time
NO_ID = (1 << 63) - 1
_U = np.uint64
ROW = "key int, kind int, doc_id long, rk long, n_words long, n_removed long, kept_sha256 string, body binary"
_NAMES = ["key", "kind", "doc_id", "rk", "n_words", "n_removed", "kept_sha256", "body"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
PACKED, TEXT, DONE, LATER = 0, 1, 2, 3


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length; all but the last as differences, which are small in sorted columns."""
    steps = [np.diff(c, prepend=c.dtype.type(0)) for c in columns[:-1]]
    return zstandard.ZstdCompressor(level=1).compress(np.int64(len(columns[0])).tobytes() + b"".join(c.tobytes() for c in (*steps, columns[-1])))


def _unpack(body: bytes, *types: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return [*(np.cumsum(c, dtype=c.dtype) for c in out[:-1]), out[-1]]


def _by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(bucket)], strict=True):
        yield int(bucket[lo]), [c[order[lo:hi]] for c in columns]


def _packed(bucket: np.ndarray, *columns: np.ndarray, kind: int = PACKED) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for b, part in _by_bucket(bucket, *columns):
        rows.append((b, kind, None, None, None, None, None, _pack(*part)))
        size += len(rows[-1][-1])
        if size > 1 << 22:
            yield _rows(rows)
            rows, size = [], 0
    if rows:
        yield _rows(rows)


def _short(rk: np.ndarray) -> np.ndarray:
    """32 bits of a row key: enough to address a hit, since a hit is looked up by value in the text it reaches."""
    return rk.astype(np.uint64).astype(np.uint32)


def _probes(values: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a probe and 32 more of its bits, in one number."""
    return ((values >> _U(32)) % _U(buckets)) << _U(32) | (values & _U(0xFFFFFFFF))


def _windows(words: _text.Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes = words.hashes()
    places, values = _text.doc_grams(words, hashes, block)
    return hashes, places, values


def _probe(window: int, buckets: int):
    """Texts -> probes by bucket. Flags: 1 it is a block, 2 the document has it more than once."""

    def send(held: list) -> Iterator[pa.RecordBatch]:
        key, rk, flag = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((rk, key))
        key, rk, flag = key[order], rk[order], flag[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        seen = np.bincount(group)
        block = np.bincount(group, flag).astype(bool)
        settled = (seen > 1) & block
        # of a value that this task has settled one entry goes on, for the others; its own texts are told now
        told = settled[group]
        yield from _packed((rk[told] % np.uint32(buckets)).astype(np.int64), rk[told], key[told], kind=TEXT)
        send = ~told | new
        key, rk, flag, told = key[send], rk[send], flag[send] | settled[group[send]], told[send]
        state = (flag.astype(np.uint8) | (told.astype(np.uint8) << 1)).astype(np.uint8)
        order = np.argsort(rk, kind="stable")
        yield from _packed((key >> _U(32)).astype(np.int64)[order], rk[order], state[order], key.astype(np.uint32)[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            rks = _short(batch.column(1).to_numpy(zero_copy_only=False))
            for lo, hi, data, starts in _text.slices(batch.column(2)):
                words = _text.find_words(data, starts, _text.separators("space"))
                _, places, values = _windows(words, window // 2)
                doc = words.doc[places]
                held.append((_probes(values, buckets), rks[lo:hi][doc], (places - words.first[doc]) % (window // 2) == 0))
                n += len(places)
                if n >= HELD:
                    yield from send(held)
                    held, n = [], 0
        if n:
            yield from send(held)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows sorted by key, then kind, as ``(key, rows)``; a key's rows must be used up before the next is asked for."""
    rows = ((k, r) for batch in batches for k, r in zip(batch.column(0).to_pylist(), zip(*(c.to_pylist() for c in batch.columns), strict=True), strict=True))
    ahead = next(rows, None)

    def of(key: int) -> Iterator[tuple]:
        nonlocal ahead
        while ahead is not None and ahead[0] == key:
            row = ahead[1]
            ahead = next(rows, None)
            yield row

    while ahead is not None:
        yield ahead[0], of(ahead[0])


def _match(buckets: int):
    """Probes of a bucket -> hits by the texts' bucket: values that some block has and that have another place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            parts = []
            for row in rows:
                if row[1] == PACKED:
                    parts.append(_unpack(row[-1], np.uint32, np.uint8, np.uint32))
                else:
                    yield _rows([(row[0], PACKED, *row[2:])])
            if not parts:
                continue
            rk, state, value = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(value, kind="stable")
            rk, value, state = rk[order], value[order], state[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            group = np.cumsum(new) - 1
            hit = ((np.bincount(group) > 1) & (np.bincount(group, state & 1) > 0))[group] & (state & 2 == 0)
            rk, key = rk[hit], value[hit].astype(np.uint64) | (_U(bucket) << _U(32))
            order = np.argsort(rk, kind="stable")
            yield from _packed((rk[order] % np.uint32(buckets)).astype(np.int64), rk[order], key[order])

    return run


def _finished(key: int, doc_id, rk, raw: bytes) -> tuple:
    words = raw.split()
    return (key, DONE, doc_id, rk, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), None)


def _settled(bucket: np.ndarray, value: np.ndarray, doc: np.ndarray, start: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of each value, the task's first place, for the others to compare; its other places are later whatever these
    have, and go on to their documents' buckets."""
    order = np.lexsort((start, doc, value, bucket))
    bucket, value, doc, start = bucket[order], value[order], doc[order], start[order]
    head = np.ones(len(value), bool)
    head[1:] = (value[1:] != value[:-1]) | (bucket[1:] != bucket[:-1])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = (doc != doc[lead]) | (start != start[lead])  # the same place again, of a repeated row, is the first one
    at = np.flatnonzero(head)[np.lexsort((start[head], doc[head]))]
    yield from _packed(bucket[at], doc[at], start[at], value[at])
    at = np.flatnonzero(later)[np.lexsort((start[later], doc[later]))]
    yield from _packed(_doc_bucket(doc[at], buckets), doc[at], start[at], value[at].astype(np.uint32), kind=LATER)


def _extend(window: int, buckets: int, texts: bool):
    """Texts with their hits -> all windows that hold a hit, by value; with ``texts`` instead those texts, by the document's
    bucket, and the other texts finished."""

    def send(held: list) -> Iterator[pa.RecordBatch]:
        yield from _settled(*(np.concatenate(c) for c in zip(*held, strict=True)), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, rows in _groups(batches):
            parts, hits, out, size = [], None, [], 0
            for row in rows:
                if row[1] == PACKED:
                    parts.append(_unpack(row[-1], np.uint32, np.uint64))
                    continue
                if hits is None:
                    rk32, key = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint32), np.zeros(0, np.uint64))
                    order = np.argsort(rk32, kind="stable")
                    hits, parts = (rk32[order], key[order]), []
                _, _, doc_id, rk, _, _, _, body = row
                raw = zstandard.ZstdDecompressor().decompress(body)
                short = np.uint32(rk & 0xFFFFFFFF)
                lo, hi = np.searchsorted(hits[0], short), np.searchsorted(hits[0], short, "right")
                starts = np.zeros(0, np.int64)
                if hi > lo:
                    data = np.frombuffer(raw, np.uint8)
                    words = _text.find_words(data, np.array([0, len(data)]), _text.separators("space"))
                    hashes, _, values = _windows(words, window // 2)
                    if len(hashes) >= window:
                        is_hit = np.concatenate([[0], np.cumsum(np.isin(_probes(values, buckets), hits[1][lo:hi]))])
                        starts = np.flatnonzero(is_hit[window - window // 2 + 1 :] > is_hit[: len(hashes) - window + 1])
                if texts:
                    if len(starts):
                        own = np.array([NO_ID if doc_id is None else doc_id])
                        out.append((int(_doc_bucket(own, buckets)[0]), TEXT, doc_id, rk, None, None, None, body))
                    else:
                        out.append(_finished(rk % buckets, doc_id, rk, raw))
                elif len(starts):
                    wide = _text.grams(hashes, window)[starts]
                    at = (_text.grams(_text.mix(hashes + _U(0x632BE59BD9B4E019)), window)[starts] % _U(buckets)).astype(np.int64)
                    held.append((at, wide, np.full(len(starts), NO_ID if doc_id is None else doc_id), starts.astype(np.uint32)))
                    n += len(starts)
                size += len(body)
                if size > 1 << 22:
                    yield _rows(out)
                    out, size = [], 0
                if n >= HELD:
                    yield from send(held)
                    held, n = [], 0
            yield _rows(out)
        if n:
            yield from send(held)

    return run


def _doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (_text.mix(doc.astype(np.uint64)) % _U(buckets)).astype(np.int64)


def _first(buckets: int):
    """Windows of a bucket -> those that aren't the first of their value, by the document's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            parts = []
            for row in rows:
                if row[1] == PACKED:
                    parts.append(_unpack(row[-1], np.int64, np.uint32, np.uint64))
                else:  # LATER: settled in a task already
                    yield _rows([(row[0], PACKED, *row[2:])])
            if parts:
                doc, start, value = (np.concatenate(c) for c in zip(*parts, strict=True))
                order = np.lexsort((start, doc, value))
                doc, start, value = doc[order], start[order], value[order]
                head = np.ones(len(value), bool)
                head[1:] = value[1:] != value[:-1]
                lead = np.flatnonzero(head)[np.cumsum(head) - 1]
                later = (doc != doc[lead]) | (start != start[lead])
                doc, start, value = doc[later], start[later], value[later]
                order = np.lexsort((start, doc))
                yield from _packed(_doc_bucket(doc[order], buckets), doc[order], start[order], value[order].astype(np.uint32))

    return run


def _cut(window: int):
    """Texts with their later windows -> what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            parts, later, out, size = [], None, [], 0
            for row in rows:
                if row[1] == DONE:
                    out.append(row)
                    continue
                if row[1] == PACKED:
                    parts.append(_unpack(row[-1], np.int64, np.uint32, np.uint32))
                    continue
                if later is None:
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
                    order = np.argsort(columns[0], kind="stable")
                    later, parts = [c[order] for c in columns], []
                _, _, doc_id, rk, _, _, _, body = row
                raw = zstandard.ZstdDecompressor().decompress(body)
                own = NO_ID if doc_id is None else doc_id
                lo, hi = np.searchsorted(later[0], own), np.searchsorted(later[0], own, "right")
                data = np.frombuffer(raw, np.uint8)
                words = _text.find_words(data, np.array([0, len(data)]), _text.separators("space"))
                values = _text.grams(words.hashes(), window).astype(np.uint32)
                start, value = later[1][lo:hi].astype(np.int64), later[2][lo:hi]
                fits = start < len(values)
                start, value = start[fits], value[fits]
                start = np.unique(start[values[start] == value])  # rows that share an id: each takes its own
                cover = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.subtract.at(cover, start + window, 1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = b" ".join(w for w, g in zip(raw.split(), gone.tolist(), strict=True) if not g)
                out.append((0, TEXT, doc_id, rk, len(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept if gone.any() else None))
                size += len(raw)
                if size > 1 << 22:
                    yield _rows(out)
                    out, size = [], 0
            yield _rows(out)

    return run


def _texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=7)
        for batch in batches:
            rks = batch.column(1).to_numpy(zero_copy_only=False)
            where = (_short(rks) % np.uint32(buckets)).tolist()
            for lo in range(0, len(rks), 256):
                part = zip(where[lo : lo + 256], batch.column(0)[lo : lo + 256].to_pylist(), rks[lo : lo + 256].tolist(), batch.column(2)[lo : lo + 256].to_pylist(), strict=True)
                yield _rows([(b, TEXT, d, r, None, None, None, pack.compress((t or "").encode())) for b, d, r, t in part])

    return run


def repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(rk, doc_id, n_words, n_removed, kept_sha256, kept)`` for each row of ``documents (doc_id, text)``.

    Words are runs of other than ASCII white space. A word is removed if a
    ``window``-word window covers it whose word sequence also starts earlier (a
    smaller doc_id, or the same and an earlier word); windows are judged on the
    input. ``kept`` is the remaining words, joined by one space, where words
    were removed, else null. ``rk`` is ``xxhash64(doc_id, text)``.
    """
    parts = partitions(documents.sparkSession)
    buckets = parts
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("rk"), "text")

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartitionById(parts, "key").sortWithinPartitions("key", "kind")

    hits = dealt(rows.mapInArrow(_probe(window, buckets), ROW)).mapInArrow(_match(buckets), ROW)
    met = dealt(hits.union(rows.mapInArrow(_texts(buckets), ROW)))  # one exchange, read for the windows and for the texts
    later = dealt(met.mapInArrow(_extend(window, buckets, False), ROW)).mapInArrow(_first(buckets), ROW)
    return dealt(later.union(met.mapInArrow(_extend(window, buckets, True), ROW))).mapInArrow(_cut(window), ROW).select("rk", "doc_id", "n_words", "n_removed", "kept_sha256", F.col("body").cast("string").alias("kept"))


def cut_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with the repeated words cut from ``text`` (kept words joined by one space) and ``n_chars``
    brought up to date if there is such a column; texts without repeats stay as they are."""
    # The rows of documents without cuts go straight through: a bitmap for each 32,768 ids says which they are, a table
    # that Spark sends to all tasks while it is small. Only the others are joined, by row key and id.
    cut = repeats(documents, window).where("n_removed > 0").select("rk", "doc_id", "kept").dropDuplicates(["rk", "doc_id"])
    cut = stored(cut, "cut")
    place = F.bitmap_bit_position("doc_id")
    marks = cut.where("doc_id IS NOT NULL").groupBy(F.bitmap_bucket_number("doc_id").alias("of")).agg(F.bitmap_construct_agg(place).alias("ones"))
    row = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("doc_id", "text").alias("key"))
    marked = row.join(stored(marks, "cut_marks"), F.bitmap_bucket_number("id") == F.col("of"), "left")
    at = F.bitmap_bit_position("id")
    byte = F.conv(F.hex(F.substring("ones", (F.call_function("div", at, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    touched = F.col("id").isNull() | F.coalesce(F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    marked = marked.select("row", "id", "key", touched.alias("touched"))
    same = (F.col("key") == F.col("rk")) & F.col("id").eqNullSafe(F.col("doc_id"))
    changed = marked.where("touched").join(cut, same, "left").select("row", "kept")
    rows = marked.where("NOT touched").select("row", F.lit(None).cast("string").alias("kept")).union(changed)
    new = {"text": F.coalesce("kept", "row.text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length("kept")).cast(documents.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in documents.columns])
