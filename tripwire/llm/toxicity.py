"""Toxicity by class-conditional Kneser-Ney models.

Each class, toxic and ordinary, has a Kneser-Ney model of the bytes of its documents (lower-cased, white space as
spaces), of n-grams of ORDER bytes and all shorter ones. A class counts how often each n-gram of ORDER bytes occurs;
these counts are discounted, and the mass that this frees goes to the next shorter order. There an n-gram counts in how
many contexts it has been seen: the distinct bytes before it. So it goes on down to single bytes, and these back off to
equal shares. A context that a class has not seen gives what the shorter one gives. ORDER - 1 zero bytes stand before
each document, so that every byte of a text is predicted once. The log-likelihood ratio of the two models per byte is
``ngram_llr``.

Beside it stand models of single words (a document counts a word once): a class's discounted counts, and for the mass
that this frees the share that both have in common, in how many of all documents, labelled or not, a word occurs. A
word that neither class has seen gets that same share from both. They give four more numbers by the length of the text:
the ratio per word (``llr``) and the ratio of the words beyond each of WORD_LLR; and the largest ratio. All numbers
are calibrated on rows that the models have not seen.

N-grams are counted by their bytes and words by a 64-bit hash, in tables that grow with the corpus; none is cut, hashed
to a fixed size or brought to the driver (but for the counts of byte pairs, 65,536 at most). Documents are read once,
in chunks of CHUNK_BYTES of text. A chunk is written as its distinct words and n-grams, with the number of its
documents that hold each word and that each class has, and how often each class has each n-gram, and as its compressed
texts. The word lists meet in buckets of the hash, the n-gram lists in buckets of the two bytes before the last one,
which hold all that an n-gram's orders of three bytes and more are counted from. What comes of it goes back to the
chunks. Labels reach the documents as two bitmaps for each 32,768 ids, a table small enough to be sent to all tasks
until there are some hundred million ids (Spark goes by its size; beyond, it joins by shuffle).

Defined results: a null or empty text has ratios 0 and gets a score like any other. Rows with a null or unknown label
add to the shared counts only; an id with both labels counts for both, an id labelled twice alike counts once, and every
row of a labelled id counts. Without labelled rows of both classes every score is 0.5. Repeated rows are scored alike.
doc_id is an integer. Columns other than doc_id and text are ignored. A text longer than a chunk is a chunk by itself.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm import _text
from tripwire.llm._tables import partitions, stored, stored_by

ORDER = 5  # bytes of the longest n-grams
GRAM_DISCOUNT = 0.75
DISCOUNT = 0.9
CALIBRATION_ROWS = 20_000
WORD_LLR = (1.5, 3.0, 5.0)  # words whose ratio passes these are compared by themselves too
CHUNK_BYTES = 1 << 24
BUCKET_BYTES = 1 << 26  # of lists that are added up together
_WIDTH = len(WORD_LLR) + 3
_OUTSIDE = _text.separators("alnum")
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
_CHUNK = "chunk long, ids binary, absent binary, sizes binary, texts binary, words binary, counts binary, grams binary, gram_counts binary, held long, total1 long, total2 long"
_ANSWER = "chunk long, bucket long, counts binary, distinct1 long, distinct2 long"


# ---------------------------------------------------------------- packing

def _pack(array: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, compressed: their upper bytes are mostly zero."""
    return zlib.compress(np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T.tobytes(), 1)


def _unpack(blob: bytes, kind: type) -> np.ndarray:
    data, size = np.frombuffer(zlib.decompress(blob), np.uint8), np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(size, len(data) // size).T).view(kind).ravel()


def _pack_sorted(array: np.ndarray) -> bytes:
    return _pack(np.diff(array, prepend=np.zeros(1, array.dtype)))


def _unpack_sorted(blob: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_unpack(blob, kind), dtype=kind)


def _zstd() -> pa.Codec:
    return pa.Codec("zstd", compression_level=9)


# ---------------------------------------------------------------- n-grams

def _gram_keys(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte of a slice of lower-cased text, as a number: the bytes before, the nearest one
    uppermost, and the byte itself. Zeros stand before a document."""
    padded = np.zeros(len(text) + 8, np.uint8)
    padded[ORDER - 1 : ORDER - 1 + len(text)] = text
    keys = np.ndarray(len(text), "<u8", padded.data, strides=(1,)).copy()  # the ORDER bytes up to each, the last uppermost, and others
    for k in range(ORDER - 1):
        here = starts[:-1][np.diff(starts) > k] + k
        keys[here] &= ~_U((1 << 8 * (ORDER - 1 - k)) - 1)
    return (keys & _U((1 << 8 * (ORDER - 1)) - 1)) << _U(8) | text


def _shorter(keys: np.ndarray) -> np.ndarray:
    """N-grams without their first byte."""
    return keys >> _U(16) << _U(8) | keys & _U(255)


def _totals(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    distinct, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate([np.zeros(0), *counts]), len(distinct)).astype(np.int64)


def kneser_ney(keys: np.ndarray, counts: np.ndarray, order: int, shortest: int, below) -> np.ndarray:
    """The probability of each n-gram's last byte after those before it. ``keys`` are sorted and distinct, of ``order``
    bytes, with a class's counts (0: an n-gram of others); ``below`` gives the probabilities of the order under
    ``shortest`` for the n-grams of that."""
    levels = [(keys, counts, None)]
    for _ in range(order - shortest):
        shorter, at = np.unique(_shorter(levels[-1][0]), return_inverse=True)
        levels.append((shorter, np.bincount(at, levels[-1][1] > 0, len(shorter)), at))
    p = below(levels[-1][0])
    while levels:
        keys, counts, at = levels.pop()
        context = keys >> _U(8)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        each = np.diff(np.append(first, len(keys)))
        total, kinds = (np.repeat(np.add.reduceat(c, first), each) if len(keys) else np.zeros(0) for c in (counts, (counts > 0).astype(np.int64)))
        p = np.where(total > 0, (np.maximum(counts - GRAM_DISCOUNT, 0.0) + GRAM_DISCOUNT * kinds * p) / np.maximum(total, 1), p)
        p = p if at is None else p[at]
    return p


# ---------------------------------------------------------------- chunks

class _Chunk:
    """Documents that wait to be written together."""

    def __init__(self) -> None:
        self.ids, self.kinds, self.docs, self.hashes, self.texts, self.sizes, self.n, self.size = [], [], [], [], [], [], 0, 0
        self.grams, self.seen = [], ([], [])

    def add(self, ids: pa.Array, kinds: np.ndarray, text: np.ndarray, starts: np.ndarray) -> None:
        words = _text.find_words(text, starts, _OUTSIDE)
        self.ids.append(ids)
        self.kinds.append(kinds)
        self.docs.append(words.doc + self.n)
        self.hashes.append(words.hashes(lower=True))
        self.texts.append(text)
        self.sizes.append(np.diff(starts))
        keys = _gram_keys(text, starts)
        self.grams.append(np.unique(keys))
        of = np.repeat(kinds, np.diff(starts))
        for k in (1, 2):
            self.seen[k - 1].append(np.unique(keys[of & k > 0], return_counts=True))
        self.n += len(ids)
        self.size += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        vocabulary, place = np.unique(np.concatenate(self.hashes), return_inverse=True)
        size = max(1, len(vocabulary))
        pair = np.unique(np.concatenate(self.docs) * np.int64(size) + place)
        doc, word = pair // size, pair % size
        kinds = np.concatenate(self.kinds)[doc]
        counts = [np.bincount(word, minlength=len(vocabulary))] + [np.bincount(word[kinds & k > 0], minlength=len(vocabulary)) for k in (1, 2)]
        grams = np.unique(np.concatenate(self.grams))
        gram_counts = np.zeros((2, len(grams)), np.uint32)
        for k in (0, 1):
            keys, times = _totals([x[0] for x in self.seen[k]], [x[1] for x in self.seen[k]])
            gram_counts[k, np.searchsorted(grams, keys)] = times
        blobs = [
            _pack(np.asarray(ids.fill_null(0)).astype(np.int64)), _pack(np.asarray(ids.is_null()).astype(np.uint8)),
            _pack(np.concatenate(self.sizes).astype(np.int64)), _zstd().compress(np.concatenate(self.texts).tobytes(), asbytes=True),
            _pack_sorted(vocabulary), _pack(np.concatenate(counts).astype(np.uint32)), _pack_sorted(grams), _pack(gram_counts.ravel()),
        ]
        values = [number, *blobs, *(int(c.sum()) for c in counts)]
        kinds = [pa.int64(), *[pa.binary()] * 8, *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in _CHUNK.split(", ")])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, chunk = TaskContext.get().partitionId() << 32, _Chunk()
    for batch in batches:
        kinds = batch.column(2).to_numpy(zero_copy_only=False)
        for lo, hi, data, starts in _text.slices(batch.column(1)):
            if chunk.n and chunk.size + len(data) > CHUNK_BYTES:
                yield chunk.row(number)
                number, chunk = number + 1, _Chunk()
            chunk.add(batch.column(0).slice(lo, hi - lo), kinds[lo:hi], _LOWER[data], starts)
    if chunk.n:
        yield chunk.row(number)


# ---------------------------------------------------------------- counts of all chunks

def _bucket_edges(words: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in a sorted list of hashes: buckets are equal ranges of the upper 32 bits."""
    return np.searchsorted((words >> np.uint64(32)).astype(np.int64) * buckets >> 32, np.arange(buckets + 1))


def _lists(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = _unpack_sorted(row["words"], np.uint64), _unpack(row["counts"], np.uint32).reshape(3, -1)
                edges = _bucket_edges(words, buckets)
                out = [(b, row["chunk"], _pack_sorted(words[lo:hi]), _pack(counts[:, lo:hi].ravel())) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if hi > lo]
                if out:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "words", "counts"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sums of a bucket's lists, for each chunk in the order of its own list."""
    rows = table.to_pylist()
    lists = [_unpack_sorted(r["words"], np.uint64) for r in rows]
    words = np.unique(np.concatenate(lists))
    sums = np.zeros((3, len(words)), np.int64)
    for r, own in zip(rows, lists, strict=True):
        sums[:, np.searchsorted(words, own)] += _unpack(r["counts"], np.uint32).reshape(3, -1)
    distinct = [int(np.count_nonzero(sums[k])) for k in (1, 2)]
    out = [(r["chunk"], r["bucket"], _pack(sums[:, np.searchsorted(words, own)].ravel()), *((distinct if i == 0 else (0, 0)))) for i, (r, own) in enumerate(zip(rows, lists, strict=True))]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _ANSWER.split(", ")])


def _gram_order(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of sorted n-grams by bucket, and where each bucket begins: all n-grams with the same two bytes before
    the last one share a bucket."""
    bucket = ((_text.mix(grams >> _U(8 * (ORDER - 2))) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _gram_lists(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = _unpack_sorted(row["grams"], np.uint64)
                counts = _unpack(row["gram_counts"], np.uint32).reshape(2, -1)
                order, edges = _gram_order(grams, buckets)
                places = [(b, order[lo:hi]) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if hi > lo]
                out = [(b, row["chunk"], _pack_sorted(grams[at]), _pack(counts[:, at].ravel())) for b, at in places]
                if out:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "grams", "counts"])

    return run


def _gram_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of three bytes of each chunk's classes, and which classes (bits) have them."""
    for batch in batches:
        for row in batch.to_pylist():
            seen = _unpack(row["gram_counts"], np.uint32).reshape(2, -1) > 0
            grams, classes = _unpack_sorted(row["grams"], np.uint64), seen[0] + 2 * seen[1]
            for _ in range(ORDER - 3):
                grams = _shorter(grams)
            both = np.unique(grams[classes > 0] * _U(4) + classes[classes > 0].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both >> 2), pa.array(both & 3)], names=["triple", "classes"])


def _pair_probabilities(chunks: DataFrame) -> np.ndarray:
    """For each class, the probability of each byte (lower 8 bits of the place) after each other (upper 8 bits)."""
    triples = chunks.select("grams", "gram_counts").mapInArrow(_gram_triples, "triple long, classes long")
    triples = triples.groupBy("triple").agg(F.bit_or("classes").alias("classes"))
    pair = F.shiftright("triple", 16) * 256 + F.col("triple").bitwiseAND(255)
    rows = triples.groupBy(pair.alias("pair")).agg(*[F.count_if(F.col("classes").bitwiseAND(k) > 0).alias(f"n{k}") for k in (1, 2)]).collect()
    keys, out = np.arange(1 << 16, dtype=np.uint64), []
    for k in (1, 2):
        counts = np.zeros(1 << 16, np.int64)
        counts[[r["pair"] for r in rows]] = [r[f"n{k}"] for r in rows]
        out.append(kneser_ney(keys, counts, 2, 1, lambda x: np.full(len(x), 1 / 256)))
    return np.stack(out)


def _gram_ratios(pairs: np.ndarray):
    """log P(last byte | toxic) - log P(last byte | ordinary) of a bucket's n-grams, for each chunk in the order of its
    own list."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lists = [_unpack_sorted(r["grams"], np.uint64) for r in rows]
        counts = [_unpack(r["counts"], np.uint32).reshape(2, -1) for r in rows]
        logs = []
        for k in (0, 1):
            grams, sums = _totals(lists, [c[k] for c in counts])
            logs.append(np.log(kneser_ney(grams, sums, ORDER, 3, lambda x, k=k: pairs[k][_shorter(x).astype(np.int64)])))
        ratio = (logs[1] - logs[0]).astype(np.float32)
        out = [(r["chunk"], r["bucket"], _pack(ratio[np.searchsorted(grams, own)])) for r, own in zip(rows, lists, strict=True)]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["chunk", "bucket", "counts"])

    return run


# ---------------------------------------------------------------- scores

def ratios(sums: np.ndarray, held: float, total: tuple, distinct: tuple) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of the models of single words (those of n-grams: ``kneser_ney``);
    ``sums`` are the word's documents: all, ordinary, toxic."""
    shared = sums[0] / max(held, 1.0)
    logs = []
    for k in (0, 1):
        spare = DISCOUNT * distinct[k] + 1.0
        logs.append(np.log((np.maximum(sums[k + 1] - DISCOUNT, 0.0) + spare * shared) / (total[k] + 1.0)))
    return logs[1] - logs[0]


def _features(words: _text.Words, own: np.ndarray, of_bytes: np.ndarray) -> np.ndarray:
    """For each document: its words' ratio per word, the excess over each of WORD_LLR by length, the largest ratio, and
    the n-grams' ratio per byte. ``own`` are the ratios of the words, ``of_bytes`` of the bytes."""
    n, doc = len(words.doc_start) - 1, words.doc
    length, size = np.maximum(np.diff(words.first), 1.0), np.diff(words.doc_start)
    columns = [np.bincount(doc, own, n) / length * 10.0]
    columns += [np.log1p(1000.0 * np.bincount(doc, np.maximum(own - level, 0.0), n) / length) for level in WORD_LLR]
    largest = np.zeros(n)
    np.maximum.at(largest, doc, own)
    by_bytes = np.bincount(np.repeat(np.arange(n), size), of_bytes, n) / np.maximum(size, 1)
    return np.stack([*columns, np.minimum(largest, 30.0) / 10.0, by_bytes * 100.0], axis=1)


def _compare(held: float, total: tuple, distinct: tuple, buckets: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        ids, absent, out = [], [], [np.zeros((0, _WIDTH))]
        for row in chunk.to_pylist():
            parts = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
            sums = np.concatenate([np.zeros((3, 0), np.int64), *(_unpack(r["counts"], np.int64).reshape(3, -1) for r in parts if not r["grams"])], axis=1)
            ratio = ratios(sums, held, total, distinct)
            grams = _unpack_sorted(row["grams"], np.uint64)
            of_gram = np.zeros(len(grams), np.float32)
            of_gram[_gram_order(grams, buckets)[0]] = np.concatenate([np.zeros(0, np.float32), *(_unpack(r["counts"], np.float32) for r in parts if r["grams"])])
            sizes = _unpack(row["sizes"], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            text = np.frombuffer(_zstd().decompress(row["texts"], decompressed_size=int(starts[-1]), asbytes=True), np.uint8)
            slices, lo = [], 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + _text.SLICE_BYTES, "right")) - 1)
                slices.append((text[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo]))
                lo = hi
            found = [_text.find_words(*of, _OUTSIDE) for of in slices]
            hashes = [words.hashes(lower=True) for words in found]
            vocabulary = np.unique(np.concatenate(hashes))
            for of, words, own in zip(slices, found, hashes, strict=True):
                out.append(_features(words, ratio[np.searchsorted(vocabulary, own)], of_gram[np.searchsorted(grams, _gram_keys(*of))]))
            ids.append(_unpack(row["ids"], np.int64))
            absent.append(_unpack(row["absent"], np.uint8).astype(bool))
        flat = np.concatenate(out)
        lists = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, _WIDTH, dtype=np.int32), pa.array(flat.ravel()))
        return pa.Table.from_arrays([pa.array(np.concatenate(ids or [np.zeros(0, np.int64)]), mask=np.concatenate(absent or [np.zeros(0, bool)])), lists], names=["doc_id", "x"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and constant of a logistic fit (Newton's method)."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
    return w


def _marks(known: DataFrame) -> DataFrame:
    """``(of, ones1, ones2)``: the labelled ids of 32,768 as a bitmap for each class."""
    places = known.groupBy(F.bitmap_bucket_number("doc_id").alias("of"))
    place = F.bitmap_bit_position("doc_id")
    return places.agg(*[F.bitmap_construct_agg(F.when(F.col("kind") == k, place)).alias(f"ones{k}") for k in (1, 2)])


def _marked(k: int) -> Column:
    place = F.bitmap_bit_position("doc_id")
    byte = F.conv(F.hex(F.substring(F.col(f"ones{k}"), (F.call_function("div", place, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(1), F.lit(0))


def score_documents(documents: DataFrame, labels: DataFrame, fit: Column, calibrate: Column, label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """``(doc_id, score, predicted, llr, ngram_llr)`` for each row of ``documents (doc_id, text)``.

    ``labels`` has doc_id and the 0/1 column ``label``. ``fit`` and
    ``calibrate`` are conditions on doc_id: the rows whose classes are counted,
    and those (at most CALIBRATION_ROWS, by hash) that calibrate the
    comparison. ``llr`` is ten times the words' log-likelihood ratio per word,
    ``ngram_llr`` a hundred times the n-grams' ratio per byte.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label) + 1).cast("int").alias("kind"))
    marks = stored(_marks(known.where(fit)), "marks")
    kinds = F.when(fit, _marked(1) + 2 * _marked(2)).otherwise(0)
    joined = texts.join(marks, F.bitmap_bucket_number("doc_id") == F.col("of"), "left").select("doc_id", "text", F.coalesce(kinds, F.lit(0)).cast("int").alias("kinds"))
    chunks = stored_by(joined.mapInArrow(_chunks, _CHUNK), "chunks", "chunk")
    size = chunks.agg(F.sum("held"), F.sum("total1"), F.sum("total2"), F.sum(F.length("words") + F.length("counts")), F.sum(F.length("grams") + F.length("gram_counts"))).first()
    if not (size[1] and size[2]):
        return texts.select("doc_id", F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"), F.lit(0.0).alias("llr"), F.lit(0.0).alias("ngram_llr"))
    buckets = max(partitions(documents.sparkSession), math.ceil(size[3] / BUCKET_BYTES))
    lists = chunks.select("chunk", "words", "counts").mapInArrow(_lists(buckets), "bucket long, chunk long, words binary, counts binary")
    answers = stored(lists.groupBy("bucket").applyInArrow(_added, _ANSWER), "answers")
    distinct = answers.agg(F.sum("distinct1"), F.sum("distinct2")).first()
    gram_buckets = max(partitions(documents.sparkSession), math.ceil(size[4] / BUCKET_BYTES))
    gram_lists = chunks.select("chunk", "grams", "gram_counts").mapInArrow(_gram_lists(gram_buckets), "bucket long, chunk long, grams binary, counts binary")
    gram_answers = gram_lists.groupBy("bucket").applyInArrow(_gram_ratios(_pair_probabilities(chunks)), "chunk long, bucket long, counts binary")
    both = answers.select("chunk", "bucket", "counts", F.lit(False).alias("grams")).union(gram_answers.select("chunk", "bucket", "counts", F.lit(True)))
    texts = chunks.select("chunk", "ids", "absent", "sizes", "texts", "grams").groupBy("chunk")
    scored = texts.cogroup(both.groupBy("chunk")).applyInArrow(_compare(float(size[0]), (size[1], size[2]), tuple(distinct), gram_buckets), "doc_id long, x array<double>")
    compared = stored(scored, "compared")
    sample = compared.join(known.where(calibrate), "doc_id").orderBy(F.xxhash64("doc_id"), "kind").limit(CALIBRATION_ROWS).select("x", "kind").collect()
    w = logistic(np.array([r["x"] for r in sample]).reshape(-1, _WIDTH), np.array([float(r["kind"] == 2) for r in sample]))
    odds = F.lit(float(w[-1]))
    for i in range(_WIDTH):
        odds = odds + F.lit(float(w[i])) * F.get("x", F.lit(i))
    score = 1.0 / (1.0 + F.exp(-odds))
    return compared.select("doc_id", score.alias("score"), (score >= threshold).cast("int").alias("predicted"), F.get("x", F.lit(0)).alias("llr"), F.get("x", F.lit(_WIDTH - 1)).alias("ngram_llr"))
