"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

A window of a document has as many words as the benchmark item it is held
against. Windows and items get a 64-bit SimHash of their five-word shingles. Items are indexed by the
blocks of their fingerprints: two fingerprints within RADIUS bits agree in some
block up to one bit, because the differing bits can't all avoid it, so looking
up each block and its one-bit neighbours finds every item within the radius.
What is found is verified by exact Jaccard similarity, weighted or plain,
whichever is more: a shingle weighs 1 / (number of different item texts that
hold it), and one that the item doesn't hold weighs as much as the item's do on
average, so an edit counts like the words it replaced and nothing depends on
the block that an item is in.

Every window of an item's size that can reach the threshold is fingerprinted, by
sums that roll along the document. A window can't if the shingles in it that
items of its size have, counted and weighed, are too few for any of them. The documents are read once and not
shuffled. Items go to the tasks in blocks of at most BLOCK_WORDS words; a larger
benchmark takes several passes, and no block grows with the data.

Defined results: a null, empty or wordless text or item matches nothing. An item
of fewer than five words is one shingle, matched exactly. A document shorter
than an item is one window. Equal items, and repeated rows, each give
their own result rows. Columns other than doc_id and text (item_id and text)
are ignored by ``contaminated`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm import _text
from tripwire.llm._tables import stored

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS, RADIUS = 64, 16, 31  # RADIUS < 2 * BLOCKS: some block differs in one bit or none
BLOCK_WORDS = 1 << 21
_U = np.uint64
_FILTER_BITS = 20


def _bits(shingles: np.ndarray) -> np.ndarray:
    """The shingles' hashed bits, as -1 and 1."""
    return ((_text.mix(shingles + _U(0x51ED270B))[:, None] >> np.arange(BITS, dtype=np.uint64)) & _U(1)).astype(np.int64) * 2 - 1


def _signs(sums: np.ndarray) -> list[int]:
    return ((sums > 0).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).tolist()


def fingerprint(shingles: np.ndarray) -> int:
    """SimHash: the signs of the sums of the distinct shingles' bits."""
    return _signs(_bits(shingles).sum(axis=0)[None, :])[0]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items -> their word hashes and distinct shingles."""
    for batch in batches:
        for lo, hi, data, starts in _text.slices(batch.column(1)):
            words = _text.find_words(data, starts, _text.separators("alnum"))
            hashes = words.hashes(lower=True).astype(np.int64)
            bounds, values = _text.shingle_sets(words, hashes.astype(np.uint64), SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(words.first.astype(np.int32), pa.array(hashes)),
                    pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(values.astype(np.int64))),
                ],
                names=["item_id", "words", "shingles"],
            )


class Index:
    """One block of items: fingerprints by block, and for each size of item, the shingles and what a window needs of them."""

    def __init__(self, items: list[tuple[int, np.ndarray, dict[int, float]]]):
        self.items = [(i, len(words), shingles) for i, words, shingles in items]
        self.tables: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(BLOCKS)]
        self.prints, self.at = [], {}
        self.needed: dict[int, tuple[float, float]] = {}
        for n, (_, words, shingles) in enumerate(items):
            p = fingerprint(np.array(sorted(shingles), np.uint64))
            self.prints.append(p)
            for b in range(BLOCKS):
                self.tables[b].setdefault((len(words), p >> (b * BITS // BLOCKS) & (1 << BITS // BLOCKS) - 1), []).append(n)
            size, counted, weighed = len(words), len(shingles), sum(shingles.values())
            least = self.needed.get(size, (counted, weighed))
            self.needed[size] = min(least[0], counted), min(least[1], weighed)
            for g, w in shingles.items():
                self.at.setdefault(g, {})[size] = w  # the same in every item
        self.shingles = np.sort(np.array(list(self.at), np.uint64))
        self.short = sorted({size for _, size, _ in self.items if size < SHINGLE})
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.shingles & _U((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True

    def near(self, size: int, print_: int) -> set[int]:
        """Items of this many words whose fingerprints are within RADIUS bits (or fewer than 2 * BLOCKS)."""
        found, width = set(), BITS // BLOCKS
        for b, table in enumerate(self.tables):
            part = print_ >> (b * width) & (1 << width) - 1
            for near in (part, *(part ^ 1 << k for k in range(width))):
                found.update(table.get((size, near), ()))
        return {n for n in found if (self.prints[n] ^ print_).bit_count() <= RADIUS}

    def similarity(self, own: list[int], item: int) -> float:
        other = self.items[item][2]
        shared = [other[s] for s in own if s in other]
        foreign, total = len(own) - len(shared), sum(other.values())
        return max(sum(shared) / (total + foreign * total / len(other)), len(shared) / (len(other) + foreign))

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places of ``hashes`` that are an item's shingle."""
        maybe = np.flatnonzero(self.maybe[(hashes & _U((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        return maybe[np.isin(hashes[maybe], self.shingles)]


def _promising(hits: list[tuple[int, float]], words: int, size: int, width: int, counted: float, weighed: float) -> np.ndarray:
    """Starts of the windows of ``size`` words whose hits ``(place, weight)`` can do for an item that has at least
    this many shingles, or these weights."""
    place, weight = (np.array(c) for c in zip(*sorted(hits), strict=True))
    run = size - width + 1  # shingles of a window
    # windows that hold the same hits: they change where one comes in or leaves
    edges = np.unique(np.concatenate([place - run + 1, place + 1]).clip(0, words - size + 1))
    sums = np.concatenate([[0.0], np.cumsum(weight)])
    lo, hi = np.searchsorted(place, edges[:-1]), np.searchsorted(place, edges[:-1] + run)
    enough = (hi > lo) & ((hi - lo >= SIMILARITY * counted - 1e-6) | (sums[hi] - sums[lo] >= SIMILARITY * weighed - 1e-6))
    spans = [np.arange(a, b) for a, b in zip(edges[:-1][enough].tolist(), edges[1:][enough].tolist(), strict=True)]
    return np.concatenate(spans) if spans else np.zeros(0, np.int64)


def _windows(words: np.ndarray, size: int, width: int, starts: np.ndarray) -> Iterator[tuple[int, list[int], int]]:
    """``(start, distinct shingles, fingerprint)`` of the windows of ``size`` words; starts ascend."""
    run = size - width + 1
    # a run of windows that lie close together, of 4096 places at most
    for own in np.split(starts, np.flatnonzero((np.diff(starts) > run) | (np.diff(starts >> 12) > 0)) + 1):
        if len(own):
            first = int(own[0])
            grams = _text.grams(words[first : int(own[-1]) + size], width)
            bits = _bits(grams)
            sums = np.concatenate([np.zeros((1, BITS), np.int64), np.cumsum(bits, axis=0)])
            rolled = sums[own - first + run] - sums[own - first]
            last: dict[int, int] = {}
            for i, g in enumerate(grams.tolist()):
                before = last.get(g)
                if before is not None and i - before < run:  # in the windows that hold both, it counts once
                    a, b = np.searchsorted(own - first, i - run + 1), np.searchsorted(own - first, before, "right")
                    rolled[a:b] -= bits[i]
                last[g] = i
            for start, print_ in zip(own.tolist(), _signs(rolled), strict=True):
                yield start, np.unique(grams[start - first : start - first + run]).tolist(), print_


def _search(index: Index):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
    names = ["doc_id", "item_id", "first_word", "n_words", "similarity", "hamming"]

    def of(words: np.ndarray, places: list[tuple[int, int]]) -> dict[int, tuple]:
        """The best window of a document (its word hashes) for each item; places: (place, shingle)."""
        by_size: dict[int, list[tuple[int, float]]] = {}
        for place, gram in places:
            for size, weight in index.at[gram].items():
                by_size.setdefault(size, []).append((place, weight))
        best: dict[int, tuple] = {}
        for size, hits in sorted(by_size.items()):
            n = min(size, len(words))
            width = min(SHINGLE, n)
            for start, own, print_ in _windows(words, n, width, _promising(hits, len(words), n, width, *index.needed[size])):
                for item in index.near(size, print_):
                    share = index.similarity(own, item)
                    if share >= SIMILARITY - 1e-12 and (item not in best or share > best[item][2]):
                        best[item] = start, n, share, (index.prints[item] ^ print_).bit_count()
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, starts in _text.slices(batch.column(1)):
                words = _text.find_words(data, starts, _text.separators("alnum"))
                hashes = words.hashes(lower=True)
                found: dict[int, list] = {}
                for size in (*index.short, SHINGLE):
                    places, values = _text.doc_grams(words, hashes, size)
                    for h in index.hits(values).tolist():
                        doc = int(words.doc[places[h]])
                        found.setdefault(doc, []).append((int(places[h] - words.first[doc]), int(values[h])))
                rows = [
                    (batch.column(0)[lo + doc].as_py(), index.items[n][0], *hit)
                    for doc, at in sorted(found.items())
                    for n, hit in sorted(of(hashes[words.first[doc] : words.first[doc + 1]], at).items())
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, similarity, hamming)``: each document and item with a window of the
    document whose weighted or plain shingle similarity to the item is SIMILARITY or more, and the most similar window.

    Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters, counted from 0.
    """
    items = stored(benchmark.select("item_id", "text").mapInArrow(_item_words, "item_id long, words array<long>, shingles array<long>").where(F.size("words") > 0), "items")
    shared = items.dropDuplicates(["words"]).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg((1.0 / F.count("*")).alias("weight"))
    weighed = items.select("item_id", "words", F.explode("shingles").alias("shingle")).join(shared, "shingle")
    weighed = weighed.groupBy("item_id", "words").agg(F.collect_list(F.struct("shingle", "weight")).alias("shingles"))
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    # equal items (the same id and words) were counted together: as many rows again as there were
    copies = items.groupBy("item_id", "words").count()
    weighed = stored(weighed.join(copies, ["item_id", "words"]).withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))), "weighed")
    found, mask = [], (1 << 64) - 1
    texts = documents.select("doc_id", "text")
    for block in range(blocks):
        rows = weighed.where(F.col("block") == block).collect()  # BLOCK_WORDS words or so
        index = Index([
            (r["item_id"], np.array(r["words"], np.int64).astype(np.uint64), {s["shingle"] & mask: min(1.0, s["weight"]) for s in r["shingles"]})
            for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["words"])) for _ in range(r["count"])
        ])
        found.append(texts.mapInArrow(_search(index), "doc_id long, item_id long, first_word long, n_words long, similarity double, hamming int"))
    return reduce(DataFrame.union, found)


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows that hold a benchmark item; a row is judged by its text."""
    key = F.xxhash64("doc_id", "text")
    leaks = contaminated(documents.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__key")).distinct()
    return documents.join(stored(leaks, "leaks"), key == F.col("__key"), "left_anti")
