"""Ranked lexical search: the ``k`` best documents of every item, by a dual-tree search.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased. With N the documents
that hold a term, L all their terms, n a document's terms and df the documents that hold a term, a term weighs
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and a document gives it ``c = 10^9 tf div (1000 tf + 12 m)`` with
``m = 75 + 25 n N div L``. A score is the sum of w * c over the item's terms, repeats included, so an item is a sparse
vector of repeats * w, a document one of c, and nothing is negative.

Method. Items form a tree (leaves of ``ITEM_LEAF``, ``FAN`` children above) and the documents of each batch form
another; a node holds the largest value of each coordinate below it. The product of an item node with a document node
bounds every score between the two, so the pair is dropped whole when that bound is below the weakest k-th score of the
node's items. What remains is descended on both sides, an item leaf with one bound for each of its items; leaf pairs are
scored exactly, best bounds first.

How it runs. Items are taken in blocks of ``BLOCK_WORDS`` words (a longer item is a block by itself), one block at a
time. One pass over ``documents`` counts N, L and df and writes, for each task, batches of the postings of the block's
terms; texts are not shuffled. The batches are searched in rounds: those of every 4096th task, of every 64th, and of all
others, each batch once. A round starts from the k-th scores of the rounds before, so a task returns a document only if
it beats them, and the rows to merge stay near k * 64 an item whatever the number of tasks. Thresholds only prune:
the result is exact for any split.

Terms are compared by 64-bit hashes. Scores are summed in doubles where they stay below 2^53, else in 64-bit integers.

Defined results: null, empty or term-less texts are in no result and not in N; a null ``doc_id`` sorts after all others
at equal scores; repeated rows are ranked each by itself. Items: equal rows count once, an ``item_id`` with
different texts is ranked for each text, a text without terms or without a document scoring above 0 gives no row, a
null ``item_id`` is an item like others. No documents or no items: no rows. Other columns of the inputs are not read. A
single text must fit in a task's memory; batches are cut so that a document tree has ``CELLS`` values at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm import _text
from tripwire.llm._tables import stored
from tripwire.session import scratch_path

BLOCK_WORDS = 500_000
ROUNDS = (4096, 64, 1)  # a round takes the tasks whose number is a multiple of this and in no round before
ITEM_LEAF, DOC_LEAF, FAN = 8, 16, 4
PACK_DOCS = 512
CELLS = 1 << 22
LEAVES_AT_ONCE = 4
TURNS = 3
_EXACT = float(1 << 53)
_C_MAX = 1e6  # c is below this: m is 75 at least
_SLACK = 1 + 1e-9  # more than doubles lose in a sum of a block's terms
_NULL_ID = np.iinfo(np.int64).max
_OUTSIDE = _text.separators("alnum")
_POSTINGS = "round int, ids binary, absent binary, n binary, ptr binary, term binary, tf binary, docs long, terms long, df binary"


@dataclass
class Block:
    """Items of one block: ``term[ptr[i]:ptr[i+1]]`` are item i's distinct terms (places in ``vocabulary``)."""

    ids: list
    vocabulary: np.ndarray
    ptr: np.ndarray
    term: np.ndarray
    times: np.ndarray


@dataclass
class ItemNode:
    items: np.ndarray
    term: np.ndarray
    top: np.ndarray  # the largest value of each term
    children: list[ItemNode]
    dense: np.ndarray | None  # leaves: items x terms


def _term_hashes(texts: pa.Array) -> Iterator[tuple[int, _text.Words, np.ndarray]]:
    for lo, _, data, start in _text.slices(texts):
        words = _text.find_words(data, start, _OUTSIDE)
        yield lo, words, words.hashes(lower=True)


def _counted(words: _text.Words, place: np.ndarray, hit: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, term, times)`` of the hits, by document and term."""
    key, times = np.unique(words.doc[hit] * np.int64(size) + place[hit], return_counts=True)
    return key // size, key % size, times


def make_block(ids: list, texts: list[str]) -> Block:
    column = pa.array(texts, pa.large_string())
    parts = [(lo, words, h) for lo, words, h in _term_hashes(column)]
    vocabulary = np.unique(np.concatenate([h for *_, h in parts])) if parts else np.zeros(0, np.uint64)
    owner, term, times = [], [], []
    for lo, words, h in parts:
        place = np.searchsorted(vocabulary, h)
        doc, t, n = _counted(words, place, np.ones(len(h), bool), max(1, len(vocabulary)))
        owner.append(doc + lo)
        term.append(t)
        times.append(n)
    owner, term, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, term, times))
    return Block(ids, vocabulary, np.searchsorted(owner, np.arange(len(ids) + 1)), term, times)


def _blocks(items: DataFrame, block_words: int) -> Iterator[Block]:
    ids, texts, size = [], [], 0
    for row in items.select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator():
        words = len(row["text"] or "") // 2 + 1  # at most so many terms
        if ids and size + words > block_words:
            yield make_block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"] or "")
        size += words
    if ids:
        yield make_block(ids, texts)


# ---------------------------------------------------------------- postings

def _postings(vocabulary: np.ndarray):
    """Batches of the documents that hold a term of ``vocabulary``, and in a task's last row its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        turn = next(i for i, every in enumerate(ROUNDS) if task % every == 0)
        size = max(1, len(vocabulary))
        df = np.zeros(size, np.int64)
        docs = terms = 0
        held: list[tuple] = []

        def row(parts: list[tuple], counts: tuple | None = None) -> pa.RecordBatch:
            ids, absent, n, each, term, tf = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else [()] * 6))
            ptr = np.concatenate([[0], np.cumsum(each)])
            blobs = [x.astype(kind).tobytes() for x, kind in ((ids, np.int64), (absent, bool), (n, np.int64), (ptr, np.int64), (term, np.int32), (tf, np.int64))]
            total = counts or (0, 0, b"")
            values = [turn, *blobs, *total]
            kinds = [pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in _POSTINGS.split(", ")])

        waiting = 0
        for batch in batches:
            ids = batch.column(0)
            absent = np.asarray(ids.is_null())
            ids = np.asarray(ids.fill_null(_NULL_ID)).astype(np.int64)
            for lo, words, hashes in _term_hashes(batch.column(1)):
                n = np.diff(words.first)
                docs += int(np.count_nonzero(n))
                terms += int(n.sum())
                if not len(vocabulary):
                    continue
                place = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
                doc, term, tf = _counted(words, place, vocabulary[place] == hashes, size)
                df += np.bincount(term, minlength=size)
                have, first = np.unique(doc, return_index=True)
                ends = np.append(first, len(doc))
                for at in range(0, len(have), PACK_DOCS):
                    part = have[at : at + PACK_DOCS]
                    span = slice(ends[at], ends[at + len(part)])
                    held.append((ids[lo + part], absent[lo + part], n[part], np.diff(ends[at : at + len(part) + 1]), term[span], tf[span]))
                    waiting += len(part)
                    if waiting >= PACK_DOCS:
                        yield row(held)
                        held, waiting = [], 0
        yield row(held, (docs, terms, df.tobytes()))

    return run


# ---------------------------------------------------------------- trees

def _merged(term: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms with their largest value."""
    if not len(term):
        return term, value
    order = np.argsort(term, kind="stable")
    term, value = term[order], value[order]
    first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    return term[first], np.maximum.reduceat(value, first)


def alike(ptr: np.ndarray, column: np.ndarray, value: np.ndarray, width: int, leaf: int) -> np.ndarray:
    """The rows of a sparse matrix, in an order that has similar ones in the same leaf and the same subtree: they are halved
    again and again by their place along a direction of large variance (``TURNS`` power iterations from a fixed start)."""
    n = len(ptr) - 1
    owner = np.repeat(np.arange(n), np.diff(ptr))
    length = np.sqrt(np.bincount(owner, value * value, n))
    unit = value / np.where(length > 0, length, 1)[owner]
    start = np.random.default_rng(1).standard_normal(width)
    out = []

    def halve(rows: np.ndarray) -> None:
        if len(rows) <= leaf:
            out.append(rows)
            return
        each = ptr[rows + 1] - ptr[rows]
        ends = np.cumsum(each)
        at = np.arange(ends[-1]) + np.repeat(ptr[rows] - ends + each, each)
        c, u, own = column[at], unit[at], np.repeat(np.arange(len(rows)), each)
        along = np.bincount(own, u * start[c], len(rows))
        for _ in range(TURNS):
            along -= along.mean()
            along /= max(np.abs(along).max(), 1e-300)
            along = np.bincount(own, u * np.bincount(c, u * along[own], width)[c], len(rows))
        order = np.argsort(along, kind="stable")
        half = -(-(len(rows) // 2) // leaf) * leaf
        halve(rows[order[:half]])
        halve(rows[order[half:]])

    halve(np.arange(n))
    return np.concatenate(out)


def item_tree(block: Block, weight: np.ndarray) -> ItemNode | None:
    """Similar items in the same leaf of ``ITEM_LEAF``; None if no item has a term of some weight."""
    value = block.times * weight[block.term].astype(np.float64)
    some = np.array([i for i, (lo, hi) in enumerate(pairwise(block.ptr)) if value[lo:hi].any()], np.int64)
    if not len(some):
        return None
    order = alike(block.ptr, block.term, value, len(weight), ITEM_LEAF)
    order = order[np.isin(order, some)]
    nodes = []
    for at in range(0, len(order), ITEM_LEAF):
        items = order[at : at + ITEM_LEAF]
        spans = [slice(block.ptr[i], block.ptr[i + 1]) for i in items]
        term, top = _merged(np.concatenate([block.term[s] for s in spans]), np.concatenate([value[s] for s in spans]))
        dense = np.zeros((len(items), len(term)))
        for row, s in zip(dense, spans, strict=True):
            row[np.searchsorted(term, block.term[s])] = value[s]
        nodes.append(ItemNode(items, term, top, [], dense))
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), FAN):
            below = nodes[at : at + FAN]
            term, top = _merged(np.concatenate([x.term for x in below]), np.concatenate([x.top for x in below]))
            above.append(ItemNode(np.concatenate([x.items for x in below]), term, top, below, None))
        nodes = above
    return nodes[0]


class DocTree:
    """A tree over some documents. ``levels[0]`` is the root, the last level the leaves of ``DOC_LEAF`` documents."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, column: np.ndarray, values: np.ndarray, heavy: np.ndarray, width: int):
        order = alike(ptr, column, heavy.astype(np.float64), width, DOC_LEAF)
        table = np.zeros((len(ids), width), np.float32)
        table[np.repeat(np.arange(len(ids)), np.diff(ptr)), column] = values
        self.table, self.ids = table[order], ids[order]
        levels = [np.maximum.reduceat(self.table, np.arange(0, len(ids), DOC_LEAF), axis=0)]
        while len(levels[0]) > 1:
            levels.insert(0, np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN), axis=0))
        self.levels = levels

    def below(self, depth: int, nodes: np.ndarray) -> np.ndarray:
        out = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return out[out < len(self.levels[depth + 1])]


class Search:
    """The best documents so far of every item of a block."""

    def __init__(self, root: ItemNode, n_items: int, k: int, score: np.ndarray, doc: np.ndarray):
        self.root, self.k = root, k
        self.score, self.doc = score.copy(), doc.copy()  # what a document must beat
        self.best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n_items
        self.scored = self.bounded = 0

    def add(self, tree: DocTree, place: np.ndarray) -> None:
        """``place``: the tree's column of each term, or -1."""
        self._visit(tree, place, self.root, 0, np.array([0]))

    def _visit(self, tree: DocTree, place: np.ndarray, node: ItemNode, depth: int, groups: np.ndarray) -> None:
        column = place[node.term]
        held = column >= 0
        if not held.any():
            return
        column = column[held]
        while True:
            # of inner nodes one bound for all items, of leaves one for each
            weakest = self.score[node.items] if node.dense is not None else self.score[node.items].min(keepdims=True)
            values = node.dense[:, held] if node.dense is not None else node.top[None, held]
            bounds = values @ tree.levels[depth][np.ix_(groups, column)].T.astype(np.float64) * _SLACK
            self.bounded += bounds.size
            alive = ((bounds > 0) & (bounds >= weakest[:, None])).any(axis=0)
            if not alive.any():
                return
            groups, bounds = groups[alive], bounds[:, alive]
            last = depth == len(tree.levels) - 1
            if node.children:
                below = groups if last else tree.below(depth, groups)
                for child in node.children:
                    self._visit(tree, place, child, depth if last else depth + 1, below)
                return
            if last:
                self._score(tree, node, values, column, groups, bounds)
                return
            groups, depth = tree.below(depth, groups), depth + 1

    def _score(self, tree: DocTree, node: ItemNode, values: np.ndarray, column: np.ndarray, leaves: np.ndarray, bounds: np.ndarray) -> None:
        kind = np.float64 if values.sum(axis=1).max() * _C_MAX < _EXACT else np.int64
        order = np.argsort(-bounds.max(axis=0), kind="stable")
        for at in range(0, len(order), LEAVES_AT_ONCE):
            now = order[at : at + LEAVES_AT_ONCE]
            alive = (bounds[:, now] > 0) & (bounds[:, now] >= self.score[node.items][:, None])
            items, now = np.flatnonzero(alive.any(axis=1)), now[alive.any(axis=0)]
            if not len(items):
                continue
            rows = (leaves[now][:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            rows = rows[rows < len(tree.ids)]
            scores = (tree.table[np.ix_(rows, column)].astype(kind) @ values[items].T.astype(kind)).astype(np.int64)
            self.scored += scores.size
            ids = tree.ids[rows]
            for j, item in enumerate(node.items[items]):
                s = scores[:, j]
                better = ((s > self.score[item]) | ((s == self.score[item]) & (ids < self.doc[item]))) & (s > 0)
                if better.any():
                    self._keep(item, s[better], ids[better])

    def _keep(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        if self.best[item] is not None:
            score, doc = np.concatenate([self.best[item][0], score]), np.concatenate([self.best[item][1], doc])
        order = np.lexsort((doc, -score))[: self.k]
        self.best[item] = score[order], doc[order]
        if len(order) == self.k:
            self.score[item], self.doc[item] = score[order[-1]], doc[order[-1]]


def doc_trees(ids, n, ptr, term, tf, weight, n_docs, n_terms) -> Iterator[tuple[DocTree, np.ndarray]]:
    """Trees over runs of one batch's documents, and the column of each term in them."""
    m = 75 + (25 * n * n_docs) // n_terms
    c = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, np.diff(ptr)))
    place = np.full(len(weight), -1, np.int64)
    lo = 0
    while lo < len(ids):
        hi = len(ids)
        while True:  # halved until the table of this run is small enough; one document always is
            span = slice(ptr[lo], ptr[hi])
            used = np.unique(term[span])
            if hi - lo == 1 or (hi - lo) * len(used) <= CELLS:
                break
            hi = lo + (hi - lo) // 2
        place[used] = np.arange(len(used))
        yield DocTree(ids[lo:hi], ptr[lo : hi + 1] - ptr[lo], place[term[span]], c[span], c[span] * weight[term[span]], len(used)), place
        place[used] = -1
        lo = hi


def _searched(root: ItemNode, ids: list, kind: pa.DataType, k: int, weight: np.ndarray, n_docs: int, n_terms: int, score: np.ndarray, doc: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(root, len(ids), k, score, doc)
        for batch in batches:
            for row in batch.to_pylist():
                blob = {name: np.frombuffer(row[name], np.int32 if name == "term" else np.int64) for name in ("ids", "n", "ptr", "term", "tf")}
                if len(blob["ids"]):
                    for tree, place in doc_trees(**blob, weight=weight, n_docs=n_docs, n_terms=n_terms):
                        search.add(tree, place)
        for item, best in enumerate(search.best):
            if best is not None:
                found, docs = best
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(docs), pa.int32()),
                        pa.array([ids[item]] * len(docs), kind),
                        pa.array([None if d == _NULL_ID else d for d in docs.tolist()], pa.int64()),
                        pa.array(found, pa.int64()),
                    ],
                    names=["item", "item_id", "doc_id", "score"],
                )

    return run


# ---------------------------------------------------------------- operator

def _rank_block(docs: DataFrame, block: Block, kind: str, arrow_kind: pa.DataType, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    path = scratch_path(spark, "postings")
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_postings(block.vocabulary), _POSTINGS).write.partitionBy("round").parquet(path)
    postings = spark.read.schema(_POSTINGS).parquet(path)
    # A count for each task and term of the block, summed by term: nothing here grows with the documents but the rows.
    counts = postings.where(F.length("df") > 0)
    n_docs, n_terms = counts.agg(F.sum("docs"), F.sum("terms")).first()
    if not n_terms or not len(block.vocabulary):
        return None
    df = np.zeros(len(block.vocabulary), np.int64)
    for term, n in counts.select("df").mapInArrow(_held_terms, "term int, n long").groupBy("term").agg(F.sum("n")).toLocalIterator():
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    root = item_tree(block, weight)
    if root is None:
        return None
    score, doc = np.zeros(len(block.ids), np.int64), np.full(len(block.ids), _NULL_ID, np.int64)
    best = None
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for turn in range(len(ROUNDS)):
        search = _searched(root, block.ids, arrow_kind, k, weight, n_docs, n_terms, score, doc)
        found = postings.where(F.col("round") == turn).select("ids", "n", "ptr", "term", "tf").mapInArrow(search, f"item int, item_id {kind}, doc_id long, score long")
        rows = found if best is None else found.unionByName(best.drop("rank"))
        best = stored(rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
        if turn + 1 < len(ROUNDS):
            for row in best.where(F.col("rank") == k).select("item", "score", "doc_id").collect():  # one row an item of this block
                score[row["item"]], doc[row["item"]] = row["score"], _NULL_ID if row["doc_id"] is None else row["doc_id"]
    return best


def _held_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            one = np.frombuffer(blob, np.int64)
            total = one.copy() if total is None else total + one
    if total is not None:
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(total[term], pa.int64())], names=["term", "n"])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring documents of each item, ties by ascending doc_id."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    field = items.schema["item_id"].dataType
    columns = f"item_id {field.simpleString()}, rank int, doc_id long, score long"
    out = None
    for block in _blocks(items, block_words):
        found = _rank_block(docs, block, field.simpleString(), to_arrow_type(field), k)
        if found is not None:
            part = found.select("item_id", "rank", "doc_id", "score")
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], columns)
