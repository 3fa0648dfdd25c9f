"""MinHash near-duplicates: SuperMinHash signatures, banding, exact verification, union-find groups.

SuperMinHash gives each element a permutation of the signature's places and
ranks ``r + j`` that rise along it, so the ranks of one element are spread over
all places. A document's places fill up after a few steps of the permutation,
and steps whose ranks can't improve any place are not taken (early stopping).

Texts with equal shingle sets form a *class*; classes, not copies, are
compared. A class meets the others of a band bucket through a pivot (the
bucket's least class), never all pairs, and the links that hold are grouped.
Only buckets that still have classes of several groups are looked at again:
their classes go once to each pair of their bands, and the classes of a pair
that holds several groups form a candidate cluster (the classes that any two
classes of different groups with two bands in common connect). Clusters that
hold several groups are compared in full, two blocks of classes at a time, and a
task returns only links between groups that it hasn't joined yet. So rows grow
with the classes, and every candidate pair of different groups is decided. Each
link is confirmed on the full shingle sets. All joins are sort-merge joins: no
side of them goes through the driver.

Defined results: null, empty and wordless texts have an empty set, link with
nothing and keep their own id as component (null for a null id). A text with
fewer words than a shingle is one shingle. Rows that repeat an id or a text are
all returned, each with the component of its text. Columns other than the id
and the text are ignored by ``near_duplicates`` and returned by
``keep_representatives`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm import _text
from tripwire.llm._graph import components
from tripwire.llm._tables import merged, partitions, stored

BANDS, ROWS = 28, 4  # a pair at similarity 0.8 shares no band with probability 3.9e-7, fewer than two with 8e-6
MEMBERS_A_TASK_GROUP = 64
BLOCK_CLASSES = 192  # of a cluster that meet another block at a time
_LISTED = 6  # steps after which the permutations of the elements still at work are held whole
_BLOCK = 100_000  # elements at a time
_U = np.uint64


def super_minhash(bounds: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Signatures ``[documents, size]`` of the sets ``values[bounds[i]:bounds[i+1]]`` (infinite for an empty set)."""
    docs = len(bounds) - 1
    ranks = np.full(docs * size, np.inf)
    table = ranks.reshape(docs, size)
    owner = np.repeat(np.arange(docs), np.diff(bounds))
    for at in range(0, len(values), _BLOCK):
        x, doc = values[at : at + _BLOCK], owner[at : at + _BLOCK]
        swapped: list[tuple[np.ndarray, np.ndarray]] = []  # (place swapped, what came there) of each step so far
        order = None
        for j in range(size):
            if j:
                here = np.arange(doc[0], doc[-1] + 1) if j == 1 else here[live_docs]
                live_docs = table[here].max(1) > j
                if not live_docs.any():
                    break
                if not live_docs.all():
                    live = live_docs[doc - here[0]] if j == 1 else np.repeat(live_docs, np.searchsorted(doc, here, "right") - np.searchsorted(doc, here))
                    x, doc = x[live], doc[live]
                    swapped = [(k[live], v[live]) for k, v in swapped]
                    order = None if order is None else order[live]
            random = _text.mix(x + _U(((j + 1) * 0x9E3779B97F4A7C15) % (1 << 64)))
            step = (j + (((random & _U(0xFFFFFFFF)) * _U(size - j)) >> _U(32)).astype(np.int64)).astype(np.int16)
            if j <= _LISTED:
                place, moved = step.copy(), np.full(len(x), j, np.int16)
                for k, v in swapped:
                    np.copyto(place, v, where=k == step)
                    np.copyto(moved, v, where=k == j)
                swapped.append((step, moved))
            else:
                row = np.arange(len(x))
                if order is None:
                    order = np.tile(np.arange(size, dtype=np.int16), (len(x), 1))
                    for k, v in swapped:
                        order[row, k] = v
                    swapped = []
                place = order[row, step]
                order[row, step] = order[row, j]
            np.minimum.at(ranks, doc * size + place, j + (random >> _U(32)).astype(np.float64) / 4294967296.0)
    return ranks.reshape(docs, size)


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(signatures), 1), np.uint64)
    for k in range(ROWS):
        key = _text.mix(key * _U(0xD1342543DE82EF95) + bits[:, :, k])
    return key.astype(np.int64)


def _sets(text: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list]]:
    """``(lo, hi, bounds, values, digests)`` by slices; a digest is None for an empty set."""
    for lo, hi, data, starts in _text.slices(text):
        words = _text.find_words(data, starts, _text.separators("space"))
        bounds, values = _text.shingle_sets(words, words.hashes(lower=True), shingle)
        digests = [xxhash.xxh3_128_digest(values[a:b].tobytes()) if b > a else None for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield lo, hi, bounds, values, digests


def _signed(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, bounds, values, digests in _sets(batch.column(1), shingle):
                keys = _band_keys(super_minhash(bounds, values, BANDS * ROWS))
                sizes = np.diff(bounds)
                bands = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32), keys[sizes > 0].ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), bands],
                    names=["doc_id", "key", "n_shingles", "class", "bands"],
                )

    return run


def _expected_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            for lo, hi, bounds, values, digests in _sets(batch.column(1), shingle):
                hits = [i for i, d in enumerate(digests) if d == wanted[lo + i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digests[i] for i in hits], pa.binary()), pa.array([values[bounds[i] : bounds[i + 1]].tobytes() for i in hits], pa.binary())],
                    names=["class", "shingles"],
                )

    return run


def _compare(percent: int):
    """Rows come sorted by (a, salt, b), the pivot's own row (b null) first: hold its set, compare the others with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, held = None, None
        for batch in batches:
            out_a, out_b = [], []
            for a, b, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                values = np.frombuffer(packed.as_buffer(), np.uint64)
                if b is None:
                    pivot, held = a, values.copy()
                    continue
                if a != pivot:
                    raise RuntimeError("a class to compare came without its pivot")
                least, most = sorted((len(values), len(held)))
                if 100 * least < percent * most:
                    continue
                at = np.searchsorted(held, values)
                shared = int((held[np.minimum(at, len(held) - 1)] == values).sum())
                if 100 * shared >= percent * (len(values) + len(held) - shared):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["a", "b"])

    return run


def _sets_of(asked: DataFrame, classes: DataFrame, documents: DataFrame, shingle: int) -> DataFrame:
    """``(class, shingles)`` of the classes asked for, each from one of its texts."""
    needed = merged(classes, asked, "class").select("class", "key")
    texts = merged(documents, needed, "key").select("class", "text")
    # repeated rows give the same set more than once
    return stored(texts.mapInArrow(_expected_sets(shingle), "class binary, shingles binary").dropDuplicates(["class"]), "sets")


def _several_groups(member: DataFrame, key: str) -> DataFrame:
    """The rows of those buckets or clusters that hold classes of several groups, with their number."""
    mixed = member.groupBy(key).agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n")).where("least != most")
    return stored(merged(member, mixed.select(key, "n"), key), "split")


def _in_blocks(member: DataFrame, key: str) -> DataFrame:
    """Every class once for each block of its bucket or cluster: with (i, j), the pair of blocks that it is to meet in."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK_CLASSES)).cast("int")
    own = member.withColumn("own", F.pmod(F.xxhash64("class"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return own.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class", "root")


def _candidates(split: DataFrame) -> DataFrame:
    """``(cluster, class, root)``: the clusters that classes of different groups with two bands in common connect.

    All classes with one pair of bands are joined to the least of them if they hold several groups, which connects
    the same classes as all links between its groups would. Classes go by 64 bits of their digest here: two that
    agree in these would only be compared once more.
    """
    named = split.groupBy("class", "root").agg(F.array_sort(F.collect_list("bucket")).alias("buckets"))  # BANDS or fewer
    named = stored(named.withColumn("node", F.xxhash64("class")), "split")
    pairs = "flatten(transform(buckets, (x, i) -> transform(slice(buckets, i + 2, size(buckets)), y -> xxhash64(x, y))))"
    rows = named.select("node", F.xxhash64("root").alias("group"), F.explode(F.expr(pairs)).alias("pair"))
    mixed = rows.groupBy("pair").agg(F.min("group").alias("least"), F.max("group").alias("most"), F.min("node").alias("first")).where("least != most")
    clusters = components(merged(rows, mixed, "pair").select("node", "first"))
    inside = clusters.select("node", F.col("root").alias("cluster")).union(clusters.select("root", "root").distinct())
    return merged(named, inside, "node").select("cluster", "class", "root")


def _compare_all(percent: int):
    def compare(roots: np.ndarray, bodies: list) -> np.ndarray:
        sets = [np.frombuffer(b, np.uint64) for b in bodies]
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        column = np.cumsum(times > 1) - 1
        owner, column = owner[times[at] > 1], column[at[times[at] > 1]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, lo), np.searchsorted(column, lo + 4096)
            holds = np.zeros((len(sets), 4096), np.float32)
            holds[owner[a:b], column[a:b] - lo] = 1
            shared += holds @ holds.T
        shared = shared.astype(np.int64)
        union = sizes[:, None] + sizes[None, :] - shared
        return (100 * shared >= percent * union) & (roots[:, None] != roots[None, :])

    return compare


def _by_blocks(rows: DataFrame, key: str, relation) -> DataFrame:
    """Links ``(a, b)`` by a relation between the classes of two blocks, one pair of blocks at a time; of those
    that join the same groups, a task returns one. ``rows``: key, i, j, class, root and what the relation looks at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined: dict[bytes, bytes] = {}  # groups that this task has joined to another

        def top(group: bytes) -> bytes:
            while group in joined:
                joined[group] = joined.get(joined[group], joined[group])
                group = joined[group]
            return group

        def send(held: list) -> pa.RecordBatch:
            names, edges = [r[0] for r in held], []
            _, roots = np.unique(np.array([r[1] for r in held], object), return_inverse=True)
            for a, b in np.argwhere(np.triu(relation(roots, [r[2] for r in held]))).tolist():
                one, other = top(held[a][1]), top(held[b][1])
                if one != other:
                    joined[max(one, other)] = min(one, other)
                    edges.append((names[a], names[b]))
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.binary()), pa.array([e[1] for e in edges], pa.binary())], names=["a", "b"])

        held, current = [], None
        for batch in batches:
            for group, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (group, i, j) != current:
                    if len(held) > 1:
                        yield send(held)
                    held, current = [], (group, i, j)
                held.append(row)
        if len(held) > 1:
            yield send(held)

    dealt = rows.repartition(partitions(rows.sparkSession), key, "i", "j").sortWithinPartitions(key, "i", "j")
    return dealt.mapInArrow(run, "a binary, b binary")


def _confirm(pairs: DataFrame, classes: DataFrame, documents: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough. A pivot's set goes once to every 64 or so
    partners, so neither a frequent pivot nor its partners meet in one task."""
    classes_asked = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    sets = _sets_of(classes_asked, classes, documents, shingle)
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(MEMBERS_A_TASK_GROUP)).cast("int").alias("parts"))
    members = merged(pairs, parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("salt"))
    pivots = parts.select("a", F.lit(None).cast("binary").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    rows = merged(members, sets.withColumnRenamed("class", "b"), "b").select("a", "b", "shingles", "salt").union(
        merged(pivots, sets.withColumnRenamed("class", "a"), "a").select("a", "b", "shingles", "salt")
    )
    dealt = rows.repartition(partitions(documents.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return stored(dealt.select("a", "b", "shingles").mapInArrow(_compare(percent), "a binary, b binary"), "links")


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _grouped(documents: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``(doc_id, key, n_shingles, root, component_id)`` for each row; ``root`` names its group (null without words)
    and ``component_id`` is the least doc_id of that (null if no row of it has one)."""
    documents = documents.select("doc_id", "text", _row_key().alias("key"))
    signed = stored(documents.mapInArrow(_signed(shingle), "doc_id long, key long, n_shingles long, class binary, bands array<long>"), "signed")
    one = signed.where("class is not null").groupBy("class")
    classes = stored(one.agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.first("bands").alias("bands")), "classes")
    rows = classes.select("class", F.explode("bands").alias("bucket"))
    crowded = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("class").alias("pivot")).where("n > 1").drop("n")
    crowded = stored(merged(rows, crowded, "bucket"), "buckets")

    asked = crowded.where("class != pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct()
    links = _confirm(stored(asked, "pairs"), classes, documents, shingle, percent)
    roots = components(links)

    member = merged(crowded, roots.withColumnRenamed("node", "class"), "class", "left").select("bucket", "class", F.coalesce("root", "class").alias("root"))
    inside = _candidates(_several_groups(member, "bucket"))
    split = _several_groups(inside, "cluster")
    sets = _sets_of(split.select("class").distinct(), classes, documents, shingle)
    with_sets = merged(_in_blocks(split, "cluster"), sets, "class").select("cluster", "i", "j", "class", "root", "shingles")
    links = links.union(stored(_by_blocks(with_sets, "cluster", _compare_all(percent)), "links"))
    roots = components(links)

    grouped = merged(classes.select("class", "doc_id"), roots.withColumnRenamed("node", "class"), "class", "left").select("class", "doc_id", F.coalesce("root", "class").alias("root"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = merged(grouped, least, "root").select("class", "root", "component_id")
    return merged(signed, named, "class", "left").select("doc_id", "key", "n_shingles", "root", "component_id")


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``documents (doc_id, text)``.

    Words are lower-cased (A-Z) and split at ASCII white space; documents link
    when ``100 * intersection >= percent * union`` of their distinct
    ``shingle``-word shingles. ``component_id`` is the least doc_id reachable.
    """
    rows = _grouped(documents, shingle, percent)
    own = rows.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return own.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_representatives(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` without the rows that repeat another: one row of each component stays, that of the least
    (doc_id, text), null ids last. Rows without words stay, identical ones too."""
    rows = _grouped(documents, shingle, percent).where("root is not null")
    least = stored(rows.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("root", "key").distinct(), "least")
    numbered = least.groupBy("root").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    # several texts under the least id (or under none): the least text of them
    several = merged(least, numbered.where("n > 1").select("root"), "root")
    by_text = merged(documents.select("text", _row_key().alias("key")), several, "key").groupBy("root").agg(F.min_by("key", "text").alias("key"))
    chosen = numbered.where("n = 1").select("key").union(by_text.select("key")).withColumnRenamed("key", "__kept")
    wordless = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(0)) == 0
    spoken = documents.where(~wordless).withColumn("__key", _row_key())
    spoken = merged(spoken, stored(chosen, "chosen"), F.col("__key") == F.col("__kept"), "left_semi").dropDuplicates(["__key"])
    return documents.where(wordless).unionByName(spoken.drop("__key"))
