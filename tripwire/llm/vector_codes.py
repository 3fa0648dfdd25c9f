"""Vector code compression: product quantisation in whole numbers, by per-dimension value dictionaries.

A component x becomes ``floor(256 x)``, and a vector is cut into ``parts`` equal consecutive parts. Each part position
has a codebook, at first that part of the ``entries`` smallest vec_ids; ``rounds`` times every part is assigned to its
nearest entry (ties: the lower index) and each entry becomes the componentwise ``floor(sum / count)`` of its parts
(an unused one stays); then the parts are assigned for good.

Method. Vectors are stored in blocks of ``BLOCK_ROWS`` rows, each dimension of a block as a dictionary of its distinct
integers and a code for each row. For a dimension the squared differences of every distinct integer to all entries are
tabulated once a block; the distances of all parts are then gathers from these tables by code, and adds. Blocks are
written once and read by each pass. A task sends one row for each entry it used (sums and counts), so what is shuffled
depends on tasks and entries only; the driver sees the codebooks alone.

Defined results: a vector that is null or holds a null or non-finite component is dropped. The dimension is the commonest
length, divisible by ``parts``, of the other vectors (ties: the longer). A vector of another length, or with a component
of 65,536 or more either way, can't be coded exactly in 64 bits: it is returned with null code and error, and takes no
part in the codebooks. Repeated vec_ids are coded row by row and take their turn in the first codebook by their components;
a null vec_id comes after all others. Fewer vectors than entries give a smaller codebook. ``label_error`` is the sum over
equal labels (nulls together), null where it leaves 64 bits or no vector of the label has an error. No vectors: no rows.
Columns other than vec_id, embedding and label aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm._tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK_ROWS = 4096
BOUND = 65_536  # |floor(256 x)| <= 2^24: squared differences stay below 2^50, their sum over 8,192 dimensions below 2^63
_BLOCK = "size int, dictionary binary, starts binary, codes binary"


def _every(test) -> Column:
    return F.coalesce(F.forall("embedding", lambda x: F.coalesce(test(x), F.lit(False))), F.lit(False))


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    """The whole numbers of list rows of one length."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), width)


def _encode(width: int, kinds: list[pa.DataType], names: list[str]):
    """Blocks of vectors: their ids and labels, and a dictionary with codes for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                numbers = _numbers(part.column(2), width)
                values, codes, starts = [], np.zeros((width, len(numbers)), np.uint16), [0]
                for d in range(width):
                    distinct, codes[d] = np.unique(numbers[:, d], return_inverse=True)
                    values.append(distinct)
                    starts.append(starts[-1] + len(distinct))
                dictionary = np.concatenate(values) if values else np.zeros(0, np.int64)
                one = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(c)) for c in (0, 1)]
                blobs = [pa.array([b], pa.binary()) for b in (dictionary.tobytes(), np.array(starts, np.int64).tobytes(), codes.tobytes())]
                yield pa.RecordBatch.from_arrays([*[x.cast(pa.list_(k)) for x, k in zip(one, kinds, strict=True)], pa.array([len(numbers)], pa.int32()), *blobs], names=names)

    return run


class Codes:
    """One block: ``dictionary(d)`` are dimension d's distinct integers and ``codes[d]`` each row's place among them."""

    def __init__(self, row: dict):
        self.values = np.frombuffer(row["dictionary"], np.int64)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.codes = np.frombuffer(row["codes"], np.uint16).reshape(-1, row["size"])

    def dictionary(self, d: int) -> np.ndarray:
        return self.values[self.starts[d] : self.starts[d + 1]]

    def column(self, d: int) -> np.ndarray:
        return self.dictionary(d)[self.codes[d]]

    def nearest(self, part: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(entry, squared distance)`` of each row's part; ``book`` is entries x dimensions of the part."""
        total = np.zeros((self.codes.shape[1], len(book)), np.int64)
        width = book.shape[1]
        for j in range(width):
            d = part * width + j
            table = (self.dictionary(d)[:, None] - book[:, j][None, :]) ** 2
            total += table[self.codes[d]]
        entry = total.argmin(axis=1)
        return entry, total[np.arange(len(entry)), entry]


def _sums(books: np.ndarray):
    """A task's count and component sums of the parts nearest to each entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                block = Codes(row)
                for part in range(parts):
                    entry, _ = block.nearest(part, books[part])
                    count[part] += np.bincount(entry, minlength=entries)
                    for j in range(width):  # a block's sums are below 2^53, so exact in doubles
                        total[part, :, j] += np.bincount(entry, block.column(part * width + j), entries).astype(np.int64)
        used = np.nonzero(count)
        if len(used[0]):
            columns = [used[0].astype(np.int32), used[1].astype(np.int32), count[used], *total[used].T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "n", *[f"s{j}" for j in range(width)]])

    return run


def _coded(books: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(names[2:]).to_pylist()):
                block = Codes(row)
                found = [block.nearest(part, book) for part, book in enumerate(books)]
                text = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                step = 2 * len(books)
                code = [text[at : at + step] for at in range(0, len(text), step)]
                error = sum(distance for _, distance in found)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, batch.column(1)[i].values, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def _learnt(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of its parts' means."""
    width = books.shape[2]
    sums = [f"s{j}" for j in range(width)]
    seen = blocks.select("size", "dictionary", "starts", "codes").mapInArrow(_sums(books), ", ".join(["part int, entry int, n long", *[f"{s} long" for s in sums]]))
    out = books.copy()
    for row in seen.groupBy("part", "entry").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ["n", *sums]]).collect():  # parts x entries rows at most
        out[row["part"], row["entry"]] = [int(row[s]) // int(row["n"]) for s in sums]
    return out


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every vector without null or non-finite components;
    ``entries`` is 256 at most."""
    from pyspark.sql.pandas.types import to_arrow_type

    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    table = vectors.select("vec_id", "label", "embedding")
    kept = table.where(_every(lambda x: F.abs(x.cast("double")) < float("inf")))
    lengths = kept.groupBy(F.size("embedding").alias("d")).count().where(F.col("d") % parts == 0)
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    width = common["d"] if common else -1
    fits = (F.size("embedding") == width) & _every(lambda x: F.abs(x.cast("double")) < BOUND)
    usable = kept.where(fits)
    first = usable.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    id_type, label_type = (table.schema[c].dataType for c in ("vec_id", "label"))
    result = f"vec_id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error long"
    books = np.zeros((parts, 0, 0), np.int64)
    if first:
        start = np.floor(np.array([r["embedding"] for r in first], np.float64).reshape(len(first), width) * SCALE).astype(np.int64)
        books = start.reshape(len(first), parts, width // parts).transpose(1, 0, 2)
        names = ["vec_id", "label", *[c.split()[0] for c in _BLOCK.split(", ")]]
        kinds = [to_arrow_type(id_type), to_arrow_type(label_type)]
        schema = f"vec_id array<{id_type.simpleString()}>, label array<{label_type.simpleString()}>, {_BLOCK}"
        blocks = stored(usable.mapInArrow(_encode(width, kinds, names), schema), "vector_blocks")
        for _ in range(rounds):
            books = _learnt(blocks, books)
        coded = blocks.mapInArrow(_coded(books, names), result)
    else:
        coded = vectors.sparkSession.createDataFrame([], result)
    others = kept.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rows = stored(coded.unionByName(others), "vector_codes")
    sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("total"))
    sums = stored(sums.select(F.col("label").alias("of"), F.expr("try_cast(total AS bigint)").alias("label_error")), "label_errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
