"""Quality classifier: random Fourier features, ridge regression by normal equations, isotonic calibration.

Each text is reduced to a few statistics of its characters, words and lines.
Random Fourier features (cosines of random projections) of these approximate a
Gaussian kernel. Each partition sums the normal equations of its labelled rows;
the sums are added in Spark block by block, and the driver solves one system
whose size is the number of features. Ridge scores are calibrated by isotonic
regression over counts in fixed score bins, fitted on rows that the ridge has
not seen.

What reaches the driver has a fixed size: FEATURES squared numbers, the means and
deviations of the statistics, and BINS counts. All labelled rows take part.

Defined results: a null or empty text has all statistics 0 and gets a score
like any other. Rows with a null or unknown label are scored, not learnt from;
where an id has several labels, all count. Without any labelled row every score
is 0.5. Repeated rows are scored alike. Columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm import _text
from tripwire.llm._tables import stored

FEATURES = 300
WIDTH = 2.5  # of the kernel, in standard deviations of the statistics
RIDGE = 1e-3  # times the number of rows
BINS = 400
SEED = 7
NAMES = [
    "log_words", "word_length", "symbols", "marks", "capitals", "digits", "points", "pipes", "non_ascii", "same_as_before",
    "distinct", "line_words", "same_lines", "long_words", "one_letter", "log_lines", "same_three_back",
]
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&<>@^_~=+\\/[]{}", np.uint8))


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of NAMES for each document of a slice."""
    n = len(starts) - 1
    words = _text.find_words(data, starts, _text.separators("space"))
    hashes, doc = words.hashes(lower=True), words.doc
    per_doc = lambda at, weight=None: np.bincount(at, weight, minlength=n).astype(float)
    flags = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[starts]).astype(float)
    count = per_doc(doc)
    size = np.maximum(count, 1)
    starts_char = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(starts_char)])
    length = (chars[words.end] - chars[words.start]).astype(float)
    letters = np.maximum(per_doc(doc, length), 1)
    back = lambda k: per_doc(doc[k:][(hashes[k:] == hashes[:-k]) & (doc[k:] == doc[:-k])]) if len(doc) > k else np.zeros(n)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    # lines as words between line ends
    lines = _text.find_words(data, starts, np.arange(256) == 10)
    line_count = np.maximum(per_doc(lines.doc), 1)
    lh = lines.hashes()
    order = np.lexsort((lh, lines.doc))
    a, b = lh[order], lines.doc[order]
    again = np.zeros(len(a), bool)
    again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    out = np.stack([
        np.log1p(count), per_doc(doc, length) / size, np.sqrt(flags(_SYMBOLS[data]) / letters), np.sqrt(flags((data == 33) | (data == 63)) / size),
        flags((data >= 65) & (data <= 90)) / letters, np.sqrt(flags((data >= 48) & (data <= 57)) / letters), flags((data == 46) | (data == 44)) / size,
        np.sqrt(flags(data == 124) / size), flags((data >= 0xC0)) / letters, np.sqrt(back(1) / size), per_doc(d[new]) / np.maximum(size, 1) ** 0.9,
        np.log1p(count / line_count), np.sqrt(per_doc(b[again]) / line_count), per_doc(doc[length > 14]) / size, per_doc(doc[length == 1]) / size,
        np.log1p(per_doc(lines.doc)), np.sqrt(back(3) / size),
    ], axis=1)
    out[count == 0] = 0.0
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, starts in _text.slices(batch.column(1)):
            values = statistics(data, starts)
            flat = pa.array(values.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(np.arange(0, flat.__len__() + 1, len(NAMES), dtype=np.int32), flat)], names=["doc_id", "x"]
            )


class Features:
    """Standardised statistics through random cosines, and a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.scale = mean, 1.0 / np.maximum(deviation, 1e-6)
        self.weights = random.normal(0.0, 1.0 / WIDTH, (len(mean), FEATURES - 1))
        self.shift = random.uniform(0.0, 2.0 * np.pi, FEATURES - 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -6.0, 6.0)
        return np.hstack([np.ones((len(x), 1)), np.sqrt(2.0 / (FEATURES - 1)) * np.cos(z @ self.weights + self.shift)])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def _normal_equations(features: Features):
    """Rows of Z'Z with Z'y at the end, summed in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, FEATURES + 1))
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                z = features(_matrix(batch.column(0).slice(lo, 2000)))
                y = batch.column(1).slice(lo, 2000).to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[i] = sums.get(i, 0.0) + np.frombuffer(row)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([r.tobytes() for r in sums.values()], pa.binary())], names=["i", "row"])


def _ridge_scores(features: Features, beta: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                raw = features(_matrix(batch.column(1).slice(lo, 2000))) @ beta
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 2000), pa.array(raw)], names=["doc_id", "raw"])

    return run


def isotonic(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to ``good / total`` over bins (pool adjacent violators), joined by straight lines where bins are empty."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(total):
        blocks.append([good[i], total[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, t, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + t, blocks[-1][2], hi]
    if not blocks:
        return np.full(len(total), 0.5)
    at = [x for b in blocks for x in (b[2], b[3])]
    value = [b[0] / b[1] for b in blocks for _ in (0, 1)]
    return np.interp(np.arange(len(total)), at, value)


def score_documents(documents: DataFrame, labels: DataFrame, fit: Column, calibrate: Column, label: str = "quality", threshold: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted)`` for each row of ``documents (doc_id, text)``.

    ``labels`` has doc_id and the 0/1 column ``label``. ``fit`` and
    ``calibrate`` are conditions on doc_id: the rows that the ridge learns
    from, and those that calibrate it.
    """
    measured = stored(documents.select("doc_id", "text").mapInArrow(_measure, "doc_id long, x array<double>"), "statistics")
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"))
    learn = stored(measured.join(known.where(fit | calibrate), "doc_id").withColumn("fits", fit), "labelled")
    moments = learn.where("fits").agg(*[F.struct(F.avg(F.get("x", i)), F.stddev_pop(F.get("x", i))) for i in range(len(NAMES))]).first()
    if moments[0][0] is None:
        return measured.select("doc_id", F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"))
    features = Features(np.array([m[0] for m in moments]), np.array([m[1] for m in moments]))
    sums = learn.where("fits").select("x", "y").mapInArrow(_normal_equations(features), "i long, row binary")
    rows = sums.repartition("i").mapInArrow(_add, "i long, row binary").collect()  # FEATURES rows
    total = np.stack([np.frombuffer(r["row"]) for r in sorted(rows, key=lambda r: r["i"])])
    gram, target = total[:, :-1], total[:, -1]
    beta = np.linalg.solve(gram + RIDGE * gram[0, 0] * np.eye(FEATURES), target)
    scored = measured.select("doc_id", "x").mapInArrow(_ridge_scores(features, beta), "doc_id long, raw double")
    bin_of = F.least(F.greatest(F.floor(((F.col("raw") + 0.5) / 2.0) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    seen = learn.where(~F.col("fits")).select("doc_id", "x", "y")
    raw = seen.select(F.col("y").cast("long").alias("doc_id"), "x").mapInArrow(_ridge_scores(features, beta), "doc_id long, raw double")
    counts = raw.groupBy(bin_of.alias("bin")).agg(F.sum("doc_id").alias("good"), F.count("*").alias("n")).collect()  # BINS rows at most
    good, n = np.zeros(BINS), np.zeros(BINS)
    for r in counts:
        good[r["bin"]], n[r["bin"]] = r["good"], r["n"]
    table = F.array(*[F.lit(float(v)) for v in isotonic(good, n)])
    score = F.get(table, bin_of)
    return scored.select("doc_id", score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
