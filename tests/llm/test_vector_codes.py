"""Product quantisation against a direct computation."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from tripwire.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, part int, code string, n long"


def brute(rows, parts=16, entries=64, rounds=2):
    """``(vec_id, label, code, error)`` and the codebooks' digest; vectors of one length, all to be coded."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in kept]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, xs in members.items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    out = []
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def expected(rows, **more):
    out, digest = brute(rows, **more)
    sums = defaultdict(int)
    for _, label, _, error in out:
        sums[label] += error
    return Counter((i, code, error, sums[label], digest) for i, label, code, error in out)


def result(spark, rows, **more):
    table = spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in vector_codes.compress(table, **more).collect()]


def some_vectors(n, width, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(7)]
    return [(k * 3, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], k % 4) for k in range(n)]


@pytest.mark.parametrize("block", [4096, 7])
def test_codes_equal_a_direct_computation(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    rows = some_vectors(150, 32)
    assert Counter(result(spark, rows)) == expected(rows)


def test_dropped_repeated_and_null_rows(spark):
    rows = some_vectors(40, 16)
    rows += [rows[3], rows[3], (9, [0.25] * 16, None), (None, [-0.5] * 16, None), (1, None, 2), (2, [None] * 16, 2)]
    rows += [(4, [math.nan] + [0.0] * 15, 1), (5, [math.inf] + [0.0] * 15, 1), (6, [0.0] * 15 + [-math.inf], 1)]
    # ties: many vectors equal, so entries are equal too and the lower index wins
    rows += [(1000 + k, [float(k % 2)] * 16, 0) for k in range(60)]
    out = result(spark, rows)
    assert Counter(out) == expected(rows)
    assert not {1, 2, 4, 5} & {r[0] for r in out}


def test_few_vectors_and_other_parameters(spark):
    rows = some_vectors(5, 12)
    assert Counter(result(spark, rows, parts=3, entries=64)) == expected(rows, parts=3)
    assert Counter(result(spark, rows, parts=4, entries=2, rounds=5)) == expected(rows, parts=4, entries=2, rounds=5)


def test_vectors_that_cannot_be_coded_come_back_without_code(spark):
    rows = some_vectors(20, 16)
    odd = [(7000, [1.0] * 32, 0), (7001, [], 0), (7002, [1e30] + [0.0] * 15, 99), (7003, [-70_000.0] + [0.0] * 15, 0)]
    out = result(spark, rows + odd)
    assert Counter(r for r in out if r[0] < 7000) == expected(rows)
    assert {r[0]: r[1:3] for r in out if r[0] >= 7000} == {k: (None, None) for k in range(7000, 7004)}
    assert {r[3] for r in out if r[0] == 7002} == {None}


def test_no_vectors(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None, 0), (2, [math.nan] * 16, 0)]) == []
    assert [r[:3] for r in result(spark, [(1, [0.5] * 5, 0)])] == [(1, None, None)]
