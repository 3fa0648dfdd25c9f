"""WARC archives: exact round trips, and damage of every kind."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from collections import Counter

import pytest

from tripwire.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload int, first string"
LONG = "<p>" + "long enough to be revisited " * 9 + "</p>"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], SCHEMA).repartition(3)


def expected(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    out = Counter()
    for i, b in data:
        ids = [j for j, c in data if c == b and j is not None]
        first = min(ids) if len(b) >= 100 and ids and i != min(ids) else None
        out[i, len(b), hashlib.sha256(b).hexdigest(), "response" if first is None else "revisit", first] += 1
    return out


ROWS = [
    (3, "http://a.b/", LONG), (1, "http://a.b/ü?x=1 2\n", LONG), (2, None, LONG), (1, "http://c/", LONG), (None, "http://n/", LONG),
    (4, "http://d/", None), (5, "http://e/", ""), (6, "http://f/", "x" * 99), (7, "http://f/", "x" * 99), (8, "h", "x" * 100), (9, "h", "x" * 100),
    (10, "q", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\x1f\u008b\b" * 5), (-11, "z", "é😀" * 40_000),
    (None, "n", "null id " * 30), (None, "n", "null id " * 30), (12, "r", "once"), (12, "r", "once"),
]


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, scratch, compress):
    path = f"{scratch}/w"
    warc.write_archives(pages(spark, ROWS), path, compress, archive_records=2)
    entries = warc.read_archives(spark, path).collect()
    assert not [e for e in entries if e["gap"]]
    found = warc.salvage_archives(spark, path, f"{scratch}/log")
    out = [tuple(r) for r in warc.page_records(found).collect()]
    assert Counter(out) == expected(ROWS)
    assert spark.read.parquet(f"{scratch}/log").count() == 0
    whole = warc.resolve(found).select("record_id", "payload", "digest").collect()
    assert len(whole) == len(ROWS) and all(hashlib.sha256(r["payload"]).hexdigest() == r["digest"] for r in whole)
    assert {r["target"] for r in found.collect()} >= {"http://a.b/ü?x=1%202%0A", None}


def test_no_pages(spark, scratch):
    warc.write_archives(pages(spark, []), f"{scratch}/w")
    assert warc.read_archives(spark, f"{scratch}/w").count() == 0


def one(k: int, payload: bytes, compress: bool) -> bytes:
    record = warc._record(str(k), "u", None, hashlib.sha256(payload).hexdigest(), payload, len(payload), "2020-01-01T00:00:00Z") + warc.END
    return gzip.compress(record) if compress else record


def parts(compress, n=9, seed=1):
    rng = random.Random(seed)
    return [one(k, " ".join(rng.choice(["WARC/1.1", "a", "bb", "\r\n", "é"]) for _ in range(400)).encode(), compress) for k in range(n)]


def read(data: bytes):
    """Numbers of the records found, and the gaps; places and sizes must cover the archive once."""
    found, gaps, place = [], [], 0
    for at, size, reason, records in warc.salvage(data):
        assert at == place
        place += size
        if reason:
            gaps.append((at, size))
        found += [int(r.head["warc-record-id"].split(":")[2]) for r in records]
    assert place == len(data)
    return found, gaps


@pytest.mark.parametrize("compress", [True, False])
def test_every_kind_of_damage_costs_its_own_record(compress):
    good = parts(compress)
    starts = [sum(map(len, good[:k])) for k in range(len(good) + 1)]
    assert read(b"".join(good)) == (list(range(9)), [])
    for k in (0, 4, 8):
        others = [i for i in range(9) if i != k]
        size = len(good[k])
        half = size // 2
        flipped = good[k][:half] + bytes([good[k][half] ^ 0x55]) + good[k][half + 1 :]
        for bad in (flipped, good[k][:half], good[k][half:], bytes(size), b"WARC/1.1\r\n" + b"x" * 50, good[k][:-5], b"\x1f\x8b\x08" * 20):
            found, gaps = read(b"".join([*good[:k], bad, *good[k + 1 :]]))
            assert found == others, (k, bad[:20])
            assert gaps == [(starts[k], len(bad))]
        # bytes between records, and a record twice
        assert read(b"".join([*good[:k], b"\0junk\n", *good[k:]])) == (list(range(9)), [(starts[k], 6)])
        assert read(b"".join([*good[: k + 1], *good[k:]]))[0] == sorted([*range(9), k])


def test_a_wrong_length_does_not_swallow_the_next_record():
    good = parts(False, 4)
    for change in (b"Content-Length: 999999999", b"Content-Length: 1", b"Content-Length: x", b"Content-Length: " + b"9" * 400):
        at = good[1].rfind(b"Content-Length", 0, good[1].find(b"HTTP/1.1"))
        bad = good[1][:at] + change + good[1][good[1].find(b"\r\n", at) :]
        assert read(good[0] + bad + good[2] + good[3])[0] == [0, 2, 3]


def test_random_damage_never_loses_an_untouched_record():
    rng = random.Random(9)
    for trial in range(60):
        good = parts(trial % 2 == 0, 8, trial)
        k = rng.randrange(8)
        at = rng.randrange(len(good[k]))
        bad = bytearray(good[k])
        bad[at : at + rng.randint(1, 30)] = rng.randbytes(rng.randint(0, 40))
        found, _ = read(b"".join([*good[:k], bytes(bad), *good[k + 1 :]]))
        assert [i for i in found if i != k] == [i for i in range(8) if i != k]


def test_other_writers_archives():
    plain = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    folded = b"WARC/1.0\r\nwarc-type:\r\n response\r\nContent-Length:0\r\n\r\n\r\n\r\n"
    whole = gzip.compress(plain + folded)  # two records in one member
    out = list(warc.salvage(whole + plain + gzip.compress(b"") + zlib.compress(b"x")))
    assert [[r.head.get("warc-type", "").strip() for r in records] for *_, records in out] == [["warcinfo", "response"], ["warcinfo"], []][: len(out)] + [[]] * (len(out) - 3)
    assert out[-1][2]  # the last bytes are no member
    assert list(warc.salvage(b"")) == []
    assert [x[2] is None for x in warc.salvage(b"not an archive")] == [False]
    assert [x[2] is None for x in warc.salvage(_bomb())] == [False]


def _bomb():
    return gzip.compress(b"\0" * 50_000_000)


def test_gaps_are_logged_with_their_archive(spark, scratch):
    import os

    os.mkdir(f"{scratch}/w")
    good = parts(True)
    for name, k in (("a", 2), ("b", 5)):
        with open(f"{scratch}/w/{name}.warc.gz", "wb") as f:
            f.write(b"".join([*good[:k], good[k][:40], *good[k + 1 :]]))
    open(f"{scratch}/w/empty.warc.gz", "wb").close()
    found = warc.salvage_archives(spark, f"{scratch}/w", f"{scratch}/log")
    assert found.count() == 16
    log = spark.read.parquet(f"{scratch}/log").collect()
    assert sorted((r["archive"].rsplit("/", 1)[1], r["at"], r["size"]) for r in log) == [
        ("a.warc.gz", sum(map(len, good[:2])), 40), ("b.warc.gz", sum(map(len, good[:5])), 40)]
    assert all(r["reason"] for r in log)
