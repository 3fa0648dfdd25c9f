"""Each corpus operator on awkward rows, against brute force where it has exact results."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripwire.llm import (
    _graph, chat_format, decontaminate, html_extract, license_scan, near_dedup, quality_classifier, quality_rules, sentencepiece_codec, substring_dedup, toxicity,
)

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, score double, class string, n_chars long, key int"


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "Tu", "re", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    """Nulls, empty and very long texts, copies, near copies, repeated rows and ids, shared passages."""
    rng = random.Random(5)
    base, passage = prose(rng, 120).split(), prose(rng, 45)
    texts = [None, "", " \t\n ", "one", "one two", "One  two", " ".join(base), prose(rng, 20_000)]
    for k in range(60):  # a family of near copies, some far apart
        copy = list(base)
        for _ in range(k % 9):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [f"{prose(rng, 30)}\n{passage}\n{prose(rng, 12)}" for _ in range(12)]
    texts += ["a b c d e f g h i j " * 12, "line here\nline here\n\nline here", "$$$ ### *** " * 10, "ünï cödé 日本 😀 ▁ x"]
    rows = [(i, t, "en", 0.5, "x", len(t or ""), i) for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[9], (None, texts[6], None, None, None, None, None), (None, None, None, None, None, None, None), (7, "another text of id seven", "de", 1.0, "y", 3, 4)]


@pytest.fixture(scope="module")
def documents(spark, awkward):
    return spark.createDataFrame(awkward, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def shingles(text, n):
    w = SPACE.findall(low(text or ""))
    return frozenset([" ".join(w)] if 0 < len(w) < n else [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)])


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_match_brute_force(documents, awkward, n):
    sets = [(row[0], shingles(row[1], n)) for row in awkward]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least: dict = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    expected = Counter((d, len(s), least.get(root(i)) if s else d) for i, (d, s) in enumerate(sets))
    out = near_dedup.near_duplicates(documents, n, 80).collect()
    assert plain(out, "doc_id", "n_shingles", "component_id") == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out if r["component_id"] is not None)


def test_links_of_a_large_bucket_are_found_in_blocks(spark, monkeypatch):
    """More classes than a block holds, whose links don't all go through one pivot."""
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", 7)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):  # a chain: neighbours are similar, the ends are not
        words[rng.randrange(100)] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"w{k}" if (k * 7 + i) % 3 else f"z{i}_{k}" for k in range(100))) for i in range(20)]
    sets = [(d, shingles(t, 4)) for d, t in rows]
    label = {d: d for d, _ in sets}
    for _ in range(len(sets)):
        for d, a in sets:
            for e, b in sets:
                if 100 * len(a & b) >= 80 * len(a | b):
                    label[d] = label[e] = min(label[d], label[e])
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == label


def test_super_minhash_equals_its_definition():
    def slow(values, m):
        ranks = np.full(m, np.inf)
        for x in values:
            order = list(range(m))
            for j in range(m):
                r = int(near_dedup._text.mix(np.array([x], np.uint64) + np.uint64(((j + 1) * 0x9E3779B97F4A7C15) % (1 << 64)))[0])
                k = j + (((r & 0xFFFFFFFF) * (m - j)) >> 32)
                order[j], order[k] = order[k], order[j]
                ranks[order[j]] = min(ranks[order[j]], j + (r >> 32) / 4294967296.0)
        return ranks

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (0, 1, 3, 90, 0, 25)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    fast = near_dedup.super_minhash(bounds, np.concatenate(sets), 24)
    assert np.array_equal(fast, np.array([slow(s, 24) for s in sets]))


def test_keep_representatives_keeps_one_row_of_each_group(documents, nothing):
    kept = near_dedup.keep_representatives(documents)
    assert kept.columns == documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 6 in ids and ids.count(6) == 1 and 0 in ids and 1 in ids
    assert near_dedup.keep_representatives(nothing).count() == 0


def test_unrelated_texts_without_id_or_of_one_id_all_stay(spark):
    rng = random.Random(11)
    texts = [prose(rng, 40) for _ in range(7)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (3, texts[3]), (3, texts[4]), (3, texts[4]), (1, texts[4]), (4, texts[5]), (None, texts[5])]
    rows += [(5, texts[6] + " b"), (5, texts[6] + " a"), (None, " ")]
    kept = near_dedup.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    expected = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (3, texts[3]), (1, texts[4]), (4, texts[5]), (5, texts[6] + " a"), (None, " ")]
    assert plain(kept.collect(), "doc_id", "text") == Counter(expected)


def plans_of(monkeypatch, make):
    """The plans of a near-duplicate result and of the tables stored on the way to it."""
    plans = []

    def seen(df, name, store=near_dedup.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    for module in (near_dedup, _graph):
        monkeypatch.setattr(module, "stored", seen)
    out = make()
    return [*plans, out._jdf.queryExecution().executedPlan().toString()]


def test_keep_representatives_sends_no_side_of_a_join_through_the_driver(documents, monkeypatch):
    """Exploded pairs of bands are judged by the small file they come from: such a side was broadcast."""
    plans = plans_of(monkeypatch, lambda: near_dedup.keep_representatives(documents))
    assert sum("SortMergeJoin" in x for x in plans) >= 10
    assert not [x for x in plans if "Broadcast" in x]


def test_near_duplicates_sends_no_side_of_a_join_through_the_driver(spark, monkeypatch):
    """Nor do those of the classes that meet by pairs of bands."""
    rng, words, rows = random.Random(3), [f"w{i}" for i in range(100)], []
    for i in range(40):
        words[rng.randrange(100)] = f"n{i}"
        rows.append((i, " ".join(words)))
    plans = plans_of(monkeypatch, lambda: near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80))
    assert any("explode(flatten" in x and "SortMergeJoin" in x for x in plans)
    assert not [x for x in plans if "Broadcast" in x]


def brute_cut(rows, window=20):
    order = sorted({(float("inf") if d is None else d, i) for i, (d, *_) in enumerate(rows)})
    first: dict = {}
    for d, i in order:
        w = SPACE.findall(rows[i][1] or "")
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, (d, s)), (d, s))
    out = []
    for d, t, *_ in rows:
        w, key = SPACE.findall(t or ""), float("inf") if d is None else d
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (key, s):
                gone[s : s + window] = [True] * window
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return Counter(out)


def test_repeats_match_brute_force(documents, awkward):
    out = substring_dedup.repeats(documents).collect()
    assert plain(out, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_cut(awkward)


def test_a_window_value_is_sent_once_by_a_task():
    rng = np.random.default_rng(8)
    doc, start = rng.integers(0, 500, 3000), rng.integers(0, 3, 3000).astype(np.uint32)
    value = rng.integers(0, 3, 3000).astype(np.uint64) + np.uint64(1 << 40)
    sent, later = [], set()
    for batch in substring_dedup._settled((value % np.uint64(7)).astype(np.int64), value, doc, start, 7):
        for row in batch.to_pylist():
            if row["kind"] == substring_dedup.PACKED:
                sent += list(zip(*(c.tolist() for c in substring_dedup._unpack(row["body"], np.int64, np.uint32, np.uint64)), strict=True))
            else:
                part = substring_dedup._unpack(row["body"], np.int64, np.uint32, np.uint32)
                assert set(substring_dedup._doc_bucket(part[0], 7).tolist()) == {row["key"]}
                later |= set(zip(*(c.tolist() for c in part), strict=True))
    places = set(zip(doc.tolist(), start.tolist(), value.tolist(), strict=True))
    assert sorted(sent) == sorted(min(p for p in places if p[2] == v) for v in {p[2] for p in places})
    assert later == {(d, s, v & 0xFFFFFFFF) for d, s, v in places - set(sent)}


def test_cut_repeats_keeps_rows_and_columns(documents, nothing):
    out = substring_dedup.cut_repeats(documents)
    assert out.columns == documents.columns and out.count() == documents.count()
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["doc_id"] == 70)
    assert substring_dedup.cut_repeats(nothing).count() == 0 and substring_dedup.repeats(nothing).count() == 0


def test_cut_repeats_equals_the_cut_texts_under_clashing_names(documents):
    """Every row with its own text, whatever its other columns are called; rows without id and of one id included."""
    cut = {(r["rk"], r["doc_id"]): r["kept"] for r in substring_dedup.repeats(documents).collect() if r["n_removed"]}
    keyed = documents.withColumn("rk", F.xxhash64("doc_id", "text"))
    expected = Counter((r["doc_id"], cut.get((r["rk"], r["doc_id"]), r["text"])) for r in keyed.collect())
    clash = documents.select("doc_id", "text", *[F.lit(k).alias(n) for k, n in enumerate(["row", "rk", "kept", "of", "ones", "touched", "id", "__key", "__kept", "a.b"])])
    out = substring_dedup.cut_repeats(clash)
    rows = out.collect()
    assert out.columns == clash.columns and Counter((r["doc_id"], r["text"]) for r in rows) == expected and len(cut) > 5
    assert {tuple(r)[2:] for r in rows} == {tuple(range(10))}


def test_quality_rules_base_matches_brute_force(documents, awkward, nothing):
    def base(text):
        text = text or ""
        w = SPACE.findall(text)
        times = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        places = {k for i in range(len(w) - 4) if times[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
        lines = [x for x in text.split("\n") if SPACE.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places)

    out = quality_rules.score_quality(documents).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert plain(out, "doc_id", *names) == Counter((row[0], *base(row[1])) for row in awkward)
    for r in out:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"]) and r["kept"] in (True, False)
    assert quality_rules.score_quality(nothing).count() == 0
    kept = quality_rules.keep_good(documents)
    assert kept.columns == documents.columns and kept.where("text is null").count() == 0


def test_em_learns_which_votes_mean_bad():
    patterns = [((0, 0, 0), 800), ((1, 0, 0), 60), ((0, 1, 0), 50), ((1, 1, None), 20), ((None, 0, 0), 70)]
    prior, rates = quality_rules.estimate(patterns, 3)
    assert 0.02 < prior < 0.4
    assert quality_rules.posterior((0, 0, 0), prior, rates) > 0.8 > 0.5 > quality_rules.posterior((1, 0, 0), prior, rates)


def test_license_places_match_brute_force(spark, documents, nothing):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, f"x\n{notice}\ny"), (2, "MIT License; the mit-license, gnu general public license"), (3, "Licensed under CC BY-NC 4.0."), (4, None), (5, "apache\nlicense"), (6, "version 2 0 of apache")]
    out = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        w = ALNUM.findall(low(t or ""))
        places = [(i, label) for p, label in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (out[d]["n_words"], out[d]["n_base"]) == (len(w), len(places))
        assert (out[d]["first_word"], out[d]["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert out[d]["base_labels"] == ",".join(sorted({x for _, x in places}))
    assert (out[3]["labels"], out[3]["score"], out[1]["blocks"], out[6]["labels"]) == ("cc-by-nc", 1.0, 1, "")
    assert license_scan.scan_licenses(documents).count() == documents.count() and license_scan.scan_licenses(nothing).count() == 0


def test_wrapped_license_notices_are_found(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following\nconditions are met:"
    lgpl = "# you can redistribute it and/or modify it\n# under the terms of the GNU Lesser General Public\n# License as published"
    mit = "some words before it\nPermission is hereby granted, free of charge, to any person obtaining a\ncopy of this software and associated documentation files (the"
    one_line = "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License\nas published by them"
    apart = "Redistribution and use in source and binary forms\n\nwith or without modification are permitted"
    far = "Redistribution and use in source and binary forms " + "x " * 9 + "\n with or without modification are permitted"
    rows = list(enumerate([bsd, lgpl, mit, one_line, apart, far, f"{bsd}\n\n{bsd}\n\n{mit}"]))
    out = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert [out[i]["labels"] for i in range(7)] == ["bsd", "gpl,lgpl", "mit", "gpl,lgpl", "", "", "bsd,mit"]
    assert [out[i]["blocks"] for i in range(7)] == [1, 1, 1, 1, 0, 0, 3]
    assert out[0]["score"] == 1.0 and out[0]["n_base"] == 0


def test_contaminated_finds_exact_and_near_items_only(spark, documents, nothing):
    rng = random.Random(3)
    item, other = prose(rng, 60), prose(rng, 40)
    near = item.split()
    near[-1] = "changed"
    rows = [(1, f"{prose(rng, 50)} {re.sub("[a-z]", lambda m: m[0].upper(), item)} {prose(rng, 9)}"), (2, " ".join(near)), (3, prose(rng, 80)), (4, " ".join(item.split()[:30])), (5, None), (1, f"{other}."), (None, other)]
    bench = spark.createDataFrame([(10, item, 1.0), (11, other, 2.0), (12, None, 3.0), (13, "two words", 4.0), (11, other, 2.0)], "item_id long, text string, similarity double")
    out = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert plain(out, "doc_id", "item_id") == Counter({(1, 10): 1, (2, 10): 1, (1, 11): 2, (None, 11): 2})
    assert {r["first_word"] for r in out if r["item_id"] == 10} == {50, 0}
    clean = decontaminate.keep_clean(documents, bench)
    assert clean.columns == documents.columns and clean.count() == documents.count()
    assert decontaminate.contaminated(nothing, bench).count() == 0 == decontaminate.contaminated(documents, bench.limit(0)).count()


def test_near_copies_of_repeated_items_are_found_whatever_the_blocks(spark, monkeypatch):
    rng = random.Random(12)
    item, passage = prose(rng, 60), prose(rng, 50)
    bench = [(i, item) for i in range(10)] + [(20 + i, f"{passage} {prose(rng, 10)}") for i in range(10)]
    texts = [item, bench[12][1]]
    for k, t in enumerate(list(texts)):
        words = t.split()
        words[25] = "changed"
        texts[k] = f"{prose(rng, 30)} {' '.join(words)} {prose(rng, 30)}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = [decontaminate.contaminated(docs, items).collect()]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    found.append(decontaminate.contaminated(docs, items).collect())
    assert {(r["doc_id"], r["item_id"]) for r in found[0]} >= {*((0, i) for i in range(10)), (1, 22)}
    assert Counter(found[0]) == Counter(found[1])


def test_every_window_of_an_items_size_is_looked_at(spark):
    rng = random.Random(13)
    x, y, short = prose(rng, 30), prose(rng, 30), prose(rng, 12)
    rows = [(1, f"{prose(rng, 41)} {y} {x} {prose(rng, 50)}"), (2, prose(rng, 90)), (3, f"{x} {prose(rng, 40)} {y}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, f"{x} {y}"), (11, short)], "item_id long, text string")
    out = decontaminate.contaminated(table, items).collect()
    assert [(r["doc_id"], r["item_id"], r["first_word"], r["n_words"]) for r in out] == [(1, 10, 41, 60)]
    assert abs(out[0]["similarity"] - 52 / 60) < 1e-9
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(table, items).collect()) == [2, 3]


def test_rolled_fingerprints_equal_those_of_each_window():
    rng = np.random.default_rng(14)
    words = rng.integers(0, 3, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    starts = np.array([0, 1, 2, 5, 90, 91, 300, 380])
    out = list(decontaminate._windows(words, 20, 5, starts))
    assert [w[0] for w in out] == starts.tolist()
    for start, own, print_ in out:
        distinct = np.unique(decontaminate._text.grams(words[start : start + 20], 5))
        assert own == distinct.tolist() and print_ == decontaminate.fingerprint(distinct)


def test_hamming_blocks_find_everything_within_the_radius():
    rng = random.Random(9)
    index = decontaminate.Index([(i, np.array([rng.getrandbits(64) for _ in range(20)], np.uint64), {rng.getrandbits(63): 1.0}) for i in range(40)])
    index.items, index.prints = [(i, 20, {}) for i in range(40)], [rng.getrandbits(64) for _ in range(40)]
    index.tables = [{} for _ in range(decontaminate.BLOCKS)]
    for n, p in enumerate(index.prints):
        for b in range(decontaminate.BLOCKS):
            index.tables[b].setdefault((20, p >> 4 * b & 15), []).append(n)
    for _ in range(300):
        probe = rng.choice(index.prints)
        for bit in rng.sample(range(64), rng.randrange(34)):
            probe ^= 1 << bit
        assert index.near(20, probe) == {n for n, p in enumerate(index.prints) if (p ^ probe).bit_count() <= decontaminate.RADIUS}


def test_sentencepiece_is_exact_and_offsets_tile_the_text(documents, awkward, nothing):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    out = sentencepiece_codec.encode(documents, path).collect()
    expected = Counter((row[0], tuple(library.encode(row[1] or ""))) for row in awkward)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in out) == expected
    for r in out:
        assert not r["ids"] or r["starts"][0] == 0 and r["starts"][1:] == r["ends"][:-1]
    back = sentencepiece_codec.decode(documents.sparkSession.createDataFrame([(1, [1, 5, 300, 228, 228]), (2, None), (3, library.encode("a  b\n é"))], "doc_id long, ids array<int>"), path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: library.decode([1, 5, 300, 228, 228]), 2: "", 3: "a  b\n é"}
    trip = sentencepiece_codec.round_trip(documents, path).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    ids = [library.encode(row[1] or "") for row in awkward]
    assert plain(trip, "doc_id", "ids_sha256", "decoded_sha256") == Counter((row[0], sha(",".join(map(str, i))), sha(library.decode(i))) for row, i in zip(awkward, ids, strict=True))
    assert all(r["tiled"] for r in trip) and sentencepiece_codec.encode(nothing, path).count() == 0


def test_compiled_character_map_matches_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    codec = object.__new__(sentencepiece_codec.Codec)
    codec.map = sentencepiece_codec.CharMap(proto.normalizer_spec.precompiled_charsmap)
    for codec.prefix, codec.squeeze, codec.escape in ((False, False, False), (True, True, True)):
        library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=codec.prefix, escape_whitespaces=codec.escape, remove_extra_whitespaces=codec.squeeze)
        for text in ["Ｈｅｌｌｏ　①②ﬁ", "ｶﾞ km² ½", "  a​b\tc\n ", "é é ｱ", "plain text"]:
            normal, align = codec.normalise(text)
            assert normal.decode() == library.normalize(text)
            assert len(align) == len(normal) + 1 and (np.diff(align) >= 0).all() and align[-1] <= len(text.encode())


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><aside>side</aside><article><h1>Title &amp; more</h1><p><b>First  line<br>next<p>Second &lt;x&gt;
line<form><p>Your mail</p></form><div class="share-box">Share</div>{extra}<section class=comments><p>Nice</p></section></article><footer>&copy; f</footer>"""


def test_html_main_text(spark):
    rows = [(1, "http://a.org/1", PAGE.format(extra=""), 9), (2, None, None, 9), (3, "x", "", 9), (None, "http://b.org", "<p>only this<!-- open", 9), (4, "http://b.org", "no tags &eacute;", 9), (1, "http://a.org/1", PAGE.format(extra=""), 9)]
    out = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    article = "Title & more\nFirst line next\nSecond <x> line"
    assert plain(out, "page_id", "text", "n_chars") == Counter({(1, article, len(article)): 2, (2, "", 0): 1, (3, "", 0): 1, (None, "only this", 9): 1, (4, "no tags é", 9): 1})


def test_html_templates_are_counted_by_host(spark):
    box = '<div class="frame"><p>Read our guide to everything</p></div>'
    rows = [(i, f"https://T.org:80/{i}", f"<body><div><p>Story number {i}</p></div>{box}</body>") for i in range(8)]
    rows += [(20 + i, "https://copies.org/", f"<body><article><p>Same</p>{box}</article></body>") for i in range(8)]
    out = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3] == "Story number 3" and out[22] == "Same\nRead our guide to everything"
    assert html_extract.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_template_of_a_section_of_a_large_host(spark):
    box = '<div class="frame"><p>Read our guide to everything</p></div>'
    rows = [(i, f"https://large.org/{i}", f"<body><article><p>Story number {i}</p>{box if i % 20 == 0 else ''}</article></body>") for i in range(160)]
    out = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: f"Story number {i}" for i in range(160)}


def page_text(source, templates=frozenset()):
    return html_extract.Page(source, frozenset(templates)).text()


def test_html_keeps_all_of_the_article():
    """All articles, what stands beside them in main, and elements whose class or id only begins like a mark."""
    assert page_text("<body><p>out</p><article><p>one</p></article><div>between</div><article><p>two</p></article></body>") == "one\ntwo"
    assert page_text("<main><h1>Head</h1><p>Lead</p><article><p>Body</p></article><p>End</p></main><p>out</p>") == "Head\nLead\nBody\nEnd"
    assert page_text("<article><p>a</p><article class='comment'><p>reader</p></article><p>b</p></article>") == "a\nb"
    kept = ['<section id="related-work">', '<div class="comment-on-the-law">', '<p class="notice-of-death">', '<div class="adverbs">', '<div id="address">', '<div class="shareholders meeting">']
    for tag in kept:
        name = tag[1:].split()[0]
        assert page_text(f"<article><p>a</p>{tag}x</{name}><p>b</p></article>") == "a\nx\nb", tag
    for tag in ['<section id="comments">', '<div class="comment-list">', '<p class="notice">', '<div class="x ad-slot-1">', '<div class="related posts">', '<div class="cookie-notice">', '<div id="sidebar_left">', '<div class="nav">']:
        name = tag[1:].split()[0]
        assert page_text(f"<article><p>a</p>{tag}x</{name}><p>b</p></article>") == "a\nb", tag


@pytest.mark.parametrize("piece", ["<a b='", '<a b="', "<p ", "<", "<!", "<!--", "</p", "<p>", "<div>", "</div><b>", "<b></i>", "<i>", "&", "<article>", "<header>", "<![CDATA[", "<script", "<li>", "<p><b><br>", "<a b='c' ", "'>\"", "<x y=\"'>", "<table><tr><td>"])
def test_html_is_read_in_linear_time(piece):
    """A megabyte of any malformed piece, with text behind it."""
    import time

    source = f"<article><p>Words before.</p>{piece * (1_000_000 // len(piece))}"
    began = time.process_time()
    text = page_text(source)
    assert time.process_time() - began < 12
    assert text.startswith("Words before.")


def test_html_broken_tags_keep_the_text():
    assert page_text("<p>one <a href='x>two</a> three</p><p>four</p>") == "one two three\nfour"
    assert page_text("<p>one</p><p>two < three <4 <") == "one\ntwo < three <4 <"
    assert page_text('<p title="a > b">one</p><p>two') == "one\ntwo"
    deep = "<div>" * 5000 + "<p>inside</p>" + "</div>" * 5000 + "<p>after</p>"
    assert page_text(f"<body><nav>menu</nav><article>{deep}</article><p>out</p></body>") == "inside\nafter"


def brute_templates(pages):
    """Templates of each host by the definition, over all subtrees of all pages."""
    around: dict = {}
    mains: dict = {}
    for host, source in pages:
        page = html_extract.Page(source)
        mains.setdefault(host, set()).add(page.text())
        low, high = page.main()[0][0], page.main()[-1][1]
        for subtree, first, end, content in page.subtrees:
            if not (first <= low and high <= end and first < end):
                around.setdefault((host, subtree, content), set()).add(page.text())
    return {(host, s) for (host, s, content), texts in around.items() if len(texts) >= 5 and (not content or 2 * len(texts) >= len(mains[host]))}


def test_html_templates_equal_a_direct_count(spark):
    """Planted templates of several kinds and shares, and content that recurs: texts, recall and precision."""
    rng = random.Random(12)
    rows, truth = [], {}
    table = "<table><tr><td>1</td><td>2</td></tr></table>"
    for host, n in (("big.org", 60), ("mid.org", 20), ("few.org", 4)):
        for i in range(n):
            own = [f"{host} paragraph {i} {prose(rng, 8)}" for _ in range(3)]
            body = "".join(f"<p>{p}</p>" for p in own)
            if i % 5 == 0:
                body += table  # the same figures in a fifth of the articles
            parts = [
                "<p>All rights and cookies of this site</p>",  # on every page, in a bare paragraph
                "<div><p>Campaign of the week</p></div>" if i % 6 == 0 else "",  # a box on some pages
                "<ul><li>Send</li><li>Print</li></ul>",
            ]
            rows.append((len(rows), f"http://{host}/{i}", f"<body><article><h1>T{i}</h1>{body}{''.join(parts)}</article></body>"))
            cut = n >= 5
            kept = [f"T{i}", *own] + (["1", "2"] if i % 5 == 0 else [])
            if not cut:
                kept += ["All rights and cookies of this site"]
            if i % 6 == 0 and (n + 5) // 6 < 5:
                kept += ["Campaign of the week"]
            if not cut:
                kept += ["Send", "Print"]
            truth[len(rows) - 1] = "\n".join(kept)
    out = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    found = brute_templates([(u.split("/")[2], h) for _, u, h in rows])
    direct = {i: page_text(h, {s for host, s in found if host == u.split("/")[2]}) for i, u, h in rows}
    assert out == direct
    assert out == truth


def test_chats_keep_maximal_conversations(spark):
    rows = [(1, 0, "user", "a", 1), (1, 1, "assistant", "b", 1), (2, 0, "user", "a", 1), (3, 0, "user", "a", 1), (3, 1, "assistant", "b", 1), (3, 2, "user", "c", 1),
            (4, 0, "user", "z", 1), (5, 0, "user", "z", 1), (6, 0, None, None, 1), (None, 0, "user", "q", 1), (None, 1, "user", "q", 1), (7, 0, "user", "b", 1), (7, 0, "user", "b", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")
    out = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat_format.format_chats(table).collect()}
    assert set(out) == {3, 4, 6, None, 7}
    assert out[3] == (3, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n")
    assert out[6] == (1, "<|im_start|>user\n<|im_end|>\n") and out[7][0] == 2
    assert chat_format.format_chats(table.limit(0)).count() == 0


def fold(n):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@pytest.mark.parametrize("module, label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_classifiers_learn_and_take_awkward_rows(spark, documents, nothing, module, label):
    rng = random.Random(4)
    rows, known = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(rng, 60).split()
        for _ in range(12 if bad else 0):
            words[rng.randrange(60)] = "vile###" if label == "quality" else "vile"
        rows.append((i, " ".join(words)))
        known.append((i, int(bad) if label == "toxic" else int(not bad)))
    known += [(1, None), (5000, 1), (None, 1)]
    labels = spark.createDataFrame(known, f"doc_id long, {label} int")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = module.score_documents(table, labels, fit=fold(3) == 0, calibrate=fold(3) == 1).collect()
    truth = dict(known[:400])
    truth[1] = known[1][1]
    assert len(out) == 400 and sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 392
    mixed = table.union(documents.select("doc_id", "text"))
    scored = module.score_documents(mixed, labels, fit=fold(3) == 0, calibrate=fold(3) == 1).collect()
    assert len(scored) == 400 + documents.count() and all(0.0 <= r["score"] <= 1.0 for r in scored)
    assert {r["score"] for r in module.score_documents(table, labels.limit(0), fit=fold(3) == 0, calibrate=fold(3) == 1).collect()} == {0.5}
    assert module.score_documents(nothing, labels, fit=fold(3) == 0, calibrate=fold(3) == 1).count() == 0


def test_word_ratios_equal_a_direct_count(spark, documents, awkward, monkeypatch):
    """Ratios and features over many chunks and buckets, with awkward rows, ids and labels."""
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", 5000)
    rng = random.Random(6)
    rows = [(i * 1111 - 30_000, prose(rng, rng.randint(0, 80)) + " A-b é9 9") for i in range(60)]
    rows += [(r[0], r[1]) for r in awkward if r[0] is None or r[0] > 7] + [rows[3], rows[4]]
    known = [(i, k % 2) for k, (i, _) in enumerate(rows[:60])] + [(rows[2][0], 1), (rows[2][0], 1), (None, 1), (rows[5][0], None), (rows[5][0], 7), (10**15, 0)]
    fit = {i for k, (i, _) in enumerate(rows[:60]) if k < 40}
    words = [(i, ALNUM.findall(low(t or ""))) for i, t in rows]
    held, seen = Counter(), [Counter(), Counter()]
    for i, w in words:
        held.update(set(w))
        for label in {label for j, label in known if j == i and i in fit and label in (0, 1)}:
            seen[label].update(set(w))
    everything = sum(held.values())

    def log_p(k, w):
        spare = 0.9 * len(seen[k]) + 1
        return np.log((max(seen[k][w] - 0.9, 0) + spare * held[w] / everything) / (sum(seen[k].values()) + 1))

    expected = Counter()
    for i, w in words:
        ratio = [log_p(1, x) - log_p(0, x) for x in w]
        expected[i, round(10 * sum(ratio) / max(len(w), 1), 6)] += 1
    table = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], "doc_id long, text string, chunk string, kind int, of int, toxic int").repartition(5)
    labels = spark.createDataFrame([(i, k, 1) for i, k in known], "doc_id long, toxic int, kind int")
    in_fit = F.col("doc_id").isin(*fit)
    out = toxicity.score_documents(table, labels, fit=in_fit, calibrate=~in_fit).collect()
    got = Counter((r["doc_id"], round(r["llr"], 6)) for r in out)
    assert {k: abs(v) for k, v in (got - expected).items()} == {} and got == expected


def test_ngram_ratios_equal_a_direct_kneser_ney(spark, awkward, monkeypatch):
    """Discounted n-grams, continuation counts of every shorter order, equal shares at the end; over many chunks."""
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", 3000)
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(0, 40)) + "\tA-b é9\n9") for i in range(50)]
    rows += [(r[0] + 100, r[1]) for r in awkward if r[0] is not None and r[0] != 7] + [rows[3], (None, "no id")]
    known = [(i, i % 2) for i in range(40)] + [(2, 1), (2, 1), (None, 1), (5, None), (45, 0), (160, 1)]
    fit = set(range(30)) | {160}
    plainer = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\v\f\r", bytes(range(97, 123)) + b" " * 5)
    texts = [(i, bytes(4) + (t or "").encode().translate(plainer)) for i, t in rows]
    counts = []
    for label in (0, 1):
        of = [Counter() for _ in range(6)]
        for i, t in texts:
            if i in fit and (i, label) in known:
                of[5].update(t[k - 4 : k + 1] for k in range(4, len(t)))
        for order in range(4, 0, -1):
            of[order].update(gram[1:] for gram in of[order + 1])
        after = [Counter() for _ in range(6)], [Counter() for _ in range(6)]
        for order in range(1, 6):
            for gram, n in of[order].items():
                after[0][order][gram[:-1]] += n
                after[1][order][gram[:-1]] += 1
        counts.append((of, *after))

    def p(label, gram):
        if not gram:
            return 1 / 256
        of, total, kinds = (x[len(gram)] for x in counts[label])
        context, less = gram[:-1], p(label, gram[1:])
        return (max(of[gram] - 0.75, 0) + 0.75 * kinds[context] * less) / total[context] if total[context] else less

    expected = Counter()
    for i, t in texts:
        ratio = [np.log(p(1, t[k - 4 : k + 1]) / p(0, t[k - 4 : k + 1])) for k in range(4, len(t))]
        expected[i, round(100 * sum(ratio) / max(len(ratio), 1), 3)] += 1
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    in_fit = F.col("doc_id").isin(*fit)
    out = toxicity.score_documents(table, spark.createDataFrame(known, "doc_id long, toxic int"), fit=in_fit, calibrate=~in_fit).collect()
    got = sorted((r["doc_id"] or -1, r["ngram_llr"]) for r in out)
    wanted = sorted((i or -1, x) for (i, x), n in expected.items() for _ in range(n))
    assert [i for i, _ in got] == [i for i, _ in wanted] and np.allclose([x for _, x in got], [x for _, x in wanted], atol=2e-3)
    assert max(x for _, x in got) > 1 and min(x for _, x in got) < -1


@pytest.mark.parametrize("operator", [sentencepiece_codec.encode, sentencepiece_codec.round_trip])
def test_word_table_goes_with_its_task(operator):
    """Spark's workers live on: what a task has learned of words must not stay in them beside the next stages."""
    import public_tokenizers

    class Table:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    path = public_tokenizers.path("piece_bpe_32k.model")
    codec = sentencepiece_codec._codec(sentencepiece_codec._model(path))
    out = operator(Table(), path)(iter([pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two", "two three"]})] * 2))
    next(out)
    assert codec.by_word and {"one", "two", "three"} <= set(codec.words)
    assert sum(1 for _ in out) == 1 and not codec.words


def test_ngram_probabilities_add_up_to_one():
    rng = np.random.default_rng(5)
    contexts = np.unique(rng.integers(0, 1 << 10, 40)).astype(np.uint64)
    keys = (contexts[:, None] << np.uint64(8) | np.arange(256, dtype=np.uint64)).ravel()
    counts = rng.poisson(0.02, len(keys))
    p = toxicity.kneser_ney(keys, counts, 3, 1, lambda x: np.full(len(x), 1 / 256)).reshape(-1, 256)
    assert np.allclose(p.sum(1), 1) and (p > 0).all()


def test_packed_numbers_come_back():
    rng = np.random.default_rng(3)
    for kind in (np.uint8, np.uint32, np.int64, np.uint64):
        for n in (0, 1, 1000):
            x = rng.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True)
            assert (toxicity._unpack(toxicity._pack(x), kind) == x).all()
            assert (toxicity._unpack_sorted(toxicity._pack_sorted(np.sort(x)), kind) == np.sort(x)).all()


def test_isotonic_pools_violators():
    fitted = quality_classifier.isotonic(np.array([0.0, 3, 1, 0, 4]), np.array([4.0, 4, 4, 0, 4]))
    assert np.allclose(fitted, [0, 0.5, 0.5, 0.75, 1])


def test_pipeline_stages_run_on_awkward_rows(spark, documents, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "a benchmark item of more than five words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == documents.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count() > 5
