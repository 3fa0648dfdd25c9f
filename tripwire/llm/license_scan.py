"""Licence notices by an exact set-similarity join of text blocks with templates.

Blocks are the lines of every document, as sets of words, and the windows of a
template's length (and as many words more as it may miss) that go over line
ends, but not over a line without words; templates are the fixed notices below.
A block meets a template when it holds at least
``CONTAINMENT`` of the template's distinct words. All words are put in one
global order, rarest in the corpus first, counted over all documents. A block
that meets a template holds at least one of the template's ``size - need + 1``
rarest words (prefix filter), has ``need`` words or more (length filter), and
at the first common word both still have enough words after it (positional
filter). What passes is verified in full, so no match is missed and none is
approximate.

The corpus is read twice: once to count the templates' words, whose counts are
as many as the templates have words, and once to join. Templates are a fixed
parameter; what the tasks are sent doesn't grow with the data.

Defined results: a null, empty or wordless text has no words, no places and no
labels, and score 0. Rows are independent of each other; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm import _text

# Phrases whose places are counted, and the label of each.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Notices of public licences, and the label that the method gives for each.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under cc by 4 0", "cc-by"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
CONTAINMENT = 0.9


def word_hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    _, _, data, starts = next(_text.slices(pa.array(words), 1 << 30))
    return _text.find_words(data, starts, _text.separators("alnum")).hashes(lower=True)


def _vocabulary(templates: tuple) -> list[str]:
    return sorted({w for text, _ in templates for w in text.split()})


def _count(vocabulary: list[str]):
    """Blocks that hold each word, counted in a task; one row for each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.sort(word_hashes(vocabulary))
        totals = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, data, starts in _text.slices(batch.column(0)):
                words, hashes, line = _blocks(data, starts)
                at = np.searchsorted(known, hashes).clip(0, len(known) - 1)
                found = known[at] == hashes
                pairs = np.unique(line[found] * len(known) + at[found])
                totals += np.bincount(pairs % len(known), minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(known.astype(np.int64)), pa.array(totals)], names=["word", "n"])

    return run


def _blocks(data: np.ndarray, starts: np.ndarray) -> tuple[_text.Words, np.ndarray, np.ndarray]:
    """Words, their hashes and the block of each: lines are numbered through the slice, a document begins a new one."""
    words = _text.find_words(data, starts, _text.separators("alnum"))
    breaks = np.zeros(len(data) + 1, np.int64)
    breaks[1:] = data == 10
    line = np.cumsum(breaks)[words.start] + words.doc
    return words, words.hashes(lower=True), line


class _Join:
    """The templates in the global word order, with an index of their prefixes."""

    def __init__(self, templates: tuple, rank: dict[int, tuple[int, int]], containment: float):
        self.templates, self.widths = [], []
        index: dict[int, list[tuple[int, int]]] = {}
        for t, (text, label) in enumerate(templates):
            words = sorted({int(h) for h in word_hashes(text.split())}, key=rank.__getitem__)
            need = math.ceil(round(containment * len(words), 9))
            self.templates.append((words, need, label))
            self.widths.append(len(text.split()) + len(words) - need)
            for at, w in enumerate(words[: len(words) - need + 1]):
                index.setdefault(w, []).append((t, at))
        self.index = index
        self.rank = rank
        self.prefixes = np.sort(np.array(list(index), np.uint64))

    def block(self, words: np.ndarray) -> Iterator[tuple[frozenset, str, float]]:
        """Words, labels and containments of the templates that a block (its word hashes) meets, the most specific ones."""
        size = len(set(words.tolist()))
        have = sorted((w for w in set(words.tolist()) if w in self.rank), key=self.rank.__getitem__)
        seen, met = set(), []
        for i, w in enumerate(have):
            for t, at in self.index.get(w, ()):
                ordered, need, label = self.templates[t]
                if t in seen or size < need:
                    continue
                seen.add(t)
                # w is the first common word: what follows it on either side bounds the overlap
                if min(len(ordered) - at, len(have) - i) < need:
                    continue
                both = len(set(ordered).intersection(have))
                if both >= need:
                    met.append((frozenset(ordered), label, both / len(ordered)))
        for own, label, share in met:
            if not any(own < other for other, _, _ in met):
                yield own, label, share

    def wrapped(self, words: np.ndarray, at: int) -> Iterator[tuple[int, int, frozenset, str, float]]:
        """``(first, end, words, label, containment)`` of the templates that have the word at this place of a run of
        lines in their prefix and that a window around it meets, the fullest window of each."""
        for t, _ in self.index[int(words[at])]:
            ordered, need, label = self.templates[t]
            own, width = frozenset(ordered), self.widths[t]
            lo = max(0, at - width + 1)
            have = [(lo + i, w) for i, w in enumerate(words[lo : at + width].tolist()) if w in own]
            if len({w for _, w in have}) < need:
                continue
            best, first, inside = (0, 0, 0), 0, Counter()
            for place, w in have:
                inside[w] += 1
                while have[first][0] <= place - width:
                    inside[have[first][1]] -= 1
                    inside -= Counter()
                    first += 1
                best = max(best, (len(inside), -have[first][0], -place))
            if best[0] >= need:
                yield -best[1], 1 - best[2], own, label, best[0] / len(ordered)


def _scan(phrases: tuple, templates: tuple, rank: dict, containment: float):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = _Join(templates, rank, containment)
        wanted = [(word_hashes(p.split()), label) for p, label in phrases]
        for batch in batches:
            for lo, hi, data, starts in _text.slices(batch.column(1)):
                words, hashes, line = _blocks(data, starts)
                n = hi - lo
                counts = np.diff(words.first)
                base = np.zeros(n, np.int64)
                first, last = [None] * n, [None] * n
                base_labels, labels, score, met = ([set() for _ in range(n)], [set() for _ in range(n)], [0.0] * n, [0] * n)
                for phrase, label in wanted:
                    k = len(phrase)
                    at = np.flatnonzero(hashes[k - 1 :] == phrase[-1]) if len(hashes) >= k else np.zeros(0, np.int64)
                    for i in range(k - 1):
                        at = at[hashes[at + i] == phrase[i]]
                    at = at[words.doc[at] == words.doc[at + k - 1]]
                    for place in at.tolist():
                        d = int(words.doc[place])
                        where = place - int(words.first[d])
                        base[d] += 1
                        first[d] = where if first[d] is None else min(first[d], where)
                        last[d] = where if last[d] is None else max(last[d], where)
                        base_labels[d].add(label)
                        labels[d].add(label)
                        score[d] = 1.0
                lines: dict[int, list] = {}
                slot = np.searchsorted(join.prefixes, hashes).clip(0, len(join.prefixes) - 1)
                for b in np.unique(line[join.prefixes[slot] == hashes]).tolist():
                    lo_w, hi_w = np.searchsorted(line, b), np.searchsorted(line, b, "right")
                    d, hit = int(words.doc[lo_w]), False
                    for own, label, share in join.block(hashes[lo_w:hi_w]):
                        labels[d].add(label)
                        score[d], hit = max(score[d], share), True
                        lines.setdefault(d, []).append((int(lo_w), int(hi_w), own))
                    met[d] += hit
                # a line without words, and a document, ends a run of lines
                edges = np.flatnonzero((np.diff(line) > 1) | (np.diff(words.doc) > 0)) + 1
                found: dict[int, set] = {}
                for at in np.flatnonzero(join.prefixes[slot] == hashes).tolist():
                    run = int(np.searchsorted(edges, at, "right"))
                    first_w, end_w = int(edges[run - 1]) if run else 0, int(edges[run]) if run < len(edges) else len(hashes)
                    if line[first_w] != line[end_w - 1]:
                        for a, b, *what in join.wrapped(hashes[first_w:end_w], at - first_w):
                            if line[first_w + a] != line[first_w + b - 1]:
                                found.setdefault(int(words.doc[at]), set()).add((first_w + a, first_w + b, *what))
                for d, hits in found.items():
                    # what a line has met there, or a template with more words, is not met again
                    known, until = [(a, b, own) for a, b, own in lines.get(d, ())], -1
                    over = lambda a, b, own, c, e, other: a < e and c < b and own < other
                    for a, b, own, label, share in sorted(hits, key=lambda h: h[:2]):
                        if any(a < e and c < b and own <= other for c, e, other in known) or any(over(a, b, own, *h[:3]) for h in hits):
                            continue
                        labels[d].add(label)
                        score[d] = max(score[d], share)
                        met[d] += a >= until
                        until = max(until, b)
                columns = [batch.column(0).slice(lo, n), counts, base, first, last, [",".join(sorted(x)) for x in base_labels], [",".join(sorted(x)) for x in labels], score, met]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def scan_licenses(documents: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)`` for each row.

    Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
    characters. ``n_base`` places hold a phrase; ``first_word`` and
    ``last_word`` are their least and greatest word positions. ``labels`` adds
    to ``base_labels`` those of the templates that some block meets;
    ``blocks`` counts these blocks (windows that overlap as one). ``score`` is 1 with a phrase, else the
    largest containment met.
    """
    texts = documents.select("doc_id", "text")
    counted = texts.select("text").mapInArrow(_count(_vocabulary(templates)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # one row for each word of the templates
    rank = {word & (1 << 64) - 1: (n, word) for word, n in counted.collect()}
    for h in word_hashes(_vocabulary(templates)).tolist():
        rank.setdefault(h, (0, h))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks long"
    return texts.mapInArrow(_scan(phrases, templates, rank, containment), schema)
