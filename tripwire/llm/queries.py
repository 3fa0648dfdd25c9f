"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm import (
    chat_format, decontaminate, html_extract, license_scan, near_dedup, quality_classifier, quality_rules, ranked_search, sentencepiece_codec, substring_dedup, toxicity,
    vector_codes, warc,
)
from tripwire.llm._tables import read_table
from tripwire.session import scratch_path

TOKENIZER = "piece_bpe_32k.model"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once an application (Spark serves the file), so that their Python finds it
    wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="tripwire-"), "tripwire_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(top, "tripwire")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, name)


def _fold(n: int) -> Column:
    """crc32 of doc_id as text, modulo n (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fit=_fold(4).isin(0, 1), calibrate=_fold(4) == 3, threshold=0.7
    )
    return out.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fit=_fold(5).isin(2, 3, 4), calibrate=_fold(5) == 1, threshold=0.5
    )
    return out.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted", "llr", "ngram_llr")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(_table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(_table(spark, sf_dir, "conversations"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.salvage_archives(spark, path, scratch_path(spark, "quarantine"), payload=False))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1,
    "op2_sentencepiece": op2,
    "op3_decontamination": op3,
    "op4_toxicity": op4,
    "op5_near_duplicates": op5,
    "op6_html_text": op6,
    "op7_quality_rules": op7,
    "op8_chat_format": op8,
    "op9_license_scan": op9,
    "op10_substring_dedup": op10,
    "op11_vector_codes": op11,
    "op12_warc": op12,
    "op13_ranked_search": op13,
    "pipeline": pipeline,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_TEMPLATES = ", ".join(f"({i}, '{text}', '{label}')" for i, (text, label) in enumerate(license_scan.TEMPLATES))
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

# Product quantisation: parts to their nearest entry, and entries to the floor of their parts' means.
_ASSIGN = """{to} AS (SELECT r, part, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d FROM
      (SELECT r, part, entry, CAST(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM p JOIN {books} USING (part)) GROUP BY r, part)"""
_LEARN = """{to} AS (SELECT part, entry, coalesce(new, e) AS e FROM {books} LEFT JOIN (SELECT part, entry, list(c ORDER BY i) AS new FROM
      (SELECT part, entry, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c FROM
       (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM {rows} JOIN p USING (r, part)) GROUP BY part, entry, i) GROUP BY part, entry) USING (part, entry))"""

ORACLE_SQL: dict[str, str] = {
    "op5_near_duplicates": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS l, b.doc_id AS r, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT l, r FROM p JOIN s a ON a.doc_id = l JOIN s b ON b.doc_id = r WHERE 100 * k >= 80 * (len(a.sh) + len(b.sh) - k)),
both_ways AS (SELECT l, r FROM link UNION SELECT r, l FROM link),
reach AS (SELECT doc_id AS d, doc_id AS c FROM s UNION SELECT reach.d, both_ways.r FROM reach JOIN both_ways ON both_ways.l = reach.c),
comp AS (SELECT d, min(c) AS component_id FROM reach GROUP BY d)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN comp ON comp.d = s.doc_id
""",
    "op8_chat_format": """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
           coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
r AS (SELECT conv_id, place, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '')
        OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS prefix,
      count(*) OVER (PARTITION BY conv_id) AS n FROM t),
whole AS (SELECT min(conv_id) AS conv_id, n, prefix FROM r WHERE place = n GROUP BY n, prefix)
SELECT conv_id, n AS n_turns, prefix AS text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.place < r.n AND r.place = whole.n AND r.prefix = whole.prefix)
""",
    "op9_license_scan": f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, {_ALNUM}) AS ws FROM d),
u AS (SELECT doc_id, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS w1 FROM w),
n AS (SELECT doc_id, i, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3 FROM u WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
hit AS (SELECT doc_id, i, 'mit' AS label FROM n WHERE w1 = 'mit' AND w2 = 'license'
        UNION ALL SELECT doc_id, i, 'apache' FROM n WHERE w1 = 'apache' AND w2 = 'license'
        UNION ALL SELECT doc_id, i, 'gpl' FROM n WHERE w1 = 'general' AND w2 = 'public' AND w3 = 'license'),
tpl AS (SELECT k, list_distinct(string_split(x, ' ')) AS tw, label FROM (VALUES {_TEMPLATES}) v(k, x, label)),
line0 AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS l FROM d),
line AS (SELECT doc_id, l, list_distinct(regexp_extract_all(x, {_ALNUM})) AS lw FROM line0),
met AS (SELECT doc_id, l, k, label, tw, len(list_intersect(lw, tw)) / len(tw) AS share FROM line, tpl
        WHERE len(list_intersect(lw, tw)) >= ceil(round({license_scan.CONTAINMENT} * len(tw), 9))),
best AS (SELECT * FROM met a WHERE NOT EXISTS (SELECT 1 FROM met b WHERE b.doc_id = a.doc_id AND b.l = a.l AND b.k <> a.k
         AND len(b.tw) > len(a.tw) AND len(list_intersect(a.tw, b.tw)) = len(a.tw))),
h AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hit GROUP BY doc_id),
m AS (SELECT doc_id, max(share) AS score, count(DISTINCT l) AS blocks FROM best GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM hit UNION ALL SELECT doc_id, label FROM best) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS DOUBLE) AS score, coalesce(blocks, 0) AS blocks
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN a USING (doc_id)
""",
    "op10_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS x FROM p),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS rn FROM g) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(0, 20) r(k)),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op11_vector_codes": f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] AS x FROM kept, range(16) t(part)),
seed AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM kept QUALIFY entry < 64),
b0 AS (SELECT part, entry, x AS e FROM seed JOIN p USING (r)),
{_ASSIGN.format(to="a0", books="b0")},
{_LEARN.format(to="b1", rows="a0", books="b0")},
{_ASSIGN.format(to="a1", books="b1")},
{_LEARN.format(to="b2", rows="a1", books="b1")},
{_ASSIGN.format(to="a2", books="b2")},
coded AS (SELECT r, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS s FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256 FROM kept JOIN coded USING (r), digest
""",
    "op12_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT page_id, n, h, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
""",
    "op13_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM documents),
total AS (SELECT count(*) FILTER (WHERE len(ws) > 0) AS n_docs, sum(len(ws)) AS n_terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_docs),
c AS (SELECT d.r, doc_id, tf.term, (1000000000 * tf) // (1000 * tf + 12 * (75 + CAST((25 * len(ws) * n_docs) // n_terms AS BIGINT))) AS c
      FROM d JOIN tf USING (r), total),
i AS (SELECT k, item_id, term, count(*) AS times FROM (SELECT row_number() OVER () AS k, item_id,
      unnest(regexp_extract_all({_LOWER}, {_ALNUM})) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
s AS (SELECT k, item_id, r, doc_id, CAST(sum(times * w * c) AS BIGINT) AS score FROM i JOIN w USING (term) JOIN c USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
