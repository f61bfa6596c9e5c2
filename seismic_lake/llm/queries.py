"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seismic_lake.llm import (
    bpe,
    decontaminate,
    fingerprints,
    importance,
    license_scan,
    merkle,
    near_dedup,
    packing,
    pii,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
)
from seismic_lake.llm.common import crc32_sql
from seismic_lake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str) -> str:
    """Where a public tokenizer's file is; the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op4_decontaminate"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
        SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, w.item_id FROM places p JOIN windows w USING (n, t)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), 4)


ORACLES["op1_near_dedup"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS m, b.n AS n, count(*) AS k FROM shingles a JOIN shingles b USING (x)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * k >= 80 * (m + n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


ORACLES["op2_license_scan"] = license_scan.oracle()


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


ORACLES["op6_suffix_dedup"] = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 800)) AS m FROM (
    SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM docs WHERE length(h) >= 800)),
again AS (SELECT m FROM starts GROUP BY m HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM starts SEMI JOIN again USING (m)),
steps AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM hits),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM steps) GROUP BY doc_id, r),
kept AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM runs GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
    sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string([
        substr(h, 2 * (CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END) + 1,
            2 * ((CASE WHEN k = n + 1 THEN length(h) // 2 ELSE starts[k] END) - (CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END)))
        for k in range(1, n + 2)], '') END)) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


@query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_importance"] = rf"""
WITH texts AS (
    SELECT TRUE AS own, doc_id, row_number() OVER () AS r, text FROM documents
    UNION ALL SELECT FALSE, NULL, -row_number() OVER (), text FROM benchmark),
words AS (
    SELECT own, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
hashed AS MATERIALIZED (SELECT w, {crc32_sql("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM words)),
found AS (SELECT own, r, bucket FROM words JOIN hashed USING (w)),
counts AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM found GROUP BY bucket),
sums AS (SELECT sum(s)::DOUBLE AS n_s, sum(t)::DOUBLE AS n_t FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (n_s + 10000) / ((s + 1)::DOUBLE * (n_t + 10000))))::BIGINT AS gain FROM counts, sums),
weights AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE own GROUP BY r),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM texts LEFT JOIN weights USING (r) WHERE own),
places AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n_long FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n_long * 10 // 100 THEN place END AS rank FROM places
"""


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


ORACLES["op13_merkle"] = f"""
WITH RECURSIVE texts AS (
    SELECT *, coalesce({crc32_sql("doc_id::VARCHAR")} % 3 = 0, FALSE) AS tampered FROM documents),
given AS (
    SELECT doc_id, lang, concat(
        coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
        coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head, text,
        CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed FROM texts),
leaves AS (
    SELECT doc_id, lang, leaf, claim, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
    FROM (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(octet_length(encode(claimed)) || ':' || claimed, '-')) AS claim FROM given)),
nodes AS (
    SELECT 0 AS depth, lang, i, n, leaf AS h FROM leaves
    UNION ALL
    SELECT depth + 1, lang, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY depth, lang, i // 8, n),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
    SELECT 0 AS depth, i, n, h FROM subroots
    UNION ALL
    SELECT depth + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY depth, i // 8, n),
sides AS MATERIALIZED (
    SELECT a.depth, a.lang, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
    FROM nodes a JOIN nodes b ON a.depth = b.depth AND a.lang IS NOT DISTINCT FROM b.lang AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL),
top_sides AS MATERIALIZED (
    SELECT a.depth, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
    FROM tops a JOIN tops b ON a.depth = b.depth AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL),
up AS (
    SELECT doc_id, lang, leaf, i AS j, 0 AS depth, i, claim AS h, '' AS proof FROM leaves
    UNION ALL
    SELECT doc_id, u.lang, leaf, j, u.depth + 1, u.i // 8, sha256(l || h || r), proof || l || r
    FROM up u JOIN sides s ON s.depth = u.depth AND s.lang IS NOT DISTINCT FROM u.lang AND s.i = u.i),
at_top AS (
    SELECT doc_id, u.lang, leaf, j, s.h AS subroot, 0 AS depth, s.i, u.h, proof
    FROM (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY lang, j ORDER BY depth DESC) = 1) u JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.lang
    UNION ALL
    SELECT doc_id, lang, leaf, j, subroot, u.depth + 1, u.i // 8, sha256(l || h || r), proof || l || r FROM at_top u JOIN top_sides s ON s.depth = u.depth AND s.i = u.i)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM (SELECT * FROM at_top QUALIFY row_number() OVER (PARTITION BY lang, j ORDER BY depth DESC) = 1), (SELECT h AS root FROM tops WHERE n = 1)
"""
