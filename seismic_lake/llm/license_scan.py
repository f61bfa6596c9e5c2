"""Licence scan of documents by ordered signature rules, in DataFrame functions alone.

Texts become lower-case words parted by single spaces. A text that has none of the gate's keywords is
done. Elsewhere, each word that begins a rule (the keyword) is tried with that keyword's rules on the words
after it; of the rules that fire at a word, the one of highest priority, then the longest match, is kept.
A detection inside another's interval, of no lower priority, is suppressed. Matches are at most MAX_WORDS
long, so only that many detections before one can contain it. The base phrases are found the same
way but never suppressed.

One projection over the rows: nothing is shuffled. NULL and empty texts have no words, no labels and score 0;
repeated rows are scanned each by itself; other columns are not looked at.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismic_lake.llm.license_rules import GATE, MAX_WORDS, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The contract's phrases and labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

RULE_TYPE = "map<string,array<struct<pattern:string,label:string,priority:int,confidence:double>>>"


def _rules() -> Column:
    by_first: dict[str, list[dict]] = {}
    for r in rules():
        entry = {"pattern": f"^(?:{r.pattern})(?= |$)", "label": r.label, "priority": r.priority, "confidence": r.confidence}
        by_first.setdefault(r.first, []).append(entry)
    return F.from_json(F.lit(json.dumps(by_first)), RULE_TYPE)


def _places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase stands."""
    parts = phrase.split()
    here = lambda i: F.get(words, i) == parts[0]
    rest = lambda i: [F.get(words, i + k) == p for k, p in enumerate(parts) if k]

    def stands(i: Column) -> Column:
        out = here(i)
        for test in rest(i):
            out = out & F.coalesce(test, F.lit(False))
        return out

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, words, base places and labels, labels of all detections, and the score."""
    none = F.array().cast("array<string>")
    texts = documents.select("doc_id", F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("low"))
    normal = texts.select("doc_id", F.trim(F.regexp_replace("low", NO_WORD, " ")).alias("norm"))
    split = normal.select(
        "doc_id",
        F.when(F.col("norm") == "", 0).otherwise(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        F.when(F.col("norm").rlike(GATE), F.split("norm", " ")).otherwise(none).alias("words"),
    )
    words = F.col("words")
    keyed = split.withColumn("rules", F.when(F.size(words) > 0, _rules()))
    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.map_contains_key("rules", F.get(words, i)))
    tails = F.transform(starts, lambda i: F.struct(i.alias("i"), F.array_join(F.slice(words, i + 2, F.lit(MAX_WORDS)), " ").alias("tail")))

    def fired(at: Column) -> Column:
        """The best detection at a place, or NULL."""

        def match(rule: Column) -> Column:
            text = F.regexp_substr(at["tail"], rule["pattern"])
            return F.struct(
                rule["priority"].alias("priority"),
                (at["i"] + 2 + F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).alias("end"),
                rule["label"].alias("label"),
                rule["confidence"].alias("confidence"),
                at["i"].alias("start"),
            )

        found = F.transform(F.element_at("rules", F.get(words, at["i"])), match)
        return F.array_max(F.filter(found, lambda d: d["end"].isNotNull()))

    gated = F.size(words) > 0
    found = keyed.select(
        "doc_id",
        "n_words",
        *[F.when(gated, _places(words, phrase)).otherwise(F.array().cast("array<int>")).alias(label) for phrase, label in BASE],
        F.when(gated, F.filter(F.transform(tails, fired), lambda d: d.isNotNull())).alias("all"),
    )
    kept = found.withColumn(
        "detections",
        F.filter(
            "all",
            lambda d, k: ~F.exists(
                F.slice("all", F.greatest(k - MAX_WORDS, F.lit(0)) + 1, F.least(k, F.lit(MAX_WORDS))),
                lambda e: (e["end"] >= d["end"]) & (e["priority"] >= d["priority"]),
            ),
        ),
    )
    places = F.concat(*[F.col(label) for _, label in BASE])
    base = F.array_compact(F.array(*[F.when(F.size(label) > 0, label) for _, label in BASE]))
    all_labels = F.array_sort(F.array_distinct(F.concat(base, F.coalesce(F.transform("detections", lambda d: d["label"]), none))))
    score = F.greatest(
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)),
        F.when(F.size(places) > 0, 0.8).otherwise(0.0),
    )
    return kept.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        score.alias("score"),
    )


def oracle() -> str:
    """The same result in another dialect of SQL: rules as rows, suppression as an anti join."""
    values = ",\n".join(
        "('{}', '{}', '{}', {}, {})".format(r.first, f"^({r.pattern})( |$)".replace("'", "''"), r.label, r.priority, r.confidence) for r in rules()
    )
    phrases = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in BASE)
    return rf"""
WITH rules(first, pattern, label, priority, confidence) AS (VALUES {values}),
phrases(phrase, n, label) AS (VALUES {phrases}),
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
base AS (SELECT doc_id, i - 1 AS start, label FROM places JOIN phrases ON array_to_string(w[i:i + n - 1], ' ') = phrase),
fired AS (
    SELECT doc_id, i, label, priority, confidence, regexp_extract(tail, pattern, 1) AS t FROM (
        SELECT doc_id, i, w[i] AS first, array_to_string(w[i + 1:i + {MAX_WORDS}], ' ') AS tail FROM places WHERE w[i] IN (SELECT first FROM rules))
    JOIN rules USING (first) WHERE regexp_matches(tail, pattern)),
ends AS (SELECT *, i + 1 + length(t) - length(replace(t, ' ', '')) AS stop FROM fired),
best AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY priority DESC, stop DESC, label DESC, confidence DESC) = 1),
kept AS (SELECT * FROM best d WHERE NOT EXISTS (
    SELECT 1 FROM best e WHERE e.doc_id = d.doc_id AND e.i < d.i AND e.stop >= d.stop AND e.priority >= d.priority)),
b AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM kept) GROUP BY doc_id),
s AS (SELECT doc_id, max(confidence) AS top FROM kept GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    greatest(coalesce(top, 0), CASE WHEN n_base > 0 THEN 0.8 ELSE 0 END)::DOUBLE AS score
FROM docs LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""
