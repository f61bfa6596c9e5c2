"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

A text's shingles of five words are hashed once; the top seven bits of a hash choose one of 128 bins, and a
bin keeps its least hash. The last value of each bin is sorted in with the hashes, so every bin begins somewhere
and is empty if that value is its least one (a hash of that value counts as none). An empty bin takes the value of a full one drawn by a hash of both bin numbers
(the first full bin along a random order of its own: optimal densification). The lowest eight bits of the bins, packed, are
the fingerprint. Two fingerprints agree in a bin with chance J + (1 - J) / 256 for likeness J, which the
estimate corrects for.

Words are the runs without white space, A-Z lower-cased; a text with fewer than five words is one shingle
of them all. NULL is read as empty: no words, no full bin, an empty fingerprint; two empty ones are alike (1), an
empty and a full one are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seismic_lake.llm.common import id_bucket, tasks

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


REST = (1 << (64 - BIN_BITS)) - 1
LAST = [((b - BINS // 2) << (64 - BIN_BITS)) + REST for b in range(BINS)]  # of each bin, in the order of signed numbers


def _bin(value: Column) -> Column:
    return F.shiftright(value, 64 - BIN_BITS)


def _full(value: Column) -> Column:
    return value.bitwiseAND(F.lit(REST)) != REST


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: the low bits of each bin, or an empty array for a text without words."""
    found = F.filter(F.split(F.translate(F.col(text), UPPER, LOWER), BLANK), lambda w: w != "")
    df = df.withColumn("_words", found)
    words = F.col("_words")
    hashes = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]),
    )
    # Each column below is used more than once by the next: Spark then keeps it a column of its own. One that is used
    # once inside a lambda would be computed anew for each element.
    hashes = F.when(F.size(words) > 0, F.concat(hashes, F.array(*[F.lit(v) for v in LAST])))
    df = df.withColumn("_hashes", F.sort_array(hashes))
    least = F.filter("_hashes", lambda h, i: (i == 0) | (_bin(h) != _bin(F.get("_hashes", i - 1))))
    df = df.withColumn("_least", least)  # of each bin
    df = df.withColumn("_some", F.filter("_least", _full))

    def drawn(b: Column) -> Column:
        return F.array_min(F.transform("_some", lambda h: F.struct(F.xxhash64(b, _bin(h)).alias("o"), h.alias("h"))))["h"]

    bins = F.when(F.size("_some") == BINS, F.col("_least"))
    bins = bins.otherwise(F.transform("_least", lambda h, b: F.when(_full(h), h).otherwise(drawn(b))))
    low = F.transform(bins, lambda h: h.bitwiseAND((1 << LOW_BITS) - 1).cast("smallint"))
    df = df.withColumn(name, F.when(F.col("_least").isNotNull(), low).otherwise(F.array().cast("array<smallint>")))
    return df.drop("_words", "_hashes", "_least", "_some")


def packed(signature: Column) -> Column:
    """Fingerprint as text: two hexadecimal digits for each bin."""
    return F.lower(F.array_join(F.transform(signature, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, s: n + s)
    chance = 2.0**-LOW_BITS
    corrected = F.greatest((same / BINS - chance) / (1 - chance), F.lit(0.0))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), corrected).otherwise(((F.size(a) == 0) & (F.size(b) == 0)).cast("double"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>``: the value in the row that follows by (doc_id, text); the first row follows the last.

    Rows are dealt to ranges of ids, so the order needs no single task; the last row of a range takes the
    first of the next range, of which there is one row each.
    """
    ranged = docs.withColumn("_range", id_bucket(docs, "doc_id", 4 * tasks(docs.sparkSession)))
    inside = W.partitionBy("_range").orderBy(F.col("doc_id").asc_nulls_first(), F.col("text"))
    rows = ranged.withColumns({f"_{c}": F.lead(c).over(inside) for c in columns}).withColumn("_last", F.lead(F.lit(False), 1, True).over(inside))
    # A number for each range, so that the few first rows are read by their ids.
    firsts = [r["first_id"] for r in ranged.groupBy("_range").agg(F.min("doc_id").alias("first_id")).collect()]
    heads = ranged.where(F.col("doc_id").isin([i for i in firsts if i is not None]) | F.col("doc_id").isNull())
    heads = heads.withColumn("_place", F.row_number().over(inside)).where("_place = 1")
    heads = heads.select("_range", *[F.col(c).alias(f"_head_{c}") for c in columns])
    around = W.orderBy("_range")  # a row for each range
    opening = around.rowsBetween(W.unboundedPreceding, W.currentRow)
    heads = heads.select("_range", *[F.coalesce(F.lead(c).over(around), F.first(c).over(opening)).alias(c) for c in heads.columns[1:]])
    joined = rows.join(heads, "_range")
    following = [F.when(F.col("_last"), F.col(f"_head_{c}")).otherwise(F.col(f"_{c}")).alias(f"next_{c}") for c in columns]
    return joined.select(*docs.columns, *following)


def fingerprint(documents: DataFrame) -> DataFrame:
    """Fingerprints of each row's text, of the text with its last quarter exchanged, and their likeness."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = with_next(with_signature(docs, "text", "sig"), ["text", "sig"])
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring("next_text", F.lit(1), quarter))
    docs = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sig", "next_sig", edited.alias("edited"))
    docs = with_signature(docs, "edited", "edited_sig")
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        packed(F.col("sig")).alias("fingerprint"),
        packed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
