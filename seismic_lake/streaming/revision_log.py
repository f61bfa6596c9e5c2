"""Incremental loading as streams that run until the available files are used up.

The stream appends each micro-batch's newest revisions to a log of revisions; the newest revision
over the log is the current table. Batches may be retried after a failure: every batch of a query owns
one folder and overwriting it again gives the same content, so nothing is lost or doubled. A query
with a new checkpoint has another id, so it adds to an older log and overwrites none of it. Rows
without a key are no revision; each batch records how many it had.

:func:`compact` folds the finished batches into a base of one row a key, and one more log row makes it the base that
readers start from. From then on only the base and the batches after it are read, so reading costs as much as there
are keys and new batches, however many batches there ever were.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seismic_lake.operators.revisions import event_order, latest_by
from seismic_lake.sources.lake import _hadoop_path, path_exists
from seismic_lake.sources.raw_events import type_events
from seismic_lake.vocab import FEED_SCHEMA, RAW_EVENT_SCHEMA


def raw_event_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New raw event files as they arrive in the run folders."""
    return (
        spark.readStream.schema(RAW_EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .parquet(folder)
    )


def feed_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New feed snapshots; the run folder in the file path names the snapshot."""
    return (
        spark.readStream.schema(FEED_SCHEMA)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .json(folder)
        .withColumn("snapshot", F.regexp_extract(F.col("_metadata.file_path"), r"run_id=([^/]+)/", 1))
    )


def log_revisions(
    stream: DataFrame,
    log_folder: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[Column],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Append the newest revision per key of every micro-batch to the log, then stop."""

    def append(batch: DataFrame, batch_id: int) -> None:
        # The id is kept in the checkpoint: the same for a restarted query, another for a new one.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = prepare(batch)
        place = f"query={query}/batch={batch_id}"
        latest_by(rows, keys, order).write.mode("overwrite").parquet(f"{log_folder}/revisions/{place}")
        lacking = F.count_if(reduce(or_, [F.col(k).isNull() for k in keys]))
        rows.agg(lacking.alias("rejected")).write.mode("overwrite").parquet(f"{log_folder}/rejects/{place}")

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@dataclass(frozen=True)
class Base:
    """What :func:`compact` made: where it is, the last batch of each query that is in it, and the rejects of those batches."""

    number: int
    location: str | None
    upto: dict[str, int]
    rejected: int


BASE_SCHEMA = "number bigint, location string, upto string, rejected bigint"


def newest_base(spark: SparkSession, log_folder: str) -> Base:
    folder = f"{log_folder}/base/log"
    if path_exists(spark, folder):
        found = spark.read.schema(BASE_SCHEMA).json(folder).orderBy(F.col("number").desc()).limit(1).collect()
        if found:
            return Base(found[0]["number"], found[0]["location"], json.loads(found[0]["upto"]), found[0]["rejected"])
    return Base(0, None, {}, 0)


def _batches(spark: SparkSession, folder: str) -> list[tuple[str, int, str]]:
    """(query, batch, path) of the batches whose files are complete."""
    if not path_exists(spark, folder):
        return []
    fs = _hadoop_path(spark, folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for done in fs.globStatus(_hadoop_path(spark, f"{folder}/query=*/batch=*/_SUCCESS")) or []:
        batch = done.getPath().getParent()
        query = batch.getParent().getName().removeprefix("query=")
        found.append((query, int(batch.getName().removeprefix("batch=")), batch.toString()))
    return sorted(found)


def _open(spark: SparkSession, folder: str, base: Base) -> list[str]:
    return [path for query, batch, path in _batches(spark, folder) if batch > base.upto.get(query, -1)]


def _revisions(spark: SparkSession, log_folder: str, logged: T.StructType, base: Base, paths: list[str]) -> DataFrame:
    every = [base.location] * (base.location is not None) + paths
    return spark.read.schema(logged).parquet(*every) if every else spark.createDataFrame([], logged)


def _logged(schema: T.StructType, also: str) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructType.fromDDL(also).fields if also else [])])


def current(
    spark: SparkSession, log_folder: str, schema: T.StructType, keys: Sequence[str], order: Sequence[Column], also: str = ""
) -> DataFrame:
    """Newest revision per key over the base and the batches after it; ``also`` names logged columns that only the order reads."""
    base = newest_base(spark, log_folder)
    log = _revisions(spark, log_folder, _logged(schema, also), base, _open(spark, f"{log_folder}/revisions", base))
    return latest_by(log, keys, order).select(*schema.fieldNames())


def rejected(spark: SparkSession, log_folder: str) -> int:
    """Rows without a key over the whole log."""
    base = newest_base(spark, log_folder)
    return base.rejected + _rejected_in(spark, _open(spark, f"{log_folder}/rejects", base))


def _rejected_in(spark: SparkSession, paths: list[str]) -> int:
    if not paths:
        return 0
    return spark.read.schema("rejected bigint").parquet(*paths).agg(F.coalesce(F.sum("rejected"), F.lit(0))).first()[0]


def compact(
    spark: SparkSession, log_folder: str, schema: T.StructType, keys: Sequence[str], order: Sequence[Column], also: str = ""
) -> Base:
    """Fold the base and the finished batches into a new base; ``order`` must decide between any two revisions of a key.

    A query runs its batches one after another, so its finished ones are all those up to the last. A batch that is run
    again after it was folded in (its query stopped between writing and noting it) is not read twice. The
    base before and the batches in the new one are no longer read; :func:`drop_folded` deletes them.
    """
    before = newest_base(spark, log_folder)
    # Rejects are written after the revisions, so a batch with rejects is whole.
    whole = {(query, batch) for query, batch, _ in _batches(spark, f"{log_folder}/rejects")}
    upto = dict(before.upto)
    for query, batch in whole:
        upto[query] = max(upto.get(query, -1), batch)

    def new(folder: str) -> list[str]:
        every = _batches(spark, f"{log_folder}/{folder}")
        return [p for q, b, p in every if before.upto.get(q, -1) < b and (q, b) in whole]

    number = max(before.number + 1, time.time_ns())
    location = f"{log_folder}/base/builds/{number}"
    revisions = _revisions(spark, log_folder, _logged(schema, also), before, new("revisions"))
    latest_by(revisions, keys, order).write.parquet(location)
    base = Base(number, location, upto, before.rejected + _rejected_in(spark, new("rejects")))
    row = (base.number, base.location, json.dumps(base.upto, sort_keys=True), base.rejected)
    spark.createDataFrame([row], BASE_SCHEMA).coalesce(1).write.mode("append").json(f"{log_folder}/base/log")
    return base


def drop_folded(spark: SparkSession, log_folder: str) -> int:
    """Delete the batches that the newest base holds, and older bases; returns how many folders. For when no reader is at them."""
    base = newest_base(spark, log_folder)
    folded = [p for part in ("revisions", "rejects") for q, b, p in _batches(spark, f"{log_folder}/{part}") if b <= base.upto.get(q, -1)]
    fs = _hadoop_path(spark, log_folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    builds = fs.globStatus(_hadoop_path(spark, f"{log_folder}/base/builds/*")) or []
    folded += [b.getPath().toString() for b in builds if int(b.getPath().getName()) < base.number]
    for path in folded:
        fs.delete(_hadoop_path(spark, path), True)
    return len(folded)


def stream_events(spark: SparkSession, raw_folder: str, log_folder: str, checkpoint: str) -> StreamingQuery:
    """Raw event files into the log of typed revisions."""
    return log_revisions(
        raw_event_stream(spark, raw_folder),
        log_folder,
        checkpoint,
        ["event_id"],
        event_order(),
        type_events,
    )
