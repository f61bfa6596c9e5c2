"""The lake layout: builds written aside, an append-only log naming the build readers use.

A table lives under ``<root>/<table>``. Every build writes its own folder and is then recorded in
the table's log; publishing is one more log row. Readers resolve the newest published row, so they
never see half a build, nothing is renamed (object stores cannot rename a folder atomically), and
a failed or lost run leaves the published data as it was.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismic_lake.session import configure
from seismic_lake.vocab import DQ_SCHEMA, with_year

BUILT, PUBLISHED = "built", "published"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("build_id", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("location", T.StringType()),
        T.StructField("summary", T.StringType()),
    ]
)


class MissingInput(RuntimeError):
    """An input the job cannot run without is not there."""


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """True when a path (or glob) matches at least one file or folder."""
    path = _hadoop_path(spark, pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder."""
    target = _hadoop_path(spark, path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(target).getLength())


@dataclass(frozen=True)
class Build:
    """One recorded build of a table."""

    build_id: str
    at: datetime
    location: str
    summary: dict


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def build_path(self, table: str, build_id: str) -> str:
        return self.path(table, "builds", build_id)

    # --- The log ------------------------------------------------------------------------

    def log(self, table: str) -> DataFrame:
        folder = self.path(table, "log")
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(folder)

    def record(
        self, table: str, event: str, build_id: str, at: datetime, location: str, summary: dict
    ) -> None:
        row = (event, build_id, at, location, json.dumps(summary, sort_keys=True))
        self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").json(
            self.path(table, "log")
        )

    def newest(self, table: str, event: str = PUBLISHED) -> Build | None:
        rows = (
            self.log(table)
            .where(F.col("event") == event)
            .orderBy(F.col("at").desc(), F.col("build_id").desc())
            .limit(1)
            .collect()
        )
        if not rows:
            return None
        r = rows[0]
        return Build(r["build_id"], r["at"].replace(tzinfo=timezone.utc), r["location"], json.loads(r["summary"]))

    def publish(self, table: str, build: Build, at: datetime, row_count: int) -> None:
        """Let readers see a build; its row count becomes the baseline of later audits."""
        self.record(table, PUBLISHED, build.build_id, at, build.location, {"row_count": row_count})

    # --- Reading ------------------------------------------------------------------------

    def read(
        self, table: str, schema: T.StructType | None = None, event: str = PUBLISHED, yearly: bool = True
    ) -> DataFrame | None:
        """The newest build of a table, or None when there is none (or it held no rows).

        With ``schema`` the columns are declared, not inferred. Without, the files speak for
        themselves, which is what the audit wants.
        """
        build = self.newest(table, event)
        if build is None or not path_exists(self.spark, build.location + ("/year=*" if yearly else "")):
            return None
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(with_year(schema) if yearly else schema)
        return reader.parquet(build.location)

    def drop_old_builds(self, table: str, keep: Sequence[str]) -> list[str]:
        """Delete the builds not named in ``keep`` and what they staged. Returns their ids."""
        gone = set()
        for part in ("builds", "staging"):
            if not path_exists(self.spark, self.path(table, part)):
                continue
            folder = _hadoop_path(self.spark, self.path(table, part))
            fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if name not in keep:
                    fs.delete(status.getPath(), True)
                    gone.add(name)
        return sorted(gone)


def write_yearly(df: DataFrame, path: str, time_col: str, extra: Sequence[str] = ()) -> None:
    """Parquet by year, rows clustered by time inside each file.

    Rebalancing on (year, month) keeps a month's rows together and lets AQE merge the tiny early
    decades and split a month that holds much of the table, so no single task writes a hot year
    and file sizes follow the advisory partition size. Sorting then keeps row-group time ranges
    narrow for filter pushdown.
    """
    month = "_month"
    keys = [*extra, "year", month]
    (
        df.withColumn("year", F.year(time_col))
        .withColumn(month, F.month(time_col))
        .hint("rebalance", *[F.col(c) for c in keys])
        .sortWithinPartitions(*extra, "year", time_col)
        .drop(month)
        .write.mode("overwrite")
        .partitionBy(*extra, "year")
        .parquet(path)
    )


def read_dq_history(spark: SparkSession, path: str) -> DataFrame:
    """Audit history with the declared schema; older files lack ``dataset`` and mean 'usgs'."""
    return (
        spark.read.schema(DQ_SCHEMA)
        .option("recursiveFileLookup", True)
        .parquet(path)
        .select(*DQ_SCHEMA.fieldNames())
        .withColumn("ds", F.coalesce("dataset", F.lit("usgs")))
    )


def read_known_issues(spark: SparkSession, path: str | None, valid_checks: Sequence[str]) -> DataFrame:
    """Reviewed exceptions as (check, event_id). Any bad row stops the run.

    An absent file means nothing is acknowledged.
    """
    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], "check string, event_id string")
    columns = ["check", "event_id", "reason", "acknowledged_on"]
    rows = spark.read.schema(", ".join(f"{c} string" for c in columns)).csv(
        path, header=True, escape='"', enforceSchema=False
    )
    rows = rows.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in columns])
    problem = (
        F.when(~F.col("check").isin(*valid_checks), F.concat(F.lit("unknown check "), F.col("check")))
        .when((F.col("event_id") == "") | (F.col("reason") == ""), "event_id and reason are required")
    )
    bad = rows.withColumn("problem", problem).where("problem IS NOT NULL").limit(5).collect()
    if bad:
        listed = "; ".join(f"{r['problem']} ({r['check']!r}, {r['event_id']!r})" for r in bad)
        raise ValueError(f"{path}: {listed}; valid checks are {sorted(valid_checks)}")
    return rows.select("check", "event_id").distinct()
