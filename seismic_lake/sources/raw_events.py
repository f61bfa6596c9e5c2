"""Raw event downloads: every column text, one folder per run, duplicates kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismic_lake.functions.text import typed
from seismic_lake.sources.lake import MissingInput, path_exists
from seismic_lake.vocab import RAW_EVENT_COLUMNS, RAW_EVENT_SCHEMA


def read_raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """All runs as one table. Columns a file lacks are NULL, columns not declared are ignored."""
    if not path_exists(spark, f"{folder}/*/*.parquet"):
        raise MissingInput(f"no raw event files under {folder}; load the raw layer first")
    return spark.read.schema(RAW_EVENT_SCHEMA).parquet(folder).select(*RAW_EVENT_SCHEMA.fieldNames())


def type_events(raw: DataFrame) -> DataFrame:
    """Renamed and typed; blank or unreadable text is NULL."""
    columns = [typed(F.col(src), kind).alias(name) for src, (name, kind) in RAW_EVENT_COLUMNS.items()]
    return raw.select(*columns, F.col("_source").alias("source"), F.col("_ingested_at").alias("ingested_at"))


def land_raw(df: DataFrame, folder: str, run_id: str, source: str) -> None:
    """Append one run's rows, all as text, with their lineage columns."""
    names = list(RAW_EVENT_COLUMNS)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names if c in df.columns]
    (
        df.select(*text)
        .withColumns({"_source": F.lit(source), "_ingested_at": F.lit(run_id)})
        .write.mode("overwrite")
        .parquet(f"{folder}/run_id={run_id}")
    )
