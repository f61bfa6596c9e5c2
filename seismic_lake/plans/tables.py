"""External tables over the lake, for ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from seismic_lake.plans.audit import HISTORY
from seismic_lake.plans.clean_jma import FELT_TABLE
from seismic_lake.plans.clean_jma import TABLE as JMA_TABLE
from seismic_lake.plans.clean_usgs import TABLE as USGS_TABLE
from seismic_lake.plans.link import TABLE as MATCH_TABLE
from seismic_lake.sources.lake import PUBLISHED, Lake, path_exists
from seismic_lake.vocab import DQ_SCHEMA, FELT_SCHEMA, JMA_SCHEMA, MATCH_SCHEMA, USGS_SCHEMA

DATABASE = "seismic"
# Table name -> (lake table, schema, partitioned by year)
TABLES: dict[str, tuple[str, T.StructType, bool]] = {
    "usgs_events": (USGS_TABLE, USGS_SCHEMA, True),
    "jma_events": (JMA_TABLE, JMA_SCHEMA, True),
    "jma_felt": (FELT_TABLE, FELT_SCHEMA, True),
    "jma_usgs_matches": (MATCH_TABLE, MATCH_SCHEMA, False),
}


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def register(lake: Lake, event: str = PUBLISHED, database: str = DATABASE) -> list[str]:
    """Create the tables, or point existing ones at the newest published build.

    A table's folder is all the catalog knows of its files: years are read off the folder names when a query is
    planned, and pruned as declared partitions are. So moving a table to another build is one change of its
    location, before which a reader sees the old build and after which the new one, whole.
    """
    spark = lake.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name, (table, schema, yearly) in TABLES.items():
        build = lake.newest(table, event)
        if build is None or not path_exists(spark, build.location):
            continue
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full) and any(c.isPartition for c in spark.catalog.listColumns(full)):
            spark.sql(f"DROP TABLE {full}")  # made by an earlier version, with its years listed in the catalog; the files stay
        if spark.catalog.tableExists(full):
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{build.location}'")
        else:
            columns = _columns(schema) + (", year int" if yearly else "")
            spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet LOCATION '{build.location}'")
        spark.catalog.refreshTable(full)
        made.append(full)
    history = lake.path(HISTORY)
    if path_exists(spark, f"{history}/*"):
        register_history(spark, history, database)
        made.append(f"{database}.dq_results")
    return made


def register_history(spark: SparkSession, path: str, database: str = DATABASE) -> None:
    """Long audit history as a table, and the wide view over it."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.dq_results ({_columns(DQ_SCHEMA)}) "
        f"USING parquet OPTIONS (recursiveFileLookup true) LOCATION '{path}'"
    )
    spark.catalog.refreshTable(f"{database}.dq_results")
    # The definition of analytics.dq_runs: equal results are counted first, then each failed check is listed once.
    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.dq_runs AS
        WITH per_check AS (
            SELECT run_id, coalesce(dataset, 'usgs') AS dataset, check, severity, passed,
                   count(*) AS n, min(run_at) AS run_at, max(value) AS value
            FROM {database}.dq_results GROUP BY 1, 2, 3, 4, 5),
        failed AS (
            SELECT run_id, dataset, check || CASE WHEN sum(n) > 1 THEN ' (' || sum(n) || ')' ELSE '' END AS label
            FROM per_check WHERE NOT passed GROUP BY run_id, dataset, check),
        labels AS (
            SELECT run_id, dataset, array_join(array_sort(collect_list(label)), ', ') AS failed_checks
            FROM failed GROUP BY run_id, dataset),
        runs AS (
            SELECT run_id, dataset, min(run_at) AS run_at, every(passed OR severity = 'warn') AS published,
                   coalesce(sum(n) FILTER (WHERE NOT passed AND severity = 'error'), 0) AS errors,
                   coalesce(sum(n) FILTER (WHERE NOT passed AND severity = 'warn'), 0) AS warnings,
                   max(value) FILTER (WHERE check = 'not empty') AS row_count,
                   max(value) FILTER (WHERE check = 'data is fresh') AS hours_since_newest_event
            FROM per_check GROUP BY run_id, dataset)
        SELECT runs.*, coalesce(failed_checks, '') AS failed_checks FROM runs LEFT JOIN labels USING (run_id, dataset)
    """)


def add_missing_column(spark: SparkSession, table: str, column: str, kind: str) -> bool:
    """Schema evolution: add a column to a table made before the column existed."""
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({column} {kind})")
    return True
