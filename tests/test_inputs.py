"""How supplied tables are dealt out to tasks."""

from __future__ import annotations

from workload import inputs


def test_parts_grow_with_the_table_and_hold_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_OF_A_TASK", 10)
    spark.range(1000).write.parquet(str(tmp_path / "orders.parquet"))
    rows = inputs.table(spark, str(tmp_path), "orders")
    sizes = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == 100 and max(sizes) <= 20
    assert sorted(r["id"] for r in rows.collect()) == list(range(1000))


def test_a_small_table_is_dealt_to_all_cores(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "orders.parquet"))
    assert inputs.table(spark, str(tmp_path), "orders").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_filter_on_catalog_lines_does_not_make_them_twice(spark, tmp_path):
    """Lines are made after the rows are dealt out, once, and no row is lost by that."""
    rows = spark.range(1000).selectExpr(
        "id AS l_orderkey", "id * 3 AS l_partkey", "id AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber", "TIMESTAMP '1996-03-13' AS l_shipdate"
    )
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    lines = inputs.spark_input(spark, str(tmp_path), "catalog_lines")
    assert lines.count() == 1000 and lines.where("length(line) = 60").count() == 11
    plan = lines.where("length(line) >= 68")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" PREF") == 1
