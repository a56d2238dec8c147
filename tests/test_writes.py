import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.session import new_path
from haulmark.sources import writes
from haulmark.sources.tables import INPUT_SCHEMAS, scan_csv
from tests.conftest import SF_DIR, rows


def test_counted_write(spark):
    path = new_path(spark, "counted")
    assert writes.counted_write(spark.range(41), path) == 41 == spark.read.parquet(path).count()


def test_observed_rows(spark):
    df, seen = writes.observed(spark.range(17), "seventeen")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 17}


def test_compaction_keeps_rows_and_orders_files(spark):
    source, target = new_path(spark, "many"), new_path(spark, "few")
    spark.range(1000).repartition(20).write.parquet(source)
    size = writes.file_sizes(spark, source).agg(F.sum("length")).first()[0]
    writes.compact(spark, source, target, ["id"], file_bytes=size // 3 + 1)
    got = spark.read.parquet(target)
    assert rows(got) == rows(spark.range(1000)) and writes.file_sizes(spark, target).count() <= 3
    spans = sorted(tuple(r) for r in got.groupBy(F.input_file_name().alias("f")).agg(
        F.min("id"), F.max("id")).drop("f").collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_day_filter_prunes_partitions(spark, lake):
    path = new_path(spark, "days")
    writes.write_by_day(lake.table("events"), "ts", path)
    one = spark.read.parquet(path).filter(F.col("event_day") == F.lit("2024-01-10").cast("date"))
    files = {r.f for r in one.select(F.input_file_name().alias("f")).distinct().collect()}
    assert files and all("event_day=2024-01-10" in f for f in files)
    assert "PartitionFilters: [isnotnull(event_day" in one._jdf.queryExecution().executedPlan().toString()


def test_csv_with_fixed_schema(spark):
    path = new_path(spark, "csv")
    spark.createDataFrame([("Zoë, K.", 3), (None, 4)], "name string, n int").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())])
    assert rows(scan_csv(spark, path, schema)) == rows(spark.createDataFrame([("Zoë, K.", 3), (None, 4)], schema))


def test_scans_are_pruned_and_pushed_down(spark, lake):
    df = lake.table("lineitem").filter("l_quantity >= 45").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


@pytest.mark.parametrize("name", sorted(INPUT_SCHEMAS))
def test_declared_schema_is_the_stored_one(spark, name):
    stored = spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema
    assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in INPUT_SCHEMAS[name]]


def test_compaction_bounds_the_rows_that_a_task_sorts(spark):
    source, target = new_path(spark, "many"), new_path(spark, "bounded")
    spark.range(1000).select((F.col("id") % 2).alias("a"), "id").repartition(20).write.parquet(source)
    writes.compact(spark, source, target, ["a", "id"], file_rows=150)
    got = spark.read.parquet(target)
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 6 and max(sizes) < 300
