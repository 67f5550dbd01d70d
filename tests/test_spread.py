"""Work per row goes to tasks by rows, not by the few bytes that its keys take."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__

N = 9000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """part and customer, each one file of one row group that a scan reads in one task."""
    folder = str(tmp_path_factory.mktemp("narrow"))
    k = F.col("id") + 1
    spark.range(0, N, 1, 1).select(k.alias("p_partkey")).write.parquet(os.path.join(folder, "part.parquet"))
    spark.range(0, N, 1, 1).select(k.alias("c_custkey"), F.lit("AUTO").alias("c_mktsegment"), (k % 25).cast("int").alias("c_nationkey")).write.parquet(os.path.join(folder, "customer.parquet"))
    return folder


@pytest.mark.parametrize("name", ["list_extract", "customer_detail_pages", "detail_extract"])
def test_pages_of_short_keys_are_read_by_many_tasks(spark, tables, name):
    got = __spark_entry__.queries()[name](spark, tables).select(F.spark_partition_id().alias("at")).groupBy("at").count().collect()
    assert sum(r["count"] for r in got) == N and len(got) >= 4 and max(r["count"] for r in got) <= 2 * N / len(got)
