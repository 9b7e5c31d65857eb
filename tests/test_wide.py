"""The derived raw table: rows dealt out by number, vendors joined."""

from pyspark.sql import functions as F

from coppice.plans.wide import wide_expressions, wide_table
from coppice.session import ROWS_PER_TASK


def _tables(spark, folder, keys):
    orders = keys.selectExpr("id AS o_orderkey", "pmod(coalesce(id, 0), 100) AS o_custkey", "cast(id as double) AS o_totalprice", "timestamp'2020-01-01' AS o_orderdate")
    orders.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.range(100).selectExpr("id AS c_custkey", "cast(id * 100 as double) AS c_acctbal").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_well_compressed_orders_are_dealt_out_by_rows(spark, tmp_path):
    n = 9 * ROWS_PER_TASK
    folder = _tables(spark, tmp_path, spark.range(n).selectExpr("id % 1000 AS id"))
    wide = wide_table(spark, folder).select("customer_id")
    sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 1.1 * ROWS_PER_TASK


def test_vendor_columns_equal_their_expressions(spark, tmp_path):
    keys = spark.range(-300, 300).union(spark.sql("SELECT cast(NULL AS bigint)"))
    folder = _tables(spark, tmp_path, keys.selectExpr("id"))
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    joined = orders.join(spark.read.parquet(f"{folder}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    plain = joined.select(*[F.expr(e).alias(n) for n, e in wide_expressions().items()])
    made = wide_table(spark, folder)
    assert made.dtypes == plain.dtypes and made.count() == 601
    assert made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()
