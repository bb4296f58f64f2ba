"""The two bronze channels derived from the test tables: even order keys play the online shop, odd ones the stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names and types of the given test tables. Declaring them saves a footer scan per read.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

#: Sales lines of both channels that one task joins with their orders.
LINES_PER_TASK = 1_000_000

_SALE = [
    "l_orderkey AS Order_ID",
    "o_orderdate AS Order_Date",
    "p_type AS Category",
    "p_brand AS Sub_Category",
    "p_name AS Product_Name",
    "CAST(l_extendedprice AS DECIMAL(18,4)) AS Sales",
    "CAST(l_quantity AS INT) AS Quantity",
    "CAST(l_discount AS DECIMAL(18,4)) AS Discount",
    "CAST(l_tax AS DECIMAL(18,4)) AS Profit",
    "CAST(p_retailprice AS DECIMAL(18,4)) AS Cost",
    "l_orderkey * 10 + l_linenumber AS payment_id",
    "o_orderpriority AS payment_method",
    "o_orderstatus AS payment_provider",
]

_BUYER = [
    "c_mktsegment AS customer_name",
    "c_name AS customer_surname",
    "IF(c_custkey % 2 = 0, 'F', 'M') AS customer_gender",
    "CAST(18 + c_custkey % 60 AS INT) AS customer_age",
    "' ' || c_name || '@example.com ' AS customer_email",
    "'+1-' || c_custkey AS customer_phone_number",
    "'Z' || c_nationkey AS Postal_Code",
    "n_name || '-C' || c_custkey % 3 || ' ' AS City",
    "n_name AS State",
    "'Q' || n_nationkey % 4 AS Region",
    "CASE r_name WHEN 'AMERICA' THEN ' USA ' WHEN 'EUROPE' THEN 'UK' ELSE r_name END AS Country",
]

_SHOP = [
    "s_suppkey AS store_id",
    "s_name AS store_name",
    "n_name || '-C' || s_suppkey % 3 AS store_city",
    "n_name AS store_state",
    "'Q' || n_nationkey % 4 AS store_region",
    "CASE r_name WHEN 'AMERICA' THEN 'United States' WHEN 'EUROPE' THEN 'United Kingdom' ELSE r_name END "
    "AS store_country",
    "s_suppkey % 37 AS employee_id",
    "'E' || s_suppkey % 37 AS employee_name",
    "'S' || s_suppkey % 37 AS employee_surname",
    "IF(s_suppkey % 37 % 2 = 0, 'F', 'M') AS employee_gender",
    "CAST(s_acctbal AS DECIMAL(10,2)) AS employee_monthly_salary",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that sales lines are dealt over, by their number, which is read from the file footers."""
    return table(spark, sf_dir, "lineitem").count() // LINES_PER_TASK


def _sales(spark: SparkSession, sf_dir: str, orders: DataFrame, remainder: int, files: int | None = None) -> DataFrame:
    """Lines of one channel; the small order side is assembled before it meets the lines.

    Lines are narrow until they meet their order and its buyer or shop. Adaptive execution sizes tasks by the narrow
    bytes, so many lines are dealt out by their number, and sorts behind the join stay as small as one task's share.

    ``files`` deals the rows over as many files to be written, an order's lines over more than one. Many lines are dealt
    out for that while they are narrow: in halves of orders, each of which finds its order by the same number of tasks.
    """
    lines = table(spark, sf_dir, "lineitem").where(f"l_orderkey % 2 = {remainder}")
    parts = table(spark, sf_dir, "part")
    many = tasks(spark, sf_dir)
    if many <= 1:
        rows = lines.join(orders, F.expr("l_orderkey = o_orderkey")).join(parts, F.expr("l_partkey = p_partkey"))
        return rows if files is None else rows.repartition(files)
    if files is not None:
        lines = lines.withColumn("l_half", F.pmod(F.xxhash64("l_linenumber", "l_partkey", "l_suppkey"), F.lit(2)))
        orders = orders.withColumn("o_half", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))))
        goods = lines.join(parts, F.expr("l_partkey = p_partkey")).repartition(files, "l_orderkey", "l_half")
        orders = orders.repartition(files, "o_orderkey", "o_half")
        return goods.join(orders, F.expr("l_orderkey = o_orderkey AND l_half = o_half"))
    many = max(many, spark.sparkContext.defaultParallelism)
    goods = lines.join(parts, F.expr("l_partkey = p_partkey")).repartition(many, "l_orderkey")
    return goods.join(orders.repartition(many, "o_orderkey"), F.expr("l_orderkey = o_orderkey"))


def online(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    buyers = table(spark, sf_dir, "customer").join(_places(spark, sf_dir), F.expr("c_nationkey = n_nationkey"))
    orders = table(spark, sf_dir, "orders").join(buyers, F.expr("o_custkey = c_custkey"))
    return _sales(spark, sf_dir, orders, 0, files).selectExpr(*_SALE, *_BUYER)


def offline(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    shops = supplier.join(_places(spark, sf_dir), F.expr("s_nationkey = n_nationkey"))
    turn = F.expr("CAST(FLOOR(o_orderkey / 2) AS BIGINT)") % supplier.agg(F.count("*")).scalar()
    orders = table(spark, sf_dir, "orders").withColumn("o_shopkey", turn).join(shops, F.expr("o_shopkey = s_suppkey"))
    sales = _sales(spark, sf_dir, orders, 1, files).selectExpr(*_SALE, *_SHOP)
    return sales.withColumnRenamed("Order_Date", "Order_date")
