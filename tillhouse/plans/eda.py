"""Exploratory checks over the bronze channels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.lookup import lookup


def count_distinct(df: DataFrame, names: list[str]) -> DataFrame:
    """Exact distinct counts, one column each."""
    return df.agg(*[F.count_distinct(F.col(c)).alias(f"n_{c.lower()}") for c in names])


def distinct_values(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names).distinct()


def projection(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)


def where_equal(df: DataFrame, **values: str) -> DataFrame:
    """Rows whose columns equal all given values; pushed down to the scan."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in values.items()]))


def sales_by_year_country_category(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Flagship report: sales, quantity and lines by year, country of the sale and category.

    The country is the customer's for online sales and the shop's otherwise. Year, category and shop country come from
    small dimensions, so they cost no shuffle of the lines; the customers, who may be many, are met last, and lines
    without customer are scattered. One aggregate with map-side combine then leaves a few rows per task.
    """
    shops = dims["store"].select("store_sk", F.col("country_name").alias("_shop"))
    buyers = dims["customer"].select("customer_sk", F.col("country_name").alias("_buyer"))
    rows = (
        fact.select("order_date_sk", "customer_sk", "store_sk", "product_sk", "order_item_id", "sales", "quantity")
        .join(dims["date"].select(F.col("date_sk").alias("order_date_sk"), "year"), "order_date_sk", "left")
        .join(dims["product"].select("product_sk", "category_name"), "product_sk", "left")
        .join(shops, "store_sk", "left")
    )
    placed = lookup(rows, buyers, "customer_sk", ["_buyer"], unique=True, spread_by=["order_item_id"])
    return placed.groupBy("year", F.coalesce("_buyer", "_shop").alias("country_name"), "category_name").agg(
        F.sum("sales").cast("decimal(38,4)").alias("sales"), F.sum("quantity").alias("quantity"), F.count("*").alias("lines")
    )
