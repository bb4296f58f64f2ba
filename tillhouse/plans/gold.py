"""Gold: six flat dimensions and one fact at order-line grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.clean import with_audit
from tillhouse.functions.fixed import (
    DIM_CUSTOMER_COLUMNS,
    DIM_EMPLOYEE_COLUMNS,
    DIM_PAYMENT_METHOD_COLUMNS,
    DIM_PRODUCT_COLUMNS,
    DIM_STORE_COLUMNS,
    FACT_COLUMNS,
    MEASURES,
    OFFLINE,
    PLACE_COLUMNS,
)
from tillhouse.functions.keys import fk60, md5_key, sk60
from tillhouse.operators.calendar import date_dim, date_key, safe_date
from tillhouse.operators.dedup import dedup, top1
from tillhouse.operators.lookup import flatten, lookup
from tillhouse.plans.silver import METHOD_KEY, order_headers, orders, orders_items, payment_keys


def flat_geography(city: DataFrame, state: DataFrame, region: DataFrame, country: DataFrame) -> DataFrame:
    """City ids with the names of all four levels; built once, then joined once per dimension."""
    return flatten(
        city.select("city_id", "state_id", "city_name"),
        [
            (state.select("state_id", "region_id", "state_name"), "state_id"),
            (region.select("region_id", "country_id", "region_name"), "region_id"),
            (country.select("country_id", "country_name"), "country_id"),
        ],
    ).select("city_id", *PLACE_COLUMNS)


def dim_customer(customer: DataFrame, geography: DataFrame) -> DataFrame:
    # customers may be many, and a large share may live in one city or in none
    placed = lookup(customer, geography, "city_id", PLACE_COLUMNS, unique=True, spread_by=["customer_id"])
    return placed.withColumn("customer_sk", F.col("customer_id")).select(*DIM_CUSTOMER_COLUMNS)


def dim_store(store: DataFrame, geography: DataFrame) -> DataFrame:
    return flatten(store, [(geography, "city_id")]).withColumn("store_sk", F.col("store_id")).select(*DIM_STORE_COLUMNS)


def dim_product(product: DataFrame, sub_category: DataFrame, category: DataFrame) -> DataFrame:
    # the product table repeats the sub-category name; the dimension takes it from its own level
    wide = flatten(
        product.drop("sub_category_name"),
        [
            (sub_category.select("sub_category_id", "category_id", "sub_category_name"), "sub_category_id"),
            (category.select("category_id", "category_name"), "category_id"),
        ],
    )
    return wide.withColumn("product_sk", F.col("product_id")).select(*DIM_PRODUCT_COLUMNS)


def dim_payment_method(methods: DataFrame) -> DataFrame:
    return methods.withColumn("payment_method_sk", F.col("method_id")).select(*DIM_PAYMENT_METHOD_COLUMNS)


def dim_employee(history: DataFrame) -> DataFrame:
    """Employee versions; the surrogate belongs to the version, not to the person."""
    renamed = history.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})
    added = {
        "employee_sk": sk60("employee_src_id", "start_at"),
        "is_current": F.col("end_at").isNull(),
        "source_system": F.lit(OFFLINE),
    }
    return renamed.withColumns(added).select(*DIM_EMPLOYEE_COLUMNS)


def dim_date(orders: DataFrame) -> DataFrame:
    return date_dim(orders, "order_date")


def payment_per_order(payment: DataFrame) -> DataFrame:
    """First payment of each order by payment id; amount, then method, break ties.

    Orders are told apart by ``order_src_id``, the full hash, where the payments carry it; two orders whose 64-bit ids
    collide then keep a payment each.

    ``payment_amount`` is one line's amount, so it must not be summed over the lines of an order; see
    :func:`order_total` for that.
    """
    key = "order_src_id" if "order_src_id" in payment.columns else "order_id"
    known = payment.filter(F.col(key).isNotNull())
    order = [F.asc("payment_id"), F.asc("payment_amount"), F.asc("method_id")]
    return top1(known, [key], order).select(key, "method_id", "payment_amount")


def order_total(payment: DataFrame) -> DataFrame:
    """All payments of an order added up."""
    known = payment.filter(F.col("order_id").isNotNull())
    return known.groupBy("order_id").agg(F.sum("payment_amount").cast("decimal(38,4)").alias("order_payment_total"))


def current_employees(dim_employee: DataFrame) -> DataFrame:
    """Surrogate of each employee's open version."""
    return dedup(
        dim_employee.filter(F.col("is_current")).select("employee_sk", "employee_src_id"), ["employee_src_id"]
    )


def _sale_key() -> Column:
    return md5_key("order_src_id", "product_id")


_HEAD = [
    "customer_sk", "employee_sk", "store_sk", "payment_method_sk", "order_date_sk", "payment_amount",
    "source_system", "source_entity",
]


def _attach(items: DataFrame, heads: DataFrame, order: str, take: list[str]) -> DataFrame:
    """Lines with columns of their order's head. A hot order is split, lines without order are scattered."""
    return lookup(items, heads, order, take, unique=True, spread_by=["order_item_id", *MEASURES])


def _finish(rows: DataFrame) -> DataFrame:
    """Fact columns from lines that carry ``order_src_id`` and ``product_id``."""
    return rows.withColumns({"sale_sk": _sale_key(), "order_id": F.col("order_src_id")}).select(*FACT_COLUMNS)


def _with_employee(heads: DataFrame, employees: DataFrame) -> DataFrame:
    """Heads with the surrogate of the employee's open version; online orders have no employee."""
    open_versions = current_employees(employees)
    return lookup(
        heads, open_versions, "employee_src_id", ["employee_sk"], unique=True, spread_by=["order_src_id"]
    )


def order_heads(orders: DataFrame, payment: DataFrame, employees: DataFrame) -> DataFrame:
    """What an order gives each of its lines: surrogates, first payment, date. One row per order."""
    heads = orders.join(payment_per_order(payment), on="order_src_id", how="left")
    return _with_employee(heads, employees).select(
        "order_src_id",
        F.col("customer_id").alias("customer_sk"),
        F.col("store_id").alias("store_sk"),
        "employee_sk",
        F.col("method_id").alias("payment_method_sk"),
        date_key(safe_date("order_date")).alias("order_date_sk"),
        "payment_amount",
        "source_system",
        "source_entity",
    )


def finished(rows: DataFrame) -> DataFrame:
    """The fact from lines with the columns of their order's head."""
    return _finish(rows.withColumn("product_sk", F.col("product_id")))


def fact_sales(items: DataFrame, orders: DataFrame, payment: DataFrame, employees: DataFrame) -> DataFrame:
    """The fact from stored silver tables.

    Order and line already carry the surrogates of every dimension but the employee version, so only
    ``dim_employee`` is joined, and that to the order heads. The lines are shuffled once. Lines and payments carry
    ``order_src_id`` beside their own columns and are joined on it; the 64-bit ``order_id`` is no join key.
    """
    return finished(_attach(items, order_heads(orders, payment, employees), "order_src_id", _HEAD))


def fact_sales_joined(
    items: DataFrame, orders: DataFrame, payment: DataFrame, dims: dict[str, DataFrame]
) -> DataFrame:
    """The same by joining all six dimensions, every join a left join: a key missing from its dimension gives NULL.

    ``dims``: ``customer employee store product payment_method date``. What hangs on the order is joined to the order
    heads, a fraction of the lines; the lines meet only the heads and the product dimension.
    """
    heads = orders.join(payment_per_order(payment), on="order_src_id", how="left").withColumn(
        "full_date", safe_date("order_date")
    )
    heads = _with_employee(heads, dims["employee"])
    dates = dims["date"].withColumnRenamed("date_sk", "order_date_sk")
    for dim, key, surrogate in [
        (dims["customer"], "customer_id", "customer_sk"),
        (dims["store"], "store_id", "store_sk"),
        (dims["payment_method"], "method_id", "payment_method_sk"),
        (dates, "full_date", "order_date_sk"),
    ]:
        heads = lookup(heads, dim, key, [surrogate], unique=True, spread_by=["order_src_id"])
    rows = _attach(items, heads, "order_src_id", _HEAD)
    return _finish(
        lookup(rows, dims["product"], "product_id", ["product_sk"], unique=True, spread_by=["order_item_id", *MEASURES])
    )


def fact_sales_from_lines(lines: DataFrame, employees: DataFrame | None) -> DataFrame:
    """The same under the path rules straight from the lines.

    One aggregation folds header and first payment of each order out of the lines, one join brings them back.
    ``employees`` is ``dim_employee``; without it the fact has no employees.
    """
    first = F.min(F.struct("payment_id", "payment_amount", "method_id")).alias("_first")
    paid = payment_keys(lines).withColumn("method_id", fk60(*METHOD_KEY, required=2))
    headers = orders(order_headers(paid, first), keep=("_first",))
    if employees is None:
        headers = headers.withColumn("employee_sk", F.lit(None).cast("bigint"))
    else:
        headers = _with_employee(headers, employees)
    heads = headers.select(
        "order_src_id",
        F.col("customer_id").alias("customer_sk"),
        F.col("store_id").alias("store_sk"),
        "employee_sk",
        F.col("_first.method_id").alias("payment_method_sk"),
        date_key(safe_date("order_date")).alias("order_date_sk"),
        "_first.payment_amount",
        "source_system",
        "source_entity",
    )
    items = orders_items(lines, keep=("order_src_id",)).withColumn("product_sk", F.col("product_id"))
    return _finish(_attach(items, heads, "order_src_id", _HEAD))


def dimensions(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six dimensions over the normalized tables, without audit columns."""
    places = flat_geography(silver["city"], silver["state"], silver["region"], silver["country"])
    return {
        "customer": dim_customer(silver["customer"], places),
        "employee": dim_employee(silver["employee_history"]),
        "store": dim_store(silver["store"], places),
        "product": dim_product(silver["products"], silver["sub_categories"], silver["categories"]),
        "payment_method": dim_payment_method(silver["payment_methods"]),
        "date": dim_date(silver["orders"]),
    }


def fact(silver: dict[str, DataFrame], dims: dict[str, DataFrame], joined: bool = False) -> DataFrame:
    """The fact over the normalized tables; ``joined`` looks every surrogate up in its dimension."""
    facts = [silver[name] for name in ("orders_items", "orders", "payment")]
    return fact_sales_joined(*facts, dims) if joined else fact_sales(*facts, dims["employee"])


def audited(name: str, dim: DataFrame) -> DataFrame:
    """Audit columns for the dimensions that carry them."""
    return dim if name in ("employee", "date") else with_audit(dim)
