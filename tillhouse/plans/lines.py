"""Both bronze channels as one narrow-typed table of sales lines. Streams and batches alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.clean import align, harmonize, tag, trim_columns
from tillhouse.functions.fixed import AMOUNT, COUNTRY_NAMES, OFFLINE, OFFLINE_TABLE, ONLINE, ONLINE_TABLE, SALARY
from tillhouse.functions.keys import md5_key
from tillhouse.plans.rules import PATH, Rules

# line column: (online column, offline column, type); "same" keeps the type the channel delivers
_COLUMNS: dict[str, tuple[str | None, str | None, str]] = {
    "order_src_id_raw": ("Order_ID", "Order_ID", "string"),
    "order_date": ("Order_Date", "Order_date", "same"),
    "category_name": ("Category", "Category", "string"),
    "sub_category_name": ("Sub_Category", "Sub_Category", "string"),
    "product_name": ("Product_Name", "Product_Name", "string"),
    "sales": ("Sales", "Sales", AMOUNT),
    "quantity": ("Quantity", "Quantity", "int"),
    "discount": ("Discount", "Discount", AMOUNT),
    "profit": ("Profit", "Profit", AMOUNT),
    "cost": ("Cost", "Cost", AMOUNT),
    "payment_id_raw": ("payment_id", "payment_id", "string"),
    "payment_method": ("payment_method", "payment_method", "string"),
    "payment_provider": ("payment_provider", "payment_provider", "string"),
    "country_name": ("Country", "store_country", "string"),
    "region_name": ("Region", "store_region", "string"),
    "state_name": ("State", "store_state", "string"),
    "city_name": ("City", "store_city", "string"),
    "email": ("customer_email", None, "string"),
    "first_name": ("customer_name", None, "string"),
    "last_name": ("customer_surname", None, "string"),
    "gender": ("customer_gender", None, "string"),
    "age": ("customer_age", None, "int"),
    "phone_number": ("customer_phone_number", None, "string"),
    "postal_code": ("Postal_Code", None, "string"),
    "store_src_id": (None, "store_id", "bigint"),
    "store_name": (None, "store_name", "string"),
    "employee_src_id": (None, "employee_id", "string"),
    "employee_first_name": (None, "employee_name", "string"),
    "employee_last_name": (None, "employee_surname", "string"),
    "employee_gender": (None, "employee_gender", "string"),
    "monthly_salary": (None, "employee_monthly_salary", SALARY),
}

NATURAL_TEXT = [
    "category_name", "sub_category_name", "product_name", "payment_method", "payment_provider",
    "region_name", "state_name", "city_name", "store_name", "email",
]

HEADER = [
    "source_system", "source_entity", "order_src_id_raw", "order_src_id", "order_date", "email",
    "store_src_id", "store_name", "country_name", "region_name", "state_name", "city_name", "employee_src_id",
]


def _channel(bronze: DataFrame, side: int, system: str, entity: str) -> DataFrame:
    types = {f.name.lower(): f.dataType.simpleString() for f in bronze.schema}
    columns = {}
    for name, spec in _COLUMNS.items():
        source, type_ = spec[side], spec[2]
        if type_ == "same":
            type_ = types[source.lower()]
        columns[name] = (source, type_)
    return tag(align(bronze, columns), system, entity)


def _with_order_hash(lines: DataFrame) -> DataFrame:
    return lines.withColumn("order_src_id", md5_key("source_system", "order_src_id_raw"))


def sales_lines(online: DataFrame, offline: DataFrame, rules: Rules = PATH) -> DataFrame:
    """One row per bronze line, columns of the other channel typed NULL. No shuffle; unread columns cost nothing."""
    lines = _channel(online, 0, ONLINE, ONLINE_TABLE).unionByName(_channel(offline, 1, OFFLINE, OFFLINE_TABLE))
    if rules.by_path:
        lines = trim_columns(lines, NATURAL_TEXT).withColumn("country_name", harmonize("country_name", COUNTRY_NAMES))
    else:
        lines = lines.withColumn("email", F.trim("email"))
    return _with_order_hash(lines)


def channel(lines: DataFrame, system: str) -> DataFrame:
    """Lines of one channel; the planner drops the other branch of the union."""
    return lines.filter(F.col("source_system") == system)
