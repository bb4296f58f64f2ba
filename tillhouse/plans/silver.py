"""Silver: the normalized model, one function per table.

Every table takes ``sales_lines``. Under the path rules a parent's id is a pure function of the columns a line
carries, so no table waits for, or joins, another one. Under the leaf rules the literal joins are made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.clean import harmonize, with_audit
from tillhouse.functions.fixed import (
    COUNTRY_NAMES,
    CUSTOMER_COLUMNS,
    EMPLOYEE_HISTORY_DDL,
    ITEM_COLUMNS,
    OFFLINE,
    OFFLINE_TABLE,
    ONLINE,
    ONLINE_TABLE,
    ORDER_COLUMNS,
    PAYMENT_COLUMNS,
    STORE_COLUMNS,
)
from tillhouse.functions.keys import fk60, md5_key, sk60, xx_key
from tillhouse.operators.cdc import scd2
from tillhouse.operators.dedup import dedup
from tillhouse.operators.dictionary import source_dictionary
from tillhouse.operators.lookup import join_key, lookup, lookup_leaf, spread_nulls
from tillhouse.plans.lines import HEADER, channel
from tillhouse.plans.rules import PATH, Rules
from tillhouse.sources.storage import checked


@dataclass(frozen=True)
class Level:
    """One level of a hierarchy. ``path`` runs from the root to this level's own name."""

    name: str
    path: tuple[str, ...]
    parent: str | None = None
    hashed: tuple[str, ...] | None = None
    extra: tuple[str, ...] = ()

    @property
    def id(self) -> str:
        return f"{self.name}_id"

    @property
    def label(self) -> str:
        return f"{self.name}_name"

    @property
    def columns(self) -> list[str]:
        parent = [f"{self.parent}_id"] if self.parent else []
        return [self.id, *parent, *self.extra, self.label, f"{self.name}_src_id", "source_system"]


PRODUCT_PATH = ("category_name", "sub_category_name", "product_name")
CITY_PATH = ("country_name", "region_name", "state_name", "city_name")
STORE_KEY = ("store_src_id", "store_name", *CITY_PATH)

LEVELS = {
    level.name: level
    for level in [
        Level("category", PRODUCT_PATH[:1]),
        Level("sub_category", PRODUCT_PATH[:2], "category"),
        Level("product", PRODUCT_PATH, "sub_category", extra=("sub_category_name",)),
        Level("country", CITY_PATH[:1]),
        Level("region", CITY_PATH[:2], "country"),
        Level("state", CITY_PATH[:3], "region"),
        Level("city", CITY_PATH, "state", hashed=("city_name", "state_name")),
    ]
}


def city_id():
    """Id of the city a line belongs to."""
    return fk60(*CITY_PATH, required=2)


def level_by_path(rows: DataFrame, name: str) -> DataFrame:
    """Table of one hierarchy level from lines, or rolled up from the dictionary of a deeper level."""
    level = LEVELS[name]
    table = source_dictionary(rows, list(level.path))
    ids = {level.id: sk60(*level.path), f"{name}_src_id": md5_key(*(level.hashed or (level.label,)))}
    if level.parent:
        ids[f"{level.parent}_id"] = fk60(*LEVELS[level.parent].path)
    return table.withColumns(ids).select(*level.columns)


# What the literal rules clean per table: (column, spellings), no entry means the raw value.
_LEAF_CLEANING = {
    "country": {"country_name": COUNTRY_NAMES},
    "region": {"country_name": {"USA": COUNTRY_NAMES["USA"]}},
    "city": {"city_name": {}, "state_name": {}},
}


def level_by_leaf(lines: DataFrame, name: str, parent: DataFrame | None = None) -> DataFrame:
    """Table of one hierarchy level under the literal rules; ``parent`` is joined by its name alone."""
    level = LEVELS[name]
    cleaned = lines.withColumns({c: harmonize(c, m) for c, m in _LEAF_CLEANING.get(name, {}).items()})
    keys = [level.label] if parent is None else [LEVELS[level.parent].label, level.label]
    table = source_dictionary(cleaned, keys)
    identity = list(keys)
    if parent is not None:
        above = LEVELS[level.parent]
        table = lookup_leaf(table, parent, above.label, [above.id])
        identity.append(above.id)
    ids = {level.id: sk60(*identity), f"{name}_src_id": md5_key(*(level.hashed or (level.label,)))}
    return table.withColumns(ids).select(*level.columns)


def hierarchy(lines: DataFrame, names: list[str], rules: Rules = PATH) -> dict[str, DataFrame]:
    """Tables of one hierarchy, root first."""
    tables: dict[str, DataFrame] = {}
    for name in names:
        parent = LEVELS[name].parent
        tables[name] = (
            level_by_path(lines, name) if rules.by_path else level_by_leaf(lines, name, tables.get(parent))
        )
    return tables


PRODUCT_LEVELS = ["category", "sub_category", "product"]
GEOGRAPHY_LEVELS = ["country", "region", "state", "city"]


def city_state_lookup(city: DataFrame, state: DataFrame) -> DataFrame:
    """Cities with the name of their state, for lookups by both names."""
    return city.select("city_id", "state_id", "city_name").join(
        state.select("state_id", "state_name"), on="state_id", how="inner"
    )


def store(lines: DataFrame, rules: Rules = PATH, places: DataFrame | None = None) -> DataFrame:
    """Distinct shops. ``places`` is the city-state lookup the leaf rules need."""
    rows = channel(lines, OFFLINE)
    if rules.by_path:
        table = rows.select(*STORE_KEY).distinct().withColumns({"store_id": sk60(*STORE_KEY), "city_id": city_id()})
    else:
        key = ["store_src_id", "store_name", "city_name", "state_name"]
        table = rows.select(*key).distinct().join(places, on=["city_name", "state_name"], how="left")
        table = table.withColumn("store_id", sk60(*key, "city_id"))
    return table.withColumn("source_system", F.lit(OFFLINE)).select(*STORE_COLUMNS)


CUSTOMER_ATTRIBUTES = ["first_name", "last_name", "gender", "age", "phone_number", "postal_code"]


def customer(lines: DataFrame, rules: Rules = PATH, places: DataFrame | None = None) -> DataFrame:
    """One row per e-mail address with the attributes of its latest order."""
    rows = channel(lines, ONLINE)
    if not rules.by_path:
        rows = rows.withColumns({c: F.trim(c) for c in ("city_name", "state_name")})
    place = list(CITY_PATH) if rules.by_path else ["city_name", "state_name"]
    # the e-mail NULL is kept as one customer, as any distinct-by-email would
    table = (
        rows.select("email", "order_date", *CUSTOMER_ATTRIBUTES, *place)
        .groupBy("email")
        .agg(F.max(F.struct("order_date", *CUSTOMER_ATTRIBUTES, *place)).alias("_row"))
        .select("email", "_row.*")
    )
    if rules.by_path:
        table = table.withColumns({"customer_id": sk60("email"), "city_id": city_id()})
    else:
        table = table.join(places, on=place, how="left").withColumn("customer_id", sk60("email", "city_id"))
    return table.withColumns({"customer_src_id": md5_key("email"), "source_system": F.lit(ONLINE)}).select(*CUSTOMER_COLUMNS)


METHOD_KEY = ("payment_method", "payment_provider")


def payment_methods(lines: DataFrame) -> DataFrame:
    table = source_dictionary(lines, list(METHOD_KEY))
    return table.select(sk60(*METHOD_KEY).alias("method_id"), *METHOD_KEY, "source_system")


def employee_changes(lines: DataFrame) -> DataFrame:
    """Employee attributes as seen on each shop line, sequenced by order date."""
    return channel(lines, OFFLINE).select(
        "employee_src_id",
        F.col("employee_first_name").alias("first_name"),
        F.col("employee_last_name").alias("last_name"),
        F.col("employee_gender").alias("gender"),
        "monthly_salary",
        "store_src_id",
        F.col("order_date").alias("update_dt"),
    )


EMPLOYEE_KEYS = ["employee_src_id"]
EMPLOYEE_TRACK = ["store_src_id", "monthly_salary", "first_name", "last_name", "gender"]


def employee_versions(changes: DataFrame) -> DataFrame:
    return scd2(changes, EMPLOYEE_KEYS, "update_dt", EMPLOYEE_TRACK, except_cols=("insert_dt",))


def employee_history(versions: DataFrame) -> DataFrame:
    """Versions in the declared table layout; ``insert_dt`` is excluded from tracking and stays empty."""
    table = versions.select(
        "employee_src_id", "first_name", "last_name", "gender", "monthly_salary",
        F.col("store_src_id").cast("string").alias("store_src_id"),
        F.col("start_at").alias("update_dt"),
        F.lit(None).cast("timestamp_ntz").alias("insert_dt"),
        F.col("start_at").alias("__START_AT"),
        F.col("end_at").alias("__END_AT"),
    )
    return checked(table, EMPLOYEE_HISTORY_DDL)


def order_headers(lines: DataFrame, *also: Column) -> DataFrame:
    """One header per channel and order number: that of the earliest, then smallest, line.

    ``also``: further aggregates over the lines of the order, computed in the same pass.
    """
    keys = ["source_system", "order_src_id_raw"]
    # order hash and entity follow from the key, so they need not travel through the shuffle
    fields = ["order_date"] + [c for c in HEADER if c not in (*keys, "order_date", "order_src_id", "source_entity")]
    headers = lines.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_row"), *also)
    return headers.select("*", "_row.*").drop("_row").withColumns(
        {
            "order_src_id": md5_key(*keys),
            "source_entity": F.when(F.col("source_system") == ONLINE, ONLINE_TABLE).otherwise(OFFLINE_TABLE),
        }
    )


def order_ids() -> dict:
    """Foreign keys a header or line can compute from its own columns."""
    return {
        "order_id": F.when(F.col("order_src_id").isNotNull(), xx_key("order_src_id", "source_system")),
        "customer_id": F.when(F.col("source_system") == ONLINE, fk60("email")),
        "store_id": F.when(
            (F.col("source_system") == OFFLINE) & F.col("store_src_id").isNotNull(), sk60(*STORE_KEY)
        ),
    }


def orders(headers: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order table from deduplicated headers, batch or stream; no join. ``keep`` adds header columns."""
    ids = order_ids()
    # a header without order number keeps an id of its own, which no line refers to
    ids["order_id"] = xx_key("order_src_id", "source_system")
    return headers.withColumns(ids).select(*ORDER_COLUMNS, *keep)


def orders_joined(headers: DataFrame, customer: DataFrame, store: DataFrame) -> DataFrame:
    """Order table that looks its customer and shop up by their source keys, batch or stream.

    Offline orders have no email and online orders no shop, half of all rows each; they are scattered over dead keys
    instead of meeting in one task. Several customers or shops of one key give a row each, as the literal rules have it.
    """
    buyers = customer.select("customer_id", join_key(F.trim("email")).alias("_buyer")).filter("_buyer is not null")
    shops = store.select("store_id", join_key("store_src_id").alias("_shop")).filter("_shop is not null")
    keyed = headers.withColumns(
        {
            "_buyer": spread_nulls(join_key("email"), "source_system", "order_src_id_raw"),
            "_shop": spread_nulls(join_key("store_src_id"), "source_system", "order_src_id_raw"),
        }
    )
    return (
        keyed.join(buyers, on="_buyer", how="left")
        .join(shops, on="_shop", how="left")
        .withColumn("order_id", xx_key("order_src_id", "source_system"))
        .select(*ORDER_COLUMNS)
    )


def _item_id():
    return xx_key("order_src_id", "product_name", "sales", "quantity")


def orders_items(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line; no join. ``keep`` adds line columns to the table."""
    ids = {
        "order_item_id": _item_id(),
        "order_id": order_ids()["order_id"],
        "product_id": fk60(*PRODUCT_PATH),
    }
    return lines.withColumns(ids).select(*ITEM_COLUMNS, *keep)


def orders_items_joined(
    lines: DataFrame, product: DataFrame, orders: DataFrame, on: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per line and matching order, product looked up by ``on``, batch or stream.

    ``product`` must be unique on ``on``; use ``dedup`` before a lookup by name alone.
    """
    return (
        lines.join(product.select("product_id", *on), on=on, how="left")
        .join(orders.select("order_id", "order_src_id"), on="order_src_id", how="left")
        .withColumn("order_item_id", _item_id())
        .select(*ITEM_COLUMNS, *keep)
    )


def payment_keys(lines: DataFrame) -> DataFrame:
    keyed = lines.withColumns(
        {"payment_src_id": md5_key("source_system", "payment_id_raw"), "payment_amount": F.col("sales")}
    )
    return keyed.withColumn("payment_id", xx_key("payment_src_id", "order_src_id"))


def payment(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line; no join."""
    ids = {"order_id": order_ids()["order_id"], "method_id": fk60(*METHOD_KEY, required=2)}
    return payment_keys(lines).withColumns(ids).select(*PAYMENT_COLUMNS, *keep)


def payment_joined(
    lines: DataFrame, methods: DataFrame, orders: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per line and matching order, method looked up by both its names, batch or stream."""
    keyed = lookup(payment_keys(lines), methods, list(METHOD_KEY), ["method_id"], unique=True)
    return keyed.join(orders.select("order_id", "order_src_id"), on="order_src_id", how="left").select(
        *PAYMENT_COLUMNS, *keep
    )


def silver(lines: DataFrame, rules: Rules = PATH) -> dict[str, DataFrame]:
    """All normalized tables as lazy frames, audit columns included."""
    products = hierarchy(lines, PRODUCT_LEVELS, rules)
    places = hierarchy(lines, GEOGRAPHY_LEVELS, rules)
    near = None if rules.by_path else city_state_lookup(places["city"], places["state"])
    tables = {
        "categories": products["category"],
        "sub_categories": products["sub_category"],
        "products": products["product"],
        **places,
        "store": store(lines, rules, near),
        "customer": customer(lines, rules, near),
        "payment_methods": payment_methods(lines),
    }
    headers = order_headers(lines)
    if rules.by_path:
        tables["orders"] = orders(headers)
        tables["orders_items"] = orders_items(lines, ("order_src_id",))
        tables["payment"] = payment(lines, ("order_src_id",))
    else:
        by_name = dedup(tables["products"].select("product_name", "product_id"), ["product_name"])
        tables["orders"] = orders_joined(headers, tables["customer"], tables["store"])
        tables["orders_items"] = orders_items_joined(lines, by_name, tables["orders"], ["product_name"], ("order_src_id",))
        tables["payment"] = payment_joined(lines, tables["payment_methods"], tables["orders"], ("order_src_id",))
    tables = {name: with_audit(df) for name, df in tables.items()}
    tables["employee_history"] = employee_history(employee_versions(employee_changes(lines)))
    return tables
