"""The whole pipeline: landing folders to bronze, silver and gold tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillhouse.functions.clean import with_audit
from tillhouse.functions.fixed import (
    OFFLINE,
    OFFLINE_FILES_PER_TRIGGER,
    OFFLINE_TABLE,
    ONLINE,
    ONLINE_FILES_PER_TRIGGER,
    ONLINE_TABLE,
    TABLE_PROPERTIES,
)
from tillhouse.functions.keys import key_exceptions
from tillhouse.operators.dictionary import source_dictionary
from tillhouse.operators.lookup import require_unique
from tillhouse.plans.clashes import distinct_keys, load, resolve
from tillhouse.plans.fact_table import MONTH, FactTable
from tillhouse.plans.gold import audited, dimensions
from tillhouse.plans.lines import HEADER, channel, sales_lines
from tillhouse.plans.silver import (
    CITY_PATH,
    CUSTOMER_ATTRIBUTES,
    EMPLOYEE_KEYS,
    EMPLOYEE_TRACK,
    GEOGRAPHY_LEVELS,
    LEVELS,
    METHOD_KEY,
    PRODUCT_LEVELS,
    PRODUCT_PATH,
    STORE_KEY,
    customer,
    employee_changes,
    employee_history,
    hierarchy,
    orders,
    orders_items,
    payment,
    payment_methods,
    store,
)
from tillhouse.sources.channels import OFFLINE_CSV, ONLINE_CSV
from tillhouse.sources.csv_files import RESCUED, bronze_schema, infer_schema, ingest_csv, zone_free
from tillhouse.sources.storage import exists, finished_scratch, name_folder, publish, read_table, read_table_stream, stored
from tillhouse.streaming.cdc import ChangeTable, FoldTable
from tillhouse.streaming.cells import name_cells
from tillhouse.streaming.headers import HeaderTable
from tillhouse.streaming.history import VersionTable
from tillhouse.streaming.refresh import CONTINUOUS, TRIGGERED, Running, append_to, merge_into, side_by_side

PRODUCT_TABLES = ["categories", "sub_categories", "products"]
DIMENSIONS = ["customer", "employee", "store", "product", "payment_method", "date"]
COMMENTS = {
    ONLINE_TABLE: "Sales lines of the online shop as they arrived",
    OFFLINE_TABLE: "Sales lines of the physical shops as they arrived",
    "orders": "Order headers of both channels",
    "orders_items": "Order lines of both channels",
    "payment": "Payments of both channels, one per line",
    "categories": "Product categories of both channels",
    "sub_categories": "Product sub-categories of both channels",
    "products": "Products of both channels",
    "country": "Countries of both channels",
    "region": "Regions of both channels",
    "state": "States of both channels",
    "city": "Cities of both channels",
    "store": "Physical shops",
    "customer": "Customers of the online shop, latest attributes only",
    "payment_methods": "Payment methods of both channels",
    "employee_history": "Employee versions by order date",
    "dim_customer": "Customers with their geography, latest attributes only",
    "dim_employee": "Employee versions",
    "dim_store": "Shops with their geography",
    "dim_product": "Products with their category hierarchy",
    "dim_payment_method": "Payment methods of both channels",
    "dim_date": "Days between the first and the last order",
    "fact_sales": "Sales, one row per order line",
}
STREAMED = ["orders_items", "payment"]
#: Batches of changes after which their log is folded.
COMPACT_AFTER = 32
#: Columns that must name one row of a dimension.
UNIQUE_KEYS = {
    "customer": "customer_sk", "employee": "employee_sk", "store": "store_sk", "product": "product_sk",
    "payment_method": "payment_method_sk", "date": "date_sk",
}


#: Line columns kept in the streamed facts, so that they are joined on the full order hash, never on a 64-bit one.
_FULL_KEY = ("order_src_id",)


def _shops(rows: DataFrame) -> DataFrame:
    return channel(rows, OFFLINE).select("source_system", *STORE_KEY).distinct()


def _buyers(rows: DataFrame) -> DataFrame:
    """The latest row of each e-mail address; the missing address is one of them."""
    row = F.max(F.struct("order_date", *CUSTOMER_ATTRIBUTES, *CITY_PATH)).alias("_row")
    return channel(rows, ONLINE).groupBy("source_system", "email").agg(row).select("source_system", "email", "_row.*")


#: Keys and folds of what is kept of the lines for the dictionaries.
FOLDS = {
    "product_paths": (PRODUCT_PATH, partial(source_dictionary, keys=list(PRODUCT_PATH))),
    "city_paths": (CITY_PATH, partial(source_dictionary, keys=list(CITY_PATH))),
    "methods": (METHOD_KEY, partial(source_dictionary, keys=list(METHOD_KEY))),
    "shops": (STORE_KEY, _shops),
    "buyers": (("email",), _buyers),
}


@dataclass(frozen=True)
class Warehouse:
    """One generation of the warehouse under ``root``.

    Calling :meth:`refresh` again takes in what is new (triggered refresh). A full refresh is a new ``root``: all
    input is read again and the named tables move over to it.

    A channel whose schema is None gets the types inferred from all files of its first intake; they are kept with the
    warehouse, and what contradicts them later is rescued.
    """

    spark: SparkSession
    online_dir: str
    offline_dir: str
    root: str
    online_schema: StructType | None = ONLINE_CSV
    offline_schema: StructType | None = OFFLINE_CSV
    online_files: int = ONLINE_FILES_PER_TRIGGER
    offline_files: int = OFFLINE_FILES_PER_TRIGGER
    #: Cells of the employee history: few large ones; take shorter slices and more buckets for longer histories.
    history_slice: str = "year"
    history_buckets: int = 4

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _schema(self, table: str) -> StructType:
        """Declared columns of a channel, or the inferred ones."""
        declared = self.online_schema if table == ONLINE_TABLE else self.offline_schema
        if declared is not None:
            return declared
        kept = f"{self.root}/schemas/{table}"
        if not exists(self.spark, f"{kept}/_SUCCESS"):
            inferred = zone_free(infer_schema(self.spark, self.online_dir if table == ONLINE_TABLE else self.offline_dir))
            self.spark.createDataFrame([(inferred.json(),)], "value string").coalesce(1).write.mode("overwrite").text(kept)
        return StructType.fromJson(json.loads(self.spark.read.text(kept).first()[0]))

    def _ingesting(self, mode: str = TRIGGERED, interval: str = "1 minute") -> dict[str, Callable[[], StreamingQuery]]:
        """Landing files to bronze, each file once."""
        channels = [(ONLINE_TABLE, self.online_dir, self.online_files), (OFFLINE_TABLE, self.offline_dir, self.offline_files)]
        return {
            table: partial(
                ingest_csv, self.spark, folder, self._schema(table), self.path("bronze", table), self._checkpoint(table), files, mode, interval
            )
            for table, folder, files in channels
        }

    def ingest(self) -> None:
        side_by_side(self._ingesting().values())

    def _bronze_schema(self, table: str) -> StructType:
        return bronze_schema(self.spark, self._schema(table))

    def _bronze(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path("bronze", table), self._bronze_schema(table))

    def lines(self) -> DataFrame:
        """Snapshot of all lines taken in so far."""
        return sales_lines(self._bronze(ONLINE_TABLE), self._bronze(OFFLINE_TABLE))

    def line_stream(self) -> DataFrame:
        """All lines as a stream."""
        streams = [
            read_table_stream(self.spark, self.path("bronze", table), self._bronze_schema(table))
            for table in (ONLINE_TABLE, OFFLINE_TABLE)
        ]
        return sales_lines(*streams)

    def rescued(self) -> DataFrame:
        """Lines of both channels that did not fit, with what was rescued of them: table, file_path, _rescued_data."""
        kept = [self._bronze(t).select(F.lit(t).alias("table"), "file_path", RESCUED) for t in (ONLINE_TABLE, OFFLINE_TABLE)]
        return kept[0].unionByName(kept[1]).filter(F.col(RESCUED).isNotNull())

    def headers(self) -> HeaderTable:
        return HeaderTable(self.path("silver", "order_headers"), schema=self.lines().select(*HEADER).schema)

    def history(self) -> VersionTable:
        changes = employee_changes(self.lines()).schema
        return VersionTable(
            self.path("silver", "employee_changes"), EMPLOYEE_KEYS, "update_dt", schema=changes, track=EMPLOYEE_TRACK,
            time_slice=self.history_slice, buckets=self.history_buckets,
        )

    def folded(self) -> dict[str, FoldTable]:
        """What dictionaries need of the lines, kept up batch by batch."""
        schema = self.lines().schema
        return {
            name: FoldTable(self.path("silver", f"{name}_log"), list(keys), schema=schema, fold=fold)
            for name, (keys, fold) in FOLDS.items()
        }

    def _processing(self, mode: str = TRIGGERED, interval: str = "1 minute") -> dict[str, Callable[[], StreamingQuery]]:
        """New lines to order items, payments, order headers and employee history."""
        out: dict[str, Callable[[], StreamingQuery]] = {}
        for name, df in self._streamed(self.line_stream()).items():
            out[name] = partial(append_to, df, self.path("silver", name), self._checkpoint(name), mode, interval)
        kept_up = {
            "orders": (self.line_stream().select(*HEADER), self.headers()),
            "employee_history": (employee_changes(self.line_stream()), self.history()),
        }
        for name, (df, table) in kept_up.items():
            out[name] = partial(merge_into, df, partial(self._keep_up, [table]), self._checkpoint(name), mode, interval)
        return out

    def _folding(self, mode: str = TRIGGERED, interval: str = "1 minute") -> dict[str, Callable[[], StreamingQuery]]:
        """New lines to dictionaries; these know all keys before a fact has them."""
        folds = partial(self._keep_up, list(self.folded().values()))
        return {"dictionaries": partial(merge_into, self.line_stream(), folds, self._checkpoint("dictionaries"), mode, interval)}

    def stream_facts(self) -> None:
        side_by_side(self._folding().values())
        with key_exceptions(self._resolve()):
            side_by_side(self._processing().values())

    def start(self, interval: str = "1 minute") -> Running:
        """Take in files for as long as it runs; :meth:`publish_all` brings the named tables up to date at any time.

        A key that clashes with an older one while this runs fails the check of its dimension when published; a restart
        does not help its facts, only a new root does.
        """
        with key_exceptions(self._resolve()):
            work = {**self._folding(CONTINUOUS, interval), **self._processing(CONTINUOUS, interval)}
        return Running({**self._ingesting(CONTINUOUS, interval), **work})

    def _keep_up(self, tables: list[ChangeTable], batch: DataFrame, batch_id: int) -> None:
        def one(table: ChangeTable) -> None:
            table.merge(batch, batch_id)
            if batch_id % COMPACT_AFTER == COMPACT_AFTER - 1:
                table.compact(self.spark)

        side_by_side(partial(one, table) for table in tables)

    def _natural_keys(self, upto: int | None = None) -> list[DataFrame]:
        """Distinct natural keys of all tables with surrogates, as folded so far or up to a batch."""
        logs = {n: t.read(self.spark) if upto is None else t.upto(self.spark, upto) for n, t in self.folded().items()}
        levels = [(level, logs["product_paths"]) for level in PRODUCT_LEVELS] + [(level, logs["city_paths"]) for level in GEOGRAPHY_LEVELS]
        found = [distinct_keys(level, rows, list(LEVELS[level].path)) for level, rows in levels]
        named = [("store", "shops", STORE_KEY), ("customer", "buyers", ("email",)), ("payment_method", "methods", METHOD_KEY)]
        return found + [distinct_keys(kind, logs[log], list(keys)) for kind, log, keys in named]

    def _resolve(self) -> dict[str, int]:
        """Give keys that clash with older ones a surrogate of their own, before any fact has it."""
        path, seen = f"{self.root}/keys/exceptions", f"{self.root}/keys/checked"
        log = self.folded()["product_paths"]
        now, last = log.last_batch(self.spark), None
        if now is None:
            return {}
        if exists(self.spark, f"{seen}/_SUCCESS"):
            last = self.spark.read.schema("batch bigint").parquet(seen).first()["batch"]
        if last == now:
            return load(self.spark, path)
        found = resolve(self._natural_keys(), [] if last is None else self._natural_keys(last), path)
        self.spark.range(1).select(F.lit(now).cast("bigint").alias("batch")).write.mode("overwrite").parquet(seen)
        return found

    def _streamed(self, lines: DataFrame) -> dict[str, DataFrame]:
        return {"orders_items": with_audit(orders_items(lines, _FULL_KEY)), "payment": with_audit(payment(lines, _FULL_KEY))}

    def orders(self) -> DataFrame:
        """Orders of all lines taken in so far."""
        return orders(self.headers().read(self.spark))

    def dictionaries(self) -> dict[str, DataFrame]:
        """Silver tables of distinct things, from the folded logs: bronze is not read again.

        Each hierarchy is kept for its deepest level; the levels above are rolled up from that.
        """
        logs = {name: table.read(self.spark) for name, table in self.folded().items()}
        goods = hierarchy(stored(logs["product_paths"], "product-paths"), PRODUCT_LEVELS)
        return {
            "categories": goods["category"],
            "sub_categories": goods["sub_category"],
            "products": goods["product"],
            **hierarchy(stored(logs["city_paths"], "city-paths"), GEOGRAPHY_LEVELS),
            "store": store(logs["shops"]),
            "customer": customer(logs["buyers"]),
            "payment_methods": payment_methods(logs["methods"]),
        }

    def employee_history(self) -> DataFrame:
        """Versions from the change log taken in so far."""
        return employee_history(self.history().read(self.spark))

    def _publish(self, layer: str, name: str, df: DataFrame, balanced: bool = True, check=None) -> None:
        path = self.path(layer, name)
        publish(df, f"{layer}.{name}", path, COMMENTS.get(name), TABLE_PROPERTIES[layer], balanced, check)

    def silver(self) -> dict[str, DataFrame]:
        """All silver tables as stored."""
        names = [*PRODUCT_TABLES, *GEOGRAPHY_LEVELS, "store", "customer", "payment_methods", "employee_history", "orders"]
        return {name: self.spark.read.table(f"silver.{name}") for name in [*names, *STREAMED]}

    def _name_streamed(self) -> None:
        """Names, comments and properties of the tables that streams append to."""
        lines = self.lines()
        schemas = {("bronze", t): self._bronze_schema(t) for t in (ONLINE_TABLE, OFFLINE_TABLE)}
        schemas |= {("silver", name): df.schema for name, df in self._streamed(lines).items()}
        for (layer, name), schema in schemas.items():
            name_folder(self.spark, f"{layer}.{name}", self.path(layer, name), schema, COMMENTS[name], TABLE_PROPERTIES[layer])

    def refresh(self) -> dict[str, DataFrame]:
        """Take in new files and bring every table up to date. Returns the gold tables."""
        with finished_scratch(self.spark):
            self.ingest()
            self.stream_facts()
            return self.publish_all()

    def publish_all(self) -> dict[str, DataFrame]:
        """Every table from what has been taken in so far. A key that names two rows stops the move of its table."""
        path = f"{self.root}/keys/exceptions"
        with key_exceptions(load(self.spark, path)):
            versions = distinct_keys("employee", self.employee_history(), ["employee_src_id", "__START_AT"])
        with key_exceptions(resolve([versions], [], path)):
            return self._publish_all()

    def _publish_all(self) -> dict[str, DataFrame]:
        for layer in ("bronze", "silver", "gold"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        self._name_streamed()
        headers = self.headers()
        upto = headers.last_batch(self.spark)
        work = [partial(self._publish, "silver", name, with_audit(df)) for name, df in self.dictionaries().items()]
        work.append(partial(self._publish, "silver", "employee_history", self.employee_history()))
        work.append(partial(self._publish, "silver", "orders", with_audit(self.orders()), balanced=False))
        side_by_side(work)
        tables = self.silver()
        side_by_side(
            partial(self._publish, "gold", f"dim_{name}", audited(name, df), check=partial(require_unique, key=UNIQUE_KEYS[name]))
            for name, df in dimensions(tables).items()
        )
        store, months = FactTable(self.path("gold", "fact_sales")).refresh(tables, self.spark.read.table("gold.dim_employee"), headers, upto)
        name_cells(self.spark, "gold.fact_sales", store, months, COMMENTS["fact_sales"], TABLE_PROPERTIES["gold"])
        star = {f"dim_{d}": self.spark.read.table(f"gold.dim_{d}") for d in DIMENSIONS}
        return star | {"fact_sales": store.read(self.spark).drop(MONTH)}
