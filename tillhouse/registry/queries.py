"""Registered queries: every operator and table over the whole test tables, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.functions.clean import harmonize, normalize_headers, tag, with_audit
from tillhouse.functions.fixed import AMOUNT, COUNTRY_NAMES, OFFLINE, OFFLINE_TABLE, ONLINE, SALARY, TABLE_PROPERTIES
from tillhouse.functions.keys import md5_key, sk60, xx_key
from tillhouse.operators.calendar import date_bounds, safe_date
from tillhouse.operators.cdc import current, scd1, scd2
from tillhouse.operators.dedup import dedup
from tillhouse.operators.dictionary import source_dictionary, union_sources
from tillhouse.operators.lookup import lookup, lookup_path
from tillhouse.plans import eda, gold, silver
from tillhouse.plans.bucketed import joined_buckets, write_buckets
from tillhouse.plans.lines import HEADER, channel, sales_lines
from tillhouse.plans.rules import LEAF, PATH, Rules
from tillhouse.plans.warehouse import Warehouse
from tillhouse.sources import fixture
from tillhouse.sources.channels import OFFLINE_CSV, ONLINE_CSV
from tillhouse.sources.csv_files import (
    RESCUED,
    bronze,
    bronze_schema,
    infer_schema,
    ingest_csv,
    read_csv,
    read_csv_stream,
    split_rescued,
    with_lineage,
    write_csv,
)
from tillhouse.sources.storage import (
    finished_scratch,
    little_disk,
    publish,
    read_table,
    read_table_stream,
    remove,
    scratch,
    stored,
    write_clustered,
)
from tillhouse.streaming.cdc import CurrentTable, HistoryTable
from tillhouse.streaming.dedup import dedup_stream
from tillhouse.streaming.enrich import enrich_stream
from tillhouse.streaming.headers import HeaderTable
from tillhouse.streaming.history import VersionTable
from tillhouse.streaming.late import BoundedDedup
from tillhouse.streaming.refresh import append_to, merge_into, side_by_side

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_ORDER_KEYS = ["customer_id", "store_id"]
_FACT_KEYS = ["customer_sk", "employee_sk", "store_sk"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- inputs


def _lines(spark: SparkSession, sf_dir: str, rules: Rules = PATH) -> DataFrame:
    return sales_lines(fixture.online(spark, sf_dir), fixture.offline(spark, sf_dir), rules)


def _raw_headers(df: DataFrame, schema: StructType) -> DataFrame:
    """Bronze columns under the headers their CSV files carry."""
    names = {n.translate(str.maketrans(" -", "__")).lower(): n for n in schema.names}
    renamed = df.withColumnsRenamed({c: names[c.lower()] for c in df.columns})
    return renamed.select(*schema.names)


def _batches(spark: SparkSession, sf_dir: str, batches: int, files: int) -> tuple[int, int]:
    """Files a channel is dealt over, and files per batch: as many batches whatever the size, files that do not grow."""
    per_batch = max(files, -(-fixture.tasks(spark, sf_dir) // batches))
    return batches * per_batch, per_batch


def _landing(df: DataFrame, schema: StructType, name: str, files: int | None) -> str:
    """CSV files of a channel; ``files`` is None for rows that are dealt out already."""
    return write_csv(_raw_headers(df, schema), scratch(df.sparkSession, name), files, compression="gzip")


def _bronze_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as a stream over stored bronze tables of several files, in two batches."""
    streams = []
    files, per_batch = _batches(spark, sf_dir, 2, 2)
    for name, make in (("online", fixture.online), ("offline", fixture.offline)):
        path = scratch(spark, f"bronze-{name}")
        frame = make(spark, sf_dir, files)
        with little_disk(spark):
            frame.write.parquet(path)
        streams.append(read_table_stream(spark, path, frame.schema, per_batch))
    return sales_lines(*streams)


def _through_stream(df: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end and read what it wrote."""
    spark = df.sparkSession
    path, checkpoint = scratch(spark, name), scratch(spark, f"{name}-checkpoint")
    append_to(df, path, checkpoint)
    return spark.read.schema(df.schema).parquet(path)


def _ingested(spark: SparkSession, folder: str, schema: StructType, max_files: int) -> DataFrame:
    """Bronze rows of a landing folder, taken in as a stream."""
    out = scratch(spark, "ingested")
    ingest_csv(spark, folder, schema, out, scratch(spark, "ingested-checkpoint"), max_files)
    return read_table(spark, out, bronze_schema(spark, schema))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.table(spark, sf_dir, "events")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _events(spark, sf_dir).schema
    return read_table_stream(spark, sf_dir, schema, glob="events.parquet")


def _places(lines: DataFrame) -> dict[str, DataFrame]:
    """Geography tables, rolled up from one stored pass over the lines."""
    paths = stored(source_dictionary(lines, list(silver.CITY_PATH)), "city-paths")
    return silver.hierarchy(paths, silver.GEOGRAPHY_LEVELS)


def _flat_places(lines: DataFrame) -> DataFrame:
    places = _places(lines)
    return gold.flat_geography(*[places[name] for name in ("city", "state", "region", "country")])


def _goods(lines: DataFrame) -> dict[str, DataFrame]:
    paths = stored(source_dictionary(lines, list(silver.PRODUCT_PATH)), "product-paths")
    return silver.hierarchy(paths, silver.PRODUCT_LEVELS)


def _employees(lines: DataFrame) -> DataFrame:
    history = silver.employee_history(silver.employee_versions(silver.employee_changes(lines)))
    return gold.dim_employee(history)


def _text_keys(df: DataFrame, *names: str) -> DataFrame:
    """Nullable 60-bit keys as text, so that no reader of the result turns them into floats."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


# ---------------------------------------------------------------- sources


@query
def bronze_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, _ = _batches(spark, sf_dir, 2, 2)
    path = _landing(fixture.online(spark, sf_dir), ONLINE_CSV, "landing-online", files)
    return _ingested(spark, path, ONLINE_CSV, 1000).drop(RESCUED, "file_path", "ingestion_datetime")


@query
def bronze_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, _ = _batches(spark, sf_dir, 2, 2)
    path = _landing(fixture.offline(spark, sf_dir), OFFLINE_CSV, "landing-offline", files)
    return _ingested(spark, path, OFFLINE_CSV, 100).drop(RESCUED, "file_path", "ingestion_datetime")


@query
def csv_header_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with columns in another order, missing and undeclared, read by name; as a batch and as a stream."""
    rows = fixture.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch(spark, "header-order")
    write_csv(rows.filter("o_orderstatus = 'O'").select("o_orderpriority", "o_orderkey", "o_orderstatus"), f"{path}/a")
    write_csv(rows.filter("o_orderstatus = 'F'").select(F.lit("x").alias("note"), "*"), f"{path}/b")
    write_csv(rows.filter("o_orderstatus = 'P'").select("o_orderpriority", "o_orderkey"), f"{path}/c")
    batch = read_csv(spark, path, rows.schema)
    streamed = _ingested(spark, path, rows.schema, 2).select(*batch.columns)
    return batch.withColumn("mode", F.lit("batch")).unionByName(streamed.withColumn("mode", F.lit("stream")))


@query
def csv_dialect_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text, full of quotes, written and read with doubled quotes."""
    rows = _events(spark, sf_dir).select("event_id", "event_type", "props")
    path = write_csv(rows, scratch(spark, "dialect"))
    return read_csv(spark, path, rows.schema).drop(RESCUED)


@query
def csv_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in a number column: the field is lost, the raw line kept."""
    quantity = F.when(F.col("l_returnflag") == "R", "unknown").otherwise(F.col("l_quantity").cast("int").cast("string"))
    rows = fixture.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", quantity.alias("l_quantity"))
    path = write_csv(rows, scratch(spark, "permissive"))
    schema = StructType.fromDDL("l_returnflag STRING, l_orderkey BIGINT, l_quantity INT")
    return (
        read_csv(spark, path, schema)
        .groupBy("l_returnflag")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("l_orderkey").alias("n_keys"),
            F.count("l_quantity").alias("n_quantities"),
            F.count(RESCUED).alias("n_rescued"),
        )
    )


@query
def csv_rescue_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with an undeclared extra field: its text is retained, the schema stays."""
    rows = fixture.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch(spark, "rescue")
    late = F.col("o_orderstatus") == "P"
    write_csv(rows.filter(~late), f"{path}/part=1")
    write_csv(rows.filter(late).withColumn("note", F.lit("late")), f"{path}/part=2")
    good, quarantine = split_rescued(read_csv(spark, path, rows.schema).drop("part"))
    return good.withColumns({RESCUED: F.lit(None).cast("string"), "kind": F.lit("good")}).unionByName(
        quarantine.withColumn("kind", F.lit("quarantine"))
    )


@query
def csv_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred types per column, with the values read under them."""
    path = write_csv(fixture.table(spark, sf_dir, "customer"), scratch(spark, "infer"))
    schema = infer_schema(spark, path)
    rows = read_csv(spark, path, schema).drop(RESCUED)
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    described = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n"))
        for f in schema
    ]
    return counts.select(F.inline(F.array(*described)))


@query
def csv_infer_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types over files whose headers differ in order, columns and values, with the values read under them."""
    rows = fixture.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    path = scratch(spark, "infer-by-name")
    write_csv(rows.filter("o_orderkey % 2 = 0"), f"{path}/a")
    big = F.col("o_orderkey").cast("bigint") * 3_000_000_000
    write_csv(rows.filter("o_orderkey % 2 = 1").select("day", F.lit("late").alias("note"), big.alias("O_ORDERKEY"), "o_custkey"), f"{path}/b")
    schema = infer_schema(spark, path)
    counts = read_csv(spark, path, schema).agg(*[F.count(c).alias(c) for c in schema.names])
    described = [
        F.struct(F.lit(f.name.lower()).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n")) for f in schema
    ]
    return counts.select(F.inline(F.array(*described)))


@query
def ingest_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight files taken in two at a time."""
    rows = _events(spark, sf_dir).select("event_id", "event_type")
    path = write_csv(rows, scratch(spark, "limited"), files=8)
    stream = with_lineage(read_csv_stream(spark, path, rows.schema, max_files=2))
    out = scratch(spark, "limited-batches")

    def note(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("file_path").count().write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    merge_into(stream, note, scratch(spark, "limited-checkpoint"))
    per_batch = spark.read.parquet(out).groupBy("batch").agg(F.count("*").alias("files"), F.sum("count").alias("rows"))
    return per_batch.agg(
        F.count("*").alias("n_batches"), F.max("files").alias("most_files"), F.sum("rows").alias("n_rows")
    )


@query
def normalize_headers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"),
        F.col("o_orderstatus").alias("order-status"),
        F.col("o_orderpriority").alias("order-priority code"),
    )
    path = write_csv(rows, scratch(spark, "headers"))
    return normalize_headers(read_csv(spark, path, rows.schema).drop(RESCUED))


QUERIES["normalize_headers"] = QUERIES.pop("normalize_headers_query")


@query
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = write_csv(rows, scratch(spark, "lineage"), files=3)
    traced = bronze(read_csv(spark, path, rows.schema))
    return traced.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("file_path").contains("lineage-") & F.col("file_path").endswith(".csv")).alias("n_with_file"),
        F.count("ingestion_datetime").alias("n_with_time"),
        (F.min("ingestion_datetime") == F.max("ingestion_datetime")).alias("one_instant"),
    )


@query
def stream_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_stream(_event_stream(spark, sf_dir), "events")


@query
def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table: its comment and properties, with its row count."""
    name = f"tillhouse_{uuid.uuid4().hex}"
    frame = silver.payment_methods(_lines(spark, sf_dir))
    publish(frame, name, scratch(spark, name), "methods of both channels", TABLE_PROPERTIES["silver"])
    listed = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").isin("quality", "layer"))
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Comment")
    comment = described.select(F.lit("comment").alias("key"), F.col("data_type").alias("value"))
    rows = spark.read.table(name).agg(F.count("*").alias("n_rows"))
    return listed.select("key", "value").unionByName(comment).withColumn("n_rows", rows.scalar())


@query
def employee_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temporary view over a stream, read by SQL."""
    view = f"employee_changes_{uuid.uuid4().hex}"
    silver.employee_changes(_bronze_streams(spark, sf_dir)).createOrReplaceTempView(view)
    return _through_stream(spark.sql(f"SELECT * FROM {view}"), "employee-changes")


# ---------------------------------------------------------------- projections and functions


@query
def tag_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["Order_ID", "payment_id"]
    online = tag(fixture.online(spark, sf_dir).select(*names), ONLINE)
    offline = tag(fixture.offline(spark, sf_dir).select(*names), OFFLINE, OFFLINE_TABLE)
    return online.unionByName(offline, allowMissingColumns=True)


@query
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_audit(silver.orders_items(_lines(spark, sf_dir)))
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count("insert_dt").alias("n_inserted"),
        F.count("update_dt").alias("n_updated"),
        F.count_if(F.col("insert_dt") == F.col("update_dt")).alias("n_equal"),
    )


@query
def fn_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture.online(spark, sf_dir).select("customer_email", "City").distinct()
    tabbed = F.concat(F.lit("\t "), "City")
    return rows.select(
        "customer_email", "City", F.trim("customer_email").alias("email"), F.trim("City").alias("city_name"),
        F.trim(tabbed).alias("tabbed"),
    )


@query
def harmonize_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    online = fixture.online(spark, sf_dir).select(F.col("Country").alias("raw"))
    offline = fixture.offline(spark, sf_dir).select(F.col("store_country").alias("raw"))
    rows = union_sources({ONLINE: online, OFFLINE: offline})
    return rows.groupBy("source_system", "raw", harmonize("raw", COUNTRY_NAMES).alias("country_name")).agg(
        F.count("*").alias("n_rows")
    )


@query
def fn_md5_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.table(spark, sf_dir, "part").select(
        "p_partkey", md5_key("p_name").alias("name_key"), md5_key("p_partkey").alias("number_key")
    )


@query
def fn_md5_concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return fixture.table(spark, sf_dir, "part").select(
        "p_partkey", md5_key("p_name", "p_brand").alias("pair_key"), md5_key("p_name", nothing).alias("gap_key")
    )


@query
def fn_xxhash64_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return lines.select(
        "order_src_id_raw", "payment_id_raw", "source_system", "sales",
        xx_key("order_src_id", "source_system").alias("order_id"),
        xx_key(md5_key("source_system", "payment_id_raw"), "order_src_id").alias("payment_id"),
        xx_key("order_src_id", "product_name", "sales", "quantity").alias("order_item_id"),
    )


@query
def fn_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return fixture.table(spark, sf_dir, "part").select(
        "p_partkey",
        sk60("p_partkey").alias("number_sk"),
        sk60("p_type", "p_brand", "p_name").alias("path_sk"),
        sk60("p_type", small).alias("gap_sk"),
    )


@query
def fn_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe casts of text: what does not fit becomes NULL, decimals round half up."""
    rank = F.substring("o_orderpriority", 1, 1)
    fine = F.concat(F.col("o_orderkey").cast("string"), F.lit(".00005"))
    return fixture.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        rank.try_cast("int").alias("rank"),
        F.col("o_orderpriority").try_cast("int").alias("no_number"),
        fine.try_cast(AMOUNT).alias("amount"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".129")).try_cast(SALARY).alias("salary"),
        F.concat(F.lit("123456789"), F.col("o_orderkey").cast("string")).try_cast(SALARY).alias("overflow"),
        F.col("o_orderkey").cast("string").alias("as_text"),
    )


@query
def fn_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        safe_date("o_orderdate").alias("from_timestamp"),
        F.col("o_orderdate").cast("string").try_cast("date").alias("from_text"),
        safe_date("o_orderpriority").alias("from_noise"),
    )


# ---------------------------------------------------------------- dictionaries, lookups, dedup


@query
def dict_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_dictionary(_lines(spark, sf_dir), ["category_name"])


@query
def dict_sub_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_dictionary(_lines(spark, sf_dir), ["sub_category_name", "category_name"])


@query
def source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each dictionary are seen in which channels, rolled up from one stored pass."""
    lines = _lines(spark, sf_dir)
    places = stored(source_dictionary(lines, list(silver.CITY_PATH)), "city-paths")
    goods = stored(source_dictionary(lines, list(silver.PRODUCT_PATH)), "product-paths")

    def coverage(rows: DataFrame, name: str) -> DataFrame:
        found = source_dictionary(rows, list(silver.LEVELS[name].path))
        return found.groupBy("source_system").agg(F.count("*").alias("n")).withColumn("dictionary", F.lit(name))

    parts = [coverage(places, n) for n in silver.GEOGRAPHY_LEVELS] + [coverage(goods, n) for n in silver.PRODUCT_LEVELS]
    return reduce(DataFrame.unionByName, parts)


@query
def union_sources_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["payment_method", "payment_provider", "payment_id"]
    return union_sources(
        {
            ONLINE: fixture.online(spark, sf_dir).select(*names),
            OFFLINE: fixture.offline(spark, sf_dir).select(*reversed(names)),
        }
    )


QUERIES["union_sources"] = QUERIES.pop("union_sources_query")


@query
def lookup_left_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    child = source_dictionary(lines, ["sub_category_name", "category_name"])
    return lookup(child, silver.level_by_path(lines, "category"), "category_name", ["category_id"])


@query
def lookup_left_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    methods = stored(silver.payment_methods(lines), "methods")
    paid = lines.select("payment_id_raw", *silver.METHOD_KEY)
    return lookup(paid, methods, list(silver.METHOD_KEY), ["method_id"])


@query
def lookup_path_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    path = ["category_name", "sub_category_name"]
    parents = source_dictionary(lines, path).withColumn("sub_category_id", sk60(*path))
    child = source_dictionary(lines, list(silver.PRODUCT_PATH))
    return lookup_path(child, parents.drop("source_system"), path, ["sub_category_id"])


QUERIES["lookup_path"] = QUERIES.pop("lookup_path_query")


@query
def lookup_leaf_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products, states and cities under the literal rules, one row per matching parent name."""
    lines = _lines(spark, sf_dir, LEAF)
    goods = silver.hierarchy(lines, silver.PRODUCT_LEVELS, LEAF)
    places = silver.hierarchy(lines, silver.GEOGRAPHY_LEVELS, LEAF)
    parts = [
        df.select(
            F.lit(name).alias("level"),
            F.col(f"{name}_id").alias("id"),
            F.col(f"{silver.LEVELS[name].parent}_id").alias("parent_id"),
            F.col(f"{name}_name").alias("name"),
            "source_system",
        )
        for name, df in {**goods, **places}.items()
        if silver.LEVELS[name].parent
    ]
    return _text_keys(reduce(DataFrame.unionByName, parts), "parent_id")


@query
def city_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _places(_lines(spark, sf_dir))
    return silver.city_state_lookup(places["city"], places["state"])


@query
def flatten_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_places(_lines(spark, sf_dir))


@query
def flatten_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    goods = _goods(_lines(spark, sf_dir))
    flat = gold.dim_product(goods["product"], goods["sub_category"], goods["category"])
    return flat.select("product_id", "product_name", "sub_category_name", "category_name")


@query
def dedup_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = channel(_lines(spark, sf_dir), OFFLINE)
    return dedup(lines.select("store_src_id", "store_name", "city_name", "state_name"),
                 ["store_src_id", "store_name", "city_name", "state_name"])


@query
def dedup_customer_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customer(_lines(spark, sf_dir)).select("email", "first_name", "last_name", "age", "postal_code")


@query
def dedup_product_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = silver.level_by_path(_lines(spark, sf_dir), "product")
    return dedup(products.select("product_name", "product_id", "sub_category_name"), ["product_name"])


@query
def dedup_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = silver.payment_methods(_lines(spark, sf_dir))
    return dedup(methods, list(silver.METHOD_KEY)).select(*silver.METHOD_KEY, "method_id")


@query
def date_bounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_bounds(fixture.table(spark, sf_dir, "orders"), "o_orderdate")


QUERIES["date_bounds"] = QUERIES.pop("date_bounds_query")


# ---------------------------------------------------------------- silver tables


def _level(table: str, name: str) -> None:
    QUERIES[table] = lambda spark, sf_dir: silver.level_by_path(_lines(spark, sf_dir), name)


for _table, _name in [
    ("silver_categories", "category"),
    ("silver_sub_categories", "sub_category"),
    ("silver_products", "product"),
    ("silver_country", "country"),
    ("silver_region", "region"),
    ("silver_state", "state"),
    ("silver_city", "city"),
]:
    _level(_table, _name)


@query
def silver_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.store(_lines(spark, sf_dir))


@query
def silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customer(_lines(spark, sf_dir))


@query
def silver_payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.payment_methods(_lines(spark, sf_dir))


@query
def silver_employee_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = silver.employee_changes(_lines(spark, sf_dir))
    return silver.employee_history(silver.employee_versions(changes))


@query
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_keys(silver.orders(silver.order_headers(_lines(spark, sf_dir))), *_ORDER_KEYS)


@query
def silver_orders_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.orders_items(_lines(spark, sf_dir))


@query
def silver_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.payment(_lines(spark, sf_dir))


# ---------------------------------------------------------------- gold tables


@query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return gold.dim_customer(silver.customer(lines), _flat_places(lines))


@query
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return gold.dim_store(silver.store(lines), _flat_places(lines))


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    goods = _goods(_lines(spark, sf_dir))
    return gold.dim_product(goods["product"], goods["sub_category"], goods["category"])


@query
def dim_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_payment_method(silver.payment_methods(_lines(spark, sf_dir)))


@query
def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _employees(_lines(spark, sf_dir))


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(_lines(spark, sf_dir).select("order_date"))


@query
def payment_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.payment_per_order(silver.payment(_lines(spark, sf_dir)))


@query
def payment_order_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.order_total(silver.payment(_lines(spark, sf_dir)))


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    fact = gold.fact_sales_from_lines(lines, stored(_employees(lines), "employees"))
    return _text_keys(fact, *_FACT_KEYS)


def _together(**makes: Callable[[], DataFrame | dict[str, DataFrame]]) -> dict:
    """What independent jobs store, by name. They run side by side, so one job's last tasks leave no core idle."""
    made = {}
    side_by_side([lambda name=name, make=make: made.update({name: make()}) for name, make in makes.items()])
    return {name: made[name] for name in makes}


def _stored_star(lines: DataFrame) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Silver facts as frames and all six dimensions as stored tables."""
    key = ("order_src_id",)
    made = _together(
        orders=lambda: stored(silver.orders(silver.order_headers(lines)), "orders"),
        employee=lambda: stored(_employees(lines), "dim-employee"),
        payment_method=lambda: stored(gold.dim_payment_method(silver.payment_methods(lines)), "dim-payment_method"),
        goods=lambda: _goods(lines),
        places=lambda: _flat_places(lines),
    )
    headers, goods, places = made.pop("orders"), made.pop("goods"), made.pop("places")
    facts = {"orders_items": silver.orders_items(lines, key), "orders": headers, "payment": silver.payment(lines, key)}
    dims = _together(
        customer=lambda: stored(gold.dim_customer(silver.customer(lines), places), "dim-customer"),
        store=lambda: stored(gold.dim_store(silver.store(lines), places), "dim-store"),
        product=lambda: stored(gold.dim_product(goods["product"], goods["sub_category"], goods["category"]), "dim-product"),
        date=lambda: stored(gold.dim_date(headers), "dim-date"),
    )
    return facts, {**made, **dims}


@query
def fact_sales_star_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by looking every surrogate up in its stored dimension."""
    lines = stored(_lines(spark, sf_dir), "lines")
    return _text_keys(gold.fact(*_stored_star(lines), joined=True), *_FACT_KEYS)


@query
def fact_sales_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from silver tables, joining only the employee versions."""
    lines = _lines(spark, sf_dir)
    headers = silver.orders(silver.order_headers(lines))
    fact = gold.fact_sales(
        silver.orders_items(lines, ("order_src_id",)),
        headers,
        silver.payment(lines, ("order_src_id",)),
        stored(_employees(lines), "employees"),
    )
    return _text_keys(fact, *_FACT_KEYS)


@query
def fact_sales_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from bucketed tables of lines and order heads, joined without an exchange."""
    lines = stored(_lines(spark, sf_dir), "lines")
    key = ("order_src_id",)
    headers = silver.orders(silver.order_headers(lines))
    heads = gold.order_heads(headers, silver.payment(lines, key), stored(_employees(lines), "employees"))
    run = uuid.uuid4().hex
    names = (f"lines_{run}", f"heads_{run}")
    write_buckets(silver.orders_items(lines, key), heads, names, scratch(spark, "buckets"), buckets=max(16, fixture.tasks(spark, sf_dir)))
    return _text_keys(gold.finished(joined_buckets(spark, names)), *_FACT_KEYS)


@query
def sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: sales by year, country and category over the star."""
    lines = stored(_lines(spark, sf_dir), "lines")
    goods, places = _goods(lines), _flat_places(lines)
    dims = {
        "customer": gold.dim_customer(silver.customer(lines), places),
        "store": gold.dim_store(silver.store(lines), places),
        "product": gold.dim_product(goods["product"], goods["sub_category"], goods["category"]),
        "date": gold.dim_date(lines.select("order_date")),
    }
    dims = {name: stored(df, f"dim-{name}") for name, df in dims.items()}
    fact = gold.fact_sales_from_lines(lines, None)  # the report names no employee
    return eda.sales_by_year_country_category(fact, dims)


# ---------------------------------------------------------------- change data


@query
def scd1_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = channel(_lines(spark, sf_dir), ONLINE)
    changes = lines.select("email", "order_date", "first_name", "last_name", "phone_number", "postal_code", "city_name")
    return scd1(changes, ["email"], "order_date")


@query
def scd1_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(_events(spark, sf_dir).select("user_id", "ts", "event_type", "event_id"), ["user_id"], "ts")


def _event_changes(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "ts", "event_type")


@query
def scd2_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(_event_changes(_events(spark, sf_dir)), ["user_id"], "ts", ["event_type"])


@query
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(scd2(_event_changes(_events(spark, sf_dir)), ["user_id"], "ts", ["event_type"]))


@query
def scd2_employees_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.current_employees(_employees(_lines(spark, sf_dir)))


@query
def scd2_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History maintained batch by batch from files taken in one at a time, in an order unrelated to time."""
    path = scratch(spark, "event-files")
    rows = _event_changes(_events(spark, sf_dir))
    rows.repartition(3, "event_type", "ts").write.parquet(path)
    table = HistoryTable(scratch(spark, "event-history"), ["user_id"], "ts", ["event_type"])
    merge_into(read_table_stream(spark, path, rows.schema, 1), table.merge, scratch(spark, "event-checkpoint"))
    return table.read(spark)


@query
def scd2_touched_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History kept up by rewriting touched cells only: the last of three batches is late all over the time range."""
    rows = _event_changes(_events(spark, sf_dir))
    table = VersionTable(scratch(spark, "event-cells"), ["user_id"], "ts", schema=rows.schema, track=["event_type"], buckets=4)
    kind = F.pmod(F.xxhash64("user_id", "ts"), F.lit(10))
    for number, part in enumerate(("_kind < 6", "_kind between 6 and 8", "_kind = 9")):
        table.merge(rows.withColumn("_kind", kind).filter(part).drop("_kind"), number)
    return table.read(spark)


@query
def scd1_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows maintained batch by batch from files in an order unrelated to time."""
    path = scratch(spark, "event-files")
    rows = _events(spark, sf_dir).select("user_id", "ts", "event_type", "event_id")
    rows.repartition(3, "event_type", "ts").write.parquet(path)
    table = CurrentTable(scratch(spark, "event-current"), ["user_id"], "ts")
    merge_into(read_table_stream(spark, path, rows.schema, 1), table.merge, scratch(spark, "event-checkpoint"))
    return table.read(spark)


@query
def scd_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes without key or sequence are kept apart; the history is built of the others."""
    path = scratch(spark, "event-files")
    keyless = F.pmod("event_id", F.lit(97)) == 0
    timeless = F.pmod("event_id", F.lit(89)) == 0
    rows = _events(spark, sf_dir).select(
        "event_id", F.when(~keyless, F.col("user_id")).alias("user_id"), F.when(~timeless, F.col("ts")).alias("ts"), "event_type"
    )
    rows.repartition(2, "event_type", "event_id").write.parquet(path)
    table = HistoryTable(scratch(spark, "event-history"), ["user_id"], "ts", ["event_type"], schema=rows.schema)
    merge_into(read_table_stream(spark, path, rows.schema, 1), table.merge, scratch(spark, "event-checkpoint"))
    bad = table.quarantined(spark).select("event_id", "user_id", "event_type", F.lit("quarantine").alias("kind"))
    good = table.log(spark).select(
        F.lit(None).cast("bigint").alias("event_id"), "user_id", "event_type", F.lit("log").alias("kind")
    )
    return _text_keys(bad.unionByName(good), "event_id", "user_id")


# ---------------------------------------------------------------- streams


@query
def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "union")
    with little_disk(spark), finished_scratch(spark):
        rows = _bronze_streams(spark, sf_dir).select("source_system", "order_src_id_raw", "payment_id_raw", "sales")
        append_to(rows, path, scratch(spark, "union-checkpoint"))
    return spark.read.schema(rows.schema).parquet(path)


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = dedup_stream(
        _bronze_streams(spark, sf_dir).select("source_system", "order_src_id_raw", "order_date"),
        ["source_system", "order_src_id_raw"],
    )
    return _through_stream(headers, "dedup")


@query
def stream_orders_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of orders whose lines differ in date and shop, folded from files in an order unrelated to time."""
    day = F.pmod(F.col("payment_id_raw").cast("bigint"), F.lit(5)).cast("int")
    shop = F.col("store_src_id") + F.pmod(F.col("payment_id_raw").cast("bigint"), F.lit(3)) + F.lit(9007199254740993)
    rows = _lines(spark, sf_dir).withColumns({"order_date": F.col("order_date") - F.make_dt_interval(day), "store_src_id": shop})
    path = scratch(spark, "shuffled-lines")
    files, per_batch = _batches(spark, sf_dir, 3, 1)
    rows.select(*HEADER).repartition(files, "order_date", "order_src_id_raw").write.parquet(path)
    schema = rows.select(*HEADER).schema
    table = HeaderTable(scratch(spark, "headers"), schema=schema)
    merge_into(read_table_stream(spark, path, schema, per_batch), table.merge, scratch(spark, "headers-checkpoint"))
    folded = table.read(spark).select("source_system", "order_src_id_raw", "order_date", "email", "store_src_id")
    return _text_keys(folded, "store_src_id")


@query
def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch: every user once. Several batches are tested on edge rows."""
    users = dedup_stream(_event_stream(spark, sf_dir), ["user_id"], "ts", "1 day")
    return _through_stream(users.select("user_id"), "dedup-watermark")


@query
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches under a watermark: what became of every row. Tenths of all times arrive in the last batch."""
    rows = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    path = scratch(spark, "late-events")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    low, high = (micros(rows.agg(end("ts")).scalar()) for end in (F.min, F.max))
    third = F.floor(3 * (micros(F.col("ts")) - low) / (high - low + 1)).cast("int")
    parts = rows.withColumn("part", F.when(F.col("event_id") % 10 == 0, 2).otherwise(third))
    for number in range(3):  # one file a batch, in this order
        parts.filter(F.col("part") == number).drop("part").coalesce(1).write.parquet(f"{path}/{number}")
    table = BoundedDedup(scratch(spark, "late-table"), ["user_id"], "ts", schema=rows.schema, delay="1 day")
    merge_into(read_table_stream(spark, path, rows.schema, 1), table.merge, scratch(spark, "late-checkpoint"))
    seen = table.read(spark).groupBy("cdc_batch", "status")
    return seen.agg(F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("n_users"))


@query
def stream_static_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    buyers, shops = stored(silver.customer(lines), "customer"), stored(silver.store(lines), "store")
    headers = dedup_stream(_bronze_streams(spark, sf_dir).select(*HEADER), ["source_system", "order_src_id_raw"])
    return _text_keys(_through_stream(silver.orders_joined(headers, buyers, shops), "orders"), *_ORDER_KEYS)


@query
def stream_static_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    path = list(silver.PRODUCT_PATH)
    products = stored(source_dictionary(lines, path).select(*path, sk60(*path).alias("product_id")), "products")
    headers = stored(silver.orders(silver.order_headers(lines)), "orders")
    items = silver.orders_items_joined(_bronze_streams(spark, sf_dir), products, headers, path)
    return _through_stream(items, "items")


@query
def stream_static_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    methods = stored(silver.payment_methods(lines), "methods")
    headers = stored(silver.orders(silver.order_headers(lines)), "orders")
    return _through_stream(silver.payment_joined(_bronze_streams(spark, sf_dir), methods, headers), "payment")


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of lines with columns of two guarded snapshots."""
    lines = _lines(spark, sf_dir)
    methods = stored(silver.payment_methods(lines), "methods")
    buyers = stored(silver.customer(lines), "customer")
    rows = _bronze_streams(spark, sf_dir).select("source_system", "payment_id_raw", "email", "sales", *silver.METHOD_KEY)
    wide = enrich_stream(
        rows,
        [(methods, list(silver.METHOD_KEY), ["method_id"]), (buyers, "email", ["customer_id", "age"])],
        spread_by=["payment_id_raw"],
    )
    return _text_keys(_through_stream(wide, "enriched"), "customer_id")


def _sold(spark: SparkSession, sf_dir: str, files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of both channels. Online lines of one order differ in their date."""
    day = F.pmod("payment_id", F.lit(3)).cast("int")
    online = fixture.online(spark, sf_dir, files)
    return online.withColumn("Order_Date", F.col("Order_Date") - F.make_dt_interval(day)), fixture.offline(spark, sf_dir, files)


def _refreshed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse fed in small batches. What it has taken in goes: landing files, then bronze, once silver is made of it."""
    files, per_batch = _batches(spark, sf_dir, 2, 2)
    root = scratch(spark, "warehouse")
    with finished_scratch(spark):
        sold, shops = _sold(spark, sf_dir, files)
        online = _landing(sold, ONLINE_CSV, "landing-online", None)
        offline = _landing(shops, OFFLINE_CSV, "landing-offline", None)
        house = Warehouse(spark, online, offline, root, online_files=per_batch, offline_files=per_batch)
        house.ingest()
    with finished_scratch(spark):
        house.stream_facts()
    remove(spark, house.path("bronze", ""))
    return house


def _digest(rows: DataFrame) -> Column:
    """Half the SHA-256 of a row: every value, by column name, with its length, NULL told from the empty text."""
    texts = [F.col(f"`{c}`").cast("string") for c in sorted(rows.columns)]
    whole = F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)
    return F.unhex(F.left(whole, F.lit(32)))


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select(_digest(rows).alias("_digest"))


def _compared(name: str, full: DataFrame, incremental: DataFrame) -> DataFrame:
    """Rows of a table, and how many are on one side only, from the digests of both sides. Each digest travels once."""
    both = full.withColumn("_side", F.lit(1)).unionByName(incremental.withColumn("_side", F.lit(-1)))
    per_row = both.repartition("_digest").groupBy("_digest").agg(
        F.sum("_side").alias("_balance"), F.count_if(F.col("_side") == 1).alias("_full")
    )
    return per_row.agg(F.sum("_full").alias("n_full"), F.sum(F.abs("_balance")).alias("n_different")).withColumn("table_name", F.lit(name))


def _difference(full: dict[str, DataFrame], incremental: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and how many are on one side only. Rows travel, and are compared, as their digest."""
    parts = [_compared(n, _digests(rows), _digests(incremental[n].select(*rows.columns))) for n, rows in full.items()]
    return reduce(DataFrame.unionByName, parts)


def _kept_digests(spark: SparkSession, make: Callable[[], dict[str, DataFrame]]) -> tuple[str, dict[str, list]]:
    """Stores the digests of tables, one folder each, and tells the tables' columns. What else was stored for it goes."""
    out = scratch(spark, "digests")
    with finished_scratch(spark):
        tables = make()
        side_by_side(lambda n=n, rows=rows: _digests(rows).write.parquet(f"{out}/{n}") for n, rows in tables.items())
    return out, {n: sorted(rows.dtypes) for n, rows in tables.items()}


def _equal(
    spark: SparkSession, incremental: Callable[[], dict[str, DataFrame]], full: Callable[[], dict[str, DataFrame]]
) -> DataFrame:
    """The difference of tables that need not be on disk at the same time: first one side is made and gone, then the other.

    Of both only the digests of all rows stay, and are compared table by table.
    """
    out = scratch(spark, "difference")
    with little_disk(spark), finished_scratch(spark):
        (kept, has), (whole, wanted) = _kept_digests(spark, incremental), _kept_digests(spark, full)
        if has != wanted:
            raise ValueError(f"columns differ: {has} {wanted}")
        for name in wanted:
            sides = [spark.read.schema("_digest binary").parquet(f"{path}/{name}") for path in (whole, kept)]
            found = _compared(name, *sides)
            found.write.parquet(f"{out}/{name}")
    return spark.read.schema(found.schema).option("recursiveFileLookup", "true").parquet(out)


@query
def refresh_incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline fed in small batches, against the batch plans over the same lines: rows that differ.

    Online lines of one order differ in their date, so a header depends on all of its lines.
    """

    def incremental() -> dict[str, DataFrame]:
        house = _refreshed(spark, sf_dir)
        return {
            "orders": house.orders(),
            "orders_items": spark.read.parquet(house.path("silver", "orders_items")).select(*silver.ITEM_COLUMNS),
            "payment": spark.read.parquet(house.path("silver", "payment")).select(*silver.PAYMENT_COLUMNS),
            "employee_history": house.employee_history(),
        }

    def full() -> dict[str, DataFrame]:
        lines = stored(sales_lines(*_sold(spark, sf_dir)), "lines")
        return {
            "orders": silver.orders(silver.order_headers(lines)),
            "orders_items": silver.orders_items(lines),
            "payment": silver.payment(lines),
            "employee_history": silver.employee_history(silver.employee_versions(silver.employee_changes(lines))),
        }

    return _equal(spark, incremental, full)


@query
def refresh_star_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for dictionaries, dimensions and the fact, all of them from what small batches left."""
    audit = ("insert_dt", "update_dt")
    facts = ("orders_items", "payment")

    def star(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Dictionaries, dimensions and fact, the former stored first."""
        tables = {n: df.drop(*audit) if n != "employee_history" else df for n, df in tables.items()}
        tables |= {n: stored(df, f"refreshed-{n}") for n, df in tables.items() if n not in facts}
        dims = {n: stored(df, f"refreshed-dim-{n}") for n, df in gold.dimensions(tables).items()}
        out = {n: df for n, df in tables.items() if n not in ("orders", *facts, "employee_history")}
        return out | {f"dim_{n}": df for n, df in dims.items()} | {"fact_sales": gold.fact(tables, dims)}

    def incremental() -> dict[str, DataFrame]:
        house = _refreshed(spark, sf_dir)
        kept = {name: spark.read.parquet(house.path("silver", name)) for name in facts}
        return star(house.dictionaries() | kept | {"orders": house.orders(), "employee_history": house.employee_history()})

    return _equal(spark, incremental, lambda: star(silver.silver(stored(sales_lines(*_sold(spark, sf_dir)), "lines"))))


# ---------------------------------------------------------------- exploration


@query
def eda_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.count_distinct(fixture.online(spark, sf_dir), ["payment_id", "Order_ID"])


@query
def eda_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    online, offline = fixture.online(spark, sf_dir), fixture.offline(spark, sf_dir)
    wanted = [
        (offline, ["store_country"]),
        (offline, ["store_region"]),
        (offline, ["payment_provider"]),
        (online, ["customer_name", "customer_surname", "City"]),
    ]
    parts = []
    for df, names in wanted:
        values = eda.distinct_values(df, names)
        padded = [F.col(c).alias(f"value_{i}") for i, c in enumerate(names)]
        padded += [F.lit(None).cast("string").alias(f"value_{i}") for i in range(len(names), 3)]
        parts.append(values.select(F.lit(", ".join(names)).alias("what"), *padded))
    return reduce(DataFrame.unionByName, parts)


@query
def eda_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.projection(fixture.online(spark, sf_dir), ["Country", "Region", "State", "City"])


@query
def eda_filter_conjunct(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = eda.where_equal(
        fixture.online(spark, sf_dir), customer_name="BUILDING", customer_surname="Customer#000000027"
    )
    return found.select("customer_name", "customer_surname", "City")


@query
def eda_filter_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup over files clustered by customer: row groups without the name are skipped."""
    rows = fixture.online(spark, sf_dir)
    path = write_clustered(rows, scratch(spark, "clustered"), ["customer_surname", "customer_name", "payment_id"], ["customer_email"])
    found = eda.where_equal(spark.read.parquet(path), customer_name="BUILDING", customer_surname="Customer#000000027")
    return found.select("customer_name", "customer_surname", "City")
