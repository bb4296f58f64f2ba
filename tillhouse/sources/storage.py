"""Where intermediate and published tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@lru_cache(maxsize=None)
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="tillhouse-")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: the session's ``spark.checkpoint.dir``; a temp folder only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root(context.applicationId)


_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path for this run."""
    path = f"{shared_dir(spark)}/tillhouse/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def finished_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside, also by the batches of streams started inside, are deleted at the end.

    Frames over them must have been used up by then. What other threads make meanwhile stays.
    """
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            remove(spark, path)


#: Settings under which a session's jobs take little disk: shuffle files go when their job ends, parquet is packed tightly.
LITTLE_DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def little_disk(spark: SparkSession) -> Iterator[None]:
    """Jobs and streams started inside give their shuffle files back when they end; otherwise these stay until the driver
    happens to collect garbage. A frame made inside may run again, its stages are then run again too.
    """
    before = {key: spark.conf.get(key, None) for key in LITTLE_DISK}
    for key, value in LITTLE_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back.

    Cuts lineage in a way that survives the loss of executors, and gives the planner the true size: whether
    a later join broadcasts this table is then decided by ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _file_system(spark, path)
    return system.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    system, found = _file_system(spark, path)
    system.delete(found, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, found = _file_system(spark, path)
    system.mkdirs(found)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table of one folder per batch, which may have no rows yet."""
    make_folder(spark, path)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def read_table_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None, glob: str | None = None
) -> DataFrame:
    """A stored table as a stream of appended files."""
    make_folder(spark, path)
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def name_folder(
    spark: SparkSession, table: str, path: str, schema: StructType, comment: str, properties: dict[str, str]
) -> None:
    """Give a folder that streams append to a table name, comment and properties. The files stay where they are."""
    make_folder(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: only the name goes
    spark.catalog.createTable(table, path=path, source="parquet", schema=schema, description=comment, recursiveFileLookup="true")
    set_properties(spark, table, properties)


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def checked(df: DataFrame, ddl: str) -> DataFrame:
    """Fail early unless ``df`` has exactly the declared columns and types, in order."""
    declared = StructType.fromDDL(ddl)
    want = [(f.name, f.dataType) for f in declared]
    have = [(f.name, f.dataType) for f in df.schema]
    if want != have:
        raise ValueError(f"schema differs from declaration: {[h for h in have if h not in want]} vs {want}")
    return df


#: Versions of a published table that stay on disk, the newest among them.
KEEP_VERSIONS = 2


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of a published table's versions, oldest first."""
    system, found = _file_system(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(found)] if system.exists(found) else []
    return [f"{path}/{name}" for name in sorted(names) if name.startswith("version-")]


def publish(
    df: DataFrame,
    table: str,
    path: str,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
    balanced: bool = True,
    check: Callable[[DataFrame], None] | None = None,
    keep: int = KEEP_VERSIONS,
) -> None:
    """Replace the rows of a named table, with comment and properties, without touching files that may be read.

    The rows are written to a new folder, given to ``check``, and only then does the name move over. If ``check`` raises,
    the table stays as it was. A frame opened before still finds its files until ``keep`` versions have followed.

    ``balanced`` adds a shuffle that evens out file sizes; leave it off for a large result of a join or aggregation,
    whose partitions are already sized at run time.
    """
    spark = df.sparkSession
    before = _versions(spark, path)
    number = int(before[-1].rsplit("-", 1)[1]) + 1 if before else 1
    target = f"{path}/version-{number:09d}"
    (df.hint("rebalance") if balanced else df).write.parquet(target)
    if check is not None:
        try:
            check(spark.read.schema(df.schema).parquet(target))
        except Exception:
            remove(spark, target)
            raise
    if spark.catalog.tableExists(table) and spark.read.table(table).schema == spark.read.schema(df.schema).parquet(target).schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: only the name goes
        spark.catalog.createTable(table, path=target, source="parquet", schema=df.schema)
    if comment is not None:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")
    if properties:
        set_properties(spark, table, properties)
    for old in before[: len(before) + 1 - keep]:
        remove(spark, old)


def write_clustered(df: DataFrame, path: str, by: list[str], bloom: list[str] | None = None, rows_per_group: int = 100_000) -> str:
    """Files sorted by ``by`` over all of them, with small row groups and bloom filters on ``bloom``.

    A lookup by the leading columns reads the row groups whose range holds the value; one by a bloom column skips the
    row groups that surely lack it. The range shuffle samples the data, so a value that many rows share fills files of
    its own, but one task writes it: add columns to ``by`` that divide it.
    """
    writer = df.repartitionByRange(*by).sortWithinPartitions(*by).write
    for name in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", str(rows_per_group))
    writer.option("parquet.block.row.count.limit", str(rows_per_group)).parquet(path)
    return path
