"""CSV landing folders: dialect, rescue of unreadable data, inference, intake limit, lineage."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from tillhouse.functions.clean import normalize_headers
from tillhouse.sources.inference import column_facts, merged_facts, schema_of
from tillhouse.sources.storage import exists, make_folder
from tillhouse.streaming.refresh import TRIGGERED, merge_into

RESCUED = "_rescued_data"

# Quotes inside quoted text are doubled.
DIALECT = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


_RAW_LINE = "_unfitting_line"
_BLANK = "".join(map(chr, range(33)))
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _options(extra: dict[str, str] | None = None) -> dict[str, str]:
    return {**DIALECT, "columnNameOfCorruptRecord": _RAW_LINE, **(extra or {})}


def _with_raw_line(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add(_RAW_LINE, StringType())


def _rescue(df: DataFrame) -> DataFrame:
    """``_rescued_data``: NULL on lines that fit, else JSON of the raw line and the columns that came out NULL.

    Spark converts, and therefore judges, only columns a query reads. Naming every column here makes the verdict on
    a line the same whatever else is selected.
    """
    names = [c for c in df.columns if c != _RAW_LINE]
    empty = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in names]))
    verdict = F.to_json(F.struct(F.col(_RAW_LINE).alias("line"), empty.alias("empty")))
    return df.withColumn(RESCUED, F.when(F.col(_RAW_LINE).isNotNull(), verdict)).drop(_RAW_LINE)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of a file, whose lines follow each other: names in the first line that is not blank, else NULL."""
    block, found = None, True
    schema = pa.schema({"path": pa.string(), "start": pa.int64(), "names": pa.list_(pa.string())})

    def told(names: list[str] | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*block, names), schema)], schema=schema)

    for batch in batches:
        rows = batch.num_rows
        ends = [batch.column(i)[j].as_py() for j in (0, rows - 1) for i in (0, 1)] if rows else [None] * 4
        if found and rows and block == tuple(ends[:2]) == tuple(ends[2:]):
            continue
        for path, start, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (path, start) != block:
                if not found:
                    yield told(None)
                block, found = (path, start), False
            line = line.removeprefix("\ufeff")
            if not found and line.strip(_BLANK):
                yield told([cell.strip() for cell in next(csv.reader([line], doublequote=True))])
                found = True
    if not found:
        yield told(None)


def _headers(spark: SparkSession, source: str | list[str], first_block: bool) -> dict[tuple[str, ...] | None, list[str]]:
    """Files by the names in their first line that is not blank, of their first block or of all; None: there is none."""
    lines = spark.read.option("recursiveFileLookup", "true").text(source)
    lines = lines.select("_metadata.file_path", F.col("_metadata.file_block_start").alias("start"), "value")
    if first_block:
        lines = lines.where("start = 0")
    blocks = lines.mapInArrow(_first_lines, "path string, start bigint, names array<string>")
    if not first_block:
        earliest = F.min_by("names", F.when(F.col("names").isNotNull(), F.col("start")))
        blocks = blocks.groupBy("path").agg(earliest.alias("names"))
    groups = blocks.groupBy("names").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    return {None if g["names"] is None else tuple(g["names"]): g["files"] for g in groups}


def header_lines(spark: SparkSession, source: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the names in their header, the first line that is not blank; files without such a line are left out.

    Executors read the files in blocks as any text; of a file's blocks only the first goes to Python, unless it is blank
    throughout. So no task reads more than a partition's share, however large the file (compressed files cannot be
    divided). Blocks are read to their end: Spark feeds a Python worker that has stopped early all the same. The driver
    opens no file and gets one row per different header. Blank is what Spark's own header reading skips: nothing above a
    space.
    """
    if not source:
        return {}
    found = _headers(spark, source, first_block=True)
    blank = found.pop(None, [])
    if blank:
        for names, files in _headers(spark, blank, first_block=False).items():
            if names is not None:
                found[names] = sorted(found.get(names, []) + files)
    return dict(sorted(found.items(), key=lambda g: (-len(g[1]), g[0])))


def _read_group(
    spark: SparkSession, files: list[str], header: tuple[str, ...], schema: StructType, options: dict[str, str], source: str | None
) -> DataFrame:
    """Files of one header, read under it and then put into the declared columns by name.

    Declared columns the files lack are NULL. Columns nobody declared go to ``_rescued_data``.
    """
    declared = {f.name.lower(): f for f in schema}
    fields, place, extra = [], {}, {}
    for i, name in enumerate(header):
        known = declared.get(name.lower())
        if known is not None and known.name not in place:
            place[known.name] = f"_c{i}"
            fields.append(StructField(f"_c{i}", known.dataType))
        else:
            extra[f"_c{i}"] = name
            fields.append(StructField(f"_c{i}", StringType()))
    raw = spark.read.options(**_options(options)).schema(_with_raw_line(StructType(fields))).csv(files)
    line = F.col(_RAW_LINE)
    # Every column is named here, so the verdict on a line is the same whatever else is selected.
    empty = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(name)) for name, c in place.items()]))
    parts = [F.when(line.isNotNull(), line).alias("line"), F.when(line.isNotNull(), empty).alias("empty")]
    surplus = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in extra], F.lit(False))
    if extra:
        values = F.struct(*[F.col(c).alias(name or f"column {int(c[2:]) + 1}") for c, name in extra.items()])
        parts.append(F.when(surplus, values).alias("extra"))
    rescued = F.when(line.isNotNull() | surplus, F.to_json(F.struct(*parts)))
    columns = [(F.col(place[f.name]) if f.name in place else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    columns += [F.col("_metadata.file_path").alias(source)] if source else []
    return raw.select(*columns, rescued.alias(RESCUED))


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, source: str | None = None, **options: str
) -> DataFrame:
    """Batch read of a folder or of given files, columns matched by name (ignoring case) whatever their order.

    A bad field becomes NULL and its line is kept in ``_rescued_data``, as are columns that are not declared; no row is
    dropped. ``source`` adds the file each row came from under that name.
    """
    groups = header_lines(spark, path)
    if not groups:
        names = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
        names += [f"`{source}` string"] if source else []
        return spark.createDataFrame([], ", ".join([*names, f"{RESCUED} string"]))
    return reduce(DataFrame.unionByName, [_read_group(spark, own, header, schema, options, source) for header, own in groups.items()])


def read_csv_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None, **options: str
) -> DataFrame:
    """New files as a stream, at most ``max_files`` per micro-batch, for files that all have the declared header.

    A file with another header fails the stream instead of filling the wrong columns; :func:`ingest_csv` takes any.
    """
    options["enforceSchema"] = "false"
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    return _rescue(spark.readStream.options(**_options(options)).schema(_with_raw_line(schema)).csv(path))


def ingest_csv(
    spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str, max_files: int, mode: str = TRIGGERED,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Bronze rows of new files, matched by name, appended under ``out``; every file exactly once.

    The stream carries file names only; each micro-batch reads its files under their own headers and writes a folder of
    its own, which is complete once Spark has marked it. Read with ``recursiveFileLookup``.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/batch-{batch_id:09d}"
        if exists(spark, f"{target}/_SUCCESS"):
            return
        files = [row.path for row in batch.select("path").collect()]  # at most ``max_files``
        bronze_files(spark, files, schema).write.mode("overwrite").parquet(target)

    make_folder(spark, out)
    names = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    names = names.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").load(folder)
    return merge_into(names.select("path"), take, checkpoint, mode, interval)


def infer_schema(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0, known: DataFrame | None = None) -> StructType:
    """Column types that fit the lines of ``path``, all of them by default, to be declared on the stream.

    Columns are matched by name over files with any headers; see :mod:`tillhouse.sources.inference`. ``known`` are facts
    of earlier files: types then only widen. A line outside the share that contradicts the guess is not lost: it is
    rescued when read.
    """
    facts = column_facts(text_columns(spark, path, sampling_ratio))
    return schema_of(facts if known is None else merged_facts(known, facts))


def text_columns(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0) -> list[tuple[list[str], DataFrame]]:
    """Per header its names, and its files' rows as arrays of texts in the same order (column ``cells``)."""
    out = []
    for header, files in header_lines(spark, path).items():
        fields = StructType([StructField(f"_c{i}", StringType()) for i in range(len(header))])
        rows = spark.read.options(**_options()).schema(fields).csv(files).select(F.array(*fields.names).alias("cells"))
        out.append((list(header), rows if sampling_ratio >= 1 else rows.sample(sampling_ratio, seed=1)))
    return out


def zone_free(schema: StructType) -> StructType:
    """Inferred timestamps as the zone-free type that the declared layouts have."""
    local = TimestampNTZType()
    return StructType([StructField(f.name, local if f.dataType == TimestampType() else f.dataType) for f in schema])


def with_lineage(df: DataFrame) -> DataFrame:
    """File each row came from and when it was taken in. Only directly on a file source."""
    return df.withColumns({"file_path": F.col("_metadata.file_path"), "ingestion_datetime": F.current_timestamp()})


def bronze(df: DataFrame) -> DataFrame:
    """What is stored of a landing folder: normalized headers plus lineage."""
    return with_lineage(normalize_headers(df))


def bronze_files(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    """The same of given files with any headers."""
    rows = read_csv(spark, files, schema, source="file_path")
    return normalize_headers(rows.select(*schema.names, RESCUED, "file_path")).withColumn("ingestion_datetime", F.current_timestamp())


def bronze_schema(spark: SparkSession, schema: StructType) -> StructType:
    """Columns of a bronze table."""
    return bronze_files(spark, [], schema).schema


def split_rescued(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the declared schema, and the rest with what was rescued of them."""
    good = df.filter(F.col(RESCUED).isNull()).drop(RESCUED)
    return good, df.filter(F.col(RESCUED).isNotNull())


def write_csv(df: DataFrame, path: str, files: int | None = None, **options: str) -> str:
    """Write in the dialect above, blanks at text ends kept."""
    frame = df if files is None else df.repartition(files)
    frame.write.options(
        header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **options
    ).csv(path)
    return path
