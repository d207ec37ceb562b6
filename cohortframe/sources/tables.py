"""Reading and writing tables."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, FractionalType, StringType, StructField, StructType, TimestampType

from cohortframe import session
from cohortframe.functions import scalars as S


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    columns: Sequence[str] | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Typed CSV scan, also of ``.csv.gz``; only named columns are parsed.

    ``schema`` must list the columns in file order, or be a superset of the wanted ones if the header is used to
    match them (see ``read_csv_by_name``). One gzip file is one task: pass a folder of many files for large inputs.
    """
    reader = spark.read.schema(schema).option("header", True)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    df = reader.csv(path)
    return df.select(*columns) if columns else df


def read_csv_by_name(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns of ``schema`` picked by header name from a file that may have more of them, in any order.

    All columns are read as text (only the header is looked at for that) and the wanted ones cast; text that does not
    parse gives NULL.
    """
    raw = spark.read.option("header", True).csv(path)
    wanted = StructType.fromDDL(schema)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names that the first file of a CSV folder states; only its first line is read."""
    return spark.read.option("header", True).csv(path).columns


def _typed(name: str, kind: DataType, formats: Sequence[str]) -> Column:
    if isinstance(kind, FractionalType):
        return S.to_number(name).cast(kind)
    if isinstance(kind, TimestampType):
        return S.to_time(name, *formats)
    return F.col(name).try_cast(kind)


def scan_csv(
    spark: SparkSession, path: str, schema: str, time_formats: Sequence[str] = (), name: str = "scan"
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a CSV file or folder from one scan.

    The columns of ``schema`` are found by the header, so the file may have them in any order and have more; one that is
    not there, or is there twice, is an error that names it. Every file must state the header of the first one (Spark checks
    that), unless columns have no name.

    A line with too many or too few fields goes to ``rejects`` (kind ``fields``) with its text. A line with a text that
    its column's type cannot hold stays in ``rows`` with NULL there, and ``rejects`` (kind ``values``) names the columns and
    texts. Empty fields and numbers written as NaN are missing, not wrong. Both tables read one typed copy in the shared
    folder. Fields do not contain line feeds. One gzip file is one task: pass a folder of many files for large inputs.
    """
    have = header(spark, path)
    wanted = StructType.fromDDL(schema)
    lacking = [f.name for f in wanted if have.count(f.name) != 1]
    if lacking:
        raise ValueError(f"columns not stated once in the header of {path}: {', '.join(lacking)}")
    broken, = _free(have, "_broken")
    texts = StructType([*[StructField(c, StringType()) for c in have], StructField(broken, StringType())])
    named = not any(re.fullmatch(r"_c\d+", c) for c in have)
    reader = spark.read.schema(texts).option("header", True).option("enforceSchema", not named)
    # A pruned parser would not see that a line has too many or too few fields.
    raw = reader.option("mode", "PERMISSIVE").option("columnPruning", False).option("columnNameOfCorruptRecord", broken).csv(path)
    typed, wrong = [], []
    for f in wanted:
        value, text = _typed(f.name, f.dataType, time_formats), F.btrim(f.name)
        nan = F.coalesce(F.isnan(text.try_cast("double")), F.lit(False)) if isinstance(f.dataType, FractionalType) else F.lit(False)
        typed.append(value.alias(f.name))
        wrong.append(F.when((text != "") & value.isNull() & ~nan, F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text"))))
    scanned = session.barrier(
        raw.select(
            *typed, F.col("_metadata.file_path").alias("_file"), F.col(broken).alias("_line"),
            F.when(F.col(broken).isNull(), F.array_compact(F.array(*wrong))).alias("_wrong"),
        ),
        name,
    )
    rejects = scanned.where(F.col("_line").isNotNull() | (F.size("_wrong") > 0)).select(
        F.col("_file").alias("file"), F.when(F.col("_line").isNotNull(), "fields").otherwise("values").alias("kind"),
        F.col("_wrong").alias("wrong"), F.col("_line").alias("line"),
    )
    return scanned.where(F.col("_line").isNull()).select(*wanted.names), rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``(kind, column, n)`` of a scan's rejects: lines by kind ``fields``, texts by column for kind ``values``."""
    each = rejects.select("kind", F.explode_outer("wrong").alias("w"))
    return each.groupBy("kind", F.col("w.column").alias("column")).agg(F.count("*").alias("n"))


def _free(taken: Sequence[str], *names: str) -> list[str]:
    have = {c.lower() for c in taken}
    return [next(n + "_" * i for i in range(len(have) + 1) if (n + "_" * i).lower() not in have) for n in names]


def unparsed(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """``(column, n_text, n_unparsed)``: texts of each column, and those of which the parsed expression is NULL."""
    sums = [
        F.struct(F.lit(c).alias("column"), F.count(c).alias("n_text"), F.count(F.when(p.isNull(), F.col(c))).alias("n_unparsed"))
        for c, p in parsed.items()
    ]
    return df.agg(F.array(*sums).alias("all")).select(F.inline("all"))


def spread_after_gzip(df: DataFrame, partitions: int) -> DataFrame:
    """Split a scan of few unsplittable files over more tasks."""
    return df.repartition(partitions)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail early, and by name, if a table lacks columns that a plan needs."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")


def with_file_order(df: DataFrame, name: str = "seq") -> DataFrame:
    """Ingest order of a file scan: file, then position within the file's splits. Apply directly to the scan."""
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def check_inputs(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], required: Mapping[str, Sequence[str]]
) -> DataFrame:
    """``(table, column, status)``; status is found, missing table, empty table or missing column."""
    rows = []
    for table, columns in required.items():
        df = tables.get(table)
        if df is None:
            rows.append((table, None, "missing table"))
            continue
        rows.append((table, None, "empty table" if df.isEmpty() else "found"))
        rows += [(table, c, "found" if c in df.columns else "missing column") for c in columns]
    return session.literal_table(spark, rows, "table string, column string, status string")


def require_inputs(report: DataFrame) -> None:
    """Fail if any required table or column is not there."""
    bad = report.where("status <> 'found'").collect()
    if bad:
        raise ValueError("inputs incomplete: " + "; ".join(f"{r.table}.{r.column}: {r.status}" for r in bad))


def write_csv(df: DataFrame, path: str, compressed: bool = False) -> str:
    writer = df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    writer.option("compression", "gzip" if compressed else "none").csv(path)
    return path


OUTPUTS = ("rows", "feature_vocab", "cuts", "scaler_params", "code_vocab", "run_info", "losses", "slot_weights")


def write_dataset(outputs: Mapping[str, DataFrame], path: str, clustered: bool = False) -> str:
    """Write the prepared data set: ``rows`` by split and sorted by stay within files, the small tables in one file.

    ``clustered`` deals the rows to files by ranges of stays first, at the price of a shuffle of the rows, and writes the
    table ``file_index`` (file, split, first and last stay, rows): then a stay is in one file, which ``read_stays`` finds.
    """
    rows = outputs["rows"]
    if clustered:
        rows = rows.repartitionByRange("split", "stay_id")
    rows.sortWithinPartitions("split", "stay_id").write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    if clustered:
        file_index(rows.sparkSession, path).coalesce(1).write.mode("overwrite").parquet(f"{path}/file_index")
    for name in OUTPUTS[1:]:
        if outputs.get(name) is not None:
            outputs[name].coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def read_dataset(spark: SparkSession, path: str, names: Sequence[str] = OUTPUTS[:-1]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """``(file, split, first_stay, last_stay, rows, in_order)`` of a written data set, from its column of stays alone.

    ``in_order``: the stays rise from row to row of the file.
    """
    rows = spark.read.parquet(f"{path}/rows").select(
        "split", F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"), "stay_id"
    )
    stay = rows.schema["stay_id"].dataType.simpleString()
    runs = rows.mapInArrow(
        _runs, f"split {rows.schema['split'].dataType.simpleString()}, path string, row bigint, rows bigint, first {stay}, last {stay}, low {stay}, high {stay}, rises boolean"
    )
    # Relative to the data set, so that it may be moved.
    runs = runs.withColumn("file", F.regexp_extract("path", "/rows/(split=.*)$", 1))
    # A row for each run: a window over a file sees thousands of its rows as one.
    before = F.lag("last").over(Window.partitionBy("file").orderBy("row"))
    runs = runs.withColumn("joined", F.coalesce(F.col("first") >= before, F.lit(True)))
    return runs.groupBy("file", "split").agg(
        F.min("low").alias("first_stay"), F.max("high").alias("last_stay"), F.sum("rows").alias("rows"),
        F.bool_and(F.col("rises") & F.col("joined")).alias("in_order"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that follow one another in a file, as one row; NULL stays are in order anywhere."""
    for batch in batches:
        split, path, row, stay = batch.columns
        n = batch.num_rows
        if not n:
            continue
        rises = pc.fill_null(pc.greater_equal(stay.slice(1), stay.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        same = pc.equal(path.slice(1), path.slice(0, n - 1)).to_numpy(zero_copy_only=False) & (np.diff(row.to_numpy()) == 1)
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        ends = np.append(starts[1:], n)
        spans = [pc.min_max(stay.slice(a, b - a)) for a, b in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays(
            [
                split.take(pa.array(starts)), path.take(pa.array(starts)), row.take(pa.array(starts)), pa.array(ends - starts),
                stay.take(pa.array(starts)), stay.take(pa.array(ends - 1)),
                pa.array([s["min"].as_py() for s in spans], stay.type), pa.array([s["max"].as_py() for s in spans], stay.type),
                pa.array([bool(rises[a : b - 1].all()) for a, b in zip(starts, ends)]),
            ],
            names=["split", "path", "row", "rows", "first", "last", "low", "high", "rises"],
        )


def read_stays(spark: SparkSession, path: str, stays: Sequence) -> DataFrame:
    """Rows of a few stays of a data set written ``clustered``; only the files that may hold them are opened."""
    wanted = [F.col("first_stay") <= F.lit(s) for s in stays]
    found = reduce(lambda a, b: a | b, [c & (F.col("last_stay") >= F.lit(s)) for c, s in zip(wanted, stays)])
    files = [r["file"] for r in spark.read.parquet(f"{path}/file_index").where(found).select("file").collect()]
    rows = spark.read.option("basePath", f"{path}/rows")
    if not files:
        return rows.parquet(f"{path}/rows").where(F.lit(False))
    return rows.parquet(*[f"{path}/rows/{f}" for f in files]).where(F.col("stay_id").isin(*stays))
