"""Session settings and the materialised hand-over tables ("barriers") between passes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the aggregate above then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cohorts too large to broadcast prune the events before their shuffle, once the events' scan is worth a second look at the cohort.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
}


#: Rows up to which a written and counted table is marked for broadcast.
SMALL_ROWS = 100_000


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators count on; sizes and parallelism stay with the cluster."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


#: Shuffled bytes that a task of the catalog's queries takes, where Spark may choose, and the parts a shuffle is dealt into before
#: small ones merge. Shuffled rows of these tables are ten to twenty times their compressed size once sorted or hashed.
PART_BYTES, PARTS = 16 << 20, 200
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def small_parts(spark: SparkSession) -> SparkSession:
    """Let adaptive execution make tasks of ``PART_BYTES``. What the session sets finer stays."""
    size, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(size).strip().lower()).groups()
    if int(number) * _UNITS[unit] > PART_BYTES:
        spark.conf.set(size, str(PART_BYTES))
    parts = int(spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if parts < PARTS:
        spark.conf.set(first, str(PARTS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for hand-over tables: ``spark.checkpoint.dir``, else one inside the warehouse, which is shared as well."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_handover"


_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """Hand-over tables written inside belong to this run and are removed when it ends: write its outputs inside.

    Outside of any run they stay in the shared folder, since a returned DataFrame still reads them.
    """
    folder = f"{shared_dir(spark)}/cohortframe/run-{uuid.uuid4().hex}"
    before = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_RUN.get() or f'{shared_dir(spark)}/cohortframe/kept'}/{name}-{uuid.uuid4().hex}"


def barrier(df: DataFrame, name: str = "barrier") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: it survives lost executors and has a known size."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: list, schema: str | StructType) -> DataFrame:
    """A table of driver-side rows as a local relation: no task reads it, the planner knows its size."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [[row[i] for row in rows] for i in range(len(fields))]
    arrow = pa.Table.from_arrays(
        [pa.array(values, to_arrow_type(f.dataType)) for values, f in zip(columns, fields)], names=fields.names
    )
    return spark.createDataFrame(arrow, fields)


def held(df: DataFrame) -> DataFrame:
    """Evaluate a table once and hold it as a local relation.

    Only for tables that parameters bound: cuts (their number), top-n vocabularies (n), the features of one tensor row.
    """
    return literal_table(df.sparkSession, df.collect(), df.schema)


def small(df: DataFrame, max_rows: int = SMALL_ROWS, name: str = "small") -> DataFrame:
    """Write ``df`` once and mark it for broadcast if it really has at most ``max_rows`` rows.

    A larger table is left unmarked, so the join is a shuffle join, where AQE splits hot keys.
    """
    written = barrier(df, name)
    return F.broadcast(written) if written.count() <= max_rows else written
