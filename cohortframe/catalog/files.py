"""Queries over sources and sinks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import Tables, query
from cohortframe.functions import scalars as S
from cohortframe.sources import schemas, tables

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"


@query(
    "typed_csv_scan",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS ordered_us,
      CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority FROM orders""",
)
def typed_csv_scan(t: Tables):
    """Orders as CSV, read with a schema and named columns; the date and a number are parsed from text."""
    path = tables.write_csv(t.read("orders"), session.fresh_path(t.spark, "orders-csv"))
    scan = tables.read_csv(t.spark, path, _ORDERS, ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return scan.select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        S.micros(S.to_time("o_orderdate")).alias("ordered_us"),
        S.to_number(F.substring("o_orderpriority", 1, 1)).alias("priority"),
    )


@query(
    "prepared_csv_roundtrip",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem",
)
def prepared_csv_roundtrip(t: Tables):
    """Line items written as gzip CSV parts and read back by header name."""
    lines = t.read("lineitem").select("l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber", "l_discount")
    path = tables.write_csv(lines, session.fresh_path(t.spark, "lines-csv"), compressed=True)
    schema = "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string"
    return tables.read_csv_by_name(t.spark, path, schema)


_TIMES = ("dd.MM.yyyy HH:mm:ss.SSSSSS",)


@query(
    "ed_csv_series",
    """SELECT user_id AS stay_id, epoch_us(ts) AS instant_us, event_type AS feature, value, CAST(0 AS BIGINT) AS n_unparsed FROM events
      UNION ALL SELECT -1, NULL, 'none', NULL, 1""",
)
def ed_csv_series(t: Tables):
    """Events as a gzip CSV of the emergency schema with times in a form of their own; one time is no time at all."""
    events = t.read("events").select(
        F.col("user_id").alias("CSN"), F.date_format(F.col("ts").cast("timestamp"), _TIMES[0]).alias("Time"),
        F.col("event_type").alias("Measure"), F.col("value").alias("Value"),
    )
    nothing = F.lit(None).cast("double").alias("Value")
    bad = t.spark.range(1).select(F.lit(-1).alias("CSN"), F.lit("soon").alias("Time"), F.lit("none").alias("Measure"), nothing)
    path = tables.write_csv(events.unionByName(bad), session.fresh_path(t.spark, "ed-csv"), compressed=True)
    scan = tables.spread_after_gzip(tables.read_csv_by_name(t.spark, path, schemas.ED_NUMERICS), 8)
    instant = S.to_time("Time", *_TIMES)
    lost = tables.unparsed(scan, {"Time": instant}).select("n_unparsed").scalar()
    named = scan.select(
        F.col("CSN").alias("stay_id"), S.micros(instant).alias("instant_us"), F.col("Measure").alias("feature"), F.col("Value").alias("value")
    )
    return named.withColumn("n_unparsed", F.when(F.col("instant_us").isNull(), lost).otherwise(F.lit(0)).cast("bigint"))


_REQUIRED = {
    "events": ["user_id", "ts", "event_type", "value"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "documents": ["doc_id", "text", "report_time"],
}


@query(
    "input_check",
    """WITH c AS (SELECT 'events' AS t, column_name AS c FROM (DESCRIBE events) UNION ALL
      SELECT 'orders', column_name FROM (DESCRIBE orders) UNION ALL SELECT 'documents', column_name FROM (DESCRIBE documents)),
    r AS (SELECT unnest(['events', 'events', 'events', 'events', 'orders', 'orders', 'orders', 'documents', 'documents', 'documents']) AS t,
      unnest(['user_id', 'ts', 'event_type', 'value', 'o_orderkey', 'o_custkey', 'o_orderdate', 'doc_id', 'text', 'report_time']) AS c),
    s AS (SELECT 'events' AS t, count(*) AS n FROM events UNION ALL SELECT 'orders', count(*) FROM orders
      UNION ALL SELECT 'documents', count(*) FROM documents)
    SELECT t AS "table", NULL::VARCHAR AS "column", CASE WHEN n = 0 THEN 'empty table' ELSE 'found' END AS status FROM s
    UNION ALL SELECT r.t, r.c, CASE WHEN c.c IS NULL THEN 'missing column' ELSE 'found' END FROM r LEFT JOIN c ON c.t = r.t AND c.c = r.c
    UNION ALL SELECT 'vitals', NULL, 'missing table'""",
)
def input_check(t: Tables):
    given = {name: t.read(name) for name in _REQUIRED}
    return tables.check_inputs(t.spark, given, {**_REQUIRED, "vitals": ["stay_id"]})


# --- header-checked scans ---------------------------------------------------------------------------------------------

_MESSY = """CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' WHEN o_orderkey % 31 = 0 THEN 'NaN' WHEN o_orderkey % 37 = 0 THEN ''
    ELSE CAST(o_totalprice AS STRING) END AS price,
  CASE WHEN o_orderkey % 23 = 0 THEN 'soon' ELSE CAST(o_orderdate AS STRING) END AS ordered,
  o_orderkey % 41 = 0 AS cut, o_orderkey % 43 = 0 AND o_orderkey % 41 <> 0 AS longer"""
_SCAN = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp"


def _messy_scan(t: Tables):
    """Orders as CSV with the columns in another order, one column more, broken lines and texts that are no values."""
    orders = t.read("orders").selectExpr("o_orderkey", "o_orderpriority", *_columns(_MESSY))
    fields = F.concat_ws(",", "price", "o_orderpriority", F.col("o_orderkey").cast("string"), "ordered")
    line = F.when(F.col("cut"), F.concat_ws(",", "price", F.col("o_orderkey").cast("string"))).otherwise(fields)
    lines = orders.select(F.when(F.col("longer"), F.concat(line, F.lit(",more,and more"))).otherwise(line).alias("value"))

    def with_header(batches):
        kind = pa.schema([("value", pa.string())])
        yield pa.RecordBatch.from_arrays([pa.array(["o_totalprice,o_orderpriority,o_orderkey,o_orderdate"])], schema=kind)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], schema=kind)

    path = session.fresh_path(t.spark, "messy-csv")
    lines.repartition(4).mapInArrow(with_header, "value string").write.text(path)
    return tables.scan_csv(t.spark, path, _SCAN)


def _columns(sql: str) -> list[str]:
    """Top-level parts of a select list."""
    return [part.strip() for part in sql.replace(" AS price,", " AS price;").replace(" AS ordered,", " AS ordered;").replace(" AS cut,", " AS cut;").split(";")]


_MESSY_SQL = f"m AS (SELECT o_orderkey, o_orderdate, {_MESSY.replace('STRING', 'VARCHAR')} FROM orders)"


@query(
    "csv_scan_rows",
    f"""WITH {_MESSY_SQL} SELECT o_orderkey, CASE WHEN price NOT IN ('n/a', 'NaN', '') THEN CAST(price AS DOUBLE) END AS o_totalprice,
      CASE WHEN ordered <> 'soon' THEN epoch_us(o_orderdate) END AS ordered_us FROM m WHERE NOT cut AND NOT longer""",
)
def csv_scan_rows(t: Tables):
    rows, _ = _messy_scan(t)
    return rows.select("o_orderkey", "o_totalprice", S.micros("o_orderdate").alias("ordered_us"))


@query(
    "csv_scan_rejects",
    f"""WITH {_MESSY_SQL} SELECT 'fields' AS kind, NULL::VARCHAR AS "column", count(*) AS n FROM m WHERE cut OR longer
    UNION ALL SELECT 'values', 'o_totalprice', count(*) FROM m WHERE price = 'n/a' AND NOT cut AND NOT longer
    UNION ALL SELECT 'values', 'o_orderdate', count(*) FROM m WHERE ordered = 'soon' AND NOT cut AND NOT longer""",
)
def csv_scan_rejects(t: Tables):
    _, rejects = _messy_scan(t)
    return tables.reject_counts(rejects)


@query(
    "clustered_file_order",
    """SELECT o_orderkey AS stay_id, o_orderstatus AS split, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS place,
      CAST(1 AS BIGINT) AS n_files, true AS in_order FROM orders""",
)
def clustered_file_order(t: Tables):
    """Orders as the rows of a clustered data set: their place, read off the files, and the files that may hold each."""
    rows = t.read("orders").select(F.col("o_orderkey").alias("stay_id"), F.col("o_orderstatus").alias("split"), "o_totalprice")
    path = session.fresh_path(t.spark, "clustered")
    tables.write_dataset({"rows": rows}, path, clustered=True)
    index = t.spark.read.parquet(f"{path}/file_index")
    later = index.select(F.col("split").alias("s"), F.col("first_stay").alias("f"), F.col("rows").alias("before"))
    # A row for each file.
    started = index.join(later, (F.col("s") == F.col("split")) & (F.col("f") < F.col("first_stay")), "left").groupBy(
        "file", "split", "first_stay", "last_stay", "in_order").agg(F.coalesce(F.sum("before"), F.lit(0)).alias("start"))
    # A stay lies in the range of its own file, so only files whose ranges meet that one may hold it too: few, and known by file.
    spans = index.select(F.col("split").alias("s"), F.col("first_stay").alias("f"), F.col("last_stay").alias("l"))
    meets = (F.col("s") == F.col("split")) & (F.col("f") <= F.col("last_stay")) & (F.col("l") >= F.col("first_stay"))
    near = index.join(spans, meets).groupBy("file").agg(F.collect_list(F.struct("f", "l")).alias("near"))
    started = session.small(started.join(near, "file"))
    back = t.spark.read.parquet(f"{path}/rows").select(
        "stay_id", "split", F.regexp_extract("_metadata.file_path", "/rows/(split=.*)$", 1).alias("file"), F.col("_metadata.row_index").alias("row")
    )
    holds = F.size(F.filter("near", lambda span: F.col("stay_id").between(span["f"], span["l"])))
    placed = back.join(started.select("file", "start", "in_order", "near"), "file")
    return placed.select(
        "stay_id", "split", (F.col("start") + F.col("row") + 1).alias("place"), "in_order", holds.cast("bigint").alias("n_files")
    ).where(F.col("n_files") > 0)
