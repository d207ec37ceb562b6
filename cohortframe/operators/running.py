"""Running totals and products over a global or per-group order, without one task holding an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.functions.scalars import MICROS_PER_HOUR

_LOW, _HIGH = 20, 40
TASK_ROWS = 1 << 20


def biggest_group(df: DataFrame, by: Sequence[str] = ()) -> int:
    """Rows of the largest group of a materialised table."""
    if not by:
        return df.count()
    return df.groupBy(*by).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0


def sized(df: DataFrame, by: Sequence[str] = (), name: str = "sized") -> tuple[DataFrame, int]:
    """Materialise ``df`` and measure its largest group."""
    kept = session.barrier(df, name)
    return kept, biggest_group(kept, by)


def _scan(df: DataFrame, part: list[str], order: str, sums, factor, weighted, before: bool) -> DataFrame:
    """Running values inside one window group: up to the row, or up to the row before it."""
    ordered = Window.partitionBy(*part).orderBy(order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    out = {f"_s_{c}": F.coalesce(F.sum(c).over(upto), F.lit(0).cast("double")) for c in sums}
    if factor:
        out["_p"] = F.coalesce(F.product(factor).over(upto), F.lit(1.0))
        out["_q"] = F.coalesce(F.product(factor).over(earlier), F.lit(1.0))
    df = df.withColumns(out)
    if weighted:
        df = df.withColumns({f"_t_{c}": F.col("_q") * F.col(c) for c in weighted})
        df = df.withColumns({f"_w_{c}": F.coalesce(F.sum(f"_t_{c}").over(upto), F.lit(0.0)) for c in weighted})
    return df


def _totals(df: DataFrame, part: list[str], sums, factor, weighted) -> DataFrame:
    aggs = [F.sum(c).alias(c) for c in sums]
    aggs += [F.product(factor).alias(factor)] if factor else []
    aggs += [F.sum(f"_t_{c}").alias(c) for c in weighted]
    return df.groupBy(*part).agg(*aggs)


def _one_level(df: DataFrame, order: str, by: list, sums, factor, weighted) -> DataFrame:
    done = _scan(df, by, order, sums, factor, weighted, before=False)
    out = {f"run_{c}": F.col(f"_s_{c}") for c in sums}
    if factor:
        out |= {"run_product": F.col("_p"), "product_before": F.col("_q")}
    out |= {f"run_{c}": F.col(f"_w_{c}") for c in weighted}
    return done.select(*df.columns, *[v.alias(k) for k, v in out.items()])


def _three_levels(df: DataFrame, order: str, by: list, sums, factor, weighted, ticks) -> DataFrame:
    """The order is cut in three digits of 2^20 ticks. One window runs inside each digit, the totals carry over to the
    next, so a task sorts at most the rows of 2^20 ticks however skewed the order is, and the top level is tiny."""
    tick = F.round(F.col(order) * F.lit(MICROS_PER_HOUR)).cast("bigint") if ticks is None else ticks
    base = df.withColumns({"_hi": F.shiftright(tick, _HIGH), "_mid": F.shiftright(tick, _LOW)})
    args = (sums, factor, weighted)

    low_part, mid_part = [*by, "_hi", "_mid"], [*by, "_hi"]
    low = _scan(base, low_part, order, *args, before=False)
    mid = _scan(_totals(low, low_part, *args), mid_part, "_mid", *args, before=True)
    high = _scan(_totals(mid, mid_part, *args), by, "_hi", *args, before=True)

    def carried(level: DataFrame, keys: list[str], tag: str) -> DataFrame:
        kept = [c for c in level.columns if c.startswith(("_s_", "_p", "_w_"))]
        return level.select(*keys, *[F.col(c).alias(f"{tag}{c}") for c in kept])

    joined = low.join(carried(mid, low_part, "m"), low_part).join(carried(high, mid_part, "h"), mid_part)
    out = {f"run_{c}": F.col(f"h_s_{c}") + F.col(f"m_s_{c}") + F.col(f"_s_{c}") for c in sums}
    if factor:
        above = F.col("h_p") * F.col("m_p")
        out["run_product"] = above * F.col("_p")
        out["product_before"] = above * F.col("_q")
    for c in weighted:
        inner = F.col(f"m_w_{c}") + F.col("m_p") * F.col(f"_w_{c}")
        out[f"run_{c}"] = F.col(f"h_w_{c}") + F.col("h_p") * inner
    return joined.select(*df.columns, *[v.alias(k) for k, v in out.items()])


def running(
    df: DataFrame,
    order: str,
    by: Sequence[str] = (),
    sums: Sequence[str] = (),
    factor: str | None = None,
    weighted: Sequence[str] = (),
    ticks: Column | None = None,
    biggest: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add, in ascending ``order`` (unique within ``by``):

    * ``run_<c>`` for each of ``sums``: running sum up to and with the row,
    * ``run_product``: running product of ``factor``, and ``product_before`` without the row itself,
    * ``run_<c>`` for each of ``weighted``: running sum of ``product_before * c``.

    The largest group is measured first (``biggest`` passes a known size). Groups of at most ``task_rows`` rows go
    through one window; larger ones through three levels of bounded windows, for which ``ticks`` maps the order to
    non-decreasing whole numbers (default: an order in hours, to microseconds). Columns in ``by`` must not be NULL.
    """
    by, sums, weighted = list(by), list(sums), list(weighted)
    if biggest is None:
        df, biggest = sized(df, by, "running")
    elif biggest > task_rows:
        df = session.barrier(df, "running")
    if biggest <= task_rows:
        return _one_level(df, order, by, sums, factor, weighted)
    return _three_levels(df, order, by, sums, factor, weighted, ticks)


#: Bits of a row's place within its partition in ``monotonically_increasing_id``.
_PLACE_BITS = 33


def ranked(
    df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), name: str = "rank", task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add the place of each row from 1 in ``order`` (unique within ``by``), whatever the type of the order.

    Up to ``task_rows`` rows in the largest group go through one window. Beyond, rows are dealt to partitions by range,
    sorted there and written with their place; the partitions' row counts, one number each, are added up to offsets. No
    task sees more than its range. Both ways give the same places. NULLs come first.
    """
    by, keys = list(by), [S.col(c) for c in order]
    kept, biggest = sized(df, by, "ranked")
    if biggest <= task_rows:
        return kept.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*keys)))
    sort = [*map(F.col, by), *keys]
    spread = kept.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id())
    spread = session.barrier(spread, "ranked").withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    # A row for each partition of the shuffle.
    counts, offsets, before = sorted(map(tuple, spread.groupBy("_part").count().collect())), [], 0
    for part, n in counts:
        offsets.append((part, before - (part << _PLACE_BITS)))
        before += n
    table = session.literal_table(df.sparkSession, offsets, "_part bigint, _offset bigint")
    placed = spread.join(F.broadcast(table), "_part").withColumn(name, F.col("_at") + F.col("_offset") + 1).drop("_part", "_offset", "_at")
    if by:
        first = session.small(placed.groupBy(*by).agg(F.min(name).alias("_first")), name="group_starts")
        placed = placed.join(first, list(by)).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first")
    return placed.withColumn(name, F.col(name).cast("int"))


def quantile_of_counts(counts: DataFrame, value: str, n: str, by: Sequence[str] = (), q: float = 0.5) -> DataFrame:
    """Exact, linearly interpolated quantile of ``value`` repeated ``n`` times; one row per group.

    ``counts`` has one row per (group, value). No group is gathered in one aggregate buffer.
    """
    by = list(by)
    counts, biggest = sized(counts, by, "counts")
    ranked = with_total(running(counts, value, by, sums=[n], biggest=biggest), counts, n, by)
    at = (F.col("_total") - 1) * F.lit(q)
    ranked = ranked.withColumns({"_lo": F.floor(at) + 1, "_hi": F.ceil(at) + 1, "_frac": at - F.floor(at)})
    ends = ranked.groupBy(*by).agg(
        F.min(F.when(F.col(f"run_{n}") >= F.col("_lo"), F.col(value))).alias("_a"),
        F.min(F.when(F.col(f"run_{n}") >= F.col("_hi"), F.col(value))).alias("_b"),
        F.first("_frac").alias("_frac"),
    )
    return ends.select(*by, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")).alias("quantile"))


def with_total(df: DataFrame, counts: DataFrame, n: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``_total``: the sum of ``n`` over the row's group of the materialised ``counts``.

    The totals are broadcast if there are few groups; otherwise they are written, so that AQE can split a hot group.
    """
    if by:
        totals = session.small(counts.groupBy(*by).agg(F.sum(n).alias("_total")), name="totals")
        return df.join(totals, list(by))
    return df.withColumn("_total", counts.agg(F.sum(n)).scalar())
