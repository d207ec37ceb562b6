"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Each document gets a 60-bit number from its id and text. A source's target is reached by as many whole passes over the
source as fit, and by the documents below a threshold for the rest. The threshold comes from histograms: sizes are summed
by source and leading digits of the number, the digit group where the running sum passes the budget is refined by the
next digits, and so on. No documents are sorted; each level reads only what the level before left open.

Null text has size 0; a null source is a source of its own and comes last. Rows equal in id and text share their number
and so are taken together. Documents without words are taken once where at least one pass is whole. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortframe.llm.base import query, read, text_mark, words
from cohortframe.session import barrier

WEIGHTS = (5, 2, 1)
#: Digit groups: 5 levels of 12 bits.
LEVELS, BITS = 5, 12


def number(id_col: str, text_col: str) -> Column:
    """60 bits of md5: the same in any engine."""
    seed = F.concat_ws("|", F.col(id_col).cast("string"), F.md5(F.coalesce(text_col, F.lit(""))))
    return F.conv(F.substring(F.md5(seed), 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``source, source_size`` plus ``target``: a share of all words by weight, no source above ``most`` times its size.

    Sources by code point, null last, take the weights in turn. Resharing the excess by weight until none is above
    ends where each source has min(cap, weight x level), with one level for all. Sorted by cap / weight, the sources at
    their cap come first, so running sums give the level. The windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("bigint"))
    a, b = share
    # All whole numbers: b times the wanted sum, the caps before a row, the weights from it on.
    before = Window.orderBy((F.col("source_size") * most / F.col("w")), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    everything = Window.partitionBy()
    rows = rows.withColumns(
        {
            "need": F.sum("source_size").over(everything) * a - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)) * b,
            "left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)),
        }
    )
    # The level that the row would give were it the first below its cap; the first such row decides.
    fits = F.col("need") * F.col("w") <= F.col("source_size") * most * b * F.col("left")
    rows = rows.withColumn("at", F.min(F.when(fits, F.struct(F.col("source_size") * most / F.col("w"), "need", "left"))).over(everything))
    fair = F.col("at.need") * F.col("w") / (F.col("at.left") * b)
    return rows.select("source", "source_size", F.round(F.least(F.col("source_size") * most, F.coalesce(fair, F.col("source_size") * most)).cast("double"), 6).alias("target"))


def _digits(level: int) -> Column:
    """The leading digit groups down to ``level``."""
    return F.shiftright("u", BITS * (LEVELS - 1 - level))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """One row per document: id, size, source, source_size, target, taken (size times the passes), passes, mark.

    ``mark`` tells rows with one id and different texts apart.
    """
    sized = barrier(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.size(words(text_col)).cast("bigint").alias("size"),
            number(id_col, text_col).alias("u"), text_mark(text_col).alias("mark"),
        ),
        "sizes",
    )
    per_source = barrier(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **kw), "targets")
    # Whole passes, then the budget of the last one. spent: words below the open digit group.
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    open_ = per_source.withColumn("passes", full).select(
        "source", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("spent"),
    )
    for level in range(LEVELS):
        table = open_.withColumnRenamed("source", "s")
        part = sized if level == 0 else sized.withColumn("p", _digits(level - 1))
        on = F.col("source").eqNullSafe(F.col("s"))
        if level:
            on = on & (F.col("p") == F.col("prefix"))
        bins = part.join(table, on).groupBy("source", "passes", "budget", "spent", _digits(level).alias("bin")).agg(F.sum("size").alias("n"))
        # At most 2**BITS rows a source.
        run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bins = bins.withColumn("upto", F.col("spent") + F.sum("n").over(run))
        # The first group that passes the budget, or the last one.
        pick = F.struct((F.col("upto") < F.col("budget")).alias("below"), F.when(F.col("upto") < F.col("budget"), -F.col("bin")).otherwise(F.col("bin")).alias("o"), "bin", "upto", "n")
        open_ = barrier(
            bins.groupBy("source", "passes", "budget").agg(F.min(pick).alias("m")).select(
                "source", "passes", "budget", F.col("m.bin").alias("prefix"), (F.col("m.upto") - F.col("m.n")).alias("spent"),
                F.col("m.upto").alias("upto"),
            ),
            "boundary",
        ).select("source", "passes", "budget", "prefix", "spent", *(["upto"] if level == LEVELS - 1 else []))
    # The documents at the boundary number go in if that comes nearer to the budget.
    limit = open_.select(
        F.col("source").alias("s"), "passes",
        (F.col("prefix") + F.when(F.col("upto") - F.col("budget") <= F.col("budget") - F.col("spent"), 1).otherwise(0)).alias("limit"),
    )
    plan = per_source.withColumnRenamed("source", "t").join(limit, F.col("t").eqNullSafe(F.col("s"))).drop("s")
    once = F.col("passes") + F.when((F.col("u") < F.col("limit")) & (F.col("passes") < 2), 1).otherwise(0)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("t"))).select(
        F.col("id").alias(id_col), "size", "source", "source_size", "target", (F.col("size") * once).alias("taken"), once.alias("passes"), "mark"
    )


SQL = r"""WITH d AS (
      SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size,
        ('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS u FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
    w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
    l AS (SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) OVER b, 0) AS need,
        sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS rest FROM w
        WINDOW b AS (ORDER BY source_size * 2 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    f AS (SELECT arg_min(need, source_size * 2 / w) AS need, arg_min(rest, source_size * 2 / w) AS rest FROM l WHERE need * w <= 4 * source_size * rest),
    t AS (SELECT source, source_size, round(least(2 * source_size, CAST(need * w AS DOUBLE) / CAST(rest * 2 AS DOUBLE))::DOUBLE, 6) AS target
        FROM w, f),
    p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
    c AS (SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS budget,
        sum(size) OVER (PARTITION BY d.source ORDER BY u) AS upto, sum(size) OVER (PARTITION BY d.source, u) AS here
        FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
    m AS (SELECT source, min(u) FILTER (upto >= budget) AS edge FROM c GROUP BY 1)
    SELECT doc_id, CAST(size AS BIGINT) AS size, c.source, source_size, target, CAST(size * n AS BIGINT) AS taken, n AS passes FROM (
      SELECT c.*, CAST(passes + CASE WHEN passes < 2 AND (edge IS NULL OR u < edge OR (u = edge AND upto - budget <= budget - (upto - here)))
        THEN 1 ELSE 0 END AS BIGINT) AS n FROM c JOIN m ON c.source IS NOT DISTINCT FROM m.source) c"""


@query("op2_mixing", SQL)
def op2_mixing(spark, sf_dir):
    """All documents; 150 % of all words, weights 5, 2, 1 by source, at most two passes."""
    return mix(read(spark, sf_dir, "documents")).drop("mark")
