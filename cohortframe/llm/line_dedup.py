"""Line dedup by the spread over distinct sites, in DataFrame operations only.

A line is what stands between line feeds; lines are equal when equal after trimming white space, and blank lines never
count. Each line hash gets a HyperLogLog sketch of the sites it occurs on; partial sketches merge by aggregation. Lines
estimated clearly at or above ``min_sites`` are boilerplate, lines near the threshold get an exact distinct count. Of a
boilerplate line only its first occurrence (smallest id, then smallest position; null id last) stays.

Null text stays null. A null site counts for no line. Rows equal in id and text are treated alike, so the first
occurrence stays in each of them. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.base import SPACES, query, read, text_mark
from cohortframe.session import barrier, small

MIN_SITES = 10
#: log2 of a sketch's registers; estimates within this share of the threshold are counted exactly.
SKETCH_BITS, NEAR = 10, 0.3


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_lines (without blank ones), n_removed, text without the removed lines, mark.

    ``mark`` tells rows with one id and different texts apart.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.col(text_col).alias("text"), text_mark(text_col).alias("mark"))
    split = rows.select("id", "mark", "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    trimmed = F.btrim("line", F.lit(SPACES))
    lines = barrier(
        split.select("id", "mark", "site", "pos", trimmed.alias("line")).where("line <> ''")
        .select("id", "mark", "site", "pos", F.unhex(F.md5("line")).alias("key")),
        "lines",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "mark", "pos")).alias("first")
    # A line that occurs in one place needs no sketch, and most do.
    counted = lines.groupBy("key").agg(F.count("*").alias("n"), first)
    often = small(counted.where(F.col("n") >= min_sites).select("key", "first"), name="often")
    # Line and site first: that combines before the shuffle and spreads a line that is on every page.
    pairs = lines.select("key", "site").join(often, "key").groupBy("key", "site").agg(F.first("first").alias("first"))
    spread = pairs.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"), F.first("first").alias("first")
    )
    spread = barrier(spread, "spread")
    near = spread.where(F.col("sites").between((1 - NEAR) * min_sites, (1 + NEAR) * min_sites)).select("key", "first")
    exact = (
        lines.select("key", "site").join(small(near, name="near"), "key").groupBy("key", "first").agg(F.countDistinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites).select("key", "first")
    )
    boilerplate = spread.where(F.col("sites") > (1 + NEAR) * min_sites).select("key", "first").unionByName(exact)
    boilerplate = small(boilerplate, name="boilerplate")
    here = F.struct(F.col("id").isNull().alias("last"), "id", "mark", "pos")
    gone = lines.join(boilerplate, "key").where(~here.eqNullSafe(F.col("first"))).groupBy("id", "mark").agg(F.collect_set("pos").alias("gone"))
    gone = gone.withColumnsRenamed({"id": "gone_id", "mark": "gone_mark"})
    counts = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left")
    all_lines = F.split("text", "\n", -1)
    counts = counts.select("id", "text", "mark", "gone", all_lines.alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    full = F.filter("lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return counts.select(
        F.col("id").alias(id_col),
        F.coalesce(F.size(full), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.element_at("lines", i + 1)), "\n")
        ).alias(text_col),
        "mark",
    )


@query(
    "op1_line_dedup",
    f"""WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, source, unnest(ls) AS raw, unnest(range(len(ls))) AS pos FROM d),
    t AS (SELECT doc_id, source, raw, pos, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
    b AS (SELECT line, min((doc_id, pos)) AS first FROM t WHERE line <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
    m AS (SELECT t.*, first IS NOT NULL AND first <> (doc_id, pos) AS gone FROM t LEFT JOIN b USING (line)),
    g AS (SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
      coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM m GROUP BY 1)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, g.text FROM d LEFT JOIN g USING (doc_id)""",
)
def op1_line_dedup(spark, sf_dir):
    """All documents; a line on ten or more sources is boilerplate."""
    return line_dedup(read(spark, sf_dir, "documents")).drop("mark")
