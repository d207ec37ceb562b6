"""How filters interact: what each removes in every order, and its fair share of all that is removed.

The filters of a coalition S remove the documents that fail at least one of them: ``v(S)`` of them. This removal game has
a potential (Hart and Mas-Colell), computed recursively over the coalitions: ``P(S) = (v(S) + sum of P(S without i)) / |S|``
with ``P(nothing) = 0``. The Shapley value of a filter is the grand potential minus the potential without that filter.
Scaled by the factorial of ``|S|`` the recursion stays in whole numbers, and a filter's value times the number of orders
is its removals summed over all orders. What a filter removes at a step of an order is ``v`` of the coalition up to it
minus ``v`` of the coalition before it. So documents are counted once only, by part and set of failed filters.

Nulls: null text is empty and a null part is the empty string. A null id is not smaller than any other, nor any other
smaller than it, and has no label. Rows equal in id and text do not repeat each other, and each counts. An id with several
labels has the largest of each. Texts are compared by their SHA-256. Columns besides the named ones are ignored. An empty
table gives an empty result.

Scale: each text is read once and becomes a row of about a hundred bytes, which is written. First copies come from an
aggregate that combines map-side and a join on text and id together, so the copies of a text held by a third of all rows
spread over all tasks. The counts have at most 32 rows a part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.base import query, read, words
from cohortframe.session import barrier, small

#: Stands for the condition that a smaller id has the same text.
REPEATED = None
MEASURES = ("n", "good", "toxic")
OUT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def failures(text: Column, word: Column) -> Mapping[str, Column | None]:
    """When a document fails each filter, from its text and its array of words."""
    n, capitals = F.size(word), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(word)) < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
        "E": REPEATED,
    }


def coalition_counts(
    docs: DataFrame, labels: DataFrame, conditions: Callable[[Column, Column], Mapping[str, Column | None]] = failures,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> tuple[DataFrame, str]:
    """``(part, mask, n, good, toxic)``: documents by part and set of failed filters (bit i: the i-th), and their names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("word", words("text"))
    failed = dict(conditions(F.col("text"), F.col("word")))
    mask = F.lit(0)
    for i, condition in enumerate(failed.values()):
        if condition is not REPEATED:
            mask = mask + F.when(condition, 1 << i).otherwise(0)
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.cast("int").alias("mask"))
    known = labels.select(
        F.col("doc_id").alias("label_id"), (F.col("quality") == 1).cast("bigint").alias("good"), (F.col("toxic") == 1).cast("bigint").alias("toxic")
    ).where("label_id IS NOT NULL").groupBy("label_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    known = small(known, name="labels")
    rows = rows.join(known, F.col("id") == F.col("label_id"), "left").select(
        "id", "part", "digest", "mask", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("good", "toxic")]
    )
    again = [i for i, condition in enumerate(failed.values()) if condition is REPEATED]
    if again:
        rows = barrier(rows, "failed")
        heads = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("head")).select(F.col("digest").alias("head_digest"), "head")
        # Text and id together: the copies of one text spread over all tasks.
        rows = rows.join(heads, (F.col("digest") == F.col("head_digest")) & (F.col("id") == F.col("head")), "left")
        repeated = F.col("id").isNotNull() & F.col("head").isNull()
        rows = rows.withColumn("mask", F.col("mask") + F.when(repeated, sum(1 << i for i in again)).otherwise(0))
    counts = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return counts, "".join(failed)


class Game:
    """The removal games of many parts at once: rows are parts, columns are sets of filters as bit masks."""

    def __init__(self, counts: np.ndarray):
        sets = np.arange(counts.shape[1])
        self.filters = int(counts.shape[1]).bit_length() - 1
        #: ``removed[:, S]``: documents that fail a filter of S.
        self.removed = counts @ (sets[:, None] & sets[None, :] != 0).astype(np.int64)

    def potentials(self) -> np.ndarray:
        """The potential of every coalition times the factorial of its size."""
        p = np.zeros_like(self.removed)
        for s in range(1, p.shape[1]):
            inside = [i for i in range(self.filters) if s >> i & 1]
            p[:, s] = factorial(len(inside) - 1) * self.removed[:, s] + sum(p[:, s ^ 1 << i] for i in inside)
        return p

    def shapley(self) -> np.ndarray:
        """The value of each filter times the number of orders."""
        p, grand = self.potentials(), (1 << self.filters) - 1
        without = p[:, [grand ^ 1 << i for i in range(self.filters)]]
        return p[:, [grand]] - self.filters * without


def interactions(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley (removals of the step's filter summed over all orders)."""
    k = len(names)
    sets = 1 << k
    orders = list(permutations(range(k)))
    at = np.array([i for order in orders for i in order])
    before = np.array([sum(1 << i for i in order[:step]) for order in orders for step in range(k)])
    upto, alone, rest = before | 1 << at, 1 << at, (sets - 1) ^ 1 << at
    named = pa.array(["".join(names[i] for i in order) for order in orders for _ in range(k)])
    steps = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                found = np.zeros((3, some.num_rows, sets), np.int64)
                for row, entries in enumerate(some.column(1).to_pylist()):
                    for e in entries:
                        found[:, row, e["mask"]] = [e[m] for m in MEASURES]
                games = [Game(f) for f in found]
                v = games[0].removed
                removed, fails = v[:, upto] - v[:, before], v[:, alone]
                lost = [g.removed[:, upto] - g.removed[:, before] for g in games[1:]]
                columns = [found[0].sum(1)[:, None] - v[:, upto], removed, fails - removed, v[:, [-1]] - v[:, rest], *lost, games[0].shapley()[:, at]]
                where = np.repeat(np.arange(some.num_rows), len(at))
                again = np.tile(np.arange(len(at)), some.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(where)), named.take(pa.array(again)), steps.take(pa.array(again)), *[pa.array(c.ravel()) for c in columns]],
                    names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
                )

    # At most one entry for each set of filters.
    gathered = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("sets"))
    return gathered.mapInArrow(run, OUT)


def audit(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """``interactions`` of the filters over ``docs``; ``kw`` are those of ``coalition_counts``."""
    return interactions(*coalition_counts(docs, labels, **kw))


@query(
    "op12_filter_audit",
    r"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS txt FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(txt, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM t),
    f AS (SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(txt, '[^A-Z]+', '', 'g')) > 5 * length(txt) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(txt, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY txt) THEN 16 ELSE 0 END AS mask FROM w),
    b AS (SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic FROM labels GROUP BY 1),
    m AS (SELECT part, mask, count(*) AS n, count(good) AS good, count(toxic) AS toxic FROM f LEFT JOIN b USING (doc_id) GROUP BY 1, 2),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM l a, l b, l c, l d, l e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
    s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit,
        CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before FROM o, range(1, 6) r(step)),
    r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM m, s GROUP BY 1, 2, 3, 4)
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
        unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r""",
)
def op12_filter_audit(spark, sf_dir):
    """Five filters over all documents, in all 120 orders, by source."""
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
