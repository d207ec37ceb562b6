"""Exact dedup of a new batch against a history through a minimal perfect hash.

The distinct digests of the history are dealt to shards by their first bytes. Each shard gets a minimal perfect hash
(levels of bit vectors; a key takes the first level where it collides with no other). The slot of a key holds the full
digest and the locator of the row that stays. A digest of the batch is looked up, its bytes are compared with the slot,
and only an equal slot makes it a member; nonmembers form groups of their own.

Null or empty text has the empty normal form. Of equal texts the row with the most code points in its original text
stays, then the smallest id (null last), then any single one of fully equal rows. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.base import SPACES, query, read, rows_per_group
from cohortframe.session import barrier

#: Bits of a level for each key that is still to be placed.
GAMMA = 1.5
#: Distinct digests that one shard holds; a shard is built and looked up in one task.
SHARD_KEYS = 50_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(digests: np.ndarray) -> np.ndarray:
    """64 bits of each digest of ``n x 32`` bytes; distinct digests with equal bits end in the fallback list."""
    parts = np.ascontiguousarray(digests).view(np.uint64).reshape(len(digests), 4)
    return parts[:, 1] ^ (parts[:, 2] * _MIX)


class PerfectHash:
    """Maps ``n`` distinct digests to the slots 0..n-1. Any other digest gets some slot or -1."""

    def __init__(self, digests: np.ndarray):
        keys, left = _keys(digests), np.arange(len(digests))
        self.levels: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        taken = 0
        while len(left) and len(self.levels) < 40:
            size = max(64, int(GAMMA * len(left)))
            at = self._place(keys[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            self.starts.append(taken + np.concatenate([[0], np.cumsum(alone)[:-1]]))
            taken += int(alone.sum())
            left = left[~alone[at]]
        self.rest = {digests[i].tobytes(): taken + n for n, i in enumerate(left)}

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(keys + np.uint64(int(_MIX) * (level + 1) % 2**64)) % np.uint64(size)).astype(np.int64)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        keys, out = _keys(digests), np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for level, (bits, starts) in enumerate(zip(self.levels, self.starts)):
            at = self._place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = starts[at[hit]]
            left = left[~hit]
        for i in left if self.rest else ():
            out[i] = self.rest.get(digests[i].tobytes(), -1)
        return out


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(-1, 32)


def _better(a: dict, b: dict) -> dict:
    """The better of two locators: most code points, then smallest id with null last, then smallest row."""
    order = lambda x: (-x["chars"], x["id"] is None, x["id"] or 0, x["row"])
    return a if order(a) <= order(b) else b


OUT = "digest binary, id bigint, chars bigint, row bigint, size bigint, known boolean"


def _look_up(known: pa.Table, new: pa.Table) -> pa.Table:
    """The classes of one shard: members of the history merged with the batch, nonmembers for themselves."""
    names = ["digest", "id", "chars", "row", "size"]
    out = []
    new_rows = new.select(names).to_pylist() if new.num_rows else []
    if known.num_rows:
        digests = _digests(known["digest"])
        table = PerfectHash(digests)
        at = table.slots(digests)
        slot_digest = np.empty_like(digests)
        slot_digest[at] = digests
        locators: list[dict] = [{}] * len(at)
        for i, row in zip(at, known.select(names).to_pylist()):
            locators[i] = row | {"known": True}
        if new_rows:
            sought = _digests(new["digest"])
            found = table.slots(sought)
            member = (found >= 0) & (slot_digest[np.maximum(found, 0)] == sought).all(1)
            for slot, ok, row in zip(found, member, new_rows):
                if ok:
                    here = locators[slot]
                    locators[slot] = _better(here, row) | {"size": here["size"] + row["size"], "known": True}
                else:
                    out.append(row | {"known": False})
        out += locators
    else:
        out = [row | {"known": False} for row in new_rows]
    columns = {n: [x[n] for x in out] for n in [*names, "known"]}
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.table({n: pa.array(columns[n], k) for n, k in zip(columns, kinds)})


def exact_dedup(docs: DataFrame, history: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, in_history (its class was there before).

    ``history`` marks the rows that were there before; the rest are the new batch (null counts as new).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = barrier(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.length(text).cast("bigint").alias("chars"),
            F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"),
            F.coalesce(history, F.lit(False)).alias("old"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    # ~x is -x - 1: the largest struct holds the smallest id, and null comes last.
    order = F.struct("chars", F.bitwise_not("id").alias("id"), F.bitwise_not("row").alias("row"))
    grouped = (
        rows.groupBy("digest", "old")
        .agg(F.max(order).alias("best"), F.count("*").alias("size"))
        .select(
            "digest", "old", "size", F.col("best.chars").alias("chars"),
            F.bitwise_not("best.id").alias("id"), F.bitwise_not("best.row").alias("row"),
        )
    )
    shards = rows_per_group(rows.count(), SHARD_KEYS)
    grouped = grouped.withColumn("shard", F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint"), F.lit(shards)))
    # Columns of their own for each side: a cogroup takes columns of one origin for the same.
    names = ["digest", "id", "chars", "row", "size", "shard"]
    sides = [grouped.where(on).select(*[F.col(n).alias(f"{n}_{k}") for n in names]) for k, on in enumerate((F.col("old"), ~F.col("old")))]
    classes = sides[0].groupBy("shard_0").cogroup(sides[1].groupBy("shard_1")).applyInArrow(
        lambda known, new: _look_up(*(t.rename_columns([n[:-2] for n in t.column_names]) for t in (known, new))), OUT
    )
    # No column is read from docs here: names that clash with these can't matter.
    classes = classes.select("digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), "size", "known")
    return rows.join(classes, "digest").select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("known").alias("in_history"),
    )


@query(
    "op6_exact_dedup",
    """WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS chars, doc_id % 2 = 0 AS old,
      sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
      FROM documents),
    g AS (SELECT text_sha256, count(*) AS group_size, arg_max(doc_id, (chars, -doc_id)) AS keep_id, bool_or(old) AS in_history
      FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256, in_history FROM d JOIN g USING (text_sha256)""",
)
def op6_exact_dedup(spark, sf_dir):
    """All documents; the even ids are the history, the odd ones the batch that arrives."""
    return exact_dedup(read(spark, sf_dir, "documents"), F.col("doc_id") % 2 == 0)
