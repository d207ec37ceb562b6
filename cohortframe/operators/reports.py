"""Report texts and their embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.functions import scalars as S

Encoder = Callable[[list[str]], "list[list[float]]"]


def join_reports(reports: DataFrame, stays: DataFrame) -> DataFrame:
    """Reports of the stay's own admission, matched on patient and admission."""
    return reports.join(stays, ["subject_id", "hadm_id"], "inner")


def report_text(df: DataFrame, *parts: str) -> DataFrame:
    """``text`` from parts that must all be present."""
    return df.dropna(subset=list(parts)).withColumn("text", F.concat_ws(" ", *parts))


def tokens(text) -> Column:
    return F.array_remove(F.split(F.lower(S.col(text)), "[^\\p{L}\\p{N}]+"), "")


def token_bucket(token, dim: int) -> Column:
    """Slot of a token in the hashed vector: first thirteen hex digits (52 bits) of its md5, modulo the dimension."""
    return (F.conv(F.substring(F.md5(S.col(token)), 1, 13), 16, 10).cast("bigint") % F.lit(dim)).cast("int")


def hashed_vectors(reports: DataFrame, dim: int) -> DataFrame:
    """Native embedding pooled per stay: ``(stay_id, embedding)``.

    A report's vector is the mean over its tokens of their one-hot slots; a stay's vector is the mean over reports. Texts
    are read once: an extra NULL token per report counts the reports, in slot -1. Tokens shrink to ``dim`` + 1 sums per
    stay before the shuffle. A report without tokens counts as zeros.
    """
    words = reports.select("stay_id", tokens("text").alias("w"))
    marked = F.concat(F.array(F.lit(None).cast("string")), F.col("w"))
    spread = words.select("stay_id", F.try_divide(F.lit(1.0), F.size("w")).alias("share"), F.explode(marked).alias("t"))
    is_token = F.col("t").isNotNull()
    slots = spread.groupBy("stay_id", F.when(is_token, token_bucket("t", dim)).otherwise(-1).alias("pos"))
    sums = slots.agg(F.sum(F.when(is_token, F.col("share")).otherwise(1.0)).alias("value"))
    packed = sums.groupBy("stay_id").agg(
        F.max(F.when(F.col("pos") < 0, F.col("value"))).alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", "value")))).alias("cells"),
    )
    mean = F.transform(S.scatter("cells", dim, F.lit(0.0)), lambda v: v / F.col("n"))
    return packed.select("stay_id", mean.alias("embedding"))


def slot_sums(reports: DataFrame, dim: int) -> DataFrame:
    """``(stay_id, n, cells)``: reports of each stay and, for each slot that occurs, ``(pos, value, reports)``.

    ``value`` sums the slot's share of the tokens over the reports, ``reports`` counts those that have it. Texts are read
    once; they shrink to ``dim`` + 1 sums per stay before the shuffle.
    """
    slots = reports.select("stay_id", F.transform(tokens("text"), lambda t: token_bucket(t, dim)).alias("s"))
    share = F.try_divide(F.lit(1.0), F.size("s"))

    def entry(pos, value, n) -> Column:
        return F.struct(pos.cast("int").alias("pos"), value.cast("double").alias("value"), F.lit(n).cast("bigint").alias("reports"))

    entries = F.concat(
        F.array(entry(F.lit(-1), F.lit(1.0), 0)),
        F.transform("s", lambda p: entry(p, share, 0)),
        F.transform(F.array_distinct("s"), lambda p: entry(p, F.lit(0.0), 1)),
    )
    sums = slots.select("stay_id", F.inline(entries)).groupBy("stay_id", "pos").agg(F.sum("value").alias("value"), F.sum("reports").alias("reports"))
    cell = F.when(F.col("pos") >= 0, F.struct("pos", "value", "reports"))
    return sums.groupBy("stay_id").agg(
        F.max(F.when(F.col("pos") < 0, F.col("value"))).alias("n"), F.sort_array(F.collect_list(cell)).alias("cells")
    )


def idf_weights(sums: DataFrame, train: DataFrame, dim: int) -> DataFrame:
    """``(pos, reports, weight)`` of every slot, fitted on the reports of train stays only: ``ln((1 + n) / (1 + d)) + 1``.

    ``n`` are the train reports, ``d`` those that have the slot; a slot that train never saw has the largest weight.
    """
    fit = sums.join(train.select("stay_id"), "stay_id", "left_semi")
    n = fit.agg(F.coalesce(F.sum("n"), F.lit(0.0))).scalar()
    seen = fit.select(F.inline("cells")).groupBy("pos").agg(F.sum("reports").alias("reports"))
    slots = sums.sparkSession.range(dim).select(F.col("id").cast("int").alias("pos"))
    counts = slots.join(seen, "pos", "left").withColumn("reports", F.coalesce("reports", F.lit(0)).cast("bigint")).withColumn("_n", n)
    return counts.select("pos", "reports", (F.log((1 + F.col("_n")) / (1 + F.col("reports"))) + 1).alias("weight"))


def weighted_vectors(sums: DataFrame, weights: DataFrame, dim: int) -> DataFrame:
    """``(stay_id, embedding)``: mean over a stay's reports of their slots times the slots' weights (``dim`` numbers).

    The weight belongs to the slot, so it may be applied to the sum of the reports.
    """
    by_slot = weights.agg(F.sort_array(F.collect_list(F.struct("pos", "weight"))).alias("w")).select(F.col("w.weight"))
    dense = sums.withColumn("_w", by_slot.scalar()).withColumn("_v", S.scatter("cells", dim, F.lit(0.0)))
    return dense.select("stay_id", F.zip_with("_v", "_w", lambda v, w: v * w / F.col("n")).alias("embedding"))


def encode_reports(reports: DataFrame, encoder: Encoder, batch_size: int = 32) -> DataFrame:
    """``(stay_id, embedding)`` per report from a user's encoder, called on batches of texts inside the tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                yield pd.DataFrame(
                    {"stay_id": part["stay_id"], "embedding": [list(map(float, v)) for v in encoder(list(part["text"]))]}
                )

    return reports.select("stay_id", "text").mapInPandas(run, "stay_id bigint, embedding array<double>")


def pool_vectors(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """Mean vector per stay. Whole vectors are summed map-side, so a stay sends one vector per task."""
    kept = vectors.where(F.col(name).isNotNull())
    mean = kept.groupBy("stay_id").agg(Summarizer.mean(array_to_vector(name)).alias("_mean"))
    return mean.select("stay_id", vector_to_array("_mean").alias(name))


def with_vectors(cohort: DataFrame, pooled: DataFrame, dim: int, name: str = "radiology") -> DataFrame:
    """Every cohort stay with its vector, zeros where it has no report, and a flag that tells the two apart."""
    source = pooled.columns[1]
    renamed = pooled.withColumnRenamed(source, "_v")
    zeros = F.array_repeat(F.lit(0.0), dim)
    filled = F.transform(F.coalesce("_v", zeros), lambda v: F.coalesce(S.nan_to_null(v), F.lit(0.0)).cast("float"))
    return (
        cohort.join(renamed, "stay_id", "left")
        .withColumns({name: filled, f"has_{name}": F.col("_v").isNotNull().cast("int")})
        .drop("_v")
    )


def intake_vectors(texts: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """Pre-computed wide embeddings as ``(stay_id, embedding)``; without them, the texts for later embedding."""
    if wide is None:
        return texts.select("stay_id", *[c for c in texts.columns if c != "stay_id"])
    values = [F.col(c).cast("double") for c in wide.columns if c != "stay_id"]
    return wide.select("stay_id", F.array(*values).alias("embedding"))
