"""From raw documents to training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and reread as the next
stage's documents. All but the last return the columns of their input. Documents are told apart by id and text, so
repeated ids are no problem; rows equal in both share every decision.

* ``language``: documents in no language go: without letters, or explained worse by any mixture of the languages of the
  labelled rows than by trigrams that are all equally likely. Where no row is labelled, every text with letters stays.
* ``lines``: boilerplate lines go, but for their first occurrence; so do documents that lose all their words by it.
* ``near-dedup``: one document of each group of near copies stays: that with the smallest id (null last), then text mark,
  then the other columns. Documents without words are no copies.
* ``mixing``: each source is brought to its target; a document that is taken twice is two rows.
* ``packing``: documents become pieces of training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortframe import session
from cohortframe.llm import language_id, line_dedup, mixing, near_dedup, packing
from cohortframe.llm.base import SPACES, text_mark, unused


def _decided(docs: DataFrame, decided: DataFrame, how: str, **also: str) -> DataFrame:
    """``docs`` joined with ``decided`` (its first columns id and text mark) under names of its own; ``also``: more keys."""
    at, = unused(docs.columns, "at")
    mine = [F.col("doc_id"), F.col(at), *map(F.col, also)]
    theirs = [F.col(c) for c in decided.columns[: len(mine)]]
    on = theirs[0].eqNullSafe(mine[0])
    for a, b in zip(mine[1:], theirs[1:]):
        on = on & a.eqNullSafe(b)
    return docs.withColumn(at, text_mark("text")).join(decided, on, how).drop(at)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language_id.language_id(docs, language_id.learn(docs))
    i, m = unused([*docs.columns, "at"], "i", "m")
    return _decided(docs, found.where("fit IS NULL OR fit < 0").select(F.col("doc_id").alias(i), text_mark("text").alias(m)).distinct(), "left_anti")


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    i, m, t = unused([*docs.columns, "at"], "i", "m", "t")
    cleaned = line_dedup.line_dedup(docs).where("n_removed > 0").dropDuplicates(["doc_id", "mark"])
    joined = _decided(docs, cleaned.select(F.col("doc_id").alias(i), F.col("mark").alias(m), F.col("text").alias(t)), "left")
    same = F.col(m).isNull()
    joined = joined.where(same | (F.btrim(t, F.lit(SPACES)) != ""))
    new = {"text": F.col(t), "n_chars": F.length(t)}
    return joined.select(
        *[F.when(same, F.col(c)).otherwise(new[c].cast(docs.schema[c].dataType)).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    )


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    i, m, c = unused([*docs.columns, "at"], "i", "m", "c")
    found = near_dedup.near_dedup(docs).select(F.col("doc_id").alias(i), F.col("mark").alias(m), F.col("component").alias(c))
    found = session.barrier(found, "found")
    first = F.min(F.struct(F.col(i).isNull().alias("last"), F.col(i), F.col(m))).alias("first")
    stay = found.where(F.col(c).isNotNull()).groupBy(c).agg(first).select(f"first.{i}", f"first.{m}").unionAll(found.where(F.col(c).isNull()).select(i, m).distinct())
    kept = _decided(docs, stay, "left_semi")
    # Rows equal in id and text: one stays of those with words.
    again = found.where(F.col(c).isNotNull()).groupBy(i, m).agg(F.count("*").alias(c)).where(F.col(c) > 1).select(i, m)
    again = session.small(again, name="repeated")
    others = [F.col(f"`{name}`") for name in docs.columns if name != "text"]
    same = _decided(kept, again, "left_semi").groupBy("doc_id", text_mark("text").alias(m))
    one = same.agg(F.min(F.struct(*others)).alias(c), F.min("text").alias("text"))
    one = one.select(*[F.col("text") if name == "text" else F.col(f"{c}.`{name}`") for name in docs.columns])
    return _decided(kept, again, "left_anti").unionAll(one)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    i, m, s, n, k = unused([*docs.columns, "at"], "i", "m", "s", "n", "k")
    passes = mixing.mix(docs).where("passes > 0").select(
        F.col("doc_id").alias(i), F.col("mark").alias(m), F.col("source").alias(s), F.col("passes").alias(n)
    )
    taken = _decided(docs, passes.distinct(), "inner", source=s)
    return taken.withColumn(k, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [
    ("language", identify_languages),
    ("lines", deduplicate_lines),
    ("near-dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Language proportions and merges by EM and similarity have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of training sequences that come out of ``documents``."""
    session.tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = session.barrier(stage(spark, docs, sf_dir), name)
    return docs
