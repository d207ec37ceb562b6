"""Queries over report texts and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import Tables, query, r6, split_sql
from cohortframe.operators import reports as R, report, split
from cohortframe.operators.split import part_of

DIM = 64


@query(
    "vector_mean_pool",
    """WITH e AS (SELECT vec_id % 150 AS stay_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos
      FROM embeddings)
    SELECT stay_id, CAST(pos AS INTEGER) AS pos, round(avg(v), 6) AS value FROM e GROUP BY 1, 2""",
)
def vector_mean_pool(t: Tables):
    pooled = R.pool_vectors(t.vectors).select("stay_id", F.posexplode("embedding").alias("pos", "value"))
    return pooled.withColumn("value", r6("value"))


@query("report_text", "SELECT doc_id, source || ' ' || text AS text FROM documents WHERE source IS NOT NULL AND text IS NOT NULL")
def report_text(t: Tables):
    return R.report_text(t.texts, "source", "text").select("doc_id", "text")


@query(
    "report_embedding",
    f"""WITH d AS (
      SELECT doc_id, doc_id % 150 AS stay_id,
             list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM documents),
    n AS (SELECT stay_id, count(*) AS n FROM d GROUP BY 1),
    s AS (SELECT stay_id, 1.0::DOUBLE / len(w) AS share, unnest(w) AS tok FROM d WHERE len(w) > 0),
    b AS (SELECT stay_id, CAST(('0x' || substr(md5(tok), 1, 13))::BIGINT % {DIM} AS INTEGER) AS pos, sum(share) AS v FROM s GROUP BY 1, 2)
    SELECT stay_id, pos, round(v / n, 6) AS value FROM b JOIN n USING (stay_id)""",
)
def report_embedding(t: Tables):
    """Hashed mean embedding of whole texts, pooled per stay."""
    vectors = R.hashed_vectors(t.texts, DIM).select("stay_id", F.posexplode("embedding").alias("pos", "value"))
    return vectors.where("value > 0").withColumn("value", r6("value"))


#: Slots enough that some of them occur in test texts only.
WIDE = 4096
_SLOTS = f"""t AS (SELECT doc_id, doc_id % 150 AS stay_id,
      list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM documents),
    d AS (SELECT *, {split_sql('stay_id')} AS split FROM t),
    s AS (SELECT doc_id, stay_id, split, 1.0::DOUBLE / len(w) AS share, unnest(w) AS tok FROM d WHERE len(w) > 0),
    p AS (SELECT doc_id, stay_id, split, share, CAST(('0x' || substr(md5(tok), 1, 13))::BIGINT % {WIDE} AS INTEGER) AS pos FROM s),
    f AS (SELECT pos, count(DISTINCT doc_id) AS reports FROM p WHERE split = 'train' GROUP BY 1),
    i AS (SELECT CAST(range AS INTEGER) AS pos, coalesce(reports, 0) AS reports,
      ln((1.0 + (SELECT count(*) FROM d WHERE split = 'train')) / (1 + coalesce(reports, 0))) + 1 AS weight
      FROM range({WIDE}) LEFT JOIN f ON f.pos = range)"""


def _slot_sums(t: Tables):
    return session.barrier(R.slot_sums(t.texts, WIDE), "slots")


def _train_stays(t: Tables):
    stays = t.texts.select("stay_id").distinct()
    return part_of(split.split_by_hash(stays, subject="stay_id"), "train")


@query("report_idf_weights", f"WITH {_SLOTS} SELECT pos, reports, round(weight, 6) AS weight FROM i")
def report_idf_weights(t: Tables):
    """Weights fitted on train reports; a slot that only others have gets the weight of no report at all."""
    return R.idf_weights(_slot_sums(t), _train_stays(t), WIDE).withColumn("weight", r6("weight"))


@query(
    "report_embedding_idf",
    f"""WITH {_SLOTS}, n AS (SELECT stay_id, count(*) AS n FROM d GROUP BY 1),
    b AS (SELECT stay_id, pos, sum(share) AS v FROM p GROUP BY 1, 2)
    SELECT stay_id, pos, round(v / n * weight, 6) AS value FROM b JOIN n USING (stay_id) JOIN i USING (pos) WHERE v / n * weight >= 1e-5""",
)
def report_embedding_idf(t: Tables):
    """Hashed mean embedding per stay with its slots weighted."""
    sums = _slot_sums(t)
    vectors = R.weighted_vectors(sums, session.held(R.idf_weights(sums, _train_stays(t), WIDE)), WIDE)
    cells = vectors.select("stay_id", F.posexplode("embedding").alias("pos", "value"))
    return cells.where("value >= 1e-5").withColumn("value", r6("value"))


@query(
    "report_two_key_join",
    """WITH g AS (SELECT lang, source, min(doc_id) AS stay_id FROM documents GROUP BY 1, 2)
    SELECT d.doc_id, g.stay_id FROM documents d JOIN g ON d.lang = g.lang AND d.source = g.source""",
)
def report_two_key_join(t: Tables):
    keyed = t.texts.select("doc_id", F.col("lang").alias("subject_id"), F.col("source").alias("hadm_id"))
    stays = keyed.groupBy("subject_id", "hadm_id").agg(F.min("doc_id").alias("stay_id"))
    return R.join_reports(keyed, stays).select("doc_id", "stay_id")


@query(
    "embedding_intake",
    f"""SELECT vec_id AS stay_id, {", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) AS e{i}" for i in range(DIM))}, NULL::VARCHAR AS text
      FROM embeddings UNION ALL SELECT doc_id, {", ".join(["NULL"] * DIM)}, text FROM documents""",
)
def embedding_intake(t: Tables):
    """Pre-computed wide vectors where given, texts passed through where not."""
    parts = [F.get("embedding", F.lit(i)).alias(f"e{i}") for i in range(DIM)]
    wide = t.read("embeddings").select(F.col("vec_id").alias("stay_id"), *parts)
    given = R.intake_vectors(t.texts, wide).select(
        "stay_id", *[r6(F.get("embedding", F.lit(i))).alias(f"e{i}") for i in range(DIM)]
    )
    texts = R.intake_vectors(t.texts.select(F.col("doc_id").alias("stay_id"), "text"))
    return given.unionByName(texts, allowMissingColumns=True)


@query(
    "embedding_value_hist",
    """WITH e AS (SELECT vec_id AS stay_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos
      FROM embeddings),
    r AS (SELECT min(v) AS lo, max(v) AS hi FROM e),
    c AS (SELECT CAST(least(floor((v - lo) * 50.0 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n FROM e, r GROUP BY 1)
    SELECT CAST(range AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(50) LEFT JOIN c ON bin = range WHERE EXISTS (FROM c)""",
)
def embedding_value_hist(t: Tables):
    return report.vector_value_histogram(t.read("embeddings"))


def _lengths(texts: list[str]) -> list[list[float]]:
    """A small encoder: characters, words and line feeds of each text."""
    return [[float(len(x)), float(len(x.split(" "))), float(x.count("\n"))] for x in texts]


@query(
    "report_encoder",
    """WITH d AS (SELECT doc_id % 150 AS stay_id, [length(text), len(string_split(text, ' ')), len(string_split(text, chr(10))) - 1] AS v
      FROM documents WHERE text IS NOT NULL),
    p AS (SELECT stay_id, unnest(v)::DOUBLE AS v, generate_subscripts(v, 1) - 1 AS pos FROM d)
    SELECT stay_id, CAST(pos AS INTEGER) AS pos, round(avg(v), 6) AS value FROM p GROUP BY 1, 2""",
)
def report_encoder(t: Tables):
    """A user's encoder over all reports, pooled per stay."""
    vectors = R.encode_reports(t.texts.where(F.col("text").isNotNull()), _lengths)
    pooled = R.pool_vectors(vectors).select("stay_id", F.posexplode("embedding").alias("pos", "value"))
    return pooled.withColumn("value", r6("value"))
