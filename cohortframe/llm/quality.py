"""Quality rules: base limits, then robust multivariate outliers, in DataFrame operations only.

Each document gives a vector of transformed statistics. For each language and source the location and scatter come from
the minimum-covariance-determinant estimate: several starts, concentration steps that keep the ``share`` of documents
with the smallest Mahalanobis distances, the start with the smallest determinant, more steps. The share's distance is
read from a histogram, so no group is sorted or gathered. A document whose distance passes the cut-off is rejected.

The scatter gets the squares of ``FLOORS`` on its diagonal, so it is regular where most documents agree in a statistic. The
last two can reach 4.6 and 3.4 at most (a line has a word, the base limit has 30 % of the words). Their floors are less
than a tenth of it, so either can reject alone: where the bulk has none, from 3 lines or words in 100 words on. Documents that fail the base limits take no part in the estimate.

Every group is judged by its own estimate, shrunk towards that of its language, as that is towards the estimate of all
documents: the wider estimate counts as ``PRIOR`` more documents, and the difference of the two centres adds to the scatter
as it does in a pooled covariance. The estimate of all documents is widened by as many documents of the deviations ``WIDE``.
So no size of a group or table changes the rule, and one document more or less moves a distance by little.

Null text has no words and fails the base limits. Null language and null source are groups of their own. Repeated rows
count each. Where all documents of a group fail the base limits they have no distance. An empty table gives an empty result.
Repeated words are found by 64-bit hashes of their windows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortframe.llm.base import SPACES, query, read, words
from cohortframe.session import barrier, small

WINDOW = 8
SHARE, PRIOR = 0.75, 50
STARTS, START_ROWS, FIRST_STEPS, LAST_STEPS = 4, 60, 2, 3
#: ln words, ln letters a word, ln(1 + 1000 symbols a letter), ln(1 + 100 repeated lines a word), ln(1 + 100 share of repeated words)
FLOORS = (0.5, 0.15, 0.7, 0.3, 0.3)
P = len(FLOORS)
#: Deviations that nothing but the statistics' own meaning tells, for tables with few documents.
WIDE = (1.5, 0.3, 1.5, 1.0, 1.0)
#: Chance that a document of the bulk passes the cut-off.
TAIL = 0.01
#: Histogram cells for each doubling of a squared distance.
CELLS = 64


def _chi2(x: float, p: int) -> float:
    """Distribution function of chi-square with an odd number of degrees of freedom."""
    out, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(3, p + 1, 2):
        out -= term
        term *= x / k
    return out


def _quantile(q: float, p: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, p) < q else (low, mid)
    return low


#: Makes the scatter of the innermost share that of all, were they normal.
CONSISTENCY = SHARE / _chi2(_quantile(SHARE, P), P + 2)
CUT = _quantile(1 - TAIL, P)


def _doubled(hashes: Column, of: str, step: int) -> Column:
    """Each hash joined with the one ``step`` places on in column ``of``."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(F.col(of), i + step)))


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``id``, the ``keep`` columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), *[F.col(k).alias(k) for k in keep], text.alias("text"), words(text_col).alias("words"))
    # Each step's columns are used more than once in the next, so the planner computes them once.
    rows = rows.select(
        "id", *keep, F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("h1"),
    )
    base = ["id", *keep, "n_words", "word_chars", "n_symbols"]
    dup_lines = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines")
    # The hash of a window is that of its two halves: of 2, 4, then 8 words. What runs over the end is cut off at last.
    rows = rows.select(*base, dup_lines, _doubled(F.col("h1"), "h1", 1).alias("h2"))
    rows = rows.select(*base, "n_dup_lines", _doubled(F.col("h2"), "h2", 2).alias("h4"))
    whole = F.slice("h4", F.lit(1), F.greatest(F.col("n_words") - WINDOW + 1, F.lit(0)).cast("int"))
    rows = rows.select(*base, "n_dup_lines", _doubled(whole, "h4", 4).alias("windows"))
    # Sorted by hash, a window found twice has an equal neighbour; its places, sorted, give the words covered.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(*base, "n_dup_lines", F.when(repeats, pairs).alias("pairs"))
    twice = F.filter(
        "pairs",
        lambda x, i: ((i > 0) & (F.get("pairs", i - 1)["h"] == x["h"])) | F.coalesce(F.get("pairs", i + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        places, start,
        lambda acc, i: F.struct((acc["covered"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("covered"), i.alias("last")),
        lambda acc: acc["covered"],
    )
    return rows.select(
        *base, "n_dup_lines",
        F.coalesce(F.when(F.col("pairs").isNotNull(), covered), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def _distance() -> Column:
    """Squared distance from the inverse factor z{i}{j} and the centre m{i} of the row's group."""
    z = [" + ".join(["0.0D", *(f"z{i}{j} * (x{j} - m{j})" for j in range(i + 1))]) for i in range(P)]
    return F.expr(" + ".join(["0.0D", *(f"({x}) * ({x})" for x in z)]))


X = [f"x{i}" for i in range(P)]


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
MOMENTS = [*(f"m{i}" for i in range(P)), *(f"s{i}{j}" for i, j in PAIRS)]


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and scatter of the rows of each key."""
    return rows.groupBy(*keys).agg(
        *[F.avg(X[i]).alias(f"m{i}") for i in range(P)], *[F.covar_pop(X[i], X[j]).alias(f"s{i}{j}") for i, j in PAIRS]
    )


def _factor(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, inverse Cholesky factor and log determinant of the scatter with the floors on its diagonal."""
    total = lambda terms: " + ".join(["0.0D", *terms])
    # One select whose columns use the ones before them: far fewer passes of the planner than a column at a time.
    steps = []
    for i, j in PAIRS:  # L of S = L L'
        rest = f"(s{i}{j}" + (f" + {FLOORS[i] ** 2!r}D" if i == j else "") + f" - ({total(f'l{i}{k} * l{j}{k}' for k in range(j))}))"
        steps.append(f"sqrt{rest} AS l{i}{j}" if i == j else f"{rest} / l{j}{j} AS l{i}{j}")
    for j in range(P):  # Z = inverse of L
        steps.append(f"1 / l{j}{j} AS z{j}{j}")
        steps += [f"-({total(f'l{i}{k} * z{k}{j}' for k in range(j, i))}) / l{i}{i} AS z{i}{j}" for i in range(j + 1, P)]
    steps.append(total(f"ln(l{i}{i})" for i in range(P)) + " AS det")
    centre, factor = [f"m{i}" for i in range(P)], [f"z{i}{j}" for i, j in PAIRS]
    return moments.selectExpr(*keys, *centre, *steps).select(*keys, *centre, *factor, "det")


def _innermost(rows: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of the share of a group's rows that is nearest to the present estimate."""
    near = rows.join(params, "g").select(*keys, *X, F.floor(CELLS * F.log2(_distance() + 1e-4)).cast("int").alias("cell"))
    cells = near.groupBy(*keys, "cell").agg(F.count("*").alias("c"))
    run = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_of = Window.partitionBy(*keys)
    edge = (
        cells.select(*keys, "cell", F.sum("c").over(run).alias("upto"), F.sum("c").over(all_of).alias("n"))
        .where(F.col("upto") >= F.col("n") * SHARE).groupBy(*keys).agg(F.min("cell").alias("edge"))
    )
    return _moments(near.join(small(edge, name="edge"), keys).where(F.col("cell") <= F.col("edge")), keys)


def mcd(rows: DataFrame) -> DataFrame:
    """The moments for each group ``g`` of rows (g, c, r, x0..; c its size, r a random number from 0 to 1 of the row itself)."""
    # Start 0 is the estimate from all rows; the others begin with a few rows each, taken by their number.
    starts = rows.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(STARTS))))
    low = (F.col("s") - 1) / STARTS
    starts = starts.where((F.col("s") == 0) | ((F.col("r") >= low) & (F.col("r") < low + F.least(F.lit(1.0 / STARTS), START_ROWS / F.col("c")))))
    # One row a group or start: marked for broadcast while they are few, so that a large group is not dealt to one task.
    params = small(_factor(_moments(starts, ["g", "s"]), ["g", "s"]), name="mcd")
    for _ in range(FIRST_STEPS):
        params = small(_factor(_innermost(rows, params, ["g", "s"]), ["g", "s"]), name="mcd")
    best = params.groupBy("g").agg(F.min(F.struct("det", "s")).alias("b")).select(F.col("g").alias("h"), F.col("b.s").alias("t"))
    params = small(params.join(best, (F.col("g") == F.col("h")) & (F.col("s") == F.col("t"))).drop("h", "t", "s"), name="mcd")
    for _ in range(LAST_STEPS - 1):
        params = small(_factor(_innermost(rows, params, ["g"]), ["g"]), name="mcd")
    return _innermost(rows, params, ["g"])


def _shrunk(own: DataFrame, wider: DataFrame) -> DataFrame:
    """``own`` (g, wider, c, moments) with the moments of its wider group counted as ``PRIOR`` more rows."""
    theirs = small(wider.select(F.col("g").alias("wider"), *[F.col(m).alias(f"w_{m}") for m in MOMENTS]), name="wider")
    share = F.col("c") / (F.col("c") + PRIOR)
    off = [F.col(f"m{i}") - F.col(f"w_m{i}") for i in range(P)]
    mix = {m: share * F.col(m) + (1 - share) * F.col(f"w_{m}") for m in MOMENTS}
    mix |= {f"s{i}{j}": mix[f"s{i}{j}"] + share * (1 - share) * off[i] * off[j] for i, j in PAIRS}
    return own.join(theirs, "wider").select("g", *[mix[m].alias(m) for m in MOMENTS])


def _estimates(stats: DataFrame) -> DataFrame:
    """Centre and inverse factor for each group ``g`` (language ``w``) of the rows that pass the base limits."""
    # A row counts for its group, for its language and for all; the name of a group begins with that of its language.
    levels = F.array(*[
        F.struct(F.lit(n).alias("level"), F.col(g).alias("g") if g else F.lit("").alias("g"), F.col(w).alias("wider") if w else F.lit("").alias("wider"))
        for n, (g, w) in enumerate([(None, None), ("w", None), ("g", "w")])
    ])
    rows = stats.where(~F.col("base_failed")).select(F.explode(levels).alias("k"), "r", *X).select("k.*", "r", *X)
    sizes = small(rows.groupBy("level", "g", "wider").agg(F.count("*").alias("c")), name="groups")
    rows = barrier(rows.select("g", "r", *X).join(sizes.select("g", "c"), "g"), "vectors")
    nodes = barrier(sizes.join(small(mcd(rows), name="mcd"), "g"), "nodes")
    share = F.col("c") / (F.col("c") + PRIOR)
    widened = {f"s{i}{j}": share * F.col(f"s{i}{j}") + (1 - share) * (WIDE[i] ** 2 if i == j else 0.0) for i, j in PAIRS}
    every = nodes.where("level = 0").withColumns(widened)
    by_language = _shrunk(nodes.where("level = 1"), every)
    return small(_factor(_shrunk(nodes.where("level = 2"), by_language), ["g"]), name="estimates")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, the statistics, base_failed, distance (squared; null if its group has none), kept."""
    table = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    stats = base_statistics(table, "i", "t")
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    part = lambda c: F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("+"), F.length(c).cast("string"), F.lit(":"), F.col(c)))
    stats = barrier(
        stats.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).select(
            "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            part("lang").alias("w"), F.concat(part("lang"), part("source")).alias("g"),
            F.log(n).alias("x0"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n).alias("x1"),
            F.log1p(1000 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))).alias("x2"),
            F.log1p(100 * F.col("n_dup_lines") / n).alias("x3"), F.log1p(100 * F.col("n_repeat_words") / n).alias("x4"),
            (F.pmod(F.xxhash64(F.col("id"), F.col("n_words"), F.col("word_chars")), F.lit(1 << 30)) / (1 << 30)).alias("r"),
        ),
        "statistics",
    )
    judged = stats.join(_estimates(stats), "g", "left")
    # The innermost share understates the scatter; the distance shrinks by the same factor.
    distance = _distance() / CONSISTENCY
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= CUT, F.lit(True))).alias("kept"),
    )


@query("op3_quality")
def op3_quality(spark, sf_dir):
    """All documents, by language and source."""
    return quality(read(spark, sf_dir, "documents")).withColumn("distance", F.round("distance", 6))
