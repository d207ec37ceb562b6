"""Survival labels, curves and discrete-time bins."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.operators.running import TASK_ROWS, running, sized, with_total

# --- labels ---------------------------------------------------------------------------------------------------------


def censor_at(df: DataFrame, horizon: float, duration: str = "duration", event: str = "event") -> DataFrame:
    """Events later than the horizon become censored at it; an event exactly at the horizon stays."""
    late = F.col(duration) > horizon
    return df.withColumns(
        {
            event: F.when(late, 0).otherwise(F.col(event)).cast("int"),
            duration: S.strict_least(F.col(duration), F.lit(float(horizon))),
        }
    )


def labels_from_offsets(df: DataFrame, offset_minutes: str, status: str, event_status: str, horizon: float) -> DataFrame:
    """Duration from a discharge offset in minutes; the event is one discharge status."""
    labelled = df.withColumns(
        {
            "duration": F.col(offset_minutes) / F.lit(60.0),
            "event": S.indicator(F.col(status) == F.lit(event_status)),
        }
    )
    return censor_at(labelled, horizon)


def labels_from_calendar(
    df: DataFrame,
    horizon: float,
    start: str = "intime",
    discharge: str = "dischtime",
    death: Sequence[str] = ("deathtime", "dod"),
) -> DataFrame:
    """Death within the horizon of the start is the event, also after discharge; others end at discharge or horizon.

    An unknown discharge without an event leaves the duration NULL.
    """
    to_death = S.hours_between(start, F.coalesce(*[F.col(c).cast("timestamp") for c in death]))
    to_end = S.strict_least(S.hours_between(start, discharge), F.lit(float(horizon)))
    died = F.coalesce(to_death <= horizon, F.lit(False))
    duration = S.strict_greatest(F.lit(0.0), F.when(died, to_death).otherwise(to_end))
    return df.withColumns({"duration": duration, "event": died.cast("int")})


def labels_competing(df: DataFrame, hours: str, outcome: str) -> DataFrame:
    """Length of stay with the outcome code as competing event."""
    return df.withColumns({"duration": F.col(hours).cast("double"), "event": F.col(outcome).cast("int")})


def any_event(event: str = "event") -> Column:
    return S.indicator(F.col(event) > 0)


def observed_event_count(labels: DataFrame) -> DataFrame:
    """Number of different non-zero event codes in the data, to check against the map."""
    return labels.where("event <> 0").select("event").distinct().agg(F.count("*").cast("int").alias("n_events"))


# --- curves ---------------------------------------------------------------------------------------------------------


def risk_table(
    labels: DataFrame, by: Sequence[str] = (), codes: Sequence[int] = ()
) -> tuple[DataFrame, int]:
    """``(by, time, n, d, d_<code>, at_risk)``: stays ending, events and stays at risk per distinct duration.

    Also returns the size of the largest group, which decides how later running values are computed. The counts are
    written once; everything after works on distinct times instead of stays.
    """
    by = list(by)
    counts = (
        labels.where(F.col("duration").isNotNull())
        .groupBy(*by, F.col("duration").alias("time"))
        .agg(
            F.count("*").cast("double").alias("n"),
            F.sum(any_event()).cast("double").alias("d"),
            *[F.sum(S.indicator(F.col("event") == k)).cast("double").alias(f"d_{k}") for k in codes],
        )
    )
    counts, biggest = sized(counts, by, "risk")
    ranked = with_total(running(counts, "time", by, sums=["n"], biggest=biggest), counts, "n", by)
    at_risk = F.col("_total") - F.col("run_n") + F.col("n")
    return ranked.withColumn("at_risk", at_risk).drop("_total", "run_n"), biggest


def km_curve(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Kaplan-Meier survival per distinct duration, with the Greenwood sum."""
    risk, biggest = risk_table(labels, by)
    return _km(risk, biggest, list(by))


def _km(risk: DataFrame, biggest: int, by: list) -> DataFrame:
    risk = risk.withColumns(
        {
            "_stay": F.lit(1.0) - F.col("d") / F.col("at_risk"),
            "_green": F.coalesce(F.try_divide("d", F.col("at_risk") * (F.col("at_risk") - F.col("d"))), F.lit(0.0)),
        }
    )
    curve = running(risk, "time", by, sums=["_green"], factor="_stay", biggest=biggest)
    return curve.select(
        *by,
        "time",
        "at_risk",
        "d",
        F.col("run_product").alias("survival"),
        F.col("run__green").alias("greenwood"),
    )


def km_band(curve: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Log-log confidence band. It is (1, 1) before the first event and unknown where survival has reached 0."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    log_s = F.when(F.col("survival") > 0, F.ln("survival"))
    spread = F.try_divide(F.lit(z) * F.sqrt("greenwood"), log_s)

    def bound(sign: float) -> Column:
        moved = F.exp(-F.exp(F.ln(-log_s) + F.lit(sign) * spread))
        return F.when(F.col("survival") >= 1, F.lit(1.0)).otherwise(moved)

    return curve.withColumns({"lower": bound(-1.0), "upper": bound(1.0)})


def aj_cif(labels: DataFrame, codes: Sequence[int], by: Sequence[str] = (), variance: bool = False) -> DataFrame:
    """Aalen-Johansen cumulative incidence of each competing event: ``(by, event, time, at_risk, d, cif)``.

    Ties are kept as ties. With ``variance`` the delta-method variance (Marubini and Valsecchi) is added; its squared
    differences are expanded, so that it too comes from running sums.
    """
    by = list(by)
    risk, biggest = risk_table(labels, by, codes)
    risk = risk.withColumn("_stay", F.lit(1.0) - F.col("d") / F.col("at_risk"))
    risk = risk.withColumns({f"h_{k}": F.col(f"d_{k}") / F.col("at_risk") for k in codes})
    curve = running(risk, "time", by, factor="_stay", weighted=[f"h_{k}" for k in codes], biggest=biggest)
    columns = [
        F.struct(
            F.lit(k).alias("event"), F.col(f"d_{k}").alias("d_event"), F.col(f"run_h_{k}").alias("cif")
        )
        for k in codes
    ]
    long = curve.withColumn("_k", F.explode(F.array(*columns)))
    long = long.select(*by, F.col("_k.event").alias("event"), "time", "at_risk", F.col("d").alias("d_any"),
                       F.col("_k.d_event").alias("d"), "product_before", F.col("_k.cif").alias("cif"))
    if not variance:
        return long.drop("d_any", "product_before")
    return _with_variance(long, [*by, "event"], biggest).drop("d_any", "product_before")


def _with_variance(long: DataFrame, by: list, biggest: int) -> DataFrame:
    n, k, s, cif = F.col("at_risk"), F.col("d"), F.col("product_before"), F.col("cif")
    w = F.coalesce(F.try_divide("d_any", n * (n - F.col("d_any"))), F.lit(0.0))
    terms = {
        "_a": w,
        "_b": w * cif,
        "_c": w * cif * cif,
        "_e": s * s * k * (n - k) / (n * n * n),
        "_f": s * k / (n * n),
        "_g": cif * s * k / (n * n),
    }
    summed = running(long.withColumns(terms), "time", by, sums=list(terms), biggest=biggest)
    first = cif * cif * F.col("run__a") - 2 * cif * F.col("run__b") + F.col("run__c")
    third = cif * F.col("run__f") - F.col("run__g")
    out = summed.withColumn("variance", first + F.col("run__e") - 2 * third)
    return out.drop(*terms, *[f"run_{t}" for t in terms])


# --- time bins ------------------------------------------------------------------------------------------------------


def _numbered(cuts: DataFrame) -> DataFrame:
    """Number a handful of cuts."""
    order = Window.orderBy("cut")
    return cuts.select((F.row_number().over(order) - 1).cast("int").alias("cut_idx"), "cut")


def km_cuts(labels: DataFrame, n_cuts: int) -> DataFrame:
    """``(cut_idx, cut)``: cuts at equal steps of Kaplan-Meier survival of any event; fewer if steps coincide.

    Step j asks for survival s_j on a line from the lowest to the highest value of the fitted curve and takes the last
    time with survival of at least s_j. The curve begins with (0, 1) only if no duration is 0; with events at time 0 its
    highest value is the survival after them. The first cut becomes 0, the last is the longest duration.
    """
    risk, biggest = risk_table(labels)
    curve = _km(risk, biggest, []).select("time", "survival")
    curve = session.barrier(curve, "km")
    ends = curve.agg(F.min("survival").alias("low"), F.max("survival").alias("high"), F.min("time").alias("first")).first()
    low, high = ends.low, ends.high
    if ends.first is None or ends.first > 0:
        high, low = 1.0, 1.0 if low is None else low
        curve = curve.unionByName(session.literal_table(curve.sparkSession, [(0.0, 1.0)], "time double, survival double"))

    def step(j: int) -> Column:
        share = j / (n_cuts - 1) if n_cuts > 1 else 1.0
        wanted = low + (high - low) * share
        return F.max(F.when(F.col("survival") + F.lit(1e-12) >= F.lit(wanted), F.col("time")))

    steps = curve.agg(F.array(*[step(j) for j in range(n_cuts)]).alias("cuts"))
    cuts = _numbered(steps.select(F.explode(F.array_distinct("cuts")).alias("cut")))
    return cuts.withColumn("cut", F.when(F.col("cut_idx") == 0, 0.0).otherwise(F.col("cut")))


def equidistant_cuts(labels: DataFrame, n_cuts: int) -> DataFrame:
    """``n_cuts`` cuts evenly spaced from 0 to the longest duration."""
    longest = labels.agg(F.max("duration").alias("_max"))
    steps = longest.select("_max", F.explode(F.sequence(F.lit(0), F.lit(n_cuts - 1))).alias("cut_idx"))
    return steps.select("cut_idx", (F.col("_max") * F.col("cut_idx") / F.lit(float(max(n_cuts - 1, 1)))).alias("cut"))


def make_cuts(labels: DataFrame, n_cuts: int, scheme: str = "quantiles") -> DataFrame:
    if scheme == "quantiles":
        return km_cuts(labels, n_cuts)
    if scheme == "equidistant":
        return equidistant_cuts(labels, n_cuts)
    raise ValueError(f"unknown scheme {scheme!r}")


def _with_cuts(labels: DataFrame, cuts: DataFrame) -> DataFrame:
    """The cuts as one array per row: a scalar subquery over a handful of rows."""
    return labels.withColumn("_cuts", cuts.agg(F.sort_array(F.collect_list("cut"))).scalar())


def discretise_labels(labels: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``duration_idx``: events go up to the next cut, censored stays down to the previous one.

    Times past the last cut take the last index; ``event_idx`` is 0 for an event there, since the grid ends before it,
    and the event elsewhere.
    """
    t = F.col("duration")
    with_cuts = _with_cuts(labels, cuts)
    up = F.size(F.filter("_cuts", lambda c: c < t))
    down = F.size(F.filter("_cuts", lambda c: c <= t)) - 1
    idx = F.when(any_event() == 1, up).otherwise(down)
    bounded = F.greatest(F.lit(0), F.least(idx, F.size("_cuts") - 1))
    late = t > F.element_at("_cuts", -1)
    return with_cuts.withColumns(
        {"duration_idx": F.when(t.isNotNull(), bounded).cast("int"), "event_idx": F.when(late, 0).otherwise(F.col("event")).cast("int")}
    ).drop("_cuts")


def digitize_durations(labels: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``bin``: the number of cuts at or below the duration."""
    t = F.col("duration")
    binned = F.size(F.filter("_cuts", lambda c: c <= t))
    return _with_cuts(labels, cuts).withColumn("bin", F.when(t.isNotNull(), binned).cast("int")).drop("_cuts")
