"""Column expressions shared by the operators. All are JVM-side; missing values are NULL, never NaN."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3.6e9


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c) -> Column:
    """Epoch microseconds of a timestamp with or without zone (session time zone UTC, see ``session.tune``)."""
    return F.unix_micros(col(c).cast("timestamp"))


def hours_between(start, end) -> Column:
    return (micros(end) - micros(start)) / F.lit(MICROS_PER_HOUR)


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def to_number(c) -> Column:
    """Text to double, anything non-numeric to NULL (a trailing Java type letter is not a number)."""
    text = col(c).cast("string")
    return F.when(~text.rlike("[0-9.][dDfF]\\s*$"), nan_to_null(text.try_cast("double")))


def to_time(c, *formats: str) -> Column:
    """Text to timestamp: the standard form, then the first of ``formats`` that fits, else NULL."""
    text = [F.try_to_timestamp(col(c).cast("string"), F.lit(f)) for f in formats]
    return F.coalesce(F.try_to_timestamp(col(c)), *text)


def strict_least(*cs) -> Column:
    """``least`` that is NULL as soon as one argument is NULL."""
    cs = [col(c) for c in cs]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.least(*cs))


def strict_greatest(*cs) -> Column:
    cs = [col(c) for c in cs]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.greatest(*cs))


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Value of a short literal mapping; unlisted keys give ``default``."""
    pairs = list(mapping.items())
    found = reduce(lambda acc, kv: acc.when(col(c) == F.lit(kv[0]), F.lit(kv[1])), pairs, F)
    return found if default is None else F.coalesce(found, F.lit(default))


def percent(part, whole) -> Column:
    return F.try_divide(col(part) * F.lit(100.0), col(whole).cast("double"))


def hour_bin(hours) -> Column:
    return F.floor(col(hours)).cast("int")


def ceil_bin(hours) -> Column:
    """Bin 0 is the first instant alone, bin k is (k-1, k]."""
    return F.ceil(col(hours)).cast("int")


def window_index(hour, window_hours: int) -> Column:
    return F.floor(col(hour) / F.lit(window_hours)).cast("int")


def hash_fraction_hex(c, seed: int) -> Column:
    """First eight hex digits of a seeded md5: a uniform, engine-independent number in text form."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}|"), col(c).cast("string"))), 1, 8)


def share_as_hex(share: float) -> str:
    return "g" if share >= 1 else f"{int(share * 2**32):08x}"


def let(value, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside other lambdas."""
    return F.get(F.transform(F.array(col(value)), body), F.lit(0))


def overlay(base, cells, value) -> Column:
    """The array ``base`` with ``value(cell)`` in place of the element at ``cell.pos``.

    ``cells`` is an array of structs sorted by distinct ``pos`` from 0, or NULL. Only the cells pass through a lambda; the
    stretches of ``base`` between them are copied whole.
    """
    base = col(base)

    def filled(sorted_cells):
        def with_gap(cell, i):
            before = F.coalesce(F.get(sorted_cells, i - 1)["pos"], F.lit(-1))
            return F.concat(F.slice(base, before + 2, cell["pos"] - before - 1), F.array(value(cell)))

        last = F.coalesce(F.get(sorted_cells, F.size(sorted_cells) - 1)["pos"], F.lit(-1))
        rest = F.slice(base, last + 2, F.greatest(F.size(base) - 1 - last, F.lit(0)))
        return F.concat(F.flatten(F.transform(sorted_cells, with_gap)), rest)

    return F.coalesce(let(cells, filled), base)


def scatter(cells, size: int, default: Column | None = None) -> Column:
    """Dense array of ``size`` doubles from ``(pos, value)`` cells; gaps are NULL or ``default``."""
    missing = F.lit(None) if default is None else default
    base = F.array_repeat(missing.cast("double"), size)
    return overlay(base, cells, lambda cell: cell["value"].cast("double"))
