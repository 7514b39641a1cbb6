"""Scalar helpers: each takes Columns and returns a Column, so codegen covers them all."""

from __future__ import annotations

import datetime as dt
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelwing import rules

_COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
_FIRST_DAY = "0001-01-01 00:00:00"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def canon(value) -> Column:
    """Canonical spelling of a category: no outer blanks, upper case."""
    return F.upper(F.trim(_col(value)))


def round_half_up(value, digits: int = 0) -> Column:
    """Half away from zero on the double itself, the same in every engine.

    The built-in `round` goes through the decimal spelling of a double (1.005
    gives 1.01), which other engines do not. NaN stays NaN, and a value whose
    scaled form has no fraction left (2**52 and beyond, infinity) stays itself.
    """
    value = _col(value).cast("double")
    scale = 10.0**digits
    up = F.floor(value * scale + 0.5)
    down = -F.floor(-value * scale + 0.5)
    whole = F.isnan(value) | (F.abs(value * scale) >= 2.0**52)
    return F.when(whole, value).when(value < 0, down / F.lit(scale)).otherwise(up / F.lit(scale))


def round_half_even(value, digits: int = 0) -> Column:
    """Half to even, used by the dashboard figures."""
    scale = 10.0**digits
    return F.rint(_col(value) * scale) / F.lit(scale)


def safe_divide(numerator, denominator) -> Column:
    """Null instead of an error when the denominator is zero."""
    return _col(numerator) / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def _units_since_first_day(unit: str, ts: Column) -> Column:
    return F.timestamp_diff(unit, F.lit(_FIRST_DAY).cast("timestamp_ntz"), ts)


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from start to end (not elapsed minutes)."""
    return _units_since_first_day("MINUTE", _col(end)) - _units_since_first_day("MINUTE", _col(start))


def seconds_between(start, end) -> Column:
    """Second boundaries crossed from start to end."""
    return _units_since_first_day("SECOND", _col(end)) - _units_since_first_day("SECOND", _col(start))


def days_between(start, end) -> Column:
    return F.datediff(_col(end), _col(start))


def plus(ts, **units) -> Column:
    """ts + amounts, e.g. plus("t", minute=F.col("n")); keeps timestamp_ntz."""
    moved = _col(ts)
    for unit, amount in units.items():
        moved = F.timestamp_add(unit.upper(), _col(amount) if isinstance(amount, str) else F.lit(amount), moved)
    return moved


def trunc_to(unit: str, ts) -> Column:
    """date_trunc that stays timestamp_ntz."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def moment(value: dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance; null when any coordinate is null."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin((lat2 - lat1) / 2.0)
    half_lon = F.sin((lon2 - lon1) / 2.0)
    chord = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    bounded = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.lit(2.0 * rules.EARTH_RADIUS_KM) * F.asin(F.sqrt(bounded))


def planar_km(lat1, lon1, lat2, lon2) -> Column:
    """Flat-earth distance with fixed kilometres per degree."""
    dy = (_col(lat2) - _col(lat1)) * rules.KM_PER_DEGREE_LAT
    dx = (_col(lon2) - _col(lon1)) * rules.KM_PER_DEGREE_LON
    return F.sqrt(F.pow(dy, F.lit(2.0)) + F.pow(dx, F.lit(2.0)))


def along(start, end, fraction) -> Column:
    """Point at a fraction of the straight line from start to end."""
    start = _col(start)
    return start + (_col(end) - start) * fraction


def tier(value, tiers: rules.Tiers, factor=None) -> Column:
    """Label of the first bound the value meets."""
    value, compare = _col(value), _COMPARE[tiers.op]
    chain = F
    for bound, label in tiers.bounds:
        limit = F.lit(bound) if factor is None else _col(factor) * bound
        chain = chain.when(compare(value, limit), F.lit(label))
    return chain.otherwise(F.lit(tiers.default))


def word_class(value, classes: dict[str, tuple], default: str) -> Column:
    """Name of the class whose word list holds the value."""
    chain = F
    for name, words in classes.items():
        chain = chain.when(_col(value).isin(*words), F.lit(name))
    return chain.otherwise(F.lit(default))


def flag(condition: Column) -> Column:
    """Two-valued form of a condition: null counts as false."""
    return F.coalesce(condition, F.lit(False))


def count_if(condition: Column) -> Column:
    """Rows meeting the condition; null for an empty input, like SUM(CASE ...)."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def fixed_units(value, digits: int) -> Column:
    """A measure with at most `digits` decimals as a whole number of its last digit."""
    return F.rint(_col(value) * 10.0**digits).cast("bigint")


def fixed_sum(value, digits: int) -> Column:
    """Sum of a measure with at most `digits` decimals, exact in any order.

    Adding scaled integers makes the result independent of partitioning and of
    task retries, and stays in the long-typed hash aggregate.
    """
    return F.sum(fixed_units(value, digits)) / F.lit(10.0**digits)


def fixed_avg(value, digits: int) -> Column:
    """Average of a measure with at most `digits` decimals, exact in any order."""
    return safe_divide(
        F.sum(fixed_units(value, digits)).cast("double"), F.count(_col(value)) * F.lit(10.0**digits)
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """part in percent of whole, null when whole is zero."""
    return round_half_up(safe_divide(part.cast("double") * 100.0, whole), digits)


def greatest_or_null(*values) -> Column:
    """Largest value, null as soon as one is null (the built-in skips nulls)."""
    columns = [_col(v) for v in values]
    known = columns[0].isNotNull()
    for column in columns[1:]:
        known = known & column.isNotNull()
    return F.when(known, F.greatest(*columns))


def positive_hash(*values) -> Column:
    """Non-negative 64-bit hash; the sign bit is cleared, so no value overflows."""
    return F.xxhash64(*[_col(v) for v in values]).bitwiseAND(F.lit(9223372036854775807))


def element_or_null(items, index) -> Column:
    """Zero-based array element, null outside the array."""
    return F.get(items, index)
