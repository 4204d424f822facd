"""Brazilian display formats as column expressions.

Rounding is half-even (``format_number``).  Divergence: Spark rounds the
shortest decimal form of the double, Python the exact binary value, so the
two differ only when that shortest form is an exact tie (e.g. 1234.565).
The decimal and thousands separators are swapped at the end ('.' <-> ',')."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .columns import col


def _swap(s: Column) -> Column:
    return F.translate(s, ",.", ".,")


def _plain(x: Column, digits: int) -> Column:
    """Fixed-point text without grouping separators."""
    return F.regexp_replace(F.format_number(x, digits), ",", "")


def _nonfinite(x: Column, suffix: str = "") -> Column | None:
    return (F.when(F.isnan(x), F.lit("nan" + suffix))
            .when(x == float("inf"), F.lit("inf" + suffix))
            .when(x == float("-inf"), F.lit("-inf" + suffix)))


def brl(c, precision: int = 0) -> Column:
    """R$ with K/M scaling (one decimal) above 1e3/1e6; NULL -> 'R$ 0'."""
    x = col(c).cast("double")
    a = F.abs(x)
    body = (F.when(a >= 1_000_000, F.concat(_plain(x / 1_000_000, 1), F.lit("M")))
            .when(a >= 1_000, F.concat(_plain(x / 1_000, 1), F.lit("K")))
            .otherwise(F.format_number(x, precision)))
    return F.when(x.isNull() | F.isnan(x), F.lit("R$ 0")).otherwise(
        F.coalesce(F.concat(F.lit("R$ "), _nonfinite(x)), _swap(F.concat(F.lit("R$ "), body))))


def percent(c, precision: int = 1) -> Column:
    """value*100 with one decimal and '%'; NULL -> '0,0%'."""
    x = col(c).cast("double")
    y = x * 100
    return F.when(x.isNull() | F.isnan(x), F.lit("0,0%")).otherwise(
        F.coalesce(_nonfinite(y, "%"), _swap(F.concat(F.format_number(y, precision), F.lit("%")))))


def number_br(c, precision: int = 2) -> Column:
    x = col(c).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit("-")).otherwise(
        F.coalesce(_nonfinite(x), _swap(F.format_number(x, precision))))


def metric_value(metric: str, c) -> Column:
    """Unit-aware formatting of one metric column."""
    unit = C.METRIC_UNITS.get(metric)
    x = col(c).cast("double")
    if unit == "R$":
        return brl(x)
    if unit == "%":
        return F.when(F.abs(x) <= 1, percent(x)).otherwise(percent(x / 100))
    if unit in ("anos", "meses"):
        return F.concat(number_br(x, 0), F.lit(" " + unit))
    # metrics without a unit: the analysed system prints the raw float text;
    # we print a 2-decimal Brazilian number instead (engine-independent text)
    return number_br(x)


def label_of(metric: str) -> str:
    return C.METRIC_LABELS.get(metric, metric.replace("_", " ").title())


def polarity(metric: str, c) -> Column:
    x = col(c).cast("double")
    if metric in C.HIGHER_IS_BETTER:
        p = F.when(x > 0, F.lit("positive")).otherwise(F.lit("negative"))
    elif metric in C.LOWER_IS_BETTER:
        p = F.when(x > 0.3, F.lit("negative")).otherwise(F.lit("positive"))
    else:
        p = F.lit("neutral")
    return F.when(x.isNull() | F.isnan(x), F.lit("neutral")).otherwise(p)
