"""Reusable column expressions.  All are built-in Spark SQL expressions so
they stay inside whole-stage codegen; no Python UDF anywhere."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(F.to_date(col(c)), "month")


def is_finite(c) -> Column:
    """True for non-null, non-NaN, non-infinite values."""
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(INF))


def finite_or_null(c) -> Column:
    """NaN and +/-inf become NULL (the library's 'undefined' convention)."""
    c = col(c)
    return F.when(is_finite(c), c)


def safe_num(c, fill: float = 0.0) -> Column:
    """Non-numeric, NaN or infinite -> ``fill``."""
    return F.coalesce(finite_or_null(col(c).cast("double")), F.lit(fill))


def ratio(num, den) -> Column:
    """num / den with NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col(num), col(den))


def pct_change(cur, prev) -> Column:
    """cur/prev - 1 with the float semantics of a spreadsheet engine:
    prev missing -> NULL, x/0 -> +/-inf by the sign of x, 0/0 -> NULL."""
    cur, prev = col(cur), col(prev)
    return (F.when(prev.isNull() | cur.isNull(), F.lit(None).cast("double"))
            .when(prev != 0, cur / prev - F.lit(1.0))
            .when(cur > 0, F.lit(INF))
            .when(cur < 0, F.lit(-INF)))


def clip(c, lo, hi) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def _any_contains(text: Column, tokens) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(t) for t in tokens])


def sector_of(activity) -> Column:
    """Activity description -> sector by the ordered keyword rules.
    Substring matching on the upper-cased text (so short tokens also match
    inside longer words); a NULL text has no keyword -> default sector."""
    text = F.upper(F.coalesce(col(activity), F.lit("NONE")))
    expr = None
    for sector, tokens in C.SECTOR_RULES:
        cond = _any_contains(text, tokens)
        expr = F.when(cond, F.lit(sector)) if expr is None else expr.when(cond, F.lit(sector))
    return expr.otherwise(F.lit(C.DEFAULT_SECTOR))


def size_of(revenue) -> Column:
    """Yearly revenue -> size band (half-open); negative or NULL -> MICRO."""
    r = col(revenue)
    expr = None
    for name, lo, hi in C.SIZE_BANDS:
        cond = (r >= F.lit(lo)) & (r < F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("MICRO"))


def size_ordinal(size) -> Column:
    s = col(size)
    expr = None
    for name, v in C.SIZE_ORDINAL.items():
        expr = F.when(s == name, F.lit(v)) if expr is None else expr.when(s == name, F.lit(v))
    return expr.otherwise(F.lit(0)).cast("double")


def sector_cycle(sector) -> Column:
    s = col(sector)
    expr = None
    for name, (cycle, _) in C.SECTOR_PROFILES.items():
        expr = F.when(s == name, F.lit(cycle)) if expr is None else expr.when(s == name, F.lit(cycle))
    return expr.otherwise(F.lit(C.SECTOR_PROFILES[C.DEFAULT_SECTOR][0]))


def sector_capital_intensive(sector) -> Column:
    heavy = [n for n, (_, cap) in C.SECTOR_PROFILES.items() if cap]
    return F.when(col(sector).isin(heavy), F.lit(1)).otherwise(F.lit(0))


def age_years(opened, as_of: str) -> Column:
    """Whole days between opening and ``as_of`` / 365.25, floored at 0;
    missing opening date -> 5.0."""
    days = F.datediff(F.to_date(F.lit(as_of)), F.to_date(col(opened)))
    return (F.when(days.isNull(), F.lit(5.0))
            .otherwise(F.greatest(F.lit(0.0), days.cast("double") / F.lit(365.25))))


def text_prefix_sector(activity) -> Column:
    """Upper-cased text before the first '-', ';', '|' or '/'; empty or
    missing -> default sector."""
    pref = F.regexp_extract(F.upper(col(activity)), r"^([^-;|/]+)", 1)
    return F.when(col(activity).isNull() | (pref == ""), F.lit(C.DEFAULT_SECTOR)).otherwise(pref)


def fold_accents(c) -> Column:
    """Strip the Portuguese accents used by the stage labels."""
    return F.translate(col(c), "ÁÀÂÃÉÊÍÓÔÕÚÇáàâãéêíóôõúç", "AAAAEEIOOOUCaaaaeeiooouc")


def banded(value, bands, last) -> Column:
    """First band whose threshold is strictly exceeded wins."""
    v = col(value)
    expr = None
    for thr, label in bands:
        expr = F.when(v > thr, F.lit(label)) if expr is None else expr.when(v > thr, F.lit(label))
    return expr.otherwise(F.lit(last))


def banded_ge(value, bands, last) -> Column:
    """First band whose threshold is reached (>=) wins."""
    v = col(value)
    expr = None
    for thr, label in bands:
        expr = F.when(v >= thr, F.lit(label)) if expr is None else expr.when(v >= thr, F.lit(label))
    return expr.otherwise(F.lit(last))


def compact_array(*conds_and_codes) -> Column:
    """array of codes whose condition holds (NULL conditions count false)."""
    items = [F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for c, code in conds_and_codes]
    return F.filter(F.array(*items), lambda x: x.isNotNull())
