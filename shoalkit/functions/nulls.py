"""Three-valued helpers: the reference's missing-value rules as Spark Column expressions.

Each helper returns a ``Column``; nothing here runs Python per row.

N1  flag(cond)           ifelse(cond, "FLAG", "")  -> NULL when cond is NULL
N2  in_set / not_in_set  %in% / %!in% never NULL
N3  case_flag            case_when without default -> NULL when nothing matched
N5  strict_sum/lenient   sum without na.rm is NULL if any input is NULL
N6  safe_div             x / 0 -> NULL instead of an ANSI error
N7  asc_last             ascending order, NULL last
N8  paste                text "NA" for NULL parts
N10 pad_int              zero padding that never truncates
N11 sub_first            replace the first match only
N12 mean_or_null         mean of all-NULL is NULL, kept out by isNotNull
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAG = "FLAG"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column, yes: str = FLAG, no: str = "") -> Column:
    """``ifelse(cond, yes, no)`` keeping NULL when ``cond`` is NULL."""
    return F.when(cond.isNull(), F.lit(None).cast("string")).when(cond, F.lit(yes)).otherwise(F.lit(no))


def in_set(c, values) -> Column:
    """``c %in% values`` -- FALSE (never NULL) for a NULL value.

    A NULL in ``values`` matches a NULL ``c``, as R's match() does.
    """
    vals = list(values)
    non_null = [v for v in vals if v is not None]
    col = _c(c)
    hit = F.coalesce(col.isin(non_null), F.lit(False)) if non_null else F.lit(False)
    if len(non_null) != len(vals):
        hit = hit | col.isNull()
    return hit


def not_in_set(c, values) -> Column:
    """``c %!in% values`` -- TRUE for a NULL value."""
    return ~in_set(c, values)


def case_flag(*cond_values) -> Column:
    """``case_when(c1 ~ v1, c2 ~ v2, ...)`` with no default (NULL when unmatched)."""
    out = None
    for cond, value in cond_values:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out


def strict_sum(c) -> Column:
    """``sum(x)`` that is NULL when any input is NULL."""
    col = _c(c)
    return F.when(F.count(col) == F.count(F.lit(1)), F.sum(col))


def lenient_sum(c) -> Column:
    """``sum(x, na.rm = TRUE)``: NULLs skipped, an all-NULL group sums to 0."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def strict_mean(c) -> Column:
    """``mean(x)`` without na.rm: NULL when any input is NULL."""
    col = _c(c)
    return F.when(F.count(col) == F.count(F.lit(1)), F.avg(col))


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero or NULL divisor."""
    return F.try_divide(_c(a), _c(b))


def asc_last(c) -> Column:
    """Ascending, NULL last."""
    return _c(c).asc_nulls_last()


def paste(*cols, sep: str = " ", na: str = "NA") -> Column:
    """R ``paste``: NULL parts print as ``na``."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(na)) for c in cols])


def pad_int(c, width: int = 3) -> Column:
    """``str_pad(n, width, "left", "0")`` that never truncates."""
    return F.format_string(f"%0{width}d", _c(c).cast("long"))


def sub_first(c, pattern: str, replacement: str = "") -> Column:
    """R ``sub``: replace the first match of ``pattern`` only.

    The prefix before the first match is captured lazily and kept.
    """
    return F.regexp_replace(_c(c), f"^(.*?){pattern}", f"$1{replacement}")


def any_null(cols) -> Column:
    """Row-wise ``any(is.na(...))`` across ``cols`` as one OR-reduced expression."""
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def any_flag(cols, value: str = FLAG) -> Column:
    """Row has any flag column equal to ``value`` (NULL is not a flag)."""
    return reduce(lambda a, b: a | b, [F.coalesce(_c(c) == value, F.lit(False)) for c in cols])


def null_safe_eq(a: Column, b: Column) -> Column:
    """NULL matches NULL (local R joins)."""
    return a.eqNullSafe(b)


def r_round(c, digits: int = 0) -> Column:
    """R's ``round(x, digits)`` on doubles, as half-even rounding of ``x * 10^digits``.

    Spark's ``round`` rounds the shortest decimal text of a double half-up: 1.005
    (stored as 1.00499...) goes up and an exact tie such as 0.125 goes up. R rounds the
    stored value and sends exact ties to even (``round(0.125, 2)`` is 0.12,
    ``round(2.5)`` is 2). Scaling, rounding half-even and scaling back reproduces that;
    SQL engines spell it ``round_even``. When the scaled product itself lands on a .5
    (174.255 * 100) the tie rule decides, as in SQL. The result is a DOUBLE.
    """
    scale = float(10 ** digits)
    x = _c(c).cast("double")
    if digits == 0:
        return F.bround(x, 0)
    return F.bround(x * F.lit(scale), 0) / F.lit(scale)
