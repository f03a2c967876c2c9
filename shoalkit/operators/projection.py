"""Column-set helpers: positional ranges, reordering, regex drops, per-column mutation.

They only rewrite the projection list (driver-side metadata), so Catalyst still prunes
unused columns down to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` inclusive, in table order (R's ``first:last``)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if i > j:
        i, j = j, i
    return cols[i:j + 1]


def move_first(df: DataFrame, *cols: str) -> DataFrame:
    """``select(a, b, everything())``."""
    first = list(cols)
    return df.select(*first, *[c for c in df.columns if c not in first])


def drop_matching(df: DataFrame, regex: str, *extra: str) -> DataFrame:
    """Drop columns whose name matches ``regex`` plus the listed ``extra`` names."""
    pat = re.compile(regex)
    gone = {c for c in df.columns if pat.search(c)} | set(extra)
    return df.select(*[c for c in df.columns if c not in gone])


def lower_columns(df: DataFrame) -> DataFrame:
    """``rename_all(tolower)``."""
    return df.toDF(*[c.lower() for c in df.columns])


def select_columns(df: DataFrame, predicate) -> list[str]:
    """Names chosen by a predicate: a callable on (name, type), a regex, or a list."""
    if callable(predicate):
        return [f.name for f in df.schema.fields if predicate(f.name, f.dataType)]
    if isinstance(predicate, str):
        pat = re.compile(predicate)
        return [c for c in df.columns if pat.search(c)]
    wanted = set(predicate)
    return [c for c in df.columns if c in wanted]


def ends_with(suffix: str):
    return lambda name, _t: name.endswith(suffix)


def contains(part: str):
    return lambda name, _t: part in name


def of_type(*types):
    return lambda _name, t: isinstance(t, tuple(types))


def mutate_where(df: DataFrame, predicate, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every column chosen by ``predicate`` (``mutate_at``/``mutate_if``)."""
    names = select_columns(df, predicate)
    if not names:
        return df
    return df.withColumns({c: fn(F.col(c)) for c in names})


STRING = of_type(T.StringType)
TIMESTAMP = of_type(T.TimestampType, T.TimestampNTZType)


#: Between packed texts; marks what is escaped in them, and NULL.
_BETWEEN, _MARK = "\x1f", "\x1e"


def pack_texts(cols) -> Column:
    """Several text columns as one, without loss (``unpack_texts``): a shuffled row pays for each
    column's place and padding, which compress badly."""
    safe = [F.replace(F.replace(F.col(c), F.lit(_MARK), F.lit(f"{_MARK}0")), F.lit(_BETWEEN), F.lit(f"{_MARK}1")) for c in cols]
    return F.concat_ws(_BETWEEN, *[F.coalesce(c, F.lit(f"{_MARK}2")) for c in safe])


def unpack_texts(packed: str, cols) -> dict:
    """Column by name of the texts that ``pack_texts`` put into the column ``packed``."""
    out = {}
    for k, c in enumerate(cols, 1):
        part = F.nullif(F.split_part(F.col(packed), F.lit(_BETWEEN), F.lit(k)), F.lit(f"{_MARK}2"))
        out[c] = F.replace(F.replace(part, F.lit(f"{_MARK}1"), F.lit(_BETWEEN)), F.lit(f"{_MARK}0"), F.lit(_MARK))
    return out
