"""Data cleaning operators: schema coercion, deduplication, null handling,
outlier treatment and string standardisation.

Design rules
------------
* Every operator is ``DataFrame -> DataFrame`` (plus small statistics).
* Statistics that decide a later projection (null shares, medians, modes,
  quartiles, means) are computed for **all** columns in one aggregate; the
  result is one row, so bringing it to the driver is bounded by the column
  count, never by the data.
* Key-based deduplication is an aggregate (``groupBy(keys)`` with ``min``/``max``
  of a struct; sorted, as the struct holds text), not a window: partial
  aggregation combines a hot key map-side before the shuffle, so one key
  holding a third of the rows costs no more than any other key.
* NaN is missing, as in pandas: the null, fill and outlier operators see it as
  NULL.

Intentional deviations from the pandas original: a bool target is really
cast; NULL is not counted as a changed value in standardisation; the outlier
flag column is always added; every numeric type gets the median.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsight.functions.scalar import clip, collapse_ws, strip_ws
from opsight.operators.ranks import column_modes, column_percentiles

# Type names of an expected schema.
TYPE_NAMES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "bool": T.BooleanType(),
}

DEFAULT_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type (bool is not numeric)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# --------------------------------------------------------------------- C1 / C2
def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected columns absent from ``df`` (reported, not fatal)."""
    have = set(df.columns)
    return sorted(c for c in expected if c not in have)


def _to_timestamp(c: Column, formats: Sequence[str]) -> Column:
    parsed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def coercion_exprs(df: DataFrame, expected: dict[str, str],
                    date_formats: Sequence[str]) -> dict[str, Column]:
    """Column -> cast expression, for columns whose type must change."""
    out: dict[str, Column] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, want in expected.items():
        target = TYPE_NAMES.get(want)
        if name not in types or target is None or types[name] == target:
            continue
        src = F.col(name)
        if isinstance(target, T.TimestampNTZType):
            if isinstance(types[name], T.StringType):
                expr = _to_timestamp(src, date_formats)
            else:
                expr = src.try_cast("timestamp_ntz")
        elif isinstance(target, T.StringType):
            expr = src.cast("string")
        else:
            if isinstance(types[name], T.StringType):
                src = strip_ws(src)
            expr = src.try_cast(target)
            if isinstance(target, T.LongType) and isinstance(types[name], T.StringType):
                expr = F.coalesce(expr, _whole_number(src))
        out[name] = expr
    return out


def _whole_number(text: Column) -> Column:
    """Decimal or exponent text as a whole number: '12.0' and '1e3' exactly, a fraction cut towards zero
    (as pandas' nullable integers after rounding down); what is no number or too large is NULL."""
    exact = text.try_cast("decimal(38,18)")
    return F.coalesce(exact.try_cast("long"), text.try_cast("double").try_cast("long"))


def coerce_types(df: DataFrame, expected: dict[str, str],
                 date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> tuple[DataFrame, list[str]]:
    """Cast columns to the expected types; a value that cannot be cast becomes NULL.

    Returns the new frame and the columns whose type changed. Text is parsed
    as ISO timestamps / dates by ``date_formats`` in order; numbers may carry
    surrounding whitespace, and whole numbers may be written as '12.0' or '1e3'
    (a fraction is cut towards zero).
    """
    exprs = coercion_exprs(df, expected, date_formats)
    cols = [exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns]
    return df.select(*cols), [c for c in df.columns if c in exprs]


def value_lost(df: DataFrame, name: str, cast: Column) -> Column:
    """Whether a non-NULL value of the column is NULL after the cast, or a number that lost its fraction."""
    source, kind = F.col(name), dict(df.dtypes)[name]
    number = (strip_ws(source) if kind == "string" else source).try_cast("double")
    cut = F.coalesce((F.abs(number) < 2.0 ** 52) & (number != F.floor(number)), F.lit(False))
    whole = isinstance(df.select(cast.alias("c")).schema["c"].dataType, T.IntegralType)
    gone = cast.isNull() | cut if whole and kind not in ("boolean", "timestamp", "timestamp_ntz", "date") else cast.isNull()
    return source.isNotNull() & gone


def coercion_losses(df: DataFrame, expected: dict[str, str],
                    date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> dict[str, int]:
    """Per coerced column, values of ``df`` that the cast turns into NULL or whose fraction it cuts (one aggregate)."""
    exprs = coercion_exprs(df, expected, date_formats)
    if not exprs:
        return {}
    names = list(exprs)
    row = df.agg(*[F.count_if(value_lost(df, c, exprs[c])).alias(f"l{i}") for i, c in enumerate(names)]).first()
    return {c: int(row[f"l{i}"]) for i, c in enumerate(names)}


# --------------------------------------------------------------------- C3 - C5
def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row dedup; NULLs compare equal."""
    return df.distinct()


def dedup_by_key(df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first",
                 order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Drop duplicates of ``subset`` keeping the first / last row by ``order_by`` (C4),
    or dropping every row whose key repeats (``keep=False``, C5).

    Ties in ``order_by`` are broken by the remaining columns, so the result is
    deterministic. A DataFrame has no row position: ``order_by`` states what
    "first" means.
    """
    if not subset:
        if keep is False:
            return dedup_by_key(df, df.columns, False)
        return df.distinct()
    keys = list(subset)
    rest = [c for c in df.columns if c not in keys]
    if keep is False:
        packed = F.struct(*rest) if rest else F.lit(None)
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.any_value(packed).alias("__row"))
        g = g.filter(F.col("__n") == 1)
        return g.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first', 'last' or False")
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order_by]
    packed = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order_cols)],
                      *[F.col(c).alias(c) for c in rest])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    g = df.groupBy(*keys).agg(pick.alias("__row"))
    return g.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


# --------------------------------------------------------------------- C6 - C10
def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """NULL (and NaN) count per column in one aggregate."""
    cols = list(columns or df.columns)
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return {c: int(row[f"n{i}"]) for i, c in enumerate(cols)}


def is_missing(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in float columns (pandas treats NaN as missing)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL or NaN."""
    return df.na.drop(how="any")


def fill_custom(df: DataFrame, fills: dict | None) -> DataFrame:
    """Fill NULLs with given per-column values; unknown columns are ignored."""
    if not fills:
        return df
    df = nan_to_null(df)
    known = {k: v for k, v in fills.items() if k in df.columns}
    exprs = []
    for f in df.schema.fields:
        if f.name in known:
            exprs.append(F.coalesce(F.col(f.name), F.lit(known[f.name]).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def columns_over_null_share(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """Columns whose NULL share is strictly above ``threshold``."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    n = row["__n"]
    if not n:
        return []
    return [c for i, c in enumerate(cols) if row[f"n{i}"] / n > threshold]


def fill_values_smart(df: DataFrame) -> dict[str, object]:
    """Median of every numeric column and lowest mode of every other column, for columns that contain
    NULL or NaN (C9, C10). Medians come from distributed ranks, modes from grouped counts."""
    lacking = [c for c, n in null_counts(df).items() if n] if df.columns else []
    nums = [c for c in lacking if c in set(numeric_columns(df))]
    medians = {c: q[0] for c, q in column_percentiles(df, nums, [0.5]).items()}
    return medians | column_modes(df, [c for c in lacking if c not in nums])


def fill_smart(df: DataFrame, drop_threshold: float = 0.5) -> tuple[DataFrame, list[str], dict]:
    """Drop mostly-NULL columns, then fill numeric NULLs with the median and the
    others with the most frequent value (ties: smallest) (C8-C10).

    Integral columns receive the median cast to their own type, so the schema
    does not change.
    """
    df = nan_to_null(df)
    dropped = columns_over_null_share(df, drop_threshold)
    kept = df.drop(*dropped) if dropped else df
    values = fill_values_smart(kept)
    exprs = []
    for f in kept.schema.fields:
        if f.name in values:
            exprs.append(F.coalesce(F.col(f.name), F.lit(values[f.name]).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return kept.select(*exprs), dropped, values


# --------------------------------------------------------------------- C11
def outlier_bounds(df: DataFrame, columns: Sequence[str], method: str = "iqr",
                   k_iqr: float = 1.5, k_sigma: float = 3.0) -> dict[str, tuple[float, float]]:
    """Lower/upper outlier bounds per column.

    ``iqr``: Q1 - 1.5·IQR, Q3 + 1.5·IQR with linear-interpolated quartiles;
    ``zscore``: mean ± 3·sample std. NULL and NaN are ignored. Columns with no
    other value get ``(None, None)``.
    """
    if method not in ("iqr", "zscore"):
        raise ValueError("method must be 'iqr' or 'zscore'")
    out: dict[str, tuple] = {c: (None, None) for c in columns}
    if not columns:
        return out
    if method == "iqr":
        for c, (q1, q3) in column_percentiles(df, columns, [0.25, 0.75]).items():
            out[c] = (q1 - k_iqr * (q3 - q1), q3 + k_iqr * (q3 - q1))
        return out
    clean = nan_to_null(df.select(*columns))
    row = clean.agg(*[e for i, c in enumerate(columns)
                      for e in (F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"))]).first()
    for i, c in enumerate(columns):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is not None and s is not None:
            out[c] = (m - k_sigma * s, m + k_sigma * s)
    return out


def _outside(c: str, lo, hi) -> Column:
    if lo is None:
        return F.lit(False)
    x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))  # NaN is missing, not above every bound
    return (x < F.lit(lo)) | (x > F.lit(hi))


def treat_outliers(df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr",
                   treatment: str = "cap") -> tuple[DataFrame, dict[str, tuple]]:
    """Cap, remove or flag outliers (C11).

    ``cap`` and ``flag`` use bounds of all columns from one aggregate and one
    projection. ``remove`` is sequential like the original: each column's
    bounds come from the rows left after the previous column's removal (one
    aggregate per column). NULL is never an outlier.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    if treatment == "remove":
        bounds = {}
        cur = df
        for c in cols:
            b = outlier_bounds(cur, [c], method)[c]
            bounds[c] = b
            cur = cur.filter(~F.coalesce(_outside(c, *b), F.lit(False)))
        return cur, bounds
    bounds = outlier_bounds(df, cols, method)
    return apply_bounds(df, bounds, treatment), bounds


def apply_bounds(df: DataFrame, bounds: dict[str, tuple], treatment: str) -> DataFrame:
    """Cap values to known bounds, or flag those outside (one projection)."""
    if treatment == "cap":
        return df.select(*[clip(f, F.lit(bounds[f][0]), F.lit(bounds[f][1])).cast(df.schema[f].dataType).alias(f)
                           if f in bounds and bounds[f][0] is not None else F.col(f) for f in df.columns])
    if treatment == "flag":
        return df.select("*", *[F.coalesce(_outside(c, *b), F.lit(False)).cast("int").alias(f"{c}_outlier")
                                for c, b in bounds.items()])
    raise ValueError("treatment must be 'cap', 'remove' or 'flag'")


def count_outliers(df: DataFrame, bounds: dict[str, tuple]) -> dict[str, int]:
    """Rows outside the bounds per column (one aggregate)."""
    if not bounds:
        return {}
    cols = list(bounds)
    row = df.agg(*[F.count_if(_outside(c, *bounds[c])).alias(f"o{i}") for i, c in enumerate(cols)]).first()
    return {c: int(row[f"o{i}"]) for i, c in enumerate(cols)}


# --------------------------------------------------------------------- C12
def standardize_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip and collapse whitespace in string columns."""
    cols = set(columns if columns is not None else string_columns(df))
    return df.select(*[collapse_ws(strip_ws(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def count_changed(before: DataFrame, columns: Sequence[str] | None = None) -> int:
    """Number of string values standardisation changes; NULL is not a change."""
    cols = list(columns if columns is not None else string_columns(before))
    if not cols:
        return 0
    changed = [F.count_if(~F.col(c).eqNullSafe(collapse_ws(strip_ws(c)))) for c in cols]
    total = changed[0]
    for e in changed[1:]:
        total = total + e
    return int(before.agg(total.alias("n")).first()["n"])
