"""Data quality scores as one-row DataFrames (lazy; nothing is collected).

All parts come from one pass: the frame is grouped by every column (the same
shuffle a ``distinct`` needs; partial aggregation collapses repeated rows
map-side), and the grouped frame is reduced to a single row. Row count,
distinct rows, NULL cells and the lexical classes of text columns are all
read from that grouped frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lexical classes of text values for the consistency part
# (a column is consistent when its non-NULL values fall in at most one class).
LEXICAL_CLASSES = (
    ("int", r"^[+-]?[0-9]+$"),
    ("decimal", r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("bool", r"^(true|false|True|False|TRUE|FALSE)$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"),
)


def lexical_class(c: Column) -> Column:
    """'int' | 'decimal' | 'bool' | 'date' | 'text' for a string value (NULL stays NULL)."""
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for name, pattern in LEXICAL_CLASSES:
        expr = expr.when(c.rlike(pattern), F.lit(name))
    return expr.otherwise(F.lit("text"))


def _class_bit(c: Column) -> Column:
    """The value's lexical class as one bit of a mask (NULL has none), so a column's classes are one ``bit_or``."""
    expr = F.when(c.isNull(), F.lit(0))
    for k, (_, pattern) in enumerate(LEXICAL_CLASSES):
        expr = expr.when(c.rlike(pattern), F.lit(1 << k))
    return expr.otherwise(F.lit(1 << len(LEXICAL_CLASSES)))


def _missing(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _parts(df: DataFrame, lexical: bool) -> tuple[DataFrame, int, list[str]]:
    cols = df.columns
    lex_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)] if lexical else []
    null_cells: Column = F.lit(0)
    for c in cols:
        null_cells = null_cells + F.when(_missing(df, c), 1).otherwise(0)
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")) if cols else \
        df.agg(F.count(F.lit(1)).alias("__n"))
    exprs = [
        F.sum("__n").cast("long").alias("total_rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_rows"),
        F.sum(F.col("__n") * null_cells).cast("long").alias("total_nulls"),
    ]
    for i, c in enumerate(lex_cols):
        exprs.append(F.bit_count(F.bit_or(_class_bit(F.col(c)))).alias(f"__k{i}"))
    return grouped.agg(*exprs), len(cols), lex_cols


def quality_score(df: DataFrame, lexical: bool = False,
                  weights: Sequence[float] = (0.4, 0.3, 0.3)) -> DataFrame:
    """0-100 score = 0.4·completeness + 0.3·uniqueness + 0.3·consistency.

    completeness = non-NULL cells / cells; uniqueness = distinct rows / rows;
    consistency = columns whose non-NULL values have one lexical class /
    columns. Typed Spark columns are consistent by construction; with
    ``lexical=True`` text columns are classified (int, decimal, bool, date,
    text). Parts are rounded to 1 digit; an empty frame gives NULL scores.
    """
    agg, n_cols, lex_cols = _parts(df, lexical)
    rows = F.col("total_rows").cast("double")
    completeness = (F.lit(1.0) - F.col("total_nulls").cast("double")
                    / F.nullif(rows * F.lit(float(n_cols)), F.lit(0.0))) * 100
    uniqueness = F.col("distinct_rows").cast("double") / F.nullif(rows, F.lit(0.0)) * 100
    consistent: Column = F.lit(float(n_cols - len(lex_cols)))
    for i, _ in enumerate(lex_cols):
        consistent = consistent + F.when(F.col(f"__k{i}") <= 1, 1.0).otherwise(0.0)
    consistency = F.when(rows > 0, consistent / F.lit(float(n_cols)) * 100)
    w1, w2, w3 = weights
    scored = agg.select(
        "total_rows", "total_nulls",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        completeness.alias("c"), uniqueness.alias("u"), consistency.alias("k"))
    return scored.select(
        F.round(F.col("c") * w1 + F.col("u") * w2 + F.col("k") * w3, 1).alias("overall_score"),
        F.round("c", 1).alias("completeness"),
        F.round("u", 1).alias("uniqueness"),
        F.round("k", 1).alias("consistency"),
        "total_rows", "total_nulls", "duplicate_rows",
    )


def etl_quality_score(df: DataFrame, weights: Sequence[float] = (0.6, 0.4)) -> DataFrame:
    """ETL score = 0.6·completeness + 0.4·uniqueness, 1 digit (C14)."""
    agg, n_cols, _ = _parts(df, False)
    rows = F.col("total_rows").cast("double")
    completeness = (F.lit(1.0) - F.col("total_nulls").cast("double")
                    / F.nullif(rows * F.lit(float(n_cols)), F.lit(0.0))) * 100
    uniqueness = F.col("distinct_rows").cast("double") / F.nullif(rows, F.lit(0.0)) * 100
    w1, w2 = weights
    return agg.select(completeness.alias("c"), uniqueness.alias("u")).select(
        F.round(F.col("c") * w1 + F.col("u") * w2, 1).alias("quality_score"),
        F.round("c", 1).alias("completeness"),
        F.round("u", 1).alias("uniqueness"),
    )
