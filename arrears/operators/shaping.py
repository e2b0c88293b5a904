"""Column selection, alignment and row filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def columns_by_type(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and text column names; booleans, dates and nested types are neither."""
    skip = set(exclude)
    fields = [f for f in df.schema.fields if f.name not in skip]
    numeric = [f.name for f in fields if isinstance(f.dataType, NUMERIC_TYPES)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def keep_known(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """The columns whose name is in ``known``, in the order of ``df``."""
    allowed = set(known)
    return df.select(*[c for c in df.columns if c in allowed])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones null, extra ones dropped, in order."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_aligned(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """All rows of all frames under one schema."""
    aligned = [align(f, schema) for f in frames]
    result = aligned[0]
    for frame in aligned[1:]:
        result = result.unionByName(frame)
    return result


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any null or NaN."""
    return df.na.drop("any")


def rows_missing(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNull())


def above_and_in(df: DataFrame, number: str, limit: float, text: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter((F.col(number) > limit) & F.col(text).isin(*allowed))


def apply_features(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a feature hook; without one the frame passes through."""
    return df.transform(hook) if hook else df


def years_and_clean_text(age: str, text: str) -> Callable[[DataFrame], DataFrame]:
    """Hook: age in years, lower-case text with dots turned into underscores."""
    return lambda df: df.withColumns(
        {age: F.col(age) / 365.0, text: F.replace(F.lower(F.col(text)), F.lit("."), F.lit("_"))}
    )
