"""Projections that adapt to the columns a table has. Decided while the plan is built."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions.parsing import col, key_of, num_of


def clean_header(name: str) -> str:
    """Header without outer white space, no-break spaces turned into blanks."""
    return name.strip().replace("\u00a0", " ")


def clean_columns(df: DataFrame) -> DataFrame:
    """Normalise all headers."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; absent names are ignored."""
    return df.withColumnsRenamed(dict(names))


def standardize_id(df: DataFrame, source: str, target: str) -> DataFrame:
    """Rename the key column and bring its values to the common text form."""
    out = rename(df, {source: target})
    return out.withColumn(target, key_of(out, target)) if target in out.columns else out


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project to those of the names that exist."""
    return df.select(*[col(n) for n in names if n in df.columns])


def first_existing(df: DataFrame, names: Sequence[str]) -> str:
    """First of the names that exists, else ``KeyError``."""
    for name in names:
        if name in df.columns:
            return name
    raise KeyError(f"none of the columns {list(names)} found")


def column_or(df: DataFrame, name: str, default: object = None, kind: str = "string") -> Column:
    """The column if it exists, else a typed literal."""
    return col(name) if name in df.columns else F.lit(default).cast(kind)


def select_positions(df: DataFrame, positions: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Pick columns by position and name them anew."""
    return df.select(*[col(df.columns[i]).alias(n) for i, n in zip(positions, names, strict=True)])


def to_numeric_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project to the named columns as doubles; what cannot be read is NULL."""
    return df.select(*[num_of(df, n).alias(n) for n in names])
