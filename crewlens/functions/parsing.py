"""Text to typed value. A value that cannot be read becomes NULL, never an error or NaN."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\r\n\x0b\x0c\u00a0"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: Layouts tried after ISO for dates of sheets, in this order; the day comes before the month.
DATE_FORMATS = (
    "d/M/yyyy", "d/M/yyyy H:m:s", "d/M/yyyy H:m", "d-M-yyyy", "d.M.yyyy", "yyyy/M/d", "yyyy-M-d", "yyyy-M-d H:m",
)
DAY_FIRST_FORMATS = ("d/M/yyyy", "d/M/yyyy H:m", "d/M/yyyy H:m:s", "yyyy-M-d", "yyyy-M-d H:m:s")


def quoted(name: str) -> str:
    """A column's exact name in SQL."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its exact name; sheet headers hold dots and blanks."""
    return F.col(quoted(name))


def strip(c: Column) -> Column:
    """Trim blanks, tabs, line ends and no-break spaces on both sides."""
    return F.btrim(c, F.lit(BLANKS))


def parse_num(c: Column) -> Column:
    """Text as double.

    The pattern keeps out what Spark's cast would let through ('1.0f', '1d', 'NaN').
    """
    text = strip(c.cast("string"))
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def parse_ts(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date or date-time text as a zone-free timestamp: ISO, or else the first layout that fits."""
    text = strip(c.cast("string"))
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(text.try_cast("timestamp_ntz"), *others)


def parse_dayfirst(c: Column, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Day-first text as a date. Every value is read on its own, whatever its neighbours hold."""
    text = strip(c.cast("string"))
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def num_of(df: DataFrame, name: str) -> Column:
    """A column as double: numbers are cast (NaN to NULL), anything else is parsed."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(col(name).cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, T.NumericType):
        return col(name).cast("double")
    return parse_num(col(name))


def ts_of(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A column as zone-free timestamp, parsed only where it is text."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return col(name).cast("timestamp_ntz")
    return parse_ts(col(name), formats)


def date_of(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A column as date. A date column stays bare, so that filters on it reach the scan."""
    return col(name) if isinstance(df.schema[name].dataType, T.DateType) else ts_of(df, name, formats).cast("date")


def dayfirst_of(df: DataFrame, name: str, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """A column as date, parsed day first only where it is text."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return date_of(df, name)
    return parse_dayfirst(col(name), formats)


def std_key(c: Column) -> Column:
    """A key as trimmed text without the '.0' that a float column leaves; blank becomes NULL."""
    return F.nullif(F.regexp_replace(strip(c.cast("string")), r"\.0$", ""), F.lit(""))


def key_of(df: DataFrame, name: str) -> Column:
    """``std_key`` of a column; whole doubles go through decimal, so 1e7 does not become '1.0E7'."""
    c = col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return c.cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e18)
        return F.when(whole, c.cast("decimal(38,0)").cast("string")).otherwise(
            std_key(F.nanvl(c.cast("double"), F.lit(None).cast("double")))
        )
    return std_key(c)


def norm_eq(c: Column, value: str, trim: bool = True) -> Column:
    """Case-insensitive equality as a flag; NULL counts as false."""
    text = c.cast("string")
    text = strip(text) if trim else text
    return F.coalesce(F.lower(text) == value.lower(), F.lit(False))


def eq_flag(c: Column, value: object) -> Column:
    """Exact equality as a flag; NULL counts as false."""
    return F.coalesce(c == F.lit(value), F.lit(False))


def icontains(c: Column, part: str) -> Column:
    """Case-insensitive substring test; NULL counts as false."""
    return F.coalesce(F.lower(c.cast("string")).contains(part.lower()), F.lit(False))


def istartswith(c: Column, prefix: str) -> Column:
    """Prefix test after trimming, case-insensitive; NULL counts as false."""
    return F.coalesce(F.lower(strip(c.cast("string"))).startswith(prefix.lower()), F.lit(False))
