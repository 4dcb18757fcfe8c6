"""One date layout for a whole column, decided by all of its values.

``05/06/2025`` is a day in May or in June; only other values of the column can tell. Each layout
is a list of patterns. All of them are tried on all values in one aggregation, and the one that
reads most is taken. If two read equally many and differ on some value, nothing in the column
decides, and that is an error that names the column and such a value.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.functions.parsing import DATE_FORMATS, col, parse_ts

MONTH_FIRST_FORMATS = (
    "M/d/yyyy", "M/d/yyyy H:m:s", "M/d/yyyy H:m", "M-d-yyyy", "M.d.yyyy", "yyyy/M/d", "yyyy-M-d", "yyyy-M-d H:m",
)
LAYOUTS: Mapping[str, Sequence[str]] = {"day first": DATE_FORMATS, "month first": MONTH_FIRST_FORMATS}


def layout_counts(df: DataFrame, columns: Sequence[str], layouts: Mapping[str, Sequence[str]] = LAYOUTS) -> DataFrame:
    """Per column and layout: values given and read, and per pair of layouts how many values both
    read but as different dates, with one of them.

    One row per column; the table is read once, whatever the number of columns and layouts.
    """
    names = list(layouts)

    def judged(name: str) -> Column:
        read = [parse_ts(col(name), layouts[n]) for n in names]
        counts = [F.count(r).alias(f"n{i}") for i, r in enumerate(read)]
        pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
        differ = [F.when(read[i] != read[j], col(name).cast("string")) for i, j in pairs]
        unlike = [c for d, (i, j) in zip(differ, pairs) for c in (F.count(d).alias(f"d{i}_{j}"), F.min(d).alias(f"e{i}_{j}"))]
        return F.struct(F.lit(name).alias("column"), F.count(col(name)).alias("n_given"), *counts, *unlike)

    found = df.agg(*[judged(c).alias(f"c{k}") for k, c in enumerate(columns)])
    return found.select(F.inline(F.array(*[F.col(f"c{k}") for k in range(len(columns))])))


def column_layouts(
    df: DataFrame, columns: Sequence[str], layouts: Mapping[str, Sequence[str]] = LAYOUTS, default: str | None = None
) -> dict[str, str]:
    """The layout of each text column, by name; columns that are dates already are left out.

    Runs one aggregation. ``default`` is taken where the values do not decide; without it they
    must. A column without any value gets the default or the first layout.
    """
    texts = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    names, out = list(layouts), {}
    for row in layout_counts(df, texts, layouts).collect() if texts else ():
        read = [row[f"n{i}"] for i in range(len(names))]
        best = [i for i in range(len(names)) if read[i] == max(read)]
        open_pairs = [(i, j) for i in best for j in best if i < j and row[f"d{i}_{j}"]]
        if open_pairs and default is None:
            i, j = open_pairs[0]
            raise ValueError(
                f"column {row['column']!r} can be read as {names[i]} or as {names[j]}, for example {row[f'e{i}_{j}']!r}; state its layout"
            )
        preferred = names.index(default) if default in names else best[0]
        out[row["column"]] = names[preferred if preferred in best else best[0]]
    return out


def with_dates(
    df: DataFrame, columns: Sequence[str], layouts: Mapping[str, Sequence[str]] = LAYOUTS, default: str | None = None
) -> DataFrame:
    """The table with the text columns as timestamps, each by the layout of its column."""
    chosen = column_layouts(df, columns, layouts, default)
    return df.withColumns({c: parse_ts(col(c), layouts[n]) for c, n in chosen.items()})
