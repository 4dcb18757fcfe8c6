"""Headers of the files of a sheet, and the groups of files that share one."""

import csv
import io
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

FIRST_READ = 1 << 16
READERS = 16


@dataclass(frozen=True)
class Layout:
    """Files with the same header. ``names`` are its column names, cleaned and made unique."""

    header: tuple[str, ...]
    names: tuple[str, ...]
    files: tuple[str, ...]


def unique_headers(names: Sequence[str | None]) -> list[str]:
    """Header texts made unique: later copies of a header get '.1', '.2'; empty ones a position."""
    seen: Counter[str] = Counter()
    out = []
    for i, name in enumerate(names):
        base = name if name else f"Unnamed: {i}"
        out.append(f"{base}.{seen[base]}" if seen[base] else base)
        seen[base] += 1
    return out


def first_record(text: str, sep: str = ",") -> list[str] | None:
    """Cells of the first line with any, line breaks inside quotes included; None if there is none."""
    rows = csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter=sep)
    return next((row for row in rows if row), None)


def _closed(data: bytes) -> bool:
    """Does the text hold a line end outside of quotes, after something else?"""
    start = len(data) - len(data.lstrip(b"\r\n"))
    end = data.find(b"\n", start)
    while end >= 0:
        if data.count(b'"', 0, end) % 2 == 0:
            return True
        end = data.find(b"\n", end + 1)
    return False


def _read_first(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str] | None:
    """The header of one file; only its first bytes are read, more only if the header is longer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    raw = where.getFileSystem(conf).open(where)
    try:
        stream = codec.createInputStream(raw) if codec else raw
        data = b""
        while not _closed(data):
            more = bytes(stream.readNBytes(FIRST_READ))
            data += more
            if not more:
                break
        return first_record(data.decode(encoding, "replace"), sep)
    finally:
        raw.close()


def layouts(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    clean: Callable[[str], str] = str,
) -> list[Layout]:
    """The different headers of the files under ``path``, each with its files, first file first.

    The first bytes of every file are read, several files at a time. What is kept is one entry
    per different header and the list of paths, which Spark's own file listing holds as well.
    Files without any text have no header and are left out.
    """
    # The list as Spark would read it: globs resolved, hidden files left out.
    files = sorted(map(unquote, spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()))
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for file, header in zip(files, pool.map(lambda f: _read_first(spark, f, sep, encoding), files), strict=True):
            if header is not None:
                groups.setdefault(tuple(header), []).append(file)
    return [Layout(h, tuple(unique_headers([clean(c) for c in h])), tuple(f)) for h, f in groups.items()]


def all_columns(found: Iterable[Layout]) -> list[str]:
    """Columns of all layouts: those of the first, then what the later ones add."""
    return list(dict.fromkeys(name for layout in found for name in layout.names))


def layout_report(spark: SparkSession, found: Sequence[Layout], expected: Sequence[str] | None = None) -> DataFrame:
    """Per layout and column: number of files, one of them, position, and status.

    A column that the layout lacks is ``missing``; one that is not among the expected ones (by
    default: those of the first layout) is ``unknown``; a header that stands twice in a file gives
    ``repeated`` for its later copies; the others are ``known``.
    """
    wanted = list(expected) if expected is not None else list(found[0].names if found else ())
    rows = []
    for i, layout in enumerate(found):
        given = set(layout.header)
        for position, name in enumerate(layout.names):
            # A copy's name is one that the sheet itself does not have.
            copied = name not in wanted and name not in given and name.rpartition(".")[0] in layout.names
            status = "repeated" if copied else "known" if name in wanted else "unknown"
            rows.append((i, len(layout.files), layout.files[0], name, position, status))
        lacking = [name for name in wanted if name not in layout.names]
        rows += [(i, len(layout.files), layout.files[0], name, None, "missing") for name in lacking]
    return spark.createDataFrame(rows, "layout int, n_files long, example string, name string, position int, status string")
