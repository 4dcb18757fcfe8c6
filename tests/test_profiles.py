"""Profiles kept per file."""

import os

from crewlens.operators import stats
from crewlens.sources import profiles, readers
from tests.conftest import values


def sheet(tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a 1.csv").write_text("id,h\n1,\n2,N/A\n3,5\n")
    (folder / "b.csv").write_text("h ,id,x\n7,4,\n,,y\n")
    return folder


def names(paths):
    return sorted(p.rsplit("/", 1)[1].replace("%20", " ") for p in paths)


def test_only_new_and_changed_files_are_read_and_the_profile_is_that_of_all(spark, tmp_path):
    folder, store = sheet(tmp_path), str(tmp_path / "store")
    same = lambda: values(profiles.kept_quality(spark, store)) == values(stats.data_quality(readers.read_table(spark, str(folder))))
    assert names(profiles.update(spark, str(folder), store)) == ["a 1.csv", "b.csv"] and same()
    assert values(profiles.kept_quality(spark, store)) == [("x", 4, 80.0), ("h", 3, 60.0), ("id", 1, 20.0)]
    assert profiles.update(spark, str(folder), store) == [] and same()
    (folder / "c.csv").write_text("id,h\n9,9\n")
    read = []
    real = profiles.file_counts
    try:
        profiles.file_counts = lambda spark, files, *more: read.append(real(spark, files, *more)) or read[-1]
        assert names(profiles.update(spark, str(folder), store)) == ["c.csv"]
    finally:
        profiles.file_counts = real
    assert names(read[0].inputFiles()) == ["c.csv"] and same()
    (folder / "b.csv").write_text("h ,id,x\n7,4,1\n")
    os.utime(folder / "b.csv", (2e9, 2e9))
    (folder / "a 1.csv").unlink()
    assert names(profiles.update(spark, str(folder), store)) == ["b.csv"] and same()


def test_a_state_that_was_not_finished_does_not_count(spark, tmp_path):
    folder, store = sheet(tmp_path), tmp_path / "store"
    profiles.update(spark, str(folder), str(store))
    before = values(profiles.kept_quality(spark, str(store)))
    broken = store / "00000009-x"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"cut off")
    assert values(profiles.kept_quality(spark, str(store))) == before
    assert profiles.update(spark, str(folder), str(store)) == []
    assert values(profiles.kept_quality(spark, str(store))) == before


def test_nothing_kept_and_empty_sheets(spark, tmp_path):
    assert profiles.kept_quality(spark, str(tmp_path / "none")).collect() == []
    (tmp_path / "e.csv").mkdir()
    (tmp_path / "e.csv" / "a.csv").write_text("id,h\n")
    profiles.update(spark, str(tmp_path / "e.csv"), str(tmp_path / "s"))
    assert profiles.kept_quality(spark, str(tmp_path / "s")).collect() == []
