"""A retrieval log in buckets: added to, merged, read."""

import glob
import os

import pytest

from lexcorpus.streaming import ingest

SCHEMA = "ord long, celex_full string, lang string, text string, timestamp string"


def add(spark, folder, number, rows):
    ingest.add_to_log(spark.createDataFrame(rows, SCHEMA), folder, number)


def newest(spark, folder):
    return sorted((r["celex_full"] or "", r["text"]) for r in ingest.newest_log(spark, folder).collect())


def files(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/bucket=*/**/*.parquet", recursive=True)}


def test_log_is_the_same_before_and_after_merging(spark, tmp_path):
    folder = str(tmp_path / "log")
    add(spark, folder, 0, [(1, "A", "en", "a0", None), (2, "B", "en", "b0", None), (3, None, None, "none", None)])
    for n in range(1, 4):
        add(spark, folder, n, [(1, "A", "en", f"a{n}-", None), (2, "A", "en", f"a{n}", None)])
    before, old = files(folder), newest(spark, folder)
    assert old == [("", "none"), ("A", "a3"), ("B", "b0")]
    assert ingest.compact_log(spark, folder, most=2) == 1
    assert newest(spark, folder) == old
    # parts of other buckets, and those a reader may still hold, stay as they are
    assert all(files(folder)[f] == t for f, t in before.items())
    with pytest.raises(ValueError, match="merged"):
        ingest.newest_log(spark, folder, 1)
    add(spark, folder, 3, [(1, "A", "en", "a3-", None), (2, "A", "en", "a3", None)])  # the batch runs again
    assert newest(spark, folder) == old
    add(spark, folder, 4, [(1, "A", "en", "a4", None), (1, "C", "en", "c4", None)])
    assert ingest.compact_log(spark, folder, most=2) == 0  # nothing due; what was merged before is deleted
    kinds = [f for f in files(folder) if "kind=batch" in f and "part_ord=1/" in f]
    assert not kinds
    assert ("A", "a4") in newest(spark, folder) and ("C", "c4") in newest(spark, folder)


def test_merging_twice_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "log")
    for n in range(5):
        add(spark, folder, n, [(i, f"D{i % 7}", "en", f"{n}-{i}", None) for i in range(20)])
    old = newest(spark, folder)
    assert ingest.compact_log(spark, folder, most=1) == ingest.compact_log(spark, folder, most=0) > 0
    assert newest(spark, folder) == old and len(old) == 7
