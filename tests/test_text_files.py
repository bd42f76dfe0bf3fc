"""Files that are read whole do not grow with the table they are written from."""

from pathlib import Path

from lexcorpus.catalog import files, registry


def test_files_stay_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "new_path", lambda spark, name: str(tmp_path / name))
    sf = tmp_path / "sf"
    rows = 3 * files.FILE_TEXTS + 7
    spark.range(rows).selectExpr("concat('a', chr(10), id) AS text").coalesce(1).write.parquet(f"{sf}/documents.parquet")
    got = registry.QUERIES["text_files_read"](spark, str(sf)).first()
    assert got["lines"] == rows and got["characters"] == sum(2 + len(str(i)) for i in range(rows))
    sizes = [len(p.read_text().splitlines()) for p in Path(tmp_path / "texts").glob("*.txt")]
    assert sum(sizes) == rows and max(sizes) <= files.FILE_TEXTS
