"""Documents of one id and one position: one of them is kept, always the same."""

from lexcorpus.plans.build import merge_parts


def test_documents_of_one_position_are_kept_once(spark, tmp_path):
    columns = "ord long, document_id string, full_text string, download_url string, content_path string"
    rows = [(5, "a", f"text {i % 3}", "u", None) for i in range(9)] + [(4, "b", "x", "u", "p")] * 2 + [(5, None, "n", None, None)]
    kept = []
    for parts in (1, 4):
        path = str(tmp_path / str(parts))
        spark.createDataFrame(rows, columns).repartition(parts).write.parquet(path)
        late = str(tmp_path / f"late{parts}")
        spark.createDataFrame([(0, "a", "late", "u", None), (0, "c", "late", "u", None)], columns).write.parquet(late)
        got = merge_parts({"EU": spark.read.parquet(path), "UK": spark.read.parquet(late)}).collect()
        kept.append(sorted((r["document_id"] or "", r["part_ord"], r["full_text"]) for r in got))
        assert [k[:2] for k in kept[-1]] == [("", 0), ("a", 0), ("b", 0), ("c", 1)]
    assert kept[0] == kept[1]
