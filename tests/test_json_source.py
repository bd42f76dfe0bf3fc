"""Records read in parts, and the place of what is no record."""

import gzip
import io
import json
import random

import pytest
from pyspark.sql import types as T

from lexcorpus.sources import json_source
from lexcorpus.sources.records import read_records

KIND = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("more", T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.BooleanType())])),
        T.StructField("odd", T.MapType(T.StringType(), T.LongType())),
    ]
)


def record(rng, i):
    text = "".join(rng.choices('ab "\\\n\té日😀{}[],:', k=rng.randint(0, 40)))
    row = {"id": i, "name": rng.choice([None, text, 7, [1, text], {"x": text}]), "tags": rng.choice([None, [], [text, None]])}
    row |= {"more": rng.choice([None, {"a": 1, "b": True}, {"a": 0.5}]), "odd": rng.choice([None, {}, {text: 3}]), "other": text}
    return {k: v for k, v in row.items() if rng.random() < 0.9 or k == "id"}


def expected(row):
    name = row.get("name")
    return json_source.shaped(row, KIND) | {
        "name": name if name is None or isinstance(name, str) else json.dumps(name, ensure_ascii=False, separators=(",", ":"))
    }


def plain(row):
    out = row.asDict(recursive=True)
    out["odd"] = None if out["odd"] is None else list(out["odd"].items())
    return out


@pytest.mark.parametrize("part", [1, 37, 1000, 1 << 26])
def test_lines_in_parts_of_any_size(spark, tmp_path, part):
    rng = random.Random(part)
    rows = [record(rng, i) for i in range(60)]
    text = "".join(rng.choice(["", "\n", " \t\r\n"]) + json.dumps(r, ensure_ascii=rng.random() < 0.5) + rng.choice(["\n", "\r\n"]) for r in rows)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_bytes(text.encode())
    (tmp_path / "in" / "_SUCCESS").write_text("no record")
    parts = json_source.RecordsReader(KIND, {"path": str(tmp_path / "in"), "partbytes": str(part)})
    got = [row for p in parts.partitions() for row, _ in parts._records(p)]
    assert got == [expected(r) for r in rows]
    spark.dataSource.register(json_source.Records)
    if part > 30:
        read = spark.read.format("lexcorpus_records").schema(KIND).option("partbytes", part).load(str(tmp_path / "in"))
        assert sorted(map(plain, read.collect()), key=lambda r: r["id"]) == [expected(r) for r in rows]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_lists_a_record_at_a_time(monkeypatch, chunk):
    monkeypatch.setattr(json_source, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = [record(rng, i) for i in range(20)]
    for text in (
        json.dumps(rows, indent=1),
        json.dumps({"about": {"records": [1]}, "records": rows, "end": [1.5e3, "x"]}, ensure_ascii=False),
        "﻿" + json.dumps(rows),
    ):
        found = json_source.listed(io.BytesIO(text.encode()), "f", KIND)
        assert [row for row, _ in found] == [expected(r) for r in rows]
    assert list(json_source.listed(io.BytesIO(b" [ ] \n"), "f", KIND)) == []
    assert list(json_source.listed(io.BytesIO(b'{"records": []}'), "f", KIND)) == []


@pytest.mark.parametrize(
    "text, line",
    [
        ('[{"id": 1},\n {"id": 2}\n {"id": 3}]', 3),
        ('[{"id": 1},\n\n 5]', 3),
        ('[{"id": 1},\n {"id": "x"}]', 2),
        ('[{"id": 1},\n {"id": tru}]', 2),
        ('[{"id": 1}\n', 2),
        ('[{"id": 1}]\n\n]', 3),
        ('{"rows": []}', 1),
        ('{"records": 3}', 1),
        ('{"records": [],\n}', 2),
        ("\n\n3", 3),
        ("", 1),
        ('[\n{"name": "open', 2),
    ],
)
@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_wrong_lists_name_their_line(monkeypatch, chunk, text, line):
    monkeypatch.setattr(json_source, "CHUNK", chunk)
    with pytest.raises(json_source.BadRecord, match=f"^some.json, line {line}: "):
        list(json_source.listed(io.BytesIO(text.encode()), "some.json", KIND))


def test_a_wrong_value_early_in_a_long_list_ends_the_read_there():
    text = b'[{"id": 1x},' + b'{"id": 2},' * 500_000
    stream = io.BytesIO(text)
    with pytest.raises(json_source.BadRecord, match="line 1"):
        list(json_source.listed(stream, "f", KIND))
    assert stream.tell() <= 2 * json_source.CHUNK


@pytest.mark.parametrize("bad", ['{"id": 3', "[1]", '"x"', '{"id": "3"}', '{"id": true}', '{"tags": "x"}', "\udcff"])
def test_a_wrong_line_fails_with_file_and_line(spark, tmp_path, bad):
    text = '{"id": 1}\n\n' * 50 + bad + '\n{"id": 4}\n'
    path = tmp_path / "bad.jsonl"
    path.write_bytes(text.encode("utf-8", "surrogateescape"))
    for part in (8, 1 << 20):
        reader = json_source.RecordsReader(KIND, {"path": str(path), "partbytes": str(part)})
        with pytest.raises(json_source.BadRecord, match="bad.jsonl, line 101: "):
            [row for p in reader.partitions() for row in reader._records(p)]


def test_failures_and_odd_files_through_spark(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\n\n{"id": 2\n')
    with pytest.raises(Exception, match=r"bad.jsonl, line 3: "):
        read_records(spark, str(tmp_path / "bad.jsonl"), schema=KIND).count()
    (tmp_path / "bad.json").write_text('{"records": [\n{"id": 1},\n{"id": 1.5}]}')
    with pytest.raises(Exception, match=r"bad.json, line 3: "):
        read_records(spark, f"file:{tmp_path}/bad.json", "json", KIND).count()
    (tmp_path / "packed.jsonl.gz").write_bytes(gzip.compress(b'{"id": 1}\n{"id": 2}\n'))
    assert read_records(spark, str(tmp_path / "packed.jsonl.gz"), schema=KIND).count() == 2
    (tmp_path / "none").mkdir()
    assert read_records(spark, str(tmp_path / "none"), schema=KIND).count() == 0
    (tmp_path / "empty.jsonl").write_text("")
    assert read_records(spark, str(tmp_path / "empty.jsonl"), schema=KIND).count() == 0
    with pytest.raises(Exception):
        read_records(spark, str(tmp_path / "absent.jsonl"), schema=KIND).count()
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path), "csv")


def test_schemes_without_a_file_system_go_to_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n')
    (tmp_path / "a.json").write_text('{"records": [{"id": 2}]}')

    def unknown(path):
        raise json_source.pa.ArrowInvalid("no such scheme")

    monkeypatch.setattr(json_source, "place", unknown)
    assert [r["id"] for r in read_records(spark, str(tmp_path / "a.jsonl"), schema=KIND).collect()] == [1]
    assert [r["id"] for r in read_records(spark, str(tmp_path / "a.json"), "json", KIND).collect()] == [2]
