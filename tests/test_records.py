import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkloom.bindings import QUERIES, inputs, storage_queries
from sparkloom.functions.inference import infer_json
from sparkloom.functions.messages import json_schema, parse_json_strings
from sparkloom.sinks.files import write_delimited
from sparkloom.sources import records
from sparkloom.sources.files import read_delimited, read_json
from tests.helpers import bag, rows


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes, so that records cross their borders."""
    names = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


SCHEMA = "id int, text string, mark string"


def hard_rows(count=200):
    draw = random.Random(8)
    parts = ["plain", "two\nlines", 'a "quote"', "\n", ",", "", '"', "\r\nx", "é" * 40, "a\n\n\nb", '"\n"', None]
    out = [(k, draw.choice(parts), draw.choice(parts)) for k in range(count)]
    return [*out, (count, "long\n" * 400 + '"', "after"), (count + 1, "last", "end")]


def test_split_csv_equals_one_task(spark, tmp_path, small_ranges):
    path = str(tmp_path / "csv")
    frame = spark.createDataFrame(hard_rows(), SCHEMA)
    write_delimited(frame, path, files=2)
    split = records.read_delimited_split(spark, path, SCHEMA)
    assert bag(split) == bag(read_delimited(spark, path, SCHEMA, multi_line=True)) == bag(frame)
    ranges = records._lines(spark, path).select("file", "start").distinct()
    assert ranges.count() > 20 and split.rdd.getNumPartitions() > 20
    placed = records.read_delimited_split(spark, path, SCHEMA, keep_place=True)
    one = spark.createDataFrame(hard_rows(), SCHEMA).coalesce(1)
    write_delimited(one, str(tmp_path / "one"))
    placed = records.read_delimited_split(spark, str(tmp_path / "one"), SCHEMA, keep_place=True)
    assert [r.id for r in placed.orderBy("file", "start", "number").collect()] == [r[0] for r in hard_rows()]


def test_split_csv_deals_a_larger_table_over_more_files(spark, tmp_path, monkeypatch):
    texts = [(k, "web", "en", f"{random.Random(k).random()}\n{k}" * 9) for k in range(600)]
    frame = spark.createDataFrame(texts, "doc_id long, source string, lang string, text string")
    frame.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    held = sum(file.stat().st_size for file in tmp_path.glob("documents.parquet/part-*"))
    monkeypatch.setattr(inputs, "FILE_BYTES", held // 21, raising=False)  # files of a seventh of the table each
    made, write = [], storage_queries.sink.write_delimited
    monkeypatch.setattr(storage_queries.sink, "write_delimited",
                        lambda frame, path, **options: (made.append(path), write(frame, path, **options)))
    found = QUERIES["csv_split_hard"](spark, str(tmp_path))
    assert bag(found) == Counter((k, 'web, "en"', text) for k, _, _, text in texts)
    assert len(list(Path(made[0]).glob("part-*"))) == 8


def test_split_csv_with_other_marks(spark, tmp_path, small_ranges):
    path = str(tmp_path / "csv")
    frame = spark.createDataFrame([(k, f"a$b\n{k}|{k}", None if k % 3 else "") for k in range(100)], SCHEMA)
    write_delimited(frame, path, sep="|", quote="$", header=False)
    assert bag(records.read_delimited_split(spark, path, SCHEMA, sep="|", quote="$", header=False)) == bag(frame)


def test_split_csv_with_carriage_returns(spark, tmp_path, small_ranges):
    text = 'id,text,mark\r\n' + "".join(f'{k},"a\r\nb{k}",z\r\n' for k in range(80)) + '\r\n80,c,"d"'
    (tmp_path / "f.csv").write_bytes(text.encode())
    got = bag(records.read_delimited_split(spark, str(tmp_path / "f.csv"), SCHEMA))
    assert got == {**{(k, f"a\r\nb{k}", "z"): 1 for k in range(80)}, (80, "c", "d"): 1}


def test_split_csv_without_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,text,mark\n")
    (tmp_path / "g.csv").write_text("")
    assert rows(records.read_delimited_split(spark, [str(tmp_path / "f.csv"), str(tmp_path / "g.csv")], SCHEMA)) == []


DOCUMENT = "id int, text string, inner struct<a: array<int>>"


def documents(count=120):
    draw = random.Random(2)
    return [{"id": k, "text": draw.choice(["x", '{"', "}]", 'a\\"b[', "[", "two\nlines"]),
             "inner": {"a": [1] * draw.randint(0, 4)}} for k in range(count)]


@pytest.mark.parametrize("layout", ["indented", "lines", "minified", "chained"])
def test_split_json_array_equals_one_task(spark, tmp_path, small_ranges, layout):
    whole = documents()
    text = {"indented": json.dumps(whole, indent=2), "minified": json.dumps(whole),
            "lines": "[" + ",\n".join(json.dumps(d) for d in whole) + "]\n",
            "chained": "[{\n" + "\n}, {\n".join(json.dumps(d, indent=1)[2:-2] for d in whole) + "\n}]"}[layout]
    assert json.loads(text) == whole
    (tmp_path / "f.json").write_text(text)
    got = records.read_documents_split(spark, str(tmp_path / "f.json"), DOCUMENT)
    want = read_json(spark, str(tmp_path / "f.json"), DOCUMENT, strict=True, whole_file=True)
    found, single = (sorted(map(str, rows(frame))) for frame in (got, want))
    assert found == single and len(found) == len(whole)
    stretches = records.document_records(spark, str(tmp_path / "f.json")).count()
    assert stretches == (len(whole) if layout in ("indented", "lines") else 1)


def test_split_json_of_other_files(spark, tmp_path):
    (tmp_path / "f.json").write_text("[]\n")
    (tmp_path / "g.json").write_text("\n[\n]\n")
    assert rows(records.read_documents_split(spark, str(tmp_path), DOCUMENT)) == []
    (tmp_path / "h.json").write_text('{\n  "id": 1,\n  "text": "no array"\n}\n')
    with pytest.raises(Exception, match="not an array"):
        records.read_documents_split(spark, str(tmp_path / "h.json"), DOCUMENT).collect()


# ---- inference

def test_many_keys_are_one_map(spark):
    strings = spark.range(3000).select(F.format_string('{"key%d": {"n": %d, "f": 1.5}}', "id", "id").alias("j"))
    schema = json_schema(strings, "j")
    assert schema.simpleString() == "map<string,struct<f:double,n:bigint>>"
    parsed = parse_json_strings(strings, "j")
    assert parsed.columns == ["entries"] and parsed.select(F.sum(F.size("entries"))).first()[0] == 3000
    nested = strings.select(F.concat(F.lit('{"id": 1, "by": '), "j", F.lit(', "list": [{"a": null}, {"a": true}]}')).alias("j"))
    assert json_schema(nested, "j").simpleString() == (
        "struct<by:map<string,struct<f:double,n:bigint>>,id:bigint,list:array<struct<a:boolean>>>")
    exact = strings.limit(500)
    assert len(json_schema(exact, "j").fields) == 500


def test_types_widen(spark):
    def kind(*values):
        return infer_json(spark.createDataFrame([(f'{{"v": {v}}}',) for v in values], "j string"), "j")["v"].dataType.simpleString()

    assert kind("1", "2.5") == "double" and kind("1", "null") == "bigint" and kind("null") == "string"
    assert kind("1", '"a"') == "string" and kind("true", "1") == "string" and kind("{}", "[]") == "string"
    assert kind("12345678901234567890", "1") == "decimal(20,0)"
    assert kind("[1, [2]]") == "array<string>" and kind("[]") == "array<string>"
    assert kind('{"a": 1}', "null", '{"b": "x"}') == "struct<a:bigint,b:string>"


def test_inference_without_objects(spark):
    for text in ("nothing", "[1]", "7"):
        with pytest.raises(ValueError):
            json_schema(spark.createDataFrame([(text,), (None,)], "j string"), "j")
    strings = spark.createDataFrame([('{"a.b": {"c d": 1}, "a": {"b": "x"}, "": 2}',)], "j string")
    assert json_schema(strings, "j").simpleString() == "struct<:bigint,a:struct<b:string>,a.b:struct<c d:bigint>>"
