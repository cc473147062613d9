import datetime
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.messages import array_rows, delimited_fields, payload_text
from sparkloom.plans import events as ev
from tests.helpers import bag, rows

BOOK = T.StructType().add("isbn", "integer").add("shelf", "integer").add("title", "string")


def messages(spark):
    def event(op, before, after):
        return json.dumps({"schema": {}, "payload": {"before": before, "after": after, "source": {"db": "d"}, "op": op}})

    texts = [event("r", None, {"isbn": 1, "shelf": 9, "title": "é"}),
             event("u", {"isbn": 1, "shelf": 9}, {"isbn": 1, "shelf": 8, "title": "y"}),
             event("d", {"isbn": 1, "shelf": 8}, None), "not json"]
    return spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value binary")


def test_envelope(spark):
    changes = ev.change_rows(messages(spark), BOOK)
    assert changes.columns == ["before", "after", "source", "op"]
    assert bag(ev.changed_to(changes, "r")) == {("r", 1, 9, "é"): 1}
    assert bag(ev.changed_to(changes)) == {("r", 1, 9, "é"): 1, ("u", 1, 8, "y"): 1, ("d", None, None, None): 1,
                                           (None, None, None, None): 1}


def test_envelope_as_text(spark):
    parts = rows(ev.change_parts_text(messages(spark)))
    assert parts[2] == ('{"isbn":1,"shelf":8}', None, '{"db":"d"}', "d")
    assert parts[3] == (None, None, None, None)


def test_charset(spark):
    frame = spark.createDataFrame([(bytearray("é", "iso-8859-1"),)], "value binary")
    assert rows(frame.select(payload_text("value", "iso-8859-1"))) == [("é",)]


def test_delimited_messages(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("day", T.DateType())])
    frame = spark.createDataFrame([("1,x,2024-01-02",), ("two,y,never",), ("3,z",), ("",), (None,), ("4,,2024-01-01,5",)],
                                  "value string")
    expected = {(1, "x", datetime.date(2024, 1, 2)): 1, (None, "y", None): 1}
    assert bag(delimited_fields(frame, schema)) == expected
    piped = frame.select(F.replace("value", F.lit(","), F.lit("|")).alias("value"))
    assert bag(delimited_fields(piped, schema, delimiter="|")) == expected
    binary = frame.select(F.encode("value", "UTF-8").alias("value"))
    assert bag(delimited_fields(binary, schema)) == expected


def test_json_tour(spark):
    """A harbour's berths: the field is there, is null, is no number, is missing; and a text that is no JSON."""
    texts = ['{"berth": 12, "ship": "Möwe", "tide": 1.5}', '{"berth": null}', '{"berth": "quay"}', '{"ship": "Ida"}', "fog"]
    frame = spark.createDataFrame(list(enumerate(texts)), "no int, value string")
    got = {r.no: r for r in ev.json_tour(frame, "value", "berth", '{"ship": "x", "wide": [true]}', keep=("no",)).collect()}
    assert [got[k].via_map for k in range(5)] == ["12", None, "quay", None, None]
    assert [got[k].via_tuple for k in range(5)] == ["12", None, "quay", None, None]
    assert [got[k].via_path for k in range(5)] == ["12", None, "quay", None, None]
    assert [got[k].via_struct for k in range(5)] == [12, None, None, None, None]
    assert got[0].as_text == '{"berth":"12","ship":"Möwe","tide":"1.5"}' and got[4].as_text is None
    assert {r.sample_schema for r in got.values()} == {"STRUCT<ship: STRING, wide: ARRAY<BOOLEAN>>"}


def test_quotes(spark):
    text = '{"symbol":"A","date":"2024-01-02","open":1.0,"high":2.0,"low":0.5,"close":1.5,"volume":7}'
    frame = spark.createDataFrame([(text,)], "value string")
    assert rows(ev.quotes(frame)) == [("A", datetime.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 7)]


def test_columns_beside_the_message_stay(spark):
    frame = messages(spark).withColumn("offset", F.monotonically_increasing_id())
    changes = ev.change_rows(frame, BOOK, keep=("offset",))
    assert changes.columns == ["offset", "before", "after", "source", "op"]
    assert changes.select("offset").distinct().count() == 4
    assert ev.change_parts_text(frame, keep=("offset",)).columns == ["offset", "before", "after", "source", "op"]
    assert ev.quotes(frame, keep=("offset",)).columns[:2] == ["offset", "symbol"]
    schema = T.StructType.fromDDL("n int, t string")
    text = spark.createDataFrame([("k", "1,x"), ("m", "2")], "key string, value string")
    assert rows(delimited_fields(text, schema, keep=("key",))) == [("k", 1, "x")]


def test_one_row_per_entry_of_a_message(spark):
    texts = ['{"who":"a","d":{"list":[{"x":1,"y":"p"},{"x":2}]}}', '{"who":"b","d":{"list":[]}}', '{"who":"c"}', "bad"]
    frame = spark.createDataFrame([(k, bytearray(t, "utf-8")) for k, t in enumerate(texts)], "no int, value binary")
    got = array_rows(frame, "who string, d struct<list: array<struct<x: int, y: string>>>", "d.list", fields=("who",), keep=("no",))
    assert bag(got) == {(0, "a", 1, "p"): 1, (0, "a", 2, None): 1}
