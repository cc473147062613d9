import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions import maps, scalars
from tests.helpers import rows


def test_duration_seconds(spark):
    texts = [("01:02:03",), ("00:00:00.0000000",), ("23:59:59.9",), ("xx:02:03",), ("",), (None,)]
    frame = spark.createDataFrame(texts, "t string").select(scalars.duration_seconds("t"))
    assert rows(frame) == [(3723,), (0,), (86399,), (None,), (None,), (None,)]


def test_safe_convert(spark):
    frame = spark.createDataFrame([("12", "2024-02-29"), ("12.5", "2023-02-29"), ("", "29/02/2024"), (None, None)],
                                  "n string, d string")
    got = rows(frame.select(scalars.safe_convert("n", "bigint"), scalars.safe_convert("d", T.DateType())))
    assert got == [(12, datetime.date(2024, 2, 29)), (None, None), (None, None), (None, None)]
    dates = spark.createDataFrame([("2024-1-2",), ("2024",), ("2024-01-02T00:00",), ("0000-01-01",), ("2024-13-45",)], "d string")
    assert rows(dates.select(scalars.safe_convert("d", "date"))) == [(datetime.date(2024, 1, 2),)] + [(None,)] * 4
    other = frame.select(scalars.safe_convert("d", "date", "dd/MM/yyyy"))
    assert rows(other)[2] == (datetime.date(2024, 2, 29),)


def test_scaled_text_matches_printf(spark):
    numbers = [6.55, 0.125, 0.375, -0.04, 2.675, 1234567.891, 0.0, 1e15, -7.5]
    frame = spark.createDataFrame([(x,) for x in numbers], "v double")
    for scale in (0, 1, 2):
        got = [r[0] for r in rows(frame.select(scalars.scaled_text("v", scale)))]
        assert got == [f"{x:.{scale}f}" for x in numbers]


def test_scaled_text_odd_input(spark):
    frame = spark.createDataFrame([("abc",), (None,), ("1.25",), ("NaN",), ("-Infinity",)], "v string")
    assert [r[0] for r in rows(frame.select(scalars.scaled_text("v", 1)))] == ["", "", "1.2", "nan", "-inf"]


def test_text_or_empty(spark):
    frame = spark.createDataFrame([(datetime.date(2024, 1, 2), 5), (None, None)], "d date, n int")
    got = rows(frame.select(scalars.text_or_empty("d", T.DateType()), scalars.text_or_empty("n"),
                            scalars.text_or_empty("d", T.DateType(), "dd.MM.yy")))
    assert got == [("2024-01-02", "5", "02.01.24"), ("", "", "")]


def test_defaults_and_ratio(spark):
    frame = spark.createDataFrame([(1, 4), (1, 0), (None, 4)], "a int, b int")
    assert rows(frame.select(scalars.ratio("a", "b"))) == [(0.25,), (None,), (None,)]
    assert rows(frame.select(scalars.or_default(scalars.ratio("a", "b"), -1.0))) == [(0.25,), (-1.0,), (-1.0,)]


def test_array_ends_and_size(spark):
    frame = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "a array<int>")
    got = rows(frame.select(scalars.first_item("a"), scalars.last_item("a"), scalars.item_count("a")))
    assert got == [(1, 3, 3), (None, None, 0), (None, None, 0)]


def test_map_pairs_round_trip(spark):
    frame = spark.createDataFrame([({"b": 2, "a": 1},), ({},)], "m map<string,int>")
    pairs = frame.select(maps.map_pairs("m").alias("p"))
    assert [[tuple(e) for e in r[0]] for r in rows(pairs)] == [[("a", 1), ("b", 2)], []]
    assert rows(pairs.select(maps.pairs_map("p"))) == [({"a": 1, "b": 2},), ({},)]
    assert rows(frame.select(maps.map_value("m", "a"), maps.map_value("m", "z"))) == [(1, None), (None, None)]


def test_row_map(spark):
    frame = spark.createDataFrame([("x", 1)], "name string, n int")
    assert rows(frame.select(maps.row_map(["name", "n"]))) == [({"name": "x", "n": "1"},)]
    assert rows(frame.select(F.col("name"))) == [("x",)]
