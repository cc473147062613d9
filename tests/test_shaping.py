import pytest
from pyspark.sql import functions as F

from sparkloom.operators import setops, shaping, summaries
from tests.helpers import bag, plan, rows


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame([(1, "a", "9", "x")], "LogID int, Name string, smart_1_raw string, smart_2_raw string")


def test_tidy(logs):
    assert shaping.tidy(logs).columns == ["logid", "name", "smart_1_raw", "smart_2_raw"]
    assert shaping.tidy(logs, "id").columns == ["name", "smart_1_raw", "smart_2_raw"]


def test_pattern_selection(logs):
    assert shaping.keep_matching(logs, "smart.*").columns == ["smart_1_raw", "smart_2_raw"]
    assert shaping.drop_matching(logs, ".*ID").columns == ["Name", "smart_1_raw", "smart_2_raw"]


def test_cast_by_prefix(logs):
    cast = shaping.cast_by_prefix(logs, "smart", "bigint")
    assert rows(cast) == [(1, "a", 9, None)]
    assert dict(shaping.schema_rows(cast))["smart_1_raw"] == "bigint"


def test_dotted_names(spark):
    frame = spark.createDataFrame([(1, 2)], "`b.x` int, a int")
    assert shaping.sort_columns(frame).columns == ["a", "b.x"]
    assert shaping.drop_matching(frame, "a").columns == ["b.x"]


@pytest.mark.parametrize("names,sizes", [(8, [4, 4]), (10, [4, 3, 3]), (2, [2]), (3, [3]), (7, [4, 3]), (0, [0])])
def test_column_chunks(names, sizes):
    columns = [f"c{i}" for i in range(names)]
    chunks = shaping.column_chunks(columns)
    assert [len(c) for c in chunks] == sizes and sum(chunks, []) == columns


def test_split_wide(logs):
    assert [f.columns for f in shaping.split_wide(logs, 2)] == [["LogID", "Name"], ["smart_1_raw", "smart_2_raw"]]


def test_union_on_common_columns(spark):
    a = spark.createDataFrame([(1, "x", 0.5)], "id int, name string, extra double")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "name string, id int")
    merged = setops.union_common_columns([a, b], ("id",))
    assert merged.columns == ["id", "name"] and bag(merged) == {(1, "x"): 1, (2, "y"): 2}
    with pytest.raises(ValueError, match="extra"):
        setops.union_common_columns([a, b], ("extra",))
    assert bag(setops.union_distinct(merged, merged)) == {(1, "x"): 1, (2, "y"): 1}


def test_profile(spark):
    frame = spark.createDataFrame([(1, "b", None), (3, "a", 2.0), (None, None, 4.0)], "n int, t string, d double")
    got = {r.column: tuple(r)[1:] for r in summaries.profile_basic(frame).collect()}
    assert got["n"] == (2, 2.0, pytest.approx(2 ** 0.5), "1", "3")
    assert got["t"] == (2, None, None, "a", "b")
    assert got["d"][0] == 2
    assert [r.column for r in summaries.profile_basic(frame, ["t"]).collect()] == ["t"]


def test_quantiles(spark):
    frame = spark.range(1, 1001).select(F.col("id").alias("v"), F.lit("x").alias("t"))
    got = rows(summaries.profile_quantiles(frame, fractions=(0.1, 0.5, 0.9)))
    assert got == [("v", 1.0, 100.0, 500.0, 900.0, 1000.0)]


def test_quantiles_are_exact(spark):
    frame = spark.range(20_011).select(
        (F.col("id") * 7919 % 20_011).alias("even"), F.when(F.col("id") % 3 == 0, 5.5).otherwise(F.col("id") / 8).alias("hot"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"), F.lit(None).cast("int").alias("none"))
    fractions = (0.01, 0.25, 0.5, 0.999, 1.0)
    got = {r.column: tuple(r)[1:] for r in summaries.profile_quantiles(frame, fractions=fractions).collect()}
    for name in ("even", "hot", "half"):
        values = sorted(float(r[0]) for r in frame.select(name).collect() if r[0] is not None)
        want = [values[max(0, -(-int(f * 1000) * len(values) // 1000) - 1)] for f in fractions]
        assert got[name] == (values[0], *want, values[-1])
    assert got["none"] == (None,) * 7


def test_profiles_of_dates_only(spark):
    frame = spark.sql("SELECT date'2024-01-02' AS d")
    assert rows(summaries.profile_basic(frame)) == [] and rows(summaries.profile_quantiles(frame)) == []


def test_summary_of_all_columns(spark):
    frame = spark.createDataFrame([(1, "b"), (3, "a"), (None, None)], "n int, t string")
    got = {r.column: r for r in summaries.profile_summary(frame).collect()}
    assert (got["n"]["count"], got["n"].p50, got["t"]["min"], got["t"].p50) == (2, 1.0, "a", None)


def test_profile_reads_each_column_once(spark, tables):
    shown = plan(summaries.profile_basic(spark.read.parquet(f"{tables}/lineitem.parquet"), ["l_quantity", "l_returnflag"]))
    assert "ReadSchema: struct<l_quantity:double>" in shown and "ReadSchema: struct<l_returnflag:string>" in shown


def test_histogram_and_mode(spark):
    frame = spark.createDataFrame([("a", 0.14), ("a", 0.15), ("b", None), ("b", 0.04)], "k string, r double")
    assert bag(summaries.rounded_histogram(frame, "r")) == {(0.0, 2): 1, (0.1, 1): 1, (0.2, 1): 1}
    values = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3), ("b", 4)], "k string, v int")
    assert bag(summaries.modal_values(values, "k", "v")) == {("a", 1): 1, ("b", 3): 1, ("b", 4): 1}


def test_null_safe_summary(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, 7), ("a", 4, None), ("b", 1, None)],
                                  "g string, t int, v int")
    got = {r.g: tuple(r)[1:] for r in summaries.null_safe_summary(frame, "g", "v", "t").collect()}
    assert got == {"a": (12, 6.0, 2, 5, 7, 5, 7), "b": (None, None, 0, None, None, None, None)}


def test_mode_without_broadcast(spark):
    values = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3), ("b", 4)], "k string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bag(summaries.modal_values(values, "k", "v")) == {("a", 1): 1, ("b", 3): 1, ("b", 4): 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
