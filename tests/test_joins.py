import pytest
from pyspark.sql import functions as F

from sparkloom.operators import joins
from tests.helpers import bag, plan, rows


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the facts share key 5, some keys are null and some have no lookup row."""
    key = (F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 11 == 0, None)
           .otherwise(F.col("id") % 400).cast("bigint"))
    facts = spark.range(6000).select(key.alias("k"), F.col("id").alias("v"))
    lookup = spark.range(300).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    return facts, lookup


KINDS = ["inner", "left", "left_semi", "left_anti"]


@pytest.mark.parametrize("how", KINDS)
def test_spread_join_equals_plain_join(sides, how):
    facts, lookup = sides
    spread = joins.lookup_join(facts, lookup, "k", how, joins.hot_keys(facts, "k"))
    assert "_spread" in plan(spread)
    assert bag(spread) == bag(facts.join(lookup, "k", how))


@pytest.mark.parametrize("form", [joins.lookup_join, joins.join_on_reference, joins.join_on_alias])
@pytest.mark.parametrize("how", [*KINDS, "right", "full"])
def test_every_form_and_kind(sides, form, how):
    facts, lookup = sides
    keys = ("k",) if form is joins.lookup_join else ("k", "k")
    hot = joins.hot_keys(facts, "k")
    plain = form(facts, lookup, *keys, how)
    assert plain.count() == facts.join(lookup, facts["k"] == lookup["k"], how).count()
    if how in KINDS:
        spread = form(facts, lookup, *keys, how, hot)
        assert spread.columns == plain.columns and bag(spread) == bag(plain)
    else:
        with pytest.raises(ValueError):
            form(facts, lookup, *keys, how, hot)


def test_repeated_lookup_rows(spark):
    facts = spark.createDataFrame([(1, k) for k in range(40)] + [(2, 99)], "k int, v int")
    lookup = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k int, n string")
    hot = joins.hot_keys(facts, "k")
    for how in KINDS:
        assert bag(joins.lookup_join(facts, lookup, "k", how, hot)) == bag(facts.join(lookup, "k", how))


def test_spread_join_on_two_keys(spark):
    facts = spark.createDataFrame([("a", 1, i) for i in range(50)] + [("b", None, 1), (None, 2, 1), ("c", 3, 1)],
                                  "x string, y int, v int")
    lookup = spark.createDataFrame([("a", 1, "p"), ("c", 3, "q"), ("b", 2, "r"), (None, 2, "s")],
                                   "x string, y bigint, n string")
    hot = joins.hot_keys(facts, ["x", "y"])
    assert hot.count() == 1
    assert bag(joins.lookup_join(facts, lookup, ["x", "y"], "left", hot)) == bag(facts.join(lookup, ["x", "y"], "left"))


def test_hot_key_is_scattered(sides):
    facts, lookup = sides
    left, right = joins.spread_sides(facts, lookup, ["k"], ["k"], joins.hot_keys(facts, "k"), salts=16)
    slots = left.where("k = 5").groupBy("_spread").count()
    assert slots.count() == 16 and slots.agg(F.max("count")).first()[0] < 400
    assert right.where("k = 5").count() == 16
    assert left.where("k IS NULL").select("_spread").distinct().count() == 16


def test_three_hundred_hot_keys(spark):
    """Each of 300 keys has more than a partition's share of the rows, next to 3,000 rare ones."""
    hot = spark.range(300 * 40).select((F.col("id") % 300).alias("k"), "id")
    facts = hot.union(spark.range(3000).select((F.col("id") + 1000).alias("k"), "id"))
    found = joins.hot_keys(facts, "k", partitions=400)
    names = facts.select("k", F.xxhash64(F.col("k").cast("string")).alias("_hot")).distinct().join(found, "_hot")
    assert {r.k for r in names.collect()} == set(range(300))
    lookup = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    assert bag(joins.lookup_join(facts, lookup, "k", "left", found)) == bag(facts.join(lookup, "k", "left"))


def test_hot_keys_of_even_or_empty_tables(spark):
    assert joins.hot_keys(spark.range(5000).withColumnRenamed("id", "k"), "k", partitions=10).count() == 0
    assert joins.hot_keys(spark.createDataFrame([], "k string"), "k").count() == 0
    assert joins.hot_keys(spark.createDataFrame([(None,)] * 9, "k string"), "k").count() == 0


def test_anti_join_forms_agree(spark):
    left = spark.createDataFrame([("red",), ("blue",), ("green",), ("grey",), ("grey",)], "colour string")
    right = spark.createDataFrame([("red",), ("green",), ("green",), ("pink",)], "colour string")
    expected = {("blue",): 1, ("grey",): 1}
    assert bag(joins.keys_without_match(left, right, "colour")) == expected
    assert bag(joins.keys_without_match_by_null(left, right, "colour")) == expected


def test_no_cross_product(sides):
    facts, _ = sides
    for how in ("inner", "left", "left_anti"):
        text = plan(joins.lookup_join(*sides, "k", how, joins.hot_keys(facts, "k")))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_rows_of_spread_join_survive_nulls(sides):
    facts, lookup = sides
    spread = joins.lookup_join(facts, lookup, "k", "left", joins.hot_keys(facts, "k"))
    assert rows(spread.where("k IS NULL").agg(F.count("*"))) == rows(facts.where("k IS NULL").agg(F.count("*")))
