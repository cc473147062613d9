import pytest

from sparkloom.bindings.star_queries import QUERIES
from sparkloom.plans import star
from tests.helpers import bag, plan, rows


@pytest.fixture(scope="module")
def parts(spark):
    facts = spark.createDataFrame(
        [(1, 10, 100, 60), (1, 11, 100, 40), (1, 12, 101, 30), (2, 10, 101, 20), (3, 10, 100, 500),
         (1, 99, 100, 7), (4, 13, 999, 0), (1, 10, 100, None)],
        "service_id int, class_id int, category_id int, duration bigint")
    identifiers = spark.createDataFrame([(1, 7, 1), (2, 8, 1), (3, 7, 0), (4, 9, 1)],
                                        "service_id int, channel_id int, primary_flag int")
    classes = spark.createDataFrame([(10, "COM ", "Ads"), (11, "NEW", "News"), (12, "PRC", "Promo"), (13, "DOC", "Docs")],
                                    "class_id int, class_code string, class_name string")
    categories = spark.createDataFrame([(100, "live"), (101, "taped")], "category_id int, category_name string")
    channels = spark.createDataFrame([(7, "seven"), (9, "nine")], "channel_id int, channel_name string")
    return facts, identifiers, classes, categories, channels


def log(parts, channels=False, categories=False):
    facts, identifiers, classes, cats, chans = parts
    return star.full_log(facts, identifiers, classes, cats if categories else None, chans if channels else None)


def test_duration_by_class(parts):
    assert bag(star.duration_by_class(log(parts))) == {
        ("COM ", "Ads", 80): 1, ("NEW", "News", 40): 1, ("PRC", "Promo", 30): 1, (None, None, 7): 1, ("DOC", "Docs", 0): 1}


def test_commercial_ratio(parts):
    shares = star.commercial_ratio(log(parts), ["COM"])
    assert rows(shares)[0] == ("COM ", "Ads", 80, 80, 1.0)
    assert bag(shares)[(None, None, 0, 7, 0.0)] == 1
    assert bag(shares)[("DOC", "Docs", 0, 0, None)] == 1
    assert ("DOC", "Docs", 0, 0, None) not in bag(star.known_ratios(shares))
    assert bag(star.filled_ratios(shares))[("DOC", "Docs", 0, 0, 0.0)] == 1


def test_channel_ratio_drops_unnamed_channels(parts):
    got = bag(star.channel_ratio(log(parts, channels=True), ["COM"]))
    assert got == {(7, "seven", 60, 137, 60 / 137): 1, (9, "nine", 0, 0, 0.0): 1}


def test_weight_of_partial_code(parts):
    got = bag(star.channel_ratio(log(parts, channels=True), ["COM"], ["PRC"]))
    assert got == {(7, "seven", 82.5, 137, 82.5 / 137): 1, (9, "nine", 0.0, 0, 0.0): 1}


def test_overlapping_lists_are_refused():
    with pytest.raises(ValueError):
        star.commercial_duration(star.COMMERCIAL_CODES, star.PARTIAL_CODES)


def test_listed_codes(parts):
    whole = bag(star.channel_ratio(log(parts, channels=True)))
    assert whole[(7, "seven", 90, 137, 90 / 137)] == 1
    weighted = bag(star.channel_ratio(log(parts, channels=True), star.FULL_WEIGHT_CODES, star.PARTIAL_CODES))
    assert weighted[(7, "seven", 82.5, 137, 82.5 / 137)] == 1


def test_histogram_counts_unknown_ratio_as_zero(parts):
    shares = star.commercial_share(log(parts, channels=True), ["channel_id", "channel_name"], ["COM"])
    assert rows(star.ratio_histogram(shares)) == [(0.0, 1), (0.4, 1)]


def test_unknown_category_is_kept(parts):
    got = bag(star.duration_by(log(parts, categories=True), "category_name"))
    assert got == {("live", 107): 1, ("taped", 50): 1, (None, 0): 1}


def test_small_tables_are_broadcast(spark, tables):
    shown = plan(QUERIES["star_duration_by_class"](spark, tables))
    assert shown.count("BroadcastHashJoin") >= 2 and "CartesianProduct" not in shown


def test_one_row_per_fact(spark, parts):
    """Whether or not lookups may be broadcast."""
    plain = bag(log(parts, categories=True, channels=True).drop("channel_id"))
    assert sum(plain.values()) == 6
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bag(log(parts, categories=True, channels=True).drop("channel_id")) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
