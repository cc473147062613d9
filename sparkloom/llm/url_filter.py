"""URL filters as a sort-merge of pages with nested intervals of rules.

A rule is a host and a path prefix and fits the host and its subdomains. The canonical key of a rule is its host with
the labels reversed, a separator, and its path; all keys that begin with it are one interval of the sort order. A
page has one probe for each ending of its host (as many labels as any rule has, at most), with the same key: a rule
fits the page when its key begins one of the probes. Rules and probes are sorted together by ranges of (key, salt),
and each range is swept once with a stack of the rules whose interval is open; a rule that opens before a range and
is still open there is a prefix of the range's first key, and is found by a join on the prefixes of those keys.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.workspace import written

SEPARATOR = "\x01"  # below every character of a label that a rule may have


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def key_of(labels: Column, path: Column) -> Column:
    """Canonical key as bytes, which sort alike here and in Python; `labels` begin with the top-level one."""
    return F.concat(F.concat_ws(".", labels), F.lit(SEPARATOR), path).cast("binary")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[tuple[bytes, int, str, str]] = []  # open rules, each key a prefix of the next
    here = None
    for batch in batches:
        found: list[tuple[int, int, str, str]] = []
        for part, key, is_probe, row, weight, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
            if part != here:
                here = part
                stack.clear()
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_probe:
                stack.append((key, weight, rule, verdict))
            elif stack:
                best = max(stack, key=lambda open_rule: open_rule[1])
                found.append((row, best[1], best[2], best[3]))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                ["row", "weight", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of `pages`.

    `rules` has the string columns host, path and verdict; host and path must be given and not contain \\x01. Of the
    rules that fit, the one with the most characters (host and path together) wins; between equals the one with the
    longer host, then the smaller verdict. A page that no rule fits, also one without a host, gets a null rule and
    the `default` verdict. A null url has an empty host and path. Rules given twice count once. Runs two jobs at
    once, which write the parsed pages and the sorted ranges.
    """
    parsed = written(
        pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"))
        .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                F.monotonically_increasing_id().alias("row")), "pages")
    known = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
             .groupBy(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
             .select("host", "path", "verdict", F.reverse(F.split("host", r"\.")).alias("labels")))
    deepest = known.agg(F.max(F.size("labels"))).first()[0] or 0
    opening = known.select(
        key_of(F.col("labels"), F.col("path")).alias("key"), F.lit(False).alias("is_probe"),
        F.lit(-1).cast("long").alias("row"),
        (F.length("host") + F.length("path")).cast("long").alias("weight"),
        F.concat("host", "path").alias("rule"), "verdict")
    endings = parsed.select("row", "path", F.reverse(F.split("host", r"\.")).alias("labels")).select(
        "row", "path", "labels",
        F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(1, deepest))))).alias("depth")).select(
        "row", "path", F.slice("labels", F.lit(1), F.col("depth")).alias("labels"))
    probes = endings.where(~F.concat_ws(".", "labels").contains(SEPARATOR)).select(
        key_of(F.col("labels"), F.col("path")).alias("key"),
        F.lit(True).alias("is_probe"), "row", F.lit(None).cast("long").alias("weight"),
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    ranges = written(opening.unionByName(probes).repartitionByRange("key", "row")
                     .select(F.spark_partition_id().alias("part"), "*"), "ranges")
    first = ranges.where("is_probe").groupBy("part").agg(F.min("key").alias("key"))
    longest = opening.agg(F.max(F.octet_length("key"))).first()[0] or 0
    carried = (first.select("part", F.col("key").alias("probe"), F.explode(F.sequence(
        F.lit(1), F.least(F.octet_length("key"), F.lit(max(1, longest))))).alias("size"))
        .select("part", F.expr("substring(probe, 1, size)").alias("key")).join(opening, "key")
        .select("part", *opening.columns))
    # A rule that both opens in a range and is carried into it is on the stack twice, which changes nothing.
    swept = (ranges.unionByName(carried).repartition("part").sortWithinPartitions("part", "key", "is_probe", "row")
             .select("part", "key", "is_probe", "row", "weight", "rule", "verdict")
             .mapInArrow(_sweep, "row long, weight long, rule string, verdict string"))
    hosted = F.length(F.regexp_extract("rule", r"^[^/]*", 0))
    best = swept.groupBy("row").agg(F.max(F.struct(F.col("weight"), hosted.alias("hosted"), F.col("rule"),
                                                   F.col("verdict"))).alias("best"))
    return parsed.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
