import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom import workspace
from sparkloom.bindings.operation_queries import bucketed_totals
from sparkloom.operators import summaries
from sparkloom.plans import catalog
from sparkloom.sinks.files import write_bucketed
from sparkloom.sources import quarantine
from sparkloom.sources.files import read_lines, read_table, stream_lines
from sparkloom.streaming.progress import run_until_idle
from tests.helpers import bag, plan, rows

REPO = Path(__file__).resolve().parent.parent


def test_bad_json_lines_are_kept(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', "", "{", '{"a": "no"}', "[1]", "7", '{"b": null}', "null", '{"a": 2, "extra": 1}']
    (tmp_path / "f.json").write_text("\n".join(lines) + "\n")
    typed = quarantine.json_lines(read_lines(spark, str(tmp_path)), "a int, b string")
    good, bad = quarantine.good_rows(typed), quarantine.bad_rows(typed).orderBy("place").collect()
    assert bag(good) == {(1, "x"): 1, (None, None): 1, (2, None): 1}
    assert [r.raw for r in bad] == ["", "{", '{"a": "no"}', "[1]", "7", "null"]
    assert [r.place for r in bad] == [1, 2, 3, 4, 5, 7] and all(r.file.endswith("f.json") and r.start == 0 for r in bad)


def test_bad_delimited_lines_are_kept(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1,"a,b"\n2\n3,c,d\nx,e\n4,\\N\n')
    typed = quarantine.delimited_lines(read_lines(spark, str(tmp_path)), "n int, t string")
    assert bag(quarantine.good_rows(typed)) == {(1, "a,b"): 1, (4, None): 1}
    assert [r.raw for r in quarantine.bad_rows(typed).orderBy("place").collect()] == ["2", "3,c,d", "x,e"]


def test_replayed_batch_stores_nothing_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f").write_text('{"a": 1}\nbad\n')
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    quarantine.store_stream(stream_lines(spark, str(tmp_path / "in")), lambda lines: quarantine.json_lines(lines, "a int"),
                            good, bad, str(tmp_path / "cp"))
    quarantine.store(quarantine.json_lines(read_lines(spark, str(tmp_path / "in")), "a int"), good, bad, 0)
    assert spark.read.parquet(good).count() == 1 and spark.read.parquet(bad).count() == 1


def test_bucketed_join_moves_nothing(spark, tables, tmp_path):
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        write_bucketed(spark.read.parquet(f"{tables}/{name}.parquet"), f"b_{name}", key, 4, str(tmp_path / name))
    totals = bucketed_totals(read_table(spark, "b_lineitem"), read_table(spark, "b_orders"))
    text = totals._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange hashpartitioning(o_orderkey" not in text
    assert "Exchange hashpartitioning(l_orderkey" not in text
    above = plan(totals).split("== Physical Plan ==")[1].split("SortMergeJoin")
    assert "Exchange" not in above[1]
    assert totals.count() == spark.read.parquet(f"{tables}/lineitem.parquet").select("l_orderkey").distinct().count()
    for name in ("b_lineitem", "b_orders"):
        spark.sql(f"DROP TABLE {name}")


def test_interval_run_stops_by_itself(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.txt").write_text("line\n" * (k + 1))

    def writer():
        return (stream_lines(spark, str(tmp_path / "in"), 1).writeStream.format("parquet").outputMode("append")
                .option("path", str(tmp_path / "out")))

    log = run_until_idle(spark, writer(), str(tmp_path / "cp"), "50 milliseconds").collect()
    assert sorted(r.input_rows for r in log) == [1, 2, 3] and all(r.milliseconds > 0 for r in log)
    assert [r.batch_id for r in log] == [0, 1, 2] and not spark.streams.active
    (tmp_path / "in" / "4.txt").write_text("more\n")
    assert [r.input_rows for r in run_until_idle(spark, writer(), str(tmp_path / "cp"), "50 milliseconds").collect()] == [1]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_failing_interval_run_raises(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f").write_text("x\n")

    def fail(batch, number):
        raise RuntimeError("no")

    with pytest.raises(Exception, match="no"):
        run_until_idle(spark, stream_lines(spark, str(tmp_path / "in")).writeStream.foreachBatch(fail),
                       str(tmp_path / "cp"), "50 milliseconds", timeout=60)


def test_schemas_widen():
    def merged(*texts):
        return catalog.merged_schema([T.StructType.fromDDL(t).json() for t in texts]).simpleString()

    assert merged("a int", "a bigint, b string", "c date") == "struct<a:bigint,b:string,c:date>"
    assert merged("a int", "a double") == "struct<a:double>" and merged("a float", "a double") == "struct<a:double>"
    assert merged("a bigint", "a decimal(10,2)") == "struct<a:decimal(21,2)>"
    assert merged("a decimal(5,1)", "a decimal(4,3)") == "struct<a:decimal(7,3)>"
    assert merged("a array<struct<x: int>>", "a array<struct<x: bigint, y: string>>") == (
        "struct<a:array<struct<x:bigint,y:string>>>")
    assert merged("m map<string, int>", "m map<string, bigint>") == "struct<m:map<string,bigint>>"
    one, two = (T.StructType([T.StructField("a", T.IntegerType(), nullable)]) for nullable in (False, True))
    assert catalog.wider_schema(one, two)["a"].nullable and not catalog.wider_schema(one, one)["a"].nullable
    for texts in (("a int", "a string"), ("a bigint", "a double"), ("s struct<x: date>", "s struct<x: boolean>"),
                  ("a decimal(38,0)", "a decimal(10,5)")):
        with pytest.raises(ValueError, match="common type"):
            merged(*texts)


def test_versions_are_read_as_the_widest(spark, tmp_path):
    frames = [spark.createDataFrame([(1, [(5,)])], "a int, s array<struct<x: int>>"),
              spark.createDataFrame([("t", 2**40, [(6, "y"), None])], "b string, a bigint, s array<struct<x: bigint, y: string>>")]
    stored = []
    for k, frame in enumerate(frames):
        frame.write.parquet(str(tmp_path / str(k)))
        stored.append((str(tmp_path / str(k)), frame.schema.json()))
    got = catalog.read_versions(spark, stored)
    assert got.schema.simpleString() == "struct<a:bigint,s:array<struct<x:bigint,y:string>>,b:string>"
    assert sorted(map(str, rows(got))) == sorted(map(str, [(1, [T.Row(x=5, y=None)], None),
                                                           (2**40, [T.Row(x=6, y="y"), None], "t")]))


def test_quantiles_keep_all_digits(spark):
    whole = [2**53, 2**53 + 1, 2**53 + 1, 2**53 + 3, None]
    frame = spark.createDataFrame([(v, None if v is None else f"{v}123456789012.25", 0.5 if v else None) for v in whole],
                                  "big long, text string, f double")
    frame = frame.select("big", F.col("text").cast("decimal(30,2)").alias("exact"), "f", F.lit(7).alias("small"))
    got = {r["column"]: r for r in summaries.profile_quantiles(frame, as_text=True).collect()}
    assert tuple(got["big"])[1:] == tuple(str(2**53 + k) for k in (0, 0, 1, 1, 3))
    assert got["exact"]["p50"] == f"{2**53 + 1}123456789012.25" and got["exact"]["max"] == f"{2**53 + 3}123456789012.25"
    assert got["f"]["min"] == "0.5" and got["small"]["p75"] == "7"
    assert {r["column"]: r["p25"] for r in summaries.profile_quantiles(frame, ["f", "small"]).collect()} == {
        "f": 0.5, "small": 7.0}


def test_sketch_profile(spark):
    frame = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("t"), F.lit(None).cast("double").alias("n"))
    got = {r["column"]: r for r in summaries.profile_sketch(frame, accuracy=500).collect()}
    assert abs(int(got["id"]["p50"]) - 2500) <= 11 and got["id"]["max"] == "4999" and got["id"]["mean"] == 2499.5
    assert got["t"]["min"] == "0" and got["t"]["p50"] is None and got["t"]["count"] == 5000
    assert got["n"]["count"] == 0 and got["n"]["p25"] is None
    assert plan(summaries.profile_sketch(frame)).split("== Physical Plan ==")[1].count("Range") == 1


def test_folder_of_a_block_goes(spark):
    with workspace.passing(spark.range(3), "block") as held:
        assert held.count() == 3
        folder = Path(held.inputFiles()[0].removeprefix("file://")).parent
    assert not folder.exists()
    with pytest.raises(RuntimeError):
        with workspace.passing(spark.range(3), "block") as held:
            folder = Path(held.inputFiles()[0].removeprefix("file://")).parent
            raise RuntimeError
    assert not folder.exists()


@pytest.mark.skipif(os.environ.get("SPARKLOOM_COPY") == "1", reason="this is the copy")
def test_text_operators_can_be_left_out(tmp_path):
    """Without the two `llm` folders, and with and without the pipeline, everything else is still registered."""
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.parquet"))
    code = ("import __spark_entry__ as e; from sparkloom.bindings import QUERIES as q; "
            "assert set(e.queries()) == set(q) and set(e.oracle_sql()) == set(q), 'keys'")
    for gone in ("none", "corpus_pipeline.py"):
        (copy / gone).unlink(missing_ok=True)
        subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": ""})
