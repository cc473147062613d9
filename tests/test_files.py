import datetime

import pytest
from pyspark.errors import AnalysisException

from sparkloom import workspace
from sparkloom.session import build_session
from sparkloom.sinks import files as sink
from sparkloom.sinks import relational as relational_sink
from sparkloom.sources import files as source
from sparkloom.sources import relational, topics
from tests.helpers import bag, rows

LOGS = "LogID|LogDate|Duration\n1|2018-08-01|00:00:30.0000000\n2|2018-08-02|01:00:00.0000000\n"


def test_pipe_file_with_schema(spark, tmp_path):
    (tmp_path / "logs.csv").write_text(LOGS)
    read = source.read_delimited(spark, str(tmp_path), "LogID int, LogDate date, Duration string", sep="|")
    assert rows(read)[0] == (1, datetime.date(2018, 8, 1), "00:00:30.0000000")


def test_inferred_and_untyped(spark, tmp_path):
    (tmp_path / "logs.csv").write_text(LOGS)
    inferred = source.read_delimited(spark, str(tmp_path), sep="|", infer=True, timestamp_format="yyyy-MM-dd")
    assert dict(inferred.dtypes)["LogID"] == "int"
    assert {t for _, t in source.read_delimited(spark, str(tmp_path), sep="|").dtypes} == {"string"}


def test_custom_quote(spark, tmp_path):
    (tmp_path / "tools.csv").write_text('tool,stock,weight\n$Hammer, small$,4,0.5\nSaw,2,1.75\n')
    read = source.read_delimited(spark, str(tmp_path), "tool string, stock int, weight double", quote="$")
    assert rows(read) == [("Hammer, small", 4, 0.5), ("Saw", 2, 1.75)]


@pytest.mark.parametrize("sep, quote", [(",", '"'), ("|", "$")])
def test_hard_values_are_read_back(spark, tmp_path, sep, quote):
    values = [("a\nb", 1), ("", 2), (None, 3), ('say "x", $5 | ok', 4), (" spaced ", None), ("back\\slash", 6), ("é\r\n", 7)]
    frame = spark.createDataFrame(values, "t string, n int")
    sink.write_delimited(frame, str(tmp_path / "out"), sep=sep, quote=quote)
    read = source.read_delimited(spark, str(tmp_path / "out"), frame.schema, sep=sep, quote=quote, multi_line=True)
    got = bag(read)
    assert {(t.strip().replace("\r\n", "\n") if t else t, n) for t, n in got} == {
        (t.strip().replace("\r\n", "\n") if t else t, n) for t, n in values}
    missing = source.read_delimited(spark, str(tmp_path / "out"), frame.schema, sep=sep, quote=quote, multi_line=True).where("t IS NULL")
    assert rows(missing) == [(None, 3)]


def test_missing_values_of_plain_files_are_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,\n,2\n")
    assert bag(source.read_delimited(spark, str(tmp_path / "x.csv"))) == {("1", None): 1, (None, "2"): 1}


def test_many_text_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text(f"{name} one\n{name} two\n")
    assert source.read_lines(spark, str(tmp_path / "*.txt")).count() == 4
    sets = source.read_delimited_sets(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")], sep=" ", header=False)
    assert [frame.count() for frame in sets] == [2, 2]


@pytest.mark.parametrize("write", [sink.write_delimited, sink.write_lines, sink.write_json, sink.write_parquet])
def test_existing_output_is_an_error_unless_overwritten(spark, tmp_path, write):
    frame, path = spark.createDataFrame([("x",), ("y",)], "value string"), str(tmp_path / "out")
    write(frame, path)
    with pytest.raises(AnalysisException):
        write(frame, path)
    write(frame, path, overwrite=True, files=1)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_partitioned_parquet_is_pruned(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "s string, v int")
    sink.write_parquet(frame, str(tmp_path / "out"), partition_by=["s"])
    read = source.read_parquet(spark, str(tmp_path / "out"))
    assert bag(read.select("s", "v")) == bag(frame)
    assert "PartitionFilters: [isnotnull(s" in read.where("s = 'a'")._jdf.queryExecution().toString()


def test_managed_table(spark):
    ships = spark.createDataFrame([(7, "Aurora", 120.5), (9, "Boreas", 98.0)], "code int, ship string, metres double")
    for _ in range(2):
        sink.write_table(ships, "ships")
    assert bag(source.read_table(spark, "ships")) == bag(ships)
    spark.sql("DROP TABLE ships")


def test_relational_options():
    connection = relational.Connection("jdbc:x://host/db", "a.Driver", "me", "word")
    plain = relational.read_options(connection, "t")
    assert plain["dbtable"] == "t" and plain["user"] == "me" and "partitionColumn" not in plain
    sliced = relational.read_options(connection, "t", relational.Slices("id", 0, 1000, 8))
    assert (sliced["partitionColumn"], sliced["lowerBound"], sliced["upperBound"], sliced["numPartitions"]) == ("id", "0", "1000", "8")
    assert relational_sink.append_options(connection, "t", 4)["numPartitions"] == "4"
    assert "user" not in relational.Connection("jdbc:x:", "a.Driver").options()


def test_topic_options():
    options = topics.topic_options("h:1", ["a", "b"], "latest", min_partitions=64, max_per_batch=5)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
                       "minPartitions": "64", "maxOffsetsPerTrigger": "5"}
    assert topics.topic_options("h:1", "a", end="latest")["endingOffsets"] == "latest"


def test_scratch_folders(spark):
    root = workspace.shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")
    frame = spark.range(3)
    assert bag(workspace.written(frame, "r")) == bag(frame)
    assert workspace.new_folder(spark, "x").startswith(workspace.application_folder(spark))


def test_folder_without_a_setting(spark):
    class Conf:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "file:/w/"}.get(name, default)

    class Session:
        conf = Conf()

    assert workspace.shared_root(Session()) == "file:/w/_sparkloom_work"


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
    assert spark.conf.get("spark.sql.catalogImplementation") == "in-memory"
    assert build_session("again").sparkContext.applicationId == spark.sparkContext.applicationId
