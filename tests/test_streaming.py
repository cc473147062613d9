import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from pyarrow import parquet
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sparkloom.bindings import QUERIES, inputs, stream_queries
from sparkloom.functions.messages import delimited_fields
from sparkloom.plans.text import part_count
from sparkloom.sources.files import stream_lines
from sparkloom.streaming import quotes, runner, word_counts
from sparkloom.streaming.changes import ChangeTable
from sparkloom.streaming.keyed import CLICK_SCHEMA, KeyedTable, click_rows, newest
from sparkloom.streaming.manifest import Manifest
from sparkloom.workspace import application_folder, new_folder
from tests.helpers import bag, plan, rows


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()

    def path(name):
        return str(tmp_path / name)

    def drop(name, *lines):
        (tmp_path / "in" / name).write_text("".join(line + "\n" for line in lines))

    return path, drop


def test_files_are_appended_once(spark, place):
    path, drop = place
    drop("1.txt", "a", "b")
    stream = stream_lines(spark, path("in"))
    for _ in range(2):
        runner.to_parquet(stream, path("out"), path("cp"))
    assert bag(spark.read.parquet(path("out"))) == {("a",): 1, ("b",): 1}
    drop("2.txt", "b", "c")
    runner.to_parquet(stream, path("out"), path("cp"))
    assert bag(spark.read.parquet(path("out"))) == {("a",): 1, ("b",): 2, ("c",): 1}


def test_per_batch_and_running_counts_differ(spark, place):
    path, drop = place
    lines = stream_lines(spark, path("in"))
    for name, line in (("1.txt", "a b  a"), ("2.txt", "a c")):
        drop(name, line)
        word_counts.count_per_batch(lines, path("batch"), path("cp1"))
        word_counts.count_running(lines, path("run"), path("cp2"))
        word_counts.count_running_complete(lines, path("all"), path("cp3"))
    assert bag(word_counts.read_per_batch(spark, path("batch"))) == {
        (0, "a", 2): 1, (0, "b", 1): 1, (0, "", 1): 1, (1, "a", 1): 1, (1, "c", 1): 1}
    total = {("a", 3): 1, ("b", 1): 1, ("", 1): 1, ("c", 1): 1}
    assert bag(word_counts.read_running(spark, path("run"))) == total
    word_counts.fold_running(spark, path("run"), path("folded"))
    assert bag(word_counts.read_running(spark, path("folded"))) == total
    assert bag(word_counts.read_last_snapshot(spark, path("all"))) == total
    assert bag(part_count(spark.read.text(path("in")))) == total
    changed = spark.read.parquet(path("run") + "/batch_id=1")
    assert bag(changed) == {("a", 3): 1, ("c", 1): 1}


def test_one_file_per_batch(spark, place):
    path, drop = place
    for i in range(3):
        drop(f"{i}.txt", f"w{i}")
    word_counts.count_per_batch(stream_lines(spark, path("in"), 1), path("out"), path("cp"))
    got = word_counts.read_per_batch(spark, path("out"))
    assert got.select("batch_id").distinct().count() == 3 and got.count() == 3


def test_bounded_wait_stops_and_resumes(spark, place):
    path, drop = place
    drop("1.txt", "a")
    stream = stream_lines(spark, path("in"))
    start = time.time()
    query = runner.to_parquet(stream, path("out"), path("cp"), every="1 second", timeout=4)
    assert not query.isActive and time.time() - start < 60
    drop("2.txt", "b")
    runner.to_parquet(stream, path("out"), path("cp"))
    assert bag(spark.read.parquet(path("out"))) == {("a",): 1, ("b",): 1}


def test_failing_batch_raises(spark, place):
    path, drop = place
    drop("1.txt", "a")

    def fail(batch, batch_id):
        raise RuntimeError("no")

    with pytest.raises(StreamingQueryException):
        runner.for_each_batch(stream_lines(spark, path("in")), fail, path("cp"))


def test_keyed_upsert_of_clicks(spark, place):
    path, drop = place
    schema = spark.createDataFrame([], CLICK_SCHEMA).schema
    table = KeyedTable(path("table"), "row_key", ("clickinfo.time",))
    stream = click_rows(delimited_fields(stream_lines(spark, path("in")), schema))
    drop("1.txt", "1,s1,u1,t1,book,2", "1,s1,u2,t3,book,3", "2,s2,u1,t2,pen,1", "short,line", "")
    runner.for_each_batch(stream, table.put, path("cp"))
    drop("2.txt", "1,s9,u9,t0,ink,9")
    runner.for_each_batch(stream, table.put, path("cp"))
    got = {r.row_key: r.asDict(recursive=True) for r in table.read(spark).collect()}
    assert sorted(got) == ["click1", "click2"]
    assert got["click1"]["clickinfo"] == {"studentid": "s1", "url": "u2", "time": "t3"}
    assert got["click2"]["iteminfo"] == {"itemtype": "pen", "quantity": "1"}


def test_replay_and_compaction(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k", ("v",))
    first = spark.createDataFrame([("a", 1), ("a", 3), ("b", 1)], "k string, v int")
    last = spark.createDataFrame([("a", 2), ("c", 1)], "k string, v int")
    table.put(first, 0)
    table.put(last, 1)
    table.put(first, 0)
    expected = {("a", 3): 1, ("b", 1): 1, ("c", 1): 1}
    assert bag(table.read(spark)) == expected
    compact = table.compact(spark, str(tmp_path / "t2"))
    assert bag(compact.read(spark)) == expected
    compact.put(last, 1)  # as Spark replays the last batch after a crash
    assert bag(compact.read(spark)) == expected
    again = compact.compact(spark, str(tmp_path / "t3"))
    again.put(spark.createDataFrame([("b", 0), ("c", 9)], "k string, v int"), 2)
    assert bag(again.read(spark)) == {("a", 3): 1, ("b", 1): 1, ("c", 9): 1}


def test_cut_into_batches_does_not_matter(spark, tmp_path):
    rows_ = [("a", 5, "x"), ("a", 1, "y"), ("b", 2, "z"), ("b", 7, "w")]
    for name, cuts in (("one", [rows_]), ("two", [rows_[:1], rows_[1:]]), ("four", [[r] for r in reversed(rows_)])):
        table = KeyedTable(str(tmp_path / name), "k", ("t",))
        for batch_id, batch in enumerate(cuts):
            table.put(spark.createDataFrame(batch, "k string, t int, v string"), batch_id)
        assert bag(table.read(spark)) == {("a", 5, "x"): 1, ("b", 7, "w"): 1}


def test_table_without_batches(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "none"), "k", ("v",))
    assert rows(table.read(spark, "k string, v int")) == []
    table.put(spark.createDataFrame([("a", 1)], "k string, v int"), 0)
    assert rows(table.read(spark, "k string, v int")) == [("a", 1)]


def test_newest(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), (None, 0, "m")], "k string, t int, v string")
    assert bag(newest(frame, "k", ["t"])) == {("a", 2, "y"): 1, (None, 1, "n"): 1}


def test_quote_merge(spark, tmp_path):
    path = str(tmp_path / "quotes")
    quotes.open_quotes(spark, path)
    quotes.open_quotes(spark, path)
    columns = quotes.read_quotes(spark, path).columns
    make = lambda *pairs: spark.createDataFrame(
        [(s, None, 1.0, 2.0, None, 1.5, v) for s, v in pairs],
        "symbol string, date date, open double, high double, low double, close double, volume int")
    quotes.add_quotes(make(("A", 1), ("B", 2), (None, 4)), path)
    quotes.add_quotes(make(("A", 1), ("A", 1), ("A", 3), ("C", 5), (None, 4)), path)
    got = bag(quotes.read_quotes(spark, path).select("symbol", "volume"))
    assert got == {("A", 1): 1, ("A", 3): 1, ("B", 2): 1, ("C", 5): 1, (None, 4): 1}
    assert set(columns) == {"symbol", "date", "open", "high", "low", "close", "volume"}


def test_empty_and_null_symbols_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "quotes")
    quotes.open_quotes(spark, path)
    frame = spark.createDataFrame(
        [("", None, 1), (None, None, 1), ("", "2024-01-02", 1), (None, "2024-01-02", 1), ("a/b c", "2024-01-02", 1)],
        "symbol string, d string, volume int").select(
        "symbol", F.col("d").cast("date").alias("date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], "volume")
    for _ in range(3):
        quotes.add_quotes(frame, path)
    assert bag(quotes.read_quotes(spark, path).select(*frame.columns)) == bag(frame)


def _dated(spark, count=60):
    return spark.range(count).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("symbol"), F.date_add(F.lit("2024-01-01").cast("date"), (
            F.col("id") % 10).cast("int")).alias("date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.col("id").cast("int").alias("volume"))


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    stored = str(tmp_path / "quotes")
    frame = _dated(spark)
    for _ in range(2):
        quotes.add_quotes(frame, stored)
    assert quotes.read_quotes(spark, stored).count() == 60
    before = Manifest(stored).current(spark).content["parts"]
    quotes.add_quotes(frame.where("date = '2024-01-03'").limit(1).withColumn("volume", F.lit(999)), stored)
    after = Manifest(stored).current(spark).content["parts"]
    changed = [(day, bucket) for day in after for bucket in after[day] if before[day].get(bucket) != after[day][bucket]]
    assert len(changed) == 1 and changed[0][0] == "2024-01-03"
    assert quotes.read_quotes(spark, stored).count() == 61
    assert quotes.read_quotes(spark, stored, days=["2024-01-03", "1999-01-01"]).count() == 7


def test_twenty_batches_leave_few_files_and_whole_versions(spark, tmp_path):
    stored = str(tmp_path / "quotes")
    shared = Path(application_folder(spark))
    left = len(list(shared.glob("quotes-*")))
    seen = []
    for number in range(20):
        batch = _dated(spark, 4).withColumn("volume", F.col("volume") + number)
        seen.append(quotes.read_quotes(spark, stored).collect)  # a reader that began before this batch
        quotes.add_quotes(batch.coalesce(1), stored)
        assert quotes.read_quotes(spark, stored).count() == 4 * (number + 1)
        assert len(seen[-1]()) == 4 * number
    live = Manifest(stored).current(spark).content["parts"]
    for day, buckets in live.items():
        for bucket, version in buckets.items():
            assert len(list(Path(f"{stored}/v{version}/quote_day={day}/quote_bucket={bucket}").glob("*.parquet"))) == 1
    # Besides the live folders only those of the last few versions are there, and nothing in the shared folder.
    assert len(list(Path(stored).glob("v*/quote_day=*/quote_bucket=*/*.parquet"))) <= 4 * (Manifest(stored).keep + 1)
    assert len(list(shared.glob("quotes-*"))) == left
    assert len(list(Path(f"{stored}/_versions").glob("[0-9]*.json"))) == Manifest(stored).keep


# ---- tables of changes

USERS = "id bigint, at int, name string"


def _changes(spark, *rows_):
    return spark.createDataFrame(rows_, f"{USERS}, deleted boolean")


def _users(tmp_path, **more):
    return ChangeTable(str(tmp_path / "users"), USERS, "id", ("at",), buckets=4, **more)


def test_changes_with_deletions(spark, tmp_path):
    users = _users(tmp_path)
    assert users.read(spark).columns == ["id", "at", "name"] and users.read(spark).count() == 0
    assert users.apply(_changes(spark, (1, 1, "a", False), (2, 1, "b", False), (3, 5, "c", None)), 0)
    assert users.apply(_changes(spark, (1, 3, None, True), (2, 4, "B", False), (2, 2, "old", False)), 1)
    assert bag(users.read(spark)) == {(2, 4, "B"): 1, (3, 5, "c"): 1}
    users.apply(_changes(spark, (1, 2, "late", False), (3, 4, None, True)), 2)  # both older than what is known
    assert bag(users.read(spark)) == {(2, 4, "B"): 1, (3, 5, "c"): 1}
    users.apply(_changes(spark, (1, 9, "again", False), (3, 5, None, True)), 3)  # on a tie the deletion wins
    assert bag(users.read(spark)) == {(2, 4, "B"): 1, (1, 9, "again"): 1}


def test_replayed_batches_are_left_out(spark, tmp_path):
    users = _users(tmp_path)
    first = _changes(spark, (1, 1, "a", False))
    assert users.apply(first, 0) and not users.apply(first, 0)
    assert not users.apply(_changes(spark, (1, 9, "other", False)), 0)
    assert users.apply(_changes(spark, (1, 2, "b", False)), 0, "second")
    assert bag(users.read(spark)) == {(1, 2, "b"): 1}
    # A crash after the run was written and before it was published: the run is written again.
    assert users.apply(_changes(spark, (7, 7, "g", False)), 1)
    _changes(spark, (8, 8, "torn", False)).write.parquet(f"{users.path}/runs/run=changes-2/bucket=0")
    assert users.apply(_changes(spark, (8, 8, "h", False)), 2)
    assert bag(users.read(spark)) == {(1, 2, "b"): 1, (7, 7, "g"): 1, (8, 8, "h"): 1}


def test_runs_are_merged_by_levels(spark, tmp_path):
    draw, users, known = random.Random(3), _users(tmp_path, fanout=3), {}
    for number in range(14):
        batch = [(draw.randint(1, 40), draw.randint(1, 1000), f"n{number}", draw.random() < 0.3) for _ in range(15)]
        users.apply(_changes(spark, *batch), number)
        for row in batch:
            if row[0] not in known or (row[1], row[3], row[2]) > (known[row[0]][1], known[row[0]][3], known[row[0]][2]):
                known[row[0]] = row
        runs = Manifest(users.path).current(spark).content["runs"]
        levels = Counter(run["level"] for run in runs)
        assert max(levels.values()) < 3 and len(levels) <= 4
    assert bag(users.read(spark)) == Counter(row[:3] for row in known.values() if not row[3])
    assert len(list(Path(users.path, "runs").iterdir())) <= len(runs) + 3 * Manifest(users.path).keep
    users.compact(spark)
    assert len(Manifest(users.path).current(spark).content["runs"]) == 1
    assert bag(users.read(spark)) == Counter(row[:3] for row in known.values() if not row[3])


def test_one_key_opens_its_bucket_only(spark, tmp_path):
    users = _users(tmp_path, fanout=10)
    for number in range(3):
        users.apply(_changes(spark, *[(k, number, f"n{k}", k == 5 and number == 2) for k in range(200)]), number)
    found = users.lookup(spark, 17)
    assert rows(found) == [(17, 2, "n17")] and rows(users.lookup(spark, 5)) == [] and rows(users.lookup(spark, 999)) == []
    runs = users._runs(spark, Manifest(users.path).current(spark))
    bucket = runs.where("id = 17").select("bucket").first()[0]
    text = plan(found)
    assert re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {bucket}\)", text) and "EqualTo(id,17)" in text
    footer = parquet.ParquetFile(next(Path(users.path, "runs", "run=changes-0").rglob("*.parquet"))).metadata.row_group(0)
    held = {footer.column(k).path_in_schema: footer.column(k) for k in range(footer.num_columns)}["id"]
    assert held.statistics.min is not None and held.statistics.max < 200


def test_floor_ends_the_memory_of_deletions(spark, tmp_path):
    users = _users(tmp_path)
    users.apply(_changes(spark, (1, 5, None, True), (2, 50, None, True), (3, 4, "old", False)), 0)
    users.compact(spark, floor=10)
    held = users._runs(spark, Manifest(users.path).current(spark))
    assert {r.id for r in held.collect()} == {2, 3}
    users.apply(_changes(spark, (1, 4, "too late", False), (2, 49, "late", False), (4, 10, "d", False)), 1)
    assert bag(users.read(spark)) == {(3, 4, "old"): 1, (4, 10, "d"): 1}


def test_two_writers_do_not_both_publish(spark, tmp_path):
    manifest = Manifest(str(tmp_path / "t"))
    start = manifest.current(spark)
    manifest.publish(spark, start, {"a": 1}, [])
    with pytest.raises(FileExistsError):
        manifest.publish(spark, start, {"a": 2}, [])
    assert manifest.current(spark).content["a"] == 1


def test_null_keys_and_empty_batches(spark, tmp_path):
    users = _users(tmp_path)
    users.apply(_changes(spark).limit(0), 0)
    assert users.read(spark).count() == 0
    users.apply(_changes(spark, (None, 1, "n", False), (None, 2, "m", False)), 1)
    assert bag(users.read(spark)) == {(None, 2, "m"): 1}


def test_a_larger_table_is_streamed_in_as_many_batches_of_more_files(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame([(k, f"w{k % 7} {k}\n{k}") for k in range(700)], "doc_id long, text string")
    frame.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    held = sum(file.stat().st_size for file in tmp_path.glob("documents.parquet/part-*"))
    for parts, files in ((1, 3), (7, 9)):
        monkeypatch.setattr(inputs, "FILE_BYTES", held // parts + 1, raising=False)
        made = []
        monkeypatch.setattr(stream_queries, "new_folder", lambda *label: made.append(new_folder(*label)) or made[-1])
        stream = stream_queries.stream_of(spark, str(tmp_path), "documents")
        assert len(list(Path(made[0]).glob("part-*"))) == files
        batches = []
        runner.for_each_batch(stream, lambda batch, _: batches.append(batch.count()), str(tmp_path / f"check{parts}"))
        assert len(batches) == 3 and sum(batches) == 700 and min(batches) > 200
    counts = Counter(word for k in range(700) for word in (f"w{k % 7}", str(k), str(k)))
    for name in ("stream_word_count_running", "stream_word_count_running_complete", "stream_word_count_from_state"):
        assert bag(QUERIES[name](spark, str(tmp_path))) == Counter(counts.items())
