"""Table sinks: write modes, derived days, keyed upserts, databases, file limits."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from streamtally.schemas import record
from streamtally.session import fresh_folder
from streamtally.sinks import database, keyed, lake, routes, text
from streamtally.streaming import run

ROWS = "day string, v int"


def test_static_and_dynamic_overwrite(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], ROWS)
    new = spark.createDataFrame([("b", 3)], ROWS)
    for write, want in ((lake.overwrite_table, {("b", 3)}),
                        (lake.overwrite_partitions, {("a", 1), ("b", 3)})):
        path = fresh_folder(spark, "t")
        lake.append(old, path, ["day"])
        write(new, path, ["day"])
        stored = spark.read.schema(ROWS).parquet(path)
        assert {(r.day, r.v) for r in stored.collect()} == want


def test_append_limits_file_length(spark):
    path = fresh_folder(spark, "t")
    lake.append(spark.range(1000).selectExpr("id", "'x' AS day"), path, ["day"], records_per_file=300)
    assert len(spark.read.parquet(path).inputFiles()) >= 4


TABLE = record(k="string", a="long", b="timestamp")


def test_upsert_and_delete_by_key(spark):
    first, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    table = keyed.KeyedTable(fresh_folder(spark, "k"), TABLE, ["k"], buckets=4)
    table.create(spark.createDataFrame([("x", 1, first), ("y", 2, first), ("z", 3, first)], TABLE))
    updates = spark.createDataFrame([("y", 20, later), ("n", 4, later), ("z", None, later)], TABLE)
    table.upsert(updates, ["a"], spark.createDataFrame([("x",)], "k string"))
    have = {(r.k, r.a, r.b) for r in table.read(spark).collect()}
    assert have == {("y", 20, first), ("n", 4, later), ("z", None, first)}
    table.upsert(updates, ["a"])
    assert {(r.k, r.a, r.b) for r in table.read(spark).collect()} == have


def test_bucket_emptied_by_deletes(spark):
    table = keyed.KeyedTable(fresh_folder(spark, "k"), TABLE, ["k"], buckets=1)
    table.create(spark.createDataFrame([("x", 1, None)], TABLE))
    table.upsert(spark.createDataFrame([], TABLE), deletes=spark.createDataFrame([("x",)], "k string"))
    assert table.read(spark).count() == 0


def test_routes_and_json_files(spark):
    frame = spark.range(250).selectExpr("CASE WHEN id < 120 THEN 'a' ELSE 'b' END AS topic", "id")
    path = fresh_folder(spark, "r")
    routes.write_by_topic(frame, path)
    assert spark.read.parquet(f"{path}/topic=a").count() == 120
    path = fresh_folder(spark, "j")
    text.write_json_files(frame.coalesce(1), path, ["topic"])
    assert len(spark.read.json(path).inputFiles()) == 2 + 2


def test_hot_partition_is_split_when_written(spark):
    rows = spark.range(200_000).selectExpr("'x' AS day", "sha2(cast(id AS string), 256) AS v")
    path = fresh_folder(spark, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        lake.append(rows, path, ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.read.parquet(path).inputFiles()) > 1


class Database:
    """Stands in for a database: remembers what was staged and run, and fails where it is told to."""

    def __init__(self, failures):
        self.failures, self.log, self.staged, self.tables, self.batch = list(failures), [], None, {}, -1

    def stage(self, rows, staging):
        self.log.append(("stage", staging))
        self._fail("stage")
        self.staged = [tuple(r) for r in rows.collect()]

    def transact(self, statements):
        self.log.append(("transaction", *statements))
        self._fail("before")
        batch_id = int(statements[0].split("batch_id >= ")[1].split(")")[0])
        if batch_id > self.batch:
            self.tables |= {r[0]: r for r in self.staged}
            self.batch = batch_id
        self._fail("after")

    def _fail(self, point):
        if point in self.failures:
            self.failures.remove(point)
            raise OSError(point)


def database_sink(stub, **options):
    slept = []
    sink = database.DatabaseSink(
        "boards", "top", ["id", "n"], ["id"], "at", stub.stage, stub.transact, sleep=slept.append, **options
    )
    return sink, slept


def test_database_sink_stages_upserts_and_records_in_one_transaction(spark):
    stub = Database(["before"])
    sink, slept = database_sink(stub)
    rows = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("a", 2, 2), ("b", 5, 1)], "id string, n int, at int")
    sink(rows, 4)
    assert stub.tables == {"a": ("a", 3), "b": ("b", 5)} and slept == [1.0]
    upsert = (
        "INSERT INTO top (id, n) SELECT id, n FROM top_staging_boards WHERE NOT EXISTS (SELECT 1 FROM sink_batches "
        "WHERE sink = 'boards' AND batch_id >= 4) ON CONFLICT (id) DO UPDATE SET n = EXCLUDED.n"
    )
    record_ = (
        "INSERT INTO sink_batches (sink, batch_id) VALUES ('boards', 4) "
        "ON CONFLICT (sink) DO UPDATE SET batch_id = GREATEST(sink_batches.batch_id, EXCLUDED.batch_id)"
    )
    assert stub.log == [("stage", "top_staging_boards"), ("transaction", upsert, record_)] * 2


@pytest.mark.parametrize("point", ["stage", "before", "after"])
def test_database_sink_has_one_effect_wherever_it_fails(spark, point):
    stub = Database([point])
    sink, _ = database_sink(stub)
    for batch_id, n in ((0, 1), (1, 2)):
        frame = spark.createDataFrame([("a", n, 1)], "id string, n int, at int")
        sink(frame, batch_id)
    assert stub.tables == {"a": ("a", 2)} and stub.batch == 1
    # An old batch that comes once more changes nothing.
    sink(spark.createDataFrame([("a", 9, 1)], "id string, n int, at int"), 1)
    assert stub.tables == {"a": ("a", 2)}


def test_database_sink_gives_up_after_its_attempts(spark):
    stub = Database(["before"] * 9)
    sink, slept = database_sink(stub, attempts=3)
    with pytest.raises(OSError, match="before"):
        sink(spark.createDataFrame([("a", 1, 1)], "id string, n int, at int"), 0)
    assert slept == [1.0, 2.0] and stub.tables == {}


def test_database_sink_as_a_stream(spark):
    """The stream fails with its sink, and goes on from its checkpoint."""
    root = fresh_folder(spark, "database")
    schema = record(id="string", n="integer", at="integer")
    stub = Database(["after", "after"])
    sink, _ = database_sink(stub, attempts=2)

    def writer(stream):
        totals = stream.groupBy("id").agg(F.sum("n").cast("int").alias("n"), F.max("at").alias("at"))
        return sink.writer(totals, f"{root}/checkpoint")

    first = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], schema)
    with pytest.raises(StreamingQueryException):
        run.replay(spark, [first], schema, writer, f"{root}/landing")
    run.replay(spark, [spark.createDataFrame([("a", 5, 2)], schema)], schema, writer, f"{root}/landing")
    assert stub.tables == {"a": ("a", 6), "b": ("b", 2)}


def test_staging_options(spark, monkeypatch):
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def mode(self, name):
            seen["mode"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def save(self):
            seen["saved"] = True

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Writer()))
    database.stage_batch(spark.range(3), "jdbc:x", "t_staging", batch_size=77, writers=2)
    assert seen["batchsize"] == "77" and seen["truncate"] == "true" and seen["mode"] == "overwrite" and seen["saved"]


def test_days_are_derived_and_prune(spark):
    path = fresh_folder(spark, "days")
    times = [dt.datetime(2024, 1, d, h, tzinfo=dt.UTC) for d in range(1, 6) for h in (0, 12, 23)] + [dt.datetime(1969, 12, 31, 23, tzinfo=dt.UTC), None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, at timestamp")
    lake.append(rows, path, ["days(at)"])
    found = spark.read.parquet(path)
    assert {str(r.at_day) for r in found.select("at_day").distinct().collect()} == {
        "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", "1969-12-31", "None",
    }
    cut = lake.between(found, "at", "2024-01-02 12:00:00", "2024-01-04 00:00:00")
    assert sorted(r.id for r in cut.collect()) == [4, 5, 6, 7, 8] and cut.columns == ["id", "at"]
    plan = cut._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "at_day" in filters and "2024-01-02" in filters and "2024-01-04" in filters
    assert len(cut.inputFiles()) <= len(found.inputFiles())
    # Another zone of the session changes neither the days nor the pruning.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        again = fresh_folder(spark, "days")
        lake.overwrite_partitions(rows, again, ["days(at)"])
        assert sorted((r.id, str(r.at_day)) for r in spark.read.parquet(again).collect()) == sorted(
            (r.id, str(r.at_day)) for r in found.collect()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_table_declared_by_days(spark):
    path = fresh_folder(spark, "declared-days")
    schema = record(id="integer", at="timestamp")
    lake.create_table(spark, "by_days", schema, ["days(at)"], path)
    try:
        rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], schema)
        lake.append(rows, path, ["days(at)"])
        spark.sql("MSCK REPAIR TABLE by_days")
        table = spark.table("by_days")
        assert table.columns == ["id", "at", "at_day"] and dict(table.dtypes)["at_day"] == "date"
        assert [r.id for r in lake.between(table, "at", "2024-01-02", "2024-01-03").collect()] == [2]
    finally:
        lake.drop_table(spark, "by_days")


def test_small_json_files_come_alone(spark):
    """No checksum file, each of which would start more processes on a local file system."""
    path = fresh_folder(spark, "alone")
    frame = spark.range(950).selectExpr("IF(id % 3 = 0, 'a', 'b') AS topic", "id", "IF(id = 7, NULL, 'é\n' || id) AS v")
    text.write_json_files(frame, path, ["topic"], writers=2)
    names = [f for _, _, files in os.walk(path) for f in files]
    assert not [n for n in names if n.endswith(".crc")]
    found = spark.read.schema(frame.schema).json(path)
    assert sorted(found.select("topic", "id", "v").collect(), key=lambda r: r.id) == frame.collect()
    # The options hold for that write alone.
    text.write_lines(frame.select(F.col("topic").alias("line")), f"{path}-lines")
    assert [f for _, _, files in os.walk(f"{path}-lines") for f in files if f.endswith(".crc")]
