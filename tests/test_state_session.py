"""The session of replayed streams."""

import json
import os

from pyspark.sql import functions as F

from streamtally.session import state_session
from streamtally.streaming import run, supplier


def test_replayed_streams_have_at_most_a_state_partition_for_each_core(spark, tmp_path):
    many = spark.newSession()
    many.conf.set("spark.sql.shuffle.partitions", "23")
    many.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    cores = spark.sparkContext.defaultParallelism
    assert state_session(many).conf.get("spark.sql.shuffle.partitions") == str(cores)
    assert state_session(many, 50).conf.get("spark.sql.shuffle.partitions") == "23"
    assert state_session(many).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    rows = many.range(100).select((F.col("id") % 10).alias("k"))
    sink = supplier.UpdateLog(f"{tmp_path}/out")
    run.replay(
        many, [rows, rows], rows.schema, lambda s: sink.writer(s.groupBy("k").count(), f"{tmp_path}/at"), f"{tmp_path}/in"
    )
    assert sorted(map(tuple, sink.latest(many, ["k"]).collect())) == [(k, 20) for k in range(10)]
    assert len([d for d in os.listdir(f"{tmp_path}/at/state/0") if d.isdigit()]) == cores
    assert many.conf.get("spark.sql.shuffle.partitions") == "23"
    with open(f"{tmp_path}/at/offsets/0") as file:
        assert json.loads(file.read().splitlines()[1])["conf"]["spark.sql.shuffle.partitions"] == str(cores)
