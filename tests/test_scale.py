"""Shapes that decide cost on large tables: what is decoded, moved and read again."""

from __future__ import annotations

import re
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import fixtures, jobs
from flowloom.operators.sessions import KEY, assign_sessions
from flowloom.plans.staging import stage_table
from flowloom.sources import captures
from tests import frames as X

# Default of the JVM's HugeMethodLimit.
COMPILED_BYTES = 8000


def code_sizes(df):
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


@pytest.fixture
def tables(spark, tmp_path):
    rows = [
        (i // 4, i % 40, i % 3, i % 4 + 1, float(i % 50 + 1), "AN"[i % 2], "FO"[i // 8 % 2], datetime(1995, 1, 1) + timedelta(i % 9))
        for i in range(400)
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def padded_frame(i):
    return X.ethernet(X.ipv4("10.0.0.1", "10.0.0.2", X.udp_datagram(5000, 53, b"%d" % i), 17), pad_to=400)


def test_decoding_is_short_enough_to_be_compiled(spark, tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frames = fixtures.build_frames(spark, tables)
        assert max(code_sizes(frames)) < COMPILED_BYTES
        read = spark.createDataFrame([], frames.schema)
        assert max(code_sizes(assign_sessions(read).groupBy(*KEY).count())) < COMPILED_BYTES
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_padding_is_no_start_of_a_range(spark, tmp_path, monkeypatch):
    packets = [(1_700_000_000_000_000 + i, padded_frame(i)) for i in range(200)]
    X.write(tmp_path / "a.pcap", X.capture(packets))
    again = []
    read = captures._read_again
    monkeypatch.setattr(captures, "_read_again", lambda ranges, *rest: again.append(ranges.count()) or read(ranges, *rest))
    got = captures.read_captures(spark, str(tmp_path), "file", range_bytes=3000).orderBy("capture_pos").collect()
    assert [(r["ts_us"], bytes(r["data"])) for r in got] == packets and again == []


def test_ranges_of_empty_records_are_found(spark, tmp_path):
    X.write(tmp_path / "a.pcap", X.capture([(1_700_000_000_000_000 + i, b"") for i in range(300)]))
    got = captures.index_captures(spark, str(tmp_path), "file", range_bytes=1000)
    assert [r["ts_us"] - 1_700_000_000_000_000 for r in got.orderBy("capture_pos").collect()] == list(range(300))


def test_ranges_that_are_read_again_are_read_by_several_tasks(spark):
    fields = "class string, capture string, path string, length long, range_no int, lo long, hi long, start long"
    ranges = spark.createDataFrame([("a", "a", "a", 9, i, 0, 9, 0) for i in range(40)], fields)
    parts = captures._read_again(ranges, 0, None).rdd.getNumPartitions()
    assert parts == 40


def test_sessions_of_one_file_are_not_ranked_in_ranges(spark, tables, tmp_path, monkeypatch):
    packets = assign_sessions(fixtures.build_frames(spark, tables))
    shown = ["class", "flow_key", "capture", "pos", "pkt_key"]
    narrow = captures.place_sessions(packets.drop("data"), fixtures.PACKET_ORDER, 400).select(*shown)
    wide = captures.place_sessions(packets, fixtures.PACKET_ORDER, 400).select(*shown)
    assert wide.where(F.col("capture").contains(".part")).count() > 0
    assert sorted(wide.collect()) == sorted(narrow.collect())
    whole = sorted(captures.place_sessions(packets.drop("data"), fixtures.PACKET_ORDER).select(*shown).collect())
    monkeypatch.delattr(captures, "slice_positions")
    placed = captures.place_sessions(packets, fixtures.PACKET_ORDER)
    assert sorted(placed.select(*shown).collect()) == whole
    captures.write_session_files(placed, f"{tmp_path}/flow", order=fixtures.PACKET_ORDER)
    back = captures.first_packets_of_files(spark, f"{tmp_path}/flow").groupBy("capture").agg(F.sort_array(F.collect_list(F.struct("capture_pos", "ts_us"))).alias("got"))
    due = placed.groupBy("capture").agg(F.sort_array(F.collect_list(F.struct(F.col("pos").cast("long") - 1, "ts_us"))).alias("due"))
    assert due.count() == back.count() == due.join(back, "capture").where("cast(got as string) = cast(due as string)").count()


def test_positions_are_ranked_without_bytes(spark, tables, monkeypatch):
    seen = []
    rank = jobs.session_positions
    monkeypatch.setattr(jobs, "session_positions", lambda rows, order: seen.append(rows.columns) or rank(rows, order))
    assert jobs.session_order(spark, tables).count() == 400
    assert seen == [["class", "flow_key", "ts_us", "pkt_key"]]


def test_sessions_alone_leave_no_table_of_frames(spark, tables):
    assert jobs.feature_join(spark, tables).columns == [*KEY, "features"]
    key = spark.sparkContext.applicationId, tables
    assert (*key, "sessions") in fixtures._STAGED and (*key, "frames") not in fixtures._STAGED


def stored(path):
    return sum(p.stat().st_size for p in path.rglob("*.pcap*"))


def test_captures_of_the_roundtrip_are_compressed(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "fresh_path", lambda spark, name: f"{tmp_path}/{name}")
    assert jobs.pcap_roundtrip(spark, tables).count() == 400
    plain = fixtures.build_frames(spark, tables).agg(F.sum(F.col("caplen") + 16)).first()[0]
    assert 0 < stored(tmp_path / "captures") * 3 < plain


def test_session_files_are_compressed(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "fresh_path", lambda spark, name: f"{tmp_path}/{name}")
    got = jobs.session_files(spark, tables)
    files = captures.first_packets_of_files(spark, f"{tmp_path}/flow", max_packets=1)
    plain = files.agg(F.sum("length")).first()[0]
    assert plain == assign_sessions(fixtures.build_frames(spark, tables)).agg(F.sum(F.col("caplen") + 16) + 24 * F.count_distinct(*KEY)).first()[0]
    assert 0 < stored(tmp_path / "flow") * 2 < plain
    assert {r["capture"][-5:] for r in got.select("capture").collect()} <= {".pcap"}


def test_staged_tables_leave_no_shuffle_files(spark):
    folders = [str(d) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    found = lambda: {p.name for d in folders for p in Path(d).rglob("shuffle_*.data")}
    before = found()
    switch = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(switch)
    rows = spark.range(1000).repartition(4).repartition(3, "id")
    assert len(stage_table(rows, "rows").collect()) == 1000 and spark.conf.get(switch) == held
    for _ in range(50):
        if not found() - before:
            break
        time.sleep(0.2)
    assert found() - before == set()
