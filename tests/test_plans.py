"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import pytest

from catalog.jobs import QUERIES
from flowloom.operators.sessions import MIN_CAPTURE_BYTES
from flowloom.sources.captures import CaptureReader
from tests import frames as X

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, mode="simple"):
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fit_select"}))
def test_no_pairwise_joins_and_no_row_wise_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert ("MapInArrow" in plan) == (name == "pcap_roundtrip")


def test_session_text_reuses_the_partitioning_of_the_cut(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["session_text"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2  # packets cut to five, and totals
    assert plan.count("SortMergeJoin") == 1


def test_capped_queries_cut_ahead_of_the_shuffle(spark):
    for name in ("class_cap", "split_assign"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert plan.count("WindowGroupLimit") == 4
        assert "text" not in plan.split("ReadSchema")[1]


def test_encoding_shuffles_rows_once(spark):
    plan = plan_of(QUERIES["encode_tokens"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_size_filter_runs_on_the_file_listing(tmp_path):
    X.write(tmp_path / "web" / "a.pcap", X.capture([]))
    X.write(tmp_path / "web" / "b.pcap", X.capture([(0, b"x" * 3000)]))
    reader = CaptureReader({"path": str(tmp_path), "range_bytes": "0", "min_bytes": str(MIN_CAPTURE_BYTES)})
    assert [item[1] for part in reader.partitions() for item in part.value] == ["b.pcap"]
