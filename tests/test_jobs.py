from __future__ import annotations

import random
from collections import Counter

import pandas
import pytest
from pyspark.sql import functions as F

from flowloom.operators import features, labelling
from flowloom.operators.modelling import fit_select, predict, save_model
from flowloom.operators.sessions import KEY, assign_sessions, kept_packets, session_stats
from flowloom.plans import jobs, staging
from flowloom.sources import captures, datasets, statistics
from tests import frames as X

HEADER = "Flow ID,Src IP,Src Port,Dst IP,Dst Port,Protocol,Timestamp,Flow Duration,Tot Pkts,名称,Rate,Label"


def statistics_csv(path, rows):
    X.write(path, ("\n".join([HEADER, *rows]) + "\n").encode("gbk"))


def frame(n, back=False, payload=400, host=1):
    ends = ("10.0.0.2", f"10.0.0.{host + 2}", 443, 5000 + n) if back else (
        f"10.0.0.{host + 2}", "10.0.0.2", 5000 + n, 443
    )
    return X.ethernet(X.ipv4(*ends[:2], X.tcp_segment(*ends[2:], payload=b"p" * payload)))


@pytest.fixture()
def capture_dir(tmp_path):
    """Class ``web``: 12 long sessions and a short one; class ``dns.v2``: 3; class ``idle``: none kept."""
    web = [(i * 1000 + j, frame(i, j % 2)) for i in range(12) for j in range(6)]
    web += [(10**6 + j, frame(50)) for j in range(2)]
    dns = [(i * 1000 + j, frame(i, host=7)) for i in range(3) for j in range(5)]
    idle = [(j, frame(1, payload=10)) for j in range(4)]
    for name, packets in (("web", web), ("dns.v2", dns), ("idle", idle)):
        X.write(tmp_path / "raw" / f"{name}.pcap", X.capture(sorted(packets)))
    statistics_csv(
        tmp_path / "feature" / "web.pcap_Flow.csv",
        [
            "10.0.0.2-10.0.0.3-443-5000-6,a,1,b,2,6,t,9,5,甲,,x",
            "10.0.0.3-10.0.0.2-5000-443-6,a,1,b,2,6,t,9,7,乙,2.5,x",
            "10.0.0.3-10.0.0.2-5001-443-6,a,1,b,2,6,t,9,8,丙,1e9,x",
        ],
    )
    return tmp_path


SCHEMA = (
    "`Flow ID` string, `Src IP` string, `Src Port` int, `Dst IP` string, `Dst Port` int,"
    " Protocol int, Timestamp string, `Flow Duration` long, `Tot Pkts` long, `名称` string,"
    " Rate double, Label string"
)


def test_statistics_files(spark, capture_dir):
    for schema in (SCHEMA, None):
        rows = statistics.read_statistics(spark, str(capture_dir / "feature"), schema)
        texts = [r["features"] for r in features.feature_text(rows).orderBy("row_no").collect()]
        assert texts == [
            "Tot Pkts: 5, 名称: 甲, Rate: nan",
            "Tot Pkts: 7, 名称: 乙, Rate: 2.5",
            "Tot Pkts: 8, 名称: 丙, Rate: 1000000000.0",
        ]
    first = {r["flow_key"]: r["features"] for r in features.first_features(rows).collect()}
    assert first["10.0.0.2-10.0.0.3-443-5000-6"].startswith("Tot Pkts: 5")


def test_statistics_by_class(spark, tmp_path):
    """Files of swapped, missing and further columns, of whole numbers here and floats there."""
    files = {
        "a": ["Flow ID,Tot Pkts,Rate,名称", "i1,5,2.5,甲", 'i2,7,,"x, y"'],
        "b": ["Flow ID,Rate,Tot Pkts,Label", "i1,7.5,9,BENIGN", "i3,NaN,,BENIGN"],
        "c.v2": ["Src IP,Extra,Flow ID", "1.1.1.1,007,i1", ""],
    }
    for name, lines in files.items():
        path = tmp_path / f"{name}.pcap_Flow.csv"
        path.write_bytes("\r\n".join(lines).encode("gbk"))
    rows = statistics.read_statistics_by_class(spark, str(tmp_path))
    got = {(r["class"], r["flow_id"]): r["features"] for r in features.feature_text(rows).collect()}
    assert got == {
        ("a", "i1"): "Tot Pkts: 5, Rate: 2.5, 名称: 甲",
        ("a", "i2"): "Tot Pkts: 7, Rate: nan, 名称: x, y",
        ("b", "i1"): "Rate: 7.5, Tot Pkts: 9.0",
        ("b", "i3"): "Rate: nan, Tot Pkts: nan",
        ("c.v2", "i1"): "Extra: 7",
    }
    first = {(r["class"], r["flow_key"]): r["features"] for r in features.first_features(rows).collect()}
    assert first["b", "i1"] == got["b", "i1"]


def odd_cell(pick):
    if pick.random() < 0.3:
        return '"' + "".join(pick.choice(["a", '""', "\n", "\r\n", "\r", ",", "甲", " "]) for _ in range(pick.randrange(6))) + '"'
    return pick.choice(['5" x', 'a"b"', "乙", "7", "12"])


@pytest.mark.parametrize("block_bytes", ["128m", "400b"])
def test_quoted_line_ends_read_as_python_reads_them(spark, tmp_path, block_bytes):
    pick = random.Random(1)
    for name, end in (("a", "\r\n"), ("b", "\n")):
        lines = ["Flow ID,A,B", *[f"i{i},{odd_cell(pick)},{odd_cell(pick)}" for i in range(120)], "", ""]
        X.write(tmp_path / f"{name}.pcap_Flow.csv", end.join(lines).encode("gbk"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    try:
        got = statistics.read_statistics_by_class(spark, str(tmp_path)).orderBy("row_no").collect()
        typed = statistics.read_statistics(spark, str(tmp_path), "`Flow ID` string, A string, B string").orderBy("row_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    for name in ("a", "b"):
        read = pandas.read_csv(tmp_path / f"{name}.pcap_Flow.csv", encoding="gbk", dtype=str, keep_default_na=False)
        want = [[v or "nan" for v in row] for row in read.values.tolist()]
        assert [list(r["texts"]) for r in got if r["class"] == name] == want
        assert [[v or "nan" for v in r[2:]] for r in typed if r["class"] == name] == want


def test_a_quote_that_is_not_closed_is_an_error(spark, tmp_path):
    X.write(tmp_path / "c.pcap_Flow.csv", b'Flow ID,A\n1,"open\n2,3\n')
    with pytest.raises(Exception, match="a quote is not closed"):
        statistics.read_statistics_by_class(spark, str(tmp_path)).collect()


def test_one_session_for_each_file(spark, tmp_path):
    packets = [(i * 10, frame(1, payload=900)) for i in range(5)]
    names = ["sess0.pcap", "sess1.pcap", "w.pcap.TCP_10-0-0-1_1_10-0-0-2_2.pcap", "w.pcap.TCP_10-0-0-2_2_10-0-0-1_1.pcap"]
    for name in names:
        X.write(tmp_path / "w" / name, X.capture(packets))
    X.write(tmp_path / "w" / "bad.pcap", b"no capture" * 300)
    got = jobs.packets_of_session_files(spark, str(tmp_path)).groupBy("flow_key").agg(
        F.array_sort(F.collect_list("pos")).alias("p")
    )
    assert {r["flow_key"]: r["p"] for r in got.collect()} == {n: [1, 2, 3, 4, 5] for n in names}
    counts = jobs.write_quarantine(spark, str(tmp_path), str(tmp_path / "left_out"))
    assert [(r["class"], r["n"]) for r in counts.collect()] == [("w", 1)]


def test_row_numbers_follow_the_file_over_many_blocks(spark, tmp_path):
    lines = [f"id{i},a,1,b,2,6,t,9,{i},x,0.5,x" for i in range(20_000)]
    statistics_csv(tmp_path / "c +1.pcap_Flow.csv", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = statistics.read_statistics(spark, str(tmp_path), SCHEMA)
        assert rows.select("row_no.block").distinct().count() > 5
        assert [r[0] for r in rows.select("class").distinct().collect()] == ["c +1"]
        ordered = [r[0] for r in rows.orderBy("row_no").select("Tot Pkts").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ordered == list(range(20_000))


@pytest.mark.parametrize("from_files", [False, True])
def test_dataset_build(spark, capture_dir, tmp_path, from_files):
    key_of = {}
    if from_files:
        raw = captures.read_captures(spark, str(capture_dir / "raw"), "file")
        by_session = {}
        for r in assign_sessions(raw).orderBy("ts_us", "capture_pos").collect():
            by_session.setdefault((r["class"], r["flow_key"]), []).append(r)
        for (name, key), packets in by_session.items():
            a, b, p, q, _ = key.split("-")
            file = f"{name}.pcap.TCP_{a.replace('.', '-')}_{p}_{b.replace('.', '-')}_{q}.pcap"
            content = X.capture([(r["ts_us"], bytes(r["data"])) for r in packets])
            X.write(tmp_path / "flow" / name / file, content)
            key_of[file] = key
        kept = jobs.packets_of_session_files(spark, str(tmp_path / "flow"))
    else:
        kept = jobs.packets_of_captures(spark, str(capture_dir / "raw"))
    stats = statistics.read_statistics(spark, str(capture_dir / "feature"), SCHEMA)
    out = str(tmp_path / "out")
    jobs.build_dataset(kept, stats, "dohbrw-2020", out, csv=True)

    labels = {r["str_label"]: r["label"] for r in datasets.read_labels(spark, f"{out}/label.tsv").collect()}
    assert labels == {"dns.v2": 0, "web": 1}
    data = spark.read.parquet(f"{out}/data").collect()
    assert Counter(r["class"] for r in data) == {"web": 12, "dns.v2": 3}
    by_key = {(r["class"], key_of.get(r["flow_key"], r["flow_key"])): r for r in data}
    row = by_key["web", "10.0.0.2-10.0.0.3-443-5000-6"]
    assert row["inputs"].startswith(
        "Below is a traffic session. Please conduct the malicious DoH detection task: "
        "\\n<session>: <pck>frame.time_delta: 0.000000, "
    )
    assert row["inputs"].count("<pck>") == 5
    assert row["inputs"].endswith(" \\n<feature>Tot Pkts: 5, 名称: 甲, Rate: nan")
    assert row["str_labels"] == "The traffic category is likely to be recognized as web."
    assert by_key["dns.v2", "10.0.0.2-10.0.0.9-443-5000-6"]["inputs"].endswith("\\n<feature>")

    splits = datasets.read_dataset(spark, f"{out}/splits")
    counts = Counter((r["class"], r["split"]) for r in splits.collect())
    assert counts == {
        ("web", "train"): 9, ("web", "val"): 1, ("web", "test"): 2,
        ("dns.v2", "train"): 3, ("dns.v2", "val"): 3, ("dns.v2", "test"): 3,
    }
    exported = datasets.read_split_files(spark, out)
    columns = ["inputs", "labels", "str_labels", "split"]
    assert datasets.read_dataset_csv(spark, f"{out}/data.tsv").count() == len(data)
    assert Counter(exported.select(*columns).collect()) == Counter(splits.select(*columns).collect())


def test_captures_are_cut_into_sessions(spark, capture_dir, tmp_path):
    out = tmp_path / "sessions"
    X.write(capture_dir / "raw" / "bad.pcap", b"no capture")
    X.write(capture_dir / "raw" / "arp.pcap", X.capture([(0, X.ethernet(b"\x00\x01" * 14, 0x0806))] * 3))
    jobs.split_captures(spark, str(capture_dir / "raw"), str(out))
    sizes = {p.name: p.stat().st_size for p in (out / "web").iterdir() if not p.name.startswith(".")}
    assert len(sizes) == 13
    packets = captures.read_captures(spark, str(out))
    assert packets.where("class = 'web'").count() == 74
    keyed = assign_sessions(packets).withColumn("flow_key", F.col("capture"))
    assert sizes == {r["flow_key"]: r["size_bytes"] for r in session_stats(keyed).where("class = 'web'").collect()}
    left = {r["class"]: (r["reason"], r["n"]) for r in spark.read.parquet(str(out / "_left_out")).collect()}
    assert left == {"bad": ("not a capture file", 1), "arp": ("no IP packet of a known link type", 3)}
    kept = jobs.packets_of_session_files(spark, str(out))
    assert kept.select("class", "flow_key").distinct().groupBy("class").count().count() == 2


def test_index_holds_no_bytes(spark, capture_dir):
    index = jobs.session_index(spark, str(capture_dir / "raw"))
    assert "data" not in index.columns and {"path", "offset", "caplen", "flow_key"} <= set(index.columns)


def test_dataset_files_keep_texts(spark, tmp_path):
    texts = ['a "quoted", text', " blanks \t", "line\nend", "back\\slash\\n", "", "NA", "null", 'x"', "\\", '\\"', "é\r\nü"]
    rows = [(t, i, t or "s") for i, t in enumerate(texts)] + [("no label", None, "z")]
    df = spark.createDataFrame(rows, datasets.DATASET_SCHEMA)
    path = str(tmp_path / "data.tsv")
    datasets.write_dataset_csv(df, path)
    got = [tuple(r) for r in datasets.read_dataset_csv(spark, path).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_reading_split_files_of_other_tools(spark, tmp_path):
    for name in datasets.SPLIT_NAMES:
        X.write(tmp_path / f"{name}.tsv", b'inputs,labels,str_labels\n"a, ""b""",1,web\n')
    got = datasets.read_split_files(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [('a, "b"', 1, "web", s) for s in datasets.SPLIT_NAMES]


def test_resplit_files_are_in_label_order(spark, tmp_path):
    rows = [(f"t{i}", i % 7, f"c{i % 7}") for i in range(420)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.resplit_dataset(spark.createDataFrame(rows, datasets.DATASET_SCHEMA), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for split, n in (("train", 336), ("val", 42), ("test", 42)):
        files = sorted((tmp_path / "out" / "splits" / f"split={split}").glob("*.parquet"))
        labels = [label for f in files for label in pandas.read_parquet(f)["labels"]]
        assert labels == sorted(labels) and len(labels) == n
    assert len(files) > 1


def test_resplit_with_equal_rows(spark, tmp_path):
    rows = [("same", 0, "a")] * 700 + [(f"t{i}", 1, "b") for i in range(20)] + [("u", 2, "c")] * 3
    rows += [("v", None, "d")]
    df = spark.createDataFrame(rows, datasets.DATASET_SCHEMA)
    jobs.resplit_dataset(df, str(tmp_path / "one"))
    jobs.resplit_dataset(df.repartition(3), str(tmp_path / "two"))
    read = lambda n: Counter(
        tuple(r) for r in datasets.read_dataset(spark, str(tmp_path / n))
        .select("inputs", "labels", "split").collect()
    )
    one = read("one")
    assert one == read("two")
    assert [one["same", 0, s] for s in datasets.SPLIT_NAMES] == [480, 60, 60]
    assert Counter(s for (_, label, s) in one.elements() if label == 1) == {"train": 16, "val": 2, "test": 2}
    assert [one["u", 2, s] for s in datasets.SPLIT_NAMES] == [3, 3, 3]


def test_training(spark, tmp_path):
    words = {0: "red green blue", 1: "one two three"}
    rows = [
        (f"{label}-{i}", f"{words[label]} {i}", label, split)
        for label in words
        for i, split in enumerate(["train"] * 20 + ["val"] * 4 + ["test"] * 4)
    ]
    df = spark.createDataFrame(rows, "id string, inputs string, labels int, split string")
    path = str(tmp_path / "model")
    metrics, confusion = jobs.train_and_evaluate(df, ["id"], path)
    assert {r["split"]: (r["f1"], r["n"]) for r in metrics.collect()} == {"val": (1.0, 8), "test": (1.0, 8)}
    assert {r["split"] for r in confusion.collect()} == {"val", "test"}
    from pyspark.ml import PipelineModel

    again = predict(PipelineModel.load(path), df.where("split = 'test'"), ["id"])
    assert all(r["y_true"] == r["y_pred"] for r in again.collect())
    model, reg, f1 = fit_select(df, ["id"], grid=(0.1,))
    assert (reg, f1) == (0.1, 1.0)
    save_model(model, path)


def test_hot_session_is_cut_before_the_shuffle(spark):
    frames = [frame(0, payload=50)] * 3000 + [frame(i, payload=50) for i in range(1, 30)] * 3
    rows = [("web", "web.pcap", i, i, len(f), len(f), 1, f) for i, f in enumerate(frames)]
    schema = (
        "class string, capture string, capture_pos long, ts_us long, caplen int, origlen int,"
        " linktype int, data binary"
    )
    packets = spark.createDataFrame(rows, schema).repartition(6)
    got = kept_packets(assign_sessions(packets), min_bytes=0).groupBy(*KEY).agg(
        F.count("*").alias("k"), F.max("n_pkts").alias("n")
    )
    assert Counter((r["k"], r["n"]) for r in got.collect()) == {(5, 3000): 1, (3, 3): 29}
    plan = spark._jvm.PythonSQLUtils.explainString(
        kept_packets(assign_sessions(packets))._jdf.queryExecution(), "simple"
    )
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning(class") == 2


def test_shared_folder(spark):
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    one, two = staging.fresh_path(spark, "t"), staging.fresh_path(spark, "t")
    assert one != two and one.startswith(staging.shared_dir(spark))


def test_staged_tables_go_with_their_scope(spark):
    import os

    with staging.temporary_tables(spark):
        kept = staging.stage_table(spark.range(3), "t")
        with staging.temporary_tables(spark):
            inner = staging.fresh_path(spark, "u")
            spark.range(2).write.parquet(inner)
        assert kept.count() == 3 and not os.path.exists(inner.removeprefix("file:"))
        outer = kept.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(outer)


def test_join_beyond_the_broadcast_threshold(spark):
    sessions = spark.createDataFrame([("a", "k1", "x"), ("b", "k2", "y")], "class string, flow_key string, text string")
    labels = labelling.label_dictionary(sessions)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    results = []
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            rows = labelling.dataset_rows(sessions, labels, ("do", "{label}!"))
            results.append(sorted(tuple(r) for r in rows.collect()))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results[0] == results[1] == [
        ("a", "k1", "do\\n<session>: x", 0, "a!"), ("b", "k2", "do\\n<session>: y", 1, "b!")
    ]
