from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.operators.endpoints import with_endpoints
from flowloom.operators.features import parse_flow_name
from flowloom.operators.headers import decode_headers
from flowloom.operators.render import packet_text, session_text
from flowloom.operators.sessions import assign_sessions, first_packets
from flowloom.plans import jobs
from flowloom.sources import captures
from tests import frames as X

A, B = "10.0.0.1", "10.0.0.2"


def tcp_frame(src=A, dst=B, sport=5000, dport=443, pad_to=0, tags=(), ip_options=b"", **tcp):
    packet = X.ipv4(src, dst, X.tcp_segment(sport, dport, **tcp), options=ip_options)
    return X.ethernet(packet, tags=tags, pad_to=pad_to)


def rows(df):
    return [r.asDict() for r in df.orderBy("class", "capture", "capture_pos").collect()]


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("nanos", [False, True])
def test_byte_orders_and_resolutions(spark, tmp_path, order, nanos):
    packets = [(1_700_000_000_123_456 + i, tcp_frame(payload=b"x" * i)) for i in range(3)]
    X.write(tmp_path / "app.pcap", X.capture(packets, order, nanos))
    got = rows(captures.read_captures(spark, str(tmp_path), "file"))
    assert [(r["class"], r["capture_pos"], r["ts_us"], bytes(r["data"])) for r in got] == [
        ("app", i, ts, frame) for i, (ts, frame) in enumerate(packets)
    ]


def test_cut_file_bad_file_and_early_stop(spark, tmp_path):
    packets = [(i, tcp_frame()) for i in range(4)]
    X.write(tmp_path / "a.pcap", X.capture(packets, cut=5))
    X.write(tmp_path / "b.pcap", b"\x0a\x0d\x0d\x0a" + b"\0" * 40)
    X.write(tmp_path / "c.pcap", X.capture(packets) + b"\xff" * 16)
    X.write(tmp_path / "_temporary" / "d.pcap", X.capture(packets))
    X.write(tmp_path / "e.pcap", b"")
    index = captures.index_captures(spark, str(tmp_path), "file")
    counts = captures.good_packets(index).groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in counts} == {"a": 3, "c": 4}
    bad = {(r["class"], r["capture_pos"]) for r in captures.quarantine(index).collect()}
    assert bad == {("b", 0), ("c", 4), ("e", 0)}
    two = captures.good_packets(captures.first_packets_of_files(spark, str(tmp_path), "file", max_packets=2))
    assert {r["class"]: r["count"] for r in two.groupBy("class").count().collect()} == {"a": 2, "c": 2}


def test_large_captures_are_cut_at_records(spark, tmp_path):
    range_bytes = 900
    packets = [(i, tcp_frame(payload=bytes([i]) * (i * 7 % 50))) for i in range(40)]
    X.write(tmp_path / "a.pcap", X.capture(packets))
    X.write(tmp_path / "b.pcap", X.capture(packets, ">", cut=3))
    X.write(tmp_path / "c.pcap", X.capture(packets) + b"\xff" * 40)
    X.write(tmp_path / "d.pcap", b"\x0a\x0d\x0d\x0a" + b"\0" * 40)
    # Packets that carry captures themselves look like records in the wrong places.
    inner = X.capture([(i, b"q" * 9) for i in range(30)])
    X.write(tmp_path / "e.pcap", X.capture([(i, tcp_frame(payload=inner)) for i in range(3)]))
    X.write(tmp_path / "f.pcap", X.capture([(i, b"\0" * (i * 31 % 200)) for i in range(60)], nanos=True))
    X.write(tmp_path / "g.pcap", X.capture([]))
    X.write(tmp_path / "h +%20.pcap", X.capture(packets[:3]))
    plain = lambda df: [
        (r["class"], r["capture_pos"], r["ts_us"], r.get("data"), r.get("offset"), r.get("error")) for r in rows(df)
    ]
    whole = captures.first_packets_of_files(spark, str(tmp_path), "file")
    index = captures.index_captures(spark, str(tmp_path), "file", range_bytes=range_bytes)
    assert "data" not in index.columns
    assert plain(index) == plain(whole.drop("data"))
    cut = captures.read_captures(spark, str(tmp_path), "file", range_bytes=range_bytes, head_bytes=5)
    assert plain(cut) == plain(captures.good_packets(whole))


def test_first_packets_of_a_huge_file(spark, tmp_path):
    """A sparse file of 3 GiB, and a limit of Spark's own reader of files that plays no part."""
    packets = [(i, tcp_frame(payload=b"x" * i)) for i in range(9)]
    X.write(tmp_path / "web" / "big.pcap", X.capture(packets))
    X.write(tmp_path / "web" / "small.pcap", X.capture(packets[:2]))
    with open(tmp_path / "web" / "big.pcap", "r+b") as big:
        big.truncate(3 << 30)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1000")
    try:
        got = rows(captures.good_packets(captures.first_packets_of_files(spark, str(tmp_path), max_packets=5, min_bytes=400)))
    finally:
        spark.conf.unset(limit)
    assert [(r["capture"], r["capture_pos"], bytes(r["data"])) for r in got] == [("big.pcap", i, f) for i, (_, f) in enumerate(packets[:5])]
    reader = captures.CaptureReader({"path": str(tmp_path), "range_bytes": str(1 << 30)})
    ranges = [item for part in reader.partitions() for item in part.value]
    assert [(item[1], item[4], item[6] - item[5]) for item in ranges[:3]] == [("big.pcap", n, 1 << 30) for n in range(3)]
    assert len(ranges) == 4


def test_filters_reach_the_reader(spark, tmp_path):
    for name, many in (("a", 3), ("b", 30), ("c", 30)):
        X.write(tmp_path / name / "s.pcap", X.capture([(i, tcp_frame()) for i in range(many)]))
    reader = captures.PushingReader({"path": str(tmp_path), "range_bytes": "0"})
    rest = list(
        reader.pushFilters(
            [captures.GreaterThanOrEqual(("length",), 1000), captures.In(("class",), ("b", "a")), captures.LessThan(("pos",), 4)]
        )
    )
    assert [type(f).__name__ for f in rest] == ["LessThan"]
    items = [item for part in reader.partitions() for item in part.value]
    assert [item[0] for item in items] == ["b"] and reader.max_packets == 4
    switch = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(switch)
    try:
        for pushed in ("true", "false"):
            spark.conf.set(switch, pushed)
            files = captures.first_packets_of_files(spark, str(tmp_path))
            asked = files.where("class in ('b', 'c') and capture_pos < 2 and length > 500").select("class", "capture_pos")
            assert sorted(map(tuple, asked.collect())) == [("b", 0), ("b", 1), ("c", 0), ("c", 1)]
    finally:
        spark.conf.set(switch, before)


def test_small_files_share_tasks(tmp_path):
    for i in range(40):
        X.write(tmp_path / "a" / f"{i}.pcap", X.capture([(0, b"x")]))
    of = lambda cores: captures.CaptureReader({"path": str(tmp_path), "parallelism": str(cores)}).partitions()
    assert [len(of(n)) for n in (1, 8)] == [1, 8]
    assert sum(len(p.value) for p in of(8)) == 40
    with pytest.raises(FileNotFoundError):
        captures.CaptureReader({"path": str(tmp_path / "none")}).partitions()


def decoded(spark, frames, link=1):
    data = [("c", "c.pcap", i, i * 1000, len(f), len(f), link, f) for i, f in enumerate(frames)]
    schema = (
        "class string, capture string, capture_pos long, ts_us long, caplen int, origlen int,"
        " linktype int, data binary"
    )
    return spark.createDataFrame(data, schema)


def test_link_and_network_layers(spark):
    v6 = bytes(range(16)), bytes(range(16, 32))
    segment = X.tcp_segment(5000, 443)
    cases = [
        (tcp_frame(), (0, 4, 34, A, 5000, B, 443)),
        (tcp_frame(tags=[(0x8100, 5)]), (1, 4, 38, A, 5000, B, 443)),
        (tcp_frame(tags=[(0x88A8, 5), (0x8100, 6)]), (2, 4, 42, A, 5000, B, 443)),
        (tcp_frame(ip_options=b"\x01" * 8), (0, 4, 42, A, 5000, B, 443)),
        (
            X.ethernet(X.ipv6(*v6, segment), 0x86DD),
            (0, 6, 54, "0001:0203:0405:0607:0809:0a0b:0c0d:0e0f", 5000,
             "1011:1213:1415:1617:1819:1a1b:1c1d:1e1f", 443),
        ),
        (X.ethernet(X.ipv4(A, B, X.udp_datagram(53, 5353), 17)), (0, 4, 34, A, 53, B, 5353)),
    ]
    columns = ["vlan_tags", "ip_version", "l4", "src_ip", "src_port", "dst_ip", "dst_port"]
    got = with_endpoints(decoded(spark, [f for f, _ in cases])).orderBy("capture_pos")
    assert [tuple(r) for r in got.select(*columns).collect()] == [want for _, want in cases]
    raw = with_endpoints(decoded(spark, [X.ipv4(A, B, segment)], link=101)).first()
    assert (raw["ip0"], raw["l4"], raw["src_ip"]) == (0, 20, A)
    for link, ahead in ((12, 0), (228, 0), (0, 4), (108, 4), (113, 16), (276, 20)):
        got = with_endpoints(decoded(spark, [bytes(ahead) + X.ipv4(A, B, segment)], link=link)).first()
        assert (got["ip0"], got["l4"], got["src_ip"], got["dst_ip"]) == (ahead, ahead + 20, A, B)
    assert with_endpoints(decoded(spark, [X.ipv4(A, B, segment)], link=9999)).first()["l4"] is None


def test_ipv6_headers_ahead_of_the_ports(spark):
    v6 = bytes(range(16)), bytes(range(16, 32))
    segment = X.tcp_segment(5000, 443, payload=b"payload")
    hop = lambda follows, units=0: bytes([follows, units]) + bytes(6 + 8 * units)
    fragment = lambda follows, offset, more=1: bytes([follows, 0]) + (offset << 3 | more).to_bytes(2, "big") + bytes(4)
    auth = bytes([6, 4]) + bytes(22)
    chains = [
        (0, hop(6), 62),
        (0, hop(43) + hop(60, 2) + hop(6, 1), 102),
        (44, fragment(6, 0), 62),
        (44, fragment(6, 7), None),
        (60, hop(51) + auth, 86),
        (0, hop(59), None),
        (0, b"".join(hop(60) for _ in range(9)) + hop(6), None),
        (0, hop(6, 30), None),
    ]
    frames = [X.ethernet(X.ipv6(*v6, chain + segment, first), 0x86DD) for first, chain, _ in chains]
    got = with_endpoints(decoded(spark, frames)).orderBy("capture_pos").collect()
    assert [r["l4"] for r in got] == [want for _, _, want in chains]
    assert all((r["src_port"], r["dst_port"], r["proto"]) == (5000, 443, 6) for r in got if r["l4"])
    kept = first_packets(assign_sessions(decoded(spark, frames)))
    fields = decode_headers(kept).orderBy("capture_pos").collect()
    assert [(r["tcp_len"], r["tcp_payload"], r["tcp_srcport"]) for r in fields] == [(7, b"payload".hex(), 5000)] * 4


def test_packets_without_ports_are_left_out(spark):
    frames = [
        X.ethernet(X.ipv4(A, B, b"\x08\x00\x00\x00", 1)),  # ICMP
        X.ethernet(X.ipv4(A, B, X.tcp_segment(1, 2), flags=0x0003)),  # later fragment
        X.ethernet(b"\x00\x01" * 14, 0x0806),  # ARP
        tcp_frame()[:35],  # cut before the ports
        b"",
        tcp_frame(),
    ]
    got = assign_sessions(decoded(spark, frames)).collect()
    assert [r["capture_pos"] for r in got] == [5]


def test_header_fields_of_a_handshake(spark):
    hello = b"\x16\x03\x01\x00\x04abcd"
    split = b"\x16\x03\x03\x00\x0aABCDE"
    rest = b"FGHIJ" + b"\x17\x03\x03\x00\x01z"
    scale = lambda n: b"\x01\x03\x03" + bytes([n])
    frames = [
        tcp_frame(flags=0x02, seq=100, ack=0, window=1000, options=scale(7)),
        tcp_frame(B, A, 443, 5000, flags=0x12, seq=900, ack=101, window=2000, options=scale(3)),
        tcp_frame(flags=0x18, seq=101, ack=901, window=10, payload=hello, pad_to=90),
        tcp_frame(B, A, 443, 5000, flags=0x10, seq=901, ack=110, window=20, payload=split),
        tcp_frame(B, A, 443, 5000, flags=0x18, seq=911, ack=110, window=20, payload=rest),
    ]
    kept = first_packets(assign_sessions(decoded(spark, frames)))
    got = {r["pos"]: r for r in decode_headers(kept).collect()}
    assert {r["flow_key"] for r in got.values()} == {f"{A}-{B}-5000-443-6"}
    assert [got[i]["tcp_window_size"] for i in range(1, 6)] == [1000, 2000, 1280, 160, 160]
    assert [got[i]["tcp_flags_str"] for i in (1, 2)] == ["··········S·", "·······A··S·"]
    assert got[3]["tcp_payload"] == hello.hex() and got[3]["tcp_len"] == 9
    assert got[3]["frame_len"] == 90
    assert (got[3]["tls_record_content_type"], got[3]["tls_record_length"]) == ("22", "4")
    assert got[3]["frame_protocols"] == "eth:ethertype:ip:tcp:tls"
    assert got[3]["tcp_analysis_bytes_in_flight"] == 9
    assert (got[4]["tls_record_length"], got[4]["tcp_reassembled_length"]) == (None, None)
    assert got[4]["tcp_analysis_push_bytes_sent"] == 10
    assert (got[5]["tls_record_length"], got[5]["tcp_reassembled_length"]) == ("10,1", 15)
    assert got[5]["tls_record_content_type"] == "22,23"
    assert got[5]["tcp_analysis_bytes_in_flight"] == 21
    assert got[5]["tcp_analysis_push_bytes_sent"] == 21
    assert [got[i]["frame_time_delta_us"] for i in range(1, 6)] == [0, 1000, 1000, 1000, 1000]


def test_ipv6_and_udp_fields(spark):
    v6 = bytes(16), bytes(15) + b"\x01"
    frames = [
        X.ethernet(X.ipv6(*v6, X.udp_datagram(53, 99, b"query"), 17), 0x86DD),
        X.ethernet(X.ipv4(A, B, X.udp_datagram(53, 99, b"answer"), 17), pad_to=60),
    ]
    got = decode_headers(first_packets(assign_sessions(decoded(spark, frames)))).orderBy("capture_pos")
    six, four = got.collect()
    assert six["ip_version"] is None and six["ip_proto"] is None
    assert six["frame_protocols"] == "eth:ethertype:ipv6:udp"
    assert six["udp_payload"] == b"query".hex() and four["udp_payload"] == b"answer".hex()
    assert (four["udp_length"], four["tcp_len"], four["ip_len"]) == (14, None, 34)
    text = packet_text(got).orderBy("capture_pos").first()["text"]
    assert text.startswith("frame.time_delta: 0.000000, frame.time_relative: 0.000000, frame.len: 67, ")
    assert "ip.version" not in text and text.endswith("udp.payload: " + b"query".hex())


def test_payload_text_is_cut(spark):
    kept = first_packets(assign_sessions(decoded(spark, [tcp_frame(payload=bytes(range(200)))])))
    text = session_text(packet_text(decode_headers(kept))).first()["packets_text"]
    assert text.startswith("<pck>frame.") and text.endswith("tcp.payload: " + bytes(range(64)).hex() + " ")


def test_sessions_survive_a_round_trip(spark, tmp_path):
    """Raw captures to session files, in parts of bounded size, and back."""
    packets = [
        (i // 4, tcp_frame(*((A, B, 5000, 443) if i % 3 else (B, A, 443, 5000)), payload=bytes([i])))
        for i in range(25)
    ]
    v6 = bytes(range(16)), bytes(range(16, 32))
    packets += [(99, X.ethernet(X.ipv6(*v6, X.tcp_segment(5000, 443)), 0x86DD)), (100, tcp_frame(sport=7))]
    X.write(tmp_path / "raw" / "a.b.pcap", X.capture(packets, ">"))
    one = 16 + len(packets[0][1])
    jobs.split_captures(spark, str(tmp_path / "raw"), str(tmp_path / "flow"), part_bytes=10 * one)
    names = {p.name: p for p in (tmp_path / "flow" / "a.b").iterdir()}
    long = "a.b.pcap.TCP_10-0-0-1_5000_10-0-0-2_443.pcap"
    six = "a.b.pcap.TCP_0001-0203-0405-0607-0809-0a0b-0c0d-0e0f_5000_1011-1213-1415-1617-1819-1a1b-1c1d-1e1f_443.pcap"
    assert {n for n in names if not n.startswith(".")} == {long, f"{long}.part1.pcap", f"{long}.part2.pcap", six, "a.b.pcap.TCP_10-0-0-1_7_10-0-0-2_443.pcap"}
    assert (tmp_path / "flow" / "_SUCCESS").exists()
    assert names[long].stat().st_size == 24 + 10 * one
    back = rows(captures.read_captures(spark, str(tmp_path / "flow")))
    own = [r for r in back if r["capture"].startswith(long)]
    assert [(r["ts_us"], bytes(r["data"])) for r in own] == packets[:25]
    parsed = parse_flow_name(spark.createDataFrame([(six,), (long,)], "file_name string")).orderBy("src_ip").collect()
    assert [r["flow_key"].split("-")[0] for r in parsed] == ["0001:0203:0405:0607:0809:0a0b:0c0d:0e0f", A]
    kept = jobs.packets_of_session_files(spark, str(tmp_path / "flow"))
    assert kept.count() == 0  # no part reaches 2 KiB


def test_a_writer_that_fails_leaves_no_files(spark, tmp_path):
    index = decoded(spark, [tcp_frame(), tcp_frame()]).withColumn("pos", F.col("capture_pos"))
    broken = index.withColumn("capture", F.when(F.col("pos") == 0, "a").otherwise(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        captures.write_session_files(broken, str(tmp_path / "flow"))
    assert [p for p in (tmp_path / "flow").rglob("*") if p.is_file()] == []


def test_class_captures_are_in_order(spark, tmp_path):
    frames = [tcp_frame(payload=bytes([i])) for i in range(60)]
    packets = decoded(spark, frames).withColumn("class", F.concat(F.lit("c"), F.col("capture_pos") % 2))
    for mode in ("append", "overwrite"):
        captures.write_class_captures(packets.repartition(5), str(tmp_path / "out"), ["ts_us"], mode=mode)
    back = rows(captures.read_captures(spark, str(tmp_path / "out")))
    assert [(r["class"], bytes(r["data"])) for r in back] == [(f"c{k}", f) for k in (0, 1) for f in frames[k::2]]


def test_compressed_captures_are_read_like_plain_ones(spark, tmp_path):
    """Files of several frames, read whole, in ranges, by place and no further than their first packets."""
    frames = [tcp_frame(payload=bytes([i % 251]) * 40, pad_to=900 + i % 70) for i in range(900)]
    packets = decoded(spark, frames).withColumn("class", F.concat(F.lit("c"), F.col("capture_pos") % 2))
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    captures.write_class_captures(packets, str(plain), ["ts_us"])
    captures.write_class_captures(packets, str(packed), ["ts_us"], compression="zstd")
    files = {p.relative_to(plain): p for p in plain.rglob("*.pcap")}
    assert {p.relative_to(packed) for p in packed.rglob("*.pcap.zst")} == {name.with_name(f"{name.name}.zst") for name in files}
    for name, path in files.items():
        other = packed / name.with_name(f"{name.name}.zst")
        with pa.input_stream(str(other), compression="zstd") as stream:
            assert stream.read() == path.read_bytes()
        assert other.stat().st_size * 4 < path.stat().st_size
    without = ["path"]
    for read in (
        lambda path: captures.read_captures(spark, path),
        lambda path: captures.read_captures(spark, path, range_bytes=5000),
        lambda path: captures.index_captures(spark, path, range_bytes=300_000),
        lambda path: captures.first_packets_of_files(spark, path),
        lambda path: captures.first_packets_of_files(spark, path, max_packets=3, min_bytes=20_000),
    ):
        assert rows(read(str(packed)).drop(*without)) == rows(read(str(plain)).drop(*without)) != []
    none = captures.first_packets_of_files(spark, str(packed), max_packets=3, min_bytes=max(p.stat().st_size for p in files.values()) + 1)
    assert none.count() == 0


def test_lengths_of_compressed_files_are_those_of_the_captures(spark, tmp_path):
    packets = decoded(spark, [tcp_frame(pad_to=700) for _ in range(5)])
    sized = packets.withColumn("capture", F.when(F.col("capture_pos") < 4, "long.pcap").otherwise("short.pcap")).withColumn("pos", F.col("capture_pos"))
    captures.write_session_files(sized, str(tmp_path), compression="zstd")
    assert (tmp_path / "c" / "long.pcap.zst").stat().st_size < 2048
    switch = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(switch)
    try:
        for pushed in ("true", "false"):
            spark.conf.set(switch, pushed)
            for asked in (
                captures.first_packets_of_files(spark, str(tmp_path), min_bytes=2048, max_packets=2),
                captures.first_packets_of_files(spark, str(tmp_path)).where("length >= 2048 and capture_pos < 2"),
            ):
                assert [(r["capture"], r["length"]) for r in rows(asked)] == [("long.pcap", 24 + 4 * 716)] * 2
    finally:
        spark.conf.set(switch, before)


def test_damaged_compressed_captures_do_not_stop_the_job(spark, tmp_path):
    packets = decoded(spark, [tcp_frame(payload=bytes([i])) for i in range(5)])
    captures.write_class_captures(packets.coalesce(1), str(tmp_path), ["ts_us"], compression="zstd")
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "c").glob("*.zst"))[:1])
    X.write(tmp_path / "cut" / "a.pcap.zst", whole[:-3])
    X.write(tmp_path / "holes" / "a.pcap.zst", whole[:9] + b"\xff" * 30 + whole[39:])
    X.write(tmp_path / "none" / "a.pcap.zst", b"")
    X.write(tmp_path / "two" / "a.pcap.zst", whole)
    X.write(tmp_path / "two" / "a.pcap", X.capture([(7, tcp_frame())]))
    index = captures.index_captures(spark, str(tmp_path))
    assert {r["class"] for r in captures.quarantine(index).collect()} == {"cut", "holes", "none"}
    good = captures.good_packets(index)
    assert good.where("class = 'c'").count() == 5
    names = {r["capture"] for r in good.where("class = 'two'").select("capture").distinct().collect()}
    assert names == {"a.pcap", "a.pcap.zst"}
    first = captures.first_packets_of_files(spark, str(tmp_path), max_packets=1)
    assert {r["class"] for r in first.where("error is not null").collect()} == {"cut", "holes", "none"}
    with pytest.raises(Exception, match="no such compression"):
        captures.write_class_captures(packets, str(tmp_path / "more"), ["ts_us"], compression="zip")
