from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.functions.numbertext import float_text, seconds_text
from flowloom.operators import evaluation, splitting, tokens
from flowloom.operators.endpoints import flow_key
from flowloom.operators.labelling import (
    TASK_OF_DATASET,
    label_dictionary,
    template_of,
    with_instruction,
)
from flowloom.operators.tlsrecords import with_tls_records
from flowloom.plans.ranks import lowest_per_group, slice_positions

few = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def test_float_text_reads_like_python(spark):
    rng = random.Random(1)
    values = [
        0.0, -0.0, 1.0, 5e-5, 1e-5, 0.0001, 0.001, 1e7, 1e15, 1e16, 1.5e16, 123456789.125, 1e22,
        -2.5e-9, 1e300, math.inf, -math.inf, math.nan, 9999999.5, 12345678.9,
    ]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 16) for _ in range(20000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: r["t"] for r in df.select("i", float_text(F.col("v")).alias("t")).collect()}
    assert [(v, got[i]) for i, v in enumerate(values) if got[i] != repr(v)] == []
    large = [rng.uniform(1, 10) * 10**p for p in range(16, 300)]
    texts = spark.createDataFrame([(v,) for v in large], "v double").select("v", float_text(F.col("v")))
    assert all(float(text) == v for v, text in texts.collect())
    whole = [rng.choice((-1, 1)) * 10 ** rng.uniform(16, 27.9) for _ in range(5000)] + [2.0**k for k in range(54, 93)]
    texts = spark.createDataFrame([(v,) for v in whole], "v double").select("v", float_text(F.col("v")))
    assert [(v, text) for v, text in texts.collect() if text != repr(v)] == []


def test_seconds_text(spark):
    df = spark.createDataFrame([(0,), (1,), (1_500_000,), (-20,), (86_400_000_001,)], "us long")
    got = [r[0] for r in df.select(seconds_text(F.col("us"))).collect()]
    assert got == ["0.000000", "0.000001", "1.500000", "-0.000020", "86400.000001"]


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1))
def test_flow_key_is_the_same_both_ways(spark, ends):
    rows = [(f"10.0.0.{a}", p, f"10.0.0.{b}", q) for a, p, b, q in ends]
    df = spark.createDataFrame(rows, "a string, p int, b string, q int")
    col = F.col
    pair = df.select(
        flow_key(col("a"), col("p"), col("b"), col("q"), F.lit(6)).alias("x"),
        flow_key(col("b"), col("q"), col("a"), col("p"), F.lit(6)).alias("y"),
    )
    assert all(r["x"] == r["y"] for r in pair.collect())


@few
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(0, 10**6)), min_size=1))
def test_slice_positions_match_plain_ranks(spark, rows):
    df = spark.createDataFrame([(g, t, k, i) for i, (g, t, k) in enumerate(rows)], "g int, t int, k int, i int")
    got = slice_positions(df, ["g"], ["t", "k", "i"]).collect()
    want = {}
    for g in {r[0] for r in rows}:
        ordered = sorted((t, k, i) for i, (h, t, k) in enumerate(rows) if h == g)
        want.update({i: n + 1 for n, (_, _, i) in enumerate(ordered)})
    assert {r["i"]: r["pos"] for r in got} == want


def test_slice_positions_of_one_hot_group_with_equal_times(spark):
    df = spark.range(20_000, numPartitions=6).select(
        F.lit("hot").alias("g"), F.lit(7).alias("t"), F.md5(F.col("id").cast("string")).alias("k")
    )
    got = slice_positions(df, ["g"], ["t", "k"]).collect()
    assert [r["k"] for r in sorted(got, key=lambda r: r["pos"])] == sorted(r["k"] for r in got)
    assert sorted(r["pos"] for r in got) == list(range(1, 20_001))


def test_small_classes_are_counted_ahead_of_the_cap(spark):
    rows = spark.range(1000).select(F.lit("big").alias("c"), "id").union(
        spark.range(9).select(F.lit("small").alias("c"), "id")
    )
    got = Counter((r["c"], r["split"]) for r in splitting.split_assign(rows, "c", ["id"], cap=8).collect())
    assert got == {("big", "train"): 6, ("big", "val"): 1, ("big", "test"): 1, **{("small", s): 8 for s in ("train", "val", "test")}}




def test_lowest_per_group_on_a_hot_group(spark):
    df = spark.range(50_000, numPartitions=7).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"),
        F.md5(F.col("id").cast("string")).alias("h"), "id",
    )
    got = lowest_per_group(df, ["g"], ["h", "id"], 25, fan=3).collect()
    for group, member in (("hot", lambda i: i % 10 < 9), ("cold", lambda i: i % 10 == 9)):
        ordered = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(50_000) if member(i))
        assert sorted((r["rank"], r["id"]) for r in got if r["g"] == group) == [
            (n + 1, i) for n, (_, i) in enumerate(ordered[:25])
        ]


@few
@given(st.lists(st.integers(1, 45), min_size=1, max_size=4), st.integers(1, 5))
def test_split_sizes_and_independence_of_partitioning(spark, sizes, parts):
    rows = [(c, c * 1000 + i) for c, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "c int, id int")
    cap = 30
    got = splitting.split_assign(df, "c", ["id"], cap).collect()
    again = splitting.split_assign(df.repartition(parts), "c", ["id"], cap).collect()
    assert Counter(got) == Counter(again)
    for c, n in enumerate(sizes):
        counts = Counter(r["split"] for r in got if r["c"] == c)
        if n < 10:
            assert counts == {s: n for s in splitting.SPLITS}
            continue
        k = min(n, cap)
        hold = math.ceil(0.2 * k)
        test = math.ceil(hold / 2)
        assert counts == Counter({"train": k - hold, "val": hold - test, "test": test})
        assert len({r["id"] for r in got if r["c"] == c}) == k


def test_small_classes_may_stay_in_train(spark):
    df = spark.createDataFrame([(1, i) for i in range(5)] + [(None, 9)], "c int, id int")
    got = splitting.split_assign(df, "c", ["id"], small="train").collect()
    assert {r["split"] for r in got} == {"train"} and len(got) == 5
    with pytest.raises(ValueError):
        splitting.split_assign(df, "c", ["id"], small="drop")


def brute_metrics(pairs):
    labels = sorted({x for p in pairs for x in p})
    rows = []
    for label in labels:
        hits = sum(t == p == label for t, p in pairs)
        support = sum(t == label for t, _ in pairs)
        predicted = sum(p == label for _, p in pairs)
        precision = hits / predicted if predicted else 0.0
        recall = hits / support if support else 0.0
        f1 = 2 * hits / (support + predicted)
        rows.append((precision, recall, f1))
    means = [sum(r[i] for r in rows) / len(rows) for i in range(3)]
    return [sum(t == p for t, p in pairs) / len(pairs), *means]


@few
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=60))
def test_metrics_and_confusion_matrix(spark, pairs):
    df = spark.createDataFrame(pairs, "y_true int, y_pred int")
    got = evaluation.eval_metrics(df).first()
    values = [got[c] for c in ("accuracy", "precision", "recall", "f1")]
    assert values == pytest.approx(brute_metrics(pairs))
    assert all(0 <= v <= 1 for v in values)
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in evaluation.confusion_long(df).collect()}
    labels = {x for p in pairs for x in p}
    assert cells == {(a, b): pairs.count((a, b)) for a in labels for b in labels}
    assert sum(cells.values()) == len(pairs)


def test_argmax_takes_the_first_maximum(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([2.0, -1.0],), ([0.0, math.nan],)], "x array<double>")
    assert [r[0] for r in df.select(evaluation.argmax(F.col("x"))).collect()] == [1, 0, 1]


def brute_best(scores, patience=3):
    best, best_at, waited = None, 0, 0
    for epoch, score in enumerate(scores, 1):
        if best is None or score > best:
            best, best_at, waited = score, epoch, 0
        else:
            waited += 1
        if waited >= patience:
            break
    return len(scores), epoch, best_at, best


@few
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=30), min_size=1, max_size=4), st.sampled_from([1, 2, 5, 4096]))
def test_best_epoch(spark, runs, slice_epochs):
    rows = [(r, e, s / 10) for r, scores in enumerate(runs) for e, s in enumerate(scores, 1)]
    df = spark.createDataFrame(rows, "run int, epoch int, f1 double")
    before = evaluation._SLICE_EPOCHS
    evaluation._SLICE_EPOCHS = slice_epochs
    try:
        got = {r[0]: tuple(r)[1:] for r in evaluation.best_epoch(df).collect()}
    finally:
        evaluation._SLICE_EPOCHS = before
    assert got == {r: brute_best([s / 10 for s in scores]) for r, scores in enumerate(runs)}


def brute_records(segments):
    """Per segment of one gap-free stretch: completed records and the reassembled length."""
    stream = b"".join(segments)
    ends = [sum(map(len, segments[: i + 1])) for i in range(len(segments))]
    results = []
    for j in range(len(segments)):
        total, at, found = ends[j], 0, []
        while at + 5 <= total:
            kind, major, length = stream[at], stream[at + 1], int.from_bytes(stream[at + 3 : at + 5], "big")
            if not (20 <= kind <= 24 and major == 3 and length <= 2**14 + 2048):
                at = min([e for e in ends[: j + 1] if e > at], default=total)
                continue
            if at + 5 + length > total:
                break
            found.append((kind, length, at, at + 5 + length))
            at += 5 + length
        start = ends[j] - len(segments[j])
        mine = [r for r in found if r[3] > start]
        spanning = [e - s for _, _, s, e in mine if s < start]
        results.append(([(k, n) for k, n, _, _ in mine], spanning[0] if spanning else None))
    return results


record = st.builds(
    lambda kind, body: bytes([kind, 3, 3]) + len(body).to_bytes(2, "big") + body,
    st.integers(20, 24), st.binary(max_size=12),
)
pieces = st.lists(st.one_of(record, st.binary(max_size=4)), max_size=60).map(b"".join)


@few
@given(st.lists(st.tuples(pieces, st.lists(st.integers(0, 400), max_size=4)), min_size=1, max_size=4))
def test_tls_records_of_cut_streams(spark, streams):
    rows, want = [], {}
    for flow, (stream, cuts) in enumerate(streams):
        edges = sorted({0, len(stream), *[c for c in cuts if c < len(stream)]})
        segments = [stream[a:b] for a, b in zip(edges, edges[1:])]
        for pos, segment in enumerate(segments, 1):
            rows.append(("c", str(flow), pos, True, True, 0, 0, segment.hex()))
        for pos, result in enumerate(brute_records(segments), 1):
            want[(str(flow), pos)] = result
    schema = (
        "class string, flow_key string, pos int, forward boolean, in_order boolean, overlap long,"
        " stream_run long, payload_hex string"
    )
    got = with_tls_records(spark.createDataFrame(rows, schema))
    assert {
        (r["flow_key"], r["pos"]): (
            [(x["type"], x["length"]) for x in r["tls_records"] or []], r["reassembled_length"]
        )
        for r in got.collect()
    } == want


def test_labels_and_instructions(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "class string")
    got = [tuple(r) for r in label_dictionary(df).orderBy("label").collect()]
    assert got == [("a", 0), ("b", 1)]
    assert template_of("MDD")[1].format(label="dns") == (
        "The traffic category is likely to be recognized as dns."
    )
    with pytest.raises(ValueError):
        template_of("XYZ")
    # Fixed values.
    assert TASK_OF_DATASET == {
        "ustc-tfc-2016": "EMD", "iscx-botnet": "BND", "iscx-vpn-2016": "EVD", "lfett-2021": "EVD",
        "dohbrw-2020": "MDD", "iscx-tor-2016": "TBD", "dapt-2020": "APT",
    }
    tasks = spark.createDataFrame([("EMD",), ("XYZ",)], "task string")
    filled = with_instruction(tasks.where("task = 'EMD'")).first()["instruction"]
    assert "<session>" in filled
    with pytest.raises(Exception, match="no template"):
        with_instruction(tasks).collect()


def test_encoding(spark):
    texts = ["b a  a\tc", " \n ", "a " * 700, "", "zz a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocabulary = tokens.vocab_build(df, "text", size=2)
    assert [tuple(r) for r in vocabulary.orderBy("id").collect()] == [("a", 703, 2), ("b", 1, 3)]
    got = {r["id"]: r for r in tokens.encode_tokens(df, ["id"], "text", vocabulary).collect()}
    assert all(len(r["ids"]) == len(r["mask"]) == 512 for r in got.values())
    assert got[0]["ids"][:5] == [3, 2, 2, 1, 0] and sum(got[0]["mask"]) == 4
    assert got[1]["ids"] == got[3]["ids"] == [0] * 512
    assert got[2]["ids"] == [2] * 512 and got[4]["ids"][:3] == [1, 2, 0]
    own = tokens.encode_with(df, "text", lambda batch: [[len(t)] for t in batch], length=3)
    assert {r["id"]: r["ids"] for r in own.collect()}[0] == [len(texts[0]), 0, 0]
    kept = tokens.encode_tokens(df.withColumn("labels", F.col("id") * 2), ["id"], "text", vocabulary, keep=["labels"])
    assert kept.columns == ["id", "labels", "ids", "mask"]
    assert all(r["labels"] == r["id"] * 2 for r in kept.collect())
    short = tokens.encode_tokens(df, ["id"], "text", vocabulary, length=2)
    assert {r["id"]: r["ids"] for r in short.collect()}[0] == [3, 2]


def test_seeded_shuffle_is_a_permutation(spark):
    df = spark.range(500, numPartitions=3).withColumn("split", F.lit("train"))
    one = splitting.seeded_shuffle(df, ["id"], ["split"]).collect()
    two = splitting.seeded_shuffle(df.repartition(5), ["id"], ["split"]).collect()
    assert Counter(one) == Counter(two)
    ordered = sorted(range(500), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert [r["id"] for r in sorted(one, key=lambda r: r["shuffle_pos"])] == ordered
