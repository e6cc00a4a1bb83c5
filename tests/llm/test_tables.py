"""Nearest neighbours, web archives, registered queries and the pipeline."""

from __future__ import annotations

import glob
import hashlib
import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from flowloom.llm import crosspolytope, warc
from flowloom.llm.oracles import ORACLES
from flowloom.llm.queries import QUERIES
from flowloom.plans.staging import fresh_path

SF_DIR = "/root/testdata/sf0.001"


def exact(rows, query, k=5):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and np.abs(v).sum() > 0]
    own = dict(usable)
    if query not in own:
        return []
    cosine = lambda a, b: float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
    near = sorted((-round(cosine(own[query], v), 12), i) for i, v in usable if i != query)
    return [i for _, i in near[:k]]


def test_nearest_on_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(200, None), (201, [0.0] * 6), (202, [float("nan")] + [1.0] * 5), (203, [None] + [1.0] * 5)]
    rows += [(None, rows[1][1]), (5, rows[5][1]), (204, [float("inf")] + [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as score", "3 as rank").repartition(4)
    for block in (4096, 4):
        found = crosspolytope.nearest(df, _every(20), block=block).collect()
        by_query = {}
        for row in found:
            by_query.setdefault(row["query_id"], {})[row["rank"]] = row["vec_id"]
        assert set(by_query) == {0, 20, 40, 100, 120}
        for query, got in by_query.items():
            assert [got[r] for r in sorted(got)] == exact(rows, query)


def _every(n):
    from pyspark.sql import functions as F

    return F.col("id") % n == 0


def test_repeated_row_takes_no_other_place(spark):
    same, other = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, same)] * 40 + [(i, same) for i in (2, 3, 4, 20, 21, 22, 23)] + [(i, other) for i in range(30, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = crosspolytope.nearest(df, _every(20)).where("query_id = 20").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 21]


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [-1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = crosspolytope.nearest(df, _every(50)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)]
    assert crosspolytope.nearest(df.where("vec_id = 0"), _every(50)).count() == 0
    assert crosspolytope.nearest(df.where("false"), _every(50)).count() == 0


def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = rows.collect()
    ids, vectors = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    found, total_rows = {}, 0
    for row in crosspolytope.nearest(rows, _every(50)).collect():
        found.setdefault(row["query_id"], set()).add(row["vec_id"])
        total_rows += 1
    assert total_rows == sum(len(ids) for ids in found.values()) == 5 * len(found)
    hit = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        near = vectors @ vectors[at]
        near[at] = -9
        hit += len(found[ids[at]] & set(ids[np.argsort(-near)[:5]].tolist()))
        total += 5
    assert hit / total >= 0.9


SEP = warc.SEPARATOR
PAYLOADS = ["", None, "plain", "x" * 2000, "x" * 2000, SEP + "a" * 1200, f"abc{SEP}def{SEP}", "ends\r\n", "ends\r\n\r\n", "WARC/1.1\r\nfoo"]
PAYLOADS += ["\r\n\r\n\r\nWARC/1.1\r\nq", "é" * 700, "é" * 700, f"5\r\n12\r\n{SEP}\r\n12\r\n", "\r\nWARC/1.1\r\n"]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives_round_trip(spark, compression):
    rows = [(i, f"http://h/{i}", p) for i, p in enumerate(PAYLOADS)] + [(None, None, "no id")]
    pages = spark.createDataFrame(rows, "page_id long, url string, payload string").repartition(3)
    path = fresh_path(spark, "warc")
    warc.write_archives(pages, path, compression=compression)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")  # ranges that begin and end within separators
    try:
        captures = warc.transactions(warc.read_records(spark, path)).collect()
        got = {r["page_id"]: r for r in warc.digest_columns(warc.transactions(warc.read_records(spark, path), with_payload=False)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(captures) == len(got) == len(rows)
    for page, url, payload in rows:
        data = (payload or "").encode()
        assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    assert {p: r["refers_to"] for p, r in got.items() if r["record_type"] == "revisit"} == {3: 4, 11: 12}
    whole = {c["metadata"]["text"].split(":")[1].strip(): c for c in captures}
    assert all(c["request"] and c["response"] and c["metadata"] for c in captures)
    assert bytes(whole["6"]["response"]["payload"]).decode() == PAYLOADS[6]
    assert whole["3"]["response"]["payload"] is None


def test_every_row_of_pages_comes_back(spark):
    big = "x" * 1500
    rows = [(1, "a", "p"), (1, "a", "p"), (1, "b", "p"), (None, "c", ""), (None, "d", ""), (None, "c", ""), (2, None, None)]
    rows += [(3, "e", big), (3, "e", big), (3, "f", big), (4, "g", big), (4, "g", big), (None, "h", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, payload string").repartition(3)
    path = fresh_path(spark, "warc")
    warc.write_archives(pages.selectExpr("*", "1 as occurrence", "2 as copies", "3 as first_id", "4 as refers_to"), path)
    got = warc.digest_columns(warc.transactions(warc.read_records(spark, path))).collect()
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    want = con.sql(f"select {columns} from ({ORACLES['op7_warc']}) q").fetchall()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want)) and len(got) == len(rows)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, payload string")
    path = fresh_path(spark, "warc")
    warc.write_archives(pages, path)
    assert warc.digest_columns(warc.transactions(warc.read_records(spark, path))).count() == 0


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = con.sql(f"select * from ({ORACLES[name]}) q")
    assert sorted(result.columns) == columns
    expected = result.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    as_text = lambda rows: sorted(repr(tuple(None if v is None else str(v) for v in row)) for row in rows)
    assert as_text(df.select(*columns).collect()) == as_text(expected)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("*", "1 as _rank", "2 as _kept")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) > len(before) // 2
        if name == "bpe":
            assert all(r["decoded"] == before[key] and r["n_tokens"] == len(r["ids"]) for key, r in after.items())
            break
        assert docs.columns == columns
        assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "simhash":
            assert len({r["text"] for r in after.values()}) == len(after)
        before = {key: r["text"] for key, r in after.items()}


def test_pipeline_without_rows(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
