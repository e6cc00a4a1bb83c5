"""Decontamination, BPE, toxicity, SimHash, line runs and byte strings against plain loops."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from flowloom.llm import bpe, decontaminate, lineruns, simhash, suffixlevels, toxicity

WORDS = ["the", "of", "Anna", "tion", "é", "中", "and", "x1", "re"]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", ".", ","]) for _ in range(n))


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# -- decontamination


def brute_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, ids = set(), set()
    for key, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in item or ""))
        size = min(10, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            for place in range(len(words) - size + 1):
                if words[place : place + size] == own[at : at + size]:
                    hit.update(range(place, place + size))
                    ids.add(key)
    return len(words), len(hit), ids


ITEMS = [(1, prose(1, 14)), (2, prose(1, 14)), (3, "The End"), (4, ""), (5, None), (10, prose(2, 30)), (7, "é é"), (7, "re re x1")]


@pytest.mark.parametrize("shard_words", [200_000, 25])
def test_decontaminate(spark, docs_of, shard_words):
    rows = [(i, prose(100 + i, 40) + " " + prose(1 + i % 2, 20 - i % 9) + " the end") for i in range(12)]
    rows += [(50, ""), (51, None), (None, prose(1, 14)), (3, rows[3][1]), (60, "…!?"), (61, prose(1, 9))]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.digest_columns(decontaminate.scan(docs_of(rows), items, shard_words=shard_words)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for row in got:
        n, hit, ids = brute_hits(texts[row["doc_id"]], ITEMS)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(ids))
        assert row["items_sha256"] == sha(",".join(sorted(map(str, ids)))) and row["contaminated"] == (hit > 0)


def test_decontaminate_without_rows(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of([(1, "the end")])
    assert decontaminate.scan(docs.where("false"), items).count() == 0
    assert [r["runs"] for r in decontaminate.scan(docs, items.where("false")).collect()] == [[]]


def test_clean_cuts_and_drops(spark, docs_of):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    leak = "One two, three four five six seven eight nine TEN"
    fine = " ".join(f"w{i}" for i in range(30))
    docs = docs_of([(1, leak), (2, f"{fine} {leak}! {fine}"), (3, fine), (4, None)]).selectExpr("*", "length(text) as n_chars")
    got = {r["doc_id"]: r for r in decontaminate.clean(docs, items).collect()}
    assert set(got) == {2, 3, 4}
    assert got[2]["text"] == f"{fine} ! {fine}" and got[2]["n_chars"] == len(got[2]["text"]) and got[3]["text"] == fine


def test_clean_is_the_same_with_several_automata(spark, docs_of):
    chain = prose(1, 60).split()
    items = [(i, " ".join(chain[i : i + 10])) for i in range(0, 51, 5)]
    items = spark.createDataFrame(items, "item_id long, text string")
    # Overlapping windows, cuts that bring words together, and documents on both sides of the limit.
    rows = [(i, " ".join([prose(100 + i, 3 + i), *chain[i : i + 12 + i], prose(200 + i, 4)])) for i in range(24)]
    rows += [(50, " ".join([*chain[:5], *chain[20:30], *chain[5:10], prose(7, 30)])), (51, None), (52, ""), (None, " ".join(chain))]
    docs = docs_of(rows).selectExpr("*", "length(text) as n_chars")
    one = decontaminate.clean(docs, items)
    got = decontaminate.clean(docs, items, shard_words=25)
    assert got.columns == docs.columns and got.schema == docs.schema
    by = lambda df: sorted(map(str, df.collect()))
    assert by(got) == by(one) and 4 < one.count() < len(rows)


# -- byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.load_ranks(path), own


@pytest.mark.parametrize("chunk_chars", [50, 10_000])
def test_bpe(spark, docs_of, vocabulary, chunk_chars):
    ranks, own = vocabulary
    rows = [(i, prose(i, 30)) for i in range(10)]
    rows += [(20, ""), (21, None), (22, "   a  b\n\n c\t"), (23, "x" * 5000), (24, "don't we'll \x1c\x85 <|endoftext|>"), (None, "null id"), (3, rows[3][1])]
    got = bpe.encode(docs_of(rows), ranks, public_tokenizers.PATTERN, bpe.digests, bpe.DIGEST_FIELDS, chunk_chars=chunk_chars).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for row in got:
        ids = own.encode_ordinary(texts[row["doc_id"]] or "")
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert row["decoded_sha256"] == sha(texts[row["doc_id"]] or "")
    empty = docs_of(rows).where("false")
    assert bpe.encode(empty, ranks, public_tokenizers.PATTERN, bpe.digests, bpe.DIGEST_FIELDS).count() == 0


def test_long_words_merge_as_short_ones(vocabulary):
    ranks, own = vocabulary
    pick = random.Random(5)
    for _ in range(60):
        word = "".join(pick.choice("abcdeé中x") for _ in range(pick.randint(1, 300))).encode()
        assert bpe.encode_word(word, ranks) == bpe._encode_long(word, ranks) == own._encode_single_piece(word)


# -- toxicity


def test_toxicity(spark, docs_of):
    rows = [(i, prose(i, 30) + (f" awful{i % 3} " if i % 4 == 0 else " fine ") + prose(i + 1, 9)) for i in range(1500)]
    rows += [(5000, ""), (5001, None), (None, "null id")]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1500)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"]]
    assert 200 < len(held) < 400
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held if r["doc_id"] < 1500) >= 0.97 * sum(r["doc_id"] < 1500 for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_toxicity_learns_a_repeated_id_once(spark, docs_of):
    rows = [(i, ("vile hateful " if i % 2 else "kind gentle ") + prose(i, 12)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    own = toxicity.fit(docs_of(rows), labels)
    again = toxicity.fit(docs_of(rows + rows[:3] * 300), labels)
    assert (again.places, again.values, again.intercept) == (own.places, own.values, own.intercept)


def test_toxicity_without_labels(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {0.5}
    assert toxicity.score(docs.where("false"), toxicity.fit(docs.where("false"), labels)).count() == 0


# -- SimHash


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items):
    root = {key: key for key, _ in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, fa in items:
        for b, fb in items:
            if (fa ^ fb).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: find(key) for key, _ in items}


def test_simhash(spark, docs_of):
    rows = []
    for i in range(40):
        long = prose(i // 4, 400).split(" ")
        long[i * 7 % 400] += "q" * (i % 4)
        rows.append((i, "\t".join(long) if i % 3 else "  ".join(long)))
    rows += [(90, ""), (91, None), (92, " \n"), (93, "one two"), (94, "ONE  two"), (95, "É"), (3, rows[3][1])]
    got = simhash.digest_columns(simhash.classes(docs_of(rows))).collect()
    assert len(got) == len(rows)
    prints = {key: brute_fingerprint(text) for key, text in rows}
    want = brute_components(list(prints.items()))
    for row in got:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}" and row["component_id"] == want[row["doc_id"]]
    kept = simhash.keep_one(docs_of(rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))
    assert simhash.classes(docs_of(rows).where("false")).count() == 0


@pytest.mark.parametrize("hot_rows", [4096, 8])
def test_links_connect_all_close_ones(spark, hot_rows):
    pick = random.Random(3)
    center = pick.getrandbits(64)
    prints = {center} | {pick.getrandbits(64) for _ in range(40)}
    while len(prints) < 160:
        flips = sum(1 << b for b in pick.sample(range(64), pick.randint(1, 5)))
        prints.add(pick.choice(sorted(prints)) ^ flips)
    want = brute_components([(p, p) for p in sorted(prints)])
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(nodes, hot_rows).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {p: find(p) for p in prints} == want


# -- repeated line runs


def brute_lines(rows, min_words):
    lines = [(key, n, line) for key, text in sorted(rows) for n, line in enumerate((text or "").split("\n"))]
    gone = set()
    for i in range(len(lines)):
        for j in range(i):
            k = 0
            while (
                i + k < len(lines) and lines[i + k][0] == lines[i][0] and lines[j + k][0] == lines[j][0] and lines[i + k][2] == lines[j + k][2]
            ):
                k += 1
            if sum(len(lines[i + x][2].split()) for x in range(k)) >= min_words:
                gone.update(lines[i + x][:2] for x in range(k))
    return gone


def test_line_runs(spark, docs_of):
    pick = random.Random(11)
    lines = ["", "a b c", "d e f g", "h i", "j", "k l m n o p", *(f"own {i} x" for i in range(20))]
    rows = [(i, "\n".join(pick.choice(lines) for _ in range(pick.randint(1, 14)))) for i in range(30)]
    rows += [(40, rows[3][1]), (41, "a b c\n" * 12), (50, ""), (51, None), (52, "\n\n")]
    gone = brute_lines(rows, 9)
    got = lineruns.digest_columns(docs_of([*rows, (40, rows[3][1])]), min_words=9).collect()
    assert len(got) == len(rows) + 1
    texts = dict(rows)
    for row in got:
        own = (texts[row["doc_id"]] or "").split("\n")
        kept = [line for n, line in enumerate(own) if (row["doc_id"], n) not in gone]
        assert (row["n_lines"], row["n_removed"]) == (len(own), len(own) - len(kept))
        assert row["kept_sha256"] == sha("\n".join(kept))
    docs = docs_of(rows).selectExpr("*", "length(text) as n_chars")
    cleaned = {r["doc_id"]: r for r in lineruns.clean(docs, min_words=9).collect()}
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in cleaned.values())
    assert 40 not in cleaned and 51 in cleaned and lineruns.clean(docs, min_words=9).columns == docs.columns
    assert lineruns.digest_columns(docs_of(rows).where("false")).count() == 0


def test_null_ids_come_first(spark, docs_of):
    passage = " ".join(f"w{i}" for i in range(60))
    got = lineruns.digest_columns(docs_of([(None, passage), (1, passage)])).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {None: 0, 1: 1}


# -- repeated byte strings


def brute_bytes(rows):
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            first[data[p : p + 50]] = min(first.get(data[p : p + 50], key), key)
    out = {}
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < key:
                gone[p : p + 50] = True
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0]) if len(data) else 0
        out[key] = (len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone, strict=False) if not g))
    return out


@pytest.mark.parametrize("buckets", [1, 16])
def test_byte_strings(spark, docs_of, monkeypatch, buckets):
    passage, other = prose(900, 60), prose(901, 40)
    rows = [(i, prose(i, 20) + (passage[i * 3 :] if i % 3 == 0 else "") + prose(500 + i, 10) + other[: 20 * i]) for i in range(20)]
    rows += [(30, "ab" * 300), (31, "x" + "ab" * 100), (32, "=" * 49), (33, "=" * 50), (34, "=" * 2000), (35, ""), (36, None)]
    rows += [(40, rows[0][1]), (41, rows[0][1][5:] + "!"), (42, "é中" * 40), (43, "中é" * 40)]
    want = brute_bytes(rows)
    monkeypatch.setattr(suffixlevels, "BATCH", 256)
    got = suffixlevels.deduplicate(docs_of([*rows, (40, rows[0][1])]), buckets=buckets, chunk_bytes=3000)
    digests = suffixlevels.digest_columns(got).collect()
    assert len(digests) == len(rows) + 1
    for row in digests:
        n, removed, spans, kept = want[row["doc_id"]]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) == (n, removed, spans, sha(kept))


def test_byte_strings_without_ids(spark, docs_of):
    got = suffixlevels.deduplicate(docs_of([(None, "z" * 80), (1, "z" * 80), (2, "z" * 80)])).collect()
    assert {r["doc_id"]: len(r["kept"]) for r in got} == {None: 80, 1: 80, 2: 0}
    assert suffixlevels.deduplicate(docs_of([(1, "z")]).where("false")).count() == 0


def test_levels_merge_geometrically():
    family = suffixlevels.Levels()
    text = np.frombuffer(prose(1, 400).encode(), np.uint8)
    for n in range(7):
        at = np.arange(n * 10, n * 10 + 10)
        family.add(suffixlevels.SuffixArray(text, at, np.full(10, n)))
    assert [rank for rank, _ in family.levels] == [2, 1, 0]
    keys = np.sort(suffixlevels.SuffixArray._windows(text, np.arange(70)))
    assert sorted(family.earliest(keys, 99).tolist()) == sorted(i // 10 for i in range(70))
