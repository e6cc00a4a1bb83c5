"""N-gram joins, spelling variants and hard negatives against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import hardnegatives, ngramjoin, spellings

# -- n-gram join


def gram_set(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def classes_by_loops(rows):
    sets = [(key, gram_set(text)) for key, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, one) in enumerate(sets):
        for j, (_, two) in enumerate(sets[:i]):
            shared = len(one & two)
            if shared and 100 * shared >= 80 * (len(one) + len(two) - shared):
                root[find(i)] = find(j)
    out = []
    for i, (key, own) in enumerate(sets):
        ids = [k for j, (k, _) in enumerate(sets) if find(j) == find(i) and k is not None]
        out.append((key, len(own), (min(ids) if ids else None) if own else key))
    return sorted(out, key=str)


def words_of(seed, n, of=10**6):
    pick = random.Random(seed)
    return [f"w{pick.randrange(of)}" for _ in range(n)]


def edited(words, seed, changes):
    pick, out = random.Random(seed), list(words)
    for at in pick.sample(range(len(out)), changes):
        out[at] = f"e{pick.randrange(10**6)}"
    return out


def odd_texts():
    rows = []
    for group in range(6):
        base = words_of(group, 30 + 40 * group)
        # Changes from none to those that leave a similarity of about 0.6, with pairs on either side of 0.8.
        rows += [(group * 100 + k, "  ".join(edited(base, group * 100 + k, k % (2 + group))).upper()) for k in range(14)]
    template = words_of(50, 150)
    rows += [(1000 + k, " ".join(template + words_of(2000 + k, 30 + k % 9))) for k in range(20)]
    rows += [(3000, ""), (3001, None), (3002, " \n\t"), (3003, "one two"), (3004, "One  TWO"), (3005, "one three"), (None, rows[3][1]), (None, "alone here")]
    for n in range(8, 16):
        own = words_of(4000 + n, n)
        rows += [(4000 + n, " ".join(own)), (4100 + n, " ".join([*own, "more"])), (4200 + n, " ".join(own[:-1]))]
    return [*rows, rows[5], (None, "é " * 4000), (5000, "é " * 4001), (5001, "a\x0bb c d e f"), (5002, "a b c d e f")]


@pytest.mark.parametrize(("tile", "sample"), [(4096, 1 << 21), (3, 200)])
def test_similar_sets(spark, docs_of, monkeypatch, tile, sample):
    rows = odd_texts()
    monkeypatch.setattr(ngramjoin, "MEMBERS", tile)
    got = ngramjoin.classes(docs_of(rows), tile=tile, sample_grams=sample).collect()
    assert sorted((tuple(r) for r in got), key=str) == classes_by_loops(rows)


def test_crowd_of_copies_makes_few_pairs(spark, docs_of):
    base = words_of(1, 200)
    rows = [(k, " ".join(edited(base, k, 1))) for k in range(300)]
    nodes_seen = []
    original = ngramjoin._similar
    try:
        ngramjoin._similar = lambda docs, nodes, pairs, size: nodes_seen.append(pairs.count()) or original(docs, nodes, pairs, size)
        got = ngramjoin.classes(docs_of(rows)).collect()
    finally:
        ngramjoin._similar = original
    assert {r["component_id"] for r in got} == {0}
    assert sum(nodes_seen) < 20 * len(rows)


def test_bitmaps_bound_the_difference():
    sets, pick = ngramjoin.GramSets(), random.Random(3)
    for n in (1, 5, 40, 900):
        one = sets.of(" ".join(words_of(n, n)))
        two = sets.of(" ".join(edited(words_of(n, n), pick.random(), n // 3)))
        bits = [np.frombuffer(ngramjoin.bitmap(x), np.uint64) for x in (one, two)]
        assert ngramjoin._apart(*bits) <= len(np.setxor1d(one, two))


def test_no_documents_to_join(spark, docs_of):
    empty = docs_of([(1, "a")]).where("false")
    assert ngramjoin.classes(empty).count() == 0
    assert spellings.variants(spellings.word_counts(empty)).count() == 0


# -- spelling variants


def variants_by_loops(rows, min_length=6, min_count=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            own = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if key is None else key}:{own}".encode())
            if code % 199 == 0:
                own = own[: code % len(own)] + own[code % len(own) + 1 :]
            counts[own] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}

    def near(a, b):
        cut = lambda w: {w[:i] + w[i + 1 :] for i in range(len(w))}
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return (len(a) - len(b) == 1 and b in cut(a)) or (len(b) - len(a) == 1 and a in cut(b))

    met = {w: [o for o in words if near(w, o)] for w in words}
    best = {w: min(o, key=lambda x: (-words[x], x)) for w, o in met.items() if o}
    form = {w: o for w, o in best.items() if words[o] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(met[w]), words[form[w]] if w in form else None) for w, n in words.items()}


@pytest.mark.parametrize("cell", [1 << 14, 3])
def test_variants(spark, docs_of, cell):
    pick = random.Random(4)
    bases = ["".join(pick.choice("aetoéßxyz÷") for _ in range(n)) for n in (6, 7, 8, 9, 12, 31, 32, 33, 40)]
    pool = []
    for base in bases:
        pool += [base] * 160
        for _ in range(8):
            at, letter = pick.randrange(len(base)), pick.choice("aetoéq")
            made = pick.choice([base[:at] + base[at + 1 :], base[:at] + letter + base[at:], base[:at] + letter + base[at + 1 :]])
            again = made[:at] + pick.choice("xyz") + made[at:]
            pool += [made] * pick.choice([5, 20, 30]) + [again] * pick.choice([4, 5, 6])
    pick.shuffle(pool)
    rows = [(i, " ".join(w.upper() if i % 3 == 0 and w.isascii() else w for w in pool[i::60])) for i in range(60)]
    rows += [(100, None), (101, ""), (None, " ".join(pool[:300])), (102, "1" + "." * 5000), rows[0], (103, "É" * 70000 + " Ÿabcdef")]
    words = spellings.word_counts(docs_of(rows))
    got = {r["word"]: tuple(r)[1:] for r in spellings.variants(words, cell_words=cell, cell_queries=cell).collect()}
    want = variants_by_loops(rows)
    assert got == want
    assert any(v[1] not in (w, v[0]) for w, v in want.items())


def test_trie_search_spends_one_each():
    counts = np.array([[1, 0, 2], [1, 1, 2], [0, 1, 2], [3, 0, 2], [1, 0, 2]])
    query, row = next(spellings.CountTrie(counts).search(np.array([[1, 0, 2], [9, 9, 9]]), np.array([1, 1]), np.array([1, 1])))
    assert sorted(zip(query.tolist(), row.tolist(), strict=True)) == [(0, 0), (0, 1), (0, 2), (0, 4)]


# -- hard negatives


def mined_by_loops(rows, every=10, keep=5):
    own = {}
    for key, label, vector in rows:
        if None in (key, label, vector) or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        own[key] = min(own.get(key, (label, vector)), (label, vector))
    whole = {k: (label, [int(np.floor(256 * np.float64(x))) for x in v]) for k, (label, v) in own.items()}
    dot = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True))))
    out = set()
    for key, (label, vector) in whole.items():
        if key % every:
            continue
        others = [(-dot(vector, v), k, kind) for k, (kind, v) in whole.items() if k != key and len(v) == len(vector)]
        for lack, positive, _ in sorted(o for o in others if o[2] == label)[:keep]:
            fit = sorted(o for o in others if o[2] != label and -80 * lack <= -100 * o[0] <= -100 * lack)
            out |= {(key, positive, n + 1, k, -lack, -score) for n, (score, k, _) in enumerate(fit[:keep])}
    return out


def odd_vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 24))
    rows = [(i, i % 4, (centres[i % 6] + rng.normal(size=24) * 0.2).tolist()) for i in range(160)]
    rows += [(200 + i, 9, rows[0][2]) for i in range(9)] + [(300 + i, 1, [0.5, 1.0, float(i % 3)]) for i in range(30)]
    rows += [(400, None, rows[0][2]), (None, 1, rows[0][2]), (401, 2, None), (402, 2, []), (403, 2, [float("nan")] * 24), (404, 2, [None] * 24)]
    rows += [(410, 2, [float("inf")] + [1.0] * 23), (420, 1, [0.0] * 24), (0, 3, rows[0][2]), rows[10], (430, 1, [1e300] * 24), (431, 2, [1e300] * 24)]
    return [*rows, (440, 1, [1e9] * 24), (441, 2, [1e9] * 24), (442, 1, [1e9] * 24)]


@pytest.mark.parametrize("cell", [4096, 7])
def test_hard_negatives(spark, cell):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 as id", "2 as rank", "3 as vector")
    got = hardnegatives.mine(df.repartition(3), F.col("id") % 10 == 0, cell_rows=cell, cell_queries=cell).collect()
    want = mined_by_loops(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100
    assert hardnegatives.mine(df.where("false"), F.col("id") % 10 == 0).count() == 0


def test_intervals_hold_the_score_and_leave_rows_out():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 64))
    rows = np.floor(256 * (centres[np.arange(2000) % 20] + rng.normal(size=(2000, 64)) * 0.1))
    planes, every = hardnegatives.Planes(rows[:20]), np.arange(len(rows))
    scored = {}
    for levels in (1, 4):
        codes, reached = hardnegatives.Codes(rows, levels), 0
        for q in range(20):
            least, most = planes.intervals(q, codes, every)
            exact = rows @ rows[q]
            assert (least <= exact).all() and (exact <= most).all()
            reached += int((most >= np.partition(least, -5)[-5]).sum())
        scored[levels] = reached / (20 * len(rows))
    # Of clustered rows little more than the own cluster, a twentieth, is scored; every code level tells more.
    assert scored[4] < 0.07 and scored[4] < scored[1]
