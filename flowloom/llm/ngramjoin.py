"""Documents whose sets of word n-grams have a Jaccard similarity of ``SIMILAR`` or more, by a blocked sparse product.

The incidence matrix has a row for each different set and a column for each n-gram; its product with its own transpose
holds the overlaps. Two sets of n and m n-grams are similar only if their overlap reaches 4/9 (n + m), and only if m is
within 4/5 of n. Columns come in one order for all rows, and the head of a row, its first n - ceil(0.8 n) + 1 columns, meets
the head of every similar row (prefix filtering). The order puts columns that are common in a sample last; it decides
what a run costs, never what it finds.

A crowded column of copies would make a pair of any two of them. Therefore each column's rows first meet
the least row alone. Rows that this has connected, directly or not, are one group already and need not meet again: a
column that lies in one group is done, and in others only rows of different groups meet.

There the product is taken over the heads. Columns of one least row are a block, since copies share most of them;
the rows of a block make tiles of at most about ``TILE`` a side, in bands of sizes, of which only neighbours can be
similar. Overlaps accumulate in a tile. Pairs below the bound are discarded, in the tile by a parity bitmap of each row
whose differing bits are no more than the differing n-grams, and then by the overlap that their heads have gathered
in all blocks plus the most their tails can add. For what is left the product is completed with the whole
rows, so every link is exact.

What few rows of a large table are wanted for is looked up by a bitmap of ``LOOKUP_BITS`` bits, which is sent to
all executors: rows that it rules out are not shuffled. It only saves work, and less where more is wanted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.components import components
from flowloom.plans.staging import join_staged, stage_table

WORDS = 5
# A similarity of 80 of 100.
SIMILAR = (80, 100)
TILE = 4096
# Bits of a row's bitmap.
BITMAP = 1024
LOOKUP_BITS = 1 << 27
# Partners that are compared with one copy of a text.
MEMBERS = 512
# N-grams from which common ones are told, and how often one of them is common.
SAMPLE_GRAMS = 1 << 21
COMMON = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Words whose hashes a task keeps.
_HELD_WORDS = 1 << 18


class GramSets:
    """N-gram sets of texts as sorted numbers of 64 bits; hashes of words are kept between texts."""

    def __init__(self, words_each: int = WORDS) -> None:
        self.size = words_each
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """Fewer words than an n-gram has make one, no words none."""
        words = text.encode().lower().split() if text else []
        if not words:
            return np.array([], np.int64)
        if len(self.known) > _HELD_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.array([known[w] for w in words], np.uint64)
        size = min(self.size, len(words))
        grams = np.full(len(words) - size + 1, size, np.uint64)
        for at in range(size):
            grams = (grams ^ codes[at : len(codes) - size + 1 + at]) * _MIX
            grams ^= grams >> np.uint64(29)
        return np.unique(grams.view(np.int64))


def _name(grams: np.ndarray) -> bytes:
    return blake2b(grams.tobytes(), digest_size=16).digest()


def head_size(size: Column | int) -> Column | int:
    """How many first columns a row meets similar ones by."""
    part, whole = SIMILAR
    return size + size * part // -whole + 1 if isinstance(size, int) else size - F.ceil(size * part / whole) + 1


def bitmap(grams: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of n-grams fall on it, so two bitmaps differ in no more bits than the sets in n-grams."""
    places = (grams.view(np.uint64) * _MIX) >> np.uint64(64 - BITMAP.bit_length() + 1)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=BITMAP) & 1).tobytes()


def _common(docs: DataFrame, words_each: int, sample_grams: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that are common in a sample of texts of about ``sample_grams`` n-grams, and how often they come."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    # A word and its blank take six characters or so.
    share = min(1.0, sample_grams * 6 / max(1, total))
    picked = docs.where(F.pmod(F.xxhash64(F.lit(7), "text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = GramSets(words_each)
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([sets.of(t) for t in part.column(0).to_pylist()]))], names=["gram"])

    counts = picked.select("text").mapInArrow(run, "gram bigint").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    # At most an eighth of the sample comes back.
    rows = sorted((row["gram"], row["n"]) for row in counts.collect())
    return np.array([g for g, _ in rows], np.int64), np.array([n for _, n in rows], np.int64)


def incidence(docs: DataFrame, words_each: int = WORDS, sample_grams: int = SAMPLE_GRAMS) -> DataFrame:
    """(id, text_hash, name, size, bits, head) of ``docs`` (id, text): each row's set by its 128-bit name, its size, bitmap and first columns."""
    sent = docs.sparkSession.sparkContext.broadcast(_common(docs, words_each, sample_grams))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, (common, often) = GramSets(words_each), sent.value
        for part in slices(batches):
            made, heads = [sets.of(t) for t in part.column(2).to_pylist()], []
            for own in made:
                order = own
                if len(common) and len(own):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    order = own[np.argsort(np.where(common[at] == own, often[at], 0), kind="stable")]
                heads.append(order[: head_size(len(own)) if len(own) else 0].tolist())
            columns = [
                *part.columns[:2],
                pa.array([_name(m) for m in made], pa.binary()),
                pa.array([len(m) for m in made], pa.int64()),
                pa.array([bitmap(m) for m in made], pa.binary()),
                pa.array(heads, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "name", "size", "bits", "head"])

    schema = f"id {kind}, text_hash bigint, name binary, size bigint, bits binary, head array<bigint>"
    return docs.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def _needed(a: Column, b: Column) -> Column:
    """The least overlap of similar sets of these sizes: o * 100 >= 80 * (a + b - o)."""
    part, whole = SIMILAR
    return F.ceil((a + b) * part / (part + whole))


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other).sum(axis=-1, dtype=np.int64)


def _may_be_similar(bits: tuple[np.ndarray, np.ndarray], sizes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sizes and bitmaps leave room for an overlap of 4/9 of both sizes, that is, for no more differing n-grams than a ninth."""
    part, whole = SIMILAR
    both = sizes[0] + sizes[1]
    fit = np.minimum(*sizes) * whole >= part * np.maximum(*sizes)
    return fit & (_apart(*bits) * (whole + part) <= both * (whole - part))


def _bitmaps(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(-1, BITMAP // 64)


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(LOOKUP_BITS)) + 1


def _lookup(keys: DataFrame) -> DataFrame:
    """(bucket, bits) for the column ``key``: at most ``LOOKUP_BITS`` bits, in buckets of 4 KB."""
    bit = _bit(F.col("key"))
    marked = keys.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("place"))
    return stage_table(marked.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")), "lookup")


def _looked_up(df: DataFrame, key: Column, lookup: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be one of those of ``lookup``, and few others."""
    bit = _bit(key)
    # The table has a proven bound: 4096 buckets of 4 KB.
    met = df.withColumn("_place", F.bitmap_bit_position(bit)).join(
        F.broadcast(lookup.withColumnRenamed("bits", "_bits")), F.bitmap_bucket_number(bit) == F.col("bucket")
    )
    byte = F.conv(F.hex(F.call_function("substring", "_bits", (F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    within = F.pow(F.lit(2), F.col("_place") % 8).cast("int")
    return met.where(byte.bitwiseAND(within) != 0).select(*df.columns)


def _similar(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words_each: int) -> DataFrame:
    """Of ``pairs`` (a, b) of ``nodes`` those whose whole rows overlap enough; rows are cut anew from one text of each node.

    The texts of up to ``MEMBERS`` partners b come to a copy of the text of a, so texts, which are smaller than
    their rows, are all that moves, and no task holds all partners of a.
    """
    part, whole = SIMILAR
    parts = F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts")
    dealt = stage_table(pairs.join(pairs.groupBy("a").agg(parts), "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts")), "dealt")
    leaders = dealt.select("a", "part", F.lit(0).alias("role"), F.col("a").alias("node")).distinct()
    members = dealt.select("a", "part", F.lit(1).alias("role"), F.col("b").alias("node"))
    key = F.xxhash64("id", "text_hash")
    known = nodes.select("node", "name", "at.id", "at.text_hash").select("node", "name", key.alias("key"))
    wanted = stage_table(leaders.unionByName(members).join(known, "node"), "wanted")
    hashed = docs.select(F.xxhash64("id", F.xxhash64("text")).alias("key"), "text")
    found = _looked_up(hashed, F.col("key"), _lookup(wanted.select("key"))).join(wanted, "key")
    # Repeated rows lie in one partition of the join.
    once = found.dropDuplicates(["key", "a", "part", "role", "node"]).select("a", "part", "role", "node", "name", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = GramSets(words_each)
        for table in _whole_runs(batches, ["a", "part"]):
            place = np.stack([table.column(c).to_numpy() for c in ("a", "part")])
            cuts = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist(), table.num_rows]
            out = []
            for start, end in zip(cuts, cuts[1:], strict=False):
                first = None
                for role, node, name, text in zip(*(table.column(c).slice(start, end - start).to_pylist() for c in ("role", "node", "name", "text")), strict=True):
                    own = sets.of(text)
                    if _name(own) != name:
                        continue  # another text under the same key
                    if role == 0:
                        first = own
                    elif first is not None:
                        shared = len(np.intersect1d(first, own, assume_unique=True))
                        if shared * whole >= part * (len(first) + len(own) - shared):
                            out.append((int(place[0, start]), node))
            both = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    cell = ["a", "part"]
    return once.repartition(*cell).sortWithinPartitions(*cell, "role").mapInArrow(run, "a bigint, b bigint")


def _room(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those whose bitmaps and sizes leave room."""
    side = lambda end: nodes.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("bits").alias(f"bits_{end}"))
    part, whole = SIMILAR
    fit = F.least("size_a", "size_b") * whole >= F.greatest("size_a", "size_b") * part
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(fit)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 4096):
            sizes = tuple(rows.column(c).to_numpy() for c in ("size_a", "size_b"))
            room = _may_be_similar(tuple(_bitmaps(rows.column(c)) for c in ("bits_a", "bits_b")), sizes)
            yield pa.RecordBatch.from_arrays([rows.column(c).filter(pa.array(room)) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "size_a", "size_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint")


def _whole_runs(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``names``; rows come sorted, a run may lie over several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(c).to_numpy() for c in names])
        other = np.flatnonzero((place != place[:, -1:]).any(axis=0))
        last = int(other[-1]) + 1 if len(other) else 0
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in names):
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _tile_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, gathered): pairs of rows in a tile that may be similar, with the overlap of their columns in it.

    Rows are of different groups, and of the tile's two blocks if it has two.
    """
    names = ["least", "low", "high"]
    for table in _whole_runs(batches, names):
        place = np.stack([table.column(c).to_numpy() for c in names])
        cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
        made = []
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), table.num_rows], strict=True):
            own = table.slice(start, end - start)
            node, root, block, size = (own.column(c).to_numpy() for c in ("node", "root", "block", "size"))
            if end - start < 2 or (root == root[0]).all():
                continue
            bits, one_block = _bitmaps(own.column("bits")), place[1, start] == place[2, start]
            lists = own.column("grams").combine_chunks()
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            _, column = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            # Rows by column, so that a row meets only those it shares columns with.
            holder = np.repeat(np.arange(len(node)), np.diff(ends, prepend=0))[np.argsort(column, kind="stable")]
            bounds = np.concatenate(([0], np.cumsum(np.bincount(column))))
            for row in range(len(node) - 1):
                columns = column[ends[row - 1] if row else 0 : ends[row]]
                met = [holder[bounds[c] : bounds[c + 1]] for c in columns.tolist()]
                overlap = np.bincount(np.concatenate(met), minlength=len(node))
                overlap[: row + 1] = 0
                others = np.flatnonzero((overlap > 0) & (root != root[row]) & (one_block | (block != block[row])))
                others = others[_may_be_similar((bits[others], bits[row]), (size[others], np.full(len(others), size[row])))]
                made.append(np.stack([np.minimum(node[others], node[row]), np.maximum(node[others], node[row]), overlap[others]]))
        pairs = np.concatenate(made, axis=1) if made else np.empty((3, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs], names=["a", "b", "gathered"])


def _tiles(rows: DataFrame, tile: int) -> DataFrame:
    """``rows`` (least, least_root, node, root, size, bits, grams) with (low, high, block): once for each tile a row takes part in.

    A crowded block is cut by size bands, by whether a row lies in the group of the least row, and by hash. Tiles
    of that group with itself, and of bands that are not neighbours, hold no pair.
    """
    part, whole = SIMILAR
    crowded = F.col("n") > tile
    many = rows.groupBy("least").agg(F.count("*").alias("n"))
    # Bands are floors of logarithms to the base 5/4: similar sizes lie in one band or in neighbours.
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(whole / part)) + 1e-9).cast("long")
    own = (F.col("root") == F.col("least_root")).cast("long")
    placed = join_staged(rows, many, ["least"]).withColumns(
        {"band": F.when(crowded, band).otherwise(0), "own": F.when(crowded, own).otherwise(0)}
    )
    blocks = stage_table(placed.groupBy("least", "band", "own").agg(F.ceil(F.count("*") / tile).alias("parts")), "blocks")
    number = lambda band, own, part: F.shiftleft(band * 2 + own, 32) + part
    dealt = placed.join(blocks, ["least", "band", "own"]).withColumn(
        "block", number(F.col("band"), F.col("own"), F.pmod(F.xxhash64("node"), F.col("parts")))
    )
    other = blocks.select("least", F.col("band").alias("_band"), F.col("own").alias("_own"), F.col("parts").alias("_parts"))
    near = (F.abs(F.col("band") - F.col("_band")) <= 1) & ((F.col("own") == 0) | (F.col("_own") == 0))
    met = dealt.join(other, "least").where(near).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    target = number(F.col("_band"), F.col("_own"), F.col("_part"))
    return met.select(
        "least", F.least("block", target).alias("low"), F.greatest("block", target).alias("high"), "block", "node", "root", "size", "bits", "grams"
    )


def links(docs: DataFrame, nodes: DataFrame, words_each: int = WORDS, tile: int = TILE) -> DataFrame:
    """(a, b): similar ``nodes``, enough of them to connect all that are similar, each pair checked on whole rows.

    ``nodes`` are (node, at, size, bits, head), where ``at`` tells id and text hash of one of ``docs`` (id, text).
    """
    heads = nodes.select("node", F.explode("head").alias("gram"))
    shared = stage_table(heads.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > 1), "shared")
    rows = _looked_up(heads, F.col("gram"), _lookup(shared.select(F.col("gram").alias("key"))))
    rows = stage_table(rows.join(shared, "gram"), "rows")
    least = stage_table(rows.groupBy("gram").agg(F.min("node").alias("least")), "least")
    others = rows.join(least, "gram").where(F.col("node") != F.col("least"))
    star = stage_table(_room(others.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), nodes), "star")
    edges = stage_table(_similar(docs, nodes, star, words_each), "star_edges")
    groups = stage_table(components(edges), "groups")
    # The least row has met all others of its column, and pairs of two rows are done.
    grouped = join_staged(others.where(F.col("n") > 2).select("gram", "node", "least"), groups, ["node"], "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    spread = grouped.groupBy("gram").agg(F.min("root").alias("one"), F.max("root").alias("two")).where("one < two")
    least_root = groups.select(F.col("node").alias("least"), F.col("root").alias("least_root"))
    left = grouped.join(stage_table(spread.select("gram"), "spread"), "gram")
    left = left.groupBy("least", "node", "root").agg(F.collect_list("gram").alias("grams"))
    left = left.join(least_root, "least", "left").withColumn("least_root", F.coalesce("least_root", "least"))
    left = stage_table(left.join(nodes.select("node", "size", "bits"), "node"), "left")
    cell = ["least", "low", "high"]
    tiles = _tiles(left, tile).repartition(*cell).sortWithinPartitions(*cell)
    pairs = tiles.mapInArrow(_tile_pairs, "a bigint, b bigint, gathered bigint")
    # Rows of different groups meet in every column that both heads have, or have met as a column's least row
    # and were found apart; so the sum is the overlap of the heads, or the pair is none.
    gathered = pairs.groupBy("a", "b").agg(F.sum("gathered").alias("gathered"))
    size = lambda end: nodes.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"))
    tail = lambda end: F.col(f"size_{end}") - head_size(F.col(f"size_{end}"))
    enough = F.col("gathered") + F.greatest(tail("a"), tail("b")) >= _needed(F.col("size_a"), F.col("size_b"))
    due = stage_table(gathered.join(size("a"), "a").join(size("b"), "b").where(enough).select("a", "b"), "due")
    return edges.unionByName(stage_table(_similar(docs, nodes, due, words_each), "tile_edges"))


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_each: int = WORDS,
    tile: int = TILE,
    sample_grams: int = SAMPLE_GRAMS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: component_id is the least id that links reach, the row's own included.

    Texts without words (null, empty, blank) have no shingles and are linked with nothing: their component is their own
    id. A null id takes part but is never the least of a class that has others. Repeated rows are kept; other
    columns are not read. No rows give no rows.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = stage_table(incidence(known, words_each, sample_grams), "incidence")
    # Rows of one name have the same size, bitmap and head.
    nodes = own.where(F.col("size") > 0).groupBy("name").agg(
        F.min(F.struct("id", "text_hash")).alias("at"), F.min("id").alias("least"),
        F.first("size").alias("size"), F.first("bits").alias("bits"), F.first("head").alias("head"),
    )
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = components(links(known, nodes, words_each, tile))
    rooted = nodes.select("name", "node", "least").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage_table(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("name", "component_id")
    joined = join_staged(own.select("id", "name", "size"), named, ["name"], "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), component.alias("component_id"))
