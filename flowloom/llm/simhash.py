"""Near-duplicates by 64-bit SimHash, found through deletion-variant signatures.

Fingerprints that differ in at most three bits are cut into two halves: one half then differs
in at most one bit. Every half is indexed 32 times, each time with another bit blanked out, so
two such halves share a variant. Rows are brought together by equality of (half, blank, rest),
and the whole fingerprints are compared there.

Rows of equal fingerprints are one node, so exact copies cost nothing. A variant that
more than ``HOT_ROWS`` different fingerprints share is dealt out in blocks; blocks are
compared with one another as rows of their own. From no group more links are
returned than it takes to connect it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.components import components
from flowloom.plans.staging import join_staged, stage_table

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
HALF = 32
HOT_ROWS = 4096
# Shingles whose bits are counted at once.
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles as an unsigned number; 0 without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    whole = b" ".join(words)
    size = min(shingle_words, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), _AT_ONCE):
        pairs = zip(first[at : at + _AT_ONCE], last[at : at + _AT_ONCE], strict=True)
        hashes = np.array([digest(whole[a:b], SEED) for a, b in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(first)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = np.array([fingerprint(t, shingle_words) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {id_type}, fp bigint")


def _variants(nodes: DataFrame) -> DataFrame:
    """64 rows for each fingerprint: the key packs half, blanked bit and the half without that bit."""
    parts = []
    for half, value in enumerate((F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND((1 << HALF) - 1))):
        rest = lambda bit, v=value: v.bitwiseAND(F.lit((1 << HALF) - 1 - (1 << bit)))
        parts += [rest(bit).bitwiseOR(F.lit((half << 37) | (bit << 32))) for bit in range(HALF)]
    return nodes.select("fp", F.explode(F.array(*parts)).alias("key"))


def _close(left: np.ndarray, right: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which pairs differ in at most three bits and belong to this variant: of all variants a pair shares, one."""
    differ = left ^ right
    high, low = differ >> np.uint64(HALF), differ & np.uint64((1 << HALF) - 1)
    second = (key >> 37) == 1
    own = np.where(second, low, high)
    blank = np.uint64(1) << ((key >> 32) & 31).astype(np.uint64)
    first_of = (own == blank) | ((own == 0) & (((key >> 32) & 31) == 0))
    return (np.bitwise_count(differ) <= MAX_BITS) & first_of & (~second | (np.bitwise_count(high) > 1))


def _forest(left: np.ndarray, right: np.ndarray, key: int) -> list[tuple[int, int]]:
    """Edges that connect what close pairs of ``left`` and ``right`` connect, no more than there are nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for x in left:
        for y in right[_close(np.full(len(right), x), right, np.full(len(right), key))]:
            a, b = find(int(x)), find(int(y))
            if a != b:
                root[b] = a
                out.append((int(x), int(y)))
    return out


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _link_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges within runs of equal (key, block); rows come sorted, a run may lie over several batches."""
    held_key = held_fp = held_block = None

    def link(key: np.ndarray, block: np.ndarray, fp: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))
        sizes = ends - starts
        two = starts[sizes == 2]
        close = _close(fp[two], fp[two + 1], key[two])
        edges = list(zip(fp[two][close].tolist(), fp[two + 1][close].tolist(), strict=True))
        for start, end in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist(), strict=True):
            run = fp[start:end]
            edges += _forest(run, run, int(key[start]))
        return edges

    for batch in batches:
        key, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        fp = batch.column(2).to_numpy().view(np.uint64)
        if not len(key):
            continue
        if held_key is not None:
            key, block, fp = np.concatenate((held_key, key)), np.concatenate((held_block, block)), np.concatenate((held_fp, fp))
        last = int(np.flatnonzero((key != key[-1]) | (block != block[-1]))[-1]) + 1 if np.any((key != key[-1]) | (block != block[-1])) else 0
        if last:
            yield _edge_batch(link(key[:last], block[:last], fp[:last]))
        held_key, held_block, held_fp = key[last:], block[last:], fp[last:]
    if held_key is not None:
        yield _edge_batch(link(held_key, held_block, held_fp))


def _link_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 16):
        for key, left, right in zip(*(c.to_pylist() for c in part.columns), strict=True):
            yield _edge_batch(_forest(np.array(left, np.int64).view(np.uint64), np.array(right, np.int64).view(np.uint64), key))


def links(nodes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b): links between different fingerprints of ``nodes`` (column fp, each once) that connect all close ones."""
    variants = _variants(nodes)
    hot = stage_table(
        variants.groupBy("key").count().where(F.col("count") > hot_rows).select("key", F.col("count").alias("n")), "hot"
    )
    blocks: Column = F.ceil(F.coalesce("n", F.lit(1)) / hot_rows).cast("int")
    dealt = variants.join(hot, "key", "left").select(
        "key", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"), "fp", F.col("n").isNotNull().alias("is_hot")
    )
    within = (
        dealt.select("key", "block", "fp")
        .repartition("key", "block")
        .sortWithinPartitions("key", "block")
        .mapInArrow(_link_runs, "a bigint, b bigint")
    )
    packed = dealt.where("is_hot").groupBy("key", "block").agg(F.collect_list("fp").alias("fps"))
    packed = stage_table(packed, "blocks")
    other = packed.select("key", F.col("block").alias("other"), F.col("fps").alias("others"))
    across = (
        packed.join(other, "key")
        .where(F.col("block") < F.col("other"))
        .select("key", "fps", "others")
        .repartition(F.xxhash64("key", "fps"))
        .mapInArrow(_link_blocks, "a bigint, b bigint")
    )
    return within.unionByName(across)


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, fp, component_id) for each row: component_id is the least id that links reach.

    Texts without words (null, empty, blank) share fingerprint 0. A null id takes part but is never
    the least. Repeated rows are kept; other columns are not read. No rows give no rows.
    """
    own = stage_table(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = stage_table(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes.select("fp")))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stage_table(rooted.withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return join_staged(own, rooted.join(least, "root").select("fp", "component_id"), ["fp"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each class of near-duplicates: that of the least id. All columns stay.

    Of repeated rows of that id one stays. Rows whose id is null have no name to keep them by and all stay.
    """
    found = classes(docs, id_col, text_col, shingle_words).where(F.col("doc_id") == F.col("component_id"))
    ids = stage_table(found.select(F.col("doc_id").alias(id_col)).distinct(), "kept")
    kept = docs.join(ids.hint("merge"), id_col, "left_semi")
    # Ranks lie on the join's own partitioning; a column of docs may have any name, so the rank gets a free one.
    rank = "_rank"
    while rank in docs.columns:
        rank += "_"
    order = Window.partitionBy(id_col).orderBy(F.md5(F.coalesce(text_col, F.lit(""))))
    first = kept.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)
    return first.unionByName(docs.where(F.col(id_col).isNull()))


def digest_columns(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
