"""Byte-level BPE over a corpus: every distinct pre-token is encoded once, by a shuffle on the word.

1. Each task cuts its texts into pre-tokens and writes chunks: the distinct words of some
   texts, and each text as the positions of its words in that list.
2. The words of all chunks are shuffled by word and sorted, so each distinct word is encoded
   once for all chunks that use it. The ids go back to their chunks in packs.
3. Chunks and their encoded words meet on the chunk's number; each text's ids are put together
   by position. Decoding looks ids up in the table of token bytes.

A word of a third of all texts is one row per chunk, not one per use. The token table has
as many rows as the vocabulary, which is fixed, so it is sent to all executors.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.bucketed import bucketed

# Texts of one chunk: so many characters, and so many rows.
CHUNK_CHARS = 16_000_000
# A word's number packs its chunk and its place there; a chunk's, its task and its turn.
PLACE_BITS, TURN_BITS = 26, 13
# Encoded words that are held before they are packed by chunk.
PACK_ROWS = 150_000
# Words up to this many bytes are merged by looking at all pairs, longer ones with a heap.
SHORT_WORD = 96


def load_ranks(path: str) -> dict[bytes, int]:
    """A file of ``<token in base64> <rank>`` lines, read by the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: of all adjacent pairs, the leftmost of the lowest rank is merged first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > SHORT_WORD:
        return _encode_long(word, ranks)
    none = 1 << 62
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return [ranks[part] for part in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs over a linked list: n log n in the word's length."""
    size = len(word)
    ends = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    alive = [True] * size
    heap: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        right = ends[at]
        if right < size:
            rank = ranks.get(word[at : ends[right]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, ends[right]))

    for at in range(size - 1):
        offer(at)
    while heap:
        _, at, end = heapq.heappop(heap)
        right = ends[at]
        if not alive[at] or right >= size or ends[right] != end:
            continue  # one of the two parts has been merged meanwhile
        alive[right] = False
        ends[at] = end
        if end < size:
            before[end] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    out, at = [], 0
    while at < size:
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as their byte planes, compressed: upper bytes of small numbers cost next to nothing."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _chunks(docs: DataFrame, pattern: str, id_col: str, text_col: str, chunk_chars: int) -> DataFrame:
    """Rows of (chunk, words, ids, sizes, places): places has the word numbers of all its texts, packed."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern).findall
        task = TaskContext.get().partitionId() << TURN_BITS
        words: dict[str, int] = {}
        ids, sizes, places, chars, turn, kind = [], [], [], 0, 0, None

        def row() -> pa.RecordBatch:
            # Words are numbered by how often they come, which packs best.
            numbers = np.concatenate(places)
            order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            listed = list(words)
            cells = [[task + turn], [[listed[w] for w in order.tolist()]], [ids], [sizes], [_packed(rank[numbers])]]
            types = [pa.int64(), pa.list_(pa.string()), pa.list_(kind), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=["chunk", "words", "ids", "sizes", "places"]
            )

        for part in slices(batches):
            kind = part.schema.field(0).type
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                text = text or ""
                numbers = np.array([words.setdefault(word, len(words)) for word in cut(text)], "<u4")
                ids.append(key)
                sizes.append(len(numbers))
                places.append(numbers)
                chars += len(text) + 1
                if chars >= chunk_chars:
                    yield row()
                    words, ids, sizes, places, chars, turn = {}, [], [], [], 0, turn + 1
        if ids:
            yield row()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"chunk bigint, words array<string>, ids array<{id_type}>, sizes array<int>, places binary"
    )


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    out: Callable[[np.ndarray, list[bytes]], tuple],
    fields: list[tuple[str, str, pa.DataType]],
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row per document: doc_id and what ``out`` makes of its ids and the token-byte table.

    ``ranks`` must hold all 256 single bytes. A null text counts as empty and has no ids, a null
    id passes through, repeated rows are kept, other columns are not read, and an empty table
    gives an empty result. Chunks are written to the shared folder, so a lost executor
    does not make a task cut other chunks than those that are in use.
    """
    spark = docs.sparkSession
    chunks = bucketed(_chunks(docs, pattern, id_col, text_col, chunk_chars), "chunk")
    sent = spark.sparkContext.broadcast(ranks)

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        last, ids = None, []
        held_at: list[np.ndarray] = []
        held_ids: list[list[int]] = []

        def packs() -> pa.RecordBatch:
            at = np.concatenate(held_at)
            order = np.argsort(at, kind="stable")
            chunk = at[order] >> PLACE_BITS
            starts = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
            cells: list[list[bytes]] = [[], [], []]
            for rows in np.split(order, starts[1:]):
                mine = [held_ids[r] for r in rows.tolist()]
                place = at[rows] & ((1 << PLACE_BITS) - 1)
                cells[0].append(_packed(np.diff(place, prepend=0)))
                cells[1].append(_packed(np.array([len(m) for m in mine])))
                cells[2].append(_packed(np.array([i for m in mine for i in m])))
            columns = [pa.array(chunk[starts]), *(pa.array(c, pa.binary()) for c in cells)]
            return pa.RecordBatch.from_arrays(columns, names=["of_chunk", "place", "many", "word_ids"])

        for part in slices(batches, 10_000):
            for word in part.column(1).to_pylist():
                if word != last:  # rows come in order of words
                    last, ids = word, encode_word(word.encode(), table)
                held_ids.append(ids)
            held_at.append(part.column(0).to_numpy())
            if len(held_ids) >= PACK_ROWS:
                yield packs()
                held_at, held_ids = [], []
        if held_ids:
            yield packs()

    uses = chunks.select("chunk", F.posexplode("words").alias("place", "word"))
    by_word = uses.select((F.shiftleft("chunk", PLACE_BITS) + F.col("place")).alias("at"), "word")
    placed = (
        by_word.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(encode_words, "of_chunk bigint, place binary, many binary, word_ids binary")
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", *(name for name, _, _ in fields)]

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        by_token = [b""] * (max(sent.value.values()) + 1)
        for token, rank in sent.value.items():
            by_token[rank] = token
        packs = [[_unpacked(data) for data in right.column(c).to_pylist()] for c in ("place", "many", "word_ids")]
        place = np.concatenate([np.cumsum(p.astype(np.int64)) for p in packs[0]]) if packs[0] else np.zeros(0, np.int64)
        many_of = np.concatenate(packs[1]).astype(np.int64) if packs[1] else place
        flat = np.concatenate(packs[2]) if packs[2] else np.zeros(0, "<u4")
        sizes, starts = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        sizes[place] = many_of
        starts[place] = np.cumsum(many_of) - many_of
        cells: list[list] = [[] for _ in fields]
        keys = []
        for row in range(left.num_rows):
            keys.extend(left.column("ids")[row].as_py())
            numbers = _unpacked(left.column("places")[row].as_py())
            end = 0
            for size in left.column("sizes")[row].as_py():
                own = numbers[end : end + size]
                end += size
                many = sizes[own]
                shift = np.cumsum(many) - many
                ids = flat[np.repeat(starts[own] - shift, many) + np.arange(int(many.sum()))]
                for cell, value in zip(cells, out(ids, by_token), strict=True):
                    cell.append(value)
        key_type = left.schema.field("ids").type.value_type
        return pa.Table.from_arrays(
            [pa.array(keys, key_type), *(pa.array(c, t) for c, (_, _, t) in zip(cells, fields, strict=True))], names=names
        )

    whole = chunks.select("chunk", "ids", "sizes", "places")
    schema = f"doc_id {id_type}, " + ", ".join(f"`{name}` {sql}" for name, sql, _ in fields)
    return whole.groupBy("chunk").cogroup(placed.groupBy("of_chunk")).applyInArrow(assemble, schema)


def decode_ids(ids: np.ndarray, by_token: list[bytes]) -> bytes:
    return b"".join(map(by_token.__getitem__, ids.tolist()))


def digests(ids: np.ndarray, by_token: list[bytes]) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids as 32-bit integers, SHA-256 of the decoded bytes."""
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decode_ids(ids, by_token)).hexdigest()


DIGEST_FIELDS = [
    ("n_tokens", "bigint", pa.int64()),
    ("ids_sha256", "string", pa.string()),
    ("decoded_sha256", "string", pa.string()),
]

TOKEN_FIELDS = [("n_tokens", "bigint", pa.int64()), ("ids", "array<int>", pa.list_(pa.int32())), ("decoded", "string", pa.string())]


def tokens(ids: np.ndarray, by_token: list[bytes]) -> tuple[int, np.ndarray, str]:
    """Number of ids, the ids, and the text they decode to."""
    return len(ids), ids.astype(np.int32), decode_ids(ids, by_token).decode()
