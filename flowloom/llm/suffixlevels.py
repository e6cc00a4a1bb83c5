"""Exact removal of repeated byte strings with a logarithmic family of suffix arrays.

A string of ``LENGTH`` bytes is removed where it also starts in a document of a smaller id.

Windows of ``LENGTH`` bytes are grouped by the least hash of the ``GRAM``-byte strings they hold. The
group depends on the window's bytes alone, so equal windows meet in one bucket of groups,
and neighbouring windows mostly share their group: they travel as one piece of text.

1. Texts are cut into chunks, written once. Each lists its groups; groups of a single document
   cannot hold a repeated window and go no further.
2. Pieces of the other groups go to their buckets. There, in order of document ids, batches of
   pieces get a suffix array each; it is merged against the suffix arrays of all earlier levels, where
   a match of ``LENGTH`` bytes or more in a smaller document marks the window. Then the batch becomes
   a level, and levels of equal rank merge into one of the next rank.
3. The marks go back to the chunks, which cut the texts.

All comparisons that decide are made on bytes; hashes only deal out the work.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.bucketed import bucketed

LENGTH = 50
GRAM = 24
# Bytes of text in a chunk, and of text that is hashed at once.
CHUNK_BYTES = 8_000_000
SEGMENT = 1 << 19
# Windows of one piece at most; their marks are the bits of one number.
PIECE = 64
# Windows of a batch in a bucket.
BATCH = 1 << 16
_TURN_BITS = 20
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def _pack(numbers: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A mixed polynomial hash of every string of ``size`` bytes, by doubling."""
    full, length, base = text.astype(np.uint64), 1, _BASE
    done, done_length = None, 0
    rest = size
    while rest:
        if rest & 1:
            if done is None:
                done, done_length = full, length
            else:
                # what is done so far, then the next ``length`` bytes
                many = len(text) - done_length - length + 1
                done = done[:many] * np.uint64(base) + full[done_length : done_length + many]
                done_length += length
        rest >>= 1
        if rest:
            many = len(text) - 2 * length + 1
            full = full[:many] * np.uint64(base) + full[length : length + many]
            length, base = 2 * length, base * base % (1 << 64)
    done = (done ^ (done >> np.uint64(31))) * _MIX
    return done ^ (done >> np.uint64(29))


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    out, size = values, 1
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    shift = width - size
    return np.minimum(out[: len(out) - shift], out[shift:]) if shift else out


class Pieces:
    """Pieces of a chunk: text number, first window, number of windows and group of each."""

    def __init__(self, texts: list[bytes]) -> None:
        parts = []
        held, at = [], 0
        for number, text in enumerate(texts):
            if len(text) < LENGTH:
                continue
            if len(text) > SEGMENT:
                for start in range(0, len(text) - LENGTH + 1, SEGMENT):
                    parts.append(self._segment([(number, start, text[start : start + SEGMENT + LENGTH - 1])]))
                continue
            held.append((number, 0, text))
            at += len(text)
            if at >= SEGMENT:
                parts.append(self._segment(held))
                held, at = [], 0
        if held:
            parts.append(self._segment(held))
        empty = np.zeros(0, np.int64)
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [empty, empty, empty, empty.astype(np.uint64)]
        self.text, self.start, self.many, self.group = columns

    @staticmethod
    def _segment(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(t) for _, _, t in held])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        data = np.frombuffer(b"".join(t for _, _, t in held), np.uint8)
        least = _window_least(_gram_hashes(data, GRAM), LENGTH - GRAM + 1)
        change = np.concatenate(([True], least[1:] != least[:-1]))
        change[begins] = True
        # Windows that reach into the next text begin a stretch of their own, which is dropped.
        over = ends[:-1] - LENGTH + 1
        change[over] = True
        first = np.flatnonzero(change)
        many = np.diff(np.append(first, len(least)))
        owner = np.searchsorted(ends, first, side="right")
        inside = first + LENGTH <= ends[owner]
        first, many, owner = first[inside], many[inside], owner[inside]
        turns = -(-many // PIECE)
        again = np.repeat(np.arange(len(first)), turns)
        turn = np.arange(len(again)) - np.repeat(np.cumsum(turns) - turns, turns)
        start = first[again] + PIECE * turn
        count = np.minimum(many[again] - PIECE * turn, PIECE)
        numbers = np.array([n for n, _, _ in held])[owner[again]]
        offsets = np.array([s for _, s, _ in held])[owner[again]]
        return numbers, start - begins[owner[again]] + offsets, count, (least[start] * _MIX) >> np.uint64(16)


def _bounds(groups: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets sorted groups fall in, and where each begins; a bucket is a range of groups."""
    of = (groups >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    return of[starts].astype(np.int64), starts


def _bucket_of(groups: np.ndarray, buckets: int) -> np.ndarray:
    return ((groups >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


_GROUP_LIST = pa.list_(pa.struct([("bucket", pa.int64()), ("groups", pa.binary()), ("many", pa.binary())]))


def _chunks(docs: DataFrame, id_col: str, text_col: str, buckets: int, chunk_bytes: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << _TURN_BITS
        ids, texts, size, turn = [], [], 0, 0

        def row() -> pa.RecordBatch:
            pieces = Pieces(texts)
            order = np.lexsort((pieces.text, pieces.group))
            group, text = pieces.group[order], pieces.text[order]
            new = np.concatenate(([True], group[1:] != group[:-1])) if len(group) else np.zeros(0, bool)
            own = np.flatnonzero(new)
            # A group of several texts of this chunk is shared whatever other chunks hold.
            last = np.append(own[1:], len(group)) - 1 if len(own) else own
            several = text[own] != text[last]
            groups = group[own]
            listed = []
            at, starts = _bounds(groups, buckets)
            for bucket, begin, end in zip(at.tolist(), starts.tolist(), [*starts[1:].tolist(), len(groups)], strict=True):
                part = groups[begin:end]
                steps = np.diff(part, prepend=np.uint64(0))
                listed.append({"bucket": bucket, "groups": _pack(steps), "many": np.packbits(several[begin:end]).tobytes()})
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            cells = [[task + turn], [ids], [[len(t) for t in texts]], [blob], [listed]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), _GROUP_LIST]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=["chunk", "ids", "sizes", "texts", "listed"]
            )

        for part in slices(batches):
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids.append(key)
                texts.append((text or "").encode())
                size += len(texts[-1]) + 1
                if size >= chunk_bytes:
                    yield row()
                    ids, texts, size, turn = [], [], 0, turn + 1
        if ids:
            yield row()

    schema = "chunk bigint, ids array<bigint>, sizes array<bigint>, texts binary, listed array<struct<bucket:bigint,groups:binary,many:binary>>"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def _shared_groups(rows: pa.Table) -> pa.Table:
    """Of each chunk's groups in one bucket, which are in another text as well: one bit each."""
    lists = [np.cumsum(_unpack(g)) for g in rows.column("groups").to_pylist()]
    sizes = [len(g) for g in lists]
    several = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(rows.column("many").to_pylist(), sizes, strict=True)]
    groups, shared = np.concatenate(lists), np.concatenate(several).astype(bool)
    order = np.argsort(groups, kind="stable")
    same = groups[order][1:] == groups[order][:-1]
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    bits = [np.packbits(part).tobytes() for part in np.split(shared, np.cumsum(sizes)[:-1])]
    return pa.table(
        {"of_chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "size": pa.array(sizes, pa.int64()), "bits": pa.array(bits, pa.binary())}
    )


def _texts_of(chunk: pa.Table) -> tuple[list, list[bytes]]:
    ids, sizes = chunk.column("ids")[0].as_py(), chunk.column("sizes")[0].as_py()
    whole = zstandard.ZstdDecompressor().decompress(chunk.column("texts")[0].as_py())
    ends = np.cumsum(sizes).tolist()
    return ids, [whole[end - size : end] for end, size in zip(ends, sizes, strict=True)]


_PIECE_LIST = pa.list_(
    pa.struct([("bucket", pa.int64()), ("bytes", pa.binary()), ("many", pa.binary()), ("doc", pa.binary()), ("place", pa.binary())])
)


def _pieces_of(chunk: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """The distinct pieces of shared groups by bucket, and where the chunk's texts use them."""
    ids, texts = _texts_of(chunk)
    pieces = Pieces(texts)
    order = np.argsort(replies.column("bucket").to_numpy())
    sizes, bits = replies.column("size").to_pylist(), replies.column("bits").to_pylist()
    flags = [np.unpackbits(np.frombuffer(bits[r], np.uint8), count=sizes[r]) for r in order.tolist()]
    shared = np.concatenate(flags).astype(bool) if flags else np.zeros(0, bool)
    _, which = np.unique(pieces.group, return_inverse=True)
    named = np.array([key is not None for key in ids], bool)
    used = np.flatnonzero(shared[which] & named[pieces.text]) if len(which) else np.zeros(0, np.int64)
    bucket = _bucket_of(pieces.group[used], buckets)
    known: dict[bytes, int] = {}
    docs: list[int] = []
    places, of_bucket = [], []
    text_of, start_of, many_of = (a[used].tolist() for a in (pieces.text, pieces.start, pieces.many))
    for text, start, many, at in zip(text_of, start_of, many_of, bucket.tolist(), strict=True):
        body = texts[text][start : start + many + LENGTH - 1]
        place = known.setdefault(body, len(known))
        if place == len(docs):
            docs.append(ids[text])
            of_bucket.append(at)
        elif ids[text] < docs[place]:
            docs[place] = ids[text]
        places.append(place)
    bodies = list(known)
    by_bucket = np.argsort(np.array(of_bucket, np.int64), kind="stable")
    at = np.array(of_bucket, np.int64)[by_bucket]
    cuts = np.flatnonzero(at[1:] != at[:-1]) + 1 if len(at) else np.zeros(0, np.int64)
    listed = []
    compress = zstandard.ZstdCompressor(level=3).compress
    for rows in np.split(by_bucket, cuts) if len(at) else []:
        mine = [bodies[r] for r in rows.tolist()]
        listed.append(
            {
                "bucket": of_bucket[rows[0]],
                "bytes": compress(b"".join(mine)),
                "many": _pack(np.array([len(m) for m in mine])),
                "doc": _pack(np.array([docs[r] for r in rows.tolist()], np.int64)),
                "place": _pack(rows),
            }
        )
    uses = [_pack(a) for a in (pieces.text[used], pieces.start[used], pieces.many[used], np.array(places, np.int64))]
    return pa.table(
        {
            "chunk": chunk.column("chunk"),
            "uses": pa.array([uses], pa.list_(pa.binary())),
            "listed": pa.array([listed], _PIECE_LIST),
        }
    )


class SuffixArray:
    """Windows of ``text`` in the order of their bytes, equal ones once, each with the least document it starts in."""

    def __init__(self, text: np.ndarray, at: np.ndarray, doc: np.ndarray) -> None:
        keys = self._windows(text, at)
        order = np.lexsort((doc, keys)) if len(at) else at
        keys = keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(at) else np.zeros(0, bool)
        self.text, self.at, self.doc = text, at[order][new], doc[order][new]

    @staticmethod
    def _windows(text: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros(0, f"S{LENGTH}")
        rows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[at]
        return np.ascontiguousarray(rows).view(f"S{LENGTH}").ravel()

    def keys(self) -> np.ndarray:
        return self._windows(self.text, self.at)

    def earliest(self, keys: np.ndarray, nowhere: int) -> np.ndarray:
        """For sorted windows, the least document of the entry that matches in all bytes."""
        own = self.keys()
        place = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return np.where(own[place] == keys, self.doc[place], nowhere)

    @classmethod
    def merged(cls, one: SuffixArray, other: SuffixArray) -> SuffixArray:
        text = np.concatenate((one.text, other.text))
        return cls(text, np.concatenate((one.at, other.at + len(one.text))), np.concatenate((one.doc, other.doc)))


class Levels:
    """Suffix arrays of ranks that fall from first to last; two of one rank merge into one of the next."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, SuffixArray]] = []

    def earliest(self, keys: np.ndarray, nowhere: int) -> np.ndarray:
        out = np.full(len(keys), nowhere)
        for _, level in self.levels:
            out = np.minimum(out, level.earliest(keys, nowhere))
        return out

    def add(self, array: SuffixArray) -> None:
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            array = SuffixArray.merged(self.levels.pop()[1], array)
            rank += 1
        self.levels.append((rank, array))


def _marks(bodies: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For each piece the bits of those windows that also start in a smaller document. Pieces come by document."""
    family = Levels()
    nowhere = np.iinfo(np.int64).max
    marks = np.zeros(len(bodies), np.uint64)
    many = np.array([len(b) - LENGTH + 1 for b in bodies], np.int64)
    batch = (np.cumsum(many) - many) // BATCH
    for rows in np.split(np.arange(len(bodies)), np.flatnonzero(batch[1:] != batch[:-1]) + 1):
        text = np.frombuffer(b"".join(bodies[rows[0] : rows[-1] + 1]), np.uint8)
        sizes = many[rows] + LENGTH - 1
        begin = np.cumsum(sizes) - sizes
        turn = np.arange(int(many[rows].sum())) - np.repeat(np.cumsum(many[rows]) - many[rows], many[rows])
        at, doc = np.repeat(begin, many[rows]) + turn, np.repeat(docs[rows], many[rows])
        array = SuffixArray(text, at, doc)
        keys = array.keys()
        # The least document of each window of the batch, in the batch and in all levels.
        first = np.minimum(array.doc, family.earliest(keys, nowhere))
        earliest = first[np.searchsorted(keys, SuffixArray._windows(text, at))]
        bits = np.where(earliest < doc, np.uint64(1) << turn.astype(np.uint64), np.uint64(0))
        marks[rows] = np.bitwise_or.reduceat(bits, np.cumsum(many[rows]) - many[rows])
        family.add(array)
    return marks


def _decide(rows: pa.Table) -> pa.Table:
    """All pieces of one bucket: per chunk the first document of each piece, and its marks there."""
    first: dict[bytes, int] = {}
    held = []
    for data, many, doc, place in zip(*(rows.column(c).to_pylist() for c in ("bytes", "many", "doc", "place")), strict=True):
        whole, sizes = zstandard.ZstdDecompressor().decompress(data), _unpack(many).astype(np.int64)
        ends = np.cumsum(sizes)
        bodies = [whole[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
        docs = _unpack(doc).view(np.int64).tolist()
        for body, key in zip(bodies, docs, strict=True):
            if first.get(body, key) >= key:
                first[body] = key
        held.append((bodies, place))
    order = sorted(first, key=lambda b: (first[b], b))
    marks = dict(zip(order, _marks(order, np.array([first[b] for b in order], np.int64)).tolist(), strict=True))
    return pa.table(
        {
            "of_chunk": rows.column("chunk"),
            "cells": pa.array(
                [[place, _pack(np.array([first[b] for b in bodies], np.int64)), _pack(np.array([marks[b] for b in bodies], np.uint64))] for bodies, place in held],
                pa.list_(pa.binary()),
            ),
        }
    )


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, last = [], 0
    for start, end in spans:
        out.append(text[last:start])
        last = end
    return b"".join([*out, text[last:]])


def _assemble(chunk: pa.Table, replies: pa.Table) -> Iterator[tuple[int | None, bytes, list[tuple[int, int]]]]:
    """(id, text, removed runs) of every text of the chunk."""
    ids, texts = _texts_of(chunk)
    cells = [[bytes(b) for b in c] for c in replies.column("cells").to_pylist()]
    uses = next((c for c in cells if len(c) == 4), None)
    text, start, many, place = ([_unpack(c).astype(np.int64) for c in uses]) if uses else [np.zeros(0, np.int64)] * 4
    total = int(place.max()) + 1 if len(place) else 0
    first, marks = np.zeros(total, np.int64), np.zeros(total, np.uint64)
    for where, doc, bits in (c for c in cells if len(c) == 3):
        rows = _unpack(where).astype(np.int64)
        first[rows], marks[rows] = _unpack(doc).view(np.int64), _unpack(bits)
    own = np.array([0 if key is None else key for key in ids], np.int64)[text]
    whole = own > first[place]
    # A later document loses all of the piece, the first one its marked windows.
    gone = whole | (marks[place] != 0)
    removed: dict[int, list[tuple[int, int]]] = {}
    for number, begin, size, bits, all_of_it in zip(
        *(a[gone].tolist() for a in (text, start, many, marks[place], whole)), strict=True
    ):
        spans = removed.setdefault(number, [])
        if all_of_it:
            spans.append((begin, begin + size + LENGTH - 1))
        else:
            spans.extend((begin + w, begin + w + LENGTH) for w in range(size) if bits >> w & 1)
    for number, (key, body) in enumerate(zip(ids, texts, strict=True)):
        merged: list[tuple[int, int]] = []
        for begin, end in sorted(removed.get(number, ())):
            if merged and begin <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], end))
            else:
                merged.append((begin, end))
        yield key, body, merged


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (bytes) and spans (removed runs as [start, end) byte places).

    A null text counts as empty, texts of under 50 bytes keep all. Documents without an id lose nothing
    and take nothing from others; ids are compared as 64-bit numbers, and rows of equal ids take nothing
    from each other. Repeated rows are kept; other columns are not read; no rows give no rows.

    ``buckets`` is how many suffix-array families the windows are dealt out to, by default four for each
    of ``spark.sql.shuffle.partitions``: it has to grow with the input as that number does.
    """
    spark = docs.sparkSession
    many = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The written table fixes what a chunk holds; all that follows depends on it alone.
    chunks = bucketed(_chunks(docs, id_col, text_col, many, chunk_bytes), "chunk")
    listed = chunks.select("chunk", F.explode("listed").alias("l")).select("chunk", "l.bucket", "l.groups", "l.many")
    shared = listed.groupBy("bucket").applyInArrow(_shared_groups, "of_chunk bigint, bucket bigint, size bigint, bits binary")
    texts = chunks.select("chunk", "ids", "sizes", "texts")
    # Worked out once for the buckets and once for the chunks, which is cheaper than to keep them.
    pieces = (
        texts.groupBy("chunk")
        .cogroup(shared.groupBy("of_chunk"))
        .applyInArrow(
            lambda chunk, replies: _pieces_of(chunk, replies, many),
            "chunk bigint, uses array<binary>, listed array<struct<bucket:bigint,bytes:binary,many:binary,doc:binary,place:binary>>",
        )
    )
    asked = pieces.select("chunk", F.explode("listed").alias("l")).select("chunk", "l.bucket", "l.bytes", "l.many", "l.doc", "l.place")
    decided = asked.groupBy("bucket").applyInArrow(_decide, "of_chunk bigint, cells array<binary>")
    back = decided.unionByName(pieces.select(F.col("chunk").alias("of_chunk"), F.col("uses").alias("cells")))

    def cut(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        rows = list(_assemble(chunk, replies))
        return pa.table(
            {
                "doc_id": pa.array([key for key, _, _ in rows], pa.int64()),
                "n_bytes": pa.array([len(body) for _, body, _ in rows], pa.int64()),
                "kept": pa.array([_cut(body, spans) for _, body, spans in rows], pa.binary()),
                "spans": pa.array([[list(s) for s in spans] for _, _, spans in rows], pa.list_(pa.list_(pa.int64()))),
            }
        )

    again = chunks.select("chunk", "ids", "sizes", "texts")
    return again.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(
        cut, "doc_id bigint, n_bytes bigint, kept binary, spans array<array<bigint>>"
    )


def digest_columns(found: DataFrame) -> DataFrame:
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select(
        "doc_id",
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

