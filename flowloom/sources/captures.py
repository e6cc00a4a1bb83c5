"""Capture files as packets, by a Spark data source, and packets as capture files.

Classic capture format: a 24-byte file header, then per packet a 16-byte record header and the captured bytes.
Files are listed once and cut into byte ranges, which tasks read by path; small files share a task. A range begins
at the first place that looks like a record, and is right if that is where the range before it ended. What is
read of all packets is an index, narrow rows with their place in the file; ranges are checked on it and read again
from the right place where they began wrong, so it equals a sequential read. Bytes are
fetched by place for the packets that are wanted.

Captures can be written compressed, as ``*.pcap.zst`` in the seekable zstd format: frames that are compressed each on
their own and a table of them at the end. Any zstd reader makes the classic file of it, and places count in that file, so
all that is said of ranges and places holds for both.

Paths are opened by Arrow's file systems (local, HDFS, S3, GCS) on every task. A store that they do not know is
given as ``filesystem``: the import path ``module:function`` of a function from a path to an Arrow file system and inner path.
"""

from __future__ import annotations

import importlib
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from flowloom.operators.endpoints import HEAD_BYTES
from flowloom.operators.sessions import CAPTURE_HEADER_BYTES, KEY, RECORD_HEADER_BYTES
from flowloom.plans.ranks import slice_positions
from flowloom.plans.staging import dropped_shuffles, join_staged, stage_table

# File magics as (byte order, ticks per second), and the snap length of a file that names none.
MAGICS = {
    b"\xd4\xc3\xb2\xa1": ("<", 1_000_000),
    b"\xa1\xb2\xc3\xd4": (">", 1_000_000),
    b"\x4d\x3c\xb2\xa1": ("<", 1_000_000_000),
    b"\xa1\xb2\x3c\x4d": (">", 1_000_000_000),
}
SNAP_BYTES = 262_144

FORMAT = "flowloom_capture"
RANGE_BYTES = 64 << 20
# A session file beyond this size goes on in a further part.
PART_BYTES = 1 << 30
# A packet row, or the one row that ends each range: ``is_end``, with the number of its packets as
# ``pos`` and the place behind the last one as ``next``.
RANGE_SCHEMA = (
    "class string, capture string, path string, length long, range_no int, lo long, hi long, start long,"
    " is_end boolean, next long, pos long, ts_us long, offset long, caplen int, origlen int, linktype int, data binary, error string"
)
_ARROW = pa.schema(
    [
        ("class", pa.string()), ("capture", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("range_no", pa.int32()),
        ("lo", pa.int64()), ("hi", pa.int64()), ("start", pa.int64()), ("is_end", pa.bool_()), ("next", pa.int64()),
        ("pos", pa.int64()), ("ts_us", pa.int64()), ("offset", pa.int64()), ("caplen", pa.int32()), ("origlen", pa.int32()),
        ("linktype", pa.int32()), ("data", pa.binary()), ("error", pa.string()),
    ]
)
_RANGE = ["class", "capture", "path", "length", "range_no", "lo", "hi", "start"]
_INT = (1 << 31) - 1
_BATCH_ROWS = 4096
_BATCH_BYTES = 16 << 20
# Headers in a row that make a place look like the start of a record.
_CHAIN = 8
# Bytes read at once from a file, and from one of which only the first packets are wanted.
_BLOCK = 4 << 20
_SMALL_BLOCK = 64 << 10
# What opening a file costs, in bytes.
_OPEN_COST = 256 << 10
# Wanted packets with no more bytes between them are fetched together.
_NEAR = 64 << 10
# Endings of plain and compressed captures.
PLAIN, COMPRESSED = ".pcap", ".pcap.zst"
# Bytes of a capture that are compressed together.
FRAME_BYTES = 256 << 10
# Fixed values of the seekable zstd format: the mark of a frame that other readers skip, and of the end of its table.
_SKIPPED, _TABLE_END = 0x184D2A5E, 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
# Files that are asked at once for their length.
_ASKED = 32


def _file_system(path: str, filesystem: str | None = None) -> tuple[pa.fs.FileSystem, str]:
    """Arrow file system and inner path of a Hadoop-style path."""
    if filesystem:
        module, _, name = filesystem.partition(":")
        return getattr(importlib.import_module(module), name)(path)
    scheme, colon, rest = path.partition(":")
    if scheme == "file" or not re.fullmatch(r"[A-Za-z][A-Za-z0-9+.-]*", scheme) or not colon:
        return pa.fs.LocalFileSystem(), "/" + (rest if scheme == "file" and colon else path).lstrip("/")
    uri = quote(re.sub(r"^s3[an]:", "s3:", path), safe=":/@")
    return pa.fs.FileSystem.from_uri(uri)


class _Places:
    """Bytes of a file by place, read in blocks."""

    def __init__(self, path: str, filesystem: str | None, block: int) -> None:
        opener, inner = _file_system(path, filesystem)
        self.stream, self.block, self.at, self.held = opener.open_input_file(inner), block, 0, b""

    def take(self, at: int, size: int) -> bytes:
        if not self.at <= at <= at + size <= self.at + len(self.held):
            self.at, self.held = self._read(at, max(size, self.block))
        return self.held[at - self.at : at - self.at + size]

    def _read(self, at: int, size: int) -> tuple[int, bytes]:
        self.stream.seek(at)
        return at, self.stream.read(size)

    def close(self) -> None:
        self.stream.close()


class _FramePlaces(_Places):
    """The same for a compressed file; places and ``length`` are those of the bytes before they were compressed."""

    def __init__(self, path: str, filesystem: str | None, block: int) -> None:
        super().__init__(path, filesystem, block)
        try:
            self._read_table()
        except ValueError:
            self.close()
            raise

    def _read_table(self) -> None:
        end = self.stream.size()
        tail = super()._read(max(0, end - _SMALL_BLOCK), _SMALL_BLOCK)[1]
        if len(tail) < _FOOTER.size or (footer := _FOOTER.unpack(tail[-_FOOTER.size :]))[2] != _TABLE_END:
            raise ValueError("not a file in the seekable zstd format")
        many, entry = footer[0], 12 if footer[1] & 0x80 else 8
        size = many * entry + _FOOTER.size
        if len(tail) < size + 8 <= end:
            tail = super()._read(end - size - 8, size + 8)[1]
        if len(tail) < size + 8 or struct.unpack_from("<II", tail, len(tail) - size - 8) != (_SKIPPED, size):
            raise ValueError("damaged table of a compressed file")
        table = np.frombuffer(tail, "<u4", many * entry // 4, len(tail) - size).reshape(many, entry // 4)
        self.places, self.begins = (np.concatenate([[0], np.cumsum(table[:, k], dtype=np.int64)]) for k in (0, 1))
        self.length = int(self.begins[-1])
        if self.places[-1] != end - size - 8:
            raise ValueError("damaged table of a compressed file")

    def _read(self, at: int, size: int) -> tuple[int, bytes]:
        """Whole frames that hold the bytes."""
        if at >= self.length:
            return at, b""
        first, last = int(np.searchsorted(self.begins, at, "right")) - 1, int(np.searchsorted(self.begins, at + size))
        last = min(last, len(self.begins) - 1)
        places, begins = self.places[first : last + 1].tolist(), self.begins[first : last + 1].tolist()
        packed, codec = memoryview(super()._read(places[0], places[-1] - places[0])[1]), pa.Codec("zstd")
        try:
            frames = [
                codec.decompress(packed[lo - places[0] : hi - places[0]], end - begin, asbytes=True)
                for lo, hi, begin, end in zip(places, places[1:], begins, begins[1:])
            ]
        except OSError as problem:
            raise ValueError(f"damaged frame in the bytes from {begins[0]} to {begins[-1]}") from problem
        return begins[0], b"".join(frames)


def _open(path: str, filesystem: str | None, block: int) -> _Places:
    return (_FramePlaces if path.endswith(COMPRESSED) else _Places)(path, filesystem, block)


class _FrameWriter:
    """Compresses what is written to a stream, frame by frame, and ends it with the table of frames."""

    def __init__(self, stream: pa.NativeFile) -> None:
        self.stream, self.codec, self.held, self.table = stream, pa.Codec("zstd"), bytearray(), bytearray()

    def write(self, data: pa.Buffer | bytes) -> None:
        self.held += memoryview(data)
        whole = len(self.held) // FRAME_BYTES * FRAME_BYTES
        self._frames(whole)
        del self.held[:whole]

    def _frames(self, upto: int) -> None:
        for at in range(0, upto, FRAME_BYTES):
            frame = bytes(self.held[at : min(at + FRAME_BYTES, upto)])
            packed = self.codec.compress(frame, asbytes=True)
            self.stream.write(packed)
            self.table += struct.pack("<II", len(packed), len(frame))

    def finish(self) -> None:
        self._frames(len(self.held))
        footer = _FOOTER.pack(len(self.table) // 8, 0, _TABLE_END)
        self.stream.write(struct.pack("<II", _SKIPPED, len(self.table) + len(footer)) + self.table + footer)

    def close(self) -> None:
        self.stream.close()


def _file_header(head: bytes) -> tuple[struct.Struct, int, int, int]:
    """Record header, ticks per second, longest packet and link type, or ValueError."""
    if len(head) < CAPTURE_HEADER_BYTES or head[:4] not in MAGICS:
        raise ValueError("not a capture file")
    order, ticks = MAGICS[head[:4]]
    snap, link = struct.unpack(order + "II", head[16:24])
    return struct.Struct(order + "IIII"), ticks, min(max(snap, SNAP_BYTES), _INT), link & 0xFFFF


def _first_record(file: _Places, row: dict, header: struct.Struct, ticks: int, longest: int) -> int | None:
    """The first place of a range from which some record headers in a row, or all up to the end, make sense.

    Zeros, with which short frames are padded, read as headers of empty records, and a header that is read from the
    wrong place leads beyond the end. Such records count only where no others are found in the room of two long packets.
    """

    def plausible(at: int, least: int) -> bool:
        for _ in range(_CHAIN):
            head = file.take(at, RECORD_HEADER_BYTES)
            if len(head) < RECORD_HEADER_BYTES:
                return not least or at == row["length"]
            _, fraction, caplen, origlen = header.unpack(head)
            if fraction >= ticks or not least <= caplen <= min(origlen, longest):
                return False
            at += RECORD_HEADER_BYTES + caplen
        return True

    near = min(row["hi"], row["lo"] + 2 * (RECORD_HEADER_BYTES + min(longest, SNAP_BYTES)))
    found = (at for upto, least in ((near, 1), (row["hi"], 0)) for at in range(row["lo"], upto) if plausible(at, least))
    return next(found, None)


def _read_range(
    row: dict, head_bytes: int | None, max_packets: int | None, filesystem: str | None, min_bytes: int = 0
) -> Iterator[tuple]:
    """Rows of the records that begin in ``[lo, hi)``, then the row that ends the range.

    Without a known ``start`` the first plausible one is taken. Packets ahead of a damaged
    record are kept; a last record that was cut off while it was written is left out. Without a known ``hi`` the whole
    file is read, if its length is ``min_bytes`` or more.
    """
    start, after, n = row["start"], row["length"], 0
    own = tuple(row[c] for c in _RANGE[:-1])
    file = None
    try:
        file = _open(row["path"], filesystem, _BLOCK if max_packets is None else _SMALL_BLOCK)
        if row["hi"] is None:
            if file.length < min_bytes:
                return
            row = row | {"length": file.length, "hi": file.length}
            own = tuple(row[c] for c in _RANGE[:-1])
        header, ticks, longest, link = _file_header(file.take(0, CAPTURE_HEADER_BYTES))
        if start is None:
            start = CAPTURE_HEADER_BYTES if row["range_no"] == 0 else _first_record(file, row, header, ticks, longest)
        at = after = start
        while at is not None and at < row["hi"] and (max_packets is None or n < max_packets):
            head = file.take(at, RECORD_HEADER_BYTES)
            after = row["length"]
            if len(head) < RECORD_HEADER_BYTES:
                break
            sec, fraction, caplen, origlen = header.unpack(head)
            if caplen > longest:
                raise ValueError(f"record of {caplen} bytes at {at}")
            if at + RECORD_HEADER_BYTES + caplen > row["length"]:
                break
            size = caplen if head_bytes is None else min(caplen, head_bytes)
            data = file.take(at + RECORD_HEADER_BYTES, size)
            yield *own, start, False, None, n, sec * 1_000_000 + fraction * 1_000_000 // ticks, at, caplen, min(origlen, _INT), link, data, None
            n += 1
            at += RECORD_HEADER_BYTES + caplen
            after = at
    except ValueError as problem:
        # One range holds the file header and reports it; nothing beyond a damaged record can be trusted.
        if start is not None or row["range_no"] == 0:
            start, after = start or 0, row["length"]
            yield *own, start, False, None, n, None, None, None, None, None, None, str(problem)
    finally:
        if file is not None:
            file.close()
    yield *own, start, True, after if start is not None else None, n, None, None, None, None, None, None, None


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-2] or b"")
        if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield _to_batch(held)
            held, size = [], 0
    if held:
        yield _to_batch(held)


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(column, type=f.type) for column, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _whole(value: str | None) -> int | None:
    return None if value is None else int(value)


class CaptureSource(DataSource):
    """Spark data source ``flowloom_capture`` of ``*.pcap`` and ``*.pcap.zst`` files below ``path``; see ``RANGE_SCHEMA``.

    Options: ``class_from`` (``directory`` or ``file``), ``range_bytes`` (0: a file is one range), ``head_bytes``
    (of each packet; none: all), ``max_packets`` (of each file, with ``range_bytes`` 0), ``min_bytes`` (of a file),
    ``parallelism``, ``filesystem`` and, where the session has filter pushdown switched on, ``pushdown``.
    Lengths, of files as well, are those of the plain capture. Option for writing: ``compression`` (``none`` or ``zstd``).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RANGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (PushingReader if self.options.get("pushdown") == "true" else CaptureReader)(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return CaptureWriter(self.options["path"], self.options.get("filesystem"), overwrite, self.options.get("compression", "none"))


class CaptureReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.filesystem = options["path"], options.get("filesystem")
        self.class_from = options.get("class_from", "directory")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.head_bytes, self.max_packets = _whole(options.get("head_bytes")), _whole(options.get("max_packets"))
        self.min_bytes, self.parallelism = int(options.get("min_bytes", 0)), int(options.get("parallelism", 1))
        self.classes: set[str] | None = None
        if self.max_packets is not None and self.range_bytes:
            raise ValueError("max_packets needs range_bytes 0")

    def _files(self) -> Iterator[tuple[str, str, str, int]]:
        """Class, name, path and size of the captures, without hidden files and folders.

        A compressed capture has the name of the plain one, unless that lies beside it. Its length is found when it is opened.
        """
        system, inner = _file_system(self.path, self.filesystem)
        top = system.get_file_info(inner)
        if top.type == pa.fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        below = [top] if top.is_file else system.get_file_info(pa.fs.FileSelector(inner, recursive=True))
        root = inner.rstrip("/")
        ahead = self.path.rstrip("/")
        plain = {info.path for info in below if info.is_file and info.base_name.endswith(PLAIN)}
        for info in below:
            local = "" if top.is_file else info.path[len(root) :]
            hidden = any(part.startswith((".", "_")) for part in local.split("/"))
            if not info.is_file or hidden or not info.base_name.endswith((PLAIN, COMPRESSED)):
                continue
            packed = info.base_name.endswith(COMPRESSED)
            bare = info.base_name[: -len(COMPRESSED if packed else PLAIN)]
            folder = info.path.rsplit("/", 2)[-2]
            own = folder if self.class_from == "directory" else bare
            name = info.base_name if packed and info.path[: -len(COMPRESSED)] + PLAIN in plain else bare + PLAIN
            if (packed or info.size >= self.min_bytes) and (self.classes is None or own in self.classes):
                yield own, name, ahead + local, info.size

    def _length(self, path: str, size: int) -> int:
        """Of a capture; a compressed one that cannot be read is left to the task that opens it, which reports it."""
        if not path.endswith(COMPRESSED):
            return size
        try:
            file = _open(path, self.filesystem, _SMALL_BLOCK)
        except ValueError:
            return size
        file.close()
        return file.length

    def partitions(self) -> list[InputPartition]:
        ranges, costs = [], []
        files = sorted(self._files(), key=lambda f: f[2])
        if self.max_packets is not None:
            # Of compressed files no more than the beginning is read; the tasks that open them find their lengths.
            late = [f for f in files if f[2].endswith(COMPRESSED)]
            files = [f for f in files if not f[2].endswith(COMPRESSED)]
            ranges += [(*f, 0, 0, None) for f in late]
            costs += [_OPEN_COST] * len(late)
        else:
            with ThreadPoolExecutor(_ASKED) as pool:
                sizes = pool.map(lambda f: self._length(*f[2:]), files)
                files = [(*f[:3], size) for f, size in zip(files, sizes, strict=True) if size >= self.min_bytes]
        for own, name, path, size in files:
            step = self.range_bytes or max(1, size)
            for number, lo in enumerate(range(0, max(1, size), step)):
                ranges.append((own, name, path, size, number, lo, min(size, lo + step)))
                costs.append(_OPEN_COST + (min(size, lo + step) - lo if self.max_packets is None else 0))
        bound = min(RANGE_BYTES, max(_OPEN_COST, sum(costs) // max(1, self.parallelism)))
        parts, held, total = [], [], 0
        for item, cost in zip(ranges, costs, strict=True):
            if held and total + cost > bound:
                parts.append(InputPartition(held))
                held, total = [], 0
            held.append(item)
            total += cost
        return [*parts, InputPartition(held)] if held or not parts else parts

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for item in partition.value:
                row = dict(zip(_RANGE, (*item, None), strict=True))
                yield from _read_range(row, self.head_bytes, self.max_packets, self.filesystem, self.min_bytes)

        yield from _batches(rows())


class PushingReader(CaptureReader):
    """Lists only the files, and reads only the packets, that filters on class, length and position leave."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for wanted in filters:
            kind, column = type(wanted), wanted.attribute if hasattr(wanted, "attribute") else ()
            if column == ("class",) and kind in (EqualTo, In):
                own = {wanted.value} if kind is EqualTo else set(wanted.value)
                self.classes = own if self.classes is None else self.classes & own
            elif column == ("length",) and kind in (GreaterThan, GreaterThanOrEqual):
                self.min_bytes = max(self.min_bytes, wanted.value + (kind is GreaterThan))
            elif column == ("pos",) and kind in (LessThan, LessThanOrEqual) and not self.range_bytes:
                many = max(0, wanted.value + (kind is LessThanOrEqual))
                self.max_packets = many if self.max_packets is None else min(many, self.max_packets)
                yield wanted  # the row that ends a range has a position of its own
            else:
                yield wanted


class _Written(WriterCommitMessage):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


# Little-endian file header, version 2.4, microseconds.
def _new_header(link: int) -> bytes:
    return struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, SNAP_BYTES, link)


def _records(batch: pa.RecordBatch) -> tuple[pa.Buffer, list[int]]:
    """The packets of a batch as records one after the other, and the places where they begin and the last one ends."""
    if any(batch.column(c).null_count for c in ("ts_us", "caplen", "origlen", "data")):
        raise TypeError("a packet without its time, lengths or bytes")
    n = batch.num_rows
    ts_us, *sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ts_us", "caplen", "origlen"))
    if n and min(size.min() for size in sizes) < 0:
        raise ValueError("a packet of negative length")
    sec, us = np.divmod(ts_us, 1_000_000)
    heads = np.stack([sec & 0xFFFFFFFF, us, *sizes], axis=1).astype("<u4")
    at = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * RECORD_HEADER_BYTES)
    headers = pa.Array.from_buffers(pa.binary(), n, [None, at, pa.py_buffer(heads)])
    whole = pc.binary_join_element_wise(headers, batch.column("data").cast(pa.binary()), pa.scalar(b"", pa.binary()))
    bounds = np.frombuffer(whole.buffers()[1], np.int32, n + 1, whole.offset * 4)
    return whole.buffers()[2] or pa.py_buffer(b""), bounds.tolist()


def _runs(columns: list[pa.Array]) -> Iterator[tuple[int, int]]:
    """Begin and end of the stretches of rows whose columns stay the same."""
    n = len(columns[0])
    changed = np.zeros(max(0, n - 1), bool)
    for column in columns:
        if n > 1:
            changed |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), n] if n else []
    yield from zip(edges, edges[1:])


class CaptureWriter(DataSourceArrowWriter):
    """Writes rows (class, capture, ts_us, caplen, origlen, linktype, data) as ``<path>/<class>/<capture>``.

    Rows of a file come one after the other, in one task. A file appears under its name when it is whole; the job's
    commit adds ``_SUCCESS``, and a job that fails removes the files of the tasks that had finished. With
    ``compression="zstd"`` names end in ``.zst``.
    """

    def __init__(self, path: str, filesystem: str | None, overwrite: bool, compression: str = "none") -> None:
        if compression not in ("none", "zstd"):
            raise ValueError(f"no such compression of captures: {compression}")
        self.path, self.filesystem, self.compressed = path.rstrip("/"), filesystem, compression == "zstd"
        if overwrite:
            system, inner = _file_system(self.path, filesystem)
            system.delete_dir_contents(inner, missing_dir_ok=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _file_system(self.path, self.filesystem)
        done: list[str] = []
        folders: set[str] = set()
        stream = None
        name = draft = ""

        def close() -> None:
            if self.compressed:
                stream.finish()
            stream.close()
            if draft != name:
                system.move(draft, name)
            done.append(name)

        try:
            for batch in iterator:
                records, bounds = _records(batch)
                names = [batch.column(c).fill_null("None") for c in ("class", "capture")]
                for first, last in _runs(names):
                    own, capture = (c[first].as_py() for c in names)
                    target = f"{root}/{own}/{capture}" + (".zst" if self.compressed else "")
                    if target != name:
                        if stream is not None:
                            close()
                            stream = None
                        name = target
                        # Object stores show a file only when it is whole, and cannot move one.
                        whole = system.type_name in ("s3", "gcs", "abfs")
                        draft = name if whole else f"{root}/{own}/.{uuid.uuid4().hex}"
                        if own not in folders:
                            system.create_dir(f"{root}/{own}", recursive=True)
                            folders.add(own)
                        stream = system.open_output_stream(draft, buffer_size=1 << 20)
                        if self.compressed:
                            stream = _FrameWriter(stream)
                        stream.write(_new_header(batch.column("linktype")[first].as_py()))
                    stream.write(records.slice(bounds[first], bounds[last] - bounds[first]))
            if stream is not None:
                close()
                stream = None
        finally:
            if stream is not None:
                stream.close()
                if draft != name:
                    system.delete_file(draft)
        return _Written(done)

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = _file_system(self.path, self.filesystem)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[_Written | None]) -> None:
        system, _ = _file_system(self.path, self.filesystem)
        for message in messages:
            for path in message.paths if message is not None else ():
                system.delete_file(path)


def capture_ranges(spark: SparkSession, path: str, class_from: str = "directory", **options: object) -> DataFrame:
    """Rows of the data source; ``options`` that are None are left out."""
    spark.dataSource.register(CaptureSource)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format(FORMAT).option("class_from", class_from).option("pushdown", pushed)
    reader = reader.option("parallelism", str(spark.sparkContext.defaultParallelism))
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load(path)


def first_packets_of_files(
    spark: SparkSession,
    path: str,
    class_from: str = "directory",
    max_packets: int | None = None,
    min_bytes: int = 0,
    filesystem: str | None = None,
) -> DataFrame:
    """The first packets of every capture of ``min_bytes`` or more, with an ``error`` row per unreadable file.

    Files are read one after the other within a task, and no further than the last packet that is wanted.
    """
    rows = capture_ranges(spark, path, class_from, range_bytes=0, max_packets=max_packets, min_bytes=min_bytes, filesystem=filesystem)
    rows = rows.where((F.col("length") >= min_bytes) & ~F.col("is_end"))
    return rows.withColumnRenamed("pos", "capture_pos").drop("range_no", "lo", "hi", "start", "is_end", "next")


def _read_again(ranges: DataFrame, head_bytes: int, filesystem: str | None) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(_read_range(row, head_bytes, None, filesystem))

    # A number of parts of our own: few short rows would be read by one task, and each is a range to read.
    return ranges.select(*_RANGE).repartition(max(1, ranges.count()), "path", "range_no").mapInArrow(read, RANGE_SCHEMA)


def _settled(ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the ends of ranges: those that are right, with their first position, and those to be read again.

    A range is right if it starts where the one before it ended; the first starts behind the file header. One that
    the record before it covers holds no start of its own. What follows a range that is still to be read waits.
    """
    before = Window.partitionBy("path").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    due = F.last("next", ignorenulls=True).over(before)
    known = ends.withColumn("_due", due).withColumn("_wrong", (F.col("range_no") > 0) & ~F.col("start").eqNullSafe(F.col("_due")))
    covered = F.col("_wrong") & (F.col("_due") >= F.col("hi"))
    again = known.where(F.col("_wrong") & ~covered & (F.col("_due") >= F.col("lo"))).withColumn("start", F.col("_due"))
    # Should the range before it turn out to end earlier, its start is no longer the right one.
    counted = known.withColumns(
        {
            "start": F.when(covered, F.col("_due")).otherwise(F.col("start")),
            "pos": F.when(covered, 0).otherwise(F.col("pos")),
            "next": F.when(~covered, F.col("next")),
            "attempt": F.when(covered, -1).otherwise(F.col("attempt")),
        }
    )
    kept = counted.withColumn("first_pos", F.coalesce(F.sum("pos").over(before), F.lit(0)))
    return kept.select(*_RANGE, "next", "pos", "attempt", "first_pos"), again.select(*_RANGE)


def index_captures(
    spark: SparkSession,
    path: str,
    class_from: str = "directory",
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    range_bytes: int = RANGE_BYTES,
    head_bytes: int = HEAD_BYTES,
    filesystem: str | None = None,
) -> DataFrame:
    """All packets of all captures below ``path`` without their bytes, with an ``error`` row per unreadable file.

    ``class, capture, path, capture_pos, ts_us, offset, caplen, origlen, linktype, error`` and what ``shape``, which sees
    the first ``head_bytes`` of each packet as ``data``, adds to them. The rows are staged. Only files of
    several ranges need the check of their ranges, on one row for each.
    """
    read = capture_ranges(spark, path, class_from, range_bytes=range_bytes, head_bytes=head_bytes, filesystem=filesystem)
    rows = stage_table(shape(read).drop("data").withColumn("attempt", F.lit(0)), "index")
    several = F.col("length") > range_bytes
    names = [*_RANGE, "next", "pos", "attempt"]
    ends = stage_table(rows.where(F.col("is_end") & several).select(*names), "ends")
    turn = 0
    while True:
        settled, again = _settled(ends)
        settled, again = stage_table(settled, "settled"), stage_table(again, "again")
        if again.isEmpty():
            break
        turn += 1
        # Ranges that began in the wrong place are few; what was read of them is left aside by its attempt.
        more = stage_table(shape(_read_again(again, head_bytes, filesystem)).drop("data").withColumn("attempt", F.lit(turn)), "index")
        rows = rows.unionByName(more)
        place = ["path", "range_no"]
        kept = settled.drop("first_pos").join(again.select(*place), place, "left_anti")
        ends = stage_table(kept.unionByName(more.where("is_end").select(*names)), "ends")
    packets = rows.where(~F.col("is_end"))
    right = settled.select("path", "range_no", "attempt", "first_pos")
    large = join_staged(packets.where(several), right, ["path", "range_no", "attempt"])
    both = packets.where(~several).withColumn("first_pos", F.lit(0)).unionByName(large)
    placed = both.withColumn("capture_pos", F.col("first_pos") + F.col("pos"))
    return placed.drop("length", "range_no", "lo", "hi", "start", "is_end", "next", "pos", "attempt", "first_pos")


def fetch_packets(rows: DataFrame, filesystem: str | None = None, fetch_bytes: int = RANGE_BYTES) -> DataFrame:
    """``rows`` of an index (path, offset, caplen and what else) with the bytes of their packets as ``data``.

    Rows are dealt out by place, so a giant capture is fetched by many tasks, and packets that lie near each other
    are read together.
    """
    schema = rows.schema.add("data", "binary")
    names = [f.name for f in schema]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in batches:
            path, offset, size = batch.column("path").to_pylist(), batch.column("offset").to_numpy(), batch.column("caplen").to_numpy()
            data, first, held = [], 0, 0
            for at, name in enumerate(path):
                if name != opened:
                    if file is not None:
                        file.close()
                    file, opened = _open(name, filesystem, _SMALL_BLOCK), name
                begin = int(offset[at]) + RECORD_HEADER_BYTES
                # The block grows where the next packets of the file are near.
                last = int(np.searchsorted(offset[at:], begin + int(size[at]) + _NEAR)) if offset[at:].size > 1 and path[-1] == name else 0
                file.block = _BLOCK if last > 1 else _SMALL_BLOCK
                data.append(file.take(begin, int(size[at])))
                held += len(data[-1])
                if held >= _BATCH_BYTES or at + 1 == len(path):
                    part = batch.slice(first, at + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names=names)
                    data, first, held = [], at + 1, 0
        if file is not None:
            file.close()

    place = F.floor(F.col("offset") / fetch_bytes)
    return rows.repartition("path", place).sortWithinPartitions("path", "offset").mapInArrow(fetch, schema)


def read_captures(spark: SparkSession, path: str, class_from: str = "directory", filesystem: str | None = None, **options: int) -> DataFrame:
    """All packets of all captures below ``path`` with their bytes; files that cannot be read are left to :func:`quarantine`."""
    index = index_captures(spark, path, class_from, filesystem=filesystem, **options)
    return fetch_packets(good_packets(index), filesystem)


def good_packets(packets: DataFrame) -> DataFrame:
    return packets.where(F.col("error").isNull()).drop("error")


def quarantine(packets: DataFrame) -> DataFrame:
    """``class, capture, capture_pos, error`` of files that could not be read (further)."""
    return packets.where(F.col("error").isNotNull()).select(
        "class", "capture", "capture_pos", "error"
    )


def _write(packets: DataFrame, path: str, filesystem: str | None, mode: str, compression: str) -> None:
    packets.sparkSession.dataSource.register(CaptureSource)
    link = F.col("linktype") if "linktype" in packets.columns else F.lit(1)
    rows = packets.select("class", "capture", "ts_us", "caplen", "origlen", link.cast("int").alias("linktype"), "data")
    with dropped_shuffles(packets.sparkSession):
        writer = rows.write.format(FORMAT).mode(mode).option("compression", compression)
        (writer.option("filesystem", filesystem) if filesystem else writer).save(path)


def write_class_captures(
    packets: DataFrame, path: str, order: list[str], filesystem: str | None = None, mode: str = "append", compression: str = "none"
) -> None:
    """All packets of a class in ``order`` as ``<path>/<class>/part-<n>.pcap``: read by name, the files are in that order.

    Rows are dealt out by ranges of (class, order), so neither a class nor its captures end up in one task.
    ``compression="zstd"`` makes them ``part-<n>.pcap.zst``, which are read alike.
    """
    ranges = packets.repartitionByRange("class", *order).withColumn("capture", F.format_string("part-%06d.pcap", F.spark_partition_id()))
    _write(ranges.sortWithinPartitions("class", *order), path, filesystem, mode, compression)


def session_file_name() -> Column:
    """``<class>.pcap.<PROTO>_<ip>_<port>_<ip>_<port>.pcap`` of a session key, lower end first, with dashes in addresses."""
    a, b, port_a, port_b, proto = (F.element_at(F.split("flow_key", "-"), i) for i in range(1, 6))
    dashed = lambda ip: F.translate(ip, ".:", "--")
    ends = F.concat_ws("_", F.when(proto == "6", "TCP").otherwise("UDP"), dashed(a), port_a, dashed(b), port_b)
    return F.concat(F.col("class"), F.lit(".pcap."), ends, F.lit(".pcap"))


def place_sessions(index: DataFrame, order: list[str], part_bytes: int = PART_BYTES) -> DataFrame:
    """``index`` with ``pos`` in its session and the session's file as ``capture``.

    A session beyond ``part_bytes`` goes on in files ``….pcap.part<n>.pcap``. Runs on rows without bytes, or, of rows
    that hold their bytes as ``data``, ranks in ranges only the sessions of several parts: others are not moved.
    """
    size = (F.col("caplen") + RECORD_HEADER_BYTES).cast("long")
    if "data" not in index.columns:
        return _in_parts(index, order, size, part_bytes)
    totals = index.groupBy(*KEY).agg(F.sum(size).alias("_total"))
    large = stage_table(totals.where(F.col("_total") > part_bytes).select(*KEY), "large")
    pos = F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)).cast("long")
    if large.isEmpty():
        return index.withColumn("pos", pos).withColumn("capture", session_file_name())
    same = F.col("flow_key").eqNullSafe(F.col("_key")) & F.col("class").eqNullSafe(F.col("_class"))
    named = large.select(F.col("class").alias("_class"), F.col("flow_key").alias("_key"))
    short = index.join(named, same, "left_anti").withColumn("pos", pos).withColumn("capture", session_file_name())
    return short.unionByName(_in_parts(index.join(named, same, "left_semi"), order, size, part_bytes))


def _in_parts(index: DataFrame, order: list[str], size: Column, part_bytes: int) -> DataFrame:
    placed = slice_positions(index, KEY, order, running={"_bytes": size})
    part = F.floor(F.col("_bytes") / part_bytes)
    name = F.when(part == 0, session_file_name()).otherwise(F.concat(session_file_name(), F.lit(".part"), part, F.lit(".pcap")))
    return placed.withColumn("capture", name).drop("_bytes")


def write_session_files(
    packets: DataFrame,
    path: str,
    filesystem: str | None = None,
    mode: str = "append",
    order: list[str] | None = None,
    compression: str = "none",
) -> None:
    """Packets with ``capture`` and ``pos`` (:func:`place_sessions`) as ``<path>/<class>/<capture>``, with ``compression="zstd"`` as ``….zst``.

    With ``order``, what ``pos`` was ranked by, no rank has to be made: bytes move once, to the task that writes their file.
    """
    dealt = packets.repartition("class", "capture").sortWithinPartitions("class", "capture", *(order or ["pos"]))
    _write(dealt, path, filesystem, mode, compression)
