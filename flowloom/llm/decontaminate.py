"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton accepts every run of words that occurs in some item. A document's words are
streamed through it; the length of the longest match that ends at each word tells which
windows (``window`` item words, or a whole shorter item) end there. Words of such windows
are hit; :func:`clean` cuts them out and drops documents that are hit almost everywhere.

The automaton is built from at most ``shard_words`` words, so what is sent to executors is
bounded. More items than that make more automata, each with its own pass over the documents;
an item longer than ``PIECE_WORDS`` enters as pieces that overlap by ``window - 1`` words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from flowloom.llm.batches import slices

WINDOW = 10
SHARD_WORDS = 200_000
PIECE_WORDS = 20_000
# A document of which this share of words or more is hit goes altogether.
MAX_COVERAGE = 0.8

# Of lower-cased UTF-8: bytes of letters outside ASCII are all above 0x7F.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; of a null none."""
    return _WORD.findall(text.encode().lower()) if text else []


class Automaton:
    """States of the generalised suffix automaton, with the items of each window's state."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.symbols: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        # Of states that hold a whole window: the items in which it occurs.
        self.items: dict[int, set] = {}
        # State to (length, items) of the windows among its suffixes, longest first.
        self.ends: list[tuple[tuple[int, int], ...]] = []

    def _state(self, size: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, known, symbol)
        new = self._state(self.size[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            known = self.next[at][symbol]
            fits = self.size[known] == self.size[at] + 1
            self.link[new] = known if fits else self._split(at, known, symbol)
        return new

    def _split(self, at: int, known: int, symbol: int) -> int:
        copy = self._state(self.size[at] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = copy
        while at >= 0 and self.next[at].get(symbol) == known:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def build(self, items: list[tuple[object, list[bytes]]]) -> Automaton:
        """``items``: ids and their words. An id of None counts hits but names no item."""
        coded = []
        for item, words in items:
            symbols = [self.symbols.setdefault(w, len(self.symbols)) for w in words]
            coded.append((item, symbols))
            last = 0
            for symbol in symbols:
                last = self._extend(last, symbol)
        found: dict[tuple[int, int], set] = defaultdict(set)
        for item, symbols in coded:
            size = min(self.window, len(symbols))
            state = 0
            for place, symbol in enumerate(symbols, 1):
                # Every prefix of an item is a path, so the walk never leaves the automaton.
                state = self.next[state][symbol]
                if place >= size:
                    # The state of the window that ends here is an ancestor.
                    at = state
                    while self.size[self.link[at]] >= size:
                        at = self.link[at]
                    found[at, size].add(item)
        sizes = defaultdict(list)
        keys = list(found)
        for number, (state, size) in enumerate(keys):
            sizes[state].append((size, number))
        self.items = {number: found[key] - {None} for number, key in enumerate(keys)}
        self.ends = [()] * len(self.size)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            own = sorted(sizes.get(state, ()), reverse=True)
            self.ends[state] = (*own, *self.ends[self.link[state]])
        return self

    def scan(self, words: list[bytes]) -> tuple[list[int], set]:
        """Hit runs as flat [start, end, start, end, ...] word numbers, and the items whose windows occur."""
        runs: list[int] = []
        seen: set[int] = set()
        follow, link, size, ends = self.next, self.link, self.size, self.ends
        state = length = 0
        for at, symbol in enumerate(map(self.symbols.get, words)):
            if symbol is None:
                state = length = 0
                continue
            to = follow[state].get(symbol)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = follow[state].get(symbol)
            if to is None:
                continue
            state = to
            length += 1
            longest = 0
            for span, number in ends[state]:
                if span <= length:
                    longest = longest or span
                    seen.add(number)
            if longest:
                start = at + 1 - longest
                while runs and start <= runs[-2]:
                    del runs[-2:]
                if runs and start <= runs[-1]:
                    runs[-1] = at + 1
                else:
                    runs += (start, at + 1)
        return runs, set().union(*(self.items[number] for number in seen)) if seen else set()


def _pieces(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, words): item texts as words joined by blanks, long ones in overlapping pieces."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, texts, sizes = [], [], []
            for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for start in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    piece = words[start : start + PIECE_WORDS + window - 1]
                    if piece:
                        ids.append(item)
                        texts.append(b" ".join(piece))
                        sizes.append(len(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, part.schema.field(0).type), pa.array(texts, pa.binary()), pa.array(sizes, pa.int32())],
                names=["item_id", "words", "size"],
            )

    return items.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"item_id {id_type}, words binary, size int")


def automata(
    items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS
) -> Iterator[Automaton]:
    """Automata of about ``shard_words`` words each; only the words of one are with the driver at a time."""
    pieces = _pieces(items, id_col, text_col, window)
    total = pieces.agg(F.sum("size")).first()[0] or 0
    shards = -(-total // shard_words)
    for shard in range(shards):
        rows = pieces.where(F.pmod(F.xxhash64("words"), F.lit(shards)) == shard).collect()
        yield Automaton(window).build([(row["item_id"], bytes(row["words"]).split(b" ")) for row in rows])


def _merged(runs: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(runs[::2], runs[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def _one_pass(docs: DataFrame, one: Automaton, id_col: str, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(one)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value
        for part in slices(batches):
            words = [words_of(text) for text in part.column(1).to_pylist()]
            made = [found.scan(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([runs for runs, _ in made], pa.list_(pa.int32())),
                    pa.array([[str(i) for i in items] for _, items in made], pa.list_(pa.string())),
                    part.column(2),
                ],
                names=["doc_id", "n_words", "runs", "items", "text_key"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = rows.withColumn("text_key", F.md5(F.coalesce("text", F.lit(""))))
    return keyed.mapInArrow(run, f"doc_id {id_type}, n_words bigint, runs array<int>, items array<string>, text_key string")


def scan(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per document: doc_id, n_words, runs (hit word numbers, flat) and items (ids as strings).

    A null or empty text has no words and no hits. Items without words make no window; an item
    whose id is null is hit but not named. Repeated documents each keep their row; other columns
    are not read. Without items, or without documents, nothing is hit.
    """
    passes = [
        _one_pass(docs, one, id_col, text_col) for one in automata(items, window, item_id_col, item_text_col, shard_words)
    ] or [_one_pass(docs, Automaton(window).build([]), id_col, text_col)]
    if len(passes) == 1:
        return passes[0].drop("text_key")
    both = passes[0]
    for other in passes[1:]:
        both = both.unionByName(other)
    merge = F.udf(lambda runs: _merged([x for r in runs for x in r]), "array<int>")
    grouped = both.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"),
        merge(F.collect_list("runs")).alias("runs"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        # Rows of equal id and text meet here; each comes once with every automaton.
        (F.count("*") / len(passes)).cast("int").alias("_rows"),
    )
    again = F.explode(F.sequence(F.lit(1), "_rows")).alias("_again")
    return grouped.select("doc_id", "n_words", "runs", "items", again).drop("_again")


def digest_columns(found: DataFrame) -> DataFrame:
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("runs") - 1),
        F.lit(0).cast("long"),
        lambda total, at: total + F.get("runs", at) * F.when(at % 2 == 0, -1).otherwise(1),
    )
    n_hit = F.when(F.size("runs") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def cut(text: str | None, runs: list[int]) -> str | None:
    """``text`` without the hit runs, from the first byte of each run's first word to the last of its last."""
    if not runs:
        return text
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    out, last = [], 0
    for start, end in zip(runs[::2], runs[1::2], strict=True):
        out.append(raw[last : places[start][0]])
        last = places[end - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def _runs_of(part: pa.RecordBatch, one: Automaton, text_col: str, runs_col: str) -> list[list[int]]:
    """Hit runs of each row, merged with those that earlier passes have noted."""
    runs = [one.scan(words_of(text))[0] for text in part.column(part.schema.names.index(text_col)).to_pylist()]
    if runs_col in part.schema.names:
        earlier = part.column(part.schema.names.index(runs_col)).to_pylist()
        runs = [_merged([*old, *new]) for old, new in zip(earlier, runs, strict=True)]
    return runs


def _marked(docs: DataFrame, one: Automaton, text_col: str, runs_col: str) -> DataFrame:
    """``docs`` with the runs of ``one`` in ``runs_col``, beside those that are there."""
    sent = docs.sparkSession.sparkContext.broadcast(one)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            runs = pa.array(_runs_of(part, sent.value, text_col, runs_col), pa.list_(pa.int32()))
            kept = [(name, column) for name, column in zip(part.schema.names, part.columns, strict=True) if name != runs_col]
            columns = [column for _, column in kept]
            yield pa.RecordBatch.from_arrays([*columns, runs], names=[*(name for name, _ in kept), runs_col])

    plain = StructType([field for field in docs.schema if field.name != runs_col])
    return docs.mapInArrow(run, plain.add(runs_col, ArrayType(IntegerType())))


def _cut_rows(
    docs: DataFrame, one: Automaton, max_coverage: float, text_col: str, length_col: str | None, runs_col: str, schema: StructType
) -> DataFrame:
    """The columns of ``schema``: rows under the limit, without the runs of ``one`` and those in ``runs_col``."""
    sent = docs.sparkSession.sparkContext.broadcast(one)
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            at = names.index(text_col)
            texts = part.column(at).to_pylist()
            runs = _runs_of(part, sent.value, text_col, runs_col)
            arrays = [part.column(n) for n in range(len(names))]
            if any(runs):
                new = [cut(text, r) for text, r in zip(texts, runs, strict=True)]
                arrays[at] = pa.array(new, part.schema.field(at).type)
                if length_col in names:
                    size_at = names.index(length_col)
                    sizes = [None if text is None else len(text) for text in new]
                    arrays[size_at] = pa.array(sizes, part.schema.field(size_at).type)
            hit = [sum(r[1::2]) - sum(r[::2]) for r in runs]
            keep = [not n or n < max_coverage * len(words_of(text)) for n, text in zip(hit, texts, strict=True)]
            out = pa.RecordBatch.from_arrays(arrays, names=names)
            yield out.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def clean(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with hit runs cut out of the texts; documents hit in ``max_coverage`` of their words or more go.

    All columns stay. Texts without hits, empty and null ones stay as they are. Every automaton
    reads the original text; the runs of all are merged, then cut and held against the limit once.
    """
    found = list(automata(items, window, item_id_col, item_text_col, shard_words))
    if not found:
        return docs
    names = docs.columns
    runs_col = "_runs"
    while runs_col in names:
        runs_col += "_"
    # Each pass but the last adds its runs to the row; the last also cuts.
    marked = docs
    for one in found[:-1]:
        marked = _marked(marked, one, text_col, runs_col)
    return _cut_rows(marked, found[-1], max_coverage, text_col, length_col, runs_col, docs.schema)
