"""Spelling variants: words one edit apart, found in tries of letter-group counts.

The letters of a word, all below U+0100, are counted in ``GROUPS`` groups. An edit of one code point raises one count, lowers
one, or does both, so words that are near differ by a surplus of one and a deficit of one at most. Words are
arranged in a trie by their counts, one group a level. A search goes down depth first and spends
that budget; the words of the leaves it reaches are compared letter by letter.

The counts of the groups in ``HEAD`` are a key that Spark deals words out by: a word asks under its own key and under each
that the budget allows, and takes along what is left of the budget. Crowded keys are cut into cells.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.cells import meet
from flowloom.plans.staging import stage_table

MIN_LENGTH = 6
MIN_COUNT = 5
# How many times more frequent the form of a word is.
FORM_FACTOR = 5
DELETE_EVERY = 199
GROUPS = 20
# The groups of e, a, t and o.
HEAD = [1, 17, 16, 11]
CELL_WORDS = 16384
CELL_QUERIES = 65536
# Queries on their way through the trie, and pairs, that are held at once.
_AT_ONCE = 1 << 16
# Words of so many letters at most are compared as rows of bytes.
_SHORT = 32
# Different words that a task counts before it passes the counts on.
_HELD_WORDS = 1 << 19

_RUN_LETTERS = "a-zÀ-ÿ"


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    delete_every: int = DELETE_EVERY,
) -> DataFrame:
    """(word, n): letter runs in lower case (A-Z only) of at least ``min_length`` and how often they occur.

    Where ``delete_every`` divides the crc32 of ``<id>:<run>``, the run has lost one code point. A null id
    reads as an empty one; null texts have no words. Repeated rows count as often as they come.
    """
    # Shorter runs cannot become words.
    find = re.compile(f"[{_RUN_LETTERS}]{{{min_length},}}").findall

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def emptied() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for part in slices(batches):
            for name, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if not text:
                    continue
                # Bytes are lowered in A-Z alone.
                runs = find(text.encode().lower().decode())
                held.update(runs)
                start = zlib.crc32(f"{name or ''}:".encode())
                for own in set(runs):
                    code = zlib.crc32(own.encode(), start)
                    if code % delete_every == 0:
                        n, at = runs.count(own), code % len(own)
                        held[own] -= n
                        if len(own) > min_length:
                            held[own[:at] + own[at + 1 :]] += n
                if len(held) >= _HELD_WORDS:
                    yield emptied()
        if held:
            yield emptied()

    parts = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def group_counts(words: list[str]) -> np.ndarray:
    """A row of ``GROUPS`` letter counts for each word."""
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cells = np.bincount(row * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS)
    return cells.reshape(len(words), GROUPS)


def one_edit(a: str, b: str) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced code point?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def reachable_heads(head: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int, int]]:
    """Heads within the budget, with the surplus and deficit that are left."""
    yield head, 1, 1
    for i in range(len(head)):
        up = (*head[:i], head[i] + 1, *head[i + 1 :])
        yield up, 0, 1
        if head[i]:
            yield (*head[:i], head[i] - 1, *head[i + 1 :]), 1, 0
        for j in range(len(head)):
            if j != i and head[j]:
                yield (*up[:j], up[j] - 1, *up[j + 1 :]), 0, 0


class CountTrie:
    """Rows arranged by successive counts: a node is a row of counts so far, its children are found by bisection."""

    def __init__(self, counts: np.ndarray) -> None:
        self.base = int(counts.max(initial=0)) + 3
        self.levels = []
        node = np.zeros(len(counts), np.int64)
        for level in range(counts.shape[1]):
            below, node = np.unique(node * self.base + counts[:, level] + 1, return_inverse=True)
            self.levels.append(below)
        self.rows = np.argsort(node, kind="stable")
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(node))))

    def search(self, counts: np.ndarray, up: np.ndarray, down: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row): rows whose counts exceed a query's by ``up`` in all at most, and fall short by ``down`` at most.

        Queries go down together, depth first, a bounded number at a time.
        """
        # Counts beyond all rows' meet no child; they must not run into another node's numbers.
        counts = np.minimum(counts, self.base - 1)
        due = [(0, at, np.zeros(len(at), np.int64), up[at], down[at]) for at in np.array_split(np.arange(len(counts)), len(counts) // _AT_ONCE + 1)]
        while due:
            level, query, node, up, down = due.pop()
            if not len(query):
                continue
            if level == len(self.levels):
                first, many = self.ends[node], self.ends[node + 1] - self.ends[node]
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                yield np.repeat(query, many), self.rows[np.repeat(first, many) + place]
                continue
            below, steps = self.levels[level], []
            for step in (-1, 0, 1):
                able = np.flatnonzero((down > 0) if step < 0 else (up > 0) if step else (up >= 0))
                wanted = counts[query[able], level] + step + 1
                key = node[able] * self.base + wanted
                at = np.minimum(np.searchsorted(below, key), len(below) - 1)
                there = (below[at] == key) & (wanted > 0) & (wanted < self.base)
                able, at = able[there], at[there]
                steps.append((query[able], at, up[able] - (step > 0), down[able] - (step < 0)))
            moved = [np.concatenate(c) for c in zip(*steps, strict=True)]
            for start in range(0, len(moved[0]), _AT_ONCE):
                due.append((level + 1, *(c[start : start + _AT_ONCE] for c in moved)))


def _padded(words: list[str]) -> np.ndarray:
    """Letters as bytes in ``_SHORT`` columns; longer words are cut, and never compared so."""
    raw = np.array([w[:_SHORT].encode("latin-1") for w in words], f"S{_SHORT}")
    return raw.view(np.uint8).reshape(len(words), _SHORT)


def _one_edit_rows(long: np.ndarray, short: np.ndarray, same: np.ndarray) -> np.ndarray:
    """:func:`one_edit` for rows of padded letters, of the same length or one letter longer on the left."""
    differ = long != short
    out = differ.sum(axis=1) == 1
    other = np.flatnonzero(~same)
    start = differ[other].argmax(axis=1)
    behind = np.arange(_SHORT - 1) >= start[:, None]
    out[other] = ~((long[other, 1:] != short[other, :-1]) & behind).any(axis=1)
    return out


def _search_cell(entries: pa.Table, queries: pa.Table) -> pa.Table:
    """(word, n_near, lack, near): how many near words the cell has, and the most frequent of them; ``lack`` is minus its count.

    A pair is found from the side of the smaller head, or of the smaller word, and counts for both words.
    """
    sides, numbers, heads = [], [], []
    for table in (entries, queries):
        table = table.sort_by([("n", "descending"), ("word", "ascending")])
        sides.append(table.column("word").to_pylist())
        numbers.append(table.column("n").to_numpy())
        heads.append(table)
    words, asked = sides
    tails = [group_counts(s)[:, [g for g in range(GROUPS) if g not in HEAD]] for s in sides]
    # The counts that tell most apart come first.
    order = np.argsort(-tails[0].var(axis=0), kind="stable")
    letters, lengths = [_padded(s) for s in sides], [np.array([len(w) for w in s]) for s in sides]
    up, down = (heads[1].column(c).to_numpy() for c in ("up", "down"))
    own_head = (up == 1) & (down == 1)
    spelt = [np.array(s, object) for s in sides]
    near, best = [np.zeros(len(s), np.int64) for s in sides], [np.full(len(s), 1 << 62) for s in sides]
    for query, row in CountTrie(tails[0][:, order]).search(tails[1][:, order], up, down):
        for start in range(0, len(query), _AT_ONCE):
            q, e = query[start : start + _AT_ONCE], row[start : start + _AT_ONCE]
            once = ~own_head[q] | (spelt[1][q] < spelt[0][e])
            q, e = q[once], e[once]
            size_q, size_e = lengths[1][q], lengths[0][e]
            swap = (size_e > size_q)[:, None]
            one, two = letters[1][q], letters[0][e]
            close = _one_edit_rows(np.where(swap, two, one), np.where(swap, one, two), size_q == size_e)
            for at in np.flatnonzero(np.maximum(size_q, size_e) > _SHORT).tolist():
                close[at] = one_edit(asked[q[at]], words[e[at]])
            for side, (here, there) in enumerate(((e[close], q[close]), (q[close], e[close]))):
                near[side] += np.bincount(here, minlength=len(near[side]))
                # Rows are in order of frequency and spelling, so the least place is the best.
                np.minimum.at(best[side], here, there)
    out = []
    for side in (0, 1):
        met = np.flatnonzero(near[side])
        other = best[side][met]
        columns = [pa.array(spelt[side][met], pa.string()), near[side][met], -numbers[1 - side][other], pa.array(spelt[1 - side][other], pa.string())]
        out.append(pa.Table.from_arrays([pa.array(c) for c in columns], names=["word", "n_near", "lack", "near"]))
    return pa.concat_tables(out)


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, cell_queries: int = CELL_QUERIES) -> DataFrame:
    """(word, n_near, near, near_n) for each of ``words`` (word, n) with near words: the most frequent, ties to the smallest."""

    def under(all_heads: bool) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, 4096):
                again, rows = [], []
                for at, head in enumerate(map(tuple, group_counts(part.column(0).to_pylist())[:, HEAD].tolist())):
                    for other, up, down in reachable_heads(head) if all_heads else [(head, 0, 0)]:
                        if other >= head:
                            again.append(at)
                            rows.append((",".join(map(str, other)), up, down))
                own = part.take(pa.array(again, pa.int64()))
                kinds = (pa.string(), pa.int32(), pa.int32())
                added = [pa.array(c, kind) for c, kind in zip(list(zip(*rows, strict=True)) or [(), (), ()], kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*own.columns, *added], names=["word", "n", "head", "up", "down"])

        return words.select("word", "n").mapInArrow(run, "word string, n bigint, head string, up int, down int")

    entries = under(False).select("head", "word", "n")
    schema = "word string, n_near bigint, lack bigint, near string"
    met = meet(entries, under(True), ["head"], "word", (cell_words, cell_queries), _search_cell, schema)
    best = F.min(F.struct("lack", "near"))
    found = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.lack")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each of ``forms`` (word, form): the last form, by doubling the step each round."""
    current = stage_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = current.join(onward, "root", "left")
        moved = stage_table(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "moved")
        if moved.where("moved").isEmpty():
            return current
        current = moved.select("word", "root")


def variants(words: DataFrame, factor: int = FORM_FACTOR, cell_words: int = CELL_WORDS, cell_queries: int = CELL_QUERIES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of ``words`` (word, n), which holds a word once.

    ``form`` is the near word of largest n (ties: the smallest) if its n is at least ``factor`` times the
    word's, else null. As n grows with every step, forms lead to a last word, the root;
    a word without a form is its own. No words give no rows.
    """
    words = stage_table(words, "words")
    near = near_words(words, cell_words, cell_queries)
    has_form = F.col("near_n") >= F.col("n") * factor
    linked = words.join(near, "word", "left").select(
        "word",
        F.when(has_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("near_n")).alias("form_n"),
    )
    linked = stage_table(linked, "linked")
    roots = _roots(linked.where(F.col("form").isNotNull()))
    return linked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
