"""Secrets in texts: one Aho-Corasick pass over keywords, anchored expressions near hits, embedded checksums.

The automaton holds the words that assignments and key prefixes begin with, and every
string of four hexadecimal digits (a long hexadecimal run contains one). Only where it
hits is an expression tried, anchored to the hit, so plain prose costs one automaton pass.

Kinds ``assign``, ``access`` and ``hex`` are the base; ``github`` and ``npm`` tokens are
added only when the CRC-32 in their last six characters fits the rest.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.spans import Span

KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CHECKED = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
_HEX_PROBE = 4
_ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CHECKED_TOKEN = re.compile(r"(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_HEX_DIGITS = "0123456789abcdef"
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in _WORDS:
        found.add_word(word, ("assign", len(word)))
    found.add_word("akia", ("access", 4))
    for word in _CHECKED:
        found.add_word(word, ("checked", len(word)))
    for digits in itertools.product(_HEX_DIGITS, repeat=_HEX_PROBE):
        found.add_word("".join(digits), ("hex", _HEX_PROBE))
    found.make_automaton()
    return found


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six digits to the base 62."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out


def scan(text: str | None, keywords: ahocorasick.Automaton) -> list[Span]:
    """All spans in order of start, then kind; those of one kind do not overlap."""
    if not text:
        return []
    folded = text.lower()
    if len(folded) != len(text):  # some letter has a longer small form: keep the places
        folded = text.translate(_ASCII_LOWER)
    spans: list[Span] = []
    after = dict.fromkeys(KINDS, 0)
    hex_seen = 0
    for last, (kind, size) in keywords.iter(folded):
        start = last - size + 1
        if kind == "hex":
            # Small hexadecimal digits only; a run is looked at once, from its first digit.
            if start < hex_seen:
                continue
            begin = start
            while begin > hex_seen and text[begin - 1] in _HEX_DIGITS:
                begin -= 1
            run = _HEX.match(text, begin)
            if not run or run.end() <= last:
                continue
            hex_seen = run.end()
            if hex_seen - begin >= MIN_HEX:
                spans.append(("hex", begin, hex_seen))
        elif kind == "checked":
            match = _CHECKED_TOKEN.match(text, start)
            if match:
                token = match.group()
                name = _CHECKED[token[:4]]
                if start >= after[name] and checksum62(token[4:-6]) == token[-6:]:
                    spans.append((name, start, match.end()))
                    after[name] = match.end()
        elif start >= after[kind]:
            match = (_ASSIGN if kind == "assign" else _ACCESS).match(text, start)
            if match:
                after[kind] = match.end()
                long_enough = len(match[1]) >= MIN_ASSIGNED if kind == "assign" else match.end() - start >= MIN_ACCESS
                if long_enough:
                    spans.append((kind, start, match.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and its spans as a list of (kind, start, end).

    A null text counts as empty, a null id passes through, repeated rows are kept, other
    columns are not read. An empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for part in slices(batches):
            cells = [
                [dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(text, keywords)]
                for text in part.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cells, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {id_type}, spans array<struct<kind:string,start:int,end:int>>"
    )


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans as text, from :func:`detect`'s rows."""

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))


__all__ = ["BASE_KINDS", "KINDS", "automaton", "checksum62", "detect", "digest_columns", "scan"]
