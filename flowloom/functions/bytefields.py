"""Integer and text fields cut out of a hex string, addressed by byte offset.

Offsets may be Python ints or Columns. A field beyond the end of the string is
null or empty, one across the end is cut short: callers check the length of the
packet once instead of once per field, which keeps the generated code small
enough for the JVM to compile.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def hex_at(h: Column, offset: int | Column, n: int | Column) -> Column:
    """Hex digits of ``n`` bytes at ``offset``."""
    start = F.lit(offset * 2 + 1) if isinstance(offset, int) else offset * 2 + 1
    return F.substring(h, start, _col(n) * 2 if isinstance(n, Column) else F.lit(n * 2))


def uint_at(h: Column, offset: int | Column, n: int) -> Column:
    """Big-endian unsigned integer of ``n`` bytes at ``offset``."""
    return F.conv(hex_at(h, offset, n), 16, 10).cast("bigint")


def ipv4_text(h: Column, offset: int | Column) -> Column:
    """Dotted quad of the four bytes at ``offset``."""
    return F.concat_ws(".", *[F.conv(hex_at(h, offset + i, 1), 16, 10) for i in range(4)])


def ipv6_text(h: Column, offset: int | Column) -> Column:
    """Eight colon-separated lower-case groups, not shortened."""
    return F.lower(F.regexp_replace(hex_at(h, offset, 16), "(.{4})(?!$)", "$1:"))


def hex_literal(value: Column, digits: int) -> Column:
    """``0x``-prefixed lower-case number padded to ``digits`` digits."""
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(value)), digits, "0"))


def bit(value: Column, mask: int) -> Column:
    """1 when the masked bit is set, else 0; null stays null."""
    return (value.bitwiseAND(mask) != 0).cast("int")
