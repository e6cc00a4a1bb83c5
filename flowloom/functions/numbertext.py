"""Number-to-text conversion with the spelling Python gives to floats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Texts up to this long have at most 15 digits, which no shorter text can stand for.
_SHORT_TEXT = 16


# Whole values up to here are exact decimals of two parts; beyond it the formatter's digits are taken.
_EXACT_BELOW = float(1 << 93)
_PART = 1 << 40


def _large_text(x: Column) -> Column:
    """Shortest text of a whole value from 1e16 to ``_EXACT_BELOW``: its exact digits, rounded to 15, 16 or 17 of them."""
    size = F.abs(x)
    upper = F.floor(size / _PART).cast("bigint")
    lower = (size - upper.cast("double") * _PART).cast("bigint")
    exact = upper.cast("decimal(19,0)") * F.lit(_PART).cast("decimal(13,0)") + lower.cast("decimal(19,0)")
    digits = exact.cast("string")
    many = F.length(digits)

    def rounded(n: int, always_up: bool = False) -> Column:
        """The nearest whole number of ``n`` digits, halves to the even one, or the next above, and the zeros it lacks."""
        head, rest = F.substring(digits, 1, n).cast("bigint"), F.substring(digits, F.lit(n + 1), many)
        half = F.rpad(F.lit("5"), many - n, F.lit("0"))
        up = F.lit(True) if always_up else (rest > half) | ((rest == half) & (head % 2 == 1))
        return F.concat(F.when(up, head + 1).otherwise(head).cast("string"), F.lit("e"), (many - n).cast("string"))

    # Above a power of two values lie further apart than below it: there the number above may do where the nearest does not.
    texts = [rounded(15), rounded(15, True), rounded(16), rounded(16, True)]
    found = F.coalesce(*[F.when(t.cast("double") == size, t) for t in texts], rounded(17))
    whole, zeros = F.substring_index(found, "e", 1), F.substring_index(found, "e", -1).cast("int")
    mantissa = F.regexp_replace(F.concat(F.substring(whole, 1, 1), F.lit("."), F.substring(whole, 2, 20)), r"\.?0*$", "")
    exponent = (F.length(whole) - 1 + zeros).cast("string")
    return F.concat(F.when(x < 0, "-").otherwise(""), mantissa, F.lit("e+"), exponent)


def float_text(x: Column) -> Column:
    """Shortest decimal text: ``10000000.0``, ``1e-05``, ``nan``, ``-inf``.

    The JVM may spell a value with more digits than needed, so longer texts are
    replaced by the first of 15, 16 or 17 digits that reads back as the value. From
    ``_EXACT_BELOW`` on, the last digit may rarely differ by one from the closest such text.
    """
    x = x.cast("double")
    raw = x.cast("string")
    size = F.abs(x)
    digits15, digits16, digits17 = [F.format_string(f"%.{n}e", x) for n in (14, 15, 16)]
    # The formatter rounds halves of the printed digits up; the value may lie below.
    below16 = F.regexp_replace(digits17, ".e", "e")
    shortest = (
        F.when(digits15.try_cast("double") == x, digits15)
        .when(digits16.try_cast("double") == x, digits16)
        .when(below16.try_cast("double") == x, below16)
        .otherwise(digits17)
    )
    # Scale 22 keeps every digit of values down to 1e-4 and leaves 16 integer digits.
    fixed = shortest.try_cast("decimal(38,22)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", ".0")
    return (
        F.when(x.isNull() | F.isnan(x), "nan")
        .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when(
            (size == 0) | ((size >= 1e-3) & (size < 1e7) & (F.length(raw) <= _SHORT_TEXT)), raw
        )
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when((size >= 1e16) & (size < _EXACT_BELOW), _large_text(x))
        .otherwise(F.regexp_replace(shortest, r"\.?0*e", "e"))
    )


def with_value_texts(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Add array ``name`` with the text of each of ``columns``; missing values read ``nan``.

    All floating-point columns go through one lambda, so the generated code does
    not grow with the long number-formatting rule for every column.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    floats = [c for c in columns if isinstance(types[c], (T.DoubleType, T.FloatType))]
    place = {c: i for i, c in enumerate(floats)}
    numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in floats])

    def text(column: str) -> Column:
        x = F.col(f"`{column}`")
        if column in place:
            return F.get(F.col("_floats"), F.lit(place[column]))
        if isinstance(types[column], T.BooleanType):
            return F.when(x.isNull(), "nan").when(x, "True").otherwise("False")
        return F.coalesce(x.cast("string"), F.lit("nan"))

    return (
        rows.withColumn("_floats", F.transform(numbers, float_text))
        .withColumn(name, F.array(*[text(c) for c in columns]))
        .drop("_floats")
    )


def named_values(names: list[str], values: Column) -> Column:
    """``name: value`` pairs joined by ``, ``; null values are left out."""
    heads = F.array(*[F.lit(f"{n}: ") for n in names])
    return F.array_join(F.zip_with(heads, values, lambda n, v: F.concat(n, v)), ", ")


def seconds_text(us: Column) -> Column:
    """Microseconds as seconds with six decimals."""
    size = F.abs(us)
    return F.concat(
        F.when(us < 0, "-").otherwise(""),
        F.call_function("div", size, F.lit(1_000_000)).cast("string"),
        F.lit("."),
        F.lpad((size % 1_000_000).cast("string"), 6, "0"),
    )
