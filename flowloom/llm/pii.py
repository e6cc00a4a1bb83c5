"""Personal data in texts: pattern spans, and further spans of a semi-Markov conditional random field.

The field scores whole candidate segments (email, ip, card, phone) by features of the
complete span, such as its number of digits, its check digit or what stands on either side.
A dynamic program over a text's tokens chooses boundaries and kinds together; an entity has
at most ``MAX_TOKENS`` tokens, so the work is linear in the text. Tokens outside entities
score 0: stretches of text without a digit run or an ``@`` cannot hold a candidate and
need no table. Pattern spans always stay; the field adds spans that overlap none of them.

Training needs no labels: islands of text with their pattern spans are the examples, along
with altered forms (sign of a phone number left out, blanks around ``@``) that patterns miss.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import slices
from flowloom.llm.spans import Span, digest, free_of, joined

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
# Code points on either side of a digit run or an @ that one island takes in.
REACH = 48
# Documented bound of the training sample: islands, and the characters of one.
TRAIN_ISLANDS = 400
TRAIN_ISLAND_CHARS = 400
# What a segment's score has to exceed beyond the score of plain text.
MARGIN = 2.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")
_SEED = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^A-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, in order of kind and start."""
    found: list[Span] = []
    # An address is found from its @: the local part reaches back no further than the last match.
    floor, at = 0, text.find("@")
    while at >= 0:
        start = len(text[floor:at].rstrip(_LOCAL)) + floor
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in match.group().split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _NON_DIGIT.sub("", match.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_NON_DIGIT.sub("", match.group())) <= 15:
                found.append(("phone", *match.span()))
    return found


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digit runs and @ signs; outside them no candidate can lie."""
    start = end = None
    for seed in _SEED.finditer(text):
        low, high = max(0, seed.start() - REACH), min(len(text), seed.end() + REACH)
        if end is not None and low <= end:
            end = high
            continue
        if end is not None:
            yield start, end
        start, end = low, high
    if end is not None:
        yield start, end


# Features of a span; each kind has its own weight for each of them.
_FEATURES = (
    "bias",
    "left_word",
    "right_word",
    "one_at",
    "spaced_at",
    "dotted_domain",
    "letter_ending",
    "bad_email_char",
    "four_bytes",
    "digits_0_6",
    "digits_7_8",
    "digits_9_12",
    "digits_13_15",
    "digits_16_19",
    "digits_more",
    "check_digit",
    "plus",
    "brackets",
    "one_group",
    "even_groups",
    "mixed_breaks",
    "letters",
    "right_more",
    "other_char",
)
_AT = {name: place for place, name in enumerate(_FEATURES)}
_EMAIL_SHAPE = re.compile(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def _features(text: str, start: int, end: int) -> list[int]:
    span = text[start:end]
    left, right = text[start - 1 : start], text[end : end + 1]
    digits = _NON_DIGIT.sub("", span)
    names = ["bias"]
    if left.isalnum() or left == "_":
        names.append("left_word")
    if right.isalnum() or right == "_":
        names.append("right_word")
    if right in ("-", ".", "@") and text[end + 1 : end + 2].isalnum():
        names.append("right_more")
    ats = span.count("@")
    if ats:
        names.append("one_at" if ats == 1 else "other_char")
        if " " in span:
            names.append("spaced_at")
        shape = _EMAIL_SHAPE.fullmatch(span)
        names.append("dotted_domain" if shape else "bad_email_char")
        if span.rpartition(".")[2].isalpha():
            names.append("letter_ending")
    else:
        n = len(digits)
        size = "0_6" if n < 7 else "7_8" if n < 9 else "9_12" if n < 13 else "13_15" if n < 16 else "16_19" if n < 20 else "more"
        names.append(f"digits_{size}")
        if 13 <= n <= 19 and luhn(digits):
            names.append("check_digit")
        groups = re.findall(r"[0-9]+", span)
        if len(groups) == 4 and span == ".".join(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups):
            names.append("four_bytes")
        if span.startswith("+"):
            names.append("plus")
        if "(" in span and span.find(")") > span.find("("):
            names.append("brackets")
        if len(groups) == 1:
            names.append("one_group")
        elif len(groups) > 2 and len({len(g) for g in groups[:-1]}) == 1 and len(groups[0]) >= 3:
            names.append("even_groups")
        breaks = set(span) - set("0123456789+")
        if len(breaks) > 1 and not breaks <= set("() -"):
            names.append("mixed_breaks")
        if any(c.isalpha() for c in span):
            names.append("letters")
        if breaks - set(" ().-"):
            names.append("other_char")
    return [_AT[name] for name in names]


Candidate = tuple[int, int, list[int]]


def _candidates(text: str, low: int, high: int) -> tuple[list[int], list[Candidate]]:
    """Token starts of an island (and its end), and the segments worth scoring, by token numbers."""
    starts = [low + m.start() for m in _TOKEN.finditer(text[low:high])]
    bounds = [*starts, high]
    found: list[Candidate] = []
    for i, begin in enumerate(starts):
        first = text[begin]
        if not (first.isalnum() or first in "+("):
            continue
        digits = ats = dots = 0
        for j in range(i, min(len(starts), i + MAX_TOKENS)):
            token = text[bounds[j] : bounds[j + 1]]
            last = token[-1]
            if last.isspace() and last != " ":
                break
            digits += len(token) if "0" <= last <= "9" else 0
            ats += last == "@"
            dots += last == "."
            if last.isalpha() and not ats and "@" not in text[bounds[j + 1] : bounds[min(len(starts), i + MAX_TOKENS)]]:
                break
            if last.isalnum() and (ats or digits >= 7 or (digits >= 4 and dots >= 3)):
                found.append((i, j + 1, _features(text, begin, bounds[j + 1])))
    return bounds, found


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _scores(found: list[Candidate], weights: list[float]) -> list[list[float]]:
    width = len(_FEATURES)
    return [[sum(weights[k * width + f] for f in feats) for k in range(len(KINDS))] for _, _, feats in found]


def decode(text: str, weights: list[float], margin: float = MARGIN) -> list[Span]:
    """The best segmentation of each island: Viterbi over token boundaries, entities of bounded length."""
    spans: list[Span] = []
    for low, high in islands(text):
        bounds, found = _candidates(text, low, high)
        if not found:
            continue
        ending: dict[int, list[tuple[int, str, float]]] = {}
        for (i, j, _), scores in zip(found, _scores(found, weights), strict=True):
            k = max(range(len(KINDS)), key=lambda kind: scores[kind])
            if scores[k] > margin:
                ending.setdefault(j, []).append((i, KINDS[k], scores[k] - margin))
        best: list[float] = [0.0]
        came: list[tuple[int, str] | None] = [None]
        for j in range(1, len(bounds)):
            top, how = best[j - 1], None
            for i, kind, score in ending.get(j, ()):
                if best[i] + score > top:
                    top, how = best[i] + score, (i, kind)
            best.append(top)
            came.append(how)
        j = len(bounds) - 1
        while j > 0:
            if came[j]:
                i, kind = came[j]
                spans.append((kind, bounds[i], bounds[j]))
                j = i
            else:
                j -= 1
    return spans


def _examples(text: str) -> Iterator[tuple[str, list[Span]]]:
    """Islands of ``text`` with their pattern spans."""
    for low, high in islands(text):
        if high - low <= TRAIN_ISLAND_CHARS:
            piece = text[low:high]
            yield piece, pattern_spans(piece)


def _altered(piece: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """Forms of an example that no pattern matches: some are personal data still, some are not."""
    if len(spans) != 1:
        return
    kind, start, end = spans[0]
    body, before, after = piece[start:end], piece[:start], piece[end:]

    def placed(new: str, label: str | None) -> tuple[str, list[Span]]:
        return before + new + after, [(label, start, start + len(new))] if label else []

    if kind == "phone" and "(" in body:
        yield placed(body[1:], "phone")
        yield placed(_NON_DIGIT.sub("", body), None)
    elif kind == "phone":
        yield placed(_NON_DIGIT.sub("", body), None)
        yield placed(_NON_DIGIT.sub(".", body[1:]), None)
    elif kind == "email":
        yield placed(body.replace("@", " @ "), "email")
        yield placed(body.replace(".", " "), None)
    elif kind == "ip":
        yield placed(body.replace(".", "-"), None)
        yield placed("7" + body.replace(".", ".9", 1), None)
    elif kind == "card":
        last = str((int(body[-1]) + 5) % 10)
        yield placed(body[:-1] + last, None)


def train(examples: list[tuple[str, list[Span]]], rounds: int = 40, l2: float = 0.02) -> list[float]:
    """Weights by gradient steps on the log-likelihood; the sums over segmentations run forward and backward."""
    width, kinds = len(_FEATURES), range(len(KINDS))
    ready = []
    for text, spans in examples:
        bounds, found = _candidates(text, 0, len(text))
        place = {bound: number for number, bound in enumerate(bounds)}
        index = {(i, j): number for number, (i, j, _) in enumerate(found)}
        gold, clear = {}, True
        for kind, start, end in spans:
            number = index.get((place.get(start), place.get(end)))
            if number is None or any(found[g][0] < place[end] and place[start] < found[g][1] for g in gold):
                clear = False
            else:
                gold[number] = KINDS.index(kind)
        if found and clear:
            ready.append((len(bounds) - 1, found, gold))
    weights, squares = [0.0] * (width * len(KINDS)), [1e-6] * (width * len(KINDS))
    for _ in range(rounds if ready else 0):
        slope = [-l2 * w for w in weights]
        for n, found, gold in ready:
            scores = _scores(found, weights)
            by_end: dict[int, list[int]] = {}
            by_start: dict[int, list[int]] = {}
            whole = []
            for number, (i, j, _) in enumerate(found):
                by_end.setdefault(j, []).append(number)
                by_start.setdefault(i, []).append(number)
                top = max(scores[number])
                whole.append(top + math.log(sum(math.exp(s - top) for s in scores[number])))
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = ahead[j - 1]
                for number in by_end.get(j, ()):
                    ahead[j] = _log_add(ahead[j], ahead[found[number][0]] + whole[number])
            for i in range(n - 1, -1, -1):
                behind[i] = behind[i + 1]
                for number in by_start.get(i, ()):
                    behind[i] = _log_add(behind[i], behind[found[number][1]] + whole[number])
            for number, (i, j, feats) in enumerate(found):
                base = ahead[i] + behind[j] - ahead[n]
                for k in kinds:
                    pull = (gold.get(number) == k) - math.exp(min(0.0, base + scores[number][k]))
                    if abs(pull) > 1e-6:
                        for f in feats:
                            slope[k * width + f] += pull
        for f, pull in enumerate(slope):
            squares[f] += pull * pull
            weights[f] += 0.5 * pull / math.sqrt(squares[f])
    return weights


def fit(docs: DataFrame, text_col: str = "text", sample_islands: int = TRAIN_ISLANDS) -> list[float]:
    """Weights of the field, from a bounded sample of islands.

    Half of the ``sample_islands`` islands hold pattern spans. Which ones are taken depends on
    a hash of the island's text alone. Without any pattern span all weights stay 0 and nothing is added.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            pieces = [(p, bool(s)) for text in part.column(0).to_pylist() for p, s in _examples(text)]
            if pieces:
                yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in pieces], "hit": [h for _, h in pieces]})

    likely = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    pieces = likely.mapInArrow(run, "piece string, hit boolean")
    order = [F.xxhash64("piece"), F.col("piece")]
    half = sample_islands // 2
    # Pieces of one kind of island are few and short, so either list is bounded.
    rows = pieces.distinct().withColumn("_order", order[0])
    taken = [r for hit in (True, False) for r in rows.where(F.col("hit") == hit).orderBy("_order", "piece").limit(half).collect()]
    examples = []
    for row in taken:
        spans = pattern_spans(row["piece"])
        examples.append((row["piece"], spans))
        examples.extend(_altered(row["piece"], spans))
    return train(examples)


def find(text: str | None, weights: list[float]) -> tuple[list[Span], list[Span]]:
    """(pattern spans, all spans), each in order of kind and start."""
    text = text or ""
    base = pattern_spans(text)
    added = [span for span in decode(text, weights) if free_of(span, base)] if any(weights) else []
    return base, sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1]))


def detect(
    docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, base and all spans as lists of (kind, start, end).

    A null text counts as empty, a null id passes through, repeated rows are kept, other
    columns are not read. An empty table gives an empty result.
    """
    span = "array<struct<kind:string,start:int,end:int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [find(text, weights) for text in part.column(1).to_pylist()]
            as_cells = [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in side[n]] for side in found] for n in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(cells, kind) for cells in as_cells)], names=["doc_id", "base", "spans"]
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {id_type}, base {span}, spans {span}")


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out.append(f"{text[last:start]}<{kind}>")
        last = max(last, end)
    return "".join(out) + text[last:]


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts of pattern spans, their digest, and all spans as text, from :func:`detect`'s rows."""

    def text_of(column: str):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(column, one), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in KINDS], F.sha2(text_of("base"), 256).alias("base_sha256"), text_of("spans").alias("spans")
    )


__all__ = ["KINDS", "decode", "detect", "digest", "digest_columns", "find", "fit", "joined", "mask", "pattern_spans", "train"]
