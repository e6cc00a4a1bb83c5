"""Character spans of a text and their digest form."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

# kind, start, end in code points, end exclusive
Span = tuple[str, int, int]


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def free_of(span: Span, taken: list[Span]) -> bool:
    """Whether ``span`` shares no character with any span of ``taken``."""
    return all(span[2] <= start or end <= span[1] for _, start, end in taken)
