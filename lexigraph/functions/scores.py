"""Numbers: confidence, similarity, costs and what a viewer draws from them."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def clamp(c) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(c)))


def calibrate(c, has_span) -> Column:
    """Clamped; times 0.8 without a source span; to four places."""
    return F.round(F.when(_col(has_span), clamp(c)).otherwise(clamp(c) * 0.8), 4)


def cosine(a, b) -> Column:
    """0 for vectors of different sizes, empty ones and zero ones."""
    a, b = _col(a), _col(b)
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot, na, nb = total(F.zip_with(a, b, lambda x, y: x * y)), F.sqrt(total(F.transform(a, lambda x: x * x))), F.sqrt(total(F.transform(b, lambda x: x * x)))
    return F.when((F.size(a) == F.size(b)) & (na > 0) & (nb > 0), dot / (na * nb)).otherwise(F.lit(0.0))


def band(c) -> Column:
    """How far an answer may lean on an edge."""
    c = _col(c)
    return F.when(c < 0.5, "drop").when(c <= 0.7, "supporting").when(c > 0.7, "primary")


def badge(c) -> Column:
    c = _col(c)
    return F.when(c >= 0.8, "high").when(c >= 0.5, "mid").otherwise("low")


def edge_width(c) -> Column:
    return F.when(_col(c).isNull(), 2.0).otherwise(1 + 4 * clamp(c))


def extraction_cost(total_chars, batch_token_budget: int = 6000) -> Column:
    """Dollars for a corpus of so many characters."""
    tokens = _col(total_chars) / 4
    overhead = 400 * (tokens / (batch_token_budget or 6000) + 1)
    return (tokens + overhead) / 1000 * 0.00015 + tokens * 0.3 / 1000 * 0.0006


def batch_count(rows: int, size: int) -> int:
    if size < 1:
        raise ValueError("size must be positive")
    return -(-rows // size)


def write_seconds(rows: int, size: int = 500, each: float = 0.12) -> float:
    return batch_count(rows, size) * each


def opacity(nodes: int, edges: int) -> float:
    return max(0.25, min(0.9, 1.1 - 0.15 * edges / nodes)) if nodes else 0.9


def label_font(nodes: int) -> int:
    return 6 if nodes > 800 else 8 if nodes > 300 else 10


def show_edge_labels(nodes: int, edges: int) -> bool:
    return not nodes or edges / nodes <= 3 and edges <= 800


def layout(nodes: int) -> str:
    """Which way of laying out suits so many nodes."""
    return "breadthfirst" if nodes > 1500 else "cose" if nodes > 1 else "grid"


def z_index(inferred) -> Column:
    """Inferred edges lie behind stated ones."""
    return F.when(_col(inferred), 1).otherwise(2)


def curve(parallel_index) -> Column:
    """The first of parallel edges is straight, the others are bent."""
    return F.when(_col(parallel_index) == 0, "straight").otherwise("bezier")


def type_color(entity_type, colors: dict[str, str], unknown: str = "#6c757d") -> Column:
    """A type's colour in a palette that the caller provides; grey for types that it lacks."""
    pairs = [F.lit(x) for k, v in colors.items() for x in (k, v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(entity_type)), F.lit(unknown)) if pairs else F.lit(unknown)


def drift(phase: float, elapsed_ms: float, period_ms: float, width: float, height: float) -> tuple[float, float]:
    """How far a node has moved from its place: a slow loop, as its two axes turn at different speeds."""
    turn = elapsed_ms / period_ms * 2 * math.pi
    return math.sin(turn + phase) * width, math.cos(0.73 * turn + phase) * height


def parse_limit(raw: str | None, default: int = 500, most: int = 5000) -> int:
    """The leading integer of raw, from 1 to most; the default if there is none."""
    import re

    m = re.match(r"\s*([+-]?\d+)", raw or "")
    return min(max(int(m[1]), 1), most) if m else default


def seed_phase(name: str) -> float:
    """A fixed angle for a node's name."""
    h = 0
    for unit in name.encode("utf-16-le")[::2] if name.isascii() else [int.from_bytes(name.encode("utf-16-le")[i : i + 2], "little") for i in range(0, len(name.encode("utf-16-le")), 2)]:
        h = (h * 31 + unit) % 100_000
    return h / 100_000 * 2 * math.pi
