"""Text functions as column expressions."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: What Python's str.split() takes as white space, for Java's matcher.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
#: White space that collapse() changes: other than a space, two in a row, or at either end.
_UNEVEN = rf"[{SPACE}&&[^ ]]|  |^ | $"
_BOUNDARY = re.compile(r"(?<=[.!?])(?=[ \n\t])")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c) -> Column:
    """Trimmed, with runs of white space as one space. Most texts are so already, which one search tells."""
    c = _col(c)
    return F.when(c.rlike(_UNEVEN), F.regexp_replace(F.regexp_replace(c, f"{SPACE}+", " "), "^ | $", "")).otherwise(c)


@F.pandas_udf(StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.str.casefold()


def norm_key(c, fold: str = "casefold") -> Column:
    """An entity's identity: case-folded and collapsed. ASCII names stay in the JVM; fold "lower" keeps all there, and then ß is not ss."""
    c = collapse(c)
    if fold == "lower":
        return F.lower(c)
    return F.when(c.rlike(r"^\p{ASCII}*$"), F.lower(c)).otherwise(_casefold(F.when(~c.rlike(r"^\p{ASCII}*$"), c)))


def same_key(a, b, fold: str = "casefold") -> Column:
    """Whether two names have one identity. Those that begin with other visible ASCII characters have not, without being folded."""
    a, b = _col(a), _col(b)
    seen = lambda c, i: F.substring(c, i, 1).between("!", "~")
    other = [seen(a, 1) & seen(b, 1) & (F.lower(F.substring(a, 1, 1)) != F.lower(F.substring(b, 1, 1)))]
    other.append(seen(a, 1) & seen(b, 1) & seen(a, 2) & seen(b, 2) & (F.lower(F.substring(a, 1, 2)) != F.lower(F.substring(b, 1, 2))))
    return F.when(other[0] | other[1], F.lit(False)).otherwise(norm_key(a, fold) == norm_key(b, fold))


def sentences(c) -> Column:
    """Sentences that, joined, are the text: a boundary follows . ! or ? before a space, tab, line end or the end."""
    return F.filter(F.split(_col(c), r"(?<=[.!?])(?=[ \n\t])", -1), lambda s: s != "")


def spans_in(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence of one text."""
    cuts = [0, *(m.start() for m in _BOUNDARY.finditer(text)), len(text)]
    return [(s, e) for s, e in zip(cuts, cuts[1:]) if e > s]


@F.arrow_udf(ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))
def _spans(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.array([None if t is None else [{"start": s, "end": e} for s, e in spans_in(t)] for t in texts.to_pylist()], kind)


def sentence_spans(c) -> Column:
    """(start, end) of each sentence, in code points. In Arrow batches: a fold in SQL would copy its array for each sentence."""
    return _spans(_col(c))


def token_estimate(c) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(_col(c)) / 4)).cast("int")


def normalize_text(c) -> Column:
    """Lines without trailing white space, three line ends or more as two, and no white space around the whole."""
    c = F.regexp_replace(_col(c), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]", "\n")
    c = F.regexp_replace(c, r"[\s\x1c-\x1f\x85\p{Z}&&[^\n]]+(?=\n|$)", "")
    return F.regexp_replace(F.regexp_replace(c, "\n{3,}", "\n\n"), rf"^{SPACE}+|{SPACE}+$", "")


def truncate(c, n: int, mark: str = "...[truncated]") -> Column:
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(mark))).otherwise(c)


def truncate_label(c, n: int = 28) -> Column:
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 1), F.lit("…"))).otherwise(c)


def highlight(c, query: str) -> Column:
    """(before, match, after) of the first occurrence, whatever its case; no occurrence: all before."""
    c, q = _col(c), query.strip().lower()
    at = F.locate(q, F.lower(c)) if q else F.lit(0)
    none = F.struct(c.alias("before"), F.lit("").alias("match"), F.lit("").alias("after"))
    some = F.struct(F.substring(c, F.lit(1), at - 1).alias("before"), F.substring(c, at, F.lit(len(q))).alias("match"), F.substring(c, at + len(q), F.length(c)).alias("after"))
    return F.when(at > 0, some).otherwise(none)


def escape_xml(c) -> Column:
    c = _col(c).cast("string")
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(raw), F.lit(name))
    return c


def ngrams(c, n: int = 3) -> Column:
    """Character n-grams of the text with a space on either side."""
    padded = F.concat(F.lit(" "), _col(c), F.lit(" "))
    return F.when(F.length(padded) >= n, F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.expr("cast(array() as array<string>)"))


def content_hash(c) -> Column:
    """The SHA-256 of a text's UTF-8 bytes, or of bytes, in lowercase hexadecimal digits."""
    return F.sha2(_col(c).cast("binary"), 256)


def key_of(*parts, sep: str = "|") -> Column:
    return F.concat_ws(sep, *map(_col, parts))


def legend_id(c) -> Column:
    return F.concat(F.lit("legend-"), F.lower(_col(c)))


def panel_title(label) -> Column:
    """The heading of a viewer's panel for the selected node, if any."""
    return F.concat(F.lit("node details"), F.coalesce(F.concat(F.lit(": "), _col(label)), F.lit("")))


def metric(c) -> Column:
    """Two decimals, or a dash where there is no number."""
    return F.when(_col(c).isNotNull(), F.format_string("%.2f", _col(c))).otherwise("—")


def row_size(df) -> Column:
    """The estimated size of a row: the lengths of its columns' names and values, as Python writes them."""
    from pyspark.sql.types import BooleanType, DoubleType, FloatType

    def written(f) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, BooleanType):
            c = F.initcap(c.cast("string"))
        elif isinstance(f.dataType, (DoubleType, FloatType)):  # a plain decimal from 0.0001 up to 1e7, which is where scores and counts are
            c = c.cast("string")
        return F.coalesce(F.length(c.cast("string")), F.lit(len("None"))) + len(f.name)

    total = F.lit(0)
    for f in df.schema:
        total = total + written(f)
    return total


def export_name(at=None, stem: str = "lexigraph") -> Column:
    """stem-2024-05-01.graphml, by the day in UTC (the session's zone must be UTC)."""
    return F.concat(F.lit(f"{stem}-"), F.date_format(F.current_timestamp() if at is None else _col(at), "yyyy-MM-dd"), F.lit(".graphml"))


def disposition(at=None, stem: str = "lexigraph") -> Column:
    return F.concat(F.lit('attachment; filename="'), export_name(at, stem), F.lit('"'))
