"""Personal data: patterns propose spans, checksums confirm them, and words nearby adjust their scores; SQL functions only.

The base kinds are email, ip, card (Luhn) and phone. The method adds iban (mod-97), ssn and secret (16 or more letters,
digits, _ and -, with a letter and a digit among them). Every span has a score: 0.4 for its pattern, 0.3 more if a checksum
confirms it, 0.3 more if a context word of its kind stands in the 40 characters before it. Added spans need `least` (0.6):
an iban needs its checksum, an ssn and a secret a context word. Base spans stay whatever their score.

Patterns are written so that Java's matcher neither recurses nor backtracks over long runs: possessive repeats where
nothing that follows could use what they hold, and starts only where a run begins or the last match ended. Each kind reads a
text twice; places are summed up in blocks, so that a text of very many matches takes time about in proportion to its length.

Null texts count as empty and have no spans; repeated rows give repeated rows; an empty table gives an empty table; other
columns are ignored by find_spans and kept by redact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "A-Za-z0-9._%+-"
#: kind -> (characters that a text with a match holds, pattern)
PATTERNS = {
    "email": ("@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    "card": ("", r"[0-9](?:[ -]?[0-9])++"),
    "phone": ("+", r"\+[0-9][ ().0-9-]+[0-9]"),
    "iban": ("", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b"),
    "ssn": ("-", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    "secret": ("", r"\b[A-Za-z0-9_][A-Za-z0-9_-]{15,}"),
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|mailto)\b",
    "ip": r"(?i)\b(?:ip|host|server|address)\b",
    "card": r"(?i)\b(?:card|visa|credit|debit|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(?:iban|bank|account|konto)\b",
    "ssn": r"(?i)\b(?:ssn|social security)\b",
    "secret": r"(?i)(?:password|passwd|secret|token|api_?key|bearer)",
}
CHECKED = ("card", "iban")
_WORD = "[A-Za-z0-9_]"
NEAR, BLOCK = 40, 512
BASE = ("email", "ip", "card", "phone")
RANK = {k: i for i, k in enumerate(PATTERNS)}
_SPAN = "array<struct<at:int,rank:int,end:int,kind:string,score:double>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: a lambda's variable, as bare columns are written out wherever they stand."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bounded(pattern: str) -> str:
    r"""The pattern with word bounds by ASCII: Java's \b takes other letters as parts of words, SQL's doesn't."""
    head, *rest = pattern.split(r"\b")
    return head + rest[0].join((f"(?<!{_WORD})", f"(?!{_WORD})" if len(rest) > 1 else "")) if rest else pattern


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, 2 * x).otherwise(x)
        return acc + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0


def _mod97(s: Column) -> Column:
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        v = F.ascii(c)
        return F.when(v >= 65, (acc * 100 + v - 55) % 97).otherwise((acc * 10 + v - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.split(m, "\\.")
        return F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(parts, lambda p: F.coalesce(p.try_cast("bigint"), F.lit(999)) <= 255)
    if kind == "card":
        return F.when(F.length(m) >= 14, _let(_digits(m), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        return _let(F.replace(m, F.lit(" "), F.lit("")), lambda s: F.length(s).between(15, 34) & _mod97(s))
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return F.lit(True)


def _found(text: Column, kind: str) -> Column:
    """The kind's valid matches as (at, end, near), in code points; near: a context word stands in the NEAR characters before it."""
    mark, pattern = PATTERNS[kind][0], _bounded(PATTERNS[kind][1])
    none = F.expr("cast(array() as array<struct<at:int,end:int,near:boolean>>)")
    start = lambda at, tail: F.struct(at.alias("at"), tail.alias("tail"), none.alias("out"))
    # each match with the text before it since the last one; the last gap has no match
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
    last = lambda *c: F.right(F.concat(*c), F.lit(NEAR))

    def step(acc: Column, x: Column) -> Column:
        at, tail = acc["at"] + F.length(x["gap"]), last(acc["tail"], F.right(x["gap"], F.lit(NEAR)))
        m = F.coalesce(x["m"], F.lit(""))
        end = at + F.length(m)
        good = x["m"].isNotNull() & F.coalesce(_valid(kind, m), F.lit(False))
        one = F.struct(at.alias("at"), end.alias("end"), tail.rlike(_bounded(CONTEXT[kind])).alias("near"))
        return F.struct(end.alias("at"), last(tail, F.right(m, F.lit(NEAR))).alias("tail"), F.when(good, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    def blocks(every: Column) -> Column:
        def block(acc: Column, i: Column) -> Column:
            inner = F.aggregate(F.slice(every, i * BLOCK + 1, F.lit(BLOCK)), start(acc["at"], acc["tail"]), step)
            return _let(inner, lambda own: F.struct(own["at"].alias("at"), own["tail"].alias("tail"), F.when(F.size(own["out"]) > 0, F.concat(acc["out"], own["out"])).otherwise(acc["out"]).alias("out")))

        return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")), start(F.lit(0), F.lit("")), block, lambda a: a["out"])

    here = F.contains(text, F.lit(mark)) if mark else text.rlike(pattern)
    return F.when(here, _let(pairs, blocks)).otherwise(none)


def find_spans(docs: DataFrame, kinds: tuple[str, ...] = tuple(PATTERNS), least: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and spans: (at, rank, end, kind, score) in order of start, then kind; starts and ends count code points."""
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return out.withColumn("spans", spans_of(F.col("text"), kinds, least))


def spans_of(text: Column, kinds: tuple[str, ...] = tuple(PATTERNS), least: float = 0.6) -> Column:
    def scored(kind: str) -> Column:
        own = 0.7 if kind in CHECKED else 0.4

        def score(s: Column) -> Column:
            total = F.when(s["near"], own + 0.3).otherwise(F.lit(own))
            return F.struct(s["at"].alias("at"), F.lit(RANK[kind]).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), total.alias("score"))

        got = F.transform(_found(text, kind), score)
        return got if kind in BASE else F.filter(got, lambda s: s["score"] >= least - 1e-9)

    return F.array_sort(F.concat(*map(scored, kinds))).cast(_SPAN)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the spans written out, and their scores in the same order."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"), F.array_join(F.transform("spans", lambda s: F.format_string("%.1f", s["score"])), ",").alias("scores"))


def redact(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """docs with every span of a text replaced by its kind in brackets; overlapping spans become one, named after the first.

    Null texts stay null, texts without spans stay as they are.
    """
    text = F.col(text_col)

    start = lambda at: F.struct(at.alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def block(acc: Column, own: Column) -> Column:
        """Spans of a block, over the part of the text that they lie in: places deep in a text are far to reach."""
        part = F.substring(text, acc["at"] + 1, F.greatest(F.element_at(own, -1)["at"] - acc["at"], F.lit(0)))

        def inside(part: Column) -> Column:
            def step(a: Column, s: Column) -> Column:
                gap = F.substring(part, a["at"] - acc["at"] + 1, s["at"] - a["at"])
                marked = F.concat(a["out"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]"))))
                return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["at"] >= a["at"], marked).otherwise(a["out"]).alias("out"))

            return F.aggregate(own, start(acc["at"]), step)

        done = _let(part, inside)
        return _let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(F.array_join(d["out"], ""))).alias("out")))

    def blocks(every: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int"))
        done = F.aggregate(F.transform(starts, lambda i: F.slice(every, i * BLOCK + 1, F.lit(BLOCK))), start(F.lit(0)), block)
        return _let(done, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))

    spans = spans_of(F.coalesce(text.cast("string"), F.lit("")), **how)
    clean = _let(spans, lambda every: F.when(F.size(every) > 0, blocks(every)).otherwise(text))
    return docs.select(*[F.when(text.isNotNull(), clean).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def oracle(kinds: tuple[str, ...] = tuple(PATTERNS)) -> str:
    """digest(find_spans(documents)) in DuckDB's SQL."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+){3}",
        "card": r"[0-9](?:[ -]?[0-9])+",
    } | {k: p for k, (_, p) in PATTERNS.items() if k not in ("email", "ip", "card")}
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    near = "regexp_matches(substring(t, greatest(pos - 39, 1), least(pos, 40)), '{}')"
    luhn = f"list_sum(list_transform(range(length({digits})), lambda i: (case when i % 2 = 1 then 2 else 1 end * {digits}[length({digits}) - i]::int) - case when i % 2 = 1 and {digits}[length({digits}) - i]::int > 4 then 9 else 0 end)) % 10 = 0"
    turned = "(substring(replace(m, ' ', ''), 5) || substring(replace(m, ' ', ''), 1, 4))"
    mod97 = f"list_reduce(list_prepend(0::bigint, list_transform(range(1, length({turned}) + 1), lambda i: ascii({turned}[i])::bigint)), lambda a, v: case when v >= 65 then (a * 100 + v - 55) % 97 else (a * 10 + v - 48) % 97 end) = 1"
    valid = {
        "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: coalesce(try_cast(p as bigint), 999) <= 255))",
        "card": f"length({digits}) between 14 and 19 and {luhn}",
        "phone": f"length({digits}) between 10 and 15",
        "iban": f"length(replace(m, ' ', '')) between 15 and 34 and {mod97}",
        "secret": "regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Za-z]')",
    }
    parts = []
    for k in kinds:
        p = plain[k].replace("'", "''")
        score = f"case when {near.format(CONTEXT[k])} then {1.0 if k in CHECKED else 0.7} else {0.7 if k in CHECKED else 0.4} end"
        parts.append(
            f"select * from (select doc_id, {RANK[k]} as rank, '{k}' as kind, pos, pos + length(m) as stop, {score} as score from (select doc_id, t, ms[i] as m, (list_sum(gs[1:i]) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))::bigint as pos"
            f" from (select doc_id, t, regexp_extract_all(t, '{p}') as ms, list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) as gs from d), unnest(range(1, len(ms) + 1)) as u(i)) where {valid.get(k, 'true')})" + " where score >= 0.6" * (k not in BASE)
        )
    some = ", ".join(f"'{k}'" for k in BASE)
    text = "string_agg(kind || ':' || pos || ':' || stop, ',' order by pos, rank)"
    counts = ", ".join(f"count(kind) filter (kind = '{k}') as n_{k}" for k in BASE)
    return f"with d as (select doc_id, coalesce(text, '') as t from documents), s as ({' union all '.join(parts)}) select d.doc_id, {counts}, sha256(coalesce({text} filter (kind in ({some})), '')) as base_sha256, coalesce({text}, '') as spans, coalesce(string_agg(printf('%.1f', score), ',' order by pos, rank), '') as scores from d left join s on d.doc_id = s.doc_id group by d.doc_id"
