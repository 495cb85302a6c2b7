"""A toxicity classifier whose scores may not hang on identity terms.

Features are the words of the whole text and their beginnings (4 to 6 letters), present or absent. Of a bounded sample of
labelled documents, per_class of either label at most (a documented parameter; all documents are scored), every feature is
counted by label; the features whose share differs most surely, at most max_features, stay. A logistic regression on them
is trained with a penalty on squared changes of the score's logit when, in labelled sentences, an identity term is swapped
for each other of its kind: neutral mentions of a group then score as other groups' do.

Null texts count as empty and get the score of a document without features; null ids are scored and never trained on;
repeated rows give repeated rows; an empty table gives an empty table; without labels of both kinds every score is the
share of toxic labels (0 without labels); other columns are ignored by score and kept by clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_rows, materialize, texts, tidy

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
PREFIXES = (4, 5, 6)
#: Terms of a kind are swapped for one another.
IDENTITY = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "musulman", "chrétien", "juif", "musulmán", "cristiano", "judío", "muslimisch", "christlich", "jüdisch"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "musulmans", "chrétiens", "juifs", "musulmanes", "cristianos", "judíos", "muslime", "christen", "juden"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "noir", "blanc", "negro", "blanco", "schwarz", "weiß"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "transgender", "homosexual", "heterosexual", "schwul", "lesbisch"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens", "migrants", "einwanderer", "flüchtlinge", "immigrés", "réfugiés", "inmigrantes", "refugiados"),
    ("disabled", "deaf", "blind", "old", "young", "elderly"),
)


def features(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words.union(*[{w[:n] + "~" for w in words if len(w) >= n} for n in PREFIXES])


def swapped(text: str, terms: dict[str, list[str]]) -> list[tuple[str, str]]:
    """Pairs of sentences that differ in one identity term alone: each term of a sentence gives way to every other of its kind."""
    out = []
    for s in _SENTENCE.split(text):
        low = s.lower()
        for t in sorted({w for w in _WORD.findall(low) if w in terms}):
            other = terms[t]
            out += [(low, re.sub(rf"(?<!\w){re.escape(t)}(?!\w)", new, low)) for new in other]
    return out


def train(rows: list[tuple[list[int], int, float]], pairs: list[tuple[list[int], list[int]]], n: int, fairness: float = 5.0, ridge: float = 1e-4, steps: int = 400) -> np.ndarray:
    """Weights of n features and, last, the intercept. rows: features present, label, weight; pairs: features of either sentence."""

    def flat(xs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(xs)), [len(x) for x in xs]), np.array([i for x in xs for i in x], int)

    r, f = flat([x for x, _, _ in rows])
    y, c = np.array([x[1] for x in rows], float), np.array([x[2] for x in rows], float)
    c /= c.sum()
    (pr, pf), (qr, qf) = flat([a for a, _ in pairs]), flat([b for _, b in pairs])
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log(max((c * y).sum(), 1e-6) / max((c * (1 - y)).sum(), 1e-6))
    for k in range(1, steps + 1):
        z = np.bincount(r, w[f], len(rows)) + w[n]
        d = c * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.append(np.bincount(f, d[r], n), d.sum())
        g[:n] += ridge * w[:n]
        if pairs:
            e = np.bincount(pr, w[pf], len(pairs)) - np.bincount(qr, w[qf], len(pairs))
            e *= 2 * fairness / len(pairs)
            g[:n] += np.bincount(pf, e[pr], n) - np.bincount(qf, e[qr], n)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = 8000, max_features: int = 4096, least_df: int = 3, identity=IDENTITY, fairness: float = 5.0) -> dict:
    """A model: weights by feature, and the intercept. Learns from labels whose crc32(doc_id) mod 4 is not 2.

    identity: groups of terms that a corpus's language has for people of one kind; fairness: the weight of the penalty, 0 for
    none. A sample in whose sentences no term occurs has no pairs, and then the penalty is nothing.
    """
    docs = texts(docs)
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label_col).cast("int") > 0).cast("int").alias("y")).dropna().filter(~held_out())
    own = own.groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return {"weights": {}, "bias": 40.0 if counts.get(1) else -40.0}
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    unit = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = F.broadcast(own.filter(unit < F.when(F.col("y") == 1, share[1]).otherwise(share[0])))  # about 2 * per_class rows
    sample = materialize(docs.join(picked, "doc_id"), "labelled")
    kinds = arrow_schema(sample.sparkSession, "feature string, pos long, neg long")

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: dict[str, list[int]] = {}
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                for x in features(t):
                    got.setdefault(x, [0, 0])[1 - y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), *[pa.array([v[i] for v in got.values()], pa.int64()) for i in (0, 1)]], schema=kinds)

    n_pos, n_neg = (sample.agg(F.sum("y"), F.sum(1 - F.col("y"))).first())
    if not n_pos or not n_neg:
        return {"weights": {}, "bias": float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))}
    stats = sample.mapInArrow(count, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, q = F.col("pos") / F.lit(n_pos), F.col("neg") / F.lit(n_neg)
    mean = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    z = F.abs(p - q) / F.sqrt(mean * (1 - mean) * F.lit(1 / n_pos + 1 / n_neg) + 1e-12)
    best = stats.filter(F.col("pos") + F.col("neg") >= least_df).withColumn("z", z).filter((F.col("z") > 3.0) & (p > q)).orderBy(F.desc("z"), "feature").limit(max_features)
    names = sorted(r["feature"] for r in best.select("feature").collect())
    at = {x: i for i, x in enumerate(names)}
    terms = {t: [o for o in g if o != t] for g in identity for t in g}

    def vector(cols: dict[str, list]) -> dict[str, list]:
        pairs = [[(sorted(at[x] for x in features(a) if x in at), sorted(at[x] for x in features(b) if x in at)) for a, b in swapped(t, terms)] for t in cols["text"]]
        return {
            "x": [sorted(at[x] for x in features(t) if x in at) for t in cols["text"]],
            "y": cols["y"],
            "a": [[a for a, b in p if a != b] for p in pairs],
            "b": [[b for a, b in p if a != b] for p in pairs],
        }

    rows = map_rows(sample.select("text", "y"), vector, "x array<int>, y int, a array<array<int>>, b array<array<int>>").collect()  # about 2 * per_class
    w = train([(r["x"], r["y"], 1 / share[r["y"]] / total) for r in rows], [p for r in rows for p in zip(r["a"], r["b"])], len(names), fairness)
    return {"weights": {x: float(w[i]) for x, i in at.items()}, "bias": float(w[-1])}


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def score_text(model: dict, text: str) -> float:
    weights, z = model["weights"], model["bias"]
    words = set(_WORD.findall(text.lower()))
    z += sum(weights[w] for w in words if w in weights)
    for n in PREFIXES:
        z += sum(weights[p] for p in {w[:n] + "~" for w in words if len(w) >= n} if p in weights)
    return float(1 / (1 + np.exp(-min(40.0, max(-40.0, z)))))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_features weights

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "score": [score_text(shared.value, t) for t in cols["text"]]}

    return map_rows(texts(docs), run, "doc_id long, score double")


def clean(docs: DataFrame, model: dict, below: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the limit, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, columns = docs.columns.index(text_col), list(docs.columns)

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([score_text(shared.value, t or "") < below for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.select(*columns).mapInArrow(keep, docs.schema)
