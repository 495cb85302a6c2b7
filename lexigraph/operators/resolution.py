"""Entity resolution: similar names become one, and triples are rewritten."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_key
from ..plans.tables import cut, small
from ..types import ResolveConfig
from .components import connected
from .similarity import pairs, vectors
from .triples import mentions


@dataclass
class Resolution:
    triples: DataFrame
    merges: DataFrame
    borderline: DataFrame
    mapping: DataFrame


def _replay(group: pd.DataFrame) -> pd.DataFrame:
    """Joins a component's pairs in the order of (left, right); the shorter root wins, of equals the left name's.

    Rows of kind 0 are merges with the root at that moment, those of kind 1 are each name's final root.
    """
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        parent.setdefault(x, x)
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    out = []
    for left, right, similarity in group.sort_values(["left", "right"])[["left", "right", "similarity"]].itertuples(index=False):
        a, b = find(left), find(right)
        if a != b:
            keep, drop = (b, a) if len(b) < len(a) else (a, b)
            parent[drop] = keep
        out.append((0, find(left), right, similarity))
    out += [(1, find(x), x, 1.0) for x in sorted(parent)]
    return pd.DataFrame(out, columns=["kind", "canonical", "alias", "similarity"])


def clusters(similar: DataFrame) -> DataFrame:
    """(kind, canonical, alias, similarity) of similar pairs (left, right, similarity), component by component.

    The order of the joins decides the canonical name, so a component is replayed in one task; a component is a set of
    names that resemble one another in chains.
    """
    comps = connected(similar, "left", "right")
    own = similar.join(comps, F.col("left") == F.col("node")).select("component", "left", "right", "similarity")
    return own.groupBy("component").applyInPandas(_replay, "kind int, canonical string, alias string, similarity double")


def resolve_names(names: DataFrame, how: ResolveConfig = ResolveConfig(), hashing: str = "blake2b") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mapping of name to canonical, merges, borderline pairs) of a table of names (column name)."""
    found = cut(pairs(vectors(names, how.dimensions, how.ngram, hashing), how.review_floor), "similar")
    done = cut(clusters(found.filter(F.col("similarity") >= how.threshold)), "clusters")
    mapping = names.select("name").distinct().join(done.filter("kind = 1").select(F.col("alias").alias("name"), "canonical"), "name", "left").select("name", F.coalesce("canonical", "name").alias("canonical"))
    borderline = found.filter(F.col("similarity") < how.threshold).select(F.col("left").alias("canonical"), F.col("right").alias("alias"), "similarity")
    return mapping, done.filter("kind = 0").select("canonical", "alias", "similarity"), borderline


def rewrite(triples: DataFrame, mapping: DataFrame, fold: str = "casefold") -> DataFrame:
    """Every endpoint takes its canonical name; a name without one takes its own identity. Names are folded and looked up once each, not once a triple."""
    keys = mentions(triples).select(F.col("name").alias("__name")).distinct().withColumn("__key", norm_key("__name", fold))
    m = mapping.select(F.col("name").alias("__of"), F.col("canonical").alias("__canonical"))
    found = small(cut(keys.join(m, F.col("__key") == F.col("__of"), "left").select("__name", F.coalesce("__canonical", "__key").alias("__to")), "names"))
    out = triples
    for end in ("subject", "object"):
        out = out.join(found, F.col(f"{end}.name") == F.col("__name"), "left")
        out = out.withColumn(end, F.struct(F.col("__to").alias("name"), F.col(f"{end}.entity_type").alias("entity_type"))).drop("__name", "__to")
    return out.select(triples.columns)


def resolve(triples: DataFrame, how: ResolveConfig = ResolveConfig(), hashing: str = "blake2b", fold: str = "casefold") -> Resolution:
    names = mentions(triples).select(norm_key("name", fold).alias("name")).distinct()
    mapping, merges, borderline = resolve_names(names, how, hashing)
    return Resolution(rewrite(triples, mapping, fold), merges, borderline, mapping)


def merge_lines(done: Resolution) -> DataFrame:
    one = done.merges.select(F.format_string("MERGE %s <- %s (%.3f)", "canonical", "alias", "similarity").alias("line"))
    return one.unionByName(done.borderline.select(F.format_string("REVIEW %s ~ %s (%.3f)", "canonical", "alias", "similarity").alias("line")))
