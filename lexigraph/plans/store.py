"""The graph store: keyed node and edge tables in versioned folders, changed by merges.

A version is a folder of two Parquet tables, named by a growing number; an empty file DONE, made last, puts it in force.
The version in force is the newest with that file, so readers see whole versions at all times, and a writer that is lost
midway leaves the last one in force. Nothing is renamed or replaced. One writer is assumed.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import same_key
from ..operators.triples import edge_rows, node_rows
from ..types import EDGE, NODE, LoadConfig
from . import reads
from .tables import cut, drop_cut


@dataclass(frozen=True)
class LoadStats:
    """What one load wrote: its own node and edge rows, the batches of batch_size rows that they make, writes that were tried again."""

    nodes: int
    relationships: int
    skipped_self_loops: int
    seconds: float
    batches: int = 0
    retries: int = 0

    def __str__(self) -> str:
        return f"{self.nodes} nodes, {self.relationships} relationships in {self.batches} batches, {self.skipped_self_loops} self-loops skipped, {self.retries} retries, {self.seconds:.2f}s"


def merge_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """New rows replace those of the same name."""
    return nodes.join(new.select("name"), "name", "left_anti").select("name", "entity_type", "last_seen_doc").unionByName(new.select("name", "entity_type", "last_seen_doc"))


def merge_edges(edges: DataFrame, new: DataFrame, nodes: DataFrame) -> DataFrame:
    """New rows replace those of the same (subject, predicate, object); those without both endpoints vanish."""
    key = ["subject", "predicate", "object"]
    columns = [*key, "confidence", "source_doc_id", "inferred"]
    for end in ("subject", "object"):
        new = new.join(nodes.select(F.col("name").alias(end)), end, "left_semi")
    return _replaced(edges, new.select(columns))


def _replaced(edges: DataFrame, new: DataFrame) -> DataFrame:
    key = ["subject", "predicate", "object"]
    return edges.join(new.select(key), key, "left_anti").select(new.columns).unionByName(new)


def delete_documents(edges: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """Edges but those whose document is in doc_ids (column doc_id); nodes stay, even without edges."""
    return edges.join(doc_ids.select(F.col("doc_id").alias("source_doc_id")), "source_doc_id", "left_anti").select("subject", "predicate", "object", "confidence", "source_doc_id", "inferred")


class GraphStore:
    def __init__(self, spark: SparkSession, path: str, how: LoadConfig = LoadConfig()):
        self.spark, self.path, self.how = spark, path.rstrip("/"), how
        self._retries = 0

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self) -> list[str]:
        """All version folders, the oldest first, whether they were finished or not."""
        top, fs = self._fs(self.path)
        return sorted(n for s in (fs.listStatus(top) if fs.exists(top) else []) if s.isDirectory() and (n := s.getPath().getName())[:1] == "v" and n[1:].isdigit())

    def _finished(self, version: str) -> bool:
        done, fs = self._fs(f"{self.path}/{version}/DONE")
        return fs.exists(done)

    def version(self) -> str | None:
        """The version in force; None only where no write ever ended."""
        return next((v for v in reversed(self._folders()) if self._finished(v)), None)

    def _table(self, name: str, schema: str) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(schema).parquet(f"{self.path}/{v}/{name}") if v else self.spark.createDataFrame([], schema)

    @property
    def nodes(self) -> DataFrame:
        return self._table("nodes", NODE)

    @property
    def edges(self) -> DataFrame:
        return self._table("edges", EDGE)

    def _write(self, df: DataFrame, path: str) -> None:
        """Written whole, and tried again as often as the settings say."""
        for left in range(self.how.max_retries, -1, -1):
            try:
                return df.write.mode("overwrite").parquet(path)
            except Exception:
                if not left:
                    raise
                self._retries += 1

    def _commit(self, nodes: DataFrame, edges: DataFrame) -> str:
        v = f"v{int((self._folders() or ['v0'])[-1][1:]) + 1:012d}"
        self._write(nodes, f"{self.path}/{v}/nodes")
        self._write(edges, f"{self.path}/{v}/edges")
        done, fs = self._fs(f"{self.path}/{v}/DONE")
        fs.create(done, False).close()
        return v

    def upsert(self, triples: DataFrame, fold: str = "casefold", instead_of: DataFrame | None = None, written: bool = False) -> LoadStats:
        """Nodes first, then edges, both of whose ends are among them, as one new version. Repeating a load changes nothing.

        instead_of: documents (column doc_id) whose edges go in the same version. written: triples are a written table; others
        are written first, so that what the caller's plan costs is paid once.
        """
        began, self._retries = time.time(), 0
        own = triples if written else cut(triples, "load")
        held = [] if written else [own]
        nodes, edges = node_rows(own), edge_rows(own, fold)
        if self.version() is None:
            self._commit(nodes, edges)
            n, e = self.nodes.count(), self.edges.count()
        else:
            nodes, edges = cut(nodes, "load-nodes"), cut(edges, "load-edges")
            held += [nodes, edges]
            old = self.edges if instead_of is None else delete_documents(self.edges, instead_of)
            self._commit(merge_nodes(self.nodes, nodes), _replaced(old, edges))
            n, e = nodes.count(), edges.count()
        loops = own.filter(same_key("subject.name", "object.name", fold)).count()
        for t in held:
            drop_cut(t)
        size = self.how.batch_size
        return LoadStats(n, e, loops, time.time() - began, -(-n // size) - (-e // size), self._retries)

    def delete(self, doc_ids: DataFrame) -> None:
        self._commit(self.nodes, delete_documents(self.edges, doc_ids))

    def check(self) -> None:
        """Raises if a name or an edge's key is there twice."""
        for df, key in ((self.nodes, ["name"]), (self.edges, ["subject", "predicate", "object"])):
            if not df.groupBy(key).count().filter("count > 1").isEmpty():
                raise ValueError(f"rows share {key}")

    def healthy(self) -> bool:
        try:
            return self.nodes.limit(1).count() >= 0
        except Exception:
            return False

    def snapshot(self, to: str) -> str:
        """A copy of the current version, in a folder of its own under to, with its tables' row counts; its path."""
        path = f"{to.rstrip('/')}/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:6]}"
        self._write(self.nodes, f"{path}/nodes")
        self._write(self.edges, f"{path}/edges")
        file, fs = self._fs(f"{path}/counts.json")
        out = fs.create(file, False)
        out.write(bytearray(json.dumps({"nodes": self.nodes.count(), "edges": self.edges.count()}).encode()))
        out.close()
        return path

    def verify(self, snapshot: str) -> bool:
        """Whether a snapshot's tables can be read whole and hold as many rows as were written."""
        try:
            counts = json.loads(self.spark.read.text(f"{snapshot}/counts.json").first()[0])
            for name, schema in (("nodes", NODE), ("edges", EDGE)):
                rows = self.spark.read.schema(schema).parquet(f"{snapshot}/{name}")
                every = rows.agg(F.count("*"), F.max(F.xxhash64(*rows.columns))).first()  # reads all columns
                if every[0] != counts[name]:
                    return False
        except Exception:
            return False
        return True

    def restore(self, snapshot: str, confirm: bool = False) -> None:
        """Makes a snapshot the current version."""
        if not confirm:
            raise ValueError("restore replaces the graph; pass confirm=True")
        self._commit(self.spark.read.schema(NODE).parquet(f"{snapshot}/nodes"), self.spark.read.schema(EDGE).parquet(f"{snapshot}/edges"))

    def prune(self, keep: int = 3) -> list[str]:
        """Removes all but the newest finished versions, and what lost writers left before them; the names of those that went."""
        every = self._folders()
        kept = [v for v in every if self._finished(v)][-max(1, keep) :]
        gone = [v for v in every if kept and v < kept[-1] and v not in kept]
        for v in gone:
            p, fs = self._fs(f"{self.path}/{v}")
            fs.delete(p, True)
        return gone

    def register(self) -> None:
        """The tables as temporary views nodes and edges, for SQL."""
        self.nodes.createOrReplaceTempView("nodes")
        self.edges.createOrReplaceTempView("edges")

    def graph(self, limit: int = 500) -> DataFrame:
        return reads.graph(self.nodes, self.edges, limit)

    def labels(self) -> DataFrame:
        return reads.labels(self.nodes)

    def neighborhood(self, name: str, limit: int = 200) -> DataFrame:
        """Raises KeyError for an unknown name."""
        got = reads.neighborhood(self.nodes, self.edges, name, limit)
        if got.isEmpty():
            raise KeyError(name)
        return got

    def dedup_metrics(self) -> DataFrame:
        return reads.dedup_metrics(self.nodes, self.edges)

    def hubs(self, k: int = 10) -> DataFrame:
        return reads.hubs(self.edges, k)

    def graphml(self, limit: int = 500) -> DataFrame:
        from ..sources.graphml import lines

        rows = self.graph(limit)
        return lines(reads.view_nodes(rows), reads.view_edges(rows))

    def replay(self, doc_id: str, triples: DataFrame, fold: str = "casefold") -> LoadStats:
        """One document anew: its edges go and those of triples come, in one version."""
        return self.upsert(triples, fold, self.spark.createDataFrame([(doc_id,)], "doc_id string"))

    def by_document(self, doc_id: str, prefix: bool = False) -> DataFrame:
        return reads.by_document(self.edges, doc_id, prefix)

    def inferred_only(self, limit: int = 50) -> DataFrame:
        return reads.inferred_only(self.edges, limit)
