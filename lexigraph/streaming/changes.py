"""The corpus watched: each trigger lists it, compares with the last state and passes the changes on.

A file stream never reports deletions, so the trigger is a rate stream and the listing a batch read. State is a versioned
table that is replaced after the changes were applied: a crash repeats them, and applying them twice changes nothing.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.changes import diff, upserts
from ..plans.tables import cut, drop_cut
from ..sources.corpus import snapshot
from ..types import STATE


class Watcher:
    def __init__(self, spark: SparkSession, root: str, state: str, apply: Callable[[DataFrame], None], glob: str = "*.txt"):
        self.spark, self.root, self.path, self.apply, self.glob = spark, root, state.rstrip("/"), apply, glob

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        p, fs = self._fs(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[1:]) for n in names if n[:1] == "s" and n[1:].isdigit() and fs.exists(self._fs(f"{self.path}/{n}/_SUCCESS")[0]))

    def state(self) -> DataFrame:
        """The last whole state. None counts as empty, and so does one that can't be read, with a warning: every document is then new."""
        v = self._versions()
        if v:
            try:
                held = self.spark.read.schema(STATE).parquet(f"{self.path}/s{v[-1]}")
                held.agg(F.max(F.xxhash64(*held.columns))).first()  # reads all of it; it has a row for each file of the corpus
                return held
            except Exception as e:
                warnings.warn(f"the state {self.path}/s{v[-1]} can't be read and counts as empty: {type(e).__name__}", stacklevel=2)
        return self.spark.createDataFrame([], STATE)

    def poll(self) -> int:
        """One round; how many changes there were. The new state is written whole, and put in force by a rename after the changes were applied."""
        now = snapshot(self.spark, self.root, self.glob)
        v = (self._versions() or [0])[-1] + 1
        now.write.mode("overwrite").parquet(f"{self.path}/next{v}")
        now = self.spark.read.schema(STATE).parquet(f"{self.path}/next{v}")
        events = cut(diff(self.state(), now).orderBy(F.desc("kind"), "doc_id"), "events")
        n = events.count()
        if n:
            self.apply(events)
        drop_cut(events)
        new, fs = self._fs(f"{self.path}/next{v}")
        fs.rename(new, self._fs(f"{self.path}/s{v}")[0])
        for old in self._versions()[:-2]:
            fs.delete(self._fs(f"{self.path}/s{old}")[0], True)
        return n

    def run(self, max_iterations: int | None = None, interval: float = 5.0) -> int:
        """Polls in the caller's thread, for ever or so many times; how many changes there were in all."""
        n = done = 0
        while max_iterations is None or done < max_iterations:
            if done:
                time.sleep(interval)
            n, done = n + self.poll(), done + 1
        return n

    def start(self, interval: str = "5 seconds", once: bool = False, checkpoint: str | None = None) -> StreamingQuery:
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        writer = ticks.writeStream.foreachBatch(lambda _, __: self.poll() and None)
        writer = writer.option("checkpointLocation", checkpoint) if checkpoint else writer
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def apply_events(events: DataFrame, reextract: Callable[[DataFrame], None], delete: Callable[[DataFrame], None]) -> int:
    """Routes changed documents to reextract and gone ones to delete, each as one table of events; how many there were.

    Deletions come first: a document that moved then keeps what its new place gives.
    """
    sides = [(delete, events.filter("kind = 'delete'")), (reextract, upserts(events))]
    total = 0
    for f, some in sides:
        n = some.count()
        total += n
        if n:
            f(some)
    return total


def into_store(store, read: Callable[[], DataFrame], triples_of: Callable[[DataFrame], DataFrame], fold: str = "casefold") -> Callable[[DataFrame], None]:
    """A function for Watcher: gone documents lose their edges, and changed ones are read, extracted and put in their place, one version each.

    read: the corpus as documents (seq, doc_id, text). triples_of: their triples.
    """

    def again(events: DataFrame) -> None:
        own = read().join(events.select("doc_id"), "doc_id", "left_semi")
        store.upsert(triples_of(own), fold, instead_of=events.select("doc_id"))

    return lambda events: apply_events(events, again, lambda gone: store.delete(gone.select("doc_id"))) and None


def event_windows(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event type in tumbling windows; works on streams (with a watermark) and on tables."""
    own = events.withWatermark("ts", late) if events.isStreaming else events
    got = own.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return got.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
