"""Completions of prompts by a client that the caller provides. Their results must be written before they are parsed: a recomputed plan would ask again."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..plans.tables import bounded_batches, cut


class Client(Protocol):
    def complete(self, prompt: str) -> str: ...


class ExtractionError(RuntimeError):
    pass


class Unanswered(Exception):
    """A reply that trying again won't mend."""


class Hosted:
    """A hosted model behind send, which takes a request and returns a reply as dictionaries; the caller brings the transport.

    Without a key there is no client. A transport's failure is a RuntimeError, which is tried again; a reply without text is
    Unanswered, which is not.
    """

    def __init__(self, send: Callable[[dict], dict], key: str | None, model: str, temperature: float = 0.0):
        if not key or not key.strip():
            raise ValueError("a hosted model needs a key")
        self.send, self.key, self.model, self.temperature = send, key.strip(), model, temperature

    def complete(self, prompt: str) -> str:
        try:
            reply = self.send({"key": self.key, "model": self.model, "temperature": self.temperature, "prompt": prompt})
        except OSError as e:
            raise RuntimeError("the transport failed") from e
        if not isinstance(reply.get("text"), str):
            raise Unanswered("the reply holds no text")
        return reply["text"]


class Scripted:
    """Answers in turn; the last one repeats."""

    def __init__(self, answers: list[str]):
        self.answers, self.prompts = list(answers), []

    def complete(self, prompt: str) -> str:
        self.prompts.append(prompt)
        return self.answers.pop(0) if len(self.answers) > 1 else self.answers[0]


class FirstWords:
    """Answers a prompt over numbered documents with one fact for each: its first word comes before its second one."""

    def complete(self, prompt: str) -> str:
        body = prompt.rpartition("\n\nText:\n")[2].removesuffix("\n\nAnswer:\n")
        parts = re.split(r"(?:\A|\n\n)Document [0-9]+ \(doc_id ([^)]*)\):\n", body)[1:]
        out = []
        for doc, text in zip(parts[::2], parts[1::2]):
            words = re.findall(r"[^\x20\x09-\x0D]+", text)[:2]
            if len(words) == 2:
                out.append({"doc_id": doc, "subject": {"name": words[0]}, "predicate": "comes before", "object": {"name": words[1]}, "confidence": 0.9})
        return f"Here it is: {json.dumps(out)}"


class Failing:
    """Fails so many times, then asks inner."""

    def __init__(self, failures: int, inner: Client):
        self.failures, self.inner = failures, inner

    def complete(self, prompt: str) -> str:
        if self.failures:
            self.failures -= 1
            raise RuntimeError("the client failed")
        return self.inner.complete(prompt)


def with_retries(client: Client, prompt: str, max_retries: int) -> tuple[str, int]:
    """(answer, failures); after max_retries + 1 failures an ExtractionError. Only RuntimeError is tried again."""
    for n in range(max_retries + 1):
        try:
            return client.complete(prompt), n
        except RuntimeError as e:
            last = e
    raise ExtractionError(f"no answer after {max_retries + 1} attempts") from last


def completions(prompts: DataFrame, client: Callable[[], Client], max_retries: int = 2) -> DataFrame:
    """prompts (a column prompt and any others) with raw and retries; client is called once in each task, on the executor. The result is written in the shared folder."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema), "raw string", "retries int"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        for f in frames:
            got = [with_retries(own, p, max_retries) for p in f["prompt"]]
            yield f.assign(raw=[g[0] for g in got], retries=[g[1] for g in got])

    bounded_batches(prompts.sparkSession)  # a prompt holds whole texts
    return cut(prompts.mapInPandas(run, schema), "completions")


def embedder(provider: str = "hashed", dimensions: int = 256, n: int = 3, send: Callable[[str], list[float]] | None = None) -> Callable[[str], list[float]]:
    """A text's vector: "hashed" counts its n-grams in buckets and makes the length 1 (0 for none); "hosted" asks send."""
    if provider == "hosted":
        if send is None:
            raise ValueError("a hosted provider needs a transport")
        return send
    if provider != "hashed":
        raise ValueError(f"unknown provider {provider!r}; known: hashed, hosted")

    def hashed(text: str) -> list[float]:
        padded, v = f" {text} ", [0.0] * dimensions
        for i in range(len(padded) - n + 1):
            v[int.from_bytes(hashlib.blake2b(padded[i : i + n].encode(), digest_size=4).digest(), "big") % dimensions] += 1
        norm = math.sqrt(sum(x * x for x in v))
        return [x / norm for x in v] if norm else v

    return hashed


def embeddings(names: DataFrame, embed: Callable[[], Callable[[str], list[float]]], name: str = "name") -> DataFrame:
    """(name, embedding) by a provider that the caller makes, once in each task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = embed()
        for f in frames:
            yield pd.DataFrame({"name": f[name], "embedding": [list(map(float, own(x))) for x in f[name]]})

    bounded_batches(names.sparkSession)
    return cut(names.select(name).distinct().mapInPandas(run, "name string, embedding array<double>"), "embeddings")
