"""Quality by weak supervision: rules vote good, bad or abstain; EM estimates each rule's accuracies; the posterior decides.

The votes of a document form a pattern, and there are at most 3 ** len(RULES) patterns, however many documents there are:
one distributed count of patterns over all documents is all that EM reads. Each rule has, for good and for bad documents,
a probability of every vote (abstaining included); rules count as independent given the class.

Words are runs of characters other than space and \\t to \\r. Null texts count as empty: no words, base_failed. Repeated rows
give repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialize, texts

_SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\x0b\x0c\r"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"[0-9]")

_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, votes string"


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() splits at exactly these six characters
    chars = len(text) - sum(map(text.count, _BLANK))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    triples = list(zip(words, words[1:], words[2:]))
    counts = Counter(triples)
    repeat = 0
    if len(counts) < len(triples):
        seen = bytearray(len(words))
        for i, t in enumerate(triples):
            if counts[t] > 1:
                seen[i : i + 3] = b"\1\1\1"
        repeat = sum(seen)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat


def _band(x: float, good: float, bad: float) -> str:
    """Good up to good, bad from bad (or the other way round, if good is larger), else none."""
    if good <= bad:
        return "+" if x <= good else "-" if x >= bad else "0"
    return "+" if x >= good else "-" if x <= bad else "0"


def _votes(text: str, m: tuple[int, int, int, int, int]) -> str:
    n, chars, symbols, dup, repeat = m
    if not n:
        return "-" * len(RULES)
    lines = text.count("\n") + 1
    letters = max(1, len(_LETTER.findall(text)))
    return "".join(
        (
            _band(symbols / n, 0.02, 0.2),
            _band(dup / lines, 0.05, 0.3),
            _band(repeat / n, 0.1, 0.3),
            _band(len(_UPPER.findall(text)) / letters, 0.15, 0.4),
            "+" if 3 <= chars / n <= 10 else "-" if not 2 <= chars / n <= 15 else "0",
            _band((text.count("!") + text.count("?")) / n, 0.05, 0.3),
            _band(len(_DIGIT.findall(text)) / max(1, chars), 0.15, 0.3),
            _band(letters / max(1, chars), 0.9, 0.75),
            _band(sum(not _LETTER.search(w) for w in text.split()) / n, 0.1, 0.2),
            "+" if n >= 100 else "-" if n < 20 else "0",
        )
    )


RULES = ("symbols", "repeated lines", "repeated words", "capitals", "word length", "exclamations", "digits", "letters", "words without letters", "length")


def em(patterns: dict[str, int], rounds: int = 100, prior: float = 0.9, smooth: float = 1.0, trust: tuple[float, float] = (0.3, 3.5)) -> dict[str, float]:
    """The posterior of good for each vote pattern.

    Starts from weighted votes, a vote for bad counting trust[1] and one for good trust[0], so that "good" keeps its meaning.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    v = np.array([["-0+".index(c) for c in k] for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    post = 1 / (1 + np.exp(-trust[0] * (v == 2).sum(1) + trust[1] * (v == 0).sum(1) - np.log(prior / (1 - prior))))
    hot = np.eye(3)[v]  # pattern, rule, vote
    for _ in range(rounds):
        w = np.stack([n * (1 - post), n * post])
        share = w.sum(1) / n.sum()
        like = np.einsum("cp,pjv->cjv", w, hot) + smooth * np.array([[2.0, 1, 1], [1.0, 1, 2]])[:, None, :]
        like /= like.sum(2, keepdims=True)
        score = np.einsum("pjv,cjv->cp", hot, np.log(like)) + np.log(np.clip(share, 1e-6, 1))[:, None]
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return dict(zip(keys, post.tolist()))


def judge(docs: DataFrame, least: float = 0.5, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """doc_id, the measures, base_failed, kept and the posterior quality."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        ms = [measures(t) for t in cols["text"]]
        failed = [m[0] < min_words or 100 * m[4] > max_repeat * m[0] for m in ms]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return {"doc_id": cols["doc_id"], "base_failed": failed, "votes": list(map(_votes, cols["text"], ms))} | {k: [m[i] for m in ms] for i, k in enumerate(names)}

    got = materialize(map_rows(texts(docs), run, _SCHEMA), "votes")
    patterns = {r["votes"]: r["count"] for r in got.groupBy("votes").count().collect()}  # at most 3 ** len(RULES) rows
    table = F.broadcast(got.sparkSession.createDataFrame(sorted(em(patterns).items()), "votes string, quality double"))
    return got.join(table, "votes").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("quality") >= least)).alias("kept"), "quality")
