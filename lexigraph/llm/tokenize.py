"""Word splitting and encoding for the two public BPE tokenizers, each distinct word once."""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

#: Outside these characters (control characters and all beyond Latin Extended-A) the library's own normaliser and splitter do the work.
_ODD = re.compile("[^\t\n\r -~\xa1-\xac\xae-ſ]")
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t\n\r "
_LOWER_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+")
_BYTE_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    own = set(plain)
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_CHARS = byte_chars()
_BYTES = {c: b for b, c in enumerate(_CHARS)}


def to_byte_level(word: str) -> str:
    return "".join(_CHARS[b] for b in word.encode())


def from_byte_level(piece: str) -> str:
    return bytes(_BYTES[c] for c in piece).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, without truncation and padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def ranked(path: str):
    """A faster encoder of single words, where the vocabulary allows it: its ids must be in the order of its merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, plain = model["vocab"], ("end_of_word_suffix", "continuing_subword_prefix", "unk_token", "dropout")
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if any(model.get(k) for k in plain) or merged != sorted(set(merged)) or any(c not in vocab for c in _CHARS) or merged[0] <= max(vocab[c] for c in _CHARS):
        return None
    import tiktoken

    keep = {*merged, *(vocab[c] for c in _CHARS)}
    ranks = {bytes(_BYTES[c] for c in t): i for t, i in vocab.items() if i in keep}
    return tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Splitter:
    """Texts to words such that the ids of a text are those of its words, joined.

    A word is ('', word) flattened to str: plain words stand for themselves, added tokens of the vocabulary that occur
    literally in a text stand as chr(0) plus their content.
    """

    def __init__(self, path: str, lower: bool):
        self.tokenizer, self.lower = load(path), lower
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.marks = list(self.added)
        self.ranked = ranked(path)

    def words(self, text: str) -> list[str]:
        if self.special and any(m in text for m in self.marks):
            out: list[str] = []
            for part in self.special.split(text):
                out += ["\0" + part] if part in self.added else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii() and not _CONTROL.search(text) or not _ODD.search(text):
            return _LOWER_WORDS.findall(text.lower()) if self.lower else _BYTE_WORDS.findall(text)
        t = self.tokenizer
        if t.normalizer is not None:
            text = t.normalizer.normalize_str(text)
        return [from_byte_level(p) for p, _ in t.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self) -> list[str]:
        """The piece of each id."""
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            out[i] = piece
        return out

    def ids(self, word: str) -> list[int]:
        if word[:1] == "\0" and word[1:] in self.added:
            return [self.added[word[1:]]]
        if self.ranked:
            return self.ranked(word.encode())
        return [t.id for t in self.tokenizer.model.tokenize(to_byte_level(word))]


_CONTROL = re.compile("[\0-\x08\x0b\x0c\x0e-\x1f\x7f]")


class IdBytes(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes, encoded on first sight; emptied when it holds too many words."""

    LIMIT = 500_000

    def __init__(self, splitter: Splitter):
        self.splitter = splitter

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        ids = self.splitter.ids(word)
        self[word] = out = struct.pack("<%dI" % len(ids), *ids)
        return out

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.splitter.words(text)))
