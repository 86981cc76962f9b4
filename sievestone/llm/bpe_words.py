"""Splitting of texts into the words that a byte-level BPE encodes one by one.

A byte-level tokenizer file cuts a text at its special strings and then by a fixed pattern into words;
merges never cross a word. Where all characters of a text are Latin letters and common punctuation, the
pattern is spelt out here with explicit ranges and run by the standard library; any other text is split
by the tokenizer's own pre-tokenizer, so that no difference between Unicode tables can matter.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property

from . import common

LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
DIGIT = r"0-9\xb2\xb3\xb9\xbc-\xbe"
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{BLANK}{LETTER}{DIGIT}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
#: Characters outside of these ranges send a text to the tokenizer's own splitter.
UNUSUAL = re.compile(r"[^\t-\r -~\x85\xa0-\u024f\u2010-\u203a\u20ac]")


def default_path() -> str:
    """The vocabulary file on this machine; looked up where it is read, since executors have their own copy."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def file_digest(path: str | None) -> str:
    with open(path or default_path(), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteVocabulary:
    """Tokens, merges and special strings of a tokenizer file whose words are bytes."""

    def __init__(self, path: str | None = None) -> None:
        self.path = path or default_path()
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer") or spec["model"].get("ignore_merges"):
            raise ValueError(f"{self.path}: only byte-level BPE without a normalizer or prefix space is supported")
        letters = byte_letters()
        self.tokens: dict[bytes, int] = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        vocab = spec["model"]["vocab"]
        for rank, (a, b) in enumerate(merges):
            self.merged[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{self.path}: special strings that strip or need word bounds are not supported")
        self.bytes_of: dict[int, bytes] = {i: t for t, i in self.tokens.items()} | {i: s.encode() for s, i in self.special.items()}
        self.longest = max(map(len, self.tokens))
        self._special = re.compile("|".join(f"({re.escape(s)})" for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    @cached_property
    def library(self):
        """The same file, read by the tokenizers library."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    @classmethod
    def cached(cls, path: str | None = None) -> ByteVocabulary:
        kept = common.worker_cache()
        key = "byte vocabulary", path
        if key not in kept:
            kept[key] = cls(path)
        return kept[key]

    def pieces(self, text: str) -> Iterator[str | int]:
        """Parts of a text between special strings, and the ids of those."""
        if self._special is None:
            yield text
            return
        at = 0
        for m in self._special.finditer(text):
            if m.start() > at:
                yield text[at : m.start()]
            yield self.special[m[0]]
            at = m.end()
        if at < len(text):
            yield text[at:]

    def words(self, text: str) -> list[str]:
        """The words of a text without special strings; joined they give the text."""
        if UNUSUAL.search(text) is None:
            return WORD.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
