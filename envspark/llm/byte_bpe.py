"""Ids of byte-level BPE vocabularies, read from a `tokenizers` file.

`tokenizers` itself spends most of its time on offsets that nobody reads here. `tiktoken` merges
the same pairs in the same order if every merge makes the next id, which is looked up when the file
is read. It is used for texts whose characters both libraries class alike (`_COMMON`); other texts,
and files of another kind, go to `tokenizers`. Nothing is remembered from one text to the next.

A text is handled in pieces of about `PIECE` characters, cut where a blank starts a word, since
no token reaches over such a place; a run without blanks is one piece whatever its length.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_OTHER = re.compile(f"[^\t\n\r -~{_LETTER}]")
#: the byte-level split for texts of the other characters
_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+"
_WORD_START = re.compile(r"(?<=\S) (?=\S)")
PIECE = 1 << 18


def pieces_of(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in order, cut before single blanks; most pieces are little longer than `size`."""
    low = 0
    while len(text) - low > size:
        cut = _WORD_START.search(text, low + size)
        if cut is None:
            break
        yield text[low:cut.start()]
        low = cut.start()
    yield text[low:] if low else text


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a byte stands for itself if it is a printable
    Latin-1 character, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Encoder:
    """Ids of texts. With `plain`, the strings of special tokens are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        before, model = parts.get("pre_tokenizer") or {}, parts["model"]
        self.special = [] if plain else [t["content"] for t in parts.get("added_tokens", [])]
        alphabet = byte_alphabet()
        self.bytes_of = {i: bytes(map(alphabet.__getitem__, token)) for token, i in model["vocab"].items()
                         if all(c in alphabet for c in token)}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in parts.get("added_tokens", [])}
        self.fast = None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        in_order = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        if (parts.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                and not before.get("add_prefix_space") and not model.get("ignore_merges")
                and model.get("dropout") is None and merges and in_order):
            import tiktoken

            ranks = {self.bytes_of[i]: i for i in range(256 + len(merges))}
            self.fast = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self._slow(text)
        if len(text) <= PIECE:
            return self._slow(text) if _OTHER.search(text) else self.fast.encode_ordinary(text)
        found: list[int] = []
        for piece in pieces_of(text):
            found.extend(self._slow(piece) if _OTHER.search(piece) else self.fast.encode_ordinary(piece))
        return found


@lru_cache(maxsize=4)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path, plain)
