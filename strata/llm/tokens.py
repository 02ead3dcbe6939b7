"""Byte-level BPE ids of whole texts, encoded by the ``tokenizers`` library and remembered by chunk.

Byte-level BPE first cuts a text where a space is followed by something else than white space, and merges never cross a
cut.  So the ids of a text are the ids of its chunks in order, and a chunk that was met before need not be merged again.
The memory is a cache of bounded size: it changes the time, never the ids.

The tokenizer stays as loaded: strings of its added tokens become the ids of these, as ``encode(text,
add_special_tokens=False)`` has it.  A text is split at them first, so no chunk holds one; what stands between two is a
text of its own.
"""

from __future__ import annotations

import os
import re
from struct import Struct

import numpy as np

END_ID = 2
CACHE_CHUNKS = 550_000

CUT = re.compile(r" (?=\S)")
UNSAFE_SPACE = re.compile(r" (?:\s|$)")
OTHER_SPACE = re.compile(r"[^\S\n]")
#: Marks that end a chunk and are always a unit of their own after a letter.
ENDING_MARKS = ",.!?;:#$%&*|<>)"

_ENCODERS: dict[str, Encoder] = {}


def _byte_characters() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: printable ones stand for themselves, the others are
    numbered from 256."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTE_CHARACTERS = _byte_characters()
PACKERS = [Struct(f"<{n}I") for n in range(64)]


class _Chunks(dict):
    """Ids of chunks, as little-endian unsigned 32-bit bytes; ``before`` is what stands before each chunk.

    When the newer half of the cache is full it becomes the older half; what is met again moves back to the newer one.
    """

    def __init__(self, tokenizer, before: str, heads: _Chunks | None = None) -> None:
        super().__init__()
        self.tokenizer, self.before, self.heads = tokenizer, before, heads if heads is not None else self
        self.tokenize, self.older = tokenizer.model.tokenize, {}
        self.shown_before = before.translate(BYTE_CHARACTERS)

    def ids(self, chunk: str) -> bytes:
        encoded = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(encoded, dtype="<u4").tobytes()

    def word_ids(self, word: str) -> bytes:
        """Ids of a word of letters only, which is one unit with what stands before: merged without cutting it first."""
        if word.isascii():
            shown = self.shown_before + word
        else:
            shown = self.shown_before + word.encode("utf-8").decode("latin-1").translate(BYTE_CHARACTERS)
        ids = [token.id for token in self.tokenize(shown)]
        return (PACKERS[len(ids)] if len(ids) < len(PACKERS) else Struct(f"<{len(ids)}I")).pack(*ids)

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            if chunk.isalpha():
                found = self.word_ids(chunk)
            elif "\n" in chunk:
                lines = chunk.split("\n")
                if all(lines) and not OTHER_SPACE.search(chunk):
                    heads = self.heads
                    return heads.newline.join([self[lines[0]], *[heads[line] for line in lines[1:]]])
                found = self.ids(self.before + chunk)
            else:
                stem = chunk.rstrip(ENDING_MARKS)
                if len(stem) < len(chunk) and stem and stem[-1].isalpha():
                    found = self[stem] + self.heads[chunk[len(stem):]]
                else:
                    found = self.ids(self.before + chunk)
        if len(self) >= CACHE_CHUNKS:
            self.older = dict(self)
            self.clear()
        self[chunk] = found
        return found


class Encoder:
    """Encodes texts with a tokenizer file as it is; strings of added tokens in a text are those tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {token.content: (number, token) for number, token in self.tokenizer.get_added_tokens_decoder().items() if token.content}
        # Tokens that take in white space or ask for word ends or a normal form are left to the library, text by text.
        self.plain_added = not any(t.lstrip or t.rstrip or t.single_word for _, t in added.values()) and self.tokenizer.normalizer is None
        self.added = {content: np.array([number], dtype="<u4").tobytes() for content, (number, _) in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_strings = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.heads = _Chunks(self.tokenizer, "")
        self.heads.newline = self.heads.ids("\n")
        self.chunks = _Chunks(self.tokenizer, " ", self.heads)

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, without an end id."""
        if not text:
            return b""
        if self.added_strings is None or not self.added_strings.search(text):
            return self.encode_between(text)
        if not self.plain_added:
            return self.heads.ids(text)
        parts = self.added_strings.split(text)
        parts[0::2] = [self.encode_between(part) if part else b"" for part in parts[0::2]]
        parts[1::2] = [self.added[content] for content in parts[1::2]]
        return b"".join(parts)

    def encode_between(self, text: str) -> bytes:
        """Ids of a text without strings of added tokens."""
        parts = CUT.split(text) if UNSAFE_SPACE.search(text) else text.split(" ")
        first = self.heads[parts[0]] if parts[0] else b""
        del parts[0]
        return first + b"".join(map(self.chunks.__getitem__, parts))


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
