"""Word vocabularies of public tokenizers, kept once in each worker process. Files are read from their path, never copied."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache

from lodestay.llm.common import BLANKS

#: Words kept with their answer in a worker, and the longest word that is kept.
KEEP, LONGEST = 400_000, 64
CHUNK = 1 << 20
BLANK_BYTES = BLANKS.encode()


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, a bounded stretch of text at a time."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        while end < len(text) and text[end] not in BLANK_BYTES:
            end += 1
        yield text[start:end].split()
        start = end


class WordIds(dict):
    """Word (UTF-8, without blanks) -> its ids as little-endian uint32, in a tokenizer that drops blanks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        table = {b: c for b, c in byte_letters().items() if 97 <= b <= 122 or b >= 128}
        self.letters = "".join(table.get(b, "\0") for b in range(256))

    def encode(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        tail = word[len(core) :]
        low = core.lower()
        if low.isalpha():  # a run of a-z is one unit to the tokenizer, and so is a run of full stops and commas
            found = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(low.decode())) + (self[tail] if core and tail else b"")
        elif len(word) <= LONGEST and core and self.latin(core):
            low = core.decode().lower().encode()
            found = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(low.decode("latin-1").translate(self.letters))) + (self[tail] if tail else b"")
        else:
            found = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= KEEP:
                self.clear()
            self[word] = found
        return found

    @staticmethod
    def latin(core: bytes) -> bool:
        """Letters of ASCII and the Latin-1 supplement only: composed already, and each has one lower-case form."""
        s = core.decode("utf-8", "replace")
        return s.isalpha() and all(c < "\x80" or "\xc0" <= c <= "\xff" for c in s)

    def ids(self, text: bytes) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, run)) for run in word_runs(text))


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


@cache
def pieces_of(path: str) -> frozenset[tuple[str, bool]]:
    """The vocabulary's pieces: (byte letters, whether the word ends with it)."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    end = model["end_of_word_suffix"]
    return frozenset((p.removesuffix(end), p.endswith(end) and p != end) for p in model["vocab"])
