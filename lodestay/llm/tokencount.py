"""Token counts by linear longest match: a vocabulary trie with failure links and counts of popped tokens.

Greedy word pieces are counted without being built. Each trie node has a failure link (where matching goes on) and the
number of pieces popped on the way; a word is read once, letter by letter, each step popping counts instead of starting
again. Words are runs without blanks, A-Z lower-cased, as UTF-8 bytes, the last byte marked as the word's end (as a piece's
last byte is, where it may only close a word); a word that the vocabulary can't spell counts as one unknown token. Answers for short words are kept in the worker.

A very long text is counted a stretch of about a megabyte at a time, a very long word letter by letter. Null text has no words; repeated rows get the same counts; other columns pass through, replaced where named alike; an empty
table gives no rows. No row moves between tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodestay.llm.common import as_bytes, documents, slices
from lodestay.llm.vocab import KEEP, LONGEST, byte_letters, default_path, pieces_of, word_runs

END = 256
NONE = -1


def closed(word: bytes) -> list[int]:
    """The word's bytes, the last with the end mark."""
    return [*word[:-1], *[b + END for b in word[-1:]]]


class Automaton(dict):
    """Word (lower-cased bytes) -> number of greedy pieces, negative if it can't be spelt."""

    def __init__(self, pieces: Iterable[tuple[bytes, bool]]):
        self.go: dict[int, int] = {}  # node * 512 + symbol -> node
        parent, symbol, whole = [0], [0], [False]
        for piece, ends in pieces:
            at = 0
            for s in closed(piece) if ends else piece:
                to = self.go.get(at * 512 + s)
                if to is None:
                    to = self.go[at * 512 + s] = len(parent)
                    parent.append(at)
                    symbol.append(s)
                    whole.append(False)
                at = to
            whole[at] = at > 0
        self.fail, self.popped = [NONE] * len(parent), [0] * len(parent)
        depth = [0] * len(parent)
        for v in range(1, len(parent)):  # parents come first
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(1, len(parent)), key=depth.__getitem__):
            if whole[v]:
                self.fail[v], self.popped[v] = 0, 1
                continue
            u, s = parent[v], symbol[v]
            z, n = self.fail[u], self.popped[u]
            while z != NONE and z * 512 + s not in self.go:
                n += self.popped[z]
                z = self.fail[z]
            if z != NONE:
                self.fail[v], self.popped[v] = self.go[z * 512 + s], n

    def count(self, word: bytes) -> int:
        go, fail, popped = self.go, self.fail, self.popped
        at = n = 0
        for s in closed(word):
            while (to := go.get(at * 512 + s)) is None:
                if fail[at] == NONE:
                    return NONE
                n += popped[at]
                at = fail[at]
            at = to
        while at:
            if fail[at] == NONE:
                return NONE
            n += popped[at]
            at = fail[at]
        return n

    def __missing__(self, word: bytes) -> int:
        n = self.count(word)
        if len(word) <= LONGEST:
            if len(self) >= KEEP:
                self.clear()
            self[word] = n
        return n


@cache
def automaton(path: str) -> Automaton:
    back = {c: b for b, c in byte_letters().items()}
    return Automaton((bytes(back[c] for c in p), e) for p, e in pieces_of(path) if all(c in back for c in p))


def token_counts(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """docs with n_words, n_tokens and n_unknown (words counted as one unknown token each)."""
    path = path or default_path()
    added = ("n_words", "n_tokens", "n_unknown")
    docs = docs.drop(*added)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType()) for n in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = automaton(path)
        for batch in slices(batches, text, 4 << 20):
            found = []
            for t in as_bytes(batch.column(text)):
                words = tokens = unknown = 0
                for run_ in word_runs(t.lower()):
                    n = list(map(counts.__getitem__, run_))
                    bad = n.count(NONE)
                    words, unknown, tokens = words + len(n), unknown + bad, tokens + sum(n) + 2 * bad
                found.append((words, tokens, unknown))
            made = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
