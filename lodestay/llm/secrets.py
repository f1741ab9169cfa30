"""Secrets: patterns, then sliding-window Shannon entropy per character class over candidate strings, with an allow-list.

The patterns (assign, access, hex) give the base spans, which always stay, allow-listed or not. A candidate is a maximal run
of at least WINDOW characters of `[A-Za-z0-9+/_=-]` that touches no base span. Its class is the narrowest that holds all of
it: hexadecimal, capitals and digits, or all of those characters; each class has its own bounds. A window of WINDOW
characters slides along the candidate. Two tables of counts follow it, of characters and of their sorts (small letter,
capital, digit, other): the character that enters is added and the one that leaves is taken out, and with it their part of
the entropy, so a step costs the same whatever the window. Windows that reach the class's bound in both entropies are
joined where they overlap, and a stretch of the class's least length that has letters and digits is an added span, unless an
allow-list rule suppresses its candidate. An added span's kind is the base kind whose values are of that class: hex,
access (capitals and digits) or assign.

Null text counts as empty; an empty text has no spans; repeated rows get equal spans, in place; texts and candidates of any
length are read whole, in time proportional to their length; other columns are left out, so their names can't clash; an
empty table gives no rows. Of spans with equal starts the kind listed first comes first. No row moves between tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import documents, slices

KINDS = ("assign", "access", "hex")
Span = tuple[int, str, int]  # start, kind, end

#: The base patterns.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
LONG_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX},}}")  # HEX's matches of the least length, found without stopping at shorter ones

WINDOW = 16
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}")


@dataclass(frozen=True)
class CharacterClass:
    """Bounds in bits a character, of characters and of their sorts; shortest is the least length of a span."""

    kind: str
    whole: re.Pattern[str]
    characters: float
    sorts: float
    shortest: int


#: Narrowest first. A window of 16 random characters has about 3.2 bits in hex, 3.6 in capitals and digits, 3.8 in all of
#: them; prose without blanks about 3.3, but of one sort.
CLASSES = (
    CharacterClass("hex", re.compile(r"[0-9a-fA-F]+"), 2.6, 0.3, 24),
    CharacterClass("access", re.compile(r"[A-Z0-9]+"), 3.0, 0.3, 20),
    CharacterClass("assign", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.3, 0.5, 20),
)
SORT = {c: s for s, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_=-")) for c in chars}
#: n * log2(n) by n: what a count of n adds to the sum that entropy is made of.
PART = [0.0, *(n * log2(n) for n in range(1, WINDOW + 1))]

#: A rule of the allow-list: a pattern searched in the candidate with up to BEFORE code points before it and one after, where
#: two NUL characters stand around the candidate itself.
BEFORE = 64
ALLOWED: tuple[re.Pattern[str], ...] = (
    re.compile(r"\0[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\0"),  # a UUID
    re.compile(r"(://|www\.)\S*\0"),  # part of a URL
    re.compile(r"\0@|@\S*\0[^\0]*\0"),  # part of an address
    re.compile(r"\0sha(1|256|384|512)[-_=]"),  # a published digest
    re.compile(r"(;base64,|sha(1|256|384|512)[:-] ?)\0"),  # embedded data, or again a digest
    re.compile(r"\0[^\0]*(example|sample|dummy|placeholder|changeme|redacted|x{6}|0123456789|1234567890|abcdefgh)[^\0]*\0", re.IGNORECASE),
)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOWEL = re.compile("[AEIOUYaeiouy]")


def worded(candidate: str) -> bool:
    """Whether the candidate is made of words: its runs of letters, cut where a capital follows a small letter, have five
    letters or more in the mean (four where there are letters of both cases), and three of ten letters are vowels. Of random
    letters one in four is, and runs among digits have about two letters, or under four where all are of one case."""
    runs = PIECES.findall(candidate)
    letters = "".join(runs)
    least = 5 if letters.islower() or letters.isupper() else 4
    return bool(runs) and len(letters) >= least * len(runs) and 10 * len(VOWEL.findall(letters)) >= 3 * len(letters)


def base_spans(text: str) -> list[Span]:
    """By start, then by kind as listed; offsets in code points."""
    out: list[tuple[int, int, str, int]] = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, "hex", m.end()) for m in LONG_HEX.finditer(text)]
    return [(a, k, b) for a, _, k, b in sorted(out)]


def windows(candidate: str, window: int = WINDOW) -> Iterator[tuple[float, float]]:
    """Entropy of characters and of their sorts, in bits a character, of every window from left to right, by counts that
    change by one character in and one out."""
    counts: dict[str, int] = {}
    sorts = [0] * 4
    of_chars = of_sorts = 0.0
    full, part = log2(window), PART if window == WINDOW else [0.0, *(n * log2(n) for n in range(1, window + 1))]
    for i, c in enumerate(candidate):
        if i >= window:
            old = candidate[i - window]
            n = counts[old]
            counts[old] = n - 1
            of_chars += part[n - 1] - part[n]
            n = sorts[SORT[old]]
            sorts[SORT[old]] = n - 1
            of_sorts += part[n - 1] - part[n]
        n = counts.get(c, 0)
        counts[c] = n + 1
        of_chars += part[n + 1] - part[n]
        n = sorts[SORT[c]]
        sorts[SORT[c]] = n + 1
        of_sorts += part[n + 1] - part[n]
        if i >= window - 1:
            yield full - of_chars / window, full - of_sorts / window


def stretches(candidate: str) -> list[tuple[int, int, str]]:
    """Where the candidate looks random: (start, end, kind), windows over their class's bounds joined where they overlap."""
    kind = next(c for c in CLASSES if c.whole.fullmatch(candidate))
    out: list[tuple[int, int]] = []
    for i, (characters, sorts) in enumerate(windows(candidate)):
        if characters >= kind.characters and sorts >= kind.sorts:
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], i + WINDOW)
            else:
                out.append((i, i + WINDOW))
    mixed = lambda s: any(SORT[c] == 2 for c in s) and any(SORT[c] < 2 for c in s)
    return [(a, b, kind.kind) for a, b in out if b - a >= kind.shortest and mixed(candidate[a:b])]


def allowed(text: str, start: int, end: int, rules: Sequence[re.Pattern[str]]) -> bool:
    seen = f"{text[max(0, start - BEFORE) : start]}\0{text[start:end]}\0{text[end : end + 1]}"
    return worded(text[start:end]) or any(rule.search(seen) for rule in rules)


def added_spans(text: str, base: list[Span], rules: Sequence[re.Pattern[str]] = ALLOWED) -> tuple[list[Span], int]:
    """Spans beside the base ones, and how many the allow-list suppressed."""
    out: list[Span] = []
    suppressed = at = 0
    held: list[list[int]] = []  # base spans joined where they overlap, in text order
    for a, _, b in base:
        if held and a < held[-1][1]:
            held[-1][1] = max(held[-1][1], b)
        else:
            held.append([a, b])
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(held) and held[at][1] <= start:
            at += 1
        if at < len(held) and held[at][0] < end:
            continue
        found = stretches(m.group())
        if found and allowed(text, start, end, rules):
            suppressed += len(found)
        else:
            out += [(start + a, kind, start + b) for a, b, kind in found]
    return out, suppressed


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def find(docs: DataFrame, text: str = "text", rules: Sequence[re.Pattern[str]] = ALLOWED) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_assign, n_access, n_hex (base spans), base, spans (all), n_added, n_suppressed."""
    names = [*[f"n_{k}" for k in KINDS], "base", "spans", "n_added", "n_suppressed"]
    kinds = [T.LongType()] * 3 + [T.StringType()] * 2 + [T.LongType()] * 2
    arrow = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(n, t) for n, t in zip(names, kinds, strict=True)]])
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            rows = []
            for t in batch.column(text).to_pylist():
                base = base_spans(t or "")
                more, suppressed = added_spans(t or "", base, rules)
                every = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1])))
                rows.append((*(sum(k == s[1] for s in base) for k in KINDS), listed(base), listed(every), len(more), suppressed))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    return docs.select("doc_id", text).mapInArrow(run, schema)


def op11_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added", "n_suppressed")
