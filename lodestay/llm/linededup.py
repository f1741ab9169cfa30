"""Line dedup by a segment-partition edit join: lines within a few edits of each other, or equal, are one class.

How many edits: 2 for lines of 20 code points or more, 3 from 300 on, counted by the shorter line of a pair; shorter lines
are one class only where they are equal (BANDS). A line is cut into edits + 1 segments; two lines within that distance share
one segment exactly, at a place that their lengths allow. So each line is indexed under its segments and looks up its own
substrings under each possible length, at the places that can still lead to a match. Keys are hashes of substrings, taken
from running sums of all lines of a batch at once. Only numbers are dealt by key; keys that hold one line end there, and
texts are fetched for the rest. Pairs in a key that pass a count-of-letters bound are verified by banded bit-parallel edit
distance, thousands side by side, each pair in one key only. All verified pairs are counted, by line; a spanning set of them
goes on as links. Classes are the components of the links; of a class, the first line in order of doc_id and place stays,
the others leave their documents.

Lines are compared without blanks at their ends; blank lines stay. Null text stays null; a null doc_id counts as last; rows
equal in doc_id and text are one document, whose copies all get its result; ties in doc_id are settled by a hash of the
document. Other columns pass through; an n_chars column follows the text. An empty table gives no rows. A text is read
whole, and a task holds about forty bytes a code point of its longest text. Lines and documents are told apart by 64-bit
hashes. A key with more lines than `cell` is dealt as pairs of its parts; lines that fill a large share of all places are
joined to their classes by broadcast, of which there can be SHARE at most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import BLANKS, SHARE, components, documents, materialize, shield, slices, unshield, with_common

#: (length from which it holds, edits), by rising length. A line must be longer than three times its edits.
BANDS: tuple[tuple[int, int], ...] = ((20, 2), (300, 3))
CELL = 4000
PAIRS = 8192  # verified side by side
AREA = 4 << 20  # letters of the pairs verified side by side
BINS = 32
#: Fixed odd multipliers of the hashes.
BASE, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def line_id(line: str) -> int:
    return signed(xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")))


def edits_of(lengths: np.ndarray, bands: tuple = BANDS) -> np.ndarray:
    """The edits that lines of these lengths allow."""
    at = np.searchsorted([b[0] for b in bands], lengths, "right")
    return np.array([0, *[b[1] for b in bands]])[at]


@lru_cache(2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the i-th, and its inverse, modulo 2 to the 64th."""
    return tuple(np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (BASE, pow(BASE, -1, 1 << 64)))


def keys_of(lines: list[str], bands: tuple = BANDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line's place in the list, key, whether the line is indexed under it or looks up lines of its length or shorter)."""
    n = np.fromiter(map(len, lines), np.int64, len(lines))
    letters = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    up, down = powers(1 << max(20, len(letters).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((letters + np.uint64(1)) * up[: len(letters)])))
    begin = np.cumsum(n) - n
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    most = max(e for _, e in bands)
    for gap in range(most + 1):
        length = n - gap
        allowed = edits_of(length, bands)
        for edits in sorted({e for _, e in bands}):
            who = np.flatnonzero((allowed == edits) & (gap <= edits))
            if not len(who):
                continue
            mine, other, first = n[who], length[who], begin[who]
            small, wide = other // (edits + 1), other % (edits + 1)
            for i in range(edits + 1):
                long_ones = i - (edits + 1 - wide)
                start, size = i * small + np.maximum(0, long_ones), small + (long_ones >= 0)
                # an alignment has at most i edits left of segment i, and at most edits - i right of it
                for shift in range(max(-i, gap - (edits - i)), min(i, gap + edits - i) + 1):
                    at = start + shift
                    ok = np.flatnonzero((at >= 0) & (at + size <= mine))
                    a = first[ok] + at[ok]
                    h = (sums[a + size[ok]] - sums[a]) * down[a]
                    h += (other[ok] * 64 + i).astype(np.uint64) * np.uint64(MIX[2])
                    for k in range(2):
                        h ^= h >> np.uint64(31)
                        h *= np.uint64(MIX[k])
                    h ^= h >> np.uint64(32)
                    found.append((who[ok], h.view(np.int64), np.full(len(ok), gap == 0 and shift == 0)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def within(pairs: list[tuple[str, str]], bands: tuple = BANDS) -> np.ndarray:
    """Whether each pair is within the edits that its shorter line allows.

    The band of 2 edits + 1 diagonals is one machine word a pair: bit b at column j stands for row j - edits + b.
    """
    out = np.zeros(len(pairs), bool)
    allowed = edits_of(np.array([min(len(a), len(b)) for a, b in pairs], np.int64), bands).tolist()
    pairs = [middle(a, b, e) for (a, b), e in zip(pairs, allowed, strict=True)]
    order = sorted(range(len(pairs)), key=lambda i: (allowed[i], len(pairs[i][0]) + len(pairs[i][1])))
    part: list[int] = []
    for i in order:  # by length, so that a part's letters fill a bounded table
        if part and (allowed[i] != allowed[part[0]] or len(part) >= PAIRS or (len(part) + 1) * max(map(len, pairs[i])) > AREA):
            out[part] = _within([pairs[k] for k in part], allowed[part[0]])
            part = []
        part.append(i)
    if part:
        out[part] = _within([pairs[k] for k in part], allowed[part[0]])
    return out


def middle(a: str, b: str, edits: int) -> tuple[str, str]:
    """What differs in two lines, with letters around it so that both stay longer than edits; the distance stays the same."""
    short = min(len(a), len(b))
    x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (a, b))
    same = x[:short] == y[:short]
    head = short if same.all() else int(same.argmin())
    same = x[len(x) - short :][::-1] == y[len(y) - short :][::-1]
    tail = short if same.all() else int(same.argmin())
    head = max(0, min(head, short - edits - 1))
    tail = max(0, min(tail, short - edits - 1 - head))
    return a[head : len(a) - tail], b[head : len(b) - tail]


def _codes(lines: list[str], lead: int, width: int, fill: int) -> np.ndarray:
    out = np.full((width, len(lines)), fill, np.uint32)
    for k, x in enumerate(lines):
        out[lead : lead + len(x), k] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _within(pairs: list[tuple[str, str]], edits: int) -> np.ndarray:
    m, n = (np.array([len(p[k]) for p in pairs]) for k in (0, 1))
    result = np.zeros(len(pairs), bool)
    live = np.flatnonzero(np.abs(m - n) <= edits)
    if not len(live):
        return result
    m, n = m[live], n[live]
    wide = int(max(m.max(), n.max())) + 2 * edits + 2
    p = _codes([pairs[i][0] for i in live], edits, wide, 0xFFFFFFFF)  # row i (from 1) is at edits + i - 1
    t = _codes([pairs[i][1] for i in live], 0, wide, 0xFFFFFFFE)
    full = (1 << (2 * edits + 1)) - 1
    vp = np.full(len(live), full & ~((1 << edits) - 1), np.int64)
    vn, score = np.zeros(len(live), np.int64), np.full(len(live), edits, np.int64)
    for j in range(1, int(n.max()) + 1):
        c = t[j - 1]
        x = (p[j - 1] == c).astype(np.int64)
        for b in range(1, 2 * edits + 1):
            x |= (p[j - 1 + b] == c).astype(np.int64) << b
        d0 = (((x & vp) + vp) ^ vp | x | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        row = np.maximum(m - j + edits, 0)  # the bit of the last row
        along = j + edits <= m
        score += np.where(j > n, 0, np.where(along, 1 - (d0 >> (2 * edits) & 1), (hp >> row & 1) - (hn >> row & 1)))
        vp = (hn | ~(d0 >> 1 | hp)) & full
        vn = d0 >> 1 & hp
        if j % 16 == 0:
            done = j >= n
            result[live[done & (score <= edits)]] = True
            go = ~done & (score <= 2 * edits + np.abs(n - m))
            if not go.all():
                live, m, n, vp, vn, score = (y[go] for y in (live, m, n, vp, vn, score))
                p, t = p[:, go], t[:, go]
                if not len(live):
                    return result
    result[live[score <= edits]] = True
    return result


def bins(line: str) -> np.ndarray:
    """Letters counted in a few bins, modulo 256: an edit moves the sum of differences by two at most."""
    return np.bincount(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) % BINS, minlength=BINS).astype(np.uint8)


class Verifier:
    """Gathers candidate pairs of many keys and verifies them side by side. links: a spanning set of the verified pairs;
    counts: the number of verified pairs of each line.

    A pair meets in several keys. It is verified in one of them: the first segment of its shorter line (of equally long ones,
    that of the smaller id) that the other line shares. By the pigeonhole every close pair has such a key.
    """

    def __init__(self, bands: tuple = BANDS):
        self.bands, self.pending, self.links = bands, [], []
        self.counts: Counter[int] = Counter()
        self.parent: dict[int, int] = {}
        self.known: dict[int, tuple[list[int], set[int]]] = {}

    def learn(self, ids: list[int], lines: list[str]) -> None:
        """Keeps the keys of lines: those under which each is indexed, by segment, and all of them."""
        new = {i: x for i, x in zip(ids, lines, strict=True) if i not in self.known}
        if len(self.known) > 20_000:
            self.known.clear()
            new = dict(zip(ids, lines, strict=True))
        names = list(new)
        for i in names:
            self.known[i] = [], set()
        for w, k, own in zip(*(x.tolist() for x in keys_of(list(new.values()), self.bands)), strict=True):
            mine, every = self.known[names[w]]
            every.add(k)
            if own:
                mine.append(k)

    def run(self, ids: np.ndarray, lines: list[str], key: int | None = None, part: np.ndarray | None = None) -> None:
        """Candidates among the distinct lines of a key; without a key, all pairs. part: only pairs of unequal parts."""
        sig = np.stack([bins(x) for x in lines]).astype(np.int16)
        length = np.array([len(x) for x in lines])
        names = ids.tolist()
        for i in range(len(lines) - 1):
            near = self.close(sig[i + 1 :], length[i + 1 :], sig[i], length[i])
            if part is not None:
                near &= part[i + 1 :] != part[i]
            for k in (np.flatnonzero(near) + i + 1).tolist():
                if names[i] != names[k] and (key is None or self.first(key, names[i], lines[i], names[k], lines[k])):
                    self.pending.append((names[i], names[k], lines[i], lines[k]))
            if len(self.pending) >= PAIRS:
                self.flush()

    def first(self, key: int, u: int, a: str, v: int, b: str) -> bool:
        """Whether the pair is verified in this key."""
        if (len(a), u) > (len(b), v):
            u, v = v, u
        others = self.known[v][1]
        return next((k for k in self.known[u][0] if k in others), None) == key

    def close(self, sig: np.ndarray, length: np.ndarray, mine: np.ndarray, n: int) -> np.ndarray:
        d = np.abs(sig - mine)
        edits = edits_of(np.minimum(length, n), self.bands)
        return (np.abs(length - n) <= edits) & (np.minimum(d, 256 - d).sum(axis=1) <= 2 * edits)

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def flush(self) -> None:
        ok = within([(a, b) for _, _, a, b in self.pending], self.bands)
        found = [(u, v) for (u, v, _, _), y in zip(self.pending, ok.tolist(), strict=True) if y]
        self.pending.clear()
        self.counts.update(u for u, _ in found)
        self.counts.update(v for _, v in found)
        if len(self.parent) > 200_000:
            self.parent.clear()
        for u, v in found:
            if (a := self.root(u)) != (b := self.root(v)):
                self.parent[b] = a
                self.links.append((u, v))


def occurrences(docs: DataFrame) -> DataFrame:
    """docs (__doc, doc_id, text) -> __doc, doc_id, place, line: where lines are that aren't blank."""
    schema = T.StructType([T.StructField("__doc", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("place", T.IntegerType()), T.StructField("line", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows, places, lines = [], [], []
            for k, t in enumerate(batch.column("text").to_pylist()):
                for i, x in enumerate((t or "").split("\n")):
                    if x := x.strip(BLANKS):
                        rows.append(k)
                        places.append(i)
                        lines.append(line_id(x))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("__doc").take(at), batch.column("doc_id").take(at), pa.array(places, pa.int32()), pa.array(lines, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def distinct_lines(texts: list[str | None], least: int, seen: set[int]) -> Iterator[tuple[int, str]]:
    """(id, line) of lines of `least` code points or more that aren't among the last half million seen."""
    for t in texts:
        for x in (t or "").split("\n"):
            if len(x := x.strip(BLANKS)) >= least and (h := line_id(x)) not in seen:
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(h)
                yield h, x


def keyed(docs: DataFrame, bands: tuple = BANDS) -> DataFrame:
    """docs (text) -> key, line, indexed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            found = list(distinct_lines(batch.column("text").to_pylist(), bands[0][0], seen))
            who, key, own = keys_of([x for _, x in found], bands)
            ids = np.array([h for h, _ in found], np.int64)
            for i in range(0, len(key), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(ids[who[part]]), pa.array(own[part])], names=["key", "line", "indexed"])

    return docs.select("text").mapInArrow(run, "key long, line long, indexed boolean")


def line_texts(docs: DataFrame, least: int) -> DataFrame:
    """docs (text) -> line, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            found = list(distinct_lines(batch.column("text").to_pylist(), least, seen))
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())], names=["line", "content"])

    return docs.select("text").mapInArrow(run, "line long, content string")


def runs(batches: Iterator[pa.RecordBatch], *columns: str, most: int = 200_000, whole: bool = True) -> Iterator[list]:
    """Batches sorted by their first column, gathered so that its equal values are together: the columns as arrays. Unless
    whole, a value with over `most` rows comes in several parts, so that memory is bounded; then a last item says so."""
    waiting: list[pa.RecordBatch] = []
    torn = None  # the value whose first rows went out before

    def out(table: pa.Table, some: bool) -> list:
        return [table.column(c) for c in columns] + ([] if whole else [some])

    for b in batches:
        if not b.num_rows:
            continue
        waiting.append(b)
        first, last = waiting[0].column(columns[0])[0], b.column(columns[0])[-1]
        rows = sum(x.num_rows for x in waiting)
        if first == last:
            if not whole and rows >= most:
                yield out(pa.Table.from_batches(waiting).combine_chunks(), True)
                waiting, torn = [], last
            continue
        if rows < most and b.nbytes < (8 << 20):
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        at = table.column(columns[0]).to_numpy()
        if torn is not None and at[0] == torn.as_py():
            cut = int(np.searchsorted(at, at[0], "right"))
            yield out(table.slice(0, cut), True)
            table, at = table.slice(cut), at[cut:]
        torn = None
        cut = int(np.searchsorted(at, last.as_py()))
        if cut:
            yield out(table.slice(0, cut), False)
        waiting = table.slice(cut).to_batches()
    if waiting:
        table = pa.Table.from_batches(waiting).combine_chunks()
        at = table.column(columns[0]).to_numpy()
        if torn is not None and at[0] == torn.as_py():
            cut = int(np.searchsorted(at, at[0], "right"))
            yield out(table.slice(0, cut), True)
            table = table.slice(cut)
        if table.num_rows:
            yield out(table, False)


def shared_keys(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """(key, line, indexed) sorted by key -> (key, line, members) of the keys with two lines or more, one of them indexed.
    A key with over `most` rows goes on in parts, with members 0: how many it has is counted later."""
    for key, line, indexed, torn in runs(batches, "key", "line", "indexed", most=most, whole=False):
        k, x, r = key.to_numpy(), line.to_numpy(), indexed.to_numpy()
        if torn:
            x = np.unique(x)
            yield pa.RecordBatch.from_arrays([pa.array(k[: len(x)]), pa.array(x), pa.array(np.zeros(len(x), np.int64))], names=["key", "line", "members"])
            continue
        first = np.concatenate(([True], k[1:] != k[:-1]))
        size = np.diff(np.append(np.flatnonzero(first), len(k)))
        crowd = np.repeat(size > 1, size)
        k, x, r = k[crowd], x[crowd], r[crowd]
        order = np.lexsort((x, k))
        k, x, r = k[order], x[order], r[order]
        fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (x[1:] != x[:-1])))[: len(k)]
        starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))[: len(k)])
        if len(starts):
            members = np.add.reduceat(fresh.astype(np.int64), starts)
            has = np.logical_or.reduceat(r, starts)
            size = np.diff(np.append(starts, len(k)))
            keep = np.repeat((members > 1) & has, size) & fresh
            yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(x[keep]), pa.array(np.repeat(members, size)[keep])], names=["key", "line", "members"])


def verified(docs: DataFrame, bands: tuple = BANDS, cell: int = CELL, most: int = 200_000) -> DataFrame:
    """docs (text) -> u, v, n: links (u, v; n is 0) of line ids that connect exactly the lines connected within their edits,
    and rows with u = v whose n add up to the number of other lines within edits of line u."""
    if any(length <= 3 * edits for length, edits in bands):
        raise ValueError("lines must be longer than three times their edits")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed(docs, bands).repartition(n, "key").sortWithinPartitions("key")
    shared = materialize(dealt.mapInArrow(lambda b: shared_keys(b, most), "key long, line long, members long"), "shared-keys")
    wanted = shared.select("line").distinct()
    texts = line_texts(docs, bands[0][0]).join(wanted, "line", "left_semi").dropDuplicates(["line"])
    # keys that came in parts: their rows are distinct in a part only, so this counts a little too many
    torn = shared.where("members = 0").groupBy(F.col("key").alias("__k")).agg(F.count("*").alias("__n"))
    shared = shared.where("members > 0").union(shared.where("members = 0").join(torn, F.col("key") == F.col("__k")).select("key", "line", "__n"))
    # lines of one part meet in its cell with itself; the cell of two parts is for pairs across them
    parts = F.ceil(F.col("members") / cell).cast("long")
    mine = F.pmod(F.xxhash64("line"), parts)
    split = F.transform(
        F.sequence(F.lit(0).cast("long"), parts - 1),
        lambda j: F.struct(F.xxhash64("key", F.least(mine, j), F.greatest(mine, j)).alias("cell"), mine.alias("part"), (mine != j).alias("across")),
    )
    whole = F.array(F.struct(F.col("key").alias("cell"), F.lit(0).cast("long").alias("part"), F.lit(False).alias("across")))
    cells = shared.select("line", "key", F.explode(F.when(F.col("members") <= cell, whole).otherwise(split)).alias("c")).select("line", "key", "c.*")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Verifier(bands)

        def out(least: int) -> pa.RecordBatch:
            rows = [(a, b, 0) for a, b in v.links]
            v.links.clear()
            if len(v.counts) >= least:
                rows += [(x, x, k) for x, k in v.counts.items()]
                v.counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(3)], names=["u", "v", "n"])

        for cell_, line, content, key, part, across in runs(batches, "cell", "line", "content", "key", "part", "across", most=20_000):
            k, ids, lines, own, at = cell_.to_numpy(), line.to_numpy(), content.to_pylist(), key.to_numpy(), part.to_numpy()
            apart = across.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            v.learn(ids.tolist(), lines)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(k)], strict=True):
                if b - a > 1:
                    once = a + np.unique(ids[a:b], return_index=True)[1]
                    v.run(ids[once], [lines[i] for i in once.tolist()], int(own[a]), at[once] if apart[a:b].any() else None)
            yield out(200_000)
        v.flush()
        yield out(0)

    met = cells.join(texts, "line").repartition(n, "cell").sortWithinPartitions("cell")
    return met.select("cell", "line", "content", "key", "part", "across").mapInArrow(verify, "u long, v long, n long")


def links(docs: DataFrame, bands: tuple = BANDS, cell: int = CELL, most: int = 200_000) -> DataFrame:
    """docs (text) -> links (u, v) of line ids that connect exactly the lines connected within their edits."""
    return verified(docs, bands, cell, most).where("u <> v").select("u", "v").distinct()


def line_classes(docs: DataFrame, bands: tuple = BANDS, cell: int = CELL) -> DataFrame:
    """Lines of classes of several texts: line, class (the smallest line id), links (other lines within edits)."""
    found = materialize(verified(docs, bands, cell), "verified")
    groups = components(found.select("u", "v"), "line-components")
    counts = found.where("u = v").groupBy("u").agg(F.sum("n").alias("links"))
    return groups.join(counts, F.col("node") == F.col("u")).select(F.col("node").alias("line"), F.col("component").alias("class"), "links")


def dedup(docs: DataFrame, bands: tuple = BANDS, cell: int = CELL, share: int = SHARE) -> DataFrame:
    """docs with repeated and near-repeated lines taken out of text, and n_lines (not blank), n_linked (of them, in classes of
    several texts), n_dropped, first_doc_ids (documents that keep the lines dropped here) and line_links: of each line the
    place, class_id (equal for all lines of a class) and n_links (other texts within edits, each counted once)."""
    added = ("n_lines", "n_linked", "n_dropped", "first_doc_ids", "line_links")
    docs = docs.drop(*added).withColumn("__doc", F.xxhash64("doc_id", "text"))
    narrow = docs.select("__doc", "doc_id", "text")
    places = materialize(occurrences(narrow).dropDuplicates(["__doc", "place"]), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__doc", "place")
    lines = places.groupBy("line").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    known = lines.join(line_classes(narrow, bands, cell), "line", "left").where("n > 1 OR class IS NOT NULL")
    known = materialize(known, "known-lines")  # a line met once and without links needs no more
    linked = known.where("class IS NOT NULL")
    classes = materialize(linked.groupBy("class").agg(F.count("*").alias("texts"), F.sum("n").alias("of_class"), F.min("first").alias("class_first")), "line-classes")
    linked = with_common(linked, classes, "class", "texts", linked.count(), share).select("line", "n", "class", "links", "of_class", F.col("class_first").alias("first"))
    alone = known.where("class IS NULL").select("line", "n", "class", "links", F.col("n").alias("of_class"), "first")
    named = materialize(linked.unionByName(alone), "named-lines")
    met = with_common(places, named, "line", "n", places.count(), share)
    gone = F.coalesce(F.col("of_class") > 1, F.lit(False)) & ((F.col("first.__doc") != F.col("__doc")) | (F.col("first.place") != F.col("place")))
    verdict = met.groupBy(F.col("__doc").alias("__key")).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("class").isNotNull()).alias("n_linked"),
        F.count_if(gone).alias("n_dropped"),
        F.collect_list(F.when(gone, F.col("place"))).alias("__gone"),
        F.array_sort(F.collect_set(F.when(gone, F.col("first.doc_id")))).alias("first_doc_ids"),
        F.array_sort(F.collect_list(F.struct("place", F.coalesce("class", "line").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links")))).alias("line_links"),
    )
    both = docs.join(verdict, F.col("__doc") == F.col("__key"), "left")
    rows = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size("__rows") - 1), F.col("__gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("__rows"), i)), "\n")
    both = both.withColumn("__rows", F.when(F.col("n_dropped") > 0, rows)).withColumn("text", F.when(F.col("n_dropped") > 0, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    both = both.withColumns({c: F.coalesce(c, F.lit(0)) for c in added[:3]} | {"first_doc_ids": F.coalesce("first_doc_ids", F.array().cast(T.ArrayType(docs.schema["doc_id"].dataType)))})
    both = both.withColumn("line_links", F.coalesce("line_links", F.array().cast(verdict.schema["line_links"].dataType)))
    return both.drop("__doc", "__key", "__gone", "__rows")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs with the lines that dedup() keeps; same columns."""
    done = dedup(shield(docs, "doc_id", "text"))
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__row").getField("n_chars"))
    return unshield(done, docs, "doc_id", "text", **changed)


def op3_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_linked", "n_dropped", "first_doc_ids", "line_links", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
