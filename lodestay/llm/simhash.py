"""SimHash near-duplicates: pigeonhole blocks, a join on shared blocks, and a Hamming check.

Fingerprints that differ in at most `bits` of 64 bits, cut into `blocks` blocks, agree in at least blocks - bits whole
blocks. Every choice of that many blocks is a key; rows meet on equal keys and are verified. All choices together lose no
pair. Equal fingerprints are collapsed first. Inside a group of equal keys links are found by a search that takes each
fingerprint off the list once it is reached, so a group gives at most one link a member, never all pairs.

Null or wordless text has fingerprint zero and links like any other; repeated rows get the same result each; a null doc_id
is never a component's id, but its row gets one; ties have no part in it; an empty table gives no rows; other columns pass
through. A text is read whole, its shingles held as 8-byte hashes. A fingerprint of a large share of the rows is joined to
its component by broadcast, so its copies stay in the tasks that read them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import as_bytes, components, documents, materialize, shield, slices, unshield, with_common

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BLOCKS = 6
#: A group of equal keys beyond this many fingerprints is dealt over several tasks, pair by pair of its parts.
CELL = 50_000


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each UTF-8 text as uint64."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        ws = text.lower().split()  # bytes: lowers A-Z only, splits at the six blanks only
        if not ws:
            continue
        joined = b" ".join(ws)
        if len(ws) <= shingle:
            hashes = [digest(joined, SEED)]
        else:
            ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(ws) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
        n, ones = len(hashes), np.zeros(64, np.int64)
        h = np.array(hashes, np.uint64)
        for i in range(0, n, 65536):
            part = h[i : i + 65536]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with fp: the fingerprint's 64 bits as a long."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, 4 << 20):
            fp = pa.array(fingerprints_of(as_bytes(b.column(text))).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], fp], names=[*[f.name for f in kept], "fp"])

    return docs.drop("fp").mapInArrow(run, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def block_keys(fp: Column, blocks: int = BLOCKS, bits: int = MAX_BITS) -> Column:
    """An array of one long for each choice of blocks - bits blocks: their bits and the choice's number, hashed together."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), blocks - bits)):
        m = sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen)
        m = m - (1 << 64) if m >= 1 << 63 else m
        keys.append(F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(m).cast("long"))))
    return F.array(*keys)


def _search(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within bits among fps (distinct uint64): at most one less than there are."""
    left = np.ones(len(fps), bool)
    us, vs = [], []
    for start in range(len(fps)):
        if not left[start]:
            continue
        left[start] = False
        rest = np.flatnonzero(left)
        front = [start]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= bits
            if near.any():
                got = rest[near]
                us.append(got)
                vs.append(np.full(len(got), at))
                left[got] = False
                front.extend(got.tolist())
                rest = rest[~near]
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _links_of_runs(key: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """key: sorted; links between fingerprints of equal keys."""
    if len(key) < 2:
        return fps[:0], fps[:0]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    length = np.diff(np.concatenate((first, [len(key)])))
    us, vs = [], []
    for d in range(1, 8):  # runs of 8 at most: all pairs at once
        at = np.repeat(length, length) <= 8
        i = np.flatnonzero(at[:-d] & (key[:-d] == key[d:])) if len(key) > d else np.zeros(0, np.int64)
        near = np.bitwise_count(fps[i] ^ fps[i + d]) <= bits
        us.append(fps[i[near]])
        vs.append(fps[i[near] + d])
    for k in np.flatnonzero(length > 8):
        run = np.unique(fps[first[k] : first[k] + length[k]])
        u, v = _search(run, bits)
        us.append(run[u])
        vs.append(run[v])
    return np.concatenate(us), np.concatenate(vs)


def find_links(batches: Iterator[pa.RecordBatch], bits: int = MAX_BITS) -> Iterator[pa.RecordBatch]:
    """Batches (key, fp) sorted by key -> links (u, v). A run of equal keys is kept together across batches."""
    held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def made(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        u, v = _links_of_runs(k, f, bits)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        k, f = b.column("key").to_numpy(zero_copy_only=False), b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(k):
            continue
        waiting.append((k, f))
        if k[-1] == waiting[0][0][0] or sum(len(x) for x, _ in waiting) < 100_000:
            continue
        held_k, held_f = (np.concatenate(x) for x in zip(*waiting, strict=True))
        cut = int(np.searchsorted(held_k, held_k[-1]))
        waiting = [(held_k[cut:], held_f[cut:])]
        yield made(held_k[:cut], held_f[:cut])
    if waiting:
        yield made(*(np.concatenate(x) for x in zip(*waiting, strict=True)))


def links(fps: DataFrame, bits: int = MAX_BITS, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """fps (fp: distinct longs) -> links (u, v) that connect exactly the pairs connected within bits."""
    keyed = fps.select("fp", F.explode(block_keys(F.col("fp"), blocks, bits)).alias("key"))
    # a key with more members than a cell is split in parts; each pair of parts meets in a key of its own
    big = keyed.groupBy("key").count().where(F.col("count") > cell).select(F.col("key").alias("__k"), F.ceil(F.col("count") / cell).alias("__g"))
    big = materialize(big, "large-keys")
    if big.first() is not None:
        mine = F.pmod(F.xxhash64("fp"), F.col("__g"))
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("__g") - 1), lambda j: F.xxhash64("key", F.least(mine, j), F.greatest(mine, j)))
        joined = keyed.join(big, F.col("key") == F.col("__k"), "left")
        keyed = joined.select("fp", F.explode(F.when(F.col("__g").isNull(), F.array("key")).otherwise(pairs)).alias("key"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartition(n, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(lambda it: find_links(it, bits), "u long, v long").distinct()


def _grouped(docs: DataFrame, bits: int, blocks: int) -> DataFrame:
    """docs without the text, with fp, component_id and __component (the component's smallest fingerprint)."""
    printed = materialize(fingerprints(docs), "fingerprints")
    unique = materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("__n")), "unique-fingerprints")
    groups = components(links(unique.select("fp"), bits, blocks)).withColumnsRenamed({"node": "__node", "component": "__component"})
    mapped = unique.join(groups, F.col("fp") == F.col("__node"), "left").select("fp", "least_id", "__n", F.coalesce("__component", "fp").alias("__component"))
    least = mapped.groupBy("__component").agg(F.min("least_id").alias("component_id"))
    named = materialize(mapped.join(least, "__component").select("fp", "__n", "component_id", "__component"), "named-fingerprints")
    return with_common(printed, named, "fp", "__n", printed.count()).drop("__n")


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """docs without the text, with fp and component_id (the smallest doc_id reachable over links of at most bits bits)."""
    return _grouped(docs, bits, blocks).drop("__component")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """docs with exactly one row of each component: the smallest doc_id, nulls last, then the smallest hash of text and row;
    same columns. Rows are told apart by 128 bits of hash."""
    rows = shield(docs, "doc_id", "text")
    rows = rows.withColumn("__hash", F.concat(*[F.hex(F.xxhash64(F.lit(seed), "doc_id", "text", "__row")) for seed in (0, 1)]))
    found = _grouped(rows.select("doc_id", "text", "__hash"), MAX_BITS, BLOCKS)
    first = found.groupBy("__component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__hash")).alias("first"))
    chosen = first.select(F.col("first.__hash").alias("__chosen"))
    kept = rows.join(chosen, F.col("__hash") == F.col("__chosen"), "left_semi").dropDuplicates(["__hash"])
    return unshield(kept, docs, "doc_id", "text")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
