"""Packing by Karmarkar-Karp multiway differencing: near-equal windows of at most `capacity` tokens.

A document is its tokenizer's ids and one end id. Whole windows of a long document stand alone; what remains is cut into
pieces of at most `piece` tokens. Pieces are gathered in groups of about `windows` windows; in a group, the two partial
partitions with the largest differences are merged, largest sums of the one on smallest of the other, until one is left.
Should its largest sum exceed the capacity, the group is packed again into one window more.

Groups are made within a task, in the order of its rows. What a task has left at its end, less than a group, is gathered
with the leftovers of the tasks beside it in groups of one to two times that size, through one exchange of those pieces alone. So how
full the sequences are doesn't depend on how the rows are split: each group loses less than a window to rounding. The same
files split alike give the same sequences; another split gives other ones, as full. A task holds one group at a time. Pieces
of equal size are taken in the order of the rows. A long text's ids are held whole, four bytes a token.
Null text counts as empty: one end id. Repeated rows are packed each. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import documents, materialize, slices
from lodestay.llm.vocab import default_path, word_ids

CAPACITY, PIECE, WINDOWS, END_ID = 2048, 512, 256, 1
#: Tokens left free in each window of a group on average, so that differencing need not be perfect.
SLACK = 6


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Places of sizes dealt over windows by differencing; sums are near equal."""
    # a partial partition: its non-empty windows as (sum, members), by falling sum; members is a nested pair
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    by_sum = lambda w: -w[0]
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heapq.heappop(heap)[2]
        if len(a) + len(b) <= windows:
            merged = a + b
        else:
            alone_a, alone_b = windows - len(b), windows - len(a)
            merged = a[:alone_a] + b[:alone_b]
            merged += [(x + y, (m, n)) for (x, m), (y, n) in zip(a[alone_a:], reversed(b[alone_b:]), strict=True)]
        merged.sort(key=by_sum)
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    out = []
    for _, members in heap[0][2] if heap else []:
        found, todo = [], [members]
        while todo:
            m = todo.pop()
            todo.extend(m) if isinstance(m, tuple) else found.append(m)
        out.append(found)
    return out


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Places of sizes (each at most capacity) in windows of at most capacity; the fewest windows that differencing fills."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        packed = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in packed):
            return packed
        k += 1


def placed(sizes: list[int], capacity: int) -> Iterator[tuple[list[int], list[int]]]:
    """pack_group(), with the offset of each piece in its window."""
    for members in pack_group(sizes, capacity):
        yield members, [0, *accumulate(sizes[i] for i in members[:-1])]


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, piece: int = PIECE, windows: int = WINDOWS, with_ids: bool = True) -> DataFrame:
    """docs (doc_id, text) -> pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    ids: little-endian unsigned 32-bit. sequence_id is unique, offset the piece's place in its sequence.
    """
    path = path or default_path()
    id_type = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", id_type), *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)
    first = T.StructType([*fields, T.StructField("__task", T.LongType()), T.StructField("__nth", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = word_ids(path)
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        sequence = number << 36
        done: list[tuple] = []
        group: list[tuple] = []
        held = 0
        types = [None, *[pa.int64()] * 6, *[pa.binary()] * with_ids, pa.int64(), pa.int64()]

        def put(p: tuple, sequence: int | None, offset: int | None, nth: int) -> None:
            done.append((*p[:5], sequence, offset, *p[5:], number, nth))

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], names=first.names)
            done.clear()
            return made

        for batch in slices(batches, "text", 4 << 20):
            types[0] = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                ids = vocabulary.ids(text or b"") + END_ID.to_bytes(4, "little")
                n = len(ids) // 4
                start = 0
                while start < n:
                    size = capacity if n - start >= capacity else min(piece, n - start)
                    part = ids[4 * start : 4 * (start + size)]
                    made = (doc_id, start, size, zlib.crc32(part), n, *[part] * with_ids)
                    if size == capacity:
                        put(made, sequence, 0, 0)
                        sequence += 1
                    else:
                        group.append(made)
                        held += size
                        if held > windows * (capacity - SLACK) - piece:
                            for members, offsets in placed([p[2] for p in group], capacity):
                                for i, offset in zip(members, offsets, strict=True):
                                    put(group[i], sequence, offset, 0)
                                sequence += 1
                            group.clear()
                            held = 0
                    start += size
            if len(done) > 4096:
                yield out()
        for nth, p in enumerate(group):
            put(p, None, None, nth)
        if done:
            yield out()

    def finish(table: pa.Table) -> pa.Table:
        table = table.sort_by([("__task", "ascending"), ("__nth", "ascending")])
        sequence = (1 << 62) + (table.column("__group")[0].as_py() << 32)
        order, sequences, offsets = [], [], []
        for members, at in placed(table.column("length").to_pylist(), capacity):
            order += members
            sequences += [sequence] * len(members)
            offsets += at
            sequence += 1
        taken = table.take(order)
        given = {"sequence_id": pa.array(sequences, pa.int64()), "offset": pa.array(offsets, pa.int64())}
        return pa.table({n: given.get(n, taken.column(n)) for n in schema.names})

    made = materialize(docs.select("doc_id", "text").mapInArrow(run, first), "pieces")
    left = made.where("sequence_id IS NULL")
    whole = windows * (capacity - SLACK)
    by_task = left.groupBy("__task").agg(F.sum("length").alias("__held"))  # a row a task
    groups = by_task.select("__task", F.floor(F.sum("__held").over(Window.orderBy("__task")) / whole).alias("__group"))
    rest = left.join(groups, "__task").groupBy("__group").applyInArrow(finish, schema)
    return made.where("sequence_id IS NOT NULL").select(*schema.names).unionByName(rest)


def op10_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), with_ids=False)
