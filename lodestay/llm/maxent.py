"""Hashed maximum-entropy language model with a class-factored softmax.

The most frequent words get ids of their own; all others share tail ids by a hash of their last two bytes, inside which they
follow their smoothed counts. Ids are ranked by count and cut into classes of classes of WIDTH ids. A token's probability is
that of its class given the context, times that of its inner class given the class and the context, times that of its place
in it; each is a softmax over log counts plus a row of weights for each active feature (class: the words one, two and three
back and the pair before; inside: the path so far with the word one and with two back), rows being found by hash. The
distribution sums to one over all known words and one unknown word.

Training: token counts come from all training documents. Then each round deals a share of them over tasks; a task makes
gradient steps (each weight's by the size of its gradients so far) from the shared weights and sends the changes in blocks
of rows, with how often each row was used. Spark averages them by use, in a tree, so that no task takes more than FAN of
them at once. Every training document is used in one round. Weights have a fixed size, and so has the table of frequent
words that is sent to tasks; counts of all other words stay in Spark and are joined to the documents' words.

Held out: crc32(doc_id as text) mod 5 = 1; a null doc_id counts as the empty text, so it is trained on. Null text is empty:
one end token. Repeated rows count each; words of equal count are ranked by their bytes. Texts are read whole, a task holding
about a hundred bytes a token of its longest text. Empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import documents, materialize, slices

WIDTH, LEVELS = 16, 3
START = WIDTH**LEVELS  # also the id of what is before a text
TAILS = 256
WORDS = START - TAILS  # with ids of their own, the end token (id 0) among them
HEAD = 1 << 17  # words whose counts every task has
ROWS = 1 << 15  # of each level's weights
BLOCK = 256  # rows sent together
FAN = 64  # tasks averaged at once
ROUNDS = 2
STEP, STEPS = 32768, 200  # most tokens of a gradient step; least steps of a task
RATE = 0.3
TASK_TOKENS = 4_000_000
LIMIT = 20.0  # of a weight
#: Multipliers of the hashes, fixed: odd numbers.
MIX = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393, 3182667139], np.uint32)


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(5)) == 1


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after another, and where each text's begin, with the end."""
    whole = pa.concat_arrays([texts.cast(pa.large_string()), pa.array([], pa.large_string())])  # Arrow lower-cases slices wrongly
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(whole, "")))
    flat, offsets = lists.values, lists.offsets.to_numpy().astype(np.int64)
    full = pc.binary_length(flat).to_numpy() > 0
    if not full.all():
        flat = flat.filter(pa.array(full))
        offsets = np.concatenate(([0], np.cumsum(full)))[offsets]
    return flat, offsets


def tails_of(words: pa.Array) -> np.ndarray:
    """The tail id of each word: a hash of its last two bytes."""
    if not len(words):
        return np.zeros(0, np.int64)
    words = pa.concat_arrays([words.cast(pa.large_string()).cast(pa.large_binary())])
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    last = data[ends[1:] - 1].astype(np.uint32)
    before = np.where(np.diff(ends) > 1, data[np.maximum(ends[1:] - 2, 0)], 0).astype(np.uint32)
    return ((before * np.uint32(256) + last + np.uint32(1)) * MIX[0] >> np.uint32(16)).astype(np.int64) % TAILS


def token_counts(docs: DataFrame) -> DataFrame:
    """token, n over docs (text): summed in each task first, so a frequent word is a few rows in the shuffle."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in slices(batches, "text", 4 << 20):
            counted = words_of(batch.column("text"))[0].value_counts()
            parts.append(pa.table({"token": counted.field("values").cast(pa.string()), "n": counted.field("counts")}))
            if sum(p.num_rows for p in parts) > 1_000_000:
                parts = [summed(parts)]
                if parts[0].num_rows > 500_000:
                    yield from parts.pop().to_batches()
        if parts:
            yield from summed(parts).to_batches()

    return docs.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Vocabulary:
    """What every task knows: the head words (by falling count), their ids and log probabilities."""

    def __init__(self, head: list[tuple[str, int]], tokens: int, distinct: int, docs: int, tails: dict[int, tuple[int, int]]):
        self.head = pa.array([w for w, _ in head], pa.large_string())
        self.size = tokens + 0.5 * (distinct + 1)
        n = np.array([c for _, c in head] + [docs], np.float64)  # the end token is last
        self.end, own = len(head), min(len(head), WORDS - 1)
        self.id = np.concatenate((np.arange(1, own + 1), WORDS + tails_of(self.head[own:]), [0]))
        inside = np.array([tails.get(k, (0, 0)) for k in range(TAILS)], np.float64)  # tokens, distinct
        self.tail_size = inside[:, 0] + 0.5 * (inside[:, 1] + 1)
        shared = self.id >= WORDS
        # a last place, which -1 finds, for words that are not in the head
        self.base = np.append(np.log10((n + 0.5) / self.size), 0.0)
        self.inner = np.append(np.where(shared, np.log10((n + 0.5) / self.tail_size[np.where(shared, self.id - WORDS, 0)]), 0.0), 0.0)
        self.known = np.append(n > 0, False)
        mass = np.zeros(START)
        mass[self.id[~shared]] = n[~shared]
        mass[WORDS:] = inside[:, 0]
        mass += 0.5
        self.bias = []  # by level: log shares of a class's parts
        for level in range(LEVELS):
            part = mass.reshape(WIDTH ** (level + 1), -1).sum(axis=1).reshape(-1, WIDTH)
            self.bias.append(np.log(part / part.sum(axis=1, keepdims=True)).astype(np.float32))

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Head places (-1: not a head word) of the texts' tokens with their ends, their ids, where texts start, and the other words."""
        flat, offsets = words_of(texts)
        where = pc.fill_null(pc.index_in(flat, value_set=self.head), -1).to_numpy().astype(np.int64)
        rest = flat.filter(pa.array(where < 0))
        got = self.id[where]
        got[where < 0] = WORDS + tails_of(rest)
        ends = offsets[1:] + np.arange(len(texts))
        word = np.ones(len(flat) + len(texts), bool)
        word[ends] = False
        at, ids = np.full(len(word), self.end), np.zeros(len(word), np.int64)
        at[word], ids[word] = where, got
        return at, ids, offsets[:-1] + np.arange(len(texts)), rest


def contexts(ids: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words one, two and three back, and of the pair before; START before a text's beginning."""
    since = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    back = []
    for k in (1, 2, 3):
        x = np.full(len(ids), START, np.uint32)
        x[k:] = ids[:-k]
        x[since < k] = START
        back.append((x + np.uint32(1)) * MIX[k - 1])
    return [*back, (back[0] ^ back[1] >> np.uint32(13)) * MIX[3]]


def features(ctx: list[np.ndarray], part: slice, path: np.ndarray, level: int) -> list[np.ndarray]:
    """Rows of a level's weights for each token: found by all contexts at the top, by the path and two of them below."""
    mixed = (path.astype(np.uint32) + np.uint32(level)) * MIX[4]
    return [((c[part] ^ mixed) * MIX[5] >> np.uint32(17)).astype(np.intp) for c in (ctx if level == 0 else ctx[:2])]


class Model:
    """Weights and, for training, the sums of their squared gradients."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray | None = None):
        self.v = vocabulary
        self.w = np.zeros((LEVELS, ROWS, WIDTH), np.float32) if weights is None else weights

    def exponents(self, ids: np.ndarray, ctx: list[np.ndarray], part: slice, level: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        path = ids >> 4 * (LEVELS - level)
        rows = features(ctx, part, path, level)
        z = self.v.bias[level].take(path, axis=0)
        for r in rows:
            z += self.w[level].take(r, axis=0)
        return z, ids >> 4 * (LEVELS - 1 - level) & 15, rows

    def log10(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log10 probability of each id in texts that begin at starts."""
        ctx, out, ones = contexts(ids, starts), np.zeros(len(ids)), np.ones(WIDTH, np.float32)
        for i in range(0, len(ids), STEP):
            part = slice(i, i + STEP)
            y = ids[part]
            n = np.arange(len(y))
            for level in range(LEVELS):
                z, want, _ = self.exponents(y, ctx, part, level)
                mine = z[n, want]
                np.exp(z, out=z)
                out[part] += mine - np.log(z @ ones)
        return out / np.log(10)

    def learn(self, ids: np.ndarray, starts: np.ndarray, squares: np.ndarray, used: np.ndarray, step: int) -> None:
        """Gradient steps over texts. squares: sums of squared gradients; used: how often each row was active."""
        ctx, ones = contexts(ids, starts), np.ones(WIDTH, np.float32)
        for i in range(0, len(ids), step):
            part = slice(i, i + step)
            y = ids[part]
            for level in range(LEVELS):
                z, want, rows = self.exponents(y, ctx, part, level)
                np.exp(z, out=z)
                z /= (z @ ones)[:, None]
                z[np.arange(len(y)), want] -= 1.0
                all_rows, by_place = np.concatenate(rows), z.T.astype(np.float64)
                total = np.empty((ROWS, WIDTH), np.float32)
                for k in range(WIDTH):
                    total[:, k] = np.bincount(all_rows, weights=np.tile(by_place[k], len(rows)), minlength=ROWS)
                used[level] += np.bincount(all_rows, minlength=ROWS)
                held = squares[level]
                held += total * total
                total /= np.sqrt(held)
                total *= np.float32(RATE)
                self.w[level] -= total
        np.clip(self.w, -LIMIT, LIMIT, out=self.w)


def one_round(docs: DataFrame, vocabulary, weights: np.ndarray, squares: np.ndarray, tasks: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and sums of squared gradients after the tasks' gradient steps over docs, averaged by use."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((weights, squares))
    pieces = (-1, BLOCK, WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, before = shared.value
        model, held, used = Model(vocabulary.value, old.copy()), before.copy(), np.zeros((LEVELS, ROWS))
        for batch in slices(batches, "text", 4 << 20):
            _, ids, starts, _ = model.v.places(batch.column("text"))
            model.learn(ids, starts, held, used, step)
        often = used.astype(np.float32).reshape(-1, BLOCK, 1)
        both = [((x - y).reshape(pieces) * often) for x, y in ((model.w, old), (held, before))]
        touched = np.flatnonzero(often.any(axis=1))
        task = np.full(len(touched), TaskContext.get().partitionId())
        arrays = [pa.array(task, pa.int64()), pa.array(touched, pa.int64()), *(pa.array([x[i].tobytes() for i in touched], pa.binary()) for x in (often, *both))]
        yield pa.RecordBatch.from_arrays(arrays, names=["task", "block", "used", "change", "square"])

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")  # so that a repeated task adds in the same order
        sums = [sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column(c)) for c in ("used", "change", "square")]
        return pa.table({"task": table.column("task").slice(0, 1), "block": table.column("block").slice(0, 1), **{c: pa.array([x.astype(np.float32).tobytes()], pa.binary()) for c, x in zip(("used", "change", "square"), sums, strict=True)}})

    schema = "task long, block long, used binary, change binary, square binary"
    sums, parts = docs.select("text").mapInArrow(run, schema), tasks
    while parts > FAN:
        parts = -(-parts // FAN)
        sums = sums.groupBy("block", F.pmod("task", F.lit(parts)).alias("part")).applyInArrow(added, schema)
        sums = sums.withColumn("task", F.pmod("task", F.lit(parts)))
    sums = sums.groupBy("block").applyInArrow(added, schema)
    out, kept = weights.copy(), squares.copy()
    for row in sums.toLocalIterator():  # a fixed number of blocks, 13 MB in all
        n = np.maximum(np.frombuffer(row["used"], np.float32), 1e-9)[:, None]
        for to, c in ((out, "change"), (kept, "square")):
            to.reshape(pieces)[row["block"]] += np.frombuffer(row[c], np.float32).reshape(BLOCK, WIDTH) / n
    shared.destroy()
    return out, kept


def fit(training: DataFrame, head: int = HEAD) -> tuple[DataFrame, Vocabulary, np.ndarray, dict]:
    """Counts (token, n) of the training documents, what tasks share of them, the weights, and totals.

    head: the most words whose counts every task gets; all words of a count are in it, or none."""
    spark = training.sparkSession
    counts = materialize(token_counts(training), "token-counts")
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    docs = training.count()
    # head words: those above the lowest count that `head` words at most reach; the counts of counts are few
    spread = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count("*").alias("words")).toLocalIterator()), reverse=True)
    least, held = float("inf"), 0
    for n, w in spread:
        if held + w > head:
            break
        least, held = n, held + w
    top = sorted(((r["token"], r["n"]) for r in counts.where(F.col("n") >= least).collect()), key=lambda r: (-r[1], r[0].encode()))
    own = pa.array([w for w, _ in top[: WORDS - 1]], pa.large_string())

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, d = np.zeros(TAILS), np.zeros(TAILS)
        for b in batches:
            token = b.column("token").cast(pa.large_string())
            k = tails_of(token)
            other = pc.is_null(pc.index_in(token, value_set=own)).to_numpy(zero_copy_only=False)
            n += np.bincount(k, weights=np.where(other, b.column("n").to_numpy(), 0), minlength=TAILS)
            d += np.bincount(k, weights=other, minlength=TAILS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAILS)), pa.array(n.astype(np.int64)), pa.array(d.astype(np.int64))], names=["k", "n", "d"])

    inside = counts.mapInArrow(tails, "k long, n long, d long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).collect()
    tokens, kinds = words + docs, distinct + (docs > 0)
    vocabulary = Vocabulary(top, tokens, kinds, docs, {r["k"]: (r["n"], r["d"]) for r in inside})
    shared = spark.sparkContext.broadcast(vocabulary)
    tasks = max(2, -(-tokens // (TASK_TOKENS * ROUNDS)))
    step = min(STEP, max(256, tokens // (tasks * ROUNDS * STEPS)))
    weights, squares = np.zeros((LEVELS, ROWS, WIDTH), np.float32), np.ones((LEVELS, ROWS, WIDTH), np.float32)
    for k in range(ROUNDS):
        mine = training.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == k)
        weights, squares = one_round(mine.coalesce(tasks), shared, weights, squares, tasks, step)
    return counts, vocabulary, weights, {"tokens": tokens, "distinct": kinds, "docs": docs}


def score(docs: DataFrame, fitted: tuple) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    counts, vocabulary, weights, totals = fitted
    context = docs.sparkSession.sparkContext
    shared, parameters = context.broadcast(vocabulary), context.broadcast(weights)
    id_type = docs.schema["doc_id"].dataType
    tail_type = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("k", T.IntegerType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("model", T.DoubleType()), T.StructField("tail", tail_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value, parameters.value)
        v = model.v
        for batch in slices(batches, "text", 4 << 20):
            at, ids, starts, rest = v.places(batch.column("text"))
            base = np.add.reduceat(v.base[at], starts)
            total = np.add.reduceat(model.log10(ids, starts) + v.inner[at], starts)
            known = np.add.reduceat(v.known[at].astype(np.int64), starts)
            # the other words of each text, each once with its count
            coded = rest.dictionary_encode()
            kinds = max(1, len(coded.dictionary))
            doc = np.searchsorted(starts, np.flatnonzero(at < 0), "right") - 1
            pair, n = np.unique(doc * kinds + coded.indices.to_numpy(), return_counts=True)
            tokens = coded.dictionary.take(pa.array(pair % kinds))
            structs = pa.StructArray.from_arrays([tokens.cast(pa.string()), pa.array(tails_of(tokens), pa.int32()), pa.array(n, pa.int64())], names=["token", "k", "n"])
            ends = np.searchsorted(pair, np.arange(len(starts) + 1) * kinds)
            arrays = [batch.column("doc_id"), pa.array(np.diff(np.append(starts, len(at))), pa.int64()), pa.array(known), pa.array(base), pa.array(total), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    scored = docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = materialize(scored, "scored")  # row numbers are settled by writing them
    rare = scored.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.k", "t.n")
    sizes = F.array(*[F.lit(float(x)) for x in vocabulary.tail_size])
    c = F.coalesce("c", F.lit(0)) + 0.5
    met = rare.join(counts.select("token", F.col("n").alias("c")), "token", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_rare"),
        F.sum(F.col("n") * F.log10(c / F.lit(vocabulary.size))).alias("base_rare"),
        F.sum(F.col("n") * F.log10(c / F.element_at(sizes, F.col("k") + 1))).alias("model_rare"),
    )
    both = scored.drop("tail").join(sums, "row", "left")
    zero = lambda x: F.coalesce(x, F.lit(0))
    return both.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("known") + zero("known_rare")).cast("long").alias("n_known"),
        F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_rare")).alias("base_score"),
        (F.col("model") + zero("model_rare")).alias("score"),
    )


def op6_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return score(docs, fit(docs.where(~held_out())))
