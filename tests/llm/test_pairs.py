"""SimHash, line dedup, components and sharding against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lodestay.llm import common, linededup, sharding, simhash

SCHEMA = "doc_id long, text string, fp string, n_chars long"


def fingerprint(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]).encode(), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(items, links):
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeÄ") for _ in range(5)) for _ in range(n))


def test_components_on_chains_stars_and_rings(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)] + [(7, 7)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = union({x for e in links for x in e}, links)
    assert got == {n: c for n, c in want.items() if any(n in e for e in links if e[0] != e[1])}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash_against_all_pairs(spark):
    rng = random.Random(2)
    texts = [None, "", "  \n", "one", "ONE", "a b c", words(rng, 400)]
    base = words(rng, 300).split()
    for k in range(40):  # near copies that drift apart
        base[rng.randrange(300)] = f"w{k}"
        texts.append(" ".join(base))
    texts += [words(rng, rng.randrange(1, 60)) for _ in range(60)] + [texts[10], texts[10].upper(), "y" * 20000, "z " * 5000]
    rows = [(i + 5, t, "x", 0) for i, t in enumerate(texts)] + [(None, texts[10], "x", 0), (5, None, "x", 0)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [fingerprint(t) for _, t, *_ in rows]
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in got) == Counter((r[0], f) for r, f in zip(rows, fps, strict=True))
    root = union(set(fps), [(a, b) for a in set(fps) for b in set(fps) if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for (i, *_), f in zip(rows, fps, strict=True):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert len(set(least)) < len(set(fps))
    assert all(r.component_id == least[root[r.fp % (1 << 64)]] for r in got)
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_one_row_of_each_component_whatever_the_ids(spark):
    rng = random.Random(8)
    a, b, c, d, e = (words(rng, n) for n in (60, 90, 70, 80, 50))
    rows = [(None, a, "x", 0), (None, b, "x", 0), (None, b, "x", 0), (3, c, "x", 0), (3, d, "x", 0), (9, c, "y", 0), (2, d, "y", 0), (None, d, "y", 0), (4, e, "x", 0), (4, e, "x", 0)]
    roots = union({fingerprint(x) for x in (a, b, c, d, e)}, [])
    assert len(roots) == 5 and min((p ^ q).bit_count() for p in roots for q in roots if p != q) > 4
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(None, a), (None, b), (3, c), (2, d), (4, e)], key=str)


def test_large_keys_are_dealt_in_parts(spark):
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([np.int64(1) << rng.integers(0, 62, 200) | np.int64(1) << rng.integers(0, 62, 200), rng.integers(0, 1 << 62, 100)])).tolist()
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = union(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    for cell in (10, 100000):
        links = [tuple(r) for r in simhash.links(df, cell=cell).collect()]
        assert union(fps, links) == want


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, s, n):
    s = list(s)
    for _ in range(n):
        i, kind = rng.randrange(len(s)), rng.randrange(3)
        if kind == 0:
            s.insert(i, rng.choice("xyz😀"))
        elif kind == 1:
            s[i] = rng.choice("xyz😀")
        else:
            del s[i]
    return "".join(s)


def allowed(a, b):
    n = min(len(a), len(b))
    return 0 if n < 20 else 2 if n < 300 else 3


def near(a, b):
    return abs(len(a) - len(b)) <= allowed(a, b) and distance(a, b) <= allowed(a, b)


def test_distance_and_keys():
    rng = random.Random(4)
    for edits in (1, 2, 3):
        bands = ((8, edits), (60, edits + 1))
        lines = [words(rng, rng.randrange(2, 18)) for _ in range(120)]
        pairs = [(a, changed(rng, a, rng.randrange(6))) for a in lines]
        bound = [edits + (min(len(a), len(b)) >= 60) for a, b in pairs]
        close = [distance(a, b) <= e for (a, b), e in zip(pairs, bound, strict=True)]
        assert linededup.within(pairs, bands).tolist() == close and any(close) and not all(close)
        who, keys, own = linededup.keys_of([x for p in pairs for x in p], bands)
        held = [(set(), set()) for _ in range(2 * len(pairs))]
        for w, k, o in zip(who.tolist(), keys.tolist(), own.tolist(), strict=True):
            held[w][1].add(k)
            if o:
                held[w][0].add(k)
        for i, y in enumerate(close):
            if y:
                short, long = sorted((2 * i, 2 * i + 1), key=lambda k: len(pairs[i][k - 2 * i]))
                assert held[short][0] & held[long][1]
    alone = linededup.keys_of([lines[5]], bands)[1].tolist()
    assert alone == [k for w, k in zip(*(x.tolist() for x in linededup.keys_of(lines, bands)[:2]), strict=True) if w == 5]
    long = "ab" * 60_000
    assert linededup.within([(long, "x" + long[1:-2] + "yz"), (long, long[:500] + "1234" + long[500:])]).tolist() == [True, False]


def line_dedup(rows):
    """Rows of (doc_id, text) -> texts that stay."""
    strip = lambda x: x.strip(common.BLANKS)
    at = sorted({(i is None, i or 0, k, strip(x)) for i, t in rows if t for k, x in enumerate(t.split("\n")) if strip(x)})
    lines = sorted({x for *_, x in at})
    root = union(lines, [(a, b) for n, a in enumerate(lines) for b in lines[n + 1 :] if near(a, b)])
    first = {}
    for none, i, k, x in at:
        first.setdefault(root[x], (none, i, k))
    out = []
    for i, t in rows:
        keep = lambda k, x: not strip(x) or first[root[strip(x)]] == (i is None, i or 0, k)  # noqa: B023, E731
        out.append((i, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if keep(k, x))))
    return out


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(5)
    pool = [words(rng, rng.randrange(3, 9)) for _ in range(25)] + [words(rng, 52)[: 296 + k] for k in range(6)]
    rows = [(1, None), (2, ""), (3, "short\nshort\n\nshort"), (4, "x" * 3000 + "\n" + "x" * 3001), (None, pool[0] + "\nlast")]
    rows += [(i, "\n".join(words(rng, 4)[: 1 + (i + j) % 21] for j in range(4)) + "\n}\n \n}") for i in range(5, 10)]
    for i in range(10, 60):
        rows.append((i, "\n".join(rng.choice(["  ", ""]) + changed(rng, rng.choice(pool), rng.randrange(5)) for _ in range(rng.randrange(1, 6)))))
    for k in range(1, 24):  # equal lines of every short length, and lines one letter apart
        rows.append((100 + k, "\n".join(["s" * k, "s" * k, "s" * (k - 1) + "t", words(rng, 5)[:k]])))
    rows.append(rows[-1])
    df = spark.createDataFrame([(i, t, "mine", len(t or "")) for i, t in rows], SCHEMA)
    got = linededup.dedup(df)
    want = line_dedup(rows)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert sum(r.n_dropped for r in got.collect()) > 20 and all(r.n_chars == len(r.text or "") for r in got.collect())
    split = [tuple(r) for r in linededup.links(df.withColumn("x", df.fp), cell=3, most=4).collect()]
    whole = [tuple(r) for r in linededup.links(df, cell=4000).collect()]
    ids = {x for e in split + whole for x in e}
    assert union(ids, split) == union(ids, whole)
    common_lines = linededup.dedup(df, share=10**6)  # every class and line that occurs is joined by broadcast
    assert sorted(((r.doc_id, r.text) for r in common_lines.collect()), key=str) == sorted(want, key=str)
    assert linededup.dedup(df.limit(0)).count() == 0


def test_runs_hand_on_a_large_key_in_parts():
    rng = np.random.default_rng(1)
    keys = np.sort(np.concatenate([rng.integers(0, 40, 300), np.full(500, 17)]))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 37]), pa.array(np.arange(len(keys))[i : i + 37])], names=["key", "line"]) for i in range(0, len(keys), 37)]
    parts = list(linededup.runs(iter(batches), "key", "line", most=60, whole=False))
    assert np.concatenate([x[1].to_numpy() for x in parts]).tolist() == list(range(len(keys)))
    assert max(len(x[0]) for x in parts) < 150 and any(x[2] for x in parts)
    assert all(set(x[0].to_pylist()) == {17} for x in parts if x[2]) and not any(17 in x[0].to_pylist() for x in parts if not x[2])
    for whole in linededup.runs(iter(batches), "key", "line", most=60):
        held = set(whole[0].to_pylist())
        assert all((keys == k).sum() == whole[0].to_pylist().count(k) for k in held)


def test_crowded_key_connects_the_same_lines():
    rng = random.Random(6)
    base = words(rng, 8)
    lines = sorted({changed(rng, base, rng.randrange(5)) for _ in range(150)})
    v = linededup.Verifier()
    v.run(np.arange(len(lines)), lines)
    v.flush()
    n = range(len(lines))
    want = union(n, [(a, b) for a in n for b in n if a < b and distance(lines[a], lines[b]) <= 2])
    assert union(n, v.links) == want


def test_every_link_is_counted_once(spark):
    rng = random.Random(7)
    base = [words(rng, 8), words(rng, 9)]
    lines = sorted({b[:30] + changed(rng, b[30:], rng.randrange(4)) for b in base for _ in range(110)} | {words(rng, 6) for _ in range(10)})
    close = [(a, b) for n, a in enumerate(lines) for b in lines[n + 1 :] if near(a, b)]
    root, held = union(lines, close), Counter(x for e in close for x in e)
    who, keys, _ = linededup.keys_of(lines)
    assert max(Counter(k for _, k in set(zip(who.tolist(), keys.tolist(), strict=True))).values()) > 64
    rows = [(i, "\n".join([*lines[i::40], "short", lines[i % 7]]), "x", 0) for i in range(40)] + [(50, None, "x", 0), (51, "short", "x", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    root["short"] = "short"
    for cell in (30, 4000):
        names = {}
        for r in linededup.dedup(df, cell=cell).collect():
            text = (rows[r.doc_id][1] if r.doc_id < 40 else "short" if r.doc_id == 51 else "").split("\n")
            assert [x.place for x in r.line_links] == [k for k, x in enumerate(text) if x]
            for x in r.line_links:
                assert x.n_links == held[text[x.place]]
                assert names.setdefault(root[text[x.place]], x.class_id) == x.class_id
        assert len(set(names.values())) == len(names) == len(set(root.values()))


def test_shards(spark):
    rows = [(i if i % 7 else None, "t" * (i % 50), "x", 0) for i in range(500)] + [(3, None, "x", 0)] * 20
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "fp", "crc32(coalesce(text, '')) AS crc", "length(coalesce(text, '')) + 8L AS size")
    one = [sharding.shard(df, ["doc_id", "crc", "size"], "size", bucket_bytes=b).collect() for b in (1000, 1000, 1 << 20)]
    for got in one:
        held = Counter(r.shard for r in got)
        assert len(got) == len(rows) and max(held.values()) - min(held.values()) <= 1 and set(held) == set(range(24))
        assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in held.items())
    key = lambda r: (str(r.doc_id), r.crc, r.size, r.shard, r.slot)
    assert sorted(map(key, one[0])) == sorted(map(key, one[1]))
    assert len({r.bucket for r in one[0]}) > 5
    assert sharding.shard(df.limit(0), ["doc_id", "crc", "size"], "size").count() == 0
    assert sorted(sharding.fisher_yates(100, 1, 2).tolist()) == list(range(100))


def test_whole_records_are_shuffled_and_written(spark, tmp_path, monkeypatch):
    rows = [(i, f"{i} " + "tä" * (i % 50), "x", 0) for i in range(300)] + [(300, None, "x", 0), (301, "z" * 100_000, "x", 0), (None, "n", "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    moved = []
    whole = sharding.external_shuffle
    monkeypatch.setattr(sharding, "external_shuffle", lambda d, *a, **b: moved.append(d.columns) or whole(d, *a, **b))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op4_external_shuffle(spark, str(tmp_path)).collect()
    assert "text" in moved[0] and not {"size", "text_crc32"} & set(moved[0])
    data = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(data(t)) + 8, zlib.crc32(data(t))) for i, t, *_ in rows)
    one = whole(docs.select("doc_id", "text"), ["doc_id", "text"], sharding.record_bytes(), bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in one) == Counter((i, t) for i, t, *_ in rows) and len({r.bucket for r in one}) > 5
    sharding.write_shards(docs, ["doc_id", "text"], sharding.record_bytes(), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t) for i, t, *_ in rows) and len({r.shard for r in back}) == 24


def test_many_equal_rows_are_dealt_over_buckets(spark):
    rows = [(7, "e" * 2000, "x", 0)] * 3000 + [(i, f"{i} " * 20, "x", 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select("doc_id", "text")
    got = sharding.external_shuffle(df, ["doc_id", "text"], sharding.record_bytes(), bucket_bytes=1 << 18).groupBy("bucket").agg({"text": "count"}).collect()
    held = [r[1] for r in got]
    assert sum(held) == len(rows) and max(held) < 5 * (1 << 18) / 2008 and len(held) > 12


def test_shards_are_written(spark, tmp_path):
    rows = [(i if i % 7 else None, "tä" * (i % 50), "x", 0) for i in range(400)] + [(3, None, "x", 0)] * 20
    df = spark.createDataFrame(rows, SCHEMA).withColumn("slot", F.lit("mine"))
    sharding.write_shards(df, ["doc_id", "text"], sharding.record_bytes(), f"{tmp_path}/out", bucket_bytes=4000)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, *_ in rows)
    held = Counter(r.shard for r in got)
    assert set(held) == set(range(24)) and max(held.values()) - min(held.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in held.items())
