"""The pipeline, stage by stage, against the brute-force versions of its operators."""

import random
from collections import Counter

import test_native
import test_pairs
from lodestay.llm import mixing, vocab

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, component_id string, size string, __key string"


def corpus():
    rng = random.Random(11)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(12)) for _ in range(400)]
    texts = ["\n".join(rng.sample(lines, 8)) for _ in range(50)]
    texts += [texts[0], texts[1] + "\ntail line that is new to all of them", None, "", "too short", "! ".join(["WORD"] * 80), "# $ " * 60]
    return [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or ""), "a", "b", "c", "d") for i, t in enumerate(texts)]


def test_stages(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    columns, seen = docs.columns, docs
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        seen = spark.createDataFrame(seen.collect(), seen.schema)  # written and read again
        seen = stage(spark, seen, "")
        outs.append(seen)
    assert all(o.columns == columns for o in outs[:-1])
    quality, lines, near, mixed, packed = ([tuple(r) for r in o.collect()] for o in outs)
    ok = lambda t: (lambda m: m[0] >= 1 and 100 * m[4] <= 50 * m[0] and 10 * m[2] <= 3 * m[0] and 10 * sum("A" <= c <= "Z" for c in t) <= 4 * m[1] and 10 * t.count("!") <= 3 * m[0])(test_native.measured(t))
    assert Counter(quality) == Counter(r for r in rows if ok(r[1] or "")) and len(quality) >= 50
    want = dict(test_pairs.line_dedup([(r[0], r[1]) for r in quality]))
    assert {r[0]: r[1] for r in lines} == want and all(r[4] == len(r[1]) for r in lines)
    prints = {r[0]: test_pairs.fingerprint(r[1]) for r in lines}
    root = test_pairs.union(set(prints.values()), [(a, b) for a in set(prints.values()) for b in set(prints.values()) if a < b and (a ^ b).bit_count() <= 4])
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    assert sorted(r[0] for r in near) == sorted(first.values())
    taken = {r.doc_id: r.taken for r in mixing.schedule(spark.createDataFrame(near, SCHEMA)).collect()}
    sent = Counter()
    for r in mixed:
        sent[r[0]] += len((r[1] or "").split())
    assert sent == Counter({i: n for i, n in taken.items() if n})
    ids = vocab.word_ids(vocab.default_path())
    assert sum(r[2] for r in packed) == sum(len(ids.ids((r[1] or "").encode())) // 4 + 1 for r in mixed)
    assert all(r[5] == "a" and r[8] == "d" for r in mixed)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
