"""Quality rules and source mixing against brute force."""

import hashlib
import math
import re
from collections import Counter

import pytest

from lodestay.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, failures string"
TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "x " * 60, "same line\nsame line\nother\n\nsame line", "# $ % & | < > *", "Zoë ünïcode 😀 " * 40, "UPPER CASE!! " * 30, "\n".join(f"w{i} v{i} u{i}" for i in range(40)) + "\nw1 v1 u1\nw1 v1 u1", "p q r s " * 3 + " ".join(f"t{i}" for i in range(100)), "x" * 5000, " ".join(f"k{i % 50}" for i in range(5000))]


def docs(spark, texts=TEXTS):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or ""), "mine") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id", "en", "s1", 5, None)] if texts else []
    return spark.createDataFrame(rows, SCHEMA)


def measured(text):
    t = text or ""
    ws = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if tri[tuple(ws[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_measurements_and_verdicts(spark):
    got = quality.judge(quality.ledger(docs(spark))).collect()
    assert len(got) == len(TEXTS) + 3
    for r in got:
        n, chars, symbols, dup, repeat = measured(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert r.kept == (r.failures & quality.mask("v1") == 0) and not (r.kept and r.base_failed)


def test_filter_keeps_columns_and_drops_rejected(spark):
    d = docs(spark)
    kept = quality.quality_filter(d)
    assert kept.columns == d.columns
    want = [r.doc_id for r in quality.judge(quality.ledger(d), "v2").collect() if r.kept]
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in kept.collect()) and 0 not in want and 3 in want
    for policy in quality.POLICIES:  # blank texts fail every policy
        assert not any(r.kept for r in quality.judge(quality.ledger(d), policy).collect() if not (r.text or "").strip())


def test_ablations(spark):
    stored = quality.ledger(docs(spark))
    bits = [r.failures & quality.mask("v1") for r in stored.collect()]
    got = {r["rule"]: r for r in quality.ablations(stored).collect()}
    for i, (name, _) in enumerate(quality.RULES):
        if quality.mask("v1") >> i & 1:
            b = 1 << i
            assert (got[name].failing, got[name].failing_alone, got[name].kept_without) == (sum(x & b > 0 for x in bits), bits.count(b), sum(x & ~b == 0 for x in bits))


def test_empty_tables(spark):
    d = docs(spark, [])
    assert quality.judge(quality.ledger(d)).count() == 0 and mixing.schedule(d).count() == 0 and mixing.mix(d).count() == 0


def fill(sizes, weights):
    """Targets by repeated resharing."""
    total, open_, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if 3 * sizes[i] < left * weights[i] / w]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = 3.0 * sizes[i]
        open_ -= set(over)
    return out


@pytest.mark.parametrize("counts", [[30, 3, 9, 1], [1, 1, 50], [20], [5, 40, 2, 2, 2, 30, 1]])
def test_mix_reaches_targets(spark, counts, monkeypatch):
    rows = [(k * 1000 + i, " ".join(["w"] * (1 + (i * 7 + k) % 23)), "en", f"s{k}", 0, None) for k, n in enumerate(counts) for i in range(n)]
    rows.append((None, None, "en", None, 0, None))
    r_text = {r[0]: r[1] for r in rows}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)  # several buckets and ranges
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    got = mixing.schedule(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    names = sorted({r.source for r in got if r.source}) + [None]
    sizes = [sum(r.size for r in got if r.source == s) for s in names]
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, size, target in zip(names, sizes, want, strict=True):
        own = [r for r in got if r.source == s]
        assert all(r.source_size == size and math.isclose(r.target, target, abs_tol=1e-5) and 0 <= r.taken <= 3 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target) < len(names)
    assert sum(sizes) - len(names) <= sum(r.taken for r in got) <= sum(sizes)
    plan = {r.doc_id: r for r in got}
    queue = []  # by the definition: everything sent by virtual time 1, in its order, until the budget is used up
    for s, target in zip(names, want, strict=True):
        own, quota, through = sorted((r for r in got if r.source == s), key=lambda r: md5(f"mix-1|{r.doc_id if r.doc_id is not None else 'null'}|{md5(r_text[r.doc_id]) if r_text[r.doc_id] is not None else 'null'}")), math.floor(round(target, 6) + 0.5), 0
        for epoch in range(3):
            for r in own:
                through += r.size
                sent = r.size if through <= quota else max(0, quota - through + r.size)
                queue.append((min(1.0, through / round(target, 6)) if target else 1.0, s is None, s or "", epoch, sent, r.doc_id))
    left, taken = sum(sizes), Counter()
    for *_, sent, i in sorted(queue, key=lambda x: x[:4]):
        taken[i] += min(sent, left)
        left -= min(sent, left)
    assert sum(abs(taken[i] - r.taken) for i, r in plan.items()) <= 2 * len(names)  # ties and the last digit of the target
    again = mixing.schedule(spark.createDataFrame(rows[::-1], SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in got) == sorted((str(r.doc_id), r.taken) for r in again)


def test_mix_sends_what_was_planned(spark):
    d = docs(spark)
    planned = mixing.schedule(d).collect()
    sent = mixing.mix(d)
    assert sent.columns == d.columns
    assert sum(len(WORD.findall(r.text or "")) for r in sent.collect()) == sum(r.taken for r in planned)
