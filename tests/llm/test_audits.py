"""Secrets, the filter audit and whitening against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestay.llm import interaction, secrets, whitening

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE64 = LETTERS + LETTERS.lower() + "0123456789+/"
PROSE = "The quick brown fox jumps over the lazy dog while internationalization of misunderstandings continues, "


# Secrets.


def plain_spans(text):
    """Every match of each pattern, then the conditions, as the contract states them."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for i, (kind, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 18), ("hex", r"[0-9a-f]+", 16)), 1):
        out += [(m.start(), i, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(a, k, b) for a, _, k, b in sorted(out)]


def plain_entropy(s):
    return sum(n / len(s) * math.log2(len(s) / n) for n in Counter(s).values())


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    parts = ["token", "TOKEN", "Api_Key", "apikey", "api__key", "ſecret", "secret", "passwd", "PassWord", " ", "   ", ":", "=", "'", '"', "AKIA", "AKIAAKIA", "abc123", "deadbeef", "0123456789abcdef", "A1B2C3D4E5", "/", ".", "+", "é", "😀", "\n", "x"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 25)))
        assert secrets.base_spans(text) == plain_spans(text), text


def test_windows_are_counted_anew():
    rng = random.Random(4)
    sorts = lambda s: "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" for c in s)
    for n in (1, 15, 16, 17, 60):
        s = "".join(rng.choices(BASE64 + "_-=aaaaaa", k=n))
        want = [(plain_entropy(s[i : i + 16]), plain_entropy(sorts(s[i : i + 16]))) for i in range(n - 15)]
        assert np.allclose(list(secrets.windows(s)), np.array(want).reshape(-1, 2), atol=1e-9) if want else not list(secrets.windows(s))


def test_planted_secrets_come_back_and_prose_stays():
    rng = random.Random(5)
    found = total = 0
    for _ in range(300):
        alphabet, n = rng.choice([(BASE64, 40), (BASE64, 24), (LETTERS + "0123456789", 32), ("0123456789ABCDEF", 40), (LETTERS.lower() + "0123456789", 40)])
        value = "".join(rng.choices(alphabet, k=n))
        text = PROSE + value + " " + PROSE
        base = secrets.base_spans(text)
        spans = base + secrets.added_spans(text, base)[0]
        total += 1
        found += any(b - a >= n * 3 // 4 and len(PROSE) <= a and b <= len(PROSE) + n for a, _, b in spans)
    assert found >= 0.9 * total, (found, total)
    clean = [PROSE * 50, "Donaudampfschifffahrtsgesellschaftskapitän 20-10-2024 2024-10-21T10:20:30", "https://example.org/a/b7Kq2/x9Zt4Lm8Qp3Ws6Rv1Yc5", "550e8400-e29b-41d4-a716-44665544000a", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "internationalization-of-misunderstandings-2024-and-2025", "-" * 200, "=" * 5000, "getElementsByTagNameAndSomeMoreWords2", "0123456789abcdefghijklmnopqrstuvwxyzABCDEF"]
    for text in clean:
        base = secrets.base_spans(text)
        assert secrets.added_spans(text, base)[0] == [], text


def test_suppression_follows_the_list_given():
    value = "9fQ2mLx7Zt4Kp8Ws3Rv1Yc6Bn5Hd0Gj"
    text = f"see https://host.org/{value} and sha256-{value}"
    spans, suppressed = secrets.added_spans(text, [])
    assert spans == [] and suppressed == 2
    assert len(secrets.added_spans(text, [], rules=())[0]) == 2


def test_secrets_of_a_table(spark):
    value = "9fQ2mLx7Zt4Kp8Ws3Rv1Yc6Bn5Hd0Gj"
    texts = ["", None, f"a token: {value} b", f"é😀 {value}", "password=short", "AKIA" + "Q" * 14, value * 3000, PROSE * 3000, f"a token: {value} b"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_added int")
    rows = secrets.find(docs).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    assert by[0].spans == by[1].spans == by[4].spans == "" and by[0].n_added == 0
    assert by[2].spans == by[8].spans == by[2].base == f"assign:2:{2 + 7 + len(value)}"
    assert by[None].base == "" and by[None].spans == f"assign:3:{3 + len(value)}" and by[None].n_added == 1
    assert by[5].spans == "access:0:18" and by[7].spans == ""
    assert by[6].spans == f"assign:0:{3000 * len(value)}"
    assert secrets.find(docs.limit(0)).count() == 0


def test_secrets_query(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    rows = secrets.op11_entropy_secrets(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in base) for x in secrets.KINDS]
        assert not Counter(listed) - Counter(r.spans.split(","))


# The filter audit.

WORDY = " ".join(f"w{i}" for i in range(250))


def plain_audit(docs, labels):
    """Every order applied to every document."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    fails = []
    for i, t, _ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({f for f, y in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]), strict=True) if y})
    out = {}
    for part in {s or "" for *_, s in docs}:
        mine = [(i, f) for (i, _, s), f in zip(docs, fails, strict=True) if (s or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i, m in left if f in m]
                left = [(i, m) for i, m in left if f not in m]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in m for _, m in mine) - len(gone), sum(m == {f} for _, m in mine), sum(i in good for i in gone), sum(i in toxic for i in gone)]
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return out


def check_audit(spark, docs, labels):
    d = spark.createDataFrame([(*x, 7) for x in docs], "doc_id long, text string, source string, mask int")
    lab = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in interaction.interactions(d, lab).collect()}
    assert got == plain_audit(docs, labels)
    return got


def test_audit_applies_every_order(spark):
    rng = random.Random(6)
    texts = [None, "", "a b c", WORDY, WORDY + " #", "W" * 50 + " " + WORDY, "same words " * 150, "same words | " * 150, "SHOUT " * 10, " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200))]
    docs = [(i if i % 13 else None, rng.choice(texts), rng.choice(["s1", "s2", None, ""])) for i in range(120)] + [(5, WORDY, "s1"), (5, WORDY, "s1"), (-3, WORDY, "s2")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(100) if i % 3] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (999, 1, 1)]
    got = check_audit(spark, docs, labels)
    assert len(got) == 3 * 600


def test_audit_of_one_large_group_and_of_nothing(spark):
    check_audit(spark, [(i, "the same text", "s") for i in range(900)] + [(1000, WORDY, "s")], [(0, 1, 0), (1, 1, 1)])
    assert check_audit(spark, [], [(1, 1, 1)]) == {}


def test_intervals_follow_the_lexicographic_order():
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert [interaction.rank(o) for o in orders] == list(range(120))
    want = Counter((mask, next(s for s, f in enumerate(o, 1) if mask >> "ABCDE".index(f) & 1), r) for mask in range(1, 32) for r, o in enumerate(orders))
    assert Counter((m, s, r) for m, s, low, high in interaction.intervals() for r in range(low, high)) == want


def test_audit_matches_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({interaction.OP12_SQL})").fetchall())
    assert sorted(map(tuple, interaction.op12_lehmer_audit(spark, d).select(*names).collect())) == want and want


# Whitening.


def test_rank_one_updates_keep_the_spectrum():
    rng = np.random.default_rng(1)
    for case in range(150):
        d = int(rng.integers(1, 20))
        w = np.sort(np.abs(rng.normal(size=d)) * 10.0 ** rng.integers(-8, 8, size=d if case % 2 else 1))
        if case % 3 == 0:
            w[: d // 2] = w[0]
        if case % 5 == 0:
            w[:] = 0
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        u = q[:, 0] * 3 if case % 7 == 0 else rng.normal(size=d) * 10.0 ** rng.integers(-6, 6)
        m = q @ np.diag(w) @ q.T + np.outer(u, u)
        w2, q2 = whitening.rank_one(w, q, u)
        assert np.abs(q2 @ np.diag(w2) @ q2.T - m).max() <= 1e-12 * np.abs(m).max()
        assert np.abs(q2.T @ q2 - np.eye(d)).max() <= 1e-12 and np.all(np.diff(w2) >= -1e-12 * w2[-1])


def test_spectra_join():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(90, 7)) * [900, 300, 100, 30, 10, 3, 1] + 100_000).astype(np.int64)
    parts = []
    for rows in (x[:1], x[1:4], x[4:60], x[60:]):
        s = whitening.Spectrum(7)
        sums = np.zeros(7, np.int64)
        for r in rows:
            s.add(r, sums)
            sums = sums + r
        s.sums = sums.astype(object)
        parts.append(s)
    whole = parts[0]
    for s in parts[1:]:
        whole.join(s)
    c = x - x.mean(0)
    assert whole.n == 90 and list(whole.sums) == list(x.sum(0))
    assert np.abs(whole.q @ np.diag(whole.w) @ whole.q.T - c.T @ c).max() <= 1e-11 * np.abs(c.T @ c).max()


def plain_whitening(vectors, k=8):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    centred = np.array([[float(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x], centred @ basis / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_query_matches_dense_algebra(spark):
    d = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, deviation, white, share = plain_whitening([[float(c) for c in r.embedding] for r in given])
    at = {r.vec_id: i for i, r in enumerate(given)}
    rows = whitening.op13_incremental_whitening(spark, d).collect()
    assert len(rows) == 8 * len(given)
    flip = {}
    for r in rows:
        want = white[at[r.vec_id], r.component - 1]
        if abs(want) > 0.1:
            flip.setdefault(r.component, math.copysign(1, r.whitened * want))
    for r in rows:
        assert (r.n, r.deviation) == (n, deviation[at[r.vec_id]])
        assert abs(flip[r.component] * r.whitened - white[at[r.vec_id], r.component - 1]) <= 1e-9
        assert abs(r.explained - share[r.component - 1]) <= 1e-10 and r.identity_error <= 1e-10


def test_whitening_drops_what_cannot_be_used(spark):
    rng = random.Random(8)
    vectors = [(i, [rng.gauss(0, 1), rng.gauss(0, 2), rng.gauss(1, 3)], i) for i in range(50)]
    odd = [(100, None, 0), (101, [1.0, None, 2.0], 0), (102, [math.nan, 1.0, 2.0], 0), (103, [math.inf, 1.0, 2.0], 0), (104, [], 0), (105, [1.0], 0), (106, [1e30, 0.0, 0.0], 0)]
    df = spark.createDataFrame([*vectors, *odd, (None, vectors[0][1], 0), vectors[1]], "vec_id long, embedding array<float>, n int").repartition(11)
    rows = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in rows) == sorted(str(i) for i in [*range(50), None, 1])
    floats = {i: [float(np.float32(c)) for c in v] for i, v, _ in vectors}
    n, deviation, white, share = plain_whitening([floats[0 if r.vec_id is None else r.vec_id] for r in rows])
    assert [int(r.deviation) for r in rows] == deviation and {r.n for r in rows} == {52}
    assert np.abs(np.abs(np.array([r.whitened for r in rows])) - np.abs(white)).max() <= 1e-9
    assert np.allclose(rows[0].explained, share, rtol=1e-9) and len(share) == 3
    for few in (df.limit(0), df.where("vec_id = 100"), df.where("vec_id = 3"), df.where("vec_id = 1")):
        assert whitening.whiten(few).count() == 0  # nothing varies


def test_whitening_with_fewer_rows_than_dimensions(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(5)], "vec_id long, embedding array<double>").repartition(3)
    rows = whitening.whiten(df).collect()
    assert {len(r.whitened) for r in rows} == {4} and rows[0].identity_error <= 1e-9


def test_large_numbers_stay_exact():
    x = np.array([[(1 << 51) + 5, -7], [3, 9]], np.int64)
    m = whitening.Whitening(1 << 40, [11, -13], np.eye(2), np.ones(2), 2.0)
    assert [[int(v) for v in r] for r in m.centred(x)] == [[((1 << 51) + 5) * (1 << 40) - 11, -7 * (1 << 40) + 13], [3 * (1 << 40) - 11, 9 * (1 << 40) + 13]]
    assert whitening.exact(1, x).dtype == np.int64 and pa.array(x[0]).type == pa.int64()


def test_combining_takes_a_few_at_a_time(spark):
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(400)], "vec_id long, embedding array<double>").repartition(30)
    rows = whitening.integers(df)
    model = whitening.fit(rows)
    one = whitening.fit(whitening.integers(df.coalesce(1)))
    assert model.n == one.n == 400 and np.allclose(model.values, one.values, rtol=1e-12)
    assert rows.select(F.count("*")).first()[0] == 400
