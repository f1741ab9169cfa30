"""Rule bitmask ledger: every rule is evaluated once per document; policies and ablations only read the stored bits.

DataFrame functions only. Null or blank text has no words and fails the base rules and every policy; repeated rows are judged alike, in
place; a measurement that equals a rule's bound passes; an empty table gives no rows; a text of any length is measured whole,
in arrays of its words; other columns pass through, and a ledger column replaces one of the same name. Nothing is dropped for
its length alone but texts of fewer than 50 words (base, v1, strict) or none (v2). No row moves between tasks; ablations move a row a bit pattern.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.llm.common import BLANKS, documents, free_name, shield, unshield, words

#: Fixed values: (name, failing condition over the measurements). A rule's bit is its place in this list; only append.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols_per_word", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("upper_case", "10 * n_upper > 4 * word_chars"),
    ("exclamations", "10 * n_exclaims > 3 * n_words"),
    ("no_words", "n_words = 0"),
]
BASE = ("too_few_words", "repeated_windows")
#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    # repeated lines alone don't reject: line dedup, which follows, takes them out of otherwise clean documents
    "v1": (*BASE, "short_words", "long_words", "symbols_per_word", "upper_case", "exclamations"),
    # short documents can be clean: v2 rejects only those without a word
    "v2": ("no_words", "repeated_windows", "short_words", "long_words", "symbols_per_word", "upper_case", "exclamations"),
    "strict": (*BASE, "short_words", "long_words", "symbols_per_word", "repeated_lines", "upper_case", "exclamations"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaims")


def mask(policy: str) -> int:
    """The bits that a policy looks at."""
    names = [n for n, _ in RULES]
    return reduce(lambda m, n: m | 1 << names.index(n), POLICIES[policy], 0)


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _covered(hashes: Column) -> Column:
    """Words in windows (given by hash, in text order) that occur twice or more; a window covers three words."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        twin = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) & (i > 0) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(twin, lambda x: x["i"]))

    def total(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(F.lit(3), b - a))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    once = F.transform(F.array(by_hash), positions)  # a lambda variable is computed once, however often it is read
    return F.get(F.transform(once, total), F.lit(0)).cast("long")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements, `failures` (long, bit i set when RULES[i] fails) and nothing decided yet."""
    w, h, t, held = (free_name(docs, x) for x in ("__words", "__hashes", "__text", "__lines"))
    base = docs.drop(*[c for c in docs.columns if c in (*MEASURES, "failures")])
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    n = F.size(w)
    hashed = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))))
    measured = (
        base.withColumn(t, F.coalesce(F.col(text), F.lit("")))
        .withColumn(w, words(F.col(text)))
        .withColumn(h, hashed)
        .withColumn(held, lines)
        .withColumns(
            {
                "n_words": n.cast("long"),
                "word_chars": F.length(F.translate(F.col(t), BLANKS, "")).cast("long"),
                "n_symbols": _count_of(F.col(t), "#*$%&|<>"),
                "n_dup_lines": (F.size(held) - F.size(F.array_distinct(held))).cast("long"),
                "n_repeat_words": F.when(F.size(F.array_distinct(F.col(h))) < F.size(F.col(h)), _covered(F.col(h))).otherwise(F.lit(0)).cast("long"),
                "n_lines": F.size(held).cast("long"),
                "n_upper": _count_of(F.col(t), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                "n_exclaims": _count_of(F.col(t), "!"),
            }
        )
        .drop(t, w, h, held)
    )
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, rule) in enumerate(RULES)])
    return measured.withColumn("failures", bits)


def judge(stored: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds base_failed, policy and kept from the stored bits alone."""
    failed = lambda p: F.col("failures").bitwiseAND(F.lit(mask(p))) != 0
    return stored.withColumns({"base_failed": failed("base"), "policy": F.lit(policy), "kept": ~failed(policy)})


def ablations(stored: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: how many documents fail it, fail it alone, and would stay if it were dropped.

    The ledger is first summed by bit pattern, which has a fixed number of values, so the shuffle is tiny at any size.
    """
    m = mask(policy)
    patterns = stored.groupBy(F.col("failures").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("docs"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (n, _) in enumerate(RULES) if m >> i & 1])
    each = patterns.select("bits", "docs", F.explode(rules).alias("r")).select("bits", "docs", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("docs")).otherwise(0)).alias("failing_alone"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("docs")).otherwise(0)).alias("kept_without"),
        F.bit_or(F.when(hit, F.col("bits")).otherwise(F.lit(0))).alias("fails_together_with"),
    )


def quality_filter(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """docs without the rejected rows; same columns.

    A row number beside the verdict keeps the optimizer from pushing the filter below the measurements, where every rule
    would compute them anew.
    """
    judged = judge(ledger(shield(docs, "text")), policy).withColumn("__nth", F.monotonically_increasing_id())
    return unshield(judged.where(F.col("kept") & (F.col("__nth") >= 0)), docs, "text")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(ledger(documents(spark, sf_dir).select("doc_id", "text")))
    return judged.select("doc_id", *MEASURES[:5], "base_failed", "kept", "n_lines", "n_upper", "n_exclaims", "failures")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does to the whole table."""
    return ablations(ledger(documents(spark, sf_dir).select("text")).select("failures"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tri AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM
        (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
cov AS (SELECT r, count(DISTINCT i + o) AS n FROM tri, (SELECT unnest([0, 1, 2]) AS o) WHERE k > 1 GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper, length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclaims
      FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
        + CASE WHEN 10 * n_symbols > 3 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END
        + CASE WHEN 10 * n_upper > 4 * word_chars THEN 64 ELSE 0 END + CASE WHEN 10 * n_exclaims > 3 * n_words THEN 128 ELSE 0 END
        + CASE WHEN n_words = 0 THEN 256 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed, failures & 223 = 0 AS kept,
  n_lines, n_upper, n_exclaims, failures FROM f
"""

ABLATIONS_SQL = f"""
WITH l AS (SELECT failures & 223 AS bits FROM ({OP8_SQL})),
rules AS (SELECT unnest(['too_few_words', 'repeated_windows', 'short_words', 'long_words', 'symbols_per_word', 'upper_case', 'exclamations']) AS rule,
  unnest([1, 2, 4, 8, 16, 64, 128]) AS bit)
SELECT rule, count(*) FILTER (bits & bit <> 0) AS failing, count(*) FILTER (bits = bit) AS failing_alone, count(*) FILTER (bits & (255 - bit) = 0) AS kept_without,
  coalesce(bit_or(bits) FILTER (bits & bit <> 0), 0)::BIGINT AS fails_together_with FROM l, rules GROUP BY rule
"""
