"""Loads from file to stored rows: counts by the writing job, rules, digests, schemas as they change."""

import gzip
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.operators import checks
from lodestay.sources import loading

SCHEMA = "id long, name string, at string"


def jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def put(path, *lines):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n" if lines else "")


def test_one_job_writes_counts_and_checks(spark):
    path = f"{sources.work_dir(spark)}/t"
    df = spark.range(1000, numPartitions=3).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 10 > 0, F.col("id").cast("double")).alias("v"))
    rules = [
        checks.row_rule("six", "k = 6", fatal=False),
        checks.not_null_rule("v", 0.8),
        checks.not_null_rule("k"),
        checks.accepted_rule("k", range(7)),
        checks.range_rule("id", 0, 999),
        checks.row_rule("unknown", "v < 0"),
    ]
    seen, n = jobs(spark, "one", lambda: loading.write_batch(df, path, "b1", "f", rules=rules))
    assert n == 1 and (seen.rows, seen.rows_failed, seen.failures) == (1000, 0, {"six": sum(i % 7 == 6 for i in range(1000))})
    assert sources.batch_rows(spark.read.parquet(path), "b1") == 1000
    assert loading.append_batch(df.where("id < 5"), path, "b1", "f") == 5  # replaces itself
    assert loading.append_batch(df.limit(0), path, "b2", "f") == 0
    assert {r[0]: r[1] for r in sources.batch_counts(spark.read.parquet(path)).collect()} == {"b1": 5}
    assert not [p for p in Path(path).iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]  # nothing staged is left


def test_a_broken_rule_keeps_the_batch_out_and_is_recorded(spark):
    work = sources.work_dir(spark)
    load = lambda df, n, **more: loading.load(df, f"{work}/t", f"{work}/m", "t", f"b{n}", f"f{n}", f"h{n}", **more)
    good = spark.createDataFrame([(1, "a@b.org", "2024-01-01"), (2, "c@d.org", "2024-01-02")], SCHEMA)
    rules = [checks.email_rule("name"), *checks.type_rules({"at": "TIMESTAMP"}, F.lit("2030-01-01").cast("timestamp")), checks.row_rule("two", "id = 2", fatal=False)]
    assert load(good, 1, rules=rules, required=["id", "at"]) == "COMPLETED"
    bad = good.union(spark.createDataFrame([(3, "nobody", "2024-01-03"), (4, "x", "2031-01-01"), (5, None, "soon")], SCHEMA))
    with pytest.raises(loading.RejectedError, match="email:name"):
        load(bad, 2, rules=rules)
    with pytest.raises(ValueError, match="lacks.*price"):
        load(good, 3, required=["price"])
    rows = {r.batch_id: r for r in loading.read_metrics(spark, f"{work}/m").collect()}
    assert json.loads(rows["b1"].failed_rules) == {"two": 1} and rows["b1"].rows_failed == 0
    assert json.loads(rows["b2"].failed_rules) == {"email:name": 2, "timestamp:at": 1, "future:at": 1, "two": 1}
    assert (rows["b2"].processing_status, rows["b2"].rows_processed, rows["b2"].rows_inserted, rows["b2"].rows_failed) == ("FAILED", 5, 0, 2)
    assert "email:name" in rows["b2"].error_message and "price" in rows["b3"].error_message
    assert spark.read.parquet(f"{work}/t").count() == 2


def test_rules_of_declared_types(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", '{"a": 1}', "[a, b]"), ("2024-01-02 10:00:00", "{bad", "{a,b}"), (None, None, "[a")], "at string, j string, a string")
    rules = checks.type_rules({"at": "TIMESTAMP", "j": "JSONB", "a": "TEXT[]", "x": "TEXT"}, F.lit("2024-01-02").cast("timestamp"))
    got = df.agg(*[r.failures.alias(r.name.replace(":", "_")) for r in rules]).first().asDict()
    assert got == {"timestamp_at": 0, "future_at": 1, "json_j": 2, "array_a": 1}


def test_a_column_more_is_one_snapshot_more(spark):
    work = sources.work_dir(spark)
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    load = lambda df, n: loading.load(df, f"{work}/t", f"{work}/m", "t", f"b{n}", f"f{n}", f"h{n}", snapshots=f"{work}/s")
    load(a, 1)
    load(a, 2)
    load(a.withColumn("price", F.lit(1.5)), 3)
    load(a, 4)  # lacks the new column, which stays
    rows = sorted(loading.read_snapshots(spark, f"{work}/s").collect(), key=lambda r: r.number)
    assert [(r.number, r.added, r.removed, r.changed, r.last_file_processed) for r in rows] == [(1, ["id", "name"], [], [], "f1"), (2, ["price"], [], [], "f3")]
    assert json.loads(rows[1].schema_snapshot) == {"id": "int", "name": "string", "price": "double"}
    assert loading.schema_diff(rows[1].schema_snapshot, json.dumps({"id": "bigint", "name": "string"})) == ([], ["price"], ["id"])
    state = loading.table_state(loading.read_metrics(spark, f"{work}/m"), loading.read_snapshots(spark, f"{work}/s")).first()
    assert (state.total_rows, state.last_file_processed, state.schema_number) == (4, "f4", 2) and state.processed_at


def test_digests_follow_the_lines_and_no_file_is_one_value(spark):
    work = sources.work_dir(spark).removeprefix("file://")
    long = [f"line {i} " + "x" * 50 for i in range(30_000)]  # more than one batch of lines
    for name, lines in {"a": ["1,a", "2,b"], "b": ["1,a", "2,b"], "c": ["2,b", "1,a"], "empty": [], "d": long}.items():
        put(f"{work}/in/{name}.csv.gz", *lines)
    got = {Path(r.file_name).name: (r.file_hash, r.file_size_bytes) for r in sources.fingerprints(spark, f"{work}/in").collect()}
    want = lambda lines: hashlib.md5(hashlib.md5("".join(f"{x}\n" for x in lines).encode()).hexdigest().encode()).hexdigest()
    assert got["a.csv.gz"][0] == got["b.csv.gz"][0] == want(["1,a", "2,b"]) != got["c.csv.gz"][0]
    assert got["d.csv.gz"][0] == want(long) and got["empty.csv.gz"][0] == hashlib.md5(b"").hexdigest()
    assert all(size == Path(f"{work}/in/{name}").stat().st_size for name, (_, size) in got.items())


def test_files_are_known_by_their_contents(spark):
    work = sources.work_dir(spark).removeprefix("file://")
    run = lambda **more: loading.ingest_changed(spark, f"{work}/in", "id int, name string", f"{work}/t", f"{work}/ledger", **more)
    Path(f"{work}/in").mkdir(parents=True)
    assert run() == {"COMPLETED": 0, "SKIPPED": 0}
    put(f"{work}/in/a.csv.gz", "id,name", "1,a")
    put(f"{work}/in/b.csv.gz", "id,name", "2,b")
    put(f"{work}/in/copy.csv.gz", "id,name", "2,b")
    assert run(most_files=2) == {"COMPLETED": 2, "SKIPPED": 1} and run() == {"COMPLETED": 0, "SKIPPED": 0}
    put(f"{work}/in/a.csv.gz", "id,name", "1,a", "3,c")  # the same name, other contents
    put(f"{work}/in/z.csv.gz", "id,name", "1,a")  # other name, contents that were in
    assert run() == {"COMPLETED": 1, "SKIPPED": 1}
    assert sorted((r.id, r.name) for r in spark.read.parquet(f"{work}/t").collect()) == [(1, "a"), (1, "a"), (2, "b"), (3, "c")]
    rows = loading.read_files(spark, f"{work}/ledger").collect()
    assert sorted((Path(r.file_name).name, r.status, r.rows_processed) for r in rows) == [("a.csv.gz", "COMPLETED", 1), ("a.csv.gz", "COMPLETED", 2), ("b.csv.gz", "COMPLETED", 1), ("copy.csv.gz", "SKIPPED", 0), ("z.csv.gz", "SKIPPED", 0)]
