from lodestay.operators import checks


def test_arrays_and_json(spark):
    df = spark.createDataFrame([("['a', 'b']",), ("{a,b}",), ("a, b",), ("[]",), ("[a",), (None,)], "c string")
    assert [r[0] for r in df.select(checks.array_items("c")).collect()] == [["a", "b"], ["a", "b"], ["a", "b"], [], None, None]
    df = spark.createDataFrame([('{"a": 1}',), ("[1]",), ("{bad",), (None,)], "c string")
    assert checks.bad_json(df, "c").count() == 2


def test_timestamp_formats(spark):
    one = lambda *values: checks.timestamp_formats(spark.createDataFrame([(v,) for v in values], "c string"), "c").first()
    assert one("2024-01-01", None).valid and one("2024-01-01T10:00:00.5", "2024-01-01T10:00:00.123456").valid and one("2024-01-01 10:00:00").valid
    assert not one("2024-01-01", "01/31/2024").valid and not one("01/31/2024").valid and not one("2024-01-01", "2024-01-01 10:00:00").valid


def test_types_and_columns(spark):
    rows = [(1, 1.0, "x", True, "12", "1.5", "2024-01-01", "t", '{"a": 1}', None, (1,)), (2, None, "7", None, "-3", "2", None, "false", "[2]", None, (2,))]
    df = spark.createDataFrame(rows, "a int, b double, c string, d boolean, e string, f string, g string, h string, i string, j string, k struct<x: int>")
    want = {"a": "BIGINT", "b": "DOUBLE PRECISION", "c": "TEXT", "d": "BOOLEAN", "e": "BIGINT", "f": "DOUBLE PRECISION", "g": "DATE", "h": "BOOLEAN", "i": "JSONB", "j": "TEXT", "k": "JSONB"}
    types = checks.infer_types(df)
    assert {r.column_name: r.logical_type for r in types.collect()} == want and {r.column_name: r.filled for r in types.collect()}["b"] == 1
    stored = {"a": "INTEGER", "b": "BIGINT", "c": "TEXT", "e": "NUMERIC", "f": "TEXT", "g": "TIMESTAMP WITH TIME ZONE", "i": "JSON", "z": "TEXT"}
    got = {r.column_name: r.verdict for r in checks.compatible(types, stored).collect()}
    assert got == {"a": "narrowing", "b": "incompatible", "c": "same", "e": "compatible", "f": "incompatible", "g": "incompatible", "i": "compatible"}
    assert all(checks.takes(stored[c], want[c]) == (v != "incompatible") for c, v in got.items())
    assert [tuple(r) for r in checks.required_columns(df, ["a", "b", "z"]).collect()] == [("a", True, 2), ("b", True, 1), ("z", False, 0)]


def test_counts(spark):
    df = spark.createDataFrame([(1, 5, "a@b.co"), (1, -1, "x"), (None, 7, None)], "k int, v int, e string")
    assert [tuple(r) for r in checks.not_unique(df, "k").collect()] == [(1, 2)]
    assert checks.bad_emails(df, "e").count() == 2
    assert checks.out_of_range(df, "v", 0, 6).count() == 2
    assert [(r.column_name, r.failures) for r in checks.verify_range(df, "k", 0, 2, [("v", "v > 0", "m")]).collect()] == [("v", 1)]
