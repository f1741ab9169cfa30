import bench


def test_no_total_unless_all_ran():
    got = bench.summary(["a", "b", "c"], {"a": 1.5})
    assert got["value"] is None and got["skipped"] == ["b", "c"] and got["queries"] == {"a": 1.5}
    assert bench.summary(["a", "b"], {"a": 1.5, "b": 2}) | {"queries": 0} == {"value": 3.5, "unit": "sec", "skipped": [], "queries": 0}


def test_the_package_can_be_shipped(spark, monkeypatch):
    import zipfile

    import lodestay

    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: sent.append(path))
    lodestay.ship(spark)
    assert "lodestay/functions/__init__.py" in zipfile.ZipFile(sent[0]).namelist()
