"""Some queries of each part against their SQL, on the smallest tables; the rest is compared by the driver."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
NAMES = ["listing_availability_monthly", "clean_listings", "booking_economics", "financial_performance", "host_performance_monthly", "host_kpis", "top_hosts", "agg_conditional_distinct", "win_moving_avg_12", "anti_join_null_aware", "fn_round", "scd2_apply_change", "scd3_prev_original", "retry_state", "check_array", "bronze_append", "stream_ingest"]


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 6) if isinstance(v, float | Decimal) else str(v) if not isinstance(v, int | bool) else int(v)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=str)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, name):
    from lodestay.queries import catalog

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = catalog.QUERIES[name](spark, str(DATA))
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(catalog.SQL[name])
    assert got == rows([c[0] for c in cur.description], cur.fetchall()) and got


def test_registry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150


def test_the_registry_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True, timeout=120)
