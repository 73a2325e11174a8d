import pytest

import __spark_entry__ as entry
from tidemill.plans import registry

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = ["daily_ohlcv_summary", "clean_bars", "audit_counts", "grid_step_label", "next_session_asof", "vwap_crosses", "volume_profile", "grid_replay", "hostile_selloff_label", "threshold_search", "failure_windows", "failure_cohorts", "runtime_controls", "overnight_asof", "feature_table", "default_day_parts", "walk_forward_trained", "csv_scan", "daily_source", "boosted_splits", "ranking_metrics", "downside_comparison", "describe_stats", "bucket_summary", "backfill_ranges", "backfill_state", "merge_partitions", "checked_rows", "rolling_split_series", "labels_of_many_bars", "streaming_replay", "walk_forward_line_metrics", "walk_forward_line_modes"]


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    rel = con.sql(entry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in names]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_entry_and_registries(spark):
    assert entry.entry(spark).columns[:2] == ["code", "date"]
    assert set(registry.ORACLES) <= set(registry.QUERIES) <= set(entry.queries())
