"""Queries against their SQL at the smallest scale; the driver does the same at a larger one."""

import pathlib

import duckdb
import pytest

from granary.plans import queries

DATA = "/root/testdata/sf0.001"
SOME = ["license_gate_decision", "rejection_details", "runtime_errors", "sanitize_html_pages", "unicode_nfc", "dup_group_id", "pii_policy_decision", "quality_gate", "repetition_ratio", "token_stats", "exact_dedup", "chunk_dup_links", "simhash_pairs_h3", "priority_dedup", "stage_funnel_by_source", "rejection_share", "entropy_percentiles", "length_percentiles", "event_value_percentiles", "source_collisions", "jsonl_lines", "rejection_breakdown", "daily_rollup", "dolma_projection", "url_extract_pages", "sources_union_priority_order"]


@pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "events", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    want = con.execute(queries.ORACLES[name]).fetch_df()
    got = queries.QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
    rows = lambda df: sorted(tuple("" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else str(v) for v in r) for r in df.itertuples(index=False))
    assert rows(got) == rows(want) and len(got)
