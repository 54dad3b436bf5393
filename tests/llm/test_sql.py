"""Queries that SQL can express against their SQL, over whole test tables; the contracts of all others."""

import duckdb
import pytest

import __spark_entry__ as entry
import inspection_fixtures as fixtures
from tamis.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_DIR
from tests.test_oracle import _bag

# The columns asked for.
CONTRACT = {
    "op1_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op2_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op3_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op9_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op10_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op11_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string",
    "op12_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op13_nearest": "query_id bigint, rank int, vec_id bigint, score double",
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in fixtures.TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result, expected = QUERIES[name](spark, SF_DIR), duck.sql(ORACLE_SQL[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert _bag(result.columns, result.collect()) == _bag(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(CONTRACT) - set(ORACLE_SQL)))
def test_columns(spark, name):
    """Lazy results only: each query's columns begin with those of its contract."""
    found = QUERIES[name](spark, SF_DIR).dtypes
    assert ", ".join(f"{c} {t}" for c, t in found).startswith(CONTRACT[name])


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
