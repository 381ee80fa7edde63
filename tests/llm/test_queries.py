"""The registered queries: columns and types, and DuckDB where SQL can express them."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from clickloom.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op2_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op4_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op6_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op7_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op10_line_dedup": {"doc_id": "bigint", "n_lines": "int", "n_removed": "int", "removed": "string"},
    "op11_chat_format": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op12_conversation_trie": dict.fromkeys(("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "bigint") | {"ends_sha256": "string"},
    "op13_collocations": dict.fromkeys(("a", "l", "r", "n", "score"), "bigint") | {"lang": "string", "rank": "int", "phrase": "string"},
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES) and {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    kinds = dict(df.dtypes)
    assert COLUMNS[name].items() <= kinds.items()
    rows = df.collect()
    assert rows
    if name in ORACLE:
        con = duckdb.connect()
        for table in ("documents", "benchmark", "pages", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        relation = con.execute(ORACLE[name])
        order = [d[0] for d in relation.description]
        assert set(order) == set(df.columns)
        assert sorted((tuple(r[c] for c in order) for r in rows), key=str) == sorted(relation.fetchall(), key=str)
