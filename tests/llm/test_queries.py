"""The registered queries: DuckDB statements on the smallest tables, result
columns and types, and that they read whole tables."""

import zlib

import duckdb
import pytest

import __spark_entry__ as E
from stayline.llm.queries import Q
from stayline.llm.sql import SQL
from tools.check_oracle import TABLES, digest

COLUMNS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_minhash_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op4_warc_segments": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string",
                          "record_type": "string", "refers_to": "bigint"},
    "op5_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_hnsw_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op7_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint",
                         "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op8_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint",
                         "kept_sha256": "string"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                           "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_chat_format": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint",
                         "loss_sha256": "string", "formatted_chars": "bigint"},
    "op13_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string",
                             "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op10_language_mixture": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_duckdb(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    rel = con.sql(SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_columns_and_whole_tables(spark, sf_small, con, key):
    df = Q[key](spark, sf_small)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert COLUMNS[key].items() <= types.items()
    if key != "op6_hnsw_search":
        table = {"op4_warc_segments": "pages", "op8_embedding_dedup": "embeddings",
                 "op12_chat_format": "(SELECT DISTINCT conv_id FROM conversations UNION ALL SELECT -1)"}.get(key, "documents")
        assert df.count() == con.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]


@pytest.mark.parametrize("key,mod,rest", [("op1_toxicity", 4, 2), ("op10_language_mixture", 3, 1)])
def test_held_out_follows_crc32(spark, sf_small, key, mod, rest):
    for r in Q[key](spark, sf_small).select("doc_id", "held_out").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest)
