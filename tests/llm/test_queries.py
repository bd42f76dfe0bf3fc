"""The registered queries on the smallest tables: their columns, their rows, and their SQL forms."""

import duckdb
import pytest

from tests.llm.helpers import key

import __spark_entry__ as entry
from lexcorpus.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op3_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_language_model": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op7_chat": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op8_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op9_decontaminate": "doc_id bigint, item_id bigint, coverage double, tiles bigint",
    "op10_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op11_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}
MAY_BE_NULL = {"grown_shard", "start", "length", "period", "exponent_milli", "parent_conv_id"}


def test_all_are_given_out():
    assert set(COLUMNS) == set(queries.QUERIES) and {*COLUMNS, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, SF)
    wanted = [c.split() for c in COLUMNS[name].split(", ")]
    assert [list(t) for t in found.dtypes][: len(wanted)] == wanted
    rows = found.collect()
    if "doc_id" in found.columns and name not in ("op9_decontaminate", "op5_packing"):
        ids = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
        assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    assert rows and all(v is not None for r in rows for c, v in r.asDict().items() if c not in MAY_BE_NULL)
    if name in queries.ORACLES:
        con = duckdb.connect()
        for table in ("conversations", "embeddings"):
            con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
        cursor = con.execute(queries.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted((tuple(r[c] for c in names) for r in rows), key=key) == sorted(cursor.fetchall(), key=key)
