"""The registered queries on the smallest tables: against SQL where there is some, else their columns and row counts."""

import os

import pytest

from check import compare, oracle
from furrow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_fingerprint": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_simhash": "doc_id fingerprint component_id",
    "op5_class_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op8_quality": "doc_id held_out score predicted",
    "op9_vafile": "query_id rank vec_id score",
    "op10_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op11_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op12_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    plan, statement = QUERIES[name]
    if statement:
        verdict, _, _, ok = compare(spark, oracle(SF), name, plan, statement, SF)
        assert ok, verdict
    rows = plan(spark, SF)
    assert set(CONTRACT[name].split()) <= set(rows.columns)
    if not statement:
        docs = spark.read.parquet(f"{SF}/documents.parquet").count()
        found = rows.toPandas()
        assert found.doc_id.nunique() == docs and (name == "op6_packing" or len(found) == docs)
