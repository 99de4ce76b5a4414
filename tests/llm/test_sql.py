"""The contract queries that SQL can express, against it, and all of them for their columns."""

import pytest
from korvane.llm.queries import ORACLE_SQL, QUERIES

from ..sql_check import differences

COLUMNS = {
    "op1_ctw": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2_ann": "query_id rank vec_id score",
    "op3_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_metric": "vec_id n_links component_id kept",
    "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_langid": "doc_id held_out lang_pred score",
    "op8_quality": "doc_id held_out score predicted",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_lines": "doc_id n_lines n_dropped kept_sha256",
    "op13_lloyd": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(name, spark, sf_dir):
    assert differences(spark, sf_dir, QUERIES[name], ORACLE_SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(name, spark, sf_dir):
    out = QUERIES[name](spark, sf_dir)
    assert out.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert out.count() >= 0
