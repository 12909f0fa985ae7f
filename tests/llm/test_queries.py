import re

import pytest

import corpus_pipeline
from quire.llm.queries import ORACLE, QUERIES
from tests.compare import differences, sql_connection

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_benchmark_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3_line_dedup": "doc_id n_lines n_removed n_links removed_sha256 class_id n_in_classes classes_sha256",
    "op4_simhash_near_dedup": "doc_id fingerprint component_id",
    "op5_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6_exact_top_k": "query_id rank vec_id score",
    "op7_token_id_orc": "doc_id start n_tokens ids_crc32",
    "op8_mixing": "doc_id source weight copies epoch block place",
    "op9_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op10_toxicity": "doc_id held_out score predicted",
    "op11_embedding_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op13_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


@pytest.fixture(scope="module")
def connection():
    with sql_connection(FOLDER) as c:
        yield c


def test_one_query_for_each_operator():
    assert QUERIES.keys() == COLUMNS.keys() and ORACLE.keys() <= QUERIES.keys()
    assert [re.match(r"op(\d+)_", name)[1] for name in QUERIES] == [str(n) for n in range(1, 14)]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE.keys()))
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, FOLDER)
    assert got.columns == COLUMNS[name].split()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    expected = {"op11_embedding_whitening": 4 * spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()}
    if name == "op8_mixing":
        # A row for each copy.
        assert got.select("doc_id").distinct().count() == documents
        assert got.where("epoch > copies or epoch is null").count() == 0
    else:
        assert got.count() == expected.get(name, documents)
