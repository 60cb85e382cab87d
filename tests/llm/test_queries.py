import pytest

import __spark_entry__ as contract
from compare import database, difference
from tablesync.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows_as_sql(spark, name):
    with database(SF) as con:
        assert difference(contract.queries()[name](spark, SF), con, ORACLE[name]) is None


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(contract.queries())


COLUMNS = {
    "op1_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op2_quality": ["doc_id", "held_out", "score", "predicted"],
    "op3_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_decontamination": ["doc_id", "item_id"],
    "op5_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7_kneser_ney": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op8_top_k": ["query_id", "rank", "vec_id", "score"],
    "op9_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op10_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13_url_filter": ["page_id", "host", "path", "rule", "verdict"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_of_the_contract(spark, name):
    out = QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(out.columns)
    per_row = {"documents": ("op2", "op3", "op5", "op6", "op7", "op10", "op11"), "pages": ("op1", "op13")}
    for table, names in per_row.items():
        if name.split("_")[0] in names:
            assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
