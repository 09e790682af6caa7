"""Every query over whole small tables: the columns asked for, one row each, and SQL where there is some."""

import os

import pytest
from compare import connect, spark_table, sql_table

from entityframe.llm.queries import ORACLES, QUERIES

# The columns that are asked for.
COLUMNS = {
    "op1_url_filter": "page_id host path rule verdict",
    "op2_quality": "doc_id quality_score text_score metadata_score keep",
    "op3_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6_compact_windows": "doc_id n_words n_removed n_spans kept_sha256",
    "op7_jaccard_join": "doc_id n_shingles component_id",
    "op8_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op9_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_lattice_dedup": "vec_id n_links component_id kept",
    "op11_importance_resampling": "doc_id n_features weight score rank",
    "op12_vector_codes": "vec_id code error label_error codebooks_sha256",
    "op13_vector_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}
ROWS_OF = {"op1_url_filter": "pages", "op10_lattice_dedup": "embeddings", "op12_vector_codes": "embeddings"}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, data, name):
    got = QUERIES[name](spark, data)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    source = spark.read.parquet(os.path.join(data, f"{ROWS_OF.get(name, 'documents')}.parquet"))
    rows = got.collect()
    if name in ("op5_packing", "op13_vector_packing"):
        assert {r.doc_id for r in rows} == {r.doc_id for r in source.collect()}
    else:
        assert len(rows) == source.count()


def test_every_operator_is_registered():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, data, name):
    assert spark_table(QUERIES[name](spark, data)) == sql_table(connect(data), ORACLES[name])
