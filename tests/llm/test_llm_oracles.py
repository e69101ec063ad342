"""Registered queries against their DuckDB oracles, and the columns their contracts name."""

import pytest
from harness import compare, duck
from tallyline.llm import queries

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_snapshot_collapse": "conv_id n_turns n_copies rendered",
    "op4_winnowing": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5_byte_cnn": "doc_id held_out score predicted",
    "op6_sainte_lague": "doc_id size source_size target taken",
    "op7_circulant_minhash": "doc_id n_shingles component_id kept",
    "op8_bit_planes": "doc_id start n_tokens ids_crc32",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_sampled_splitters": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_veb_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_line_runs": "doc_id n_lines n_dropped kept_sha256",
    "op13_nra_search": "item_id rank doc_id score",
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(ready, name):
    got = queries.QUERIES[name](ready, SF)
    assert got.columns == COLUMNS[name].split()
    if "conv" not in COLUMNS[name] and "item_id" not in COLUMNS[name]:
        assert got.count() == ready.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(ready, name):
    same, why = compare(queries.QUERIES[name](ready, SF), duck(SF), queries.ORACLE[name])
    assert same, why
