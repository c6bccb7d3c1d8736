"""Each registered query has SQL or is named here with the test that holds it to plain code."""

import os

import __spark_entry__ as entry_module
from landfall.llm.queries import ORACLES, QUERIES

HELD_BY = {
    "op1_toxicity": ("test_llm", "test_models_on_held_out_rows"),
    "op2_quality_rules": ("test_llm", "test_rule_statistics"),
    "op3_token_counts": ("test_llm", "test_token_counts"),
    "op5_bpe": ("test_llm", "test_bpe"),
    "op6_quality_bayes": ("test_llm", "test_models_on_held_out_rows"),
    "op7_url_filter": ("test_llm", "test_url_filter"),
    "op8_sharding": ("test_words_and_tokens", "test_descent_against_plain_draws"),
    "op9_decontamination": ("test_llm", "test_decontamination_of_items_of_each_length"),
    "op12_language": ("test_words_and_tokens", "test_path_is_the_best_of_all"),
    "op13_alignment": ("test_words_and_tokens", "test_alignment_against_all_pairs"),
    "pipeline": ("test_llm", "test_pipeline"),
}


def test_each_query_is_held_to_something():
    assert HELD_BY.keys() | ORACLES.keys() == QUERIES.keys() | {"pipeline"}
    assert not HELD_BY.keys() & ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    for module, name in HELD_BY.values():
        with open(os.path.join(os.path.dirname(__file__), f"{module}.py")) as file:
            assert f"\ndef {name}(" in file.read()
