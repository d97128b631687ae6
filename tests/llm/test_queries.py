"""Each registered query: its columns, and its SQL where there is some."""

import os
import sys

import pytest
from helpers import SF

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3_substring": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op7_line_dedup": ["doc_id", "n_lines", "n_exact", "n_near", "removed"],
    "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_metric_join": ["vec_id", "n_links", "component_id", "kept"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_pii": ["doc_id", "n_email", "n_phone", "n_card", "n_ssn", "n_ip", "n_name", "text"],
}


def test_registered():
    import __spark_entry__ as e
    assert set(COLUMNS) | {"pipeline"} <= set(e.queries())


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    from oracle_check import compare, duck

    from feria.llm.queries import ORACLE, QUERIES
    assert QUERIES[name](spark, SF).columns == COLUMNS[name]
    if name in ORACLE:
        assert compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF) == "OK"
