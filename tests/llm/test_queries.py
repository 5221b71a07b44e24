"""The registered queries against their SQL, and their columns."""

import pytest
from compare import connect, spark_rows, sql_rows
from conftest import SMALL

from usageledger.llm import oracles, queries

COLUMNS = {
    1: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    2: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    3: ["doc_id", "n_shingles", "component_id", "kept"],
    4: ["doc_id", "perplexity", "kept"],
    5: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    6: ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    7: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    8: ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    9: ["query_id", "rank", "vec_id", "score"],
    10: ["page_id", "url", "text", "n_chars"],
    11: ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    12: ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    13: ["doc_id", "n_words", "n_removed", "kept_sha256"],
}


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_sql(spark, name):
    assert spark_rows(queries.REGISTRY[name](spark, SMALL)) == sql_rows(connect(SMALL), oracles.SQL[name])


def test_one_query_per_operator_with_its_columns(spark):
    numbered = {int(name[2:].split("_")[0]): f for name, f in queries.REGISTRY.items()}
    assert sorted(numbered) == list(range(1, 14))
    for n, f in numbered.items():
        frame = f(spark, SMALL)
        assert set(COLUMNS[n]) <= set(frame.columns)
        assert frame.columns == list(dict.fromkeys(frame.columns))
