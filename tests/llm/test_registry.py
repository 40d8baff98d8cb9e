"""The registered training-data queries and the entry file."""

import re

import __spark_entry__ as entry
from voxsift.llm import registry


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.queries())
    assert numbers == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(registry.queries()) <= set(entry.queries())


def test_pipeline_is_registered():
    import corpus_pipeline
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii", "sentencepiece"]
