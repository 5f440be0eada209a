"""The pipeline's stages against plain Python, each on its own input."""

import pytest

import corpus_pipeline
from tessera.llm import quality
from tessera.llm._common import read_table, stored
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_near_dup import brute as components
from tests.llm.test_tokens import BYTE, _crc, _expected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """[(name, input, output)]"""
    docs, out = read_table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF), name)
        out.append((name, docs, result))
        docs = result
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns_and_names(stages, spark):
    want = read_table(spark, SF, "documents").dtypes
    assert [s[0] for s in stages] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "pack"]
    assert all(s[2].dtypes == want for s in stages[:-1])


def test_quality(stages):
    _, before, after = stages[0]
    verdicts = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(before).collect()}
    assert ids(after) == {d for d, kept in verdicts.items() if kept} != ids(before)


def test_near_duplicates(stages):
    _, before, after = stages[1]
    groups = components([(r["doc_id"], r["text"]) for r in before.collect()], 5)
    assert ids(after) == {d for d, (_, c) in groups.items() if d == c} != ids(before)


def test_decontamination(stages, spark):
    _, before, after = stages[2]
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").collect()]
    report = contaminated([(r["doc_id"], r["text"]) for r in before.collect()], items)
    assert ids(after) == {r[0] for r in report if not r[5]} != ids(before)


def test_secrets(stages):
    _, before, after = stages[3]
    old, new = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (before, after))
    assert old.keys() == new.keys()
    changed = {d for d in old if old[d] != new[d]}
    assert changed and all("<secret>" in new[d] for d in changed)


def test_packing(stages, spark):
    _, before, after = stages[4]
    want = _expected(before.collect(), BYTE)
    total = 0
    for r in after.collect():
        assert r["ids_crc32"] == _crc(want[r["doc_id"]][r["start"]:r["start"] + r["length"]])
        total += r["length"]
    assert total == sum(map(len, want.values()))
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect())) == sorted(map(tuple, after.select(key).collect()))


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
