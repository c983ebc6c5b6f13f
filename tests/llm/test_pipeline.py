import pytest

import corpus_pipeline
from usagelake.llm import pii, quality, simhash
from usagelake.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        given, path = docs, corpus_pipeline.staged
        docs = path(stage(spark, docs, SF), f"test-{n}")
        out.append((given, docs))
    return out


def test_columns(stages):
    for given, result in stages[:-1]:
        assert result.columns == given.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage_keeps_exactly_the_accepted(spark, stages):
    given, kept = stages[0]
    want = {r.doc_id for r in quality.op4(given, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.exceptAll(given).count() == 0


def test_simhash_stage_keeps_one_of_each_class(stages):
    given, kept = stages[1]
    classes = simhash.op7(given).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in classes})
    assert kept.exceptAll(given).count() == 0


def test_pii_stage_redacts_all_base_spans(stages):
    given, kept = stages[2]
    before = {r.doc_id: r for r in given.collect()}
    for r in kept.collect():
        assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
        if not pii._MARK.search(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text
    assert kept.count() == given.count()


def test_mixing_stage_takes_rows_of_the_input(stages):
    given, kept = stages[3]
    assert 0 < kept.count() <= given.count() and kept.exceptAll(given).count() == 0


def test_packing_stage_and_run(spark, stages):
    given, packed = stages[4]
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in given.collect()}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == packed.columns
    assert sorted(whole.select(columns).collect()) == sorted(packed.select(columns).collect())


def test_stages_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    for name, docs in (("odd", odd), ("empty", empty)):
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
