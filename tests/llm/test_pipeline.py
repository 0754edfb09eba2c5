import pytest

import corpus_pipeline
from newslens.llm import jaccard, language, lines, mixing
from newslens.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, written(stage(spark, docs, SF), "stage")))
        docs = out[-1][2]
    return out


def test_order_and_columns(stages):
    assert [n for n, _, _ in stages] == [
        "language ID", "line dedup", "n-gram Jaccard join", "mixing to target weights", "packing",
    ]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_does_what_its_operator_says(spark, stages):
    (_, raw, known), (_, _, cut), (_, _, single), (_, _, chosen), (_, _, packed) = stages
    found = language.identify(raw, language.learn(raw)).filter("accepted AND lang_pred != 'und'")
    assert ids(known) == ids(found)
    want = {r.doc_id: r.text for r in lines.line_dedup(known).collect()}
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert ids(single) == ids(jaccard.near_duplicates(cut).filter("kept"))
    weights = (corpus_pipeline.MIX_LEVELS, corpus_pipeline.MIX_WEIGHTS)
    assert ids(chosen) == ids(mixing.mix(single, *weights))
    assert ids(packed) == ids(chosen)


def test_run_is_the_stages(spark, stages):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages[-1][2])


def test_odd_documents(spark, tmp_path):
    good = "The committee met on Tuesday and agreed to publish the report before the end of the month"
    rows = [(1, None, "en", "src1", None, "x"), (2, "", "en", "src1", 0, "x"), (3, "12 34", None, None, 5, "x")]
    rows += [(10 + i, f"{good} number {i} " * 3, "en" if i % 3 else None, f"src{i % 3}", 9, "x") for i in range(20)]
    rows += [(10, rows[3][1], "en", "src1", 9, "x"), (None, good, "en", "src2", 9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.columns[0] == "doc_id"
    assert docs.count() == 0
