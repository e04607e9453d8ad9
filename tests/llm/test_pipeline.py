import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from marlstone.llm.secrets import find_spans

from .helpers import documents, edge_texts
from .test_jaccard_join import brute as components
from .test_packing import check as check_packing
from .test_suffix_dedup import brute_cleaned

SF = "/root/testdata/sf0.001"


def test_stage_by_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name.replace(" ", "_")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id: r for r in docs.collect()})
        assert all(r.n_chars == len(r.text) for r in kept[name][1].values())

    before, after = kept["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(after) > 0.9 * sum(labels.get(d, 0) == 0 for d in before)
    assert all(after[d] == before[d] for d in after)

    before, after = kept["n-gram Jaccard join"]
    want = components([(d, r.text) for d, r in before.items()])
    assert set(after) == {d for d, n, c in want if d == c}

    before, after = kept["suffix-array dedup"]
    assert sorted(((d, r.text) for d, r in after.items()), key=repr) == brute_cleaned([(d, r.text) for d, r in before.items()])

    before, after = kept["secret scans"]
    assert set(before) == set(after)
    assert all((after[d].text == r.text) == (not find_spans(r.text)[1]) for d, r in before.items())

    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packing([(d, r.text) for d, r in after.items()], out)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in {r.doc_id: r for r in out}.values())


NAMES = ["key", "raw", "spans", "score", "features", "toxic", "node", "component_id", "id", "count", "k", "hash", "length", "part", "ids", "Blank name"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_bears_names_nulls_and_no_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    df = documents(spark, [(d, t) for d, t in edge_texts() if len(t or "") < 1000])
    wide = df.select(*[F.lit(n).alias(n) for n in NAMES], "*")
    out = stage(spark, wide, SF)
    rows = out.collect()
    none = stage(spark, wide.limit(0), SF)
    assert none.columns == out.columns and none.collect() == []
    if last:
        assert {r.doc_id for r in rows} == {r.doc_id for r in wide.collect()}
        return
    assert out.columns == wide.columns
    given = wide.collect()
    assert all(r in given for r in rows)
    ids = {r.doc_id for r in rows}
    assert {1, 2, 3, 7, 8, None} <= ids
    assert sum(r.text is None for r in rows) == 2


def test_scratch_goes_when_a_stage_fails(spark, monkeypatch):
    from marlstone.llm.common import checkpoint_dir

    def broken(spark, docs, sf_dir):
        raise RuntimeError("broken")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("secret scans", corpus_pipeline.without_secrets), ("broken", broken), corpus_pipeline.STAGES[-1]])
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    held = lambda: {s.getPath().getName() for s in fs.listStatus(path) if "scratch" in s.getPath().getName()}
    before = held()
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, SF)
    assert held() == before
