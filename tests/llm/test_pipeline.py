"""The pipeline's stages, each against a plain reading of what it decides."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linepulse.llm import decontam, pii, quality, simhash

FOLDER = "/root/testdata/sf0.001"
COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that go into each stage and what comes out last."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(900001, None, None, None, None), (900002, "", "en", "s", 0)], docs.schema)
    docs = docs.union(extra).union(docs.where("doc_id < 3"))
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], FOLDER).write.parquet(str(base / str(k)))
        seen.append(spark.read.parquet(str(base / str(k))))
    return seen


def ids(df):
    return collections.Counter(r[0] for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:5]:
        assert df.columns == COLUMNS


def test_quality_stage(stages):
    kept = quality.judge(stages[0]).where("kept")
    assert ids(stages[1]) == ids(kept)
    assert 0 < stages[1].count() < stages[0].count()
    assert not {900001, 900002} & set(ids(stages[1]))


def test_one_of_each_group_stays(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[1].collect()}
    prints = {k: simhash.fingerprint(t) for k, t in texts.items()}
    group = {k: k for k in prints}

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    assert ids(stages[2]) == collections.Counter({k: 1 for k in group if top(k) == k})


def test_contaminated_go(spark, stages):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    windows = {w for r in items for w in decontam.windows_of(r["text"] or "", 10)}
    sizes = {len(w) for w in windows}
    want = collections.Counter()
    for r in stages[2].collect():
        words = decontam.words_of(r["text"])
        if not any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1)):
            want[r["doc_id"]] += 1
    assert ids(stages[3]) == want


def test_personal_data_is_masked(stages):
    assert ids(stages[4]) == ids(stages[3])
    base = F.filter("_spans", lambda s: s["base"])
    assert stages[4].withColumn("n", F.lit(0)).transform(pii.spans).where(F.size(base) > 0).count() == 0
    before = {r["doc_id"]: r for r in stages[3].collect()}
    for r in stages[4].collect():
        if r["text"] != before[r["doc_id"]]["text"]:
            assert "<" in r["text"] and r["n_chars"] == len(r["text"])
        else:
            assert r["n_chars"] == before[r["doc_id"]]["n_chars"]


def test_all_are_packed(stages):
    assert set(ids(stages[5])) == set(ids(stages[4]))


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_empty(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
