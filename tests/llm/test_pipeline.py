import random

import pytest
import test_line_dedup
import test_ngram_join
from llm_helpers import EDGES, prose

import corpus_pipeline as cp
from adlens.llm.common import materialize
from adlens.llm.quality import quality_scores

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, n_lines int"


def corpus():
    rng = random.Random(21)
    notice = "all rights are kept by us\nand may not be given\nto anyone else at all"
    texts = []
    for i in range(150):
        text = "\n".join(prose(rng, 12) for _ in range(rng.randrange(1, 7)))
        texts += [text] * (2 if i % 10 == 0 else 1)
        if i % 9 == 0:
            texts.append(text.replace("a", "a", 1) + " indeed")
        if i % 5 == 0:
            texts.append(prose(rng, 9) + "\n" + notice + "\n" + prose(rng, 20))
        if i % 4 == 0:
            texts.append(" | ".join("$$$ " + "".join(rng.choices("xyzw#%", k=6)) for _ in range(60)))
    texts += [t for t in EDGES if t is None or len(t) < 1000]
    rows = [(i, t, "en", rng.choice(["a", "b", "c", None]), len(t or ""), 0.1, 3, 4) for i, t in enumerate(texts)]
    return rows, [(i, 0 if "$$$" in (t or "") else 1, 0) for i, t in enumerate(texts) if i % 2]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    rows, labels = corpus()
    base = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    frames = [spark.read.parquet(f"{base}/documents.parquet")]
    for name, stage in cp.STAGES:
        frames.append(materialize(stage(spark, frames[-1], base), name))
    return base, frames


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_and_columns(run):
    _, frames = run
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]
    for df in frames[1:-1]:
        assert df.dtypes == frames[0].dtypes


def test_rejected_documents_go(spark, run):
    base, frames = run
    scored = quality_scores(frames[0], spark.read.parquet(f"{base}/labels.parquet"))
    assert sorted(r.doc_id for r in scored.where("predicted = 1").collect()) == sorted(i for i, _ in texts(frames[1]))
    kept = dict(texts(frames[1]))
    assert not any("$$$" in (t or "") for t in kept.values())
    assert len(kept) >= 0.97 * sum("$$$" not in (t or "") for _, t in texts(frames[0]))


def test_repeated_passages_go(run):
    _, frames = run
    want = test_line_dedup.brute(texts(frames[1]))
    before = dict(texts(frames[1]))
    got = dict(texts(frames[2]))
    assert got == {i: t for i, t in want.items() if t == before[i] or t}
    assert all(r.n_chars == len(r.text or "") for r in frames[2].collect())


def test_one_of_each_group_stays(run):
    _, frames = run
    groups = test_ngram_join.brute(texts(frames[2]))
    assert sorted(i for i, _ in texts(frames[3])) == sorted({c for _, _, c in groups})


def test_mix_meets_its_targets(run):
    _, frames = run
    size, taken = {}, {}
    for r in frames[3].collect():
        size[r.source] = size.get(r.source, 0) + len((r.text or "").split())
    for r in frames[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len((r.text or "").split())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 0.01 * sum(size.values())
    assert set(texts(frames[4])) <= set(texts(frames[3]))


def test_all_words_of_the_mix_are_packed(run):
    _, frames = run
    assert sum(r.length for r in frames[5].collect()) == sum(len((t or "").split()) for _, t in texts(frames[4]))


def test_run_gives_the_last_stage(spark, run):
    base, frames = run
    key = lambda r: (r.doc_id, r.part, r.start, r.length)
    assert sorted(map(key, cp.run(spark, base).collect())) == sorted(map(key, frames[5].collect()))


def test_equal_rows_count_once_and_empty_tables_pass(spark, tmp_path):
    empty = spark.createDataFrame([], COLUMNS)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
    twice = spark.createDataFrame([(1, "same text of five words", "en", "s", 23, 0.1, 1, 1)] * 2, COLUMNS)
    assert cp.STAGES[2][1](spark, twice, str(tmp_path)).count() == 1
