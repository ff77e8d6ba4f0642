import random
import zlib

import pytest
from llm_helpers import EDGES, prose

from adlens.llm.quality import fit, held_out, quality_scores, with_quality


def corpus(seed=13, n=600):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        rows.append((i, prose(rng, rng.randrange(5, 300)) if good else " | ".join(
            "$$$ " + "".join(rng.choices("xyzw#%", k=6)) for _ in range(rng.randrange(5, 200)))))
        labels.append((i, int(good), 0))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_rows(spark, docs):
    rows, labels = corpus()
    rows += [(10_000 + i, t) for i, t in enumerate(EDGES)] + [(None, "no id"), (1, rows[1][1])]
    out = quality_scores(docs(rows), frame(spark, labels)).collect()
    assert len(out) == len(rows)
    want = {i: y for i, y, _ in labels}
    unseen = [r for r in out if r.held_out and r.doc_id in want]
    assert sum(r.predicted == want[r.doc_id] for r in unseen) / len(unseen) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    scores = {r.score for r in out if r.doc_id in (10_000, 10_001)}
    assert len(scores) == 1  # null as empty


def test_held_out_labels_change_nothing(spark, docs):
    rows, labels = corpus(14, 240)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, t) for i, y, t in labels]
    a, b = (sorted((r.doc_id, r.score) for r in quality_scores(docs(rows), frame(spark, x)).collect()) for x in (labels, turned))
    assert a == b


def test_rerun_and_partitioning_agree(spark, docs):
    rows, labels = corpus(15, 200)
    a = fit(docs(rows), frame(spark, labels))
    b = fit(docs(rows[::-1]).repartition(7), frame(spark, labels[::-1] + labels[:20]))
    assert (a.good, a.bad) == (b.good, b.bad) and a.weights == pytest.approx(b.weights)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, 0), (2, 0, 1), (2, 1, 1), (None, 0, 0), (777, 0, 0)]])
def test_without_two_classes_every_score_is_half(spark, docs, labels):
    out = quality_scores(docs([(1, "a"), (2, None)]), frame(spark, labels)).collect()
    assert [r.score for r in out] == [0.5, 0.5] and {r.predicted for r in out} == {1}


def test_very_few_rows_and_clashing_names(spark, docs):
    rows = [(i, ("good words here " if i % 2 else "$$ %% ## ") * 3) for i in range(12)]
    model = fit(docs(rows), frame(spark, [(i, i % 2, 0) for i in range(12)]))
    out = with_quality(docs(rows), model)
    assert out.columns == [*docs([]).columns, "score"] and out.count() == 12
    assert quality_scores(docs([]), frame(spark, [])).collect() == []
    assert docs([(3, "x")]).select(held_out("doc_id")).first()[0] == (zlib.crc32(b"3") % 3 == 1)
