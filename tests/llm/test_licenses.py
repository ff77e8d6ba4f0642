import random

import pytest
from llm_helpers import EDGES, prose

from adlens.llm.licenses import TEMPLATES, license_matches, miss_probability


def test_every_template_is_found_wherever_it_stands(spark, docs):
    rng = random.Random(7)
    rows, n = [], 0
    for name, text in TEMPLATES:
        for before in range(0, 24, 3):
            rows.append((n, prose(rng, before) + " " + text.upper().replace(" ", "\n ") + " " + prose(rng, 30), name))
            n += 1
    out = {(r.doc_id, r.template): r.containment for r in license_matches(docs(rows)).collect()}
    assert all(out.get((i, name)) == 1.0 for i, _, name in rows)
    also = {"Apache-2.0-header": {"Apache-2.0"}, "MIT-text": {"MIT-grant"}}  # one opens the other
    assert all(t == rows[i][2] or t in also.get(rows[i][2], ()) for i, t in out)


def test_threshold_and_edges(spark, docs):
    grant = dict(TEMPLATES)["MIT-grant"]
    words = grant.split()
    cut = " ".join(words[:len(words) * 4 // 5])
    half = " ".join(words[:len(words) // 2])
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(50, cut), (51, half), (None, grant), (52, grant), (52, grant), (53, "the MIT License.")]
    out = license_matches(docs(rows)).collect()
    assert sorted((r.doc_id, round(r.containment, 1)) for r in out if r.doc_id) == [(50, 0.8), (52, 1.0), (52, 1.0)]
    assert sum(r.doc_id is None for r in out) == 1
    assert license_matches(docs([])).collect() == []


def test_own_templates_and_bound(spark, docs):
    own = spark.createDataFrame([("t", "alpha beta gamma delta epsilon zeta"), ("short", "too short")], "template string, text string")
    out = license_matches(docs([(1, "x alpha, beta gamma; delta EPSILON zeta y"), (2, "too short")]), own).collect()
    assert [(r.doc_id, r.template, r.containment, r.first_word) for r in out] == [(1, "t", 1.0, 1)]
    assert miss_probability(1) < 0.002 and miss_probability(2) < 4e-6
    none = spark.createDataFrame([], "template string, text string")
    assert license_matches(docs([(1, "a b c d e f")]), none).collect() == []


@pytest.mark.parametrize("times", [2000])
def test_very_many_hits_in_one_text(spark, docs, times):
    out = license_matches(docs([(1, "Released under the MIT License. " * times)])).collect()
    assert [(r.template, r.first_word) for r in out] == [("MIT", 0)]


def test_passes_over_many_templates(spark, docs, monkeypatch):
    """More shingles than one broadcast takes: further passes, the same rows."""
    from adlens.llm import licenses
    rng = random.Random(3)
    own = [(f"t{i}", prose(rng, 12)) for i in range(20)] + [(None, prose(rng, 9))]
    rows = [(i, prose(rng, 7) + " " + text + " " + prose(rng, 5)) for i, (_, text) in enumerate(own)]
    table = spark.createDataFrame(own, "template string, text string")
    once = license_matches(docs(rows), table).collect()
    monkeypatch.setattr(licenses, "MOST", 40)
    split = license_matches(docs(rows), table).collect()
    assert len(once) == 21 and sorted(map(str, once)) == sorted(map(str, split))


def test_a_quarter_of_any_template_may_be_gone(spark, docs):
    """Whatever shingles are lost, one of the kept bands retrieves the rest."""
    rng = random.Random(5)
    rows, want = [], set()
    for n, (name, text) in enumerate(TEMPLATES):
        words = text.split()
        for j in range(6):
            cut = list(words)
            if len(words) > 30:
                cut[rng.randrange(len(cut))] = "other"
                want.add((10 * n + j, name))
            rows.append((10 * n + j, " ".join(cut)))
    found = {(r.doc_id, r.template) for r in license_matches(docs(rows)).collect() if r.containment < 1}
    assert want <= found
