import random

from llm_helpers import EDGES, prose

from adlens.llm.packing import bin_cost, best_fit, pack, segments


def one_by_one(lengths, sizes, top):
    """Best-fit decreasing item by item, opening sizes up to ``top``, shrunk at the end; its cost."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fits:
            min(fits, key=lambda b: b[0] - sum(b[1]))[1].append(n)
            continue
        least = min(s for s in sizes if s >= n)
        bins.append((min((s for s in sizes if s >= n and (s <= top or s == least)), key=lambda s: (bin_cost(s) / s, s)), [n]))
    return sum(bin_cost(min(s for s in sizes if s >= sum(held))) for _, held in bins)


def test_plan_on_counts_equals_packing_one_by_one():
    rng = random.Random(1)
    for _ in range(60):
        sizes = sorted(rng.sample(range(5, 60), rng.randrange(1, 4)))
        lengths = [rng.randrange(1, max(sizes) + 1) for _ in range(rng.randrange(1, 120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        plan = best_fit(counts, sizes)
        assert sum(bin_cost(s) * k for s, _, k in plan) == min(one_by_one(lengths, sizes, t) for t in sizes)
        held = {}
        for size, contents, bins in plan:
            assert 0 < sum(n * k for n, k in contents) <= size in sizes
            for n, k in contents:
                held[n] = held.get(n, 0) + k * bins
        assert held == counts
        ends = {}
        for n, low, high, *_ in segments(plan):
            assert low == ends.get(n, 0)
            ends[n] = high
        assert ends == counts


def test_every_word_has_one_place(spark, docs):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(100 + i, prose(rng, rng.randrange(1, 90))) for i in range(150)]
    rows += [(None, "no id"), (5, "same row"), (5, "same row")]
    out = pack(docs(rows), sizes=(16, 32, 64)).collect()
    words = {}
    for r in out:
        if r.length:
            words.setdefault(r.bin_id, []).append((r.bin_offset, r.length, r.bin_size))
    for places in words.values():
        end = 0
        for offset, length, size in sorted(places):
            assert offset == end
            end += length
        assert end <= size in (16, 32, 64) and all(s >= end or s < end for s in (16, 32, 64))
        assert size == min(s for s in (16, 32, 64) if s >= end)
    assert sum(r.length for r in out) == sum(len((t or "").split()) for _, t in rows)
    assert all(r.bin_id is None for r in out if not r.length)
    assert sorted(words) == list(range(len(words)))
    long = sorted((r.part, r.start, r.length) for r in out if r.doc_id == 8)
    assert long == [(i, 64 * i, min(64, 3000 - 64 * i)) for i in range(47)]


def test_empty_table(spark, docs):
    assert pack(docs([])).collect() == []
    assert pack(docs([(1, None), (2, " ")])).count() == 2
