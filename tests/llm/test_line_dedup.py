import random

from llm_helpers import EDGES

from adlens.llm.line_dedup import line_dedup


def brute(rows):
    """Unique ids only: {doc_id: text}."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        lines, gone = (text or "").split("\n"), set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if not "".join(w).strip(" \t\r\x0b\x0c"):
                continue
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = None if text is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return out


def test_equals_one_pass_over_sorted_documents(spark, docs):
    rng = random.Random(3)
    lines = [f"line {i}" for i in range(9)] + ["", " "]
    rows = list(enumerate(EDGES)) + [(100 + i, "\n".join(rng.choices(lines, k=rng.randrange(0, 14)))) for i in range(120)]
    rows += [(None, "\n".join(lines[:6]))]
    rng.shuffle(rows)
    out = line_dedup(docs(rows))
    assert out.columns[:8] == docs([]).columns
    assert {r.doc_id: r.text for r in out.collect()} == brute(rows)


def test_repeated_rows_and_counts(spark, docs):
    out = line_dedup(docs([(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (3, "a\nb"), (4, None)])).collect()
    got = sorted((r.doc_id, r.text or "", r.n_lines, r.n_removed) for r in out)
    assert got == [(1, "", 4, 4), (1, "a\nb\nc\nd", 4, 0), (2, "x", 4, 3), (3, "a\nb", 2, 0), (4, "", 0, 0)]


def test_empty_table(spark, docs):
    assert line_dedup(docs([])).collect() == []


def test_long_passages_of_one_or_two_lines_go(spark, docs):
    long, half = " ".join(f"w{i}" for i in range(51)), " ".join(f"v{i}" for i in range(26))
    rows = [(1, long), (2, long), (3, f"a\n{long}\nb"), (4, f"c\n{half}\n{half} x\nd"), (5, f"{half}\n{half} x"),
            (6, f"e\n{half}"), (7, " ".join(long.split()[:50])), (8, " ".join(long.split()[:50])), (9, None), (10, "")]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup(docs(rows), passage=50).collect()}
    want = dict(rows) | {2: "", 3: "a\nb", 5: ""}
    assert got == {i: (t, {2: 1, 3: 1, 5: 2}.get(i, 0)) for i, t in want.items()}
