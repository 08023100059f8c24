"""Source mixing against a plain version over sorted documents."""

import hashlib
import re

from tastespark.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, h string"


def plain(rows, weights=(5, 2, 1), cap=3):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for i, r in enumerate(rows)}
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[i] for i, r in enumerate(rows) if r[2] == s) for s in sources}
    w = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, capped = dict.fromkeys(sources, 0.0), set()
    while True:
        rest = sum(total.values()) - cap * sum(total[s] for s in capped)
        free = [s for s in sources if s not in capped]
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * total[s]}
        if not over:
            break
        capped |= over
    for s in sources:
        target[s] = cap * total[s] if s in capped else share[s]
    return size, total, target


def check(make, rows):
    got = mixing.mix(make(rows, SCHEMA)).collect()
    size, total, target = plain(rows)
    assert len(got) == len(rows)
    want = sorted((str(r[0]), str(r[2]), size[i], total[r[2]]) for i, r in enumerate(rows))
    assert sorted((str(g.doc_id), str(g.source), g.size, g.source_size) for g in got) == want
    taken = {}
    for g in got:
        assert abs(g.target - target[g.source]) < 1e-6
        assert 0 <= g.taken <= 3 * g.size and (g.size == 0 or g.taken % g.size == 0)
        taken[g.source] = taken.get(g.source, 0) + g.taken
    return taken, target, got


def test_targets_and_taken(make):
    rows = [(i, "w " * (1 + int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 9), f"s{i % 4}" if i % 3 else "s0", "x", "y") for i in range(400)]
    taken, target, got = check(make, rows)
    for s in target:
        assert abs(taken[s] - target[s]) <= 9
    again = mixing.mix(make(rows[::-1], SCHEMA)).collect()
    assert sorted((g.doc_id, g.taken) for g in got) == sorted((g.doc_id, g.taken) for g in again)


def test_cap_reshares_and_null_source(make):
    rows = [(1, "a b", "a", None, None)] + [(i, "w " * 10, None, None, None) for i in range(2, 60)] + [(70, None, "b", None, None), (71, "", "b", None, None)]
    taken, target, _ = check(make, rows)
    assert target["a"] == 6 and taken["a"] == 6 and target["b"] == 0


def test_empty_documents_of_a_source_at_its_cap(make):
    """Nothing is left to take beyond three copies: no document is taken a fourth time."""
    rows = [(i, "a b" if i % 2 else "", "a", None, None) for i in range(40)] + [(i, "w " * 50, "b", None, None) for i in range(50, 90)]
    got = [g for g in mixing.mix(make(rows, SCHEMA)).collect() if g.source == "a"]
    assert {g.repeats for g in got} == {3} and got[0].target == 120
    assert mixing.mixed_rows(make(rows, SCHEMA)).filter("source = 'a'").count() == 120


def test_nested_budgets(make):
    """A smaller budget takes a subset: hashes decide, not order."""
    rows = [(i, "w " * 3, "a" if i % 2 else "b", None, None) for i in range(200)]
    small = {g.doc_id for g in mixing.mix(make(rows, SCHEMA), weights=(1, 9)).collect() if g.taken and g.source == "a"}
    large = {g.doc_id for g in mixing.mix(make(rows, SCHEMA), weights=(2, 8)).collect() if g.taken and g.source == "a"}
    assert small and small < large


def test_rows_repeat_and_keep_columns(make):
    rows = [(i, "w " * 5, "a" if i < 5 else "b", "t", "h") for i in range(50)]
    out = mixing.mixed_rows(make(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "source", "target", "h"]
    per = {g.doc_id: g.repeats for g in mixing.mix(make(rows, SCHEMA)).collect()}
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in per.items() if v}


def test_empty_and_repeated(make):
    assert mixing.mix(make([], SCHEMA)).count() == 0
    assert mixing.mixed_rows(make([], SCHEMA)).count() == 0
    rows = [(None, "a b c", "a", None, None)] * 3 + [(1, "a b c", "b", None, None)]
    assert len(check(make, rows)[2]) == 4
