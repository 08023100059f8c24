"""Line dedup against a plain version."""

import random

from tastespark.llm import lines

SCHEMA = "doc_id long, text string, n_lines string, removed string"


def plain(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, gone = {}, {i: set() for i in range(len(rows))}
    for i in order:
        full = [(p, x.strip(" \t\r\x0b\x0c")) for p, x in enumerate((rows[i][1] or "").split("\n"))]
        full = [x for x in full if x[1]]
        for a in range(len(full) - 2):
            key = tuple(x[1] for x in full[a:a + 3])
            at = (rows[i][0], rows[i][1], full[a][0])
            if seen.setdefault(key, at) != at:
                gone[i] |= {x[0] for x in full[a:a + 3]}
    return [(r[0], None if r[1] is None else "\n".join(x for p, x in enumerate(r[1].split("\n")) if p not in gone[i]), len(gone[i]))
            for i, r in enumerate(rows)]


def test_against_plain(make):
    rnd = random.Random(1)
    rows = [(i, "\n".join(rnd.choice(["a", "b", " b\t", "c", "", "  "]) for _ in range(rnd.randint(0, 9))), "x", "y") for i in range(80)]
    out = lines.dedup_lines(make(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "removed", "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.n_removed) for r in out.collect()) == sorted(plain(rows))


def test_edges(make):
    rows = [(2, "a\nb\nc", None, None), (1, "x\na\nb\nc\ny", None, None), (3, None, None, None), (4, "", None, None), (5, "a\nb", None, None),
            (6, "p\np\np\np", None, None), (7, "long\n" * 5000 + "a\nb\nc", None, None), (None, "q\nr\ns", None, None), (8, "q\nr\ns", None, None)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(make(rows, SCHEMA)).collect()}
    assert got[1] == "x\na\nb\nc\ny" and got[2] == "" and got[3] is None and got[4] == "" and got[5] == "a\nb"
    assert got[6] == "p" and got[7] == "long" and got[8] == "q\nr\ns" and got[None] == ""


def test_repeated_rows_and_empty(make):
    rows = [(1, "a\nb\nc\nd", None, None)] * 3
    assert [r.text for r in lines.dedup_lines(make(rows, SCHEMA)).collect()] == ["a\nb\nc\nd"] * 3
    assert lines.dedup_lines(make([], SCHEMA)).count() == 0


def test_no_text_is_lost(make):
    rnd = random.Random(2)
    rows = [(i, "\n".join(rnd.choice("abc") for _ in range(8)), None, None) for i in range(40)]
    left = {x for r in lines.dedup_lines(make(rows, SCHEMA)).collect() for x in r.text.split("\n")}
    assert {x for r in rows for x in r[1].split("\n")} <= left
