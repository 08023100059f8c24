"""Decontamination against every window compared with every window; automaton, shards and removal."""

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF001

from tastespark.io import table
from tastespark.llm import decontaminate as d
from tastespark.llm.queries import op13_decontaminate

UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(text, items, window=10):
    """(words, positions hit, ids of items found) by comparing all windows."""
    words, hit, found = words_of(text), set(), set()
    for item, content in items:
        w = words_of(content)
        m = min(window, len(w))
        keys = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i:i + m]) in keys:
                hit.update(range(i, i + m))
                found.add(item)
    return words, hit, {str(i) for i in found if i is not None}


def random_case(rnd, window):
    vocabulary = [f"w{i}" for i in range(rnd.choice([2, 3, 30]))]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(rnd.choice([None, *range(6)]), text(rnd.randint(0, 3 * window))) for _ in range(rnd.randint(1, 12))]
    items += [(90, items[0][1]), (91, "W0, w1! " * rnd.randint(1, 9)), (92, "é Ünï " * rnd.randint(1, 8)), (93, None), (94, " .,")]
    docs = [text(rnd.randint(0, 60)) + " x " + rnd.choice(items)[1].__str__() + rnd.choice([" ", "-y-"]) + text(5) for _ in range(20)]
    return items, [*docs, None, "", "w1", " ".join(f"w{i % 3}" for i in range(500))]


@pytest.mark.parametrize("seed,window,shard", [(1, 10, 1 << 18), (2, 4, 1 << 18), (3, 3, 24), (4, 10, 64), (5, 2, 16)])
def test_scan_against_all_windows(spark, make, seed, window, shard):
    items, docs = random_case(random.Random(seed), window)
    bench = make(items, "item_id int, text string")
    rows = make([(i, t, "clash", 7) for i, t in enumerate(docs)], "doc_id long, text string, spans string, _n int")
    got = {r.doc_id: r for r in d.scan(rows, bench, window=window, shard_words=shard).collect()}
    assert len(got) == len(docs)
    for i, t in enumerate(docs):
        words, hit, found = plain(t, items, window)
        r = got[i]
        assert r.n_words == len(words) and r.n_hit == len(hit) and r.item_ids == sorted(found), (i, t)
        assert {x for s in r.spans for x in range(s.start, s.end)} == hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_automaton_has_every_substring_and_no_other():
    rnd = random.Random(9)
    for _ in range(40):
        seqs = [np.array([rnd.randint(0, 2) for _ in range(rnd.randint(1, 14))], dtype=np.uint64) for _ in range(5)]
        a = d.Automaton(seqs, [[str(i)] for i in range(5)], window=4)
        known = {tuple(s[i:j].tolist()) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        assert sum(a.length[v] - a.length[a.link[v]] for v in range(1, len(a.link))) == len(known)
        assert len(a.link) <= 2 * sum(map(len, seqs))


def test_more_than_one_pass(spark, make, monkeypatch):
    monkeypatch.setattr(d, "PASS_SHARDS", 1)
    items, docs = random_case(random.Random(11), 4)
    bench, rows = make(items, "item_id int, text string"), make([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in d.scan(rows, bench, window=4, shard_words=48).collect()}
    assert got == {i: (len(h), sorted(f)) for i, t in enumerate(docs) for _, h, f in [plain(t, items, 4)]}


def test_remove_spans(make):
    bench = make([(1, "one two three four five six seven eight nine ten eleven"), (2, "tiny item")], "item_id int, text string")
    long = "Keep (ONE two, three four five six seven eight nine ten) and also this text with many other words so that it stays here"
    rows = [(1, long, 5), (2, "one two three four five six seven eight nine ten", 6), (3, None, 7), (None, "a tiny item is a short span", 8)]
    docs = make(rows, "doc_id long, text string, _text int")
    got = {r.doc_id: r for r in d.remove_spans(docs, bench, min_span=10).collect()}
    assert set(got) == {1, 3, None} and got[1]._text == 5 and got[3].text is None
    assert got[1].text == "Keep () and also this text with many other words so that it stays here"
    assert got[None].text == rows[3][1]
    assert {r.text for r in d.remove_spans(docs, bench, min_span=2, max_coverage=1.0).collect()} == {
        got[1].text, "", None, "a  is a short span"}


def test_empty_tables(make):
    docs, bench = make([(1, "some words")], "doc_id long, text string"), make([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.item_ids) for r in d.scan(docs, bench).collect()] == [(2, 0, [])]
    assert d.scan(make([], "doc_id long, text string"), make([(1, "x")], "item_id long, text string")).collect() == []
    assert d.remove_spans(docs, bench).collect() == docs.collect()


def test_registered_query(spark):
    items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    docs = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op13_decontaminate(spark, SF001).collect()}
    want = {}
    for i, t in docs.items():
        words, hit, found = plain(t, items)
        want[i] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    assert got == want
