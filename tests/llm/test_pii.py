"""Personal data: rules against plain regular expressions, the model on held-out altered spans."""

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from tastespark.llm import pii

# fixed values: the rules as stated
RULES = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
         r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            d = re.sub("[^0-9]", "", m[0])
            good = [True, k == 1 and all(int(p) <= 255 for p in m[0].split(".")), 12 <= len(d) <= 19 and pii.luhn(d), 9 <= len(d) <= 15][k]
            out += [(m.start(), k, m.end())] * good
    return [(pii.KINDS[k], s, e) for s, k, e in sorted(out)]


def test_rules_on_random_texts():
    rnd = random.Random(2)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab.@.-+ 1204(5)59é%_\n") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 20_000):
        pii.base_spans(text)
        pii.islands(text)


def phone(rnd):
    return f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"


def card(rnd):
    d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if pii.luhn(d + c))


def parts(seed, n):
    rnd = random.Random(seed)
    make = [phone, card, lambda r: f"{r.choice('abc')}x.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com", lambda r: ".".join(str(r.randint(1, 255)) for _ in range(4)),
            lambda r: "".join(r.choice("0123456789abcdef") for _ in range(32)), lambda r: str(r.randint(0, 10 ** r.randint(1, 18))),
            lambda r: f"{r.randint(300, 999)}.{r.randint(1, 999)}.1.1", lambda r: f"{r.randint(1900, 2030)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}", lambda r: f"v{r.randint(1, 9)}.{r.randint(1, 9)}"]
    return [rnd.choice(make)(rnd) for _ in range(n)]


def test_model_on_held_out_copies():
    model = pii.SemiMarkov(pii.train(parts(1, 600)))
    rng = np.random.default_rng(3)
    hit = wrong = missed = 0
    for p in parts(2, 400):
        for text, gold in ((p, pii.base_spans(p)), pii.altered(p, pii.base_spans(p), rng)):
            got = {(pii.KINDS[k], s, e) for k, s, e in model.decode(pii.Island(text, 0, len(text)))}
            hit, wrong, missed = hit + len(got & set(gold)), wrong + len(got - set(gold)), missed + len(set(gold) - got)
    assert hit / (hit + wrong) > 0.95 and hit / (hit + missed) > 0.85, (hit, wrong, missed)


def test_forward_backward_is_exact():
    """Likelihood and gradient against the sum over all segmentations of a small island."""
    isl = pii.Island("a1@b.cd 12", 0, 10)
    rng = np.random.default_rng(1)
    model = pii.SemiMarkov(rng.normal(size=(4, pii.N_FEATURES)) * 0.3)
    s = isl.f @ model.w.T

    def all_from(i):
        if i == isl.n:
            yield ()
            return
        yield from all_from(i + 1)
        for x, (a, b) in enumerate(isl.segments):
            if a == i:
                for rest in all_from(b):
                    for k in range(4):
                        yield ((x, k), *rest)

    every = list(all_from(0))
    score = np.array([sum(s[x, k] for x, k in seg) for seg in every])
    gold = dict(every[-1])
    value, g = model.gradient(isl, gold)
    assert value == pytest.approx(score[-1] - np.logaddexp.reduce(score))
    p = np.exp(score - np.logaddexp.reduce(score))
    want = np.zeros_like(g)
    for seg, w in zip(every, p):
        for x, k in seg:
            want[k] -= w * isl.f[x]
    for x, k in gold.items():
        want[k] += isl.f[x]
    assert np.allclose(g, want)


def test_decode_is_the_best_segmentation():
    isl = pii.Island("x1@b.cd +1 (202) 555-0123", 0, 25)
    model = pii.SemiMarkov(np.random.default_rng(5).normal(size=(4, pii.N_FEATURES)))
    top = (isl.f @ model.w.T - pii.MARGIN).max(axis=1)
    best = [0.0] * (isl.n + 1)
    for j in range(1, isl.n + 1):
        best[j] = max([best[j - 1], *[best[a] + top[x] for x, (a, b) in enumerate(isl.segments) if b == j]])
    where = {isl.span(x): top[n] for n, x in enumerate(isl.segments)}
    assert sum(where[s, e] for _, s, e in model.decode(isl)) == pytest.approx(best[-1])


def test_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    found = pii.find_spans(docs).select("doc_id", "spans", F.sha2(pii.span_text(pii.strict(F.col("spans"))).cast("binary"), 256).alias("sha")).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(found) == len(texts)
    for r in found:
        want = plain(texts[r.doc_id])
        assert [(x.kind, x.start, x.end) for x in r.spans if x.strict] == want
        assert r.sha == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        for x in r.spans:
            assert x.strict or not any(x.start < e and s < x.end for _, s, e in want)


def test_joined_numbers_are_taken_apart(make):
    rnd = random.Random(6)
    rows = [(i, p, "s", None) for i, p in enumerate(parts(1, 600))]
    both = f"call {phone(rnd)} {card(rnd)} now"
    rows += [(9000, both, "s", None), (9001, None, "s", None), (9002, "", "s", None), (9003, "no numbers here", "s", None)]
    df = pii.find_spans(make(rows, "doc_id long, text string, kind string, start int"))
    got = {r.doc_id: [(x.kind, x.start, x.end, x.strict) for x in r.spans] for r in df.filter("doc_id >= 9000").collect()}
    assert got[9000] == [("phone", 5, 22, False), ("card", 23, 39, False)]
    assert got[9001] == got[9002] == got[9003] == []
    red = {r.doc_id: r.red for r in df.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("red")).filter("doc_id >= 9000").collect()}
    assert red[9000] == "call [phone] [card] now" and red[9001] is None and red[9003] == "no numbers here"
    assert pii.find_spans(make([], "doc_id long, text string")).count() == 0
