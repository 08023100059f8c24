"""Quality: held-out accuracy, shrinkage, edges."""

import random

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from tastespark.llm import quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long, p double, posterior double"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    """Labels of odd documents train, those of even ones test."""
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    out = quality.judge(docs, labels.filter("doc_id % 2 = 1"))
    n = {(r.quality, r.keep): r["count"] for r in out.join(labels.filter("doc_id % 2 = 0"), "doc_id").groupBy("quality", "keep").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.97
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.9


def corpus():
    rnd = random.Random(1)
    good = lambda: " ".join(rnd.choice(["the", "of", "river", "stone", "walks", "under", "bright"]) for _ in range(40))
    bad = lambda: " ".join([rnd.choice(["BUY!!", "NOW!!"])] * 40)
    docs, labels = [], []
    for i in range(300):
        b = i % 5 == 0 or (i % 3 == 0 and i < 150)
        docs.append((i, bad() if b else good(), "en", f"https://host{i % 3}.org/p{i % 2}/x", 1, 0.0, 0.0))
        labels.append((i, int(not b), 0))
    return docs, labels


def test_priors_shrink_and_decide(make):
    docs, labels = corpus()
    docs.append((900, "the river of stone walks", "en", "https://new.org/a", 1, 0.0, 0.0))
    out = {r.doc_id: r for r in quality.judge(make(docs, DOCS), make(labels, LABELS)).collect()}
    assert all(out[i].keep == bool(q) for i, q, _ in labels)
    assert out[1].prior > out[0].prior                       # host0 holds more bad documents than host1
    mean = sum(r.evidence for r in out.values()) / len(out)
    assert abs(out[900].prior - mean) < 0.15                 # a site of one document has nearly the global share


def recomputed(rows, keep_at=0.5):
    """Priors, posteriors and decisions from (host, path, evidence), by the formulas and with plain loops."""
    n, total = len(rows), sum(p for _, _, p in rows)
    share = min(max(total / n, 1e-6), 1 - 1e-6)

    def strength(groups):
        """groups: (size, sum, prior mean)"""
        size, k = sum(g[0] for g in groups), len(groups)
        if k < 2:
            return 100.0
        spread = sum(c * (s / c - m) ** 2 / max(m * (1 - m), 1e-9) for c, s, m in groups) - (k - 1)
        spread /= max(size - sum(c * c for c, _, _ in groups) / size, 1e-9)
        return min(max(1 / spread - 1, 1.0), 1e6) if spread > 0 else 1e6

    hosts, paths = {}, {}
    for h, p, e in rows:
        for table, key in ((hosts, h), (paths, (h, p))):
            c, s = table.get(key, (0, 0.0))
            table[key] = c + 1, s + e
    kh = strength([(c, s, share) for c, s in hosts.values()])
    kp = strength([(c, s, (hosts[h][1] + kh * share) / (hosts[h][0] + kh)) for (h, _), (c, s) in paths.items()])
    out = []
    for h, p, e in rows:
        (hn, hs), (pn, ps) = hosts[h], paths[h, p]
        host = (max(hs - e, 0.0) + kh * share) / (hn - 1 + kh)
        prior = min(max((max(ps - e, 0.0) + kp * host) / (pn - 1 + kp), 1e-6), 1 - 1e-6)
        odds = prior / (1 - prior) * (1 - share) / share
        posterior = e * odds / (e * odds + 1 - e)
        out.append((prior, posterior, posterior >= keep_at))
    return out


@pytest.mark.parametrize("given", ["small", "sf0.01"])
def test_posteriors_against_plain_loops(spark, make, given):
    if given == "small":
        docs, labels = corpus()
        docs += [(900, "the river of stone walks", "en", "https://new.org/a", 1, 0.0, 0.0), (None, "BUY!! " * 9, None, None, 1, 0.0, 0.0)]
        docs, labels = make(docs, DOCS), make(labels, LABELS)
    else:
        docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    scored = quality.fit(docs, labels)[0].select("doc_id", "host", "path", "p").collect()
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    for r, (prior, posterior, keep) in zip(scored, recomputed([(r.host, r.path, r.p) for r in scored])):
        mine = got[r.doc_id]
        assert abs(mine.evidence - r.p) < 1e-9 and abs(mine.prior - prior) < 1e-9 and abs(mine.posterior - posterior) < 1e-9
        assert mine.keep == keep or abs(posterior - 0.5) < 1e-9


def test_a_document_alone_on_its_host_has_the_global_share(spark, make):
    rows = [(f"h{i % 5}", "p", float(i % 2)) for i in range(40)] + [("alone", "p", 1.0), ("sure", "q", 0.0)]
    scored = make(rows, "host string, path string, p double")
    sites = quality.fit_sites(scored)
    out = {r.host: r.prior for r in quality.with_posterior(scored, sites).filter("host IN ('alone', 'sure')").collect()}
    assert abs(out["alone"] - sites.share) < 1e-12 and abs(out["sure"] - sites.share) < 1e-12


def test_stage_keeps_rows_and_columns(make):
    docs, labels = corpus()
    df = make(docs, DOCS)
    kept = quality.kept_rows(df, make(labels, LABELS))
    assert kept.columns == df.columns
    judged = quality.judge(df, make(labels, LABELS)).filter("keep")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.collect())


def test_edges(make):
    docs, labels = corpus()
    odd = [(None, "the river of stone", None, None, 1, 0.0, 0.0), (901, None, "en", "a", 1, 0.0, 0.0), (902, " \n", "en", None, 1, 0.0, 0.0), docs[1], docs[1]]
    out = quality.judge(make(docs + odd, DOCS), make(labels + [labels[1], (None, 1, 0), (901, None, None)], LABELS)).collect()
    assert len(out) == len(docs) + len(odd)
    assert {r.doc_id: r.keep for r in out if r.doc_id in (901, 902)} == {901: False, 902: False}
    assert all(r.posterior is not None for r in out)
    assert quality.judge(make([], DOCS), make(labels, LABELS)).count() == 0
    no_labels = quality.judge(make(docs + odd, DOCS), make([], LABELS)).filter(F.col("keep"))
    assert no_labels.count() == len(docs) + len(odd) - 2


@pytest.mark.parametrize("text", [None, "", "   ", "a", "A!! B!!", "x\n" * 10_000, "é" * 5000, "퟿ ok"])
def test_features_are_finite(text):
    f = quality.text_features(text)
    assert len(f) == len(quality.FEATURES) and all(abs(x) < 10 for x in f)
