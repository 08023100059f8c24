"""Quality classification by hierarchical empirical Bayes.

Evidence of a document comes from a logistic regression over whole-text
features, trained here on labelled rows.  The prior of a document is its
site's share of good documents: shares are estimated for hosts and, inside a
host, for paths, by one grouped aggregation of the evidence over all documents,
and are shrunk, paths toward their host and hosts toward the global share, the
more the fewer documents a site has.  The strength of the shrinkage is itself
estimated from the spread between sites (method of moments for a beta-binomial).
The posterior replaces the global prior odds in the document's evidence by its
site's odds, leaving the document's own share out of its path's and its host's
count (a document alone on its host has the global share as prior); documents
with a posterior of at least ``keep_at`` stay.

A host is the source's host name (or the whole source where it is no URL), a
path its first path segment together with the language.

Scale: one pass over the texts for features, stored as a narrow table; sites are
aggregated with map-side partial sums, so a source with a third of all rows is
a few rows per task; site tables are joined by ordinary joins.  Only scalars
reach the driver.  The fit uses at most ``max_labels`` labelled rows, chosen by
hash; every other count covers all documents.

Defined results: null or blank text has evidence 0 and is rejected; a null
source or language is a site of its own; labels of a document that occur twice
count twice; labels without both classes give every other document the same
evidence (kept); rows are scored independently of repeats and of further
columns; an empty table gives no rows.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tastespark.llm.common import make_room, prepare, stored

FEATURES = ["log_words", "word_length", "upper", "digit", "mark", "repeat", "distinct", "line_repeat", "bare_mark", "mark_end"]
_UPPER = bytes(range(0x41, 0x5B))
_DIGIT = bytes(range(0x30, 0x3A))
_MARK = bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
_MARKS = set(_MARK.decode())


def text_features(text: str | None) -> tuple[float, ...]:
    """Shares, ratios and logarithms of one whole text, each between 0 and a few units."""
    if not text or not (words := text.split()):
        return (0.0,) * len(FEATURES)
    raw, n = text.encode("utf-8", "replace"), len(words)
    size = len(raw)

    def share(kind: bytes) -> float:
        return (size - len(raw.translate(None, kind))) / size

    lines = text.split("\n")
    tails = [w[-2:] for w in words]
    return (float(np.log1p(n)) / 10, float(np.log1p(len(text) / n)) / 5, share(_UPPER), share(_DIGIT), share(_MARK),
            sum(map(operator.eq, words, words[1:])) / n, len(set(words)) / n, 1 - len(set(lines)) / len(lines),
            sum(map(_MARKS.__contains__, words)) / n, sum([t[0] in _MARKS and t[-1] in _MARKS for t in tails]) / n)


@F.pandas_udf(ArrayType(DoubleType()))
def features_of(texts: pd.Series) -> pd.Series:
    make_room()
    return pd.Series([np.array(text_features(t)) for t in texts], dtype=object)


@dataclass
class Evidence:
    """A fitted classifier: the log-odds of good quality for an array of features."""

    weights: list[float]
    intercept: float

    def probability(self, features: Column, text_present: Column) -> Column:
        logit = F.lit(self.intercept)
        for i, w in enumerate(self.weights):
            logit = logit + features[i] * F.lit(w)
        return F.when(text_present, 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(20.0)), F.lit(-20.0))))).otherwise(F.lit(0.0))


def fit_evidence(rows: DataFrame, max_labels: int = 200_000) -> Evidence:
    """Logistic regression on ``f`` (features) and ``quality`` (0/1) of at most about
    ``max_labels`` rows; beyond that a hash of the id keeps an even share of them."""
    n = rows.count()
    if n > max_labels:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(max_labels / n * (1 << 20)))
    classes = rows.agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).first()
    if classes["lo"] is None or classes["lo"] == classes["hi"]:
        return Evidence([0.0] * len(FEATURES), -20.0 if classes["hi"] == 0 else 20.0)
    data = rows.select(F.col("quality").cast("double").alias("label"), *[F.col("f")[i].alias(c) for i, c in enumerate(FEATURES)])
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data).select("label", "features")
    model = LogisticRegression(maxIter=40, regParam=1e-4, tol=1e-6).fit(data)
    return Evidence([float(x) for x in model.coefficients], float(model.intercept))


def site_columns(source: Column, lang: Column) -> list[Column]:
    """``host`` and ``path`` of a document."""
    bare = F.regexp_replace(F.lower(source), r"^[a-z][a-z0-9+.-]*://", "")
    first = F.split(bare, "/", -1)
    return [first[0].alias("host"),
            F.when(source.isNull() & lang.isNull(), F.lit(None).cast("string"))
            .otherwise(F.concat_ws("/", F.coalesce(F.get(first, 1), F.lit("")), F.coalesce(lang, F.lit("?")))).alias("path")]


def _strength(rates: DataFrame, mean: Column | float) -> float:
    """Beta-binomial prior strength of groups with size ``n``, sum ``s`` and prior mean ``mean``."""
    m = F.lit(mean) if isinstance(mean, float) else mean
    v = F.greatest(m * (1 - m), F.lit(1e-9))
    r = rates.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"),
                  F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - m, 2) / v).alias("d")).first()
    if not r["N"] or r["k"] < 2:
        return 100.0
    total, k = float(r["N"]), float(r["k"])
    spread = (r["d"] - (k - 1)) / max(total - r["nn"] / total, 1e-9)
    return float(min(max(1 / spread - 1, 1.0), 1e6)) if spread > 0 else 1e6


@dataclass
class Sites:
    """Per (host, path): ``n``, ``s`` and the host's ``hn``, ``hs``; the global share; strength of both levels."""

    table: DataFrame
    share: float
    host_strength: float
    path_strength: float


def fit_sites(scored: DataFrame) -> Sites:
    """``scored``: host, path, p.  Two aggregations: by path, and of those by host."""
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "quality-paths", compact=True)
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    share = min(max(total["s"] / total["n"], 1e-6), 1 - 1e-6) if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k = _strength(hosts, share)
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("hn"), F.col("s").alias("hs"))
    both = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left").drop("h"), "quality-sites", compact=True)
    return Sites(both, share, k, _strength(both, (F.col("hs") + k * share) / (F.col("hn") + k)))


def with_posterior(rows: DataFrame, sites: Sites) -> DataFrame:
    """Adds ``prior`` (the shrunk share of the document's path) and ``posterior`` to rows with host, path, p."""
    t = sites.table.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("n").alias("_n"),
                           F.col("s").alias("_s"), F.col("hn").alias("_hn"), F.col("hs").alias("_hs"))
    j = rows.join(t, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")), "left")

    def others(n: str, s: str, toward: Column, strength: float) -> Column:
        """Share of the site's other documents, shrunk toward the level above."""
        return (F.greatest(F.col(s) - F.col("p"), F.lit(0.0)) + F.lit(strength) * toward) / (F.col(n) - 1 + F.lit(strength))

    host = others("_hn", "_hs", F.lit(sites.share), sites.host_strength)
    prior = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.coalesce(
        others("_n", "_s", host, sites.path_strength), F.lit(sites.share))))
    odds = F.col("prior") / (1 - F.col("prior")) * F.lit((1 - sites.share) / sites.share)
    return j.withColumn("prior", prior).withColumn(
        "posterior", F.col("p") * odds / (F.col("p") * odds + 1 - F.col("p"))).drop("_h", "_p", "_n", "_s", "_hn", "_hs")


def _present(text: Column) -> Column:
    return F.coalesce(F.length(F.trim(text, F.lit(" \t\r\n\x0b\x0c"))) > 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 200_000) -> tuple[DataFrame, Evidence, Sites]:
    """Scored narrow rows (doc_id, source, host, path, p), the classifier and the sites of ``docs``."""
    prepare(docs.sparkSession)
    rows = stored(docs.select("doc_id", "source", *site_columns(F.col("source"), F.col("lang")), _present(F.col("text")).alias("present"),
                              features_of("text").alias("f")), "quality-features")
    known = rows.join(labels.filter("quality IN (0, 1)").select("doc_id", "quality"), "doc_id")
    evidence = fit_evidence(known, max_labels)
    scored = rows.select("doc_id", "source", "host", "path", evidence.probability(F.col("f"), F.col("present")).alias("p"))
    return scored, evidence, fit_sites(scored)


def judge(docs: DataFrame, labels: DataFrame, keep_at: float = 0.5, max_labels: int = 200_000) -> DataFrame:
    """One row per document: doc_id, source, evidence, prior, posterior, keep."""
    scored, _, sites = fit(docs, labels, max_labels)
    out = with_posterior(scored, sites)
    return out.select("doc_id", "source", F.col("p").alias("evidence"), "prior", "posterior",
                      (F.col("posterior") >= keep_at).alias("keep"))


def kept_rows(docs: DataFrame, labels: DataFrame, keep_at: float = 0.5, max_labels: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.  Features are computed again beside
    each text, so no text is shuffled and rows need no key."""
    _, evidence, sites = fit(docs, labels, max_labels)
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), features_of("text").alias("f")).select(
        "_row", *site_columns(F.col("_row.source"), F.col("_row.lang")),
        evidence.probability(F.col("f"), _present(F.col("_row.text"))).alias("p"))
    return with_posterior(rows, sites).filter(F.col("posterior") >= keep_at).select("_row.*")
