"""Personal data spans: strict rules, and a semi-Markov conditional random field that adds what they miss.

Rules give the base spans, leftmost and non-overlapping per kind: ``email``, ``ip``
(parts to 255), ``card`` (12 to 19 digits, Luhn) and ``phone`` (leading plus, 9 to 15
digits).  They always stay.

The model scores whole candidate segments of an *island* - a stretch of text around digits or an
at-sign - by features of the whole span (digit counts, grouping, checksum, separators, borders)
and a dynamic programme over token positions, with segments of at most ``MAX_TOKENS`` tokens, chooses
borders and kinds jointly.  Tokens outside islands can be in no segment and score nothing, so decoding
islands is decoding the whole text.  Decoded segments that touch no base span are added with the same four
kinds and marked as not ``strict``: a phone and a card number with one space between them, say, which
the rules read as one number too long.

The weights are trained here by conditional likelihood (forward-backward) on a bounded sample of
islands of the corpus: base spans label them, and altered copies (phone without its plus,
spelled at-sign, dotted card groups) teach the variants; whatever the rules reject in them
stays an example of no entity.

Scale: one pass over the texts that hold a digit or an at-sign takes the sample, every task keeping its ``max_islands``
islands of smallest hash, so that a shuffle carries that many rows a task at most; a second pass without a
shuffle finds the spans.  Weights are about a hundred numbers.

Defined results: null text is empty and has no spans; offsets count code points, ends are
exclusive; whole texts are searched in linear time; repeated rows give repeated results; without any base span in the
sample nothing is added; an empty table gives no rows; other columns are kept, and a column named like the result is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastespark.llm.common import prepare

KINDS = ["email", "ip", "card", "phone"]
#: Longest segment, in tokens and characters, that the model considers.
MAX_TOKENS, MAX_CHARS = 24, 96
#: Log-odds by which an added segment must beat "no entity".
MARGIN = 2.0
#: Islands that training may use.
MAX_ISLANDS = 1500

# fixed values: the base rules
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += (d if i % 2 == 0 else d * 2 - 9 * (d > 4))
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strict rules by start, then kind."""
    out = []
    if "@" in text:
        end = 0
        at = text.find("@")
        while at >= 0:
            start = at
            while start > end and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append((0, start, m.end()))
                end = m.end()
            at = text.find("@", max(at + 1, end))
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if 12 <= len(m[0]) <= 37 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in out)]


# -- islands and segments ------------------------------------------------------

_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]", re.I)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_AT = re.compile(r"@|\s?[(\[]at[)\]]\s?", re.I)
_GROUP = re.compile(r"[0-9]+")
N_FEATURES = 24


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches of the text that may hold entities.  Words are cut at white space, so each is read once."""
    if not _TRIGGER.search(text):
        return []
    out: list[tuple[int, int]] = []
    for m in re.finditer(r"\S+", text):
        hit = _TRIGGER.search(m[0])
        if not hit:
            continue
        s, e = m.span()
        if hit[0][0] in "([" and len(m[0]) == 4:      # a spelled at-sign of its own takes its neighbours in
            before = re.search(r"\S+\x20\Z", text[max(0, s - 80):s])
            s -= len(before[0]) if before else 0
            after = re.match(r"\x20\S+", text[e:e + 80])
            e += len(after[0]) if after else 0
        if out and s <= out[-1][1] + 1 and (s <= out[-1][1] or text[out[-1][1]] == " "):
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def features(seg: str, before: str, after: str) -> np.ndarray:
    """Whole-span features of one candidate segment and its border characters."""
    f = np.zeros(N_FEATURES)
    groups = _GROUP.findall(seg)
    digits = "".join(groups)
    n = len(digits)
    letters = sum(map(str.isalpha, seg))
    at = _AT.findall(seg)
    f[0] = 1
    f[1] = len(at) == 1
    f[2] = len(at) > 1
    if len(at) == 1:
        local, _, domain = seg.partition(at[0])
        f[3] = bool(re.fullmatch(r"[\w.%+-]+", local, re.A)) and bool(_DOMAIN.fullmatch(domain))
    f[4] = letters / len(seg)
    f[5:11] = [n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n >= 20]
    f[11] = 12 <= n <= 19 and luhn(digits)
    f[12] = 12 <= n <= 19 and not f[11]
    plain = letters == 0
    f[13] = plain and len(groups) == 4 and seg.count(".") == 3
    f[14] = f[13] and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    f[15] = seg.startswith("+")
    f[16] = "(" in seg and ")" in seg
    f[17] = plain and bool(re.fullmatch(r"\+?\(?[0-9]{1,3}\)?[ .-]*\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}", seg))
    f[18] = plain and len(groups) > 1 and len(set(map(len, groups[:-1]))) == 1 and len(groups[0]) == 4
    f[19] = plain and len(groups) == 1
    # a border inside a longer run of the characters that entities are made of
    f[20] = bool(re.match(r"[\w.%+@-]", before))
    f[21] = bool(re.match(r"[\w@%+-]", after))
    f[22] = seg.count("(") != seg.count(")")
    f[23] = plain and len({c for c in seg if not c.isdigit() and c not in "+()"}) > 2
    return f


class Island:
    """Tokens of one stretch and its candidate segments (first token, end token) with their features."""

    def __init__(self, text: str, start: int, end: int):
        self.start, part = start, text[start:end]
        self.at = [m.start() for m in _TOKEN.finditer(part)] + [len(part)]
        self.n = len(self.at) - 1
        self.segments: list[tuple[int, int]] = []
        rows = []
        ok_first = [part[a].isalnum() or part[a] in "+(" for a in self.at[:-1]]
        for i in range(self.n):
            if not ok_first[i]:
                continue
            for j in range(i + 1, min(self.n, i + MAX_TOKENS) + 1):
                a, b = self.at[i], self.at[j]
                if b - a > MAX_CHARS:
                    break
                # long enough, ends in a letter or digit, and holds an at-sign or digits
                if b - a < 7 or not part[b - 1].isalnum() or not _TRIGGER.search(part, a, b):
                    continue
                before = part[a - 1] if a else (text[start - 1] if start else " ")
                after = part[b] if b < len(part) else (text[end] if end < len(text) else " ")
                self.segments.append((i, j))
                rows.append(features(part[a:b], before, after))
        self.f = np.array(rows) if rows else np.zeros((0, N_FEATURES))

    def span(self, seg: tuple[int, int]) -> tuple[int, int]:
        return self.start + self.at[seg[0]], self.start + self.at[seg[1]]


class SemiMarkov:
    """Weights per kind; a segmentation scores the sum of its segments, single other tokens score 0."""

    def __init__(self, weights: np.ndarray):
        self.w = weights

    @staticmethod
    def _ending(isl: Island) -> list[list[int]]:
        ends: list[list[int]] = [[] for _ in range(isl.n + 1)]
        for x, (_, j) in enumerate(isl.segments):
            ends[j].append(x)
        return ends

    def decode(self, isl: Island) -> list[tuple[int, int, int]]:
        """Best segmentation: (segment, kind) as (kind, start, end) of the text."""
        if not isl.segments:
            return []
        s = isl.f @ self.w.T - MARGIN
        kind, top = s.argmax(axis=1), s.max(axis=1)
        if top.max() <= 0:
            return []
        best, back = [0.0] * (isl.n + 1), [-1] * (isl.n + 1)
        for j, ending in enumerate(self._ending(isl)):
            if j:
                best[j] = best[j - 1]
            for x in ending:
                v = best[isl.segments[x][0]] + top[x]
                if v > best[j]:
                    best[j], back[j] = v, x
        out, j = [], isl.n
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                out.append((int(kind[back[j]]), *isl.span(isl.segments[back[j]])))
                j = isl.segments[back[j]][0]
        return out[::-1]

    def gradient(self, isl: Island, gold: dict[int, int]) -> tuple[float, np.ndarray]:
        """Log-likelihood of the gold segments (segment -> kind) and its gradient, by forward-backward."""
        s = isl.f @ self.w.T
        total = np.logaddexp.reduce(s, axis=1)
        fwd, bwd = np.zeros(isl.n + 1), np.zeros(isl.n + 1)
        ending = self._ending(isl)
        for j in range(1, isl.n + 1):
            fwd[j] = np.logaddexp.reduce([fwd[j - 1], *[fwd[isl.segments[x][0]] + total[x] for x in ending[j]]])
        starting: list[list[int]] = [[] for _ in range(isl.n + 1)]
        for x, (i, _) in enumerate(isl.segments):
            starting[i].append(x)
        for i in range(isl.n - 1, -1, -1):
            bwd[i] = np.logaddexp.reduce([bwd[i + 1], *[bwd[isl.segments[x][1]] + total[x] for x in starting[i]]])
        i, j = np.array([a for a, _ in isl.segments]), np.array([b for _, b in isl.segments])
        p = np.exp(np.minimum(fwd[i][:, None] + s + bwd[j][:, None] - fwd[-1], 0))
        g = -p.T @ isl.f
        value = -fwd[-1]
        for x, k in gold.items():
            g[k] += isl.f[x]
            value += s[x, k]
        return value, g


# -- training ----------------------------------------------------------------

def altered(part: str, spans: list[tuple[str, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """A copy of an island whose entities are written differently, with their new places."""
    out, labels, at = "", [], 0
    for kind, s, e in spans:
        if s < at:
            continue
        out += part[at:s]
        x = part[s:e]
        if kind == "phone":
            x = x.lstrip("+")
            x = re.sub(r"[ .-]", lambda m: str(rng.choice([" ", "-", "."])), x)
        elif kind == "email":
            x = x.replace("@", str(rng.choice([" (at) ", "(at)", " [at] "])))
        elif kind == "card":
            d = _digits(x)
            x = str(rng.choice([".", " . ", "/"])).join(d[i:i + 4] for i in range(0, len(d), 4))
        labels.append((kind, len(out), len(out) + len(x)))
        out += x
        at = e
    return out + part[at:], labels


def labelled(text: str, start: int, end: int, spans: list[tuple[str, int, int]]) -> tuple[Island, dict[int, int]]:
    """An island and its gold segments: earlier kinds and earlier spans first where they overlap."""
    isl = Island(text, start, end)
    where = {isl.span(x): n for n, x in enumerate(isl.segments)}
    gold, taken = {}, []
    for kind, s, e in spans:
        if (s, e) in where and not any(s < b and a < e for a, b in taken):
            gold[where[s, e]] = KINDS.index(kind)
            taken.append((s, e))
    return isl, gold


def train(parts: list[str], epochs: int = 25, seed: int = 5) -> np.ndarray:
    """Weights from island texts, their base spans and altered copies."""
    rng = np.random.default_rng(seed)
    data = []
    for part in parts:
        spans = base_spans(part)
        data.append(labelled(part, 0, len(part), spans))
        if spans:
            other, labels = altered(part, spans, rng)
            if all(_TRIGGER.search(other[s:e]) for _, s, e in labels):
                data.append(labelled(other, 0, len(other), labels))
    data = [(i, g) for i, g in data if i.segments]
    model = SemiMarkov(np.zeros((len(KINDS), N_FEATURES)))
    if not any(g for _, g in data):
        model.w[:, 0] = -10.0
        return model.w
    history = np.full_like(model.w, 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(data), 32):
            batch = [data[x] for x in order[start:start + 32]]
            g = sum(model.gradient(i, y)[1] for i, y in batch) / len(batch) - 1e-4 * model.w
            history += g * g
            model.w += 0.5 * g / np.sqrt(history)
    return model.w


def island_sample(docs: DataFrame, text: str, limit: int = MAX_ISLANDS) -> list[str]:
    """At most ``limit`` distinct islands of the corpus, those with the smallest hashes."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The smallest of a task: twice as many are held at most, whatever it reads."""
        best: dict[str, str] = {}
        for pdf in batches:
            for t in pdf["t"]:
                for s, e in islands(t) if t else ():
                    if e - s <= 4 * MAX_CHARS:
                        best[hashlib.md5(t[s:e].encode("utf-8", "replace")).hexdigest()] = t[s:e]
                if len(best) > 2 * limit:
                    best = dict(sorted(best.items())[:limit])
        yield pd.DataFrame(sorted(best.items())[:limit], columns=["h", "part"])

    found = docs.select(F.col(f"`{text}`").cast("string").alias("t")).filter(F.col("t").rlike("[0-9@]")).mapInPandas(cut, "h string, part string")
    return [r["part"] for r in found.distinct().orderBy("h").limit(limit).collect()]


# -- the operator --------------------------------------------------------------

def all_spans(text: str, model: SemiMarkov) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, added spans)."""
    base = base_spans(text)
    added = []
    for s, e in islands(text):
        for kind, a, b in model.decode(Island(text, s, e)):
            if not any(a < y and x < b for _, x, y in base):
                added.append((KINDS[kind], a, b))
    return base, added


SPANS = "array<struct<kind:string,start:int,end:int,strict:boolean>>"


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans", max_islands: int = MAX_ISLANDS) -> DataFrame:
    """``docs`` with an array of all spans (kind, start, end, strict) by start, then kind."""
    prepare(docs.sparkSession)
    model = SemiMarkov(train(island_sample(docs, text, max_islands)))

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        found = []
        for t in texts:
            base, added = all_spans(t, model) if t else ([], [])
            marked = [(s, KINDS.index(k), e, strict) for part, strict in ((base, True), (added, False)) for k, s, e in part]
            found.append([{"kind": KINDS[k], "start": s, "end": e, "strict": strict} for s, k, e, strict in sorted(marked)])
        return pd.Series(found, dtype=object)

    return docs.withColumn(out, spans(F.col(f"`{text}`").cast("string")))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def strict(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["strict"])


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets (overlapping spans by the first one)."""
    step = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda acc, x: F.when(
        x["start"] >= acc["at"],
        F.struct(F.concat(acc["out"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), x["kind"], F.lit("]")).alias("out"),
                 x["end"].alias("at"))).otherwise(acc))
    return F.concat(step["out"], F.substr(text, step["at"] + 1))
