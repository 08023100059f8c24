"""Benchmark decontamination by a generalised suffix automaton of the test items.

Texts are normalised to words (A-Z in lower case; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``).  All items
go into one automaton over words, whose states are the classes of word sequences that end at the same places of the
items.  The words of a training document are streamed through it: after each word the state and the matching
length name the longest sequence ending there that occurs in an item.  Where the length reaches ``window``
(10 words), the last ten words are an item's window and are hit; the class of exactly those ten words, found by its
suffix link, names the items.  An item of fewer words is one window; the states of such whole items are
marked, and every state knows its nearest marked suffix.  Overlapping windows make spans; ``remove_spans`` takes
the spans of at least ``min_span`` words out of the texts and drops documents of which more than a given share is hit.

A word that no item holds, or two neighbouring words that stand together in no item, end every longer match.  Both
are looked up for whole batches at once, and only the stretches between such places, long enough for a window, are streamed.

Scale: the documents are read once, without a shuffle.  The automaton grows with the benchmark, so the items are dealt
into shards of at most about ``SHARD_WORDS`` words (a longer item in pieces that overlap by a window less one word), each
built by one task; ``PASS_SHARDS`` shards (about 100 MB in all) are broadcast at a time, and a benchmark beyond that takes
further passes, each of which adds its spans to the rows of the one before, written in between.

Defined results: null texts have no words; an item without words has no window; rows that repeat an item_id are one
item; an item without id hits words and is not named; repeated, null or other ids of documents make no difference, each row
is judged alone; empty tables give no rows, or no hits; other columns are carried by ``remove_spans`` and ignored by
``scan``.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import pickle
import re
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastespark.llm.common import batch_rows, hold, make_room, prepare, stored, text_chunks
from tastespark.llm.shingles import word_hashes

#: Words of one window, and of the automata that are built by one task and broadcast together.
WINDOW, SHARD_WORDS, PASS_SHARDS = 10, 1 << 18, 8
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _bytes(texts: list) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


class Automaton:
    """Generalised suffix automaton of sequences of word hashes, with the items of each window."""

    def __init__(self, sequences: list[np.ndarray], owners: list[list[str]], window: int = WINDOW):
        self.window = window
        everything = np.concatenate([np.zeros(0, np.uint64), *sequences])
        self.words = np.unique(everything)
        self.least = min([min(window, len(s)) for s in sequences], default=window)
        ids = [np.searchsorted(self.words, s).astype(np.int64) for s in sequences]
        pairs = [(s[:-1] << 32) | s[1:] for s in ids]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
        self._filter()
        self._grow([s.tolist() for s in ids])
        self._name(ids, owners)

    def _filter(self) -> None:
        """A table by the low bits of a hash, which most words that no item holds fail."""
        bits = 1 << max(10, (16 * max(len(self.words), 1)).bit_length())
        self.mask = np.uint64(bits - 1)
        self.maybe = np.zeros(bits, dtype=bool)
        self.maybe[self.words & self.mask] = True

    def _grow(self, sequences: list[list[int]]) -> None:
        step: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def split(p: int, c: int) -> int:
            """The state after p and c, made one of its own where longer sequences share it."""
            q = step[p][c]
            if length[q] == length[p] + 1:
                return q
            own = len(step)
            step.append(dict(step[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = own
            while p >= 0 and step[p].get(c) == q:
                step[p][c] = own
                p = link[p]
            return own

        for sequence in sequences:
            last = 0
            for c in sequence:
                if c in step[last]:
                    last = split(last, c)
                    continue
                new, p = len(step), last
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                while p >= 0 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p >= 0:
                    link[new] = split(p, c)
                last = new
        sizes = np.fromiter(map(len, step), dtype=np.int64, count=len(step))
        key = np.fromiter((c for t in step for c in t), dtype=np.int64, count=int(sizes.sum()))
        to = np.fromiter((s for t in step for s in t.values()), dtype=np.int32, count=len(key))
        key |= np.repeat(np.arange(len(step), dtype=np.int64), sizes) << 32
        order = np.argsort(key)
        self.key, self.to = array("q", key[order].tobytes()), array("i", to[order].tobytes())
        self.link, self.length = array("i", link), array("i", length)

    def _name(self, ids: list[np.ndarray], owners: list[list[str]]) -> None:
        """Items of the window states and of the marked states; for every state the state of its last ``window`` words
        (``top``) and the nearest marked one among itself and its suffixes (``near``, 0 for none)."""
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        top = array("i", bytes(4 * len(self.link)))
        for v in by_length:
            if self.length[v] >= self.window:
                top[v] = v if self.length[self.link[v]] < self.window else top[self.link[v]]
        items: dict[int, set[str]] = {}
        marked = set()
        for s, own in zip(ids, owners):
            state = 0
            for n, c in enumerate(s.tolist(), 1):
                state = self.to[bisect_left(self.key, state << 32 | c)]
                if n >= self.window:
                    items.setdefault(top[state], set()).update(own)
            if 0 < len(s) < self.window:
                marked.add(state)
                items.setdefault(state, set()).update(own)
        near = array("i", bytes(4 * len(self.link)))
        for v in by_length:
            near[v] = v if v in marked else near[self.link[v]]
        self.top, self.near = top, near
        self.items = {v: sorted(x) for v, x in items.items()}

    def _known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that items hold, and their numbers."""
        at = np.flatnonzero(self.maybe[h & self.mask])
        n = np.searchsorted(self.words, h[at])
        n[n == len(self.words)] = 0
        ok = self.words[n] == h[at] if len(self.words) else np.zeros(len(at), dtype=bool)
        return at[ok], n[ok]

    def matches(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(start, end, state) of the windows among the words ``h`` of several texts, which begin at ``first``."""
        at, word = self._known(h)
        if not len(at):
            return
        text = np.searchsorted(first, at, side="right")
        pair = (word[:-1] << 32) | word[1:]
        p = np.searchsorted(self.pairs, pair)
        p[p == len(self.pairs)] = 0
        joined = (at[1:] == at[:-1] + 1) & (text[1:] == text[:-1])
        joined &= self.pairs[p] == pair if len(self.pairs) else False
        cut = np.concatenate([[0], np.flatnonzero(~joined) + 1, [len(at)]])
        for i in np.flatnonzero(np.diff(cut) >= self.least):
            yield from self._stream(word[cut[i]:cut[i + 1]].tolist(), int(at[cut[i]]))

    def _stream(self, words: list[int], offset: int) -> Iterator[tuple[int, int, int]]:
        key, to, link, length, window = self.key, self.to, self.link, self.length, self.window
        state = n = 0
        for end, c in enumerate(words, offset + 1):
            while True:
                p = bisect_left(key, state << 32 | c)
                if p < len(key) and key[p] == state << 32 | c:
                    state, n = to[p], n + 1
                    break
                if state == 0:
                    break
                state = link[state]
                n = length[state]
            if n >= window:
                yield end - window, end, self.top[state]
            short = self.near[state if n == length[state] else link[state]] if state else 0
            while short:
                yield end - length[short], end, short
                short = self.near[link[short]]


def _shards(benchmark: DataFrame, window: int, item_id: str, text: str, shard_words: int) -> DataFrame:
    """shard, blob: the items dealt by hash, one automaton for each shard."""
    prepare(benchmark.sparkSession)
    most = max(shard_words // 16, 2 * window)
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, z in text_chunks(pdf["text"].tolist(), 1 << 20):
                h, first = word_hashes(_bytes(pdf["text"].tolist()[a:z]), _BETWEEN)
                out = []
                for i in range(z - a):
                    w = h[first[i]:first[i + 1]]
                    for s in range(0, max(len(w) - window + 1, 1), most - window + 1):
                        if len(w):
                            out.append((pdf["item"].iloc[a + i], len(w[s:s + most]), w[s:s + most].tobytes()))
                yield pd.DataFrame(out, columns=["item", "n", "words"])

    cut = stored(rows.mapInPandas(pieces, "item string, n bigint, words binary"), "decontaminate-items")
    total = cut.agg(F.sum("n")).first()[0] or 0
    count = max(-(-2 * total // shard_words), 1) if total > shard_words else 1

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        owners: dict[bytes, set] = {}
        for item, words in zip(pdf["item"], pdf["words"]):
            owners.setdefault(words, set()).update([item] if item is not None else [])
        order = sorted(owners)
        made = Automaton([np.frombuffer(w, dtype=np.uint64) for w in order], [sorted(owners[w]) for w in order], window)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "blob": [pickle.dumps(made, protocol=5)]})

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(count)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(build, "shard int, blob binary"), "decontaminate-automata")


_LOADED: dict[str, list[Automaton]] = {}


def _automata(name: str, shared: Broadcast) -> list[Automaton]:
    """The automata of a pass, unpacked once per worker process."""
    if name not in _LOADED:
        make_room("decontaminate")
        _LOADED.clear()
        _LOADED[name] = [pickle.loads(b) for b in shared.value]
        hold("decontaminate", _LOADED.clear)
    return _LOADED[name]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


FOUND = "_n bigint, _spans array<struct<s: bigint, e: bigint>>, _items array<string>"


def _pass(rows: DataFrame, blobs: list[bytes], more: bool) -> DataFrame:
    """``rows`` (any columns and ``_text``), with what an earlier pass found if ``more``, and what these automata find."""
    shared, name = rows.sparkSession.sparkContext.broadcast(blobs), uuid.uuid4().hex
    kept = [f for f in rows.schema if f.name not in ("_n", "_spans", "_items")]
    schema = StructType(kept).simpleString()[len("struct<"):-1]
    where, names = len(kept), [f.name for f in kept]
    text_at = names.index("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(name, shared)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            n: list[int] = []
            spans: list[list] = [[] for _ in texts]
            items: list[set] = [set() for _ in texts]
            if more:
                spans = [[(x["s"], x["e"]) for x in old] for old in batch.column(where + 1).to_pylist()]
                items = [set(old) for old in batch.column(where + 2).to_pylist()]
            for a, z in text_chunks(texts, 1 << 20):
                h, first = word_hashes(_bytes(texts[a:z]), _BETWEEN)
                n += np.diff(first).tolist()
                for automaton in automata:
                    seen: dict[int, set[int]] = {}
                    for s, e, state in automaton.matches(h, first[:-1]):
                        i = int(np.searchsorted(first, s, side="right")) - 1
                        mine = spans[a + i]
                        s, e = s - int(first[i]), e - int(first[i])
                        if mine and mine[-1][0] <= s <= mine[-1][1]:
                            mine[-1] = (mine[-1][0], max(e, mine[-1][1]))
                        else:
                            mine.append((s, e))
                        seen.setdefault(a + i, set()).add(state)
                    for i, states in seen.items():
                        for state in states:
                            items[i].update(automaton.items[state])
            found = [pa.array(n, pa.int64()), pa.array([[{"s": s, "e": e} for s, e in merged(x)] for x in spans],
                                                        pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:where], *found], [*names, "_n", "_spans", "_items"])

    return rows.mapInArrow(run, f"{schema}, {FOUND}")


def _found(rows: DataFrame, benchmark: DataFrame, window: int, item_id: str, item_text: str, shard_words: int) -> DataFrame:
    automata = _shards(benchmark, window, item_id, item_text, shard_words)
    shards = sorted(r["shard"] for r in automata.select("shard").collect())
    for at in range(0, max(len(shards), 1), PASS_SHARDS):
        if at:
            rows = stored(rows, "decontaminate-pass")
        some = automata.filter(F.col("shard").isin(shards[at:at + PASS_SHARDS])).select("blob")
        rows = _pass(rows, [bytes(r["blob"]) for r in some.toLocalIterator()] if shards else [], more=at > 0)
    return rows


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (start, end in words, end exclusive), item_ids (strings, sorted)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    found = _found(rows, benchmark, window, item_id, item_text, shard_words)
    hit = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda t, x: t + x["e"] - x["s"])
    spans = F.transform("_spans", lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end")))
    return found.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_words"), hit.alias("n_hit"), spans.alias("spans"),
                        F.col("_items").alias("item_ids"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_span: int = WINDOW, max_coverage: float = 0.5,
                 text: str = "text", item_id: str = "item_id", item_text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without the documents of which more than ``max_coverage`` of the words is hit, and without the spans of
    ``min_span`` or more words in the others (from the span's first word to its last; text around it stays)."""
    prepare(docs.sparkSession)
    cols = docs.columns
    at = cols.index(text)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cols)], F.col(f"`{text}`").cast("string").alias("_text"))
    found = _found(rows, benchmark, window, item_id, item_text, shard_words)
    hit = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda t, x: t + x["e"] - x["s"])
    kept = found.filter(hit <= F.col("_n") * F.lit(max_coverage))

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = texts.copy()
        for i, (t, cuts) in enumerate(zip(texts, spans)):
            cuts = [(x["s"], x["e"]) for x in cuts if x["e"] - x["s"] >= min_span]
            if cuts:
                raw = t.encode("utf-8", "surrogatepass")
                word = [m.span() for m in _WORD.finditer(raw)]
                edges = [0, *[b for s, e in cuts for b in (word[s][0], word[e - 1][1])], len(raw)]
                out.iloc[i] = b"".join([raw[a:z] for a, z in zip(edges[::2], edges[1::2])]).decode("utf-8", "surrogatepass")
        return out

    with batch_rows(docs.sparkSession, 256):
        return kept.select(*[(without("_text", "_spans") if i == at else F.col(f"_c{i}")).alias(c) for i, c in enumerate(cols)])
