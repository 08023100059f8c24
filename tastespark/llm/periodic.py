"""Periodic runs of words in whole texts, by scale-tiled search.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
``max(12, 2q)`` words long, that no neighbouring word extends.  Periods are searched by octave
``2^k <= q < 2^(k+1)``.  For an octave a document is cut into overlapping tiles; inside a tile every multiple b
of ``2^k`` is a boundary, and the boundary's Z-function ``z(q) = lcp(x[b:], x[b+q:])`` with its mirror image
``y(q) = lcs(x[:b], x[:b+q])`` gives the stretch of period q around the boundary, ``[b - y, b + q + z)``.  Every run
of the octave holds such a boundary, and there or before it at least half of its repeated words, so that the Z-values
that matter exceed a power of two: hashes of all windows of ``2^j`` words (doubled level by level,
64 bits, mixed at every level) show in one comparison a position which of them do, and give their exact length by
binary lifting.  A stretch whose period is no smallest one has the same ends as the one with the smallest, so the
smallest period of equal ends is kept.

Scale: one pass over the texts.  A document of at most ``tile`` words is one tile of every octave and is solved in the
task that reads it.  Tiles of longer documents (``(start, codes)``, 16 ``2^k`` words for octave k, the lower octaves together)
are dealt over all tasks, so that one very long text is solved by many; their fragments are
shuffled by (text, period), and fragments that overlap by a period are stitched.  Equal long texts are one text
there (128 bits of hash); only long texts are joined to their runs again.  Work and memory are ``n log n`` in a tile's words.

Defined results: null text has no words; words are ``[^\\x20\\x09-\\x0D]+``, compared exactly; rows are handled
one by one, whatever their id (null and repeated ones too); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastespark.llm.common import WORD, make_room, mix64, parallelism, prepare, stored, text_chunks

#: Words of a document that is solved where it is read, and of the tiles of the lower octaves.
TILE = 4096
#: Shortest run.
LEAST = 12
_A = np.uint64(0x9E3779B97F4A7C15)
RUN = "start bigint, length bigint, period bigint"
DIGEST = f"n_runs bigint, {RUN}, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def word_codes(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words of the list (the last position where it stands)."""
    last = dict(zip(words, range(len(words))))
    return np.fromiter(map(last.__getitem__, words), dtype=np.int64, count=len(words))


def _levels(x: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of the windows of 2^j words at every position, for the documents (longest first) that hold such a window."""
    level, out = mix64(x.view(np.uint64) + _A), []
    width = 1
    while len(level):
        out.append(level)
        held = ends[np.diff(ends, prepend=0) > 2 * width]      # one more than its words, with its mark
        n = max(int(held[-1]) - 2 * width + 1, 0) if len(held) else 0
        level = mix64(level[:n] * _A + level[width:width + n])
        width *= 2
    return out


def _reach(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """Words that agree from x and y on (step 1), or before them (step -1)."""
    total = np.zeros(len(x), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        h, width = levels[j], 1 << j       # what is left to find is shorter than two windows
        u, v = (x + total, y + total) if step > 0 else (x - total - width, y - total - width)
        w = np.flatnonzero((np.minimum(u, v) >= 0) & (np.maximum(u, v) < len(h)))
        total[w[h[u[w]] == h[v[w]]]] += width
    return total


def solve(parts: list[np.ndarray], low: int = 0, high: int = 62) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Part, start, end and period of the maximal stretches of each code array with a period of the octaves
    ``low`` to ``high``; of stretches with equal ends the one with the smallest period."""
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    size = np.array([len(parts[i]) + 1 for i in order], dtype=np.int64)
    ends = np.cumsum(size)
    x = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    for i, e, n in zip(order, ends, size):
        x[e - n:e - 1] = parts[i]
    if len(x):
        x[ends - 1] = -1 - np.arange(len(ends))    # a mark of its own after every part: nothing agrees across it
    levels = _levels(x, ends)
    found = [np.zeros((3, 0), dtype=np.int64)]
    for k in range(low, high + 1):
        least = max(LEAST, 2 << k)
        held = ends[size > least]
        if not len(held):
            break
        # the repeated words on one side of a boundary are at least half of max(q, 12 - q)
        width = 2 if k < 2 else max(1, k - 1)
        grid, n = 1 << k, int(held[-1])
        h = levels[width][:n]
        rows = -(-(n + 1) // grid)
        for shift in (0, 1 << width):
            # entry i holds the window at i - shift; row j + 1 is compared with the boundary j * grid
            m = np.empty(rows * grid, dtype=np.uint64)
            fill = min(len(h), rows * grid - shift)
            if fill <= 0:
                continue
            m[shift:shift + fill] = h[:fill]
            blank = np.concatenate([np.arange(shift), np.arange(shift + fill, len(m))])
            m[blank] = mix64(blank.astype(np.uint64))
            m = m.reshape(rows, grid)
            j, c = np.nonzero(m[1:] == m[:-1, :1])
            b, q = j * grid, grid + c
            ok = b + q < n
            b, q = b[ok], q[ok]
            if not len(b):
                continue
            s, e = b - _reach(levels, b, b + q, -1), b + q + _reach(levels, b, b + q, 1)
            ok = e - s >= np.maximum(LEAST, 2 * q)
            found.append(np.stack([s[ok], e[ok], q[ok]]))
    s, e, q = np.concatenate(found, axis=1)
    keep = np.lexsort((q, e, s))
    s, e, q = s[keep], e[keep], q[keep]
    first = np.ones(len(s), dtype=bool)
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[first], e[first], q[first]
    part = np.searchsorted(ends, s, side="right")
    base = (ends - size)[part]
    return np.array(order, dtype=np.int64)[part], s - base, e - base, q


def octave_tiles(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """(lowest octave, highest octave, start, stop) of all tiles of a document of n words.  Tiles of an octave overlap by
    four times its lower end and by 16 words, so that every stretch of two periods and of 12 words lies in one."""
    base = max((tile // 32).bit_length() - 1, 0)
    top = max(n // 2, 1).bit_length() - 1
    for low, high in [(0, base), *[(k, k) for k in range(base + 1, top + 1)]]:
        length = tile if low == 0 else 16 << low
        step = length - max(16, 4 << high)
        start = 0
        while True:
            yield low, high, start, min(start + length, n)
            if start + length >= n:
                break
            start += step


def digests(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """What the query returns for one document: its words and its runs (start, length, period)."""
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    listing = "".join([f"{s},{n},{q}\n" for s, n, q in runs])
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *numbers, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest())


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for s, n, q in runs:
        keep[s + q:s + n] = False
    return [words[i] for i in np.flatnonzero(keep)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()       # of bytes: exactly the six ASCII characters of WORD


def _runs_of(texts: list, tile: int) -> Iterator[tuple[int, list[bytes], list[tuple[int, int, int]]]]:
    """Index, words and runs of the texts of at most ``tile`` words."""
    for a, z in text_chunks(texts, 1 << 20):
        words = [words_of(t) for t in texts[a:z]]
        which = [i for i, w in enumerate(words) if len(w) <= tile]
        codes = word_codes([w for i in which for w in words[i]])
        cuts = np.cumsum([len(words[i]) for i in which])[:-1] if which else []
        got: dict[int, list] = {i: [] for i in which}
        if which:
            for p, s, e, q in zip(*(v.tolist() for v in solve(np.split(codes, cuts)))):
                got[which[p]].append((s, e - s, q))
        for i in which:
            yield a + i, words[i], got[i]


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def long_runs(docs: DataFrame, text: str = "text", tile: int = TILE) -> DataFrame:
    """k1, k2 (hash of the text), start, length, period: the runs of the texts of more than ``tile`` words, solved by tiles."""
    spark = docs.sparkSession
    body = F.col(f"`{text}`").cast("string")
    # more words than a tile take at least as many characters and separators
    rows = docs.filter(F.length(body) > 2 * tile).select(*_text_key(body), body.alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        seen: set[tuple[int, int]] = set()

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), schema)], names)

        names = ["k1", "k2", "low", "high", "start", "codes"]
        schema = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            out, held = [], 0
            for i in range(batch.num_rows):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                words = words_of(batch.column(2)[i].as_py())
                if len(words) <= tile or key in seen:
                    continue
                seen.add(key)
                codes = np.unique(word_codes(words), return_inverse=True)[1]
                codes = codes.astype(np.uint16 if codes.max() < 1 << 16 else np.uint32)
                for low, high, start, stop in octave_tiles(len(words), tile):
                    out.append((*key, low, high, start, bytes([codes.itemsize]) + codes[start:stop].tobytes()))
                    held += len(out[-1][-1])
                    if held > 1 << 22:
                        yield pack(out)
                        out, held = [], 0
            if out:
                yield pack(out)

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            out = [np.zeros((5, 0), dtype=np.int64)]
            for i in range(batch.num_rows):
                k1, k2, low, high, start, body = (batch.column(c)[i].as_py() for c in range(6))
                x = np.frombuffer(body, dtype=np.uint16 if body[0] == 2 else np.uint32, offset=1).astype(np.int64)
                _, s, e, q = solve([x], low, high)
                key = np.full((2, len(s)), [[k1], [k2]], dtype=np.int64)
                out.append(np.concatenate([key, np.stack([q, s + start, e + start])]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], ["k1", "k2", "q", "s", "e"])

    tiles = rows.mapInArrow(cut, "k1 bigint, k2 bigint, low int, high int, start bigint, codes binary")
    # equal texts read by several tasks are dealt apart, too: the task is part of the key
    tiles = tiles.withColumn("task", F.spark_partition_id()).repartition(2 * parallelism(spark), "k1", "low", "start", "task").drop("task")
    pieces = stored(tiles.mapInArrow(solved, "k1 bigint, k2 bigint, q bigint, s bigint, e bigint"), "periodic-fragments")
    # fragments of a period that overlap by it are one stretch
    before = Window.partitionBy("k1", "k2", "q").orderBy("s", "e")
    past = F.max("e").over(before.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.distinct().withColumn("new", F.coalesce((F.col("s") + F.col("q") > past).cast("int"), F.lit(1)))
    chained = marked.withColumn("part", F.sum("new").over(before))
    whole = chained.groupBy("k1", "k2", "q", "part").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    smallest = whole.groupBy("k1", "k2", "start", "e").agg(F.min("q").alias("period"))
    return smallest.select("k1", "k2", "start", (F.col("e") - F.col("start")).alias("length"), "period")


def run_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli; null without
    one), and the digests of all runs and of the text without their repetitions."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def batch_of(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[] for _ in types]
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(cols, types)]], names)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            at, out = [], []
            for i, words, runs in _runs_of(batch.column(1).to_pylist(), tile):
                at.append(i)
                out.append(digests(words, runs))
            yield batch_of(batch.column(0).take(pa.array(at, pa.int64())), out)

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            at, out = [], []
            for i in range(batch.num_rows):
                words = words_of(batch.column(1)[i].as_py())
                if len(words) > tile:
                    at.append(i)
                    out.append(digests(words, [(r["start"], r["length"], r["period"]) for r in batch.column(2)[i].as_py() or []]))
            yield batch_of(batch.column(0).take(pa.array(at, pa.int64())), out)

    found = long_runs(rows, tile=tile).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    found = stored(found, "periodic-runs", compact=True)
    big = rows.filter(F.length("text") > 2 * tile).select("doc_id", "text", *_text_key(F.col("text")))
    joined = big.join(found, ["k1", "k2"], "left").select("doc_id", "text", "runs")
    schema = f"doc_id {kind}, {DIGEST}"
    return rows.mapInArrow(short, schema).unionByName(joined.mapInArrow(long, schema))


def document_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """One row per run of every document: doc_id, start, length, period (rows that repeat an id list theirs again)."""
    prepare(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(i, *r) for i, _, runs in _runs_of(batch.column(1).to_pylist(), tile) for r in runs]
            cols = np.array(got, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0])), *[pa.array(c) for c in cols[1:]]],
                                             ["doc_id", "start", "length", "period"])

    big = rows.filter(F.length("text") > 2 * tile).select("doc_id", *_text_key(F.col("text")))
    of_long = big.join(long_runs(rows, tile=tile), ["k1", "k2"]).select("doc_id", "start", "length", "period")
    return rows.mapInArrow(short, f"doc_id {kind}, {RUN}").unionByName(of_long)


def collapsed_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """``docs`` with each text of at least one run reduced to its kept words, joined by single spaces; other texts stay."""
    prepare(docs.sparkSession)
    body = F.col(f"`{text}`").cast("string")

    @F.pandas_udf("string")
    def short(texts):
        out = texts.copy()
        for i, words, runs in _runs_of(texts.tolist(), tile):
            if runs:
                out.iloc[i] = b" ".join(kept_words(words, runs)).decode("utf-8", "surrogatepass")
        return out

    @F.pandas_udf("string")
    def long(texts, runs):
        return texts.combine(runs, lambda t, r: t if r is None or not len(r) else b" ".join(
            kept_words(words_of(t), [(x["start"], x["length"], x["period"]) for x in r])).decode("utf-8", "surrogatepass"))

    found = stored(long_runs(docs, text, tile).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("start", "length", "period")).alias("_runs")), "periodic-runs", compact=True)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    brief = docs.filter(body.isNull() | (F.length(body) <= 2 * tile)).select(*others, short(body).alias(text))
    big = docs.filter(F.length(body) > 2 * tile).withColumn("_body", short(body)).select(
        *others, "_body", *[k.alias(f"_{n}") for k, n in zip(_text_key(body), ("k1", "k2"))])
    big = big.join(found.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_runs"), ["_k1", "_k2"], "left").select(
        *others, long(F.col("_body"), F.col("_runs")).alias(text))
    return brief.unionByName(big).select(*docs.columns)


def with_planted_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Test input of the query: in documents whose hash is divisible by 10, the words from position a on repeat
    the p words there (h = crc32 of the decimal id, g = h / 10, a = g % n, p = 1 + (n - a) / (3 + g % 8))."""
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0))
    rows = docs.withColumns({"_g": F.when(h % 10 == 0, g), "_words": F.when(h % 10 == 0, words)})
    n = F.size("_words")
    a = F.when(n > 0, F.col("_g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int")
    # whole slices, linear wherever the planner moves them
    period = F.slice("_words", a + 1, p)
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.when(n > 0, F.array_join(F.concat(F.slice("_words", F.lit(1), a), repeated), " ")).otherwise(F.col(f"`{text}`"))
    return rows.select(*[planted.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
