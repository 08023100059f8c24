"""WARC archives with a two-level capture index.

``write_archives`` turns pages into WARC/1.1 records, one gzip member each, in
archive files of bounded size.  Payloads are deduplicated by SHA-1: of the
records with equal payloads (of at least ``min_bytes``) the one with the smallest
page_id is a ``response``, the others are ``revisit`` records that keep the HTTP
header (with the payload's length) and refer to the response by its id and its target URI.
Readers find that response through the index: a revisit is ``intact`` where an intact response of
that id has its digest and length, and its payload is the response's.

The capture index is built as in large web archives: keys are URLs with the host
reversed (``com,example,www)/path``), sorted globally by range partitioning, cut
into blocks of ``block_lines`` entries and compressed; a sparse directory keeps the first and
last key, file, offset and length of every block.  ``lookup`` binary-searches the
directory, range-reads and binary-searches one block per key, and range-reads the
records, and does the same for the target URIs of revisits whose responses are not among
them; ``read_all`` reads every block of the directory and then every archive in
ranges that cover neighbouring records.

Scale: the payloads are shuffled at most once, in the join with the table of
repeated digests (which adaptive execution broadcasts when it is small, and whose
hot keys it splits).  The index sort moves entries only.  Tasks stream records;
files carry the name of the attempt that wrote them and only files named by the
stored manifest are ever read, so a task lost half-way leaves no wrong data.
Archives, index and manifest lie in the shared folder and are opened with
``pyarrow.fs`` by URI.

Defined results: a null payload is the empty payload; a null url has the empty key;
rows that share the smallest page_id of their payload are all responses; a null page_id
comes last and a payload that has no other is a response; equal urls are separate
captures; an empty table writes no archive; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastespark.llm.common import parallelism, prepare, scratch_folder, stored

#: An archive file is closed once it has this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Neighbouring records are read together up to this many bytes.
READ_BYTES = 4 << 20

ENTRY = "key string, page_id bigint, url string, file string, offset bigint, length bigint"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, refers_to_url string, intact boolean")


# -- keys and records ----------------------------------------------------------

def target_uri(url: str | None) -> str:
    """The URL as records write it: without white space at its ends, control characters and spaces escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", (url or "").strip())


def capture_key(url: str | None) -> str:
    """The target URI with its host reversed: scheme, user, default port and fragment dropped.  A URL and its target
    URI have one key."""
    url = target_uri(url)
    if not url:
        return ""
    try:
        u = urlsplit(url)
        host, port = (u.hostname or "").rstrip("."), u.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    port = "" if port in (None, 80, 443) else f":{port}"
    reverse = host if re.fullmatch(r"[0-9.]+|.*:.*", host) else ",".join(reversed(host.split(".")))
    return f"{reverse}{port}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 refers_to_url: str | None, revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target_uri(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head[5:5] = [f"WARC-Refers-To: {record_uri(refers_to)}", f"WARC-Refers-To-Target-URI: {target_uri(refers_to_url)}",
                     f"WARC-Refers-To-Date: {date}",
                     "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    data = "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(member: bytes) -> dict:
    """Headers, HTTP headers and payload of a record; ``intact``: lengths and digest hold (a revisit has no payload of
    its own to hold them against; ``resolved`` does that with its response)."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = revisit or (len(payload) == length and base32_sha1(hashlib.sha1(payload).digest()) == digest)
    return {"page_id": page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload": payload,
            "payload_bytes": length, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": page_of(fields.get("WARC-Refers-To")), "refers_to_url": fields.get("WARC-Refers-To-Target-URI"),
            "intact": whole and rest[len(block):] == b"\r\n\r\n"}


# -- files -------------------------------------------------------------------

def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI or absolute path."""
    if re.match(r"file:/", uri) or "://" not in uri:
        return pyarrow.fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return pyarrow.fs.FileSystem.from_uri(uri)


class Files:
    """Open files of one task for range reads; at most a few stay open."""

    def __init__(self) -> None:
        self.open: dict[str, pyarrow.NativeFile] = {}

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri not in self.open:
            if len(self.open) >= 8:
                self.open.pop(next(iter(self.open))).close()
            fs, path = open_store(uri)
            self.open[uri] = fs.open_input_file(path)
        f = self.open[uri]
        f.seek(offset)
        return f.read(length)


@dataclass
class Store:
    """Folders of one written archive set."""

    root: str

    @property
    def archives(self) -> str:
        return f"{self.root}/archives"

    @property
    def index(self) -> str:
        return f"{self.root}/index"

    @property
    def directory(self) -> str:
        return f"{self.root}/directory"


def _task_file(folder: str, suffix: str):
    """A new file of this attempt: (uri, stream)."""
    uri = f"{folder}/part-{uuid.uuid4().hex}.{suffix}"
    fs, path = open_store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, fs.open_output_stream(path, compression=None)


def _frame(rows: list, names: list[str], ids: tuple[str, ...]) -> pd.DataFrame:
    """Rows as a frame; ``ids`` beside nulls keep their value (they would pass through floating point numbers)."""
    pdf = pd.DataFrame(rows, columns=names, dtype=object)
    return pdf.assign(**{c: pd.array(pdf[c].tolist(), dtype="Int64") for c in ids})


def _entry_frame(rows: list) -> pd.DataFrame:
    return _frame(rows, ["key", "page_id", "url", "file", "offset", "length"], ("page_id",))


# -- writing -----------------------------------------------------------------

def record_plan(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """page_id, url, payload, digest (hex), revisit, refers_to, refers_to_url."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    # the smallest page_id with its url; rows that share it are all responses, and the smallest of their urls names them
    named = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("m")
    repeated = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        named, F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("digest").alias("d"), F.col("m.page_id").alias("first"), F.col("m.url").alias("first_url"))
    j = rows.join(repeated, F.col("digest") == F.col("d"), "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return j.select("page_id", "url", "payload", "digest", revisit.alias("revisit"),
                    F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_to_url"))


def write_archives(pages: DataFrame, root: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, block_lines: int = 2000, date: str = "2000-01-01T00:00:00Z") -> Store:
    """Write archives, index and directory below ``root`` (default: a new folder in the shared one)."""
    spark = pages.sparkSession
    prepare(spark)
    store = Store(root or scratch_folder(spark, "warc"))
    archives, index = store.archives, store.index

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uri = out = None
        at = 0
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                page = None if r.page_id is None else int(r.page_id)
                first = None if r.refers_to is None else int(r.refers_to)
                data = record_bytes(page, r.url, bytes(r.payload), base32_sha1(bytes.fromhex(r.digest)), first, r.refers_to_url,
                                    bool(r.revisit), date)
                if out is None:
                    uri, out = _task_file(archives, "warc.gz")
                    at = 0
                out.write(data)
                rows.append((capture_key(r.url), page, r.url, uri, at, len(data)))
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield _entry_frame(rows)
        if out is not None:
            out.close()

    # ids pass through Python as strings: long ids beside nulls would become floating point numbers
    plan = record_plan(pages, page_id, url, html, min_bytes).withColumns(
        {c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    entries = stored(plan.mapInPandas(write, ENTRY), "warc-entries")

    def write_index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uri = out = None
        at, pending = 0, []

        def block(lines: list[tuple]) -> tuple:
            nonlocal uri, out, at
            if out is None:
                uri, out = _task_file(index, "idx")
            data = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode("utf-8"), 6)
            out.write(data)
            at += len(data)
            return lines[0][0], lines[-1][0], uri, at - len(data), len(data), len(lines)

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                pending.append((r.key, r.page_id or "", r.file, r.offset, r.length))
            made = [block(pending[i:i + block_lines]) for i in range(0, len(pending) - block_lines + 1, block_lines)]
            pending = pending[len(made) * block_lines:]
            yield pd.DataFrame(made, columns=["first_key", "last_key", "file", "offset", "length", "n"])
        if pending:
            yield pd.DataFrame([block(pending)], columns=["first_key", "last_key", "file", "offset", "length", "n"])
        if out is not None:
            out.close()

    key = F.regexp_replace("key", "[\t\n\r]", " ").alias("key")
    ordered = entries.select(key, "page_id", "file", "offset", "length").repartitionByRange(
        parallelism(spark), "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    ordered.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(write_index, "first_key string, last_key string, file string, offset bigint, length bigint, n bigint") \
        .write.parquet(store.directory)
    return store


# -- reading -----------------------------------------------------------------

def _block_entries(files: Files, file: str, offset: int, length: int) -> list[list[str]]:
    return [x.split("\t") for x in zlib.decompress(files.read(file, offset, length)).decode("utf-8").split("\n")]


def index_entries(spark: SparkSession, store: Store) -> DataFrame:
    """Every entry of the index, by the directory: one range read per block."""
    prepare(spark)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = Files()
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                yield _entry_frame([(k, int(p) if p else None, None, f, int(o), int(n)) for k, p, f, o, n in
                                    _block_entries(files, b.file, int(b.offset), int(b.length))])

    blocks = spark.read.schema("first_key string, last_key string, file string, offset bigint, length bigint, n bigint").parquet(store.directory)
    # a block stands for thousands of records: deal blocks out evenly
    return blocks.repartition(parallelism(spark), "file", "offset").mapInPandas(read, ENTRY)


def read_records(entries: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of index entries, revisits as they stand.  Entries are dealt by archive stretch and sorted by offset, so
    that neighbouring records come with one range read."""
    spark = entries.sparkSession

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = Files()
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "refers_to_url", "intact"] + ["payload"] * with_payload
        for pdf in batches:
            spans = list(zip(pdf["file"], pdf["offset"].astype(int), pdf["length"].astype(int)))
            i, out = 0, []
            while i < len(spans):
                file, start, n = spans[i]
                end, j = start + n, i + 1
                while j < len(spans) and spans[j][0] == file and start <= spans[j][1] <= end and spans[j][1] + spans[j][2] - start <= READ_BYTES:
                    end = max(end, spans[j][1] + spans[j][2])
                    j += 1
                data = files.read(file, start, end - start)
                for _, o, m in spans[i:j]:
                    r = parse_record(data[o - start:o - start + m])
                    out.append([r[k] for k in names])
                i = j
                if len(out) >= 500:
                    yield _frame(out, names, ("page_id", "refers_to"))
                    out = []
            if out:
                yield _frame(out, names, ("page_id", "refers_to"))

    stretch = F.floor(F.col("offset") / (4 * READ_BYTES))
    dealt = entries.withColumn("_stretch", stretch).repartition(parallelism(spark), "file", "_stretch").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInPandas(read, RECORD + ", payload binary" * with_payload)


def resolved(records: DataFrame, responses: DataFrame) -> DataFrame:
    """``records`` with every revisit held against the response that it refers to, found among ``responses``: intact where
    an intact response of that id has the same digest and length, with that response's payload (null where there is none)."""
    revisits = records.filter("record_type = 'revisit'")
    same = (F.col("_id") == F.col("refers_to")) & (F.col("_digest") == F.col("payload_digest"))
    payload = "payload" in records.columns
    asked = revisits.select(F.col("refers_to").alias("_id"), F.col("payload_digest").alias("_digest")).distinct()
    # only what is referred to, written: a join with it is dealt by measured sizes and splits the copies of one payload
    first = stored(responses.filter("record_type = 'response' AND intact").select(
        F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"),
        *[F.col("payload").alias("_payload")] * payload).join(asked, ["_id", "_digest"], "left_semi").dropDuplicates(["_id", "_digest"]),
        "warc-responses")
    whole = F.col("intact") & F.coalesce(F.col("_bytes") == F.col("payload_bytes"), F.lit(False))
    made = {"intact": whole.alias("intact"), "payload": F.col("_payload").alias("payload") if payload else None}
    held = revisits.join(first, same, "left").select(*[made.get(c, F.col(c)) for c in records.columns])
    return records.filter("record_type <> 'revisit'").unionByName(held)


def read_all(spark: SparkSession, store: Store, with_payload: bool = False) -> DataFrame:
    """Every record of the archives, found through the index; revisits with their responses."""
    records = stored(read_records(index_entries(spark, store), with_payload), "warc-records")
    return resolved(records, records)


def captures(store: Store, urls: DataFrame, url: str = "url") -> DataFrame:
    """The index entries of each distinct url of ``urls``; several urls of a batch or of different batches may share a key."""
    return found_entries(store, urls, url).dropDuplicates(["file", "offset"])


def found_entries(store: Store, urls: DataFrame, url: str = "url") -> DataFrame:
    """Index entries of the distinct urls of ``urls``, by binary search and range reads.

    Keys are range-partitioned and sorted, so a task opens the directory once and loads for each batch only the rows
    between its smallest and largest key (filtered in the Parquet scan).  What it finds are (key, block) pairs, dealt
    again by block: the captures of one url that very many pages share lie in many blocks, and each block is
    read once, by one task, its entries given out in bounded frames.
    """
    spark = urls.sparkSession
    prepare(spark)
    directory = store.directory

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = open_store(directory)
        whole = None
        for pdf in batches:
            keys = sorted({capture_key(u) for u in pdf["url"]})
            if not keys:
                continue
            field = pyarrow.dataset.field
            whole = pyarrow.dataset.dataset(path, filesystem=fs, format="parquet") if whole is None else whole
            part = whole.to_table(filter=(field("last_key") >= keys[0]) & (field("first_key") <= keys[-1])).to_pandas()
            part = part.sort_values(["first_key", "last_key", "offset"], kind="stable")
            lasts, firsts = part["last_key"].tolist(), part["first_key"].tolist()
            where = list(zip(part["file"], part["offset"], part["length"]))
            pairs = []
            for k in keys:
                b = bisect.bisect_left(lasts, k)
                while b < len(lasts) and firsts[b] <= k:
                    pairs.append((k, *where[b]))
                    b += 1
            yield pd.DataFrame(pairs, columns=["key", "file", "offset", "length"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by block and key; a block stays open until the next one begins."""
        files, at, held, last, rows = Files(), None, [], None, []
        for pdf in batches:
            for k, file, offset, length in zip(pdf["key"], pdf["file"], pdf["offset"], pdf["length"]):
                if at != (file, offset):
                    held, at, last = _block_entries(files, file, int(offset), int(length)), (file, offset), None
                if k == last:
                    continue
                last = k
                i = bisect.bisect_left(held, k, key=lambda x: x[0])
                while i < len(held) and held[i][0] == k:
                    _, p, f, o, n = held[i]
                    rows.append((k, int(p) if p else None, None, f, int(o), int(n)))
                    i += 1
                if len(rows) >= 5000:
                    yield _entry_frame(rows)
                    rows = []
        if rows:
            yield _entry_frame(rows)

    wanted = urls.select(F.col(f"`{url}`").cast("string").alias("url")).distinct()
    host = F.reverse(F.split(F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1)), r"\."))
    near = wanted.withColumn("_host", F.array_join(host, ",")).repartitionByRange(parallelism(spark), "_host", "url")
    blocks = near.sortWithinPartitions("_host", "url").select("url").mapInPandas(find, "key string, file string, offset bigint, length bigint")
    dealt = blocks.repartition(parallelism(spark), "file", "offset").sortWithinPartitions("file", "offset", "key")
    return dealt.mapInPandas(read, ENTRY)


def lookup(store: Store, urls: DataFrame, url: str = "url", with_payload: bool = True) -> DataFrame:
    """The captures of each distinct url of ``urls``: their records, revisits with their responses.  Responses that are not
    among the records are looked up by the revisits' ``refers_to_url``."""
    records = stored(read_records(captures(store, urls, url), with_payload), "warc-found")
    have = records.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest")
    asked = records.filter("record_type = 'revisit'").select("refers_to", "payload_digest", "refers_to_url").distinct()
    missing = stored(asked.join(have, ["refers_to", "payload_digest"], "left_anti"), "warc-missing")
    if missing.isEmpty():
        return resolved(records, records)
    entries = captures(store, missing, "refers_to_url").join(
        missing.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi")
    return resolved(records, records.unionByName(read_records(entries, with_payload)))
