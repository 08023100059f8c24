"""SNK4, SNK7, STR5: a table that streams update by key, bucketed and rewritten by bucket.

Rows are dealt into a fixed number of buckets by a hash of their bucket columns.  A batch rewrites only the buckets
that its keys touch: their old rows without those keys, and the batch's rows.  A small manifest (one JSON
text, renamed into place) names for every bucket the folder that holds it, and the last batch.  Readers follow the newest
manifest, so they see a batch whole or not at all, and list as many folders as there are buckets, however old the stream is.

Batches come with rising numbers, as ``foreachBatch`` gives them.  A batch that the table already has changes nothing, and
``read(before=n)`` shows what batch n saw the first time; for that the manifest before the newest one is
kept, with its folders.  Everything older is removed after each batch.

The rename has to be atomic (HDFS and local file systems; on an object store, through its committer).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.materialize import drop_tables

BUCKET = "_bucket"


class UpsertTable:
    """The table below ``path``: one row for each value of ``keys``; ``by`` (a part of the keys) decides the bucket."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: list[str] | None = None, buckets: int = 64):
        self.spark, self.path, self.keys, self.by, self.buckets = spark, path.rstrip("/"), keys, by or keys, buckets
        jvm = spark.sparkContext._jvm
        self._place = jvm.org.apache.hadoop.fs.Path
        self._fs = self._place(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- manifests ---------------------------------------------------------

    def _versions(self) -> list[int]:
        folder = self._place(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _manifest(self, version: int) -> dict:
        place = f"{self.path}/manifest/v{version}.json"
        return json.loads(self.spark.read.text(place, wholetext=True).first()[0])

    def manifest(self, before: int | None = None) -> dict | None:
        """The newest manifest, or the newest of a batch earlier than ``before``."""
        for version in reversed(self._versions()):
            found = self._manifest(version)
            if before is None or found["batch"] < before:
                return found
        return None

    def _publish(self, version: int, content: dict) -> None:
        draft = self._place(f"{self.path}/manifest/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if not self._fs.rename(draft, self._place(f"{self.path}/manifest/v{version}.json")):
            raise RuntimeError(f"manifest {version} of {self.path} was written by another stream")

    # -- rows --------------------------------------------------------------

    def bucket_of(self):
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _read(self, manifest: dict, only: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        folders = [f for b, f in manifest["folders"].items() if only is None or int(b) in only]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def read(self, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """All rows (of the buckets ``only``), or None while no batch (earlier than ``before``) has been written."""
        manifest = self.manifest(before)
        return None if manifest is None else self._read(manifest, only)

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that the rows' ``by`` columns fall in: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket_of()).distinct().collect())

    def upsert(self, rows: DataFrame, batch: int) -> bool:
        """Write the rows of ``batch`` (one for each key) over those of equal keys; False where the table has that batch."""
        versions = self._versions()
        last = self._manifest(versions[-1]) if versions else None
        if last is not None and last["batch"] >= batch:
            return False
        touched = self.buckets_of(rows)
        folders = dict(last["folders"]) if last else {}
        if touched:
            name = f"{batch}-{uuid.uuid4().hex}"
            new = rows.withColumn(BUCKET, self.bucket_of())
            if last is not None:
                old = self._read(last, touched).join(rows.select(*self.keys), self.keys, "left_anti")
                new = new.unionByName(old.withColumn(BUCKET, self.bucket_of()))
            # a bucket's rows meet in one task and make one file
            new.repartition(min(len(touched), 4 * self.spark.sparkContext.defaultParallelism), BUCKET) \
                .write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
            folders.update({str(b): f"{name}/{BUCKET}={b}" for b in touched})
        version = versions[-1] + 1 if versions else 0
        self._publish(version, {"batch": batch, "folders": folders, "schema": json.loads(rows.schema.json())})
        self._clean(versions[:-1], [folders, *([last["folders"]] if last else [])])
        return True

    def _clean(self, versions: list[int], live: list[dict]) -> None:
        """Remove manifests that no reader needs, and folders that no manifest names."""
        drop_tables(self.spark, [f"{self.path}/manifest/v{v}.json" for v in versions])
        named = {f for folders in live for f in folders.values()}
        whole = {f.split("/")[0] for f in named}
        data = self._place(f"{self.path}/data")
        if not self._fs.exists(data):
            return
        for write in self._fs.listStatus(data):
            name = write.getPath().getName()
            if name not in whole:
                self._fs.delete(write.getPath(), True)
                continue
            for part in self._fs.listStatus(write.getPath()):
                if part.getPath().getName().startswith(BUCKET) and f"{name}/{part.getPath().getName()}" not in named:
                    self._fs.delete(part.getPath(), True)

    def files(self) -> int:
        """Data files that a read of the newest manifest lists."""
        manifest = self.manifest()
        if manifest is None:
            return 0
        return sum(1 for f in manifest["folders"].values() for s in self._fs.listStatus(self._place(f"{self.path}/data/{f}"))
                   if s.getPath().getName().endswith(".parquet"))
