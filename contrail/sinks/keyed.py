"""A keyed serving table kept by upsert, in hash buckets.

Layout below the table's path::

    data/c=<commit>/b=<bucket>/part-*.parquet   files of one bucket, written by one commit, never changed
    manifests/<version>.json                    what a version consists of

A manifest names, for every bucket, the commit that holds it, and the last batch of every
stream (the ledger). An upsert reads and rewrites the buckets that hold its keys; the others
keep their files. A version comes to be when its manifest is renamed into place, which
fails if another writer made that version first (the upsert is then done again on top of
it). So data and ledger change in one step: a job lost before the rename leaves the
previous version, and one lost after it has left nothing undone. The rename is atomic on HDFS and on a local
disk; a store without an atomic rename must have one writer at a time.

A batch of a stream that is at or below the stream's entry in the ledger was taken in
before, whatever other streams have written since, and is not taken in again.
:meth:`KeyedTable.expire` removes old versions and the files that no kept version names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.upsert import first_per_key, upsert
from contrail.session import scratch_path
from contrail.sinks.files import materialize
from contrail.sinks.paths import create_new, list_names, read_text, remove

BUCKETS = 32
SPREAD = 4  # tasks (and files) a bucket is written by, at most
ATTEMPTS = 20


class KeyedTable:
    """``buckets`` counts when the table is made; afterwards its own number holds."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = keys
        self.order = order
        self.buckets = buckets

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        """Versions, oldest first."""
        names = list_names(self.spark, f"{self.path}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int) -> dict:
        return json.loads(read_text(self.spark, self._manifest_path(version)))

    def read(self, version: int, only: list[int] | None = None) -> DataFrame:
        """The rows of a version (of the buckets ``only``, if given)."""
        m = self.manifest(version)
        held = {int(b): c for b, c in m["files"].items() if only is None or int(b) in only}
        paths = [f"{self.path}/data/c={c}/b={b}" for b, c in sorted(held.items())]
        schema = T.StructType.fromJson(m["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def current(self, versions: list[int] | None = None) -> DataFrame | None:
        vs = self.versions() if versions is None else versions
        return self.read(vs[-1]) if vs else None

    def last_batch(self, stream: str) -> int | None:
        """The stream's last batch that the newest version holds."""
        vs = self.versions()
        return self.manifest(vs[-1])["ledger"].get(stream) if vs else None

    def _bucket(self, n: int) -> F.Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(n)).cast("int")

    def upsert(self, updates: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Take ``updates`` in as a new version; return its number.

        ``batch`` is (stream name, batch number) when the updates are a stream's
        batch; if the ledger holds it already, the newest version's number is returned.
        """
        new = None
        for _ in range(ATTEMPTS):
            vs = self.versions()
            base = self.manifest(vs[-1]) if vs else None
            if base and batch and base["ledger"].get(batch[0], -1) >= batch[1]:
                return vs[-1]
            n = base["buckets"] if base else self.buckets
            if new is None:  # the updates are computed once, also if the commit must be tried again
                one = first_per_key(updates, self.keys, self.order).withColumn("_b", self._bucket(n))
                new = materialize(one, scratch_path(self.spark, "upsert"))
                touched = sorted(r["_b"] for r in new.select("_b").distinct().collect())  # at most n numbers
            commit = uuid.uuid4().hex
            if touched:
                self._write(new, vs[-1] if vs else None, base, touched, n, commit)
            ledger = dict(base["ledger"]) if base else {}
            if batch:
                ledger[batch[0]] = batch[1]
            version = vs[-1] + 1 if vs else 0
            made = {
                "buckets": n,
                "keys": self.keys,
                "schema": base["schema"] if base else json.loads(new.drop("_b").schema.json()),
                "files": {**(base["files"] if base else {}), **{str(b): commit for b in touched}},
                "ledger": ledger,
            }
            if create_new(self.spark, self._manifest_path(version), json.dumps(made)):
                return version
            remove(self.spark, f"{self.path}/data/c={commit}")  # another writer made this version; again on top of it
        raise RuntimeError(f"{self.path}: {ATTEMPTS} other versions were committed meanwhile")

    def _write(self, new: DataFrame, version: int | None, base: dict | None, touched: list[int], n: int, commit: str) -> None:
        """The touched buckets, with the updates taken in, as files of ``commit``."""
        updates = new.drop("_b")
        if base is None:
            rows = updates
        else:
            columns = [f["name"] for f in base["schema"]["fields"]]
            if sorted(columns) != sorted(updates.columns):
                raise ValueError(f"{self.path} holds the columns {columns}, the updates {updates.columns}")
            old = self.read(version, only=touched)
            typed = updates.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromJson(base["schema"])])
            rows = upsert(old, typed, self.keys, self.order)
        spread = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys], F.lit("spread")), F.lit(SPREAD))
        out = rows.withColumn("_b", self._bucket(n)).withColumn("b", F.col("_b"))
        out = out.repartition(F.col("_b"), spread).drop("_b")
        out.write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/data/c={commit}")

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` versions, and the files that no kept version names
        (those of lost jobs too, so no upsert may be under way). Returns the versions removed."""
        vs = self.versions()
        old, kept = vs[: -keep or None], vs[-keep:]
        for v in old:
            remove(self.spark, self._manifest_path(v))
        used = {(c, int(b)) for v in kept for b, c in self.manifest(v)["files"].items()}
        for name in list_names(self.spark, f"{self.path}/data"):
            for part in list_names(self.spark, f"{self.path}/data/{name}"):
                if part.startswith("b=") and (name[2:], int(part[2:])) not in used:
                    remove(self.spark, f"{self.path}/data/{name}/{part}")
            if not any(c == name[2:] for c, _ in used):
                remove(self.spark, f"{self.path}/data/{name}")
        return old
