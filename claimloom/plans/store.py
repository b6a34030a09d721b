"""The store on disk: versions of the tables, numbered manifests, and a lock with fencing."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.plans.files import files_at
from claimloom.sources.jsonl import write_jsonl

#: Of every version. Those with a key are kept in buckets by its hash, and a version writes only buckets that change.
TABLES = ["claims", "contradictions", "entities", "routes", "inventory", "pending"]
KEYS = {"claims": "id", "contradictions": "claim_id", "entities": "claim_id", "routes": "claim_id", "inventory": "path"}
LOCKS, MANIFESTS, MANIFEST = "locks", "manifests", "manifest.json"
STALE_LOCK_SECONDS = 2 * 3600


class LockHeld(RuntimeError):
    """Another run is at work."""


class LockLost(RuntimeError):
    """Another run has taken over, or has published since this one began."""


def bucket_of(key: str | Column, buckets: int) -> Column:
    """0 .. buckets - 1; rows without a key are in bucket 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("int")


class Store:
    """A folder reached through Spark's file systems.

    ``v=<run>/<table>`` are Parquet tables, ``v=<run>/views`` texts. ``manifests/<n>.json`` says which files the tables
    of version n consist of; the highest number is the current one. A manifest is created in one step, after everything
    it names, and never changed: who reads sees a whole version, and who crashes leaves the one before. ``manifest.json``
    is a copy for people.

    ``locks/<n>.json`` is the lock of the run that holds number n. The next one, a free lock's or a stale one's, is
    n + 1, and only one run can create it. Before a run publishes it makes sure its number is still the highest, and it
    can only create the manifest that follows the one it began with: of a run that was thought dead and the one that
    took over, one publishes.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.files = files_at(spark, self.path)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def read_text(self, name: str) -> str | None:
        return self.files.read(name)

    def write_text(self, name: str, text: str) -> None:
        """Whole or not at all: a sibling is written and takes the name in one step."""
        self.files.replace(name, text)

    def _numbers(self, folder: str) -> list[int]:
        """Numbers of a folder's JSON files, highest first."""
        found = (re.fullmatch(r"(\d+)\.json", n) for n in self.names(folder))
        return sorted((int(m[1]) for m in found if m), reverse=True)

    def _read(self, name: str) -> dict | None:
        try:
            found = json.loads(self.read_text(name) or "")
        except ValueError:
            return None
        return found if isinstance(found, dict) else None

    # --- versions -----------------------------------------------------------------------------------------------------

    def current(self) -> tuple[int, dict]:
        """The highest number there is, and the manifest of the highest that can be read."""
        numbers = self._numbers(MANIFESTS)
        for n in numbers:
            found = self._read(f"{MANIFESTS}/{n:012d}.json")
            if found is not None:
                return numbers[0], found
        return numbers[0] if numbers else 0, self._read(MANIFEST) or {}

    def manifest(self) -> dict:
        return self.current()[1]

    def publish(self, run_id: str, manifest: dict, after: int, lock: int) -> None:
        """The manifest that follows number ``after``, by who holds ``lock``."""
        self.fence(lock)
        text = json.dumps(manifest | {"version_dir": f"v={run_id}", "number": after + 1}, indent=1, sort_keys=True)
        if not self.files.create(f"{MANIFESTS}/{after + 1:012d}.json", text):
            raise LockLost("another run published since this one began")
        self.write_text(MANIFEST, text)

    # --- the lock -----------------------------------------------------------------------------------------------------

    def _holder(self) -> tuple[int, dict | None]:
        """The highest lock's number, and who holds it, if anyone does."""
        numbers = self._numbers(LOCKS)
        if not numbers:
            return 0, None
        n = numbers[0]
        if self.exists(f"{LOCKS}/{n:012d}.free"):
            return n, None
        name = f"{LOCKS}/{n:012d}.json"
        held = self._read(name)
        if held is None or "at" not in held:  # not written by this class: as old as its file
            held = {"run_id": None, "at": self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000}
        return n, held

    def held_by(self) -> dict | None:
        return self._holder()[1]

    def lock(self, run_id: str, now: float | None = None) -> int:
        """The number of a lock that no other run holds. One older than two hours is taken over."""
        now = time.time() if now is None else now
        number, held = self._holder()
        if held is not None and now - float(held["at"]) < STALE_LOCK_SECONDS:
            raise LockHeld(str(held.get("run_id")))
        if not self.files.create(f"{LOCKS}/{number + 1:012d}.json", json.dumps({"run_id": run_id, "at": now})):
            raise LockHeld(str((self.held_by() or {}).get("run_id")))
        # Numbers only grow: files of lower ones say nothing any more.
        for name in self.names(LOCKS):
            if re.match(r"\d{12}\.", name) and int(name[:12]) < number:
                self.delete(f"{LOCKS}/{name}")
        return number + 1

    def fence(self, lock: int) -> None:
        """Is ``lock`` still the last one?"""
        if self._holder()[0] != lock:
            raise LockLost("another run has taken over")

    def unlock(self, lock: int) -> None:
        self.files.create(f"{LOCKS}/{lock:012d}.free", "")

    # --- tables -------------------------------------------------------------------------------------------------------

    def save(self, run_id: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/v={run_id}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_buckets(self, run_id: str, name: str, df: DataFrame, buckets: int, changed: Sequence[int], before: dict[str, str]) -> dict[str, str]:
        """Write the ``changed`` buckets of a table (those of ``df`` alone) and return where each bucket is now, by its
        number as text; ``before`` is where they were. A bucket is dealt over as many tasks as there are for it."""
        after = {k: v for k, v in before.items() if int(k) not in set(changed)}
        if not changed:
            return after
        key, parts = KEYS[name], int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        lane = F.pmod(F.hash(F.col(key), F.lit(name)), F.lit(max(1, parts // len(changed))))
        rows = df.withColumn("bucket", bucket_of(key, buckets)).where(F.col("bucket").isin(*changed))
        rows.repartition(parts, "bucket", lane).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={run_id}/{name}")
        made = [n.removeprefix("bucket=") for n in self.names(f"v={run_id}/{name}") if n.startswith("bucket=")]
        return after | {b: f"v={run_id}" for b in made}

    def open(self, name: str, schema, where: dict[str, str] | None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a table whose buckets are at ``where``, of all buckets or ``only`` some."""
        paths = [f"{self.path}/{v}/{name}/bucket={b}" for b, v in sorted((where or {}).items()) if only is None or int(b) in set(only)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def save_lines(self, run_id: str, name: str, df: DataFrame) -> None:
        """The same rows as JSON lines, for readers that want them; null fields are written too."""
        write_jsonl(df, f"{self.path}/v={run_id}/{name}.jsonl")

    def write_view(self, name: str, head: str, lines: DataFrame) -> bool:
        """A text file of ``head`` and then, after an empty line, the ``lines`` as they lie in their partitions. Tasks write
        them, and the file system puts the parts together. Tells whether there were any."""
        lines.write.mode("overwrite").text(f"{self.path}/{name}.parts")
        parts = [f"{name}.parts/{n}" for n in self.names(f"{name}.parts") if n.startswith("part-")]
        parts = [p for p in parts if self._fs.getFileStatus(self._at(p)).getLen()]
        self.files.join(name, head + "\n" * bool(parts), parts)
        self.delete(f"{name}.parts")
        return bool(parts)

    def load(self, name: str, schema, manifest: dict | None = None) -> DataFrame:
        """A table of the current version, or of the version of ``manifest``; empty if there is none."""
        manifest = self.manifest() if manifest is None else manifest
        if name in manifest.get("files", {}):
            return self.open(name, schema, manifest["files"][name])
        version = manifest.get("version_dir")
        if not version or not self.exists(f"{version}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{version}/{name}")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete what none of the last ``keep`` manifests names: whole versions, and buckets written anew since.
        Returns what went. Readers of older versions must be done."""
        kept = [m for n in self._numbers(MANIFESTS)[:keep] if (m := self._read(f"{MANIFESTS}/{n:012d}.json"))]
        if not kept:
            return []
        whole = {m["version_dir"] for m in kept}
        used = {(v, name, b) for m in kept for name, where in m.get("files", {}).items() for b, v in where.items()}
        gone = []
        for version in (n for n in self.names("") if n.startswith("v=")):
            if version not in whole and not any(v == version for v, _, _ in used):
                gone.append(version)
                continue
            for name in set(KEYS) & set(self.names(version)):
                buckets = [n.removeprefix("bucket=") for n in self.names(f"{version}/{name}") if n.startswith("bucket=")]
                gone += [f"{version}/{name}/bucket={b}" for b in buckets if (version, name, b) not in used]
        for path in gone:
            self.delete(path)
        return gone

    def append(self, name: str, df: DataFrame, by: str | None = None) -> None:
        """Ledgers and logs: JSON lines, only ever added to."""
        writer = df.write.mode("append")
        (writer.partitionBy(by) if by else writer).json(f"{self.path}/{name}")

    def read_ledger(self, name: str, schema) -> DataFrame:
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.path}/{name}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def drop_version(self, run_id: str) -> None:
        self.delete(f"v={run_id}")

    def names(self, name: str) -> list[str]:
        """What lies in a folder, sorted."""
        if not self.exists(name):
            return []
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._at(name)))

    def keep_tables(self, run_id: str) -> None:
        """Of a version only what readers see: what the steps in between wrote goes."""
        for name in self.names(f"v={run_id}"):
            if name not in (*TABLES, "views", "warnings", "violations") and not name.endswith(".jsonl"):
                self.delete(f"v={run_id}/{name}")
