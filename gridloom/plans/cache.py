"""Content-keyed tables, stage manifests and drift.

A cache entry is a Parquet folder named by the digest of what it was made from; Spark's success
marker says whether it is whole.  A broken or half-written entry counts as none and is made anew.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSION = "1"
MANIFEST = "stage string, label string, fingerprint string, written double"


def stable_json(x: object) -> str:
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def key(**parts: object) -> str:
    """Digest of a configuration; lists whose order does not matter are to be sorted by the caller."""
    return hashlib.sha256(stable_json(parts | {"version": VERSION}).encode()).hexdigest()


def fingerprint(files: DataFrame) -> DataFrame:
    """``(fingerprint)`` of a table ``(path, content)`` of a folder: a digest of the files' names and digests in order."""
    each = files.select(F.element_at(F.split("path", "/"), -1).alias("n"), F.sha2("content", 256).alias("h"))
    return each.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "h"))), lambda x: F.concat(x["n"], F.lit("\0"), x["h"])), "\n").cast("binary"), 256).alias("fingerprint"))


def _shape(schema: StructType) -> str:
    return schema.simpleString()  # names and types: files hold every column as nullable


def digests(rows: DataFrame, key: str, *fields: str) -> DataFrame:
    """``(key, fingerprint)``: the SHA-256 of each key's rows, their fields joined by colons, in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*fields))), lambda x: F.concat_ws(":", *(x[f].cast("string") for f in fields)))
    return rows.groupBy(key).agg(F.sha2(F.array_join(parts, ",").cast("binary"), 256).alias("fingerprint"))


def regenerate(builders: dict[str, tuple[str, Callable[[], DataFrame]]], cache: Cache, only: set[str] | None = None) -> dict[str, str]:
    """Rebuild the entries ``name -> (digest, build)`` that are asked for; what was done for each: ``built`` or ``skipped``."""
    done = {}
    for name, (digest, build) in sorted(builders.items()):
        if only is not None and name not in only:
            done[name] = "skipped"
            continue
        cache.get_or_build(digest, build, rebuild=True)
        done[name] = "built"
    return done


class Reports:
    """Parity reports that may be used again: only after exit code 0, with the same key, and not in continuous integration."""

    def __init__(self, load: Callable[[], str | None], save: Callable[[str | None], None], ci: bool = False) -> None:
        self.load, self.save, self.ci = load, save, ci

    def reusable(self, digest: str) -> bool:
        try:
            meta = json.loads(self.load() or "null")
        except ValueError:
            return False
        return not self.ci and isinstance(meta, dict) and meta.get("key") == digest and meta.get("exit_code") == 0 and meta.get("version") == VERSION

    def run(self, digest: str, compare: Callable[[], int]) -> tuple[int, bool]:
        """Exit code, and whether it is that of a run before.  What was saved is forgotten before a run, so one that breaks off leaves nothing."""
        if self.reusable(digest):
            return 0, True
        self.save(None)
        code = compare()
        self.save(stable_json({"key": digest, "exit_code": code, "version": VERSION}))
        return code, False


class Cache:
    """Tables in ``folder`` by digest."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def get_or_build(self, digest: str, build: Callable[[], DataFrame], *, no_cache: bool = False, rebuild: bool = False, shape: StructType | None = None, verify: bool = False) -> DataFrame:
        """The entry, made by ``build`` if it is absent, its footers are broken or, where ``shape`` gives the schema expected, it is of another shape.

        ``verify`` reads all of it once, so that a broken data page counts, too.
        """
        if no_cache:
            return build()
        made = None
        if not rebuild and self._fs.exists(self._path(f"{self.folder}/{digest}/_SUCCESS")):
            try:
                found = self.spark.read.parquet(f"{self.folder}/{digest}")
                found.write.format("noop").mode("overwrite").save() if verify else None
            except (AnalysisException, Py4JError, SparkRuntimeException):  # an entry that cannot be read is no entry
                found = None
            if found is not None and (shape is None or _shape(found.schema) == _shape(shape)):
                return found
        made = build()
        made.write.mode("overwrite").parquet(f"{self.folder}/{digest}")
        return self.spark.read.schema(made.schema).parquet(f"{self.folder}/{digest}")

    def keys(self) -> list[tuple[str, int]]:
        """Digests with the times of their folders, newest first."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        found = [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(self._path(self.folder)) if s.isDirectory()]
        return sorted(found, key=lambda x: (-x[1], x[0]))

    def newest(self) -> DataFrame | None:
        for digest, _ in self.keys():
            if self._fs.exists(self._path(f"{self.folder}/{digest}/_SUCCESS")):
                return self.spark.read.parquet(f"{self.folder}/{digest}")
        return None

    def prune(self, keep: set[str]) -> list[str]:
        """Delete the entries that are not to be kept."""
        stale = sorted(k for k, _ in self.keys() if k not in keep)
        for k in stale:
            self._fs.delete(self._path(f"{self.folder}/{k}"), True)
        return stale


def record(spark: SparkSession, path: str, stage: str, fingerprints: dict[str, str]) -> None:
    """Append a stage's fingerprints to the manifest."""
    now = time.time()
    rows = [(stage, label, value, now) for label, value in sorted(fingerprints.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last fingerprint of each stage and label."""
    rows = spark.read.schema(MANIFEST).parquet(path)
    last = rows.groupBy("stage").agg(F.max("written").alias("written"))
    return rows.join(last, ["stage", "written"]).select("stage", "label", "fingerprint")


def drift(expected: DataFrame, current: DataFrame) -> DataFrame:
    """``(label, state)`` of labels that are ``missing`` now, ``unchecked`` before, or ``changed``; by label."""
    found = expected.select("label", F.col("fingerprint").alias("e")).join(current.select("label", F.col("fingerprint").alias("c")), "label", "full_outer")
    state = F.when(F.col("c").isNull(), "missing").when(F.col("e").isNull(), "unchecked").when(F.col("e") != F.col("c"), "changed")
    return found.select("label", state.alias("state")).where("state IS NOT NULL").orderBy("label")


def require(spark: SparkSession, path: str, stage: str) -> None:
    """Raise unless the manifest has the stage that comes before."""
    if manifest(spark, path).where(F.col("stage") == stage).isEmpty():
        raise ValueError(f"stage {stage} has not been run")


class Timer:
    """Times of stages; the file is written anew after each, so a run that breaks off leaves what it had."""

    def __init__(self, write: Callable[[str], None]) -> None:
        self.write, self.rows = write, []

    def run(self, stage: str, f: Callable[[], object], outcome: Callable[[object], str] = lambda _: "built") -> object:
        began = time.time()
        result = f()
        self.rows.append({"stage": stage, "seconds": time.time() - began, "outcome": outcome(result), "seq": len(self.rows)})
        self.write(stable_json({"stages": self.rows, "total": sum(r["seconds"] for r in self.rows)}))
        return result


def gathered(calls: list[Callable[[], object]], workers: int = 5, collect_errors: bool = False) -> list[object]:
    """Results of driver-side calls as they complete; the first error cancels the rest, or errors are results."""
    from concurrent.futures import ThreadPoolExecutor, as_completed

    with ThreadPoolExecutor(workers) as pool:
        found = {pool.submit(c): k for k, c in enumerate(calls)}
        out: list[object] = [None] * len(calls)
        for f in as_completed(found):
            try:
                out[found[f]] = f.result()
            except Exception as e:
                if not collect_errors:
                    for g in found:
                        g.cancel()
                    raise
                out[found[f]] = e
    return out
