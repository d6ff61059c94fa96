"""File sources and sinks: JSON lines, texts, PDFs, run folders, manifests."""

from __future__ import annotations

import hashlib
import json
import platform
import subprocess
from collections.abc import Iterator
from importlib import metadata
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casequarry.schemas import schema


def exists(spark: SparkSession, path: str) -> bool:
    """Does a path exist in whatever store Spark reaches?  Globs count if they match."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(there)
    return found is not None and len(found) > 0


def request_log(spark: SparkSession, path: str) -> DataFrame:
    """A request log; malformed lines are dropped and a missing file is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema("request_log"))
    return spark.read.schema(schema("request_log")).option("mode", "DROPMALFORMED").json(path)


def strict_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """JSON lines of a declared table; a malformed line fails."""
    return spark.read.schema(schema(name)).option("mode", "FAILFAST").json(path)


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last by ``order``."""
    newest = rows.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("r"))
    return newest.select("r.*")


def first_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    oldest = rows.groupBy(key).agg(F.min_by(F.struct("*"), order).alias("r"))
    return oldest.select("r.*")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files, bad UTF-8 replaced."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", replaced(F.col("content")).alias("text"))


def _replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if b is None else b.decode("utf-8", "replace") for b in batch.to_pylist()], pa.string())


def replaced(content: Column) -> Column:
    """Bytes as text; what is not UTF-8 becomes the replacement character."""
    return F.arrow_udf(_replaced, StringType())(content)


def pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, sha1, is_pdf) of files; a PDF starts with %PDF."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    return files.select("path", "content", F.sha1("content").alias("sha1"), (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("is_pdf"))


def run_summaries(spark: SparkSession, runs: str) -> DataFrame:
    """meta and summaries of each run folder's summary.json; unreadable ones are skipped."""
    kind = "meta struct<run_id:string,timestamp:string,subset:string,n_docs:bigint,n_gold:bigint>, summaries map<string,struct<iou_mean:double,iou_ge_0_9:double,citation_support_mean:double,cost_usd_per_doc:double,latency_s_mean:double>>"
    path = f"{runs}/*/summary.json"
    if not exists(spark, path):
        return spark.createDataFrame([], kind)
    read = spark.read.schema(f"{kind}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return read.where("summaries is not null").select("meta", "summaries")


def write_failures(failures: DataFrame, path: str) -> None:
    """Failure records as JSON lines, a folder for each reason."""
    failures.write.mode("overwrite").partitionBy("reason").json(path)


def write_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_dataset(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("overwrite").partitionBy(*by).parquet(path)


def build_id(commit: str, params: dict[str, Any], at: str) -> str:
    """Twelve hex digits of SHA-256 over commit, parameters and time."""
    return hashlib.sha256(json.dumps([commit, params, at], sort_keys=True).encode()).hexdigest()[:12]


def manifest(commit: str, params: dict[str, Any], at: str, versions: dict[str, str] | None = None, dirty: bool | None = None) -> dict[str, Any]:
    """What a run was made with; ``dirty`` tells whether the working tree differed from the commit, None if that is not known."""
    return {"build_id": build_id(commit, params, at), "started_at": at, "commit": commit, "dirty": dirty, "params": params, "versions": versions or {}, "results": None}


def git_state(folder: str = ".") -> tuple[str | None, bool | None]:
    """Commit of a folder's checkout and whether its files differ from it; None where git or the checkout is missing."""

    def git(*words: str) -> str | None:
        try:
            done = subprocess.run(["git", "-C", folder, *words], capture_output=True, text=True, timeout=5, check=True)
        except (OSError, subprocess.SubprocessError):
            return None
        return done.stdout.strip()

    changes = git("status", "--porcelain")
    return git("rev-parse", "HEAD"), None if changes is None else changes != ""


def versions(packages: tuple[str, ...] = ("pyspark", "pyarrow", "pandas", "numpy")) -> dict[str, str]:
    """Versions of Python, the platform and packages; a package that is not there is named so."""
    found = {"python": platform.python_version(), "platform": platform.platform()}
    for name in packages:
        try:
            found[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            found[name] = "not installed"
    return found


def manifest_here(params: dict[str, Any], at: str, folder: str = ".") -> dict[str, Any]:
    """A manifest with this machine's versions and the state of the checkout."""
    commit, dirty = git_state(folder)
    return manifest(commit or "unknown", params, at, versions(), dirty)


def finished(record: dict[str, Any], at: str, results: dict[str, Any]) -> dict[str, Any]:
    return record | {"finished_at": at, "results": results}


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file in whatever store Spark reaches: written beside its place, then moved there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    there, beside = hadoop(path), hadoop(f"{path}.part")
    store = there.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    store.delete(there, False)
    if not store.rename(beside, there):
        raise OSError(f"cannot move {path}.part to its place")


def write_json(spark: SparkSession, value: Any, path: str) -> None:
    """A small record as one JSON file."""
    write_text(spark, json.dumps(value, indent=2, default=str), path)


def content_key(content: Column) -> Column:
    return F.sha1(content)
