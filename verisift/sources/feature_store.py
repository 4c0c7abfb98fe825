"""Versioned feature tables: parquet folders plus a manifest.

Every write goes to a folder of its own. A version exists once its manifest row is
written, so readers never see a half-written one and a failed write leaves the
previous version in place. The manifest has a file per version, which only one writer can
create: of two writers the later one takes the next version, and what it appends to is the
version of the other.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from verisift.sources.layout import Layout

MANIFEST = "version INT, parts ARRAY<STRING>, row_count BIGINT, written_at STRING"


def _manifest_path(root: str) -> str:
    return f"{root}/_manifest"


#: Seconds to wait for the row of a version that another writer has claimed.
CLAIM_SECONDS = 10.0


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def _claims(spark: SparkSession, manifest: str) -> dict[int, int]:
    """The claimed versions and the bytes of their rows, 0 until written."""
    system, target = _file_system(spark, manifest)
    if not system.exists(target):
        return {}
    found = {}
    for status in system.listStatus(target):
        name = re.fullmatch(r"version-(\d+)\.json", status.getPath().getName())
        if name:
            found[int(name[1])] = status.getLen()
    return found


def _claim(spark: SparkSession, manifest: str, version: int, row: dict) -> bool:
    """Write the version's row; false if the version belongs to another writer already."""
    system, target = _file_system(spark, f"{manifest}/version-{version}.json")
    system.mkdirs(target.getParent())
    try:
        if system.getUri().getScheme() == "file":
            # a local file system checks and creates in one step here only
            local = spark._jvm.java.io.File(target.toUri().getPath())
            if not local.createNewFile():
                return False
            out = system.create(target, True)
        else:
            out = system.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            return False
        raise
    out.write(bytearray((json.dumps(row) + "\n").encode()))
    out.close()
    return True


def feature_versions(spark: SparkSession, layout: Layout, domain: str, name: str) -> DataFrame:
    """The manifest: one row per version."""
    path = _manifest_path(layout.features(domain, name))
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(path)


def _entry(
    spark: SparkSession, layout: Layout, domain: str, name: str, version: int | None
) -> dict | None:
    entries = feature_versions(spark, layout, domain, name)
    if version is not None:
        entries = entries.where(F.col("version") == version)
    row = entries.orderBy(F.desc("version")).first()
    return row.asDict() if row else None


def _latest(spark: SparkSession, layout: Layout, domain: str, name: str) -> tuple[dict | None, int]:
    """The latest version's row and the highest claimed number.

    A claim without a row is waited for; if none comes its writer is gone and its number unused.
    """
    manifest = _manifest_path(layout.features(domain, name))
    until = time.monotonic() + CLAIM_SECONDS
    while True:
        claims = _claims(spark, manifest)
        entry = _entry(spark, layout, domain, name, None)
        highest = max([0, *claims, entry["version"] if entry else 0])
        if not claims.get(highest, 1) and time.monotonic() < until:
            time.sleep(0.05)
            continue
        return entry, highest


def _layout_mark(partition_by: Sequence[str]) -> str:
    """Parts with one mark have equal folders below and can be read together."""
    return "-" + hashlib.md5(",".join(partition_by).encode()).hexdigest()[:8] if partition_by else ""


def write_feature_table(
    df: DataFrame,
    layout: Layout,
    domain: str,
    name: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> int:
    """Write the next version and return its number.

    ``overwrite`` makes the version hold just these rows; ``append`` adds them to the
    rows of the version before, whose files are shared and not copied. Rows are written once,
    however often the version's number has to be tried.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    return _add_version(df, layout, domain, name, mode == "append", partition_by, None)


def _add_version(
    df: DataFrame, layout: Layout, domain: str, name: str, append: bool, partition_by: Sequence[str], after: int | None
) -> int | None:
    """Write the rows and claim a version; None if ``after`` is given and no longer the latest."""
    spark = df.sparkSession
    root = layout.features(domain, name)
    _, highest = _latest(spark, layout, domain, name)
    part = f"v={highest + 1}-{uuid.uuid4().hex[:8]}{_layout_mark(partition_by)}"
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    out.write.partitionBy(*partition_by).parquet(f"{root}/{part}")
    while True:
        previous, highest = _latest(spark, layout, domain, name)
        if after is not None and (previous is None or previous["version"] != after):
            return None
        kept = previous if append and previous else {"parts": [], "row_count": 0}
        row = {
            "version": highest + 1,
            "parts": [*kept["parts"], part],
            "row_count": kept["row_count"] + seen.get["rows"],
            "written_at": datetime.now(timezone.utc).isoformat(),
        }
        if _claim(spark, _manifest_path(root), highest + 1, row):
            return highest + 1


def compact_feature_table(
    spark: SparkSession, layout: Layout, domain: str, name: str, *, partition_by: Sequence[str] = ()
) -> int:
    """Rewrite the latest version as one part and return the new version.

    If another version appears meanwhile, that one is compacted instead.
    """
    while True:
        entry, _ = _latest(spark, layout, domain, name)
        if entry is None:
            raise ValueError(f"feature {domain}/{name} has no version")
        rows = read_feature_table(spark, layout, domain, name, version=entry["version"])
        done = _add_version(rows, layout, domain, name, False, partition_by, entry["version"])
        if done is not None:
            return done


def read_feature_table(
    spark: SparkSession,
    layout: Layout,
    domain: str,
    name: str,
    *,
    version: int | None = None,
) -> DataFrame:
    """A version of a feature table, the latest unless given: one scan of all its parts.

    A column that some parts lack is NULL there.
    """
    entry = _entry(spark, layout, domain, name, version)
    if entry is None:
        raise ValueError(f"feature {domain}/{name} has no version {version or ''}".rstrip())
    root = layout.features(domain, name)
    alike: dict[str, list[str]] = {}
    for part in entry["parts"]:
        alike.setdefault(part.partition("-")[2].partition("-")[2], []).append(f"{root}/{part}")
    # parts that are partitioned alike are read together
    frames = [spark.read.option("mergeSchema", "true").parquet(*paths) for paths in alike.values()]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged
