"""Fixity: inventories, digests, manifests, verification (S4, S10, S11, H1-H5, A18, J-1, J-7, J-8)."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import fixed
from tidepool.functions.hashing import fixity_line, mime_of, role_of, sha256_hex


def inventory(spark: SparkSession, root: str, prefix: str = "", skip=fixed.SKIP_FILES) -> DataFrame:
    """S4 + H1 + H3 + H4: every file under ``root`` (recursive) with size, digest, MIME type and role.

    ``prefix`` is the archive folder the root stands for (``raw/`` ...). The
    ``binaryFile`` source reads one file per row, so a single file must fit in
    a task's memory; that is this source's limit, not a hidden cap.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
    top = urlparse(root).path.rstrip("/") + "/"  # the reader shows paths with their scheme in front
    rel = F.concat(F.lit(prefix), F.substring(F.col("path"), F.locate(top, F.col("path")) + len(top), F.length("path")))
    out = files.where(~name.isin(*skip)).select(
        rel.alias("path"), F.col("length").alias("size_bytes"), sha256_hex(F.col("content")).alias("sha256")
    )
    return manifest_rows(out)


def manifest_rows(df: DataFrame, log_default: bool = False) -> DataFrame:
    """Add MIME type and role to ``(path, size_bytes, sha256)`` rows."""
    default = fixed.DEFAULT_LOG_MIME if log_default else fixed.DEFAULT_DATA_MIME
    return df.select("path", "sha256", "size_bytes", mime_of(F.col("path"), default).alias("format"),
                     role_of(F.col("path")).alias("role"))


def fixity_lines(manifest: DataFrame) -> DataFrame:
    """H5 + O1: BSD checksum lines in path order (a distributed sort)."""
    return manifest.select(fixity_line(F.col("path"), F.col("sha256")).alias("line")).orderBy("line")


def write_fixity(manifest: DataFrame, path: str) -> None:
    """The sorted lines as one text output (``orderBy`` keeps global order across part files)."""
    fixity_lines(manifest).write.mode("overwrite").text(path)


def totals(manifest: DataFrame, keys: list[Column | str] | None = None) -> DataFrame:
    """File count and bytes (by role, or overall)."""
    keys = keys or []
    return manifest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_files"), F.sum("size_bytes").cast("long").alias("total_bytes")
    )


def verify(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """J-8: compare a manifest with the files present now, by path.

    ``ok`` (same digest), ``changed``, ``missing`` (in manifest only) and
    ``extra`` (present only). A full outer join on the path; both sides are
    shuffled by path, so no side needs to fit in memory.
    """
    m = manifest.select("path", F.col("sha256").alias("_old"))
    c = current.select("path", F.col("sha256").alias("_new"))
    j = m.join(c, on="path", how="full_outer")
    status = (
        F.when(F.col("_new").isNull(), "missing").when(F.col("_old").isNull(), "extra")
        .when(F.col("_old") == F.col("_new"), "ok").otherwise("changed")
    )
    return j.select("path", status.alias("status"))


def expected_presence(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """J-1: each expected file is found by the base name of its source path, else by its name.

    ``expected``: ``keys + (name, source_path)``; ``present``: ``keys + (file_name)``.
    Two left equi-joins; presence by base name wins.
    """
    p = present.select(*keys, "file_name").distinct()
    base = F.regexp_extract(F.col("source_path"), r"([^/]+)$", 1)
    e = expected.withColumn("_base", base)
    by_base = p.select(*keys, F.col("file_name").alias("_base"), F.lit(True).alias("_b"))
    by_name = p.select(*keys, F.col("file_name").alias("name"), F.lit(True).alias("_n"))
    j = e.join(by_base, on=[*keys, "_base"], how="left").join(by_name, on=[*keys, "name"], how="left")
    matched = F.when(F.col("_b"), "source_path").when(F.col("_n"), "name")
    return j.select(
        *keys, "name", "source_path",
        F.coalesce(F.col("_b"), F.col("_n"), F.lit(False)).alias("file_exists"),
        matched.alias("matched_by"),
        F.when(F.col("_b"), F.col("_base")).when(F.col("_n"), F.col("name")).alias("raw_file"),
    )


def missing_artefacts(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """J-7: required artefacts (``keys + path, description``) absent from ``present`` (``keys + path``)."""
    return required.join(present.select(*keys, "path").distinct(), on=[*keys, "path"], how="left_anti")


def ingest_inventory(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Per configured file its original and archive path, formats, description, size, digest, role.

    ``expected``: ``name, source_path, format, target_format, description``;
    ``present``: ``source_path, size_bytes, sha256``. The target format falls
    back to the format; absent files keep null size and digest.
    """
    j = expected.join(present, on="source_path", how="left")
    archive = F.concat(F.lit("raw/"), F.col("name"))
    return j.select(
        F.col("source_path").alias("original_path"), archive.alias("archive_path"), "name", "format",
        F.coalesce(F.col("target_format"), F.col("format")).alias("target_format"), "description",
        "size_bytes", "sha256", role_of(archive).alias("role"),
    )


def write_manifest(spark: SparkSession, path: str, files: DataFrame, info: DataFrame | None = None) -> str:
    """A new manifest snapshot: earlier top-level keys kept, ``files`` replaced, totals added.

    A manifest is a folder of snapshots ``v=<n>`` holding ``files`` (Parquet)
    and ``info`` (key/value). The newest snapshot's keys are carried over,
    overridden by ``info``; totals come from a grouped count of ``files``.
    Returns the snapshot path.
    """
    import os

    from pyspark.sql.utils import AnalysisException

    try:
        prev = spark.read.parquet(f"{path}/info")
        latest = prev.agg(F.max("v")).first()[0]
        old = prev.where(F.col("v") == latest).select("key", "value")
        version = latest + 1
    except AnalysisException:
        old, version = None, 1
    tot = totals(files).select(F.col("total_files").cast("string").alias("f"), F.col("total_bytes").cast("string").alias("b"))
    totals_kv = tot.select(F.explode(F.array(
        F.struct(F.lit("total_files").alias("key"), F.col("f").alias("value")),
        F.struct(F.lit("total_bytes").alias("key"), F.coalesce(F.col("b"), F.lit("0")).alias("value")),
    )).alias("kv")).select("kv.*")
    new = totals_kv if info is None else info.select("key", "value").unionByName(totals_kv)
    merged = new if old is None else new.unionByName(old.join(new.select("key"), "key", "left_anti"))
    merged.withColumn("v", F.lit(version)).write.mode("append").partitionBy("v").parquet(f"{path}/info")
    snap = os.path.join(path, "files", f"v={version}")
    files.write.mode("overwrite").parquet(snap)
    return snap


class SnapshotConflict(RuntimeError):
    """Another writer published the same version first."""


def _mark(spark: SparkSession, path: str, name: str):
    """(file system, path) of a file that publishes a version, or of the folder that holds them."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/published", name) if name else \
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), mark


def _published(spark: SparkSession, path: str) -> dict[int, str]:
    """Version -> folder of each published snapshot: one small file a version, its only line names the folder."""
    fs, home = _mark(spark, path, "")
    if not fs.exists(home):
        return {}
    marks = spark.read.text(f"{path}/published").select(F.col("_metadata.file_name").alias("v"), "value").collect()
    return {int(r["v"]): r["value"] for r in marks if r["v"].isdigit()}


def _publish(spark: SparkSession, path: str, version: int, folder: str) -> None:
    """Create the version's file; creating it without leave to overwrite is the one step that decides who wins."""
    fs, mark = _mark(spark, path, str(version))
    try:
        out = fs.create(mark, False)
    except Exception as e:  # the gateway wraps whatever the file system raises
        if fs.exists(mark):
            raise SnapshotConflict(f"version {version} of {path} is published already") from e
        raise
    out.write(bytearray(folder.encode()))
    out.close()


def publish_manifest(spark: SparkSession, path: str, files: DataFrame, info: DataFrame | None = None,
                     base: int | None = None) -> int:
    """S10, atomic: write a snapshot apart, then publish it under the next version; returns the version.

    Keys of the snapshot it follows (``base``, by default the newest) are kept unless ``info`` has them; ``files`` is replaced, totals
    are added. ``files`` and ``info`` go to a folder of their own; readers see them only through the version's
    file, which is made last, so a failure in between leaves nothing to see. Of two writers that follow
    the same snapshot one publishes and the other gets :class:`SnapshotConflict`, and may try again. A writer lost
    within the last step leaves an empty version file, which readers pass over; removing it frees the version.
    """
    import uuid

    done = _published(spark, path)
    base = max(done, default=0) if base is None else base
    folder = f"snapshot-{uuid.uuid4().hex}"
    files.write.parquet(f"{path}/{folder}/files")
    written = spark.read.parquet(f"{path}/{folder}/files")
    tot = totals(written)
    kv = tot.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.coalesce(F.col(c), F.lit(0)).cast("string").alias("value"))
                                        for c in tot.columns])).alias("kv")).select("kv.*")
    new = kv if info is None else info.select("key", "value").unionByName(kv)
    if base:
        old = spark.read.parquet(f"{path}/{done[base]}/info")
        new = new.unionByName(old.join(new.select("key"), "key", "left_anti"))
    new.write.parquet(f"{path}/{folder}/info")
    _publish(spark, path, base + 1, folder)
    return base + 1


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(files, info)`` of a published snapshot, the newest unless ``version`` is given."""
    done = _published(spark, path)
    if not done:
        raise FileNotFoundError(f"no snapshot is published in {path}")
    folder = f"{path}/{done[max(done) if version is None else version]}"
    return spark.read.parquet(f"{folder}/files"), spark.read.parquet(f"{folder}/info")
