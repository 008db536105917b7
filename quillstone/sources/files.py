"""Stored bytes, listings, pointers and archives as tables.

Fetching from remote hosts stays outside the engine: listings, archives and ref snapshots are landed files that Spark reads.
"""

from __future__ import annotations

import io
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.sources import schemas

#: Fixed value: how a large-file pointer begins.
POINTER = "version https://git-lfs.github.com/spec/v1"
HEAD = 512


def content(spark: SparkSession, folder: str, glob: str = "*", most_bytes: int | None = None) -> DataFrame:
    """(path, size, bytes) of the files below a folder laid out as ``pack/path``, with pack. Size filters reach the scan; unselected bytes are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    if most_bytes is not None:
        rows = rows.where(F.col("length") <= most_bytes)
    root = folder.rstrip("/").rpartition("://")[2]
    tail = F.regexp_replace(F.substring_index("path", root + "/", -1), "^/+", "")
    return rows.select(F.substring_index(tail, "/", 1).alias("pack"), F.regexp_replace(tail, "^[^/]*/", "").alias("path"), F.col("length").alias("size"), F.col("content").alias("bytes"))


def fingerprinted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sha256", F.sha2("bytes", 256)).withColumn("size", F.octet_length("bytes").cast("long"))


def lfs_pointer(content: Column) -> Column:
    """(oid, size) of a large-file pointer, from its first bytes; null for anything else."""
    head = content.substr(F.lit(1), F.lit(HEAD))
    text = F.make_valid_utf8(head.cast("string"))
    oid, size = F.regexp_extract(text, r"(?m)^oid sha256:([0-9a-f]{64})\s*$", 1), F.regexp_extract(text, r"(?m)^size (\d+)\s*$", 1)
    return F.when(F.startswith(content, F.lit(POINTER).cast("binary")) & (oid != "") & (size != ""), F.struct(oid.alias("oid"), size.cast("long").alias("size")))


def resolve_lfs(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """``rows`` (…, bytes) with pointers replaced by the objects (oid, object) they name; a wrong or missing object fails the job.

    The stored and the hashed bytes are the same value. Plain rows stay where they are: in the join, all of them would have the null key of one task.
    """
    pointer = lfs_pointer(F.col("bytes"))
    named = rows.where(pointer.isNotNull()).withColumn("oid__", pointer["oid"])
    joined = named.join(objects.select(F.col("oid").alias("oid__"), F.col("object").alias("object__")), "oid__", "left")
    right = F.sha2("object__", 256).eqNullSafe(F.col("oid__"))
    whole = F.when(right, F.col("object__")).otherwise(F.raise_error(F.concat(F.lit("object differs from its pointer: "), F.col("oid__"))).cast("binary"))
    return rows.where(pointer.isNull()).unionByName(joined.withColumn("bytes", whole).select(*rows.columns))


def tree(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """(path, sha) of the files in landed listings; a truncated listing fails the job, since absence could not be told from omission."""
    rows = spark.read.schema("truncated boolean, tree array<struct<path:string,type:string,sha:string>>").option("multiLine", True).json(path)
    whole = F.when(F.coalesce("truncated", F.lit(False)), F.raise_error(F.lit("truncated listing")).cast(rows.schema["tree"].dataType)).otherwise(F.col("tree"))
    entries = rows.select(F.explode(whole).alias("e")).where("e.type = 'blob'")
    return entries.select(F.concat(F.lit(prefix.strip("/") + "/" if prefix.strip("/") else ""), "e.path").alias("path"), "e.sha")


def _inside(archive: str, tar: tarfile.TarFile) -> Iterator[pa.RecordBatch]:
    """One row for each regular file of an archive; a row goes on as soon as it is read."""
    for k, m in enumerate(tar):
        _, slash, inner = m.name.partition("/")
        if m.isreg() and slash and inner:
            yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([k], pa.int64()), pa.array([inner]), pa.array([tar.extractfile(m).read()], pa.binary())], ["archive", "ordinal", "path", "bytes"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with tarfile.open(fileobj=io.BytesIO(raw), mode="r:*") as tar:
                yield from _inside(archive, tar)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            target, path = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", archive))
            with target.open_input_stream(path, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
                yield from _inside(archive, tar)


def tar_members(spark: SparkSession, path: str, most_bytes: int = 1 << 30) -> DataFrame:
    """(archive, ordinal, path, bytes) of the regular files in landed tar archives, without their first path component.

    Archives of more than ``most_bytes`` do not fit a cell; tasks read those as streams, a member at a time.
    """
    rows = spark.read.format("binaryFile").load(path)
    schema = "archive string, ordinal long, path string, bytes binary"
    small = rows.where(F.col("length") <= most_bytes).select("path", "content").mapInArrow(_members, schema)
    return small.unionByName(rows.where(F.col("length") > most_bytes).select("path").mapInArrow(_streamed, schema))


def blob_key(wanted: DataFrame) -> Column:
    """What a blob is cached under: its hash in the listing, else a hash of where it lies."""
    place = F.sha2(F.concat("repo", F.lit("@"), "commit", F.lit("/"), "path"), 256)
    return F.coalesce("sha", place)


def missing_blobs(wanted: DataFrame, objects: DataFrame) -> DataFrame:
    """(key, repo, commit, path): what has yet to be landed for ``wanted`` (ordinal, repo, commit, path, sha), each blob once however many paths name it. ``objects`` is (key, bytes)."""
    first = wanted.withColumn("key", blob_key(wanted)).groupBy("key").agg(F.min_by(F.struct("repo", "commit", "path"), "ordinal").alias("at"))
    return first.join(objects.select("key"), "key", "left_anti").select("key", "at.*")


def blobs(wanted: DataFrame, objects: DataFrame) -> DataFrame:
    """``wanted`` with the bytes of landed blobs; ordinal keeps the order that was asked for. A blob that is not landed fails the job."""
    rows = wanted.withColumn("key", blob_key(wanted)).join(objects.select("key", "bytes"), "key", "left")
    there = F.when(F.col("bytes").isNull(), F.raise_error(F.concat(F.lit("blob is not landed: "), "path")).cast("binary")).otherwise(F.col("bytes"))
    return rows.withColumn("bytes", there).drop("key")


def ref_snapshot(rows: DataFrame) -> DataFrame:
    """One commit for each (repo, ref): the first observed (column ordinal) wins, the lesser commit where two have its ordinal."""
    return rows.groupBy("repo", F.coalesce("ref", F.lit("HEAD")).alias("ref")).agg(F.min(F.struct("ordinal", "commit"))["commit"].alias("commit"))


def load_locks(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """pack, source and file tables of lock documents (whole JSON files)."""
    docs = spark.read.schema(schemas.LOCK).option("multiLine", True).json(path)
    pack = docs.select("pack.name", "pack.kind", "pack.summary", F.col("pack.mergeGroup").alias("merge_group"))
    lic = "s.license."
    tri = F.when(F.col(lic + "commercialUse") == "true", "yes").when(F.col(lic + "commercialUse") == "false", "no").otherwise("unknown")
    layers = F.transform(lic + "underlying", lambda x: F.struct(x["declared"].alias("declared"), x["declaredFrom"].alias("declared_from"), x["note"].alias("note"), x["snapshot"].alias("snapshot")))
    named = {"declared": "declared", "declaredScope": "declared_scope", "declaredFrom": "declared_from", "covers": "covers", "sourceCode": "source_code", "concluded": "concluded", "prohibition": "prohibition", "onwardUse": "onward_use"}
    license = F.struct(
        *[F.col(lic + a).alias(b) for a, b in named.items()], tri.alias("commercial_use"), F.coalesce(lic + "redistributable", F.lit(True)).alias("redistributable"),
        F.coalesce(lic + "derivatives", F.lit(True)).alias("derivatives"), F.coalesce(lic + "permissive", F.lit(False)).alias("permissive"), layers.alias("underlying"),
    )
    source = docs.select(F.col("pack.name").alias("pack"), F.posexplode("sources").alias("ordinal", "s")).select(
        "pack", "s.id", "ordinal", "s.kind", "s.repo", "s.ref", "s.commit", "s.url", "s.retrieved", F.coalesce("s.vendored", F.lit(True)).alias("vendored"), license.alias("license"),
        F.col("s.licenseSnapshot").alias("license_snapshot"), F.col("s.adjacentPath").alias("adjacent_path"), F.col("s.derivedFrom").alias("derived_from"),
    )
    kind = F.get_json_object("f.format", "$.kind")
    file = docs.select(F.col("pack.name").alias("pack"), F.explode("files").alias("f")).select(
        "pack", "f.path", F.col("f.sourceId").alias("source_id"), F.col("f.upstreamPath").alias("upstream_path"), "f.sha256", "f.size",
        F.when(kind.isNotNull(), F.struct(kind.alias("kind"), F.get_json_object("f.format", "$.version").alias("version"), F.col("f.format").alias("attrs"))).alias("format"),
        F.when(F.col("f.depicts").isNotNull(), F.struct("f.depicts.subject", F.col("f.depicts.rightsHolder").alias("rights_holder"), "f.depicts.status")).alias("depicts"), F.col("f.exclude").alias("exclude"),
        F.col("f.derivedFrom").alias("derived_from"), F.col("f.derivedFromSha256").alias("derived_from_sha256"), "f.strategy",
    )
    return {"pack": pack, "source": source, "file": file}
