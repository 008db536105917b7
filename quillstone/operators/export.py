"""Deterministic archives of pack variants, with their manifest, notices and index."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import subprocess
import tarfile
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.paths import basename
from quillstone.operators import integrity, variants

#: Later kinds of members replace earlier ones of the same name.
PRECEDENCE = {"asset": 0, "spdx": 1, "snapshot": 2, "adjacent": 3, "underlying": 4, "manifest": 5, "notice": 6, "readme": 7}
GZIP_LEVEL, MODE = 6, 0o644


def _member(rows: DataFrame, name: Column, kind: str) -> DataFrame:
    return rows.select("pack", "variant", name.alias("name"), F.lit(PRECEDENCE[kind]).alias("precedence"), "bytes")


def overwrite_wins(members: DataFrame) -> DataFrame:
    """One member for each name: that of the highest precedence."""
    order = Window.partitionBy("pack", "variant", "name").orderBy(F.desc("precedence"), F.sha2("bytes", 256))
    return members.withColumn("rank__", F.row_number().over(order)).where("rank__ = 1").drop("rank__", "precedence")


def notice_rows(source: DataFrame, kept: DataFrame) -> DataFrame:
    """(pack, variant, source_id, files, repo, commit, retrieved, url, license, license_snapshot): what a notice says of each used source."""
    counts = kept.groupBy("variant", "pack", F.col("source_id").alias("id")).agg(F.count("*").alias("files"))
    return counts.join(source, ["pack", "id"]).withColumnRenamed("id", "source_id")


def notice_text(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(pack, variant, bytes): the notice of each variant, sources by id, then depicted subjects by path."""
    lic = F.col("license")
    line = lambda when, *parts: F.when(when, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    layers = F.transform(F.coalesce(lic["underlying"], F.array().cast(rows.schema["license"].dataType["underlying"].dataType)), lambda x: F.concat(F.lit("- Underlying instrument: **"), x["declared"], F.lit("**\n  - "), F.coalesce(x["note"], F.lit(""))))
    snapshot = F.col("license_snapshot") if "license_snapshot" in rows.columns else F.lit(None).cast("string")
    body = F.concat_ws(
        "\n", line(F.lit(True), "## ", F.col("source_id"), "  (", F.col("files").cast("string"), " files)\n"), line(F.col("repo").isNotNull(), "- Source: `", F.col("repo"), "` @ `", F.coalesce("commit", F.lit("-")), "`"),
        line(F.col("url").isNotNull(), "- Retrieved from: ", F.col("url")), line(F.lit(True), "- Retrieved: ", F.coalesce("retrieved", F.lit("unknown"))),
        line(F.lit(True), "- Declared licence: **", lic["declared"], "** (scope: ", F.coalesce(lic["declared_scope"], F.lit("-")), ")"), line(lic["declared_from"].isNotNull(), "- Declared in: `", lic["declared_from"], "`"),
        line(snapshot.isNotNull(), "- Licence text: `LICENSES/", basename(snapshot), "`"), line(lic["covers"].isNotNull(), "- Covers: ", lic["covers"]),
        line(lic["commercial_use"] == "no", "- **Commercial use: not permitted.**"), line(lic["commercial_use"] == "unknown", "- Commercial use: unknown"),
        line(lic["source_code"].isNotNull(), "- Corresponding source: ", lic["source_code"]), F.array_join(layers, "\n"),
    )
    parts = rows.groupBy("pack", "variant").agg(F.array_sort(F.collect_list(F.struct("source_id", F.rtrim(body).alias("text")))).alias("parts"))  # sources of a pack: metadata
    shown = kept.where("depicts is not null").groupBy("pack", "variant").agg(F.array_sort(F.collect_list(F.struct("path", F.concat(F.lit("- `"), "path", F.lit("` — "), F.coalesce("depicts.subject", F.lit("-")), F.lit(" ("), F.coalesce("depicts.rights_holder", F.lit("rights holder unknown")), F.lit(")")).alias("text")))).alias("shown"))
    text = F.concat(
        F.lit("# Attribution — "), "pack", F.lit("\n\n"), F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n"),
        F.when(F.col("shown").isNotNull(), F.concat(F.lit("\n\n## Third-party subject matter\n\n"), F.array_join(F.transform("shown", lambda p: p["text"]), "\n"))).otherwise(F.lit("")), F.lit("\n"),
    )
    return parts.join(shown, ["pack", "variant"], "left").select("pack", "variant", F.encode(text, "UTF-8").alias("bytes"))


def readme_text(pack: DataFrame, source: DataFrame, kept: DataFrame) -> DataFrame:
    """(pack, variant, bytes): totals, and sections for merge groups and for material that is not for commercial use."""
    totals = kept.groupBy("pack", "variant").agg(F.count("*").alias("files"), F.sum("size").alias("size"))
    used = kept.select("pack", "variant", "source_id").distinct().join(source.select("pack", F.col("id").alias("source_id"), F.col("license.commercial_use").alias("use")), ["pack", "source_id"])
    closed = used.groupBy("pack", "variant").agg(F.bool_or(F.col("use") == "no").alias("closed"))
    rows = totals.join(closed, ["pack", "variant"]).join(pack.select(F.col("name").alias("pack"), "summary", "merge_group"), "pack")
    text = F.concat(
        F.lit("# "), "pack", F.lit(" ("), "variant", F.lit(")\n\n"), F.coalesce("summary", F.lit("")), F.lit("\n\n"), F.format_string("%d files, %.2f MB\n", F.col("files"), F.col("size") / 1e6),
        F.when(F.col("merge_group").isNotNull(), F.concat(F.lit("\n## Merge group\n\nUnpack beside the other packs of `"), "merge_group", F.lit("`.\n"))).otherwise(F.lit("")),
        F.when(F.col("closed"), F.lit("\n## Not for commercial use\n\nSome sources forbid commercial use; NOTICE.md names them.\n")).otherwise(F.lit("")),
    )
    return rows.select("pack", "variant", F.encode(text, "UTF-8").alias("bytes"))


def manifests(source: DataFrame, kept: DataFrame) -> DataFrame:
    """(pack, variant, bytes): used sources, kept files and totals as JSON; absent keys are left out, not null."""
    entry = F.struct("path", F.col("source_id").alias("sourceId"), "sha256", "size", "format", "depicts", F.col("derived_from").alias("derivedFrom"), "strategy")
    files = kept.groupBy("pack", "variant").agg(F.array_sort(F.collect_list(F.struct("path", F.to_json(entry).alias("json")))).alias("files"), F.count("*").alias("n"), F.sum("size").alias("size"))
    used = kept.select("pack", "variant", F.col("source_id").alias("id")).distinct().join(source, ["pack", "id"]).groupBy("pack", "variant").agg(F.array_sort(F.collect_list(F.struct("id", F.to_json(F.struct("id", "kind", "repo", "ref", "commit", "license")).alias("json")))).alias("used"))
    listed = lambda c: F.array_join(F.transform(c, lambda x: x["json"]), ",")
    text = F.concat(F.lit('{"pack":"'), "pack", F.lit('","variant":"'), "variant", F.lit('","sources":['), listed("used"), F.lit('],"files":['), listed("files"), F.format_string(']," totals":{"files":%d,"bytes":%d}}\n', F.col("n"), F.col("size")))
    return files.join(used, ["pack", "variant"]).select("pack", "variant", F.encode(F.replace(text, F.lit('" totals"'), F.lit('"totals"')), "UTF-8").alias("bytes"))


def archive_members(pack: DataFrame, source: DataFrame, kept: DataFrame, content: DataFrame, texts: DataFrame | None = None, snapshots: DataFrame | None = None) -> DataFrame:
    """(pack, variant, name, bytes): everything that goes into the archives. ``texts`` is (token, text), ``snapshots`` (snapshot, bytes)."""
    out = [_member(kept.join(content.select("pack", "path", "bytes"), ["pack", "path"]), F.col("path"), "asset")]
    used = kept.select("pack", "variant", "source_id").distinct()
    if texts is not None:
        tokens = used.join(integrity.spdx_tokens(source), ["pack", "source_id"]).select("pack", "variant", "token").distinct().join(texts, "token").withColumn("bytes", F.encode("text", "UTF-8"))
        out.append(_member(tokens, F.concat(F.lit("LICENSES/"), "token", F.lit(".txt")), "spdx"))
    if snapshots is not None:
        named = used.join(source.withColumnRenamed("id", "source_id"), ["pack", "source_id"])
        taken = named.withColumn("snapshot", F.col("license_snapshot")).join(snapshots, "snapshot")
        out.append(_member(taken, F.concat(F.lit("LICENSES/"), basename(F.col("snapshot"))), "snapshot"))
        out.append(_member(taken.where("adjacent_path is not null"), F.col("adjacent_path"), "adjacent"))
        layers = named.select("pack", "variant", F.explode("license.underlying").alias("layer")).withColumn("snapshot", F.col("layer.snapshot")).join(snapshots, "snapshot")
        out.append(_member(layers, F.concat(F.lit("LICENSES/"), basename(F.col("snapshot"))), "underlying"))
    out.append(_member(manifests(source, kept), F.lit("manifest.json"), "manifest"))
    out.append(_member(notice_text(notice_rows(source, kept), kept), F.lit("NOTICE.md"), "notice"))
    out.append(_member(readme_text(pack, source, kept), F.lit("README.md"), "readme"))
    return overwrite_wins(integrity.union(*out))


def write_tar_gz(members: Iterable[tuple[str, bytes]], out) -> None:
    """The same members give the same bytes: no times, owners or modes of the machine. Members come by name; one is held at a time."""
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=GZIP_LEVEL, mtime=0, filename="") as zipped, tarfile.open(fileobj=zipped, mode="w|", format=tarfile.PAX_FORMAT) as tar:
        for name, raw in members:
            info = tarfile.TarInfo(name)
            info.size, info.mtime, info.mode, info.uid, info.gid, info.uname, info.gname = len(raw), 0, MODE, 0, 0, "", ""
            tar.addfile(info, io.BytesIO(raw))


class _Hashing:
    """Writes through, and knows the digest and size of what went."""

    def __init__(self, out) -> None:
        self.out, self.digest, self.size = out, hashlib.sha256(), 0

    def write(self, data: bytes) -> int:
        self.digest.update(data)
        self.size += len(data)
        return self.out.write(data)

    def flush(self) -> None:
        self.out.flush()


def _archives(folder: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by pack, variant and name. Each archive goes to a file of its own attempt first, and takes its name when it is whole."""
        target, root = fs.FileSystem.from_uri(folder)
        rows = ((p, v, n, b) for batch in batches for p, v, n, b in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
        for (pack, variant), own in groupby(rows, key=lambda r: r[:2]):
            name, counted = f"{pack}-{variant}-{version}.tar.gz", [0]

            def members(own=own, counted=counted) -> Iterator[tuple[str, bytes]]:
                for _, _, member, raw in own:
                    counted[0] += 1
                    yield member, raw

            own_name = f"{root}/.{name}.{uuid.uuid4().hex}"
            with target.open_output_stream(own_name) as stream:
                out = _Hashing(stream)
                write_tar_gz(members(), out)
            target.move(own_name, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (pack, variant, name, out.digest.hexdigest(), out.size, counted[0])], ["pack", "variant", "file", "sha256", "size", "files"])

    return run


def export(members: DataFrame, file: DataFrame, folder: str, version: str, groups: DataFrame | None = None) -> DataFrame:
    """Write an archive for each pack and variant and return the artifact table.

    Excluded contents among the members stop the export before anything is written. Archives are written by tasks, side by side, to a folder that all of them reach (a path or URI
    of a file system that Arrow knows); a member is held at a time. A task that runs again writes the same bytes to the same name.
    """
    hashed = members.withColumn("sha256", F.sha2("bytes", 256)).withColumnRenamed("name", "path")
    if first := variants.breaches(hashed, file).limit(20).collect():  # for the message
        raise ValueError("excluded contents reach an archive: " + "; ".join(f"{r['pack']}: {r['path']} = {r['excluded_path']}" for r in first))
    uri = folder if "://" in folder else Path(folder).resolve().as_uri()
    target, root = fs.FileSystem.from_uri(uri)
    target.create_dir(root, recursive=True)
    rows = members.select("pack", "variant", "name", "bytes").repartition("pack", "variant").sortWithinPartitions("pack", "variant", "name").mapInArrow(_archives(uri, version), "pack string, variant string, file string, sha256 string, size long, files long")
    out = members.sparkSession.createDataFrame(rows.collect(), rows.schema)  # a row for each archive, written once
    return out.join(groups.select(F.col("name").alias("pack"), "merge_group"), "pack", "left") if groups is not None else out


def write_index(artifacts: DataFrame, folder: str, version: str, built_from: dict | None = None) -> None:
    """index.json and SHA256SUMS beside the archives: a row for each archive."""
    rows = [{k: v for k, v in r.asDict().items() if v is not None} for r in artifacts.orderBy("pack", "variant").collect()]
    doc = {"version": version, **({"builtFrom": built_from} if built_from else {}), "packs": rows}
    (Path(folder) / "index.json").write_text(json.dumps(doc, indent=2) + "\n")
    (Path(folder) / "SHA256SUMS").write_text("".join(f"{r['sha256']}  {r['file']}\n" for r in sorted(rows, key=lambda r: r["file"])))


def resolve_release(requests: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Artifacts that (pack, variant) requests name."""
    return requests.join(artifacts, ["pack", "variant"])


def source_commit(root: str) -> dict | None:
    """The commit that a checkout stands at, and whether it has changes of its own; None without a checkout."""
    git = lambda *args: subprocess.run(["git", "-C", root, *args], capture_output=True, text=True, timeout=15)
    try:
        head = git("rev-parse", "HEAD")
        if head.returncode:
            return None
        return {"commit": head.stdout.strip()} | ({"dirty": True} if git("status", "--porcelain").stdout.strip() else {})
    except (OSError, subprocess.SubprocessError):
        return None
