"""From specifications and landed contents to the file table of a lock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.paths import basename, destination, glob_regex
from quillstone.operators import derive, integrity
from quillstone.operators.variants import effective_license


def with_globs(source: DataFrame) -> DataFrame:
    """Sources with one regex for inclusion, exclusion and parents each; compiled once on the driver, a row for each source."""
    spark = source.sparkSession
    rows = [(r["pack"], r["id"], glob_regex(r["include"] or ()), glob_regex(r["exclude_paths"]) if r["exclude_paths"] else None, glob_regex(r["from_include"] or ())) for r in source.select("pack", "id", "include", "exclude_paths", "from_include").collect()]
    return source.join(F.broadcast(spark.createDataFrame(rows, "pack string, id string, include_rx string, exclude_rx string, from_rx string")), ["pack", "id"])


def pinned(source: DataFrame, locked: DataFrame | None, refs: DataFrame, update: bool = False) -> DataFrame:
    """Sources with the commit to read: the specified one, else the locked one, else (or on update) the head of the ref."""
    at = source.withColumn("at__", F.coalesce("ref", F.lit("HEAD")))
    if locked is None:
        at = at.withColumn("locked__", F.lit(None).cast("string"))
    else:
        at = at.join(locked.select("pack", "id", F.col("commit").alias("locked__")), ["pack", "id"], "left")
    heads = refs.select("repo", F.col("ref").alias("at__"), F.col("commit").alias("head__"))
    known = F.coalesce("commit", "locked__")
    commit = F.when(F.lit(update) | known.isNull(), F.col("head__")).otherwise(known)
    return at.join(heads, ["repo", "at__"], "left").withColumn("commit", commit).select(*source.columns)


def selected(source: DataFrame, tree: DataFrame) -> DataFrame:
    """(pack, source_id, upstream_path, path): the listed paths that each source takes, before any bytes are read.

    ``tree`` is (pack, source_id, path). Sources that forbid redistribution take nothing.
    """
    rules = with_globs(source.where("kind = 'upstream' and license.redistributable")).select("pack", F.col("id").alias("source_id"), "include_rx", "exclude_rx", "strip", "dest")
    rows = tree.join(F.broadcast(rules), ["pack", "source_id"])  # a row for each source
    taken = rows.where(F.expr("path rlike include_rx and not coalesce(path rlike exclude_rx, false)"))
    return taken.select("pack", "source_id", F.col("path").alias("upstream_path"), destination(F.col("path"), F.col("strip"), F.col("dest")).alias("path"))


def wanted(source: DataFrame, tree: DataFrame) -> DataFrame:
    """Paths whose bytes a fetch needs: selected ones, and licence documents whether listed or not."""
    named = F.array_union(F.array("license.declared_from"), F.coalesce(F.transform("license.underlying", lambda x: x["declared_from"]), F.array().cast("array<string>")))
    licences = source.where("license.redistributable").select("pack", F.col("id").alias("source_id"), F.explode(F.array_compact(named)).alias("path"))
    return selected(source, tree).select("pack", "source_id", F.col("upstream_path").alias("path")).unionByName(licences).distinct()


def upstream_files(chosen: DataFrame, content: DataFrame, formats: DataFrame | None = None, annotation: DataFrame | None = None) -> DataFrame:
    """File rows of selected paths: hash, size, format and annotations. ``content`` is (pack, source_id, upstream_path, bytes); ``formats`` (sha256, format)."""
    hashed = content.select("pack", "source_id", "upstream_path", F.sha2("bytes", 256).alias("sha256"), F.octet_length("bytes").cast("long").alias("size"))
    rows = chosen.join(hashed, ["pack", "source_id", "upstream_path"])
    rows = rows.join(formats, "sha256", "left") if formats is not None else rows
    if annotation is not None:
        notes = annotation.groupBy("pack", "path").agg(F.max_by("depicts", "ordinal").alias("depicts"), F.max_by("exclude", "ordinal").alias("exclude"))  # a later source wins
        rows = rows.join(notes, ["pack", "path"], "left")
    return rows


def parent_files(source: DataFrame, file: DataFrame) -> DataFrame:
    """Files that each derived source mutates: its parent's, by pattern, sampled by hash; exclusions and subjects of the parent go along."""
    rules = with_globs(effective_license(source).where("kind = 'derived'"))
    rules = rules.where(F.when(F.col("license.derivatives"), True).otherwise(F.raise_error(F.concat(F.lit("derivatives are forbidden: "), F.col("from_pack"), F.lit("/"), F.col("from_source"))).cast("boolean")))
    rules = rules.select(F.col("pack").alias("to_pack"), F.col("id").alias("to_source"), "from_pack", "from_source", "from_rx", "sample", "strategies", F.col("dest").alias("to_dest"))
    rows = file.join(F.broadcast(rules), (file["pack"] == F.col("from_pack")) & (file["source_id"] == F.col("from_source"))).where(F.expr("path rlike from_rx"))
    from quillstone.operators.summaries import sample_by_hash

    return sample_by_hash(rows, ["to_pack", "to_source"], "sample")


def derived_files(source: DataFrame, file: DataFrame, content: DataFrame) -> tuple[DataFrame, DataFrame]:
    """File rows (with bytes) of derived sources, and the rows that a collision skips. Names come from the base name; the first in order wins."""
    chosen = parent_files(source, file).select("to_pack", "to_source", "to_dest", "strategies", "pack", "path", F.col("sha256").alias("derived_from_sha256"), "depicts", "exclude")
    rows = chosen.join(content.select("pack", "path", "bytes"), ["pack", "path"])
    made = derive.derive_all(rows).where(F.array_contains("strategies", F.col("strategy")))
    made = made.withColumn("order__", F.array_position("strategies", F.col("strategy")) * 100 + F.col("rank") % 100)
    to = F.regexp_replace(F.concat("to_dest", basename(F.col("derived"))), "^/+", "")
    out = made.select(
        F.col("to_pack").alias("pack"), to.alias("path"), F.col("to_source").alias("source_id"), F.sha2("bytes", 256).alias("sha256"), F.octet_length("bytes").cast("long").alias("size"),
        F.col("path").alias("derived_from"), "derived_from_sha256", F.col("label").alias("strategy"), "depicts", "exclude", "bytes", "order__",
    )
    order = ["derived_from_sha256", "derived_from", "order__"]
    return derive.first_wins(out, ["pack", "path"], order).drop("order__"), derive.skipped(out, ["pack", "path"], order).drop("order__")


def build_lock(source: DataFrame, tree: DataFrame, content: DataFrame, annotation: DataFrame, formats: DataFrame | None = None, derived: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(file, finding): the files of upstream sources, and those that were derived from stored ones (from ``derived_files``), as one table. ``in_order`` sorts it for display."""
    chosen = selected(source, tree)
    file = upstream_files(chosen, content, formats, annotation)
    found = integrity.union(integrity.collisions(chosen), integrity.sources_without_files(source.where("kind = 'upstream'"), chosen), integrity.orphan_annotations(annotation, chosen), integrity.licence_texts(source.where("kind = 'upstream' and license.redistributable"), tree))
    return file if derived is None else file.unionByName(derived.drop("bytes"), allowMissingColumns=True), found


def in_order(file: DataFrame) -> DataFrame:
    """Files as a lock lists them."""
    return file.orderBy("pack", "path")
