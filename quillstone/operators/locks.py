"""Writing what an ingest recorded: lock documents, stored bytes and licence snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.paths import destination
from quillstone.operators import integrity
from quillstone.sources import files, schemas

#: Hex digits of a commit that a snapshot's name shows.
SHORT = 12


def _json(text: Column) -> Column:
    return F.parse_json(text)


def _own(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column where the table has it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _within(df: DataFrame, outer: str, name: str, kind: str = "string") -> Column:
    fields = df.schema[outer].dataType.fieldNames()
    return F.col(f"{outer}.{name}") if name in fields else F.lit(None).cast(kind)


def _license(source: DataFrame) -> Column:
    own = lambda name, kind="string": _within(source, "license", name, kind)
    use = F.when(own("commercial_use") == "yes", "true").when(own("commercial_use") == "no", "false").otherwise('"unknown"')
    layers = own("underlying", "array<struct<declared:string,declared_from:string,note:string,snapshot:string>>")
    has_snapshot = "snapshot" in (source.schema["license"].dataType["underlying"].dataType.elementType.fieldNames() if "underlying" in source.schema["license"].dataType.fieldNames() else ["snapshot"])
    layer = lambda x: F.struct(x["declared"].alias("declared"), x["declared_from"].alias("declaredFrom"), x["note"].alias("note"), (x["snapshot"] if has_snapshot else F.lit(None).cast("string")).alias("snapshot"))
    return F.struct(
        own("declared").alias("declared"), own("declared_scope").alias("declaredScope"), _json(use).alias("commercialUse"), own("redistributable", "boolean").alias("redistributable"), own("declared_from").alias("declaredFrom"), own("covers").alias("covers"),
        own("source_code").alias("sourceCode"), own("concluded").alias("concluded"), own("prohibition").alias("prohibition"), own("onward_use").alias("onwardUse"), own("derivatives", "boolean").alias("derivatives"), own("permissive", "boolean").alias("permissive"),
        F.when(F.size(layers) > 0, F.transform(layers, layer)).alias("underlying"),
    )


def _format(file: DataFrame) -> Column:
    """Kind, version and attributes as one object."""
    known = F.to_json(F.struct(F.col("format.kind").alias("kind"), F.col("format.version").alias("version")))
    rest = F.coalesce("format.attrs", F.lit("{}"))
    whole = F.when(F.get_json_object(rest, "$.kind").isNotNull(), rest).when(rest == "{}", known).otherwise(F.concat(F.expr("substr(k__, 1, length(k__) - 1)"), F.lit(","), F.substring(rest, 2, 1 << 30)))
    return known, whole


def documents(pack: DataFrame, source: DataFrame, file: DataFrame) -> DataFrame:
    """(name, text): the lock document of each pack: pack, sources in order, files by path, totals; absent keys are left out.

    A lock is one document, so its text is one cell; a pack's lock grows with its files, not with their bytes.
    """
    known, whole = _format(file.select("format") if "format" in file.columns else file.withColumn("format", F.lit(None).cast(schemas.FORMAT)).select("format"))
    rows = file if "format" in file.columns else file.withColumn("format", F.lit(None).cast(schemas.FORMAT))
    entry = F.struct(
        "path", F.col("source_id").alias("sourceId"), _own(file, "upstream_path").alias("upstreamPath"), "sha256", "size", F.when(F.col("format.kind").isNotNull(), _json(whole)).alias("format"), _own(file, "derived_from").alias("derivedFrom"),
        _own(file, "derived_from_sha256").alias("derivedFromSha256"), _own(file, "strategy").alias("strategy"),
        (F.when(F.col("depicts").isNotNull(), F.struct("depicts.subject", F.col("depicts.rights_holder").alias("rightsHolder"), "depicts.status")) if "depicts" in file.columns else F.lit(None).cast("struct<subject:string,rightsHolder:string,status:string>")).alias("depicts"),
        _own(file, "exclude", schemas.EXCLUDE).alias("exclude"),
    )
    listed = rows.withColumn("k__", known).groupBy(F.col("pack").alias("name")).agg(F.transform(F.array_sort(F.collect_list(F.struct("path", F.to_json(entry).alias("text")))), lambda x: x["text"]).alias("files"), F.count("*").alias("n"), F.sum("size").alias("bytes"))
    origin = "struct<pack:string,source:string,originals:bigint,strategies:array<string>>"
    one = F.struct("id", "kind", _own(source, "repo").alias("repo"), _own(source, "ref").alias("ref"), _own(source, "commit").alias("commit"), _own(source, "url").alias("url"), _own(source, "retrieved").alias("retrieved"), _own(source, "vendored", "boolean").alias("vendored"), _license(source).alias("license"), _own(source, "license_snapshot").alias("licenseSnapshot"), _own(source, "adjacent_path").alias("adjacentPath"), _own(source, "derived_from", origin).alias("derivedFrom"))
    sources = source.groupBy(F.col("pack").alias("name")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "id", F.to_json(one).alias("text")))), lambda x: x["text"]).alias("sources"))
    head = F.to_json(F.struct("name", "kind", "summary", F.col("merge_group").alias("mergeGroup")))
    lines = lambda c: F.coalesce(F.array_join(c, ",\n  "), F.lit(""))
    text = F.concat(F.lit('{"pack":'), head, F.lit(',\n"sources":[\n  '), lines("sources"), F.lit('\n],\n"files":[\n  '), lines("files"), F.lit('\n],\n"totals":'), F.to_json(F.struct(F.coalesce("n", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))), F.lit("}"))
    return pack.join(sources, "name", "left").join(listed, "name", "left").select("name", text.alias("text"))


def write(pack: DataFrame, source: DataFrame, file: DataFrame, folder: str) -> None:
    """A lock document for each pack, in ``folder/name=<pack>``; ``read`` gives its tables back."""
    documents(pack, source, file).repartition("name").write.partitionBy("name").text(folder)


def read(spark, folder: str) -> dict[str, DataFrame]:
    return files.load_locks(spark, f"{folder}/name=*")


def recorded(source: DataFrame, day: str, stored: bool = True) -> DataFrame:
    """Sources as a lock records them: retrieved on ``day`` where they do not say when, and whether their bytes are stored."""
    return source.withColumn("retrieved", F.coalesce("retrieved", F.lit(day))).withColumn("vendored", F.lit(stored) & F.col("license.redistributable"))


def objects(content: DataFrame) -> DataFrame:
    """(sha256, bytes): each distinct content once, however many paths have it."""
    hashed = content.select(F.sha2("bytes", 256).alias("sha256"), "bytes")
    return hashed.groupBy("sha256").agg(F.first("bytes").alias("bytes"))


def write_objects(content: DataFrame, folder: str) -> None:
    """Store contents by their hash. Files are cut by the first hash digit, so a lookup reads a part."""
    objects(content).withColumn("part", F.substring("sha256", 1, 1)).write.partitionBy("part").mode("append").parquet(folder)


def restored(file: DataFrame, stored: DataFrame) -> DataFrame:
    """``file`` with the bytes that its hashes name; a hash without bytes fails the job."""
    there = F.when(F.col("bytes").isNull(), F.raise_error(F.concat(F.lit("no stored bytes: "), F.col("pack"), F.lit("/"), F.col("path"))).cast("binary")).otherwise(F.col("bytes"))
    return file.join(stored.select("sha256", "bytes").dropDuplicates(["sha256"]), "sha256", "left").withColumn("bytes", there)


def snapshots(source: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources with license_snapshot, adjacent_path and the snapshots of their layers; (snapshot, bytes); and findings of texts that are not there.

    ``texts`` is (pack, source_id, path, bytes): what the commit holds. A licence beside its files lands beside them in an archive too.
    """
    short = F.substring("commit", 1, SHORT)
    layer = lambda x, k: F.struct(x["declared"].alias("declared"), x["declared_from"].alias("declared_from"), x["note"].alias("note"), F.when(x["declared_from"].isNotNull(), F.concat(F.lit("licenses/"), F.col("id"), F.lit("-underlying-"), k.cast("string"), F.lit("@"), short, F.lit(".txt"))).alias("snapshot"))
    named = source.withColumn("license", F.col("license").withField("underlying", F.transform("license.underlying", layer)))
    declared = F.col("license.declared_from")
    named = named.withColumn("license_snapshot", F.when(declared.isNotNull(), F.concat(F.lit("licenses/"), "id", F.lit("@"), short, F.lit(".txt"))))
    beside = F.col("license.declared_scope") == "file-adjacent"
    named = named.withColumn("adjacent_path", F.when(declared.isNotNull() & beside, destination(declared, F.col("strip"), F.col("dest"))))
    entry = lambda path, snapshot, code: F.struct(path.alias("path"), snapshot.alias("snapshot"), F.lit(code).alias("code"))
    layers = F.transform(F.filter("license.underlying", lambda x: x["declared_from"].isNotNull()), lambda x: entry(x["declared_from"], x["snapshot"], "C35"))
    wanted = F.concat(F.when(declared.isNotNull(), F.array(entry(declared, F.col("license_snapshot"), "C34"))).otherwise(F.array().cast("array<struct<path:string,snapshot:string,code:string>>")), layers)
    rows = named.where("license.redistributable").select("pack", F.col("id").alias("source_id"), F.explode(wanted).alias("w")).select("pack", "source_id", "w.*")
    found = rows.join(texts, ["pack", "source_id", "path"], "left")
    return named, found.where("bytes is not null").select("pack", "snapshot", "bytes"), integrity.finding(found.where("bytes is null"), "licences", F.col("code"), F.lit("not at the commit"))


def without_bytes(source: DataFrame) -> DataFrame:
    """Recorded sources whose bytes are not stored."""
    return source.where(~F.coalesce("vendored", F.lit(True)))
