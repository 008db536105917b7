"""Checks of recorded facts against bytes, against each other and against the world, each as rows of one finding table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators import references, summaries, variants


def finding(rows: DataFrame, check: str, code: str | Column, detail: Column, fatal: bool = True) -> DataFrame:
    """Rows in the shape of findings; pack, source_id and path are taken where ``rows`` has them."""
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
    return rows.select(F.lit(check).alias("check"), own("pack"), own("source_id"), own("path"), (F.lit(code) if isinstance(code, str) else code).alias("code"), detail.alias("detail"), F.lit(fatal).alias("fatal"))


def union(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def contents(file: DataFrame, content: DataFrame) -> DataFrame:
    """Recorded files whose stored bytes are missing or have another hash. ``content`` has (pack, path, bytes) or (pack, path, sha256); only hashes are joined."""
    hashed = content.select("pack", "path", (F.col("sha256") if "sha256" in content.columns else F.sha2("bytes", 256)).alias("stored"))
    rows = file.join(hashed, ["pack", "path"], "left").where("stored is null or stored <> sha256")
    return finding(rows, "contents", "C39", F.when(F.col("stored").isNull(), "missing").otherwise(F.concat(F.lit("hash differs: "), F.col("stored"))))


def pins(source: DataFrame) -> DataFrame:
    rows = summaries.pin_conflicts(source)
    return finding(rows, "pins", "C42", F.concat("repo", F.lit("@"), "ref", F.lit(" is "), F.array_join("commits", ", "), F.lit(" in "), F.array_join("packs", ", ")))


def dangling(refs: DataFrame, file: DataFrame) -> DataFrame:
    """For information: nothing fails by it."""
    return finding(references.unresolved(refs, file), "references", "C44", F.col("raw_ref"), fatal=False)


def merge_groups(refs: DataFrame, file: DataFrame, pack: DataFrame) -> DataFrame:
    return finding(references.merge_group_missing(refs, file, pack), "merge-group", "C43", F.col("raw_ref"))


def verify(pack: DataFrame, source: DataFrame, file: DataFrame, content: DataFrame) -> DataFrame:
    """All checks of a set of packs as one table; ``content`` is (pack, path, bytes)."""
    refs = references.references(content.join(file.select("pack", "path"), ["pack", "path"], "left_semi"))
    out = union(contents(file, content), pins(source), dangling(refs, file), merge_groups(refs, file, pack))
    if "license" in source.columns:
        out = union(out, closed(source, file))
    return union(out, excluded(file)) if "exclude" in file.columns else out


def closed(source: DataFrame, file: DataFrame) -> DataFrame:
    """Recorded files whose source forbids redistribution: such a source has no files."""
    shut = source.where(~F.coalesce("license.redistributable", F.lit(True))).select("pack", F.col("id").alias("source_id"))
    return finding(file.join(shut, ["pack", "source_id"], "left_semi"), "distribution", "C40", F.lit("its source forbids redistribution"))


def excluded(file: DataFrame) -> DataFrame:
    """Files that stay although another path excludes what they hold."""
    rows = variants.breaches(file.where("exclude is null"), file)
    return finding(rows, "exclusion", "C41", F.concat(F.lit("excluded as "), "excluded_path"))


def exit_code(findings: DataFrame) -> int:
    return int(not findings.where("fatal").isEmpty())


def drift(source: DataFrame, locked: DataFrame, refs: DataFrame) -> DataFrame:
    """Specified sources that no lock has, and locked commits that are no longer the head of their ref.

    ``refs`` is a recorded snapshot (repo, ref, commit). Sources without a commit were not stored and can't drift; a head that was not observed is a finding too.
    """
    up = source.where("kind = 'upstream' and license.redistributable")
    pin = locked.select("pack", "id", F.col("commit").alias("locked"), F.lit(True).alias("known"))
    rows = up.join(pin, ["pack", "id"], "left").withColumn("at", F.coalesce("ref", F.lit("HEAD"))).withColumnRenamed("id", "source_id")
    seen = rows.join(refs.select("repo", F.col("ref").alias("at"), F.col("commit").alias("head")), ["repo", "at"], "left")
    code = F.when(F.col("known").isNull(), "absent").when(F.col("locked").isNull(), None).when(F.col("head").isNull(), "unobserved").when(F.col("head") != F.col("locked"), "moved")
    told = F.when(F.col("code") == "absent", "not in the lock").when(F.col("code") == "moved", F.concat(F.substring("locked", 1, 12), F.lit(" -> "), F.substring("head", 1, 12))).otherwise(F.concat("repo", F.lit("@"), "at"))
    return finding(seen.withColumn("code", code).where("code is not null"), "drift", F.col("code"), told)


def orphan_annotations(annotation: DataFrame, file: DataFrame) -> DataFrame:
    return finding(annotation.join(file.select("pack", "path"), ["pack", "path"], "left_anti"), "annotations", "C36", F.lit("no such file"))


def collisions(file: DataFrame) -> DataFrame:
    """Archive paths that more than one file of a pack would take."""
    rows = file.groupBy("pack", "path").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("source_id")).alias("by")).where("n > 1")
    return finding(rows, "destinations", "C32", F.concat_ws(", ", "by"))


def sources_without_files(source: DataFrame, file: DataFrame) -> DataFrame:
    rows = source.where("kind <> 'recovered' and license.redistributable").join(file.select("pack", F.col("source_id").alias("id")), ["pack", "id"], "left_anti").withColumnRenamed("id", "source_id")
    return finding(rows, "selection", "C33", F.lit("no file selected"))


def parents(source: DataFrame, file: DataFrame, ingested: DataFrame | None = None, content: DataFrame | None = None) -> DataFrame:
    """Derived sources whose parent is unknown, has no files, or forbids derivatives; a licence that disagrees with the parent's is told too, and not fatal.

    With ``ingested`` (pack), parents whose pack was not ingested are told, and not looked for; with ``content`` (pack, path), parents of whose files some are not stored.
    """
    up = source.select(F.col("pack").alias("from_pack"), F.col("id").alias("from_source"), F.col("license").alias("parent"), F.lit(True).alias("known"))
    counts = file.groupBy(F.col("pack").alias("from_pack"), F.col("source_id").alias("from_source")).agg(F.count("*").alias("files"))
    rows = source.where("kind = 'derived'").join(up, ["from_pack", "from_source"], "left").join(counts, ["from_pack", "from_source"], "left").withColumnRenamed("id", "source_id")
    name = F.concat_ws("/", "from_pack", "from_source")
    more = []
    if ingested is not None:
        packs = ingested.select(F.col("pack").alias("from_pack")).distinct()
        more.append(finding(rows.join(packs, "from_pack", "left_anti"), "derivation", "C27", name))
        rows = rows.join(packs, "from_pack", "left_semi")
    if content is not None:
        gone = file.join(content.select("pack", "path"), ["pack", "path"], "left_anti").groupBy(F.col("pack").alias("from_pack"), F.col("source_id").alias("from_source")).agg(F.count("*").alias("gone"))
        more.append(finding(rows.join(gone, ["from_pack", "from_source"]), "derivation", "C30", F.concat(name, F.lit(": "), F.col("gone").cast("string"), F.lit(" without bytes"))))
    return union(
        *more,
        finding(rows.where("known is null"), "derivation", "C28", name),
        finding(rows.where("known and files is null"), "derivation", "C29", name),
        finding(rows.where("known and not coalesce(parent.derivatives, true)"), "derivation", "C31", F.concat(name, F.lit(": "), F.coalesce("parent.prohibition", F.lit("")))),
        finding(rows.where("known and parent.declared <> license.declared"), "derivation", "D4", F.concat("license.declared", F.lit(" is "), "parent.declared"), fatal=False),
    )


def licence_texts(source: DataFrame, tree: DataFrame) -> DataFrame:
    """Licence documents that a source names and its listing (pack, source_id, path) does not hold."""
    entry = lambda path, code: F.struct(path.alias("path"), F.lit(code).alias("code"))
    layers = F.coalesce(F.transform("license.underlying", lambda x: entry(x["declared_from"], "C35")), F.array().cast("array<struct<path:string,code:string>>"))
    named = F.filter(F.concat(F.array(entry(F.col("license.declared_from"), "C34")), layers), lambda x: x["path"].isNotNull())
    rows = source.select("pack", F.col("id").alias("source_id"), F.explode(F.array_distinct(named)).alias("w")).select("pack", "source_id", "w.path", "w.code")
    return finding(rows.join(tree, ["pack", "source_id", "path"], "left_anti"), "licences", F.col("code"), F.lit("not at the commit"))


def spdx_tokens(source: DataFrame) -> DataFrame:
    """(pack, source_id, token) of each identifier in a declaration."""
    tokens = F.filter(F.split(F.regexp_replace("license.declared", " OR | AND ", " "), r"\s+"), lambda t: t != "")
    return source.select("pack", F.col("id").alias("source_id"), F.explode(tokens).alias("token"))


def missing_texts(source: DataFrame, texts: DataFrame) -> DataFrame:
    """Declared identifiers without a canonical text (token, text) to ship."""
    return finding(spdx_tokens(source).join(texts, "token", "left_anti"), "licences", "D9", F.col("token"), fatal=False)


def demand_none(findings: DataFrame) -> None:
    """Raise with the first fatal findings, if there are any."""
    if first := findings.where("fatal").orderBy("check", "pack", "path").limit(20).collect():  # for the message; the table has all
        raise ValueError("; ".join(f"{r['check']} {r['pack']}/{r['path'] or r['source_id']}: {r['detail']}" for r in first))
