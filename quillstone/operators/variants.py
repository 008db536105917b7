"""Which files of a pack go into which variant, and the guarantee that excluded contents go into none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VARIANTS = ("full", "demo", "permissive")
#: Declarations that need no second thought.
PERMISSIVE = ("MIT", "Apache-2.0", "Apache-2.0 OR MIT", "MIT OR Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "CC0-1.0", "Unlicense", "0BSD", "CC-BY-4.0", "Unicode-3.0")
#: Onward uses that keep a file out of public view.
NOT_SHOWN = ("testing-only", "unknown")


def onward(license: Column) -> Column:
    return F.coalesce(license["onward_use"], F.lit("unrestricted"))


def depicts_settled(depicts: Column) -> Column:
    """Nothing is depicted, or the rights in it are resolved."""
    return depicts.isNull() | depicts["status"].eqNullSafe("resolved")


def demo_safe(license: Column, depicts: Column) -> Column:
    return ~onward(license).isin(*NOT_SHOWN) & depicts_settled(depicts)


def permissive(license: Column, depicts: Column) -> Column:
    known = license["declared"].isin(*PERMISSIVE) | license["permissive"].eqNullSafe(True)
    return F.coalesce(known & license["commercial_use"].eqNullSafe("yes") & (onward(license) == "unrestricted") & depicts_settled(depicts), F.lit(False))


def eligible(variant: Column, license: Column, depicts: Column) -> Column:
    return F.when(variant == "demo", demo_safe(license, depicts)).when(variant == "permissive", permissive(license, depicts)).otherwise(F.lit(True))


def effective_license(source: DataFrame) -> DataFrame:
    """Sources with the licence that counts: a derived source has its parent's, whatever it says itself."""
    parent = source.select(F.col("pack").alias("from_pack"), F.col("id").alias("from_source"), F.col("license").alias("parent_license"))
    return source.join(parent, ["from_pack", "from_source"], "left").withColumn("license", F.coalesce("parent_license", "license")).select(*source.columns)


def source_eligibility(source: DataFrame) -> DataFrame:
    """(pack, variant, sources): how many sources each variant may draw on; no content is needed."""
    open_ = effective_license(source).where(F.col("license.redistributable"))
    rows = open_.withColumn("variant", F.explode(F.array(*map(F.lit, VARIANTS))))
    none = F.lit(None).cast("struct<subject:string,rights_holder:string,status:string>")
    return rows.where(eligible(F.col("variant"), F.col("license"), none)).groupBy("pack", "variant").agg(F.count("*").alias("sources"))


def with_source(file: DataFrame, source: DataFrame) -> DataFrame:
    """Files with the licence and availability of their source; a file without a source fails the job that reads it."""
    slim = source.select("pack", F.col("id").alias("source_id"), "license", F.lit(True).alias("known"))
    joined = file.join(slim, ["pack", "source_id"], "left")
    checked = F.when(F.coalesce("known", F.lit(False)), F.col("license")).otherwise(F.raise_error(F.concat(F.lit("file without a source: "), F.col("pack"), F.lit("/"), F.col("path"))))
    return joined.withColumn("license", checked).drop("known")


def select_variant(file: DataFrame, source: DataFrame, variant: str) -> DataFrame:
    """The files that a variant keeps. A file whose source forbids redistribution stops the job, even if it is excluded."""
    return select_variants(file, source, (variant,)).drop("variant")


def select_variants(file: DataFrame, source: DataFrame, variants: tuple[str, ...] = VARIANTS) -> DataFrame:
    """``file`` once for each variant that keeps it (column variant); one pass over one join for all variants."""
    rows = with_source(file, source)
    breach = F.raise_error(F.concat(F.lit("not redistributable: "), F.col("pack"), F.lit("/"), F.col("path")))
    open_ = F.when(F.coalesce(F.col("license.redistributable"), F.lit(True)), F.col("exclude").isNull()).otherwise(breach.cast("boolean"))
    kept = rows.where(open_).withColumn("variant", F.explode(F.array(*map(F.lit, variants))))
    return kept.where(eligible(F.col("variant"), F.col("license"), F.col("depicts"))).select("variant", *file.columns)


def excluded_hashes(file: DataFrame) -> DataFrame:
    return file.where(F.col("exclude").isNotNull()).select("pack", "sha256").distinct()


def breaches(members: DataFrame, file: DataFrame) -> DataFrame:
    """Members whose contents are excluded in the pack, with the least path that excludes them and how many do: by hash, whatever the path. A row for each member, however many copies are excluded."""
    out = file.where(F.col("exclude").isNotNull()).groupBy("pack", "sha256").agg(F.min("path").alias("excluded_path"), F.count("*").alias("excluded"))
    return members.join(out, ["pack", "sha256"]).select("pack", "path", "excluded_path", "excluded", "sha256")


def used_sources(source: DataFrame, kept: DataFrame) -> DataFrame:
    return source.join(kept.select("pack", F.col("source_id").alias("id")), ["pack", "id"], "left_semi")


def noncommercial(source: DataFrame, kept: DataFrame) -> DataFrame:
    """(pack, noncommercial): whether any used source forbids commercial use."""
    return used_sources(source, kept).groupBy("pack").agg(F.bool_or(F.col("license.commercial_use") == "no").alias("noncommercial"))
