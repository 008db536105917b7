"""Totals, histograms and consistency over files and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def totals(pack: DataFrame, file: DataFrame) -> DataFrame:
    """(pack, files, bytes), packs without files too."""
    sums = file.groupBy("pack").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    return pack.select(F.col("name").alias("pack")).join(sums, "pack", "left").select("pack", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def files_per_source(source: DataFrame, file: DataFrame) -> DataFrame:
    """(pack, source_id, files), sources without files too."""
    counts = file.groupBy("pack", "source_id").agg(F.count("*").alias("files"))
    return source.select("pack", F.col("id").alias("source_id")).join(counts, ["pack", "source_id"], "left").withColumn("files", F.coalesce("files", F.lit(0)))


def format_histogram(file: DataFrame) -> DataFrame:
    """(pack, kind, version, files); unrecognised files are a kind of their own. ``by_frequency`` orders them for display."""
    kind = F.coalesce("format.kind", F.lit("unrecognised"))
    return file.groupBy("pack", kind.alias("kind"), F.col("format.version").alias("version")).agg(F.count("*").alias("files"))


def by_frequency(histogram: DataFrame) -> DataFrame:
    """A format histogram in the order of a report: the most frequent first, equal counts by kind and version as text, where no version reads None."""
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    name = F.concat(quoted(F.col("kind")), F.lit(", "), F.coalesce(quoted(F.col("version")), F.lit("None")))
    return histogram.orderBy("pack", F.desc("files"), name)


def duplicates(file: DataFrame, name: str = "path") -> DataFrame:
    """(sha256, copies, first): contents that more than one file has, with the least name among them."""
    return file.groupBy("sha256").agg(F.count("*").alias("copies"), F.min(name).alias("first")).where("copies > 1")


def flagged(file: DataFrame) -> DataFrame:
    """(pack, depicting, excluded): files that depict third-party subjects, and files that are excluded."""
    return file.groupBy("pack").agg(F.count_if(F.col("depicts").isNotNull()).alias("depicting"), F.count_if(F.col("exclude").isNotNull()).alias("excluded"))


def pin_conflicts(source: DataFrame) -> DataFrame:
    """(repo, ref, commits, packs) of each ref that is pinned to more than one commit across packs."""
    pins = source.where("repo is not null and commit is not null").groupBy("repo", F.coalesce("ref", F.lit("HEAD")).alias("ref"))
    return pins.agg(F.array_sort(F.collect_set("commit")).alias("commits"), F.array_sort(F.collect_set("pack")).alias("packs")).where(F.size("commits") > 1)


def merge_group_files(pack: DataFrame, file: DataFrame) -> DataFrame:
    """(merge_group, packs, files) of groups of two packs or more."""
    return totals(pack, file).join(pack.select(F.col("name").alias("pack"), "merge_group"), "pack").where("merge_group is not null").groupBy("merge_group").agg(F.count("*").alias("packs"), F.sum("files").alias("files")).where("packs > 1")


def capped(findings: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first rows of each group, for display; findings themselves are stored whole."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return findings.withColumn("rank__", rank).where(F.col("rank__") <= most).drop("rank__")


def sample_by_hash(file: DataFrame, by: list[str], most: str) -> DataFrame:
    """The files of least sha256 in each group, ``most`` of them (a column; 0 takes all); path settles equal contents."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("sha256", "path"))
    return file.withColumn("rank__", rank).where((F.col(most) == 0) | (F.col("rank__") <= F.col(most))).drop("rank__")


def show(pack: DataFrame, source: DataFrame, file: DataFrame) -> DataFrame:
    """(pack, item, key, files): everything that a summary lists, one row for each line."""
    line = lambda item, key, n: [F.col("pack"), F.lit(item).alias("item"), key.alias("key"), n.cast("long").alias("files")]
    out = totals(pack, file).select(*line("total", F.format_string("%.2f MB", F.col("bytes") / 1e6), F.col("files")))
    out = out.unionByName(files_per_source(source, file).select(*line("source", F.col("source_id"), F.col("files"))))
    out = out.unionByName(format_histogram(file).select(*line("format", F.concat_ws(" ", "kind", "version"), F.col("files"))))
    flags = flagged(file)
    return out.unionByName(flags.select(*line("depicts", F.lit(""), F.col("depicting")))).unionByName(flags.select(*line("exclude", F.lit(""), F.col("excluded"))))
