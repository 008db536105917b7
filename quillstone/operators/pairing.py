"""Joins that users of a corpus make: inputs with what is expected of them, and everything of one origin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.paths import basename, dirname

#: What a rendering's name adds to its input's, as a whole and for each frame.
RENDERED, FRAME = r"\.png$", r"\.anim_(\d+)\.png$"


def renderings(file: DataFrame, inputs: str = "images/", expected: str = "reference/") -> DataFrame:
    """(pack, path, rendering, frame) of each input: the picture that is expected of it, and one for each frame of an animation (frame is null for the whole).

    ``images/a.gif`` goes with ``reference/a.gif.png`` and ``reference/a.gif.anim_01.png``. Inputs without a rendering are there once, with null.
    """
    under = lambda root: file.where(F.col("path").startswith(root))
    frame = F.regexp_extract("path", FRAME, 1)
    of = F.when(frame != "", F.regexp_replace("path", FRAME, "")).otherwise(F.regexp_replace("path", RENDERED, ""))
    pictures = under(expected).where(F.col("path").endswith(".png")).select("pack", F.substring(of, len(expected) + 1, 1 << 30).alias("stem"), F.col("path").alias("rendering"), F.when(frame != "", frame.cast("int")).alias("frame"))
    return under(inputs).select("pack", "path", F.substring("path", len(inputs) + 1, 1 << 30).alias("stem")).join(pictures, ["pack", "stem"], "left").drop("stem")


def same_directory(file: DataFrame, first: str, second: str) -> DataFrame:
    """(pack, directory, first, second): files of two names that lie side by side, such as a test and its output."""
    own = lambda name, to: file.where(basename(F.col("path")) == name).select("pack", dirname(F.col("path")).alias("directory"), F.col("path").alias(to))
    return own(first, "first").join(own(second, "second"), ["pack", "directory"])


def of_one_origin(file: DataFrame, source: DataFrame, challenged: DataFrame) -> DataFrame:
    """All files of the repositories and commits that challenged files (pack, path) come from: a complaint about one is a question about the others."""
    named = file.join(source.select("pack", F.col("id").alias("source_id"), "repo", "commit"), ["pack", "source_id"]).where("repo is not null")
    origin = named.join(challenged.select("pack", "path"), ["pack", "path"], "left_semi").select("repo", "commit").distinct()
    return named.join(origin.withColumnRenamed("commit", "at__"), (named["repo"] == origin["repo"]) & named["commit"].eqNullSafe(F.col("at__")), "left_semi").select("repo", "commit", "pack", "path")
