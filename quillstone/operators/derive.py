"""Malformed inputs derived from well-formed ones, the same each time for the same bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.paths import basename, extension, stem

#: Fixed values of the strategies: percentages, header windows, offsets and fills.
PERCENTS, WINDOWS, OFFSETS, FILLS = (1, 10, 50, 99), (("magic", 4), ("zeroed", 16)), (4, 8, 12, 16, 20), (("max", b"\xff" * 4), ("zero", b"\0" * 4))
HEADER_LEAST, LENGTHS_LEAST, FLIPS, FLIP_FROM = 16, 32, 3, 64
STRATEGIES = ("truncate", "header", "lengths", "bitflip", "empty")

#: Draws of a flip's place, at most, and the bytes at the head that seed them.
DRAWS, SEED = 24, 64
_SPEC = "array<struct<strategy:string,k:int,label:string,at:bigint,fill:binary>>"


def _spec(strategy: str, k: int, label: str, at: Column, fill: bytes | None = None) -> Column:
    return F.struct(F.lit(strategy).alias("strategy"), F.lit(k).alias("k"), F.lit(label).alias("label"), at.cast("bigint").alias("at"), F.lit(fill).cast("binary").alias("fill"))


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def flip_offsets(content: Column) -> Column:
    """Up to FLIPS distinct offsets past the head, drawn from hashes of the head and a counter, ascending.

    The first eight bytes of a hash are an unsigned number, whose remainder is the place.
    """
    n = F.octet_length(content).cast("bigint")
    low = F.least(_long(FLIP_FROM), n)
    head = content.substr(F.lit(1), F.lit(SEED))
    draw = lambda k: F.conv(F.substring(F.sha2(F.concat(head, F.unhex(F.lpad(F.hex(k.cast("bigint")), 8, "0"))), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    drawn = F.transform(F.sequence(F.lit(0), F.lit(DRAWS - 1)), lambda k: low + (draw(k) % (n - low).cast("decimal(20,0)")).cast("bigint"))
    return F.when(low < n, F.array_sort(F.slice(F.array_distinct(drawn), 1, FLIPS))).otherwise(F.array().cast("array<bigint>"))


def specs(content: Column, strategies: Sequence[str]) -> Column:
    """What is to be made of some bytes, without making it: (strategy, k, label, at, fill)."""
    n = F.octet_length(content).cast("bigint")
    none = F.array().cast(_SPEC)
    cut = lambda p: F.greatest(_long(1), F.floor(n * p / 100))
    of = {
        "truncate": lambda: F.array_compact(F.array(*[F.when(cut(p) < n, _spec("truncate", k, f"truncate-{p:02d}pct", cut(p))) for k, p in enumerate(PERCENTS)])),
        "header": lambda: F.when(n >= HEADER_LEAST, F.array(*[_spec("header", k, f"header-{label}", _long(0), bytes(w)) for k, (label, w) in enumerate(WINDOWS)])).otherwise(none),
        "lengths": lambda: F.when(n >= LENGTHS_LEAST, F.array(*[_spec("lengths", len(FILLS) * i + j, f"length-{o}-{label}", _long(o), fill) for i, o in enumerate(OFFSETS) for j, (label, fill) in enumerate(FILLS)])).otherwise(none),
        "bitflip": lambda: F.transform(flip_offsets(content), lambda x, k: F.struct(F.lit("bitflip").alias("strategy"), k.alias("k"), F.concat(F.lit("bitflip-"), k).alias("label"), x.alias("at"), F.lit(None).cast("binary").alias("fill"))),
        "empty": lambda: F.array(_spec("empty", 0, "empty", _long(0)), _spec("empty", 1, "one-byte", _long(1))),
    }
    return F.concat(none, *[of[s]().cast(_SPEC) for s in strategies])


def mutated(content: Column, spec: Column) -> Column:
    """The bytes that a specification makes of others."""
    at = spec["at"]
    place = (at + 1).cast("int")
    byte = F.conv(F.hex(content.substr(place, F.lit(1))), 16, 10).cast("int")
    flipped = F.unhex(F.lpad(F.hex(byte.bitwiseXOR(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))).cast("bigint")), 2, "0"))
    return (
        F.when(spec["strategy"] == "truncate", content.substr(F.lit(1), at.cast("int")))
        .when(spec["strategy"] == "bitflip", F.overlay(content, flipped, place))
        .when(spec["strategy"] != "empty", F.overlay(content, spec["fill"], place))
        .when(at == 0, F.lit(b""))
        .when(F.octet_length(content) > 0, content.substr(F.lit(1), F.lit(1)))
        .otherwise(F.lit(b"\0"))
    )


def derived_name(path: Column, label: Column) -> Column:
    name = basename(path)
    base = F.when(stem(name) == "", name).otherwise(stem(name))
    return F.when(extension(name) == "", F.concat_ws(".", base, label)).otherwise(F.concat_ws(".", base, label, extension(name)))


def derive_all(content: DataFrame, strategies: Sequence[str] = STRATEGIES) -> DataFrame:
    """Rows of ``content`` (path, bytes, ...) once for each mutation: label, bytes, derived name, strategy and its rank.

    One scan for all strategies, in expressions only. What is to be made is listed first, then made a row at a time, so a row holds one mutated copy. Null bytes give no rows.
    """
    if unknown := sorted(set(strategies) - {*STRATEGIES}):
        raise ValueError(f"no such strategy: {', '.join(unknown)}")
    keep = [c for c in content.columns if c != "bytes"]
    rank = F.array_position(F.array(*map(F.lit, strategies)), F.col("spec__.strategy")) if strategies else F.lit(1)
    made = content.where("bytes is not null").withColumn("spec__", F.explode(specs(F.col("bytes"), strategies)))
    out = made.select(*keep, F.col("spec__.label").alias("label"), mutated(F.col("bytes"), F.col("spec__")).alias("bytes"), F.col("spec__.strategy").alias("strategy"), (100 * (rank - 1) + F.col("spec__.k")).cast("int").alias("rank"))
    return out.withColumn("derived", derived_name(F.col("path"), F.col("label")))


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order; later ones are skipped."""
    return rows.withColumn("rank__", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("rank__ = 1").drop("rank__")


def skipped(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What ``first_wins`` leaves out, so that no collision goes unseen."""
    return rows.withColumn("rank__", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("rank__ > 1").drop("rank__")
