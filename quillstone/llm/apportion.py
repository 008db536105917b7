"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.llm.common import split_join, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, and how often at most it takes a word.
SHARE, REPEATS = 1.5, 2
#: Tokens in a block, at most.
BLOCK = 64
#: The smallest source's target holds so many blocks at least (while a block has a token): what its share may miss.
FINENESS = 256
#: Documents of its source that a shard holds, about, unless that would make more shards of a source than one task apportions.
SHARD_ROWS, MOST_SHARDS = 2000, 1 << 16
#: Rows of a plan that are broadcast, at most; a longer one meets its rows by key.
SENT = 200_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, repeats: float = REPEATS) -> list[float]:
    """Targets by weight, none above ``repeats`` times its size; what is cut off goes to the others by weight."""
    target, open_, left = [0.0] * len(sizes), [k for k, s in enumerate(sizes) if s > 0], float(total)
    for k in sorted(open_, key=lambda k: repeats * sizes[k] / weights[k]):
        rest = sum(weights[j] for j in open_)
        share = left * weights[k] / rest
        if share <= repeats * sizes[k]:
            for j in open_:
                target[j] = left * weights[j] / rest
            break
        target[k] = float(repeats * sizes[k])
        left -= target[k]
        open_ = [j for j in open_ if j != k]
    return target


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by the highest quotients votes / (2 n + 1), none above ``most``; ties go to the earlier party.

    The first seats are dealt at once: a divisor search gives the seats whose quotients surely win,
    and a heap hands out the few that are left, so the cost does not grow with the seats.
    """
    seats = min(seats, sum(m for v, m in zip(votes, most, strict=True) if v > 0))
    at = lambda d: [min(m, int(v / d + 0.5)) if v > 0 else 0 for v, m in zip(votes, most, strict=True)]
    if seats <= 0:
        return [0] * len(votes)
    low, high = 0.0, 2.0 * max(votes) + 1
    for _ in range(200):  # at high too few seats go out, at low too many
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (low, mid) if sum(at(mid)) <= seats else (mid, high)
    out = at(high)
    heap = [(-v / (2 * n + 1), k) for k, (v, n, m) in enumerate(zip(votes, out, most, strict=True)) if v > 0 and n < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, k = heapq.heappop(heap)
        out[k] += 1
        if out[k] < most[k]:
            heapq.heappush(heap, (-votes[k] / (2 * out[k] + 1), k))
    return out


def _targets(totals: Sequence, share: float, repeats: int, weights: Sequence[float]) -> tuple[list, list[int], list[float]]:
    """Sources (rows with none, source, size, n) in code point order, null last, with their sizes and targets."""
    totals = sorted(totals, key=lambda t: (t["none"], t["source"]))
    sizes = [t["size"] for t in totals]
    return totals, sizes, water_fill(sizes, [weights[k % len(weights)] for k in range(len(totals))], share * sum(sizes), repeats)


def _shards(n: int) -> int:
    return max(1, min(n // SHARD_ROWS, MOST_SHARDS))


def _cells(block: int, repeats: int, seed: int):
    def run(cells: pa.Table) -> pa.Table:
        """Of the shards of one source, the integer quota of each by highest quotients, how many blocks it has, and where its draw starts."""
        cells = cells.sort_by("shard")
        words, name = cells["words"].to_pylist(), (cells["none"][0].as_py(), cells["source"][0].as_py())
        have = [-(-repeats * w // block) for w in words]
        quotas = sainte_lague(words, cells["quota"][0].as_py(), have)
        starts = [zlib.crc32(f"{seed}:{name}:{s}".encode()) % max(b, 1) for s, b in zip(cells["shard"].to_pylist(), have, strict=True)]
        return pa.table({"none": cells["none"], "source": cells["source"], "shard": cells["shard"], "quota": pa.array(quotas, pa.int64()), "blocks": pa.array(have, pa.int64()), "start": pa.array(starts, pa.int64())})

    return run


def _dealt(rows: DataFrame, plan: list[tuple], seed: int, block: int, repeats: int, *by: str) -> DataFrame:
    """``rows`` (none, source, size, ...; a stored table) with what ``plan`` (none, source, source_size, target, quota, shards, n) says of their source, their shard, dealt by a
    seeded hash of the columns ``by``, and quota, blocks and start of that shard."""
    spark, of_source = rows.sparkSession, ["none", "source"]
    plan = stored(spark.createDataFrame(plan, "none boolean, source string, source_size long, target double, source_quota long, shards long, n long"), "mix-sources")
    rows = split_join(rows, plan, of_source, "n").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), *by), "shards").cast("int"))
    words = rows.groupBy(*of_source, "shard").agg(F.sum("size").alias("words"), F.first("source_quota").alias("quota"))
    cells = stored(words.groupBy(*of_source).applyInArrow(_cells(block, repeats, seed), "none boolean, source string, shard int, quota long, blocks long, start long"), "mix-cells")
    return rows.join(F.broadcast(cells) if cells.count() <= SENT else cells, [*of_source, "shard"])


def mix(spark: SparkSession, sized: DataFrame, seed: int = 17, share: float = SHARE, repeats: int = REPEATS, weights: Sequence[float] = WEIGHTS, block: int = BLOCK, fineness: int = FINENESS) -> DataFrame:
    """Add source_size, target, taken and passes (words taken in each reading) to ``sized`` (doc_id, source, size, ...).

    Documents of a source are dealt by seeded hash to shards, as many as its rows ask for. The words of a source and shard
    form a stream, read ``repeats`` times over and cut into blocks of equal tokens. Highest quotients give each source
    its blocks of the whole, and each shard of the source its integer quota of those. A seeded systematic draw then selects that many
    blocks of the stream, each at most once, so no word is taken more than ``repeats`` times.
    Null sources form one source, last in the order. Null ids, repeated rows and ties have an order by seeded hash, size and id.
    Tables without words give targets and takings of 0. The driver holds a row for each source; the shards of a source are apportioned in one task.
    """
    given = [c for c in sized.columns if c not in ("source_size", "target", "taken", "passes")]
    rows = stored(sized.select(F.struct(*given).alias("row"), F.col("source").isNull().alias("none"), F.coalesce(F.col("source"), F.lit("")).alias("source"), "size", "doc_id"), "mix-sizes")
    totals, sizes, targets = _targets(rows.groupBy("none", "source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect(), share, repeats, weights)
    block = max(1, min(block, int(min((t for t in targets if t > 0), default=1.0) // fineness)))
    quotas = sainte_lague(targets, round(sum(targets) / block), [-(-repeats * s // block) for s in sizes])
    plan = [(t["none"], t["source"], s, target, q, _shards(t["n"]), t["n"]) for t, s, target, q in zip(totals, sizes, targets, quotas, strict=True)]
    key = ["none", "source", "shard"]
    sized = _dealt(rows, plan, seed, block, repeats, "doc_id", "size").withColumn("draw", F.xxhash64(F.lit(seed), "doc_id"))
    before = Window.partitionBy(*key).orderBy("draw", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    out = sized.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("words", F.sum("size").over(whole))
    # chosen(j): blocks selected among the first j; tokens(x): words of selected blocks among the first x words of the stream
    chosen = lambda j: F.expr(f"(({j}) * quota + start) div blocks - start div blocks")
    full = lambda x: chosen(f"({x}) div {block}")
    part = lambda x: (chosen(f"({x}) div {block} + 1") - full(x)) * F.expr(f"({x}) % {block}")
    tokens = lambda x: full(x) * block + part(x)
    once = lambda a: tokens(f"{a} + size") - tokens(a)
    passes = [F.when(F.col("blocks") > 0, once(f"before + {p} * words")).otherwise(0) for p in range(repeats)]
    taken = passes[0]
    for p in passes[1:]:
        taken = taken + p
    return out.select("row.*", "source_size", "target", taken.cast("long").alias("taken"), F.array(*[p.cast("long") for p in passes]).alias("passes"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words of the text; null: none)."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def copies(sizes: Sequence[int], quota: int, chances: Sequence[float], repeats: int = REPEATS) -> list[int]:
    """How often to take each document, whole, so that the words come to ``quota``: sizes from the longest, a chance in [0, 1) for each.

    Each is taken at the rate that what is left of the quota has of the words left, so the shorter ones make up for the longer ones, and few words miss in the end.
    Where a document exceeds what is left (it still has its chance), or the rest twice over falls short of it, the quota is missed by less than that document.
    """
    out, left, rest = [], quota, sum(sizes)
    for size, chance in zip(sizes, chances, strict=True):
        out.append(int(min(max(left / rest, 0), repeats) + chance))
        left, rest = left - out[-1] * size, rest - size
    return out


def draw(cell: pa.Table) -> pa.Table:
    """Rows of one source and shard that are taken, with copies."""
    cell = cell.sort_by([("size", "descending"), ("draw", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
    taken = copies(cell["size"].to_pylist(), cell["quota"][0].as_py(), cell["chance"].to_pylist())
    return cell.select(["none", "source", "doc_id", "text"]).append_column("copies", pa.array(taken, pa.int32())).filter(pa.array([c > 0 for c in taken]))


def mixed(spark: SparkSession, docs: DataFrame, seed: int = 17, share: float = SHARE, repeats: int = REPEATS, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """The documents of the mix, whole, as often as it takes them, with their columns as they were.

    Sources get their targets in words by highest quotients, and shards of a source (dealt by seeded hash) their integer quotas of those; documents of a shard are drawn
    against its quota. Documents without words can't be drawn and go; null ids are ids like others; rows alike in source, doc_id and text are drawn alike.
    """
    key = ["none", "source", "doc_id", "text"]
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("source"), "doc_id", F.xxhash64("text").alias("text"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")).where("size > 0")
    units = stored(rows.groupBy(*key).agg(F.sum("size").alias("size")), "mix-units")
    totals, sizes, targets = _targets(units.groupBy("none", "source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect(), share, repeats, weights)
    quotas = sainte_lague(targets, round(sum(targets)), [repeats * s for s in sizes])
    plan = [(t["none"], t["source"], s, target, q, _shards(t["n"]), t["n"]) for t, s, target, q in zip(totals, sizes, targets, quotas, strict=True)]
    dealt = _dealt(units, plan, seed, 1, repeats, "doc_id", "text")
    dealt = dealt.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text")).withColumn("chance", F.pmod(F.xxhash64(F.lit(seed + 2), "doc_id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52)))
    times = dealt.select(*key, "shard", "size", "quota", "draw", "chance").groupBy("none", "source", "shard").applyInArrow(draw, f"none boolean, source string, doc_id {kind}, text long, copies int")
    times = times.select(F.when(~F.col("none"), F.col("source")).alias("source__"), F.col("doc_id").alias("doc_id__"), F.col("text").alias("text__"), "copies")
    alike = F.col("source").eqNullSafe(F.col("source__")) & F.col("doc_id").eqNullSafe(F.col("doc_id__")) & (F.xxhash64(docs["text"]) == F.col("text__"))
    return docs.join(times, alike).withColumn("copy__", F.explode(F.sequence(F.lit(1), times["copies"]))).select(*[docs[c] for c in docs.columns])
