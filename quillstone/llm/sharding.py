"""Sharding by histogram sort.

Splitters of a total order are found by counting exact bytes below candidate
boundaries in all partitions at once and refining the candidates between
rounds; when every splitter meets its tolerance the rows move once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.llm.common import LOWEST, packed, stored, text_or_empty

#: The key columns: group, order within the group, and a number that tells equal rows apart; bytes of a key.
KEY, WIDTH = ("k1", "k2", "k3"), 24
END = 1 << 8 * WIDTH
#: Candidates of the first round, and for each unmet splitter in later ones.
FIRST_PROBES, PROBES = 2048, 64
#: Most key ranges that rows are dealt to; the driver keeps a boundary for each.
MOST_RANGES = 8192


def _bytes(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(WIDTH, "big") for k in keys], dtype=f"S{WIDTH}")


def _counter(probes: list[int]):
    bounds = _bytes(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(bounds) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least: list[bytes | None] = [None] * n
        most: list[bytes | None] = [None] * n
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = packed(*(batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(KEY))))
            order = np.argsort(keys, kind="stable")
            keys, sizes = keys[order], batch.column(len(KEY)).to_numpy(zero_copy_only=False)[order]
            bins = np.searchsorted(bounds, keys, side="right")
            size += np.bincount(bins, weights=sizes, minlength=n).astype(np.int64)
            rows += np.bincount(bins, minlength=n)
            firsts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
            lasts = np.r_[firsts[1:], len(bins)] - 1
            for a, b in zip(firsts, lasts, strict=True):
                k, lo, hi = bins[a], bytes(keys[a]).ljust(WIDTH, b"\0"), bytes(keys[b]).ljust(WIDTH, b"\0")
                least[k] = lo if least[k] is None else min(least[k], lo)
                most[k] = hi if most[k] is None else max(most[k], hi)
        found = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(size[found], pa.int64()), pa.array(rows[found], pa.int64()), pa.array([least[k] for k in found], pa.binary()), pa.array([most[k] for k in found], pa.binary())],
            ["bin", "size", "n", "least", "most"],
        )

    return count


class Boundaries:
    """What is known of the order: exact bytes and rows below each probe, and the keys at the ends of each gap."""

    def __init__(self, keyed: DataFrame) -> None:
        self.keyed = keyed.select(*KEY, "size")
        self.at, self.below, self.rows = [0, END], [0, 0], [0, 0]
        self.ends: list[tuple[int, int] | None] = [None]
        self.rounds = 0

    def count(self, probes: list[int]) -> None:
        """Put exact counts at these new probes; one job over all partitions."""
        known = set(self.at)
        at = sorted(known | {p for p in probes if 0 < p < END})
        inner = at[1:-1]
        got = {r["bin"]: r for r in self.keyed.mapInArrow(_counter(inner), "bin int, size long, n long, least binary, most binary").groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect()}
        below, rows, ends = [0], [0], []
        for k in range(len(at) - 1):
            r = got.get(k)
            below.append(below[-1] + (r["size"] if r else 0))
            rows.append(rows[-1] + (r["n"] if r else 0))
            ends.append((int.from_bytes(r["least"], "big"), int.from_bytes(r["most"], "big")) if r else None)
        self.at, self.below, self.rows, self.ends = at, below, rows, ends
        self.rounds += 1

    def nearest(self, target: float) -> int:
        k = bisect_left(self.below, target)
        return min((i for i in (k - 1, k) if 0 <= i < len(self.at)), key=lambda i: abs(self.below[i] - target))

    def refine(self, target: float, tolerance: float) -> list[int]:
        """Probes that narrow the gap about ``target``; none if it is met or can't be narrowed."""
        if abs(self.below[self.nearest(target)] - target) <= tolerance:
            return []
        gap = bisect_left(self.below, target) - 1
        if gap < 0 or gap >= len(self.ends) or self.ends[gap] is None:
            return []
        least, most = self.ends[gap]
        if least == most:  # one row
            return [x for x in (least, least + 1) if x not in self.at and 0 < x < END]
        shift = 128 if least >> 128 != most >> 128 else 0  # boundaries between groups first; inside a group only where one spans the gap
        a, b = least >> shift, most >> shift
        n = min(PROBES, b - a)
        return [(a + (b - a) * i // n) << shift for i in range(1, n + 1)] + ([a << shift] if a << shift > self.at[gap] else []) + ([(b + 1) << shift] if (b + 1) << shift < END else [])


def histogram_sort(rows: DataFrame, shards: int, tolerance: float = 0.01, range_bytes: int = 64 << 20) -> DataFrame:
    """Deal ``rows`` to ``shards`` shards of near equal bytes, in the order of (k1, k2, k3).

    ``rows`` has k1, k2 and k3 (long; rows of equal k1 form a group; k3 tells rows apart and may be left out where k1 and k2 do), size (long) and any other
    columns; added are shard (int) and slot (long, gapless from 0 in each shard).
    A splitter may miss its ideal place by ``tolerance`` of a shard, and then lies between
    groups; a group is cut, by k2 and then k3, only where it spans more than that, so no
    hot group and no row that repeats makes a large shard or a large task.
    Within shards rows are dealt to ranges of about ``range_bytes`` (64 or more in all), so that no
    task holds a whole shard. An empty table gives no rows.
    """
    spark = rows.sparkSession
    given = rows.columns
    if KEY[2] not in given:
        rows = rows.withColumn(KEY[2], F.lit(0).cast("long"))
    known = Boundaries(rows)
    known.count([END * i // FIRST_PROBES for i in range(1, FIRST_PROBES)])
    total = known.below[-1]
    ranges = min(MOST_RANGES, shards * max(-(-64 // shards), -(-total // (range_bytes * shards))))
    main = [total * j / shards for j in range(1, shards)]
    fine = [total * j / ranges for j in range(1, ranges)]
    wanted = [(t, tolerance * total / shards) for t in main] + [(t, 0.3 * total / ranges) for t in fine]
    while probes := sorted({p for t, e in wanted for p in known.refine(t, e)} - set(known.at)):
        known.count(probes)
    chosen = sorted({known.nearest(t) for t in main} | {known.nearest(t) for t in fine} | {0})
    chosen = [k for k in chosen if k < len(known.at) - 1]
    cuts = [known.nearest(t) for t in main]
    shard_of = [sum(c <= k for c in cuts) for k in chosen]
    starts = [0, *cuts]
    base = [known.rows[k] - known.rows[starts[s]] for k, s in zip(chosen, shard_of, strict=True)]
    bounds = _bytes([known.at[k] for k in chosen[1:]])
    shard_at, base_at = np.array(shard_of, np.int32), np.array(base, np.int64)

    @F.pandas_udf("range int, shard int, base long")
    def place(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(bounds, packed(k1.to_numpy(), k2.to_numpy(), k3.to_numpy()), side="right")
        return pd.DataFrame({"range": at.astype(np.int32), "shard": shard_at[at], "base": base_at[at]})

    order = Window.partitionBy("place__.range").orderBy(*KEY)
    return rows.withColumn("place__", place(*KEY)).withColumn("slot", F.row_number().over(order) - 1 + F.col("place__.base")).select(*given, F.col("place__.shard").alias("shard"), "slot")


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 8, tolerance: float = 0.01) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    Size is the UTF-8 bytes of the text plus 1; a null text is empty. Equal texts are neighbours in the
    order and share a shard unless their bytes span a splitter by more than the tolerance.
    Null doc_ids come first among equal texts; rows that repeat have an order of their own and may be cut like others. Extra columns are ignored.
    """
    text = text_or_empty()
    keyed = stored(
        docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("k1"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("k2"), F.monotonically_increasing_id().alias("k3")),
        "shard-keys",
    )
    out = histogram_sort(keyed, shards, tolerance)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
