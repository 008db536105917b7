"""Threshold-scaled sketches of documents.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Whether a hash is kept depends on
that hash alone, so the sketch of a union is the union of the sketches, and shares of common hashes
estimate containment and resemblance however unequal two documents are. Short texts, of which that would leave nothing or little, keep all their
hashes; their sketches say so, and two sketches are compared and merged by the smaller of their fractions.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import LOWEST, bounded, packed, partitions, small_batches, text_or_empty

#: Code points in a shingle; one hash in so many is kept, but all of so few shingles; bits of a hash.
SHINGLE, ONE_IN, SHORT, BITS = 8, 16, 256, 40


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - BITS)


class Sketch(NamedTuple):
    """Every hash of a set that lies below one in ``one_in`` of the range, ascending."""

    one_in: int
    hashes: np.ndarray

    def at(self, one_in: int) -> Sketch:
        """The sketch of the same set by a fraction as small or smaller."""
        return self if one_in <= self.one_in else Sketch(one_in, self.hashes[self.hashes < np.uint64((1 << BITS) // one_in)])


def sketch(text: str) -> Sketch:
    """The sketch of a text's shingles of SHINGLE code points: one hash in ONE_IN, but of SHORT shingles or fewer all. A shorter text is one shingle, an empty one has none."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(c):
        return Sketch(1, np.empty(0, np.uint64))
    k = min(SHINGLE, len(c))
    h = np.zeros(len(c) - k + 1, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x100000001B3) + c[j : len(c) - k + 1 + j] + np.uint64(1)
    h, one_in = _mixed(h), 1 if len(h) <= SHORT else ONE_IN
    return Sketch(one_in, np.unique(h[h < np.uint64((1 << BITS) // one_in)]))


def fingerprint(text: str, kept: Sketch) -> str:
    """Shingles in the text (positions), of how many hashes one is kept, then those of five bytes each in base 64."""
    raw = kept.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes()
    return f"{max(len(text) - SHINGLE + 1, min(len(text), 1))}:{kept.one_in}:{base64.b64encode(raw).decode()}"


def sketched(fp: str) -> Sketch:
    """The sketch in a fingerprint."""
    _, one_in, kept = fp.split(":")
    raw = np.frombuffer(base64.b64decode(kept), np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - BITS // 8 :] = raw
    return Sketch(int(one_in), wide.reshape(-1).view(">u8").astype(np.uint64))


def alike(a: Sketch, b: Sketch) -> tuple[Sketch, Sketch]:
    """Both by the smaller of their fractions."""
    return a.at(b.one_in), b.at(a.one_in)


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of the union, by the smaller of the fractions."""
    a, b = alike(a, b)
    return Sketch(a.one_in, np.union1d(a.hashes, b.hashes))


def containment(a: Sketch, b: Sketch) -> float | None:
    """Estimated share of the shingles of a that b has; None if a keeps no hash by the smaller fraction."""
    a, b = alike(a, b)
    return len(np.intersect1d(a.hashes, b.hashes, assume_unique=True)) / len(a.hashes) if len(a.hashes) else None


def resemblance(a: Sketch, b: Sketch) -> float | None:
    """Estimated Jaccard similarity; None if neither keeps a hash by the smaller fraction."""
    a, b = alike(a, b)
    common = len(np.intersect1d(a.hashes, b.hashes, assume_unique=True))
    return common / (len(a.hashes) + len(b.hashes) - common) if len(a.hashes) + len(b.hashes) else None


def likeness(x: tuple[str, Sketch], y: tuple[str, Sketch]) -> float:
    """Containment of the first fingerprint's hashes in the second's; where nothing tells it (an empty text, or a short one that keeps no hash by a long one's fraction), whether the fingerprints are equal."""
    share = containment(x[1], y[1])
    return float(x[0] == y[0]) if share is None else share


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first code points of the following text, or all of them."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range: its documents in order, then those of the start of the next range."""
    held: tuple | None = None  # the document before, whose next is not yet known
    out: list[tuple] = []

    def of(text: str) -> tuple[str, Sketch]:
        kept = sketch(text)
        return fingerprint(text, kept), kept

    for batch in bounded(batches, 3):
        c = batch.to_pydict()
        for span, ahead, doc_id, text in zip(c["span"], c["ahead"], c["doc_id"], c["text"], strict=True):
            if ahead and (held is None or held[0] != span):
                continue  # only the first of these is needed
            own = of(text)
            if held is not None:
                _, before, was, fp = held
                new = edited(was, text)
                fp_new = of(new)
                out.append((before, len(was), hashlib.sha256(new.encode()).hexdigest(), fp[0], fp_new[0], likeness(fp, fp_new), likeness(fp, own), resemblance(fp[1], fp_new[1]), resemblance(fp[1], own[1])))
            held = None if ahead else (span, doc_id, text, own)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(KINDS)], list(COLUMNS))
        out = []


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "resemblance_edited", "resemblance_next")
KINDS = (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4)


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with likenesses to the edited and the next text.

    Next is by ascending doc_id, null first, ties by the text's hash; after the last comes the first. Ids alone are
    dealt first, to find a start for each range; then texts move once, and the first document of each range
    also goes to the range before it. A null text is empty. An empty table gives no rows; extra columns are ignored.
    """
    small_batches(spark)
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumns({"k1": F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)), "k2": F.xxhash64("text")})
    n = partitions(spark)
    starts = sorted((r["least"]["k1"], r["least"]["k2"]) for r in rows.select("k1", "k2").repartitionByRange(n, "k1", "k2").groupBy(F.spark_partition_id()).agg(F.min(F.struct("k1", "k2")).alias("least")).collect())  # one for each range
    bounds = packed(np.array([s[0] for s in starts], np.int64), np.array([s[1] for s in starts], np.int64)) if starts else np.empty(0, "S16")

    @F.pandas_udf("array<struct<span:int,ahead:boolean>>")
    def place(k1: pd.Series, k2: pd.Series) -> pd.Series:
        keys = packed(k1.to_numpy(), k2.to_numpy())
        at = np.searchsorted(bounds, keys, side="right") - 1
        first = bounds[at] == keys
        return pd.Series([[{"span": int(a), "ahead": False}, {"span": int(a - 1) % len(bounds), "ahead": True}] if f else [{"span": int(a), "ahead": False}] for a, f in zip(at, first, strict=True)])

    placed = rows.withColumn("place", F.explode(place("k1", "k2"))).select("place.span", "place.ahead", "k1", "k2", "doc_id", "text")
    dealt = placed.repartitionById(max(len(bounds), 1), "span").sortWithinPartitions("span", "ahead", "k1", "k2").select("span", "ahead", "doc_id", "text")
    return dealt.mapInArrow(_prints, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, resemblance_edited double, resemblance_next double")
