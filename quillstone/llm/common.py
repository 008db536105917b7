"""Shared helpers: table access, the shared working folder and ordered prefix sums."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The lowest long, in place of a null id: nulls come first.
LOWEST = -(1 << 63)


def packed(*longs: np.ndarray) -> np.ndarray:
    """Signed longs as bytes, eight for each, whose byte order is the order of the tuples."""
    parts = np.stack([x.astype(np.int64).view(np.uint64) for x in longs], axis=1) ^ np.uint64(1 << 63)
    return np.frombuffer(parts.astype(">u8").tobytes(), dtype=f"S{8 * len(longs)}")


_REMEMBERED: dict[str, Callable[[], object]] = {}


def remembers(name: str, forget: Callable[[], object]) -> None:
    """A module says how to drop what it keeps in a worker between tasks."""
    _REMEMBERED[name] = forget


def only(name: str) -> None:
    """Drop what other modules keep in this worker: workers outlive stages, and their memory is bounded by one operator's."""
    for other, forget in _REMEMBERED.items():
        if other != name:
            forget()


def _trim() -> None:
    """Give memory that is free back to the system: workers outlive stages, and the C library keeps what arrays have left."""
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def light(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for batches, after which a worker is as small as what it remembers."""

    def light_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()

    return light_run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    in a local session, as in tests, a temporary folder takes its place.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("a cluster must name a shared folder in spark.checkpoint.dir")
        base = tempfile.mkdtemp(prefix="quillstone-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Working tables of the operators that run now, innermost last.
_WORK: list[dict[int, tuple[DataFrame, str]]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if _WORK:
        _WORK[-1][id(out)] = (out, path)
    return out


@contextmanager
def working(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Working tables that are stored inside go at its end, but for those that the yielded function is told to keep, because the result reads them."""
    kept: list[tuple[DataFrame, str]] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(_WORK[-1].pop(id(df)))
        return df

    _WORK.append({})
    try:
        yield keep
    finally:
        for _, path in _WORK.pop().values():
            remove(spark, path)
        if _WORK:
            _WORK[-1].update({id(df): (df, path) for df, path in kept})


def remove(spark: SparkSession, df_or_path: DataFrame | str) -> None:
    """Delete a working table that no later result reads."""
    paths = [df_or_path] if isinstance(df_or_path, str) else {f.rpartition("/")[0] for f in df_or_path.inputFiles()}
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of one key that a task takes without being split from other keys, and the most keys that are broadcast.
SPLIT_ROWS, SPLIT_KEYS = 1000, 20_000


#: Rows that are broadcast, at most, where their number is counted first.
SENT = 1_000_000


def split_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has a row for each key and in ``weight`` how many rows of ``left`` hold it.

    Keys of more than SPLIT_ROWS rows and more than one in SPLIT_KEYS of all rows, so SPLIT_KEYS keys at most, are broadcast: their rows stay
    where they are. The others meet by key. Both sides are read twice, so they should be stored tables; ``weight`` is dropped. ``how`` is inner or left.
    """
    total, most = right.agg(F.sum(weight), F.max(weight)).first()
    bound = max(SPLIT_ROWS, (total or 0) // SPLIT_KEYS)
    hot, cold = right.where(F.col(weight) > bound).drop(weight), right.where(F.col(weight) <= bound).drop(weight)
    if (most or 0) <= bound:
        return left.join(right.drop(weight), keys, how)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys, how))


#: Bytes of one column that Python takes from an Arrow batch at a time, or one row.
TAKEN = 1 << 20


def bounded(batches: Iterable[pa.RecordBatch], column: int, most: int = TAKEN) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``most`` bytes of this text or binary column, or of one row."""
    for batch in batches:
        if batch.column(column).nbytes <= most:
            yield batch
            continue
        ends, start = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def small_batches(spark: SparkSession, most: int = TAKEN) -> None:
    """Bound the bytes of the Arrow batches that go to Python, for this session: plans read the setting when they run, so it can't be put back here."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) > most:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{most}b")


def let(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the value of ``x``, which is computed once however often ``then`` uses it."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def partitions(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ordered(df: DataFrame, keys: Iterable[str], sums: dict[str, str], name: str, part: str | None = None) -> DataFrame:
    """``df`` in key order, with exact sums over all rows before each one, for any number of rows.

    Rows are dealt by key range; running sums within a range need only that
    range, and the totals of the ranges (one row for each partition) give
    each range its offset. ``sums`` maps the output column to the summed one.
    """
    spark, keys = df.sparkSession, list(keys)
    dealt = df.repartitionByRange(partitions(spark), *keys).withColumn("part__", F.spark_partition_id())
    dealt = stored(dealt, f"{name}-ranges")
    within = Window.partitionBy("part__").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part__").agg(*[F.sum(c).alias(o) for o, c in sums.items()]).orderBy("part__").collect()
    offsets, so_far = [], dict.fromkeys(sums, 0)
    for t in totals:
        offsets.append((t["part__"], *so_far.values()))
        so_far = {o: so_far[o] + (t[o] or 0) for o in sums}
    schema = "part__ int, " + ", ".join(f"`{o}__` bigint" for o in sums)
    out = dealt.join(F.broadcast(spark.createDataFrame(offsets, schema)), "part__")  # a row for each partition
    for o, c in sums.items():
        out = out.withColumn(o, F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"{o}__"))
    out = out.withColumn(part, F.col("part__")) if part else out
    return out.drop("part__", *[f"{o}__" for o in sums])
