"""Token ids in a content-addressed store.

The id stream of a document is cut where a rolling hash of the last ids says so, so equal passages give equal
chunks wherever they stand. Each distinct chunk is stored once under its digest;
a recipe for each document lists its digests in order, and Merkle manifests over the recipes verify what is read back.
All tables are Parquet in one folder: chunks (digest, ids), recipes (in ascending doc_id order), manifest.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import bounded, light, new_path, only, ordered, partitions, remembers, remove, small_batches, split_join, stored, text_or_empty
from quillstone.llm.remembered import STOP, TOGETHER, Remembered

END_ID = 0
#: Rolling hash: ids in the window; a cut at one position in so many; least and most ids in a chunk.
WINDOW, ONE_IN, LEAST, MOST = 8, 512, 128, 4096
#: Characters that Python takes for white space and the tokenizer does not.
ODD_SPACE = range(0x1C, 0x20)


def _plain() -> re.Pattern:
    """Finds a character outside the longer runs of code points that Python's Unicode tables assign; which of the others are letters, libraries know differently by their age."""
    runs, start = [], 0
    for c in range(0x10000):
        if c in ODD_SPACE or unicodedata.category(chr(c)) in ("Cn", "Cs"):
            if c - start >= 28:
                runs.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = c + 1
    return re.compile(f"[^{''.join(runs)}]")


NOT_PLAIN = _plain()
#: White space that is not ASCII: runs of it may go on beyond the bounds of pieces.
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True

CHUNKS = "digest binary, ids binary"
RECIPES = "doc_id long, n_tokens long, digests array<binary>"


def divided(raw: bytes) -> np.ndarray:
    """Where the pieces of texts begin, each text followed by STOP, which is a piece of its own.

    Pieces are words with one space before them, a full stop or comma that ends a word, and what is left of runs of white space: the tokenizer's own pre-tokens never cross their bounds.
    """
    b = np.frombuffer(raw, np.uint8)
    space, stop = _SPACE[b], b == STOP
    word = ~(space | stop)
    starts = np.zeros(len(b), bool)
    starts[0] = True
    starts[1:] |= stop[1:] | stop[:-1] | space[1:] & word[:-1]
    last = space[:-1] & word[1:]
    starts[:-1] |= last
    starts[1:] |= last & (b[:-1] != 32)
    mark = (b[1:-1] == 46) | (b[1:-1] == 44)
    starts[1:-1] |= mark & _ALNUM[b[:-2]] & ~word[2:]
    return np.flatnonzero(starts)


class Encoder:
    """Ids of whole texts by the tokenizers library, for byte-level BPE; the ids of pieces are remembered.

    The library divides new pieces into pre-tokens, and its model encodes those. A text with a special token, white space beyond ASCII, odd white space or a character that
    Python's tables do not assign goes through the library whole.
    """

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())["pre_tokenizer"]
        if spec["type"] != "ByteLevel" or spec["add_prefix_space"] or not spec["use_regex"] or self.tokenizer.normalizer:
            raise ValueError("a byte-level tokenizer without normaliser or prefix space is needed")
        self.tokens, self.parts = self.tokenizer.model.tokenize, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        # byte-level BPE writes a byte that can't be printed as the next character from 256 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.shown = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.remembered = Remembered(self._piece)

    def _whole(self, text: str) -> bool:
        return bool(self.special.search(text) or NOT_PLAIN.search(text) and any(ord(c) in ODD_SPACE or unicodedata.category(c) in ("Cn", "Cs") for c in set(text)) or not text.isascii() and WIDE_SPACE.search(text))

    def _piece(self, p: str) -> list[int]:
        if (p[1:] if p[0] == " " else p).isalpha():  # one pre-token
            return [t.id for t in self.tokens(p.replace(" ", self.shown[32]) if p.isascii() else p.encode().decode("latin-1").translate(self.shown))]
        return [t.id for part, _ in self.parts(p) for t in self.tokens(part)]

    def _together(self, texts: list[str], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        raw = b"".join([x for t in texts for x in (t.encode(), b"\xff")])
        return self.remembered.ids(raw, divided(raw), end)

    def streams(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, each followed by the id ``end`` if there is one; and where each text ends."""
        ids, ends, total, some = [], [], 0, []

        def add(x: np.ndarray, to: np.ndarray) -> None:
            nonlocal total
            ids.append(x)
            ends.append(to + total)
            total += len(x)

        for text in [*texts, None]:
            if text is not None and not self._whole(text):
                some.append(text)
                continue
            if some:
                add(*self._together(some, end))
                some = []
            if text is not None:
                x = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids + ([] if end is None else [end]), np.uint32)
                add(x, np.array([len(x)]))
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.concatenate([np.empty(0, np.int64), *ends])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.streams([text])[0].astype("<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}
remembers("token_store", _ENCODERS.clear)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Weights of ids in the rolling hash come from their number by this rule (a 64-bit finaliser).
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def cuts(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each document, whose ids lie between neighbouring ``bounds`` of ``ids``.

    A cut depends only on the last WINDOW ids and on the chunk's length so far.
    """
    w = _mixed(ids.astype(np.uint64))
    h = w.copy()
    for _ in range(WINDOW - 1):  # h[i] = sum of w[i - j] * 3 ** j
        h[1:] = w[1:] + np.uint64(3) * h[:-1]
    at = np.flatnonzero((h >> np.uint64(20)) % np.uint64(ONE_IN) == 0) + 1
    out, firsts = [], np.searchsorted(at, bounds)
    for k in range(len(bounds) - 1):
        start, end, mine = int(bounds[k]), int(bounds[k + 1]), []
        for c in at[firsts[k] : firsts[k + 1]].tolist():
            while c - start > MOST:
                start += MOST
                mine.append(start)
            if c - start >= LEAST and c < end:
                mine.append(c)
                start = c
        while end - start > MOST:
            start += MOST
            mine.append(start)
        out.append([*mine, end])
    return out


def _digest(x: bytes) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("token_store")
        enc, written = encoder(path), set()
        for batch in bounded(batches, 1, TOGETHER):
            ids, ends = enc.streams(batch.column(1).to_pylist(), END_ID)
            bounds = np.r_[0, ends]
            narrow = ids.astype("<u2").tobytes() if len(ids) and ids.max() < 1 << 16 else None
            digests, blobs, recipes = [], [], []
            for k, ends in enumerate(cuts(ids, bounds)):
                own, start = [], int(bounds[k])
                for e in ends:
                    # the first byte is the width of an id
                    blob = b"\x02" + narrow[2 * start : 2 * e] if narrow is not None else _blob(ids[start:e])
                    own.append(d := _digest(blob))
                    if d not in written:  # this task stores a chunk once, however hot it is
                        written.add(d)
                        digests.append(d)
                        blobs.append(blob)
                    start = e
                recipes.append(own)
            n, m = len(digests), len(recipes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([True] * n + [False] * m),
                    pa.array(digests + [None] * m, pa.binary()),
                    pa.array(blobs + [None] * m, pa.binary()),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), batch.column(0).cast(pa.int64())]),
                    pa.array([None] * n + np.diff(bounds).tolist(), pa.int64()),
                    pa.array([None] * n + recipes, pa.list_(pa.binary())),
                ],
                ["chunk", "digest", "ids", "doc_id", "n_tokens", "digests"],
            )

    return run


def _blob(ids: np.ndarray) -> bytes:
    return b"\x02" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\x04" + ids.astype("<u4").tobytes()


def ids_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the chunks of a partition, in order of digest, the first of each; recipes pass."""
    last = None
    for batch in batches:
        keep = []
        for chunk, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keep.append(not chunk or d != last)
            last = d if chunk else last
        yield batch.filter(pa.array(keep, pa.bool_()))


def _merkle(leaves: Iterable[bytes]) -> bytes:
    """Root of a binary tree over leaves in order, in memory that grows with the tree's height."""
    peaks: list[tuple[int, bytes]] = []
    for leaf in leaves:
        peaks.append((0, hashlib.sha256(b"\0" + leaf).digest()))
        while len(peaks) > 1 and peaks[-1][0] == peaks[-2][0]:
            (h, b), (_, a) = peaks.pop(), peaks.pop()
            peaks.append((h + 1, hashlib.sha256(b"\1" + a + b).digest()))
    while len(peaks) > 1:
        (_, b), (h, a) = peaks.pop(), peaks.pop()
        peaks.append((h + 1, hashlib.sha256(b"\1" + a + b).digest()))
    return peaks[0][1] if peaks else hashlib.sha256(b"").digest()


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with the Merkle root of each part; rows come in order of part and start."""
    part, leaves, out = None, [], []

    def rows():
        for batch in batches:
            c = batch.to_pydict()
            yield from zip(*(c[k] for k in ("part", "start", "doc_id", "n_tokens", "digests")), strict=True)

    def close():
        if part is not None:
            out.append((part, len(leaves), _merkle(leaves)))

    for p, start, doc_id, n, digests in rows():
        if p != part:
            close()
            part, leaves = p, []
        leaves.append(hashlib.sha256(f"{doc_id}:{start}:{n}:".encode() + b"".join(digests)).digest())
    close()
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["part", "documents", "root"])


def manifest(recipes: DataFrame) -> DataFrame:
    n = partitions(recipes.sparkSession)
    return recipes.repartition(n, "part").sortWithinPartitions("part", "start").mapInArrow(_roots, "part int, documents long, root binary")


def write_store(spark: SparkSession, docs: DataFrame, tokenizer_path: str, path: str | None = None) -> str:
    """Encode every whole text (null: empty), end each document with id 0, and write the store; its folder is returned.

    Texts are encoded once. Tasks drop chunks they have stored before, then chunks move once, by digest, to be
    stored once; recipes are small. Documents are in ascending doc_id order, null first, repeated ids in order of content.
    An empty table gives an empty store; extra columns are ignored.
    """
    small_batches(spark)
    path = path or new_path(spark, "token-store")
    rows = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(light(_encode(tokenizer_path)), "chunk boolean, digest binary, ids binary, doc_id long, n_tokens long, digests array<binary>")
    dealt = rows.repartition(partitions(spark), F.coalesce("digest", F.xxhash64("doc_id", "digests").cast("string").cast("binary"))).sortWithinPartitions("chunk", "digest")
    dealt.mapInArrow(_once, dealt.schema).write.option("compression", "zstd").partitionBy("chunk").parquet(f"{path}/parts")
    raw = _part(spark, f"{path}/parts/chunk=false", RECIPES)
    keyed = raw.withColumn("content", F.sha2(F.array_join(F.transform("digests", F.hex), ""), 256))
    out = ordered(keyed, ["doc_id", "content"], {"start": "n_tokens"}, "recipes", part="part")
    out.select("part", "doc_id", "start", "n_tokens", "digests").repartitionByRange(partitions(spark), "start").sortWithinPartitions("start").write.parquet(f"{path}/recipes")
    remove(spark, f"{path}/parts/chunk=false")
    manifest(_recipes(spark, path)).write.parquet(f"{path}/manifest")
    return path


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part int, doc_id long, start long, n_tokens long, digests array<binary>").parquet(f"{path}/recipes")


def _part(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)  # without a document, no part is written


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return _part(spark, f"{path}/parts/chunk=true", CHUNKS)


def verify(spark: SparkSession, path: str) -> None:
    """Hold the recipes against the Merkle manifest (a row for each part); raise where they differ."""
    found = {r["part"]: (r["documents"], bytes(r["root"])) for r in manifest(_recipes(spark, path)).collect()}
    said = {r["part"]: (r["documents"], bytes(r["root"])) for r in spark.read.parquet(f"{path}/manifest").collect()}
    if found != said:
        raise ValueError(f"recipes of {path} differ from their manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, length and crc32 (of the ids as 32-bit integers) of each stored chunk; raise where its digest differs."""
    for batch in batches:
        n, crc = [], []
        for d, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if _digest(blob) != d:
                raise ValueError(f"chunk {d.hex()} is damaged")
            ids = ids_of(blob)
            n.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["digest", "n", "crc"])


#: The polynomial of crc32, bits reversed.
POLYNOMIAL = np.uint32(0xEDB88320)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of polynomials over GF(2) modulo crc32's, element by element; the highest bit is the constant term."""
    out = np.zeros(np.broadcast(a, b).shape, np.uint32)
    for bit in range(31, -1, -1):
        out ^= b * (a >> np.uint32(bit) & np.uint32(1))
        b = b >> np.uint32(1) ^ POLYNOMIAL * (b & np.uint32(1))
    return out


def _powers() -> list[np.ndarray]:
    """x ** (32 d 256 ** k) for each digit d of 256 and place k: what ids that follow multiply a crc by."""
    step, out = np.array([1 << 31], np.uint32), []
    unit = np.array([0x80000000 >> 8], np.uint32)
    for _ in range(2):
        unit = _product(unit, unit)  # x ** 8, 16, 32
    for _ in range(5):
        row = [step]
        for _ in range(255):
            row.append(_product(row[-1], unit))
        out.append(np.concatenate(row))
        unit = _product(row[-1], unit)
    return out


_POWERS: list[np.ndarray] = []


def combined(ends: np.ndarray, n: np.ndarray, crc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and crc32 of concatenations from those of their parts; ``ends`` bounds the parts of each."""
    if not len(n):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if not _POWERS:
        _POWERS.extend(_powers())
    totals = np.add.reduceat(n, ends[:-1])
    after = np.repeat(np.cumsum(totals), np.diff(ends)) - np.cumsum(n)
    shifted = crc.astype(np.uint32)
    for k, row in enumerate(_POWERS):
        digit = after >> 8 * k & 255
        if digit.any():
            shifted = _product(row[digit], shifted)
    return totals, np.bitwise_xor.reduceat(shifted, ends[:-1]).astype(np.int64)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.column(2)
        ends = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        flat = parts.flatten()
        n, crc = combined(ends, flat.field("n").to_numpy(zero_copy_only=False), flat.field("crc").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document from the stored chunks and its recipe.

    Each chunk is read and hashed once, however many documents hold it; the crc32 of a document follows
    from those of its chunks. So only digests move, and uses of a hot chunk (that of empty texts, say) stay where they are.
    """
    verify(spark, path)
    chunks = _chunks(spark, path).mapInArrow(_read, "digest binary, n long, crc long")
    uses = _recipes(spark, path).select("doc_id", "start", F.posexplode("digests").alias("k", "digest"))
    there = F.when(F.col("n").isNull(), F.raise_error(F.concat(F.lit("chunk is missing: "), F.hex("digest"))).cast("long")).otherwise(F.col("n"))
    held = stored(uses.groupBy("digest").agg(F.count("*").alias("m")).join(chunks, "digest", "left").select("digest", there.alias("n"), "crc", "m"), "chunk-crcs")
    whole = split_join(uses, held, ["digest"], "m").groupBy("start", "doc_id").agg(F.collect_list(F.struct("k", "n", "crc")).alias("parts"))
    return whole.select("doc_id", "start", F.array_sort("parts").alias("parts")).mapInArrow(_whole, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and the ids (array<int>) of each document, put together from its recipe."""
    verify(spark, path)

    @F.pandas_udf("array<int>")
    def join(parts: pd.Series) -> pd.Series:
        return pd.Series([np.concatenate([ids_of(p["ids"]) for p in sorted(own, key=lambda p: p["k"])]).astype(np.int32) for own in parts])

    uses = _recipes(spark, path).select("doc_id", "start", F.posexplode("digests").alias("k", "digest"))
    whole = uses.join(_chunks(spark, path), "digest").groupBy("start", "doc_id").agg(F.collect_list(F.struct("k", "ids")).alias("parts"))
    return whole.select("doc_id", "start", join("parts").alias("ids"))
