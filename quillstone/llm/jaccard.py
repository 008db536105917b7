"""Exact Jaccard join of documents on word shingles, by rare-first prefix filtering.

Two sets of similarity t share a token among the first n - ceil(t n) + 1 of each in any common order of tokens. The order here puts rare
tokens first, by exact counts of the documents that hold each. Tokens that only one document holds are the rarest and can't be shared, so a document with more
of them than its prefix is long has no partner and goes early; the others keep the tokens that they share with any other document as their record.
Prefix tokens of records bring pairs together; pairs pass length, positional and suffix filters and are verified once, on whole sets.

Only what links reach is asked for, so groups of near copies are not spelled out in pairs: equal sets are
one class; each document is first held against the documents that stand for its prefix tokens; after that only documents of different components are
compared, in blocks: first those that the same document stands for, whole sets in one place, then pairs of others that share a prefix token. For those nothing is skipped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.llm.common import SENT, bounded, light, only, partitions, small_batches, split_join, stored, text_or_empty, working
from quillstone.llm.components import components

#: Words in a shingle; similarity in hundredths.
WORDS, PERCENT = 5, 75
#: Bytes of the name of a set; bits of a token that are kept beside its part of the hash range.
NAME, KEPT = 12, 48
#: Documents that one is first held against; members checked in one piece of work; documents of a token that are compared with as many others in one block.
STANDS, PIECE, BLOCK = 2, 1024, 1024
#: Least and most bits of a set's parity.
PARITY = (512, 4096)
#: Tokens that a task gathers before it hands them on; bytes of text that are hashed together.
GATHER, TOGETHER = 1 << 20, 1 << 18
#: Multiplier of the polynomial hash of a word's bytes.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, BASE)], dtype=np.uint64)
    return _POWERS


def _chain(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbouring words."""
    m = len(w) - k + 1
    h = np.full(m, k, np.uint64)
    for j in range(k):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[j : m + j])
    return h


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The set of hashed word shingles of each text, ascending. Letters A-Z count as a-z; words are what ASCII white space divides; fewer words are one shingle.

    Texts are hashed together, TOGETHER bytes or one text at a time.
    """
    out, some, size = [], [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass").lower()  # bytes: ASCII case only
        if some and size + len(raw) > TOGETHER:
            out += _sets(some, words)
            some, size = [], 0
        some.append(raw)
        size += len(raw)
    return out + (_sets(some, words) if some else [])


def _sets(raw: list[bytes], words: int) -> list[np.ndarray]:
    b = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    at = np.flatnonzero(~_SPACE[b])
    if not len(at):
        return [np.empty(0, np.uint64) for _ in raw]
    first = np.r_[True, at[1:] != at[:-1] + 1]
    starts = np.flatnonzero(first)  # of words, among the bytes that are not space
    lengths = np.diff(np.r_[starts, len(at)])
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    w = _mixed(np.add.reduceat((b[at].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()) + 1)[place], starts) + lengths.astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    per = np.diff(np.r_[0, np.searchsorted(at[starts], ends)])  # words of each text
    bounds = np.r_[0, np.cumsum(per)]
    all_ = _chain(w, words) if len(w) >= words else np.empty(0, np.uint64)
    out = []
    for n, s, e in zip(per.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        h = np.sort(all_[s : e - words + 1]) if n >= words else _chain(w[s:e], n) if n else np.empty(0, np.uint64)
        out.append(h[np.r_[True, h[1:] != h[:-1]]] if n else h)
    return out


def need(n: int, percent: int = PERCENT) -> int:
    """The tokens that a set of ``n`` shares with any set that it links with, at least."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - need(n, percent) + 1 if n else 0


def parity(tokens: np.ndarray) -> bytes:
    """A bit for each part of the range of hashed tokens: whether the set has an odd number there. Two sets differ in at least as many tokens as bits.

    Sets of more tokens have more bits, a power of two; a longer parity folds to a shorter one.
    """
    bits = min(PARITY[1], max(PARITY[0], 1 << (4 * len(tokens)).bit_length()))
    return np.packbits((np.bincount((_mixed(tokens) >> np.uint64(7)) % np.uint64(bits), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """Rows of parities, each folded to so many words of 64 bits."""
    while x.shape[1] > words:
        x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
    return x


def name(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=NAME).digest()


def _of_name(raw: np.ndarray, n: int) -> np.ndarray:
    """The part, of ``n``, that keeps the record of a set of this name."""
    return (np.ascontiguousarray(raw.view(np.uint8).reshape(-1, NAME)[:, :8]).view("<u8").ravel() % np.uint64(n)).astype(np.int32)


def _meta(n: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document the size and name of its set, and the part that keeps its record."""
        only("jaccard")
        for batch in bounded(batches, 1):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            names = [name(h) if len(h) else None for h in sets]
            home = [int.from_bytes(x[:8], "little") % n if x else None for x in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(h) for h in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(home, pa.int32())], ["doc", "n", "name", "home"])

    return run


def _packed(names: np.ndarray, of: np.ndarray, tokens: np.ndarray, *more: np.ndarray) -> bytes:
    """Tokens, with the entry of each in ascending order, as one blob: names and numbers of tokens of the entries that occur, then columns."""
    entry, counts = np.unique(of, return_counts=True)
    columns = (np.uint32(len(entry)), names[entry], counts.astype("<u4"), (tokens & np.uint64(0xFFFFFFFF)).astype("<u4"), (tokens >> np.uint64(32)).astype("<u2"), *more)
    return b"".join(c.tobytes() for c in columns)


def _unpacked(blob: bytes, more: int = 0) -> tuple[np.ndarray, ...]:
    """Names, counts, tokens and further columns of bytes."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    at = 4 + (NAME + 4) * n
    m = (len(blob) - at) // (6 + more)
    token = np.frombuffer(blob, "<u4", m, at) | np.frombuffer(blob, "<u2", m, at + 4 * m).astype(np.uint64) << np.uint64(32)
    return np.frombuffer(blob, f"S{NAME}", n, 4), np.frombuffer(blob, "<u4", n, 4 + NAME * n).astype(np.int64), token, *(np.frombuffer(blob, np.uint8, m, at + (6 + k) * m) for k in range(more))


def _dealt(n: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All tokens of the classes of a task, dealt to ``n`` parts of the hash range; a class is handed on once."""
        only("jaccard")
        seen: set[bytes] = set()
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            names = np.frombuffer(b"".join(name(h) for h in held), f"S{NAME}")
            token = np.concatenate([np.empty(0, np.uint64), *held])
            of = np.repeat(np.arange(len(held)), [len(h) for h in held])
            at = (token % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.uint32)
            by = np.argsort(at, kind="stable")
            at, of, token = at[by], of[by], token[by] // np.uint64(n) & np.uint64((1 << KEPT) - 1)
            part, first = np.unique(at, return_index=True)
            ends = [*first[1:].tolist(), len(at)][: len(first)]
            return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array([_packed(names, of[s:e], token[s:e]) for s, e in zip(first.tolist(), ends, strict=True)], pa.binary())], ["part", "tokens"])

        for batch in bounded(batches, 1):
            for h in shingle_sets(batch.column(1).to_pylist(), words):
                if not len(h) or (s := name(h)) in seen:
                    continue
                seen.add(s)
                held.append(h)
                size += len(h)
                if size >= GATHER:
                    yield flush()
                    held, size = [], 0
        yield flush()

    return run


def _joined(blobs: list[tuple], at: int) -> np.ndarray:
    return np.concatenate([b[at] for b in blobs])


def _frequencies(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of one part of the hash range, the tokens that two classes or more hold, with a number that grows with how many do, dealt to the parts that keep records."""
        part, blobs = None, []
        for batch in batches:
            for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = p
                blobs.append(_unpacked(raw))
        if not blobs:
            return
        names, counts, token = (_joined(blobs, k) for k in range(3))
        del blobs
        names, first, of = np.unique(names, return_index=True, return_inverse=True)
        own = np.repeat(np.isin(np.arange(len(of)), first, assume_unique=True), counts)  # several tasks may hand on a class
        token, of = token[own], np.repeat(of, counts)[own].astype(np.int32)
        by = np.argsort(token, kind="stable")
        token, of = token[by], of[by]
        sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, token[1:] != token[:-1]]), len(token)]) if len(token) else np.empty(0, np.int64)
        holders = np.repeat(sizes, sizes)
        keep = holders > 1
        token, of, holders = token[keep], of[keep], holders[keep]
        rank = np.minimum(255, 8 * np.log2(holders)).astype(np.uint8)
        home = _of_name(names, n) if len(names) else np.empty(0, np.int32)
        by = np.argsort(home[of].astype(np.int64) * max(len(names), 1) + of, kind="stable")
        token, of, rank = token[by], of[by], rank[by]
        to, first = np.unique(home[of], return_index=True)
        ends = [*first[1:].tolist(), len(of)][: len(first)]
        for k in range(0, len(to), 64):
            some = list(zip(first.tolist(), ends, strict=True))[k : k + 64]
            yield pa.RecordBatch.from_arrays([pa.array(to[k : k + 64].astype(np.int32)), pa.array([part] * len(some), pa.int32()), pa.array([_packed(names, of[s:e], token[s:e], rank[s:e]) for s, e in some], pa.binary())], ["home", "part", "tokens"])

    return run


RECORD = "rep long, n long, tokens binary, parity binary"


def _records(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are shared tokens of one part of the names, and its classes (name, n, rep). A record holds the shared tokens of a class that may have a partner, rarest first."""
        names, sizes, reps, blobs = [], [], [], []
        for batch in batches:
            for part, raw, name_, size, rep in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                if raw is None:
                    names.append(name_)
                    sizes.append(size)
                    reps.append(rep)
                else:
                    held, counts, token, rank = _unpacked(raw, 1)
                    blobs.append((held, counts, token * np.uint64(n) + np.uint64(part), rank))
        if not blobs:
            return
        known = np.frombuffer(b"".join(names), f"S{NAME}")
        by = np.argsort(known, kind="stable")
        held, counts, token, rank = (_joined(blobs, k) for k in range(4))
        del blobs
        entry = by[np.searchsorted(known, held, sorter=by)]
        size, rep = np.array(sizes, np.int64), np.array(reps, np.int64)
        shared = np.bincount(entry, counts, len(size)).astype(np.int64)
        may = shared >= -(-percent * size // 100)
        of = np.repeat(entry, counts)
        keep = may[of]
        of, token, rank = of[keep], token[keep], rank[keep]
        by = np.lexsort((token, rank, of))
        of, token = of[by], token[by]
        which, first = np.unique(of, return_index=True)
        ends = [*first[1:].tolist(), len(of)][: len(first)]
        spans = list(zip(which.tolist(), first.tolist(), ends, strict=True))
        for k in range(0, len(spans), 256):
            some = spans[k : k + 256]
            at = [w for w, _, _ in some]
            yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(size[at]), pa.array([token[s:e].tobytes() for _, s, e in some], pa.binary()), pa.array([parity(token[s:e]) for _, s, e in some], pa.binary())], ["rep", "n", "tokens", "parity"])

    return run


def _postings(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shared tokens in the prefix of each record, with their places; those that nothing shares come before them."""
        for batch in batches:
            token, id_, n, pos = [np.empty(0, np.int64)], [], [], [np.empty(0, np.int32)]
            for i, size, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                t = np.frombuffer(raw, np.int64)
                alone = size - len(t)
                t = t[: max(0, prefix_length(size, percent) - alone)]
                token.append(t)
                pos.append(np.arange(alone, alone + len(t), dtype=np.int32))
                id_.append((i, size, len(t)))
            m = [x[2] for x in id_]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token)), pa.array(np.repeat([x[0] for x in id_], m).astype(np.int64)), pa.array(np.repeat([x[1] for x in id_], m).astype(np.int64)), pa.array(np.concatenate(pos))], ["token", "id", "n", "pos"])

    return run


def linked(a: np.ndarray, b: np.ndarray, na: int, nb: int, percent: int = PERCENT) -> bool:
    """Whether sets of sizes ``na`` and ``nb`` link, by their shared tokens; those of ``a`` ascend."""
    if 100 * min(na, nb) < percent * max(na, nb) or not len(a):
        return False
    at = np.searchsorted(a, b)
    common = int(np.count_nonzero(a[np.minimum(at, len(a) - 1)] == b))
    return 100 * common >= percent * (na + nb - common)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by pivot and piece of work, the pivot first."""
        key, pivot, size, to = None, np.empty(0, np.uint64), 0, None
        for batch in bounded(batches, 6):
            out = []
            for p, piece, member, id_, rep, n, raw in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                t = np.frombuffer(raw, np.uint64)
                if not member:
                    key, pivot, size, to = (p, piece), np.sort(t), n, rep
                elif key == (p, piece):
                    out.append((p, id_, to, rep, linked(pivot, t, size, n, percent)))
            yield pa.RecordBatch.from_arrays([*(pa.array([x[k] for x in out], pa.int64()) for k in range(4)), pa.array([x[4] for x in out], pa.bool_())], ["pivot", "id", "u", "v", "ok"])

    return run


def verified(records: DataFrame, pairs: DataFrame, percent: int, called: str) -> DataFrame:
    """(pivot, id, u, v, ok) of ``pairs`` (pivot, id), a stored table without repeated rows; u and v are the documents that stand for them. A record moves once for each pair that it is a member of, and as pivot once for each piece of members."""
    sizes = stored(pairs.groupBy("pivot").agg(F.count("*").alias("m")).withColumn("pieces", F.ceil(F.col("m") / PIECE).cast("int")), "pivots")
    members = split_join(pairs, sizes, ["pivot"], "m").select("pivot", F.pmod(F.xxhash64("id"), "pieces").cast("int").alias("piece"), F.lit(True).alias("member"), "id")
    heads = sizes.select("pivot", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(False).alias("member"), F.col("pivot").alias("id"))
    rows = members.unionByName(heads).join(records.select("id", "rep", "n", "tokens"), "id").select("pivot", "piece", "member", "id", "rep", "n", "tokens")
    dealt = rows.repartition(partitions(records.sparkSession), "pivot", "piece").sortWithinPartitions("pivot", "piece", "member", "id")
    out = stored(dealt.mapInArrow(light(_verify(percent)), "pivot long, id long, u long, v long, ok boolean"), called)
    return out


class Block:
    """Documents that share a key, some of them to be held against all."""

    def __init__(self, rows: list[pa.RecordBatch], percent: int) -> None:
        t = pa.Table.from_batches(rows)
        self.percent = percent
        self.left, self.id, self.rep, self.n, self.alone, self.component, self.group, self.pos = (t.column(c).to_numpy() for c in ("left", "id", "rep", "n", "alone", "component", "group", "pos"))
        self.component, self.minor = self.component.copy(), t.column("minor").to_numpy()
        self.tokens = t.column("tokens").to_pylist()
        raw = t.column("parity").to_pylist()
        self.wide, self.parities = np.array([len(r) // 8 for r in raw]), {}
        for w in np.unique(self.wide).tolist():  # parities of at least so many words, folded to that
            rows_ = self.parities[w] = np.zeros((len(raw), w), np.uint64)
            for v in np.unique(self.wide[self.wide >= w]).tolist():
                own = np.flatnonzero(self.wide == v)
                rows_[own] = folded(np.frombuffer(b"".join(raw[k] for k in own), np.uint64).reshape(-1, v), w)
        right = np.flatnonzero(~self.left)
        self.right = right[np.argsort(self.n[right], kind="stable")]

    def close(self, i: int, within: bool) -> np.ndarray:
        """Rows of other components that the length, positional and suffix filters leave for row ``i``; of the same group or of others."""
        n, percent = self.n, self.percent
        low, high = np.searchsorted(n[self.right], [-(-percent * n[i] // 100), 100 * n[i] // percent + 1])
        j = self.right[low:high]
        keep = (self.component[j] != self.component[i]) & ((self.id[i] < self.id[j]) | ~self.minor[j])  # two that are held against all meet once
        if not within:
            keep &= self.group[j] != self.group[i]
            most = np.minimum(self.pos[i], self.pos[j]) + np.minimum(n[i] - self.pos[i], n[j] - self.pos[j])  # tokens they may share before this one, and from it on
            keep &= (100 + percent) * most >= percent * (n[i] + n[j])
        j = j[keep]
        apart = self.alone[i] + self.alone[j]
        for w, rows in self.parities.items():
            own = np.minimum(self.wide[i], self.wide[j]) == w
            apart[own] += np.bitwise_count(rows[j[own]] ^ rows[i]).sum(axis=1, dtype=np.int64)
        return j[(100 + percent) * apart <= (100 - percent) * (n[i] + n[j])]

    def pairs(self) -> np.ndarray:
        """(pivot, id) of pairs of different groups to be verified."""
        out = [np.empty((0, 2), np.int64)]
        for i in np.flatnonzero(self.left).tolist():
            j = self.close(i, False)
            out.append(np.stack([np.minimum(self.id[j], self.id[i]), np.maximum(self.id[j], self.id[i])], axis=1))
        return np.concatenate(out)

    def links(self) -> np.ndarray:
        """(u, v) of links that join components, verified on whole sets: one for each two components that become one."""
        flat = np.frombuffer(b"".join(self.tokens), np.uint64)
        sizes = np.array([len(x) // 8 for x in self.tokens])
        start = np.cumsum(sizes) - sizes
        distinct, code = np.unique(flat, return_inverse=True)
        has, out = np.zeros(len(distinct), bool), []
        for i in np.flatnonzero(self.left).tolist():
            j = self.close(i, True)
            own = code[start[i] : start[i] + sizes[i]]
            has[own] = True
            for k in range(0, len(j), 256):
                some = j[k : k + 256]
                some = some[sizes[some] > 0]
                if not len(some):
                    continue
                ends = np.cumsum(sizes[some])
                held = code[np.arange(ends[-1]) + np.repeat(start[some] - ends + sizes[some], sizes[some])]
                common = np.add.reduceat(has[held], ends - sizes[some], dtype=np.int64)
                for x in some[100 * common >= self.percent * (self.n[i] + self.n[some] - common)].tolist():
                    if self.component[x] != self.component[i]:
                        out.append((self.rep[i], self.rep[x]))
                        self.component[self.component == self.component[x]] = self.component[i]
            has[own] = False
        return np.array(out, np.int64).reshape(-1, 2)


def _compared(percent: int, within: bool):
    names = ["u", "v"] if within else ["pivot", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block. What several blocks of a task find leaves it once."""
        held: list[pa.RecordBatch] = []
        key, found = None, np.empty((0, 2), np.int64)

        def close() -> None:
            nonlocal found
            if held:
                block = Block(held, percent)
                found = np.concatenate([found, block.links() if within else block.pairs()])

        for batch in batches:
            if not batch.num_rows:
                continue
            of = [batch.column(k).to_numpy() for k in range(3)]
            edge = np.zeros(batch.num_rows, bool)
            for c in of:
                edge[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(edge).tolist(), batch.num_rows]
            for s, e in zip(starts, starts[1:], strict=False):
                now = tuple(c[s] for c in of)
                if now != key:
                    close()
                    held = []
                    if len(found) > GATHER:
                        found = np.unique(found, axis=0)
                    if len(found) > GATHER // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names)
                        found = found[:0]
                key = now
                held.append(batch.slice(s, e - s))
        close()
        found = np.unique(found, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names)

    return run


def _blocks(rows: DataFrame, records: DataFrame, key: str, tokens: bool) -> DataFrame:
    """``rows`` (key, id, component, group, main, pos; a stored table) in blocks by ``key``: those of another component than ``main`` are held against all of the key.

    So a group whose documents are linked with the one that stands for them costs its rows, not their square. Keys whose documents are all of one component go.
    """
    n = partitions(rows.sparkSession)
    rows = rows.withColumn("minor", F.col("component") != F.col("main"))
    chunks = lambda c: F.ceil(c / BLOCK).cast("int")
    sizes = rows.groupBy(key).agg(F.count("*").alias("m"), F.count_if("minor").alias("k"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    sizes = stored(sizes.select(key, "m", chunks(F.col("k")).alias("lefts"), chunks(F.col("m")).alias("rights")), "sizes")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    at = lambda c: F.pmod(F.xxhash64("id"), c).cast("int")
    beside = records.select("id", "rep", "n", (F.col("n") - F.octet_length("tokens") / 8).cast("long").alias("alone"), "parity", (F.col("tokens") if tokens else F.lit(None).cast("binary")).alias("tokens"))
    whole = split_join(rows, sizes, [key], "m").join(beside, "id")
    row = lambda left: [F.lit(left).alias("left"), "minor", "id", "rep", "n", "alone", F.col("pos").cast("long").alias("pos"), "component", "group", "parity", "tokens"]
    placed = whole.select(F.col(key).alias("key"), every("lefts").alias("a"), at("rights").alias("b"), *row(False)).unionByName(whole.where("minor").select(F.col(key).alias("key"), at("lefts").alias("a"), every("rights").alias("b"), *row(True)))
    return placed.repartition(n, "key", "a", "b").sortWithinPartitions("key", "a", "b")


def join(spark: SparkSession, documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach) of every document.

    Null, empty and blank texts have no shingles and link with nothing. Rows with a null doc_id have a null component. Rows that
    repeat a doc_id are one node, which links whatever any of their texts links with. Extra columns are ignored; an empty table gives no rows.
    """
    small_batches(spark)
    with working(spark) as keep:
        return _join(spark, documents, words, percent, keep)


def _join(spark: SparkSession, documents: DataFrame, words: int, percent: int, keep) -> DataFrame:
    n = partitions(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text"))
    meta = keep(stored(docs.mapInArrow(light(_meta(n, words)), "doc long, n long, name binary, home int"), "shingle-meta"))
    nodes = meta.where("doc is not null and n > 0")
    classes = stored(nodes.groupBy("name").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("home").alias("home"), F.count("*").alias("copies")), "classes")

    # exact counts of all tokens, and the records of classes that share enough of theirs with any others
    dealt = docs.where("doc is not null").mapInArrow(light(_dealt(n, words)), "part int, tokens binary").repartitionById(n, "part")
    shared = dealt.mapInArrow(light(_frequencies(n)), "home int, part int, tokens binary").select("home", "part", "tokens", F.lit(None).cast("binary").alias("name"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("rep"))
    own = classes.select("home", F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("tokens"), "name", "n", "rep")
    records = stored(shared.unionByName(own).repartitionById(n, "home").mapInArrow(light(_records(n, percent)), RECORD).withColumn("id", F.monotonically_increasing_id()), "records")

    # tokens of near copies are held by nearly the same documents: the same few stand for them. Each document is held against those it shares most tokens with
    postings = stored(records.select("id", "n", "tokens").mapInArrow(light(_postings(percent)), "token long, id long, n long, pos int"), "postings")
    runs = stored(postings.groupBy("token").agg(F.count("*").alias("m"), F.min("id").alias("pivot")).where("m > 1"), "runs")
    met = split_join(postings.select("token", "id"), runs, ["token"], "m").where("id <> pivot").groupBy("id", "pivot").agg(F.count("*").alias("k"))
    nearest = Window.partitionBy("id").orderBy(F.desc("k"), "pivot")
    near = stored(met.withColumn("nearest", F.row_number().over(nearest)).where(F.col("nearest") <= STANDS), "nearest")
    tried = verified(records, near.select("pivot", "id"), percent, "tried")
    edges = tried.where("ok").select("u", "v")
    known = stored(components(edges), "first-components")

    # every other pair of different components: those that the same document stands for are compared in whole, others that share a prefix token after that
    def placed(known: DataFrame) -> DataFrame:
        group = near.where("nearest = 1").select("id", F.col("pivot").alias("group"))
        return stored(records.select("id", "rep").join(known.withColumnRenamed("node", "rep"), "rep", "left").join(group, "id", "left").select("id", F.coalesce("component", "rep").alias("component"), F.coalesce("group", "id").alias("group")), "placed")

    def mains(keys: DataFrame, of: DataFrame, key: str) -> DataFrame:
        """(key, main, m): the component of the document that stands for each key."""
        return stored(keys.join(of.select(F.col("id").alias("pivot"), F.col("component").alias("main")), "pivot").select(key, "main", "m"), "mains")

    of = placed(known)
    members = split_join(of, mains(of.groupBy("group").agg(F.count("*").alias("m")).where("m > 1").withColumn("pivot", F.col("group")), of, "group"), ["group"], "m").withColumn("pos", F.lit(0))
    inside = stored(_blocks(stored(members, "members"), records, "group", True).mapInArrow(light(_compared(percent, True)), "u long, v long"), "inside")
    if not inside.isEmpty():
        edges = edges.unionByName(inside)
        known = stored(components(edges), "second-components")
        of = placed(known)
    held = stored(postings.select("token", "id", "pos").join(of, "id"), "postings-placed")
    held = split_join(held, mains(runs, of, "token"), ["token"], "m")
    across = _blocks(stored(held, "postings-held"), records, "token", False).mapInArrow(light(_compared(percent, False)), "pivot long, id long").distinct()
    both = tried.select(F.least("pivot", "id").alias("pivot"), F.greatest("pivot", "id").alias("id"))
    left = stored(across.join(both, ["pivot", "id"], "left_anti"), "pairs")
    links = [] if left.isEmpty() else [verified(records, left, percent, "verified").where("ok").select("u", "v")]

    # rows that repeat a doc_id are one node
    repeated = nodes.groupBy("doc").agg(F.min(F.xxhash64("name")).alias("low"), F.max(F.xxhash64("name")).alias("high")).where("low <> high").select("doc")
    if not repeated.isEmpty():
        again = nodes.join(repeated, "doc", "left_semi").select("doc", "name").distinct().join(classes.select("name", "rep"), "name")
        links.append(again.join(again.groupBy("doc").agg(F.min("rep").alias("v")), "doc").select(F.col("rep").alias("u"), "v"))
    last = (components(reduce(DataFrame.unionByName, links, edges)) if links else known).withColumnRenamed("node", "rep")
    classes = keep(stored(classes.join(last, "rep", "left").select("name", "copies", F.coalesce("component", "rep").alias("component")), "class-components"))
    found = split_join(nodes.select("doc", "n", "name"), classes, ["name"], "copies").select("doc", "n", "component")
    texts = found.groupBy("doc").agg(F.min("component").alias("component"))
    none = meta.where("doc is null or n = 0").select("doc", "n").join(texts, "doc", "left").select("doc", "n", F.coalesce("component", "doc").alias("component"))
    return found.unionByName(none).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _known(spark: SparkSession, ids: DataFrame) -> DataFrame:
    """Ids to hold rows against: broadcast if there are at most SENT of them, otherwise met by key."""
    return F.broadcast(ids) if ids.count() <= SENT else ids


def deduplicated(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One document of each component, that of the least doc_id, with its columns as they were.

    Rows without a doc_id link with nothing and stay; of rows that repeat a doc_id one stays. Those that go are the fewer, so texts are held against them.
    """
    ids = stored(join(spark, documents).where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count("*").alias("rows__")), "document-ids")
    gone = _known(spark, ids.where("doc_id <> component").select("doc_id"))
    again = ids.where("doc_id = component and rows__ > 1").select("doc_id")
    out = documents.where("doc_id is not null").join(gone, "doc_id", "left_anti")
    if not again.isEmpty():
        again = _known(spark, again)
        out = out.join(again, "doc_id", "left_anti").unionByName(out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return out.select(*documents.columns).unionByName(documents.where("doc_id is null"))
