"""SentencePiece BPE by a merge-type prefix table.

For each prefix of a text the table stores the last token of its encoding, which is unique: of the tokens that
end there (found by an automaton), the one that is compatible with the last token of the prefix before it. A pair is
compatible if merging its joined text gives just that pair. The ids are read from the table backwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import bounded, light, only, remembers, small_batches, text_or_empty
from quillstone.llm.remembered import STOP, TOGETHER, Remembered

SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, BYTE = 1, 6
#: Pairs that a worker remembers.
PAIRS = 300_000


def divided(raw: bytes) -> np.ndarray:
    """Where the segments of texts begin, each text followed by STOP, which is one of its own: spaces with the word after them, spaces alone, and line ends. No piece crosses these bounds."""
    b = np.frombuffer(raw, np.uint8)
    space, bound = b == 32, (b == 10) | (b == STOP)
    starts = bound.copy()
    starts[0] = True
    starts[1:] |= bound[:-1] | space[1:] & ~space[:-1]
    return np.flatnonzero(starts)


class Pieces:
    """A BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not spec.byte_fallback or kinds - {1, 2, 3, 6} or spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with identity normalisation, a dummy prefix and byte fallback is needed")
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == "</s>")
        self.pieces = [p.piece for p in model.pieces]
        self.rank = {p.piece: (-p.score, i) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.ids = {p: r[1] for p, r in self.rank.items()}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        # what an id stands for in decoded text; control pieces stand for nothing
        self.surface = [bytes([int(p.piece[3:-1], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b" \xe2\x81\x87 " if p.type == 2 else b"" for p in model.pieces]
        multi = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in multi) or any("\n" in p for p in multi):
            raise ValueError("pieces with a space inside or with line ends are not expected")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merged(p) == [p]:  # others never come out of merging
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.decimal = [str(i) for i in range(len(self.pieces))]
        self.remembered = Remembered(lambda s: self._segment(s.replace(" ", SPACE)))
        self.pairs: dict[int, bool] = {}  # by a << 20 | b

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: always the first pair of the best rank."""
        parts, rank = list(text), self.rank
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        x, y = self.pieces[a], self.pieces[b]
        found = self.merged(x + y) == [x, y]
        if len(self.pairs) < PAIRS:
            self.pairs[a << 20 | b] = found
        return found

    def _run(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        last: list[tuple[int, int]] = [(0, -1)] * (len(text) + 1)
        pairs = self.pairs
        done = 0
        for at, (n, token) in self.automaton.iter(text):
            end = at + 1
            if done == end:
                continue
            before = end - n
            if before == 0 or ((ok := pairs.get(last[before][1] << 20 | token)) is None and self.compatible(last[before][1], token)) or ok:
                last[end] = (n, token)
                done = end
        out, at = [], len(text)
        while at:
            n, token = last[at]
            out.append(token)
            at -= n
        return out[::-1]

    def _segment(self, text: str) -> tuple[int, ...]:
        ids, out, start = self.ids, [], 0
        for k, c in enumerate(text):
            if c not in ids:
                out += self._run(text[start:k]) if k > start else []
                out += [self.bytes[b] for b in c.encode()]
                start = k + 1
        return tuple(out + (self._run(text[start:]) if start < len(text) else []))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, each with the end id."""
        raw = b"".join([x for t in texts for x in ((b" ", t.replace(SPACE, " ").encode(), b"\xff") if t else (b"\xff",))])  # the sign for a space counts as one
        if not raw:
            return []
        ids, ends = self.remembered.ids(raw, divided(raw), self.end)
        return [x.tolist() for x in np.split(ids, ends[:-1])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " and ids and self.pieces[ids[0]].startswith(SPACE) else raw).decode("utf-8", "replace")


_MODELS: dict[str, Pieces] = {}
remembers("pieces", _MODELS.clear)


def pieces(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


COLUMNS = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "ids": pa.list_(pa.int32()), "decoded": pa.string()}
SCHEMA = {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "array<int>", "decoded": "string"}


def _encode(path: str, columns: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("pieces")
        model = pieces(path)
        for batch in bounded(batches, 1, TOGETHER):
            got: dict[str, list] = {c: [] for c in columns}
            put = [(got[c].append, c) for c in columns]
            for doc_id, ids in zip(batch.column(0).to_pylist(), model.encode_all(batch.column(1).to_pylist()), strict=True):
                decoded = model.decode(ids)
                for append, c in put:
                    append(
                        doc_id if c == "doc_id" else len(ids) if c == "n_tokens" else ids if c == "ids" else decoded if c == "decoded"
                        else hashlib.sha256(" ".join(map(model.decimal.__getitem__, ids)).encode() if c == "ids_sha256" else decoded.encode()).hexdigest()
                    )
            yield pa.RecordBatch.from_arrays([pa.array(got[c], COLUMNS[c]) for c in columns], list(columns))

    return run


def encoded(spark: SparkSession, docs: DataFrame, model_path: str, columns: tuple[str, ...] = ("doc_id", "ids", "decoded")) -> DataFrame:
    """Of every whole text the named columns: doc_id, ids (end id last), n_tokens, the decoded text, and digests of ids and decoded text.

    One scan, no shuffle. A null text is empty, and has the end id alone. Ids may be null or repeated; extra columns are ignored.
    """
    small_batches(spark)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(light(_encode(model_path, columns)), ", ".join(f"{c} {SCHEMA[c]}" for c in columns))


#: What the digest query returns.
DIGESTS = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
