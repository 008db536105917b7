import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest

from quillstone.llm import pieces, token_store
from quillstone.llm import remembered as memory

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def store(spark, docs):
    return token_store.write_store(spark, docs, BYTES)


def expected(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    ids = [(r[0], t.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows]
    return sorted(ids, key=lambda x: (x[0] is not None, x[0] or 0))


def test_round_trip(spark, store, rows):
    got = sorted((r["start"], r["doc_id"], r["ids"]) for r in token_store.read_ids(spark, store).collect())
    want = expected(rows)
    assert sorted((d is None, d or 0, i) for _, d, i in got) == sorted((d is None, d or 0, i) for d, i in want)
    assert [d for _, d, _ in got] == [d for d, _ in want]
    start = 0
    for s, _, ids in got:
        assert s == start
        start += len(ids)


def test_digests(spark, store, rows):
    got = {r["start"]: r for r in token_store.read_digests(spark, store).collect()}
    for r in token_store.read_ids(spark, store).collect():
        d = got.pop(r["start"])
        assert (d["doc_id"], d["n_tokens"], d["ids_crc32"]) == (r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))
    assert not got


def test_chunks_are_stored_once(spark, store):
    chunks = spark.read.schema(token_store.CHUNKS).parquet(f"{store}/parts/chunk=true")
    assert chunks.count() == chunks.select("digest").distinct().count()
    recipes = spark.read.parquet(f"{store}/recipes")
    assert chunks.count() < recipes.selectExpr("explode(digests)").count()


def test_damage_is_found(spark, docs):
    path = token_store.write_store(spark, docs, BYTES)
    spark.read.parquet(f"{path}/recipes").selectExpr("part", "doc_id", "start", "n_tokens", "reverse(digests) as digests").write.parquet(f"{path}/other")
    from quillstone.llm.common import remove

    remove(spark, f"{path}/recipes")
    spark.read.parquet(f"{path}/other").write.parquet(f"{path}/recipes")
    with pytest.raises(ValueError, match="differ from their manifest"):
        token_store.verify(spark, path)


def test_cuts_follow_content():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 50_000, 30_000), rng.integers(0, 50_000, 777)
    both = np.concatenate([b, a])
    one = token_store.cuts(a.astype(np.uint32), np.array([0, len(a)]))[0]
    other = [c - len(b) for c in token_store.cuts(both.astype(np.uint32), np.array([0, len(both)]))[0]]
    assert len(set(one) & set(other)) > 0.9 * len(one)
    assert all(token_store.LEAST <= y - x <= token_store.MOST for x, y in zip([0, *one], one[:-1], strict=False))


def test_combined_crcs():
    x = np.arange(200_000, dtype="<u4")
    at = [0, 10, 11, 700, 1000, 70_000, 200_000]
    n = np.diff(at)
    crc = np.array([zlib.crc32(x[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)])
    ids, whole = token_store.combined(np.array([0, 4, 6]), n, crc)
    assert ids.tolist() == [1000, 199_000] and whole.tolist() == [zlib.crc32(x[:1000].tobytes()), zlib.crc32(x[1000:].tobytes())]


def test_empty_store(spark, none):
    path = token_store.write_store(spark, none, BYTES)
    assert token_store.read_digests(spark, path).count() == 0


def test_pieces_are_the_library_s(spark, docs, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for r in rows:
        ids = [*sp.encode(r[1] or ""), sp.eos_id()]
        want.append((str(r[0]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = pieces.encoded(spark, docs, PIECES, pieces.DIGESTS).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(want)


@pytest.mark.parametrize(("places", "remembered"), [(22, 1 << 24), (5, 300)])
def test_pieces_of_texts_together(monkeypatch, places, remembered):
    import random

    import sentencepiece

    monkeypatch.setattr(memory, "PLACES", places)
    monkeypatch.setattr(memory, "REMEMBERED", remembered)
    sp, own, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Pieces(PIECES), random.Random(6)
    parts = [*"ab cde th in\n▁  é日<s>'12.!?☃ß\t\r\x00", "  ", "\n\n", " the", "word", "x" * 60, "😀", "</s>", "<0x41>", "\u2028"]
    for _ in range(20):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 16))) for _ in range(300)]
        ids = own.encode_all(texts)
        assert ids == [[*x, sp.eos_id()] for x in sp.encode(texts)]
        assert [own.decode(x) for x in ids] == [sp.decode(x) for x in ids]
    assert own.encode_all([]) == []


def test_pieces_on_random_strings():
    import random

    import sentencepiece

    sp, own, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Pieces(PIECES), random.Random(1)
    for _ in range(4000):
        t = "".join(rnd.choice("ab cde th in\n▁  é日<s>'12.!?☃ßabcdefghij") for _ in range(rnd.randrange(40)))
        ids = own.encode(t)
        assert ids == [*sp.encode(t), 2] and own.decode(ids) == sp.decode(ids), repr(t)


def library(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def several(encoder, texts):
    ids, ends = encoder.streams(texts)
    return [x.tolist() for x in np.split(ids, ends[:-1])]


def test_encoder_on_all_characters():
    """Libraries class characters by Unicode tables of different age: each one before a contraction, which letters do not part."""
    enc = token_store.Encoder(BYTES)
    chars = [chr(c) for c in range(0x34000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x34000, 0x110000, 997)]
    for k in range(0, len(chars), 20_000):
        texts = [c + x for c in chars[k : k + 20_000] for x in ("'s", "'ll")]
        assert several(enc, texts) == library(enc, texts)


@pytest.mark.parametrize(("places", "remembered"), [(22, 1 << 24), (5, 300)])
def test_encoder_on_texts_together(monkeypatch, places, remembered):
    """Texts of all kinds in one batch, with few places, so that pieces drive each other out, and a memory that is emptied at times."""
    import random

    monkeypatch.setattr(memory, "PLACES", places)
    monkeypatch.setattr(memory, "REMEMBERED", remembered)
    rnd, enc = random.Random(4), token_store.Encoder(BYTES)
    parts = [*"ab1. ,'\n\t\r  !é日 sll", "'s", "'ll", " the", "..", "  ", "\x0b", "\x0c", "\x1f", "\x85", "\xa0", "\u3000", "<|endoftext|>", "x" * 60, "\u200b"]
    for _ in range(30):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 14))) for _ in range(400)]
        assert several(enc, texts) == library(enc, texts)
    ids, ends = enc.streams(["", "a", "<|endoftext|>b"], 7)
    assert [x.tolist()[-1] for x in np.split(ids, ends[:-1])] == [7, 7, 7] and ends.tolist()[0] == 1
    assert enc.streams([])[0].size == 0


def test_a_missing_chunk_is_found(spark, docs):
    path = token_store.write_store(spark, docs, BYTES)
    chunks = spark.read.schema(token_store.CHUNKS).parquet(f"{path}/parts/chunk=true")
    chunks.limit(chunks.count() - 1).write.parquet(f"{path}/fewer")
    from quillstone.llm.common import remove

    remove(spark, f"{path}/parts/chunk=true")
    spark.read.parquet(f"{path}/fewer").write.parquet(f"{path}/parts/chunk=true")
    with pytest.raises(Exception, match="chunk is missing"):
        token_store.read_digests(spark, path).collect()


def test_encoder_on_random_strings():
    import random

    rnd, enc = random.Random(2), token_store.Encoder(BYTES)
    for _ in range(3000):
        t = "".join(rnd.choice("ab c  d\n\t'sé日12.,!☃²٣\x1c ́'ll") for _ in range(rnd.randrange(30)))
        assert enc.encode(t) == np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)
