"""Each stage of the pipeline against brute force over its own input, and the registered queries that SQL expresses."""

from collections import Counter
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import queries, secrets, weak_quality

from .test_jaccard import brute

TABLES = Path("/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark, rows):
    """The input and the result of every stage."""
    own = {r[0]: (*r[:4], len(r[1] or "")) for r in rows if r[0] is not None}
    own[2000] = (2000, own[7][1] + " password=abcdefghijklmnop", "en", "src2", 1)
    docs = spark.createDataFrame(list(own.values()), COLUMNS)
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], "").cache())
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(steps):
    assert all(d.columns == steps[0].columns and dict(d.dtypes) == dict(steps[0].dtypes) for d in steps[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scans", "mixing sources", "SentencePiece encoding"]


def test_quality(spark, steps):
    said = {r["doc_id"]: (r["text"] or "").strip() for r in steps[0].collect()}
    kept = ids(steps[1])
    assert all(said[k] for k in kept) and sum(bool(t) for t in said.values()) - len(kept) <= 6
    scored = weak_quality.classify(spark, steps[0]).where("kept")
    assert ids(scored) == kept


def test_near_duplicates(steps):
    texts = {r["doc_id"]: r["text"] or "" for r in steps[1].collect()}
    want = {k for k, (_, c) in brute(texts).items() if k == c}
    assert ids(steps[2]) == Counter(want)


def test_secrets(spark, steps):
    before, after = ({r["doc_id"]: r for r in d.collect()} for d in steps[2:4])
    assert before.keys() == after.keys()
    table = secrets.model(spark, steps[2])
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan(steps[2], table).collect()}
    for k, r in after.items():
        assert r["n_chars"] == len(r["text"]) and (r["text"] == before[k]["text"]) == (not spans[k])
    if 2000 in after:
        assert "abcdefghijklmnop" not in after[2000]["text"]


def test_mix_repeats_whole_documents(steps):
    assert steps[4].exceptAll(steps[3]).exceptAll(steps[3]).count() == 0 and max(ids(steps[4]).values()) <= 2


def test_encoding(steps):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    rows = steps[5].collect()
    assert len(rows) == steps[4].count()
    for r in rows:
        assert r["ids"] == [*sp.encode(text[r["doc_id"]]), sp.eos_id()] and r["n_tokens"] == len(r["ids"])


def test_run_and_empty(spark, steps, tmp_path):
    steps[0].coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in got.collect()) == sorted((r["doc_id"], r["ids_sha256"]) for r in steps[5].collect())
    docs = steps[0].where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_as_sql(spark, name):
    if not TABLES.is_dir():
        pytest.skip("the test tables are not here")
    con = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    got = queries.queries()[name](spark, str(TABLES)).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(str).values.tolist()))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
