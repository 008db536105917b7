import hashlib
import random
import re
import time

import pytest

from quillstone.llm import secrets

EXTRA = [
    "password = 'abcdefghijkl' Token:ABCDEFGH12345678 secret: short api_key=\"0123456789ab\" APIKEY:aaaaaaaaaaaa", "token: secret: abcdefghijklmnop", "token=password=abcdefghijklmnop", "AKIAABCDEFGHIJKLMN AKIASHORT AKIAKIAKIAKIAKIAKIA", "0123456789abcdef0 0123456789ABCDEF",
    "é password=äbcdefghijkl 日本 password=zzzzzzzzzzzz", "use qX7rT9vLk2PzW4mN8sB1 here", "internationalisation_of_identifiers stays", "deadbeefdeadbeefdeadbeef" * 4, "token==abcdefghijkl token : : abcdefghijklm",
]


@pytest.fixture(scope="module")
def texts(spark, docs):
    more = spark.createDataFrame([(5000 + k, t) for k, t in enumerate(EXTRA)], "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(more)


@pytest.fixture(scope="module")
def table(spark, texts):
    return secrets.model(spark, texts)


def base(text):
    out = []
    for rank, (kind, pattern, group, least) in enumerate(secrets.BASE):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_base_spans(spark, texts):
    rows = {(r["doc_id"], i): r["text"] for i, r in enumerate(texts.collect())}
    want = sorted((str(d), *(sum(s.startswith(k) for s in base(t or "")) for k in ("assign", "access", "hex")), hashlib.sha256(",".join(base(t or "")).encode()).hexdigest()) for (d, _), t in rows.items())
    got = secrets.digests(spark, texts).collect()
    assert sorted((str(r["doc_id"]), r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    assert all(set(base(t or "")) <= set(r["spans"].split(",")) | {""} for (d, _), t in rows.items() for r in got if r["doc_id"] == d and d is not None and d >= 5000)


def test_models_tell_random_from_ordinary(spark, table):
    from pyspark.sql import functions as F

    rows = [(True, hashlib.sha256(b"%d" % k).hexdigest()[:24]) for k in range(300)] + [(True, "".join(chr(33 + b % 90) for b in hashlib.sha512(b"x%d" % k).digest() if chr(33 + b % 90).isalnum())[:20]) for k in range(300)]
    rows += [(False, f"{a}_{b}_{c}") for a in ("customer", "payment", "library", "network") for b in ("handler", "registry", "observer") for c in ("listener", "settings", "collection")]
    scored = spark.createDataFrame([r for r in rows if len(r[1]) >= 16], "random boolean, token string").select("random", (secrets.scored(F.col("token"), table) >= secrets.THRESHOLD).alias("found")).groupBy("random").agg(F.avg(F.col("found").cast("int")).alias("share")).collect()
    share = {r["random"]: r["share"] for r in scored}
    assert share[True] > 0.95 and share[False] < 0.05


def test_added_spans_and_redaction(spark, texts, table):
    got = {r["doc_id"]: r["text"] for r in secrets.redacted(texts.where("doc_id >= 5000"), table).collect()}
    assert got[5006] == "use [SECRET] here" and got[5007] == EXTRA[7]
    assert "abcdefghijkl" not in got[5000] and got[5000].count("[SECRET]") == 4
    clean = secrets.redacted(texts.where("doc_id < 60"), table)
    assert clean.exceptAll(texts.where("doc_id < 60")).count() == 0


def test_longer_strings_around_base_spans(spark, table):
    rows = spark.createDataFrame([(1, "x sk0123456789abcdef0123XyZ9QwErTy"), (2, "password=qX7rT9vLk2PzW4mN8sB1 0123456789abcdef01")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.scan(rows, table).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[1]["spans"]] == [("markov", 2, 34), ("hex", 4, 24)]
    assert got[2]["spans"] == got[2]["base"]
    assert [r["text"] for r in secrets.redacted(rows, table).orderBy("doc_id").collect()] == ["x [SECRET]", "[SECRET] [SECRET]"]


def test_clashing_columns_stay(spark, table):
    from pyspark.sql import functions as F

    odd = spark.createDataFrame([("x", "y", "password=abcdefghijkl", None)], "base string, spans string, text string, doc_id long")
    assert tuple(secrets.redacted(odd, table).first()) == ("x", "y", "[SECRET]", None)
    assert secrets.digests(spark, odd.select("doc_id", F.lit(None).cast("string").alias("text"))).first()["spans"] == ""


def test_native_plan(spark, texts, table):
    plan = secrets.scan(texts, table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty(spark, none):
    assert secrets.digests(spark, none).count() == 0


def test_many_spans_against_plain_loops(spark, table):
    """Texts with hundreds of spans of all kinds, side by side, inside each other and across the borders of runs and pieces."""
    rnd = random.Random(5)
    parts = [lambda: "0123456789abcdef" + "ab" * rnd.randrange(4), lambda: "AKIA" + "Q7" * rnd.randrange(4, 12), lambda: "password=" + "zX9-" * rnd.randrange(1, 6), lambda: "qX7rT9vLk2PzW4mN8sB1", lambda: "plain words é 日本 ", lambda: " ", lambda: "x" * rnd.randrange(3000), lambda: "token:0123456789abcdef0123", lambda: "\n"]
    rows = [(k, "".join(rnd.choice(parts)() + rnd.choice(("", " ", " ", "\n")) for _ in range(60 * k))) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.scan(df, table).collect()}
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(df, table, "#").collect()}
    most = 0
    for k, text in rows:
        spans = sorted((s["start"], s["end"], s["kind"], s["rank"]) for s in got[k]["spans"])
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in got[k]["base"]] == base(text)
        own = sorted((s, e) for s, e, kind, _ in spans if kind != "markov")
        covered = lambda a, b: all(any(s <= c < e for s, e in own) for c in range(a, b))
        for s, e, kind, _ in spans:
            if kind == "markov":
                assert re.fullmatch(r"[A-Za-z0-9+/_=-]{16,}", text[s:e]) and not covered(s, e)
        out, at = [], 0
        for s, e, *_ in spans:
            if s > at or not out:
                out += [text[at:s], "#"]
            at = max(at, e)
        assert clean[k] == "".join([*out, text[at:]])
        most = max(most, len(spans))
    assert most > 250


@pytest.mark.parametrize("made", ["hex", "markov", "long"])
def test_cost_follows_the_matches(spark, table, made):
    """Twice the matches of a text, or twice the length of one string, cost at most about twice the time."""

    def seconds(n):
        unit = {"hex": "0123456789abcdef0 ", "markov": "qX7rT9vLk2PzW4mN8sB1 ", "long": "qX7rT9vLk2PzW4mN8sB1"}[made]
        df = spark.createDataFrame([(1, unit * n)], "doc_id long, text string").cache()
        df.count()
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            secrets.redacted(df, table).select("text").collect()
            best = min(best, time.perf_counter() - start)
        return best

    seconds(500)
    assert seconds(16_000) <= 2.2 * seconds(8000) + 0.4
