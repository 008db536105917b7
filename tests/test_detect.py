"""Formats told from bytes built by hand, by expressions and by probes alike."""

import json

import pytest

from quillstone.functions.detect import detected, detected_by_probes
from quillstone.functions.probes import ALL, Blob, detect
from quillstone.operators import derive
from quillstone.plans.goldens import SAMPLES


@pytest.mark.parametrize("k", range(len(SAMPLES)))
def test_probe(k):
    data, name, kind, version, attrs = SAMPLES[k]
    got = detect(data, name)
    assert got == ((kind, version, attrs) if kind else None) or (got and got[:2] == (kind, version) and {a: v for a, v in got[2].items() if v is not None} == attrs)


def test_expressions_and_probes_agree_and_never_raise(spark):
    """Over the samples and all their mutants, with their own names and with others."""
    names = ["", "a.xml", "a.json", "a.fnt", "a.tga", "a.atlas"]
    rows = [(k, n or s[1], s[0]) for k, s in enumerate(SAMPLES) for n in names]
    base = spark.createDataFrame(rows, "k int, path string, bytes binary")
    mutants = derive.derive_all(base.where("length(bytes) < 5000")).select("k", "path", "bytes")
    every = base.unionByName(mutants)
    key = lambda df: sorted((r["k"], r["path"], r["sha"], r["format"] and (r["format"]["kind"], r["format"]["version"], json.dumps(json.loads(r["format"]["attrs"]), sort_keys=True))) for r in df.collect())
    from pyspark.sql import functions as F

    every = every.withColumn("sha", F.sha2("bytes", 256))
    assert key(detected(every, "path", "bytes")) == key(detected_by_probes(every, "path", "bytes"))


def test_ranks_are_ordered():
    ranks = [r for r, _ in ALL]
    assert ranks == sorted(ranks)
    assert len({int(r) for r in ranks}) == 93


def test_every_probe_has_a_sample():
    """The one exception can't be reached: an earlier rule takes its name."""
    claimed = {int(next(r for r, p in ALL if p(Blob(s[0], s[1])))) for s in SAMPLES if s[2]}
    assert {int(r) for r, _ in ALL} - claimed == {92}
