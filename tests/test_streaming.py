import hashlib
import json

from quillstone.streaming import snapshots


def test_drift_by_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = spark.createDataFrame([("p", "a", "upstream", "r/a", None, True), ("p", "b", "upstream", "r/b", "main", True)], "pack string, id string, kind string, repo string, ref string, redistributable boolean").selectExpr("*", "named_struct('redistributable', redistributable) as license")
    locked = spark.createDataFrame([("p", "a", "old"), ("p", "b", "same")], "pack string, id string, commit string")
    land = lambda name, *rows: (tmp_path / "in" / name).write_text("".join(json.dumps(dict(zip(("repo", "ref", "commit", "observed_at"), r, strict=True))) + "\n" for r in rows))
    run = lambda: snapshots.watch_drift(snapshots.ref_stream(spark, str(tmp_path / "in")), source, locked, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    land("1.json", ("r/a", None, "new", "2024-01-02T00:00:00Z"), ("r/a", None, "older", "2024-01-01T00:00:00Z"))
    run()
    land("2.json", ("r/b", "main", "same", "2024-01-03T00:00:00Z"))
    run()
    assert [(r["source_id"], r["code"], r["detail"], r["batch"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", "moved", "old -> new", 0)]


def test_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.bin").write_bytes(b"%d" % k)
        snapshots.watch_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["sha256"] for r in rows) == sorted(hashlib.sha256(b"%d" % k).hexdigest() for k in range(3))
