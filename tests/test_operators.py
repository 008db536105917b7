import datetime
import hashlib
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from quillstone.functions import paths, texts
from quillstone.operators import derive, export, ingest, integrity, locks, pairing, references, summaries, variants
from quillstone.sources import files, schemas, specs

BASE = """
[pack]
name = "one"
summary = "first"
[[source]]
id = "a"
kind = "upstream"
repo = "r/a"
include = ["img/**"]
exclude_paths = ["**/skip.*"]
strip = "img/"
dest = "pics"
[source.license]
declared = "MIT"
declared_scope = "repository-root"
declared_from = "LICENSE"
commercial_use = true
[source.annotations."pics/depict.png".depicts]
subject = "S"
rightsHolder = "H"
status = "open"
"""
DERIVED = """
[pack]
name = "two"
kind = "malformed"
[[source]]
id = "d"
kind = "derived"
from_pack = "one"
from_source = "a"
from_include = ["**/*.png"]
strategies = ["empty", "truncate"]
[source.license]
declared = "CC0-1.0"
declared_scope = "directory"
"""


@pytest.fixture
def loaded(spark, tmp_path):
    (tmp_path / "a-two.toml").write_text(DERIVED)
    (tmp_path / "b-one.toml").write_text(BASE)
    return specs.load_specs(spark, str(tmp_path))


def lock(spark, loaded):
    tree = spark.createDataFrame([("one", "a", p) for p in ("img/x.png", "img/depict.png", "img/skip.png", "doc/y.md", "LICENSE")], "pack string, source_id string, path string")
    content = spark.createDataFrame([("one", "a", "img/x.png", bytearray(b"x" * 40)), ("one", "a", "img/depict.png", bytearray(b"d" * 9))], "pack string, source_id string, upstream_path string, bytes binary")
    return ingest.build_lock(loaded.source, tree, content, loaded.annotation.where("pack = 'one'"))


def test_specs(spark, loaded):
    assert loaded.order == ["one", "two"] and not loaded.findings
    row = loaded.source.where("id = 'a'").first()
    assert row["license"]["commercial_use"] == "yes" and row["license"]["onward_use"] == "unrestricted" and row["fetch"] == "tarball"
    assert [r["name"] for r in specs.subset(loaded, ["two", "one", "two"]).collect()] == ["two", "one", "two"]
    with pytest.raises(specs.SpecError):
        specs.subset(loaded, ["none"])


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"declared_scope": "x"}, "C1"), ({"commercial_use": "maybe"}, "C2"), ({"onward_use": "x"}, "C3"), ({"declared": "LicenseRef-UGent-Academic"}, "C5"), ({"commercial_use": False}, "C6"), ({"derivatives": False}, "C7"), ({"redistributable": False}, "C8"),
        ({"permissive": True}, "C9"), ({"underlying": ["x"]}, "C10"), ({"underlying": [{"declared": "x"}]}, "C11"), ({"odd": 1}, "C24"),
    ],
)
def test_license_constraints(change, code):
    good = {"declared": "MIT", "declared_scope": "directory", "commercial_use": True}
    assert specs.license_problems(good) == []
    assert [c for c, _ in specs.license_problems(good | change)] == [code]


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"kind": "x"}, "C4"), ({"repo": None}, "C12"), ({"include": []}, "C13"), ({"fetch": "x"}, "C14"), ({"subtree": "a"}, "C15"), ({"fetch": "blobs", "subtree": "b"}, "C16"), ({"include": ["a/[b]"]}, "C25"), ({"license": None}, "C23"),
        ({"kind": "derived", "from_pack": "p", "from_source": "s", "strategies": ["empty"]}, "C19"), ({"kind": "derived", "from_pack": "p", "from_source": "s", "from_include": ["*"]}, "C18"), ({"kind": "recovered"}, "C20"),
    ],
)
def test_source_constraints(change, code):
    good = {"id": "a", "kind": "upstream", "repo": "r", "include": ["a/*"], "license": {"declared": "MIT", "declared_scope": "directory", "commercial_use": True}}
    assert specs.source_problems(good) == []
    assert [c for c, _ in specs.source_problems(good | change)] == [code]


def test_dependency_order():
    assert specs.dependency_order({"c": ["a", "b"], "a": [], "b": ["a"], "d": ["gone"]}) == ["a", "b", "c", "d"]
    with pytest.raises(specs.CycleError, match="a -> b -> a"):
        specs.dependency_order({"a": ["b"], "b": ["a"]})


def test_lock(spark, loaded):
    file, found = lock(spark, loaded)
    rows = {r["path"]: r for r in ingest.in_order(file).collect()}
    assert list(rows) == ["picsdepict.png", "picsx.png"]
    assert rows["picsx.png"]["sha256"] == hashlib.sha256(b"x" * 40).hexdigest() and rows["picsx.png"]["size"] == 40
    assert [(r["code"], r["path"]) for r in found.collect()] == [("C36", "pics/depict.png")]
    with pytest.raises(ValueError, match="annotations"):
        integrity.demand_none(found)


def test_pinning(spark, loaded):
    refs = spark.createDataFrame([("r/a", "HEAD", "new")], schemas.REF_SNAPSHOT)
    locked = spark.createDataFrame([("one", "a", "old")], "pack string, id string, commit string")
    commit = lambda df: df.where("id = 'a'").first()["commit"]
    assert commit(ingest.pinned(loaded.source, None, refs)) == "new"
    assert commit(ingest.pinned(loaded.source, locked, refs)) == "old"
    assert commit(ingest.pinned(loaded.source, locked, refs, update=True)) == "new"


def test_derived_files(spark, loaded):
    file = spark.createDataFrame([("one", "p/x.png", "a", "h1"), ("one", "q/x.png", "a", "h0"), ("one", "p/x.txt", "a", "h2")], "pack string, path string, source_id string, sha256 string").withColumns({"depicts": F.lit(None).cast(schemas.DEPICTS), "exclude": F.lit(None).cast(schemas.EXCLUDE)})
    content = spark.createDataFrame([("one", "p/x.png", bytearray(b"0123456789")), ("one", "q/x.png", bytearray(b"ab"))], "pack string, path string, bytes binary")
    kept, skipped = ingest.derived_files(loaded.source, file, content)
    rows = {r["path"]: (bytes(r["bytes"]), r["derived_from"]) for r in kept.collect()}
    assert rows["x.empty.png"] == (b"", "q/x.png") and rows["x.one-byte.png"] == (b"a", "q/x.png")
    assert rows["x.truncate-50pct.png"] == (b"a", "q/x.png")
    assert {r["derived_from"] for r in skipped.collect()} == {"p/x.png"}


def test_a_lock_written_and_read_is_itself(spark, loaded, tmp_path):
    file, _ = lock(spark, loaded)
    file = file.withColumns({"derived_from": F.lit(None).cast("string"), "derived_from_sha256": F.lit(None).cast("string"), "strategy": F.lit(None).cast("string")})
    kind = F.struct(F.lit("png").alias("kind"), F.lit("1").alias("version"), F.lit('{"width":3,"color":["a","b"]}').alias("attrs"))
    file = file.withColumn("format", F.when(F.col("path") == "picsx.png", kind))
    file = file.withColumn("depicts", F.when(F.col("path") == "picsx.png", F.struct(F.lit("S").alias("subject"), F.lit("H").alias("rights_holder"), F.lit("open").alias("status"))).cast(schemas.DEPICTS))
    source = locks.recorded(loaded.source.where("kind = 'upstream'").withColumn("commit", F.lit("c" * 40)), "2024-05-06")
    named, snapshots, missing = locks.snapshots(source, spark.createDataFrame([("one", "a", "LICENSE", bytearray(b"text"))], "pack string, source_id string, path string, bytes binary"))
    assert missing.count() == 0 and [tuple(r)[:2] for r in snapshots.collect()] == [("one", "licenses/a@cccccccccccc.txt")]
    locks.write(loaded.pack, named, file, str(tmp_path / "locks"))
    doc = json.loads(next((tmp_path / "locks" / "name=one").glob("part-*")).read_text())
    assert doc["totals"] == {"files": 2, "bytes": 49} and [f["path"] for f in doc["files"]] == ["picsdepict.png", "picsx.png"]
    assert doc["files"][1]["format"] == {"kind": "png", "version": "1", "width": 3, "color": ["a", "b"]} and "format" not in doc["files"][0] and "depicts" not in doc["files"][0]
    assert doc["sources"][0]["license"]["commercialUse"] is True and doc["sources"][0]["retrieved"] == "2024-05-06" and doc["sources"][0]["vendored"] is True and doc["sources"][0]["licenseSnapshot"] == "licenses/a@cccccccccccc.txt"
    assert json.loads(next((tmp_path / "locks" / "name=two").glob("part-*")).read_text()) == {"pack": {"name": "two", "kind": "malformed", "summary": ""}, "sources": [], "files": [], "totals": {"files": 0, "bytes": 0}}
    once = locks.read(spark, str(tmp_path / "locks"))
    shared = ["path", "source_id", "upstream_path", "sha256", "size"]
    assert sorted(map(tuple, once["file"].select("pack", *shared).collect())) == sorted(map(tuple, file.select("pack", *shared).collect()))
    locks.write(once["pack"], once["source"], once["file"], str(tmp_path / "again"))
    again = locks.read(spark, str(tmp_path / "again"))
    for name in ("pack", "source", "file"):
        assert sorted(map(repr, again[name].collect())) == sorted(map(repr, once[name].collect())) and once[name].count()


def test_licence_snapshots(spark, loaded):
    layers = F.array(F.struct(F.lit("CC").alias("declared"), F.lit("CC.txt").alias("declared_from"), F.lit("n").alias("note")), F.struct(F.lit("X").alias("declared"), F.lit(None).cast("string").alias("declared_from"), F.lit("n").alias("note")), F.struct(F.lit("Y").alias("declared"), F.lit("gone.txt").alias("declared_from"), F.lit("n").alias("note")))
    source = loaded.source.where("id = 'a'").withColumn("commit", F.lit("d" * 40)).withColumn("license", F.col("license").withField("underlying", layers).withField("declared_scope", F.lit("file-adjacent")))
    texts_ = spark.createDataFrame([("one", "a", "LICENSE", bytearray(b"L")), ("one", "a", "CC.txt", bytearray(b"C"))], "pack string, source_id string, path string, bytes binary")
    named, kept, missing = locks.snapshots(source, texts_)
    row = named.first()
    assert [x["snapshot"] for x in row["license"]["underlying"]] == ["licenses/a-underlying-0@dddddddddddd.txt", None, "licenses/a-underlying-2@dddddddddddd.txt"] and row["adjacent_path"] == "picsLICENSE"
    assert sorted((r["snapshot"], bytes(r["bytes"])) for r in kept.collect()) == [("licenses/a-underlying-0@dddddddddddd.txt", b"C"), ("licenses/a@dddddddddddd.txt", b"L")]
    assert [(r["code"], r["path"]) for r in missing.collect()] == [("C35", "gone.txt")]
    tree = texts_.select("pack", "source_id", "path").where("path <> 'LICENSE'")
    assert sorted((r["code"], r["path"]) for r in integrity.licence_texts(source, tree).collect()) == [("C34", "LICENSE"), ("C35", "gone.txt")]


def test_contents_are_stored_once(spark, tmp_path):
    content = spark.createDataFrame([("p", "a", bytearray(b"1")), ("p", "b", bytearray(b"1")), ("q", "a", bytearray(b"2"))], "pack string, path string, bytes binary")
    locks.write_objects(content, str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    assert stored.count() == 2
    file = content.select("pack", "path", F.sha2("bytes", 256).alias("sha256"))
    assert sorted((r["pack"], r["path"], bytes(r["bytes"])) for r in locks.restored(file, stored).collect()) == [("p", "a", b"1"), ("p", "b", b"1"), ("q", "a", b"2")]
    with pytest.raises(Exception, match="no stored bytes: q/a"):
        locks.restored(file, stored.where("sha256 <> sha2(binary('2'), 256)")).collect()


def test_blobs_are_landed_once(spark):
    wanted = spark.createDataFrame([(0, "r", "c", "x", "s1"), (1, "r", "c", "y", "s1"), (2, "r", "c", "z", None), (3, "r", "c", "w", "s2")], "ordinal int, repo string, commit string, path string, sha string")
    place = hashlib.sha256(b"r@c/z").hexdigest()
    objects = spark.createDataFrame([("s2", bytearray(b"W"))], "key string, bytes binary")
    assert sorted((r["key"], r["path"]) for r in files.missing_blobs(wanted, objects).collect()) == sorted([("s1", "x"), (place, "z")])
    full = spark.createDataFrame([("s2", bytearray(b"W")), ("s1", bytearray(b"X")), (place, bytearray(b"Z"))], "key string, bytes binary")
    assert [bytes(r["bytes"]) for r in files.blobs(wanted, full).orderBy("ordinal").collect()] == [b"X", b"X", b"Z", b"W"]
    with pytest.raises(Exception, match="not landed"):
        files.blobs(wanted, objects).collect()


def test_pairs_of_inputs_and_expectations(spark):
    names = ["images/gif/a.gif", "reference/gif/a.gif.png", "reference/gif/a.gif.anim_01.png", "reference/gif/a.gif.anim_12.png", "images/png/b.png", "reference/png/b.png.png", "images/c.bmp", "t/one/test.swf", "t/one/output.txt", "t/two/test.swf", "other/reference/x.png"]
    file = spark.createDataFrame([("p", n, "s" if n.startswith("t/") else "i") for n in names], "pack string, path string, source_id string")
    got = sorted((r["path"], r["rendering"] or "", r["frame"] or 0) for r in pairing.renderings(file).collect())
    assert got == [("images/c.bmp", "", 0), ("images/gif/a.gif", "reference/gif/a.gif.anim_01.png", 1), ("images/gif/a.gif", "reference/gif/a.gif.anim_12.png", 12), ("images/gif/a.gif", "reference/gif/a.gif.png", 0), ("images/png/b.png", "reference/png/b.png.png", 0)]
    assert [tuple(r) for r in pairing.same_directory(file, "test.swf", "output.txt").collect()] == [("p", "t/one", "t/one/test.swf", "t/one/output.txt")]
    source = spark.createDataFrame([("p", "s", "r", "c1"), ("p", "i", "r", "c2"), ("q", "s", "r", "c1")], "pack string, id string, repo string, commit string")
    more = file.unionByName(spark.createDataFrame([("q", "far", "s")], "pack string, path string, source_id string"))
    challenged = spark.createDataFrame([("p", "t/one/test.swf")], "pack string, path string")
    assert sorted((r["pack"], r["path"]) for r in pairing.of_one_origin(more, source, challenged).collect()) == [("p", "t/one/output.txt"), ("p", "t/one/test.swf"), ("p", "t/two/test.swf"), ("q", "far")]


def test_texts_and_escapes(spark):
    df = spark.createDataFrame([("a b/c+d~e*é%.-_",), ("",)], "p string")
    from urllib.parse import quote

    assert [r[0] for r in df.select(paths.quoted(F.col("p"))).collect()] == [quote("a b/c+d~e*é%.-_"), ""]
    docs = spark.createDataFrame([('{"k":3}',), ("{",), ('{"k":"x"}',), (None,)], "t string")
    assert [r[0] for r in docs.select(texts.json_value(F.col("t"), "$.k", "bigint")).collect()] == [3, None, None, None]


def test_parents_that_are_not_there(spark, loaded):
    file = spark.createDataFrame([("one", "p/x.png", "a", "h"), ("one", "p/y.png", "a", "h")], "pack string, path string, source_id string, sha256 string")
    packs = lambda *names: spark.createDataFrame([(n,) for n in names], "pack string")
    code = lambda **more: sorted(r["code"] for r in integrity.parents(loaded.source, file, **more).collect())
    assert code() == ["D4"] and code(ingested=packs("one", "two")) == ["D4"] and code(ingested=packs("two")) == ["C27"]
    assert code(content=file.where("path = 'p/x.png'")) == ["C30", "D4"]


def test_whole_verify_tells_what_must_not_be_packed(spark):
    h = hashlib.sha256(b"a").hexdigest()
    file = spark.createDataFrame([("p", "a", "s", h, None), ("p", "b", "t", h, ("why", None))], f"pack string, path string, source_id string, sha256 string, exclude {schemas.EXCLUDE}")
    content = spark.createDataFrame([("p", "a", bytearray(b"a")), ("p", "b", bytearray(b"a"))], "pack string, path string, bytes binary")
    source = spark.createDataFrame([("p", "s", None, None, None, (True,)), ("p", "t", None, None, None, (False,))], "pack string, id string, repo string, ref string, commit string, license struct<redistributable:boolean>")
    packs = spark.createDataFrame([("p", None)], "name string, merge_group string")
    assert sorted((r["code"], r["path"]) for r in integrity.verify(packs, source, file, content).collect()) == [("C40", "b"), ("C41", "a")]


def test_archives_that_do_not_fit_a_cell(spark, tmp_path):
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        for k in range(20):
            info = tarfile.TarInfo(f"top/{k}")
            info.size = 100
            tar.addfile(info, io.BytesIO(bytes([k]) * 100))
    one, other = (sorted(map(repr, files.tar_members(spark, str(tmp_path / "x.tar.gz"), most_bytes=n).select("ordinal", "path", "bytes").collect())) for n in (1 << 30, 1))
    assert one == other and len(one) == 20


def test_build_provenance(tmp_path):
    assert export.source_commit(str(tmp_path / "none")) is None
    import subprocess

    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=x", "-c", "user.email=x@x", *a], check=True, capture_output=True)
    git("init")
    (tmp_path / "f").write_text("1")
    git("add", "f")
    git("commit", "-m", "x")
    assert set(export.source_commit(str(tmp_path))) == {"commit"}
    (tmp_path / "f").write_text("2")
    assert export.source_commit(str(tmp_path))["dirty"] is True


def test_derivatives_forbidden(spark, tmp_path):
    (tmp_path / "a.toml").write_text(BASE.replace("commercial_use = true", 'commercial_use = true\nderivatives = false\nprohibition = "no"'))
    (tmp_path / "b.toml").write_text(DERIVED)
    loaded = specs.load_specs(spark, str(tmp_path))
    file = spark.createDataFrame([("one", "p/x.png", "a", "h")], "pack string, path string, source_id string, sha256 string")
    assert [r["code"] for r in integrity.parents(loaded.source, file).collect()] == ["C31", "D4"]
    with pytest.raises(Exception, match="derivatives are forbidden"):
        ingest.parent_files(loaded.source, file).collect()


def test_mutations_are_the_same_each_time(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([("a/b.bin", bytearray(data)), ("c", bytearray(b""))], "path string, bytes binary")
    once, again = (sorted((r["path"], r["derived"], bytes(r["bytes"])) for r in derive.derive_all(df).collect()) for _ in range(2))
    assert once == again
    own = {d: b for p, d, b in once if p == "a/b.bin"}
    assert len(own) == 21 and data not in own.values()
    assert own["b.header-magic.bin"] == bytes(4) + data[4:] and own["b.length-8-max.bin"] == data[:8] + b"\xff" * 4 + data[12:]
    assert [d for p, d, b in once if p == "c"] == ["c.empty", "c.one-byte"]
    flips = [b for d, b in own.items() if "bitflip" in d]
    assert all(sum(x != y for x, y in zip(b, data, strict=True)) == 1 for b in flips) and len(flips) == 3


def flips(data):
    """Places of bit flips, by plain arithmetic."""
    low, found = min(derive.FLIP_FROM, len(data)), []
    for k in range(derive.DRAWS if low < len(data) else 0):
        at = low + int.from_bytes(hashlib.sha256(data[:64] + k.to_bytes(4, "big")).digest()[:8], "big") % (len(data) - low)
        if at not in found and len(found) < derive.FLIPS:
            found.append(at)
    return sorted(found)


def test_bit_flips_against_plain_arithmetic(spark):
    rows = [(f"{n}.bin", bytearray(hashlib.sha512(b"%d" % n).digest() * 3)[:n]) for n in (0, 1, 63, 64, 65, 66, 67, 70, 100, 191)] + [("ff.bin", bytearray(b"\xff" * 90)), ("null.bin", None)]
    got = {(r["path"], r["label"]): bytes(r["bytes"]) for r in derive.derive_all(spark.createDataFrame(rows, "path string, bytes binary"), ["bitflip"]).collect()}
    want = {}
    for path, data in rows:
        for k, at in enumerate(flips(bytes(data)) if data is not None else ()):
            want[path, f"bitflip-{k}"] = bytes(data[:at]) + bytes([data[at] ^ 1 << at % 8]) + bytes(data[at + 1 :])
    assert got == want and len(want) == 1 + 2 + 3 * 5


def files_and_sources(spark):
    lic = lambda declared="MIT", use="yes", onward="unrestricted", redistributable=True, permissive=False: (declared, use, onward, redistributable, permissive)
    sources = [("p", "mit", lic()), ("p", "gpl", lic("GPL-3.0")), ("p", "test", lic(onward="testing-only")), ("p", "nc", lic(use="no", onward="non-commercial")), ("p", "own", lic("LicenseRef-X", permissive=True)), ("p", "null", lic(onward=None))]
    source = spark.createDataFrame(sources, "pack string, id string, license struct<declared:string,commercial_use:string,onward_use:string,redistributable:boolean,permissive:boolean>")
    rows = [("p", s, s, f"h-{s}", None, None) for _, s, _ in sources] + [("p", "dep", "mit", "h-dep", ("s", "h", "open"), None), ("p", "ok", "mit", "h-ok", ("s", "h", "resolved"), None), ("p", "out", "mit", "h-out", None, ("why", None)), ("p", "twin", "mit", "h-out", None, None)]
    file = spark.createDataFrame(rows, f"pack string, path string, source_id string, sha256 string, depicts {schemas.DEPICTS}, exclude {schemas.EXCLUDE}").withColumn("size", F.lit(2).cast("long"))
    return file, source


def test_variants(spark):
    file, source = files_and_sources(spark)
    got = {v: {r["path"] for r in variants.select_variant(file, source, v).collect()} for v in variants.VARIANTS}
    assert got["full"] == {"mit", "gpl", "test", "nc", "own", "null", "dep", "ok", "twin"}
    assert got["demo"] == {"mit", "gpl", "nc", "own", "null", "ok", "twin"}
    assert got["permissive"] == {"mit", "own", "null", "ok", "twin"}
    kept = variants.select_variant(file, source, "full")
    assert [(r["path"], r["excluded_path"], r["excluded"]) for r in variants.breaches(kept, file).collect()] == [("twin", "out", 1)]
    copies = file.unionByName(file.where("path = 'out'").withColumn("path", F.lit("again")))
    assert [(r["path"], r["excluded_path"], r["excluded"]) for r in variants.breaches(kept, copies).collect()] == [("twin", "again", 2)]
    assert variants.noncommercial(source, kept).first()["noncommercial"] is True


def test_closed_and_unknown_sources_stop_the_job(spark):
    file, source = files_and_sources(spark)
    closed = source.withColumn("license", F.struct("license.declared", "license.commercial_use", "license.onward_use", (F.col("id") != "mit").alias("redistributable"), "license.permissive"))
    with pytest.raises(Exception, match="not redistributable"):
        variants.select_variant(file, closed, "full").collect()
    with pytest.raises(Exception, match="without a source"):
        variants.select_variant(file, source.where("id <> 'gpl'"), "full").collect()


def test_source_eligibility_inherits_from_the_parent(spark, loaded):
    got = {(r["pack"], r["variant"]): r["sources"] for r in variants.source_eligibility(loaded.source).collect()}
    assert got == {(p, v): 1 for p in ("one", "two") for v in variants.VARIANTS}


DESCRIPTORS = {
    "m/a.atlas": (b"page.png\nsize: 1,1\n  region.x\n\nother\n", ["page.png"]),
    "m/a.fnt": (b'page id=0 file="f 0.png"', ["f 0.png"]),
    "m/a.plist": (b"<key>realTextureFileName</key>\n<string>t.png</string><key>textureFileName</key><string>u.png</string>", ["u.png", "t.png"]),
    "m/a.tmx": (b'<tileset source="t.tsx"/><image a="1" source="i.png"/>', ["i.png", "t.tsx"]),
    "m/a.tmj": (b'{"image":"r.png","tilesets":[{"image":"a.png","source":"b.tsx"},{}]}', ["r.png", "a.png", "b.tsx"]),
    "m/a.xml": (b'<TextureAtlas x="1" imagePath="p.png">', ["p.png"]),
    "m/a.pex": (b'<texture name="q.png"/>', ["q.png"]),
    "m/a.obj": (b"v 1\nmtllib lib one.mtl \n", ["lib one.mtl"]),
    "m/a.mtl": (b"newmtl x\nKd 1 1 1\nmap_Kd -s 1 2 3 tex.png\nmap_Ka on\nmap_bump -bm 0.5 -clamp on -imfchan r b/n.1.png \r\n  map_Ks no.png\nmap_d -mm 0 1.5 -o .5 -t 1 2 -type sphere d.tga\nmap_Ns -s 1 2\nmap_Ke none\n", ["tex.png", "b/n.1.png", "d.tga"]),
    "m/a.gltf": (b'{"buffers":[{"uri":"b.bin"},{"uri":"data:x"},{}],"images":[{"uri":"i%20j.png"}]}', ["b.bin", "i j.png"]),
    "m/a.json": (b'{"assets":[{"u":"img/","p":"k.png"},{"p":"data:z"}],"imagePath":"d.png"}', ["d.png", "img/k.png"]),
    "m/b.json": (b"not json", []),
    "m/c.fnt": (b'file="/abs.png" file="http://h/x.png" file="../up.png"', ["../up.png"]),
}


def test_references(spark):
    content = spark.createDataFrame([("p", k, bytearray(v[0])) for k, v in DESCRIPTORS.items()], "pack string, path string, bytes binary")
    got: dict = {}
    for r in references.references(content).collect():
        got.setdefault(r["path"], []).append((r["raw_ref"], r["target"]))
    for path, (_, want) in DESCRIPTORS.items():
        assert [x[0] for x in got.get(path, [])] == want, path
    assert got["m/c.fnt"] == [("../up.png", "up.png")]
    assert references.references(content, most_bytes=3).count() == 0


def test_unresolved(spark):
    refs = spark.createDataFrame([("p", "m/a.fnt", "x.png", "m/x.png"), ("p", "m/a.fnt", "../../up.png", "../up.png"), ("p", "m/a.plist", "deep/n.png", "m/deep/n.png"), ("p", "m/a.fnt", "n.png", "m/n.png")], "pack string, path string, raw_ref string, target string")
    file = spark.createDataFrame([("p", "m/x.png"), ("q", "up.png"), ("q", "else/n.png")], "pack string, path string")
    assert [r["raw_ref"] for r in references.unresolved(refs, file).collect()] == ["n.png"]
    packs = spark.createDataFrame([("p", "g"), ("q", "g"), ("r", None)], "name string, merge_group string")
    scenes = refs.withColumn("path", F.regexp_replace("path", r"\.\w+$", ".gltf"))
    assert sorted(r["raw_ref"] for r in references.merge_group_missing(scenes, file, packs).collect()) == ["deep/n.png", "n.png"]
    assert references.merge_group_missing(refs, file, packs).count() == 0  # other dialects are for information only
    assert references.merge_group_missing(scenes, file, packs.where("name <> 'q'")).count() == 0


def test_integrity(spark):
    file = spark.createDataFrame([("p", "a", "s", hashlib.sha256(b"a").hexdigest()), ("p", "b", "s", "0"), ("p", "c", "s", "0")], "pack string, path string, source_id string, sha256 string")
    content = spark.createDataFrame([("p", "a", bytearray(b"a")), ("p", "b", bytearray(b"b"))], "pack string, path string, bytes binary")
    assert sorted((r["path"], r["detail"][:7]) for r in integrity.contents(file, content).collect()) == [("b", "hash di"), ("c", "missing")]
    source = spark.createDataFrame([("p", "s", "r", None, "c1"), ("q", "t", "r", "HEAD", "c2")], "pack string, id string, repo string, ref string, commit string")
    assert integrity.pins(source).first()["detail"] == "r@HEAD is c1, c2 in p, q"
    packs = spark.createDataFrame([("p", None), ("q", None)], "name string, merge_group string")
    found = integrity.verify(packs, source, file, content)
    assert integrity.exit_code(found) == 1 and {r["check"] for r in found.collect()} == {"contents", "pins"}


def test_drift(spark, loaded):
    locked = spark.createDataFrame([("one", "a", "c" * 40)], "pack string, id string, commit string")
    refs = spark.createDataFrame([("r/a", "HEAD", "d" * 40)], schemas.REF_SNAPSHOT)
    code = lambda lock, refs: [r["code"] for r in integrity.drift(loaded.source, lock, refs).collect()]
    assert code(locked, refs) == ["moved"] and code(locked.limit(0), refs) == ["absent"] and code(locked, refs.limit(0)) == ["unobserved"]
    assert code(locked.withColumn("commit", F.lit(None).cast("string")), refs) == []


def test_summaries(spark):
    pack = spark.createDataFrame([("p", "g"), ("q", "g"), ("z", None)], "name string, merge_group string")
    file = spark.createDataFrame([("p", "a", 2, ("png", None, "{}")), ("p", "a", 3, None), ("q", "b", 1, ("png", "1", "{}"))], f"pack string, source_id string, size long, format {schemas.FORMAT}").withColumns({"depicts": F.lit(None).cast(schemas.DEPICTS), "exclude": F.lit(None).cast(schemas.EXCLUDE)})
    assert sorted(map(tuple, summaries.totals(pack, file).collect())) == [("p", 2, 5), ("q", 1, 1), ("z", 0, 0)]
    assert sorted(map(tuple, summaries.merge_group_files(pack, file).collect())) == [("g", 2, 3)]
    assert [tuple(r) for r in summaries.by_frequency(summaries.format_histogram(file)).collect()] == [("p", "png", None, 1), ("p", "unrecognised", None, 1), ("q", "png", "1", 1)]
    source = spark.createDataFrame([("p", "a"), ("p", "none")], "pack string, id string")
    assert sorted(map(tuple, summaries.files_per_source(source, file).collect())) == [("p", "a", 2), ("p", "none", 0)]
    assert summaries.show(pack, source, file).count() == 3 + 2 + 3 + 2 + 2


def test_lfs(spark):
    data, oid = b"object", hashlib.sha256(b"object").hexdigest()
    pointer = f"{files.POINTER}\noid sha256:{oid}\nsize 6\n".encode()
    rows = spark.createDataFrame([("a", bytearray(pointer)), ("b", bytearray(b"plain")), ("c", bytearray(pointer.replace(b"size 6\n", b"")))], "path string, bytes binary")
    assert [r[0] and tuple(r[0]) for r in rows.select(files.lfs_pointer(F.col("bytes"))).collect()] == [(oid, 6), None, None]
    objects = spark.createDataFrame([(oid, bytearray(data))], "oid string, object binary")
    assert {r["path"]: bytes(r["bytes"]) for r in files.resolve_lfs(rows, objects).collect()}["a"] == data
    with pytest.raises(Exception, match="differs from its pointer"):
        files.resolve_lfs(rows, objects.withColumn("object", F.lit(b"x"))).collect()


def test_lfs_plain_rows_stay_dealt_out(spark):
    oid = hashlib.sha256(b"object").hexdigest()
    pointer = F.lit(f"{files.POINTER}\noid sha256:{oid}\nsize 6\n")
    text = F.when(F.col("id") % 10 == 0, pointer).when(F.col("id") % 10 > 1, F.concat(F.lit("plain "), "id"))  # the rest have no bytes
    rows = spark.range(0, 800, 1, 8).select("id", F.encode(text, "UTF-8").alias("bytes"), F.lit("own").alias("oid"))
    objects = spark.createDataFrame([(oid, bytearray(b"object")), ("f" * 64, bytearray(b"wrong, but named by none"))], "oid string, object binary")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = files.resolve_lfs(rows, objects).withColumn("task", F.spark_partition_id()).collect()
        with pytest.raises(Exception, match="differs from its pointer"):
            files.resolve_lfs(rows, objects.where("object <> encode('object', 'UTF-8')")).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    want = {i: b"object" if i % 10 == 0 else f"plain {i}".encode() if i % 10 > 1 else None for i in range(800)}
    assert len(got) == 800 and {r["id"]: r["bytes"] and bytes(r["bytes"]) for r in got} == want and {r["oid"] for r in got} == {"own"}
    plain = [r["task"] for r in got if r["id"] % 10]
    assert max(plain.count(t) for t in set(plain)) == 90


def test_trees_tars_and_locks(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"truncated": False, "tree": [{"path": "a", "type": "blob", "sha": "1"}, {"path": "d", "type": "tree", "sha": "2"}]}))
    (tmp_path / "u.json").write_text(json.dumps({"truncated": True, "tree": [{"path": "a", "type": "blob", "sha": "1"}]}))
    assert [tuple(r) for r in files.tree(spark, str(tmp_path / "t.json"), "sub/").collect()] == [("sub/a", "1")]
    with pytest.raises(Exception, match="truncated"):
        files.tree(spark, str(tmp_path / "u.json")).collect()
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        for name, body in (("top/a.txt", b"A"), ("top/d/b.txt", b"B"), ("loose", b"C")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    assert [(r["path"], bytes(r["bytes"])) for r in files.tar_members(spark, str(tmp_path / "x.tar.gz")).orderBy("ordinal").collect()] == [("a.txt", b"A"), ("d/b.txt", b"B")]
    doc = {"pack": {"name": "p"}, "sources": [{"id": "s", "kind": "upstream", "license": {"declared": "MIT", "commercialUse": True, "redistributable": True}}], "files": [{"path": "a", "sourceId": "s", "sha256": "0", "size": 1, "format": {"kind": "png", "width": 3}}]}
    (tmp_path / "p.json").write_text(json.dumps(doc, indent=2))
    tables = files.load_locks(spark, str(tmp_path / "p.json"))
    assert tables["source"].first()["license"]["commercial_use"] == "yes" and tables["file"].first()["format"]["kind"] == "png"


def test_content_layout(spark, tmp_path):
    (tmp_path / "p" / "d").mkdir(parents=True)
    (tmp_path / "p" / "d" / "a.bin").write_bytes(b"12345")
    assert [(r["pack"], r["path"], r["size"]) for r in files.content(spark, str(tmp_path)).collect()] == [("p", "d/a.bin", 5)]
    assert files.content(spark, str(tmp_path), most_bytes=4).count() == 0


def test_export(spark, loaded, tmp_path):
    file, source = files_and_sources(spark)
    file = file.where("path <> 'twin'").withColumns({"format": F.lit(None).cast(schemas.FORMAT), "derived_from": F.lit(None).cast("string"), "strategy": F.lit(None).cast("string")})
    lic = F.struct("license.*", F.lit("directory").alias("declared_scope"), *[F.lit(None).cast("string").alias(c) for c in ("declared_from", "covers", "source_code")], F.array().cast("array<struct<declared:string,declared_from:string,note:string,snapshot:string>>").alias("underlying"))
    source = source.withColumns({"license": lic, "kind": F.lit("upstream"), "repo": F.lit("r"), "ref": F.lit(None).cast("string"), "commit": F.lit("c" * 40), "url": F.lit(None).cast("string"), "retrieved": F.lit(str(datetime.date(2024, 1, 2))), "license_snapshot": F.lit("licenses/x.txt"), "adjacent_path": F.lit(None).cast("string")})
    pack = spark.createDataFrame([("p", "sum", None)], "name string, summary string, merge_group string")
    kept = variants.select_variants(file, source)
    content = file.select("pack", "path", F.encode("path", "UTF-8").alias("bytes"))
    texts = spark.createDataFrame([("MIT", "permission")], "token string, text string")
    snapshots = spark.createDataFrame([("licenses/x.txt", bytearray(b"X"))], "snapshot string, bytes binary")
    members = export.archive_members(pack, source, kept, content, texts, snapshots)
    first, second = (export.export(members, file, str(tmp_path / d), "1") for d in ("a", "b"))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    with tarfile.open(tmp_path / "a" / "p-demo-1.tar.gz") as tar:
        names = tar.getnames()
        assert names == sorted(names) and {"LICENSES/MIT.txt", "LICENSES/x.txt", "NOTICE.md", "README.md", "manifest.json", "mit"} <= set(names)
        manifest = json.loads(tar.extractfile("manifest.json").read())
        assert manifest["totals"] == {"files": len(manifest["files"]), "bytes": 2 * len(manifest["files"])} and "depicts" not in manifest["files"][0]
        assert "## mit  (2 files)" in tar.extractfile("NOTICE.md").read().decode()
        assert "Not for commercial use" in tar.extractfile("README.md").read().decode()
    export.write_index(first, str(tmp_path / "a"), "1", {"commit": "z"})
    index = json.loads((tmp_path / "a" / "index.json").read_text())
    assert [p["variant"] for p in index["packs"]] == ["demo", "full", "permissive"] and "merge_group" not in index["packs"][0]
    assert (tmp_path / "a" / "SHA256SUMS").read_text().splitlines()[0] == f"{index['packs'][0]['sha256']}  p-demo-1.tar.gz"
    bad = file.withColumn("exclude", F.when(F.col("path") == "out", F.col("exclude"))).unionByName(file.where("path = 'mit'").withColumns({"path": F.lit("gone"), "exclude": F.struct(F.lit("x").alias("reason"), F.lit(None).cast("string").alias("ref")), "sha256": F.sha2(F.lit("mit"), 256)}))
    with pytest.raises(ValueError, match="excluded contents"):
        export.export(members, bad, str(tmp_path / "c"), "1")
