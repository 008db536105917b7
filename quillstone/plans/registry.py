"""All queries of the engine itself, by name, with the DuckDB SQL that gives the same rows.

The tables at hand hold no packs; documents stand for files (language: pack, source: source, text: content), labels for licence facts,
orders for pins, pages for descriptors. Every query runs an operator of the engine over its whole tables. Three run over generated tables, as no table
at hand holds what they read: formats, descriptors of all dialects, and specifications that break one constraint each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import paths, texts
from quillstone.operators import derive, export, ingest, integrity, locks, pairing, references, summaries, variants
from quillstone.plans import goldens, violations
from quillstone.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

NO_DEPICTS = "struct<subject:string,rights_holder:string,status:string>"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a file table."""
    docs = _table(spark, sf_dir, "documents")
    return docs.select(
        F.col("lang").alias("pack"), F.concat(F.lit("doc/"), "source", F.lit("/"), "doc_id", F.lit(".txt")).alias("path"), F.col("source").alias("source_id"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"),
        F.struct(F.col("lang").alias("kind"), F.col("source").alias("version"), F.lit(None).cast("string").alias("attrs")).alias("format"), F.when(F.col("n_chars") > 5000, F.struct(F.lit("s").alias("subject"), F.lit("h").alias("rights_holder"), F.lit("open").alias("status"))).cast(NO_DEPICTS).alias("depicts"),
        F.when(F.col("n_chars") < 40, F.struct(F.lit("short").alias("reason"), F.lit(None).cast("string").alias("ref"))).alias("exclude"), "doc_id",
    )


def _pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("lang").alias("name"), F.when(F.col("lang").isin("de", "fr"), "group").alias("merge_group")).distinct()


def _licensed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as files of a source each, and those sources with licence facts made from the labels; what has no label counts as neither good nor toxic."""
    rows = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left")
    name = F.col("doc_id").cast("string")
    depicts = F.when(F.col("doc_id") % 7 == 0, F.struct(F.lit("s").alias("subject"), F.lit("h").alias("rights_holder"), F.when(F.col("doc_id") % 2 == 0, "resolved").otherwise("open").alias("status")))
    file = rows.select(F.col("lang").alias("pack"), name.alias("path"), name.alias("source_id"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"), depicts.alias("depicts"), F.when(F.col("doc_id") % 11 == 0, F.lit("x")).alias("exclude"))
    license = F.struct(
        F.when(F.col("quality") == 1, "MIT").otherwise("GPL-3.0-only").alias("declared"), F.when(F.col("toxic") == 1, "no").otherwise("yes").alias("commercial_use"), F.lit(True).alias("redistributable"), F.lit(False).alias("permissive"),
        F.when(F.col("doc_id") % 5 == 0, "testing-only").when(F.col("doc_id") % 5 == 1, "non-commercial").otherwise("unrestricted").alias("onward_use"),
    )
    return file, rows.select(F.col("lang").alias("pack"), name.alias("id"), license.alias("license"))


_LICENSED = """
WITH f AS (SELECT d.lang AS pack, d.doc_id, octet_length(encode(d.text)) AS size, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic,
  d.doc_id % 11 = 0 AS excluded, NOT (d.doc_id % 7 = 0 AND d.doc_id % 2 = 1) AS settled, d.doc_id % 5 AS onward
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
v AS (SELECT 'full' AS variant, * FROM f WHERE NOT excluded
  UNION ALL SELECT 'demo', * FROM f WHERE NOT excluded AND settled AND onward <> 0
  UNION ALL SELECT 'permissive', * FROM f WHERE NOT excluded AND settled AND onward > 1 AND quality = 1 AND toxic <> 1)
"""


@query("SELECT lang AS pack, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM documents GROUP BY lang")
def lock_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.totals(_pack(spark, sf_dir), _file(spark, sf_dir))


@query("SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text)) AS size FROM documents")
def sha256_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("bytes"))
    return files.fingerprinted(docs).drop("bytes")


@query("SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.duplicates(_file(spark, sf_dir), "doc_id").withColumnRenamed("first", "first_id")


@query("SELECT n.n_name AS source_id, 'all' AS pack, count(s.s_suppkey) AS files FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name")
def source_counts_with_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    suppliers = _table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))  # nations: a fixed table
    return summaries.files_per_source(nation.select(F.lit("all").alias("pack"), F.col("n_name").alias("id")), suppliers.select(F.lit("all").alias("pack"), F.col("n_name").alias("source_id")))


@query("SELECT lang AS pack, lang AS kind, source AS version, count(*) AS files FROM documents GROUP BY lang, source")
def format_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.format_histogram(_file(spark, sf_dir))


@query("SELECT lang AS pack, count(*) FILTER (WHERE n_chars > 5000) AS depicting, count(*) FILTER (WHERE n_chars < 40) AS excluded FROM documents GROUP BY lang")
def flagged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.flagged(_file(spark, sf_dir))


def _pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("repo"), F.lit(None).cast("string").alias("ref"), F.col("o_orderstatus").alias("commit"), F.col("o_orderpriority").alias("pack"))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS repo, 'HEAD' AS ref, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS commits, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS packs
FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1""")
def pin_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.pin_conflicts(_pins(spark, sf_dir)).select("repo", "ref", F.array_join("commits", ",").alias("commits"), F.array_join("packs", ",").alias("packs"))


@query("SELECT 'group' AS merge_group, count(DISTINCT lang) AS packs, count(*) AS files FROM documents WHERE lang IN ('de', 'fr') HAVING count(DISTINCT lang) > 1")
def merge_group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.merge_group_files(_pack(spark, sf_dir), _file(spark, sf_dir))


def _url_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("path"))


@query("""SELECT page_id, path FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages)
WHERE regexp_matches(path, '^(?:[^/]*/(?:.*/)?[^/]*[^/])$') AND NOT regexp_matches(path, '^(?:.*[02468])$')""")
def glob_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = [f"**{d}" for d in "02468"]
    return _url_path(spark, sf_dir).where(paths.selects(F.col("path"), ["*/**/*?"], odd))


@query("""SELECT page_id, ltrim('kept/' || CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END, '/') AS path FROM pages""")
def dest_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", paths.destination(F.col("url"), F.lit("https://"), F.lit("/kept/")).alias("path"))


@query(_LICENSED + "SELECT pack, CAST(doc_id AS VARCHAR) AS path, size FROM v WHERE variant = 'demo'")
def variant_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.select_variant(*_licensed(spark, sf_dir), "demo").select("pack", "path", "size")


@query(_LICENSED + "SELECT pack, CAST(doc_id AS VARCHAR) AS path, size FROM v WHERE variant = 'permissive'")
def variant_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.select_variant(*_licensed(spark, sf_dir), "permissive").select("pack", "path", "size")


@query(_LICENSED + "SELECT variant, pack, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM v GROUP BY variant, pack")
def union_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.select_variants(*_licensed(spark, sf_dir)).groupBy("variant", "pack").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


@query("""SELECT d.lang AS pack, v.variant, count(*) AS sources FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id, (VALUES ('full'), ('demo'), ('permissive')) v(variant)
WHERE v.variant = 'full' OR (v.variant = 'demo' AND d.doc_id % 5 <> 0) OR (v.variant = 'permissive' AND d.doc_id % 5 > 1 AND l.quality = 1 AND coalesce(l.toxic, 0) <> 1) GROUP BY ALL""")
def source_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _licensed(spark, sf_dir)[1].withColumns({"from_pack": F.lit(None).cast("string"), "from_source": F.lit(None).cast("string")})
    return variants.source_eligibility(source)


@query(_LICENSED + "SELECT pack, bool_or(toxic = 1) AS noncommercial FROM v WHERE variant = 'full' GROUP BY pack")
def noncommercial_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    file, source = _licensed(spark, sf_dir)
    return variants.noncommercial(source, variants.select_variant(file, source, "full"))


@query("""SELECT k.lang AS pack, k.doc_id AS kept_id, min(x.doc_id) AS excluded_id, count(*) AS excluded FROM documents k JOIN documents x ON k.text = x.text AND k.lang = x.lang
WHERE x.n_chars < 40 GROUP BY k.lang, k.doc_id""")
def excluded_hash_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a member, against the documents that are excluded."""
    file = _file(spark, sf_dir).withColumn("path", F.col("doc_id"))
    return variants.breaches(file, file).select("pack", F.col("path").alias("kept_id"), F.col("excluded_path").alias("excluded_id"), "excluded")


@query("SELECT 'annotations' AS \"check\", d.lang AS pack, d.source AS source_id, CAST(d.doc_id AS VARCHAR) AS path, 'C36' AS code, 'no such file' AS detail, true AS fatal FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_join_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    notes = docs.select(F.col("lang").alias("pack"), F.col("source").alias("source_id"), F.col("doc_id").cast("string").alias("path"))
    known = docs.join(_table(spark, sf_dir, "labels"), "doc_id").select(F.col("lang").alias("pack"), F.col("doc_id").cast("string").alias("path"))
    return integrity.orphan_annotations(notes, known)


@query("""WITH heads AS (SELECT l_orderkey, max(l_linestatus) AS head FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS source_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'absent' WHEN head IS NULL THEN 'unobserved' ELSE 'moved' END AS code
FROM orders LEFT JOIN heads ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' OR head IS NULL OR head <> o_orderstatus""")
def drift_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(F.lit("p").alias("pack"), F.col("o_orderkey").cast("string").alias("id"), F.lit("upstream").alias("kind"), F.struct(F.lit(True).alias("redistributable")).alias("license"), F.col("o_orderkey").cast("string").alias("repo"), F.lit(None).cast("string").alias("ref"), F.col("o_orderstatus").alias("commit"), "o_orderpriority")
    refs = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linestatus").alias("commit")).select(F.col("l_orderkey").cast("string").alias("repo"), F.lit("HEAD").alias("ref"), "commit")
    return integrity.drift(orders, orders.where("o_orderpriority <> '1-URGENT'"), refs).select("source_id", "code")


@query("""SELECT orderkey, "commit" FROM (SELECT l_orderkey AS orderkey, l_linestatus AS "commit", row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linestatus) AS k FROM lineitem) WHERE k = 1""")
def ref_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("repo"), F.lit(None).cast("string").alias("ref"), F.col("l_linestatus").alias("commit"), F.col("l_linenumber").alias("ordinal"))
    return files.ref_snapshot(rows).select(F.col("repo").alias("orderkey"), "commit")


@query("""SELECT d.lang AS pack, CAST(d.doc_id AS VARCHAR) AS path, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'hash differs: ' || sha256(d.text || 'x') END AS detail
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL OR l.toxic = 1""")
def verify_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    file = docs.select(F.col("lang").alias("pack"), F.col("doc_id").cast("string").alias("path"), F.lit(None).cast("string").alias("source_id"), F.sha2("text", 256).alias("sha256"))
    held = docs.join(_table(spark, sf_dir, "labels"), "doc_id").select(F.col("lang").alias("pack"), F.col("doc_id").cast("string").alias("path"), F.encode(F.when(F.col("toxic") == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text")), "UTF-8").alias("bytes"))
    return integrity.contents(file, held).select("pack", "path", "detail")


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in pages, as references of tile maps: links become images, and site-absolute paths lose their slash."""
    pages = _table(spark, sf_dir, "pages").select("page_id", F.explode(references.extracted(F.lit("page.tmx"), F.regexp_replace("html", r'<\w+([^>]*?)\shref="', '<image$1 source="'))).alias("raw_ref"))
    return pages.select(F.lit("pages").alias("pack"), F.col("page_id").cast("string").alias("path"), "raw_ref", F.regexp_replace("raw_ref", "^/+", "").alias("target"))


@query(r"""SELECT page_id, unnest(regexp_extract_all(html, '<\w+[^>]*\shref="([^"]+)"', 1)) AS raw_ref FROM pages""")
def reference_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refs(spark, sf_dir).select(F.col("path").cast("long").alias("page_id"), "raw_ref")


@query(r"""WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '<\w+[^>]*\shref="([^"]+)"', 1)) AS raw_ref FROM pages),
p AS (SELECT DISTINCT regexp_replace(url, '^[a-z]+://[^/]*/', '') AS path FROM pages)
SELECT page_id, raw_ref FROM r WHERE ltrim(raw_ref, '/') NOT IN (SELECT path FROM p) AND ltrim(ltrim(raw_ref, '/'), './') NOT IN (SELECT path FROM p)""")
def reference_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = _table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^[a-z]+://[^/]*/", "").alias("path"))
    return references.unresolved(_refs(spark, sf_dir), present).select(F.col("path").cast("long").alias("page_id"), "raw_ref")


#: A descriptor of each dialect, and what it names: (name, text, targets), # for the page.
DESCRIPTORS = (
    ("d/#.atlas", "\np#.png\nsize: 64,64\n  region.one\n", ("d/p#.png",)),
    ("d/#.fnt", 'page id=0 file="f#.png"\npage id=1 file="/abs.png"', ("d/f#.png",)),
    ("d/#.plist", "<key>textureFileName</key>\n  <string>t#.png</string><key>realTextureFileName</key><string>r#.png</string>", ("d/t#.png", "d/r#.png")),
    ("d/e/#.tmx", '<map><image width="1" source="../../sheets%2F#.png"/><image source="http://host/a.png"/><tileset firstgid="1" source="#.tsx"/></map>', ("sheets/#.png", "d/e/#.tsx")),
    ("d/#.tsx", '<tileset><image source="s#.png"/></tileset>', ("d/s#.png",)),
    ("d/#.tmj", '{"image":"m#.png","tilesets":[{"source":"#.tsj"},{"image":"n#.png"}]}', ("d/m#.png", "d/#.tsj", "d/n#.png")),
    ("d/#.tsj", '{"image":"o#.png"}', ("d/o#.png",)),
    ("d/#.xml", '<TextureAtlas imagePath="a%20#.png">', ("d/a #.png",)),
    ("d/#.pex", '<texture name="q#.png"/>', ("d/q#.png",)),
    ("d/#.obj", "v 0 0 0\nmtllib l#.mtl\n", ("d/l#.mtl",)),
    ("d/#.mtl", "newmtl a\nmap_Kd -s 1 1 1 -clamp on k#.png\nmap_Ka none\n", ("d/k#.png",)),
    ("d/#.gltf", '{"buffers":[{"uri":"b#.bin"},{"uri":"data:x"}],"images":[{"uri":"i#.png"}]}', ("d/b#.bin", "d/i#.png")),
    ("d/#.json", '{"imagePath":"j#.png","assets":[{"u":"img/","p":"v#.png"},{"p":"data:y"}]}', ("d/j#.png", "d/img/v#.png")),
)


@query("SELECT page_id, replace(path, '#', CAST(page_id AS VARCHAR)) AS path, replace(target, '#', CAST(page_id AS VARCHAR)) AS target FROM pages, (VALUES " + ", ".join(f"('{name}', '{target}')" for name, _, targets in DESCRIPTORS for target in targets) + ") v(path, target)")
def reference_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptors of all dialects for every page."""
    kinds = F.broadcast(spark.createDataFrame([(name, text) for name, text, _ in DESCRIPTORS], "name string, text string"))  # a row for each dialect
    own = lambda c: F.replace(F.col(c), F.lit("#"), F.col("page_id").cast("string"))
    rows = _table(spark, sf_dir, "pages").select("page_id").join(kinds).select(F.lit("p").alias("pack"), own("name").alias("path"), F.encode(own("text"), "UTF-8").alias("bytes"))
    return references.references(rows).select(F.regexp_extract("path", r"(\d+)\.\w+$", 1).cast("long").alias("page_id"), "path", "target")


@query("""SELECT lang, source, doc_id FROM (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY sha256(text), 'doc/' || source || '/' || doc_id || '.txt') AS k FROM documents) WHERE k <= 3""")
def deterministic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.sample_by_hash(_file(spark, sf_dir).withColumn("most", F.lit(3)), ["pack", "source_id"], "most").select(F.col("pack").alias("lang"), F.col("source_id").alias("source"), "doc_id")


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("a/"), "doc_id", F.lit(".txt")).alias("path"), F.encode("text", "UTF-8").alias("bytes"))


@query("""SELECT doc_id, doc_id || '.truncate-' || lpad(CAST(p AS VARCHAR), 2, '0') || 'pct.txt' AS derived, greatest(1, n * p // 100) AS size
FROM (SELECT doc_id, octet_length(encode(text)) AS n FROM documents), (VALUES (1), (10), (50), (99)) v(p) WHERE greatest(1, n * p // 100) < n""")
def derive_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.derive_all(_content(spark, sf_dir), ["truncate"]).select("doc_id", "derived", F.octet_length("bytes").cast("long").alias("size"))


@query("""SELECT doc_id, doc_id || '.' || label || '.txt' AS derived, size, head FROM (
SELECT doc_id, 'empty' AS label, 0 AS size, '' AS head FROM documents UNION ALL SELECT doc_id, 'one-byte', 1, CASE WHEN text = '' THEN '00' ELSE substr(hex(encode(text)), 1, 2) END FROM documents)""")
def derive_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.derive_all(_content(spark, sf_dir), ["empty"]).select("doc_id", "derived", F.octet_length("bytes").alias("size"), F.hex("bytes").alias("head"))


@query("""WITH d AS (SELECT doc_id, hex(encode(text)) AS h FROM documents WHERE octet_length(encode(text)) >= 16)
SELECT doc_id, 'header-magic' AS label, sha256('00000000' || substr(h, 9)) AS sha FROM d UNION ALL SELECT doc_id, 'header-zeroed', sha256(repeat('00', 16) || substr(h, 33)) FROM d""")
def derive_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.derive_all(_content(spark, sf_dir), ["header"]).select("doc_id", "label", F.sha2(F.hex("bytes"), 256).alias("sha"))


@query("""WITH d AS (SELECT doc_id, hex(encode(text)) AS h FROM documents WHERE octet_length(encode(text)) >= 32)
SELECT doc_id, 'length-' || o || '-' || l AS label, sha256(substr(h, 1, 2 * o) || f || substr(h, 2 * o + 9)) AS sha FROM d, (VALUES (4), (8), (12), (16), (20)) a(o), (VALUES ('max', 'FFFFFFFF'), ('zero', '00000000')) b(l, f)""")
def derive_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.derive_all(_content(spark, sf_dir), ["lengths"]).select("doc_id", "label", F.sha2(F.hex("bytes"), 256).alias("sha"))


@query("""WITH d AS (SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents WHERE octet_length(encode(text)) > 64),
k AS (SELECT doc_id, n, k, 64 + CAST(('0x' || substr(sha256(unhex(substr(h, 1, 128) || lpad(hex(k), 8, '0'))), 1, 16))::UBIGINT % CAST(n - 64 AS UBIGINT) AS BIGINT) AS spot FROM d, range(24) r(k)),
f AS (SELECT doc_id, spot, min(k) AS k FROM k GROUP BY doc_id, spot),
c AS (SELECT doc_id, spot, row_number() OVER (PARTITION BY doc_id ORDER BY spot) - 1 AS j FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM f) WHERE i <= 3)
SELECT c.doc_id, 'bitflip-' || j AS label, c.doc_id || '.bitflip-' || j || '.txt' AS derived,
  sha256(unhex(substr(h, 1, 2 * spot) || lpad(hex(xor(('0x' || substr(h, 2 * spot + 1, 2))::INT, 1 << CAST(spot % 8 AS INT))), 2, '0') || substr(h, 2 * spot + 3))) AS sha FROM c JOIN d ON c.doc_id = d.doc_id""")
def derive_bitflip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.derive_all(_content(spark, sf_dir), ["bitflip"]).select("doc_id", "label", "derived", F.sha2("bytes", 256).alias("sha"))


@query("SELECT role, text, conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY role, text ORDER BY conv_id, turn) AS k FROM conversations) WHERE k = 1")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.first_wins(_table(spark, sf_dir, "conversations"), ["role", "text"], ["conv_id", "turn"])


@query("SELECT conv_id, max(turn) AS turn, max_by(sha256(text), turn) AS sha FROM conversations GROUP BY conv_id")
def overwrite_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select(F.lit("p").alias("pack"), F.lit("full").alias("variant"), F.col("conv_id").alias("name"), F.col("turn").alias("precedence"), F.encode("text", "UTF-8").alias("bytes"), "turn")
    return export.overwrite_wins(rows).select(F.col("name").alias("conv_id"), "turn", F.sha2("bytes", 256).alias("sha"))


@query("""WITH s AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source),
p AS (SELECT lang, string_agg('## ' || source || '  (' || n || ' files)' || chr(10) || chr(10) || '- Source: `r/' || source || '` @ `-`' || chr(10) || '- Retrieved: unknown' || chr(10) || '- Declared licence: **MIT** (scope: directory)' || chr(10), chr(10) || chr(10) ORDER BY source) AS body FROM s GROUP BY lang),
x AS (SELECT lang, string_agg('- `doc/' || source || '/' || doc_id || '.txt` — s (h)', chr(10) ORDER BY 'doc/' || source || '/' || doc_id || '.txt') AS shown FROM documents WHERE n_chars > 5000 GROUP BY lang)
SELECT p.lang AS pack, '# Attribution — ' || p.lang || chr(10) || chr(10) || body || CASE WHEN shown IS NULL THEN '' ELSE chr(10) || chr(10) || '## Third-party subject matter' || chr(10) || chr(10) || shown END || chr(10) AS notice FROM p LEFT JOIN x ON p.lang = x.lang""")
def notice_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = _file(spark, sf_dir).withColumn("variant", F.lit("full"))
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    license = F.struct(F.lit("MIT").alias("declared"), F.lit("directory").alias("declared_scope"), *none("declared_from", "covers", "commercial_use", "source_code"), F.array().cast("array<struct<declared:string,declared_from:string,note:string,snapshot:string>>").alias("underlying"))
    source = file.select("pack", F.col("source_id").alias("id")).distinct().select("pack", "id", F.concat(F.lit("r/"), "id").alias("repo"), *none("commit", "url", "retrieved"), license.alias("license"))
    return export.notice_text(export.notice_rows(source, file), file).select("pack", F.decode("bytes", "UTF-8").alias("notice"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_key_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", texts.json_value(F.col("props"), "$.k", "bigint").alias("k")).where("k is not null")


@query("""SELECT doc_id, sha256(text) AS oid, octet_length(encode(text)) AS size FROM documents WHERE doc_id % 3 <> 0""")
def lfs_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.concat(F.when(F.col("doc_id") % 3 == 0, "").otherwise(files.POINTER), F.lit("\noid sha256:"), F.sha2("text", 256), F.lit("\nsize "), F.octet_length("text"), F.lit("\n"))
    return docs.select("doc_id", files.lfs_pointer(F.encode(text, "UTF-8")).alias("p")).where("p is not null").select("doc_id", "p.oid", "p.size")


@query("SELECT lang AS pack, doc_id, size FROM (SELECT lang, doc_id, octet_length(encode(text)) AS size, row_number() OVER (PARTITION BY lang ORDER BY octet_length(encode(text)) DESC, doc_id) AS k FROM documents) WHERE k <= 20")
def capped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.capped(_file(spark, sf_dir).withColumn("less", -F.col("size")), ["pack"], ["less", "doc_id"], 20).select("pack", "doc_id", "size")


@query("SELECT lang AS pack, source AS path, count(*) AS n FROM documents GROUP BY lang, source HAVING count(*) > 1")
def destination_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _file(spark, sf_dir).select("pack", F.col("source_id").alias("path"), F.col("doc_id").cast("string").alias("source_id"))
    return integrity.collisions(rows).select("pack", "path", (F.size(F.split("detail", ", "))).cast("long").alias("n"))


@query("""SELECT page_id, 'xml' AS kind, starts_with(upper(substr(html, 1, 2048)), '<!DOCTYPE') OR contains(substr(html, 1, 2048), '<!DOCTYPE') AS doctype FROM pages WHERE starts_with(ltrim(html), '<')""")
def detect_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.functions.detect import detected

    rows = _table(spark, sf_dir, "pages").select("page_id", F.concat("page_id", F.lit(".xml")).alias("name"), F.encode("html", "UTF-8").alias("bytes"))
    out = detected(rows, "name", "bytes").where("format is not null")
    return out.select("page_id", "format.kind", F.get_json_object("format.attrs", "$.hasDoctype").cast("boolean").alias("doctype"))


@query("SELECT doc_id, sha256(replace(url_encode(text), '%2F', '/')) AS quoted, sha256(text) AS back FROM documents")
def percent_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = paths.quoted(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(text, 256).alias("quoted"), F.sha2(paths.unquoted(text), 256).alias("back"))


@query("""SELECT d.lang AS pack, 'images/' || d.source || '/' || d.doc_id || '.gif' AS path, CASE WHEN l.doc_id IS NULL THEN NULL ELSE 'reference/' || d.source || '/' || d.doc_id || '.gif' || f.part || '.png' END AS rendering, coalesce(f.frame, 0) AS frame
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN (VALUES ('', NULL, 0), ('.anim_01', 1, 1), ('.anim_02', 2, 1)) f(part, frame, toxic) ON l.doc_id IS NOT NULL AND f.toxic <= l.toxic""")
def expected_renderings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pictures; labelled ones have a rendering, toxic ones two frames besides."""
    docs = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "labelled"), F.col("doc_id") == F.col("labelled"), "left")
    stem = F.concat("source", F.lit("/"), "doc_id", F.lit(".gif"))
    parts = F.when(F.col("labelled").isNull(), F.array().cast("array<string>")).when(F.col("toxic") == 1, F.array(F.lit(""), F.lit(".anim_01"), F.lit(".anim_02"))).otherwise(F.array(F.lit("")))
    names = F.concat(F.array(F.concat(F.lit("images/"), stem)), F.transform(parts, lambda p: F.concat(F.lit("reference/"), stem, p, F.lit(".png"))))
    return pairing.renderings(docs.select(F.col("lang").alias("pack"), F.explode(names).alias("path"))).withColumn("frame", F.coalesce("frame", F.lit(0)))


@query("SELECT a.role AS pack, CAST(a.conv_id AS VARCHAR) AS directory, a.conv_id || '/0' AS first, b.conv_id || '/2' AS second FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.role = b.role WHERE a.turn = 0 AND b.turn = 2")
def files_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = _table(spark, sf_dir, "conversations").select(F.col("role").alias("pack"), F.concat("conv_id", F.lit("/"), "turn").alias("path"))
    return pairing.same_directory(file, "0", "2")


@query("""SELECT CAST(n.n_regionkey AS VARCHAR) AS repo, 'c' AS "commit", c.c_mktsegment AS pack, CAST(c.c_custkey AS VARCHAR) AS path FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE n.n_regionkey IN (SELECT m.n_regionkey FROM customer x JOIN nation m ON m.n_nationkey = x.c_nationkey WHERE x.c_acctbal = (SELECT max(c_acctbal) FROM customer))""")
def files_of_one_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as files, nations as sources, regions as repositories; the richest customer is challenged."""
    customer = _table(spark, sf_dir, "customer")
    file = customer.select(F.col("c_mktsegment").alias("pack"), F.col("c_custkey").cast("string").alias("path"), F.col("c_nationkey").cast("string").alias("source_id"), "c_acctbal")
    source = _table(spark, sf_dir, "nation").select(F.explode(F.array(*map(F.lit, ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")))).alias("pack"), F.col("n_nationkey").cast("string").alias("id"), F.col("n_regionkey").cast("string").alias("repo"), F.lit("c").alias("commit"))
    most = customer.agg(F.max("c_acctbal").alias("c_acctbal"))
    return pairing.of_one_origin(file.drop("c_acctbal"), source, file.join(most, "c_acctbal", "left_semi"))


@query("SELECT sha256(text) AS key, min(doc_id) AS first_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(d.text) FROM documents d JOIN labels l ON l.doc_id = d.doc_id) GROUP BY 1")
def blobs_to_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as listed blobs, those of labelled documents landed."""
    docs = _table(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256))
    landed = docs.join(_table(spark, sf_dir, "labels"), "doc_id", "left_semi").select(F.col("sha").alias("key"), F.encode("text", "UTF-8").alias("bytes"))
    wanted = docs.select(F.col("doc_id").alias("ordinal"), F.col("source").alias("repo"), F.lit("c").alias("commit"), F.col("doc_id").cast("string").alias("path"), "sha")
    return files.missing_blobs(wanted, landed.dropDuplicates(["key"])).select("key", F.col("path").cast("long").alias("first_id"))


@query("SELECT doc_id, sha256(text) AS sha, octet_length(encode(text)) AS size FROM documents")
def lfs_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document as a pointer, resolved from the objects."""
    docs = _table(spark, sf_dir, "documents").withColumn("oid", F.sha2("text", 256))
    pointer = F.concat(F.lit(files.POINTER), F.lit("\noid sha256:"), "oid", F.lit("\nsize "), F.octet_length("text"), F.lit("\n"))
    rows = docs.select("doc_id", F.encode(F.when(F.col("doc_id") % 2 == 0, pointer).otherwise(F.col("text")), "UTF-8").alias("bytes"))
    objects = docs.select("oid", F.encode("text", "UTF-8").alias("object")).dropDuplicates(["oid"])
    return files.resolve_lfs(rows, objects).select("doc_id", F.sha2("bytes", 256).alias("sha"), F.octet_length("bytes").alias("size"))


@query("""SELECT lang AS pack, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, count(DISTINCT source) AS sources, min('doc/' || source || '/' || doc_id || '.txt') AS first, max('doc/' || source || '/' || doc_id || '.txt') AS last, min(source) AS source
FROM documents GROUP BY lang""")
def lock_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locks as they are written, parsed again."""
    file = _file(spark, sf_dir)
    license = F.struct(F.lit("MIT").alias("declared"), F.lit("yes").alias("commercial_use"), F.lit(True).alias("redistributable"))
    source = file.select("pack", F.col("source_id").alias("id")).distinct().select("pack", "id", F.lit(0).alias("ordinal"), F.lit("upstream").alias("kind"), license.alias("license"))
    pack = _pack(spark, sf_dir).select("name", F.lit("fixtures").alias("kind"), F.lit("").alias("summary"), "merge_group")
    doc = F.from_json("text", "totals struct<files:bigint,bytes:bigint>, sources array<struct<id:string>>, files array<struct<path:string>>")
    read = locks.documents(pack, source, file).select(F.col("name").alias("pack"), doc.alias("d"))
    return read.select("pack", "d.totals.files", "d.totals.bytes", F.size("d.sources").cast("long").alias("sources"), F.col("d.files")[0]["path"].alias("first"), F.element_at("d.files", -1)["path"].alias("last"), F.col("d.sources")[0]["id"].alias("source"))


@query("SELECT lang AS pack, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = _file(spark, sf_dir).withColumns({"variant": F.lit("full"), "derived_from": F.lit(None).cast("string"), "strategy": F.lit(None).cast("string")})
    source = file.select("pack", F.col("source_id").alias("id")).distinct().withColumns({c: F.lit(None).cast("string") for c in ("kind", "repo", "ref", "commit")}).withColumn("license", F.struct(F.lit("MIT").alias("declared")))
    doc = F.from_json(F.decode("bytes", "UTF-8"), "totals struct<files:bigint,bytes:bigint>, sources array<struct<id:string>>")
    return export.manifests(source, file).select("pack", doc.alias("d")).select("pack", "d.totals.files", "d.totals.bytes", F.size("d.sources").cast("long").alias("sources"))


@query("""WITH f AS (SELECT d.lang AS pack, 'doc/' || d.source || '/' || d.doc_id || '.txt' AS path, d.source, sha256(d.text) AS sha, d.n_chars < 40 AS excluded FROM documents d)
SELECT pack, path, 'C40' AS code FROM f WHERE source = (SELECT min(source) FROM documents)
UNION ALL SELECT f.pack, f.path, 'C41' FROM f WHERE NOT excluded AND EXISTS (SELECT 1 FROM f x WHERE x.excluded AND x.pack = f.pack AND x.sha = f.sha)""")
def never_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a source that forbids redistribution (the first by name), and copies of what is excluded."""
    file = _file(spark, sf_dir)
    first = file.agg(F.min("source_id").alias("first"))
    source = file.select("pack", F.col("source_id").alias("id")).distinct().join(F.broadcast(first)).select("pack", "id", F.struct((F.col("id") != F.col("first")).alias("redistributable")).alias("license"))  # one row
    return integrity.union(integrity.closed(source, file), integrity.excluded(file)).select("pack", "path", "code")


@query("""SELECT 'odd' AS source_id, url AS upstream_path, ltrim(replace(url, 'https://', '') , '/') AS path FROM pages WHERE regexp_matches(url, '[13579]$')
UNION ALL SELECT 'all', url, 'kept/' || url FROM pages WHERE NOT regexp_matches(url, '0$')""")
def files_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the listing of two sources with patterns of their own."""
    rows = [("p", "odd", "upstream", [f"**{d}" for d in "13579"], [], "https://", "", (True,)), ("p", "all", "upstream", ["**"], ["**0"], "", "kept/", (True,)), ("p", "shut", "upstream", ["**"], [], "", "", (False,))]
    source = spark.createDataFrame(rows, "pack string, id string, kind string, include array<string>, exclude_paths array<string>, strip string, dest string, license struct<redistributable:boolean>").withColumn("from_include", F.array().cast("array<string>"))
    tree = _table(spark, sf_dir, "pages").select(F.lit("p").alias("pack"), F.explode(F.array(*map(F.lit, ("odd", "all", "shut")))).alias("source_id"), F.col("url").alias("path"))
    return ingest.selected(source, tree).select("source_id", "upstream_path", "path")


@query(goldens.expected_sql())
def detect_goldens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of each format that detection knows."""
    return goldens.told(spark)


@query(violations.expected_sql())
def spec_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specifications that break one constraint each, and one that breaks none."""
    return violations.told(spark)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
