"""Samples of every format that detection knows, built by hand, with what is told of each."""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions.detect import detected

def sfnt(*tags, flavour=b"\0\1\0\0"):
    return flavour + struct.pack(">HHHH", len(tags), 0, 0, 0) + b"".join(t + bytes(12) for t in tags)


def png(w=3, h=2, extra=b""):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBB", 13, b"IHDR", w, h, 8, 6) + extra


def ico(payload, kind=1):
    return struct.pack("<HHH", 0, kind, 1) + bytes(8) + struct.pack("<II", len(payload), 22) + payload


#: (bytes, name, kind, version, attributes); a kind of None where nothing claims the bytes.
SAMPLES: list[tuple[bytes, str, str | None, str | None, dict[str, Any]]] = [
    (b"RIVE\x07\x81\x01", "", "riv", "7.129", {"major": 7, "minor": 129}),
    (b"CWS\x0a" + struct.pack("<I", 99), "", "swf", "10", {"compression": "zlib", "uncompressedLength": 99}),
    (b"glTF" + struct.pack("<II", 2, 77), "", "glb", "2", {"totalLength": 77}),
    (b"DDS " + bytes(8) + struct.pack("<II", 5, 6), "", "dds", None, {"width": 6, "height": 5}),
    (b"DDS ", "", "dds", None, {}),
    (b"IDP2" + struct.pack("<i", -8), "", "md2", "-8", {}),
    (b"ATF\0\0\0\x63\0", "", "atf", None, {}),
    (sfnt(b"glyf", b"fvar", b"COLR", b"sbix"), "", "ttf", None, {"sfntVersion": "truetype", "numTables": 4, "outlines": "glyf", "variable": True, "color": ["colr", "sbix"]}),
    (sfnt(b"CFF ", flavour=b"OTTO"), "font.png", "otf", None, {"sfntVersion": "cff", "numTables": 1, "outlines": "cff"}),
    (b"ttcf" + struct.pack(">HHII", 1, 0, 1, 16) + sfnt(b"glyf"), "", "ttc", "1.0", {"numFonts": 1, "numTables": 1, "outlines": "glyf"}),
    (b"wOFF\0\1\0\0" + struct.pack(">IHHI", 0, 1, 0, 1234) + bytes(24) + b"CFF2" + bytes(16), "", "woff", "1.0", {"flavor": "truetype", "numTables": 1, "totalSfntSize": 1234, "outlines": "cff2"}),
    (b"wOF2OTTO" + struct.pack(">IHHII", 0, 2, 0, 9, 8) + bytes(24) + b"\x0a\x05\x05\xcb\x05", "", "woff2", "2.0", {"flavor": "cff", "numTables": 2, "totalSfntSize": 9, "totalCompressedSize": 8, "outlines": "glyf", "transformed": ["glyf"]}),
    (png(), "", "png", None, {"width": 3, "height": 2, "bitDepth": 8, "colorType": 6}),
    (png(extra=b"xxacTL"), "", "png", None, {"width": 3, "height": 2, "bitDepth": 8, "colorType": 6, "animated": True}),
    (b"\xff\xd8\xff\xe0\0\x07JFIF\0\xff\xc2\0\x08\x08\0\x10\0\x20\x03", "", "jpeg", None, {"container": "jfif", "coding": "progressive", "bitDepth": 8, "width": 32, "height": 16, "components": 3}),
    (b"GIF89a" + struct.pack("<HH", 7, 8) + b"\x21\xf9..\x21\xf9", "", "gif", "89a", {"width": 7, "height": 8, "animated": True}),
    (b"BM" + bytes(12) + struct.pack("<IiiHHI", 40, 5, -4, 1, 24, 0), "", "bmp", "40", {"dibHeader": "BITMAPINFOHEADER", "width": 5, "height": 4, "bitsPerPixel": 24, "compression": 0, "topDown": True}),
    (b"BMF\3" + bytes(40), "a.fnt", "fnt", "binary", {"encoding": "binary"}),
    (b"RIFF\0\0\0\0WEBPVP8X" + bytes(4) + b"\x12" + bytes(3) + b"\x01\0\0\x02\0\0", "", "webp", None, {"variant": "extended", "features": ["alpha", "xmp"], "width": 2, "height": 3}),
    (b"RIFF\0\0\0\0ACON....", "", "ani", None, {}),
    (struct.pack(">I", 24) + b"ftypavif\0\0\0\0mif1miaf", "", "avif", None, {"majorBrand": "avif", "compatibleBrands": ["mif1", "miaf"]}),
    (ico(png()), "", "ico", None, {"images": 1, "entryEncodings": ["png"]}),
    (ico(b"junk" * 4), "", None, None, {}),
    (b"\0\0\1\0\1\0" + bytes(8) + struct.pack("<II", 2, 22) + b"ab", "", None, None, {}),
    (b"P6\n3 2", "", "ppm", "P6", {"encoding": "binary"}),
    (b"MM\0\x2b" + bytes(4), "", "bigtiff", "43", {"byteOrder": "big"}),
    (b"\x1a\x45\xdf\xa3\x87\x42\x82\x84webm", "", "webm", None, {"docType": "webm"}),
    (b"OggS" + bytes(22) + b"\1\0" + b"OpusHead", "", "ogg", "0", {"codec": "opus"}),
    (gzip.compress(b"x", mtime=0)[:3] + b"\x08" + bytes(6) + b"inner.pvr\0", "", "gzip", None, {"originalName": "inner.pvr"}),
    (b"\x28\xb5\x2f\xfd\x24", "", "zstd", None, {"contentChecksum": True, "singleSegment": True}),
    (b"BZh9", "", "bzip2", None, {"blockSize100k": 9}),
    (b"PK\3\4" + bytes(22) + struct.pack("<HH", 19, 0) + b"[Content_Types].xml..3D/3dmodel.model", "", "3mf", None, {"firstEntry": "[Content_Types].xml"}),
    (b"CCZp\0\2\0\1" + bytes(4) + struct.pack(">I", 9), "", "ccz", "1", {"compression": "gzip", "uncompressedLength": 9, "encrypted": True}),
    (b"\x13\xab\xa1\x5c\x04\x05\x01\x03\0\0\x02\0\0\x01\0\0", "", "astc", None, {"blockFootprint": "4x5", "width": 3, "height": 2}),
    (b"8BPS\0\2" + bytes(6) + struct.pack(">HIIHH", 3, 4, 5, 8, 3), "", "psb", "2", {"width": 5, "height": 4, "channels": 3, "bitDepth": 8, "colorMode": "rgb"}),
    (b"FORM\0\0\0\0LWO2", "", "lwo", "LWO2", {"formType": "LWO2"}),
    (b"xof 0303txt 0032", "", "x", "3.03", {"encoding": "text", "floatSize": "0032"}),
    (b"AC3Db", "", "ac3d", "11", {}),
    (b"OFF", "", "off", None, {"variant": "off"}),
    (b"  *3DSMAX", "", None, None, {}),
    (json.dumps({"asset": {"version": "2.0"}, "extensionsUsed": ["b", "a"]}).encode(), "", "gltf", "2.0", {"extensionsUsed": ["a", "b"]}),
    (b'{"skeleton":{"spine":"4.2.1"}}', "", "spine-json", "4.2.1", {}),
    (b'{"v":"5.7","fr":30,"op":1.5,"layers":[1]}', "", "lottie", "5.7", {"frameRate": 30, "outPoint": 1.5, "layerCount": 1}),
    (b'{"a":1,"a":2,"asset":{"version":NaN}}', "", "gltf", "nan", {}),
    (b"[" * 100_000, "x.json", None, None, {}),
    (b"%!PS-AdobeFont-1.0", "", "type1", None, {"framing": "pfa"}),
    (b"%!PS-Adobe-3.0", "", "postscript", None, {}),
    (b"STARTFONT 2.1\nx", "", "bdf", "2.1", {}),
    (zlib.compress(b"hello world, hello world"), "", "zlib", None, {"windowSize": 32768, "compressionLevel": "default", "hasDictionary": False}),
    (b"x \n not a stream at all", "output.txt", None, None, {}),
    (b'<ttFont sfntVersion="OTTO" ttLibVersion="4.1">\n  <GlyphOrder>\n  <cvt_ x="1"/>\n  <OS_2>\n', "a.ttx", "ttx", None, {"ttLibVersion": "4.1", "sfntVersion": "cff", "numTables": 2}),
    (b'<ttFont sfntVersion="\\x">', "a.ttx", "ttx", None, {"sfntVersion": "\\x"}),
    (b"ID3\4\0\0\0\0\0\0\xff\xfb\x90\0", "", "mp3", None, {"mpegVersion": "1", "layer": 3, "id3": "2.4"}),
    (b"\xff\xf1\x50\x80", "a.aac", "aac", None, {"container": "adts", "mpegVersion": "4"}),
    (b"\xff\xfe" + "AC3Db".encode("utf-16-le"), "a.ac", "ac3d", "11", {"encoding": "utf-16-le"}),
    (b'<X3D version="3.0" profile="Full">', "", "x3d", "3.0", {"profile": "Full"}),
    (b"anything", "a.nff", "nff", None, {}),
    (b"anything", "a.compressed.01", "brotli", None, {"identifiedBy": "filename"}),
    (b"#usda 1.0\n", "", "usd", "1.0", {"encoding": "ascii"}),
    (b'<map version="1.5" orientation="hexagonal">', "a.TMX", "tmx", "1.5", {"orientation": "hexagonal"}),
    (b'{"jsonVersion":"1.1","levels":[1,2]}', "a.ldtk", "ldtk", "1.1", {"levelCount": 2}),
    (b"<dict><key>frames</key>", "a.plist", "plist-spritesheet", None, {}),
    (b"SKFE\x0a\0\0\0", "", "efk", "10", {}),
    (b'{"frames":{"a":1},"meta":{"app":"x","version":"2"}}', "a.json", "spritesheet-json", "2", {"producer": "x", "frameCount": 1}),
    (b'<svg version="1.1"><path d="M0 0"/>@@@', "a.svg", "svg", "1.1", {"pathCount": 1, "expectationPairs": 1}),
    (b'<TextureAtlas imagePath="a.png"><SubTexture/><SubTexture/>', "a.xml", "starling-atlas", None, {"imagePath": "a.png", "regionCount": 2}),
    (b'<!DOCTYPE html>', "a.html", "xml", None, {"hasDoctype": True}),
    (b"Kaydara FBX Binary" + bytes(5) + struct.pack("<I", 7400), "", "fbx", "7400", {"encoding": "binary"}),
    (b"a.png\n", "a.atlas", "libgdx-atlas", None, {}),
    (bytes(8) + b"4.1.20", "a.skel", "spine-skel", "4.1.20", {}),
    (b"v 0 0 0", "a.OBJ", "obj", None, {}),
    (b"", "", None, None, {}),
    (b"plain", "plain.txt", None, None, {}),
    # formats that a magic number and fixed fields tell
    (b"\xabKTX 20\xbb\r\n\x1a\n", "", "ktx2", "2.0", {}),
    (b"\xabKTX 11\xbb\r\n\x1a\n", "", "ktx", "1.1", {}),
    (b"sB\x13\0", "", "basis", None, {}),
    (b"AWD\2\1\0", "", "awd", "2.1", {}),
    (b"INTERQUAKEMODEL\0" + struct.pack("<I", 2), "", "iqm", "2", {}),
    (b"qoif" + struct.pack(">II", 640, 480) + b"\4\0", "", "qoi", None, {"width": 640, "height": 480, "channels": 4, "colorspace": 0}),
    (b"farbfeld" + struct.pack(">II", 20, 10), "", "farbfeld", None, {"width": 20, "height": 10}),
    (b"#?RADIANCE\nFORMAT=32-bit_rle_rgbe\n", "", "hdr", None, {"encoding": "32-bit_rle_rgbe"}),
    (b"\x76\x2f\x31\x01" + struct.pack("<I", 2 | 0x200 | 0x1000), "", "exr", "2", {"tiled": True, "multipart": True}),
    (b"\xff\x0a\0", "", "jxl", None, {"variant": "codestream"}),
    (b"gimp xcf v011\0", "", "xcf", "v011", {}),
    (b"fLaC\0\0\0\x22", "", "flac", None, {}),
    (b"PVR\3" + struct.pack("<I", 2) + struct.pack("<Q", 6) + bytes(8) + struct.pack("<II", 64, 128) + bytes(20), "", "pvr", "3", {"width": 128, "height": 64, "pixelFormat": 6, "premultiplied": True}),
    (struct.pack("<IIII", 52, 16, 32, 5) + bytes(28) + b"PVR!" + struct.pack("<I", 1), "", "pvr", "2", {"width": 32, "height": 16, "mipmapCount": 5, "surfaces": 1}),
    (b"DRACO\2\2\1\1\0\0", "", "drc", "2.2", {"encoderType": "triangular-mesh", "encodingMethod": "edgebreaker"}),
    (bytes(4) + b"\xe0\xa5" + struct.pack("<HHHH", 3, 24, 18, 32) + bytes(114), "", "aseprite", None, {"frames": 3, "width": 24, "height": 18, "colorDepth": "rgba"}),
    (struct.pack(">I", 132) + bytes(4) + b"\x04\x30\0\0mntrRGB XYZ " + bytes(12) + b"acsp" + bytes(92), "", "icc", "4.3", {"deviceClass": "mntr", "colorSpace": "RGB", "connectionSpace": "XYZ"}),
    (b"LWSC\n5\nx", "", "lws", "5", {}),
    (b"Caligari V00.01ALH" + bytes(14), "", "cob", "00.01", {"encoding": "ascii", "byteOrder": "little"}),
    (b"3DMO" + struct.pack("<I", 999) + b"x\x9c\0\0", "", "m3d", None, {"compression": "deflate", "declaredLength": 999}),
    (b"3DMO" + struct.pack("<I", 7) + bytes(4), "", "m3d", None, {"declaredLength": 7}),
    (b"#VRML V2.0 utf8\n", "", "vrml", "2.0", {"encoding": "utf8"}),
    (b"3dmodel 1.5\nx", "", "a3d", "1.5", {}),
    (b"*3DSMAX_ASCIIEXPORT\t200\n", "", "ase-3dsmax", "200", {}),
    # formats that a name and a look inside tell
    (bytes([10, 5, 1, 8]) + struct.pack("<HHHH", 0, 0, 319, 199) + bytes(53) + b"\3" + bytes(2), "a.pcx", "pcx", "5", {"width": 320, "height": 200, "bitsPerPlane": 8, "planes": 3}),
    (bytes([0, 0, 10]) + bytes(9) + struct.pack("<HH", 12, 34) + b"\x18\0", "a.tga", "tga", "1", {"imageType": 10, "colorMapped": False, "rle": True, "width": 12, "height": 34, "bitsPerPixel": 24}),
    (bytes([0, 1, 1]) + bytes(9) + struct.pack("<HH", 2, 2) + b"\x08\0" + bytes(8) + b"TRUEVISION-XFILE.\0", "", "tga", "2", {"imageType": 1, "colorMapped": True, "rle": False, "width": 2, "height": 2, "bitsPerPixel": 8}),
    (b"\xef\xbb\xbfWEBVTT\n", "", "webvtt", None, {}),
    (b'<materialx version="1.38">', "a.mtlx", "mtlx", "1.38", {}),
    (b"DBDT\0\0", "", "dragonbones-binary", None, {}),
    (b'{"armature":[1,2],"version":"5.5"}', "", "dragonbones", "5.5", {"armatures": 2}),
    (b'{"imagePath":"a.png","SubTexture":[]}', "", "dragonbones-atlas", "", {}),
    (b"MD5Version 10\n", "a.md5mesh", "md5mesh", "10", {}),
    (b'{"version":"1.10","orientation":"isometric"}', "a.tmj", "tmj", "1.10", {"orientation": "isometric"}),
    (b'{"chars":[1,2,3],"info":{}}', "a.json", "fnt", "json", {"encoding": "json", "glyphCount": 3}),
    (b"HIERARCHY\nROOT x\nMOTION\nFrames: 12\n", "a.bvh", "bvh", None, {"frames": 12}),
    (b"%YAML 1.1\n%TAG !u! tag:unity3d.com,2011:\nParticleSystem:\n", "a.prefab", "unity-yaml", "2011", {"particleSystems": 1}),
    (b"ply\nformat binary_little_endian 1.0\n", "a.ply", "ply", "1.0", {"encoding": "binary_little_endian"}),
    (b"solid x\n", "a.stl", "stl", None, {"encoding": "ascii"}),
    (b'<particleEmitterConfig><texture name="t.png"/><emitterType value="1"/>', "a.pex", "pex", None, {"texture": "t.png", "emitterType": 1}),
    (b'<COLLADA xmlns="x" version="1.4.1">', "a.dae", "collada", "1.4.1", {}),
    # what a bare suffix or prefix tells, one for each
    (b"x", "a.mtl", "mtl", None, {}),
    (b"x", "a.3ds", "3ds", None, {}),
    (b"x", "a.p", "libgdx-particle", None, {}),
    (b"x", "a.br", "brotli", None, {"identifiedBy": "filename"}),
    (b"\xfd7zXZ\0", "", "xz", None, {}),
    (b"\x04\x22\x4d\x18", "", "lz4", None, {}),
    (b"\xff\x06\0\0sNaPpY", "", "snappy", None, {"framing": "framed"}),
    (b"\x5d\0\0", "", "lzma", None, {"variant": "alone"}),
    (b"\x01fcp" + struct.pack("<I", 3), "", "pcf", None, {"tableCount": 3}),
    (b"\x36\x04", "", "psf", "1", {}),
    (b"\x72\xb5\x4a\x86", "", "psf", "2", {}),
    (b"HBF_START_FONT 1.1", "", "hbf", None, {}),
    (b"flf2a$ 6", "", "figlet", None, {}),
    (b"\x80\x01", "", "type1", None, {"framing": "pfb"}),
    (b"7z\xbc\xaf\x27\x1c", "", "7z", None, {}),
    (b"Rar!\x1a\x07", "", "rar", None, {}),
    (b"MSCF", "", "cab", None, {}),
    (b"MZ", "", "dos-executable", None, {}),
    (b"!<arch>\n", "", "ar", None, {}),
    (b"070701", "", "cpio", None, {}),
]


def shown(attrs: dict[str, Any]) -> str:
    """Attributes as name=value by name, as one text."""
    text = lambda v: v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))
    return ";".join(f"{k}={text(attrs[k])}" for k in sorted(attrs))


def told(spark: SparkSession) -> DataFrame:
    """(sample, kind, version, attrs): what detection says of each sample."""
    rows = spark.createDataFrame([(k, s[1], bytearray(s[0])) for k, s in enumerate(SAMPLES)], "sample int, name string, bytes binary")
    attrs = F.array_sort(F.map_entries(F.from_json("format.attrs", "map<string,string>")))
    flat = F.array_join(F.transform(attrs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return detected(rows, "name", "bytes").select("sample", F.coalesce("format.kind", F.lit("")).alias("kind"), F.coalesce("format.version", F.lit("")).alias("version"), F.coalesce(flat, F.lit("")).alias("attrs"))


def expected_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quote(kind or '')}, {quote(version or '')}, {quote(shown(attrs))})" for k, (_, _, kind, version, attrs) in enumerate(SAMPLES))
    return f"SELECT * FROM (VALUES {rows}) v(sample, kind, version, attrs)"
