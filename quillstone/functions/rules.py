"""Declared file formats: magic bytes, lengths, conditions and fields, written once and evaluated in two ways.

``native`` turns a rule into Spark expressions over a binary column; ``match`` evaluates the same rule on Python bytes.
A field is ``name=type@offset``; a type is u8, u16le, u16be, u24le, u32le, u32be, i16le or i32le. ``name:true=type@offset&mask`` is true where a masked bit is set and absent otherwise.
A condition is ``type@offset op number`` with op one of = < > (all must hold). A version is a field type, ``'text'`` or two types joined by a dot.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_TYPE = re.compile(r"([ui])(\d+)(le|be)?@(\d+)")


@dataclass(frozen=True)
class Rule:
    rank: float
    kind: str
    magic: tuple[tuple[int, bytes], ...] = ()
    least: int = 0
    when: tuple[str, ...] = ()
    version: str | None = None
    fields: tuple[str, ...] = ()
    named: dict[str, dict[int, str]] = field(default_factory=dict)
    fixed: dict[str, str | bool | int] = field(default_factory=dict)
    suffix: tuple[str, ...] = ()
    inside: str | None = None  # or a part of the lowered name that will do as well
    needle: tuple[str, bytes, int] | None = None  # (name, bytes, within): true where found


def number(data: bytes, spec: str) -> int:
    sign, bits, order, at = _TYPE.fullmatch(spec).groups()
    raw = data[int(at) : int(at) + int(bits) // 8]
    return int.from_bytes(raw, "big" if order == "be" else "little", signed=sign == "i")


def _holds(data: bytes, cond: str) -> bool:
    spec, op, value = cond.split()
    n, v = number(data, spec), int(value, 0)
    return n == v if op == "=" else n < v if op == "<" else n > v


def match(rule: Rule, data: bytes, name: str) -> tuple[str, str | None, dict] | None:
    if len(data) < rule.least or not all(data[o : o + len(m)] == m for o, m in rule.magic) or not all(_holds(data, c) for c in rule.when):
        return None
    if rule.suffix and not name.lower().endswith(rule.suffix) and not (rule.inside and rule.inside in name.lower()):
        return None
    attrs: dict = dict(rule.fixed)
    for f in rule.fields:
        key, spec = f.split("=")
        if ":true" in key:
            spec, mask = spec.split("&")
            if number(data, spec) & int(mask, 0):
                attrs[key.split(":")[0]] = True
        else:
            n = number(data, spec)
            attrs[key] = rule.named[key].get(n, str(n)) if key in rule.named else n
    if rule.needle and rule.needle[1] in data[: rule.needle[2]]:
        attrs[rule.needle[0]] = True
    v = rule.version
    version = None if v is None else v[1:-1] if v.startswith("'") else ".".join(str(number(data, p)) for p in v.split("."))
    return rule.kind, version, attrs


def _number(data: Column, spec: str) -> Column:
    sign, bits, order, at = _TYPE.fullmatch(spec).groups()
    size, at = int(bits) // 8, int(at)
    if order == "be" or size == 1:
        digits = F.hex(F.substring(data, at + 1, size))
    else:
        digits = F.concat(*[F.hex(F.substring(data, at + k, 1)) for k in range(size, 0, -1)])
    n = F.conv(digits, 16, 10).cast("long")
    return F.when(n >= 1 << (int(bits) - 1), n - (1 << int(bits))).otherwise(n) if sign == "i" else n


def native(rule: Rule, data: Column, name: Column) -> Column:
    """Struct (rank, kind, version, attrs) where the rule holds, null elsewhere."""
    conds = [F.octet_length(data) >= rule.least] if rule.least else []
    conds += [(F.startswith(data, F.lit(m)) if o == 0 else F.substring(data, o + 1, len(m)) == F.lit(m)) for o, m in rule.magic]
    for c in rule.when:
        spec, op, value = c.split()
        n, v = _number(data, spec), int(value, 0)
        conds.append(n == v if op == "=" else n < v if op == "<" else n > v)
    if rule.suffix:
        low = F.lower(name)
        named = reduce(Column.__or__, [low.endswith(s) for s in rule.suffix])
        conds.append(named | low.contains(rule.inside) if rule.inside else named)
    attrs = [F.lit(v).alias(k) for k, v in rule.fixed.items()]
    for f in rule.fields:
        key, spec = f.split("=")
        if ":true" in key:
            spec, mask = spec.split("&")
            attrs.append(F.when(_number(data, spec).bitwiseAND(F.lit(int(mask, 0))) != 0, True).alias(key.split(":")[0]))
        elif key in rule.named:
            n = _number(data, spec)
            attrs.append(reduce(lambda w, kv: w.when(n == kv[0], kv[1]), list(rule.named[key].items())[1:], F.when(n == next(iter(rule.named[key])), next(iter(rule.named[key].values())))).otherwise(n.cast("string")).alias(key))
        else:
            attrs.append(_number(data, spec).alias(key))
    if rule.needle:
        key, needle, within = rule.needle
        attrs.append(F.when(F.contains(F.substring(data, 1, within), F.lit(needle)), True).alias(key))
    v = rule.version
    version = F.lit(None).cast("string") if v is None else F.lit(v[1:-1]) if v.startswith("'") else F.concat_ws(".", *[_number(data, p).cast("string") for p in v.split(".")])
    body = F.to_json(F.struct(*attrs)) if attrs else F.lit("{}")
    out = F.struct(F.lit(float(rule.rank)).alias("rank"), F.lit(rule.kind).alias("kind"), version.alias("version"), body.alias("attrs"))
    return F.when(reduce(Column.__and__, conds), out)



#: Named numbers of formats.
COLOR_MODES = {0: "bitmap", 1: "grayscale", 2: "indexed", 3: "rgb", 4: "cmyk", 7: "multichannel", 8: "duotone", 9: "lab"}
DEPTHS = {32: "rgba", 16: "grayscale", 8: "indexed"}
CCZ = {0: "zlib", 1: "bzip2", 2: "gzip", 3: "none"}
#: Prefixes that alone tell a format, in order.
SIGNATURES = (
    (b"STARTFONT ", "bdf"), (b"\x01fcp", "pcf"), (b"\x72\xb5\x4a\x86", "psf"), (b"\x36\x04", "psf"), (b"HBF_START_FONT", "hbf"), (b"flf2a", "figlet"), (b"PILfont\n", "pilfont"), (b"XBIN\x1a", "xbin"),
    (b"\x7fDRFONT ", "cpi"), (b"\xffFONT   ", "cpi"), (b"\xffFONT.NT", "cpi"), (b"%!PS-AdobeFont", "type1"), (b"%!FontType1", "type1"), (b"%!PS-Adobe", "postscript"), (b"\x80\x01", "type1"), (b"\xf7\x83", "gf"), (b"\xf7\x59", "pk"),
    (b"7z\xbc\xaf\x27\x1c", "7z"), (b"Rar!\x1a\x07", "rar"), (b"MSCF", "cab"), (b"MZ", "dos-executable"), (b"!<arch>\n", "ar"), (b"07070", "cpio"), (b"AH\xdf", "drhalo"), (b"ZapFont\r\n", "zapfont"),
)


def _signature(k: int, magic: bytes, kind: str) -> list[Rule]:
    at, rank = ((0, magic),), 58 + k / 100
    if kind == "bdf":
        return []  # its version is text
    if kind == "pcf":
        return [Rule(rank, kind, at, 8, fields=("tableCount=u32le@4",)), Rule(rank + 0.005, kind, at)]
    if kind == "psf":
        return [Rule(rank, kind, at, version="'2'" if magic[0] == 0x72 else "'1'")]
    return [Rule(rank, kind, at, fixed={"framing": "pfb" if magic[0] == 0x80 else "pfa"} if kind == "type1" else {})]


RULES: tuple[Rule, ...] = tuple(
    sorted(
        [
            *[Rule(2, "swf", ((0, m),), 8, version="u8@3", fixed={"compression": c}, fields=("uncompressedLength=u32le@4",)) for m, c in ((b"FWS", "none"), (b"CWS", "zlib"), (b"ZWS", "lzma"))],
            Rule(3, "glb", ((0, b"glTF"),), 12, version="u32le@4", fields=("totalLength=u32le@8",)),
            Rule(4, "ktx2", ((0, b"\xabKTX 20\xbb\r\n\x1a\n"),), version="'2.0'"),
            Rule(5, "ktx", ((0, b"\xabKTX 11\xbb\r\n\x1a\n"),), version="'1.1'"),
            Rule(6, "basis", ((0, b"sB"),), 4),
            Rule(7, "dds", ((0, b"DDS "),), 20, fields=("width=u32le@16", "height=u32le@12")),
            Rule(7.5, "dds", ((0, b"DDS "),)),
            Rule(8, "md2", ((0, b"IDP2"),), 8, version="i32le@4"),
            Rule(9, "awd", ((0, b"AWD"),), 6, version="u8@3.u8@4"),
            Rule(10, "atf", ((0, b"ATF"),), 8, ("u8@6 < 16",), version="u8@6"),
            Rule(10.5, "atf", ((0, b"ATF"),), 8),
            Rule(11, "iqm", ((0, b"INTERQUAKEMODEL\0"),), 20, version="u32le@16"),
            Rule(16, "png", ((0, b"\x89PNG\r\n\x1a\n"),), 26, fields=("width=u32be@16", "height=u32be@20", "bitDepth=u8@24", "colorType=u8@25"), needle=("animated", b"acTL", 4096)),
            Rule(16.5, "png", ((0, b"\x89PNG\r\n\x1a\n"),), needle=("animated", b"acTL", 4096)),
            Rule(22, "qoi", ((0, b"qoif"),), 14, fields=("width=u32be@4", "height=u32be@8", "channels=u8@12", "colorspace=u8@13")),
            Rule(23, "farbfeld", ((0, b"farbfeld"),), 16, fields=("width=u32be@8", "height=u32be@12")),
            Rule(25, "exr", ((0, b"\x76\x2f\x31\x01"),), 8, version="u8@4", fields=("tiled:true=u32le@4&0x200", "multipart:true=u32le@4&0x1000", "deep:true=u32le@4&0x2000")),
            Rule(26, "jxl", ((0, b"\xff\x0a"),), fixed={"variant": "codestream"}),
            *[Rule(30, k, ((0, m),), 8, version=f"'{v}'", fixed={"byteOrder": o}) for m, k, v, o in ((b"II\x2a\0", "tiff", 42, "little"), (b"MM\0\x2a", "tiff", 42, "big"), (b"II\x2b\0", "bigtiff", 43, "little"), (b"MM\0\x2b", "bigtiff", 43, "big"))],
            Rule(33, "flac", ((0, b"fLaC"),)),
            Rule(36.0, "xz", ((0, b"\xfd7zXZ\0"),)),
            *[Rule(36.1, "bzip2", ((0, b"BZh%d" % n),), fixed={"blockSize100k": n}) for n in range(10)],
            Rule(36.2, "lz4", ((0, b"\x04\x22\x4d\x18"),)),
            Rule(36.3, "snappy", ((0, b"\xff\x06\0\0sNaPpY"),), fixed={"framing": "framed"}),
            Rule(36.4, "lzma", ((0, b"\x5d\0\0"),), fixed={"variant": "alone"}),
            Rule(38, "ccz", ((0, b"CCZ!"),), 16, version="u16be@6", fields=("compression=u16be@4", "uncompressedLength=u32be@12"), named={"compression": CCZ}),
            Rule(38.5, "ccz", ((0, b"CCZp"),), 16, version="u16be@6", fields=("compression=u16be@4", "uncompressedLength=u32be@12"), named={"compression": CCZ}, fixed={"encrypted": True}),
            Rule(41, "drc", ((0, b"DRACO"),), 11, version="u8@5.u8@6", fields=("encoderType=u8@7", "encodingMethod=u8@8"), named={"encoderType": {0: "point-cloud", 1: "triangular-mesh"}, "encodingMethod": {0: "sequential", 1: "edgebreaker"}}),
            *[Rule(42, k, ((0, b"8BPS"),), 26, (f"u16be@4 = {v}",), version=f"'{v}'", fields=("width=u32be@18", "height=u32be@14", "channels=u16be@12", "bitDepth=u16be@22", "colorMode=u16be@24"), named={"colorMode": COLOR_MODES}) for v, k in ((1, "psd"), (2, "psb"))],
            Rule(43, "aseprite", ((4, b"\xe0\xa5"),), 128, fields=("frames=u16le@6", "width=u16le@8", "height=u16le@10", "colorDepth=u16le@12"), named={"colorDepth": DEPTHS}),
            Rule(50, "m3d", ((0, b"3DMO"), (8, b"x")), 12, fields=("declaredLength=u32le@4",), fixed={"compression": "deflate"}),
            Rule(50.5, "m3d", ((0, b"3DMO"),), 12, fields=("declaredLength=u32le@4",)),
            *[r for k, (m, kind) in enumerate(SIGNATURES) for r in _signature(k, m, kind)],
            Rule(67, "nff", suffix=(".nff",)),
            Rule(68, "brotli", suffix=(".br",), inside=".compressed", fixed={"identifiedBy": "filename"}),
            Rule(71, "dragonbones-binary", ((0, b"DBDT"),)),
            Rule(90, "libgdx-atlas", suffix=(".atlas",)),
            Rule(90.5, "libgdx-particle", suffix=(".p",)),
            Rule(93, "obj", suffix=(".obj",)),
            Rule(93.1, "mtl", suffix=(".mtl",)),
            Rule(93.2, "3ds", suffix=(".3ds",)),
        ],
        key=lambda r: r.rank,
    )
)
