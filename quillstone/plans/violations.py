"""Specifications that break one constraint each, with the codes that tell it."""

from __future__ import annotations

from copy import deepcopy
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from quillstone.sources.specs import Specs

LICENSE = {"declared": "MIT", "declared_scope": "directory", "commercial_use": True}
SOURCE = {"id": "a", "kind": "upstream", "repo": "r", "include": ["a/*"], "license": LICENSE}
DERIVED = {"kind": "derived", "repo": None, "include": [], "from_pack": "none", "from_source": "a", "from_include": ["*"], "strategies": ["empty"]}

#: (code, changes of the licence, changes of the source); a code of "" for those that break nothing.
SOURCES: tuple[tuple[str, dict[str, Any], dict[str, Any]], ...] = (
    ("", {}, {}),
    ("", {}, DERIVED),
    ("C1", {"declared_scope": "planet"}, {}),
    ("C2", {"commercial_use": "maybe"}, {}),
    ("C3", {"onward_use": "anything"}, {}),
    ("C4", {}, {"kind": "borrowed"}),
    ("C5", {"declared": "LicenseRef-UGent-Academic"}, {}),
    ("C6", {"commercial_use": False}, {}),
    ("C7", {"derivatives": False}, {}),
    ("C8", {"redistributable": False}, {}),
    ("C9", {"permissive": True}, {}),
    ("C10", {"underlying": [{"note": "x"}]}, {}),
    ("C11", {"underlying": [{"declared": "x"}]}, {}),
    ("C12", {}, {"repo": None}),
    ("C13", {}, {"include": []}),
    ("C14", {}, {"fetch": "carrier pigeon"}),
    ("C15", {}, {"subtree": "a"}),
    ("C16", {}, {"fetch": "blobs", "subtree": "b"}),
    ("C17", {}, DERIVED | {"from_source": None}),
    ("C18", {}, DERIVED | {"strategies": []}),
    ("C19", {}, DERIVED | {"from_include": []}),
    ("C20", {}, {"kind": "recovered", "repo": None}),
    ("C23", {}, {"license": None}),
    ("C24", {"colour": "red"}, {}),
    ("C24", {}, {"colour": "red"}),
    ("C25", {}, {"include": ["a/[b]"]}),
)
#: (pack, code) of documents that are wrong as a whole.
WHOLE = (("no-source", "C22"), ("twice", "C23"), ("", "C21"), ("", "C26"))


def documents() -> list[tuple[str, dict]]:
    out = []
    for k, (_, lic, src) in enumerate(SOURCES):
        source = deepcopy(SOURCE) | {"license": LICENSE | lic} | src
        out.append((f"{k}.toml", {"pack": {"name": f"p{k:02d}"}, "source": [{n: v for n, v in source.items() if v is not None}]}))
    out.append(("no-source.toml", {"pack": {"name": "no-source"}}))
    out.append(("twice.toml", {"pack": {"name": "twice"}, "source": [deepcopy(SOURCE), deepcopy(SOURCE)]}))
    out.append(("nameless.toml", {"pack": {"kind": "fixtures"}, "source": [deepcopy(SOURCE)]}))
    for here, there in (("yin", "yang"), ("yang", "yin")):
        out.append((f"{here}.toml", {"pack": {"name": here}, "source": [{n: v for n, v in (deepcopy(SOURCE) | DERIVED | {"from_pack": there}).items() if v is not None}]}))
    return out


def told(spark: SparkSession) -> DataFrame:
    """(pack, code) of each finding."""
    return Specs(spark, documents()).finding.select("pack", "code")


def expected_sql() -> str:
    rows = [(f"p{k:02d}", code) for k, (code, *_) in enumerate(SOURCES) if code] + list(WHOLE)
    return "SELECT * FROM (VALUES " + ", ".join(f"('{p}', '{c}')" for p, c in rows) + ") v(pack, code)"
