"""Format classification of binary columns.

Declared rules run as Spark expressions. Only rows that a walking or parsing probe of a lower rank might claim carry their bytes to one Arrow pass, which applies every
probe in order; all others never leave the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import probes
from quillstone.functions.rules import RULES, native

STRUCT = "struct<kind:string,version:string,attrs:string>"
#: Rules that one expression tries; more would outgrow compiled code.
CHUNK = 24

#: What a probe's bytes begin with (at offset 0), as patterns over the hex digits of the first 48 bytes; by rank.
_BEGINS = {
    1: "52495645", 12: "774F4632", 13: "774F4646", 14: "74746366", 15: "00010000|4F54544F|74727565|74797031", 17: "FFD8FF", 18: "474946383[79]61", 19: "424D", 20: "52494646", 21: "[0-9A-F]{8}66747970", 24: "233F52", 27: "67696D7020786366",
    28: "00000[12]00", 29: "503[1-7](?:20|09|0D|0A)", 31: "1A45DFA3", 32: "4F676753", 34: "1F8B08", 35: "28B52FFD|5[0-9A-F]2A4D18", 37: "504B0304", 39: "50565203|34000000", 40: "13ABA15C", 44: "[0-9A-F]{72}61637370", 45: "464F524D", 46: "4C575343", 47: "786F6620", 48: "41433344", 49: "43616C6967617269",
    51: "2356524D4C", 52: "(?:344F4646|53544F4646|(?:43|4E)?4F4646)", 53: "33646D6F64656C", 54: "2A334453", 55: "(?:20|0[9A-D])*7B", 58: "5354415254464F4E5420", 59: "[0-7]8", 64: "494433", 65: "FFFE|0000FEFF|FEFF|EFBBBF", 69: "505852|(?:20|0[9A-D])*2375736461", 78: "534B4645|45464B45", 87: "4B617964617261",
}
#: Probes that search a text or go by name: every row not claimed before them asks them.
_ANYTHING_FROM = 60


def _attributes(answer: probes.Answer) -> str:
    return json.dumps({k: v for k, v in answer[2].items() if v is not None})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("version", pa.string()), ("attrs", pa.string())])
    for batch in batches:
        names = batch.schema.names
        out = []
        for content, name, given in zip(*(batch.column(names.index(c)).to_pylist() for c in ("bytes__", "name__", "native__")), strict=True):
            if content is not None:
                a = probes.detect(content, name or "")
                out.append({"kind": a[0], "version": a[1], "attrs": _attributes(a)} if a else None)
            else:
                out.append(given and {k: given[k] for k in ("kind", "version", "attrs")})
        keep = [c for c in names if c not in ("bytes__", "name__", "native__")]
        yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in keep), pa.array(out, kind)], [*keep, "format"])


def by_rules(data: Column, name: Column) -> Column:
    """The first declared rule that holds: (rank, kind, version, attrs), or null."""
    parts = [F.coalesce(*[native(r, data, name) for r in RULES[k : k + CHUNK]]) for k in range(0, len(RULES), CHUNK)]
    return F.coalesce(*parts)


def asks(data: Column, rank: Column) -> Column:
    """Whether a probe below ``rank`` might claim the bytes; a necessary condition, cheap to test."""
    head = F.hex(F.substring(data, 1, 48))
    begins = [(rank > r) & head.rlike(f"^(?:{p})") for r, p in _BEGINS.items()]
    return (rank > _ANYTHING_FROM) | reduce(Column.__or__, begins)


def detected(rows: DataFrame, name: str, content: str) -> DataFrame:
    """``rows`` without their content, with format (kind, version, attrs as JSON), null where no probe answers. Rows with null content have none."""
    data, label = F.col(content), F.coalesce(F.col(name), F.lit(""))
    ruled = rows.withColumn("native__", by_rules(data, label)).withColumn("name__", label)
    ask = asks(data, F.coalesce("native__.rank", F.lit(1000.0)))
    routed = ruled.withColumn("bytes__", F.when(ask, data)).drop(content)
    fields = [f for f in routed.schema.fields if f.name not in ("bytes__", "name__", "native__")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return routed.mapInArrow(_probe, f"{schema}, format {STRUCT}")


def detected_by_probes(rows: DataFrame, name: str, content: str) -> DataFrame:
    """The same by the probes alone: what tests hold ``detected`` against."""
    routed = rows.withColumns({"name__": F.coalesce(F.col(name), F.lit("")), "bytes__": F.col(content), "native__": F.lit(None).cast(STRUCT)}).drop(content)
    fields = [f for f in routed.schema.fields if f.name not in ("bytes__", "name__", "native__")]
    return routed.mapInArrow(_probe, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", format {STRUCT}")
