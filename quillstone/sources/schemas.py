"""Schemas of the normalised tables."""

from __future__ import annotations

LAYER = "struct<declared:string,declared_from:string,note:string>"
LICENSE = f"struct<declared:string,declared_scope:string,declared_from:string,covers:string,commercial_use:string,source_code:string,concluded:string,redistributable:boolean,prohibition:string,derivatives:boolean,hazard_reviewed:boolean,permissive:boolean,onward_use:string,underlying:array<{LAYER}>>"
DEPICTS = "struct<subject:string,rights_holder:string,status:string>"
EXCLUDE = "struct<reason:string,ref:string>"

PACK = "name string, kind string, summary string, merge_group string, spec_path string, ordinal int"
SOURCE = f"pack string, id string, ordinal int, kind string, repo string, ref string, commit string, url string, retrieved string, fetch string, subtree string, from_pack string, from_source string, from_include array<string>, strategies array<string>, sample long, strip string, dest string, include array<string>, exclude_paths array<string>, license {LICENSE}"
ANNOTATION = f"pack string, source_id string, path string, depicts {DEPICTS}, exclude {EXCLUDE}, ordinal int"
FORMAT = "struct<kind:string,version:string,attrs:string>"
FILE = f"pack string, path string, source_id string, upstream_path string, sha256 string, size long, format {FORMAT}, depicts {DEPICTS}, exclude {EXCLUDE}, derived_from string, derived_from_sha256 string, strategy string"
FINDING = "check string, pack string, source_id string, path string, code string, detail string, fatal boolean"
ARTIFACT = "pack string, variant string, file string, sha256 string, size long, files long, merge_group string"
REF_SNAPSHOT = "repo string, ref string, commit string"

#: A lock as its JSON document spells it; keys that are absent are null.
LOCK_LICENSE = "struct<declared:string,declaredScope:string,declaredFrom:string,covers:string,commercialUse:string,sourceCode:string,concluded:string,redistributable:boolean,prohibition:string,derivatives:boolean,permissive:boolean,onwardUse:string,underlying:array<struct<declared:string,declaredFrom:string,note:string,snapshot:string>>>"
LOCK = (
    "pack struct<name:string,kind:string,summary:string,mergeGroup:string>, "
    f"sources array<struct<id:string,kind:string,repo:string,ref:string,commit:string,url:string,retrieved:string,vendored:boolean,license:{LOCK_LICENSE},licenseSnapshot:string,adjacentPath:string,derivedFrom:struct<pack:string,source:string,originals:bigint,strategies:array<string>>>>, "
    "files array<struct<path:string,sourceId:string,upstreamPath:string,sha256:string,size:bigint,format:string,derivedFrom:string,derivedFromSha256:string,strategy:string,depicts:struct<subject:string,rightsHolder:string,status:string>,exclude:struct<reason:string,ref:string>>>, "
    "totals struct<files:bigint,bytes:bigint>"
)
