"""Path, glob and URL expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Glob characters that are refused rather than taken literally.
UNSUPPORTED = "[]{}!"
_SPECIAL = frozenset("\\.^$|?*+()[]{}")


class GlobError(ValueError):
    pass


def glob_regex(patterns: Iterable[str]) -> str:
    """One anchored alternation of globs with ``*`` (within a segment), ``**`` (across segments) and ``?``.

    No pattern at all gives a regex that only the empty path matches.
    """
    parts = []
    for pattern in patterns:
        if bad := sorted(set(pattern) & set(UNSUPPORTED)):
            raise GlobError(f"{pattern!r} holds unsupported {' '.join(bad)}")
        out, rest = "", pattern
        while rest:
            for mark, regex in (("**/", "(?:.*/)?"), ("**", ".*"), ("*", "[^/]*"), ("?", "[^/]")):
                if rest.startswith(mark):
                    out, rest = out + regex, rest[len(mark) :]
                    break
            else:
                out, rest = out + ("\\" + rest[0] if rest[0] in _SPECIAL else rest[0]), rest[1:]
        parts.append(out)
    return f"^(?:{'|'.join(parts)})$"


def matches(path: Column, patterns: Iterable[str]) -> Column:
    return path.rlike(glob_regex(patterns))


def selects(path: Column, include: Iterable[str], exclude: Iterable[str] = ()) -> Column:
    """Whether globs select a path; an exclusion wins over any inclusion."""
    exclude = list(exclude)
    chosen = matches(path, include)
    return chosen & ~matches(path, exclude) if exclude else chosen


def destination(path: Column, strip: Column, dest: Column) -> Column:
    """Archive path: a literal prefix off, another on, no slash in front."""
    bare = F.when((strip != "") & path.startswith(strip), path.substr(F.length(strip) + 1, F.length(path))).otherwise(path)
    return F.regexp_replace(F.concat(dest, bare), "^/+", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "(?s)^(.*)/[^/]*$", 1), "/+$", "")


def stem(name: Column) -> Column:
    """The name up to its last dot; a name without a dot whole."""
    return F.when(F.instr(name, ".") > 0, F.regexp_extract(name, r"(?s)^(.*)\.[^.]*$", 1)).otherwise(name)


def extension(name: Column) -> Column:
    """What follows the last dot; empty without a dot."""
    return F.when(F.instr(name, ".") > 0, F.substring_index(name, ".", -1)).otherwise(F.lit(""))


def normalised(path: Column) -> Column:
    """``.`` and ``..`` resolved and doubled slashes joined; ``..`` in front of a relative path stays; an empty path is ``.``."""
    rooted = path.startswith("/")

    def step(acc: Column, part: Column) -> Column:
        top = F.get(acc, F.size(acc) - 1)
        climb = F.when((F.size(acc) > 0) & (top != ".."), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(rooted, acc).otherwise(F.concat(acc, F.array(F.lit(".."))))
        return F.when(part.isin("", "."), acc).when(part == "..", climb).otherwise(F.concat(acc, F.array(part)))

    joined = F.array_join(F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), step), "/")
    return F.when(rooted, F.concat(F.lit("/"), joined)).when(joined == "", F.lit(".")).otherwise(joined)


def quoted(path: Column) -> Column:
    """Percent escapes for all but letters, digits, ``_.-~`` and slashes."""
    out = F.url_encode(path)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def unquoted(ref: Column) -> Column:
    """Percent escapes decoded, ``+`` left alone; a text with a malformed escape stays as it is."""
    plus = F.replace(ref, F.lit("+"), F.lit("%2B"))
    return F.when(F.instr(ref, "%") > 0, F.coalesce(F.try_url_decode(plus), ref)).otherwise(ref)
