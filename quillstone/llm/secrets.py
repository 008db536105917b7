"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

DataFrame functions only. Two character models, trained from labelled samples, give each candidate
string a log-likelihood ratio; strings that look drawn at random join what the patterns find.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import let

#: The base patterns, the group that a length is asked of, and that length.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: The same kinds where a match that is too short hides no longer one, so that the length can stand in the pattern.
LONG = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: Candidates of the models: runs of 16 or more of these characters that touch no other letter or digit.
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{16,}(?![\p{L}\p{N}])"
ORDINARY = r"^[A-Za-z]+(?:[_-][A-Za-z]+)*$"
#: Least mean log-likelihood ratio of a character pair, in nats; pseudo-count of each pair; scale of the stored integers.
THRESHOLD, PSEUDO, SCALE = 0.5, 0.5, 1_000_000
CODES = 128
#: Random and ordinary strings that the rules below make.
BY_RULE = 6000
#: Parts of ordinary identifiers.
PARTS = "account action address batch buffer build cache call cell change check child class client column config content context count create current data date default delete device error event field file filter find first flag format from function get global group handle hash header height image index input insert instance item key label last length level line list load local lock main manager map message method mode model name next node number object offset open option order output page param parent path point port prefix process query queue read record remove render request reset response result return root row run sample save scale schema scope search select send server service session set size sort source stack start state status step stop stream string style sub suffix table tag target task test text thread time title total tree type unit update user value vector version view width window word worker write".split()


#: Elements that a running total takes one by one; code points of a text that are cut off together.
RUN, CUT = 64, 4096
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"


def running(values: Column, op, zero: int) -> Column:
    """Before each element of an array of longs, what ``op`` (associative) makes of those in front of it. RUN at a time, so that the cost follows the elements."""
    none, start = F.array().cast("array<bigint>"), F.lit(zero).cast("bigint")

    def before(of: Column, value) -> Column:
        step = lambda acc, x: F.struct(op(acc["at"], value(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(of, F.struct(start.alias("at"), none.alias("out")), step)

    runs = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda k: before(F.slice(v, k * RUN + 1, RUN), lambda x: x))
    shifted = lambda r: F.flatten(F.zip_with(r, before(r, lambda x: x["at"])["out"], lambda x, o: F.transform(x["out"], lambda y: op(o, y))))
    return let(values, lambda v: F.when(F.size(v) > 0, let(runs(v), shifted)).otherwise(none))


def found(text: Column, kind: str, pattern: str, group: int, least: int, rank: int) -> Column:
    """Leftmost non-overlapping matches whose group is long enough: array of (start, rank, end, kind, value), in code points, end exclusive."""
    long = LONG.get(kind, pattern)
    matches, values, between = F.regexp_extract_all(text, F.lit(long), F.lit(0)), F.regexp_extract_all(text, F.lit(long), F.lit(group)), F.split(text, long, -1)
    rows = F.zip_with(F.arrays_zip(matches.alias("m"), values.alias("v")), between, lambda x, b: F.struct(F.length(b).cast("bigint").alias("b"), F.length(x["m"]).cast("bigint").alias("m"), x["v"].alias("v")))
    row = lambda x, at: F.struct((at + x["b"]).alias("start"), F.lit(rank).alias("rank"), (at + x["b"] + x["m"]).alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"))
    placed = lambda r: F.zip_with(r, running(F.transform(r, lambda x: x["b"] + x["m"]), lambda a, b: a + b, 0), row)
    real = F.filter(rows, lambda x: x["m"].isNotNull())  # what follows the last match goes
    return F.when(text.rlike(long), F.filter(let(real, placed), lambda s: F.length(s["value"]) >= least)).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    return F.concat(*[found(text, kind, pattern, group, least, rank) for rank, (kind, pattern, group, least) in enumerate(BASE)])


def candidates(text: Column) -> Column:
    return found(text, "markov", CANDIDATE, 0, 16, len(BASE))


def merged(spans: Column) -> Column:
    """Disjoint (start, end) of what ``spans`` cover, in order; spans that touch become one."""
    bound = lambda s, end: F.struct(s["start"].alias("start"), s["end"].alias("end"), end.alias("before"), (s["start"] > end).alias("new"))
    far = (1 << 62) - 1

    def join(s: Column) -> Column:  # (start, end, greatest end before, whether it begins a new one)
        last = F.greatest(F.array_max(F.transform(s, lambda x: x["end"])), F.lit(0))
        ends = F.reverse(running(F.reverse(F.transform(s, lambda x: F.when(x["new"], x["before"]).otherwise(F.lit(far)))), F.least, far))
        closed = F.zip_with(s, ends, lambda x, e: F.struct(x["start"].alias("start"), F.when(e == far, last).otherwise(e).alias("end"), x["new"].alias("new")))
        return F.transform(F.filter(closed, lambda x: x["new"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    with_before = lambda s: F.zip_with(s, running(F.transform(s, lambda x: x["end"]), F.greatest, -1), bound)
    return let(F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))), lambda s: let(with_before(s), join))


def _beside(spans: Column, base: Column, keep) -> Column:
    """Those spans for which ``keep`` (span, end of the base span that begins last at its start or before, start of the first that begins later) holds. Base spans are merged first, so each side is read once."""
    none, far = F.lit(None).cast(SPAN), (1 << 62) - 1
    both = F.array_sort(F.concat(F.transform(merged(base), lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("own"), b["end"].alias("end"), none.alias("span"))), F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("own"), s["end"].alias("end"), s.alias("span")))))

    def kept(a: Column) -> Column:
        end = running(F.transform(a, lambda x: F.when(x["own"] == 0, x["end"]).otherwise(F.lit(-1).cast("bigint"))), F.greatest, -1)
        next_ = F.reverse(running(F.reverse(F.transform(a, lambda x: F.when(x["own"] == 0, x["start"]).otherwise(F.lit(far)))), F.least, far))
        rows = F.zip_with(F.zip_with(a, end, lambda x, e: F.struct(x.alias("x"), e.alias("e"))), next_, lambda y, n: F.struct(y["x"]["span"].alias("span"), y["e"].alias("e"), n.alias("n")))
        return F.transform(F.filter(rows, lambda r: r["span"].isNotNull() & keep(r["span"], r["e"], r["n"])), lambda r: r["span"])

    return F.when(F.size(spans) > 0, F.when(F.size(base) > 0, let(both, kept)).otherwise(spans)).otherwise(spans)


def _apart(spans: Column, base: Column) -> Column:
    """Those spans that touch no base span."""
    return _beside(spans, base, lambda s, end, start: (end <= s["start"]) & (start >= s["end"]))


def _beyond(spans: Column, base: Column) -> Column:
    """Those spans that base spans do not cover from end to end."""
    return _beside(spans, base, lambda s, end, start: end < s["end"])


def rule_samples(spark: SparkSession, n: int = BY_RULE) -> DataFrame:
    """random (boolean) and token: strings of hash digits in several alphabets, and identifiers joined from ordinary parts in several styles."""
    rows = spark.range(2 * n).withColumn("h", F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256))
    part = lambda k: F.get(F.split(F.lit(" ".join(PARTS)), " "), (F.conv(F.substring("h", 4 * k + 1, 4), 16, 10).cast("int") % len(PARTS)))
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))
    digest = F.base64(F.unhex("h"))
    random = F.when(F.col("id") % 4 == 0, F.substring("h", 1, 40)).when(F.col("id") % 4 == 1, F.upper(F.translate(digest, "+/=", "K7"))).otherwise(digest)
    style = (F.col("id").bitwiseAND(F.lit(12)) / 4).cast("int")
    ordinary = F.when(style == 0, F.concat_ws("_", part(0), part(1), part(2))).when(style == 1, F.concat(part(0), cap(part(1)), cap(part(2)))).when(style == 2, F.concat_ws("-", part(0), part(1), part(2))).otherwise(F.concat(part(0), part(1), part(2)))
    ordinary = F.when(F.col("id") % 3 == 0, F.upper(ordinary)).otherwise(ordinary)
    return rows.select((F.col("id") < n).alias("random"), F.when(F.col("id") < n, random).otherwise(ordinary).alias("token"))


def corpus_samples(docs: DataFrame) -> DataFrame:
    """Labelled by the patterns: values in base spans are random; candidates apart from them, of letters only, are ordinary, as written and in capitals."""
    text = F.col("text")
    marked = docs.select("text").where(text.rlike(CANDIDATE) | text.rlike(BASE[0][1]) | text.rlike(LONG["access"]) | text.rlike(LONG["hex"])).select(base_spans(text).alias("base"), candidates(text).alias("other"))
    row = lambda random: lambda s: F.struct(F.lit(random).alias("random"), s["value"].alias("token"))
    plain = F.filter(_apart(F.col("other"), F.col("base")), lambda s: s["value"].rlike(ORDINARY))
    return marked.select(F.explode(F.concat(F.transform("base", row(True)), F.transform(plain, row(False)), F.transform(plain, lambda s: F.struct(F.lit(False).alias("random"), F.upper(s["value"]).alias("token"))))).alias("s")).select("s.*")


def train(samples: DataFrame) -> list[int]:
    """The log-likelihood ratio of each pair of characters, scaled, at 128 a + b; from (random, token), each distinct token once.

    Pairs are counted over all samples; the driver gets a row for each label and pair of ASCII characters. Labels without tokens leave the other's model against an even one.
    """
    tokens = samples.where(F.length("token") > 1).where(~F.col("token").rlike(r"[^\x00-\x7F]")).distinct()
    pairs = tokens.select("random", F.explode(let(F.split("token", ""), lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: F.concat(a, b)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["count"] for r in pairs.groupBy("random", "pair").count().collect()}
    table, cells = [0.0] * (CODES * CODES), 65
    for label, sign in ((True, 1), (False, -1)):
        after = [0.0] * CODES
        for (random, pair), n in counts.items():
            if random == label:
                after[ord(pair[0])] += n
        for a in range(CODES):
            for b in range(CODES):
                n = counts.get((label, chr(a) + chr(b)), 0)
                table[CODES * a + b] += sign * math.log((n + PSEUDO) / (after[a] + PSEUDO * cells))
    return [round(SCALE * x) for x in table]


def scored(value: Column, table: list[int]) -> Column:
    """The mean log-likelihood ratio of the pairs of a token, in nats."""
    model = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    each = lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: F.get(model, F.ascii(a) * CODES + F.ascii(b)))
    total = F.aggregate(let(F.split(value, ""), each), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return total / (F.length(value) - 1) / SCALE


def scan(docs: DataFrame, table: list[int], base: str = "base", spans: str = "spans") -> DataFrame:
    """``docs`` with base (spans of the patterns) and spans (those and the models', where they reach beyond), ordered by start, then kind.

    A null or empty text has none. One scan without a shuffle; rows stay as they are, repeated or not. Columns of
    these names, which may be chosen, are replaced; all others pass.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn(base, F.array_sort(base_spans(text)))
    added = F.filter(_beyond(candidates(text), F.col(base)), lambda s: scored(s["value"], table) >= THRESHOLD)
    return out.withColumn(spans, F.array_sort(F.concat(base, added)))


def joined(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def model(spark: SparkSession, docs: DataFrame) -> list[int]:
    return train(corpus_samples(docs).unionByName(rule_samples(spark)))


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans of every whole text."""
    out = scan(docs.select("doc_id", "text"), model(spark, docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(kind) for kind, *_ in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), F.size(F.filter("spans", lambda s: s["kind"] == "markov")).cast("long").alias("n_markov"))


def redacted(docs: DataFrame, table: list[int], mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of touching spans in its text replaced by ``mark``; texts without spans, null ones too, stay as they are.

    A text is cut into pieces of CUT code points first, so that what is kept is copied once, wherever it stands.
    """
    columns = docs.columns
    text = F.col("text")

    def between(cuts: Column, start: Column, end: Column) -> Column:
        """The text from one code point to another."""
        a, b = F.floor(start / CUT).cast("int"), F.floor((end - 1) / CUT).cast("int")
        at = (start - a * CUT + 1).cast("int")
        whole = F.array_join(F.slice(cuts, a + 2, F.greatest(b - a - 1, F.lit(0))), "")
        one = F.get(cuts, a).substr(at, (end - start).cast("int"))
        more = F.concat(F.get(cuts, a).substr(at, F.lit(CUT)), whole, F.get(cuts, b).substr(F.lit(1), (end - b * CUT).cast("int")))
        return F.when(end <= start, F.lit("")).when(a == b, one).otherwise(more)

    size = F.length(text).cast("bigint")

    def kept(spans: Column) -> Column:
        starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
        ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(size))
        return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)), lambda cuts: F.array_join(F.zip_with(starts, ends, lambda a, b: between(cuts, a, b)), mark))

    return scan(docs, table, "base__", "spans__").withColumn("text", F.when(F.size("spans__") > 0, let(merged(F.col("spans__")), kept)).otherwise(text)).select(*columns)
