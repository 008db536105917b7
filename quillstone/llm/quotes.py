"""Chat formatting by quotation linking. DataFrame functions only.

Messages quote others by lines that begin with ``>``, once for each level. Quoted passages are cut into sentences, normalised and
hashed, as is each passage as a whole, and joined to the first message that says them itself; replies then follow what they quote, and quotes are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import SENT, let, remove, split_join, stored, working

#: Marks of a quoted line; a line that announces a quote; shorter normalised sentences and passages link within their conversation only.
MARKS, ANNOUNCES, LEAST = r"^[ \t]{0,3}((?:>[ \t]?)+)", r"(?i)(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$", 8
#: Columns that linking adds.
ADDED = ("body", "n_quoted", "reply_conv", "reply_turn", "root_conv", "root_turn", "depth")
#: Doubling rounds for reply chains: chains of up to 2 ** ROUNDS replies.
ROUNDS = 40
#: Marks between passages and after a passage's level while lines are put together; in texts they count as spaces.
NEXT, SAYS = "\x00", "\x01"


def _plain(text: Column) -> Column:
    return F.translate(text, NEXT + SAYS, "  ")


def lines(text: Column) -> Column:
    """Array of (level, said): how often a line is quoted, and what it says without its marks."""
    return F.transform(F.split(_plain(text), r"\r\n|\r|\n"), lambda x: F.struct(F.length(F.translate(F.regexp_extract(x, MARKS, 1), " \t", "")).alias("level"), F.regexp_replace(x, MARKS, "").alias("said")))


def normalised(text: Column) -> Column:
    """Lower case, one space between words, no marks at either end."""
    return F.regexp_replace(F.lower(F.regexp_replace(text, r"[\s\p{Z}]+", " ")), r"^[\p{P}\p{S} ]+|[\p{P}\p{S} ]+$", "")


def passages(of_lines: Column) -> Column:
    """Neighbouring lines of one level as (level, said) passages, lines joined by spaces, so that wrapping does not matter. One pass over the lines."""
    before = F.concat(F.array(F.lit(-1)), F.transform(of_lines, lambda x: x["level"]))
    parts = F.zip_with(of_lines, F.slice(before, 1, F.size(of_lines)), lambda x, p: F.concat(F.when(x["level"] == p, F.lit(" ")).otherwise(F.concat(F.lit(NEXT), x["level"].cast("string"), F.lit(SAYS))), x["said"]))
    whole = F.split(F.array_join(parts, ""), NEXT)
    level = lambda p: F.substring_index(p, SAYS, 1)
    return F.transform(F.slice(whole, 2, F.greatest(F.size(whole), F.lit(1))), lambda p: F.struct(level(p).cast("int").alias("level"), p.substr(F.length(level(p)) + 2, F.length(p)).alias("said")))


def parsed(messages: DataFrame) -> DataFrame:
    """Add lines__ (level, said) and body: the text without quoted lines and without the line that announces a quote."""
    text = F.coalesce(F.col("text"), F.lit(""))
    quoted = text.rlike("(?m)" + MARKS)
    of = F.col("lines__")
    after = F.concat(F.slice(F.transform(of, lambda x: x["level"]), 2, F.size(of)), F.array(F.lit(0)))
    own = F.filter(F.zip_with(of, after, lambda x, n: F.struct(((x["level"] == 0) & ~((n > 0) & x["said"].rlike(ANNOUNCES))).alias("own"), x["said"].alias("said"))), lambda x: x["own"])
    body = F.trim(F.regexp_replace(F.array_join(F.transform(own, lambda x: x["said"]), "\n"), r"\n{3,}", "\n\n"))
    return messages.withColumn("lines__", F.when(quoted, lines(text))).withColumn("body", F.when(quoted, F.trim(F.regexp_replace(body, r"^\n+|\n+$", ""))).otherwise(F.col("text")))


def sentences(said: Column) -> Column:
    whole = F.transform(F.split(said, r"(?<=[.!?])[\s\p{Z}]+|(?<=[。！？｡])(?![。！？｡])"), normalised)
    return F.array_distinct(F.filter(whole, lambda s: s != ""))


def whole(said: Column) -> Column:
    """A passage as one; what normalising leaves nothing of (marks, emoji) is taken as it is."""
    return let(normalised(said), lambda plain: F.when(plain != "", plain).otherwise(F.trim(F.regexp_replace(said, r"[\s\p{Z}]+", " "))))


def quoted_units(said: Column) -> Column:
    """(s, counts) of a quoted passage: its sentences and the whole of it, which counts only if it has no sentence."""
    own = sentences(said)
    row = lambda counts: lambda s: F.struct(s.alias("s"), F.lit(counts).alias("counts"))
    alone = F.struct(whole(said).alias("s"), (F.size(own) == 0).alias("counts"))
    return F.concat(F.transform(own, row(True)), F.filter(F.array(alone), lambda u: (u["s"] != "") & ~F.array_contains(own, u["s"])))


def said_units(body: Column, of_lines: Column) -> Column:
    """What a message says itself: its sentences, and as wholes its body, paragraphs, lines and the passages between quotes."""
    body = _plain(body)
    between = F.transform(F.filter(passages(of_lines), lambda p: p["level"] == 0), lambda p: p["said"])
    parts = F.concat(F.array(body), F.split(body, r"(?:\r\n|\r|\n)\s*[\r\n]"), F.split(body, r"\r\n|\r|\n"), F.coalesce(between, F.array().cast("array<string>")))
    return F.array_distinct(F.concat(sentences(F.regexp_replace(body, r"\s+", " ")), F.filter(F.transform(F.array_distinct(parts), whole), lambda s: s != "")))


def _chains(links: DataFrame) -> DataFrame:
    """conv_id, turn, root (of the thread) and depth of the messages of ``links`` (conv_id, turn, up); each round doubles the known part of every chain, which is two ids and a number."""
    spark, id_ = links.sparkSession, F.struct("conv_id", "turn")
    now = stored(links.select("conv_id", "turn", "up", F.lit(1).alias("depth"), F.lit(False).alias("done")), "chains")
    for _ in range(ROUNDS):
        if now.where("not done").isEmpty():
            return now.select("conv_id", "turn", F.col("up").alias("root"), "depth")
        held = now.where("not done").groupBy("up").agg(F.count("*").alias("m"))
        ends = stored(held.join(now.select(id_.alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"), F.col("done").alias("last")), "up", "left"), "chain-ends")
        grown = split_join(now.where("not done"), ends, ["up"], "m").select("conv_id", "turn", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), (F.col("further").isNull() | F.col("last")).alias("done"))
        was, now = now, stored(grown.unionByName(now.where("done")), "chains")
        remove(spark, was)
        remove(spark, ends)
    raise RuntimeError(f"chains of replies did not end in {ROUNDS} rounds")


def link(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) as reply-ordered conversations without quotes.

    Added are body, n_quoted (quoted sentences, and passages without one), reply_conv and reply_turn (the message a quote links to), root_conv and root_turn (the first message of its
    thread) and depth. What a message answers comes before it by conv_id and turn, so ordering by root_conv, root_turn, conv_id and turn puts replies after what they answer.
    The original of a sentence or whole passage is the first earlier message that says it unquoted, in the same conversation
    or else, unless it is short, anywhere before; of the originals of a message the least deeply quoted comes first, then the one with most quoted characters, then the latest.
    So each sentence has one original, and common sentences do not multiply: all sides are aggregated before they meet, and rows of a hot one stay where they are.
    A message without a linked quote begins a thread. Work and rows grow in proportion to the text, whatever the lines of a message or the length of a thread.
    Columns with the names of new ones are replaced. Null texts have null bodies; rows with a null conv_id or turn link with nothing; repeated rows share their link and stay; extra columns pass.
    """
    with working(messages.sparkSession) as keep:
        return _link(messages, keep)


def _link(messages: DataFrame, keep) -> DataFrame:
    read = parsed(messages.drop(*ADDED))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    quotes = F.col("lines__").isNotNull()
    units = read.where(known & quotes).select("conv_id", "turn", F.explode(F.filter(passages(F.col("lines__")), lambda p: p["level"] > 0)).alias("p")).select("conv_id", "turn", "p.level", F.explode_outer(quoted_units(F.col("p.said"))).alias("u"))
    quoting = stored(units.groupBy("conv_id", "turn", "level", F.unhex(F.md5("u.s")).alias("hash")).agg(F.max(F.length("u.s")).alias("weight"), F.bool_or("u.counts").alias("counts"), F.count("*").alias("times")), "quotes")
    asked = quoting.where("hash is not null")
    said = read.where(known).select("conv_id", "turn", F.explode(said_units(F.coalesce("body", F.lit("")), F.col("lines__"))).alias("s")).select("conv_id", "turn", F.unhex(F.md5("s")).alias("hash"))
    wanted = stored(asked.select("hash").distinct(), "wanted")
    if wanted.count() <= SENT:  # otherwise units that nobody quotes move too, a row for each conversation and unit
        said = said.join(F.broadcast(wanted), "hash", "left_semi")
    said = stored(said.groupBy("conv_id", "hash").agg(F.min("turn").alias("first_turn")), "said")
    here = stored(asked.groupBy("conv_id", "hash").agg(F.count("*").alias("m")).join(said, ["conv_id", "hash"], "left"), "said-here")
    first = said.groupBy("hash").agg(F.min("conv_id").alias("conv"))
    first = first.join(said, [first["hash"] == said["hash"], first["conv"] == said["conv_id"]]).select(first["hash"], "conv", F.col("first_turn").alias("conv_turn"))
    anywhere = stored(asked.groupBy("hash").agg(F.count("*").alias("m")).join(first, "hash", "left"), "said-anywhere")
    near = split_join(split_join(asked, here, ["conv_id", "hash"], "m"), anywhere, ["hash"], "m")
    origin = F.when(F.col("first_turn") < F.col("turn"), F.struct("conv_id", F.col("first_turn").alias("turn"))).when((F.col("weight") >= LEAST) & (F.col("conv") < F.col("conv_id")), F.struct(F.col("conv").alias("conv_id"), F.col("conv_turn").alias("turn")))
    votes = near.withColumn("origin", origin).where("origin is not null").groupBy("conv_id", "turn", "origin").agg(F.min("level").alias("level"), F.sum("weight").alias("weight"))
    links = stored(votes.groupBy("conv_id", "turn").agg(F.max_by("origin", F.struct(-F.col("level"), "weight", "origin")).alias("up")), "links")
    counts = quoting.groupBy("conv_id", "turn").agg(F.count_if("counts").alias("n_quoted"), F.max("times").alias("rows__"))
    answer = keep(stored(counts.join(links, ["conv_id", "turn"], "left").join(_chains(links), ["conv_id", "turn"], "left").select("conv_id", "turn", "n_quoted", "up", "root", "depth", "rows__"), "answers"))
    plain = read.where(~(known & quotes)).withColumns({"n_quoted": F.lit(0).cast("long"), **{c: F.lit(None).cast(answer.schema[c].dataType) for c in ("up", "root", "depth")}})
    out = split_join(read.where(known & quotes), answer, ["conv_id", "turn"], "rows__", "left").unionByName(plain)
    return out.select(
        *[c for c in messages.columns if c not in ADDED], "body", F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.col("up.conv_id").alias("reply_conv"), F.col("up.turn").alias("reply_turn"),
        F.coalesce("root.conv_id", "conv_id").alias("root_conv"), F.coalesce("root.turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )
