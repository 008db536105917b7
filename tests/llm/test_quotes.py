import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quillstone.llm import common, quotes

SCHEMA = "conv_id long, turn long, role string, text string, lines string"
CHAT = [
    (1, 0, "user", "How do I sort a list?\nIt has many numbers.", "x"),
    (1, 1, "assistant", "Call the sort method of the list.  It works in place.", "x"),
    (1, 2, "user", "On Monday X wrote:\n> Call the sort method\n> of the LIST.\n\nAnd for tuples, please?", "x"),
    (1, 3, "assistant", "> > Call the sort method of the list.\n> And for tuples, please?\n\nUse the sorted function.", "x"),
    (1, 4, "user", "> How do I sort a list?\nI meant another list.", "x"),
    (2, 0, "user", "> Use the sorted function.\nThat one returns a new list, right?", "x"),
    (2, 1, "assistant", "> nobody ever said this sentence\nHello there, friend of mine.", "x"),
    (3, 0, "user", "> I quote myself here today.\nI quote myself here today.", "x"),
    (3, 1, "user", None, "x"),
    (3, 2, "user", "", "x"),
    (3, 3, None, ">>> >\n>", "x"),
    (None, 0, "user", "> How do I sort a list?\nno conversation", "x"),
    (4, None, "user", "> How do I sort a list?\nno turn", "x"),
    (1, 4, "user", "> How do I sort a list?\nI meant another list.", "x"),
]


@pytest.fixture(scope="module")
def linked(spark):
    return quotes.link(spark.createDataFrame(CHAT, SCHEMA).repartition(3))


def by(rows):
    return {(r["conv_id"], r["turn"]): r for r in rows}


def test_links_and_bodies(linked):
    rows = linked.collect()
    assert len(rows) == len(CHAT)
    r = by(rows)
    reply = {k: (v["reply_conv"], v["reply_turn"]) for k, v in r.items() if v["reply_turn"] is not None}
    assert reply == {(1, 2): (1, 1), (1, 3): (1, 2), (1, 4): (1, 0), (2, 0): (1, 3)}
    assert r[1, 2]["body"] == "And for tuples, please?" and r[1, 3]["body"] == "Use the sorted function."
    assert r[1, 0]["body"] == CHAT[0][3] and r[3, 1]["body"] is None and r[3, 3]["body"] == ""
    assert r[1, 3]["n_quoted"] == 2 and r[2, 1]["n_quoted"] == 1 and r[1, 0]["n_quoted"] == 0


def test_reply_order(linked):
    r = by(linked.collect())
    assert (r[1, 3]["root_conv"], r[1, 3]["root_turn"], r[1, 3]["depth"]) == (1, 1, 2)
    assert (r[2, 0]["root_conv"], r[2, 0]["root_turn"], r[2, 0]["depth"]) == (1, 1, 3) and (r[1, 4]["root_turn"], r[3, 1]["root_turn"], r[4, None]["root_turn"]) == (0, 1, None)
    order = [(x["conv_id"], x["turn"]) for x in linked.where("root_conv = 1").orderBy("root_conv", "root_turn", "conv_id", "turn").collect()]
    for k in ((1, 2), (1, 3), (2, 0), (1, 4)):
        assert order.index((r[k]["reply_conv"], r[k]["reply_turn"])) < order.index(k)


def test_long_chains(spark):
    rows = [(9, k, "user", (f"> Message number {k - 1} is said here.\n" if k else "") + f"Message number {k} is said here.", None) for k in range(37)]
    got = by(quotes.link(spark.createDataFrame(rows, SCHEMA)).collect())
    assert all((r["depth"], r["root_turn"], r["reply_turn"]) == (k, 0, k - 1 if k else None) for (_, k), r in got.items())


def test_common_sentences_do_not_multiply(spark):
    rows = [(k, 0, "user", "The very same first turn for all.", None) for k in range(300)] + [(k, 1, "user", "> The very same first turn for all.\nYes.", None) for k in range(300)]
    got = quotes.link(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 600 and all((r["reply_conv"], r["reply_turn"]) == (r["conv_id"], 0) for r in got if r["turn"] == 1)


def test_short_quotes(spark):
    rows = [
        (5, 0, "user", "Let us meet at noon tomorrow. I agree.\nThe red list\nmilk and bread", None),
        (5, 1, "user", "你好。你在做什么？", None),
        (5, 2, "user", "???", None),
        (5, 3, "user", "> I agree.\nFine.", None),
        (5, 4, "user", "> 你在做什么？\n没什么", None),
        (5, 5, "user", "> ???\nIndeed!", None),
        (5, 6, "user", "> Fine.\n> Indeed!\nBoth.", None),
        (5, 7, "user", "> The red list\nWhich one?", None),
        (6, 0, "user", "> I agree.\nNobody said so here.", None),
    ]
    got = by(quotes.link(spark.createDataFrame(rows, SCHEMA)).collect())
    assert {k: v["reply_turn"] for k, v in got.items() if v["reply_turn"] is not None} == {(5, 3): 0, (5, 4): 1, (5, 5): 2, (5, 6): 5, (5, 7): 0}
    assert [got[k]["n_quoted"] for k in ((5, 3), (5, 4), (5, 5), (5, 6), (5, 7), (6, 0))] == [1, 1, 1, 2, 1, 1]


def test_native_and_empty(spark, linked):
    assert not re.search("Python|Arrow|Pandas", linked._jdf.queryExecution().executedPlan().toString())
    assert quotes.link(spark.createDataFrame([], SCHEMA)).count() == 0


def units(text):
    return [s for s in (re.sub(r"^[\W_]+|[\W_]+$", "", " ".join(p.lower().split())) for p in re.split(r"(?<=[.!?])\s+", text)) if s]


def brute(rows):
    """Links of plain messages, by reading all of them for each quote."""
    said, out = {}, {}
    for conv, turn, text in rows:
        own = "\n".join(x for x in text.split("\n") if not x.startswith(">"))
        for s in {*units(" ".join(own.split())), *(u for p in (own, *own.split("\n")) for u in [" ".join(units(" ".join(p.split())))] if len(units(p)) == 1)}:
            said.setdefault(s, []).append((conv, turn))
    for conv, turn, text in rows:
        votes = {}
        for level in (2, 1):
            for passage in re.findall(rf"(?:^(?:> ){{{level}}}[^>\n]*\n?)+", text, re.M):
                for s in units(" ".join(re.sub(r"^(> )+", "", passage, flags=re.M).split())):
                    where = said.get(s, [])
                    same = [w for w in where if w[0] == conv]
                    first = min(same, default=(conv, turn))
                    if first >= (conv, turn):
                        first = min(where, default=(conv, turn))
                        if first[0] >= conv or len(s) < quotes.LEAST:
                            continue
                    votes.setdefault(first, {})[s, level] = (level, len(s))
        if votes:
            out[conv, turn] = max(votes, key=lambda o: (-min(x[0] for x in votes[o].values()), sum(x[1] for x in votes[o].values()), o))
    return out


@pytest.mark.parametrize("split", [3, 10_000])
def test_against_brute_force(spark, monkeypatch, split):
    """Threads of several conversations that quote each other on two levels, common sentences among them; hot ones split off or not."""
    monkeypatch.setattr(common, "SPLIT_ROWS", split)
    monkeypatch.setattr(quotes, "SENT", split)
    rnd = random.Random(11)
    rows, all_ = [], []
    for conv in range(12):
        for turn in range(9):
            own = [rnd.choice(["Thanks a lot for that.", "Yes.", "I see what you mean here.", "No."])] if rnd.random() < 0.5 else []
            own += [f"Remark {rnd.randrange(60)} is about point {conv % 5} of {turn % 4}." for _ in range(rnd.randrange(1, 4))]
            quoted = []
            if all_ and rnd.random() < 0.8:
                picks = rnd.sample(all_, min(len(all_), rnd.randrange(1, 4)))
                quoted = [f"> > {picks[0]}"] * (len(picks) > 2) + [f"> {p}" for p in picks[1:] or picks]
            rows.append((conv, turn, "\n".join([*quoted, *own])))
            all_ += own
    got = quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(4)).collect()
    links = {(r["conv_id"], r["turn"]): (r["reply_conv"], r["reply_turn"]) for r in got if r["reply_turn"] is not None}
    assert links == brute(rows) and len(links) > 40
    for r in got:  # roots and depths by following links
        at, depth = (r["conv_id"], r["turn"]), 0
        while at in links:
            at, depth = links[at], depth + 1
        assert (r["root_conv"], r["root_turn"], r["depth"]) == (*at, depth)


def test_cost_follows_the_lines(spark):
    """Twice the lines of a message cost at most about twice the time."""

    def seconds(n):
        text = "\n".join("> " * (k % 2) + f"line {k}" for k in range(n))
        df = spark.createDataFrame([(1, text)], "id long, text string")
        one = df.select(F.sum(F.size(quotes.passages(quotes.lines(F.col("text"))))))
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            assert one.first()[0] == n
            best = min(best, time.perf_counter() - start)
        return best

    seconds(1000)
    assert seconds(80_000) <= 2.2 * seconds(40_000) + 0.3


def test_control_characters(spark):
    rows = [(1, 0, "user", "One\x00two three\x01 four five.", None), (1, 1, "user", "> One\x00two three\x01 four five.\n> \x00\nYes\x00.", None)]
    got = by(quotes.link(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got[1, 1]["reply_turn"] == 0 and got[1, 0]["body"] == rows[0][3]
