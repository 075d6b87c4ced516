"""Quotes that are short, or part of what they quote."""

import random
import re
import time

from surgewatch.llm import quotes

SCHEMA = "conv_id string, turn bigint, role string, text string"


def linked(spark, texts):
    data = [("c", i, "u", t) for i, t in enumerate(texts)]
    return {r.turn: r for r in quotes.link_quotes(spark.createDataFrame(data, SCHEMA)).collect()}


def test_short_quotes_link(spark):
    got = linked(spark, ["Shall I?", "Yes, do it", "> Yes, do it\nDone.", "好的", "> 好的\n谢谢", "> ???\nwhat"])
    assert [got[t].parent_turn for t in range(6)] == [None, None, 1, None, 3, None]
    assert (got[2].root_turn, got[4].root_turn, got[2].n_linked) == (1, 3, 1)


def test_a_part_of_a_paragraph_links(spark):
    paragraph = "The lamp is red. It stands in\nthe hall. Nobody knows why.\nAsk the owner!"
    got = linked(spark, [
        "Hello there", paragraph, "> Nobody knows why.\nI do.", "> Ask the owner!\nI will.", "> It stands in the hall.\nOh.",
        "> the hall. Nobody knows why.\nHm.", "> The lamp is red. [...]\n> Ask the owner!\nSure.", "> Nobody asks.\nNo.",
    ])
    assert [got[t].parent_turn for t in range(8)] == [None, None, 1, 1, 1, 1, 1, None]
    assert got[6].n_linked == 1 and got[6].own_text == "Sure."


def test_a_whole_passage_counts_before_a_part(spark):
    got = linked(spark, ["I came. Yes, do it. I went.", "Yes, do it.", "> Yes, do it.\nFine"])
    assert got[2].parent_turn == 1


def test_positions_follow_the_tree(spark):
    import random

    pick = random.Random(3)
    parent = {0: None, 1: None} | {i: pick.choice([i - 1, pick.randrange(i)]) for i in range(2, 40)}
    texts = [f"reply number {i}" if parent[i] is None else f"> reply number {parent[i]}\nreply number {i}" for i in range(40)]

    def walk(top):
        return [top, *[x for i in range(40) if parent[i] == top for x in walk(i)]]

    want = {x: n for top in (0, 1) for n, x in enumerate(walk(top))}
    got = linked(spark, texts)
    assert {i: got[i].position for i in range(40)} == want
    rows = [("c", i, "u", t) for i, t in enumerate(texts)]
    ordered = quotes.in_reply_order(quotes.link_quotes(spark.createDataFrame(rows, SCHEMA)))
    assert [r.turn for r in ordered.collect()] == walk(0) + walk(1)


def plain_runs(text):
    """Runs of one quote level, line by line."""
    runs, open_ = [], False
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        mark = re.match(r"(?:[ \t]*>)*", line).group()
        level, rest = mark.count(">"), line[len(mark):].removeprefix(" ").rstrip(" ")
        if rest == "":
            open_ = False
        elif open_ and runs[-1][0] == level:
            runs[-1][1].append(rest)
        else:
            runs.append((level, [rest]))
            open_ = True
    return [(level, "\n".join(lines)) for level, lines in runs]


def test_runs_of_lines_against_plain_python(spark):
    pick = random.Random(4)
    lines = ["", " ", ">", "> a", ">> b c", "> > d ", "a", " a > b", "\t> e", ">f", "7 up", "é 。", "\t", "a\rb", "c\r"]
    texts = ["\n".join(pick.choices(lines, k=pick.randrange(12))) for _ in range(300)] + [None]
    rows = [("c", i, "user", t) for i, t in enumerate(texts)]
    got = quotes.parsed(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    for r in got:
        assert [tuple(p) for p in r.passages] == plain_runs(texts[r.turn] or ""), texts[r.turn]


def test_a_mail_of_ten_megabytes(spark):
    """One run of 400,000 lines, and 200,000 passages of two levels in turn."""
    rows = [("c", 1, "user", "a line of some words here\n" * 400_000),
            ("d", 1, "user", "> quoted words of a line\nwhat it answers to it\n\n" * 100_000)]
    docs = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    began = time.monotonic()
    got = {r.conv_id: r for r in quotes.parsed(docs).selectExpr("conv_id", "size(passages) AS n", "passages[0].text AS one").collect()}
    assert (got["c"].n, len(got["c"].one)) == (1, 26 * 400_000 - 1)
    assert (got["d"].n, got["d"].one) == (200_000, "quoted words of a line")
    assert time.monotonic() - began < 60


def test_no_messages_and_clashing_columns(spark):
    schema = "conv_id string, turn int, role string, text string, level int, hash string, source string, position int"
    assert quotes.link_quotes(spark.createDataFrame([], schema)).count() == 0
    rows = [("c", 1, "user", "please do it", 9, "h", "s", 9), ("c", 2, "user", "> please do it\nyes", 9, "h", "s", 9)]
    got = {r.turn: r for r in quotes.link_quotes(spark.createDataFrame(rows, schema)).collect()}
    assert (got[2].parent_turn, got[2].position, got[2].own_text) == (1, 1, "yes")
