"""Quotation linking: conversations in reply order, without what replies quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.llm.common import once, salted_join, saved

#: Ends of sentences: marks followed by a blank, and full-width marks.
SENTENCE = r"(?<=[.!?])\s+|(?<=[。！？])"
LEVEL = r"^(?:[ \t]*>)*"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, LEVEL, 0), "[^>]", ""))


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, LEVEL + r" ?", "")


def _normal(text: Column) -> Column:
    """Lower case, single blanks, no attribution or punctuation at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def _runs(lines: Column) -> Column:
    """Consecutive lines of one quote level, empty lines ending a run: ``level, text``.

    Lines are put together as one text in which carriage returns, that no line
    has, begin the runs, so the work grows with the text alone.
    """
    shaped = F.transform(
        lines, lambda x: F.struct(_level(x).alias("level"), F.rtrim(_bare(x)).alias("text"))
    )

    def blank(line):
        return F.trim(line["text"]) == ""

    def joined(all_lines):
        def piece(line, i):
            last = F.get(all_lines, i - 1)
            goes_on = F.coalesce(~blank(last) & (last["level"] == line["level"]), F.lit(False))
            begins = F.concat(F.lit("\r"), line["level"].cast("string"), F.lit(" "), line["text"])
            return F.when(blank(line), "").when(goes_on, F.concat(F.lit("\n"), line["text"])).otherwise(begins)

        return F.array_join(F.transform(all_lines, piece), "")

    runs = F.filter(F.split(once(shaped, joined), "\r", -1), lambda x: x != "")
    return F.transform(runs, lambda x: F.struct(
        F.substring_index(x, " ", 1).cast("int").alias("level"),
        F.substring(x, F.locate(" ", x) + 1, F.length(x)).alias("text"),
    ))


def parsed(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` and its passages: ``level, text`` from top to bottom."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n", -1)
    return messages.select("conv_id", "turn", "role", text.alias("text"), _runs(lines).alias("passages"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role``, ``own_text``, ``n_quotes, n_linked``, ``parent_turn``,
    ``root_turn``, ``depth`` and ``position`` per message.

    Lines with leading ``>`` are quotes, as deep as they have of them.
    Consecutive lines of one depth are a passage. A quoted passage is linked to
    the earliest earlier message of the conversation that has the same words, of
    any number, among its own as a passage; if none has, as lines or sentences
    of one (:func:`parts`). A passage that is no part itself is linked by its
    own lines and sentences, to the message that has the most of them, the
    earliest of several. The parent of a message is the latest message that its
    outermost linked quotes come from; without one a message starts a thread.
    Threads follow parents up to their root. ``position`` is the place of a turn
    in its thread, from 0, each reply and what answers it standing after the
    message it answers, replies to one message by turn.

    ``own_text`` has no quotes. A null text is empty; a message with a null
    conv_id or turn is kept and links to nothing; repeated rows give repeated
    results; the order within equal turns does not matter.
    """
    found = saved(parsed(messages), "parsed")
    links = saved(_links(found), "links")
    outer = links.groupBy("conv_id", "turn").agg(
        F.min(F.struct(F.col("level"), (-F.col("source")).alias("back"))).alias("m"),
        F.countDistinct("hash").alias("n_linked"),
    )
    parents = saved(
        outer.select("conv_id", "turn", (-F.col("m.back")).alias("parent_turn"), "n_linked"), "parents"
    )
    roots = saved(_rooted(parents), "roots")
    placed = _positions(parents, roots)
    keyed = parents.join(roots.drop("size"), ["conv_id", "turn"]).join(placed, ["conv_id", "turn"])
    own = F.filter("passages", lambda p: p["level"] == 0)
    base = found.select(
        "conv_id", "turn", "role",
        F.array_join(F.transform(own, lambda p: p["text"]), "\n\n").alias("own_text"),
        (F.size("passages") - F.size(own)).cast("bigint").alias("n_quotes"),
    )
    joined = base.join(keyed, ["conv_id", "turn"], "left")
    return joined.select(
        "conv_id", "turn", "role", "own_text", "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"), "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
        F.coalesce("position", F.lit(0)).cast("bigint").alias("position"),
    )


def _hash(words: Column) -> Column:
    return F.unhex(F.substring(F.sha2(words, 256), 1, 32))


def parts(text: Column) -> Column:
    """The distinct lines and sentences of a passage, normalised; none without words."""
    lines = F.split(text, "\n", -1)
    sentences = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), SENTENCE, -1)
    in_lines = F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE, -1)))
    return F.filter(F.array_distinct(F.transform(F.concat(lines, sentences, in_lines), _normal)), lambda x: x != "")


def _links(found: DataFrame) -> DataFrame:
    """``conv_id, turn, level, hash, source`` of the linked quotes; ``hash`` is the whole quote's.

    Each hash of a conversation has one source for each way it stands in a
    message, so a quote has at most as many candidates as lines and sentences.
    """
    rows = found.select("conv_id", "turn", F.explode("passages").alias("p")).select(
        "conv_id", "turn", "p.level", _hash(_normal(F.col("p.text"))).alias("hash"),
        _normal(F.col("p.text")).alias("words"), parts(F.col("p.text")).alias("parts"),
    ).where("words <> ''")
    own = rows.where("level = 0")
    whole = own.select("conv_id", F.col("hash").alias("part"), "turn", F.lit(True).alias("whole")).unionAll(
        own.select("conv_id", F.explode(F.transform("parts", _hash)), "turn", F.lit(False))
    )
    originals = whole.groupBy("conv_id", "part").agg(
        F.min(F.when(F.col("whole"), F.col("turn"))).alias("as_whole"), F.min("turn").alias("as_part")
    )
    quoted = rows.where("level > 0").select("conv_id", "turn", "level", "hash", F.transform("parts", _hash).alias("parts"))
    quoted = saved(quoted.distinct(), "quoted")
    pieces = F.array_distinct(F.concat(F.array("hash"), F.col("parts")))
    pieces = quoted.select("conv_id", "turn", "level", "hash", F.explode(pieces).alias("part"))
    met = salted_join(pieces, originals, ["conv_id", "part"]).where("as_part < turn")
    # The whole quote as a passage, else as a part of one, else the most of its parts.
    met = met.select(
        "conv_id", "turn", "level", "hash",
        F.when(F.col("part") != F.col("hash"), 2).when(F.col("as_whole") < F.col("turn"), 0).otherwise(1).alias("way"),
        F.when((F.col("part") == F.col("hash")) & (F.col("as_whole") < F.col("turn")), F.col("as_whole"))
        .otherwise(F.col("as_part")).alias("source"),
    )
    votes = met.groupBy("conv_id", "turn", "level", "hash", "way", "source").agg((-F.count(F.lit(1))).alias("votes"))
    best = votes.groupBy("conv_id", "turn", "level", "hash").agg(F.min(F.struct("way", "votes", "source")).alias("b"))
    return best.select("conv_id", "turn", "level", "hash", "b.source")


def _rooted(parents: DataFrame) -> DataFrame:
    """``root_turn, depth, size`` of messages with a parent, doubling the distance each round.

    A parent has a smaller turn, so there are no cycles. ``size`` is the number
    of turns from a message on downwards: those nearer than the distance, and of
    messages at just that distance below it, theirs.
    """
    ahead = parents.select(
        "conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("bigint").alias("depth"),
        F.lit(1).cast("bigint").alias("size"),
    )
    distance = 1
    while True:
        further = ahead.select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more")
        )
        below = ahead.where(F.col("depth") == distance).groupBy("conv_id", F.col("up").alias("turn")).agg(
            F.sum("size").alias("below")
        )
        joined = salted_join(ahead, further, ["conv_id", "up"], "left").join(below, ["conv_id", "turn"], "left")
        ahead = saved(
            joined.select(
                "conv_id", "turn", F.coalesce("next", "up").alias("up"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                (F.col("size") + F.coalesce("below", F.lit(0))).alias("size"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if ahead.where("moved").isEmpty():
            return ahead.select("conv_id", "turn", F.col("up").alias("root_turn"), "depth", "size")
        ahead = ahead.drop("moved")
        distance *= 2


def _positions(parents: DataFrame, roots: DataFrame) -> DataFrame:
    """``position`` of messages with a parent: the sum, up to the root, of one and the
    sizes of earlier replies to the same message. No path is stored.
    """
    sized = parents.join(roots, ["conv_id", "turn"]).select("conv_id", "turn", "parent_turn", "size")
    earlier = Window.partitionBy("conv_id", "parent_turn").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    ahead = saved(
        sized.select(
            "conv_id", "turn", F.col("parent_turn").alias("up"),
            (F.coalesce(F.sum("size").over(earlier), F.lit(0)) + 1).alias("position"),
        ),
        "places",
    )
    while True:
        further = ahead.select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("position").alias("more")
        )
        joined = salted_join(ahead, further, ["conv_id", "up"], "left")
        ahead = saved(
            joined.select(
                "conv_id", "turn", F.coalesce("next", "up").alias("up"),
                (F.col("position") + F.coalesce("more", F.lit(0))).alias("position"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "places",
        )
        if ahead.where("moved").isEmpty():
            return ahead.select("conv_id", "turn", "position")
        ahead = ahead.drop("moved")


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The messages sorted over all partitions by conversation, thread and position."""
    order = ["conv_id", "root_turn", "position", "turn"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)
