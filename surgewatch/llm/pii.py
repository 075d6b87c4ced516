"""Personal data, and terms that reveal it by co-occurrence, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.llm.common import places, salted_join, saved

# The four kinds in their order. Repetitions are possessive and a
# match starts where a run does, or where the last match ended, so that no text
# takes more than linear time; the matches are those of the plain expressions
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, [0-9]+(\.[0-9]+){3},
# [0-9]([\x20-]?[0-9])+ and \+[0-9][\x20().0-9-]+[0-9].
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"

#: Share of an entity's information that a term must reveal to be generalised, and removed.
GENERALISE, REMOVE = 0.6, 0.85

TERM = r"[\p{L}\p{M}\p{N}]++"
NONE = "array<struct<start:bigint,end:bigint,value:string>>"


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
    if kind == "card":
        return F.length(digits).between(16, 19) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """``start, end, value`` of one kind's valid matches, leftmost and without overlap."""
    may = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(
        kind, F.rlike(text, F.lit("[0-9][0-9.\\x20-]{6}"))
    )
    found = F.filter(places(text, F.lit(KINDS[kind])), lambda x: _valid(kind, x["value"]))
    return F.when(may, found).otherwise(F.array().cast(NONE))


def with_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` (null is empty), ``_key`` of the text and one span column per kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select("doc_id", text.alias("text"))
    return plain.select(
        "doc_id", "text", F.md5("text").alias("_key"),
        *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS],
    )


def named_spans() -> Column:
    """``start, end, put, entity`` of the spans of all kinds; ``put`` is what replaces them."""

    def of(kind):
        # A further parameter of the lambda would be taken as the index.
        return F.transform(F.col(kind), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit(f"<{kind}>").alias("put"),
            F.concat(F.lit(f"{kind}:"), F.lower(x["value"])).alias("entity"),
        ))

    return F.concat(*map(of, KINDS))


def holders(found: DataFrame) -> DataFrame:
    """The distinct texts with an entity: ``_key, copies, text`` and ``spans``."""
    spans = named_spans()
    return found.where(F.size(spans) > 0).groupBy("_key").agg(
        F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"), F.first(spans).alias("spans")
    )


def _terms(text: str) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def revealing(found: DataFrame, held: DataFrame) -> DataFrame:
    """``_key, term, strength``: terms of a text that reveal one of its entities.

    With N documents, n(c) with an entity, n(t) with a term and n(c, t) with
    both, wherever they stand, strength is log(n(c, t) N / n(c) n(t)) /
    log(N / n(c)), at most 1: the share of the entity's information that the
    term gives away. All four are numbers of documents, copies included. No
    number of documents is asked for: an entity seen once is revealed by each
    term of a few documents. Of several entities in a text the strongest counts.

    Entities of the same texts have the same counts, so they are one group and
    a list of addresses is no list of pairs. Since n(c, t) is at most n(c), a
    pair reaches the least strength s only if n(t) is at most n(c)^s N^(1-s);
    others are not made.
    """
    total = found.count()
    names = F.array_distinct(F.transform("spans", lambda x: x["entity"]))
    entities = saved(held.select("_key", "copies", F.explode(names).alias("entity")), "entities")
    groups = entities.groupBy("entity").agg(
        F.sum("copies").alias("seen"), F.count(F.lit(1)).alias("texts"),
        F.bit_xor(F.xxhash64("_key")).alias("x"), F.bit_xor(F.xxhash64(F.lit("texts"), F.col("_key"))).alias("y"),
    ).select("entity", "seen", F.md5(F.concat_ws(",", "seen", "texts", "x", "y")).alias("group"))
    sets = salted_join(entities, saved(groups, "groups"), ["entity"]).select("_key", "copies", "group", "seen").distinct()
    # All terms are counted, so rows grow with the texts and not with the pairs;
    # counts are partial before they are shuffled.
    used = found.select(F.explode(_terms("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    terms = salted_join(saved(held.select("_key", F.explode(_terms("text")).alias("term")), "terms"), used, ["term"])
    most = F.pow(F.col("seen"), F.lit(GENERALISE)) * F.pow(F.lit(float(total)), F.lit(1 - GENERALISE))
    pairs = terms.join(sets, "_key").where(F.col("docs") <= most * 1.000001)
    pairs = saved(pairs.select("_key", "copies", "group", "seen", "term", "docs"), "pairs")
    counts = pairs.groupBy("group", "term").agg(
        F.sum("copies").alias("both"), F.max("seen").alias("seen"), F.max("docs").alias("docs")
    )
    c, t = F.col("seen").cast("double"), F.col("docs").cast("double")
    shared = F.log(F.col("both") * F.lit(float(total)) / (c * t))
    strength = F.when(c >= total, F.lit(0.0)).otherwise(F.least(shared / F.log(total / c), F.lit(1.0)))
    strong = saved(
        counts.select("group", "term", strength.alias("strength")).where(F.col("strength") >= GENERALISE), "revealing"
    )
    told = salted_join(pairs.select("_key", "group", "term"), strong, ["group", "term"])
    return told.groupBy("_key", "term").agg(F.max("strength").alias("strength"))


def marked(held: DataFrame, told: DataFrame) -> DataFrame:
    """``_key`` and ``terms``: every place of a text's revealing terms, but those inside entities."""
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    words = F.zip_with(F.split(text, F.lit(TERM), -1), found, lambda p, f: F.struct(
        F.length(p).alias("gap"), f.alias("word"),
    ))
    words = held.select("_key", F.posexplode(F.slice(words, F.lit(1), F.size(found))).alias("at", "w"))
    # Sums over a text's words, not an array grown word by word: its time is linear.
    before = Window.partitionBy("_key").orderBy("at")
    end = F.sum((F.col("w.gap") + F.length("w.word")).cast("bigint")).over(before)
    words = words.select(
        "_key", (end - F.length("w.word")).alias("start"), end.alias("end"), F.lower("w.word").alias("term")
    )
    words = words.join(told, ["_key", "term"]).select("_key", "start", "end", "term", "strength")
    spans = held.select("_key", F.explode("spans").alias("s")).select(
        "_key", "s.start", "s.end", F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("strength")
    )
    covered = F.max(F.when(F.col("term").isNull(), F.col("end"))).over(
        Window.partitionBy("_key").orderBy("start", F.col("term").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    )
    free = words.unionByName(spans).withColumn("covered", F.coalesce(covered, F.lit(0)))
    return free.where(F.col("term").isNotNull() & (F.col("end") > F.col("covered"))).groupBy("_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "term", "strength"))).alias("terms")
    )


def find_private(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` (null is empty), spans per kind, and ``terms`` with their strength.

    Base spans depend on the text only. ``terms`` are all words of a text that
    reveal an entity of it (:func:`revealing`), wherever they stand; those from
    strength 0.85 are to be removed, others generalised. A word is a run of
    letters, marks and digits of any length, also where a script has no blanks.
    Repeated rows give repeated results; an empty table gives none.
    """
    found = saved(with_spans(docs), "spans")
    held = saved(holders(found), "holders")
    terms = saved(marked(held, saved(revealing(found, held), "told")), "marked")
    # Rows with an entity are joined, one text may be many of them; others pass.
    with_any = F.size(named_spans()) > 0
    none = F.array().cast("array<struct<start:bigint,end:bigint,term:string,strength:double>>")
    joined = salted_join(found.where(with_any), terms, ["_key"], "left").withColumn("terms", F.coalesce("terms", none))
    return joined.unionByName(found.where(~with_any).withColumn("terms", none)).drop("_key")


def sanitised(found: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with entities replaced by their kind and revealing terms
    generalised to ``<term>`` or removed; spans that overlap are replaced as one, by the first.
    """
    marks = F.array_sort(F.concat(
        F.transform(named_spans(), lambda x: F.struct(
            x["start"].alias("start"), F.lit(0).alias("rank"), x["end"].alias("end"), x["put"].alias("put"),
        )),
        F.transform("terms", lambda x: F.struct(
            x["start"].alias("start"), F.lit(1).alias("rank"), x["end"].alias("end"),
            F.when(x["strength"] >= REMOVE, F.lit("")).otherwise(F.lit("<term>")).alias("put"),
        )),
    ))

    def step(state, x):
        kept = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        more = F.when(x["start"] < state["at"], state["out"]).otherwise(F.concat(state["out"], kept, x["put"]))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = F.length("text").cast("int")
    text = F.aggregate(
        marks, start, step,
        lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), rest)),
    )
    return found.select("doc_id", text.alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and spans per document, from :func:`find_private`."""

    def listed(kind, spans):
        return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["end"]))

    base = F.concat(*[listed(kind, F.col(kind)) for kind in KINDS])
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, listed("term", F.col("terms"))), ",").alias("spans"),
        F.size("terms").cast("bigint").alias("n_terms"),
    )
