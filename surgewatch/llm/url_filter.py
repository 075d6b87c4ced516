"""Url filter: rules by host and path, and a tree of path templates per host."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import once, salted_join, saved
from surgewatch.operators.sizing import fits_broadcast

#: Rules: verdict, host and path. A rule holds for the host and all below it, and for paths that start with its own.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: A segment, shape or branch is told apart in its host's tree from so many urls on ...
LEAST = 5
#: ... and this share of the host's urls; so a host's tree has 1 / SHARE branches at most at each depth.
SHARE = 0.01
#: Deeper segments of a path are one wildcard.
DEEPEST = 32
#: Chance of keeping apart two branches that do not differ (bound of Hoeffding).
ALPHA = 0.05
#: Weight, in labelled urls, of what is known above a branch.
WEIGHT = 2
#: A template is rejected from this smoothed share of blocked among labelled urls on.
REJECT = 0.9

#: Segments are kept with a first character that tells what they are.
LITERAL, SHAPE, OTHER = "=", "~", "*"
#: Between the segments of a branch's name; paths have none within segments.
SEP = "/"

MODEL = "host string, branches map<string,struct<template:string,purity:double,labelled:bigint,rejected:boolean>>"
MODEL_ARROW = pa.schema([
    ("host", pa.string()),
    ("branches", pa.map_(pa.string(), pa.struct([
        ("template", pa.string()), ("purity", pa.float64()), ("labelled", pa.int64()), ("rejected", pa.bool_()),
    ]))),
])


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://`` up to ``/``, ``?`` or ``#``, and then up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. Of equal ones the first counts."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """A segment with its runs of digits, and of hexadecimal digits with a digit among eight or more, made ``#``."""
    hexed = F.regexp_replace(segment, r"(?i)(?<![0-9a-z])(?=[a-f]*[0-9])[0-9a-f]{8,}(?![0-9a-z])", "#")
    return F.regexp_replace(hexed, r"[0-9]+", "#")


def segments(path: Column) -> Column:
    """The path's segments with their depths, from 1; empty ones, as from a slash at the end, do not count.

    After ``DEEPEST`` segments an empty one stands for the rest.
    """
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    rest = F.when(F.size(parts) > DEEPEST, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.transform(
        F.concat(F.slice(parts, 1, DEEPEST), rest), lambda s, i: F.struct((i + 1).alias("depth"), s.alias("segment"), shape(s).alias("shape"))
    )


def frequent_segments(rows: DataFrame) -> DataFrame:
    """``host, n, known``: urls of each host, and which segments and shapes stand in enough of them.

    ``known`` has at most ``2 / SHARE`` entries a depth. Counts are combined
    before the shuffle, so a host with a third of all urls is no hot key.
    """
    sizes = saved(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    entry = F.explode(
        F.flatten(
            F.transform(
                "parts",
                lambda p: F.filter(
                    F.array(F.when(p["segment"] != "", name(LITERAL, p["depth"], p["segment"])), F.when(p["shape"] != p["segment"], name(SHAPE, p["depth"], p["shape"]))),
                    lambda x: x.isNotNull(),
                ),
            )
        )
    )
    counts = rows.select("host", entry.alias("entry")).groupBy("host", "entry").agg(F.count(F.lit(1)).alias("c"))
    counts = saved(counts.where(F.col("c") >= LEAST), "segments")
    enough = salted_join(counts, sizes, ["host"]).where(F.col("c") >= SHARE * F.col("n"))
    known = enough.groupBy("host").agg(F.collect_list("entry").alias("known"))
    return sizes.join(known, "host", "left").select("host", "n", F.coalesce("known", F.array().cast("array<string>")).alias("known"))


def name(kind: str, depth: Column, value: Column) -> Column:
    return F.concat(F.lit(kind), depth.cast("string"), F.lit(SEP), value)


def template(parts: Column, known: Column) -> Column:
    """The path with segments that vary made wildcards: their shape, if it is frequent, or any.

    Any number of such segments in a row are one, so odd long paths stay short.
    """
    pieces = F.transform(
        parts,
        lambda p: F.when(F.array_contains(known, name(LITERAL, p["depth"], p["segment"])), F.concat(F.lit(LITERAL), p["segment"]))
        .when(F.array_contains(known, name(SHAPE, p["depth"], p["shape"])), F.concat(F.lit(SHAPE), p["shape"]))
        .otherwise(OTHER),
    )
    return once(
        pieces,
        lambda a: F.filter(a, lambda x, i: (i == 0) | (x != OTHER) | (F.get(a, F.greatest(i - 1, F.lit(0))) != OTHER)),
    )


def prefixes(parts: Column) -> Column:
    """Names of a template's branches from the root on: its first segments, none to all."""
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), SEP)
    )


@dataclass
class Branch:
    """Urls under a place of the tree, and of them the labelled and the blocked ones."""

    rows: int = 0
    labelled: int = 0
    blocked: int = 0
    below: dict[str, Branch] = field(default_factory=dict)

    def joined(self, other: Branch) -> Branch:
        """Both branches laid on each other."""
        below = dict(self.below)
        for key, branch in other.below.items():
            below[key] = below[key].joined(branch) if key in below else branch
        return Branch(self.rows + other.rows, self.labelled + other.labelled, self.blocked + other.blocked, below)


def differ(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    """Whether shares ``a / n`` and ``b / m`` differ by more than chance."""
    if not n or not m:
        return False
    return abs(a / n - b / m) > (math.sqrt(1 / n) + math.sqrt(1 / m)) * math.sqrt(math.log(2 / alpha) / 2)


def alike(a: Branch, b: Branch, alpha: float) -> bool:
    """Whether two branches may be one: alike in labels and, down the tree, in what is below.

    A branch without labels is alike only to others without: its purity is unknown.
    """
    if (a.labelled == 0) != (b.labelled == 0) or differ(a.blocked, a.labelled, b.blocked, b.labelled, alpha):
        return False
    none = Branch()
    for key in a.below.keys() | b.below.keys():
        x, y = a.below.get(key, none), b.below.get(key, none)
        if differ(x.rows, a.rows, y.rows, b.rows, alpha):
            return False
        if x.rows and y.rows and not alike(x, y, alpha):
            return False
    return True


def shown(keys: list[str]) -> str:
    """A merged segment in words: values, ``{#}`` for shapes and ``{*}`` for any."""
    words = sorted(key[1:] if key[0] == LITERAL else "{" + (key[1:] or "*") + "}" for key in keys)
    return words[0] if len(words) == 1 else "(" + "|".join(words) + ")"


def judged(branches: list[tuple[str, int, int, int]], alpha: float, weight: float, reject: float) -> dict[str, tuple]:
    """``template, purity, labelled, rejected`` of each branch of a host's tree.

    ``branches`` has names and numbers of urls, the root among them. From the
    root on, the branches below a place are merged with the first that they are
    like, the largest first; the merged one goes on with both's branches.
    Purity is the share of blocked among labelled urls, smoothed towards that
    of the place above, or 1/2 if that is more, so that no template is rejected
    without labels of its own.
    """
    tree: dict[str, Branch] = {}
    for label, rows, labelled, blocked in sorted(branches):
        tree[label] = Branch(rows, labelled, blocked)
    for label, branch in tree.items():
        if label:
            above, _, key = label.rpartition(SEP)
            tree[above].below[key] = branch
    found: dict[str, tuple] = {}
    # Each entry: a merged branch, the names it stands for, its template, and the purity above it.
    todo = [(tree[""], [""], "", 0.5)]
    while todo:
        branch, names, text, above = todo.pop()
        prior = min(above, 0.5)
        purity = (branch.blocked + weight * prior) / (branch.labelled + weight)
        for label in names:
            found[label] = text or SEP, purity, branch.labelled, branch.labelled > 0 and purity >= reject
        merged: list[tuple[Branch, list[str]]] = []
        for key, below in sorted(branch.below.items(), key=lambda x: (-x[1].rows, x[0])):
            for i, (other, keys) in enumerate(merged):
                if alike(other, below, alpha):
                    merged[i] = other.joined(below), [*keys, key]
                    break
            else:
                merged.append((below, [key]))
        for below, keys in merged:
            labels = [f"{label}{SEP}{key}" if label else key for label in names for key in keys]
            labels = [label for label in labels if label in tree]
            todo.append((below, labels, f"{text}{SEP}{shown(keys)}", purity))
    return found


def model(alpha: float, weight: float, reject: float):
    """The judged tree of each host, of rows with the host's branches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = []
            for tree in batch.column("tree").to_pylist():
                found = judged([(b["name"], b["rows"], b["labelled"], b["blocked"]) for b in tree], alpha, weight, reject)
                names = ("template", "purity", "labelled", "rejected")
                trees.append([(label, dict(zip(names, values, strict=True))) for label, values in found.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(trees, MODEL_ARROW.field("branches").type)], schema=MODEL_ARROW
            )

    return run


def by_host(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with their host's row of ``table``, which is broadcast if it was measured to be small."""
    measured = table.select("host", *[F.to_json(F.struct(c)).alias(c) for c in table.columns if c != "host"])
    if fits_broadcast(measured):
        return rows.join(F.broadcast(table), "host")
    return salted_join(rows, table, ["host"])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    labels: DataFrame | None = None,
    alpha: float = ALPHA,
    weight: float = WEIGHT,
    reject: float = REJECT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity, labelled`` per row of ``pages``.

    ``rules`` are pairs of a verdict and ``host/path``; the longest that fits a
    url decides. All other urls are judged by their host's tree of path
    templates. Its labels are the verdicts of the rules, so what rules say of
    some urls of a template holds for the rest of it; or give ``labels``
    (``url, blocked``, several rows of a url allowed, nulls ignored).

    Segments of a path that stand in few of the host's urls become wildcards,
    first their shape (digits made ``#``), and if that is rare too, any; places
    of the tree with few urls are left out and their urls judged one place
    further up. Branches that are statistically alike are merged, and templates
    whose smoothed share of blocked labels reaches ``reject`` are blocked; all
    others are allowed, also where nothing is labelled. ``purity`` is that
    share and ``labelled`` the labels behind it, whether a rule decided or not.

    Null urls and urls without ``://`` have an empty host and path, which is a
    host like others. Repeated rows and null ids each have a result; other
    columns are not read. An empty table gives none.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), url.alias("url"))
    if labels is None:
        rows = parsed(rows, rules).drop("url")
        said = F.col("verdict").isNotNull(), F.col("verdict") == "block"
    else:
        given = labels.where("blocked is not null and url is not null").groupBy(F.col("url").cast("string").alias("url"))
        given = given.agg(F.count(F.lit(1)).alias("_all"), F.sum(F.col("blocked").cast("int")).alias("_bad"))
        some = salted_join(rows.where("url is not null"), given, ["url"], "left")
        none = rows.where("url is null").select("url", "page_id", *[F.lit(None).cast("bigint").alias(c) for c in ("_all", "_bad")])
        rows = parsed(some.unionByName(none), rules).drop("url")
        said = F.col("_all").isNotNull(), 2 * F.col("_bad") > F.col("_all")
    rows = rows.select(
        "*", said[0].cast("int").alias("is_labelled"), F.coalesce(said[1], F.lit(False)).cast("int").alias("is_blocked"),
        segments(F.col("path")).alias("parts"),
    )
    hosts = saved(frequent_segments(rows), "url-hosts")
    rows = by_host(rows, hosts).select(
        "page_id", "host", "path", "rule", "verdict", "is_labelled", "is_blocked", "n",
        template(F.col("parts"), F.col("known")).alias("parts"),
    )
    rows = saved(rows, "url-templates")

    counted = rows.groupBy("host", "n", "parts").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("is_labelled").alias("labelled"), F.sum("is_blocked").alias("blocked")
    )
    places = counted.select("host", "n", F.explode(prefixes(F.col("parts"))).alias("name"), "rows", "labelled", "blocked")
    places = places.groupBy("host", "n", "name").agg(*[F.sum(c).alias(c) for c in ("rows", "labelled", "blocked")])
    enough = (F.col("name") == "") | ((F.col("rows") >= LEAST) & (F.col("rows") >= SHARE * F.col("n")))
    trees = places.where(enough).groupBy("host").agg(
        F.collect_list(F.struct("name", "rows", "labelled", "blocked")).alias("tree")
    )
    models = saved(trees.mapInArrow(model(alpha, weight, reject), MODEL), "url-models")

    found = by_host(rows, models)
    deepest = F.aggregate(
        prefixes(F.col("parts")),
        F.col("branches")[""],
        lambda best, label: F.coalesce(F.try_element_at(F.col("branches"), label), best),
    )
    found = found.withColumn("found", deepest)
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("found.rejected"), "block").otherwise("allow")).alias("verdict"),
        F.col("found.template").alias("template"), F.col("found.purity").alias("purity"),
        F.col("found.labelled").alias("labelled"),
    )


def parsed(rows: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """The rows with ``host, path, rule, verdict``."""
    host, path = url_parts(F.col("url"))
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("verdict"))

