"""Repeated-phrase automata: passages that recur across documents, found and removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import salted_join, saved

#: Words of a window, and of the phrase that a window is filed under.
WINDOW = 50
PHRASE = 8
#: Characters of segments that one automaton's shard is made of, on average.
SHARD_CHARS = 2 << 20
#: Segments of one phrase that an automaton takes: they are in one shard, so this
#: bounds a shard's memory, some 1 MB of text, beside what it holds on average.
PHRASE_SEGMENTS = 1000
#: Windows of a segment at most.
SEGMENT_WINDOWS = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)


def phrase_hashes(words: list[bytes], size: int = PHRASE) -> np.ndarray:
    """A 64-bit hash of the phrase that starts at each word."""
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    last = len(words) - size + 1
    found = hashes[:last].copy()
    for i in range(1, size):
        found = (found ^ (found >> np.uint64(29))) * _ODD + hashes[i : last + i]
    return found ^ (found >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values


def segments(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, first window, windows) of each run of windows filed under one phrase.

    A window's phrase is the one of its phrases with the smallest hash, so
    equal windows are filed under the same phrase wherever they stand.
    """
    size = min(PHRASE, window)
    if len(words) < window:
        none = np.empty(0, np.int64)
        return none, none, none
    least = sliding_min(phrase_hashes(words, size), window - size + 1)
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.concatenate(([0], change))
    counts = np.diff(np.concatenate((starts, [len(least)])))
    if counts.max() > SEGMENT_WINDOWS:  # a phrase that repeats all the time
        cut = [np.arange(s, s + c, SEGMENT_WINDOWS) for s, c in zip(starts, counts, strict=True)]
        starts = np.concatenate(cut)
        counts = np.diff(np.concatenate((starts, [len(least)])))
    return least[starts].view(np.int64), starts.astype(np.int64), counts.astype(np.int64)


def filer(window: int):
    """A row per document without a phrase, and a row per segment with one."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "key", "n_words", "kept_sha256", "phrase", "first", "windows"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows: list[list] = [[] for _ in names]

            def add(*values):
                for column, value in zip(rows, values, strict=True):
                    column.append(value)

            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), texts, strict=True):
                words = raw.split() if raw else []
                add(doc_id, key, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), None, None, None)
                for phrase, first, count in zip(*(x.tolist() for x in segments(words, window)), strict=True):
                    add(doc_id, key, None, None, phrase, first, count)
                if len(rows[0]) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)
                    rows = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)

    return file


FILED = """doc_id bigint, key string, n_words bigint, kept_sha256 string, phrase bigint,
    first bigint, windows bigint"""


def cutter(window: int):
    """The text of each segment listed for a document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "key", "phrase", "first", "text", "hot"]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "key", "listed")]
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, key, listed, raw in zip(*columns, texts, strict=True):
                words = raw.split()
                for one in listed:
                    part = words[one["first"] : one["first"] + one["windows"] + window - 1]
                    for column, value in zip(
                        rows, (doc_id, key, one["phrase"], one["first"], b" ".join(part), one["hot"]), strict=True
                    ):
                        column.append(value)
                if len(rows[0]) > 20_000:
                    yield _segment_rows(rows, names)
                    rows = [[] for _ in names]
            yield _segment_rows(rows, names)

    return cut


def _segment_rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)


class Shard:
    """Segments filed under the phrases of one shard, and the automaton over them.

    Segments come in ascending doc_id, null last, so the first document that
    has a window owns it.
    """

    def __init__(self, window: int) -> None:
        self.window = window
        self.rows: list[tuple[int | None, str, int, list[str]]] = []

    def add(self, doc_id: int | None, key: str, first: int, text: str) -> None:
        self.rows.append((doc_id, key, first, text.split(" ")))

    def passages(self) -> dict[str, int]:
        """Confirmed passages: windows in a row with one owner that others have too."""
        owner: dict[str, int] = {}
        shared: set[str] = set()
        own: list[list[str]] = []
        for doc_id, _, _, words in self.rows:
            text = " ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            begins = [0, *ends[:-1].tolist()]
            last = (ends - 1).tolist()
            keys = [
                hashlib.blake2b(text[begins[i] : last[i + self.window - 1]].encode(), digest_size=16).digest()
                for i in range(len(words) - self.window + 1)
            ]
            own.append(keys)
            for one in keys:
                if one not in owner:
                    owner[one] = doc_id
                elif owner[one] is not None and owner[one] != doc_id:
                    shared.add(one)
        found: dict[str, int] = {}
        for (_, _, _, words), keys in zip(self.rows, own, strict=True):
            start = None
            for i in range(len(keys) + 1):
                here = owner[keys[i]] if i < len(keys) and keys[i] in shared else None
                if start is not None and (here is None or here != owner[keys[start]]):
                    found[" ".join(words[start : i - 1 + self.window])] = owner[keys[start]]
                    start = None
                if start is None and here is not None:
                    start = i
        return found

    def removed(self) -> Iterator[tuple[int | None, str, int, int]]:
        """(doc_id, key, first, end) of words in passages that an earlier document owns."""
        passages = self.passages()
        if not passages:
            return
        automaton = ahocorasick.Automaton()
        for text, owner in passages.items():
            automaton.add_word(f" {text} ", (owner, len(text)))
        automaton.make_automaton()
        for doc_id, key, first, words in self.rows:
            line = f" {' '.join(words)} "
            starts = None
            spans: list[list[int]] = []
            for end, (owner, length) in automaton.iter(line):
                if doc_id is not None and owner >= doc_id:
                    continue
                if starts is None:  # word number by place
                    starts = {0: 0}
                    at = 0
                    for i, word in enumerate(words):
                        at += len(word) + 1
                        starts[at] = i + 1
                low, high = starts[end - length - 1], starts[end]
                spans.append([low, high])
            merged: list[list[int]] = []
            for low, high in sorted(spans):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                yield doc_id, key, first + low, first + high


def locator(window: int):
    """Spans to remove; rows come shard by shard, in each by document."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["doc_id", "key", "low", "high"], [pa.int64(), pa.string(), pa.int64(), pa.int64()]

        def out(shard: Shard) -> pa.RecordBatch:
            rows = list(shard.removed())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        shard, number = Shard(window), None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "doc_id", "key", "first", "text")]
            for at, doc_id, key, first, text in zip(*columns, strict=True):
                if at != number:
                    if shard.rows:
                        yield out(shard)
                    shard, number = Shard(window), at
                shard.add(doc_id, key, first, text)
        if shard.rows:
            yield out(shard)

    return locate


def keeper():
    """Kept words of a document without the spans listed for it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            for spans, raw in zip(
                batch.column("spans").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True
            ):
                words, kept, at = raw.split(), [], 0
                for span in sorted((s["low"], s["high"]) for s in spans):
                    kept.extend(words[at : max(at, span[0])])
                    at = max(at, span[1])
                kept.extend(words[at:])
                counts.append(len(words) - len(kept))
                texts.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "key", "n_removed", "kept"],
            )

    return keep


def _same(left: str, right: str):
    return (F.col(f"{left}.key") == F.col(f"{right}.key")) & F.col(f"{left}.doc_id").eqNullSafe(
        F.col(f"{right}.doc_id")
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row, and ``kept``, the text where words went.

    Words are separated by space and tab to carriage return. A word goes if a
    window of ``window`` words over it also starts in a document with a smaller
    doc_id, judged on the input. A null doc_id is larger than all others, and
    rows with the same id do not remove each other's words. A null text has no
    words. Repeated rows give repeated results. ``kept`` is null where nothing
    was removed, and in copies whose every word goes.

    Of equal texts the smallest doc_id's is searched; from the other copies
    everything goes. Windows are filed under phrases; phrases of one document
    are dropped. Segments (runs of windows under a phrase) are dealt to shards
    by phrase, each small enough for an automaton. A shard confirms which
    passages recur, and its automaton finds all places of them.
    """
    plain = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("key", F.md5("text"))
    filed = saved(plain.mapInArrow(filer(window), FILED), "filed")
    base = filed.where("phrase is null").select("doc_id", "key", "n_words", "kept_sha256")
    least = saved(base.groupBy("key").agg(F.min("doc_id").alias("doc_id")), "copies")
    # One row for a segment of all copies of a text.
    runs = filed.where("phrase is not null").groupBy("key", "phrase", "first", "windows").agg(
        F.min("doc_id").alias("doc_id")
    )
    runs = saved(runs, "runs")
    short = F.xxhash64("key")
    recurring = runs.groupBy("phrase").agg(
        F.min(short).alias("a"), F.max(short).alias("b"), F.count(F.lit(1)).alias("m")
    ).where("a <> b")
    hot = recurring.select("phrase", (F.col("m") > PHRASE_SEGMENTS).alias("hot"))
    listed = salted_join(runs, hot, ["phrase"]).groupBy("key", "doc_id").agg(
        F.collect_list(F.struct("phrase", "first", "windows", "hot")).alias("listed")
    )
    wanted = plain.alias("d").join(listed.alias("l"), _same("d", "l")).select(
        "d.doc_id", "d.key", "d.text", "l.listed"
    ).dropDuplicates(["key"])
    wanted = saved(wanted, "wanted")
    cut = wanted.mapInArrow(
        cutter(window), "doc_id bigint, key string, phrase bigint, first bigint, text string, hot boolean"
    )
    spans = _located(cut, wanted, window)
    spans = spans.groupBy("doc_id", "key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    kept = wanted.alias("w").join(spans.alias("s"), _same("w", "s")).select(
        "w.doc_id", "w.key", "w.text", "s.spans"
    ).mapInArrow(keeper(), "doc_id bigint, key string, n_removed bigint, kept string")
    kept = saved(kept, "kept").alias("k")
    first = salted_join(base, least.select("key", F.col("doc_id").alias("least")), ["key"])
    result = first.alias("b").join(kept, _same("b", "k"), "left")
    copy = (F.col("b.least") < F.coalesce(F.col("b.doc_id"), F.lit((1 << 63) - 1))) & (
        F.col("b.n_words") >= window
    )
    return result.select(
        "b.doc_id", "b.n_words",
        F.when(copy, F.col("b.n_words")).otherwise(F.coalesce("k.n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(
            F.coalesce(F.sha2("k.kept", 256), F.col("b.kept_sha256"))
        ).alias("kept_sha256"),
        F.when(~copy, F.col("k.kept")).alias("kept"),
    )


def _located(cut: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Spans to remove from the documents whose segments ``cut`` has.

    A phrase with over ``PHRASE_SEGMENTS`` segments, at any size of the table, is
    split by the segments' windows: each of its windows alone, filed under its
    own hash. So an automaton never holds more of one phrase.
    """
    sizes = wanted.agg(F.sum(F.size("listed")).alias("n")).first()["n"] or 0
    mean = window * 2 * 8  # characters of a segment, roughly
    shards = max(1, sizes * mean // SHARD_CHARS)
    words = F.split("text", " ")
    last = F.size(words) - window + 1
    single = F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(
        (F.col("first") + i - 1).alias("first"), F.array_join(F.slice(words, i, window), " ").alias("text"),
    ))
    cold = cut.where("not hot").select(
        F.pmod(F.xxhash64("phrase"), F.lit(shards)).alias("shard"), "doc_id", "key", "first", "text"
    )
    split = cut.where("hot").select("doc_id", "key", F.explode(single).alias("s")).select(
        "doc_id", "key", "s.first", "s.text"
    )
    # A window of a hot phrase needs no automaton: its owner is the least document.
    owner = split.groupBy(F.sha2("text", 256).alias("w")).agg(
        F.min("doc_id").alias("owner"), F.max(F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("top")
    ).where("owner < top").select("w", "owner")
    found = salted_join(split.select("doc_id", "key", "first", F.sha2("text", 256).alias("w")), owner, ["w"])
    hot_spans = found.where(F.col("owner") < F.coalesce("doc_id", F.lit((1 << 63) - 1))).select(
        "doc_id", "key", F.col("first").alias("low"), (F.col("first") + window).alias("high")
    )
    ordered = cold.repartition("shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last())
    located = ordered.mapInArrow(locator(window), "doc_id bigint, key string, low bigint, high bigint")
    return located.unionByName(hot_spans)
