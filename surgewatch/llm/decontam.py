"""Wu-Manber search for benchmark passages in documents."""

from __future__ import annotations

import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import renamed, saved

#: Words of a window.
WINDOW = 10
#: Bytes of benchmark text searched for in one pass. The driver holds and broadcasts the
#: text; each Python worker compiles it to tables of some 10 times its size.
BLOCK_BYTES = 32 << 20

# Bytes that separate words, and lower case of A-Z.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
FOLD = bytes(
    0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)

FOUND = "n_words bigint, starts array<bigint>, ends array<bigint>, item_ids array<string>"


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(FOLD).split() if raw else []


class WuManber:
    """Tables for patterns of one length, of some 50 bytes a pattern.

    ``shift`` tells how far to go on from a block of words: blocks are hashed to
    its slots, and those of one slot share the least shift. Where it is 0, the
    hash of the words before that place leads to a bucket, a chain of patterns,
    and the one equal to these words is found by comparing them.
    """

    def __init__(self, length: int, patterns: int, items: list[str | None]) -> None:
        self.length = length
        self.block = min(2, length)
        self.skip = min(length - self.block + 1, 255)
        slots = 1 << max(10, (8 * patterns).bit_length())
        self.slot_mask, self.bucket_mask = slots - 1, (slots >> 2) - 1
        self.shift = bytearray([self.skip]) * slots
        self.heads = array("i", [-1]) * (slots >> 2)
        self.chain, self.begin, self.end, self.item = array("i"), array("q"), array("q"), array("i")
        self.shared: dict[int, set[int]] = {}
        self.text = bytearray()
        self.items = items

    def add(self, words: list[bytes], item: int) -> None:
        """All windows of an item; ``item`` is its number in ``items``."""
        length, block, digest = self.length, self.block, xxhash.xxh3_64_intdigest
        for last in range(block - 1, len(words)):
            slot = digest(b" ".join(words[last - block + 1 : last + 1])) & self.slot_mask
            # Windows end with each word from the first window's last one on.
            self.shift[slot] = min(self.shift[slot], max(0, length - 1 - last))
        at = len(self.text)
        begins = [at, *(at + n for n in accumulate(len(w) + 1 for w in words))]
        self.text += b" ".join(words) + b" "
        for first in range(len(words) - length + 1):
            begin, end = begins[first], begins[first + length] - 1
            key = self.text[begin:end]
            bucket = digest(key) & self.bucket_mask
            known = self._pattern(key, bucket)
            if known >= 0:
                if self.item[known] != item:
                    self.shared.setdefault(known, set()).add(item)
                continue
            self.chain.append(self.heads[bucket])
            self.heads[bucket] = len(self.begin)
            self.begin.append(begin)
            self.end.append(end)
            self.item.append(item)

    def _pattern(self, key: bytes, bucket: int) -> int:
        at = self.heads[bucket]
        while at >= 0 and self.text[self.begin[at] : self.end[at]] != key:
            at = self.chain[at]
        return at

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of each occurrence, from left to right."""
        length, pair, digest = self.length, self.block == 2, xxhash.xxh3_64_intdigest
        shifts, mask = self.shift, self.slot_mask
        at, n = length - 1, len(words)
        while at < n:
            shift = shifts[digest(words[at - 1] + b" " + words[at] if pair else words[at]) & mask]
            if shift:
                at += shift
                continue
            first = at - length + 1
            key = b" ".join(words[first : at + 1])
            found = self._pattern(key, digest(key) & self.bucket_mask)
            if found >= 0:
                yield first, found
            at += 1

    def items_of(self, pattern: int) -> set[str | None]:
        return {self.items[i] for i in (self.item[pattern], *self.shared.get(pattern, ()))}


def compiled(rows: list[tuple[str | None, bytes | None]], window: int) -> list[WuManber]:
    """Tables by pattern length: windows, and whole items that are shorter."""
    sizes = Counter()
    for _, raw in rows:
        n = len(words_of(raw))
        sizes[min(window, n)] += max(1, n - window + 1)
    items = [item for item, _ in rows]
    tables = {length: WuManber(length, sizes[length], items) for length in sizes if length}
    for item, (_, raw) in enumerate(rows):
        words = words_of(raw)
        if words:
            tables[min(window, len(words))].add(words, item)
    return list(tables.values())


#: The tables a worker compiled last, by the block's name.
_TABLES: dict[str, list[WuManber]] = {}


def _tables(name: str, rows, window: int) -> list[WuManber]:
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = compiled(rows.value, window)
    return _TABLES[name]


def scanner(rows, name: str, window: int, columns: list[str], schema: pa.Schema):
    """Adds the words found to each row; ``rows`` is the broadcast block called ``name``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(name, rows, window)
        for batch in batches:
            counts, starts, ends, items = [], [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(raw)
                spans, found = [], set()
                for table in tables:
                    seen = set()
                    for first, pattern in table.search(words):
                        spans.append((first, first + table.length))
                        if pattern not in seen:
                            seen.add(pattern)
                            found |= table.items_of(pattern)
                merged: list[list[int]] = []
                for first, last in sorted(spans):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last)
                    else:
                        merged.append([first, last])
                counts.append(len(words))
                starts.append([x[0] for x in merged])
                ends.append([x[1] for x in merged])
                items.append(sorted(found - {None}))
            own = [batch.column(c) for c in columns]
            new = [
                pa.array(x, schema.field(len(own) + i).type)
                for i, x in enumerate((counts, starts, ends, items))
            ]
            yield pa.RecordBatch.from_arrays([*own, *new], schema=schema)

    return scan


def _found(docs: DataFrame, rows: list[tuple], window: int, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` (text is read for the search) and what is found."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kept = docs.select(*keep)
    schema = to_arrow_schema(kept.schema)
    for name, kind in (
        ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())), ("item_ids", pa.list_(pa.string())),
    ):
        schema = schema.append(pa.field(name, kind))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))
    return source.mapInArrow(
        scanner(spark.sparkContext.broadcast(rows), uuid.uuid4().hex, window, keep, schema), f"{ddl}, {FOUND}"
    )


class _Blocks:
    """The distinct items of the benchmark in blocks of bounded size, each read when it is needed."""

    def __init__(self, benchmark: DataFrame, block_bytes: int) -> None:
        self.items = benchmark.select(
            F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
        ).distinct()
        total = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count = -(-total // block_bytes) or 1

    def rows(self, block: int) -> list[tuple[str | None, bytes | None]]:
        own = self.items.where(F.pmod(F.xxhash64("item", "text"), F.lit(self.count)) == block)
        return [(r.item, None if r.text is None else r.text.encode()) for r in own.toLocalIterator()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_words``, hit word ranges ``starts, ends`` and ``item_ids`` per document.

    Words are runs of digits, letters and characters beyond ASCII; A-Z are
    lower-cased. Ranges are half open and merged where they touch. An item
    shorter than a window is one window; items without words, or a null text,
    match nothing; an item with a null id marks words and is not listed. A null
    document has no words. Repeated rows give repeated results.

    Test strings are dealt to blocks of about ``block_bytes``, and every document
    is searched with each block; a block's text is broadcast, and each worker
    compiles it once. With one block documents are not shuffled; with more, only those with hits are.
    """
    blocks = _Blocks(benchmark, block_bytes)
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    if blocks.count == 1:
        return _found(docs, blocks.rows(0), window, ["doc_id"])
    keyed = docs.withColumn("_key", F.md5("text"))
    hits = None
    for block in range(blocks.count):
        part = _found(keyed, blocks.rows(block), window, ["doc_id", "_key"])
        part = saved(part.where("size(starts) > 0 or size(item_ids) > 0").dropDuplicates(["doc_id", "_key"]), "hits")
        hits = part if hits is None else hits.unionByName(part)
    span = F.arrays_zip("starts", "ends")
    merged = hits.groupBy("doc_id", "_key").agg(
        F.array_sort(F.flatten(F.collect_list(span))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )

    def join(done, x):
        last = F.element_at(done, -1)
        wider = F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], x["ends"]).alias("ends"))
        touching = (F.size(done) > 0) & (x["starts"] <= F.try_element_at(done, F.lit(-1))["ends"])
        return F.when(
            touching, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))
        ).otherwise(F.array_append(done, x))

    empty = F.array().cast("array<struct<starts:bigint,ends:bigint>>")
    merged = merged.withColumn("spans", F.aggregate("spans", empty, join))
    counts = _found(keyed, [], window, ["doc_id", "_key"]).select("doc_id", "_key", "n_words").alias("c")
    m = merged.alias("m")
    on = F.col("c.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("c._key").eqNullSafe(F.col("m._key"))
    none = F.array().cast("array<bigint>")
    return counts.join(m, on, "left").select(
        "c.doc_id", "c.n_words",
        F.coalesce(F.col("m.spans.starts"), none).alias("starts"),
        F.coalesce(F.col("m.spans.ends"), none).alias("ends"),
        F.coalesce("m.item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of ``docs``, all columns, in which no benchmark passage occurs.

    Each block of test strings is one filter over the rows that are left, which
    are written between blocks so that only one block's tables are in memory.
    """
    blocks = _Blocks(benchmark, block_bytes)
    docs, names = renamed(docs, "text")
    for block in range(blocks.count):
        if block:
            docs = saved(docs, "clean")
        docs = _found(docs, blocks.rows(block), window, docs.columns).where(F.size("starts") == 0).select(*docs.columns)
    return docs.select(*names)


def digest(found: DataFrame) -> DataFrame:
    """Counts per document, from :func:`find_passages`."""
    hit = F.aggregate(
        F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
