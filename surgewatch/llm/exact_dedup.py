"""Grace hash deduplication: equal texts found by comparing complete content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import saved

BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes of distinct content in the table of one bucket.
BUCKET_BYTES = 32 << 20
#: Bytes of distinct content a map task keeps to catch copies before the shuffle.
LOCAL_BYTES = 16 << 20

STAGED = """rid bigint, doc_id bigint, chars bigint, local bigint, text binary, hash bigint,
    n bigint"""
CLASSES = "local bigint, keep_rid bigint, keep_id bigint, group_size bigint, text_sha256 string"


class OpenTable:
    """Open addressing with linear probing; keys are compared byte by byte."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.keys: list[bytes] = []
        self.values: list[list] = []
        self.bytes = 0

    def slot(self, key: bytes, hashed: int) -> int:
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.keys[entry] == key:
                return at
            at = (at + 1) & mask
        return at

    def entry(self, key: bytes, hashed: int) -> list:
        """The value of a key; an empty list for a new one."""
        at = self.slot(key, hashed)
        if self.slots[at] >= 0:
            return self.values[self.slots[at]]
        if len(self.keys) * 2 >= len(self.slots):
            self.slots = [-1] * (len(self.slots) * 2)
            mask = len(self.slots) - 1
            for number, known in enumerate(self.hashes):
                at = known & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = number
            at = self.slot(key, hashed)
        self.slots[at] = len(self.keys)
        self.hashes.append(hashed)
        self.keys.append(key)
        self.values.append([])
        self.bytes += len(key)
        return self.values[-1]


def better(row: tuple, other: tuple) -> bool:
    """Rows are (chars, doc_id, rid): most code points, then smallest doc_id, null last."""
    if row[0] != other[0]:
        return row[0] > other[0]
    if row[1] != other[1]:
        return other[1] is None or (row[1] is not None and row[1] < other[1])
    return row[2] < other[2]


def _rows(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


STAGED_ARROW = pa.schema([
    ("rid", pa.int64()), ("doc_id", pa.int64()), ("chars", pa.int64()), ("local", pa.int64()),
    ("text", pa.binary()), ("hash", pa.int64()), ("n", pa.int64()),
])
CLASSES_ARROW = pa.schema([
    ("local", pa.int64()), ("keep_rid", pa.int64()), ("keep_id", pa.int64()),
    ("group_size", pa.int64()), ("text_sha256", pa.string()),
])


def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row with the content per text of the task's table.

    Whenever the table is full its texts are sent on and it starts empty.
    """
    rid = TaskContext.get().partitionId() << 36
    table = OpenTable()

    def contents(table: OpenTable) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(table.keys), 2000):
            part = slice(low, low + 2000)
            values = table.values[part]
            yield _rows(
                [[v[2][2] for v in values], [v[2][1] for v in values], [v[2][0] for v in values],
                 [v[0] for v in values], table.keys[part], table.hashes[part], [v[1] for v in values]],
                STAGED_ARROW,
            )

    for batch in batches:
        text = pc.fill_null(batch.column("text").cast(pa.string()), "")
        ids = batch.column("doc_id").to_pylist()
        chars = pc.utf8_length(text).to_pylist()
        rids, locals_ = [], []
        for i, raw in enumerate(text.cast(pa.binary()).to_pylist()):
            key = raw.translate(None, BLANKS)
            hashed = xxhash.xxh3_64_intdigest(key) - (1 << 63)
            value = table.entry(key, hashed)
            row = (chars[i], ids[i], rid)
            if not value:
                value[:] = [rid, 0, row]
            value[1] += 1
            if better(row, value[2]):
                value[2] = row
            rids.append(rid)
            locals_.append(value[0])
            rid += 1
            if table.bytes > LOCAL_BYTES:
                yield from contents(table)
                table = OpenTable()
        none = [None] * len(ids)
        yield _rows([rids, ids, chars, locals_, none, none, none], STAGED_ARROW)
    yield from contents(table)


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of equal content; rows come bucket by bucket, one table for each."""
    table, bucket = OpenTable(), None

    def classes(table: OpenTable) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], [], []]
        for key, (best, size, members) in zip(table.keys, table.values, strict=True):
            digest = hashlib.sha256(key).hexdigest()
            for local in members:
                for column, x in zip(columns, (local, best[2], best[1], size, digest), strict=True):
                    column.append(x)
            if len(columns[0]) >= 5000:
                yield _rows(columns, CLASSES_ARROW)
                columns = [[], [], [], [], []]
        yield _rows(columns, CLASSES_ARROW)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "text", "hash", "rid", "doc_id", "chars", "local", "n")]
        for at, key, hashed, rid, doc_id, chars, local, n in zip(*columns, strict=True):
            if at != bucket:
                if table.keys:
                    yield from classes(table)
                table, bucket = OpenTable(), at
            value = table.entry(key, hashed)
            row = (chars, doc_id, rid)
            if not value:
                value[:] = [row, 0, []]
            elif better(row, value[0]):
                value[0] = row
            value[1] += n
            value[2].append(local)
    yield from classes(table)


def bucket_bits(contents: DataFrame, limit: int) -> int:
    """Hash bits after which every bucket's distinct content fits ``limit`` bytes.

    Buckets are split in two, again and again, until each fits or is one text.
    """
    sizes = contents.groupBy("hash").agg(F.max(F.octet_length("text")).alias("bytes"))
    sizes = saved(sizes, "sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    bits = max(0, (2 * total // limit).bit_length())
    while bits < 62:
        bucket = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0)
        filled = sizes.groupBy(bucket.alias("bucket")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("texts")
        )
        if filled.where((F.col("bytes") > limit) & (F.col("texts") > 1)).isEmpty():
            break
        bits += 1
    return bits


def exact_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per document.

    Texts are equal if identical without blanks (space, tab to carriage
    return); null is empty. Of equal texts the longest original stays, then the
    smallest ``doc_id`` (null last), then the first read, so of wholly repeated
    rows exactly one is kept. Other columns are not read.

    Map tasks catch copies in a table of bounded size, so a text that makes up
    a third of all rows is sent on a few times a task. The contents are then
    dealt to shuffle files by hash bits, as many as make each bucket fit its
    open-addressing table, and compared in full.
    """
    staged = saved(
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(stage, STAGED),
        "staged",
    )
    contents = staged.where("text is not null")
    bits = bucket_bits(contents, bucket_bytes)
    bucket = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("bigint")
    classes = (
        contents.withColumn("bucket", bucket)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(compare, CLASSES)
    )
    members = staged.where("text is null").select("rid", "doc_id", "local")
    return members.join(classes, "local").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
    )
