"""Token ids in files of independent zstandard frames with a seek table.

A file is, in this order: one zstandard frame per document, with its ids as
little-endian unsigned integers of 2 or 4 bytes; a skippable frame with the
documents' ids; and a seek table as a last skippable frame, in the public
layout for seekable zstandard: per frame the compressed size, the size of the
content and the low 32 bits of the content's XXH64, then the number of frames,
a descriptor and the magic number. Every frame, the index too, is in the table.
Any zstandard tool reads the file from front to back; a reader that wants some
documents reads the table, the index and those documents' frames.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surgewatch.session import scratch_dir

#: Appended to every document.
END_ID = 2
#: Words whose ids a worker remembers.
CACHE_WORDS = 1 << 20
#: Longest word, in characters, that is remembered.
CACHE_CHARS = 32
#: Latin letters, without those that are not a letter any more when normalised or lower-cased.
LETTERS = string.ascii_letters + "".join(
    c for c in map(chr, range(0xC0, 0x149)) if c.isalpha() and len(c.lower()) == 1
)
WORD = re.compile(f"[{LETTERS}]+")
#: Punctuation looked up apart from a word that ends in one of ``ENDS``: it joins with nothing before it.
TAIL = ".,;:!?)]}\"%&$*#"
ENDS = frozenset(LETTERS + string.digits)
LEVEL = 3

# Fixed values of the format.
SKIPPABLE_INDEX, SKIPPABLE_TABLE = 0x184D2A50, 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
NULL_ID = -(1 << 63)

MANIFEST = "shard int, path string, documents bigint, ids bigint, bytes bigint"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """A tokenizer file's content, loaded when first used, and remembered words.

    White space is dropped by this kind of tokenizer, so a text's ids are those
    of its words between blanks, one after the other. A word that ends in a
    letter or digit keeps its ids when punctuation follows it, so the two are
    looked up apart. Words of ``LETTERS`` go to the tokenizer's model at once if
    its first steps replace these letter by letter; all others take every step.
    Ids are kept as little-endian unsigned 32-bit integers.
    """

    def __init__(self, content: str) -> None:
        self.content = content
        self.tokenizer = None
        self.letters: dict[int, str] = {}
        self.known: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {"content": self.content, "tokenizer": None, "letters": {}, "known": {}}

    def _load(self) -> None:
        # Spark runs a worker per core; threads of the tokenizer's own would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(self.content)
        single = {c: self._pieces(c) for c in LETTERS}
        together = ["".join(chain.from_iterable(single.values()))]
        if all(len(x) == 1 for x in single.values()) and self._pieces(LETTERS) == together:
            self.letters = {ord(c): x[0] for c, x in single.items()}

    def _pieces(self, word: str) -> list[str]:
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        found = self.tokenizer.pre_tokenizer
        return [piece for piece, _ in found.pre_tokenize_str(normal)] if found else [normal]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words not met before."""
        known, other, tokenize = self.known, [], self.tokenizer.model.tokenize
        for word in words:
            if self.letters and WORD.fullmatch(word):
                known[word] = _packed([token.id for token in tokenize(word.translate(self.letters))])
            else:
                other.append(word)
        if other:
            ids = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
            known.update((word, _packed(one.ids)) for word, one in zip(other, ids, strict=True))

    def encode(self, text: str) -> np.ndarray:
        if self.tokenizer is None:
            self._load()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        words = text.replace("\n", " ").replace("\t", " ").split(" ")
        new = set(words).difference(known)
        if new:
            whole, split = [], {}
            for word in new:
                core = word.rstrip(TAIL)
                if len(core) < len(word) and core and core[-1] in ENDS:
                    split[word] = core, word[len(core) :]
                else:
                    whole.append(word)
            self._learn(list(set(chain(whole, *split.values())).difference(known)))
            known.update((word, known[core] + known[tail]) for word, (core, tail) in split.items())
        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")
        for word in new:
            if len(word) > CACHE_CHARS:
                del known[word]
                known.pop(split[word][0] if word in split else None, None)
        return ids


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def write_shard(path: str, rows: Iterable[tuple[int | None, np.ndarray]], width: int) -> tuple[int, int, int]:
    """Documents, ids and bytes written. The file appears under its name when complete."""
    files, name = fs.FileSystem.from_uri(path)
    context = TaskContext.get()
    part = f"{name}.{context.taskAttemptId() if context else 0}.part"
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
    entries: list[tuple[int, int, int]] = []
    doc_ids: list[int] = []
    total = size = 0
    with files.open_output_stream(part) as out:

        def put(frame: bytes, content_size: int, checksum: int) -> None:
            nonlocal size
            entries.append((len(frame), content_size, checksum))
            out.write(frame)
            size += len(frame)

        for doc_id, ids in rows:
            content = ids.astype(f"<u{width}").tobytes()
            put(compressor.compress(content), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)
            doc_ids.append(NULL_ID if doc_id is None else doc_id)
            total += len(ids)
        index = struct.pack("<BQ", width, len(doc_ids)) + np.array(doc_ids, "<i8").tobytes()
        put(_skippable(SKIPPABLE_INDEX, index), 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF)
        table = np.array(entries, "<u4").tobytes() + struct.pack("<IBI", len(entries), CHECKSUMS, SEEKABLE)
        out.write(_skippable(SKIPPABLE_TABLE, table))
        size += len(table) + 8
    files.move(part, name)
    return len(doc_ids), total, size


class ShardReader:
    """Reads chosen documents of a file; only their frames are decompressed."""

    def __init__(self, path: str) -> None:
        files, name = fs.FileSystem.from_uri(path)
        self.file = files.open_input_file(name)
        size = self.file.size()
        count, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError(f"no seek table with checksums: {path}")
        start = size - 9 - 12 * count
        self.table = np.frombuffer(self._at(start, 12 * count), "<u4").reshape(count, 3)
        self.offsets = np.concatenate(([0], np.cumsum(self.table[:, 0].astype(np.int64))))
        index = self._at(int(self.offsets[count - 1]), int(self.table[-1, 0]))[8:]
        if xxhash.xxh64_intdigest(index) & 0xFFFFFFFF != self.table[-1, 2]:
            raise ValueError(f"damaged index: {path}")
        self.width, documents = struct.unpack_from("<BQ", index)
        self.doc_ids = np.frombuffer(index, "<i8", documents, 9)
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def doc_id(self, number: int) -> int | None:
        found = int(self.doc_ids[number])
        return None if found == NULL_ID else found

    def ids(self, number: int) -> np.ndarray:
        """Ids of the document of that number in the file; its checksum is verified."""
        frame = self._at(int(self.offsets[number]), int(self.table[number, 0]))
        content = self.decompressor.decompress(frame, max_output_size=int(self.table[number, 1]))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[number, 2]:
            raise ValueError(f"damaged frame {number}")
        return np.frombuffer(content, f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> list[int]:
        """Numbers of the documents with an id; the index is in ascending order."""
        low, high = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return list(range(int(low), int(high)))


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    shards: int | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """The manifest ``shard, path, documents, ids, bytes, start``, after writing the files.

    Documents are in ascending ``doc_id`` order over the shards (null first,
    equal ids by text). A null text is empty, so only the end id. An empty table
    gives no shards. ``folder`` must be shared by all executors, a new one in the
    scratch folder by default; the manifest is a table in it. A task that is run
    again writes the same file and renames it into place.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    if "://" not in folder:  # a path, or file:/path
        folder = f"file://{folder.removeprefix('file:')}"
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with open(tokenizer_path, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    largest = max(Tokenizer.from_str(encoder.content).get_vocab_size(with_added_tokens=True) - 1, end_id)
    width = 2 if largest < 1 << 16 else 4
    shared = spark.sparkContext.broadcast(encoder)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next((f for f in frames if len(f)), None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        path = f"{folder}/{shard:06d}.ids.zst"

        def rows() -> Iterator[tuple[int | None, np.ndarray]]:
            for frame in chain((first,), frames):
                for doc_id, null, text in zip(frame["doc_id"], frame["_null"], frame["text"], strict=True):
                    ids = np.append(shared.value.encode(text), np.uint32(end_id))
                    yield None if null else int(doc_id), ids

        files, name = fs.FileSystem.from_uri(folder)
        files.create_dir(name, recursive=True)
        yield pd.DataFrame([(shard, path, *write_shard(path, rows(), width))],
                           columns=["shard", "path", "documents", "ids", "bytes"])

    doc_id = F.col("doc_id").cast("bigint")
    ordered = (
        docs.select(
            F.coalesce(doc_id, F.lit(NULL_ID)).alias("doc_id"), doc_id.isNull().alias("_null"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInPandas(write, MANIFEST).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file: the sums before each are a small window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, read from the files."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, start in zip(frame["path"], frame["start"], strict=True):
                reader, rows = ShardReader(path), []
                for number in range(len(reader)):
                    ids = reader.ids(number)
                    rows.append((reader.doc_id(number), start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield _digests(rows)
                        rows = []
                yield _digests(rows)

    files = manifest.select("path", "start")
    spread = files.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return spread.mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _digests(rows: list[tuple]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return found.astype({"doc_id": "Int64", "start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})


def digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all documents and read them back."""
    return read_tokens(write_tokens(docs, tokenizer_path))
