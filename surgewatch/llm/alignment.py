"""Alignment of two tokenizers' ids between whitespace-token anchors."""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import salted_join, saved

#: Chunks of text, and windows, whose ids a worker remembers; when so many are kept, it starts anew.
CHUNKS, WINDOWS = 400_000, 400_000
#: Characters of text that are aligned at once, and one more text.
CHARS = 1 << 21
#: Longest chunk in characters, and window in ids, that is remembered.
LONGEST = 48
#: The pairs' counts are broadcast if there are at most so many; each takes some 100 bytes.
BROADCAST_PAIRS = 500_000
#: An id pair is the number ``a * PAIR + b``.
PAIR = 1 << 24

STAGED = """rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,
    groups_sha256 string, pairs array<bigint>, times array<int>"""
ARROW = pa.schema([
    ("rid", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
])

#: Before a single blank between two characters that are none. No token crosses such a place.
CUTS = re.compile(r"(?<=\S)(?= \S)")
#: A blank beside other white space.
BESIDE = re.compile(r" \s|[^\S ] ")
# Fixed value: how byte-level vocabularies of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_of_letter() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable bytes are themselves, the others the characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: a byte-level file of the tokenizers library.

    If the file's merges make its entries in the order of their ids, the ids
    are ranks, and tiktoken gives the same ids sooner.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            if entry in special or not all(c in letters for c in entry):
                self.bytes[i] = entry.encode()
            else:
                self.bytes[i] = bytes(letters[c] for c in entry)
        parts = json.loads(self.tokenizer.to_str())
        split = parts["pre_tokenizer"] or {}
        self.separable = (
            parts["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        )
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in parts["model"]["merges"]]
        ordered = [vocabulary[m] for m in merged] == list(range(256, 256 + len(merged)))
        self.ranked = None
        if self.separable and ordered and not parts["model"].get("ignore_merges"):
            ranks = {self.bytes[i]: i for entry, i in vocabulary.items() if entry not in special}
            self.ranked = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of the texts, which start with the blank put before a document."""
        if self.ranked:
            return [self.ranked.encode_ordinary(text) for text in texts]
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model that puts a blank before a text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = []
        for i, entry in enumerate(entries):
            hexed = self.model.is_byte(i) and BYTE.fullmatch(entry)
            self.bytes.append(bytes([int(hexed[1], 16)]) if hexed else entry.replace(MARK, " ").encode())
        self.separable = not any(re.search(f"[^{MARK}]{MARK}", entry) for entry in entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of the texts without the blank each of them starts with."""
        return self.model.encode([text[1:] for text in texts], num_threads=1)


class Sides:
    """Both tokenizers, their byte lengths and space marks by id, and a worker's memory.

    Tokens of neither tokenizer reach across a single blank between words, so a
    text's ids are those of the chunks between such blanks, and known chunks
    need not be encoded again. Tokenizers of which that is not certain get
    whole texts. Ids are kept as 32-bit integers.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        if max(len(self.a.bytes), len(self.b.bytes)) > PAIR:
            raise ValueError(f"vocabularies may have {PAIR} entries")
        self.separable = self.a.separable and self.b.separable
        self.lengths = [[len(x) for x in side.bytes] for side in (self.a, self.b)]
        self.sizes = [np.array(x) for x in self.lengths]
        self.marked = [np.array([x[:1] == b" " for x in side.bytes]) for side in (self.a, self.b)]
        self.names = [str(i) for i in range(max(map(len, self.lengths)))]
        self.chunks: dict[str, tuple[bytes, bytes, bool]] = {}
        self.windows: dict[tuple[bytes, bytes], tuple[str, int, bytes]] = {}

    def cut(self, text: str) -> list[str]:
        """Blank and text, cut into chunks that are encoded apart."""
        if not self.separable:
            return [" " + text]
        if text[0].isspace() or text[-1].isspace() or BESIDE.search(text):
            return CUTS.split(" " + text)
        return [" " + word for word in text.split(" ")]

    def encode(self, chunks: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Both tokenizers' ids of each chunk, and whether both give its bytes back."""
        if len(self.chunks) > CHUNKS:
            self.chunks = {}
        found = list(map(self.chunks.get, chunks))
        at = [i for i, entry in enumerate(found) if entry is None]
        new = [chunks[i] for i in at]
        ids = self.a.encode(new), self.b.encode(new)
        whole = [chunk.encode("utf-8", "surrogatepass") for chunk in new]
        same = [x and y for x, y in zip(self.back(0, ids[0], whole), self.back(1, ids[1], whole), strict=True)]
        packed = [[array("i", x).tobytes() for x in side] for side in ids]
        for i, chunk, entry in zip(at, new, zip(*packed, same, strict=True), strict=True):
            found[i] = entry
            if len(chunk) <= LONGEST:
                self.chunks[chunk] = entry
        return found

    def back(self, side: int, ids: list[list[int]], whole: list[bytes]) -> list[bool]:
        """Whether a tokenizer's ids of each chunk give its bytes back; all chunks are compared at once."""
        entries, sizes = (self.a, self.b)[side].bytes, self.lengths[side]
        lengths = [sum([sizes[x] for x in chunk]) for chunk in ids]
        if lengths == list(map(len, whole)):
            if b"".join([entries[x] for chunk in ids for x in chunk]) == b"".join(whole):
                return [True] * len(whole)
        return [b"".join([entries[x] for x in chunk]) == text for chunk, text in zip(ids, whole, strict=True)]

    def window(self, key: tuple[bytes, bytes]) -> tuple[str, int, bytes]:
        """The groups of a window's ids as text, their number, and the linked pairs."""
        known = self.windows.get(key)
        if known is None:
            known = self.groups(memoryview(key[0]).cast("i").tolist(), memoryview(key[1]).cast("i").tolist())
            if len(key[0]) + len(key[1]) <= 4 * LONGEST:
                if len(self.windows) > WINDOWS:
                    self.windows = {}
                self.windows[key] = known
        return known

    def groups(self, a: list[int], b: list[int]) -> tuple[str, int, bytes]:
        """Cut ids of equal bytes where tokens of both end, every token having bytes."""
        names = self.names
        names_a, names_b = [names[k] for k in a], [names[k] for k in b]
        if len(a) == 1 or len(b) == 1:
            return ",".join(names_a) + "|" + ",".join(names_b), 1, struct.pack("=q", a[-1] * PAIR + b[-1])
        sizes_a, sizes_b = self.lengths
        ends = {end: j for j, end in enumerate(accumulate([sizes_b[k] for k in b]), 1)}
        text, links = [], []
        first_a = first_b = 0
        for i, end in enumerate(accumulate([sizes_a[k] for k in a]), 1):
            j = ends.get(end)
            if j:
                links.append(a[i - 1] * PAIR + b[j - 1])
                left = names_a[first_a] if i - first_a == 1 else ",".join(names_a[first_a:i])
                right = names_b[first_b] if j - first_b == 1 else ",".join(names_b[first_b:j])
                text.append(left + "|" + right)
                first_a, first_b = i, j
        return ";".join(text), len(text), struct.pack(f"={len(links)}q", *links)


def spread(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of ``flat``, of ``sizes``, in the order of ``codes``; and where each ends."""
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(starts[codes] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
    return flat[at], ends


def anchors(a: np.ndarray, b: np.ndarray, sides: Sides) -> tuple[np.ndarray, np.ndarray]:
    """Positions in both id sequences where windows end, the last ids' ends included.

    A window ends where a token of A and one of B end at the same byte, and the
    next token of either starts with a blank.
    """
    at_a = np.flatnonzero(sides.marked[0][a[1:]])
    at_b = np.flatnonzero(sides.marked[1][b[1:]])
    ends_a, ends_b = np.cumsum(sides.sizes[0][a])[at_a], np.cumsum(sides.sizes[1][b])[at_b]
    if len(at_a) and len(at_b):
        place = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
        shared = ends_b[place] == ends_a
        at_a, at_b = at_a[shared], at_b[place[shared]]
    else:
        at_a = at_b = at_a[:0]
    return np.append(at_a + 1, len(a)), np.append(at_b + 1, len(b))


def numbered(ids: list[np.ndarray], ends: list[np.ndarray]) -> np.ndarray:
    """A number per window, equal for equal ids; windows over ``LONGEST`` ids are not compared."""
    starts = [np.concatenate(([0], e[:-1])) for e in ends]
    sizes = [e - s for e, s in zip(ends, starts, strict=True)]
    # Windows that differ in size or in an id so far have different numbers at each step.
    code, used = sizes[0] * (LONGEST + 1) + sizes[1], (LONGEST + 1) ** 2
    short = sizes[0] + sizes[1] <= LONGEST
    for side in (0, 1):
        k, some = 0, np.flatnonzero(short)
        while len(some):
            new, values = pd.factorize(code[some] * PAIR + ids[side][starts[side][some] + k])
            code[some] = used + new
            used, k = used + len(values), k + 1
            some = some[sizes[side][some] > k]
    long = np.flatnonzero(~short)
    code[long] = used + np.arange(len(long))
    return code


def aligned(texts: list[str], sides: Sides) -> list:
    """The columns from ``n_a`` on for texts that are not empty.

    Nothing made here refers back to itself, so no search for such garbage is
    made in the worker's large memory meanwhile.
    """
    searching = gc.isenabled()
    gc.disable()
    try:
        return _aligned(texts, sides)
    finally:
        if searching:
            gc.enable()


def _aligned(texts: list[str], sides: Sides) -> list:
    cut = [sides.cut(t) for t in texts]
    codes, chunks = pd.factorize(np.array([c for part in cut for c in part], object))
    entries = sides.encode(chunks.tolist())
    doc_of = np.repeat(np.arange(len(texts)), [len(part) for part in cut])
    bad = np.zeros(len(texts), bool)
    bad[doc_of[~np.array([e[2] for e in entries])[codes]]] = True
    codes = codes[~bad[doc_of]]
    last = np.cumsum(np.where(bad, 0, [len(part) for part in cut]))
    ids, sizes = [], []
    for side in (0, 1):
        flat = np.frombuffer(b"".join([e[side] for e in entries]), np.int32)
        found, ends = spread(flat, np.array([len(e[side]) // 4 for e in entries]), codes)
        ids.append(found)
        sizes.append(np.diff(np.concatenate(([0], ends))[last], prepend=0))
    if not len(codes):
        none = [0] * len(texts)
        return [none, none, none, none, [""] * len(texts), [[]] * len(texts), [[]] * len(texts)]

    # Each text starts with a blank in both tokenizers, so windows end with texts.
    ends = anchors(*ids, sides)
    numbers = numbered(ids, ends)
    _, first, numbers = np.unique(numbers, return_index=True, return_inverse=True)
    raw = [x.tobytes() for x in ids]
    spans = [
        (4 * part).tolist()
        for e in ends
        for part in (np.concatenate(([0], e[:-1]))[first], e[first])
    ]
    windows = [sides.window((raw[0][i:x], raw[1][j:y])) for i, x, j, y in zip(*spans, strict=True)]
    doc_of = np.searchsorted(np.cumsum(sizes[0]), ends[0])
    cuts = np.searchsorted(doc_of, np.arange(len(texts) + 1))
    window_text, order = [w[0] for w in windows], numbers.tolist()
    digests = [
        "" if bad[d] else hashlib.sha256(";".join([window_text[k] for k in order[x:y]]).encode()).hexdigest()
        for d, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]
    per_window = np.array([w[1] for w in windows])[numbers]
    groups = np.bincount(doc_of, per_window, len(texts)).astype(np.int64)
    flat = np.frombuffer(b"".join([w[2] for w in windows]), np.int64)
    links = np.array([len(w[2]) // 8 for w in windows])
    linked, _ = spread(flat, links, numbers)
    link_doc = np.repeat(doc_of, links[numbers])
    n_links = np.bincount(link_doc, minlength=len(texts))
    code, pairs = pd.factorize(linked)
    key, times = np.unique(link_doc * len(pairs) + code, return_counts=True)
    offsets = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * len(pairs)), pa.int32())
    lists = [
        pa.ListArray.from_arrays(offsets, pa.array(v))
        for v in (pairs[key % len(pairs)], times.astype(np.int32))
    ]
    return [*sizes, groups, n_links, digests, *lists]


#: The tokenizers a worker has loaded, for its later tasks too.
_LOADED: dict[tuple[str, str], Sides] = {}


def stage(path_a: str, path_b: str):
    """Aligned documents, a row each, without what depends on other documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _LOADED.get((path_a, path_b))
        if sides is None:
            sides = _LOADED[path_a, path_b] = Sides(path_a, path_b)
        rid = TaskContext.get().partitionId() << 33

        def rows(ids: list, columns: list) -> pa.RecordBatch:
            nonlocal rid
            columns = [np.arange(rid, rid + len(ids)), ids, *columns]
            rid += len(ids)
            arrays = [
                c if isinstance(c, pa.Array) else pa.array(c, type=t.type)
                for c, t in zip(columns, ARROW, strict=True)
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=ARROW)

        for batch in batches:
            ids, texts = [], []
            size = 0
            blank = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    blank.append(doc_id)
                    continue
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size > CHARS:
                    yield rows(ids, aligned(texts, sides))
                    ids, texts, size = [], [], 0
            if texts:
                yield rows(ids, aligned(texts, sides))
            none = [0] * len(blank)
            yield rows(blank, [none] * 4 + [[""] * len(blank)] + [[[]] * len(blank)] * 2)

    return run


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, links, best``: how often each id pair is linked, and if its B id has none linked more often."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("links")).withColumn("b", F.pmod("pair", F.lit(PAIR)))
    # A B id has at most as many pairs as A has ids.
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document.

    A is a byte-level file of the tokenizers library and gets a blank and the
    text, B a sentencepiece model that adds the blank; strings of special
    tokens are plain text. Bytes where tokens of both end cut a document's ids
    into groups; tokens of A and B that end together are linked. ``count_sum``
    adds up how often each linked id pair is linked in all documents,
    ``n_best`` counts the links whose pair is the most frequent of its B id,
    ties included. A text that is null, empty, or not given back by the bytes
    of both tokenizers, has zeros and an empty ``groups_sha256``. Repeated rows
    and rows with null ids each have a result. Other columns are not read.

    Both ids of whole texts are cut at anchors, shared ends before tokens that
    start with a blank; a worker remembers the groups of the id windows
    between anchors, up to a bounded number. The pairs' counts are broadcast
    only if they are few; otherwise they are joined by shuffling, frequent
    pairs dealt out to many tasks.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    staged = saved(rows.mapInArrow(stage(path_a, path_b), STAGED), "aligned")
    links = staged.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("rid", "x.*")
    links = links.select("rid", F.col("pairs").alias("pair"), "times")
    counts = saved(pair_counts(links), "pairs")
    if counts.count() <= broadcast_pairs:
        joined = links.join(F.broadcast(counts), "pair")
    else:
        joined = salted_join(links, counts, ["pair"])
    sums = joined.groupBy("rid").agg(
        F.sum(F.col("times") * F.col("best").cast("int")).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"),
    )
    none = F.lit(0).cast("bigint")
    return staged.join(sums, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
