"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.llm.common import renamed

#: N-grams of a language profile, and of a document that are compared with it.
TOP = 400
#: Languages that profiles can be learned for; more is an error, as profiles are broadcast.
MAX_LANGUAGES = 2000
#: Characters that are counted at once while profiles are learned.
CHUNK = 1 << 20

BLANK = 0x20
GRAMS = "lang string, gram bigint, n bigint"


class Letters:
    """Which code points are letters; made once per Python worker, when first used."""

    def __init__(self) -> None:
        self.table = None

    def __getstate__(self) -> dict:
        return {"table": None}

    def of(self, codes: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = np.fromiter(
                (unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000
            )
        return self.table[codes]


def grams(text: str, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three characters within words, and their counts.

    Words are runs of letters, lower-cased, with a blank before and after. An
    n-gram is the number made of its code points, 21 bits each.
    """
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = codes.astype(np.int64)
    is_letter = letters.of(codes)
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]  # the first blank after a word; further ones go
    codes, is_letter = np.where(is_letter, codes, BLANK)[keep], is_letter[keep]
    pairs = (codes[:-1] << 21) | codes[1:]
    triples = (pairs[:-1] << 21) | codes[2:]
    found = np.concatenate((codes[is_letter], pairs, triples[is_letter[1:-1]]))
    return np.unique(found, return_counts=True)


def ranked(found: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, then by their number."""
    return found[np.argsort(-counts, kind="stable")[:top]]


def has_letter(text: str, letters: Letters) -> bool:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return bool(letters.of(codes).any())


def counter(letters: Letters):
    """N-gram counts per language, summed within the task as far as memory allows."""

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, at, np.concatenate([p[1] for p in parts]))
        return found, sums

    def rows(lang: str, found: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts.astype(np.int64))],
            names=["lang", "gram", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}

        def add(lang: str) -> None:
            new = grams(" ".join(waiting.pop(lang)), letters)
            sizes.pop(lang)
            sums[lang] = merged([sums[lang], new]) if lang in sums else new

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= CHUNK:
                    add(lang)
            for lang in list(waiting):
                add(lang)
            if sum(len(found) for found, _ in sums.values()) > CHUNK:
                for lang in list(sums):
                    yield rows(lang, *sums.pop(lang))
        for lang, (found, counts) in sums.items():
            yield rows(lang, found, counts)

    return count


class Profiles:
    """Ranks of the profiles' n-grams, for all languages at once."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int) -> None:
        self.top = top
        self.langs = sorted({lang for lang, _, _ in rows}, key=lambda x: x.encode())
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.ranks = np.full((len(self.langs), len(self.grams)), -1, np.int64)
        number = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[number[lang], np.searchsorted(self.grams, gram)] = rank
        self.letters = Letters()

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score of a text; ties go to the first language by code point."""
        if not text or not self.langs or not has_letter(text, self.letters):
            return "und", 0.0
        own = ranked(*grams(text, self.letters), self.top)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        ranks = self.ranks[:, at[known]]
        apart = np.abs(ranks - np.flatnonzero(known))
        apart[ranks < 0] = self.top
        distances = apart.sum(axis=1) + self.top * np.count_nonzero(~known)
        best = int(np.argmin(distances))
        return self.langs[best], 1.0 - float(distances[best]) / (self.top * len(own))


def learn(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, gram, rank``: the most frequent n-grams per language, ranks from 0.

    All rows with a text and a language are counted.
    """
    known = docs.where("lang is not null and text is not null").select(
        F.col("lang").cast("string"), F.col("text").cast("string")
    )
    counts = known.mapInArrow(counter(Letters()), GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top)
        .select("lang", "gram", F.col("rank").cast("bigint"))
    )


def collected(profiles: DataFrame, top: int = TOP) -> Profiles:
    """The profiles on the driver: at most ``MAX_LANGUAGES`` times ``top`` short rows."""
    rows = profiles.limit(MAX_LANGUAGES * top + 1).collect()
    if len(rows) > MAX_LANGUAGES * top:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Profiles([(r.lang, r.gram, r.rank) for r in rows], top)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    Score is 1 minus the out-of-place distance over its largest possible value.
    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text when nothing could be learned. Whole texts are ranked; only the
    column ``text`` is used.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return _with_prediction(docs.select(*rest), profiles, "_pred").select(
        *rest, "_pred.lang_pred", "_pred.score"
    )


def _with_prediction(docs: DataFrame, profiles: Profiles, name: str) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [model.value.predict(x if isinstance(x, str) else None) for x in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.select("*", predict(F.col("text").cast("string")).alias(name))


def held_out() -> Column:
    """Whether crc32 of ``doc_id`` as text is divisible by five; false for null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict_languages(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from rows not held out."""
    model = collected(learn(docs.where(~held_out()), top), top)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, top: int = TOP, least_score: float = 0.0) -> DataFrame:
    """Rows, all columns, whose language is determined with more than ``least_score``.

    Rejected are texts without a letter and texts none of whose frequent n-grams
    is near its place in any profile (score 0).
    """
    docs, names = renamed(docs, "text", "lang")
    model = collected(learn(docs, top), top)
    lang, score = F.col("_pred.lang_pred"), F.col("_pred.score")
    return (
        _with_prediction(docs, model, "_pred").where((lang != "und") & (score > least_score)).select(*names)
    )
