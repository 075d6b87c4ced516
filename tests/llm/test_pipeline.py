"""The pipeline against plain Python on a small fixture, and op6 to op9 against their SQL."""

import os
import re
import zlib
from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from surgewatch.llm import jaccard, queries

WORDS = "river stone maple cloud ember harbor lantern meadow pepper quartz ribbon saddle timber velvet willow".split()
LEAK = "the quick brown fox jumps over the lazy dog again and again"


def text_of(i, n=30):
    return " ".join(WORDS[(i * i + k * (i + 1) + k * k) % len(WORDS)] + str((i + k) % 5) for k in range(n))


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def one_of_each(rows):
    """Rows left of (doc_id, text): the first, null last, of each group of linked rows."""
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    first = {}
    for i in order:
        first.setdefault(group[i], i)
    return [rows[i] for i in sorted(first.values())]


def test_keep_one_by_row(spark):
    rows = [(1, text_of(1)), (1, text_of(2)), (None, text_of(3)), (None, text_of(3) + " tail"), (4, text_of(2)), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, jaccard.keep_one(docs).collect())) == Counter(one_of_each(rows))


def test_pipeline(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [(i, text_of(i)) for i in range(24)]
    rows += [(24, text_of(3) + " end"), (25, text_of(4)), (26, "12 34 !"), (27, None), (28, text_of(40) + " " + LEAK), (29, text_of(41))]
    data = [(i, t, "en", "web", len(t or "")) for i, t in rows]
    spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, LEAK)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    identified = [r for r in rows if re.search("[a-z]", r[1] or "")]
    clean = {i: t for i, t in one_of_each(identified) if LEAK not in t}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken = Counter(r.doc_id for r in got)
    # One source: its target is 1.5 times its words, in whole documents.
    total = sum(len(t.split()) for t in clean.values())
    assert set(taken) <= set(clean)
    assert sum(n * len(clean[i].split()) for i, n in taken.items()) == pytest.approx(1.5 * total, abs=31)
    tokenizer, start = Tokenizer.from_file(queries.tokenizer_path()), 0
    for r in sorted(got, key=lambda r: r.start):
        ids = [*tokenizer.encode(clean[r.doc_id], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_stages_delete_what_the_one_before_saved(spark, tmp_path):
    data = [(i, text_of(i), "en", f"s{i % 2}", 1) for i in range(20)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    used = []
    for name, stage in corpus_pipeline.STAGES[1:2] + corpus_pipeline.STAGES[3:4]:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        used.append([os.path.exists(path.removeprefix("file:")) for path in corpus_pipeline._used])
        first = list(corpus_pipeline._used) if len(used) == 1 else first
    assert all(map(all, used)) and all(used)
    assert not any(os.path.exists(path.removeprefix("file:")) for path in first)
    # A result that was not written keeps its tables.
    lazy = corpus_pipeline.STAGES[1][1](spark, docs, "")
    assert corpus_pipeline.STAGES[1][1](spark, lazy, "").count() == lazy.count() > 0


@pytest.mark.parametrize("name", queries.ORACLES)
def test_registered_sql(spark, small_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_dir}/{table}.parquet'")
    want = connection.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, small_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0

    def plain(frame):
        return sorted(tuple("" if pd.isna(v) else str(v) for v in row) for row in frame[sorted(want.columns)].itertuples(index=False))

    assert plain(got) == plain(want)


CLASHES = ["_row", "_key", "_copies", "_copy", "_pred", "n_words", "starts", "ends", "item_ids", "a.b", "c1", "component_id", "size", "doc_id"]


def test_stages_give_extra_columns_back(spark, tmp_path):
    """Columns named as the stages' own, or with a dot, come out as they went in."""
    spark.createDataFrame([(1, LEAK)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["text", "lang", "source", *CLASHES]
    data = [(text_of(i), "en", "web", *[f"{n}{i}" for n in CLASHES[:-1]], i) for i in range(12)]
    schema = ", ".join(f"`{n}` {'bigint' if n == 'doc_id' else 'string'}" for n in names)
    docs = spark.createDataFrame(data, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == names
        rows = {tuple(r) for r in got.collect()}
        assert rows and rows <= {tuple(r) for r in docs.collect()}
