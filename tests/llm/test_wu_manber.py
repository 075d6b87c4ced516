"""Wu-Manber tables against plain search, and phrases with many segments."""

import hashlib
import random

import pytest

from surgewatch.llm import decontam, phrases


def plain(rows, window, words):
    """(first word, length, items) of each occurrence of a window."""
    patterns = {}
    for item, raw in rows:
        own = decontam.words_of(raw)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            patterns.setdefault(tuple(own[k : k + n]), set()).add(item)
    return sorted(
        (k, len(p), sorted(map(str, items)))
        for p, items in patterns.items() for k in range(len(words) - len(p) + 1) if tuple(words[k : k + len(p)]) == p
    )


@pytest.mark.parametrize("window", [1, 2, 3, 10, 300])
def test_tables_find_what_plain_search_finds(window):
    draw = random.Random(window)
    for words_known in (2, 30):
        some = [f"w{i}".encode() for i in range(words_known)]
        text = [draw.choice(some) for _ in range(900)]
        rows = [(str(i), b" ".join(draw.choice(some) for _ in range(draw.randrange(40)))) for i in range(30)]
        rows += [("part", b" ".join(text[100:160])), ("again", b" ".join(text[100:160])), (None, b"w1"), ("none", None)]
        rows.append(("long", b" ".join(text[200:620])))
        tables = decontam.compiled(rows, window)
        got = sorted(
            (first, t.length, sorted(map(str, t.items_of(p)))) for t in tables for first, p in t.search(text)
        )
        assert got == plain(rows, window, text)


def test_full_slots_only_cost_time(monkeypatch):
    # All blocks and all patterns share a slot, as the worst of hashes would have it.
    monkeypatch.setattr(decontam.xxhash, "xxh3_64_intdigest", lambda b: 7)
    rows = [("a", b"x y z x y"), ("b", b"y z x")]
    words = b"q x y z x y z x q".split()
    tables = decontam.compiled(rows, 3)
    assert sorted((k, t.length, sorted(t.items_of(p))) for t in tables for k, p in t.search(words)) == plain(rows, 3, words)


def test_tables_are_small():
    draw = random.Random(1)
    raw = b" ".join(str(draw.randrange(10**6)).encode() for _ in range(40_000))
    (table,) = decontam.compiled([("a", raw)], 10)
    held = [table.shift, table.heads, table.chain, table.begin, table.end, table.item, table.text]
    assert sum(memoryview(x).nbytes for x in held) < 12 * len(raw)


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_phrases_with_many_segments(spark, monkeypatch, most):
    """Windows of a phrase over the limit are compared alone; the result is the same."""
    monkeypatch.setattr(phrases, "PHRASE_SEGMENTS", most)
    shared = [f"s{i}" for i in range(70)]
    texts = {i: " ".join([f"d{i}", *shared[i % 4 : 70 - i % 3], *(f"e{i}x{j}" for j in range(20))]) for i in range(12)}
    texts[12] = texts[3]
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    first, windows = {}, {}
    for i, text in texts.items():
        w = text.split()
        windows[i] = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        for x in windows[i]:
            first.setdefault(x, i)
    got = {r.doc_id: r for r in phrases.remove_repeats(docs).collect()}
    for i, text in texts.items():
        gone = {k + j for k, x in enumerate(windows[i]) if first[x] < i for j in range(50)}
        kept = " ".join(x for k, x in enumerate(text.split()) if k not in gone)
        assert (got[i].n_removed, got[i].kept_sha256) == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert any(r.n_removed for r in got.values())
