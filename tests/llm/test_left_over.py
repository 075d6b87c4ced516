"""Sets that share keys, compared in blocks: by cluster or by key, against brute force."""

import random

import pytest

from surgewatch.llm import jaccard


def shingles_of(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def texts():
    draw = random.Random(3)
    found = []
    # A chain: neighbours share half of their words, so keys join all to one cluster.
    for i in range(14):
        base = [f"c{j}" for j in range(i * 20, i * 20 + 40)]
        for _ in range(draw.randrange(1, 4)):
            copy = list(base)
            copy[draw.randrange(40)] = f"x{draw.randrange(10**9)}"
            found.append(" ".join(copy))
    # Sizes from one to long, of which some link and some do not.
    long = [f"l{j}" for j in range(120)]
    found += [" ".join(long[:n]) for n in (120, 110, 95, 94, 93, 92, 90, 72, 71, 60, 9, 8, 5, 4)]
    return found


@pytest.mark.parametrize(("block", "alone"), [(1500, True), (3, True), (3, False), (1, True)])
def test_no_link_is_lost(spark, monkeypatch, block, alone):
    """``alone``: without hubs, every pair is left to the blocks."""
    all_texts = texts()
    docs = spark.createDataFrame(list(enumerate(all_texts)), "doc_id bigint, text string").repartition(3)
    sets = [shingles_of(t) for t in all_texts]
    linked = {
        (a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
        if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    }
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    seen = []

    def left(of_sets, keys, percent=75):
        none = spark.createDataFrame([], "node binary, root binary")
        found = jaccard.saved(jaccard.left_over(of_sets, keys, none, percent), "found")
        seen.extend((bytes(r.a), bytes(r.b)) for r in found.collect())
        return found

    if alone:
        monkeypatch.setattr(jaccard, "links", left)
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(docs).collect()}
    root = list(range(len(sets)))
    for _ in sets:
        for a, b in linked | {(b, a) for a, b in linked}:
            root[a] = min(root[a], root[b])
    for i, x in enumerate(sets):  # equal sets
        root[i] = min(root[j] for j, y in enumerate(sets) if x == y)
    assert got == dict(enumerate(root))
    if alone:
        assert len({tuple(sorted(p)) for p in seen}) == len(linked)


def test_a_chain_is_taken_apart_into_its_keys(spark, monkeypatch):
    """Ten thousand sets in one chain would be 25 million pairs; its keys have two sets each."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 100)
    n = 10_000
    own = spark.range(n).selectExpr(
        "explode(array(id, id + 1)) AS key", "cast(cast(id AS string) AS binary) AS id", "10L AS n",
        "cast(cast(id AS string) AS binary) AS root", "cast('0' AS binary) AS low",
    )
    clusters = own.select("root").distinct().selectExpr("root", "cast('0' AS binary) AS cluster")
    units = jaccard._units(own, clusters, 75)
    assert units.groupBy("unit").count().agg({"count": "max"}).first()[0] == 2
    blocks, placed = jaccard._blocks(jaccard.saved(units, "units"))
    assert placed.count() == 2 * n and blocks.count() == n + 1
