"""Alignment of two tokenizers against brute force over whole texts."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from surgewatch.llm import alignment, common

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, rid bigint, pair string, links int"
LONG = " ".join(f"word{i % 97}, and {i}!" for i in range(30_000))
TEXTS = [
    None, "", " ", "\n", "One two three", "One two three", "  two  blanks ", "tab\t and\nlines \n\n more",
    "<|endoftext|> </s> <s> <unk>", "<0x41> ▁ mark", "naïve café — “quotes” 日本語のテキスト 🙂 x", "a b 　 c",
    "it's we'll I'd 's 'S", "x" * 3000, "日本" * 500, "a ̈b  é", "tail ", "\x1c x\x85 y\x00z", LONG, LONG + " .",
]


def brute(texts):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = SentencePieceProcessor(model_file=B)
    letters = alignment.byte_of_letter()
    rows, total = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        parts_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        parts_b = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            rows.append(None)
            continue
        ends_a, ends_b, n = {}, {}, 0
        for k, part in enumerate(parts_a):
            n += len(part)
            ends_a[n] = k
        n = 0
        for k, part in enumerate(parts_b):
            n += len(part)
            ends_b[n] = k
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            x, y = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        total.update(links)
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, y), n in total.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = row
        best = sum(total[link] == most[link[1]] for link in links)
        out.append((n_a, n_b, n_groups, len(links), best, sum(total[link] for link in links), digest))
    return out


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_equals_brute_force(spark, monkeypatch, broadcast_pairs):
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    rows = [(i if i % 5 else None, t, 7, "x", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = alignment.align(docs, A, B, broadcast_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = sorted((i if i % 5 else -1, *r) for i, r in enumerate(brute(TEXTS)))
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()) == want


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert alignment.align(docs, A, B).count() == 0
    rows = [(1, None, 1, "", 1), (2, "", 1, "", 1), (3, "▁", 1, "", 1)]
    got = alignment.align(spark.createDataFrame(rows, SCHEMA), A, B).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_a_worker_may_forget_everything(monkeypatch):
    whole = alignment.Sides(A, B)
    little = alignment.Sides(A, B)
    little.separable = False
    monkeypatch.setattr(alignment, "CHUNKS", 3)
    monkeypatch.setattr(alignment, "WINDOWS", 3)
    forgets = alignment.Sides(A, B)
    texts = [t for t in TEXTS if t][:-2]
    results = []
    for sides, step in ((whole, len(texts)), (little, 2), (forgets, 1)):
        found = []
        for i in range(0, len(texts), step):
            columns = alignment.aligned(texts[i : i + step], sides)
            found += zip(*[list(c) if isinstance(c, list) else c.tolist() for c in columns], strict=True)
        results.append([(*r[:5], dict(zip(r[5], r[6], strict=True))) for r in found])
    assert results[0] == results[1] == results[2]
    assert len(forgets.windows) <= 5


def test_anchors_are_shared_ends_before_marked_tokens():
    sides = alignment.Sides(A, B)
    (a, b, same), = sides.encode([" unbelievable things, happen"])
    import numpy as np

    a, b = np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)
    ends = alignment.anchors(a, b, sides)
    for x, y in zip(*ends, strict=True):
        left = b"".join(sides.a.bytes[i] for i in a[:x])
        assert left == b"".join(sides.b.bytes[i] for i in b[:y])
        assert x == len(a) or sides.a.bytes[a[x]][:1] == sides.b.bytes[b[y]][:1] == b" "
    assert same and len(ends[0]) == 3
