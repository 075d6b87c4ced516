"""Terms that reveal entities: counts, places and what sanitised() leaves."""

import pytest

from surgewatch.llm import pii

OTHER = "we write about weather and other things that all of us know"


def private(spark, texts):
    return pii.find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def terms_of(found):
    return {r.doc_id: {t["term"]: t["strength"] for t in r.terms} for r in found.collect()}


def test_a_contact_line_in_many_different_documents(spark):
    line = "contact albrecht office desk kiosk at a@b.cd mornings only please thanks"
    got = terms_of(private(spark, [f"{line}. {OTHER} item{i}" for i in range(8)] + [f"{OTHER} no{i}" for i in range(40)]))
    assert all(got[i]["albrecht"] == pytest.approx(1.0) for i in range(8))
    assert not got[20]


def test_an_entity_seen_once(spark):
    got = terms_of(private(spark, ["albrecht has a@b.cd now", *[f"{OTHER} now" for _ in range(40)]]))
    assert "albrecht" in got[0] and "now" not in got[0]


def test_entities_are_replaced_by_their_kind(spark):
    found = private(spark, ["mail a@b.cd or call +49 (30) 123-4567"])
    assert pii.sanitised(found).first().text == "mail <email> or call <phone>"


def test_terms_far_from_the_entity_are_marked_everywhere(spark):
    top = "Albrecht Li, 山田 wrote"
    text = f"{top} {OTHER * 20} a@b.cd {OTHER * 20} handle jd42 albrecht's " + "q" * 60
    found = private(spark, [text, *[f"{OTHER * 3} wrote handle" for _ in range(30)]])
    got = next(r for r in found.collect() if r.doc_id == 0)
    assert [t["start"] for t in got.terms if t["term"] == "albrecht"] == [0, text.index("albrecht's")]
    assert {"li", "山田", "jd42", "q" * 60} <= {t["term"] for t in got.terms}
    assert all(text[t["start"] : t["end"]].lower() == t["term"] for t in got.terms)
    assert not {"wrote", "handle", "a", "b", "cd"} & {t["term"] for t in got.terms}
    clean = {r.doc_id: r.text for r in pii.sanitised(found).collect()}[0]
    assert not any(w in clean for w in ("lbrecht", "Li", "山田", "jd42", "qq", "a@b"))


def test_strengths_against_brute_force(spark):
    import math
    import random
    import re

    pick = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["Öl", "x"]
    texts = []
    for _ in range(60):
        body = pick.choices(words, weights=range(1, 43), k=12)
        body += [f"p{e}@q.rs" for e in pick.sample(range(6), 2)] if pick.random() < 0.3 else []
        texts.append(" ".join(pick.sample(body, len(body))))
    texts += texts[:7] + ["", None]
    entities = [set(re.findall(r"p[0-9]@q\.rs", t or "")) for t in texts]
    terms = [set(re.findall(r"[^\W_]+", (t or "").lower())) for t in texts]
    want, n = {}, len(texts)
    for i, t in enumerate(texts):
        want[i] = {}
        for e in entities[i]:
            c = sum(e in x for x in entities)
            for w in terms[i]:
                both = sum(e in x and w in y for x, y in zip(entities, terms, strict=True))
                s = min(1.0, math.log(both * n / (c * sum(w in y for y in terms))) / math.log(n / c))
                if s >= pii.GENERALISE and re.search(rf"(?<![\w@.]){w}(?![\w@.])", t, re.I):
                    want[i][w] = max(s, want[i].get(w, 0))
    got = terms_of(private(spark, texts))
    assert any(want.values())
    assert {i: set(x) for i, x in got.items()} == {i: set(x) for i, x in want.items()}
    assert all(got[i][w] == pytest.approx(s) for i, x in want.items() for w, s in x.items())
