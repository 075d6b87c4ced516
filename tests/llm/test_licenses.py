"""License rules against all rules tried everywhere, and texts that state a license, deny one or only sound like it."""

import pytest
import regex

from surgewatch.llm import licenses

STATED = {
    "BSD license": "bsd",
    "GPL v2 or later": "gpl-2",
    "This is GPLv3 only code": "gpl-3",
    "Licensed under the GNU GPL": "gpl",
    "Mozilla license": "mpl",
    "Licensed under the Apache License, Version 2.0": "apache-2",
    "released under the Apache license": "apache",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1",
    "It is available under a Creative Commons Attribution 4.0 International License": "cc-by",
    "published under CC BY-SA 4.0": "cc-by-sa",
    "you may use it under the terms of the PostgreSQL License": "postgresql",
    "License: MIT": "mit",
    "covered by the Ruby licence": "ruby",
    "not only under the MIT license": "mit",
    "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software": "zlib",
    "licensed under GNU Lesser General Public License version 3 and, for data, CC0 1.0; not under the GPL": "lgpl-3",
}
SILENT = [
    "The server runs under PostgreSQL 14", "compiled it under Ruby on Rails", "Traffic runs under OpenSSL now",
    "a talk under MIT supervision", "the site is available under Apache 2 on port 80", "they licensed Ruby code",
    "This is not licensed under the GPL", "It was never released under the terms of the Mozilla Public License 2.0",
    "this is not a BSD license", "driving without a license under the bridge", "", None, "mit", "as is", "!?",
]
DENIED = "It is not licensed under the MIT license"


def plain(text):
    """Labels of the rules that no detection of the same or a better priority contains."""
    words = regex.sub(licenses.SEPARATORS, " ", (text or "").lower()).strip(" ")
    normal, found = f" {words} ", []
    for priority, order, label, _, _, expression in licenses.rules():
        for m in regex.finditer(expression, normal):
            found.append((m.start(), -m.end(), priority, order, label))
    kept = []
    for d in sorted(found):
        if not any(k[0] <= d[0] and k[1] <= d[1] and k[2] <= d[2] for k in kept):
            kept.append(d)
    return sorted({d[4] for d in kept} - {""})


@pytest.fixture(scope="module")
def labels(spark):
    texts = [*STATED, *SILENT, DENIED, *(f"{a}. {b}; {a}" for a, b in zip(STATED, SILENT, strict=False))]
    texts += [f"x {shape} y" for _, _, shape in licenses.WORDINGS if not set(shape) & set("()?[]|{}")]
    texts.append("filler words " * 200_000 + "Licensed under the GNU GPL" + " more words" * 200_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = licenses.digest(licenses.scan_licenses(docs)).collect()
    return texts, {r.doc_id: r for r in got}


def test_all_rules_tried_everywhere_give_the_same(labels):
    texts, got = labels
    for i, text in enumerate(texts):
        base = [x for x in got[i].base_labels.split(",") if x]
        assert got[i].labels == ",".join(sorted({*base, *plain(text)})), text[:80] if text else text


def test_statements_denials_and_things(labels):
    texts, got = labels
    of = {text: got[i] for i, text in reversed(list(enumerate(texts)))}
    assert {t: of[t].labels for t in STATED} == STATED
    assert [t for t in SILENT if of[t].labels] == []
    # The base phrase stays, by its own definition; the method adds nothing to it.
    assert (of[DENIED].labels, of[DENIED].base_labels, of[DENIED].score) == ("mit", "mit", 0.5)
    assert got[len(texts) - 1].labels == "gpl"
