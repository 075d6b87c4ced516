"""License detection by ordered signature rules, with built-in functions only."""

from __future__ import annotations

import string
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import once, places, spaces

# Characters between words, and the phrases counted in any case.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

V = "(?:version |v ?)?"
# License, words of which some must occur (| separates the choices), expression
# for its name. Text is single words with one blank between them: "2.0" is
# "2 0", "BY-NC" is "by nc".
NAMES = (
    ("mit", "mit|expat", r"mit|expat"),
    ("apache-1.1", "apache", rf"apache(?: software)?(?: license| licence)? {V}1 1"),
    ("apache-2", "apache", rf"apache(?: software)?(?: license| licence)? {V}2(?: 0)?"),
    ("bsd-2-clause", "bsd", r"(?:2 clause|two clause|simplified|freebsd) bsd|bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:3 clause|three clause|new|modified|revised) bsd|bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:4 clause|four clause|original) bsd|bsd 4 clause"),
    ("gpl-1", "gpl|gnu general", rf"(?:gnu )?gpl {V}1(?: 0)?|gnu general public license {V}1(?: 0)?"),
    ("gpl-2", "gpl|gnu general", rf"(?:gnu )?gpl {V}2(?: 0)?|gnu general public license {V}2(?: 0)?"),
    ("gpl-3", "gpl|gnu general", rf"(?:gnu )?gpl {V}3(?: 0)?|gnu general public license {V}3(?: 0)?"),
    ("lgpl-2", "lgpl|gnu library|gnu lesser", rf"(?:gnu )?lgpl {V}2(?: 0)?|gnu (?:library|lesser) general public license {V}2(?: 0)?"),
    ("lgpl-2.1", "lgpl|gnu lesser", rf"(?:gnu )?lgpl {V}2 1|gnu lesser general public license {V}2 1"),
    ("lgpl-3", "lgpl|gnu lesser", rf"(?:gnu )?lgpl {V}3(?: 0)?|gnu lesser general public license {V}3(?: 0)?"),
    ("agpl-3", "agpl|gnu affero", rf"(?:gnu )?agpl {V}3(?: 0)?|gnu affero general public license {V}3(?: 0)?"),
    ("mpl-1.1", "mpl|mozilla public", rf"mpl {V}1 1|mozilla public license {V}1 1"),
    ("mpl-2", "mpl|mozilla public", rf"mpl {V}2(?: 0)?|mozilla public license {V}2(?: 0)?"),
    ("epl-1", "epl|eclipse public", rf"epl {V}1(?: 0)?|eclipse public license {V}1(?: 0)?"),
    ("epl-2", "epl|eclipse public", rf"epl {V}2(?: 0)?|eclipse public license {V}2(?: 0)?"),
    ("eupl-1.2", "eupl|european union public", rf"eupl {V}1 2|european union public licen[cs]e {V}1 2"),
    ("cddl-1", "cddl|common development", rf"cddl {V}1(?: 0)?|common development and distribution license {V}1(?: 0)?"),
    ("cpl-1", "cpl|common public", rf"cpl {V}1(?: 0)?|common public license {V}1(?: 0)?"),
    ("cc0", "cc0|cc 0|creative commons zero", rf"cc0(?: {V}1 0)?|cc 0|creative commons zero"),
    ("cc-by", "cc by|creative commons attribution", r"cc by(?! (?:nc|nd|sa))(?: [1-4] [05])?|creative commons attribution(?! (?:non|no|share))(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by sa|creative commons attribution", r"cc by sa(?: [1-4] [05])?|creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by nd|creative commons attribution", r"cc by nd(?: [1-4] [05])?|creative commons attribution no ?derivatives(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by nc|creative commons attribution", r"cc by nc(?! (?:nd|sa))(?: [1-4] [05])?|creative commons attribution non ?commercial(?! (?:no|share))(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa|creative commons attribution", r"cc by nc sa(?: [1-4] [05])?|creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd|creative commons attribution", r"cc by nc nd(?: [1-4] [05])?|creative commons attribution non ?commercial no ?derivatives(?: [1-4] [05])?"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-1", "artistic", rf"artistic(?: license| licence)? {V}1(?: 0)?"),
    ("artistic-2", "artistic", rf"artistic(?: license| licence)? {V}2(?: 0)?"),
    ("bsl-1", "bsl|boost software", rf"bsl {V}1 0|boost software(?: license| licence)?(?: {V}1(?: 0)?)?"),
    ("ofl-1.1", "ofl|open font", rf"ofl {V}1 1|(?:sil )?open font(?: license| licence)?(?: {V}1 1)?"),
    ("openssl", "openssl", r"openssl"),
    ("php-3.01", "php", rf"php(?: license| licence)? {V}3 0?1"),
    ("postgresql", "postgresql", r"postgresql"),
    ("python-2", "psf|python software foundation", rf"psf {V}2(?: 0)?|python software foundation(?: license| licence)?(?: {V}2(?: 0)?)?"),
    ("ruby", "ruby", r"ruby"),
    ("ms-pl", "ms pl|microsoft public", r"ms pl|microsoft public"),
    ("ms-rl", "ms rl|microsoft reciprocal", r"ms rl|microsoft reciprocal"),
    ("ncsa", "ncsa|university of illinois", r"ncsa|university of illinois ncsa open source"),
    ("osl-3", "osl|open software", rf"osl {V}3(?: 0)?|open software license {V}3(?: 0)?"),
    ("afl-3", "afl|academic free", rf"afl {V}3(?: 0)?|academic free license {V}3(?: 0)?"),
    ("odbl-1", "odbl|open data base|open database", rf"odbl(?: {V}1(?: 0)?)?|open data ?base(?: license| licence)?(?: {V}1(?: 0)?)?"),
    ("odc-by-1", "odc by|open data commons", rf"odc by(?: {V}1(?: 0)?)?|open data commons attribution(?: license| licence)?"),
    ("pddl-1", "pddl|open data commons", rf"pddl(?: {V}1(?: 0)?)?|open data commons public domain dedication"),
    ("gfdl-1.3", "gfdl|gnu free documentation", rf"gfdl {V}1 3|gnu free documentation license {V}1 3"),
    ("rail-m", "openrail|open rail|rail", r"(?:bigscience |creativeml )?open ?rail(?: m)?"),
    # Families without a version; of two equal matches the earlier, more exact name counts.
    ("apache", "apache", r"apache(?: software)?(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style| like)?"),
    ("gpl", "gpl|gnu general", r"(?:gnu )?gpl|gnu general public license"),
    ("lgpl", "lgpl|gnu library|gnu lesser", r"(?:gnu )?lgpl|gnu (?:library|lesser) general public license"),
    ("agpl", "agpl|gnu affero", r"(?:gnu )?agpl|gnu affero general public license"),
    ("gfdl", "gfdl|gnu free documentation", r"gfdl|gnu free documentation license"),
    ("mpl", "mpl|mozilla", r"mpl|mozilla(?: public)?(?: licen[cs]e)?"),
    ("epl", "epl|eclipse public", r"epl|eclipse public(?: licen[cs]e)?"),
    ("eupl", "eupl|european union public", r"eupl|european union public licen[cs]e"),
    ("cddl", "cddl|common development", r"cddl|common development and distribution license"),
    ("artistic", "artistic|perl artistic", r"(?:perl )?artistic"),
    ("creative-commons", "creative commons", r"creative commons(?: public)?(?: licen[cs]e)?"),
)

#: Names of programs and places too: by themselves they state no license.
ALSO_THINGS = frozenset((
    "mit", "apache", "apache-1.1", "apache-2", "artistic", "artistic-1", "artistic-2", "bsd", "isc", "mpl",
    "ncsa", "openssl", "php-3.01", "postgresql", "python-2", "rail-m", "ruby", "unlicense", "zlib",
))

OFFERED = r"licen[cs]ed|released|distributed|available|published|provided|covered|offered|shared|made available|redistributed"
TERMS = r"(?:the |a |an )?(?:terms (?:and conditions )?of (?:the |a )?)?"
LICENSE = r" (?:international |unported |public |open source )?licen[cs]e"
VERSION = r"(?: (?:version |v ?)?[0-9](?: [0-9])?(?= ))?"

# Ways to state a name, best first: word that must occur, expression, and the
# expression for names of :data:`ALSO_THINGS`, which need a word of licensing.
STATEMENTS = (
    ("spdx", r"spdx license identifiers? (?:{name})", r"spdx license identifiers? (?:{name})"),
    (
        "under",
        rf"(?:{OFFERED}) under {TERMS}(?:{{name}})(?:{LICENSE})?{VERSION}",
        rf"(?:licen[cs]ed under {TERMS}(?:{{name}})(?:{LICENSE})?|(?:{OFFERED}) under {TERMS}(?:{{name}})(?:{LICENSE}|(?<=licen[cs]e[ .0-9a-z]{{0,12}}))){VERSION}",
    ),
    (
        "under",
        rf"under {TERMS}(?:{{name}})(?:{LICENSE})?{VERSION}",
        rf"under {TERMS}(?:{{name}})(?:{LICENSE}|(?<=licen[cs]e[ .0-9a-z]{{0,12}})){VERSION}",
    ),
    (
        "licen",
        r"licen[cs]e(?:s|d)?(?: type| name)?(?: is| as)? (?:the )?(?:{name})(?: licen[cs]e)?",
        r"licen[cs]e(?: type| name)?(?: is| as)? (?:the )?(?:{name})(?: licen[cs]e)?(?! (?:code|library|server|toolkit|team|foundation|on)(?= ))",
    ),
    ("licen", rf"(?:the )?(?:{{name}}){LICENSE}", rf"(?:the )?(?:{{name}}){LICENSE}"),
)

#: What denies a license. A match has no label and suppresses what lies in it.
ABBREVIATED = r"licen[cs]e|[al]?gpl(?:v[0-9])?|mpl|epl|cddl|cc0|cc by(?: (?:nc|sa|nd))*"
DENIALS = (
    ("under", rf"(?:not|never|nor|neither|no longer)(?! (?:only|just|merely) ) (?:be |been |yet |currently |being )?(?:(?:{OFFERED}) )?under (?:[^ ]+ ){{0,7}}?(?:{ABBREVIATED}){VERSION}"),
    ("licen", rf"(?:is|are|was|were) (?:not|no longer)(?! (?:only|just|merely) ) (?:under )?(?:the |an? )?(?:[^ ]+ ){{0,4}}?licen[cs]e{VERSION}"),
)

# Wording of the licenses themselves: label, word that must occur, expression.
WORDINGS = (
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "apache", r"licensed under the apache license version 2 0 the license"),
    ("apache-2", "apache org", r"(?:http |https )?www apache org licenses license 2 0"),
    ("bsd-2-clause", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-2", "free software", r"free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2"),
    ("gpl-3", "free software", r"free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3"),
    ("gpl-3", "gnu general", r"gnu general public license version 3"),
    ("gpl-2", "gnu general", r"gnu general public license version 2"),
    ("lgpl-2.1", "lesser", r"terms of the gnu lesser general public license as published by the free software foundation either version 2 1"),
    ("mpl-2", "mozilla", r"subject to the terms of the mozilla public license v 2 0"),
    ("epl-2", "eclipse", r"made available under the terms of the eclipse public license v? ?2 0"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "what the", r"do what the [a-z]+ you want to public license"),
    ("cc0", "public domain", r"has dedicated the work to the public domain"),
    ("public-domain", "public domain", r"(?:is|are|placed|released|dedicated)(?: in| into| to)? the public domain"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("gpl-1", "gpl", rf"(?:gnu )?gpl {V}1(?: 0)? or (?:any )?later"),
    ("gpl-2", "gpl", rf"(?:gnu )?gpl {V}2(?: 0)? (?:or (?:any )?later|only)"),
    ("gpl-3", "gpl", rf"(?:gnu )?gpl {V}3(?: 0)? (?:or (?:any )?later|only)"),
    ("lgpl-2.1", "lgpl", rf"(?:gnu )?lgpl {V}2 1 (?:or (?:any )?later|only)"),
    ("lgpl-3", "lgpl", rf"(?:gnu )?lgpl {V}3(?: 0)? (?:or (?:any )?later|only)"),
    ("agpl-3", "agpl", rf"(?:gnu )?agpl {V}3(?: 0)? (?:or (?:any )?later|only)"),
    ("gpl-2", "gplv2", r"(?:gnu )?gplv2(?: 0)?(?: or (?:any )?later| only)?"),
    ("gpl-3", "gplv3", r"(?:gnu )?gplv3(?: 0)?(?: or (?:any )?later| only)?"),
    ("lgpl-2.1", "lgplv2", r"(?:gnu )?lgplv2 1(?: or (?:any )?later| only)?"),
    ("lgpl-3", "lgplv3", r"(?:gnu )?lgplv3(?: or (?:any )?later| only)?"),
    ("agpl-3", "agplv3", r"(?:gnu )?agplv3(?: or (?:any )?later| only)?"),
    ("mit", "as is", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "permission notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2", "apache", r"you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org"),
    ("bsd-3-clause", "endorse or promote", r"neither the name of (?:[^ ]+ ){1,12}?nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-2-clause", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("agpl-3", "affero", r"terms of the gnu affero general public license as published by the free software foundation either version 3"),
    ("lgpl-3", "lesser", r"terms of the gnu lesser general public license as published by the free software foundation either version 3"),
    ("gfdl-1.3", "free documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3"),
    ("mpl-2", "mozilla", r"if a copy of the mpl was not distributed with this file you can obtain one at https? mozilla org mpl 2 0"),
    ("bsl-1", "boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license|boost org license 1 0 txt"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("postgresql", "permission to use", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ncsa", "software without restriction", r"deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("python-2", "licensee a nonexclusive", r"psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("ofl-1.1", "font software", r"permission is hereby granted free of charge to any person obtaining a copy of the font software|scripts sil org ofl"),
    ("cc0", "waives", r"waives abandons and surrenders all of affirmer s copyright and related rights"),
    ("cddl-1", "common development", r"subject to the terms of the common development and distribution license"),
    ("odbl-1", "opendatacommons", r"opendatacommons org licenses odbl(?: 1 0)?"),
    ("pddl-1", "opendatacommons", r"opendatacommons org licenses pddl(?: 1 0)?"),
    ("proprietary", "all rights reserved", r"proprietary and confidential|all rights reserved unauthorized"),
)


def rules() -> list[tuple[int, int, str, str, str, str]]:
    """(priority, order, label, keyword, name, expression), the best priority first.

    Denials, with no label, and wordings of licenses come first, then each way
    of stating each name.
    """
    found = [(0, "", word, "", text) for word, text in DENIALS]
    found += [(0, label, word, "", text) for label, word, text in WORDINGS]
    for (rank, (word, clear, guarded)), (label, _, name) in product(enumerate(STATEMENTS), NAMES):
        shape = guarded if label in ALSO_THINGS else clear
        found.append((rank + 1, label, word, name, shape.replace("{name}", name)))
    return [
        (priority, order, label, word, name, rf"(?<= )(?:{text})(?= )")
        for order, (priority, label, word, name, text) in enumerate(found)
    ]


def _rule_array() -> Column:
    return F.array(*[
        F.struct(
            F.lit(priority).alias("priority"), F.lit(order).alias("order"), F.lit(label).alias("label"),
            F.lit(word).alias("word"), F.lit(name).alias("name"), F.lit(text).alias("text"),
        )
        for priority, order, label, word, name, text in rules()
    ])


#: Text in which the rules are tried; every rule's keyword contains one of these or is one.
GATE = ("licen", "spdx", "hereby granted", "apache", "redistribution", "free software", "gnu general",
        "lesser", "mozilla", "eclipse", "permission to use", "as is", "unencumbered", "what the",
        "public domain", "creativecommons", "all rights reserved", " under ", "gpl", "permission notice",
        "endorse or promote", "advertising materials", "affero", "free documentation", "boost",
        "altered source", "software without restriction", "font software", "waives", "common development",
        "opendatacommons")

DETECTION = "start:bigint,end:bigint,priority:int,order:int,label:string"


def detections(low: Column) -> Column:
    """All matches of the rules whose keyword and words of a name a text has, as word ranges."""

    def of(rule):
        return F.transform(
            places(low, rule["text"], spaces),
            lambda x: F.struct(
                (x["start"] - 1).alias("start"), x["end"].alias("end"), rule["priority"].alias("priority"),
                rule["order"].alias("order"), rule["label"].alias("label"),
            ),
        )

    names = F.array(*[
        F.struct(F.lit(name).alias("name"), F.array(*[
            F.array(*[F.lit(word) for word in choice.split(" ")]) for choice in words.split("|")
        ]).alias("choices"))
        for _, words, name in NAMES
    ])
    key_words = sorted({word for _, words, _ in NAMES for word in words.replace("|", " ").split(" ")})

    def named(known):
        met = F.filter(names, lambda n: F.exists(
            n["choices"], lambda words: F.forall(words, lambda w: F.array_contains(known, w))
        ))
        return F.concat(F.array(F.lit("")), F.transform(met, lambda n: n["name"]))

    known = F.array_intersect(F.array(*[F.lit(w) for w in key_words]), F.split(low, " ", -1))

    def tried(present):
        gated = F.filter(
            _rule_array(), lambda r: F.array_contains(present, r["name"]) & F.contains(low, r["word"])
        )
        return F.flatten(F.transform(gated, of))

    passes = F.lit(False)
    for word in GATE:
        passes = passes | F.contains(low, F.lit(word))
    none = F.array().cast(f"array<struct<{DETECTION}>>")
    return F.when(passes, once(once(known, named), tried)).otherwise(none)


def resolved(found: Column) -> Column:
    """Detections without those inside one of the same or a better priority.

    In the order of start, longest first, a detection lies in an earlier one
    exactly if it ends no later, so one pass with the largest end so far per
    priority is enough. Denials suppress, and are left out themselves.
    """
    ranks = len(STATEMENTS) + 1
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), d["priority"].alias("priority"),
        d["order"].alias("order"), d["label"].alias("label"),
    )))
    ends = F.array_repeat(F.lit(-1).cast("bigint"), ranks)
    none = F.array().cast(f"array<struct<{DETECTION}>>")

    def step(state, d):
        end = -d["back"]
        inside = F.exists(F.slice(state["ends"], F.lit(1), d["priority"] + 1), lambda e: e >= end)
        one = F.struct(d["start"].alias("start"), end.alias("end"), d["priority"].alias("priority"),
                       d["order"].alias("order"), d["label"].alias("label"))
        raised = F.transform(
            state["ends"], lambda e, i: F.when(i == d["priority"], F.greatest(e, end)).otherwise(e)
        )
        return F.struct(
            F.when(inside, state["ends"]).otherwise(raised).alias("ends"),
            F.when(inside, state["out"]).otherwise(F.array_append(state["out"], one)).alias("out"),
        )

    start = F.struct(ends.alias("ends"), none.alias("out"))
    return F.aggregate(ordered, start, step, lambda s: F.filter(s["out"], lambda d: d["label"] != ""))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words``, places of the base phrases, surviving ``detections`` and ``score``.

    A-Z are matched in any case; words are runs of digits, letters and
    characters beyond ASCII. Null is an empty text: no words, no labels, score
    0. Places overlap freely; repeated rows give repeated results. Score is 1
    for a license's own wording and falls with the rule's priority; a document
    with only a base phrase has 0.5. A name that is also a thing's needs a word
    of licensing beside it; a license that is denied gives no label, but for base
    phrases.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    # In a text of ASCII alone both ways give the same letters.
    folded = F.when(F.octet_length("text") == F.length("text"), F.lower("text")).otherwise(
        F.translate(F.col("text"), upper, lower)
    )
    words = F.trim(F.regexp_replace(folded, SEPARATORS, " "))
    normal = docs.select("doc_id", text.alias("text")).select(
        "doc_id", F.concat(F.lit(" "), words, F.lit(" ")).alias("normal")
    )
    found = normal.select(
        "doc_id",
        F.when(F.length("normal") <= 2, 0).otherwise(spaces(F.col("normal")) - 1).cast("bigint").alias("n_words"),
        *[
            F.when(
                F.contains("normal", F.lit(phrase)),
                F.transform(
                    places(F.col("normal"), F.lit(rf"(?<= ){phrase}(?= )"), spaces), lambda x: x["start"] - 1
                ),
            ).otherwise(F.array().cast("array<bigint>")).alias(f"base_{label}")
            for label, phrase in BASE
        ],
        detections(F.col("normal")).alias("all"),
    )
    return found.withColumn("detections", resolved(F.col("all"))).drop("all")


def digest(found: DataFrame) -> DataFrame:
    """Counts and labels per document, from :func:`scan_licenses`."""
    starts = F.concat(*[F.col(f"`base_{label}`") for label, _ in BASE])
    base = F.array_compact(
        F.array(*[F.when(F.size(F.col(f"`base_{label}`")) > 0, F.lit(label)) for label, _ in BASE])
    )
    base = F.array_sort(base)
    own = F.transform("detections", lambda d: d["label"])
    best = F.array_min(F.transform("detections", lambda d: d["priority"]))
    score = F.when(best.isNotNull(), 1.0 - best / (2.0 * len(STATEMENTS))).otherwise(0.0)
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size(base) > 0, F.greatest(score, F.lit(0.5))).otherwise(score).alias("score"),
    )
