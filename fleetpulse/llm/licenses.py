"""License scans by ordered signature rules (DataFrame functions only).

A text is lower-cased (A-Z) and reduced to its words (letters, digits and other
scripts) with one space between them. Every rule is a hand-written regular
expression over these words with a keyword, a label, a priority and a
confidence. A keyword is one or more words (the last may be cut short) that
stand in everything the expression accepts; names with alternatives are a rule
for every keyword. A rule is tried only on texts that hold its keyword at the
start of a word; texts without any keyword are not normalised at all. All places of all rules are found, and a
place is suppressed if a place of higher priority, or of the same priority and
an earlier rule, contains its words. The labels of the places that stay are the
method's; base phrases are counted on their own and never suppressed.

Scale: one pass, no shuffle, no Python; the rules are a constant of the plan.
The sweep that suppresses keeps one number per priority while it walks the
places in order, so a text with very many places costs time in proportion.

Defined results: NULL and empty texts have no words and no places; repeated
rows are scanned alike; ties between rules of one priority go to the earlier
rule; an empty table gives an empty result. Only the text is read; other
columns are carried in a struct and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"          # before lower-casing
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and labels (fixed values).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Priorities: a tag or full notice beats a named version, that beats a family
# name, that beats a hint.
TAG, NOTICE, NAME, FAMILY, HINT = 4, 3, 2, 1, 0
CONFIDENCE = {TAG: 1.0, NOTICE: 0.95, NAME: 0.8, FAMILY: 0.6, HINT: 0.3}

_V = r"(?: version| v)?"
_LATER = r"(?: or(?: at your option)?(?: any)? later(?: version)?| plus)"
_CC = r"(?:creative commons|cc)"



def _gpl(before: str, short: str, version: str) -> dict[str, str]:
    """The long and the short name, by keyword."""
    return {f"{before}general public": rf"(?:gnu )?{before}general public license{_V}{version}",
            short: rf"(?:gnu )?{short}{_V}{version}"}


def _clauses(digit: str, word: str, *names: str) -> dict[str, str]:
    return {**{n: f"{n} license" for n in names},
            **{f"{n} clause": rf"(?:bsd )?{n} clause(?: bsd)? license" for n in (digit, word)}}


#: label, keyword, expression of the name (or a dict of both), SPDX words (or None).
FAMILIES = [
    ("gpl-2.0", _gpl("", "gpl", " ?2(?: 0)?"), "gpl 2 0"),
    ("gpl-3.0", _gpl("", "gpl", " ?3(?: 0)?"), "gpl 3 0"),
    ("gpl-2.0-or-later", _gpl("", "gpl", rf" ?2(?: 0)?{_LATER}"), "gpl 2 0 or later"),
    ("gpl-3.0-or-later", _gpl("", "gpl", rf" ?3(?: 0)?{_LATER}"), "gpl 3 0 or later"),
    ("lgpl-2.1", _gpl("lesser ", "lgpl", " ?2 1"), "lgpl 2 1"),
    ("lgpl-3.0", _gpl("lesser ", "lgpl", " ?3(?: 0)?"), "lgpl 3 0"),
    ("agpl-3.0", _gpl("affero ", "agpl", " ?3(?: 0)?"), "agpl 3 0"),
    ("gfdl-1.3", {"free documentation": rf"(?:gnu )?free documentation license{_V} ?1 3", "gfdl": rf"(?:gnu )?gfdl{_V} ?1 3"},
     "gfdl 1 3"),
    ("apache-2.0", "apache", rf"apache (?:software )?license{_V} ?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?license{_V} ?1 1", "apache 1 1"),
    ("mit", {"mit": r"mit licen[sc]e", "expat": r"expat licen[sc]e"}, "mit"),
    ("mit-0", "mit", r"mit no attribution(?: license)?", "mit 0"),
    ("bsd-2-clause", _clauses("2", "two", "simplified bsd", "freebsd"), "bsd 2 clause"),
    ("bsd-3-clause", _clauses("3", "three", "new bsd", "modified bsd", "revised bsd"), "bsd 3 clause"),
    ("bsd-4-clause", _clauses("4", "four", "original bsd"), "bsd 4 clause"),
    ("isc", "isc", r"isc license", "isc"),
    ("mpl-2.0", "mozilla", rf"mozilla public license{_V} ?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public license{_V} ?1 1", "mpl 1 1"),
    ("epl-1.0", "eclipse", rf"eclipse public license{_V} ?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", rf"eclipse public license{_V} ?2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", "distribution", rf"common development and distribution license{_V} ?1(?: 0)?", "cddl 1 0"),
    ("eupl-1.2", "european", rf"european union public licen[sc]e{_V} ?1 2", "eupl 1 2"),
    ("artistic-2.0", "artistic", rf"artistic license{_V} ?2(?: 0)?", "artistic 2 0"),
    ("bsl-1.0", "boost", rf"boost software license{_V} ?1(?: 0)?", "bsl 1 0"),
    ("zlib", "zlib", r"zlib license", "zlib"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", rf"wtfpl(?:{_V} ?2)?", "wtfpl"),
    ("ofl-1.1", "sil", rf"sil open font license{_V} ?1 1", "ofl 1 1"),
    ("psf-2.0", "python", r"python software foundation license", "psf 2 0"),
    ("postgresql", "postgresql", r"postgresql license", "postgresql"),
    ("openssl", "openssl", r"openssl license", "openssl"),
    ("ms-pl", "microsoft", r"microsoft public license", "ms pl"),
    ("odbl-1.0", "database", rf"open database license{_V}(?: ?1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1.0", "commons", rf"open data commons attribution license{_V}(?: ?1(?: 0)?)?", "odc by 1 0"),
    ("cc0-1.0", "cc0", rf"cc0(?:{_V} ?1 0)?(?: universal)?", "cc0 1 0"),
    ("busl-1.1", "business", rf"business source license{_V} ?1 1", "busl 1 1"),
    ("sspl-1.0", "server", rf"server side public license{_V} ?1(?: 0)?", "sspl 1 0"),
]
#: Creative Commons terms: label part, short form, long form.
CC_TERMS = [
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
_GRANT = r"(?:licensed|released|distributed|available|published|provided|made available) under(?: the)?(?: terms of(?: the)?)?"
#: Whole notices and hints: label, keyword, expression, priority.
TEXTS = [
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software", NOTICE),
    ("mit-0", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: \w+){5,60} without restriction(?: \w+){5,40} provided as is without", NOTICE),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", NOTICE),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", NOTICE),
    ("bsd-3-clause", "endorse", r"neither the name of .{1,80}? may be used to endorse or promote products", NOTICE),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license", NOTICE),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license", NOTICE),
    ("agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license", NOTICE),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", NOTICE),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", NOTICE),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license", NOTICE),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented", NOTICE),
    ("public-domain", "domain", r"(?:released|dedicated|placed) (?:in)?to the public domain", NOTICE),
    ("public-domain", "domain", r"public domain", HINT),
    ("proprietary", "reserved", r"all rights reserved", HINT),
    ("proprietary", "confidential", r"proprietary and confidential", NAME),
    ("proprietary", "prohibited", r"unauthorized copying of this file(?: \w+){0,8} is strictly prohibited", NOTICE),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d", HINT),
    ("gpl", "gnu", r"gnu general public license", FAMILY),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license", FAMILY),
    ("agpl", "affero", r"(?:gnu )?affero general public license", FAMILY),
    ("apache", "apache", r"apache (?:software )?license", FAMILY),
    ("mpl", "mozilla", r"mozilla public license", FAMILY),
    ("epl", "eclipse", r"eclipse public license", FAMILY),
    ("bsd", "bsd", r"bsd license", FAMILY),
    ("artistic", "artistic", r"artistic license", FAMILY),
    ("cc", "commons", r"creative commons license", FAMILY),
    ("eula", "license", r"end user license agreement", NAME),
    ("open-source", "license", r"open source license", HINT),
]


def rules() -> list[tuple[str, str, str, int]]:
    """(label, keyword, expression, priority) in order: for every family its
    tag, its grant and its name; Creative Commons by terms and version."""
    out = []
    for label, *names, spdx in FAMILIES:
        names = names[0] if len(names) == 1 else {names[0]: names[1]}
        if spdx:
            out.append((label, "spdx", rf"spdx license identifier {spdx}(?: only)?", TAG))
        out += [(label, keyword, rf"{_GRANT} {name}", NOTICE) for keyword, name in names.items()]
        out += [(label, keyword, name, NAME) for keyword, name in names.items()]
    for part, short, long in CC_TERMS:
        for version in CC_VERSIONS:
            label = f"cc-{part}-{version.replace(' ', '.')}"
            out.append((label, "spdx", rf"spdx license identifier cc {short} {version}", TAG))
            out.append((label, "cc", rf"cc {short}{_V} ?{version}", NAME))
            out.append((label, "creativecommons", rf"creativecommons org licenses {short} {version}", TAG))
            out.append((label, "commons", rf"creative commons {long}(?: {version}| license{_V} ?{version})", NAME))
        out.append((f"cc-{part}", "cc", rf"cc {short}", FAMILY))
        out.append((f"cc-{part}", "commons", rf"creative commons {long}", FAMILY))
    return out + TEXTS


def any_keyword() -> str:
    """One expression for any keyword at the start of a word, grouped by first
    letters, so that most places of a text fail on one character."""
    keys = {k for _, k, _, _ in rules()} | {p.split()[0] for p in BASE}
    by_letter: dict[str, list[str]] = {}
    for k in sorted(keys):
        by_letter.setdefault(k[0], []).append(k[1:].replace(" ", GAP))
    body = "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in by_letter.items())
    return f"(?i)(?<![0-9A-Za-z\\x80-\\x{{10FFFF}}])(?:{body})"


def _table() -> Column:
    """The rules as a constant array, in order."""
    return F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(label).alias("label"), F.lit(keyword).alias("keyword"),
                              F.lit(f"(?<= ){expr}(?= )").alias("expr"), F.lit(priority).alias("priority"))
                     for k, (label, keyword, expr, priority) in enumerate(rules())])


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _places(norm: Column, expr: Column, extra) -> Column:
    """Every place of a pattern: struct(start, stop, *extra), in words. ``norm``
    has one space before, between and after its words."""
    def located(found: Column) -> Column:
        def build(pieces: Column) -> Column:
            gaps = F.transform(pieces, _spaces)
            inner = F.transform(found, _spaces)
            begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
            walked = F.aggregate(
                F.sequence(F.lit(0), F.size(found) - 1), begin,
                lambda acc, k: F.struct((acc["at"] + F.get(gaps, k) + F.get(inner, k)).alias("at"),
                                        F.concat(acc["starts"], F.array(acc["at"] + F.get(gaps, k) - 1)).alias("starts")))
            return F.transform(walked["starts"], lambda s, k: F.struct(
                s.alias("start"), (-(s + F.get(inner, k) + 1)).alias("neg_stop"), *extra))
        return let(F.split(norm, expr), build)

    empty = F.array().cast("array<struct<start:int,neg_stop:int,neg_priority:int,rule:int,label:string>>")
    return let(F.regexp_extract_all(norm, expr, 0),
               lambda found: F.when(F.size(found) == 0, empty).otherwise(located(found)))


def _swept(places: Column) -> Column:
    """Walk the places by start, longest first, with the furthest stop seen at
    each priority or above: a place inside an earlier one is suppressed."""
    levels = range(TAG + 1)
    begin = F.struct(F.array(*[F.lit(-1)] * len(levels)).alias("reach"),
                     F.array().cast("array<struct<start:int,stop:int,label:string,priority:int>>").alias("kept"))

    def step(acc, p):
        stop, priority = -p["neg_stop"], -p["neg_priority"]
        reach = F.transform(acc["reach"], lambda r, k: F.when(priority >= k, F.greatest(r, stop)).otherwise(r))
        inside = F.get(acc["reach"], priority) >= stop
        kept = F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(F.struct(
            p["start"].alias("start"), stop.alias("stop"), p["label"].alias("label"), priority.alias("priority")))))
        return F.struct(reach.alias("reach"), kept.alias("kept"))

    return F.aggregate(F.array_sort(places), begin, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``__d`` (the input row as a struct), n_words, base (start words and
    labels of the base phrases) and places (start, stop, label, priority of the
    rules' places that stay; stop exclusive)."""
    text = F.coalesce(F.col(f"__d.{text_col}"), F.lit(""))
    rows = docs.select(F.struct("*").alias("__d"))
    rows = rows.withColumn("n_words", F.regexp_count(text, F.lit(WORD)).cast("long"))
    norm = F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, " ")), F.lit(" "))
    rows = rows.withColumn("__norm", F.when(text.rlike(any_keyword()), norm))

    def by_rule(n: Column) -> Column:
        def one(r: Column) -> Column:
            return _places(n, r["expr"], [(-r["priority"]).alias("neg_priority"), r["rule"].alias("rule"),
                                          r["label"].alias("label")])
        return _swept(F.flatten(F.transform(F.filter(_table(), lambda r: F.contains(n, F.concat(F.lit(" "), r["keyword"]))), one)))

    base = F.flatten(F.array(*[
        _places(F.col("__norm"), F.lit(f"(?<= ){phrase}(?= )"),
                [F.lit(0).alias("neg_priority"), F.lit(0).alias("rule"), F.lit(label).alias("label")])
        for phrase, label in BASE.items()]))
    rows = rows.withColumn("base", F.when(F.col("__norm").isNotNull(), base))
    return rows.withColumn("places", F.when(F.col("__norm").isNotNull(), by_rule(F.col("__norm")))).drop("__norm")


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The scan's digest: ``__d``, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best confidence of a place that stays) and
    places."""
    rows = scan(docs, text_col)
    starts = F.transform("base", lambda p: p["start"])
    base_labels = F.coalesce(F.transform("base", lambda p: p["label"]), F.array().cast("array<string>"))
    all_labels = F.concat(base_labels, F.coalesce(F.transform("places", lambda p: p["label"]), F.array().cast("array<string>")))
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    confidence = F.array(*[F.lit(CONFIDENCE[k]) for k in sorted(CONFIDENCE)])
    best = F.array_max(F.transform("places", lambda p: p["priority"]))
    return rows.select(
        "__d", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(all_labels).alias("labels"),
        F.coalesce(F.get(confidence, best), F.when(F.size("base") > 0, F.lit(CONFIDENCE[FAMILY])), F.lit(0.0)).alias("score"),
        "places")
