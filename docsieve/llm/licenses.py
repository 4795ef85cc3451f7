"""License scan by ordered signature rules.

A rule is a regular expression over the text's words, with pieces of text of which one is in every
match and must be present before the expression is tried, and a tier. Where detections overlap, one that lies inside another of
the same or a higher tier is dropped; of two on the same words the earlier rule stays.

For matching, a text is written as its words with their numbers, `` 0:under  1:the ``, so that a
match carries its own place and nothing has to be counted afterwards.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.llm.common import held, let, lower_ascii, whole, written

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SCORES = {3: 1.0, 2: 0.8, 1: 0.5}


class Rule(NamedTuple):
    label: str
    tier: int
    keyword: str
    pattern: str
    # Pieces of the numbered text of which every match holds one; by default the keyword as a whole word.
    gates: tuple[str, ...] = ()


# Fixed by the contract of the scan.
BASE = [
    Rule("mit", 3, "mit", "under the mit license"),
    Rule("apache-2", 3, "apache", "apache license version 2"),
    Rule("cc-by-nc", 3, "cc", "cc by nc"),
]

# label, keyword, name, identifier (as words)
_FAMILIES = [
    ("mit", "mit", "(?:mit|mit x11|mit expat)", "mit"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?(?:2|v2)(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?1 1", "apache 1 1"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("gpl-2", "gpl", "(?:gnu )?gpl(?: version| v)? ?(?:2|v2)(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-2", "general", "(?:gnu )?general public license(?: version| v)? ?(?:2|v2)(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gpl", "(?:gnu )?gpl(?: version| v)? ?(?:3|v3)(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-3", "general", "(?:gnu )?general public license(?: version| v)? ?(?:3|v3)(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?(?:2|v2) 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.1", "general", "(?:gnu )?(?:lesser|library) general public license(?: version| v)? ?(?:2|v2) 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?(?:3|v3)(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?(?:3|v3)(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "agpl", "(?:gnu )?agpl(?: version| v)? ?(?:3|v3)(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?: version| v)? ?(?:3|v3)(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "free", "(?:gnu )?free documentation license(?: version 1 [0-9])?", "gfdl 1 [0-9](?: only| or later)?"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? 1 1", "mpl 1 1"),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0"),
    ("cddl-1", "common", "common development and distribution license(?: version 1 [01])?", "cddl 1 [01]"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "(?:zlib|zlib libpng)", "zlib"),
    ("boost-1", "boost", "boost(?: software)?(?: license)?(?: version)? 1 0", "bsl 1 0"),
    ("artistic-2", "artistic", "artistic license(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("python-2", "python", "python software foundation license(?: version 2)?", "(?:python|psf) 2 0"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1.1", "font", "(?:sil )?open font license(?: version)?(?: 1 1)?", "ofl 1 1"),
    ("eupl-1.2", "european", "european union public licen[cs]e(?: version| v)?(?: 1 2)?", "eupl 1 2"),
    ("odbl", "database", "open database license(?: version| v)?(?: 1 0)?", "odbl 1 0"),
    ("odc-by", "data", "open data commons attribution license", "odc by 1 0"),
    ("cc0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("bsl-1.1", "business", "business source license(?: 1 1)?", "busl 1 1"),
    ("sspl-1", "server", "server side public license(?: version| v)?(?: ?1)?", "sspl 1 0"),
    ("elastic-2", "elastic", "elastic license(?: version| v)? ?(?:2|v2)(?: 0)?", "elastic 2 0"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("ncsa", "ncsa", "(?:university of illinois ncsa|ncsa open source)", "ncsa"),
    ("upl-1", "universal", "universal permissive license(?: version| v)?(?: 1 0)?", "upl 1 0"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
]

# Names that a version may be joined to, as in gplv2, and a name with its keyword inside a longer word.
_GATES = {k: (f":{k}",) for k in ("apache", "gpl", "lgpl", "agpl")} | {"bsd": (":bsd ", ":freebsd ")}

# Creative Commons: the four attribution forms in four versions, built by rule.
_CC = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nc": "attribution non ?commercial",
       "by-nd": "attribution no ?deriv(?:atives|s)"}

_NOTICES = [
    Rule("mit", 3, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    Rule("apache-2", 3, "apache", "www apache org licenses license 2 0"),
    Rule("bsd-3-clause", 3, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    Rule("isc", 3, "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    # This sentence names no license: its keyword is a condition of its own, not a piece of the match.
    Rule("gpl-2", 3, "gnu", "either version 2 of the license or at your option any later version"),
    Rule("gpl-3", 3, "gnu", "either version 3 of the license or at your option any later version"),
    Rule("mpl-2", 3, "mozilla", "mozilla org mpl 2 0"),
    Rule("unlicense", 3, "unencumbered", "this is free and unencumbered software released into the public domain"),
    Rule("public-domain", 2, "domain", "(?:released|placed|dedicated|put) (?:in|into|to) the public domain"),
    Rule("public-domain", 1, "domain", "public domain"),
    Rule("proprietary", 2, "rights", "all rights reserved"),
    Rule("proprietary", 1, "confidential", "proprietary and confidential"),
]

_GRANT = "(?:licensed|released|distributed|available|provided|published|covered|offered|free) under (?:the )?(?:terms of )?(?:the )?"


def all_rules() -> list[Rule]:
    """The rules in order: base, notices, then for every license its tag, grant, named and address form."""
    rules = BASE + _NOTICES
    for label, keyword, name, ident in _FAMILIES:
        rules += [
            Rule(label, 3, "spdx", f"spdx license identifier {ident}"),
            Rule(label, 2, keyword, f"{_GRANT}{name}(?: licen[cs]e)?", _GATES.get(keyword, ())),
            Rule(label, 1, keyword, f"{name} licen[cs]e", _GATES.get(keyword, ())),
            Rule(label, 1, "license", f"license {ident}"),
        ]
    for kind, spoken in _CC.items():
        label, code = f"cc-{kind}", kind.replace("-", " ")
        for version in ("1", "2", "3", "4"):
            rules += [
                Rule(f"{label}-{version}", 3, "spdx", f"spdx license identifier cc {code} {version} 0"),
                Rule(f"{label}-{version}", 2, "cc", f"cc {code} {version}(?: 0)?"),
                Rule(f"{label}-{version}", 2, "commons", f"creative commons {spoken} {version}(?: 0)?"),
                Rule(f"{label}-{version}", 3, "creativecommons", f"creativecommons org licenses {code} {version} 0"),
            ]
        rules += [Rule(label, 1, "cc", f"cc {code}"), Rule(label, 1, "commons", f"creative commons {spoken}")]
    return list(dict.fromkeys(rules))


RULES = all_rules()


def regex(pattern: str) -> str:
    """The pattern over numbered words: every word has a blank on both sides of its own."""
    between = r"  \d+:"
    parts = [part.replace(" ", between) for part in pattern.split(" ?")]
    return r" \d+:" + f"(?:{between})?".join(parts) + " "


def numbered(ws: Column) -> Column:
    return F.array_join(F.transform(ws, lambda w, i: F.concat(F.lit(" "), i.cast("string"), F.lit(":"), w, F.lit(" "))), "")


def gates(rule: Rule) -> tuple[str, ...]:
    """Pieces of which a text must hold one. All matches do, but for the notices of ``gnu``, where it is asked for besides."""
    return rule.gates or (f":{rule.keyword} ",)


def _found(text: Column, rules: list[Rule]) -> Column:
    """(start, length, rule) of every match in the numbered text."""
    table = F.array(*[
        F.struct(
            F.lit(i).alias("rule"), F.array(*[F.lit(g) for g in gates(r)]).alias("gates"), F.lit(regex(r.pattern)).alias("rx")
        )
        for i, r in enumerate(rules)
    ])
    pieces = F.array(*[F.lit(g) for g in sorted({g for r in rules for g in gates(r)})])
    of_rule = lambda r: F.transform(
        F.regexp_extract_all(text, r["rx"], F.lit(0)),
        lambda m: F.struct(
            F.ltrim(F.substring_index(m, ":", 1)).cast("long").alias("start"),
            F.regexp_count(m, F.lit(":")).cast("long").alias("length"),
            r["rule"].alias("rule"),
        ),
    )
    return let(
        F.filter(pieces, lambda g: F.contains(text, g)),
        lambda there: F.flatten(F.transform(F.filter(table, lambda r: F.arrays_overlap(r["gates"], there)), of_rule)),
    )


def detections(docs: DataFrame, key: str, text: str, rules: list[Rule] = RULES) -> DataFrame:
    """(key, text_hash, n_words, found): all matches of a document before suppression, row by row.

    A null text counts as empty. Texts without any keyword only have their words counted.
    """
    low = lower_ascii(whole(docs[text]))
    keywords = sorted({r.keyword for r in rules})
    # Words inside longer words pass here as well; the numbered text is exact.
    hints = [k for k in keywords if not any(o != k and o in k for o in keywords)]
    gate = F.lit(False)
    for k in hints:
        gate = gate | F.contains(F.col("_low"), F.lit(k))
    rows = held(docs.select(docs[key].alias("key"), docs[text].alias("_text")), _low=lower_ascii(whole(F.col("_text"))))
    counted = rows.select(
        "key",
        F.xxhash64("_low").alias("text_hash"),
        F.regexp_count("_low", F.lit(LICENSE_WORD)).cast("long").alias("n_words"),
        F.when(gate, F.col("_low")).alias("_low"),
    )
    words = F.array_remove(F.split(F.col("_low"), _NOT_WORD), "")
    marked = held(counted, _marked=numbered(words))
    found = F.coalesce(_found(F.col("_marked"), rules), F.array().cast("array<struct<start:bigint,length:bigint,rule:int>>"))
    return held(marked, found=found).select("key", "text_hash", "n_words", "found")


def surviving(found: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(key, text_hash, start, length, rule, label, tier) of ``detections`` that no other suppresses."""
    tiers = F.array(*[F.lit(r.tier) for r in rules])
    labels = F.array(*[F.lit(r.label) for r in rules])
    spans = found.select("key", "text_hash", F.inline("found"))
    spans = spans.select(
        "*", F.get(labels, F.col("rule")).alias("label"), F.get(tiers, F.col("rule")).alias("tier"),
        (F.col("start") + F.col("length")).alias("end"),
    )
    before = (
        Window.partitionBy("key", "text_hash")
        .orderBy("start", F.desc("end"), F.desc("tier"), "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = {t: F.max(F.when(F.col("tier") >= t, F.col("end"))).over(before) for t in SCORES}
    inside = F.lit(False)
    for t, far in reach.items():
        inside = inside | ((F.col("tier") == t) & (F.coalesce(far, F.lit(0)) >= F.col("end")))
    return spans.withColumn("_inside", inside).where("NOT _inside").drop("_inside", "end")


def scan(docs: DataFrame, key: str, text: str, rules: list[Rule] = RULES, base: int = len(BASE)) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``base`` rules, the first of the list, are counted everywhere and keep their labels; the
    others add the labels that survive suppression. The score is that of the best surviving
    tier, 0 without any. Repeated rows give equal rows; null keys are keys like others; an empty
    table gives no rows; other columns are not used.
    """
    found = written(detections(docs, key, text, rules), "licenses")
    labels = F.array(*[F.lit(r.label) for r in rules[:base]])
    scores = F.create_map(*[F.lit(x) for pair in SCORES.items() for x in pair])
    kept = surviving(found, rules).groupBy(F.col("key").alias("_k"), F.col("text_hash").alias("_h")).agg(
        F.collect_set("label").alias("_labels"), F.max("tier").alias("_tier")
    )
    base_found = F.filter("found", lambda d: d["rule"] < base)
    rows = held(found, _base=base_found).select(
        "key", "text_hash", "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda d: d["start"])).alias("first_word"),
        F.array_max(F.transform("_base", lambda d: d["start"])).alias("last_word"),
        F.array_distinct(F.transform("_base", lambda d: F.get(labels, d["rule"]))).alias("_own"),
    )
    joined = rows.join(kept, (F.col("key").eqNullSafe(F.col("_k"))) & (F.col("text_hash") == F.col("_h")), "left")
    joined_labels = lambda a: F.array_join(F.sort_array(a), ",")
    both = F.array_union("_own", F.coalesce("_labels", F.array().cast("array<string>")))
    return joined.select(
        "key", "n_words", "n_base", "first_word", "last_word",
        joined_labels(F.col("_own")).alias("base_labels"),
        joined_labels(both).alias("labels"),
        F.coalesce(scores[F.col("_tier")], F.lit(0.0)).alias("score"),
    )
