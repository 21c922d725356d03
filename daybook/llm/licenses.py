"""License detection by ordered signature rules, with SQL functions only.

A text is reduced to its words (A-Z as a-z, joined by single spaces).  Each
rule is a regular expression over that form, with a label, a priority (smaller
is stronger) and a keyword without which it can't match; only rules whose
keyword occurs are tried.  Detections are ordered by start, longest first; one
that lies inside another of the same or a stronger priority is suppressed.
The work is done row by row inside the scan: no rows are exchanged.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases that always label a text (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_V = {"any": [""], "apache": ["1 0", "1 1", "2 0"], "gnu": ["1 0", "2 0", "2 1", "3 0"], "cc": ["1 0", "2 0", "2 5", "3 0", "4 0"], "two": ["1 0", "2 0"]}
#: label, expression for the name, keyword, versions.
_FAMILIES = [
    ("mit", "mit", "mit", "any"), ("mit-0", "mit (?:0|no attribution)", "mit", "any"), ("isc", "isc", "isc", "any"),
    ("x11", "x11", "x11", "any"), ("zlib", "zlib(?: libpng)?", "zlib", "any"), ("unlicense", "(?:the )?unlicense", "unlicense", "any"),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", "w", "any"), ("beerware", "beerware", "beerware", "any"),
    ("bsd-0", "(?:0 clause bsd|0bsd|zero clause bsd)", "bsd", "any"), ("bsd-2", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd", "any"),
    ("bsd-3", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", "bsd", "any"), ("bsd-4", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd", "any"),
    ("apache", "(?:the )?apache(?: software)?", "apache", "apache"), ("gpl", "(?:gnu )?(?:gpl|general public)", "g", "gnu"),
    ("lgpl", "(?:gnu )?(?:lgpl|lesser general public|library general public)", "l", "gnu"), ("agpl", "(?:gnu )?(?:agpl|affero general public)", "a", "gnu"),
    ("gfdl", "(?:gnu )?(?:gfdl|free documentation)", "f", "gnu"), ("mpl", "(?:mpl|mozilla public)", "m", "apache"),
    ("epl", "(?:epl|eclipse public)", "e", "two"), ("eupl", "(?:eupl|european union public)", "eu", "two"), ("cddl", "(?:cddl|common development and distribution)", "c", "two"),
    ("artistic", "artistic", "artistic", "two"), ("boost", "(?:boost software|bsl)", "b", "two"), ("afl", "academic free", "academic free", "cc"),
    ("osl", "open software", "open software", "cc"), ("odbl", "(?:odbl|open database)", "o", "two"), ("ofl", "(?:ofl|sil open font)", "o", "two"),
    ("postgresql", "postgresql", "postgresql", "any"), ("python", "(?:psf|python software foundation)", "p", "any"), ("ruby", "ruby", "ruby", "any"),
    ("php", "php", "php", "gnu"), ("openssl", "openssl", "openssl", "any"), ("ms-pl", "(?:ms pl|microsoft public)", "m", "any"), ("cc0", "(?:cc0|cc zero|creative commons zero)", "c", "two"),
]
_CC = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
_CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s", "nc": "non ?commercial"}
#: Form of a rule: (expression around the name {n} and version {v}, priority).
_FORMS = [
    (r"spdx license identifier {n}{v}(?: only| or later)?", 0),
    (r"(?:released|licen[sc]ed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}(?: licen[sc]e)?{v}", 1),
    (r"{n} licen[sc]e{v}", 2),
]
#: Acronyms that with a version (v2, version 2) are a statement by themselves.
_ACRONYMS = {"gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "eupl", "cddl"}
#: Full sentences of well-known texts: label, expression, keyword.
_TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "redistribute it"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
]
#: Confidence of a detection by its rule's priority; a base phrase is certain.
_SCORES = [0.95, 0.85, 0.7]
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, expression, keyword) of every rule, strongest first."""
    names = [(*f[:3], _V[f[3]]) for f in _FAMILIES]
    for kind in _CC:
        words = " ".join(_CC_WORDS[w] for w in kind.split())
        names.append((f"cc-{kind.replace(' ', '-')}", f"(?:cc {kind}|creative commons {words})", "c", _V["cc"]))
    found = [(label, 0, text, word) for label, text, word in _TEXTS]
    for (label, name, word, versions), (form, priority) in product(names, _FORMS):
        gate = "spdx" if priority == 0 else "under" if priority == 1 else word if len(word) > 2 else "licen"
        for v in dict.fromkeys(["", *versions]):
            number = f"(?: version)? ?(?:v ?)?{_number(v)}" if v else ""
            tag = f"{label}-{v.replace(' ', '.')}" if v else label
            found.append((tag, priority, form.format(n=name, v=number), gate))
    for label, _, _, versions in names:
        for v in versions if label in _ACRONYMS else []:
            found.append((f"{label}-{v.replace(' ', '.')}", 2, f"(?:gnu )?{label}(?: version ?v?| ?v) ?{_number(v)}", label))
    for kind in _CC:  # the short form is a statement by itself
        found.append((f"cc-{kind.replace(' ', '-')}", 2, f"cc {kind}", "cc by"))
    return sorted(found, key=lambda r: r[1])


def _number(version: str) -> str:
    """Expression of a version: its two parts, or the first alone if the second is 0; another minor number doesn't follow."""
    major, minor = version.split(" ")
    return f"{major}(?: 0)?(?! [0-9] )" if minor == "0" else f"{major} {minor}"


def _places(pattern: str) -> str:
    """SQL for the matches of a pattern (SQL text) in ``words``: array of (start, stop, word), in code points and words."""
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    step = (
        "named_struct('at', s.at + length(z.p) + coalesce(length(z.h), 0),"
        f" 'word', s.word + {spaces.format('z.p')} + coalesce({spaces.format('z.h')}, 0),"
        " 'out', if(z.h IS NULL, s.out, array_append(s.out, named_struct('start', s.at + length(z.p),"
        f" 'stop', s.at + length(z.p) + length(z.h), 'word', s.word + {spaces.format('z.p')}))))"
    )
    zipped = f"zip_with(split(words, {pattern}, -1), regexp_extract_all(words, {pattern}, 0), (p, h) -> named_struct('p', p, 'h', h))"
    empty = "CAST(array() AS array<struct<start:int,stop:int,word:int>>)"
    return f"aggregate({zipped}, named_struct('at', 0, 'word', -1, 'out', {empty}), (s, z) -> {step}, s -> s.out)"


def _quoted(s: str) -> str:
    return "r'" + s + "'"


def detect_licenses(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) and what the rules find in every whole text.

    n_words; base (array of (label, word): places of the BASE phrases, by
    label and word); detections (array of (start, stop, priority, label) that
    are not suppressed, by start; places in the text reduced to words); labels
    (sorted, distinct) of both; score, the confidence of the surest one, 0
    without any.  A null or empty text has no words and no labels; repeated
    rows are each looked at.
    """
    whole = F.struct(*(docs[c] for c in (docs.columns if carry is None else carry)))
    words = F.btrim(F.regexp_replace(F.expr(_LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    given = docs.select(whole.alias("row"), F.concat(F.lit(" "), words, F.lit(" ")).alias("words"))
    base = []
    for phrase, label in BASE.items():
        head, rest = phrase.split(" ", 1)
        places = _places(_quoted(f"(?<= ){head}(?= {rest} )"))
        base.append(f"if(contains(words, ' {phrase} '), transform({places}, p -> named_struct('label', '{label}', 'word', CAST(p.word AS LONG))), array())")
    table = "array(" + ",".join(
        f"named_struct('label', '{label}', 'priority', {p}, 're', {_quoted(f'(?<= )(?:{e})(?= )')}, 'gate', '{gate}')" for label, p, e, gate in rules()
    ) + ")"
    gates = "array(" + ",".join(f"'{g}'" for g in sorted({r[3] for r in rules()})) + ")"
    gated = f"filter({table}, r -> array_contains(gates, r.gate) AND words RLIKE r.re)"
    hits = f"transform({gated}, r -> transform({_places('r.re')}, p -> named_struct('start', p.start, 'stop', -p.stop, 'priority', r.priority, 'label', r.label)))"
    reach = [f"if(x.priority = {i}, greatest(s.m{i}, -x.stop), s.m{i})" for i in range(3)]
    hidden = " OR ".join(f"(x.priority >= {i} AND s.m{i} >= -x.stop)" for i in range(3))
    none = "CAST(array() AS array<struct<start:int,stop:int,priority:int,label:string>>)"
    fold = (
        f"aggregate(array_sort(found), named_struct('m0', 0, 'm1', 0, 'm2', 0, 'out', {none}), (s, x) -> named_struct("
        + ", ".join(f"'m{i}', {r}" for i, r in enumerate(reach))
        + f", 'out', if({hidden}, s.out, array_append(s.out, named_struct('start', x.start, 'stop', -x.stop, 'priority', x.priority, 'label', x.label)))), s -> s.out)"
    )
    out = given.withColumn("base", F.expr(f"concat({', '.join(base)})")).withColumn(
        "gates", F.expr(f"if(words RLIKE 'licen|unlicense|spdx|under|cc by|hereby|permission|redistribut|public domain|rights|proprietary|{'|'.join(sorted(_ACRONYMS))}', filter({gates}, g -> if(g = 'under', words RLIKE ' (?:released|licen[sc]ed|distributed|available|published) under ', contains(words, g))), array())")
    )
    out = out.withColumn("found", F.expr(f"if(size(gates) = 0, array(), flatten({hits}))")).withColumn("detections", F.expr(fold))
    score = "CASE " + " ".join(f"WHEN exists(detections, d -> d.priority = {i}) THEN {s}D" for i, s in enumerate(_SCORES)) + " ELSE 0D END"
    return out.select(
        "row",
        F.expr("if(length(words) = 2, 0L, CAST(length(words) - length(replace(words, ' ', '')) - 1 AS LONG))").alias("n_words"),
        "base",
        "detections",
        F.expr("array_sort(array_distinct(concat(transform(base, b -> b.label), transform(detections, d -> d.label))))").alias("labels"),
        F.expr(f"if(size(base) > 0, 1D, {score})").alias("score"),
    )
