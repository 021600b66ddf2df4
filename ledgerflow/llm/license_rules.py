"""The signature rules of the licence scan, as a table that is made from names, versions and forms.

A rule is a pattern over the words that follow from a place on. Words are lower-cased runs of
letters, digits and signs beyond ASCII; each stands between two blanks of its own (" mit  license "),
so matches of neighbouring words never share a character. Patterns use literals, optional groups and
short alternatives only: no match depends on how far a pattern may backtrack.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """`first`: the word it begins with; `need`: words that must stand somewhere in the window;
    `pattern`: from the first word on; `base`: one of the phrases that are always reported."""

    first: str
    need: str
    pattern: str
    label: str
    priority: int
    weight: float
    base: bool = False


# The phrases that are always reported, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Names of licences: label, name, versions.
NAMES = (
    ("agpl", "gnu affero general public license", "1.0 3.0"),
    ("gpl", "gnu general public license", "1.0 2.0 3.0"),
    ("gpl", "gnu gpl", "1.0 2.0 3.0"),
    ("lgpl", "gnu lesser general public license", "2.1 3.0"),
    ("lgpl", "gnu library general public license", "2.0"),
    ("gfdl", "gnu free documentation license", "1.1 1.2 1.3"),
    ("apache", "apache license", "1.0 1.1 2.0"),
    ("apache", "apache software license", "1.1 2.0"),
    ("mit", "mit license", ""),
    ("mit", "expat license", ""),
    ("bsd", "bsd license", ""),
    ("bsd-2-clause", "bsd 2 clause license", ""),
    ("bsd-2-clause", "simplified bsd license", ""),
    ("bsd-3-clause", "bsd 3 clause license", ""),
    ("bsd-3-clause", "new bsd license", ""),
    ("bsd-4-clause", "bsd 4 clause license", ""),
    ("0bsd", "zero clause bsd license", ""),
    ("isc", "isc license", ""),
    ("zlib", "zlib license", ""),
    ("boost", "boost software license", "1.0"),
    ("mpl", "mozilla public license", "1.0 1.1 2.0"),
    ("epl", "eclipse public license", "1.0 2.0"),
    ("cddl", "common development and distribution license", "1.0 1.1"),
    ("cpl", "common public license", "1.0"),
    ("eupl", "european union public licence", "1.1 1.2"),
    ("artistic", "artistic license", "1.0 2.0"),
    ("psf", "python software foundation license", "2.0"),
    ("ofl", "sil open font license", "1.1"),
    ("osl", "open software license", "3.0"),
    ("afl", "academic free license", "3.0"),
    ("ms-pl", "microsoft public license", ""),
    ("ms-rl", "microsoft reciprocal license", ""),
    ("postgresql", "postgresql license", ""),
    ("php", "php license", "3.0"),
    ("ruby", "ruby license", ""),
    ("openssl", "openssl license", ""),
    ("odbl", "open database license", "1.0"),
    ("odc-by", "open data commons attribution license", "1.0"),
    ("pddl", "public domain dedication and license", "1.0"),
    ("cecill", "cecill free software license", "2.0 2.1"),
    ("elastic", "elastic license", "2.0"),
    ("sspl", "server side public license", "1.0"),
    ("busl", "business source license", "1.1"),
    ("ncsa", "university of illinois open source license", ""),
)
#: The elements of a Creative Commons licence, as a code and as words.
CC_ELEMENTS = (("by", "attribution"), ("nc", "(?: non  commercial | noncommercial )"), ("nd", "(?: no  derivatives | noderivatives | no  derivs | noderivs )"), ("sa", "(?: share  alike | sharealike )"))
CC_KINDS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
#: What grants use before a licence's name.
LEADS = ("licensed under", "released under", "distributed under", "published under", "available under", "provided under", "subject to")
#: Sentences of licence texts.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("unlicense", "unencumbered software released into the public domain"),
    ("zlib", "altered source versions must be plainly marked as such"),
    ("cc0", "cc0 public domain dedication"),
    ("public-domain", "dedicated to the public domain"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("all-rights-reserved", "all rights reserved"),
)

#: Words of the window that begins with a rule's first word: as many as the longest rule can take.
WINDOW = 24


def _words(text: str) -> str:
    return "".join(f" {w} " for w in text.split())


def _version(version: str) -> str:
    """Pattern of a version after a name: `2.0` is `2 0`, `2` or `v2`."""
    major, minor = version.split(".")
    tail = f" {minor} " if minor != "0" else f"(?: {minor} )?"
    return f"(?: version )?(?: v )? v?{major} {tail}"


def _cc_words(kind: str) -> str:
    parts = dict(CC_ELEMENTS)
    return "".join(parts[k] if "(" in parts[k] else f" {parts[k]} " for k in kind.split("-"))


def make_rules() -> list[Rule]:
    """All rules in a fixed order; a rule's number is its place."""
    rules = [Rule(p.split()[0], p.split()[1], _words(p), label, 1, 0.7, True) for p, label in BASE.items()]
    named = [(label, _words(name), name.split(), versions.split()) for label, name, versions in NAMES]
    for kind in CC_KINDS:
        codes = kind.replace("-", " ")
        named.append((f"cc-{kind}", _words(f"cc {codes}"), ["cc", *codes.split()], CC_VERSIONS.split()))
        named.append((f"cc-{kind}", _words("creative commons") + _cc_words(kind), ["creative", "commons"], CC_VERSIONS.split()))
    for label, name, words, versions in named:
        need = words[1]
        rules.append(Rule(words[0], need, name, label, 2, 0.8))
        for v in versions:
            rules.append(Rule(words[0], need, name + _version(v), f"{label}-{v}", 4, 0.95))
            if "gpl" in label:
                rules.append(Rule(words[0], need, name + _version(v) + _words("or") + "(?: at  your  option )?(?: any )?" + _words("later"), f"{label}-{v}-or-later", 5, 0.95))
        for lead in LEADS:
            terms = "(?: the )?(?: terms  of )?(?: the )?(?: a )?"
            rules.append(Rule(lead.split()[0], words[0], _words(lead) + terms + name, label, 3, 0.9))
        if not versions:
            rules.append(Rule("spdx", words[0], _words("spdx license identifier") + name.replace(" license ", "(?: license )?"), label, 6, 1.0))
    for label in ("gpl", "lgpl", "agpl", "apache", "mpl", "epl"):
        versions = next(v for n, _, v in NAMES if n == label).split()
        rules += [Rule("spdx", label, _words(f"spdx license identifier {label}") + _version(v), f"{label}-{v}", 6, 1.0) for v in versions]
    rules += [Rule(text.split()[0], text.split()[-1], _words(text), label, 4, 0.9) for label, text in SENTENCES]
    return rules


RULES = make_rules()
