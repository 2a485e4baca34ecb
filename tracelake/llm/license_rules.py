"""The signature rules of the licence scan.

Rules are ordered regular expressions over normalised words: lower case, joined
by single blanks. Families of licences are written down by hand; each is put
into the forms in which licences are named, so that there are several hundred
rules. The forms' priorities say which of two detections that contain one
another stays.
"""

from __future__ import annotations

from dataclasses import dataclass

# Phrases that count as base places, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

V = "(?:version |v ?)?"

# Licences by hand: label, keyword that gates its rules, ways to name it.
FAMILIES = [
    ("gpl-1.0", "gpl", [f"gnu (?:general public license|gpl) {V}1(?: 0)?", "gplv1", f"gpl {V}1(?: 0)?"]),
    ("gpl-2.0", "gpl", [f"gnu (?:general public license|gpl) {V}2(?: 0)?", "gplv2", f"gpl {V}2(?: 0)?"]),
    ("gpl-3.0", "gpl", [f"gnu (?:general public license|gpl) {V}3(?: 0)?", "gplv3", f"gpl {V}3(?: 0)?"]),
    ("lgpl-2.0", "lgpl", [f"gnu (?:library|lesser) general public license {V}2 0", f"lgpl {V}2 0"]),
    ("lgpl-2.1", "lgpl", [f"gnu lesser general public license {V}2 1", f"lgpl {V}2 1", "lgplv2 1"]),
    ("lgpl-3.0", "lgpl", [f"gnu lesser general public license {V}3(?: 0)?", f"lgpl {V}3(?: 0)?", "lgplv3"]),
    ("lgpl", "gnu", ["gnu (?:library|lesser) general public license", "gnu lgpl"]),
    ("agpl-3.0", "affero", [f"gnu affero general public license {V}3(?: 0)?"]),
    ("agpl-3.0", "agpl", [f"agpl {V}3(?: 0)?", "agplv3"]),
    ("agpl", "affero", ["gnu affero general public license", "affero general public license"]),
    ("gfdl-1.2", "documentation", [f"gnu free documentation license {V}1 2"]),
    ("gfdl-1.3", "documentation", [f"gnu free documentation license {V}1 3"]),
    ("gfdl", "documentation", ["gnu free documentation license"]),
    ("apache-1.1", "apache", [f"apache (?:software )?license {V}1 1"]),
    ("apache-2.0", "apache", [f"apache (?:software )?license {V}2(?: 0)?", "apache 2 0", "apachev2"]),
    ("apache", "apache", ["apache software license", "apache license"]),
    ("mit", "mit", ["mit license", "mit expat license", "mit x11 license"]),
    ("mit-0", "mit", ["mit no attribution license", "mit no attribution"]),
    ("x11", "x11", ["x11 license"]),
    ("expat", "expat", ["expat license"]),
    ("bsd-0-clause", "bsd", ["bsd (?:zero|0) clause(?: license)?", "(?:zero|0) clause bsd(?: license)?"]),
    ("bsd-2-clause", "bsd", ["bsd (?:two|2) clause(?: license)?", "(?:two|2) clause bsd(?: license)?", "simplified bsd license", "freebsd license"]),
    ("bsd-3-clause", "bsd", ["bsd (?:three|3) clause(?: license)?", "(?:three|3) clause bsd(?: license)?", "(?:new|modified|revised) bsd license"]),
    ("bsd-4-clause", "bsd", ["bsd (?:four|4) clause(?: license)?", "(?:four|4) clause bsd(?: license)?", "original bsd license"]),
    ("bsd", "bsd", ["bsd style license", "bsd license"]),
    ("isc", "isc", ["isc license", "internet systems consortium license"]),
    ("zlib", "zlib", ["zlib license", "zlib libpng license"]),
    ("libpng", "libpng", ["libpng license"]),
    ("boost-1.0", "boost", [f"boost software license(?: {V}1 0)?"]),
    ("unlicense", "unlicense", ["the unlicense", "unlicense org"]),
    ("wtfpl", "wtfpl", ["wtfpl"]),
    ("mpl-1.0", "mozilla", [f"mozilla public license {V}1 0"]),
    ("mpl-1.1", "mozilla", [f"mozilla public license {V}1 1"]),
    ("mpl-2.0", "mozilla", [f"mozilla public license {V}2 0"]),
    ("mpl-2.0", "mpl", [f"mpl {V}2 0", "mplv2(?: 0)?"]),
    ("mpl", "mozilla", ["mozilla public license"]),
    ("epl-1.0", "eclipse", [f"eclipse public license {V}1 0"]),
    ("epl-2.0", "eclipse", [f"eclipse public license {V}2 0"]),
    ("epl", "eclipse", ["eclipse public license"]),
    ("edl-1.0", "eclipse", [f"eclipse distribution license(?: {V}1 0)?"]),
    ("cddl-1.0", "distribution", [f"common development and distribution license(?: {V}1 0)?"]),
    ("cpl-1.0", "common", [f"common public license(?: {V}1 0)?"]),
    ("eupl-1.1", "european", [f"european union public licen[cs]e {V}1 1"]),
    ("eupl-1.2", "european", [f"european union public licen[cs]e {V}1 2"]),
    ("artistic-1.0", "artistic", [f"artistic license {V}1 0"]),
    ("artistic-2.0", "artistic", [f"artistic license {V}2 0"]),
    ("artistic", "artistic", ["artistic license"]),
    ("python-2.0", "python", ["python software foundation license", "psf license"]),
    ("ruby", "ruby", ["ruby license"]),
    ("php-3.01", "php", [f"php license(?: {V}3 01)?"]),
    ("perl", "perl", ["same terms as perl itself", "same terms as perl"]),
    ("openssl", "openssl", ["openssl license", "openssl toolkit license"]),
    ("postgresql", "postgresql", ["postgresql license"]),
    ("ncsa", "ncsa", ["university of illinois ncsa open source license", "ncsa open source license"]),
    ("ofl-1.1", "sil", [f"sil open font license(?: {V}1 1)?"]),
    ("ofl", "font", ["open font license"]),
    ("ms-pl", "microsoft", ["microsoft public license"]),
    ("ms-rl", "microsoft", ["microsoft reciprocal license"]),
    ("upl-1.0", "universal", [f"universal permissive license(?: {V}1 0)?"]),
    ("afl-3.0", "academic", [f"academic free license(?: {V}3 0)?"]),
    ("osl-3.0", "open", [f"open software license(?: {V}3 0)?"]),
    ("odbl-1.0", "database", [f"open database license(?: {V}1 0)?", "odbl"]),
    ("odc-by-1.0", "commons", [f"open data commons attribution license(?: {V}1 0)?"]),
    ("pddl-1.0", "domain", [f"public domain dedication and license(?: {V}1 0)?"]),
    ("cecill-2.1", "cecill", [f"cecill free software license agreement(?: {V}2 1)?", "cecill"]),
    ("mulan-psl-2.0", "mulan", [f"mulan permissive software license(?: {V}2(?: 0)?)?", "mulanpsl2"]),
    ("bsl-1.1", "business", [f"business source license(?: {V}1 1)?"]),
    ("sspl-1.0", "server", [f"server side public license(?: {V}1(?: 0)?)?", "sspl"]),
    ("elastic-2.0", "elastic", [f"elastic license(?: {V}2 0)?"]),
    ("json", "json", ["json license"]),
    ("beerware", "beerware", ["beerware license", "beer ware license"]),
    ("cc0-1.0", "cc0", ["cc0(?: 1 0)?(?: universal)?"]),
    ("public-domain", "domain", ["(?:placed|dedicated|released) (?:in|to|into) the public domain"]),
]

# The six Creative Commons kinds and their versions, by rule.
CC_KINDS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?deriv(?:ative)?s",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Sentences of licence texts by hand: label, keyword, pattern.
SENTENCES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify"),
    ("gpl-2.0", "either", "either version 2 of the license or at your option any later version"),
    ("gpl-3.0", "either", "either version 3 of the license or at your option any later version"),
    ("gpl", "warranty", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu"),
    ("lgpl", "library", "this library is free software you can redistribute it and or modify"),
    ("agpl-3.0", "affero", "terms of the gnu affero general public license as published by the free software foundation"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache", "apache org licenses license 2 0"),
    ("mpl-2.0", "mozilla", f"subject to the terms of the mozilla public license {V}2 0"),
    ("epl-1.0", "eclipse", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", "eclipse org legal epl 2 0"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost-1.0", "boost", "boost org license 1 0"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("python-2.0", "psf", "psf license agreement for python"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("gpl", "gnu", "gnu org licenses gpl"),
    ("lgpl", "gnu", "gnu org licenses lgpl"),
    ("agpl", "gnu", "gnu org licenses agpl"),
    ("gfdl", "gnu", "gnu org (?:licenses|copyleft) fdl"),
    ("mit", "opensource", "opensource org licenses mit"),
    ("bsd-3-clause", "opensource", "opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "opensource", "opensource org licenses bsd 2 clause"),
    ("proprietary", "reserved", "all rights reserved"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("proprietary", "unauthorized", "unauthorized (?:copying|reproduction|distribution) of this file"),
    ("no-derivatives", "derivative", "no derivative works (?:are|may be) (?:permitted|made)"),
]

GRANT = "(?:licensed|released|distributed|published|available|provided|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?"
OR_LATER = " (?:or (?:at your option )?(?:any )?(?:later|newer)(?: version)?)"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float
    base: bool = False


def rules() -> list[Rule]:
    """All rules in order."""
    found = [
        Rule(label, phrase.split()[0], phrase, 10, 0.5, True)
        for phrase, label in BASE_PHRASES.items()
    ]
    for label, keyword, names in [*FAMILIES, *_creative_commons()]:
        spdx = label.replace("-", " ").replace(".", " ")
        found.append(Rule(label, "spdx", f"spdx license identifier {spdx}(?: only)?", 100, 0.99))
        if "gpl-" in label:
            found.append(Rule(f"{label}-or-later", "spdx", f"spdx license identifier {spdx} or later", 101, 0.99))
        for name in names:
            # a name that begins with a plain word is gated by that word
            first = name.split(" ")[0]
            gate = first if first.isalnum() else keyword
            if "gpl-" in label:
                found.append(Rule(f"{label}-or-later", gate, name + OR_LATER, 85, 0.9))
                found.append(Rule(f"{label}-or-later", gate, GRANT + name + OR_LATER, 86, 0.95))
            found.append(Rule(label, gate, GRANT + name, 80, 0.95))
            found.append(Rule(label, gate, name, 60, 0.8))
    for label, keyword, sentence in SENTENCES:
        found.append(Rule(label, keyword, sentence, 90, 0.7 if label == "proprietary" else 0.95))
    return found


def _creative_commons() -> list[tuple[str, str, list[str]]]:
    found = []
    for kind, long in CC_KINDS.items():
        short = kind.replace("-", " ")
        for version in CC_VERSIONS:
            digits = version.replace(".", " ")
            label = f"cc-{kind}-{version}"
            found.append((label, "cc", [f"cc {short} {digits}"]))
            found.append((label, "creativecommons", [f"creativecommons org licenses {short} {digits}"]))
            found.append((label, "creative", [f"creative commons {long} {digits}(?: international| unported| generic)?(?: license)?"]))
        found.append((f"cc-{kind}", "cc", [f"cc {short}"]))
        found.append((f"cc-{kind}", "creative", [f"creative commons {long}(?: license)?"]))
    return found
