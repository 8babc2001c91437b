"""Signature rules for licenses.

Patterns run over normalised text: the document's words in lower case with one blank between and around them, so
"GPL-2.0" reads " gpl 2 0 ". Every family is written by hand as (label, keyword, name, SPDX id, address); `rules`
makes its signatures from the ways a license is stated. A keyword is a word that each match of the name
contains; it gates the rules of the family.
"""

from __future__ import annotations

from dataclasses import dataclass

# How sure a signature is; a higher priority suppresses what lies inside it.
TAG, NOTICE, ADDRESS, NAME = 4, 3, 2, 1
CONFIDENCE = {TAG: 1.0, NOTICE: 0.95, ADDRESS: 0.9, NAME: 0.7}

#: Phrases whose places are counted, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

_V = r"(?: version| v)? ?"  # between a name and its number
_GPL = "(?:gnu )?(?:general public licen[sc]e|gpl)"
_LGPL = "(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl)"
_AGPL = "(?:gnu )?(?:affero general public licen[sc]e|agpl)"
_CC = "(?:creative commons|cc)"
_CC_WORDS = {
    "by": "(?:attribution|by)",
    "by-sa": "(?:attribution share ?alike|by sa)",
    "by-nd": "(?:attribution no ?derivatives|by nd)",
    "by-nc": "(?:attribution non ?commercial|by nc)",
    "by-nc-sa": "(?:attribution non ?commercial share ?alike|by nc sa)",
    "by-nc-nd": "(?:attribution non ?commercial no ?derivatives|by nc nd)",
}

# (label, keyword or keywords, name, SPDX id, address)
_FAMILIES = [
    ("mit", "mit", "mit licen[sc]e", "mit", "opensource org licenses mit"),
    ("mit", "expat", "expat licen[sc]e", "mit", "jclark com xml copying"),
    ("mit-0", "mit", "mit no attribution(?: licen[sc]e)?", "mit 0", "opensource org licenses mit 0"),
    ("x11", "x11", "x11 licen[sc]e", "x11", "xfree86 org 3 3 6 copyright2"),
    ("apache-1.0", "apache", rf"apache licen[sc]e{_V}1 0", "apache 1 0", "apache org licenses license 1 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?licen[sc]e{_V}1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache", rf"apache (?:software )?licen[sc]e{_V}2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache", "apache", "apache (?:software )?licen[sc]e", "apache", "apache org licenses"),
    ("gpl-1.0", "gpl general", rf"{_GPL}{_V}1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2.0", "gpl general", rf"{_GPL}{_V}2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3.0", "gpl general", rf"{_GPL}{_V}3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("gpl", "gpl general", _GPL, "gpl", "gnu org licenses gpl"),
    ("lgpl-2.0", "lgpl lesser library", rf"{_LGPL}{_V}2(?: 0)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "lgpl lesser library", rf"{_LGPL}{_V}2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses old licenses lgpl 2 1"),
    ("lgpl-3.0", "lgpl lesser library", rf"{_LGPL}{_V}3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lgpl", "lgpl lesser library", _LGPL, "lgpl", "gnu org licenses lgpl"),
    ("agpl-3.0", "agpl affero", rf"{_AGPL}{_V}3(?: 0)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("agpl", "agpl affero", _AGPL, "agpl", "gnu org licenses agpl"),
    ("gfdl-1.3", "gfdl documentation", rf"(?:gnu free documentation licen[sc]e|gfdl){_V}1 3", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    ("gfdl", "gfdl documentation", "(?:gnu free documentation licen[sc]e|gfdl)", "gfdl", "gnu org licenses fdl"),
    ("bsd-1-clause", "bsd", "(?:1|one) clause bsd licen[sc]e", "bsd 1 clause", "opensource org licenses bsd 1 clause"),
    ("bsd-2-clause", "bsd freebsd", "(?:(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:(?:3|three) clause bsd|bsd (?:3|three) clause|new bsd|modified bsd)(?: licen[sc]e)?", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd)(?: licen[sc]e)?", "bsd 4 clause", "directory fsf org wiki license bsd 4clause"),
    ("bsd", "bsd", "bsd(?: style)? licen[sc]e", "bsd", "opensource org licenses bsd license"),
    ("0bsd", "0bsd bsd", "(?:zero clause bsd|0 clause bsd|bsd zero clause)(?: licen[sc]e)?", "0bsd", "opensource org licenses 0bsd"),
    ("isc", "isc", "isc licen[sc]e", "isc", "opensource org licenses isc"),
    ("mpl-1.1", "mozilla mpl", rf"(?:mozilla public licen[sc]e|mpl){_V}1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla mpl", rf"(?:mozilla public licen[sc]e|mpl){_V}2(?: 0)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("mpl", "mozilla", "mozilla public licen[sc]e", "mpl", "mozilla org mpl"),
    ("epl-1.0", "eclipse epl", rf"(?:eclipse public licen[sc]e|epl){_V}1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse epl", rf"(?:eclipse public licen[sc]e|epl){_V}2(?: 0)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("epl", "eclipse", "eclipse public licen[sc]e", "epl", "eclipse org legal epl"),
    ("cddl-1.0", "cddl distribution", rf"(?:common development and distribution licen[sc]e|cddl){_V}1(?: 0)?", "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cddl", "cddl distribution", "(?:common development and distribution licen[sc]e|cddl)", "cddl", "opensource org licenses cddl"),
    ("cpl-1.0", "common", rf"common public licen[sc]e(?:{_V}1 0)?", "cpl 1 0", "opensource org licenses cpl1 0"),
    ("artistic-1.0", "artistic", rf"artistic licen[sc]e{_V}1(?: 0)?", "artistic 1 0", "opensource org licenses artistic 1 0"),
    ("artistic-2.0", "artistic", rf"artistic licen[sc]e{_V}2(?: 0)?", "artistic 2 0", "opensource org licenses artistic 2 0"),
    ("artistic", "artistic", "artistic licen[sc]e", "artistic", "dev perl org licenses artistic"),
    ("bsl-1.0", "boost", rf"boost software licen[sc]e(?:{_V}1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib", "zlib net zlib license"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl net"),
    ("psf-2.0", "python", rf"python software foundation licen[sc]e(?:{_V}2)?", "psf 2 0", "docs python org 3 license"),
    ("eupl-1.2", "eupl european", rf"(?:european union public licen[sc]e|eupl)(?:{_V}1 2)?", "eupl 1 2", "joinup ec europa eu community eupl"),
    ("osl-3.0", "open", rf"open software licen[sc]e(?:{_V}3 0)?", "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl-3.0", "academic", rf"academic free licen[sc]e(?:{_V}3 0)?", "afl 3 0", "opensource org licenses afl 3 0"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e", "ms rl", "opensource org licenses ms rl"),
    ("ofl-1.1", "ofl font", rf"(?:sil )?open font licen[sc]e(?:{_V}1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("odbl-1.0", "odbl database", rf"(?:open database licen[sc]e|odbl)(?:{_V}1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "commons", rf"open data commons attribution licen[sc]e(?:{_V}1 0)?", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "pddl dedication", "(?:public domain dedication and licen[sc]e|pddl)", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "domain", "public domain", "public domain", "creativecommons org publicdomain mark 1 0"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e", "ncsa", "opensource org licenses ncsa"),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl", "openssl org source license"),
    ("php-3.01", "php", rf"php licen[sc]e(?:{_V}3 01)?", "php 3 01", "php net license 3 01"),
    ("ruby", "ruby", "ruby licen[sc]e", "ruby", "ruby lang org en about license"),
    ("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql", "postgresql org about licence"),
    ("vim", "vim", "vim licen[sc]e", "vim", "vimhelp org uganda txt"),
    ("proprietary", "rights", "all rights reserved", "licenseref proprietary", "example com eula"),
]
_FAMILIES += [
    (
        f"cc-{kind}-{version}",
        "cc creative",
        rf"{_CC} {words}(?: licen[sc]e)?(?: {number}|{_V}{number})(?: international| unported| generic)?",
        f"cc {kind.replace('-', ' ')} {number}",
        f"creativecommons org licenses {kind.replace('-', ' ')} {number}",
    )
    for kind, words in _CC_WORDS.items()
    for version, number in (("2.0", "2 0"), ("3.0", "3 0"), ("4.0", "4 0"))
]
_FAMILIES += [
    (f"cc-{kind}", "cc creative", f"{_CC} {words}", f"cc {kind.replace('-', ' ')}", f"creativecommons org licenses {kind.replace('-', ' ')}")
    for kind, words in _CC_WORDS.items()
]

_GRANT = (
    "(?:(?:re)?licen[sc]ed|released|distributed|available|published|provided|offered|covered|redistribute it)"
    "(?: and or modif(?:y|ied) it)? (?:under|by|according to) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
)


@dataclass(frozen=True)
class Rule:
    rule: int
    keyword: str
    pattern: str
    label: str
    priority: int
    base: bool


def rules() -> list[Rule]:
    """All rules in order; in a tie of priority and interval the earlier one stands."""
    found: list[tuple[str, str, str, int, bool]] = [(p.split()[0], p, label, NAME, True) for p, label in BASE]
    for label, keywords, name, tag, address in _FAMILIES:
        found += [("spdx", f"spdx license identifier {tag}", label, TAG, False)]
        found += [(word, _GRANT + name, label, NOTICE, False) for word in keywords.split()]
        found += [(address.split()[0], address, label, ADDRESS, False)]
        found += [(word, name, label, NAME, False) for word in keywords.split()]
    return [Rule(i, k, f"(?<= ){p}(?= )", label, n, base) for i, (k, p, label, n, base) in enumerate(found)]
