"""License scan with ordered signature rules.

A rule is a regular expression with a label, a priority and a keyword. A text is searched by a rule only if it holds
the rule's keyword (plain substring search in lower case with single blanks), which is a part of all that the rule
matches. Overlapping
detections are resolved: a detection inside one of a higher priority, or inside a longer one of the same priority, is
suppressed.

The rules are written by hand, as families of licenses with the ways they are named. Each way makes rules of its own
kind: a tag, a link, a notice, a name.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import map_text, pack, plain_words, texts_of
from arrears.llm.registry import query, table

#: Kinds of rules: priority, and how sure a detection is.
KINDS = {"tag": (6, 0.98), "link": (5, 0.9), "notice": (4, 0.9), "name": (3, 0.7), "phrase": (2, 0.5), "hint": (1, 0.2)}

#: label; keyword; name (a blank stands for any white space); link; versions as "version: label ending".
#: A version may follow the name as "2.0", "-2.0", "v2", "version 2" or ", version 2".
FAMILIES = r"""
gpl        | general public | (?:GNU )?General Public Licen[cs]e  | gnu\.org/licenses/(?:old-licenses/)?gpl | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0; 3(?:\.0)?: -3.0
gpl        | gpl            | \b(?:GNU )?GPL                      | opensource\.org/licenses/gpl            | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0; 3(?:\.0)?: -3.0
lgpl       | general public | (?:GNU )?(?:Lesser|Library) General Public Licen[cs]e | gnu\.org/licenses/(?:old-licenses/)?lgpl | 2(?:\.0)?: -2.0; 2\.1: -2.1; 3(?:\.0)?: -3.0
lgpl       | lgpl           | \b(?:GNU )?LGPL                     | opensource\.org/licenses/lgpl           | 2(?:\.0)?: -2.0; 2\.1: -2.1; 3(?:\.0)?: -3.0
agpl       | general public | (?:GNU )?Affero General Public Licen[cs]e | gnu\.org/licenses/agpl            | 1(?:\.0)?: -1.0; 3(?:\.0)?: -3.0
agpl       | agpl           | \b(?:GNU )?AGPL                     | opensource\.org/licenses/agpl           | 1(?:\.0)?: -1.0; 3(?:\.0)?: -3.0
gfdl       | documentation  | (?:GNU )?Free Documentation Licen[cs]e | gnu\.org/licenses/fdl                | 1\.1: -1.1; 1\.2: -1.2; 1\.3: -1.3
apache     | apache         | \bApache(?: Software)? Licen[cs]e   | apache\.org/licenses                    | 1\.0: -1.0; 1\.1: -1.1; 2(?:\.0)?: -2.0
mit        | mit            | \bMIT Licen[cs]e                    | opensource\.org/licenses/mit            |
mit-0      | mit            | \bMIT No Attribution                | opensource\.org/licenses/mit-0          |
x11        | x11            | \bX11 Licen[cs]e                    |                                         |
isc        | isc            | \bISC Licen[cs]e                    | opensource\.org/licenses/isc            |
bsd-2      | bsd            | \b(?:BSD[ -]2[ -]Clause|2[ -]Clause BSD|Simplified BSD)\b | opensource\.org/licenses/bsd-2-clause |
bsd-3      | bsd            | \b(?:BSD[ -]3[ -]Clause|3[ -]Clause BSD|New BSD|Modified BSD)\b | opensource\.org/licenses/bsd-3-clause |
bsd-4      | bsd            | \b(?:BSD[ -]4[ -]Clause|4[ -]Clause BSD|Original BSD)\b |                    |
bsd-0      | bsd            | \b(?:0BSD|Zero[ -]Clause BSD)\b     | opensource\.org/licenses/0bsd           |
bsd        | bsd            | \bBSD Licen[cs]e                    | opensource\.org/licenses/bsd            |
mpl        | mozilla        | \bMozilla Public Licen[cs]e         | mozilla\.org/(?:en-us/)?mpl             | 1\.0: -1.0; 1\.1: -1.1; 2(?:\.0)?: -2.0
mpl        | mpl            | \bMPL\b                             |                                         | 1\.0: -1.0; 1\.1: -1.1; 2(?:\.0)?: -2.0
epl        | eclipse        | \bEclipse Public Licen[cs]e         | eclipse\.org/legal/epl                  | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0
edl        | eclipse        | \bEclipse Distribution Licen[cs]e   | eclipse\.org/org/documents/edl          |
cddl       | common dev     | \bCommon Development and Distribution Licen[cs]e | opensource\.org/licenses/cddl | 1\.0: -1.0; 1\.1: -1.1
cpl        | common public  | \bCommon Public Licen[cs]e          | opensource\.org/licenses/cpl            | 1\.0: -1.0
ipl        | ibm            | \bIBM Public Licen[cs]e             | opensource\.org/licenses/ibmpl          | 1\.0: -1.0
eupl       | european union | \bEuropean Union Public Licen[cs]e  | joinup\.ec\.europa\.eu/[\w/-]*eupl      | 1\.0: -1.0; 1\.1: -1.1; 1\.2: -1.2
eupl       | eupl           | \bEUPL\b                            |                                         | 1\.0: -1.0; 1\.1: -1.1; 1\.2: -1.2
cecill     | cecill         | \bCeCILL(?:[ -](?:A|B|C))?\b        | cecill\.info/licences                   | 1\.0: -1.0; 2\.0: -2.0; 2\.1: -2.1
artistic   | artistic       | \bArtistic Licen[cs]e               | opensource\.org/licenses/artistic       | 1\.0: -1.0; 2\.0: -2.0
psf        | python         | \bPython(?: Software Foundation)? Licen[cs]e | docs\.python\.org/[\w/.]*license | 2(?:\.0)?: -2.0
ruby       | ruby           | \bRuby Licen[cs]e                   |                                         |
php        | php            | \bPHP Licen[cs]e                    | php\.net/license                        | 3\.0: -3.0; 3\.01: -3.01
zlib       | zlib           | \bzlib(?:/libpng)? Licen[cs]e       | opensource\.org/licenses/zlib           |
libpng     | libpng         | \blibpng Licen[cs]e                 | libpng\.org/pub/png/src/libpng-license  | 2(?:\.0)?: -2.0
boost      | boost          | \bBoost Software Licen[cs]e         | boost\.org/license                      | 1\.0: -1.0
unlicense  | unlicen        | \bUnlicen[cs]e\b                    | unlicense\.org                          |
wtfpl      | what the       | \bDo What The F\w*ck You Want To Public Licen[cs]e | wtfpl\.net               | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0
wtfpl      | wtfpl          | \bWTFPL\b                           |                                         | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0
ofl        | open font      | \b(?:SIL )?Open Font Licen[cs]e     | scripts\.sil\.org/ofl                   | 1\.0: -1.0; 1\.1: -1.1
osl        | open software  | \bOpen Software Licen[cs]e          | opensource\.org/licenses/osl            | 1\.0: -1.0; 2\.0: -2.0; 2\.1: -2.1; 3\.0: -3.0
afl        | academic free  | \bAcademic Free Licen[cs]e          | opensource\.org/licenses/afl            | 1\.1: -1.1; 1\.2: -1.2; 2\.0: -2.0; 2\.1: -2.1; 3\.0: -3.0
apsl       | apple public   | \bApple Public Source Licen[cs]e    | opensource\.apple\.com/license/apsl     | 1\.0: -1.0; 1\.1: -1.1; 1\.2: -1.2; 2\.0: -2.0
ms-pl      | microsoft      | \bMicrosoft Public Licen[cs]e       | opensource\.org/licenses/ms-pl          |
ms-rl      | microsoft      | \bMicrosoft Reciprocal Licen[cs]e   | opensource\.org/licenses/ms-rl          |
upl        | universal per  | \bUniversal Permissive Licen[cs]e   | oss\.oracle\.com/licenses/upl           | 1\.0: -1.0
ncsa       | ncsa           | \b(?:University of Illinois/)?NCSA(?: Open Source)? Licen[cs]e | opensource\.org/licenses/ncsa |
openssl    | openssl        | \bOpenSSL Licen[cs]e                | openssl\.org/source/license             |
curl       | curl           | \bcurl Licen[cs]e                   | curl\.(?:se|haxx\.se)/docs/copyright    |
vim        | vim            | \bVim Licen[cs]e                    | vimhelp\.org/uganda                     |
postgresql | postgresql     | \bPostgreSQL Licen[cs]e             | postgresql\.org/about/licen[cs]e        |
ntp        | ntp            | \bNTP Licen[cs]e                    |                                         |
hpnd       | historical per | \bHistorical Permission Notice and Disclaimer | opensource\.org/licenses/hpnd |
w3c        | w3c            | \bW3C(?: Software(?: Notice)?)?(?: and)? Licen[cs]e | w3\.org/consortium/legal  |
unicode    | unicode        | \bUnicode(?: Terms of Use| Licen[cs]e(?: Agreement)?) | unicode\.org/(?:copyright|license) |
icu        | icu            | \bICU Licen[cs]e                    |                                         |
json       | json           | \bJSON Licen[cs]e                   | json\.org/license                       |
beerware   | beer           | \bBeer-?ware Licen[cs]e             |                                         |
blueoak    | blue oak       | \bBlue Oak Model Licen[cs]e         | blueoakcouncil\.org/license             | 1(?:\.0\.0)?: -1.0.0
mulan      | mulan          | \bMulan(?: Permissive Software)?(?: PSL| Licen[cs]e) | license\.coscl\.org\.cn | 1: -1.0; 2: -2.0
bsl        | business sou   | \bBusiness Source Licen[cs]e        | mariadb\.com/bsl                        | 1\.0: -1.0; 1\.1: -1.1
sspl       | server side    | \bServer Side Public Licen[cs]e     | mongodb\.com/licensing/server-side      | 1(?:\.0)?: -1.0
elastic    | elastic        | \bElastic Licen[cs]e                | elastic\.co/licensing/elastic-license   | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0
commons-clause | commons cl | \bCommons Clause\b                  | commonsclause\.com                      | 1\.0: -1.0
odbl       | open database  | \b(?:ODC )?Open Database Licen[cs]e | opendatacommons\.org/licenses/odbl      | 1\.0: -1.0
odc-by     | attribution    | \b(?:Open Data Commons|ODC) Attribution(?: Licen[cs]e)? | opendatacommons\.org/licenses/by | 1\.0: -1.0
pddl       | public domain  | \b(?:ODC )?Public Domain Dedication and Licen[cs]e | opendatacommons\.org/licenses/pddl | 1\.0: -1.0
cdla       | community data | \bCommunity Data Licen[cs]e Agreement | cdla\.(?:dev|io)                      | 1\.0: -1.0; 2\.0: -2.0
ogl-uk     | open government | \bOpen Government Licen[cs]e       | nationalarchives\.gov\.uk/doc/open-government-licence | 1(?:\.0)?: -1.0; 2(?:\.0)?: -2.0; 3(?:\.0)?: -3.0
etalab     | licence ouverte | \bLicence Ouverte(?:/Open Licence)? | etalab\.gouv\.fr/licence               | 1\.0: -1.0; 2\.0: -2.0
dl-de      | datenlizenz    | \bDatenlizenz Deutschland           | govdata\.de/dl-de                       | 1\.0: -1.0; 2\.0: -2.0
rail       | rail           | \b(?:Open)?RAIL(?:-M| Licen[cs]e)   | bigscience\.huggingface\.co/blog/the-bigscience-rail-license |
cc0        | cc0            | \bCC0\b                             | creativecommons\.org/publicdomain/zero  | 1\.0: -1.0
cc0        | creative commons | \bCreative Commons (?:CC0|Zero)\b |                                         | 1\.0: -1.0
cc-pd      | public domain  | \bPublic Domain Mark                | creativecommons\.org/publicdomain/mark  | 1\.0: -1.0
cc-by      | cc             | \bCC[ -]BY\b(?![ -](?:NC|ND|SA))    | creativecommons\.org/licenses/by/       | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-sa   | cc             | \bCC[ -]BY[ -]SA\b                  | creativecommons\.org/licenses/by-sa/    | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nd   | cc             | \bCC[ -]BY[ -]ND\b                  | creativecommons\.org/licenses/by-nd/    | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nc   | cc             | \bCC[ -]BY[ -]NC\b(?![ -](?:ND|SA)) | creativecommons\.org/licenses/by-nc/    | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nc-sa | cc            | \bCC[ -]BY[ -]NC[ -]SA\b            | creativecommons\.org/licenses/by-nc-sa/ | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nc-nd | cc            | \bCC[ -]BY[ -]NC[ -]ND\b            | creativecommons\.org/licenses/by-nc-nd/ | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by      | creative commons | \bCreative Commons Attribution\b(?! ?-? ?(?:Non|No |Share)) | |  1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-sa   | creative commons | \bCreative Commons Attribution ?-? ?Share ?-?Alike\b | | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nd   | creative commons | \bCreative Commons Attribution ?-? ?No ?-?Deriv\w*\b | | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nc   | creative commons | \bCreative Commons Attribution ?-? ?Non ?-?Commercial\b(?! ?-? ?(?:No|Share)) | | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nc-sa | creative commons | \bCreative Commons Attribution ?-? ?Non ?-?Commercial ?-? ?Share ?-?Alike\b | | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
cc-by-nc-nd | creative commons | \bCreative Commons Attribution ?-? ?Non ?-?Commercial ?-? ?No ?-?Deriv\w*\b | | 1\.0: -1.0; 2\.0: -2.0; 2\.5: -2.5; 3\.0: -3.0; 4\.0: -4.0
"""

#: kind; label; keyword; expression.
PHRASES = r"""
phrase | reserved      | all rights       | \ball rights(?: are)? reserved\b
phrase | reserved      | rechte           | \balle rechte vorbehalten\b
phrase | reserved      | droits           | \btous droits r[ée]serv[ée]s\b
phrase | reserved      | derechos         | \btodos los derechos reservados\b
phrase | reserved      | redistribut      | \b(?:no|without) (?:part|permission)[^.\n]{0,80}redistribut\w+
phrase | public-domain | public domain    | \b(?:is|are|released (?:in)?to|placed in|dedicated to) the public domain\b
phrase | public-domain | copyright        | \bno (?:known )?copyright(?: restrictions)?\b
phrase | mit           | permission is    | \bpermission is hereby granted, free of charge, to any person obtaining a copy\b
phrase | isc           | permission to    | \bpermission to use, copy, modify, and(?:/or)? distribute this software\b
phrase | bsd           | redistribution   | \bredistribution and use in source and binary forms\b
phrase | zlib          | as-is            | \bprovided 'as-is', without any express or implied warranty\b
phrase | boost         | permission is    | \bpermission is hereby granted, free of charge, to any person or organization\b
phrase | apache-2.0    | unless required  | \bunless required by applicable law or agreed to in writing, software\b
phrase | mpl-2.0       | source code form | \bthis source code form is subject to the terms of the mozilla public licen[cs]e\b
phrase | gpl           | redistribute it  | \byou can redistribute it and/or modify it under the terms of the gnu general public\b
phrase | lgpl          | redistribute it  | \byou can redistribute it and/or modify it under the terms of the gnu lesser general\b
phrase | agpl          | redistribute it  | \byou can redistribute it and/or modify it under the terms of the gnu affero general\b
phrase | unlicense     | unencumbered     | \bthis is free and unencumbered software released into the public domain\b
phrase | proprietary   | proprietary      | \bproprietary(?: and confidential| licen[cs]e| software)\b
phrase | proprietary   | unauthori        | \bunauthori[sz]ed (?:copying|use|reproduction|distribution)\b
phrase | proprietary   | user licen       | \bend[ -]user licen[cs]e agreement\b
phrase | noncommercial | use only         | \bfor (?:non-?commercial|personal|educational|research)(?: and [\w-]+)? use only\b
phrase | noncommercial | commercial       | \bnot (?:be used )?for commercial (?:use|purposes)\b
phrase | permission    | permission       | \b(?:used|reprinted|reproduced) (?:with|by) (?:kind )?permission\b
hint   | copyright     | copyright        | \bcopyright (?:\(c\)|©)? ?(?:19|20)\d\d\b
hint   | copyright     | copyright        | \bcopyright (?:\(c\)|©)
hint   | copyright     | ©                | ©
hint   | licensed      | under            | \b(?:licen[cs]ed|released|distributed|available) under\b
"""

VERSION = r"(?:[,-]? ?(?:version|v\.?)? ?)?(?:{0})(?!\d|\.\d)"
NOTICE = r"\b(?:licen[cs]ed|released|distributed|available|published|provided|covered)(?: to you)?(?: under| by)(?: the)?(?: terms of)?(?: the)? "


def spaced(pattern: str) -> str:
    """A blank stands for any white space, a character class with one for any run of its characters."""

    def wide(m):
        found = m.group()
        if found.startswith("["):
            inside = found[1:].rstrip("?").rstrip("]").replace(" ", r"\s")
            return f"[{inside}]{'*' if found.endswith('?') else '+'}" if " " in found else found
        return r"\s?" if found == " ?" else r"\s+"

    return regex.sub(r"\[[^\]]*\]\??| \??", wide, pattern)


class Rule:
    def __init__(self, number: int, kind: str, label: str, keyword: str, pattern: str):
        self.number, self.kind, self.label, self.keyword = number, kind, label, keyword.lower()
        self.priority, self.sure = KINDS[kind]
        self.find = regex.compile(spaced(pattern), regex.IGNORECASE).finditer


@lru_cache(1)
def rules() -> list[Rule]:
    out: list[Rule] = []
    add = lambda *x: out.append(Rule(len(out), *x))
    for line in FAMILIES.strip().splitlines():
        label, keyword, name, link, versions = (x.strip() for x in split_line(line, 5))
        pairs = [(*map(str.strip, v.rsplit(":", 1)),) for v in versions.split(";") if v.strip()]
        for version, ending in pairs:
            full = f"{name}{VERSION.format(version)}"
            add("notice", label + ending, keyword, NOTICE + full)
            add("name", label + ending, keyword, full)
            add("tag", label + ending, "spdx", rf"\bSPDX-License-Identifier: ?{regex.escape(label + ending)}\b")
            if link:
                add("link", label + ending, link_word(link), rf"{link}[\w./-]*?{version}(?!\d)")
        add("notice", label, keyword, NOTICE + name)
        add("name", label, keyword, name)
        add("tag", label, "spdx", rf"\bSPDX-License-Identifier: ?{regex.escape(label)}\b")
        if link:
            add("link", label, link_word(link), link)
    for line in PHRASES.strip().splitlines():
        add(*(x.strip() for x in split_line(line, 4)))
    return out


def split_line(line: str, n: int) -> list[str]:
    """Columns are divided by a bar with blanks around it."""
    parts = regex.split(r"\s\|(?=\s|$)", line.rstrip())
    return parts[:n] + [""] * (n - len(parts))


def link_word(link: str) -> str:
    """The host at the start of a link, as plain text."""
    return regex.match(r"(?:[\w-]|\\\.)+", link).group().replace("\\.", ".")


@lru_cache(1)
def by_keyword() -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = {}
    for rule in rules():
        out.setdefault(rule.keyword, []).append(rule)
    return out


def detect(text: str) -> list[tuple[int, int, Rule]]:
    """Detections that are not suppressed, in text order."""
    low = text.replace("\u0130", "i").lower().replace("\u017f", "s")  # these match i and s in any case
    low = " ".join(low.split())
    return resolve(text, [rule for keyword, own in by_keyword().items() if keyword in low for rule in own])


def resolve(text: str, searched: list[Rule]) -> list[tuple[int, int, Rule]]:
    """Detections of the given rules that are not suppressed."""
    found: dict[int, list[tuple[int, int, Rule]]] = {}
    for rule in searched:
        hits = [(*m.span(), rule) for m in rule.find(text)]
        if hits:
            found.setdefault(rule.priority, []).extend(hits)
    kept: list[tuple[int, int, Rule]] = []
    for priority in sorted(found, reverse=True):
        starts = np.array([a for a, _, _ in kept])
        furthest = np.maximum.accumulate([b for _, b, _ in kept]) if kept else starts
        reach, level = -1, []
        for hit in sorted(found[priority], key=lambda h: (h[0], -h[1], h[2].number)):
            above = int(np.searchsorted(starts, hit[0], side="right"))
            inside = above and furthest[above - 1] >= hit[1]
            if not inside and hit[1] > reach:
                level.append(hit)
                reach = hit[1]
        kept = sorted([*kept, *level], key=lambda h: h[:2])
    return kept


#: Phrases that are looked up as whole words, and their labels.
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))


def places(words: list[bytes]) -> list[tuple[int, str]]:
    """Word numbers at which a base phrase starts, with its label."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in BASE:
        at = joined.find(b" " + phrase + b" ")
        number, counted = 0, 0  # blanks before the last place
        while at >= 0:
            number, counted = number + joined.count(b" ", counted, at), at
            out.append((number, label))
            at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Licenses named in each text.

    One row for each input row, repeated rows included: ``row`` (struct of ``keep``), n_words, n_base (places of the
    base phrases), first_word and last_word (smallest and largest start; null without places), base_labels, labels
    (those of detections too), score (one minus the product of the doubts of all detections' labels), and
    ``detections`` (label, rule kind, characters from and up to). Null and empty texts name nothing.
    """
    rows = docs.select(pack(keep), F.col(text).cast("string").alias("text"))

    def work(batches):
        for batch in batches:
            out = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            spans = []
            for t in texts_of(batch.column(1)):
                words = plain_words(t)
                base = places(words)
                hits = detect(t.decode())
                own = {label for _, label in base}
                sure: dict[str, float] = {}
                for _, _, rule in hits:
                    sure[rule.label] = max(rule.sure, sure.get(rule.label, 0.0))
                out["n_words"].append(len(words))
                out["n_base"].append(len(base))
                out["first_word"].append(min((w for w, _ in base), default=None))
                out["last_word"].append(max((w for w, _ in base), default=None))
                out["base_labels"].append(",".join(sorted(own)))
                out["labels"].append(",".join(sorted(own | set(sure))))
                out["score"].append(float(1 - np.prod([1 - s for s in sure.values()])))
                spans.append([{"label": r.label, "kind": r.kind, "begin": a, "end": b} for a, b, r in hits])
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            span = pa.struct([("label", pa.string()), ("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(out.values(), kinds)), pa.array(spans, pa.list_(span))],
                names=["row", *out, "detections"],
            )

    schema = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, detections array<struct<label:string,kind:string,begin:int,end:int>>"
    )
    return map_text(rows, schema, work, "text")


@query("op9_license_scan")
def op9_license_scan(spark, folder):
    found = scan(table(spark, folder, "documents"), ["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
