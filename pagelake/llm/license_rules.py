r"""Signature rules of the licence scan: hand-written patterns in priority order.

``NAMES`` gives each licence's label, a pattern of its name, its SPDX
identifiers and a pattern of its web address; every entry stands for four rules
(SPDX tag, statement, address, bare name).  ``NOTICES`` are sentences of the
licence texts themselves, ``GENERAL`` rules name no licence.  Patterns see text
lower-cased (A-Z); a blank stands for white space of any length.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    name: str
    label: str
    priority: int
    weight: float
    keywords: tuple[str, ...]  # one of them stands in every text that the pattern matches, white space folded to a blank
    pattern: str


# label | name pattern | SPDX identifiers | address pattern | keywords of the name
NAMES = r"""
mit | mit(?:/x11| \(expat\))? licen[cs]e | mit | opensource\.org/licenses?/mit\b | mit
expat | expat licen[cs]e | expat | directory\.fsf\.org/wiki/license:expat | expat
x11 | x11 licen[cs]e | x11 | directory\.fsf\.org/wiki/license:x11 | x11
mit-0 | mit no attribution(?: licen[cs]e)? | mit-0 | github\.com/aws/mit-0 | attribution
apache-2.0 | apache licen[cs]e,? ?(?:\(?v(?:ersion)?\.? ?)?2(?:\.0)?\b | apache-2.0 | apache\.org/licenses/license-2\.0 | apache
apache-1.1 | apache (?:software )?licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?1\.1 | apache-1.1 | apache\.org/licenses/license-1\.1 | apache
apache-1.0 | apache (?:software )?licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?1\.0 | apache-1.0 | apache\.org/licenses/license-1\.0 | apache
apache | apache (?:software )?licen[cs]e | apache | apache\.org/licenses/?(?!\w) | apache
gpl-1.0 | (?:gnu )?general public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?1\b | gpl-1.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0 | general public
gpl-2.0 | (?:gnu )?general public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?2\b | gpl-2.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0 | general public
gpl-3.0 | (?:gnu )?general public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?3\b | gpl-3.0(?:-only|-or-later|\+)? | gnu\.org/licenses/gpl-3\.0 | general public
gpl | (?:gnu )?general public licen[cs]e | gpl | gnu\.org/(?:copyleft|licenses)/gpl\b | general public
lgpl-2.0 | (?:gnu )?library general public licen[cs]e(?:,? ?(?:v(?:ersion)?\.? ?)?2)? | lgpl-2.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0 | library general
lgpl-2.1 | (?:gnu )?lesser general public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?2\.1 | lgpl-2.1(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1 | lesser general
lgpl-3.0 | (?:gnu )?lesser general public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?3 | lgpl-3.0(?:-only|-or-later|\+)? | gnu\.org/licenses/lgpl-3\.0 | lesser general
lgpl | (?:gnu )?lesser general public licen[cs]e | lgpl | gnu\.org/(?:copyleft/lesser|licenses/lgpl)\b | lesser general
agpl-3.0 | (?:gnu )?affero general public licen[cs]e(?:,? ?(?:v(?:ersion)?\.? ?)?3)? | agpl-3.0(?:-only|-or-later|\+)? | gnu\.org/licenses/agpl | affero
gfdl | (?:gnu )?free documentation licen[cs]e | gfdl-1\.[1-3](?:-only|-or-later)? | gnu\.org/(?:copyleft|licenses)/fdl | free documentation
bsd-2-clause | (?:simplified|freebsd|2-clause|two-clause) bsd licen[cs]e|bsd[ -](?:2-clause|two-clause)(?: licen[cs]e)? | bsd-2-clause | opensource\.org/licenses?/bsd-2-clause | bsd
bsd-3-clause | (?:new|revised|modified|3-clause|three-clause) bsd licen[cs]e|bsd[ -](?:3-clause|three-clause)(?: licen[cs]e)? | bsd-3-clause | opensource\.org/licenses?/bsd-3-clause | bsd
bsd-4-clause | (?:original|4-clause|four-clause) bsd licen[cs]e|bsd[ -](?:4-clause|four-clause)(?: licen[cs]e)? | bsd-4-clause | spdx\.org/licenses/bsd-4-clause | bsd
0bsd | (?:zero-clause bsd|bsd zero[ -]clause)(?: licen[cs]e)? | 0bsd | opensource\.org/licenses?/0bsd | bsd
bsd | bsd(?:-style)? licen[cs]e | bsd | opensource\.org/licenses?/bsd-license | bsd
isc | isc licen[cs]e | isc | opensource\.org/licenses?/isc\b | isc
zlib | zlib(?:/libpng)? licen[cs]e | zlib | opensource\.org/licenses?/zlib | zlib
libpng | (?:lib)?png (?:reference library )?licen[cs]e | libpng(?:-2\.0)? | libpng\.org/pub/png/src/libpng-license | png
mpl-1.1 | mozilla public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?1\.1 | mpl-1.1 | mozilla\.org/mpl/(?:mpl-)?1\.1 | mozilla
mpl-2.0 | mozilla public licen[cs]e,? ?(?:v(?:ersion)?\.? ?)?2\.0 | mpl-2.0 | mozilla\.org/(?:en-us/)?mpl/2\.0 | mozilla
mpl | mozilla public licen[cs]e | mpl | mozilla\.org/mpl/?(?![\w/]) | mozilla
epl-1.0 | eclipse public licen[cs]e,?(?: -)? ?(?:v(?:ersion)?\.? ?)?1\.0 | epl-1.0 | eclipse\.org/legal/epl-v10 | eclipse
epl-2.0 | eclipse public licen[cs]e,?(?: -)? ?(?:v(?:ersion)?\.? ?)?2\.0 | epl-2.0 | eclipse\.org/legal/epl-(?:2\.0|v20) | eclipse
epl | eclipse public licen[cs]e | epl | eclipse\.org/legal/?(?!\w) | eclipse
edl-1.0 | eclipse distribution licen[cs]e | edl-1.0 | eclipse\.org/org/documents/edl | eclipse
cddl-1.0 | common development and distribution licen[cs]e(?:,? ?(?:v(?:ersion)?\.? ?)?1\.0)? | cddl-1\.[01] | opensource\.org/licenses?/cddl | common development
cpl-1.0 | common public licen[cs]e(?:,? ?(?:v(?:ersion)?\.? ?)?1\.0)? | cpl-1.0 | opensource\.org/licenses?/cpl | common public
ipl-1.0 | ibm public licen[cs]e | ipl-1.0 | opensource\.org/licenses?/ibmpl | ibm public
eupl | european union public licen[cs]e | eupl-1\.[0-2] | joinup\.ec\.europa\.eu/[\w/.-]*eupl | european union
cecill | cecill(?:-[abc])? (?:free software )?licen[cs]e(?: agreement)? | cecill-(?:1\.[01]|2\.[01]|b|c) | cecill\.info/licences | cecill
artistic-1.0 | artistic licen[cs]e,? v?(?:ersion )?1\.0 | artistic-1.0(?:-perl|-cl8)? | opensource\.org/licenses?/artistic-1\.0 | artistic
artistic-2.0 | artistic licen[cs]e,? v?(?:ersion )?2(?:\.0)? | artistic-2.0 | opensource\.org/licenses?/artistic-2\.0 | artistic
artistic | artistic licen[cs]e | artistic | perlfoundation\.org/artistic | artistic
bsl-1.0 | boost software licen[cs]e | bsl-1.0 | boost\.org/license_1_0 | boost
python-2.0 | python software foundation licen[cs]e|psf licen[cs]e | (?:python-2\.0|psf-2\.0) | docs\.python\.org/[\w/.]*license | python+psf
postgresql | postgresql licen[cs]e | postgresql | opensource\.org/licenses?/postgresql | postgresql
php-3.01 | php licen[cs]e | php-3\.0?1? | php\.net/license | php
ruby | ruby licen[cs]e | ruby | ruby-lang\.org/[\w/.]*license | ruby
ofl-1.1 | (?:sil )?open font licen[cs]e | ofl-1\.[01](?:-rfn|-no-rfn)? | scripts\.sil\.org/ofl|openfontlicense\.org | open font
unlicense | unlicense\b | unlicense | unlicense\.org | unlicense
wtfpl | wtfpl\b|do what the fuck you want to public licen[cs]e | wtfpl | wtfpl\.net | wtfpl+do what the
cc0-1.0 | cc0(?: 1\.0)?(?: universal)?(?: public domain dedication)?\b | cc0-1.0 | creativecommons\.org/publicdomain/zero | cc0
cc-by-nc-nd | cc by-nc-nd(?: \d\.\d)?|(?:creative commons )?attribution-noncommercial-noderiv(?:ative)?s | cc-by-nc-nd-\d\.\d | creativecommons\.org/licenses/by-nc-nd | by-nc-nd+noderiv
cc-by-nc-sa | cc by-nc-sa(?: \d\.\d)?|(?:creative commons )?attribution-noncommercial-sharealike | cc-by-nc-sa-\d\.\d | creativecommons\.org/licenses/by-nc-sa | by-nc-sa+sharealike
cc-by-nc | cc by-nc(?: \d\.\d)?(?!-)|(?:creative commons )?attribution-noncommercial(?!-) | cc-by-nc-\d\.\d | creativecommons\.org/licenses/by-nc/ | by-nc+noncommercial
cc-by-nd | cc by-nd(?: \d\.\d)?|(?:creative commons )?attribution-noderiv(?:ative)?s | cc-by-nd-\d\.\d | creativecommons\.org/licenses/by-nd | by-nd+noderiv
cc-by-sa | cc by-sa(?: \d\.\d)?|(?:creative commons )?attribution-sharealike | cc-by-sa-\d\.\d | creativecommons\.org/licenses/by-sa | by-sa+sharealike
cc-by | cc by(?: \d\.\d)?(?!-)\b|creative commons attribution(?!-) | cc-by-\d\.\d | creativecommons\.org/licenses/by/ | cc by+creative commons
creative-commons | creative commons licen[cs]e | cc-pddc | creativecommons\.org/?(?![\w/]) | creative commons
odbl-1.0 | open database licen[cs]e|\bodbl\b | odbl-1.0 | opendatacommons\.org/licenses/odbl | open database+odbl
odc-by-1.0 | open data commons attribution licen[cs]e|\bodc-by\b | odc-by-1.0 | opendatacommons\.org/licenses/by | open data commons+odc-by
pddl-1.0 | public domain dedication and licen[cs]e | pddl-1.0 | opendatacommons\.org/licenses/pddl | dedication
cdla-permissive | community data licen[cs]e agreement(?: -)? permissive | cdla-permissive-\d\.\d | cdla\.dev/permissive | community data
cdla-sharing | community data licen[cs]e agreement(?: -)? sharing | cdla-sharing-1\.0 | cdla\.dev/sharing | community data
openssl | openssl licen[cs]e | openssl | openssl\.org/source/license | openssl
ssleay | original ssleay licen[cs]e | ssleay | openssl\.org/source/ssleay | ssleay
curl | curl licen[cs]e | curl | curl\.(?:se|haxx\.se)/docs/copyright | curl
vim | vim licen[cs]e | vim | vimhelp\.org/[\w.]*license | vim
tcl | tcl/tk licen[cs]e|tcl licen[cs]e | tcl | tcl\.tk/software/tcltk/license | tcl
w3c | w3c (?:software (?:notice and )?)?licen[cs]e | w3c(?:-\d+)? | w3\.org/consortium/legal | w3c
unicode | unicode(?:, inc\.)? licen[cs]e(?: agreement)? | unicode-(?:dfs-\d+|3\.0|tou) | unicode\.org/(?:copyright|license) | unicode
icu | icu licen[cs]e | icu | source\.icu-project\.org/[\w/.]*license | icu
ijg | independent jpeg group(?:'s)? licen[cs]e | ijg | ijg\.org | jpeg group
hpnd | historical permission notice and disclaimer | hpnd(?:-[\w-]+)? | opensource\.org/licenses?/hpnd | historical permission
ncsa | (?:university of illinois/)?ncsa (?:open source )?licen[cs]e | ncsa | opensource\.org/licenses?/ncsa | ncsa
afl-3.0 | academic free licen[cs]e | afl-\d\.\d | opensource\.org/licenses?/afl | academic free
osl-3.0 | open software licen[cs]e | osl-\d\.\d | opensource\.org/licenses?/osl | open software
ecl-2.0 | educational community licen[cs]e | ecl-\d\.\d | opensource\.org/licenses?/ecl | educational community
ms-pl | microsoft public licen[cs]e|\bms-pl\b | ms-pl | opensource\.org/licenses?/ms-pl | microsoft public+ms-pl
ms-rl | microsoft reciprocal licen[cs]e|\bms-rl\b | ms-rl | opensource\.org/licenses?/ms-rl | microsoft reciprocal+ms-rl
apsl-2.0 | apple public source licen[cs]e | apsl-\d\.\d | opensource\.apple\.com/apsl | apple public
qpl-1.0 | q public licen[cs]e|\bqpl\b | qpl-1.0 | opensource\.org/licenses?/qpl | q public+qpl
sleepycat | sleepycat licen[cs]e | sleepycat | opensource\.org/licenses?/sleepycat | sleepycat
zpl-2.1 | zope public licen[cs]e | zpl-\d\.\d | opensource\.org/licenses?/zpl | zope public
lppl | latex project public licen[cs]e | lppl-1\.\d\w? | latex-project\.org/lppl | latex project
upl-1.0 | universal permissive licen[cs]e | upl-1.0 | oss\.oracle\.com/licenses/upl | universal permissive
mulanpsl-2.0 | mulan (?:psl|permissive software licen[cs]e) | mulanpsl-[12]\.0 | license\.coscl\.org\.cn/mulan | mulan
sspl-1.0 | server side public licen[cs]e | sspl-1.0 | mongodb\.com/licensing/server-side | server side
busl-1.1 | business source licen[cs]e | busl-1.1 | mariadb\.com/bsl11 | business source
elastic-2.0 | elastic licen[cs]e(?: 2\.0)? | elastic-2.0 | elastic\.co/licensing/elastic-license | elastic
polyform | polyform (?:noncommercial|shield|strict|small business) licen[cs]e | polyform-[\w-]+-1\.0\.0 | polyformproject\.org/licenses | polyform
commons-clause | commons clause(?: licen[cs]e condition)? | commons-clause | commonsclause\.com | commons clause
openrail | (?:creativeml|bigscience|bigcode)? ?open ?rail(?:\+\+)?(?:-[ms])?(?: licen[cs]e)? | openrail(?:\+\+)? | huggingface\.co/spaces/[\w/-]*license | rail
beerware | beer-?ware licen[cs]e | beerware | people\.freebsd\.org/~phk | beer
json | json licen[cs]e | json | json\.org/license | json
naumen | naumen public licen[cs]e | naumen | opensource\.org/licenses?/naumen | naumen
nasa-1.3 | nasa open source agreement | nasa-1\.3 | opensource\.org/licenses?/nasa | nasa
"""

# label | keywords | sentence pattern
NOTICES = r"""
mit | permission is hereby granted | permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | the above copyright notice | the above copyright notice and this permission notice shall be included in all copies
x11 | shall not be used in advertising | except as contained in this notice, the names? of .{1,80}? shall not be used in advertising
isc | permission to use, copy, modify | permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee
bsd-2-clause | redistribution and use | redistribution and use in source and binary forms, with or without modification, are permitted
bsd-3-clause | endorse or promote | neither the names? of .{1,120}? may be used to endorse or promote products
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display
apache-2.0 | apache | licensed under the apache license, version 2\.0 \(the .license.\)
apache-2.0 | you may not use this file | you may not use this file except in compliance with the license
gpl | free software foundation | it under the terms of the gnu general public license as published by the free software foundation
lgpl | free software foundation | it under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation
agpl-3.0 | free software foundation | it under the terms of the gnu affero general public license as published by the free software foundation
gpl | general public | you should have received a copy of the gnu general public license
lgpl | lesser general | you should have received a copy of the gnu lesser general public license
gfdl | free documentation | permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license, v\. 2\.0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1\.1
epl | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license
cddl-1.0 | common development | the contents of this file are subject to the terms of the common development and distribution license
zlib | altered source versions | altered source versions must be plainly marked as such
zlib | origin of this software | the origin of this software must not be misrepresented
bsl-1.0 | boost | distributed under the boost software license, version 1\.0
ofl-1.1 | open font | this font software is licensed under the sil open font license
unlicense | public domain | this is free and unencumbered software released into the public domain
wtfpl | do what the | everyone is permitted to copy and distribute verbatim or modified copies of this license document.{1,200}? do what the fuck
cc0-1.0 | waived all copyright | has waived all copyright and related or neighboring rights
cc-by | creative commons | this work is licensed under a creative commons attribution [\d.]+ (?:international|unported) licen[cs]e
cc-by-sa | sharealike | this work is licensed under a creative commons attribution-sharealike [\d.]+ (?:international|unported) licen[cs]e
postgresql | without fee, and without | permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without
hpnd | provided that the above | provided that the above copyright notice appears? in all copies and that both that copyright notice
json | for good, not evil | the software shall be used for good, not evil
beerware | buy me a beer | you can buy me a beer in return
artistic-2.0 | artistic | you may use, modify, and distribute this package under the terms of the artistic license
python-2.0 | psf | psf is making python available to licensee on an .as is. basis
"""

# label | priority | weight | keywords | pattern
GENERAL = r"""
public-domain | 40 | 0.6 | public domain | (?:released|placed|dedicated|donated) (?:in)?to the public domain
public-domain | 20 | 0.3 | public domain | public domain
proprietary | 40 | 0.6 | proprietary | (?:confidential and proprietary|proprietary and confidential)
proprietary | 40 | 0.6 | all rights reserved | all rights reserved
copyright | 10 | 0.2 | copyright | copyright (?:\(c\)|©)? ?(?:19|20)\d\d
copyright | 10 | 0.2 | copyright | copyright (?:\(c\)|©)
dual-license | 30 | 0.5 | dual | dual[ -]licen[cs]ed
see-license | 10 | 0.2 | licen | see (?:the )?(?:accompanying )?(?:file )?licen[cs]e(?:\.txt|\.md)?(?: file)? (?:for|in)
license | 10 | 0.2 | licen+released under+distributed under | (?:licen[cs]ed|released|distributed) under (?:the )?(?:terms|conditions) of
"""

STATEMENT = r"(?:(?:re)?licen[cs]ed|released|distributed|available|published|covered|provided)(?: \w+){0,3}? (?:under|by|with)(?: an?| the)?(?: terms of)?(?: the)? "


def _rows(table: str) -> list[list[str]]:
    return [[c.strip() for c in line.split(" | ")] for line in table.strip().splitlines()]


def _hosts(address: str) -> tuple[str, ...]:
    """The literal host that opens each alternative of an address pattern."""
    depth, parts = 0, [""]
    for c in address:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return tuple(re.match(r"[\w-]+(?:\\\.[\w-]+)*", p)[0].replace("\\.", ".") for p in parts)


def _flex(pattern: str) -> str:
    """A blank of the table is white space of any length."""
    return pattern.replace("[ -]", "(?: |-)").replace(" ?", r"\s*").replace(" ", r"\s+")


def rules() -> list[Rule]:
    out = []
    for label, name, spdx, address, keys in _rows(NAMES):
        words = tuple(keys.split("+"))
        named = rf"(?<!\w)(?:{_flex(name)})"
        out.append(Rule(f"{label}:spdx", label, 90, 0.99, ("spdx",), rf"spdx-license-identifier:\s*\(?(?:{spdx})(?![\w.+-])"))
        out.append(Rule(f"{label}:statement", label, 70, 0.9, words, _flex(STATEMENT) + rf"(?:{_flex(name)})"))
        out.append(Rule(f"{label}:address", label, 60, 0.8, _hosts(address), rf"(?:{address})"))
        out.append(Rule(f"{label}:name", label, 50, 0.5, words, named))
    for line in NOTICES.strip().splitlines():
        label, keys, text = (c.strip() for c in line.split(" | ", 2))
        out.append(Rule(f"{label}:notice:{len(out)}", label, 80, 0.95, tuple(keys.split("+")), _flex(text)))
    for line in GENERAL.strip().splitlines():
        label, priority, weight, keys, text = (c.strip() for c in line.split(" | ", 4))
        out.append(Rule(f"{label}:general:{len(out)}", label, int(priority), float(weight), tuple(keys.split("+")), _flex(text)))
    return out
