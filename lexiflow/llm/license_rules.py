"""The signatures of licences: patterns over lower-case words with single spaces between them.

A line of a table is `label | keyword | pattern`. The keyword stands in every text that the
pattern matches, so that texts without it need not be searched; it holds one of STEMS.
NAMES also give the rules of a grant ("licensed under the ..."), and IDENTIFIERS are those of
`SPDX-License-Identifier:` lines. Higher priorities win where a place lies within another.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Every keyword holds one of these, so texts with none of them are not normalised at all.
STEMS = ("licen", "gpl", "gnu", "bsd", "cc", "creative", "copy", "permission", "redistribut", "warrant", "domain", "mozilla", "unlicense")
#: Priorities and what a place of them is worth as a score.
NOTICE, IDENTIFIER, GRANT, NAME, MENTION = 5, 4, 3, 2, 1
WORTH = {NOTICE: 1.0, IDENTIFIER: 0.95, GRANT: 0.9, NAME: 0.7, MENTION: 0.4}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False


NAMES = """
mit | mit licen | mit licen[cs]e
mit | mit x11 licen | mit x11 licen[cs]e
mit | expat licen | expat licen[cs]e
mit-0 | mit no attribution licen | mit no attribution licen[cs]e
x11 | x11 licen | x11 licen[cs]e
isc | isc licen | (?:openbsd )?isc licen[cs]e
0bsd | zero clause bsd | (?:bsd )?zero clause bsd(?: licen[cs]e)?
bsd-2-clause | simplified bsd | simplified bsd(?: licen[cs]e)?
bsd-2-clause | freebsd licen | freebsd licen[cs]e
bsd-2-clause | bsd 2 clause | bsd 2 clause(?: licen[cs]e)?
bsd-2-clause | clause bsd | (?:2|two) clause bsd(?: licen[cs]e)?
bsd-3-clause | bsd 3 clause | bsd 3 clause(?: licen[cs]e)?
bsd-3-clause | clause bsd | (?:3|three) clause bsd(?: licen[cs]e)?
bsd-3-clause | new bsd | new bsd(?: licen[cs]e)?
bsd-3-clause | modified bsd | modified bsd(?: licen[cs]e)?
bsd-3-clause | revised bsd | revised bsd(?: licen[cs]e)?
bsd-4-clause | clause bsd | (?:4|four) clause bsd(?: licen[cs]e)?
bsd-4-clause | original bsd | original bsd(?: licen[cs]e)?
bsd | bsd licen | bsd licen[cs]e
apache-2 | apache licen | apache licen[cs]e(?: version)?(?: 2| v2)(?: 0)?
apache-2 | apache software licen | apache software licen[cs]e(?: version)?(?: 2| v2)(?: 0)?
apache-2 | apache public licen | apache public licen[cs]e(?: version)?(?: 2| v2)(?: 0)?
apache-1.1 | apache software licen | apache software licen[cs]e(?: version)?(?: 1| v1) 1
apache-1.1 | apache licen | apache licen[cs]e(?: version)?(?: 1| v1) 1
apache-1.0 | apache licen | apache licen[cs]e(?: version)?(?: 1| v1) 0
apache | apache licen | apache licen[cs]e
apache | apache software licen | apache software licen[cs]e
gpl-3 | gnu general public licen | gnu general public licen[cs]e(?: gpl)?(?: version| ver)?(?: 3| v3)(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)?
gpl-2 | gnu general public licen | gnu general public licen[cs]e(?: gpl)?(?: version| ver)?(?: 2| v2)(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)?
gpl-1 | gnu general public licen | gnu general public licen[cs]e(?: gpl)?(?: version| ver)?(?: 1| v1)(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)?
gpl | gnu general public licen | gnu general public licen[cs]e
gpl-3 | gnu gpl | gnu gpl(?: version)?(?: 3| v3)(?: 0)?(?: or later)?
gpl-2 | gnu gpl | gnu gpl(?: version)?(?: 2| v2)(?: 0)?(?: or later)?
gpl | gnu gpl | gnu gpl
gpl-3 | gplv3 | gplv3(?: or later)?
gpl-2 | gplv2 | gplv2(?: or later)?
gpl-3 | gpl | gpl(?: version)?(?: 3| v3)(?: 0)?(?: or later| only)?
gpl-2 | gpl | gpl(?: version)?(?: 2| v2)(?: 0)?(?: or later| only)?
lgpl-3 | gnu lesser general public licen | gnu lesser general public licen[cs]e(?: lgpl)?(?: version)?(?: 3| v3)(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)?
lgpl-2.1 | gnu lesser general public licen | gnu lesser general public licen[cs]e(?: lgpl)?(?: version)?(?: 2| v2) 1(?: or(?: at your option)?(?: any)? later(?: version)?)?
lgpl-2 | gnu library general public licen | gnu library general public licen[cs]e(?: lgpl)?(?: version)?(?: 2| v2)(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)?
lgpl | gnu lesser general public licen | gnu lesser general public licen[cs]e
lgpl | gnu library general public licen | gnu library general public licen[cs]e
lgpl-3 | lgplv3 | lgplv3(?: or later)?
lgpl-2.1 | lgplv2 | lgplv2 1(?: or later)?
lgpl-3 | lgpl | lgpl(?: version)?(?: 3| v3)(?: 0)?(?: or later| only)?
lgpl-2.1 | lgpl | lgpl(?: version)?(?: 2| v2) 1(?: or later| only)?
agpl-3 | gnu affero general public licen | gnu affero general public licen[cs]e(?: agpl)?(?: version)?(?: 3| v3)(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)?
agpl | gnu affero general public licen | gnu affero general public licen[cs]e
agpl-3 | agplv3 | agplv3(?: or later)?
agpl-3 | agpl | agpl(?: version)?(?: 3| v3)(?: 0)?(?: or later| only)?
gfdl-1.3 | gnu free documentation licen | gnu free documentation licen[cs]e(?: gfdl)?(?: version)? 1 3(?: or(?: any)? later(?: version)?)?
gfdl-1.2 | gnu free documentation licen | gnu free documentation licen[cs]e(?: gfdl)?(?: version)? 1 2(?: or(?: any)? later(?: version)?)?
gfdl | gnu free documentation licen | gnu free documentation licen[cs]e
mpl-2.0 | mozilla public licen | mozilla public licen[cs]e(?: mpl)?(?: version)?(?: 2| v2)(?: 0)?
mpl-1.1 | mozilla public licen | mozilla public licen[cs]e(?: mpl)?(?: version)?(?: 1| v1) 1
mpl-1.0 | mozilla public licen | mozilla public licen[cs]e(?: mpl)?(?: version)?(?: 1| v1) 0
mpl | mozilla public licen | mozilla public licen[cs]e
epl-2.0 | eclipse public licen | eclipse public licen[cs]e(?: version)?(?: 2| v2)(?: 0)?
epl-1.0 | eclipse public licen | eclipse public licen[cs]e(?: version)?(?: 1| v1)(?: 0)?
epl | eclipse public licen | eclipse public licen[cs]e
cpl-1.0 | common public licen | common public licen[cs]e(?: version)?(?: 1 0)?
cddl-1.1 | common development and distribution licen | common development and distribution licen[cs]e(?: cddl)?(?: version)? 1 1
cddl-1.0 | common development and distribution licen | common development and distribution licen[cs]e(?: cddl)?(?: version)?(?: 1 0)?
eupl-1.2 | european union public licen | european union public licen[cs]e(?: eupl)?(?: version)?(?: 1| v1) 2
eupl-1.1 | european union public licen | european union public licen[cs]e(?: eupl)?(?: version)?(?: 1| v1) 1
artistic-2.0 | artistic licen | artistic licen[cs]e(?: version)?(?: 2| v2)(?: 0)?
artistic-1.0 | artistic licen | artistic licen[cs]e(?: version)?(?: 1 0)?
bsl-1.0 | boost software licen | boost software licen[cs]e(?: version)?(?: 1 0)?
zlib | zlib licen | zlib licen[cs]e
zlib-acknowledgement | zlib libpng licen | zlib libpng licen[cs]e
libpng | libpng licen | libpng licen[cs]e
psf-2.0 | python software foundation licen | python software foundation licen[cs]e(?: version)?(?: 2(?: 0)?)?
openssl | openssl licen | openssl licen[cs]e
php-3.01 | php licen | php licen[cs]e(?: version)? 3 01
php | php licen | php licen[cs]e
ruby | ruby licen | ruby licen[cs]e
ofl-1.1 | sil open font licen | sil open font licen[cs]e(?: ofl)?(?: version)?(?: 1 1)?
postgresql | postgresql licen | postgresql licen[cs]e
ncsa | ncsa open source licen | (?:university of illinois )?ncsa open source licen[cs]e
upl-1.0 | universal permissive licen | universal permissive licen[cs]e(?: upl)?(?: version)?(?: v1| 1)?(?: 0)?
ms-pl | microsoft public licen | microsoft public licen[cs]e
ms-rl | microsoft reciprocal licen | microsoft reciprocal licen[cs]e
osl-3.0 | open software licen | open software licen[cs]e(?: version)?(?: v)?(?: 3 0)?
afl-3.0 | academic free licen | academic free licen[cs]e(?: version)?(?: v)?(?: 3 0)?
cecill-2.1 | cecill licen | cecill licen[cs]e(?: version)?(?: 2 1)?
odbl-1.0 | open database licen | open database licen[cs]e(?: odbl)?(?: version)?(?: v1 0| 1 0)?
odc-by-1.0 | open data commons attribution licen | open data commons attribution licen[cs]e(?: version)?(?: v1 0| 1 0)?
pddl-1.0 | public domain dedication and licen | (?:open data commons )?public domain dedication and licen[cs]e
busl-1.1 | business source licen | business source licen[cs]e(?: version)?(?: 1 1)?
sspl-1.0 | server side public licen | server side public licen[cs]e(?: version)?(?: v1| 1)?
elastic-2.0 | elastic licen | elastic licen[cs]e(?: version)?(?: v2| 2)?(?: 0)?
wtfpl | do what the fuck you want to public licen | do what the fuck you want to public licen[cs]e
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | creative commons zero | creative commons zero(?: v1 0| 1 0)?(?: universal)?
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [1-4] [0-9])?
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [1-4] [0-9])?
cc-by-nc | cc by nc | cc by nc(?: [1-4] [0-9])?
cc-by-nd | cc by nd | cc by nd(?: [1-4] [0-9])?
cc-by-sa | cc by sa | cc by sa(?: [1-4] [0-9])?
cc-by | cc by | cc by(?: [1-4] [0-9])?
cc-by-nc-nd | creative commons attribution non | creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s?(?: works)?(?: [1-4] [0-9])?
cc-by-nc-sa | creative commons attribution non | creative commons attribution non(?: )?commercial share(?: )?alike(?: [1-4] [0-9])?
cc-by-nc | creative commons attribution non | creative commons attribution non(?: )?commercial(?: [1-4] [0-9])?
cc-by-nd | creative commons attribution no | creative commons attribution no(?: )?deriv(?:ative)?s?(?: works)?(?: [1-4] [0-9])?
cc-by-sa | creative commons attribution share | creative commons attribution share(?: )?alike(?: [1-4] [0-9])?
cc-by | creative commons attribution | creative commons attribution(?: [1-4] [0-9])?
unlicense | the unlicense | the unlicense
public-domain | public domain | public domain
"""

#: Words before a name that make it a grant.
GRANTED = "(?:dual )?(?:licensed|released|distributed|redistributed|published|offered|provided|available|issued|shared|covered)(?: to you)? (?:under|by)(?: a| the)?(?: terms(?: and conditions)? of)?(?: a| the)?"

IDENTIFIERS = """
mit | mit
mit-0 | mit 0
x11 | x11
isc | isc
0bsd | 0bsd
bsd-2-clause | bsd 2 clause
bsd-3-clause | bsd 3 clause
bsd-4-clause | bsd 4 clause
apache-1.0 | apache 1 0
apache-1.1 | apache 1 1
apache-2 | apache 2 0
gpl-1 | gpl 1 0(?: only| or later)?
gpl-2 | gpl 2 0(?: only| or later)?
gpl-3 | gpl 3 0(?: only| or later)?
lgpl-2 | lgpl 2 0(?: only| or later)?
lgpl-2.1 | lgpl 2 1(?: only| or later)?
lgpl-3 | lgpl 3 0(?: only| or later)?
agpl-3 | agpl 3 0(?: only| or later)?
gfdl-1.2 | gfdl 1 2(?: only| or later)?
gfdl-1.3 | gfdl 1 3(?: only| or later)?
mpl-1.0 | mpl 1 0
mpl-1.1 | mpl 1 1
mpl-2.0 | mpl 2 0
epl-1.0 | epl 1 0
epl-2.0 | epl 2 0
cpl-1.0 | cpl 1 0
cddl-1.0 | cddl 1 0
cddl-1.1 | cddl 1 1
eupl-1.1 | eupl 1 1
eupl-1.2 | eupl 1 2
artistic-1.0 | artistic 1 0(?: perl| cl8)?
artistic-2.0 | artistic 2 0
bsl-1.0 | bsl 1 0
busl-1.1 | busl 1 1
zlib | zlib
libpng | libpng(?: 2 0)?
psf-2.0 | psf 2 0
psf-2.0 | python 2 0
openssl | openssl
php-3.01 | php 3 01
ruby | ruby
ofl-1.1 | ofl 1 1
postgresql | postgresql
ncsa | ncsa
upl-1.0 | upl 1 0
ms-pl | ms pl
ms-rl | ms rl
osl-3.0 | osl 3 0
afl-3.0 | afl 3 0
cecill-2.1 | cecill 2 1
odbl-1.0 | odbl 1 0
odc-by-1.0 | odc by 1 0
pddl-1.0 | pddl 1 0
sspl-1.0 | sspl 1 0
elastic-2.0 | elastic 2 0
wtfpl | wtfpl
cc0-1.0 | cc0 1 0
cc-by | cc by [1-4] [0-9]
cc-by-sa | cc by sa [1-4] [0-9]
cc-by-nd | cc by nd [1-4] [0-9]
cc-by-nc | cc by nc [1-4] [0-9]
cc-by-nc-sa | cc by nc sa [1-4] [0-9]
cc-by-nc-nd | cc by nc nd [1-4] [0-9]
unlicense | unlicense
"""

NOTICES = """
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | copyright notice and this permission notice shall be included | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy
isc | permission to use copy modify and | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc | copyright notice and this permission notice appear in all copies | provided that the above copyright notice and this permission notice appear in all copies
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions of source code must retain | redistributions of source code must retain the above copyright notice
bsd | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | without specific prior written permission | neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|the) contributors may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | copyright | copyright notice all advertising materials mentioning features or use of this software must display
apache-2 | you may not use this file except in compliance with the licen | you may not use this file except in compliance with the licen[cs]e
apache-2 | you may obtain a copy of the licen | you may obtain a copy of the licen[cs]e at http www apache org licen[cs]es
apache-2 | governing permission | see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e
gpl | gnu general public licen | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation
gpl-3 | gnu general public licen | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e
gpl-2 | gnu general public licen | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e
lgpl | gnu lesser general public licen | you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation
agpl | gnu affero general public licen | you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e as published by the free software foundation
gpl | gnu general public licen | you should have received a copy of the gnu general public licen[cs]e along with this program
lgpl | gnu lesser general public licen | you should have received a copy of the gnu lesser general public licen[cs]e along with this (?:program|library)
agpl | gnu affero general public licen | you should have received a copy of the gnu affero general public licen[cs]e along with this program
gfdl | gnu free documentation licen | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
mpl-2.0 | mozilla public licen | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-1.1 | mozilla public licen | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-2.0 | eclipse public licen | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2 0
epl-1.0 | eclipse public licen | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0
cddl-1.0 | common development and distribution licen | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
zlib | without any express or implied warrant | this software is provided as is without any express or implied warranty
zlib | altered from any source redistribut | this notice may not be removed or altered from any source redistribution
bsl-1.0 | permission is hereby granted free of charge | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e
unlicense | released into the public domain | this is free and unencumbered software released into the public domain
cc0-1.0 | copyright and related | to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright and related or neighboring rights
wtfpl | everyone is permitted to copy and distribute | everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document and changing it is allowed
ofl-1.1 | sil open font licen | this font software is licensed under the sil open font licen[cs]e version 1 1
ncsa | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software
artistic-2.0 | everyone is permitted to copy and distribute | everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed preamble this licen[cs]e establishes the terms under which a given free software package may be copied modified distributed and or redistributed the intent is that the copyright holder
proprietary | all rights reserved unauthorized copy | all rights reserved unauthorized copying of this file via any medium is strictly prohibited
proprietary | proprietary and confidential unauthorized copy | proprietary and confidential unauthorized copying
public-domain | public domain | (?:placed|put|dedicated|released) (?:in|into|to) the public domain
"""

ADDRESSES = """
mit | org licenses mit | opensource org licenses mit
bsd-2-clause | org licenses bsd 2 clause | opensource org licenses bsd 2 clause
bsd-3-clause | org licenses bsd 3 clause | opensource org licenses bsd 3 clause
isc | org licenses isc | opensource org licenses isc
artistic-2.0 | org licenses artistic | opensource org licenses artistic license 2 0
apache-2 | apache org licenses | (?:www )?apache org licenses license 2 0
apache-1.1 | apache org licenses | (?:www )?apache org licenses license 1 1
gpl-3 | gnu org licenses | (?:www )?gnu org licenses gpl 3 0
gpl-2 | gnu org licenses | (?:www )?gnu org licenses(?: old licenses)? gpl 2 0
gpl | gnu org licenses | (?:www )?gnu org licenses gpl
lgpl-3 | gnu org licenses | (?:www )?gnu org licenses lgpl 3 0
lgpl-2.1 | gnu org licenses | (?:www )?gnu org licenses(?: old licenses)? lgpl 2 1
lgpl | gnu org licenses | (?:www )?gnu org licenses lgpl
agpl-3 | gnu org licenses | (?:www )?gnu org licenses agpl(?: 3 0)?
gfdl | gnu org licenses | (?:www )?gnu org licenses fdl(?: 1 [1-3])?
mpl-2.0 | mozilla org mpl | (?:www )?mozilla org mpl(?: 2 0)?
unlicense | unlicense org | unlicense org
cc0-1.0 | creativecommons org publicdomain zero | creativecommons org publicdomain zero 1 0
cc-by | creativecommons org licenses by | creativecommons org licenses by [1-4] [0-9]
cc-by-sa | creativecommons org licenses by sa | creativecommons org licenses by sa [1-4] [0-9]
cc-by-nd | creativecommons org licenses by nd | creativecommons org licenses by nd [1-4] [0-9]
cc-by-nc | creativecommons org licenses by nc | creativecommons org licenses by nc [1-4] [0-9]
cc-by-nc-sa | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa [1-4] [0-9]
cc-by-nc-nd | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd [1-4] [0-9]
ofl-1.1 | scripts sil org ofl licen | scripts sil org ofl licen[cs]e
"""

MENTIONS = """
mit | mit licensed | mit licensed
apache | apache licensed | apache licensed
bsd | bsd licensed | bsd licensed
bsd | bsd style | bsd style(?: licen[cs]e)?
gpl | gpl | gpl
gpl | gpl licensed | gpl licensed
gpl | gpl compatible | gpl compatible
lgpl | lgpl | lgpl
agpl | agpl | agpl
gpl | general public licen | general public licen[cs]e
creative-commons | creative commons | creative commons
copyleft | copyleft | copyleft
proprietary | all rights reserved copy | all rights reserved copyright
unlicense | unlicense | unlicense
"""

#: Phrases whose labels always stay, whatever else lies around them.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def lines(table: str) -> list[list[str]]:
    return [[part.strip() for part in line.split("|", 2)] for line in table.strip().splitlines()]


def identifiers() -> list[Rule]:
    """Rules of an identifier line's first licence, and of one that follows `or` or `and`."""
    found, line = [], "spdx license identifier"
    for label, pattern in (line.split(" | ", 1) for line in IDENTIFIERS.strip().splitlines()):
        found.append(Rule(label, line, f"{line} {pattern}", IDENTIFIER))
        found.append(Rule(label, line, f"{line}(?: [0-9a-z]+){{1,8}} (?:or|and) {pattern}", GRANT))
    return found


def all_rules(base: dict[str, str] = BASE) -> list[Rule]:
    """The rules in order: of places alike in all else the earlier rule wins."""
    kinds = ((NOTICES, NOTICE), (ADDRESSES, GRANT), (NAMES, NAME), (MENTIONS, MENTION))
    found = [Rule(label, phrase, phrase, NAME, True) for phrase, label in base.items()] + identifiers()
    found += [Rule(label, keyword, f"{GRANTED} {pattern}", GRANT) for label, keyword, pattern in lines(NAMES)]
    return found + [Rule(label, keyword, pattern, priority) for table, priority in kinds for label, keyword, pattern in lines(table)]
