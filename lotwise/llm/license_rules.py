"""License signatures, by hand.

One line per label: ``label | priority | keyword | pattern ; pattern ; ...``.
A smaller priority is the surer kind (1: names the licence and its terms or
version, 2: a licence's full name, 3: its usual short form, 4: a bare hint).
Patterns are over whole words: ``[x]`` may be missing, ``(a|b)`` is a choice,
``#`` a number.  The keyword is a word that every match of the line contains.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SIGNATURES = """
gpl-3.0 | 1 | general | gnu general public license [as] [published] [by] [the] [free] [software] [foundation] [either] version 3 ; gnu general public license v3 ; gnu general public licence [version] 3 ; general public license version 3 0
gpl-3.0 | 2 | gpl | gpl [version] 3 [0] [only] ; gpl [v] 3 or later ; gnu gpl 3 ; licensed under [the] gpl 3
gpl-3.0 | 2 | gplv3 | gplv3 ; gnu gplv3 ; the gplv3 license ; gplv3 or later
gpl-2.0 | 1 | general | gnu general public license version 2 ; gnu general public license v2 ; gnu general public licence version 2 ; general public license version 2 0
gpl-2.0 | 2 | gpl | gpl version 2 [0] [only] ; gpl 2 0 or later ; gnu gpl 2 ; licensed under [the] gpl 2
gpl-2.0 | 2 | gplv2 | gplv2 ; gnu gplv2 ; the gplv2 license ; gplv2 or later
gpl-1.0 | 1 | general | gnu general public license version 1 ; gnu general public license v1 ; gnu general public licence version 1
gpl | 2 | general | gnu general public license ; gnu general public licence ; under [the] terms of the gnu general public license ; general public license as published
gpl | 3 | gpl | gnu gpl ; gpl license ; gpl licence ; gpl licensed ; licensed under [the] gpl ; released under [the] gpl
lgpl-3.0 | 1 | lesser | gnu lesser general public license version 3 ; gnu lesser general public license v3 ; lesser general public license version 3
lgpl-2.1 | 1 | lesser | gnu lesser general public license version 2 1 ; gnu lesser general public license v2 1 ; lesser general public license version 2 1
lgpl-2.0 | 1 | library | gnu library general public license version 2 ; gnu library general public license
lgpl | 1 | lesser | gnu lesser general public license ; gnu lesser general public licence ; lesser general public license
lgpl | 3 | lgpl | gnu lgpl ; lgpl license ; lgpl licence ; licensed under [the] lgpl ; lgpl version # ; lgpl # #
agpl-3.0 | 1 | affero | gnu affero general public license version 3 ; gnu affero general public license v3 ; affero general public license version 3
agpl | 1 | affero | gnu affero general public license ; gnu affero general public licence ; affero general public license
agpl | 3 | agpl | gnu agpl ; agpl license ; licensed under [the] agpl ; agpl version # ; agpl # #
gfdl | 1 | documentation | gnu free documentation license version 1 # ; gnu free documentation license ; gnu free documentation licence
apache-2.0 | 1 | apache | apache license version 2 0 ; apache license v2 0 ; apache software license version 2 0 ; apache licence version 2 0 ; apache license 2 0
apache-2.0 | 2 | apache | apache 2 0 license ; apache 2 license ; licensed under apache 2 0 ; apache 2 0
apache-1.1 | 1 | apache | apache license version 1 1 ; apache software license version 1 1 ; apache license 1 1
apache-1.0 | 1 | apache | apache license version 1 0 ; apache software license version 1 0 ; apache license 1 0
apache | 2 | apache | apache license ; apache licence ; apache software license ; licensed under the apache license ; apache software foundation license
mit | 1 | granted | permission is hereby granted free of charge to any person obtaining a copy
mit | 2 | license | the mit license ; mit license ; released under the mit license ; distributed under the mit license ; mit x11 license ; licensed under the mit license
mit | 2 | licence | the mit licence ; mit licence ; released under the mit licence
mit | 3 | license | license mit
mit | 3 | licensed | mit licensed ; licensed under mit ; licensed under the mit
mit-0 | 1 | attribution | mit no attribution ; mit no attribution license
mit-0 | 1 | license | mit 0 license
x11 | 2 | x11 | x11 license ; x11 licence ; x consortium x11 license
bsd-3-clause | 1 | bsd | bsd 3 clause ; 3 clause bsd ; three clause bsd ; new bsd license ; modified bsd license ; revised bsd license ; bsd 3 clause license
bsd-3-clause | 1 | endorse | neither the name of the [copyright] [holder] nor the names of its contributors may be used to endorse ; may be used to endorse or promote products derived from this software
bsd-2-clause | 1 | bsd | bsd 2 clause ; 2 clause bsd ; two clause bsd ; simplified bsd license ; bsd 2 clause license
bsd-2-clause | 1 | freebsd | freebsd license ; freebsd licence
bsd-4-clause | 1 | bsd | bsd 4 clause ; 4 clause bsd ; original bsd license ; four clause bsd
bsd | 1 | redistribution | redistribution and use in source and binary forms with or without modification are permitted ; redistribution and use in source and binary forms
bsd | 2 | bsd | bsd license ; bsd licence ; bsd style license ; licensed under [the] bsd ; bsd licensed
0bsd | 1 | 0bsd | 0bsd license ; zero clause bsd 0bsd ; license 0bsd
isc | 1 | isc | isc license ; isc licence ; licensed under [the] isc license
isc | 1 | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
mpl-2.0 | 1 | mozilla | mozilla public license version 2 0 ; mozilla public license v 2 0 ; mozilla public license 2 0 ; mozilla public licence version 2 0
mpl-1.1 | 1 | mozilla | mozilla public license version 1 1 ; mozilla public license 1 1
mpl | 2 | mozilla | mozilla public license ; mozilla public licence
mpl | 3 | mpl | mpl 2 0 ; mpl 1 1 ; mpl license ; licensed under [the] mpl
epl-2.0 | 1 | eclipse | eclipse public license version 2 0 ; eclipse public license v 2 0 ; eclipse public license 2 0
epl-1.0 | 1 | eclipse | eclipse public license version 1 0 ; eclipse public license v 1 0 ; eclipse public license 1 0
epl | 2 | eclipse | eclipse public license ; eclipse public licence ; eclipse distribution license
cddl | 1 | cddl | cddl 1 0 ; cddl 1 1 ; cddl license ; licensed under [the] cddl
cddl | 1 | distribution | common development and distribution license version # # ; common development and distribution license
cpl | 1 | common | common public license version 1 0 ; common public license
eupl | 1 | european | european union public licence ; european union public license ; european union public licence v # #
eupl | 2 | eupl | eupl 1 2 ; eupl 1 1 ; eupl license
cecill | 1 | cecill | cecill license ; cecill free software license agreement ; cecill 2 1 ; cecill b ; cecill c
artistic-2.0 | 1 | artistic | artistic license 2 0 ; artistic license version 2 0 ; the artistic license 2
artistic | 2 | artistic | artistic license ; artistic licence ; perl artistic license
zlib | 1 | zlib | zlib license ; zlib licence ; zlib libpng license ; zlib png license
libpng | 1 | libpng | libpng license ; libpng licence ; png reference library libpng license
boost | 1 | boost | boost software license version 1 0 ; boost software license ; boost license ; boost software licence
unlicense | 1 | unlicense | the unlicense ; unlicense org ; unlicense license ; released under [the] unlicense
unlicense | 1 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 1 | wtfpl | wtfpl license ; wtfpl version # ; under [the] wtfpl ; wtfpl
postgresql | 1 | postgresql | postgresql license ; postgresql licence
python | 1 | python | python software foundation license ; psf license python ; python license version # ; python software foundation licence
php | 1 | php | php license version 3 # ; php license ; php licence
ruby | 1 | ruby | ruby license ; ruby s license ; same terms as ruby
openssl | 1 | openssl | openssl license ; openssl licence ; openssl ssleay license ; openssl toolkit license
ofl-1.1 | 1 | sil | sil open font license version 1 1 ; sil open font license ; sil open font licence
ofl-1.1 | 2 | ofl | ofl 1 1 ; ofl license ; licensed under [the] ofl
ncsa | 1 | ncsa | university of illinois ncsa open source license ; ncsa license ; ncsa open source license
afl | 1 | academic | academic free license version 3 0 ; academic free license v # # ; academic free license
ecl | 1 | educational | educational community license version 2 0 ; educational community license
osl-3.0 | 1 | osl | osl 3 0 ; osl license
osl-3.0 | 1 | open | open software license version 3 0 ; open software license v 3 0 ; open software license
ms-pl | 1 | microsoft | microsoft public license ; microsoft public license ms pl ; microsoft permissive license
ms-rl | 1 | reciprocal | microsoft reciprocal license ; microsoft reciprocal license ms rl
upl | 1 | universal | universal permissive license version 1 0 ; universal permissive license v 1 0 ; universal permissive license
lppl | 1 | latex | latex project public license ; latex project public license version 1 # ; latex project public licence
vim | 1 | vim | vim license ; vim licence
w3c | 1 | w3c | w3c software notice and license ; w3c software license ; w3c document license
bsl-1.1 | 1 | business | business source license 1 1 ; business source license version 1 1 ; business source license
sspl | 1 | server | server side public license version 1 ; server side public license ; server side public licence
elastic-2.0 | 1 | elastic | elastic license 2 0 ; elastic license version 2 0 ; elastic license
commons-clause | 1 | commons | commons clause license condition v 1 0 ; commons clause license ; commons clause
cc0-1.0 | 1 | cc0 | cc0 1 0 universal ; cc0 1 0 ; cc0 license ; creative commons cc0 ; cc0 public domain dedication ; licensed under cc0
cc-by-nc-nd | 1 | cc | cc by nc nd # 0 ; cc by nc nd ; licensed under cc by nc nd
cc-by-nc-sa | 1 | cc | cc by nc sa # 0 ; cc by nc sa ; licensed under cc by nc sa
cc-by-nc | 1 | cc | cc by nc # 0 ; cc by nc ; licensed under cc by nc ; cc by nc license
cc-by-nd | 1 | cc | cc by nd # 0 ; cc by nd ; licensed under cc by nd
cc-by-sa | 1 | cc | cc by sa # 0 ; cc by sa ; licensed under cc by sa ; cc by sa license
cc-by-4.0 | 1 | cc | cc by 4 0 ; cc by 4 0 international ; licensed under cc by 4 0
cc-by-3.0 | 1 | cc | cc by 3 0 ; cc by 3 0 unported ; licensed under cc by 3 0
cc-by | 2 | cc | cc by ; cc by license ; licensed under cc by
cc-by | 2 | attribution | creative commons attribution ; creative commons attribution license ; creative commons attribution # 0 international ; creative commons attribution # 0 license
cc-by-sa | 1 | sharealike | creative commons attribution sharealike ; creative commons attribution sharealike # 0 ; attribution sharealike # 0 international
cc-by-nc | 1 | noncommercial | creative commons attribution noncommercial ; creative commons attribution noncommercial # 0 ; attribution noncommercial # 0 international
cc-by-nd | 1 | noderivatives | creative commons attribution noderivatives ; creative commons attribution noderivatives # 0 ; attribution noderivatives # 0 international
creative-commons | 3 | creative | creative commons license ; creative commons licence ; licensed under creative commons ; creative commons
public-domain | 2 | domain | dedicated to the public domain ; placed in the public domain ; released into the public domain ; in the public domain ; public domain dedication
odbl | 1 | database | open database license ; open database license odbl ; open data commons open database license
odc-by | 1 | commons | open data commons attribution license ; open data commons attribution
pddl | 1 | pddl | pddl license ; odc pddl ; pddl 1 0
openrail | 1 | openrail | openrail m ; creativeml openrail m ; bigscience openrail m ; openrail license
llama | 1 | llama | llama 2 community license ; llama 3 community license ; llama community license agreement
proprietary | 2 | reserved | all rights reserved ; all rights are reserved ; rights reserved worldwide
proprietary | 2 | proprietary | proprietary and confidential ; proprietary license ; proprietary software license
spdx | 4 | spdx | spdx license identifier ; spdx id
license-hint | 4 | license | see the license file ; see license for details ; license file for details ; under the following license ; this work is licensed under [the] license ; subject to the license
license-hint | 4 | licensed | this work is licensed under ; this software is licensed under ; is licensed under the ; licensed under the terms
license-hint | 4 | licence | see the licence file ; under the following licence ; subject to the licence
"""

#: Phrases of the base report.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
WEIGHTS = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.3}


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    keyword: str
    literal: str        # the longest run of words that every match contains, padded
    pattern: str


def compiled(pattern: str) -> str:
    """Regex over a text whose words each stand between blanks of their own (`` a  b ``)."""
    out = []
    for token in pattern.split():
        if token.startswith("["):
            out.append(f"(?: {token[1:-1]} )?")
        elif token == "#":
            out.append(" [0-9]+ ")
        elif token.startswith("("):
            out.append(f" (?:{token[1:-1]}) ")
        else:
            out.append(f" {re.escape(token)} ")
    return "".join(out)


def literal(pattern: str) -> str:
    """The longest run of plain words in a pattern, padded like the text."""
    runs = [[]]
    for token in pattern.split():
        if token[0] in "[(#":
            runs.append([])
        else:
            runs[-1].append(token)
    return "".join(f" {w} " for w in max(runs, key=lambda r: sum(len(w) + 2 for w in r)))


def signatures() -> tuple[Signature, ...]:
    """The table above, in its order, which decides between equal spans of equal priority."""
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, priority, keyword, patterns = (x.strip() for x in line.split(" | "))
        out += [Signature(label, int(priority), keyword, literal(p), compiled(p)) for p in patterns.split(" ; ")]
    return tuple(out)
