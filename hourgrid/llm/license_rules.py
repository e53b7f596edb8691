"""Signature rules for licence notices.

A block begins with ``label keyword``; each line below is ``priority regex`` over lower-case words with one space between.
The keyword is a word that every match of the block holds. Priorities: 1 tag, 2 grant or notice sentence,
3 name with version or owner, 4 bare mention. Within a priority earlier rules come first.
"""

from __future__ import annotations

TEXT = """
mit mit
2 (?:released|distributed|licensed|available|provided) under (?:the )?(?:terms of )?(?:the )?mit licen[sc]e
2 under the terms of the mit licen[sc]e
2 this (?:software|project|code|work) is (?:free )?(?:and )?(?:licensed )?under (?:the )?mit
3 the mit licen[sc]e mit
3 mit x11 licen[sc]e
3 mit expat licen[sc]e
4 mit licensed
4 licen[sc]e mit
4 mit licen[sc]e
mit expat
3 expat licen[sc]e
mit charge
2 permission is hereby granted free of charge to any person obtaining a copy
mit substantial
2 shall be included in all copies or substantial portions of the software
mit-0 attribution
3 mit no attribution(?: licen[sc]e)?
apache-2 apache
2 licensed under the apache licen[sc]e version 2 0
2 licensed under (?:the )?apache(?: software)? licen[sc]e
2 (?:released|distributed|available) under (?:the )?(?:terms of )?(?:the )?apache 2(?: 0)?
2 you may not use this file except in compliance with the apache licen[sc]e
2 www apache org licenses license 2 0
3 apache(?: software)? licen[sc]e (?:version |v )?2(?: 0)?
3 apache 2 0 licen[sc]e
3 apache v2 licen[sc]e
3 asf 2 0 apache
4 apache 2 licen[sc]e
4 licen[sc]e apache
apache-2 warranties
2 distributed on an as is basis without warranties or conditions of any kind
apache-1.1 apache
3 apache(?: software)? licen[sc]e (?:version )?1 1
2 this product includes software developed by the apache software foundation
apache-1.0 apache
3 apache(?: software)? licen[sc]e (?:version )?1 0
bsd-2-clause bsd
3 (?:the )?(?:bsd )?2 clause bsd licen[sc]e
3 (?:the )?two clause bsd licen[sc]e
3 (?:the )?simplified bsd licen[sc]e
3 (?:the )?freebsd bsd licen[sc]e
3 bsd 2 clause(?: licen[sc]e)?
bsd-2-clause freebsd
3 freebsd licen[sc]e
bsd-3-clause bsd
3 (?:the )?3 clause bsd licen[sc]e
3 (?:the )?three clause bsd licen[sc]e
3 (?:the )?new bsd licen[sc]e
3 (?:the )?modified bsd licen[sc]e
3 (?:the )?revised bsd licen[sc]e
3 bsd 3 clause(?: licen[sc]e)?
2 governed by a bsd style licen[sc]e
bsd-3-clause endorse
2 may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause bsd
3 (?:the )?4 clause bsd licen[sc]e
3 (?:the )?four clause bsd licen[sc]e
3 (?:the )?original bsd licen[sc]e
3 bsd 4 clause(?: licen[sc]e)?
bsd-4-clause advertising
2 all advertising materials mentioning features or use of this software must display
bsd binary
2 redistribution and use in source and binary forms with or without modification are permitted
bsd bsd
2 (?:released|distributed|licensed|available) under (?:the )?(?:terms of )?(?:the )?bsd
4 bsd style licen[sc]e
4 bsd licen[sc]e
4 bsd licensed
0bsd bsd
3 zero clause bsd(?: licen[sc]e)?
3 0 clause bsd(?: licen[sc]e)?
gpl-3.0 gnu
2 gnu general public licen[sc]e as published by the free software foundation (?:either )?version 3
2 under the terms of the gnu general public licen[sc]e version 3
3 gnu general public licen[sc]e (?:version |v )?3(?: 0)?
3 gnu gpl (?:version |v )?3(?: 0)?
3 gnu gplv3
gpl-3.0 gplv3
3 gplv3(?: licen[sc]e)?
gpl-3.0 gpl
3 gpl (?:version |v )?3(?: 0)?(?: or later)?
gpl-2.0 gnu
2 gnu general public licen[sc]e as published by the free software foundation (?:either )?version 2
2 under the terms of the gnu general public licen[sc]e version 2
3 gnu general public licen[sc]e (?:version |v )?2(?: 0)?
3 gnu gpl (?:version |v )?2(?: 0)?
3 gnu gplv2
gpl-2.0 gplv2
3 gplv2(?: licen[sc]e)?
gpl-2.0 gpl
3 gpl (?:version |v )?2(?: 0)?(?: or later)?
gpl gnu
2 under the terms of the gnu general public licen[sc]e
2 you should have received a copy of the gnu general public licen[sc]e
4 gnu general public licen[sc]e
4 gnu gpl
gpl gpl
2 (?:released|distributed|licensed|available) under (?:the )?gpl
4 gpl licen[sc]e
4 gpl licensed
lgpl-3.0 gnu
3 gnu (?:lesser|library) general public licen[sc]e (?:version |v )?3(?: 0)?
3 gnu lgpl (?:version |v )?3(?: 0)?
lgpl-3.0 lgpl
3 lgpl (?:version |v )?3(?: 0)?
lgpl-3.0 lgplv3
3 lgplv3
lgpl-2.1 gnu
3 gnu lesser general public licen[sc]e (?:version |v )?2 1
3 gnu lgpl (?:version |v )?2 1
lgpl-2.1 lgpl
3 lgpl (?:version |v )?2 1
lgpl-2.0 gnu
3 gnu library general public licen[sc]e (?:version |v )?2(?: 0)?
lgpl gnu
2 under the terms of the gnu (?:lesser|library) general public licen[sc]e
2 you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e
4 gnu (?:lesser|library) general public licen[sc]e
4 gnu lgpl
lgpl lgpl
4 lgpl licen[sc]e
4 under (?:the )?lgpl
agpl-3.0 affero
2 under the terms of the gnu affero general public licen[sc]e
2 you should have received a copy of the gnu affero general public licen[sc]e
3 (?:gnu )?affero general public licen[sc]e (?:version |v )?3(?: 0)?
4 (?:gnu )?affero general public licen[sc]e
agpl-3.0 agpl
3 agpl (?:version |v )?3(?: 0)?
4 agpl licen[sc]e
agpl-3.0 agplv3
3 agplv3
gfdl gnu
2 under the terms of the gnu free documentation licen[sc]e
3 gnu free documentation licen[sc]e (?:version |v )?1 [123]
4 gnu free documentation licen[sc]e
4 gnu fdl
mpl-2.0 mozilla
2 subject to the terms of the mozilla public licen[sc]e v 2 0
3 mozilla public licen[sc]e (?:version |v )?2(?: 0)?
3 mozilla org mpl 2 0
mpl-2.0 mpl
3 mpl (?:version |v )?2(?: 0)?
mpl-1.1 mozilla
3 mozilla public licen[sc]e (?:version |v )?1 1
mpl-1.1 mpl
3 mpl (?:version |v )?1 1
mpl mozilla
4 mozilla public licen[sc]e
epl-2.0 eclipse
3 eclipse public licen[sc]e (?:version |v )?2(?: 0)?
epl-1.0 eclipse
3 eclipse public licen[sc]e (?:version |v )?1(?: 0)?
2 www eclipse org legal epl v10
epl eclipse
2 made available under the terms of the eclipse public licen[sc]e
4 eclipse public licen[sc]e
edl eclipse
3 eclipse distribution licen[sc]e(?: (?:version |v )?1(?: 0)?)?
cddl-1.0 common
2 subject to the terms of the common development and distribution licen[sc]e
3 common development and distribution licen[sc]e(?: (?:version |v )?1 [01])?
cddl-1.0 cddl
4 cddl licen[sc]e
cpl-1.0 common
3 common public licen[sc]e(?: (?:version |v )?1(?: 0)?)?
isc isc
2 (?:released|distributed|licensed|available) under (?:the )?(?:terms of )?(?:the )?isc licen[sc]e
4 isc licen[sc]e
isc fee
2 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib zlib
3 zlib libpng licen[sc]e
4 zlib licen[sc]e
zlib misrepresented
2 the origin of this software must not be misrepresented
libpng libpng
3 libpng licen[sc]e(?: (?:version |v )?2)?
boost-1.0 boost
2 distributed under the boost software licen[sc]e
3 boost software licen[sc]e (?:version |v )?1(?: 0)?
4 boost(?: software)? licen[sc]e
unlicense unlicense
2 under the unlicense
3 the unlicense
4 unlicense org
unlicense unencumbered
2 this is free and unencumbered software released into the public domain
wtfpl wtfpl
3 wtfpl(?: version 2)?
wtfpl fuck
3 do what the fuck you want to public licen[sc]e
artistic-2.0 artistic
3 (?:the )?artistic licen[sc]e (?:version |v )?2(?: 0)?
artistic-1.0 artistic
3 (?:the )?artistic licen[sc]e (?:version |v )?1(?: 0)?
artistic artistic
2 same terms as perl under the artistic
4 artistic licen[sc]e
perl perl
2 under the same terms as perl(?: itself)?
python-2.0 python
3 python software foundation licen[sc]e(?: (?:version |v )?2)?
4 psf licen[sc]e python
4 python licen[sc]e
ruby ruby
4 ruby licen[sc]e
3 same licen[sc]e as ruby
php-3.01 php
3 php licen[sc]e (?:version |v )?3 01
4 php licen[sc]e
openssl openssl
3 openssl(?: and ssleay)? licen[sc]e
2 for use in the openssl toolkit
ms-pl microsoft
3 microsoft public licen[sc]e
ms-rl microsoft
3 microsoft reciprocal licen[sc]e
eupl-1.2 european
3 european union public licen[sc]e (?:version |v )?1 2
eupl european
4 european union public licen[sc]e
eupl eupl
4 eupl(?: (?:version |v )?1 [12])?
osl-3.0 open
3 open software licen[sc]e(?: (?:version |v )?3(?: 0)?)?
ofl-1.1 sil
2 licensed under the sil open font licen[sc]e
3 sil open font licen[sc]e(?: (?:version |v )?1 [01])?
odbl-1.0 database
3 open (?:data commons open )?database licen[sc]e(?: (?:version |v )?1(?: 0)?)?
odc-by-1.0 commons
3 open data commons attribution licen[sc]e
pddl-1.0 commons
3 open data commons public domain dedication and licen[sc]e
postgresql postgresql
3 postgresql licen[sc]e
ncsa illinois
3 university of illinois(?: ncsa)? open source licen[sc]e
ncsa ncsa
3 ncsa open source licen[sc]e
upl-1.0 universal
3 universal permissive licen[sc]e(?: (?:version |v )?1(?: 0)?)?
bsl-1.1 business
3 business source licen[sc]e(?: (?:version |v )?1 1)?
sspl-1.0 server
3 server side public licen[sc]e(?: (?:version |v )?1)?
elastic-2.0 elastic
3 elastic licen[sc]e (?:version |v )?2(?: 0)?
elastic elastic
4 elastic licen[sc]e
openrail rail
3 (?:creativeml |bigscience |bigcode )?open rail(?: m)?(?: licen[sc]e)?
llama llama
3 llama (?:2 |3 |3 1 )?community licen[sc]e(?: agreement)?
cc0-1.0 cc0
2 released under cc0
3 cc0 1 0(?: universal)?
4 cc0(?: licen[sc]e)?
cc0-1.0 dedication
3 creative commons (?:zero |public domain )dedication
cc0-1.0 zero
3 creative commons zero(?: (?:v )?1 0)?
cc-by-nc-nd creative
3 creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-nc-sa creative
3 creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
cc-by-nc creative
3 creative commons attribution non ?commercial(?: [1234] [05])?
cc-by-nd creative
3 creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-sa creative
3 creative commons attribution share ?alike(?: [1234] [05])?
2 text is available under the creative commons attribution share ?alike licen[sc]e
cc-by creative
3 creative commons attribution(?: (?:international )?(?:licen[sc]e )?[1234] [05])?
cc creative
2 licensed under a creative commons licen[sc]e
4 creative commons licen[sc]e
cc-by-nc-nd cc
3 cc by nc nd(?: [1234] [05])?
cc-by-nc-sa cc
3 cc by nc sa(?: [1234] [05])?
cc-by-nc cc
3 cc by nc(?: [1234] [05])?
cc-by-nd cc
3 cc by nd(?: [1234] [05])?
cc-by-sa cc
3 cc by sa(?: [1234] [05])?
cc-by cc
3 cc by [1234] [05]
public-domain domain
2 (?:released|dedicated|placed) (?:in|into|to) the public domain
4 in the public domain
proprietary reserved
3 all rights reserved
proprietary proprietary
2 this (?:software|document|file) is proprietary(?: and confidential)?
3 proprietary and confidential
proprietary confidential
3 confidential and proprietary
copyright copyright
4 copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
4 copyright (?:by|holders?|owners?)
"""

#: Tags name their licence outright; their rules follow from the identifiers.
TAGS = ("mit mit-0 apache-1.0 apache-1.1 apache-2.0 bsd-2-clause bsd-3-clause bsd-4-clause 0bsd gpl-2.0 gpl-3.0 lgpl-2.0 lgpl-2.1 "
        "lgpl-3.0 agpl-3.0 mpl-1.1 mpl-2.0 epl-1.0 epl-2.0 cddl-1.0 cpl-1.0 isc zlib libpng bsl-1.0 unlicense wtfpl artistic-1.0 "
        "artistic-2.0 python-2.0 ruby php-3.01 openssl ms-pl ms-rl eupl-1.2 osl-3.0 ofl-1.1 odbl-1.0 odc-by-1.0 pddl-1.0 postgresql "
        "ncsa upl-1.0 sspl-1.0 elastic-2.0 cc0-1.0 cc-by-4.0 cc-by-sa-4.0 cc-by-nc-4.0 cc-by-nd-4.0 cc-by-nc-sa-4.0 cc-by-nc-nd-4.0").split()
_LABELS = {"apache-2.0": "apache-2", "bsl-1.0": "boost-1.0", **{t: t.removesuffix("-4.0") for t in TAGS if t.startswith("cc-")}}


def rules() -> list[dict]:
    """All rules in order: ``rank, priority, label, keyword, regex``; a smaller rank comes first."""
    made = [(1, _LABELS.get(tag, tag), "spdx", "spdx license identifier " + tag.replace("-", " ").replace(".", " ") + "(?: only| or later)?")
            for tag in sorted(TAGS, key=lambda t: -len(t))]
    label = keyword = ""
    for line in TEXT.strip().splitlines():
        first, rest = line.split(" ", 1)
        if first.isdigit() and len(first) == 1:
            made.append((int(first), label, keyword, rest))
        else:
            label, keyword = first, rest
    made.sort(key=lambda rule: rule[0])
    return [{"rank": i, "priority": p, "label": label, "keyword": keyword, "regex": regex}
            for i, (p, label, keyword, regex) in enumerate(made)]
