"""Signature rules for licence texts, notices and tags: fixed values, one rule a line.

label | priority | keyword | expression. Texts are matched as their lower-case words joined by single spaces, so
"Apache License, Version 2.0" reads "apache license version 2 0". Every match holds the keyword. Priorities: 90 for
identifiers and full titles with a version, 70 for titles, 50 for phrases of a licence's body, 30 for loose mentions.
"""

RULES = r"""
apache-2.0 | 90 | apache | spdx license identifier apache 2 0
apache-2.0 | 90 | apache | apache license version 2(?: 0)?
apache-2.0 | 90 | apache | licensed under the apache license(?: version)? 2(?: 0)?
apache-2.0 | 90 | apache | apache (?:software )?license 2 0
apache-2.0 | 70 | licenses license | (?:www )?apache org licenses license 2 0
apache-2.0 | 50 | as is basis | on an as is basis without warranties or conditions of any kind either express or implied
apache-1.1 | 90 | apache | apache (?:software )?license version 1 1
apache-1.1 | 90 | apache | spdx license identifier apache 1 1
apache-1.0 | 90 | apache | apache (?:software )?license version 1 0
apache | 30 | apache | apache (?:style|public|software) license
mit | 90 | mit | spdx license identifier mit
mit | 90 | mit | (?:released|licensed|distributed|available) under the (?:terms of the )?mit license
mit | 70 | mit | the mit license(?: mit)?
mit | 50 | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 50 | sublicense | use copy modify merge publish distribute sublicense and or sell copies
mit | 50 | shall be included | the above copyright notice and this permission notice shall be included in all copies
mit | 50 | noninfringement | merchantability fitness for a particular purpose and noninfringement
mit | 30 | mit | license mit
mit | 30 | expat | expat license
mit-0 | 90 | mit | spdx license identifier mit 0
mit-0 | 90 | mit no | mit no attribution
x11 | 90 | x11 | spdx license identifier x11
x11 | 70 | x11 | x11 license
isc | 90 | isc | spdx license identifier isc
isc | 70 | isc | (?:the )?isc license
isc | 50 | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-2-clause | 90 | bsd | spdx license identifier bsd 2 clause
bsd-2-clause | 90 | bsd | (?:simplified|freebsd) bsd license
bsd-2-clause | 90 | clause | (?:bsd 2|2|two) clause (?:bsd )?license
bsd-3-clause | 90 | bsd | spdx license identifier bsd 3 clause
bsd-3-clause | 90 | bsd | (?:modified|revised|new) bsd license
bsd-3-clause | 90 | clause | (?:bsd 3|3|three) clause (?:bsd )?license
bsd-3-clause | 50 | endorse | neither the name of .{1,120} nor the names of its contributors may be used to endorse or promote
bsd-4-clause | 90 | bsd | spdx license identifier bsd 4 clause
bsd-4-clause | 90 | clause | (?:bsd 4|4|four) clause (?:bsd )?license
bsd-4-clause | 50 | advertising materials | all advertising materials mentioning features or use of this software must display
0bsd | 90 | 0bsd | spdx license identifier 0bsd
0bsd | 90 | zero clause | zero clause bsd
bsd | 70 | bsd | (?:the )?bsd (?:style )?license
bsd | 50 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | 50 | redistributions | redistributions of source code must retain the above copyright notice
bsd | 50 | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd | 50 | as is | this software is provided by the (?:copyright holders|author|regents)(?: and contributors)? as is
gpl-1.0 | 90 | gpl | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 90 | general public | gnu general public license version 1
gpl-2.0 | 90 | gpl | spdx license identifier gpl 2 0 only
gpl-2.0 | 90 | gpl | spdx license identifier gpl 2 0(?! or later)
gpl-2.0 | 90 | general public | (?:gnu )?general public license v(?:ersion )?2(?: 0)?(?! or)
gpl-2.0 | 90 | gplv2 | gplv2(?! or)
gpl-2.0 | 90 | gpl | gpl (?:v|version )?2(?: 0)?(?! \d| or)
gpl-2.0-or-later | 90 | gpl | spdx license identifier gpl 2 0 or later
gpl-2.0-or-later | 90 | version 2 of | either version 2 of the license or at your option any later version
gpl-2.0-or-later | 90 | gplv2 | gplv2 or later
gpl-2.0-or-later | 90 | general public | general public license version 2(?: 0)? or (?:any )?later
gpl-3.0 | 90 | gpl | spdx license identifier gpl 3 0(?! or later)
gpl-3.0 | 90 | general public | (?:gnu )?general public license v(?:ersion )?3(?: 0)?(?! or)
gpl-3.0 | 90 | gplv3 | gplv3(?! or)
gpl-3.0 | 90 | gpl | gpl (?:v|version )?3(?: 0)?(?! \d| or)
gpl-3.0-or-later | 90 | gpl | spdx license identifier gpl 3 0 or later
gpl-3.0-or-later | 90 | version 3 of | either version 3 of the license or at your option any later version
gpl-3.0-or-later | 90 | gplv3 | gplv3 or later
gpl-3.0-or-later | 90 | general public | general public license version 3(?: 0)? or (?:any )?later
gpl | 70 | general public | gnu general public license
gpl | 50 | free software | this (?:program|library|file|software) is free software you can redistribute it and or modify it
gpl | 50 | free software foundation | as published by the free software foundation
gpl | 50 | useful but without | in the hope that it will be useful but without any warranty
gpl | 30 | gnu gpl | gnu gpl
lgpl-2.0 | 90 | lgpl | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 90 | library general | gnu library general public license(?: version 2)?
lgpl-2.1 | 90 | lgpl | spdx license identifier lgpl 2 1(?: only)?(?! or later)
lgpl-2.1 | 90 | lesser general | lesser general public license v(?:ersion )?2 1
lgpl-2.1 | 90 | lgplv2 | lgplv2(?: 1)?
lgpl-2.1-or-later | 90 | lgpl | spdx license identifier lgpl 2 1 or later
lgpl-2.1-or-later | 90 | version 2 1 of | either version 2 1 of the license or at your option any later version
lgpl-3.0 | 90 | lgpl | spdx license identifier lgpl 3 0(?: only)?(?! or later)
lgpl-3.0 | 90 | lesser general | lesser general public license v(?:ersion )?3(?: 0)?
lgpl-3.0 | 90 | lgplv3 | lgplv3
lgpl-3.0-or-later | 90 | lgpl | spdx license identifier lgpl 3 0 or later
lgpl | 70 | lesser general | (?:gnu )?lesser general public license
lgpl | 30 | lgpl | (?:gnu )?lgpl
agpl-1.0 | 90 | affero | affero general public license version 1
agpl-3.0 | 90 | agpl | spdx license identifier agpl 3 0(?: only)?(?! or later)
agpl-3.0 | 90 | affero | affero general public license v(?:ersion )?3(?: 0)?
agpl-3.0 | 90 | agplv3 | agplv3
agpl-3.0-or-later | 90 | agpl | spdx license identifier agpl 3 0 or later
agpl | 70 | affero | (?:gnu )?affero general public license
agpl | 30 | agpl | (?:gnu )?agpl
gfdl-1.1 | 90 | gfdl | spdx license identifier gfdl 1 1
gfdl-1.2 | 90 | gfdl | spdx license identifier gfdl 1 2
gfdl-1.2 | 90 | documentation license | free documentation license version 1 2
gfdl-1.3 | 90 | gfdl | spdx license identifier gfdl 1 3
gfdl-1.3 | 90 | documentation license | free documentation license version 1 3
gfdl | 70 | documentation license | gnu free documentation license
gfdl | 50 | invariant sections | with no invariant sections no front cover texts and no back cover texts
mpl-1.0 | 90 | mozilla | mozilla public license version 1 0
mpl-1.1 | 90 | mpl | spdx license identifier mpl 1 1
mpl-1.1 | 90 | mozilla | mozilla public license version 1 1
mpl-2.0 | 90 | mpl | spdx license identifier mpl 2 0
mpl-2.0 | 90 | mozilla | mozilla public license v(?:ersion )?(?: )?2 0
mpl-2.0 | 70 | mozilla | mozilla org mpl 2 0
mpl | 70 | mozilla | mozilla public license
epl-1.0 | 90 | epl | spdx license identifier epl 1 0
epl-1.0 | 90 | eclipse | eclipse public license v(?:ersion )?(?: )?1 0
epl-2.0 | 90 | epl | spdx license identifier epl 2 0
epl-2.0 | 90 | eclipse | eclipse public license v(?:ersion )?(?: )?2 0
epl | 70 | eclipse | eclipse public license
edl-1.0 | 90 | eclipse | eclipse distribution license v(?:ersion )?(?: )?1 0
cddl-1.0 | 90 | cddl | spdx license identifier cddl 1 0
cddl-1.0 | 90 | common development | common development and distribution license version 1 0
cddl-1.1 | 90 | cddl | spdx license identifier cddl 1 1
cddl | 70 | common development | common development and distribution license
cpl-1.0 | 90 | common public | common public license version 1 0
cpl | 70 | common public | common public license
ibm-pl | 70 | ibm | ibm public license
lucent | 70 | lucent | lucent public license
eupl-1.1 | 90 | eupl | spdx license identifier eupl 1 1
eupl-1.2 | 90 | eupl | spdx license identifier eupl 1 2
eupl-1.2 | 90 | european union | european union public licen[cs]e v(?:ersion )?(?: )?1 2
eupl | 70 | european union | european union public licen[cs]e
cecill-2.1 | 90 | cecill | spdx license identifier cecill 2 1
cecill-b | 90 | cecill | cecill b(?: license)?
cecill-c | 90 | cecill | cecill c(?: license)?
cecill | 70 | cecill | cecill (?:free software )?license
artistic-1.0 | 90 | artistic | artistic license 1 0
artistic-2.0 | 90 | artistic | spdx license identifier artistic 2 0
artistic-2.0 | 90 | artistic | artistic license (?:version )?2 0
artistic | 70 | artistic | (?:the )?artistic license
perl | 50 | perl | under the same terms as perl itself
python-2.0 | 90 | python | spdx license identifier python 2 0
psf-2.0 | 90 | psf | spdx license identifier psf 2 0
psf | 70 | python software | python software foundation license
ruby | 70 | ruby | ruby license
php-3.01 | 90 | php | php license version 3 01
php | 70 | php | (?:the )?php license
zlib | 90 | zlib | spdx license identifier zlib
zlib | 70 | zlib | zlib(?: libpng)? license
zlib | 50 | misrepresented | the origin of this software must not be misrepresented
libpng | 70 | libpng | libpng license
bsl-1.0 | 90 | bsl | spdx license identifier bsl 1 0
bsl-1.0 | 90 | boost | boost software license(?: version)? 1 0
bsl-1.0 | 70 | boost | boost software license
busl-1.1 | 90 | busl | spdx license identifier busl 1 1
busl-1.1 | 90 | business source | business source license(?: version)?(?: 1 1)?
unlicense | 90 | unlicense | spdx license identifier unlicense
unlicense | 70 | unlicense | (?:the )?unlicense(?: org)?
unlicense | 50 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 90 | wtfpl | (?:spdx license identifier )?wtfpl
wtfpl | 70 | want to | do what the fuck you want to public license
beerware | 70 | beer | beer ?ware license
public-domain | 70 | public domain | (?:released|placed|dedicated|donated) (?:in)?to the public domain
public-domain | 50 | public domain | (?:is|are) in the public domain
public-domain | 30 | public domain | public domain
cc0-1.0 | 90 | cc0 | spdx license identifier cc0 1 0
cc0-1.0 | 90 | cc0 | cc0 1 0(?: universal)?
cc0-1.0 | 70 | cc0 | cc0
cc0-1.0 | 70 | publicdomain | creativecommons org publicdomain zero
cc-by-1.0 | 90 | cc by | cc by 1 0
cc-by-2.0 | 90 | cc by | cc by 2 0
cc-by-2.5 | 90 | cc by | cc by 2 5
cc-by-3.0 | 90 | cc by | cc by 3 0
cc-by-3.0 | 90 | attribution 3 | creative commons attribution 3 0
cc-by-4.0 | 90 | cc by | cc by 4 0
cc-by-4.0 | 90 | attribution 4 | creative commons attribution 4 0(?: international)?
cc-by-4.0 | 90 | licenses by | creativecommons org licenses by 4 0
cc-by-sa-2.0 | 90 | cc by sa | cc by sa 2 0
cc-by-sa-3.0 | 90 | cc by sa | cc by sa 3 0
cc-by-sa-3.0 | 90 | sharealike 3 | creative commons attribution sharealike 3 0
cc-by-sa-4.0 | 90 | cc by sa | cc by sa 4 0
cc-by-sa-4.0 | 90 | sharealike 4 | creative commons attribution sharealike 4 0
cc-by-sa-4.0 | 90 | licenses by sa | creativecommons org licenses by sa 4 0
cc-by-nd-4.0 | 90 | cc by nd | cc by nd 4 0
cc-by-nd-4.0 | 90 | noderivatives 4 | creative commons attribution noderivatives 4 0
cc-by-nc-3.0 | 90 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | 90 | cc by nc | cc by nc 4 0
cc-by-nc-4.0 | 90 | noncommercial 4 | creative commons attribution noncommercial 4 0
cc-by-nc-sa-3.0 | 90 | cc by nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 90 | cc by nc sa | cc by nc sa 4 0
cc-by-nc-sa-4.0 | 90 | noncommercial sharealike | creative commons attribution noncommercial sharealike 4 0
cc-by-nc-nd-4.0 | 90 | cc by nc nd | cc by nc nd 4 0
cc-by-nc-nd-4.0 | 90 | noncommercial noderivatives | creative commons attribution noncommercial noderivatives 4 0
cc-by-sa | 70 | cc by sa | cc by sa
cc-by-nd | 70 | cc by nd | cc by nd
cc-by-nc-sa | 70 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 70 | cc by nc nd | cc by nc nd
cc-by-nc | 70 | cc by nc | cc by nc
cc-by | 70 | creative commons | creative commons attribution(?: license)?
cc-by | 50 | cc by | cc by
creative-commons | 30 | creative commons | creative commons
odbl-1.0 | 90 | odbl | (?:spdx license identifier )?odbl(?: 1 0)?
odbl-1.0 | 70 | open database | open data(?:base| commons open database) license
odc-by-1.0 | 90 | odc by | (?:spdx license identifier )?odc by(?: 1 0)?
pddl-1.0 | 90 | pddl | (?:spdx license identifier )?pddl(?: 1 0)?
cdla-permissive | 90 | cdla | cdla permissive(?: [12] 0)?
cdla-sharing | 90 | cdla | cdla sharing(?: 1 0)?
ogl-3.0 | 90 | open government | open government licen[cs]e(?: v(?:ersion )?(?: )?3(?: 0)?)?
ofl-1.1 | 90 | ofl | spdx license identifier ofl 1 1
ofl-1.1 | 90 | open font | sil open font license(?: version)?(?: 1 1)?
openrail | 90 | openrail | (?:bigscience |creativeml )?openrail(?: m)?(?: license)?
openrail | 70 | open rail | (?:bigscience |creativeml )?open rail(?: m)?(?: license)?
llama | 70 | llama | llama (?:2 |3 )?community license(?: agreement)?
sspl-1.0 | 90 | sspl | (?:spdx license identifier )?sspl(?: 1 0)?
sspl-1.0 | 70 | server side | server side public license
elastic-2.0 | 90 | elastic | elastic license(?: version)?(?: 2 0)?
commons-clause | 70 | commons clause | commons clause(?: license condition)?
polyform | 70 | polyform | polyform (?:noncommercial|small business|shield|perimeter|strict)(?: license)?
ncsa | 90 | ncsa | (?:spdx license identifier |university of illinois )?ncsa(?: open source license)?
upl-1.0 | 90 | universal permissive | universal permissive license(?: v(?:ersion)?)?(?: 1 0)?
ms-pl | 90 | microsoft public | microsoft public license(?: ms pl)?
ms-rl | 90 | microsoft reciprocal | microsoft reciprocal license(?: ms rl)?
osl-3.0 | 90 | open software | open software license(?: version)?(?: 3 0)?
afl-3.0 | 90 | academic free | academic free license(?: version)?(?: 3 0)?
ecl-2.0 | 90 | educational community | educational community license(?: version)?(?: 2 0)?
w3c | 70 | w3c | w3c software (?:notice and )?license
openssl | 70 | openssl | openssl license
curl | 70 | curl | curl license
postgresql | 70 | postgresql | postgresql license
vim | 70 | vim | vim license
tcl | 70 | tcl | tcl(?: tk)? license
icu | 70 | icu | icu license
unicode | 70 | unicode | unicode(?: inc)? license(?: agreement)?
json | 50 | good not evil | the software shall be used for good not evil
reserved | 70 | all rights | all rights reserved
reserved | 50 | no part of | no part of this (?:publication|book|document|work) may be reproduced
reserved | 50 | written permission | without the (?:prior|express) written permission of
reserved | 50 | written consent | without the (?:prior|express) written consent of
proprietary | 70 | proprietary | proprietary and confidential
proprietary | 50 | unauthorized | unauthorized (?:copying|use|distribution|reproduction) .{0,60}(?:is )?(?:strictly )?prohibited
proprietary | 50 | trade secret | (?:contains|constitutes?) trade secrets?
proprietary | 30 | end user | end user license agreement
copyright | 30 | copyright | copyright (?:c )?(?:19|20)\d\d
copyright | 30 | copyright | copyright (?:c )?by
"""
