"""Signature rules for licence texts, notices and tags.

A rule is written for normalised text: lower-case words of letters and digits,
one space between them, so "GPL-3.0-or-later" reads ``gpl 3 0 or later``. Each
line holds the label, the priority (0 to 100, also the confidence), the keywords
and the pattern. The rule is tried on texts with one of its keywords as a whole
word, so every match of the pattern must have one: a keyword for each branch and
for each form that joins words ("gpl2", "gplv 2").
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


RULES_TEXT = """
gpl-1.0 88 gnu gnu general public license(?: as published by the free software foundation)? (?:version|v) 1(?! \\d)
gpl-2.0 90 gnu gnu general public license(?: gpl)?,? (?:version|v) 2(?: 0)?
gpl-2.0 88 gnu version 2(?: 0)? of the gnu general public license
gpl-2.0-or-later 94 gnu gnu general public license(?: as published by the free software foundation)?(?: either)? version 2(?: of the license)? or at your option any later version
gpl-2.0-or-later 93 gnu gnu general public license version 2(?: 0)? or later
gpl-3.0 90 gnu gnu general public license(?: gpl)? (?:version|v) 3(?: 0)?
gpl-3.0 88 gnu version 3(?: 0)? of the gnu general public license
gpl-3.0-or-later 94 gnu gnu general public license(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or at your option any later version
gpl-3.0-or-later 93 gnu gnu general public license version 3(?: 0)? or later
gpl 70 gpl (?:released|licensed|distributed|available|published|covered) under (?:the )?(?:terms of the )?(?:gnu )?gpl
gpl-2.0 86 gpl,gplv,gpl2,gplv2 gpl ?v? ?2(?: 0)?(?: only)?
gpl-2.0-or-later 91 gpl,gplv,gpl2,gplv2 gpl ?v? ?2(?: 0)? or later
gpl-3.0 86 gpl,gplv,gpl3,gplv3 gpl ?v? ?3(?: 0)?(?: only)?
gpl-3.0-or-later 91 gpl,gplv,gpl3,gplv3 gpl ?v? ?3(?: 0)? or later
gpl-2.0 86 gplv2 gplv2(?: 0)?
gpl-2.0-or-later 91 gplv2 gplv2 or (?:any )?later
gpl-3.0 86 gplv3 gplv3(?: 0)?
gpl-3.0-or-later 91 gplv3 gplv3 or (?:any )?later
gpl-2.0 97 spdx spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later 98 spdx spdx license identifier gpl 2 0 or later
gpl-3.0 97 spdx spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later 98 spdx spdx license identifier gpl 3 0 or later
gpl 60 gnu gnu gpl
gpl 80 gnu this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl 75 gnu you should have received a copy of the gnu general public license
gpl-2.0-classpath 95 classpath gnu general public license(?: version 2)?(?: \\w+){0,6} with (?:the )?classpath exception
gpl-gcc-exception 95 gcc gcc runtime library exception(?: version 3 1)?
gpl-autoconf-exception 94 autoconf autoconf (?:configure script )?exception
gpl-bison-exception 94 bison (?:gnu )?bison exception(?: version 2 2)?
gpl-font-exception 94 font gpl(?: \\w+){0,4} font exception
lgpl-2.0 92 gnu gnu library general public license(?: \\w+){0,8} version 2(?: 0)?
lgpl 82 gnu gnu library general public license
lgpl-2.1 92 gnu gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 2 1
lgpl-2.1-or-later 95 gnu gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 2 1(?: of the license)? or (?:at your option )?(?:any )?later
lgpl-3.0 92 gnu gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?
lgpl-3.0-or-later 95 gnu gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or (?:at your option )?(?:any )?later
lgpl 80 gnu gnu lesser general public license
lgpl-2.1 87 lgpl,lgplv,lgpl2,lgplv2 lgpl ?v? ?2 1(?: only)?
lgpl-2.1-or-later 91 lgpl,lgplv,lgpl2,lgplv2 lgpl ?v? ?2 1 or later
lgpl-3.0 87 lgpl,lgplv,lgpl3,lgplv3 lgpl ?v? ?3(?: 0)?(?: only)?
lgpl-3.0-or-later 91 lgpl,lgplv,lgpl3,lgplv3 lgpl ?v? ?3(?: 0)? or later
lgpl-2.1 87 lgplv2 lgplv2(?: 1)?
lgpl-3.0 87 lgplv3 lgplv3
lgpl-2.1 97 spdx spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later 98 spdx spdx license identifier lgpl 2 1 or later
lgpl-3.0 97 spdx spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later 98 spdx spdx license identifier lgpl 3 0 or later
lgpl 65 lgpl (?:under|the|gnu) lgpl
agpl-1.0 90 affero affero general public license version 1
agpl-3.0 92 affero (?:gnu )?affero general public license(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?
agpl-3.0-or-later 95 affero (?:gnu )?affero general public license(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or (?:at your option )?(?:any )?later
agpl 82 affero gnu affero general public license
agpl-3.0 87 agpl,agplv,agpl3,agplv3 agpl ?v? ?3(?: 0)?(?: only)?
agpl-3.0-or-later 91 agpl,agplv,agpl3,agplv3 agpl ?v? ?3(?: 0)? or later
agpl-3.0 87 agplv3 agplv3
agpl-3.0 97 spdx spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later 98 spdx spdx license identifier agpl 3 0 or later
gfdl-1.1 90 documentation gnu free documentation license version 1 1
gfdl-1.2 90 documentation gnu free documentation license version 1 2
gfdl-1.3 90 documentation gnu free documentation license version 1 3
gfdl 80 documentation gnu free documentation license
gfdl-1.3 97 spdx spdx license identifier gfdl 1 3(?: only| or later)?
apache-1.0 90 apache apache(?: software)? license version 1 0
apache-1.1 90 apache apache(?: software)? license version 1 1
apache-2.0 92 apache apache(?: software)? license(?: version| v)? 2(?: 0)?
apache-2.0 90 apache apache 2(?: 0)?(?: license)?
apache-2.0 90 apache (?:released|licensed|distributed|available) under (?:the )?apache(?: license)?(?: version)? 2(?: 0)?
apache-2.0 93 apache licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 96 apache http www apache org licenses license 2 0
apache-2.0 97 spdx spdx license identifier apache 2 0
apache-2.0 88 asl asl 2 0
apache 60 apache apache(?: style)? licen[cs]ed?
apache-2.0-llvm 95 llvm apache(?: license)?(?: v?2 0)? with llvm exceptions?
mit 85 mit (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?mit(?: license)?
mit 75 mit mit licen[cs]ed?
mit 96 permission permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit 84 copyright the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit 88 opensource opensource org licenses mit
mit 97 spdx spdx license identifier mit(?! \\d)
mit-0 97 spdx spdx license identifier mit 0
mit-0 88 mit mit no attribution
mit 70 expat expat license
x11 86 x11 x11 license
x11 86 consortium except as contained in this notice the name of the x consortium shall not be used
bsd-4-clause 92 bsd (?:4|four) clause bsd
bsd-4-clause 90 advertising all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd-4-clause 90 bsd bsd (?:4|four) clause
bsd-4-clause 97 spdx spdx license identifier bsd 4 clause
bsd-3-clause 92 bsd (?:3|three) clause bsd
bsd-3-clause 90 bsd bsd (?:3|three) clause
bsd-3-clause 88 bsd (?:new|revised|modified) bsd license
bsd-3-clause 92 endorse may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause 97 spdx spdx license identifier bsd 3 clause
bsd-3-clause 88 opensource opensource org licenses bsd 3 clause
bsd-3-clause-clear 95 bsd (?:clear bsd|bsd 3 clause clear)
bsd-2-clause 92 bsd (?:2|two) clause bsd
bsd-2-clause 90 bsd bsd (?:2|two) clause
bsd-2-clause 88 bsd (?:simplified|freebsd) bsd license
bsd-2-clause 97 spdx spdx license identifier bsd 2 clause
bsd-2-clause-patent 95 bsd bsd 2 clause(?: plus)? patent
bsd-1-clause 90 bsd (?:1 clause bsd|bsd 1 clause)
0bsd 92 bsd (?:zero clause bsd|bsd zero clause)
0bsd 97 spdx spdx license identifier 0bsd
0bsd 86 0bsd 0bsd
bsd 80 redistribution redistribution and use in source and binary forms with or without modification are permitted
bsd 70 bsd bsd(?: style)? licen[cs]ed?
bsd 72 bsd (?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?bsd
isc 86 isc isc license
isc 92 permission permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 97 spdx spdx license identifier isc
zlib 86 zlib (?:zlib libpng|zlib) license
zlib 92 altered altered source versions must be plainly marked as such
zlib 90 origin the origin of this software must not be misrepresented
zlib 97 spdx spdx license identifier zlib
libpng 86 libpng libpng license(?: version 2)?
mpl-1.0 90 mozilla mozilla public license(?: version| v)? 1 0
mpl-1.1 90 mozilla mozilla public license(?: version| v)? 1 1
mpl-2.0 92 mozilla mozilla public license(?: version| v)? 2 0
mpl-2.0 96 mozilla subject to the terms of the mozilla public license v 2 0
mpl 78 mozilla mozilla public license
mpl-1.1 86 mpl,mplv,mpl1,mplv1 mpl ?v? ?1 1
mpl-2.0 86 mpl,mplv,mpl2,mplv2 mpl ?v? ?2(?: 0)?
mpl-2.0 97 spdx spdx license identifier mpl 2 0
epl-1.0 90 eclipse eclipse public license(?: version| v)? 1 0
epl-2.0 92 eclipse eclipse public license(?: version| v)? 2 0
epl 78 eclipse eclipse public license
edl-1.0 90 eclipse eclipse distribution license(?: version| v)?(?: 1 0)?
epl-1.0 86 epl,eplv,epl1,eplv1 epl ?v? ?1 0
epl-2.0 86 epl,eplv,epl2,eplv2 epl ?v? ?2 0
epl-2.0 97 spdx spdx license identifier epl 2 0
cddl-1.0 90 cddl cddl(?: version| v)?(?: 1 0)?
cddl-1.1 91 cddl cddl(?: version| v)? 1 1
cddl 86 distribution common development and distribution license
cpl-1.0 88 common common public license(?: version 1 0)?
ipl-1.0 88 ibm ibm public license(?: version 1 0)?
eupl-1.1 90 eupl,euplv,eupl1,euplv1 eupl ?v? ?1 1
eupl-1.2 90 eupl,euplv,eupl1,euplv1 eupl ?v? ?1 2
eupl 85 european european union public licen[cs]e
osl-3.0 90 open open software license(?: version| v)? 3 0
osl 76 open open software license
afl-3.0 90 academic academic free license(?: version| v)? 3 0
afl 80 academic academic free license
ecl-2.0 90 educational educational community license(?: version)?(?: 2 0)?
artistic-1.0 90 artistic artistic license(?: version)? 1 0
artistic-2.0 92 artistic artistic license(?: version)? 2 0
artistic 78 artistic (?:the )?artistic license
artistic-2.0 97 spdx spdx license identifier artistic 2 0
artistic-perl 84 perl (?:same|the) terms as perl(?: itself)?
unlicense 90 unlicense (?:the )?unlicense
unlicense 94 unencumbered this is free and unencumbered software released into the public domain
unlicense 97 spdx spdx license identifier unlicense
wtfpl 92 wtfpl wtfpl(?: version 2)?
wtfpl 92 fuck do what the fuck you want to public license
beerware 90 beerware beerware license(?: revision 42)?
beerware 90 beer the beer ware license
bsl-1.0 92 boost boost software license(?: version| v)?(?: 1 0)?
bsl-1.0 97 spdx spdx license identifier bsl 1 0
busl-1.1 92 business business source license(?: version)?(?: 1 1)?
busl-1.1 97 spdx spdx license identifier busl 1 1
sspl-1.0 92 server server side public license(?: version| v)?(?: 1(?: 0)?)?
sspl-1.0 86 sspl,ssplv,sspl1,ssplv1 sspl(?: ?v? ?1(?: 0)?)?
elastic-2.0 92 elastic elastic license(?: version| v)? 2(?: 0)?
elastic 80 elastic elastic license
commons-clause 92 clause commons clause(?: license condition| restriction)?
polyform-noncommercial 90 polyform polyform noncommercial(?: license)?(?: 1 0 0)?
polyform-shield 90 polyform polyform shield(?: license)?(?: 1 0 0)?
polyform 76 polyform polyform
parity 84 parity parity public license(?: \\d)*
ncsa 90 ncsa (?:university of illinois )?(?:ncsa )?open source license ncsa|ncsa(?: open source)? license
psf-2.0 90 python,psf (?:python software foundation|psf) license(?: agreement)?(?: version 2)?
python-2.0 88 python python license(?: 2 0)?
php-3.01 90 php php license(?: version)? 3 01
php-3.0 89 php php license(?: version)? 3 0(?! 1)
php 76 php php license
ruby 84 ruby ruby(?: s)? license
postgresql 90 postgresql postgresql licen[cs]e
openssl 90 openssl openssl license
openssl 92 openssl this product includes software developed by the openssl project
ssleay 88 ssleay (?:original )?ssleay license
openldap-2.8 90 openldap openldap public license(?: version)?(?: 2 8)?
curl 86 curl curl license
ms-pl 90 microsoft microsoft public license
ms-rl 90 microsoft microsoft reciprocal license
ms-pl 84 ms ms pl
ms-rl 84 ms ms rl
apsl-2.0 88 apple apple public source license(?: version)?(?: 2 0)?
qpl-1.0 88 qt,q q public license(?: version 1 0)?|qt public license
sleepycat 88 sleepycat sleepycat(?: public)? license
watcom-1.0 88 watcom sybase open watcom public license
intel 76 intel intel open source license
nasa-1.3 88 nasa nasa open source agreement(?: version)?(?: 1 3)?
w3c 86 w3c w3c(?: software)?(?: notice and)? license
ofl-1.1 92 sil sil open font license(?: version)?(?: 1 1)?
ofl-1.1 90 ofl ofl(?: version)? 1 1
ofl-1.1 97 spdx spdx license identifier ofl 1 1
bitstream-vera 86 bitstream bitstream vera(?: fonts)? (?:copyright|license)
unicode-dfs 88 unicode unicode(?: inc)? license agreement(?: data files and software)?
odbl-1.0 92 database open (?:data commons open )?database license(?: odbl)?(?: v?1 0)?
odbl-1.0 86 odbl,odblv,odbl1,odblv1 odbl(?: ?v? ?1 0)?
odc-by-1.0 92 attribution open data commons attribution license(?: v?1 0)?
odc-by-1.0 86 odc odc by(?: 1 0)?
pddl-1.0 92 pddl pddl(?: 1 0)?
pddl-1.0 92 dedication (?:open data commons )?public domain dedication and license
cdla-permissive 90 cdla cdla permissive(?: \\d 0)?
cdla-sharing 90 cdla cdla sharing(?: 1 0)?
cdla 84 community community data license agreement
ogl-3.0 90 government open government licen[cs]e(?: v?3(?: 0)?)?
etalab-2.0 90 etalab,ouverte (?:etalab(?: open licen[cs]e)?|licence ouverte)(?: 2 0)?
dl-de-by-2.0 90 datenlizenz datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
cc0-1.0 92 cc0 cc0(?: 1 0)?(?: universal)?
cc0-1.0 94 creative creative commons (?:zero|cc0)(?: v?1 0)?(?: universal)?
cc0-1.0 97 spdx spdx license identifier cc0 1 0
cc-pdm-1.0 88 public public domain mark(?: 1 0)?
public-domain 72 public (?:in|into|to) the public domain
cc-by-nc-nd-4.0 94 cc cc by nc nd 4 0
cc-by-nc-nd-3.0 94 cc cc by nc nd 3 0
cc-by-nc-nd-2.0 94 cc cc by nc nd 2 [05]
cc-by-nc-nd 90 cc cc by nc nd
cc-by-nc-sa-4.0 94 cc cc by nc sa 4 0
cc-by-nc-sa-3.0 94 cc cc by nc sa 3 0
cc-by-nc-sa-2.0 94 cc cc by nc sa 2 [05]
cc-by-nc-sa 90 cc cc by nc sa
cc-by-nc-4.0 93 cc cc by nc 4 0
cc-by-nc-3.0 93 cc cc by nc 3 0
cc-by-nc-2.0 93 cc cc by nc 2 [05]
cc-by-nc 88 cc cc by nc
cc-by-nd-4.0 93 cc cc by nd 4 0
cc-by-nd-3.0 93 cc cc by nd 3 0
cc-by-nd 88 cc cc by nd
cc-by-sa-4.0 93 cc cc by sa 4 0
cc-by-sa-3.0 93 cc cc by sa 3 0
cc-by-sa-2.0 93 cc cc by sa 2 [05]
cc-by-sa 88 cc cc by sa
cc-by-4.0 92 cc cc by 4 0
cc-by-3.0 92 cc cc by 3 0
cc-by-2.0 92 cc cc by 2 [05]
cc-by-nc-nd-4.0 95 creative creative commons attribution non ?commercial no ?deriv(?:ative)?s? 4 0
cc-by-nc-nd 91 creative creative commons attribution non ?commercial no ?deriv(?:ative)?s?
cc-by-nc-sa-4.0 95 creative creative commons attribution non ?commercial share ?alike 4 0
cc-by-nc-sa 91 creative creative commons attribution non ?commercial share ?alike
cc-by-nc-4.0 94 creative creative commons attribution non ?commercial 4 0
cc-by-nc 89 creative creative commons attribution non ?commercial
cc-by-nd-4.0 94 creative creative commons attribution no ?deriv(?:ative)?s? 4 0
cc-by-nd 89 creative creative commons attribution no ?deriv(?:ative)?s?
cc-by-sa-4.0 94 creative creative commons attribution share ?alike 4 0
cc-by-sa-3.0 94 creative creative commons attribution share ?alike 3 0
cc-by-sa 89 creative creative commons attribution share ?alike
cc-by-4.0 93 creative creative commons attribution(?: international)? 4 0
cc-by-3.0 93 creative creative commons attribution 3 0
cc-by 86 creative creative commons attribution
cc-by 88 creativecommons creativecommons org licenses by(?= )
cc-by-sa 90 creativecommons creativecommons org licenses by sa
cc-by-nc 90 creativecommons creativecommons org licenses by nc
cc-by-nc-sa 92 creativecommons creativecommons org licenses by nc sa
cc-by-nc-nd 92 creativecommons creativecommons org licenses by nc nd
cc-by-nd 90 creativecommons creativecommons org licenses by nd
cc0-1.0 92 creativecommons creativecommons org publicdomain zero
openrail 88 openrail (?:creativeml )?openrail(?: m)?
rail 80 responsible responsible ai license
llama2 90 llama llama 2 community license(?: agreement)?
llama3 90 llama llama 3(?: \\d)? community license(?: agreement)?
gemma 86 gemma gemma terms of use
json 90 evil the software shall be used for good not evil
proprietary 80 proprietary proprietary and confidential
proprietary 80 unauthorized unauthorized copying of this file(?: via any medium)? is strictly prohibited
all-rights-reserved 62 rights all rights reserved
"""


def _rule(line: str) -> Rule:
    label, priority, keywords, pattern = line.split(" ", 3)
    return Rule(label, int(priority), tuple(keywords.encode().split(b",")), re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])"))


#: In order: of equal detections the earlier rule's stays.
RULES = [_rule(line) for line in RULES_TEXT.strip().splitlines()]
