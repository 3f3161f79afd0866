"""The signature rules of the license scan, one to a line.

A line holds label, rank, confidence, keywords and pattern.  Patterns are over a text's words in
lower case between single spaces, so "Apache-2.0" is ``apache 2 0``.  Rank 1 is a mere name, 2 a
statement that the name applies, 3 the wording of a license or notice, or a tag.  Every match of
a pattern must hold one of its keywords as a whole word.
"""

from __future__ import annotations

#: Wordings that many rules share.
SHARED = {
    "{lic}": "licen[cs]e",
    "{under}": "(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?",
    "{ver}": "(?:version |v)?",
}

RULES = """
mit; 1; 0.7; mit; mit {lic}
mit; 1; 0.7; expat; expat {lic}
mit; 2; 0.95; mit; {under}mit(?: {lic})?
mit; 2; 0.9; mit; {lic} mit
mit; 2; 0.9; mit; mit {lic}d
mit; 3; 0.98; hereby; permission is hereby granted free of charge to any person obtaining a copy
mit; 3; 0.95; sublicense; rights to use copy modify merge publish distribute sublicense and or sell copies
mit; 3; 0.9; portions; (?:this|the above copyright notice and this) permission notice shall be included in all copies or substantial portions
mit; 3; 0.8; noninfringement; warranties of merchantability fitness for a particular purpose and noninfringement
mit; 3; 0.95; opensource; opensource org licenses mit(?: {lic})?
mit-0; 1; 0.8; mit; mit 0(?: {lic})?
mit-0; 1; 0.8; attribution; mit no attribution
x11; 1; 0.7; x11; x11 {lic}
x11; 2; 0.9; x11; {under}x11 {lic}
x11; 3; 0.9; consortium; the name of the x consortium shall not be used in advertising
isc; 1; 0.7; isc; isc {lic}
isc; 2; 0.95; isc; {under}isc(?: {lic})?
isc; 3; 0.95; fee; permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc; 3; 0.85; author; the software is provided as is and the author disclaims all warranties
0bsd; 1; 0.8; 0bsd; 0bsd
0bsd; 1; 0.8; bsd; (?:zero|0) clause bsd
bsd; 1; 0.65; bsd; bsd {lic}
bsd; 1; 0.6; bsd; bsd style
bsd; 2; 0.9; bsd; {under}bsd(?: {lic})?
bsd; 3; 0.95; redistribution; redistribution and use in source and binary forms with or without modification are permitted
bsd; 3; 0.9; redistributions; redistributions of source code must retain the above copyright notice
bsd; 3; 0.9; redistributions; redistributions in binary form must reproduce the above copyright notice
bsd-2-clause; 1; 0.8; bsd; (?:bsd 2 clause|2 clause bsd|bsd two clause|two clause bsd|simplified bsd)(?: {lic})?
bsd-2-clause; 2; 0.9; bsd; {under}(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: {lic})?
bsd-2-clause; 2; 0.9; freebsd; {under}freebsd(?: {lic})?
bsd-2-clause; 1; 0.7; freebsd; freebsd {lic}
bsd-2-clause; 3; 0.9; freebsd; official policies either expressed or implied of the freebsd project
bsd-2-clause; 3; 0.95; opensource; opensource org licenses bsd 2 clause
bsd-3-clause; 1; 0.8; bsd; (?:bsd 3 clause|3 clause bsd|bsd three clause|three clause bsd)(?: {lic})?
bsd-3-clause; 1; 0.8; bsd; (?:new|modified|revised) bsd(?: {lic})?
bsd-3-clause; 2; 0.9; bsd; {under}(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: {lic})?
bsd-3-clause; 3; 0.95; neither; neither the name of .{1,80} nor the names of its contributors
bsd-3-clause; 3; 0.9; endorse; may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause; 3; 0.95; opensource; opensource org licenses bsd 3 clause
bsd-4-clause; 1; 0.8; bsd; (?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: {lic})?
bsd-4-clause; 3; 0.95; advertising; all advertising materials mentioning features or use of this software must display
bsd-4-clause; 2; 0.9; bsd; {under}(?:bsd 4 clause|4 clause bsd|original bsd)(?: {lic})?
apache-1.0; 1; 0.7; apache; apache(?: software)? {lic} {ver}1 0
apache-1.1; 1; 0.8; apache; apache(?: software)?(?: {lic})? {ver}1 1
apache-1.1; 3; 0.9; apache; this product includes software developed by the apache (?:software foundation|group)
apache-2.0; 1; 0.8; apache; apache(?: software)? {lic}(?: version| v)? ?2(?: 0)?
apache-2.0; 1; 0.8; apache; apache {ver}2(?: 0)?(?: {lic})?
apache-2.0; 1; 0.8; apache2; apache2(?: {lic})?
apache-2.0; 1; 0.8; asl; asl 2(?: 0)?
apache-2.0; 2; 0.95; apache apache2; {under}apache(?: software)?(?: {lic})?(?: version| v)? ?2(?: 0)?(?: {lic})?
apache-2.0; 2; 0.95; apache2; {under}apache2(?: {lic})?
apache-2.0; 3; 0.9; compliance; you may not use this file except in compliance with the {lic}
apache-2.0; 3; 0.95; apache; licensed under the apache license version 2 0
apache-2.0; 3; 0.9; apache; you may obtain a copy of the {lic} at https? www apache org licenses
apache-2.0; 3; 0.95; apache; apache org licenses {lic} 2 0
apache-2.0; 3; 0.8; conditions; distributed on an as is basis without warranties or conditions of any kind
apache; 1; 0.6; apache; apache(?: software)? {lic}
apache; 2; 0.8; apache; {under}apache(?: software)? {lic}
gpl; 1; 0.6; gpl; (?:gnu )?gpl {lic}
gpl; 2; 0.8; gpl; {under}(?:gnu )?gpl
gpl; 2; 0.85; gnu; {under}gnu general public {lic}
gpl; 3; 0.95; redistribute; you can redistribute it and or modify it under the terms of the gnu general public {lic}
gpl; 3; 0.9; gnu; you should have received a copy of the gnu general public {lic}
gpl; 3; 0.9; gnu; see the gnu general public {lic} for more details
gpl; 3; 0.95; gnu; gnu org licenses gpl(?: html| txt)?
gpl-1.0; 1; 0.8; gpl; (?:gnu )?gpl {ver}1(?: 0)?(?: only| or later)?
gpl-1.0; 1; 0.8; gplv1; gplv1
gpl-2.0; 1; 0.8; gpl; (?:gnu )?gpl {ver}2(?: 0)?(?: only| or later)?
gpl-2.0; 1; 0.85; gplv2 gpl2; (?:gnu )?(?:gplv2|gpl2)(?: 0)?
gpl-2.0; 2; 0.95; gpl; {under}(?:gnu )?gpl {ver}2(?: 0)?
gpl-2.0; 2; 0.95; gplv2 gpl2; {under}(?:gnu )?(?:gplv2|gpl2)(?: 0)?
gpl-2.0; 2; 0.9; gnu; gnu general public {lic} {ver}2(?: 0)?
gpl-2.0; 3; 0.95; gnu; gnu org licenses (?:old licenses )?gpl 2 0
gpl-2.0; 3; 0.9; gnu; gnu general public {lic} as published by the free software foundation (?:either )?version 2
gpl-3.0; 1; 0.8; gpl; (?:gnu )?gpl {ver}3(?: 0)?(?: only| or later)?
gpl-3.0; 1; 0.85; gplv3 gpl3; (?:gnu )?(?:gplv3|gpl3)(?: 0)?
gpl-3.0; 2; 0.95; gpl; {under}(?:gnu )?gpl {ver}3(?: 0)?
gpl-3.0; 2; 0.95; gplv3 gpl3; {under}(?:gnu )?(?:gplv3|gpl3)(?: 0)?
gpl-3.0; 2; 0.9; gnu; gnu general public {lic} {ver}3(?: 0)?
gpl-3.0; 3; 0.95; gnu; gnu org licenses gpl 3 0
gpl-3.0; 3; 0.9; gnu; gnu general public {lic} as published by the free software foundation (?:either )?version 3
lgpl; 1; 0.7; lgpl; (?:gnu )?lgpl(?: {lic})?
lgpl; 1; 0.8; lesser; (?:gnu )?lesser general public {lic}
lgpl; 1; 0.8; library; (?:gnu )?library general public {lic}
lgpl; 2; 0.85; lesser; {under}(?:gnu )?lesser general public {lic}
lgpl; 3; 0.95; redistribute; you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public {lic}
lgpl; 3; 0.9; lesser; you should have received a copy of the gnu lesser general public {lic}
lgpl-2.0; 1; 0.85; lgpl; (?:gnu )?lgpl {ver}2 0
lgpl-2.1; 1; 0.85; lgpl; (?:gnu )?lgpl {ver}2 1(?: only| or later)?
lgpl-2.1; 1; 0.85; lgplv2 lgpl2; (?:gnu )?(?:lgplv2|lgpl2) 1
lgpl-2.1; 2; 0.95; lgpl; {under}(?:gnu )?lgpl {ver}2 1
lgpl-2.1; 2; 0.95; lgplv2 lgpl2; {under}(?:gnu )?(?:lgplv2|lgpl2) 1
lgpl-2.1; 2; 0.9; lesser; (?:gnu )?lesser general public {lic} {ver}2 1
lgpl-3.0; 1; 0.85; lgpl; (?:gnu )?lgpl {ver}3(?: 0)?(?: only| or later)?
lgpl-3.0; 1; 0.85; lgplv3 lgpl3; (?:gnu )?(?:lgplv3|lgpl3)(?: 0)?
lgpl-3.0; 2; 0.95; lgpl; {under}(?:gnu )?lgpl {ver}3(?: 0)?
lgpl-3.0; 2; 0.95; lgplv3 lgpl3; {under}(?:gnu )?(?:lgplv3|lgpl3)(?: 0)?
lgpl-3.0; 2; 0.9; lesser; (?:gnu )?lesser general public {lic} {ver}3(?: 0)?
agpl-3.0; 1; 0.8; agpl; (?:gnu )?agpl(?: {ver}3(?: 0)?)?(?: only| or later)?
agpl-3.0; 1; 0.85; agplv3 agpl3; (?:gnu )?(?:agplv3|agpl3)(?: 0)?
agpl-3.0; 1; 0.85; affero; (?:gnu )?affero general public {lic}(?: {ver}3(?: 0)?)?
agpl-3.0; 2; 0.95; agpl; {under}(?:gnu )?agpl(?: {ver}3(?: 0)?)?
agpl-3.0; 2; 0.95; agplv3 agpl3; {under}(?:gnu )?(?:agplv3|agpl3)(?: 0)?
agpl-3.0; 3; 0.95; affero; under the terms of the gnu affero general public {lic}
agpl-3.0; 3; 0.9; network; users interacting with it remotely through a computer network
mpl; 1; 0.7; mozilla; mozilla public {lic}
mpl-1.0; 1; 0.85; mozilla; mozilla public {lic} {ver}1 0
mpl-1.1; 1; 0.85; mozilla; mozilla public {lic} {ver}1 1
mpl-1.1; 1; 0.8; mpl; mpl {ver}1 1
mpl-1.1; 3; 0.9; mozilla; the contents of this file are subject to the mozilla public {lic} version 1 1
mpl-2.0; 1; 0.85; mozilla; mozilla public {lic} {ver}2(?: 0)?
mpl-2.0; 1; 0.8; mpl; mpl {ver}2(?: 0)?
mpl-2.0; 1; 0.8; mpl2 mplv2; (?:mpl2|mplv2)(?: 0)?
mpl-2.0; 2; 0.95; mozilla; {under}mozilla public {lic}(?: {ver}2(?: 0)?)?
mpl-2.0; 3; 0.95; mozilla; this source code form is subject to the terms of the mozilla public {lic}
mpl-2.0; 3; 0.95; mozilla; mozilla org mpl 2 0
epl-1.0; 1; 0.85; eclipse; eclipse public {lic} {ver}1(?: 0)?
epl-2.0; 1; 0.85; eclipse; eclipse public {lic} {ver}2(?: 0)?
epl; 1; 0.7; eclipse; eclipse public {lic}
epl; 2; 0.9; eclipse; {under}eclipse public {lic}
epl-2.0; 3; 0.9; eclipse; eclipse org legal epl 2 0
epl-1.0; 3; 0.9; eclipse; eclipse org legal epl v10
edl-1.0; 1; 0.85; eclipse; eclipse distribution {lic}(?: {ver}1 0)?
cddl-1.0; 1; 0.85; cddl; cddl(?: {ver}1 0)?
cddl-1.1; 1; 0.85; cddl; cddl {ver}1 1
cddl-1.0; 1; 0.85; development; common development and distribution {lic}
cddl-1.0; 2; 0.9; cddl; {under}cddl
cpl-1.0; 1; 0.8; common; common public {lic}(?: {ver}1 0)?
cpal-1.0; 1; 0.85; attribution; common public attribution {lic}
ipl-1.0; 1; 0.85; ibm; ibm public {lic}(?: {ver}1 0)?
apsl-2.0; 1; 0.85; apple; apple public source {lic}(?: {ver}2 0)?
apsl-2.0; 3; 0.9; apple; subject to the apple public source {lic}
spl-1.0; 1; 0.85; sun; sun public {lic}
npl-1.1; 1; 0.85; netscape; netscape public {lic}
eupl-1.1; 1; 0.85; eupl; eupl {ver}1 1
eupl-1.2; 1; 0.85; eupl; eupl {ver}1 2
eupl; 1; 0.8; eupl; eupl
eupl; 1; 0.85; european; european union public {lic}(?: {ver}1 [012])?
eupl; 2; 0.9; eupl; {under}eupl
cecill-2.1; 1; 0.85; cecill; cecill(?: {ver}2 1)?
cecill-b; 1; 0.85; cecill; cecill b
cecill-c; 1; 0.85; cecill; cecill c
artistic-1.0; 1; 0.85; artistic; artistic {lic} {ver}1 0
artistic-2.0; 1; 0.85; artistic; artistic {lic} {ver}2 0
artistic; 1; 0.75; artistic; artistic {lic}
artistic; 2; 0.9; artistic; {under}artistic {lic}
perl; 2; 0.9; perl; under the same terms as perl(?: itself)?
perl; 2; 0.9; perl; same {lic} as perl
zlib; 1; 0.75; zlib; zlib {lic}
zlib; 2; 0.9; zlib; {under}zlib(?: {lic})?
zlib; 3; 0.95; altered; altered source versions must be plainly marked as such
zlib; 3; 0.9; origin; the origin of this software must not be misrepresented
zlib-libpng; 1; 0.8; libpng; (?:zlib )?libpng {lic}
libpng-2.0; 1; 0.8; libpng png; png reference library {lic} version 2|libpng {lic} version 2
libtiff; 1; 0.8; libtiff; libtiff {lic}
ijg; 1; 0.85; jpeg; independent jpeg group {lic}
ijg; 3; 0.9; jpeg; this software is based in part on the work of the independent jpeg group
bzip2-1.0.6; 1; 0.8; bzip2; bzip2 {lic}
curl; 1; 0.75; curl; curl {lic}
boost-1.0; 1; 0.85; boost; boost software {lic}(?: {ver}1 0)?
boost-1.0; 1; 0.8; bsl; bsl 1 0
boost-1.0; 3; 0.95; boost; distributed under the boost software {lic} version 1 0
boost-1.0; 3; 0.95; boost; boost org {lic} 1 0 txt
unlicense; 1; 0.8; unlicense; (?:the )?unlicense
unlicense; 2; 0.95; unlicense; {under}unlicense
unlicense; 3; 0.95; unencumbered; this is free and unencumbered software released into the public domain
unlicense; 3; 0.95; unlicense; unlicense org
wtfpl; 1; 0.85; wtfpl; wtfpl(?: {ver}2)?
wtfpl; 3; 0.95; fuck; do what the fuck you want to public {lic}
beerware; 1; 0.8; beerware; beerware {lic}|beerware
beerware; 1; 0.8; beer; beer ware {lic}
beerware; 3; 0.95; beer; you can buy me a beer in return
public-domain; 2; 0.7; domain; (?:in|into) the public domain
public-domain; 3; 0.9; domain; (?:dedicated|released|placed) (?:to|into|in) the public domain
public-domain; 2; 0.85; domain; public domain dedication
python-2.0; 1; 0.8; python; python software foundation {lic}(?: {ver}2)?
python-2.0; 1; 0.8; psf; psf {lic}(?: {ver}2)?
python-2.0; 3; 0.9; python; this {lic} agreement is between the python software foundation
cnri-python; 1; 0.8; cnri; cnri (?:python )?{lic}
postgresql; 1; 0.8; postgresql; postgresql {lic}
postgresql; 3; 0.9; california; in no event shall the university of california be liable to any party
openssl; 1; 0.8; openssl; openssl {lic}
openssl; 3; 0.95; openssl; this product includes software developed by the openssl project
ssleay; 3; 0.9; young; this product includes cryptographic software written by eric young
php-3.0; 1; 0.85; php; php {lic} {ver}3 0
php-3.01; 1; 0.85; php; php {lic} {ver}3 01
php; 1; 0.75; php; php {lic}
php-3.01; 3; 0.9; php; this source file is subject to version 3 01 of the php {lic}
ruby; 1; 0.75; ruby; ruby {lic}|ruby s {lic}
ncsa; 1; 0.85; ncsa; (?:university of illinois )?ncsa(?: open source)? {lic}
ncsa; 3; 0.9; illinois; university of illinois at urbana champaign nor the names of its contributors
upl-1.0; 1; 0.85; universal; universal permissive {lic}(?: {ver}1 0)?
ms-pl; 1; 0.85; microsoft; microsoft public {lic}
ms-pl; 1; 0.8; ms; ms pl
ms-rl; 1; 0.85; microsoft; microsoft reciprocal {lic}
ms-rl; 1; 0.8; ms; ms rl
ms-lpl; 1; 0.8; microsoft; microsoft limited public {lic}
osl-3.0; 1; 0.85; osl; osl(?: {ver}3 0)?
osl-3.0; 1; 0.85; open; open software {lic}(?: {ver}3 0)?
afl-3.0; 1; 0.85; academic; academic free {lic}(?: {ver}3 0)?
ecl-2.0; 1; 0.85; educational; educational community {lic}(?: {ver}2 0)?
sleepycat; 1; 0.8; sleepycat; sleepycat {lic}
qpl-1.0; 1; 0.85; qpl; qpl(?: 1 0)?
qpl-1.0; 1; 0.85; q; q public {lic}(?: {ver}1 0)?
vim; 1; 0.8; vim; vim {lic}
w3c; 1; 0.85; w3c; w3c software(?: notice and)? {lic}
unicode; 1; 0.85; unicode; unicode (?:inc )?{lic} agreement|unicode {lic}
icu; 1; 0.8; icu; icu {lic}
intel; 1; 0.7; intel; intel open source {lic}|intel simplified software {lic}
nasa-1.3; 1; 0.85; nasa; nasa open source agreement(?: {ver}1 3)?
nvidia; 1; 0.75; nvidia; nvidia (?:software|source code) {lic}
sissl; 1; 0.85; sissl; sissl
sissl; 1; 0.85; sun; sun industry standards source {lic}
lppl-1.3c; 1; 0.85; latex; latex project public {lic}(?: {ver}1 3c?)?
lppl-1.3c; 1; 0.85; lppl; lppl(?: {ver}1 3c?)?
ofl-1.1; 1; 0.85; ofl; (?:sil )?ofl(?: {ver}1 1)?
ofl-1.1; 1; 0.9; sil; sil open font {lic}(?: {ver}1 1)?
ofl-1.1; 3; 0.9; font; this font software is licensed under the sil open font {lic}
ofl-1.1; 3; 0.9; scripts; scripts sil org ofl
gfdl; 1; 0.85; gfdl; (?:gnu )?gfdl(?: 1 [123])?
gfdl; 1; 0.85; documentation; (?:gnu )?free documentation {lic}(?: {ver}1 [123])?
gfdl; 3; 0.95; invariant; with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
odbl-1.0; 1; 0.85; odbl; odbl(?: {ver}1 0)?
odbl-1.0; 1; 0.85; database; open database {lic}
odbl-1.0; 3; 0.9; openstreetmap; openstreetmap contributors
odc-by; 1; 0.85; odc; odc (?:by|attribution)(?: {lic})?
odc-by; 1; 0.85; commons; open data commons attribution {lic}
pddl; 1; 0.85; pddl; pddl
pddl; 1; 0.85; dedication; public domain dedication and {lic}
cdla-permissive; 1; 0.85; cdla; cdla permissive(?: [12] 0)?
cdla-sharing; 1; 0.85; cdla; cdla sharing(?: 1 0)?
ogl; 1; 0.85; government; open government {lic}(?: {ver}[123] 0)?
etalab; 1; 0.85; ouverte; licence ouverte
cc0; 1; 0.85; cc0; cc0(?: 1 0)?(?: universal)?
cc0; 2; 0.95; cc0; {under}(?:creative commons )?cc0
cc0; 3; 0.95; waived; has waived all copyright and related(?: or neighboring rights)?
cc0; 3; 0.95; zero; creativecommons org publicdomain zero 1 0
cc-pdm; 3; 0.9; mark; creativecommons org publicdomain mark 1 0
cc-by; 1; 0.8; cc; cc by(?: [1234] 0)?
cc-by; 1; 0.85; attribution; creative commons attribution(?: [1234] 0)?(?: international| unported| generic)?(?: {lic})?
cc-by; 2; 0.9; cc; {under}cc by(?: [1234] 0)?
cc-by; 3; 0.95; creativecommons; creativecommons org licenses by [1234] 0
cc-by-sa; 1; 0.85; cc; cc by sa(?: [1234] 0)?
cc-by-sa; 1; 0.9; sharealike; (?:creative commons )?attribution sharealike(?: [1234] 0)?
cc-by-sa; 1; 0.9; alike; (?:creative commons )?attribution share alike(?: [1234] 0)?
cc-by-sa; 2; 0.9; cc; {under}cc by sa(?: [1234] 0)?
cc-by-sa; 3; 0.95; creativecommons; creativecommons org licenses by sa [1234] 0
cc-by-nc; 1; 0.85; cc; cc by nc(?: [1234] 0)?
cc-by-nc; 1; 0.9; noncommercial; (?:creative commons )?attribution noncommercial(?: [1234] 0)?
cc-by-nc; 1; 0.9; commercial; (?:creative commons )?attribution non commercial(?: [1234] 0)?
cc-by-nc; 3; 0.95; creativecommons; creativecommons org licenses by nc [1234] 0
cc-by-nd; 1; 0.85; cc; cc by nd(?: [1234] 0)?
cc-by-nd; 1; 0.9; noderivatives noderivs; (?:creative commons )?attribution (?:noderivatives|noderivs)(?: [1234] 0)?
cc-by-nd; 3; 0.95; creativecommons; creativecommons org licenses by nd [1234] 0
cc-by-nc-sa; 1; 0.9; cc; cc by nc sa(?: [1234] 0)?
cc-by-nc-sa; 1; 0.9; sharealike; (?:creative commons )?attribution noncommercial sharealike(?: [1234] 0)?
cc-by-nc-sa; 3; 0.95; creativecommons; creativecommons org licenses by nc sa [1234] 0
cc-by-nc-nd; 1; 0.9; cc; cc by nc nd(?: [1234] 0)?
cc-by-nc-nd; 1; 0.9; noderivatives noderivs; (?:creative commons )?attribution noncommercial (?:noderivatives|noderivs)(?: [1234] 0)?
cc-by-nc-nd; 3; 0.95; creativecommons; creativecommons org licenses by nc nd [1234] 0
creative-commons; 1; 0.6; commons; creative commons(?: {lic})?
creative-commons; 2; 0.7; creativecommons; creativecommons org
openrail; 1; 0.85; openrail; (?:creativeml )?openrail(?: m)?
openrail; 1; 0.8; rail responsible; responsible ai {lic}|open rail {lic}|rail {lic}
llama; 1; 0.85; llama; llama [23](?: [1-3])? community {lic}
gemma; 1; 0.8; gemma; gemma terms of use
bsl-1.1; 1; 0.85; business; business source {lic}(?: {ver}1 1)?
sspl-1.0; 1; 0.85; sspl; sspl(?: {ver}1 0)?
sspl-1.0; 1; 0.85; server; server side public {lic}(?: {ver}1 0)?
elastic-2.0; 1; 0.85; elastic; elastic {lic}(?: {ver}2 0)?
commons-clause; 1; 0.85; clause; commons clause(?: {lic} condition)?
polyform; 1; 0.85; polyform; polyform (?:noncommercial|shield|strict|perimeter|internal use|small business)(?: {lic})?
jsr; 3; 0.85; evil; the software shall be used for good not evil
copyright; 2; 0.5; copyright; copyright (?:c )?(?:19|20)[0-9]{2}
copyright; 2; 0.5; copyright; copyright ©
copyright; 2; 0.5; ©; © (?:19|20)[0-9]{2}
proprietary; 2; 0.9; confidential; proprietary and confidential|confidential and proprietary
proprietary; 2; 0.85; proprietary; proprietary {lic}
proprietary; 3; 0.85; unauthorized unauthorised; (?:unauthorized|unauthorised) (?:copying|use|reproduction|distribution)
proprietary; 3; 0.85; trade; (?:contains|constitutes) trade secrets of
proprietary; 2; 0.8; eula; end user {lic} agreement eula|eula
proprietary; 2; 0.8; end; end user {lic} agreement
no-reuse; 3; 0.9; reproduced; no part of this .{1,60} may be reproduced
no-reuse; 3; 0.85; redistribute; do not (?:copy or )?redistribute
permission-needed; 3; 0.8; permission; without (?:the )?(?:prior |express )?(?:written )?permission
permission-needed; 3; 0.8; consent; without (?:the )?(?:prior |express )?(?:written )?consent
reused; 2; 0.7; permission; (?:reprinted|used|reproduced) (?:with|by) permission
noncommercial; 2; 0.8; commercial; (?:for )?non commercial (?:use|purposes) only
noncommercial; 2; 0.8; noncommercial; (?:for )?noncommercial (?:use|purposes) only
personal-use; 2; 0.8; personal; for personal use only
research-only; 2; 0.8; research; for (?:academic |scientific )?research (?:use|purposes) only
evaluation-only; 2; 0.8; evaluation; for evaluation (?:use|purposes) only
dual; 2; 0.6; dual; dual licen[cs]ed
patent-grant; 2; 0.6; patent; grants? of patent {lic}|patent grant
"""

#: Identifiers of the public license list, as files spell them after "SPDX-License-Identifier:".
IDENTIFIERS = """
0BSD AFL-2.1 AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later APSL-2.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0
BSD-2-Clause BSD-3-Clause BSD-4-Clause BSD-3-Clause-Clear BSL-1.0 BUSL-1.1 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0
CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1
CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-2.1 CECILL-B CECILL-C CPAL-1.0 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2
Elastic-2.0 GFDL-1.3 GFDL-1.3-or-later GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later IJG IPL-1.0
ISC ICU Intel LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later
LPPL-1.3c Libpng MIT MIT-0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NASA-1.3 NCSA NPL-1.1 ODC-By-1.0 ODbL-1.0
OFL-1.1 OLDAP-2.8 OSL-3.0 OpenSSL PDDL-1.0 PHP-3.0 PHP-3.01 PSF-2.0 PostgreSQL Python-2.0 QPL-1.0 Ruby SISSL SPL-1.0 SSPL-1.0 Sleepycat
UPL-1.0 Unlicense Vim W3C WTFPL X11 Zlib blessing bzip2-1.0.6 curl zlib-acknowledgement
"""
