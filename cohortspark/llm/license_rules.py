"""Signature rules for license texts, in order.

A line is: keyword | level | label | pattern. Patterns run over lower-cased words
(ASCII letters and digits, and anything beyond ASCII) with one blank between
them, from the start of a word to the end of one. A rule is only tried on texts
that have one of its keywords (comma-separated) as a word. Levels: 1 an identifier or a sentence that
only this license has, 2 a name with version or a grant under a name, 3 a name
alone, 4 a hint. Earlier rules win where two of a level mark the same words.
"""

from __future__ import annotations

TABLE = """
spdx | 1 | mit | spdx license identifier mit
spdx | 1 | apache | spdx license identifier apache 2 0
spdx | 1 | apache | spdx license identifier apache 1 [01]
spdx | 1 | agpl | spdx license identifier agpl [13] 0( only| or later)?
spdx | 1 | lgpl | spdx license identifier lgpl [23] [01]( only| or later)?
spdx | 1 | gpl | spdx license identifier gpl [123] 0( only| or later)?
spdx | 1 | bsd | spdx license identifier (0|bsd [1234]) ?(clause|bsd)
spdx | 1 | bsd | spdx license identifier 0bsd
spdx | 1 | mpl | spdx license identifier mpl [12] [01]
spdx | 1 | epl | spdx license identifier epl [12] 0
spdx | 1 | eupl | spdx license identifier eupl 1 [012]
spdx | 1 | cddl | spdx license identifier cddl 1 [01]
spdx | 1 | isc | spdx license identifier isc
spdx | 1 | zlib | spdx license identifier zlib
spdx | 1 | bsl | spdx license identifier bsl 1 0
spdx | 1 | busl | spdx license identifier busl 1 1
spdx | 1 | unlicense | spdx license identifier unlicense
spdx | 1 | wtfpl | spdx license identifier wtfpl
spdx | 1 | cc0 | spdx license identifier cc0 1 0
spdx | 1 | cc-by-nc-nd | spdx license identifier cc by nc nd [1234] [05]
spdx | 1 | cc-by-nc-sa | spdx license identifier cc by nc sa [1234] [05]
spdx | 1 | cc-by-nc | spdx license identifier cc by nc [1234] [05]
spdx | 1 | cc-by-nd | spdx license identifier cc by nd [1234] [05]
spdx | 1 | cc-by-sa | spdx license identifier cc by sa [1234] [05]
spdx | 1 | cc-by | spdx license identifier cc by [1234] [05]
spdx | 1 | python | spdx license identifier (python|psf) 2 0
spdx | 1 | postgresql | spdx license identifier postgresql
spdx | 1 | openssl | spdx license identifier openssl
spdx | 1 | artistic | spdx license identifier artistic [12] 0
spdx | 1 | ofl | spdx license identifier ofl 1 [01]
spdx | 1 | odbl | spdx license identifier odbl 1 0
spdx | 1 | x11 | spdx license identifier x11
spdx | 1 | ncsa | spdx license identifier ncsa
spdx | 1 | mulan | spdx license identifier mulanpsl [12] 0
spdx | 1 | upl | spdx license identifier upl 1 0
spdx | 1 | afl | spdx license identifier afl [123] [01]
spdx | 1 | osl | spdx license identifier osl [123] [01]
spdx | 1 | ms-pl | spdx license identifier ms pl
spdx | 1 | ms-rl | spdx license identifier ms rl
spdx | 1 | vim | spdx license identifier vim
spdx | 1 | ruby | spdx license identifier ruby
spdx | 1 | php | spdx license identifier php 3 0[01]?
spdx | 1 | sspl | spdx license identifier sspl 1 0
spdx | 1 | elastic | spdx license identifier elastic 2 0
spdx | 4 | spdx-reference | spdx license identifier licenseref( [^ ]+)?
spdx | 4 | spdx-reference | spdx license identifier
permission | 1 | mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
permission | 1 | isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
permission | 1 | isc | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
permission | 1 | bsl | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
permission | 1 | ofl | permission is hereby granted free of charge to any person obtaining a copy of the font software
permission | 1 | hpnd | permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee
permission | 1 | gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
permission | 1 | zlib | permission is granted to anyone to use this software for any purpose including commercial applications
copying | 1 | all-permissive | copying and distribution of this file with or without modification are permitted in any medium without royalty
permission | 4 | permission-notice | (the above copyright notice and )?this permission notice shall be included in all copies
permission | 4 | all-rights-reserved | without (the )?(prior|express) written permission
redistribution | 1 | bsd | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
redistribution,redistributions | 1 | bsd | redistributions? in binary form must reproduce the above copyright notice this list of conditions
redistribution,redistributions | 1 | bsd | redistributions? of source code must retain the above copyright notice this list of conditions
redistribution | 4 | no-redistribution | redistribution (is )?(strictly )?prohibited
neither | 1 | bsd-3 | neither the name of( the)?( [^ ]+){1,8} nor the names of its contributors may be used to endorse or promote
advertising | 1 | bsd-4 | all advertising materials mentioning features or use of this software must display
unencumbered | 1 | unlicense | this is free and unencumbered software released into the public domain
waived,waiving | 1 | cc0 | has (dedicated the work to the public domain by waiving|waived) all( of)?( his or her| their)?( copyright and related)? rights
provided | 1 | zlib | this software is provided as is without any express or implied warranty
provided | 4 | no-warranty | the software is provided as is without warranty of any kind
provided | 4 | no-warranty | (software|it|program) is provided as is
warranty | 1 | gpl | in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
warranty,warranties | 4 | no-warranty | without warrant(y|ies) (or conditions )?of any kind
warranty | 4 | no-warranty | (absolutely )?no warranty
fuck | 1 | wtfpl | you just do what the fuck you want to
wtfpl | 3 | wtfpl | wtfpl
beerware | 1 | beerware | the beerware license( revision 42)?
beerware | 3 | beerware | beerware
buy | 1 | beerware | you can buy me a beer in return
apache | 1 | apache | you may not use this (file|work) except in compliance with the license you may obtain a copy of the license at http www apache org licenses
apache | 1 | apache | (https? )?(www )?apache org licenses license 2 0( txt| html)?
apache | 2 | apache | licensed under the apache license( version 2 0)?
apache | 2 | apache | apache license version [12] [01]
apache | 2 | apache | apache (software )?license v?2( 0)?
apache | 2 | apache | apache software license version 1 [01]
apache | 3 | apache | apache (software |public )?license
asl | 3 | apache | (under|the) asl( 2 0)?
gnu | 2 | agpl | gnu affero general public license( version| v)? ?3?( 0)?
gnu | 2 | lgpl | gnu (lesser|library) general public license( version| v)? ?[23]?( [01])?
gnu | 2 | gfdl | gnu free documentation license( version)?( 1 [123])?
gnu | 2 | gpl | gnu general public license( as published by the free software foundation)?( either)?( version| v) ?[123]( of the license)?( or at your option any later version)?
gnu | 2 | gpl | gnu general public license
gnu | 2 | gpl | gnu gpl( version| v)? ?[123]?
gnu | 1 | gpl | you should have received a copy of the gnu general public license
gnu | 1 | lgpl | you should have received a copy of the gnu (lesser|library) general public license
gnu | 1 | agpl | you should have received a copy of the gnu affero general public license
gnu | 1 | gpl | (https? )?(www )?gnu org licenses (gpl|old licenses gpl)( [23] 0)?( txt| html)?
gnu | 1 | lgpl | (https? )?(www )?gnu org licenses lgpl( [23] [01])?( txt| html)?
gnu | 1 | agpl | (https? )?(www )?gnu org licenses agpl( 3 0)?( txt| html)?
gnu | 1 | gfdl | (https? )?(www )?gnu org licenses fdl( 1 [123])?( txt| html)?
general | 3 | lgpl | (lesser|library) general public license
general | 3 | agpl | affero general public license
general | 3 | gpl | general public license( version| v)? [123]( [01])?
general | 3 | gpl | general public license
agpl,agpl3 | 2 | agpl | (agpl3|agpl( v)? 3)( 0)?( only| or later)?
agplv3 | 2 | agpl | agplv3( only| or later)?
agpl | 3 | agpl | agpl
lgpl | 2 | lgpl | lgpl (v )?[23]( [01])?( only| or later)?
lgplv2 | 2 | lgpl | lgplv2( 1)?( only| or later)?
lgplv3 | 2 | lgpl | lgplv3( only| or later)?
lgpl | 3 | lgpl | lgpl
gpl | 2 | gpl | gpl (v )?[123]( [01])?( only| or later)?
gplv2 | 2 | gpl | gplv2( only| or later)?
gplv3 | 2 | gpl | gplv3( only| or later)?
gpl | 3 | gpl | (under|the) gpl
mit | 2 | mit | (licensed|released|distributed|available) under (the )?mit( license)?
mit | 2 | mit | (the )?mit license mit
mit | 3 | mit | (the )?mit license
mit | 3 | mit | mit licensed
mit | 3 | mit | mit x11( license)?
mit | 1 | mit | (https? )?(www )?opensource org licenses mit( license)?( php| html)?
opensource | 1 | bsd | opensource org licenses bsd( license| [23] clause)?
opensource | 1 | apache | opensource org licenses apache( 2 0|2 0)?
opensource | 1 | gpl | opensource org licenses gpl( [23] 0| license)?
opensource | 1 | isc | opensource org licenses isc( license)?
opensource | 1 | mpl | opensource org licenses mpl( 2 0| 1 [01])?
opensource | 1 | epl | opensource org licenses epl( [12] 0)?
opensource | 4 | open-source | opensource org licenses( [^ ]+)?
x11 | 3 | x11 | x11 license
expat | 3 | mit | expat license
bsd | 2 | bsd | licensed under (the )?(new |modified |simplified |revised )?bsd( license)?
bsd,freebsd | 2 | bsd-2 | (bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)( license)?
bsd | 2 | bsd-3 | (bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)( license)?
bsd | 2 | bsd-4 | (bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)( license)?
bsd | 2 | 0bsd | (zero clause bsd|0 clause bsd|bsd zero clause)( license)?
bsd | 3 | bsd | bsd (style )?licen[cs]ed?
0bsd | 2 | 0bsd | 0bsd( license)?
mozilla | 1 | mpl | this source code form is subject to the terms of the mozilla public license( v 2 0)?
mozilla | 1 | mpl | (https? )?(www )?mozilla org mpl( 2 0| mpl 1 1 html)?
mozilla | 2 | mpl | mozilla public license( version| v)? [12]( [01])?
mozilla | 3 | mpl | mozilla public license
mpl | 2 | mpl | mpl (v )?[12]( [01])?
eclipse | 1 | epl | (https? )?(www )?eclipse org (legal epl v10 html|legal epl 2 0)
eclipse | 1 | edl | (https? )?(www )?eclipse org org documents edl v10( php)?
eclipse | 2 | epl | eclipse public license( version| v)? [12] 0
eclipse | 3 | epl | eclipse public license
eclipse | 3 | edl | eclipse distribution license
epl | 2 | epl | epl (v )?[12] 0
common | 2 | cddl | common development and distribution license( version)?( 1 [01])?
common | 2 | cpl | common public license( version)?( 1 0)?
common | 2 | cpal | common public attribution license( version)?( 1 0)?
cddl | 2 | cddl | cddl( version)? 1 [01]
cddl | 3 | cddl | cddl
eupl | 2 | eupl | eupl v? ?1 [012]
eupl | 3 | eupl | eupl
european | 3 | eupl | european union public licen[cs]e
european | 2 | eupl | european union public licen[cs]e( version| v)? 1 [012]
isc | 2 | isc | (licensed|released) under (the )?isc( license)?
isc | 3 | isc | isc license
zlib | 3 | zlib | zlib( libpng)? license
libpng | 3 | libpng | libpng license
boost | 1 | bsl | (https? )?(www )?boost org license 1 0( txt)?
boost | 2 | bsl | boost software license( version)? 1 0
boost | 3 | bsl | boost software license
business | 2 | busl | business source license( version)? 1 1
business | 3 | busl | business source license
server | 2 | sspl | server side public license( version)?( 1)?
elastic | 2 | elastic | elastic license( version)? 2 0
elastic | 3 | elastic | elastic license
sspl | 3 | sspl | sspl
unlicense | 1 | unlicense | (https? )?(www )?unlicense org
unlicense | 3 | unlicense | the unlicense
public | 2 | public-domain | (released|placed|dedicated) (in|into|to) the public domain
public | 2 | public-domain | public domain dedication
public | 2 | q-public | q public license( version)?( 1 0)?
public | 2 | ms-pl | microsoft public license
microsoft | 2 | ms-rl | microsoft reciprocal license
public | 2 | lppl | latex project public license( version)?( 1 [0123][abc]?)?
public | 2 | npl | netscape public license( version)?( 1 [01])?
public | 2 | spl | sun public license( version)?( 1 0)?
public | 2 | ibm-pl | ibm public license( version)?( 1 0)?
public | 2 | zpl | zope public license( version)?( [12] [01])?
public | 2 | apsl | apple public source license( version)?( [12] [012])?
public | 2 | rpl | reciprocal public license( version)?( 1 [15])?
mulan | 2 | mulan | mulan (permissive software|public) license( version| v)? ?[12]?
public | 3 | public-domain | (in|into) the public domain
public | 4 | public-license | public licen[cs]e
microsoft | 3 | ms-pl | microsoft permissive license
microsoft | 3 | ms-lpl | microsoft limited public license
creative | 2 | cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(ative)?s( works)?( license)?( [1234] [05])?
creative | 2 | cc-by-nc-sa | creative commons attribution non ?commercial share ?alike( license)?( [1234] [05])?
creative | 2 | cc-by-nc | creative commons attribution non ?commercial( license)?( [1234] [05])?
creative | 2 | cc-by-nd | creative commons attribution no ?deriv(ative)?s( works)?( license)?( [1234] [05])?
creative | 2 | cc-by-sa | creative commons attribution share ?alike( license)?( [1234] [05])?
creative | 2 | cc-by | creative commons attribution( license| [1234] [05])( international| unported)?( license)?
creative | 2 | cc0 | creative commons (zero|cc0)( [^ ]+)?( 1 0)?
creative | 3 | cc | creative commons( license)?
creativecommons | 1 | cc0 | creativecommons org publicdomain zero( 1 0)?
creativecommons | 1 | public-domain | creativecommons org publicdomain mark( 1 0)?
creativecommons | 1 | cc-by-nc-nd | creativecommons org licenses by nc nd( [1234] [05])?
creativecommons | 1 | cc-by-nc-sa | creativecommons org licenses by nc sa( [1234] [05])?
creativecommons | 1 | cc-by-nc | creativecommons org licenses by nc( [1234] [05])?
creativecommons | 1 | cc-by-nd | creativecommons org licenses by nd( [1234] [05])?
creativecommons | 1 | cc-by-sa | creativecommons org licenses by sa( [1234] [05])?
creativecommons | 1 | cc-by | creativecommons org licenses by( [1234] [05])?
cc | 2 | cc-by-nc-nd | cc by nc nd( [1234] [05])?
cc | 2 | cc-by-nc-sa | cc by nc sa( [1234] [05])?
cc | 2 | cc-by-nc | cc by nc( [1234] [05])?
cc | 2 | cc-by-nd | cc by nd( [1234] [05])?
cc | 2 | cc-by-sa | cc by sa( [1234] [05])?
cc | 2 | cc-by | cc by [1234] [05]
cc0 | 2 | cc0 | cc0( 1 0)?( universal)?
open | 2 | odbl | open (data commons open )?database license( v)?( 1 0)?
open | 2 | odc-by | open data commons attribution license( v)?( 1 0)?
open | 2 | pddl | open data commons public domain dedication and license
open | 2 | ogl | open government licen[cs]e( v)?( [123] 0)?
open | 2 | ofl | open font license( version)?( 1 [01])?
open | 2 | osl | open software license( version| v)?( [123] [01])?
open | 4 | open-source | open source licen[cs]e
sil | 2 | ofl | sil open font license( version)?( 1 [01])?
universal | 2 | upl | universal permissive license( version)?( 1 0)?
academic | 2 | afl | academic free license( version| v)?( [123] [01])?
artistic | 2 | artistic | artistic license( version)? [12]( 0)?
artistic | 3 | artistic | artistic license
perl | 2 | perl | under the same terms as perl( itself)?
python | 1 | python | python software foundation license( version)?( 2)?
python,psf | 3 | python | (python license|psf license)
psf | 3 | python | psf license( agreement)?
php | 2 | php | php license( version)?( 3 0[01]?)?
ruby | 3 | ruby | (ruby license|same terms as ruby)
postgresql | 3 | postgresql | postgresql licen[cs]e
openssl | 1 | openssl | this product includes software developed by the openssl project
openssl | 3 | openssl | openssl license
vim | 3 | vim | vim license
tcl | 3 | tcl | tcl tk license
curl | 3 | curl | curl license
ncsa | 2 | ncsa | (university of illinois )?ncsa( open source)? license
w3c | 2 | w3c | w3c software( notice)?( and)?( document)? license
unicode | 2 | unicode | unicode( inc)? license( agreement)?
evil | 1 | json | the software shall be used for good not evil
json | 3 | json | json license
icu | 3 | icu | icu license
intel | 3 | intel | intel open source license
info | 3 | info-zip | info zip license
sleepycat | 3 | sleepycat | sleepycat license
eula | 2 | commercial | eula
end | 2 | commercial | end user licen[cs]e agreement
commercial | 2 | commercial | commercial licen[cs]e
commercial | 2 | non-commercial | (for )?non commercial use only
proprietary | 2 | proprietary | proprietary and confidential
proprietary | 3 | proprietary | proprietary (licen[cs]e|software)
confidential | 4 | proprietary | confidential and proprietary
shareware | 3 | shareware | shareware
freeware | 3 | freeware | freeware
rights | 4 | all-rights-reserved | all rights reserved
copyleft | 4 | copyleft | copyleft
dual | 4 | dual | dual licensed( under)?
licensed | 4 | license-notice | licensed under the
license,licence,copying | 4 | license-notice | see (the )?(accompanying )?(license|licence|copying)( file| txt| md)?( for (more )?(details|information))?
"""

RULES = [(keyword, int(level), label, pattern) for keyword, level, label, pattern in (line.split(" | ") for line in TABLE.strip().splitlines())]
