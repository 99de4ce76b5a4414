"""Signature rules for licence texts, written by hand.

A line is: tier, label, keyword, pattern. Patterns run over a text's words in lower case with one space between them
(words are runs of ASCII letters and digits and of all non-ASCII characters, so "GPL-3.0" is "gpl 3 0"); they match whole
words. An optional word is written with the space behind it. The keyword is a word that every match holds; the pattern is
tried only on texts that hold it. Tier 1 are identifiers, 2 titles, 3 notices and addresses, 4 hints. Within a tier the
earlier line wins.
"""

RULES = r"""
1 mit spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) mit
1 mit-0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) mit 0
1 x11 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) x11
1 apache-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) apache 1 0
1 apache-1.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) apache 1 1
1 apache-2.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) apache 2 0
1 gpl-1.0-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 1 0 only
1 gpl-1.0-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 1 0 or later
1 gpl-2.0-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 2 0 only
1 gpl-2.0-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 2 0 or later
1 gpl-2.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 2 0
1 gpl-3.0-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 3 0 only
1 gpl-3.0-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 3 0 or later
1 gpl-3.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) gpl 3 0
1 lgpl-2.0-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 2 0 only
1 lgpl-2.0-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 2 0 or later
1 lgpl-2.1-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 2 1 only
1 lgpl-2.1-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 2 1 or later
1 lgpl-2.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 2 1
1 lgpl-3.0-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 3 0 only
1 lgpl-3.0-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 3 0 or later
1 lgpl-3.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) lgpl 3 0
1 agpl-3.0-only spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) agpl 3 0 only
1 agpl-3.0-or-later spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) agpl 3 0 or later
1 agpl-3.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) agpl 3 0
1 bsd-1-clause spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsd 1 clause
1 bsd-2-clause spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsd 2 clause
1 bsd-2-clause-patent spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsd 2 clause patent
1 bsd-3-clause spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsd 3 clause
1 bsd-3-clause-clear spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsd 3 clause clear
1 bsd-4-clause spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsd 4 clause
1 0bsd spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) 0bsd
1 isc spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) isc
1 mpl-1.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) mpl 1 1
1 mpl-2.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) mpl 2 0
1 epl-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) epl 1 0
1 epl-2.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) epl 2 0
1 eupl-1.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) eupl 1 1
1 eupl-1.2 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) eupl 1 2
1 cddl-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cddl 1 0
1 cddl-1.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cddl 1 1
1 cc0-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc0 1 0
1 cc-by-3.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by 3 0
1 cc-by-4.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by 4 0
1 cc-by-sa-3.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by sa 3 0
1 cc-by-sa-4.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by sa 4 0
1 cc-by-nc-4.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by nc 4 0
1 cc-by-nd-4.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by nd 4 0
1 cc-by-nc-sa-4.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by nc sa 4 0
1 cc-by-nc-nd-4.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) cc by nc nd 4 0
1 unlicense spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) unlicense
1 wtfpl spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) wtfpl
1 zlib spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) zlib
1 bsl-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) bsl 1 0
1 artistic-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) artistic 1 0
1 artistic-2.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) artistic 2 0
1 ofl-1.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) ofl 1 1
1 odbl-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) odbl 1 0
1 ms-pl spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) ms pl
1 ms-rl spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) ms rl
1 psf-2.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) (?:psf|python) 2 0
1 postgresql spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) postgresql
1 openssl spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) openssl
1 sspl-1.0 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) sspl 1 0
1 busl-1.1 spdx spdx (?:licen[cs]e |short )?(?:identifier|expression|id) busl 1 1
2 gpl-1.0 gnu gnu general public license (?:version |v )?(?:1|v1)(?: 0)?
2 gpl-2.0-or-later gnu gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:2|v2)(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
2 gpl-2.0 gnu gnu general public license (?:version |v )?(?:2|v2)(?: 0)?
2 gpl-3.0-or-later gnu gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:3|v3)(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
2 gpl-3.0 gnu gnu general public license (?:version |v )?(?:3|v3)(?: 0)?
2 gpl gnu gnu general public license
2 gpl gnu gnu gpl
2 lgpl-2.0 gnu gnu library general public license (?:version |v )?(?:2|v2)(?: 0)?
2 lgpl gnu gnu library general public license
2 lgpl-2.1-or-later gnu gnu lesser general public license (?:version |v )?(?:2|v2) 1 or (?:at your option )?(?:any )?later(?: version)?
2 lgpl-2.1 gnu gnu lesser general public license (?:version |v )?(?:2|v2) 1
2 lgpl-3.0-or-later gnu gnu lesser general public license (?:version |v )?(?:3|v3)(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
2 lgpl-3.0 gnu gnu lesser general public license (?:version |v )?(?:3|v3)(?: 0)?
2 lgpl gnu gnu lesser general public license
2 lgpl gnu gnu lgpl
2 agpl-3.0-or-later gnu gnu affero general public license (?:version |v )?(?:3|v3)(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
2 agpl-3.0 gnu gnu affero general public license (?:version |v )?(?:3|v3)(?: 0)?
2 agpl gnu gnu affero general public license
2 agpl affero affero general public license
2 gfdl-1.1 gnu gnu free documentation license (?:version |v )?1 1
2 gfdl-1.2 gnu gnu free documentation license (?:version |v )?1 2
2 gfdl-1.3 gnu gnu free documentation license (?:version |v )?1 3
2 gfdl gnu gnu free documentation license
2 apache-1.1 apache apache (?:software )?license (?:version |v )?1 1
2 apache-1.0 apache apache (?:software )?license (?:version |v )?1 0
2 apache-2.0 apache apache (?:software )?license (?:version |v )?(?:2|v2)(?: 0)?
2 apache apache apache (?:software |public )?license
2 mit mit (?:the )?mit license
2 mit expat (?:the )?expat license
2 mit-0 attribution mit no attribution(?: license)?
2 x11 x11 (?:mit )?x11 license
2 bsd-2-clause clause (?:bsd )?2 clause (?:bsd )?license
2 bsd-2-clause simplified simplified bsd license
2 bsd-2-clause freebsd freebsd license
2 bsd-3-clause clause (?:bsd )?3 clause (?:bsd )?license
2 bsd-3-clause revised (?:new or )?revised bsd license
2 bsd-3-clause new new bsd license
2 bsd-3-clause modified modified bsd license
2 bsd-3-clause-clear clear clear bsd license
2 bsd-4-clause clause (?:bsd )?4 clause (?:bsd )?license
2 bsd-4-clause original original bsd license
2 0bsd clause (?:zero|0) clause bsd(?: license)?
2 bsd bsd (?:the )?bsd (?:style )?license
2 isc isc (?:the )?isc license
2 mpl-1.0 mozilla mozilla public license (?:version |v )?1 0
2 mpl-1.1 mozilla mozilla public license (?:version |v )?1 1
2 mpl-2.0 mozilla mozilla public license (?:version |v )?(?:2|v2)(?: 0)?
2 mpl mozilla mozilla public license
2 npl netscape netscape public license
2 epl-1.0 eclipse eclipse public license (?:version |v )?1(?: 0)?
2 epl-2.0 eclipse eclipse public license (?:version |v )?2(?: 0)?
2 epl eclipse eclipse public license
2 edl-1.0 eclipse eclipse distribution license
2 cpl-1.0 common common public license
2 ipl-1.0 ibm ibm public license
2 eupl-1.1 european european union public licen[cs]e (?:version |v )?1 1
2 eupl-1.2 european european union public licen[cs]e (?:version |v )?1 2
2 eupl european european union public licen[cs]e
2 cddl-1.0 development common development and distribution license (?:cddl )?(?:version |v )?1 0
2 cddl-1.1 development common development and distribution license (?:cddl )?(?:version |v )?1 1
2 cddl development common development and distribution license
2 cpal-1.0 attribution common public attribution license
2 osl-3.0 open open software license (?:version |v )?3(?: 0)?
2 osl open open software license
2 afl-3.0 academic academic free license (?:version |v )?3(?: 0)?
2 afl academic academic free license
2 ecl-2.0 educational educational community license
2 artistic-1.0 artistic artistic license (?:version |v )?1(?: 0)?
2 artistic-2.0 artistic artistic license (?:version |v )?2(?: 0)?
2 artistic artistic (?:the )?artistic license
2 bsl-1.0 boost boost software license
2 zlib zlib (?:the )?zlib(?: libpng)? license
2 libpng libpng libpng license
2 curl curl (?:the )?curl license
2 openssl openssl openssl license
2 ssleay ssleay ssleay license
2 php-3.01 php php license (?:version |v )?3 01
2 php php php license
2 psf-2.0 python python software foundation license
2 python python python license
2 ruby ruby ruby license
2 tcl tcl tcl tk license
2 vim vim vim license
2 postgresql postgresql postgresql license
2 sleepycat sleepycat sleepycat license
2 w3c w3c w3c software (?:notice and )?license
2 ntp ntp ntp license
2 ncsa ncsa (?:university of illinois )?ncsa (?:open source )?license
2 ms-pl microsoft microsoft public license
2 ms-rl microsoft microsoft reciprocal license
2 apsl apple apple public source license
2 sgi-b sgi sgi free software license
2 sissl sun sun industry standards source license
2 spl-1.0 sun sun public license
2 qpl-1.0 q q public license
2 lppl-1.3 latex latex project public license (?:version |v )?1 3
2 lppl latex latex project public license
2 ofl-1.1 font (?:sil )?open font license (?:version |v )?1 1
2 ofl font (?:sil )?open font license
2 ubuntu-font-1.0 ubuntu ubuntu font licen[cs]e
2 bitstream-vera bitstream bitstream vera (?:fonts )?(?:copyright|license)
2 wtfpl want do what the fuck you want to public license
2 unlicense unlicense (?:the )?unlicense
2 upl-1.0 universal universal permissive license
2 cecill-2.1 cecill cecill (?:free software license agreement )?(?:version |v )?2 1
2 cecill-b cecill cecill b
2 cecill-c cecill cecill c
2 cecill cecill cecill (?:free software )?licen[cs]e
2 odbl-1.0 database open database licen[cs]e
2 odc-by-1.0 commons open data commons attribution license
2 pddl-1.0 dedication (?:open data commons )?public domain dedication and licen[cs]e
2 cdla-permissive-2.0 permissive community data license agreement permissive (?:version )?2 0
2 cdla-permissive community community data license agreement permissive
2 cdla-sharing community community data license agreement sharing
2 ogl-uk-3.0 government open government licen[cs]e (?:version |v )?(?:3|v3)(?: 0)?
2 ogl-uk government open government licen[cs]e
2 etalab etalab etalab open license
2 etalab etalab licence ouverte etalab
2 dl-de-by-2.0 deutschland datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
2 sspl-1.0 server server side public license
2 elastic-2.0 elastic elastic license (?:version |v )?2(?: 0)?
2 elastic elastic elastic license
2 busl-1.1 business business source license
2 commons-clause clause commons clause
2 polyform-noncommercial polyform polyform noncommercial license
2 polyform polyform polyform [a-z]+ license
2 prosperity prosperity prosperity public license
2 confluent confluent confluent community license
2 timescale timescale timescale license
2 parity parity parity public license
2 openrail rail (?:creativeml )?(?:open )?rail(?: m)? license
2 openrail openrail (?:creativeml |bigscience )?openrail(?: m)?
2 llama llama llama (?:2 |3 |3 1 )?community license
2 gemma gemma gemma terms of use
2 json evil (?:software )?shall be used for good not evil
2 beerware beer beer ware license
2 fair fair (?:the )?fair license
2 mulan-psl-2.0 mulan mulan (?:permissive software license|psl) (?:version |v )?(?:2|v2)
2 mulan-psl mulan mulan (?:permissive software license|psl)
2 hpnd historical historical permission notice and disclaimer
2 blueoak-1.0.0 blue blue oak model license
2 unicode unicode unicode (?:license|inc license agreement)
2 icu icu icu license
2 zpl-2.1 zope zope public license (?:version |v )?2 1
2 zpl zope zope public license
2 cern-ohl cern cern open hardware licen[cs]e
2 tapr-ohl tapr tapr open hardware license
2 rpl reciprocal reciprocal public license
2 watcom sybase sybase open watcom public license
2 nasa-1.3 nasa nasa open source agreement
2 intel intel intel open source license
2 lpl lucent lucent public license
2 cc0-1.0 commons creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?
2 cc0-1.0 cc0 cc0(?: 1 0)?(?: universal)?
2 cc-by-nc-nd-4.0 commons creative commons attribution (?:noncommercial|non commercial) (?:noderivs|noderivatives|no derivatives) (?:version )?4 0
2 cc-by-nc-nd commons creative commons attribution (?:noncommercial|non commercial) (?:noderivs|noderivatives|no derivatives)
2 cc-by-nc-sa-4.0 commons creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike) (?:version )?4 0
2 cc-by-nc-sa commons creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike)
2 cc-by-nc-4.0 commons creative commons attribution (?:noncommercial|non commercial) (?:version )?4 0
2 cc-by-nc commons creative commons attribution (?:noncommercial|non commercial)
2 cc-by-nd commons creative commons attribution (?:noderivs|noderivatives|no derivatives)
2 cc-by-sa-4.0 commons creative commons attribution (?:sharealike|share alike) (?:version )?4 0
2 cc-by-sa-3.0 commons creative commons attribution (?:sharealike|share alike) (?:version )?3 0
2 cc-by-sa commons creative commons attribution (?:sharealike|share alike)
2 cc-by-4.0 commons creative commons attribution (?:international |license )?(?:version )?4 0
2 cc-by-3.0 commons creative commons attribution (?:unported |license )?(?:version )?3 0
2 cc-by-2.0 commons creative commons attribution (?:generic |license )?(?:version )?2 0
2 cc-by commons creative commons attribution
2 cc-by-nc-nd-4.0 cc cc by nc nd 4 0
2 cc-by-nc-nd cc cc by nc nd
2 cc-by-nc-sa-4.0 cc cc by nc sa 4 0
2 cc-by-nc-sa cc cc by nc sa
2 cc-by-nc-4.0 cc cc by nc 4 0
2 cc-by-nc cc cc by nc
2 cc-by-nd-4.0 cc cc by nd 4 0
2 cc-by-nd cc cc by nd
2 cc-by-sa-4.0 cc cc by sa 4 0
2 cc-by-sa-3.0 cc cc by sa 3 0
2 cc-by-sa cc cc by sa
2 cc-by-4.0 cc cc by 4 0
2 cc-by-3.0 cc cc by 3 0
2 cc-by-2.0 cc cc by 2 0
2 cc-by cc cc by
3 apache-2.0 apache (?:http |https )?(?:www )?apache org licenses license 2 0(?: txt| html)?
3 apache-1.1 apache (?:http |https )?(?:www )?apache org licenses license 1 1
3 apache apache licensed under the apache license
3 mit opensource (?:http |https )?(?:www )?opensource org licenses mit(?: license)?(?: php)?
3 bsd opensource (?:http |https )?(?:www )?opensource org licenses bsd(?: license| [23] clause)?(?: php)?
3 isc opensource (?:http |https )?(?:www )?opensource org licenses isc(?: license)?
3 gpl gnu (?:http |https )?(?:www )?gnu org (?:licenses|copyleft) gpl(?: html| txt)?
3 lgpl gnu (?:http |https )?(?:www )?gnu org (?:licenses|copyleft) lgpl(?: html| txt)?
3 agpl gnu (?:http |https )?(?:www )?gnu org licenses agpl(?: html| txt)?
3 gpl gnu (?:http |https )?(?:www )?gnu org licenses
3 mpl-2.0 mozilla (?:http |https )?(?:www )?mozilla org mpl 2 0
3 mpl mozilla (?:http |https )?(?:www )?mozilla org mpl
3 epl eclipse (?:http |https )?(?:www )?eclipse org legal epl(?: v10| v20| 2 0)?
3 unlicense unlicense (?:http |https )?(?:www )?unlicense org
3 bsl-1.0 boost (?:http |https )?(?:www )?boost org license 1 0 txt
3 wtfpl wtfpl (?:http |https )?(?:www )?wtfpl net
3 ofl-1.1 sil (?:http |https )?scripts sil org ofl
3 cc0-1.0 creativecommons (?:http |https )?(?:www )?creativecommons org publicdomain zero 1 0
3 cc-pdm creativecommons (?:http |https )?(?:www )?creativecommons org publicdomain mark 1 0
3 cc-by-nc-nd creativecommons (?:http |https )?(?:www )?creativecommons org licenses by nc nd(?: [1-4] [05])?
3 cc-by-nc-sa creativecommons (?:http |https )?(?:www )?creativecommons org licenses by nc sa(?: [1-4] [05])?
3 cc-by-nc creativecommons (?:http |https )?(?:www )?creativecommons org licenses by nc(?: [1-4] [05])?
3 cc-by-nd creativecommons (?:http |https )?(?:www )?creativecommons org licenses by nd(?: [1-4] [05])?
3 cc-by-sa creativecommons (?:http |https )?(?:www )?creativecommons org licenses by sa(?: [1-4] [05])?
3 cc-by creativecommons (?:http |https )?(?:www )?creativecommons org licenses by(?: [1-4] [05])?
3 mit granted permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
3 mit substantial the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
3 isc permission permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
3 hpnd permission permission to use copy modify and distribute this software and its documentation for any purpose
3 bsd redistribution redistribution and use in source and binary forms with or without modification are permitted
3 bsd redistributions redistributions of source code must retain the above copyright notice
3 bsd-3-clause endorse may be used to endorse or promote products derived from this software without specific prior written permission
3 bsd-4-clause advertising all advertising materials mentioning features or use of this software must display the following acknowledge?ment
3 bsl-1.0 organization permission is hereby granted free of charge to any person or organization obtaining a copy of the software
3 zlib misrepresented the origin of this software must not be misrepresented
3 apache-2.0 compliance you may not use this file except in compliance with the license
3 gpl redistribute you can redistribute it and or modify it under the terms of the gnu general public license
3 lgpl redistribute you can redistribute it and or modify it under the terms of the gnu lesser general public license
3 agpl redistribute you can redistribute it and or modify it under the terms of the gnu affero general public license
3 mpl-2.0 source this source code form is subject to the terms of the mozilla public license
3 unlicense unencumbered this is free and unencumbered software released into the public domain
3 wtfpl fuck you just do what the fuck you want to
3 epl accompanying this program and the accompanying materials are made available under the terms of the eclipse public license
3 gpl warranty this program is distributed in the hope that it will be useful but without any warranty
3 gpl-3.0 gplv3 (?:gnu )?gplv3(?: only| or later)?
3 gpl-2.0 gplv2 (?:gnu )?gplv2(?: only| or later)?
3 lgpl-3.0 lgplv3 lgplv3
3 lgpl-2.1 lgplv2 lgplv2 1
3 agpl-3.0 agplv3 agplv3
3 gpl gpl gpl (?:v )?[123](?: 0)?
3 lgpl lgpl lgpl (?:v )?[23](?: [01])?
3 agpl agpl agpl (?:v )?3(?: 0)?
3 mpl mpl mpl (?:v )?[12](?: [01])?
3 mit released released under (?:the )?(?:terms of the )?mit
3 mit licensed licensed under (?:the )?(?:terms of the )?mit
3 mit available available under (?:the )?(?:terms of the )?mit
3 mit distributed distributed under (?:the )?(?:terms of the )?mit
3 bsd bsd (?:released|licen[cs]ed|available|distributed|published|offered|covered) under (?:the |a )?(?:terms of |terms of the )?bsd
3 gpl gpl (?:released|licen[cs]ed|available|distributed|published|offered|covered) under (?:the |a )?(?:terms of |terms of the )?gpl
3 bsd implied this software is provided by (?:the )?(?:copyright holders?|authors?|regents)(?: and contributors)? as is and any express or implied warranties
3 apache-2.0 distributed unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
3 gpl gnu you should have received a copy of the gnu general public license along with (?:this|the) (?:program|software|file|package)
3 lgpl gnu you should have received a copy of the gnu (?:lesser|library) general public license along with (?:this|the) (?:program|software|file|library)
3 agpl gnu you should have received a copy of the gnu affero general public license along with (?:this|the) (?:program|software|file)
3 gfdl gnu permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
3 mpl-2.0 mpl if a copy of the mpl was not distributed with this file you can obtain one at
3 artistic artistic you (?:can|may) (?:re)?distribute (?:it|this package|this program|this module) (?:and or modify it )?under the terms of the artistic license
3 perl perl this (?:library|module|program|package|distribution) is free software you (?:can|may) redistribute it and or modify it under the same terms as perl(?: itself)?
3 python python (?:released|distributed|licen[cs]ed) under the same (?:terms|license) as python(?: itself)?
3 zlib altered altered source versions must be plainly marked as such and must not be misrepresented
3 cc0-1.0 waived to the extent possible under law (?:[a-z0-9]+ ){1,10}has waived all copyright and related or neighbou?ring rights
3 unlicense compile anyone is free to copy modify publish use compile sell or distribute this software
3 beerware retain as long as you retain this notice you can do whatever you want with this stuff
3 creative-commons commons this (?:work|article|document|book|content) is (?:licen[cs]ed|available|published|released) under (?:a |the )?creative commons
3 public-domain copyright (?:the )?authors? (?:hereby )?disclaims? copyright to this source code
3 public-domain copyright no copyright is claimed (?:in|on|for) (?:this|the) (?:work|software|code|file)
3 isc copyright provided that the above copyright notice and this permission notice appear in all copies
3 hpnd copyright provided that the above copyright notice appear in (?:all|supporting) (?:copies|documentation)
3 elastic elastic you may not use this file except in compliance with the elastic license(?: 2 0)?
3 busl-1.1 licensor the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
3 commons-clause sell the license does not grant to you the right to sell the software
3 odbl-1.0 database this (?:[a-z0-9]+ ){0,4}database is made available under the open database licen[cs]e
3 dual dual dual licen[cs]ed under (?:the )?(?:[a-z0-9]+ ){1,6}(?:and|or)
3 public-domain domain (?:dedicated|released|placed) (?:in)?to the public domain
3 public-domain domain this work is in the public domain
3 all-rights-reserved reserved all rights reserved
3 proprietary proprietary proprietary and confidential
3 proprietary proprietary proprietary license
3 proprietary prohibited unauthorized (?:copying|reproduction|use) (?:or )?(?:reproduction|distribution) (?:[a-z0-9]+ ){0,8}prohibited
4 public-domain domain public domain
4 creative-commons commons creative commons
4 copyleft copyleft copyleft
4 gpl gpl gpl
4 lgpl lgpl lgpl
4 agpl agpl agpl
4 free-software software free software
4 open-source source open source (?:software )?licen[cs]e
4 permissive permissive permissive licen[cs]e
4 unknown-license licensed licensed under (?:the )?[a-z0-9]+
4 unknown-license terms under the terms of the (?:[a-z0-9]+ ){1,4}licen[cs]e
4 unknown-license file see (?:the )?(?:accompanying )?license file
""".strip()
