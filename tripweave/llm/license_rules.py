r"""The signature rules of the licence scan: names, tags, addresses and typical sentences of licences.

Written by hand. A blank in a pattern stands for any run of characters that are neither letters nor
digits; texts are matched in lower case (A-Z).
"""

from __future__ import annotations

# (label, spelling of the name, tags in headers, addresses)
NAMES: list[tuple[str, str, str, str]] = [
    ("agpl-1.0", r"affero general public licen[cs]e version 1", r"agpl-1\.0(?:-only|-or-later)?", r"affero\.org/oagpl"),
    ("agpl-3.0", r"(?:gnu )?affero general public licen[cs]e(?: (?:version|v) ?3)?", r"agpl-3\.0(?:-only|-or-later)?", r"gnu\.org/licenses/agpl"),
    ("gpl-1.0", r"gnu general public licen[cs]e(?: as published by the free software foundation)? (?:version|v) ?1", r"gpl-1\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", r"gnu general public licen[cs]e(?: as published by the free software foundation)? (?:version|v) ?2", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", r"gnu general public licen[cs]e(?: as published by the free software foundation)? (?:version|v) ?3", r"gpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl-2.0", r"gnu library general public licen[cs]e(?: (?:version|v) ?2)?", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/old-licenses/lgpl-2\.0"),
    ("lgpl-2.1", r"gnu lesser general public licen[cs]e (?:version|v) ?2 1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", r"gnu lesser general public licen[cs]e (?:version|v) ?3", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl-3\.0"),
    ("gfdl-1.1", r"gnu free documentation licen[cs]e (?:version|v) ?1 1", r"gfdl-1\.1(?:-only|-or-later)?", r"gnu\.org/licenses/(?:old-licenses/)?fdl-1\.1"),
    ("gfdl-1.2", r"gnu free documentation licen[cs]e (?:version|v) ?1 2", r"gfdl-1\.2(?:-only|-or-later)?", r"gnu\.org/licenses/(?:old-licenses/)?fdl-1\.2"),
    ("gfdl-1.3", r"gnu free documentation licen[cs]e(?: (?:version|v) ?1 3)?", r"gfdl-1\.3(?:-only|-or-later)?", r"gnu\.org/licenses/fdl"),
    ("apache-1.0", r"apache (?:software )?licen[cs]e (?:version|v) ?1 0", r"apache-1\.0", r"apache\.org/licenses/license-1\.0"),
    ("apache-1.1", r"apache (?:software )?licen[cs]e (?:version|v) ?1 1", r"apache-1\.1", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", r"apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)?", r"apache-2\.0", r"apache\.org/licenses/license-2\.0"),
    ("mit", r"(?:the )?(?:mit|expat) licen[cs]e", r"mit", r"opensource\.org/licen[cs]es/mit"),
    ("mit-0", r"mit no attribution(?: licen[cs]e)?", r"mit-0", r"github\.com/aws/mit-0"),
    ("x11", r"x11 licen[cs]e", r"x11", r"xfree86\.org/3\.3\.6/copyright2"),
    ("isc", r"isc licen[cs]e", r"isc", r"opensource\.org/licen[cs]es/isc"),
    ("0bsd", r"(?:bsd zero clause|zero clause bsd|0 ?bsd) licen[cs]e", r"0bsd", r"opensource\.org/licen[cs]es/0bsd"),
    ("bsd-1-clause", r"(?:1|one) clause bsd licen[cs]e", r"bsd-1-clause", r"opensource\.org/licen[cs]es/bsd-1-clause"),
    ("bsd-2-clause", r"(?:simplified bsd|freebsd|bsd (?:2|two) clause|(?:2|two) clause bsd) licen[cs]e", r"bsd-2-clause", r"opensource\.org/licen[cs]es/bsd-2-clause"),
    ("bsd-3-clause", r"(?:new bsd|modified bsd|revised bsd|bsd (?:3|three) clause|(?:3|three) clause bsd) licen[cs]e", r"bsd-3-clause", r"opensource\.org/licen[cs]es/bsd-3-clause"),
    ("bsd-4-clause", r"(?:original bsd|bsd (?:4|four) clause|(?:4|four) clause bsd) licen[cs]e", r"bsd-4-clause", r"directory\.fsf\.org/wiki/license:bsd_4clause"),
    ("bsd-2-clause-patent", r"bsd (?:2 clause )?plus patents? licen[cs]e", r"bsd-2-clause-patent", r"opensource\.org/licen[cs]es/bsdpluspatent"),
    ("mpl-1.0", r"mozilla public licen[cs]e (?:version|v) ?1 0", r"mpl-1\.0", r"mozilla\.org/mpl/mpl-1\.0"),
    ("mpl-1.1", r"mozilla public licen[cs]e (?:version|v) ?1 1", r"mpl-1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", r"mozilla public licen[cs]e (?:(?:version|v) ?)?2 0", r"mpl-2\.0", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl-1.0", r"eclipse public licen[cs]e (?:(?:version|v) ?)?1 0", r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"eclipse public licen[cs]e (?:(?:version|v) ?)?2 0", r"epl-2\.0", r"eclipse\.org/legal/epl-2\.0"),
    ("cpl-1.0", r"common public licen[cs]e (?:version|v) ?1 0", r"cpl-1\.0", r"opensource\.org/licen[cs]es/cpl1\.0"),
    ("ipl-1.0", r"ibm public licen[cs]e (?:version|v) ?1 0", r"ipl-1\.0", r"opensource\.org/licen[cs]es/ipl-1\.0"),
    ("cddl-1.0", r"common development and distribution licen[cs]e(?: (?:version|v) ?1 0)?", r"cddl-1\.0", r"opensource\.org/licen[cs]es/cddl1"),
    ("cddl-1.1", r"common development and distribution licen[cs]e (?:version|v) ?1 1", r"cddl-1\.1", r"glassfish\.java\.net/public/cddl\+gpl_1_1"),
    ("eupl-1.1", r"european union public licen[cs]e (?:version|v) ?1 1", r"eupl-1\.1", r"joinup\.ec\.europa\.eu/software/page/eupl"),
    ("eupl-1.2", r"european union public licen[cs]e(?: (?:version|v) ?1 2)?", r"eupl-1\.2", r"joinup\.ec\.europa\.eu/collection/eupl"),
    ("artistic-1.0", r"artistic licen[cs]e (?:version |v ?)?1 0", r"artistic-1\.0(?:-perl|-cl8)?", r"opensource\.org/licen[cs]es/artistic-license-1\.0"),
    ("artistic-2.0", r"artistic licen[cs]e (?:version |v ?)?2 0", r"artistic-2\.0", r"opensource\.org/licen[cs]es/artistic-license-2\.0"),
    ("bsl-1.0", r"boost software licen[cs]e(?: (?:version|v) ?1 0)?", r"bsl-1\.0", r"boost\.org/license_1_0"),
    ("busl-1.1", r"business source licen[cs]e(?: 1 1)?", r"busl-1\.1", r"mariadb\.com/bsl11"),
    ("sspl-1.0", r"server side public licen[cs]e(?: (?:version|v) ?1)?", r"sspl-1\.0", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", r"elastic licen[cs]e (?:version |v ?)?2 0", r"elastic-2\.0", r"elastic\.co/licensing/elastic-license"),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib", r"zlib\.net/zlib_license"),
    ("libpng", r"libpng licen[cs]e(?: version 2)?", r"libpng(?:-2\.0)?", r"libpng\.org/pub/png/src/libpng-license"),
    ("unlicense", r"(?:the )?unlicen[cs]e", r"unlicense", r"unlicense\.org"),
    ("wtfpl", r"do what the f\S+ you want to public licen[cs]e", r"wtfpl", r"wtfpl\.net"),
    ("beerware", r"beer ?ware licen[cs]e", r"beerware", r"people\.freebsd\.org/~phk"),
    ("postgresql", r"postgresql licen[cs]e", r"postgresql", r"postgresql\.org/about/licen[cs]e"),
    ("python-2.0", r"python software foundation licen[cs]e(?: (?:version|v) ?2)?", r"(?:python|psf)-2\.0", r"python\.org/psf/license"),
    ("php-3.01", r"php licen[cs]e (?:version |v ?)?3 01", r"php-3\.01", r"php\.net/license/3_01"),
    ("ruby", r"ruby licen[cs]e", r"ruby", r"ruby-lang\.org/en/about/license"),
    ("openssl", r"openssl licen[cs]e", r"openssl", r"openssl\.org/source/license"),
    ("curl", r"curl licen[cs]e", r"curl", r"curl\.se/docs/copyright"),
    ("ofl-1.1", r"sil open font licen[cs]e(?: (?:version|v) ?1 1)?", r"ofl-1\.1(?:-rfn|-no-rfn)?", r"scripts\.sil\.org/ofl"),
    ("ncsa", r"university of illinois(?: ncsa)? open source licen[cs]e", r"ncsa", r"opensource\.org/licen[cs]es/ncsa"),
    ("upl-1.0", r"universal permissive licen[cs]e(?: (?:version|v) ?1 0)?", r"upl-1\.0", r"oss\.oracle\.com/licenses/upl"),
    ("afl-3.0", r"academic free licen[cs]e (?:version|v) ?3 0", r"afl-3\.0", r"opensource\.org/licen[cs]es/afl-3\.0"),
    ("osl-3.0", r"open software licen[cs]e (?:version|v) ?3 0", r"osl-3\.0", r"opensource\.org/licen[cs]es/osl-3\.0"),
    ("ms-pl", r"microsoft public licen[cs]e", r"ms-pl", r"opensource\.org/licen[cs]es/ms-pl"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", r"ms-rl", r"opensource\.org/licen[cs]es/ms-rl"),
    ("vim", r"vim licen[cs]e", r"vim", r"vimhelp\.org/uganda"),
    ("w3c", r"w3c software(?: notice and)? licen[cs]e", r"w3c", r"w3\.org/consortium/legal/2015/copyright-software"),
    ("json", r"json licen[cs]e", r"json", r"json\.org/license"),
    ("cc0-1.0", r"(?:creative commons )?cc ?0(?: 1 0)?(?: universal)?", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1-4] [05])?", r"cc-by-nc-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [05])?", r"cc-by-nc-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [05])?", r"cc-by-nc-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [1-4] [05])?", r"cc-by-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nd"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [05])?", r"cc-by-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by-4.0", r"(?:cc by|creative commons attribution)(?: international)? 4 0", r"cc-by-4\.0", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-3.0", r"(?:cc by|creative commons attribution)(?: unported)? 3 0", r"cc-by-3\.0", r"creativecommons\.org/licenses/by/3\.0"),
    ("odbl-1.0", r"open (?:data commons open )?database licen[cs]e", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e", r"odc-by-1\.0", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", r"public domain dedication and licen[cs]e", r"pddl-1\.0", r"opendatacommons\.org/licenses/pddl"),
    ("ogl-uk-3.0", r"open government licen[cs]e (?:(?:version|v) ?)?3 0", r"ogl-uk-3\.0", r"nationalarchives\.gov\.uk/doc/open-government-licence"),
    ("cecill-2.1", r"cecill (?:free software )?licen[cs]e(?: agreement)?", r"cecill-(?:2\.1|2\.0|b|c)", r"cecill\.info/licences"),
    ("mulan-2.0", r"mulan (?:permissive software licen[cs]e|psl) ?(?:v ?2)?", r"mulanpsl-2\.0", r"license\.coscl\.org\.cn/mulanpsl2"),
]

# (label, weight in percent, a word that every match holds, sentence)
SENTENCES: list[tuple[str, int, str, str]] = [
    ("mit", 90, "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 75, "portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", 90, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd-2-clause", 70, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 80, "endorse", r"neither the name of .{1,80}? may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 85, "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", 90, "apache", r"licensed under the apache licen[cs]e version 2(?: 0)?"),
    ("apache-2.0", 80, "warranties", r"distributed under the licen[cs]e is distributed on an as is basis without warranties or conditions"),
    ("gpl-2.0", 85, "version", r"either version 2 of the licen[cs]e or at your option any later version"),
    ("gpl-3.0", 85, "version", r"either version 3 of the licen[cs]e or at your option any later version"),
    ("gpl-2.0", 90, "version", r"licensed under the gnu general public licen[cs]e (?:version|v) ?2"),
    ("gpl-3.0", 90, "version", r"licensed under the gnu general public licen[cs]e (?:version|v) ?3"),
    ("lgpl-2.1", 85, "version", r"either version 2 1 of the licen[cs]e or at your option any later version"),
    ("mpl-2.0", 90, "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v ?2 0"),
    ("mpl-1.1", 90, "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("epl-2.0", 90, "eclipse", r"made available under the terms of the eclipse public licen[cs]e(?: v)? 2 0"),
    ("zlib", 85, "plainly", r"altered source versions must be plainly marked as such"),
    ("bsl-1.0", 85, "boost", r"distributed under the boost software licen[cs]e version 1 0"),
    ("unlicense", 90, "domain", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", 85, "just", r"you just do what the f\S+ you want to"),
    ("beerware", 85, "beer", r"you can buy me a beer in return"),
    ("cc0-1.0", 85, "waived", r"waived all copyright and related or neighboring rights"),
    ("ofl-1.1", 85, "font", r"this font software is licensed under the sil open font licen[cs]e"),
    ("public-domain", 70, "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("all-rights-reserved", 40, "reserved", r"all rights reserved"),
    ("proprietary", 70, "proprietary", r"proprietary and confidential"),
    ("proprietary", 65, "prohibited", r"unauthori[sz]ed (?:copying|use|reproduction|distribution) .{0,60}?(?:is )?(?:strictly )?prohibited"),
    ("commercial", 60, "commercial", r"commercial licen[cs]e (?:agreement|terms)"),
    ("non-commercial", 60, "commercial", r"(?:for|licensed for) non ?commercial use only"),
    ("cc-by-sa", 75, "creative", r"text is available under the creative commons attribution share ?alike licen[cs]e"),
    ("eula", 60, "agreement", r"end user licen[cs]e agreement"),
    ("unknown-license", 30, "licensed", r"(?:this work is |is |are )?licensed under (?:the )?\S+"),
]
