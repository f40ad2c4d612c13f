"""The rules of the licence scan: regular expressions over a text's lower-case words, joined by single spaces.

In a pattern, LIC stands for license or licence, THE for an optional "the", VER for an optional "version" or "v" before a number.
``need``: the keywords that any match holds, separated by spaces; "/" separates alternatives. A rule is tried only on texts with all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

#: From strongest to weakest: an identifier field, a sentence of the licence itself, a stated grant, a full name, a short or general name.
FIELD, SENTENCE, GRANT, NAME, GENERAL = range(5)
WEIGHT = (0.98, 0.95, 0.95, 0.85, 0.5)
#: Stands for the phrases that always count; no other rule suppresses them.
BASE = -1
BASE_WEIGHT = 0.95


@dataclass(frozen=True)
class Rule:
    label: str
    level: int
    need: str
    pattern: str


BASE_RULES = [
    Rule("mit", BASE, "under the mit license", "under the mit license"),
    Rule("apache-2", BASE, "apache license version 2", "apache license version 2"),
    Rule("cc-by-nc", BASE, "cc by nc", "cc by nc"),
]

# Licences by the form that their identifiers and short names take as words: (label, keyword, pattern).
SHORT = [
    ("apache-1", "apache", r"apache 1 [01]"),
    ("apache-2", "apache", r"apache 2(?: 0)?"),
    ("mit", "mit", r"mit"),
    ("mit-0", "mit", r"mit 0"),
    ("bsd-0", "0bsd", r"0bsd"),
    ("bsd-1", "bsd", r"bsd 1 clause"),
    ("bsd-2", "bsd", r"bsd 2(?: clause(?: simplified| freebsd| netbsd| patent| views)?)?"),
    ("bsd-3", "bsd", r"bsd 3(?: clause(?: clear| lbnl| modification| no nuclear (?:license|warranty))?)?"),
    ("bsd-4", "bsd", r"bsd 4(?: clause(?: uc| shortened)?)?"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib"),
    ("libpng", "libpng", r"libpng(?: 2 0)?"),
    ("boost-1", "bsl", r"bsl 1 0"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("gpl-1", "gpl", r"(?:gnu )?gpl (?:v1|1 0|1)(?: only| or later)?"),
    ("gpl-2", "gpl/gplv2/gpl2", r"(?:gnu )?(?:gplv2|gpl2|gpl (?:v2|2 0|2))(?: only| or later)?"),
    ("gpl-3", "gpl/gplv3/gpl3", r"(?:gnu )?(?:gplv3|gpl3|gpl (?:v3|3 0|3))(?: only| or later)?"),
    ("lgpl-2", "lgpl/lgplv2", r"(?:gnu )?(?:lgplv2|lgpl (?:v2|2))(?: 0)?(?: only| or later)?"),
    ("lgpl-2.1", "lgpl/lgplv2", r"(?:gnu )?(?:lgplv2|lgpl (?:v2|2)) 1(?: only| or later)?"),
    ("lgpl-3", "lgpl/lgplv3", r"(?:gnu )?(?:lgplv3|lgpl (?:v3|3))(?: 0)?(?: only| or later)?"),
    ("agpl-1", "agpl", r"agpl (?:v1|1)(?: 0)?(?: only| or later)?"),
    ("agpl-3", "agpl/agplv3", r"(?:gnu )?(?:agplv3|agpl (?:v3|3))(?: 0)?(?: only| or later)?"),
    ("gfdl", "gfdl", r"gfdl(?: 1 [123])?(?: only| or later)?"),
    ("mpl-1", "mpl", r"mpl 1 [01]"),
    ("mpl-2", "mpl", r"mpl (?:v2|2)(?: 0)?"),
    ("epl-1", "epl", r"epl (?:v1|1)(?: 0)?"),
    ("epl-2", "epl", r"epl (?:v2|2)(?: 0)?"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?"),
    ("cpl-1", "cpl", r"cpl 1 0"),
    ("eupl", "eupl", r"eupl(?: 1 [012])?"),
    ("cecill", "cecill", r"cecill(?: [12] [01]| b| c)?"),
    ("artistic-1", "artistic", r"artistic 1 0(?: perl| cl8)?"),
    ("artistic-2", "artistic", r"artistic 2 0"),
    ("python-2", "python", r"python 2 0(?: 1)?"),
    ("psf-2", "psf", r"psf 2 0"),
    ("php-3", "php", r"php 3 0(?:1)?"),
    ("ms-pl", "ms", r"ms pl"),
    ("ms-rl", "ms", r"ms rl"),
    ("osl-3", "osl", r"osl 3 0"),
    ("afl-3", "afl", r"afl 3 0"),
    ("apsl-2", "apsl", r"apsl 2 0"),
    ("openssl", "openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("ncsa", "ncsa", r"ncsa"),
    ("vim", "vim", r"vim"),
    ("sleepycat", "sleepycat", r"sleepycat"),
    ("ofl-1", "ofl", r"ofl 1 [01]"),
    ("odbl-1", "odbl", r"odbl(?: 1 0)?"),
    ("odc-by-1", "odc", r"odc by(?: 1 0)?"),
    ("pddl-1", "pddl", r"pddl(?: 1 0)?"),
    ("upl-1", "upl", r"upl 1 0"),
    ("busl-1.1", "busl", r"busl 1 1"),
    ("sspl-1", "sspl", r"sspl(?: 1 0)?"),
    ("elastic-2", "elastic", r"elastic 2 0"),
    ("lppl-1", "lppl", r"lppl 1 [0123]c?"),
    ("hpnd", "hpnd", r"hpnd"),
    ("qpl-1", "qpl", r"qpl 1 0"),
    ("w3c", "w3c", r"w3c"),
    ("x11", "x11", r"x11"),
    ("tcl", "tcl", r"tcl"),
    ("blueoak-1", "blueoak", r"blueoak 1 0 0"),
]

# Full names: (label, keywords, pattern).
NAMES = [
    ("apache-1", "apache", r"apache (?:software )?LIC(?: version)? 1 [01]"),
    ("apache-2", "apache", r"apache (?:software )?LIC VER2(?: 0)?"),
    ("apache-2", "asl", r"asl 2 0"),
    ("mit", "mit", r"mit (?:open source |x11 )?LIC"),
    ("mit", "expat", r"expat LIC"),
    ("mit-0", "mit", r"mit no attribution LIC"),
    ("bsd-0", "bsd", r"zero clause bsd LIC"),
    ("bsd-2", "bsd clause", r"(?:2|two) clause bsd LIC"),
    ("bsd-2", "bsd clause", r"bsd (?:2|two) clause LIC"),
    ("bsd-2", "bsd simplified", r"simplified bsd LIC"),
    ("bsd-2", "freebsd", r"freebsd LIC"),
    ("bsd-3", "bsd clause", r"(?:3|three) clause bsd LIC"),
    ("bsd-3", "bsd clause", r"bsd (?:3|three) clause LIC"),
    ("bsd-3", "bsd", r"(?:new|modified|revised) bsd LIC"),
    ("bsd-4", "bsd clause", r"(?:4|four) clause bsd LIC"),
    ("bsd-4", "bsd original", r"original bsd LIC"),
    ("isc", "isc", r"isc LIC"),
    ("isc", "internet consortium", r"internet (?:software|systems) consortium LIC"),
    ("zlib", "zlib", r"zlib (?:libpng )?LIC"),
    ("libpng", "libpng", r"libpng LIC"),
    ("boost-1", "boost", r"boost software LIC(?: VER1 0)?"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "what fuck", r"do what the fuck you want to public LIC"),
    ("cc0", "cc0", r"cc0 1 0 universal"),
    ("cc0", "zero/cc0 commons", r"creative commons (?:cc0|zero)(?: public domain dedication)?"),
    ("cc-by", "commons attribution", r"creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: LIC)?"),
    ("cc-by-sa", "commons attribution", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: LIC)?"),
    ("cc-by-nd", "commons attribution", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: LIC)?"),
    ("cc-by-nc", "commons attribution", r"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: LIC)?"),
    ("cc-by-nc-sa", "commons attribution", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: LIC)?"),
    ("cc-by-nc-nd", "commons attribution", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: LIC)?"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by(?: [1-4] [05])?"),
    ("cc-by-sa", "creativecommons sa", r"creativecommons org licenses by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "creativecommons nd", r"creativecommons org licenses by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "creativecommons nc", r"creativecommons org licenses by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creativecommons nc sa", r"creativecommons org licenses by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creativecommons nc nd", r"creativecommons org licenses by nc nd(?: [1-4] [05])?"),
    ("cc0", "creativecommons zero", r"creativecommons org publicdomain zero 1 0"),
    ("gpl-1", "general public", r"(?:gnu )?general public LIC VER1(?: 0)?"),
    ("gpl-2", "general public", r"(?:gnu )?general public LIC VER2(?: 0)?"),
    ("gpl-3", "general public", r"(?:gnu )?general public LIC VER3(?: 0)?"),
    ("gpl-2", "general public", r"version 2 of THEgnu general public LIC"),
    ("gpl-3", "general public", r"version 3 of THEgnu general public LIC"),
    ("lgpl-2", "general public", r"(?:gnu )?(?:library|lesser) general public LIC VER2(?: 0)?"),
    ("lgpl-2.1", "general public lesser", r"(?:gnu )?lesser general public LIC VER2 1"),
    ("lgpl-3", "general public lesser", r"(?:gnu )?lesser general public LIC VER3(?: 0)?"),
    ("lgpl-2", "general public lesser/library", r"version 2 of THEgnu (?:lesser|library) general public LIC"),
    ("lgpl-2.1", "general public lesser", r"version 2 1 of THEgnu lesser general public LIC"),
    ("lgpl-3", "general public lesser", r"version 3 of THEgnu lesser general public LIC"),
    ("agpl-1", "affero general", r"affero general public LIC VER1(?: 0)?"),
    ("agpl-3", "affero general", r"(?:gnu )?affero general public LIC VER3(?: 0)?"),
    ("agpl-3", "affero general", r"version 3 of THEgnu affero general public LIC"),
    ("gfdl", "gnu documentation", r"gnu free documentation LIC(?: VER1 [123])?"),
    ("mpl-1", "mozilla", r"mozilla public LIC VER1 [01]"),
    ("mpl-2", "mozilla", r"mozilla public LIC VER2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public LIC VER1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public LIC VER2(?: 0)?"),
    ("edl-1", "eclipse", r"eclipse distribution LIC(?: VER1 0)?"),
    ("cddl", "common distribution", r"common development and distribution LIC(?: VER1 [01])?"),
    ("cpl-1", "common public", r"common public LIC VER1 0"),
    ("ipl-1", "ibm", r"ibm public LIC(?: VER1 0)?"),
    ("eupl", "european union", r"european union public LIC(?: VER1 [012])?"),
    ("cecill", "cecill", r"cecill (?:[bc] )?(?:free software )?LIC(?: agreement)?"),
    ("artistic-1", "artistic", r"artistic LIC VER1 0"),
    ("artistic-2", "artistic", r"artistic LIC VER2 0"),
    ("python-2", "python", r"python software foundation LIC(?: VER2)?"),
    ("ruby", "ruby", r"ruby LIC"),
    ("php-3", "php", r"php LIC VER3(?: 01?)?"),
    ("ms-pl", "microsoft", r"microsoft public LIC"),
    ("ms-rl", "microsoft", r"microsoft reciprocal LIC"),
    ("osl-3", "open software", r"open software LIC VER3 0"),
    ("afl-3", "academic", r"academic free LIC VER3 0"),
    ("apsl-2", "apple", r"apple public source LIC(?: VER2 0)?"),
    ("openssl", "openssl", r"openssl LIC"),
    ("ssleay", "ssleay", r"(?:original )?ssleay LIC"),
    ("postgresql", "postgresql", r"postgresql LIC"),
    ("ncsa", "illinois", r"university of illinois (?:ncsa )?open source LIC"),
    ("w3c", "w3c", r"w3c software (?:notice and )?LIC"),
    ("vim", "vim", r"vim LIC"),
    ("sleepycat", "sleepycat", r"sleepycat (?:public )?LIC"),
    ("ofl-1", "sil font", r"sil open font LIC(?: VER1 [01])?"),
    ("odbl-1", "database", r"open (?:data commons open )?database LIC(?: VER1 0)?"),
    ("odc-by-1", "commons attribution", r"open data commons attribution LIC(?: VER1 0)?"),
    ("pddl-1", "domain dedication", r"open data commons public domain dedication and LIC"),
    ("upl-1", "universal permissive", r"universal permissive LIC(?: VER1 0)?"),
    ("busl-1.1", "business source", r"business source LIC(?: VER1 1)?"),
    ("sspl-1", "server side", r"server side public LIC(?: VER1)?"),
    ("elastic-2", "elastic", r"elastic LIC VER2(?: 0)?"),
    ("commons-clause", "commons clause", r"commons clause LIC condition(?: VER1 0)?"),
    ("polyform-nc", "polyform", r"polyform noncommercial LIC(?: 1 0 0)?"),
    ("polyform-sb", "polyform", r"polyform small business LIC(?: 1 0 0)?"),
    ("json", "json", r"json LIC"),
    ("curl", "curl", r"curl LIC"),
    ("icu", "icu", r"icu LIC"),
    ("unicode", "unicode", r"unicode (?:inc )?LIC agreement"),
    ("tcl", "tcl", r"tcl tk LIC"),
    ("hpnd", "historical notice", r"historical permission notice and disclaimer"),
    ("qpl-1", "public", r"q public LIC(?: VER1 0)?"),
    ("lppl-1", "latex", r"latex project public LIC(?: VER1 [0123])?"),
    ("ogl-uk", "open government", r"open government LIC(?: v?[123](?: 0)?)?"),
    ("etalab-2", "etalab", r"etalab (?:open LIC )?2 0"),
    ("beerware", "beer", r"(?:the )?beer ?ware LIC"),
    ("mulan-2", "mulan", r"mulan (?:psl|permissive software LIC)(?: v?2)?"),
    ("nasa-1", "nasa", r"nasa open source agreement(?: VER1 3)?"),
    ("sissl", "sun", r"sun industry standards source LIC"),
    ("openrail", "openrail/rail", r"(?:creativeml |bigscience |bigcode )?(?:openrail|open rail m)(?: m)?(?: LIC)?"),
    ("rail", "responsible ai", r"responsible ai LIC"),
    ("llama", "llama", r"llama (?:2 |3 |3 1 |3 2 )?community LIC(?: agreement)?"),
    ("gemma", "gemma", r"gemma terms of use"),
    ("blueoak-1", "oak model", r"blue oak model LIC(?: 1 0 0)?"),
]

# Sentences that stand in the licences' own texts: (label, keywords, pattern).
SENTENCES = [
    ("mit", "hereby charge obtaining", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "merge sublicense", r"use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "file compliance", r"you may not use this file except in compliance with the LIC"),
    ("apache-2", "apache licenses", r"www apache org licenses LIC 2 0"),
    ("bsd-2", "redistribution binary modification", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3", "endorse derived", r"neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|any|other) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", "hereby fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "hereby fee", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "misrepresented origin", r"the origin of this software must not be misrepresented"),
    ("boost-1", "organization obtaining", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", "unencumbered domain", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "what fuck", r"you just do what the fuck you want to"),
    ("gpl", "redistribute general", r"you can redistribute it and or modify it under the terms of THEgnu general public LIC"),
    ("lgpl", "redistribute general lesser/library", r"you can redistribute it and or modify it under the terms of THEgnu (?:lesser|library) general public LIC"),
    ("agpl", "redistribute affero", r"you can redistribute it and or modify it under the terms of THEgnu affero general public LIC"),
    ("gpl", "merchantability particular general", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public LIC"),
    ("gpl", "received general", r"you should have received a copy of the gnu general public LIC"),
    ("lgpl", "received lesser/library general", r"you should have received a copy of the gnu (?:lesser|library) general public LIC"),
    ("agpl", "received affero", r"you should have received a copy of the gnu affero general public LIC"),
    ("gpl-2", "free software version", r"general public LIC as published by the free software foundation (?:either )?version 2"),
    ("gpl-3", "free software version", r"general public LIC as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.1", "lesser free software", r"lesser general public LIC as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3", "lesser free software", r"lesser general public LIC as published by the free software foundation (?:either )?version 3"),
    ("agpl-3", "affero free software", r"affero general public LIC as published by the free software foundation (?:either )?version 3"),
    ("gfdl", "copy documentation gnu", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation LIC"),
    ("mpl-2", "mozilla subject", r"this source code form is subject to the terms of the mozilla public LIC v 2 0"),
    ("mpl-1", "mozilla contents", r"the contents of this file are subject to the mozilla public LIC version 1 [01]"),
    ("epl-1", "eclipse public", r"made available under the terms of the eclipse public LIC v1 0"),
    ("epl-2", "eclipse public", r"made available under the terms of the eclipse public LIC 2 0"),
    ("cddl", "contents common", r"the contents of this file are subject to the terms of the common development and distribution LIC"),
    ("ofl-1", "font sil", r"this font software is licensed under the sil open font LIC"),
    ("ms-pl", "accept software", r"if you use the software you accept this LIC"),
    ("openssl", "openssl product", r"this product includes software developed by the openssl project"),
    ("apache-1", "apache product", r"this product includes software developed by the apache (?:group|software foundation)"),
    ("beerware", "beer worth", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("json", "good evil", r"the software shall be used for good not evil"),
    ("public-domain", "dedicated domain", r"(?:has been |is )?dedicated to the public domain"),
    ("public-domain", "placed domain", r"(?:has been |is )?placed in(?:to)? the public domain"),
    ("public-domain", "domain work/software/text/book/file", r"this (?:work|software|text|book|file) is in the public domain"),
    ("proprietary", "confidential proprietary", r"proprietary and confidential"),
    ("proprietary", "copying", r"unauthori[sz]ed copying of this (?:file|document|work|software)"),
    ("proprietary", "reproduced permission", r"may not be reproduced (?:in whole or in part )?without (?:the )?(?:prior )?(?:written )?permission"),
    ("proprietary", "part reproduced", r"no part of this (?:publication|book|work|document) may be reproduced"),
    ("non-commercial", "commercial only", r"for (?:personal and )?non ?commercial use only"),
    ("non-commercial", "research only", r"for (?:academic |scientific )?research (?:purposes|use) only"),
]

# Names that leave the version open, and general statements: (label, keywords, pattern).
GENERALS = [
    ("gpl", "general public", r"gnu general public LIC"),
    ("gpl", "gnu", r"gnu gpl"),
    ("gpl", "gpl", r"gpl licensed"),
    ("lgpl", "general public lesser/library", r"gnu (?:lesser|library) general public LIC"),
    ("lgpl", "gnu lgpl", r"gnu lgpl"),
    ("agpl", "affero general", r"(?:gnu )?affero general public LIC"),
    ("agpl", "gnu agpl", r"gnu agpl"),
    ("apache", "apache", r"apache (?:software )?LIC"),
    ("bsd", "bsd", r"bsd (?:style )?LIC"),
    ("mit", "mit style", r"mit style LIC"),
    ("mpl", "mozilla", r"mozilla public LIC"),
    ("epl", "eclipse", r"eclipse public LIC"),
    ("artistic", "artistic", r"(?:the )?artistic LIC"),
    ("perl", "perl", r"same terms as perl(?: itself)?"),
    ("creative-commons", "creative", r"creative commons LIC"),
    ("proprietary", "reserved", r"all rights reserved"),
    ("proprietary", "rechte vorbehalten", r"alle rechte vorbehalten"),
    ("proprietary", "droits réservés", r"tous droits réservés"),
    ("proprietary", "derechos reservados", r"todos los derechos reservados"),
    ("proprietary", "proprietary", r"proprietary LIC"),
    ("proprietary", "end user", r"end user LIC agreement"),
]

# Ways to state a licence in a field, and to grant one; ID stands for each short form above.
FIELDS = [("spdx identifier", r"spdx LIC identifier ID"), ("LICWORDS", r"LIC ID"), ("LICWORDS type", r"LIC type ID")]
GRANTS = [("licensed/licenced", r"(?:dual )?licen[cs]ed under (?:the terms of )?THEID(?: LIC)?"), ("under", r"(?:released|distributed|published|provided|available) under (?:the terms of )?THEID LIC")]

#: Labels whose short form needs nothing around it.
ALONE = ("gpl-1", "gpl-2", "gpl-3", "lgpl-2", "lgpl-2.1", "lgpl-3", "agpl-1", "agpl-3", "cc-by-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd", "cc0", "eupl", "wtfpl")

_LICENSE = "license/licence"


def _full(pattern: str) -> str:
    return pattern.replace("LIC", "licen[cs]e").replace("THE", "(?:the )?").replace("VER", "(?:version |v)?")


def rules() -> list[Rule]:
    """All rules in their order: the first phrases, then by level; within a level as written above."""
    made = list(BASE_RULES)
    for need, way in FIELDS:
        made += [Rule(label, FIELD, f"{need.replace('LICWORDS', _LICENSE)} {key}", way.replace("ID", short)) for label, key, short in SHORT]
    made += [Rule(label, SENTENCE, need, pattern) for label, need, pattern in SENTENCES]
    for need, way in GRANTS:
        made += [Rule(label, GRANT, f"{need} {key}", way.replace("ID", short)) for label, key, short in SHORT]
    made += [Rule(label, NAME, need, pattern) for label, need, pattern in [*NAMES, *(x for x in SHORT if x[0] in ALONE)]]
    made += [Rule(label, GENERAL, need, pattern) for label, need, pattern in GENERALS]
    return [Rule(r.label, r.level, r.need, _full(r.pattern)) for r in made]
