"""License detection by ordered signature rules.

A text is reduced to its words (A-Z lower-cased; anything but digits, letters and non-ASCII characters separates), joined by
single spaces. Each rule is a regular expression over that string with a label, a priority, a confidence and a gate: the
keywords without which it cannot match. One pass of an Aho-Corasick automaton finds the keywords of a text; only rules whose
whole gate was seen run. Overlapping detections are then resolved in order of priority, length and place: a detection whose
interval lies inside a kept one, or overlaps one of higher priority, is suppressed. Of two with one interval and priority the
first label stays. The rules are the signatures of NOTICES, each written by hand, and for each family's name the ways in which
texts refer to a license by name (FORMS).

Defined cases: null or empty text has no words, no labels and score 0; repeated rows are scanned each; long texts are
scanned whole; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

from pyspark.sql import DataFrame

from tessera.llm.byte_bpe import slices
from tessera.llm.common import map_rows

#: Fixed phrases of the base result and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label: (keyword of the name, the name, version words or "")
FAMILIES = {
    "gpl": ("gpl|public", r"(?:gnu )?(?:gpl|general public licen[sc]e)", r"(?:v|version )?[123](?: 0)?"),
    "lgpl": ("lgpl|lesser|library", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[sc]e)", r"(?:v|version )?[23](?: [01])?"),
    "agpl": ("agpl|affero", r"(?:gnu )?(?:agpl|affero general public licen[sc]e)", r"(?:v|version )?[13](?: 0)?"),
    "gfdl": ("gfdl|documentation", r"(?:gnu )?(?:gfdl|free documentation licen[sc]e)", r"(?:v|version )?1 [123]"),
    "apache": ("apache", r"apache(?: software)?(?: licen[sc]e)?", r"(?:v|version )?(?:1 [01]|2(?: 0)?)"),
    "mit": ("mit", r"mit(?: x11)?(?: licen[sc]e)?", ""),
    "bsd": ("bsd", r"(?:[234] clause |(?:simplified|modified|new|original) )?bsd(?: [0234] clause)?(?: licen[sc]e)?", ""),
    "isc": ("isc", r"isc(?: licen[sc]e)?", ""),
    "mpl": ("mpl|mozilla", r"(?:mpl|mozilla public licen[sc]e)", r"(?:v|version )?(?:1 [01]|2(?: 0)?)"),
    "epl": ("epl|eclipse", r"(?:epl|eclipse public licen[sc]e)", r"(?:v|version )?[12](?: 0)?"),
    "eupl": ("eupl|european", r"(?:eupl|european union public licen[sc]e)", r"(?:v|version )?1 [012]"),
    "cddl": ("cddl|distribution", r"(?:cddl|common development and distribution licen[sc]e)", r"(?:v|version )?1 [01]"),
    "cpl": ("cpl|common", r"(?:cpl|common public licen[sc]e)", r"(?:v|version )?1(?: 0)?"),
    "artistic": ("artistic", r"artistic(?: licen[sc]e)?", r"(?:v|version )?[12](?: 0)?"),
    "zlib": ("zlib", r"zlib(?: libpng)?(?: licen[sc]e)?", ""),
    "unlicense": ("unlicense", r"unlicense", ""),
    "wtfpl": ("wtfpl", r"wtfpl", r"(?:v|version )?[12]"),
    "boost": ("boost|bsl", r"(?:boost(?: software)?(?: licen[sc]e)?|bsl)", r"(?:v|version )?1 0"),
    "python": ("python|psf", r"(?:python(?: software foundation)?|psf)(?: licen[sc]e)?", r"(?:v|version )?[23](?: [0-9])?"),
    "php": ("php", r"php(?: licen[sc]e)?", r"(?:v|version )?3 0[01]?"),
    "ruby": ("ruby", r"ruby(?: licen[sc]e)?", ""),
    "openssl": ("openssl", r"openssl(?: licen[sc]e)?", ""),
    "postgresql": ("postgresql", r"postgresql(?: licen[sc]e)?", ""),
    "ofl": ("ofl|font", r"(?:ofl|(?:sil )?open font licen[sc]e)", r"(?:v|version )?1 [01]"),
    "odbl": ("odbl|database", r"(?:odbl|open database licen[sc]e)", r"(?:v|version )?1 0"),
    "cc0": ("cc0|zero", r"(?:cc0|cc zero|creative commons zero)", r"(?:v|version )?1 0"),
    "cc-by-sa": ("cc|commons", r"(?:cc by sa|creative commons attribution share ?alike)", r"(?:v|version )?[1234](?: [05])?"),
    "cc-by-nd": ("cc|commons", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: works)?)", r"(?:v|version )?[1234](?: [05])?"),
    "cc-by-nc": ("cc|commons", r"(?:cc by nc|creative commons attribution non ?commercial)", r"(?:v|version )?[1234](?: [05])?"),
    "cc-by-nc-sa": ("cc|commons", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", r"(?:v|version )?[1234](?: [05])?"),
    "cc-by-nc-nd": ("cc|commons", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)", r"(?:v|version )?[1234](?: [05])?"),
    "cc-by": ("cc|commons", r"(?:cc by|creative commons attribution)", r"(?:v|version )?[1234](?: [05])?"),
    "ms-pl": ("microsoft|ms", r"(?:ms pl|microsoft public licen[sc]e)", ""),
    "ms-rl": ("microsoft|ms", r"(?:ms rl|microsoft reciprocal licen[sc]e)", ""),
    "apsl": ("apsl|apple", r"(?:apsl|apple public source licen[sc]e)", r"(?:v|version )?[12] [012]"),
    "upl": ("upl|universal", r"(?:upl|universal permissive licen[sc]e)", r"(?:v|version )?1 0"),
    "ncsa": ("ncsa|illinois", r"(?:ncsa|university of illinois ncsa open source)(?: licen[sc]e)?", ""),
    "afl": ("afl|academic", r"(?:afl|academic free licen[sc]e)", r"(?:v|version )?[123] [012]"),
    "osl": ("osl|open", r"(?:osl|open software licen[sc]e)", r"(?:v|version )?[123] [012]"),
    "qpl": ("qpl|q", r"(?:qpl|q public licen[sc]e)", r"(?:v|version )?1 0"),
    "vim": ("vim", r"vim licen[sc]e", ""),
    "beerware": ("beerware|beer", r"beer ?ware(?: licen[sc]e)?", ""),
    "sspl": ("sspl|server", r"(?:sspl|server side public licen[sc]e)", r"(?:v|version )?1(?: 0)?"),
    "busl": ("busl|business", r"(?:busl|business source licen[sc]e)", r"(?:v|version )?1 1"),
    "elastic": ("elastic", r"elastic licen[sc]e", r"(?:v|version )?2(?: 0)?"),
    "mulan": ("mulan", r"mulan(?: psl| permissive software licen[sc]e)", r"(?:v|version )?[12]"),
}

#: name: (priority, confidence, further keyword, form); {n} is the name, {v} the version. "{v}" forms need a version.
FORMS = {
    "identifier": (100, 1.0, "spdx", r"spdx licen[sc]e identifier {n}(?: {v})?(?: only| or later)?"),
    "header": (95, 1.0, "licensed", r"licensed under (?:the )?(?:terms of (?:the )?)?{n}(?: licen[sc]e)?(?:,? {v})?"),
    "granted": (90, 0.95, "under", r"(?:released|distributed|redistribut(?:ed|able)|published|available|provided|made available|licensable) under (?:the )?(?:terms of (?:the )?)?{n}(?: {v})?"),
    "terms": (85, 0.9, "terms", r"(?:under|by|to|with|accept(?:s|ing)?) (?:the )?terms (?:and conditions )?of (?:the )?{n}(?: {v})?"),
    "governed": (80, 0.9, "by", r"(?:governed|covered|protected) by (?:the )?{n}(?: {v})?"),
    "copy": (75, 0.85, "copy", r"(?:received|obtain|include[sd]?|see) (?:a|the) copy of (?:the )?{n}(?: {v})?"),
    "versioned": (60, 0.8, "", r"{n} {v}"),
    "named": (50, 0.7, "", r"(?:the )?{n} licen[sc]e"),
}

#: Signatures of notices, titles, grants, conditions, disclaimers and addresses, each written for itself:
#: label, priority, confidence, gate (words that must all occur), expression.
NOTICES = (
    # permissive grants
    ("mit", 72, 0.95, "permission charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 70, 0.9, "permission charge", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 62, 0.8, "sublicense merge", r"use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 58, 0.7, "substantial portions", r"(?:copyright notice and this permission notice|this permission notice) shall be included in all copies or substantial portions of the software"),
    ("mit-0", 73, 0.9, "mit attribution", r"mit no attribution"),
    ("x11", 71, 0.85, "consortium", r"except as contained in this notice the names? of the x consortium shall not be used in advertising"),
    ("isc", 70, 0.9, "permission fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", 68, 0.8, "permission fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("hpnd", 69, 0.8, "permission documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", 70, 0.9, "redistribution binary", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 60, 0.8, "redistributions source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 60, 0.8, "redistributions binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 66, 0.9, "endorse derived", r"neither the names? of .{1,120}? may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", 64, 0.85, "endorse promote", r"the names? of (?:the )?(?:author|authors|contributors|copyright holder) may not be used to endorse or promote products"),
    ("bsd-4-clause", 67, 0.9, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("0bsd", 74, 0.9, "bsd zero", r"bsd zero clause licen[sc]e"),
    ("0bsd", 74, 0.9, "0bsd", r"0bsd"),
    ("zlib", 70, 0.9, "origin misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", 68, 0.85, "altered plainly", r"altered source versions must be plainly marked as such"),
    ("zlib", 60, 0.75, "arising held", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", 72, 0.9, "permission accompanying", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("ncsa", 68, 0.85, "disclaimers following", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("unlicense", 74, 0.95, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 66, 0.8, "publish compile", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 74, 0.95, "want", r"do what the fuck you want to(?: public licen[sc]e)?"),
    ("beerware", 72, 0.9, "beer", r"you can buy me a beer in return"),
    ("postgresql", 73, 0.85, "written agreement", r"without fee and without a written agreement is hereby granted"),
    ("python", 70, 0.85, "python agreement", r"this licen[sc]e agreement is between the python software foundation"),
    ("openssl", 72, 0.9, "openssl toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", 70, 0.85, "php freely", r"this product includes php software freely available"),
    ("artistic", 70, 0.85, "package standard", r"you may make and give away verbatim copies of the source form of the standard version of this package"),
    ("artistic", 66, 0.8, "perl itself", r"(?:you can redistribute it and or modify it )?under the same terms as perl itself"),
    ("vim", 70, 0.8, "vim charityware", r"vim is charityware"),
    ("curl", 72, 0.85, "curl", r"curl licen[sc]e"),
    ("json", 71, 0.85, "evil", r"the software shall be used for good not evil"),
    ("ofl", 72, 0.9, "font sil", r"this font software is licensed under the sil open font licen[sc]e"),
    ("ofl", 66, 0.8, "reserved font", r"no modified version of the font software may use the reserved font names?"),
    ("libpng", 70, 0.8, "png", r"png reference library licen[sc]e"),
    ("libpng", 70, 0.8, "libpng", r"libpng licen[sc]e"),
    ("icu", 70, 0.8, "icu", r"icu licen[sc]e"),
    ("upl", 70, 0.85, "permissive universal", r"the universal permissive licen[sc]e upl"),
    # copyleft grants
    ("gpl", 71, 0.95, "redistribute foundation", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation"),
    ("gpl", 70, 0.9, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("gpl", 69, 0.85, "gnu received", r"you should have received a copy of the gnu general public licen[sc]e along with this (?:program|software|library|file)"),
    ("gpl", 68, 0.85, "gnu version", r"gnu general public licen[sc]e version [123] (?:june|february|july)? ?\d{0,2} ?(?:1989|1991|2007)"),
    ("gpl", 64, 0.75, "copyleft gnu", r"the gnu general public licen[sc]e is a free copyleft licen[sc]e for software"),
    ("gpl-2.0-or-later", 73, 0.9, "version later", r"either version 2 of the licen[sc]e or at your option any later version"),
    ("gpl-3.0-or-later", 73, 0.9, "version later", r"either version 3 of the licen[sc]e or at your option any later version"),
    ("lgpl", 72, 0.95, "lesser redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e"),
    ("lgpl", 72, 0.95, "library redistribute", r"you can redistribute it and or modify it under the terms of the gnu library general public licen[sc]e"),
    ("lgpl", 70, 0.85, "gnu received", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", 72, 0.95, "affero redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    ("agpl", 70, 0.85, "affero received", r"you should have received a copy of the gnu affero general public licen[sc]e"),
    ("gfdl", 72, 0.95, "permission documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("gfdl", 64, 0.8, "invariant cover", r"with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
    ("classpath-exception", 74, 0.9, "link exception", r"as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("gcc-exception", 74, 0.9, "gcc runtime", r"gcc runtime library exception"),
    ("mpl", 72, 0.95, "mozilla subject", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl", 70, 0.9, "mozilla contents", r"the contents of this file are subject to the mozilla public licen[sc]e"),
    ("mpl", 68, 0.8, "mpl obtain", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("npl", 70, 0.85, "netscape contents", r"the contents of this file are subject to the netscape public licen[sc]e"),
    ("epl", 72, 0.9, "eclipse accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("edl", 72, 0.9, "eclipse distribution", r"eclipse distribution licen[sc]e"),
    ("cddl", 71, 0.9, "contents distribution", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("cpl", 70, 0.85, "accompanying common", r"the accompanying program is provided under the terms of this common public licen[sc]e"),
    ("apsl", 70, 0.85, "apple original", r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source licen[sc]e"),
    ("eupl", 70, 0.9, "eupl soon", r"licensed under the eupl version 1 [12] or as soon they will be approved"),
    ("cecill", 70, 0.9, "cecill", r"(?:governed by the )?cecill(?: [abc])? licen[sc]e"),
    ("osl", 66, 0.8, "licensed open", r"licensed under the open software licen[sc]e version [123] [012]"),
    ("sleepycat", 70, 0.85, "accompanied obtain", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("odc-by", 70, 0.85, "attribution commons", r"open data commons attribution licen[sc]e"),
    ("odbl", 70, 0.85, "database commons", r"open data commons open database licen[sc]e"),
    ("pddl", 70, 0.85, "dedication domain", r"public domain dedication and licen[sc]e"),
    # Apache
    ("apache", 73, 0.95, "apache compliance", r"licensed under the apache licen[sc]e version 2 0 the licen[sc]e you may not use this file except in compliance with the licen[sc]e"),
    ("apache", 66, 0.85, "compliance except", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache", 62, 0.75, "applicable writing", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache", 70, 0.9, "asf contributor", r"licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    ("apache", 68, 0.85, "apache developed", r"this product includes software developed by the apache software foundation"),
    ("apache", 66, 0.85, "apache january", r"apache licen[sc]e version 2 0 january 2004"),
    # Creative Commons
    ("cc-by", 71, 0.9, "creative attribution", r"this work is licensed under (?:a|the) creative commons attribution(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-sa", 72, 0.9, "creative work", r"this work is licensed under (?:a|the) creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nc", 72, 0.9, "creative work", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc-by-nd", 72, 0.9, "creative work", r"this work is licensed under (?:a|the) creative commons attribution no ?derivatives(?: [1234] [05])?(?: international| unported| generic)? licen[sc]e"),
    ("cc0", 72, 0.9, "waived related", r"has waived all copyright and related or neighboring rights"),
    ("cc0", 70, 0.9, "cc0 universal", r"cc0 1 0 universal"),
    ("cc-pdm", 70, 0.85, "mark domain", r"public domain mark(?: 1 0)?"),
    # addresses
    ("cc-by", 65, 0.85, "creativecommons", r"creativecommons org licen[sc]es by [1234] [05]"),
    ("cc-by-sa", 65, 0.85, "creativecommons", r"creativecommons org licen[sc]es by sa [1234] [05]"),
    ("cc-by-nc", 65, 0.85, "creativecommons", r"creativecommons org licen[sc]es by nc [1234] [05]"),
    ("cc-by-nd", 65, 0.85, "creativecommons", r"creativecommons org licen[sc]es by nd [1234] [05]"),
    ("cc-by-nc-sa", 65, 0.85, "creativecommons", r"creativecommons org licen[sc]es by nc sa [1234] [05]"),
    ("cc-by-nc-nd", 65, 0.85, "creativecommons", r"creativecommons org licen[sc]es by nc nd [1234] [05]"),
    ("cc0", 65, 0.85, "creativecommons zero", r"creativecommons org publicdomain zero 1 0"),
    ("apache", 65, 0.85, "apache org", r"(?:www )?apache org licen[sc]es(?: licen[sc]e 2 0)?"),
    ("gpl", 65, 0.8, "gnu org", r"(?:www )?gnu org licen[sc]es gpl(?: [23] 0)?(?: html| txt)?"),
    ("lgpl", 65, 0.8, "gnu org", r"(?:www )?gnu org licen[sc]es lgpl(?: [23] [01])?(?: html| txt)?"),
    ("agpl", 65, 0.8, "gnu org", r"(?:www )?gnu org licen[sc]es agpl(?: 3 0)?(?: html| txt)?"),
    ("mpl", 65, 0.8, "mozilla org", r"(?:www )?mozilla org mpl(?: [12] [01])?"),
    ("mit", 65, 0.8, "opensource mit", r"(?:www )?opensource org licen[sc]es mit(?: licen[sc]e)?"),
    ("bsd", 65, 0.8, "opensource bsd", r"(?:www )?opensource org licen[sc]es bsd(?: [23] clause| licen[sc]e)?"),
    ("boost", 65, 0.8, "boost org", r"(?:www )?boost org licen[sc]e 1 0(?: txt)?"),
    ("ofl", 65, 0.8, "sil org", r"scripts sil org ofl"),
    ("unlicense", 65, 0.8, "unlicense org", r"unlicense org"),
    # source-available and proprietary terms
    ("busl", 72, 0.9, "change date", r"change date .{0,60}?change licen[sc]e"),
    ("sspl", 72, 0.9, "service program", r"offering the program as a service"),
    ("commons-clause", 73, 0.9, "commons clause", r"commons clause(?: licen[sc]e condition)?"),
    ("polyform", 72, 0.85, "polyform", r"polyform (?:noncommercial|small business|shield|perimeter|strict|internal use) licen[sc]e"),
    ("non-commercial", 50, 0.6, "only", r"(?:for )?non ?commercial (?:use|purposes) only"),
    ("evaluation-only", 50, 0.6, "evaluation", r"for evaluation (?:use|purposes) only"),
    ("proprietary", 45, 0.6, "confidential proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", 44, 0.6, "unauthorized copying", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("no-redistribution", 44, 0.6, "prohibited", r"(?:redistribution|reproduction) (?:in whole or in part )?is (?:strictly )?prohibited"),
    ("dual-licensed", 48, 0.6, "dual", r"dual licen[sc]ed"),
    ("public-domain", 65, 0.8, "domain", r"(?:released|dedicated|placed|is) (?:in|into|to) the public domain"),
    ("royalty-free", 30, 0.4, "royalty worldwide", r"perpetual worldwide non exclusive no charge royalty free irrevocable(?: copyright| patent)? licen[sc]e"),
    # disclaimers tell that there is a license, not which
    ("warranty-disclaimer", 26, 0.4, "warranty kind", r"the software is provided as is without warranty of any kind"),
    ("warranty-disclaimer", 25, 0.4, "warranties merchantability", r"any express or implied warranties including but not limited to the implied warranties of merchantability"),
    ("warranty-disclaimer", 25, 0.4, "warranty fitness", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("warranty-disclaimer", 24, 0.35, "liable event", r"in no event shall (?:the )?(?:authors?|copyright holders?|contributors|regents).{0,60}? be liable"),
    ("all-rights-reserved", 30, 0.6, "reserved", r"all rights reserved"),
    ("copyright", 20, 0.3, "copyright", r"copyright (?:c )?(?:19|20)\d\d"),
    ("copyright", 18, 0.3, "copyright", r"copyright (?:c )?(?:19|20)\d\d (?:19|20)\d\d"),
    ("other", 12, 0.5, "identifier spdx", r"spdx licen[sc]e identifier \S+"),
    ("other", 10, 0.5, "licensed", r"licensed under (?:the )?(?:\w+ ){1,4}licen[sc]e"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    gate: tuple[frozenset[str], ...]  # of each set one keyword must occur
    pattern: re.Pattern


def signature_rules() -> list[Rule]:
    rules = []
    for label, (keys, name, version) in FAMILIES.items():
        for priority, confidence, more, form in FORMS.values():
            if "{n} {v}" == form and not version:
                continue
            pattern = form.replace("(?: {v})?", f"(?: {version})?" if version else "").replace("(?:,? {v})?", f"(?: {version})?" if version else "").replace("{v}", version).replace("{n}", name)
            gate = [frozenset(keys.split("|"))] + ([frozenset([more])] if more else [])
            rules.append(Rule(label, priority, confidence, tuple(gate), re.compile(rf"(?<!\S)(?:{pattern})(?!\S)")))
    rules += [Rule(label, p, c, tuple(frozenset([k]) for k in gate.split()), re.compile(rf"(?<!\S)(?:{x})(?!\S)")) for label, p, c, gate, x in NOTICES]
    return rules


@dataclass(frozen=True)
class Detection:
    label: str
    start: int
    end: int
    priority: int
    confidence: float


def resolve(found: Sequence[Detection]) -> list[Detection]:
    """Detections left after suppression, in text order.

    They are taken by priority, then length, then place. The kept ones of one priority never contain each other, so sorted by
    start they are sorted by end too, and one look-up tells whether any of them contains the next detection; the kept ones of
    higher priorities are merged into disjoint intervals, where another look-up tells of an overlap.
    """
    kept: list[Detection] = []
    over: list[list[int]] = []  # disjoint intervals of higher priorities
    order = sorted(set(found), key=lambda d: (-d.priority, d.start - d.end, d.start, d.label))
    for _, level in groupby(order, key=lambda d: d.priority):
        starts, ends = [], []
        for d in level:
            at = bisect_left(over, [d.end]) - 1
            inside = bisect_right(starts, d.start)
            if (at < 0 or over[at][1] <= d.start) and not (inside and ends[inside - 1] >= d.end):
                starts.insert(inside, d.start)
                ends.insert(inside, d.end)
                kept.append(d)
        merged: list[list[int]] = []
        for start, end in sorted([*over, *map(list, zip(starts, ends, strict=True))]):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        over = merged
    return sorted(kept, key=lambda d: (d.start, d.end, d.label))


class LicenseScanner:
    def __init__(self) -> None:
        import ahocorasick

        self.rules = signature_rules()
        self.automaton = ahocorasick.Automaton()
        for word in sorted({k for r in self.rules for g in r.gate for k in g}):
            self.automaton.add_word(f" {word} ", word)
        self.automaton.make_automaton()
        gap = [b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A)]
        upper = bytes(range(0x41, 0x5B))
        self.table = bytes.maketrans(bytes(gap) + upper, b" " * len(gap) + upper.lower())
        self.phrases = [(f" {p} ".encode(), p.encode().split(), label) for p, label in PHRASES.items()]

    def words(self, text: str) -> list[bytes]:
        return text.encode().translate(self.table).split()

    def base(self, words: list[bytes], joined: bytes) -> tuple[list[int], set[str]]:
        """Start words of all places of the fixed phrases, and their labels."""
        starts, labels = [], set()
        for needle, phrase, label in self.phrases:
            if needle in joined:
                n = len(phrase)
                starts += [i for i, w in enumerate(words) if w == phrase[0] and words[i : i + n] == phrase]
                labels.add(label)
        return starts, labels

    def detections(self, joined: str) -> list[Detection]:
        seen = {word for _, word in self.automaton.iter(joined)}
        if not seen:
            return []
        found = []
        for rule in self.rules:
            if all(not g.isdisjoint(seen) for g in rule.gate):
                found += [Detection(rule.label, m.start(), m.end(), rule.priority, rule.confidence) for m in rule.pattern.finditer(joined)]
        return resolve(found)

    def scan(self, text: str) -> tuple:
        words = self.words(text)
        joined = b" " + b" ".join(words) + b" "
        starts, base = self.base(words, joined)
        kept = self.detections(joined.decode())
        labels = base | {d.label for d in kept}
        score = max([d.confidence for d in kept], default=0.7 if base else 0.0)
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


@lru_cache(maxsize=1)
def scanner() -> LicenseScanner:
    return LicenseScanner()


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of a table of (doc_id, text)."""

    def rows(batches):
        scan = scanner().scan
        for batch in batches:
            texts, ids = [t or "" for t in batch.column("text").to_pylist()], batch.column("doc_id").to_pylist()
            for a, b in slices(texts):
                yield {"doc_id": ids[a:b]} | dict(zip(COLUMNS, zip(*map(scan, texts[a:b]), strict=True), strict=True))

    return map_rows(docs.select("doc_id", "text"), rows, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
