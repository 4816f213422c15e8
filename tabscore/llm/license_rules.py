"""Ordered signature rules for license statements.

A rule is ``(label, priority, keyword, regex)``.  The regex runs over a text's lower-cased words joined by one space,
so punctuation, case and line breaks never matter; it starts and ends at word borders.  ``keyword`` is a literal
that every match holds: the regex runs only on texts that hold it.  Higher priorities win overlaps.
"""

from __future__ import annotations

#: Base phrases and their labels (fixed values).
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

TAG, TEXT, GRANT, URL, NAME, HINT = 95, 90, 80, 75, 60, 40

#: label, SPDX words (regex), names (regexes); "V" stands for an optional "version"/"v" before a number.
FAMILIES = [
    ("mit", "mit(?: 0| cmu| modern variant)?", ["mit licen[sc]e", "(?:the )?expat licen[sc]e", "mit x11 licen[sc]e"]),
    ("x11", "x11", ["x11 licen[sc]e", "x consortium licen[sc]e"]),
    ("apache-2.0", "apache 2 0", ["apache (?:software )?licen[sc]e V2(?: 0)?", "apache 2(?: 0)? licen[sc]e", "asl V2(?: 0)?"]),
    ("apache-1.1", "apache 1 1", ["apache (?:software )?licen[sc]e V1 1"]),
    ("apache-1.0", "apache 1 0", ["apache (?:software )?licen[sc]e V1 0"]),
    ("gpl-3.0", "gpl 3 0(?: only| or later)?", ["(?:gnu )?general public licen[sc]e V3(?: 0)?", "(?:gnu )?gpl ?V3(?: 0)?", "gplv3(?: or later)?"]),
    ("gpl-2.0", "gpl 2 0(?: only| or later)?", ["(?:gnu )?general public licen[sc]e V2(?: 0)?", "(?:gnu )?gpl ?V2(?: 0)?", "gplv2(?: or later)?"]),
    ("gpl-1.0", "gpl 1 0(?: only| or later)?", ["(?:gnu )?general public licen[sc]e V1(?: 0)?", "gplv1"]),
    ("lgpl-3.0", "lgpl 3 0(?: only| or later)?", ["(?:gnu )?lesser general public licen[sc]e V3(?: 0)?", "(?:gnu )?lgpl ?V3(?: 0)?", "lgplv3"]),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", ["(?:gnu )?lesser general public licen[sc]e V2 1", "(?:gnu )?lgpl ?V2 1", "lgplv2 1"]),
    ("lgpl-2.0", "lgpl 2 0(?: only| or later)?", ["(?:gnu )?library general public licen[sc]e V2(?: 0)?", "lgplv2"]),
    ("lgpl", "lgpl", ["(?:gnu )?(?:lesser|library) general public licen[sc]e", "(?:gnu )?lgpl"]),
    ("agpl-3.0", "agpl 3 0(?: only| or later)?", ["(?:gnu )?affero general public licen[sc]e V3(?: 0)?", "(?:gnu )?agpl ?V3(?: 0)?", "agplv3"]),
    ("agpl-1.0", "agpl 1 0(?: only| or later)?", ["affero general public licen[sc]e V1(?: 0)?", "agplv1"]),
    ("agpl", "agpl", ["(?:gnu )?affero general public licen[sc]e", "(?:gnu )?agpl"]),
    ("gfdl-1.3", "gfdl 1 3(?: only| or later)?", ["(?:gnu )?free documentation licen[sc]e V1 3"]),
    ("gfdl-1.2", "gfdl 1 2(?: only| or later)?", ["(?:gnu )?free documentation licen[sc]e V1 2"]),
    ("gfdl", "gfdl", ["(?:gnu )?free documentation licen[sc]e", "(?:gnu )?fdl"]),
    ("bsd-2-clause", "bsd 2 clause", ["bsd 2 clause(?: licen[sc]e)?", "2 clause bsd(?: licen[sc]e)?", "simplified bsd licen[sc]e", "freebsd licen[sc]e"]),
    ("bsd-3-clause", "bsd 3 clause(?: clear)?", ["bsd 3 clause(?: licen[sc]e)?", "3 clause bsd(?: licen[sc]e)?", "(?:new|revised|modified) bsd licen[sc]e"]),
    ("bsd-4-clause", "bsd 4 clause", ["bsd 4 clause(?: licen[sc]e)?", "4 clause bsd(?: licen[sc]e)?", "original bsd licen[sc]e"]),
    ("0bsd", "0bsd", ["zero clause bsd(?: licen[sc]e)?", "bsd zero clause licen[sc]e", "0bsd licen[sc]e"]),
    ("bsd", "bsd", ["bsd (?:style )?licen[sc]e"]),
    ("isc", "isc", ["isc licen[sc]e"]),
    ("mpl-2.0", "mpl 2 0", ["mozilla public licen[sc]e V2(?: 0)?", "mpl V2(?: 0)?"]),
    ("mpl-1.1", "mpl 1 1", ["mozilla public licen[sc]e V1 1", "mpl V1 1"]),
    ("mpl-1.0", "mpl 1 0", ["mozilla public licen[sc]e V1 0"]),
    ("epl-2.0", "epl 2 0", ["eclipse public licen[sc]e V2(?: 0)?", "epl V2(?: 0)?"]),
    ("epl-1.0", "epl 1 0", ["eclipse public licen[sc]e V1(?: 0)?", "epl V1(?: 0)?"]),
    ("cddl-1.1", "cddl 1 1", ["common development and distribution licen[sc]e V1 1"]),
    ("cddl-1.0", "cddl 1 0", ["common development and distribution licen[sc]e(?: V1(?: 0)?)?", "cddl(?: V1(?: 0)?)?"]),
    ("cpl-1.0", "cpl 1 0", ["common public licen[sc]e(?: V1(?: 0)?)?"]),
    ("ipl-1.0", "ipl 1 0", ["ibm public licen[sc]e(?: V1(?: 0)?)?"]),
    ("eupl-1.2", "eupl 1 2", ["european union public licen[sc]e V1 2", "eupl V1 2"]),
    ("eupl-1.1", "eupl 1 1", ["european union public licen[sc]e V1 1", "eupl V1 1"]),
    ("osl-3.0", "osl 3 0", ["open software licen[sc]e V3(?: 0)?"]),
    ("afl-3.0", "afl 3 0", ["academic free licen[sc]e V3(?: 0)?"]),
    ("afl-2.1", "afl 2 1", ["academic free licen[sc]e V2 1"]),
    ("artistic-2.0", "artistic 2 0", ["artistic licen[sc]e V2(?: 0)?"]),
    ("artistic-1.0", "artistic 1 0(?: perl| cl8)?", ["artistic licen[sc]e(?: V1(?: 0)?)?", "perl artistic licen[sc]e"]),
    ("bsl-1.0", "bsl 1 0", ["boost software licen[sc]e(?: V1(?: 0)?)?"]),
    ("busl-1.1", "busl 1 1", ["business source licen[sc]e(?: V1 1)?"]),
    ("sspl-1.0", "sspl 1 0", ["server side public licen[sc]e(?: V1)?"]),
    ("elastic-2.0", "elastic 2 0", ["elastic licen[sc]e(?: V2(?: 0)?)?"]),
    ("unlicense", "unlicense", ["the unlicense"]),
    ("wtfpl", "wtfpl", ["do what the f[a-z]* you want to public licen[sc]e", "wtfpl"]),
    ("zlib", "zlib", ["zlib(?: libpng)? licen[sc]e"]),
    ("libpng", "libpng(?: 2 0)?", ["libpng licen[sc]e", "png reference library licen[sc]e"]),
    ("cc0-1.0", "cc0 1 0", ["cc0(?: 1 0)?(?: universal)?", "creative commons zero"]),
    ("cc-by-4.0", "cc by 4 0", ["creative commons attribution 4 0(?: international)?", "cc by 4 0"]),
    ("cc-by-3.0", "cc by 3 0", ["creative commons attribution 3 0(?: unported)?", "cc by 3 0"]),
    ("cc-by-2.0", "cc by 2 0", ["creative commons attribution 2 0(?: generic)?", "cc by 2 0"]),
    ("cc-by-sa-4.0", "cc by sa 4 0", ["creative commons attribution share ?alike 4 0(?: international)?", "cc by sa 4 0"]),
    ("cc-by-sa-3.0", "cc by sa 3 0", ["creative commons attribution share ?alike 3 0(?: unported)?", "cc by sa 3 0"]),
    ("cc-by-nc-4.0", "cc by nc 4 0", ["creative commons attribution non ?commercial 4 0(?: international)?", "cc by nc 4 0"]),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", ["creative commons attribution non ?commercial share ?alike 4 0(?: international)?", "cc by nc sa 4 0"]),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", ["creative commons attribution non ?commercial no ?derivatives 4 0(?: international)?", "cc by nc nd 4 0"]),
    ("cc-by-nd-4.0", "cc by nd 4 0", ["creative commons attribution no ?derivatives 4 0(?: international)?", "cc by nd 4 0"]),
    ("odbl-1.0", "odbl 1 0", ["open (?:data commons open )?database licen[sc]e(?: V1 0)?", "odbl"]),
    ("odc-by-1.0", "odc by 1 0", ["open data commons attribution licen[sc]e(?: V1 0)?"]),
    ("pddl-1.0", "pddl 1 0", ["public domain dedication and licen[sc]e(?: V1 0)?"]),
    ("ofl-1.1", "ofl 1 1", ["sil open font licen[sc]e(?: V1 1)?", "open font licen[sc]e(?: V1 1)?"]),
    ("psf-2.0", "psf 2 0", ["python software foundation licen[sc]e(?: V2)?", "psf licen[sc]e(?: agreement)?"]),
    ("python-2.0", "python 2 0", ["python licen[sc]e V2(?: 0)?"]),
    ("php-3.01", "php 3 01", ["php licen[sc]e(?: V3 01)?"]),
    ("ruby", "ruby", ["ruby licen[sc]e"]),
    ("vim", "vim", ["vim licen[sc]e"]),
    ("openssl", "openssl", ["openssl licen[sc]e", "ssleay licen[sc]e"]),
    ("curl", "curl", ["curl licen[sc]e"]),
    ("ncsa", "ncsa", ["university of illinois ncsa open source licen[sc]e", "ncsa open source licen[sc]e"]),
    ("postgresql", "postgresql", ["postgresql licen[sc]e"]),
    ("ms-pl", "ms pl", ["microsoft public licen[sc]e"]),
    ("ms-rl", "ms rl", ["microsoft reciprocal licen[sc]e"]),
    ("w3c", "w3c", ["w3c software (?:and document )?(?:notice and )?licen[sc]e"]),
    ("upl-1.0", "upl 1 0", ["universal permissive licen[sc]e(?: V1(?: 0)?)?"]),
    ("mulanpsl-2.0", "mulanpsl 2 0", ["mulan permissive software licen[sc]e(?: V2)?"]),
    ("blueoak-1.0.0", "blueoak 1 0 0", ["blue oak model licen[sc]e(?: 1 0 0)?"]),
    ("cecill-2.1", "cecill 2 1", ["cecill (?:free software )?licen[sc]e(?: agreement)?(?: V2 1)?"]),
    ("lppl-1.3c", "lppl 1 3c", ["latex project public licen[sc]e(?: V1 3c?)?"]),
    ("qpl-1.0", "qpl 1 0", ["q public licen[sc]e(?: V1 0)?"]),
    ("sleepycat", "sleepycat", ["sleepycat licen[sc]e"]),
    ("watcom-1.0", "watcom 1 0", ["sybase open watcom public licen[sc]e(?: V1 0)?"]),
    ("zpl-2.1", "zpl 2 1", ["zope public licen[sc]e(?: V2 1)?"]),
    ("beerware", "beerware", ["beer ?ware licen[sc]e"]),
    ("json", "json", ["json licen[sc]e"]),
    ("hpnd", "hpnd", ["historical permission notice and disclaimer"]),
    ("naist-2003", "naist 2003", ["naist 2003 licen[sc]e"]),
    ("gpl", "gpl", ["gnu gpl", "gnu general public licen[sc]e", "general public licen[sc]e"]),
    ("apache", "apache", ["apache (?:software )?licen[sc]e"]),
]

#: Sentences of license texts: label, priority, keyword, regex.
SENTENCES = [
    ("mit", TEXT, "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", HINT, "the above copyright notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", TEXT, "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", HINT, "permission to use copy modify", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", HINT, "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", TEXT, "to endorse or promote", "neither the name of .{1,120}? may be used to endorse or promote products"),
    ("bsd-4-clause", TEXT, "advertising materials mentioning", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", TEXT, "you may not use this file except", "you may not use this file except in compliance with the licen[sc]e"),
    ("gpl", TEXT, "this program is free software", "this program is free software you can redistribute it and or modify it"),
    ("gpl", TEXT, "you should have received a copy", "you should have received a copy of the gnu general public licen[sc]e"),
    ("lgpl", TEXT, "you should have received a copy", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", TEXT, "you should have received a copy", "you should have received a copy of the gnu affero general public licen[sc]e"),
    ("lgpl", TEXT, "this library is free software", "this library is free software you can redistribute it and or modify it"),
    ("mpl-2.0", TEXT, "this source code form", "this source code form is subject to the terms of the mozilla public licen[sc]e v ?2 0"),
    ("mpl-1.1", TEXT, "the contents of this file", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("cddl-1.0", TEXT, "the contents of this file", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("epl-1.0", TEXT, "this program and the accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v ?1 0"),
    ("epl-2.0", TEXT, "this program and the accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v? ?2 0"),
    ("unlicense", TEXT, "released into the public domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", HINT, "public domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("zlib", TEXT, "this software is provided as is", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("bsl-1.0", TEXT, "boost software license", "distributed under the boost software license version 1 0"),
    ("beerware", TEXT, "buy me a beer", "you can buy me a beer in return"),
    ("wtfpl", TEXT, "you just do what", "you just do what the f[a-z]* you want to"),
    ("json", TEXT, "used for good not evil", "the software shall be used for good not evil"),
    ("cc0-1.0", TEXT, "waived all copyright", "waived all copyright and related or neighboring rights"),
    ("proprietary", HINT, "all rights reserved", "all rights reserved"),
    ("proprietary", TEXT, "confidential and proprietary", "confidential and proprietary(?: information)?"),
    ("commercial", NAME, "commercial licen", "commercial licen[sc]e(?: agreement)?"),
    ("eula", NAME, "end user licen", "end user licen[sc]e agreement"),
]

#: Words of well-known addresses of licenses: label, regex.
ADDRESSES = [
    ("mit", "opensource org licenses mit(?: license php)?"), ("isc", "opensource org licenses isc"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause"), ("bsd-3-clause", "opensource org licenses bsd 3 clause"),
    ("apache-2.0", "apache org licenses license 2 0"), ("gpl-3.0", "gnu org licenses gpl 3 0"),
    ("gpl-2.0", "gnu org licenses (?:old licenses )?gpl 2 0"), ("lgpl-3.0", "gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", "gnu org licenses (?:old licenses )?lgpl 2 1"), ("agpl-3.0", "gnu org licenses agpl 3 0"),
    ("gfdl-1.3", "gnu org licenses fdl 1 3"), ("gpl", "gnu org licenses"),
    ("mpl-2.0", "mozilla org mpl 2 0"), ("epl-2.0", "eclipse org legal epl 2 0"), ("epl-1.0", "eclipse org legal epl v10"),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0"), ("cc-by-4.0", "creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "creativecommons org licenses by 3 0"), ("cc-by-sa-4.0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "creativecommons org licenses by sa 3 0"), ("cc-by-nc-4.0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons org licenses by nc sa 4 0"), ("cc-by-nd-4.0", "creativecommons org licenses by nd 4 0"),
    ("unlicense", "unlicense org"), ("wtfpl", "wtfpl net"), ("bsl-1.0", "boost org license 1 0 txt"),
    ("ofl-1.1", "scripts sil org ofl"), ("odbl-1.0", "opendatacommons org licenses odbl"),
]

#: Words before a name that make it a grant.
GRANTED = "(?:licen[sc]ed|released|distributed|available|provided|published|covered) (?:under|by|with) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:gnu )?"


def literal(regex: str) -> str:
    """The longest run of plain words of a regex: every match holds it."""
    import re
    flat, depth = [], 0
    for part in re.split(r"(\(\?:|\)\??)", regex):
        if part == "(?:":
            depth += 1
        elif part.startswith(")"):
            depth -= 1
        flat.append(part if not depth and not part.startswith((")", "(?:")) else "\n")
    runs = re.split(r"\n|\[[^\]]*\][*+?]?|.\?|\.\{[^}]*\}\?|\.", re.sub(r"licen\[sc\]e", "licen\n", "".join(flat)))
    return max(runs, key=lambda x: len(x.strip())).strip()


def rules() -> list[tuple[str, int, str, str]]:
    """All rules in their order: by priority, then as written.  More words in a name rank before fewer."""
    out = list(SENTENCES) + [(label, URL, literal(r), r) for label, r in ADDRESSES]
    for label, spdx, names in FAMILIES:
        out.append((label, TAG, "spdx licen", f"spdx licen[sc]e identifier {spdx}"))
        for name in names:
            name = name.replace(" ?V", "(?: version| v)? ?").replace("V", "(?:version |v ?)?")
            out.append((label, NAME, literal(name), name))
            out.append((label, GRANT, literal(name), GRANTED + name))
    return sorted(out, key=lambda r: -r[1])
