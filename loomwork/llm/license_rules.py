"""Licence signatures: ordered rules of (label, priority, keyword, pattern).

Patterns run on lower-case text with single spaces. A rule is tried only if its keyword occurs.
Higher priority wins where one detection lies inside another; among equals the
earlier rule does. Families with versions are written once and spelled out for
each version.
"""

from __future__ import annotations

from dataclasses import dataclass

_GAP = r"[\s,;:()\"'“”/-]{1,4}"
_V = r"(?:[\s,;:(]{1,3}(?:as published by the free software foundation[\s,;:]{1,3})?(?:either )?(?:version|ver\.?|v\.?)?[\s.]{0,2})"
_LATER = r"(?: of (?:the|this) licen[cs]e)?[\s,;:)]{1,4}(?:or|and)[\s(]{1,2}(?:\(?at your option\)?[\s,]{1,2})?any later version|\+|[\s,;:)]{1,4}or[\s-]later"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str


def _version(v: str) -> str:
    """Pattern of a version: 2.0 also as 2, never the beginning of a longer one."""
    whole, _, minor = v.partition(".")
    body = whole + (r"(?:\.0)?" if minor in ("", "0") else rf"\.{minor}")
    return rf"{body}(?![\d]|\.\d)"


def _versioned(label: str, keyword: str, name: str, versions: str, later: bool = False, priority: int = 60) -> list[Rule]:
    """The name alone, with each version, and where asked for "or any later version"."""
    out = []
    for v in versions.split():
        exact = rf"{name}{_V}{_version(v)}"
        if later:
            out.append(Rule(f"{label}-{v}-or-later", priority + 30, keyword, rf"{exact}(?:{_LATER})"))
        out.append(Rule(f"{label}-{v}", priority + 20, keyword, exact))
    out.append(Rule(label, priority, keyword, name))
    return out


def _spdx(ids: str) -> list[Rule]:
    """Each identifier after an SPDX tag."""
    return [Rule(i.lower(), 95, "spdx", rf"spdx-license-identifier\s*:\s*\(?{i.lower().replace('.', r'\.').replace('+', r'\+')}(?![\w.+-])") for i in ids.split()]


def _creative_commons() -> list[Rule]:
    out = []
    words = {"by": "attribution", "nc": "non-?commercial", "nd": "no-?deriv(?:ative)?s(?: works)?", "sa": "share-?alike"}
    for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        parts = kind.split("-")
        short = r"cc[\s-]{1,2}" + r"[\s-]{1,2}".join(parts) + r"(?![\w]|-(?:nc|nd|sa)\b)"
        long = r"creative commons " + r"[\s,-]{1,3}".join(words[p] for p in parts) + r"(?![\s,-]{1,3}(?:non-?commercial|no-?deriv|share-?alike))"
        url = rf"creativecommons\.org/licenses/{kind}/"
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            at = rf"(?:[\s-]{{0,2}}(?:licen[cs]e[\s,]{{0,2}})?(?:v|version)?\s?){_version(v)}"
            out.append(Rule(f"cc-{kind}-{v}", 85, "cc", short + at))
            out.append(Rule(f"cc-{kind}-{v}", 85, "creative commons", rf"{long}[\s,]{{0,2}}(?:international|unported|generic)?{at}"))
            out.append(Rule(f"cc-{kind}-{v}", 90, "creativecommons", url + _version(v)))
        out.append(Rule(f"cc-{kind}", 65, "cc", short))
        out.append(Rule(f"cc-{kind}", 65, "creative commons", long))
    out.append(Rule("cc0-1.0", 85, "cc0", r"\bcc0(?:[\s-]{1,2}1\.0)?(?: universal)?(?![\w])"))
    out.append(Rule("cc0-1.0", 90, "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0"))
    out.append(Rule("cc-pdm-1.0", 90, "creativecommons", r"creativecommons\.org/publicdomain/mark/1\.0"))
    out.append(Rule("creative-commons", 30, "creative commons", r"creative commons(?: public)? licen[cs]e"))
    return out


def _rules() -> list[Rule]:
    gnu = r"(?:gnu )"
    lic = r" licen[cs]e"
    out: list[Rule] = []
    # GNU
    out += _versioned("lgpl", "general public", rf"{gnu}?(?:lesser|library) general public{lic}", "2.0 2.1 3.0", True, 62)
    out += _versioned("agpl", "general public", rf"{gnu}?affero general public{lic}", "1.0 3.0", True, 62)
    out += _versioned("gpl", "general public", rf"(?<!lesser )(?<!library )(?<!affero ){gnu}?general public{lic}", "1.0 2.0 3.0", True)
    out += _versioned("gfdl", "free documentation", rf"{gnu}?free documentation{lic}", "1.1 1.2 1.3", True)
    for short in ("lgpl", "agpl", "gpl"):
        for v in ("2.0", "2.1", "3.0"):
            if (short, v) in (("agpl", "2.0"), ("agpl", "2.1"), ("gpl", "2.1")):
                continue
            head = rf"(?<![\w-]){short}[\s-]?(?:v|version )?{_version(v)}"
            out.append(Rule(f"{short}-{v}-or-later", 88, short, rf"{head}(?:{_LATER})"))
            out.append(Rule(f"{short}-{v}-only", 88, short, rf"{head}[\s-]only(?!\w)"))
            out.append(Rule(f"{short}-{v}", 78, short, head))
        out.append(Rule(short, 50, short, rf"(?<![\w-]){short}(?![\w-])"))
    for name in ("classpath", "bison", "autoconf", "font", "gcc runtime library", "linux syscall", "openssl", "llvm"):
        out.append(Rule(f"{name.replace(' ', '-')}-exception", 70, "exception", rf"{name}(?: linking)? exception"))
    # Apache, MIT, BSD, ISC and their kin
    out += _versioned("apache", "apache", rf"apache(?: software)?{lic}", "1.0 1.1 2.0")
    out.append(Rule("apache-2.0", 90, "apache.org", r"apache\.org/licenses/license-2\.0"))
    out.append(Rule("apache-2.0", 75, "apache", r"(?<![\w-])apache[\s-]2(?:\.0)?(?![\w.]\d)(?=[\s,.;)]|$)"))
    out += [
        Rule("mit", 70, "mit licen", rf"(?<![\w-])(?:the )?mit{lic}"),
        Rule("mit", 60, "mit", r"(?<![\w-])mit[\s/-](?:x11|expat|style)(?![\w])"),
        Rule("mit", 80, "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        Rule("mit", 80, "opensource.org", r"opensource\.org/licenses/mit(?!-)"),
        Rule("mit-0", 82, "mit-0", r"(?<![\w-])mit-0(?![\w-])"),
        Rule("mit-0", 84, "no attribution", rf"mit no attribution(?:{lic})?"),
        Rule("x11", 70, "x11", rf"(?<![\w-])x11{lic}"),
        Rule("expat", 70, "expat", rf"(?<![\w-])expat{lic}"),
        Rule("isc", 72, "isc", rf"(?<![\w-])isc{lic}"),
        Rule("isc", 80, "permission to use, copy", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
        Rule("0bsd", 84, "0bsd", r"(?<![\w-])0bsd(?![\w-])"),
        Rule("0bsd", 84, "zero", rf"zero[\s-]clause bsd(?:{lic})?"),
        Rule("bsd-1-clause", 84, "clause", rf"(?:bsd[\s-](?:1|one)[\s-]clause|(?:1|one)[\s-]clause bsd)(?:{lic})?"),
        Rule("bsd-2-clause", 84, "clause", rf"(?:bsd[\s-](?:2|two)[\s-]clause|(?:2|two)[\s-]clause bsd)(?:{lic})?"),
        Rule("bsd-3-clause", 84, "clause", rf"(?:bsd[\s-](?:3|three)[\s-]clause|(?:3|three)[\s-]clause bsd)(?:{lic})?"),
        Rule("bsd-4-clause", 84, "clause", rf"(?:bsd[\s-](?:4|four)[\s-]clause|(?:4|four)[\s-]clause bsd)(?:{lic})?"),
        Rule("bsd-2-clause", 82, "simplified", rf"simplified bsd{lic}"),
        Rule("bsd-2-clause", 82, "freebsd", rf"freebsd{lic}"),
        Rule("bsd-3-clause", 82, "bsd", rf"(?:new|modified|revised) bsd{lic}"),
        Rule("bsd-4-clause", 82, "bsd", rf"(?:original|old) bsd{lic}"),
        Rule("bsd-3-clause-clear", 86, "clear bsd", rf"(?:the )?clear bsd{lic}"),
        Rule("bsd", 60, "bsd", rf"(?<![\w-])bsd(?:[\s-]style)?{lic}"),
        Rule("bsd", 75, "redistribution and use", r"redistribution and use in source and binary forms, with or without modification"),
        Rule("bsd-4-clause", 78, "advertising materials", r"all advertising materials mentioning features or use of this software"),
        Rule("zlib", 72, "zlib", rf"(?<![\w-])zlib(?:/libpng)?{lic}"),
        Rule("libpng", 72, "libpng", rf"(?<![\w/-])libpng{lic}"),
        Rule("unlicense", 80, "unlicense", r"(?<![\w-])(?:the )?unlicense(?![\w])"),
        Rule("unlicense", 80, "unencumbered", r"free and unencumbered software released into the public domain"),
        Rule("wtfpl", 84, "wtfpl", r"(?<![\w-])wtfpl(?![\w])"),
        Rule("wtfpl", 84, "do what the", rf"do what the f\S{{2,4}} you want to public{lic}"),
        Rule("beerware", 76, "beer", rf"beer-?ware(?:{lic})?"),
        Rule("postgresql", 76, "postgresql", rf"postgresql{lic}"),
        Rule("ncsa", 76, "ncsa", r"(?:university of illinois/)?ncsa open source licen[cs]e"),
        Rule("curl", 76, "curl", rf"(?<![\w-])curl{lic}"),
        Rule("ijg", 76, "jpeg group", rf"independent jpeg group(?:'s)?{lic}"),
        Rule("ftl", 76, "freetype", rf"freetype(?: project)?{lic}"),
        Rule("openssl", 76, "openssl", rf"openssl{lic}"),
        Rule("ssleay", 76, "ssleay", rf"ssleay{lic}"),
        Rule("vim", 76, "vim", rf"(?<![\w-])vim{lic}"),
        Rule("ruby", 76, "ruby", rf"(?<![\w-])ruby(?:'s)?{lic}"),
        Rule("hpnd", 76, "historical permission", r"historical permission notice and disclaimer"),
        Rule("naist", 70, "naist", rf"naist{lic}"),
        Rule("icu", 76, "icu", rf"(?<![\w-])icu{lic}"),
        Rule("unicode", 76, "unicode", rf"unicode(?:,? inc\.?)?{lic}"),
        Rule("w3c", 76, "w3c", r"w3c(?:®)? software(?: notice)?(?: and)?(?: document)? (?:notice and )?licen[cs]e"),
        Rule("afl-general", 50, "academic", rf"academic free{lic}"),
        Rule("upl-1.0", 80, "universal permissive", rf"universal permissive{lic}"),
        Rule("blueoak-1.0.0", 80, "blue oak", rf"blue oak model{lic}"),
        Rule("json", 76, "shall be used for good", r"the software shall be used for good, not evil"),
        Rule("fair", 72, "fair licen", rf"(?<![\w-])fair{lic}"),
        Rule("miros", 72, "miros", rf"miros{lic}"),
        Rule("mulan-psl-2.0", 80, "mulan", r"mulan (?:psl|permissive software licen[cs]e)[\s,]{1,2}(?:v|version )?2"),
        Rule("mulan-psl-1.0", 78, "mulan", r"mulan (?:psl|permissive software licen[cs]e)"),
    ]
    # copyleft families with versions
    families = (
        ("mpl", "mozilla public", rf"mozilla public{lic}", "1.0 1.1 2.0"),
        ("epl", "eclipse public", rf"eclipse public{lic}", "1.0 2.0"),
        ("edl", "eclipse distribution", rf"eclipse distribution{lic}", "1.0"),
        ("cddl", "common development", rf"common development and distribution{lic}", "1.0 1.1"),
        ("cpl", "common public", rf"common public{lic}", "1.0"),
        ("cpal", "attribution licen", rf"common public attribution{lic}", "1.0"),
        ("ipl", "ibm public", rf"ibm public{lic}", "1.0"),
        ("npl", "netscape public", rf"netscape public{lic}", "1.0 1.1"),
        ("spl", "sun public", rf"sun public{lic}", "1.0"),
        ("apsl", "apple public", rf"apple public source{lic}", "1.0 1.1 1.2 2.0"),
        ("artistic", "artistic", rf"(?<![\w-])artistic{lic}", "1.0 2.0"),
        ("afl", "academic free", rf"academic free{lic}", "1.1 1.2 2.0 2.1 3.0"),
        ("osl", "open software", rf"open software{lic}", "1.0 1.1 2.0 2.1 3.0"),
        ("eupl", "european union", rf"european union public{lic}", "1.0 1.1 1.2"),
        ("ofl", "open font", rf"(?:sil )?open font{lic}", "1.0 1.1"),
        ("bsl", "boost", rf"boost software{lic}", "1.0"),
        ("busl", "business source", rf"business source{lic}", "1.0 1.1"),
        ("sspl", "server side", rf"server side public{lic}", "1.0"),
        ("elastic", "elastic", rf"(?<![\w-])elastic{lic}", "1.0 2.0"),
        ("psf", "python", rf"(?<![\w-])(?:python software foundation|psf){lic}", "2.0"),
        ("php", "php", rf"(?<![\w-])php{lic}", "3.0 3.01"),
        ("zpl", "zope", rf"zope public{lic}", "1.1 2.0 2.1"),
        ("qpl", "q public", rf"(?<![\w-])q public{lic}", "1.0"),
        ("lppl", "latex", rf"latex project public{lic}", "1.0 1.1 1.2 1.3"),
        ("rpl", "reciprocal public", rf"reciprocal public{lic}", "1.1 1.5"),
        ("ms-pl", "microsoft public", rf"microsoft public{lic}", "1.0"),
        ("ms-rl", "microsoft reciprocal", rf"microsoft reciprocal{lic}", "1.0"),
        ("cecill", "cecill", r"(?<![\w-])cecill(?![\w])", "1.0 1.1 2.0 2.1"),
        ("odbl", "open database", rf"open (?:data commons )?(?:open )?database{lic}", "1.0"),
        ("odc-by", "data commons", rf"open data commons attribution{lic}", "1.0"),
        ("pddl", "public domain dedication", r"public domain dedication and licen[cs]e", "1.0"),
        ("cdla-permissive", "community data", rf"community data{lic} agreement[\s–-]{{1,3}}permissive", "1.0 2.0"),
        ("cdla-sharing", "community data", rf"community data{lic} agreement[\s–-]{{1,3}}sharing", "1.0"),
        ("ogl-uk", "open government", rf"open government{lic}", "1.0 2.0 3.0"),
        ("openrail-m", "rail", rf"(?<![\w-])(?:open|bigscience |creativeml )?open ?rail(?:-m)?{lic}", "1.0"),
        ("nposl", "non-profit", rf"non-profit open software{lic}", "3.0"),
        ("ecl", "educational community", rf"educational community{lic}", "1.0 2.0"),
        ("efl", "eiffel", rf"eiffel forum{lic}", "1.0 2.0"),
        ("opl", "open publication", rf"open publication{lic}", "1.0"),
        ("ocl", "open content", rf"open content{lic}", "1.0"),
        ("hippocratic", "hippocratic", rf"hippocratic{lic}", "2.1 3.0"),
        ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict) licen[cs]e", "1.0"),
        ("liliq", "québec", r"licence libre du québec", "1.1"),
        ("nasa", "nasa", r"nasa open source agreement", "1.3"),
        ("oclc", "oclc", rf"oclc research public{lic}", "2.0"),
        ("rpsl", "realnetworks", rf"realnetworks public source{lic}", "1.0"),
        ("vsl", "vovida", rf"vovida software{lic}", "1.0"),
        ("watcom", "watcom", rf"sybase open watcom public{lic}", "1.0"),
    )
    for label, keyword, name, versions in families:
        out += _versioned(label, keyword, name, versions)
    out += _creative_commons()
    out += _spdx(
        "MIT Apache-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only"
        " LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later BSD-2-Clause BSD-3-Clause ISC MPL-2.0 EPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0"
        " Unlicense Zlib BSL-1.0 0BSD Artistic-2.0 OFL-1.1 MIT-0 CDDL-1.0 EUPL-1.2 WTFPL"
    )
    # notices without a licence
    out += [
        Rule("all-rights-reserved", 40, "all rights reserved", r"all rights reserved"),
        Rule("all-rights-reserved", 40, "rechte vorbehalten", r"alle rechte vorbehalten"),
        Rule("all-rights-reserved", 40, "droits réservés", r"tous droits réservés"),
        Rule("all-rights-reserved", 40, "derechos reservados", r"todos los derechos reservados"),
        Rule("public-domain", 45, "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
        Rule("proprietary", 45, "proprietary", r"proprietary and confidential|confidential and proprietary"),
        Rule("proprietary", 45, "unauthorized", r"unauthorized (?:copying|reproduction|distribution|use)[^.]{0,60}(?:prohibited|forbidden)"),
        Rule("no-commercial-use", 45, "commercial", r"(?:for )?non-?commercial (?:use|purposes) only|not for commercial use"),
        Rule("copyright", 20, "copyright", r"copyright (?:\(c\)|©)?\s?(?:19|20)\d\d"),
        Rule("copyright", 20, "©", r"©\s?(?:copyright )?(?:19|20)\d\d"),
        Rule("copyright", 20, "(c)", r"(?<!copyright )\(c\)\s?(?:copyright )?(?:19|20)\d\d"),
    ]
    return out


RULES: tuple[Rule, ...] = tuple(_rules())

#: Fixed values of the base task: a phrase's words and its label.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
