"""Licence scan by ordered signature rules.

Rules are regular expressions of two kinds: written by hand for spellings, notices and paragraphs of licence texts, and one
per licence and form of words (identifier tag, link, grant, title with version, mention). A document is looked at only if it
holds the opening of some form or a keyword of a rule written by hand, and a rule only if the document holds one of the
rule's keywords. Both save work and never change a result: every match of a rule holds its form's opening, if it has one,
and one of its keywords. All matches of all rules give intervals; a match contained in an interval of equal or better priority
(equal intervals: of the earlier rule) is suppressed, and the labels of the rest are the document's.

Besides, base phrases are found as consecutive words; their labels always stay.

Everything is one narrow projection of the document row: no shuffle, so hot sources and copies do not matter.

Defined results: a null or empty text has no words, no labels and score 0; equal rows are scanned alike; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # in lower-cased text
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# Licences: label, keywords of the title, title, version (empty: none), identifier, link. Hand-written, lower case. Every
# match of the title holds one of the keywords, which are without blanks, as any white space may stand between words.
LICENCES = [
    ("mit", "mit|expat", r"(?:mit|expat)", "", r"mit", r"opensource\.org/licenses/mit"),
    ("mit-0", "mit", r"mit no attribution", "", r"mit-0", r"github\.com/aws/mit-0"),
    ("apache-1.1", "apache", r"apache(?: software)?", r"1\.1", r"apache-1\.1", r"apache\.org/licenses/license-1\.1"),
    ("apache-2", "apache", r"apache(?: software)?", r"2(?:\.0)?", r"apache-2\.0", r"apache\.org/licenses/license-2"),
    ("gpl-2", "gnu", r"gnu general public", r"2(?:\.0)?", r"gpl-2\.0", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"),
    ("gpl-3", "gnu", r"gnu general public", r"3(?:\.0)?", r"gpl-3\.0", r"gnu\.org/licenses/gpl-3"),
    ("gpl-2", "gpl", r"gpl", r"2(?:\.0)?", r"gplv2", r"gnu\.org/licenses/gplv2"),
    ("gpl-3", "gpl", r"gpl", r"3(?:\.0)?", r"gplv3", r"gnu\.org/licenses/gplv3"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public", r"2\.1", r"lgpl-2\.1", r"gnu\.org/licenses/old-licenses/lgpl-2\.1"),
    ("lgpl-3", "lesser", r"gnu lesser general public", r"3(?:\.0)?", r"lgpl-3\.0", r"gnu\.org/licenses/lgpl-3"),
    ("agpl-3", "affero", r"gnu affero general public", r"3(?:\.0)?", r"agpl-3\.0", r"gnu\.org/licenses/agpl"),
    ("gfdl-1.3", "documentation", r"gnu free documentation", r"1\.3", r"gfdl-1\.3", r"gnu\.org/licenses/fdl"),
    ("bsd-2", "bsd", r"(?:2-clause|simplified|freebsd) bsd", "", r"bsd-2-clause", r"opensource\.org/licenses/bsd-2"),
    ("bsd-3", "bsd", r"(?:3-clause|new|modified|revised) bsd", "", r"bsd-3-clause", r"opensource\.org/licenses/bsd-3"),
    ("bsd-4", "bsd", r"(?:4-clause|original) bsd", "", r"bsd-4-clause", r"spdx\.org/licenses/bsd-4"),
    ("0bsd", "bsd", r"(?:zero|0)-clause bsd", "", r"0bsd", r"opensource\.org/licenses/0bsd"),
    ("isc", "isc", r"(?:the )?isc", "", r"isc", r"opensource\.org/licenses/isc"),
    ("mpl-1.1", "mozilla", r"mozilla public", r"1\.1", r"mpl-1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2", "mozilla", r"mozilla public", r"2(?:\.0)?", r"mpl-2\.0", r"mozilla\.org/(?:en-us/)?mpl/2"),
    ("epl-1", "eclipse", r"eclipse public", r"1(?:\.0)?", r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl-2", "eclipse", r"eclipse public", r"2(?:\.0)?", r"epl-2\.0", r"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    ("edl-1", "eclipse", r"eclipse distribution", r"1(?:\.0)?", r"edl-1\.0", r"eclipse\.org/org/documents/edl-v10"),
    ("cddl-1", "development", r"common development and distribution", r"1(?:\.0)?", r"cddl-1\.0", r"opensource\.org/licenses/cddl-1"),
    ("cpl-1", "common", r"common public", r"1(?:\.0)?", r"cpl-1\.0", r"opensource\.org/licenses/cpl1"),
    ("artistic-1", "artistic", r"artistic", r"1(?:\.0)?", r"artistic-1\.0", r"opensource\.org/licenses/artistic-1"),
    ("artistic-2", "artistic", r"artistic", r"2(?:\.0)?", r"artistic-2\.0", r"opensource\.org/licenses/artistic-2"),
    ("bsl-1", "boost", r"boost software", r"1(?:\.0)?", r"bsl-1\.0", r"boost\.org/license_1_0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl|want", r"(?:wtfpl|do what the f\S* you want to public)", r"2", r"wtfpl", r"wtfpl\.net"),
    ("zlib", "zlib", r"zlib(?:/libpng)?", "", r"zlib", r"opensource\.org/licenses/zlib"),
    ("psf-2", "python", r"python software foundation", r"2", r"psf-2\.0", r"docs\.python\.org/3/license"),
    ("postgresql", "postgresql", r"postgresql", "", r"postgresql", r"postgresql\.org/about/licence"),
    ("ofl-1.1", "font", r"sil open font", r"1\.1", r"ofl-1\.1", r"scripts\.sil\.org/ofl"),
    ("afl-3", "academic", r"academic free", r"3(?:\.0)?", r"afl-3\.0", r"opensource\.org/licenses/afl-3"),
    ("osl-3", "software", r"open software", r"3(?:\.0)?", r"osl-3\.0", r"opensource\.org/licenses/osl-3"),
    ("eupl-1.2", "european", r"european union public", r"1\.2", r"eupl-1\.2", r"joinup\.ec\.europa\.eu/\S*eupl"),
    ("ms-pl", "microsoft", r"microsoft public", "", r"ms-pl", r"opensource\.org/licenses/ms-pl"),
    ("upl-1", "universal", r"universal permissive", r"1(?:\.0)?", r"upl-1\.0", r"opensource\.org/licenses/upl"),
    ("ncsa", "illinois", r"university of illinois/ncsa open source", "", r"ncsa", r"opensource\.org/licenses/ncsa"),
    ("odbl-1", "database", r"open (?:data commons open )?database", r"1(?:\.0)?", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("cc0-1", "cc0", r"cc0", r"1(?:\.0)?", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by", "cc|creative", r"(?:cc by|cc-by|creative commons attribution)(?![- ](?:n|s))", r"[1-4]\.0", r"cc-by-[1-4]\.0", r"creativecommons\.org/licenses/by/"),
    ("cc-by-sa", "cc", r"(?:cc by-sa|cc-by-sa)", r"[1-4]\.0", r"cc-by-sa-[1-4]\.0", r"creativecommons\.org/licenses/by-sa/"),
    ("cc-by-nd", "cc", r"(?:cc by-nd|cc-by-nd)", r"[1-4]\.0", r"cc-by-nd-[1-4]\.0", r"creativecommons\.org/licenses/by-nd/"),
    ("cc-by-nc", "cc", r"(?:cc by-nc|cc-by-nc)(?!-)", r"[1-4]\.0", r"cc-by-nc-[1-4]\.0", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nc-sa", "cc", r"(?:cc by-nc-sa|cc-by-nc-sa)", r"[1-4]\.0", r"cc-by-nc-sa-[1-4]\.0", r"creativecommons\.org/licenses/by-nc-sa/"),
    ("cc-by-nc-nd", "cc", r"(?:cc by-nc-nd|cc-by-nc-nd)", r"[1-4]\.0", r"cc-by-nc-nd-[1-4]\.0", r"creativecommons\.org/licenses/by-nc-nd/"),
    ("public-domain", "domain", r"public domain", "", r"public-domain", r"creativecommons\.org/publicdomain/mark"),
]
GRANTED = r"(?:licensed|released|distributed|available|published|provided|redistribut\w+)\s+under\s+"
GRANT = GRANTED + r"(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"
NAMED = r"licen[cs]e"
TAG = "spdx-license-identifier:"
# what stands before an identifier of a tag's expression: up to five others, joined by or, and, with
OPERAND = r"(?:[\w.+-]{1,40}[\s()]{1,4}(?:or|and|with)[\s(]{1,4})?"
EXPRESSION = rf"(?<={TAG}[\s(]{{0,4}}{OPERAND * 5}"
LICENCE_WORD = rf"\s+(?:public\s+)?{NAMED}"


@dataclass(frozen=True)
class Rule:
    pattern: str
    opening: str  # a pattern found in every match
    keywords: tuple[str, ...]  # every match holds one of them
    label: str
    priority: int
    score: float


def literal(pattern: str) -> str:
    """The plain characters an identifier or link begins with."""
    return re.match(r"[^(\[\\]*", pattern.replace(r"\.", "."))[0]


def rules_of(label: str, keywords: str, title: str, version: str, identifier: str, link: str) -> list[Rule]:
    """The forms in which a licence is named, best first."""
    title = title.replace(" ", r"\s+")
    numbered = rf"(?:[,;]?\s+|[- ]?)(?:version\s+|v\.?\s*)?{version}(?!\.?\w)" if version else ""
    of_title, of_identifier, of_link = tuple(keywords.split("|")), (literal(identifier),), (literal(link),)
    host = re.escape(of_link[0].split("/")[0])
    tagged = rf"{identifier}(?:-only|-or-later|\+)?"
    forms = [
        (rf"(?<![\w.+-]){tagged}(?![.\w-]){EXPRESSION}{tagged})", NAMED, (TAG,), 0, 1.0),
        (link, host, of_link, 0, 0.95),
        (rf"{GRANT}{title}(?:{LICENCE_WORD})?{numbered}(?!\w)", GRANTED, of_title, 1, 0.9),
        (rf"\b{title}{LICENCE_WORD}{numbered}(?!\w)", NAMED, of_title, 2, 0.8),
        (rf"{NAMED}\s*[:=]\s*[\"']?{identifier}(?![.\w-])", NAMED, of_identifier, 3, 0.6),
    ]
    return [Rule(p, opening, k, label, priority, score) for p, opening, k, priority, score in forms]


# Rules written by hand: label, priority, score, keyword, pattern, for text in lower case whose white space is single blanks.
# Every match holds the keyword. Priorities as above: 0 texts, notices and tags, 1 grants, 2 titles, 3 bare mentions.
SIGNATURES = [
    # paragraphs of the texts themselves
    ("mit", 0, 1.0, "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 0, 0.95, "the above copyright", r"the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies or substantial portions of the software"),
    ("mit-0", 0, 1.0, "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the .software.\), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so\. the software is provided"),
    ("isc", 0, 1.0, "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", 0, 1.0, "permission to use", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\. the software is provided"),
    ("bsd-2", 0, 0.9, "redistribution and", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3", 0, 0.95, "neither the name", r"neither the names? of .{1,120}? nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4", 0, 0.95, "all advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2", 0, 1.0, "apache license", r"licensed under the apache license, version 2\.0 \(the .license.\)[;,] you may not use this file except in compliance with the license"),
    ("apache-2", 0, 0.9, "terms and conditions for", r"apache license version 2\.0, january 2004 http\S* terms and conditions for use, reproduction, and distribution"),
    ("apache-1.1", 0, 0.9, "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("gpl-2", 0, 1.0, "gnu general public", r"redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation[;,] (?:either )?version 2"),
    ("gpl-3", 0, 1.0, "gnu general public", r"redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation[;,] (?:either )?version 3"),
    ("gpl-3", 0, 0.95, "copyleft license for", r"the gnu general public license is a free, copyleft license for software and other kinds of works"),
    ("gpl-2", 0, 0.95, "most software are", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("lgpl-2.1", 0, 1.0, "lesser general", r"modify it under the terms of the gnu lesser general public license as published by the free software foundation[;,] (?:either )?version 2\.1"),
    ("lgpl-3", 0, 1.0, "lesser general", r"modify it under the terms of the gnu lesser general public license as published by the free software foundation[;,] (?:either )?version 3"),
    ("lgpl-2", 0, 1.0, "library general", r"under the terms of the gnu library general public license as published by the free software foundation[;,] (?:either )?version 2"),
    ("agpl-3", 0, 1.0, "affero general", r"modify it under the terms of the gnu affero general public license as published by the free software foundation[;,] (?:either )?version 3"),
    ("gfdl-1.3", 0, 1.0, "documentation license", r"copy, distribute and/or modify this document under the terms of the gnu free documentation license, version 1\.3"),
    ("gfdl-1.2", 0, 1.0, "documentation license", r"copy, distribute and/or modify this document under the terms of the gnu free documentation license, version 1\.2"),
    ("mpl-2", 0, 1.0, "source code form", r"this source code form is subject to the terms of the mozilla public license, v\. ?2\.0"),
    ("mpl-1.1", 0, 1.0, "mozilla public", r"the contents of this file are subject to the mozilla public license version 1\.1"),
    ("epl-2", 0, 1.0, "eclipse public", r"made available under the terms of the eclipse public license (?:v\.? ?)?2\.0"),
    ("epl-1", 0, 1.0, "eclipse public", r"made available under the terms of the eclipse public license (?:v\.? ?)?1\.0"),
    ("cddl-1", 0, 1.0, "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1", 0, 1.0, "boost software", r"distributed under the boost software license, version 1\.0\.? ?\(see accompanying"),
    ("bsl-1", 0, 0.95, "person or organization", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", 0, 1.0, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", 0, 1.0, "you just do", r"you just do what the f\S* you want to"),
    ("zlib", 0, 1.0, "origin of this", r"the origin of this software must not be misrepresented[;,] you must not claim that you wrote the original software"),
    ("ofl-1.1", 0, 1.0, "sil open font", r"this font software is licensed under the sil open font license, version 1\.1"),
    ("postgresql", 0, 1.0, "without a written", r"without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear"),
    ("cc0-1", 0, 0.9, "dedicated the work", r"associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1", 0, 0.95, "to the extent possible", r"to the extent possible under law, .{1,120}? has waived all copyright and related or neighboring rights"),
    ("public-domain", 0, 0.9, "public domain", r"(?:released|dedicated|placed|put|contributed) (?:in|in)?to the public domain"),
    ("artistic-2", 0, 0.95, "everyone is permitted", r"the artistic license 2\.0 copyright \(c\) 2000-2006, the perl foundation"),
    ("beerware", 0, 1.0, "in return", r"you can buy me a beer in return"),
    ("json", 0, 1.0, "good, not evil", r"the software shall be used for good, not evil"),
    ("openssl", 0, 0.95, "openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("curl", 0, 0.9, "and distribute this", r"permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\. the software is provided .as is., without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement of third party rights"),
    # bsd by its clauses
    ("bsd-3", 1, 0.9, "bsd", r"(?:licensed|released|distributed|available|published) under (?:the |a )?(?:terms of the )?(?:bsd[- ]3[- ]clause|bsd 3[- ]clause|3[- ]clause bsd|three[- ]clause bsd|new bsd|modified bsd|revised bsd)"),
    ("bsd-2", 1, 0.9, "bsd", r"(?:licensed|released|distributed|available|published) under (?:the |a )?(?:terms of the )?(?:bsd[- ]2[- ]clause|2[- ]clause bsd|two[- ]clause bsd|simplified bsd|freebsd)"),
    ("bsd-4", 1, 0.9, "bsd", r"(?:licensed|released|distributed|available|published) under (?:the |a )?(?:terms of the )?(?:bsd[- ]4[- ]clause|4[- ]clause bsd|four[- ]clause bsd|original bsd|old bsd)"),
    ("bsd-3", 2, 0.8, "bsd", r"\bbsd[- ](?:3|three)[- ]clause(?: .?(?:new|revised|modified).?)?(?: (?:clear )?licen[cs]e)?(?![\w-])"),
    ("bsd-2", 2, 0.8, "bsd", r"\bbsd[- ](?:2|two)[- ]clause(?: .?(?:simplified|freebsd).?)?(?: licen[cs]e)?(?![\w-])"),
    ("bsd-4", 2, 0.8, "bsd", r"\bbsd[- ](?:4|four)[- ]clause(?: .?(?:original|old).?)?(?: licen[cs]e)?(?![\w-])"),
    ("0bsd", 2, 0.8, "bsd", r"\bbsd zero[- ]clause(?: licen[cs]e)?(?![\w-])"),
    ("bsd-3", 2, 0.8, "bsd", r"\b(?:three[- ]clause|3[- ]clause) bsd(?:-style)?(?: licen[cs]e)?(?![\w-])"),
    ("bsd-2", 2, 0.8, "bsd", r"\b(?:two[- ]clause|2[- ]clause) bsd(?:-style)?(?: licen[cs]e)?(?![\w-])"),
    ("bsd", 3, 0.5, "bsd", r"\b(?:the )?bsd(?:-style)? licen[cs]e(?!\w)"),
    ("bsd", 3, 0.5, "bsd", r"(?:licensed|released|distributed|available|published) under (?:the |a )?bsd(?! ?[234]| zero|[-\w])"),
    ("bsd", 3, 0.5, "bsd", r"licen[cs]e ?[:=] ?[\"']?bsd(?![\w-])"),
    # gpl and its kin by their short names
    ("gpl-3", 1, 0.9, "gpl", r"\bunder (?:the )?(?:terms of the )?(?:gnu )?gpl[ -]?v?(?:ersion )?3(?:\.0)?(?!\.?\d)"),
    ("gpl-2", 1, 0.9, "gpl", r"\bunder (?:the )?(?:terms of the )?(?:gnu )?gpl[ -]?v?(?:ersion )?2(?:\.0)?(?!\.?\d)"),
    ("gpl-3", 2, 0.8, "gpl", r"\b(?:gnu )?gpl[ -]?(?:v\.? ?|version )?3(?:\.0)?(?:\+|[- ]only|[- ]or[- ]later)?(?![\w]|\.\d)"),
    ("gpl-2", 2, 0.8, "gpl", r"\b(?:gnu )?gpl[ -]?(?:v\.? ?|version )?2(?:\.0)?(?:\+|[- ]only|[- ]or[- ]later)?(?![\w]|\.\d)"),
    ("lgpl-3", 2, 0.8, "lgpl", r"\b(?:gnu )?lgpl[ -]?(?:v\.? ?|version )?3(?:\.0)?(?:\+|[- ]only|[- ]or[- ]later)?(?![\w]|\.\d)"),
    ("lgpl-2.1", 2, 0.8, "lgpl", r"\b(?:gnu )?lgpl[ -]?(?:v\.? ?|version )?2\.1(?:\+|[- ]only|[- ]or[- ]later)?(?![\w]|\.\d)"),
    ("lgpl-2", 2, 0.8, "lgpl", r"\b(?:gnu )?lgpl[ -]?(?:v\.? ?|version )?2(?:\.0)?(?:\+|[- ]only|[- ]or[- ]later)?(?![\w]|\.\d)"),
    ("agpl-3", 2, 0.8, "agpl", r"\b(?:gnu )?agpl[ -]?(?:v\.? ?|version )?3(?:\.0)?(?:\+|[- ]only|[- ]or[- ]later)?(?![\w]|\.\d)"),
    ("gpl-3", 2, 0.8, "general public", r"\bgnu general public licen[cs]e \((?:gnu )?gpl\),? (?:version |v\.? ?)3"),
    ("gpl-2", 2, 0.8, "general public", r"\bgnu general public licen[cs]e \((?:gnu )?gpl\),? (?:version |v\.? ?)2"),
    ("gpl", 3, 0.5, "gpl", r"(?:licensed|released|distributed|available|published) under (?:the )?(?:gnu )?gpl(?! ?v?\.? ?\d|[-\w])"),
    ("gpl", 3, 0.5, "general public", r"\bgnu general public licen[cs]e(?!,? (?:version|v)|\w| \()"),
    ("lgpl", 3, 0.5, "lesser general", r"\bgnu lesser general public licen[cs]e(?!,? (?:version|v)|\w| \()"),
    ("agpl", 3, 0.5, "affero general", r"\bgnu affero general public licen[cs]e(?!,? (?:version|v)|\w| \()"),
    ("gpl-3", 3, 0.6, "gpl", r"licen[cs]e ?[:=] ?[\"']?gpl(?:v| |-v|-)3(?:\.0)?(?:\+|-only|-or-later)?(?![\w.])"),
    ("gpl-2", 3, 0.6, "gpl", r"licen[cs]e ?[:=] ?[\"']?gpl(?:v| |-v|-)2(?:\.0)?(?:\+|-only|-or-later)?(?![\w.])"),
    # apache and mit without the usual words
    ("apache-2", 2, 0.7, "apache", r"\bapache(?:[- ]licen[cs]e)?[- ](?:v(?:ersion )?)?2(?:\.0)?(?![\w]|\.\d)(?: licen[cs]e)?"),
    ("apache-2", 2, 0.8, "2.0", r"\basl[- ]?2\.0(?!\w|\.\d)"),
    ("apache-2", 2, 0.8, "apache", r"\bapache software licen[cs]e,? (?:version |v\.? ?)?2(?:\.0)?(?![\w]|\.\d)"),
    ("apache-1.1", 2, 0.8, "apache", r"\bapache(?: software)? licen[cs]e,? (?:version |v\.? ?)?1\.1"),
    ("mit", 2, 0.8, "licen", r"\b(?:mit|expat)[- ](?:style )?licen[cs]ed?(?!\w)"),
    ("mit", 2, 0.8, "licen", rf"(?<!{WORD[:-1]})the{GAP}mit{GAP}license(?!{WORD[:-1]})"),
    ("mit", 2, 0.8, "mit/x11", r"\bmit/x11(?: licen[cs]e)?(?!\w)"),
    ("mit", 2, 0.7, "x11", r"\bx11 licen[cs]e(?!\w)"),
    ("mit", 3, 0.6, "opensource", r"opensource\.org/licenses?/mit"),
    ("mit", 1, 0.9, "mit", r"(?:licensed|released|distributed|available|published) under mit(?!\w| no)"),
    # creative commons by name
    ("cc-by", 1, 0.9, "creative commons", r"creative commons attribution (?:[1-4]\.[05] )(?:international|unported|generic)"),
    ("cc-by-sa", 1, 0.9, "creative commons", r"creative commons attribution[- ]share ?-?alike(?: [1-4]\.[05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nd", 1, 0.9, "creative commons", r"creative commons attribution[- ]no ?-?deriv(?:ative)?s?(?: [1-4]\.[05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nc-sa", 1, 0.9, "creative commons", r"creative commons attribution[- ]non ?-?commercial[- ]share ?-?alike(?: [1-4]\.[05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nc-nd", 1, 0.9, "creative commons", r"creative commons attribution[- ]non ?-?commercial[- ]no ?-?deriv(?:ative)?s?(?: [1-4]\.[05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nc", 1, 0.9, "creative commons", r"creative commons attribution[- ]non ?-?commercial(?![- ](?:share|no))(?: [1-4]\.[05])?(?: (?:international|unported|generic))?"),
    ("cc-by-sa", 2, 0.8, "by-sa", r"\bcc[- ]by-sa(?:[- ][1-4]\.[05])?(?![\w-])"),
    ("cc-by-nd", 2, 0.8, "by-nd", r"\bcc[- ]by-nd(?:[- ][1-4]\.[05])?(?![\w-])"),
    ("cc-by-nc", 2, 0.8, "by-nc", r"\bcc[- ]by-nc(?:[- ][1-4]\.[05])?(?![\w-])"),
    ("cc-by-nc-sa", 2, 0.8, "by-nc-sa", r"\bcc[- ]by-nc-sa(?:[- ][1-4]\.[05])?(?![\w-])"),
    ("cc-by-nc-nd", 2, 0.8, "by-nc-nd", r"\bcc[- ]by-nc-nd(?:[- ][1-4]\.[05])?(?![\w-])"),
    ("cc0-1", 1, 0.9, "cc0", r"\bcc0(?:[- ]1\.0)?(?: universal)?(?: public domain dedication)?(?![\w-])"),
    ("cc0-1", 1, 0.9, "creative commons", r"creative commons (?:cc)?zero"),
    # the rest by their short names
    ("mpl-2", 2, 0.8, "2.0", r"\bmpl[ -]?(?:v\.? ?|version )?2\.0(?!\w|\.\d)"),
    ("mpl-2", 2, 0.8, "mplv2", r"\bmplv2(?!\w|\.\d)"),
    ("mpl-1.1", 2, 0.8, "1.1", r"\bmpl[ -]?(?:v\.? ?|version )?1\.1(?!\w)"),
    ("mpl-2", 2, 0.8, "mozilla public", r"\bmozilla public licen[cs]e,? (?:version |v\.? ?)?2(?:\.0)?(?![\w]|\.\d)"),
    ("epl-2", 2, 0.8, "epl", r"\bepl[ -]?(?:v\.? ?|version )?2(?:\.0)?(?![\w]|\.\d)"),
    ("epl-1", 2, 0.8, "epl", r"\bepl[ -]?(?:v\.? ?|version )?1(?:\.0)?(?![\w]|\.\d)"),
    ("epl-2", 2, 0.8, "eclipse public", r"\beclipse public licen[cs]e(?: -)? (?:version |v\.? ?)2(?:\.0)?(?![\w]|\.\d)"),
    ("cddl-1", 2, 0.8, "cddl", r"\bcddl(?:[- ](?:v\.? ?|version )?1\.[01])?(?!\w)"),
    ("eupl-1.2", 2, 0.8, "eupl", r"\beupl[ -]?(?:v\.? ?|version )?1\.2(?!\w)"),
    ("ofl-1.1", 2, 0.8, "1.1", r"\b(?:sil )?ofl[ -]?(?:v\.? ?|version )?1\.1(?!\w)"),
    ("ofl-1.1", 2, 0.7, "open font", r"\bsil open font licen[cs]e(?!\w)"),
    ("isc", 2, 0.8, "isc", r"\bisc licen[cs]ed?(?!\w)"),
    ("isc", 1, 0.9, "isc", r"(?:licensed|released|distributed|available) under (?:the )?isc(?!\w)"),
    ("unlicense", 2, 0.8, "unlicense", r"\b(?:the |under )unlicense(?!\w)"),
    ("zlib", 2, 0.8, "zlib", r"\bzlib(?:/libpng)? licen[cs]e(?!\w)"),
    ("bsl-1", 2, 0.8, "boost", r"\bboost(?: software)? licen[cs]e(?:,? (?:version )?1\.0)?(?!\w)"),
    ("psf-2", 2, 0.7, "python software", r"\b(?:psf|python software foundation) licen[cs]e(?!\w)"),
    ("artistic-2", 2, 0.8, "artistic", r"\bartistic licen[cs]e,? (?:version )?2(?:\.0)?(?![\w]|\.\d)"),
    ("wtfpl", 2, 0.8, "wtfpl", r"\bwtfpl(?:[- ](?:v\.? ?|version )?2)?(?!\w)"),
    ("beerware", 2, 0.8, "ware licen", r"\bbeer-?ware licen[cs]e(?!\w)"),
    ("odbl-1", 2, 0.8, "odbl", r"\bodbl(?:[- ](?:v\.? ?|version )?1\.0)?(?!\w)"),
    ("ms-pl", 2, 0.8, "microsoft public", r"\bmicrosoft public licen[cs]e(?: \(ms-pl\))?(?!\w)"),
    ("elastic-2", 2, 0.8, "elastic license", r"\belastic license(?: (?:version |v)?2(?:\.0)?)(?![\w]|\.\d)"),
    ("sspl-1", 2, 0.8, "server side", r"\bserver side public licen[cs]e(?:,? (?:version |v)?1)?(?!\w)"),
    ("busl-1.1", 2, 0.8, "business source", r"\bbusiness source licen[cs]e(?: 1\.1)?(?!\w)"),
    ("commons-clause", 2, 0.8, "commons clause", r"\bcommons clause(?: licen[cs]e condition)?(?!\w)"),
    ("openrail", 2, 0.8, "openrail", r"\b(?:bigscience |creativeml )?open ?rail(?:-?\+?\+?-?m)?(?: licen[cs]e)?(?!\w)"),
    ("llama", 2, 0.8, "community license", r"\bllama (?:[23](?:\.\d)? )?community license(?: agreement)?(?!\w)"),
    ("proprietary", 2, 0.7, "all rights reserved", r"\bproprietary and confidential\.? (?:\S+ ){0,6}?all rights reserved"),
]
# rules that begin with a grant share the opening of the grants above
GRANTING = ("(?:licensed|released|distributed|available|published) under", "(?:licensed|released|distributed|available) under")
SPELLED = [
    Rule(pattern, GRANTED if pattern.startswith(GRANTING) else "", (keyword,), label, priority, score)
    for label, priority, score, keyword, pattern in SIGNATURES
]
RULES = [*SPELLED, *(rule for row in LICENCES for rule in rules_of(*row))]
LEVELS = 1 + max(rule.priority for rule in RULES)
GATE = "(?i)" + "|".join(dict.fromkeys(rule.opening for rule in RULES if rule.opening))
HELD = tuple(dict.fromkeys(max(rule.keywords[0].split(), key=len) for rule in SPELLED if not rule.opening))  # words, as lines may break between them
CHUNK = 128


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def normal(low: Column) -> Column:
    """White space as single blanks: licence texts are wrapped at any word."""
    return F.regexp_replace(low, r"\s+", " ")


def phrase_gate() -> str:
    return "(?i)" + "|".join(GAP.join(phrase.split()) for phrase, _ in PHRASES)


def places(words: Column, phrase: str) -> Column:
    """Starts of a phrase among the words."""
    own = phrase.split()
    last = F.size(words) - len(own)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def stands(i: Column) -> Column:
        found = F.get(words, i) == own[0]
        for k, word in enumerate(own[1:], 1):
            found = found & (F.get(words, i + k) == word)
        return found

    return F.filter(starts, stands)


def named(value: Column, body) -> Column:
    """``body`` of a value that it uses several times: computed once, as an expression within a lambda would not be."""
    return F.get(F.transform(F.array(value), body), 0)


def running_ends(steps: Column) -> Column:
    """Where each of (gap, length) ends, from the beginning of the text. ``steps`` is a bound value, not an expression.

    Sums run within chunks, and over the chunks' sums, so that the array a step copies stays short.
    """
    last = F.floor((F.size(steps) - 1) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(steps, i * CHUNK + 1, CHUNK))
    add = lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
    start = F.array(F.lit(0).cast("bigint"))
    within = lambda chunk: F.aggregate(chunk, start, lambda done, s: add(done, (s["gap"] + s["length"]).cast("bigint")))

    def joined(inner: Column) -> Column:
        before = F.aggregate(inner, start, lambda done, ends: add(done, F.element_at(ends, -1)))
        shifted = F.zip_with(inner, F.slice(before, 1, F.size(inner)), lambda ends, b: F.transform(F.slice(ends, 2, CHUNK), lambda e: e + b))
        return F.flatten(shifted)

    return named(F.transform(chunks, within), joined)


def matches(low: Column, rule: Column) -> Column:
    """All matches of a rule as intervals: pieces between matches and the matches themselves add up to positions."""

    def placed(found: Column) -> Column:
        pieces = F.slice(F.split(low, rule["pattern"], -1), 1, F.size(found))
        steps = F.zip_with(pieces, found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("length")))
        interval = lambda end, s: F.struct(
            (end - s["length"]).cast("int").alias("start"),
            (-end).cast("int").alias("neg_end"),
            rule["priority"].alias("priority"),
            rule["number"].alias("number"),
            rule["label"].alias("label"),
            rule["score"].alias("score"),
        )
        return named(steps, lambda bound: F.zip_with(running_ends(bound), bound, interval))

    # a rule without a match costs one pass
    found = F.array(F.regexp_extract_all(low, rule["pattern"], F.lit(0)))
    return F.flatten(F.transform(F.filter(found, lambda f: F.size(f) > 0), placed))


def surviving(detections: Column) -> Column:
    """Labels (distinct, sorted) and best score of the detections that no better interval contains.

    Sorted by (start, -end, priority, rule), a detection is contained exactly if an earlier one of a priority as good
    ends no sooner, so one running maximum per priority decides.
    """
    reach = F.array(*[F.lit(-1)] * LEVELS)
    begin = F.struct(
        reach.alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score")
    )

    def step(state: Column, d: Column) -> Column:
        end = -d["neg_end"]
        contained = F.exists(F.slice(state["reach"], 1, d["priority"] + 1), lambda r: r >= end)
        return F.struct(
            F.transform(
                state["reach"], lambda r, i: F.when(i == d["priority"], F.greatest(r, end)).otherwise(r)
            ).alias("reach"),
            F.when(contained, state["labels"])
            .otherwise(F.array_union(state["labels"], F.array(d["label"])))
            .alias("labels"),
            F.when(contained, state["score"]).otherwise(F.greatest(state["score"], d["score"])).alias("score"),
        )

    return F.aggregate(
        F.array_sort(detections),
        begin,
        step,
        lambda state: F.struct(F.array_sort(state["labels"]).alias("labels"), state["score"].alias("score")),
    )


def rule_table() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(rule.pattern).alias("pattern"),
                F.array(*[F.lit(k) for k in rule.keywords]).alias("keywords"),
                F.lit(rule.priority).alias("priority"),
                F.lit(number).alias("number"),
                F.lit(rule.label).alias("label"),
                F.lit(rule.score).alias("score"),
            )
            for number, rule in enumerate(RULES)
        ]
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"),
        F.when(F.col("text").rlike(phrase_gate()), ascii_lower(F.col("text"))).alias("phrased"),
        F.lower("text").alias("low"),
    )
    words = F.regexp_extract_all("phrased", F.lit(WORD), F.lit(0))
    rows = rows.withColumn("words", words).withColumn(
        "bases", F.array(*[places(F.col("words"), phrase) for phrase, _ in PHRASES])
    )
    held = reduce(Column.__or__, [F.contains("low", F.lit(k)) for k in HELD])
    rows = rows.withColumn("gated", F.when(held | F.col("low").rlike(GATE), normal(F.col("low"))))
    low = F.col("gated")
    due = F.filter(rule_table(), lambda rule: F.exists(rule["keywords"], lambda k: F.contains(low, k)))
    found = F.flatten(F.transform(due, lambda rule: matches(low, rule)))
    rows = rows.withColumn("starts", F.flatten("bases")).withColumn(
        "found", F.when(low.isNotNull(), surviving(found))
    )
    base = F.filter(
        F.array(
            *[F.when(F.size(F.get(F.col("bases"), k)) > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)]
        ),
        lambda x: x.isNotNull(),
    )
    rows = rows.withColumn("base", F.array_sort(F.array_distinct(base)))
    has_base = F.size("base") > 0
    labels = F.array_sort(F.array_union("base", F.coalesce("found.labels", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id",
        "n_words",
        F.greatest(F.size("starts"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("found.score", F.lit(0.0)), F.when(has_base, 0.8).otherwise(0.0)).alias("score"),
    )
