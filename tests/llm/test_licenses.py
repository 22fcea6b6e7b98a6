"""Licences as they are written in the wild, with the labels a reader gives them; independent of the rules."""

import re
import time

import pytest
import regex

from tidemark.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""

SPELLINGS = [
    ("BSD 3-Clause License", "bsd-3"),
    ("licensed under the BSD 3-Clause License", "bsd-3"),
    ("the 2-clause BSD license", "bsd-2"),
    ("GNU LGPL v2.1", "lgpl-2.1"),
    ("LGPLv3", "lgpl-3"),
    ("GPL-3.0-or-later", "gpl-3"),
    ("This is under GPLv3.", "gpl-3"),
    ("released under the GPL v2", "gpl-2"),
    ("GNU GPL version 3", "gpl-3"),
    ("AGPLv3+", "agpl-3"),
    ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International", "cc-by-nc-nd"),
    ("Creative Commons Attribution 4.0 International", "cc-by"),
    ("CC BY-SA 3.0", "cc-by-sa"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2,mit"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2"),
    ("SPDX-License-Identifier: BSD-2-Clause AND ISC", "bsd-2,isc"),
    ("Apache 2.0", "apache-2"),
    ("Apache License, Version 2.0", "apache-2"),
    ("ASL 2.0", "apache-2"),
    ("Licensed under MIT", "mit"),
    ("MIT licensed", "mit"),
    ("MPL-2.0", "mpl-2"),
    ("CC0 1.0 Universal", "cc0-1"),
    (MIT, "mit"),
    (BSD, "bsd-2"),
    (BSD + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products\nderived from this software without", "bsd-2,bsd-3"),
    (GPL3, "gpl-3"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "mpl-2"),
    ("licensed under the terms of the BSD license", "bsd"),
    ("the GNU General Public License", "gpl"),
]
NONE = [
    "Ich komme mit dem Bus", "the apache tribe, 2 of them", "under the table", "a gpl of milk", "the public domain debate", "mit 2.0 Promille",
    "permission is hereby refused", "redistribution of wealth", "gpl", "an epl 3 match", "she lives in Boost", "isc", "eclipse of the sun 2.0",
]


def test_spellings_in_the_wild(spark):
    docs = spark.createDataFrame(list(enumerate(text for text, _ in SPELLINGS)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert {text: found[i] for i, (text, _) in enumerate(SPELLINGS)} == dict(SPELLINGS)


def test_spellings_inside_other_text_and_lines(spark):
    wrapped = [(i, "Ein Satz. " + re.sub(" ", "\n   ", text, count=2) + "\nund weiter", labels) for i, (text, labels) in enumerate(SPELLINGS)]
    docs = spark.createDataFrame([(i, text) for i, text, _ in wrapped], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert found == {i: labels for i, _, labels in wrapped}


def test_ordinary_text_has_no_licence(spark):
    docs = spark.createDataFrame(list(enumerate(NONE)), "doc_id long, text string")
    assert {NONE[r.doc_id]: r.labels for r in licenses.scan(docs).collect()} == dict.fromkeys(NONE, "")


def test_rules_are_many_and_each_match_holds_its_keyword():
    assert len(licenses.SIGNATURES) >= 100
    for rule in licenses.SPELLED:
        for text, _ in SPELLINGS:
            for match in regex.finditer(rule.pattern, re.sub(r"\s+", " ", text.lower())):
                assert rule.keywords[0] in match[0], (rule.pattern, match[0])


@pytest.mark.parametrize("unit", ["Released under the MIT License. ", "GPLv3 ", "SPDX-License-Identifier: MIT or ", "permission "])
def test_a_megabyte_of_licences_takes_seconds(spark, unit):
    text = unit * (1_000_000 // len(unit))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.time()
    licenses.scan(docs).collect()
    assert time.time() - started < 30


BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
PUNCTUATED = [
    None,
    "",
    "Released Under\n(the) MIT-License, 2.0",
    "under the MIT license; UNDER The mit license",
    "the MIT License",
    'the "MIT" License of CC BY-NC',
    "thunder the MIT license",
    "under the MIT licenses",
    "cc_by\0nc cc by nc. Apache License, Version 2.0",
    "Apache License Version 20",
    "\u017f under the M\u0130T license \u00e9under the MIT license",
]


def base_places(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label)
        for phrase, label in BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_phrases_as_the_contract_words_them(spark):
    docs = spark.createDataFrame(list(enumerate(PUNCTUATED)), "doc_id long, text string")
    found = {PUNCTUATED[r.doc_id]: r for r in licenses.scan(docs).collect()}
    assert {t: tuple(r)[1:6] for t, r in found.items()} == {t: base_places(t) for t in PUNCTUATED}
    # what is no base phrase may still be named by a rule
    assert found["the MIT License"].labels == "mit"
    assert found['the "MIT" License of CC BY-NC'].labels == "cc-by-nc,mit"
