import random
import time
import re

import pytest

from loomwork.llm import license_rules, license_scan
from tests.llm.fixtures import documents, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def scanner():
    return license_scan.Scanner()


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, places = WORD.findall(lowered), []
    for phrase, label in license_rules.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None, "", "no licence", "MIT License MIT license", "gnu General\nPublic, LICENSE", "xmit license", "cc-by cc by CC/BY", "İ mit license é", "apache licenses",
    "Licensed under the Apache License, Version 2.0.", "mit\x7flicense", "mit\x00license mitélicense", "cc by cc by",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_equals_brute_force(scanner, text):
    got = license_scan.scan_text(text, scanner)
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == brute(text)
    assert set(filter(None, got["base_labels"].split(","))) <= set(filter(None, got["labels"].split(",")))


LABELS = [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("GNU Lesser General Public License, version 2.1 or any later version", "lgpl-2.1-or-later"),
    ("GPLv3+ applies", "gpl-3.0-or-later"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("Creative Commons Attribution-ShareAlike 3.0", "cc-by-sa-3.0"),
    ("BSD 3-Clause License", "bsd-3-clause"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("Mozilla Public License 2.0", "mpl-2.0"),
    ("All rights reserved.", "all-rights-reserved"),
    ("the mitigation licensed a car", ""),
    ("limited public meetings at 3.0", ""),
]


@pytest.mark.parametrize("text,labels", LABELS)
def test_labels(scanner, text, labels):
    assert license_scan.scan_text(text, scanner)["labels"] == labels


def test_hundreds_of_ordered_rules():
    assert len(license_rules.RULES) >= 200
    for rule in license_rules.RULES:
        re.compile(rule.pattern)


def test_prefilter_loses_nothing(scanner):
    """Every text that a rule matches holds its keyword."""
    texts = [t for t, _ in LABELS] + [t or "" for t in TEXTS]
    for text in texts:
        lowered = text.lower()
        gated = set(scanner.candidates(lowered))
        for i, p in enumerate(scanner.patterns):
            if p.search(lowered):
                assert i in gated, (scanner.rules[i], text)


def test_suppression():
    d = license_scan.Detection
    inside, outside = d("a", 5, 9, 50, 1), d("b", 0, 10, 60, 2)
    assert license_scan.suppress([inside, outside]) == [outside]
    strong = d("a", 5, 9, 70, 1)
    assert set(license_scan.suppress([strong, outside])) == {strong, outside}
    assert license_scan.suppress([d("x", 0, 5, 50, 2), d("y", 0, 5, 60, 9)]) == [d("y", 0, 5, 60, 9)]
    overlap = d("c", 8, 14, 10, 3)
    assert set(license_scan.suppress([outside, overlap])) == {outside, overlap}


def test_frames(spark):
    docs = documents(spark)
    got = license_scan.scan_licenses(docs).collect()
    want = sorted((r["doc_id"] or 0, *brute(r["text"])[:2]) for r in docs.collect())
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_base"]) for r in got) == want
    assert all(0 <= r["score"] <= 1 for r in got)
    assert license_scan.scan_licenses(empty(spark)).count() == 0


WRAPPED = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without\n  modification, are permitted", "bsd"),
    ("under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", "gpl-3.0-or-later"),
    ("the terms of the GNU Lesser General Public\n    License as published by the Free Software Foundation; either\n    version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1-or-later"),
    ("GNU General Public License, version 2 of this License, or any later version", "gpl-2.0-or-later"),
    ("Licensed under the Apache\nLicense,\r\n   Version 2.0 (the \"License\");\nyou may not use this file", "apache,apache-2.0"),
]


@pytest.mark.parametrize("text,labels", WRAPPED)
def test_wrapped_texts(scanner, text, labels):
    got = license_scan.scan_text(text, scanner)
    assert got["labels"] == ",".join(sorted(set(labels.split(",")) | set(filter(None, got["base_labels"].split(",")))))
    assert {s[0] for s in got["spans"]} <= set(labels.split(","))
    flat = " ".join(text.split())
    for (a, x, y, _), (b, u, v, _) in zip(got["spans"], license_scan.scan_text(flat, scanner)["spans"], strict=True):
        assert a == b and " ".join(text[x:y].split()) == flat[u:v]


@pytest.mark.parametrize("seed", range(40))
def test_suppression_equals_brute_force(seed):
    rng = random.Random(seed)
    found = []
    for rule in range(rng.randrange(1, 60)):
        start = rng.randrange(30)
        found.append(license_scan.Detection("x", start, start + rng.randrange(1, 30), rng.choice([50, 60, 80, 95]), rule))
    strength = lambda d: (-d.priority, d.start - d.end, d.rule)
    want = {d for d in found if not any(o.start <= d.start and o.end >= d.end and strength(o) < strength(d) for o in found)}
    got = license_scan.suppress(found)
    assert set(got) == want and [d.start for d in got] == sorted(d.start for d in got)


@pytest.mark.parametrize("phrase", ["mit license ", "gnu general public license version 2 ", "apache license, version 2.0\n"])
def test_time_is_linear_in_detections(scanner, phrase):
    def seconds(k):
        began = time.perf_counter()
        license_scan.scan_text(phrase * k, scanner)
        return time.perf_counter() - began

    seconds(100)
    assert seconds(32_000) < 14 * max(seconds(4_000), 0.02)


def test_only_ascii_is_lowered(scanner):
    """A Kelvin sign is no k and a dotted capital I no i, for rules as for base phrases."""
    assert license_scan.scan_text("M\u0130T LICENSE", scanner)["labels"] == ""
    spans = license_scan.scan_text("\u0130\u0130 MIT License", scanner)["spans"]
    assert spans and spans[0][1] == 3
