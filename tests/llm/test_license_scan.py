"""License scan: rankings, wording and whole texts."""

import textwrap

import pytest

from stopclock.llm import license_scan
from stopclock.llm.license_scan import TEMPLATES, Scanner


@pytest.mark.parametrize(("name", "text"), TEMPLATES)
def test_every_template_finds_itself(name, text):
    found, gain, differences = Scanner().explain(text)
    assert (found, differences) == (name, ()) and gain > 0.3


@pytest.mark.parametrize(
    ("block", "license", "differences"),
    [
        ("Released under the MIT license", "MIT", ()),
        ("Released under MIT License", "MIT", ("-the",)),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0", ()),
        ("This work is licensed under the GNU General Public License, version 4.", None, ()),
        ("Licensed under CC BY-ND 4.0.", None, ()),
        ("A license to print money", None, ()),
    ],
)
def test_wording_decides(block, license, differences):
    found, _, got = Scanner().explain(block)
    assert (found, got) == (license, differences)


MIT_GRANT = next(t for n, t in TEMPLATES if n == "MIT" and "merge" in t)


@pytest.mark.parametrize(
    ("block", "licenses"),
    [
        ('Licensed under the Apache License, Version 2.0 (the "License");', ["Apache-2.0"]),
        ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with it', ["Apache-2.0"]),
        (MIT_GRANT, ["MIT"]),
        ("Released under the MIT License, as the law and all others here may use it at will", ["MIT"]),
        ("so it goes and " * 40 + "this work is licensed under the GNU General Public License, version number 3. and so on", ["GPL-3.0"]),
        ("Released under the MIT License and licensed under the Apache License, Version 2.0", ["MIT", "Apache-2.0"]),
        ("This work is licensed under the GNU Library General Public License, version 2.", [None]),
        ("This work is licensed under the GNU Affero General Public License, version 3.", [None]),
        ("Licensed under the Apache License, Version 1.1, or the terms of 2.0", [None]),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", [None]),
    ],
)
def test_notices_within_their_block(block, licenses):
    assert [f[1] for f in Scanner().explain_all(block)] == licenses


def test_test_data_has_every_line(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in license_scan.op7_license_scan(spark, path).collect()}
    assert len(got) == len(docs)
    for r in docs:
        assert set(filter(None, got[r.doc_id].licenses.split(","))) == {n for n, t in TEMPLATES if t in (r.text or "")}


def test_odd_rows(make_docs, odd_rows):
    docs = [*odd_rows, (8, "x " * 100_000 + "end. Released under the MIT License. More.", "en", "s", 1)]
    found = license_scan.scan(make_docs(docs, clash=True)).collect()
    assert len(found) == len(docs)
    assert {r.doc_id: [(f.block, f.license) for f in r.found] for r in found if r.found} == {8: [("Released under the MIT License.", "MIT")]}
    assert license_scan.scan(make_docs([])).collect() == []


WRAPPED = [(n, t) for n, t in TEMPLATES if len(t) > 60]


def test_wrapped_and_commented_notices(spark, make_docs):
    texts, expected = [], []
    for name, notice in WRAPPED:
        for width in (40, 72):
            lines = textwrap.wrap(notice, width)
            for begin, mark, end in (("", "", ""), ("", "// ", ""), ("", "# ", ""), ("/*\n", " * ", "\n */"), ("<!--\n", "", "\n-->"), ("", ";; ", ""), ("", "-- ", "")):
                for stop in ("\n", "\r\n"):
                    commented = begin + "\n".join(mark + line for line in lines) + end
                    blank = mark.rstrip()
                    text = f"{mark}program.c - does things\n{blank}\n{commented}\n{blank}\n{mark}Then other words follow"
                    texts.append(text.replace("\n", stop))
                    expected.append(name)
    docs = make_docs(list(enumerate(texts)))
    got = {r.doc_id: [f.license for f in r.found if f.license] for r in license_scan.scan(docs).collect()}
    assert [set(got[k]) for k in range(len(texts))] == [{n} for n in expected]


def test_whole_notices(make_docs):
    apache = """   Copyright 2020 Someone

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
    mozilla = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
    lines = "words that stand before\nLicensed under CC BY\n4.0\nReleased under the MIT License\nand more"
    found = license_scan.scan(make_docs([(1, apache), (2, mozilla), (3, lines)])).collect()
    assert {r.doc_id: [f.license for f in r.found if f.license] for r in found} == {1: ["Apache-2.0"], 2: ["MPL-2.0"], 3: ["CC-BY-4.0", "MIT"]}
