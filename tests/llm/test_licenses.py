"""Licence families by rule, their notices, and names that clash."""

import pytest

from chalkline.llm import bpe, licenses

MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
BSD3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the
copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED."""
CASES = [
    (MPL, "mpl-2.0"), (BSD3, "bsd-3-clause"), (BSD3.replace(BSD3[BSD3.index("3. Neither"):BSD3.index("THIS SOFTWARE")], ""), "bsd-2-clause"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0"),
    ("licensed under a Creative Commons Attribution-NonCommercial 2.5 Generic License", "cc-by-nc-2.5"),
    ("the terms: Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
     "the License, or (at your option) any later version", "lgpl-2.1"),
    ("licensed under the GNU Affero General Public License version 3", "agpl-3.0"),
    ("// SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"),
    ("SPDX-License-Identifier: MIT", "mit-notice"), ("the Eclipse Public License 2.0", ""), ("BSD license", ""),
    ("redistribution and use in source and binary forms", ""), ("", ""),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
     "sell, or distribute this software", "unlicense"),
]


def labels(text):
    needles = []
    automata = [(label, licenses.Automaton(t)) for label, ts in licenses.family_templates().items() for t in ts]
    return {m[0] for m in licenses.scan_words(licenses.words_of(text), needles, automata)[0]}


@pytest.mark.parametrize("text,label", CASES)
def test_notice(text, label):
    assert labels(text) == ({label} if label else set())
    assert labels("some words before " + text.upper() + " and after") == ({label} if label else set())


def test_every_template_is_accepted_by_its_own_automaton():
    for label, ways in licenses.family_templates().items():
        for way in ways:
            a = licenses.Automaton(way)
            assert a.anchor, (label, way)


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "MIT license", "mine", [9], "x")], "doc_id long, text string, _license string, ids array<int>, decoded string")
    row = licenses.scan(df).collect()[0]
    assert row["_license"] == "mine" and row["__license"]["n_words"] == 2
    out = bpe.decode(bpe.encode(df, bpe.default_vocab()), bpe.default_vocab())
    assert out.columns == [*df.columns, "_ids", "_decoded"]
    row = out.collect()[0]
    assert row["ids"] == [9] and row["_decoded"] == "MIT license" and row["decoded"] == "x"
    with pytest.raises(ValueError):
        bpe.encode(df, bpe.default_vocab(), ids="ids")


def test_phrase_places_in_a_long_text():
    words = licenses.words_of("apache license word " * 30_000)
    joined = b" " + b" ".join(words) + b" "
    assert list(licenses.phrase_places(joined, b" apache license ")) == list(range(0, 90_000, 3))
