"""License scan by template-markup matching.

A template is a licence wording with two kinds of markup: ``[[ ... ]]`` encloses
words that may be missing, ``<<n>>`` stands for up to n words of any kind.  It is
compiled into a token automaton whose states are places between words; a text is
accepted where all mandatory words occur in order, word for word.  Each template
also has an anchor, its longest run of mandatory words without markup; only texts
that hold the anchor are walked through the automaton, so most texts cost one
substring search per template.

Plain phrases name a licence family; templates add more exact labels.  Wordings that
differ in a name or a version only (the GNU and Creative Commons families, licence
identifiers) are made from one wording by rule.

Defined results: a null or wordless text has no words, no matches and score 0;
repeated rows are scanned one by one, an empty table gives an empty table, and
extra columns pass through untouched: the result is one struct column under a name that
the input does not use (``free_name``).  A text of any length is scanned whole, in time
linear in it and its matches.  Matches that tie in place are ordered by end and label.
The work is per row, without a shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, free_name, positional

#: Phrase -> label.  Fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label -> wordings.  The licence texts are fixed values of their publishers.
TEMPLATES = {
    "apache-2.0": ["""licensed under the apache license version 2 0 [[the license]] [[you may not use this file
        except in compliance with the license [[you may obtain a copy of the license at <<8>>]] unless required by
        applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
        without warranties or conditions of any kind either express or implied see the license for the specific
        language governing permissions and limitations under the license]]"""],
    "gpl-2.0": ["licensed under [[the terms of]] the gnu general public license [[as published by the free software "
                "foundation]] [[either]] version 2 [[of the license]] [[or at your option any later version]]",
                "under the terms of the gnu general public license as published by the free software foundation "
                "[[either]] version 2 [[of the license]] [[or at your option any later version]]"],
    "gpl-3.0": ["licensed under [[the terms of]] the gnu general public license [[as published by the free software "
                "foundation]] [[either]] version 3 [[of the license]] [[or at your option any later version]]",
                "under the terms of the gnu general public license as published by the free software foundation "
                "[[either]] version 3 [[of the license]] [[or at your option any later version]]"],
    "cc-by-4.0": ["licensed under [[a]] [[creative commons attribution 4 0 international license]] cc by 4 0"],
    "cc-by-nc-4.0": ["licensed under [[a]] [[creative commons attribution noncommercial 4 0 international license]] "
                     "cc by nc 4 0"],
    "mit-text": ["""[[the mit license [[mit]]]] [[copyright [[c]] <<8>>]] permission is hereby granted free of charge to
        any person obtaining a copy of this software and associated documentation files the software to deal in the
        software without restriction including without limitation the rights to use copy modify merge publish
        distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice
        [[including the next paragraph]] shall be included in all copies or substantial portions of the software the
        software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement in no event shall
        <<6>> be liable for any claim damages or other liability whether in an action of contract tort
        or otherwise arising from out of or in connection with the software or the use or other dealings in the
        software"""],
    "mit-notice": ["released under [[the terms of]] the mit license"],
    "isc-text": ["""[[copyright [[c]] <<8>>]] permission to use copy modify and [[or]] distribute this software for any
        purpose with or without fee is hereby granted provided that the above copyright notice and this permission
        notice appear in all copies the software is provided as is and <<4>> disclaims all warranties with regard to
        this software including all implied warranties of merchantability and fitness"""],
}

#: Names, versions and notices by which families are spelt out.  Fixed values.
GNU = {"gpl": ("general", ("2", "3")), "lgpl": ("lesser general", ("2 1", "3")), "agpl": ("affero general", ("3",))}
CC = {"by": "attribution", "by-sa": "attribution sharealike", "by-nc": "attribution noncommercial", "by-nd": "attribution noderivatives",
      "by-nc-sa": "attribution noncommercial sharealike", "by-nc-nd": "attribution noncommercial noderivatives"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
#: Label -> words of its identifier, where the label does not spell it.
IDENTIFIERS = {"mit-notice": "mit", "isc-text": "isc", "bsd-2-clause": "bsd 2 clause", "bsd-3-clause": "bsd 3 clause"}
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the
    following conditions are met <<2>> redistributions of source code must retain the above copyright notice this list of
    conditions and the following disclaimer <<2>> redistributions in binary form must reproduce the above copyright notice
    this list of conditions and the following disclaimer in the documentation and or other materials provided with the
    distribution {endorsement} this software is provided by <<12>> as is and any express or implied warranties including but
    not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"""
_NO_ENDORSEMENT = """<<2>> neither the name of <<12>> nor the names of its contributors may be used to endorse or promote products
    derived from this software without specific prior written permission"""
#: More wordings that stand for themselves.
NOTICES = {
    "bsd-2-clause": [_BSD.format(endorsement="")],
    "bsd-3-clause": [_BSD.format(endorsement=_NO_ENDORSEMENT)],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0 [[if a copy of the mpl was not "
                "distributed with this file you can obtain one at <<8>>]]"],
    "epl-2.0": ["made available under the terms of the eclipse public license [[v]] 2 0"],
    "cc0-1.0": ["waived all copyright and related or neighboring rights to", "creative commons zero [[v]] 1 0 universal",
                "cc0 1 0 universal"],
    "unlicense": ["this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
                  "compile sell or distribute this software"],
}


def family_templates() -> dict[str, list[str]]:
    """Label -> wordings: ``TEMPLATES``, ``NOTICES``, and the families by their rule."""
    out = {label: list(ways) for label, ways in [*TEMPLATES.items(), *NOTICES.items()]}

    def add(label, wording):
        if wording not in out.setdefault(label, []):
            out[label].append(wording)

    for short, (name, versions) in GNU.items():
        for v in versions:
            label = f"{short}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
            for start in ("licensed under [[the terms of]] the", "under the terms of the"):
                add(label, f"{start} gnu {name} public license [[as published by the free software foundation]] [[either]] "
                           f"version {v} [[of the license]] [[or at your option any later version]]")
            add(label, f"gnu {name} public license [[for more details]] version {v} [[or later]]")
            add(label, f"spdx license identifier {label.replace('-', ' ').replace('.', ' ')} [[only]] [[or later]]")
    for short, name in CC.items():
        for v in CC_VERSIONS:
            label = f"cc-{short}-{v.replace(' ', '.')}"
            add(label, f"[[licensed under]] [[a]] [[the]] creative commons {name} {v} [[international]] [[unported]] [[generic]] license")
            add(label, f"licensed under [[a]] [[the]] [[terms of the]] cc {short.replace('-', ' ')} {v} [[license]]")
    for label in [*TEMPLATES, *NOTICES]:
        words = IDENTIFIERS.get(label, label.replace("-", " ").replace(".", " "))
        if not words.endswith("text"):
            add(label, f"spdx license identifier {words}")
    return out


#: ASCII characters that are no digit or letter separate words; A-Z count as a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """States 0..n; word edges, any-word edges and empty edges."""

    def __init__(self, template: str):
        self.word: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.empty: list[list[int]] = [[]]
        opened: list[int] = []
        run: list[bytes] = []
        self.anchor: list[bytes] = []
        at = 0
        for mark in re.findall(r"\[\[|\]\]|<<\d+>>|[^\s\[\]<>]+", template):
            if mark == "[[" or mark == "]]" or mark[0] == "<":
                run = []
            if mark == "[[":
                opened.append(at)
            elif mark == "]]":
                self.empty[opened.pop()].append(at)
            elif mark[0] == "<":
                places = [at]
                for _ in range(int(mark[2:-2])):
                    nxt = self._state()
                    self.any[places[-1]] = nxt
                    places.append(nxt)
                at = self._state()
                for p in places:
                    self.empty[p].append(at)
            else:
                nxt = self._state()
                self.word[at][mark.encode()] = nxt
                at = nxt
                if not opened:
                    run = [*run, mark.encode()]
                    self.anchor = max(self.anchor, run, key=len)
        self.accept = at
        self.first = {w for s in self._close({0}) for w in self.word[s]}
        self.needle = b" " + b" ".join(self.anchor) + b" "

    def _state(self) -> int:
        self.word.append({})
        self.any.append(None)
        self.empty.append([])
        return len(self.word) - 1

    def _close(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return seen

    def longest(self, words: list[bytes], start: int) -> int:
        """End of the longest accepted run of words from ``start``, or -1."""
        states, end, i = self._close({0}), -1, start
        while True:
            if self.accept in states:
                end = i
            if i == len(words) or not states:
                return end
            step = {n for s in states for n in (self.word[s].get(words[i]), self.any[s]) if n is not None}
            states, i = self._close(step), i + 1

    def matches(self, words: list[bytes]):
        """Leftmost longest matches that do not overlap."""
        i = 0
        while i < len(words):
            end = self.longest(words, i) if words[i] in self.first else -1
            if end > i:
                yield i, end
                i = end
            else:
                i += 1


def phrase_places(joined: bytes, phrase: bytes):
    """Word numbers at which a phrase stands; ``joined`` has a space around every word."""
    at, seen, words = joined.find(phrase), 0, 0
    while at >= 0:
        words += joined.count(b" ", seen, at)
        seen = at
        yield words
        at = joined.find(phrase, at + 1)


def scan_words(words: list[bytes], phrases, automata) -> tuple[list[tuple], int]:
    """((label, is_phrase, start, end), ...) by start, and the number of words they cover."""
    joined = b" " + b" ".join(words) + b" "
    found = [(label, True, s, s + n) for needle, n, label in phrases for s in phrase_places(joined, needle)]
    for label, automaton in automata:
        if automaton.needle in joined:
            found += [(label, False, s, e) for s, e in automaton.matches(words)]
    found.sort(key=lambda m: (m[2], m[3], m[0]))
    covered, upto = 0, 0
    for _, _, s, e in found:
        covered += max(0, e - max(s, upto))
        upto = max(upto, e)
    return found, covered


MATCH = "array<struct<label:string,phrase:boolean,start:bigint,end:bigint>>"
_ARROW_MATCH = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()),
                                   ("start", pa.int64()), ("end", pa.int64())]))


def _scanner(phrases: dict, templates: dict, text_at: int):
    def run(batches):
        needles = [(b" " + p.encode() + b" ", len(p.split()), label) for p, label in phrases.items()]
        automata = [(label, Automaton(t)) for label, ts in templates.items() for t in ts]
        for b in batches:
            n, covered, found = [], [], []
            for text in b.column(text_at).to_pylist():
                words = words_of(text) if text else []
                m, c = scan_words(words, needles, automata)
                n.append(len(words))
                covered.append(c)
                found.append([dict(zip(("label", "phrase", "start", "end"), x)) for x in m])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(n, pa.int64()), pa.array(covered, pa.int64()), pa.array(found, _ARROW_MATCH)],
                names=[*b.schema.names, "_words", "_covered", "_found"])
    return run


def scan(docs: DataFrame, phrases: dict = PHRASES, templates: dict | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``_license``: struct(n_words, n_covered, matches)."""
    templates = family_templates() if templates is None else templates
    rows, (text_x,) = positional(docs, text)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = rows.mapInArrow(_scanner(phrases, templates, rows.columns.index(text_x)),
                          f"{fields}, _words long, _covered long, _found {MATCH}")
    return out.select(*[F.col(x).alias(c) for x, c in zip(rows.columns, docs.columns)],
                      F.struct(F.col("_words").alias("n_words"), F.col("_covered").alias("n_covered"),
                               F.col("_found").alias("matches")).alias(free_name(docs, "_license")))


def op5_license_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = F.col("_license.matches")
    base = F.filter(found, lambda m: m["phrase"])
    starts = F.transform(base, lambda m: m["start"])

    def names(ms):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")

    return scan(docs).drop("text").select(
        "doc_id", F.col("_license.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(found).alias("labels"),
        F.coalesce(F.col("_license.n_covered") / F.nullif(F.col("_license.n_words"), F.lit(0)), F.lit(0.0)).alias("score"))


by_value(__name__)
