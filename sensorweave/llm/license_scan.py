"""License scans by template-markup matching.

A license notice is written once as a template: mandatory words, optional regions
``<<beginOptional>> ... <<endOptional>>`` (may be nested) and replaceable regions
``<<var;name=...;words=LOW-HIGH>>`` that stand for any LOW to HIGH words.  Templates
compile into token automata that run over a text's words.  A place is accepted if all
mandatory wording matches exactly; punctuation, case and white space never count.

Labels say how much was compared: ``<licence>`` is a line that names the licence,
``<licence>-opening`` the first sentence of its text, whatever follows, ``<licence>-notice``
the whole notice that files carry, and ``<licence>-text`` the whole mandatory wording.

An automaton starts only where a text has one of its first words, and a template is
tried only on texts that contain its rarest mandatory word, which loses nothing.

Defined results: a null or empty text has no words and no place; repeated rows give
repeated results; null ids are kept; an empty table gives an empty result; other columns
are ignored.  Overlapping places all count; of places of one template that start at one
word the longest is returned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# Phrases whose places are always reported, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: "
        "<<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. "
        "<<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. ")
_BSD_AD = ("<<beginOptional>>3<<endOptional>> All advertising materials mentioning features or use of this software must display "
           "the following acknowledgement: This product includes software developed by <<var;name=who;words=1-24>>. ")
_BSD_NAME = ("<<beginOptional>>3<<endOptional>><<beginOptional>>4<<endOptional>> Neither the name of "
             "<<var;name=holder;words=1-24>> may be used to endorse or promote products derived from this software without "
             "specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1-24>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL <<var;name=holder;words=1-24>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
            "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS "
            "OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
            "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
            "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE")


def _gnu(name: str, version: str) -> str:
    """The notice of a GNU license, with or without the paragraph on where to get a copy."""
    return ("is free software; you can redistribute it and/or modify it under the terms of the GNU "
            f"{name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) "
            "any later version. <<var;name=work;words=1-8>> is distributed in the hope that it will be useful, but WITHOUT ANY "
            "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
            f"{name} for more details<<beginOptional>>. You should have received a copy of the GNU {name} along with "
            "<<var;name=work;words=1-8>> if not, <<var;name=where;words=2-24>><<endOptional>>")


# Public license texts and notices as templates, with the word that a text must contain.
TEMPLATES = (
    ("mit-text", "sublicense", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     "<<var;name=work;words=1-12>> to deal in the <<var;name=work;words=1-3>> without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "<<var;name=work;words=1-3>>, and to permit persons to whom the <<var;name=work;words=1-3>> is furnished to do so, subject to "
     "the following conditions: The above copyright notice and this permission notice "
     "<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of "
     "the <<var;name=work;words=1-3>>. THE <<var;name=work;words=1-3>> IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
     "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=holder;words=1-24>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
     "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
     "<<var;name=work;words=1-3>> OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("bsd-2-text", "redistributions", _BSD + _BSD_END),
    ("bsd-3-text", "endorse", _BSD + _BSD_NAME + _BSD_END),
    ("bsd-4-text", "advertising", _BSD + _BSD_AD + _BSD_NAME + _BSD_END),
    ("isc-text", "tortious", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any "
     "purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
     "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var;name=holder;words=1-24>> "
     "<<beginOptional>>DISCLAIMS<<endOptional>><<beginOptional>>DISCLAIM<<endOptional>> ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
     "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name=holder;words=1-24>> BE LIABLE "
     "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
     "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
     "OR PERFORMANCE OF THIS SOFTWARE"),
    ("unlicense-text", "unencumbered", "This is free and unencumbered software released into the public domain. Anyone is free to "
     "copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
     "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
     "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this "
     "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
     "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under "
     "copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
     "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
     "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
     "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("apache-2-notice", "apache", "licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "<<var;name=work;words=1-3>> except in compliance with the License. You may obtain a copy of the License at "
     "<<var;name=where;words=4-12>> Unless required by applicable law or agreed to in writing, software distributed under the "
     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
     "License for the specific language governing permissions and limitations under the License"),
    ("gpl-3-notice", "gnu", _gnu("General Public License", "3")),
    ("gpl-2-notice", "gnu", _gnu("General Public License", "2")),
    ("lgpl-notice", "lesser", _gnu("Lesser General Public License", "<<var;name=version;words=1-2>>")),
    ("agpl-3-notice", "affero", _gnu("Affero General Public License", "3")),
    ("mit", "mit", "<<beginOptional>>this <<var;name=kind;words=1-3>> is<<endOptional>> "
     "<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>><<beginOptional>>distributed<<endOptional>> "
     "under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    ("mit-opening", "hereby", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     "<<var;name=work;words=1-12>> to deal in <<var;name=work;words=1-6>> without restriction"),
    ("apache-2", "apache", "licensed under the Apache License, Version 2<<beginOptional>>.0<<endOptional>> "
     "<<beginOptional>>(the \"License\")<<endOptional>>"),
    ("gpl-3", "gnu", "under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License "
     "<<beginOptional>>as published by the Free Software Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> "
     "version 3"),
    ("gpl-2", "gnu", "under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License "
     "<<beginOptional>>as published by the Free Software Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> "
     "version 2"),
    ("lgpl", "lesser", "under <<beginOptional>>the terms of<<endOptional>> the GNU Lesser General Public License"),
    ("agpl-3", "affero", "under <<beginOptional>>the terms of<<endOptional>> the GNU Affero General Public License"),
    ("mpl-2", "mozilla", "subject to the terms of the Mozilla Public License, <<beginOptional>>v.<<endOptional>>"
     "<<beginOptional>>version<<endOptional>> 2.0"),
    ("bsd-opening", "redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("isc-opening", "hereby", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any "
     "purpose with or without fee is hereby granted"),
    ("cc-by-nc", "nc", "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC <<beginOptional>>-SA<<endOptional>>"
     "<<beginOptional>>-ND<<endOptional>> <<var;name=version;words=1-2>>"),
    ("cc-by-nc", "noncommercial", "Creative Commons Attribution-NonCommercial"),
    ("cc-by", "commons", "Creative Commons Attribution <<var;name=version;words=1-2>> International License"),
    ("cc0", "cc0", "CC0 1.0 Universal"),
    ("unlicense-opening", "unencumbered", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
)

#: ASCII letters in lower case, digits and all bytes beyond ASCII; the rest separates words.
_WORDS = bytes(b if b > 127 or chr(b).isalnum() and chr(b) == chr(b).lower() else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


@dataclass
class Automaton:
    """States 0 .. n; ``step[s]``: word -> states, ``other[s]``: states reached by any word, ``free[s]``: by no word."""
    label: str
    needs: bytes
    step: list[dict[bytes, set[int]]] = field(default_factory=lambda: [{}])
    other: list[set[int]] = field(default_factory=lambda: [set()])
    free: list[set[int]] = field(default_factory=lambda: [set()])
    end: int = 0

    def state(self) -> int:
        self.step.append({})
        self.other.append(set())
        self.free.append(set())
        return len(self.step) - 1

    def closed(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return seen

    def first_words(self) -> set[bytes]:
        return {w for s in self.closed({0}) for w in self.step[s]}

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted place from ``at``, or -1."""
        now, best, i = self.closed({0}), -1, at
        while now:
            if self.end in now:
                best = i
            if i == len(words):
                break
            w, i = words[i], i + 1
            now = self.closed({t for s in now for t in (self.step[s].get(w, set()) | self.other[s])})
        return best


_MARK = re.compile(r"<<(.*?)>>", re.S)


def compiled(label: str, needs: str, template: str) -> Automaton:
    """The automaton of a template; raises ValueError for unbalanced or unknown marks, or if any word may start it."""
    a, at, open_ = Automaton(label, needs.encode()), 0, []
    for k, part in enumerate(_MARK.split(template)):
        if k % 2 == 0:
            for w in words_of(part.encode()):
                to = a.state()
                a.step[at].setdefault(w, set()).add(to)
                at = to
        elif part == "beginOptional":
            open_.append(at)
        elif part == "endOptional":
            if not open_:
                raise ValueError("endOptional without beginOptional")
            to = a.state()
            a.free[at].add(to)
            a.free[open_.pop()].add(to)
            at = to
        elif part.startswith("var;"):
            low, high = map(int, dict(x.split("=", 1) for x in part.split(";")[1:])["words"].split("-"))
            done, ways = a.state(), []
            for n in range(high + 1):
                if n >= low:
                    ways.append(at)
                if n < high:
                    to = a.state()
                    a.other[at].add(to)
                    at = to
            for w in ways:
                a.free[w].add(done)
            at = done
        else:
            raise ValueError(f"unknown mark {part}")
    if open_:
        raise ValueError("beginOptional without endOptional")
    a.end = at
    start = a.closed({0})
    if any(a.other[s] for s in start) or a.end in start:
        raise ValueError("a template starts with a word of its own")
    return a


def phrase_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[str, int, int]]:
    """(label, start, end) of each place where a phrase's words stand consecutively, by start."""
    out = []
    for phrase, label in phrases:
        at = -1
        for _ in range(words.count(phrase[0])):
            at = words.index(phrase[0], at + 1)
            if words[at:at + len(phrase)] == phrase:
                out.append((label, at, at + len(phrase)))
    return sorted(out, key=lambda x: x[1])


class Scanner:
    """All templates and phrases, compiled."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.automata = [compiled(*t) for t in templates]
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases]
        # a phrase is looked for only in texts with its longest word
        self.needs = [max(p, key=len) for p, _ in self.phrases]

    def scan(self, text: bytes | None):
        """(number of words, phrase places, template places)"""
        low = (text or b"").translate(_WORDS)
        words = low.split()
        base = phrase_places(words, [p for p, n in zip(self.phrases, self.needs, strict=True) if n in low])
        starts: dict[bytes, list[Automaton]] = {}
        for a in self.automata:
            if a.needs in low:
                for w in a.first_words():
                    starts.setdefault(w, []).append(a)
        found = []
        if starts:
            for i, w in enumerate(words):
                for a in starts.get(w, ()):
                    end = a.longest(words, i)
                    if end >= 0:
                        found.append((a.label, i, end))
        return len(words), base, found


def covered(places: list[tuple[str, int, int]]) -> int:
    """Words inside any of the places."""
    total, upto = 0, 0
    for _, s, e in sorted(places, key=lambda x: x[1]):
        total += max(0, e - max(s, upto))
        upto = max(upto, e)
    return total


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """(doc_id, n_words, base, found, score): places as (label, start, end) in words, end exclusive.

    ``score``: the share of the text's words that stand in a phrase's or template's place.
    """
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = Scanner(templates, phrases)
        for b in batches:
            rows = [scanner.scan(t) for t in b.column(1).to_pylist()]
            cols = [[[dict(zip(("label", "start", "end"), p, strict=True)) for p in r[k]] for r in rows] for k in (1, 2)]
            score = [covered(base + found) / n if n else 0.0 for n, base, found in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.int64()), *[pa.array(c, place) for c in cols],
                 pa.array(score, pa.float64())], ["doc_id", "n_words", "base", "found", "score"])

    kind = "array<struct<label: string, start: long, end: long>>"
    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")],
                       f"doc_id long, n_words long, base {kind}, found {kind}, score double", run)


def digest(scanned: DataFrame) -> DataFrame:
    """One row of plain columns for each row of ``scan``."""
    def labels(places):
        return F.transform(places, lambda p: p["label"])

    def listed(names):
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    starts = F.transform("base", lambda p: p["start"])
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), listed(labels(F.col("base"))).alias("base_labels"),
        listed(F.concat(labels(F.col("base")), labels(F.col("found")))).alias("labels"), "score")
