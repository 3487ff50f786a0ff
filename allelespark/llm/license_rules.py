"""Licence scans by sentence rules.

A text is cut into atoms at line ends and after sentence marks.  Atoms, or runs of them (a sentence may be wrapped over lines), are
normalised and looked up in a table of known licence sentences; a run may also be several known sentences one after another, and
an entry's ``*`` stands for up to 12 words (names of holders).  A list mark before a sentence and comment marks don't count.  The found
identifiers, in order, are matched against ordered rules, each a sequence of identifiers; the first rule that fits at a place names
the licence and takes its identifiers.

Scale: texts are only scanned, nothing is shuffled.  Sentences and rules are a fixed table of this module (some MB as a broadcast), so
what tasks carry is bounded.

Defined cases: null and empty texts have no sentences and no licences; a sentence with a licence word that no table entry knows is
counted as unknown; words with other than ASCII letters are words like others, so no entry passes over them; repeated rows give a row each; a null doc_id is carried; other columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame

from allelespark.llm.common import per_row

# Sentences of public licences, normalised (lower case, words only), by identifier.
SENTENCES: dict[str, str | list[str]] = {
    "apache-2-short": "licensed under the apache license version 2 0",
    "apache-2-may-not": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "apache-2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-short": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "gpl-3-short": "this work is licensed under the gnu general public license version 3",
    "gpl-2-short": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "all-rights": "all rights reserved",
    "apache-2-head": "licensed under the apache license version 2 0 the license",
    "apache-2-asf": "licensed to the apache software foundation asf under one or more contributor license agreements",
    "apache-2-notice": "see the notice file distributed with this work for additional information regarding copyright ownership",
    "apache-2-asf-grant": "the asf licenses this file to you under the apache license version 2 0 the license",
    "apache-2-copy-at": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "apache-2-url": ["http www apache org licenses license 2 0", "https www apache org licenses license 2 0", "http www apache org licenses license 2 0 txt", "https www apache org licenses license 2 0 txt"],
    "apache-2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-title": ["the mit license", "the mit license mit", "mit license"],
    "mit-notice-next": "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software",
    "as-is-2": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement",
    "mit-liable": "in no event shall * be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "bsd-product": ["this product includes software developed by *", "this product includes software developed by the *"],
    "bsd-name": [
        "neither the name of * nor the names of * contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "neither the name * nor the names of * contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission",
        "the names of * may not be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "bsd-as-is": [
        "this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
        "this software is provided by * as is and * any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ],
    "bsd-liable": "in no event shall * be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license version 2 0"],
    "mpl-2-copy": [f"if a copy of the mpl was not distributed with this file you can obtain one at {h} mozilla org mpl 2 0" for h in ("http", "https")],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "the software is provided as is and * disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "bsl-short": "distributed under the boost software license version 1 0",
    "bsl-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    **{f"epl-{v[0]}": [f"this program and the accompanying materials are made available under the terms of the eclipse public license {mark}{v}" for mark in ("", "v ", "version ")] + [f"this program and the accompanying materials are made available under the terms of the eclipse public license v{v}"] for v in ("1 0", "2 0")},
    "see-license": [f"see {a}license{b}{c}" for a in ("", "the ") for b in ("", " file", " txt", " md") for c in ("", " for details", " for more details", " for more information")],
}

#: Names by which one-sentence grants call a licence, by its SPDX identifier; also the identifiers of SPDX lines.
NAMES = {
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache version 2 0 license"],
    "MIT": ["mit license", "mit licence"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause simplified license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause new or revised license"],
    "ISC": ["isc license"], "Zlib": ["zlib license"], "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"], "Unlicense": ["unlicense"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v 2 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license 1 0"], "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0"],
    "CC0-1.0": ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"],
}
_GNU = {"GPL": ("gnu general public license", ("2", "3")), "LGPL": ("gnu lesser general public license", ("2 1", "3")), "AGPL": ("gnu affero general public license", ("3",))}
_CC = {"": "", "-NC": " noncommercial", "-SA": " sharealike", "-ND": " noderivatives", "-NC-SA": " noncommercial sharealike", "-NC-ND": " noncommercial noderivatives"}
_WORKS = ("this program", "this library", "this software", "this file", "this package", "this module", "this code", "it")


def _more() -> tuple[dict[str, list[str]], list[tuple[str, list[str]]]]:
    """One-sentence grants of many licences, and the rule of each: identifiers end in the licence they name."""
    names = {k: list(v) for k, v in NAMES.items()}
    out: dict[str, list[str]] = {}
    for kind, (name, versions) in _GNU.items():
        short = kind.lower()
        for version in versions:
            spdx = f"{kind}-{version.replace(' ', '.')}" + ("" if " " in version else ".0")
            marks = [f"{m}{v}" for v in {version, version if " " in version else f"{version} 0"} for m in ("version ", "v", "")]
            names[f"{spdx}-only"] = [f"{name} {m}" for m in marks] + [f"{short} v{version}", f"{short}v{version}", f"{short} {version}"]
            names[f"{spdx}-or-later"] = [f"{x} or {y}" for x in names[f"{spdx}-only"] for y in ("later", "any later version", "at your option any later version")]
            lead = [f"{w} is free software you can redistribute it and or modify it under the terms of the {name} as published by the free software foundation" for w in _WORKS]
            out[f"free:{spdx}-or-later"] = [f"{a} {b}version {version} of the license or {c}any later version" for a in lead for b in ("either ", "") for c in ("at your option ", "")]
            out[f"free:{spdx}-only"] = [f"{a} {b}" for a in lead for b in (f"version {version} of the license", f"version {version}", f"version {version} only", f"in version {version}", f"version {version} of the license only")]
        see = [f"see the {name} for more details", *[f"you should have received a copy of the {name} along with {w}{x}" for w in _WORKS for x in ("", *[f" if not see {h}{g}gnu org licenses" for h in ("http ", "https ", "") for g in ("www ", "")])]]
        out[f"{short}-see"] = see
    for part, words in _CC.items():
        for version, port in (("4.0", "international"), ("3.0", "unported")):
            v, tag = version.replace(".", " "), part.replace("-", " ").lower()
            long = [f"creative commons attribution{w} {v}{p}" for w in {words, words.replace("sharealike", "share alike").replace("noncommercial", "non commercial").replace("noderivatives", "no derivatives")} for p in ("", f" {port}")]
            names[f"CC-BY{part}-{version}"] = [*long, *[f"{x} license" for x in long], f"cc by{tag} {v}", f"creative commons by{tag} {v}"]
    verbs = [f"{a}{b} under {c}" for a in ("", *[f"{d} {n} is " for d in ("this", "the") for n in ("project", "work", "software", "code", "package", "library", "program", "document", "file")])
             for b in ("licensed", "released", "distributed", "available", "made available", "published") for c in ("", "a ", "an ", "the ", "the terms of the ")]
    for spdx, called in names.items():
        out[f"named:{spdx}"] = [f"{verb}{name}" for verb in verbs for name in called]
        out[f"spdx:{spdx}"] = ["spdx license identifier " + " ".join(_WORDS.findall(spdx.lower()))]
        if old := re.fullmatch(r"(A?L?GPL-[\d.]+)-(only|or-later)", spdx):  # older forms of the identifiers: GPL-2.0, GPL-2.0+
            if old[2] == "only":
                out[f"spdx:{spdx}"].append("spdx license identifier " + " ".join(_WORDS.findall(old[1].lower())))
    return out, [(x.partition(":")[2], [x]) for x in out if ":" in x]


# Sequences of sentence identifiers and what they say, in the order in which they are tried.
RULES = [
    ("Apache-2.0", ["apache-2-short", "apache-2-may-not", "apache-2-copy", "apache-2-as-is"]),
    *[("Apache-2.0", [*head, "apache-2-may-not", *copy, "apache-2-as-is", "apache-2-see"][:end])
      for head in (["apache-2-asf", "apache-2-notice", "apache-2-asf-grant"], ["apache-2-asf-grant"], ["apache-2-head"], ["apache-2-short"])
      for copy in (["apache-2-copy", "apache-2-url"], ["apache-2-copy-at"], ["apache-2-copy"]) for end in (None, -1)],
    *[("MIT", [*title, "mit-grant", notice, *rest]) for title in (["mit-title"], []) for notice in ("mit-notice", "mit-notice-next")
      for rest in (["as-is", "mit-liable"], ["as-is-2", "mit-liable"], ["as-is"], ["as-is-2"], [])],
    *[(licence, ["bsd-grant", "bsd-source", "bsd-binary", *more, *rest]) for licence, more in (
        ("BSD-4-Clause", ["bsd-advert", "bsd-product", "bsd-name"]), ("BSD-4-Clause", ["bsd-advert", "bsd-name"]), ("BSD-3-Clause", ["bsd-name"]), ("BSD-2-Clause", []))
      for rest in (["bsd-as-is", "bsd-liable"], ["bsd-as-is"], [])],
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant", "isc-as-is"]),
    ("0BSD", ["0bsd-grant"]),
    ("Unlicense", ["unlicense", "unlicense-anyone"]),
    ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["bsl-short"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("MPL-2.0", ["mpl-2", "mpl-2-copy"]),
    ("MPL-2.0", ["mpl-2"]),
    ("EPL-1.0", ["epl-1"]),
    ("EPL-2.0", ["epl-2"]),
    ("Apache-2.0", ["apache-2-asf-grant"]),
    ("Apache-2.0", ["apache-2-head"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("Apache-2.0", ["apache-2-short"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-under"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-3.0-only", ["gpl-3-short"]),
    ("GPL-2.0-only", ["gpl-2-short"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("All-rights-reserved", ["all-rights"]),
]

_CUT = re.compile(r"(?<=[.!?])[ \t]+|\n")
_WORDS = re.compile(r"[a-z0-9]+")
_ANY_WORDS = re.compile(r"[^\W_]+")
_HINT = re.compile(r"licen[cs]e|copyright|warrant|redistribut|rights reserved|permission is", re.I)
_GAP = 12
_MARK = re.compile(r"[0-9]{1,2}|[a-e]|i{1,3}")

_ADDED, _ADDED_RULES = _more()
SENTENCES |= _ADDED
RULES += _ADDED_RULES


def tables(sentences: dict[str, str | list[str]] = SENTENCES):
    """Tree of the entries' words (None: the identifier that ends there), the first words by which one may begin, longest entry."""
    tree: dict = {}
    heads, longest = set(), 0
    for name, texts in sentences.items():
        for text in [texts] if isinstance(texts, str) else texts:
            words, at = text.split(), tree
            for w in words:
                at = at.setdefault(w, {})
            at.setdefault(None, name)
            heads.add(words[0])
            longest = max(longest, len(words) + (_GAP - 1) * words.count("*"))
    return tree, heads, longest


def _entries(tree: dict, words: list[str], start: int) -> list[tuple[int, str]]:
    """(end, identifier) of all entries that begin at a word, the longest first."""
    found: dict[int, str] = {}
    todo = [(tree, start)]
    while todo:
        at, i = todo.pop()
        if None in at:
            found.setdefault(i, at[None])
        if i < len(words) and words[i] in at:
            todo.append((at[words[i]], i + 1))
        if "*" in at:
            todo += [(at["*"], j) for j in range(i + 1, min(i + _GAP, len(words)) + 1)]
    return sorted(found.items(), reverse=True)


def _chain(tree: dict, words: list[str], ends: set[int], start: int) -> list[tuple[int, int, str]]:
    """Known sentences one after another from ``start`` on that close at an atom's end: (from, to, identifier) in words.

    Longest first; a place from which no end was reached isn't tried again, so steps are at most as many as words.
    """
    stack, tried = [(start, [])], set()
    while stack:
        at, done = stack.pop()
        if at in tried:
            continue
        tried.add(at)
        more = _entries(tree, words, at)
        for end, name in more:
            if end in ends:
                return [*done, (at, end, name)]
        stack += [(end, [*done, (at, end, name)]) for end, name in reversed(more)]
    return []


def _words(atom: str) -> list[str]:
    low = atom.lower()
    if "licenc" in low:
        low = low.replace("licenc", "licens")
    return _WORDS.findall(low) if low.isascii() else _ANY_WORDS.findall(low)


def sentence_ids(text: str | None, tree, heads, longest) -> tuple[int, list[tuple[str, int, int]], int]:
    """Number of atoms with a word, known sentences in order as (identifier, from, to) in characters, number of unknown ones."""
    text = text or ""
    atoms, start = [], 0
    for m in [*_CUT.finditer(text), None]:
        end = m.start() if m else len(text)
        atoms.append((start, end))
        start = m.end() if m else end
    words = [_words(text[a:b]) for a, b in atoms]
    found, unknown, i = [], 0, 0
    while i < len(atoms):
        own, step, skip = words[i], 1, 0
        if len(own) > 1 and own[0] not in heads and _MARK.fullmatch(own[0]):
            skip = 1  # "1) Redistributions ..."
        chain = []
        if len(own) > skip and own[skip] in heads and (len(own) < skip + 2 or own[skip + 1] in tree[own[skip]] or "*" in tree[own[skip]]):
            run, ends, atom_of = [], {}, []
            for j in range(i, len(atoms)):
                run += words[j]
                atom_of += [j] * len(words[j])
                if words[j]:
                    ends[len(run)] = j
                if len(run) > longest:
                    break
            chain = _chain(tree, run, set(ends), skip)
        if chain:
            found += [(name, atoms[atom_of[a]][0], atoms[atom_of[b - 1]][1]) for a, b, name in chain]
            step = ends[chain[-1][1]] - i + 1
        elif _HINT.search(text, *atoms[i]):
            unknown += 1
        i += step
    return sum(1 for a, b in atoms if text[a:b].strip()), found, unknown


def match_rules(ids: list[str], rules=RULES) -> list[tuple[str, int, int]]:
    """(licence, first, last) over the identifier sequence; what no rule takes is passed over."""
    out, i = [], 0
    while i < len(ids):
        for licence, sequence in rules:
            if ids[i : i + len(sequence)] == sequence:
                out.append((licence, i, i + len(sequence) - 1))
                i += len(sequence)
                break
        else:
            i += 1
    return out


def scan(docs: DataFrame, sentences: dict[str, str | list[str]] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per document row: doc_id, n_sentences, sentence_ids, licences (by place), spans (characters of each), n_unknown."""
    schema = "doc_id long, n_sentences long, sentence_ids array<string>, licences array<string>, spans array<struct<from:long,to:long>>, n_unknown long"
    known = docs.sparkSession.sparkContext.broadcast(tables(sentences))

    def look(known, doc_id, text):
        n, found, unknown = sentence_ids(text, *known)
        ids = [x[0] for x in found]
        hits = match_rules(ids, rules)
        return doc_id, n, ids, [h[0] for h in hits], [{"from": found[a][1], "to": found[b][2]} for _, a, b in hits], unknown

    return per_row(docs, ["doc_id", "text"], schema, look, lambda: known.value)
