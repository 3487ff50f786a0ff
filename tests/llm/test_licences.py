"""Licence scans on the headers that public licences prescribe."""
from allelespark.llm import license_rules

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """3. Neither the name of Example Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
LGPL = """/* This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 */
"""
CASES = [
    (APACHE, ["Apache-2.0"]), (APACHE.split("\n")[0], ["Apache-2.0"]), (" ".join(APACHE.split()), ["Apache-2.0"]), ("".join(f"# {x}\n" for x in APACHE.split("\n")), ["Apache-2.0"]),
    (APACHE.replace('"', "“"), ["Apache-2.0"]), (BSD_2, ["BSD-2-Clause"]), (BSD_3, ["BSD-3-Clause"]), (LGPL, ["LGPL-2.1-or-later"]),
    ("// SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0-only"]), ("Released under the MIT Licence.", ["MIT"]),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("It is not licensed under the MIT License.", []), ("Licensed under CC BY 4.0 日本", []),
]


def test_real_headers(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_rules.scan(docs).collect()}
    assert [got[i].licences for i in range(len(CASES))] == [want for _, want in CASES]
    assert got[0].n_unknown == got[6].n_unknown == 0
    span = got[6].spans[0]
    assert BSD_3[span["from"] : span["to"]].startswith("Redistribution and use") and BSD_3[span["from"] : span["to"]].endswith("permission.")


def test_a_long_chain_has_no_cap():
    """Many ways to go on that end nowhere, before the one that does: 2**20 paths by a plain search, 64 steps by the old one."""
    from allelespark.llm import license_rules as L

    entries = {f"s{i}": text for i, text in enumerate(["a", "a a", "a a a", "z end"])}
    tree, heads, longest = L.tables(entries)
    words = ["a"] * 200 + ["z", "end"]
    chain = L._chain(tree, words, {len(words)}, 0)
    assert chain[0][0] == 0 and chain[-1] == (200, 202, "s3") and all(a[1] == b[0] for a, b in zip(chain, chain[1:]))
    assert L._chain(tree, words[:-1], {999}, 0) == []
