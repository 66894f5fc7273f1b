"""License scan by sentence rules.

A text is cut into sentences; each is normalised and looked up among known licence sentences; the
sequence of identifiers found is matched against ordered licence rules, the most specific first. A
rule that matches takes its identifiers out of the sequence and leaves the licence's name; what no
rule takes stays as unresolved identifiers.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WHITE, text_of

#: Texts without any of these words hold no known sentence.
CUE = r"(?i)licen[cs]e|copyright|rights reserved|redistribut|warrant|merchantab|permission|public domain|endorse|as is|liab|free software|file except|Mozilla|MPL|(?:released|distributed|available) under".replace(" ", r"[\W_]+")

# Wording of well-known public licence notices, as published with each licence.
_SENTENCES = {
    "AllRights": ["All rights reserved."],
    "Apache-2.0:is": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License");',
        "Released under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License 2.0.",
    ],
    "Apache-2.0:comply": ["you may not use this file except in compliance with the License."],
    "Apache-2.0:copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at"],
    "Apache-2.0:url": ["http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0"],
    "Apache-2.0:asis": [
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ],
    "Apache-2.0:see": ["See the License for the specific language governing permissions and limitations under the License."],
    "MIT:is": ["Released under the MIT License.", "Licensed under the MIT License.", "This work is licensed under the MIT License.", "This project is licensed under the MIT License.", "The MIT License (MIT)", "MIT License"],
    "MIT:grant": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
    ],
    "MIT:notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MIT:asis": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    ],
    "MIT:liable": [
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ],
    "ISC:grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "BSD:may": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSD:source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSD:binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "BSD:endorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ],
    "BSD:asis": [
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'
    ],
    "BSD-3:is": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."],
    "BSD-2:is": ["Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License."],
    "GPL:free": ["This program is free software;", "This program is free software:"],
    "GPL-2:terms": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3:terms": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ],
    "GPL:hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "GPL:implied": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "GPL:see": ["See the GNU General Public License for more details."],
    "MPL-2.0:is": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "MPL-2.0:copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "BSD:liable": [
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ],
    "ISC:asis": [
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'
    ],
    "LGPL:free": ["This library is free software;", "This library is free software:"],
    "LGPL-2.1:terms": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ],
    "LGPL-3:terms": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ],
    "AGPL-3:terms": [
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ],
    "LGPL:hope": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "LGPL:see": ["See the GNU Lesser General Public License for more details."],
    "AGPL:see": ["See the GNU Affero General Public License for more details."],
    "EPL-2.0:is": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ],
    "BSL-1.0:is": ["Distributed under the Boost Software License, Version 1.0."],
    "Zlib:asis": ["This software is provided 'as-is', without any express or implied warranty."],
    "Zlib:liable": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "Zlib:grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "PublicDomain": ["This work is in the public domain.", "Released into the public domain."],
}
_OPENINGS = (
    "Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This project is licensed under", "This file is licensed under", "This software is licensed under", "This code is licensed under",
    "This program is licensed under", "This library is licensed under", "This package is licensed under", "This software is released under", "This file is distributed under",
)
_CC = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
#: Identifier -> the names by which one-line notices call a licence.
_NAMED = {
    "Apache-2.0:is": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache License v2.0", "the Apache 2.0 License", "Apache License 2.0", "Apache-2.0"),
    "MIT:is": ("the MIT License", "the MIT license (MIT)", "MIT License", "MIT", "the terms of the MIT License"),
    "BSD-3:is": ("the BSD 3-Clause License", "the 3-Clause BSD License", "BSD-3-Clause", "the New BSD License"),
    "BSD-2:is": ("the BSD 2-Clause License", "the 2-Clause BSD License", "BSD-2-Clause", "the Simplified BSD License"),
    "ISC:is": ("the ISC License", "ISC"),
    "MPL-2.0:is": ("the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License v2.0", "MPL-2.0"),
    "BSL-1.0:is": ("the Boost Software License, Version 1.0",),
}


# Identifiers of the public list of licences, and of exceptions, that a tag line can name.
_TAGS = "Apache-2.0 MIT ISC Zlib Unlicense 0BSD BSD-2-Clause BSD-3-Clause BSL-1.0 EPL-2.0 MPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0".split()
_EXCEPTIONS = "Classpath-exception-2.0 LLVM-exception GCC-exception-3.1 Bison-exception-2.2 Linux-syscall-note".split()
#: Tag lines also have the identifiers that these replaced; a plus sign meant "or later".
_OLD_TAGS = {t.removesuffix("-only"): t for t in _TAGS if t.endswith("-only")}
_TAG = "SPDX-License-Identifier:"

# A licence's text has places where a holder's name stands; what stands there becomes the words of the known sentence.
_W, _ANY = r"[\W_]+", r"[\s\S]{1,200}?"
_SLOTS = (
    (("neither the name of", "nor the names of its contributors"), "the copyright holder"),
    (("provided by", "as is and any express"), "the copyright holders and contributors"),
    (("in no event shall", "be liable for any direct"), "the copyright holder or contributors"),
)


def _filled(text: Column) -> Column:
    """A text with its slots filled, and old tags with a plus sign written out."""
    out = F.regexp_replace(text, r"(?i)(SPDX-License-Identifier:[^\n]*?\b[AL]?GPL-[0-9.]+)\+", "$1-or-later")
    for (before, after), words in _SLOTS:
        start, end = (x.replace(" ", _W) for x in (before, after))
        out = F.regexp_replace(out, rf"(?i)\b({start}{_W}){_ANY}{_W}({end}\b)", rf"$1{words} $2")
    return out


def known_sentences() -> dict[str, list[str]]:
    """Identifier -> wordings; tag lines and one-line notices follow a pattern."""
    out = {k: list(v) for k, v in _SENTENCES.items()}
    for name in _TAGS:
        out[f"tag:{name}"] = [f"{_TAG} {name}"]
    for old, name in _OLD_TAGS.items():
        out[f"tag:{name}"].append(f"{_TAG} {old}")
    for kind, version in product(_CC, _CC_VERSIONS):
        out[f"CC-{kind}-{version}"] = [f"{o} CC {kind} {version}." for o in _OPENINGS]
    for (short, name), version in product(_GNU.items(), ("2", "2.1", "3")):
        forms = [f"the {name}, version {version}", f"the {name} version {version}", f"the {name} v{version}", f"the {short}v{version}", f"the {short} v{version}"]
        forms += [f"the {name}, version {version}.0", f"the {name} v{version}.0"] if "." not in version else []
        out[f"{short}-{version}:is"] = [f"{o} {f}." for o in _OPENINGS for f in forms]
    for name, forms in _NAMED.items():
        out.setdefault(name, []).extend(f"{o} {f}." for o in _OPENINGS for f in forms)
    return {k: list({normalised_text(x): x for x in reversed(v)}.values())[::-1] for k, v in out.items()}


def rules() -> list[tuple[str, list[str]]]:
    """(licence, identifiers in sequence), in the order in which they are tried: long ones first."""
    made = [
        ("Apache-2.0", ["Apache-2.0:is", "Apache-2.0:comply", "Apache-2.0:copy", "Apache-2.0:asis", "Apache-2.0:see"]),
        ("Apache-2.0", ["Apache-2.0:is", "Apache-2.0:comply", "Apache-2.0:copy"]),
        ("MIT", ["MIT:is", "MIT:grant", "MIT:notice", "MIT:asis", "MIT:liable"]),
        ("MIT", ["MIT:grant", "MIT:notice", "MIT:asis", "MIT:liable"]),
        ("BSD-3-Clause", ["BSD:may", "BSD:source", "BSD:binary", "BSD:endorse", "BSD:asis", "BSD:liable"]),
        ("BSD-2-Clause", ["BSD:may", "BSD:source", "BSD:binary", "BSD:asis", "BSD:liable"]),
        ("BSD-3-Clause", ["BSD:may", "BSD:source", "BSD:binary", "BSD:endorse", "BSD:asis"]),
        ("BSD-2-Clause", ["BSD:may", "BSD:source", "BSD:binary", "BSD:asis"]),
        ("GPL-2.0-or-later", ["GPL:free", "GPL-2:terms", "GPL:hope", "GPL:implied", "GPL:see"]),
        ("GPL-3.0-or-later", ["GPL:free", "GPL-3:terms", "GPL:hope", "GPL:implied", "GPL:see"]),
        ("LGPL-2.1-or-later", ["LGPL:free", "LGPL-2.1:terms", "LGPL:hope", "GPL:implied", "LGPL:see"]),
        ("LGPL-3.0-or-later", ["LGPL:free", "LGPL-3:terms", "LGPL:hope", "GPL:implied", "LGPL:see"]),
        ("AGPL-3.0-or-later", ["GPL:free", "AGPL-3:terms", "GPL:hope", "GPL:implied", "AGPL:see"]),
        ("LGPL-2.1-or-later", ["LGPL:free", "LGPL-2.1:terms"]),
        ("LGPL-3.0-or-later", ["LGPL:free", "LGPL-3:terms"]),
        ("AGPL-3.0-or-later", ["GPL:free", "AGPL-3:terms"]),
        ("GPL-2.0-or-later", ["GPL:free", "GPL-2:terms"]),
        ("GPL-3.0-or-later", ["GPL:free", "GPL-3:terms"]),
        ("MPL-2.0", ["MPL-2.0:is", "MPL-2.0:copy"]),
        ("MPL-2.0", ["MPL-2.0:is"]),
        ("ISC", ["ISC:grant", "ISC:asis"]),
        ("ISC", ["ISC:grant"]),
        ("Zlib", ["Zlib:asis", "Zlib:liable", "Zlib:grant"]),
        ("EPL-2.0", ["EPL-2.0:is"]),
        ("BSL-1.0", ["BSL-1.0:is"]),
        ("Apache-2.0", ["Apache-2.0:is", "Apache-2.0:url"]),
        ("Apache-2.0", ["Apache-2.0:is"]),
        ("Apache-2.0", ["Apache-2.0:url"]),
        ("MIT", ["MIT:is"]),
        ("ISC", ["ISC:is"]),
        ("BSD-3-Clause", ["BSD-3:is"]),
        ("BSD-2-Clause", ["BSD-2:is"]),
        ("Unlicense", ["Unlicense"]),
        ("LicenseRef-public-domain", ["PublicDomain"]),
        ("LicenseRef-all-rights-reserved", ["AllRights"]),
    ]
    made += [(name, [f"tag:{name}"]) for name in _TAGS]
    made += [(f"CC-{k}-{v}", [f"CC-{k}-{v}"]) for k, v in product(_CC, _CC_VERSIONS)]
    numbers = {"2": "2.0-only", "2.1": "2.1-only", "3": "3.0-only"}
    return made + [(f"{s}-{numbers[v]}", [f"{s}-{v}:is"]) for s, v in product(_GNU, numbers)]


def normalised(sentence: Column) -> Column:
    """Lower case; runs of anything but letters, digits and points inside numbers become one space."""
    spaced = F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}.]+|\.(?!\d)", " ")
    return F.trim(F.regexp_replace(spaced, " +", " "))


def normalised_text(sentence: str) -> str:
    """The same for a plain string."""
    spaced = re.sub(r"[^\w.]+|_+|\.(?!\d)", " ", sentence.lower())
    return re.sub(" +", " ", spaced).strip()


def _ends() -> str:
    """Where a text is cut: after a sentence's end, unless a known sentence goes on there, and at empty lines."""
    inside = {(m[1].lower(), m[2].lower()): None for v in known_sentences().values() for s in v for m in re.finditer(r"(\w+)[.;:!?]\s+(\w+)", s)}
    goes_on = "".join(rf"(?!(?<=\b{a}[.;:!?])[^\p{{L}}\p{{N}}]*{b}\b)" for a, b in inside)
    return rf"(?i)(?<=[.;:!?]){goes_on}{WHITE}|\n[\x20\x09]*\n"


def _sentences(unit: Column, known: dict[str, str]) -> Column:
    """Identifiers in a unit: at each line that is not in the run before, the longest run of lines that is a known sentence."""
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    openings = list(dict.fromkeys(" ".join(s.split()[:k]) for s in known for k in (1, 2, 3)))
    most = max(len(s.split()) for s in known)  # every line has a word at least
    lines = F.array_remove(F.transform(F.split(unit, "\n"), normalised), "")

    def at(line: Column, i: Column) -> Column:
        lengths = F.sequence(F.least(F.size(lines) - i, F.lit(most)), F.lit(1), F.lit(-1))
        runs = F.transform(lengths, lambda n: F.struct(i.alias("first"), (i + n).alias("end"), F.try_element_at(table, F.array_join(F.slice(lines, i + 1, n), " ")).alias("id")))
        return F.when(F.substring_index(line, " ", 3).isin(openings), F.get(F.filter(runs, lambda r: r["id"].isNotNull()), F.lit(0)))

    def next_one(so_far: Column, run: Column) -> Column:
        longer = F.struct(run["end"].alias("end"), F.concat(so_far["ids"], F.array(run["id"])).alias("ids"))
        return F.when(run["first"] >= so_far["end"], longer).otherwise(so_far)

    tags = {normalised_text(k): v for k, v in {**{t: t for t in (*_TAGS, *_EXCEPTIONS)}, **_OLD_TAGS}.items()}
    known_tags = F.create_map(*(F.lit(x) for pair in tags.items() for x in pair))

    def expression(line: Column, i: Column) -> Column:
        """A tag line that joins several identifiers: all of them, with the words that join them; grouping is dropped."""
        rest = F.substring(line, len(normalised_text(_TAG)) + 2, 1 << 20)
        names = F.transform(F.split(rest, " (?:or(?! later)|and|with) "), lambda n: F.try_element_at(known_tags, n))
        joins = F.concat(F.array(F.lit("")), F.transform(F.regexp_extract_all(rest, F.lit(" (or(?! later)|and|with) "), F.lit(1)), lambda w: F.concat(F.lit("_"), F.upper(w), F.lit("_"))))
        whole = F.array_join(F.zip_with(joins, names, lambda j, n: F.concat(j, n)), "")
        fits = line.startswith(normalised_text(_TAG) + " ") & (F.size(names) > 1) & F.forall(names, lambda n: n.isNotNull())
        return F.when(fits, F.struct(i.alias("first"), (i + 1).alias("end"), F.concat(F.lit("tag:"), whole).alias("id")))

    def found(line: Column, i: Column) -> Column:
        return F.coalesce(at(line, i), expression(line, i))

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(F.array_compact(F.transform(lines, found)), start, next_one, lambda x: x["ids"])


def recognised(docs: DataFrame) -> DataFrame:
    """docs with sentence_ids (an array): the known licence sentences of each text, in order."""
    known = {s: k for k, v in known_sentences().items() for s in map(normalised_text, v)}
    units = F.filter(F.split(_filled(text_of()), _ends()), lambda x: x.rlike(CUE))
    found = F.flatten(F.transform(units, lambda u: _sentences(u, known)))
    none = F.array().cast("array<string>")
    return docs.withColumn("sentence_ids", F.when(text_of().rlike(CUE), found).otherwise(none))


def resolved(ids: Column) -> Column:
    """An identifier sequence after all rules: licences in angle brackets, unresolved identifiers as they are."""
    out = F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))
    for licence, sequence in rules():
        out = F.replace(out, F.lit(" " + "  ".join(sequence) + " "), F.lit(f" <{licence}> "))
    out = F.regexp_replace(out, r" tag:(\S+_(?:OR|AND|WITH)_\S+) ", " <$1> ")
    return F.array_remove(F.split(out, " +"), "")


def scan(docs: DataFrame) -> DataFrame:
    """docs with sentence_ids, licences and unresolved (arrays of strings).

    licences has a name for each match of a rule, in order, repeats included; of a tag line that
    joins several identifiers, the expression (MIT OR Apache-2.0). A null or empty text has none; a
    text of any length is read whole. Rows (repeated ones too) and other columns are kept, whatever
    they are called; columns with the new names are replaced. An empty table gives no rows.
    """
    held = docs.drop("sentence_ids", "licences", "unresolved")
    found = recognised(held)
    none, both = F.array().cast("array<string>"), "_"
    while both in held.columns:
        both += "_"
    made = found.withColumn(both, F.when(F.size("sentence_ids") > 0, resolved(F.col("sentence_ids"))).otherwise(none))
    licences = F.transform(F.filter(both, lambda x: x.startswith("<")), lambda x: F.replace(F.substr(x, F.lit(2), F.char_length(x) - 2), F.lit("_"), F.lit(" ")))
    return made.withColumns({"licences": licences, "unresolved": F.filter(both, lambda x: ~x.startswith("<"))}).drop(both)
