import random
import re

import regex
from odd_rows import ODD

from quarrylane.llm import licenses


def found(docs_of, text):
    (r,) = licenses.scan(docs_of([(1, text)])).collect()
    return r.sentence_ids, r.licences, r.unresolved


def test_single_line_notices(docs_of):
    text = "Thing oner.\nLicensed under the Apache License, Version 2.0.\nAnd more\nAll rights reserved.\nLicensed under CC BY-NC 4.0."
    assert found(docs_of, text) == (["Apache-2.0:is", "AllRights", "CC-BY-NC-4.0"], ["Apache-2.0", "LicenseRef-all-rights-reserved", "CC-BY-NC-4.0"], [])
    assert found(docs_of, "x | y |\nThis work is licensed under the GNU General Public License, version 3.")[1] == ["GPL-3.0-only"]
    assert found(docs_of, "released UNDER the mit   license")[1] == ["MIT"]
    assert found(docs_of, "We have a licence to be free. Licensed to kill.") == ([], [], [])


def test_sequences_and_comments(docs_of):
    header = (
        "/* Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance with the License.\n"
        " * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n *\n * Unless required by applicable law or agreed to in writing, software\n"
        " * distributed under the License is distributed on an \"AS IS\" BASIS,\n * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"
        " * See the License for the specific language governing permissions and\n * limitations under the License.\n */"
    )
    ids, names, rest = found(docs_of, header)
    assert names == ["Apache-2.0"] and rest == []
    bsd = licenses.known_sentences()
    both = "\n".join(bsd[k][0] for k in ("BSD:may", "BSD:source", "BSD:binary", "BSD:endorse", "BSD:asis"))
    assert found(docs_of, both)[1] == ["BSD-3-Clause"]
    assert found(docs_of, bsd["BSD:may"][0])[2] == ["BSD:may"]


def test_tables_are_consistent():
    known = licenses.known_sentences()
    assert all(k in known for _, ids in licenses.rules() for k in ids)
    assert all(re.search(licenses.CUE, s) for v in known.values() for s in v)
    seen = {}
    for k, v in known.items():
        for s in v:
            assert seen.setdefault(licenses.normalised_text(s), k) == k


def test_every_known_sentence_verbatim_and_wrapped(docs_of):
    sentences = [(k, s) for k, v in licenses.known_sentences().items() for s in v]
    rows = [(k, f"Some words.\n{t}\nOther words.") for k, s in sentences for t in (s, f"/* {s} */", "/*\n * " + s.replace(" ", "\n *\n * ") + "\n */", s.replace(" ", "\n# "))]
    got = {r.doc_id: r.sentence_ids for r in licenses.recognised(docs_of([(i, t) for i, (_, t) in enumerate(rows)])).collect()}
    assert [(t, got[i]) for i, (k, t) in enumerate(rows) if got[i] != [k]] == []


def test_published_notices(docs_of):
    gpl = (
        " * This program is free\n * software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n * as published by the Free Software Foundation; either version 2\n"
        " * of the License, or (at your option) any later version.\n"
    )
    assert found(docs_of, gpl)[1:] == (["GPL-2.0-or-later"], [])
    mpl = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"
    assert found(docs_of, mpl) == (["MPL-2.0:is", "MPL-2.0:copy"], ["MPL-2.0"], [])
    assert found(docs_of, "All rights\n * reserved.")[0] == ["AllRights"]


def test_tag_lines(docs_of):
    assert found(docs_of, "# SPDX-License-Identifier: LGPL-2.1-or-later\nimport os")[1:] == (["LGPL-2.1-or-later"], [])
    assert found(docs_of, "/* SPDX-License-Identifier: MIT */\n/* SPDX-License-Identifier:\n * Apache-2.0 */")[1] == ["MIT", "Apache-2.0"]


def test_more_notices_and_holders(docs_of):
    texts = {
        "This file is licensed under the MIT License.": ["MIT"], "Licensed under the GNU General Public License v3.0.": ["GPL-3.0-only"], "This software is licensed under the Apache License, Version 2.0.": ["Apache-2.0"],
        "# SPDX-License-Identifier: MIT OR Apache-2.0\nx": ["MIT OR Apache-2.0"], "/* SPDX-License-Identifier: GPL-2.0 */": ["GPL-2.0-only"], "// SPDX-License-Identifier: GPL-2.0+\n": ["GPL-2.0-or-later"],
        "SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0)": ["GPL-2.0-or-later WITH Classpath-exception-2.0"], "SPDX-License-Identifier: MIT OR Nothing-1.0": [],
        "See https://x.org/\nhttps://www.apache.org/licenses/LICENSE-2.0\n": ["Apache-2.0"], "Distributed under the ISC License": ["ISC"], "licensed under the New BSD License.": ["BSD-3-Clause"],
    }
    got = {r.text: r.licences for r in licenses.scan(docs_of(list(enumerate(texts)))).collect()}
    assert got == texts
    known = licenses.known_sentences()
    bsd = "\n".join(known[k][0] for k in ("BSD:may", "BSD:source", "BSD:binary", "BSD:endorse", "BSD:asis", "BSD:liable"))
    for holder in ("Example, Inc.", "the\n * University of X"):
        other = bsd.replace("the copyright holder nor", f"{holder} nor").replace("BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", f"BY {holder}").replace("SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS", f"SHALL {holder}")
        assert other.count(holder) == 3 and found(docs_of, other)[1:] == (["BSD-3-Clause"], [])


def brute_ids(text):
    """Sentences and runs of lines looked up one by one, without Spark."""
    known = {licenses.normalised_text(s): k for k, v in licenses.known_sentences().items() for s in v}
    most, out = max(len(k.split()) for k in known), []
    for unit in regex.split(licenses._ends(), text or ""):
        lines = [x for x in map(licenses.normalised_text, unit.split("\n")) if x]
        at = 0
        while at < len(lines):
            run = next((n for n in range(min(len(lines) - at, most), 0, -1) if " ".join(lines[at : at + n]) in known), 0)
            out += [known[" ".join(lines[at : at + run])]] if run else []
            at += run or 1
    return out


def test_equals_brute_force(spark, docs_of):
    """On the supplied texts, and on known sentences torn apart and mixed with others."""
    rng = random.Random(3)
    sentences = [s for v in licenses.known_sentences().values() for s in rng.sample(v, min(3, len(v)))]
    torn = [rng.choice(["\n", " ", "\n\n"]).join(rng.choice([s, s.replace(" ", "\n * "), s.upper(), s[: len(s) // 2], "Other words. And more"]) for s in rng.sample(sentences, 4)) for _ in range(150)]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + torn
    got = {r.doc_id: r.sentence_ids for r in licenses.recognised(docs_of(list(enumerate(texts)))).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts) if got[i] != brute_ids(t)] == []
    assert sum(map(len, got.values())) > 200


def test_odd_rows(docs_of):
    out = licenses.scan(docs_of(ODD).withColumnRenamed("d", "licences"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "sentence_ids", "licences", "unresolved"]
    assert [r.sentence_ids for r in out.collect()] == [[]] * len(ODD)
    assert licenses.scan(docs_of(ODD).limit(0)).count() == 0
    clashing = licenses.scan(docs_of([(1, "MIT License")]).selectExpr("doc_id", "text", "7 as __all", "8 as _", "9 as `a b`")).first()
    assert (clashing["__all"], clashing["_"], clashing["a b"], clashing.licences) == (7, 8, 9, ["MIT"])
