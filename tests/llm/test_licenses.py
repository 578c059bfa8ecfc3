"""Short notices, and lines that hold several."""

from __future__ import annotations

from salesmart.llm import licenses

NOTICES = {
    "All rights reserved.": "proprietary", "Licensed under MIT": "mit", "MIT License": "mit", "The MIT License (MIT)": "mit",
    "Apache License 2.0": "apache", "BSD 3-Clause License": "bsd", "ISC License": "isc", "The Unlicense": "unlicense",
    "SPDX-License-Identifier: Apache-2.0": "apache", "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: GPL-3.0-or-later": "gpl",
    "SPDX-License-Identifier: LGPL-3.0-only": "lgpl", "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa",
}


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.license_scan(docs).collect()}


def test_short_notices_are_found_also_behind_a_copyright_line(spark):
    texts = {lead + t: f for t, f in NOTICES.items() for lead in ("", "Copyright (c) 2020 A. Author. ", "Copyright 2021 The Authors\n")}
    got = scanned(spark, texts)
    assert {t: got[i].families for i, t in enumerate(texts)} == texts


def test_words_of_short_notices_stay_unknown(spark):
    texts = ["MIT", "The software", "All rights belong to the people.", "Version 2.0", "Copyright (c) 2020 A. Author.", "The museum reserved all seats.", "", "License"]
    assert {r.family for r in scanned(spark, texts).values()} == {"unknown"}


def test_a_line_may_hold_several_licences(spark):
    texts = {
        "Licensed under the MIT License or the Apache License, Version 2.0": "apache,mit",
        "SPDX-License-Identifier: GPL-2.0-only OR BSD-3-Clause": "bsd,gpl",
        "Released under the MIT License. Licensed under CC BY-NC 4.0. Released under the ISC License. All rights reserved.": "cc-by-nc,isc,mit,proprietary",
        "The river was cold. " * 200 + "MIT License" + " The river was cold." * 200 + " Licensed under the Apache License, Version 2.0.": "apache,mit",
        "MIT License\nMIT License or Apache License 2.0": "apache,mit",
        # one notice that uses the words of another family
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License": "agpl",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    }
    got = scanned(spark, texts)
    assert {t: got[i].families for i, t in enumerate(texts)} == texts
    assert [got[i].n_licensed for i in range(len(texts))] == [1, 1, 1, 1, 2, 1, 1]


def test_pairs_of_notices_against_plain_python(spark):
    families = sorted(licenses.TEMPLATES)
    lines = [f"{a} {b}" for f, g in zip(families, families[1:] + families[:1]) for a in licenses.TEMPLATES[f][:2] for b in licenses.TEMPLATES[g][-2:]]
    got, model = scanned(spark, lines), licenses.train()
    assert {i: r.families for i, r in got.items()} == {i: ",".join(sorted(licenses.families_of(model, licenses.tokens(t)))) for i, t in enumerate(lines)}
    assert all("," in r.families for r in got.values())
