"""Notices and inheritance against a plain version; odd rows."""

import re
import textwrap

from rosterworks.llm import licenses as L
from rosterworks.llm.queries import QUERIES, table
from pyspark.sql import functions as F

ROOT = "/root/testdata/sf0.01"
NOTICES = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}


def lines(body):
    return F.split(F.coalesce(body, F.lit("")), "\n")


def directory(url):
    return re.sub(r"/?[^/]*$", "", re.sub(r"^[a-z]+://|[?#].*$", "", url))


def test_whole_table(spark):
    pages = table(spark, ROOT, "pages").collect()
    own = {p.page_id: next((v for k, v in NOTICES.items() if re.search(rf"[>\n]{re.escape(k)}[<\n]", p.html)), None) for p in pages}
    votes = {}
    for p in pages:
        if own[p.page_id]:
            votes.setdefault(directory(p.url), set()).add(own[p.page_id])
    agreed = {d: next(iter(v)) for d, v in votes.items() if len(v) == 1}
    got = {r.page_id: r for r in QUERIES["op8_licenses"](spark, ROOT).collect()}
    assert len(got) == len(pages)
    for p in pages:
        parts = directory(p.url).split("/")
        near = next((agreed[d] for k in range(len(parts), 0, -1) if (d := "/".join(parts[:k])) in agreed), None)
        assert (got[p.page_id].own_license, got[p.page_id].license) == (own[p.page_id], own[p.page_id] or near)


def test_files_and_directories(spark):
    rows = [
        (1, "proj/LICENSE", "MIT\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
        (2, "proj/src/a.c", "int main() {}"),
        (3, "proj/src/deep/b.c", "// Licensed under the Apache License, Version 2.0"),
        (4, "proj/src/deep/c.c", "nothing"),
        (5, "other/x.c", "We work under the licence of nobody, version 2"),
        (6, "proj/mixed.c", "Released under the MIT license"),
        (7, None, None),
    ]
    frame = spark.createDataFrame([(*r, "w", 1) for r in rows], "file_id long, path string, body string, weight string, key int")
    got = {r.file_id: (r.license, r.found, r.license_directory) for r in L.scan_licenses(frame, lines, least=0.6).collect()}
    assert got[1] == ("MIT", "file", "proj") and got[2] == ("MIT", "inherited", "proj") and got[3] == ("Apache-2.0", "header", "proj/src/deep")
    assert got[4] == ("Apache-2.0", "inherited", "proj/src/deep") and got[5][1] == "none" and got[6] == ("MIT", "header", "proj") and got[7] == (None, "none", None)
    assert L.scan_licenses(frame.where("false"), lines).count() == 0
    assert L.scan_licenses(frame.union(frame), lines).count() == 2 * len(rows)


def comment(text, width=68):
    return "\n".join(f" * {line}" for line in textwrap.wrap(text, width))


def test_headers_and_whole_texts(spark):
    """Notices in longer lines, over several lines and in whole licence texts, with the registered parameters."""
    want = {
        "Copyright 2024 Example. Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Copyright 2020 Jane Doe. Released under the MIT License.": "MIT",
        "MIT License": "MIT",
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.": "GPL-3.0-only",
        "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "LGPL-3.0-only",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        comment("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."): "BSD-3-Clause",
        "/*\n * Copyright (c) 2021, The Authors\n" + comment(L.TEXTS["BSD-2-Clause"]) + "\n */\nint main() {}": "BSD-2-Clause",
        "/*\n * Copyright (c) 2021, The Authors\n" + comment(L.TEXTS["BSD-3-Clause"]) + "\n */\nint main() {}": "BSD-3-Clause",
        "Copyright 2022 Somebody\n\n" + "\n".join(textwrap.wrap(L.TEXTS["ISC"], 70)): "ISC",
        "MIT": None,
        "She studied at MIT. The license of the car was lost.": None,
        "nothing here": None,
    }
    rows = [(k, f"d{k}/a.c", body) for k, body in enumerate(want)] + [(1000 + k, f"p{k}/x.c", f"some plain words about the license of work number {k}") for k in range(40)]
    rows.append((100, "lib/COPYING", "Copyright (c) 2021, The Authors\nAll rights reserved.\n\n" + "\n".join(textwrap.wrap(L.TEXTS["BSD-2-Clause"], 72))))
    got = {r.file_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, body string"), lines).collect()}
    assert {body: got[k].own_license for k, body in enumerate(want)} == want
    assert (got[100].own_license, got[100].found) == ("BSD-2-Clause", "file")
    assert all(got[k].own_license is None for k in range(1000, 1040))


def test_common_words_weigh_less(spark):
    """Words that stand in every line with a notice weigh little, wherever they come from."""
    rows = [(k, f"d{k}/a.c", f"Released under the MIT License acme tools {k if k else ''}") for k in range(1)] + [(k, f"e{k}/b.c", f"acme tools license topic{k}") for k in range(1, 400)]
    got = {r.file_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, body string"), lines).collect()}
    assert got[0].own_license == "MIT" and got[0].own_score > 0.95


def gnu(kind, name, version):
    return f"This {kind} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation; {version}"


LATER = "either version {} of the License, or (at your option) any later version."
HEADERS = {
    "GNU General Public License version 2 as published by the Free Software Foundation": "GPL-2.0-only",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.": "GPL-2.0-only",
    gnu("program", "", "version 2 of the License."): "GPL-2.0-only",
    gnu("program", "", LATER.format(2)): "GPL-2.0-or-later",
    gnu("program", "", LATER.format(3)): "GPL-3.0-or-later",
    gnu("program", "Affero ", LATER.format(3)): "AGPL-3.0-or-later",
    gnu("program", "Affero ", "version 3 of the License."): "AGPL-3.0-only",
    gnu("library", "Lesser ", LATER.format("2.1")): "LGPL-2.1-or-later",
    gnu("library", "Lesser ", LATER.format("3")): "LGPL-3.0-or-later",
    "Licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0-only",
    "Licensed under the GPL version 2 or later.": "GPL-2.0-or-later",
    "Licensed under the GPL v3.": "GPL-3.0-only",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "BSL-1.0",
    "Licensed under the Apache License, Version 2": "Apache-2.0",
    "Licensed under the Apache License, Version 1.1.": None,
    "SPDX-License-Identifier: MIT": "MIT",
    "// SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later",
    "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "SPDX-License-Identifier: Nothing-1.0": None,
    "This file is not licensed under the MIT License.": None,
    "The work was never released under the MIT License.": None,
}


def test_standard_headers(spark):
    """Each header on one line and wrapped in a comment, among files that mention licences."""
    bodies = [b for h in HEADERS for b in (h, "/*\n" + comment(h) + "\n */\nint main() {}")]
    rows = [(k, f"d{k}/a.c", body) for k, body in enumerate(bodies)] + [(1000 + k, f"p{k}/x.c", f"some plain words about the license of work number {k}") for k in range(40)]
    got = {r.file_id: r.own_license for r in L.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, body string"), lines).collect()}
    names = [n for n in HEADERS.values() for _ in range(2)]
    assert {bodies[k]: got[k] for k in range(len(bodies))} == dict(zip(bodies, names, strict=True))
    assert all(got[1000 + k] is None for k in range(40))


def test_odd_files(spark):
    """Nulls, empty and very long bodies, repeated rows, clashing columns and an empty table."""
    long = "word soup and more " * 60_000
    rows = [(1, None, None), (2, "", ""), (3, "a/b.c", long + "\nReleased under the MIT License.\n" + long), (3, "a/b.c", long + "\nReleased under the MIT License.\n" + long), (None, "c/d.c", "MIT License"), (4, "e/LICENSE", None), (5, "a/x", "\n\n \t")]
    frame = spark.createDataFrame([(*r, "k", 1.0, "t") for r in rows], "file_id long, path string, body string, key string, idf double, terms string")
    got = sorted(((r.file_id or 0, r.license, r.found) for r in L.scan_licenses(frame, lines).collect()), key=str)
    assert got == [(0, "MIT", "header"), (1, None, "none"), (2, None, "none"), (3, "MIT", "header"), (3, "MIT", "header"), (4, None, "none"), (5, "MIT", "inherited")]
    assert L.scan_licenses(frame.where("false"), lines).count() == 0
