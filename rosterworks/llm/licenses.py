"""License scan: notices by TF-IDF cosine to templates, then inheritance from the nearest directory.

A file is cut into pieces at the ends of lines and sentences. A piece, and a run of up to WIDTH of
them (wrapped notices), is a sparse vector over all its terms, with weights from the pieces of the
whole table; runs begin and end in a piece with a word of a template, since others only dilute. A
file's notice is the template closest to any run. Licence files as wholes, and what follows the
opening words of a licence text anywhere, are held against whole licence texts as well; these tell
licences apart that share a notice. A directory has a licence if its licence files agree on one
or, without licence files, all notices in it do; files without a notice take the licence of the
nearest directory above them, by an equi-join on the paths of their directory's ancestors.

DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Notices as projects print them, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "GPL-2.0-only": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0-only": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3."),
    "MIT": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
_PROGRAM = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; "
_LIBRARY = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; "
_ONLY, _LATER = "version {} of the License.", "either version {} of the License, or (at your option) any later version."


def _gnu(name: str, adjective: str, version: str, dated: str) -> dict[str, tuple[str, ...]]:
    """The usual headers and short notices of one version of a GNU licence, alone and with later ones."""
    full, short = f"GNU {adjective}General Public License", {"": "GPL", "Lesser ": "LGPL", "Affero ": "AGPL"}[adjective]
    only = (
        f"{full} Version {version}, {dated}",
        f"This work is licensed under the {full}, version {version}.",
        f"Licensed under the {full} version {version} as published by the Free Software Foundation.",
        f"Licensed under the {short} version {version}.",
        f"Licensed under {short}v{version}.",
        *(kind.format(adjective) + _ONLY.format(version) for kind in (_PROGRAM, _LIBRARY)),
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {full} version {version} as published by the Free Software Foundation.",
        f"This file may be distributed under the terms of the {full} version {version}.",
    )
    later = (
        *(kind.format(adjective) + _LATER.format(version) for kind in (_PROGRAM, _LIBRARY)),
        f"Licensed under the {full} version {version} or later.",
        f"Licensed under the {short} version {version} or later.",
        f"Licensed under {short}v{version} or later.",
        f"This work is licensed under the {full}, version {version} or any later version.",
    )
    return {f"{name}-only": only, f"{name}-or-later": later}


# Further notices and the titles of licence texts. The SQL of op8_licenses knows TEMPLATES alone.
MORE_NOTICES = {
    **_gnu("GPL-2.0", "", "2", "June 1991"),
    **_gnu("GPL-3.0", "", "3", "29 June 2007"),
    **_gnu("LGPL-2.1", "Lesser ", "2.1", "February 1999"),
    **_gnu("LGPL-3.0", "Lesser ", "3", "29 June 2007"),
    **_gnu("AGPL-3.0", "Affero ", "3", "19 November 2007"),
    "Apache-2.0": ("Apache License Version 2.0, January 2004",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Licensed under the BSD 2-Clause License."),
    "BSD-3-Clause": ("BSD 3-Clause License", "Licensed under the BSD 3-Clause License."),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "EPL-2.0": ("Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "Licensed under the Eclipse Public License, version 2.0."),
    "ISC": ("ISC License", "Licensed under the ISC License."),
    "MIT": ("MIT License", "Licensed under the MIT License."),
    "MPL-2.0": ("Mozilla Public License Version 2.0",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "The Unlicense"),
}
#: Licences that a line "SPDX-License-Identifier: ..." may name.
SPDX = sorted({*TEMPLATES, *MORE_NOTICES} - {"GPL-2.0", "GPL-3.0"})
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAME = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'
    " IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Whole licence texts from their opening words on.
TEXTS = {
    "BSD-2-Clause": _BSD + _BSD_END,
    "BSD-3-Clause": _BSD + _BSD_NAME + _BSD_END,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'
    " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}
WIDTH = 6
#: Of templates with no more terms than this, every term must be there: one word alone says too little.
SHORT = 3
# Words too common to speak for a licence.
STOP = ("a", "an", "and", "any", "are", "at", "be", "by", "can", "for", "in", "is", "it", "may", "not", "of", "or", "that", "the", "this", "to", "with", "you")
# Words of templates that ordinary text is full of; a run of pieces does not begin or end with them alone.
COMMON = ("as", "available", "copy", "distributed", "domain", "either", "file", "form", "following", "free", "general", "https", "library", "made", "materials", "person", "program", "public", "published", "released", "source", "terms", "under", "use", "which", "work")
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)(\.[a-z]+)?$"


#: How a version is written, and what does away with ".0" at its end, so that 2 and 2.0 are one: both as pattern and replacement.
VERSION = (r"\bv(?:ersion)?[.:]?\s*([0-9]+(?:[.][0-9]+)*)", "version-")
ROUND = r"(version-[0-9]+(?:[.][0-9]+)*?)(?:[.]0)+\b"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Wording that takes back the notice that follows.
DENIED = r"(?i)\b(?:not|never|no longer|isn't|aren't)\s+(?:be\s+|been\s+)?(?:licensed|released|distributed|available|covered)\b"


def terms_of(line: Column) -> Column:
    """Lower-case runs of letters, digits and inner dots or hyphens, without stop words; a version is one term with its number."""
    named = F.regexp_replace(F.lower(line), VERSION[0], VERSION[1] + "$1")
    return F.filter(F.regexp_extract_all(F.regexp_replace(named, ROUND, "$1"), F.lit(TERM), 0), lambda t: ~t.isin(*STOP))


def must_hold(license: str, term: str) -> bool:
    """Whether a notice without this term of the template is another licence's: its version, and "later" where later ones count."""
    return term.startswith("version-") or (term == "later" and license.endswith("-or-later"))


def template_terms(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, int, str, int]]:
    """(licence, number of the notice, term, count)."""
    found = []
    for name, notices in templates.items():
        for k, notice in enumerate(notices):
            named = re.sub(ROUND, r"\1", re.sub(VERSION[0], VERSION[1] + r"\1", notice.lower()))
            words = Counter(w for w in re.findall(TERM, named) if w not in STOP)
            found += [(name, k, word, n) for word, n in words.items()]
    return found


def pieces_of(lines: Column) -> Column:
    """The lines, cut after the marks that end sentences and clauses."""
    return F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.;:!?])\s+")))


def visible_lines(html: Column) -> Column:
    """The lines of a page: tags, scripts, styles and comments end a line."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", "\n")
    return F.filter(F.split(bare, "\n"), lambda x: F.length(x) > 0)


def directory_of(path: Column) -> Column:
    """host/dir/dir of a URL or path, without scheme, query, fragment and file name."""
    plain = F.regexp_replace(F.coalesce(path, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://|[?#].*$", "")
    return F.regexp_replace(plain, r"/?[^/]*$", "")


def file_name_of(path: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(F.coalesce(path, F.lit("")), r"[?#].*$", ""), r"([^/]*)$", 1)


def _runs(rows: DataFrame, lines, vocabulary: list[str]) -> DataFrame:
    """key, first, last, terms: runs of pieces that begin and end in one with a word of the vocabulary."""
    word = F.lit("(?<![a-z0-9])(?:" + "|".join(map(re.escape, vocabulary)) + ")(?![a-z0-9])")
    cut = rows.select("key", pieces_of(lines(F.col("body"))).alias("pieces")).where(F.size("pieces") > 0)
    cut = cut.select("key", "pieces", F.transform("pieces", lambda x: F.rlike(F.lower(x), word)).alias("hits"))
    starts = F.filter(F.sequence(F.lit(1), F.size("pieces")), lambda i: F.element_at("hits", i))
    begun = cut.select("key", F.explode(F.transform(starts, lambda i: F.struct(i.alias("first"), F.slice("pieces", i, WIDTH).alias("text"), F.slice("hits", i, WIDTH).alias("hits")))).alias("r"))
    ends = F.filter(F.sequence(F.lit(1), F.size("r.hits")), lambda k: F.element_at("r.hits", k))
    runs = begun.select("key", "r.first", "r.text", F.explode(ends).alias("n"))
    run = F.array_join(F.slice("text", 1, F.col("n")), "\n")
    runs = runs.select("key", "first", (F.col("first") + F.col("n") - 1).alias("last"), F.when(~run.rlike(DENIED), terms_of(run)).alias("terms"))
    return runs.where(F.arrays_overlap("terms", F.lit(vocabulary))).distinct()


def _texts(rows: DataFrame, lines, texts: dict[str, str]) -> DataFrame:
    """key, license, part, terms: licence files as wholes, and stretches from opening words on, as long as a text."""
    opening = "|".join(r"\b" + "[^A-Za-z0-9]+".join(re.findall("[A-Za-z0-9]+", text)[:3]) + r"\b" for text in texts.values())
    held = rows.where(F.col("named") | F.col("body").rlike("(?i)" + opening)).select("key", "named", F.array_join(lines(F.col("body")), "\n").alias("text"))
    wholes = held.where("named").select("key", F.lit(0).alias("part"), terms_of(F.col("text")).alias("terms"))
    tails = held.select("key", F.lit(1).alias("part"), terms_of(F.regexp_extract("text", f"(?is)(?:{opening}).*", 0)).alias("terms"))
    sizes = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(sum(n for *_, n in template_terms({name: (text,)}))).alias("n")) for name, text in texts.items()])
    both = wholes.unionByName(tails).where(F.size("terms") > 0).withColumn("t", F.explode(sizes))
    return both.select("key", F.col("t.license").alias("license"), "part", F.when(F.col("part") == 1, F.slice("terms", F.lit(1), F.col("t.n"))).otherwise(F.col("terms")).alias("terms")).distinct()


def scan_licenses(files: DataFrame, lines, templates: dict[str, tuple[str, ...]] | None = None, least: float = 0.75, texts: dict[str, str] | None = None) -> DataFrame:
    """A row for every row of files (file_id, path, body): file_id, directory, own_license, own_score,
    license, found ("file", "header", "inherited" or "none") and license_directory.

    ``lines`` turns the body into an array of lines. A notice counts from a cosine of ``least``, and so
    does a whole licence text, which stands before a notice unless that is of a licence without such a
    text; of equally close templates the first in alphabetical order wins. Given ``templates`` replace
    both the notices and the texts. Null and empty bodies have no
    notice of their own, null paths lie in the directory "" and so inherit nothing but from it. Rows
    that repeat id, path and body repeat in the result. More columns are ignored; an empty table gives
    an empty table.
    """
    spark = files.sparkSession
    texts = texts if texts is not None else TEXTS if templates is None else {}
    if templates is None:
        templates = {name: (*TEMPLATES.get(name, ()), *MORE_NOTICES.get(name, ()), f"SPDX-License-Identifier: {name}") for name in SPDX}
    known = template_terms(templates)
    vocabulary = sorted({t for _, _, t, _ in known if t not in COMMON and not re.fullmatch(f"{VERSION[1]}[0-9.]+", t)})
    rows = files.select("file_id", directory_of(F.col("path")).alias("directory"), file_name_of(F.col("path")).rlike(LICENCE_FILE).alias("named"), F.xxhash64("file_id", "path", "body").alias("key"), "body")
    seen = materialize(_runs(rows, lines, vocabulary), "runs")
    total = max(1, seen.where("first = last").count())
    df = seen.where("first = last").select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").count()
    df = materialize(df.select("term", (F.log((1 + total) / (1 + F.col("count"))) + 1).alias("idf")), "terms")
    unseen = math.log(1 + total) + 1
    whole_terms = [(name, -1, t, n) for name, text in texts.items() for _, _, t, n in template_terms({name: (text,)})]
    asked = sorted({t for _, _, t, _ in known + whole_terms})
    idf = {t: unseen for t in asked} | {r.term: r.idf for r in df.where(F.col("term").isin(asked)).collect()}

    def weights_of(listed):
        norms: dict[tuple[str, int], float] = {}
        terms = Counter((name, k) for name, k, _, _ in listed)
        musts = Counter((name, k) for name, k, term, _ in listed if must_hold(name, term))
        for name, k, term, n in listed:
            norms[name, k] = norms.get((name, k), 0.0) + (n * idf[term]) ** 2
        given = [(name, k, t, idf[t], n * idf[t] / math.sqrt(norms[name, k]), terms[name, k] if terms[name, k] <= SHORT else 0, int(must_hold(name, t)), musts[name, k]) for name, k, t, n in listed]
        return F.broadcast(spark.createDataFrame(given, "license string, notice int, term string, idf double, weight double, need int, must int, musts int"))

    def sized(counts, unit):
        """Norms with the weights of all terms; frequent ones are template words or were cut off before."""
        return counts.join(df, "term", "left").groupBy(*unit).agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.coalesce("idf", F.lit(unseen)), F.lit(2)))).alias("norm"))

    unit = ["key", "first", "last"]
    weights = weights_of(known)
    counts = seen.select(*unit, F.explode("terms").alias("term")).groupBy(*unit, "term").agg(F.count("*").alias("tf"))
    bare = counts.join(weights.select("term", "idf").distinct().hint("broadcast"), "term").groupBy(*unit).agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), F.lit(2)))).alias("bare"))
    dots = counts.join(weights, "term").groupBy(*unit, "license", "notice").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"), F.count("*").alias("terms"), F.max("need").alias("need"), F.sum("must").alias("held"), F.max("musts").alias("musts"))
    # The norm over template words alone is a lower bound: what does not reach the threshold with it cannot reach it at all.
    hopeful = materialize(dots.where("terms >= need AND held >= musts").join(bare, unit).where(F.col("dot") / F.col("bare") >= least - 1e-6).drop("bare", "terms", "need", "held", "musts"), "hopeful")
    norms = sized(counts.join(hopeful.select(*unit).distinct(), unit, "left_semi"), unit)
    close = hopeful.join(norms, unit).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= least)
    best = lambda found: found.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("order"), "license")).alias("top"))
    own = best(close).select("key", F.col("top.license").alias("own_license"), (-F.col("top.order")).alias("own_score"))
    if texts:
        part = ["key", "license", "part"]
        counts = materialize(_texts(rows, lines, texts).select(*part, F.explode("terms").alias("term")).groupBy(*part, "term").agg(F.count("*").alias("tf")), "texts")
        dots = counts.join(weights_of(whole_terms).drop("notice"), ["license", "term"]).groupBy(*part).agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
        full = best(dots.join(sized(counts, part), part).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= least))
        own = own.join(full, "key", "full")
        first = F.col("top").isNotNull() & (F.col("own_license").isNull() | F.col("own_license").isin(*texts))
        own = own.select("key", F.when(first, F.col("top.license")).otherwise(F.col("own_license")).alias("own_license"), F.when(first, -F.col("top.order")).otherwise(F.col("own_score")).alias("own_score"))
    own = materialize(own, "notices")

    placed = materialize(rows.select("file_id", "directory", "named", "key").join(own, "key", "left"), "placed")
    votes = placed.where("own_license IS NOT NULL").groupBy("directory").agg(
        F.min(F.when(F.col("named"), F.col("own_license"))).alias("file_low"), F.max(F.when(F.col("named"), F.col("own_license"))).alias("file_high"), F.min("own_license").alias("low"), F.max("own_license").alias("high")
    )
    agreed = F.when(F.col("file_low").isNotNull(), F.when(F.col("file_low") == F.col("file_high"), F.col("file_low"))).when(F.col("low") == F.col("high"), F.col("low"))
    licensed = votes.select(F.col("directory").alias("license_directory"), agreed.alias("inherited")).where("inherited IS NOT NULL")
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    climbs = placed.select("directory").distinct().select("directory", F.posexplode(above).alias("depth", "license_directory"))
    nearest = climbs.join(licensed, "license_directory").groupBy("directory").agg(F.max(F.struct("depth", "license_directory", "inherited")).alias("near"))
    nearest = materialize(nearest.select("directory", F.col("near.license_directory").alias("license_directory"), F.col("near.inherited").alias("inherited")), "directories")
    result = placed.join(nearest, "directory", "left")
    has = F.col("own_license").isNotNull()
    return result.select(
        "file_id",
        "directory",
        "own_license",
        "own_score",
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(has & F.col("named"), "file").when(has, "header").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(has, F.col("directory")).otherwise(F.col("license_directory")).alias("license_directory"),
    )
