"""License scans: TF-IDF cosine of statements and licence files to templates, then
inheritance from the nearest ancestor directory.  DataFrame operations only."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.operators.joins import sized_broadcast

__all__ = ["TEMPLATES", "HEADERS", "SPDX", "REQUIRED", "EXCLUDED", "SUPERSEDED", "templates", "scan_licenses", "tokens"]

# License identifiers and the statements by which files declare them.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License, CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This program is free software licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# Standard headers and titles as the licences' own texts give them; found wherever they stand, wrapped or within longer lines.
HEADERS = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
                 "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                 "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                 "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]

_TAG = "spdx-license-identifier"
SPDX = [(k, f"SPDX-License-Identifier: {k}{end}") for k, _ in TEMPLATES for end in ("", *(("-only", "-or-later") if "GPL" in k else ()))]

# What tells neighbours apart.  Where a template has one of its licence's words, a line or passage with
# none of them cannot win it, nor one with a word of another licence; a text that holds the passage of the second of a pair is not under the first.
REQUIRED = {
    "AGPL-3.0": ["affero", "agpl", "agpl-3.0"],
    "Apache-2.0": ["apache", "apache-2.0"],
    "BSD-2-Clause": ["2", "2-clause", "bsd-2-clause", "two-clause"],
    "BSD-3-Clause": ["3", "3-clause", "bsd-3-clause", "three-clause"],
    "CC-BY-NC-4.0": ["attribution-noncommercial", "by-nc", "cc-by-nc-4.0", "noncommercial"],
    "CC-BY-SA-4.0": ["attribution-sharealike", "by-sa", "cc-by-sa-4.0", "sharealike"],
    "EPL-2.0": ["eclipse", "epl", "epl-2.0"],
    "GPL-2.0": ["2", "2.0", "gpl-2.0", "gplv2", "v2"],
    "GPL-3.0": ["3", "3.0", "gpl-3.0", "gplv3", "v3"],
    "ISC": ["isc"],
    "LGPL-2.1": ["lesser", "lgpl", "lgpl-2.1"],
    "LGPL-3.0": ["lesser", "lgpl", "lgpl-3.0"],
    "MIT": ["expat", "mit"],
    "MPL-2.0": ["mozilla", "mpl", "mpl-2.0"],
}
EXCLUDED = {
    "AGPL-3.0": ["lesser"],
    "CC-BY-4.0": ["attribution-noncommercial", "attribution-noncommercial-noderivatives", "attribution-noncommercial-sharealike", "attribution-noderivatives",
                  "attribution-sharealike", "by-nc", "by-nc-nd", "by-nc-sa", "by-nd", "by-sa", "noncommercial", "noderivatives", "sharealike"],
    "CC-BY-NC-4.0": ["attribution-noncommercial-noderivatives", "attribution-noncommercial-sharealike", "attribution-noderivatives", "attribution-sharealike",
                     "by-nc-nd", "by-nc-sa", "by-nd", "by-sa", "noderivatives", "sharealike"],
    "CC-BY-SA-4.0": ["attribution-noncommercial", "attribution-noncommercial-noderivatives", "attribution-noncommercial-sharealike", "attribution-noderivatives",
                     "by-nc", "by-nc-nd", "by-nc-sa", "by-nd", "noncommercial", "noderivatives"],
    "GPL-2.0": ["affero", "lesser"],
    "GPL-3.0": ["affero", "lesser"],
    "LGPL-2.1": ["affero"],
    "LGPL-3.0": ["2.1", "affero"],
}
SUPERSEDED = [("BSD-2-Clause", "BSD-3-Clause")]

_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)([.-][^/]*)?$"


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, statement string")


TOKEN = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, joined by single dots and hyphens."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _weights(units: DataFrame, keys: list[str], idf: DataFrame, n_docs: Column) -> DataFrame:
    """L2-normalised TF-IDF rows ``(keys, t, w)`` of units with tokens ``x``; a token
    outside the templates' vocabulary weighs as if no document had it (the squares
    of its weight count in the norm; its own rows are not needed)."""
    tf = units.select(*keys, F.explode("x").alias("t")).groupBy(*keys, "t").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(F.broadcast(idf), "t", "left").select(*keys, "t", (F.col("tf") * F.coalesce("idf", F.log(1 + n_docs) + 1)).alias("w"))
    norm = w.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.struct("t", "w")).alias("v"))
    return norm.select(*keys, F.explode("v").alias("v"), "norm").select(*keys, "v.t", (F.col("v.w") / F.col("norm")).alias("w"))


def _refused(known: list[tuple[str, str]]) -> Column:
    """Of the templates ``(key, statement)``, the keys that tokens ``x`` rule out."""
    out = []
    for key, statement in known:
        k, x = key.split("#")[0], F.col("x")
        if statement.lower().startswith(_TAG):
            out.append((key, ~F.array_contains(x, statement.split()[-1].lower())))
            continue
        if k in EXCLUDED:
            out.append((key, F.arrays_overlap(x, _any_of(set(EXCLUDED[k])))))
        if not set(re.findall(TOKEN, statement.lower())).isdisjoint(REQUIRED.get(k, ())):
            out.append((key, ~F.arrays_overlap(x, _any_of(set(REQUIRED[k])))))
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in out])) if out else F.array().cast("array<string>")


def _best(units: DataFrame, keys: list[str], lic: DataFrame, idf: DataFrame, n_docs: Column, least: float, known: list[tuple[str, str]]) -> DataFrame:
    """The most similar template of each unit that its tokens do not rule out, if its
    cosine is ``least`` or more (ties: the smaller identifier)."""
    units = units.withColumn("no", _refused(known))
    cos = _weights(units, [*keys, "no"], idf, n_docs).join(F.broadcast(lic), "t").where(~F.array_contains("no", F.col("license"))).groupBy(*keys, "license") \
        .agg(F.round(F.sum(F.col("w") * F.col("lw")), 6).alias("cosine")).where(F.col("cosine") >= least)
    return cos.groupBy(*keys).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")) \
        .select(*keys, F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def _model(src: DataFrame, known: DataFrame, n_docs: int, least: float) -> tuple[DataFrame, DataFrame, dict[str, set[str]]]:
    """Document frequencies of the templates' tokens as ``idf``, the templates'
    weights, and each template's tokens without which no cosine of ``least`` is
    possible.  The templates are few: all three are small tables by nature."""
    tt = known.select("license", tokens(F.col("statement")).alias("x"))
    vocab = tt.select(F.explode("x").alias("t")).distinct()
    words = [r["t"] for r in vocab.orderBy("t").collect()]
    both = F.array_intersect(tokens(F.col("text")), F.array(*[F.lit(w) for w in words]).cast("array<string>"))
    df = src.select(F.explode(both).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    idf = saved(vocab.join(df, "t", "left").select("t", (F.log((1 + F.lit(n_docs)) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")), "license-idf")
    lic = _weights(tt, ["license"], idf, F.lit(n_docs)).select("license", "t", F.col("w").alias("lw"))
    lic = saved(lic, "license-weights")
    # tokens needed: without the heaviest ones, the rest of a template has a norm below the threshold
    need: dict[str, set[str]] = {}
    by_lic: dict[str, list] = {}
    for r in lic.collect():
        by_lic.setdefault(r["license"], []).append((r["lw"], r["t"]))
    for k, v in by_lic.items():
        if _TAG in (t for _, t in v):
            need[k] = {_TAG}
            continue
        left = sum(w * w for w, _ in v)
        need[k] = set()
        for w, t in sorted(v, reverse=True):
            if left < least ** 2 * (1 - 1e-9):
                break
            need[k].add(t)
            left -= w * w
    return idf, lic, need


def _any_of(words: set[str]) -> Column:
    return F.array(*[F.lit(t) for t in sorted(words)]).cast("array<string>")


def _passages(src: DataFrame, known: DataFrame, idf: DataFrame, lic: DataFrame, need: dict[str, set[str]], n_docs: int, least: float,
              statements: list[tuple[str, str]]) -> DataFrame:
    """``(id, th, license, cosine)`` of the texts with a passage similar to a template,
    whatever lines it stands on.  Weighed are the passages of a template's length
    that have one of its needed tokens at its own place."""
    x = tokens(F.col("text"))
    wanted = src.sparkSession.createDataFrame([(k, t) for k, ts in need.items() for t in sorted(ts)], "license string, t string")
    t = known.select("license", tokens(F.col("statement")).alias("x"))
    at = t.select("license", F.size("x").alias("n"), F.posexplode("x").alias("o", "t")).join(F.broadcast(wanted), ["license", "t"], "left_semi") \
        .select("n", "o", "t").distinct()
    must = _any_of(set().union(*need.values()) if need else set())
    found = src.where(F.arrays_overlap(x, must)).select("id", "th", x.alias("x")).select("id", "th", "x", F.posexplode("x").alias("p", "t")) \
        .join(F.broadcast(at), "t").select("id", "th", F.greatest(F.col("p") - F.col("o"), F.lit(0)).alias("start"), "n", "x") \
        .select("id", "th", "start", "n", F.expr("slice(x, start + 1, n)").alias("x"))
    units = saved(found.dropDuplicates(["id", "th", "start", "n"]), "license-passages")
    return _best(units, ["id", "th", "start", "n"], lic, idf, F.lit(n_docs), least, statements) \
        .select("id", "th", F.substring_index("license", "#", 1).alias("license"), "cosine")


def _top(found: DataFrame) -> DataFrame:
    """The most similar of each text (ties: the smaller identifier) that no other found licence supersedes."""
    each = found.groupBy("id", "th", "license").agg(F.max("cosine").alias("cosine")).groupBy("id", "th") \
        .agg(F.collect_list(F.struct((-F.col("cosine")).alias("c"), "license")).alias("all"))  # an entry a licence
    names, worse = F.transform("all", lambda x: x["license"]), lambda x: F.lit(False)
    for a, b in SUPERSEDED:
        worse = (lambda before, a, b: lambda x: before(x) | ((x["license"] == a) & F.array_contains(names, b)))(worse, a, b)
    return each.select("id", "th", F.array_min(F.filter("all", lambda x: ~worse(x))).alias("b")) \
        .select("id", "th", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def scan_licenses(files: DataFrame, id_col: str, path_col: str, text_col: str, known: DataFrame | None = None,
                  least: float = 0.6, file_least: float = 0.6) -> DataFrame:
    """Per row ``(id_col, path, license, cosine, basis, directory)``.

    Every line of every whole text is compared to the templates (``known``:
    ``license, statement``; small by nature) as a TF-IDF vector whose document
    frequencies are counted over all texts.  A line must share one of the
    template tokens without which no cosine of ``least`` is possible; only
    those lines are weighed.  In texts without a similar line, passages of a
    template's length are compared, across lines and within them, to the templates
    and to the standard headers and titles of their licences (``HEADERS``) and to
    their SPDX tags, which must name the licence.  ``REQUIRED``, ``EXCLUDED`` and
    ``SUPERSEDED`` tell neighbours apart: a licence ruled out by the tokens of a line
    or passage cannot win it, however similar, and a licence not known is none.
    ``basis`` is ``header`` if a line or passage of the text is similar enough, else ``inherited`` if the nearest ancestor directory
    (its own first) holds a licence file, else null.  A licence file has a
    licence file's name and a similar line or passage, or its whole text is similar enough to a template;
    of several in a directory the most similar counts (ties: smaller licence).

    A null text is empty; a null path has no directory; repeated rows give
    repeated results; an empty table gives no rows."""
    spark = files.sparkSession
    known = templates(spark) if known is None else known.select("license", "statement").na.drop()
    statements = [(r["license"], r["statement"]) for r in known.collect()]
    held = {k for k, _ in statements}
    headers = [(f"{k}#{i}", x) for i, (k, x) in enumerate([*HEADERS, *SPDX]) if k in held]
    src = files.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("th", F.xxhash64("path", "text"))
    n_docs = src.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    n = F.lit(n_docs)
    idf, lic, need = _model(src, known, n_docs, min(least, file_least))
    must = _any_of(set().union(*need.values()) if need else set())
    lines = src.where(F.arrays_overlap(tokens(F.col("text")), must)).select("id", "path", "th", F.posexplode(F.split("text", "\n")).alias("line", "s")) \
        .withColumn("x", tokens(F.col("s"))).where(F.arrays_overlap("x", must)).select("id", "path", "th", "line", "x")
    lines = saved(lines, "license-lines")
    head = _top(_best(lines.select("id", "th", "line", "x").distinct(), ["id", "th", "line"], lic, idf, n, least, statements))
    head = saved(head, "license-headers")
    # texts without such a line: passages over several lines or within one, of the templates and of the standard headers
    rest = src.join(head.select("id", "th").alias("h"), (src["th"] == F.col("h.th")) & src["id"].eqNullSafe(F.col("h.id")), "left_anti")
    extra = spark.createDataFrame(headers, "license string, statement string")
    e_idf, e_lic, e_need = _model(src, extra, n_docs, least)
    parts = _passages(rest, known, idf, lic, need, n_docs, least, statements) \
        .unionByName(_passages(rest, extra, e_idf, e_lic, e_need, n_docs, least, headers))
    parts = saved(_top(parts), "license-parts")
    # licence files: by name, or by the cosine of the whole text (only of texts that have a similar line)
    named = src.where(F.col("path").rlike(_FILE)).select("id", "th", "path", tokens(F.col("text")).alias("x"))
    few = src.join(head.select("id", "th").alias("h"), (src["th"] == F.col("h.th")) & src["id"].eqNullSafe(F.col("h.id")), "left_semi") \
        .select("id", "th", "path", tokens(F.col("text")).alias("x"))
    whole = named.unionByName(few).distinct()
    decl = _best(whole.where("path is not null"), ["id", "th", "path"], lic, idf, n, file_least, statements).select("path", "license", "cosine")
    head = saved(head.unionByName(parts), "license-found")
    # a file of a licence file's name declares what its text holds, too: whole licences begin with their title or grant
    by_name = src.where(F.col("path").rlike(_FILE)).select("id", "th", "path").alias("f") \
        .join(head.alias("h"), (F.col("f.th") == F.col("h.th")) & F.col("f.id").eqNullSafe(F.col("h.id"))).select("f.path", "h.license", "h.cosine")
    decl = decl.unionByName(by_name)
    parent = F.regexp_replace("path", "/?[^/]*$", "")
    dirs = decl.select(parent.alias("dir"), "license", "cosine").groupBy("dir") \
        .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")).select(F.col("dir").alias("up"), F.col("b.license").alias("dir_license"), (-F.col("b.c")).alias("dir_cosine"))
    # nearest ancestor of each distinct directory, then back to the files
    mine = src.where("path is not null").select(parent.alias("dir")).distinct()
    steps = F.split("dir", "/")
    up = mine.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("up")))).alias("a")).select("dir", "a.depth", "a.up").distinct()
    near = up.join(dirs, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "dir_license", "dir_cosine")).alias("b")).select("dir", "b.up", "b.dir_license", "b.dir_cosine")
    near = sized_broadcast(saved(near, "license-near")).alias("d")  # one row a directory: broadcast only if its measured size allows
    out = src.select("id", "path", "th", parent.alias("dir")).alias("l") \
        .join(head.alias("h"), (F.col("l.th") == F.col("h.th")) & F.col("l.id").eqNullSafe(F.col("h.id")), "left") \
        .join(near, F.col("l.dir") == F.col("d.dir"), "left")
    own = F.col("h.license").isNotNull()
    return out.select(F.col("l.id").alias(id_col), F.col("l.path").alias("path"), F.coalesce("h.license", "dir_license").alias("license"),
                      F.coalesce("h.cosine", "dir_cosine").alias("cosine"),
                      F.when(own, "header").when(F.col("dir_license").isNotNull(), "inherited").alias("basis"),
                      F.when(~own, F.col("d.up")).alias("directory"))
