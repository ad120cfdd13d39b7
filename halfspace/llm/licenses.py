"""Licences by sparse TF-IDF cosine to templates, inherited along directories.

A file's header passages (its lines, and its sentences and pairs of them with wrapped lines
joined) and the whole texts of licence files are compared with the templates below, each as a
sparse TF-IDF vector. Passages without a cue, a token that all
passages close enough to a template have one of, are not compared. Whole licence files are also
compared with the licences' full texts, and SPDX identifiers are looked up. A file without a licence of its own inherits that of
the nearest ancestor directory that has a licence file; ancestors are found by joins on
paths. Only DataFrame operations are used.
"""

from __future__ import annotations

import math
from collections import Counter
from importlib import resources

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.llm.common import documents, hot_join, shared_table

# Short notices by which works name their licence (SPDX identifiers).
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the software without restriction.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v2.",
        "Licensed under the GNU General Public License v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "MPL": [
        "This source code form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "The contents of this file are subject to the Mozilla Public License Version 1.1; you may "
        "not use this file except in compliance with the License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License.",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has dedicated this work to the public domain.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced."],
}

# Licences whose version a notice has to give; without one, the family is all
# that it names. A notice that reserves all rights counts if no other licence is named.
VERSIONS = {
    "GPL-1": "GPL-1.0",
    "GPL-2": "GPL-2.0",
    "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0",
    "LGPL-2.1": "LGPL-2.1",
    "LGPL-3": "LGPL-3.0",
    "AGPL-3": "AGPL-3.0",
    "MPL-1.1": "MPL-1.1",
    "MPL-2": "MPL-2.0",
}
GENERAL = ("GPL", "LGPL", "AGPL", "MPL", "proprietary")
NUMBER = r"v(?:ersion|\.)?[\s#*/]*([0-9]+(?:\.[0-9]+)?)"
VERSION_AFTER = rf"(?is)licen[cs]e.{{0,120}}?\b{NUMBER}"
VERSION_BEFORE = rf"(?is)\b{NUMBER}[\s#*/]+of\b"

# Identifiers that stand for a licence beside its own name.
SPDX_ENDINGS = ("", "+", "-only", "-or-later")
SPDX_NAMES = [*(n for n in TEMPLATES if n not in GENERAL), *VERSIONS.values(), "BSD-2-Clause"]
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([^\n\r]*)"

# Names of files whose whole text is a licence.
LICENSE_FILE = r"(?i)^(un)?(licen[cs]e|copying|notice|copyright)([.-].*)?$"

# A file is a licence file, too, if its licence passages make up this share of its text.
MOSTLY = 0.8

# Cosine from which a template names the licence.
LEAST_COSINE = 0.6

# How a passage was cut out of its text.
LINES, SENTENCES, PAIRS, WHOLE = range(4)

# What section 13 of the Affero licence adds to the GPL's.
AFFERO = (
    "13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any "
    "other provision of this License, if you modify the Program, your modified version must "
    "prominently offer all users interacting with it remotely through a computer network (if your "
    "version supports such interaction) an opportunity to receive the Corresponding Source of your "
    "version by providing access to the Corresponding Source from a network server at no charge, "
    "through some standard or customary means of facilitating copying of software."
)

TOKEN = r"[^a-z0-9]+"
PASSAGE = r"\n|(?<=[.!?;])[ \t\r\x0b\x0c]+"
# A line without letters and digits, such as a bare comment sign, ends a paragraph.
PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*\n)+"
SENTENCE = r"(?<=[.!?;])[ \t\r\x0b\x0c\n]+"


def _tokens(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def full_texts() -> dict[str, list[str]]:
    """The whole texts of licences, as files named LICENSE or COPYING hold them."""
    folder = resources.files("halfspace.llm").joinpath("license_texts")
    texts = {
        file.name.removesuffix(".txt"): [file.read_text(encoding="utf-8")]
        for file in sorted(folder.iterdir(), key=lambda f: f.name)
        if file.name.endswith(".txt")
    }
    # The Affero licence is the GPL's text but for its name and section 13.
    gpl = texts["GPL-3.0"][0].replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC")
    gpl = gpl.replace("GNU General Public", "GNU Affero General Public")
    texts["AGPL-3.0"] = [f"{gpl}\n{AFFERO}"]
    return texts


def template_vectors(
    templates: dict[str, list[str]] | None = None, damped: bool = False
) -> tuple[list[tuple[str, int, str, float, float]], float]:
    """Rows (license, template, token, unit weight, idf), and the idf of unknown tokens.

    ``damped`` counts a token 1 + ln(tf) times, so that in long texts its words tell, not
    how often the commonest of them is used.
    """
    templates = TEMPLATES if templates is None else templates
    texts = [(name, i, _tokens(t)) for name, ts in templates.items() for i, t in enumerate(ts)]
    n = len(texts)
    seen = Counter(token for *_, tokens in texts for token in set(tokens))
    idf = {token: math.log((1 + n) / (1 + df)) + 1 for token, df in seen.items()}
    rows = []
    for name, i, tokens in texts:
        counts = Counter(tokens).items()
        weights = {t: (1 + math.log(c) if damped else c) * idf[t] for t, c in counts}
        length = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(name, i, t, w / length, idf[t]) for t, w in sorted(weights.items())]
    return rows, math.log(1 + n) + 1


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


# Bits of the table that tells known tokens from nearly all others by their hash.
SLOTS = 4096
# If two sentences together are close to a template, one of them has at least this cosine:
# a pair's vector is no shorter than the sum of its halves' lengths by the root of two.
HALF_COSINE = LEAST_COSINE / math.sqrt(2)


def reaching():
    """A condition on texts that all with a cosine of ``least`` or more to a template meet.

    It is the cosine itself, but for tokens that a text repeats: its length is taken as if
    each occurrence were another token, which makes it shorter at most. The sums are over
    the tokens that templates have, which are told by a table of their hashes first.
    """
    rows, unknown = template_vectors()
    numbers = {key: i for i, key in enumerate(dict.fromkeys((name, i) for name, i, *_ in rows))}
    idf = {token: value for _, _, token, _, value in rows}
    products = {token: [0.0] * len(numbers) for token in idf}
    for name, i, token, weight, value in rows:
        products[token][numbers[name, i]] = weight * value
    largest = max(row[3] for row in rows)
    bits = [0] * (SLOTS // 64)
    for token in idf:
        slot = xxhash.xxh64(token, seed=42).intdigest() % SLOTS
        bits[slot // 64] |= 1 << slot % 64
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    table = F.expr(f"array({', '.join(f'{b}L' if b != -(1 << 63) else 'bigint(-9223372036854775808)' for b in signed)})")
    idfs = F.expr(f"map({', '.join(f"'{t}', {v!r}D" for t, v in idf.items())})")
    vectors = F.expr(
        f"map({', '.join(f"'{t}', array({', '.join(f'{x!r}D' for x in v)})" for t, v in products.items())})"
    )
    nothing = F.expr(f"array_repeat(0.0D, {len(numbers)})")

    def known(token: Column) -> Column:
        slot = F.pmod(F.xxhash64(token), F.lit(SLOTS)).cast("int")
        word = F.get(table, F.shiftright(slot, 6))
        return F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", word, slot.bitwiseAND(63))) == 1

    def add(sums: Column, token: Column) -> Column:
        value = F.coalesce(F.try_element_at(idfs, token), F.lit(0.0))
        return F.struct(
            (sums["s"] + value).alias("s"),
            (sums["squares"] + value * value).alias("squares"),
            (sums["n"] + (value > 0).cast("int")).alias("n"),
        )

    def dots(tokens: Column) -> Column:
        return F.aggregate(
            tokens,
            nothing,
            lambda sums, token: F.zip_with(
                sums, F.coalesce(F.try_element_at(vectors, token), nothing), lambda x, y: x + y
            ),
        )

    def reaches(text: Column, least: float) -> Column:
        start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("squares"), F.lit(0).alias("n"))
        least *= 1 - 1e-6

        def judged(count: Column, tokens: Column) -> Column:
            def by_sums(sums: Column) -> Column:
                others = (count - sums["n"]).cast("double")
                length = F.sqrt(sums["squares"] + others * F.lit(unknown * unknown))
                # The first condition is cheap, and nearly always decides.
                return (
                    (sums["n"] > 0)
                    & (sums["s"] * F.lit(largest) >= length * F.lit(least))
                    & (F.array_max(dots(tokens)) >= length * F.lit(least))
                )

            return _let(F.aggregate(tokens, start, add), by_sums)

        def by_tokens(tokens: Column) -> Column:
            return _let(F.filter(tokens, known), lambda found: judged(F.size(tokens), found))

        return _let(F.filter(F.split(F.lower(text), TOKEN), lambda t: t != ""), by_tokens)

    return reaches


def passages(files: DataFrame) -> DataFrame:
    """path, named (a licence file by name), cut, share of the text, and passage.

    The text is cut twice: at line ends, and into the sentences of paragraphs whose lines
    are joined, so that a notice is found whether or not it is wrapped. A further cut
    (``share`` NULL) has each two sentences that follow one another, for a full stop
    inside a notice, and a licence file's whole text. Passages that can't be close to a
    template are left out as they are cut.
    """
    name = F.element_at(F.split("path", "/"), -1)
    reaches = reaching()
    piece = lambda cut, text: F.struct(F.lit(cut).alias("cut"), text.alias("passage"))

    def of_lines(text: Column) -> Column:
        close = F.filter(F.split(text, PASSAGE), lambda x: reaches(x, LEAST_COSINE))
        return F.transform(close, lambda x: piece(LINES, x))

    def of_paragraph(paragraph: Column) -> Column:
        """A paragraph's sentences, and its pairs of neighbours, that are close."""
        marked = F.transform(
            F.split(paragraph, SENTENCE),
            lambda x: F.struct(x.alias("text"), reaches(x, HALF_COSINE).alias("near")),
        )

        def close(sentences: Column) -> Column:
            one = F.filter(sentences, lambda x: x["near"] & reaches(x["text"], LEAST_COSINE))
            # Pairs begin at each sentence but the last that is near, or is before a near one.
            at = F.filter(
                F.sequence(F.lit(0), F.size(sentences) - 1),
                lambda i: (i + 1 < F.size(sentences)) & (F.get(sentences, i)["near"] | F.get(sentences, i + 1)["near"]),
            )
            two = F.transform(
                at, lambda i: F.concat(F.get(sentences, i)["text"], F.lit(" "), F.get(sentences, i + 1)["text"])
            )
            two = F.filter(two, lambda x: reaches(x, LEAST_COSINE))
            return F.concat(
                F.transform(one, lambda x: piece(SENTENCES, x["text"])), F.transform(two, lambda x: piece(PAIRS, x))
            )

        none = F.array().cast("array<struct<cut:int,passage:string>>")
        return _let(marked, lambda x: F.when(F.exists(x, lambda y: y["near"]), close(x)).otherwise(none))

    whole = F.when(
        F.col("named"),
        F.array(F.struct(F.lit(WHOLE).alias("cut"), F.col("text").alias("passage"))),
    ).otherwise(F.array().cast("array<struct<cut:int,passage:string>>"))
    paragraphs = F.flatten(F.transform(F.split("text", PARAGRAPH), of_paragraph))
    marked = files.select("path", "text", name.rlike(LICENSE_FILE).alias("named"))
    found = marked.select(
        "path",
        "named",
        F.length("text").alias("n"),
        F.explode(F.concat(of_lines(F.col("text")), paragraphs, whole)).alias("piece"),
    )
    share = F.when(
        F.col("piece.cut").isin(LINES, SENTENCES),
        F.length("piece.passage") / F.greatest("n", F.lit(1)),
    )
    return found.select("path", "named", "piece.cut", share.alias("share"), "piece.passage")


def identified(files: DataFrame) -> DataFrame:
    """path, named, license and similarity 1 of each SPDX identifier that a file gives."""
    licenses = {
        f"{name}{ending}".lower(): name
        for name in SPDX_NAMES
        for ending in SPDX_ENDINGS
    }
    known = F.create_map(*[F.lit(x) for pair in licenses.items() for x in pair])
    ids = F.flatten(
        F.transform(
            F.regexp_extract_all("text", F.lit(SPDX), F.lit(1)),
            lambda x: F.split(F.lower(x), r"[^a-z0-9.+-]+"),
        )
    )
    name = F.element_at(F.split("path", "/"), -1)
    found = files.where(F.contains(F.lower("text"), F.lit("spdx-license-identifier:"))).select(
        "path", name.rlike(LICENSE_FILE).alias("named"), F.explode(ids).alias("id")
    )
    license = F.try_element_at(known, F.rtrim(F.col("id"), F.lit(".")))
    found = found.select("path", "named", license.alias("license"), F.lit(1.0).alias("similarity"))
    return found.where("license IS NOT NULL")


def closest_templates(
    spark: SparkSession,
    found: DataFrame,
    templates: dict[str, list[str]] | None = None,
    damped: bool = False,
) -> DataFrame:
    """passage, its number n, license and similarity, if it is close enough to a template.

    The templates' vectors are a fixed table of some hundred or thousand rows, and broadcast. Equal
    passages are compared once: a notice that a third of all files carry is one row.
    """
    rows, unknown = template_vectors(templates, damped)
    tf = F.col("tf")
    times = 1 + F.log(tf) if damped else tf
    vectors = spark.createDataFrame(
        rows, "license string, template int, token string, weight double, idf double"
    )
    idf = F.broadcast(vectors.select("token", "idf").distinct())
    # A passage is known by its digest, as its text would travel with each of its tokens.
    different = found.groupBy("passage").agg(F.count("*").alias("n"))
    different = different.withColumn("sha", F.unhex(F.sha2("passage", 256)))
    tokens = F.filter(F.split(F.lower("passage"), TOKEN), lambda t: t != "")
    terms = (
        different.select("sha", F.explode(tokens).alias("token"))
        .groupBy("sha", "token")
        .agg(F.count("*").alias("tf"))
        .join(idf, "token", "left")
        .withColumn("w", times * F.coalesce("idf", F.lit(unknown)))
    )
    lengths = terms.groupBy("sha").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = (
        terms.join(F.broadcast(vectors.drop("idf")), "token")
        .groupBy("sha", "license", "template")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    # Rounded, so that a tie does not depend on the order in which sums were taken.
    cosine = F.round(F.col("dot") / F.col("length"), 9)
    best = (
        dots.join(lengths, "sha")
        .select("sha", "license", cosine.alias("similarity"))
        .where(F.col("similarity") >= LEAST_COSINE)
        .groupBy("sha")
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("best"))
    )
    return best.join(different, "sha").select(
        "passage", "n", "best.license", (-F.col("best.s")).alias("similarity")
    )


def with_versions(matches: DataFrame) -> DataFrame:
    """Matches whose licence is a family's get the version that the passage names, if any."""
    text, license = F.col("passage"), F.col("license")
    gnu = F.when(text.rlike(r"(?i)\baffero\b"), "AGPL")
    gnu = gnu.when(text.rlike(r"(?i)\b(?:lesser|library)[^a-z]+general\b"), "LGPL").otherwise("GPL")
    family = F.when(license.isin("GPL", "LGPL", "AGPL"), gnu).otherwise(license)
    after, before = (F.regexp_extract("passage", p, 1) for p in (VERSION_AFTER, VERSION_BEFORE))
    number = F.regexp_replace(F.when(after != "", after).otherwise(before), r"\.0$", "")
    known = F.create_map(*[F.lit(x) for pair in VERSIONS.items() for x in pair])
    named = F.coalesce(F.try_element_at(known, F.concat_ws("-", family, number)), family)
    return matches.withColumn("license", named)


def directory_of(path: Column) -> Column:
    """The path without its last part; the root is the empty text."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def nearest_licensed(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """directory, license and from_directory of directories with a licensed ancestor or self.

    ``directories`` has each directory once as ``directory``, ``licensed`` each directory
    of a licence file once, with its ``license``. A directory is joined under the path of
    each of its ancestors.
    """
    parts = F.split("directory", "/")
    ancestors = F.transform(
        F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(F.size(parts))),
        lambda n: F.concat_ws("/", F.slice(parts, F.lit(1), n)),
    )
    up = directories.select("directory", F.explode(ancestors).alias("ancestor"))
    above = licensed.select(F.col("directory").alias("ancestor"), "license")
    nearest = (
        up.join(above, "ancestor")
        .groupBy("directory")
        .agg(F.max(F.struct(F.length("ancestor").alias("n"), "ancestor", "license")).alias("at"))
    )
    return nearest.select(
        "directory", "at.license", F.col("at.ancestor").alias("from_directory")
    )


def scan_licenses(files: DataFrame) -> DataFrame:
    """For each file: path, license, similarity, origin and from_directory.

    ``origin`` is ``own`` (by a passage of the file), ``inherited`` or ``none``. A notice of
    the GNU or Mozilla licences without a version names the family (``GPL``). Of several own
    licences, families and reserved rights come last; before that, an identifier's or that
    of a licence file's whole text counts first, then the most similar, then the first by name.

    A NULL or empty text has no licence of its own. A NULL path is in no directory and
    inherits nothing. Rows that repeat a path are one file with several texts: each row
    gets the file's best licence. Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = files.sparkSession
    files = files.select("path", F.coalesce("text", F.lit("")).alias("text"))
    found = shared_table(passages(files.where("path IS NOT NULL")), "passages")
    closest = shared_table(with_versions(closest_templates(spark, found)), "matches")
    entire = shared_table(found.where(F.col("cut") == WHOLE), "license-files")
    texts = shared_table(closest_templates(spark, entire, full_texts(), damped=True), "matches")
    columns = ["path", "named", "cut", "share", "license", "similarity"]
    matched = (
        hot_join(found, closest, ["passage"], "n")
        .select(*columns)
        .unionByName(hot_join(entire, texts, ["passage"], "n").select(*columns))
        .unionByName(identified(files.where("path IS NOT NULL")), allowMissingColumns=True)
    )
    # A licence with its version goes before a family, and what a whole licence file or an
    # identifier says before its single sentences.
    general = F.col("license").isin(*GENERAL)
    part = F.coalesce(F.col("cut") != WHOLE, F.lit(False))
    rank = F.struct(
        general.alias("general"), part.alias("part"), (-F.col("similarity")).alias("s"), "license"
    )
    whole = F.max("named")
    for cut in (LINES, SENTENCES):
        held = F.sum(F.when(F.col("cut") == cut, F.col("share")))
        whole = whole | F.coalesce(held >= MOSTLY, F.lit(False))
    own = shared_table(
        matched.groupBy("path").agg(F.min(rank).alias("best"), whole.alias("whole")),
        "own-licenses",
    )
    own_license = own.select(
        "path",
        F.col("best.license").alias("own_license"),
        (-F.col("best.s")).alias("similarity"),
    )
    in_directory = own.where("whole").withColumn("directory", directory_of(F.col("path")))
    licensed = in_directory.groupBy("directory").agg(
        F.min("best").getField("license").alias("license")
    )
    paths = shared_table(
        files.select("path", directory_of(F.col("path")).alias("directory")), "paths"
    )
    sizes = paths.where("path IS NOT NULL").groupBy("directory").agg(F.count("*").alias("n"))
    nearest = nearest_licensed(sizes.select("directory"), licensed)
    by_directory = shared_table(sizes.join(nearest, "directory", "left"), "directories")
    inherited = hot_join(
        paths.where("path IS NOT NULL"), by_directory, ["directory"], "n"
    ).select("path", "license", "from_directory")
    nowhere = paths.where("path IS NULL").select(
        "path",
        F.lit(None).cast("string").alias("license"),
        F.lit(None).cast("string").alias("from_directory"),
    )
    everything = inherited.unionByName(nowhere).join(own_license, "path", "left")
    mine = F.col("own_license").isNotNull()
    return everything.select(
        "path",
        F.coalesce("own_license", "license").alias("license"),
        "similarity",
        F.when(mine, "own").when(F.col("license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("from_directory")).alias("from_directory"),
    )


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """The documents as files ``source/lang/doc_id``; a NULL part is empty.

    A document that is hardly more than a licence is the licence file of its directory.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")]
    files = documents(spark, sf_dir).select(F.concat_ws("/", *parts).alias("path"), "text")
    doc_id = F.element_at(F.split("path", "/"), -1).try_cast("bigint")
    return scan_licenses(files).select(
        doc_id.alias("doc_id"), "path", "license", "similarity", "origin", "from_directory"
    )
