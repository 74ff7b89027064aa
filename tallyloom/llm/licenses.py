"""License scans: a trained paragraph classifier, confirmed by templates. DataFrame and ML functions of the JVM only.

A text falls into blocks at blank lines; line breaks and comment marks inside a block are joined. A cue is a word that
licences use, or a name of one: every run of PIECE + 1 words of a template holds one, but for runs that any text may
hold, and so does every statement like FORMS. Each cue is judged for itself, by the words around it, up to BEFORE before
and AFTER after it, whatever stands in other cues' words: so no statement is cut where another one ends. A paragraph is a
run of cues of a block of which each has at most AFTER words to the one before. Hashed words and word pairs around a cue
go to a multinomial logistic regression, which says how likely each licence family is. The regression is trained here: on
templates, whole, in halves and inside other words, and, as the class `unknown`, on paragraphs of the corpus without a
cue, on such paragraphs with a cue word by chance, and on general sentences about licences. Its probabilities are calibrated by one temperature, fitted
on a fifth of the examples, which the regression isn't trained on (other surroundings of the templates, other
paragraphs).

A family is found around a cue if its calibrated probability reaches LEAST and a template confirms it: the words hold
CONTAINED of the template's word pairs, or, being a piece of a licence's text, the template holds as much of theirs. The
words may name several licences, between which the probability is divided: a further family is found if it is likelier
than `unknown` and the words hold all of one of its templates.

A statement that only names a licence is a few words among many others, so the words next to the cue (NEAR before, BEYOND
after it) are judged for themselves, too; there a template of NAMES and FORMS may confirm the family, too.

Defined results: a null or empty text has no paragraphs; a row always comes back, with no families if none is found;
repeated rows get equal results; an empty table gives no rows; equally likely families go by their order; a paragraph
that stands twice in a text is counted twice; a very long text is read whole. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

FEATURES = 1 << 14
#: Corpus paragraphs in the training set, and those of them whose words go before templates, at most: the first ones in the order of their hashes.
BACKGROUND, LEADS = 2000, 80
#: Words before and after a cue that are judged with it.
BEFORE, AFTER = 8, 40
#: Words next to the cue that are judged for themselves.
NEAR, BEYOND = 7, 8
#: Calibrated probability, and share of word pairs, that a family needs.
LEAST, CONTAINED = 0.2, 0.75
#: Word pairs that a piece of a template must share with it.
PIECE = 6
UNKNOWN = "unknown"

# Fixed texts: how each family is usually named and granted.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0.",
        "Apache-2.0 licensed.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        "This software is available under the terms of the MIT license.",
        "MIT licensed.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "Distributed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Licensed under the BSD license.",
        "Under the BSD-3 license.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "Released under the GPL version 2 or later.",
        "Licensed under the GPL.",
        "Licensed under the GPLv3.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Licensed under the LGPL.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the MPL 2.0.",
    ),
    "AGPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial, and by any means. For more information, please refer to the Unlicense.",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License.",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Shared under the CC BY-NC-SA 4.0 license.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Shared under the CC BY-SA 4.0 license, Creative Commons Attribution-ShareAlike.",
    ),
    "CC0": (
        "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0 Universal.",
        "Released into the public domain under the Creative Commons Zero CC0 dedication.",
    ),
    "Proprietary": (
        "Copyright the author. All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced or distributed without prior written permission.",
        "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited. All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "All rights reserved.",
    ),
}
# Short names of each family.
NAMES = {
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache-2.0", "Apache 2.0"),
    "MIT": ("MIT",),
    "BSD": ("BSD", "BSD-2-Clause", "BSD-3-Clause", "New BSD", "Simplified BSD"),
    "GPL": ("GPL", "GNU GPL", "GPLv2", "GPLv3", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GNU General Public License"),
    "LGPL": ("LGPL", "GNU LGPL", "LGPLv2.1", "LGPLv3", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "GNU Lesser General Public License"),
    "AGPL": ("AGPL", "GNU AGPL", "AGPLv3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "GNU Affero General Public License"),
    "MPL-2.0": ("MPL 2.0", "MPL-2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0"),
    "ISC": ("ISC",),
    "Unlicense": ("Unlicense",),
    "EPL": ("EPL-1.0", "EPL-2.0", "Eclipse Public License", "Eclipse Public License 2.0"),
    "Zlib": ("Zlib", "zlib/libpng"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"),
    "CC-BY": ("CC BY 4.0", "CC-BY-4.0", "CC BY 3.0", "CC-BY-3.0", "CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution 4.0", "Creative Commons Attribution 3.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC0": ("CC0", "CC0 1.0", "CC0-1.0"),
}
#: Statements that name a family; a template for each of its names.
FORMS = ("{}", "Licensed under {}.", "Licensed under the {} license.", "License: {}", "SPDX-License-Identifier: {}", "Released under the {} license.", "Distributed under the terms of the {}.", "This project uses the {} license.", "The code is available under {}.")
# Fixed texts that speak of licences and grant none.
OTHER = (
    "You need a driving license to rent a car in this country.",
    "The license plate was seen near the station.",
    "He lost his pilot license after the accident.",
    "Please read the license agreement of your network provider.",
    "The court decided the copyright case in favour of the author.",
    "A fishing permit or license is required at the lake.",
    "The mit and the apache were mentioned in the talk.",
    "Permission to enter the building was given by the guard.",
    "The hotel said that all rights reserved for guests were cancelled.",
    "All rights reserved to citizens were listed in the treaty.",
    "A liquor license: three hundred a year, said the clerk.",
    "The restaurant was licensed under the new rules of the city.",
    "They were released under the supervision of a doctor.",
    "The software license costs more than the machine.",
    "Copyright law protects the works of living authors.",
    "The proprietary recipe of the bakery is known to two people.",
)
# Fixed stems that speak of licences; those of two words stand for neighbours.
CUES = ("licens", "licenc", "copyright", "permission", "redistribut", "public domain", "creative commons", "cc by", "cc-by", "cc0", "rights reserved", "applicable law", "spdx", "gpl", "proprietary", "unauthorized copying")
# Fixed stems of names, and of pieces of templates in which none of these stands. Then names that are words, too, after a grant.
MORE_CUES = ("software", "gnu", "modif", "commercial", "materials", "granted", "disclaimer", "obtaining", "compliance", "prohibited", "publication", "permitted", "except", "associated", "writing", "distribut", "source", "copies", "purpose", "apache", "mozilla", "eclipse", "bsd", "mpl", "epl", "zlib", "conditions", "binary", "medium", "received", "dedicated", "restrictions", "subject")
SHORT = "(?:under|the|of){0}(?:mit|isc)"
#: What may part neighbours in a text whose lines aren't joined yet.
GAP = r"[\s#*/;]+"
FAMILIES = tuple(TEMPLATES)
#: Between the words that grant and a name, in text of which only words are left.
GRANT = r"(?:licen[sc]ed|released|distributed|available|published|shared|covered|provided|usable) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
#: What may follow a phrase that reserves all rights, if it speaks of something else.
NOT_RESERVED = r"(?i)all rights reserved\s+(?:for|to|at|in|on|were|was|are|is)\b"


def has_cue(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for cue in CUES:
        found = found | low.contains(cue)
    return found


def may_have_cue(text: Column) -> Column:
    """Whether a whole text may hold a cue: one of the stems, however lines are wrapped."""
    stems = [*(c for c in CUES if " " not in c), *(c.split(" ")[1] for c in CUES if " " in c and c != "cc by"), *MORE_CUES]
    pairs = rf"\b(?:cc{GAP}by|{SHORT.format(GAP)}\b)"
    return once(F.lower(text), lambda low: reduce(or_, [low.contains(c) for c in stems]) | low.rlike(pairs))


def is_cue(word: Column, two: Column) -> Column:
    """Whether a word, of which two is it and the next one, is a cue; both in lower case."""
    return reduce(or_, [(two if " " in c else word).contains(c) for c in (*CUES, *MORE_CUES)]) | two.rlike(rf"\b{SHORT.format(' ')}\b")


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def pairs(w: Column) -> Column:
    """Pairs of neighbours; a single word alone."""
    last = F.greatest(F.size(w) - 1, F.lit(0))
    two = F.zip_with(F.slice(w, F.lit(1), last), F.slice(w, F.lit(2), last), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(w) > 1, two).otherwise(w)


def features(rows: DataFrame, column: str = "paragraph") -> DataFrame:
    grams = once(words(F.col(column)), lambda w: F.concat(w, pairs(w)))
    return HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="x", binary=True).transform(rows.withColumn("grams", grams))


def cues(rows: DataFrame) -> DataFrame:
    """row, block, i (the word's place in its block), wide and near (the words around it) of every cue of rows (row, text)."""

    def around(w: Column) -> Column:
        low = F.transform(w, lambda x, i: F.struct(F.lower(x).alias("word"), F.lower(F.concat_ws(" ", x, F.get(w, i + 1))).alias("two")))
        at = F.filter(F.transform(low, lambda x, i: F.when(is_cue(x["word"], x["two"]), i)), lambda i: i.isNotNull())
        cut = lambda i, a, b: F.array_join(F.slice(w, F.greatest(i - a, F.lit(0)) + 1, F.least(i, F.lit(a)) + b + 1), " ")
        return F.transform(at, lambda i: F.struct(i.alias("i"), cut(i, BEFORE, AFTER).alias("wide"), cut(i, NEAR, BEYOND).alias("near")))

    blocks = rows.select("row", F.posexplode(F.split("text", r"\n[ \t\r]*\n")).alias("block", "b"))
    split = F.filter(F.split(F.regexp_replace("b", r"\s*\n[\s#*/;]*", " "), r"\s+"), lambda x: x != "")
    return blocks.select("row", "block", F.explode(once(split, around)).alias("cue")).select("row", "block", "cue.i", "cue.wide", "cue.near")


def examples(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Written: paragraph, family and held (not trained on)."""
    given = [(t, f) for f, ts in TEMPLATES.items() for t in ts]
    halves = [(" ".join(half), f) for t, f in given if len(w := t.split()) >= 12 for half in (w[: len(w) // 2 + 2], w[len(w) // 2 - 2 :])]
    short = [(form.format(n), f) for f, names in NAMES.items() for n in names for form in FORMS]
    alone = spark.createDataFrame(given + halves + [(t, UNKNOWN) for t in OTHER], "paragraph string, family string").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    alone = alone.unionByName(spark.createDataFrame(short, "paragraph string, family string").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))))
    n = docs.agg(F.count("text")).first()[0] or 1
    share = max(1, int((1 << 20) * min(1.0, 2 * BACKGROUND / n)))
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share).select(F.explode(F.split("text", "\n")).alias("paragraph"))
    some = some.where(~has_cue(F.col("paragraph")) & (F.length("paragraph") > 20)).distinct()
    some = C.written(some.orderBy(F.xxhash64("paragraph"), "paragraph").limit(BACKGROUND))
    background = some.select("paragraph", F.lit(UNKNOWN).alias("family"), F.lit(0).alias("copy"))
    cue = F.array(*[F.lit(c) for c in CUES])[F.pmod(F.xxhash64("paragraph"), F.lit(len(CUES))).cast("int")]
    by_chance = some.select(F.concat_ws(" ", "paragraph", cue).alias("paragraph"), F.lit(UNKNOWN).alias("family"), F.lit(0).alias("copy"))
    # templates before, after and between words of corpus text, as they stand in documents
    lead = some.select(F.regexp_extract("paragraph", rf"^((?:\S+\s+){{1,{BEFORE}}})((?:\S+\s+){{1,{AFTER}}})", 1).alias("lead"), F.regexp_extract("paragraph", rf"^((?:\S+\s+){{1,{BEFORE}}})((?:\S+\s+){{1,{AFTER}}})", 2).alias("trail"))
    lead = lead.where("trail != ''").orderBy(F.xxhash64("lead", "trail"), "lead").limit(LEADS)
    each = lambda rows, some: rows.crossJoin(F.broadcast(spark.createDataFrame(some, "t string, family string")))
    few = lead.where(F.pmod(F.xxhash64("lead", "trail"), F.lit(10)) == 0)
    inside = each(lead, given + halves).unionByName(each(few, short))
    inside = inside.withColumn("side", F.pmod(F.xxhash64("lead", "trail", "t"), F.lit(3)))
    around = F.concat(F.when(F.col("side") != 0, F.col("lead")).otherwise(""), "t", F.when(F.col("side") != 1, F.concat(F.lit(" "), F.rtrim("trail"))).otherwise(""))
    inside = inside.select(around.alias("paragraph"), "family", F.lit(0).alias("copy"))
    rows = alone.unionByName(inside).unionByName(background).unionByName(by_chance)
    return C.written(rows.select("paragraph", "family", (F.pmod(F.xxhash64("paragraph", "copy"), F.lit(5)) == 0).alias("held")))


class Model:
    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.labels = [UNKNOWN, *FAMILIES]
        code = F.create_map(*[F.lit(x) for i, f in enumerate(self.labels) for x in (f, float(i))])
        rows = features(examples(spark, docs)).withColumn("label", code[F.col("family")]).select("x", "label", "held").coalesce(2)  # few rows: each task sends the whole gradient in each step
        self.lr: LogisticRegressionModel = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=0.001, maxIter=40).fit(rows.where("NOT held"))
        held = self.lr.transform(rows.where("held")).select("label", vector_to_array("rawPrediction").alias("raw"))
        losses = held.agg(*[F.avg(-F.log(self.softmax(F.col("raw"), t)[F.col("label").cast("int")] + 1e-12)).alias(f"t{i}") for i, t in enumerate(self.temperatures)]).first()
        self.temperature = min(zip((x if x is not None else 0.0 for x in losses), self.temperatures, strict=True))[1]

    temperatures = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)

    @staticmethod
    def softmax(raw: Column, temperature: float) -> Column:
        powers = lambda raw: F.transform(raw, lambda x: F.exp((x - F.array_max(raw)) / temperature))
        shares = lambda e: once(F.aggregate(e, F.lit(0.0), lambda a, b: a + b), lambda all_: F.transform(e, lambda x: x / all_))
        return once(once(raw, powers), shares)

    def probabilities(self, rows: DataFrame, column: str, into: str) -> DataFrame:
        """rows with the calibrated probabilities of a column's words."""
        made = self.lr.transform(features(rows, column))
        return made.select(*rows.columns, self.softmax(vector_to_array("rawPrediction"), self.temperature).alias(into))

    def judged(self, rows: DataFrame) -> DataFrame:
        """rows (wide, near) with found, the families as (family, probability)."""
        made = self.probabilities(self.probabilities(rows, "near", "q"), "wide", "p")
        plain = once(F.concat(F.lit(" "), F.array_join(words(F.col("near")), " "), F.lit(" ")), lambda x: F.array_compact(F.array(*[F.when(named(x, f), F.lit(f)) for f in NAMES])))
        made = made.withColumns({"names": plain, "by_near": confirmed(F.col("near")), "by_wide": confirmed(F.col("wide")), "reserved": F.col("wide").rlike(NOT_RESERVED)})
        p, q, by_near, by_wide = (F.col(c) for c in ("p", "q", "by_near", "by_wide"))

        def of(f: Column, i: Column) -> Column:
            known = ((p[i + 1] >= LEAST) & F.array_contains(by_wide["some"], f)) | ((p[i + 1] > p[0]) & F.array_contains(by_wide["whole"], f))
            known = known | ((q[i + 1] >= LEAST) & (F.array_contains("names", f) | F.array_contains(by_near["some"], f)))
            return F.when(known & ~((f == "Proprietary") & F.col("reserved")), F.struct(f.alias("family"), p[i + 1].alias("probability")))

        found = F.array_compact(F.transform(F.array(*[F.lit(f) for f in self.labels[1:]]), of))
        return made.select(*rows.columns, found.alias("found"))


def named(plain: Column, family: str) -> Column:
    """Whether a paragraph, of which words with single spaces are left, grants a licence of the family by one of its names, in a form like FORMS."""
    if family not in NAMES:
        return F.lit(False)
    found = {" ".join(re.findall("[a-z0-9]+", n.lower())) for n in NAMES[family]}
    name = "(?:" + "|".join(sorted(found, key=lambda n: (-len(n), n))) + ")"
    # a longer name of another family may go on: attribution, then noncommercial
    name += r"(?! (?:nc|noncommercial)\b)" if family == "CC-BY" else ""
    titles = "|".join(n for n in found if n.count(" ") > 2)  # of four words and more
    alone = f"| (?:{titles}) " if titles else ""
    return plain.rlike(f" {GRANT}{name} | (?:licen[sc]e|licen[sc]ed|spdx license identifier) {name} | {name} licen[sc]ed? {alone}")


def confirmed(text: Column) -> Column:
    """some: the families of templates whose word pairs a text holds CONTAINED of, or that hold as much of its; whole: of those that it holds all of."""
    given = [(f, "|".join(" ".join(two) for two in zip(w, w[1:], strict=False)) or w[0]) for f, ts in TEMPLATES.items() for t in ts if (w := re.findall("[a-z0-9]+", t.lower()))]
    # folded into the plan as one value
    table = F.array(*[F.struct(F.lit(f).alias("family"), F.array_distinct(F.split(F.lit(two), "\\|")).alias("pairs")) for f, two in given])

    def of(own: Column) -> Column:
        shared = F.transform(table, lambda t: F.struct(t["family"].alias("family"), F.size(t["pairs"]).alias("n"), F.size(F.array_intersect(own, t["pairs"])).alias("k")))
        most = lambda t: (t["k"] >= CONTAINED * t["n"]) | ((t["k"] >= PIECE) & (t["k"] >= CONTAINED * F.size(own)))
        families = lambda held, ok: F.array_distinct(F.transform(F.filter(held, ok), lambda t: t["family"]))
        return once(shared, lambda held: F.struct(families(held, most).alias("some"), families(held, lambda t: t["k"] >= t["n"]).alias("whole")))

    return once(once(words(text), lambda w: F.array_distinct(pairs(w))), of)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, families (sorted, distinct), n_paragraphs with a cue, n_licensed of them, and the least probability among these; of every row."""
    model = Model(docs.sparkSession, docs)
    rows = C.written(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.when(may_have_cue(F.col("text")), F.col("text")).alias("text")))
    found = model.judged(cues(rows.where("text IS NOT NULL").select("row", "text"))).select("row", "block", "i", "found")
    upto = Window.partitionBy("row").orderBy("block", "i")
    last = F.lag(F.struct("block", "i")).over(upto)
    begins = last.isNull() | (last["block"] != F.col("block")) | (F.col("i") > last["i"] + AFTER)
    found = found.withColumn("paragraph", begins.cast("long")).withColumn("paragraph", F.sum("paragraph").over(upto))
    per_row = found.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("found", lambda x: x["family"]))))).alias("families"),
        F.max("paragraph").alias("n_paragraphs"),
        F.size(F.collect_set(F.when(F.size("found") > 0, F.col("paragraph")))).alias("n_licensed"),
        F.min(F.array_min(F.transform("found", lambda x: x["probability"]))).alias("probability"),
    )
    out = rows.select("row", "doc_id").join(per_row, "row", "left")
    return out.select(
        "doc_id",
        F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce("n_licensed", F.lit(0)).cast("long").alias("n_licensed"),
        "probability",
    )


def op5_license_scan(spark, sf_dir) -> DataFrame:
    return scan(C.table(spark, sf_dir, "documents"))
