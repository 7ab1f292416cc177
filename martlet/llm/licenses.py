"""Licence scan: a trained paragraph classifier with an unknown class, confirmed by comparison with templates.

A paragraph is a line of a text, or neighbouring lines joined, so that a notice may be wrapped anywhere. Its features are
the word 1- to 3-grams it holds (a word is ``[a-z0-9]+`` of the lower-cased paragraph), present or not. One logistic regression for each licence family, with an L1 penalty that keeps
it sparse, is fitted in numpy on templates, notices of licences that have none, and ordinary paragraphs; one more tells notices of any
licence from ordinary paragraphs. The threshold is calibrated on paragraphs that a fit has not seen. A paragraph is of the best family
that reaches it, or, if none does, of an unknown licence if the last one does, or of none. A family is confirmed if one of its templates and the paragraph share
``CONFIRM`` of the template's distinct n-grams and the telling n-grams agree (``tellings``): those that the family needs are
there, and none of another version or variant without one of its own. A paragraph that the classifier takes for a licence, but no
template confirms, is reported as ``unknown``. N-grams that go on from its last line into the next tell version and variant as well, and so do
GNU's phrases on the version in lines that may be joined with it, since a version often follows on a later line.

Joined lines have no line without a word between them and fewer than ``REACH`` words, twice the longest template, between the
first and the last line; of these two, the last and the first ``REACH`` words count. Of nested paragraphs with the same outcome the
innermost is reported, so a line that is a notice by itself stays one; overlapping ones are one notice, reported at its first
line. What is unknown and shares a line with a confirmed notice is a piece of it and not reported.

Scoring uses DataFrame functions alone: the model and the templates are tables of a size that this file sets. Texts without a
cue, a word without which no family can reach the threshold, are left out by one regular expression before n-grams
are made; ``cue_words`` chooses them so that this changes no result. Of the others, only n-grams that the model or a template
holds go on, with their places, and joined lines are scored if the positive weights in them can reach the threshold.

Defined cases: null and empty texts have no licence paragraph. Repeated rows give their paragraphs each; ties between families
go to the first by name. Rows without an id are reported with a NULL id. Empty tables give empty results. Other columns are
ignored. Texts are read whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import scratch_path

SIZES = (1, 2, 3)
#: The class of licences without a template, which are reported as unknown.
UNTOLD = "untold"
CONFIRM = 0.7
ROUNDS, RATE, PENALTY, FOLDS = 800, 1.0, 0.0008, 4

#: Notices of licence families.
TEMPLATES = {
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright (c) by the authors. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright, dedicated to the public domain."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is MIT licensed.",
        "Distributed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}

#: Notices of licences that have no template here, and other wordings of those that have one.
OTHER = """
This software is provided under the zlib license.
Distributed under the Boost Software License, Version 1.0.
Licensed under the Artistic License 2.0.
This Font Software is licensed under the SIL Open Font License, Version 1.1.
The contents of this file are subject to the terms of the Common Development and Distribution License.
Licensed under the EUPL, Version 1.2 or later.
Licensed under the Microsoft Public License (Ms-PL).
This project is released under the PostgreSQL license.
Use of this software is governed by the University of Illinois Open Source License.
Distributed under the terms of the Python Software Foundation License.
This file is licensed under the Do What The Fuck You Want To Public License.
Proprietary software of the vendor.
Company confidential. Do not copy.
This file is proprietary and confidential.
zlib License
License: BSL-1.0
This work has been released into the public domain by its author.
This code is proprietary and may not be copied, distributed or modified without permission.
This software is the confidential and proprietary information of the company.
Use is subject to license terms.
See the LICENSE file for license information.
See the file COPYING for copying conditions.
For the full copyright and license information, please view the LICENSE file that was distributed with this source code.
You may obtain a copy of the License at the address below.
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis.
The software is provided as is, without warranty of any kind, express or implied.
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the software.
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Permission to use, copy and distribute this document for any purpose and without fee is hereby granted.
You should have received a copy of the license along with this program.
This is free and unencumbered material placed in the public domain by its authors.
This document is dual licensed under two licenses; choose the one you prefer.
This library is licensed under the terms of the license in the file LICENSE.txt.
Code licensed under a permissive open source license.
The text of this page is available under an open licence; additional terms may apply.
Content on this site is licensed under a Creative Commons license unless noted otherwise.
Licensed under a Creative Commons Attribution-NoDerivatives license.
Published under the Open Government Licence.
Data is made available under the Open Database License.
Made available under the Community Data License Agreement.
SPDX-License-Identifier: Zlib
SPDX-License-Identifier: BSL-1.0
SPDX-License-Identifier: Artistic-2.0
SPDX-License-Identifier: EUPL-1.2
SPDX-License-Identifier: LicenseRef-Proprietary
License: Artistic-2.0
License: see LICENSE
This package is zlib licensed.
This project is licensed under the terms of its own license.
Copyright 2019 the authors, licensed under the terms below.
""".strip().splitlines()

#: Paragraphs of no licence, some with words of one.
ORDINARY = """
The rights of the tenants were reserved by the court until the next hearing in May.
She passed her driving test and was licensed to drive buses under the new rules.
The film was released under a different title in the north of the country.
All seats are reserved for guests of the hotel and their families.
The version of the story that was released in 2004 is the best known.
He asked the general for permission to leave the camp with his work unfinished.
The public library has a copy of the source of this old map, free of charge.
A helicopter of the Apache class was seen over the valley at 4 in the morning.
The students of the institute published their work in version 2 of the report.
With or without sugar, the use of fresh fruit is permitted in this recipe.
You may not use this lift in case of fire; use the stairs at the end of the hall.
This program is about the history of free trade and the terms of the treaty.
The commons were open to all, and no part of the land was sold by the town.
Any person obtaining a place in the final will be told by the end of the week.
The fishing license of the boat was renewed under the law of the state.
It is the third book of the author and it is by far the most creative.
The international committee met in Vienna on the 4th of June to review the terms.
In the end all of them left, and the house stood empty for years.
The price of wheat rose by 3 per cent in the first half of the year.
To the extent possible, answers are short and to the point.
Software for this machine is sold without warranty of any kind by several firms.
The subject of the talk is the form of the code that bees dance to each other.
Wool is a good material for winter as it keeps its warmth when it is wet.
My license plate was stolen, so I had to ask the office for a new one.
The copyright lawyer explained the law to the class in under ten minutes.
The restaurant was licensed to serve wine until midnight.
He lost his pilot's license after the second accident.
A new license for the mine was granted to the company in spring.
Doctors must renew their licence every five years.
The software was distributed to schools across the region on disks.
The contents of the box were subject to damage in the rain.
Files are copied to the server at night and checked in the morning.
The museum is open source of pride for the people of the town.
Permission to enter the park was denied to the visitors.
The terms of the agreement were announced by both companies.
The conditions in the camp were hard, and the winter was long.
The notice on the door said that the shop was closed.
The foundation gave money to the university for a new library.
Her documents were placed in a file and sent to the ministry.
The warranty on the car had run out a month before.
The public domain of politics was of no interest to him.
Data from the survey is made available to members of the team.
The program is available on the site of the station.
They obtained a copy of the map from a dealer in the capital.
The authors of the study found no proof of any effect.
Work on the bridge was carried out under the terms of the old contract.
The company is known for its general stores in small towns.
The gnu is an antelope that lives on the plains of the south.
The town of Berkeley has a large university.
Creative work by children was shown in the hall of the school.
She shared the work alike between the two of them.
The institute of technology in the city trains engineers.
A permit is required by law for fires in the forest.
The plan was modified twice and then copied by others.
The information is confidential, said the spokesman of the bank.
Rights of way across the fields are shown on the map.
All copies of the newspaper were sold by noon.
The basis of the sauce is butter, flour and milk.
""".strip().splitlines()


#: Words too common to tell anything by themselves.
COMMON = (
    "a all an and any are as at by for free from has in is it may no not of on or other part person possible source that the this to "
    "under use with work you 0 1 2 3 4 v"
).split()


#: What a family's notice must hold, one n-gram of each question. A title goes to the word that a version follows.
def _gnu(before: str, short: str) -> dict[str, list[str]]:
    shorts = [short, *[f"{short}{v}{n}" for v in ("", "v") for n in range(10)]]
    return {"name": [f"{before} general", *shorts], "title": ["general public license", "general public licence", *shorts]}


NEEDED = {
    "agpl-3.0": _gnu("affero", "agpl"),
    "apache-2.0": {"title": ["apache license", "apache licence", *[f"apache {v}{n}" for v in ("", "v") for n in range(10)]]},
    "cc-by": {"name": ["cc by", "creative commons attribution"]},
    "cc-by-nc": {"name": ["by nc", "attribution noncommercial", "attribution non commercial"]},
    "cc-by-sa": {"name": ["by sa", "attribution sharealike", "attribution share alike"]},
    "gpl-3.0": _gnu("gnu", "gpl"),
    "lgpl-3.0": _gnu("lesser", "lgpl"),
    "mpl-2.0": {"title": ["mozilla public license", "mozilla public licence", "mpl"]},
}
#: The version of a family's name, if it has one; endings of another variant, after one of the family's words.
VERSIONS = {"agpl-3.0": 3, "apache-2.0": 2, "gpl-3.0": 3, "lgpl-3.0": 3, "mpl-2.0": 2}
VARIANTS = {
    "cc-by": (["by", "attribution"], ["nc", "noncommercial", "non commercial", "nd", "noderivatives", "noderivs", "no derivatives", "sa", "sharealike", "share alike"]),
    "cc-by-nc": (["nc", "noncommercial", "commercial"], ["nd", "noderivatives", "noderivs", "no derivatives", "sa", "sharealike", "share alike"]),
}


def tellings() -> list[tuple[str, str, str, bool, bool]]:
    """(n-gram, family, question, whether it speaks for the family, whether it may stand in later lines).

    The questions are the family's name and title, its version and its variant. Versions 0 to 9 are told apart by their first number.
    """
    found = [(g, f, question, True, False) for f, asked in NEEDED.items() for question, grams in asked.items() for g in grams]
    names = ["license", "licence", "gpl", "lgpl", "agpl", "mpl", "apache"]
    for f, own in VERSIONS.items():
        for n in range(10):
            grams = [f"{w} {n}" for w in ("version", "v", *names)] + [f"v{n}"] + [f"{w}{v}{n}" for w in ("gpl", "lgpl", "agpl", "mpl") for v in ("", "v")]
            # These matter where a line ends in a name.
            grams += [f"{w} {v}{n}" for w in names for v in ("version ", "v ", "v")]
            found += [(g, f, "version", n == own, False) for g in grams]
            if f.endswith("gpl-3.0"):
                found += [(g, f, "version", n == own, True) for g in (f"either version {n}", f"foundation version {n}", f"version {n} of")]
    for f, (words, endings) in VARIANTS.items():
        found += [(f"{w} {e}", f, "variant", False, False) for w in words for e in endings]
        found += [(f"{w} {n}", f, "variant", True, False) for w in words for n in range(10)]
    return found


def ngrams(text: str) -> list[str]:
    """The distinct n-grams that hold a word which is not common."""
    words = re.findall("[a-z0-9]+", text.lower())
    runs = {tuple(words[i : i + n]) for n in SIZES for i in range(len(words) - n + 1)}
    return sorted(" ".join(run) for run in runs if not set(run) <= set(COMMON))


@dataclass
class LicenseModel:
    families: list[str]
    bias: np.ndarray
    weights: dict[str, np.ndarray]
    threshold: float

    def family_of(self, logits: np.ndarray) -> str | None:
        """The best family at the threshold; ``UNTOLD`` where none is, but the paragraph is one of a licence."""
        logits = np.round(logits, 9)
        named = [(-logits[i], f) for i, f in enumerate(self.families) if f != UNTOLD and logits[i] >= self.threshold]
        if named:
            return min(named)[1]
        return UNTOLD if UNTOLD in self.families and logits[self.families.index(UNTOLD)] >= self.threshold else None

    def logits(self, text: str) -> np.ndarray:
        return self.bias + sum((self.weights[g] for g in ngrams(text) if g in self.weights), np.zeros(len(self.families)))


def _fit(texts: list[str], classes: np.ndarray, families: list[str]) -> LicenseModel:
    grams = sorted({g for t in texts for g in ngrams(t)})
    at = {g: i for i, g in enumerate(grams)}
    rows, columns = np.array([(row, at[g]) for row, t in enumerate(texts) for g in ngrams(t)], int).reshape(-1, 2).T
    # The n-grams of each text, and the texts of each n-gram; every n-gram has one.
    filled, row_starts = np.unique(rows, return_index=True)
    by_column = np.argsort(columns, kind="stable")
    column_starts = np.unique(columns[by_column], return_index=True)[1]
    y = (classes[:, None] == np.arange(len(families))).astype(float)
    if UNTOLD in families:  # any notice is one of a licence
        y[:, families.index(UNTOLD)] = classes >= 0
    scale = np.where(y == 1, 0.5 / np.maximum(1, y.sum(axis=0)), 0.5 / np.maximum(1, (1 - y).sum(axis=0)))
    weights, bias = np.zeros((len(grams), len(families))), np.full(len(families), -2.0)
    step, z = RATE / np.sqrt(len(rows) / len(texts)), np.zeros((len(texts), len(families)))
    for _ in range(ROUNDS):
        z[filled] = np.add.reduceat(weights[columns], row_starts, axis=0)
        miss = scale * (1 / (1 + np.exp(-(z + bias))) - y)
        weights -= step * np.add.reduceat(miss[rows[by_column]], column_starts, axis=0)
        # The penalty pulls every weight to zero, and small ones onto it.
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - step * PENALTY)
    used = np.flatnonzero(weights.any(axis=1))
    return LicenseModel(families, bias, {grams[i]: weights[i] for i in used}, 0.0)


@lru_cache(maxsize=1)
def train() -> LicenseModel:
    """Fit on all notices, and put the threshold over ordinary paragraphs and under the notices that the fit did not see.

    Both are scored by fits without them, in folds. The threshold is the middle between the highest ordinary paragraph and the median
    notice, so that wordings of licences that no text here has are found as well.
    """
    families = sorted([*TEMPLATES, UNTOLD])
    texts = [(t, i) for i, f in enumerate(families) for t in TEMPLATES.get(f, OTHER)] + [(t, -1) for t in ORDINARY]
    classes = np.array([c for _, c in texts])
    model = _fit([t for t, _ in texts], classes, families)
    fold, unseen = np.arange(len(texts)) % FOLDS, np.zeros(len(texts))
    for k in range(FOLDS):
        part = _fit([t for (t, _), at in zip(texts, fold) if at != k], classes[fold != k], families)
        for i in np.flatnonzero(fold == k):
            unseen[i] = part.logits(texts[i][0]).max()
    highest = max(unseen[classes < 0].max(), model.bias.max())
    lowest = min(min(model.logits(t)[c] for t, c in texts if c >= 0), np.median(unseen[classes >= 0]))
    model.threshold = float((highest + max(lowest, highest)) / 2)
    return model


def cue_words(model: LicenseModel) -> list[str]:
    """Words one of which any paragraph at the threshold must hold.

    Words are taken as no cue, common ones first and then the least telling, as long as all n-grams of such words together
    stay below the threshold.
    """
    positive = {g: np.maximum(0, w) for g, w in model.weights.items()}
    telling: dict[str, float] = {}
    for gram, weight in positive.items():
        for word in gram.split():
            telling[word] = telling.get(word, 0.0) + float(weight.max())
    plain: set[str] = set()
    for word in sorted(telling, key=lambda w: (w not in COMMON, telling[w], w)):
        tried = plain | {word}
        reach = sum((w for g, w in positive.items() if tried.issuperset(g.split())), model.bias.copy())
        if reach.max() >= model.threshold - 1e-6:
            continue
        plain = tried
    return sorted(set(telling) - plain)


#: Words that may lie between the first and the last of joined lines, and that count of these two.
REACH = 2 * max(len(re.findall("[a-z0-9]+", t.lower())) for ts in TEMPLATES.values() for t in ts)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _hits(docs: DataFrame, model: LicenseModel, id_col: str, text_col: str) -> DataFrame:
    """One row for each place of a known n-gram: its words' place in the text, and its first and last line.

    ``line_end`` is the place after the first line, ``line_start`` that of the last one, and ``most`` the largest positive weight.
    """
    spark, cues = docs.sparkSession, "|".join(cue_words(model))
    known = {g: 0.0 for ts in TEMPLATES.values() for t in ts for g in ngrams(t)} | {g: 0.0 for g, *_ in tellings()} | {g: max(0.0, float(w.max())) for g, w in model.weights.items()}
    firsts = F.broadcast(spark.createDataFrame([(w,) for w in sorted({g.split()[0] for g in known})], "word string"))
    known = F.broadcast(spark.createDataFrame(sorted(known.items()), "gram string, most double"))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.lower(text_col).alias("text"))
    cued = rows.filter(F.col("text").rlike(rf"(?<![a-z0-9])(?:{cues})(?![a-z0-9])"))
    # A line without a word takes as many places as keep its neighbours from being joined.
    lines = cued.select("doc_id", "row", F.transform(F.split("text", "\n", -1), lambda t: F.regexp_extract_all(t, F.lit("[a-z0-9]+"), 0)).alias("lines"))
    stream = F.expr(
        f"flatten(transform(lines, (t, i) -> transform(if(size(t) = 0, array_repeat('', {REACH}), t), "
        "(w, k) -> named_struct('word', w, 'line', i, 'at', k, 'of', size(t)))))"
    )
    stream = lines.select("doc_id", "row", stream.alias("a")).filter(F.size("a") > 0)
    after = [F.expr(f"slice(a, {k}, size(a))").alias(c) for k, c in ((2, "b"), (3, "c"))]
    places = stream.select("doc_id", "row", "a", *after).select("doc_id", "row", F.posexplode(F.arrays_zip("a", "b", "c")).alias("place", "w"))
    places = places.withColumn("word", F.col("w.a.word")).join(firsts, "word", "left_semi")
    runs = [
        F.struct(F.lit(n).alias("n"), F.concat(*[x for c in "abc"[:n] for x in (F.lit(" "), F.col(f"w.{c}.word"))][1:]).alias("gram"), F.col(f"w.{c}").alias("last"))
        for n, c in zip(SIZES, "abc")
    ]
    grams = places.select("doc_id", "row", "place", F.col("w.a").alias("first"), F.explode(F.array(*runs)).alias("run"))
    grams = grams.select("doc_id", "row", "place", "first", "run.*").join(known, "gram")
    stop = F.col("place") + F.col("n")
    return grams.select(
        "doc_id",
        "row",
        "gram",
        "most",
        "place",
        stop.alias("stop"),
        F.col("first.line").alias("first"),
        F.col("last.line").alias("last"),
        (F.col("place") - F.col("first.at") + F.col("first.of")).alias("line_end"),
        (stop - 1 - F.col("last.at")).alias("line_start"),
    )


def _joined(hits: DataFrame, least: float) -> DataFrame:
    """The distinct known n-grams of all joined lines whose positive weights come to ``least``.

    Lines without an n-gram at either end would change nothing, so only lines with one begin or end a paragraph.
    """
    bucket = lambda at: F.floor(at / REACH)
    starts = hits.select("row", F.col("first").alias("begin"), F.col("line_end").alias("edge")).distinct()
    starts = starts.withColumn("bucket", F.explode(F.sequence(bucket(F.col("edge")) - 1, bucket(F.col("edge")) + 2)))
    near = hits.withColumn("bucket", bucket(F.col("place"))).join(starts, ["row", "bucket"])
    near = near.filter((F.col("first") >= F.col("begin")) & (F.col("place") >= F.col("edge") - REACH))
    hit = F.struct("gram", "most", "last", "line_start", "stop")
    held = near.groupBy("doc_id", "row", "begin", "edge").agg(F.collect_list(hit).alias("hits"), F.sum("most").alias("most"))
    ends = F.expr(
        f"array_distinct(transform(filter(hits, h -> h.last > begin and h.line_start < edge + {REACH}), "
        "h -> named_struct('last', h.last, 'line_start', h.line_start)))"
    )
    held = held.filter(F.col("most") >= least).select("doc_id", "row", "begin", "hits", F.explode(ends).alias("end"))
    own = F.expr(
        f"array_distinct(transform(filter(hits, h -> h.last <= end.last and h.stop <= end.line_start + {REACH}), "
        "h -> named_struct('gram', h.gram, 'most', h.most)))"
    )
    held = held.select("doc_id", "row", F.col("begin").alias("first"), F.col("end.last").alias("last"), own.alias("own"))
    enough = F.aggregate("own", F.lit(0.0), lambda total, x: total + x["most"]) >= least
    return held.filter(enough).select("doc_id", "row", "first", "last", F.explode("own.gram").alias("gram"))


def _denied(paragraphs: DataFrame, grams: DataFrame, hits: DataFrame) -> DataFrame:
    """``row``, ``first``, ``last`` and ``family`` of the paragraphs whose telling n-grams do not agree with their family."""
    place = ["row", "first", "last", "family"]
    spark = paragraphs.sparkSession
    telling = F.broadcast(spark.createDataFrame(tellings(), "gram string, family string, question string, own boolean, later boolean"))
    needed = F.broadcast(spark.createDataFrame([(f, question) for f, asked in NEEDED.items() for question in asked], "family string, question string"))
    asked = paragraphs.select(*place)
    told = grams.select("row", "first", "last", "gram").join(telling, "gram").drop("gram")
    inside = told.drop("later")
    later = asked.join(told.filter("later").select("row", "first", "family", "question", "own").distinct(), ["row", "first", "family"])
    across = hits.filter("first < last").select("row", F.col("first").alias("last"), "gram").join(telling.filter("question in ('version', 'variant')"), "gram")
    across = asked.join(across.select("row", "last", "family", "question", "own").distinct(), ["row", "last", "family"])
    said = inside.join(asked, place, "left_semi").unionByName(later).unionByName(across)
    said = said.unionByName(asked.join(needed, "family").withColumn("own", F.lit(False)))
    return said.groupBy(*place, "question").agg(F.max("own").alias("own")).filter("not own").select(*place).distinct()


def _reported(judged: DataFrame) -> DataFrame:
    """The innermost paragraphs of each outcome, one for a chain of overlapping ones, and nothing unknown on lines of a confirmed notice."""
    inside = Window.partitionBy("row", "family").orderBy(F.desc("first"), "last").rowsBetween(Window.unboundedPreceding, -1)
    inner = judged.withColumn("inner", F.min("last").over(inside))
    inner = _stored(inner.filter("inner is null or inner > last").drop("inner"), "licence-paragraphs")
    covered = F.explode(F.sequence("first", "last")).alias("line")
    notices = inner.filter("confirmed").select("row", covered).distinct()
    pieces = inner.filter("not confirmed").select("row", "first", "last", covered).join(notices, ["row", "line"], "left_semi")
    pieces = pieces.select("row", "first", "last").distinct().withColumn("confirmed", F.lit(False))
    left = inner.join(pieces, ["row", "first", "last", "confirmed"], "left_anti")
    before = F.lag("last").over(Window.partitionBy("row", "family").orderBy("first"))
    return left.withColumn("before", before).filter("before is null or before < first")


def scan_licenses(docs: DataFrame, model: LicenseModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``paragraph`` (number of its first line from 0), ``family``, ``probability``, ``similarity`` and ``confirmed`` of licence paragraphs."""
    spark, model = docs.sparkSession, model or train()
    columns = [f"w{i}" for i in range(len(model.families))]
    # Model and templates are tables of as many rows as this file's texts have n-grams.
    weights = F.broadcast(
        spark.createDataFrame([(g, *map(float, w)) for g, w in model.weights.items()], f"gram string, {', '.join(c + ' double' for c in columns)}")
    )
    templates = [(f"{family}/{k}", family, g, len(ngrams(t))) for family in model.families for k, t in enumerate(TEMPLATES.get(family, ())) for g in ngrams(t)]
    templates = F.broadcast(spark.createDataFrame(templates, "template string, family string, gram string, size int"))

    hits = _stored(_hits(docs, model, id_col, text_col), "licence-ngrams")
    key = ["doc_id", "row", "first", "last"]
    lines = hits.filter("first = last").select(*key, "gram").distinct()
    least = model.threshold - float(model.bias.max()) - 1e-6
    grams = _stored(lines.unionByName(_joined(hits, least)), "paragraph-ngrams")

    summed = grams.join(weights, "gram").groupBy(*key).agg(*[F.sum(c).alias(c) for c in columns])
    # A family at the threshold comes before the class of all licences, whatever that one's logit.
    names = []
    for i, (c, b, f) in enumerate(zip(columns, model.bias, model.families)):
        logit = F.round(F.col(c) + float(b), 9)
        named = (logit >= model.threshold) & F.lit(f != UNTOLD)
        names.append(F.struct(named.alias("named"), logit.alias("logit"), F.lit(-i).alias("order"), F.lit(f).alias("family")))
    best = summed.select(*key, F.greatest(*names).alias("best")).filter(F.col("best.logit") >= model.threshold)
    best = best.select(*key, F.col("best.family").alias("family"), (1 / (1 + F.exp(-F.col("best.logit")))).alias("probability"))

    shared = grams.join(templates, "gram").groupBy(*key, "family", "template").agg((F.count("*") / F.max("size")).alias("similarity"))
    alike = shared.groupBy(*key, "family").agg(F.max("similarity").alias("similarity"))
    place = ["row", "first", "last", "family"]
    judged = _stored(best.alias("b").join(alike.select(*place, "similarity").alias("a"), place, "left"), "licence-likenesses")
    denied = _denied(judged, grams, hits).withColumn("denied", F.lit(True))
    judged = judged.join(denied, place, "left")
    similarity = F.coalesce(F.col("similarity"), F.lit(0.0))
    confirmed = (similarity >= CONFIRM) & F.col("denied").isNull()
    judged = judged.select(
        *key,
        F.when(confirmed, F.col("family")).otherwise("unknown").alias("family"),
        "probability",
        similarity.alias("similarity"),
        confirmed.alias("confirmed"),
    )
    return _reported(judged).select("doc_id", F.col("first").alias("paragraph"), "family", "probability", "similarity", "confirmed")
