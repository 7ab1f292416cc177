"""The operators made of DataFrame functions: rules, mixing, line dedup and licence scan."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from helpers import awkward, make_docs, numbered  # noqa: F401
from pyspark.sql import functions as F

from martlet.llm import licenses, lines, mixing, rules


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    kept = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + o for i, w in enumerate(windows) if count[w] > 1 for o in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(kept) - len(set(kept)), len(covered)


def python_free(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rules_by_hand(make_docs, awkward):
    texts = ["a b c a b c a b c", "a a a a", "x\ny\nx\n\n \nx ", "# * $x%|<>&", "a b c d a b c", numbered(0, 60) + " #", "A\x0bB\x0cC\rD\tE  F", "q w e " * 900]
    rows = awkward + [(100 + i, t) for i, t in enumerate(texts)]
    docs = make_docs(rows).withColumn("n_words", F.lit("clash")).withColumn("words", F.lit(1)).withColumn("kept", F.lit(2))
    judged = rules.judge(docs)
    python_free(judged)
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in judged.collect())
    assert got == sorted((str(i), *measures(t)) for i, t, *_ in rows)
    for r in judged.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["fail_bits"] == 0) and not (r["kept"] and r["base_failed"])
    assert rules.judge(docs.limit(0)).collect() == []


def test_policies_and_ablations(make_docs):
    rows = [(1, numbered(0, 60)), (2, "a"), (3, "# " + numbered(100, 70) + " $" * 30), (4, "a b " * 40), (5, "# " * 20)]
    judged = rules.ledger(make_docs(rows))
    policy = rules.Policy("v2", ("few_words", "symbols"))
    assert {r["doc_id"]: r["kept"] for r in rules.apply_policy(judged, policy).collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    found = {r["rule"]: tuple(r[c] for c in ("broken", "removed_by_it_alone", "kept", "kept_without")) for r in rules.ablations(judged, policy).collect()}
    assert found == {"few_words": (2, 1, 2, 3), "symbols": (2, 1, 2, 3)}


def draws(rate, u):
    k, mass, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        k += 1
        mass *= rate / k
        total += mass
    return k


def test_mixing_by_hand(spark, make_docs, awkward):
    rows = [(i, t, "a" if i and i % 3 else "b") for i, t, *_ in awkward] + [(i, f"text {i}", "c") for i in range(1000, 1200)] + [(2000, "x", "d")]
    docs = make_docs(rows).withColumn("replica", F.lit("clash")).withColumn("k", F.lit(1)).withColumn("cdf", F.lit(1))
    targets = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("b", 2.0), ("c", 1.0), ("d", 0.0), ("absent", 5.0)], "source string, weight double")
    mixed = mixing.mix_sources(docs, targets)
    python_free(mixed)
    counts, weights = Counter(r[2] for r in rows), {"a": 4.0, "b": 2.0, "c": 1.0}
    expected = Counter()
    for i, text, source in rows:
        key = str(i) if i is not None else hashlib.md5((text or "").encode()).hexdigest()
        u = int(hashlib.md5(f"{mixing.SEED}:{key}".encode()).hexdigest()[:13], 16) / 2**52
        if source in weights:
            n = draws(weights[source] / 7 * len(rows) / counts[source], u)
            expected.update((str(i), r + 1, n) for r in range(n))
    assert Counter((str(r["doc_id"]), r["replica"], r["copies"]) for r in mixed.collect()) == expected
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_mixing_meets_the_targets_in_random_order(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.expr("if(id % 10 < 7, 'big', 'small')").alias("source"))
    targets = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    mixed = mixing.mix_sources(docs, targets)
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["small"] / 30_000 - 1) < 0.03 and abs(n["big"] / 10_000 - 1) < 0.03
    order = [r["doc_id"] for r in mixed.select("doc_id").limit(2000).collect()]
    assert 0.4 < sum(a < b for a, b in zip(order, order[1:])) / len(order) < 0.6


def test_large_and_small_rates(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.expr("if(id = 0, 'rare', 'rest')").alias("source"))
    targets = spark.createDataFrame([("rare", 1.0), ("rest", 0.001)], "source string, weight double")
    n = {r["source"]: r["count"] for r in mixing.mix_sources(docs, targets).groupBy("source").count().collect()}
    assert abs(n["rare"] / 2997 - 1) < 0.1 and n.get("rest", 0) < 20


def cut_by_hand(rows, min_sites, min_chars=20):
    sites, of_doc = defaultdict(set), defaultdict(set)
    for i, text, source in rows:
        for line in (text or "").split("\n"):
            if len(line.strip(" ")) >= min_chars:
                sites[line.strip(" ")].add(source or "")
                of_doc[i].add(line.strip(" "))
    out = []
    for i, text, _ in rows:
        own = [] if text is None else text.split("\n")
        cut = [x for x in own if len(sites[x.strip(" ")]) >= min_sites and x.strip(" ") in of_doc[i]]
        out.append((str(i), len(own), len(cut), text if text is None else "\n".join(x for x in own if x not in cut)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_sites", [2, 8, 30])
def test_line_dedup_by_hand(make_docs, awkward, min_sites):
    rows = [(r[0], r[1], "z") for r in awkward if r[0] is not None]
    for i in range(300):
        own = [f"a line of document {i} by itself", "a line that is on every single page", "short", f"shared by some of the sites {i % 40}", ""]
        rows.append((1000 + i, "\n".join(own * (1 + i % 2)), None if i % 11 == 0 else f"s{i % 37}"))
    docs = make_docs(rows).withColumn("key", F.lit(1)).withColumn("site", F.lit("clash")).withColumn("keys", F.lit(1))
    cut = lines.cut_shared_lines(docs, min_sites)
    python_free(cut)
    assert sorted(((str(r["doc_id"]), r["n_lines"], r["n_cut"], r["text"]) for r in cut.collect()), key=str) == cut_by_hand(rows, min_sites)
    assert lines.cut_shared_lines(docs.limit(0)).collect() == []


def test_line_dedup_of_rows_without_an_id(make_docs, awkward):
    """Rows without an id lose shared lines like any other, repeated rows and null texts among them."""
    rows = [(r[0], r[1], "z") for r in awkward] + [(None, None, "z"), (None, "", None)]
    for i in range(120):
        own = [f"a line of document {i // 2} by itself", "a line that is on every single page", f"shared by some of the sites {i % 40}"]
        rows.append((None if i % 4 < 3 else 0 if i % 8 < 4 else 1000 + i, "\n".join(own), f"s{i % 37}"))
    cut = lines.cut_shared_lines(make_docs(rows), 2)
    python_free(cut)
    got = sorted(((str(r["doc_id"]), r["n_lines"], r["n_cut"], r["text"]) for r in cut.collect()), key=str)
    assert got == cut_by_hand(rows, 2) and any(i == "None" and n for i, _, n, _ in got)


def test_near_threshold_lines_are_counted_exactly(spark):
    keys = spark.range(4000).select(
        F.expr("id % 2").alias("key"), F.expr("concat('s', if(id % 2 = 0, id % 1000, id % 1400))").alias("site"), F.lit(0).alias("salt")
    )
    found = {r["key"]: (r["sites"], r["exact"]) for r in lines.site_spread(keys, 500).collect()}
    assert found[0] == (500, True) and 650 < found[1][0] < 750 and not found[1][1]


def test_licences(make_docs, awkward):
    model = licenses.train()
    notices = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    rows = awkward + [(100 + i, f"{t}\nsome words\n") for i, (_, t) in enumerate(notices)]
    rows += [(500 + i, t) for i, t in enumerate(licenses.ORDINARY)]
    rows += [(700, "x\ny\n  licensed under the APACHE license, version 2.0"), (701, "Released under the Frobnicate Public License, version 7.")]
    docs = make_docs(rows).withColumn("paragraph", F.lit("clash")).withColumn("family", F.lit(1)).withColumn("row", F.lit(2))
    found = licenses.scan_licenses(docs, model)
    python_free(found)
    got = {(r["doc_id"], r["paragraph"]): r for r in found.collect()}
    for i, (family, _) in enumerate(notices):
        assert got[100 + i, 0]["family"] == family and got[100 + i, 0]["confirmed"]
    assert got[700, 2]["family"] == "apache-2.0"
    assert (701, 0) not in got or got[701, 0]["family"] == "unknown"
    assert not [k for k in got if k[0] is None or k[0] < 100 or 500 <= k[0] < 700]
    assert licenses.scan_licenses(docs.limit(0), model).collect() == []


#: Notices of families and in wordings that no text of the model has, and ordinary paragraphs with words of licences.
UNSEEN = [
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in it.',
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above notice appears.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "This is free and unencumbered software released into the public domain.",
    "This work is licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "Licensed under CC BY-SA.", "Text is available under the Creative Commons Attribution-ShareAlike License.",
    "SPDX-License-Identifier: BSD-2-Clause", "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: GPL-2.0-only",
    "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2.",
    "Released under the Frobnicate Public License, version 7.", "This library is licensed under the Vim license.",
    "Licensed under the Educational Community License, Version 2.0.", "Copyright 2021 Foo Inc. Licensed under the Sleepycat License.",
]
PLAIN = [
    "The company was licensed by the state to run trains.", "He asked for permission to use the hall free of charge.",
    "She has a licence to teach in two states.", "The new version of the program was released in March.",
    "All the rights of the workers were discussed.", "The general gave a public speech.", "Any use of force was prohibited.",
    "Please note the attribution of the painting to a student.", "Copyright law was changed in 1998.",
    "The material was distributed to all members of the public.", "The author of the book lives in Spain.",
    "Open source of the river and free use of the water were in the terms of the sale.",
]


def test_notices_that_the_model_has_not_seen(make_docs):
    model = licenses.train()
    told = {t for ts in (*licenses.TEMPLATES.values(), licenses.OTHER, licenses.ORDINARY) for t in ts}
    assert not told & {*UNSEEN, *PLAIN}
    found = licenses.scan_licenses(make_docs(list(enumerate(UNSEEN + PLAIN))), model)
    python_free(found)
    got = {r["doc_id"]: r["family"] for r in found.collect()}
    assert sorted(got) == list(range(len(UNSEEN)))
    named = {i: f for i, f in got.items() if f != "unknown"}
    assert set(named.values()) <= {"mit", "cc-by-sa"} and got[9] == got[11] == "unknown"


WRAPPED = {
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "apache-2.0": """Licensed under the Apache
License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.""",
    "mit": """Permission is hereby granted, free
of charge, to any person
obtaining a copy
of this software and associated documentation files""",
}


def runs_of(words):
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def agrees(family, inside, across, later):
    """Whether the telling n-grams of a paragraph and of the lines after it speak for the family."""
    said = defaultdict(set, {question: {False} for question in licenses.NEEDED.get(family, ())})
    for gram, f, question, own, may_follow in licenses.tellings():
        here = inside | (across if question in ("version", "variant") else set()) | (later if may_follow else set())
        if f == family and gram in here:
            said[question].add(own)
    return all(True in answers for answers in said.values())


def spans_by_hand(model, text):
    """(first line, family, confirmed) of the notices of a text, by scoring every line and all joined lines."""
    own, reach = [re.findall("[a-z0-9]+", line) for line in text.lower().split("\n")], licenses.REACH
    judged = []
    for s in range(len(own)):
        spans = []
        for e in range(s, len(own)):
            between = own[s + 1 : e]
            if e > s and (not all(own[s : e + 1]) or sum(map(len, between)) >= reach):
                break
            spans.append((e, own[s] if e == s else own[s][-reach:] + sum(between, []) + own[e][:reach]))
        later = set().union(*(runs_of(words) for _, words in spans))
        for e, words in spans:
            logits, held = model.logits(" ".join(words)), set(licenses.ngrams(" ".join(words)))
            if round(float(logits.max()), 9) >= model.threshold:
                after = []
                for line in own[e + 1 : e + 3]:
                    if not line:
                        break
                    after += line
                ends = [own[e][-k:] + after[: n - k] for n in (2, 3) for k in range(1, n) if len(own[e]) >= k and len(after) >= n - k]
                across = {" ".join(end) for end in ends}
                family = model.family_of(logits)
                grams = [licenses.ngrams(t) for t in licenses.TEMPLATES.get(family, [])]
                sure = max([0, *(len(held & set(g)) / len(g) for g in grams)]) >= licenses.CONFIRM
                sure = sure and agrees(family, runs_of(words), across, later)
                judged.append((s, e, family if sure else "unknown", sure))
    inner = [a for a in judged if not any(a != b and a[2] == b[2] and a[0] <= b[0] and b[1] <= a[1] for b in judged)]
    left = [a for a in inner if a[3] or not any(b[3] and b[0] <= a[1] and a[0] <= b[1] for b in inner)]
    return sorted((s, f, sure) for s, e, f, sure in left if not any(b[2] == f and b[0] < s <= b[1] for b in left))


def test_wrapped_licences(make_docs):
    model = licenses.train()
    texts = [f"words of a text\n{notice}\n\nmore words" for notice in WRAPPED.values()]
    texts += ["\n".join(f" * {line}" for line in notice.split("\n")) for notice in WRAPPED.values()]
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    notices = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    texts += [wrap(t, n) for _, t in notices for n in (1, 2, 5, 8)]
    texts += [f"{numbered(0, 200)} licensed under the\nMIT license. {numbered(300, 200)}", "Licensed under the\n\nMIT\n---\nlicense."]
    texts += ["\n".join(wrap(t, 4) for _, t in notices), "\n".join(licenses.ORDINARY), wrap(" ".join(licenses.ORDINARY), 7)]
    texts += ["Released under the Frobnicate Public\nLicense, version 7, licensed under\nthe MIT license."]
    found = licenses.scan_licenses(make_docs(list(enumerate(texts))), model)
    python_free(found)
    got = defaultdict(list)
    for r in found.collect():
        got[r["doc_id"]].append((r["paragraph"], r["family"], r["confirmed"]))
    for i, family in enumerate(WRAPPED):
        assert (1, family, True) in got[i] and (0, family, True) in got[len(WRAPPED) + i]
    for i, text in enumerate(texts):
        assert sorted(got[i]) == spans_by_hand(model, text), text


def test_neighbouring_versions_are_unknown(make_docs):
    """Notices of another version or variant are no family's, however they are wrapped; those of the same one are."""
    model = licenses.train()
    other = [
        "This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU GPL v2.",
        "Licensed under the Apache License, Version 1.1.", "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the GNU Affero General Public License, version 1.", "Licensed under CC BY-NC-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
        "This program is free software: you can redistribute it under the terms of the GNU Lesser General Public License.",
        WRAPPED["gpl-3.0"].replace("version 3", "version 2"), WRAPPED["gpl-3.0"].replace("version 3", "version 2").replace("\n", " "),
    ]
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    texts = other + [wrap(t, n) for t in other for n in (3, 5, 9, 10)]
    same = [("gpl-3.0", f"{t}\nLicensed under the Apache License, Version 2.0.") for t in licenses.TEMPLATES["gpl-3.0"]]
    same += [("gpl-3.0", WRAPPED["gpl-3.0"].replace("\n", " ")), ("gpl-3.0", "Licensed under the GNU GPL v3 (not the GNU GPL v2).")]
    found = licenses.scan_licenses(make_docs(list(enumerate(texts + [t for _, t in same]))), model)
    python_free(found)
    got = defaultdict(list)
    for r in found.collect():
        got[r["doc_id"]].append((r["paragraph"], r["family"], r["confirmed"]))
    for i, text in enumerate(texts):
        assert not [r for r in got[i] if r[2]] and sorted(got[i]) == spans_by_hand(model, text), text
    assert all(got[i] for i in (0, 1, 2, 3, 4, 8, 9, 10, 11))
    for i, (family, text) in enumerate(same):
        assert (0, family, True) in got[len(texts) + i], text


def test_cue_words_change_nothing():
    """No paragraph without a cue can reach the threshold."""
    model = licenses.train()
    cues = set(licenses.cue_words(model))
    pool = [t for ts in licenses.TEMPLATES.values() for t in ts] + licenses.ORDINARY
    for text in pool:
        bare = " ".join(w for w in re.findall("[a-z0-9]+", text.lower()) if w not in cues)
        assert model.logits(bare).max() < model.threshold
    plain = sorted({w for g in model.weights for w in g.split()} - cues)
    assert model.logits(" ".join(plain)).max() < model.threshold
    assert all(max(model.logits(t)) >= model.threshold for ts in licenses.TEMPLATES.values() for t in ts)
