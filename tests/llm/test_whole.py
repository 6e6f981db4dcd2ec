"""What a review found left out: each test fails where part of the job is cut."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailgrove.llm import charlm, langid, licenses, neardup, vecdedup

KIND = "doc_id long, text string"


def _shingles(text, k=5):
    w = text.lower().split()
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def _variants(rng, n=30):
    """Texts and near copies of them with one to nine words changed."""
    out = []
    for _ in range(n):
        base = [f"w{int(x)}" for x in rng.integers(0, 4000, int(rng.integers(40, 260)))]
        out.append(" ".join(base))
        for changes in range(1, 10):
            w = list(base)
            for at in rng.choice(len(w), changes, replace=False):
                w[int(at)] = f"x{int(rng.integers(0, 9999))}"
            out.append(" ".join(w))
    return out


def test_near_copies_are_all_pairs_at_similarity(spark):
    """Classes are those of all pairs with a five-word Jaccard similarity of at least 0.8, as brute force finds them."""
    texts = _variants(np.random.default_rng(8))
    sets = [_shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    linked = 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            linked += 1
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), KIND)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_classes(docs).collect()}
    assert linked > 100 and got == {i: find(i) for i in range(len(texts))}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, None).collect()}
    assert kept == {i for i in range(len(texts)) if find(i) == i}


def test_near_copies_odd(spark):
    docs = spark.createDataFrame([(5, "a b"), (3, "A  b"), (4, "a c"), (None, "a b"), (7, ""), (8, None)], KIND)
    assert {(r["doc_id"], r["component_id"]) for r in neardup.near_classes(docs).collect()} == {(5, 3), (3, 3), (4, 4), (None, 3), (7, 7), (8, 7)}
    assert neardup.near_classes(docs.limit(0)).count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, None).collect()} == {3, 4, None, 7, 8}


def _slow_model(rows, order, labels, shared):
    """Interpolated Kneser-Ney from the definition, on strings: a function (word, label) -> log-likelihood, and the counts."""
    raw = {}
    for text, label in rows:
        for w in text.split():
            padded = "^" * (order - 1) + w + "$"
            for end in range(order - 1, len(padded)):
                for k in range(1, order + 1):
                    cell = (k, padded[end - k + 1 : end + 1], label)
                    raw[cell] = raw.get(cell, 0) + 1
    characters = {c for k, g, _ in raw for c in g if k == 1} | ({"^"} if order > 1 else set())
    levels = {}  # (level, label) -> {gram: count}
    for label in range(labels):
        for k in range(1, order):
            before = {}
            for g in {g for size, g, of in raw if size == k + 1 and (shared or of == label)}:
                before[g[1:]] = before.get(g[1:], 0) + 1
            levels[k, label] = before
        top = {}
        for (size, g, of), n in raw.items():
            if size == order and (shared or of == label):
                top[g] = top.get(g, 0) + n
        levels[order, label] = top
        levels[order + 1, label] = {g: n for (size, g, of), n in raw.items() if size == order and of == label}
    total = [sum(levels[order + 1, label].values()) for label in range(labels)]

    def probability(level, g, label):
        if level == 0:
            return 1 / (len(characters) + 1)
        cut = charlm.RARE * total[label] / min(total) if level > order else charlm.DISCOUNT
        below = probability(level - 1, g if level > order else g[1:], label)
        ext = {x: n for x, n in levels[level, label].items() if x[:-1] == g[:-1]}
        if not ext:
            return below
        return (max(ext.get(g, 0) - cut, 0) + sum(min(n, cut) for n in ext.values()) * below) / sum(ext.values())

    def score(w, label):
        padded = "^" * (order - 1) + w + "$"
        return sum(np.log(max(1e-12, probability(order + shared, padded[end - order + 1 : end + 1], label))) for end in range(order - 1, len(padded)))

    return score, raw


@pytest.mark.parametrize("shared", [False, True])
def test_models_equal_slow_kneser_ney(spark, shared):
    """Every gram counts, rare ones of the small class too, and scores are those of the definition; in one part and in several."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdef"), int(rng.integers(1, 7)))) for _ in range(400)]
    rows = [(" ".join(words[i : i + 9]), int(i % 90 == 0)) for i in range(0, 400, 9)] + [("common words again", 0)] * 20 + [("", 0), (None, 1), ("12 34", 1)]
    order = 3
    score, raw = _slow_model([(t or "", y) for t, y in rows if t != "12 34"], order, 2, shared)
    counted = charlm.count_words(spark.createDataFrame(rows, "text string, label int"), 2)
    grams = charlm.count_grams(counted, order, 2).collect()
    for k in range(1, order + 1):
        for label in (0, 1):
            assert sorted(r["n"] for r in grams if (r["size"], r["label"]) == (k, label)) == sorted(n for (size, _, of), n in raw.items() if (size, of) == (k, label))
    asked = [*dict.fromkeys(words[:40]), "common", "zzz", "é", "a" * 50]
    want = np.array([[score(w, label) for label in (0, 1)] for w in asked])
    for rows_a_part in (charlm.PART_ROWS, 100):
        before, charlm.PART_ROWS = charlm.PART_ROWS, rows_a_part
        model = charlm.fit_model(counted, order, 2, shared)
        charlm.PART_ROWS = before
        assert (len(model.files) > 4) == (rows_a_part == 100)
        ll, chars = charlm.Mapped(model).word_scores(asked)
        assert np.allclose(ll, want, rtol=1e-4) and chars.tolist() == [len(w) + 1 for w in asked]


APACHE = """/*
 * Copyright 2024 Some Body
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
int main(void) { return 0; }
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
"""
MIT = """Copyright (c) 2024 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GPL_FILE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

  The GNU General Public License is a free, copyleft license for
software and other kinds of works.
"""


def test_licences_in_headers_files_and_tags(spark):
    texts = {1: APACHE, 2: GPL, 3: MIT, 4: ISC, 5: GPL_FILE, 6: "MIT License\n\nCopyright (c) 2024", 7: "// SPDX-License-Identifier: MIT\nint x;", 8: "# SPDX-License-Identifier: GPL-2.0-or-later", 9: "some words\nReleased under the\nMIT License.\nmore words of prose follow here", 10: "as is well known, rivers run to the sea\nand need no general public", 11: "", 12: None}
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in texts.items()], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["license_id"] for r in licenses.license_scan(files).collect()}
    assert got == {1: "Apache-2.0", 2: "GPL-3.0", 3: "MIT", 4: "ISC", 5: "GPL-3.0", 6: "MIT", 7: "MIT", 8: "GPL-2.0", 9: "MIT", 10: None, 11: None, 12: None}


def test_licence_is_inherited_over_levels(spark):
    """The nearest licensed directory upwards counts, over one, two and three levels."""
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [(1, "a/one", mit), (2, "a/b/two", "words"), (3, "a/b/c/three", "words"), (4, "a/b/c/d/four", "words"), (5, "a/x/five", apache), (6, "a/x/y/z/six", "words"), (7, "q/r/seven", "words")]
    got = {r["doc_id"]: (r["license_id"], r["declared_in"]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "a/one"), 2: ("MIT", "a"), 3: ("MIT", "a"), 4: ("MIT", "a"), 5: ("Apache-2.0", "a/x/five"), 6: ("Apache-2.0", "a/x"), 7: (None, None)}


def test_near_copies_by_sketches(spark):
    """Sketches rule out no similar pair, however full their bytes, and keep most of the others' sets from being brought together."""
    rng = np.random.default_rng(12)
    told = []
    for n in (3, 200, 3000, 100_000):
        base = rng.choice(1 << 32, n, replace=False).astype(np.uint32)
        for share in (0.0, 0.02, 0.05, 0.1, 0.3):
            other = base.copy()
            other[: int(n * share)] = rng.choice(1 << 32, int(n * share)).astype(np.uint32)
            a, b = np.unique(base), np.unique(other)
            x, y = (np.frombuffer(neardup.sketch(s), np.uint8)[None] for s in (a, b))
            may = neardup.may_be_similar(x, y, np.array([len(a)]), np.array([len(b)]))[0]
            assert may or not neardup.similar(a, b)
            told.append((n, share, bool(may)))
    assert (200, 0.3, False) in told and (100_000, 0.3, True) in told
    base = np.arange(1000, 1200)
    sets = spark.createDataFrame([(1, base.tolist()), (2, (base + 10).tolist()), (3, (base + 90).tolist())], "fp long, shingles array<int>")
    pairs = spark.createDataFrame([(2, 1), (3, 1), (3, 2)], "a long, b long")
    assert {(r["a"], r["b"]) for r in neardup._close(pairs, sets).collect()} == {(2, 1)}


def test_vectors_are_dealt_out_once(spark, monkeypatch):
    """However many lists a vector probes, the index holds it once, in files that each are one task's; links over all files are those of brute force."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 24))
    x[600:] = x[:300] + rng.normal(size=(300, 24)) * 0.45  # about the threshold
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    told = []
    monkeypatch.setattr(vecdedup, "ROWS", 64)
    monkeypatch.setattr(vecdedup, "write_index", lambda *args, write=vecdedup.write_index: told.append(write(*args)) or told[0])
    got = {r["vec_id"]: r["n_links"] for r in vecdedup.near_duplicates(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert got == dict(enumerate(((u @ u.T >= 0.9).sum(axis=1) - 1).tolist())) and 50 < sum(got.values()) < 600
    assert len(told[0][1]) > 8 and sum(len(zlib.decompress(cells)) // 4 for _, cells in told[0][1]) == 900


def test_language_limits_come_from_all_rows(spark, monkeypatch):
    """Confidence and rejection are calibrated on every training row that has letters, and their order statistics are exact."""
    seen = []
    monkeypatch.setattr(langid, "_calibrated", lambda table, calibrated=langid._calibrated: (seen.append(table.toPandas() if hasattr(table, "toPandas") else table), calibrated(table))[1])
    words = {"aa": ["river", "stone", "bread", "window"], "bb": ["strom", "stein", "brot", "fenster"]}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[lang], 1 + i % 9)) + f" {chr(97 + i % 26)}{chr(97 + i // 26)}", lang) for i, lang in enumerate(["aa", "bb"] * 100)] + [(900, "12 34", "aa")]
    fitted = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(seen[0]) == 200
    least, root = seen[0]["least"].to_numpy(), np.sqrt(seen[0]["n"].to_numpy())
    middle = np.quantile(least, 0.5, method="lower")
    assert fitted.spread == pytest.approx(4 * np.quantile(np.abs(least - middle) * root, 0.5, method="lower") / 0.6745)
    assert fitted.level == pytest.approx(max(middle, np.quantile(least - fitted.spread / root, langid.KEEP, method="higher")) + langid.SLACK)
    values = rng.normal(size=500).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert [langid.ranked(df, F.col("v"), k) for k in (0, 250, 499)] == np.sort(values)[[0, 250, 499]].tolist()
