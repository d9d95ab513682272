"""Ranked search, whitening and licence scans against brute force and awkward tables."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import dual_tree, exact_spectrum, license_scan, whitening
from tests.llm.helpers import awkward_texts, documents, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute_ranks(docs, items, k):
    """Every document scored for every item."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d if d is not None else 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def items_of(spark):
    rows = [
        (1, "alpha1 beta2 GAMMA3, river4"), (2, awkward_texts()[3]), (3, None), (4, ""), (5, "été À 漢字"), (None, "short one"),
        (6, "no such words"), (1, "alpha1 beta2 GAMMA3, river4"), (7, prose(300, 9)), (8, "Short ONE"), (9, "?! --"),
    ]
    return spark.createDataFrame([(i, t, 5, 7) for i, t in rows], "item_id long, text string, score long, rank int"), rows


@pytest.mark.parametrize("size", [None, "small"])
def test_ranked_documents_equal_brute_force(spark, monkeypatch, size):
    if size:
        for name, value in {"TREE_DOCS": 5, "TREE_ENTRIES": 40, "FAN_OUT": 2, "BLOCK_BYTES": 400, "MERGE_PARTS": 2}.items():
            monkeypatch.setattr(dual_tree, name, value)
    texts = awkward_texts() + [prose(60, i) for i in range(40)] + [prose(60, 3)] * 5
    docs = documents(spark, texts).repartition(3)
    items, rows = items_of(spark)
    held = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in dual_tree.ranked_documents(docs, items, k=7).collect()), key=repr)
    assert got == brute_ranks(held, rows, 7)
    assert max(r[1] for r in got) == 7


def test_ranked_documents_of_empty_tables(spark):
    items, _ = items_of(spark)
    docs = documents(spark)
    assert dual_tree.ranked_documents(docs.limit(0), items).count() == 0
    assert dual_tree.ranked_documents(docs, items.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "?!"), (3, "")], "doc_id long, text string")
    assert dual_tree.ranked_documents(nothing, items).count() == 0


def test_trees_prune_and_lose_nothing():
    rng = np.random.default_rng(4)
    n_docs, n_terms = 3000, 400
    weight = rng.integers(1, 9000, n_terms)
    term = np.concatenate([rng.choice(n_terms, 8, replace=False) for _ in range(n_docs)])
    owner, value = np.repeat(np.arange(n_docs), 8), rng.integers(1, 10**6, 8 * n_docs)
    items = [np.unique(rng.choice(n_terms, 6)) for _ in range(30)] + [np.unique(term[:8])]
    root, order = dual_tree.item_tree(items, weight)
    assert sorted(order) == list(range(31))
    for exact in (True, False):
        best, pairs = dual_tree.Best(31, 5), []
        for _ in range(2):  # the second tree meets weakest scores that prune it
            tree = dual_tree.DocumentTree(owner, term, value, n_docs, weight)
            pairs.append(dual_tree.search(root, tree, tree.order, np.zeros(n_docs, bool), weight, best, exact))
        assert pairs[1] < 0.5 * pairs[0] and pairs[1] < 0.4 * n_docs * 31
        dense = np.zeros((n_docs, n_terms), dtype=np.int64)
        dense[owner, term] = value
        for place, i in enumerate(order):
            score = dense[:, items[i]] @ weight[items[i]]
            top = np.lexsort((np.arange(n_docs), -score))[:3]
            # every document was offered twice
            assert best.found[place][0].tolist()[:4:2] == score[top][:2].tolist()


def matrix_of(rows):
    return [[int(v) for v in r] for r in rows]


@pytest.mark.parametrize("kind", ["full", "low rank", "multiple", "one", "close"])
def test_spectrum_equals_floating_point(kind):
    rng = np.random.default_rng(8)
    a = rng.integers(-50, 50, (200, 14))
    m = {
        "full": a.T @ a,
        "low rank": (a[:, :3] @ rng.integers(-2, 3, (3, 14))).T @ (a[:, :3] @ rng.integers(-2, 3, (3, 14))),
        "multiple": np.diag([9] * 3 + [4] * 5 + [1]),
        "one": np.array([[5]]),
        "close": np.diag([10**15, 10**15 - 1, 10**15 - 2]),
    }[kind]
    if kind == "low rank":
        half = a[:, :3] @ rng.integers(-2, 3, (3, 14))
        m = half.T @ half
    size, trace = len(m), int(np.trace(m))
    primes = exact_spectrum.primes_for(size, trace)
    poly = exact_spectrum.combine(exact_spectrum.characteristic_mod(matrix_of(m), primes), primes)
    assert poly[0] == 1 and poly[1] == -trace
    values = np.sort(np.linalg.eigvalsh(m.astype(float)))[::-1]
    rank = size
    while poly[rank] == 0:
        rank -= 1
    assert rank == np.linalg.matrix_rank(m.astype(float))
    for k in range(rank):
        root, shift, number, multiple = exact_spectrum.isolate(poly, trace, k + 1)
        assert root / (1 << shift) == pytest.approx(values[k], rel=1e-9, abs=1e-9 * trace)
        vectors = exact_spectrum.null_vectors(matrix_of(m), trace, root, shift, multiple)
        assert np.abs(vectors @ vectors.T - np.eye(multiple)).max() < 1e-14
        assert np.abs(m @ vectors[number] - root / (1 << shift) * vectors[number]).max() < 1e-12 * trace
    if kind == "multiple":
        assert [exact_spectrum.isolate(poly, trace, k)[2:] for k in (1, 2, 3, 4, 9)] == [(0, 3), (1, 3), (2, 3), (0, 5), (0, 1)]
    if kind == "close":
        assert [exact_spectrum.isolate(poly, trace, k)[3] for k in (1, 2, 3)] == [1, 1, 1]


def brute_whitened(vectors, most):
    """Whitening in floating point of the usable rows, in the given order."""
    x = np.floor(np.array(vectors, dtype=np.float64) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    keep = [k for k in range(len(e))[::-1] if e[k] > 1e-9 * np.trace(v)][:most]
    return (x - s / n) @ u[:, keep] / np.sqrt(e[keep]), e[keep] / np.trace(v), ((n * x - s) ** 2).sum(1), n


VECTORS = "vec_id long, embedding array<float>, label int, x string, n string, component string, copies int, id int"


def vectors_table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, 1, "x", "n", "c", 1, 2) for i, v in enumerate(vectors)], VECTORS)


@pytest.mark.parametrize("most", [3, 16])
def test_whitening_equals_floating_point(spark, most):
    rng = np.random.default_rng(2)
    good = (rng.normal(size=(300, 6)) * [3, 2, 1, 0.5, 0.25, 0.0]).astype(np.float32).tolist()
    good += [good[0]] * 100
    bad = [None, [], [None] + good[1][1:], [float("nan")] + good[1][1:], [float("inf")] * 6, [1e30] * 6, good[0][:4]]
    table = vectors_table(spark, good).union(vectors_table(spark, bad, 1000)).union(vectors_table(spark, good[5:6]).selectExpr(
        "cast(null as long) vec_id", "embedding", "label", "x", "n", "component", "copies", "id"))
    rows = whitening.whiten(table.repartition(3), most=most).toPandas()
    expected, share, squares, n = brute_whitened([*good, good[5]], most)
    count = expected.shape[1]
    assert count == min(most, 5) and len(rows) == 401 * count
    rows = rows.sort_values(["vec_id", "component"], na_position="last")
    got = rows["whitened"].to_numpy().reshape(401, count)
    sign = np.sign((got * expected).sum(0))
    assert np.abs(got * sign - expected).max() < 1e-6
    assert np.abs(rows["explained"].to_numpy().reshape(401, count) / share - 1).max() < 1e-9
    assert rows["deviation"].to_numpy().reshape(401, count).tolist() == np.repeat(squares[:, None], count, 1).tolist()
    assert set(rows["n"]) == {n} and n == 300
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].iloc[0] < 1e-10


def test_whitening_of_large_entries_is_exact(spark):
    """Products beyond 2^53, and squares beyond a long."""
    vectors = [[3e6 * i, float(i % 3), -2e6 * i * i] for i in range(1, 30)]
    rows = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"))
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x, strict=True)]
    exact = {i: sum((29 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in enumerate(x)}
    assert any(v >= 1 << 63 for v in exact.values())
    for r in rows.collect():
        assert r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None)
        assert r["identity_error"] < 1e-6


def test_whitening_without_variance_has_no_rows(spark):
    for vectors in ([], [[1.0, 2.0]] * 4, [None, []]):
        out = whitening.whiten(vectors_table(spark, vectors))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


LICENCES = [
    None, "", "no licence here", "Released under the MIT License.", "UNDER--THE mit_license!", "under the mitK license",
    "Licensed under the Apache License, Version 2.0 and, below, under the MIT license; under the MIT license",
    "this work is licensed under the GNU General Public License, version 3.",
    "this work is not licensed under the general public license of gnu version 3",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this fine software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction",
    "Permission is hereby granted, free of charge, to nobody", "cc by nc cc by nc cc-by-nc", "CC BY-SA 4.0", "licensed under cc by-sa 4.0",
    "mit " * 5000 + "license " * 5000, "gnu general public license version 3", prose(3000, 5) + " licensed under cc by-nc 4.0.",
]


def test_licences(spark):
    docs = spark.createDataFrame(
        [(i, t, "w", "l", 3) for i, t in enumerate(LICENCES)] + [(3, LICENCES[3], "w", "l", 3), (None, LICENCES[5], "w", "l", 3)],
        "doc_id long, text string, words_ string, labels string, n_words long",
    )
    out = license_scan.scan_licenses(docs)
    assert out.columns[:4] == ["doc_id", "words_", "labels", "n_words"]
    rows = {r[0]: r for r in out.collect()}
    assert out.count() == len(LICENCES) + 2
    got = {i: (r["base_labels"], r["labels_"]) for i, r in rows.items()}
    assert {i: g for i, g in got.items() if g != ("", "")} == {
        3: ("mit", "mit"), 4: ("mit", "mit"), 6: ("apache-2,mit", "apache-2,mit"), 7: ("", "gpl-3"), 9: ("", "mit"), 11: ("cc-by-nc", "cc-by-nc"),
        12: ("", "cc-by-sa"), 13: ("", "cc-by-sa"), 15: ("", "gpl-3"), 16: ("cc-by-nc", "cc-by-nc"),
    }
    words = {i: license_scan.re.findall(license_scan.WORD, (t or "").translate(FOLD)) for i, t in enumerate(LICENCES)}
    for i, w in words.items():
        starts = [j for p in license_scan.BASE for j in range(len(w)) if w[j : j + len(p.split())] == p.split()]
        assert (rows[i]["n_words_"], rows[i]["n_base"]) == (len(w), len(starts))
        assert (rows[i]["first_word"], rows[i]["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert rows[i]["score"] == 1.0 if starts else 0 <= rows[i]["score"] <= 1
    assert [(p["label"], p["start"]) for p in rows[9]["places"]] == [("mit", 0)]


def test_a_licence_starts_where_its_first_phrase_stands(spark):
    """Words added between the first phrase and the rarest word do not move the start."""
    grant = license_scan.TEMPLATES[1].text
    more = grant.replace("this software and", "this very fine software and")
    texts = [grant, f"one two {grant}", more, f"one two {more} {more}", "deal " * 3, "Released under the MIT License"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *["charge granted permission hereby free"] * 9])], "doc_id long, text string")
    got = {r["doc_id"]: [p["start"] for p in r["places"] if p["label"] == "mit"] for r in license_scan.scan_licenses(docs).collect()}
    n = len(license_scan.words_of(more))
    assert [got[i] for i in range(6)] == [[0], [2], [0], [2, 2 + n], [], [0]]


def test_texts_are_split_into_words(spark, capsys):
    """At the gaps, without a match for each word."""
    texts = [*LICENCES, "A\x00b:\x7f@Z`{", " a", "a ", "\u212a K\u0130 \u00c9t\u00e9 \U0001f600x_1\ufffd", "free of charge " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", license_scan.word_array(F.col("text")).alias("words"))
    want = {i: license_scan.re.findall(license_scan.WORD, (t or "").translate(FOLD)) for i, t in enumerate(texts)}
    mine = {r["doc_id"]: r["words"] for r in got.filter(f"doc_id < {len(texts) - 1}").collect()}
    assert got.select(F.max(F.size("words"))).first()[0] == 60_000 and len(mine) == len(texts) - 1
    got.explain(True)
    assert "regexp_extract_all" not in capsys.readouterr().out
    # letters other than A-Z may change their case, which no ASCII word sees
    ascii_only = lambda words: [w if w.isascii() else None for w in words]
    assert all(ascii_only(words) == ascii_only(want[i]) for i, words in mine.items())


def test_licences_equal_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from hitloom.llm import queries

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(LICENCES)], "doc_id long, text string")
    got = sorted(tuple(r) for r in license_scan.scan_licenses(docs).drop("places").collect())
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got == sorted(con.execute(queries.SQL["op13_licenses"]).fetchall())


def test_licences_of_an_empty_table_and_without_python(spark):
    docs = documents(spark)
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0
    plan = license_scan.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    own = license_scan.scan_licenses(docs, templates=[], base={"two spaces": "two"}).filter("n_base > 0")
    assert [r["doc_id"] for r in own.collect()] == [9]
    with pytest.raises(ValueError):
        license_scan.scan_licenses(docs, base={"été": "x"})
