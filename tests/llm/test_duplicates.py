"""Near copies, repeated paragraphs and substrings, vectors and fingerprints against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hitloom.llm import cross_polytope, fingerprints, near_links, paragraph_dedup, passages, suffix_dedup, weighted_minhash
from hitloom.llm.common import classes, shingle_hashes, stage, words_of

from .helpers import awkward_texts, documents, prose


def _fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def _words(text):
    return [w for w in __import__("re").split("[ \t\n\x0b\f\r]+", _fold(text or "")) if w]


def _shingles(text):
    w = _words(text)
    return [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []


def _components(n, links):
    at = list(range(n))
    for _ in range(n):
        for a, b in links:
            at[a] = at[b] = min(at[a], at[b])
    return at


@given(st.lists(st.text("ab \n\tÉ", max_size=12), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_shingles_are_runs_of_words(texts):
    hashes, owner = shingle_hashes([t.encode() for t in texts], 2)
    want = [
        (i, tuple(w[j : j + 2]))
        for i, t in enumerate(texts)
        for w in [_words(t)]
        for j in range(max(len(w) - 1, 1) if w else 0)
    ]
    assert owner.tolist() == [i for i, _ in want]
    assert len({(h, s) for h, (_, s) in zip(hashes.tolist(), want, strict=True)}) == len({s for _, s in want}) == len(set(hashes.tolist()))


def _copies(n, seed):
    """A group of copies that differ from a base, and from each other, by a few words."""
    rng = random.Random(seed)
    base = prose(100, seed).split()
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"w{seed}x{i}"
        out.append(" ".join(words))
    return out


def test_near_documents(spark):
    texts = [*awkward_texts(), *_copies(25, 7), *[prose(60, 100 + i) for i in range(10)]]
    docs = documents(spark, texts)
    rows = docs.collect()
    n = len(rows)
    counts = [Counter(_shingles(r.text)) for r in rows]
    df = Counter(s for c in counts for s in c)
    weight = [{s: k * (math.log((1 + n) / (1 + df[s])) + 1) for s, k in c.items()} for c in counts]
    good = [i for i, r in enumerate(rows) if r.text is not None and r.doc_id is not None]

    def sim(a, b):
        if rows[a].text == rows[b].text:
            return 1.0
        low = sum(min(v, weight[b][s]) for s, v in weight[a].items() if s in weight[b])
        total = sum(weight[a].values()) + sum(weight[b].values()) - low
        return low / total if total else 0.0

    links = [(a, b) for a in good for b in good if a < b and sim(a, b) >= 0.8]
    at = _components(n, links)
    ids = defaultdict(set)
    for i in good:
        ids[at[i]].add(rows[i].doc_id)
    want = Counter((r.doc_id, min(ids[at[i]]) if i in good else r.doc_id) for i, r in enumerate(rows))
    out = weighted_minhash.near_documents(docs)
    assert Counter((r.doc_id, r["class"]) for r in out.collect()) == want
    left = weighted_minhash.keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {k for k, c in want if k == c}


def test_plain_copies_of_a_large_group_are_linked(spark):
    # 40 copies of a text, each with 2 words of its own: 90 of 100 shingles shared, 10 rare
    base = prose(104, 21).split()
    copies = [" ".join([*base[:30], f"own{i}", *base[31:70], f"mine{i}", *base[71:]]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate([*copies, *[prose(104, 300 + i) for i in range(40)]])), "doc_id long, text string")
    weighted = weighted_minhash.near_documents(docs)
    assert len({r["class"] for r in weighted.collect() if r.doc_id < 40}) > 1
    out = {r.doc_id: r["class"] for r in weighted_minhash.near_documents(docs, plain=True).collect()}
    assert {out[i] for i in range(40)} == {0} and all(out[i] == i for i in range(40, 80))


def test_buckets_of_several_classes_lose_no_link(spark, monkeypatch):
    # a chain: each text is like its neighbours only, so no head links all
    words = prose(400, 3).split()
    texts = [" ".join(words[i * 6 : i * 6 + 100]) for i in range(30)]
    monkeypatch.setattr(near_links, "BLOCK", 7)
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    buckets = spark.createDataFrame([(b, i, 96.0) for i in range(30) for b in (1, 2)], "bucket long, id long, size double")

    def prepare(batch):
        return paragraph_dedup.shingle_sets(batch, 5)

    at, links = near_links.near_classes(buckets, lambda ids: rows.join(ids, "id"), prepare, 0.8)
    assert {(r.id, r["class"]) for r in at.collect()} == {(i, 0) for i in range(30)}
    assert all(r.sim >= 0.8 for r in links.collect())


@pytest.mark.parametrize("n, samples", [(400, 3000), (100_000, 500)])
def test_samples_agree_as_often_as_texts_are_alike(n, samples):
    rng = np.random.default_rng(1)
    items = np.sort(rng.integers(0, 1 << 62, n, dtype=np.uint64))
    w = rng.random(n) * 3 + 0.2
    part = n * 3 // 4
    x, y = (items[:part], w[:part]), (items[n // 8 :], w[n // 8 :] * 1.1)
    sampler = weighted_minhash.Sampler(samples, 4)
    a, b = (sampler.sample(i, np.array([0]), v)[0] for i, v in (x, y))
    # four standard errors
    likeness = near_links.likeness(x, y)
    assert abs((a == b).mean() - likeness) < 4 * math.sqrt(likeness * (1 - likeness) / samples)


def test_extreme_draws_are_usable():
    top, none = np.full(2, 0xFFFFFFFF, dtype=np.uint32), np.zeros(2, dtype=np.uint32)
    for u, v in ((top, top), (none, none), (top, none)):
        drawn = weighted_minhash._gamma(u, v)
        assert (drawn > 0).all() and np.isfinite(np.log(drawn)).all()


def test_near_copies_among_very_long_texts(spark):
    words = prose(100_000, 5).split()
    near = list(words)
    for i in range(0, len(near), 70):  # 5 of each 70 shingles change: likeness (65 / 75) = 0.87
        near[i] = f"x{i}"
    far = list(words)
    for i in range(0, len(far), 20):
        far[i] = f"y{i}"
    texts = [" ".join(words), " ".join(near), " ".join(far), prose(100_000, 6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r["class"] for r in weighted_minhash.near_documents(docs, plain=True).collect()}
    assert out == {0: 0, 1: 0, 2: 2, 3: 3}


def _plain_or_weighted_classes(rows):
    """Class of each row by comparing all pairs, with exact document frequencies."""
    n, counts = len(rows), [Counter(_shingles(r.text)) for r in rows]
    df = Counter(s for c in counts for s in c)
    weight = [{s: k * (math.log((1 + n) / (1 + df[s])) + 1) for s, k in c.items()} for c in counts]

    def alike(a, b):
        if rows[a].text == rows[b].text:
            return True
        low = sum(min(v, weight[b][s]) for s, v in weight[a].items() if s in weight[b])
        total = sum(weight[a].values()) + sum(weight[b].values()) - low
        both, either = len(counts[a].keys() & counts[b].keys()), len(counts[a].keys() | counts[b].keys())
        return low >= 0.8 * total > 0 or both >= 0.8 * either > 0

    at = _components(n, [(a, b) for a in range(n) for b in range(a) if alike(a, b)])
    first = {}
    for i, r in enumerate(rows):
        first[at[i]] = min(first.get(at[i], r.doc_id), r.doc_id)
    return {r.doc_id: first[at[i]] for i, r in enumerate(rows)}


def test_near_documents_with_plain_links(spark):
    texts = [*_copies(25, 7), *_copies(20, 8), *[prose(60, 100 + i) for i in range(10)], "", "", "one two", "one two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r["class"] for r in weighted_minhash.near_documents(docs, plain=True).collect()}
    assert out == _plain_or_weighted_classes(docs.collect())


def test_paragraphs(spark):
    a, b, c = prose(60, 1), prose(60, 2), prose(30, 4)
    near = a.replace(a.split()[10], "other")
    texts = [None, "", f"{a}\nx\n{b}", f"{c}\n{near}", f"{b.upper()}\n{b}", "y\ny", f"{c}\n{c}\nshort line", prose(5000, 9), "\n\n"]
    docs = documents(spark, texts)
    out = paragraph_dedup.dedup_paragraphs(docs)
    got = Counter((r.doc_id, r.text, tuple(r.removed)) for r in out.collect())
    # the row of the null id comes first, so its copy of the near paragraph stays, and documents 2, 3 and 6
    # lose theirs; rows that repeat an id and a text are one document
    assert (2, "x\n" + b, (0,)) in got
    assert (3, "", (0, 1)) in got and got[(3, "", (0, 1))] == 3
    assert (4, "", (0, 1)) in got
    assert (6, "short line", (0, 1)) in got
    assert (None, f"{c}\n{near}", ()) in got
    assert out.columns == [*docs.columns, "n_paragraphs", "n_removed", "removed", "removed_bytes", "kept_in"]


def test_short_lines_are_no_paragraphs(spark):
    docs = spark.createDataFrame([(i, "only a few words here") for i in range(5)], "doc_id long, text string")
    assert {r.n_removed for r in paragraph_dedup.dedup_paragraphs(docs).collect()} == {0}


def test_passages_inside_and_over_lines(spark):
    passage = prose(55, 77)
    w = passage.split()
    texts = [
        f"{prose(70, 1)} {passage} {prose(70, 2)}",
        f"{prose(90, 3)} {passage.upper()}\n{prose(40, 4)}",
        "\n".join([prose(30, 5), *[" ".join(w[i : i + 11]) for i in range(0, 55, 11)], prose(30, 6)]),
        prose(200, 8),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in paragraph_dedup.dedup_paragraphs(docs).collect()}
    assert [got[i].n_removed for i in range(4)] == [0, 1, 1, 0]
    assert got[0].text == texts[0] and got[3].text == texts[3]
    assert got[1].removed == [0] and got[1].kept_in == [0] and set(got[2].removed) <= set(range(1, 6))
    for i in (1, 2):
        # what surrounds the passage stays, and of the passage a few words at its ends
        assert got[i].removed_bytes >= 0.7 * len(passage)
        left, rest = got[i].text.lower().split(), iter(texts[i].lower().split())
        assert all(x in rest for x in left)
        assert set(texts[i].lower().split()) - set(left) <= set(w)


def test_words_are_counted_for_many_texts_at_once(monkeypatch):
    calls = []
    monkeypatch.setattr(paragraph_dedup, "words_of", lambda texts: calls.append(len(texts)) or words_of(texts))
    texts = [None, "", *[f"{prose(19, i)}\n\n{prose(20, i)}\x0b \f\t{prose(i % 3, 7)}\né\xa0{prose(18, i)}" for i in range(3000)], "x"]
    got = paragraph_dedup._paragraphs([t if t is None else t.encode() for t in texts], 20)
    for t, (lines, good) in zip(texts, got, strict=True):
        assert lines == (t or "").encode().split(b"\n")
        assert good == [i for i, line in enumerate(lines) if len(line.split()) >= 20]
    assert sum(calls) > 3000 and len(calls) <= 2 + sum(len(t or "") for t in texts) // paragraph_dedup.SLICE_BYTES


def test_different_shingles_are_those_of_each_text():
    texts = [t.encode() for t in (prose(300, 3), "", "a b a b a b a b a b a b", "one", prose(300, 3), "a b a b a b")]
    shingle, owner = paragraph_dedup.different_shingles(texts, 5)
    hashes, of = shingle_hashes(texts, 5)
    assert list(zip(owner.tolist(), shingle.tolist(), strict=True)) == sorted(set(zip(of.tolist(), hashes.tolist(), strict=True)))
    assert [len(s) for s, _ in paragraph_dedup.shingle_sets(texts, 5)] == np.bincount(owner, minlength=len(texts)).tolist()


def test_lists_without_a_long_run_are_told_apart(spark):
    rng, lists = random.Random(4), [[]]
    for _ in range(200):
        places = rng.sample(range(12), rng.randrange(1, 10))
        lists.append([(rng.choice([None, 1, 2]), k, rng.randrange(3, 12), rng.choice([None, 5])) for k in places])
    docs = spark.createDataFrame(list(enumerate(lists)), "id long, cut array<struct<doc:long,place:long,words:long,head:long>>")
    for i, most in docs.select("id", passages.longest_run(F.col("cut"))).collect():
        words = {(d, k): n for d, k, n, _ in lists[i]}
        runs = [0]
        for d, k in words:
            end = k
            while (d, end) in words:
                end += 1
            runs.append(sum(words[d, j] for j in range(k, end)))
        assert most == max(runs)


def test_only_texts_with_a_long_run_are_cut_up_again(spark, monkeypatch):
    """A text whose repeated pieces make no long run is not cut up again."""
    held = []
    real = passages.map_batches
    monkeypatch.setattr(passages, "map_batches", lambda df, fn, *more: held.append((fn.__name__, df)) or real(df, fn, *more))
    phrase = prose(14, 50)
    texts = [f"{prose(30, i)} {phrase} {prose(30, 900 + i)}" for i in range(40)] + [f"{prose(60, 80 + i)} {prose(60, 71)}" for i in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in paragraph_dedup.dedup_paragraphs(docs).collect()}
    assert {i for i, r in got.items() if r.n_removed} == {41, 42}
    listed = next(df for name, df in held if name == "remove")
    assert {r.doc_id for r in listed.filter("size(passage_cut) > 0").collect()} == {41, 42}


def _repeats(texts, size):
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = 1
        edge = np.diff(gone, prepend=0)
        out.append((bytes(b for b, g in zip(t, gone, strict=False) if not g), int(gone.sum()), int((edge == 1).sum())))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings(spark, seed):
    rng = random.Random(seed)
    base = prose(400, seed)
    texts = [*awkward_texts()[:11]]
    for _ in range(25):
        a, n = rng.randrange(len(base)), rng.randrange(20, 700)
        texts.append(prose(rng.randrange(30), rng.randrange(999)) + base[a : a + n] + prose(rng.randrange(30), rng.randrange(999)))
    texts += ["ab" * 300, "b" * 450, "é" * 130 + base[:210], base[:200], base[1:200], "x" + base[:200]]
    docs = documents(spark, texts)
    rows = docs.collect()
    data = [(r.text or "").encode() for r in rows]
    want = Counter((r.doc_id, len(t), *w) for r, t, w in zip(rows, data, _repeats(data, 200), strict=True))
    out = suffix_dedup.remove_repeats(docs, size=200)
    got = Counter((r.doc_id, r.n_bytes, bytes(r.kept_), r.n_removed, r.n_spans) for r in out.collect())
    assert got == want


def test_scan_holds_a_bounded_multiple_of_its_texts():
    import tracemalloc

    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abcdefgh ", k=2000)) for _ in range(200)]
    suffix_dedup.Scan(texts, 200)  # keeps the powers
    tracemalloc.start()
    try:
        scan = suffix_dedup.Scan(texts, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 * 400_000
    # anchors and cores by their definition, in one text
    data = texts[3]
    at = [i - 6000 for i, d in zip(scan.anchor.tolist(), scan.anchor_doc.tolist(), strict=True) if d == 3]
    gram = suffix_dedup.range_hash(scan.prefix, np.arange(6000, 8000 - 15), np.arange(6016, 8001)) >> np.uint64(32)
    chosen = [max(range(r, r + scan.reach), key=lambda i: (-int(gram[i]), i)) for r in range(len(gram) - scan.reach + 1)]
    assert at == sorted(set(chosen))
    low, high = scan.low[scan.doc == 3] - 6000, scan.high[scan.doc == 3] - 6000
    assert low[0] == 0 and high[-1] == len(data) - 200 and (low[1:] == high[:-1] + 1).all()
    ends = [(chosen[w], chosen[w + 200 - 15 - scan.reach]) for w in range(len(data) - 199)]
    assert low.tolist() == [w for w in range(len(ends)) if not w or ends[w] != ends[w - 1]]


def test_scan_computes_what_is_asked_for():
    texts = [bytes(random.Random(i).choices(b"abcdefgh ", k=900)) for i in range(5)]
    scan = suffix_dedup.Scan(texts, 200)
    assert len(scan.phrase) == len(scan.anchor) == len(scan.anchor_doc)
    assert not {"low", "core", "block", "n_phrases", "_cores", "_core_anchors"} & set(vars(scan))
    assert len(scan.block) == len(scan.low) and not {"core", "n_phrases"} & set(vars(scan))


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows, base = [], rng.normal(size=(6, 24))
    for i in range(240):
        v = base[i % 6] + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.2, 0.4])
        rows.append((i, v.tolist(), i % 3))
    rows += [
        (300, None, 1), (301, [], 1), (302, [0.0] * 24, 1), (303, [math.nan] * 24, 1), (304, [None, 1.0], 1),
        (305, base[0].tolist(), None), (306, [1.0, 0.0], 1), (307, [2.0, -0.0], 1), (308, [1e300, 1e299], 1), (None, [1.0, 0.0], 1), (309, [5.0], 2),
        (310, [7.0], 2), (5, rows[5][1], rows[5][2]), (311, [math.inf, 1.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")

    def good(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        if not (good(a) and good(b)) or a[2] != b[2] or len(a[1]) != len(b[1]):
            return False
        x, y = (np.array(v[1]) / np.abs(v[1]).max() for v in (a, b))
        return x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98

    n = len(rows)
    links = [(a, b) for a in range(n) for b in range(a) if linked(rows[a], rows[b])]
    at = _components(n, links)
    low = defaultdict(list)
    for i in range(n):
        if good(rows[i]):
            low[at[i]].append(rows[i][0])
    degree = Counter(x for ab in links for x in ab)
    want = Counter()
    for i, r in enumerate(rows):
        c = min(low[at[i]]) if good(r) else r[0]
        want[r[0], degree[i], c, r[0] is not None and c == r[0]] += 1
    got = Counter(tuple(r) for r in cross_polytope.near_vectors(df).collect())
    assert got == want


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=32)
    df = spark.createDataFrame(
        [(i, (base + rng.normal(size=32) * 0.02).tolist(), 1) for i in range(150)], "vec_id long, embedding array<double>, label int"
    )
    got = cross_polytope.near_vectors(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(149, 0)}


def test_fingerprints_with_next(spark):
    texts = awkward_texts()
    docs = documents(spark, texts)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    got = fingerprints.fingerprint_with_next(docs).collect()
    want, prints = Counter(), defaultdict(set)
    for i, r in enumerate(rows):
        text, after = r.text or "", rows[(i + 1) % len(rows)].text or ""
        want[r.doc_id, len(text), hashlib.sha256(fingerprints.edit(text, after).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by_id = {r.doc_id: r.text or "" for r in rows}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            prints[by_id[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for p in prints.values()}) == len(prints)


def test_phrases_do_not_depend_on_the_offset():
    text = prose(300, 8)
    own, _ = fingerprints.parse([text])
    for k in (1, 2, 3, 17, 200):
        other, _ = fingerprints.parse([prose(60, k)[:k] + text + "tail"])
        shared = len(set(own.tolist()) & set(other.tolist())) / len(set(own.tolist()))
        assert shared > 0.9
    runs, _ = fingerprints.parse(["a" * 5000, "a" * 5000 + "b"])
    assert len(runs) <= 4


def test_likeness_is_that_of_the_phrases():
    off = []
    for seed in range(12):
        x, y = prose(400, seed), prose(300, 50 + seed)
        for z in (x, fingerprints.edit(x, y), y, x[: len(x) * 3 // 4] + y[:200], "start " + x):
            a, b = (set(fingerprints.parse([t])[0].tolist()) for t in (x, z))
            f, g = fingerprints.fingerprints([x, z])
            off.append(fingerprints.likeness(f, g, len(x), len(z)) - len(a & b) / len(a | b))
    # 64 values: a standard error of at most 1/16 each
    assert max(map(abs, off)) < 0.28 and abs(sum(off) / len(off)) < 0.03


def test_classes_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {(r.id, r["class"]) for r in classes(links).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_empty_tables(spark):
    empty = stage(documents(spark, []), "empty")
    assert weighted_minhash.near_documents(empty).count() == 0
    assert paragraph_dedup.dedup_paragraphs(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert fingerprints.fingerprint_with_next(empty).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert cross_polytope.near_vectors(vectors).count() == 0


def test_repeated_pieces_are_deleted_once_they_are_joined(spark):
    text = " ".join(f"w{i * i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"a{i} b{i} {text} c{i}") for i in range(3)], "doc_id long, text string")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.glob("repeated_pieces-*"))
    assert paragraph_dedup.dedup_paragraphs(docs).count() == 3
    assert set(shared.glob("repeated_pieces-*")) == before
