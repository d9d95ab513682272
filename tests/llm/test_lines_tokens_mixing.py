"""Line dedup, SentencePiece and mixing against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from hitloom.llm import line_dedup, mixing, queries, sentencepiece_chunks
from hitloom.llm.suffix_groups import suffix_order
from pyspark.sql import functions as F

from .helpers import awkward_texts, documents, prose


def _key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        {c: c + 32 for c in range(65, 91)}
    )


@pytest.mark.parametrize("least", [1, 2, 3])
def test_lines(spark, least):
    docs = documents(spark)
    rows = docs.collect()
    seen = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            seen[_key(line)].add(r.doc_id)
    want = Counter()
    for r in rows:
        lines = (r.text or "").split("\n")
        left = [x for x in lines if not (_key(x) and len(seen[_key(x)]) >= least)]
        want[r.doc_id, None if r.text is None else "\n".join(left), len(lines), len(lines) - len(left)] += 1
    out = line_dedup.dedup_lines(docs, min_docs=least, batches=3)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()) == want


def test_lines_short_keys_stay_and_names_clash(spark):
    docs = spark.createDataFrame([(i, "ab\nabc") for i in range(3)], "doc_id long, text string").withColumn("n_lines", F.lit(1))
    out = line_dedup.dedup_lines(docs, min_docs=2, min_chars=3).collect()
    assert [(r.text, r.n_lines, r.n_lines_, r.n_dropped) for r in out] == [("ab", 1, 2, 1)] * 3


def test_runs_are_levelled_and_compacted(spark):
    runs = line_dedup.LineRuns(spark, threshold=3, fanout=2, buckets=2)
    for batch in ([(1, 10), (2, 10)], [(3, 10), (3, 20)], [(4, 20), (5, 10)], [(6, 20)]):
        runs.add(spark.createDataFrame([(d, k, k) for d, k in batch], "doc long, k1 long, k2 long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    # key 10 was settled after two batches, so later batches did not store it again
    assert sorted(runs.settled().collect()) == [(10, 10), (20, 20)]
    runs.drop()


def test_failed_batches_leave_no_runs(spark, monkeypatch):
    def broken(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(line_dedup.LineRuns, "settled", broken)
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(RuntimeError, match="lost"):
        line_dedup.dedup_lines(documents(spark))
    assert {t.name for t in spark.catalog.listTables()} == before


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece

    model = queries.tokenizer_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = [*awkward_texts(), "▁▁ lead", " x", "x ", "a b", "▁", "   ", "\x00 nul", "<s> </s> <0x41>", "tab\t\ttab"]
    docs = documents(spark, texts)
    done = sentencepiece_chunks.decode(sentencepiece_chunks.encode(docs, model), model, ids_col="ids_")
    assert done.columns == [*docs.columns, "ids_", "decoded"]
    for r in done.collect():
        want = sp.encode(r.text or "", add_eos=True)
        assert r.ids_ == want
        assert r.decoded == sp.decode(want)
    both = sentencepiece_chunks.encode_and_decode(docs, model)
    assert both.columns == done.columns
    assert Counter(map(str, both.collect())) == Counter(map(str, done.collect()))


def test_decoding_of_any_ids(spark):
    import sentencepiece

    model = queries.tokenizer_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    lists = [[], None, [0], [1, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [3 + 0xFF, 500, 3 + 0x80], [28705, 28705, 400], [400, 0, 401]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n long, ids array<int>")
    for r in sentencepiece_chunks.decode(df, model).collect():
        assert r.decoded == sp.decode(r.ids or [])


def _fill(children, budget):
    """Water filling by bisection: children are (capacity, weight)."""
    if sum(c for c, w in children if w > 0) <= budget:
        return [c if w > 0 else 0.0 for c, w in children]
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(c, w * mid) for c, w in children) < budget else (low, mid)
    return [min(c, w * low) for c, w in children]


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [
        ("a", "x", 4.0, 1.0, 10), ("a", "y", 4.0, 1.0, 1000), ("a", "z", 4.0, 0.0, 500),
        ("b", "x", 1.0, 3.0, 50), ("b", "y", 1.0, 1.0, 40), ("c", "x", 0.0, 1.0, 70), (None, None, 2.0, 1.0, 5),
    ]
    df = spark.createDataFrame([(*leaf, 1) for leaf in leaves], "p0 string, p1 string, w0 double, w1 double, supply long, n long")
    for budget in (1.0, 60.0, 200.0, 900.0, 5000.0):
        got = {(r.p0, r.p1): r["take"] for r in mixing.budgets(df, 2, F.lit(budget), 1.0).collect()}
        tops = sorted({leaf[0] for leaf in leaves}, key=str)
        own = {t: [leaf for leaf in leaves if leaf[0] == t] for t in tops}
        caps = [(sum(leaf[4] for leaf in own[t] if leaf[3] > 0), own[t][0][2]) for t in tops]
        for t, share in zip(tops, _fill(caps, budget), strict=True):
            shares = _fill([(leaf[4], leaf[3]) for leaf in own[t]], share)
            for leaf, want in zip(own[t], shares, strict=True):
                assert abs(got[t, leaf[1]] - want) <= 1 + 1e-6


def test_mixing_takes_a_prefix_of_the_epoch(spark):
    docs = documents(spark)
    out = mixing.mix_sources(docs, [F.col("lang"), F.col("source")], [F.lit(1.0), F.lit(2.0)], share=0.5, max_epochs=2.0)
    assert out.columns == [*docs.columns, "copies", "tokens_"]
    rows = out.collect()
    assert all(r.copies in (1, 2, 3) for r in rows)
    assert all(r.tokens_ == len((r.text or "").split()) for r in rows)
    total = sum(len((r.text or "").split()) for r in docs.collect())
    # each leaf may go over its share by its last document
    assert sum(r.tokens_ * r.copies for r in rows) >= 0.5 * total * 0.99
    again = mixing.mix_sources(docs, [F.col("lang"), F.col("source")], [F.lit(1.0), F.lit(2.0)], share=0.5, max_epochs=2.0)
    assert Counter(map(str, again.collect())) == Counter(map(str, rows))


def test_mixing_without_usable_weights(spark):
    docs = documents(spark)
    for w in (None, -1.0, float("nan"), 0.0):
        assert mixing.mix_sources(docs, [F.col("lang")], [F.lit(w).cast("double")]).count() == 0


def test_sources_without_a_number_take_part(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    names = [None, "web", "", "src1", "src2", "src7", "src99999999999"]
    rows = [(i, prose(20 + i % 13, i), ["en", "de", None][i % 3], names[i % 7], 1) for i in range(140)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    out = [tuple(r) for r in queries.QUERIES["op3_mixing"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert Counter(out) == Counter(con.execute(queries.SQL["op3_mixing"]).fetchall())
    assert {r[2] for r in out} == set(names)


def test_lines_left_without_sorting_texts(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_dedup.dedup_lines(documents(spark), min_docs=2)
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_suffix_order_equals_sorting():
    import random

    rng = random.Random(5)
    for _ in range(1500):
        text = [0]
        for _ in range(rng.randint(0, 4)):
            text += [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 12))] + [0]
        suffix = lambda p, t=text: t[p : t.index(0, p)]
        order = suffix_order(text)
        assert sorted(order) == [p for p, s in enumerate(text) if s]
        assert [suffix(p) for p in order] == sorted(suffix(p) for p in order)
