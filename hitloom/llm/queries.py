"""The operators of this package over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import cross_polytope, dual_tree, fingerprints, language_id, license_scan, line_dedup, mixing, paragraph_dedup, sentencepiece_chunks, suffix_dedup, warc_zst, weighted_minhash, whitening
from hitloom.llm.common import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text: str) -> F.Column:
    """Lowercase hex digest of a text column in UTF-8, null as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def source_tree() -> tuple[list[F.Column], list[F.Column]]:
    """Levels (domain, language, source) and their weights; sources are dealt to four domains by number.

    A source that is null or has no usable number is of the null domain, which has weight 1 like the fourth.
    """
    domain = F.concat(F.lit("d"), F.regexp_extract("source", r"(\d+)", 1).try_cast("int") % 4)
    weight = F.when(domain == "d0", 4.0).when(domain == "d1", 3.0).when(domain == "d2", 2.0).otherwise(1.0)
    lang = F.when(F.col("lang") == "en", 2.0).otherwise(1.0)
    return [domain, F.col("lang"), F.col("source")], [weight, lang, F.lit(1.0)]


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, *source_tree(), share=0.6, max_epochs=3.0, seed=17)
    return mixed.select("doc_id", "lang", "source", "tokens", "copies")


_LEVEL = """
n{i} AS (SELECT {path}, max(w{i}) AS w, max(c{i}) AS c, max({budget}) AS b FROM t{i} GROUP BY {path}),
o{i} AS (
  SELECT *, (b - coalesce(sum(c) OVER (PARTITION BY {parent} ORDER BY c / w, {path}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(w) OVER (PARTITION BY {parent}) - sum(w) OVER (PARTITION BY {parent} ORDER BY c / w, {path}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + w) AS l
  FROM n{i} WHERE w > 0 AND c > 0),
g{i} AS (
  SELECT {path}, CASE WHEN sum(c) OVER (PARTITION BY {parent}) <= b THEN c
    ELSE least(c, w * max(l) OVER (PARTITION BY {parent})) END AS got FROM o{i}),
t{j} AS (SELECT t{i}.*, coalesce(got, 0.0) AS b{j} FROM t{i} LEFT JOIN g{i} ON {same})"""

SQL["op3_mixing"] = (
    r"""
WITH r AS (
  SELECT doc_id, lang, source,
    'd' || CAST(TRY_CAST(nullif(regexp_extract(source, '(\d+)', 1), '') AS INTEGER) % 4 AS VARCHAR) AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS tokens
  FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(tokens)::DOUBLE AS supply,
    CASE domain WHEN 'd0' THEN 4.0 WHEN 'd1' THEN 3.0 WHEN 'd2' THEN 2.0 ELSE 1.0 END::DOUBLE AS w0,
    CASE WHEN lang = 'en' THEN 2.0 ELSE 1.0 END::DOUBLE AS w1, 1.0::DOUBLE AS w2
  FROM r GROUP BY domain, lang, source),
c AS (SELECT *, supply * 3.0::DOUBLE AS c2 FROM leaf),
t0 AS (
  SELECT *, sum(c2) OVER (PARTITION BY domain, lang) AS c1,
    CASE WHEN w0 > 0 THEN sum(c2) OVER (PARTITION BY domain) ELSE 0.0 END AS c0,
    0.6::DOUBLE * sum(supply) OVER () AS b0
  FROM c),"""
    + ",".join(
        _LEVEL.format(
            i=i,
            j=i + 1,
            path=", ".join(["domain", "lang", "source"][: i + 1]),
            parent=", ".join(["domain", "lang"][:i]) or "1",
            budget=f"b{i}",
            same=" AND ".join(
                f"t{i}.{p} IS NOT DISTINCT FROM g{i}.{p}" for p in ["domain", "lang", "source"][: i + 1]
            ),
        )
        for i in range(3)
    )
    + r""",
a AS (
  SELECT domain, lang, source, CAST(floor(b3 + 1e-6) AS BIGINT) AS take, CAST(supply AS BIGINT) AS supply
  FROM t3 WHERE floor(b3 + 1e-6) > 0),
k AS (
  SELECT r.*, take // supply AS epoch, take % supply AS rest,
    md5('17:' || CAST(take // supply AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM r JOIN a ON r.domain IS NOT DISTINCT FROM a.domain AND r.lang IS NOT DISTINCT FROM a.lang
    AND r.source IS NOT DISTINCT FROM a.source),
s AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - sum(tokens) OVER (PARTITION BY domain, lang, source, key) AS before
  FROM k)
SELECT doc_id, lang, source, tokens, CAST(epoch + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM s WHERE epoch + CASE WHEN before < rest THEN 1 ELSE 0 END > 0"""
)


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = stage(warc_zst.write_archives(table(spark, sf_dir, "pages")), "warc")
    return warc_zst.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256")
    )


SQL["op6_line_dedup"] = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM s),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key AS hit FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hit) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hit IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON key = hit GROUP BY doc_id"""


def tokenizer_model() -> str:
    """Path of the BPE model with byte fallback that is installed with the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokens(docs: DataFrame) -> DataFrame:
    """`docs` without the text, with ids and end id, their number and digest, and the decoded text's digest."""
    model = tokenizer_model()
    done = sentencepiece_chunks.encode_and_decode(docs, model, eos=True).drop("text")
    return done.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256),
            "decoded_sha256": sha256("decoded"),
        }
    )


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


# Every pair of a label: fast enough for whole tables of this size, exact by definition.
SQL["op10_cross_polytope"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e)
    AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(id, low) AS (
  SELECT a, least(a, min(b)) FROM p GROUP BY a
  UNION
  SELECT p.a, r.low FROM r JOIN p ON p.b = r.id WHERE r.low < p.a),
c AS (SELECT id, min(low) AS low FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id,
  vec_id = coalesce(low, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.id = vec_id"""


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.train(docs, F.col("text"), F.col("lang"), sample=4000)
    of_docs = language_id.identify_documents(docs, model, [F.col("doc_id")])
    of_pages = language_id.identify_pages(pages, model, [F.col("page_id")])
    out = ["language", F.round("posterior", 6).alias("posterior"), "letters", "kept"]
    return of_docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), *out).unionByName(
        of_pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", *out)
    )


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weighted_minhash.near_documents(docs, threshold=0.8, shingle=5, plain=True)


@query
def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return paragraph_dedup.dedup_paragraphs(docs, threshold=0.8, shingle=5, min_words=20).select(
        "doc_id", "n_paragraphs", "n_removed", "removed", "removed_bytes", "kept_in", sha256("text").alias("kept_sha256")
    )


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_next(table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, size=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "spans"
    )


@query
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.drop("places")


def _license_sql() -> str:
    """The scan in SQL; templates and phrases are written out as lists."""

    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    templates = ", ".join(f"({i}, '{t.label}', {listed(t.words)})" for i, t in enumerate(license_scan.TEMPLATES))
    phrases = ", ".join(
        f"({i}, {listed(license_scan.words_of(p))})" for i, t in enumerate(license_scan.TEMPLATES) for p in t.phrases
    )
    base = ", ".join(f"('{label}', {listed(license_scan.words_of(p))})" for p, label in license_scan.BASE.items())
    return rf"""
WITH template(t, label, words) AS (VALUES {templates}),
phrase(t, words) AS (VALUES {phrases}),
base(label, words) AS (VALUES {base}),
d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '{license_scan.WORD}') AS ws
  FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM d),
tw AS (SELECT t, unnest(words) AS word, unnest(range(len(words))) AS pos FROM template),
first_of AS (SELECT t, word, min(pos) AS off FROM tw GROUP BY t, word),
df AS (SELECT word, count(DISTINCT r) AS df FROM w WHERE word IN (SELECT word FROM tw) GROUP BY word),
n AS (SELECT count(*) AS n FROM d),
weighed AS (
  SELECT t, word, off, floor(1000 * ln((2 * n.n + 2) / (2 * coalesce(df, 0) + 1)))::BIGINT AS idf
  FROM first_of LEFT JOIN df USING (word), n),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY idf DESC, word) AS rk FROM weighed),
anchor AS (SELECT t, word, off, greatest(idf, 1) AS weight FROM ranked WHERE rk <= {license_scan.ANCHORS}),
total AS (SELECT t, sum(weight) AS total FROM anchor GROUP BY t),
lead_of AS (
  SELECT t, arg_min(word, rk) AS word, arg_min(off, rk) AS off FROM ranked
  WHERE (t, word) IN (SELECT t, unnest(words) FROM phrase) GROUP BY t),
place AS (SELECT DISTINCT r, t, pos - off AS origin FROM w JOIN lead_of USING (word)),
found AS (
  SELECT DISTINCT p.r, p.t, origin, a.word, weight FROM place p JOIN anchor a ON a.t = p.t
  JOIN w ON w.r = p.r AND w.word = a.word AND w.pos BETWEEN origin + off - {license_scan.SLACK} AND origin + off + {license_scan.SLACK}),
scored AS (
  SELECT r, t, origin, sum(weight) / any_value(total) AS score FROM found JOIN total USING (t)
  GROUP BY r, t, origin HAVING sum(weight) / any_value(total) >= {license_scan.COVERAGE}),
checked AS (
  SELECT r, t, any_value(label) AS label, any_value(score) AS score
  FROM scored JOIN d USING (r) JOIN template USING (t) JOIN phrase p USING (t)
  GROUP BY r, t, origin
  HAVING bool_and(len(list_filter(range(greatest(origin - {license_scan.SLACK}, 0), origin + len(template.words) + {license_scan.SLACK + 1}),
    lambda q: ws[q + 1 : q + len(p.words)] = p.words)) > 0)),
of_method AS (SELECT r, list(DISTINCT label) AS labels, max(score) AS score FROM checked GROUP BY r),
hit AS (
  SELECT r, label, unnest(list_filter(range(len(ws)), lambda q: ws[q + 1 : q + len(words)] = words)) AS start
  FROM d, base),
of_base AS (
  SELECT r, count(*) AS n, min(start) AS lo, max(start) AS hi, list(DISTINCT label) AS labels FROM hit GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0) END AS score
FROM d LEFT JOIN of_base b USING (r) LEFT JOIN of_method m USING (r)"""


SQL["op13_licenses"] = _license_sql()


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


SQL["op12_ranked_search"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
d AS (SELECT r, doc_id, len(ws)::BIGINT AS n FROM words WHERE len(ws) > 0),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
i AS (
  SELECT item_id, row_number() OVER () AS i, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ws
  FROM benchmark),
it AS (SELECT i, item_id, unnest(ws) AS term FROM i),
t AS (SELECT r, unnest(ws) AS term FROM words),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM it) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, s GROUP BY term),
x AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS gain
  FROM tf JOIN w USING (term) JOIN d USING (r), s),
g AS (SELECT i, item_id, r, doc_id, sum(gain)::BIGINT AS score FROM it JOIN x USING (term) GROUP BY i, item_id, r, doc_id),
k AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM g WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), most=16)
