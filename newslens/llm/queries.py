"""The registered queries of this subpackage, one per operator, and their SQL.

Each applies its operator, with production parameters, to its whole table and derives the
columns of its contract from the operator's own result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import (
    exact_dedup, fingerprints, hnsw, jaccard, language, lines, mixing, negatives, packing, periodic, pitman_yor, quality, urls,
)
from newslens.llm.blocks import whole_vector
from newslens.llm.common import WORD, doc_part, or_empty, word_count, written

URL_RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)

#: The tree of the mix: three groups of sources, their languages, the sources themselves.
_NUMBER = r"try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS bigint)"
MIX_LEVELS = {
    "domain": f"CASE WHEN {_NUMBER} < 10 THEN 'web' WHEN {_NUMBER} < 15 THEN 'reference' WHEN {_NUMBER} >= 15 THEN 'books' ELSE 'other' END",
    "language": "lang",
    "source": "source",
}
MIX_WEIGHTS = (
    {"web": 5, "reference": 3, "books": 2},
    {"en": 6, "de": 2, "fr": 2, "es": 1},
    {},
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its bucket, batch and slot."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likenesses."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", or_empty("text").alias("text"))
    rows = fingerprints.with_next(rows, "doc_id", "text", fingerprints.with_sketch, ["sketch"])
    n = F.length("text").cast("bigint")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("next_text", F.lit(1), cut)
    )
    rows = rows.select("doc_id", n.alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = fingerprints.with_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.fingerprint("sketch").alias("fingerprint"),
        fingerprints.fingerprint("edited_sketch").alias("edited_fingerprint"),
        fingerprints.likeness("sketch", "edited_sketch").alias("near_edited"),
        fingerprints.likeness("sketch", "next_sketch").alias("near_next"),
    )


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under a model of nine tenths of them."""
    docs = _table(spark, sf_dir, "documents")
    return pitman_yor.score(docs, doc_part("doc_id", 10) == 0)


def op4_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix, once per epoch, by domain - language - source."""
    docs = _table(spark, sf_dir, "documents")
    lengths = written(
        docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("text"), word_count(or_empty("text")).alias("words")),
        "lengths",
    )
    chosen = mixing.mix(lengths, MIX_LEVELS, MIX_WEIGHTS, tokens=F.col("words"))
    return chosen.select("doc_id", "lang", "source", "epoch", "n_tokens")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for it."""
    rows = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from labelled good and from unlabelled documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", doc_part("doc_id", 5) == 0)
    learned = docs.filter("NOT held_out")
    good = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    model = quality.learn(learned.join(good, "doc_id", "left_semi"), learned)
    rows = quality.score(docs, model)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, by character models of three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    held_out = doc_part("doc_id", 4) == 2
    models = language.learn(docs.filter(~held_out))
    rows = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), models)
    return rows.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted")


def op8_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rows = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates and its number of links to different texts."""
    rows = jaccard.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "class_id", "class_size", "n_links", "kept")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line equals or nearly equals."""
    rows = lines.line_dedup(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "n_chars", "n_lines", "n_dropped")


def _whole_numbers(vector: str):
    """Each component as floor(256 x), in doubles: those from 2**53 on are whole already."""
    scaled = lambda x: F.lit(256.0) * x.cast("double")
    far = lambda x: F.abs(scaled(x)) >= F.lit(2.0**53)
    return F.transform(vector, lambda x: F.when(far(x), scaled(x)).otherwise(F.floor(scaled(x)).cast("double")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each anchor and each of its positives, its hard negatives."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.filter(whole_vector("embedding")).select("vec_id", other.alias("label"), _whole_numbers("embedding").alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0).drop("positive_rank")


def op12_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for each hundredth row."""
    return hnsw.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of each tenth document, by a hash of its id, the words from some place on repeat."""
    docs = docs.select("doc_id", or_empty("text").alias("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    docs = docs.withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    )
    docs = docs.withColumn("n", F.size("words")).withColumn("g", F.expr("h DIV 10"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    tail = F.flatten(F.array_repeat(F.expr("slice(words, a + 1, p)"), F.expr("CAST(1 + (n - a) DIV p AS INT)")))
    repeated = F.concat(F.expr("slice(words, 1, a)"), F.slice(tail, F.lit(1), F.expr("n - a")))
    return docs.select("doc_id", F.coalesce(F.array_join(repeated, " "), "text").alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, its most repeated one, and its text without their repetitions."""
    docs = _with_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = periodic.with_runs(docs).withColumn("best", periodic.best_run("runs"))
    line = lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_QUERIES = (
    op1_length_buckets, op2_closed_syncmers, op3_pitman_yor, op4_hierarchical_mix, op5_exact_dedup,
    op6_pu_quality, op7_kneser_ney, op8_url_trie, op9_jaccard_join, op10_line_dedup, op11_hard_negatives,
    op12_hnsw, op13_periodic_runs,
)


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


_OP4 = r"""
WITH docs AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
    coalesce(lang, 'unknown') AS l1, coalesce(source, 'unknown') AS l2,
    TRY_CAST(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS BIGINT) AS k
  FROM documents
),
rows_ AS (
  SELECT *, CASE WHEN k < 10 THEN 'web' WHEN k < 15 THEN 'reference' WHEN k >= 15 THEN 'books' ELSE 'other' END AS l0
  FROM docs
),
leaves AS (SELECT l0, l1, l2, CAST(sum(n) AS HUGEINT) AS t FROM rows_ GROUP BY ALL),
top AS (SELECT least(CAST(sum(t) AS HUGEINT) * 60 // 100, CAST(sum(t) AS HUGEINT) * 3) AS b FROM leaves),
c0 AS (
  SELECT l0, CAST(sum(t) AS HUGEINT) * 3 AS c, CASE l0 WHEN 'web' THEN 5 WHEN 'reference' THEN 3 WHEN 'books' THEN 2 ELSE 1 END AS w
  FROM leaves GROUP BY l0
),
o0 AS (
  SELECT *, b, coalesce(sum(c) OVER (ORDER BY c::DOUBLE / w, l0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (ORDER BY c::DOUBLE / w, l0 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM c0, top
),
f0 AS (SELECT *, c::DOUBLE * open::DOUBLE <= w::DOUBLE * (b - before)::DOUBLE AS full_ FROM o0),
g0 AS (
  SELECT l0, CASE WHEN full_ THEN c ELSE least(c, CAST(floor((b - coalesce(sum(CASE WHEN full_ THEN c END) OVER (), 0))::DOUBLE * w::DOUBLE
    / (sum(CASE WHEN NOT full_ THEN w END) OVER ())::DOUBLE) AS HUGEINT)) END AS g FROM f0
),
c1 AS (
  SELECT l0, l1, CAST(sum(t) AS HUGEINT) * 3 AS c, CASE l1 WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w
  FROM leaves GROUP BY l0, l1
),
o1 AS (
  SELECT c1.*, g AS b, coalesce(sum(c) OVER (PARTITION BY l0 ORDER BY c::DOUBLE / w, l1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (PARTITION BY l0 ORDER BY c::DOUBLE / w, l1 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM c1 JOIN g0 USING (l0)
),
f1 AS (SELECT *, c::DOUBLE * open::DOUBLE <= w::DOUBLE * (b - before)::DOUBLE AS full_ FROM o1),
g1 AS (
  SELECT l0, l1, CASE WHEN full_ THEN c ELSE least(c, CAST(floor((b - coalesce(sum(CASE WHEN full_ THEN c END) OVER (PARTITION BY l0), 0))::DOUBLE * w::DOUBLE
    / (sum(CASE WHEN NOT full_ THEN w END) OVER (PARTITION BY l0))::DOUBLE) AS HUGEINT)) END AS g FROM f1
),
c2 AS (SELECT l0, l1, l2, t * 3 AS c, 1 AS w FROM leaves),
o2 AS (
  SELECT c2.*, g AS b, coalesce(sum(c) OVER (PARTITION BY l0, l1 ORDER BY c::DOUBLE / w, l2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (PARTITION BY l0, l1 ORDER BY c::DOUBLE / w, l2 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM c2 JOIN g1 USING (l0, l1)
),
f2 AS (SELECT *, c::DOUBLE * open::DOUBLE <= w::DOUBLE * (b - before)::DOUBLE AS full_ FROM o2),
g2 AS (
  SELECT l0, l1, l2, CASE WHEN full_ THEN c ELSE least(c, CAST(floor((b - coalesce(sum(CASE WHEN full_ THEN c END) OVER (PARTITION BY l0, l1), 0))::DOUBLE * w::DOUBLE
    / (sum(CASE WHEN NOT full_ THEN w END) OVER (PARTITION BY l0, l1))::DOUBLE) AS HUGEINT)) END AS g FROM f2
),
plan AS (
  SELECT l0, l1, l2, t, CASE WHEN t > 0 THEN g // t ELSE 0 END AS passes, CASE WHEN t > 0 THEN g % t ELSE 0 END AS rest
  FROM g2 JOIN leaves USING (l0, l1, l2)
),
placed AS (
  SELECT doc_id, lang, source, n, passes, rest, t, sum(n) OVER (PARTITION BY l0, l1, l2
    ORDER BY md5('17:' || passes || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows_ JOIN plan USING (l0, l1, l2)
),
taken AS (
  SELECT *, least(3, passes + CASE WHEN upto <= rest AND (rest > 0 OR t = 0) THEN 1 ELSE 0 END) AS copies FROM placed
)
SELECT doc_id, lang, source, CAST(unnest(range(CAST(copies AS BIGINT))) AS INTEGER) AS epoch, CAST(n AS BIGINT) AS n_tokens FROM taken
"""

_OP5 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY h) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k
"""

_OP8 = r"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
),
rules(h, q, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
  SELECT page_id, h || q AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(q) DESC) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON fit.page_id = p.page_id AND k = 1
"""


_OP11 = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT a.vec_id AS a, r.vec_id AS r, a.label = r.label AS same, CAST(list_dot_product(a.e, r.e) AS BIGINT) AS s
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
),
p AS (SELECT a, r, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, r) <= 5),
n AS (
  SELECT p.a, p.r AS p, p.s AS ps, s.r AS n, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.s DESC, s.r) AS k
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s
)
SELECT a AS anchor_id, p AS positive_id, CAST(k AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE k <= 3
"""


def oracle_sql() -> dict:
    return {"op4_hierarchical_mix": _OP4, "op5_exact_dedup": _OP5, "op8_url_trie": _OP8, "op11_hard_negatives": _OP11}
