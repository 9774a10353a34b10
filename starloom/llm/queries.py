"""The registered queries of these operators and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    collocations,
    divergence,
    embedding,
    hmm,
    language,
    licenses,
    mixture,
    neighbours,
    pieces,
    quality,
    repeats,
    setsketch,
    toxicity,
)
from starloom.llm.learn import bounded_sample, remainder

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
HELD_OUT = 2


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labelled(spark: SparkSession, sf_dir: str, label: str, among=None) -> DataFrame:
    """Texts with one label, of a bounded sample of the labels: their few ids are sent to the documents, which stay where they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label).where(F.col(label).isNotNull())
    chosen = bounded_sample(labels if among is None else labels.where(among), "doc_id")
    return documents(spark, sf_dir).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


@query("op1_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.fit(labelled(spark, sf_dir, "quality"))
    return quality.score(documents(spark, sf_dir), model)


@query("op2_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit(labelled(spark, sf_dir, "toxic", remainder("doc_id", 4) != HELD_OUT))
    scored = toxicity.score(documents(spark, sf_dir), model)
    return scored.select("doc_id", (remainder("doc_id", 4) == HELD_OUT).alias("held_out"), "score", "predicted")


@query("op3_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs.where(remainder("doc_id", 4) != HELD_OUT))
    found = language.identify(docs, model)
    return found.select("doc_id", (remainder("doc_id", 4) == HELD_OUT).alias("held_out"), "lang_pred", "score")


@query("op5_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.score(documents(spark, sf_dir), remainder("doc_id", 7) != HELD_OUT)
    held_out = (remainder("doc_id", 7) == HELD_OUT).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS everything
  FROM sums
), rated AS (
  SELECT *, (everything - coalesce(sum(most) OVER (ORDER BY most / weight, source IS NULL, source
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source IS NULL, source
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weighed
), targets AS (
  SELECT source, source_size,
         CASE WHEN most <= rate * weight THEN most
              ELSE max(CASE WHEN most > rate * weight THEN rate END) OVER () * weight END AS target
  FROM rated
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS take,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('mix-' || s.doc_id), s.doc_id ROWS UNBOUNDED PRECEDING)
          - s.size)::BIGINT AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (greatest(least(take - place, size), 0) + greatest(least(take - source_size - place, size), 0))::BIGINT AS taken
FROM placed
"""


@query("op6_source_mixture", MIX_SQL)
def source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_near_dedup")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


@query("op7_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.with_next(documents(spark, sf_dir))


@query("op8_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir))


@query("op10_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("spans")


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATION_SQL = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLDED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), said AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece
), place AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM said
), total AS (
  SELECT lang, count(*)::BIGINT AS n FROM place GROUP BY lang
), gram AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k AS size
  FROM place, (VALUES (1), (2), (3), (4)) AS s(k) WHERE i + k - 1 <= len(w)
), known AS (
  SELECT lang, phrase, size, count(*)::BIGINT AS f FROM gram GROUP BY lang, phrase, size HAVING count(*) >= 30
), cand AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM known WHERE size >= 2
), cut AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM cand c, (VALUES (1), (2), (3)) AS s(k), known l, known r
  WHERE k < c.size AND l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
    AND r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.size], ' ')
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cut
), inside AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, c.a AS longer
  FROM cand c, (VALUES (2), (3)) AS s(m), (VALUES (1), (2), (3)) AS t(i) WHERE m < c.size AND i + m - 1 <= c.size
), kept AS (
  SELECT b.* FROM best b WHERE b.place = 1 AND NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100::HUGEINT * i.longer >= 80::HUGEINT * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, rank::BIGINT AS rank, phrase, a, l, r.r, n, score FROM ranked r JOIN total t ON r.lang = t.lang WHERE rank <= 2000
"""


@query("op11_collocations", COLLOCATION_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@query("op12_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0)


DIVERGENCE_SQL = f"""
WITH doc AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d, {_FOLDED} AS text FROM documents
), term AS (
  SELECT lang, source, d, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM doc
), kept AS (
  SELECT lang, term, count(*)::BIGINT AS n FROM term GROUP BY lang, term HAVING count(DISTINCT d) >= 10
), counted AS (
  SELECT t.lang, t.source, t.term, count(*)::BIGINT AS n FROM term t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL
), grp AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS total
  FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL
), whole AS (
  SELECT lang, sum(n)::BIGINT AS total, count(*)::BIGINT AS v FROM kept GROUP BY lang
), share AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * w.v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (k.n + 2)) // (w.total + 2 * w.v))::BIGINT AS q
  FROM grp g JOIN whole w ON g.lang = w.lang JOIN kept k ON g.lang = k.lang
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum(((x.p - y.p)::HUGEINT * (x.p - y.p)) // (x.p + y.p)) FROM share x JOIN share y
              ON x.lang = y.lang AND x.term = y.term
              WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
), own AS (
  SELECT lang, source, term AS item, (((p - q)::HUGEINT * (p - q)) // (p + q))::BIGINT AS value FROM share WHERE n > 0 AND p > q
), both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM own
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op13_divergence", DIVERGENCE_SQL)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))
