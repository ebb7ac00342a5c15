"""The dealt operators as named queries over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import (
    exact_dedup, interpolation, jaccard_join, language_id, line_dedup, minhash, mixing, ranked_search, spelling, substring_dedup, token_files,
    toxicity, trie_bpe,
)
from lendspark.llm.frames import documents, sha256_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


@query
def op2_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(documents(spark, sf_dir))


@query
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.scores(documents(spark, sf_dir))


@query
def op4_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.encoded_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


#: Shares of all tokens that the mixture aims at, by quality label.
TARGETS = {"quality-1": 0.9, "quality-0": 0.1}


def quality_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.select("doc_id", F.concat(F.lit("quality-"), F.col("quality").cast("string")).alias("domain"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.rates(documents(spark, sf_dir), quality_domains(spark, sf_dir), TARGETS)
    return out.select("doc_id", "tokens", "posterior", "rate", mixing.copies(F.col("rate")).alias("copies"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir), k=3, percent=90)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = line_dedup.apply_bitmaps(docs.select("doc_id", "text"), line_dedup.keep_bitmaps(docs, min_chars=20, min_docs=3))
    return out.select("row.doc_id", "dedup.n_lines", "dedup.n_dropped", sha256_text(out["dedup.kept_text"]).alias("kept_sha256"))


ORACLES["op9_line_dedup"] = r"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT row, doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM texts),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT k.*, coalesce(k.doc_id < o.last, false) AS dropped FROM keyed k LEFT JOIN often o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


ORACLES["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
"""


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.SubstringDedup(documents(spark, sf_dir), window=35).digests().drop("spans")


ORACLES["op11_substring_dedup"] = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, first, array_to_string(words[first:first + 34], ' ') AS sequence
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS first FROM split)
),
often AS (SELECT sequence FROM windows GROUP BY sequence HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, first + 35)) AS pos FROM windows WHERE sequence IN (SELECT sequence FROM often)
),
every AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split),
kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY e.pos) AS text
  FROM every e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id
)
SELECT s.doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


ORACLES["op12_ranked_search"] = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
posting AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
total AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM found),
doc AS (SELECT doc_id, 10 + (90 * count(*) * (SELECT n_docs FROM total)) // (SELECT n_terms FROM total) AS m FROM found GROUP BY doc_id),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT n_docs FROM total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting WHERE term IN (SELECT term FROM items) GROUP BY term
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN weight USING (term) JOIN posting USING (term) JOIN doc USING (doc_id) GROUP BY item_id, doc_id
),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir)))
