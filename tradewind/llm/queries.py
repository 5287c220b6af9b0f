"""The registered queries of the operators: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import (
    bpe, codes, decontaminate, language, linededup, lm, pii, quality, resampling, secrets, sharding,
    simhash, substrings,
)
from tradewind.llm.frames import ship, table

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
RANKS = "byte_bpe_50k.tiktoken"


def query(job):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return job(spark, folder)

    JOBS[job.__name__] = run
    return run


@query
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as vocabularies

    return bpe.digests(table(spark, folder, "documents"), vocabularies.path(RANKS),
                       vocabularies.PATTERN)


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.report(table(spark, folder, "documents"))


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


@query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@query
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.report(table(spark, folder, "documents"), 40)


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"),
                                 table(spark, folder, "benchmark"))


@query
def op8_linededup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.report(table(spark, folder, "documents"))


@query
def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.report(table(spark, folder, "documents"))


@query
def op9_lm(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as vocabularies

    return lm.scores(table(spark, folder, "documents"), vocabularies.path(RANKS),
                     vocabularies.PATTERN)


@query
def op11_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.report(table(spark, folder, "embeddings"))


@query
def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.report(table(spark, folder, "documents"))


# Shingles of every document against those of every item, without a sketch.
SQL["op7_decontaminate"] = r"""
    WITH d AS (SELECT row_number() OVER () AS d_no, doc_id,
            regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
        b AS (SELECT *, least(5, len(w)) AS k FROM (SELECT row_number() OVER () AS b_no, item_id,
            regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark) x
            WHERE len(w) > 0),
        bs AS (SELECT DISTINCT b_no, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b) x),
        ds AS (SELECT DISTINCT d_no, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
                  FROM d, (SELECT DISTINCT k FROM b) y) x),
        n AS (SELECT b_no, count(*) AS n FROM bs GROUP BY 1),
        m AS (SELECT b_no, d_no, count(*) AS c FROM bs JOIN ds USING (k, s) GROUP BY 1, 2)
    SELECT doc_id, item_id, n AS n_shingles, c AS n_shared, c / n AS containment
    FROM m JOIN n USING (b_no) JOIN b USING (b_no) JOIN d USING (d_no) WHERE c >= 0.8 * n - 1e-9"""


def _assigned(books: str) -> str:
    return f"""SELECT n, p, min({{'d': (list_sum(list_transform(list_zip(parts.q, b.q),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))))::BIGINT, 'e': e}}) AS m
        FROM parts JOIN {books} b USING (p) GROUP BY n, p"""


def _moved(books: str, assigned: str) -> str:
    return f"""SELECT p, e, coalesce(c.q, b.q) AS q FROM {books} b LEFT JOIN (
            SELECT p, e, list(s ORDER BY i) AS q FROM (
                SELECT p, m.e AS e, i, floor(sum(q[i])::DOUBLE / count(*))::BIGINT AS s
                FROM (SELECT p, m, q, unnest(range(1, len(q) + 1)) AS i
                      FROM {assigned} JOIN parts USING (n, p)) x GROUP BY 1, 2, 3) y
            GROUP BY 1, 2) c USING (p, e)"""


# Every part against every entry, without a tree.
SQL["op11_codes"] = f"""
    WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, vec_id, label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT n, p, v[p * w + 1:p * w + w] AS q
            FROM (SELECT *, len(v) // 16 AS w, unnest(range(16)) AS p FROM kept) x),
        b0 AS (SELECT p, n - 1 AS e, q FROM parts WHERE n <= 64),
        a1 AS ({_assigned("b0")}), b1 AS ({_moved("b0", "a1")}),
        a2 AS ({_assigned("b1")}), b2 AS ({_moved("b1", "a2")}), a3 AS ({_assigned("b2")}),
        r AS (SELECT n, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code,
            sum(m.d)::BIGINT AS error FROM a3 GROUP BY n),
        h AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
            FROM (SELECT p, e, generate_subscripts(q, 1) AS i, unnest(q) AS c FROM b2) x)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        codebooks_sha256 FROM kept JOIN r USING (n), h"""
