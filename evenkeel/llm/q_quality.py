"""Query and SQL of the quality rules."""

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.quality import PARENT_TEXTS, SLACK, SPREADS, TWO_SIDED, quality

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select("doc_id", *COLUMNS)


def _oracle() -> str:
    share = lambda part, whole: f"{part} * 1000 // greatest({whole}, 1)"
    pivot = ", ".join(
        f"max(CASE WHEN measure = '{name}' THEN q3 + {SPREADS} * (q3 - q1) + {slack} END) AS {name}_high, "
        f"max(CASE WHEN measure = '{name}' THEN q1 - {SPREADS} * (q3 - q1) - {slack} END) AS {name}_low"
        for name, slack in SLACK.items()
    )
    long = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS measure, {name} AS value FROM measures" for name in SLACK)

    def shares(parent: str, *by: str) -> str:
        names = "".join(f"{name}, " for name in by)
        same = " AND ".join(f"g.{name} IS NOT DISTINCT FROM o.{name}" for name in (*by[:-1], "measure"))
        return f"""
            SELECT {names}measure, bucket, (sum(n) OVER (PARTITION BY {names}measure ORDER BY bucket)::DOUBLE + {PARENT_TEXTS} * share)
                   / (sum(n) OVER (PARTITION BY {names}measure) + {PARENT_TEXTS})::DOUBLE AS share
            FROM (SELECT {names}measure, bucket, sum(n) AS n, max(share) AS share
                  FROM (SELECT {names}measure, bucket, 1 AS n, NULL AS share FROM buckets
                        UNION ALL
                        SELECT {"".join(f"g.{name}, " for name in by)}g.measure, o.bucket, 0, o.share
                        FROM (SELECT DISTINCT {names}measure FROM buckets) g JOIN {parent} o ON {same})
                  GROUP BY {names}measure, bucket)"""

    fails = " OR ".join(
        [f"{name} > {name}_high" for name in SLACK] + [f"{name} < {name}_low" for name in TWO_SIDED]
    )
    blank = "[\\x20\\x09-\\x0D]+"
    return f"""
        WITH docs AS (
            SELECT doc_id, lang, source, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '{blank}'), lambda w: w <> '') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_replace(l, '{blank}', '', 'g') <> '') AS lines
            FROM documents
        ), grams AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs WHERE len(words) >= 3)
        ), repeats AS (
            SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS pos FROM grams WHERE n > 1)
            GROUP BY doc_id
        ), counts AS (
            SELECT docs.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
                   length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words
            FROM docs LEFT JOIN repeats ON docs.doc_id = repeats.doc_id
        ), measures AS (
            SELECT *, {share("word_chars", "n_words")} AS mean_word, {share("n_symbols", "n_words")} AS symbol_share,
                   {share("n_dup_lines", "n_lines")} AS dup_line_share, {share("n_repeat_words", "n_words")} AS repeat_share
            FROM counts
        ), buckets AS (
            SELECT lang, source, measure, value - value % (1 << greatest(length(bin(value)) - 6, 0)) AS bucket FROM ({long})
        ), of_all AS (
            SELECT measure, bucket, (sum(n) OVER (PARTITION BY measure ORDER BY bucket))::DOUBLE
                   / (sum(n) OVER (PARTITION BY measure))::DOUBLE AS share
            FROM (SELECT measure, bucket, count(*) AS n FROM buckets GROUP BY measure, bucket)
        ), of_lang AS ({shares("of_all", "lang")}
        ), of_pair AS ({shares("of_lang", "lang", "source")}
        ), limits AS (
            SELECT lang, source, {pivot} FROM (
                SELECT lang, source, measure, min(bucket) FILTER (share * 4 >= 1) AS q1, min(bucket) FILTER (share * 4 >= 3) AS q3
                FROM of_pair GROUP BY lang, source, measure)
            GROUP BY lang, source
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {fails} AS fails
            FROM measures JOIN limits ON measures.lang IS NOT DISTINCT FROM limits.lang
                AND measures.source IS NOT DISTINCT FROM limits.source
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT fails AS kept
        FROM judged
    """


ORACLE = _oracle()
