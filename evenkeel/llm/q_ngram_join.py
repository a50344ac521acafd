"""Query of the n-gram Jaccard join."""

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.ngram_join import ngram_join


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir))


_UPPER = "".join(map(chr, range(65, 91)))

# Sets that share a shingle are compared by their sorted lists; reach holds all pairs of a component.
ORACLE = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(
            regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'),
            lambda w: w <> '') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, list_sort(list_distinct(
            CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
        FROM words
    ), named AS (
        SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN sha256(array_to_string(s, chr(10))) END AS c, s FROM sets
    ), classes AS (
        SELECT c, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS least, count(*) AS copies
        FROM named WHERE c IS NOT NULL GROUP BY c
    ), tokens AS (
        SELECT c, n, unnest(s) AS t FROM classes
    ), links AS (
        SELECT a.c AS x, b.c AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.c <> b.c
        GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT c AS x, c AS y FROM classes
        UNION
        SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
    ), told AS (
        SELECT x, min(least) AS component_id FROM reach JOIN classes ON reach.y = classes.c GROUP BY x
    ), linked AS (
        SELECT x, count(*) AS n FROM links GROUP BY x
    )
    SELECT named.doc_id, named.n AS n_shingles, coalesce(component_id, named.doc_id) AS component_id,
           coalesce(copies, 1) AS n_copies, coalesce(linked.n, 0) AS n_links
    FROM named LEFT JOIN classes ON named.c = classes.c LEFT JOIN told ON named.c = told.x
         LEFT JOIN linked ON named.c = linked.x
"""
