"""Query and SQL of the URL filter."""

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.host_reputation import LIMIT, LONG_SUFFIXES, SPREADS, STRONGEST, WEAKEST, judge_urls

# The rules of the contract.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, bad): pages are labelled by the row of ``labels`` with their id; toxic or of low quality is bad."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.selectExpr("doc_id AS id", "CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality = 1 AND toxic = 0 THEN 0 END AS bad")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = judge_urls(pages, page_labels(spark, sf_dir), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    case = lambda pick: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{pick(v, h, p)}'" for v, h, p in ordered) + " END"
    long = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)
    last = lambda n: f"array_to_string(list_slice(string_split(name, '.'), greatest(len(string_split(name, '.')) - {n - 1}, 1), len(string_split(name, '.'))), '.')"

    def level(of: str, name: str) -> str:
        z = "(bad - labelled * above) * (bad - labelled * above) / (labelled * above * (1 - above))"
        return f"""{name}_prior AS (
            SELECT CASE WHEN rho > 1 / (most + 1) THEN greatest({WEAKEST}::DOUBLE, 1 / rho - 1) ELSE most END AS held
            FROM (SELECT least({STRONGEST}::DOUBLE, sum(labelled) + 2) AS most FROM known), (SELECT sum(CAST(round(({z} - 1) * 1e6) AS BIGINT))::DOUBLE / 1e6 / sum(labelled - 1) AS rho
                  FROM {of} WHERE labelled > 1)
        )"""

    return f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), hosted AS (
            SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
        ), parts AS (
            SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM hosted
        ), told AS (
            SELECT doc_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS k
            FROM labels WHERE quality = 0 OR toxic = 1 OR (quality = 1 AND toxic = 0) GROUP BY doc_id
        ), counted AS (
            SELECT host, CAST(coalesce(sum(n), 0) AS BIGINT) AS labelled, CAST(coalesce(sum(k), 0) AS BIGINT) AS bad
            FROM parts LEFT JOIN told ON page_id = doc_id GROUP BY host
        ), named AS (
            SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\\.$', '') AS name FROM counted
        ), known AS (
            SELECT host, labelled, bad,
                   CASE WHEN address THEN name WHEN long THEN two ELSE one END AS suffix,
                   CASE WHEN address THEN name WHEN long THEN three ELSE two END AS domain
            FROM (SELECT *, regexp_matches(name, '^[0-9.]+$|^\\[') AS address, {last(1)} AS one, {last(2)} AS two, {last(3)} AS three,
                         {last(2)} IN ({long}) AS long FROM named)
        ), by_suffix AS (
            SELECT suffix, CAST(sum(labelled) AS BIGINT) AS labelled, CAST(sum(bad) AS BIGINT) AS bad,
                   (SELECT (sum(bad) + 1)::DOUBLE / (sum(labelled) + 2) FROM known) AS above
            FROM known GROUP BY suffix
        ), {level("by_suffix", "suffix")}, suffixes AS (
            SELECT suffix, (held * above + bad) / (held + labelled) AS above FROM by_suffix, suffix_prior
        ), by_domain AS (
            SELECT k.domain, k.suffix, CAST(sum(labelled) AS BIGINT) AS labelled, CAST(sum(bad) AS BIGINT) AS bad, any_value(above) AS above
            FROM known k JOIN suffixes s ON k.suffix = s.suffix GROUP BY k.domain, k.suffix
        ), {level("by_domain", "domain")}, domains AS (
            SELECT domain, suffix, (held * above + bad) / (held + labelled) AS above FROM by_domain, domain_prior
        ), by_host AS (
            SELECT host, labelled, bad, above FROM known k JOIN domains d ON k.domain = d.domain AND k.suffix = d.suffix
        ), {level("by_host", "host")}, posterior AS (
            SELECT host, held * above + bad AS a, held * (1 - above) + (labelled - bad) AS b FROM by_host, host_prior
        ), bounds AS (
            SELECT host, a / (a + b) - {SPREADS}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior
        )
        SELECT page_id, host, path, {case(lambda v, h, p: h + p)} AS rule,
               coalesce({case(lambda v, h, p: v)}, CASE WHEN bound > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts JOIN bounds USING (host)
    """


ORACLE = _oracle()
