"""Quality rules with thresholds that adapt to each language and source.

Only DataFrame functions. One pass over the texts measures them; the measures are stored.
The values of each measure are gathered in quantile sketches, one for each pair of
language and source: counts by bucket, where a bucket holds numbers that agree in their
six leading binary digits (a relative error of 1/32). Sketches merge by adding counts, so
those of a language and of all texts are sums of these. Each pair's sketch is merged with
``PARENT_TEXTS`` texts spread as those of its language, whose sketch is merged with as
many spread as all texts: a pair of few texts is judged as its language, and its own
texts weigh more with each that is added. A text fails where it lies beyond the quartiles
of its pair by more than ``SPREADS`` times their distance plus the measure's slack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import stored

BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
PARENT_TEXTS = 100
SPREADS = 3
# Measures (whole numbers), and by how much each may pass its quartiles
# whatever their distance. Shares are in thousandths.
SLACK = {
    "mean_word": 1500,  # letters a word
    "symbol_share": 100,  # symbols a word
    "dup_line_share": 350,  # lines that repeat one, of all with a word
    "repeat_share": 150,  # words in repeated windows, of all
}
TWO_SIDED = ("mean_word",)

# Each inner array is bound to a name by a transform over an array that holds only it,
# so that it is computed once however often the steps refer to it.
_REPEATED = """
    transform(array(words), w -> if(size(w) < 3, 0L,
      transform(array(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))), g ->
        if(size(array_distinct(g)) = size(g), 0L,
          transform(array(sort_array(transform(g, (h, i) -> struct(h AS h, i AS i)))), s ->
            transform(array(sort_array(transform(
                filter(s, (x, k) -> coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false)),
                x -> x.i))), p ->
              aggregate(transform(p, (q, k) -> least(3, coalesce(get(p, k + 1) - q, 3))), 0L, (a, n) -> a + n)
            )[0])[0]))[0]))[0]
"""


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang, source) and the counts of each text; NULL counts as empty.

    Windows of three words are compared by a 64-bit hash within their text.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANK, "") != "")
    return (
        docs.select(F.col(id_column).alias("id"), "lang", "source", text.alias("text"), split.alias("words"), lines.alias("lines"))
        .select(
            "id",
            "lang",
            "source",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.translate("text", BLANK, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.expr(_REPEATED).alias("n_repeat_words"),
        )
    )


def _measures(counts: DataFrame) -> DataFrame:
    share = lambda part, whole: f"CAST({part} * 1000 DIV greatest({whole}, 1) AS BIGINT)"
    return counts.selectExpr(
        "*",
        f"{share('word_chars', 'n_words')} AS mean_word",
        f"{share('n_symbols', 'n_words')} AS symbol_share",
        f"{share('n_dup_lines', 'n_lines')} AS dup_line_share",
        f"{share('n_repeat_words', 'n_words')} AS repeat_share",
    )


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): mergeable quantile sketches.

    ``bucket`` is the least number of its bucket.
    """
    columns = ", ".join(f"'{name}', {name}" for name in SLACK)
    long = measures.selectExpr("lang", "source", f"stack({len(SLACK)}, {columns}) AS (measure, value)")
    shift = "greatest(length(bin(value)) - 6, 0)"
    return (
        long.selectExpr("lang", "source", "measure", f"shiftleft(shiftright(value, {shift}), {shift}) AS bucket")
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _shares(sketch: DataFrame, parent: DataFrame | None, *by: str) -> DataFrame:
    """(by, measure, bucket, share): share of the texts up to each bucket, merged with the parent's.

    Every bucket of the parent is given, also those that the group has no text in.
    """
    own = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    upto, texts = F.sum("n").over(group.orderBy("bucket")), F.sum("n").over(group)
    if parent is None:
        return own.select("measure", "bucket", (upto / texts).alias("share"))
    of = parent.withColumnsRenamed({name: f"of_{name}" for name in (*by[:-1], "measure")})
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in (*by[:-1], "measure")]
    grid = own.select(*by, "measure").distinct().join(of, same)
    both = grid.select(*by, "measure", "bucket", F.lit(0).alias("n"), "share").union(
        own.select(*by, "measure", "bucket", "n", F.lit(None))
    )
    filled = both.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"), F.max("share").alias("share"))
    share = (upto + PARENT_TEXTS * F.col("share")) / (texts + PARENT_TEXTS)
    return filled.select(*by, "measure", "bucket", share.alias("share"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source) with ``<measure>_low`` and ``<measure>_high``."""
    # A measure has at most 32 buckets for each of 63 lengths, so that this is a table of some thousand rows at any size.
    root = F.broadcast(_shares(sketch, None))
    shares = _shares(sketch, _shares(sketch, root, "lang"), "lang", "source")
    rows = shares.groupBy("lang", "source", "measure").agg(
        *[F.min(F.when(F.col("share") * 4 >= k, F.col("bucket"))).alias(f"q{k}") for k in (1, 3)]
    )
    reach = F.col("q3") - F.col("q1")
    picks = []
    for name, slack in SLACK.items():
        of = lambda value, name=name: F.max(F.when(F.col("measure") == name, value))
        picks.append(of(F.col("q3") + SPREADS * reach + slack).alias(f"{name}_high"))
        if name in TWO_SIDED:
            picks.append(of(F.col("q1") - SPREADS * reach - slack).alias(f"{name}_low"))
    return rows.groupBy("lang", "source").agg(*picks)


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, measures and verdict of each text: ``base_failed``, ``failed_rules``, ``kept``.

    NULL and empty texts have no words and fail the base rule. NULL languages and sources
    are groups of their own. Rows that repeat count as often as they occur. An empty
    table gives an empty result.
    """
    counts = stored(measured(docs, id_column, text_column), "measures")
    measures = _measures(counts)
    limits = thresholds(sketches(measures)).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = measures.join(
        limits, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left"
    )
    rules = [F.when(F.col(name) > F.col(f"{name}_high"), F.lit(f"{name}_high")) for name in SLACK]
    rules += [F.when(F.col(name) < F.col(f"{name}_low"), F.lit(f"{name}_low")) for name in TWO_SIDED]
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return joined.select(
        F.col("id").alias(id_column),
        "lang",
        "source",
        *["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", *SLACK],
        base.alias("base_failed"),
        F.array_compact(F.array(*rules)).alias("failed_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
