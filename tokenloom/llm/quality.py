"""Quality rules whose cutoffs are chosen under a proven risk of rejecting good texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACE_CHARS, SPACE_CLASS, let, stored

WINDOW = 8  # Fixed value: words of a repeated passage.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30  # Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"  # Fixed value.

# The method's parameters. A rule rejects a text whose rate, per thousand, is above its cutoff.
RULES = ("symbols", "dup_lines", "repeats")
CUTOFFS = (5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500)
RISK = 0.02  # most good texts a rule may reject, as a share of its stratum
DELTA = 0.05  # chance that any chosen cutoff breaks that promise


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that the text holds twice or more."""

    def covered(windows: Column, all_words: Column) -> Column:
        numbered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(pairs: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                one = F.slice(all_words, a["i"] + 1, F.lit(WINDOW))
                return (a["h"] == b["h"]) & (one == F.slice(all_words, b["i"] + 1, F.lit(WINDOW)))

            def twice(p: Column, k: Column) -> Column:
                left = F.when(k > 0, same(p, F.get(pairs, k - 1)))
                right = F.when(k < F.size(pairs) - 1, same(p, F.get(pairs, k + 1)))
                return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

            return F.array_sort(F.transform(F.filter(pairs, twice), lambda p: p["i"]))

        begin = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            let(numbered, again),
            begin,
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
        repeated = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h, w)).otherwise(0)
        return F.when(F.size(w) < WINDOW, 0).otherwise(let(windows, repeated))

    return let(words, hashed)


def measures(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its ``doc_id``, ``lang`` and the counts the rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    counts = docs.select(
        "doc_id",
        "lang",
        let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("_w"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        F.size(lines).cast("bigint").alias("n_lines"),
    )
    return counts.select(
        "doc_id",
        "lang",
        F.col("_w.n").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("_w.r").cast("bigint").alias("n_repeat_words"),
        "n_lines",
    )


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function: Stirling's series, moved to arguments above 8."""
    up = F.when(x < 8, x + 8).otherwise(x)
    series = (
        (up - 0.5) * F.log(up)
        - up
        + 0.918938533204672741780329736406
        + 1 / (12 * up)
        - 1 / (360 * F.pow(up, 3))
        + 1 / (1260 * F.pow(up, 5))
        - 1 / (1680 * F.pow(up, 7))
    )
    down = F.log(x)
    for step in range(1, 8):
        down = down + F.log(x + step)
    return F.when(x < 8, series - down).otherwise(series)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """Exact P(X <= k) of a binomial X, for k <= n * p; 1 above, where no bound can be met.

    Terms are added downwards from k, each from the one before. Those more than 60 standard
    deviations below k are under 1e-300 of the first, so leaving them out changes no digit.
    """
    first = (
        _log_gamma(n + 1.0)
        - _log_gamma(k + 1.0)
        - _log_gamma(n - k + 1.0)
        + k * F.log(F.lit(p))
        + (n - k) * F.log(F.lit(1 - p))
    )
    terms = F.sequence(F.lit(0), F.least(k, F.ceil(60 * F.sqrt(n)) + 60).cast("int"))
    begin = F.struct(first.alias("t"), F.lit(0.0).alias("s"))
    total = F.aggregate(
        terms,
        begin,
        lambda acc, i: F.struct(
            (acc["t"] + F.log(F.greatest(k - i, F.lit(1e-300)) / (n - k + i + 1) * ((1 - p) / p))).alias("t"),
            (acc["s"] + F.exp(acc["t"])).alias("s"),
        ),
        lambda acc: F.least(acc["s"], F.lit(1.0)),
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(total)


def rates() -> dict[str, Column]:
    """A rule's rate, in thousandths, of a row of :func:`measures`."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.floor(F.col(part) * 1000 / F.col(whole))).otherwise(0).cast("bigint")

    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def base_failed() -> Column:
    short = F.col("n_words") < MIN_WORDS
    return short | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def chosen_cutoffs(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``(stratum, rule, cutoff, good, rejected, p_value)``: the lowest cutoff proven safe.

    For each language, rule and cutoff the holdout are the documents labelled good (quality 1)
    that pass the base rules. That more than ``RISK`` of the good texts are above the cutoff is refuted if the exact
    binomial probability of so few rejections is at most ``DELTA`` over the number of all tests
    (strata times rules times cutoffs), so all choices hold together. No safe cutoff: no row,
    and the rule rejects nothing there. Only counts per stratum, rule and cutoff are shuffled.
    """
    good = labels.filter("quality = 1").select("doc_id").distinct()
    held = measured.filter(~base_failed()).join(good, "doc_id", "left_semi")
    values = [F.struct(F.lit(n).alias("rule"), r.alias("rate")) for n, r in rates().items()]
    rated = held.select(F.col("lang").alias("stratum"), F.explode(F.array(*values)).alias("v"))
    above = [F.count_if(F.col("v.rate") > c).alias(f"c{c}") for c in CUTOFFS]
    counts = rated.groupBy("stratum", F.col("v.rule").alias("rule")).agg(F.count("*").alias("good"), *above)
    everything = Window.partitionBy(F.lit(0))  # one row per stratum and rule
    tests = counts.withColumn("tests", F.count("*").over(everything) * len(CUTOFFS))
    each = tests.select(
        "stratum", "rule", "good", "tests",
        F.explode(F.array(*[F.struct(F.lit(c).alias("cutoff"), F.col(f"c{c}").alias("k")) for c in CUTOFFS])).alias("t"),
    ).select("stratum", "rule", "good", "tests", "t.cutoff", F.col("t.k").alias("rejected"))
    k, n = F.col("rejected").cast("double"), F.col("good").cast("double")
    proven = each.withColumn("p_value", binomial_cdf(k, n, RISK)).filter(F.col("p_value") <= DELTA / F.col("tests"))
    return proven.groupBy("stratum", "rule").agg(
        F.min("cutoff").alias("cutoff"),
        F.min_by("good", "cutoff").alias("good"),
        F.min_by("rejected", "cutoff").alias("rejected"),
        F.min_by("p_value", "cutoff").alias("p_value"),
    )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict per document.

    Null texts count as empty and fail the base rules; a null language is a stratum of its own;
    repeated rows are judged each; extra columns are ignored; without labels no cutoff is proven,
    and only the base rules reject.
    """
    measured = stored(measures(docs), "quality")
    cutoffs = chosen_cutoffs(measured, labels)
    wide = cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES]
    )
    rows = measured.alias("m").join(wide.alias("c"), F.expr("m.lang <=> c.stratum"), "left")
    rejected = F.lit(False)
    for name, rate in rates().items():
        rejected = rejected | F.coalesce(rate > F.col(f"max_{name}"), F.lit(False))
    base = base_failed()
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~rejected).alias("kept"),
    )


def _sql() -> str:
    """The same in SQL; probabilities are summed from the first term on."""
    rules = {
        "symbols": ("n_symbols", "word_chars"),
        "dup_lines": ("n_dup_lines", "n_lines"),
        "repeats": ("n_repeat_words", "n_words"),
    }
    rate = {n: f"CASE WHEN {w} > 0 THEN {p} * 1000 // {w} ELSE 0 END" for n, (p, w) in rules.items()}
    rated = " UNION ALL ".join(f"SELECT lang, '{n}' AS rule, {r} AS rate FROM held" for n, r in rate.items())
    limits = ", ".join(f"max(cutoff) FILTER (rule = '{n}') AS max_{n}" for n in rules)
    above = " OR ".join(f"coalesce({r} > max_{n}, false)" for n, r in rate.items())
    last = WINDOW - 1
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, array_to_string(w[i:i + {last}], ' ') AS g FROM (SELECT rid, w, unnest(range(1, (len(w) - {last - 1})::BIGINT)) AS i FROM w)),
again AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range({WINDOW}) AS t(k) GROUP BY rid),
m AS (
  SELECT rid, doc_id, lang, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
held AS (SELECT * FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
rated AS ({rated}),
counts AS (
  SELECT lang, rule, cutoff, count(*) AS n, count(*) FILTER (rate > cutoff) AS k
  FROM rated, (SELECT unnest({list(CUTOFFS)}) AS cutoff) GROUP BY ALL),
tested AS (
  SELECT *, count(*) OVER () AS tests, CASE WHEN k > n * {RISK} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) END AS p FROM counts),
chosen AS (SELECT lang, rule, min(cutoff) AS cutoff FROM tested WHERE p <= {DELTA} / tests GROUP BY ALL),
wide AS (SELECT lang, {limits} FROM chosen GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({above}) AS kept
FROM b LEFT JOIN wide ON b.lang IS NOT DISTINCT FROM wide.lang"""


SQL = _sql()
