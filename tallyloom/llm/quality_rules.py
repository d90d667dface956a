"""Quality rules whose cutoffs are chosen so that few good documents are rejected.

Every text is measured by Spark SQL functions alone. Fixed base rules reject first. For the other rules
a labelled holdout picks the cutoffs: per stratum (language) and rule, each cutoff of a fixed grid is
tested by the exact binomial tail. A cutoff is admissible if, were its share of rejected good documents
above ``max_false_rejection / rules``, so few rejections would be seen with a probability below
``error / (strata * rules * cutoffs)`` (Bonferroni). So with probability ``1 - error``, all strata lose at
most ``max_false_rejection`` of their good documents. Of the admissible cutoffs, the one that catches most
bad documents, good ones subtracted, is taken; none, if none catches more bad than good ones.

Defined results: a null text has no words and fails the base rules; a null language is a stratum of its
own; labels other than 0 and 1 and labels without document count for nothing; a document labelled twice, or one
of several with the same text, counts as bad if any label says so, and its text as one trial; documents without an id are
measured and judged, but have no label. Equal rows give equal results, texts of any length are measured whole; of equally
good cutoffs the largest is taken; columns besides doc_id, text and lang are passed on or left out, not read. An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACE_CHARS, let, lines_with_words, stored, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: rule -> (numerator, denominator, cutoffs in thousandths); a document fails above the cutoff.
RULES = {
    "symbols": ("n_symbols", "word_chars", (10, 20, 50, 100, 200)),
    "dup_lines": ("n_dup_lines", "n_lines", (100, 200, 300, 500)),
    "repeat_words": ("n_repeat_words", "n_words", (20, 50, 100, 200)),
    "long_words": ("word_chars", "n_words", (8000, 10000, 12000, 15000)),
    "short_words": ("n_words", "word_chars", (250, 333, 400, 500)),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Risk:
    max_false_rejection: float = 0.05
    error: float = 0.05


def _repeated_words(words: Column, width: int) -> Column:
    """Words inside windows of ``width`` words that occur at least twice in the array."""

    def covered(pairs: Column) -> Column:
        same = lambda p, q: F.coalesce(p["h"] == q["h"], F.lit(False))
        starts = F.transform(
            F.filter(pairs, lambda p, k: same(p, F.get(pairs, k - 1)) | same(p, F.get(pairs, k + 1))), lambda p: p["i"]
        )
        # every start adds what the next start does not cover as well
        return let(F.sort_array(starts), lambda s: F.aggregate(
            F.transform(s, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(s, k + 1) - p, F.lit(width)))),
            F.lit(0), lambda total, n: total + n,
        ))

    def of_windows(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(pairs, covered))

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(width))),
        )
        return F.when(F.size(hashes) <= width, 0).otherwise(let(windows, of_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``measures``, a struct of longs by ``MEASURES``; whole texts, no shuffle."""
    whole = text_or_empty(text)
    bare = F.translate(whole, SPACE_CHARS, "")
    from_words = let(words_of(whole), lambda words: F.struct(
        F.size(words).cast("long").alias("n"), _repeated_words(words, WINDOW).cast("long").alias("repeated")
    ))
    from_lines = let(lines_with_words(whole), lambda lines: F.struct(
        F.size(lines).cast("long").alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup")
    ))
    parts = docs.withColumns({
        "measures": F.struct(
            from_words.alias("w"),
            from_lines.alias("l"),
            F.length(bare).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        )
    })
    m = F.col("measures")
    return parts.withColumn("measures", F.struct(
        m["w"]["n"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["l"]["n"].alias("n_lines"), m["l"]["dup"].alias("n_dup_lines"), m["w"]["repeated"].alias("n_repeat_words"),
    ))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def fails(m: Column, rule: str, cutoff: Column) -> Column:
    over, under, _ = RULES[rule]
    return 1000 * m[over] > cutoff * m[under]


def binomial_tail(seen: Column, trials: Column, share: float) -> Column:
    """P(X <= seen) for X binomial with ``trials`` and ``share``; 1 if ``seen`` is above the mean."""
    odds = F.lit(share / (1 - share))

    def step(state: Column, i: Column) -> Column:
        term = state["t"] + F.log(odds * (trials - i + 1) / i)
        return F.struct(term.alias("t"), (state["p"] + F.exp(term)).alias("p"))

    first = trials * F.log(F.lit(1 - share))
    start = F.struct(first.cast("double").alias("t"), F.exp(first).cast("double").alias("p"))
    terms = F.when(seen >= 1, F.sequence(F.lit(1).cast("long"), seen)).otherwise(F.array().cast("array<bigint>"))
    return F.when(seen > trials * share, F.lit(1.0)).otherwise(F.aggregate(terms, start, step)["p"])


def cutoffs(measures: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Chosen cutoffs: stratum -> map of rule to cutoff (thousandths).

    ``measures``: doc_id, stratum, text_hash, measures. ``labels``: doc_id, quality. A text is one trial of its stratum,
    however many documents have it, as copies are no independent trials; it is good if no label of it says otherwise.
    Counts are taken per stratum before anything is compared, so the test works on a few rows per stratum, however many
    labels exist.
    """
    judged = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("_good"))
    )
    grid = [(rule, cut) for rule, (_, _, cuts) in RULES.items() for cut in cuts]
    good = F.col("_good") == 1
    m = F.col("measures")
    holdout = measures.join(judged, "doc_id").groupBy("stratum", "text_hash").agg(
        F.min("_good").alias("_good"), F.first("measures").alias("measures")).where(~base_failed(m))
    counts = holdout.groupBy("stratum").agg(
        F.count_if(good).alias("n_good"),
        *(F.count_if(fails(m, r, F.lit(c)) & good).alias(f"g_{r}_{c}") for r, c in grid),
        *(F.count_if(fails(m, r, F.lit(c)) & ~good).alias(f"b_{r}_{c}") for r, c in grid),
    )
    strata = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # one row per stratum
    tests = counts.withColumn("_strata", strata).select(
        "stratum", "n_good", "_strata",
        F.inline(F.array(*(
            F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"),
                     F.col(f"g_{r}_{c}").alias("good_lost"), F.col(f"b_{r}_{c}").alias("bad_caught"))
            for r, c in grid
        ))),
    )
    tail = binomial_tail(F.col("good_lost"), F.col("n_good"), risk.max_false_rejection / len(RULES))
    admissible = tests.where(tail * F.col("_strata") * len(grid) <= risk.error).where("bad_caught > good_lost")
    best = admissible.groupBy("stratum", "rule").agg(
        F.max_by("cutoff", F.struct(F.col("bad_caught") - F.col("good_lost"), F.col("cutoff"))).alias("cutoff")
    )
    return best.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")  # one entry per rule
    )


def _text_hash() -> Column:
    return F.unhex(F.md5(text_or_empty()))


def stratum_of(lang: str = "lang") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit(""))


def verdict(m: Column, chosen: Column) -> Column:
    """True if no base rule and no chosen cutoff rejects the document."""
    over = [F.coalesce(fails(m, r, F.element_at(chosen, r)), F.lit(False)) for r in RULES]
    failed = base_failed(m)
    for one in over:
        failed = failed | one
    return ~failed


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, the measures, base_failed, kept.

    Texts are read once; their measures are stored in the shared folder, then judged.
    """
    rows = measured(docs.select("doc_id", stratum_of().alias("stratum"), "text")).withColumn("text_hash", _text_hash()).drop("text")
    rows = stored(rows, "measures")
    chosen = cutoffs(rows, labels.select("doc_id", "quality"), risk)
    m = F.col("measures")
    return rows.join(chosen, "stratum", "left").select(
        "doc_id", *(m[name].alias(name) for name in MEASURES),
        base_failed(m).alias("base_failed"), verdict(m, F.col("cutoffs")).alias("kept"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. Rows are stored with their measures, so texts are measured
    once and not shuffled."""
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id"), stratum_of().alias("stratum"), F.col("text"))
    rows = stored(measured(keyed).withColumn("text_hash", _text_hash()).drop("text"), "measured-rows")
    chosen = stored(cutoffs(rows.drop("row"), labels.select("doc_id", "quality"), risk), "cutoffs")
    judged = rows.join(chosen, "stratum", "left")
    return judged.where(verdict(F.col("measures"), F.col("cutoffs"))).select("row.*")
