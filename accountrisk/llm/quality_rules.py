"""Quality rules with thresholds that adapt to each language and source.

Per document a few shares are measured with built-in functions only. Mergeable KLL sketches hold their
distributions for each (language, source) and for each language. With SPREAD = max(q75 - q25, (q90 - q10) / 2) of
a group its fences are

    high = max(q75 + FENCE * SPREAD, HABIT * p25) + TIE
    low  = q25 - FENCE * SPREAD - TIE, for the word length only: few symbols or repeats are no fault

where p25 is the lower quartile of the values above 0, from a sketch of their own, and counts only if q25 is 0 and
``COMMON`` of the group's rows are above 0: of a share that is 0 in most documents all plain quantiles may be 0, and
what the others usually have says how much is usual. It stays with the usual values while up to three quarters of those above 0 are
junk. A group of fewer than ``MIN_ROWS`` rows that pass the base uses its language's fences. Documents are joined with
their group's fences; one outside them is not kept.

Sketches are partial aggregates: rows are summed up inside each task, so a group with a third of all rows
shuffles one sketch a task, and the fences are a table of one row a group.

Cases: null, empty and blank texts have no words and fail the base. Null languages and sources are groups of their
own. Repeated rows count as often as they stand. An extra column with the name of a result column is replaced. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.session import written

WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"
FENCE = 3.0
HABIT, COMMON = 2.0, 0.02
TIE = 0.02
MIN_ROWS = 200
SKETCH_K = 400
SHARES = ["symbol_share", "dup_line_share", "repeat_share", "word_length"]
LOW = ["word_length"]
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *SHARES]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def joined(left: str, shift: int, left_size: Column) -> Column:
    """Hashes of each item with the one ``shift`` places on."""
    n = left_size - shift
    return F.zip_with(F.slice(left, 1, n), F.slice(left, shift + 1, n), lambda x, y: F.xxhash64(x, y))


def some_twice(items: str) -> Column:
    return F.size(items) > F.size(F.array_distinct(items))


def repeated_places(hashes: str) -> Column:
    """Hash and place of all windows in hash order, for texts where some hash stands twice; else null."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(some_twice(hashes), ordered)


def repeat_words(ordered: str) -> Column:
    """Words under the windows whose hash stands twice or more."""
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    before = F.concat(none, F.slice(ordered, 1, F.size(ordered) - 1))
    after = F.concat(F.slice(ordered, 2, F.size(ordered) - 1), none)
    joined = F.arrays_zip(F.col(ordered).alias("x"), before.alias("p"), after.alias("q"))
    # equal hashes stand next to each other
    twice = F.filter(joined, lambda r: r["x"]["h"].eqNullSafe(r["p"]["h"]) | r["x"]["h"].eqNullSafe(r["q"]["h"]))
    places = F.sort_array(F.transform(twice, lambda r: r["x"]["i"]))
    start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
    total = F.aggregate(places, start, lambda s, i: F.struct(i.alias("at"), (s["n"] + F.least(F.lit(WINDOW), i - s["at"])).alias("n")))
    return F.when(F.col(ordered).isNotNull(), total["n"]).otherwise(0)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts and the shares the fences are drawn on."""
    base = docs.drop(*RESULT, "kept")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split("x_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    none = F.array().cast("array<bigint>")
    n = F.size("x_words")
    out = base.withColumn("x_text", text).withColumn("x_words", words_of(F.col("x_text")))
    out = (
        out.withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.length(F.array_join("x_words", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace("x_text", f"[^{SYMBOLS}]+", "")).cast("long"))
        .withColumn("x_lines", lines)
        .withColumn("n_dup_lines", (F.size("x_lines") - F.size(F.array_distinct("x_lines"))).cast("long"))
        # windows of 2, 4 and 8 words from one another; a window of 8 stands twice only where one of 4 does
        .withColumn("x_1", F.when(n > WINDOW, F.transform("x_words", lambda w: F.xxhash64(w))).otherwise(none))
        .withColumn("x_2", F.when(F.size("x_1") > 0, joined("x_1", 1, F.size("x_1"))).otherwise(none))
        .withColumn("x_4", F.when(F.size("x_2") > 0, joined("x_2", 2, F.size("x_2"))).otherwise(none))
        .withColumn("x_hashes", F.when(some_twice("x_4"), joined("x_4", 4, F.size("x_4"))).otherwise(none))
        .withColumn("x_places", repeated_places("x_hashes"))
        .withColumn("n_repeat_words", repeat_words("x_places").cast("long"))
    )

    def share(top, of):
        return F.when(of > 0, top / of).otherwise(0.0)

    n = F.col("n_words")
    return (
        out.withColumn("symbol_share", share(F.col("n_symbols"), F.col("word_chars")))
        .withColumn("dup_line_share", share(F.col("n_dup_lines"), F.size("x_lines")))
        .withColumn("repeat_share", share(F.col("n_repeat_words"), n))
        .withColumn("word_length", share(F.col("word_chars"), n))
        .withColumn("base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * n))
        .drop("x_text", "x_words", "x_lines", "x_1", "x_2", "x_4", "x_hashes", "x_places")
    )


def fences(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(f_lang, f_source, rows, high_<share>, low_<share>): the fences of each language and source."""
    passed = ~F.col("base_failed")
    tallies = {"rows": F.count_if(passed)}
    for s in SHARES:
        some = passed & (F.col(s) > 0)
        tallies[f"n_{s}"] = F.count_if(some)
        tallies[f"all_{s}"] = F.kll_sketch_agg_double(F.when(passed, F.col(s)), F.lit(SKETCH_K))
        tallies[f"some_{s}"] = F.kll_sketch_agg_double(F.when(some, F.col(s)), F.lit(SKETCH_K))
    groups = measured.groupBy(F.col(lang_col).alias("f_lang"), F.col(source_col).alias("f_source"))
    small = groups.agg(*(v.alias(k) for k, v in tallies.items()))
    whole = {k: F.kll_merge_agg_double(k) if k.startswith(("all_", "some_")) else F.sum(k) for k in tallies}
    large = small.where("rows > 0").groupBy(F.col("f_lang").alias("l_lang")).agg(*(v.alias(f"l_{k}") for k, v in whole.items()))

    def limits(share: str, of: str) -> tuple[Column, Column]:
        def quantile(kind: str, n: str, q: float) -> Column:
            return F.when(F.col(of + n) > 0, F.kll_sketch_get_quantile_double(F.col(f"{of}{kind}_{share}"), F.lit(q)))

        q10, q25, q75, q90 = (quantile("all", "rows", q) for q in (0.1, 0.25, 0.75, 0.9))
        reach = FENCE * F.greatest(q75 - q25, (q90 - q10) / 2)
        common = (q25 <= 0) & (F.col(f"{of}n_{share}") >= COMMON * F.col(f"{of}rows"))
        usual = F.when(common, HABIT * quantile("some", f"n_{share}", 0.25)).otherwise(0.0)
        return F.greatest(q75 + reach, usual) + TIE, q25 - reach - TIE

    out = []
    for s in SHARES:
        for name, own, other in zip(("high", "low"), limits(s, ""), limits(s, "l_"), strict=True):
            if name == "high" or s in LOW:
                out.append(F.when(F.col("rows") >= MIN_ROWS, own).otherwise(other).alias(f"{name}_{s}"))
    return small.join(large, F.col("f_lang").eqNullSafe(F.col("l_lang"))).select("f_lang", "f_source", "rows", *out)


def apply_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts, shares, ``base_failed`` and ``kept``. The texts are measured once; what is measured is
    written to the shared work folder, without the texts if they are not to be kept."""
    measured = measure(docs, text_col)
    measured = written(measured if keep_text else measured.drop(text_col), "measured")
    limits = fences(measured, lang_col, source_col)
    same = measured[lang_col].eqNullSafe(F.col("f_lang")) & measured[source_col].eqNullSafe(F.col("f_source"))
    both = measured.join(limits, same, "left")
    outside = F.lit(False)
    for s in SHARES:
        outside = outside | F.coalesce(F.col(s) > F.col(f"high_{s}"), F.lit(False))
    for s in LOW:
        outside = outside | F.coalesce(F.col(s) < F.col(f"low_{s}"), F.lit(False))
    return both.withColumn("kept", ~F.col("base_failed") & ~outside).select(*measured.columns, "kept")
