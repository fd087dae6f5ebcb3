"""Quality rules with thresholds learnt per language and source from mergeable quantile sketches.

All of it is DataFrame expressions.  Each rule reads one share of a text.  Median and quartiles of that share in the group
(lang, source) come from a KLL sketch; a document is kept if every share lies within the rule's FENCE times the distance from the median
to the quartile on its side, and EPSILON more, so that a group without any spread has a limit too.  Quartiles hold against
junk in up to a quarter of a group.  Most texts repeat nothing, so a median of all would be 0: the two
rules for repeats (SPARSE) sketch the texts that repeat something at all.

A rule takes the group's sketch if LEAST documents are in it, else the merged sketch of the language, else that of all languages.
A source that holds a third of all rows is sketched in SALTS parts that are merged after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattone.llm.scratch import small_side, written

WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
LEAST, SALTS = 50, 32
# Items a sketch holds per level: exact up to so many rows, about 0.3 % of rank beyond.
SKETCH = 1024
SPACE = "[\\x20\\x09-\\x0D]+"
# Quartile distances from the median to the limit, by rule.
FENCE = {"word_chars_mean": 8.0, "symbol_share": 8.0, "upper_share": 8.0, "dup_line_share": 4.0, "repeat_share": 4.0}
SPARSE = {"dup_line_share", "repeat_share"}
EPSILON = 0.01


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _repeated(h: Column) -> Column:
    """Places covered by windows whose hash occurs more than once, from the sorted places of such windows."""

    def covered(s: Column) -> Column:
        twin = lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))
        places = F.sort_array(F.transform(F.filter(s, twin), lambda e: e["i"]))
        reach = lambda p: F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.transform(F.array(places), lambda p: F.aggregate(reach(p), F.lit(0), lambda total, x: total + x))[0]

    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(F.transform(F.array(ordered), covered)[0])


def repeated_words(w: Column) -> Column:
    """Words in windows of eight that the text holds twice or more, the first included; ``w`` is bound once."""

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))
        return F.when(F.size(w) > WINDOW, F.transform(F.array(hashes), _repeated)[0]).otherwise(F.lit(0))

    return F.transform(F.array(w), of)[0]


def measures(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, base_failed) of every row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    rows = documents.select("doc_id", "lang", "source", text.alias("text"), words(text).alias("w"), lines.alias("lines"))
    w = F.col("w")
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _shares() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "word_chars_mean": per("word_chars", "n_words"),
        "symbol_share": per("n_symbols", "word_chars"),
        "upper_share": per("n_upper", "word_chars"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
    }


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, and low_ and high_ of each rule), a row per group, learnt from the documents that pass the base rules.

    A rule that no document of the table informs has null limits.
    """
    rules = list(FENCE)
    shares = [F.when(share > 0, share).alias(r) if r in SPARSE else share.alias(r) for r, share in _shares().items()]
    learnt = measured.where("not base_failed").select("lang", "source", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"), *shares)
    counts = [F.count(r).alias(f"n_{r}") for r in rules]
    salted = learnt.groupBy("lang", "source", "salt").agg(*counts, *[F.kll_sketch_agg_double(r, SKETCH).alias(r) for r in rules])

    def merged(parts: DataFrame, *by: str) -> DataFrame:
        return parts.groupBy(*by).agg(*[F.sum(f"n_{r}").alias(f"n_{r}") for r in rules], *[F.kll_merge_agg_double(r, SKETCH).alias(r) for r in rules])

    groups = written(merged(salted, "lang", "source"), "group-sketches")
    langs = written(merged(groups, "lang"), "language-sketches")
    whole = merged(langs.withColumn("one", F.lit(1)), "one")

    def named(level: DataFrame, prefix: str, *by: str) -> DataFrame:
        return level.select(*by, *[F.col(c).alias(f"{prefix}_{c}") for r in rules for c in (f"n_{r}", r)])

    joined = named(groups, "g", "lang", "source").withColumn("one", F.lit(1))
    l = named(langs, "l", "lang").withColumnRenamed("lang", "l_lang")
    joined = joined.join(l, F.col("lang").eqNullSafe(F.col("l_lang"))).join(named(whole, "a", "one"), "one")
    out = []
    for r, fence in FENCE.items():
        sketch = F.when(F.col(f"g_n_{r}") >= LEAST, F.col(f"g_{r}")).when(F.col(f"l_n_{r}") >= LEAST, F.col(f"l_{r}")).when(F.col(f"a_n_{r}") > 0, F.col(f"a_{r}"))
        low, mid, high = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.5, 0.75))
        out.append((mid - fence * (mid - low) - EPSILON).alias(f"low_{r}"))
        out.append((mid + fence * (high - mid) + EPSILON).alias(f"high_{r}"))
    return joined.select("lang", "source", *out)


def verdicts(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """The measures with ``broken``: the names of the rules whose limits the document's share leaves, a share equal to a limit being within.

    A text that repeats nothing lies within the rules for repeats.
    """
    named = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    found = []
    for rule, share in _shares().items():
        below = F.lit(False) if rule in SPARSE else share < F.col(f"low_{rule}")
        found.append(F.when(below | (share > F.col(f"high_{rule}")), F.lit(rule)))
    return measured.join(named, same, "left").select(*measured.columns, F.array_compact(F.array(*found)).alias("broken"))


def judge(documents: DataFrame) -> DataFrame:
    """The measures of every row, ``broken`` (see ``verdicts``) and ``kept``: false if base_failed, else whether no rule is broken.

    A null text has no words and fails.  A null lang or source is a group of its own name.  Rows are judged each, a null or
    repeated doc_id included; an empty table gives an empty result; other columns are ignored.
    """
    measured = written(measures(documents), "measures")
    judged = verdicts(measured, small_side(written(thresholds(measured), "thresholds")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
