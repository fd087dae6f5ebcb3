"""The registered queries of the subpackage: operators over their whole tables, and their statements in SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mattone.llm import decontamination, languages, mixing, periodic_runs, personal_data, pieces, quality, rules, substrings, vector_codes, wavelet, wrappers
from mattone.llm import near_duplicates as nd
from mattone.llm.scratch import fold
from mattone.session import work_folder

# Vocabulary files of public tokenizers, read on the driver.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), BYTE_BPE, path)
    return wavelet.documents_of(wavelet.read_shards(spark, path))


@query
def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 1
    scores = mixing.text_scores(table(spark, sf_dir, "documents"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query
def op3_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _rules_sql() -> str:
    """The rules in SQL. Exact quantiles stand for the sketches: equal as long as no group has more rows than a sketch holds."""
    shares = {
        "word_chars_mean": "word_chars::DOUBLE / n_words",
        "symbol_share": "n_symbols::DOUBLE / word_chars",
        "upper_share": "n_upper::DOUBLE / word_chars",
        "dup_line_share": "n_dup_lines::DOUBLE / n_lines",
        "repeat_share": "n_repeat_words::DOUBLE / n_words",
    }
    long = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {r} AS v FROM b WHERE NOT base_failed" + (f" AND {r} > 0" if r in rules.SPARSE else "") for r in shares)
    fence = "CASE s.rule " + " ".join(f"WHEN '{r}' THEN {f}" for r, f in rules.FENCE.items()) + " END"
    at = lambda p: f"min(v) FILTER (WHERE place >= ceil({p} * n))"

    def level(by: str) -> str:
        ranked = f"SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY v) AS place, count(*) OVER (PARTITION BY {by}) AS n FROM u"
        return f"(SELECT {by}, n, {at(0.25)} AS low, {at(0.5)} AS mid, {at(0.75)} AS high FROM ({ranked}) GROUP BY {by}, n)"

    limits = ", ".join(f"max(low) FILTER (WHERE rule = '{r}') AS low_{r}, max(high) FILTER (WHERE rule = '{r}') AS high_{r}" for r in shares)
    tests = [f"coalesce({r} <= high_{r}, true)" if r in rules.SPARSE else f"coalesce({r} BETWEEN low_{r} AND high_{r}, true)" for r in shares]
    names = ", ".join(f"('{r}')" for r in shares)
    return rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
r AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g), (SELECT unnest(range(0, 8)) AS o) WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id),
b AS MATERIALIZED (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {", ".join(f"CASE WHEN n_words > 0 THEN {e} ELSE 0 END AS {r}" for r, e in shares.items())} FROM m),
u AS MATERIALIZED ({long}),
g3 AS {level("lang, source, rule")}, g2 AS {level("lang, rule")}, g1 AS {level("rule")},
p AS (SELECT lang, source, rule FROM (SELECT DISTINCT lang, source FROM b WHERE NOT base_failed), (VALUES {names}) r(rule)),
s AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, rule ORDER BY near) AS choice FROM (
    SELECT p.*, 1 AS near, low, mid, high FROM p JOIN g3 ON g3.rule = p.rule AND g3.lang IS NOT DISTINCT FROM p.lang AND g3.source IS NOT DISTINCT FROM p.source WHERE n >= {rules.LEAST}
    UNION ALL SELECT p.*, 2, low, mid, high FROM p JOIN g2 ON g2.rule = p.rule AND g2.lang IS NOT DISTINCT FROM p.lang WHERE n >= {rules.LEAST}
    UNION ALL SELECT p.*, 3, low, mid, high FROM p JOIN g1 ON g1.rule = p.rule)),
f AS (SELECT lang, source, rule, mid - {fence} * (mid - low) - {rules.EPSILON} AS low, mid + {fence} * (high - mid) + {rules.EPSILON} AS high FROM s WHERE choice = 1),
t AS (SELECT lang, source, {limits} FROM f GROUP BY lang, source)
SELECT b.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, b.base_failed, NOT b.base_failed AND {" AND ".join(tests)} AS kept
FROM b LEFT JOIN t ON t.lang IS NOT DISTINCT FROM b.lang AND t.source IS NOT DISTINCT FROM b.source
"""


ORACLE["op3_adaptive_rules"] = _rules_sql()


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op5_benchmark_decontamination"] = r"""
WITH i AS MATERIALIZED (
  SELECT item_id, w, len(w) AS len, least(len(w), 5) AS width, len(w) - least(len(w), 5) + 1 AS m
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark) WHERE len(w) > 0),
ig AS MATERIALIZED (
  SELECT item_id, len, width, m, g, count(*) AS c
  FROM (SELECT item_id, len, width, m, array_to_string(w[p:p + width - 1], ' ') AS g FROM (SELECT *, unnest(range(1, m + 1)) AS p FROM i))
  GROUP BY ALL),
d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
dg AS MATERIALIZED (
  SELECT doc_id, n, width, p, array_to_string(w[p + 1:p + width], ' ') AS g
  FROM (SELECT doc_id, w, len(w) AS n, width, unnest(range(0, len(w) - width + 1)) AS p FROM d, (SELECT DISTINCT width FROM i) WHERE len(w) >= width)),
h AS MATERIALIZED (
  SELECT dg.doc_id, ig.item_id, ig.m, ig.c, dg.p, dg.g, greatest(dg.n - ig.len, 0) AS last, least(dg.n - dg.width + 1, ig.m) AS own
  FROM dg JOIN ig ON ig.g = dg.g AND ig.width = dg.width WHERE dg.n - dg.width + 1 >= ceil(round(0.8 * ig.m, 9))),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, item_id, m, own, start
  FROM (SELECT doc_id, item_id, m, own, unnest(range(greatest(p - m + 1, 0), least(p, last) + 1)) AS start FROM h)),
b AS (
  SELECT s.doc_id, s.item_id, s.m, s.own, s.start, least(count(*), h.c) AS c
  FROM s JOIN h ON h.doc_id = s.doc_id AND h.item_id = s.item_id AND h.p BETWEEN s.start AND s.start + s.m - 1
  GROUP BY s.doc_id, s.item_id, s.m, s.own, s.start, h.g, h.c),
j AS (SELECT doc_id, item_id, start, sum(c)::DOUBLE / (own + m - sum(c)) AS similarity FROM b GROUP BY doc_id, item_id, m, own, start)
SELECT doc_id, item_id, max(similarity) AS similarity FROM j WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


@query
def op7_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = languages.fit_languages(docs.where(~held_out))
    return languages.language_mixtures(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))

    def listed(column: str) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nd.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op10_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n
  HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
r(a, b) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id
GROUP BY d.doc_id, n.n
"""


@query
def op11_cover_tree_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def _with_periodic_ends(docs: DataFrame) -> DataFrame:
    """Documents, those whose crc32 of the id is divisible by ten with some words from a word on repeated to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    placed = split.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    period = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    made = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return period.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_with_periodic_ends(table(spark, sf_dir, "documents")))
    # The longest run; of equally long ones the first, then the one of the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op13_fm_substring_dedup"] = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, s, array_to_string(w[s + 1:s + 20], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
h AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM g) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM h),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM x ANTI JOIN c ON c.doc_id = x.doc_id AND c.i = x.i GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
