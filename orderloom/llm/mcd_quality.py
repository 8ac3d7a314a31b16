"""Quality rules by robust multivariate outliers.

Base rules come first: enough words, not too many of them in repeated passages. The rest is judged against its own
language and source: four transformed statistics of a document (log of the mean word length, roots of the shares of
symbols, of repeated words and of repeated lines) are compared with a minimum-covariance-determinant estimate, to which
each document's own sampling error is added, so that short texts don't stand out by chance and a group without any
symbols still has a spread. It starts from medians and median deviations,
takes the ``support`` share of rows with the least distance, computes mean and covariance of those, and repeats
(concentration steps); each step is a grouped aggregate and a join with one row per group. Documents whose squared
Mahalanobis distance passes ``cutoff`` are rejected. All of it is column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import settle, table
from orderloom.operators.sized import broadcast_if_small

SUPPORT = 0.75
STEPS = 4
#: 0.999-quantile of chi-square with four degrees of freedom.
CUTOFF = 18.47
#: Makes the support's covariance estimate that of a normal population: 0.75 / P(chi2(6) <= 0.75-quantile of chi2(4)).
CONSISTENCY = 1.486
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_F = ("f1", "f2", "f3", "f4")
_PAIRS = [(a, b) for i, a in enumerate(_F) for b in _F[i:]]


#: Positions, in order, of the windows whose hash occurs at least twice; ``ordered`` holds (hash, position) sorted.
_REPEATED = (
    "sort_array(transform(filter(sequence(0, size(ordered) - 1), j -> "
    "(j > 0 and ordered[greatest(j - 1, 0)].h = ordered[j].h) or "
    "(j < size(ordered) - 1 and ordered[least(j + 1, size(ordered) - 1)].h = ordered[j].h)), j -> ordered[j].i))")


def text_statistics(docs: DataFrame, window: int = 8) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines
    in place of the text. A null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       text.alias("text"))
    trimmed = F.btrim("text", F.lit(_SPACES))
    rows = rows.select(
        "doc_id", "lang", "source",
        (F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.length(F.translate("text", _SPACES, "")).cast("bigint").alias("word_chars"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(_SPACES))) > 0).alias("lines"),
        F.when(F.length(trimmed) > 0, F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda x: F.xxhash64(x)))
        .otherwise(F.array().cast("array<bigint>")).alias("words"))
    gram = "xxhash64(" + ", ".join(f"words[i + {k}]" for k in range(window)) + ")"
    rows = rows.select(
        "doc_id", "lang", "source", "n_symbols", "word_chars", F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(f"if(size(words) >= {window}, transform(sequence(0, size(words) - {window}), i -> {gram}), "
               "cast(array() as array<bigint>))").alias("grams"))
    # Most texts repeat no window; only the others have theirs sorted.
    rows = rows.withColumn("ordered", F.expr(
        "if(size(array_distinct(grams)) < size(grams), sort_array(transform(grams, (h, i) -> struct(h, i))), null)"))
    rows = rows.withColumn("at", F.when(F.col("ordered").isNotNull(), F.expr(_REPEATED)))
    covered = F.expr(
        f"if(at is null, 0, {window} + aggregate(zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1), "
        f"(a, b) -> least({window}, b - a)), 0, (x, y) -> x + y))")
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
                       covered.cast("bigint").alias("n_repeat_words"))


def _features() -> list[Column]:
    """The statistics, and ``e_...``: the variance that each has by chance. The root of a share varies by 1/4 over the
    number of what was counted, whatever the share; symbols cling together in words, repeated words in passages of
    eight, and word lengths vary by about half their mean."""
    words, chars, lines = (F.greatest(n, F.lit(1)).cast("double") for n in ("n_words", "word_chars", "n_lines"))
    return [F.log(chars / words).alias("f1"), F.sqrt(F.col("n_symbols") / chars).alias("f2"),
            F.sqrt(F.col("n_repeat_words") / words).alias("f3"), F.sqrt(F.col("n_dup_lines") / lines).alias("f4"),
            (0.25 / words).alias("e_f1"), (0.25 / words).alias("e_f2"), (2.0 / words).alias("e_f3"), (0.25 / lines).alias("e_f4")]


def _distance(means: list[Column], cov: dict[tuple[str, str], Column]) -> Column:
    """Squared Mahalanobis distance, by blocks of two; the diagonal has the document's sampling error added, so that it
    is never singular."""
    a, b, c, d = (cov[(f, f)] + F.col(f"e_{f}") for f in _F)
    ab, ac, ad, bc, bd, cd = (cov[pair] for pair in _PAIRS if pair[0] != pair[1])
    w, x, y, z = (F.col(n) - m for n, m in zip(_F, means))

    def solved(p: Column, q: Column) -> tuple[Column, Column]:
        return (b * p - ab * q) / (a * b - ab * ab), (a * q - ab * p) / (a * b - ab * ab)

    # What the first two leave of the others and of their covariance.
    c1, c2 = solved(ac, bc)
    d1, d2 = solved(ad, bd)
    c, cd, d = c - (c1 * ac + c2 * bc), cd - (c1 * ad + c2 * bd), d - (d1 * ad + d2 * bd)
    y, z = y - (c1 * w + c2 * x), z - (d1 * w + d2 * x)
    first, second = solved(w, x)
    return w * first + x * second + (y * y * d - 2.0 * y * z * cd + z * z * c) / (c * d - cd * cd)


def _with_groups(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One row per language and source joined to its documents. Broadcast if measured small; else a plain join."""
    params = broadcast_if_small(params.withColumnsRenamed({"lang": "p_lang", "source": "p_source"}))
    return rows.join(params, F.col("lang").eqNullSafe(F.col("p_lang")) & F.col("source").eqNullSafe(F.col("p_source")),
                     "left").drop("p_lang", "p_source")


def mcd_distances(rows: DataFrame, fit: Column, steps: int = STEPS, support: float = SUPPORT) -> DataFrame:
    """``rows`` (lang, source, f1 ... f4, e_f1 ... e_f4, ...) with ``d2``: squared robust distance within language and source.

    ``fit`` marks the rows that the estimates are made from. A group without such rows has null distances."""
    inner = rows.where(fit).select("lang", "source", *_F, *(f"e_{f}" for f in _F))
    medians = settle(inner.groupBy("lang", "source").agg(*(F.percentile_approx(f, 0.5, 10000).alias(f"m_{f}") for f in _F)), "medians")
    spread = _with_groups(inner, medians).groupBy("lang", "source").agg(
        *(F.first(f"m_{f}").alias(f"m_{f}") for f in _F),
        *(F.percentile_approx(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5, 10000).alias(f"s_{f}") for f in _F))
    params = settle(spread.select(
        "lang", "source", *(F.col(f"m_{f}") for f in _F),
        *((F.pow(F.col(f"s_{a}") * 1.4826, F.lit(2.0)) if a == b else F.lit(0.0)).alias(f"c_{a}_{b}") for a, b in _PAIRS)), "mcd")

    def measured(frame: DataFrame, scale: float) -> DataFrame:
        cov = {(a, b): F.col(f"c_{a}_{b}") * scale for a, b in _PAIRS}
        joined = _with_groups(frame, params).withColumn("d2", _distance([F.col(f"m_{f}") for f in _F], cov))
        return joined.drop(*(f"m_{f}" for f in _F), *(f"c_{a}_{b}" for a, b in _PAIRS))

    for _ in range(steps):
        near = measured(inner, 1.0)
        limits = settle(near.groupBy("lang", "source").agg(F.percentile_approx("d2", support, 10000).alias("limit")), "limits")
        half = _with_groups(near, limits).where("d2 <= limit")
        params = settle(half.groupBy("lang", "source").agg(
            *(F.avg(f).alias(f"m_{f}") for f in _F),
            *((F.covar_pop(a, b)).alias(f"c_{a}_{b}") for a, b in _PAIRS)), "mcd")
    return measured(rows, CONSISTENCY)


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, d2, kept) per row of ``docs``
    (doc_id, text, lang, source).

    Null and empty texts have no words and fail the base rules. Rows with a null language or source form groups of
    their own. A group with too few rows to vary has only their sampling errors as its spread. Repeated rows come back as often as they
    came in; an empty table gives an empty result."""
    rows = text_statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
    rows = settle(rows.select("*", *_features()), "statistics")
    judged = mcd_distances(rows, ~F.col("base_failed"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"))


def op8_mcd_quality(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
