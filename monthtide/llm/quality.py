"""Quality rules and a likelihood ratio between trusted and raw text, over hashed n-grams of words."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import SPACES, bound, small, words

BUCKETS = 1 << 14
#: Added to each bucket's count, as a share of the mean count.
SMOOTHING = 0.05
#: Least log-likelihood ratio per n-gram, in nats, that a kept document has.
THRESHOLD = -0.05
#: Length of the windows whose repetition is measured.
REPEAT = 8


def base_metrics(text: Column, hashes: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text and its words' hashes; all zero for null and empty texts."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    return {
        "n_words": F.size(hashes).cast("long"),
        "word_chars": F.length(F.translate(whole, SPACES, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": _repeat_words(hashes),
    }


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word of a text."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _repeat_words(words: Column) -> Column:
    """Words inside windows whose sequence occurs twice or more; windows are compared by hashes of 64 bits within the text."""
    none = F.lit(0).cast("long")
    starts = F.sequence(F.lit(1), F.size(words) - (REPEAT - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, REPEAT)))

    def twice(order: Column) -> Column:
        def at(x: Column, k: Column) -> Column:
            before, after = F.get(order, k - 1)["h"], F.get(order, k + 1)["h"]
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

        return F.array_sort(F.transform(F.filter(order, at), lambda x: x["i"]))

    def covered(places: Column) -> Column:
        start = F.struct(none.alias("n"), F.lit(-REPEAT).alias("last"))
        step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(REPEAT), i - acc["last"])).cast("long").alias("n"), i.alias("last"))
        return F.aggregate(places, start, step)["n"]

    def counted(all_hashes: Column) -> Column:
        order = F.array_sort(F.transform(all_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        alone = F.size(all_hashes) == F.size(F.array_distinct(all_hashes))
        return F.when(alone, none).otherwise(covered(bound(order, twice)))

    return F.when(F.size(words) < REPEAT, none).otherwise(bound(hashes, counted))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def ngram_buckets(hashes: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of the unigrams and bigrams of a list of words, given by their hashes."""
    size = F.size(hashes) - 1
    pairs = F.zip_with(F.slice(hashes, F.lit(1), size), F.slice(hashes, F.lit(2), size), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    pairs = F.when(size > 0, pairs).otherwise(F.array().cast("array<int>"))
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def likelihood_table(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(P(bucket | trusted) / P(bucket | raw)) of each bucket, from the n-grams of all of docs.

    trusted has the doc_ids of the trusted documents. The counts are summed by bucket in each task first; what
    reaches the driver is one row per bucket, whatever the input.
    """
    chosen = small(trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).where("trusted_id IS NOT NULL").distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(chosen, F.col("id") == F.col("trusted_id"), "left")
    grams = rows.select(F.col("trusted_id").isNotNull().alias("good"), F.explode(bound(word_hashes(F.col("text")), lambda h: ngram_buckets(h, buckets))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("good").alias("good"))
    return _ratios({r["bucket"]: (r["raw"], r["good"]) for r in counts.collect()}, buckets)


def _ratios(counts: dict[int, tuple[int, int]], buckets: int) -> list[float]:
    raw, good = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if not good:
        return [0.0] * buckets
    smooth = [max(1e-9, SMOOTHING * total / buckets) for total in (raw, good)]
    whole = [total + buckets * s for total, s in zip((raw, good), smooth)]
    pairs = (counts.get(b, (0, 0)) for b in range(buckets))
    return [round(log((g + smooth[1]) / whole[1]) - log((r + smooth[0]) / whole[0]), 6) for r, g in pairs]


def judgement(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> Column:
    """A struct of n_words to n_repeat_words and llr, to be selected from docs.

    llr is the mean over a text's n-grams of the log-likelihood ratio; a text without words has 0. A document is kept
    if it doesn't fail the base rules and llr is at least the threshold: the same text gets the same verdict everywhere.
    Without trusted documents every ratio is 0. Null and empty texts fail the base rules; repeated rows are judged and
    counted each; rows without a doc_id are never trusted; an empty table gives no rows; other columns are ignored.
    """
    ratios = likelihood_table(docs, trusted, buckets)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")

    def judged(found: Column) -> Column:
        values = base_metrics(F.col("text"), found)
        total = F.aggregate(ngram_buckets(found, buckets), F.lit(0.0), lambda acc, b: acc + F.get(table, b))
        mean = F.when(F.size(found) > 0, total / (2 * F.size(found) - 1)).otherwise(F.lit(0.0))
        return F.struct(*(v.alias(k) for k, v in values.items()), mean.alias("llr"))

    return bound(word_hashes(F.col("text")), judged)


def _kept(judged: Column, threshold: float) -> Column:
    return ~base_failed(judged["n_words"], judged["n_repeat_words"]) & (judged["llr"] >= threshold)


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept), a row for each of docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), judgement(docs, trusted, buckets).alias("j"))
    failed = base_failed(F.col("j")["n_words"], F.col("j")["n_repeat_words"])
    return rows.select("doc_id", "j.*", failed.alias("base_failed"), _kept(F.col("j"), threshold).alias("kept"))


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns."""
    return docs.where(bound(judgement(docs, trusted, buckets), lambda j: _kept(j, threshold)))
