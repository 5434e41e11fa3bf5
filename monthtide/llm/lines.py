"""Lines that spread over many sites, by sketches and exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import LAST_ID, SPACES, settled, small, unused

#: lgK of the sketches; their relative standard error is about 1.04 / sqrt(2^lgK).
SKETCH = 12
#: Standard errors around the threshold within which lines are counted exactly.
MARGIN = 5


def _folded(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(SPACES)))


def _long_enough(line: Column, min_chars: int) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) >= min_chars


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, hash, site, at, high, low) of every line that counts: at is its place, high and low the hash of its folded text."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64("text").alias("hash"),
        F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("site"),
        F.posexplode(F.split(F.col("text"), "\n")).alias("at", "line"),
    )
    lines = lines.where(_long_enough(F.col("line"), min_chars))
    return lines.select("id", "hash", "site", "at", F.xxhash64(_folded(F.col("line"))).alias("high"), F.hash(_folded(F.col("line"))).alias("low"))


def spread_lines(rows: DataFrame, min_sites: int) -> DataFrame:
    """(high, low, n_sites, first) of the lines of rows found on at least so many distinct sites; first is their first place.

    One sketch per line is built in each task and merged. Only lines whose estimate is within the margin of the
    threshold are counted exactly, over their distinct pairs of line and site; n_sites is exact for these.
    """
    found = settled(
        rows.groupBy("high", "low").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH))).alias("n_sites"),
            F.min(F.struct("id", "hash", "at")).alias("first"),
        )
    )
    near = F.abs(F.col("n_sites") - min_sites) <= max(1.0, MARGIN * 1.04 / 2 ** (SKETCH / 2) * min_sites)
    close = found.where(near).select("high", "low", "first")
    pairs = rows.join(small(close.select("high", "low")), ["high", "low"], "left_semi").groupBy("high", "low", "site").agg(F.lit(1).alias("n"))
    exact = pairs.groupBy("high", "low").agg(F.count("*").alias("n_sites")).join(close, ["high", "low"])
    return found.where(~near).unionByName(exact).where(F.col("n_sites") >= min_sites)


def remove_spread_lines(docs: DataFrame, min_sites: int = 10, min_chars: int = 20) -> DataFrame:
    """All columns of docs with text cut by boilerplate lines, and n_chars, if it is there, set to the new length.

    A line (between \\n, compared without outer blanks and letter case) is boilerplate if its distinct sources number
    min_sites or more and it has min_chars characters. It stays where it is first (smallest doc_id, null last, then the
    text's hash, then place) and goes everywhere else, in every document. What stays is joined by \\n again; a text of
    which nothing stays is empty, a null text stays null. A null source counts as one more source. A row repeated in
    full counts as often as it occurs and keeps the same lines each time; an empty table gives no rows.
    """
    id_, hash_, drop, left = unused(docs, "_id", "_hash", "_drop", "_left")
    marked = _drops(docs, min_sites, min_chars).withColumnsRenamed({"id": id_, "hash": hash_, "drop": drop})
    rows = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), hash_: F.xxhash64("text")})
    rows = rows.join(marked, [id_, hash_], "left")
    rows = rows.withColumn(left, F.when(F.col(drop).isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col(drop))))
    new = {"text": F.col(left)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(drop).isNull(), F.col("n_chars")).otherwise(F.length(left)).cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def _drops(docs: DataFrame, min_sites: int, min_chars: int) -> DataFrame:
    """(id, hash, drop): the places of the lines that go, by document."""
    lines = line_rows(docs, min_chars)
    often = settled(lines.groupBy("high", "low").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("high", "low"))
    asked = settled(lines.join(small(often), ["high", "low"], "left_semi"))
    spread = settled(spread_lines(asked, min_sites).select("high", "low", "first"))
    gone = asked.join(small(spread), ["high", "low"]).where(F.struct("id", "hash", "at") != F.col("first"))
    return gone.groupBy("id", "hash").agg(F.collect_set("at").alias("drop"))


def _without(text: Column, drop: Column) -> Column:
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    return F.concat_ws("\n", F.transform(stay, lambda i: F.get(lines, i)))
