"""Benchmark passages in documents, found by windows of templates and checked by their slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthtide.llm.common import LAST_ID, bound, settled, small, unused

#: Words that are a unit when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal ms s sec min h hr hrs day days week weeks month months "
    "year years hour hours minute minutes second seconds mph kph kmh km/h % percent dollars dollar cents euros euro "
    "pounds usd eur meters metres meter metre miles mile feet foot inches inch grams gram liters litres degrees"
).split()

# private-use characters stand for the typed placeholders
_NUMBER, _UNIT, _NAME = "", "", ""
_NAME_PATTERN = r"(?<=[\p{Ll},;] )\p{Lu}\p{Ll}\p{L}*"
_NUMBER_PATTERN = r"\p{Sc}?\d+(?:[.,:]\d+)*"
_UNIT_PATTERN = "(?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}])"
_SLOTS = f"(?:{_NAME_PATTERN})|(?:{_NUMBER_PATTERN}(?: ?{_UNIT_PATTERN})?)"
_CUT = r"[^\p{L}\p{N}" + _NUMBER + _UNIT + _NAME + "]+"


def _clean(text: Column) -> Column:
    """The text, null as empty, without the placeholders' own characters."""
    whole = F.coalesce(text, F.lit(""))
    mine = F.contains(whole, F.lit(_NUMBER)) | F.contains(whole, F.lit(_UNIT)) | F.contains(whole, F.lit(_NAME))
    return F.when(mine, F.translate(whole, _NUMBER + _UNIT + _NAME, "   ")).otherwise(whole)


def template(text: Column) -> Column:
    """The lower-case tokens of a text, with names, numbers and units replaced by typed placeholders.

    A name is a capitalised word after a small letter or comma and a blank, a unit one of UNITS after a number. A name
    is all letters of its word, and each placeholder a token of its own, so that the slots of a text are its values.
    """
    marked = F.regexp_replace(_clean(text), _NAME_PATTERN, f" {_NAME} ")
    marked = F.regexp_replace(marked, _NUMBER_PATTERN, f" {_NUMBER} ")
    marked = F.regexp_replace(marked, f"{_NUMBER}  ?{_UNIT_PATTERN}", f"{_NUMBER} {_UNIT} ")
    return F.array_remove(F.split(F.lower(marked), _CUT), "")


def _slots(text: Column, tokens: Column) -> Column:
    """(at, value) of the names and numbers of a text; a number's value has its unit with it."""
    values = F.regexp_extract_all(_clean(text), F.lit(_SLOTS), F.lit(0))
    numbered = F.transform(tokens, lambda t, i: F.struct(i.alias("at"), t.alias("t")))
    places = F.transform(F.filter(numbered, lambda x: x["t"].isin(_NUMBER, _NAME)), lambda x: x["at"])
    return bound(values, lambda v: F.transform(places, lambda at, i: F.struct(at.alias("at"), F.lower(F.get(v, i)).alias("value"))))


def _window_hash(tokens: Column, start: Column, length: int | Column) -> Column:
    """Of the tokens from a place (counted from 1) on: the hash of those of its first half and those of the rest."""
    half = F.floor(length / 2).cast("int") if isinstance(length, Column) else F.lit(length // 2)
    return F.xxhash64(F.xxhash64(F.slice(tokens, start, half)), F.xxhash64(F.slice(tokens, start + half, length - half)))


def _windows(tokens: Column, length: int | Column) -> Column:
    """(at, w) of all windows of a length: where they start and their hashes."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (length - 1))
    hashed = F.transform(starts, lambda i: F.struct((i - 1).alias("at"), _window_hash(tokens, i, length).alias("w")))
    return F.when((F.size(tokens) < length) | (F.size(tokens) == 0), F.array().cast(_PLACED)).otherwise(hashed)


def _all_windows(tokens: Column, lengths: list[int]) -> Column:
    """The windows of several lengths; runs of one length, of which two make up a window, are hashed once for all places."""

    def of(length: int) -> Column:
        half = length // 2
        if length % 2 or not half:
            return _windows(tokens, length)
        runs = F.transform(F.sequence(F.lit(1), F.size(tokens) - (half - 1)), lambda i: F.xxhash64(F.slice(tokens, i, half)))
        pairs = lambda r: F.transform(
            F.sequence(F.lit(0), F.size(r) - half - 1), lambda i: F.struct(i.alias("at"), F.xxhash64(F.get(r, i), F.get(r, i + half)).alias("w"))
        )
        return F.when(F.size(tokens) < length, F.array().cast(_PLACED)).otherwise(bound(runs, pairs))

    return F.concat(*map(of, lengths))


_PLACED = "array<struct<at: int, w: bigint>>"


def _changes(window: int) -> Column:
    """How many of the n tokens of an item a near copy may have changed: a window stays whole wherever these are."""
    return F.when(F.col("n") < window, 0).otherwise(F.greatest(F.lit(1), F.floor(F.col("n") / window) - 1))


def _versions(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, version, text, led): the texts of the items; led ones, of items shorter than a window, begin with a name.

    After a small letter or comma the capital of an item's first word makes it a name. Longer items have other windows.
    """
    items = benchmark.select("item_id", "text").distinct().withColumn("led", F.lit(False))
    begins = F.regexp_extract("text", r"(?s)^[^\p{L}\p{N}]*(\p{Lu}\p{Ll}.*)$", 1)
    led = items.where(F.size(template(F.col("text"))) < window).select("item_id", F.concat(F.lit(", "), begins).alias("text"), F.lit(True).alias("led"))
    items = items.unionByName(led.where("text != ', '"))
    return items.withColumn("version", F.xxhash64("text", "led"))


def _places(items: DataFrame, window: int) -> DataFrame:
    """(item_id, version, n, length, item_at, w): all windows of the items of n tokens.

    Besides those of the full length, items of fewer tokens than two of them have windows of half the length, or of
    their own length if that is less.
    """
    tokens = items.select("item_id", "version", template(F.col("text")).alias("tokens")).withColumn("n", F.size("tokens"))
    half = F.least(F.col("n"), F.lit(max(1, window // 2)))
    full = tokens.where(F.col("n") >= window).withColumn("length", F.lit(window))
    sized = full.unionByName(tokens.where((F.col("n") > 0) & (F.col("n") < 2 * window)).withColumn("length", half))
    return sized.select("item_id", "version", "n", "length", F.inline(_windows(F.col("tokens"), F.col("length")))).withColumnRenamed("at", "item_at")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, coverage: float = 0.5, excerpt: int = 32) -> DataFrame:
    """(doc_id, text_hash, item_id, n_matched, n_windows, n_slots, n_changed) of each document and benchmark item that it holds.

    Texts become templates: names, numbers and units are typed placeholders. A document holds an item if its template
    has at least the given share of the item's windows of so many tokens, and the slots of the matched windows are
    consistent: each value of the item always became one value of the document, and no two became the same. So a
    question with other names and numbers is caught, and n_changed tells how many of its values differ. Consistent
    must be any one occurrence with that share, or all matched windows together; n_slots and n_changed are those of
    the consistent occurrence with the fewest changes. At least a quarter of its tokens must be words or equal values,
    so that one row of numbers is not taken for another.

    It also holds an item of which one consistent occurrence has so many tokens as an excerpt in matched windows, or
    all but one token in eight, less one (one at least; none of an item shorter than a window), if half of these are
    words or equal values. Items shorter than a window match as a whole; n_windows counts their shorter windows.

    Null and empty texts have no windows and match nothing. Rows without a doc_id are matched, too; rows with one
    doc_id and different texts are different documents; rows repeated in full count once; items repeated under one
    item_id are one item with the windows of all. Empty tables give no rows.
    """
    items = _versions(benchmark, window)
    places = settled(_places(items, window))
    whole = places.where(F.col("length") == window)
    first = F.min(F.struct("item_at", "version")).alias("first")
    item_windows = places.groupBy("item_id", "w").agg(first, F.max("length").alias("length"), F.count("*").alias("n_places"))
    item_windows = item_windows.select("item_id", "w", "length", "n_places", "first.*")
    counted = (F.col("length") == window) | (F.col("n") < window)
    sizes = places.where(counted).groupBy("item_id").agg(F.count_distinct("w").alias("n_windows"), F.count_distinct(F.when(F.col("length") == window, F.col("w"))).alias("n_whole"))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    lengths = sorted(r["length"] for r in places.select("length").distinct().collect()) or [window]
    grams = rows.select("id", "text_hash", F.inline(bound(template(F.col("text")), lambda t: _all_windows(t, lengths))))
    hits = settled(grams.join(small(item_windows), "w").select("id", "text_hash", "at", "item_id", "version", "item_at", "w", "length", "n_places"))
    long = hits.where(F.col("length") == window)
    pairs = long.select(*_PAIR, "w", "n_places").distinct().groupBy(*_PAIR).agg(F.count("*").alias("n_matched"), F.sum("n_places").alias("n_places"))
    pairs = pairs.join(small(sizes), "item_id").withColumn("enough", F.col("n_matched") >= coverage * F.col("n_whole"))
    pairs = settled(pairs.where(F.col("enough") | (F.col("n_places") * window >= excerpt)))
    enough = pairs.where("enough").select(*_PAIR)
    long = long.join(pairs.select(*_PAIR), _PAIR, "left_semi")
    pooled = _tokens(long.join(enough, _PAIR, "left_semi"), window).select(*_PAIR, _run(0).alias("run"), "version", "at", "item_at").distinct()
    aligned = settled(_aligned(long, whole, window))
    runs = aligned.groupBy(*_PAIR, "run").agg(F.count_distinct(F.when(F.col("step") == 0, F.col("w"))).alias("n"), F.count_distinct("item_at").alias("n_tokens"))
    own = whole.groupBy("item_id", "version").agg(F.count_distinct("w").alias("of"))
    runs = runs.withColumn("version", F.col("run.version")).join(small(own), ["item_id", "version"])
    shared = F.col("n") >= coverage * F.col("of")
    runs = runs.where(shared | (F.col("n_tokens") >= excerpt)).select(*_PAIR, "run", F.when(shared, 0).otherwise(F.col("n_tokens")).alias("n_tokens"))
    near = settled(_near(rows, items, hits, places, window))
    near_runs = near.groupBy(*_PAIR, "run", "n").agg(F.count_distinct("item_at").alias("n_tokens"))
    near_runs = near_runs.where(F.col("n_tokens") >= F.col("n") - _changes(window)).select(*_PAIR, "run", "n_tokens")
    runs = settled(runs.unionByName(near_runs).unionByName(enough.select("*", _run(0).alias("run"), F.lit(0).alias("n_tokens"))))
    columns = [*_PAIR, "run", "version", "at", "item_at"]
    aligned = aligned.select(*columns).distinct().unionByName(near.select(*columns)).unionByName(pooled)
    aligned = settled(aligned.join(runs, [*_PAIR, "run"], "left_semi"))
    checked = _slot_pairs(rows, items, aligned, runs)
    plain = items.select("item_id", "version", F.posexplode(template(F.col("text"))).alias("item_at", "token")).where(~F.col("token").isin(_NUMBER, _UNIT, _NAME))
    known = aligned.join(small(plain.withColumn("is_plain", F.lit(True))), ["item_id", "version", "item_at"], "left")
    known = known.groupBy(*_PAIR, "run").agg(F.count("*").alias("n_all"), F.count("is_plain").alias("n_plain"))
    held = runs.join(checked, [*_PAIR, "run"], "left").join(known, [*_PAIR, "run"]).where(F.coalesce("consistent", F.lit(True)))
    equal = F.col("n_plain") + F.coalesce("n_same", F.lit(0))
    held = held.where((2 * equal >= F.col("n_tokens")) & ((F.col("n_tokens") > 0) | (4 * equal >= F.col("n_all"))))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    best = F.min(F.struct(F.col("run.kind") == 0, count("n_changed"), (-F.coalesce("n_slots", F.lit(0))).alias("slots"))).alias("best")
    held = held.groupBy(*_PAIR).agg(best)
    matched = hits.join(held.select(*_PAIR), _PAIR, "left_semi").join(small(places.where(counted).select("item_id", "w").distinct()), ["item_id", "w"])
    matched = matched.groupBy(*_PAIR).agg(F.count_distinct("w").alias("n_matched"))
    out = held.join(matched, _PAIR, "left").join(small(sizes), "item_id")
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id")
    return out.select(doc_id, "text_hash", "item_id", count("n_matched"), "n_windows", (-F.col("best.slots")).alias("n_slots"), "best.n_changed")


_PAIR = ["id", "text_hash", "item_id"]


def _run(kind: int, version: Column | None = None, place: Column | None = None) -> Column:
    """Tells groups of a pair apart: all matched windows (0), those of one offset (1) or near offsets (2), and all equal tokens of these (3, 4)."""
    number = lambda c: (F.lit(0) if c is None else c).cast("long")
    return F.struct(F.lit(kind).alias("kind"), number(version).alias("version"), number(place).alias("place"))


def _tokens(hits: DataFrame, window: int) -> DataFrame:
    """The places of all tokens of matched windows; step counts within a window."""
    steps = hits.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(window - 1))))
    return steps.withColumns({"at": F.col("at") + F.col("step"), "item_at": F.col("item_at") + F.col("step")})


def _aligned(hits: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(id, text_hash, item_id, run, version, w, step, at, item_at) of the tokens of each occurrence of an item in a document.

    Every place of a window in the item counts. Windows of one offset between document and item are one run. So are
    those of offsets that follow each other by less than a window (words put in or left out); there each token goes
    with the offset that has the most windows, as each token of the item does.
    """
    lines, every = _lines(hits, places, window)
    tokens = _tokens(every.join(lines, [*_OWNER, "offset"]), window)
    columns = [*_PAIR, "run", "version", "w", "step", "at", "item_at"]
    straight = tokens.withColumn("run", _run(1, F.col("version"), F.col("offset"))).select(*columns)
    bends = lines.groupBy(*_OWNER, "near").agg(F.count("*").alias("of")).where("of > 1").drop("of")
    bent = _bent(tokens.join(small(bends), [*_OWNER, "near"], "left_semi"))
    return straight.unionByName(bent.withColumn("run", _run(2, F.col("version"), F.col("near"))).select(*columns))


_OWNER = [*_PAIR, "version"]


def _lines(hits: DataFrame, places: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The offsets of each item version in a document with their number of windows, near offsets numbered; and the windows."""
    every = hits.select(*_PAIR, "at", "w").join(small(places), ["item_id", "w"]).withColumn("offset", F.col("at") - F.col("item_at"))
    order = Window.partitionBy(*_OWNER).orderBy("offset")
    starts = F.when(F.col("offset") - F.lag("offset").over(order) < window, 0).otherwise(1)
    lines = every.groupBy(*_OWNER, "offset").agg(F.count("*").alias("n_hits")).withColumn("starts", starts)
    return settled(lines.withColumn("near", F.sum("starts").over(order)).drop("starts")), every


def _bent(tokens: DataFrame) -> DataFrame:
    """The tokens of near offsets, each with one offset alone."""
    for side in ("at", "item_at"):
        best = Window.partitionBy(*_OWNER, "near", side).orderBy(F.desc("n_hits"), F.asc("offset"))
        tokens = tokens.withColumn("rank", F.dense_rank().over(best)).where("rank = 1").drop("rank")
    return tokens


def _near(rows: DataFrame, items: DataFrame, hits: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(id, text_hash, item_id, run, version, n, at, item_at) of the equal tokens of an item and a document, offset by offset.

    Only offsets are looked at that have the windows which so few changes leave; one changed, missing or additional
    token costs the windows that it lies in. The next offsets on both sides count with them.
    """
    anchors = places.where((F.col("n") >= 2 * window) | (F.col("length") < window))
    lines, every = _lines(hits, anchors, window)
    got = every.join(lines.select(*_OWNER, "offset", "near"), [*_OWNER, "offset"]).groupBy(*_OWNER, "near", "n", "length").agg(F.count_distinct("item_at").alias("got"))
    least = F.greatest(F.lit(1), F.col("n") - F.col("length") + 1 - F.col("length") * _changes(window))
    lines = lines.join(got.where(F.col("got") >= least).select(*_OWNER, "near", "n"), [*_OWNER, "near"])
    beside = lines.where(F.col("n") >= window).withColumns({"n_hits": F.lit(0).cast("long"), "offset": F.explode(F.array(F.col("offset") - 1, F.col("offset") + 1))})
    lines = settled(lines.unionByName(beside).groupBy(*_OWNER, "near", "n", "offset").agg(F.max("n_hits").alias("n_hits")))
    item_tokens = items.select("item_id", "version", F.posexplode(template(F.col("text"))).alias("item_at", "token"))
    found = small(lines.select("id", "text_hash").distinct())
    texts = rows.join(found, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    doc_tokens = texts.select("id", "text_hash", F.posexplode(template(F.col("text"))).alias("at", "token"))
    tokens = lines.join(small(item_tokens), ["item_id", "version"]).withColumn("at", F.col("offset") + F.col("item_at"))
    tokens = settled(tokens.join(doc_tokens, ["id", "text_hash", "at", "token"]).drop("token"))
    columns = [*_PAIR, "run", "version", "n", "at", "item_at"]
    straight = tokens.where("n_hits > 0").withColumn("run", _run(3, F.col("version"), F.col("offset"))).select(*columns)
    bent = _bent(tokens.where(F.col("n") >= window)).withColumn("run", _run(4, F.col("version"), F.col("near"))).select(*columns)
    return straight.unionByName(bent)


def _slot_pairs(rows: DataFrame, items: DataFrame, aligned: DataFrame, runs: DataFrame) -> DataFrame:
    """(id, text_hash, item_id, run, n_slots, n_same, n_changed, consistent) of the runs of aligned tokens that have slots."""
    keys = [*_PAIR, "run"]
    item_tokens = items.select("item_id", "version", "led", "text", template(F.col("text")).alias("tokens"))
    item_slots = item_tokens.select("item_id", "version", "led", F.inline(_slots(F.col("text"), F.col("tokens")))).withColumnsRenamed({"at": "item_at", "value": "item_value"})
    found = small(runs.select("id", "text_hash").distinct())
    texts = rows.join(found, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    doc_tokens = texts.select("id", "text_hash", "text", template(F.col("text")).alias("tokens"))
    doc_slots = doc_tokens.select("id", "text_hash", F.inline(_slots(F.col("text"), F.col("tokens"))))
    pairs = aligned.join(small(item_slots), ["item_id", "version", "item_at"]).join(doc_slots, ["id", "text_hash", "at"])
    other = F.max(F.col("led") & (F.col("item_at") == 0) & (F.col("item_value") != F.col("value"))).alias("other")  # no name, in truth
    pairs = pairs.groupBy(*keys, "item_value", "value").agg(F.count("*").alias("n"), other)
    both = F.struct("item_value", "value")
    return pairs.groupBy(*keys).agg(
        F.sum("n").alias("n_slots"),
        F.sum(F.when(F.col("item_value") == F.col("value"), F.col("n")).otherwise(0)).alias("n_same"),
        F.count_if(F.col("item_value") != F.col("value")).alias("n_changed"),
        ((F.count_distinct("item_value") == F.count_distinct(both)) & (F.count_distinct("value") == F.count_distinct(both)) & ~F.max("other")).alias("consistent"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, coverage: float = 0.5, excerpt: int = 32) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns."""
    found = leaks(docs, benchmark, window, coverage, excerpt)
    id_, hash_ = unused(docs, "_id", "_hash")
    gone = found.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias(id_), F.col("text_hash").alias(hash_)).distinct()
    rows = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), hash_: F.xxhash64("text")})
    return rows.join(small(settled(gone)), [id_, hash_], "left_anti").select(*(f"`{c}`" for c in docs.columns))
