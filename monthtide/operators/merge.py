"""Insert-only merge: the batch rows whose key is not in the main table.

What must hold, whatever the plan:

* Rows of one batch are compared with the main table only, never with each
  other: two equal new rows are both inserted.
* Keys compare by plain equality, so a NULL on either side never matches.
* With ``order`` a batch may span several loads. The result is then what merging
  the loads one after the other, in that order, would have inserted.

How the work is spread: the main side is reduced to its distinct keys by a
partial aggregation before it is shuffled, so copies in main cost nothing. The
batch side cannot be reduced, so keys that hold an outsized share of it are
found with a bounded sketch and answered by broadcast, while all other keys take
the shuffled anti join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.session import stored

# A key with at least this share of the batch is heavy; there are at most
# 1 / share of them, which bounds everything broadcast for them.
HEAVY_SHARE = 0.001
_HEAVY_LIMIT = int(1 / HEAVY_SHARE)
# Counters of the frequent-items sketch; its error, about 3.5 / 2^14 of the
# rows, stays well below HEAVY_SHARE.
_SKETCH_COUNTERS = 10_000
# Groups in which the sketches of the tasks are combined first.
_SKETCH_GROUPS = 64

_SEEN = "_seen_"
_FIRST = "_seen_first"
_HEAVY = "_seen_often"
# Order value of rows already in main: before every load.
_BEFORE_ALL = ""


def _check_key_types(batch: DataFrame, main: DataFrame, keys: Sequence[str]) -> None:
    for key in keys:
        left, right = batch.schema[key].dataType, main.schema[key].dataType
        if left != right:
            raise TypeError(f"{key}: {left.simpleString()} in the batch, {right.simpleString()} in main; conform first")


def _seen_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys under their own names, so that a join never mixes up the sides."""
    return df.select(*[F.col(k).alias(_SEEN + k) for k in keys])


def packed(key: Column) -> Column:
    """A text key as bytes, a fingerprint in half its length; different keys have different bytes."""
    raw = key.cast("binary")
    # Marked by its end, and never 32 bytes long.
    other = F.concat(raw, F.when(F.length(raw) == 31, F.lit(b"\2\2")).otherwise(F.lit(b"\1")))
    # Only digits of the lower case come back as they were; what else there is unhex leaves out.
    return F.coalesce(F.when((F.length(key) == 64) & (F.lower(key) == key), F.unhex(key)), other)


def unpacked(key: Column) -> Column:
    """The text of a packed key."""
    marks = F.when(F.substring(key, -1, 1) == F.lit(b"\2"), 2).otherwise(1)
    other = F.substring(key, F.lit(1), F.length(key) - marks).cast("string")
    return F.when(F.length(key) == 32, F.lower(F.hex(key))).otherwise(other)


def _texts(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if isinstance(df.schema[k].dataType, T.StringType)]


def with_packed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with those of the keys packed that are texts."""
    return df.withColumns({k: packed(F.col(k)) for k in _texts(df, keys)})


def first_seen(
    main: DataFrame, keys: Sequence[str], rivals: DataFrame | None = None, order: str | None = None
) -> DataFrame:
    """Distinct keys that may rule out a batch row.

    Without ``order``: the keys of ``main``. With it: the keys of ``main`` and of
    ``rivals`` (batch rows of any load), each with the earliest load holding it.
    """
    in_main = _seen_keys(main, keys)
    if order is None:
        return in_main.distinct()
    seen = in_main.withColumn(_FIRST, F.lit(_BEFORE_ALL))
    if rivals is not None:
        in_batch = rivals.select(*[F.col(k).alias(_SEEN + k) for k in keys], F.col(order).alias(_FIRST))
        seen = seen.unionByName(in_batch)
    return seen.groupBy(*[_SEEN + k for k in keys]).agg(F.min(_FIRST).alias(_FIRST))


def _anti(rows: DataFrame, seen: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    same = reduce(and_, [F.col(k) == F.col(_SEEN + k) for k in keys])
    if order is not None:
        same = same & (F.col(_FIRST) < F.col(order))
    return rows.join(seen, same, "left_anti")


def heavy_keys(rows: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """Hashes of the keys that hold at least ``share`` of ``rows``.

    One pass over the key columns. Each task keeps a sketch of fixed size; the
    sketches are combined in groups, and then those of the groups, so that no task
    meets the sketches of all others. Nothing is shuffled by key. The sketch is
    approximate: two evaluations may differ in keys near the limit.
    """
    hashed = rows.select(F.xxhash64(*[F.col(k) for k in keys]).alias("_key"), F.spark_partition_id().alias("_task"))
    sketched = hashed.groupBy(F.pmod("_task", F.lit(_SKETCH_GROUPS))).agg(
        F.expr(f"approx_top_k_accumulate(_key, {_SKETCH_COUNTERS})").alias("_sketch"), F.count("*").alias("_n")
    )
    # Grouped, since there is no sketch of no rows.
    combined = sketched.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(_sketch, {_SKETCH_COUNTERS})").alias("_sketch"), F.sum("_n").alias("_n"))
    return (
        combined.select(F.explode(F.expr(f"approx_top_k_estimate(_sketch, {_HEAVY_LIMIT})")).alias("_top"), "_n")
        .where(F.col("_top.count") >= F.col("_n") * share)
        .select(F.col("_top.item").alias("_heavy"))
    )


def _spread(
    rows: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    alike: Sequence[str] | None,
    join: Callable[[DataFrame, DataFrame], DataFrame],
    known: DataFrame | None = None,
) -> DataFrame:
    """``join(rows, others)`` with the heavy keys of ``rows`` taken out, those ``known`` or else found by a pass over them.

    ``others`` must hold each key a bounded number of times. Its entries for
    heavy keys are broadcast, so that heavy rows stay where they are. The list of
    heavy keys is written once, and all branches read that: were it found again in
    each, they could differ, and rows be lost or doubled. Without heavy keys there
    is one branch.
    """
    probed = list(alike or keys)
    found = known if known is not None else stored(heavy_keys(rows, probed), "heavy_keys")
    if found.isEmpty():
        return join(rows, others)
    heavy = F.broadcast(found)  # at most 1 / HEAVY_SHARE rows
    by_hash = F.xxhash64(*[F.col(c) for c in probed]) == F.col("_heavy") if known is None else None
    is_heavy = by_hash if known is None else reduce(and_, [F.col(k) == F.col(_SEEN + k) for k in keys])
    weighty = rows.join(heavy, is_heavy, "left_semi")
    # One key per heavy hash, hence as bounded as the list of these.
    heavy_values = F.broadcast(_seen_keys(weighty, keys).distinct())
    others_heavy = F.broadcast(others.join(heavy_values, [_SEEN + k for k in keys], "left_semi"))
    return join(rows.join(heavy, is_heavy, "left_anti"), others).unionByName(join(weighty, others_heavy))


def unseen(
    rows: DataFrame,
    seen: DataFrame,
    keys: Sequence[str],
    order: str | None = None,
    alike: Sequence[str] | None = None,
) -> DataFrame:
    """Rows without an entry in ``seen``, for sides of any size and skew.

    ``alike`` names columns that are equal exactly when the keys are, if these
    are cheaper to read than a computed key.
    """
    return _spread(rows, seen, keys, alike, lambda part, entries: _anti(part, entries, keys, order))


def unseen_packed(batch: DataFrame, main: DataFrame, key: str, rank: str, heavy_from: int | None = None) -> DataFrame:
    """Packed keys that a merge inserts, each with the rank of the rows that bring it.

    ``batch`` has the packed ``key`` and an int ``rank`` above 1: twice the load's number, and one more for rows that
    may only rule out later ones. ``main`` has the key as text. All sides meet in one aggregation, which reduces copies
    before they are shuffled and, the rank being a number, hashes and does not sort. With ``heavy_from`` the keys that so
    many rows of even ranks have are told, too, as :func:`heavy_among` reads them; of those not inserted the rank is NULL.
    """
    before = main.select(packed(F.col(key)).alias(key), F.lit(0).alias(rank))
    bring = (F.col(rank) > 0) & (F.col(rank) % 2 == 0)
    counted = [] if heavy_from is None else [(F.count_if(bring) >= heavy_from).alias(_HEAVY)]
    grouped = before.unionByName(batch.select(key, rank)).where(F.col(key).isNotNull()).groupBy(key)
    first = grouped.agg(F.min(rank).alias(rank), *counted)
    if heavy_from is None:
        return first.where(bring).select(F.col(key).alias(_SEEN + key), F.col(rank).alias(_FIRST))
    told = first.select(F.col(key).alias(_SEEN + key), F.when(bring, F.col(rank)).alias(_FIRST), _HEAVY)
    return told.where(F.col(_FIRST).isNotNull() | F.col(_HEAVY))


def wanted_among(told: DataFrame) -> DataFrame:
    """The keys to insert, of what :func:`unseen_packed` tells with ``heavy_from``."""
    return told.where(F.col(_FIRST).isNotNull()).drop(_HEAVY)


def heavy_among(told: DataFrame) -> DataFrame:
    """The heavy keys, inserted or not, of what :func:`unseen_packed` tells with ``heavy_from``."""
    return told.where(F.col(_HEAVY)).drop(_HEAVY, _FIRST)


def unseen_keys(
    rows: DataFrame, main: DataFrame, keys: Sequence[str], rivals: DataFrame | None = None, order: str | None = None
) -> DataFrame:
    """Distinct keys (with their load, if ordered) that a merge of ``rows`` inserts.

    Both sides are reduced to their keys before they are shuffled. Null keys,
    which never match, are not supported here.
    """
    named = rows.select(*keys, *([order] if order else [])).distinct()
    found = _anti(named, first_seen(main, keys, rivals, order), keys, order)
    loads = [F.col(order).alias(_FIRST)] if order else []
    return found.select(*[F.col(k).alias(_SEEN + k) for k in keys], *loads)


def rows_of_keys(
    rows: DataFrame,
    wanted: DataFrame,
    keys: Sequence[str],
    order: str | None = None,
    alike: Sequence[str] | None = None,
    few: bool = False,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key is in ``wanted``, a result of :func:`unseen_keys` or :func:`unseen_packed`.

    ``few`` says that ``wanted`` is known by count to be small enough to
    broadcast; ``rows`` are not shuffled then. ``heavy`` are the heavy keys of
    ``rows``, where these are known.
    """

    def matching(part: DataFrame, entries: DataFrame) -> DataFrame:
        same = [F.col(k) == F.col(_SEEN + k) for k in keys]
        if order:
            same.append(F.col(order) == F.col(_FIRST))
        return part.join(entries, reduce(and_, same), "left_semi")

    return matching(rows, F.broadcast(wanted)) if few else _spread(rows, wanted, keys, alike, matching, heavy)


def unseen_among_few(
    rows: DataFrame,
    main: DataFrame,
    keys: Sequence[str],
    rivals: DataFrame | None = None,
    order: str | None = None,
) -> DataFrame:
    """Rows that neither ``main`` nor an earlier load in ``rivals`` has.

    For a main and rivals *known by count* to be small: their keys are broadcast,
    and ``rows`` are not shuffled, whatever their size.
    """
    return _anti(rows, F.broadcast(first_seen(main, keys, rivals, order)), keys, order)


def unseen_by_probe(
    rows: DataFrame,
    main: DataFrame,
    keys: Sequence[str],
    rivals: DataFrame | None = None,
    order: str | None = None,
) -> DataFrame:
    """The same for ``rows`` *known by count* to be small.

    Their keys are broadcast to where main lies, so that a large main is scanned
    but not shuffled.
    """
    wanted = F.broadcast(rows.select(*keys).distinct())
    in_main = main.select(*keys).join(wanted, list(keys), "left_semi")
    if rivals is not None:
        rivals = rivals.select(*keys, order).join(wanted, list(keys), "left_semi")
    # No more keys than there were in ``rows``.
    return unseen_among_few(rows, in_main, keys, rivals, order)


def _as_main(new: DataFrame, main: DataFrame, insert_columns: Sequence[str] | None) -> DataFrame:
    """``new`` in the columns of ``main``; those not inserted are NULL."""
    given = set(new.columns if insert_columns is None else insert_columns)
    return new.select(
        *[F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in main.schema]
    )


def merge_insert(
    batch: DataFrame,
    main: DataFrame,
    keys: Sequence[str] = ("trip_hash",),
    insert_columns: Sequence[str] | None = None,
    order: str | None = None,
    alike: Sequence[str] | None = None,
) -> DataFrame:
    """The rows a merge of ``batch`` into ``main`` appends, in main's columns.

    ``insert_columns`` lists what is filled in (default: all the batch has); the
    rest is NULL. With ``order`` the batch holds several loads, see the module;
    for ``alike`` see :func:`unseen`. ``batch`` is read more than once, the first
    time at once, for its heavy keys: it must not depend on chance, and is better
    stored first if it is costly to compute.
    """
    _check_key_types(batch, main, keys)
    rows = with_packed(batch, keys)
    seen = first_seen(with_packed(main, keys), keys, rows if order is not None else None, order)
    new = unseen(rows, seen, keys, order, alike).withColumns({k: unpacked(F.col(k)) for k in _texts(batch, keys)})
    return _as_main(new, main, insert_columns)


def new_keys(batch: DataFrame, main: DataFrame, keys: Sequence[str] = ("trip_hash",)) -> DataFrame:
    """Distinct batch keys that are not in main. Reads the key columns only."""
    _check_key_types(batch, main, keys)
    named, seen = (with_packed(df.select(*keys), keys) for df in (batch, main))
    found = _anti(named.distinct(), first_seen(seen, keys), keys, None)
    return found.withColumns({k: unpacked(F.col(k)) for k in _texts(batch, keys)})


def has_new(batch: DataFrame, main: DataFrame, keys: Sequence[str] = ("trip_hash",)) -> bool:
    """Whether merging ``batch`` into ``main`` would insert anything."""
    return not new_keys(batch, main, keys).isEmpty()
