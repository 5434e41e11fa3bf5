"""SimHash near-duplicates, linked by multi-index hashing."""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import LAST_ID, settled, unused
from monthtide.llm.components import components

BITS = 64
_SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text, signed; zero for no words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    count = max(1, len(found) - shingle + 1)
    shingles = map(b" ".join, zip(*(found[i:] for i in range(shingle)))) if len(found) >= shingle else [b" ".join(found)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=_SEED), shingles), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, _BLOCK):
        octets = hashes[start : start + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of every row of docs."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), of("text").alias("fp"))


def links(fps: DataFrame, distance: int = 2, segments: int = 2, bucket_limit: int = 64) -> DataFrame:
    """Edges (a, b) between the distinct values of column fp that connect just what pairs at most distance bits apart connect.

    Multi-index hashing: the fingerprint is cut into segments; fingerprints within the distance agree in one
    segment up to a small radius. Each fingerprint looks up, for each segment, all values in the ball of that radius
    in the table of the others' segments; what is found is verified on all 64 bits.

    Buckets of the table with more than bucket_limit fingerprints would give the square of their number as pairs.
    Their fingerprints, and those that look into them, are linked by whole midpoints instead: two fingerprints are
    at most the distance apart just if some value lies within half of it of both, and the fingerprints around one
    value are so few (65 for distance 2) that they can be hung on the least of them. No link is lost either way.
    """
    distinct = fps.select("fp").distinct()
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    shifts = [sum(widths[:i]) for i in range(segments)]
    radius, extra = divmod(distance, segments)

    def part(i: int) -> Column:
        return F.shiftrightunsigned("fp", shifts[i]).bitwiseAND(F.lit((1 << widths[i]) - 1))

    table = distinct.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("segment"), part(i).alias("value")) for i in range(segments)))).alias("at")).select("at.*", "fp")
    near = [i for i in range(segments) if radius - (i > extra) >= 0]
    probes = None
    for i in near:
        ball = F.explode(_values(part(i), widths[i], radius - (i > extra)))
        rows = distinct.select(F.lit(i).alias("segment"), ball.alias("value"), F.col("fp").alias("probe"))
        probes = rows if probes is None else probes.union(rows)
    sizes = table.groupBy("segment", "value").agg(F.count("*").alias("size"))
    many = settled(sizes.where(F.col("size") > bucket_limit).select("segment", "value"))
    crowded = many.limit(1).count() > 0

    light, lookups = table, probes
    if crowded:
        light = table.join(many, ["segment", "value"], "left_anti")
    found = lookups.join(light, ["segment", "value"]).where((F.col("probe") < F.col("fp")) & (F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= distance))
    edges = found.select(F.col("probe").alias("a"), F.col("fp").alias("b"))
    if crowded:
        inside = table.join(many, ["segment", "value"], "left_semi").select("fp")
        looking = probes.join(many, ["segment", "value"], "left_semi").select(F.col("probe").alias("fp"))
        edges = edges.union(_midpoints(inside.union(looking).distinct(), distance))
    return edges.distinct()


def _midpoints(fps: DataFrame, distance: int) -> DataFrame:
    half, rest = distance // 2, distance - distance // 2
    around = fps.select("fp", F.explode(_values(F.col("fp"), BITS, rest)).alias("middle"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("middle"))) <= half
    groups = around.groupBy("middle").agg(F.min(F.when(close, F.col("fp"))).alias("a"), F.collect_set("fp").alias("all"))
    return groups.where("a IS NOT NULL AND size(all) > 1").select("a", F.explode("all").alias("b")).where("a != b")


def _values(value: Column, width: int, radius: int) -> Column:
    """All values that differ from value in at most radius of width bits."""
    masks = [sum(1 << k for k in some) for r in range(radius + 1) for some in combinations(range(width), r)]
    assert len(masks) == sum(comb(width, r) for r in range(radius + 1))
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.transform(F.expr(f"array({', '.join(f'{m}L' if m > -(1 << 63) else 'shiftleft(1L, 63)' for m in signed)})"), lambda m: value.bitwiseXOR(m))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root) of every row of docs.

    Fingerprints that differ in at most distance bits are linked; root is the least fingerprint and component_id the
    smallest doc_id that can be reached. Null and empty texts have fingerprint zero and are linked like any other.
    Rows without a doc_id take part; component_id is null where a component has no doc_id at all. Repeated rows stay,
    an empty table gives none.
    """
    rows = settled(fingerprints(docs, shingle))
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(rows, distance))
    owners = settled(firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    ids = owners.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(owners.join(ids, "root").select("fp", "component_id", "root"), "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id (null last, then the least hash of the text).

    All columns are kept. Rows repeated with the same doc_id and text count as one.
    """
    found = near_duplicates(docs, shingle, distance)
    names = unused(docs, "_kept_id", "_kept_hash")
    order = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias(names[0]), F.col("text_hash").alias(names[1]))
    keys = found.groupBy("root").agg(F.min(order).alias("k")).select("k.*")
    rows = docs.withColumns(dict(zip(names, (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), F.xxhash64("text")))))
    kept = rows.join(keys, names, "left_semi").dropDuplicates(names)
    return kept.select(*(f"`{c}`" for c in docs.columns))
