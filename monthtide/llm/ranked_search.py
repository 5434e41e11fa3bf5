"""Ranked lexical search: the documents of the highest scores for each query, by buckets of impact vectors of like length.

A document's vector has one coordinate per term of the queries: the term's weight times its impact there. A query is
the vector of ones at its terms, so that a score is an inner product. Vectors are dealt out and sorted by length; runs
of them are the buckets. With the score that a query's last place needs so far,

* a bucket is left out if no vector of its greatest length can reach that (Cauchy-Schwarz), or none of its greatest
  coordinates can;
* in a bucket, terms whose greatest coordinates together stay below it find no candidates; a candidate goes on if what
  is known of it and the greatest coordinates of the rest can reach it;
* the scores of what is left are computed again, exactly, in integers.

The longest vectors are searched first; the scores found there are the bounds with which all others are searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthtide.llm.common import LAST_ID, tidy
from monthtide.session import stored

#: Vectors in a bucket.
BUCKET = 2048
#: The share of the vectors, the longest ones, that is searched first.
FIRST_SHARE = 1 / 16
#: Bytes of query texts that are searched together: what tasks get of them is bounded by it.
QUERY_BYTES = 8 << 20

# Fixed values of the score.
_LOG_SCALE, _IMPACT_SCALE, _TF_SCALE, _LENGTH_SCALE = 1000, 1_000_000_000, 1000, 20
_BASE_LENGTH = 50

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: Above any rounding error of a bound in doubles.
_SLACK = 1 + 1e-9

_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
_BUCKETS = "doc_id long, norm double, terms array<int>, impacts array<int>"
_FOUND = "item int, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in their order: runs of ASCII letters and digits, lower-cased, and of characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


@dataclass(frozen=True)
class Queries:
    """Queries as arrays: the terms of each, as numbers, one after the other, and where each starts."""

    vocabulary: dict[bytes, int]
    flat: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        each = [sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)}) for text in texts]
        return cls(vocabulary, np.array([t for some in each for t in some], np.int64), np.cumsum([0, *map(len, each)]))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def of_number(self, k: int) -> np.ndarray:
        return self.flat[self.starts[k] : self.starts[k + 1]]


def vectors(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(doc_id, n, terms, counts) of each document: its number of terms, and how often it has those of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        size = max(1, len(known))
        for batch in batches:
            sizes, lengths, found = [], [], []
            for text in batch.column("text"):
                words = terms(text.as_py())
                mine = [known[w] for w in words if w in known]
                lengths.append(len(words))
                sizes.append(len(mine))
                found += mine
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            keys, counts = np.unique(owner * size + np.array(found, np.int64), return_counts=True)
            bounds = pa.array(np.searchsorted(keys // size, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x, pa.int32())) for x in (keys % size, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run), _VECTORS)


def _impacts(found: DataFrame, weights: Broadcast, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, norm, terms, impacts) of the vectors that aren't empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        for batch in batches:
            terms, counts = batch.column("terms"), batch.column("counts")
            sizes = np.diff(np.asarray(terms.offsets))
            n = np.asarray(batch.column("n"))
            length = 100 - _BASE_LENGTH + (_BASE_LENGTH * n * n_docs) // n_terms
            tf, which = np.asarray(counts.flatten()).astype(np.int64), np.asarray(terms.flatten())
            impacts = (_IMPACT_SCALE * tf) // (_TF_SCALE * tf + _LENGTH_SCALE * np.repeat(length, sizes))
            squares = np.append(0.0, np.cumsum((weight[which] * impacts).astype(np.float64) ** 2))
            ends = np.cumsum(sizes)
            # Differences of a running sum: rounded up, since a norm is a bound.
            norm = np.sqrt(np.maximum(squares[ends] - squares[ends - sizes], 0) + squares[-1] * 1e-12)
            offsets = pa.array(np.append(0, ends), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (which, impacts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(norm), *lists], ["doc_id", "norm", "terms", "impacts"])

    return found.where(F.size("terms") > 0).mapInArrow(tidy(run), _BUCKETS)


def _by_length(rows: DataFrame) -> DataFrame:
    """Vectors dealt out and sorted by length; of equal ones by doc_id and by where they lie."""
    order = [F.col("norm").desc(), F.col("doc_id").asc(), F.col("_at").asc()]
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at")


class Bucket:
    """Some vectors, by rows and by coordinates."""

    def __init__(self, doc_ids: np.ndarray, norms: np.ndarray, bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray) -> None:
        self.doc_ids, self.norms, self.bounds, self.terms, self.impacts = doc_ids, norms, bounds, terms, impacts
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(doc_ids)), np.diff(bounds))[order]
        self.values = (weights[terms] * impacts)[order].astype(np.float64)
        self.columns = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.greatest = np.zeros(len(weights))
        filled = np.flatnonzero(np.diff(self.columns))
        if len(filled):
            self.greatest[filled] = np.maximum.reduceat(self.values, self.columns[filled])
        self.longest = norms.max(initial=0.0)

    def open_queries(self, queries: Queries, needed: np.ndarray) -> np.ndarray:
        """Numbers of the queries for which the lengths and the greatest coordinates leave a chance."""
        sizes = np.diff(queries.starts)
        sums = np.append(0.0, np.cumsum(self.greatest[queries.flat]))
        reach = np.minimum(np.sqrt(sizes) * self.longest, (sums[queries.starts[1:]] - sums[queries.starts[:-1]]) + sums[-1] * 1e-12) * _SLACK
        return np.flatnonzero((reach >= needed) & (reach > 0))

    def candidates(self, wanted: np.ndarray, needed: float) -> np.ndarray:
        """Rows that may have the score needed, for a query of these terms."""
        reach = self.greatest[wanted]
        order = np.argsort(reach, kind="stable")
        sums = np.cumsum(reach[order]) * _SLACK
        idle = int(np.searchsorted(sums, needed, side="left"))  # so many terms together don't reach it
        rest = sums[idle - 1] if idle else 0.0
        spans = [slice(self.columns[t], self.columns[t + 1]) for t in wanted[order[idle:]]]
        if not spans:
            return np.zeros(0, np.int64)
        rows, values = (np.concatenate([x[s] for s in spans]) for x in (self.rows, self.values))
        partly = np.bincount(rows, values, len(self.doc_ids))
        able = (partly > 0) & ((partly + rest) * _SLACK >= needed) & (math.sqrt(len(wanted)) * self.norms * _SLACK >= needed)
        return np.flatnonzero(able)

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of rows; weight has those of the query's terms, and zero for all others."""
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.bounds[rows] - (ends - sizes), sizes)
        return np.add.reduceat(weight[self.terms[at]] * self.impacts[at], ends - sizes)


def _buckets(batch: pa.RecordBatch, weights: np.ndarray) -> Iterator[Bucket]:
    for start in range(0, batch.num_rows, BUCKET):
        some = batch.slice(start, BUCKET)
        terms, impacts = some.column("terms"), some.column("impacts")
        bounds = np.asarray(terms.offsets).astype(np.int64)
        flat = np.asarray(terms.flatten()), np.asarray(impacts.flatten()).astype(np.int64)
        yield Bucket(np.asarray(some.column("doc_id")), np.asarray(some.column("norm")), bounds - bounds[0], *flat, weights)


def _searched(rows: DataFrame, shared: Broadcast, least: np.ndarray, places: int) -> DataFrame:
    """(item, doc_id, score): what each task's vectors have for the first places, scores below least left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        needed = np.maximum(least, 1).astype(np.float64)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(queries))]
        weight = np.zeros(len(weights), np.int64)
        for batch in batches:
            for bucket in _buckets(batch, weights):
                for k in bucket.open_queries(queries, needed):
                    wanted = queries.of_number(k)
                    found = bucket.candidates(wanted, needed[k])
                    if not len(found):
                        continue
                    weight[wanted] = weights[wanted]
                    scores = bucket.scores(found, weight)
                    weight[wanted] = 0
                    good = scores >= needed[k]
                    ids, scores = np.append(best[k][0], bucket.doc_ids[found[good]]), np.append(best[k][1], scores[good])
                    order = np.lexsort((ids, -scores))[:places]
                    best[k] = ids[order], scores[order]
                    if len(order) == places:
                        needed[k] = max(needed[k], scores[order[-1]])
        items = np.repeat(np.arange(len(best), dtype=np.int32), [len(ids) for ids, _ in best])
        columns = [np.concatenate([np.zeros(0, np.int64), *(b[c] for b in best)]) for c in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(items), *map(pa.array, columns)], ["item", "doc_id", "score"])

    return rows.mapInArrow(tidy(run), _FOUND)


def _ranked(found: DataFrame, places: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= places)


def _search(docs: DataFrame, texts: list[str | None], places: int) -> DataFrame:
    """(item, rank, doc_id, score) for each text, item being its number."""
    spark = docs.sparkSession
    context, queries = spark.sparkContext, Queries.of(texts)
    found = stored(vectors(docs, context.broadcast(queries.vocabulary)), "vectors")
    told = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    holding = np.zeros(len(queries.vocabulary), np.int64)
    for row in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():  # a row per term of the queries
        holding[row["t"]] = row["n"]
    weights = np.array([math.floor(_LOG_SCALE * math.log((2 * told["docs"] + 2) / (2 * int(n) + 1))) for n in holding], np.int64)
    rows = stored(_by_length(_impacts(found, context.broadcast(weights), told["docs"], told["terms"] or 1)), "buckets")
    limit = rows.agg(F.percentile_approx("norm", 1 - FIRST_SHARE).alias("norm")).first()["norm"]
    limit = 0.0 if limit is None else limit
    shared, least = context.broadcast((queries, weights)), np.zeros(len(queries), np.int64)
    first = stored(_ranked(_searched(rows.where(F.col("norm") >= limit), shared, least, places), places).drop("rank"), "first")
    for row in first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == places).collect():
        least[row["item"]] = row["least"]
    others = _searched(rows.where(F.col("norm") < limit), shared, least, places)
    return _ranked(first.unionByName(others), places)


def search(docs: DataFrame, items: DataFrame, places: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the documents of the highest scores above 0, equal ones by doc_id.

    docs has doc_id and text, items have item_id and text. Weights and lengths come from all documents, whole texts.
    Rows of one item_id and text are one item; rows of one item_id with other texts are items of their own. Null and
    empty texts have no terms: such a document is never found, such an item finds nothing. Repeated documents count and
    are ranked as often as they are there; a null doc_id comes last among equal scores. Other columns are not looked at.
    Items are taken in blocks of limited bytes; each block is one pass over the documents.
    """
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, results = max(1, -(-size // QUERY_BYTES)), []
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        names = spark.createDataFrame(pa.table({"item": pa.array(range(mine.num_rows), pa.int32()), "item_id": mine["item_id"]}))
        results.append(_search(docs, mine["text"].to_pylist(), places).join(F.broadcast(names), "item"))
    whole = results[0]
    for other in results[1:]:
        whole = whole.unionByName(other)
    return whole.select("item_id", "rank", F.when(F.col("doc_id") < LAST_ID, F.col("doc_id")).alias("doc_id"), "score")
