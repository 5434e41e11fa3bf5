"""Repeated word windows, found level by level and removed after their first occurrence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import KEY, keyed, per_batch, settled

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_HIGH, _LOW = np.uint64(32), np.uint64(29)
#: Words that are hashed at once.
_BLOCK = 1 << 16


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))

    def __call__(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = 1 << (int(count) - 1).bit_length()
            for name, factor in (("up", _BASE), ("down", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_powers = _Powers()


def _sliding(values: np.ndarray, width: int, take: np.ufunc) -> np.ndarray:
    """take over each run of width values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = take(values[:-step], values[step:])
        have += step
    return values


class _Document:
    """The words of one document, its candidate windows and what each level says of them."""

    def __init__(self, text: bytes | None, window: int) -> None:
        self.words, self.window = (text or b"").split(), window
        self.starts = max(0, len(self.words) - window + 1)
        if self.starts:
            self.body = b" ".join(self.words)
            self.bytes = np.frombuffer(self.body, np.uint8)
            gaps = np.flatnonzero(self.bytes == 32)
            self.first, self.end = np.append(0, gaps + 1), np.append(gaps, len(self.body))
        self.alive = np.ones(self.starts, bool)

    def grams(self, length: int) -> np.ndarray:
        """A hash of every run of so many words: a polynomial in its bytes, from sums over the text, then mixed."""
        out = np.empty(len(self.words) - length + 1, np.uint64)
        for start in range(0, len(out), _BLOCK):
            stop = min(start + _BLOCK, len(out))
            low, high = self.first[start], self.end[stop + length - 2]
            up, down = _powers(high - low + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self.bytes[low:high] * up[: high - low], out=sums[1:])
            first, end = self.first[start:stop] - low, self.end[start + length - 1 : stop + length - 1] - low
            out[start:stop] = (sums[end] - sums[first]) * down[first]
        out ^= out >> _HIGH
        out *= _MIX
        return out ^ (out >> _LOW)

    def _chosen(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the shorter windows, and for each window the least of those in it."""
        grams = self.grams(length)
        return grams, _sliding(grams, self.window - length + 1, np.minimum)

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of the shorter windows that stand for the candidates: in each the one of the least hash.

        Equal windows have equal anchors, so that an anchor found once tells that no window that it stands for repeats.
        """
        grams, chosen = self._chosen(length)
        side = self.window - length
        around = np.zeros(len(grams) + side, np.uint64)
        around[side : side + self.starts] = np.where(self.alive, chosen, 0)
        at = np.flatnonzero((grams == _sliding(around, side + 1, np.maximum)) & (grams > 0))
        return at, grams[at]

    def discard(self, length: int, single: np.ndarray) -> None:
        """Drops the candidates whose anchor of this length is at one of the positions found once."""
        if self.starts:
            grams, self.chosen = self._chosen(length)
            if len(single):
                self.alive &= ~np.isin(self.chosen, grams[single])

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, hash of the last level's anchor, hash of all words) of the candidates."""
        at = np.flatnonzero(self.alive)
        parts = zip(self.first[at].tolist(), self.end[at + self.window - 1].tolist())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(self.body[a:b]) for a, b in parts), np.uint64, len(at))
        return at, self.chosen[at], hashes

    def kept(self, first: np.ndarray) -> tuple[bytes, int]:
        """The words that stay, and the number of those removed; first: starts of the candidates found there first."""
        self.alive[first] = False
        if not self.alive.any():
            return b" ".join(self.words), 0
        marks = np.zeros(len(self.words) + 1, np.int64)
        marks[: self.starts] += self.alive
        marks[self.window : self.window + self.starts] -= self.alive
        gone = np.cumsum(marks[:-1]) > 0
        return b" ".join(w for w, g in zip(self.words, gone.tolist()) if not g), int(gone.sum())


def _numbers(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    value = batch.column(name)[row]
    return value.values.to_numpy(zero_copy_only=False).astype(np.int64) if value.is_valid else np.zeros(0, np.int64)


def _first_of_each(parts: list[tuple], hashes: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of parts (so many of hashes, then id, tag, at), a row for each hash with its first place, by place; and how often each is there."""
    columns = [np.concatenate(x) for x in zip(*parts)]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns[:hashes]:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(order)))
    by_place = np.argsort(order[first])  # rows of one document side by side take less room in the shuffle
    return [c[first[by_place]] for c in columns], count[by_place]


def _runs(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of the first row of each run, and all rows' offsets by run: rows one after another, whose last column grows by one and whose others are equal."""
    new = np.ones(len(columns[-1]), bool)
    new[1:] = columns[-1][1:] != columns[-1][:-1] + 1
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.append(first, len(new))


def _levels(window: int, base: int) -> list[int]:
    found = [base]
    while found[-1] * 2 < window:
        found.append(found[-1] * 2)
    if found[-1] * 2 != window:
        raise ValueError("the window must be the base length doubled once or more")
    return found


def _replayed(batch: pa.RecordBatch, row: int, window: int, levels: list[int]) -> _Document:
    doc = _Document(batch.column("text")[row].as_py(), window)
    for length in levels:
        doc.discard(length, _numbers(batch, f"single{length}", row))
    return doc


def _with_lists(rows: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    for name, found in lists.items():
        rows = rows.join(found.withColumnRenamed("at", name), KEY, "left")
    return rows


def _singles(rows: DataFrame, lists: dict[str, DataFrame], window: int, done: list[int], length: int) -> DataFrame:
    """(id, tag, tag2, at): positions of each document's anchors of this length that occur once in all documents."""

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = []
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in KEY))):
            doc = _replayed(batch, i, window, done)
            if doc.alive.any():
                at, hashes = doc.anchors(length)
                parts.append((hashes.view(np.int64), *(np.full(len(at), k) for k in key), at))
        if parts:
            (h, *place), n = _first_of_each(parts, 1)
            columns = [pa.array(h), pa.array(np.minimum(n, 2), pa.int32()), *(pa.array(x, t) for x, t in zip(place, (*[pa.int64()] * 3, pa.int32())))]
            yield pa.RecordBatch.from_arrays(columns, ["h", "n", *KEY, "at"])

    anchors = _with_lists(rows, lists).mapInArrow(per_batch(emit), "h long, n int, id long, tag long, tag2 long, at int")
    # the sum, mostly one, comes last: between columns that differ it would take more room in the shuffle
    alone = anchors.groupBy("h").agg(*(F.min(c).alias(c) for c in (*KEY, "at")), F.sum("n").alias("n")).where("n = 1").select(*KEY, "at")
    # the more partitions there are, the fewer positions of a document are in one: lists are made after the shuffle only
    return alone.repartition(*KEY).groupBy(*KEY).agg(F.collect_list("at").alias("at"))


def remove_repeats(docs: DataFrame, window: int = 20, base: int = 10) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): each document without the words of windows that start earlier, too.

    A window is so many consecutive words of one document; earlier is a smaller doc_id, or an earlier start in the same
    document. Level by level, windows of the base length and of its doubles are looked at: a window all of whose
    occurrences at one length are single can't repeat at the next, so only what repeats is extended to twice the
    length, and at the last length the first occurrence of each window left is found. All levels count every document;
    each moves only the least hash of the candidate windows around it, and sums by hash before and after the shuffle.
    The last moves the windows' hashes, those of windows one after another that have one anchor in one row.
    At the last length windows are told apart by 128 bits: two hashes of 64, of all their words and of their anchor.

    Null and empty texts have no words. A null doc_id counts as the largest. Rows with the same doc_id and different
    texts are different documents in the order of a hash of the text; a row repeated in full counts once and gets its
    result each time. Columns beside doc_id and text are ignored, an empty table gives no rows.
    """
    levels = _levels(window, base)
    rows, lists, done = keyed(docs).withColumn("text", F.col("text").cast("binary")), {}, []
    for length in levels:
        lists[f"single{length}"] = settled(_singles(rows, lists, window, done, length))
        done.append(length)

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = []
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in KEY))):
            doc = _replayed(batch, i, window, levels)
            if doc.alive.any():
                at, anchor, hashes = doc.whole()
                parts.append((anchor.view(np.int64), hashes.view(np.int64), *(np.full(len(at), k) for k in key), at))
        if parts:
            (anchor, hashes, *place), _ = _first_of_each(parts, 2)
            found, offsets = _runs([anchor, *place])
            columns = [pa.array(x, t) for x, t in zip(found, (*[pa.int64()] * 4, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hashes)], ["anchor", *KEY, "at", "hashes"])

    kind = "anchor long, id long, tag long, tag2 long, at int, hashes array<long>"
    whole = _with_lists(rows, lists).mapInArrow(per_batch(emit), kind)
    # each batch has a window once, so nothing is left to sum before the shuffle; windows of one anchor stay together,
    # and those that start one after another are one row, which has their anchor and place once
    whole = whole.repartition("anchor").select("anchor", *KEY, "at", F.posexplode("hashes").alias("next", "hash"))
    first = whole.groupBy("anchor", "hash").agg(F.min(F.struct(*KEY, (F.col("at") + F.col("next")).alias("at"))).alias("at")).select("at.*")
    first = first.groupBy(*KEY).agg(F.collect_list("at").alias("at"))

    def rest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, counts, removed = [], [], []
        for i in range(batch.num_rows):
            doc = _replayed(batch, i, window, levels)
            text, gone = doc.kept(_numbers(batch, "first", i))
            kept.append(text)
            counts.append(len(doc.words))
            removed.append(gone)
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_text"])

    return _with_lists(rows, lists | {"first": first}).mapInArrow(per_batch(rest), "doc_id long, n_words long, n_removed long, kept_text string")
