"""Code length of texts under context-tree weighting, beside a smoothed unigram model of words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import log, log10, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import most_frequent, settled, slices, tidy

#: Bytes of context.
DEPTH = 5
#: Contexts of this depth are dealt to classes; all deeper ones lie in the class of their last bytes.
ROOT = 3
CLASSES = 1 << 10
#: Slots of the tables of the depths from 1 on, as powers of two: the model has 58 MB, whatever the corpus.
SLOT_BITS = {1: 16, 2: 20, 3: 22, 4: 23, 5: 24}
#: Words whose counts every task has; the others are joined.
COMMON_WORDS = 1 << 16
#: Entries of a task's memory of n-grams that it has scored.
_MEMO = 1 << 21
#: Bytes of texts that are worked on at once, and bytes whose n-grams are looked up at once.
_SLICE, _BLOCK = 4 << 20, 1 << 17
_SCALE, _ZERO = 10.0, 128
_MIX = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _grams(bodies: list[bytes], depth: int) -> np.ndarray:
    """For every byte of the bodies: the byte, below the bytes before it, the nearest lowest; line ends stand before a body."""
    pad = b"\n" * depth
    data = np.frombuffer(b"".join(pad + b for b in bodies), np.uint8)
    out = data[depth:].astype(np.uint64)
    for back in range(1, depth + 1):
        out |= data[depth - back : len(data) - back].astype(np.uint64) << _U(8 * back)
    inside = np.ones(len(out), bool)
    place = 0
    for b in bodies[:-1]:
        place += len(b)
        inside[place : place + depth] = False
        place += depth
    return out[inside]


def _hash(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> _U(32)
    x *= _MIX
    return x ^ (x >> _U(29))


def classes(context: np.ndarray) -> np.ndarray:
    """The class of a context's last bytes."""
    return _hash(context & _U((1 << 8 * ROOT) - 1)) >> _U(54)


def places(context: np.ndarray, depth: int, number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What slots() needs of a context at a depth: its last bytes with room for a node, and the start of its class's range."""
    context = (context & _U((1 << 8 * depth) - 1)) << _U(8)
    if depth < ROOT:
        return context, np.zeros(1, np.uint64)
    number = classes(context >> _U(8)) if number is None else number
    return context + _U(depth << 60), number << _U(SLOT_BITS[depth] - 10)


def slots(place: tuple[np.ndarray, np.ndarray], node: np.ndarray, depth: int) -> np.ndarray:
    """The slot of a bit's node (1, then the bits before it) in the table of a context depth; one class has a range of its own."""
    context, start = place
    if depth < 2:
        return (context | node).astype(np.int64)
    bits = SLOT_BITS[depth] - (10 if depth >= ROOT else 0)
    return (start | _hash(context | node) >> _U(64 - bits)).astype(np.int64)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of values from 0.5 on, by Stirling's series after six steps up."""
    steps = np.ones_like(x)
    for k in range(6):
        steps *= x + k
    z = x + 6
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * log(2 * pi) + series - np.log(steps)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - log(pi) - _log_gamma(zeros + ones + 1)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of the values over each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(keys) else v for v in values)


def leaves(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context << 8 | node, zeros, ones) of the nodes at full depth."""
    byte, context = grams & _U(255), grams >> _U(8)
    keys, zeros, ones = [], [], []
    for bit in range(8):
        node = _U(1 << bit) | byte >> _U(8 - bit)
        one = (byte >> _U(7 - bit) & _U(1)).astype(float)
        keys.append(context << _U(8) | node)
        zeros.append(counts * (1 - one))
        ones.append(counts * one)
    return _summed(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(log of the weighted probability, log-odds that the tree ends here) of nodes; below: the sum of the former over a node's children."""
    own = log_estimate(zeros, ones)
    if below is None:
        return own, np.full(len(own), 30.0)
    return np.logaddexp(own, below) - log(2), own - below


def up(keys: np.ndarray, depth: int, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The nodes of one depth less, with sums over their children."""
    mask = _U((1 << 8 * depth) - 1)  # of the shorter context and the node
    return _summed(keys & mask, *values)


def packed(depth: int, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, odds: np.ndarray, offset: int, size: int) -> bytes:
    """Two bytes for each slot from offset on: log-odds of a one (0: never seen) and of the tree's end. Nodes that share a slot are one."""
    at, zeros, ones, odds = _summed(slots(places(keys >> _U(8), depth), keys & _U(255), depth), zeros, ones, odds)
    out = np.zeros((size, 2), np.uint8)
    out[at - offset, 0] = _code(np.log((ones + 0.5) / (zeros + 0.5)))
    out[at - offset, 1] = _code(odds)
    return out.tobytes()


def _code(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(odds * _SCALE) + _ZERO, 1, 255).astype(np.uint8)


_PROBABILITY = 1 / (1 + np.exp(-(np.arange(256) - _ZERO) / _SCALE))


class Model:
    """The tables of all depths, and a task's memory of what it has scored."""

    def __init__(self, tables: dict[int, bytes | bytearray], depth: int = DEPTH) -> None:
        self.depth = depth
        self.tables = {d: np.frombuffer(t, np.uint8).reshape(-1, 2) for d, t in tables.items()}
        self.keys = np.full(_MEMO, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.zeros(_MEMO, np.float32)

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 of the probability of each gram's byte after its context."""
        out = np.empty(len(grams), np.float32)
        for start in range(0, len(grams), _BLOCK):
            part = grams[start : start + _BLOCK]
            at = (_hash(part) >> _U(64 - 21)).astype(np.int64)
            got = self.values[at]
            missing = np.flatnonzero(self.keys[at] != part)
            if len(missing):
                new, where = np.unique(part[missing], return_inverse=True)
                found = self._log2(new).astype(np.float32)
                got[missing] = found[where]
                place = (_hash(new) >> _U(64 - 21)).astype(np.int64)
                self.keys[place] = new
                kept = self.keys[place] == new  # of those that share a place the last stays
                self.values[place[kept]] = found[kept]
            out[start : start + len(part)] = got
        return out

    def _log2(self, grams: np.ndarray) -> np.ndarray:
        byte, context = grams & _U(255), grams >> _U(8)
        number = classes(context)
        at = [places(context, d, number) for d in range(self.depth + 1)]
        total = np.zeros(len(grams))
        for bit in range(8):
            node = _U(1 << bit) | byte >> _U(8 - bit)
            one = (byte >> _U(7 - bit) & _U(1)).astype(bool)
            mixed, below = np.full(len(grams), 0.5), np.zeros(len(grams), bool)
            for depth in range(self.depth, -1, -1):
                entry = self.tables[depth][slots(at[depth], node, depth)]
                seen = entry[:, 0] > 0
                own = _PROBABILITY[entry[:, 0]]
                ends = np.where(below, _PROBABILITY[entry[:, 1]], 1.0)
                mixed = np.where(seen, ends * own + (1 - ends) * mixed, 0.5)
                below = seen
            total += np.log2(np.where(one, mixed, 1 - mixed))
        return total


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning; a row without doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 1, F.lit(False))


def _bodies(texts: Iterable[str | None]) -> list[bytes]:
    return [b" ".join(tokens_of(t)) + b"\n" for t in texts]


def gram_counts(training: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n): counts of all n-grams of depth + 1 bytes of the training texts; each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed(np.concatenate([k for k, _ in kept]), np.concatenate([n for _, n in kept]))

        def out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])

        for batch in batches:
            for piece in slices(batch, _SLICE):
                kept.append(np.unique(_grams(_bodies(piece.column("text").to_pylist()), depth), return_counts=True))
                if sum(len(k) for k, _ in kept) > 1 << 22:
                    kept = [merged()]
                    if len(kept[0][0]) > 1 << 21:
                        yield out(*kept.pop())
        if kept:
            yield out(*merged())

    return training.select("text").mapInArrow(tidy(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def trained(training: DataFrame, depth: int = DEPTH) -> dict[int, bytes | bytearray]:
    """The model's tables, from the n-grams of all training texts.

    The tree is weighed from its leaves: the weighted probability of a node is the mean of its own estimate and the
    product of its children's. Contexts with the same last ROOT bytes lie in one class; each class weighs its part of
    the tree and gives its range of the slots, and the nodes above it are summed by node. What reaches the driver are
    the tables, whose size is fixed, and the nodes of the two upper depths. Nodes that share a slot share their counts.
    """
    counts = gram_counts(training, depth)
    last = F.col("gram").bitwiseAND(F.lit(((1 << 8 * ROOT) - 1) << 8))

    def part(table: pa.Table) -> pa.Table:
        grams = table.column("gram").to_numpy().view(np.uint64)
        keys, zeros, ones = leaves(grams, table.column("n").to_numpy().astype(float))
        number = int(classes(grams[:1] >> _U(8))[0])
        below, rows = None, []
        for d in range(depth, ROOT - 1, -1):
            weight, odds = weigh(zeros, ones, below)
            size = 1 << (SLOT_BITS[d] - 10)
            rows.append((d, number, packed(d, keys, zeros, ones, odds, number * size, size), 0, 0.0, 0.0, 0.0))
            keys, zeros, ones, below = up(keys, d, zeros, ones, weight)
        rows += [(-1, 0, b"", int(k), z, o, b) for k, z, o, b in zip(keys, zeros, ones, below)]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    names = ["depth", "number", "table", "key", "zeros", "ones", "below"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    schema = "depth int, number long, table binary, key long, zeros double, ones double, below double"
    parts = settled(counts.withColumn("class", _class(last)).groupBy("class").applyInArrow(part, schema))
    tables = {d: bytearray(2 << SLOT_BITS[d]) for d in range(ROOT, depth + 1)}
    for row in parts.where("depth >= 0").select("depth", "number", "table").toLocalIterator():
        size = len(row["table"])
        tables[row["depth"]][row["number"] * size : (row["number"] + 1) * size] = row["table"]
    top = parts.where("depth < 0").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below"))).toPandas()
    keys = top["key"].to_numpy().astype(np.int64).view(np.uint64)
    zeros, ones, below = (top[c].to_numpy().astype(float) for c in ("zeros", "ones", "below"))
    order = np.argsort(keys)
    keys, zeros, ones, below = keys[order], zeros[order], ones[order], below[order]
    for d in range(ROOT - 1, -1, -1):
        weight, odds = weigh(zeros, ones, below)
        tables[d] = packed(d, keys, zeros, ones, odds, 0, 1 << SLOT_BITS[d] if d else 256)
        if d:
            keys, zeros, ones, below = up(keys, d, zeros, ones, weight)
    return tables


def _class(last: Column) -> Column:
    """The class of a gram's last context bytes: the same hash as classes()."""

    @F.pandas_udf("long")
    def of(x):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(classes(x.to_numpy().view(np.uint64) >> _U(8)).astype(np.int64))

    return of(last)


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c): counts of all words of the training texts, as bytes in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for piece in slices(batch, _SLICE):
                for text in piece.column("text").to_pylist():
                    seen.update(tokens_of(text))
                if len(seen) > 1 << 20:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return training.select("text").mapInArrow(tidy(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def code_lengths(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row of docs.

    Tokens are the words in lower case (A-Z only) and one end. score is log10 of the probability that context-tree
    weighting gives to the words joined by blanks and a line end, byte by byte; bits_per_byte the code length per byte.
    base_score sums the smoothed unigram probabilities of the tokens. Both learn from all rows that aren't held out.

    Null and empty texts have the end alone. Rows without doc_id are learned from; repeated rows are counted and scored
    each; without training rows each bit costs one; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = settled(word_counts(training))
    ends = training.count()
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    size, distinct = total + ends, kinds + (ends > 0)
    tables = docs.sparkSession.sparkContext.broadcast(trained(training, depth))
    common = {bytes(r["word"]): r["c"] for r in most_frequent(counts, COMMON_WORDS, "c")}
    common = docs.sparkSession.sparkContext.broadcast(common)
    scale = log10(size + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(tables.value, depth)
        chance = {w: log10(c + 0.5) for w, c in common.value.items()}.get
        end = log10(ends + 0.5)
        for batch in batches:
            for piece in slices(batch, _SLICE):
                split = [tokens_of(t) for t in piece.column("text").to_pylist()]
                bodies = [b" ".join(w) + b"\n" for w in split]
                lengths = np.array([len(b) for b in bodies], np.int64)
                bits = np.add.reduceat(model.log2(_grams(bodies, depth)), np.cumsum(lengths) - lengths, dtype=np.float64)
                base, known, rare, numbers, bounds = [], [], [], [], [0]
                for w in split:
                    chances = list(map(chance, w))
                    if None in chances:
                        rest = Counter(x for x, c in zip(w, chances) if c is None)
                        rare.extend(rest)
                        numbers.extend(rest.values())
                        chances = [c for c in chances if c is not None]
                    base.append(end + sum(chances))
                    known.append(len(chances) + (ends > 0))
                    bounds.append(len(rare))
                entries = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(numbers, pa.int64())], ["word", "n"])
                columns = [
                    piece.column("doc_id"),
                    piece.column("held_out"),
                    pa.array([len(w) + 1 for w in split], pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(bits * log10(2), pa.float64()),
                    pa.array(-bits / lengths, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), entries),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "known", "base", "score", "bits_per_byte", "rare"])

    schema = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, bits_per_byte double, rare array<struct<word: binary, n: bigint>>"
    scored = settled(rows.mapInArrow(tidy(run), schema).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.inline("rare"))
    found = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
    )
    out = scored.drop("rare").join(found, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(size).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"),
        "score",
        "bits_per_byte",
    )
