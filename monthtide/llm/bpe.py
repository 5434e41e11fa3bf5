"""Byte-pair encoding through a minimal automaton of frequent words, and decoding."""

from __future__ import annotations

import json
import os
import re
import tempfile
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.llm.common import most_frequent, settled, slices, tidy

#: Words in the lexicon. It decides how many words are merged anew, never what they become.
LEXICON_WORDS = 1 << 15
#: Distinct pieces that a task remembers at once, and bytes of texts that it encodes at once.
_KNOWN = 1 << 19
_SLICE = 4 << 20
#: Pieces that are merged together, and bytes beyond which a piece is merged alone, by a heap.
_TOGETHER = 1 << 15
_LONG = 64


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Vocabulary:
    """A BPE model with word ends: pieces to ids by merging, ids to tokens. Read from a tokenizer's JSON file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = said["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()} | {a["id"]: a["content"] for a in said["added_tokens"]}
        self.added = {a["content"]: a["id"] for a in said["added_tokens"]}
        letters = _byte_letters()
        self.inner = [ids[x] for x in letters]
        self.last = [ids[x + self.suffix] for x in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.results = [ids[a + b] for a, b in pairs]
        split = next(p for p in said["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]

        order = sorted((a << 32 | b, rank) for (a, b), rank in self.ranks.items())
        self._pairs = np.array([*(k for k, _ in order), 1 << 62], np.int64)
        self._ranks = np.array([*(r for _, r in order), 0], np.int64)
        self._inner, self._last, self._results = (np.array(x, np.int64) for x in (self.inner, self.last, self.results))

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one piece: the pair of lowest rank is merged, leftmost first, until none is left.

        A heap of (rank, place) over linked places finds it, so that time grows little faster than length.
        """
        ids = [self.inner[b] for b in piece[:-1]]
        ids.append(self.last[piece[-1]])
        size, rank = len(ids), self.ranks.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, at) for at, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapify(heap)
        while heap:
            best, at = heappop(heap)
            gone = after[at]
            if gone >= size or rank((ids[at], ids[gone])) != best:
                continue  # one of the two was merged meanwhile
            ids[at], ids[gone], after[at] = self.results[best], -1, after[gone]
            if after[at] < size:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < size and (r := rank((ids[left], ids[after[left]]))) is not None:
                    heappush(heap, (r, left))
        return [i for i in ids if i >= 0]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        place = np.searchsorted(self._pairs, pair)
        return np.where(self._pairs[place] == pair, self._ranks[place], len(self.results))

    def merged_together(self, pieces: list[bytes]) -> list[list[int]]:
        """The same for many short pieces: in each round, every piece that has a pair to merge merges its first of lowest rank.

        The ids of all pieces lie in one array, a piece's rank at a place is that of the pair which begins there.
        """
        none = len(self.results)
        lengths = np.array([len(p) for p in pieces])
        body = np.frombuffer(b"".join(pieces), np.uint8)
        last = np.cumsum(lengths) - 1
        ids = self._inner[body]
        ids[last] = self._last[body[last]]
        ranks = np.append(self._rank(ids[:-1], ids[1:]), none)
        ranks[last] = none
        piece = np.arange(len(pieces))
        out: list[list[int]] = [[]] * len(pieces)
        bits = len(body).bit_length()
        while len(piece):
            first = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(ranks << bits | np.arange(len(ranks)), first)
            more = best >> bits < none
            ended = np.flatnonzero(~more)
            for k, start, stop in zip(piece[ended].tolist(), first[ended].tolist(), (first + lengths)[ended].tolist()):
                out[k] = ids[start:stop].tolist()
            at = best[more] & ((1 << bits) - 1)
            ids[at] = self._results[best[more] >> bits]
            keep = np.repeat(more, lengths)
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            ids, ranks, piece, lengths = ids[keep], ranks[keep], piece[more], lengths[more] - 1
            last = np.cumsum(lengths) - 1
            ranks[at] = none
            right = at[at < last]
            ranks[right] = self._rank(ids[right], ids[right + 1])
            left = at[at > last + 1 - lengths] - 1
            ranks[left] = self._rank(ids[left], ids[left + 1])
        return out


class Splitter:
    """Texts to pieces as the file's normaliser and splitter do; the added tokens' strings are pieces of their own."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.find = regex.compile(vocabulary.pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True))) + ")") if vocabulary.added else None
        self.marks = tuple(vocabulary.added)
        letters, numbers, blanks = (re.escape("".join(regex.findall(kind, "".join(map(chr, range(256)))))) for kind in (r"\p{L}", r"\p{N}", r"\s"))
        plain = vocabulary.pattern.replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{numbers}]").replace(r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{numbers}]")
        self.find_latin = self.find if "\\p" in plain else re.compile(plain).findall  # the same for texts of the first 256 characters, faster

    def __call__(self, text: str | None) -> list[str]:
        text = text or ""
        if self.special is None or not any(m in text for m in self.marks):
            return self._plain(text)
        out = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.find_latin(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # str.lower alone has a rule for word ends
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.find_latin(text)


class Lexicon:
    """A minimal acyclic automaton over the bytes of words, whose arrays can be mapped from a file.

    Equal suffixes share their states. Each edge knows how many words come before those that go through it, so that a
    path gives the number of its word, and that number the ids: the output of the transducer.
    """

    NAMES = ("keys", "targets", "skips", "final", "starts", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.__dict__.update(arrays)

    @classmethod
    def compiled(cls, outputs: dict[bytes, list[int]]) -> Lexicon:
        words = sorted(w for w in outputs if w)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []
        counts: list[int] = []
        path: list[list] = [[False, []]]  # of the word before: for each depth, whether a word ends there, and the closed edges

        def close(depth: int) -> None:
            while len(path) > depth:
                final, edges = path.pop()
                key = (final, tuple(edges))
                if key not in register:
                    register[key] = len(states)
                    states.append(key)
                    counts.append(final + sum(counts[t] for _, t in edges))
                if path:
                    path[-1][1].append((before[len(path) - 1], register[key]))

        before = b""
        for word in words:
            same = len(os.path.commonprefix([before, word]))
            close(same + 1)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0] = True
            before = word
        close(0)
        keys, targets, skips = [], [], []
        for state, (final, edges) in enumerate(states):
            skip = int(final)
            for byte, target in edges:
                keys.append(state << 8 | byte)
                targets.append(target)
                skips.append(skip)
                skip += counts[target]
        ids = [outputs[w] for w in words]
        return cls(
            {
                "keys": np.array([*keys, 1 << 62], np.int64),
                "targets": np.array([*targets, 0], np.int32),
                "skips": np.array([*skips, 0], np.int32),
                "final": np.array([f for f, _ in states], bool),
                "starts": np.cumsum([0, *map(len, ids)], dtype=np.int64),
                "ids": np.array([i for x in ids for i in x], np.int32),
            }
        )

    def save(self, path: str) -> None:
        """One file: a line that names the arrays, then the arrays at multiples of 64 bytes."""
        place, head = 4096, []
        with open(path, "wb") as f:
            for name in self.NAMES:
                array = getattr(self, name)
                head.append([name, array.dtype.str, len(array), place])
                f.seek(place)
                f.write(array.tobytes())
                place += -(-array.nbytes // 64) * 64
            f.seek(0)
            f.write(json.dumps(head).encode())
            f.truncate(place)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            head = json.loads(f.read(4096).rstrip(b"\0"))
        return cls({n: np.memmap(path, kind, "r", place, (size,)) if size else np.zeros(0, kind) for n, kind, size, place in head})

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that aren't in the lexicon; all words go ahead byte by byte together."""
        found = np.full(len(words), -1, np.int64)
        if not len(self.final) or not words:
            return found
        lengths = np.array([len(w) for w in words])
        body = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(lengths) - lengths
        alive = np.flatnonzero(lengths > 0)
        state = np.full(len(alive), len(self.final) - 1, np.int64)  # the root is closed last
        number = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            key = (state << 8) | body[at[alive] + step]
            edge = np.searchsorted(self.keys, key)
            good = self.keys[edge] == key
            alive, edge = alive[good], edge[good]
            state, number = self.targets[edge].astype(np.int64), number[good] + self.skips[edge]
            step += 1
            ended = lengths[alive] == step
            done = ended & self.final[state]
            found[alive[done]] = number[done]
            alive, state, number = alive[~ended], state[~ended], number[~ended]
        return found


def frequent_pieces(docs: DataFrame, vocabulary: Vocabulary, count: int) -> list[str]:
    """The most frequent pieces of all texts, those found twice at least, in order; of equally frequent ones all or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Splitter(vocabulary), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["piece", "n"])

        for batch in batches:
            for text in batch.column("text"):
                seen.update(split(text.as_py()))
                if len(seen) > _KNOWN:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    seen = docs.select("text").mapInArrow(tidy(run), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    found = most_frequent(settled(seen.where("n > 1")), count)
    return [r["piece"] for r in sorted(found, key=lambda r: (-r["n"], r["piece"]))]


def lexicon_file(docs: DataFrame, vocabulary: Vocabulary, count: int = LEXICON_WORDS) -> str:
    """The name of a file of the session that holds the lexicon of the most frequent pieces of docs; executors fetch it once each."""
    pieces = [p for p in frequent_pieces(docs, vocabulary, count) if p not in vocabulary.added]
    folder = tempfile.mkdtemp(prefix="lexicon-")
    path = os.path.join(folder, f"lexicon-{uuid.uuid4().hex}.bin")
    Lexicon.compiled({p.encode(): vocabulary.merged(p.encode()) for p in pieces}).save(path)
    docs.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


class Encoder:
    """Encodes batches of texts: each piece not seen lately is looked up in the lexicon, or else merged."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon, self.split = vocabulary, lexicon, Splitter(vocabulary)
        self.bounds, self.ids = lexicon.starts.tolist(), lexicon.ids.tolist()
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}  # of a piece, under which its ids and its text are found below
        self.flat, self.starts, self.texts = array("i"), array("q", [0]), []

    def _unseen(self, raw: list[bytes]) -> Iterator[list[int]]:
        for start in range(0, len(raw), _TOGETHER):
            some = raw[start : start + _TOGETHER]
            short = iter(self.vocabulary.merged_together([p for p in some if len(p) <= _LONG]))
            yield from (next(short) if len(p) <= _LONG else self.vocabulary.merged(p) for p in some)

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        tokens, added = self.vocabulary.tokens, self.vocabulary.added
        places = self.lexicon.find(raw).tolist()
        merged = self._unseen([p for p, found in zip(raw, places) if found < 0])
        for piece, found in zip(pieces, places):
            ids = next(merged) if found < 0 else self.ids[self.bounds[found] : self.bounds[found + 1]]
            if piece in added:
                ids = [added[piece]]
            self.number[piece] = len(self.texts)
            self.flat.extend(ids)
            self.starts.append(len(self.flat))
            self.texts.append(" ".join([tokens[i] for i in ids]))

    def __call__(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts, where each text's ids start, with the end, and the tokens of each text joined by blanks)."""
        split = [self.split(t) for t in texts]
        new = {p for x in split for p in x if p not in self.number}
        if new and len(self.number) + len(new) > _KNOWN:
            self._forget()
            new = {p for x in split for p in x}
        self._learn(list(new))
        number, text = self.number.__getitem__, self.texts.__getitem__
        numbers = [list(map(number, x)) for x in split]
        decoded = [" ".join(map(text, x)) for x in numbers]
        at = np.fromiter(chain.from_iterable(numbers), np.int64, sum(map(len, numbers)))
        starts = np.frombuffer(self.starts, np.int64).copy()
        lengths = starts[at + 1] - starts[at]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - lengths), lengths)
        ids = np.frombuffer(self.flat, np.int32).copy()[places] if len(places) else np.zeros(0, np.int32)
        bounds = np.append(0, ends)[np.cumsum([0, *map(len, numbers)])]
        return ids, bounds, decoded


def encode_decode(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """All columns of docs but text, then ids (array of int) and decoded (the tokens of the ids, joined by blanks), in place of any so named.

    path is a tokenizer's JSON file: BPE with word ends over bytes, no decoder. The most frequent pieces of all of docs
    are compiled into a lexicon that tasks map into memory; other pieces are merged exactly. The ids are those of the
    tokenizers library without special tokens added, whatever the lexicon holds.
    Null and empty texts have no ids and decode to the empty text; every row gives one row, repeated rows as well.
    """
    vocabulary = Vocabulary(path)
    name = lexicon_file(docs, vocabulary, lexicon_words)
    others = [c for c in docs.columns if c not in ("text", "ids", "decoded")]
    schema = docs.select(*others).schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, Lexicon.mapped(SparkFiles.get(name)))

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            ids, bounds, decoded = encoder(batch.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(decoded, pa.string())], [*others, "ids", "decoded"])

        for batch in batches:
            for piece in slices(batch, _SLICE):
                yield from work(piece)

    return docs.select(*others, "text").mapInArrow(tidy(run), schema)
