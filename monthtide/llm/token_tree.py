"""Token counts that follow edits: a segment tree over the pre-tokens of each document."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from monthtide.llm.common import per_batch, tidy

#: Pre-tokens in a new leaf; a tree is built anew when a leaf has this many times more.
LEAF, GROWTH = 32, 8
#: Characters before a place on which the pre-token boundaries after it can depend: the longest look-ahead of the patterns.
CONTEXT = 4
#: Distinct pre-tokens whose counts a task remembers.
_MEMO = 1 << 20


class Counter:
    """The number of tokens of pre-tokens, under the ranks of a vocabulary file and the pattern that splits texts."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.find = regex.compile(pattern)
        self.memo: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.find.findall(text)

    def __call__(self, pieces: Sequence[str]) -> int:
        total, memo = 0, self.memo
        for p in pieces:
            n = memo.get(p)
            if n is None:
                if len(memo) >= _MEMO:
                    memo.clear()
                n = memo[p] = len(self.encoding.encode_ordinary(p))
            total += n
        return total


class TokenTree:
    """The leaves of a document, each a run of whole pre-tokens, under two trees of sums: characters and tokens.

    An edit goes down the tree to the leaves that it touches. These, with the context before them and as many leaves
    after them as it takes until old and new pre-token boundaries meet, are split and counted anew; all others keep
    their counts. The sums on the paths from the new leaves to the root are then updated.
    """

    def __init__(self, texts: list[str], tokens: list[int]) -> None:
        self.size = 1
        while self.size < max(1, len(texts)):
            self.size *= 2
        self.texts = texts + [""] * (self.size - len(texts))
        self.chars = [0] * self.size + [len(t) for t in self.texts]
        self.tokens = [0] * self.size + tokens + [0] * (self.size - len(tokens))
        for node in range(self.size - 1, 0, -1):
            self._add_up(node)

    @classmethod
    def built(cls, text: str, count: Counter) -> TokenTree:
        pieces = count.split(text)
        runs = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)]
        return cls(["".join(r) for r in runs], [count(r) for r in runs])

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a place; the last one with text for a place at the end."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def edit(self, start: int, end: int, new: str, count: Counter) -> int:
        """Puts new in the place of the characters from start to end, both cut to the text; the characters split anew."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, at = self.leaf_at(max(0, start - CONTEXT))
        last, last_at = self.leaf_at(max(start, end))
        before = "".join(self.texts[first : last + 1])
        body = before[: start - at] + new + before[end - at :]
        while True:
            # the next leaf with text is there to look ahead to; the split is right once a boundary meets its start
            ahead = last + 1
            while ahead < self.size and not self.texts[ahead]:
                ahead += 1
            more = self.texts[ahead] if ahead < self.size else ""
            if len(more) <= CONTEXT and ahead < self.size:
                last, body = ahead, body + more
                continue
            pieces, place = [], 0
            for m in count.find.finditer(body + more):
                if place >= len(body):
                    break
                pieces.append(m[0])
                place = m.end()
            if place == len(body):
                break
            last, body = ahead, body + more
        self._replace(first, last, pieces, count)
        return len(body)

    def _replace(self, first: int, last: int, pieces: list[str], count: Counter) -> None:
        slots = last - first + 1
        if len(pieces) > slots * LEAF * GROWTH:
            left = [(t, n) for t, n in zip(self.texts[:first], self.tokens[self.size : self.size + first]) if t]
            right = [(t, n) for t, n in zip(self.texts[last + 1 :], self.tokens[self.size + last + 1 :]) if t]
            runs = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)]
            whole = left + [("".join(r), count(r)) for r in runs] + right
            self.__init__([t for t, _ in whole], [n for _, n in whole])
            return
        step = max(1, -(-len(pieces) // slots))
        for k in range(slots):
            run = pieces[k * step : (k + 1) * step]
            leaf = first + k
            self.texts[leaf] = "".join(run)
            self.chars[self.size + leaf] = len(self.texts[leaf])
            self.tokens[self.size + leaf] = count(run)
        low, high = (self.size + first) // 2, (self.size + last) // 2
        while low:
            for node in range(low, high + 1):
                self._add_up(node)
            low, high = low // 2, high // 2

    def leaves(self) -> tuple[list[str], list[int]]:
        kept = [(t, n) for t, n in zip(self.texts, self.tokens[self.size :]) if t]
        return [t for t, _ in kept], [n for _, n in kept]


def _mapped(rows: DataFrame, path: str, pattern: str, work: Callable[[pa.RecordBatch, Counter], Iterable[pa.RecordBatch]], schema: object) -> DataFrame:
    with open(path, "rb") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(vocabulary, pattern)
        yield from per_batch(lambda batch: work(batch, count))(batches)

    return rows.mapInArrow(tidy(run), schema)


def token_trees(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns of docs but text, then leaves (the runs of pre-tokens), leaf_tokens (their counts) and n_tokens, in place of any so named.

    path is a file of byte-pair ranks and pattern the regular expression that cuts texts into pre-tokens. Null and
    empty texts have no leaves and no tokens. Every row has a tree of its own, repeated rows as well.
    """
    others = [c for c in docs.columns if c not in ("text", "leaves", "leaf_tokens", "n_tokens")]

    def work(batch: pa.RecordBatch, count: Counter) -> Iterable[pa.RecordBatch]:
        found = [TokenTree.built(t or "", count) for t in batch.column("text").to_pylist()]
        kept = [t.leaves() for t in found]
        columns = [*(batch.column(c) for c in others), pa.array([x[0] for x in kept], pa.list_(pa.string())), pa.array([x[1] for x in kept], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([t.n_tokens for t in found], pa.int64())], [*others, "leaves", "leaf_tokens", "n_tokens"])

    kind = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), "leaves array<string>, leaf_tokens array<int>, n_tokens long"])
    return _mapped(docs.select(*others, "text"), path, pattern, work, kind)


def edited(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """trees with its edits done: all columns but edits, with leaves, leaf_tokens and n_tokens as they are now, and n_reencoded.

    edits is an array of (start, end, text) structs, done in their order; places are code points of the text as the
    edits before have left it, cut to its length. A null or empty list changes nothing, null fields are 0 or empty.
    n_reencoded is the number of characters that were split and counted again.
    """
    others = [c for c in trees.columns if c not in ("leaves", "leaf_tokens", "n_tokens", "n_reencoded", "edits")]

    def work(batch: pa.RecordBatch, count: Counter) -> Iterable[pa.RecordBatch]:
        leaves, tokens, totals, again = [], [], [], []
        lists = (batch.column(c).to_pylist() for c in ("leaves", "leaf_tokens", "edits"))
        for texts, counts, edits in zip(*lists):
            tree = TokenTree(texts or [], counts or [])
            again.append(sum(tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "", count) for e in edits or () if e))
            kept = tree.leaves()
            leaves.append(kept[0])
            tokens.append(kept[1])
            totals.append(tree.n_tokens)
        new = [pa.array(leaves, pa.list_(pa.string())), pa.array(tokens, pa.list_(pa.int32())), pa.array(totals, pa.int64()), pa.array(again, pa.int64())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *new], [*others, "leaves", "leaf_tokens", "n_tokens", "n_reencoded"])

    kind = ", ".join([*(f"`{c}` {trees.schema[c].dataType.simpleString()}" for c in others), "leaves array<string>, leaf_tokens array<int>, n_tokens long, n_reencoded long"])
    return _mapped(trees, path, pattern, work, kind)
