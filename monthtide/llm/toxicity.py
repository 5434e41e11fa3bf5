"""Toxicity of clauses, by composed transducers over classes of words with learned weights."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import most_frequent, per_batch, settled

#: Labelled rows, at most, from which lexicon and weights are learned.
SAMPLE_ROWS = 40_000
#: Patterns that the lexicon has at most, those of the greatest weights.
LEXICON_SIZE = 20_000
#: Lengths of the word beginnings that are patterns beside whole words.
STEMS = (3, 4, 5, 6)
#: Documents that a pattern is in at least, and its least weight (log of the ratio of its rates, less 2 / sqrt(documents)).
LEAST_DOCS, LEAST_WEIGHT = 4, 2.5
#: Weight above which a word's match is a feature of its own.
SURE = 4.0
#: Toxic texts in the lexicon's half below which all texts give the lexicon, and no weights are fitted.
FEW_TOXIC = 12
#: The weights of features then.
FEW_WEIGHTS = {"bias": -LEAST_WEIGHT - 1, "top": 1.0, "share": 1.0}

# Word lists of the grammar's classes, in English, German, French and Spanish.
THREATS = "kill hurt destroy crush beat burn shoot stab töten verletzen zerstören schlagen tuer frapper détruire brûler matar golpear destruir quemar".split()
TARGETS = "you your yours yourself u they them their he she him her du dich dir dein deine ihr euch sie tu te toi ton ta vous votre ils elles usted ustedes tú tus ellos ellas".split()
NEGATIONS = "not no never none nobody isn't aren't wasn't don't doesn't didn't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say saying called calls quoted quote wrote writes told tells reported claimed sagte sagt schrieb nannte dit disait écrit dijo dice decía escribió llamó".split()

_OTHER, _INSULT, _THREAT, _TARGET, _NEGATION, _REPORT = range(6)
_CLASSES = {w: c for words, c in ((THREATS, _THREAT), (TARGETS, _TARGET), (NEGATIONS, _NEGATION), (REPORTS, _REPORT)) for w in words}
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_EDGES = "\"'`´“”„«»‘’()[]{}<>.,;:!?¡¿*#$%&|~_-+=/\\"
_FORM_FEATURES = ("bias", "best", "top", "sure", "total", "clauses", "threat", "targeted", "negated", "reported", "share")


def forms(word: str) -> list[str]:
    """The patterns that a word can match: itself, and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def folded_words(text: str | None) -> list[str]:
    """The words of a text in lower case, without marks around them."""
    return [w for w in (x.strip(_EDGES) for x in (text or "").lower().split()) if w]


#: Words over which a negation reaches; reported speech reaches to the clause's end.
REACH = 3

#: A word's class with the marks that the transducers before have put on it.
Symbol = tuple[int, frozenset]


@dataclass(frozen=True)
class Transducer:
    """States, numbered from 0, where it starts; arcs from (state, symbol read) to (next state, symbol written)."""

    arcs: dict[tuple[int, Hashable], tuple[int, Hashable]]

    def run(self, symbols: Iterable[Hashable]) -> list[Hashable]:
        """What is written for what is read."""
        state, out = 0, []
        for symbol in symbols:
            state, written = self.arcs[state, symbol]
            out.append(written)
        return out


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that writes what second writes for what first writes; it has those pairs of states that are reached."""
    read = sorted({symbol for state, symbol in first.arcs if state == 0}, key=repr)
    numbers, arcs, open_pairs = {(0, 0): 0}, {}, [(0, 0)]
    for pair in open_pairs:
        for symbol in read:
            one, passed = first.arcs[pair[0], symbol]
            two, written = second.arcs[pair[1], passed]
            if (one, two) not in numbers:
                numbers[one, two] = len(numbers)
                open_pairs.append((one, two))
            arcs[numbers[pair], symbol] = numbers[one, two], written
    return Transducer(arcs)


def _symbols(marks: Iterable[str]) -> list[Symbol]:
    sets = [frozenset(some) for n in range(len(list(marks)) + 1) for some in combinations(marks, n)]
    return [(kind, some) for kind in range(_REPORT + 1) for some in sets]


def _marked(symbol: Symbol, mark: str, when: bool) -> Symbol:
    """An insult or threat gets a mark."""
    return (symbol[0], symbol[1] | {mark}) if when and symbol[0] in (_INSULT, _THREAT) else symbol


def negation(reach: int = REACH) -> Transducer:
    """Marks what comes within reach of a negation; the state is how far the last one still reaches."""
    return Transducer({
        (left, symbol): (reach if symbol[0] == _NEGATION else max(0, left - 1), _marked(symbol, "negated", left > 0))
        for left in range(reach + 1) for symbol in _symbols([])
    })


def after(trigger: int, mark: str, marks: Sequence[str]) -> Transducer:
    """Marks what comes after a word of the class trigger; it reads symbols with any of these marks."""
    return Transducer({
        (seen, symbol): (int(seen or symbol[0] == trigger), _marked(symbol, mark, seen > 0))
        for seen in (0, 1) for symbol in _symbols(marks)
    })


def verdict(marks: Sequence[str]) -> Transducer:
    """Writes as what an insult or threat with these marks counts, or nothing."""

    def ways(symbol: Symbol) -> tuple[str, ...]:
        kind, put = symbol
        if kind not in (_INSULT, _THREAT):
            return ()
        way = "negated" if "negated" in put else "reported" if "reported" in put else "threat" if kind == _THREAT else "plain"
        return (way, "targeted") if "targeted" in put and way in ("plain", "threat") else (way,)

    return Transducer({(0, symbol): (0, ways(symbol)) for symbol in _symbols(marks)})


def clause_transducer() -> Transducer:
    """From the classes of a clause's words to what each counts as: negation, reported speech and targets, then the verdict."""
    found = composed(negation(), after(_REPORT, "reported", ["negated"]))
    found = composed(found, after(_TARGET, "targeted", ["negated", "reported"]))
    return composed(found, verdict(["negated", "reported", "targeted"]))


class Grammar:
    """The lexicon transducer (words to classes and weights) composed with the clause transducer (classes to ways to count).

    What an insult or threat writes is the weight that the lexicon gives it, under the way that the clause transducer
    says: in full, as a threat, with a target before it, as negated or as reported.
    """

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.steps = {(state, kind): arc for (state, (kind, _)), arc in clause_transducer().arcs.items()}
        self.heads = {w.rstrip("*")[: STEMS[0]] for w in weights} | {w[: STEMS[0]] for w in _CLASSES}

    def read(self, word: str) -> tuple[int, float]:
        """The class and weight that the lexicon transducer writes for a word."""
        weight = max((self.weights.get(f, 0.0) for f in forms(word)), default=0.0)
        kind = _CLASSES.get(word, _OTHER)
        return (_INSULT, weight) if weight > 0 and kind != _THREAT else (kind, weight if weight > 0 else 1.0)

    def clause(self, tokens: list[tuple[int, float]]) -> dict[str, float]:
        """What the clause transducer writes: the weights of its matches by kind."""
        out = dict.fromkeys(("plain", "threat", "targeted", "negated", "reported"), 0.0)
        state, steps = 0, self.steps
        for kind, weight in tokens:
            state, ways = steps[state, kind]
            for way in ways:
                out[way] += weight
        return out

    def features(self, text: str | None) -> list[float]:
        """The features of a whole text: its best clause, and sums over its matched clauses."""
        best = top = total = clauses = threat = targeted = negated = reported = 0.0
        count = 0
        for part in _CLAUSE_END.split((text or "").lower()):
            words = [w for w in (x.strip(_EDGES) for x in part.split()) if w]
            count += len(words)
            heads = self.heads
            if not any(w[:3] in heads for w in words):
                continue
            tokens = [self.read(w) if w[:3] in heads else (_OTHER, 0.0) for w in words]
            got = self.clause(tokens)
            if got["plain"]:
                top = max(top, *(weight for kind, weight in tokens if kind == _INSULT))
            score = got["plain"]
            best, total = max(best, score), total + score
            clauses += score > 0
            threat += got["threat"]
            targeted += got["targeted"]
            negated += got["negated"]
            reported += got["reported"]
        sums = (log(1 + x) for x in (total, clauses, threat, targeted, negated, reported))
        return [1.0, best, top, max(0.0, top - SURE), *sums, log(1 + 100 * total / (count + 10))]


def held_out(doc_id: Column, folds: int = 3) -> Column:
    """Whether a row is kept from learning; rows without doc_id are not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 1, F.lit(False))


def _sampled(found: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """found, if it has no more than so many rows; else those whose hash is below a limit for somewhat fewer."""
    n = found.count()
    if n <= rows:
        return found
    span = 2**40
    return found.where(F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(span)) < int(span * max(0.0, rows - 5 * rows**0.5) / n))


def learned(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[Grammar, np.ndarray]:
    """The grammar and the weights of its features, from the labelled documents outside of the held-out fold.

    Of these, at most the given number are used, texts chosen by hashes of doc_id and text. Half of them, by another
    hash of doc_id, give the lexicon: patterns whose rate among toxic documents is a multiple of that among others, each distinct text
    counted once. The other half give the weights of the clause features, by regularised logistic regression. Where the
    first half has fewer than FEW_TOXIC toxic texts, no pattern would be in enough of them: both halves give the lexicon
    then, every word and each beginning found twice may be in it if its weight is positive, and fixed weights are given
    to a text's best match and the share of its matches.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("toxic") == 1).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    ids = ids.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    # Ids first, then texts, since an id may have many of these; each distinct text of an id is one row.
    chosen = F.broadcast(settled(_sampled(settled(ids), ["id"], rows)))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(chosen, "id").withColumn("hash", F.xxhash64("text"))
    distinct_texts = settled(texts.groupBy("id", "toxic", "hash").agg(F.first("text").alias("text")))
    texts = _sampled(distinct_texts, ["id", "hash"], rows)
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2))
    first, second = (texts.where(half == k).select("text", "toxic") for k in (0, 1))

    def texts_by_label(rows: DataFrame) -> dict[bool, int]:
        return {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count_distinct(F.xxhash64("text")).alias("n")).collect()}

    sizes = texts_by_label(first)
    few = sizes.get(True, 0) < FEW_TOXIC or not sizes.get(False)
    if few:
        first = texts.select("text", "toxic")
        sizes = texts_by_label(first)
    if not sizes.get(True) or not sizes.get(False):
        return Grammar({}), np.zeros(len(_FORM_FEATURES))

    def patterns(wanted: frozenset | None) -> Callable:
        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            seen: Counter = Counter()
            for text in set(batch.column("text").to_pylist()):
                words = set(folded_words(text))
                if wanted is not None:
                    words = {w for w in words if w[:3] in heads}
                found = {f for w in words for f in forms(w)}
                seen.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["form", "n"])

        heads = {f.rstrip("*")[:3] for f in wanted} if wanted is not None else set()
        return work

    def counts(toxic: bool, wanted: frozenset | None) -> DataFrame:
        distinct = first.where(F.col("toxic") == toxic).select("text").groupBy(F.xxhash64("text")).agg(F.first("text").alias("text")).select("text")
        return distinct.mapInArrow(per_batch(patterns(wanted)), "form string, n long").groupBy("form").agg(F.sum("n").alias("n"))

    bad = most_frequent(settled(counts(True, None).where(F.col("n") >= (1 if few else LEAST_DOCS))), 10 * LEXICON_SIZE)
    bad = {r["form"]: r["n"] for r in sorted(bad, key=lambda r: r["form"])}
    good = {r["form"]: r["n"] for r in counts(False, frozenset(bad)).collect()}
    rate = lambda n, of: log((n + 0.5) / (of + 1))
    weights = {f: rate(n, sizes[True]) - rate(good.get(f, 0), sizes[False]) - 2 / n**0.5 for f, n in bad.items()}
    if few:
        weights = {f: w for f, w in weights.items() if w > 0 and (bad[f] > 1 or not f.endswith("*"))}
    best = sorted((f for f, w in weights.items() if few or w >= LEAST_WEIGHT), key=lambda f: (-weights[f], f))[:LEXICON_SIZE]
    grammar = Grammar({f: weights[f] for f in best})
    if few:
        return grammar, np.array([FEW_WEIGHTS.get(name, 0.0) for name in _FORM_FEATURES])

    def measure(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        rows = [grammar.features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    measured = second.mapInArrow(per_batch(measure), "x array<double>, toxic boolean").collect()
    measured.sort(key=lambda r: (r["toxic"], r["x"]))  # sums in one order, whatever came first
    if not measured:
        return grammar, np.zeros(len(_FORM_FEATURES))
    return grammar, _logistic(np.array([r["x"] for r in measured]), np.array([r["toxic"] for r in measured], float))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, by Newton's steps."""
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, best_clause) of every row of docs.

    score is between 0 and 1, from the whole text alone; predicted is 1 from the threshold on. best_clause is the weight
    of the clause with the most. Null and empty texts match nothing and have the score of such texts; without
    labels of both kinds every score is 0.5. A doc_id with labels of both kinds counts as toxic. Rows without doc_id are scored, never learned from;
    repeated rows are scored each; other columns are never read; an empty table gives no rows.
    """
    grammar, weights = learned(docs, labels, rows)
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))

    def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        found = [grammar.features(t) for t in batch.column("text").to_pylist()]
        sums = (sum(a * b for a, b in zip(x, weights)) for x in found)
        scores = [1 / (1 + exp(-min(30.0, max(-30.0, s)))) for s in sums]
        columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())]
        columns += [pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array([x[1] for x in found], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "best_clause"])

    return rows_in.mapInArrow(per_batch(work), "doc_id long, held_out boolean, score double, predicted int, best_clause double")
