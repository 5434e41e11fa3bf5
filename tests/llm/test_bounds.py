"""What goes to the driver, keys of documents, clashing columns, and the grammar's transducers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthtide.llm import bpe, common, decontaminate, lines, simhash, substring, toxicity


def counted(spark, counts):
    return spark.createDataFrame([(f"p{k}", n) for k, n in enumerate(counts)], "piece string, n long")


@pytest.mark.parametrize("most", [0, 1, 3, 7, 10, 100, 5000])
def test_most_frequent_takes_ties_whole_or_not(spark, most):
    rng = random.Random(most)
    counts = [10_000, 9_000, 9_000] + [rng.randrange(1, 40) for _ in range(900)]
    found = sorted((r["n"] for r in common.most_frequent(counted(spark, counts), most)), reverse=True)
    wanted = sorted(counts, reverse=True)[:most]
    if len(counts) > most and wanted and sorted(counts, reverse=True)[most] == wanted[-1]:
        wanted = [n for n in wanted if n != wanted[-1]]
    assert found == wanted


def test_most_frequent_of_nothing(spark):
    assert common.most_frequent(counted(spark, []), 5) == []


def test_collected_pieces_do_not_grow_with_the_partitions(spark):
    """However many partitions there are, the driver gets the places' worth of rows."""
    texts = [(k, " ".join(f"w{n}" for n in range(k % 50, k % 50 + 200))) for k in range(400)]
    docs, path = spark.createDataFrame(texts, "doc_id long, text string"), __import__("public_tokenizers").path("word_bpe_49k.json")
    found = []
    for parts in (2, 64):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(bpe.frequent_pieces(docs, bpe.Vocabulary(path), 30))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] and 0 < len(found[0]) <= 30


def test_texts_without_id_are_told_apart_by_128_bits(spark):
    """Two hashes of 64 bits; texts whose first ones had 31 equal bits used to be one document."""
    rows = common.keyed(spark.createDataFrame([(None, "a"), (None, "b"), (1, "a")], "doc_id long, text string"))
    assert [f.dataType.simpleString() for f in rows.schema if f.name in common.KEY] == ["bigint"] * 3
    assert rows.select(*common.KEY).distinct().count() == 3


def test_equal_short_tags_lose_no_repeats(spark):
    rng = random.Random(8)
    shared = " ".join(f"s{rng.randrange(10**6)}" for _ in range(25))
    texts = [f"{' '.join(f'x{rng.randrange(10**6)}' for _ in range(30))} {shared} {k}" for k in range(60)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    found = substring.remove_repeats(docs).collect()
    assert sorted(r.n_removed for r in found) == [0] + [25] * 59


def test_documents_of_unique_ids_need_no_tags(spark, monkeypatch):
    """The tags of 128 bits are in each row of a shuffle, so only ids that are null or found again have them."""
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (3, "d"), (None, "e"), (None, None), (common.LAST_ID, "f"), (4, None)], "doc_id long, text string")
    found = common.keyed(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in found) == sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    assert sorted(r.id for r in found if (r.tag, r.tag2) == (0, 0)) == [1, 2, 4]
    assert len({tuple(r[c] for c in common.KEY) for r in found}) == 8
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)  # more ids found again than can be broadcast
    assert not [r for r in common.keyed(docs).collect() if (r.tag, r.tag2) == (0, 0)]


@pytest.mark.parametrize("most", [0, 1000])
def test_repeats_among_documents_of_one_id(spark, monkeypatch, most):
    monkeypatch.setattr(common, "BROADCAST_ROWS", most)
    rng = random.Random(most)
    shared = " ".join(f"s{rng.randrange(10**6)}" for _ in range(25))
    texts = [f"{' '.join(f'x{rng.randrange(10**6)}' for _ in range(30))} {shared} {k}" for k in range(8)]
    docs = spark.createDataFrame(list(zip([7, 5, 5, 5, 6, None, None, 9], texts)) + [(7, texts[0])], "doc_id long, text string")
    found = sorted((r.doc_id or 10, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert found == [(5, 0), (5, 25), (5, 25), (6, 25), (7, 25), (7, 25), (9, 25), (10, 25), (10, 25)]


def test_windows_one_after_another_are_one_row():
    """A row of the last level has the anchor and the place of its windows once; rows of one window each took twice the room."""
    rows = [(1, 5, 0), (1, 5, 1), (1, 5, 2), (1, 6, 3), (2, 6, 4), (2, 6, 6), (2, 6, 7), (2, 6, 7)]
    columns, offsets = substring._runs([np.array(c) for c in zip(*rows)])
    assert list(zip(*(c.tolist() for c in columns))) == [(1, 5, 0), (1, 6, 3), (2, 6, 4), (2, 6, 6), (2, 6, 7)]
    assert offsets.tolist() == [0, 3, 4, 5, 7, 8]


def test_many_repeated_windows_equal_brute_force(spark):
    """Runs that are broken by windows found before in a batch, in one document too."""
    rng = random.Random(11)
    passages = [" ".join(f"p{rng.randrange(9)}" for _ in range(rng.randrange(20, 70))) for _ in range(5)]
    texts = [" ".join(rng.choice([*passages, f"o{rng.randrange(99)}"]) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    first, wanted = {}, []
    for k, t in enumerate(texts):
        w = t.split()
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (k, s))
    for k, t in enumerate(texts):
        w = t.split()
        gone = {p for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] != (k, s) for p in range(s, s + 20)}
        wanted.append((k, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, substring.remove_repeats(docs).collect())) == wanted


CLASHING = "doc_id long, text string, source string, n_chars long, _id double, _hash string, _text string, _drop int, _left int, _ID_ int, _kept_id double, _kept_hash int, `a.b` int"


def clashing(spark):
    line = "the same line on all of the sites"
    texts = [f"own words {k} {k * 7} {k * 11} here\n{line}" for k in range(12)]
    rows = [(k, t, f"site{k}", len(t), 0.5 + k, f"h{k}", "t", k, 1, 2, 1.5 + k, 3, 4) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING)


def test_columns_named_like_internal_ones_come_through(spark):
    docs = clashing(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    before = sorted(docs.select(*(f"`{c}`" for c in others)).collect())
    for found in (lines.remove_spread_lines(docs), simhash.keep_one(docs, distance=0), decontaminate.decontaminated(docs, spark.createDataFrame([(1, "nothing of this kind at all in here")], "item_id long, text string"))):
        assert found.schema == docs.schema
        assert sorted(found.select(*(f"`{c}`" for c in others)).collect()) == before
    assert lines.remove_spread_lines(docs).where("text like '%same line%'").count() == 1


def test_one_row_of_numbers_is_not_another(spark):
    items = spark.createDataFrame([(1, "2 4 8 16 32 64 128 256 512 1024"), (2, "Anna sold 12 kg of apples on Monday and then 30 kg of pears to Tom")], "item_id long, text string")
    texts = [
        "the results were 51 17 93 4 66 28 75 31 82 19 23 in that order", "see 2 4 8 16 32 64 128 256 512 1024 here",
        "yesterday Maria sold 7 kg of apples on Friday and then 44 kg of pears to Eve again", "9 9 9 9 9 9 9 9 9 9 9 9 9",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()) == [(1, 1), (2, 2)]


# --- the grammar


def plain_clause(tokens, reach=toxicity.REACH):
    """The same by one loop over the words of a clause."""
    out = dict.fromkeys(("plain", "threat", "targeted", "negated", "reported"), 0.0)
    negation, report, target = -reach - 1, False, False
    for at, (kind, weight) in enumerate(tokens):
        if kind in (toxicity._INSULT, toxicity._THREAT):
            way = "negated" if at - negation <= reach else "reported" if report else "threat" if kind == toxicity._THREAT else "plain"
            out[way] += weight
            out["targeted"] += weight if target and way in ("plain", "threat") else 0.0
        negation = at if kind == toxicity._NEGATION else negation
        report, target = report or kind == toxicity._REPORT, target or kind == toxicity._TARGET
    return out


def test_composed_transducers_equal_a_loop():
    rng, grammar = random.Random(3), toxicity.Grammar({})
    for _ in range(4000):
        tokens = [(rng.randrange(6), float(rng.randrange(1, 9))) for _ in range(rng.randrange(12))]
        assert grammar.clause(tokens) == plain_clause(tokens), tokens


def test_a_composition_writes_what_one_after_the_other_writes():
    rng = random.Random(4)
    first, second = toxicity.negation(2), toxicity.after(toxicity._REPORT, "reported", ["negated"])
    both = toxicity.composed(first, second)
    for _ in range(500):
        read = [(rng.randrange(6), frozenset()) for _ in range(rng.randrange(15))]
        assert both.run(read) == second.run(first.run(read))
    assert {state for state, _ in both.arcs} == set(range(6))
    assert len({state for state, _ in toxicity.clause_transducer().arcs}) == 4 * 2 * 2


def test_the_sample_bounds_rows_not_ids(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("id"), F.col("id").alias("hash"))
    kept = toxicity._sampled(rows, ["id", "hash"], 500).count()
    assert 300 <= kept <= 500 and toxicity._sampled(rows, ["id", "hash"], 3000).count() == 3000
