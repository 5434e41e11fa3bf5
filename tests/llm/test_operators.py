"""Operators against brute force on small tables with odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from monthtide.llm import chat, components, ctw, decontaminate, lines, quality, simhash, substring, token_tree, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, id string"


def table(spark, texts, sources=None):
    """Documents of the texts, then odd rows: null, empty and blank texts, a row twice, a null id; and extra columns."""
    rows = [(k, t, "en", sources[k % len(sources)] if sources else "s", len(t), "x", "y") for k, t in enumerate(texts)]
    rows += [(900, None, None, None, None, None, None), (901, "", "en", "s", 0, None, None), (902, " \n\t", "en", "s", 3, None, None), (903, "twice here", "en", "s", 10, None, None)]
    rows += [rows[-1], (None, "no id at all", "en", None, 12, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def roots(nodes, linked):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


# --- simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    rng = random.Random(2)
    long = [prose(rng, 300) for _ in range(12)]
    texts = long + [t + " tail" for t in long] + [t.upper() for t in long[:3]] + ["a", "a b", "A B"]
    docs = table(spark, texts)
    found = simhash.near_duplicates(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = {plain_fingerprint(t) for _, t in rows}
    group = roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for i, t in rows:
        if i is not None:
            r = group[plain_fingerprint(t)]
            least[r] = min(i, least.get(r, i))
    wanted = Counter((i, plain_fingerprint(t), least.get(group[plain_fingerprint(t)])) for i, t in rows)
    assert Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in found) == wanted
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 1000])
def test_links_connect_what_brute_force_connects(spark, limit):
    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        fps |= {f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(4)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(table, distance=2, bucket_limit=limit)
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).count() == 0
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    wanted = {n: r for n, r in roots(signed, near).items() if n != r}
    assert {r.node: r.root for r in components.components(edges).collect()} == wanted


# --- substring


def plain_repeats(rows, window):
    seen, out = {}, {}
    for k, (i, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        w = (t or "").split()
        for s in range(len(w) - window + 1):
            seen.setdefault(tuple(w[s : s + window]), (i, s))
    for k, (i, t) in enumerate(rows):
        w = (t or "").split()
        gone = {p for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] != (i, s) for p in range(s, s + window)}
        out[k] = (i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return Counter(out.values())


@pytest.mark.parametrize("base", [2, 4])
def test_repeats_equal_brute_force(spark, base):
    rng = random.Random(base)
    texts = [prose(rng, rng.randrange(60), 6) for _ in range(40)]
    passage = prose(rng, 15)
    texts += [f"{prose(rng, 9)} {passage} {prose(rng, 9)}" for _ in range(5)] + [passage, "x " * 40, texts[0]]
    docs = table(spark, texts)
    found = Counter(map(tuple, substring.remove_repeats(docs, 8, base).collect()))
    assert found == plain_repeats([(r.doc_id, r.text) for r in docs.collect()], 8)
    assert substring.remove_repeats(docs.limit(0), 8, base).count() == 0


# --- lines


def test_spread_lines_equal_brute_force(spark):
    rng = random.Random(4)
    common = [f"This line is boilerplate number {k}" for k in range(6)]
    texts = ["\n".join(rng.choice([*common, f"own {prose(rng, 6)}", "short", ""]) for _ in range(8)) for _ in range(60)]
    docs = table(spark, texts, sources=[f"s{k}" for k in range(5)])
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sites, first = defaultdict(set), {}
    for i, t, s in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, x in enumerate((t or "").split("\n")):
            if len(x.strip(" \t\n\x0b\f\r")) >= 20:
                sites[x.strip().lower()].add(s)
                first.setdefault(x.strip().lower(), (i, k))
    drop = lambda i, k, x: len(sites.get(x.strip().lower(), ())) >= 4 and first[x.strip().lower()] != (i, k)
    wanted = Counter((i, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not drop(i, k, x))) for i, t, _ in rows)
    out = lines.remove_spread_lines(docs, min_sites=4)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == wanted
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    assert lines.remove_spread_lines(docs.limit(0)).count() == 0


# --- quality


def test_base_metrics_equal_brute_force_and_junk_goes(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(15, 90)) for _ in range(30)] + [" ".join(x + "###" for x in prose(rng, 40).split()) for _ in range(10)]
    texts += ["a b c d e f g h " * 5 + prose(rng, 30), "same line\nsame line\n\nother <b> & $", "z " * 30]
    docs = table(spark, texts)
    good = docs.where("doc_id < 30").select("doc_id")
    found = {r.doc_id: r for r in quality.quality_rules(docs, good).collect()}
    for row in docs.collect():
        t, r = row.text or "", found[row.doc_id]
        w = t.split()
        at = defaultdict(list)
        for s in range(len(w) - 7):
            at[tuple(w[s : s + 8])].append(s)
        covered = {p for v in at.values() if len(v) > 1 for s in v for p in range(s, s + 8)}
        full = [x for x in t.split("\n") if x.strip()]
        base = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert r.kept == (not r.base_failed and r.llr >= quality.THRESHOLD)
    assert not any(found[k].kept for k in range(30, 40)) and all(found[k].kept for k in range(30) if not found[k].base_failed)
    assert quality.keep_good(docs, good).count() == sum(r.kept for r in found.values())
    assert quality.quality_rules(docs, good.limit(0)).where("llr != 0").count() == 0
    assert quality.quality_rules(docs.limit(0), good).count() == 0


# --- decontamination


def test_leaks_with_other_names_and_numbers(spark):
    item = "On Monday the farmer, Tom sold 12 kg of apples to his friend, Ann and later, Tom bought 7 more boxes of pears"
    other = item.replace("Tom", "Bob").replace("Ann", "Eve").replace("12 kg", "30 lb").replace("7 more", "9 more")
    mixed = item.replace("Tom sold", "Bob sold").replace("later, Tom", "later, Max")
    rng = random.Random(6)
    texts = [f"{prose(rng, 30)} . {x} . {prose(rng, 30)}" for x in (item, other, mixed)] + [prose(rng, 80), " ".join(item.split()[:9])]
    docs = table(spark, texts)
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None)], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.leaks(docs, bench).collect()}
    assert set(found) == {0, 1} and found[0].n_changed == 0 and found[1].n_changed == 4 and found[1].item_id == 1
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0 == decontaminate.leaks(docs, bench.limit(0)).count()


def test_each_place_of_a_template_has_its_own_value(spark):
    texts = ["we saw a YouTube video, the McDonald Tom5 and Tom½ or Ann_x, Bob's 5km 12 km5 3 %7 $4.50 x2", "a TomÅsa b Éva", "he said Jo", None, "", "7", "the iPhone, Max²"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("tokens", decontaminate.template(F.col("text")))
    places = F.size(F.filter("tokens", lambda t: t.isin(decontaminate._NUMBER, decontaminate._NAME)))
    values = F.size(F.regexp_extract_all(decontaminate._clean(F.col("text")), F.lit(decontaminate._SLOTS), F.lit(0)))
    assert all(a == b for a, b in rows.select(places, values).collect())
    item = "On Monday the farmer, Tom sold 12 kg of apples to his friend, Ann and later, Tom bought 7 more boxes of pears"
    docs = table(spark, [f"we saw a YouTube video . {item} .", f"at the McDonald . {item}"])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {(r.doc_id, r.n_changed) for r in decontaminate.leaks(docs, bench).collect()} == {(0, 0), (1, 0)}


def test_any_consistent_occurrence_is_a_leak(spark):
    rng = random.Random(7)
    run = "Compute the sum " + " + ".join(str(3 + 11 * k) for k in range(11)) + " and write it down"
    item = "On Monday the farmer, Tom sold 12 kg of apples to his friend, Ann and later, Tom bought 7 more boxes of pears"
    other = item.replace("12 kg", "15 kg")
    bad = item.replace("Tom sold", "Bob sold")
    split = lambda x: x.replace("apples to", "apples straight from his garden to")
    texts = [f"{prose(rng, 9)} . {run}", f"{item} . {prose(rng, 9)} . {other}", f"{bad} . {bad}", f"{split(other)} . {prose(rng, 40)} . {bad}", f"{item} {other}"]
    bench = spark.createDataFrame([(1, run), (2, item)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(table(spark, texts), bench).collect()}
    assert set(found) == {(0, 1), (1, 2), (3, 2), (4, 2)}
    assert [found[k].n_changed for k in sorted(found)] == [0, 0, 1, 0] and found[0, 1].n_slots == 11


def test_short_items_near_copies_and_excerpts_are_leaks(spark):
    rng = random.Random(8)
    plain = [f"i{k}" for k in rng.sample(range(1000), 300)]  # no numbers: letters stand before the digits
    plain = ["".join(chr(97 + int(c)) for c in w[1:].zfill(3)) for w in plain]
    short, near, long = "What is 31 plus 47", plain[:15], plain[100:200]
    texts = [f"so {short} then", "so What is 5 plus 8 then", "so What was 31 plus 47 then", f"well. {short}?", "so Tom is 31 plus 47"]
    changed = [[*near[:k], "zzz", *near[k + 1 :]] for k in range(15)]
    put_in = [[*near[:k], "zzz", *near[k:]] for k in (3, 7, 12)]
    left_out = [[*near[:k], *near[k + 1 :]] for k in (2, 7, 11)]
    for x in (*changed, *put_in, *left_out, [*near[:5], "y", "z", *near[7:10], "x", *near[11:]], long[30:70], long[30:50]):
        texts.append(f"{prose(rng, 10)} q {' '.join(x)} q {prose(rng, 10)}")
    bench = spark.createDataFrame([(1, short), (2, " ".join(near)), (3, " ".join(long)), (4, "3 + 4"), (5, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table(spark, texts), bench).collect()}
    assert found == {(0, 1), (1, 1), (3, 1), *((k, 2) for k in range(5, 26)), (27, 3)}


# --- chat


def test_templates_fold_and_fail():
    tree = chat.folded(chat.parse("{% if 1 == 1 %}a{{ 'b' + 'c' | upper }}{% else %}x{% endif %}d{{ x.y }}"))
    assert tree == (chat.Emit(chat.Const("abCd")), chat.Emit(chat.Name("x", ("y",))))
    render = chat.compiled("{% for t in ts %}{% if not loop.first %},{% endif %}{% generation %}{{ t.a }}{% endgeneration %}{% endfor %}")
    assert render({"ts": [{"a": "x"}, {"a": None}, {"a": 3}]}) == ("x,,3", [(0, 1), (2, 2), (3, 4)])
    for bad in ("{% for x %}{% endfor %}", "{{ f(x) }}", "{{ x.__class__ }}", "{% if a %}", "{{ a | open }}", "{% import x %}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)


def test_conversations_come_back(spark):
    rng = random.Random(7)
    bits = ["<|im_end|>", "<|im_start|>", "\n", "\\", "<", "|", "n", "assistant", "ok", " ", "é😀"]
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(bits, k=rng.randrange(12)))) for c in range(20) for t in range(5)]
    rows += [(50, 0, None, None), (None, 1, "user", "x"), (51, None, "assistant", "first"), (51, 0, "assistant", "second"), (51, 0, "assistant", "second")]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    found = chat.read_back(chat.format_conversations(given)).collect()
    turns = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[c].append((r or "", x or ""))
    assert {r.conv_id: list(zip(r.roles, r.texts)) for r in found} == turns
    assert all(r.loss_texts == [x for role, x in turns[r.conv_id] if role == "assistant"] for r in found)
    assert chat.format_conversations(given.limit(0)).count() == 0


# --- token counts


def test_token_trees_follow_edits(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        count = token_tree.Counter(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(8)
    letters = [*"ab'ls  \n\t1é.,!", "'ll", "   ", "the "]
    for _ in range(300):
        text = "".join(rng.choices(letters, k=rng.randrange(600)))
        tree = token_tree.TokenTree.built(text, count)
        for _ in range(8):
            start = rng.randint(0, len(text))
            end = start + rng.choice((0, 0, 1, 3, 40))
            new = "".join(rng.choices(letters, k=rng.choice((0, 0, 1, 2, 20, 300)))) * rng.choice((1, 1, 1, 60))
            tree.edit(start, end, new, count)
            text = text[:start] + new + text[end:]
            assert tree.text == text and tree.n_tokens == len(count.encoding.encode_ordinary(text))
    docs = table(spark, ["hello world " * 200]).withColumn("edits", F.expr("array(struct(1 AS start, 3 AS end, 'xx' AS text))"))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for r in token_tree.edited(token_tree.token_trees(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect():
        assert r.n_tokens == len(count.encoding.encode_ordinary("".join(r.leaves))) == sum(r.leaf_tokens)
        assert r.doc_id != 0 or r.n_reencoded < 1000


# --- context-tree weighting


def plain_ctw(training, text, depth):
    """Exact tables: probability of the text's bytes under the weighted tree of the training texts."""
    zeros, ones = Counter(), Counter()

    def path(body, k):
        padded = b"\n" * depth + body
        return [(d, padded[k + depth - d : k + depth]) for d in range(depth + 1)]

    for body in training:
        for k, byte in enumerate(body):
            for d, context in path(body, k):
                for bit in range(8):
                    (ones if byte >> (7 - bit) & 1 else zeros)[d, context, 1 << bit | byte >> (8 - bit)] += 1
    nodes = set(zeros) | set(ones)
    estimate = {n: float(ctw.log_estimate(np.array([zeros[n]], float), np.array([ones[n]], float))[0]) for n in nodes}
    below, weight, end = Counter(), {}, {}
    for n in sorted(nodes, key=lambda n: -n[0]):
        d, context, node = n
        weight[n] = estimate[n] if d == depth else np.logaddexp(estimate[n], below[n]) - math.log(2)
        end[n] = 1.0 if d == depth else 1 / (1 + math.exp(min(700.0, below[n] - estimate[n])))
        if d:
            below[d - 1, context[1:], node] += weight[n]
    total = 0.0
    for k, byte in enumerate(text):
        for bit in range(8):
            p, seen = 0.5, False
            for d, context in reversed(path(text, k)):
                n = (d, context, 1 << bit | byte >> (8 - bit))
                if n in nodes:
                    own, stop = (ones[n] + 0.5) / (ones[n] + zeros[n] + 1), end[n] if seen else 1.0
                    p, seen = stop * own + (1 - stop) * p, True
            total += math.log10(p if byte >> (7 - bit) & 1 else 1 - p)
    return total


def test_code_lengths_equal_exact_tree(spark):
    rng = random.Random(9)
    docs = table(spark, [prose(rng, 40, 30) for _ in range(20)])
    found = ctw.code_lengths(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    split = [(i, ctw.tokens_of(t)) for i, t in rows]
    counts = Counter(x for i, w in split if not out(i) for x in [*w, b"\n"])
    size, kinds = sum(counts.values()), len(counts)
    bodies = [b" ".join(w) + b"\n" for i, w in split if not out(i)]
    wanted = {}
    for i, w in split:
        base = sum(math.log10((counts[x] + 0.5) / (size + 0.5 * (kinds + 1))) for x in [*w, b"\n"])
        wanted[i] = (out(i), len(w) + 1, sum(counts[x] > 0 for x in [*w, b"\n"]), size, base)
    for r in found:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == wanted[r.doc_id][:4]
        assert r.base_score == pytest.approx(wanted[r.doc_id][4])
    assert len(found) == len(rows)
    for i in (0, 1, 900):
        r = next(r for r in found if r.doc_id == i)
        exact = plain_ctw(bodies, b" ".join(dict(split)[i]) + b"\n", ctw.DEPTH)
        assert r.score == pytest.approx(exact, rel=0.03, abs=0.05)  # the tables hold log-odds to a tenth
    assert ctw.code_lengths(docs.limit(0)).count() == 0


# --- toxicity


def test_toxicity_learns_words_and_stems_and_reads_clauses(spark):
    rng = random.Random(10)
    bad = lambda: rng.choice(["grumbo", "snarl" + rng.choice("abcdefgh") * 3])
    texts, labels = [], []
    for k in range(400):
        toxic = rng.random() < 0.3
        words = prose(rng, 40).split()
        if toxic:
            words[rng.randrange(40)] = bad()
            words[rng.randrange(40)] = bad()
        texts.append(" ".join(words))
        labels.append((k, int(toxic)))
    docs = table(spark, texts)
    given = spark.createDataFrame([*labels, (None, 1), (903, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, given).collect()}
    held = [(k, y) for k, y in labels if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(found[k].held_out for k, _ in held) and sum(r.held_out for k, r in found.items() if k is not None and k < 400) == len(held)
    assert sum(found[k].predicted == y for k, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())
    grammar = toxicity.Grammar({"grumbo": 5.0, "snarl*": 4.0})
    assert grammar.clause([grammar.read(w) for w in "you are a grumbo".split()])["targeted"] == 5.0
    assert grammar.clause([grammar.read(w) for w in "he is not a grumbo".split()])["plain"] == 0.0
    assert grammar.clause([grammar.read(w) for w in "she said grumbo".split()])["reported"] == 5.0
    assert grammar.read("snarlx") == (toxicity._INSULT, 4.0)
    assert toxicity.toxicity(docs, given.limit(0)).where("score != 0.5").count() == 0
    assert toxicity.toxicity(docs.limit(0), given).count() == 0


def test_toxicity_ranks_held_out_texts_after_few_labels(spark):
    rng = random.Random(8)
    plain = [f"{a}{b}" for a in ("lor", "mip", "tov", "ren", "sal") for b in ("an", "ek", "ul", "os", "im")]
    rows = []
    for k in range(120):
        words = [rng.choice(plain) for _ in range(25)]
        if k % 8 == 0:
            words[rng.randrange(25)] = rng.choice(("grumbo", "snarlix"))
        rows.append((k, " ".join(words), int(k % 8 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, t) for k, _, t in rows], "doc_id long, toxic int")
    held = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    bad, good = ([r.score for r in held if (r.doc_id % 8 == 0) == want] for want in (True, False))
    assert bad and good and min(bad) > max(good)
