"""The pipeline's stages on the smallest tables."""

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from monthtide.llm import quality, queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = out.cache()
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = corpus_pipeline.encoding_stage(spark, docs, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# --- run() against plain Python

BLANKS = " \t\n\x0b\f\r"


def words(text):
    return (text or "").encode().split()


def h64(body, seed=42):
    return xxhash.xxh64_intdigest(body, seed=seed)


def buckets_of(text, buckets=quality.BUCKETS):
    hashes = [h64(w) for w in words(text)]
    packed = [struct.pack("<Q", h) for h in hashes]
    signed = lambda h: (h - (1 << 64) if h >= 1 << 63 else h) % buckets
    return [signed(h) for h in hashes] + [signed(h64(b, h64(a))) for a, b in zip(packed, packed[1:])]


def quality_verdicts(docs, trusted):
    """doc_id to (llr, kept): rules, and the mean log ratio of smoothed multinomials over n-grams."""
    raw, good, judged = Counter(), Counter(), {}
    for d in docs:
        raw.update(buckets_of(d["text"]))
        good.update(buckets_of(d["text"]) if d["doc_id"] in trusted else [])
    smooth = [quality.SMOOTHING * c.total() / quality.BUCKETS for c in (good, raw)]
    whole = [c.total() + quality.BUCKETS * s for c, s in zip((good, raw), smooth)]
    for d in docs:
        w = words(d["text"])
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        often, covered = Counter(windows), set()
        for i, window in enumerate(windows):
            covered.update(range(i, i + 8) if often[window] > 1 else ())
        found = [math.log((good[b] + smooth[0]) / whole[0]) - math.log((raw[b] + smooth[1]) / whole[1]) for b in buckets_of(d["text"])]
        llr = sum(found) / len(found) if found else 0.0
        judged[d["doc_id"]] = llr, len(w) >= 20 and 100 * len(covered) <= 30 * len(w) and llr >= quality.THRESHOLD
    return judged


def without_spread_lines(docs, sites=10, chars=20):
    seen, first = defaultdict(set), {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        for at, line in enumerate(d["text"].split("\n")):
            body = line.strip(BLANKS)
            if len(body) >= chars:
                seen[body.lower()].add(d["source"] or "")
                first.setdefault(body.lower(), (d["doc_id"], at))
    out = []
    for d in docs:
        lines = d["text"].split("\n")
        gone = [len(seen.get(x.strip(BLANKS).lower(), ())) >= sites and first[x.strip(BLANKS).lower()] != (d["doc_id"], at) for at, x in enumerate(lines)]
        out.append(d | {"text": "\n".join(x for x, g in zip(lines, gone) if not g)} if any(gone) else d)
    return out


def fingerprint(text):
    w = [x.lower() for x in words(text)]
    hashes = [h64(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def one_of_each_group(docs, distance=2):
    prints, top = {d["doc_id"]: fingerprint(d["text"]) for d in docs}, {d["doc_id"]: d["doc_id"] for d in docs}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                low, high = sorted((root(a), root(b)))
                top[high] = low
    return [d for d in docs if root(d["doc_id"]) == d["doc_id"]]


def holds(text, item):
    """Whether half of an item's windows of eight words are in a text; items of the test tables have neither names nor numbers."""
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    mine, its = split(text), split(item)
    n = min(8, len(its))
    there = {tuple(mine[i : i + n]) for i in range(len(mine) - n + 1)}
    windows = {tuple(its[i : i + n]) for i in range(len(its) - n + 1)}
    return 2 * len(windows & there) >= len(windows)


def test_quality_verdicts_equal_plain_python(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    wanted = quality_verdicts(docs, trusted)
    found = queries.op2_quality(spark, SF).collect()
    assert {r.doc_id: r.kept for r in found} == {k: kept for k, (_, kept) in wanted.items()}
    assert all(math.isclose(r.llr, wanted[r.doc_id][0], abs_tol=1e-5) for r in found)
    assert len({r.kept for r in found}) == 2


def test_run_equals_plain_python(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    verdicts = quality_verdicts(docs, trusted)
    kept = one_of_each_group(without_spread_lines([d for d in docs if verdicts[d["doc_id"]][1]]))
    clean = [d for d in kept if not any(holds(d["text"], item) for item in items)]
    assert 0 < len(clean) < len(kept) < len(docs)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for d in clean:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        wanted.append((d["doc_id"], d["lang"], d["source"], len(ids), ids, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(wanted)
