"""Simple-8b, files of token ids, and their query against the tokenizers library."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow.fs import LocalFileSystem
from tokenizers import Tokenizer

from monthtide.llm import queries, simple8b, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 64).flatmap(lambda w: st.integers(0, (1 << w) - 1 if w else 0)), max_size=400), st.sampled_from([60, 64, 100, 4096]))
def test_values_come_back(values, block):
    given = np.array(values, np.uint64)
    packed = simple8b.pack(given, block)
    assert (simple8b.unpack(packed) == given).all() and len(simple8b.unpack(packed)) == len(given)
    assert packed.n_values.sum() == len(given) and packed.n_words.sum() == len(packed.words)


def test_words_hold_as_many_values_as_fit():
    assert len(simple8b.pack(np.ones(120, np.uint64)).words) == 2
    assert len(simple8b.pack(np.full(40, 32767, np.uint64)).words) == 10
    assert len(simple8b.pack(np.full(30, 50_000, np.uint64)).words) == 10
    packed = simple8b.pack(np.array([5, (1 << 60) + 3, 7], np.uint64))
    assert packed.escapes.tolist() == [(1 << 60) + 3] and (packed.words >> np.uint64(60)).tolist()[1] == 0


def test_encoder_equals_the_library():
    library, rng = Tokenizer.from_file(PATH), random.Random(4)
    letters = [*"abcXY tress ées×÷ñß 'sS\"!?,.-()<|>\t\n\r\x0b\x0c\x1c\x85\xa0 　  中文😀 12½", "<|endoftext|>", "  ", "\n\n", "'ll", "don't", " the", "café,", "\xa0 ", " \xa0"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["", "word, " * 3000, "a" * 5000]
    encoder = token_files.Encoder(PATH)
    for some in (texts[:1900], texts[1900:], ["", ""], []):
        ids, counts = encoder(pa.array(some, pa.string()))
        ends = np.cumsum(counts)
        for k, text in enumerate(some):
            assert ids[ends[k] - counts[k] : ends[k]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def expected(rows, end=(2,)):
    library, found, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, *end]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def read(spark, folder):
    rows = token_files.read_token_files(spark, folder).collect()
    return sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in rows if r.doc_id is not None), [r for r in rows if r.doc_id is None]


@pytest.mark.parametrize("end_id", [2, None])
def test_files_hold_all_documents_in_order(spark, end_id, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    monkeypatch.setattr(token_files, "_BLOCKS_AT_ONCE", 2)
    rng = random.Random(5)
    texts = [(k * 7 % 400, " ".join(rng.choice(["the", "of", "naïve,", "x1"]) for _ in range(rng.choice([0, 3, 50, 4000])))) for k in range(400)]
    rows = [(d, t, "z", 1) for d, t in texts] + [(None, "last of all", "z", 1), (500, None, None, None), (501, "", "", 2), (-3, "first", "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string, place int").repartition(5)
    folder = token_files.write_token_files(docs, PATH, end_id=end_id)
    order = sorted((r[:2] for r in rows if r[0] is not None), key=lambda r: r[0]) + [(None, "last of all")]
    wanted = expected(order, () if end_id is None else (end_id,))
    found, nulls = read(spark, folder)
    assert found == sorted(wanted[:-1]) and [(r.start, r.n_tokens) for r in nulls] == [wanted[-1][1:3]]
    assert spark.read.parquet(f"{folder}/manifest").count() > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeated_rows_and_equal_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (2, "d")] * 3
    folder = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    found, _ = read(spark, folder)
    assert len(found) == 12 and sorted(r[2:] for r in found) == sorted(r[2:] for r in expected(rows))
    assert [r[1] for r in sorted(found, key=lambda r: r[1])] == [0, *np.cumsum([r[2] for r in sorted(found, key=lambda r: r[1])])[:-1]]


def test_no_rows_give_no_files(spark):
    folder = token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert token_files.read_token_files(spark, folder).collect() == []


def test_damaged_files_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    folder = token_files.write_token_files(docs, PATH, folder=str(tmp_path / "f"))
    path = re.sub("^file:/+", "/", spark.read.parquet(f"{folder}/manifest").first().path)
    assert token_files.Reader(f"file://{path}").ids(0, 3).tolist() == Tokenizer.from_file(PATH).encode("one two three").ids
    whole = open(path, "rb").read()
    for broken in (whole[:-1], whole[:40], whole[:-60] + b"x" + whole[-59:]):
        with LocalFileSystem().open_output_stream(str(tmp_path / "broken")) as out:
            out.write(broken)
        with pytest.raises(ValueError):
            token_files.Reader(f"file://{tmp_path}/broken")


def test_query_equals_the_library(spark):
    found = queries.op11_token_files(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found)) == expected(sorted((r.doc_id, r.text) for r in docs))
