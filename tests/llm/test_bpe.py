import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from monthtide.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def test_lexicon_finds_its_words_only(vocabulary, tmp_path):
    words = [w.encode() for w in ("a", "and", "band", "sand", "sands", "the", "then", "é")]
    bpe.Lexicon.compiled({w: vocabulary.merged(w) for w in words}).save(str(tmp_path / "x"))
    lexicon = bpe.Lexicon.mapped(str(tmp_path / "x"))
    numbers = lexicon.find([*words, b"th", b"thenx", b"", b"bands"])
    assert sorted(numbers[: len(words)]) == list(range(len(words))) and set(numbers[len(words) :]) == {-1}
    for w, n in zip(words, numbers):
        assert lexicon.ids[lexicon.starts[n] : lexicon.starts[n + 1]].tolist() == vocabulary.merged(w)
    assert len(lexicon.final) < sum(map(len, words))  # suffixes are shared
    assert (bpe.Lexicon.compiled({}).find([b"a", b""]) == -1).all()


def test_encoder_equals_the_library(vocabulary):
    library, rng = Tokenizer.from_file(PATH), random.Random(1)
    letters = [*"aAbB eE'stre ΣσΑς İIıé é ÅßﬁǅΩ \x1c\x85  \x0b 12½Ⅷ٣中文日本😀‍̇.,!?$\t\n", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "the", "then", "<|", "|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + ["", "word " * 5000]
    lexicon = bpe.Lexicon.compiled({w.encode(): vocabulary.merged(w.encode()) for w in ("the", "then", "e", "12")})
    encoder = bpe.Encoder(vocabulary, lexicon)
    for some in (texts[:1500], texts[1500:], [None, None]):
        ids, bounds, decoded = encoder(some)
        for k, text in enumerate(some):
            wanted = library.encode(text or "", add_special_tokens=False).ids
            assert ids[bounds[k] : bounds[k + 1]].tolist() == wanted, text
            assert decoded[k] == library.decode(wanted, skip_special_tokens=False)


def test_long_words_equal_the_library(vocabulary):
    library, rng = Tokenizer.from_file(PATH), random.Random(2)
    texts = ["".join(rng.choices(some, k=n)) for some in ("ab", "theranding", "aéß,'s中9", "x") for n in (64, 65, 66, 200, 3000)]
    texts += [f"a {t} B\xa0 \x85 {t}<|endoftext|>{t}" for t in texts] + ["\u2003 \xa0", "a" * 200_000]
    encoder = bpe.Encoder(vocabulary, bpe.Lexicon.compiled({}))
    ids, bounds, decoded = encoder(texts)
    for k, text in enumerate(texts):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[k] : bounds[k + 1]].tolist() == wanted, text[:200]
        assert decoded[k] == library.decode(wanted, skip_special_tokens=False)


def test_query_shape_with_odd_rows(spark):
    rows = [(1, "The cat", 5), (1, "The cat", 5), (None, None, 6), (2, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded int")
    found = sorted(bpe.encode_decode(docs, PATH).collect(), key=str)
    assert [(r.doc_id, len(r.ids), r.decoded) for r in found if r.doc_id == 1] == [(1, 2, "the</w> cat</w>")] * 2
    assert [(len(r.ids), r.decoded) for r in found if r.doc_id != 1] == [(0, ""), (0, "")]
    assert bpe.encode_decode(docs.limit(0), PATH).count() == 0
