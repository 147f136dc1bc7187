"""Viterbi counts and byte-level BPE."""

import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from loamline.llm import bpe, queries, viterbi

BPE = f"{queries.TOKENIZERS}/byte_bpe_50k.json"
PIECES = f"{queries.TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def unigram():
    t = Tokenizer(models.Unigram(viterbi.read_vocabulary(PIECES), unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return t


def test_counts_equal_the_tokenizer(spark, sf, corpus, unigram):
    got = {r.doc_id: r.n_tokens for r in queries.op8_token_counts(spark, sf).collect()}
    assert got == {i: len(unigram.encode(t).ids) for i, t in corpus}


def test_counts_on_odd_texts(unigram):
    random.seed(4)
    cache = viterbi._cached(PIECES)
    parts = ["a", "b", " ", "the", "▁", "é", "日", "ñ", "\n", "ing", "<s>", "𐍈", "  ", "<0x0A>"]
    for _ in range(1500):
        text = "".join(random.choice(parts) for _ in range(random.choice([1, 3, 12, 50])))
        assert viterbi.count_text(text, cache)[0] == len(unigram.encode(text).ids), text


def test_ties_and_unknowns():
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁ab", -5.0), ("abb", -6.0)]
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    count = viterbi.counter(vocabulary)
    random.seed(2)
    for _ in range(300):
        word = "".join(random.choice("ab") for _ in range(random.randrange(1, 9)))
        assert count("▁" + word)[0] == len(t.encode(word).ids)
    assert count("▁é")[0] == 3


def test_viterbi_odd_rows(odd, none):
    rows = viterbi.count_tokens(odd, PIECES).collect()
    assert len(rows) == odd.count() and all(r.n_tokens == 0 for r in rows if r.doc_id in (2, 3))
    assert viterbi.count_tokens(none, PIECES).count() == 0


@pytest.fixture(scope="module")
def hf():
    return Tokenizer.from_file(BPE)


def whole(text, leaf):
    encoder, special = bpe.load(BPE)
    parts = bpe.leaves(text, leaf, tuple(special))
    assert "".join(p[0] for p in parts) == text
    return bpe.join_tree(encoder, [bpe.encode_leaf(encoder, p[0]) for p in parts], [(p[1], p[2]) for p in parts])


def test_joins_equal_the_tokenizer(hf):
    random.seed(8)
    parts = ["a", "ab", "thereand", " ", "  ", "\n", " \n", "1", "23", "'", "'s", "'re", "!", "#*$", "é", "日本", "<|endoftext|>", "<|", "\t"]
    for _ in range(500):
        text = "".join(random.choice(parts) * random.choice([1, 1, 2, 50, 200]) for _ in range(random.choice([3, 10, 40])))
        run = random.choice(["abcdefghij", "01234", "#$%&'", "  \n", " ", "a", "thinghe"])
        text = text[:50] + "".join(random.choice(run) for _ in range(900)) + text[50:250]
        assert whole(text, random.choice([100, 200, 400])) == hf.encode(text, add_special_tokens=False).ids


def test_query_equals_the_tokenizer(spark, sf, corpus, hf):
    rows = {r.doc_id: r for r in queries.op10_bpe(spark, sf).collect()}
    assert len(rows) == len(corpus)
    for doc_id, text in corpus[:250]:
        ids = hf.encode(text, add_special_tokens=False).ids
        r = rows[doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(hf.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_rows(odd, none, hf):
    long = odd.where("doc_id = 7").first().text
    rows = bpe.decode(bpe.encode(odd, BPE, keep=["doc_id", "text", "ids"], leaf=2000), BPE).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r.text or ""
        assert r.decoded == text and list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) == hf.encode(text, add_special_tokens=False).ids
    assert len(long) > 50_000
    assert bpe.decode(bpe.encode(none, BPE), BPE).count() == 0
