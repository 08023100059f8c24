"""BPE against the tokenizers library: exact ids and decoded text."""

import hashlib
import random
import tracemalloc
import unicodedata

import public_tokenizers
import pytest
from conftest import SF001
from tokenizers import Tokenizer

from tastespark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(bpe.load(PATH))


def test_every_code_point(library, encoder):
    """Class, composition and lower form of all characters, between letters, digits and marks."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f"ab{chr(c)}e{chr(c)}1 {chr(c)}\u0301." for c in points[at:at + 50_000]]
        for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert encoder.encode(text) == want.ids, hex(ord(text[2]))


def test_random_marks(library, encoder):
    marks = [chr(c) for c in range(0x300, 0x20000) if unicodedata.combining(chr(c))]
    rnd = random.Random(4)
    for _ in range(3000):
        text = "".join(rnd.choice(marks) if rnd.random() < 0.6 else chr(rnd.randrange(32, 0x3000)) for _ in range(12))
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_random_texts(library, encoder):
    letters = "abcdeefghiijklmnopqrsttuvwxyzABCDE   's'téèßñÄIİΣσς0123½٣ \x1c\x85\xa0​\n\t.,!?…—😀👍🏽日本語é<|startoftext|><|endoftext|>"
    rnd = random.Random(3)
    for _ in range(1500):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        ids = encoder.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_hard_words(library, encoder):
    for text in ("a" * 3000, "ab" * 500, "the" * 400, "x" * 7 + "y" * 9, "!" * 500, "é" * 50, "aaabaaab'll've", "<|endoftext|>" * 3, "<|endoftext|"):
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_caches_may_overflow(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 4)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 20)
    enc = bpe.PrefixEncoder(bpe.load(PATH))
    text = "many different words and thoroughly unusual ones pass through a tiny cache again and again " * 3
    assert enc.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_encoder_stays_small():
    """Every worker of an executor holds an encoder, beside what earlier stages left: 61 MB before, 28 now."""
    spec = bpe.load(PATH)
    tracemalloc.start()
    try:
        enc = bpe.PrefixEncoder(spec)
        built = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert enc.encode("small")
    assert built < 45e6, built


def test_forgotten_steps_are_found_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_STEPS", 3)
    enc = bpe.PrefixEncoder(bpe.load(PATH))
    for text in ("xqzjkv thoroughlyunusual wordswithoutspaces zzyzx " * 3, "c4d0e4e2afd97eac40cbfd290a54a9cbdf355ce1", "日本語 é👍🏽"):
        assert enc.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert len(enc.fallen) <= 3


def test_border_rule_is_merging(encoder):
    """Two tokens stand side by side exactly when plain merging of their characters leaves them."""
    def merge(symbols):
        while True:
            ranks = [(encoder.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:]))]
            r, i = min(ranks, default=(1 << 30, 0))
            if r == 1 << 30:
                return symbols
            symbols = symbols[:i] + [encoder.vocab[encoder.token[symbols[i]] + encoder.token[symbols[i + 1]]]] + symbols[i + 2:]

    def atoms(t):
        a = encoder.parts.get(t)
        return [t] if a is None else atoms(a[0]) + atoms(a[1])

    rnd = random.Random(5)
    inner = [t for s, t in encoder.vocab.items() if not s.endswith("</w>")]
    for _ in range(3000):
        a, b = rnd.choice(inner), rnd.choice(list(encoder.vocab.values()))
        assert encoder.border_holds(a, b) == (merge(atoms(a) + atoms(b)) == [a, b])


def test_documents(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r for r in bpe.encode_documents(docs, PATH, keep_ids=True).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        g = got[r.doc_id]
        assert (g.n_tokens, list(g.ids)) == (len(ids), ids)
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges(make, library):
    big = (1 << 60) + 1
    rows = [(big, None, 1), (None, "", 2), (None, "Hello", 3), (4, "Hello", 4), (4, "Hello", 4), (6, "word " * 20_000, 5)]
    docs = make(rows, "doc_id long, text string, ids long")
    out = bpe.encode_documents(docs, PATH, keep_ids=True, keep_text=True)
    got = sorted((str(r.doc_id), r.n_tokens, r.decoded[:9]) for r in out.collect())
    assert got == sorted([(str(big), 0, ""), ("None", 0, ""), ("None", 1, "hello</w>"), ("4", 1, "hello</w>"), ("4", 1, "hello</w>"), ("6", 20_000, "word</w> ")])
    again = bpe.decode_ids(out.select("ids", "decoded"), PATH, out="again")
    assert again.filter("again <> decoded").count() == 0
    assert bpe.encode_documents(make([], "doc_id long, text string"), PATH).count() == 0
