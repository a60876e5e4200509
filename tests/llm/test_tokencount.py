import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from patronlens.llm import tokencount
from patronlens.llm.queries import op2_token_counts
from patronlens.llm.tokencount import Machine, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def machine():
    return Machine(PATH)


def test_random_texts(machine, library):
    rng = random.Random(3)
    signs = list("abcdefghijklmnopqrstuvwxyzABCDE'''   \n\t.,!?-12³½ⅧéñßÅΣςАбв中文ไทย한글İı🙂̧́  \x85\x1c#<|>")
    words = ["the", "it's", "they've", "I'll", "'s", "''s", "!'s", "'rex", "'re", "'r", "rock'n'roll", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(rng.choice(words if rng.random() < 0.2 else signs) for _ in range(rng.randrange(60))) for _ in range(1500)]
    assert machine.counts(texts).tolist() == [library(t) for t in texts]


def test_chunks_compose(machine, library, monkeypatch):
    texts = ["ab" * 3000 + " x" + "y" * 2000 + "'s" * 500, "", "one two", "z" * 5000, "'" * 300 + "re" * 300]
    whole = [library(t) for t in texts]
    for size in (1024, 64, 7, 1):
        monkeypatch.setattr(tokencount, "CHUNK", size)
        assert machine.counts(texts).tolist() == whole


def unbroken(kind, size):
    rng = random.Random(kind)
    if kind == "letters":
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size))
    if kind == "periods":  # the last token before a chunk differs from chunk to chunk
        return ("abc" * size)[: size // 2] + ("zzzzzzz" * size)[: size - size // 2]
    return "".join(rng.choice(["the", "in", "'re", "'", "s", "ation", "q", "12", "!!"]) for _ in range(size // 2))


@pytest.mark.parametrize("kind", ["letters", "periods", "pieces"])
@pytest.mark.parametrize("entries", [1, 2, 4])
def test_long_unbroken_texts(machine, library, monkeypatch, kind, entries):
    text = unbroken(kind, 60_000)
    texts = [text, "one " + text[:9000] + " two", text[:3], text[5000:30_000]]
    whole = [library(t) for t in texts]
    monkeypatch.setattr(tokencount, "ENTRIES", entries)
    for size in (1024, 100, 17):
        monkeypatch.setattr(tokencount, "CHUNK", size)
        assert machine.counts(texts).tolist() == whole


def test_tables_stay_bounded_inside_a_text(library, monkeypatch):
    monkeypatch.setattr(tokencount, "STATES", 3000)
    small = Machine(PATH)
    text = unbroken("letters", 60_000)
    sizes = []
    renew = small._renew
    monkeypatch.setattr(small, "_renew", lambda *held: (sizes.append(len(small._states)), renew(*held)))
    assert small.counts([text, "some words"]).tolist() == [library(text), library("some words")]
    assert len(sizes) > 2 and max(sizes) < 3000 + 2 * 60  # no more than one step of all chunks beyond the bound


def test_full_tables_are_built_anew(library, monkeypatch):
    monkeypatch.setattr(tokencount, "STATES", 50)
    monkeypatch.setattr(tokencount, "COLUMNS", 8)
    small = Machine(PATH)
    for text in ("the quick brown fox", "jumps over lazy dogs", "THE quick", "日本 jumps"):
        assert small.counts([text]).tolist() == [library(text)]


def test_documents(spark, tiny, documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op2_token_counts(spark, tiny).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 2048)


def test_odd_rows(odd, library):
    rows = sorted((str(r.doc_id), r.n_tokens) for r in count_tokens(odd).collect())
    assert rows == sorted((str(r.doc_id), library(r.text or "")) for r in odd.collect())
    assert count_tokens(odd.limit(0)).collect() == []
