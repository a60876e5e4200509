import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patronlens.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_packed(rows, capacity):
    """Every sequence is filled from 0 without gap or overlap."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=150, deadline=None)
def test_plan_uses_every_length_once(lengths):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    plan = packing.plan(counts, 64)
    used = Counter()
    for parts, times in plan:
        assert sum(parts) <= 64 and times > 0
        for size in parts:
            used[size] += times
    assert used == Counter(lengths)
    # No two sequences could be one.
    loads = sorted(sum(p) for p, t in plan for _ in range(min(t, 2)))
    assert len(loads) < 2 or loads[0] + loads[1] > 64


def test_exact_complements_are_found():
    counts = np.zeros(101, int)
    for size, n in {60: 5, 40: 3, 25: 2, 15: 2, 34: 2, 33: 4, 70: 1, 10: 3}.items():
        counts[size] = n
    assert sum(t for p, t in packing.plan(counts, 100) if sum(p) == 100) >= 8


def test_documents(documents, tokenizer):
    rows = packing.pack_documents(documents, 2048).collect()
    ids = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0] for r in documents.collect()}
    seen = Counter()
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
        assert r.length == 2048 or r.piece == 0
    assert seen == {d: len(x) for d, x in ids.items()}
    total = sum(seen.values())
    assert check_packed(rows, 2048) <= -(-total // 2048) * 1.03 + 1


def test_sequences_hold_the_ids(documents, tokenizer):
    some = documents.limit(20)
    packed = packing.pack_documents(some, 256, keep_ids=True)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_odd_rows(odd, tokenizer):
    rows = packing.pack_documents(odd, 64).collect()
    check_packed(rows, 64)
    want = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert sum(r.length for r in rows) == want
    assert sorted(r.length for r in rows if r.doc_id in (2, 3)) == [1, 1]
    assert packing.pack_documents(odd.limit(0), 64).collect() == []


def test_texts_that_the_fast_form_refuses(tokenizer):
    encode = packing.encoder(packing.Vocabulary.standard())
    text = " " * 1_000_000 + "end"
    assert encode.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
