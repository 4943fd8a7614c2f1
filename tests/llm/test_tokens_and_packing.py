import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordmill.llm import packing, tokens
from wordmill.llm.queries import tokenizer_path

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = [
    "", None, " ", "\n\n", "a", "  two  spaces ", "<|endoftext|>", "x <|endoftext|>y  <|endoftext|> ", "don't we'll",
    "a\x1fb !\x1f!", "nbsp\xa0here \xa0 there", "　wide ", "é ́x", "ÀÉ Σ ΟΔΟΣ", "\x85x\x1c y", "�\x00z",
    "💥💥 🏳️‍🌈", "1234 5678", "A" * 300,
]


LOADED = {path: tokens.load_tokenizer(path) for path in (BYTE, WORD)}


def whole(path, text):
    return LOADED[path].encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(frame, documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "same id")]
    got = tokens.count_tokens(frame(rows, n_tokens="x"), BYTE, 5).collect()
    want = sorted((str(i), len((t or "").encode()), n := len(whole(BYTE, t)), n > 5) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    some = {r.doc_id: r.text for r in documents.collect()}
    got = tokens.count_tokens(documents, BYTE, 512).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(whole(BYTE, t)) for i, t in some.items()}
    assert tokens.count_tokens(frame([]), BYTE, 5).count() == 0


PARTS = st.sampled_from([" ", "  ", "\n", "\xa0", "word", "Wörter", "12", "'s", "!?", "<|endoftext|>", "<|", "é", "💥", "x" * 40])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=60).map("".join), st.integers(2, 40), st.integers(1, 12))
def test_windows_splice_to_the_whole(text, window, overlap):
    assert tokens.count_huge(LOADED[BYTE], text, window, overlap) == len(whole(BYTE, text))


def test_huge_texts_without_white_space_and_with(documents):
    tokenizer = LOADED[BYTE]
    long = "\n".join(r.text for r in documents.collect())[:150_000]
    for text in (long, "ab1!" * 5_000, "word " * 9_000 + "x" * 3_000):
        assert tokens.count_huge(tokenizer, text, 4096, 64) == len(tokenizer.encode(text).ids)


def check_packing(rows, capacity, end_id, truth):
    for r in rows:
        ids = truth[r.doc_id]
        own = np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes()
        assert zlib.crc32(own) == r.ids_crc32 and r.length <= capacity
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(truth)
    for key, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.length for r in own[:-1]] == [capacity] * (len(own) - 1)
        assert sum(r.length for r in own) == len(truth[key])
    for own in by_window.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_window)


def test_packing_holds_every_token(frame, documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, "many words of text " * 400), (51, "w " * 127), (52, "w " * 128)]
    got = packing.pack(frame(rows, length="x", task="y"), WORD, capacity=64).collect()
    check_packing(got, 64, 0, {i: [*whole(WORD, t), 0] for i, t in rows})
    truth = {r.doc_id: [*whole(WORD, r.text), 0] for r in documents.collect()}
    got = packing.pack(documents, WORD, with_ids=True).collect()
    windows = check_packing(got, 2048, 0, truth)
    assert windows <= 1.02 * -(-sum(map(len, truth.values())) // 2048) + 1
    for r in got:
        assert list(r.ids) == truth[r.doc_id][r.start : r.start + r.length]


def test_packing_of_equal_null_and_no_rows(frame):
    got = packing.pack(frame([(None, "a"), (None, "a"), (1, None), (1, None)]), WORD, capacity=4).collect()
    assert sorted(r.length for r in got) == [1, 1, 2, 2] and len({r.sequence_id for r in got}) == 2
    assert packing.pack(frame([]), WORD).count() == 0


def best_fit(lengths, capacity):
    """Best-fit decreasing, one piece after the other."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_sweep_opens_as_many_windows_as_best_fit(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    matches = packing.sweep(counts, 30)
    used = {}
    for length, _, many, first, offset in matches:
        for w in range(first, first + many):
            assert used.get(w, 0) == offset
            used[w] = offset + length
    assert sorted(n for m in matches for n in [m[0]] * m[2]) == sorted(lengths)
    assert all(v <= 30 for v in used.values()) and len(used) == best_fit(lengths, 30)


@pytest.mark.parametrize("capacity", [1, 2])
def test_smallest_capacities(frame, capacity):
    got = packing.pack(frame([(1, "a b c"), (2, "")]), WORD, capacity=capacity).collect()
    check_packing(got, capacity, 0, {1: [*whole(WORD, "a b c"), 0], 2: [0]})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAÉéßſİΣςKǅ'’sS.,!<|>endoftx 12٣\u0301\u0308\u0374\t\n\x0b\x85\xa0中"), max_size=40), max_size=5))
def test_words_cut_in_parts_give_the_ids_of_whole_texts(texts):
    texts = [*texts, None, "", " a", "<|endoftext|>", "<|ENDOFTEXT|>.", "T\u0308 t\u0308"]
    cache = packing.ChunkCache(packing.PartEncoder(LOADED[WORD]))
    got = [bytes(b) for b in packing.encode_texts(pa.array(texts, pa.string()), cache)]
    assert got == [struct.pack(f"<{len(w)}I", *w) for w in (whole(WORD, t) for t in texts)]


def test_placing_moves_no_piece(frame):
    plan = packing.pack(frame([(1, "a b c"), (2, "d")]), WORD)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
