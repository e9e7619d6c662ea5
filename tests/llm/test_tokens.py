"""Token files and packing against the tokenizers library on whole texts."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from doctriage.llm import common, packing, token_files, tokens


def whole(vocabulary, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    return [np.array(x.ids, "<u4").tobytes() for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("vocabulary", [tokens.WORD_BPE, tokens.BYTE_BPE])
def test_encoder_is_the_library(vocabulary):
    encode = tokens.Encoder(vocabulary, cached=50)  # a small cache: its limit must not show

    @settings(max_examples=40, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(
        list("abcXYZ  \t\n\r.,'!?0129-_<|>éÉßŸİΣ字\x1c\x85\xa0  　") + ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "it's", "the "]), max_size=40).map("".join), max_size=4))
    def check(texts):
        assert encode(texts) == whole(vocabulary, texts)
    check()


@pytest.mark.parametrize("vocabulary", [tokens.WORD_BPE, tokens.BYTE_BPE])
def test_added_tokens_as_the_library_has_them(vocabulary):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|endoftext|", "a <| b", "plain text"]
    assert tokens.Encoder(vocabulary)(texts) == whole(vocabulary, texts)


def test_memory_of_an_encoder_is_bounded_and_let_go():
    with tokens.encoder(tokens.BYTE_BPE) as encode:
        for i in range(8):
            encode([" ".join(f"w{i}x{j}q" for j in range(60_000))])
        for known in (encode._segments_known, encode._pieces_known):
            assert sum(len(k) + len(v) + tokens._ENTRY for k, v in known.items()) <= tokens.CACHED
    with tokens.encoder(tokens.BYTE_BPE) as again:
        assert again is encode  # the stage's next task
    with tokens.encoder(tokens.WORD_BPE):
        assert list(common.KEPT) == [tokens.WORD_BPE]
    common.let_go()
    assert not common.KEPT


@pytest.mark.parametrize("vocabulary", [tokens.WORD_BPE, tokens.BYTE_BPE])
def test_a_word_is_looked_up_once_a_slice(vocabulary):
    class Counted(dict):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    encode = tokens.Encoder(vocabulary)
    for name in ("_segments_known", "_pieces_known"):
        room = encode._room.pop(id(getattr(encode, name)))
        setattr(encode, name, Counted())
        encode._room[id(getattr(encode, name))] = room
    texts = ["some words, again and again. Été, 9. x.,\n" * 2000, " \t", "", "again."]
    assert encode(texts) == whole(vocabulary, texts)
    assert Counted.asked < 200


def test_rows_of_one_id_are_spread(spark, frame):
    rows = [(None if i % 3 else i, f"text {i} of many") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = token_files.write_token_files(frame(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r.n_docs for r in spark.read.parquet(f"{folder}/index").collect()]
    assert sum(parts) == 3000 and max(parts) <= 3 * 3000 / 8


def test_token_files_round_trip(spark, frame, odd_rows):
    folder = token_files.write_token_files(frame(odd_rows))
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0)) and len(got) == len(odd_rows)
    at, want = 0, defaultdict(list)
    for (d, t, *_), raw in zip(odd_rows, whole(tokens.WORD_BPE, [r[1] or "" for r in odd_rows])):
        raw += np.array([1], "<u4").tobytes()
        want[d].append((len(raw) // 4, zlib.crc32(raw)))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens
    index = spark.read.parquet(f"{folder}/index").collect()
    assert sum(r.n_tokens for r in index) == at and all(r.width == 2 for r in index)


def test_token_files_empty(spark, frame):
    folder = token_files.write_token_files(frame([]))
    assert token_files.read_token_files(spark, folder).count() == 0


def test_packing_keeps_every_id_once(frame, odd_rows):
    rows = odd_rows + [(1000 + i, "tok en " * (i * 37 % 900)) for i in range(120)]
    got = packing.pack_documents(frame(rows)).collect()
    ids = defaultdict(list)
    for (d, *_), raw in zip(rows, whole(tokens.BYTE_BPE, [r[1] or "" for r in rows])):
        ids[d].append(np.frombuffer(raw + np.array([1], "<u4").tobytes(), "<u4"))
    pieces, want = Counter(), Counter()
    for r in got:
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    for d, docs in ids.items():
        for x in docs:
            for a in range(0, len(x), 2048):
                want[d, a, len(x[a:a + 2048]), zlib.crc32(x[a:a + 2048].tobytes()), len(x)] += 1
    assert pieces == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(by) <= total / 2048 * 1.1 + 2
    assert packing.pack_documents(frame([])).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
@settings(max_examples=100, deadline=None)
def test_histogram_patterns(counts):
    patterns = packing.pack_histogram(counts, 64)
    placed = Counter()
    for p, n in patterns:
        assert sum(p) <= 64 and list(p) == sorted(p, reverse=True)
        for length in p:
            placed[length] += n
    assert placed == counts
    assert len(patterns) <= 4 * 64 + 4
    table = packing.slots(patterns)
    assert len(set(table[:, 0].tolist())) == len(table)
