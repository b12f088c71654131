"""Token ids, their files, packing, and the SentencePiece codec."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import NO_ID, by_id

from loomhouse.llm.common import byte_rows, groups
from loomhouse.llm.packing import best_fit_runs, pack, token_pieces
from loomhouse.llm.sentencepiece_codec import PieceEncoder, encode_decode
from loomhouse.llm.token_store import (store_folder, stored_documents, token_counts,
                                       token_positions, tokens_at, write_store)
from loomhouse.llm.tokens import ByteEncoder, vocabulary
from loomhouse.llm.wavelet import WaveletMatrix

PARTS = [" ", "  ", "\n", " \n", "\t", "a", "b", "don't", "it's", " 's", "12", "3.5", "é", "中文",
         "<|endoftext|>", "<s>", "\xa0", "　", "\x1c", "\x85", "!", "?!", "...", "\r\n",
         "   ", "x", " ", "​", "ß", "▁", "▁▁", "\0", "😀", " " * 14, " " * 33, "ﬁ",
         "Ａ", "﻿", "the", "ing", "tion"]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(4000)]


@pytest.fixture(scope="module")
def bytes_encoder():
    return ByteEncoder(vocabulary("byte_bpe_50k.json"), remembered=3000, young=500)


def rows_of(encode, texts):
    data, offsets = byte_rows(pa.array(texts, pa.string()))
    for low, high in groups(offsets, 3000):
        ids, at = encode(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
        yield from (ids[at[k]:at[k + 1]].tolist() for k in range(high - low))


def test_byte_ids_are_those_of_whole_texts(bytes_encoder, texts):
    want = bytes_encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert list(rows_of(bytes_encoder.encode, texts)) == [e.ids for e in want]


def fresh_ids(path, texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_named_tokens_get_their_ids(bytes_encoder, texts):
    path = vocabulary("byte_bpe_50k.json")
    named = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", " <|endoftext|>",
             "<|endof text|>", "<|endoftext|", "|> <|endoftext|>  z", "one two three"]
    want = fresh_ids(path, named + texts)
    assert want[0] == [64, 220, 50256, 275]
    assert list(rows_of(bytes_encoder.encode, named + texts)) == want


def test_added_tokens_with_spaces(tmp_path, texts):
    from tokenizers import AddedToken, Tokenizer
    changed = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    changed.add_tokens([AddedToken("b c"), AddedToken("a b"), AddedToken(" x "), AddedToken("dog s"),
                        AddedToken("the", single_word=True)])
    changed.add_special_tokens([AddedToken("<m>", lstrip=True, rstrip=True)])
    path = f"{tmp_path}/changed.json"
    changed.save(path)
    draw = random.Random(9)
    words = ["a", "b", "c", "x", "the", "then", "<m>", "dog", "s", "cat", "<|endoftext|>"]
    mixed = ["".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "", "\n"])
                     for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    encoder = ByteEncoder(path, remembered=3000, young=500)
    assert list(rows_of(encoder.encode, mixed + texts)) == fresh_ids(path, mixed + texts)


def test_stored_and_packed_tokens_with_names(spark, frame):
    docs = [(1, "a <|endoftext|> b"), (2, "x"), (3, "c <|endoftext|>")]
    want = fresh_ids(vocabulary("byte_bpe_50k.json"), [t for _, t in docs])
    crc = [[zlib.crc32(np.array([*ids, end], "<u4").tobytes()) for ids in want] for end in (0, 2)]
    starts = [0, len(want[0]) + 1, len(want[0]) + len(want[1]) + 2]
    folder = store_folder(spark)
    write_store(frame(docs), folder)
    assert by_id(stored_documents(spark, folder), "start", "n_tokens", "ids_crc32") == {
        i: (starts[i - 1], len(want[i - 1]) + 1, crc[0][i - 1]) for i, _ in docs}
    assert by_id(pack(token_pieces(frame(docs))), "length", "ids_crc32") == {
        i: (len(want[i - 1]) + 1, crc[1][i - 1]) for i, _ in docs}


def test_pieces_are_those_of_the_library(texts):
    import sentencepiece
    path = vocabulary("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = PieceEncoder(path, remembered=3000, young=500)
    want = model.encode(texts)
    found = list(rows_of(encoder.encode_texts, texts))
    assert found == want
    at = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    flat = np.array([i for f in found for i in f], np.uint32)
    assert encoder.decode(flat, at) == model.decode(want)


def test_codec_on_a_table(frame):
    docs = [(1, "a b"), (2, None), (3, ""), (None, " x"), (4, "long " * 30_000), (4, "again")]
    found = encode_decode(frame(docs))
    assert sorted((r["text"] or "", r["decoded"]) for r in found.collect()) == sorted(
        (t or "", t or "") for _, t in docs)
    assert encode_decode(frame(docs).limit(0)).count() == 0


def test_wavelet_matrix():
    draw = np.random.default_rng(2)
    ids = draw.integers(0, 700, 5000).astype(np.uint32)
    matrix = WaveletMatrix.frombytes(WaveletMatrix.build(ids, 10).tobytes())
    assert (matrix.all() == ids).all()
    for at in (0, 1, 511, 512, 4999):
        value = int(ids[at])
        places = np.flatnonzero(ids == value)
        assert matrix.access(at) == value
        assert matrix.rank(value, at) == (ids[:at] == value).sum()
        assert matrix.count(value) == len(places)
        assert [matrix.select(value, k) for k in range(len(places))] == places.tolist()
        assert matrix.positions(value).tolist() == places.tolist()
        assert matrix.positions(value, 2, 5).tolist() == places[2:5].tolist()
    assert matrix.count(1023) == 0 and matrix.rank(5000, 10) == 0
    assert (WaveletMatrix.frombytes(WaveletMatrix.build(ids[:0], 10).tobytes()).all() == []).all()


DOCS = [(5, "a b c"), (3, None), (9, ""), (None, "first"), (7, "word " * 3000), (8, "word " * 3000)]


def test_token_store(spark, frame, bytes_encoder):
    folder = store_folder(spark)
    write_store(frame(DOCS), folder, shard_ids=50)
    found = by_id(stored_documents(spark, folder), "start", "n_tokens", "ids_crc32")
    want, start = {}, 0
    for i, text in sorted(((NO_ID if i is None else i), t or "") for i, t in DOCS):
        ids = bytes_encoder.tokenizer.encode(text, add_special_tokens=False).ids + [0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert found == want
    empty = store_folder(spark)
    write_store(frame(DOCS).limit(0), empty)
    assert stored_documents(spark, empty).count() == 0


def test_lookups_in_the_stored_tokens(spark, frame):
    folder = store_folder(spark)
    write_store(frame(DOCS), folder, shard_ids=50)
    in_order = [t or "" for _, t in sorted(((NO_ID if i is None else i), t) for i, t in DOCS)]
    path = vocabulary("byte_bpe_50k.json")
    flat = [i for ids in fresh_ids(path, in_order) for i in [*ids, 0]]
    asked = [0, 1, 5, 60, 3000, len(flat) - 1, len(flat), -1, 5]
    at = tokens_at(spark, folder, spark.createDataFrame([(p,) for p in asked], "position long"))
    assert {(r["position"], r["token"]) for r in at.collect()} == {
        (p, flat[p] if 0 <= p < len(flat) else None) for p in asked}
    tokens = [0, flat[0], flat[60], 49_999, 1 << 40]
    counts = token_counts(spark, folder, tokens).collect()
    assert {r["token"]: r["n"] for r in counts} == {t: flat.count(t) for t in tokens}
    places = token_positions(spark, folder, tokens).collect()
    assert sorted((r["token"], r["position"]) for r in places) == sorted(
        (t, p) for p, t in enumerate(flat) if t in tokens)


def check_packing(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing(frame, bytes_encoder):
    draw = random.Random(4)
    docs = DOCS + [(i, "word " * draw.randint(0, 60)) for i in range(20, 150)]
    rows = pack(token_pieces(frame(docs), capacity=64, with_ids=True), capacity=64).collect()
    total = sum(r["length"] for r in rows)
    # Best fit takes at most 11/9 of the fewest sequences.
    assert check_packing(rows, 64) <= 11 * -(-total // 64) // 9 + 1
    by_doc = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        by_doc.setdefault(r["doc_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for i, text in docs:
        ids = bytes_encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(b"".join(r["ids"] for r in by_doc[i]), "<u4").tolist() == ids
        assert all(r["length"] == 64 for r in by_doc[i][1:])
    assert pack(token_pieces(frame(docs).limit(0))).count() == 0


def test_best_fit_is_close_to_the_least():
    draw = random.Random(6)
    for _ in range(50):
        counts = {draw.randint(1, 1024): draw.randint(1, 5000) for _ in range(draw.randint(1, 200))}
        runs = best_fit_runs(counts, 1024)
        ranks = {}
        for size, rank, *_ in runs:
            ranks.setdefault(size, []).append(rank)
        assert set(ranks) == set(counts) and all(min(r) == 0 for r in ranks.values())
    assert best_fit_runs({600: 2, 400: 2, 24: 2}, 1024) == [
        (600, 0, 0, 0, 1), (400, 0, 0, 600, 1), (24, 0, 0, 1000, 1)]
