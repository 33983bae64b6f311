import tracemalloc
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeflow.llm import token_planes as T
from changeflow.llm.common import written


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from([1, 8]), st.integers(1, 70))
@settings(max_examples=60, deadline=None)
def test_segments_round_trip(ids, bits, block):
    ids = np.array(ids, "<u4")
    content = T.pack_segment(ids, bits, block)
    assert (T.unpack_segment(content) == ids).all()
    _, n, blocks = T.chunk_index(content)
    assert n == len(ids) and sum(b[0] for b in blocks) == n
    for i, b in enumerate(blocks):  # any block by itself
        assert (T.unpack_block(content, bits, b) == ids[i * block : (i + 1) * block]).all()


def test_a_foreign_segment_is_refused():
    with pytest.raises(ValueError):
        T.chunk_index(b"something else entirely")


@given(st.text(alphabet="aZ é.,'’\n\t\x1c  0!<|>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(text):
    e = T._encoder(None)
    assert e.encode([text])[0] == np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def expected(rows, end=0):
    tokenizer, start, out = T._encoder(None).tokenizer, 0, []
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents_come_back_in_order(spark, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    segments = written(T.encode(documents, bits=1, block=1000, segment_ids=5000), "test")
    assert segments.count() > 5
    assert sorted(map(tuple, T.read_digests(segments).collect())) == expected(rows)
    ids = {r.doc_id: r.ids for r in T.read_ids(segments).collect()}
    assert all(zlib.crc32(np.array(ids[d], "<u4").tobytes()) == c for d, _, _, c in expected(rows))


def test_odd_documents(spark, odd_docs, no_docs):
    got = T.read_digests(written(T.encode(odd_docs), "test")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -3, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 10]
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for r in got:
        assert any((r.n_tokens, r.ids_crc32) == expected([(0, t)])[0][2:] for t in texts[r.doc_id])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert T.read_digests(written(T.encode(no_docs), "test")).count() == 0


def test_added_tokens_are_the_library_s(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "<|endoftext|>", "two  <|endoftext|><|endoftext|>\n, words.", "no <|endoftext |> here"]
    assert T._encoder(None).encode(texts) == [np.array(fresh.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = {r.doc_id: r.ids[:-1] for r in T.read_ids(written(T.encode(docs), "test")).collect()}
    assert ids == {i: fresh.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert np.frombuffer(T._encoder(None, True).encode(texts[:1])[0], "<u4").tolist() == [87, 1279, 91, 437, 1659, 5239, 91, 29, 331]


def test_words_are_held_without_their_marks():
    e = T.Encoder()
    texts = ["alpha beta, beta. alpha\nalpha, naïve. x1, x.. (b)", "alpha  alpha, alpha.\t«ça». beta,. beta!."]
    want = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want and e.encode(texts[::-1]) == want[::-1] and e.encode([]) == []
    assert {" alpha", " beta", " naïve", ".", ","} < set(e.pool.slots)
    assert not {" alpha,", " alpha.", " beta,", " beta.", " naïve."} & set(e.pool.slots)
    count = e.pool.count
    e.encode(["\nalpha beta. beta, alpha,"])
    assert e.pool.count == count


def test_a_held_piece_takes_few_bytes():
    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" + "".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(60_000)]
    e = T.Encoder()
    tracemalloc.start()
    try:
        for i in range(0, len(words), 6000):
            e.encode([" ".join(["x", *words[i : i + 6000]])])
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert e.pool.count > 50_000 and held < 80 * e.pool.count


def test_a_slice_takes_little_memory():
    e, text = T.Encoder(), "one two three, four. " * (T.SLICE_BYTES // 21)
    e.encode([text])
    tracemalloc.start()
    try:
        e.encode([text])
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 24 << 20


def test_pieces_of_one_hash_and_long_pieces(monkeypatch):
    monkeypatch.setattr(T, "_hashed", lambda data, begin, size: np.zeros(len(size), np.uint64))
    e = T.Encoder()
    long = "q" * (T.LONGEST_PIECE + 1)
    texts = [f"alpha beta gamma {long} beta. ab ba", f"{long} beta delta, {long}", long * 40, "", "delta ab alpha"]
    want = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want and e.encode(texts[::-1]) == want[::-1]
    assert [e.encode([t])[0] for t in texts] == want


def test_the_cache_is_emptied_when_it_holds_many_ids(monkeypatch):
    monkeypatch.setattr(T, "CACHED_IDS", 1000)
    e = T.Encoder()
    for i in range(20):
        text = "".join(chr(33 + (i + k * k) % 90) for k in range(3000))
        assert e.encode([text])[0] == np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert e.pool.used < 6000
