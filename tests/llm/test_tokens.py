"""Token store, byte-level BPE, packing and token counts against the libraries and plain loops."""

import base64
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskwatch.llm import byte_bpe, packing, token_count, token_store
from riskwatch.llm.encode import TextEncoder
from riskwatch.session import shared_path

BYTE, WORD, RANKS = (P.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))
PIECES = P.path("piece_bpe_32k.model")


def library(path):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return lambda x: found.encode(x or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ENCODERS = {x: (TextEncoder(x, x == BYTE), library(x)) for x in (BYTE, WORD)}
ODD = st.text(alphabet=" \n\t\r ab.,'sTé\u0301\x1c\x85\xa01Σİ<|endoftext>", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(ODD, st.text(max_size=20)), max_size=4))
def test_cut_texts_have_the_ids_of_whole_texts(texts):
    for encoder, whole in ENCODERS.values():
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [whole(x) for x in texts]


def test_a_full_cache_changes_no_ids():
    encoder = TextEncoder(BYTE, True)
    encoder.entries, encoder.kept = 5, 2
    texts = ["the one of the two", "and another of many words", "the last one, the end."]
    for x in texts * 2:
        assert np.frombuffer(encoder.encode([x])[0], "<u4").tolist() == ENCODERS[BYTE][1](x)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=2000))
def test_directly_addressable_codes(ids):
    ids = np.array(ids, np.uint32)
    levels = token_store.dac_encode(ids)
    assert token_store.dac_range(levels, 0, len(ids)).tolist() == ids.tolist()
    rnd = random.Random(len(ids))
    for _ in range(10):
        i, j = sorted((rnd.randrange(len(ids)), rnd.randrange(len(ids))))
        assert token_store.dac_get(levels, i) == ids[i]
        assert token_store.dac_range(levels, i, j).tolist() == ids[i:j].tolist()


def test_token_store(spark, docs, corpus, monkeypatch):
    path = shared_path(spark, "test")
    token_store.write_tokens(docs, path, BYTE, end_id=0)
    whole = library(BYTE)
    order = sorted(corpus, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    stream, expected = [], []
    for key, text in order:
        ids = [*whole(text), 0]
        expected.append((key, len(stream), len(ids), ids))
        stream += ids
    found = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist())
             for r in token_store.read_documents(spark, path).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    for place in (0, 1, 777, len(stream) - 1):
        assert token_store.token_at(spark, path, place) == stream[place]
    assert token_store.token_at(spark, path, len(stream)) is None
    assert token_store.token_at(spark, path, -1) is None


def test_a_lookup_reads_one_segment(spark, many_parts):
    """A third of the rows have a null id and a third one id; ranges split both, and a place is found in one row."""
    rnd = random.Random(8)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"{rnd.random()} word " * 30) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = shared_path(spark, "test")
    token_store.write_tokens(df, path, BYTE, end_id=0)
    whole = library(BYTE)
    stream = [x for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for x in [*whole(t), 0]]
    parts = token_store.segments(spark, path).selectExpr("part", "size(doc_ids) as n").collect()
    assert max(r.n for r in parts) < 150 and sum(r.n for r in parts) == 300
    for place in (0, len(stream) // 3, len(stream) - 1):
        found, start = token_store.segment_of(spark, path, place)
        assert len(found.inputFiles()) == 1 and found.count() == 1 and 0 <= place - start
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(seg," in plan and "ReadSchema: struct<seg:int,levels:" in plan
        assert token_store.token_at(spark, path, place) == stream[place]


def test_small_segments_hold_the_same_stream():
    import pyarrow as pa

    texts = ["a b c", None, "", "word " * 50, "z"]
    batch = pa.RecordBatch.from_pydict({"k": pa.array([1, 2, 3, 4, 5]), "t": pa.array(texts)})
    old = token_store.SEGMENT_TOKENS

    class Context:
        partitionId = staticmethod(lambda: 0)

    token_store.SEGMENT_TOKENS, task = 4, token_store.TaskContext
    token_store.TaskContext = type("T", (), {"get": staticmethod(lambda: Context)})
    try:
        rows = [r for x in token_store._segments(BYTE, 0, True)([batch]) for r in x.to_pylist()]
    finally:
        token_store.SEGMENT_TOKENS, token_store.TaskContext = old, task
    assert len(rows) > 2 and [r["before"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows[:-1]]).tolist()
    ids = [i for r in rows for i in token_store.dac_range(r["levels"], 0, r["n_tokens"]).tolist()]
    assert ids == [i for x in texts for i in [*library(BYTE)(x), 0]]


def test_token_store_of_nothing(spark, no_docs):
    path = shared_path(spark, "test")
    token_store.write_tokens(no_docs, path, BYTE, end_id=0)
    assert token_store.read_documents(spark, path).count() == 0
    assert token_store.token_at(spark, path, 0) is None


@pytest.fixture(scope="module")
def exact():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


CODER = byte_bpe.ByteBpe(RANKS, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.one_of(ODD, st.text(max_size=30), st.text(alphabet="aeinrsth ", max_size=60)))
def test_byte_bpe_is_exact(exact, text):
    ids = np.frombuffer(CODER.encode([text])[0], "<u4").tolist()
    assert ids == exact.encode_ordinary(text)


def test_byte_bpe_query_parts(docs, corpus, exact):
    ids = byte_bpe.encode(docs, RANKS, P.PATTERN)
    found = [(r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded).decode())
             for r in byte_bpe.decode(ids, RANKS).collect()]
    expected = [(k, len(i), i, x or "") for k, x in corpus for i in [exact.encode_ordinary(x or "")]]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_byte_bpe_of_nothing(no_docs):
    assert byte_bpe.decode(byte_bpe.encode(no_docs, RANKS, P.PATTERN), RANKS).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=30), st.sampled_from([60, 64, 100]))
def test_plan_uses_every_piece_once(counts, capacity):
    plan, used = packing.make_plan(counts, capacity), Counter()
    for lengths, times in plan:
        assert 0 < sum(lengths) <= capacity and times > 0
        for x in lengths:
            used[x] += times
    assert used == Counter(counts)
    total = sum(k * n for k, n in counts.items())
    sequences = sum(times for _, times in plan)
    assert sequences >= -(-total // capacity)
    open_ = []  # plain first fit decreasing
    for x in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        at = next((i for i, gap in enumerate(open_) if gap >= x), None)
        if at is None:
            open_.append(capacity - x)
        else:
            open_[at] -= x
    assert sequences <= len(open_) + 1


def test_exact_complements_fill_sequences():
    # 7 + 3, 6 + 2 + 2 and 5 + 3 + 1 + 1 fill exactly
    plan = packing.make_plan({7: 4, 3: 7, 6: 2, 2: 4, 5: 3, 1: 6}, 10)
    assert sum(times for _, times in plan) == 9 and all(sum(x) == 10 for x, _ in plan)


@pytest.mark.parametrize("capacity", [4096, 50])
def test_packing(docs, corpus, capacity):
    pieces = packing.cut(docs, WORD, end_id=1, capacity=capacity)
    found = packing.pack(pieces, capacity).collect()
    whole, expected = library(WORD), []
    for key, text in corpus:
        ids = [*whole(text), 1]
        expected += [(key, i, at, crc(ids[at:at + capacity])) for i, at in enumerate(range(0, len(ids), capacity))]
    assert sorted(((r.doc_id, r.piece, r.start, crc(np.frombuffer(r.ids, "<u4"))) for r in found), key=str) == sorted(
        expected, key=str)
    ends = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= capacity
    made = packing.sequences(packing.pack(pieces, capacity)).collect()
    assert {r.sequence_id: len(r.ids) // 4 for r in made} == dict(ends)


def test_packing_of_nothing(no_docs):
    assert packing.pack(packing.cut(no_docs, WORD, 1, 4096), 4096).count() == 0


def segment(counter, word):
    """Plain dynamic programming over all splits."""
    word, best = token_count.SPACE + word, [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = [(best[s][0] + counter.pieces[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in counter.pieces]
        if word[end - 1] not in counter.pieces:
            size = len(word[end - 1].encode())
            found.append((best[end - 1][0] + size * counter.byte_score, best[end - 1][1] - size))
        best.append(max(found))
    return -best[-1][1]


def test_token_counts(docs, corpus):
    counter = token_count.counter(PIECES)
    found = [tuple(r) for r in token_count.count_tokens(docs, PIECES).collect()]
    expected = [(k, len(w), sum(segment(counter, x) for x in w)) for k, t in corpus for w in [(t or "").split()]
                if not any(len(x) > 200 for x in w)]
    assert len(found) == len(corpus)
    assert not Counter(expected) - Counter(found)


def test_token_counts_of_a_small_vocabulary():
    counter = token_count.UnigramCounter({"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -3.5, "▁a": -4.0, "bab": -5.5})
    assert counter.count(["ab abab b", "", "a\u00e9"]) == [(3, sum(segment(counter, x) for x in ("ab", "abab", "b"))),
                                                          (0, 0), (1, segment(counter, "a\u00e9"))]


def test_token_counts_of_nothing(no_docs):
    assert token_count.count_tokens(no_docs, PIECES).count() == 0
