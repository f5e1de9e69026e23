"""The registered queries on a whole table against plain versions, and a plain parse of fingerprints."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_documents import plain_components, plain_simhash
from test_pages_and_chats import expected_chats
from tokenizers import Tokenizer

from riskwatch.llm import fingerprint, queries

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def library(name):
    found = Tokenizer.from_file(P.path(name))
    found.encode_special_tokens = True
    return lambda x: found.encode(x, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def texts(spark):
    return sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


def run(spark, key):
    return queries.QUERIES[key](spark, SF)


def test_token_store(spark, texts):
    encode, start, want = library("byte_bpe_50k.json"), 0, []
    for k, t in texts:
        ids = [*encode(t), 0]
        want.append((k, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, run(spark, "op2_token_store").select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_byte_bpe(spark, texts):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for k, t in texts:
        ids = own.encode_ordinary(t)
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(own.decode_bytes(ids)).hexdigest()))
    assert sorted(map(tuple, run(spark, "op10_byte_bpe").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want


def test_packing(spark, texts):
    encode, want = library("word_bpe_49k.json"), []
    for k, t in texts:
        ids = [*encode(t), 1]
        want += [(k, i, s, len(ids[s:s + 4096]), crc(ids[s:s + 4096])) for i, s in enumerate(range(0, len(ids), 4096))]
    found = run(spark, "op3_best_fit_packing").collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        ends = 0
        for offset, length in sorted(own):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert len(sequences) <= -(-sum(x[3] for x in want) // 4096) + 1


def test_chats(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected_chats([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    found = run(spark, "op4_chat_format").collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == want and len(found) == len(want)


def test_simhash(spark, texts):
    codes = [plain_simhash(t) for _, t in texts]
    pairs = [(i, j) for i, a in enumerate(codes) for j, b in enumerate(codes[:i]) if (a ^ b).bit_count() <= 2]
    group = plain_components([*pairs, *((i, i) for i in range(len(codes)))])
    want = [(k, f"{codes[i]:016x}", texts[group[i]][0]) for i, (k, _) in enumerate(texts)]
    assert sorted(map(tuple, run(spark, "op9_simhash").collect())) == want


def test_base_statistics(spark, texts):
    texts = dict(texts)
    for r in run(spark, "op6_quality").collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        inside = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(inside))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


# ---- fingerprints, one symbol after the other --------------------------------------------------------------------

STEP = 0x9E3779B97F4A7C15


def mix(x):
    for _ in range(2):
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & MASK
    return x ^ x >> 32


def toss(symbol, left):
    place = ((symbol ^ left) & -(symbol ^ left)).bit_length() - 1
    return 2 * place + (symbol >> place & 1)


def plain_names(data):
    """The names of all levels of a text's parse."""
    row, found = [mix((x + 1) * STEP & MASK) for x in data], set()
    while row:
        symbols, i = [], 0
        while i < len(row):  # runs of one symbol
            j = i
            while j < len(row) and row[j] == row[i]:
                j += 1
            symbols.append(row[i] if j - i == 1 else mix((row[i] + (j - i) * STEP) & MASK))
            i = j
        labels = symbols
        for _ in range(4):
            labels = [toss(x, labels[i - 1] if i else x ^ 1) for i, x in enumerate(labels)]
        cuts = [i for i in range(1, len(symbols) - 1) if labels[i] > labels[i - 1] and labels[i] > labels[i + 1]]
        row = []
        for a, b in zip([0, *cuts], [*cuts, len(symbols)], strict=True):
            total = sum(mix((x + k * STEP) & MASK) for k, x in enumerate(symbols[a:b])) & MASK
            row.append(mix((total + b - a) & MASK))
        found |= {mix(x) >> 32 for x in row}
        if len(row) == 1:
            break
    return found


def plain_fingerprint(text):
    return "".join(f"{x:08x}" for x in sorted(plain_names(text.encode()))[:fingerprint.SKETCH])


def plain_likeness(a, b):
    a, b = ({x[i:i + 8] for i in range(0, len(x), 8)} for x in (a, b))
    both = sorted(a | b)[:fingerprint.SKETCH]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def test_plain_parse():
    rnd = random.Random(9)
    texts = ["", "a", "ab", "aa", "a" * 50, "ab" * 40, "abc" * 30 + "x"]
    texts += ["".join(rnd.choice(rnd.choice(["ab", "abcdefgh ", "é \n"])) for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    found = fingerprint.sketches([x.encode() for x in texts])
    assert [fingerprint.to_text(x) for x in found] == [plain_fingerprint(x) for x in texts]


def test_fingerprint(spark, texts):
    found = {r.doc_id: r for r in run(spark, "op5_fingerprint").collect()}
    assert len(found) == len(texts)
    for i, (k, x) in enumerate(texts):
        y = texts[(i + 1) % len(texts)][1]
        edited = x[:len(x) - len(x) // 2] + y[:len(x) // 2]
        r = found[k]
        assert (r.n_chars, r.edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        if len(x) + len(y) > 4000:
            continue  # the plain parse takes too long
        own, changed, after = map(plain_fingerprint, (x, edited, y))
        assert (r.fingerprint, r.edited_fingerprint) == (own, changed)
        assert (r.near_edited, r.near_next) == (plain_likeness(own, changed), plain_likeness(own, after))
