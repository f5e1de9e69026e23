"""Periodic runs against plain loops."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from riskwatch.llm import periodic, queries


def plain_runs(words):
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            s = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - s + p >= max(6, 4 * p):
                found.setdefault((s, i - s + p), p)  # the smallest period of the stretch comes first
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def random_words(rnd):
    n, k = rnd.randint(0, 120), rnd.choice([1, 2, 3, 9])
    words = [rnd.randrange(k) for _ in range(n)]
    if n > 3 and rnd.random() < 0.6:
        a = rnd.randrange(n)
        p = rnd.randint(1, max(1, (n - a) // 3))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rnd.random() < 0.4:
            words += words[-p:] * rnd.randint(1, 3) + [rnd.randrange(k) for _ in range(5)]
    return words


def test_find_against_plain_loops(monkeypatch):
    rnd = random.Random(3)
    for trial in range(150):
        monkeypatch.setattr(periodic, "GRID_ROWS", rnd.choice([1, 7, 1 << 20]))
        texts = [random_words(rnd) for _ in range(rnd.randint(1, 5))]
        at = np.cumsum([0] + [len(x) for x in texts])
        found = periodic.find(np.array([x for t in texts for x in t], np.int64), at)
        want = [(at[d] + s, n, p) for d, t in enumerate(texts) for s, n, p in plain_runs(t)]
        assert list(zip(*(x.tolist() for x in found), strict=True)) == want


def test_grammar_extensions():
    rnd = random.Random(4)
    for _ in range(60):
        row = np.array(random_words(rnd) + [1, 2], np.int64)
        n = len(row)
        a, b = np.triu_indices(n, 1)
        grammar = periodic.Grammar(row)
        for step in (1, -1):
            found = grammar.agree(a, b, step)
            for i, j, x in zip(a.tolist(), b.tolist(), found.tolist(), strict=True):
                k = 0
                while 0 <= i + step * k and j + step * k < n and row[i + step * k] == row[j + step * k]:
                    k += 1
                assert k == x


def test_find_runs_keeps_rows(docs, corpus):
    found = periodic.find_runs(docs).collect()
    want = []
    for doc_id, text in corpus:
        runs = plain_runs(split(text))
        want.append((doc_id, len(split(text)), runs, plain_collapsed(split(text), runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r.runs for r in found)


def test_find_runs_of_nothing_and_of_many(spark, no_docs):
    assert periodic.find_runs(no_docs).count() == 0
    long = "a b c d e " * 60_000 + "f"
    df = spark.createDataFrame([("x", long), ("y", None), ("z", "w")], "name string, body string")
    found = {r.doc_id: r for r in periodic.find_runs(df, "name", "body").collect()}
    assert [tuple(x) for x in found["x"].runs] == [(0, 300_000, 5)] and found["x"].collapsed == "a b c d e f"
    assert (found["y"].n_words, found["y"].runs, found["y"].collapsed) == (0, [], "")
    assert found["z"].collapsed == "w"


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, sf).collect()}
    assert len(found) == len(texts)
    n_runs = 0
    for doc_id, text in texts:
        words = planted(doc_id, split(text))
        runs = plain_runs(words)
        n_runs += len(runs)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, plain_collapsed(words, runs))]
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)
        r = found[doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
    assert n_runs > 5
