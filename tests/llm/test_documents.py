"""Line dedup, fingerprints, quality rules and SimHash against plain loops."""

import hashlib
import math
import random
import re
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from riskwatch.llm import fingerprint, line_dedup, quality, simhash
from riskwatch.llm.components import components


def key(x):
    return (x is not None, x if x is not None else 0)


# ---- line dedup ------------------------------------------------------------------------------------------------

def plain_line_dedup(texts):
    first, out = {}, []
    for i, text in enumerate(texts):
        lines = text.split("\n")
        for pos in range(len(lines) - 2):
            first.setdefault(tuple(lines[pos:pos + 3]), (i, pos))
    for i, text in enumerate(texts):
        lines, gone = text.split("\n"), set()
        for pos in range(len(lines) - 2):
            if first[tuple(lines[pos:pos + 3])] != (i, pos):
                gone |= {pos, pos + 1, pos + 2}
        out.append((len(lines), len(gone), "\n".join(x for pos, x in enumerate(lines) if pos not in gone)))
    return out


def test_line_dedup(spark, corpus):
    own = {k: t for k, t in corpus if k is not None and t is not None}
    df = spark.createDataFrame(sorted(own.items()), "doc_id long, text string").repartition(4)
    found = line_dedup.dedup_lines(df).select("row.doc_id", "n_lines", "n_removed", "text").orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == plain_line_dedup([own[k] for k in sorted(own)])
    assert any(r.n_removed for r in found)


def test_line_dedup_keeps_rows_and_columns(docs, corpus):
    found = line_dedup.dedup_lines(docs).collect()
    assert len(found) == len(corpus) and found[0].row.asDict().keys() == set(docs.columns)
    assert sorted(((r.row.doc_id, r.row.text) for r in found), key=str) == sorted(corpus, key=str)
    null = [r for r in found if r.row.text is None]
    assert null and all(r.text is None and r.n_lines == r.n_removed == 0 for r in null)
    short = [r for r in found if r.row.text == "a\nb"]
    assert [(r.text, r.n_lines, r.n_removed) for r in short] == [("a\nb", 2, 0)]
    same = [r for r in found if r.row.text == "\n".join(["same line"] * 6)]
    assert [(r.text, r.n_removed) for r in same] == [("same line", 5)]


def test_line_dedup_of_nothing(no_docs):
    assert line_dedup.dedup_lines(no_docs).count() == 0


# ---- components ------------------------------------------------------------------------------------------------

def plain_components(edges):
    above = {}

    def top(x):
        above.setdefault(x, x)
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {x: top(x) for x in above}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(5, 4), (4, 3), (3, 2), (9, 8)], [(0, i) for i in range(1, 60)],
    [(i, i + 1) for i in range(40)], [(random.Random(i).randrange(80), random.Random(-i - 1).randrange(80)) for i in range(60)]])
def test_components(spark, edges):
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == plain_components([x for x in edges if x[0] != x[1]])


# ---- fingerprints ----------------------------------------------------------------------------------------------

def test_compare_next(docs, corpus):
    order = sorted(corpus, key=lambda x: (key(x[0]), x[1] is not None, x[1] or ""))
    texts = [x or "" for _, x in order]
    own = [fingerprint.sketches([x.encode()])[0] for x in texts]
    expected = []
    for i, (k, _) in enumerate(order):
        x, y = texts[i], texts[(i + 1) % len(texts)]
        edited = x[:len(x) - len(x) // 2] + y[:len(x) // 2]
        changed = fingerprint.sketches([edited.encode()])[0]
        expected.append((k, len(x), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.to_text(own[i]),
                         fingerprint.to_text(changed), fingerprint.likeness(own[i], changed),
                         fingerprint.likeness(own[i], own[(i + 1) % len(texts)])))
    found = [tuple(r) for r in fingerprint.compare_next(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("bucket_rows", [1, 2, 7])
def test_runs_follow_each_other(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", bucket_rows)
    rnd = random.Random(bucket_rows)
    ids = [-(1 << 62), 1 << 61, (1 << 61) + 1, *rnd.sample(range(10**12), 20), *range(5)]
    rows = sorted((i, f"text {i} " + " ".join(str(rnd.random()) for _ in range(20))) for i in ids)
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    found = fingerprint.compare_next(spark.createDataFrame(shuffled, "doc_id long, text string")).collect()
    follow = {k: (t, rows[(i + 1) % len(rows)][1]) for i, (k, t) in enumerate(rows)}
    for r in found:
        x, y = follow[r.doc_id]
        assert r.edited_sha256 == hashlib.sha256((x[:len(x) - len(x) // 2] + y[:len(x) // 2]).encode()).hexdigest()
    assert sorted(r.doc_id for r in found) == sorted(ids)


def test_fingerprints_are_locally_consistent():
    rnd = random.Random(3)
    one, two = ("".join(rnd.choice("abcdefgh ") for _ in range(3000)) for _ in range(2))
    a, shifted, half, other = fingerprint.sketches([x.encode() for x in (one, "xyz" + one, one[:1500] + two[:1500], two)])
    assert fingerprint.likeness(a, shifted) > 0.9
    assert 0.15 < fingerprint.likeness(a, half) < 0.55
    assert fingerprint.likeness(a, other) < 0.1
    empty = fingerprint.sketches([b""])[0]
    assert fingerprint.likeness(empty, empty) == 1.0 and fingerprint.likeness(a, empty) == 0.0


def test_short_texts_compare_across_any_length():
    rnd = random.Random(8)
    for n in (63, 64, 65, 100, 150):
        found = []
        for _ in range(40):
            text = "".join(rnd.choice("abcdefgh ") for _ in range(n))
            a, b = fingerprint.sketches([text.encode(), (text + "x").encode()])
            found.append(fingerprint.likeness(a, b))
        assert statistics.mean(found) > 0.7, n


def test_parsing_a_batch_or_alone_is_the_same():
    rnd = random.Random(4)
    texts = [bytes(rnd.choice(b"aab ") for _ in range(rnd.randint(0, 300))) for _ in range(200)] + [b"a" * 999, b"ab" * 500]
    for x, y in zip(fingerprint.sketches(texts), texts, strict=True):
        assert x.tolist() == fingerprint.sketches([y])[0].tolist() and (len(x) > 0) == (len(y) > 0)


def test_likeness_is_jaccard_for_small_sets():
    a, b = np.array([1, 2, 5, 9], np.uint32), np.array([2, 3, 9], np.uint32)
    assert fingerprint.likeness(a, b) == 2 / 5


def test_fingerprints_of_nothing(no_docs):
    assert fingerprint.compare_next(no_docs).count() == 0
    assert fingerprint.fingerprints(no_docs).count() == 0


# ---- quality ---------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def plain_scores(corpus):
    """Cross entropy by a plain recursion over modified Kneser-Ney counts."""
    counts = {5: Counter()}
    for text in corpus:
        for word in text.encode().split():
            line = bytes([quality.START]) * 4 + word + bytes([quality.END])
            counts[5].update(line[i:i + 5] for i in range(len(line) - 4))
    for size in (4, 3, 2, 1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    contexts = {}

    def discount(size, gram):
        return discounts[size][min(counts[size][gram], 3)]

    discounts = {}
    for size, own in counts.items():
        n = Counter(own.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        discounts[size] = [0] + [min(i, max(0, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[1] else i / 2 for i in (1, 2, 3)]
        contexts[size] = defaultdict(list)
        for gram in own:
            contexts[size][gram[:-1]].append(gram)

    def p(gram):
        if not gram:
            return 1 / 256
        size, after = len(gram), contexts[len(gram)].get(gram[:-1])
        if not after:
            return p(gram[1:])
        total = sum(counts[size][g] for g in after)
        freed = sum(discount(size, g) for g in after)
        own = counts[size][gram] - discount(size, gram) if gram in counts[size] else 0
        return (own + freed * p(gram[1:])) / total

    def run_score(words):
        total = n = 0
        for word in words:
            line = bytes([quality.START]) * 4 + word + bytes([quality.END])
            total += sum(math.log(p(line[i:i + 5])) for i in range(len(line) - 4))
            n += len(word) + 1
        return -total / n

    def score(text):
        """Of the middle run, of all words, and of the run at the upper quartile."""
        words = text.encode().split()
        if not words:
            return 0.0, 0.0, 0.0
        last = max(0, len(words) // 16 * 16 - 16)
        runs = sorted(map(run_score, [words[i:i + 16] for i in range(0, last, 16)] + [words[last:]]))
        return statistics.median(runs), run_score(words), runs[3 * (len(runs) - 1) // 4]
    return score


def test_quality(docs, corpus):
    found = quality.judge(docs).collect()
    assert len(found) == len(corpus) and found[0].row.asDict().keys() == set(docs.columns)
    score, rows = plain_scores([x or "" for _, x in corpus]), {}
    for r in found:
        text = r.row.text or ""
        base = plain_base(text)
        assert tuple(r[x] for x in quality.STATS) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert (r.score, r.whole, r.tail) == pytest.approx(score(text), abs=1e-9)
        n_bytes = sum(len(x) + 1 for x in text.encode().split())
        if not r.base_failed:
            rows[r.score, r.whole, r.tail, n_bytes] = n_bytes
    classes = Counter(max(1, n).bit_length() for n in rows.values())
    assert max(classes.values()) < quality.CLASS_ROWS  # so that one band holds for all lengths
    bands = []
    for i in range(3):
        a, m, b = np.quantile([x[i] for x in rows], [0.25, 0.5, 0.75])
        bands.append((m, (b - a) / 1.349))
    for r in found:
        text = r.row.text or ""
        n_bytes = sum(len(x) + 1 for x in text.encode().split())
        reach = [4 * max(d, 0.1 / math.sqrt(max(1, n_bytes))) for _, d in bands]
        if not r.base_failed:
            assert (r.low, r.high) == pytest.approx((bands[0][0] - reach[0], bands[0][0] + reach[0]))
        own = score(text)
        assert r.kept == (not r.base_failed and abs(own[0] - bands[0][0]) <= reach[0]
                          and all(own[i] <= bands[i][0] + reach[i] for i in (1, 2)))
    assert any(r.kept for r in found)


def test_hash_arrays():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 50, 3000):
        grams = np.unique(rnd.integers(0, 1 << 40, n))
        p = rnd.random(len(grams)) + 0.01
        some = rnd.integers(0, len(grams), 2 * n)
        assert (quality.HashArrays(grams, p).find(grams[some]) == np.log(p[some])).all()


def test_long_clean_documents_stay(spark):
    rnd = random.Random(5)
    common, rare = (["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n)] for n in (60, 2000))

    def text(n, style):  # documents differ in their share of rare words, long ones as much as short ones
        return " ".join(rnd.choice(rare if rnd.random() < style else common) for _ in range(n))

    rows = [(i, text(rnd.randint(150, 3000), rnd.uniform(0.2, 0.5)), "x") for i in range(160)]
    rows += [(1000, text(400_000, 0.25), "x"), (1001, text(400_000, 0.45), "x")]
    found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), keep=["doc_id"]).collect()
    assert not any(r.base_failed for r in found)
    assert {r.row.doc_id for r in found if r.row.doc_id >= 1000 and not r.kept} == set()
    assert sum(r.kept for r in found) > 155


def test_junk_in_a_part_of_a_text_counts(spark):
    rnd = random.Random(6)
    stems = ["ka", "lo", "mi", "ter", "un"]

    def clean(n):
        return ["".join(rnd.choice(stems) for _ in range(rnd.randint(1, 3))) for _ in range(n)]

    def junk(n):
        return ["".join(rnd.choice("bcdfghjpqvwxyz0123456789") for _ in range(8)) for _ in range(n)]

    rows = [(i, " ".join(clean(rnd.randint(300, 400))), "x") for i in range(120)]
    rows += [(200, " ".join(clean(200) + junk(140)), "x"), (201, " ".join(clean(20) + junk(120) + clean(200)), "x")]
    found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), keep=["doc_id"]).collect()
    assert {r.row.doc_id for r in found if not r.kept and r.row.doc_id >= 200} == {200, 201}
    assert sum(r.kept for r in found) > 110


def test_other_rows_leave_a_language_alone(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(f"{rnd.choice(['ka', 'lo', 'mi'])}{rnd.randrange(400)}" for _ in range(40)), "x") for i in range(40)]
    more = [(100 + i, "hot words of another language " * 40_000, "y") for i in range(6)]

    def scores(rows):
        found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), keep=["doc_id"])
        return {r.row.doc_id: r.score for r in found.collect() if r.row.doc_id < 100}

    assert scores(rows) == pytest.approx(scores(rows + more), abs=1e-9)


def test_bands_are_of_a_language(spark):
    rnd = random.Random(1)

    def text(letters):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(80))

    rows = [(i, text("abcde"), "x") for i in range(60)] + [(100 + i, text("vwxyz"), None) for i in range(60)]
    rows += [(200, text("vwxyz"), "x"), (201, text("abcde"), None)]
    found = {r.row.doc_id: r.kept for r in
             quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [k for k, kept in found.items() if not kept] == [200, 201] or {k for k, v in found.items() if not v} == {200, 201}


def test_quality_of_nothing(no_docs):
    assert quality.judge(no_docs).count() == 0


# ---- SimHash ---------------------------------------------------------------------------------------------------

def plain_simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, corpus):
    codes = [plain_simhash(x) for _, x in corpus]
    pairs = [(i, j) for i, a in enumerate(codes) for j, b in enumerate(codes[:i]) if (a ^ b).bit_count() <= 2]
    group = plain_components([*pairs, *((i, i) for i in range(len(codes)))])
    least = {}
    for i, (k, _) in enumerate(corpus):
        if k is not None:
            least[group[i]] = min(k, least.get(group[i], k))
    expected = [(k, codes[i], least.get(group[i])) for i, (k, _) in enumerate(corpus)]
    found = [(r.doc_id, r.code % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_long_texts_have_exact_sums():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("ab cd ef".split()) for _ in range(n)) for n in (1, 2, 3, 4, 257, 258, 259, 1200)]
    hashes = [simhash.shingle_hashes(x, 3) for x in texts]
    flat = np.array([h for x in hashes for h in x], np.uint64)
    assert simhash.simhash(flat, np.array([len(x) for x in hashes])).tolist() == [plain_simhash(x) for x in texts]


@pytest.mark.parametrize("block_codes,distance", [(4, 2), (16, 2), (64, 3), (2048, 0)])
def test_links_connect_what_is_near(spark, monkeypatch, block_codes, distance):
    monkeypatch.setattr(simhash, "BLOCK_CODES", block_codes)
    rnd = random.Random(block_codes)
    codes = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(25):
        code = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):  # chains of near codes
            codes.add(code)
            for _ in range(rnd.randint(1, 4)):
                code ^= 1 << rnd.randrange(64)
    codes = sorted(codes)
    near = [(a, b) for i, a in enumerate(codes) for b in codes[:i] if (a ^ b).bit_count() <= distance]
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in codes], "code long").repartition(3)
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, distance).collect()]
    assert plain_components([e for e in edges if e[0] != e[1]]) == plain_components(near)
    assert len(edges) <= 20 * len(codes)


def test_dedup_keeps_one_of_each_class(docs, corpus):
    found = simhash.dedup(docs).collect()
    assert found[0].asDict().keys() == set(docs.columns)
    classes = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    codes = {}
    for k, text in corpus:
        codes.setdefault(plain_simhash(text), []).append(k)
    assert len(found) <= len(codes) and {r.doc_id for r in found} == classes


def test_simhash_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.dedup(no_docs).count() == 0
