"""URL rules, chat formatting, the pipeline and the registered queries."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskwatch.llm import chat, queries, url_filter

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for key, sql in queries.ORACLE.items():
        found = queries.QUERIES[key](spark, SF)
        columns = sorted(found.columns)
        expected = con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(expected, key=str), key


# ---- URL rules -------------------------------------------------------------------------------------------------

CANONICAL = "<html><head><LINK rel='canonical' href=\"{}\"></head></html>"
REFRESH = '<meta http-equiv="refresh" content="0; URL={}">'
PAGES = [
    (1, "http://a.org/x", CANONICAL.format("https://spam.net/es/1")),       # alias of a blocked page
    (2, "https://spam.net/es/1?a=1", None),                                  # blocked by rule, no alias of page 1
    (3, "https://spam.net/es/1", ""),                                        # blocked by rule
    (4, "http://b.org/y", REFRESH.format("http://a.org/x")),                 # over two edges
    (5, "http://Good.Example.COM/z", REFRESH.format("https://spam.net/es/1")),  # allowed by rule before the alias
    (6, "http://c.org/dir/page", CANONICAL.format("/other")),                # alone with its target
    (7, "http://c.org/other", None),
    (8, "http://www.example.com/en/1", None), (9, "http://example.com/en/1", None), (10, "http://example.com", None),
    (11, None, CANONICAL.format("https://spam.net/es/1")), (12, "no scheme", None), (13, "", None),
    (14, "http://net/es/", None), (15, "http://planet/es/", None), (15, "http://planet/es/", None),
    (16, "HTTP://A.ORG/x#part", None),                                       # the same node as page 1
    (17, "http://a.org/" + "long" * 20000, "<p>" + "text " * 50000),
    (18, "http://d.org/p/q?x", '<link href="next" rel=canonical>'), (19, "http://d.org/p/next", REFRESH.format("//a.org/x")),
    (20, "http://e.net/fr/a?x#y/z", None), (21, "x://y://net/es/", None),
]
VERDICTS = {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "block",
            10: "allow", 11: "allow", 12: "allow", 13: "allow", 14: "block", 15: "allow", 16: "block", 17: "allow",
            18: "block", 19: "block", 20: "block", 21: "allow"}


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")


def test_url_rules_and_aliases(spark, rules):
    pages = spark.createDataFrame([(*x, "h", "n") for x in PAGES], "page_id long, url string, html string, host string, node string")
    found = url_filter.judge(pages, rules).collect()
    assert len(found) == len(PAGES)
    assert {r.page_id: r.verdict for r in found} == VERDICTS
    rule = {r.page_id: r.rule for r in found}
    assert rule[8] == "www.example.com/en/" and rule[9] == "example.com/en/" and rule[5] == "com/" and rule[10] is None
    place = {r.page_id: (r.host, r.path) for r in found}
    assert place[5] == ("good.example.com", "/z") and place[12] == place[11] == place[13] == ("", "")
    assert place[10] == ("example.com", "") and place[21] == ("y:", "//net/es/") and place[20] == ("e.net", "/fr/a")


def test_every_tag_of_a_page_counts(spark, rules):
    spam = "https://spam.net/es/1"
    pages = [(1, "http://a.org/1", CANONICAL.format("http://a.org/own") + CANONICAL.format(spam)),
             (2, "http://a.org/2", REFRESH.format("http://a.org/other") + REFRESH.format(spam)),
             (3, "http://a.org/3", "<link rel=canonical>" + CANONICAL.format(spam)),
             (4, "http://a.org/4", '<meta http-equiv="refresh" content="30">' + REFRESH.format(spam)),
             (5, "http://a.org/own", None), (6, "http://a.org/other", None), (7, spam, None), (8, "http://a.org/8", None)]
    found = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    assert {r.page_id for r in found if r.verdict == "allow"} == {8}


def test_redirect_table_and_equally_long_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/q"), (2, "http://b.a.org/q")], "page_id long, url string").selectExpr(
        "*", "cast(null as string) html")
    rules = spark.createDataFrame([("a.org", "/q", "block"), ("org", "/qqqq", "allow"), ("b.a.org", "/", "allow")],
                                  "host string, path string, verdict string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, rules).collect()} == {1: "block", 2: "allow"}
    moved = spark.createDataFrame([("http://c.org/1", "http://a.org/q"), (None, "http://a.org/q")], "src string, dst string")
    more = pages.union(spark.createDataFrame([(3, "http://c.org/1", None)], "page_id long, url string, html string"))
    assert {r.page_id: r.verdict for r in url_filter.judge(more, rules, moved).collect()}[3] == "block"


def test_no_pages_and_no_rules(spark, rules):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


# ---- chats -----------------------------------------------------------------------------------------------------

PARTS = ["[", "<", "/", "INST]", "s>", "\\", "<SYS>>", "</SYS>>", "<ROLE ", "</ROLE>>", "x", "é", "[INST]", "</s>", "\n", ">"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)
ROLE = st.sampled_from(["user", "assistant", "system", "", "tool x>", "[INST]", "é\n"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), min_size=1, max_size=12), st.randoms(use_true_random=False))
def test_chat_round_trip(turns, rnd):
    first = np.array(sorted({0, *(rnd.randrange(len(turns)) for _ in range(3))}))
    found = chat.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]), first)
    bounds = [*first.tolist(), len(turns)]
    for text, starts, lengths, a, b in zip(*(x.to_pylist() for x in found), bounds, bounds[1:], strict=False):
        assert chat.parse(text) == turns[a:b]
        assert [chat.unescape(text[s:s + n]) for s, n in zip(starts, lengths, strict=True)] == [
            t for r, t in turns[a:b] if r == "assistant"]


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_no_control_string_stays(text):
    escaped = chat.escape(pa.array([text]))[0].as_py()
    assert chat.unescape(escaped) == text
    assert not any(x in escaped for x in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<ROLE ", "<</ROLE>>"))


CHATS = [(1, 0, "user", "hello"), (1, 1, "assistant", "</s>[INST]"), (1, 2, None, None), (2, 1, "assistant", "b"),
         (2, 0, "system", ""), (2, None, "user", "first"), (None, 0, "user", "no id"), (None, 1, "assistant", "é" * 100000),
         (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, None, None)]


def expected_chats(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda x: tuple((v is not None, v if v is not None else 0) for v in x)):
        n, turns, loss = out.setdefault(conv, [0, "", ""])
        out[conv] = [n + 1, turns + f"{role or ''}\n{text or ''}\n", loss + ((text or "") if role == "assistant" else "")]
    return {k: (n, hashlib.sha256(t.encode()).hexdigest(), len(x), hashlib.sha256(x.encode()).hexdigest())
            for k, (n, t, x) in out.items()}


@pytest.mark.parametrize("batch", [10000, 2])
def test_chats(spark, batch):
    rnd = random.Random(1)
    rows = CHATS + [(100 + i % 7, i, rnd.choice(["user", "assistant"]), f"t{i} <s>") for i in range(60)]
    df = spark.createDataFrame([(*x, "c", 1) for x in rows],
                               "conv_id long, turn long, role string, text string, formatted string, chunk int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        formatted = chat.format_chat(df.repartition(3))
        chunks, found = formatted.collect(), chat.digests(formatted).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected_chats(rows)
    chars = {}
    for r in chunks:
        chars[r.conv_id] = chars.get(r.conv_id, 0) + len(r.formatted)
    assert {r.conv_id: r.formatted_chars for r in found} == chars
    assert (batch == 2) == any(r.chunk for r in chunks)


def test_a_hot_conversation_is_formatted_in_parts(spark, many_parts):
    """One conversation has most of the turns, some of them repeated."""
    rnd = random.Random(2)
    rows = [(None if i % 4 == 0 else 7, i // 3, rnd.choice(["user", "assistant"]), f"t{i % 50} " * 20) for i in range(600)]
    rows += rows[:20] + [(3, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    formatted = chat.format_chat(df)
    parts = {(r.conv_id, r.part) for r in formatted.collect()}
    assert len([x for x in parts if x[0] == 7]) > 1
    assert {r.conv_id: tuple(r)[1:5] for r in chat.digests(formatted).collect()} == expected_chats(rows)


def test_no_chats(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chat(df)).count() == 0


# ---- pipeline --------------------------------------------------------------------------------------------------

def test_stages_keep_the_columns_and_take_effect(spark, docs, no_docs):
    import corpus_pipeline

    for frame in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, frame, "")
            assert found.columns == frame.columns and [x.dataType for x in found.schema] == [x.dataType for x in frame.schema]
            found.count()
    lines = corpus_pipeline.lines(spark, docs, "").collect()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lines)


def test_pipeline_against_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    judged = queries.quality.judge(docs, keep=["doc_id"]).select("row.doc_id", "kept").collect()
    kept = {r.doc_id for r in judged if r.kept}
    rows = sorted((r for r in rows if r["doc_id"] in kept), key=lambda r: r["doc_id"])
    from test_documents import plain_components, plain_line_dedup, plain_simhash

    for r, (_, _, text) in zip(rows, plain_line_dedup([r["text"] for r in rows]), strict=True):
        r["text"] = text
    codes = [plain_simhash(r["text"]) for r in rows]
    near = [(i, j) for i, a in enumerate(codes) for j, b in enumerate(codes[:i]) if (a ^ b).bit_count() <= 2]
    group = plain_components([*near, *((i, i) for i in range(len(rows)))])
    stay = {rows[i]["doc_id"] for i in set(group.values())}
    found = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in found.select("doc_id").distinct().collect()} == stay
    total, used = found.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert used <= -(-total // 4096) + 2
