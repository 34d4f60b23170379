"""Token counts against the tokenizers library, text by text."""

import pytest
import public_tokenizers

from newsight.llm import queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \t\n ", "Don't we'LL 'sx", "x<|endoftext|>y<|startoftext|>", "<|endoftext|", "日本語 テスト",
    "ｆｕｌｌ　width ﬁne ǅ", "été İstanbul İİ", "Σας ΟΔΟΣ", "٣٤ ½² 1234567", "a\x00b\x85q", "가각 é",
    "​ab\U0001f600\U0001f600 ok", "x" * 50_000, "7" * 20_000, "ab " * 30_000, "!?" * 5_000,
]


@pytest.fixture(scope="module")
def split():
    return token_counts.PreTokens(PATH, token_counts.WORD_PATTERN)


def test_whole_table(spark, sf_dir, documents, split):
    got = {r["doc_id"]: r for r in queries.op11_token_counts(spark, sf_dir).collect()}
    assert set(got) == set(documents)
    for doc_id, text in documents.items():
        n = split.count_whole(text or "")
        assert got[doc_id][1:] == (len((text or "").encode()), n, n > 2048)


def test_every_plain_character(split):
    plain = [chr(c) for c in range(0x3000) if split.plain(chr(c))]
    assert len(plain) > 500
    for c in plain:
        for text in (c, f"a{c}b", c + c, f"1{c}!", f"{c}'s", f"A{c}"):
            assert sum(map(split.length, split(text))) == split.count_whole(text), repr(text)


@pytest.mark.parametrize("pattern", [token_counts.WORD_PATTERN, None])
@pytest.mark.parametrize("table", [{}, None])
def test_odd_texts(spark, split, pattern, table):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(2, ODD[2]), (None, "null id"), (99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS n_bytes", "1 AS n_tokens")
    got = token_counts.count_tokens(docs, PATH, pattern, table=table).collect()
    want = [(i, len((t or "").encode()), n := split.count_whole(t or ""), n > 2048) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(spark, empty):
    assert token_counts.count_tokens(empty, PATH, token_counts.WORD_PATTERN).collect() == []


def test_no_pre_token_is_shuffled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = token_counts.count_tokens(docs, PATH, token_counts.WORD_PATTERN)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_first_tier_is_bounded_and_right(spark, sf_dir, split):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    table = token_counts.frequent_lengths(docs, PATH, token_counts.WORD_PATTERN, table_words=200, seed_rows=10)
    assert 100 < len(table) <= 200
    assert all(split.length(w) == n and len(w) <= token_counts.WORD_CHARS for w, n in table.items())


def test_cache_goes_back_to_its_table():
    cache = token_counts.LengthCache({"a": 1}, len, room=3)
    for word in ("bb", "ccc", "bb", "dd", "eeeee", "x" * 99):
        assert cache[word] == len(word)
    assert len(cache) <= 4 and cache["a"] == 1 and cache.misses == 5
