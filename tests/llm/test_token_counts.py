"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paymart.llm import token_counts
from paymart.llm.token_counts import TokenCounter, count_tokens, stable

LIB = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
PIECES = ["the", "don't", "I'LL", "abc123", "...", " ", "  ", "\n", "\t", "é", "é", "́", " ", "\x85", " ",
          "漢字漢字", "<|endoftext|>", "<|startof", "text|>", "😀", "''s", "'", "12", "A", "ǅ", "İ", "ß", "ﬁ", "x" * 90,
          "!?", "'s", "\x1c", "<|", "Σς", "‍"]


def whole(text):
    return len(LIB.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(6))
def test_chunks_equal_whole(seed):
    rnd = random.Random(seed)
    for chunk, overlap in ((8, 2), (20, 5), (64, 16), (300, 30)):
        counter = TokenCounter(LIB, chunk, overlap)
        texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 120))) for _ in range(60)]
        assert counter.counts(texts) == [whole(t) for t in texts]
        assert TokenCounter(LIB).counts(texts) == [whole(t) for t in texts]


def _letters(begin, end):
    return [chr(c) for c in range(begin, end) if chr(c).isalpha()]


SCRIPTS = {
    "cyrillic": (_letters(0x400, 0x460), " ,.!?—«»", 8), "greek": (_letters(0x370, 0x400), " ,.;·’", 8),
    "cjk": (_letters(0x4E00, 0x4F00), "，。！？、「」", 12), "arabic": (_letters(0x620, 0x650) + ["\u064B", "\u0651"], " ،؟.", 7),
    "devanagari": (_letters(0x905, 0x93A) + ["\u093E", "\u094D", "\u0902"], " ।,", 7),
    "mixed": (list("aZéßİıǅﬁΣςж漢٣२½²Ⅷ") + ["e\u0301", "\u0307", "\u212B", "ᄀ", "ᅡ", "ᆨ", "각"], " 1٣½'!\u00A0\u3000\u037E\u200D\u0301€", 4)}


def script_text(script, rnd, n):
    letters, marks, length = SCRIPTS[script]
    return "".join("".join(rnd.choices(letters, k=rnd.randint(1, length))) + rnd.choice(marks) + rnd.choice(["", "", " ", "7"])
                   for _ in range(n))


@pytest.mark.parametrize("script", SCRIPTS)
def test_every_script_is_spliced_exactly(script):
    rnd = random.Random(script)
    for chunk, overlap in ((8, 2), (40, 10), (200, 20)):
        counter = TokenCounter(LIB, chunk, overlap)
        for _ in range(150):
            text = script_text(script, rnd, rnd.randint(1, 60))
            assert counter.count_long(text) == whole(text), repr(text)


@pytest.mark.parametrize("script", ["cyrillic", "greek", "cjk", "arabic", "devanagari"])
def test_no_call_grows_with_the_text(script, monkeypatch):
    text = script_text(script, random.Random(9), 40_000)
    counter, sizes = TokenCounter(LIB), []
    encode = counter._encode
    monkeypatch.setattr(counter, "_encode", lambda part: sizes.append(len(part)) or encode(part))
    assert len(text) > 6 * counter.chunk
    assert counter.count_long(text) == whole(text)
    assert max(sizes) <= counter.chunk + 8 * counter.overlap


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 50)
    rnd = random.Random(1)
    counter = TokenCounter(LIB)
    for _ in range(20):
        texts = [" ".join(rnd.choice(["Word,", "word", "x%d!" % rnd.randint(0, 99), "It's", "<|EndOfText|>."])
                          for _ in range(30)) for _ in range(4)]
        assert counter.counts(texts) == [whole(t) for t in texts]


def test_no_boundary_at_all():
    counter = TokenCounter(LIB, 50, 10)
    for text in ("a" * 5000, "漢" * 900, "a" * 300 + " " + "b" * 300, " " * 1000, "é" * 400 + "1" * 400, "'s" * 300):
        assert counter.counts([text]) == [whole(text)]


def test_stable_positions():
    assert stable("ab cd", 2) and not stable("abcd", 2) and stable("ab!", 2) and not stable("a'", 5)
    assert stable("да нет", 2) and stable("да,", 2) and stable("漢。", 1) and stable("٣३", 1) and not stable("İ!", 1)
    assert not stable("a\u0301", 1) and not stable("a \u0301", 1) and not stable("'s", 1) and not stable("<|endoftext|>", 11)


def test_edge_rows(spark):
    rows = [(1, None, 5), (None, "", 6), (2, "Hello world", 7), (2, "Hello world", 7), (3, "word " * 30_000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df).collect()))
    want = sorted((len((t or "").encode()), whole(t or ""), whole(t or "") > 2048) for _, t, _ in rows)
    assert got == want
    assert count_tokens(df.limit(0)).collect() == []


def test_whole_table(spark):
    from paymart.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op7_token_counts"](spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {k: whole(t or "") for k, t in texts.items()}
