"""Token alignment against brute force over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from paymart.llm import token_alignment
from paymart.llm.token_alignment import RANKS_A, TOKENIZER_A, TOKENIZER_B, Aligner, align_tokens


@pytest.fixture(scope="module")
def aligner():
    return Aligner(*map(public_tokenizers.path, (TOKENIZER_A, TOKENIZER_B, RANKS_A[TOKENIZER_A])))


def whole_tokens(aligner, text):
    """Ids by the libraries on the whole text, or none."""
    if not text:
        return [], []
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    whole = b" " + text.encode()
    same = (b"".join(aligner.bytes_a[i] for i in a) == whole, b"".join(aligner.bytes_b[i] for i in b) == whole)
    return (a, b) if all(same) else ([], [])


def brute(aligner, rows):
    found, counts = [], Counter()
    for i, text in rows:
        a, b = whole_tokens(aligner, text)
        spans = []
        for ids, table in ((a, aligner.bytes_a), (b, aligner.bytes_b)):
            at, out = 0, []
            for x in ids:
                out.append((at, at + len(table[x]), x))
                at += len(table[x])
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = [tuple(",".join(str(t[2]) for t in s if begin <= t[0] < end) for s in spans)
                  for begin, end in zip([0, *cuts], cuts)]
        found.append((i, len(a), len(b), len(groups), links, groups))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted((i, n_a, n_b, n_g, len(links), sum(counts[p] == most[p[1]] for p in links),
                   sum(counts[p] for p in links),
                   hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if groups else "")
                  for i, n_a, n_b, n_g, links, groups in found)


WORDS = ["the", "naïve", "Straße", "東京都", "русский", "عربي", "it's", "don't", "1234", "x9", "<|endoftext|>", "<s>",
         "<0x41>", "▁", "é", "👍🏽", "a_b", "...", " ", "ﬁ", "​", "re're", "İ", "%$", "unbelievably"]
GAPS = [" ", " ", " ", " ", "  ", "\n", "\t", "", "   ", "\r\n", "　"]


def random_text(rnd, n):
    return "".join(rnd.choice(WORDS) + rnd.choice(GAPS) for _ in range(n))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, align_tokens(df).collect()))


def test_random_texts(spark, aligner):
    rnd = random.Random(1)
    rows = [(i, random_text(rnd, rnd.randint(0, 40))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, " lead"), (1004, "trail "), (1005, "\x00a"), (1006, "a▁b"),
             (1007, "퟿"), (7, rows[7][1]), (8, "a second row with this id")]
    expected = brute(aligner, rows)
    assert run(spark, rows) == expected
    assert any(r[1] == 0 for r in expected) and sum(r[1] > 0 for r in expected) > 20


def test_small_batches_and_memo(spark, aligner, monkeypatch):
    rnd = random.Random(2)
    texts = [random_text(rnd, rnd.randint(0, 30)) for _ in range(60)]
    monkeypatch.setattr(token_alignment, "MEMO", 20)
    monkeypatch.setattr(token_alignment, "STEP", 7)
    monkeypatch.setattr(token_alignment, "LONG", 5)
    expected = brute(aligner, list(enumerate(texts)))
    for size in (1, 7, 60):
        got = []
        for begin in range(0, 60, size):
            docs, _ = aligner.batch(texts[begin:begin + size])
            got += list(zip(docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_links"], docs["groups_sha256"]))
        assert [tuple(map(str, g)) for g in got] == [tuple(map(str, (*r[1:5], r[7]))) for r in expected]


def test_empty_table_and_extra_columns(spark, aligner):
    assert run(spark, []) == []
    rows = [(1, "one two three"), (2, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, batch int, pairs int, n_a int")
    assert sorted(map(tuple, align_tokens(df).collect())) == brute(aligner, rows)
    assert run(spark, [(1, None), (2, "")]) == brute(aligner, [(1, None), (2, "")])


def test_parts_give_the_tokens_of_the_whole(aligner):
    rnd = random.Random(3)
    odd = [chr(c) for c in (*range(0x20), 0x7F, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x200B, 0x2060, 0x2581, 0x3000, 0xFEFF, 0x301,
                            0x5D0, 0x661, 0x1F600)]
    parted = 0
    for n in range(600):
        text = random_text(rnd, rnd.randint(1, 60))
        for _ in range(n % 4):
            at = rnd.randrange(len(text) + 1)
            text = text[:at] + rnd.choice([" ", ""]) + rnd.choice(odd) + rnd.choice([" ", ""]) + text[at:]
        text = text.replace("\u2581", "") if n % 2 else text
        if n % 3 == 0:  # no white space but single blanks
            text = " ".join(text.split())
        parted += len(token_alignment.parts_of(text)) > 3
        assert tuple(ids.tolist() for ids, _ in aligner.tokens([text])) == whole_tokens(aligner, text)
    assert parted > 400


def test_ranks_give_the_ids_of_the_vocabulary(aligner):
    rnd = random.Random(5)
    plain = [chr(c) for c in (0x0A, *range(0x20, 0x7F), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    for n in range(3000):
        letters = plain if n % 3 else rnd.sample(plain, 4)
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 64)))
        if n % 5 == 0:
            text = rnd.choice(["'s", "'LL", "don't", "  ", "\n\n", "1234", "<|endoftext|>", "éÀß"]) + text
        assert token_alignment._PLAIN.fullmatch(text)
        assert aligner.by_rank(" " + text) == aligner.a.encode(" " + text, add_special_tokens=False).ids, text


def test_very_long_texts(spark, aligner):
    rnd = random.Random(4)
    text = random_text(rnd, 60_000)
    rows = [(1, text.replace("▁", "")), (2, "word " * 200_000), (3, "x" * 50_000)]
    got = run(spark, rows)
    for (i, text), row in zip(rows, got):
        a, b = whole_tokens(aligner, text)
        assert row[:3] == (i, len(a), len(b)) and len(a) > 0
