"""Hashes in blocks: the same as over the whole text, whatever the order and length of spans."""

import numpy as np

from paymart.llm import textops as tx


def plain(data, a, b):
    total = 0
    for i, x in enumerate(data[a:b].tolist()):
        total += int(tx._BYTE_VALUE[x]) * pow(tx._ODD_BYTE, i, 1 << 64)
    return int(tx.mix(np.array([total % (1 << 64)], dtype=tx.U64), 1)[0])


def test_spans_of_any_order_and_length(monkeypatch):
    rnd = np.random.default_rng(1)
    for block in (7, 64, 1 << 16):
        monkeypatch.setattr(tx, "BLOCK", block)
        monkeypatch.setattr(tx, "_tables", {})
        data = rnd.integers(0, 256, 500).astype(np.uint8)
        starts = rnd.integers(0, 500, 200)
        ends = np.minimum(starts + rnd.integers(0, 90, 200), 500)
        for order in (np.argsort(starts), np.arange(200)):
            got = tx.span_hashes(data, starts[order], ends[order])
            assert got.tolist() == [plain(data, a, b) for a, b in zip(starts[order], ends[order])]
    assert len(tx.span_hashes(data, starts[:0], ends[:0])) == 0


def test_powers_beyond_a_block():
    up, down = tx.powers(tx._ODD_WORD, 3 * tx.BLOCK + 5)
    for i in (0, 1, tx.BLOCK - 1, tx.BLOCK, 2 * tx.BLOCK + 3, 3 * tx.BLOCK + 4):
        assert int(up[i]) == pow(tx._ODD_WORD, i, 1 << 64)
        assert int(up[i]) * int(down[i]) % (1 << 64) == 1


def test_a_long_text_is_hashed_in_little_memory():
    import tracemalloc
    data = np.frombuffer(b"some words and others " * 400_000, dtype=np.uint8)
    tracemalloc.start()
    words = tx.words_of(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words.starts) == 1_600_000 and peak < 20 * len(data)
