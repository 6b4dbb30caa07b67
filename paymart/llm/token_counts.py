"""Token counts of whole texts with a public tokenizer, whatever their length.

Overlap resynchronisation. A text longer than ``chunk`` characters is encoded
in chunks that overlap by ``overlap`` characters, with offsets. Two neighbours
are spliced at a boundary that both encodings have in their overlap and that is
*stable*: the tokenizer's pre-tokenisation can't join the characters on its two
sides in any context, so what is left of it does not depend on what is right of
it. Then the tokens of the left chunk up to there and those of the right chunk
from there on are exactly the tokens of the whole text. If the overlap holds no
such boundary, it is doubled and both are aligned again; in the end (one run of
letters, say) the chunk grows over the whole run, and the count stays exact.

Stable for the pre-tokenisation of ``word_bpe_49k.json`` (pieces: contractions,
letter runs, single digits, symbol runs; white space dropped; composed and
lower-cased character by character):

* before an ASCII white space that no combining mark follows;
* between a letter and a character that is no letter;
* between a number and any character.

Letters, numbers and others are told by their Unicode category, after the tokenizer's
own composing and lower-casing of the character; characters that these turn into
several, combining marks, white space beyond ASCII and characters whose category has
changed since Unicode 3.2 (so the library's tables may differ) leave it open.

Never within reach of ``<|``, which may begin a special token's string.

White space is a stable boundary in every text, so within texts that need no
chunks the words between ASCII white space are encoded once each and remembered
(at most ``MEMO`` words a process; then the memory starts anew). Their trailing
symbols, and the case of ASCII words, do not matter for it by the same rules.

Null or empty text: 0 tokens. Repeated rows are counted each; an empty table
gives an empty table; other columns are left as they are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import lru_cache
import os
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 32_768
OVERLAP = 256
MEMO = 400_000
LONG_WORD = 256
_SPACE = frozenset(" \t\n\r")
_REACH = 32
_TAIL = b".,;:!?|*%$&#)"


class TokenCounter:
    """Counts tokens as the library gives them for the whole text, without
    added special tokens."""

    def __init__(self, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.chunk, self.overlap = tokenizer, chunk, overlap
        self.memo: dict[bytes, int] = {}  # tokens of words, and of their parts
        self.pieces: dict[bytes, int] = {}

    # ------------------------------------------------------- ordinary texts

    def counts(self, texts: list[str]) -> list[int]:
        split = [text.encode().split() if len(text) <= self.chunk else None for text in texts]
        words = {w for words in split if words for w in words if len(w) <= LONG_WORD}
        new = words - self.memo.keys()
        if len(self.memo) + len(new) > MEMO:
            self.memo, new = {}, words
        self._learn(new)
        memo = self.memo
        out = []
        for text, words in zip(texts, split):
            if words is None:
                out.append(self.count_long(text))
            else:
                out.append(sum(memo[w] if len(w) <= LONG_WORD else len(self._encode(w.decode())) for w in words))
        return out

    def _learn(self, words: set[bytes]) -> None:
        """Count the tokens of each word. An ASCII word is its letters and the
        symbols after them (a stable boundary), in lower case."""
        parts = {w: self._parts(w) for w in words}
        new = {p for pair in parts.values() for p in pair} - self.pieces.keys()
        if len(self.pieces) + len(new) > MEMO:
            self.pieces, new = {}, {p for pair in parts.values() for p in pair}
        pieces, known = list(new), self.pieces
        got = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        known.update(zip(pieces, map(len, got)))
        self.memo.update((w, known[a] + known[b]) for w, (a, b) in parts.items())

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        if not word.isascii() or b"<|" in word:
            return word, b""
        word = word.lower()
        core = word.rstrip(_TAIL)
        return (core, word[len(core):]) if core[-1:].isalpha() else (word, b"")

    # ----------------------------------------------------------- long texts

    def _encode(self, text: str) -> list[tuple[int, int]]:
        return self.tokenizer.encode(text, add_special_tokens=False).offsets

    def count_long(self, text: str) -> int:
        """Tokens of ``text``, encoded chunk by chunk and spliced."""
        total, begin, size = 0, 0, self.chunk
        left = self._encode(text[:size])
        done = 0  # tokens of the left chunk that lie before ``begin``
        overlap = self.overlap
        left_at, end = 0, min(size, len(text))
        while end < len(text):
            right_at = max(begin, end - overlap)
            right_end = min(len(text), right_at + overlap + self.chunk)
            right = self._encode(text[right_at:right_end])
            cut = self._common(text, left, left_at, end, right, right_at)
            if cut is None:
                if right_at > begin:
                    overlap *= 2
                else:  # nothing stable so far: the left chunk grows
                    left, left_at, end = right, right_at, right_end
                    done = bisect_left(left, begin - left_at, key=lambda x: x[0])
                    overlap = max(overlap, end - begin)
                continue
            at, n_left, n_right = cut
            total += n_left - done
            left, left_at, end, done, begin = right, right_at, right_end, n_right, at
            overlap = self.overlap
        return total + len(left) - done

    def _common(self, text: str, left: list, left_at: int, left_end: int, right: list,
                right_at: int) -> tuple[int, int, int] | None:
        """The last stable boundary that both encodings have in their overlap:
        (position, tokens of the left before it, tokens of the right before it)."""
        for at in range(left_end - 1, right_at, -1):
            if not stable(text, at):
                continue
            n_left, n_right = self._before(left, at - left_at), self._before(right, at - right_at)
            if n_left is not None and n_right is not None:
                return at, n_left, n_right
        return None

    @staticmethod
    def _before(offsets: list[tuple[int, int]], at: int) -> int | None:
        """How many tokens end at or before ``at``; None if one goes across it."""
        n = bisect_right(offsets, at, key=lambda x: x[1])
        return n if n == len(offsets) or offsets[n][0] >= at else None


def stable(text: str, at: int) -> bool:
    """Whether no piece of any tokenisation goes across position ``at``."""
    if not 0 < at < len(text):
        return False
    before, after = text[at - 1], text[at]
    if "<|" in text[max(0, at - _REACH):at + 2]:
        return False
    if after in _SPACE:
        return not unicodedata.category(text[at + 1:at + 2] or "x").startswith("M")
    left, right = kind(before), kind(after)
    if left == "L":
        return right in ("N", "O")
    return left == "N" and right is not None


@lru_cache(maxsize=1 << 16)
def kind(character: str) -> str | None:
    """``L`` letter, ``N`` number, ``O`` other visible character, None: not sure."""
    character = unicodedata.normalize("NFC", character).lower()
    if len(character) != 1:
        return None
    category = unicodedata.category(character)[0]
    if category != unicodedata.ucd_3_2_0.category(character)[0]:
        return None
    return {"L": "L", "N": "N", "P": "O", "S": "O"}.get(category)


@lru_cache(maxsize=4)
def _counter(path: str) -> TokenCounter:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    return TokenCounter(Tokenizer.from_file(path))


def token_count(text: Column, tokenizer: str) -> Column:
    """Column of token counts; ``tokenizer``: name of a file of the public
    vocabularies that every executor has installed."""
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        import public_tokenizers

        counter = _counter(public_tokenizers.path(tokenizer))
        out: list[int] = []
        for at in range(0, len(texts), 256):
            out += counter.counts(texts[at:at + 256].to_pylist())
        return pa.array(out, type=pa.int64())

    return count(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, text: str = "text", tokenizer: str = "word_bpe_49k.json",
                 limit: int = 2048) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens); clashing names are replaced."""
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"))
            .withColumn("n_tokens", token_count(F.col(text), tokenizer))
            .withColumn("over_limit", F.col("n_tokens") > limit))
