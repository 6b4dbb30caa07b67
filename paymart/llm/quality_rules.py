"""Quality rules as weak supervision.

Rules vote ``good``, ``bad`` or abstain on each text. How far each is to be
trusted is not set by hand: expectation-maximisation over the vote patterns of
the whole table estimates each rule's accuracy and the share of good texts. A text is kept if its posterior probability
of being good reaches ``KEEP``, not if it passes every rule; texts that fail the
two base limits are dropped whatever the posterior.

Measures are taken once per text, vectorised, and written to the shared folder;
vote patterns are counted by a fold in each task. The pattern table has at most
3 ** (number of rules) rows, whatever the corpus, so it alone goes to the driver
for the estimation and is broadcast back.

Results: one row per input row (all its columns; clashing names replaced) with
``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
``base_failed``, ``p_good`` and ``kept``. Null or empty text: no words, base
failed. Repeated rows are judged each, alike. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.llm import textops as tx
from paymart.session import work_dir

REPEAT_WIDTH = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP = 0.5
BAD, ABSTAIN, GOOD = 0, 1, 2

# Characters counted as symbols, sentence ends, frequent words.
SYMBOLS = "#*$%&|<>"
SENTENCE_ENDS = ".!?"
STOP_WORDS = ("the of and to in a is that it for on with as was be by this are at from "
              "der die und das in zu den von ist des mit ein eine auf nicht sich im "
              "le la les de des et un une en que est pour qui par au sur "
              "el los las y del se una por con para").split()

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_letters", "n_ends", "n_stop", "n_distinct")


def _mask(characters: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[list(characters.encode())] = True
    return mask


_SYMBOL, _END = _mask(SYMBOLS), _mask(SENTENCE_ENDS)
_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _mask("abcdefghijklmnopqrstuvwxyz")
_NEWLINE = _mask("\n")


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return np.unique(tx.words_of(data, np.array([0, len(data)])).hashes)


_STOP_HASHES = _hashes(STOP_WORDS)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text's range."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which keys occur more than once within their text."""
    own = keys ^ tx.mix(text.astype(tx.U64), 37)
    order = np.sort(own)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    return np.isin(own, again) if len(again) else np.zeros(len(own), dtype=bool)


def _distinct(keys: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Distinct keys in each text (``text`` ascending)."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    fresh = np.ones(len(k), dtype=bool)
    fresh[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[fresh], minlength=n_texts)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n_texts = len(offsets) - 1
    words = tx.words_of(data, offsets)
    lines = tx.words_of(data, offsets, _NEWLINE)  # non-empty lines
    spaces = np.concatenate([[0], np.cumsum(~tx.SPACE[data])])
    with_word = spaces[lines.ends] > spaces[lines.starts]
    line_text, line_hash = lines.text[with_word], lines.hashes[with_word]
    n_lines = np.bincount(line_text, minlength=n_texts)

    at = np.flatnonzero(tx.inside(words, REPEAT_WIDTH))
    windows = tx.window_hashes(words.hashes, REPEAT_WIDTH)[at]
    found = at[_repeats(windows, words.text[at])]
    cover = np.zeros(len(words.text) + 1, dtype=np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + REPEAT_WIDTH, -1)
    repeated = np.cumsum(cover)[:-1] > 0

    solid = ~tx.SPACE[data] & ((data & 0xC0) != 0x80)
    last = data[words.ends - 1] if len(words.ends) else data[:0]
    return {
        "n_words": np.diff(words.first),
        "word_chars": _per_text(solid, offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": n_lines - _distinct(line_hash, line_text, n_texts),
        "n_repeat_words": _per_text(repeated, words.first),
        "n_lines": n_lines,
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_letters": _per_text(_LETTER[data], offsets),
        "n_ends": _per_text(_END[last], words.first),
        "n_stop": _per_text(np.isin(words.hashes, _STOP_HASHES), words.first),
        "n_distinct": _distinct(words.hashes, words.text, n_texts),
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of each text. Columns other than the text pass
    through unread."""
    kind = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

    @F.arrow_udf(kind)
    def take(texts: pa.Array) -> pa.Array:
        parts = [measure(data, offsets) for _, _, data, offsets in tx.text_slices(texts)]
        columns = [np.concatenate([p[m] for p in parts]) if parts else np.zeros(0) for m in MEASURES]
        return pa.StructArray.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=list(MEASURES))

    return docs.withColumn("__rule_m", take(F.coalesce(F.col(text), F.lit(""))))


# ------------------------------------------------------------------- rules

def _vote(good: Column | None, bad: Column) -> Column:
    """Bad on a violation; good only on positive evidence; else no vote."""
    vote = F.when(bad, BAD)
    return (vote if good is None else vote.when(good, GOOD)).otherwise(ABSTAIN)


def votes(m: Column) -> dict[str, Column]:
    """The rules' votes on a text's measures."""
    words = F.greatest(m["n_words"], F.lit(1))
    share = lambda c: m[c] / words
    upper = m["n_upper"] / F.greatest(m["n_letters"], F.lit(1))
    mean = m["word_chars"] / words
    return {
        "length": _vote(None, m["n_words"] < MIN_WORDS),
        "word_length": _vote(None, (mean < 2.5) | (mean > 12)),
        "symbols": _vote(None, share("n_symbols") > 0.1),
        "lines": _vote(None, m["n_dup_lines"] * 4 > m["n_lines"]),
        "repeats": _vote(None, share("n_repeat_words") > 0.25),
        "case": _vote(None, upper > 0.4),
        "sentences": _vote(None, (share("n_ends") > 0.5) | ((m["n_ends"] == 0) & (m["n_words"] >= 50))),
        "stop_words": _vote(share("n_stop") > 0.1, share("n_stop") < 0.01),
        "variety": _vote(None, m["n_distinct"] * 10 < m["n_words"]),
    }


def pattern(m: Column) -> Column:
    """All votes as one number in base 3."""
    code = F.lit(0)
    for vote in votes(m).values():
        code = code * 3 + vote
    return code.cast("int")


RULES = ("length", "word_length", "symbols", "lines", "repeats", "case", "sentences", "stop_words", "variety")


def estimate(codes: np.ndarray, counts: np.ndarray, n_rules: int = len(RULES), rounds: int = 200,
             accuracy: float = 0.85, good_share: float = 0.9,
             strength: float = 0.5) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns: (posterior probability of
    good per pattern, accuracy of each rule's votes, share of good).

    A rule that votes is right with its accuracy, whatever the class; whether it
    votes says nothing. ``accuracy`` and ``good_share`` are where it starts and
    also priors that count as ``strength`` times the votes seen: rules that
    mostly vote alone can't make themselves infallible, and no accuracy falls
    below a half (a rule is not turned round).
    """
    ballots = np.stack([codes // 3 ** (n_rules - 1 - j) % 3 for j in range(n_rules)], axis=1)
    good, bad = (ballots == GOOD).astype(float), (ballots == BAD).astype(float)
    cast = counts @ (good + bad)
    learned, share = np.full(n_rules, accuracy), good_share
    post = np.zeros(len(codes))
    for _ in range(rounds):
        odds = np.log(share / (1 - share)) + (good - bad) @ np.log(learned / (1 - learned))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        moved = np.abs(new - post).max() if len(post) else 0.0
        post = new
        right = (counts * post) @ good + (counts * (1 - post)) @ bad
        learned = (right + accuracy * (strength * cast + 1)) / (cast + strength * cast + 1)
        learned = np.clip(learned, 0.5, 0.999)
        n = counts.sum()
        share = ((counts * post).sum() + good_share * (strength * n + 1)) / (n + strength * n + 1)
        if moved < 1e-9:
            break
    return post, learned, float(share)


def judge_quality(docs: DataFrame, text: str = "text", keep: float = KEEP) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``p_good`` and ``kept``."""
    spark = docs.sparkSession
    out = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "p_good", "kept")
    columns = [c for c in docs.columns if c not in out]
    m = F.col("__rule_m")
    base = measured(docs, text).select(*columns, m, pattern(m).alias("__rule_pattern"))
    path = work_dir(spark, "quality-measures")
    base.write.parquet(path)
    base = spark.read.schema(base.schema).parquet(path)
    # at most 3 ** len(RULES) rows
    seen = base.groupBy("__rule_pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("__rule_pattern").collect()
    codes = np.array([r[0] for r in seen], dtype=np.int64)
    post, _, _ = estimate(codes, np.array([r[1] for r in seen], dtype=float))
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, post)], "__rule_pattern int, p_good double")
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    return (base.join(F.broadcast(table), "__rule_pattern")
            .select(*columns, *(m[x].alias(x) for x in out[:5]), failed.alias("base_failed"), "p_good",
                    (~failed & (F.col("p_good") >= keep)).alias("kept")))
