"""LM scoring by masked pseudo-likelihood.

A small network predicts every word of a text from the ``WINDOW`` words on both
of its sides; the sum of the conditional log-probabilities of all words is the
text's score.

* Vocabulary: every word of the corpus with its count (folded per Arrow batch and
  per task), a stored table that grows with the corpus. The ``TOP`` most frequent
  words are tokens of their own; all others share the remaining tokens by hash.
* A word of a shared token has the token's probability times its own share of the
  token's occurrences: (n + ``ADD``) / (N + ``ADD`` (V + 1)) for its count n, the
  token's N occurrences and V words; words never counted are one class of count 0.
  The counts of the at most ``COMMON`` most frequent words go to the tasks; the
  rarer words are joined with the table. Such a word is rarer than any common one,
  and so is a text that holds it: no key of the joins is hot.
* Network: the neighbours' vectors, each weighted by its distance and side, are
  summed and squashed; two softmax layers give the token's row and, given the
  row, its column in a ``SIDE`` x ``SIDE`` table of tokens. It starts from the
  corpus's token frequencies.
* Training: each task trains its own copy over all words of its share of the
  corpus, once (numpy, mini-batches, adagrad); the copies are averaged, weighted by
  words, in a grouped sum over parameters. ``rounds`` repeats this from the
  average. Neither the parameters nor their sum grow with the corpus.

Results: one row per input row, its columns kept (clashing names replaced), with
``n_tokens``, ``log_prob`` and ``mean_log_prob``. Text without words (null, empty,
white space): 0 tokens, ``log_prob`` 0, ``mean_log_prob`` null. Repeated rows are
scored each, alike. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm import textops as tx
from paymart.session import work_dir

SIDE = 32
TOP = 768
WINDOW = 3
DIM = 12
RATE = 0.08
BATCH = 8192
COMMON = 1 << 18
ADD = 0.5
_OFFSETS = [o for o in range(-WINDOW, WINDOW + 1) if o]
_CHUNK = 512


# --------------------------------------------------------------- vocabulary

@dataclass
class Vocabulary:
    """Sorted hashes of the most frequent words and their token numbers; any
    other word gets one of the tokens from ``TOP`` on by its hash.

    ``common``: sorted hashes of the words whose counts the tasks have, and
    ``common_counts``; ``counts``: the table (h, n) of the others (None: there are
    none); ``below``: log of what a word's count is divided by, per token."""
    hashes: np.ndarray
    numbers: np.ndarray
    frequency: np.ndarray = field(default_factory=lambda: np.ones(SIDE * SIDE))
    common: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=tx.U64))
    common_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    below: np.ndarray = field(default_factory=lambda: np.full(SIDE * SIDE, np.log(ADD)))
    counts: DataFrame | None = None

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        rest = SIDE * SIDE - TOP
        out = TOP + (tx.mix(hashes, 43) % tx.U64(rest)).astype(np.int32)
        if len(self.hashes):
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[place] == hashes
            out[known] = self.numbers[place[known]]
        return out

    def without_counts(self) -> Vocabulary:
        """What training needs of it."""
        return Vocabulary(self.hashes, self.numbers, self.frequency)

    def for_tasks(self) -> Vocabulary:
        return replace(self, counts=None)

    def shares(self, hashes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-probability of each word given its token, without the count's part
        where that is not known here; which words those are)."""
        shared = tokens >= TOP
        count = np.zeros(len(hashes), dtype=np.int64)
        known = np.zeros(len(hashes), dtype=bool)
        if len(self.common):
            place = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            known = self.common[place] == hashes
            count[known] = self.common_counts[place[known]]
        part = np.where(shared, np.log(count + ADD) - self.below[tokens], 0.0)
        rare = shared & ~known
        part[rare] = -self.below[tokens[rare]]
        return part, rare


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [tx.words_of(data, offsets).hashes for _, _, data, offsets in tx.text_slices(batch.column(0))]
        if parts:
            hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tx.as_signed(hashes)), pa.array(counts, type=pa.int64())],
                                             names=["h", "n"])


def _count_tokens(vocabulary: Vocabulary):
    """Map (h, n) to each token's occurrences and words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words = np.zeros(SIDE * SIDE, dtype=np.int64), np.zeros(SIDE * SIDE, dtype=np.int64)
        for batch in batches:
            token = vocabulary.tokens(batch.column(0).to_numpy().view(tx.U64))
            np.add.at(total, token, batch.column(1).to_numpy())
            words += np.bincount(token, minlength=SIDE * SIDE)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIDE * SIDE)), pa.array(total), pa.array(words)],
                                         names=["token", "n", "words"])
    return run


def build_vocabulary(texts: DataFrame) -> Vocabulary:
    """From the counts of all words of ``texts`` (one column)."""
    counts = texts.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    path = work_dir(texts.sparkSession, "lm-words")
    counts.write.parquet(path)
    counts = texts.sparkSession.read.schema("h long, n long").parquet(path)
    top = counts.orderBy(F.desc("n"), "h").limit(TOP).collect()
    hashes = np.array([r.h for r in top], dtype=np.int64).view(tx.U64)
    order = np.argsort(hashes)
    vocabulary = Vocabulary(hashes[order], np.arange(len(top), dtype=np.int32)[order])
    totals = (counts.mapInArrow(_count_tokens(vocabulary), "token long, n long, words long").groupBy("token")
              .agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect())  # one row per token
    total, words = np.zeros(SIDE * SIDE), np.zeros(SIDE * SIDE)
    for r in totals:
        total[r.token], words[r.token] = r.n, r.words
    # the lowest count that at most COMMON words reach, to an eighth of a power of two
    step = F.floor(F.log2("n") * 8)
    steps = sorted(((r.step, r.words) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"))
                    .collect()), reverse=True)  # at most 8 * 63 rows
    kept, least = 0, None
    for at, n in steps:
        if kept + n > COMMON:
            break
        kept, least = kept + n, at
    common = (counts.where(step >= F.lit(least)) if least is not None else counts.limit(0)).toArrow()
    found = common.column("h").to_numpy().view(tx.U64)
    order = np.argsort(found)
    rare = counts if least is None else counts.where(step < F.lit(least)) if kept < words.sum() else None
    return replace(vocabulary, frequency=1 + total, below=np.log(total + ADD * (words + 1)), common=found[order],
                   common_counts=common.column("n").to_numpy()[order], counts=rare)


# ------------------------------------------------------------------ network

SHAPES = {"vectors": (SIDE * SIDE + 1, DIM), "places": (len(_OFFSETS), DIM), "shift": (DIM,),
          "row": (DIM, SIDE), "row_bias": (SIDE,), "column": (DIM, SIDE), "column_bias": (SIDE, SIDE)}


def initial(frequency: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters that predict the token frequencies from any context."""
    rnd = np.random.default_rng(7)
    p = {k: rnd.normal(0, 0.1, shape).astype(np.float32) for k, shape in SHAPES.items()}
    table = (frequency / frequency.sum()).reshape(SIDE, SIDE)
    rows = table.sum(axis=1)
    p["places"][:] = 1 / len(_OFFSETS)
    p["places"] += rnd.normal(0, 0.05, p["places"].shape).astype(np.float32)
    p["vectors"] *= 5
    p["shift"][:] = 0
    p["row"] *= 0.1
    p["column"] *= 0.1
    p["row_bias"] = np.log(rows).astype(np.float32)
    p["column_bias"] = np.log(table / rows[:, None]).astype(np.float32)
    return p


def pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k] = flat[at:at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def padded(tokens: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one line with ``WINDOW`` blanks between them, and where each
    word stands in it."""
    at = np.arange(len(tokens)) + WINDOW * (text + 1)
    line = np.full(len(tokens) + WINDOW * (n_texts + 1), SIDE * SIDE, dtype=np.int32)
    line[at] = tokens
    return line, at


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _forward(p: dict[str, np.ndarray], line: np.ndarray, at: np.ndarray):
    near = sum(p["vectors"][line[at + o]] * p["places"][i] for i, o in enumerate(_OFFSETS))
    hidden = np.tanh(near + p["shift"])
    token = line[at]
    row, column = token // SIDE, token % SIDE
    p_row = _softmax(hidden @ p["row"] + p["row_bias"])
    p_column = _softmax(hidden @ p["column"] + p["column_bias"][row])
    return hidden, row, column, p_row, p_column


def log_probs(p: dict[str, np.ndarray], line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of each word given the words on both sides."""
    out = np.empty(len(at))
    for begin in range(0, len(at), BATCH):
        part = at[begin:begin + BATCH]
        _, row, column, p_row, p_column = _forward(p, line, part)
        n = np.arange(len(part))
        out[begin:begin + BATCH] = np.log(np.maximum(p_row[n, row] * p_column[n, column], 1e-30))
    return out


def _gradient(p: dict[str, np.ndarray], line: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    hidden, row, column, d_row, d_column = _forward(p, line, at)
    n = np.arange(len(at))
    d_row[n, row] -= 1
    d_column[n, column] -= 1
    back = (d_row @ p["row"].T + d_column @ p["column"].T) * (1 - hidden**2)
    which = np.zeros((len(at), SIDE), dtype=np.float32)
    which[n, row] = 1
    g = {"row": hidden.T @ d_row, "row_bias": d_row.sum(axis=0), "column": hidden.T @ d_column,
         "column_bias": which.T @ d_column, "shift": back.sum(axis=0),
         "places": np.empty(SHAPES["places"], dtype=np.float32)}
    # a position's vector is used by its neighbours on both sides
    begin, end = at[0] - WINDOW, at[-1] + WINDOW + 1
    used = np.zeros((end - begin, DIM), dtype=np.float32)
    for i, o in enumerate(_OFFSETS):
        g["places"][i] = (back * p["vectors"][line[at + o]]).sum(axis=0)
        used[at + o - begin] += back * p["places"][i]
    ids = line[begin:end]
    g["vectors"] = np.stack([np.bincount(ids, weights=used[:, d], minlength=SIDE * SIDE + 1) for d in range(DIM)], axis=1)
    return g


class Trainer:
    """Adagrad over mini-batches, from given parameters."""

    def __init__(self, start: np.ndarray, rate: float = RATE):
        self.p, self.rate, self.words = unpack(start.copy()), rate, 0
        self.seen = {k: np.full(shape, 1e-6, dtype=np.float32) for k, shape in SHAPES.items()}

    def learn(self, line: np.ndarray, at: np.ndarray) -> None:
        for begin in range(0, len(at), BATCH):
            part = at[begin:begin + BATCH]
            for k, g in _gradient(self.p, line, part).items():
                g = (g / len(part)).astype(np.float32)
                self.seen[k] += g * g
                self.p[k] -= self.rate * g / np.sqrt(self.seen[k])
        self.words += len(at)


# ----------------------------------------------------------------- operator

def _lines(vocabulary: Vocabulary, texts: pa.Array):
    for _, _, data, offsets in tx.text_slices(texts):
        words = tx.words_of(data, offsets)
        line, at = padded(vocabulary.tokens(words.hashes), words.text, len(offsets) - 1)
        yield words, line, at


def _train(vocabulary: Vocabulary, start: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(start)
        for batch in batches:
            for _, line, at in _lines(vocabulary, batch.column(0)):
                if len(at):
                    trainer.learn(line, at)
        if trainer.words:
            flat = pack(trainer.p).astype(np.float64) * trainer.words
            cuts = range(0, len(flat), _CHUNK)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(range(len(cuts))), type=pa.int32()),
                pa.array([trainer.words] * len(cuts), type=pa.int64()),
                pa.array([flat[c:c + _CHUNK] for c in cuts], type=pa.list_(pa.float64()))],
                names=["chunk", "words", "sums"])
    return run


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = 1) -> np.ndarray:
    """Parameters after ``rounds`` passes over all texts (one column)."""
    flat = pack(initial(vocabulary.frequency))
    vocabulary = vocabulary.without_counts()
    for _ in range(rounds):
        copies = texts.mapInArrow(_train(vocabulary, flat), "chunk int, words long, sums array<double>")
        sums = (copies.select("chunk", "words", F.posexplode("sums").alias("place", "value"))
                .groupBy("chunk", "place").agg((F.sum("value") / F.sum("words")).alias("mean"))
                .orderBy("chunk", "place").select("mean"))
        mean = sums.toArrow().column("mean").to_numpy()  # one number per parameter
        if len(mean):
            flat = mean.astype(np.float32)
    return flat


def _rare_words(vocabulary: Broadcast):
    """Map (text) to (key of the text, hash) of the words whose counts the tasks
    don't have, one row for each occurrence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for begin, _, data, offsets in tx.text_slices(batch.column(1)):
                words = tx.words_of(data, offsets)
                _, rare = vocabulary.value.shares(words.hashes, vocabulary.value.tokens(words.hashes))
                yield pa.RecordBatch.from_arrays([pa.array(keys[begin + words.text[rare]]),
                                                  pa.array(tx.as_signed(words.hashes[rare]))], names=["key", "h"])
    return run


def score_documents(docs: DataFrame, text: str = "text", rounds: int = 1,
                    model: tuple[Vocabulary, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``log_prob`` and ``mean_log_prob``; ``model``: by
    default trained on ``docs``."""
    words_in = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(words_in.alias("text"))
    if model is None:
        vocabulary = build_vocabulary(texts)
        model = vocabulary, train(texts, vocabulary, rounds)
    vocabulary, flat = model
    counts, sent = vocabulary.counts, docs.sparkSession.sparkContext.broadcast(vocabulary.for_tasks())
    whole = counts is None

    @F.arrow_udf("struct<n:long,log_prob:double,rare:long>")
    def score(texts: pa.Array) -> pa.Array:
        p, sizes, sums, rares = unpack(flat), [], [], []
        for words, line, at in _lines(sent.value, texts):
            part, rare = sent.value.shares(words.hashes, line[at])
            if whole:  # a word that isn't common was never counted
                part[rare] += np.log(ADD)
            total = np.concatenate([[0.0], np.cumsum(log_probs(p, line, at) + part)])
            sizes.append(np.diff(words.first))
            sums.append(np.diff(total[words.first]))
            rares.append(np.diff(np.concatenate([[0], np.cumsum(rare)])[words.first]))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(x) if x else [], type=t)
             for x, t in ((sizes, pa.int64()), (sums, pa.float64()), (rares, pa.int64()))], names=["n", "log_prob", "rare"])

    kept = [c for c in docs.columns if c not in ("n_tokens", "log_prob", "mean_log_prob")]
    scored = docs.select(*kept, score(words_in).alias("__lm"), F.xxhash64(words_in).alias("__lm_text"))
    log_prob = F.col("__lm.log_prob")
    if not whole:
        # equal texts have one key: their rare words' sum is shared out among them
        sums = (docs.select(F.xxhash64(words_in).alias("key"), words_in.alias("text"))
                .mapInArrow(_rare_words(sent), "key long, h long").join(counts, "h", "left").groupBy("key")
                .agg(F.avg(F.log(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("__lm_rare")))
        # a text without rare words may be frequent: it meets nothing, spread by its
        # row (maps can't be hashed)
        row = [f.name for f in docs.schema if f.name in kept and "map<" not in f.dataType.simpleString()]
        key = F.when(F.col("__lm.rare") > 0, F.col("__lm_text")).otherwise(F.xxhash64("__lm_text", *row))
        scored = (scored.withColumn("__lm_key", key)
                  .join(sums.withColumnRenamed("key", "__lm_key"), "__lm_key", "left"))
        log_prob = log_prob + F.when(F.col("__lm.rare") > 0, F.col("__lm.rare") * F.col("__lm_rare")).otherwise(0.0)
    return (scored.withColumn("__lm_log_prob", log_prob)
            .select(*kept, F.col("__lm.n").alias("n_tokens"), F.col("__lm_log_prob").alias("log_prob"),
                    F.when(F.col("__lm.n") > 0, F.col("__lm_log_prob") / F.col("__lm.n")).alias("mean_log_prob")))
