"""Phrase collocation mining by prefix-free parsing.

A text is a sequence of words and breaks: A-Z are lower-cased, each of
``[.,;:!?\\x0A-\\x0D]`` is a break, words are the runs of other characters than
blank and tab between breaks. A pair of neighbours whose hash is divisible by
``MODULUS`` is a trigger. The parse cuts each text into chunks from one trigger
to the next, both triggers included, so neighbouring chunks overlap by as many
words as the longest phrase has, less one; equal passages give equal chunks
wherever they stand. Where no trigger comes within ``LONGEST`` words, a chunk
ends there.

1. The dictionary: distinct chunks and how often the corpus has each. A phrase
   belongs to the chunk in which it starts before the overlap, so the phrases in
   an overlap are counted once, by the later chunk.
2. Words and pairs of the distinct chunks, weighted by the chunk's frequency, are
   counted under 64-bit hashes. Those below the minimum count can be no part of a
   candidate. The others set their bits in a bitmap of ``BITS`` bits, the only
   thing that is collected and broadcast (16 MB, whatever the corpus). Collisions
   only let more phrases pass; a corpus so large that the bitmap is full loses
   speed, never phrases.
3. Phrases whose words and pairs pass are counted exactly, by their text.

Everything is per language (null: ``und``). Scores use 38-digit decimals; a count
may have up to 15 digits. The first ``top`` of a language are taken from the first
``top`` of each of ``SALTS`` shares of its candidates, so no task sees them all.

Results: (lang, rank, phrase, a, l, r, n, score), see ``mine_collocations``. A null
or empty text has no words. Repeated rows count each time. A language without
candidates has no rows; neither has an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm import textops
from paymart.session import stored_once

WORDS = 3
MIN_COUNT = 10
TOP = 2000
MODULUS = 32
LONGEST = 1024
BITS = 1 << 27
SALTS = 32
BATCH_BYTES = 12 << 20
UNKNOWN = "und"

#: What ends a piece, what stands between words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
_BREAK, _BLANK = 0x0A, 0x20

_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[ord("A"):ord("Z") + 1] += 32
_TABLE[list(BREAKS)] = _BREAK
_TABLE[list(BLANKS)] = _BLANK
_GAP = np.zeros(256, dtype=bool)
_GAP[[_BREAK, _BLANK]] = True

_CHUNKS = "lang string, chunk string, last boolean, freq long, words long"


def chunk_spans(data: np.ndarray, offsets: np.ndarray, overlap: int,
                modulus: int = MODULUS, longest: int = LONGEST) -> Iterator[tuple[int, int, int, bool, int]]:
    """The parse of translated texts ``data[offsets[i]:offsets[i + 1]]``: (text,
    begin byte, end byte, whether it is the text's last chunk, words that start
    before the overlap)."""
    words = textops.words_of(data, offsets, _GAP)
    if not len(words.starts):
        return
    broken = np.concatenate([[0], np.cumsum(data == _BREAK)])
    # neighbours with a break between them get another hash than without
    gap = broken[words.starts[1:]] > broken[words.ends[:-1]]
    pair = textops.mix(words.hashes[:-1] * textops.U64(3) + words.hashes[1:] + gap.astype(textops.U64), 11)
    trigger = pair % textops.U64(modulus) == 0
    for text, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if a == b:
            continue
        cuts = [int(a)]
        for cut in [*(np.flatnonzero(trigger[a:b - 1]) + a).tolist(), int(b)]:
            while cut - cuts[-1] > longest:
                cuts.append(cuts[-1] + longest)
            if cuts[-1] < cut < b:
                cuts.append(cut)
        for i, begin in enumerate(cuts):
            # a last chunk holds all words up to the text's end
            if i + 1 == len(cuts) or cuts[i + 1] + overlap >= b:
                yield text, int(words.starts[begin]), int(words.ends[b - 1]), True, int(b) - begin
                break
            end = cuts[i + 1]
            yield text, int(words.starts[begin]), int(words.ends[end + overlap - 1]), False, end - begin


def _tokens(chunk: bytes) -> bytes:
    """A translated chunk with one blank between its words and breaks."""
    return b" ".join(filter(None, chunk.replace(b"\n", b" \n ").split(b" ")))


def _parse(overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for begin, _, data, offsets in textops.text_slices(batch.column("text")):
                data = _TABLE[data]
                whole = data.tobytes()
                rows = [(langs[begin + t], _tokens(whole[s:e]), last, n)
                        for t, s, e, last, n in chunk_spans(data, offsets, overlap)]
                for i in range(0, len(rows), 10_000):
                    lang, chunk, last, n = zip(*rows[i:i + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lang, pa.string()), pa.array(chunk, pa.binary()).cast(pa.string()),
                         pa.array(last, pa.bool_()), pa.array([1] * len(n), pa.int64()), pa.array(n, pa.int64())],
                        ["lang", "chunk", "last", "freq", "words"])
    return run


def chunk_dictionary(docs: DataFrame, words: int = WORDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """Distinct chunks (lang, chunk, last) with their frequency and the words that
    all their occurrences account for."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text).cast("string").alias("text"))
    return (rows.mapInArrow(_parse(max(1, words - 1)), _CHUNKS)
            .groupBy("lang", "chunk", "last").agg(F.sum("freq").alias("freq"), F.sum("words").alias("words")))


class _Phrases:
    """Phrases of up to ``words`` words of some distinct chunks, as exact numbers:
    of its words, and of its first words with the last."""

    def __init__(self, table: pa.Table, words: int):
        lang = table.column("lang").combine_chunks().dictionary_encode()
        tokens = pc.split_pattern(table.column("chunk").combine_chunks().cast(pa.large_string()), " ")
        self.lang_names = lang.dictionary.to_pylist()
        size = np.diff(tokens.offsets.to_numpy())
        coded = tokens.flatten().dictionary_encode()
        self.words = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64)
        chunk = np.repeat(np.arange(len(size)), size)
        solid = pc.not_equal(coded.dictionary, "\n").to_numpy(zero_copy_only=False)[ids]
        # pieces: runs of words of one chunk without a break
        place = np.flatnonzero(solid)
        self.ids, chunk = ids[place], chunk[place]
        self.lang = lang.indices.to_numpy().astype(np.int64)[chunk]
        self.freq = table.column("freq").to_numpy()[chunk]
        same = (np.diff(place) == 1) & (np.diff(chunk) == 0)
        n = len(place)
        self.fits = [np.ones(n, dtype=bool)]
        for k in range(1, words):
            more = np.zeros(n, dtype=bool)
            if n > k:
                more[:n - k] = self.fits[k - 1][:n - k] & same[k - 1:]
            self.fits.append(more)
        # the words before the overlap: all of a last chunk, else all but ``words - 1``
        first = np.searchsorted(chunk, np.arange(len(size)))
        count = np.bincount(chunk, minlength=len(size)) if n else np.zeros(len(size), dtype=np.int64)
        last = table.column("last").to_numpy()
        own = np.where(last, count, np.maximum(count - max(1, words - 1), 0))
        self.owned = (np.arange(n) - first[chunk]) < own[chunk]

    def counted(self, k: int, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of the phrases of ``k`` words, one place of each and its count."""
        mask = self.fits[k - 1] & self.owned
        if only is not None:
            mask &= only
        at = np.flatnonzero(mask)
        if not len(at):
            return at, np.zeros(0, dtype=np.int64)
        key = self.lang[at]
        for i in range(k):
            _, one, key = np.unique(key * np.int64(len(self.words)) + self.ids[at + i],
                                    return_index=True, return_inverse=True)
        order = np.argsort(key, kind="stable")
        begins = np.searchsorted(key[order], np.arange(len(one)))
        return at[one], np.add.reduceat(self.freq[at][order], begins)

    def hashes(self, k: int) -> np.ndarray:
        """A 64-bit hash of the phrase of ``k`` words (1 or 2) at each place that
        has that many following it."""
        by_lang = pd.util.hash_array(np.array(self.lang_names, dtype=object), categorize=False)
        by_word = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False), categorize=False)
        out = textops.mix(by_lang[self.lang] + by_word[self.ids], k)
        if k == 2 and len(out):
            out[:-1] = textops.mix(out[:-1] * textops.U64(5) + by_word[self.ids[1:]], k)
        return out

    def text(self, at: np.ndarray, k: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.ids[at + i])).cast(pa.string()) for i in range(k)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ")) if k > 1 else parts[0]


def _gathered(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.Table]:
    """Batches put together up to ``limit`` bytes, so that equal phrases meet."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _hash_counts(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            phrases = _Phrases(table, words)
            for k in range(1, min(2, words) + 1):
                at, count = phrases.counted(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(textops.as_signed(phrases.hashes(k)[at])), pa.array(count)], ["hash", "n"])
    return run


def _spark_phrases(words: int, bitmap, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(bitmap.value, dtype=np.uint8)

        def passes(hashes: np.ndarray) -> np.ndarray:
            slot = hashes & textops.U64(bits - 1)
            return (frequent[(slot >> textops.U64(3)).astype(np.int64)] >> (slot & textops.U64(7)).astype(np.uint8)) & 1 == 1

        for table in _gathered(batches):
            phrases = _Phrases(table, words)
            word = passes(phrases.hashes(1))
            pair = passes(phrases.hashes(2)) if words > 1 else word
            only = word
            for k in range(1, words + 1):
                if k == 2:
                    only = pair & word
                    only[:-1] &= word[1:]
                if k > 2:
                    # both the phrase less its last word and its last pair pass
                    only = only.copy()
                    only[:-(k - 2)] &= pair[k - 2:]
                at, count = phrases.counted(k, only)
                for i in range(0, len(at), 50_000):
                    part = at[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(phrases.lang_names, dtype=object)[phrases.lang[part]], pa.string()),
                         phrases.text(part, k), pa.array(np.full(len(part), k, dtype=np.int32)),
                         pa.array(count[i:i + 50_000])], ["lang", "phrase", "k", "n"])
    return run


def frequent_bitmap(dictionary: DataFrame, words: int, min_count: int, bits: int = BITS) -> bytes:
    """Bits of the hashes of words and pairs that may reach the minimum count;
    ``bits`` / 8 bytes, gathered as at most ``bits`` / 32768 rows."""
    hashes = (dictionary.select("lang", "chunk", "last", "freq")
              .mapInArrow(_hash_counts(words), "hash long, n long")
              .groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    parts = (hashes.select(F.shiftright(slot, 15).alias("part"), (slot % 32768).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bitmap")))
    out = bytearray(bits // 8)
    for part, bitmap in parts.toLocalIterator():
        out[part * 4096:(part + 1) * 4096] = bitmap[:4096]
    return bytes(out[:bits // 8])


def phrase_counts(docs: DataFrame, words: int = WORDS, min_count: int = MIN_COUNT, bits: int = BITS,
                  text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``words`` words that occur ``min_count`` times or more
    (lang, phrase, k words, n times), and all words of each language (lang, n)."""
    spark = docs.sparkSession
    dictionary = stored_once(chunk_dictionary(docs, words, text, lang), "collocation-chunks")
    totals = dictionary.groupBy("lang").agg(F.sum("words").alias("n"))
    bitmap = spark.sparkContext.broadcast(frequent_bitmap(dictionary, words, min_count, bits))
    counts = (dictionary.select("lang", "chunk", "last", "freq")
              .mapInArrow(_spark_phrases(words, bitmap, bits), "lang string, phrase string, k int, n long")
              .groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    return stored_once(counts, "collocation-phrases"), totals


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    over = F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0])
    under = wide[1] * wide[2]
    return F.floor((over - over % under) / under).cast("long")


def mine_collocations(docs: DataFrame, words: int = WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                      share: int = 50, bits: int = BITS, text: str = "text", lang: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n,
    score). Candidates have 2 to ``words`` words and occur ``min_count`` times or
    more; one that lies inside a longer candidate with at least ``share`` per cent
    of its count is dropped. Of a candidate's cuts the one with the lowest score
    counts, the first on ties."""
    counts, totals = phrase_counts(docs, words, min_count, bits, text, lang)
    candidates = counts.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"),
                                              F.split("phrase", " ").alias("parts"))
    inner = (candidates.where("k > 2")
             .select("lang", "k", "a", "parts", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
             .select("lang", "a", "parts", "size", F.explode(F.expr("sequence(1, k - size + 1)")).alias("start"))
             .groupBy("lang", F.array_join(F.slice("parts", F.col("start"), F.col("size")), " ").alias("phrase"))
             .agg(F.max("a").alias("longer")))
    kept = (candidates.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))))
    cuts = (kept.select("lang", "phrase", "k", "a", "parts", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
            .select("lang", "phrase", "a", "cut",
                    F.array_join(F.slice("parts", F.lit(1), F.col("cut")), " ").alias("first"),
                    F.array_join(F.expr("slice(parts, cut + 1, k - cut)"), " ").alias("rest")))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .withColumn("score", cut_score(F.col("a"), F.col("l"), F.col("r")))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("best"))
              .select("lang", "phrase", "best.a", "best.l", "best.r", "best.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
             .where(F.col("rank") <= top).drop("rank", "salt"))
    ranked = (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    return (ranked.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def oracle_sql(min_count: int = MIN_COUNT, top: int = TOP, share: int = 50) -> str:
    """DuckDB SQL of ``mine_collocations`` for phrases of up to three words."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM listed, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND n >= {min_count}),
inner_pairs AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN inner_pairs i ON c.k = 2 AND c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < {share} * c.a),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS p, array_to_string(w[cut + 1:k], ' ') AS q
  FROM kept, (SELECT unnest([1, 2]) AS cut) WHERE cut < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.n AS l, r.n AS r,
    (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.n AS HUGEINT) * r.n) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.p AND l.k = c.cut
    JOIN counts r ON r.lang = c.lang AND r.phrase = c.q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, rank, phrase, a, l, r, totals.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""
