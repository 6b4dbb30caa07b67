"""Benchmark decontamination by template canonicalisation.

Words are reduced to letters and digits in lower case. Words with a digit become
``<num>``, words that begin with a capital ``<name>``, units ``<unit>``: a
benchmark item becomes a template, and the same question with other numbers,
names or units has the same one. What the placeholders stand for is kept as the
window's slot values.

1. Every window of ``WIDTH`` words of every item (an item with fewer: one window of
   all its words) is hashed in two forms: its canonical words, if at least
   ``min(LITERALS, its words)`` of them are plain, and the words as they are in any
   case, so a copy in capitals or small letters is found too. The distinct hashes are few against the corpus, but nothing
   bounds a benchmark: they are taken in blocks of at most ``BLOCK`` hashes, and
   each block is broadcast (8 MB) to a pass over the texts that keeps the
   windows whose hash is in it.
2. The kept windows are joined with the items' by hash, and matches are grouped
   by (text, item). Spark folds per task before the shuffle, so a passage that a
   third of all texts hold is no load.
3. Slot consistency: a slot value of the item stands for one value in the text
   wherever it occurs in the matched windows of one diagonal, else it clashes. An
   item may repeat a value by chance, so one clashing value, or ``SLACK`` of the
   values, is no matter; with more, the windows that hold one are dropped and
   ``COVER`` decides on the rest.
4. A window is hit if its case-blind form matches or its template does and is
   consistent. A text is contaminated by an item if the hit windows are at least
   ``COVER`` of the item's windows, or of those that have a template, or if
   consecutive hit windows on one diagonal hold ``PASSAGE`` words, however long the
   item is.

Results: ``find_contamination`` gives one row per (id, item_id) with ``cover``;
``judge_documents`` one row per input row, all its columns (clashing names
replaced), with ``contaminated`` and ``items`` (sorted item ids). Null or empty
texts and items match nothing. Repeated rows are judged each, alike (windows are
joined back by the text's hash, so a null id is no matter). Empty tables give no
contamination.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm import textops as tx
from paymart.session import work_dir

WIDTH = 8
LITERALS = 4
COVER = 0.5
SLACK = 0.5
PASSAGE = 20
BLOCK = 1_000_000
_KEY, _T = "__bench_key", "__bench_text"

# Units that become a placeholder.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l gal ms s sec min h hr hours minutes seconds days weeks "
         "months years metres meters kilometres kilometers miles feet inches grams kilograms pounds ounces "
         "litres liters gallons percent degrees dollars euros cents usd eur").split()

_DROP = np.zeros(256, dtype=bool)
_DROP[list(range(0x21, 0x30)) + list(range(0x3A, 0x41)) + list(range(0x5B, 0x61)) + list(range(0x7B, 0x7F))] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_NUM, _NAME, _UNIT = (tx.U64(x) for x in (0x6E756D, 0x6E616D65, 0x756E6974))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), dtype=np.uint8)
    return np.unique(tx.words_of(data, np.array([0, len(data)])).hashes)


_UNIT_HASHES = _unit_hashes()


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[tx.Words, np.ndarray, np.ndarray]:
    """(words without punctuation in lower case, hash of each word's canonical
    form, whether it is a slot)."""
    solid = ~_DROP[data]
    sums = np.concatenate([[0], np.cumsum(solid)])
    data, offsets = data[solid], sums[offsets]
    upper = (data >= 0x41) & (data <= 0x5A)
    low = np.where(upper, data + 0x20, data).astype(np.uint8)
    if len(data) > 1:
        accent = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][accent] += 0x20
        upper[:-1] |= accent
    words = tx.words_of(low, offsets)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[low])])
    number = digits[words.ends] > digits[words.starts]
    name = upper[words.starts] if len(words.starts) else number
    unit = np.isin(words.hashes, _UNIT_HASHES)
    form = np.where(number, _NUM, np.where(name, _NAME, np.where(unit, _UNIT, words.hashes)))
    return words, form, number | name | unit


def case_blind(texts: pa.Array, words: tx.Words) -> np.ndarray:
    """Hash of each word in any case: full Unicode folding, no placeholders.
    ``texts``: the rows that ``words`` are of."""
    if not (words.data >= 0x80).any():
        return words.hashes
    folded = pa.array([(t or "").casefold() for t in texts.to_pylist()], type=pa.large_string())
    (_, _, data, offsets), = tx.text_slices(folded, limit=1 << 62)
    solid = ~_DROP[data]
    sums = np.concatenate([[0], np.cumsum(solid)])
    return tx.words_of(data[solid], sums[offsets]).hashes


def _hashes(forms: np.ndarray, size: int, at: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the ``size`` words from each ``at`` on."""
    return tx.mix(tx.window_hashes(forms, size)[at], seed)


def windows_of(texts: pa.Array, data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...],
               short: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
    """(words, first word of each window, its size, hashes, which have enough plain
    words, which words are slots) for each size and form: the template form of the
    windows with enough plain words, then the case-blind form of all, which has no
    slots (None). ``short``: also one window for each text of fewer words."""
    words, form, slot = canonical(data, offsets)
    folded = case_blind(texts, words)
    plain = np.concatenate([[0], np.cumsum(~slot)])
    spans = [(n, np.flatnonzero(tx.inside(words, n))) for n in sizes]
    if short:
        count = np.diff(words.first)
        spans += [(int(n), words.first[:-1][count == n]) for n in np.unique(count) if 0 < n < short]
    for n, at in spans:
        enough = plain[at + n] - plain[at] >= min(LITERALS, n)
        lit = at[enough]
        yield words, lit, n, _hashes(form, n, lit, n), np.ones(len(lit), dtype=bool), slot
        yield words, at, n, _hashes(folded, n, at, -n), enough, None


def _slots(words: tx.Words, slot: np.ndarray | None, at: int, size: int) -> list[int] | None:
    """The slot values of a window, in order; plain words are no part."""
    if slot is None:
        return None
    inside = slice(at, at + size)
    return tx.as_signed(words.hashes[inside][slot[inside]]).tolist()


_WINDOW = "h long, {key} long, at int, size int, lit boolean, slots array<long>"
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64())]


def _emit(key: str, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), _TYPES)],
                                      names=["h", key, "at", "size", "lit", "slots"])


def _scan(key: str, width: int, wanted=None, sizes: tuple[int, ...] = ()):
    """Map (key, text) to windows; ``wanted``: broadcast of the sorted hashes to
    keep, by default all; ``sizes``: shorter window sizes to look for too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for begin, end, data, offsets in tx.text_slices(batch.column(1)):
                rows: list[tuple] = []
                texts = batch.column(1).slice(begin, end - begin)
                for words, at, size, hashes, lit, slot in windows_of(texts, data, offsets, (width, *sizes),
                                                                     width if wanted is None else 0):
                    if wanted is not None:
                        known = wanted.value
                        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                        keep = np.flatnonzero(known[place] == hashes)
                        at, hashes, lit = at[keep], hashes[keep], lit[keep]
                    rows += [(int(h), keys[begin + int(t)].as_py(), int(a - words.first[t]), size, bool(x),
                              _slots(words, slot, int(a), size))
                             for h, t, a, x in zip(tx.as_signed(hashes), words.text[at], at, lit)]
                if rows:
                    yield _emit(key, rows)
    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matches(texts: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Windows of texts that have the template of an item's window."""
    spark = texts.sparkSession
    hashes = items.select("h", "size").distinct()
    n = hashes.count()
    if not n:
        return spark.createDataFrame([], _WINDOW.format(key=_KEY))
    blocks = -(-n // BLOCK)
    part = F.pmod(F.xxhash64("h"), F.lit(2 * blocks if blocks > 1 else 1))
    hashes = _stored(hashes.withColumn("part", part), "bench-hashes")
    out = None
    for block in range(2 * blocks if blocks > 1 else 1):
        # about BLOCK / 2 hashes, 8 bytes each
        rows = hashes.where(F.col("part") == block).select("h", "size").toArrow()
        known = np.unique(rows.column("h").to_numpy().view(tx.U64))
        if not len(known):
            continue
        sizes = tuple(sorted({int(s) for s in np.unique(rows.column("size").to_numpy())} - {width}))
        wanted = spark.sparkContext.broadcast(known)
        found = texts.mapInArrow(_scan(_KEY, width, wanted, sizes), _WINDOW.format(key=_KEY))
        out = found if out is None else out.unionByName(found)
    return _stored(out, "bench-windows")


def _lit_windows(name: str) -> Column:
    """How many windows have enough plain words for a template."""
    return F.countDistinct(F.when(F.col("lit"), F.struct("at", "size"))).alias(name)


def find_contamination(texts: DataFrame, benchmark: DataFrame, width: int = WIDTH, cover: float = COVER,
                       slack: float = SLACK, text: str = "text", item_id: str = "item_id",
                       passage: int = PASSAGE) -> DataFrame:
    """(key, item_id, cover) of contaminated texts; ``texts`` has (key, text)."""
    items = _stored(benchmark.where(F.col(text).isNotNull() & F.col(item_id).isNotNull())
                    .select(F.col(item_id).cast("long").alias("item_id"), text)
                    .mapInArrow(_scan("item_id", width), _WINDOW.format(key="item_id")), "bench-items")
    total = items.groupBy("item_id").agg(F.countDistinct("at", "size").alias("windows"), _lit_windows("lit_windows"))
    ours = _matches(texts, items, width).drop("lit").withColumnsRenamed({"at": "t_at", "slots": "t_slots"})
    pairs = (ours.join(items, ["h", "size"]).withColumn("diagonal", F.col("t_at") - F.col("at"))
             .where(F.col("slots").isNull() | (F.size("slots") == F.size("t_slots"))))
    # one value in the text for each slot value of the item, per diagonal
    on = [_KEY, "item_id", "diagonal"]
    slots = (pairs.select(*on, F.explode(F.arrays_zip("slots", "t_slots")).alias("s"))
             .groupBy(*on, F.col("s.slots").alias("slot"))
             .agg((F.min("s.t_slots") != F.max("s.t_slots")).alias("clash"))
             .groupBy(*on).agg(F.collect_list(F.when(F.col("clash"), F.col("slot"))).alias("clashing"),
                               F.count("*").alias("values")))
    allowed = F.greatest(F.lit(1), F.floor(F.col("values") * F.lit(slack)))
    good = (pairs.join(slots, on, "left")
            .where(F.col("slots").isNull() | F.col("clashing").isNull() | (F.size("clashing") <= allowed)
                   | ~F.arrays_overlap("slots", "clashing")))
    # consecutive windows have one difference between place and rank
    rank = F.row_number().over(Window.partitionBy(*on).orderBy("at"))
    runs = (good.where(F.col("size") == width).select(*on, "at").distinct().withColumn("run", F.col("at") - rank)
            .groupBy(*on, "run").agg(F.count("*").alias("n")).where(F.col("n") >= max(1, passage - width + 1))
            .select(_KEY, "item_id").distinct().withColumn("passage", F.lit(True)))
    # of all windows or of those with a template (a text in the item's own case
    # matches both, one with other values the latter only); null without any
    shares = [F.col("hit") / F.col("windows"), F.try_divide("lit_hit", "lit_windows")]
    return (good.groupBy(_KEY, "item_id").agg(F.countDistinct("at", "size").alias("hit"), _lit_windows("lit_hit"))
            .join(total, "item_id").withColumn("cover", F.greatest(*shares))
            .join(runs, [_KEY, "item_id"], "left")
            .where((F.col("cover") >= cover) | F.col("passage")).select(_KEY, "item_id", "cover"))


def judge_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with ``contaminated`` and ``items``."""
    kept = [c for c in docs.columns if c not in ("contaminated", "items")]
    keyed = docs.select(*kept, F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(_KEY))
    texts = docs.select(F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(_KEY), F.col(text).alias(_T))
    found = (find_contamination(texts, benchmark, text="text", **how)
             .groupBy(_KEY).agg(F.sort_array(F.collect_set("item_id")).alias("__bench_items")))
    return (keyed.join(found, _KEY, "left")
            .select(*kept, F.col("__bench_items").isNotNull().alias("contaminated"),
                    F.coalesce("__bench_items", F.array().cast("array<long>")).alias("items")))
