"""Substring dedup: remove every word that lies in a repeated passage.

A *window* is ``width`` consecutive words of one text. A window is repeated if
its word sequence also starts anywhere else in the corpus, in the same text
included. Removed are all words of repeated windows, judged on the input.

Method: suffix automata of reference shards. Sending the automaton of every
shard to every task would broadcast the corpus, so the shards are cut such
that a text needs few of them, and both meet in a shuffle:

1. Each window has an anchor: the smallest hash of its ``anchor``-word runs.
   Equal windows have equal anchors, and neighbouring windows mostly share
   one, so a text is a short list of *runs* of windows with one anchor.
2. Anchors are counted over the corpus (folded per task first). A run whose
   anchor occurs once holds no repeated window. If all runs of an anchor hold
   the same words, all their windows are repeated.
3. The others are the reference: the runs of one anchor form a shard of at
   most ``hot`` runs. Its suffix automaton, with occurrence counts, is built in
   one task and the same runs are streamed through it; a matching statistic of
   ``width`` words or more in a state with two or more occurrences is a
   repeated window.
4. An anchor with more than ``hot`` runs (a passage in a third of all texts,
   say) is never gathered: its windows are counted one by one under a 128-bit
   hash, folded per task, and Spark splits the join back if it is skewed.
5. Windows found are joined back per text, and cut out as maximal spans.

Results: one row per input row, all its columns kept, with ``n_words``,
``n_removed`` and ``kept_text`` (kept words joined by one space) appended; names
that clash with input columns are replaced by the new ones. Null or empty text:
0 words, 0 removed, empty ``kept_text``. Texts shorter than ``width`` words are
never cut. Repeated rows (same text twice) are two texts: both are cut. An
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm import textops as tx
from paymart.llm.suffix_automaton import SuffixAutomaton
from paymart.session import stored_once

WIDTH = 35
ANCHOR = 12
HOT = 1000
_K, _N, _T = "__sub_key", "__sub_bytes", "__sub_text"
_KEY = [_K, _N]
ALL, SHARD, SINGLE = 0, 1, 2

_RUNS = f"m long, {_K} long, {_N} int, s int, w int, h long, twice boolean"
_SEGMENTS = f"m long, {_K} long, {_N} int, s int, words binary"
_WINDOWS = f"h1 long, h2 long, {_K} long, {_N} int, starts array<int>"
_FOUND = f"{_K} long, {_N} int, a int, b int"


def _batch(schema: dict[str, tuple[np.ndarray | list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in schema.values()], names=list(schema))


def _runs(width: int, anchor: int):
    """Map texts to their runs of windows with one anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(_K).to_numpy(zero_copy_only=False)
            sizes = batch.column(_N).to_numpy(zero_copy_only=False)
            for row, _, data, offsets in tx.text_slices(batch.column(_T)):
                words = tx.words_of(data, offsets)
                at = np.flatnonzero(tx.inside(words, width))
                if not len(at):
                    continue
                low = tx.sliding_min(tx.window_hashes(words.hashes, anchor), width - anchor + 1)[at]
                text = words.text[at]
                begin = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (text[1:] != text[:-1])]))
                size = np.diff(np.append(begin, len(at)))
                # windows that the text itself repeats
                own = tx.window_hashes(words.hashes, width)[at] ^ tx.mix(text.astype(tx.U64), 5)
                order = np.sort(own)
                again = order[1:][order[1:] == order[:-1]]
                twice = np.isin(own, again) if len(again) else np.zeros(len(own), dtype=bool)
                first, of = at[begin], text[begin]
                yield _batch({
                    "m": (tx.as_signed(low[begin]), pa.int64()),
                    _K: (keys[row + of], pa.int64()),
                    _N: (sizes[row + of], pa.int32()),
                    "s": (first - words.first[of], pa.int32()),
                    "w": (size, pa.int32()),
                    "h": (tx.as_signed(tx.range_hashes(words.hashes, first, first + size + width - 1)), pa.int64()),
                    "twice": (np.logical_or.reduceat(twice, begin), pa.bool_()),
                })
    return run


def _marked(batches: Iterator[pa.RecordBatch], mode: int) -> Iterator[tuple[int, int, str, list]]:
    """(key, bytes, text, its runs of one mode) of joined rows."""
    for batch in batches:
        columns = [batch.column(c) for c in (_K, _N, _T, "marks")]
        for k, n, text, marks in zip(*columns):
            runs = [x for x in marks.as_py() if x["mode"] == mode]
            if runs:
                yield k.as_py(), n.as_py(), text.as_py(), runs


def _segments(width: int):
    """The words of each run that goes to a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for k, n, text, runs in _marked(batches, SHARD):
            words = text.encode().split()
            rows += [(x["m"], k, n, x["s"], b" ".join(words[x["s"]:x["s"] + x["w"] + width - 1])) for x in runs]
            if len(rows) >= 5000:
                yield _rows(rows, _SEGMENT_TYPES)
                rows = []
        if rows:
            yield _rows(rows, _SEGMENT_TYPES)
    return run


_SEGMENT_TYPES = {"m": pa.int64(), _K: pa.int64(), _N: pa.int32(), "s": pa.int32(), "words": pa.binary()}
_FOUND_TYPES = {_K: pa.int64(), _N: pa.int32(), "a": pa.int32(), "b": pa.int32()}


def _rows(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types.values())],
                                      names=list(types))


def _shard(segments: list[tuple], width: int) -> Iterator[tuple]:
    """Repeated windows of one shard, as ranges (key, bytes, from, to) of starts."""
    times: dict[bytes, int] = {}
    for *_, words in segments:
        times[words] = times.get(words, 0) + 1
    split = {words: words.split(b" ") for words in times}
    automaton = SuffixAutomaton((split[words], n) for words, n in times.items())
    ranges = {}
    for words, seq in split.items():
        starts = automaton.repeated(seq, width)
        spans: list[list[int]] = []
        for s in starts:
            if spans and spans[-1][1] == s:
                spans[-1][1] = s + 1
            else:
                spans.append([s, s + 1])
        ranges[words] = spans
    for _, k, n, s, words in segments:
        for a, b in ranges[words]:
            yield k, n, s + a, s + b


def _match(width: int):
    """Rows sorted by anchor: one automaton per anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    out += _shard(group, width)
                    group = []
                group.append(row)
            if len(out) >= 5000:
                yield _rows(out, _FOUND_TYPES)
                out = []
        if group:
            out += _shard(group, width)
        if out:
            yield _rows(out, _FOUND_TYPES)
    return run


def _windows(width: int):
    """A 128-bit hash for each window of the runs with a hot anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, n, text, runs in _marked(batches, SINGLE):
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            words = tx.words_of(data, np.array([0, len(data)]))
            at = np.concatenate([np.arange(x["s"], x["s"] + x["w"]) for x in runs])
            h1, h2 = (tx.as_signed(tx.range_hashes(words.hashes, at, at + width, seed)) for seed in (11, 13))
            # one row per distinct window of the text, with its places
            order = np.lexsort((at, h2, h1))
            h1, h2, at = h1[order], h2[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), type=pa.int32()),
                                              pa.array(at, type=pa.int32()))
            m = len(first)
            yield _batch({"h1": (h1[first], pa.int64()), "h2": (h2[first], pa.int64()), _K: (np.full(m, k), pa.int64()),
                          _N: (np.full(m, n), pa.int32()), "starts": (starts, pa.list_(pa.int32()))})
    return run


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the key of each text: its 64-bit hash and length in bytes."""
    return docs.withColumns({_K: F.xxhash64(F.col(text)), _N: F.coalesce(F.octet_length(F.col(text)), F.lit(0)),
                             _T: F.coalesce(F.col(text), F.lit(""))})


def run_marks(base: DataFrame, width: int, anchor: int, hot: int) -> DataFrame:
    """Per text key, its runs whose anchor is not alone: (s, w, mode, m)."""
    runs = stored_once(base.select(_K, _N, _T).mapInArrow(_runs(width, anchor), _RUNS), "substring-runs")
    anchors = (runs.groupBy("m")
               .agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice"),
                    F.min("h").alias("lo"), F.max("h").alias("hi"))
               .where((F.col("n") > 1) | F.col("twice"))
               .select("m", F.when((F.col("n") > 1) & (F.col("lo") == F.col("hi")), F.lit(ALL))
                       .when(F.col("n") > hot, F.lit(SINGLE)).otherwise(F.lit(SHARD)).alias("mode")))
    anchors = stored_once(anchors, "substring-anchors")
    marks = (runs.join(anchors, "m").groupBy(*_KEY)
             .agg(F.collect_set(F.struct("s", "w", "mode", "m")).alias("marks")))
    return stored_once(marks, "substring-marks")


def repeated_windows(base: DataFrame, marks: DataFrame, width: int) -> DataFrame:
    """Per text key, the ranges of starts of its repeated windows that the
    marks leave open: by the shards' automata, or by 128-bit hashes."""
    def of(mode: int) -> DataFrame:
        return marks.select(*_KEY, F.filter("marks", lambda x: x["mode"] == mode).alias("marks")).where("size(marks) > 0")

    by_shard = (base.join(of(SHARD), _KEY).mapInArrow(_segments(width), _SEGMENTS)
                .repartition("m").sortWithinPartitions("m").mapInArrow(_match(width), _FOUND))
    # both sides of the join are stored, so each has a shuffle of its own that
    # Spark can split where a window is in very many texts
    single = stored_once(of(SINGLE), "substring-single")  # small as a rule: Spark may broadcast it
    windows = stored_once(base.join(single, _KEY).mapInArrow(_windows(width), _WINDOWS), "substring-windows")
    often = stored_once(windows.groupBy("h1", "h2").agg(F.sum(F.size("starts")).alias("n")).where("n > 1").drop("n"),
                        "substring-often")
    by_window = (windows.join(often, ["h1", "h2"]).select(*_KEY, F.explode("starts").alias("a"))
                 .withColumn("b", F.col("a") + 1))
    return by_shard.unionByName(by_window).groupBy(*_KEY).agg(F.collect_set(F.struct("a", "b")).alias("found"))


def _cut(width: int):
    """(text, ranges of repeated windows) -> words, removed words, kept text."""
    @F.arrow_udf("struct<n_words:long,n_removed:long,kept_text:string>")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts, ranges):
            words = text.as_py().encode().split()
            gone = np.zeros(len(words), dtype=bool)
            for span in spans.as_py() or ():
                gone[span["a"]:span["b"] + width - 1] = True
            kept = words if not gone.any() else [words[i] for i in np.flatnonzero(~gone)]
            out.append({"n_words": len(words), "n_removed": len(words) - len(kept), "kept_text": b" ".join(kept).decode()})
        return pa.array(out, type=pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()),
                                             ("kept_text", pa.string())]))
    return cut


def dedup_substrings(docs: DataFrame, text: str = "text", width: int = WIDTH, anchor: int = ANCHOR,
                     hot: int = HOT) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (see above)."""
    base = keyed(docs, text)
    marks = run_marks(base, width, anchor, hot)
    found = repeated_windows(base, marks, width)
    marks, found = (x.withColumnsRenamed({"marks": "__sub_marks", "found": "__sub_found"}) for x in (marks, found))
    whole = F.transform(F.filter(F.col("__sub_marks"), lambda x: x["mode"] == ALL),
                        lambda x: F.struct(x["s"].alias("a"), (x["s"] + x["w"]).alias("b")))
    none = F.array().cast("array<struct<a:int,b:int>>")
    cut = _cut(width)(F.col(_T), F.concat(F.coalesce(whole, none), F.coalesce(F.col("__sub_found"), none)))
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    return (base.join(marks, _KEY, "left").join(found, _KEY, "left").withColumn("__sub_cut", cut)
            .select(*kept, "__sub_cut.n_words", "__sub_cut.n_removed", "__sub_cut.kept_text"))
