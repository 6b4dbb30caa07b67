"""MinHash near-dedup: BagMinHash signatures, bands, exact verification.

Two texts are near copies if the weighted Jaccard similarity of their multisets
of ``WIDTH``-word runs (a shorter text has one run, all its words) is at least
``THRESHOLD``. Groups are the connected components of these links.

1. Signature. Each run of a text is a Poisson process over time and weight
   (0, w], w its number of occurrences, and each of ``SIZE`` components keeps the
   first point that falls to it. The weight axis is cut into (0, 1], (1, 2],
   (2, 4], ...: each piece is a process of its own with the rate of its length,
   so a weight w takes log(w) processes; in the last piece, points above w are
   passed over. Points come from hashes, in order of time, until they are later
   than all components' first points. Equal components then have the
   probability of the weighted Jaccard similarity, without bias.
2. Bands of ``ROWS`` components are hashed; texts that share a band are
   candidates. A pair at the threshold shares none of the ``SIZE / ROWS`` bands
   with probability (1 - 0.8**7)**48, about 1e-5; texts that merely share a
   passage rarely meet (similarity 0.3: 1 %).
3. Identical texts are one node. In each band bucket, the nodes are verified
   (two texts side by side, exact multiset overlap) against one leader, not
   against each other: the node that meets most others in its buckets, which in
   a family of copies is the text they were made from. Components are formed.
4. Buckets that still hold several components are finished without comparing
   all their nodes. What two nodes share is shared with their leader L or not. If
   nothing beyond L is shared, the overlaps with L bound their similarity, and
   only pairs whose bound reaches the threshold are candidates. Else they share a
   run beyond L, and then (prefix filter) one among the smallest hashes of what
   each has beyond L, about a fifth of a text: an equi-join on those gives the
   candidates. Parity sketches of ``SKETCH`` bits, which never differ in more bits
   than the multisets do in elements, pass over pairs that are too far apart
   (texts that merely share two common passages). The rest is verified, and the
   components formed anew. So a group of
   very many copies does not make all its pairs, and no link between texts that
   share a band is lost.

Results: one row per input row: the id and ``group_id``, the smallest id of its
group (null only if all ids of the group are null). A text without words (null,
empty, white space) is never a copy: its group is its own id. Repeated rows are
in one group. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm import textops as tx
from paymart.llm.components import connected_components, joined_components
from paymart.session import stored_once

WIDTH = 5
THRESHOLD = 0.8
SIZE = 336
ROWS = 7
SKETCH = 1024
_NODE, _T = "__near_node", "__near_text"
_SIGNATURES = f"{_NODE} binary, bands array<long>"


def text_node(text: Column) -> Column:
    """Identity of a text: 128 bits of its digest."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


# ------------------------------------------------------------- signatures

def bag(words: tx.Words, n_texts: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets of word runs: (text, run's hash, weight) per distinct run."""
    at = np.flatnonzero(tx.inside(words, width))
    runs, text = tx.window_hashes(words.hashes, width)[at], words.text[at]
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < width))
    if len(short):
        runs = np.concatenate([runs, tx.range_hashes(words.hashes, words.first[short], words.first[short + 1])])
        text = np.concatenate([text, short])
    _, index, weight = np.unique(runs ^ tx.mix(text.astype(tx.U64), 17), return_index=True, return_counts=True)
    return text[index], runs[index], weight


def bag_minhash(text: np.ndarray, runs: np.ndarray, weight: np.ndarray, n_texts: int,
                size: int = SIZE) -> np.ndarray:
    """Signatures: ``n_texts`` x ``size`` hashes of the components' first points
    (0 for a text without runs)."""
    # one process per run and piece of the weight axis it reaches
    pieces = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    of = np.repeat(np.arange(len(runs)), pieces)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.where(piece > 0, 2.0 ** (piece - 1), 0.0)
    length = np.where(piece > 0, low, 1.0)
    seed = tx.mix(runs[of] + piece.astype(tx.U64) * tx.U64(0x9E3779B97F4A7C15), 19)
    text, most = text[of], weight[of].astype(np.float64)
    clock = np.zeros(len(of))
    first = np.full(n_texts * size, np.inf)
    point_of = np.zeros(n_texts * size, dtype=tx.U64)
    turn = 0
    while len(seed):
        turn += 1
        point = tx.mix(seed + tx.U64(turn), 23)
        draw = ((point >> tx.U64(11)).astype(np.float64) + 0.5) / 2.0**53
        clock = clock - np.log(draw) / length
        other = tx.mix(point, 29)
        slot = text * size + (other % tx.U64(size)).astype(np.int64)
        level = low + length * ((other >> tx.U64(11)).astype(np.float64) + 0.5) / 2.0**53
        counts = np.flatnonzero((level <= most) & (clock < first[slot]))
        np.minimum.at(first, slot[counts], clock[counts])
        won = counts[first[slot[counts]] == clock[counts]]
        point_of[slot[won]] = point[won]
        latest = first.reshape(n_texts, size).max(axis=1)
        going = np.flatnonzero(clock < latest[text])
        seed, text, most, low, length, clock = (x[going] for x in (seed, text, most, low, length, clock))
    return point_of.reshape(n_texts, size)


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` components; bands of different place differ."""
    n, size = signatures.shape
    parts = signatures.reshape(n, size // rows, rows)
    out = np.broadcast_to(np.arange(size // rows, dtype=tx.U64), parts.shape[:2])
    for i in range(rows):
        out = tx.mix(out ^ parts[:, :, i], 31 + i)
    return out


def _signatures(width: int, size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0)
            for begin, end, data, offsets in tx.text_slices(batch.column(1)):
                words = tx.words_of(data, offsets)
                have = np.flatnonzero(np.diff(words.first) > 0)
                if not len(have):
                    continue
                bands = band_hashes(bag_minhash(*bag(words, end - begin, width), end - begin, size), rows)[have]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, bands.size + 1, bands.shape[1]), type=pa.int32()),
                    pa.array(tx.as_signed(np.ascontiguousarray(bands).reshape(-1)), type=pa.int64()))
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(have + begin)), lists], names=[_NODE, "bands"])
    return run


# ----------------------------------------------------------- verification

def _runs_of(text: str, width: int) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    words = tx.words_of(data, np.array([0, len(data)]))
    if len(words.hashes) >= width:
        return tx.window_hashes(words.hashes, width)
    n = np.array([len(words.hashes)])
    return tx.range_hashes(words.hashes, n * 0, n) if n[0] else words.hashes


def numbered(runs: np.ndarray) -> np.ndarray:
    """The multiset as a sorted set: the k-th copy of a run is an element of its
    own, so multiset overlap is set overlap."""
    runs = np.sort(runs)
    first = np.concatenate([[True], runs[1:] != runs[:-1]])[:len(runs)]
    at = np.arange(len(runs))
    copy = at - np.maximum.accumulate(np.where(first, at, 0)) if len(runs) else at
    return np.sort(tx.mix(runs + copy.astype(tx.U64) * tx.U64(0xD6E8FEB86659FD93), 47))


def parity_sketch(elements: np.ndarray) -> np.ndarray:
    """``SKETCH`` bits; each element flips one. The bits in which two sketches
    differ are never more than the elements in only one of the sets."""
    flips = np.bincount((elements >> tx.U64(17)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def compare(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[int, np.ndarray]:
    """(overlap, prefix) of two numbered multisets. The prefix is the smallest
    elements of ``a`` beyond ``b``: any text whose similarity to ``a`` reaches the
    threshold and that shares anything with ``a`` beyond ``b`` has one of them
    in its own prefix."""
    shared = np.isin(a, b, assume_unique=True)
    overlap = int(shared.sum())
    beyond = a[~shared]
    least = max(1, int(np.ceil(threshold * len(a) - 1e-9)) - overlap)
    return overlap, beyond[:max(0, len(beyond) - least + 1)]


_COMPARED = pa.struct([("overlap", pa.int32()), ("a_size", pa.int32()), ("b_size", pa.int32()),
                       ("prefix", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])


def _compared(width: int, threshold: float):
    @F.arrow_udf("struct<overlap:int,a_size:int,b_size:int,prefix:array<long>,sketch:array<long>>")
    def compared(left: pa.Array, right: pa.Array) -> pa.Array:
        out, known, text = [], None, None
        for a, b in zip(left, right):
            a, b = numbered(_runs_of(a.as_py(), width)), b.as_py()
            if b != text:
                text, known = b, numbered(_runs_of(b, width))
            overlap, prefix = compare(a, known, threshold)
            out.append({"overlap": overlap, "a_size": len(a), "b_size": len(known), "prefix": tx.as_signed(prefix),
                        "sketch": parity_sketch(a)})
        return pa.array(out, type=_COMPARED)
    return compared


def verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes with ``overlap``, ``a_size``, ``b_size``, ``prefix``
    (of a beyond b), ``sketch`` (of a) and ``linked``: whether they are near copies. Spark
    splits the join if one node has very many partners."""
    left, right = (texts.select(F.col(_NODE).alias(x), F.col(_T).alias(f"{x}_text")) for x in "ab")
    found = (pairs.join(left, "a").join(right, "b")
             .select("a", "b", _compared(width, threshold)("a_text", "b_text").alias("c")).select("a", "b", "c.*"))
    union = F.col("a_size") + F.col("b_size") - F.col("overlap")
    return found.withColumn("linked", F.col("overlap") >= F.lit(threshold) * union)


# ------------------------------------------------------------------ groups

def _buckets(texts: DataFrame, width: int, size: int, rows: int) -> DataFrame:
    """(band, node, leader) of the nodes that share a band with others. The
    leader has the most nodes in all its buckets."""
    bands = texts.mapInArrow(_signatures(width, size, rows), _SIGNATURES)
    entries = (stored_once(bands.dropDuplicates([_NODE]), "near-bands")
               .select(F.explode("bands").alias("band"), _NODE))
    many = entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored_once(entries.join(many, "band"), "near-shared")
    degree = shared.groupBy(_NODE).agg(F.sum("n").alias("degree"))
    shared = stored_once(shared.drop("n").join(degree, _NODE), "near-degrees")
    leaders = (shared.groupBy("band").agg(F.max(F.struct("degree", _NODE)).alias("lead"))
               .select("band", F.col(f"lead.{_NODE}").alias("leader")))
    return stored_once(shared.join(leaders, "band").select("band", _NODE, "leader"), "near-buckets")


def _open_entries(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, other (the leader), label, is_rest) of the buckets with several
    components; ``is_rest``: outside a bucket's largest component."""
    member = (buckets.join(labels.withColumnRenamed("node", _NODE), _NODE, "left")
              .withColumn("label", F.coalesce("label", _NODE)))
    sizes = member.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = (sizes.groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1").select("band", F.col("top.label").alias("top")))
    return (member.join(largest, "band").where(F.col(_NODE) != F.col("leader"))
            .groupBy(F.col(_NODE).alias("a"), F.col("leader").alias("b"))
            .agg(F.first("label").alias("label"), F.max(F.col("label") != F.col("top")).alias("is_rest")))


def _candidates(entries: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may be linked, from
    entries (a, b (the leader), label, is_rest, overlap, a_size, prefix)."""
    x = entries.where("is_rest").select("b", F.col("a").alias("x"), F.col("label").alias("x_label"),
                                        F.col("overlap").alias("x_overlap"), F.col("a_size").alias("x_size"),
                                        F.col("prefix").alias("x_prefix"), F.col("sketch").alias("x_sketch"))
    y = entries.select("b", F.col("a").alias("y"), F.col("label").alias("y_label"), F.col("is_rest").alias("y_rest"),
                       F.col("overlap").alias("y_overlap"), F.col("a_size").alias("y_size"), F.col("prefix").alias("y_prefix"),
                       F.col("sketch").alias("y_sketch"))
    both = F.col("x_size") + F.col("y_size")
    need = F.lit(threshold / (1 + threshold) - 1e-9)
    apart = ((F.col("x_label") != F.col("y_label")) & (~F.col("y_rest") | (F.col("x") < F.col("y")))
             & (F.least("x_size", "y_size") >= F.lit(threshold - 1e-9) * F.greatest("x_size", "y_size")))
    # elements in only one of them: at least the bits in which the sketches differ
    differ = sum(F.bit_count(F.col("x_sketch")[i].bitwiseXOR(F.col("y_sketch")[i])) for i in range(SKETCH // 64))
    apart &= differ <= both * F.lit((1 - threshold) / (1 + threshold) + 1e-9)
    # nothing shared beyond the leader: the overlaps with it bound the similarity.
    # A text this close to another is nearly inside the leader itself
    inner = lambda p: F.col(f"{p}_overlap") >= F.lit(threshold - 1e-9) * F.col(f"{p}_size")
    bound = (x.where(inner("x")).drop("x_prefix").join(y.where(inner("y")).drop("y_prefix"), "b")
             .where(apart & (F.least("x_overlap", "y_overlap") >= need * both)))
    # something shared beyond it
    shared = (x.withColumn("run", F.explode("x_prefix")).join(y.withColumn("run", F.explode("y_prefix")), ["b", "run"])
              .where(apart))
    pairs = bound.select("x", "y").unionByName(shared.select("x", "y"))
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def near_components(base: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, size: int = SIZE,
                    rows: int = ROWS) -> DataFrame:
    """(node, label) for every text with a near copy other than itself."""
    texts = base.select(_NODE, _T)
    buckets = _buckets(texts, width, size, rows)
    nodes = buckets.select(_NODE).distinct()
    wanted = stored_once(texts.join(nodes, _NODE, "left_semi").dropDuplicates([_NODE]), "near-texts")
    star = (buckets.where(F.col(_NODE) != F.col("leader"))
            .select(F.col(_NODE).alias("a"), F.col("leader").alias("b")).distinct())
    tried = stored_once(verified(star, wanted, width, threshold), "near-star")
    links = tried.where("linked").select("a", "b")
    labels = connected_components(links)
    entries = _open_entries(buckets, labels).join(tried, ["a", "b"])
    pairs = stored_once(_candidates(entries, threshold), "near-pairs")
    more = stored_once(verified(pairs, wanted, width, threshold).where("linked").select("a", "b"), "near-links")
    # the new links only join components: the nodes' own rounds are not run again
    if more.isEmpty():
        return labels
    return joined_components(labels, more)


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """(doc id, ``group_id``), one row per row of ``docs``."""
    base = docs.select(F.col(doc_id).alias("doc_id"), text_node(F.col(text)).alias(_NODE),
                       F.coalesce(F.col(text), F.lit("")).alias(_T),
                       F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("has_words"))
    labels = near_components(base, **how).withColumnRenamed("node", _NODE)
    known = (base.select("doc_id", _NODE, "has_words").join(labels, _NODE, "left")
             .withColumn("label", F.when(F.col("has_words"), F.coalesce("label", _NODE))))
    groups = (known.where("has_words").groupBy("label").agg(F.min("doc_id").alias("least")))
    return (known.join(groups, "label", "left")
            .select("doc_id", F.when(F.col("has_words"), F.col("least")).otherwise(F.col("doc_id")).alias("group_id")))


def keep_one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` without near copies: of each group, the row with the smallest id
    stays (of rows with equal id and text, one). Rows without words stay."""
    words = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.withColumns({_NODE: text_node(F.col(text)), "__near_words": words})
    base = keyed.select(_NODE, F.coalesce(F.col(text), F.lit("")).alias(_T))
    labels = near_components(base, **how).withColumnRenamed("node", _NODE)
    best = (keyed.where("__near_words").select(F.col(doc_id).alias("id"), _NODE).join(labels, _NODE, "left")
            .groupBy(F.coalesce("label", _NODE).alias("label"))
            .agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col(_NODE))).alias("best"))
            .select(F.col("best.id").alias("__near_id"), F.col(f"best.{_NODE}").alias(_NODE)))
    kept = (keyed.join(best, (keyed[_NODE] == best[_NODE]) & keyed[doc_id].eqNullSafe(best["__near_id"]), "left")
            .where(best[_NODE].isNotNull() | ~F.col("__near_words")))
    # repeated rows: one of each (id, text); rows without words are no copies
    plain, empty = (kept.where(c).select(docs.columns) for c in ("__near_words", "NOT __near_words"))
    return plain.dropDuplicates([doc_id, text]).unionByName(empty)
