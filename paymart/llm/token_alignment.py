"""Cross-tokenizer alignment with white-space token anchors.

Each text is tokenised whole by tokenizer A (a byte-level BPE, given a space and the
text) and by B (a sentencepiece model, given the text; it adds the space). Where a
token of A and a token of B end at the same byte and the next tokens of both begin
with a space is an anchor; the end of the text is one too. Anchors cut the text into
windows. What a window's tokens have to do with each other depends on their ids
alone, so the alignment of a window (its groups and links) is worked out once for a
pair of id tuples and remembered (about ``MEMO`` windows a process, then anew).

Whole texts are encoded part by part: a part ends at a blank between two visible
characters other than U+2581. That changes no token: A's pre-tokenisation begins a new
piece at such a blank, and no piece of B's vocabulary has a space after another
character (checked when it is loaded), so no merge of either goes across. So the
memory of a task does not depend on the length of a text, parts of up to ``LONG``
characters that come again are encoded once (about ``MEMO`` a process), and parts not
seen yet are encoded many at a time, put together with blanks. A text without such a
blank is one part. Where A's vocabulary is there as ranks too (checked entry by entry),
short parts of plain Latin characters are encoded by these; the ids are the same.

Counts of linked id pairs are corpus-wide and grow with the corpus, so they are
never broadcast. Texts are taken in batches of about ``BATCH_BYTES``. A batch has a
number, its distinct windows, its distinct pairs with their number of links, and per
text the windows it is made of; all this is stored once. Pair counts are summed by
pair, the best of each B id by B id; each batch is joined with the counts of its own
distinct pairs and then adds them up for its texts. So a common pair has one row per
batch, not per text or link, and no text is tokenised twice.

Results: see ``align_tokens``. A null or empty text, and one whose joined tokens of
A or B are not the bytes of the space and the text, has no tokens: zeros, and '' for
the groups. Repeated rows and ids are rows of their own and each count. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
import hashlib
from itertools import chain
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm import textops
from paymart.session import stored_once

TOKENIZER_A = "byte_bpe_50k.json"
#: A's vocabulary as ranks, if there is one: the same ids for plain text, in a third of the time.
RANKS_A = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}
TOKENIZER_B = "piece_bpe_32k.model"
LONG = 64
STEP = 2000
BATCH_BYTES = 3 << 19
MEMO = 200_000
#: Blanks at which a text may be encoded in parts, and parts that may stand between such.
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_INNER = re.compile(r"[!-~\w]|[!-~\w].*[!-~\w]", re.DOTALL)
#: Short parts of these characters, whose classes are the same in every version of
#: Unicode, may be encoded by ranks.
_PLAIN = re.compile(r"[\n -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*")
#: Beside a blank these leave no place to cut.
_UNSAFE = ("  ", " \n", "\n ")

_STORED = ("batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "windows array<int>, times array<int>, pairs array<long>, linked array<long>, "
           "firsts array<int>, links array<int>")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokenises and aligns texts; remembers windows."""

    def __init__(self, path_a: str, path_b: str, ranks_a: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        code = byte_characters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(code[c] for c in entry) if all(c in code for c in entry) else entry.encode()
        if self.a.normalizer is not None or len({x for x in self.bytes_a if len(x) == 1}) < 256:
            raise ValueError("A does not have every byte, or changes texts")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("B has pieces with a space inside")
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.space_a, self.space_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.text_a = _with_ends(len(self.bytes_a), ",", "|")
        self.text_b = _with_ends(len(self.bytes_b), ",", ";")
        self.by_rank = _by_rank(ranks_a, self.bytes_a) if ranks_a else None
        # numbers of parts; their ids by A and by B, where each part's begin, and
        # whether the tokens of a part do not give it back
        self.parts: dict[str, int] = {}
        self.ids = [np.zeros(0, dtype=np.int32)] * 2
        self.begins = [np.zeros(1, dtype=np.int64)] * 2
        self.odd = np.zeros(0, dtype=bool)
        self.forget()

    def forget(self) -> None:
        """Begin the memory of windows anew."""
        self.memo: dict[bytes, int] = {}
        self.groups: list[str] = []                      # of each window, as text
        self.n_groups = np.zeros(0, dtype=np.int64)
        self.firsts = np.zeros(1, dtype=np.int64)        # where the links of each window begin
        self.links = np.zeros(0, dtype=np.int64)

    # --------------------------------------------------------- tokenisation

    def learn(self, parts: set[str]) -> None:
        """Encode the parts that are not known."""
        new = parts.difference(self.parts)
        if len(self.parts) + len(new) > MEMO:
            kept = list(parts - new)
            numbers = np.array([self.parts[p] for p in kept], dtype=np.int64)
            found = [(kept, *(gather(self.ids[i], self.begins[i], numbers) for i in (0, 1)), self.odd[numbers])]
            self.parts, self.odd = {}, self.odd[:0]
            self.ids, self.begins = [x[:0] for x in self.ids], [x[:1] for x in self.begins]
            self._remember(found)
        inner = {p for p in new if _INNER.fullmatch(p)}
        plain = [p for p in inner if len(p) <= LONG and _PLAIN.fullmatch(p)] if self.by_rank else []
        other = sorted(inner.difference(plain), key=len)  # long ones last, see ``tokens``
        found = []
        for i in range(0, len(plain), STEP):
            self._encode(plain[i:i + STEP], found, self.by_rank)
        for part in sorted(new - inner, key=len):
            if len(part) <= LONG:
                self._encode([part], found)
        for i in range(0, len(other), STEP):
            self._encode(other[i:i + STEP], found)
        for part in new - inner:
            if len(part) > LONG:
                self._encode([part], found)
        self._remember(found)

    def _remember(self, found: list) -> None:
        """Put parts with their ids (flat, and how many each has) into the memory."""
        if not found:
            return
        names = [p for parts, *_ in found for p in parts]
        self.parts.update(zip(names, range(len(self.odd), len(self.odd) + len(names))))
        for i in (0, 1):
            self.begins[i] = np.concatenate([self.begins[i], len(self.ids[i]) + np.cumsum(np.concatenate([x[1 + i][1] for x in found]))])
            self.ids[i] = np.concatenate([self.ids[i], *(x[1 + i][0] for x in found)])
        self.odd = np.concatenate([self.odd, *(x[3] for x in found)])

    def _encode(self, parts: list[str], found: list, by_rank=None) -> None:
        """Encode parts as one text, a blank between each two, and take it apart."""
        joined = " ".join(parts)
        whole = b" " + joined.encode()
        a = np.array(by_rank(" " + joined) if by_rank else
                     self.a.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids, dtype=np.int32)
        b = np.array(self.b.encode(joined), dtype=np.int32)
        # A is lossless (see ``__init__``), so its tokens give the text back
        if b"".join(map(self.bytes_b.__getitem__, b.tolist())) != whole:
            if len(parts) == 1:
                none = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
                found.append((parts, none, none, np.ones(1, dtype=bool)))
            else:  # one of them is odd
                half = len(parts) // 2
                self._encode(parts[:half], found, by_rank)
                self._encode(parts[half:], found, by_rank)
            return
        until = np.cumsum([1 + len(p) for p in (parts if joined.isascii() else map(str.encode, parts))])
        cut = [(ids, np.diff(np.searchsorted(np.cumsum(size[ids]), until) + 1, prepend=0))
               for ids, size in ((a, self.size_a), (b, self.size_b))]
        found.append((parts, *cut, np.zeros(len(parts), dtype=bool)))

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """By A and by B: the ids of all texts, and how many each text has; none of a
        text that the joined tokens do not give back."""
        parts = [parts_of(text) for text in texts]
        self.learn(set().union(*parts))
        size = np.array([len(own) for own in parts], dtype=np.int64)
        numbers = np.fromiter(map(self.parts.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=int(size.sum()))
        text = np.repeat(np.arange(len(texts)), size)
        bad = np.zeros(len(texts), dtype=bool)
        bad[text[self.odd[numbers]]] = True
        if bad.any():
            numbers, text = numbers[~bad[text]], text[~bad[text]]
        out = []
        for i in (0, 1):
            ids, counts = gather(self.ids[i], self.begins[i], numbers)
            ends = np.concatenate([[0], np.cumsum(counts)])
            place = np.searchsorted(text, np.arange(len(texts) + 1))
            out.append((ids, ends[place[1:]] - ends[place[:-1]]))
        long = {p for own in parts for p in own if len(p) > LONG}
        if long:  # they are the last ones, and are not kept
            keep = min(self.parts[p] for p in long)
            for part in long:
                del self.parts[part]
            self.odd = self.odd[:keep]
            for i in (0, 1):
                self.ids[i] = self.ids[i][:self.begins[i][keep]].copy()
                self.begins[i] = self.begins[i][:keep + 1].copy()
        return out

    # -------------------------------------------------------------- windows

    def cut(self, a: np.ndarray, b: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends (as numbers of tokens of A, of B) of the windows of joined texts;
        ``text_ends``: at which tokens of A the texts end."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(ends_b, ends_a)
        shared = np.flatnonzero(ends_b[at] == ends_a)
        i, j = shared + 1, at[shared] + 1
        last = np.zeros(len(a) + 1, dtype=bool)
        last[text_ends] = True
        marked = np.zeros(len(i), dtype=bool)
        inner = (i < len(a)) & (j < len(b))
        marked[inner] = self.space_a[a[i[inner]]] & self.space_b[b[j[inner]]]
        anchor = last[i] | marked
        return i[anchor], j[anchor]

    def lookup(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
        """The remembered number of each window."""
        begin_a, begin_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
        n_a, n_b = ends_a - begin_a, ends_b - begin_b
        size = n_a + n_b + 1  # a window's key: how many ids of A, these, those of B
        begin = np.cumsum(size) - size
        keys = np.empty(int(size.sum()), dtype=np.int32)
        keys[begin] = n_a
        keys[np.arange(len(a)) + np.repeat(begin + 1 - begin_a, n_a)] = a
        keys[np.arange(len(b)) + np.repeat(begin + 1 + n_a - begin_b, n_b)] = b
        whole, edges = keys.tobytes(), (4 * np.append(begin, len(keys))).tolist()
        keys = [whole[x:y] for x, y in zip(edges, edges[1:])]
        memo = self.memo
        numbers = list(map(memo.get, keys))
        unknown = [i for i, number in enumerate(numbers) if number is None]
        if unknown:
            new = list(dict.fromkeys([keys[i] for i in unknown]))
            memo.update(zip(new, range(len(memo), len(memo) + len(new))))
            self.align(new)
            for i in unknown:
                numbers[i] = memo[keys[i]]
        return np.array(numbers, dtype=np.int64)

    def align(self, keys: list[bytes]) -> None:
        """Remember the groups and links of new windows."""
        ids = np.frombuffer(b"".join(keys), dtype=np.int32).astype(np.int64)
        size = np.array([len(k) // 4 for k in keys])
        begin = np.cumsum(size) - size
        n_a = ids[begin]
        n_b = size - 1 - n_a
        window = np.repeat(np.arange(len(keys)), size)
        place = np.arange(len(ids)) - begin[window]
        a, b = ids[(place > 0) & (place <= n_a[window])], ids[place > n_a[window]]
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # from each end to the next, one token of A and one of B lie over the bytes
        steps = np.union1d(ends_a, ends_b)
        i, j = np.searchsorted(ends_a, steps), np.searchsorted(ends_b, steps)
        links = a[i] << 32 | b[j]
        ends = ends_a[np.cumsum(n_a) - 1]
        self.firsts = np.concatenate([self.firsts, len(self.links) + np.searchsorted(steps, ends) + 1])
        self.links = np.concatenate([self.links, links])
        # groups end where both do; as text, those of A stand before those of B
        closing = steps[(ends_a[i] == steps) & (ends_b[j] == steps)]
        self.n_groups = np.concatenate([self.n_groups, np.diff(np.searchsorted(closing, ends, side="right"), prepend=0)])
        group_a, group_b = np.searchsorted(closing, ends_a), np.searchsorted(closing, ends_b)
        at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        text = np.empty(len(a) + len(b), dtype=object)
        text[at_a] = self.text_a[2 * a + (ends_a == closing[group_a])]
        text[at_b] = self.text_b[2 * b + (ends_b == closing[group_b])]
        text, edges = text.tolist(), [0, *np.cumsum(n_a + n_b).tolist()]
        self.groups += ["".join(text[x:y])[:-1] for x, y in zip(edges, edges[1:])]

    # -------------------------------------------------------------- batches

    def batch(self, texts: list[str]) -> tuple[dict, dict]:
        """What is stored of a batch: lists with an entry per text, and the batch's
        own pairs and windows."""
        if len(self.memo) > MEMO // 2:
            self.forget()
        (a, n_a), (b, n_b) = self.tokens(texts)
        n = len(texts)
        if not len(a):
            none = np.zeros(0, dtype=np.int64)
            docs = {"n_a": n_a, "n_b": n_b, "n_groups": n_a, "n_links": n_a, "groups_sha256": [""] * n,
                    "windows": [none] * n, "times": [none] * n}
            return docs, {"pairs": none, "linked": none, "firsts": none, "links": none}
        text_ends = np.cumsum(n_a)
        ends_a, ends_b = self.cut(a, b, text_ends)
        known, window = np.unique(self.lookup(a, b, ends_a, ends_b), return_inverse=True)
        names = [self.groups[x] for x in known.tolist()]
        n_groups, n_links = self.n_groups[known], self.firsts[known + 1] - self.firsts[known]
        firsts = np.concatenate([[0], np.cumsum(n_links)])
        place = np.arange(firsts[-1]) + np.repeat(self.firsts[known] - firsts[:-1], n_links)
        pairs, links = np.unique(self.links[place], return_inverse=True)
        uses = np.bincount(window, minlength=len(known))
        linked = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(linked, links, np.repeat(uses, n_links))
        edges = np.searchsorted(ends_a, text_ends, side="right")  # windows before each text's end
        begins = np.concatenate([[0], edges[:-1]])
        sums = [np.concatenate([[0], np.cumsum(x[window])]) for x in (n_groups, n_links)]
        ids = window.tolist()
        digests = [hashlib.sha256(";".join(map(names.__getitem__, ids[x:y])).encode()).hexdigest() if y > x else ""
                   for x, y in zip(begins.tolist(), edges.tolist())]
        # the distinct windows of each text and how often it has them
        text = np.repeat(np.arange(n), edges - begins)
        found, times = np.unique(text * len(known) + window, return_counts=True)
        cut = np.searchsorted(found, np.arange(1, n) * len(known))
        docs = {"n_a": n_a, "n_b": n_b, "n_groups": sums[0][edges] - sums[0][begins], "n_links": sums[1][edges] - sums[1][begins],
                "groups_sha256": digests, "windows": np.split(found % len(known), cut), "times": np.split(times, cut)}
        return docs, {"pairs": pairs, "linked": linked, "firsts": firsts, "links": links}


def gather(flat: np.ndarray, begins: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``numbers`` of lists that lie one after the other: flat, and how
    long each is."""
    size = begins[numbers + 1] - begins[numbers]
    place = np.arange(int(size.sum())) + np.repeat(begins[numbers] - (np.cumsum(size) - size), size)
    return flat[place], size


def parts_of(text: str) -> list[str]:
    """The text cut at the blanks where tokens can't go across."""
    if not text:
        return []
    visible = text.replace("\n", "x").isprintable() and "\u2581" not in text
    if visible and not any(x in text for x in _UNSAFE) and text[0] not in " \n" and text[-1] not in " \n":
        return text.split(" ")
    return _CUT.split(text)


def _with_ends(n: int, inner: str, last: str) -> np.ndarray:
    """Each id as text, followed by ``inner`` (at 2 * id) or ``last``."""
    return np.array([f"{i}{end}" for i in range(n) for end in (inner, last)], dtype=object)


def _by_rank(path: str, entries: list[bytes]):
    """An encoder by ranks, for a vocabulary that has the same id for every entry."""
    from public_tokenizers import PATTERN
    from tiktoken import Encoding

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, lines)}
    if any(entries[i] != entry for entry, i in ranks.items()):
        raise ValueError("the ranks are of another vocabulary")
    return Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def _aligner(name_a: str, name_b: str) -> Aligner:
    from public_tokenizers import path

    return Aligner(path(name_a), path(name_b), path(RANKS_A[name_a]) if name_a in RANKS_A else None)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def _stored(name_a: str, name_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(name_a, name_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, end, _, _ in textops.text_slices(batch.column("text"), BATCH_BYTES):
                texts = [t or "" for t in batch.column("text").slice(begin, end - begin).to_pylist()]
                docs, own = aligner.batch(texts)
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), batch.column("doc_id").slice(begin, n),
                     *(pa.array(docs[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(docs["groups_sha256"], pa.string()),
                     *(_lists(docs[c], pa.int32()) for c in ("windows", "times")),
                     *(pa.nulls(n, pa.list_(k)) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], _NAMES)
                # the batch's own row is told by its pairs
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), *(pa.nulls(1, pa.int64()) for _ in range(5)), pa.nulls(1, pa.string()),
                     *(pa.nulls(1, pa.list_(pa.int32())) for _ in range(2)),
                     *(_lists([own[c]], k) for c, k in (("pairs", pa.int64()), ("linked", pa.int64()),
                                                        ("firsts", pa.int32()), ("links", pa.int32())))], _NAMES)
                number += 1
    return run


_NAMES = [c.split()[0] for c in _STORED.split(", ")]


def _totals(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """One batch: its texts' links added up. ``counts``: place of a pair among the
    batch's pairs, its links in the corpus, whether its B id has none with more."""
    at = counts.column("at").to_numpy()
    links = np.zeros(len(at), dtype=np.int64)
    best = np.zeros(len(at), dtype=np.int64)
    links[at], best[at] = counts.column("n").to_numpy(), counts.column("best").to_numpy()
    is_text = rows.column("pairs").is_null().to_numpy()
    own = rows.filter(pa.array(~is_text))
    texts = rows.filter(pa.array(is_text))
    firsts, place = (own.column(c).combine_chunks().flatten().to_numpy() for c in ("firsts", "links"))
    sums = [np.concatenate([[0], np.cumsum(v[place])]) for v in (links, best)]
    by_window = [s[firsts[1:]] - s[firsts[:-1]] if len(firsts) else s[:0] for s in sums]
    windows, times = (texts.column(c).combine_chunks() for c in ("windows", "times"))
    ends = np.concatenate([[0], np.cumsum(np.diff(windows.offsets.to_numpy()))])
    w, t = windows.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    count_sum, n_best = ((s := np.concatenate([[0], np.cumsum(v[w] * t)]))[ends[1:]] - s[ends[:-1]] for v in by_window)
    return (texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
            .append_column("n_best", pa.array(n_best, pa.int64()))
            .append_column("count_sum", pa.array(count_sum, pa.int64()))
            .append_column("groups_sha256", texts.column("groups_sha256")))


def align_batches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer_a: str = TOKENIZER_A,
                  tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """The stored form: rows of texts and, with ``pairs``, rows of batches."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stored_once(rows.mapInArrow(_stored(tokenizer_a, tokenizer_b), _STORED), "token-alignment")


def pair_counts(stored: DataFrame) -> DataFrame:
    """(pair, n links, best) of the corpus; a pair is A's id * 2**32 + B's id; best:
    1 if no pair of the B id has more links, else 0."""
    pairs = (stored.where(F.col("pairs").isNotNull())
             .select(F.explode(F.arrays_zip("pairs", "linked")).alias("x"))
             .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.linked").alias("n"))
             .withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    pairs = stored_once(pairs, "token-pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer_a: str = TOKENIZER_A,
                 tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """Per row of ``docs``: doc_id, its tokens by A and B, groups (tokens between
    places where both end), links (pairs of tokens whose bytes overlap), n_best
    (links whose id pair has the most links of its B id, ties included), count_sum
    (the corpus-wide links of each link's pair, added up) and the digest of the
    groups' ids."""
    stored = align_batches(docs, doc_id, text, tokenizer_a, tokenizer_b)
    wanted = (stored.where(F.col("pairs").isNotNull())
              .select(F.col("batch").alias("of"), F.posexplode("pairs").alias("at", "pair")))
    counts = wanted.join(pair_counts(stored), "pair").select("of", "at", "n", "best")
    return (stored.groupBy("batch").cogroup(counts.groupBy("of")).applyInArrow(_totals, _RESULT)
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
