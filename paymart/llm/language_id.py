"""Language identification by hierarchical discrimination.

A text's features are hashed counts of its lower-cased byte 2- and 3-grams (all
of the text). One-versus-one linear support vector machines (squared hinge,
trained here in numpy) first choose the language family; then, within the
family, one-versus-one machines separate the closely related languages. At both
levels the class with most wins is taken, ties going to the larger sum of
margins and then to the smaller name.

Training rows are the labelled rows outside the held-out third (crc32 of the id
as text, modulo 3, is 1 there). The machines are fitted on a sample of at most
about ``PER_LANGUAGE`` rows of each language, the ones with the smallest hashes
of their ids, of the ``LANGUAGES`` most frequent languages, and ``SAMPLE_LIMIT`` rows in
all: this is the only bounded part.
Language counts that steer the sample and the predictions cover every row.
Language, source and id are never features.

Results: one row per input row (all its columns; clashing names replaced) with
``held_out``, ``lang_pred`` and ``score`` (0 to 1: how clear the closest
decision at each level was). Null text, or one without a letter: ``und``, score
0. Nothing to learn from: ``und`` for all. One language only: that one, score 1.
Null id: hashed as empty text. Repeated rows are predicted each, alike. An empty
table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm import textops as tx

BUCKETS = 2048
PER_LANGUAGE = 500
SAMPLE_LIMIT = 20_000
LANGUAGES = 1000
UNKNOWN = "und"
_ROWS = 256
_SLOPE = 4.0

# Families of language codes; any other code is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "sa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "uralic": ("et", "fi", "hu"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, lang)


# ---------------------------------------------------------------- features

def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z, and the capitals of the Latin-1 letters, in lower case."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Texts x buckets: square roots of n-gram counts, of unit length."""
    n = len(offsets) - 1
    out = np.zeros(n * buckets, dtype=np.float32)
    low = lowered(data).astype(np.uint32)
    text = np.repeat(np.arange(n), np.diff(offsets))
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for width, odd in ((2, (0x9E3779B1, 0x85EBCA77)), (3, (0xC2B2AE3D, 0x27D4EB2F, 0x165667B1))):
        if len(data) < width:
            continue
        end = len(data) - width + 1
        code = sum(low[i:end + i] * np.uint32(m) for i, m in enumerate(odd)) + np.uint32(width)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        slot = text[:end] * buckets + (code >> shift)
        out += np.bincount(slot[text[width - 1:] == text[:end]], minlength=n * buckets)
    out = np.sqrt(out.reshape(n, buckets))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _slices(texts: pa.Array):
    """Like ``text_slices``, of at most ``_ROWS`` texts each."""
    for at in range(0, len(texts), _ROWS):
        for _, _, data, offsets in tx.text_slices(texts[at:at + _ROWS]):
            yield data, offsets


# ---------------------------------------------------------------- machines

def fit_svm(x: np.ndarray, sign: np.ndarray, weight: np.ndarray, ridge: float = 1e-3,
            rounds: int = 250) -> np.ndarray:
    """Linear machine (last entry: bias) by accelerated gradient descent on the
    weighted squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    w = ahead = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    step = 1 / (ridge + 2 * np.einsum("i,ij->", weight, x * x))
    for turn in range(rounds):
        slack = np.maximum(0, 1 - sign * (x @ ahead))
        new = ahead - step * (ridge * ahead - 2 * (weight * slack * sign) @ x)
        ahead, w = new + turn / (turn + 3) * (new - w), new
    return w


@dataclass
class OneVersusOne:
    classes: list[str]
    weights: np.ndarray  # pairs x (features + 1)

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> "OneVersusOne":
        classes = sorted(set(labels.tolist()))
        rows = []
        for a, b in combinations(classes, 2):
            use = (labels == a) | (labels == b)
            sign = np.where(labels[use] == a, 1.0, -1.0)
            even = np.where(sign > 0, 1 / (sign > 0).sum(), 1 / (sign < 0).sum())
            rows.append(fit_svm(x[use], sign, even))
        return cls(classes, np.array(rows).reshape(len(rows), x.shape[1] + 1).astype(np.float32))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class number, clearness of its closest duel) per row."""
        n, k = len(x), len(self.classes)
        wins, sums, closest = np.zeros((n, k)), np.zeros((n, k)), np.full((n, k), np.inf)
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1] if len(self.weights) else np.zeros((n, 0))
        for margin, (a, b) in zip(margins.T, combinations(range(k), 2)):
            for c, m in ((a, margin), (b, -margin)):
                wins[:, c] += m > 0 if c == b else m >= 0
                sums[:, c] += m
                closest[:, c] = np.minimum(closest[:, c], m)
        best = np.lexsort((np.broadcast_to(-np.arange(k), (n, k)), sums, wins), axis=1)[:, -1]
        return best, 1 / (1 + np.exp(-_SLOPE * closest[np.arange(n), best]))


@dataclass
class Hierarchy:
    families: OneVersusOne
    languages: dict[str, OneVersusOne]

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> "Hierarchy":
        families = np.array([family_of(c) for c in langs])
        within = {f: OneVersusOne.fit(x[families == f], langs[families == f]) for f in sorted(set(families.tolist()))}
        return cls(OneVersusOne.fit(x, families), within)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, clear = self.families.predict(x)
        lang = np.empty(len(x), dtype=object)
        for number, name in enumerate(self.families.classes):
            rows = np.flatnonzero(family == number)
            if len(rows):
                best, clearer = self.languages[name].predict(x[rows])
                lang[rows] = np.array(self.languages[name].classes, dtype=object)[best]
                clear[rows] *= clearer
        return lang, clear


# --------------------------------------------------------------- operator

def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                  per_language: int = PER_LANGUAGE, limit: int = SAMPLE_LIMIT) -> Hierarchy | None:
    """The machines, from a bounded sample of the rows that are not held out."""
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("id")).where(
        F.col("lang").isNotNull() & ~held_out(F.col("id")))
    # at most LANGUAGES rows are broadcast
    counts = F.broadcast(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                         .orderBy(F.desc("n"), "lang").limit(LANGUAGES))
    place = F.pmod(F.xxhash64(F.lit("lang-sample"), F.col("id")), F.lit(1 << 30)) / float(1 << 30)
    chosen = (known.withColumn("place", place).join(counts, "lang")
              .where((F.col("place") * F.col("n") < per_language) & _has_letter(F.col("text"))))

    @F.arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        rows = [row.tobytes() for data, offsets in _slices(texts) for row in features(data, offsets)]
        return pa.array(rows, type=pa.binary())

    # the rank within the language first: beyond the limit, every language keeps its share
    rows = (chosen.orderBy(F.col("place") * F.col("n"), "lang", "id").limit(limit)
            .select("lang", vector(F.coalesce("text", F.lit(""))).alias("vector")).collect())
    if not rows:
        return None
    x = np.frombuffer(b"".join(r.vector for r in rows), dtype=np.float32).reshape(len(rows), -1)
    return Hierarchy.fit(x, np.array([r.lang for r in rows]))


def identify_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                       model: Hierarchy | None = None, **how) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``."""
    model = model or fit_languages(docs, text, lang, doc_id, **how)
    kept = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array, letters: pa.Array) -> pa.Array:
        names, scores = [], []
        for data, offsets in _slices(texts):
            best, clear = model.predict(features(data, offsets))
            names += best.tolist()
            scores += clear.tolist()
        use = letters.to_pylist()
        return pa.array([{"lang_pred": n if ok else UNKNOWN, "score": s if ok else 0.0}
                         for n, s, ok in zip(names, scores, use)], type=kind)

    base = docs.select(*kept, held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("__lang_text"))
    if model is None:
        return base.select(*kept, "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = predict(F.coalesce("__lang_text", F.lit("")), _has_letter(F.col("__lang_text")))
    return base.withColumn("__lang", found).select(*kept, "held_out", "__lang.lang_pred", "__lang.score")
