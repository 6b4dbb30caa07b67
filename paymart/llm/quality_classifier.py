"""Quality classifier with hierarchical empirical Bayes.

1. Document evidence. Two logistic models, one for quality and one for
   toxicity, on which words and word stems of a lexicon a text has (letters
   only, lower case) and on a few measures of its form. They are fitted in numpy on a sample of at
   most ``SAMPLE`` labelled documents, the ones with the smallest hashes of their
   ids; a model's lexicon is the words whose presence goes with its label by a
   likelihood-ratio statistic of at least ``MIN_RATIO``, at most ``LEXICON`` of them. This is the only bounded part; every document is
   scored over its whole text.
2. Site posteriors. The evidence of all documents is summed per path (host and
   path), folded per task, and rolled up to hosts and to the whole. A host's mean
   is shrunk towards the global mean, a path's towards its host's, by a
   pseudo-count that the spread between sites determines (method of moments): a
   sparse site stays near the level above, a large one speaks for itself.
3. A document's log-odds are shifted by the difference of its path's log-odds
   from the global ones. It is kept if the result reaches ``KEEP``.

The site table (one row per path) is joined back on (path, salt), so a site with
a third of all documents is spread over ``SALTS`` keys.

Results: one row per input row (all its columns; clashing names replaced) with
``p_quality``, ``p_toxic``, ``p_good`` and ``kept``. Null text counts as empty, null
host and path as sites of their own. Labels with a null id or null value teach
nothing; repeated labels count each. Without labels of both classes a model says
0.5 (quality) or 0 (toxicity) and the site level stays neutral: all is kept.
An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm import textops as tx
from paymart.llm.quality_rules import measure
from paymart.session import work_dir

SAMPLE = 6000
LEXICON = 2000
MIN_RATIO = 25.0
STEM_BYTES = (5, 7)
STEM_LEVELS = (2, 3, 5)
KEEP = 0.5
SALTS = 32
_LEAST = 1e-4
FORM = ("upper", "symbols", "repeats", "dup_lines", "ends", "variety", "short", "word_length")

# A-Z to a-z; ASCII characters that are no letters end a word.
_NOT_LETTER = np.zeros(256, dtype=bool)
_NOT_LETTER[:128] = True
_NOT_LETTER[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = False


# ---------------------------------------------------------------- features

def _once(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (text, hash), with the place of each one's first row."""
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    fresh = np.ones(len(t), dtype=bool)
    fresh[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[fresh], h[fresh], order[fresh]


def lexical(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of what each text has, in order of texts: its distinct
    words, and the stems that several of its distinct words begin with (one
    feature each for reaching the numbers in ``STEM_LEVELS``)."""
    low = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)
    words = tx.words_of(low, offsets, _NOT_LETTER)
    text, hashes, at = _once(words.text, words.hashes)
    starts, size = words.starts[at], (words.ends - words.starts)[at]
    texts, features = [text], [hashes]
    for length in STEM_BYTES:
        long = np.flatnonzero(size > length)
        stems = tx.span_hashes(low, starts[long], starts[long] + length)
        order = np.lexsort((stems, text[long]))
        of, stem, _ = _once(text[long], stems)
        t, h = text[long][order], stems[order]
        first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])])[:len(t)])
        count = np.diff(np.append(first, len(t)))
        for level in STEM_LEVELS:
            texts.append(of[count >= level])
            features.append(tx.mix(stem[count >= level], 100 * length + level))
    text, hashes = np.concatenate(texts), np.concatenate(features)
    order = np.argsort(text, kind="stable")
    return text[order], hashes[order]


def form(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x ``FORM``: measures of form, each about 0 to 1."""
    m = {k: v.astype(np.float64) for k, v in measure(data, offsets).items()}
    words = np.maximum(m["n_words"], 1)
    return np.stack([
        m["n_upper"] / np.maximum(m["n_letters"], 1), np.minimum(1, m["n_symbols"] / words),
        m["n_repeat_words"] / words, m["n_dup_lines"] / np.maximum(m["n_lines"], 1), m["n_ends"] / words,
        m["n_distinct"] / words, np.exp(-m["n_words"] / 10), np.minimum(1, m["word_chars"] / words / 20)], axis=1)


def _form_features(x: np.ndarray) -> np.ndarray:
    """Measures and their steps (how far beyond a few levels they go)."""
    return np.hstack([x, x > 0.1, x > 0.25, x > 0.5]).astype(np.float64)


# ------------------------------------------------------------------ models

def fit_logistic(row: np.ndarray, column: np.ndarray, n_columns: int, dense: np.ndarray, y: np.ndarray,
                 ridge: float = 3e-4, rounds: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression by accelerated gradient descent: (weights of the
    sparse columns, weights of the dense ones, the last a bias)."""
    n = len(y)
    dense = np.hstack([dense, np.ones((n, 1))])
    w, v = np.zeros(n_columns), np.zeros(dense.shape[1])
    near_w, near_v = w, v
    # columns count less the more documents have them, so that steps fit all
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(column, minlength=n_columns)) / n + 0.01)
    value = scale[column]
    size = np.bincount(row, weights=value**2, minlength=n) + (dense**2).sum(axis=1)
    step = 1 / (0.25 * np.percentile(size, 90) + ridge)
    for turn in range(rounds):
        margin = np.bincount(row, weights=value * near_w[column], minlength=n) + dense @ near_v
        gap = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / n
        new_w = near_w - step * (np.bincount(column, weights=value * gap[row], minlength=n_columns) + ridge * near_w)
        new_v = near_v - step * (dense.T @ gap + ridge / 10 * near_v)
        go = turn / (turn + 3)
        near_w, near_v = new_w + go * (new_w - w), new_v + go * (new_v - v)
        w, v = new_w, new_v
    return w * scale, v


def telling_words(hashes: np.ndarray, positive: np.ndarray, n_positive: int, n: int) -> np.ndarray:
    """Sorted hashes of the words whose presence tells the classes apart:
    ``positive`` says for each (document, word) whether the document is."""
    words, index = np.unique(hashes, return_inverse=True)
    a = np.bincount(index, weights=positive, minlength=len(words))
    b = np.bincount(index, weights=~positive, minlength=len(words))
    ratio = np.zeros(len(words))
    for have, total in ((a, n_positive), (b, n - n_positive), (n_positive - a, n_positive), (n - n_positive - b, n - n_positive)):
        share = (a + b) / n if have is a or have is b else 1 - (a + b) / n
        ratio += 2 * have * np.log(np.maximum(have, 1e-12) / np.maximum(total * share, 1e-12))
    good = np.flatnonzero(ratio >= MIN_RATIO)
    return np.sort(words[good[np.lexsort((words[good], -ratio[good]))[:LEXICON]]])


@dataclass
class LogisticModel:
    lexicon: np.ndarray  # sorted word hashes
    words: np.ndarray    # their weights
    forms: np.ndarray    # weights of the form features, and a bias

    def predict(self, text: np.ndarray, hashes: np.ndarray, shape: np.ndarray) -> np.ndarray:
        margin = shape @ self.forms[:-1] + self.forms[-1]
        if len(self.lexicon):
            place = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            known = self.lexicon[place] == hashes
            margin += np.bincount(text[known], weights=self.words[place[known]], minlength=len(shape))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


@dataclass
class DocumentModel:
    models: dict[str, LogisticModel]  # by target

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        text, hashes = lexical(data, offsets)
        shape = _form_features(form(data, offsets))
        return {target: model.predict(text, hashes, shape) for target, model in self.models.items()}


def fit_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  sample: int = SAMPLE) -> DocumentModel:
    """The two models, from at most ``sample`` labels."""
    ids = (labels.select(F.col("doc_id").alias("id"), "quality", "toxic").where(F.col("id").isNotNull())
           .orderBy(F.xxhash64(F.lit("quality-sample"), F.col("id")), "id", "quality", "toxic").limit(sample))

    @F.arrow_udf("struct<words:binary,form:binary>")
    def take(texts: pa.Array) -> pa.Array:
        rows = []
        for _, _, data, offsets in tx.text_slices(texts):
            at, hashes = lexical(data, offsets)
            cuts = np.searchsorted(at, np.arange(len(offsets)))
            shapes = form(data, offsets)
            rows += [{"words": hashes[cuts[i]:cuts[i + 1]].tobytes(), "form": shapes[i].tobytes()}
                     for i in range(len(offsets) - 1)]
        return pa.array(rows, type=pa.struct([("words", pa.binary()), ("form", pa.binary())]))

    # at most ``sample`` narrow rows are broadcast
    rows = (docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .join(F.broadcast(ids), "id").select("quality", "toxic", take("text").alias("f"), "id")
            .orderBy("id").limit(2 * sample).select("quality", "toxic", "f.words", "f.form").collect())
    bags = [np.frombuffer(r.words, dtype=tx.U64) for r in rows]
    model = DocumentModel({})
    for target in ("quality", "toxic"):
        use = [i for i, r in enumerate(rows) if r[target] is not None]
        y = np.array([rows[i][target] > 0 for i in use], dtype=bool)
        if len(set(y.tolist())) < 2:
            continue
        hashes = np.concatenate([bags[i] for i in use])
        row = np.repeat(np.arange(len(use)), [len(bags[i]) for i in use])
        lexicon = telling_words(hashes, y[row], int(y.sum()), len(y))
        known = np.isin(hashes, lexicon)
        shapes = _form_features(np.stack([np.frombuffer(rows[i].form) for i in use]))
        words, forms = fit_logistic(row[known], np.searchsorted(lexicon, hashes[known]), len(lexicon), shapes,
                                    y.astype(np.float64))
        model.models[target] = LogisticModel(lexicon, words, forms)
    return model


# ------------------------------------------------------------------- sites

def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_LEAST)), F.lit(1 - _LEAST))
    return F.log(p / (1 - p))


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def _pseudo_count(groups: DataFrame, mean: str, n: str, of: str) -> float:
    """How many documents the level above is worth: p(1 - p) over the variance
    between groups, less what sampling alone explains."""
    spread = F.col(n) * (F.col(mean) - F.col(of)) ** 2
    noise = F.col(of) * (1 - F.col(of))
    r = groups.agg(F.sum(spread), F.sum(noise), F.sum(n), F.sum(F.col(n) * noise)).first()
    if not r[2] or not r[3]:
        return 1.0
    between = max((r[0] - r[1]) / r[2], 1e-6)
    return float(min(max(r[3] / r[2] / between, 1.0), 1e6))


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """(``__site_host``, ``__site_path``, ``shift``) from rows with those two and
    ``p_good``: the path's shrunken log-odds less the global ones."""
    paths = evidence.groupBy("__site_host", "__site_path").agg(F.sum("p_good").alias("good"), F.count(F.lit(1)).alias("n"))
    spark = evidence.sparkSession
    at = work_dir(spark, "quality-sites")
    paths.write.parquet(at)
    paths = spark.read.schema(paths.schema).parquet(at)
    total = paths.agg(F.sum("good"), F.sum("n")).first()
    if not total[1]:
        return paths.select("__site_host", "__site_path", F.lit(0.0).alias("shift"))
    overall = float(total[0]) / total[1]
    hosts = (paths.groupBy("__site_host").agg(F.sum("good").alias("h_good"), F.sum("n").alias("h_n"))
             .withColumn("mean", F.col("h_good") / F.col("h_n")).withColumn("of", F.lit(overall)))
    k = _pseudo_count(hosts, "mean", "h_n", "of")
    hosts = hosts.select("__site_host", ((F.col("h_good") + k * overall) / (F.col("h_n") + k)).alias("host_mean"))
    both = paths.join(hosts, "__site_host").withColumn("mean", F.col("good") / F.col("n"))
    k = _pseudo_count(both, "mean", "n", "host_mean")
    shrunk = (F.col("good") + k * F.col("host_mean")) / (F.col("n") + k)
    return both.select("__site_host", "__site_path", (_logit(shrunk) - _logit(F.lit(overall))).alias("shift"))


def classify_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     host: str = "source", path: str = "lang", keep: float = KEEP,
                     model: DocumentModel | None = None) -> DataFrame:
    """``docs`` with ``p_quality``, ``p_toxic``, ``p_good`` and ``kept``."""
    model = model or fit_documents(docs, labels, text, doc_id)
    out = ("p_quality", "p_toxic", "p_good", "kept")
    kept = [c for c in docs.columns if c not in out]

    @F.arrow_udf("struct<q:double,t:double>")
    def predict(texts: pa.Array) -> pa.Array:
        parts = [(len(offsets) - 1, model.predict(data, offsets)) for _, _, data, offsets in tx.text_slices(texts)]
        columns = [np.concatenate([p.get(target, np.full(n, default)) for n, p in parts]) if parts else np.zeros(0)
                   for target, default in (("quality", 0.5), ("toxic", 0.0))]
        return pa.StructArray.from_arrays([pa.array(c, type=pa.float64()) for c in columns], names=["q", "t"])

    salt = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(SALTS)).cast("int")
    scored = docs.select(*kept, _key(F.col(host)).alias("__site_host"), _key(F.col(path)).alias("__site_path"),
                         salt.alias("__site_salt"), predict(F.coalesce(F.col(text), F.lit(""))).alias("__site_p"))
    scored = scored.withColumn("p_good", F.col("__site_p.q") * (1 - F.col("__site_p.t")))
    sites = (site_posteriors(scored.select("__site_host", "__site_path", "p_good"))
             .withColumn("__site_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    odds = _logit(F.col("p_good")) + F.col("shift")
    return (scored.join(sites, ["__site_host", "__site_path", "__site_salt"])
            .select(*kept, F.col("__site_p.q").alias("p_quality"), F.col("__site_p.t").alias("p_toxic"),
                    (1 / (1 + F.exp(-odds))).alias("p_good"))
            .withColumn("kept", (F.col("p_good") >= keep)))
