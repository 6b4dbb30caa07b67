"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: target rows of the source divided by
its rows. Each row draws its number of copies from the Poisson distribution of
that rate, by inverting it at a number in [0, 1) that is a hash of ``seed`` and
the row's id. So the draw is the same in every run, every layout and every
retry, no row needs to know of any other, and the expected mix is the target.
Copies are exploded and dealt over all tasks in a hash-random order.

Rows are counted per source with a fold in each task. The rates (one row per
source) are stored and joined back on (source, salt): Spark broadcasts them if they
are as small as they should be; else a source with a third of all rows is spread
over ``SALTS`` join keys.

Results: the input's columns and ``copy_no`` (0, 1, ...; a clashing name is
replaced); rows with no copy are gone. A null source is a source of its own; a
null id draws like an empty id; rows with the same id draw the same number. A
source that ``targets`` lacks, or gives no positive weight, gets no rows. Empty
texts are rows like any other. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.session import stored_once

SEED = "mix-1"
ALPHA = 0.5
SALTS = 32
_S, _SALT, _U, _CDF = "__mix_source", "__mix_salt", "__mix_u", "__mix_cdf"


def _source_key(source: Column) -> Column:
    """Join key that keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _hash_hex(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the id."""
    return F.conv(F.substring(_hash_hex(doc_id, seed), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """The distribution function of the Poisson distribution at 0, 1, ..., until
    what is left is below double precision (in logarithms, so large rates work)."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    step = F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("cdf"))

    def add(have: Column, i: Column) -> Column:
        log_p = have["log_p"] + F.log(rate) - F.log(i.cast("double"))
        return F.struct(log_p.alias("log_p"),
                        F.concat(have["cdf"], F.array(F.element_at(have["cdf"], -1) + F.exp(log_p))).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), last), step, add, lambda have: have["cdf"])


def source_counts(docs: DataFrame, source: str = "source") -> DataFrame:
    return docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def tempered_targets(counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Target weights in proportion to the source's size to the power ``alpha``:
    large sources are thinned, small ones repeated."""
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(alpha)).alias("weight"))


def source_rates(counts: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """Mean copies per row and source; ``total``: expected rows of the result
    (default: the rows there are)."""
    weighted = (counts.withColumn(_S, _source_key(F.col("source")))
                .join(targets.select(_source_key(F.col("source")).alias(_S), "weight"), _S)
                .where((F.col("weight") > 0) & (F.col("n") > 0)))
    sums = weighted.agg(F.sum("weight"), F.sum("n")).first()
    if sums[0] is None:
        return weighted.select(_S, F.lit(0.0).alias("rate"))
    rows = float(total if total is not None else counts.agg(F.sum("n")).first()[0])
    return weighted.select(_S, (F.lit(rows) * F.col("weight") / F.lit(float(sums[0])) / F.col("n")).alias("rate"))


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, total: float | None = None,
                seed: str = SEED, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Copies of ``docs``; ``targets`` has (source, weight), by default
    ``tempered_targets``."""
    counts = source_counts(docs, source)
    rates = source_rates(counts, targets if targets is not None else tempered_targets(counts), total)
    # stored, so that Spark knows how small it is and need not shuffle the documents
    # to meet it; if there are very many sources, the salts spread the large ones
    spread = stored_once(rates.select(_S, poisson_cdf(F.col("rate")).alias(_CDF))
                         .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "mixing-rates")
    kept = [c for c in docs.columns if c != "copy_no"]
    drawn = (docs.select(*kept, _source_key(F.col(source)).alias(_S), uniform(F.col(doc_id), seed).alias(_U),
                         F.pmod(F.xxhash64(F.col(doc_id)), F.lit(SALTS)).cast("int").alias(_SALT))
             .join(spread, [_S, _SALT])
             .withColumn("copy_no", F.size(F.filter(_CDF, lambda c: c <= F.col(_U))))
             .where("copy_no > 0"))
    numbers = F.sequence(F.lit(0).cast("long"), F.col("copy_no").cast("long") - 1)
    copies = drawn.select(*kept, F.explode(numbers).alias("copy_no"))
    order = F.xxhash64(F.lit(seed), F.col(doc_id), F.col("copy_no"))
    return (copies.withColumn(_U, order).repartition(_U).sortWithinPartitions(_U).drop(_U))


def oracle_sql(alpha: float = ALPHA, seed: str = SEED) -> str:
    """DuckDB SQL of the registered query."""
    return f"""
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sum(n) OVER () * (pow(n, {alpha}) / sum(pow(n, {alpha})) OVER ()) / n AS rate FROM counts),
tables AS (
  SELECT source, list_transform(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1),
    lambda k: list_sum(list_transform(range(0, k + 1), lambda i: exp(i * ln(rate) - rate - lgamma(i + 1))))) AS cdf
  FROM rates),
drawn AS (
  SELECT d.*, len(list_filter(t.cdf,
      lambda c: c <= CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
                / CAST(4503599627370496 AS DOUBLE))) AS copies
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, text, lang, source, n_chars, unnest(range(0, copies)) AS copy_no FROM drawn WHERE copies > 0
"""
