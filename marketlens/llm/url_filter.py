"""URL filter: host and path rules, and a ratio of two character language models where no rule fits.

The URLs that rules allow or block are the examples. For each of the two classes a variable-order Markov model gives
the probability of a character after up to three characters; Witten-Bell smoothing backs off from each context to the
next shorter one. A URL's score is the difference of its log-likelihoods under both models, divided by its number of
characters. The threshold on it is calibrated: the examples are scored by models that count only the other half of the
examples, and the threshold with the least mean error rate of both classes is taken.

Character counts cover all examples. Their number is bounded by the alphabet (41 characters to the power of 4), so a
model is a table of proven size however large the input: at most 2.9 million rows reach the driver, and 11 MB are
broadcast.

A URL that is null or has no ``://`` has an empty host and path, no rule, and the score of the text that ends at once;
URLs of any length are read whole. Without examples of both classes the threshold is 0, and a score of at least the
threshold means allow. Repeated rows get equal verdicts. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import slices, table, text_bytes

# Fixed values of the contract.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

ORDER = 3
# 0 is the end (and what stands before the start), 1 any other character.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789/.-"
LETTERS = len(SYMBOLS) + 2
_CODE = np.ones(256, np.int64)
_CODE[[ord(c) for c in SYMBOLS]] = np.arange(2, LETTERS)
_CODE[[ord(c) for c in SYMBOLS[:26].upper()]] = np.arange(2, 28)
# Scores are counted in bins of this width for the calibration.
BIN = 0.005

UPPER, LOWER = SYMBOLS[:26].upper(), SYMBOLS[:26]


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does. Of equally long ones the first by text."""
    name = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        top, slash, rest = rule.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of every run of ORDER + 1 characters, and the text that it is in. Every text ends with the end sign."""
    data, offsets = text_bytes(column)
    lengths = np.diff(offsets)
    codes = np.zeros(len(data) + (ORDER + 1) * len(lengths), np.int64)
    codes[np.arange(len(data)) + np.repeat(np.arange(len(lengths)) * (ORDER + 1) + ORDER, lengths)] = _CODE[data]
    number = codes[: len(codes) - ORDER]
    for k in range(1, ORDER + 1):
        number = number * LETTERS + codes[k : len(codes) - ORDER + k]
    # A text has one gram for each of its characters and one for its end; the others would cross texts.
    text = np.repeat(np.arange(len(lengths)), lengths + ORDER + 1)[: len(number)]
    starts = offsets[:-1] + np.arange(len(lengths)) * (ORDER + 1)
    own = np.arange(len(number)) - starts[text] <= lengths[text] if len(number) else np.empty(0, bool)
    return number[own], text[own]


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Log of the smoothed probability of each run's last character after those before it."""
    counts = counts.reshape((LETTERS,) * (ORDER + 1))
    p = np.full(LETTERS, 1 / LETTERS)
    for order in range(ORDER + 1):
        n = counts.sum(axis=tuple(range(ORDER - order)), dtype=np.float64)
        total, kinds = n.sum(-1, keepdims=True), np.count_nonzero(n, axis=-1)[..., None]
        p = np.where(total > 0, (n + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).astype(np.float32).ravel()


def log_ratio(accepted: np.ndarray, rejected: np.ndarray) -> np.ndarray:
    return log_probabilities(accepted) - log_probabilities(rejected)


def scores(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    number, text = grams(column)
    sums = np.bincount(text, ratio[number], len(column))
    return sums / np.maximum(np.bincount(text, minlength=len(column)), 1)


def class_counts(examples: DataFrame) -> DataFrame:
    """gram, half, good, bad: how often each run of characters is in the allowed and in the blocked URLs of each half."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "url"):
            number, text = grams(batch.column("url"))
            kind = (batch.column("half").to_numpy() * 2 + batch.column("good").cast(pa.int32()).to_numpy())[text]
            keys, n = np.unique(number * 4 + kind, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys // 4), pa.array(keys % 4), pa.array(n)], ["gram", "kind", "n"])

    counted = examples.mapInArrow(count, "gram long, kind long, n long")
    return counted.groupBy("gram", "kind").agg(F.sum("n").alias("n"))


def threshold(histogram: list[tuple[int, bool, int]]) -> float:
    """Where the mean of both classes' error rates is least: the middle of the best range."""
    bins = sorted({b for b, _, _ in histogram})
    total = {g: sum(n for _, k, n in histogram if k == g) for g in (True, False)}
    if not all(total.values()):
        return 0.0
    share = {g: {b: n / total[g] for b, k, n in histogram if k == g} for g in total}
    error, errors = 1.0, [(1.0, bins[0] - 1, bins[0])]  # allow from: error, last bin below, first bin above
    for b, after in zip(bins, [*bins[1:], bins[-1] + 1], strict=True):
        error += share[True].get(b, 0) - share[False].get(b, 0)
        errors.append((error, b, after))
    _, below, above = min(errors, key=lambda e: (round(e[0], 12), -(e[2] - e[1]), e[1]))
    return (below + 1 + above) / 2 * BIN


def judged_urls(
    pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row: ``key``, host, path, rule, verdict, score (higher: more like allowed URLs)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias("key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rule, ruled = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": ruled, "url": F.concat("host", "path")})
    half = F.pmod(F.xxhash64("url"), F.lit(2)).cast("int").alias("half")
    examples = rows.filter("ruled IS NOT NULL").select("url", half, (F.col("ruled") == "allow").alias("good"))

    counts = np.zeros((4, LETTERS ** (ORDER + 1)), np.int64)
    found = class_counts(examples).toArrow()
    counts[found["kind"].to_numpy(), found["gram"].to_numpy()] = found["n"].to_numpy()
    by_other_half = spark.sparkContext.broadcast([log_ratio(counts[3 - 2 * h], counts[2 - 2 * h]) for h in (0, 1)])
    final = spark.sparkContext.broadcast(log_ratio(counts[1] + counts[3], counts[0] + counts[2]))

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "url"):
            both = np.stack([scores(batch.column("url"), m) for m in by_other_half.value])
            own = both[batch.column("half").to_numpy(), np.arange(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(own / BIN).astype(np.int64)), batch.column("good")], ["bin", "good"])

    bins = examples.mapInArrow(held_out, "bin long, good boolean").groupBy("bin", "good").count()
    least = threshold([tuple(r) for r in bins.collect()])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "url"):
            yield batch.append_column("score", pa.array(scores(batch.column("url"), final.value), pa.float64()))

    kind = pages.schema[key].dataType.simpleString()
    scored = rows.mapInArrow(score, f"key {kind}, host string, path string, rule string, ruled string, url string, score double")
    by_score = F.when(F.col("score") >= least, "allow").otherwise("block")
    return scored.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages"))
