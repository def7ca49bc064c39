"""Quality classifier: a sparse ensemble of rules over text statistics."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookledger.llm.common import keep

#: The model learns from at most so many labelled rows, those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 24, 4, 64
#: Strength of the lasso penalty.
PENALTY = 0.002

STATISTICS = (
    "log_bytes",
    "upper",
    "lower",
    "digit",
    "white",
    "newline",
    "stop",
    "comma",
    "exclamation",
    "bar",
    "symbol",
    "other_punctuation",
    "non_ascii",
    "word_length",
    "longest_word",
    "distinct_words",
    "top_word",
    "repeated_neighbours",
    "sentence_ends",
    "words_a_line",
    "distinct_lines",
    "words_with_symbols",
    "upper_words",
    "log_words",
)


def _mask(characters: bytes) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(characters)] = 1
    return mask


CLASSES = np.stack(
    [
        _mask(bytes(range(65, 91))),
        _mask(bytes(range(97, 123))),
        _mask(b"0123456789"),
        _mask(b" \t\n\x0b\f\r"),
        _mask(b"\n"),
        _mask(b"."),
        _mask(b","),
        _mask(b"!"),
        _mask(b"|"),
        _mask(b"#$%&*@^~<>{}[]\\_="),
        _mask(b"\"'()+-/:;?`"),
        _mask(bytes(range(128, 256))),
    ]
)
SYMBOLS = re.compile(r"[#$%&*@^~|<>{}\[\]\\=]")


def statistics(text: str) -> list[float]:
    """``STATISTICS`` of a whole text; shares unless they say otherwise. An empty text has zeros."""
    data = text.encode()
    if not data:
        return [0.0] * len(STATISTICS)
    histogram = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    shares = (CLASSES @ histogram / len(data)).tolist()
    words = text.split()
    n = max(1, len(words))
    lengths = list(map(len, words)) or [0]
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        float(np.log1p(len(data))),
        *shares,
        sum(lengths) / n,
        float(max(lengths)),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(w[-1] in ".!?" for w in words) / n,
        n / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)),
        len(SYMBOLS.findall(text)) / n,
        sum(map(str.isupper, words)) / n,
        float(np.log1p(len(words))),
    ]


def with_statistics(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row_id: str | None = None
) -> DataFrame:
    """``doc_id`` and a double column for each statistic, for every row; null texts count as empty.

    A column of row keys may be named, which is passed on as ``row_id``.
    """
    ids = ["doc_id"] + (["row_id"] if row_id else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py() or "") for t in batch.column(1)]
            values = np.array(rows, dtype=np.float64).reshape(len(rows), len(STATISTICS))
            columns = [pa.array(values[:, i]) for i in range(len(STATISTICS))]
            kept = [batch.column(0), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*ids, *STATISTICS])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *([F.col(row_id).cast("long").alias("row_id")] if row_id else []),
    )
    return rows.mapInArrow(run, ", ".join([*(f"{i} long" for i in ids), *(f"{s} double" for s in STATISTICS)]))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text is 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    border: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > F.lit(self.border) if self.above else value <= F.lit(self.border)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(Column.__and__, (c.column() for c in self.conditions))


@dataclass(frozen=True)
class RuleModel:
    """A logistic model over rules; ``score`` compiles it into one column expression."""

    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        terms = (F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.weighted)
        total = reduce(Column.__add__, terms, F.lit(float(self.intercept)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tightest(path: tuple[Condition, ...]) -> Rule:
    """Borders on one statistic are merged, so a rule has at most two conditions on each."""
    kept: dict[tuple[str, bool], Condition] = {}
    for c in path:
        known = kept.get((c.statistic, c.above))
        if known is None or (c.border > known.border) == c.above:
            kept[c.statistic, c.above] = c
    return Rule(tuple(sorted(kept.values(), key=lambda c: (c.statistic, c.above, c.border))))


def tree_rules(values: np.ndarray, labels: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> list[Rule]:
    """The paths of a tree that is grown on a bootstrap sample: every node below the root is a rule.

    Nodes split by Gini impurity at quantiles, each looking at some of the statistics.
    """
    n, width = values.shape
    least, tried = max(2, n // 1000), max(1, round(width**0.5))
    borders = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(borders[f], values[:, f]) for f in range(width)], axis=1)
    rules: list[Rule] = []

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        own = labels[rows]
        if len(path) == depth or len(rows) < 2 * least or own.min() == own.max():
            return
        best = None
        for f in sorted(rng.choice(width, tried, replace=False)):
            size = np.cumsum(np.bincount(bins[rows, f], minlength=len(borders[f]) + 1))[:-1]
            ones = np.cumsum(np.bincount(bins[rows, f], weights=own, minlength=len(borders[f]) + 1))[:-1]
            rest, rest_ones = len(rows) - size, own.sum() - ones
            fits = (size >= least) & (rest >= least)
            if fits.any():
                size, rest = np.maximum(size, 1), np.maximum(rest, 1)
                impurity = ones * (size - ones) / size + rest_ones * (rest - rest_ones) / rest
                at = int(np.argmin(np.where(fits, impurity, np.inf)))
                if best is None or impurity[at] < best[0] - 1e-9:
                    best = (impurity[at], f, at)
        if best is None:
            return
        _, f, at = best
        low = bins[rows, f] <= at
        for above, side in ((False, rows[low]), (True, rows[~low])):
            further = (*path, Condition(STATISTICS[f], above, float(borders[f][at])))
            rules.append(_tightest(further))
            grow(side, further)

    grow(rng.integers(0, n, n), ())
    return rules


def lasso_logistic(fired: np.ndarray, labels: np.ndarray, penalty: float, rounds: int = 250) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise the mean logistic loss plus ``penalty`` times the weights' sum of sizes.

    Accelerated proximal gradient steps; the intercept isn't penalised.
    """
    n, width = fired.shape
    x = np.concatenate([np.ones((n, 1), dtype=np.float32), fired.astype(np.float32)], axis=1)
    direction = np.ones(width + 1, dtype=np.float32)
    for _ in range(20):
        direction = x.T @ (x @ direction)
        direction /= np.linalg.norm(direction)
    step = 4 * n / float(np.linalg.norm(x @ direction) ** 2) / 1.05
    weights = ahead = np.zeros(width + 1)
    pace = 1.0
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-np.clip(x @ ahead.astype(np.float32), -30, 30))) - labels
        moved = ahead - step * (x.T @ miss.astype(np.float32)) / n
        shrunk = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        shrunk[0] = moved[0]
        next_pace = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = shrunk + (pace - 1) / next_pace * (shrunk - weights)
        weights, pace = shrunk, next_pace
    return float(weights[0]), weights[1:]


def fit(sample: DataFrame, seed: int = 7) -> RuleModel:
    """Trees propose rules, a lasso logistic regression weighs them, rules of weight 0 go.

    sample: ``doc_id``, statistics and ``label`` (0 or 1) of a bounded number of rows, which come to the
    driver. Without rows of both labels the model is a constant: the share of label 1, or one half.
    """
    rows = sample.select("doc_id", "label", *STATISTICS).toArrow().sort_by("doc_id")
    labels = rows["label"].to_numpy().astype(np.float64)
    n, ones = len(labels), float(labels.sum())
    if not 0 < ones < n:
        share = ones / n if n else 0.5
        return RuleModel(float(np.log((share + 1e-3) / (1 - share + 1e-3))), ())
    values = np.column_stack([rows[s].to_numpy() for s in STATISTICS])
    rng = np.random.default_rng(seed)
    rules = list(dict.fromkeys(rule for _ in range(TREES) for rule in tree_rules(values, labels, rng)))
    if not rules:
        return RuleModel(float(np.log(ones / (n - ones))), ())
    place = {name: i for i, name in enumerate(STATISTICS)}

    def fires(rule: Rule) -> np.ndarray:
        holds = np.ones(n, dtype=bool)
        for c in rule.conditions:
            value = values[:, place[c.statistic]]
            holds &= value > c.border if c.above else value <= c.border
        return holds

    intercept, weights = lasso_logistic(np.column_stack([fires(r) for r in rules]), labels, PENALTY)
    found = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w]
    return RuleModel(intercept, tuple(found))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and ``label`` of at most ``rows`` labelled documents outside the held-out fold.

    A label's ids are broadcast: no more than ``rows``, whatever the tables' size. Labels that are null or
    not 0 or 1 are left out; repeated labels of a document count once, with their maximum.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    ids = F.broadcast(keep(chosen))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids.select("doc_id"), "doc_id", "left_semi")
    return with_statistics(own).join(ids, "doc_id").dropDuplicates(["doc_id"])


def quality_scores(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, row_id: str | None = None
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; ``row_id`` too, if row keys are named.

    score: how likely label 1 is, from 0 to 1, by the rules that ``fit`` finds in at most ``rows``
    labelled rows. The inputs are statistics of the whole text only. Null texts count as empty
    and have a score like any; a null id is not held out; repeated rows give repeated results; an
    empty table gives no rows; other columns are ignored.
    """
    model = fit(training_sample(docs, labels, rows))
    score = model.score()
    scored = with_statistics(docs, row_id=row_id).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), *(["row_id"] if row_id else [])
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
