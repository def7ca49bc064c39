"""Quality rules: a linear-chain conditional random field marks a text's lines as content or boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger.llm.line_training import SEQUENCES

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEATED_PERCENT = 8, 20, 30
#: A text whose lines of content hold a smaller share of its word characters is not kept.
MIN_CONTENT = 0.5
WHITE_SPACE = " \t\n\x0b\f\r"

FEATURES = (
    "bias",
    "up to 3 words",
    "4 to 7 words",
    "8 words or more",
    "ends a sentence",
    "ends a sentence, 8 words or more",
    "some symbols",
    "many symbols",
    "some bars",
    "many bars",
    "some exclamation marks",
    "many exclamation marks",
    "upper case",
    "digits",
    "words repeat",
    "neighbours repeat",
    "sentences or clauses",
    "no punctuation",
    "notice words, up to 20 words",
    "link",
    "equals an earlier line",
)
NOTICES = (
    "license licence copyright (c) © cookie privacy newsletter subscribe imprint impressum datenschutz".split()
    + ["rights reserved", "terms of", "sign up", "log in", "login", "droits réservés", "mentions légales", "aviso legal"]
)
LINKS = ("http://", "https://", "www.")
MARKS, DIGITS = b"#*$%&<>@^~{}[]\\=", b"0123456789"


def line_features(line: str, again: bool) -> list[float]:
    """``FEATURES`` of a line that has a word, each 0 or 1; ``again``: it equals an earlier line of its text."""
    words = line.split()
    n = len(words)
    if not n:
        # Only characters that other definitions of white space don't count.
        words, n = [line], 1
    data, lower = line.encode(), line.lower()
    symbols = (len(data) - len(data.translate(None, MARKS))) / n
    digits = len(data) - len(data.translate(None, DIGITS))
    bars, shouts = line.count("|") / n, line.count("!") / n
    ends = words[-1].rstrip("\"'”»)")[-1:] in (".", "!", "?", ":", "…")
    marks = line.count(",") + line.count(". ") + line.count(";")
    upper = sum(map(str.isupper, words)) / n
    return [
        1.0,
        n <= 3,
        4 <= n <= 7,
        n >= 8,
        ends,
        ends and n >= 8,
        symbols > 0.1,
        symbols > 0.5,
        bars > 0.1,
        bars > 0.3,
        shouts > 0.1,
        shouts > 0.5,
        upper > 0.5,
        digits > 0.2 * len(line),
        n >= 8 and len(set(words)) < 0.4 * n,
        n >= 5 and sum(map(str.__eq__, words, words[1:])) > 0.2 * n,
        marks / n > 0.03,
        n >= 8 and not marks and not ends,
        n <= 20 and any(map(lower.__contains__, NOTICES)),
        any(map(lower.__contains__, LINKS)),
        again,
    ]


@dataclass(frozen=True)
class LineModel:
    """Scores of content against boilerplate: a weight a feature, one a pair of neighbouring labels, one a first label.

    Labels are 0 (boilerplate) and 1 (content).
    """

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights

    def viterbi(self, scores: list[float]) -> list[int]:
        """The labels of the best sequence; boilerplate, where content isn't better."""
        if not scores:
            return []
        (to00, to01), (to10, to11) = self.pairs.tolist()
        boiler, content = self.first.tolist()
        content += scores[0]
        back = []
        for score in scores[1:]:
            from0, from1 = content + to10 > boiler + to00, content + to11 > boiler + to01
            back.append((from0, from1))
            boiler, content = (
                content + to10 if from0 else boiler + to00,
                (content + to11 if from1 else boiler + to01) + score,
            )
        label = int(content > boiler)
        labels = [label]
        for choice in reversed(back):
            label = int(choice[label])
            labels.append(label)
        return labels[::-1]


def _logadd(values: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp.reduce(values, axis=axis)


def fit_lines(
    sequences: list[tuple[np.ndarray, np.ndarray]], penalty: float = 0.002, steps: int = 250, pace: float = 2.0
) -> LineModel:
    """Weights of the greatest likelihood of the labels, less a square penalty, by gradient steps.

    sequences: features (line, feature) and labels. The expected counts come from forward and backward sums.
    """
    width = sequences[0][0].shape[1]
    total = sum(len(y) for _, y in sequences)
    weights, pairs, first = np.zeros(width), np.zeros((2, 2)), np.zeros(2)
    for _ in range(steps):
        g_weights, g_pairs, g_first = -penalty * weights, -penalty * pairs, -penalty * first
        for x, y in sequences:
            score = np.stack([np.zeros(len(y)), x @ weights], axis=1)
            forward, backward = np.empty_like(score), np.zeros_like(score)
            forward[0] = first + score[0]
            for t in range(1, len(y)):
                forward[t] = score[t] + _logadd(forward[t - 1][:, None] + pairs, 0)
            for t in range(len(y) - 2, -1, -1):
                backward[t] = _logadd(pairs + (score[t + 1] + backward[t + 1])[None, :], 1)
            whole = _logadd(forward[-1], 0)
            own = np.exp(forward + backward - whole)
            g_weights = g_weights + x.T @ (y - own[:, 1]) / total
            g_first = g_first + (np.eye(2)[y[0]] - own[0]) / len(sequences)
            for t in range(1, len(y)):
                both = np.exp(forward[t - 1][:, None] + pairs + (score[t] + backward[t])[None, :] - whole)
                both = -both
                both[y[t - 1], y[t]] += 1
                g_pairs = g_pairs + both / total
        weights, pairs, first = weights + pace * g_weights, pairs + pace * g_pairs, first + pace * g_first
    return LineModel(weights, pairs, first)


def lines_of(text: str) -> Iterator[tuple[int, str, bool]]:
    """(start, line, again) of the \\n-split lines with a word."""
    known, start = set(), 0
    for line in text.split("\n"):
        if line.strip(WHITE_SPACE):
            yield start, line, line in known
            known.add(line)
        start += len(line) + 1


def labelled(sequence: str) -> tuple[np.ndarray, np.ndarray]:
    marked = [line for line in sequence.split("\n") if line]
    text = "\n".join(line[2:] for line in marked)
    x = np.array([line_features(line, again) for _, line, again in lines_of(text)], dtype=np.float64)
    return x, np.array([line[0] == "+" for line in marked], dtype=np.int64)


@lru_cache
def line_model() -> LineModel:
    return fit_lines([labelled(s) for s in SEQUENCES])


def _may_repeat(words: list[bytes], window: int) -> bool:
    """Whether hashes of windows are equal, as those of equal windows are."""
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
    rolled = hashes[: len(words) - window + 1].copy()
    for i in range(1, window):
        rolled *= 0x5851F42D4C957F2D
        rolled += hashes[i : len(words) - window + 1 + i]
    rolled.sort()
    return bool((rolled[1:] == rolled[:-1]).any())


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of so many that occurs twice or more, all its occurrences included.

    Windows are told apart exactly: equal numbers stand for equal pairs, then equal fours, then equal eights.
    """
    if len(words) <= window or not _may_repeat(words, window):
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    size = 1
    while size < window:
        ids = ids[:-size] * (int(ids.max()) + 1) + ids[size:]
        ids = np.unique(ids, return_inverse=True)[1]
        size *= 2
    twice = np.bincount(ids)[ids] > 1
    # A word is inside if one of the windows that start up to window - 1 words before it is found twice.
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def text_quality(text: str, model: LineModel) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, content characters, content spans."""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, WHITE_SPACE))
    n_symbols = sum(map(text.count, SYMBOLS))
    placed = list(lines_of(text))
    n_dup_lines = sum(again for _, _, again in placed)
    content, spans = 0, []
    if placed:
        features = np.array([line_features(line, again) for _, line, again in placed], dtype=np.float64)
        last = None
        for i, label in enumerate(model.viterbi(model.scores(features).tolist())):
            if label:
                start, line, _ = placed[i]
                content += len(line) - sum(map(line.count, WHITE_SPACE))
                if last == i - 1:
                    spans[-1] = (spans[-1][0], start + len(line))
                else:
                    spans.append((start, start + len(line)))
                last = i
    return len(words), word_chars, n_symbols, n_dup_lines, repeated_words(words), len(placed), content, spans


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "content_chars")
#: Documents of one output batch.
BATCH = 500


def line_quality(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_content: float = MIN_CONTENT
) -> DataFrame:
    """``doc_id``, ``COUNTS``, ``content``, ``base_failed``, ``content_share`` and ``kept`` of every row.

    Lines are split at \\n; those without a word carry no label. A conditional random field, fitted to
    ``SEQUENCES``, gives the best sequence of labels for the lines of a whole text. ``content`` lists the
    stretches of neighbouring lines of content, as [start, end) in code points. content_share is the
    share of the word characters in lines of content, 0 without words. A text that the base rules fail
    is not kept: fewer than 20 words, or over 30 % of the words in windows of eight that the text repeats.
    Any other is kept if content_share is ``min_content`` or more.

    Null texts have no words and fail. Null and repeated ids, and repeated rows, are rows like others; an empty table gives
    no rows; other columns are ignored. A row depends on its own text only, so nothing is shuffled.
    """
    model = line_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                rows = [text_quality(t.as_py() or "", model) for t in batch.column(1)]
                columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
                spans = [[{"start": a, "end": b} for a, b in r[-1]] for r in rows]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns, pa.array(spans, kind)], names=["doc_id", *COUNTS, "content"]
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = ["doc_id long", *(f"{c} long" for c in COUNTS), "content array<struct<start:bigint,end:bigint>>"]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    share = F.when(F.col("word_chars") > 0, F.col("content_chars") / F.col("word_chars")).otherwise(F.lit(0.0))
    return (
        rows.mapInArrow(run, ", ".join(schema))
        .withColumn("base_failed", failed)
        .withColumn("content_share", share)
        .withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= min_content))
    )
