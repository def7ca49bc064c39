"""Line labelling: base counts against a plain version, Viterbi against all label sequences, verdicts against labels."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from bookledger.llm.line_labels import (
    FEATURES,
    SEQUENCES,
    fit_lines,
    labelled,
    line_features,
    line_model,
    line_quality,
    lines_of,
)
from bookledger.llm.queries import op13_quality_rules
from tests.llm import brute

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def best_sequence(model, scores):
    """Of all sequences the best; of equal ones the one with boilerplate at the last place where they differ."""

    def total(labels):
        value = model.first[labels[0]] + labels[0] * scores[0]
        for i in range(1, len(labels)):
            value = value + model.pairs[labels[i - 1], labels[i]] + labels[i] * scores[i]
        return value

    return max(itertools.product((0, 1), repeat=len(scores)), key=total)


def plain_verdict(text, model):
    placed = list(lines_of(text or ""))
    chars = lambda line: sum(c not in " \t\n\x0b\f\r" for c in line)
    content, kept = [], 0
    if placed:
        scores = [sum(f * w for f, w in zip(line_features(line, again), model.weights.tolist(), strict=True)) for _, line, again in placed]
        # Forward by dictionaries of best predecessors.
        best = {label: (model.first[label] + label * scores[0], (label,)) for label in (0, 1)}
        for score in scores[1:]:
            best = {
                label: max((best[b][0] + model.pairs[b, label] + label * score, best[b][1] + (label,)) for b in (0, 1))
                for label in (0, 1)
            }
        labels = max(best.values())[1]
        content = [p for p, label in zip(placed, labels, strict=True) if label]
        kept = sum(chars(line) for _, line, _ in content)
    whole = chars(text or "")
    return len(content), kept, whole > 0 and kept / whole >= 0.5


def test_query_equals_plain_version_on_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = op13_quality_rules(spark, SMALL).collect()
    assert Counter(tuple(r[c] for c in BASE) for r in found) == Counter(brute.base_quality(map(tuple, docs)))
    model = line_model()
    expected = {i: plain_verdict(t, model)[2] for i, t in docs}
    for r in found:
        assert r["kept"] == (not r["base_failed"] and expected[r["doc_id"]]), r


def test_hard_rows(spark, documents):
    words = [f"w{i}" for i in range(40)]
    eight = " ".join(words[:8])
    rows = [
        (1, None), (2, ""), (3, " \n\t\x0b\n"), (4, "a b   c\x1cd"), (None, "A sentence here. " * 9), (5, "x\r\ny\r\nx\r\n x"),
        (6, " ".join(words)), (7, f"{eight} {eight}"), (8, f"{eight} mid {eight} {' '.join(words)}"), (9, "a " * 50),
        (9, "a " * 50), (10, "line one is here\n" * 30), (11, "#*$%&|<> \U0001f600 " * 8), (12, "word " * 300_000),
        (13, "\n".join(f"Line {i} goes on. And on, too." for i in range(50_000))), (14, " ".join(words[:19])), (15, " ".join(words[:20])),
        (16, f"{eight} {words[9]} {eight[:-1]}"),
    ]
    found = line_quality(documents(rows))
    assert Counter(tuple(r) for r in found.select(*BASE).collect()) == Counter(brute.base_quality(rows))
    assert line_quality(documents(rows).where("false")).collect() == []


def test_spans_cover_the_content(spark, documents):
    text = SEQUENCES[1].replace("\n- ", "\n").replace("\n+ ", "\n").strip("\n") + "\n\n  \n"
    row = line_quality(documents([(1, text)])).first()
    shown = [text[s["start"] : s["end"]] for s in row["content"]]
    assert shown == ["\n".join(line for line in text.split("\n") if "bridges" in line or "younger" in line)]
    assert row["content_chars"] == sum(not c.isspace() for c in shown[0])
    assert row["n_lines"] == 5


def test_threshold_of_the_share(spark, documents):
    text = "This is content, and it goes on for a while. It has two sentences, and some commas.\n" + "A | b | c | d\nE | f | g | h\n"
    share = line_quality(documents([(1, text)])).first()["content_share"]
    assert 0.5 < share < 1
    assert line_quality(documents([(1, text)]), min_content=share).first()["kept"]
    assert not line_quality(documents([(1, text)]), min_content=share + 0.01).first()["kept"]


def test_viterbi_finds_the_best_sequence():
    rng = random.Random(3)
    model = line_model()
    for _ in range(200):
        scores = [rng.uniform(-3, 3) for _ in range(rng.randrange(1, 9))]
        assert tuple(model.viterbi(scores)) == best_sequence(model, scores)
    assert model.viterbi([]) == []


def test_neighbours_decide():
    """The same line is content among content and boilerplate among boilerplate."""
    model = line_model()
    weak = 0.3
    assert model.viterbi([3.0, weak, 3.0])[1] == 1
    assert model.viterbi([-3.0, weak, -3.0])[1] == 0


def test_model_fits_and_likelihood_has_right_gradient():
    model = line_model()
    for sequence in SEQUENCES:
        x, y = labelled(sequence)
        assert x.shape[1] == len(FEATURES)
        assert (np.array(model.viterbi(model.scores(x).tolist())) == y).mean() >= 0.75
    # One feature that decides: the fit puts the greatest weight on it.
    rng = np.random.default_rng(0)
    made = []
    for _ in range(20):
        y = rng.integers(0, 2, 6)
        made.append((np.stack([y * 1.0, rng.integers(0, 2, 6) * 1.0], axis=1), y))
    fitted = fit_lines(made, steps=60)
    assert fitted.weights[0] > 1 > abs(fitted.weights[1])


@pytest.mark.parametrize("quality, least", [(1, 0.98), (0, 0.9)])
def test_verdict_agrees_with_labels_it_never_saw(spark, quality, least):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").where(f"quality = {quality}")
    judged = op13_quality_rules(spark, MIDDLE).join(labels, "doc_id").where("not base_failed")
    kept = [r["kept"] for r in judged.select("kept").collect()]
    assert len(kept) >= 10 and sum(k == bool(quality) for k in kept) >= least * len(kept)
