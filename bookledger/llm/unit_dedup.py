"""Substring deduplication: units, and passages made of units, that occur earlier in the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookledger.llm.common import keep, spread_lookup

#: Where units end. Passages are often set into the middle of a line, and clauses find them there.
UNITS = {
    "paragraph": re.compile(r"(?:(?!\n[^\S\n]*\n).)+", re.S),
    "line": re.compile(r"[^\n]+"),
    "clause": re.compile(r"[^\n.,;:!?]+"),
}
#: A run of repeated clauses is a passage if it has so many words; shorter ones are common phrases.
MIN_WORDS = 20


def units(text: str, kind: str = "clause") -> Iterator[tuple[int, int, str, int]]:
    """(start, end, normalised, words) of each unit with words: lower case, single spaces."""
    for found in UNITS[kind].finditer(text):
        raw = found[0]
        words = raw.lower().split()
        if words:
            start = found.start() + len(raw) - len(raw.lstrip())
            yield start, start + len(raw.strip()), " ".join(words), len(words)


#: Stands for the place of a document that has no id: behind all others.
LAST = 2**63 - 1
PLACES = ("place", "span")


def _packed(high: int, low: int) -> int:
    """Two numbers of 31 bits as one long: rows of units are shuffled, and each field takes eight bytes."""
    return high << 32 | low


def _high(packed: Column) -> Column:
    return F.shiftright(packed, 32)


def _low(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(2**32 - 1))


def _words(place: Column) -> Column:
    return F.shiftright(_low(place), 1)


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``own, doc, text``: what tells documents apart, their rank, and the text.

    ``own`` is a digest of id and text, so every scan gives it again; rows that share an id, or have none, differ in it
    unless their texts are equal too.
    """
    number, content = F.col(doc_id).cast("long"), F.col(text).cast("string")
    return docs.select(
        F.xxhash64(number, content).alias("own"), F.coalesce(number, F.lit(LAST)).alias("doc"), content.alias("text")
    )


def _hashed(rows: DataFrame, kind: str, places: bool, owners: tuple[str, ...] = ("own", "doc"), empty: bool = False) -> DataFrame:
    """``owners, h1, h2`` of every unit, with ``place, span`` if places are wanted.

    h1 and h2 are a digest of 128 bits. ``place`` packs the unit's number in the document over twice its words; the
    last bit marks all but the first of the document's equal units. ``span`` packs start over end. With ``empty``,
    every document also has a row of its own, whose number is -1.
    """
    names = [*owners, "h1", "h2", *(PLACES if places else ())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *keys, texts = batch.columns
            at, digests, placed = [], [], []

            def flush() -> pa.RecordBatch:
                halves = np.frombuffer(b"".join(digests), dtype=">i8").astype("<i8").reshape(-1, 2)
                taken = pa.array(at, pa.int64())
                columns = [k.take(taken) for k in keys]
                columns += [pa.array(halves[:, 0]), pa.array(halves[:, 1])]
                if places:
                    values = np.array(placed, dtype=np.int64).reshape(-1, 2)
                    columns += [pa.array(values[:, 0]), pa.array(values[:, 1])]
                for kept in (at, digests, placed):
                    kept.clear()
                return pa.RecordBatch.from_arrays(columns, names=names)

            for i in range(len(texts)):
                known = set()
                if empty:
                    at.append(i)
                    digests.append(bytes(16))
                    placed.append((_packed(-1, 0), 0))
                for nth, (start, end, normal, words) in enumerate(units(texts[i].as_py() or "", kind)):
                    digest = md5(normal.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                    at.append(i)
                    digests.append(digest)
                    if places:
                        placed.append((_packed(nth, words << 1 | (digest in known)), _packed(start, end)))
                        known.add(digest)
                    if len(at) > 100_000:
                        yield flush()
            if at:
                yield flush()

    return rows.select(*owners, "text").mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _copied(hashed: DataFrame, owner: str) -> DataFrame:
    """``unit, first, first_doc, n`` of the units that occur more than once; the first is in the smallest ``doc``."""
    groups = hashed.groupBy("h1", "h2").agg(
        F.min_by(owner, "doc").alias("first"), F.min("doc").alias("first_doc"), F.count(F.lit(1)).alias("n")
    )
    return keep(groups.where("n > 1").select(F.struct("h1", "h2").alias("unit"), "first", "first_doc", "n"))


def _later(hashed: DataFrame, copied: DataFrame, owner: str, kind: str) -> DataFrame:
    """``hashed`` with ``gone``: whether the same unit occurs earlier. The key is named after the kind, as plans show it."""
    keyed = hashed.withColumn(kind, F.struct("h1", "h2"))
    met = spread_lookup(keyed, copied.withColumnRenamed("unit", kind), kind, "n").drop(kind)
    again = F.col("place").bitwiseAND(F.lit(1)) == 1
    return met.withColumn("gone", F.coalesce((F.col("first") != F.col(owner)) | again, F.lit(False)))


def _passages(docs: DataFrame, text: str, doc_id: str, kind: str, min_words: int) -> DataFrame:
    """``own, doc, start, end, n_words, n_units, first_doc`` of runs of later units."""
    rows = _rows(docs, text, doc_id)
    copied = _copied(_hashed(rows, kind, places=False), "own")
    gone = _later(_hashed(rows, kind, places=True), copied, "own", kind).where("gone").select(
        "own", "doc", "place", "span", "first_doc"
    )
    in_order = Window.partitionBy("own").orderBy("place")
    # Neighbours share nth less their place among the document's repeated units.
    return (
        # One exchange serves the copies of a row, the window and the runs.
        gone.repartition("own")
        .dropDuplicates(["own", "place"])
        .withColumn("run", _high(F.col("place")) - F.row_number().over(in_order))
        .groupBy("own", "run")
        .agg(
            F.min("doc").alias("doc"),
            F.min(_high(F.col("span"))).alias("start"),
            F.max(_low(F.col("span"))).alias("end"),
            F.sum(_words(F.col("place"))).alias("n_words"),
            F.count(F.lit(1)).alias("n_units"),
            F.min_by("first_doc", "place").alias("first_doc"),
        )
        .where(F.col("n_words") >= min_words)
    )


def _known(name: str) -> Column:
    return F.when(F.col(name) != LAST, F.col(name))


def repeated_spans(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", kind: str = "clause", min_words: int = MIN_WORDS
) -> DataFrame:
    """``doc_id, start, end, n_words, n_units, first_doc_id``: passages that occur earlier, one row each.

    Units are normalised and grouped by digest over the corpus. Of equal units the one in the
    document with the smallest id, and there the first, stays; among documents that share this id, or have none, it is
    one of theirs. Neighbouring units that don't stay form a passage, which is reported from ``min_words`` words on.
    start and end are code points of the original text, end exclusive; first_doc_id is where the passage's first unit
    stays. Documents that repeat nothing don't appear.

    Null texts have no units; a null id counts as the largest and is returned as null; rows equal in id and text are one
    document, whose repetition is not counted; an empty table gives no rows; other columns are ignored.

    Digests are combined within tasks before the shuffle, and a common unit's occurrences are dealt
    over many tasks when they meet its group again.
    """
    return _passages(docs, text, doc_id, kind, min_words).select(
        _known("doc").alias("doc_id"), "start", "end", "n_words", "n_units", _known("first_doc").alias("first_doc_id")
    )


def unit_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", kind: str = "line", passage_words: int = MIN_WORDS
) -> DataFrame:
    """One row per input row: which of its units occur earlier in the corpus, and what remains without them.

    ``doc_id, n_units, removed, kept_sha256, passages``. Of equal units the earliest stays, which is the first one of
    the document with the smallest id; every other one is removed, however short. ``removed`` lists the removed units
    as (start, end, n_words) in code points of the original text, end exclusive, in order; ``remove_spans`` cuts them
    out. ``kept_sha256`` is the digest of the remaining units' MD5 digests in hexadecimal, in order. ``passages`` lists
    (start, end, n_words, first_doc_id) of the runs of repeated clauses with at least ``passage_words`` words, which
    also lie inside units; callers that want to leave common short units alone go by them.

    Every row is a document: equal rows remove each other's units but one's. Null and empty texts have no units. A
    null id counts as the largest and is returned as null. Among rows that share an id, one of those with the unit
    keeps it. An empty table gives no rows; other columns are ignored.

    The units are stored once with a key of their row, so all steps agree on it; texts are not shuffled. Digests are
    combined before the shuffle and common units dealt over many tasks. A row's units meet in one task at the end.
    """
    rows = _rows(docs, text, doc_id).withColumn("row", F.monotonically_increasing_id())
    index = keep(_hashed(rows, kind, places=True, owners=("row", "own", "doc"), empty=True))
    found = index.where("place >= 0")
    later = _later(found, _copied(found, "row"), "row", kind).drop("first", "first_doc", "n")
    per_row = (
        index.where("place < 0")
        .withColumn("gone", F.lit(False))
        .unionByName(later)
        .groupBy("row")
        .agg(
            F.min("own").alias("own"),
            F.min("doc").alias("doc"),
            F.array_sort(F.collect_list(F.when(F.col("place") >= 0, F.struct("place", "gone", "span", "h1", "h2")))).alias("units"),
        )
    )
    runs = _passages(docs, text, doc_id, "clause", passage_words).groupBy("own").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "n_words", _known("first_doc").alias("first_doc_id")))).alias("passages")
    )
    half = lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")
    staying = F.transform(F.filter("units", lambda u: ~u["gone"]), lambda u: F.concat(half(u["h1"]), half(u["h2"])))
    leaving = F.transform(
        F.filter("units", lambda u: u["gone"]),
        lambda u: F.struct(
            _high(u["span"]).alias("start"),
            _low(u["span"]).alias("end"),
            _words(u["place"]).alias("n_words"),
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,n_words:bigint,first_doc_id:bigint>>")
    return per_row.join(runs, "own", "left").select(
        _known("doc").alias("doc_id"),
        F.size("units").cast("long").alias("n_units"),
        leaving.alias("removed"),
        F.sha2(F.array_join(staying, ""), 256).alias("kept_sha256"),
        F.coalesce("passages", none).alias("passages"),
    )


def remove_spans(docs: DataFrame, spans: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without the spans' text; ``removed`` lists what went, in original offsets.

    Spans don't overlap. The text between them stays as it is. Null texts stay null. Rows with equal ids lose the
    same spans; a column ``removed`` of the input is replaced.
    """
    per_doc = spans.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed")
    )
    joined = docs.join(per_doc, F.col(doc_id).eqNullSafe(F.col("_doc")), "left").drop("_doc")
    removed = F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    borders = F.concat(F.array(F.lit(0).cast("long")), F.col("removed.end"))
    starts = F.concat(F.col("removed.start"), F.array(F.length(text).cast("long")))
    pieces = F.zip_with(borders, starts, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    return joined.withColumn("removed", removed).withColumn(
        text, F.when(F.size("removed") > 0, F.array_join(pieces, "")).otherwise(F.col(text))
    )
