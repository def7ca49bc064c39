"""The corpus pipeline: five stages over ``documents``, each on what the one before has kept.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs`` unchanged, for the
documents they keep; the last returns a row for each document it is given. Nulls, empty and long
texts and empty tables are handled as the operators' docstrings say. A document is a row: each filter
decides by a row key, so null and repeated ids are filtered like any other, and of rows that are equal
in id and text the dedup stages leave one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookledger.llm.bpe import encode_decode, encoding_digests
from bookledger.llm.common import keep, shared_folder, small, table
from bookledger.llm.decontaminate import contamination
from bookledger.llm.exact_dedup import exact_groups
from bookledger.llm.quality import quality_scores
from bookledger.llm.queries import tokenizer_path
from bookledger.llm.simhash import near_duplicates
from bookledger.sources.sinks import remove_folder


def _free(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has; Spark doesn't tell upper from lower case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with row keys that are the same each time they are read, and the column's name.

    Rows of stored files are known by file and place in it, however the files are cut among tasks. Their numbers
    come from the list of files, a row each, for which no column is read. Anything else is stored with keys first.
    """
    key, file, place, number = (_free(n, docs.columns) for n in ("row_key", "row_file", "row_place", "file_number"))
    try:
        where = docs.metadataColumn("_metadata")
        path = where.getField("file_path").alias(file)
        files = docs.select(path).distinct()
        placed = docs.select("*", path, where.getField("row_index").alias(place))
    except AnalysisException:
        return keep(docs.withColumn(key, F.monotonically_increasing_id())), key
    numbers = keep(files.withColumn(number, F.row_number().over(Window.orderBy(file)).cast("long")))
    # A row's place in its file takes the lower 40 bits.
    row = F.shiftleft(number, 40) + F.col(place)
    return placed.join(small(numbers), file).select(*(docs[f"`{c}`"] for c in docs.columns), row.alias(key)), key


def _without(numbered: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``numbered`` whose key is not among ``row_id`` of ``dropped``, without the key."""
    gone = _free("dropped_row", numbered.columns)
    rows = keep(dropped.select(F.col("row_id").alias(gone)))
    return numbered.join(small(rows), numbered[key] == rows[gone], "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    docs, key = _numbered(docs)
    scores = quality_scores(docs, table(spark, sf_dir, "labels"), row_id=key)
    return _without(docs, key, scores.where("predicted = 0"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    docs, key = _numbered(docs)
    return _without(docs, key, exact_groups(docs, row_id=key).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document that names its component, of each component of near-duplicates."""
    docs, key = _numbered(docs)
    return _without(docs, key, near_duplicates(docs, row_id=key).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain too much of a benchmark."""
    docs, key = _numbered(docs)
    found = contamination(docs, table(spark, sf_dir, "benchmark"), row_id=key)
    return _without(docs, key, found.where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return encoding_digests(encode_decode(docs, tokenizer_path()))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: The rule ensemble, SimHash components and BPE have no SQL form; the stages are tested one by one
#: against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again as the next one's documents.

    A stage's documents are removed when the next stage's are complete.
    """
    folder = shared_folder(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
