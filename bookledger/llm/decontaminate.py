"""Benchmark decontamination by a positional inverted index, on built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookledger.llm.common import ascii_lower, keep, small

WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Stands behind the last word of every document, so that its position is the number of words.
#: No word is empty.
END = ""


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``phrase_id, terms, items``: the distinct windows, and the ids of the items that hold them.

    A window is ``window`` consecutive words; an item with fewer, but not none, is one window.
    Items without words have none; a null id is written ``null``.
    """
    listed = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("all")
    ).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - F.lit(window - 1), F.lit(1)))
    return (
        listed.withColumn("start", F.explode(starts))
        .select("item", F.expr(f"slice(all, start, {int(window)})").alias("terms"))
        .groupBy("terms")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("phrase_id", F.monotonically_increasing_id())
    )


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings ``doc_id, pos, term`` of all words, or of the words in ``terms`` (column ``term``).

    Every document also has a posting of ``END`` at its number of words, which carries what ``docs`` has as
    ``own_id``, if anything. Rows with equal id are one document.
    """
    listed = F.concat(words(F.col("text")), F.array(F.lit(END)))
    own = ["own_id"] if "own_id" in docs.columns else []
    postings = docs.select("doc_id", *own, F.posexplode(listed).alias("pos", "term"))
    if own:
        postings = postings.withColumn("own_id", F.when(F.col("term") == END, F.col("own_id")))
    return postings if terms is None else postings.join(small(terms), "term")


def _same_doc(a: str, b: str) -> Column:
    return F.expr(f"{a}.doc_id <=> {b}.doc_id")


def _agree(found: DataFrame, index: DataFrame, needs: DataFrame, slop: int) -> DataFrame:
    """The alignments in ``found`` for which all ``needs`` of their phrase have a posting.

    needs: ``phrase_id, offset, term_id``. A posting agrees if its position less its offset is
    the alignment's start, or differs from it by at most ``slop``.
    """
    wanted = found.join(needs, "phrase_id").withColumn("pos", F.col("start") + F.col("offset"))
    if slop:
        near = F.sequence(F.col("pos") - slop, F.col("pos") + slop)
        wanted = wanted.withColumn("pos", F.explode(near))
    lists = index.join(small(keep(needs.select("term_id").distinct())), "term_id", "left_semi")
    doc_ids = keep(found.select("doc_id").distinct())
    near_docs = small(doc_ids)
    if near_docs is not doc_ids:
        lists = lists.alias("l").join(near_docs.alias("d"), _same_doc("l", "d"), "left_semi")
    match = _same_doc("w", "l") & F.expr("w.pos = l.pos and w.term_id = l.term_id")
    hit = wanted.alias("w").join(lists.alias("l"), match, "left_semi").select("w.*")
    if slop:
        hit = hit.dropDuplicates(["doc_id", "start", "phrase_id", "offset"])
    counted = hit.groupBy("doc_id", "start", "phrase_id").agg(F.count(F.lit(1)).alias("n_found"))
    expected = needs.groupBy("phrase_id").agg(F.count(F.lit(1)).alias("n_needs"))
    agreed = counted.join(expected, "phrase_id").where(F.col("n_found") == F.col("n_needs"))
    # Phrases without needs agree by themselves.
    free = found.join(expected, "phrase_id", "left_anti")
    return agreed.select("doc_id", "start", "phrase_id").unionByName(free)


def occurrences(index: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """``doc_id, start, phrase_id`` of all phrase matches, or proximity matches if ``slop`` > 0.

    index: ``doc_id, pos, term_id``; terms: ``phrase_id, offset, term_id`` of the phrases. Each
    phrase starts from the postings of its rarest term. The next two terms, by rarity, cut these down
    before the frequent rest is read. A proximity match has every term at most ``slop`` words from
    its place, seen from the rarest.
    """
    counts = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("phrase_id").orderBy("n", "offset")
    ranked = terms.join(counts, "term_id", "left").withColumn("rank", F.row_number().over(order))
    alive = F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("phrase_id")) > 0
    ranked = keep(ranked.withColumn("alive", alive).where("alive").select("phrase_id", "offset", "term_id", "rank"))

    anchors = ranked.where(F.col("rank") == 1).select("phrase_id", "offset", "term_id")
    found = index.join(small(anchors), "term_id").select(
        "doc_id", (F.col("pos") - F.col("offset")).alias("start"), "phrase_id"
    )
    if not slop:
        found = found.where(F.col("start") >= 0)
    found = keep(found.distinct())
    for needs in (ranked.where(F.col("rank").between(2, 3)), ranked.where(F.col("rank") > 3)):
        found = keep(_agree(found, index, needs.select("phrase_id", "offset", "term_id"), slop))
    return found


#: How far a word may stand from its place in a proximity match.
SLOP = 2


def _per_document(found: DataFrame, listed: DataFrame) -> DataFrame:
    """``doc_id, items``: the sorted ids of the items that the phrases found in a document belong to."""
    return (
        found.select("doc_id", "phrase_id").distinct()
        .join(listed.select("phrase_id", F.explode("items").alias("item")), "phrase_id")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, row_id: str | None = None, slop: int = 0
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document row.

    With ``slop``, ``n_near`` and ``near_items`` tell how many items, and which, have a window whose words all
    stand at most so far from their places, exact occurrences included. If a column of row keys is named, it
    is passed on as ``row_id``.

    A word inside any occurrence of an item's window is hit; a document is contaminated if at least
    one word in twenty is. Null texts have no words; a row is a document, whether or not its id is null or
    occurs elsewhere; empty tables give no rows or no hits; other columns are ignored.

    The index holds the postings of the items' words only, is written once, and everything
    else is read from it. Its rows are told apart by document and position, so no word, however
    frequent, is a key of its own.
    """
    listed = keep(phrases(items, window))
    spelled = listed.select("phrase_id", F.posexplode("terms").alias("offset", "term"))
    vocabulary = keep(
        spelled.select("term").distinct().select("term", F.monotonically_increasing_id().alias("term_id"))
        .unionByName(docs.sparkSession.range(1).select(F.lit(END).alias("term"), F.lit(-1).cast("long").alias("term_id")))
    )
    # Words of rows with null or equal ids don't mix: the index knows rows, and their ids only at their ends.
    row = F.col(row_id).cast("long") if row_id else F.monotonically_increasing_id()
    known = docs.select(F.col("doc_id").alias("own_id"), row.alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = keep(build_index(known, vocabulary).select("doc_id", "own_id", "pos", "term_id"))
    terms = spelled.join(vocabulary, "term").select("phrase_id", "offset", "term_id")
    postings = index.where(F.col("term_id") >= 0).drop("own_id")
    found = occurrences(postings, terms)

    held = found.join(listed.select("phrase_id", F.size("terms").alias("n")), "phrase_id")
    before = Window.partitionBy("doc_id").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.col("start")))
    hits = (
        held.withColumn("new", F.greatest(end - covered, F.lit(0)))
        .groupBy("doc_id")
        .agg(F.sum("new").alias("n_hit"))
    )
    ends = index.where(F.col("term_id") < 0).select("doc_id", "own_id", F.col("pos").cast("long").alias("n_words"))
    out = ends.join(hits, "doc_id", "left").join(_per_document(found, listed), "doc_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    no_items = F.array().cast("array<string>")
    item_ids = F.coalesce("items", no_items)
    near = []
    if slop:
        close = _per_document(occurrences(postings, terms, slop), listed).withColumnRenamed("items", "near")
        out = out.join(close, "doc_id", "left")
        near_ids = F.coalesce("near", no_items)
        near = [F.size(near_ids).cast("long").alias("n_near"), F.concat_ws(",", near_ids).alias("near_items")]
    return out.select(
        F.col("own_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", item_ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
        *near,
        *([F.col("doc_id").alias("row_id")] if row_id else []),
    )
