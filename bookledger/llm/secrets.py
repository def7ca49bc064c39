"""Secret scans with ownership frequency over the whole corpus, on built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookledger.llm.common import keep, spread_lookup

#: kind, pattern, group of the secret, least length of the secret. A shorter match still takes its
#: place: ``assign`` is matched first and measured then. For the other two a minimum inside
#: the pattern means the same, since a run's first match is its longest.
BASE_KINDS = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
LIVE, COPIED = "live", "copied"

#: A value that so many owners have is a copied example.
COPIED_OWNERS = 3
#: A value with fewer different characters, or with one of these words, doesn't look live.
LIVE_CHARACTERS = 6
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|xxxx|your_|your-"


def _found(text: Column) -> Column:
    """For each kind with matches: its number, the matches, their secrets, and the text between."""
    kinds = [
        F.struct(
            F.lit(number).alias("kind"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("secret"),
            F.split(text, pattern, -1).alias("before"),
        )
        for number, (_, pattern, group, _) in enumerate(BASE_KINDS)
    ]
    none = F.struct(*(F.lit(None).cast(t).alias(n) for n, t in (
        ("kind", "int"), ("match", "array<string>"), ("secret", "array<string>"), ("before", "array<string>"))))
    listed = [F.when(text.rlike(kind[1]), found).otherwise(none) for kind, found in zip(BASE_KINDS, kinds, strict=True)]
    # The first entry stands for the document itself, with or without secrets.
    return F.filter(F.array(F.struct(
        F.lit(-1).alias("kind"), F.array(F.lit("")).alias("match"), F.array(F.lit("")).alias("secret"),
        F.array(F.lit("")).alias("before")), *listed), lambda x: x["kind"].isNotNull())


def base_spans(docs: DataFrame, text: str, doc_id: str, owner: str, repository: str) -> DataFrame:
    """``row_id, doc_id, owner, repository, kind, start, end, secret``; kind -1 once for every row.

    Offsets are code points. A match starts after all text and matches before it, which
    a running sum over the row's own matches gives; the texts themselves are not shuffled.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    pieces = (
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
            content.alias("content"),
        )
        .select("row_id", "doc_id", "owner", "repository", F.explode(_found(F.col("content"))).alias("found"))
        .select(
            "row_id", "doc_id", "owner", "repository", F.col("found.kind").alias("kind"),
            F.posexplode(F.arrays_zip("found.match", "found.secret", "found.before")).alias("nth", "piece"),
        )
        # The text behind the last match is a piece without a match.
        .where(F.col("piece.match").isNotNull())
        .select(
            "row_id", "doc_id", "owner", "repository", "kind", "nth",
            (F.length("piece.before") + F.length("piece.match")).cast("long").alias("step"),
            F.length("piece.match").cast("long").alias("width"),
            F.col("piece.secret").alias("secret"),
        )
    )
    so_far = Window.partitionBy("row_id", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.array(*(F.lit(n) for *_, n in BASE_KINDS)), F.greatest(F.col("kind"), F.lit(0)) + 1)
    return (
        pieces.withColumn("end", F.sum("step").over(so_far))
        .withColumn("start", F.col("end") - F.col("width"))
        .where((F.col("kind") < 0) | (F.length("secret") >= least))
        .select("row_id", "doc_id", "owner", "repository", "kind", "start", "end", "secret")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """``secret_hash, n_spans, n_repositories, n_owners`` over the corpus.

    Distinct counts are grouped in steps, each combined before its shuffle, so a value copied
    into a third of all documents stays a few rows a task.
    """
    one = spans.groupBy("secret_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    two = one.groupBy("secret_hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("r"))
    return two.groupBy("secret_hash").agg(
        F.sum("n").alias("n_spans"), F.sum("r").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")
    )


def _written(spans: Column) -> Column:
    """``kind:start:end``, by start, then kind in the listed order."""
    names = F.array(*(F.lit(kind[0]) for kind in BASE_KINDS), F.lit(LIVE), F.lit(COPIED))
    text = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(F.array_sort(spans), text))


def secret_scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", repository: str = "doc_id"
) -> DataFrame:
    """One row per input row: base counts and spans, and how widely each secret is owned.

    A value that ``COPIED_OWNERS`` or more owners have is a copied example and gets a ``copied`` span;
    one of fewer owners that looks real gets a ``live`` span. These spans cover the secret
    itself, the base spans the whole match; base spans stay as they are. ``n_live`` and
    ``n_copied`` count them. ``live_ownership`` has ``owners:repositories`` for every live span in order, so that a value
    that one owner has in many repositories can be told from one that occurs once.

    Null texts have no secrets; a null owner or repository is one of its own; a null id is
    returned as null; repeated rows give repeated results; an empty table gives no rows; other
    columns are ignored.
    """
    spans = keep(
        base_spans(docs, text, doc_id, owner, repository).withColumn(
            "secret_hash", F.when(F.col("kind") >= 0, F.sha2("secret", 256))
        )
    )
    secrets = spans.where(F.col("kind") >= 0)
    owned = keep(ownership(secrets))
    looks_live = (F.size(F.array_distinct(F.split("secret", ""))) >= LIVE_CHARACTERS) & ~F.col("secret").rlike(PLACEHOLDER)
    added = (
        F.when(F.col("n_owners") >= COPIED_OWNERS, F.lit(len(BASE_KINDS) + 1))
        .when(looks_live, F.lit(len(BASE_KINDS)))
        .cast("int")
    )
    rated = spread_lookup(secrets.drop("owner", "repository"), owned, "secret_hash", "n_spans").withColumn("added", added)
    column = lambda kind, start, *more: F.struct(start.alias("start"), kind.alias("kind"), F.col("end").alias("end"), *more)
    per_row = rated.groupBy("row_id").agg(
        F.collect_list(column(F.col("kind"), F.col("start"))).alias("base"),
        F.collect_set(
            F.when(
                F.col("added").isNotNull(),
                column(F.col("added"), F.col("end") - F.length("secret"), F.col("n_owners"), F.col("n_repositories")),
            )
        ).alias("more"),
        *(F.count_if(F.col("kind") == i).alias(f"n_{kind[0]}") for i, kind in enumerate(BASE_KINDS)),
    )
    rows = spans.where(F.col("kind") < 0).select("row_id", "doc_id")
    no_spans = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    no_added = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,n_owners:bigint,n_repositories:bigint>>")
    base, owned_spans = F.coalesce("base", no_spans), F.array_sort(F.coalesce("more", no_added))
    more = F.transform(owned_spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    of_kind = lambda kind: F.size(F.filter(more, lambda s: s["kind"] == kind)).cast("long")
    live = F.filter(owned_spans, lambda s: s["kind"] == len(BASE_KINDS))
    ownership_of = lambda s: F.concat_ws(":", s["n_owners"].cast("string"), s["n_repositories"].cast("string"))
    return rows.join(per_row, "row_id", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{kind[0]}", F.lit(0)).cast("long").alias(f"n_{kind[0]}") for kind in BASE_KINDS),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, more)).alias("spans"),
        of_kind(len(BASE_KINDS)).alias("n_live"),
        of_kind(len(BASE_KINDS) + 1).alias("n_copied"),
        F.array_join(F.transform(live, ownership_of), ",").alias("live_ownership"),
    )
