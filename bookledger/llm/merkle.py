"""Merkle manifest of a table, labelled with nested intervals of leaf ranks; on built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookledger.llm.common import Scratch, ascii_lower, partitions, spread_lookup

#: So many consecutive nodes become one node of the next level.
FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "array<struct<left:string,right:string>>"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def field_code(value: Column) -> Column:
    """``-`` for null, else the value's bytes in UTF-8: their count, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return sha256(F.concat(*(field_code(f) for f in fields)))


def tampered(doc_id: Column) -> Column:
    """Rows whose text the check changes: 5 divides the crc32 of the id as text; never a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _ranked(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``rows`` kept with ``lo``, their place in ``order`` over the whole table, from 0 on.

    Rows are range-partitioned and sorted within partitions; a row's place is its partition's first
    place plus its place there. No key has to fit into one task: equal rows are cut apart, too, by a
    number that they get where they are read.
    """
    parts = partitions(rows.sparkSession)
    numbered = rows.withColumn("_cut", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(parts, *order, "_cut").sortWithinPartitions(*order, "_cut").drop("_cut")
    # The upper bits of this id are the partition, the lower 33 count its rows in their order.
    placed = scratch.keep(dealt.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # A row a partition.
    firsts = sizes.withColumn("_first", F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows"))
    mask = F.lit(2**33 - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(scratch.keep(firsts.drop("_rows"))), "_part")
        .withColumn("lo", F.col("_first") + F.col("_place").bitwiseAND(mask))
        .drop("_part", "_first", "_place")
    )


def _families(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes of one level grouped below their parents, which cover ``width`` leaves of their tree each.

    nodes: ``tree, start, size, lo, hi, digest`` and ``extra``. A family has at most ``FAN_OUT`` members,
    in order; ``lo`` and ``hi`` label the parent, ``digest`` is its own.
    """
    bucket = F.floor((F.col("lo") - F.col("start")) / F.lit(width)).cast("long")
    return (
        nodes.groupBy("tree", "start", "size", bucket.alias("bucket"))
        .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", "extra"))).alias("members"))
        .withColumn("digest", sha256(F.array_join("members.digest", "")))
        .withColumn("lo", F.element_at("members.lo", 1))
        .withColumn("hi", F.element_at("members.hi", -1))
    )


def _grow(leaves: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The families of every level of all trees, lowest first, and the trees' roots.

    leaves: ``tree, start, size, lo, hi, digest, extra``; size counts a tree's leaves. A tree of one leaf has
    that leaf as its root and no family.
    """
    most = leaves.agg(F.max("size")).first()[0] or 0
    levels, roots, width = [], [], 1
    nodes = leaves
    plain = ["tree", "start", "size", "lo", "hi", "digest"]
    while True:
        roots.append(nodes.where(F.col("size") <= width).select(*plain))
        if most <= width:
            break
        families = scratch.keep(_families(nodes.where(F.col("size") > width), width * FAN_OUT))
        levels.append(families)
        nodes = families.select(*plain, F.lit(None).cast("string").alias("extra"))
        width *= FAN_OUT
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return levels, out


def _with_paths(families: DataFrame, above: DataFrame) -> DataFrame:
    """The members of families, with ``path``: left and right siblings on each level from their own up.

    above: ``tree, bucket, top_lo, top_hi, subroot, path`` of the level's parents. The parent's interval contains the
    family's. What the parent's interval holds before and after a member's own are its siblings.
    """
    contained = (F.col("top_lo") <= F.col("lo")) & (F.col("hi") <= F.col("top_hi"))
    rows = (
        families.withColumnRenamed("digest", "parent")
        .join(above.withColumnsRenamed({"tree": "_tree", "bucket": "_bucket"}),
              (F.col("tree") == F.col("_tree")) & (F.col("bucket") == F.col("_bucket")) & contained)
        .select("tree", "start", "size", "members", "subroot", "path", "top_lo", "top_hi", F.explode("members").alias("own"))
    )
    left = F.filter("members", lambda m: (m["lo"] >= F.col("top_lo")) & (m["hi"] <= F.col("own.lo")))
    right = F.filter("members", lambda m: (m["lo"] >= F.col("own.hi")) & (m["hi"] <= F.col("top_hi")))
    step = F.struct(
        F.array_join(F.transform(left, lambda m: m["digest"]), "").alias("left"),
        F.array_join(F.transform(right, lambda m: m["digest"]), "").alias("right"),
    )
    return rows.select(
        "tree", "start", "size", "own.lo", "own.hi", "own.digest", "own.extra", "subroot",
        F.concat(F.array(step), "path").cast(STEP).alias("path"),
    )


def _descend(levels: list[DataFrame], roots: DataFrame) -> list[DataFrame]:
    """Paths of the leaves of all trees, by the level of their roots; roots: ``tree, start, size, lo, hi, subroot, path``."""
    whole = ["tree", "start", "size", "lo", "hi", "subroot", "path"]
    width = FAN_OUT ** len(levels)
    nodes = roots.where(F.col("size") > width // FAN_OUT).select(*whole)
    for families in reversed(levels):
        bucket = F.floor((F.col("lo") - F.col("start")) / F.lit(width)).cast("long")
        above = nodes.select(
            "tree", bucket.alias("bucket"), F.col("lo").alias("top_lo"), F.col("hi").alias("top_hi"),
            "subroot", "path",
        )
        members = _with_paths(families, above)
        width //= FAN_OUT
        # Trees whose root stands on the members' level join here.
        own = roots.where((F.col("size") <= width) & (F.col("size") > width // FAN_OUT))
        nodes = members.select(*whole).unionByName(own.select(*whole)) if width > 1 else members
    return nodes


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda known, s: sha256(F.concat(s["left"], known, s["right"])))


def proof(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, tampered_leaf, path, lo`` of every row.

    fields: the columns whose codes a leaf's digest covers, of which the last is the text; ``doc_id`` and
    ``source`` are needed besides. Leaves of a source ascend by ``doc_id``, null first; rows with equal ids
    ascend by leaf, and rows that are equal in all fields have equal leaves, so any order of them gives the
    same result. Every 16 consecutive nodes become one until a single one, the subroot, is left; the subroots, ordered
    by source, null first, become the root in the same way. ``lo`` is the leaf's rank over all
    sources. Every node is labelled with the interval of ranks that it covers; parents are attached to families
    by containment among the nodes of a level, and a path's siblings are the rest of the parent's interval.

    ``path`` lists the digests left and right of a node on each level, from the leaf to the root.
    ``tampered_leaf`` is the leaf with the text's A-Z in lower case, where ``tampered`` says so, else the leaf.
    Nulls in any field are fields of their own, unlike empty texts; an empty table gives no rows; other columns
    are ignored. A source of any size is spread: ranks come from range partitions, families have 16 members.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    columns = [F.col(c) for c in fields]
    text = F.col(fields[-1]).cast("string")
    # A key that is never null and sorts like the source, null first.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    leaves = docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(columns).alias("digest"),
        F.when(tampered(F.col("doc_id")), leaf_digest([*columns[:-1], ascii_lower(text)])).alias("other"),
    )
    ranked = _ranked(leaves, ["tree", "doc_id", "digest"], scratch)
    trees = scratch.keep(
        ranked.groupBy("tree").agg(F.min("lo").alias("start"), F.count(F.lit(1)).alias("size"))
    )
    extra = F.struct("doc_id", "other").alias("extra")
    known = spread_lookup(ranked, trees, "tree", "size")
    leaves = known.select("tree", "start", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest", extra)
    leaves = scratch.keep(leaves)
    levels, roots = _grow(leaves, scratch)

    # The subroots are the leaves of one more tree, in the order of their sources.
    subroots = _ranked(roots.select("tree", "digest", F.col("size").alias("own_size")), ["tree"], scratch)
    n = subroots.count()
    top_leaves = subroots.select(
        F.lit("").alias("tree"), F.lit(0).cast("long").alias("start"), F.lit(n).cast("long").alias("size"), "lo",
        (F.col("lo") + 1).alias("hi"), "digest", F.col("tree").alias("extra"),
    )
    top_levels, top_root = _grow(top_leaves, scratch)
    no_path = F.array().cast(STEP)
    if top_levels:
        top = _descend(top_levels, top_root.withColumns({"subroot": F.col("digest"), "path": no_path}))
    else:
        top = top_leaves.withColumn("path", no_path)
    above = top.select(F.col("extra").alias("tree"), F.col("digest").alias("subroot"), "path")
    placed = scratch.keep(roots.join(above, "tree"))
    root = (top_root.first() or {"digest": None})["digest"]

    known = ["tree", "lo", "digest", "extra", "subroot", "path"]
    lone = leaves.where(F.col("size") == 1).join(placed.select("tree", "subroot", "path"), "tree").select(*known)
    members = _descend(levels, placed).select(*known).unionByName(lone) if levels else lone
    return members.select(
        F.col("extra.doc_id").alias("doc_id"),
        F.when(F.col("tree") != "-", F.substring("tree", 2, 2**31 - 1)).alias("source"),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        F.coalesce("extra.other", "digest").alias("tampered_leaf"),
        "path",
        "lo",
    )


def verified(manifest: DataFrame) -> DataFrame:
    """The manifest with digests of the proofs, and the roots that the tampered leaves fold to."""
    folded = fold(F.col("tampered_leaf"), F.col("path"))
    return manifest.select(
        "doc_id", "leaf", "subroot", "root", sha256(proof(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
