"""SimHash near-duplicates: fingerprints are linked through Golay-code keys and verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger.llm.common import keep, partitions, spread_lookup

SHINGLE = 4
MAX_BITS = 4

# ---------------------------------------------------------------- the binary Golay code [23, 12, 7]

#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011
LENGTH, CHECKS = 23, 11
#: Widths of a fingerprint's three segments; each is a Golay word whose other bits are 0.
SEGMENTS = (22, 21, 21)


def _syndrome(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


class Golay:
    """Codeword indices near a word.

    The code is perfect: every word is at most three bits from exactly one codeword. A word's
    keys are the codewords of itself and of its 23 neighbours, which are one (within two bits
    of a codeword) or six. Two words that differ in at most two bits share a key, since the
    word halfway between is the same as, or a neighbour of, both.
    """

    def __init__(self) -> None:
        of_bit = [_syndrome(1 << b) for b in range(LENGTH)]
        fix = np.zeros(1 << CHECKS, dtype=np.int64)
        for weight in range(4):
            for bits in combinations(range(LENGTH), weight):
                syndrome = 0
                for b in bits:
                    syndrome ^= of_bit[b]
                fix[syndrome] = sum(1 << b for b in bits)
        self.masks = np.zeros((1 << CHECKS, 6), dtype=np.int64)
        self.counts = np.zeros(1 << CHECKS, dtype=np.int64)
        for syndrome in range(1 << CHECKS):
            near = {int(fix[syndrome])}
            near |= {(1 << b) ^ int(fix[syndrome ^ of_bit[b]]) for b in range(LENGTH)}
            self.counts[syndrome] = len(near)
            self.masks[syndrome, : len(near)] = sorted(near)
        self.low = np.array([_syndrome(w) for w in range(1 << 12)], dtype=np.int64)
        self.high = np.array([_syndrome(w << 12) for w in range(1 << CHECKS)], dtype=np.int64)

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices (n, 6) of nearby codewords, and which of them count."""
        syndromes = self.low[words & 0xFFF] ^ self.high[words >> 12]
        indices = (words[:, None] ^ self.masks[syndromes]) >> CHECKS
        return indices, np.arange(6) < self.counts[syndromes][:, None]


def fingerprint_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """All (row, key): two fingerprints that differ in at most four bits share one.

    If no segment has over two errors, the three Golay keys together are shared. Otherwise one
    segment has three or four, the others have one at most, so one is equal and the other shares
    a Golay key. The top bits of a key say which case it is of.
    """
    words, shift = [], 0
    for width in SEGMENTS:
        words.append((prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    near = [golay.keys(w) for w in words]
    (a, in_a), (b, in_b), (c, in_c) = near
    joint = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :]
    valid = in_a[:, :, None, None] & in_b[:, None, :, None] & in_c[:, None, None, :]
    rows, keys = [np.nonzero(valid)[0]], [joint[valid]]
    for case, (equal, close) in enumerate(permutations(range(3), 2), start=1):
        indices, counted = near[close]
        key = (case << 40) | (words[equal][:, None] << 12) | indices
        rows.append(np.nonzero(counted)[0])
        keys.append(key[counted])
    return np.concatenate(rows), np.concatenate(keys)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """64 bits; a bit is 1 if it is set in over half the shingles' hashes. No words: 0."""
    import xxhash

    # On bytes, lower() and split() know ASCII letters and ASCII white space only, as wanted.
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    lasts = ends[min(size, len(words)) - 1 :][:n].tolist()
    firsts = starts[:n].tolist()
    ones, step, hash_of = np.zeros(64, dtype=np.int64), 1 << 15, xxhash.xxh64_intdigest
    for i in range(0, n, step):
        hashes = np.array(
            [hash_of(joined[a:b], 42) for a, b in zip(firsts[i : i + step], lasts[i : i + step], strict=True)],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, row_id: str | None = None
) -> DataFrame:
    """``doc_id, print`` of every row, and ``row_id`` if row keys are named; the 64 bits as a signed long."""
    names = ["doc_id", "print"] + (["row_id"] if row_id else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py(), size) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]], names=names
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *([F.col(row_id).cast("long").alias("row_id")] if row_id else []),
    )
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))


# ---------------------------------------------------------------- links


#: A bucket up to this size is searched in one go; a larger one goes by halfway words instead.
BUCKET = 4096
SHORT = 4


def _spanning(prints: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among distinct fingerprints: fewer than there are."""
    links, rest = [], prints
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            close = np.bitwise_count(rest ^ one) <= bits
            if close.any():
                found = rest[close]
                links += [(one, other) for other in found]
                queue.extend(found)
                rest = rest[~close]
    return links


def _linked(keys: np.ndarray, prints: np.ndarray, bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Verified links inside the runs of equal keys."""
    borders = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    sizes = np.diff(borders)
    short = np.repeat(sizes <= SHORT, sizes)
    left, right = [], []
    for lag in range(1, SHORT):
        same = (keys[lag:] == keys[:-lag]) & short[lag:]
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(prints[at] ^ prints[at + lag]) <= bits]
        left.append(prints[at])
        right.append(prints[at + lag])
    for i in np.flatnonzero(sizes > SHORT):
        found = _spanning(prints[borders[i] : borders[i + 1]], bits)
        if found:
            a, b = np.array(found, dtype=np.uint64).T
            left.append(a)
            right.append(b)
    return left, right


def _batch(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a = np.concatenate([x.astype(np.uint64) for x in left]) if left else np.zeros(0, dtype=np.uint64)
    b = np.concatenate([x.astype(np.uint64) for x in right]) if right else np.zeros(0, dtype=np.uint64)
    a, b = a.view(np.int64), b.view(np.int64)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _link_buckets(bits: int, bucket: int):
    """Streams sorted (key, print) rows. ``a = b`` reports a member of an oversized bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_keys, kept = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        oversized = None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy().view(np.uint64)
            if oversized is not None:
                more = keys == oversized
                if more.any():
                    yield _batch([prints[more]], [prints[more]])
                    keys, prints = keys[~more], prints[~more]
            keys, prints = np.concatenate([kept_keys, keys]), np.concatenate([kept, prints])
            if not len(keys):
                continue
            # The last run may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1]))
            done_keys, done = keys[:cut], prints[:cut]
            kept_keys, kept = keys[cut:], prints[cut:]
            if len(kept) > bucket:
                oversized = int(kept_keys[0])
                yield _batch([kept], [kept])
                kept_keys, kept = kept_keys[:0], kept[:0]
            if cut:
                borders = np.flatnonzero(np.concatenate(([True], done_keys[1:] != done_keys[:-1], [True])))
                sizes = np.diff(borders)
                large = np.repeat(sizes > bucket, sizes)
                if large.any():
                    yield _batch([done[large]], [done[large]])
                    done_keys, done = done_keys[~large], done[~large]
                if len(done):
                    yield _batch(*_linked(done_keys, done, bits))
        if len(kept):
            yield _batch(*_linked(kept_keys, kept, bits))

    return run


def _halfway(bits: int):
    """All words within half the distance: two fingerprints that are linked share one of them."""
    flips = [0]
    for weight in range(1, (bits + 1) // 2 + 1):
        flips += [sum(1 << b for b in chosen) for chosen in combinations(range(64), weight)]
    masks = np.array(flips, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(prints), 256):
                some = prints[i : i + 256]
                words = (some[:, None] ^ masks).reshape(-1).view(np.int64)
                own = np.repeat(some, len(masks)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(own)], names=["word", "print"])

    return run


def links(prints: DataFrame, bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links among distinct fingerprints that connect all that differ in ``bits`` or fewer.

    Fingerprints that share a Golay key meet in a bucket and are verified there. A bucket returns
    links that connect its members, not all its pairs. Buckets are read as sorted streams; the
    members of one with over ``bucket`` fingerprints are linked through their halfway words
    instead, a number of rows in proportion to the members.
    """
    if bits not in range(0, MAX_BITS + 1, 2):
        raise ValueError(f"the limit is an even number of bits, {MAX_BITS} at most")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(values), 1024):
                some = values[i : i + 1024]
                rows, keys = fingerprint_keys(some, golay)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(some[rows].view(np.int64))], names=["key", "print"]
                )

    parts = partitions(prints.sparkSession)
    buckets = (
        prints.select("print").repartition(parts, "print").mapInArrow(keyed, "key long, print long")
        .repartition(parts, "key").sortWithinPartitions("key", "print")
    )
    found = keep(buckets.mapInArrow(_link_buckets(bits, bucket), "a long, b long").distinct())
    near = found.where("a <> b")
    crowded = found.where("a = b").select(F.col("a").alias("print"))
    if crowded.isEmpty():
        return near
    words = crowded.repartition(parts, "print").mapInArrow(_halfway(bits), "word long, print long")
    # Two that share a halfway word are linked, so the smallest stands for all that share it.
    least = words.groupBy("word").agg(F.min("print").alias("a"), F.collect_set("print").alias("all"))
    star = least.where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where("a <> b")
    return near.unionByName(star.distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each node of ``a, b`` can reach.

    Labels spread along edges and jump to their label's label, so rounds grow with the logarithm
    of a chain's length. Each round is written, which keeps plans short.
    """
    both = keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        spread = keep(spread)
        up = spread.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = keep(spread.join(up, "label").select("node", F.least("label", "top").alias("label"), "old"))
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, bits: int = MAX_BITS,
    row_id: str | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, component_size`` of every row.

    A component is what links of at most ``bits`` differing bits reach; its id is the smallest
    doc_id in it. Null and empty texts have fingerprint zero, which links like any other. Null
    ids never name a component unless it has no other. Repeated rows share all results. If a column of
    row keys is named, it is passed on as ``row_id``, and ``kept`` marks one row of each component, of
    those with its id. An empty table gives no rows; other columns are ignored.

    Equal fingerprints are grouped first, so copies never meet in a bucket.
    """
    order = lambda c: F.coalesce(c, F.lit(2**63 - 1))
    keep_row = ["keep_row"] if row_id else []
    rows = keep(fingerprints(docs, text, doc_id, size, row_id))
    first_row = [F.min_by("row_id", order("doc_id")).alias("keep_row")] if row_id else []
    prints = keep(rows.groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), *first_row))
    labels = components(links(prints, bits))
    labelled = prints.join(labels.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "label", F.coalesce("label", "print")
    )
    labelled = keep(labelled)
    whole = keep(
        labelled.groupBy("label").agg(
            F.min("first").alias("component_id"), F.sum("n").alias("component_size"), F.count(F.lit(1)).alias("prints"),
            *([F.min_by("keep_row", order("first")).alias("keep_row")] if row_id else []),
        )
    )
    of_print = keep(spread_lookup(labelled.select("print", "n", "label"), whole, "label", "prints"))
    out = spread_lookup(rows, of_print.select("print", "n", "component_id", "component_size", *keep_row), "print", "n")
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component_size",
        *(["row_id", (F.col("row_id") == F.col("keep_row")).alias("kept")] if row_id else []),
    )
