"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_OF_WORD = "</w>"
#: No mergeable pair.
NONE = np.iinfo(np.int64).max
#: Cells of one batch of trees. A cell takes about 60 bytes.
CELLS = 1 << 17
#: Bytes that the remembered words of a task may take.
REMEMBERED = 16_000_000
#: What a remembered word takes besides its characters and ids: the text object, its place in a table, two numbers.
WORD_BYTES = 160
#: Characters of text that are encoded at once; a longer text is one piece of work by itself.
CHUNK = 400_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


def _ranges(kinds: str) -> str:
    """The 16-bit code points of some general categories, as ranges for a character class."""
    out, start = [], None
    for code in range(0x10001):
        inside = code < 0x10000 and unicodedata.category(chr(code)) in kinds.split()
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{code - 1:04x}")
            start = None
    return "".join(out)


#: The characters of the Unicode property White_Space (fixed values).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split pattern of this kind of file (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Merges:
    """The merge table: ranks of pairs of ids, looked up for whole arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]]) -> None:
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        left, right, merged = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``NONE`` for pairs that never merge, and where an id is negative."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NONE)

    def apply(self, symbols: np.ndarray) -> np.ndarray:
        """Merges every row of ``symbols`` (ids, -1 behind the end); width is a power of two.

        Row by row, a tree over the gaps between symbols holds rank and place of each adjacent
        pair, and its root the leftmost pair of the lowest rank. A merge changes three leaves, whose
        paths to the root are updated. All rows take a step at once, until no root is left.
        Merged symbols keep the place of their left part; the other places are -1.
        """
        n, width = symbols.shape
        ids = np.full((n, width + 1), -1, dtype=np.int64)
        ids[:, :width] = symbols
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width + 1), (n, 1))
        levels = width.bit_length() - 1
        place = np.arange(width)
        tree = np.full((n, 2 * width), NONE)
        ranks = self.rank(ids[:, :-1].reshape(-1), ids[:, 1:].reshape(-1)).reshape(n, width)
        tree[:, width:] = np.where(ranks == NONE, NONE, ranks << levels | place)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

        rows = np.flatnonzero(tree[:, 1] != NONE) if width > 1 else np.zeros(0, dtype=np.int64)
        while len(rows):
            root = tree[rows, 1]
            at = root & (width - 1)
            gone = after[rows, at]
            follows = after[rows, gone]
            ids[rows, at] = self.merged[root >> levels]
            ids[rows, gone] = -1
            after[rows, at] = follows
            before[rows, follows] = at
            ahead = before[rows, at]

            leaves = np.concatenate([gone, at, np.maximum(ahead, 0)])
            three = np.concatenate([rows, rows, rows])
            pair_left = np.concatenate([np.full(len(rows), -1), ids[rows, at], np.where(ahead >= 0, ids[rows, ahead], -1)])
            pair_right = np.concatenate([ids[rows, follows], ids[rows, follows], ids[rows, at]])
            rank = self.rank(pair_left, pair_right)
            value = np.where(rank == NONE, NONE, rank << levels | leaves)
            # A row without a symbol ahead has nothing to change there.
            real = np.concatenate([np.ones(2 * len(rows), dtype=bool), ahead >= 0])
            three, node = three[real], leaves[real] + width
            tree[three, node] = value[real]
            for _ in range(levels):
                node = node >> 1
                tree[three, node] = np.minimum(tree[three, 2 * node], tree[three, 2 * node + 1])
            rows = rows[tree[rows, 1] != NONE]
        return ids[:, :width]


class WordBpe:
    """A tokenizer file of the kind: added tokens, NFC, lower case, split pattern, bytes, merges.

    The file's steps are fixed here and checked against it; other kinds of files are refused.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        known = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"].get("Regex") == SPLIT and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and model["type"] == "BPE" and model["end_of_word_suffix"] == END_OF_WORD
            and not model["ignore_merges"] and not model["byte_fallback"] and model["unk_token"] is None
            and spec["decoder"] is None
            and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        if not known:
            raise ValueError(f"{path} describes another kind of tokenizer")
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(vocabulary, merges)
        characters = byte_characters()
        self.inner = np.array([vocabulary.get(c, -1) for c in characters])
        self.last = np.array([vocabulary.get(c + END_OF_WORD, -1) for c in characters])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        letters, numbers = _ranges("Lu Ll Lt Lm Lo"), _ranges("Nd Nl No")
        self.word_pattern = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{WHITE_SPACE}{letters}{numbers}]+"
        )
        # Characters beyond 16 bits would make this pattern slow, and those that this Python's Unicode
        # version doesn't know may be letters in the file's library: texts with them are split by
        # the library itself.
        self.plain: set[str] = set()
        self.path = path
        self._forget()

    @cached_property
    def library(self):
        """The file's own library, a second copy of the tables; loaded only for texts that need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.int32)
        self.taken = 0
        self._remember(list(self.added), [np.ones(len(self.added))], [np.array([*self.added.values()])])

    def _remember(self, words: list[str], lengths: list[np.ndarray], ids: list[np.ndarray]) -> None:
        self.known.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words)), strict=True))
        self.lengths = np.concatenate([self.lengths, *lengths], dtype=np.int32, casting="unsafe")
        self.ids = np.concatenate([self.ids, *ids], dtype=np.int32, casting="unsafe")
        self.starts = np.concatenate([[0], np.cumsum(self.lengths[:-1], dtype=np.int32)], dtype=np.int32) if words else self.starts
        self.taken += sum(WORD_BYTES + 4 * len(w) for w in words)

    def _is_plain(self, text: str) -> bool:
        new = set(text).difference(self.plain)
        self.plain |= {c for c in new if c <= "\uffff" and unicodedata.category(c) != "Cn"}
        return new <= self.plain

    def words(self, text: str) -> list[str]:
        """Added tokens as they stand, and the words of the text between them."""
        out: list[str] = []
        for piece in self.added_pattern.split(text) if self.added_pattern else [text]:
            if piece in self.added:
                out.append(piece)
            elif not self._is_plain(piece):
                lowered = self.library.normalizer.normalize_str(piece)
                splitter = self.library.pre_tokenizer[0]
                out += [word for word, _ in splitter.pre_tokenize_str(lowered)]
            elif piece:
                # Each character is lowered by itself, without the final form of sigma.
                lowered = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                out += self.word_pattern.findall(lowered)
        return out

    def _encode_words(self, words: list[str]) -> None:
        data = [w.encode() for w in words]
        sizes = np.array([len(d) for d in data])
        flat = np.frombuffer(b"".join(data), dtype=np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[flat]
        symbols[ends - 1] = self.last[flat[ends - 1]]
        done: tuple[list[str], list, list] = ([], [], [])
        width_of = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
        for width in np.unique(width_of):
            chosen = np.flatnonzero(width_of == width)
            step = max(1, CELLS // int(width))
            for i in range(0, len(chosen), step):
                some = chosen[i : i + step]
                inside = np.arange(width) < sizes[some][:, None]
                rows = np.full((len(some), width), -1)
                source = (ends[some] - sizes[some])[:, None] + np.arange(width)
                rows[inside] = symbols[source[inside]]
                if (rows[inside] < 0).any():
                    # Bytes that the vocabulary lacks are left out; the others close up.
                    order = np.argsort(rows < 0, axis=1, kind="stable")
                    rows = np.take_along_axis(rows, order, axis=1)
                merged = self.merges.apply(rows)
                left = merged >= 0
                done[0].extend(words[k] for k in some)
                done[1].append(left.sum(axis=1))
                done[2].append(merged[left].astype(np.int32))
        self._remember(*done)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) into the ids of all texts, and those ids."""
        listed = [self.words(t) for t in texts]
        every = [w for words in listed for w in words]
        new = set(every).difference(self.known)
        if new and self.taken > REMEMBERED:
            # What this batch needs is encoded again; the rest had its use.
            self._forget()
            new = set(every).difference(self.known)
        if new:
            self._encode_words(sorted(new))
        index = np.fromiter(map(self.known.__getitem__, every), dtype=np.int64, count=len(every))
        lengths = self.lengths[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.starts[index] - (ends - lengths), lengths)]
        borders = np.cumsum([0] + [len(words) for words in listed])
        return np.concatenate(([0], ends))[borders], ids

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[1].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Without a decoder in the file, tokens are joined by spaces, added ones included."""
        return " ".join(map(self.token_of.__getitem__, ids))


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    start, chunk, size = 0, [], 0
    for i, text in enumerate(texts):
        value = text.as_py() or ""
        if chunk and size + len(value) > CHUNK:
            yield start, chunk
            start, chunk, size = i, [], 0
        chunk.append(value)
        size += len(value)
    if chunk:
        yield start, chunk


def encode_decode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids, decoded`` of every row: its token ids, and the text they decode to.

    Null texts count as empty and have no ids; a null id is returned as null; repeated rows give
    repeated results; an empty table gives no rows; other columns are ignored. Texts are
    encoded whole, however long, and no row is moved.

    path: the tokenizer file, which every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path)
        for batch in batches:
            for start, texts in _chunks(batch.column(1)):
                offsets, ids = bpe.encode_batch(texts)
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                decoded = [bpe.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), listed, pa.array(decoded, type=pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encoding_digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``encode_decode``'s rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
