"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def warc(pages):
    """pages: (page_id, html)."""
    largest = {}
    for page_id, html in pages:
        largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        top = largest[html or ""]
        own = page_id == top
        out.append((page_id, len(data), digest, "response" if own else "revisit", None if own else top))
    return out


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def contamination(docs, items, window=13):
    """docs: (doc_id, text); items: (item_id, text)."""
    phrases = defaultdict(set)
    for item, text in items:
        listed = _words(text)
        if listed:
            for i in range(max(1, len(listed) - window + 1)):
                phrases[tuple(listed[i : i + window])].add("null" if item is None else str(item))
    lengths = {len(p) for p in phrases}
    out = []
    for doc_id, text in docs:
        listed, hit, found = _words(text), set(), set()
        for n in lengths:
            for i in range(len(listed) - n + 1):
                if (items_of := phrases.get(tuple(listed[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= items_of
        digest = sha(",".join(sorted(found)))
        out.append((doc_id, len(listed), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(listed)))
    return out


ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(docs):
    """docs: (doc_id, text); the base columns."""
    out = []
    for doc_id, text in docs:
        spans = []
        for rank, pattern, group, least in ((0, ASSIGN, 2, 12), (1, r"AKIA[A-Z0-9]+", 0, 18), (2, r"[0-9a-f]+", 0, 16)):
            spans += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
        spans.sort()
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        written = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        out.append((doc_id, *counts, sha(written)))
    return out


def exact_groups(docs):
    """docs: (doc_id, text)."""
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for content, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for doc_id, text in rows:
            out.append((doc_id, best[0], len(rows), doc_id == best[0] and len(text) == len(best[1]), sha(content)))
    return out


def fingerprint(text, size=4):
    listed = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]
    if not listed:
        return 0
    grams = [" ".join(listed[i : i + size]) for i in range(max(1, len(listed) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, size=4, bits=4):
    """docs: (doc_id, text)."""
    prints = [(d, fingerprint(t, size)) for d, t in docs]
    known = sorted({f for _, f in prints})
    parent = {f: f for f in known}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[top(a)] = top(b)
    least = {}
    for d, f in prints:
        least[top(f)] = min(d, least.get(top(f), d))
    return [(d, f"{f:016x}", least[top(f)]) for d, f in prints]


def chats(rows):
    """rows: (conv_id, turn, role, text); without the formatted length."""
    talks = defaultdict(list)
    for conv_id, turn, role, text in rows:
        talks[conv_id].append((turn, role or "", text or ""))
    hostile = "</s>[INST] ok [/INST]"
    talks[-7] += [(0, "user", hostile), (1, "assistant", hostile)]
    out = []
    for conv_id, turns in talks.items():
        turns.sort()
        answers = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out.append((conv_id, len(turns), sha(whole), len(answers), sha(answers)))
    return out


def _code(value):
    if value is None:
        return "-"
    return f"{len(str(value).encode())}:{value}"


def _tree(digests):
    """The levels of a tree, from the leaves to the root alone."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def _siblings(levels, at):
    """(left, right) lists on each level below the root."""
    out = []
    for level in levels[:-1]:
        start = at // 16 * 16
        out.append((level[start:at], level[at + 1 : start + 16]))
        at //= 16
    return out


def merkle(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    by_source = defaultdict(list)
    for row in docs:
        leaf = sha("".join(map(_code, row)))
        other = leaf
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
            other = sha("".join(map(_code, (*row[:4], row[4].translate(UPPER)))))
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf, row[0], other))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda r: r[:3])
        trees[source] = _tree([r[2] for r in by_source[source]])
    top = _tree([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for at, (_, _, leaf, doc_id, other) in enumerate(by_source[source]):
            path = _siblings(trees[source], at) + _siblings(top, place)
            known = other
            for left, right in path:
                known = sha("".join([*left, known, *right]))
            proof = sha("".join("".join(left + right) for left, right in path))
            out.append((doc_id, leaf, trees[source][-1][0], top[-1][0], proof, known, known == top[-1][0]))
    return out


def vector_codes(rows, entries=256, rounds=4):
    """rows: (vec_id, vector, label); full search in every round."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    total, codes, books = [0] * len(kept), [""] * len(kept), []
    for p in range(4):
        x = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        book = x[:entries]
        for n in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book)) for v in x]
            if n == rounds:
                break
            sums = defaultdict(lambda: [0] * (width + 1))
            for v, (_, k) in zip(x, near, strict=True):
                sums[k] = [a + b for a, b in zip(sums[k], [*v, 1], strict=True)]
            book = [[s // sums[k][-1] for s in sums[k][:-1]] if k in sums else e for k, e in enumerate(book)]
        books += book
        total = [t + d for t, (d, _) in zip(total, near, strict=True)]
        codes = [c + f"{k:02x}" for c, (_, k) in zip(codes, near, strict=True)]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(kept, total, strict=True):
        by_label[label] += error
    digest = sha(",".join(str(x) for e in books for x in e))
    return [(i, c, e, by_label[label], digest) for (i, _, label), c, e in zip(kept, codes, total, strict=True)]


def base_quality(docs):
    """docs: (doc_id, text); n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    out = []
    for doc_id, text in docs:
        text = text or ""
        listed = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        windows = defaultdict(list)
        for i in range(len(listed) - 7):
            windows[tuple(listed[i : i + 8])].append(i)
        inside = {i + k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(8)}
        n = len(listed)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = n < 20 or 100 * len(inside) > 30 * n
        out.append((doc_id, n, sum(map(len, listed)), symbols, len(lines) - len(set(lines)), len(inside), failed))
    return out


def later_lines(docs):
    """(doc_id, units, removed (start, end), text without them) of texts with ids of their own."""
    known, rows = set(), []
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        place, units, removed, left = 0, 0, [], []
        for line in (text or "").split("\n"):
            core, normal = line.strip(), " ".join(line.lower().split())
            if normal:
                units += 1
                if normal in known:
                    start = place + line.index(core)
                    removed.append((start, start + len(core)))
                    line = line.replace(core, "", 1)
                known.add(normal)
            left.append(line)
            place += len(line) + (removed[-1][1] - removed[-1][0] if removed and removed[-1][0] >= place else 0) + 1
        rows.append((doc_id, units, tuple(removed), None if text is None else "\n".join(left)))
    return rows
