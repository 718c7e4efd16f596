"""Plain versions of the operators, for small inputs."""

import hashlib
import html
import re
import zlib
from collections import Counter

import numpy as np
import xxhash


def kept_lines(texts):
    """{id: text without repeated runs of lines}, one place after another in order of (id, chunk); None stays."""
    cut, count = {}, Counter()
    for doc_id, text in texts.items():
        chunks, open_chunk, last = [], [], 0
        for line in text.split("\n") if text is not None else []:
            value = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
            open_chunk.append(line)
            if (value + 31 * last) * 2654435761 % 2**32 < 15 * 2**28:
                chunks.append(open_chunk)
                open_chunk = []
            last = value
        cut[doc_id] = chunks + [open_chunk] * bool(open_chunk)
        count.update(map(tuple, cut[doc_id]))
    first, out = {}, {}
    for doc_id in sorted(texts):
        chunks = cut[doc_id]
        if texts[doc_id] is None:
            out[doc_id] = None
            continue
        lines = [(k, j) for k, chunk in enumerate(chunks) for j in range(len(chunk))]
        gone = set()
        for k, chunk in enumerate(chunks):
            sides = [[] if not 0 <= n < len(chunks) or count[tuple(chunks[n])] > 1 else chunks[n] for n in (k - 1, k + 1)]
            if count[tuple(chunk)] < 2:
                continue
            if tuple(chunk) not in first:
                first[tuple(chunk)] = sides
                continue
            gone |= {(k, j) for j in range(len(chunk))}
            for side, other, step in zip(sides, first[tuple(chunk)], (-1, 1), strict=True):
                j = 0
                while j < min(len(side), len(other)) and side[::step][j] == other[::step][j]:
                    gone.add((k - 1, len(side) - 1 - j) if step < 0 else (k + 1, j))
                    j += 1
        kept, run = [], []
        for at in [*lines, None]:
            if at in gone:
                run.append(at)
                continue
            if sum(bool(chunks[k][j].strip(" \t\r")) for k, j in run) < 2:
                kept += run
            run = []
            kept += [at] if at else []
        out[doc_id] = "\n".join(chunks[k][j] for k, j in kept)
    return out


def repeated_passage_lines(texts, words=50):
    """{id: {places of lines}} of runs of two lines and more, with so many words, that stand in an earlier document too."""
    pairs, out = {}, {}
    for doc_id in sorted(texts):
        lines = (texts[doc_id] or "").split("\n")
        seen = {k for k in range(len(lines) - 1) if pairs.setdefault((lines[k], lines[k + 1]), doc_id) != doc_id}
        covered = sorted(seen | {k + 1 for k in seen})
        runs = []
        for k in covered:
            if runs and runs[-1][-1] == k - 1 and k - 1 in seen:
                runs[-1].append(k)
            else:
                runs.append([k])
        out[doc_id] = {k for run in runs if sum(len(lines[j].split()) for j in run) >= words for k in run}
    return out


def simhash(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints, radius):
    """{id: smallest id reachable} for {id: fingerprint}."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label = np.arange(len(ids))
    while True:
        new = np.array([label[row].min() for row in near], int)
        if (new == label).all():
            return {i: ids[k] for i, k in zip(ids, label, strict=True)}
        label = new


def alignment(item, text):
    """Smith-Waterman score of two texts' words over the item's own."""
    a, b = (re.findall(r"[a-z0-9_\x80-\U0010ffff]+", t.lower()) for t in (item, text))
    above, best = [0] * (len(b) + 1), 0
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, max(row)), row
    return best / (2 * len(a))


def without_repeats(texts, length):
    """[(bytes removed, spans, bytes kept)] of byte strings."""
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


def paragraphs(text):
    return {p for p in re.split(r"(?<=[.!?|])\s+|\n+", text) if p}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def page_text(source):
    """Text of the one article element of a page of the test tables."""
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
    inner = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", inner)).split())


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(texts):
    """{word: (n, n_near, form, form_n, root)} of (id, text) rows."""
    count = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    halves = {}
    for w in count:  # any two near words share a word that lacks one letter of each, or one is that word
        for part in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            halves.setdefault(part, []).append(w)
    near = {w: set() for w in count}
    for group in halves.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w in count:
        best = min(near[w], key=lambda b: (-count[b], b), default=None)
        if best and count[best] >= 5 * count[w]:
            form[w] = best
    out = {}
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out[w] = (count[w], len(near[w]), form.get(w), count.get(form.get(w)), root)
    return out
