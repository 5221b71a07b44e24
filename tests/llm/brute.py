"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def text_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(max(0, len(words) - 7))]
    often, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(rows, percent):
    """{doc_id: (n_shingles, component)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, n in collections.Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def line_dedup(rows, min_docs=5):
    """[(doc_id, n_lines, n_dropped, sha)] of (doc_id, text) rows."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = collections.defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 40:
                    holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 40 or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def top_k(rows, k):
    """[(query, rank, vec_id, score)] of (vec_id, list) rows; queries are ids divisible by 100."""
    good = [(i, [int(np.floor(float(x) * 1024)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, u in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(u, v, strict=True)), i) for i, v in good if i != q and len(v) == len(u))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def fill_in_middle(doc_id, text, seed=7, fim_percent=100, spm_percent=50, sentinels=("<P>", "<S>", "<M>")):
    """(n, form, prefix_chars, middle_chars, output) by cutting a list of lines."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or any(s in text for s in sentinels) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:x]), "".join(lines[x:y]), "".join(lines[y:])
    p, s, m = sentinels
    if h4 % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def periodic_runs(words, copies=3, shortest=24):
    """Every maximal stretch with its smallest period, by trying all lags at all places."""
    n, found = len(words), {}
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, copies * q) and j > i:
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def without_runs(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def repeated_words(docs, window=13):
    """{row: places of the words that a window of a smaller doc_id covers} of [(doc_id, text)]."""
    split = [WORD.findall(t or "") for _, t in docs]
    firsts = {}
    for (i, _), words in zip(docs, split):
        for s in range(len(words) - window + 1 if i is not None else 0):
            key = tuple(words[s : s + window])
            firsts[key] = min(i, firsts.get(key, i))
    out = []
    for (i, _), words in zip(docs, split):
        gone = set()
        for s in range(len(words) - window + 1 if i is not None else 0):
            if firsts[tuple(words[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((words, gone))
    return out
