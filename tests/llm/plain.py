"""Brute-force versions in plain Python of what the operators compute."""

import collections
import hashlib
import re


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    words = split(text)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered)


def without_repeats(rows, window=20):
    """(n_words, n_removed, kept text) per row of (doc_id, text), in the order of ids."""
    seen, out = {}, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = split(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            place = seen.setdefault(tuple(words[i : i + window]), (doc_id, i))
            if place != (doc_id, i):
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def shingles(text):
    words = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard_groups(rows):
    """doc_id -> (set size, smallest id reachable), comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def mixed(rows, block=16):
    """The slices (doc_id, first word, word after the last) that the mix takes of (doc_id, text, source) rows."""
    import heapq

    sizes = {i: len(split(t)) for i, t, _ in rows}
    order = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    size = {s: sum(sizes[i] for i, _, x in rows if x == s) for s in order}
    total, share, closed = sum(size.values()), 0.0, set()
    while True:
        share = (total - sum(3 * size[s] for s in closed)) / sum(weight[s] for s in order if s not in closed)
        more = {s for s in order if 3 * size[s] / weight[s] < share}
        if more == closed:
            break
        closed = more
    target = {s: min(3.0 * size[s], share * weight[s]) for s in order}
    blocks = {s: -(-size[s] // block) for s in order}
    seats = dict.fromkeys(order, 0)
    heap = [(-target[s], k, s) for k, s in enumerate(order) if target[s] > 0]
    heapq.heapify(heap)
    for _ in range((2 * total + block) // (2 * block)):
        _, k, s = heap[0]
        seats[s] += 1
        heapq.heapreplace(heap, (-target[s] / (2 * seats[s] + 1), k, s))
    out = []
    for s in order:
        quota = min(seats[s], 3 * blocks[s])
        n = max(blocks[s], 1)
        first = int(hashlib.md5(f"mix:{s or ''}".encode()).hexdigest()[:8], 16) % n
        rounds, rest = divmod(quota, n)
        own = sorted((i for i, _, x in rows if x == s), key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest())
        place = 0
        for i in own:
            begin, end = place, place + sizes[i]
            place = end
            runs = [(begin, end)] * rounds
            for low, high in ((first * block, min((first + rest) * block, size[s])), (0, (first + rest - blocks[s]) * block)):
                runs.append((max(begin, low), min(end, high)))
            out += [(i, a - begin, b - begin) for a, b in runs if b > a]
    return out
