"""Plain Python versions of what the corpus operators compute, for small inputs."""

import hashlib
import math
import re
import zlib

import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BLANKS = re.compile("[^\x20\x09-\x0d]+")


def sha256(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def exact_groups(rows):
    """(doc_id, text) rows to sorted (doc_id, keep_id, group_size, kept, digest)."""
    groups = {}
    for doc_id, text in rows:
        bare = re.sub("[\x20\x09-\x0d]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    found = []
    for bare, members in groups.items():
        members.sort()
        keep = members[0][3]
        for i, member in enumerate(members):
            found.append((member[3], keep, len(members), i == 0, sha256(bare)))
    return sorted(found, key=repr)


def shingles(text, k):
    words = BLANKS.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def near_components(rows, k):
    """(doc_id, text) rows to {doc_id: (set size, component)}; ids are distinct."""
    sets = {doc_id: shingles(text, k) for doc_id, text in rows}
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc_id: (len(sets[doc_id]), find(doc_id)) for doc_id in ids}


def contamination(rows, items, width=10):
    """(doc_id, text) rows to sorted (doc_id, n_words, n_hit, sorted item ids as strings)."""
    windows = []
    for item_id, text in items:
        words = WORDS.findall((text or "").translate(UPPER))
        n = min(width, len(words))
        windows += [
            (item_id, words[i : i + n]) for i in range(len(words) - n + 1) if words
        ]
    found = []
    for doc_id, text in rows:
        words = WORDS.findall((text or "").translate(UPPER))
        hit, own = set(), set()
        for item_id, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    own.add("" if item_id is None else str(item_id))
        found.append((doc_id, len(words), len(hit), sorted(own)))
    return sorted(found, key=repr)


def repeats(rows, least, keep_first):
    """(doc_id, text) rows to sorted (doc_id, n_bytes, removed, spans, kept)."""
    seen = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        for i in range(len(raw) - least + 1):
            seen.setdefault(raw[i : i + least], []).append((doc_id, i))
    found = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - least + 1):
            places = seen[raw[i : i + least]]
            if places[0] != (doc_id, i) if keep_first else len(places) > 1:
                gone[i : i + least] = b"\1" * least
        spans = sum(1 for i in range(len(raw)) if gone[i] and (not i or not gone[i - 1]))
        kept = bytes(x for x, y in zip(raw, gone) if not y)
        found.append((doc_id, len(raw), sum(gone), spans, kept))
    return sorted(found, key=repr)


def trie_nodes(rows):
    """(conv_id, turn, role, text) rows to the sorted rows of the prefix trie."""
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, role, sha256(f"{role}\0{text}"))
            convs.setdefault(conv_id, []).append((order, role, text))
    convs = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in convs.items()}
    paths = {}
    for c, own in convs.items():
        shared = zlib.crc32(str(c).encode()) % 6
        paths[c] = (*convs.get(c - int(math.fmod(c, 100)), [])[:shared], *own[shared:])
    nodes, children = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals = {}
    for path in sorted(nodes, key=len, reverse=True):
        below = [totals[child] for child in children.get(path, [])]
        saved = (len(nodes[path]) - 1) * len(path[-1][1]) if path else 0
        leaves = sum(x for x, _ in below) if below else 1
        totals[path] = (leaves, saved + sum(x for _, x in below))
    found = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        sizes = (len(members), len(children.get(path, [])), *totals[path])
        found.append((min(members), len(path), parent, *sizes, sha256(ends)))
    return sorted(found, key=repr)


def clustered(rows, k=16, rounds=3, size=64):
    """(vec_id, embedding) rows to sorted (vec_id, cluster, distance, cluster's, all, centroid)."""
    kept = []
    for vec_id, embedding in rows:
        usable = embedding is not None and len(embedding) == size
        if usable and all(x is not None and math.isfinite(x) for x in embedding):
            clamped = (min(max(64 * x, -(2**27)), 2**27) for x in embedding)
            kept.append((vec_id, [math.floor(x) for x in clamped]))
    name = [sha256(f"1:{'' if i is None else i}") for i, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (name[i], kept[i][1]))
    centroids = [kept[i][1] for i in order[:k]]

    def assign():
        found = []
        for _, vector in kept:
            apart = [sum((x - y) ** 2 for x, y in zip(vector, c)) for c in centroids]
            found.append((apart.index(min(apart)), min(apart)))
        return found

    for _ in range(rounds):
        best = assign()
        for n in range(len(centroids)):
            own = [kept[i][1] for i in range(len(kept)) if best[i][0] == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    best = assign()
    total = sum(d for _, d in best)
    of = [sum(d for c, d in best if c == n) for n in range(len(centroids))]
    rows = [(i, c, d, of[c], total, centroids[c]) for (i, _), (c, d) in zip(kept, best)]
    return sorted(rows, key=repr)


def simhash_components(rows, width=4, distance=4):
    """(doc_id, text) rows to sorted (doc_id, fingerprint, component)."""
    values = []
    for _, text in rows:
        words = BLANKS.findall((text or "").translate(UPPER))
        n = max(1, len(words) - width + 1) if words else 0
        hashes = [
            xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(n)
        ]
        values.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and (values[i] ^ values[j]).bit_count() <= distance:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group):
        known = least.get(g)
        least[g] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    found = [(doc_id, v, least[g]) for (doc_id, _), v, g in zip(rows, values, group)]
    return sorted(found, key=repr)
