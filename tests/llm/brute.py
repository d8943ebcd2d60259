"""Plain single-process versions of the operators, for small inputs."""

import collections
import hashlib
import re

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def jaccard(rows, k, num, den):
    """{id: (set size, component)} for rows (id, text)."""
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().translate(LOW))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = collections.defaultdict(list)
    for i in sorted(sets):
        common = collections.Counter()
        for s in sets[i]:
            common.update(having[s])
            having[s].append(i)
        for j, n in common.items():
            if n * den >= num * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeats(rows, width=50):
    """{id: (n_bytes, n_removed, n_spans, kept_sha256)} for rows (id, text)."""
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        windows = range(len(b) - width + 1)
        hit = [first.get(b[p:p + width], i) < i for p in windows]
        for p in windows:
            first.setdefault(b[p:p + width], i)
        gone = bytearray(len(b))
        for p in windows:
            if hit[p]:
                gone[p:p + width] = b"\1" * width
        kept = bytes(x for x, r in zip(b, gone) if not r)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def tokens(texts, path, end=2):
    """Ids of each text by the whole tokenizer, with the closing id."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def top_k(vectors, queries, k):
    """[(query, rank, id, score)] for {id: [int]}."""
    out = []
    for q in queries:
        s = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return out


def order_minhash(text, k, l, m, mix_all):  # noqa: E741
    """Tuples of the l smallest numbered k-mers in text order, one per hash
    function of ``mix_all(k-mer, occurrence) -> m numbers``."""
    padded = "\0" * (k - 1) + text
    seen, items = collections.Counter(), []
    for p in range(len(text)):
        g = padded[p:p + k]
        items.append((p, mix_all(g, seen[g])))
        seen[g] += 1
    return [tuple(p for p, _ in sorted(sorted(items, key=lambda x: x[1][j])[:l])) for j in range(m)]
