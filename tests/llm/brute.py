"""Plain versions of the operators, one document after the other, over (id, text) rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def in_order(rows):
    """Rows by id, NULL first; rows of one id are one document, so each text of it counts once."""
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))


def _covered(values, window, seen):
    gone = [False] * len(values)
    for i in range(len(values) - window + 1):
        if values[i:i + window] in seen:
            gone[i:i + window] = [True] * window
        else:
            seen.add(values[i:i + window])
    return gone


def repeated_words(rows, window=20):
    seen, out = set(), {}
    for key, text in in_order(rows):
        w = words(text)
        gone = _covered(tuple(w), window, seen)
        out[key] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def repeated_bytes(rows, length=100):
    seen, out = set(), {}
    for key, text in in_order(rows):
        data = (text or "").encode()
        gone = _covered(data, length, seen)
        runs = sum(g and not before for before, g in zip([False, *gone], gone))
        out[key] = (len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone) if not g)))
    return out


def bag(text):
    w = tuple(words(text))
    return Counter(w[i:i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else Counter([w] if w else [])


def near_classes(rows, percent=80):
    rows = in_order(rows)
    name = {key: key for key, _ in rows}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    bags = [(key, bag(text)) for key, text in rows]
    holders = defaultdict(list)
    for at, (key, own) in enumerate(bags):
        common = Counter()
        for shingle, n in own.items():
            for other, m in holders[shingle]:
                common[other] += min(n, m)
            holders[shingle].append((at, n))
        for other, both in common.items():
            if both * 100 >= percent * (own.total() + bags[other][1].total() - both):
                a, b = root(key), root(bags[other][0])
                low, high = sorted((a, b), key=lambda x: (x is not None, x or 0))
                name[high] = low
    return {key: root(key) for key, _ in rows}


def line_sets(rows, percent=80):
    """id: (lines with a word, lines removed, text that is kept)."""
    seen, holders, out = [], defaultdict(list), {}
    for key, text in in_order(rows):
        kept, n, removed = [], 0, 0
        for line in (text or "").split("\n"):
            own = frozenset(bag(line))
            if not own:
                kept.append(line)
                continue
            n += 1
            common = Counter(i for x in own for i in holders[x])
            if any(c * 100 >= percent * (len(own) + len(seen[i]) - c) for i, c in common.items()):
                removed += 1
            else:
                kept.append(line)
            for x in own:
                holders[x].append(len(seen))
            seen.append(own)
        out[key] = (n, removed, "\n".join(kept))
    return out


def crc(ids):
    import numpy as np

    return zlib.crc32(np.array(ids, "<u4").tobytes())


def cut(text, encode, capacity=2048, end=0):
    ids = encode(text or "") + [end]
    return [(at // capacity, at, len(ids[at:at + capacity]), crc(ids[at:at + capacity])) for at in range(0, len(ids), capacity)]


def contaminated(rows, items, percent=80):
    held, asked = defaultdict(set), defaultdict(set)
    for source, into in ((rows, held), (items, asked)):
        for key, text in source:
            w = words((text or "").lower())
            into[key] |= {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {
        (d, i, len(s & t), len(t)) for i, t in asked.items() for d, s in held.items()
        if t and len(s & t) * 100 >= percent * len(t)
    }


def vocabulary(rows, every=199, min_length=6, min_count=5):
    """word: occurrences, of runs of letters of which some lose one."""
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n_of, ratio=5):
    """word: (form, root, n, n_near, form_n)."""
    holders = defaultdict(set)
    for w in n_of:
        for i in range(len(w) + 1):
            holders[w[:i] + "\0" + w[i + 1:]].add(w)
            holders[w[:i] + "\0" + w[i:]].add(w)
    near = {w: {o for i in range(len(w) + 1) for k in (w[:i] + "\0" + w[i + 1:], w[:i] + "\0" + w[i:]) for o in holders[k] if one_edit(w, o)} for w in n_of}
    form = {}
    for w, n in n_of.items():
        best = min(near[w], key=lambda o: (-n_of[o], o), default=None)
        form[w] = best if best is not None and n_of[best] >= ratio * n else None
    out = {}
    for w, n in n_of.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), n_of[form[w]] if form[w] else None)
    return out


def periodic(key, text):
    """The words of a document, of which some repeat a passage to the end."""
    w = words(text)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def runs(w, min_words=24, repeats=3):
    """(start, length, period) of all maximal runs, lag by lag."""
    found, n = [], len(w)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_words, repeats * q):
                part = w[i:j + q]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def run_digests(key, text):
    w = periodic(key, text)
    found = runs(w)
    gone = set()
    for start, length, q in found:
        gone.update(range(start + q, start + length))
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *told, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
