"""The plain meaning of each operator, on rows in memory."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
FOLDED = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 2**63 - 1


def rank(i):
    return LAST if i is None else i


def words(text):
    return WORD.findall(text or "")


def word_windows(rows, k=13):
    """(doc_id, n_words, n_removed, kept) of each (doc_id, text)."""
    first = {}
    for i, text in rows:
        w = words(text)
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            first[key] = min(first.get(key, LAST), rank(i))
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < rank(i):
                gone[a : a + k] = [True] * k
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def byte_strings(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept)."""
    first = {}
    for i, text in rows:
        b = (text or "").encode()
        for a in range(len(b) - length + 1):
            key = b[a : a + length]
            first[key] = min(first.get(key, (LAST, LAST)), (rank(i), a))
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if first[b[a : a + length]] < (rank(i), a):
                gone[a : a + length] = b"\1" * length
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def passages(rows, items, window=10):
    """(doc_id, n_words, n_hit, item ids)."""
    patterns = defaultdict(set)
    for item, text in items:
        w = FOLDED.findall((text or "").translate(LOW))
        m = min(window, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            patterns[tuple(w[a : a + m])].add(None if item is None else str(item))
    out = []
    for i, text in rows:
        w = FOLDED.findall((text or "").translate(LOW))
        hit, found = [False] * len(w), set()
        for p, ids in patterns.items():
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a : a + len(p)]) == p:
                    hit[a : a + len(p)] = [True] * len(p)
                    found |= ids
        out.append((i, len(w), sum(hit), sorted(x for x in found if x is not None)))
    return out


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = words(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        again += bool(WORD.search(line)) and line in seen
        seen.add(line)
    counts = Counter(tuple(w[a : a + 5]) for a in range(len(w) - 4))
    twice = [False] * len(w)
    for a in range(len(w) - 4):
        if counts[tuple(w[a : a + 5])] > 1:
            twice[a : a + 5] = [True] * 5
    n = sum(twice)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), again, n, len(w) < 10 or 100 * n > 20 * len(w)


def similar(rows, percent=75):
    """(doc_id, n_shingles, component_id)."""
    sets = []
    for i, text in rows:
        w = words((text or "").translate(LOW))
        sets.append((rank(i), frozenset(tuple(w[a : a + 5]) for a in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    show = lambda i: None if i == LAST else i
    return [(show(i), len(s), show(find(i))) for i, s in sets]


def lines(rows, min_chars=10):
    """(doc_id, n_lines, n_dropped, kept)."""
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOW)
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), LAST), rank(i))
    out = []
    for i, text in rows:
        split = (text or "").split("\n")
        kept = [x for x in split if len(key(x)) < min_chars or first[key(x)] >= rank(i)]
        out.append((i, len(split), len(split) - len(kept), "\n".join(kept)))
    return out


def targets(sizes):
    """Target of each source from its size, by filling and sharing again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: n % 3 + 1 for n, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        left = sum(weight[s] for s in order if s not in capped)
        aim = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / left for s in order}
        over = {s for s in order if s not in capped and aim[s] > 3 * sizes[s]}
        if not over:
            return aim
        capped |= over


def copies(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row."""
    groups = defaultdict(list)
    low = lambda text: (text or "").translate(LOW)
    for i, text in rows:
        groups[low(text)].append(i)
    best = {k: max((i for i in g if i is not None), default=None) for k, g in groups.items()}
    return [(i, best[low(t)], len(groups[low(t)]), hashlib.sha256(low(t).encode()).hexdigest()) for i, t in rows]


RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")


def variants(rows, min_length=6, min_count=5, ratio=5):
    """(word, form, root, n, n_near, form_n) of each word."""
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = defaultdict(set)
    by = defaultdict(set)
    for w in counts:
        for at in range(len(w)):
            by[w[:at] + w[at + 1 :], at].add(w)
            if (less := w[:at] + w[at + 1 :]) in counts:
                near[w].add(less)
                near[less].add(w)
    for group in by.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _way(levels, at):
    way = []
    for level in levels[:-1]:
        way.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else None))
        at >>= 1
    return way


def merkle(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows of five columns."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0], h(*map(part, row)), row))
    langs = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in langs:
        groups[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[k] = _levels([leaf for _, leaf, _ in groups[k]])
    top = _levels([trees[k][-1][0] for k in langs])
    out = []
    for number, k in enumerate(langs):
        for at, (i, leaf, row) in enumerate(groups[k]):
            way = _way(trees[k], at) + _way(top, number)
            node = leaf
            if i is not None and row[3] is not None and zlib.crc32(str(i).encode()) % 7 == 0:
                node = h(*map(part, (*row[:3], row[3] + 1, row[4])))
            for right, other in way:
                node = h(node) if other is None else h(other, node) if right else h(node, other)
            out.append((i, leaf, trees[k][-1][0], top[-1][0], h(*[o for _, o in way if o]), node, node == top[-1][0]))
    return out
