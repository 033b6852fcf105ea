"""Plain versions of the operators, for small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np

LOWER_WORD = re.compile("[0-9a-z_\x80-\U0010ffff]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_words(text):
    return LOWER_WORD.findall((text or "").lower())


def shingles(text):
    w = lower_words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_duplicates(rows, threshold=0.8):
    """(doc_id, class_id, n_links) by row, from all pairs."""
    sets, n = [shingles(t) for _, t in rows], len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], least[find(i)], links[i]) for i in range(n))


def repeats(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) by row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def quality_base(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = set()
    for k in range(len(w) - 2):
        if grams[tuple(w[k : k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


_MASK = (1 << 64) - 1


def _mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
    return x ^ (x >> 31)


def sentence_spans(rows, span=3, longest=12, near=3):
    """(doc_id, n_sentences, n_removed, kept) by row, for distinct ids. Only the hashes of single words, which content-defined cuts
    depend on, come from the library."""
    from linkwright.llm.spans import _PLACE
    from linkwright.llm.textcore import run_hash

    seen, out = set(), []
    for i, text in sorted(rows):
        text = text or ""
        found = list(re.finditer("[0-9A-Za-z_\x80-\U0010ffff]+", text))
        w = [m[0].lower() for m in found]
        raw = [x.encode() for x in w]
        h = [int(run_hash(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0]) for x in raw]
        sentence = [len(re.findall(r"[.!?\n]", text[: m.start()])) for m in found]
        n_of = Counter(sentence)
        new = [k == 0 or sentence[k] != sentence[k - 1] for k in range(len(w))]
        value = [_mixed((h[k] * int(_PLACE[0]) + h[k + 1] * int(_PLACE[1])) & _MASK) if k + 1 < len(w) and not new[k + 1] else _MASK for k in range(len(w))]
        long = [n_of[s] > span * longest for s in sentence]
        cut = list(new)
        for k in range(len(w)):
            mine = [j for j in range(max(0, k - near), min(len(w), k + near + 1)) if sentence[j] == sentence[k]]
            cut[k] |= long[k] and all(value[k] < value[j] if j < k else value[k] <= value[j] for j in mine if j != k)

        def parts(bounds):
            firsts, since = [], 0
            for k in range(len(w)):
                since = 0 if bounds[k] else since + 1
                if since % longest == 0:
                    firsts.append(k)
            return [(a, b) for a, b in zip(firsts, [*firsts[1:], len(w)])]

        by_sentence, gone = parts(new), set()
        for kind, p in (("sentence", by_sentence), ("passage", parts(cut))):
            for k in range(len(p) - span + 1):
                a, b = p[k][0], p[k + span - 1][1]
                if kind == "passage" and not any(long[a:b]):
                    continue
                key = (kind, *(tuple(w[x:y]) for x, y in p[k : k + span]))
                if key in seen:
                    gone |= set(range(a, b))
                seen.add(key)
        ends = [m.start() for m in found[1:]] + [len(text)]
        kept = text[: found[0].start()] if found else text
        kept += "".join(text[m.start() : e] for k, (m, e) in enumerate(zip(found, ends)) if k not in gone)
        out.append((i, len(by_sentence), sum(any(k in gone for k in range(*p)) for p in by_sentence), kept))
    return out


def tiling(item, text, least=5):
    """Greedy string tiling by its definition: the longest match of unmarked words, again and again."""
    marked, used = [False] * len(item), [False] * len(text)
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not marked[i + n] and not used[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return marked
        marked[i : i + n] = used[j : j + n] = [True] * n


def pii_base(text):
    """The base kinds by the patterns as they stand."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (1 + k % 2)
            total += v - 9 * (v > 9)
        return total % 10 == 0

    found = []
    for order, (kind, p) in enumerate(patterns.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(found)]


def warc(rows):
    """(page_id, bytes, digest, type, refers_to), for distinct ids."""
    first, out = {}, []
    for i, html in sorted(rows):
        b = (html or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        f = first.setdefault(d, i)
        out.append((i, len(b), d, "response" if f == i else "revisit", None if f == i else f))
    return out


def tokens(rows, library, end=1):
    """(doc_id, start, n_tokens, crc32), for distinct ids."""
    start, out = 0, []
    for i, t in sorted(rows):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out
