"""The operators' results worked out row by row in plain Python."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import regex
import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def text_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = BLANK.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def simhash(text, shingle=3):
    words = BLANK.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def grouped(ids, linked):
    """The smallest id that each id reaches; ``linked`` tells whether two are neighbours."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = list(ids)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def repeats(docs, width=50):
    """doc_id -> (bytes, removed, spans, digest of the rest) for documents of distinct ids."""
    first = {}
    data = {i: (t or "").encode() for i, t in docs}
    for i in sorted(data):
        for p in range(len(data[i]) - width + 1):
            first.setdefault(data[i][p : p + width], i)
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        spans = len(re.findall(b"\1+", bytes(gone)))
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def lost_lines(docs, window=2, min_words=8, long=12):
    """doc_id -> places of the lines that go."""
    first, gone = {}, defaultdict(set)
    for i, text in sorted(docs):
        lines = [(k, x.strip(" \t\n\x0b\x0c\r"), len(BLANK.findall(x))) for k, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[2]]
        runs = [lines[k : k + window] for k in range(len(lines) - window + 1)]
        runs = [r for r in runs if sum(x[2] for x in r) >= min_words] + [[x] for x in lines if x[2] >= long]
        for run in sorted(runs, key=lambda r: r[0][0]):
            key = tuple(x[1] for x in run)
            if first.setdefault(key, (i, run[0][0])) < (i, run[0][0]):
                gone[i] |= {x[0] for x in run}
    return gone


def template(text, units, names="all"):
    """(kind, value) pairs of the canonical form, by one walk over the tokens instead of rewriting the text."""
    tokens = list(regex.finditer(r"[0-9]+(?:,[0-9]{3}(?![0-9]))*(?:\.[0-9]+(?:,[0-9]{3}(?![0-9]))*)*|[^\W_0-9]+", text))
    out, last, inner_before = [], None, False
    for t in tokens:
        word, before = t.group(), text[: t.start()]
        gap = text[last.end() : t.start()] if last else None
        if word[0].isdigit():
            out.append(("number", word.replace(",", "")))
            inner_before = False
        elif word in units and last and out[-1][0] == "number" and gap.strip(" ") == "":
            out.append(("unit", word.lower()))
            inner_before = False
        else:
            capital = bool(regex.match(r"\p{Lu}\p{Ll}", word))
            inner = capital and (bool(regex.search(r"[\p{Ll},;] $", before)) or (inner_before and gap == " "))
            inner_before = inner
            out.append(("name" if capital and (names == "all" or names == "inner" and inner) else "", word.lower()))
        last = t
    return out


def contaminated(docs, items, units, window=10, shortest=5):
    """(doc, item) pairs by comparing all windows of both."""
    forms = {i: [template(t, units, n) for n in ("all", "inner", "none")] for i, t in items}
    forms = {i: f for i, f in forms.items() if len(f[0]) >= shortest}
    small = {v for f in forms.values() for kind, v in f[0] if not kind}
    found = set()
    for d, text in docs:
        texts = [template(text, units, n) for n in ("all", "inner")]
        for i, f in forms.items():
            stay = {("name", a[1]) for a, b in zip(f[0], f[1], strict=True) if a[0] and not b[0] and a[1] in small}
            n, pairs = min(window, len(f[0])), {}
            for form, doc in itertools.product(f, texts):
                for start, at in itertools.product(range(len(form) - n + 1), range(len(doc) - n + 1)):
                    both = list(zip(form[start : start + n], doc[at : at + n], strict=True))
                    dense = 2 * sum(bool(a[0]) for a, _ in both) > n
                    if any(a[0] != b[0] or ((dense or not a[0] or a in stay) and a != b) for a, b in both):
                        continue
                    pairs.setdefault(at - start, set()).update(p for p in both if p[0][0])
            if any(len({a for a, _ in p}) == len(p) == len({b for _, b in p}) for p in pairs.values()):
                found.add((d, i))
    return found
