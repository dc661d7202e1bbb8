"""Plain versions of the operators, for small inputs."""

import hashlib
import re

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (k % 2 + 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def pii(text):
    out = []
    for kind, form in FORMS.items():
        out += [(kind, m.start(), m.end()) for m in re.finditer(form, text or "") if valid(kind, m[0])]
    return out


def pii_sha(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in pii(text)).encode()).hexdigest()


def suffix(docs, span=200):
    """doc -> (n_bytes, n_removed, n_spans, sha256 of what is left)."""
    from collections import Counter

    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[k : k + span] for _, b in raw for k in range(len(b) - span + 1))
    out = {}
    for i, b in raw:
        mask = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if seen[b[k : k + span]] > 1:
                mask[k : k + span] = b"\1" * span
        kept = bytes(x for x, m in zip(b, mask) if not m)
        runs = sum(1 for k, m in enumerate(mask) if m and (k == 0 or not mask[k - 1]))
        out[i] = (len(b), sum(mask), runs, hashlib.sha256(kept).hexdigest())
    return out


def components(keys, linked):
    """Smallest key reachable."""
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def simhash(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 3 else [b" ".join(words)]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    from collections import Counter

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    found = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if found[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
