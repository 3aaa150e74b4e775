"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")

_VOCABULARY = ["alpha", "beta", "gamma", "delta", "é", "日本", "omega's", "x9", "the", "of", "and", "in", "to"]


def prose(seed: int, words: int, line: int = 9) -> str:
    """Lines of invented words."""
    draw = random.Random(seed)
    parts = [draw.choice(_VOCABULARY) + str(draw.randint(0, 60)) for _ in range(words)]
    return "\n".join(" ".join(parts[i:i + line]) for i in range(0, words, line))


def sha256(value) -> str:
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def shingles(text) -> frozenset:
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def simhash(text: str) -> str:
    """Votes of words and of two words in a row, bit by bit, as hex digits."""
    import xxhash

    whole = 2 ** 64 - 1
    factors = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def stir(value, factor):
        value = ((value ^ (value >> 31)) * factor) & whole
        return value ^ (value >> 29)

    hashes = [xxhash.xxh3_64_intdigest(word) for word in text.split()]
    weights = {term: round(1000 * (1 + math.log(n))) for term, n in Counter(hashes).items()}
    for term, n in Counter((stir(a, factors[0]) + b) & whole for a, b in zip(hashes, hashes[1:])).items():
        weights[term] = weights.get(term, 0) + round(500 * (1 + math.log(n)))
    votes = [0] * 128
    for term, weight in weights.items():
        raw = b"".join(stir(stir((term + f) & whole, f), factors[0]).to_bytes(8, "little") for f in factors)
        for place in range(128):
            votes[place] += weight if raw[place // 8] >> (7 - place % 8) & 1 else -weight
    return int("".join("1" if vote > 0 else "0" for vote in votes), 2).to_bytes(16, "big").hex()


def likeness(one: str, other: str) -> float:
    return round(max(0.0, math.cos(math.pi * (int(one, 16) ^ int(other, 16)).bit_count() / 128)), 9)


def component_ids(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return out


def kept_bytes(rows: list[tuple], length: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept)."""
    order = lambda doc_id: float("inf") if doc_id is None else doc_id
    first: dict[bytes, float] = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for at in range(len(raw) - length + 1):
            piece = raw[at:at + length]
            first[piece] = min(first.get(piece, float("inf")), order(doc_id))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            if first[raw[at:at + length]] < order(doc_id):
                gone[at:at + length] = b"\1" * length
        spans = len([run for run in bytes(gone).split(b"\0") if run])
        out.append((doc_id, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def base_statistics(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(text.count(s) for s in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def secret_spans(text) -> list[tuple]:
    """(start, kind number, end) of the fixed patterns."""
    text = text or ""
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    keys = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    assign = re.compile(rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def line_dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_removed_lines, kept text)."""
    order = lambda doc_id: (doc_id is None, doc_id or 0)
    first: dict[tuple, tuple] = {}
    split = [(text or "").split("\n") for _, text in rows]
    for (doc_id, _), lines in sorted(zip(rows, split), key=lambda row: order(row[0][0])):
        for at in range(len(lines) - 2):
            first.setdefault(tuple(line.strip(" \t\x0b\x0c\r") for line in lines[at:at + 3]), (doc_id, at))
    out = []
    for (doc_id, _), lines in zip(rows, split):
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(line.strip(" \t\x0b\x0c\r") for line in lines[at:at + 3])
            where = first[window]
            if any(window) and (where[0] != doc_id or at >= where[1] + 3):
                gone |= {at, at + 1, at + 2}
        out.append((doc_id, len(lines), len(gone), "\n".join(line for i, line in enumerate(lines) if i not in gone)))
    return out


def chains(texts):
    """Counts of the models of ordinary and of random strings: steps of states, steps of case."""
    counted = []
    for label in (0, 1):
        steps, cases = {}, {}
        for text in texts:
            at, plain, found = 0, "", ""
            for start, kind, end in secret_spans(text):
                plain += text[at:start] + " "
                found += (re.search(r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", text[start:end])[1] if kind == 0 else text[start:end]) + " "
                at = max(at, end)
            plain += text[at:]
            for a, b in zip(" " + (found if label else plain), found if label else plain):
                if b in _ALNUM:
                    key = (a.lower() if a in _ALNUM else " ", b.lower())
                    steps[key] = steps.get(key, 0) + 1
                if a in _LETTERS and b in _LETTERS:
                    cases[a.isupper(), b.isupper()] = cases.get((a.isupper(), b.isupper()), 0) + 1
        counted.append((steps, cases))
    return counted


_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALNUM = _LETTERS + "0123456789"
_STATES = "abcdefghijklmnopqrstuvwxyz0123456789"


def log_ratios(strings, ordinary, random, mixed=0.05):
    """Logarithm of the likelihood as a random string over that as an ordinary one."""
    def likely(model, text):
        steps, cases = model
        total = 0.0
        for a, b in zip(" " + text, text):
            if b in _ALNUM:
                a_, b_ = a.lower() if a in _ALNUM else " ", b.lower()
                all_ = sum(steps.get((a_, c), 0) + 0.01 for c in _STATES)
                total += math.log((1 - mixed) * (steps.get((a_, b_), 0) + 0.01) / all_ + mixed / 36)
            if a in _LETTERS and b in _LETTERS:
                all_ = sum(cases.get((a.isupper(), up), 0) + 0.01 for up in (False, True))
                total += math.log((1 - mixed) * (cases.get((a.isupper(), b.isupper()), 0) + 0.01) / all_ + mixed / 2)
        return total

    out = []
    for text in strings:
        drawn = [c for c in text if c in _ALNUM]
        parts = [likely(random, text)]
        small, capital, digit = _LETTERS[:26], _LETTERS[26:], "0123456789"
        for alphabet in ("abcdef" + digit, small, small + digit, capital + digit, small + capital, small + capital + digit):
            if all(c in alphabet for c in drawn):
                parts.append(-len(drawn) * math.log(len(alphabet)))
        top = max(parts)
        out.append(top + math.log(sum(math.exp(p - top) for p in parts)) - math.log(7) - likely(ordinary, text))
    return out


def model_spans(texts, least=8, threshold=14.0):
    """All spans of every text, (start, kind number, end), by models of these texts."""
    models = chains([text or "" for text in texts])
    out = []
    for text in texts:
        base = secret_spans(text)
        runs = [m for m in re.finditer("[A-Za-z0-9+/_=-]+", text or "") if len(m[0]) >= least]
        ratios = log_ratios([m[0] for m in runs], *models)
        out.append(sorted(base + [
            (m.start(), 3, m.end()) for m, ratio in zip(runs, ratios)
            if ratio > threshold and not any(a < m.end() and m.start() < b for a, _, b in base)]))
    return out
