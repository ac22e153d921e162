"""Plain Python versions of what the operators' queries return, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(rows):
    """rows: (doc_id, text) with distinct ids."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    return {
        i: (max(own), len(own), i == max(own), hashlib.sha256(text.encode()).hexdigest())
        for text, own in groups.items() for i in own
    }


def shingle_set(text, width):
    words = BLANK.findall((text or "").translate(ASCII))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def jaccard(rows, width, num, den):
    sets = {i: shingle_set(t, width) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if min(len(sets[a]), len(sets[b])) * den < num * max(len(sets[a]), len(sets[b])):
                continue
            common = len(sets[a] & sets[b])
            if den * common >= num * len(sets[a] | sets[b]):
                p, q = sorted((top(a), top(b)))
                up[q] = p
    return {i: (len(sets[i]), top(i)) for i in sets}


def quality(text):
    text = text or ""
    words = BLANK.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def targets(sizes):
    """sizes: source -> words."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
    at, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    spans.sort()
    line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    n = Counter(s[3] for s in spans)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(line.encode()).hexdigest()


def chats(rows):
    """rows: (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def padding(lengths, size=2048):
    """Padded places of sequences of these lengths."""
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths)


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
