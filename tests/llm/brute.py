"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
import xxhash

from tidepool.llm import bpe

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def encoded(text):
    enc = tiktoken.Encoding("brute", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS), special_tokens={})
    return enc.encode_ordinary(text or "")


def quality(text):
    text = text or ""
    words = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def simhash(text, k=3):
    words = SPACE.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > n)


def groups(nodes: dict, linked) -> dict:
    """node -> frozenset of its component, for a dict of node -> value and a test on two values."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    names = list(nodes)
    for i, a in enumerate(names):
        for b in names[:i]:
            if linked(nodes[a], nodes[b]):
                parent[find(a)] = find(b)
    sets = {}
    for n in names:
        sets.setdefault(find(n), set()).add(n)
    return {n: sets[find(n)] for n in names}


def repeats(texts, length=200):
    """Per text (bytes): a mask of the bytes to remove."""
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                mask[i:i + length] = True
        out.append(mask)
    return out


def spans(mask) -> int:
    return int((mask & ~np.r_[False, mask[:-1]]).sum()) if len(mask) else 0


def cut(text: bytes, mask) -> bytes:
    return np.frombuffer(text, np.uint8)[~mask].tobytes()


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if not words:
        return []
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)]


def leaks(text, item):
    """Best weighted similarity of an item-sized window of a text."""
    a, b, best = shingles(text), shingles(item), 0.0
    if not a or not b:
        return best
    want = Counter(b)
    for i in range(len(a)):
        have = Counter(a[i:i + len(b)])
        both = sum((have & want).values())
        best = max(best, both / sum((have | want).values()))
    return best


def line_units(text: bytes, least: int):
    """(start, end, name) of the lines of a text, cut after punctuation; short clauses are named by their line."""
    blank, marks, out, at = b" \t\n\r\x0b\x0c", b".!?,;:", [], 0
    for line in re.findall(rb"[^\n]*\n|[^\n]+\Z", text):
        tokens = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", line)]
        plain = [line[a:b].lower() for a, b in tokens]
        clauses, now = [], []
        for (a, b), word in zip(tokens, plain):
            now.append((a, b, word))
            if word[-1] in marks and b < len(line) and line[b] in blank:
                clauses.append(now)
                now = []
        clauses += [now] if now else []
        groups = []
        for c in clauses:
            if len(c) < least and groups and groups[-1][0] == "short":
                groups[-1][1].extend(c)
            else:
                groups.append(("short" if len(c) < least else "long", list(c)))
        lead = len(line) - len(line.lstrip(blank))
        for i, (kind, members) in enumerate(groups):
            a = members[0][0] - (lead if i == 0 else 0)
            b = groups[i + 1][1][0][0] if i + 1 < len(groups) else len(line)
            out.append((at + a, at + b, (kind, b" ".join(w for _, _, w in members)) if kind == "long" else (kind, i, b" ".join(plain))))
        at += len(line)
    return out


def runs_of(text: bytes, units, gap: int, least: int):
    """Of removed units those whose run of words, short stretches between counted, has ``least`` words."""
    places = [m.start() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", text)]
    gone = [i for i, p in enumerate(places) if any(a <= p < b for a, b in units)]
    runs = []
    for i in gone:
        if runs and i - runs[-1][1] - 1 < gap:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    good = [(places[a], places[b]) for a, b in runs if b - a + 1 >= least]
    return [u for u in units if least == 0 or any(a < u[1] and u[0] <= b for a, b in good)]
