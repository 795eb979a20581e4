"""Plain versions of the operators over small inputs."""

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def byte_repeats(rows, n=50):
    """rows (doc_id, text) -> list of (doc_id, n_bytes, n_removed, n_spans, sha256), as given."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - n + 1):
                s = b[k:k + n]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        if i is not None:
            for k in range(len(b) - n + 1):
                if first[b[k:k + n]] < i:
                    gone[k:k + n] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def word_repeats(rows, n=13):
    first = {}
    for i, t in rows:
        w = words(t)
        if i is not None:
            for k in range(len(w) - n + 1):
                s = tuple(w[k:k + n])
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - n + 1):
                if first[tuple(w[k:k + n])] < i:
                    gone[k:k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, shingle=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lowered)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + shingle]), seed=42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(n, linked):
    """Smallest member of each place's component, for a predicate over pairs of places."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


#: Nulls, empty and long texts, ties, repeated rows, special strings.
ODD = [
    (5, "the same line of words stands here and goes on for quite a while, much longer than fifty bytes\nend of five", "en", "a"),
    (3, "the same line of words stands here and goes on for quite a while, much longer than fifty bytes", "en", "a"),
    (9, None, None, None),
    (7, "", "en", ""),
    (1, " \t\n\x0b ", None, "b"),
    (2, "Ünïcode ☃ ☃ 中文 <|endoftext|> ▁ <s> don't  stop here   x", "de", "b"),
    (None, "the same line of words stands here and goes on for quite a while, much longer than fifty bytes", "en", None),
    (None, None, None, None),
    (8, "the same line of words stands here and goes on for quite a while, much longer than fifty bytes", "fr", "a"),
    (8, "the same line of words stands here and goes on for quite a while, much longer than fifty bytes", "fr", "a"),
    (4, "ab " * 3000 + "tail", "en", "c"),
    (6, "x" * 20000, "en", "c"),
    (10, "x" * 60 + "y" * 60 + "x" * 60, "es", "c"),
    (11, "one", "es", "d"),
]
