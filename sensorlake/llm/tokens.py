"""Token ids of whole texts by a public tokenizer file, with a bounded cache of text pieces.

A tokenizer splits a text by a pattern and encodes every piece on its own, so a piece's ids can be
kept. Texts of plain characters (ASCII without apostrophe, Western European letters) are cut in numpy
by the classes of their bytes, and their distinct pieces go to the library's merges once; any other
text, or one that may hold a special string, goes to the library whole. Both give the library's ids.
Pieces are told apart by a 64-bit hash of their bytes and length (``span_hashes``).
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import xxhash

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿŒœ"
#: A character outside these, or what may open a contraction or a special string, sends a text to the library.
NOT_PLAIN = re.compile(rf"[^\t\n\r -&(-~{LETTERS}]")
LETTER, DIGIT, OTHER, SPACE = range(4)


def _classes() -> np.ndarray:
    of = np.full(256, OTHER, dtype=np.uint8)
    of[128:] = LETTER  # a plain text's only characters above ASCII are letters
    for a, b, kind in (("A", "Z", LETTER), ("a", "z", LETTER), ("0", "9", DIGIT)):
        of[ord(a):ord(b) + 1] = kind
    for c in " \t\n\r":
        of[ord(c)] = SPACE
    return of


CLASSES = _classes()
_RANDOM = np.random.default_rng(7)
BYTE_VALUES = _RANDOM.integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15


_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n; the longest tables asked for are kept."""
    if len(_POWERS[0]) < n:
        for which, base in enumerate((BASE, pow(BASE, -1, 2 ** 64))):
            out = np.ones(n, dtype=np.uint64)
            done, step = 1, base
            while done < n:
                out[done:2 * done] = out[:min(done, n - done)] * np.uint64(step)
                done, step = 2 * done, step * step % 2 ** 64
            _POWERS[which] = out
    return _POWERS[0][:n], _POWERS[1][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes.

    Spans of up to 8 bytes: a bijection of their bytes, salted by the length. Up to 16 bytes: both
    halves, mixed one into the other. Longer ones: XXH3, span by span.
    """
    raw = data.tobytes()
    padded = np.frombuffer(raw + bytes(16), dtype=np.uint8)
    eight = np.ndarray((len(data) + 9,), dtype="<u8", buffer=padded, strides=(1,))  # 8 bytes from every place on
    size = ends - starts
    h = mix64((eight[starts] & _MASKS[np.minimum(size, 8)])
              ^ (size.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    two = np.flatnonzero(size > 8)
    second = eight[starts[two] + 8] & _MASKS[np.minimum(size[two] - 8, 8)]
    h[two] = mix64(h[two] ^ mix64(second + np.uint64(0xD6E8FEB86659FD93)))
    long = np.flatnonzero(size > 16)
    h[long] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return h


def join_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in a row, and where each begins (with the end at last)."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    bounds = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=bounds[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), bounds


def cut(data: np.ndarray, bounds: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Piece starts and ends of plain texts in a row.

    ``words``: runs of letters, runs of other marks and single digits; white space goes. Otherwise runs
    of letters, digits and marks, each with one space before it; of other white space, the run up to its
    last character is a piece and the last one is too, unless it is a space that the next piece takes;
    a run that ends a text stays whole.
    """
    n = len(data)
    kind = CLASSES[data]
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = kind == SPACE
    if words:
        start |= kind == DIGIT
        at = np.flatnonzero(start)
        ends = np.append(at[1:], n)
        keep = ~blank[at]
        return at[keep], ends[keep]
    last = np.zeros(n, dtype=bool)  # white space right before another character of the same text
    last[:-1] = blank[:-1] & ~blank[1:] & ~first[1:n]
    start |= last
    glued = np.flatnonzero(last & (data == 32)) + 1
    start[glued] = False
    at = np.flatnonzero(start)
    return at, np.append(at[1:], n)


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others in order from code point 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Known:
    """Sorted 64-bit hashes, each with a number: what the pieces of earlier texts were given."""

    def __init__(self):
        self.hash, self.value = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where there is none."""
        if not len(self.hash):
            return np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, self.value[at], -1)

    def add(self, h: np.ndarray, value: np.ndarray) -> None:
        """Hashes in ascending order that are not there yet."""
        at = np.searchsorted(self.hash, h)
        self.hash, self.value = np.insert(self.hash, at, h), np.insert(self.value, at, value)


class TokenIds:
    """Ids of texts; null text counts as empty. At most about ``limit`` pieces are kept, as hashes and ids
    in arrays (some 40 bytes a piece)."""

    def __init__(self, path: str, limit: int = 1_500_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.words = "Lowercase" in str(self.library.normalizer)
        self.merges = Tokenizer(self.library.model)  # the merges alone: pieces come cut and byte-mapped
        self.characters = str.maketrans(dict(enumerate(_byte_characters())))
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.ids, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.begin, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def learn(self, pieces: list[bytes]) -> None:
        """Append the ids of pieces, in order."""
        for at in range(0, len(pieces), 5_000):
            part = [p.decode("latin-1").translate(self.characters) for p in pieces[at:at + 5_000]]
            e = self.merges.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, dtype=np.uint32)
            size = np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(part))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            self.begin = np.append(self.begin, self.used + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.used += len(ids)

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all plain texts in a row, number of ids of each)."""
        data, bounds = join_bytes([t.lower() for t in texts] if self.words else texts)
        starts, ends = cut(data, bounds, self.words)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        if len(self.begin) > self.limit or self.used > 8 * self.limit:
            self.forget()
        hashes, at, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        entry = self.known.find(hashes)
        new = np.flatnonzero(entry < 0)
        a, b = starts[at[new]], ends[at[new]]
        raw = data.tobytes()
        entry[new] = len(self.begin) + np.arange(len(new))
        self.learn([raw[x:y] for x, y in zip(a.tolist(), b.tolist())])
        short = new[b - a <= 64]
        self.known.add(hashes[short], entry[short])
        entry = entry[which]
        n = self.size[entry]
        upto = np.cumsum(n)
        ids = self.ids[np.repeat(self.begin[entry] - (upto - n), n) + np.arange(upto[-1])]
        cuts = np.append(0, upto)[np.searchsorted(starts, bounds)]
        return ids, np.diff(cuts)

    def many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin, with the end at last)."""
        plain = np.array([not t or not (NOT_PLAIN.search(t) or "<|" in t) for t in texts], dtype=bool)
        ids, sizes = self.plain([t or "" for t, p in zip(texts, plain) if p])
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[plain] = sizes
        if not plain.all():
            own = {i: self.whole(texts[i]) for i in np.flatnonzero(~plain).tolist()}
            cuts, parts, k = np.append(0, np.cumsum(sizes)), [], 0
            for i, p in enumerate(plain.tolist()):
                if p:
                    parts.append(ids[cuts[k]:cuts[k + 1]])
                    k += 1
                else:
                    parts.append(own[i])
                    counts[i] = len(own[i])
            ids = np.concatenate(parts) if parts else ids
        return ids, np.append(0, np.cumsum(counts))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]


def groups(texts: list[str | None], chars: int = 2_000_000):
    """Slices of ``texts`` of about ``chars`` characters each: (start, end)."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= chars:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=4)
def token_ids(path: str) -> TokenIds:
    """One encoder a worker process and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return TokenIds(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
