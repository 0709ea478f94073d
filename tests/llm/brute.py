"""Plain single-process versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter

GAP = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1
               for k in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)


def base_spans(text):
    """Base secret spans as (start, kind order, end, kind)."""
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text)
            if len(m[0]) >= 32]
    return sorted(out)


def base_digest(text):
    return sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in base_spans(text)))


def crc32_ids(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
