"""Vocabulary files of public tokenizers (their path is a parameter) and the pre-token patterns."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

# The printable stand-ins of bytes in byte-level vocabularies
_PRINTED = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
# Contractions that both patterns try first, in this order
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# The Unicode White_Space property
WHITE_SPACE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> dict[int, str]:
    """byte -> its stand-in character."""
    out, extra = {}, 256
    for b in range(256):
        if b in _PRINTED:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def _ranges(major: str, top: int) -> str:
    parts, start = [], None
    for c in range(top + 2):
        hit = c <= top and unicodedata.category(chr(c))[0] == major
        if hit and start is None:
            start = c
        elif not hit and start is not None:
            parts.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(parts)


@lru_cache(maxsize=1)
def split_patterns() -> dict[str, tuple[str, str]]:
    """The two pre-token patterns with exact letter and number classes for Python's ``re``: for texts
    below U+10000 (their classes are bitmaps, which is fast), and for any text."""
    out: dict[str, tuple[str, str]] = {"spaced": (), "bare": ()}
    space, solid = f"[{WHITE_SPACE}]", f"[^{WHITE_SPACE}]"
    for top in (0xFFFF, sys.maxunicode):
        letters, numbers = _ranges("L", top), _ranges("N", top)
        other = f"[^{WHITE_SPACE}{letters}{numbers}]"
        out["spaced"] += (f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?{other}+|{space}+(?!{solid})|{space}+",)
        out["bare"] += (f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|{other}+",)
    return out


def finder(patterns: tuple[str, str]):
    """A function text -> list of pre-tokens."""
    short, whole = (re.compile(p).findall for p in patterns)
    return lambda t: short(t) if t.isascii() or len(t.encode("utf-16-le", "surrogatepass")) == 2 * len(t) else whole(t)


def load(path: str) -> dict:
    """Merges as (left id, right id) -> (rank, new id), token strings, special tokens of a BPE json file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    merges = {}
    for rank, m in enumerate(spec["model"]["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        merges[(vocab[a], vocab[b])] = (rank, vocab[a + b])
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {"vocab": vocab, "merges": merges, "special": special,
            "suffix": spec["model"].get("end_of_word_suffix") or ""}


def split_specials(text: str, special: dict[str, int]) -> list:
    """Pieces of ``text``: strings, and the ids of special tokens found in it (leftmost, longest first)."""
    if not any(s in text for s in special):
        return [text]
    pattern = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))
    out, at = [], 0
    for m in re.finditer(pattern, text):
        out += [text[at:m.start()], special[m.group()]]
        at = m.end()
    return [*out, text[at:]]
