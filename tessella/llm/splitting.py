"""Pre-tokeniser patterns, compiled twice.

Patterns with Unicode properties need the regex module. Over a plain repertoire (printable ASCII, tab and line ends,
precomposed Latin, common punctuation) each property is a short list of ranges, and the standard module finds the same
matches in half the time. A text with any other sign goes to the regex module.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable

import regex

PLAIN = "\t\n\x0b\x0c\r -~\xa1-\xac\xae-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20ac"
odd = re.compile(f"[^{PLAIN}]").search


def _ranges(category: str) -> str:
    inside = re.compile(f"[{PLAIN}]").match
    signs = [k for k in range(0x2100) if inside(chr(k)) and unicodedata.category(chr(k))[0] == category]
    out, k = "", 0
    while k < len(signs):
        j = k
        while j + 1 < len(signs) and signs[j + 1] == signs[j] + 1:
            j += 1
        out += re.escape(chr(signs[k])) + ("-" + re.escape(chr(signs[j])) if j > k else "")
        k = j + 1
    return out


def compiled(pattern: str) -> Callable[[str], list[str]]:
    """findall of a pattern that uses no properties but letters and numbers (others: the regex module alone)."""
    full = regex.compile(pattern).findall
    bare = re.sub(r"\\p\{([LN])\}", "", pattern)
    if "\\p" in bare or "\\P" in bare or sys.version_info < (3, 11):
        return full
    ranges = {c: _ranges(c) for c in "LN"}
    out, depth, k = "", 0, 0
    while k < len(pattern):
        if m := re.compile(r"\\p\{([LN])\}").match(pattern, k):
            out += ranges[m[1]] if depth else f"[{ranges[m[1]]}]"
            k = m.end()
            continue
        if pattern[k] == "\\":
            out += pattern[k : k + 2]
            k += 2
            continue
        depth += (pattern[k] == "[") - (pattern[k] == "]")
        out += pattern[k]
        k += 1
    fast = re.compile(out).findall
    return lambda text: full(text) if odd(text) else fast(text)
