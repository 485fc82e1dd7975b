"""Porter's stemming algorithm of 1980, as a vectorised function that stems each different token once."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffix rules of steps 2, 3 and 4 of the paper.
STEP_2 = "ational ate|tional tion|enci ence|anci ance|izer ize|abli able|alli al|entli ent|eli e|ousli ous|ization ize|ation ate|ator ate|alism al|iveness ive|fulness ful|ousness ous|aliti al|iviti ive|biliti ble"
STEP_3 = "icate ic|ative |alize al|iciti ic|ical ic|ful |ness "
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
_TWO, _THREE = ([tuple(p.split(" ")) for p in s.split("|")] for s in (STEP_2, STEP_3))
_FOUR = sorted(STEP_4.split(), key=len, reverse=True)


def _form(w: str) -> str:
    """c and v for each letter; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(w):
        out += "v" if ch in "aeiou" or (ch == "y" and i > 0 and out[i - 1] == "c") else "c"
    return out


def _measure(w: str) -> int:
    return len(re.findall("v+c+", _form(w)))


def _double(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _form(w)[-1] == "c"


def _cvc(w: str) -> bool:
    return _form(w)[-3:] == "cvc" and w[-1] not in "wxy"


def stem_word(w: str) -> str:
    if len(w) <= 2 or not w.isascii():
        return w
    for end, to in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(end):
            w = w[: len(w) - len(end)] + to
            break
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        for end in ("ed", "ing"):
            base = w[: -len(end)]
            if w.endswith(end) and "v" in _form(base):
                w = base
                if w.endswith(("at", "bl", "iz")) or (_measure(w) == 1 and _cvc(w)):
                    w += "e"
                elif _double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                break
    if w.endswith("y") and "v" in _form(w[:-1]):
        w = w[:-1] + "i"
    for rules in (_TWO, _THREE):
        for end, to in sorted(rules, key=lambda r: -len(r[0])):
            if w.endswith(end):
                if _measure(w[: -len(end)]) > 0:
                    w = w[: -len(end)] + to
                break
    for end in _FOUR:
        if w.endswith(end):
            base = w[: -len(end)]
            if _measure(base) > 1 and (end != "ion" or base.endswith(("s", "t"))):
                w = base
            break
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    return w[:-1] if _measure(w) > 1 and _double(w) and w[-1] == "l" else w


@F.pandas_udf(T.StringType())
def stem(x: pd.Series) -> pd.Series:
    known: dict[str, str] = {}

    def of(w: str) -> str:
        if w not in known:
            known[w] = stem_word(w)
        return known[w]

    return x.map(lambda s: None if s is None else " ".join(of(w) for w in s.split()))
