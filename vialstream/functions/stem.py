"""Porter2 stems, and a rule lemmatiser, as Arrow-batched functions over word arrays."""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_V = "aeiouy"
_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
# Fixed values of the published algorithm.
_SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
_SAME = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes", "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful", "lessli": "less"}
_STEP3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic")


def _regions(w: str) -> tuple[int, int]:
    m = re.match(r"gener|commun|arsen", w)
    r1 = m.end() if m else (m.end() if (m := re.search(r"[aeiouy][^aeiouy]", w)) else len(w))
    m = re.search(r"[aeiouy][^aeiouy]", w[r1:])
    return r1, r1 + m.end() if m else len(w)


def _short_end(w: str) -> bool:
    return bool(re.search(r"[^aeiouy][aeiouy][^aeiouywxY]$", w) or re.fullmatch(r"[aeiouy][^aeiouy]", w))


@functools.lru_cache(maxsize=200_000)
def porter2(word: str) -> str:
    w = word.lower()
    if len(w) < 3:
        return w
    if w in _SPECIAL:
        return _SPECIAL[w]
    if w in _SAME:
        return w
    w = w.removeprefix("'")
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = re.sub(r"(?<=[aeiouy])y", "Y", w)
    r1, r2 = _regions(w)
    for s in ("'s'", "'s", "'"):
        if w.endswith(s):
            w = w[: -len(s)]
            break
    # 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith(("us", "ss")):
        pass
    elif w.endswith("s") and re.search(r"[aeiouy].+$", w[:-1]):
        w = w[:-1]
    if w.lower() in _SAME:
        return w.lower()
    # 1b
    for s in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(s):
            if s in ("eed", "eedly"):
                if len(w) - len(s) >= r1:
                    w = w[: -len(s)] + "ee"
            elif re.search(r"[aeiouy]", w[: -len(s)]):
                w = w[: -len(s)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif w.endswith(_DOUBLE):
                    w = w[:-1]
                elif _short_end(w) and r1 >= len(w):
                    w += "e"
            break
    # 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _V:
        w = w[:-1] + "i"
    # 2
    for s in sorted([*_STEP2, "ogi", "li"], key=lambda s: -len(s)):
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                if s == "ogi":
                    w = w[:-1] if w[-4:-3] == "l" else w
                elif s == "li":
                    w = w[:-2] if w[-3:-2] in tuple("cdeghkmnrt") else w
                else:
                    w = w[: -len(s)] + _STEP2[s]
            break
    # 3
    for s in sorted([*_STEP3, "ative"], key=lambda s: -len(s)):
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                if s == "ative":
                    w = w[:-5] if len(w) - 5 >= r2 else w
                else:
                    w = w[: -len(s)] + _STEP3[s]
            break
    # 4
    for s in sorted([*_STEP4, "ion"], key=lambda s: -len(s)):
        if w.endswith(s):
            if len(w) - len(s) >= r2 and (s != "ion" or w[-4:-3] in ("s", "t")):
                w = w[: -len(s)]
            break
    # 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


_IRREGULAR = {"was": "be", "were": "be", "is": "be", "are": "be", "been": "be", "has": "have", "had": "have", "did": "do", "does": "do", "children": "child", "men": "man", "women": "woman", "feet": "foot", "teeth": "tooth", "worse": "bad", "better": "good"}


def lemma(word: str, kind: str) -> str:
    """A dictionary form by part of speech: N(oun), V(erb), A(djective)."""
    w = word.lower()
    if w in _IRREGULAR:
        return _IRREGULAR[w]
    if kind == "N":
        for a, b in (("ies", "y"), ("sses", "ss"), ("xes", "x"), ("ches", "ch"), ("shes", "sh")):
            if w.endswith(a) and len(w) > len(a) + 1:
                return w[: -len(a)] + b
        return w[:-1] if w.endswith("s") and not w.endswith(("ss", "us", "is")) and len(w) > 3 else w
    if kind == "V":
        for a, b in (("ying", "y"), ("ied", "y"), ("ies", "y")):
            if w.endswith(a) and len(w) > len(a) + 1:
                return w[: -len(a)] + b
        for a in ("ing", "ed"):
            if w.endswith(a) and len(w) > len(a) + 2:
                s = w[: -len(a)]
                return s[:-1] if len(s) > 3 and s[-1] == s[-2] and s[-1] not in "ls" else s
        return w[:-1] if w.endswith("s") and not w.endswith("ss") and len(w) > 3 else w
    for a in ("iest", "ier"):
        if w.endswith(a) and len(w) > len(a) + 1:
            return w[: -len(a)] + "y"
    return w


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stems(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: None if ws is None else [porter2(w) for w in ws])


def stem_words(words: Column) -> Column:
    """Porter2 stems of a word array, in Arrow batches."""
    return _stems(words)
