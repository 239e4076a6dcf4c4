"""Title similarity outside Spark, for pairs inside a block; equals functions.text.title_similarity."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

from tessel.functions.text import TITLE_STOPWORDS

_STOP = frozenset(TITLE_STOPWORDS)


@lru_cache(100_000)
def normalise(text: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not "̀" <= c <= "ͯ").lower()
    plain = re.sub("[’'`]", "", plain)
    return " ".join("".join(c if unicodedata.category(c)[0] in "LN" else " " for c in plain).split())


@lru_cache(100_000)
def _parts(title: str) -> tuple[tuple[str, ...], Counter]:
    tokens = tuple(w for w in normalise(title).split() if w not in _STOP)
    joined = "".join(tokens)
    return tokens, Counter(a + b for a, b in zip(joined, joined[1:], strict=False))


def title_similarity(a: str, b: str) -> float:
    (ta, ga), (tb, gb) = _parts(a), _parts(b)
    if not ta or not tb:
        return 0.0
    if ta == tb:
        dice = 1.0
    else:
        total = ga.total() + gb.total()
        dice = 2 * (ga & gb).total() / total if total else 0.0
    small, other = (ta, set(tb)) if len(ta) <= len(tb) else (tb, set(ta))
    share = sum(w in other for w in small) / len(small)
    return max(dice, share * (0.95 if len(small) >= 2 else 0.7))
