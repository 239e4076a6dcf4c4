"""Text expressions: folding, keys, shingles, similarity, chunks. Built-ins wherever they can say it."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that titles are compared without.
TITLE_STOPWORDS = ["the", "a", "an", "and", "of", "in", "at", "with", "en", "die", "van", "concert", "konsert", "presents", "2025", "2026", "2027", "2028"]
#: A keyword's stem at a word's start, or a whole word.
KEYWORD_STEMS = ["orchestr", "orkes", "philharmon", "filharmon", "symphon", "simfon", "conservator", "konservator", "orrel", "koor"]
KEYWORDS = [
    "concerto", "concertos", "sonata", "sonatas", "quartet", "kwartet", "quintet", "trio", "chamber music", "kamermusiek",
    "choir", "choirs", "kore", "choral", "chorale", "opera", "operas", "operetta", "oratorio", "recital", "resital",
    "cantata", "kantate", "requiem", "messiah", "organ", "organist", "baroque", "barok", "classical", "klassiek",
    "piano", "pianist", "klavier", "violin", "violinist", "viool", "cello", "cellist", "soprano", "mezzo", "mezzo-soprano",
    "baritone", "countertenor", "eisteddfod", "bach", "mozart", "beethoven", "brahms", "handel", "haydn", "vivaldi",
    "chopin", "schubert", "tchaikovsky", "rachmaninov", "rachmaninoff", "mahler", "dvorak", "dvořák", "verdi", "puccini",
]


def _base(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not "̀" <= x <= "ͯ")


def _latin() -> tuple[str, str]:
    """Latin letters with marks and their single base letters, by Unicode's own decompositions."""
    pairs = [(c, _base(c)) for c in map(chr, range(0xC0, 0x250)) if len(_base(c)) == 1 and _base(c) != c]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _PLAIN = _latin()


def fold(text: Column, exact: bool = False) -> Column:
    """Without diacritics. Latin letters are folded in the JVM; `exact` decomposes all of Unicode, through Arrow."""
    if not exact:
        return F.regexp_replace(F.translate(text, _MARKED, _PLAIN), "[̀-ͯ]", "")

    @F.pandas_udf("string")
    def decomposed(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.replace("[̀-ͯ]", "", regex=True)

    return decomposed(text)


def normalise(text: Column, exact: bool = False) -> Column:
    """Lower case, without diacritics, quotes and punctuation, single spaces."""
    plain = F.regexp_replace(F.lower(fold(text, exact)), "[’'`]", "")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def slug(text: Column, exact: bool = False) -> Column:
    return F.replace(normalise(text, exact), F.lit(" "), F.lit("-"))


def words(text: Column, exact: bool = False) -> Column:
    """Normalised words; none of an empty text."""
    return F.array_remove(F.split(normalise(text, exact), " "), "")


def first_words(text: Column, n: int = 6) -> Column:
    return F.array_join(F.slice(words(text), 1, n), " ")


def shingles(ws: Column, n: int) -> Column:
    """All spans of n words of an array column, in order; none if there are fewer."""
    spans = F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.array_join(F.slice(ws, i, n), " "))
    return F.when(F.size(ws) >= n, spans).otherwise(F.array().cast("array<string>"))


def _bigrams(squashed: Column) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.length(squashed) - 1), lambda i: F.substr(squashed, i, F.lit(2)))
    return F.when(F.length(squashed) >= 2, grams).otherwise(F.array().cast("array<string>"))


def _given(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def shared_count(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two array columns; nulls are shared with nothing. Both are sorted and merged in one pass."""
    place = lambda i, j, n: F.struct(i.alias("i"), j.alias("j"), n.alias("n"))

    def merged(x: Column, y: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            p, q = F.get(x, s["i"]), F.get(y, s["j"])  # null behind the end
            both = place(s["i"] + 1, s["j"] + 1, s["n"] + 1)
            return F.when(p == q, both).when(q.isNull() | (p > q), place(s["i"], s["j"] + 1, s["n"])).otherwise(place(s["i"] + 1, s["j"], s["n"]))

        return F.aggregate(F.array_repeat(F.lit(0), F.size(x) + F.size(y)), place(F.lit(0), F.lit(0), F.lit(0)), step, lambda s: s["n"])

    return _given(F.sort_array(a), lambda x: _given(F.sort_array(b), lambda y: merged(x, y)))


def multiset_f1(a: Column, b: Column) -> Column:
    """2 * shared / (size of both); 1 for two empty lists."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * shared_count(a, b) / total)


def dice(a: Column, b: Column) -> Column:
    """Dice over character bigrams, spaces left out; 1 for equal texts, 0 if either is empty."""
    x, y = (_bigrams(F.replace(s, F.lit(" "), F.lit(""))) for s in (a, b))
    total = F.size(x) + F.size(y)
    score = F.when(total == 0, F.lit(0.0)).otherwise(2.0 * shared_count(x, y) / total)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(score)


def title_similarity(a: Column, b: Column) -> Column:
    """The better of bigram Dice and weighted token containment of the shorter title, without stopwords."""
    stop = F.array(*map(F.lit, TITLE_STOPWORDS))
    ta, tb = (F.filter(words(t), lambda w: ~F.array_contains(stop, w)) for t in (a, b))
    small, other = F.when(F.size(ta) <= F.size(tb), ta).otherwise(tb), F.when(F.size(ta) <= F.size(tb), tb).otherwise(ta)
    share = F.size(F.filter(small, lambda w: F.array_contains(other, w))) / F.size(small)
    contained = share * F.when(F.size(small) >= 2, F.lit(0.95)).otherwise(F.lit(0.7))
    score = F.greatest(dice(F.array_join(ta, " "), F.array_join(tb, " ")), contained)
    return F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0)).otherwise(score)


def has_keyword(text: Column, stems: Sequence[str] = KEYWORD_STEMS, whole: Sequence[str] = KEYWORDS) -> Column:
    """Whether a stem starts a word, or a whole word occurs, in any case."""
    return text.rlike(rf"(?iu)(?<![\p{{L}}])(?:{'|'.join(stems)})|(?<![\p{{L}}])(?:{'|'.join(whole)})(?![\p{{L}}])")


def chunks(text: Column, most: int) -> Column:
    """Chunks of at most `most` characters, cut at form feeds if there are any, else at line starts.

    Pieces are packed while they fit; a longer piece ends the chunk before it and is sliced.
    """
    pages = F.split(text, "\f", -1)
    lines = F.split(text, r"\n(?=\S)", -1)
    pieces = F.when(F.contains(text, F.lit("\f")), pages).otherwise(lines)
    state = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))

    def closed(s: Column) -> Column:
        return F.when(s["cur"] != "", F.array_append(s["out"], s["cur"])).otherwise(s["out"])

    def sliced(u: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.length(u) - 1) / most).cast("int")), lambda i: F.substr(u, i * most + 1, F.lit(most)))

    def step(s: Column, u: Column) -> Column:
        full = (s["cur"] != "") & (F.length(s["cur"]) + F.length(u) + 1 > most)
        out = F.when(full, closed(s)).otherwise(s["out"])
        cur = F.when(full, F.lit("")).otherwise(s["cur"])
        fits = F.struct(F.when(cur != "", F.concat_ws("\n", cur, u)).otherwise(u).alias("cur"), out.alias("out"))
        cut = F.struct(cur.alias("cur"), F.concat(out, sliced(u)).alias("out"))
        return F.when(F.length(u) > most, cut).otherwise(fits)

    packed = F.aggregate(pieces, state, step, closed)
    return F.when(F.length(text) <= most, F.array(text)).otherwise(packed)
