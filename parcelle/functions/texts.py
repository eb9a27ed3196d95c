"""Accent folding and tokenising."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.params import STOPWORDS


def _folding_table() -> tuple[str, str, dict[str, str]]:
    """Every character whose decomposition is one ASCII letter plus marks, by rule, and those with several.

    Bare combining marks come last with no counterpart, so ``translate`` drops them.
    """
    letters, plain, several = [], [], {}
    for point in [*range(0x80, 0xD800), *range(0xE000, 0x20000)]:
        char = chr(point)
        base = "".join(c for c in unicodedata.normalize("NFKD", char.lower()) if not unicodedata.combining(c))
        if len(base) == 1 and "a" <= base <= "z":
            letters.append(char)
            plain.append(base)
        elif len(base) > 1 and any("a" <= b <= "z" for b in base):
            several[char] = base
    marks = [chr(p) for p in range(0x0300, 0x0370) if unicodedata.combining(chr(p))]
    return "".join(letters + marks), "".join(plain), several


_ACCENTED, _PLAIN, _SEVERAL = _folding_table()
# Letters that stand for several in ordinary text: ligatures and digraphs.
_LIGATURES = {c: b for c, b in _SEVERAL.items() if b.isalpha() and b.isascii()}


# Stands for any of these until a text is known to hold one.
_MARKER = "\ue000"
_WITH_MARKERS = _ACCENTED[: len(_PLAIN)] + "".join(_LIGATURES) + _ACCENTED[len(_PLAIN) :]


def fold_accents(c: Column) -> Column:
    """Lower case without accents, ligatures spelt out. One ``translate`` does all texts without a ligature."""
    text = F.lower(c.cast("string"))
    folded = F.translate(text, _WITH_MARKERS, _PLAIN + _MARKER * len(_LIGATURES))
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(b).alias("b")) for c, b in _LIGATURES.items()])
    spelt = F.aggregate(pairs, text, lambda x, p: F.replace(x, p.c, p.b))
    # replacements only run for rows that hold one of them
    return F.when(F.contains(folded, F.lit(_MARKER)), F.translate(spelt, _ACCENTED, _PLAIN)).otherwise(folded)


def tokens(c: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Runs of three or more plain letters, stop words left out."""
    words = F.regexp_extract_all(fold_accents(c), F.lit("[a-z]{3,}"), F.lit(0))
    if not stopwords:
        return words
    # Words shorter than three letters never reach the stop list.
    stops = [w for w in stopwords if len(w) >= 3]
    return F.filter(words, lambda w: ~w.isin(*stops))
