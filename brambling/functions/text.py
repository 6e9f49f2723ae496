"""Text functions as column expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the plain letters they fold to, by position.
MARKED = "àáâãäåāăąçćčďđèéêëēĕėęěìíîïĩīĭįğĝģñńňòóôõöøōŏőŕřśşšťţùúûüũūŭůűųýÿźżžłßÀÁÂÃÄÅĀĂĄÇĆČĎĐÈÉÊËĒĔĖĘĚÌÍÎÏĨĪĬĮĞĜĢÑŃŇÒÓÔÕÖØŌŎŐŔŘŚŞŠŤŢÙÚÛÜŨŪŬŮŰŲÝŸŹŻŽŁ"
PLAIN = "aaaaaaaaacccddeeeeeeeeeiiiiiiiigggnnnooooooooorrsssttuuuuuuuuuuyyzzzlsAAAAAAAAACCCDDEEEEEEEEEIIIIIIIIGGGNNNOOOOOOOOORRSSSTTUUUUUUUUUUYYZZZL"


def fold_accents(c: Column) -> Column:
    """Letters without marks; combining marks that stand alone are dropped. Plain texts are passed through, which is several times as fast."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(c, MARKED, PLAIN), r"\p{M}+", "")).otherwise(c)


def folded(c: Column) -> Column:
    """A text in small letters and digits without marks, with single blanks between words; may be empty."""
    return F.trim(F.regexp_replace(F.lower(fold_accents(c)), r"[^\p{L}\p{N}]+", " "))


def norm_title(c: Column) -> Column:
    """Title in small letters and digits with single blanks; null where nothing is left."""
    t = folded(c)
    return F.when(t != "", t)


def author_key(last: Column, fore: Column) -> Column:
    """Surname and first initial: `surname-x`, without marks, hyphens, blanks and apostrophes; null without a surname."""
    plain = lambda c: F.regexp_replace(F.lower(fold_accents(c)), r"[^\p{L}\p{N}]+", "")
    s = plain(last)
    return F.when(s != "", F.concat(s, F.lit("-"), F.coalesce(F.substring(plain(fore), 1, 1), F.lit(""))))


def year_of(c: Column) -> Column:
    """First four-digit year of a text, null if there is none."""
    y = F.regexp_extract(c, r"(?<!\d)(\d{4})(?!\d)", 1)
    return F.when(y != "", y).cast("int")


def tokens(c: Column) -> Column:
    """Words of three letters or more in small letters, of any script; hyphens inside are kept."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{M}\p{N}]+(?:-[\p{L}\p{M}\p{N}]+)*)"), 1), lambda t: F.length(t) >= 3)


def words(c: Column) -> Column:
    """Words for phrase matching: small letters and digits without marks."""
    return F.filter(F.split(F.coalesce(folded(c), F.lit("")), " "), lambda w: w != "")


def ngrams(w: Column, n: int) -> Column:
    """All runs of n neighbours of an array of words, joined by blanks."""
    if n == 1:
        return w
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


def phrases(c: Column, longest: int) -> Column:
    """All runs of 1 to `longest` neighbouring words of a text; the words are found once."""
    return F.flatten(F.transform(F.array(words(c)), lambda w: F.concat(*[ngrams(w, k) for k in range(1, longest + 1)])))
