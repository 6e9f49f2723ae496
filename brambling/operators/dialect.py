"""Several values packed in one field: the cheapest delimiter-and-quote parse by description length (problem 7)."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import cut

# Delimiters by name. A full stop delimits before a blank only, a stroke between blanks only; list marks delimit before themselves.
DELIMITERS = {
    "semicolon": r"\s*;[\s;]*",
    "bar": r"\s*\|[\s|]*",
    "stroke": r"\s+/\s+",
    "line": r"\s*[\r\n\x85  ]\s*",
    "stop": r"(?<=\.)\s+",
    "quotes": r'(?<=")\s*,?\s*(?=")',
    "square": r"\s+(?=\[\d{1,3}\])",
    "round": r"\s+(?=\(?\d{1,3}\)\s)",
    "number": r"\s+(?=\d{1,3}\.\s)",
}
_CUT = re.compile("|".join(f"(?P<{k}>{v})" for k, v in DELIMITERS.items()))
_ADDRESS = re.compile(r"[\s;,.]*(?:e-?mail|electronic)(?:\s+address)?\s*:?\s*\S+@\S+|[\s;,]*\S+@[\w-]+\.[\w.-]*\w", re.IGNORECASE)
_MARK = re.compile(r"^(?:\[\d{1,3}\]|\(?\d{1,3}\)|\d{1,3}\.(?=\s))\s*")
_LETTER = re.compile(r"^\(?([a-z])[).]?\s+")
_ENDS = " \t\r\n\f\v   ​﻿"

NOVEL, PER_CHAR, PER_CUT, OPEN_END, PER_DIALECT = 12.0, 5.0, 3.0, 120.0, 2.0


def value_of(text: str) -> str:
    """A comma-separated component as it is counted."""
    return " ".join(text.casefold().split()).strip(' .;"')


def without_address(text: str) -> str:
    """The text with electronic addresses blanked out; they belong to no value."""
    return _ADDRESS.sub("", text) if "@" in text else text


def tidy(part: str) -> str:
    """A value without outer blanks, enclosing quotes, list mark and final full stop or delimiter."""
    old = None
    while part != old:
        old = part
        part = part.strip(_ENDS + ";,|")
        if len(part) > 1 and part[0] == part[-1] == '"':
            part = part[1:-1]
        elif len(part) > 2 and part[0] == '"' and part[-2:] in ('".', '",', '";'):
            part = part[1:-2]
        if part.endswith("."):
            part = part[:-1]
        part = _MARK.sub("", part)
    return part


class Parser:
    """Parses fields by code lengths in bits: `ends` and `inner` give those of known last and other components; any other
    component is spelled out. A value without a known last component costs OPEN_END on top."""

    def __init__(self, ends: dict[str, float], inner: dict[str, float]) -> None:
        # in whole parts of 2^-20 bits sums are exact, whatever their order
        exact = lambda d: {k: round(v * 2**20) / 2**20 for k, v in d.items()}
        self.ends, self.inner = exact(ends), exact(inner)

    def _inner(self, component: str) -> float:
        v = value_of(_MARK.sub("", component.lstrip(_ENDS + '"')))
        return min(self.inner.get(v, math.inf), NOVEL + PER_CHAR * len(v))

    def _last(self, component: str) -> float:
        v = value_of(component)
        known = self.ends.get(v)
        return known if known is not None else NOVEL + PER_CHAR * len(v) + OPEN_END

    def length(self, segment: str) -> float:
        *first, last = segment.split(",")
        if not first:
            return NOVEL + PER_CHAR * len(value_of(last)) + OPEN_END
        return sum(map(self._inner, first)) + self._last(last)

    def _parse(self, text: str, quoted: bool) -> tuple[float, list[str], frozenset[str]]:
        """The cheapest division at the delimiters of `text` (outside quotes, where `quoted`), by dynamic programming over all of them.

        The length of a segment is that of its first component, of the whole ones between its commas, which are added up beforehand, and of
        its last one. For one end the search goes back as long as the whole components alone don't cost more than the best division
        found; what lies before can't be cheaper.
        """
        cuts: list[tuple[int, int, str]] = [(0, 0, "")]
        inside = False
        at = 0
        for m in _CUT.finditer(text):
            if quoted:
                inside ^= text.count('"', at, m.start()) % 2 == 1
                at = m.start()
                if inside:
                    continue
            if 0 < m.start() and m.end() < len(text):
                cuts.append((m.start(), m.end(), m.lastgroup or ""))
        cuts.append((len(text), len(text), ""))
        commas = [k for k, c in enumerate(text) if c == ","]
        whole = [0.0]  # of the components before each comma but the first
        for x, y in zip(commas, commas[1:], strict=False):
            whole.append(whole[-1] + self._inner(text[x + 1 : y]))
        after = [bisect_left(commas, c[1]) for c in cuts]  # first comma behind a cut
        first = [self._inner(text[c[1] : commas[k]]) if k < len(commas) else 0.0 for c, k in zip(cuts, after, strict=True)]
        # signs that a value certainly keeps, up to each place; of blanks one in a row, but for those at its ends
        plain = [0, *accumulate((c not in '.;"') if not c.isspace() else not b.isspace() for b, c in zip(" " + text, text, strict=False))] if len(commas) < len(cuts) else [0] * (len(text) + 1)
        best: list[tuple[float, int]] = [(0.0, -1)]
        for j in range(1, len(cuts)):
            end = cuts[j][0]
            n = bisect_left(commas, end)
            last = self._last(text[commas[n - 1] + 1 : end]) if n else 0.0
            found = (math.inf, -1)
            for i in (0, *range(j - 1, 0, -1)):
                k = after[i]
                if k < n:
                    between = whole[n - 1] - whole[k] + last
                    if i and between > found[0]:
                        break
                    bits = first[i] + between
                elif best[i][0] + NOVEL + OPEN_END + PER_CHAR * (plain[end] - plain[cuts[i][1]] - 2) > found[0]:
                    continue
                else:
                    bits = self.length(text[cuts[i][1] : end])
                found = min(found, (best[i][0] + bits + (PER_CUT if i else 0.0), i))
            best.append(found)
        parts, kinds, j = [], set(), len(cuts) - 1
        while j > 0:
            i = best[j][1]
            parts.append(text[cuts[i][1] : cuts[j][0]])
            kinds.add(cuts[i][2])
            j = i
        kinds.discard("")
        return best[-1][0] + PER_DIALECT * len(kinds) + (PER_DIALECT if quoted else 0.0), parts[::-1], frozenset(kinds)

    def parse(self, text: str | None) -> list[str]:
        """The values of a field, tidied, in order; none for null and blank fields."""
        if text is None:
            return []
        body = without_address(text).strip(_ENDS)
        if not body.strip(' ".;,|'):
            return []
        tries = [self._parse(body, False)]
        if '"' in body:
            tries.append(self._parse(body, True))
        parts = [p for p in min(tries, key=lambda t: t[0])[1] if p.strip(' ".;,|\r\n')]
        parts = [tidy(p) for p in parts]
        marks = [_LETTER.match(p) for p in parts]
        if len(parts) > 1 and all(m and m[1] == chr(97 + i) for i, m in enumerate(marks)):
            parts = [p[m.end() :] for p, m in zip(parts, marks, strict=True)]
        return [p for p in parts if p]


def code_lengths(df: DataFrame, col: str, share: float = 1e-4) -> tuple[dict[str, float], dict[str, float]]:
    """Bits of the last and of the other components of all fields, by their shares of all occurrences. Only values of at
    least `share` of them get a code of their own, so each table holds 1 / share entries at most. A component in which a delimiter
    occurs gets none: whether it is one value is what the codes are to decide."""

    def components(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            ends, inner = [], []
            for t in s:
                *first, last = without_address(t).strip(_ENDS + ".;,").split(",") if t else [""]
                ends.append(value_of(last) if first else None)
                inner.append([value_of(x) for x in first if not _CUT.search(x.strip(_ENDS))])
            yield pd.DataFrame({"last": ends, "inner": inner})

    parts = df.select(F.pandas_udf(components, "last string, inner array<string>")(F.col(col)).alias("c"))
    long = parts.select(F.explode(F.concat(F.array(F.struct(F.lit(True).alias("is_end"), F.col("c.last").alias("v"))), F.transform("c.inner", lambda x: F.struct(F.lit(False).alias("is_end"), x.alias("v"))))).alias("x")).select("x.*")
    counts = long.where("v IS NOT NULL AND v <> ''").groupBy("is_end", "v").agg(F.count("*").alias("n"))
    counts = cut(counts, "values")
    total = {r[0]: r[1] for r in counts.groupBy("is_end").agg(F.sum("n")).collect()}
    out: tuple[dict[str, float], dict[str, float]] = ({}, {})
    for is_end, v, n in counts.where(F.col("n") >= F.when(F.col("is_end"), total.get(True, 0) * share).otherwise(total.get(False, 0) * share)).collect():
        out[0 if is_end else 1][v] = -math.log2(n / total[is_end])
    return out


def with_values(df: DataFrame, col: str, out: str = "values", share: float = 1e-4) -> DataFrame:
    """Add array<string> of the values packed in `col`: one per value in order, none for null or blank fields."""
    lengths = df.sparkSession.sparkContext.broadcast(code_lengths(df, col, share))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        p = Parser(*lengths.value)
        for s in batches:
            yield pd.Series([p.parse(x) for x in s], index=s.index, dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "array<string>")(F.col(col)))
