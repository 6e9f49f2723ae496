"""Token ids of a public byte-level BPE vocabulary, by an index of pair occurrences (problem 8)."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"

# Fixed value: the word pattern of this vocabulary's public tokenizer.
WORD = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank (which is the id) by token bytes, of a vocabulary file with one base64 token and rank a line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


class Encoder:
    """Encodes many texts at once. Distinct words of the batch are merged together; words met before come from a memo of
    bounded size, which changes speed only."""

    def __init__(self, ranks: dict[bytes, int], memo_size: int = 400_000) -> None:
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.byte = [ranks[bytes([i])] for i in range(256)]
        self.pair_rank: dict[tuple[int, int], int | None] = {}
        self.memo: dict[str, list[int]] = {}
        self.memo_size = memo_size
        self.find = regex.compile(WORD).findall

    def _rank(self, a: int, b: int) -> int | None:
        k = (a, b)
        try:
            return self.pair_rank[k]
        except KeyError:
            r = self.pair_rank[k] = self.ranks.get(self.token[a] + self.token[b])
            return r

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. All words' symbols lie in one sequence; `where` maps the rank of each mergeable pair to the
        positions of its occurrences. Active ranks are taken in ascending order from a heap, each one's positions from left
        to right; a merge rewrites its two neighbours' pairs and adds their positions. Positions overtaken by an earlier
        merge no longer have the rank and are passed over."""
        sym: list[int] = []
        starts: list[int] = []
        for w in words:
            starts.append(len(sym))
            sym.extend(self.byte[x] for x in w.encode("utf-8", "replace"))
            sym.append(-1)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        where: dict[int, list[int]] = {}
        rank = self._rank
        for i in range(n - 1):
            a, b = sym[i], sym[i + 1]
            if a >= 0 and b >= 0 and (r := rank(a, b)) is not None:
                where.setdefault(r, []).append(i)
        heap = list(where)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            for i in sorted(where.pop(r)):
                a = sym[i]
                if a < 0:
                    continue
                j = nxt[i]
                b = sym[j]
                if b < 0 or rank(a, b) != r:
                    continue
                sym[i], sym[j] = r, -2
                k = nxt[i] = nxt[j]
                prv[k] = i
                p = prv[i]
                for left, x, y in ((p, sym[p] if p >= 0 else -1, r), (i, r, sym[k])):
                    if x >= 0 and y >= 0 and (q := rank(x, y)) is not None:
                        if q in where:
                            where[q].append(left)
                        else:
                            where[q] = [left]
                            heapq.heappush(heap, q)
        out = []
        for s in starts:
            ids, i = [], s
            while sym[i] >= 0:
                ids.append(sym[i])
                i = nxt[i]
            out.append(ids)
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; an empty list for null and empty texts. What looks like a special token is plain text."""
        split = [self.find(t) if t else [] for t in texts]
        if len(self.memo) > self.memo_size:
            self.memo.clear()
        memo = self.memo
        fresh = list({w: None for ws in split for w in ws if w not in memo})
        memo.update(zip(fresh, self.merge(fresh), strict=True))
        return [[i for w in ws for i in memo[w]] for ws in split]


def with_ids(df: DataFrame, text_col: str, out_col: str = "ids", tokenizer_dir: str = TOKENIZER_DIR, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """Add the token ids of `text_col` as array<int>; an empty list for null and empty texts. Whole texts, no shuffle.

    The vocabulary (fixed size, under 1 MB) is read on the driver and broadcast.
    """
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(f"{tokenizer_dir}/{vocabulary}.tiktoken"))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = Encoder(ranks.value)
        for s in batches:
            yield pd.Series(enc.encode(s.tolist()), index=s.index, dtype=object)

    return df.withColumn(out_col, F.pandas_udf(run, "array<int>")(F.col(text_col)))
