"""Spellings of names that mean one person (problem 2)."""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.llm.cooccur import MAX_BROADCAST, pair_counts
from brambling.runtime import attach, cut, discard, local

# Particles that come and go before a surname.
PARTICLES = frozenset("de del der den da dos du di la le van von bin al el".split())

_MARKS = regex.compile(r"\p{M}+")
_WORD = regex.compile(r"[\p{L}\p{M}'’ʼ‘`-]+")
_APOSTROPHE = regex.compile(r"['’ʼ‘`]")


def tokens(name: str) -> tuple[str, ...]:
    """The parts of a name in order: full parts in lower case without marks, initials as `x.`.

    A run of up to three capitals beside other letters is initials. A hyphen joins parts of one surname (`Abcd-Efgh`), but
    parts of which all are long, or the second begins small, are parts of their own. Particles are left out unless nothing
    else is there.
    """
    plain = unicodedata.normalize("NFKC", name)
    mixed = any(c.islower() for c in plain)
    out: list[str] = []
    for segment in plain.split(","):
        words = _WORD.findall(segment)
        short = any(c.islower() for c in segment) or (mixed and len(words) == 1)
        for w in words:
            bits = [b for b in _APOSTROPHE.sub("", w).split("-") if b]
            if len(bits) > 1 and not (all(len(b) >= 6 for b in bits) or (mixed and any(b[0].islower() for b in bits[1:]))) and not all(len(b) == 1 for b in bits):
                bits = ["".join(bits)]
            for b in bits:
                t = _MARKS.sub("", unicodedata.normalize("NFKD", b))
                if len(t) == 1 or (t.isupper() and len(t) <= 3 and short):
                    out.extend(f"{c.lower()}." for c in t)
                elif t:
                    out.append(t.casefold())
    return tuple([t for t in out if t not in PARTICLES] or out)


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, changes and swaps of neighbours from a to b; `most` + 1 where it takes more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, nxt[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            nxt.append(d)
        if min(nxt) > most:
            return most + 1
        before, row = row, nxt
    return min(row[-1], most + 1)


class Matcher:
    """Compares names given as parts: `x.` for an initial, `abcd~` for a part too common to tell a person (given names).
    `nicknames`: (formal, short) pairs of given names."""

    def __init__(self, nicknames: list[tuple[str, str]]) -> None:
        self.same: dict[str, set[str]] = defaultdict(set)
        for formal, short in nicknames:
            if formal and short:
                f, s = "".join(tokens(formal)), "".join(tokens(short))
                self.same[f].add(f)
                self.same[s].add(f)

    def part(self, a: str, b: str) -> float:
        """Likeness of two parts, 0 to 1: 0.9 for an initial or one edit, 0.95 for forms of one given name."""
        a, b = a.rstrip("~"), b.rstrip("~")
        if a == b:
            return 1.0
        if a[-1] == "." or b[-1] == ".":
            if a[-1] == b[-1]:
                return 0.0
            i, full = (a, b) if a[-1] == "." else (b, a)
            return 0.9 if any(f[0] == i[0] for f in {full, *self.same.get(full, ())}) else 0.0
        if self.same.get(a, set()) & self.same.get(b, set()):
            return 0.95
        n = min(len(a), len(b))
        return (0.9 if n >= 5 else 0.85) if n >= 3 and edits(a, b, 1) == 1 else 0.0

    def _aligned(self, a: tuple[str, ...], b: tuple[str, ...]) -> float:
        """Monge-Elkan likeness of a to b (a not longer): the mean over a's parts of the likeness to its own best part of b,
        less a hundredth for each part that only b has."""
        scored = sorted(((s, -i, -j) for i, x in enumerate(a) for j, y in enumerate(b) if (s := self.part(x, y)) > 0), reverse=True)
        mate: dict[int, int] = {}
        used: set[int] = set()
        total = 0.0
        for s, i, j in scored:
            if -i not in mate and -j not in used:
                mate[-i] = -j
                used.add(-j)
                total += s
        if len(mate) < len(a):
            return 0.0
        ranked = sorted((-self.part(a[i], b[j]), i, j) for i, j in mate.items())
        surname = next((i for s, i, j in ranked if a[i][-1] not in ".~" and b[j][-1] not in ".~"), None)
        if surname is None:
            # common parts tell a person together: one written alike, and another alike or a slip of one that is known
            full = [(-s, i, j) for s, i, j in ranked if a[i][-1] != "." and b[j][-1] != "."]
            if len(full) < 2 or full[0][0] < 1 or full[1][0] < 0.9 or (full[1][0] == 0.9 and a[full[1][1]][-1] == b[full[1][2]][-1] == "~"):
                return 0.0
            surname = full[0][1]
        if len(a) < len(b):
            # parts may be left out after the first given name only
            first_a, first_b = next(i for i in range(len(a)) if i != surname), next(j for j in range(len(b)) if j != mate[surname])
            if mate[first_a] != first_b:
                return 0.0
        elif any(x[-1] == "." for x in (*a, *b)) and [mate[i] for i in range(len(a)) if i != surname] != [j for j in range(len(b)) if j != mate[surname]]:
            total -= 0.05  # initials in another order are weaker evidence
        return total / len(a) - 0.01 * (len(b) - len(a))

    def same_person(self, a: tuple[str, ...], b: tuple[str, ...], least: float = 0.85) -> float:
        """Likeness where two names can mean one person, else 0.

        Every part of the shorter name has its own counterpart, one of them a part written out and not common in both, or two of them
        written out of which one is equal (a common surname and a given name; two known given names one edit apart are two names), with
        a mean likeness of `least` or more. A common surname with an initial tells nobody apart. Parts only the longer name has come after the first given name. A part cut in two
        is taken as one. Names of a single part are like their equals only.
        """
        if len(a) > len(b):
            a, b = b, a
        if len(a) < 2:
            return 1.0 if a == b and len(a) > 0 else 0.0
        best = self._aligned(a, b)
        if best < least and len(b) > 2:
            plain = {x.rstrip("~") for x in a}
            for k in range(len(b) - 1):
                whole = (b[k] + b[k + 1]).replace("~", "")
                if b[k][-1] != "." and b[k + 1][-1] != "." and whole in plain:
                    best = max(best, self._aligned(*sorted((a, (*b[:k], whole, *b[k + 2 :])), key=len)))
        return best if best >= least else 0.0


def curve(likeness: float, rows: int, bands: int) -> float:
    """Chance that two sets of this Jaccard likeness share a bucket in at least one of `bands` bands of `rows` minima."""
    return 1 - (1 - likeness**rows) ** bands


def bands_for(likeness: float, rows: int, recall: float) -> int:
    """Least number of bands at which sets of this likeness meet with chance `recall` or more."""
    return math.ceil(math.log(1 - recall) / math.log(1 - likeness**rows))


def _grams(key: str, q: int) -> list[str]:
    pad = "#" * (q - 1)
    return [g for t in key.split(" ") for s in [f"{pad}{t}{pad}"] for g in (s[i : i + q] for i in range(len(s) - q + 1))] or [key]


def min_buckets(df: DataFrame, key_col: str, out_col: str, q: int, rows: int, bands: int, seed: int = 7) -> DataFrame:
    """Add array<bigint> of the buckets, one per band, of each text's set of padded q-grams."""
    rng = np.random.default_rng(seed)
    mult = rng.integers(1, 2**63, rows * bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, rows * bands, dtype=np.uint64)
    mix = rng.integers(1, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import hashlib

        code: dict[str, int] = {}

        def of(g: str) -> int:
            if g not in code:
                if len(code) > 500_000:
                    code.clear()
                code[g] = int.from_bytes(hashlib.blake2b(g.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            return code[g]

        for s in batches:
            sets = [_grams(k, q) for k in s]
            if not sets:
                yield pd.Series([], dtype=object)
                continue
            flat = np.array([of(g) for gs in sets for g in gs], dtype=np.uint64)
            starts = np.cumsum([0, *(len(gs) for gs in sets[:-1])])
            out = np.empty((len(sets), bands), dtype=np.int64)
            for b in range(bands):
                h = np.full(len(sets), ((b + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1), dtype=np.uint64)
                for r in range(rows):
                    k = b * rows + r
                    h = (h ^ (np.minimum.reduceat(flat * mult[k] + add[k], starts) >> np.uint64(16))) * mix[r]
                    h ^= h >> np.uint64(29)
                out[:, b] = h.view(np.int64)
            yield pd.Series(list(out), index=s.index)

    return df.withColumn(out_col, F.pandas_udf(run, "array<bigint>")(F.col(key_col)))


def spread(df: DataFrame, n: int) -> DataFrame:
    """A side of a join in which a table has `n` rows. Spark judges a table by its files, which may be a small part of its size in memory, and
    adaptive execution doesn't take back a broadcast that would cost a shuffle, so beyond a counted size both sides are shuffled."""
    return df.hint("merge") if n > MAX_BROADCAST else df


def star_clusters(nodes: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, center) for nodes (node, rank) and edges (a, b, w), a <> b, each pair once.

    Centres are chosen greedily by rank, then degree, then smallest id, no two of them neighbours; every other node goes to
    its likest neighbouring centre. In each round every open node that comes before all its open neighbours becomes a centre
    and its neighbours are settled, which gives the greedy result without a global order. Only open edges are kept.
    """
    n = edges.count()
    both = edges.select("a", "b", "w").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    degree = both.groupBy("a").agg(F.count("*").alias("d"))
    order = nodes.join(spread(degree, n), nodes["node"] == degree["a"]).select("node", F.struct("rank", "d", (-F.col("node")).alias("i")).alias("p"))
    side = lambda s: spread(order.select(F.col("node").alias(s), F.col("p").alias(f"p{s}")), n)
    full = cut(both.join(side("a"), "a").join(side("b"), "b"), "star")
    open_, settled = full, None
    for _ in range(max_rounds):
        top = open_.groupBy("a").agg(F.max("pb").alias("top"), F.first("pa").alias("pa")).where("pa > top").select(F.col("a").alias("c"))
        new = open_.join(spread(top, n), open_["a"] == top["c"]).select(F.col("b").alias("s"))
        done = cut(top.select(F.col("c").alias("n"), F.lit(False).alias("sat")).unionByName(new.select(F.col("s").alias("n"), F.lit(True).alias("sat"))).distinct(), "settled")
        settled = done.where("sat") if settled is None else settled.unionByName(done.where("sat"))
        gone = spread(done.select("n").distinct(), n)
        before = open_
        open_ = cut(open_.join(gone, open_["a"] == gone["n"], "left_anti").join(gone, F.col("b") == gone["n"], "left_anti"), "open")
        if before is not full:
            discard(before)
        if open_.isEmpty():
            break
    else:
        raise RuntimeError(f"star clustering open after {max_rounds} rounds")
    sat = settled.select(F.col("n").alias("b")).distinct()
    to = full.join(spread(sat.select(F.col("b").alias("a")), n), "a", "left_anti")  # edges that begin at a centre
    mine = to.groupBy("b").agg(F.max_by("a", F.struct("w", "pa")).alias("center"))
    return nodes.join(spread(mine, n), nodes["node"] == mine["b"], "left").select("node", F.coalesce("center", "node").alias("center"))


def in_cells(forms: DataFrame, sizes: DataFrame, cell: int) -> DataFrame:
    """`forms` (key, node, ...) with `cells` of its key (a cell for `cell` of its forms, from `sizes` (key, n)) and its own `c` of them."""
    dealt = attach(forms, sizes.select("key", "n"), ["key"], "n", forms.count(), ["node"]).withColumn("cells", F.ceil(F.col("n") / cell).cast("int"))
    return dealt.withColumn("c", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")).drop("n")


def form_pairs(forms: DataFrame, sizes: DataFrame, near: DataFrame, cell: int = 256) -> DataFrame:
    """(a, b, form_a, form_b) of all forms (key, node, form) of one key, a < b, and of all forms of two keys of `near` (key_a, key_b).

    The forms of a key are dealt into cells and pairs of cells are rows of their own, so that no task holds more than two cells of one key at
    once, however many forms it has. Pairs of cells are never broadcast: a table of few forms may be one of very many pairs.
    """
    dealt = cut(in_cells(forms.select("key", "node", "form"), sizes, cell), "dealt")
    n = dealt.count()
    side = lambda s, *cols: dealt.select(*cols, F.col("node").alias(s), F.col("form").alias(f"form_{s}"))
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    within = side("a", "key", "c", every.alias("d")).join(side("b", "key", F.col("c").alias("d"), every.alias("c")).hint("merge"), ["key", "c", "d"]).where("a < b")
    cells = lambda s: spread(sizes.select(F.col("key").alias(f"key_{s}"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / cell).cast("int") - 1)).alias(f"c_{s}")), n)
    met = near.join(cells("a"), "key_a").join(cells("b"), "key_b")
    placed = lambda s: spread(side(s, F.col("key").alias(f"key_{s}"), F.col("c").alias(f"c_{s}")), n)
    across = met.join(placed("a"), ["key_a", "c_a"]).join(placed("b"), ["key_b", "c_b"])
    return across.select("a", "b", "form_a", "form_b").unionByName(within.select("a", "b", "form_a", "form_b"))


def common_parts(spelled: DataFrame, given_least: int = 5, surname_share: float = 0.001, surname_least: int = 40) -> DataFrame:
    """Parts (t) too common to tell a person, from names of which the surname is known (name, parts, n_last).

    A given name is a part that stands as one beside `given_least` different surnames or more and more often so than it stands
    as a surname beside different given names; a surname that some use as a given name too stays telling however large the corpus. A
    common surname is that of `surname_share` of all such spellings or more: names that share it alone would be compared with
    so many others that the work grew with the square of the corpus. Below `surname_least` spellings that costs nothing and it
    stays telling. Shares don't move with the size of the corpus.
    """
    two = spelled.where("n_last > 0 AND n_last < size(parts)").select(F.slice("parts", F.lit(1), F.col("n_last")).alias("last"), F.expr("slice(parts, n_last + 1, size(parts))").alias("fore")).distinct()
    written = lambda c: F.filter(c, lambda t: ~t.endswith("."))
    given = two.select(F.explode(written(F.col("fore"))).alias("t"), F.concat_ws(" ", "last").alias("o"), F.lit(1).alias("g"))
    last = two.select(F.explode(written(F.col("last"))).alias("t"), F.concat_ws(" ", "fore").alias("o"), F.lit(0).alias("g"))
    stands = given.unionByName(last).distinct().groupBy("t").agg(F.sum("g").alias("as_given"), F.count_if(F.col("g") == 0).alias("as_last"))
    many = max(surname_least, int(surname_share * two.count()))
    return stands.where(((F.col("as_given") >= given_least) & (F.col("as_given") > F.col("as_last"))) | (F.col("as_last") >= many)).select("t")


def link_names(names: DataFrame, nicknames: DataFrame, q: int = 3, rows: int = 4, likeness: float = 0.42, recall: float = 0.99, max_nicknames: int = 200_000) -> DataFrame:
    """(name, cluster) for each different name of `names` (name) that isn't null or blank; `nicknames` (formal_name, nickname).

    Names are taken as parts. A part is common as `common_parts` says or if it is in `nicknames`. The key of a name is its parts written out that aren't common (all parts, where there is no
    other). Keys meet in buckets of minima over their padded q-grams; the number of bands follows from the collision curve, so
    that keys of Jaccard `likeness` meet with chance `recall`. Names of equal or meeting keys are compared in full and form
    the graph that star clustering divides. `nicknames` goes to every task, so its size is checked.
    """
    given = nicknames.where("formal_name IS NOT NULL AND nickname IS NOT NULL").select("formal_name", "nickname").distinct()
    if (n := given.count()) > max_nicknames:
        raise ValueError(f"{n} nicknames; the operator takes {max_nicknames} at most")
    pairs = [tuple(r) for r in given.collect()]
    shared = names.sparkSession.sparkContext.broadcast(pairs)

    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            t = [tokens(x) for x in s]
            last = [len(tokens(x.split(",")[0])) if "," in x else 0 for x in s]
            yield pd.DataFrame({"parts": [list(x) for x in t], "n_last": last})

    spelled = names.select("name").where(F.col("name").rlike(r"\p{L}")).distinct()
    spelled = cut(spelled.withColumn("_t", F.pandas_udf(parse, "parts array<string>, n_last int")("name")).select("name", "_t.parts", "_t.n_last").where(F.size("parts") > 0), "spelled")
    listed = local(names.sparkSession, [(t,) for t in {"".join(tokens(x)) for p in pairs for x in p}], "t string")
    common = cut(common_parts(spelled).unionByName(listed).distinct().withColumn("mark", F.lit("~")), "common")
    common = F.broadcast(common) if common.count() <= 100_000 else common.hint("merge")
    forms = spelled.select("parts").distinct()
    marked = forms.select("parts", F.posexplode("parts").alias("k", "t")).join(common, "t", "left").groupBy("parts").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", F.concat("t", F.coalesce("mark", F.lit(""))).alias("v")))), lambda x: x["v"]).alias("form"))
    own = F.array_sort(F.array_distinct(F.filter("form", lambda t: ~t.rlike("[.~]$"))))
    full = F.array_sort(F.array_distinct(F.transform("form", lambda t: F.regexp_replace(t, "~$", ""))))
    key = F.concat_ws(" ", F.when(F.size(own) > 0, own).otherwise(full))
    rank = (F.size(F.filter("form", lambda t: ~t.endswith("."))) > 1).cast("int")
    forms = cut(marked.withColumn("node", F.monotonically_increasing_id()).select("node", "parts", "form", key.alias("key"), rank.alias("rank")), "forms")

    keys = cut(forms.groupBy("key").agg(F.count("*").alias("n")).withColumn("k", F.monotonically_increasing_id()), "keys")
    n_keys = keys.count()
    # a task for every 5,000 keys; written, so that its size is known (a plan takes the buckets for no larger than the keys) and minima are taken once
    bucketed = cut(min_buckets(keys.repartition(n_keys // 5000 + 1, "k"), "key", "bucket", q, rows, bands_for(likeness, rows, recall)).select("k", F.explode("bucket").alias("bucket")), "buckets")
    met = pair_counts(bucketed, "bucket", "k", 64)

    def close(u: list[str], v: list[str]) -> bool:
        return any(edits(x, y, 1) <= 1 for x in u for y in v if len(x) > 2) or any(x + y in q for p, q in ((u, v), (v, u)) for x in p for y in p)

    def near_keys(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([close(u.split(" "), v.split(" ")) for u, v in zip(a, b, strict=True)], dtype=bool)

    side = lambda s: spread(keys.select(F.col("k").alias(s), F.col("key").alias(f"key_{s}")), n_keys)
    # parts must be within two changes, of which a swap of neighbours is two, or one cut in two; that much is checked without Python
    parts = lambda c: F.split(c, " ")
    cut_in_two = lambda p, q: F.exists(parts(p), lambda x: F.exists(parts(p), lambda y: F.array_contains(parts(q), F.concat(x, y))))
    rough = F.exists(parts("key_a"), lambda x: F.exists(parts("key_b"), lambda y: F.levenshtein(x, y, 2) >= 0)) | cut_in_two("key_a", "key_b") | cut_in_two("key_b", "key_a")
    near = cut(met.join(side("a"), "a").join(side("b"), "b").where(rough).where(F.pandas_udf(near_keys, "boolean")("key_a", "key_b")).select("key_a", "key_b"), "near")
    discard(bucketed)
    todo = form_pairs(forms, keys, near)

    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = Matcher(shared.value)
        for a, b in batches:
            yield pd.Series([m.same_person(tuple(x), tuple(y)) for x, y in zip(a, b, strict=True)], dtype=float)

    edges = cut(todo.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.pandas_udf(compare, "double")("form_a", "form_b").alias("w")).where("w > 0"), "alike")
    clusters = star_clusters(forms.select("node", "rank"), edges)
    n = forms.count()
    return spelled.join(spread(forms.select("parts", "node"), n), "parts").join(spread(clusters, n), "node").select("name", F.col("center").alias("cluster"))
