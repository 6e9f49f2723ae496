"""Freely typed values mapped to a canonical list, by a trie walked with a Levenshtein automaton (problem 3)."""

from __future__ import annotations

import html
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.llm.names import edits
from brambling.runtime import attach, cut

# Words that come and go, and other ways to write words of institutions' names.
FILLERS = frozenset(["of", "for", "the", "and"])
OTHER_FORMS = {
    "agency": ["agcy"],
    "center": ["centre", "ctr"],
    "centre": ["center", "ctr"],
    "college": ["coll"],
    "department": ["dept"],
    "foundation": ["fdn", "found"],
    "general": ["gen"],
    "health": ["hlth"],
    "hospital": ["hosp"],
    "institute": ["inst"],
    "international": ["intl"],
    "laboratory": ["lab"],
    "limited": ["ltd"],
    "medical": ["med"],
    "medicine": ["med"],
    "ministry": ["min"],
    "national": ["natl"],
    "public": ["publ", "pub"],
    "research": ["res"],
    "royal": ["r"],
    "saint": ["st"],
    "school": ["sch"],
    "technology": ["tech", "technol"],
    "university": ["univ"],
}
COUNTRIES = {"united states": "usa", "u s a": "usa", "united states america": "usa", "uk": "united kingdom", "great britain": "united kingdom"}
PHRASES = {"moh": "ministry health"}

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_APOSTROPHE = regex.compile(r"(?<=\p{L})['’ʼ‘`](?=\p{L})")


@dataclass(frozen=True)
class Language:
    """How names are written: words that come and go, other forms of a word, words that stand for several, other names of countries."""

    fillers: frozenset[str] = FILLERS
    forms: dict[str, list[str]] = field(default_factory=lambda: OTHER_FORMS)
    phrases: dict[str, str] = field(default_factory=lambda: PHRASES)
    countries: dict[str, str] = field(default_factory=lambda: COUNTRIES)

    @staticmethod
    def of(table: DataFrame, most: int = 100_000) -> Language:
        """From a table (kind, word, other): kind is `filler`, `form`, `phrase` or `country`. It goes to every task, so its size is checked."""
        rows = table.select("kind", "word", "other").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a table of forms takes {most} rows at most")
        forms: dict[str, list[str]] = defaultdict(list)
        for r in rows:
            if r["kind"] == "form":
                forms[r["word"]].append(r["other"])
        pick = lambda kind: {r["word"]: r["other"] for r in rows if r["kind"] == kind}
        return Language(frozenset(pick("filler")), dict(forms), pick("phrase"), pick("country"))

    def words(self, text: str) -> list[str]:
        """Words in small letters without marks, numbers, punctuation and fillers."""
        t = unicodedata.normalize("NFKC", html.unescape(text))
        t = "".join(c for c in unicodedata.normalize("NFKD", _APOSTROPHE.sub("", t).casefold()) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
        return [x for w in _WORD.findall(t) if w not in self.fillers for x in self.phrases.get(w, w).split(" ")]

    def initials(self, text: str) -> str:
        """The acronym of a name: first letters of its words but the fillers."""
        return "".join(w[0] for w in self.words(text))

    def country(self, text: str) -> str:
        w = " ".join(self.words(text))
        return self.countries.get(w, w)

    def slots(self, words: list[str]) -> list[tuple[str, ...]]:
        return [tuple(sorted({w, *self.forms.get(w, ())})) for w in words]


def limit(length: int) -> int:
    """Edits allowed by length: none below 5 letters, one below 22, two from there."""
    return 0 if length < 5 else 1 if length < 22 else 2


class Node:
    """A place between two words: the entries that end here, and the next words by form and letter by letter. All forms of a word
    lead to one node, so that a name of many words with several forms each adds a node a word, not a path for each combination."""

    __slots__ = ("children", "ends", "forms", "letters")

    def __init__(self) -> None:
        self.ends: set[int] = set()
        self.children: dict[tuple[str, ...], Node] = {}
        self.forms: dict[str, list[Node]] = {}
        self.letters: dict = {}


class Automaton:
    """Levenshtein automaton of up to `most` edits (insertions, deletions, changes, swaps of neighbours), for any text.

    A state is the row of distances from the path read so far to those prefixes of the text whose length is within `most` of the path's,
    with the row before it. The next state follows from where in that window the text has the letter read, so each
    transition is worked out once and then looked up.
    """

    def __init__(self, most: int) -> None:
        self.most, self.width = most, 2 * most + 1
        self.rows: list[tuple[tuple[int, ...], tuple[int, ...]]] = []
        self.number: dict[tuple, int] = {}
        self.table: dict[tuple[int, int, int, int, int], int] = {}

    def state(self, row: tuple[int, ...], before: tuple[int, ...]) -> int:
        k = self.number.setdefault((row, before), len(self.rows))
        if k == len(self.rows):
            self.rows.append((row, before))
        return k

    def start(self, n: int) -> int:
        row = tuple(k - self.most if 0 <= k - self.most <= n else self.most + 1 for k in range(self.width))
        return self.state(row, row)

    def step(self, state: int, same: int, swapped: int, low: int, high: int) -> int:
        """The next state, or -1 where none is within reach. Bit k of `same`: the text has the letter at place k of the window; of
        `swapped`: there and before it stand this and the last letter the other way round. low, high: places of the window before and behind
        the text."""
        row, before = self.rows[state]
        over, d, new = self.most + 1, self.most + 1, []
        for k in range(self.width):
            if k < low or k >= self.width - high:
                d = over
            else:
                d = min(d + 1, over, row[k] + (not same >> k & 1), *((before[k] + 1,) if swapped >> k & 1 else ()), *((row[k + 1] + 1,) if k + 1 < self.width else ()))
            new.append(d)
        got = self.state(tuple(new), row) if min(new) < over else -1
        self.table[state, same, swapped, low, high] = got
        return got


class Trie:
    """Entries as sequences of words with other forms; search gives all entries within a distance."""

    def __init__(self) -> None:
        self.root = Node()
        self.longest = 0
        self.automata: dict[int, Automaton] = {}

    def add(self, slots: list[tuple[str, ...]], entry: int) -> None:
        node, size = self.root, len(slots) - 1
        for forms in slots:
            size += max(map(len, forms))
            child = node.children.get(forms)
            if child is None:
                child = node.children[forms] = Node()
                for f in forms:
                    node.forms.setdefault(f, []).append(child)
                    at = node.letters
                    for c in f:
                        at = at.setdefault(c, {})
                    at.setdefault("", []).append(child)
            node = child
        node.ends.add(entry)
        self.longest = max(self.longest, size)

    def exact(self, words: Iterable[str]) -> set[int]:
        at = [self.root]
        for w in words:
            at = [c for n in at for c in n.forms.get(w, ())]
            if not at:
                return set()
        return set().union(*(n.ends for n in at))

    def search(self, text: str, most: int) -> dict[int, int]:
        """Distance by entry, up to `most`: the trie is walked with the automaton, and a branch ends where it has no next state."""
        found: dict[int, int] = {}
        n = len(text)
        if n > self.longest + most:
            return found
        auto = self.automata.setdefault(most, Automaton(most))
        width, table, rows = auto.width, auto.table, auto.rows
        window = (1 << width) - 1
        # bit most + 1 + i of a letter's mask: the text has it at i
        masks: dict[str, int] = {}
        for i, c in enumerate(text, most + 1):
            masks[c] = masks.get(c, 0) | 1 << i
        stack = [(self.root.letters, 0, 0, auto.start(n))]
        while stack:
            node, last, depth, state = stack.pop()
            steps = node.items()
            if "" in node:
                end = n - depth + most
                d = rows[state][0][end] if 0 <= end < width else most + 1
                for word in node[""]:
                    if d <= most:
                        for e in word.ends:
                            found[e] = min(found.get(e, d), d)
                steps = [s for s in steps if s[0]] + [(" ", w.letters) for w in node[""] if w.letters]
            low, high = max(0, most - depth - 1), max(0, depth + 1 + most - n)
            if high >= width:
                continue
            for c, child in steps:
                mask = masks.get(c, 0)
                same = mask >> depth + 1 & window
                swapped = last >> depth + 1 & mask >> depth & window
                nxt = table.get((state, same, swapped, low, high))
                if nxt is None:
                    nxt = auto.step(state, same, swapped, low, high)
                if nxt >= 0:
                    stack.append((child, mask, depth + 1, nxt))
        return found


class Candidate(NamedTuple):
    """kind: 0 for a piece of the text, 1 for a piece with the one behind it, 2 for an acronym. piece: which of them. placed: for an
    acronym, whether a word of the entry's name stands beside it."""

    kind: int
    piece: int
    d: int
    length: int
    id: str
    country: str | None
    placed: bool


CANDIDATES = "array<struct<kind:int,piece:int,d:int,length:int,id:string,country:string,placed:boolean>>"


def decide(found: Iterable[Candidate], country: str | None) -> tuple[str | None, int]:
    """(id of the entry meant or None, distance) from the candidates of the whole list: pieces alone come before pieces with the one behind
    them, these before acronyms; the nearest entry, of equals the longest piece's, is taken. Where several are equally
    near the country written last decides; if it can't, none is taken."""
    found = list(found)
    kind = min((c.kind for c in found), default=0)
    pieces: dict[int, list[Candidate]] = defaultdict(list)
    for c in found:
        if c.kind == kind:
            pieces[c.piece].append(c)
    tries = []
    for p, cs in sorted(pieces.items()):
        d = min(c.d for c in cs)
        cs = [c for c in cs if c.d == d]
        tries.append((d, -cs[0].length, p, [c for c in cs if c.placed] or cs))
    for d, _, _, cs in sorted(tries, key=lambda t: t[:3]):
        ids = {c.id for c in cs}
        if len(ids) > 1 and country:
            ids = {c.id for c in cs if c.country == country} or {c.id for c in cs if c.country is None}
        if len(ids) == 1:
            return ids.pop(), d
    return None, -1


class Canonical:
    """The list of (id, label, country or None), or a part of it, with its alias paths: other forms of words, the first word behind or the
    last word in front, and the acronym with a word of the name beside it."""

    def __init__(self, entries: list[tuple[str, str, str | None]], language: Language | None = None) -> None:
        self.language = lang = language or Language()
        self.ids = [e[0] for e in entries]
        self.country = [lang.country(e[2]) if e[2] else None for e in entries]
        self.trie = Trie()
        self.acronyms: dict[str, set[int]] = defaultdict(set)
        self.labels = [set(lang.words(e[1])) for e in entries]
        self.orders: dict[int, list[list[tuple[str, ...]]]] = {}
        for k, (_, label, _) in enumerate(entries):
            slots = lang.slots(lang.words(label))
            if not slots:
                continue
            self.orders[k] = [slots] if len(slots) < 2 else [slots, [*slots[1:], slots[0]], [slots[-1], *slots[:-1]]]
            for o in self.orders[k]:
                self.trie.add(o, k)
            a = lang.initials(label)
            if len(a) > 2:
                self.acronyms[a].add(k)
        self.memo: dict[str, dict[int, int]] = {}
        self.pieces: dict[str, list[str]] = {}

    def words_of(self, piece: str) -> list[str]:
        """`words` with a memo of bounded size: departments and countries come again and again."""
        if piece not in self.pieces:
            if len(self.pieces) > 200_000:
                self.pieces.clear()
            self.pieces[piece] = self.language.words(piece)
        return self.pieces[piece]

    def near(self, words: list[str]) -> dict[int, int]:
        """Entries within the length-dependent distance of a text of words, no word of them by two edits. A text of any length may be
        an entry's exact name."""
        text = " ".join(words)
        if text not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            most = limit(len(text))
            same = self.trie.exact(words)
            got = dict.fromkeys(same, 0) if same else self.trie.search(text, 1) if most else {}
            if most > 1 and not got:
                # two edits count in different words only
                got = {k: d for k, d in self.trie.search(text, most).items() if self._spread(words, k)}
            self.memo[text] = got
        return self.memo[text]

    def _spread(self, words: list[str], entry: int) -> bool:
        return any(len(o) == len(words) and all(any(edits(w, f, 1) <= 1 for f in forms) for w, forms in zip(words, o, strict=True)) for o in self.orders[entry])

    def candidates(self, text: str) -> list[Candidate]:
        """The entries that a text may mean: of its comma-separated pieces, else of pieces with the one behind (a place written after the
        name), else of acronyms."""
        pieces = [p for p in text.split(",") if p.strip()]
        ws = [self.words_of(p) for p in pieces]
        make = lambda kind, piece, d, length, k, placed=False: Candidate(kind, piece, d, length, self.ids[k], self.country[k], placed)
        for kind, tried in ((0, ws), (1, [[*w, *v] for w, v in zip(ws, ws[1:], strict=False)])):
            out = [make(kind, i, d, len(" ".join(w)), k) for i, w in enumerate(tried) if w for k, d in self.near(w).items()]
            if out:
                return out
        out = []
        for i, p in enumerate(pieces[:-1] or pieces):
            for j, a in enumerate(regex.findall(r"\b\p{Lu}{3,}\b", p)):
                place = {x for w in ws[i : i + 2] for x in w}
                out += [make(2, i * 1000 + j, 0, len(a), k, bool(place & self.labels[k])) for k in self.acronyms.get(a.lower(), ())]
        return out

    def match(self, text: str) -> tuple[str | None, int]:
        """(id of the entry meant or None, distance), where this list is the whole."""
        return decide(self.candidates(text), written_country(text, self.language))


def written_country(text: str, language: Language) -> str | None:
    pieces = [p for p in text.split(",") if p.strip()]
    return language.country(pieces[-1]) if len(pieces) > 1 else None


def map_values(df: DataFrame, col: str, canonical: DataFrame, out: str = "node_id", unmatched: str = "unmatched", block: int = 50_000, language: Language | None = None, group: int = 20_000) -> DataFrame:
    """Add the id of the entry of `canonical` (node_id, label, country) that `col` means, or `unmatched`; null for a null value.

    A list of up to `block` entries goes to every task, and rows are not shuffled. A longer one is divided into blocks of about that size;
    different values meet the blocks in groups of `group` values, so that a task holds one block's trie and one group; the
    candidates of all blocks are put together before it is decided which is meant, so that the result is that of the undivided list, and
    values find theirs by a join that spreads frequent ones. Null labels are no entries; an id may have several labels. `language`
    holds words' other forms and may come from a table (Language.of).
    """
    lang = language or Language()
    lst = canonical.where("label IS NOT NULL AND node_id IS NOT NULL").select(F.col("node_id").cast("string").alias("node_id"), F.col("label").cast("string").alias("label"), F.col("country").cast("string").alias("country")).dropDuplicates(["node_id", "label"])
    head = lst.limit(block + 1).collect()
    if len(head) <= block:
        shared = df.sparkSession.sparkContext.broadcast((sorted((tuple(r) for r in head), key=str), lang))

        def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            c = Canonical(*shared.value)
            for s in batches:
                yield pd.Series([(c.match(x)[0] or unmatched) if x is not None else None for x in s], index=s.index, dtype=object)

        return df.withColumn(out, F.pandas_udf(search, "string")(F.col(col)))
    blocks, values = -(-lst.count() // block), cut(df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count("*").alias("_n")), "values")
    groups = max(1, -(-values.count() // group))
    left = values.select("_v", F.pmod(F.xxhash64("_v"), F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    right = lst.withColumn("b", F.pmod(F.xxhash64("node_id", "label"), F.lit(blocks)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))

    def meet(v: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        c = Canonical([(i, x, y) for i, x, y in entries[["node_id", "label", "country"]].itertuples(index=False)], lang)
        found = [[x._asdict() for x in c.candidates(t)] for t in v["_v"]]
        return pd.DataFrame({"_v": v["_v"], "c": found})[[len(x) > 0 for x in found]]

    met = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(meet, f"_v string, c {CANDIDATES}")

    def pick(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for v, cs in batches:
            yield pd.Series([decide([Candidate(**x) for x in c], written_country(t, lang))[0] for t, c in zip(v, cs, strict=True)], index=v.index, dtype=object)

    merged = met.groupBy("_v").agg(F.flatten(F.collect_list("c")).alias("c"))
    ids = merged.select("_v", F.pandas_udf(pick, "string")("_v", "c").alias("_id"))
    every = cut(values.join(ids, "_v", "left"), "matched")
    total = every.agg(F.sum("_n")).first()[0] or 0
    known = attach(df.where(F.col(col).isNotNull()).withColumn("_v", F.col(col)), every, ["_v"], "_n", total).select(*[F.col(c) for c in df.columns if c != out], F.coalesce("_id", F.lit(unmatched)).alias(out))
    return known.unionByName(df.where(F.col(col).isNull()).select(*[F.col(c) for c in df.columns if c != out], F.lit(None).cast("string").alias(out)))
