"""K-means over sparse vectors within groups. All groups are fitted in the same passes, and no driver or task holds centers as wide as the vocabulary."""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import cut, local

#: Numbers below this are columns of dense matrices, the others meet term by term. Vectors give their commonest terms the least numbers; any numbering gives right results.
DENSE = 1024
_LISTS = "ptr binary, idx binary, val binary"
_SUMS = "domain string, dense binary, keys binary, vals binary, counts binary"


@dataclass
class Block:
    """Texts of one domain: text i has the terms idx[ptr[i]:ptr[i + 1]] and their values."""

    ptr: np.ndarray
    idx: np.ndarray
    val: np.ndarray
    row: np.ndarray = field(init=False)
    common: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.row = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        self.common = self.idx < DENSE

    @staticmethod
    def of(r: dict) -> Block:
        return Block(np.frombuffer(r["ptr"], np.int64), np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float64))

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def take(self, i: np.ndarray) -> Block:
        n = np.diff(self.ptr)[i]
        ptr = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(ptr[-1]) - np.repeat(ptr[:-1] - self.ptr[i], n)
        return Block(ptr, self.idx[at], self.val[at])

    def squares(self) -> np.ndarray:
        return np.bincount(self.row, self.val**2, minlength=len(self))


def joined(blocks: list[Block]) -> Block:
    return Block(np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b.ptr) for b in blocks]))]), np.concatenate([b.idx for b in blocks]), np.concatenate([b.val for b in blocks]))


def _added(keys: np.ndarray, vals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, vals
    order = np.argsort(keys, kind="stable")
    keys, vals = keys[order], vals[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(vals, first)


@dataclass
class Centers:
    """k centers: common terms as a matrix, of the others the keys term * k + center, in order, and their values."""

    dense: np.ndarray
    keys: np.ndarray
    vals: np.ndarray
    square: np.ndarray = field(init=False)
    term: np.ndarray = field(init=False)
    ptr: np.ndarray = field(init=False)
    who: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.dense, self.vals = self.dense.astype(np.float32), self.vals.astype(np.float32)
        terms, self.who = self.keys // len(self.dense), (self.keys % len(self.dense)).astype(np.int32)
        self.term, first = np.unique(terms, return_index=True)
        self.ptr = np.append(first, len(terms))
        self.square = (self.dense.astype(np.float64) ** 2).sum(1) + np.bincount(self.who, self.vals.astype(np.float64) ** 2, minlength=len(self.dense))

    @staticmethod
    def at(b: Block) -> Centers:
        """A center at each text."""
        k, c = len(b), b.common
        dense = np.bincount(b.row[c] * DENSE + b.idx[c], b.val[c], minlength=k * DENSE).reshape(k, DENSE)
        return Centers(dense, *_added(b.idx[~c].astype(np.int64) * k + b.row[~c], b.val[~c]))

    def moved(self, old: Centers) -> float:
        """The farthest way of a center."""
        k = len(self.dense)
        keys, d = _added(np.concatenate([self.keys, old.keys]), np.concatenate([self.vals, -old.vals]).astype(np.float64))
        return float(np.sqrt((((self.dense - old.dense).astype(np.float64) ** 2).sum(1) + np.bincount(keys % k, d**2, minlength=k)).max()))


def products(b: Block, c: Centers, at_once: int = 1_000_000) -> np.ndarray:
    """Scalar products of texts and centers. Uncommon terms are met `at_once` at a time, so memory doesn't follow their number."""
    n, k = len(b), len(c.dense)
    x = np.zeros((n, DENSE), np.float32)
    x[b.row[b.common], b.idx[b.common]] = b.val[b.common]
    s = x @ c.dense.T
    if len(c.term):
        rare = np.flatnonzero(~b.common)
        at = np.minimum(np.searchsorted(c.term, b.idx[rare]), len(c.term) - 1)
        hit = c.term[at] == b.idx[rare]
        rare, at = rare[hit], at[hit]
        n_of = c.ptr[at + 1] - c.ptr[at]
        for part in np.split(np.arange(len(rare)), np.flatnonzero(np.diff(np.cumsum(n_of) // at_once)) + 1) if len(rare) else []:
            m = n_of[part]
            of = np.repeat(part, m)
            pos = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + c.ptr[at[of]]
            s += np.bincount(b.row[rare[of]] * k + c.who[pos], b.val[rare[of]] * c.vals[pos], minlength=n * k).reshape(n, k)
    return s


def nearest(b: Block, c: Centers) -> tuple[np.ndarray, np.ndarray]:
    """Of each text its nearest center, the first of equals, and the square of the distance."""
    d = c.square - 2.0 * products(b, c)
    best = d.argmin(1)
    return best, np.maximum(d[np.arange(len(b)), best] + b.squares(), 0.0)


def blocks(vec: DataFrame, key: str, sizes: dict[str, int], seed: int, per_block: int) -> DataFrame:
    """(domain, b, keys, h, ptr, idx, val): the vectors of a domain in blocks of about `per_block` by a hash of their keys, in the order of
    keys, so that blocks don't depend on how files lie."""
    kind = vec.schema[key].dataType.simpleString()
    number = local(vec.sparkSession, [(d, -(-n // per_block)) for d, n in sizes.items()], "domain string, _blocks int")
    v = vec.join(F.broadcast(number), "domain").withColumn("b", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"))
    v = v.select("domain", "b", F.col(key).alias("keys"), F.xxhash64(F.lit(seed), key).alias("h"), "features.indices", "features.values")

    def pack(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=[("keys", "ascending"), ("h", "ascending")])).combine_chunks()
        one = {c: t[c].chunk(0) for c in t.column_names}
        ptr = np.concatenate([[0], np.cumsum(one["indices"].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        lists = [ptr.tobytes(), one["indices"].flatten().to_numpy().astype(np.int32).tobytes(), one["values"].flatten().to_numpy().astype(np.float64).tobytes()]
        whole = [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), one[c]) for c in ("keys", "h")]
        return pa.table([one["domain"].slice(0, 1), one["b"].slice(0, 1), *whole, *(pa.array([x], pa.binary()) for x in lists)], names=["domain", "b", "keys", "h", "ptr", "idx", "val"])

    return cut(v.groupBy("domain", "b").applyInArrow(pack, f"domain string, b int, keys array<{kind}>, h array<bigint>, {_LISTS}"), "blocks")


def _pass(df: DataFrame, state: dict[str, object], each: Callable, close: Callable, shape: str) -> pa.Table:
    """Runs over the blocks of the domains in `state`: each(state of the domain, its row, what the task has of the domain so far) gives what it has
    then, close(domain, that) a row of the task."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(state)
    names = [c.split(" ")[0] for c in shape.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has: dict[str, object] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() if c != "h" else batch.column(c)[i].values.to_numpy() for c in batch.schema.names}
                has[r["domain"]] = each(shared.value[r["domain"]], r, has.get(r["domain"]))
        for d, x in has.items():
            yield pa.RecordBatch.from_pylist([dict(zip(names, close(d, x), strict=True))])

    own = df.where(F.col("domain").isin(list(state))).select("domain", "h", "ptr", "idx", "val").coalesce(max(1, sc.defaultParallelism))
    out = own.mapInArrow(run, shape).toArrow().sort_by("domain")
    shared.destroy()
    return out


def _candidates(df: DataFrame, state: dict[str, tuple[Centers | None, int]], salt: int) -> dict[str, Block]:
    """m texts of each domain, drawn one after another by the square of their distance from the nearest of its centers (evenly where there are none),
    without those that lie on one. A text's turn is exponential with that rate; the first m are drawn."""

    def each(own: tuple, r: dict, has: tuple | None) -> tuple:
        c, m = own
        b = Block.of(r)
        with np.errstate(over="ignore"):
            h = r["h"].astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53
        rate = np.ones(len(b)) if c is None else nearest(b, c)[1]
        ok = np.flatnonzero(rate > 1e-6)
        turn = -np.log1p(-u[ok]) / rate[ok]
        ok = ok[first := np.argsort(turn, kind="stable")[:m]]
        turns, both = (turn[first], b.take(ok)) if has is None else (np.concatenate([has[0], turn[first]]), joined([has[1], b.take(ok)]))
        first = np.argsort(turns, kind="stable")[:m]
        return turns[first], both.take(first)

    t = _pass(df, state, each, lambda d, x: (d, x[0].tobytes(), x[1].ptr.astype(np.int64).tobytes(), x[1].idx.tobytes(), x[1].val.tobytes()), f"domain string, turns binary, {_LISTS}")
    out: dict[str, Block] = {}
    for d, (_, m) in state.items():
        rows = t.filter(pc.equal(t["domain"], d)).to_pylist()
        turns = np.concatenate([np.frombuffer(r["turns"]) for r in rows])
        out[d] = joined([Block.of(r) for r in rows]).take(np.argsort(turns, kind="stable")[:m])
    return out


def _sums(df: DataFrame, centers: dict[str, Centers], only_counts: bool = False) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each domain the sums of the texts of each center (dense, keys, values as in Centers) and their numbers."""

    def each(c: Centers, r: dict, has: list | None) -> list:
        b, k = Block.of(r), len(c.dense)
        near = nearest(b, c)[0]
        has = has or [np.zeros(k * DENSE * (not only_counts)), np.zeros(0, np.int64), np.zeros(0), np.zeros(k, np.int64), []]
        has[3] += np.bincount(near, minlength=k)
        if not only_counts:
            has[0] += np.bincount(near[b.row[b.common]] * DENSE + b.idx[b.common], b.val[b.common], minlength=k * DENSE)
            has[4].append((b.idx[~b.common].astype(np.int64) * k + near[b.row[~b.common]], b.val[~b.common]))
            if sum(len(x) for x, _ in has[4]) > max(1_000_000, len(has[1])):
                settle(has)
        return has

    def settle(has: list) -> None:
        has[1], has[2] = _added(np.concatenate([has[1], *(x for x, _ in has[4])]), np.concatenate([has[2], *(y for _, y in has[4])]))
        has[4].clear()

    def close(d: str, has: list) -> tuple:
        settle(has)
        return d, *(x.tobytes() for x in has[:4])

    t, out = _pass(df, centers, each, close, _SUMS), {}
    for d, c in centers.items():
        rows = t.filter(pc.equal(t["domain"], d)).to_pylist()
        of = lambda name, kind=np.float64: [np.frombuffer(r[name], kind) for r in rows]  # noqa: B023, E731
        keys, vals = _added(np.concatenate(of("keys", np.int64)), np.concatenate(of("vals")))
        dense = np.zeros(0) if only_counts else sum(of("dense")).reshape(len(c.dense), DENSE)
        out[d] = dense, keys, vals, sum(of("counts", np.int64))
    return out


def chosen(b: Block, weight: np.ndarray, k: int, rng: np.random.Generator) -> Block:
    """k of the candidates by k-means++; fewer where no more of them differ."""
    own = b.squares()
    far, got = weight.astype(np.float64), []
    least = np.full(len(b), np.inf)
    while len(got) < k and (total := far.sum()) > 0:
        i = int(np.searchsorted(np.cumsum(far), rng.random() * total, side="right"))
        got.append(min(i, len(b) - 1))
        c = Centers.at(b.take(np.array(got[-1:])))
        d = own + own[got[-1]] - 2.0 * products(b, c)[:, 0]
        least = np.minimum(least, np.where(d > 1e-6, d, 0.0))
        far = least * weight
    return b.take(np.array(got))


def fit(df: DataFrame, k: dict[str, int], seed: int, max_iter: int, tolerance: float = 1e-4, rounds: int = 2) -> tuple[dict[str, Centers], dict[str, np.ndarray]]:
    """(centers, numbers of texts) of the domains of the blocks `df`, which get k centers each.

    Starts are drawn over all texts (k-means|| in `rounds` of 2 k candidates, of which k-means++ takes k). Every pass reads the blocks of
    the domains that still move, all at once; a domain ends when no center moves by more than `tolerance`; where `max_iter` passes end it
    before, there is a warning.
    """
    found = _candidates(df, dict.fromkeys(k, (None, 1)), 0)
    many = {d: n for d, n in k.items() if n > 1}
    for i in range(rounds if many else 0):
        more = _candidates(df, {d: (Centers.at(found[d]), 2 * n) for d, n in many.items()}, i + 1)
        found |= {d: joined([found[d], x]) for d, x in more.items()}
    weight = _sums(df, {d: Centers.at(found[d]) for d in many}, only_counts=True) if many else {}
    centers = {d: Centers.at(chosen(found[d], weight[d][3], n, np.random.default_rng([seed, zlib.crc32(d.encode())])) if n > 1 else found[d]) for d, n in k.items()}
    counts: dict[str, np.ndarray] = {}
    going = [d for d in k if len(centers[d].dense) > 1]
    for i in range(max_iter if going else 0):
        moved = {}
        for d, (dense, keys, vals, n) in _sums(df, {d: centers[d] for d in going}).items():
            old, counts[d] = centers[d], n
            m = np.maximum(n, 1)
            stays = n == 0
            kept = stays[old.who]
            new = Centers(np.where(stays[:, None], old.dense, dense / m[:, None]), *_added(np.concatenate([keys, old.keys[kept]]), np.concatenate([vals / m[keys % len(m)], old.vals[kept]])))
            if new.moved(old) > tolerance:
                moved[d] = new
        going = list(moved)
        if not going:
            break
        if i + 1 < max_iter:
            centers |= moved
    for d in going:
        warnings.warn(f"topics of {d}: the centers still moved after {max_iter} iterations", stacklevel=3)
    return centers, counts


def assigned(df: DataFrame, key: str, kind: str, centers: dict[str, Centers], names: dict[str, list[str]]) -> DataFrame:
    """(key, domain, topic_id, features) of the texts of the blocks `df`: the name of the nearest center."""
    shared = df.sparkSession.sparkContext.broadcast((centers, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, names = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                d = batch.column("domain")[i].as_py()
                b = Block.of({c: batch.column(c)[i].as_py() for c in ("ptr", "idx", "val")})
                near = nearest(b, centers[d])[0] if len(centers[d].dense) > 1 else np.zeros(len(b), np.int64)
                ptr = pa.array(b.ptr, pa.int32())
                lists = [pa.ListArray.from_arrays(ptr, pa.array(x)) for x in (b.idx, b.val)]
                topic = pa.array(names[d], pa.string()).take(pa.array(near))
                yield pa.RecordBatch.from_arrays([batch.column("keys")[i].values, pa.array([d] * len(b), pa.string()), topic, pa.StructArray.from_arrays(lists, ["indices", "values"])], names=[key, "domain", "topic_id", "features"])

    return df.select("domain", "keys", "ptr", "idx", "val").mapInArrow(run, f"`{key}` {kind}, domain string, topic_id string, features struct<indices:array<int>,values:array<double>>")
