"""Deeply nested records as flat tables: columnar shredding with repetition and definition levels (problem 5)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Node:
    """A member of the nested shape. `repeated`: a list of it (a single value stands for a list of one). `adapt`: turns a
    stored value of another shape into a dict (groups) or a scalar (leaves)."""

    name: str
    children: list[Node] = field(default_factory=list)
    repeated: bool = False
    adapt: Callable[[object], object] | None = None


@dataclass
class Leaf:
    """A leaf path with its greatest levels; `repeated_at`: path of each repeated ancestor with its definition level."""

    path: str
    max_rep: int
    max_def: int
    repeated_at: list[tuple[str, int]]


def leaves(root: Node) -> list[Leaf]:
    """Leaf paths below `root` in order; every member is optional, so each adds one definition level, a repeated one's element too."""
    out: list[Leaf] = []

    def walk(n: Node, path: str, rep: int, level: int, reps: list[tuple[str, int]]) -> None:
        for k in n.children:
            p = f"{path}.{k.name}" if path else k.name
            r, d, rs = (rep + 1, level + 1, [*reps, (p, level + 1)]) if k.repeated else (rep, level + 1, reps)
            if k.children:
                walk(k, p, r, d, rs)
            else:
                d += k.repeated
                out.append(Leaf(p, r, d, rs))

    walk(root, "", 0, 0, [])
    return out


def _text(x: object) -> str | None:
    return x if isinstance(x, str) or x is None else json.dumps(x, ensure_ascii=False)


def shred(value: object, root: Node) -> dict[str, tuple[list[int], list[int], list[str | None]]]:
    """(repetition levels, definition levels, values) by leaf path, of one record.

    A value not fully defined is None in `values`; members that the shape doesn't name are left out.
    """
    out: dict[str, tuple[list[int], list[int], list[str | None]]] = {x.path: ([], [], []) for x in leaves(root)}

    def put(p: str, r: int, d: int, v: str | None) -> None:
        s = out[p]
        s[0].append(r)
        s[1].append(d)
        s[2].append(v)

    def missing(n: Node, p: str, r: int, d: int) -> None:
        if n.children:
            for k in n.children:
                missing(k, f"{p}.{k.name}", r, d)
        else:
            put(p, r, d, None)

    def element(n: Node, x: object, p: str, r: int, rep: int, d: int) -> None:
        """`d` is the level that holds already, `rep` the greatest repetition level so far."""
        if n.adapt:
            x = n.adapt(x)
        if n.children:
            members(n, x if isinstance(x, dict) else {}, p, r, rep, d)
        elif n.repeated:
            put(p, r, d + (x is not None), _text(x))
        else:
            put(p, r, d, _text(x))

    def members(n: Node, x: dict, path: str, r: int, rep: int, d: int) -> None:
        for k in n.children:
            p, v = (f"{path}.{k.name}" if path else k.name), x.get(k.name)
            if k.repeated:
                items = v if isinstance(v, list) else [] if v is None else [v]
                if not items:
                    missing(k, p, r, d)
                for i, item in enumerate(items):
                    element(k, item, p, r if i == 0 else rep + 1, rep + 1, d + 1)
            else:
                w = k.adapt(v) if k.adapt else v
                if w is None:
                    missing(k, p, r, d)
                elif k.children:
                    members(k, w if isinstance(w, dict) else {}, p, r, rep, d + 1)
                else:
                    put(p, r, d + 1, _text(w))

    members(root, value if isinstance(value, dict) else {}, "", 0, 0, 0)
    return out


_STRIPE = pa.struct([("path", pa.string()), ("rep", pa.list_(pa.int32())), ("def", pa.list_(pa.int32())), ("val", pa.list_(pa.string()))])
STRIPES = "array<struct<path:string,rep:array<int>,def:array<int>,val:array<string>>>"


def stripes(df: DataFrame, id_col: str, body_col: str, root: Node, read: Callable[[object], object] = lambda x: x) -> DataFrame:
    """Shred JSON texts: one row per readable text with the level and value sequences of each leaf path.

    Texts that are null or no JSON give no row. `read` turns the parsed text into the record at the root. One text is
    shredded in one task at a time; no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, found = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                try:
                    v = json.loads(t) if t is not None else None
                except (ValueError, RecursionError):
                    v = None
                if v is not None:
                    keep.append(i)
                    found.append([{"path": p, "rep": s[0], "def": s[1], "val": s[2]} for p, s in shred(read(v), root).items()])
            yield pa.record_batch([b.column(0).take(pa.array(keep, pa.int64())), pa.array(found, pa.list_(_STRIPE))], names=["id", "stripes"])

    src = df.select(F.col(id_col).alias("id"), F.col(body_col).alias("body"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, stripes {STRIPES}")


def ordinals(rep: np.ndarray, defs: np.ndarray, depth: int, levels: list[int]) -> list[np.ndarray]:
    """Position (from 1) within its parent of each entry's ancestor at every repetition depth up to `depth`; 0 where absent.

    An entry of repetition level r starts a new element at depth r and resets all deeper ones; level 0 starts a new record.
    """
    n = len(rep)
    out = []
    index = np.arange(n)
    for k in range(1, depth + 1):
        starts = rep <= k  # a new element at depth k begins
        resets = rep < k  # its parent changes too
        count = np.cumsum(starts)
        base = np.maximum.accumulate(np.where(resets, index, 0))
        pos = count - count[base] + 1 if n else count
        out.append(np.where(defs >= levels[k - 1], pos, 0))
    return out


def flat_table(striped: DataFrame, root: Node, ancestor: str, columns: dict[str, str], numbers: list[str], absent: bool = False) -> DataFrame:
    """The table of the elements of the repeated member `ancestor`, from level sequences alone.

    columns: output name by leaf path; the path's deepest repeated member is `ancestor` or above it. numbers: names for the
    positions (from 1) of the element and of its repeated ancestors, outermost first; with `id` they are the key, without the
    last one the key of the parent's row. absent: a parent without elements gives a row with 0 as the last number.
    """
    known = {x.path: x for x in leaves(root)}
    inside = next(x for x in known.values() if any(p == ancestor for p, _ in x.repeated_at))
    depth = next(i for i, (p, _) in enumerate(inside.repeated_at, 1) if p == ancestor)
    levels = [d for _, d in inside.repeated_at[:depth]]
    need = levels[-1] if not absent else (levels[-2] if depth > 1 else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten()
            rec = np.repeat(np.arange(b.num_rows), b.column(1).value_lengths().to_numpy(zero_copy_only=False)) if b.num_rows else np.array([], int)
            paths = np.array(flat.field("path").to_pylist(), dtype=object)

            def leaf(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
                at = np.flatnonzero(paths == path)
                rows = flat.take(pa.array(at, pa.int64()))
                rep, defs, val = rows.field("rep"), rows.field("def"), rows.field("val")
                who = np.repeat(rec[at], rep.value_lengths().to_numpy(zero_copy_only=False)) if len(at) else np.array([], int)
                return who, rep.flatten().to_numpy(zero_copy_only=False).astype(int), defs.flatten().to_numpy(zero_copy_only=False).astype(int), val.flatten()

            who, rep, defs, _ = leaf(inside.path)
            # leaves below a deeper list repeat within the element: only entries that begin it count
            first = rep <= depth
            pos = ordinals(rep, defs, depth, levels)
            sel = np.flatnonzero(first & (defs >= need))
            names = ["id", *numbers, *columns]
            cols = [b.column(0).take(pa.array(who[sel], pa.int64()))] + [pa.array(p[sel], pa.int32()) for p in pos]
            for path in columns.values():
                lf = known[path]
                k = len(lf.repeated_at)
                lwho, lrep, ldefs, lval = leaf(path)
                key = np.cumsum(lrep <= k) - 1  # ordinal of the leaf's own element over the whole batch
                mine = np.cumsum(rep <= k) - 1  # the same of the table's entries
                at = np.full(int(key[-1]) + 1 if len(key) else 0, -1)
                at[key[::-1]] = np.arange(len(key))[::-1]
                cols.append(lval.take(pa.array(at[mine[sel]], pa.int64())))
            yield pa.record_batch(cols, names=names)

    kind = striped.schema["id"].dataType.simpleString()
    shape = ", ".join([f"id {kind}", *[f"{n} int" for n in numbers], *[f"{c} string" for c in columns]])
    return striped.mapInArrow(run, shape)
