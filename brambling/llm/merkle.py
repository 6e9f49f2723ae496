"""Records that differ in formatting only, by bottom-up hashing of their structure (problem 1)."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import attach, cut

_DROP = regex.compile(r"[^\p{L}\p{N}\p{M}]|[͏︀-️\U000e0100-\U000e01ef]+")
_ASCII_DROP = {i: None for i in range(128) if not chr(i).isalnum()}


def fold(text: str) -> str:
    """Letters, digits and their marks in order, without case, punctuation, white or invisible characters, in one Unicode form."""
    if text.isascii():
        return text.lower().translate(_ASCII_DROP)
    return _DROP.sub("", unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()))


def digest(value: object, unordered: frozenset[str], path: str = "") -> tuple[bytes, object] | None:
    """(Merkle digest, canonical structure) of a JSON value; None where it has no content.

    A leaf is folded text. An object's members count in any order, absent, null and empty ones alike. A list counts in order
    unless its path is in `unordered`; then its children's digests are sorted.
    """
    if isinstance(value, dict):
        kids = sorted((k, d) for k, x in value.items() if (d := digest(x, unordered, f"{path}.{k}" if path else k)))
        tag, canon, parts = b"o", {k: d[1] for k, d in kids}, [k.encode() + b"\0" + d[0] for k, d in kids]
    elif isinstance(value, list):
        below = [d for x in value if (d := digest(x, unordered, path))]
        if path in unordered:
            below.sort(key=lambda d: d[0])
        tag, canon, parts = b"l", [d[1] for d in below], [d[0] for d in below]
    else:
        canon = fold(value if isinstance(value, str) else "" if value is None else json.dumps(value))
        tag, parts = b"t", [canon.encode("utf-8", "surrogatepass")] if canon else []
    if not parts:
        return None
    h = hashlib.blake2b(tag, digest_size=16)
    for p in parts:
        h.update(p)
    return h.digest(), canon


def with_root(df: DataFrame, id_col: str, fields: list[str], unordered: tuple[str, ...] = ()) -> DataFrame:
    """(id, root, canon): digest and canonical structure, as text, of each row's record made of `fields`; null where it has no content."""
    free = frozenset(unordered)

    def roots(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            found = [digest(json.loads(x), free) for x in s]
            yield pd.DataFrame({"root": [d and d[0] for d in found], "canon": [d and json.dumps(d[1], ensure_ascii=False, sort_keys=True) for d in found]})

    udf = F.pandas_udf(roots, "root binary, canon string")
    return df.select(F.col(id_col).alias("id"), udf(F.to_json(F.struct(*[F.col(f) for f in fields]))).alias("m")).select("id", "m.root", "m.canon")


def formatting_copies(df: DataFrame, id_col: str, fields: list[str], unordered: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(classes, members) of records that are the same but for formatting.

    classes: first_id (smallest id), n_copies (rows); one row per class, those of one record included. members: first_id,
    copy_id for every other id of the class, each pair once. Rows are grouped by root digest and by the whole canonical
    structure beside it, so that two structures with one digest stay apart. Records without content (null, empty, only
    punctuation) and rows with a null id are in neither. Repeated rows count as copies but make no pair. Columns other
    than `id_col` and `fields` are ignored, whatever their names.
    """
    rows = cut(with_root(df.where(F.col(id_col).isNotNull()), id_col, fields, unordered).where("root IS NOT NULL"), "merkle")
    grouped = rows.groupBy("root", "canon").agg(F.min("id").alias("first_id"), F.count("*").alias("n_copies"))
    several = grouped.where("n_copies > 1")
    members = attach(rows, several, ["root", "canon"], "n_copies", rows.count(), ["id"]).where("id <> first_id").select("first_id", F.col("id").alias("copy_id")).distinct()
    return grouped.select("first_id", "n_copies"), members
