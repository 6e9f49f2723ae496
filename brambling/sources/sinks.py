"""Writers: CSV for spreadsheets, JSON lines, and the roster upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.sources import files

HAND_COLUMNS = ("pubmed_author_query", "orcid", "domains", "notes", "active")


def csv(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """One CSV file at `path`: UTF-8 with header, CRLF and minimal quoting; null is empty, booleans are 0 and 1. Columns that begin with `_` may
    serve the order and are left out."""
    flat = df.select(*[F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in df.dtypes])
    flat = flat.orderBy(*order) if order else flat
    shown = [c for c in df.columns if not c.startswith("_")]
    files.one_file(flat.select(*shown), path, "csv", ",".join(shown) + "\r\n", header=False, lineSep="\r\n", escape='"', emptyValue="", nullValue="")


def json_lines(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """One file of JSON lines at `path`; nulls are written."""
    files.one_file(df.orderBy(*order) if order else df, path, "json", ignoreNullFields=False)


def upsert_roster(old: DataFrame, fetched: DataFrame, key: str = "profile_url", keep: tuple[str, ...] = HAND_COLUMNS) -> DataFrame:
    """The roster after a fetch: fetched values win but for the columns people edit, rows that weren't fetched stay. An empty fetch
    changes nothing. Of rows with one key in a table the first by text counts; null keys are left out of the fetch."""
    new = fetched.where(F.col(key).isNotNull()).dropDuplicates([key])
    cols = [c for c in old.columns if c != key]
    extra = [c for c in new.columns if c not in old.columns]
    a, b = old.alias("a"), new.alias("b")
    pick = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")) if c in keep else F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")) for c in cols if c in new.columns]
    named = [p.alias(c) for p, c in zip(pick, [c for c in cols if c in new.columns], strict=True)]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), *named, *[F.col(f"a.{c}") for c in cols if c not in new.columns], *[F.col(f"b.{c}") for c in extra])
