"""Subject areas of documents, by latent semantic vectors and refined seed centroids (problem 10)."""

from __future__ import annotations

import unicodedata
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import cut

_WORD = regex.compile(r"[\p{L}\p{M}]{2,}")
_SENTENCE = regex.compile(r"(?<=[.!?])\s+|\s*[\r\n]+\s*")


def sentences(text: str) -> list[list[str]]:
    """The words (two letters or more, without case) of each sentence that has any. Line ends end a sentence too."""
    t = unicodedata.normalize("NFKC", text).casefold()
    return [w for s in _SENTENCE.split(t) if (w := _WORD.findall(s))]


@dataclass
class Model:
    """terms: number by term; vectors: a row per term; weight: of each term, 0 for one that tells nothing of subjects;
    centroids: subjects x languages x dimensions, the last subject being none of them."""

    terms: dict[str, int]
    idf: np.ndarray
    vectors: np.ndarray
    weight: np.ndarray | None
    centroids: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def _sum_runs(rows: np.ndarray, index: np.ndarray, lens: np.ndarray, weight: np.ndarray | None = None, most: int = 256) -> np.ndarray:
    """Sums of rows[index], times `weight`, over runs of the lengths `lens`. The k-th members of all runs are added at once, so that no array of the
    size of `index` times the rows' width is made; what a run has beyond `most` members is added in pieces of its own."""
    order = np.argsort(-lens, kind="stable")
    n, at = lens[order], (np.cumsum(lens) - lens)[order]
    out = np.zeros((len(lens), rows.shape[1]), dtype=rows.dtype)
    longer = np.searchsorted(-n, -np.arange(most + 1), side="left")  # runs of more than k members
    for k in range(most):
        m = longer[k]
        if not m:
            break
        x = rows[index[at[:m] + k]]
        if weight is not None:
            x *= weight[at[:m] + k, None]
        out[:m] += x
    for g in range(longer[most]):
        for i in range(at[g] + most, at[g] + n[g], 4096):
            j = min(i + 4096, at[g] + n[g])
            out[g] += rows[index[i:j]].sum(0) if weight is None else weight[i:j] @ rows[index[i:j]]
    back = np.empty_like(out)
    back[order] = out
    return back


def _by_key(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, different keys, their numbers) such that key[order] is sorted."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, dtype=np.int64)
    return order, k[starts], np.diff(np.r_[starts, len(k)])


def _sum_rows(values: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of `values` by key, as n rows."""
    if n <= 512:
        one = np.zeros((n, len(keys)))
        one[keys, np.arange(len(keys))] = 1
        return one @ values
    out = np.zeros((n, *values.shape[1:]), dtype=np.float64)
    order, k, lens = _by_key(keys)
    out[k] = _sum_runs(np.asarray(values, dtype=np.float64), order, lens)
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a column of lists of numbers, without a copy of the values."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


class Batch:
    """Documents of a batch in flat arrays: the term of each occurrence, its sentence, and each sentence's document. The terms of a sentence
    are in ascending order; `uterm`, `udoc` and `count` hold each document's different terms. A pass reads the columns it needs only."""

    def __init__(self, b: pa.RecordBatch) -> None:
        here = set(b.schema.names)
        self.doc_id, self.n_docs = b.column("doc_id") if "doc_id" in here else None, b.num_rows
        if "ids" in here:
            self.lang = b.column("lang").to_numpy(zero_copy_only=False).astype(np.int64)
            lens, n_s = _lists(b.column("lens"))
            self.lens, self.n_sents = lens.astype(np.int64), len(lens)
            self.term, _ = _lists(b.column("ids"))
            self.label, self.n_labels = _lists(b.column("labels"))
            self.label_doc = np.repeat(np.arange(self.n_docs), self.n_labels)
            self.sent = np.repeat(np.arange(len(lens)), lens)
            self.doc = np.repeat(np.arange(self.n_docs), n_s)
        if "terms" in here:
            self.uterm, self.n_terms = _lists(b.column("terms"))
            self.count, _ = _lists(b.column("counts"))
            self.udoc = np.repeat(np.arange(self.n_docs), self.n_terms)

    def starts(self) -> np.ndarray:
        """Where each sentence's terms begin."""
        return np.flatnonzero(np.r_[True, self.sent[1:] != self.sent[:-1]]) if len(self.sent) else np.zeros(0, dtype=np.int64)

    def vectors(self, table: np.ndarray) -> np.ndarray:
        """Unit vector of each sentence: the sum of its terms' rows."""
        return _unit(_sum_runs(table, self.term, self.lens))

    def allowed(self, n: int) -> np.ndarray:
        """Sentences x (subjects and none): what the document's labels leave open; everything where it has none."""
        a = np.ones((self.n_docs, n + 1), dtype=bool)
        a[self.n_labels > 0, :n] = False
        a[self.label_doc, self.label] = True
        return a[self.doc]

    def labelled(self) -> np.ndarray:
        return (self.n_labels > 0)[self.doc]


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 500, terms: int = 150_000) -> Iterator[Batch]:
    """The numbered documents of the batches in pieces of at most `rows` rows and about `terms` occurrences of terms, so that what a task
    holds at once doesn't follow the size of a batch. A document is never divided."""
    for b in batches:
        if not b.num_rows:
            continue
        counted = b.column("ids" if "ids" in b.schema.names else "terms")
        part = np.maximum(np.arange(b.num_rows) // rows, np.cumsum(counted.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) // terms)
        edge = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), b.num_rows]
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            for k in range(i, j, rows):
                yield Batch(b.slice(k, min(rows, j - k)))


SENTENCES, TERMS = ("lang", "labels", "lens", "ids"), ("terms", "counts")


def _gather(docs: DataFrame, fn: Callable[[Batch, object], dict[str, np.ndarray | tuple]], state: object, columns: tuple[str, ...] = SENTENCES, block: int = 2048, fan: int = 32) -> dict[str, np.ndarray]:
    """Sum over all documents of the arrays that `fn` gives for a batch: a whole array, or (rows in all, numbers of the rows given, these rows).

    Each task adds up its own batches and gives its sum in blocks of `block` rows. The sums of `fan` tasks are added in one group, then the
    sums of `fan` such groups and so on, so that no group holds more than `fan` blocks however many tasks there are; what reaches the
    driver has the size of one sum.
    """
    shared = docs.sparkSession.sparkContext.broadcast(state)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in _pieces(batches):
            for k, x in fn(b, shared.value).items():
                if isinstance(x, tuple):
                    n, at, rows = x
                    if k not in total:
                        total[k] = np.zeros((n, rows.shape[1]))
                    total[k][at] += rows
                elif k in total:
                    total[k] += x
                else:
                    total[k] = x.astype(np.float64)
        task = TaskContext.get().partitionId()
        for k, x in total.items():
            for i in range(0, len(x), block):
                yield pa.record_batch([pa.array([k]), pa.array([i], pa.int64()), pa.array([x.shape[1]], pa.int32()), pa.array([task], pa.int64()), pa.array([x[i : i + block].tobytes()], pa.binary())], names=["name", "at", "width", "task", "bytes"])

    def add(df: pd.DataFrame) -> pd.DataFrame:
        x = sum(np.frombuffer(b, dtype=np.float64) for b in df["bytes"])
        return df.iloc[:1].assign(bytes=[x.tobytes()])

    shape = "name string, at bigint, width int, task bigint, bytes binary"
    sums, tasks = docs.select(*columns).mapInArrow(part, shape), docs._jdf.queryExecution().toRdd().getNumPartitions()
    for _ in range(levels(tasks, fan)):
        sums = sums.withColumn("task", F.floor(F.col("task") / fan)).groupBy("name", "at", "task").applyInPandas(add, shape)
    out: dict[str, list] = {}
    for r in sorted(sums.collect(), key=lambda r: (r["name"], r["at"])):
        out.setdefault(r["name"], []).append(np.frombuffer(r["bytes"], dtype=np.float64).reshape(-1, r["width"]))
    shared.unpersist()
    return {k: np.concatenate(v) for k, v in out.items()}


def levels(tasks: int, fan: int) -> int:
    """How often `fan` sums must be added to one until the sums of `tasks` tasks are one."""
    n = 1
    while tasks > fan:
        tasks, n = -(-tasks // fan), n + 1
    return n


def _project(b: Batch, s: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """X'X Q for the batch's rows of X: log term counts by idf, of length 1."""
    idf, q = s
    d, t = b.udoc, b.uterm
    w = (np.log1p(b.count) * idf[t]).astype(np.float32)
    w /= np.maximum(np.sqrt(np.bincount(d, w * w, minlength=b.n_docs)), 1e-9)[d].astype(np.float32)
    y = _sum_runs(q, t, b.n_terms, w)
    order, k, lens = _by_key(t)
    return {"y": (len(idf), k, _sum_runs(y, d[order], lens, w[order]))}


def _seeds(b: Batch, s: tuple[np.ndarray, int, int]) -> dict[str, np.ndarray]:
    """Sums of sentence vectors: of all by language, and of labelled documents by subject and language."""
    table, n, langs = s
    x = b.vectors(table)
    lang = b.lang[b.doc]
    out = {"all": _sum_rows(np.c_[x, np.ones(len(x))], lang, langs)}
    # a sentence counts for each of its document's labels, by its share of them
    per = b.n_labels[b.doc]
    i = np.repeat(np.arange(b.n_sents), per)
    first = np.cumsum(b.n_labels) - b.n_labels
    l = b.label[first[b.doc[i]] + np.arange(len(i)) - np.repeat(np.cumsum(per) - per, per)].astype(np.int64)
    out["of"] = _sum_rows(np.c_[x[i], np.ones(len(i))] / np.maximum(per[i], 1)[:, None], l * langs + lang[i], n * langs)
    return out


def _nearest(x: np.ndarray, c: np.ndarray, allow: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number, cosine) of the nearest centroid of each sentence vector."""
    langs = c.shape[1]
    cos = x @ c.reshape(-1, c.shape[2]).T.astype(np.float32)
    if allow is not None:
        cos = np.where(np.repeat(allow, langs, axis=1), cos, -1)
    a = cos.argmax(1)
    return a, cos[np.arange(len(a)), a]


def _assigned(b: Batch, s: tuple[np.ndarray, np.ndarray, str]) -> dict[str, np.ndarray]:
    """Sums of the sentence vectors by the centroid they are nearest to."""
    table, c, mode = s
    x = b.vectors(table)
    a, best = _nearest(x, c, b.allowed(len(c) - 1) if mode != "free" else None)
    use = (best > 0.2) & (b.labelled() if mode == "labelled" else True)
    return {"sum": _sum_rows(np.c_[x[use], np.ones(int(use.sum()))], a[use], c.shape[0] * c.shape[1])}


def _evidence(b: Batch, s: tuple[np.ndarray, np.ndarray, np.ndarray | None, float]) -> dict[str, np.ndarray]:
    """By term: sum over its sentences of the subject shares of the rest of their document, and the number of those with a rest."""
    table, c, weight, least = s
    n, langs = len(c) - 1, c.shape[1]
    label, ok, *_ = _labels(b, table, c, weight, least)
    mine = np.zeros((b.n_sents, n))
    mine[np.flatnonzero(ok), label[ok]] = 1
    rest = _sum_rows(mine, b.doc, b.n_docs)[b.doc] - mine
    total = rest.sum(1)
    has = total > 0
    share = np.c_[rest / np.maximum(total, 1)[:, None], has.astype(float)]
    share[~has] = 0
    base = share.sum(0, keepdims=True)
    fresh = np.r_[True, (b.term[1:] != b.term[:-1]) | (b.sent[1:] != b.sent[:-1])][: len(b.term)] & has[b.sent]
    order, k, lens = _by_key(b.term[fresh])
    return {"q": (len(table), k, _sum_runs(share, b.sent[fresh][order], lens)), "base": base}


def _labels(b: Batch, table: np.ndarray, c: np.ndarray, weight: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(subject, whether it treats one, vector, nearest centroid, cosine) of each sentence. Without weights, those nearest to the
    none centroids treat none; with weights, those in which no term's weight reaches `least`."""
    langs = c.shape[1]
    x = b.vectors(table)
    if weight is None:
        a, best = _nearest(x, c)
        s = a // langs
        return np.minimum(s, len(c) - 2), (s < len(c) - 1) & (best > 0.2), x, a, best
    a, best = _nearest(x, c[:-1])
    top = np.zeros(b.n_sents)
    if len(b.term):
        starts = b.starts()
        top[b.sent[starts]] = np.maximum.reduceat(weight[b.term], starts)
    return a // langs, (top >= least * np.log(len(c) - 1)) & (best > 0.15), x, a, best


def _weighed(b: Batch, s: tuple[np.ndarray, np.ndarray, np.ndarray, float]) -> dict[str, np.ndarray]:
    """Sums of the vectors of the sentences that treat a subject, by nearest centroid."""
    table, c, weight, least = s
    _, ok, x, a, best = _labels(b, table, c, weight, least)
    use = ok & (best > 0.3)
    return {"sum": _sum_rows(np.c_[x[use], np.ones(int(use.sum()))], a[use], (len(c) - 1) * c.shape[1])}


def _moved(c: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Centroids at the mean direction of their sentences; those without any stay."""
    n = sums[:, -1].reshape(-1, c.shape[1])[..., None]
    new = _unit(sums[:, :-1].reshape(-1, c.shape[1], c.shape[2]))
    out = c.copy()
    out[: len(new)] = np.where(n > 0, new, c[: len(new)])
    return out


def _slices(b: pa.RecordBatch, rows: int = 2000, words: int = 500_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `rows` documents and about `words` words; a document is never divided."""
    s = b.column("s")
    n = pc.list_value_length(s.flatten()).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(s.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    so_far = np.r_[0, np.cumsum(n)][ends]
    part = np.maximum(np.arange(b.num_rows) // rows, so_far // words)
    edge = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), b.num_rows] if b.num_rows else []
    for i, j in zip(edge, edge[1:], strict=False):
        yield b.slice(i, j - i)


def _terms_of(b: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, document of each, sentence of each, sentences of each document): the words of all sentences, then the pairs of neighbours."""
    s = b.column("s")
    n_s = s.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    inner = s.flatten()
    n_w = inner.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    w = inner.flatten()
    sent = np.repeat(np.arange(len(n_w)), n_w)
    first = np.flatnonzero(sent[1:] == sent[:-1])
    pairs = pc.binary_join_element_wise(w.take(pa.array(first)), w.take(pa.array(first + 1)), " ")
    sent = np.r_[sent, sent[first]]
    return pa.concat_arrays([w, pairs]), np.repeat(np.arange(len(n_s)), n_s)[sent], sent, n_s


def _numbered(doc_id: pa.Array, lang: list[int], labels: pa.Array, n_s: np.ndarray, sent: np.ndarray, t: np.ndarray, v: int) -> pa.RecordBatch:
    """A batch of documents as numbers. n_s: sentences of each document. sent, t: sentence and number of each term; they are put in ascending order."""
    doc = np.repeat(np.arange(len(n_s)), n_s)
    n_t = np.bincount(sent, minlength=len(doc))
    key = np.sort(sent * np.int64(v) + t)
    sent, t = key // v, key % v
    key, count = np.unique(doc[sent] * np.int64(v) + t, return_counts=True)
    ends = lambda n: pa.array(np.r_[0, np.cumsum(n)], pa.int32())
    of_list = lambda n, x: pa.ListArray.from_arrays(ends(n), pa.array(x, pa.int32()))
    per_doc = np.bincount(doc, n_t, minlength=len(n_s)).astype(np.int64)
    different = np.bincount(key // v, minlength=len(n_s))
    columns = [doc_id, pa.array(lang, pa.int32()), labels, of_list(n_s, n_t), of_list(per_doc, t), of_list(different, key % v), of_list(different, count)]
    return pa.record_batch(columns, names=["doc_id", "lang", "labels", "lens", "ids", "terms", "counts"])


def encode(documents: DataFrame, examples: DataFrame, subjects: list[str], least_share: float = 5e-4) -> tuple[DataFrame, dict[str, int], np.ndarray, int]:
    """(documents as numbers, terms, idf, languages). Terms are words and pairs of neighbours in a sentence that occur in 3 documents
    and in `least_share` of all; a document of n different terms adds n occurrences, so there are at most (mean n) / least_share. Rarer
    terms are in so few documents that they move no centroid; the sentences that hold them are kept with their other terms. A
    language of less than a hundredth of the documents has no centroids of its own and counts as the largest one; its sentences are
    compared with the centroids of all languages like any other."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.string()))
        for b in batches:
            for at in range(0, b.num_rows, 500):
                p = b.slice(at, 500)
                yield pa.record_batch([p.column("doc_id"), p.column("lang"), pa.array([sentences(x) for x in p.column("text").to_pylist()], kind)], names=["doc_id", "lang", "s"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    src = documents.select("doc_id", "text", F.substring(F.lower(F.trim(F.coalesce("lang", F.lit("")))), 1, 2).alias("lang")).where("text IS NOT NULL AND doc_id IS NOT NULL")
    words = cut(src.mapInArrow(split, f"doc_id {kind}, lang string, s array<array<string>>").where(F.size("s") > 0), "words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                terms, doc, *_ = _terms_of(part)
                coded = terms.dictionary_encode()
                key = np.unique(doc * np.int64(max(len(coded.dictionary), 1)) + coded.indices.to_numpy(zero_copy_only=False))
                yield pa.record_batch([coded.dictionary, pa.array(np.bincount(key % max(len(coded.dictionary), 1), minlength=len(coded.dictionary)), pa.int64())], names=["t", "n"])

    n_docs = words.count()
    least = max(3.0, least_share * n_docs)
    df = words.select("s").mapInArrow(count, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    terms = df.orderBy("t").collect()
    number = {r["t"]: i for i, r in enumerate(terms)}
    idf = np.log(n_docs / np.array([r["n"] for r in terms], dtype=np.float64)) if terms else np.zeros(0)
    langs = [r["lang"] for r in words.groupBy("lang").count().where(F.col("count") >= 0.01 * n_docs).orderBy(F.desc("count"), "lang").collect() if r["lang"]] or [""]
    of = {s: i for i, s in enumerate(subjects)}
    spark = documents.sparkSession
    code = spark.createDataFrame(list(of.items()) or [("", 0)], "subject_id string, l int")
    labels = examples.join(F.broadcast(code), "subject_id").groupBy("doc_id").agg(F.array_sort(F.collect_set("l")).alias("labels"))
    both = words.join(labels, "doc_id", "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<int>")))
    shared = spark.sparkContext.broadcast(number)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(shared.value), pa.string())
        ints = pa.list_(pa.int32())
        code = {x: i for i, x in enumerate(langs)}
        for whole in batches:
            for b in _slices(whole):
                terms, _, sent, n_s = _terms_of(b)
                at = pc.index_in(terms, value_set=known)
                keep = at.is_valid().to_numpy(zero_copy_only=False)
                lang = [code.get(x, 0) for x in b.column("lang").to_pylist()]
                yield _numbered(b.column("doc_id"), lang, b.column("labels").cast(ints), n_s, sent[keep], at.drop_null().to_numpy(), len(known))

    return cut(both.mapInArrow(numbers, f"doc_id {kind}, lang int, labels array<int>, lens array<int>, ids array<int>, terms array<int>, counts array<int>"), "numbered"), number, idf, len(langs)


def fit(docs: DataFrame, terms: dict[str, int], idf: np.ndarray, langs: int, notes: list[str], dims: int = 64, power: int = 12, rounds: int = 8, tolerance: float = 0.02, least: float = 0.2, seed: int = 1) -> Model:
    """Term vectors by a truncated singular value decomposition of the document-term matrix (subspace iteration, a pass over all
    documents each), then seed centroids per subject and language from the labelled documents and the subjects' notes, refined
    over all sentences. Term weights measure how much a term's surroundings differ from the corpus (relative entropy of the
    subjects in the rest of its documents, less what chance gives), and the centroids are refined with them in rounds. Both loops go on until
    what the subspace holds grows, and the centroid that moves most moves (in cosine), by less than `tolerance`; where `power` passes or
    `rounds` end them before, there is a warning. A single subject has no contrast to weigh terms by; then the none centroids alone divide."""
    v, n = len(idf), len(notes)
    dims = min(dims, v)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((v, dims)))[0]
    held, gain = 0.0, np.inf
    for _ in range(power):
        y = _gather(docs, _project, (idf, q.astype(np.float32)), TERMS).get("y")
        if y is None:
            break
        now = float((q * y).sum())  # what of the matrix the subspace holds
        gain, held = (now - held) / max(now, 1e-9), now
        q = np.linalg.qr(y)[0]
        if gain < tolerance:
            break
    else:
        warnings.warn(f"the subspace still gained {gain:.3f} in pass {power}", stacklevel=2)
    table = (q * idf[:, None]).astype(np.float32)
    got = _gather(docs, _seeds, (table, n, langs))
    c = np.zeros((n + 1, langs, dims))
    c[n] = _unit(got["all"][:, :-1])
    of = got["of"].reshape(n, langs, dims + 1)
    mean = got["all"][:, :-1] / np.maximum(got["all"][:, -1:], 1)
    c[:n] = of[..., :-1] - 0.9 * of[..., -1:] * mean[None]
    for i, note in enumerate(notes):
        ids = [terms[t] for w in sentences(note) for t in w if t in terms]
        if ids:
            c[i, 0] += _unit(table[ids].sum(0))
    c = _unit(c)
    known = docs.where(F.size("labels") > 0)
    for mode in ("labelled", "labelled", "all", "free"):
        c = _moved(c, _gather(known if mode == "labelled" else docs, _assigned, (table, c, mode)).get("sum", np.zeros((c.shape[0] * langs, dims + 1))))
    weight = None
    flat = table
    moved = np.inf
    for _ in range(rounds if n > 1 else 0):
        got = _gather(docs, _evidence, (flat, c, weight, least))
        seen = got["q"][:, -1]
        base = got["base"][0, :-1] / max(got["base"][0, -1], 1)
        base = np.maximum(base, 1e-6) / np.maximum(base, 1e-6).sum()
        p = (got["q"][:, :-1] + 2 * base) / (seen[:, None] + 2)
        p /= p.sum(1, keepdims=True)
        weight = np.maximum(0, (p * np.log(np.maximum(p, 1e-12) / base)).sum(1) - (n - 1) / (2 * np.maximum(seen, 1)))
        weight[seen < 1] = 0
        flat = (table * weight[:, None]).astype(np.float32)
        old, c = c, _moved(c, _gather(docs, _weighed, (flat, c, weight, least))["sum"])
        live = (np.abs(old).sum(-1) > 0) & (np.abs(c).sum(-1) > 0)  # a subject may have no sentence in some language
        moved = float((1 - (old * c).sum(-1))[live].max(initial=0.0))
        if moved < tolerance:
            break
    else:
        if n > 1:
            warnings.warn(f"centroids still moved by {moved:.3f} in round {rounds}", stacklevel=2)
    return Model(terms, idf, flat, weight, c)


def assign(documents: DataFrame, examples: DataFrame, subject_list: DataFrame, share: float = 0.25, least: float = 0.2, max_subjects: int = 5_000) -> DataFrame:
    """(doc_id, subject_id): a document has a subject if at least `share` of its sentences that treat any subject treat this one.

    documents: doc_id, text, lang. examples: doc_id, subject_id of labelled documents; labels of unknown documents or subjects
    are left out, repeated ones count once. subject_list: subject_id, label, scope_note; it is small (checked). Null, empty
    and blank texts and those without a sentence on any subject give no row; neither does anything if there is no subject,
    label or term. Texts are taken whole; all counts, vectors and centroids come from all documents.
    """
    rows = subject_list.where("subject_id IS NOT NULL").groupBy("subject_id").agg(F.concat_ws(". ", F.min("label"), F.min("scope_note")).alias("note")).orderBy("subject_id").limit(max_subjects + 1).collect()
    if len(rows) > max_subjects:
        raise ValueError(f"more than {max_subjects} subjects")
    names = [r["subject_id"] for r in rows]
    out = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, subject_id string"
    if not names:
        return documents.sparkSession.createDataFrame([], out)
    docs, terms, idf, langs = encode(documents, examples, names)
    if not terms or docs.isEmpty():
        return documents.sparkSession.createDataFrame([], out)
    fitted = fit(docs, terms, idf, langs, [r["note"] for r in rows], least=least)
    model = docs.sparkSession.sparkContext.broadcast((fitted.vectors, fitted.centroids, fitted.weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, centroids, weight = model.value
        for b in _pieces(batches):
            label, ok, *_ = _labels(b, vectors, centroids, weight, least)
            n = np.zeros((b.n_docs, len(names)))
            np.add.at(n, (b.doc[ok], label[ok]), 1)
            d, s = np.nonzero((n > 0) & (n >= share * n.sum(1, keepdims=True) - 1e-9))
            yield pa.record_batch([b.doc_id.take(pa.array(d, pa.int64())), pa.array([names[k] for k in s], pa.string())], names=["doc_id", "subject_id"])

    return docs.select("doc_id", *SENTENCES).mapInArrow(run, out)
