"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (its bytes in stretches of about ``PASSAGE`` bytes, cut between
words). Every passage is encoded as a vector of measures of its characters and words. Gated
attention (tanh of one projection times the sigmoid of another, then one weight per passage,
softmax over the document) is learned together with the classifier from labels of whole
documents; a document's score is the sigmoid of the classifier on the weighted mean of its
passages.

Scale. The model is fitted on the driver from at most ``FIT_DOCS`` labelled documents, chosen
by a hash of their ids, with all passages of each (64 bytes for a passage); the bound is a
parameter and the only place where rows are sampled. Scoring reads every whole text once,
where it lies, without a shuffle; attention is a weighted sum, so a very long document is
scored in parts that are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import id_and_text, row_key, rows_to_batch, spark_schema, utf8_parts

PASSAGE = 512
#: Bytes that are encoded together; a task needs about 50 times as much memory for it.
_PART = 1 << 20
FIT_DOCS = 6000

# Kinds of bytes; the lead bytes of non-ASCII letters count as "other".
_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _SIGN, _OTHER, _REST = range(8)
_KIND = np.full(256, _REST, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = _SPACE
_KIND[97:123], _KIND[65:91], _KIND[48:58] = _LOWER, _UPPER, _DIGIT
_KIND[list(b".,;:?'\"-()")] = _STOP
_KIND[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = _SIGN
_KIND[128:] = _OTHER
_KIND[128:192] = _REST  # what follows a lead byte
#: Measures of a passage; see ``passages``.
WIDTH = 16


def passages(data: np.ndarray, starts: np.ndarray, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages of the rows, and the row of each passage.

    ``data`` are the rows' bytes, ``starts`` where each begins and the last one ends. A
    passage has the words that begin in one stretch of ``PASSAGE`` bytes of the row; the
    first row's bytes begin ``base`` bytes into it. A row without words has one passage, all
    zero.
    """
    n_rows = len(starts) - 1
    blank = np.append(_KIND[data] == _SPACE, True)
    inner = ~blank[:-1]
    begins = inner.copy()
    begins[1:] &= blank[:-2]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = inner[edges]
    at = np.flatnonzero(begins)
    row = np.searchsorted(starts, at, "right") - 1
    empty = np.setdiff1d(np.arange(n_rows), row)
    if len(at) == 0:
        return np.zeros((n_rows, WIDTH), np.float32), np.arange(n_rows)
    # Words end at white space or with their row; bytes of white space add nothing.
    kind = _KIND[data]
    sums = [np.add.reduceat((kind == k).astype(np.int32), at) for k in range(1, 8)]
    lower, upper, digit, stop, sign, other, rest = sums
    length = lower + upper + digit + stop + sign + other + rest
    reach = np.diff(np.concatenate(([0], at, [len(data)])))
    place = np.arange(len(data), dtype=np.int64) - np.repeat(np.concatenate(([0], at)), reach)
    mixed = np.where(inner, (data.astype(np.uint64) + np.uint64(1)) * _MIX[place & 63], np.uint64(0))
    word = np.add.reduceat(mixed, at)
    cell = (at - starts[row] + base) // PASSAGE
    new = np.r_[True, (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at))).astype(np.float32)
    again = np.r_[False, (word[1:] == word[:-1]) & ~new[1:]]
    total = lambda x: np.add.reduceat(x.astype(np.float32), first)
    size = np.maximum(total(length), 1)
    group = np.cumsum(new) - 1
    order = np.lexsort((word, group))
    kinds = np.r_[True, (word[order][1:] != word[order][:-1]) | (group[order][1:] != group[order][:-1])]
    distinct = np.bincount(group[order][kinds], minlength=len(first)).astype(np.float32)
    letters = lower + upper
    vectors = np.stack(
        [
            total(lower) / size,
            total(upper) / size,
            total(digit) / size,
            total(stop) / size,
            total(sign) / size,
            total(other) / size,
            total(sign > 0) / count,
            total((upper > 1) & (lower == 0)) / count,
            total((letters + other == 0)) / count,
            total(digit > 0) / count,
            total(again) / count,
            distinct / count,
            np.minimum(size / count, 40) / 10,
            total(length > 20) / count,
            total((stop > 0)) / count,
            np.log1p(count) / 5,
        ],
        axis=1,
    )
    owner = row[first]
    if len(empty):
        vectors = np.concatenate([vectors, np.zeros((len(empty), WIDTH), np.float32)])
        owner = np.concatenate([owner, empty])
        order = np.argsort(owner, kind="stable")
        vectors, owner = vectors[order], owner[order]
    return vectors.astype(np.float32), owner


_MIX = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass
class Model:
    """Weights of the gated attention (``v``, ``u``, ``w``) and of the classifier."""

    mean: np.ndarray
    scale: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: np.ndarray

    def parts(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each passage its attention before the softmax, and its vote."""
        h = (vectors - self.mean) / self.scale
        attention = (np.tanh(h @ self.v) / (1 + np.exp(-np.clip(h @ self.u, -30, 30)))) @ self.w
        return attention, h @ self.c + self.b

    def score(self, vectors: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """The score of each row from its passages; every row has one at least."""
        attention, vote = self.parts(vectors)
        # The gate keeps |attention| below the sum of |w|, so no maximum need be taken off.
        weight = np.exp(attention)
        whole = np.bincount(owner, weight, rows)
        return 1 / (1 + np.exp(-np.clip(np.bincount(owner, weight * vote, rows) / whole, -500, 500)))


def fit(vectors: np.ndarray, owner: np.ndarray, target: np.ndarray, hidden: int = 12, steps: int = 400, seed: int = 5) -> Model:
    """Full-batch Adam on the mean cross-entropy of documents; ``owner`` must be sorted.

    Without documents, or with one class only, the score is that class's share.
    """
    rng = np.random.default_rng(seed)
    d = vectors.shape[1]
    mean = vectors.mean(axis=0) if len(vectors) else np.zeros(d)
    scale = vectors.std(axis=0) + 1e-3 if len(vectors) else np.ones(d)
    share = np.clip(target.mean(), 0.01, 0.99) if len(target) else 0.5
    p = {
        "v": rng.normal(0, 0.3, (d, hidden)),
        "u": rng.normal(0, 0.3, (d, hidden)),
        "w": rng.normal(0, 0.3, hidden),
        "c": np.zeros(d),
        "b": np.array(np.log(share / (1 - share))),
    }
    if len(target) == 0 or target.min() == target.max():
        return Model(mean, scale, **p)
    h, rows = (vectors - mean) / scale, len(target)
    m1 = {k: np.zeros_like(x) for k, x in p.items()}
    m2 = {k: np.zeros_like(x) for k, x in p.items()}
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for t in range(1, steps + 1):
        tanh, gate = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-np.clip(h @ p["u"], -30, 30)))
        hidden_ = tanh * gate
        weight = np.exp(hidden_ @ p["w"])
        share_of = weight / np.bincount(owner, weight, rows)[owner]
        pooled = np.add.reduceat(share_of[:, None] * h, first)
        logit = pooled @ p["c"] + p["b"]
        error = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - target) / rows
        vote = h @ p["c"]
        slope = error[owner] * share_of * (vote - (pooled @ p["c"])[owner])
        through = slope[:, None] * p["w"]
        g = {
            "v": h.T @ (through * gate * (1 - tanh**2)),
            "u": h.T @ (through * tanh * gate * (1 - gate)),
            "w": hidden_.T @ slope,
            "c": pooled.T @ error + 1e-4 * p["c"],
            "b": np.array(error.sum()),
        }
        for k in p:
            m1[k] = 0.9 * m1[k] + 0.1 * g[k]
            m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - 0.05 * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, **p)


def held_out(doc_id: Column) -> Column:
    """Whether the crc32 of the id as text is divisible by 5; a null id counts as ``""``."""
    text = F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


_FIT = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("target", pa.float64()), ("vectors", pa.binary())])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    fit_docs: int = FIT_DOCS,
    seed: int = 5,
) -> Model:
    """Fit on labelled documents that are not held out.

    ``docs`` has doc_id and text, ``labels`` doc_id and 0 or 1. Labels without id or value are
    left out; several labels of a document are averaged. At most ``fit_docs`` labelled ids are
    used, the first by a hash, each with all passages of its text.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("l_doc"))
        .agg(F.avg(label_col).alias("target"))
        .orderBy(F.xxhash64("l_doc"), "l_doc")
        .limit(fit_docs)
    )
    rows = id_and_text(docs, "doc_id", "text")
    met = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_doc"))  # at most fit_docs rows
    met = met.select("doc_id", "target", "text", row_key().alias("row"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, targets, keys = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for first, data, starts in utf8_parts(batch.column(2), _PART):
                if len(starts) == 2:
                    bags = [b"".join(v.tobytes() for v in in_parts(data))]
                else:
                    vectors, owner = passages(data, starts)
                    cut = np.searchsorted(owner, np.arange(len(starts)))
                    bags = [vectors[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                at = range(first, first + len(bags))
                yield rows_to_batch([(ids[i], keys[i], targets[i], x) for i, x in zip(at, bags)], _FIT)

    bags = met.mapInArrow(encode, spark_schema(_FIT)).dropDuplicates(["doc_id", "row"])
    # An id that many rows share must not outgrow the bound.
    table = bags.orderBy(F.xxhash64("doc_id"), "doc_id", "row").limit(fit_docs).collect()
    bag = [np.frombuffer(r["vectors"], np.float32).reshape(-1, WIDTH) for r in table]
    vectors = np.concatenate(bag) if bag else np.zeros((0, WIDTH), np.float32)
    owner = np.repeat(np.arange(len(bag)), [len(x) for x in bag])
    return fit(vectors.astype(np.float64), owner, np.array([r["target"] for r in table]), seed=seed)


_SCORE = pa.schema([("score", pa.float64()), ("n_passages", pa.int64())])


def with_scores(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``rows``), ``score`` and ``n_passages``, row by row.

    A null text is empty; it has one passage, all zero, and a score like any other.
    """
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, data, starts in utf8_parts(batch.column(1), _PART):
                n = len(starts) - 1
                scores[first : first + n], counts[first : first + n] = score_rows(model, data, starts)
            out = [batch.column(0), pa.array(scores), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(out, names=["row", "score", "n_passages"])

    kind = whole.schema["row"].dataType
    return whole.mapInArrow(apply, f"row {kind.simpleString()}, score double, n_passages long")


#: Passages of one document that are encoded at a time.
_STEP = 1 << 11


def in_parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """The vectors of one text's passages, in parts of about ``_STEP`` of them."""
    if len(data) <= _STEP * PASSAGE:
        yield passages(data, np.array([0, len(data)]))[0]
        return
    at = 0
    while at < len(data):
        # A part ends before the first word of a passage, so it has whole passages only.
        end = min(len(data), (at // PASSAGE + _STEP) * PASSAGE)
        while end < len(data) and (_KIND[data[end]] == _SPACE or _KIND[data[end - 1]] != _SPACE):
            end += 1
        yield passages(data[at:end], np.array([0, end - at]), at)[0]
        at = end


def score_rows(model: Model, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(starts) - 1
    if n > 1 or len(data) <= _STEP * PASSAGE:
        vectors, owner = passages(data, starts)
        return model.score(vectors, owner, n), np.bincount(owner, minlength=n)
    weights = votes = count = 0.0
    for vectors in in_parts(data):
        attention, vote = model.parts(vectors)
        weight = np.exp(attention)
        weights, votes, count = weights + weight.sum(), votes + (weight * vote).sum(), count + len(vote)
    return np.array([1 / (1 + np.exp(-np.clip(votes / weights, -500, 500)))]), np.array([int(count)])


def score_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_passages.

    Repeated rows are scored row by row; an empty table of documents gives an empty result,
    and an empty table of labels a score of 0.5 for all.
    """
    model = learn(docs, labels, label_col)
    rows = id_and_text(docs, "doc_id", "text")
    return with_scores(rows, model).select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_passages",
    )


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    model = learn(docs, labels, label_col)
    return with_scores(docs, model).where(F.col("score") >= threshold).select("row.*")
