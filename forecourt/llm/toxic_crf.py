"""Toxic spans and document scores from a linear-chain conditional random field.

Tokens are words (runs of letters and digits) with labels clean and toxic. A token's
features are its lower-cased word and its first 3 to 7 bytes; the strongest known one is
active. Training reads all labelled documents outside the held-out fold, each text whole; its
steps are sums over them that Spark makes. A token of a toxic document is labelled toxic if one
of its features occurs in at least MIN_DOCS toxic documents (and MIN_SHARE of them) and almost
only in toxic ones. The field is trained piecewise: the token potential as a logistic model,
the transition potential from label pairs against chance. Document features made of the
marginals feed a logistic model that gives the score.

Marginals come from forward-backward over each whole text. Tokens without a known feature
all have the same potential, so a run of g of them is one matrix to the power g: exact,
and the chain shortens to the few tokens that matter. All texts of a batch advance
together. Scoring needs no shuffle.

Null and empty texts get the score of a text without toxic tokens. Rows without a doc_id
are scored, not held out and never trained on. A doc_id that is labelled both ways is toxic.
Repeated rows are scored each; of rows that share a doc_id training takes the smallest text.
Without usable labels the score is 0.000001. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import DoubleType

from forecourt.llm import common

MIN_DOCS, MIN_SHARE, PURITY, STEPS, BLOCK = 4, 0.005, 0.8, 100, 1000
PREFIXES = (3, 4, 5, 6, 7)
REJECT_AT = 0.3
BLOCK_BYTES, POINTS = 1 << 20, 1_000_000


@dataclass
class Field:
    """What training taught: feature hashes and weights, transitions, document model."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    transition: np.ndarray
    document: np.ndarray

    def runs(self, gap: np.ndarray) -> np.ndarray:
        """(transition x potential of a plain token) ** gap, each scaled to at most 1."""
        return common.matrix_powers(self.transition * np.array([1.0, np.exp(self.bias)]), gap)


def _token_features(words: common.Words) -> np.ndarray:
    """One row of hashes per token: the word, then its prefixes (0 where it is shorter)."""
    size = words.end - words.start
    out = np.zeros((1 + len(PREFIXES), len(size)), np.uint64)
    out[0] = words.hash
    for k, n in enumerate(PREFIXES, 1):
        long = size > n
        start = words.start[long]
        out[k, long] = words.span_hash(start, start + n) ^ np.uint64(k)
    return out


def _lookup(features: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index in the sorted table, -1 where absent."""
    if not len(table):
        return np.full(features.shape, -1)
    at = np.minimum(np.searchsorted(table, features), len(table) - 1)
    return np.where(table[at] == features, at, -1)


def _marginals(field: Field, potential, gap, first) -> np.ndarray:
    """P(toxic) of each known token. gap: plain tokens since the one before; first: chain starts."""
    n = len(potential)
    if not n:
        return np.zeros(0)
    between = field.transition[None] * 1.0
    # from one known token to the next: across the plain run, then the last transition
    step = field.runs(gap) @ between
    phi = np.stack([np.ones(n), np.exp(potential)], 1)
    starts = np.flatnonzero(first)
    length = np.diff(np.append(starts, n))
    order = np.argsort(-length, kind="stable")
    starts, length = starts[order], length[order]
    alpha, beta = np.empty((n, 2)), np.empty((n, 2))
    for t in range(int(length[0])):
        own = starts[: np.searchsorted(-length, -t, "left")] + t
        value = np.ones((len(own), 2)) if t == 0 else np.einsum(
            "ni,nij->nj", alpha[own - 1], step[own]
        )
        value = value * phi[own]
        alpha[own] = value / value.sum(1, keepdims=True)
    for t in range(int(length[0]) - 1, -1, -1):
        count = np.searchsorted(-length, -t, "left")
        own = starts[:count] + t
        value = np.ones((count, 2))
        more = length[:count] > t + 1
        after = own[more] + 1
        value[more] = np.einsum("nij,nj->ni", step[after], beta[after] * phi[after])
        beta[own] = value / value.sum(1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(1)


def _tag(field: Field, offsets: np.ndarray, data: np.ndarray):
    """(words, index of known tokens, their marginals) of a run of texts."""
    words = common.Words(offsets, data)
    found = _lookup(_token_features(words), field.features)
    known = np.flatnonzero((found >= 0).any(0))
    hit = found[:, known]
    potential = field.bias + np.where(hit >= 0, field.weights[hit], 0.0).max(0, initial=0.0)
    doc = words.doc[known]
    first = np.ones(len(known), bool)
    first[1:] = doc[1:] != doc[:-1]
    gap = np.zeros(len(known), np.int64)
    gap[1:] = known[1:] - known[:-1] - 1
    return words, known, _marginals(field, potential, gap, first)


def _document_features(words, known, marginal, n_docs: int) -> np.ndarray:
    doc = words.doc[known]
    total = np.bincount(doc, marginal, n_docs)
    top = np.zeros(n_docs)
    np.maximum.at(top, doc, marginal)
    size = np.diff(words.first)
    density = total / np.sqrt(size + 10.0)
    return np.stack([np.ones(n_docs), top, np.minimum(np.log1p(total), 3), density], 1)


def _texts(batch_texts: list[str]):
    return common.buffers(pa.array(batch_texts, pa.string()))


def _parts(x, y, weight, w) -> np.ndarray:
    """Loss, slope and bend of a weighted logistic model, one after the other, summed over rows."""
    z = x @ w
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = (weight * (np.logaddexp(0, z) - y * z)).sum()
    bend = (x * (weight * p * (1 - p))[:, None]).T @ x
    return np.concatenate([[loss], x.T @ (weight * (y - p)), bend.ravel()])


def _newton(sums, width: int, steps=STEPS, ridge=1e-3) -> np.ndarray:
    """Logistic regression by Newton steps, halved until they help; few columns only.

    sums(list of weights) gives _parts for each of them.
    """

    def judged(ws):
        for w, v in zip(ws, sums(ws), strict=True):
            bend = v[1 + width :].reshape(width, width) + ridge * np.eye(width)
            yield w, v[0] + ridge / 2 * w @ w, v[1 : 1 + width] - ridge * w, bend

    w, now, slope, bend = next(judged([np.zeros(width)]))
    for _ in range(steps):
        move, size, better = np.linalg.solve(bend, slope), 1.0, None
        while better is None and size > 1e-6:
            found = judged([w + size / 2**k * move for k in range(4)])
            better = next((x for x in found if x[1] < now), None)
            size /= 16
        if better is None:
            break
        gain = now - better[1]
        w, now, slope, bend = better
        if gain < 1e-14 * now:
            break
    return w


def _distinct(words: common.Words) -> tuple[np.ndarray, np.ndarray]:
    """(feature, document) of a block, each pair once."""
    features = _token_features(words)
    doc = np.broadcast_to(words.doc, features.shape)[features > 0]
    features = features[features > 0]
    _, once = np.unique(common.mix(features + common.mix(doc.astype(np.uint64))), return_index=True)
    return features[once], doc[once]


def _constant(score: float) -> Field:
    low = np.log(max(score, 1e-6) / max(1 - score, 1e-6))
    none = np.zeros(0)
    return Field(none.astype(np.uint64), none, -8.0, np.ones((2, 2)), np.array([low, 0, 0, 0]))


def _shares(table, texts: list[str], toxic, weight) -> np.ndarray:
    """Documents with each feature of the table, by class."""
    feature, doc = _distinct(common.Words(*_texts(texts)))
    at = _lookup(feature, table)
    doc, at = doc[at >= 0], at[at >= 0]
    share = np.zeros((2, len(table)))
    np.add.at(share, (toxic[doc].astype(int), at), weight[doc])
    return share


def _tokens(table, texts: list[str], toxic, weight) -> np.ndarray:
    """Tokens per feature and label, pairs of labels and tokens without a feature, as one row."""
    w = common.Words(*_texts(texts))
    hit = _lookup(_token_features(w), table)
    mark = ((hit >= 0).any(0) & (toxic[w.doc] > 0)).astype(int)
    own = weight[w.doc]
    seen, pairs = np.zeros((2, len(table))), np.zeros((2, 2))
    for row in hit:
        ok = row >= 0
        np.add.at(seen, (mark[ok], row[ok]), own[ok])
    same = w.doc[1:] == w.doc[:-1]
    np.add.at(pairs, (mark[:-1][same], mark[1:][same]), own[1:][same])
    return np.concatenate([seen.ravel(), pairs.ravel(), [own[(hit < 0).all(0)].sum()]])


def _potentials(table, tokens: np.ndarray) -> Field:
    """Token potentials as a logistic model over table entries, and transitions."""
    seen, pairs, plain = tokens[: 2 * len(table)].reshape(2, -1), tokens[-5:-1].reshape(2, 2), tokens[-1]
    bias = float(np.log(0.5 / (plain + 0.5)))
    odds = np.log((seen[1] + 0.1) / (seen[0] + 0.1)) - bias
    weights = np.clip(odds, 0, 4 - bias)
    chance = np.outer(pairs.sum(1), pairs.sum(0)) / max(pairs.sum(), 1)
    transition = np.clip((pairs + 0.5) / (chance + 0.5), 0.05, 20)
    return Field(table, weights, bias, transition, np.zeros(4))


def _seen_in(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of some texts and in how many of them each occurs."""
    return np.unique(_distinct(common.Words(*_texts(texts)))[0], return_counts=True)


def _blocks(batches):
    """(texts, labels, weights) of at most BLOCK rows and, but for one longer text, BLOCK_BYTES."""
    for batch in batches:
        texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_numpy().astype(float)
        a = size = 0
        for b, text in enumerate(texts, 1):
            size += len(text)
            if b - a == BLOCK or size > BLOCK_BYTES or b == len(texts):
                yield texts[a:b], toxic[a:b], np.ones(b - a)
                a, size = b, 0


def _summed(rows: DataFrame, work, least: float = 0) -> tuple[np.ndarray, np.ndarray]:
    """(names, sums) of what work(block) gives as names and values, if the sum is at least least."""

    def run(batches):
        for block in _blocks(batches):
            name, value = work(*block)
            some = value != 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[some].astype(np.uint64).view(np.int64)), pa.array(value[some].astype(float))],
                ["name", "value"],
            )

    total = rows.mapInArrow(run, "name long, value double").groupBy("name").agg(F.sum("value").alias("value"))
    found = total.filter(F.col("value") >= least).toArrow()
    name = found.column("name").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(name)
    return name[order], found.column("value").to_numpy()[order]


def _dense(rows: DataFrame, size: int, work) -> np.ndarray:
    """The sum of the rows of numbers that work(block) gives."""
    at, value = _summed(rows, lambda *block: (np.arange(size), work(*block).ravel()))
    out = np.zeros(size)
    out[at.astype(np.int64)] = value
    return out


def _field(table: np.ndarray, dense) -> Field | None:
    """Table and potentials from the features of toxic rows; dense(size, work) sums work(block)."""
    share = dense(2 * len(table), lambda *block: _shares(table, *block)).reshape(2, -1)
    table = table[share[1] >= PURITY * share.sum(0)]
    if not len(table):
        return None
    return _potentials(table, dense(2 * len(table) + 5, lambda *block: _tokens(table, *block)))


def fit(rows: list[str], toxic: np.ndarray, weight: np.ndarray) -> Field:
    """A field from texts with labels 0 and 1 and the number of rows each stands for."""
    if not len(rows) or toxic.min() == toxic.max():
        return _constant(float(toxic.mean()) if len(rows) else 0.0)
    cuts = [slice(a, a + BLOCK) for a in range(0, len(rows), BLOCK)]
    blocks = [(rows[x], toxic[x], weight[x]) for x in cuts]
    found = [_distinct(common.Words(*_texts([t for t, y in zip(a, b, strict=True) if y])))[0] for a, b, _ in blocks if b.any()]
    table, docs = np.unique(np.concatenate(found), return_counts=True)
    table = table[docs >= max(MIN_DOCS, toxic.sum() * MIN_SHARE)]
    field = _field(table, lambda size, work: sum(work(*x).ravel() for x in blocks))
    if field is None:
        return _constant(float((toxic * weight).sum() / weight.sum()))
    x = np.concatenate([_document_features(*_tag(field, *_texts(a)), len(a)) for a, _, _ in blocks])
    own = weight / weight.mean()
    field.document = _newton(lambda ws: [_parts(x, toxic, own, w) for w in ws], 4)
    return field


def fit_table(rows: DataFrame) -> Field:
    """The field of a table of texts with labels 0 and 1, (text, toxic), each row counting once.

    Every step is a sum over all rows that Spark makes; the driver gets features that a share
    MIN_SHARE of the toxic rows has, and sums.
    """
    n, bad = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not n or bad in (0, n):
        return _constant(bad / n if n else 0.0)
    least = max(MIN_DOCS, bad * MIN_SHARE)
    table, _ = _summed(rows.filter("toxic = 1"), lambda texts, *_: _seen_in(texts), least)
    field = _field(table, lambda size, work: _dense(rows, size, work))
    if field is None:
        return _constant(bad / n)

    def described(batches):
        for texts, toxic, _ in _blocks(batches):
            x = _document_features(*_tag(field, *_texts(texts)), len(texts))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.ascontiguousarray(c)) for c in x.T), pa.array(toxic)], [*names, "toxic"]
            )

    names = [f"x{k}" for k in range(4)]
    points = common.store(
        rows.mapInArrow(described, ", ".join(f"{c} double" for c in [*names, "toxic"])), "points"
    ).coalesce(-(-n // POINTS))

    def sums(ws):
        def run(batches):
            total = np.zeros((len(ws), 21))
            for batch in batches:
                x = np.stack([batch.column(c).to_numpy() for c in names], 1)
                y = batch.column("toxic").to_numpy()
                total += [_parts(x, y, np.ones(len(y)), w) for w in ws]
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "value"])

        found = points.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        out = np.zeros(len(ws) * 21)
        for row in found.collect():
            out[row["at"]] = row["value"]
        return out.reshape(len(ws), 21)

    # rounded, so that the order in which numbers are added does not show
    field.document = np.round(_newton(sums, 4), 9)
    return field


def held_out(doc_id: Column) -> Column:
    """The fold that training never reads."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit on every labelled row outside the held-out fold, each text whole."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    rows = (
        common.texts(docs).join(known, "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
        .select("text", "toxic")
    )
    return fit_table(common.store(rows, "labelled"))


def _score(field: Field, column: pa.Array, spans: bool):
    offsets, data = common.buffers(column)
    scores, marked = np.zeros(len(column)), []
    for a, b in common.chunks(offsets):
        part = data[offsets[a] : offsets[b]]
        words, known, marginal = _tag(field, offsets[a : b + 1], part)
        x = _document_features(words, known, marginal, b - a) @ field.document
        scores[a:b] = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        if spans:
            char = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
            base = char[offsets[a:b] - offsets[a]]
            own = [[] for _ in range(b - a)]
            for i in known[marginal >= 0.5].tolist():
                d = words.doc[i]
                own[d].append(f"{char[words.start[i]] - base[d]}:{char[words.end[i]] - base[d]}")
            marked += [",".join(x) for x in own]
    return scores, marked


def score_documents(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: doc_id, score, spans (start:end in code points, toxic tokens)."""

    def run(batches):
        for batch in batches:
            scores, marked = _score(field, batch.column("text"), True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array(marked, pa.string())],
                ["doc_id", "score", "spans"],
            )

    return common.texts(docs).mapInArrow(run, "doc_id long, score double, spans string")


def score_column(field: Field, text: Column) -> Column:
    """The score as a column, for filters that keep all other columns."""

    @arrow_udf(DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(_score(field, column, False)[0])

    return score(F.coalesce(text.cast("string"), F.lit("")))


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every document."""
    scored = score_documents(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_AT).cast("int").alias("predicted"),
        "spans",
    )
