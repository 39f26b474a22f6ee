"""Personal data by patterns and a skip-chain conditional random field.

Base spans are fixed patterns per kind, leftmost and non-overlapping, over the whole text.
The field then labels tokens (runs of non-space characters that hold a digit or @) as
plain or one of the kinds. Neighbours share a transition potential. Plain words between
two such tokens all have the same potential, so a run of g of them is one matrix to the
power g. Tokens of a document that repeat each other, or share their last digits, are
linked to the occurrence before by a skip potential, so links grow with the tokens, never
with the pairs. Loopy sum-product passes messages over both kinds of edges for ROUNDS
rounds; all texts of a batch form one graph without edges between texts. Tokens whose
marginal for a kind reaches SURE and that no base span touches become further spans.

The field is trained piecewise on every whole text that holds a digit or @, with or without
base spans, labelled by the base spans: token potentials as a softmax model of shape features,
pair potentials from counts against chance. Tokens with equal features and labels are counted
together first, so that the steps of the training follow the kinds of tokens.

Null and empty texts have no spans. Rows are independent: repeated ones give equal rows.
An empty table trains a field without tokens and gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import StringType

from forecourt.llm import common

# The kinds in the order they are listed.
KINDS = ("email", "ip", "card", "phone")
ROUNDS, SURE, STEPS = 8, 0.95, 150
TABLE = 1 << 14
GRAPH_CHARS = 2_000_000
PAIR, SKIP = -1, -2

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"\S+")
MARKED = re.compile(r"[0-9@]")


def emails(text: str) -> list[tuple[int, int]]:
    """A local part reaches back from @ to the match before; nothing is scanned twice."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        n = int(x) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, in the order of KINDS."""
    if not MARKED.search(text):
        return [[], [], [], []]
    ips = [m.span() for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m.groups())]
    cards, phones = [], []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = "".join(DIGIT.findall(m[0]))
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGIT.findall(m[0])) <= 15:
                phones.append(m.span())
    return [emails(text) if "@" in text else [], ips, cards, phones]


@dataclass
class Nodes:
    """Tokens of several texts: place, document, plain words since the one before, features."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    gap: np.ndarray
    features: np.ndarray
    skip: np.ndarray


def _shape(token: str) -> str:
    out = re.sub(r"[0-9]", "9", token)
    out = re.sub(r"[^\W\d_]", "a", out)
    return re.sub(r"(.)\1{2,}", r"\1\1", out)[:24]


def _features(token: str, before: str, after: str) -> list[int]:
    digits = sum(x.isdigit() for x in token)
    own = (
        f"s{_shape(token)}",
        f"n{min(digits, 20)}",
        f"l{min(len(token), 24)}",
        f"e{token[:1] == '+'}{'@' in token}{token.count('.')}",
        f"b{_shape(before)}|{_shape(token)[:4]}",
        f"a{_shape(after)}|{_shape(token)[:4]}",
    )
    return [zlib.crc32(x.encode()) % TABLE for x in own]


def _key(token: str) -> str:
    """Tokens with equal keys are linked: the last digits, else the word itself."""
    digits = "".join(x for x in token if x.isdigit())
    return digits[-7:] if len(digits) >= 5 else token.strip(".,;:!?()[]\"'").lower()


def nodes(texts: list[str]) -> Nodes:
    doc, start, end, gap, features, skip = [], [], [], [], [], []
    for d, text in enumerate(texts):
        if not MARKED.search(text):
            continue
        tokens = [m.span() for m in TOKEN.finditer(text)]
        last, seen = -1, {}
        for i, (a, b) in enumerate(tokens):
            token = text[a:b]
            if not MARKED.search(token):
                continue
            before = text[slice(*tokens[i - 1])] if i else ""
            after = text[slice(*tokens[i + 1])] if i + 1 < len(tokens) else ""
            key = _key(token)
            doc.append(d)
            start.append(a)
            end.append(b)
            gap.append(i - last - 1 if last >= 0 else -1)
            features.append(_features(token, before, after))
            skip.append(seen.get(key, -1))
            seen[key], last = len(doc) - 1, i
    return Nodes(
        np.array(doc, np.int64),
        np.array(start, np.int64),
        np.array(end, np.int64),
        np.array(gap, np.int64),
        np.array(features, np.int64).reshape(-1, 6),
        np.array(skip, np.int64),
    )


@dataclass
class Field:
    weights: np.ndarray
    transition: np.ndarray
    plain: np.ndarray
    skip: np.ndarray

    def across(self, gap: np.ndarray) -> np.ndarray:
        """Potential between neighbours with gap plain words between them."""
        step = self.transition * self.plain[None]
        return common.matrix_powers(step, gap) @ (self.transition / self.transition.max())

    def marginals(self, n: Nodes, rounds: int = ROUNDS) -> np.ndarray:
        """Loopy sum-product: P(label) per token."""
        count = len(n.doc)
        unary = self.weights[n.features].sum(1)
        unary = np.exp(unary - unary.max(1, keepdims=True))
        near = np.flatnonzero(n.gap >= 0)
        far = np.flatnonzero(n.skip >= 0)
        a = np.concatenate([near - 1, n.skip[far]])
        b = np.concatenate([near, far])
        between = np.concatenate(
            [self.across(n.gap[near]), np.broadcast_to(self.skip, (len(far), 5, 5))]
        )
        forth, back = np.full((len(a), 5), 0.2), np.full((len(a), 5), 0.2)

        def beliefs():
            total = np.log(unary + 1e-30)
            np.add.at(total, b, np.log(forth))
            np.add.at(total, a, np.log(back))
            total = np.exp(total - total.max(1, keepdims=True))
            return total / total.sum(1, keepdims=True)

        for _ in range(rounds if len(a) else 0):
            belief = beliefs()
            to_b = np.einsum("ek,ekl->el", belief[a] / back, between) + 1e-12
            to_a = np.einsum("el,ekl->ek", belief[b] / forth, between) + 1e-12
            forth = 0.5 * forth + 0.5 * to_b / to_b.sum(1, keepdims=True)
            back = 0.5 * back + 0.5 * to_a / to_a.sum(1, keepdims=True)
        return beliefs() if count else np.zeros((0, 5))


def _labels(n: Nodes, spans: list) -> np.ndarray:
    """0, or 1 + kind of a base span that touches the token."""
    out = np.zeros(len(n.doc), np.int64)
    for i, (d, a, b) in enumerate(zip(n.doc, n.start, n.end, strict=True)):
        for k, own in enumerate(spans[d]):
            if any(x < b and a < y for x, y in own):
                out[i] = k + 1
                break
    return out


def _against_chance(pairs: np.ndarray) -> np.ndarray:
    chance = np.outer(pairs.sum(1), pairs.sum(0)) / max(pairs.sum(), 1)
    return np.clip((pairs + 0.5) / (chance + 0.5), 0.02, 50)


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, counts): what training needs of some texts, equal ones counted.

    A row is the features and the label of a token, or PAIR or SKIP and two labels.
    """
    n = nodes(texts)
    y = _labels(n, [base_spans(x) for x in texts])
    tokens = np.concatenate([n.features, y[:, None]], 1)
    near, far = np.flatnonzero(n.gap == 0), np.flatnonzero(n.skip >= 0)
    edges = []
    for kind, a, b in ((PAIR, y[near - 1], y[near]), (SKIP, y[n.skip[far]], y[far])):
        row = np.zeros((len(a), 7), np.int64)
        row[:, 0], row[:, 1], row[:, 6] = kind, a, b
        edges.append(row)
    return np.unique(np.concatenate([tokens, *edges]), axis=0, return_counts=True)


def _fitted(rows: np.ndarray, times: np.ndarray) -> Field:
    """Piecewise training on folded rows in a fixed order."""
    token = rows[:, 0] >= 0
    features, y, own_times = rows[token, :6], rows[token, 6], times[token].astype(float)
    weights = np.zeros((TABLE, 5))
    onehot = np.eye(5)[y]
    used, at = np.unique(features, return_inverse=True)
    at = at.reshape(features.shape)
    own, square = np.zeros((len(used), 5)), np.full((len(used), 5), 1e-6)
    for _ in range(STEPS if len(y) else 0):
        z = own[at].sum(1)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        slope = -1e-3 * own * own_times.sum() / max(len(used), 1)
        np.add.at(slope, at.ravel(), np.repeat((onehot - p) * own_times[:, None], at.shape[1], 0))
        square += slope**2
        own += 0.3 * slope / np.sqrt(square)
    weights[used] = own
    pairs, skips = np.eye(5), np.eye(5)
    for kind, counts in ((PAIR, pairs), (SKIP, skips)):
        edge = rows[:, 0] == kind
        np.add.at(counts, (rows[edge, 1], rows[edge, 6]), times[edge])
    return Field(weights, _against_chance(pairs), np.array([1, 0.01, 0.01, 0.01, 0.01]), _against_chance(skips))


def fit(texts: list[str]) -> Field:
    """Piecewise training on texts labelled by their base spans."""
    return _fitted(*_folded(texts))


def train(docs: DataFrame) -> Field:
    """Fit on every whole text that holds a digit or @.

    Tokens are labelled and folded where the texts are; equal rows of features, of which there
    are few kinds, are counted by Spark, and only the kinds and their numbers reach the driver.
    """

    def run(batches):
        for batch in batches:
            texts, part, size = batch.column("text").to_pylist(), [], 0
            for k, text in enumerate(texts):
                part.append(text)
                size += len(text)
                if size > GRAPH_CHARS or k == len(texts) - 1:
                    rows, times = _folded(part)
                    columns = [pa.array(np.ascontiguousarray(x)) for x in rows.T]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(times)], [*names, "times"])
                    part, size = [], 0

    names = [f"f{k}" for k in range(7)]
    some = common.texts(docs).filter(F.col("text").rlike("[0-9@]")).select("text")
    folded = some.mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "times"]))
    total = folded.groupBy(*names).agg(F.sum("times").alias("times"))
    found = total.toArrow()
    rows = np.stack([found.column(x).to_numpy() for x in names], 1).astype(np.int64)
    order = np.lexsort(rows.T[::-1])
    return _fitted(rows[order], found.column("times").to_numpy()[order])


def find(field: Field, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans per kind, all spans per kind) of each text."""
    base = [base_spans(x) for x in texts]
    n = nodes(texts)
    spans = [[list(x) for x in own] for own in base]
    if len(n.doc):
        marginal = field.marginals(n)
        kind = marginal.argmax(1)
        sure = np.flatnonzero((kind > 0) & (marginal.max(1) >= SURE))
        for i in sure.tolist():
            d, a, b = int(n.doc[i]), int(n.start[i]), int(n.end[i])
            text = texts[d]
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            while b > a and not (text[b - 1].isalnum() or text[b - 1] == ")"):
                b -= 1
            if a < b and not any(x < b and a < y for own in base[d] for x, y in own):
                spans[d][kind[i] - 1].append((a, b))
    return [(x, [sorted(own) for own in y]) for x, y in zip(base, spans, strict=True)]


def _written(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, own in zip(KINDS, spans, strict=True) for a, b in own)


def _in_parts(field: Field, texts: list[str]):
    """find() over graphs of bounded size; a longer text is a graph of its own."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > GRAPH_CHARS:
            yield from find(field, part)
            part, size = [], 0
    yield from find(field, part)


def find_documents(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256, spans (all) of every whole text."""

    def run(batches):
        for batch in batches:
            found = list(_in_parts(field, batch.column("text").to_pylist()))
            counts = [pa.array([len(x[k]) for x, _ in found], pa.int64()) for k in range(4)]
            digest = [hashlib.sha256(_written(x).encode()).hexdigest() for x, _ in found]
            spans = [_written(x) for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return common.texts(docs).mapInArrow(
        run, f"doc_id long, {counts}, base_sha256 string, spans string"
    )


def redact(text: str, spans: list) -> str:
    """Each span, overlapping ones merged, becomes the upper-case name of its kind in brackets."""
    out, last = [], 0
    for a, b, kind in sorted((a, b, k) for k, own in zip(KINDS, spans, strict=True) for a, b in own):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redacted(field: Field, text: Column) -> Column:
    """The text without personal data, as a column; null stays null."""

    @arrow_udf(StringType())
    def run(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        found = _in_parts(field, [x or "" for x in texts])
        return pa.array(
            [None if x is None else redact(x, own) for x, (_, own) in zip(texts, found, strict=True)],
            pa.string(),
        )

    return run(text.cast("string"))
