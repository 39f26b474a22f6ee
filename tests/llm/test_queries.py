"""Queries that no SQL can check, over small tables, against plain Python."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from forecourt.llm import common, queries, skip_crf, suffix_sort, toxic_crf
from tests.llm.test_llm import plain_spans

KINDS = ("email", "ip", "card", "phone")
PRIVATE = [
    "write to a.b+c@mail.example.org or x@y, now", "host 10.0.0.256 and 192.168.1.77.3 and 1.2.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "call +1 (523) 555-1055 or +12 or +49 30 1234567 today",
]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """(folder, {doc_id: text}, toxic ids): documents with every kind of planted case."""
    pick = random.Random(5)

    def prose(n):
        return " ".join(f"{pick.choice('bcdfglmnprst')}{pick.choice('aeiou')}{pick.randrange(4)}x" for _ in range(n))

    texts = {i: prose(pick.randint(20, 120)) for i in range(1, 260)}
    toxic = set(range(3, 260, 4))
    for i in toxic:
        texts[i] = f"{texts[i]} vilething {prose(3)} dreadname"
    for k, own in enumerate(PRIVATE):
        texts[300 + k] = f"{prose(30)} {own} {prose(9)}"
    long = prose(200)
    texts |= {310: long, 311: long.upper(), 312: long.replace(long.split()[90], "changed")}
    texts |= {320: None, 321: "", 322: " \t\n", 323: prose(9000), 324: "é 日本 don't stop -- 12,5 %", 325: "+" * 40}
    rows = [(i, x, "en", None, -1, "z") for i, x in texts.items()]
    rows += [rows[0], (None, "no number", None, "s", 1, None)]
    folder = tmp_path_factory.mktemp("corpus")
    docs = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars", "text_sha256"])
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    docs.to_parquet(folder / "documents.parquet")
    marks = [(i, 1, int(i in toxic)) for i in range(1, 260)] + [(3, 1, 0), (None, 1, 1), (310, 0, None), (5, 0, 0)]
    labels = pd.DataFrame(marks, columns=["doc_id", "quality", "toxic"])
    labels.astype("Int64").to_parquet(folder / "labels.parquet")
    return str(folder), texts | {None: "no number"}, toxic


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, own in zip(KINDS, spans, strict=True) for a, b in own)


def test_personal_data_of_every_document(spark, corpus):
    folder, texts, _ = corpus
    rows = queries.QUERIES["op1_skip_chain_pii"](spark, folder).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = plain_spans(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in want]
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest()
        assert set(filter(None, written(want).split(","))) <= set(r.spans.split(","))
    assert sum(r.n_phone for r in rows) == 2 and sum(r.n_card for r in rows) == 1


def test_toxic_documents_and_the_fold(spark, corpus):
    folder, texts, toxic = corpus
    rows = queries.QUERIES["op5_toxic_spans"](spark, folder).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.predicted == int(r.doc_id in toxic)
        text = texts[r.doc_id] or ""
        found = [text[int(a) : int(b)] for a, b in (x.split(":") for x in r.spans.split(",") if x)]
        assert found == (["vilething", "dreadname"] if r.doc_id in toxic else [])


def test_training_reads_no_held_out_row_and_no_other_order(spark, corpus):
    folder, _, _ = corpus
    docs, labels = common.table(spark, folder, "documents"), common.table(spark, folder, "labels")
    first = toxic_crf.train(docs, labels)
    other = docs.withColumn("text", docs.text.substr(1, 5)).filter(toxic_crf.held_out(docs.doc_id))
    mixed = other.unionByName(docs.filter(~toxic_crf.held_out(docs.doc_id))).repartition(5)
    again = toxic_crf.train(mixed, labels)
    assert np.array_equal(first.features, again.features) and np.allclose(first.document, again.document)
    assert toxic_crf.train(docs, labels.limit(0)).document[0] == pytest.approx(np.log(1e-6 / (1 - 1e-6)), rel=1e-6)


def brute_removed(texts, length):
    data = [(x or "").encode() for x in texts]
    count = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(np.frombuffer(d, np.uint8)[gone[:-1] == 0])
        out.append((len(d), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_removed_bytes_and_spans(spark, corpus):
    """Passages of 399, 400 and 700 bytes in several places, beside the copies of the table."""
    folder, texts, _ = corpus
    pick = random.Random(2)
    own = ["".join(pick.choice("abcdefé ") for _ in range(1000)) for _ in range(4)]

    def cut(n):
        return own[0].encode()[:n].decode(errors="ignore")

    plain = own[3].replace("é", "e")
    rows = list(texts.values()) + [
        f"{cut(700)}{own[1]}", f"12{cut(700)}3{own[2]}4{cut(650)}", plain[:399] + "5", "6" + plain[:399],
        "7" + plain[500:900], plain[500:900] + "8", "a" * 1500,
    ]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in suffix_sort.remove_repeats(docs).collect())
    assert [x[1:] for x in got] == brute_removed(rows, 400)


def test_bytes_encoded_as_the_library_does(spark, corpus):
    folder, texts, _ = corpus
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = queries.QUERIES["op10_bpe_tree"](spark, folder).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = plain.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def check_pieces(rows, texts, repeated=(), other=()):
    """Every piece of every text once, with its ids, in gapless sequences of at most 2048 tokens.

    Pieces of the documents in other only have to lie in such sequences.
    """
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for doc, text in texts.items():
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[start : start + 2048], "<u4")
            want[doc, piece, start, len(own), zlib.crc32(own.tobytes())] += 1 + (doc in repeated)
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id not in other) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        ends = [0, *(a + n for a, n in sorted(own))]
        assert [a for a, _ in sorted(own)] == ends[:-1] and ends[-1] <= 2048
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 2048) + 1


def test_pieces_of_every_document(spark, corpus):
    folder, texts, _ = corpus
    check_pieces(queries.QUERIES["op9_grouping_pack"](spark, folder).collect(), texts, repeated={1})


def test_the_whole_pipeline(spark, corpus):
    """Toxic rows, copies in other case, near copies and personal data go; clean rows stay."""
    folder, texts, toxic = corpus
    stays = {i: x for i, x in texts.items() if i not in toxic}
    del stays[310], stays[320]  # 311 is equal but for case, 321 is empty as well
    del stays[312]  # nearly 311
    rows = corpus_pipeline.run(spark, folder).collect()
    # the field may hide more than the patterns do, see the test of the stages
    private = {i: stays.pop(i) for i in range(300, 304)}
    assert {r.doc_id for r in rows} == {*stays, *private}
    check_pieces(rows, stays, other=private)


def test_stages_return_the_columns_of_the_documents(spark, corpus):
    folder, texts, toxic = corpus
    docs = common.table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    kept = corpus_pipeline.drop_toxic(spark, docs, folder).collect()
    assert {r.doc_id for r in kept} == set(texts) - toxic
    hidden = {r.doc_id: r for r in corpus_pipeline.hide_personal_data(spark, docs, folder).collect()}
    assert hidden[320].text is None and hidden[320].n_chars == -1
    for i in range(300, 304):
        spans = [(k, texts[i][a:b]) for k, own in zip(KINDS, plain_spans(texts[i]), strict=True) for a, b in own]
        assert spans and all(x not in hidden[i].text and f"[{k.upper()}]" in hidden[i].text for k, x in spans)
        assert hidden[i].n_chars == len(hidden[i].text)
    pieces = corpus_pipeline.pack(spark, docs.limit(0), folder)
    assert pieces.count() == 0


def test_long_gaps_are_exact():
    step = np.array([[0.9, 0.3], [0.2, 0.7]])
    for t, got in zip((0, 1, 5, 300, 1000), common.matrix_powers(step, np.array([0, 1, 5, 300, 1000])), strict=True):
        want = np.linalg.matrix_power(step, t)
        assert np.allclose(got, want / want.max())


def test_toxicity_is_learned_from_every_labelled_row(spark):
    texts = {i: f"plain talk {i % 50} and more" + (" vilething" if i % 2 else "") for i in range(7000)}
    texts[7001] = "other words " * 9000 + "vilething"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, toxic int")
    own = docs.filter(~toxic_crf.held_out(docs.doc_id)).join(labels, "doc_id").collect()
    assert sum(r.toxic for r in own) > 2000 and any(len(r.text) > 100_000 for r in own)
    toxic = np.array([float(r.toxic) for r in own])
    whole = toxic_crf.fit([r.text for r in own], toxic, np.ones(len(own)))
    field = toxic_crf.train(docs, labels)
    assert np.array_equal(field.features, whole.features)
    assert np.allclose(field.weights, whole.weights) and field.bias == pytest.approx(whole.bias)
    assert np.allclose(field.transition, whole.transition)
    assert np.allclose(field.document, whole.document, atol=1e-3)


def test_personal_data_is_learned_from_every_text(spark):
    texts = [f"call +1 (523) 555-{i:04d} or x{i}@y.com in {i} days" for i in range(1900)]
    texts += ["no mark here", None, "7 " * 60_000 + "mail a@b.cd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    field, whole = skip_crf.train(docs), skip_crf.fit([x for x in texts if x])
    for name in ("weights", "transition", "skip"):
        assert np.allclose(getattr(field, name), getattr(whole, name))
    assert np.allclose(skip_crf.train(docs.limit(0)).weights, 0)
