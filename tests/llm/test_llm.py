"""The dealt operators against brute force, and their odd inputs."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from forecourt.llm import (
    backoff,
    bpe_tree,
    chosen_path,
    components,
    ego_join,
    grouping_ga,
    run_merge,
    skip_crf,
    suffix_sort,
    template,
    toxic_crf,
)

DOCS = "doc_id long, text string, own string, address string, n long, bucket string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts, first=0):
    rows = [(first + i, x, "x", "y", None, "z") for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, columns with names used inside."""
    long = " ".join(f"word{i % 997}" for i in range(20000))
    rows = [(1, None, None, None, None, None), (None, "a b", "x", "y", 1, "z"), (2, "", "x", "y", 1, "z"),
            (3, long, "x", "y", 1, "z"), (3, long, "x", "y", 1, "z"), (4, "A b", "x", "y", 1, "z"),
            (5, "one two three four five six", "x", "y", 1, "z")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_odd_and_empty_tables(spark, odd, empty):
    field = skip_crf.fit([])
    toxic = toxic_crf.fit([], np.zeros(0), np.zeros(0))
    for docs, n in ((odd, 7), (empty, 0)):
        assert skip_crf.find_documents(docs, field).count() == n
        assert backoff.score_documents(docs).count() == n
        assert chosen_path.similarity_join(docs).count() == n
        assert toxic_crf.score_documents(docs, toxic).count() == n
        assert run_merge.exact_dedup(docs).count() == n
        assert suffix_sort.remove_repeats(docs).count() == n
        assert bpe_tree.digests(docs, RANKS, public_tokenizers.PATTERN).count() == n
        packed = grouping_ga.pack_documents(docs, WORD_FILE)
        assert (packed.select("doc_id").count() >= n) and (n or packed.count() == 0)


def test_exact_dedup(spark, odd):
    got = {(r.doc_id, r.text_sha256): r for r in run_merge.exact_dedup(odd).collect()}
    sha = hashlib.sha256(b"a b").hexdigest()
    assert got[(None, sha)].keep_id == 4 and not got[(None, sha)].kept
    assert got[(4, sha)].kept and got[(4, sha)].group_size == 2
    none = hashlib.sha256(b"").hexdigest()
    assert got[(1, none)].keep_id == 2 and got[(1, none)].group_size == 2


def luhn(digits):
    total = 0
    for i, x in enumerate(map(int, digits[::-1])):
        x *= 1 + i % 2
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    email = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ip = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    card = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    phone = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return [
        [m.span() for m in email],
        [m.span() for m in ip if all(int(x) < 256 for x in m[0].split("."))],
        [m.span() for m in card if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [m.span() for m in phone if 8 <= len(digits(m)) <= 15],
    ]


def test_copies_in_the_pipeline(spark, odd):
    import corpus_pipeline

    kept = corpus_pipeline.drop_copies(spark, odd, "")
    assert kept.columns == odd.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [
        (2, ""), (3, "word0"), (4, "A b"), (5, "one t"),
    ]


def test_base_spans():
    pick = random.Random(2).choice
    parts = ["a", "b.", "@", "1", "23", "4539578763621486", " ", "-", ".", "+1", "(", ")", "é", "x@y.z", "255", "0007", "\n"]
    for _ in range(4000):
        text = "".join(pick(parts) for _ in range(25))
        assert skip_crf.base_spans(text) == plain_spans(text), text


def test_personal_data_without_slow_scans():
    assert skip_crf.base_spans("a" * 200_000 + "1" * 200_000) == [[], [], [], []]
    assert skip_crf.redact("mail a@b.c now", skip_crf.base_spans("mail a@b.c now")) == "mail [EMAIL] now"


def test_skip_links_raise_agreement():
    field = skip_crf.fit(["call +1 (523) 555-1055 or x@y.com soon 7 days"] * 40)
    found = skip_crf.nodes(["call +1 (523) 555-1055 today, again 555-1055 please"])
    alone, linked = (skip_crf.Nodes(found.doc, found.start, found.end, found.gap, found.features, s)
                     for s in (np.full(len(found.doc), -1), found.skip))
    assert found.skip[-1] >= 0
    assert field.marginals(linked)[-1, 4] > field.marginals(alone)[-1, 4]


PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header>Top</header>"
    "<nav><ul><li><a>Home</a><li>About</ul></nav>%s<footer>f</footer></body>"
)


def test_main_text(spark):
    rows = [
        (1, "http://a.b/1", PAGE % "<article><h1>A &amp; b</h1><p>One <b>two</b>\n three<p>Four<aside>x</aside>"
         "<div class='comments'>bad</div></article>"),
        (2, "http://a.b/2", PAGE % "<div class='cookie-notice'>c</div><div id=content><p>Text<script>a<b</script></p></div>"),
        (3, None, None), (4, "odd", "no tags < 3"), (4, "odd", "<p>cut <foot"),
    ]
    got = template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = sorted((r.page_id, r.text, r.n_chars) for r in got)
    assert texts == [(1, "A & b\n\nOne two three\n\nFour", 26), (2, "Text", 4), (3, "", 0), (4, "cut", 3), (4, "no tags < 3", 11)]


def test_repeated_blocks_are_template(spark):
    rows = [(i, f"http://h.x/{i}", f"<body><main><p class=a>Always here</p><p class=b>Own {i}</p></main>") for i in range(5)]
    got = template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(r.text for r in got.collect()) == [f"Own {i}" for i in range(5)]


def test_copies_of_an_article_keep_their_text(spark):
    def copies(host, n, label="", change=False):
        own = [f"<p>Part {k} of the story on {host}</p>" for k in range(4)]
        for i in range(n):
            last = f"<p>Edited {i}</p>" if change else ""
            yield f"http://{host}/c{i}", (
                f"<body><div class=ad>ad {i}</div><main><p class=a>Always here</p><article {label}><h1>Title</h1>"
                f"<table><td>Cell</table>{''.join(own)}{last}</article></main>"
            )

    def others(host, n):
        for i in range(n):
            yield f"http://{host}/o{i}", f"<body><main><p class=a>Always here</p><article id=post-{i}><h1>T {i}</h1><p>Own {i}</article></main>"

    story = [f"Part {k} of the story on %s" for k in range(4)]
    rows = [
        *copies("ids", 4, "id=post-1234 class=post-1234"), *others("ids", 6),
        *copies("only", 3), *copies("edited", 5, change=True), *copies("most", 5, change=True), *others("most", 2),
    ]
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "page_id long, url string, html string")
    for r in template.main_text(docs).collect():
        host, own = r.url.split("/")[2:]
        if own[0] == "o":
            assert r.text == f"T {own[1:]}\n\nOwn {own[1:]}"
            continue
        last = [f"Edited {own[1:]}"] if host in ("edited", "most") else []
        assert r.text.split("\n\n") == ["Title", "Cell", *(x % host for x in story), *last]


def test_backoff(spark):
    docs = frame(spark, ["a b c", "a b d", "b c", None])
    got = {r.doc_id: (r.n_words, r.score) for r in backoff.score_documents(docs).collect()}
    one = np.log10
    first = one(2 / 8)
    assert got[0] == (3, round((first + one(2 / 2) + (one(0.4) + one(2 / 3))) / 3, 6))
    assert got[3] == (0, 0.0)


def brute_jaccard(texts):
    word = re.compile("[^\x00-/:-@\\[-`{-\x7f]+")
    sets = []
    for x in texts:
        w = word.findall((x or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    n = [0] * len(texts)
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 9 * both >= 4 * (len(sets[i]) + len(sets[j])):
                n[i] += 1
                n[j] += 1
    return n


def test_similarity_join_with_split_groups(spark, monkeypatch):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        own = list(base)
        own[59 - pick.randrange(2)] = f"x{pick.random()}"
        texts.append(" ".join(own))
    texts += [" ".join(f"y{pick.random()}" for _ in range(30)) for _ in range(20)] + [texts[0], "one two", None]
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    got = {r.doc_id: r for r in chosen_path.similarity_join(frame(spark, texts)).collect()}
    assert [got[i].n_links for i in range(len(texts))] == brute_jaccard(texts)
    assert {got[i].class_id for i in range(60)} == {0} and got[80].class_id == 0


def test_candidates_of_large_buckets(spark):
    docs = frame(spark, [" ".join(f"a{i}" for i in range(30)) + f" z{j}" for j in range(40)])
    from forecourt.llm import common

    signs = "doc_id long, a long, b long, size long, signs binary"
    classes = common.texts(docs).mapInArrow(chosen_path._sketch, signs).selectExpr("doc_id as id", "signs")
    links = chosen_path.candidate_links(common.store(classes, "t"), runs=3, small=4)
    assert components.components(links).select("component").distinct().count() == 1


def test_deep_buckets_get_further_rounds(spark, monkeypatch):
    """Every sample is as frequent as a common passage, so buckets are split four times or more."""
    n, monkey = 512, np.random.default_rng(9)
    monkeypatch.setattr(chosen_path, "FAR", 0.5)

    def signs(number):
        base = monkey.integers(0, 4, (n, chosen_path.SIGNS), dtype=np.uint32)
        other = base.copy()
        for own in other:
            own[monkey.permutation(chosen_path.SIGNS)[: 16 if number == 0 else 13]] += 4 + number
        both = np.stack([base, other], 1).reshape(2 * n, -1)
        rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(both)]
        return spark.createDataFrame(rows, "id long, signs binary")

    def pairs(links):
        found = {(min(r), max(r)) for r in map(tuple, links.collect())}
        return sum((2 * i, 2 * i + 1) in found for i in range(n))

    first = signs(0)
    once = pairs(chosen_path.candidate_links(first, small=4))
    rounds = []

    def fresh(ids, number):
        rounds.append(number)
        return signs(number).join(ids, "id")

    assert once < n == pairs(chosen_path.candidate_links(first, small=4, fresh=fresh))
    assert rounds == list(range(1, len(rounds) + 1)) and len(rounds) >= 2
    assert [chosen_path.rounds_for(x) for x in (1, 2, 4, 5)] == [1, 1, 2, 3]


def test_texts_that_share_a_doc_id(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join([*base[:59], "other"])
    clean = " ".join(f"y{i}" for i in range(40))
    rows = [(3, " ".join(base)), (5, clean), (5, near), (7, clean + " z"), (2, "short"), (2, near + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in chosen_path.similarity_join(docs).collect())
    assert got == [(2, 2, 0), (2, 2, 2), (3, 2, 2), (5, 2, 2), (5, 5, 1), (7, 5, 1)]
    import corpus_pipeline

    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(map(tuple, kept)) == [(2, "short"), (2, near + " more"), (5, clean)]


def test_toxic_words_are_learned():
    pick = random.Random(3)
    texts = [" ".join(f"w{pick.randrange(300)}" for _ in range(30)) + (" vilething" if i % 3 == 0 else "") for i in range(300)]
    toxic = np.array([float(i % 3 == 0) for i in range(300)])
    field = toxic_crf.fit(texts, toxic, np.ones(300))
    import pyarrow as pa

    scores, spans = toxic_crf._score(field, pa.array(["a vilething é vilething", "plain words", ""]), True)
    assert scores[0] > 0.5 > 0.3 > scores[1] and spans == ["2:11,14:23", "", ""]


def test_forward_backward_against_enumeration():
    table = np.sort(np.arange(1, 4, dtype=np.uint64))
    field = toxic_crf.Field(table, np.ones(3), -1.0, np.array([[1.2, 0.5], [0.4, 3.0]]), np.zeros(4))
    potential, gap = np.array([0.3, 1.0]), np.array([0, 2])
    got = toxic_crf._marginals(field, potential, gap, np.array([True, False]))
    weight = np.zeros((2, 2))
    plain = np.array([1.0, np.exp(-1.0)])
    t = field.transition
    for a in (0, 1):
        for x in (0, 1):
            for y in (0, 1):
                for b in (0, 1):
                    weight[a, b] += np.exp(a * 0.3 + b * 1.0) * t[a, x] * plain[x] * t[x, y] * plain[y] * t[y, b]
    weight /= weight.sum()
    assert np.allclose(got, [weight[1].sum(), weight[:, 1].sum()])


def test_near_vectors(spark):
    r = np.random.default_rng(3)
    rows = [(m + r.normal(size=8) * 0.1).tolist() for m in r.normal(size=(6, 8)) for _ in range(9)]
    rows += [rows[0], None, [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7, []]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {x.vec_id: (x.n_links, x.component_id) for x in ego_join.near_vectors(docs, block=8).collect()}
    unit = np.array([x / np.linalg.norm(x) for x in map(np.array, rows[:55])])
    near = unit @ unit.T >= 0.95
    assert [got[i][0] for i in range(55)] == (near.sum(1) - 1).tolist()
    assert all(got[i] == (0, i) for i in range(55, 60))


def brute_repeats(texts, length):
    data = [(x or "").encode() for x in texts]
    count = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(d), sum(gone), hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("small", [256, 5])
def test_remove_repeats(spark, small):
    pick = random.Random(4)

    def text(n):
        return "".join(pick.choice("abcdé ") for _ in range(n))

    shared = [text(60) for _ in range(3)]
    texts = ["", None, "a" * 90, "ab" * 50] + [
        text(pick.randint(0, 40)) + pick.choice(shared)[pick.randint(0, 15) : pick.randint(35, 60)] + text(20) for _ in range(60)
    ]
    got = {r.doc_id: r for r in suffix_sort.remove_repeats(frame(spark, texts), 20, 10, small).collect()}
    want = brute_repeats(texts, 20)
    assert [(got[i].n_bytes, got[i].n_removed, got[i].kept_sha256) for i in range(len(texts))] == want


def test_packing():
    pick = np.random.default_rng(1)
    lengths = sorted((int(x) for x in pick.integers(1, 2048, 300)), reverse=True)
    numbers, n = grouping_ga.evolve(lengths, [], 1)
    assert np.bincount(numbers, lengths).max() <= 2048
    plain, _ = grouping_ga.best_fit(lengths, range(300), [], [], 2048)
    assert n <= len(plain)
    again, m = grouping_ga.evolve(lengths, [numbers.tolist()], 2)
    assert m <= n and len(again) == 300


def test_pieces_are_whole(spark):
    docs = frame(spark, ["Hello, world! it's é", None, "a " * 5000])
    rows = grouping_ga.pack_documents(docs, WORD_FILE).collect()
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(WORD_FILE)
    for doc, text in ((0, "Hello, world! it's é"), (1, ""), (2, "a " * 5000)):
        total = sum(r.length for r in rows if r.doc_id == doc)
        assert total == len(tool.encode(text, add_special_tokens=False).ids) + 1
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_tree_encoding_and_decoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tree = bpe_tree.TreeCodec(RANKS, public_tokenizers.PATTERN, leaf=16)
    pick = random.Random(1)
    for _ in range(500):
        text = "".join(pick.choice(["a", "b", "'re", " ", "  ", "\n", "é", "1", "$", "the", "日本"]) for _ in range(200))
        ids = tree.encode(text.encode())
        assert ids == plain.encode_ordinary(text)
        assert tree.decode(ids) == text.encode()


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (9, 5), (20, 21), (21, 22), (22, 23), (7, 7), (8, None)]
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert dict(map(tuple, got)) == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 22: 20, 23: 20, 7: 7}
