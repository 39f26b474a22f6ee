"""The queries of this subpackage over the driver's tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import (
    backoff,
    bpe_tree,
    chosen_path,
    ego_join,
    filter_audit,
    grouping_ga,
    run_automaton,
    run_merge,
    skip_crf,
    suffix_sort,
    template,
    threshold_mix,
    toxic_crf,
)
from forecourt.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op6_run_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_merge.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op6_run_merge_dedup"] = """
with n as (
    select doc_id, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
), g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept,
    sha256(t) as text_sha256
from n join g using (t)
"""


@query
def op9_grouping_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping_ga.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query
def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op5_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_crf.toxic_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return skip_crf.find_documents(docs, skip_crf.train(docs))


@query
def op4_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similarity_join(table(spark, sf_dir, "documents"))


# Shingles as lists of words; the words are runs without ASCII space, marks or controls.
ORACLES["op4_chosen_path_join"] = r"""
with recursive w as (
    select doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-/:-@\[-`{-\x7f]+') if x <> ''] as ws
    from documents
), g as (
    select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
        else list_distinct([array_to_string(ws[i : i + 4], ' ') for i in range(1, len(ws) - 3)])
        end as gs
    from w
), s as materialized (select doc_id, len(gs) as n, unnest(gs) as g from g),
links as materialized (
    select a.doc_id as u, b.doc_id as v
    from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 9 * count(*) >= 4 * (a.n + b.n)
), reach as (
    select doc_id as u, doc_id as v from documents
    union
    select r.u, l.v from reach r join links l on l.u = r.v
)
select d.doc_id, min(r.v) as class_id,
    (select count(*) from links l where l.u = d.doc_id) as n_links
from documents d join reach r on r.u = d.doc_id
group by d.doc_id
"""


@query
def op8_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sort.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op7_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op7_epsilon_grid_join"] = """
with recursive e as (
    select vec_id, [x::double for x in embedding] as v from embeddings
), ok as (
    select vec_id, v from e
    where len(v) > 0 and len([x for x in v if x is null or not isfinite(x)]) = 0
        and len([x for x in v if x <> 0]) > 0
), links as materialized (
    select a.vec_id as u, b.vec_id as v
    from ok a join ok b on len(a.v) = len(b.v) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.95
), reach as (
    select vec_id as u, vec_id as v from embeddings
    union
    select r.u, l.v from reach r join links l on l.u = r.v
)
select e.vec_id, (select count(*) from links l where l.u = e.vec_id) as n_links,
    min(r.v) as component_id, e.vec_id = min(r.v) as kept
from e join reach r on r.u = e.vec_id
group by e.vec_id
"""


@query
def op2_template_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_text(table(spark, sf_dir, "pages"))


@query
def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_documents(table(spark, sf_dir, "documents"))


ORACLES["op3_stupid_backoff"] = r"""
with w as (
    select doc_id, unnest([x for x in regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-/:-@\[-`{-\x7f]+') if x <> '']) as w3,
        generate_subscripts([x for x in regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-/:-@\[-`{-\x7f]+') if x <> ''], 1) as i
    from documents
), t as materialized (
    select doc_id, i, w3, lag(w3) over p as w2, lag(w3, 2) over p as w1
    from w window p as (partition by doc_id order by i)
), c1 as (select w3 as a, count(*) as c from t group by 1),
c2 as (select w2 as a, w3 as b, count(*) as c from t where w2 is not null group by 1, 2),
c3 as (select w1 as a, w2 as b, w3 as d, count(*) as c from t where w1 is not null group by 1, 2, 3),
s as (
    select doc_id, case
        when c3.c >= 2 then log10(c3.c) - log10(x2.c)
        else (case when w1 is null then 0 else log10(0.4) end) + case
            when c2.c >= 2 then log10(c2.c) - log10(x1.c)
            else (case when w2 is null then 0 else log10(0.4) end)
                + log10(c1.c / (select count(*) from t)) end end as s
    from t left join c1 on c1.a = w3 left join c2 on c2.a = w2 and c2.b = w3
    left join c3 on c3.a = w1 and c3.b = w2 and c3.d = w3
    left join c1 as x1 on x1.a = w2 left join c2 as x2 on x2.a = w1 and x2.b = w2
)
select d.doc_id, count(s.s) as n_words, round(coalesce(avg(s.s), 0), 6) as score
from documents d left join s using (doc_id) group by d.doc_id
"""


@query
def op11_run_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_automaton.periodic_runs(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Every order against every mask, without ranks or intervals.
ORACLES["op12_filter_audit"] = r"""
with recursive t as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as ws
    from documents
), l as (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
    from labels group by doc_id
), m as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        case when len(ws) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
        || case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t)
            then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as mask
    from t left join l using (doc_id)
), c as materialized (
    select part, mask, count(*) as docs, sum(good) as good, sum(toxic) as toxic
    from m group by part, mask
), o as (
    select '' as o
    union all
    select o || x from o, (values ('A'), ('B'), ('C'), ('D'), ('E')) as v(x)
    where not contains(o, x)
), s as (
    select o as filter_order, step, o[step:step] as x, o[1 : step - 1] as earlier
    from o, range(1, 6) as r(step) where length(o) = 5
), a as (
    select part, filter_order, step::int as step, x,
        sum(case when translate(mask, earlier || x, '') = mask then docs else 0 end) as kept,
        sum(case when contains(mask, x) and translate(mask, earlier, '') = mask
            then docs else 0 end) as removed,
        sum(case when contains(mask, x) and translate(mask, earlier, '') <> mask
            then docs else 0 end) as redundant,
        sum(case when mask = x then docs else 0 end) as unique_fails,
        sum(case when contains(mask, x) and translate(mask, earlier, '') = mask
            then good else 0 end) as good_lost,
        sum(case when contains(mask, x) and translate(mask, earlier, '') = mask
            then toxic else 0 end) as toxic_lost
    from c, s group by part, filter_order, step, x
)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed,
    redundant::bigint as redundant, unique_fails::bigint as unique_fails,
    good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, x))::bigint as shapley
from a
"""


@query
def op13_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_mix.mix(table(spark, sf_dir, "documents"))


# Targets by sorting sources, documents one by one in order of their hash.
ORACLES["op13_threshold_mix"] = r"""
with recursive d as materialized (
    select doc_id, source, case when source is null then '1' else '0' || source end as k,
        len([x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''])
            as size,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ' ' || coalesce(text, '')), 1, 15))
            ::bigint as place
    from documents
), s as (
    select k, sum(size)::bigint as ss, (row_number() over (order by k) - 1) % 3 + 1 as w
    from d group by k
), p as (
    select *, sum(ss) over ()
        - 3 * coalesce(sum(ss) over (order by ss * 6 // w, k rows between unbounded preceding
            and 1 preceding), 0) as words,
        sum(w) over (order by ss * 6 // w, k rows between current row and unbounded following)
            as weight
    from s
), free as (
    select first(words order by ss * 6 // w, k) as words,
        first(weight order by ss * 6 // w, k) as weight
    from p where words * w <= 3 * ss * weight
), t as (
    select k, ss, case when free.words * w > 3 * ss * free.weight then (3 * ss)::double
        else least((free.words * w)::double / free.weight, (3 * ss)::double) end as target
    from s, free
), b as materialized (
    select *, floor(target - copies * ss + 0.5)::bigint as budget,
        floor(target / 500)::bigint as tol
    from (select *, case when ss > 0 then floor(target / ss) else 0 end::bigint as copies from t)
), g as materialized (
    select k, place, sum(size)::bigint as size,
        row_number() over (partition by k order by place) as i
    from d where size > 0 group by k, place
), f as (
    select k, 0::bigint as i, budget as r, 0 as skips, true as on_, false as take,
        false as skip, tol
    from b where budget > 0
    union all
    select f.k, g.i, f.r - case when fits or near then g.size else 0 end,
        f.skips + (not fits)::int, fits or (not near and f.r > tol and f.skips < 5),
        fits or near, not fits and not near and f.r > tol, tol
    from f join g on g.k = f.k and g.i = f.i + 1,
        lateral (select g.size <= f.r as fits,
            g.size > f.r and f.r > tol and g.size - f.r <= tol as near)
    where f.on_
), late as (
    select k, arg_min(g.place, (g.size, g.place)) as place
    from f join g using (k, i) join (select k, min(r) as left_ from f group by k) using (k)
    where f.skip group by k, left_, tol
    having left_ > tol and min(g.size) < 2 * left_
)
select d.doc_id, d.source, d.size, b.ss as source_size, b.target,
    d.size * (b.copies + (coalesce(f.take, false) or late.place is not null)::int) as taken
from d join b using (k)
left join g on g.k = d.k and g.place = d.place and d.size > 0
left join f on f.k = g.k and f.i = g.i
left join late on late.k = g.k and late.place = g.place
"""
