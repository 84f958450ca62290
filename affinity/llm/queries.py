"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import (
    clusters,
    contamination,
    embeddings,
    exact,
    jaccard,
    langid,
    lines,
    packing,
    pii,
    search,
    substrings,
    tokenfiles,
    urls,
)
from affinity.llm.common import table, workspace
from affinity.llm.tokens import byte_bpe_path


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = contamination.contamination(docs, items)
    digest = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe_path())


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark).path("tokens")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), folder, byte_bpe_path())
    return tokenfiles.read_digests(spark, folder)


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.number("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.written("base"), 256).alias("base_sha256"),
        pii.written("spans").alias("spans"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_decontamination,
        op3_best_fit_packing,
        op4_jaccard_join,
        op5_line_dedup,
        op6_url_filters,
        op7_substring_dedup,
        op8_token_files,
        op9_embedding_near_dedup,
        op10_pii,
        op11_ranked_search,
        op12_exact_dedup,
        op13_centroid_clustering,
    )
}

BLANK = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_RANKED = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _clustering(k: int, rounds: int, width: int, scale: int, seed: int) -> str:
    """The clustering, unrolled: a table of centroids and one of assignments per round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        d{i} as materialized (
            select id, c, sum((x.v - m.v) * (x.v - m.v))::bigint as d
            from x join c{i} m using (i) group by id, c
        ), a{i} as materialized (
            select id, c, d from d{i} qualify row_number() over (partition by id order by d, c) = 1
        )""")
        if i < rounds:
            steps.append(f"""
        s{i} as (select c, i, sum(v)::bigint as s, count(*) as n from x join a{i} using (id) group by c, i),
        c{i + 1} as materialized (
            select m.c, m.i, coalesce((s - ((s % n) + n) % n) // n, m.v) as v from c{i} m left join s{i} using (c, i)
        )""")
    return f"""
        with q as materialized (
            select vec_id, row_number() over (order by vec_id) as id,
                list_transform(embedding, lambda e: floor({scale} * e::double)::bigint) as e
            from embeddings where len(embedding) = {width}
                and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
        ), x as materialized (
            select id, unnest(e) as v, generate_subscripts(e, 1) as i from q
        ), starts as (
            select id, row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as c from q
            order by c limit {k}
        ), c0 as materialized (select c, i, v from starts join x using (id)), {",".join(steps)},
        digests as (
            select c, sha256(string_agg(v::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by c
        )
        select vec_id, c::integer as cluster, d as distance,
            (sum(d) over (partition by c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
            centroid_sha256
        from a{rounds} join digests using (c) join q using (id)
    """


ORACLES: dict[str, str] = {
    "op2_decontamination": f"""
        with words as (
            select doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} as w from documents
        ), item_words as (
            select item_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} as w from benchmark
        ), items as (
            select *, least(len(w), 13) as width from item_words where len(w) > 0
        ), windows as (
            select item_id, width, array_to_string(w[i:i + width - 1], ' ') as s
            from (select *, unnest(range(1, len(w) - width + 2)) as i from items)
        ), widths as (
            select distinct width from items
        ), places as (
            select doc_id, width, unnest(range(1, len(w) - width + 2)) as start, w
            from words join widths on len(w) >= width
        ), hits as (
            select doc_id, start, p.width, item_id from (
                select doc_id, start, width, array_to_string(w[start:start + width - 1], ' ') as s
                from places) p
            join windows using (s)
        ), covered as (
            select doc_id, count(distinct nr) as n_hit from (
                select doc_id, unnest(range(start, start + width)) as nr from hits) group by doc_id
        ), found as (
            select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
            from (select distinct doc_id, item_id::varchar as i from hits) group by doc_id
        )
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit,
            coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
            coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
        from words left join covered using (doc_id) left join found using (doc_id)
    """,
    "op4_jaccard_join": f"""
        with recursive words as (
            select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents
        ), shingles as (
            select distinct doc_id, unnest(case
                when len(w) = 0 then []
                when len(w) < 5 then [array_to_string(w, ' ')]
                else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
            end) as s from words
        ), sizes as (
            select doc_id, count(*) as n from shingles group by doc_id
        ), links as (
            select x.doc_id as a, y.doc_id as b from shingles x join shingles y using (s)
            join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
            where x.doc_id <> y.doc_id group by x.doc_id, y.doc_id, p.n, q.n
            having 100 * count(*) >= 80 * (p.n + q.n - count(*))
        ), reached(doc_id, other) as (
            select doc_id, doc_id from documents
            union
            select r.doc_id, l.b from reached r join links l on l.a = r.other
        )
        select doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
        from reached left join sizes using (doc_id) group by doc_id
    """,
    "op7_substring_dedup": f"""
        with words as (
            select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents
        ), windows as (
            select doc_id, unnest(range(1, len(w) - 18)) as start, w from words where len(w) >= 20
        ), placed as (
            select doc_id, start, array_to_string(w[start:start + 19], ' ') as s from windows
        ), later as (
            select doc_id, start, row_number() over (partition by s order by doc_id, start) as place
            from placed
        ), covered as (
            select distinct doc_id, unnest(range(start, start + 20)) as nr from later where place > 1
        ), each as (
            select doc_id, unnest(w) as word, generate_subscripts(w, 1) as nr from words
        ), kept as (
            select doc_id, count(*) as kept, string_agg(word, ' ' order by nr) as body
            from each anti join covered using (doc_id, nr) group by doc_id
        )
        select doc_id, len(w) as n_words, len(w) - coalesce(kept, 0) as n_removed,
            sha256(coalesce(body, '')) as kept_sha256
        from words left join kept using (doc_id)
    """,
    "op5_line_dedup": rf"""
        with split as (
            select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
        ), lines as (
            select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as nr from split
        ), keyed as (
            select *, {_LOWER.format(rf"regexp_replace(regexp_replace(line, '^{BLANK}+', ''), '{BLANK}+$', '')")}
                as line_key from lines
        ), repeated as (
            select line_key, max(doc_id) as keeper from keyed where length(line_key) >= 20
            group by line_key having count(distinct doc_id) >= 3
        ), marked as (
            select doc_id, nr, line, coalesce(doc_id < keeper, false) as dropped
            from keyed left join repeated using (line_key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by nr) filter (not dropped), ''))
                as kept_sha256
        from marked group by doc_id
    """,
    "op6_url_filters": f"""
        with parts as (
            select page_id, case when contains(url, '://')
                then substr(url, instr(url, '://') + 3) else '' end as rest from pages
        ), urls as (
            select page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts
        ), rules(rule_host, rule_path, rule_verdict) as (
            values {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)}
        ), fits as (
            select page_id, rule_host || rule_path as rule, rule_verdict, row_number() over (
                partition by page_id order by length(rule_host || rule_path) desc,
                length(rule_host) desc, rule_verdict desc) as place
            from urls join rules on starts_with(path, rule_path)
                and (host = rule_host or ends_with(host, '.' || rule_host))
        )
        select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
        from urls left join (select * from fits where place = 1) using (page_id)
    """,
    # Brute force: equal where the index misses no link, as on the tables it was measured on.
    "op9_embedding_near_dedup": """
        with recursive vectors as (
            select vec_id, embedding::double[] as e from embeddings
            where vec_id is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links as (
            select x.vec_id as a, y.vec_id as b from vectors x join vectors y
            on x.vec_id <> y.vec_id and len(x.e) = len(y.e)
            where list_cosine_similarity(x.e, y.e) >= 0.9
        ), reached(vec_id, other) as (
            select vec_id, vec_id from embeddings
            union
            select r.vec_id, l.b from reached r join links l on l.a = r.other
        ), components as (
            select vec_id, min(other) as component_id from reached group by vec_id
        ), counts as (
            select a as vec_id, count(distinct b) as n_links from links group by a
        )
        select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
        from components left join counts using (vec_id)
    """,
    "op11_ranked_search": f"""
        with words as (
            select doc_id, unnest({_RANKED.format(_LOWER.format("coalesce(text, '')"))}) as term from documents
        ), lengths as (
            select doc_id, count(*) as n from words group by doc_id
        ), totals as (
            select count(*)::bigint as docs, sum(n)::bigint as length from lengths
        ), tfs as (
            select doc_id, term, count(*) as tf from words group by doc_id, term
        ), weights as (
            select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from tfs, totals group by term, docs
        ), asked as (
            select item_id, unnest({_RANKED.format(_LOWER.format("coalesce(text, '')"))}) as term from benchmark
        ), items as (
            select item_id, term, count(*) as times from asked group by item_id, term
        ), scores as (
            select item_id, doc_id, sum(times * w * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length))))::bigint as score
            from items join weights using (term) join tfs using (term) join lengths using (doc_id), totals
            group by item_id, doc_id
        )
        select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank,
            doc_id, score
        from scores where score > 0
        qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10
    """,
    "op12_exact_dedup": rf"""
        with bodies as (
            select doc_id, length(coalesce(text, '')) as size,
                regexp_replace(coalesce(text, ''), '{BLANK}+', '', 'g') as body from documents
        )
        select doc_id, first_value(doc_id) over kept as keep_id, count(*) over (partition by body) as group_size,
            row_number() over kept = 1 as kept, sha256(body) as text_sha256
        from bodies window kept as (partition by body order by size desc, doc_id)
    """,
    "op13_centroid_clustering": _clustering(
        clusters.CENTROIDS, clusters.ROUNDS, clusters.WIDTH, clusters.SCALE, clusters.SEED
    ),
}
