"""The operators of this subpackage as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchtrail.llm import (
    bpe,
    chat,
    decontaminate,
    hard_negatives,
    language,
    main_text,
    minhash,
    near_vectors,
    passages,
    prefix_trie,
    quality,
    secrets,
    url_filter,
)
from touchtrail.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = "byte_bpe_50k.tiktoken"


# The rules that the urls are judged by.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)
# Fixed value: what both turns of the added conversation say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path(BPE_RANKS),
        public_tokenizers.PATTERN,
        with_ids=False,
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_digests(read_table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings."""
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    added = spark.createDataFrame(rows, given.schema)
    return chat.conversation_digests(chat.format_conversations(given.unionByName(added)))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read_table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(read_table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(read_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_near_vectors,
        op2_byte_bpe,
        op3_url_filter,
        op4_suffix_dedup,
        op5_chat,
        op6_minhash,
        op7_decontaminate,
        op8_quality,
        op9_main_text,
        op10_language,
        op11_secret_scan,
        op12_hard_negatives,
        op13_prefix_trie,
        pipeline,
    )
}

# Groups that links (a, b) in both directions make, as (node, component_id).
_COMPONENTS = """reached as (
            select {key} as node, {key} as root from {nodes}
            union
            select l.b, r.root from reached r join links l on l.a = r.node
        ), components as (
            select node, min(root) as component_id from reached group by node
        )"""

# Steps of a walk whose last one still moves less than url_filter.TOLERANCE pages on any given table.
_WALK_STEPS = 200
_RULE_ROWS = ", ".join(f"('{rule.verdict}', '{rule.host}', '{rule.path}')" for rule in URL_RULES)

LLM_ORACLE: dict[str, str] = {
    "op1_near_vectors": f"""
        with recursive vectors as (
            select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v
            from embeddings where embedding is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links as (
            select a.vec_id as a, b.vec_id as b from vectors a join vectors b
            on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
                and list_inner_product(a.v, b.v) >= 0.95
                    * sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))
        ), {_COMPONENTS.format(key="vec_id", nodes="embeddings")}
        select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id,
            vec_id = component_id as kept
        from embeddings join components on node = vec_id
    """,
    # A walk that returns to its seeds where no link leaves is the one that ends there, scaled to 1.
    "op3_url_filter": f"""
        with recursive rules(verdict, host, path) as (values {_RULE_ROWS}), urls as (
            select page_id, html, case when strpos(url, '://') > 0
                then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
        ), parsed as (
            select page_id, html, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz') as host from urls
        ), matches as (
            select p.host, p.path, arg_max(r.host || r.path, len(r.host || r.path)) as rule,
                arg_max(r.verdict, len(r.host || r.path)) as verdict
            from (select distinct host, path from parsed) p join rules r
            on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
            group by 1, 2
        ), matched as (
            select page_id, p.host, p.path, rule, verdict from parsed p
            left join matches m on m.host = p.host and m.path = p.path
        ), hosts as (
            select host, count(*) as pages, count(*) filter (verdict = 'allow') as allowed,
                count(*) filter (verdict = 'block') as blocked
            from matched where host <> '' group by 1
        ), links as (
            select src, dst, count(*) as weight from (
                select host as src, unnest(list_distinct(list_transform(regexp_extract_all(html,
                    '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.\\-]*:)?//([^/?#"''\\s>]+)', 1),
                    lambda h: translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz')))) as dst from parsed
            ) where src <> '' and src <> dst group by 1, 2
        ), steps as (
            select kind, src, dst, weight / sum(weight) over (partition by kind, src) as share from (
                select 'allow' as kind, src, dst, weight from links
                union all select 'block', dst, src, weight from links)
        ), seeds as (
            select kind, host, n / sum(n) over (partition by kind) as mass from (
                select 'allow' as kind, host, allowed as n from hosts
                union all select 'block', host, blocked from hosts) where n > 0
        ), walk as (
            select 0 as k, kind, host, mass from seeds
            union all
            select k + 1, w.kind, dst, cast(0.85 as double) * sum(mass * share)
            from walk w join steps s on s.kind = w.kind and s.src = w.host
            where k < {_WALK_STEPS} group by k, w.kind, dst
        ), masses as (
            select kind, host, sum(mass) / sum(sum(mass)) over (partition by kind) as mass
            from walk group by 1, 2
        ), per_page as (
            select h.host, coalesce(a.mass, 0) * sum(allowed) over () / pages as trust, greatest(
                blocked / pages, coalesce(b.mass, 0) * sum(blocked) over () / pages) as distrust
            from hosts h left join masses a on a.kind = 'allow' and a.host = h.host
            left join masses b on b.kind = 'block' and b.host = h.host
        )
        select page_id, m.host, path, rule, coalesce(verdict,
            case when distrust >= 0.5 and distrust > trust then 'block' else 'allow' end) as verdict
        from matched m left join per_page p on p.host = m.host
    """,
    "op4_suffix_dedup": """
        with texts as (
            select doc_id, hex(coalesce(text, '')) as h from documents
        ), blocks as (
            select doc_id, b, substr(h, 1024 * b + 1, 1222) as part
            from (select doc_id, h, unnest(range(0, len(h) // 1024 + 1)) as b from texts)
        ), starts as (
            select doc_id, part, b, unnest(range(0, least(512, len(part) // 2 - 99))) as i from blocks
        ), later as (
            select doc_id, p from (
                select doc_id, 512 * b + i as p, row_number() over (
                    partition by md5(substr(part, 2 * i + 1, 200)) order by doc_id, 512 * b + i
                ) as place from starts
            ) where place > 1
        ), marked as (
            select *, p > coalesce(lag(p) over (partition by doc_id order by p) + 100, -1) as opens
            from later
        ), runs as (
            select doc_id, min(p) as lo, max(p) + 100 as hi from (
                select *, sum(cast(opens as int)) over (partition by doc_id order by p) as run
                from marked
            ) group by doc_id, run
        ), gaps as (
            select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as before
            from runs
        ), cut as (
            select g.doc_id, cast(sum(hi - lo) as bigint) as n_removed, count(*) as n_spans,
                string_agg(substr(any_h, 2 * before + 1, 2 * (lo - before)), '' order by lo)
                    || substr(any_value(any_h), 2 * max(hi) + 1) as kept
            from gaps g join (select doc_id, h as any_h from texts) t on t.doc_id = g.doc_id
            group by g.doc_id
        )
        select t.doc_id, cast(len(h) // 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed,
            coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
        from texts t left join cut c on c.doc_id = t.doc_id
    """,
    "op6_minhash": f"""
        with recursive words as (
            select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents
        ), sets as (
            select doc_id, case
                when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3),
                    lambda i: array_to_string(w[i:i + 4], ' ')))
                when len(w) > 0 then [array_to_string(w, ' ')] else [] end as shingles from words
        ), each as (
            select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets
        ), links as (
            select x.doc_id as a, y.doc_id as b from each x join each y
            on x.shingle = y.shingle and x.doc_id <> y.doc_id
            group by x.doc_id, y.doc_id, x.n, y.n
            having 100 * count(*) >= 75 * (x.n + y.n - count(*))
        ), {_COMPONENTS.format(key="doc_id", nodes="documents")}
        select doc_id, cast(len(shingles) as bigint) as n_shingles, component_id,
            doc_id = component_id as kept
        from sets join components on node = doc_id
    """,
    "op5_chat": """
        with every as (
            select conv_id, turn, role, text from conversations
            union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
                case when role = 'assistant' then coalesce(text, '') else '' end as loss,
                lag(role) over (partition by conv_id order by turn, role, text) as before
            from every
        ), sized as (
            select *, length(replace(replace(replace(replace(
                    role || chr(10) || text, '&', '&amp;'), '<', '&lt;'), '|', '&#124;'),
                    '[', '&#91;')) - 1 + length('<||><|end|>') as formatted,
                coalesce(before, 'start') || '>' || role in ('start>system', 'start>user',
                    'system>user', 'user>assistant', 'assistant>user') as follows
            from turns
        ), whole as (
            select conv_id, count(*) as n_turns,
                string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
                string_agg(loss, '' order by turn, role, text) as loss,
                sum(formatted) + length('<s></s>') as formatted_chars,
                bool_and(follows) and bool_or(role in ('user', 'assistant')) as valid
            from sized group by conv_id
        )
        select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars,
            sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars, valid
        from whole
    """,
    "op12_hard_negatives": """
        with rows as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * cast(x as double))) as scaled
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scores as (
            select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
                cast(list_inner_product(a.scaled, b.scaled) as bigint) as score
            from rows a join rows b on a.vec_id % 100 = 0 and len(a.scaled) = len(b.scaled)
        ), positives as (
            select * from scores where same and other <> anchor_id
            qualify row_number() over (
                partition by anchor_id order by score desc, other) <= 5
        )
        select p.anchor_id, p.other as positive_id, cast(row_number() over best as integer) as rank,
            n.other as negative_id, p.score as positive_score, n.score as negative_score
        from positives p join scores n on n.anchor_id = p.anchor_id and not n.same
            and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
        window best as (partition by p.anchor_id, p.other order by n.score desc, n.other)
        qualify row_number() over best <= 10
    """,
    "op13_prefix_trie": """
        with ids as (
            select distinct conv_id as c from conversations where conv_id is not null
        ), steps as (
            select c, list_concat([4294967295], flatten(list_transform(string_split(cast(c as varchar), ''),
                lambda ch: [cast(ascii(ch) as bigint), 0, 0, 0, 0, 0, 0, 0]))) as bits from ids
        ), hashed as (
            select c, xor(list_reduce(bits, lambda a, x:
                xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295) % 9 as h from steps
        ), turns as (
            select *, row_number() over (partition by conv_id order by turn nulls first, id) as place from (
                select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                    || coalesce(text, '')) as id, strlen(coalesce(text, '')) as bytes
                from conversations where conv_id is not null)
        ), rebuilt as (
            select c, id, bytes, row_number() over (partition by c order by own, place) as d from (
                select c, id, bytes, place, 0 as own from hashed join turns on conv_id = c - c % 5
                    where place <= h
                union all
                select c, id, bytes, place, 1 from hashed join turns on conv_id = c where place > h)
        ), prefixes as (
            select c, d, bytes, string_agg(id, '/') over (partition by c order by d) as path from rebuilt
            union all select c, 0, 0, '' from ids
        ), lasts as (
            select *, d = max(d) over (partition by c) as ends,
                lag(path) over (partition by c order by d) as above from prefixes
        ), nodes as (
            select d, path, any_value(above) as above, min(c) as conv_id, count(*) as n, any_value(bytes) as b,
                sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where ends), ''))
                    as ends_sha256
            from lasts group by d, path
        ), kids as (
            select above as path, count(*) as n_children from nodes where d > 0 group by 1
        ), sums as (
            select p.path, p.d, sum((n.n - 1) * n.b) as saved, count(*) filter (where k.path is null) as leaves
            from nodes n join prefixes p on p.c = n.conv_id and p.d <= n.d left join kids k on k.path = n.path
            group by 1, 2
        )
        select n.conv_id, n.d as depth, u.conv_id as parent_conv_id, n.n as n_convs,
            coalesce(k.n_children, 0) as n_children, s.leaves as n_leaves,
            cast(s.saved as bigint) as saved_tokens, n.ends_sha256
        from nodes n join sums s on s.path = n.path and s.d = n.d
        left join nodes u on u.path = n.above and u.d = n.d - 1 left join kids k on k.path = n.path
    """,
}
