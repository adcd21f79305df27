"""The operators over the driver's tables, thin: each derives its result columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import bpe, conversation_trie, divergence, embed_dedup, fingerprints, html_extract, langid, line_dedup, ngram_join, packing, quality, token_records, topk
from sessionlake.llm.common import fold

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048, end_id=0)


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.digests(token_records.write_records(table(spark, sf_dir, "documents"), end_id=1))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold(F.col("doc_id")) != 0)
    return langid.predict(docs, model).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, fold(F.col("doc_id")) != 0)
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_pack, op2_top_k, op3_main_text, op4_jaccard, op5_records, op6_language, op7_lines, op8_near_vectors, op9_byte_bpe, op10_quality, op11_fingerprints, op12_conversation_trie, op13_divergence)
}

ORACLE_SQL: dict[str, str] = {
    "op2_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
                   where embedding is not null and len(embedding) > 0
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
             s as (select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
                   from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
             r as (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 5""",
    "op4_jaccard": """
        with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
             s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from w),
             n as (select doc_id, len(s)::bigint as n from s),
             t as (select doc_id, unnest(s) as t from s),
             c as (select a.doc_id as a, b.doc_id as b, count(*) as c from t a join t b on a.t = b.t and a.doc_id <> b.doc_id group by all),
             l as (select c.a, c.b from c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * c.c >= 90 * (x.n + y.n - c.c)),
             r(a, b) as (select doc_id, doc_id from n union select r.a, l.b from r join l on r.b = l.a)
        select n.doc_id, n.n as n_shingles, min(r.b) as component_id from n join r on r.a = n.doc_id group by all""",
    "op8_near_vectors": """
        with recursive v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null and len(embedding) > 0
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
             l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95),
             r(a, b) as (select vec_id, vec_id from v union select r.a, l.b from r join l on r.b = l.a),
             c as (select a, min(b) as c from r group by a),
             k as (select a, count(*) as k from l group by a)
        select vec_id, coalesce(k.k, 0)::bigint as n_links, coalesce(c.c, vec_id) as component_id, coalesce(c.c, vec_id) = vec_id as kept
        from embeddings left join c on c.a = vec_id left join k on k.a = vec_id""",
    "op12_conversation_trie": """
        with recursive given as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as k, coalesce(role, '') as role, coalesce(text, '') as text
                                 from conversations where conv_id is not null),
             ids as (select distinct conv_id, list_reduce(list_concat([4294967295], list_transform(range(1, length(conv_id::varchar) + 1), lambda i: ascii(substring(conv_id::varchar, i, 1))::bigint)),
                            lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))) as c from given),
             h as (select conv_id, xor(c, 4294967295) % 4 as h from ids),
             turns as (select h.conv_id, g.k, g.role, g.text from h join given g on g.conv_id = h.conv_id - h.conv_id % 20 and g.k <= h.h
                       union all select g.conv_id, g.k, g.role, g.text from h join given g on g.conv_id = h.conv_id and g.k > h.h),
             lists as (select h.conv_id, coalesce(list({'r': t.role, 't': t.text} order by t.k) filter (t.k is not null), []) as l from h left join turns t on t.conv_id = h.conv_id group by h.conv_id),
             paths as (select conv_id, l, unnest(range(0, len(l) + 1)) as d from lists),
             nodes as (select l[1:d] as path, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
                              coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(l) = d), '') as ends from paths group by l[1:d], d),
             kids as (select path[1:depth - 1] as path, count(*) as n from nodes where depth > 0 group by 1),
             full_nodes as (select n.*, coalesce(k.n, 0) as n_children,
                                   case when depth = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(n.path[depth].t, '[^\x20\x09-\x0D]+')) end as saved from nodes n left join kids k on k.path = n.path),
             up as (select path[1:a] as path, saved, n_children from (select path, saved, n_children, unnest(range(0, depth + 1)) as a from full_nodes)),
             sums as (select path, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves from up group by path)
        select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) as ends_sha256
        from full_nodes n join sums s on s.path = n.path left join nodes p on n.depth > 0 and p.path = n.path[1:n.depth - 1]""",
    "op13_divergence": """
        with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
             t as (select id, lang, source, unnest(w) as term from d),
             k as (select lang, term, count(*)::hugeint as n from t group by all having count(distinct id) >= 10),
             l as (select lang, count(*)::hugeint as v, sum(n)::hugeint as total from k group by lang),
             c as (select lang, source, term, count(*)::hugeint as n from t group by all),
             g as (select distinct lang, source from d),
             f as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
             s as (select lang, source, sum(n)::hugeint as total from f group by all),
             p as (select f.*, 1 + 1000000000 * (n + 2) // (s.total + 2 * l.v) as p, 1 + 1000000000 * (lang_n + 2) // (l.total + 2 * l.v) as q from f join s using (lang, source) join l using (lang)),
             x as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint as value
                   from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
             r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value
                   from g a join g b on a.lang = b.lang and a.source <> b.source left join x on x.lang = a.lang and x.source = a.source and x.item = b.source
                   union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q),
             o as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from r)
        select * from o where part = 'pair' or rank <= 10""",
}
