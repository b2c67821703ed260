"""One query per operator, over its whole table with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    lexical_search,
    licenses,
    line_dedup,
    near_dedup,
    personal_data,
    prefix_trie,
    quality,
    sentencepiece_bpe,
    substring_dedup,
    url_filter,
    vptree,
    warc,
)

MODEL = "piece_bpe_32k.model"
#: A document is good if its score is at least this.
GOOD = 0.3
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_bpe.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sentencepiece_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line with words: the line, the first line of its group, and whether it is kept."""
    return line_dedup.line_groups(_table(spark, sf_dir, "documents"), distance=None).select(
        "doc_id", F.col("line_no").cast("long"), "first_doc_id", F.col("first_line_no").cast("long"), "kept"
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: number of matching lines and blocks, licences found, and the greatest likeness."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.array_max("matches.dice").alias("dice"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    counts = [
        F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
        for kind in personal_data.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.spans_text(base), 256).alias("base_sha256"),
        personal_data.spans_text(F.col("spans")).alias("spans"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.sequences(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(rows))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_line_dedup,
        op3_license_scan,
        op4_warc,
        op5_quality,
        op6_url_filter,
        op7_substring_dedup,
        op8_vptree,
        op9_decontaminate,
        op10_near_dedup,
        op11_personal_data,
        op12_lexical_search,
        op13_prefix_trie,
    )
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))
_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_ASCII_UPPER}', '{_ASCII_UPPER.lower()}')"
_TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_BIGRAMS = (
    "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
)

ORACLES = {
    "op3_license_scan": f"""
        with t as (select *, {_BIGRAMS} as b from (
            select t, license, regexp_extract_all({_LOWERED}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w
            from (values {_TEMPLATE_ROWS}) as v(t, license, text))),
        blocks as (select doc_id, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) as text, false as line from documents),
        units as (
            select doc_id, unnest(string_split(text, chr(10))) as text from documents
            union all select doc_id, text from blocks where contains(text, chr(10))),
        u as (select row_number() over () as u, doc_id, {_BIGRAMS} as b from (
            select doc_id, regexp_extract_all({_LOWERED}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from units)),
        pairs as (
            select u.u, u.doc_id, t.t, t.license, len(u.b) as n, len(t.b) as m, count(*) as c
            from (select u, doc_id, b, unnest(b) as x from u) u join (select t, license, b, unnest(b) as x from t) t using (x)
            group by all),
        best as (
            select u, doc_id, license, 2 * c / (n + m) as dice from pairs where 200 * c >= {licenses.PERCENT} * (n + m)
            qualify row_number() over (partition by u order by 2 * c / (n + m) desc, license) = 1)
        select d.doc_id, count(u) as n_matches,
               coalesce(string_agg(distinct license, ',' order by license), '') as licenses, max(dice) as dice
        from documents d left join best using (doc_id) group by d.doc_id""",
    "op4_warc": """
        with p as (
            select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as h, max(page_id) over
                (partition by sha1(coalesce(html, ''))) as first from pages),
        bits as (
            select *, list_reduce(list_transform(string_split(h, ''),
                lambda c: printf('%04d', bin(instr('0123456789abcdef', c) - 1)::int)), lambda a, b: a || b) as b from p)
        select page_id, n as payload_bytes,
               list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
                   + list_reduce(list_transform(string_split(substr(b, 5 * i + 1, 5), ''), lambda c: c::int),
                                 lambda x, y: 2 * x + y), 1)), lambda a, c: a || c) as payload_digest,
               case when page_id = first then 'response' else 'revisit' end as record_type,
               case when page_id <> first then first end as refers_to
        from bits""",
    "op6_url_filter": f"""
        with parts as (
            select page_id, contains(coalesce(url, ''), '://') as has,
                   substr(url, instr(url, '://') + 3) as rest from pages),
        p as (
            select page_id,
                   case when has then translate(regexp_extract(rest, '^[^/?#]*'), '{_ASCII_UPPER}', '{_ASCII_UPPER.lower()}')
                        else '' end as host,
                   case when has then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path from parts),
        rules(verdict, h, q) as (values
            {", ".join(f"('{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in URL_RULES)}),
        fits as (
            select page_id, host, path, r.verdict, h || q as rule, len(string_split(h, '.')) as labels, length(q) as n
            from p left join rules r on (host = h or suffix(host, '.' || h)) and starts_with(path, q))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits
        qualify row_number() over (partition by page_id order by labels desc, n desc) = 1""",
    "op7_substring_dedup": r"""
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        win as (
            select doc_id, i, list_slice(w, i, i + 49) as k
            from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w where len(w) >= 50)),
        least as (select k, min(doc_id) as first from win group by k),
        gone as (
            select distinct doc_id, i + j as pos from win join least using (k), range(0, 50) r(j) where doc_id > first),
        kept as (
            select doc_id, string_agg(x, ' ' order by pos) as t, count(*) as n from (
                select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as pos from w) s
            anti join gone using (doc_id, pos) group by doc_id)
        select w.doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
        from w left join kept using (doc_id)""",
    "op8_vptree": """
        with v as (
            select vec_id, embedding::double[] as e from embeddings
            where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s as (
            select q.vec_id as query_id, v.vec_id, list_inner_product(q.e, v.e) as score
            from v q join v on q.vec_id <> v.vec_id and len(q.e) = len(v.e) where q.vec_id % 20 = 0)
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
               vec_id, score
        from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20""",
    "op9_decontaminate": f"""
        with d as (select doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
        b as (select item_id::varchar as item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
              from benchmark),
        bw as (
            select distinct item_id, list_slice(w, i, i + 9) as k
            from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
        sizes as (select distinct len(k) as n from bw),
        dw as (
            select doc_id, n, i, list_slice(w, i, i + n - 1) as k
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
        hits as (select doc_id, i, n, item_id from dw join bw using (k)),
        words as (
            select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from hits) group by 1),
        items as (
            select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids
            from hits group by 1)
        select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join words using (doc_id) left join items using (doc_id)""",
    "op10_near_dedup": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') as w from documents),
        s as (
            select distinct doc_id, list_slice(w, i, i + 3) as k
            from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from w where len(w) > 0)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        pairs as (
            select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id
            group by 1, 2),
        links as (
            select x, y from pairs join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
        reach as (
            select doc_id as x, doc_id as root from w
            union select l.y, r.root from reach r join links l on l.x = r.x),
        part as (select x as doc_id, min(root) as component_id from reach group by x)
        select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
        from w left join n using (doc_id) join part using (doc_id)""",
    # spans are marked by two private characters, which the text itself then may not hold
    "op11_personal_data": r"""
        with d as (
            select doc_id, translate(coalesce(text, ''), chr(57344) || chr(57345), chr(63743) || chr(63743)) as t from documents),
        marked as (
            select doc_id, 0 as k, regexp_replace(t, '([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)', chr(57344) || '\1' || chr(57345), 'g') as s from d
            union all
            select doc_id, 1, regexp_replace(t, '([0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+))', chr(57344) || '\1' || chr(57345), 'g') from d
            union all
            select doc_id, 2, regexp_replace(t, '([0-9](?:[\x20-]?[0-9])+)', chr(57344) || '\1' || chr(57345), 'g') from d
            union all
            select doc_id, 3, regexp_replace(t, '(\+[0-9][\x20().0-9-]+[0-9])', chr(57344) || '\1' || chr(57345), 'g') from d),
        parts as (
            select doc_id, k, unnest(string_split(s, chr(57344))) as x, generate_subscripts(string_split(s, chr(57344)), 1) as i
            from marked),
        found as (
            select doc_id, k, i, split_part(x, chr(57345), 1) as m, coalesce(sum(length(x) - (i > 1)::int) over
                (partition by doc_id, k order by i rows between unbounded preceding and 1 preceding), 0)::bigint as a from parts),
        digits as (
            select *, regexp_replace(m, '[^0-9]', '', 'g') as g, reverse(regexp_replace(m, '[^0-9]', '', 'g')) as z
            from found where i > 1),
        good as (
            select doc_id, k, a, a + length(m) as b from digits where case k
                when 0 then true
                when 1 then len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3
                    or right('000' || x, 3)::int > 255)) = 0
                when 2 then length(g) between 12 and 19 and list_sum(list_transform(range(1, length(z) + 1), lambda j:
                    case when j % 2 = 1 then z[j]::int else 2 * z[j]::int // 10 + 2 * z[j]::int % 10 end)) % 10 = 0
                else length(g) between 9 and 15 end),
        s as (
            select doc_id, count(*) filter (k = 0) as n_email, count(*) filter (k = 1) as n_ip, count(*) filter (k = 2) as n_card,
                   count(*) filter (k = 3) as n_phone,
                   string_agg(['email', 'ip', 'card', 'phone'][k + 1] || ':' || a || ':' || b, ',' order by a, k) as spans
            from good group by doc_id)
        select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
               coalesce(n_phone, 0) as n_phone, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
        from d left join s using (doc_id)""",
    "op12_lexical_search": f"""
        with d as (select doc_id, regexp_extract_all({_LOWERED}, '{_TERMS}') as w from documents),
        n as (select doc_id, len(w) as n from d where len(w) > 0),
        every as (select count(*)::bigint as nd, sum(n)::bigint as lt from n),
        b as (
            select distinct item_id, term
            from (select item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERMS}')) as term from benchmark)),
        tf as (
            select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from d) x
            where term in (select term from b) group by all),
        w as (
            select term, floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::bigint as w
            from (select term, count(*) as df from tf group by term), every),
        s as (
            select item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nd) // lt)))))::bigint as score
            from b join tf using (term) join w using (term) join n using (doc_id), every group by all)
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
        from s where score > 0 qualify rank <= 10""",
    "op13_prefix_trie": r"""
        with t as (
            select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos,
                   {'r': coalesce(role, ''), 't': coalesce(text, '')} as x
            from conversations where conv_id is not null),
        c as (
            select conv_id, xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint),
                lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
                    lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(a, b)),
                4294967295::bigint), 4294967295) % 4 as h
            from (select distinct conv_id from t)),
        r as (
            select c.conv_id, 0 as own, pos, x from c join t on t.conv_id = c.conv_id - c.conv_id % 20 and pos <= h
            union all select conv_id, 1, pos, x from c join t using (conv_id) where pos > h),
        s as (
            select c.conv_id, coalesce(list(x order by own, pos) filter (x is not null), []) as q
            from c left join r using (conv_id) group by c.conv_id),
        p as (select conv_id, len(q) as n, d, list_slice(q, 1, d) as k from (select *, unnest(range(0, len(q) + 1)) as d from s)),
        nodes as (
            select k, d, min(conv_id) as conv_id, count(*) as n_convs,
                   string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d) as ends from p group by k, d),
        kids as (select list_slice(k, 1, d - 1) as k, count(*) as n_children from nodes where d > 0 group by 1),
        f as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (k)),
        sub as (
            select list_slice(k, 1, a) as k, sum((n_children = 0)::int)::bigint as n_leaves,
                   sum((n_convs - 1) * case when d = 0 then 0
                       else len(regexp_extract_all(k[d].t, '[^\x20\x09-\x0D]+')) end)::bigint as saved_tokens
            from (select *, unnest(range(0, d + 1)) as a from f) group by 1)
        select f.conv_id, f.d as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
               sha256(coalesce(f.ends, '')) as ends_sha256
        from f join sub using (k) left join nodes u on f.d > 0 and u.k = list_slice(f.k, 1, f.d - 1)""",
}
