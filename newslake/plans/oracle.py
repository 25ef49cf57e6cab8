"""The queries again, as SQL for the checking engine.

Written on their own, from the meaning of each operator; bigint results are
cast where Spark gives int.
"""

from __future__ import annotations

from newslake.fixtures import ARTICLES_SQL
from newslake.functions.text import (
    CONTEXT_BLOCK,
    NO_ARTICLES,
    PROMPT_HEAD,
    PROMPT_QUESTION,
    PROMPT_TAIL,
)
from newslake.plans.queries import QUESTIONS

_ARTICLES = ARTICLES_SQL.format(documents="documents", events="events")


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _cleaned(where: str, order: str) -> str:
    return f"""
select ingest_seq, trim(title) as title, description, content, url,
       case when source is null then 'Unknown' else trim(source) end as source,
       try_cast(published_at as timestamp) as published_at,
       case when author is null then 'Unknown' else trim(author) end as author,
       lang, cast(length(content) as int) as content_length,
       content is not null as has_content
from articles
where title is not null and url is not null and {where}
qualify row_number() over (partition by url order by {order}) = 1
"""


# English articles arrive before the others in the queries with two loads.
_TWO_LOADS = "case when lang = 'en' then 0 else 1 end, ingest_seq"

def _staged(silver: str) -> str:
    return f"""
select title, description, url, source, author, published_at, content_length, has_content,
       cast(published_at as date) as published_date,
       cast(extract(year from published_at) as int) as published_year,
       cast(extract(month from published_at) as int) as published_month
from {silver}"""


_WITH = f"""with articles as ({_ARTICLES}),
silver as ({_cleaned("true", "ingest_seq")}),
english as ({_cleaned("lang = 'en'", "ingest_seq")}),
in_loads as ({_cleaned("true", _TWO_LOADS)}),
staged as ({_staged("silver")}),
staged_in_loads as ({_staged("in_loads")}),
messages as (
  select ingest_seq, ingest_seq % 19 = 0 as bad,
         title, description, content, url, source, published_at, author from articles)
"""


def _by_source(silver: str) -> str:
    return f"""
select source, count(*) as total_articles, round(avg(content_length), 2) as avg_content_length,
       min(published_at) as earliest_article, max(published_at) as latest_article
from {silver} group by source"""


def _by_date(silver: str) -> str:
    return f"""
select date_trunc('day', published_at) as date, count(*) as total_articles,
       count(author) as total_authors
from {silver} group by 1"""


def _by_author(silver: str) -> str:
    return f"""
select author, source, count(*) as total_articles, max(published_at) as latest_article
from {silver} where author <> 'Unknown' group by author, source"""


def _mart_by_source(staged: str) -> str:
    return f"""
select source, count(*) as total_articles, round(avg(content_length), 2) as avg_content_length,
       min(published_at) as earliest_article, max(published_at) as latest_article,
       count(distinct published_date) as active_days
from {staged} group by source"""


def _mart_by_date(staged: str) -> str:
    return f"""
select published_date, published_year, published_month, count(*) as total_articles,
       count(distinct source) as unique_sources, count(distinct author) as unique_authors
from {staged} group by published_date, published_year, published_month"""


def _mart_by_author(staged: str) -> str:
    return f"""
select author, source, count(*) as total_articles, min(published_at) as first_article,
       max(published_at) as latest_article, count(distinct published_date) as active_days
from {staged} where author <> 'Unknown' group by author, source"""


def _upserted(report, same: str) -> str:
    return f"""
select * from ({report("silver")})
union all
select * from ({report("english")}) t
where not exists (select 1 from ({report("silver")}) s where {same})"""


def _decoded(extra: str = "") -> str:
    names = ("title", "description", "content", "url", "source", "published_at", "author")
    columns = ", ".join(f"case when bad then null else {n} end as {n}" for n in names)
    return f"select {columns}{extra} from messages"


def _checks(model_rows: str, model: str, required: tuple, unique: tuple) -> list[str]:
    parts = [
        f"""select 'not_null' as "check", '{model}' as model, '{c}' as "column",
        cast(count(*) filter (where {c} is null) as bigint) as failing_rows from {model_rows}"""
        for c in required
    ]
    parts += [
        f"""select 'unique' as "check", '{model}' as model, '{c}' as "column",
        cast(count(*) as bigint) as failing_rows
        from (select {c} from {model_rows} where {c} is not null group by {c} having count(*) > 1)"""
        for c in unique
    ]
    return parts


def _report(*parts: str) -> str:
    return f"""select *, failing_rows = 0 as passed from ({" union all ".join(parts)})"""


_JSON = """cast(to_json(struct_pack(title := title, description := description,
  content := content, url := url, source := source, published_at := published_at,
  author := author)) as varchar)"""
_SLUG = "translate(substr(title, 1, 50), '/ :'',?!', '-_-')"
_ARRIVED = "coalesce(try_cast(published_at as timestamp), timestamp '2024-01-01 00:00:00')"
_ISO = """case when published_at is null then '' else
  strftime(published_at, '%Y-%m-%dT%H:%M:%S')
  || case when microsecond(published_at) % 1000000 = 0 then '' else strftime(published_at, '.%f') end
  || '+00:00' end"""
_EMBEDDING_TEXT = """concat_ws(' ',
  case when title <> '' then 'Title: ' || title end,
  case when description <> '' then 'Description: ' || description end,
  case when content <> '' then 'Content: ' || content end)"""

# Word counts by hash place, as single-precision weights of unit length.
_WORDS = r"""
select id, word from (
  select id, unnest(regexp_split_to_array(lower(body), '[\s\p{Z}\x1c-\x1f\x85]+')) as word
  from texts)
where word <> ''"""


def _vectors(rows: str) -> str:
    return f"""
texts as (
  select url as id, {_EMBEDDING_TEXT} as body from {rows} where url <> '' and title <> ''
  union all
  select 'q' || q_id, question
  from (values {", ".join(f"({i}, {_text(q)})" for i, q in QUESTIONS)}) q(q_id, question)),
counted as (
  select id, cast('0x' || substr(md5(word), 1, 4) as int) % 256 as place, count(*) as n
  from ({_WORDS}) group by 1, 2),
vectors as (
  select id, place, cast(n / sqrt(sum(n * n) over (partition by id)) as float) as weight
  from counted)"""


def _weights(rows: str) -> str:
    return f"""
select id, source, cast(place as int) as place, weight
from vectors join {rows} on url = id where id not like 'q_'"""


_VECTORS = _vectors("silver")
_HITS = f"""
norms as (select id, sqrt(sum(weight::double * weight::double)) as norm from vectors group by id),
questions(q_id, question) as (values {", ".join(f"({i}, {_text(q)})" for i, q in QUESTIONS)}),
dots as (
  select q.q_id, v.id, sum(w.weight::double * v.weight::double) as dot
  from questions q join vectors w on w.id = 'q' || q.q_id
  join vectors v on v.place = w.place and v.id not in (select 'q' || q_id from questions)
  group by 1, 2),
pairs as (
  select q.q_id, s.url as id, coalesce(round(dot / (nq.norm * nv.norm), 12), 0) as score
  from questions q cross join silver s
  left join dots d on d.q_id = q.q_id and d.id = s.url
  left join norms nq on nq.id = 'q' || q.q_id
  left join norms nv on nv.id = s.url
  where s.url <> '' and s.title <> ''),
hits as (
  select p.q_id, cast(row_number() over (partition by p.q_id order by p.score desc, p.id) as int) as rank,
         s.title, s.url, s.source, coalesce(s.description, '') as description, {_ISO} as published
  from pairs p join silver s on s.url = p.id
  qualify rank <= 5)"""


def _block() -> str:
    pieces = CONTEXT_BLOCK.replace("%d", "%s").split("%s")
    values = ["rank", "title", "source", "published", "description", "url"]
    out = [_text(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        out += [value, _text(piece)]
    return " || ".join(out)


_CONTEXTS = f"""
contexts as (
  select q_id, string_agg({_block()}, chr(10) order by rank) as context from hits group by q_id)"""

_DIMS = range(64)

ORACLE = {
    "silver_articles": f"{_WITH} select * from silver",
    "gold_by_source": f"{_WITH} {_by_source('silver')}",
    "gold_by_date": f"{_WITH} {_by_date('silver')}",
    "gold_by_author": f"{_WITH} {_by_author('silver')}",
    "gold_total_check": f"""{_WITH}
select cast(sum(total_articles) as bigint) as total_articles_sum,
       (select count(*) from silver) as silver_rows,
       sum(total_articles) = (select count(*) from silver) as matches
from ({_by_source("silver")})""",
    "row_counts": f"""{_WITH}
select count(*) as bronze_rows,
       count(*) filter (where title is not null and url is not null) as usable_rows
from articles""",
    "stg_news_silver": f"{_WITH} select * from staged",
    "stg_news_sources": f"""{_WITH}
select source, count(*) as total_articles from silver where source is not null group by source""",
    "mart_articles_by_source": f"{_WITH} {_mart_by_source('staged')}",
    "mart_articles_by_date": f"{_WITH} {_mart_by_date('staged')}",
    "mart_articles_by_author": f"{_WITH} {_mart_by_author('staged')}",
    "models_stored": f"""{_WITH}
select 'stg_news_silver' as model, * from staged_in_loads
union all by name
select 'stg_news_sources' as model, source, count(*) as total_articles from in_loads group by source
union all by name select 'mart_articles_by_source' as model, * from ({_mart_by_source("staged_in_loads")})
union all by name select 'mart_articles_by_date' as model, * from ({_mart_by_date("staged_in_loads")})
union all by name select 'mart_articles_by_author' as model, * from ({_mart_by_author("staged_in_loads")})""",
    "load_verified": f"""{_WITH}
select count(*) as written, count(*) filter (where published_at is null) as undated,
       count(*) as stored, least(count(*), 5) as shown from silver""",
    "dq_report": f"{_WITH} "
    + _report(
        *_checks("staged", "stg_news_silver", ("url", "title", "source", "published_at"), ("url",)),
        *_checks(
            "(select source, count(*) from silver group by source)",
            "stg_news_sources", ("source",), ("source",),
        ),
    ),
    "dq_report_raw": f"""{_WITH}, raw as (
  select url, title, source, try_cast(published_at as timestamp) as published_at from articles) """
    + _report(
        *_checks("raw", "stg_news_silver", ("url", "title", "source", "published_at"), ("url",)),
        *_checks("raw", "stg_news_sources", ("source",), ("source",)),
    ),
    "upsert_insert_only": f"{_WITH} select * from in_loads",
    "upsert_update_insert": f"{_WITH} "
    + _upserted(_by_author, "s.author = t.author and s.source = t.source"),
    "upsert_null_key": f"{_WITH} " + _upserted(_by_date, "s.date is not distinct from t.date"),
    "anti_join_seen": f"""{_WITH}
select url, title, ingest_seq from silver
where url not in (select url from articles
                  where lang = 'en' and title is not null and url is not null)""",
    "encode_json": f"""{_WITH}
select ingest_seq, {_JSON} as value from articles""",
    "decode_json": f"{_WITH} {_decoded()}",
    "decode_variant": f"""{_WITH}
select {", ".join(f"case when ingest_seq % 19 <> 0 then {c} end as {c}" for c in (
    "title", "description", "content", "url", "source", "published_at", "author", "lang"))},
  case when ingest_seq % 19 <> 0 then ingest_seq end as seq, case when ingest_seq % 19 <> 0 then author end as second,
  null::varchar as none
from articles""",
    "rejected_messages": f"""{_WITH}
select 'not json' as _raw, count(*) as messages from messages where bad having count(*) > 0""",
    "flatten_api": f"""{_WITH}
select title, description, content, url, source, published_at, author from articles
where (ingest_seq // 50) % 5 <> 4""",
    "flatten_api_page": f"""{_WITH}
select title, description, content, url, source, published_at, author from articles
where (ingest_seq // 50) % 5 <> 4
qualify row_number() over (partition by ingest_seq // 50 order by ingest_seq) <= 20""",
    "existing_urls": f"""{_WITH}
select distinct url from articles where title is not null and url is not null""",
    "object_key": f"""{_WITH}
select ingest_seq,
       'bronze/news/' || strftime({_ARRIVED}, '%Y/%m/%d/%H%M%S') || '_' || {_SLUG} || '.json' as object_key,
       substr(url, 1, 500) as article_url, substr(title, 1, 60) as preview
from articles
where title is not null and url is not null""",
    "landed_articles": f"""{_WITH}
select title, description, content, url, source, published_at, author,
       substr(url, 1, 500) as article_url,
       'bronze/news/' || strftime({_ARRIVED}, '%Y/%m/%d/%H%M%S') || '_' || {_SLUG} || '.json' as object_key
from articles where title is not null and url is not null""",
    "stream_bronze": f"{_WITH} {_decoded()}",
    "stream_produce": f"""{_WITH}, ok as (select * from articles where (ingest_seq // 50) % 5 <> 4)
select distinct url, true as whole from ok where url is not null
union all
select url, true from ok where url is null
union all
select url, true from ok where url is null""",
    "stream_land": f"""{_WITH}
select distinct url, true as whole, substr(url, 1, 500) as article_url from articles
where title is not null and url is not null""",
    "stream_rejects": f"""{_WITH}, sent as (
  select bad, title is null or url is null as unusable,
         case when bad then 'not json' else {_JSON} end as _raw from messages)
select 'unread' as kind, _raw from sent where bad
union all
select 'unlanded', _raw from sent where bad or unusable""",
    "stream_silver": f"{_WITH} select * from in_loads",
    "stream_gold_by_source": f"{_WITH} {_by_source('in_loads')}",
    "stream_gold_by_date": f"{_WITH} {_by_date('in_loads')}",
    "stream_gold_by_author": f"{_WITH} {_by_author('in_loads')}",
    "stream_mart_by_source": f"{_WITH} {_mart_by_source('staged_in_loads')}",
    "stream_mart_by_date": f"{_WITH} {_mart_by_date('staged_in_loads')}",
    "stream_mart_by_author": f"{_WITH} {_mart_by_author('staged_in_loads')}",
    "stream_dq": f"{_WITH} "
    + _report(
        *_checks("staged_in_loads", "stg_news_silver", ("url", "title", "source", "published_at"), ("url",)),
        *_checks(
            "(select source, count(*) from in_loads group by source)",
            "stg_news_sources", ("source",), ("source",),
        ),
    ),
    "late_rejects": """
select event_id, event_id % 2 = 1 and ts < (select max(ts) - interval 5 day from events where event_id % 2 = 0) as late
from events""",
    "late_windows": """
select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end,
       count(*) as total_articles
from events group by 1, 2
having date_trunc('day', ts) + interval 1 day <= (select max(ts) - interval 1 day from events)""",
    "late_dedup": f"""{_WITH}
select distinct url from articles where title is not null and url is not null""",
    "embedding_text": f"""{_WITH}
select url, {_EMBEDDING_TEXT} as text from silver where url <> '' and title <> ''""",
    "vector_metadata": f"""{_WITH}
select title, coalesce(description, '') as description, url, source, {_ISO} as published_at, author
from silver where url <> '' and title <> ''""",
    "embed_hashed": f"""{_WITH}, {_VECTORS}
select id, cast(place as int) as place, weight from vectors
where id not like 'q_'""",
    "vector_upsert": f"""{_WITH}, kept as (
  select * from silver where url <> '' and title <> ''
  union all
  select * from english
  where url <> '' and title <> '' and url not in (select url from silver where title <> '')),
{_vectors("kept")} {_weights("kept")}""",
    "vector_counts": f"""{_WITH}
select layout, count(*) as vectors from silver, (values ('replaced'), ('inserted')) l(layout)
where url <> '' and title <> '' group by layout""",
    "stream_vectors": f"{_WITH}, {_vectors('in_loads')} {_weights('in_loads')}",
    "topk_similar": f"""
with means as (
  select label as q_id, [{", ".join(f"avg(embedding[{i + 1}]::double)" for i in _DIMS)}] as mean
  from embeddings group by label),
scored as (
  select q_id, vec_id as id,
         list_cosine_similarity(mean, embedding::double[]) as score
  from means, embeddings)
select q_id, cast(row_number() over (partition by q_id order by score desc, id) as int) as rank,
       id, round(score, 6) + 0.0 as score
from scored qualify rank <= 10""",
    "topk_lsh": f"""
with planes as (
  select p, list(case when ('0x' || substr(md5(p || ':' || d), 2, 1))::int % 2 = 1 then 1.0::double else -1.0 end
                 order by d) as signs
  from range(32 * 8) t(p), range({len(_DIMS)}) u(d) group by p),
units as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
keys as (
  select vec_id, p // 8 as tab, sum(case when list_dot_product(v, signs) >= 0 then 1 << (p % 8) else 0 end) as key
  from units, planes group by 1, 2),
pairs as (
  select distinct a.vec_id as q_id, b.vec_id as id
  from keys a join keys b on a.tab = b.tab and a.key = b.key where a.vec_id % 40 = 0),
enough as (
  select q_id from pairs group by q_id
  having count(*) >= least(10, (select count(*) from embeddings))),
met as (
  select * from pairs where q_id in (select q_id from enough)
  union all
  select a.vec_id, b.vec_id from units a, units b
  where a.vec_id % 40 = 0 and a.vec_id not in (select q_id from enough)),
scored as (
  select q_id, id, round(list_cosine_similarity(a.v, b.v), 12) as score
  from met join units a on a.vec_id = q_id join units b on b.vec_id = id)
select q_id, cast(row_number() over (partition by q_id order by score desc, id) as int) as rank,
       id, round(score, 6) + 0.0 as score
from scored qualify rank <= 10""",
    "rag_context": f"{_WITH}, {_VECTORS}, {_HITS}, {_CONTEXTS} select q_id, context from contexts",
    "rag_prompt": f"""{_WITH}, {_VECTORS}, {_HITS}, {_CONTEXTS}
select q.q_id, question,
       {_text(PROMPT_HEAD)} || context || {_text(PROMPT_QUESTION)} || question
         || {_text(PROMPT_TAIL)} as prompt,
       case when context is null then {_text(NO_ARTICLES)} end as fallback_answer
from questions q left join contexts c on c.q_id = q.q_id""",
    "rag_sources": f"""{_WITH}, {_VECTORS}, {_HITS}
select q.q_id, question, string_agg(source, '; ' order by rank) as sources
from questions q join hits h on h.q_id = q.q_id group by 1, 2""",
    "source_links": f"""{_WITH}, {_VECTORS}, {_HITS}
select q_id, rank, title, url, source, published as published_at,
       '- [' || title || '](' || url || ') — **' || source || '**' as link
from hits""",
}
