"""Reference-shaped rows derived from the given tables. The SQL runs unchanged in both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

IMG = "concat('img_', lpad(cast(cast(floor({0}/8) as bigint) as string),5,'0'))"
_TYPE = "case cast({0}%6 as int) when 0 then 'brand' when 1 then 'landmark' when 2 then 'text' when 3 then 'person' when 4 then 'product' else 'object' end"

#: Relations that exercise every rule table, with a few that none knows.
RELATIONS = (
    "founded_by", "Founded In", "ceo", "owner_of", "brand_of", "author", "lyrics_by", "book_and_lyrics_by", "music_by", "features_songs_by",
    "directed_by", "has_theaters_count", "annual_revenue", "population", "total area", "price", "incorporated_as", "originally_named", "country",
    "born_in", "death_date", "closed_in", "premiered_on", "released_in", "established", "performed_at", "opened_at", "headquartered_in",
    "located_in", "related_to", "located_left_of", "plays_for", "won_championship_in", "covered_the_pre_draft_workout_of", "a_b_c_d", "has_logo",
    "celebrity_guest", "hometown", "based_in", "starring", "stock_exchange", "menu_item", "role", "  Part Of ", "sales figures",
)

_CUSTOMERS = f"""
  select c.*, n.n_name, r.r_name, y.y0, y.y1, {IMG.format("c_custkey")} as img_id,
    lead(c_name) over (partition by floor(c_custkey/8) order by c_custkey) as next_name
  from {{customer}} c join {{nation}} n on c.c_nationkey = n.n_nationkey join {{region}} r on n.n_regionkey = r.r_regionkey
  left join {{yrs}} y on y.o_custkey = c.c_custkey
"""
#: Triples of a customer: when there is one, its number, head, relation, tail, kind, value and unit.
TRIPLE_ROWS = (
    ("", 1, "c_name", "'based_in'", "n_name", "'LOCATION'", "null", "' km '"),
    ("", 2, "c_name", "'member_of'", "c_mktsegment", "'ORG'", "null", "null"),
    ("", 3, "c_name", "'Annual Revenue'", "cast(cast(floor(c_acctbal) as bigint) as string)", "' quantity '", "cast(cast(floor(c_acctbal) as bigint) as string)", "'usd'"),
    ("y0 is not null", 4, "c_name", "'founded_in'", "cast(y0 as string)", "'time'", "cast(y0 as string)", "'year'"),
    ("y1 is not null", 5, "case when c_custkey%4=0 then concat(c_name, ' Corp') else c_name end", "'closed_in'", "cast(y1 as string)", "'TIME'", "cast(y1 as string)", "'year'"),
    ("", 6, "n_name", "'located_in'", "r_name", "'LOCATION'", "null", "null"),
    ("c_custkey%3=0 and next_name is not null", 7, "c_name", "'related_to'", "next_name", "'bogus'", "null", "null"),
)


def _triple(number: int, *texts: str) -> str:
    names = ("head", "relation", "tail", "tail_type", "normalized_value", "unit")
    return f"img_id, cast(c_custkey*10+{number} as bigint) as ord, " + ", ".join(f"cast({t} as string) as {n}" for t, n in zip(texts, names, strict=True))


VIEWS = {
    "geo_raw": f"""
select {IMG.format("p_partkey")} as img_id, cast(p_partkey % 8 as int) as ord,
  case when p_partkey%5=0 then upper(p_name) when p_partkey%7=3 then concat('  ', p_name, ' ') when p_partkey%31=4 then ' x ' else p_name end as name, {_TYPE.format("p_partkey")} as etype,
  1000+40*cast(floor(p_partkey/8) as bigint)%400 as w, 800+30*cast(floor(p_partkey/8) as bigint)%210 as h,
  case when p_partkey%97=0 then 0 else (p_partkey*37)%700 end as rx1, case when p_partkey%97=0 then 0 else (p_partkey*53)%700 end as ry1,
  case when p_partkey%97=0 then 1000 else (p_partkey*37)%700+20+(p_partkey*17)%280 end as rx2,
  case when p_partkey%97=0 then 1000 else (p_partkey*53)%700+20+(p_partkey*29)%280 end as ry2,
  cast((p_partkey*31)%100 as double)/100 as confidence, case when p_partkey%10=3 then 'High' else 'low' end as level
from {{part}}""",
    "yrs": "select o_custkey, min(year(o_orderdate)) as y0, max(year(o_orderdate)) as y1 from {orders} group by o_custkey",
    "kg_ent": f"""
select {IMG.format("c_custkey")} as img_id, cast(c_custkey % 8 as int) as ord, concat('E', cast(c_custkey % 8 + 1 as string)) as id, c_name as name,
  {_TYPE.format("c_custkey")} as etype, cast((c_custkey*31)%100 as double)/100 as confidence,
  case cast(c_custkey % 4 as int) when 0 then '大幅画面上方偏左' when 1 then '画面中央' when 2 then '偏右' else '' end as location,
  cast(c_custkey%50 as bigint) as x1, cast(c_custkey%40 as bigint) as y1, cast(c_custkey%50+60 as bigint) as x2, cast(c_custkey%40+55 as bigint) as y2
from {{customer}}""",
    "kg_triples_raw": f"with c as ({_CUSTOMERS})\n" + " union all ".join(f"select {_triple(*row)} from c" + (f" where {test}" if test else "") for test, *row in TRIPLE_ROWS),
    "alias_groups": """
select img_id, c_custkey*10 as group_ord, concat(c_name, ' ') as canonical, concat(' ', c_name, ' Corp') as alias from {kg_cust} where c_custkey%4=0
union all select img_id, c_custkey*10+1, c_name, lower(c_name) from {kg_cust} where c_custkey%8=1
union all select img_id, c_custkey*10+2, next_name, c_name from {kg_cust} where floor(c_custkey/8)%10=0 and c_custkey%8<2 and next_name is not null""",
    "kg_cust": f"""
select c_custkey, c_name, {IMG.format("c_custkey")} as img_id, lead(c_name) over (partition by floor(c_custkey/8) order by c_custkey) as next_name from {{customer}}""",
    "tool_rows": """
select concat(cast(user_id as string), '_', cast(cast(ts as date) as string)) as img_id, ts, event_id,
  case event_type when 'view' then 'web_search' when 'click' then ' Visit' when 'signup' then 'image_search' when 'purchase' then 'code_interpreter' else 'OCR' end as tool
from {events}""",
    "page_rows": """
select page_id, case when page_id%11=0 then concat('http://www.facebook.com/', cast(page_id as string)) else url end as url,
  regexp_extract(html, '<title>([^<]*)</title>', 1) as title, html, cast(floor(page_id/40) as int) as topic
from {pages}""",
    "json_blobs": """
select event_id, case cast(event_id%5 as int) when 0 then props when 1 then concat('```json', chr(10), props, chr(10), '```')
  when 2 then concat('The answer is ', props, ' as asked.') when 3 then substring(props, 1, length(props)-1) else concat('[', props, ', ', props, ']') end as raw
from {events}""",
    "rel_rows": "select event_id, relation, kind from {events} join (values "
    + ", ".join(f"({k}, '{r}')" for k, r in enumerate(RELATIONS))
    + f") r(k, relation) on event_id % {len(RELATIONS)} = k join (values (0,'TIME'),(1,'QUANTITY'),(2,'LOCATION'),(3,'PERSON'),(4,'ORG'),(5,'OTHER')) t(j, kind) on floor(event_id / {len(RELATIONS)}) % 6 = j",
    "answer_rows": """
select event_id, kind, case cast(event_id%9 as int) when 0 then '  ' when 1 then ' USA ' when 2 then 'Company  ' when 3 then 'founder' when 4 then 'unknown' when 5 then 'New York City' when 6 then 'Europe'
  else relation end as answer from {rel_rows}""",
    "geo_wide": """
select concat('wide_', cast(cast(floor(p/40) as bigint) as string)) as img_id, cast(p%40 as int) as ord, name, etype, w, h, rx1, ry1, rx2, ry2, confidence, level
from (select *, cast(substring(img_id, 5) as bigint)*8 + ord as p from {geo_raw}) g""",
    "alias_links": f"""
select img_id, alias, canonical from (
  select {IMG.format("c_custkey")} as img_id, c_name as alias, case when c_custkey%8=5 and floor(c_custkey/8)%3=0 then lag(c_name, 3) over (partition by floor(c_custkey/8) order by c_custkey)
    when c_custkey%8=3 and floor(c_custkey/8)%5=1 then cast(null as string) else lead(c_name) over (partition by floor(c_custkey/8) order by c_custkey) end as canonical
  from {{customer}}) l where canonical is not null""",
    "tries": """
select concat('img_', cast(o_custkey as string)) as img_id, case when o_orderkey%3=0 then 'questions' else 'enrich' end as stage, cast(o_orderkey as bigint) as run,
  case when o_orderstatus='P' then 'skip' when o_orderkey%5=0 then 'ok' when o_orderkey%7=0 then 'waiting' else 'error' end as status, concat('why ', cast(o_orderkey%4 as string)) as reason,
  cast(o_orderkey%9 as bigint) as n_entities, cast(o_orderkey%30 as bigint) as n_triples, cast(o_orderkey%10 as bigint) as n_questions, floor(o_totalprice)/1000 as seconds
from {orders}""",
    "run_rows": """
select o_orderkey as img_id, case when o_orderstatus = 'F' then 'step1_error' else 'ok' end as status, o_orderkey % 10 as n_questions,
  floor(o_totalprice)/100 as step1_sec, floor(o_totalprice)/1000 as step2_sec from {orders}""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _triples_in_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kg_triples_raw`` without its union: a customer's triples are structs of one row, so the joins below run once."""
    parts = [f"case when {test or 'true'} then struct({_triple(*row)}) end" for test, *row in TRIPLE_ROWS]
    wide = spark.sql(f"select filter(array({', '.join(parts)}), x -> x is not null) as items from ({_CUSTOMERS}) c", **_used(spark, sf_dir, _CUSTOMERS))
    return wide.selectExpr("inline(items)")


def _used(spark: SparkSession, sf_dir: str, sql: str) -> dict[str, DataFrame]:
    return {t: view(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", sql))}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived view of them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "kg_triples_raw":
        return _triples_in_one_scan(spark, sf_dir)
    sql = VIEWS[name]
    return spark.sql(sql, **_used(spark, sf_dir, sql))


def ctes(*names: str) -> str:
    """The views as common table expressions, each after those it uses."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in TABLES or name in done:
            return
        for t in re.findall(r"\{(\w+)\}", VIEWS[name]):
            add(t)
        done[name] = re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])

    for n in names:
        add(n)
    return ",\n".join(f"{k} as ({v})" for k, v in done.items())
