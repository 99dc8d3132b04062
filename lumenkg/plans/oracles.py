"""DuckDB SQL for the engine's queries, from the same rule tables and derived views."""

from __future__ import annotations

from lumenkg.functions import rules as r
from lumenkg.functions.strings import STOP_WORDS
from lumenkg.plans.fixtures import ctes


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(map(q, words)) + ")"


def any_of(col: str, words) -> str:
    return "(" + " or ".join(f"contains({col}, {q(w)})" for w in words) + ")" if words else "false"


def tokens(col: str) -> str:
    return f"list_filter(list_distinct(regexp_split_to_array({col}, '[^a-z0-9]+')), lambda x: x <> '' and x not in {in_list(STOP_WORDS)})"


def cases(pairs, default: str) -> str:
    return "case " + " ".join(f"when {a} then {b}" for a, b in pairs) + f" else {default} end"


def bucket(rel: str, kind: str) -> str:
    t = cases([(any_of(rel, w), q(b)) for w, b in r.TIME_BUCKETS], "'time_other'")
    n = cases([(any_of(rel, w), q(b)) for w, b in r.QUANTITY_BUCKETS], "'quantity_other'")
    return f"case when {kind} = 'TIME' then {t} when {kind} = 'QUANTITY' then {n} else 'other' end"


SLUG = "replace(lower(trim({0})), ' ', '_')"


def natural(rel: str, kind: str) -> str:
    out = [(f"{rel} = ''", q("相关属性"))]
    for phrases, words, label, time in r.NATURAL_TEXTS:
        test = any_of(rel, phrases)
        if words:
            test = f"({test} or list_has_any({tokens(rel)}, [{', '.join(map(q, words))}]))"
        out.append((test, q(label) if time is None else f"case when {kind} = 'TIME' then {q(time)} else {q(label)} end"))
    return cases(out, f"replace({rel}, '_', ' ')")


def by_kind(kind: str, table: dict, default: str) -> str:
    return cases([(f"{kind} = {q(k)}", q(v)) for k, v in table.items()], q(default))


def wh(rel: str, kind: str) -> str:
    place = f"case when {any_of(rel, r.WHERE_RELATIONS)} then 'where' else 'which_place' end"
    return f"case {kind} when 'PERSON' then 'who' when 'TIME' then 'when' when 'QUANTITY' then 'how_many' when 'LOCATION' then {place} when 'ORG' then 'which_org' else 'what' end"


def tools(rel: str, kind: str) -> str:
    return f"list_concat(list_concat(case when {kind} in ('TIME', 'QUANTITY') then ['code_interpreter'] else [] end, case when {any_of(rel, r.IMAGE_RELATIONS)} then ['image_search'] else [] end), ['web_search'])"


def value(rel: str, kind: str) -> str:
    return " + ".join(f"case when {any_of(rel, w)} then {v}::double else 0.0::double end" for w, v in r.QUESTION_VALUES) + f" + case when {kind} in ('PERSON', 'ORG') then 0.4::double else 0.0::double end"


def follow(rel: str, kind: str) -> str:
    pairs = [(any_of(rel, w), q(c) if p is None else f"case when {kind} = 'LOCATION' then {q(p)} else {q(c)} end") for w, c, p in r.FOLLOW_CLAUSES]
    n = natural(rel, kind)
    return cases(pairs, f"case when starts_with({n}, '相关') then {by_kind(kind, r.VAGUE_PROMPTS, '答案是什么')} else {n} || {by_kind(kind, r.ANSWER_PROMPTS, '是什么')} end")


def profiled(source: str) -> str:
    """CTEs p1 to p3 that add slug, text and the profile's numbers to ``source``(relation, kind, ...)."""
    yes = lambda test, v: f"case when {test} then {v}::double else 0::double end"
    strong, weak, other = f"slug in {in_list(r.STRONG_RELATIONS)}", f"slug in {in_list(r.LOW_VALUE_RELATIONS)}", "kind = 'OTHER'"
    return f"""p1 as (select *, {SLUG.format("relation")} as slug from {source}),
p2 as (select *, {natural("slug", "kind")} as question_head, {value("slug", "kind")} as worth from p1),
p3 as (select *, case when question_head <> replace(slug, '_', ' ') and not starts_with(question_head, '相关') then 0.85::double
    when question_head = replace(slug, '_', ' ') and len(string_split(slug, '_')) <= 3 then 0.65::double else 0.2::double end as base from p2),
p4 as (select *, greatest(0::double, least(2::double, 0.7::double + greatest(0::double, worth) * 0.25::double + {yes(strong, 0.35)} - {yes(weak, 1.0)} - {yes(other, 0.3)})) as askability,
    greatest(0::double, least(1.5::double, base + {yes(strong, 0.25)} - {yes(weak, 0.5)} - {yes(other, 0.2)})) as lexicalizability,
    greatest(0::double, least(1.5::double, case when base >= 0.6 then 0.8::double else 0.2::double end + {yes(strong, 0.15)})) as hideability,
    greatest(0::double, case when base >= 0.6 then 0::double else 0.9::double end + {yes(weak, 1.2)}) as generic_penalty from p3)"""


KEPT = ctes("geo_raw") + """,
g1 as (select *, row_number() over (partition by img_id, lower(name) order by ord) as rn from (select * replace (trim(name) as name) from geo_raw) where length(name) >= 2),
g2 as (select *, greatest(0, cast(trunc(rx1/1000::double*w) as bigint)) as x1, greatest(0, cast(trunc(ry1/1000::double*h) as bigint)) as y1 from g1 where rn = 1),
g3 as (select *, least(w, greatest(x1+1, cast(trunc(rx2/1000::double*w) as bigint))) as x2, least(h, greatest(y1+1, cast(trunc(ry2/1000::double*h) as bigint))) as y2 from g2),
k0 as (select *, (x2-x1)*(y2-y1) as area, (x2-x1)*(y2-y1)/(w*h)::double as share, (x1+x2)/2::double as cx, (y1+y2)/2::double as cy from g3 where (x2-x1)*(y2-y1)/(w*h)::double <= 0.8),
kept as (select *, row_number() over (partition by img_id order by ord) as idx from k0),
kid as (select *, concat('E', idx) as id from kept)"""
PAIRS = KEPT + """,
pr as (select a.img_id, a.id as a_id, b.id as b_id, a.idx as a_idx, b.idx as b_idx, a.name as a_name, b.name as b_name, b.cx-a.cx as dx, b.cy-a.cy as dy from kid a join kid b on a.img_id = b.img_id and a.idx < b.idx)"""
SEEDS = KEPT + f""",
s0 as (select *, row_number() over (partition by img_id order by confidence desc, idx) as rank from kid),
s1 as (select * from s0 where not (etype = 'object' and lower(trim(name)) in {in_list(r.GENERIC_OBJECTS)})),
seeds as (select * exclude (sn) from (select *, row_number() over (partition by img_id, lower(trim(name)) order by rank) as sn from s1) where sn = 1
  union all select * exclude (sn) from (select *, row_number() over (partition by img_id order by idx) as sn from s0 where img_id not in (select img_id from s1)) where sn <= 5)"""
WIDE = (ctes("geo_wide") + SEEDS[len(ctes("geo_raw")):]).replace("(trim(name) as name) from geo_raw)", "(trim(name) as name) from geo_wide)")
GENERIC = SEEDS.replace("(select * replace (trim(name) as name) from geo_raw)", "(select * replace (trim(name) as name) from (select * replace (case when cast(substring(img_id, 5) as bigint) % 3 = 0 then ['car', 'Tree', ' sky ', 'Wall', 'door', 'sign', 'floor', 'person'][ord + 1] else name end as name, case when cast(substring(img_id, 5) as bigint) % 3 = 0 then 'object' else etype end as etype) from geo_raw))")
CLEAN = ctes("kg_ent", "kg_triples_raw") + """,
tri as (select img_id, ord, trim(head) as head, relation, trim(tail) as tail, case when upper(trim(tail_type)) in ('TIME','QUANTITY','LOCATION','PERSON','ORG','OTHER') then upper(trim(tail_type)) else 'OTHER' end as tail_type,
  coalesce(trim(normalized_value), '') as nv_raw, coalesce(trim(unit), '') as unit,
  case when regexp_full_match(coalesce(trim(normalized_value), ''), '-?[0-9]+([.][0-9]+)?') then cast(trim(normalized_value) as double) end as nv_num,
  case when coalesce(trim(normalized_value), '') = '' then 'empty' when regexp_full_match(trim(normalized_value), '-?[0-9]+') then 'int'
    when regexp_full_match(trim(normalized_value), '-?[0-9]+[.][0-9]+') then 'float' else 'str' end as nv_kind from kg_triples_raw)"""
NORMAL = CLEAN + """,
ends as (select distinct img_id, given from (select img_id, head as given from tri union all select img_id, tail from tri)),
best as (select img_id, given, canon from (select e.img_id, e.given, k.name as canon, row_number() over (partition by e.img_id, e.given order by length(k.name) desc, k.ord) as rn
  from ends e join kg_ent k on e.img_id = k.img_id and length(k.name) >= 3 and (contains(lower(e.given), lower(k.name)) or contains(lower(k.name), lower(e.given)))) where rn = 1),
n1 as (select t.* replace (coalesce(a.canon, t.head) as head, coalesce(b.canon, t.tail) as tail) from tri t left join best a on t.img_id = a.img_id and t.head = a.given left join best b on t.img_id = b.img_id and t.tail = b.given),
norm as (select * exclude (rn) from (select *, row_number() over (partition by img_id, lower(head), lower(relation), lower(tail) order by ord) as rn from n1 where head <> '' and tail <> '' and lower(head) <> lower(tail)) where rn = 1)"""
ALIAS = CLEAN + "," + ctes("alias_groups").replace("kg_cust as", "kg_cust as", 1) + """,
cand as (select distinct img_id, name from (select img_id, name from kg_ent union all select img_id, head from tri union all select img_id, tail from tri)
  where length(name) between 2 and 80 and not regexp_full_match(translate(name, ',.% ', ''), '[0-9]+')),
ali as (select img_id, alias, canonical from (select g.*, row_number() over (partition by g.img_id, alias order by group_ord desc, canonical desc) as rn from (select * replace (trim(alias) as alias, trim(canonical) as canonical) from alias_groups) g
  join cand a on g.img_id = a.img_id and g.alias = a.name join cand c on g.img_id = c.img_id and g.canonical = c.name where alias <> canonical) where rn = 1)"""
TRI_COLS = "img_id, ord, head, relation, tail, tail_type, nv_raw, nv_num, nv_kind, unit"
GRAPH = NORMAL + f""",
own as (select img_id, ord, concat('region:', id) as region, concat('entity:', lower(name)) as entity, name, etype, confidence, location from kg_ent),
src as (select *, tail_type as kind from norm),
{profiled("src")},
rs as (select p.*, o.entity is null as synthetic, concat('entity:', lower(head)) as ent, concat('fact:', lower(head), ':', slug, ':', lower(tail)) as fact_key
  from p4 p left join (select distinct img_id, entity from own) o on p.img_id = o.img_id and concat('entity:', lower(p.head)) = o.entity),
re as (select img_id, ent as entity, fact_key, head, relation, slug, tail, tail_type, nv_num, askability, lexicalizability, first_ord as ord from
  (select *, min(ord) over (partition by img_id, ent, fact_key) as first_ord, row_number() over (partition by img_id, ent, fact_key order by ord desc) as ln from rs
   where slug not in {in_list(r.LOW_VALUE_RELATIONS)} and askability > 0) where ln = 1),
rank as (select *, row_number() over (partition by img_id, entity order by askability desc, ord) as place from re),
bre as (select o.img_id, o.region, o.ord as region_ord, o.etype, k.* exclude (img_id) from own o join rank k on o.img_id = k.img_id and o.entity = k.entity)"""
COMPARABLE = lambda kind: GRAPH + f""",
side as (select *, {bucket("relation", q(kind))} as bk, {tokens("relation")} as tk from bre where tail_type = {q(kind)}),
cmp as (select a.img_id, a.region as a_region, b.region as b_region, a.fact_key as a_fact_key, b.fact_key as b_fact_key, a.nv_num as a_num, b.nv_num as b_num,
  case when a.relation = b.relation then 1.0::double when a.bk = b.bk and not ends_with(a.bk, 'other') then 0.6::double when list_has_any(a.tk, b.tk) then 0.3::double else 0::double end as score,
  case when a.relation = b.relation then a.relation else {q("time_attribute" if kind == "TIME" else "quantity_attribute")} end as bucket
  from side a join side b on a.img_id = b.img_id and a.region_ord < b.region_ord)"""  # noqa: E731
QUESTIONS = ctes("tool_rows") + f""",
t1 as (select img_id, count(*) as n_tools, max(case when lower(trim(tool)) in {in_list(r.CODE_TOOLS)} then 1 else 0 end) as code, max(case when lower(trim(tool)) in {in_list(r.SEARCH_TOOLS)} then 1 else 0 end) as search from tool_rows group by img_id),
t2 as (select img_id, split_part(img_id, '_', 2) as day, n_tools, case when code = 1 and search = 1 then 'hybrid' when code = 1 then 'code' else 'retrieval' end as category,
  case when n_tools >= 5 then 'hard' when n_tools >= 3 then 'medium' else 'easy' end as difficulty from t1)"""
NUMBERED = QUESTIONS + """,
t3 as (select *, concat(category, '_', difficulty, '_', case when length(cast(rn as varchar)) < 2 then concat('0', rn) else cast(rn as varchar) end) as question_id from
  (select *, row_number() over (partition by day, category order by img_id) as rn from t2))"""

ORACLES = {
    "entities_kept": f"with {KEPT} select img_id, ord, id, name, etype, x1, y1, x2, y2 from kid",
    "entity_location": f"""with {KEPT} select img_id, id, concat(case when share > 0.15 then '大幅' when share < 0.005 then '细小的' else '' end, '画面', case when a = '' and d = '' then '中央' else concat(d, a) end) as location
from (select *, case when cx/w < 0.2 then '最左侧' when cx/w < 0.4 then '偏左' when cx/w > 0.8 then '最右侧' when cx/w > 0.6 then '偏右' else '' end as a,
  case when cy/h < 0.2 then '顶部' when cy/h < 0.4 then '上方' when cy/h > 0.8 then '底部' when cy/h > 0.6 then '下方' else '' end as d from kid)""",
    "entity_values": f"""with {ctes("geo_raw")}, n as (select img_id, ord, concat(name, ' ', rx1, case when rx1 % 3 = 0 then 'kg' when rx1 % 3 = 1 then ' GHz' else 'x' end, ' $', ry1, '.5') as name from geo_raw)
select img_id, ord, nullif(trim(regexp_extract(name, '(?i)([$¥]\\s*\\d+(?:[.,]\\d+)?)|(\\d+(?:[.,]\\d+)?\\s*(?:kg|g|cm|mm|inch|in|hz|mhz|ghz|gb|tb|w|kw|v|mah))', 0)), '') as value,
  list_transform(regexp_extract_all(name, '\\b(\\d{{1,4}})\\b', 1), lambda x: cast(x as int)) as numbers from n""",
    "entity_views": f"""with {KEPT}, b as (select *, x2-x1 as bw, y2-y1 as bh, (x1+x2)//2 as mx, (y1+y2)//2 as my from kid)
select img_id, id, 'tight' as view, x1, y1, x2, y2 from b
union all select img_id, id, 'pad20', greatest(0, x1-cast(trunc(bw*0.2::double) as bigint)), greatest(0, y1-cast(trunc(bh*0.2::double) as bigint)), least(w, x2+cast(trunc(bw*0.2::double) as bigint)), least(h, y2+cast(trunc(bh*0.2::double) as bigint)) from b
union all select img_id, id, 'pad40', greatest(0, x1-cast(trunc(bw*0.4::double) as bigint)), greatest(0, y1-cast(trunc(bh*0.4::double) as bigint)), least(w, x2+cast(trunc(bw*0.4::double) as bigint)), least(h, y2+cast(trunc(bh*0.4::double) as bigint)) from b
union all select img_id, id, 'context', greatest(0, mx-2*bw), greatest(0, my-2*bh), least(w, mx+2*bw), least(h, my+2*bh) from b
union all select img_id, id, 'full_scene', 0, 0, w, h from b""",
    "bbox_areas": f"with {KEPT} select img_id, id, name, area, floor(share*10000::double+0.5::double)/10000::double as relative_area, x2-x1 as width, y2-y1 as height from kid",
    "layout_relations": f"""with {PAIRS} select img_id, a_id, b_id, case when abs(dx) > abs(dy) then case when dx > 0 then 'right_of' else 'left_of' end when dy > 0 then 'below' else 'above' end as direction,
  floor(sqrt(dx*dx+dy*dy)*10::double+0.5::double)/10::double as distance from pr""",
    "direction_8way": f"""with {PAIRS}, t as (select *, case when abs(dx) <= 1 and abs(dy) <= 1 then 0 else (degrees(atan2(dy, -dx)) + 360) % 360 end as turn from pr)
select img_id, a_id, b_id, concat(b_name, '的', case when turn < 22.5 or turn >= 337.5 then '右方' when turn < 67.5 then '右上方' when turn < 112.5 then '上方' when turn < 157.5 then '左上方'
  when turn < 202.5 then '左方' when turn < 247.5 then '左下方' when turn < 292.5 then '下方' else '右下方' end) as direction from t""",
    "area_extremum": f"with {KEPT} select img_id, arg_max(id, area*1000-idx) as largest, arg_min(id, area*1000-idx) as smallest from kid group by img_id",
    "spatial_triples": f"""with {PAIRS} select img_id, a_idx, b_idx, a_name as head, b_name as tail, case when abs(dx) >= abs(dy) then case when dx > 0 then 'located_left_of' else 'located_right_of' end
  when dy > 0 then 'located_above' else 'located_below' end as relation from pr""",
    "domain_guess": f"with {KEPT}, n as (select img_id, lower(string_agg(name, ' ' order by idx)) as names from kid group by img_id) select img_id, {cases([(any_of('names', w), q(d)) for d, w in r.DOMAINS], q('other'))} as domain from n",
    "core_anchors": f"""with {KEPT}, s0 as (select *, row_number() over (partition by img_id order by confidence desc, idx) as rank from kid),
c as (select *, row_number() over (partition by img_id, lower(trim(name)) order by rank) as cn from s0 where confidence >= 0.8 or lower(level) = 'high'),
f as (select *, row_number() over (partition by img_id order by idx) as fn from s0 where img_id not in (select img_id from c))
select img_id, id, name, confidence from c where cn = 1 union all select img_id, id, name, confidence from f where fn <= 5""",
    "expansion_seeds": f"with {GENERIC} select img_id, id, name, rank from seeds",
    "tier1_brand_dense": f"""with {WIDE}, m as (select *, count(*) over (partition by img_id) as n, avg(case when etype in ('brand','text') then 1.0 else 0.0 end) over (partition by img_id) as dense,
  area * case when etype in ('person','landmark','product') then 1.5::double else 1::double end * confidence as score from seeds where (case cast(idx % 3 as int) when 0 then 'proposal' when 1 then 'vlm_only' else '' end) in ('vlm_only', '') or lower(level) = 'high'),
o as (select *, row_number() over (partition by img_id order by score desc, idx) as place from m)
select img_id, id, score, place from o where not (n > 12 or (n >= 12 and dense > 0.7)) or place <= 12""",
    "pairs_capped": f"""with {KEPT}, k2 as (select *, row_number() over (partition by img_id order by case when etype in ('person','landmark','product','brand') then 1 else 0 end desc, confidence desc, idx) as rk from kid),
p as (select a.img_id, a.rk as a_rank, b.rk as b_rank, a.name as a_name, b.name as b_name, row_number() over (partition by a.img_id order by a.rk, b.rk) as n from k2 a join k2 b on a.img_id = b.img_id and a.rk < b.rk)
select img_id, a_rank, b_rank, a_name, b_name from p where n <= 5""",
    "triples_sanitized": f"with {CLEAN} select {TRI_COLS} from tri",
    "triples_normalized": f"with {NORMAL} select {TRI_COLS} from norm",
    "alias_candidates": f"with {ALIAS} select img_id, name from cand",
    "triples_aliased": f"""with {ALIAS}, a1 as (select t.* replace (coalesce(a.canonical, t.head) as head, coalesce(b.canonical, t.tail) as tail) from tri t
  left join ali a on t.img_id = a.img_id and t.head = a.alias left join ali b on t.img_id = b.img_id and t.tail = b.alias)
select {TRI_COLS} from (select *, row_number() over (partition by img_id, lower(head), lower(relation), lower(tail) order by ord) as rn from a1 where head <> '' and tail <> '' and lower(head) <> lower(tail)) where rn = 1""",
    "entities_after_alias": f"with {ALIAS} select e.img_id, e.ord, e.name from kg_ent e where not exists (select 1 from ali a where a.img_id = e.img_id and a.alias = e.name)",
    "expand_merge": f"""with {NORMAL}, fresh as (select *, row_number() over (partition by img_id, lower(head), lower(relation), lower(tail) order by ord) as rn from tri where ord % 10 >= 3),
old as (select * from norm where ord % 10 <= 4)
select img_id, ord, head, relation, tail from old union all
select f.img_id, coalesce(m.last, 0) + row_number() over (partition by f.img_id order by ord) - 1, head, relation, tail from fresh f left join (select img_id, max(ord) + 1 as last from old group by img_id) m on f.img_id = m.img_id
where rn = 1 and not exists (select 1 from old o where o.img_id = f.img_id and lower(o.head) = lower(f.head) and lower(o.relation) = lower(f.relation) and lower(o.tail) = lower(f.tail))""",
    "cross_merge": f"""with {NORMAL}, f0 as (select img_id, ord, trim(head) as head, trim(upper(relation)) as relation, trim(tail) as tail from tri where ord % 10 >= 3),
fresh as (select *, row_number() over (partition by img_id, lower(head), lower(relation), lower(tail) order by ord) as rn from f0 where head <> '' and tail <> '' and lower(head) <> lower(tail)),
old as (select * from norm where ord % 10 <= 4)
select img_id, ord, head, relation, tail from old union all
select f.img_id, coalesce(m.last, 0) + row_number() over (partition by f.img_id order by ord) - 1, head, relation, tail from fresh f left join (select img_id, max(ord) + 1 as last from old group by img_id) m on f.img_id = m.img_id
where rn = 1 and not exists (select 1 from old o where o.img_id = f.img_id and lower(o.head) = lower(f.head) and lower(o.relation) = lower(f.relation) and lower(o.tail) = lower(f.tail))""",
    "tail_topk": f"""with {CLEAN}, c as (select img_id, tail, count(*) as n, min(ord) as first_ord from tri t where length(tail) >= 3 and not exists (select 1 from kg_ent k where k.img_id = t.img_id and lower(k.name) = lower(t.tail)) group by img_id, tail)
select img_id, tail, n, rank from (select *, row_number() over (partition by img_id order by n desc, first_ord) as rank from c) where rank <= 6""",
    "tail_context": f"""with {CLEAN}, c as (select img_id, tail, count(*) as n, min(ord) as first_ord from tri where length(tail) >= 3 group by img_id, tail),
top as (select img_id, tail from (select *, row_number() over (partition by img_id order by n desc, first_ord) as rank from c) where rank <= 6),
b as (select t.*, row_number() over (partition by t.img_id, t.tail order by t.ord) as nth from tri t join top using (img_id, tail))
select img_id, tail, string_agg(concat(head, ' ', relation, ' ', tail), '; ' order by nth) as context from b where nth <= 3 group by img_id, tail""",
    "unconnected_pairs": f"""with {NORMAL}, con as (select distinct img_id, least(lower(head), lower(tail)) as lo, greatest(lower(head), lower(tail)) as hi from norm)
select a.img_id, a.name as a_name, b.name as b_name from kg_ent a join kg_ent b on a.img_id = b.img_id and a.ord < b.ord
where not exists (select 1 from con c where c.img_id = a.img_id and c.lo = least(lower(a.name), lower(b.name)) and c.hi = greatest(lower(a.name), lower(b.name)))""",
    "spatial_fallback": f"""with {PAIRS}, sp as (select img_id, a_idx, b_idx, a_name as head, b_name as tail, case when abs(dx) >= abs(dy) then case when dx > 0 then 'located_left_of' else 'located_right_of' end when dy > 0 then 'located_above' else 'located_below' end as relation from pr),
con as (select distinct img_id, least(lower(head), lower(tail)) as lo, greatest(lower(head), lower(tail)) as hi from sp where (a_idx + b_idx) % 3 = 0),
o as (select *, row_number() over (partition by img_id, least(lower(head), lower(tail)), greatest(lower(head), lower(tail)) order by a_idx, b_idx) as rn from sp s
  where not exists (select 1 from con c where c.img_id = s.img_id and c.lo = least(lower(head), lower(tail)) and c.hi = greatest(lower(head), lower(tail))))
select img_id, a_idx, b_idx, head, relation, tail, 'spatial' as source from o where rn = 1""",
    "triples_by_head": f"""with {CLEAN}, h as (select img_id, head, min(ord) as first_ord, count(*) as n from tri group by img_id, head)
select img_id, head, n, row_number() over (partition by img_id order by first_ord) as place from h""",
    "relation_profile": f"""with {ctes("rel_rows")}, {profiled("rel_rows")} select event_id, slug as relation, {wh("slug", "kind")} as wh_type, question_head, case when not starts_with(question_head, '相关') then question_head end as role_phrase,
  askability, lexicalizability, hideability, generic_penalty, {tools("slug", "kind")} as tool_affordance from p4""",
    "relation_texts": f"""with {ctes("rel_rows")}, p1 as (select *, {SLUG.format("relation")} as slug from rel_rows)
select event_id, {natural("slug", "kind")} as natural_text, {follow("slug", "kind")} as follow_clause, {by_kind("kind", r.ANSWER_PROMPTS, "是什么")} as answer_prompt,
  concat({natural("slug", "kind")}, case kind when 'TIME' then '更早' when 'QUANTITY' then '更高' else '更符合条件' end) as selection_phrase, {value("slug", "kind")} as question_value from p1""",
    "value_bucket": f"with {ctes('rel_rows')} select event_id, {bucket('relation', 'kind')} as bucket from rel_rows",
    "answer_scores": f"""with {ctes("answer_rows")} select event_id, case when answer = '' then -1::double else case when length(answer) >= 6 then 0.3::double else 0 end + case when kind in ('PERSON','ORG') then 0.5::double when kind = 'LOCATION' then 0.2::double else 0 end
  - case when kind = 'LOCATION' and lower(answer) in {in_list(r.GENERIC_PLACES)} then 0.4::double else 0 end - case when kind = 'ORG' and lower(answer) in {in_list(r.GENERIC_ORGS)} then 0.6::double else 0 end end as specificity,
  case when answer = '' then 2::double else case when lower(answer) in {in_list(r.BAD_ANSWERS)} then 2::double else 0 end + case when (kind = 'LOCATION' and lower(answer) in {in_list(r.PENALTY_PLACES)})
  or (kind = 'ORG' and lower(answer) in {in_list(r.GENERIC_ORGS)}) or (kind = 'PERSON' and lower(answer) in {in_list(r.PENALTY_PERSONS)}) then 0.8::double else 0 end end as penalty from (select * replace (trim(answer) as answer) from answer_rows)""",
    "graph_nodes": f"""with {GRAPH} select distinct * from (select img_id, '__full_image__' as key, 'full_image' as ntype from own union all select img_id, region, 'region' from own union all select img_id, entity, 'entity' from own
  union all select img_id, ent, 'entity' from rs union all select img_id, fact_key, 'fact' from rs)""",
    "graph_edges": f"""with {GRAPH} select distinct * from (select img_id, '__full_image__' as src, region as dst, 'observe' as etype from own union all select img_id, region, entity, 'resolve' from own union all select img_id, entity, fact_key, 'retrieve' from re)""",
    "graph_stats": f"""with {GRAPH}, nd as (select distinct img_id, '__full_image__' as key, 'full_image' as t from own union select img_id, region, 'region' from own union select img_id, entity, 'entity' from own union select img_id, ent, 'entity' from rs union select img_id, fact_key, 'fact' from rs),
ed as (select img_id, region as s, '' as d, 'observe' as t from own union select img_id, region, entity, 'resolve' from own union select img_id, entity, fact_key, 'retrieve' from re),
n as (select img_id, count(*) filter (t='full_image') as n_full_image, count(*) filter (t='region') as n_region, count(*) filter (t='entity') as n_entity, count(*) filter (t='fact') as n_fact from nd group by img_id),
e as (select img_id, count(*) filter (t='observe') as e_observe, count(*) filter (t='resolve') as e_resolve, count(*) filter (t='retrieve') as e_retrieve from ed group by img_id)
select n.*, coalesce(e_observe,0) as e_observe, coalesce(e_resolve,0) as e_resolve, coalesce(e_retrieve,0) as e_retrieve from n left join e using (img_id)""",
    "retrieve_edges_ranked": f"with {GRAPH} select img_id, entity, fact_key, place, askability, lexicalizability from rank",
    "comparable_pairs": f"with {COMPARABLE('TIME')} select img_id, a_region, b_region, a_fact_key, b_fact_key, score, bucket from cmp where score > 0",
    "comparable_quantities": f"with {COMPARABLE('QUANTITY')} select img_id, a_region, b_region, a_num - b_num as difference, score from cmp where score > 0 and a_num is not null and b_num is not null",
    "rankable_groups": f"""with {GRAPH}, bk as (select *, {bucket("relation", "'TIME'")} as bucket from bre where tail_type = 'TIME'),
b1 as (select *, row_number() over (partition by img_id, bucket, region order by askability desc, place) as rn from bk where not ends_with(bucket, 'other')),
b2 as (select *, count(*) over (partition by img_id, bucket) as n_regions from b1 where rn = 1) select img_id, bucket, region, fact_key, n_regions from b2 where n_regions >= 3""",
    "shared_fact_strict": f"with {GRAPH}, s as (select distinct img_id, entity, fact_key as target from re) select a.img_id, a.entity as a_entity, b.entity as b_entity, target from s a join s b using (img_id, target) where a.entity < b.entity",
    "shared_fact_by_value": f"with {GRAPH}, s as (select distinct img_id, entity, concat(slug, ':', lower(tail)) as target from re) select a.img_id, a.entity as a_entity, b.entity as b_entity, target from s a join s b using (img_id, target) where a.entity < b.entity",
    "set_merge_compat": f"""with {ctes("rel_rows")}, s as (select distinct event_id // 100 as grp, slug, {cases([(f"slug in {in_list(w)}", str(k)) for k, w in enumerate(r.SET_MERGE_BUCKETS)], "null")} as bucket from (select *, {SLUG.format("relation")} as slug from rel_rows))
select cast(a.grp as bigint) as grp, a.slug as a_slug, b.slug as b_slug, cast(a.bucket as int) as bucket from s a join s b on a.grp = b.grp and a.bucket = b.bucket and a.slug < b.slug""",
    "region_scores": f"""with {GRAPH}, d as (select img_id, entity, count(*) as degree, list(distinct slug) as slugs from re group by img_id, entity),
o as (select o.*, coalesce(degree, 0) as degree, coalesce(slugs, []) as slugs from own o left join d using (img_id, entity))
select img_id, region, degree, confidence*0.3::double + least(degree, 8)*0.15::double + case etype when 'brand' then 0.3::double when 'product' then 0.25::double when 'landmark' then 0.2::double when 'person' then 0.15::double else 0 end
  + case when {any_of("location", r.EDGE_PLACES)} then 0.2::double else 0 end as score,
  concat(case when location = '' then '图中的' when strpos(location, '画面') > 1 then concat(substring(location, strpos(location, '画面')), '的') when strpos(location, '画面') = 0 then concat('画面', location, '的') else concat(location, '的') end,
  {cases([(f"list_has_any(slugs, [{', '.join(map(q, r.SIGNALS['musical']))}])", q("音乐剧海报")), (f"list_has_any(slugs, [{', '.join(map(q, r.SIGNALS['movie']))}])", q("电影海报")), (f"etype = 'brand' and list_has_any(slugs, [{', '.join(map(q, r.SIGNALS['electronics']))}])", q("电子品牌广告牌")), (f"etype = 'brand' and list_has_any(slugs, [{', '.join(map(q, r.SIGNALS['food']))}])", q("餐饮品牌广告牌")), ("etype = 'brand'", q("品牌广告牌")), ("etype = 'landmark'", q("地标建筑")), ("etype = 'person'", q("人物照片")), ("etype = 'text'", q("文字招牌")), ("etype = 'product'", q("广告海报"))], q("标识"))}) as descriptor from o""",
    "k_hop_facts": f"""with {GRAPH}, e as (select img_id, '__full_image__' as src, region as dst from own union select img_id, region, entity from own union select img_id, entity, fact_key from re),
h1 as (select distinct img_id, dst as key, 1 as hop from e where src = '__full_image__'), h2 as (select distinct h.img_id, e.dst as key, 2 as hop from h1 h join e on h.img_id = e.img_id and h.key = e.src),
h3 as (select distinct h.img_id, e.dst as key, 3 as hop from h2 h join e on h.img_id = e.img_id and h.key = e.src)
select img_id, '__full_image__' as key, 0 as hop from (select distinct img_id from own) union all select * from h1 union all select * from h2 union all select * from h3""",
    "graph_context_text": f"""with {CLEAN}, e as (select img_id, string_agg(concat('  - ', name, '  类型=', etype, '  位置=', location, '  bbox=[', x1, ', ', y1, ', ', x2, ', ', y2, ']'), chr(10) order by ord) as names,
  string_agg(concat('  ', name, ': 中心=(', (x1+x2)//2, ',', (y1+y2)//2, ') 尺寸=', x2-x1, '×', y2-y1, ' 面积=', (x2-x1)*(y2-y1), 'px²'), chr(10) order by ord) as details, count(*) as n from kg_ent group by img_id),
t0 as (select *, min(ord) over (partition by img_id, head) as o1 from tri),
t as (select img_id, string_agg(concat('  ', head, ' —[', relation, ']→ ', tail, ' [', tail_type, ']', case when nv_raw = '' or nv_num = 0 then '' else concat(' (', nv_raw, ' ', unit, ')') end), chr(10) order by o1, ord) as facts, count(*) as n from t0 group by img_id)
select e.img_id, concat('【图中实体】', chr(10), names, chr(10), chr(10), '【知识三元组】（共 ', coalesce(t.n, 0), ' 条）', case when facts is null then '' else concat(chr(10), facts) end,
  case when e.n >= 2 then concat(chr(10), chr(10), '【空间细节】', chr(10), details) else '' end, chr(10), chr(10), '图片描述: ', 'picture ', e.img_id) as context from e left join t using (img_id)""",
    "skip_domains": f"with {ctes('page_rows')} select page_id, url from page_rows where url <> '' and not {any_of('url', r.SKIPPED_SITES)}",
    "url_netloc": f"with {ctes('page_rows')} select page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as site, substring(trim(split_part(split_part(title, ' - ', 1), ' | ', 1)), 1, 60) as head from page_rows",
    "deep_read_urls": f"""with {ctes("page_rows")}, f as (select *, row_number() over (partition by topic order by page_id) as nth from page_rows where url <> '' and not {any_of("url", r.SKIPPED_SITES)})
select topic, page_id, nth, substring(html, 1, 2000) as page_text from f where nth <= 2 and coalesce(html, '') <> ''""",
    "both_mentioned": """with n as (select item_id, split_part(text, ' ', 3) as entity_a, split_part(text, ' ', 5) as entity_b from benchmark)
select d.doc_id, n.item_id from documents d, n where entity_a <> '' and entity_b <> '' and contains(lower(d.text), lower(entity_a)) and contains(lower(d.text), lower(entity_b))""",
    "visit_queue": f"""with {ctes("page_rows")}, c as (select topic, page_id, url, case cast(page_id % 4 as int) when 0 then 'image' when 1 then 'web' when 2 then 'discovery' else 'lens' end as origin, page_id % 4 as origin_rank, page_id % 5 as ent from page_rows),
b as (select *, row_number() over (partition by topic, origin, ent order by page_id) as own from c),
f as (select *, row_number() over (partition by topic, origin order by page_id) as nth from b where own <= 2 or origin not in ('image', 'web')), g as (select *, row_number() over (partition by topic order by origin_rank, nth) as place from f
  where nth <= case origin when 'image' then 20 when 'web' then 30 when 'discovery' then 5 else 8 end) select topic, page_id, origin, place from g where place <= 30""",
    "resolution_merge": f"""with {ctes("page_rows")}, e as (select distinct topic from page_rows), t0 as (select *, row_number() over (partition by topic order by page_id) as nth from page_rows where title <> ''),
t as (select topic, list(title order by nth) as titles from t0 where nth <= 5 group by topic), p as (select topic, count(*) as n_pages, string_agg(concat_ws(' | ', url, title, substring(html, 1, 200)), chr(10) order by page_id) as pages from page_rows group by topic)
select e.topic, coalesce(titles, []) as titles, coalesce(n_pages, 0) as n_pages, coalesce(pages, '') as pages from e left join t using (topic) left join p using (topic)""",
    "lens_flatten": f"""with {ctes("page_rows")}, t as (select topic, title, page_id, row_number() over (partition by topic, lower(trim(title)) order by page_id) as rn from page_rows where length(trim(title)) >= 3)
select topic, title, nth from (select *, row_number() over (partition by topic order by page_id) as nth from t where rn = 1) where nth <= 20""",
    "search_rows_flat": """with s as (select page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages)
select page_id, 0 as pos, 'knowledge_graph' as kind, cast(null as varchar) as url, concat('panel ', page_id, ' | about | k: v') as content from s where page_id % 3 = 0
union all select page_id, case when page_id % 3 = 0 then 1 else 0 end, 'answer', null, 'yes no' from s where page_id % 2 = 0
union all select page_id, (case when page_id % 3 = 0 then 1 else 0 end) + (case when page_id % 2 = 0 then 1 else 0 end), 'result', url, null from s""",
    "props_json": f"""with {ctes("json_blobs")} select event_id, props as json from json_blobs join events using (event_id) where event_id % 5 in (0, 1, 2, 4)""",
    "question_classify": f"with {QUESTIONS} select img_id, n_tools, category, difficulty from t2",
    "question_ids": f"with {NUMBERED} select img_id, day, question_id from t3",
    "final_records": f"with {NUMBERED} select concat(day, '_', question_id) as id, day as image_id, concat('images/', day, '.jpg') as image_path, category, question_id from t3",
    "question_stats": f"with {QUESTIONS} select count(*) as total_questions, count(*) filter (category='retrieval') as retrieval, count(*) filter (category='code') as code, count(*) filter (category='hybrid') as hybrid, count(distinct day) as images_with_questions from t2",
    "image_metrics": f"""with {QUESTIONS} select day as img_id, count(*) as n_questions, count(*) filter (category='retrieval') as n_retrieval, count(*) filter (category='code') as n_code, count(*) filter (category='hybrid') as n_hybrid,
  count(*) filter (difficulty='easy') as n_easy, count(*) filter (difficulty='medium') as n_medium, count(*) filter (difficulty='hard') as n_hard from t2 group by day""",
    "question_cube": f"with {QUESTIONS} select category, difficulty, count(*) as n from t2 group by cube (category, difficulty)",
    "run_summary": f"""with {ctes("run_rows")} select count(*) as images, count(*) filter (status='ok') as succeeded, count(*) filter (status<>'ok') as failed, cast(sum(n_questions) filter (status='ok') as bigint) as questions,
  avg(step1_sec) filter (status='ok') as mean_step1, avg(step2_sec) filter (status='ok') as mean_step2 from run_rows""",
    "cache_key": """select page_id, substring(sha256(concat('{"_t": "jina", "max_chars": 2000, "url": "', url, '"}')), 1, 16) as key from pages""",
    "cache_misses": """select distinct substring(sha256(concat('{"_t": "jina", "max_chars": 2000, "url": "', url, '"}')), 1, 16) as key, url as payload from pages where page_id % 2 = 1 and url not in (select url from pages where page_id % 2 = 0)""",
    "sampled_per_group": "select topic, url from (select cast(floor(page_id / 25) as bigint) as topic, url, row_number() over (partition by floor(page_id / 25) order by url, page_id) as rn from pages) where rn <= 3",
    "pair_plan_queries": f"""with {PAIRS}, pl as (select *, (a_idx + b_idx) % 4 as m from pr) select img_id, a_name, b_name, u.pos as pos, u.query as query from pl, lateral (
  select 0 as pos, case when m = 1 then concat('first ', a_name) else concat(a_name, ' ', b_name) end as query where m <> 2 union all select 1, concat('second ', b_name) where m = 1) u""",
    "discovered_names": f"""with {KEPT}, f as (select img_id, ord as pos, case when ord % 3 = 0 then concat(' 《new ', name, '》 ') when ord % 3 = 1 then name else 'x' end as given from geo_raw),
c as (select img_id, pos, trim(trim(given), '《》"''') as name from f), d as (select *, row_number() over (partition by img_id, lower(name) order by pos) as rn from c where length(name) between 2 and 60
  and not exists (select 1 from kid k where k.img_id = c.img_id and lower(trim(k.name)) = lower(c.name)))
select img_id, pos, name, concat('DE', row_number() over (partition by img_id order by pos)) as id from d where rn = 1""",
    "promoted_seeds": f"""with {SEEDS} select img_id, id, name from seeds where (case cast(idx % 3 as int) when 0 then 'proposal' when 1 then 'vlm_only' else '' end) in ('vlm_only', '') or lower(level) = 'high'""",
    "search_routes": f"with {KEPT} select img_id, id, name, case when etype in ('person', 'landmark', 'product') then 'image' else 'web' end as route from kid",
    "reverse_search_views": f"""with {KEPT} select img_id, id, 'pad20' as view, greatest(0, x1-cast(trunc((x2-x1)*0.2::double) as bigint)) as x1, greatest(0, y1-cast(trunc((y2-y1)*0.2::double) as bigint)) as y1,
  least(w, x2+cast(trunc((x2-x1)*0.2::double) as bigint)) as x2, least(h, y2+cast(trunc((y2-y1)*0.2::double) as bigint)) as y2 from kid where etype in ('person', 'landmark', 'product')""",
    "image_search_rows": """select page_id, 0 as pos, concat('picture ', page_id) as title, coalesce(url, '') as image_url, case when page_id % 2 = 0 then url else '' end as source_url, 'site' as source_domain from pages
union all select page_id, 1, '', '', 'second', '' from pages where page_id % 3 = 0""",
    "tail_queries": f"""with {ctes("kg_triples_raw")}, t as (select img_id, ord, trim(tail) as name, tail, case cast(ord % 4 as int) when 0 then upper(tail) when 1 then concat(tail, ' history') when 2 then '' else 'other' end as rewritten from kg_triples_raw where ord % 7 <> 0)
select img_id, ord, tail, 0 as pos, name as query, 'text_exact' as origin from t where name <> '' union all
select img_id, ord, tail, case when name <> '' then 1 else 0 end, rewritten, 'text_rewrite' from t where rewritten <> '' and lower(rewritten) <> lower(name)""",
    "known_names_text": f"""with {CLEAN}, e as (select distinct img_id, name from (select img_id, head as name from tri union all select img_id, tail from tri) where name is not null)
select img_id, string_agg(name, ', ' order by name) as names from e group by img_id""",
    "job_totals": f"with {ctes('geo_raw', 'kg_triples_raw')} select (select count(*) from geo_raw) as entities, (select count(distinct img_id) from geo_raw) as images, (select count(*) from kg_triples_raw) as triples, (select count(*) from pages) as searches",
    "visit_queue_faithful": f"""with {ctes("page_rows")}, c as (select topic, page_id, url, case when page_id % 10 < 4 then 'image' when page_id % 10 < 8 then 'web' when page_id % 10 = 8 then 'discovery' else 'lens' end as origin,
  case when page_id % 10 < 4 then 0 when page_id % 10 < 8 then 1 when page_id % 10 = 8 then 2 else 3 end as origin_rank, page_id % 4 as part, floor(page_id % 200 / 12) as ent from (select * replace (cast(floor(page_id/200) as bigint) as topic) from page_rows)),
b as (select *, row_number() over (partition by topic, origin, ent order by page_id) as own from c), k as (select * from b where own <= 2 or origin_rank > 1),
e as (select topic, origin, ent, count(*) as n, min(page_id) as start from k group by all), s as (select *, sum(n) over (partition by topic, origin order by start) - n as before from e),
j as (select k.*, s.before from k join s on k.topic = s.topic and k.origin = s.origin and k.ent = s.ent),
i as (select * from j where origin = 'image' and (own = 1 or before + own <= 20)), h as (select topic, count(*) as held from i group by topic),
w as (select j.* from j left join h on j.topic = h.topic where origin = 'web' and (own = 1 or coalesce(held, 0) + before + own <= 30)),
x as (select * exclude (nth) from (select *, row_number() over (partition by topic, origin order by page_id) as nth from j where origin_rank > 1) where nth <= case origin when 'discovery' then 5 else 8 end),
f as (select *, row_number() over (partition by topic, origin order by page_id) as nth from (select * from i union all select * from w union all select * from x))
select topic, page_id, origin, row_number() over (partition by topic order by origin_rank, nth) as place from f""",
    "aliases_closed": f"""with recursive {ctes("alias_links")}, way as (
  select img_id, alias, canonical as name, 1 as step from alias_links union all
  select w.img_id, w.alias, l.canonical, step + 1 from way w join alias_links l on l.img_id = w.img_id and l.alias = w.name where step < 24)
select * from (select img_id, alias, coalesce(max(name) filter (not exists (select 1 from alias_links l where l.img_id = way.img_id and l.alias = way.name)), min(name) filter (step > 9)) as canonical from way group by img_id, alias) where alias <> canonical""",
    "enrich_outcomes": f"""with {KEPT}, i as (select distinct img_id, cast(substring(img_id, 5) as bigint) as k from geo_raw), n as (select img_id, count(*) as n from kid group by img_id)
select i.img_id, 'enrich' as stage, case when k % 13 = 4 then 'error' when k % 7 = 0 then 'waiting' when k % 7 = 1 or k % 11 = 5 then 'error' when coalesce(n, 0) < 7 then 'skip' when k % 7 = 2 then 'waiting' else 'ok' end as status,
  case when k % 13 = 4 then 'unreadable image' when k % 7 = 0 then 'not called' when k % 7 = 1 then 'detect: TimeoutError' when k % 11 = 5 then 'detect: json_parse_failed' when coalesce(n, 0) < 7 then 'too few entities'
    when k % 7 = 2 then 'requests not called' else '' end as reason, case when k % 13 = 4 or k % 7 < 2 or k % 11 = 5 then null when coalesce(n, 0) < 7 then coalesce(n, 0) when k % 7 = 2 then null else n end as n_entities
from i left join n using (img_id)""",
    "unfinished_images": f"""with {ctes("tries")}, s as (select img_id, max(case when status in ('ok', 'skip') then 1 else 0 end) as done, count(*) filter (status = 'error') as failed from tries where stage = 'enrich' group by img_id)
select concat('img_', c_custkey) as img_id from customer where concat('img_', c_custkey) not in (select img_id from s where done = 1 or failed >= 3)""",
    "image_results": f"""with {ctes("tries")}, l as (select * from (select *, row_number() over (partition by img_id, stage order by run desc) as rn from tries) where rn = 1), a as (select * from l where stage = 'enrich'), b as (select * from l where stage = 'questions')
select coalesce(a.img_id, b.img_id) as img_id, case when a.status <> 'ok' then concat('step1_', a.status) when b.status is null then 'step2_waiting' when b.status <> 'ok' then concat('step2_', b.status) else 'ok' end as status,
  case when a.status <> 'ok' then concat('step1: ', a.reason) when b.status <> 'ok' then concat('step2: ', b.reason) end as error, a.n_entities, a.n_triples, b.n_questions, a.seconds as step1_sec, b.seconds as step2_sec
from a full join b on a.img_id = b.img_id""",
    "outcome_counts": f"""with {ctes("tries")} select stage, status, reason, count(*) as images from (select *, row_number() over (partition by img_id, stage order by run desc) as rn from tries) where rn = 1 group by all""",
    "bench_summary": """select count(*) as total_images, count(*) filter (o_orderstatus <> 'F') as success, count(*) filter (o_orderstatus = 'F') as failed, count(distinct o_orderpriority) as folders,
  cast(coalesce(sum(o_orderkey % 10) filter (o_orderstatus <> 'F'), 0) as bigint) as total_questions from orders""",
    "bench_rows": """select folder, o_orderkey as img_id, status, row_number() over (order by folder, o_orderkey) as place from (select o_orderpriority as folder, o_orderkey, case when o_orderstatus = 'F' then 'step1_error' else 'ok' end as status,
  row_number() over (partition by o_orderpriority, o_custkey order by o_orderkey) as rn from orders) where rn <= 3""",
    "attempt_trace": """select event_id, cast(attempt as int) as attempt, case when attempt < 1 + event_id % 3 then case when event_id % 2 = 0 then 'json_parse_failed' else 'call_error' end else 'ok' end as status,
  case when attempt < 1 + event_id % 3 and event_id % 2 = 1 then concat('E', attempt) end as error from events, lateral (select unnest(range(1, 2 + event_id % 3)) as attempt)""",
    "good_images": """select * from (select l_orderkey * 10 + l_linenumber as img_id, l_partkey % 6 as a, l_suppkey % 6 as b, l_linenumber % 6 as c, cast(l_quantity as bigint) % 6 as d from lineitem) where a + b + c + d >= 14 and a >= 3 and b >= 3 and c >= 3 and d >= 3""",
    "sound_boxes": f"""with {KEPT.replace("(select * replace (trim(name) as name) from geo_raw)", "(select * replace (trim(name) as name, case when (rx1 + ord) % 7 = 0 then rx1 % 50 + 980 else rx1 end as rx1, case when (rx1 + ord) % 7 = 0 then rx2 % 50 + 1000 else rx2 end as rx2) from geo_raw)")}
select img_id, ord, x1 >= 0 and y1 >= 0 and x2 > x1 and y2 > y1 and x2 <= w and y2 <= h as sound_box from kid""",
    "bounded_sizes": f"""with {ctes("geo_raw")} select img_id, ord, cast(trunc(case when greatest(w, h) * 3 > 2048 then w * 3 * 2048 / (greatest(w, h) * 3)::double else w * 3 end) as bigint) as width,
  cast(trunc(case when greatest(w, h) * 3 > 2048 then h * 3 * 2048 / (greatest(w, h) * 3)::double else h * 3 end) as bigint) as height from geo_raw""",
    "parsed_questions": """select event_id as img_id, pos as ord, case when pos = 0 then concat('What of ', event_id, '?') else 'And?' end as question, case when pos = 0 then event_type end as answer
from events, lateral (select unnest([0, 2]) as pos) where not (event_id % 4 = 3) and not (event_id % 4 = 1 and pos = 2)""",
    "images_with_enough": f"with {KEPT}, n as (select img_id, count(*) as n from kid group by img_id) select img_id, id, name from kid join n using (img_id) where n >= 7",
    "entity_lines": f"""with {KEPT}, t as (select *, case when cast(idx % 3 as int) = 0 then ' [图搜验证: one, two] [来源页: see]' when cast(idx % 3 as int) = 1 then ' [图搜验证: one]' else '' end as more from kid)
select img_id, string_agg(concat('- ', id, ': ', name, ' (类型=', etype, ', 位置=here)', more), chr(10) order by ord) as lines from t group by img_id""",
    "answered_triples": f"with {CLEAN} select img_id, row_number() over (partition by img_id order by ord) - 1 as ord, head, relation, tail, tail_type, nv_raw, unit from tri where cast(substring(img_id, 5) as bigint) % 4 < 3",
    "detected_boxes": f"with {ctes('geo_raw')} select img_id, ord, name, etype, rx1, ry1, rx2, ry2 from geo_raw where ord % 5 <> 2",
    "entity_documents": f"""with {PAIRS}, s0 as (select *, row_number() over (partition by img_id order by confidence desc, idx) as rank from kid),
c as (select * from (select *, row_number() over (partition by img_id, lower(trim(name)) order by rank) as cn from s0 where confidence >= 0.8 or lower(level) = 'high') where cn = 1),
f as (select * from (select *, row_number() over (partition by img_id order by idx) as fn from s0 where img_id not in (select img_id from c)) where fn <= 5),
an as (select img_id, rank, id from c union all select img_id, rank, id from f), a as (select img_id, count(*) as n_anchors, min_by(id, rank) as first_anchor from an group by img_id),
e as (select img_id, count(*) as n_entities, min_by(name, ord) as first_name, max_by(id, area * 1000 - idx) as largest, min_by(id, area * 1000 - idx) as smallest from kid group by img_id),
t as (select img_id, count(*) as n, min_by(b_name, a_idx * 100 + b_idx) as first_tail from pr group by img_id)
select e.img_id, n_entities, n_anchors, coalesce(n, 0) as n_triples, first_name, first_anchor, first_tail, largest, smallest, coalesce(n, 0) as n_layout from e join a using (img_id) left join t using (img_id)""",
    "question_documents": f"with {NUMBERED} select day as img_id, concat('images/', day, '.jpg') as img_path, count(*) as n, string_agg(question_id, ',' order by question_id) as ids from t3 group by day",
    "records_of_documents": f"with {NUMBERED} select concat(day, '_', question_id) as id, day as image_id, concat('images/', day, '.jpg') as image_path, category, question_id, img_id as question, 'a' as answer from t3",
    "expansion_rounds": f"""with {CLEAN}, base as (select img_id, ord, head, relation, tail from tri),
known0 as (select img_id, name from kg_ent),
live0 as (select * from base where img_id in (select img_id from base group by img_id having count(*) < 52)),
top0 as (select img_id, tail, rank from (select *, row_number() over (partition by img_id order by n desc, first_ord) as rank from (
  select img_id, trim(tail) as tail, count(*) as n, min(ord) as first_ord from live0 l where length(trim(tail)) >= 3 and not exists (select 1 from known0 x where x.img_id = l.img_id and lower(x.name) = lower(trim(l.tail))) group by img_id, trim(tail))) where rank <= 6),
new0 as (select img_id, rank * 2 as o, tail as head, 'leads_to' as relation, tail || ' next' as tail from top0),
put0 as (select n.img_id, m.last + row_number() over (partition by n.img_id order by o) - 1 as ord, head, relation, tail from new0 n join (select img_id, max(ord) + 1 as last from base group by img_id) m on m.img_id = n.img_id
  where not exists (select 1 from base s where s.img_id = n.img_id and lower(s.head) = lower(n.head) and lower(s.relation) = lower(n.relation) and lower(s.tail) = lower(n.tail))),
round0 as (select img_id, ord, head, relation, tail from base union all select * from put0),
known1 as (select img_id, tail as name from top0),
live1 as (select * from round0 where img_id in (select img_id from round0 group by img_id having count(*) < 52)),
top1 as (select img_id, tail, rank from (select *, row_number() over (partition by img_id order by n desc, first_ord) as rank from (
  select img_id, trim(tail) as tail, count(*) as n, min(ord) as first_ord from live1 l where length(trim(tail)) >= 3 and not exists (select 1 from known1 x where x.img_id = l.img_id and lower(x.name) = lower(trim(l.tail))) group by img_id, trim(tail))) where rank <= 6),
new1 as (select img_id, rank * 2 as o, tail as head, 'leads_to' as relation, tail || ' next' as tail from top1),
put1 as (select n.img_id, m.last + row_number() over (partition by n.img_id order by o) - 1 as ord, head, relation, tail from new1 n join (select img_id, max(ord) + 1 as last from round0 group by img_id) m on m.img_id = n.img_id
  where not exists (select 1 from round0 s where s.img_id = n.img_id and lower(s.head) = lower(n.head) and lower(s.relation) = lower(n.relation) and lower(s.tail) = lower(n.tail))),
round1 as (select img_id, ord, head, relation, tail from round0 union all select * from put1)
select * from round1""",
    "plainly_worded": f"""with {ctes("rel_rows")}, p as (select event_id, {SLUG.format("relation")} as slug, kind from rel_rows), c as (select event_id, {follow("slug", "kind")} as clause from p),
a as (select event_id, case when event_id % 3 = 0 then clause || [{", ".join(map(q, r.GRAPH_WORDING))}][event_id % 6 + 1] else clause end as question from c)
select event_id, question from a where not {any_of("question", r.GRAPH_WORDING)}""",
}
