"""Relation semantics: one definition of every rule table, and the column expressions built from them.

The tables hold fixed values. Rules apply in the order given; the first that matches decides.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenkg.functions.strings import relation_tokens, slug, trimmed

# --- fixed values -------------------------------------------------------------------------------------------------
BAD_ANSWERS = ("true", "false", "yes", "no", "none", "n/a", "unknown", "various", "multiple")
LOW_VALUE_RELATIONS = ("related_to", "associated_with", "connected_to", "located_left_of", "located_right_of", "located_above", "located_below")
#: Wording of the graph that a question shouldn't use.
GRAPH_WORDING = ("对应的", "所对应的", "实体", "对象", "相关信息", "组织或机构是什么")
STRONG_RELATIONS = (
    "founded_by", "founder", "ceo", "music_by", "book_and_lyrics_by", "features_songs_by", "director", "author", "writer", "lyrics",
    "headquartered_in", "performed_at", "premiered_at", "opened_at", "incorporated_as", "originally_named", "born_in", "born_on",
    "died_in", "died_on", "has_theaters_count", "revenue", "population",
)
TIME_BUCKETS = (
    (("founded", "established", "formed", "opened", "started"), "time_origin"),
    (("released", "premiered", "debut", "published", "aired", "launched"), "time_release"),
    (("closed", "ended", "ceased", "cancelled", "retired"), "time_end"),
    (("born", "birth"), "time_birth"),
    (("died", "death"), "time_death"),
)
QUANTITY_BUCKETS = (
    (("revenue", "sales", "gross", "income", "earnings", "budget"), "quantity_money"),
    (("population", "employees", "staff", "people", "attendance"), "quantity_people"),
    (("area", "size", "length", "distance", "height", "weight", "mass"), "quantity_measure"),
    (("price", "cost", "fee", "valuation"), "quantity_price"),
)
#: (substrings of the slug, whole tokens of the slug, label, label for TIME if it differs)
NATURAL_TEXTS = (
    (("performed_at", "staged_at", "played_at"), (), "演出地点", None),
    (("premiered_at", "opened_at"), (), "首演地点", None),
    (("headquartered_in", "headquartered_at"), ("headquartered",), "总部所在地", None),
    (("located_in", "located_at"), (), "所在地点", None),
    (("founded_by",), ("founder",), "创始人", None),
    ((), ("ceo",), "首席执行官", None),
    (("owned_by",), ("owner",), "所有者", None),
    (("brand_of",), ("parent", "subsidiary"), "上级组织", None),
    ((), ("author", "writer"), "作者", None),
    ((), ("lyrics",), "作词者", None),
    (("book_and_lyrics_by",), (), "编剧和作词者", None),
    (("music_by",), ("composer",), "作曲者", None),
    (("features_songs_by",), (), "歌曲创作组合", None),
    (("directed_by",), ("director",), "导演", None),
    (("has_theaters_count",), (), "剧院数量", None),
    ((), ("revenue", "sales", "gross", "income", "earnings"), "营收", None),
    ((), ("population", "employees", "staff", "attendance"), "人数", None),
    ((), ("area", "size", "length", "distance", "height", "weight", "mass"), "数值规模", None),
    ((), ("price", "cost", "fee", "valuation"), "价格", None),
    (("originally_named",), ("incorporated", "renamed"), "后续名称", None),
    ((), ("country", "city", "state"), "所属地点", None),
    ((), ("born", "birth"), "出生地", "出生时间"),
    ((), ("died", "death"), "去世地", "去世时间"),
    ((), ("closed", "ended", "ceased", "cancelled", "retired"), "结束时间", None),
    ((), ("premiered", "premiere", "debut"), "首演时间", None),
    ((), ("released", "published", "aired", "launched"), "发布时间", None),
    ((), ("founded", "established", "formed", "opened", "started"), "成立时间", None),
)
WHERE_RELATIONS = ("headquartered", "performed_at", "premiered_at", "opened_at", "located_in", "based_in", "born_in", "died_in")
IMAGE_RELATIONS = ("logo", "landmark", "person", "celebrity")
QUESTION_VALUES = (
    (("founder", "founded_by", "ceo", "music_by", "book_and_lyrics_by", "features_songs_by", "director", "author", "writer", "lyrics"), 1.2),
    (("incorporated", "renamed", "originally_named"), 1.0),
    (("performed_at", "premiered_at", "opened_at", "headquartered"), 0.7),
    (("located_in", "located_at", "has_theaters_count"), 0.25),
    (("related_to", "associated_with", "connected_to"), -1.0),
)
ANSWER_PROMPTS = {"PERSON": "是谁", "ORG": "是什么组织或机构", "LOCATION": "是哪里", "TIME": "是什么时间", "QUANTITY": "是多少"}
VAGUE_PROMPTS = {"PERSON": "相关人物是谁", "ORG": "隶属于哪个机构", "LOCATION": "位于哪里", "TIME": "是什么时候", "QUANTITY": "是多少"}
#: (substrings of the slug, clause, clause for LOCATION if it differs)
FOLLOW_CLAUSES = (
    (("incorporated", "renamed", "originally_named"), "后来合并注册为什么公司名称", None),
    (("performed_at", "staged_at", "played_at"), "演出地点是哪里", None),
    (("premiered_at", "opened_at"), "首演地点是哪里", None),
    (("headquartered", "based_in"), "总部设在哪里", None),
    (("located_in", "located_at"), "位于哪里", None),
    (("founder", "founded_by"), "创始人是谁", None),
    (("ceo",), "首席执行官是谁", None),
    (("book_and_lyrics_by",), "编剧和作词者是谁", None),
    (("author", "writer"), "作者是谁", None),
    (("lyrics",), "作词者是谁", None),
    (("composer", "music_by"), "作曲者是谁", None),
    (("features_songs_by",), "歌曲出自哪个组合", None),
    (("director", "directed_by"), "导演是谁", None),
    (("has_theaters_count",), "拥有多少家剧院", None),
    (("founded", "established", "formed", "opened", "started"), "成立于哪一年", None),
    (("premiered", "premiere", "debut"), "首演时间是什么时候", None),
    (("released", "published", "aired", "launched"), "发布时间是什么时候", None),
    (("born", "birth"), "出生时间是什么时候", "出生地是哪里"),
    (("died", "death"), "去世时间是什么时候", "去世地是哪里"),
    (("revenue", "sales", "gross", "income", "earnings"), "营收是多少", None),
    (("population", "employees", "staff", "attendance"), "人数是多少", None),
    (("area", "size", "length", "distance", "height", "weight", "mass"), "具体数值是多少", None),
    (("price", "cost", "fee", "valuation"), "价格是多少", None),
)
GENERIC_PLACES = ("new york city", "united states", "usa", "china", "japan")
GENERIC_ORGS = ("organization", "company", "group")
PENALTY_PLACES = ("united states", "usa", "china", "japan", "europe", "asia")
PENALTY_PERSONS = ("founder", "author", "ceo")
SET_MERGE_BUCKETS = (
    ("born_in", "birthplace", "from", "hometown", "origin", "birth_city"),
    ("headquartered_in", "based_in", "located_in", "hq", "headquarters"),
    ("plays_for", "plays for", "played_for", "played for", "member_of", "signed_with"),
    ("competes_in", "plays_in", "part_of", "league"),
    ("sponsored_by", "partner_of", "endorses", "endorsed_by"),
    ("occupation", "profession", "role", "position"),
    ("nationality", "citizen_of", "country"),
)
TYPE_SCORES = {"brand": 0.3, "product": 0.25, "landmark": 0.2, "person": 0.15}
EDGE_PLACES = ("偏左", "偏右", "最左", "最右", "上方", "下方", "顶部", "底部")
SIGNALS = {
    "musical": ("performed_at", "music_by", "book_and_lyrics_by", "broadway_premiere_date", "choreographed_by"),
    "movie": ("directed_by", "starring", "produced_by", "box_office", "release_date"),
    "food": ("first_restaurant_opened", "global_systemwide_sales", "menu_item", "restaurant_count"),
    "electronics": ("stock_exchange", "listed_on", "invented", "manufactures"),
}
DOMAINS = (
    ("food", ("burger", "pizza", "sandwich", "hot dog", "donut", "apple", "banana", "cake")),
    ("sports", ("football", "basketball", "tennis", "baseball", "skateboard", "surfboard")),
    ("electronics", ("computer", "laptop", "phone", "keyboard", "monitor", "mouse", "tv")),
    ("retail", ("store", "shop", "cashier", "shelf", "product", "cart")),
    ("geography", ("map", "street", "road", "building", "bridge", "tower")),
)
#: What a region looks like, by the signals of its entity's relations and by its type, and how its place is put.
SIGNAL_LOOKS = (("musical", False, "音乐剧海报"), ("movie", False, "电影海报"), ("electronics", True, "电子品牌广告牌"), ("food", True, "餐饮品牌广告牌"))  # (signal, brands only, look)
TYPE_LOOKS = (("brand", "品牌广告牌"), ("landmark", "地标建筑"), ("person", "人物照片"), ("text", "文字招牌"), ("product", "广告海报"))
OTHER_LOOK, PICTURE, IN_PICTURE, OF = "标识", "画面", "图中的", "的"
CODE_TOOLS = ("code_interpreter", "point", "insertimage", "draw2dpath", "detectblackarea", "astar")
SEARCH_TOOLS = ("web_search", "image_search", "visit", "crop", "ocr")
GENERIC_OBJECTS = ("car", "person", "building", "tree", "sign", "door", "window", "wall", "floor", "sky")
PICTURED_TYPES = ("person", "landmark", "product")
SEARCHED_TYPES = ("brand", "product", "landmark", "person")
SKIPPED_SITES = ("youtube.com", "facebook.com", "instagram.com", "twitter.com", "tiktok.com", "basketball-reference.com", "forbes.com")
# ------------------------------------------------------------------------------------------------------------------


def contains_any(c: Column, words) -> Column:
    """Does the text contain one of the words? One pattern for all: a chain of tests would make plans large."""
    return c.rlike("|".join(map(re.escape, words))) if words else F.lit(False)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first(cases, default: Column) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def value_bucket(relation: Column, kind: Column) -> Column:
    """Bucket of a TIME or QUANTITY relation, by substrings of the relation as it is written."""
    rel = F.coalesce(relation, F.lit(""))
    time = _first([(contains_any(rel, w), F.lit(b)) for w, b in TIME_BUCKETS], F.lit("time_other"))
    quantity = _first([(contains_any(rel, w), F.lit(b)) for w, b in QUANTITY_BUCKETS], F.lit("quantity_other"))
    return F.when(kind == "TIME", time).when(kind == "QUANTITY", quantity).otherwise("other")


def relations_compatible(a: Column, b: Column, kind: Column) -> Column:
    """struct(ok, score, label): may two values be compared?"""
    generic = F.when(kind == "TIME", "time_attribute").otherwise("quantity_attribute")
    bucket = value_bucket(a, kind)
    same = (bucket == value_bucket(b, kind)) & ~bucket.endswith("other")
    overlap = F.arrays_overlap(relation_tokens(a), relation_tokens(b))

    def verdict(ok: bool, score: float, label: Column) -> Column:
        return F.struct(F.lit(ok).alias("ok"), F.lit(score).alias("score"), label.alias("label"))

    blank = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    return (
        F.when(blank, verdict(False, 0.0, generic))
        .when(a == b, verdict(True, 1.0, a))
        .when(same, verdict(True, 0.6, generic))
        .when(overlap, verdict(True, 0.3, generic))
        .otherwise(verdict(False, 0.0, F.lit("")))
    )


def natural_text(rel: Column, kind: Column) -> Column:
    """Readable name of a relation slug; unknown slugs with spaces for underscores."""
    tokens = relation_tokens(rel)
    cases = [(rel == "", F.lit("相关属性"))]
    for phrases, words, label, time_label in NATURAL_TEXTS:
        test = contains_any(rel, phrases)
        if words:
            test = test | F.arrays_overlap(tokens, F.array(*map(F.lit, words)))
        cases.append((test, F.lit(label) if time_label is None else F.when(kind == "TIME", time_label).otherwise(label)))
    return _first(cases, F.replace(rel, F.lit("_"), F.lit(" ")))


def wh_type(rel: Column, kind: Column) -> Column:
    place = F.when(contains_any(rel, WHERE_RELATIONS), "where").otherwise("which_place")
    return _first(
        [(kind == "PERSON", F.lit("who")), (kind == "TIME", F.lit("when")), (kind == "QUANTITY", F.lit("how_many")), (kind == "LOCATION", place), (kind == "ORG", F.lit("which_org"))],
        F.lit("what"),
    )


def tools_for(rel: Column, kind: Column) -> Column:
    code = F.when(kind.isin("TIME", "QUANTITY"), F.array(F.lit("code_interpreter"))).otherwise(F.expr("cast(array() as array<string>)"))
    image = F.when(contains_any(rel, IMAGE_RELATIONS), F.array(F.lit("image_search"))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.concat(code, image, F.array(F.lit("web_search")))


def question_value(rel: Column, kind: Column) -> Column:
    parts = [F.when(contains_any(rel, w), v).otherwise(0.0) for w, v in QUESTION_VALUES]
    return sum(parts[1:], parts[0]) + F.when(kind.isin("PERSON", "ORG"), 0.4).otherwise(0.0)


def _clamped(c: Column, high: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(high), c))


def relation_profile(relation: Column, kind: Column) -> Column:
    """struct of nine fields that say how well a relation can be asked about."""
    return _let(slug(relation), lambda rel: _let(natural_text(rel, kind), lambda text: _let(_base(rel, text), lambda base: _profile(rel, kind, text, base))))


def _base(rel: Column, text: Column) -> Column:
    """How well a relation can be put in words: known names, short ones, the rest."""
    plain, vague = text == F.replace(rel, F.lit("_"), F.lit(" ")), text.startswith("相关")
    short = F.size(F.split(rel, "_")) <= 3
    return F.when(~plain & ~vague, 0.85).when(plain & short, 0.65).otherwise(0.2)


def _profile(rel: Column, kind: Column, text: Column, base: Column) -> Column:
    vague = text.startswith("相关")
    sure, strong, weak, other = base >= 0.6, rel.isin(*STRONG_RELATIONS), rel.isin(*LOW_VALUE_RELATIONS), kind == "OTHER"
    bonus = lambda test, v: F.when(test, v).otherwise(0.0)
    ask = 0.7 + F.greatest(F.lit(0.0), question_value(rel, kind)) * 0.25 + bonus(strong, 0.35) - bonus(weak, 1.0) - bonus(other, 0.3)
    lex = base + bonus(strong, 0.25) - bonus(weak, 0.5) - bonus(other, 0.2)
    hide = F.when(sure, 0.8).otherwise(0.2) + bonus(strong, 0.15)
    penalty = F.when(sure, 0.0).otherwise(0.9) + bonus(weak, 1.2)
    return F.struct(
        rel.alias("relation"), wh_type(rel, kind).alias("wh_type"), text.alias("question_head"), F.when(~vague, text).alias("role_phrase"),
        _clamped(ask, 2.0).alias("askability"), _clamped(lex, 1.5).alias("lexicalizability"), _clamped(hide, 1.5).alias("hideability"),
        F.greatest(F.lit(0.0), penalty).alias("generic_penalty"), tools_for(rel, kind).alias("tool_affordance"),
    )


def _by_kind(kind: Column, table: dict, default: str) -> Column:
    return _first([(kind == k, F.lit(v)) for k, v in table.items()], F.lit(default))


def answer_prompt(kind: Column) -> Column:
    return _by_kind(kind, ANSWER_PROMPTS, "是什么")


def follow_clause(rel: Column, kind: Column) -> Column:
    text = natural_text(rel, kind)
    vague = _by_kind(kind, VAGUE_PROMPTS, "答案是什么")
    cases = [(contains_any(rel, w), F.lit(c) if place is None else F.when(kind == "LOCATION", place).otherwise(c)) for w, c, place in FOLLOW_CLAUSES]
    return _first(cases, F.when(text.startswith("相关"), vague).otherwise(F.concat(text, answer_prompt(kind))))


def selection_phrase(rel: Column, kind: Column) -> Column:
    return F.concat(natural_text(rel, kind), F.when(kind == "TIME", "更早").when(kind == "QUANTITY", "更高").otherwise("更符合条件"))


def answer_specificity(answer: Column, kind: Column) -> Column:
    """-1 for blanks; longer answers, people and organisations score more, generic places and organisations less."""
    answer = trimmed(answer)
    low = F.lower(answer)
    score = (
        F.when(F.length(answer) >= 6, 0.3).otherwise(0.0)
        + F.when(kind.isin("PERSON", "ORG"), 0.5).when(kind == "LOCATION", 0.2).otherwise(0.0)
        - F.when((kind == "LOCATION") & low.isin(*GENERIC_PLACES), 0.4).otherwise(0.0)
        - F.when((kind == "ORG") & low.isin(*GENERIC_ORGS), 0.6).otherwise(0.0)
    )
    return F.when(F.coalesce(answer, F.lit("")) == "", -1.0).otherwise(score)


def answer_penalty(answer: Column, kind: Column) -> Column:
    answer = trimmed(answer)
    low = F.lower(answer)
    generic = ((kind == "LOCATION") & low.isin(*PENALTY_PLACES)) | ((kind == "ORG") & low.isin(*GENERIC_ORGS)) | ((kind == "PERSON") & low.isin(*PENALTY_PERSONS))
    score = F.when(low.isin(*BAD_ANSWERS), 2.0).otherwise(0.0) + F.when(generic, 0.8).otherwise(0.0)
    return F.when(F.coalesce(answer, F.lit("")) == "", 2.0).otherwise(score)


def set_merge_bucket(rel: Column) -> Column:
    """Number of the synonym bucket of a relation, or null."""
    low = F.lower(rel)
    return _first([(low.isin(*words), F.lit(k)) for k, words in enumerate(SET_MERGE_BUCKETS)], F.lit(None).cast("int"))


def domain_of(names: Column) -> Column:
    """Domain guessed from all names of an image joined by spaces; substrings count."""
    low = F.lower(names)
    return _first([(contains_any(low, words), F.lit(d)) for d, words in DOMAINS], F.lit("other"))


def region_score(confidence: Column, degree: Column, kind: Column, location: Column) -> Column:
    by_type = _first([(kind == k, F.lit(v)) for k, v in TYPE_SCORES.items()], F.lit(0.0))
    edge = F.when(contains_any(F.coalesce(location, F.lit("")), EDGE_PLACES), 0.2).otherwise(0.0)
    return confidence * 0.3 + F.least(degree, F.lit(8)) * 0.15 + by_type + edge


def visual_descriptor(kind: Column, slugs: Column, location: Column) -> Column:
    """What a region looks like and where it is, from its type and its entity's relations."""
    has = lambda signal: F.arrays_overlap(slugs, F.array(*map(F.lit, SIGNALS[signal])))
    told = [(has(signal) & (kind == "brand") if brands else has(signal), F.lit(look)) for signal, brands, look in SIGNAL_LOOKS]
    what = _first([*told, *[(kind == k, F.lit(look)) for k, look in TYPE_LOOKS]], F.lit(OTHER_LOOK))
    loc = F.coalesce(location, F.lit(""))
    at = F.instr(loc, PICTURE)
    placed = F.when(at > 1, F.substr(loc, at)).when(at == 0, F.concat(F.lit(PICTURE), loc)).otherwise(loc)
    return F.when(loc == "", F.concat(F.lit(IN_PICTURE), what)).otherwise(F.concat(placed, F.lit(OF), what))


def question_category(tools: Column) -> Column:
    names = F.transform(tools, lambda t: F.lower(trimmed(t)))
    code = F.arrays_overlap(names, F.array(*map(F.lit, CODE_TOOLS)))
    search = F.arrays_overlap(names, F.array(*map(F.lit, SEARCH_TOOLS)))
    return F.when(code & search, "hybrid").when(code, "code").otherwise("retrieval")


def question_difficulty(tools: Column) -> Column:
    return F.when(F.size(tools) >= 5, "hard").when(F.size(tools) >= 3, "medium").otherwise("easy")
