"""String, JSON and number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what counts as white space when text is trimmed (ASCII).
SPACE = "[\\x20\\x09-\\x0D]"
#: Kinds of a triple's tail.
TAIL_TYPES = ("TIME", "QUANTITY", "LOCATION", "PERSON", "ORG", "OTHER")
#: Words that don't tell relations apart.
STOP_WORDS = ("in", "on", "at", "by", "of", "the", "a", "an")
#: Fixed value: an amount of money, or a number with a unit.
VALUE_PATTERN = r"(?i)(\$\s*\d+(?:[\.,]\d+)?)|(¥\s*\d+(?:[\.,]\d+)?)|(\d+(?:[\.,]\d+)?\s*(?:kg|g|cm|mm|inch|in|hz|mhz|ghz|gb|tb|w|kw|v|mah))"


def trimmed(c: Column) -> Column:
    """Without white space at both ends; null stays null."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def name_key(c: Column) -> Column:
    """Trimmed and lower-cased: the key names are compared by."""
    return F.lower(trimmed(c))


def canonical(c: Column) -> Column:
    """Trimmed, inner white space collapsed, lower-cased; null and blank give ''."""
    return F.lower(F.regexp_replace(trimmed(F.coalesce(c, F.lit(""))), f"{SPACE}+", " "))


def slug(c: Column) -> Column:
    """Relation slug: trimmed, lower-cased, each space an underscore."""
    return F.replace(F.lower(trimmed(F.coalesce(c, F.lit("")))), F.lit(" "), F.lit("_"))


def relation_tokens(c: Column) -> Column:
    """Distinct runs of a-z and 0-9 (the input isn't lower-cased), without stop words."""
    parts = F.array_distinct(F.split(F.coalesce(c, F.lit("")), "[^a-z0-9]+"))
    return F.array_except(parts, F.array(F.lit(""), *map(F.lit, STOP_WORDS)))


def tail_type(c: Column) -> Column:
    upper = F.upper(trimmed(c))
    return F.when(upper.isin(*TAIL_TYPES), upper).otherwise("OTHER")


def unit(c: Column) -> Column:
    return F.coalesce(trimmed(c), F.lit(""))


def scalar_value(c: Column) -> Column:
    """struct(raw, num, kind) of a loose scalar: kind is empty, int, float or str."""
    raw = F.coalesce(trimmed(c), F.lit(""))
    kind = F.when(raw == "", "empty").when(raw.rlike("^-?[0-9]+$"), "int").when(raw.rlike("^-?[0-9]+\\.[0-9]+$"), "float").otherwise("str")
    number = F.when(raw.rlike("^-?[0-9]+(\\.[0-9]+)?$"), raw.try_cast("double"))
    return F.struct(raw.alias("raw"), number.alias("num"), kind.alias("kind"))


def value_in(c: Column) -> Column:
    """First amount of money or number with a unit in a name, or null."""
    found = F.regexp_extract(c, VALUE_PATTERN, 0)
    return F.when(found != "", trimmed(found))


def numeric_labels(c: Column) -> Column:
    """Whole numbers of one to four digits that stand alone in a name."""
    return F.transform(F.regexp_extract_all(c, F.lit("\\b(\\d{1,4})\\b"), F.lit(1)), lambda x: x.cast("int"))


def url_site(c: Column) -> Column:
    """Network location of a URL, with port and user, or ''."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def title_head(c: Column, limit: int = 60) -> Column:
    """A page title up to its first ' - ' and then its first ' | '."""
    head = F.split_part(F.split_part(c, F.lit(" - "), F.lit(1)), F.lit(" | "), F.lit(1))
    return F.substring(trimmed(head), 1, limit)


def _json_text(c: Column) -> Column:
    escaped = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = F.replace(F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def cache_key(api: str, **params: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the request as JSON with sorted keys; numbers stay numbers."""
    parts = [F.concat(F.lit('"_t": '), _json_text(F.lit(api)))]
    for name in sorted(params):
        value = params[name]
        text = value.cast("string") if name == "n" or name.startswith("max_") else _json_text(value)
        parts.append(F.concat(F.lit(f'"{name}": '), text))
    return F.left(F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")), 256), F.lit(16))


def without_fence(raw: Column) -> Column:
    """The body of a fenced block, without the fence lines; other text as it is; null where a fence has no line end."""
    text = trimmed(raw)
    body = trimmed(F.regexp_replace(F.regexp_replace(text, "^```[^\\n]*\\n", ""), "```$", ""))
    return F.when(~text.startswith("```"), text).when(text.contains("\n"), body)


def _once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def braced(raw: Column) -> Column:
    """From the first '{' to the brace that closes it (braces in strings count too), or null.

    One pass over the braces alone: the state is the depth, the closing braces met and which of them came back to 0.
    """
    text = F.coalesce(raw, F.lit(""))
    rest = F.substr(text, F.greatest(F.instr(text, "{"), F.lit(1)))
    state = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed"), F.lit(0).alias("end"))

    def step(acc: Column, ch: Column) -> Column:
        depth = acc["depth"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)
        closed = acc["closed"] + F.when(ch == "}", 1).otherwise(0)
        end = F.when((acc["end"] == 0) & (ch == "}") & (depth == 0), closed).otherwise(acc["end"])
        return F.struct(depth.alias("depth"), closed.alias("closed"), end.alias("end"))

    end = F.aggregate(F.split(F.regexp_replace(rest, "[^{}]+", ""), ""), state, step, lambda acc: acc["end"])
    return _once(end, lambda n: F.when(n > 0, F.concat(F.call_function("substring_index", rest, F.lit("}"), n), F.lit("}"))))


def extract_json(raw: Column) -> Column:
    """JSON text of a model's answer: the fenced body if that parses, else the first braced block; null if neither does.

    A fence without a line end gives null.
    """
    text = trimmed(raw)
    fence = text.startswith("```")
    parsed = lambda c: _once(c, lambda x: F.when(F.try_parse_json(x).isNotNull(), x))
    return F.when(~fence, parsed(braced(text))).when(text.contains("\n"), F.coalesce(parsed(without_fence(raw)), parsed(braced(text))))


def extract_json_array(raw: Column) -> Column:
    """From the first '[' to the last ']' if that parses, else ``extract_json``."""
    grabbed = F.regexp_extract(F.coalesce(raw, F.lit("")), "(?s)\\[.*\\]", 0)
    parses = (grabbed != "") & F.try_parse_json(grabbed).isNotNull()
    return F.when(parses, grabbed).otherwise(extract_json(raw))
