"""Host-level quality rules, in DataFrame functions only.

Per document the rules count words, symbols, repeated lines and words inside
repeated three-word windows. Failures are aggregated by host (the ``source``
column), each host's failure rate is shrunk with a beta prior fitted to all
hosts by the method of moments, and the host verdict is joined back.

A document is kept unless it fails a base rule, or it fails a soft rule on a
host whose shrunk failure rate is over ``host_limit``. A document that fails no
rule is always kept, whatever its host.

Defined results: null or empty text has no words and fails the base rule; a
null host is a host of its own; repeated rows are judged each for itself; an
empty table gives an empty result; other columns pass through untouched
(internal columns start with ``__qr_``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenkg.llm.workspace import materialise

P = "__qr_"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class RuleLimits:
    """Base rules, soft rules and the host limit; all are shares or counts per document."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_share: float = 0.10
    dup_line_share: float = 0.30
    mean_word_chars: tuple[float, float] = (2.0, 20.0)
    host_limit: float = 0.5
    default_prior_weight: float = 10.0


def _replace_each(text: Column, characters: str, by: str) -> Column:
    """Plain byte searches, one per character: far cheaper than ``translate`` or a pattern."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    spaced = _replace_each(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", " ")
    return F.array_remove(F.split(spaced, " "), "")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _window_hashes(words: Column) -> Column:
    def triples(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), triples)


def _twice_or_more(hashes: Column) -> Column:
    """The distinct values that an array holds more than once, from equal neighbours of its sorted form."""
    return F.array_distinct(_let(F.sort_array(hashes), lambda s: F.filter(s, lambda x, i: (i > 0) & (F.get(s, i - 1) == x))))


def _places_by_lookup(hashes: Column, repeated: Column) -> Column:
    marked = F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i))
    return F.filter(marked, lambda p: p.isNotNull())


def _places_by_sort(hashes: Column) -> Column:
    """For texts with many repeats: sort (hash, position) and keep equal neighbours, n log n at any length."""

    def repeated(s: Column) -> Column:
        n = F.size(s)
        return F.filter(
            s,
            lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i < n - 1) & (F.get(s, i + 1)["h"] == x["h"])),
        )

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.sort_array(F.transform(_let(ordered, repeated), lambda x: x["p"]))


def _covered(places: Column) -> Column:
    """Words inside three-word windows that start at the given ascending places."""
    return F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the ``__qr_`` counts of every document's whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    out = docs.withColumn(P + "words", words_of(F.col(text_col)))
    out = out.withColumns({P + "hashes": _window_hashes(F.col(P + "words")), P + "lines": lines})
    out = out.withColumn(P + "repeated", _twice_or_more(F.col(P + "hashes")))
    hashes, repeated = F.col(P + "hashes"), F.col(P + "repeated")
    n_repeat_words = (
        F.when(F.size(repeated) == 0, F.lit(0).cast("long"))
        .when(F.size(repeated) <= 64, _covered(_places_by_lookup(hashes, repeated)))
        .otherwise(_covered(_places_by_sort(hashes)))
    )
    out = out.withColumns(
        {
            P + "n_words": F.size(P + "words").cast("long"),
            P + "word_chars": F.length(F.array_join(P + "words", "")).cast("long"),
            P + "n_symbols": (F.octet_length(text) - F.octet_length(_replace_each(text, "#*$%&|<>", ""))).cast("long"),
            P + "n_lines": F.size(P + "lines").cast("long"),
            P + "n_dup_lines": (F.size(P + "lines") - F.size(F.array_distinct(P + "lines"))).cast("long"),
            P + "n_repeat_words": n_repeat_words,
        }
    )
    return out.drop(P + "words", P + "hashes", P + "lines", P + "repeated")


def _failures(limits: RuleLimits) -> dict[str, Column]:
    c = {k: F.col(P + k) for k in (*METRICS, "n_lines")}
    low, high = limits.mean_word_chars
    soft = (
        (c["n_symbols"] > limits.symbol_share * c["word_chars"])
        | (c["n_dup_lines"] > limits.dup_line_share * c["n_lines"])
        | (c["word_chars"] < low * c["n_words"])
        | (c["word_chars"] > high * c["n_words"])
    )
    base = (c["n_words"] < limits.min_words) | (100 * c["n_repeat_words"] > limits.repeat_percent * c["n_words"])
    return {P + "base_failed": base, P + "soft_failed": soft}


def fit_beta_prior(hosts: DataFrame, limits: RuleLimits) -> tuple[float, float]:
    """(alpha, beta) by the method of moments over the hosts' failure rates; one row reaches the driver."""
    rate = F.col(P + "failed") / F.col(P + "docs")
    row = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    if row is None or row["m"] is None:
        return 1.0, 1.0
    m, v = min(max(row["m"], 1e-6), 1 - 1e-6), row["v"] or 0.0
    weight = m * (1 - m) / v - 1 if v > 1e-12 else limits.default_prior_weight
    weight = min(max(weight, 1e-3), 1e6)
    return m * weight, (1 - m) * weight


def host_verdicts(judged: DataFrame, host_col: str, limits: RuleLimits) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate and verdict."""
    failed = (F.col(P + "base_failed") | F.col(P + "soft_failed")).cast("long")
    hosts = judged.groupBy(F.col(host_col).alias(P + "host")).agg(
        F.count(F.lit(1)).alias(P + "docs"), F.sum(failed).alias(P + "failed")
    )
    alpha, beta = fit_beta_prior(hosts, limits)
    shrunk = (F.col(P + "failed") + F.lit(alpha)) / (F.col(P + "docs") + F.lit(alpha + beta))
    return hosts.withColumn(P + "host_rate", shrunk).withColumn(P + "host_rejected", shrunk > limits.host_limit)


def judge_metrics(measured: DataFrame, host_col: str = "source", limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Verdicts for rows that carry the counts of ``with_metrics``; the counts are written once and read twice."""
    judged = materialise(measured.withColumns(_failures(limits)), "quality")
    hosts = host_verdicts(judged, host_col, limits).select(P + "host", P + "host_rate", P + "host_rejected")
    joined = judged.join(hosts, F.col(host_col).eqNullSafe(F.col(P + "host")), "left")
    rejected = F.col(P + "base_failed") | (F.col(P + "soft_failed") & F.coalesce(P + "host_rejected", F.lit(False)))
    return joined.withColumn(P + "kept", ~rejected).drop(P + "host", P + "host_rejected")


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", limits: RuleLimits = RuleLimits()) -> DataFrame:
    """All columns of ``docs`` plus the ``__qr_`` counts, ``__qr_host_rate``, ``__qr_base_failed`` and ``__qr_kept``."""
    return judge_metrics(with_metrics(docs, text_col), host_col, limits)


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", limits: RuleLimits = RuleLimits()) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns; only rows that fail a soft rule are shuffled."""
    judged = materialise(with_metrics(docs, text_col).withColumns(_failures(limits)), "quality")
    hosts = host_verdicts(judged.drop(text_col) if text_col != host_col else judged, host_col, limits).filter(~F.col(P + "host_rejected")).select(P + "host")
    own, sound = [F.col(f"`{c}`") for c in docs.columns], judged.filter(~F.col(P + "base_failed"))
    good = sound.filter(~F.col(P + "soft_failed")).select(*own)
    spared = sound.filter(P + "soft_failed").join(hosts, F.col(host_col).eqNullSafe(F.col(P + "host")), "left_semi").select(*own)
    return good.unionByName(spared)
