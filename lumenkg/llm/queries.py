"""One query per corpus operator, over whole tables, and the SQL that states each result where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenkg.llm import best_fit_packing, bpe_codec, compact_windows, edit_token_counts, exact_dedup, language_id, merkle, posting_lists, quality_rules, simhash, spelling, warc_archive, wavelet_store
from lumenkg.llm.workspace import read_table, scratch_path


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    warc_archive.write_archive(read_table(spark, sf_dir, "pages"), root)
    return warc_archive.read_index(spark, root)


OP3_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), w as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as winner from p
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> winner then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> winner then winner end as refers_to
from w
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    slim = quality_rules.with_metrics(docs).drop("text")
    judged = quality_rules.judge_metrics(slim)
    p = quality_rules.P
    return judged.select(
        "doc_id", *[F.col(p + c).alias(c) for c in quality_rules.METRICS], F.col(p + "base_failed").alias("base_failed"), F.col(p + "kept").alias("kept")
    )


OP6_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents
), w as (
  select rid, doc_id, source, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') as lines from d
), g as (
  select rid, unnest(range(1, len(words) - 1)) as p, words from w where len(words) >= 3
), h as (
  select rid, p, count(*) over (partition by rid, words[p], words[p + 1], words[p + 2]) as n from g
), r as (
  select rid, count(distinct q) as n_repeat_words from (select rid, unnest([p, p + 1, p + 2]) as q from h where n > 1) group by rid
), m as (
  select w.rid, doc_id, source, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from w left join r using (rid)
), f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    n_symbols > 0.1::double * word_chars or n_dup_lines > 0.3::double * n_lines
      or word_chars < 2 * n_words or word_chars > 20 * n_words as soft_failed
  from m
), hosts as (
  select source, count(*) as docs, sum(case when base_failed or soft_failed then 1 else 0 end) as failed from f group by source
), moments as (
  select least(greatest(avg(failed / docs), 1e-6), 1 - 1e-6) as m, var_pop(failed / docs) as v from hosts
), prior as (
  select m, least(greatest(case when v > 1e-12 then m * (1 - m) / v - 1 else 10 end, 1e-3), 1e6) as weight from moments
), verdict as (
  select source, (failed + m * weight) / (docs + weight) > 0.5 as host_rejected from hosts, prior
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or (soft_failed and host_rejected)) as kept
from f join verdict on f.source is not distinct from verdict.source
"""


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicate_classes(read_table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id", F.lower(F.lpad(F.hex(simhash.P + "fp"), 16, "0")).alias("fingerprint"), F.col(simhash.P + "component").alias("component_id")
    )


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.decode_ids(bpe_codec.encode_texts(docs, drop_text=True))
    return coded.select(
        "doc_id",
        (F.octet_length(bpe_codec.P + "ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(bpe_codec.P + "ids", 256).alias("ids_sha256"),
        F.sha2(F.col(bpe_codec.P + "decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_wavelet_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "wavelet")
    wavelet_store.write_shards(read_table(spark, sf_dir, "documents"), root)
    found = wavelet_store.read_documents(spark, root, (F.crc32("ids").alias("ids_crc32"),))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def wavelet_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the middle id of every document, read from the store by their place."""
    root = scratch_path(spark, "wavelet")
    wavelet_store.write_shards(read_table(spark, sf_dir, "documents"), root)
    docs = wavelet_store.read_documents(spark, root, (F.lit(None).cast("int").alias("ids"),)).select("doc_id", "start", "n_tokens")
    asked = docs.select("doc_id", "start", F.explode(F.array("start", F.col("start") + F.floor(F.col("n_tokens") / 2))).alias("place")).distinct()
    return asked.join(wavelet_store.access_ids(spark, root, asked), "place").select("doc_id", (F.col("place") - F.col("start")).alias("at"), "id")


def wavelet_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of the ids 2, 1002, 2002 and so on, the end of a document among them."""
    root = scratch_path(spark, "wavelet")
    wavelet_store.write_shards(read_table(spark, sf_dir, "documents"), root)
    return wavelet_store.occurrences_of(spark, root, list(range(2, 50_000, 1000)))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = best_fit_packing.cut_pieces(read_table(spark, sf_dir, "documents"))
    return pack_digest(pieces)


def pack_digest(pieces: DataFrame) -> DataFrame:
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    placed = best_fit_packing.place_pieces(slim)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    net = language_id.fit(docs.filter(~held_out))
    told = language_id.predict(docs.select("doc_id", "text"), net)
    return told.select(
        "doc_id", held_out.alias("held_out"), F.col(language_id.P + "lang").alias("lang_pred"), F.col(language_id.P + "score").alias("score")
    )


def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeated_passages(read_table(spark, sf_dir, "documents"))


def op7_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after two edits: 40 characters in the middle give way to the text's
    first 24, and the source is added at the end."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    step = lambda at, deleted, inserted: F.struct(at.alias("at"), deleted.alias("deleted"), inserted.alias("inserted"))
    middle = step(F.floor(n / 2), F.lit(40).cast("long"), F.substring("text", 1, 24))
    last = step(n + 24, F.lit(0).cast("long"), F.concat(F.lit(" "), F.coalesce("source", F.lit(""))))
    p = edit_token_counts.P
    docs = docs.withColumn(p + "edits", F.array(middle, last).cast(edit_token_counts.EDITS)).drop("source")
    trees = edit_token_counts.build_trees(docs, drop_text=True).withColumn("n_tokens", F.col(p + "n_tokens"))
    edited = edit_token_counts.apply_edits(trees)
    return edited.select("doc_id", "n_tokens", F.col(p + "n_tokens").alias("n_tokens_edited"), F.col(p + "encoded").alias("n_chars_encoded"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), drop_one_in=199)


#: crc32 of a string in DuckDB, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i::int + 1, 2))::bigint)),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda y, k: case when y & 1 = 1 then xor(y >> 1, 3988292384) else y >> 1 end)))"""

OP11_SQL = f"""
with recursive d as (
  select row_number() over () as rid, coalesce(doc_id::varchar, '') as doc, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), r as (
  select rid, doc, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]+')) as run from d
), c as (
  select doc, run, count(*) as n from r where length(run) >= 6 group by all
), h as (
  select run, n, {_CRC32.format("(doc || ':' || run)")} as h from c
), t as (
  select n, case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from h
), v as (
  select word, sum(n)::bigint as n from t where length(word) >= 6 group by word having sum(n) >= 5
), cuts as (
  select word, n, unnest(range(1, length(word) + 1))::int as i from v
), masked as (
  select word, n, length(word) as k, i, left(word, i - 1) || '*' || substr(word, i + 1) as m, left(word, i - 1) || substr(word, i + 1) as less from cuts
), pairs as (
  select a.word as a, b.word as b, b.n as bn from masked a join masked b on a.k = b.k and a.i = b.i and a.m = b.m and a.word <> b.word
  union select v.word, m.word, m.n from v join masked m on m.less = v.word
  union select m.word, v.word, v.n from v join masked m on m.less = v.word
), near as (
  select a, count(*) as n_near, max(bn) as most from pairs group by a
), best as (
  select p.a, min(b) as b from pairs p join near on near.a = p.a and p.bn = near.most group by p.a
), told as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when most >= 5 * v.n then b end as form, case when most >= 5 * v.n then most end as form_n
  from v left join near on near.a = v.word left join best on best.a = v.word
), chain as (
  select word, word as root from told
  union all select chain.word, told.form from chain join told on told.word = chain.root where told.form is not null
)
select told.word, form, root, n, n_near, form_n from told join (
  select chain.word, chain.root from chain join told on told.word = chain.root where told.form is null
) using (word)
"""


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicate_classes(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("least_id").alias("keep_id"), F.col("rows").alias("group_size"),
        (F.col("row") == F.col("least_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP12_SQL = r"""
with d as (
  select doc_id, row_number() over (order by doc_id nulls last) as row, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, row = min(row) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is checked with a changed text: its capital letters A-Z are small."""
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = merkle.leaf_digest([small if c == "text" else F.col(c) for c in fields])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.unhex(changed))
    manifest = merkle.build(docs, fields, "lang", "doc_id", {"tampered": tampered})
    rows = merkle.proofs(manifest)
    own = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    rows = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"), merkle.folded(own, F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}::varchar) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

OP13_SQL = f"""
with recursive d as (
  select *, row_number() over (partition by lang order by doc_id nulls first) - 1 as k, count(*) over (partition by lang) as m,
    {_LEAF.replace("{0}::varchar) || ':' || {0}", "text::varchar) || ':' || text")} as leaf,
    {_LEAF.replace("{0}::varchar) || ':' || {0}", "small::varchar) || ':' || small")} as changed
  from (select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as small from documents)
), low as (
  select 0 as level, coalesce('=' || lang, '') as grp, k, m, leaf as h from d
  union all
  select level + 1, grp, k // 8, (max(m) + 7) // 8, sha256(string_agg(h, '' order by k)) from low where m > 1 group by level, grp, k // 8
), tops as (
  select grp, h as subroot, level as depth, row_number() over (order by grp) - 1 as k, count(*) over () as m from low where m = 1
), high as (
  select 0 as level, k, m, subroot as h from tops
  union all
  select level + 1, k // 8, (max(m) + 7) // 8, sha256(string_agg(h, '' order by k)) from high where m > 1 group by level, k // 8
), whole as (
  select h as root from high where m = 1
), sides as (
  select level, grp, k, string_agg(h, '') over (w rows between unbounded preceding and 1 preceding) as l, string_agg(h, '') over (w rows between 1 following and unbounded following) as r
  from low where m > 1 window w as (partition by level, grp, k // 8 order by k)
), high_sides as (
  select level, k, string_agg(h, '') over (w rows between unbounded preceding and 1 preceding) as l, string_agg(h, '') over (w rows between 1 following and unbounded following) as r
  from high where m > 1 window w as (partition by level, k // 8 order by k)
), steps as (
  select grp, level, k, coalesce(l, '') as l, coalesce(r, '') as r, false as top from sides
  union all select tops.grp, tops.depth + s.level, s.k, coalesce(l, ''), coalesce(r, ''), true from tops join high_sides s on s.k = tops.k // (8 ** s.level)::bigint
), fold as (
  select doc_id, coalesce('=' || lang, '') as grp, k, leaf, 0 as level, '' as proof,
    case when {_CRC32.format("doc_id::varchar")} % 3 = 0 then changed else leaf end as h from d
  union all
  select f.doc_id, f.grp, f.k, f.leaf, f.level + 1, f.proof || s.l || s.r, sha256(s.l || f.h || s.r)
  from fold f join steps s on s.grp = f.grp and s.level = f.level and (s.top or s.k = f.k // (8 ** f.level)::bigint)
), done as (
  select doc_id, grp, leaf, proof, h, level, max(level) over (partition by grp) as last from fold
)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, h as folded_root, h = root as verified
from done join tops using (grp), whole where level = last
"""


QUERIES = {
    "op3_warc_archive": op3_warc_archive,
    "op6_quality_rules": op6_quality_rules,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op9_bpe_codec": op9_bpe_codec,
    "op2_wavelet_store": op2_wavelet_store,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op1_language_id": op1_language_id,
    "op8_posting_lists": op8_posting_lists,
    "op4_compact_windows": op4_compact_windows,
    "op7_edit_token_counts": op7_edit_token_counts,
    "wavelet_access": wavelet_access,
    "wavelet_occurrences": wavelet_occurrences,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op3_warc_archive": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_exact_dedup": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
