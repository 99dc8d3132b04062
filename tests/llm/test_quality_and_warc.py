import hashlib
import re
from collections import Counter

from lumenkg.llm import quality_rules as qr
from lumenkg.llm import queries
from lumenkg.llm import warc_archive as wa


def brute_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.sub("[\x20\x09-\x0d]+", "", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


LONG = " ".join(f"w{i % 4000}" for i in range(9000))
TEXTS = [None, "", " \n ", "a b c a b c a", "é x ## \x0b y\r\nz", "one line\none line\n\n \n  \none line", "x " * 300, LONG, "a a a a", "one line\none line"]
CLEAN = " ".join(f"word{i}" for i in range(80))
JUNK = " ".join(f"word{i}***" for i in range(80))


def test_counts_and_verdicts(spark):
    rows = [(i, t, "s", "x") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, JUNK + f" t{i}", "bad", "x") for i in range(40)] + [(200, CLEAN, "bad", "x"), (201, JUNK, "good", "x"), (203, CLEAN, None, "x")]
    rows += [(300 + i, CLEAN + f" u{i}", "good", "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string")
    out = {r["doc_id"]: r for r in qr.judge(docs).collect()}
    assert len(out) == len(rows)
    for i, t, _, _ in rows:
        assert {k: out[i][f"__qr_{k}"] for k in qr.METRICS} == brute_counts(t)
        n = brute_counts(t)
        assert out[i]["__qr_base_failed"] == (n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"])
    assert not any(out[100 + i]["__qr_kept"] for i in range(40)), "junk on a host of junk goes"
    assert all(out[k]["__qr_kept"] for k in (200, 201, 203, 300)), "clean rows stay on any host, junk on a good host too"
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["__qr_kept"] for r in out.values())
    assert qr.keep_good(docs.limit(0)).count() == 0
    plan = qr.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


PAGES = [(1, "http://a", "p" * 1500), (7, "http://b\r\n", "p" * 1500), (3, None, "p" * 1500), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (8, "u", "é" * 600), (9, "u", "é" * 600), (10, "u", "é" * 499), (11, "u", "é" * 499), (8, "u", "é" * 600)]


def test_archive_rebuilds_records(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, address string")
    root = str(tmp_path / "archive")
    wa.write_archive(pages, root)
    assert spark.read.parquet(root + "/payloads").count() == len({p[2] or "" for p in PAGES})
    got = wa.read_records(spark, root).collect()
    assert sorted(r["page_id"] for r in got) == sorted(p[0] for p in PAGES)
    html = {p[0]: (p[2] or "").encode() for p in PAGES}
    for r in got:
        assert bytes(r["payload"]) == html[r["page_id"]]
        assert bytes(r["record"]).startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert bytes(r["record"]).endswith(b"\r\n\r\n" + (b"" if r["record_type"] == "revisit" else html[r["page_id"]]) + b"\r\n\r\n")
    refers = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert refers == {(1, "revisit", 7), (3, "revisit", 7), (7, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (8, "revisit", 9), (9, "response", None), (10, "response", None), (11, "response", None)}
    pages.drop("address").write.parquet(str(tmp_path / "pages.parquet"))
    for r in queries.op3_warc_archive(spark, str(tmp_path)).collect():
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html[r["page_id"]]), hashlib.sha1(html[r["page_id"]]).hexdigest())
    wa.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert wa.read_records(spark, str(tmp_path / "none")).count() == 0
