"""License scans, toxicity, language-model scores and WARC derivatives."""

import gzip
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry_mod
from emberwake.llm.common import reachable
from emberwake.llm.license_scan import align, known_licenses, license_scan, places, rising, scan, words_of
from emberwake.llm.license_texts import TEMPLATES
from emberwake.llm.elias_fano import EliasFano, from_buffer, to_bytes
from emberwake.llm.ngram_lm import language_model_scores
from emberwake.llm.toxicity import drop_toxic, fold, learn, score, toxicity_scores
from emberwake.llm.warc import build_derivatives, derivatives, read_derivatives, write_responses
from emberwake.llm.warc_records import page_text, parsed_lines, record, records, unchunked
from helpers import LONG, awkward, empty, lower, sha, unique
from pyspark.sql import functions as F

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def _workers(spark):
    reachable(spark)


@settings(max_examples=200, deadline=None)
@given(st.permutations(range(9)))
def test_rising_is_longest(values):
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] += max((best[j] for j in range(i) if values[j] < values[i]), default=0)
    got = [values[i] for i in rising(values)]
    assert got == sorted(got) and len(got) == max(best)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=12), st.lists(st.sampled_from("abcdef"), max_size=12))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(align(a, a)) == len(a)


def test_license_scan_finds_whole_and_altered_texts(spark):
    mit = words_of(TEMPLATES["MIT"])
    altered = [w for k, w in enumerate(mit) if k % 11 != 5]
    inserted = [x for k, w in enumerate(mit) for x in ([w, "extra"] if k % 9 == 4 else [w])]
    texts = [TEMPLATES[n] for n in sorted(TEMPLATES)]
    texts += [LONG + "\n" + TEMPLATES["MIT"] + "\n" + LONG, " ".join(altered), " ".join(inserted),
              " ".join(mit[: len(mit) // 2]), TEMPLATES["MIT (line)"] + " x " + TEMPLATES["MIT (line)"],
              " ".join(sorted(mit))]
    docs, rows = unique(spark, texts)
    got = [r for r in sorted(license_scan(docs).collect(), key=lambda r: r["doc_id"])]
    for name, r in zip(sorted(TEMPLATES), got):
        assert r["license"] == name and r["matches"][0]["coverage"] == 1.0
    long, cut, longer, half, twice, shuffled = got[len(TEMPLATES):]
    start = len(words_of(LONG))
    assert [(m["license"], m["start"], m["stop"]) for m in long["matches"]] == [("MIT", start, start + len(mit))]
    assert cut["license"] == "MIT" and longer["license"] == "MIT"
    assert half["license"] is None and shuffled["license"] is None
    assert [m["license"] for m in twice["matches"]] == ["MIT (line)"] * 2


def test_license_scan_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = license_scan(docs).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in got) == Counter((d, len(words_of(t or ""))) for d, t in rows)
    assert all(r["n_matches"] == 0 and r["license"] is None for r in got)
    assert license_scan(empty(spark)).count() == 0
    assert license_scan(docs, {"none": "..."}).filter("n_matches > 0").count() == 0


def test_license_query_against_whole_lines(spark):
    """Every document with a license line of the table is found, no other is."""
    lines = [" ".join(words_of(t)) for t in TEMPLATES.values()]
    docs = {r["doc_id"]: " ".join(words_of(r["text"] or "")) for r in
            spark.read.parquet(f"{MORE}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in entry_mod.queries()["op4_license_scan"](spark, MORE).collect()}
    assert got.keys() == docs.keys()
    want = {d for d, t in docs.items() if any(f" {line} " in f" {t} " for line in lines)}
    assert want and {d for d, r in got.items() if r["n_matches"]} == want


@pytest.mark.parametrize("text, name", [
    ("Released under the BSD License.", "BSD"), ("Released under the Foo License.", None),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC-SA 3.0.", "CC-BY-NC-SA-3.0"), ("Licensed under CC BY-NC 9.0.", None),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 9. See 3 files.", None),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"), ("Licensed under the Apache License, Version 7.3.", None),
    (TEMPLATES["GPL-3.0"].replace("either version 3", "either version 2"), "GPL-2.0"),
    (TEMPLATES["GPL-3.0"].replace("General Public", "Affero General Public"), "AGPL-3.0"),
    (TEMPLATES["BSD-3-Clause (full)"].replace("copyright holder nor", "University nor"), "BSD-3-Clause"),
    (TEMPLATES["BSD-2-Clause"] + " 3. Do not endorse or promote.", None),
    ("x " * 99 + TEMPLATES["LGPL-2.1 (full)"], "LGPL-2.1"), (TEMPLATES["Apache-2.0 (full)"] + " x" * 99, "Apache-2.0"),
])
def test_near_miss_licenses_keep_their_own_name(text, name):
    found = scan(words_of(text), known_licenses())
    assert {m[0].split(" (")[0] for m in found} == ({name} if name else set())


def test_what_tells_licenses_apart_stands_in_their_texts():
    for t in known_licenses():
        assert all(places(t.words, p) for p in t.phrases) and not t.barred & t.distinct
        assert not t.headed or t.words[:len(t.phrases[0])] == t.phrases[0]


def test_folding():
    assert fold("ｈ3llО w​orld!").split() == ["hello", "world"]


@pytest.mark.parametrize("written, meant", [
    ("c1own", "clown"), ("worth1ess", "worthless"), ("1d1ot", "idiot"), ("!diot!", "idiot"), ("c|own", "clown"),
    ("CIown", "clown"), ("pi9", "pig"), ("6arba9e", "garbage")])
def test_signs_with_several_readings(written, meant):
    assert fold(written).split()[0] == fold(meant).split()[0]


def test_a_sign_still_parts_words():
    assert fold("Stop!clown a|b 69 x9clown")[1:-1].split() == ["stoplclown", "clown", "alb", "b", "xgclown", "clown"]


def test_terms_inside_sentences_without_spaces(spark):
    rows = [(k, f"今天{c}笨蛋{c}啊", 1) for k, c in enumerate("天地人山水火木金土日月星")]
    rows += [(100 + k, f"今天{chr(0x5000 + k)}天气很好啊", 0) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert score("他说那个笨蛋来了", model) > 0.3 > score("他说天气很好", model)


def test_toxicity_on_held_out_rows(spark):
    # 120 held-out toxic rows; some labels have no sign in the text
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity_scores(docs, labels)
    assert got.count() == docs.count()
    rows = got.filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    bad = [r["score"] for r in rows if r["toxic"] == 1]
    good = [r["score"] for r in rows if r["toxic"] == 0]
    assert bad and good
    assert sum((b > g) + (b == g) / 2 for b in bad for g in good) / len(bad) / len(good) > 0.9


def test_toxicity_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, None), (99, 1), (None, 1), (9, 1), (9, 0)], "doc_id long, toxic int")
    got = toxicity_scores(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity_scores(empty(spark), labels).count() == 0
    assert toxicity_scores(docs, labels.limit(0)).filter("score > 0").count() == 0
    assert drop_toxic(docs, labels.limit(0)).count() == len(rows)
    assert drop_toxic(docs, labels).columns == docs.columns


def base_scores(rows, held):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    tokens = [[*word.findall(lower(t)), None] for _, t in rows]
    counts = Counter(w for (d, _), t in zip(rows, tokens) if not held(d) for w in t)
    n, v = sum(counts.values()), len(counts)
    return [(d, held(d), len(t), sum(counts[w] > 0 for w in t), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)) for (d, _), t in zip(rows, tokens)]


def test_language_model(spark):
    docs, rows = unique(spark)

    def held(d):
        return zlib.crc32(str(d).encode()) % 7 == 2

    got = language_model_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect()
    for r, want in zip(sorted(got, key=lambda r: r["doc_id"]), base_scores(rows, held), strict=True):
        assert tuple(r)[:5] == want[:5]
        assert r["base_score"] == pytest.approx(want[5], abs=1e-6) and r["score"] < 0
    never = F.lit(False)
    assert language_model_scores(empty(spark), never).count() == 0
    assert all(r["n_known"] == 0 for r in language_model_scores(docs, ~never).collect())
    repeated, all_rows = awkward(spark)
    assert language_model_scores(repeated, never).count() == len(all_rows)


def test_language_model_beats_the_base_and_sums_to_one(spark):
    got = entry_mod.queries()["op9_lm_score"](spark, MORE).filter("held_out")
    r = got.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert r["score"] > r["base"]
    # all texts of one known word from a closed world, and one unknown: at most one together
    words = ["a", "b", "c", "d"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a b", "a c", "d", "a b c", *words, "unknown"])],
                                 "doc_id long, text string")
    scored = language_model_scores(docs, F.col("doc_id") >= 4).filter("held_out").collect()
    assert sum(10 ** r["score"] for r in scored) <= 1 + 1e-9


def brute_force(train_texts, text, order):
    """Interpolated log10 score without the eight-bit codes, one discount a level."""
    seqs = [[None, *t.split(), ""] for t in train_texts]
    words = Counter(w for s in seqs for w in s[1:])
    n, once = sum(words.values()), sum(c == 1 for c in words.values())
    grams = {k: Counter(tuple(s[i - k + 1:i + 1]) for s in seqs for i in range(k - 1, len(s))) for k in range(2, order + 1)}
    unknown, total, s = (once + 1) / (n + 2), 0.0, [None, *text.split(), ""]
    for i in range(1, len(s)):
        p = (1 - unknown) * words[s[i]] / n if words[s[i]] else unknown
        for k in range(2, min(order, i + 1) + 1):
            h = tuple(s[i - k + 1:i])
            after = {g: c for g, c in grams[k].items() if g[:-1] == h}
            if after:
                one, two = (sum(c == m for c in grams[k].values()) for m in (1, 2))
                d = min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5
                p = max(0, after.get((*h, s[i]), d) - d) / sum(after.values()) + d * len(after) / sum(after.values()) * p
        total += math.log10(p)
    return total


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_uses_contexts_of_its_order(spark, order):
    known = ["a b c", "a b c", "x b d", "x b d", "a b c d", "e", "x b d c"]
    asked = ["a b c", "x b d", "a b d", "x b c", "e a b c d", "new b c", ""]
    docs = spark.createDataFrame(list(enumerate(known + asked)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in language_model_scores(docs, F.col("doc_id") >= len(known), order).collect()}
    for k, t in enumerate(asked, len(known)):
        # a code is rounded down by less than 0.09, in natural logarithms, a level
        tokens, exact = len(t.split()) + 1, brute_force(known, t, order)
        assert exact - 0.04 * order * tokens <= got[k] <= exact + 1e-9


def test_language_model_does_not_depend_on_partitions(spark):
    rows = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect() if r["doc_id"] % 5 == 0]
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
            found.append(sorted(map(tuple, language_model_scores(docs, F.col("doc_id") % 3 == 0).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_language_model_with_keys_beyond_a_shard(spark):
    """Contexts that do not fit a shard's keys are dealt to more shards."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(12).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") % 3 == 0
    wide = sorted(map(tuple, language_model_scores(docs, held).collect()))
    assert sorted(map(tuple, language_model_scores(docs, held, key_bits=18).collect())) == wide


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**63)), max_size=60), st.integers(0, 200),
       st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 300), st.integers(0, 300)), max_size=20))
def test_elias_fano_as_a_sorted_list(values, repeats, asked):
    values = sorted([*values, *values[:1] * repeats])
    array = np.array(values, np.uint64)
    sequence = EliasFano.of(from_buffer(to_bytes(EliasFano.arrays(array, "x"))), "x")
    assert sequence.access(np.arange(len(values))).tolist() == values
    asked += [(v, lo, hi) for v in values[::7] for lo, hi in ((0, len(values)), (3, 9))]
    want = np.array([v for v, _, _ in asked], np.uint64)
    lo, hi = (np.array([min(len(values), a[k]) for a in asked], np.int64) for k in (1, 2))
    first = [next((i for i in range(a, b) if values[i] == v), -1) for v, a, b in zip(want.tolist(), lo.tolist(), hi.tolist())]
    assert sequence.find(want, lo, hi).tolist() == first


PAGES = [(1, "http://a.example/x", "<html><head><title>T &amp; U</title><style>p{}</style><script>x('<p>')</script></head>"
                                   "<body><p>One <b>two</b>&nbsp;three<!-- no --><br>four</p></body></html>"),
         (2, None, "plain"), (None, "http://b.example/\r\nX: y", "<p>a null id"), (4, "", None), (5, "http://c.example", ""),
         (5, "http://c.example", ""), (6, "http://d.example", "<p>" + "<a" * 50_000), (7, "u", "\x00 � é <"),
         (8, "u", "line one\r\n\r\nWARC/1.1\r\n<p>two")]


def test_page_text():
    assert page_text(PAGES[0][2]) == "T & U\nOne two three\nfour"
    assert page_text("") == "" and page_text("<script>never closed") == ""


def test_warc_derivatives(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, file string")
    folder, files = write_responses(pages, file_bytes=200)
    out, made = build_derivatives(folder, files, file_bytes=300)
    rows = read_derivatives(out, made, "long").collect()
    assert len(rows) == 2 * len(PAGES) and len({r["record_id"] for r in rows}) == len(rows)
    sources = {}
    for f in files.collect():
        with open(f"{folder.removeprefix('file:')}/{f['file']}", "rb") as s:
            sources |= {h["warc-record-id"]: (h, block) for h, block in records(s)}
    assert len(sources) == len(PAGES)
    meta = {r["refers_to"]: r for r in rows if r["warc_type"] == "metadata"}
    text = {r["refers_to"]: r for r in rows if r["warc_type"] == "conversion"}
    assert meta.keys() == text.keys() == sources.keys()
    for k, (h, block) in sources.items():
        assert meta[k]["concurrent_to"] == text[k]["record_id"] and meta[k]["source_digest_ok"]
        assert meta[k]["source_digest"] == text[k]["source_digest"] == h["warc-payload-digest"]
        assert meta[k]["target_uri"] == text[k]["target_uri"] == h.get("warc-target-uri")
        assert meta[k]["page_id"] == text[k]["page_id"] and "content-type: text/html" in meta[k]["source_headers"]
    assert all(r["block_digest_ok"] for r in rows)
    want = Counter((i, u and u.replace("\r", "%0D").replace("\n", "%0A"), sha(page_text(p or ""))) for i, u, p in PAGES)
    assert Counter((r["page_id"], r["target_uri"], r["block_sha256"]) for r in text.values()) == want


def test_repeated_headers_are_all_read(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nVia: one\r\nSet-Cookie: b=2\r\n\r\n<p>x"
    made = derivatives({"warc-record-id": "<urn:x>"}, block)
    (tmp_path / "f.warc.gz").write_bytes(b"".join(made) + record(
        [("WARC-Type", "conversion"), ("WARC-Record-ID", "<urn:y>"), ("WARC-Concurrent-To", "<urn:p>"),
         ("WARC-Concurrent-To", "<urn:q>")], b""))
    files = spark.createDataFrame([("f.warc.gz", 3, 0)], "file string, records long, bytes long")
    rows = {r["record_id"]: r for r in read_derivatives(str(tmp_path), files).collect()}
    meta, = (r for r in rows.values() if r["warc_type"] == "metadata")
    assert [line for line in meta["source_headers"].split("\n") if not line.startswith("http-status")] == \
        ["set-cookie: a=1", "via: one", "set-cookie: b=2"]
    assert rows["<urn:y>"]["concurrent_to"] == "<urn:p>\n<urn:q>"


def _conversion(head: bytes, body: bytes) -> bytes:
    import io
    made = derivatives({"warc-record-id": "<urn:x>"}, b"HTTP/1.1 200 OK\r\n" + head + b"\r\n" + body)
    (_, _), (fields, text) = records(io.BytesIO(b"".join(made)))
    assert fields["warc-type"] == "conversion"
    return text.decode()


PAGE = "<p>caf\u00e9 one</p><p>two".encode()
RAW_DEFLATE = zlib.compressobj(wbits=-15)
RAW_DEFLATE = RAW_DEFLATE.compress(PAGE) + RAW_DEFLATE.flush()


@pytest.mark.parametrize("head, body, want", [
    (b"", PAGE, "caf\u00e9 one\ntwo"),
    (b"Transfer-Encoding: chunked\r\n", b"9\r\n<p>caf\xc3\xa9 \r\n5;x=y\r\none</\r\n7\r\np><p>tw\r\n1\r\no\r\n0\r\n\r\n", "caf\u00e9 one\ntwo"),
    (b"Transfer-Encoding: chunked\r\n", b"4\r\n<p>a\r\nnot a size", "anot a size"),
    (b"Transfer-Encoding: chunked\r\n", b"<p>stored without chunks", "stored without chunks"),
    (b"Content-Encoding: gzip\r\n", gzip.compress(PAGE), "caf\u00e9 one\ntwo"),
    (b"Content-Encoding: GZIP\r\n", gzip.compress(PAGE[:7]) + gzip.compress(PAGE[7:]), "caf\u00e9 one\ntwo"),
    (b"Content-Encoding: gzip\r\n", PAGE, "caf\u00e9 one\ntwo"),
    (b"Content-Encoding: deflate\r\n", zlib.compress(PAGE), "caf\u00e9 one\ntwo"),
    (b"Content-Encoding: deflate\r\n", RAW_DEFLATE, "caf\u00e9 one\ntwo"),
    (b"Transfer-Encoding: gzip, chunked\r\n", b"%x\r\n%s\r\n0\r\n\r\n" % (len(gzip.compress(PAGE)), gzip.compress(PAGE)), "caf\u00e9 one\ntwo"),
    (b"Content-Encoding: deflate, gzip\r\n", gzip.compress(zlib.compress(PAGE)), "caf\u00e9 one\ntwo"),
    (b"Content-Encoding: br\r\n", b"\x8b\x02\x80abc", ""),
    (b"Content-Encoding: gzip\r\n", b"", ""),
    (b"Content-Type: text/html; charset=ISO-8859-1\r\n", b"<p>caf\xe9 \x93q\x94", "caf\u00e9 \u201cq\u201d"),
    (b"Content-Type: text/html\r\n", b'<meta charset="windows-1251"><p>\xe4\xe0', "\u0434\u0430"),
    (b"Content-Type: text/html; charset=no-such\r\n", PAGE, "caf\u00e9 one\ntwo"),
    (b"Content-Type: text/html; charset=idna\r\n", PAGE, "caf\u00e9 one\ntwo"),
    (b"Content-Type: text/html;\r\n  charset=shift_jis\r\n", "<p>\u65e5\u672c".encode("shift_jis"), "\u65e5\u672c"),
    (b"", b'\xff\xfe' + "<p>wide".encode("utf-16-le"), "wide"),
    (b"", b'<meta charset="utf-16"><p>narrow', "narrow"),
])
def test_bodies_as_servers_send_them(head, body, want):
    assert _conversion(head, body) == want


def test_a_body_in_an_unknown_coding_is_told_and_digests_hold_with_chunks_or_without():
    import io
    from emberwake.llm.warc_records import digest
    raw = b"3\r\n<p>\r\n1\r\nx\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: zz\r\n\r\n" + raw
    for named, holds in ((digest(raw), b"true"), (digest(b"<p>x"), b"true"), (digest(b"other"), b"false")):
        meta = derivatives({"warc-record-id": "<urn:x>", "warc-payload-digest": named}, block)[0]
        (_, lines), = records(io.BytesIO(meta))
        assert b"source-coding-unknown: zz\r\n" in lines and b"source-payload-digest-holds: " + holds in lines


@given(st.lists(st.binary(min_size=1, max_size=40), max_size=6))
def test_chunks_round_trip(parts):
    sent = b"".join(b"%X\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
    assert unchunked(sent) == b"".join(parts)


@given(st.text(alphabet=" \t\u00a0\x1c\u2003ab<p>&#10;\n\r", max_size=60))
def test_blanks_are_joined_as_by_the_pattern(page):
    import html
    from emberwake.llm.warc_records import BLOCK, HIDDEN, SPACE, TAG
    text = TAG.sub("", BLOCK.sub("\n", HIDDEN.sub(" ", page.replace("\r", " ").replace("\n", " "))))
    lines = (SPACE.sub(" ", html.unescape(line)).strip() for line in text.split("\n"))
    assert page_text(page) == "\n".join(line for line in lines if line)


def test_folded_header_lines():
    assert parsed_lines([b" lost", b"A: one", b"\ttwo ", b"no colon", b"B:", b"  three"]) == [("A", "one two"), ("B", "three")]


def test_files_are_dealt_one_a_task(spark):
    from emberwake.llm.warc import _dealt
    for n in (1, 16, 200):
        files = spark.createDataFrame([(f"f-{k:05d}", 1, 1) for k in range(n)], "file string, records long, bytes long").repartition(7)
        sizes = _dealt(files).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == n and {r["count"] for r in sizes} == {1}


def test_warc_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder, files = write_responses(pages)
    assert read_derivatives(*build_derivatives(folder, files)).count() == 0


def test_warc_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    rows = entry_mod.queries()["op8_warc"](spark, SMALL).collect()
    assert Counter((r["page_id"], r["target_uri"], r["block_sha256"]) for r in rows if r["warc_type"] == "conversion") == \
        Counter((p["page_id"], p["url"], sha(page_text(p["html"] or ""))) for p in pages)
