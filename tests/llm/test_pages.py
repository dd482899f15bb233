"""HTML extraction, WARC archives and language identification."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

from dialogue_etl.llm import html_extract, language_id, warc

BOILER = '<nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div><aside class="sidebar">side</aside>'
END = '<section class="comments"><p>reader says</p></section><form><input><button>send</button></form><footer>foot &copy;</footer><script>var a="<p>x</p>";</script>'


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{BOILER}{body}{END}</body></html>"


CASES = [
    (page("<article><h1>Head</h1><p>One <b>bo</b>ld&amp;\n  two<br>three</p><ul><li>four</li><li>five</li></ul></article>"), "Head One bold& two three four five"),
    (page('<div class="main-content"><p>alpha &#228;&nbsp;b</p><div class="ad">buy</div><p>beta</p></div>'), "alpha ä b beta"),
    (page('<div class="page-with-sidebar"><div id="post-12"><p>text one<p>text two</div><div id="sidebar">no</div></div>'), "text one text two"),
    (page('<table><tr><td>cell one</td><td>cell two</td></tr></table>'), "cell one cell two"),
    (page('<article><p><b>open <br><p>next</p></article>'), "open next"),
    ("plain text only", "plain text only"),
    ("", ""),
    (None, ""),
    ("<html><body><nav>only menu</nav></body></html>", ""),
    ("<article>a < b <!-- no --> c</article>", "a < b c"),
]


@pytest.mark.parametrize("rows", [200_000, 0])
def test_extract(spark, rows):
    pages = [(k, f"http://h{k}.example/x" if k % 3 else None, h) for k, (h, _) in enumerate(CASES)] + [(50, "HTTP://user@H1.example:80/", CASES[0][0])]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS text")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in html_extract.extract_pages(frame, max_broadcast_rows=rows).collect()}
    for k, u, _ in pages:
        want = CASES[k if k < 50 else 0][1]
        assert got[k] == (u, want, len(want))
    assert html_extract.extract_pages(frame.limit(0), max_broadcast_rows=rows).collect() == []


def test_very_long_page(spark):
    """A page of megabytes is read whole, deep nesting too."""
    body = "<article>" + "<div>" * 300 + "<p>" + "word &amp; more " * 150_000 + "</p>" + "</div>" * 300 + "<p>end</p></article>"
    got = html_extract.extract_pages(spark.createDataFrame([(1, "http://a/", page(body))], "page_id long, url string, html string")).first()
    assert got.text == "word & more " * 150_000 + "end" and got.n_chars == len(got.text)


def test_hosts_agree(spark):
    """Of the containers that hold nearly all of a page's text the one that most pages of the host vote for wins."""
    usual = page('<div class="story"><p>' + "story text " * 40 + '</p><p>end</p></div>')
    odd = page('<div class="story"><p>lead</p><div class="inner"><p>' + "story text " * 40 + "</p></div></div>")
    frame = spark.createDataFrame([(k, "http://a.example/", usual if k else odd) for k in range(9)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(frame).collect()}
    assert got[0] == "lead " + ("story text " * 40).strip() and all(got[k] == ("story text " * 40) + "end" for k in range(1, 9))


def test_no_part_of_an_article_is_lost(spark):
    """A path that holds only a part of a page's text isn't taken there, whatever its votes; nor is its tag's name."""
    usual = page('<div class="layout"><article><p>' + "usual words " * 30 + "</p></article></div>")
    parted = page('<div class="layout"><p>' + "lead " * 40 + "</p><article><p>" + "rest " * 60 + "</p></article></div>")
    beside = page("<h1>Headline here</h1><article><p>" + "word " * 20 + '</p></article><div class="part"><p>' + "second " * 12 + "</p></div>")
    frame = spark.createDataFrame([(k, "http://a.example/", usual) for k in range(8)] + [(8, "http://a.example/", parted), (9, "http://a.example/", beside)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(frame).collect()}
    assert got[8].split() == ["lead"] * 40 + ["rest"] * 60
    assert got[9].split() == ["Headline", "here"] + ["word"] * 20 + ["second"] * 12


def test_extract_against_plain_reading(spark, sf_dir):
    """The given pages by an independent rule: the article element without its marked parts."""
    import html as entities
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    right = 0
    for r in pages.collect():
        part = re.search(r"<article[^>]*>(.*)</article>", r.html, re.S)[1]
        part = re.sub(r"<!--.*?-->|<(script|style|aside|nav|form|footer|header)\b.*?</\1>", "", part, flags=re.S)
        part = re.sub(r'<(div|section|p)[^>]*class="(?:ad|ads|advert|share|related|comments?|newsletter|promo|cookie)[^"]*".*?</\1>', "", part, flags=re.S)
        part = re.sub(r"</?(?:b|i|em|strong|a|span|code)\b[^>]*>", "", part)
        right += " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", part)).split()) == got[r.page_id]
    assert right >= 0.98 * len(got)


@pytest.mark.parametrize("rows", [200_000, 0])
def test_rows_are_read_one_by_one(spark, rows):
    """Rows that share an id, or have none, are read under paths of their own."""
    story, other = page('<div class="story"><p>' + "story text " * 20 + "</p></div><p>loose end</p>"), page('<section class="text"><p>' + "other words " * 30 + "</p></section>")
    pages = [(k, "http://a.example/", story) for k in range(5)] + [(7, "http://a.example/", story), (7, "http://a.example/", other), (None, "http://a.example/", story), (None, "http://a.example/", other), (None, None, None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(str((r.page_id, r.text)) for r in html_extract.extract_pages(frame, max_broadcast_rows=rows).collect())
    want = {story: ("story text " * 20).strip(), other: ("other words " * 30).strip(), None: ""}
    assert got == sorted(str((k, want[h])) for k, _, h in pages)


def test_missing_path_reads_the_whole_page():
    assert html_extract.extract("<div><p>one</p></div> two", "> body>div.story") == "one two"


def archive_rows():
    rng = random.Random(3)
    bodies = ["", None, "<p>é</p>", "x\r\n\r\nWARC/1.1\r\n", "long " * 50_000] + [f"<p>{k}</p>" for k in range(20)]
    return [(k, f"http://h.example/{k}" if k % 4 else None, bodies[rng.randrange(len(bodies))] if k > 5 else bodies[k % 5]) for k in range(150)] + [(7, "again", "<p>é</p>"), (None, "n", "only here"), (None, "n", "<p>3</p>")]


@pytest.mark.parametrize("least", [0, 10])
def test_archive(spark, tmp_path, least):
    rows = archive_rows()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS payload")
    path = warc.write_archive(frame, f"file://{tmp_path}/a{least}", min_bytes=least)
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= least and top[h or ""] != -1 and i != top[h or ""]
        want.append(str((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", top[h or ""] if revisit else None)))
    assert sorted(str(tuple(r)) for r in warc.records(spark, path).collect()) == sorted(want)
    assert spark.read.parquet(f"{path}/payloads").count() == len(top)
    out = f"file://{tmp_path}/w{least}"
    warc.export_warc(spark, path, out)
    blocks = sorted((r.header, bytes(r.block)) for r in warc.import_warc(spark, out).collect())
    rebuilt = sorted((r.header, b"" if "Type: revisit" in r.header else bytes(r.payload)) for r in warc.read_archive(spark, path).collect())
    assert blocks == rebuilt and len(blocks) == len(rows)


def test_damaged_archive(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")
    path = warc.write_archive(frame, f"file://{tmp_path}/d")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", warc.F.lit("z").cast("binary")).write.parquet(f"{path}/other")
    (tmp_path / "d/payloads").rename(tmp_path / "d/was")
    (tmp_path / "d/other").rename(tmp_path / "d/payloads")
    with pytest.raises(Exception, match="digest"):
        warc.records(spark, path).collect()


WORDS = {"aa": ["the", "and", "with", "thing", "house"], "bb": ["der", "und", "mit", "schön", "haus"], "cc": ["le", "et", "avec", "été", "maison"]}


def test_letters_of_any_script_only(spark):
    rows = [(k, t, None) for k, t in enumerate(["½ ² ③", "Ⅷ", "٣", "_", "ª", "日", "5 é"])] + [(100 + k, "the and with house", "aa") for k in range(40)]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[k] for k in range(7)] == ["und"] * 4 + ["aa"] * 3


def test_held_out_languages_of_documents(spark):
    """Accuracy on the documents that aren't learned from, long texts and repeated rows too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    more = docs.limit(3).selectExpr("doc_id", "repeat(text, 60) AS text", "lang").unionByName(docs.limit(2).select("doc_id", "text", "lang")).unionByName(docs.limit(2).select("doc_id", "text", "lang"))
    got = language_id.identify(docs.select("doc_id", "text", "lang").unionByName(more)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang is not None]
    assert len(held) > 200 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    alike = {}
    for r in got:
        alike.setdefault(r.doc_id, set()).add(r.lang_pred)
    assert sum(len(v) > 1 for v in alike.values()) <= 1


def test_languages_of_many_rows_without_id(spark):
    """Rows without an id, or with one id, are sampled by their texts; the sample of a language has a true bound."""
    english, other = ["the house and the tree", "a river with the boat"], ["der hund und die katze", "ein fluss mit dem boot"]
    rows = [(None, f"{t} {k}", lang) for k in range(1500) for lang, ts in (("en", english), ("de", other)) for t in ts] + [(None, "la casa", "es")] * 3000
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    _, langs, centres, _ = language_id.train(frame, "doc_id", "text", "lang", max_per_lang=50)
    assert set(langs) == {"en", "de", "es"} and len(centres) == len(langs)
    asked = spark.createDataFrame([(1, "the boat", None), (2, "die katze", None), (3, "casa", None)], frame.schema)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(frame.unionByName(asked), max_per_lang=50).filter("doc_id IS NOT NULL").collect()}
    assert got == {1: "en", 2: "de", 3: "es"}


def test_forged_header_lines(spark, tmp_path):
    """A header line ends at CR LF only, so no character in a URL makes another one."""
    urls = [f"http://h/{c}WARC-Payload-Digest: sha1:FORGED{c}WARC-Type: revisit" for c in ("\u2028", "\u2029", "\u0085", "\r\n", "\n", "\r", "\x0b", "\x0c", "\x00")]
    frame = spark.createDataFrame([(k, u, f"<p>{k}</p>\r\n\r\nWARC/1.1\r\n") for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = warc.records(spark, warc.write_archive(frame, f"file://{tmp_path}/f")).collect()
    assert sorted(r.page_id for r in got) == list(range(len(urls))) and all(r.record_type == "response" and len(r.payload_digest) == 32 for r in got)


def test_languages(spark):
    rng = np.random.default_rng(0)
    rows = [(k, " ".join(rng.choice(WORDS[lang], 4 + k % 30)), lang) for k in range(600) for lang in [list(WORDS)[k % 3]]]
    extra = [(1000, None, "aa"), (1001, "123 !!! 456", "bb"), (1002, "", None), (None, "der und mit", None), (1003, "Und MIT der Haus", None), (1004, "日本", None)]
    frame = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").selectExpr("*", "1 AS held_out")
    out = language_id.identify(frame, max_per_lang=100).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) + len(extra)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    assert np.mean([got[k].lang_pred == lang for k, _, lang in rows if got[k].held_out]) > 0.98
    assert [got[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3 and got[1003].lang_pred == "bb" and got[1004].lang_pred in WORDS and got[1004].rejected
    assert {r.lang_pred for r in language_id.identify(frame.withColumn("lang", warc.F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(frame.limit(0)).collect() == []
