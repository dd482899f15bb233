"""Hand-written edge rows of the line, version, coverage and page operators."""

import html
import random
from html.entities import html5
from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from dialogue_etl.functions import pages as P
from dialogue_etl.functions import text as T
from dialogue_etl.functions.render import profile_markdown, story_markdown
from dialogue_etl.operators import coverage as V
from dialogue_etl.operators import graph as G
from dialogue_etl.operators import lines as L
from dialogue_etl.operators import summary as S
from dialogue_etl.plans.shared import save, scratch
from dialogue_etl.sources import io as IO


def values(spark, texts, *functions):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [tuple(r)[1:] for r in frame.select("k", *[f(F.col("t")).alias(f"c{n}") for n, f in enumerate(functions)]).orderBy("k").collect()]


def test_speaker_forms(spark):
    got = values(spark, ["a:b", "a：b", "x" * 32 + ":y", "x" * 33 + ":y", "a:", "[choice:x] t", "[choicer:x", "a:b\nc", "a:b c", None], T.speaker_name, T.speaker_text)
    assert got == [("a", "b"), ("a", "b"), ("x" * 32, "y"), (None, None), (None, None), (None, None), (None, None), (None, None), ("a", "b c"), (None, None)]


def test_kinds(spark):
    got = values(spark, ["[choice:x] a:b", "所属版本 3.0", "剧情内容", "额外对话1", "出场人物：x", "text"], T.line_kind)
    assert [x[0] for x in got] == ["choice", "meta", "heading", "heading", "dialogue", "text"]


def test_versions(spark):
    frame = spark.createDataFrame([(v,) for v in [None, "", "abc", "3", "3.0", "3.10", "3.9", "3.9.0"]], "v string")
    got = [r[0] for r in frame.select(T.classify_version(F.col("v"), F.lit("3.0"), F.lit("3.9"))).collect()]
    assert got == ["version_unknown"] * 3 + ["in_range", "in_range", "skipped_by_max_version", "skipped_by_max_version", "skipped_by_max_version"]


def test_clean_text(spark):
    got = values(spark, ["&amp;lt;", "a&nbsp;　b\t c", "a\n\n\nb ", None], T.clean_text, T.match_key)
    assert got == [("&lt;", "&lt;"), ("a b c", "abc"), ("a\nb", "ab"), (None, None)]


def test_repair_at_ends(spark):
    docs = spark.createDataFrame([("d", "星\n穹\nhello\n\n丹恒\n\nlast\n星")], "source string, text string")
    got = [(r.line_no, r.text, r.speaker) for r in L.normalized(docs).orderBy("line_no").collect()]
    assert got == [(1, "星", None), (2, "hello", "穹"), (5, "last", "丹恒"), (8, "星", None)]


def test_prelude_and_last_values(spark):
    docs = spark.createDataFrame([("d", "a：b\n所属版本 3.1\n任务描述 one\n任务描述 two\n额外对话x\n出场人物 p q p\n过场动画\nz")], "source string, text string")
    got = [(r.section_no, r.title, r.start_line, r.version, r.description, r["cast"]) for r in L.build_sections(L.normalized(docs)).orderBy("section_no").collect()]
    assert got == [(1, "Prelude section 1", 1, None, None, []), (2, "过场动画", 2, "3.1", "two", ["p", "q"])]


def test_missing_items_and_cap(spark):
    items = [("p", k, "text", "aa", "aa") for k in range(3)] + [("q", k, "text", f"k{k:03d}", f"k{k:03d}") for k in range(100)]
    frame = spark.createDataFrame(items, "page string, pos int, kind string, text string, key string")
    targets = spark.createDataFrame([("p", "xaaax"), ("q", "")], "page string, target string")
    got = V.missing_items(frame, targets).groupBy("page").count().collect()
    assert {r[0]: r[1] for r in got} == {"p": 2, "q": 80}
    assert V.missing_items(frame, targets, None).count() == 102


def test_frames_and_ruby(spark):
    def frame(options, contents):
        return '<div class="plotFrame">' + '<div class="plotOptions">o</div>' * options + '<div class="content"><p>a：b</p></div>' * contents + "</div>"

    html = frame(5, 1) + frame(0, 1) + frame(3, 3) + "<p><ruby><rb>a</rb><rt>b</rt></ruby></p><p><ruby><rb>a</rb>(z</ruby><ruby>y<rt>z</rt></ruby></p>"
    pages = spark.createDataFrame([(1, html, "t", "s", "3.0"), (2, None, None, "s", None)], "page int, html string, title string, source string, version string")
    read = P.read_pages(pages, "page", "html")
    found = V.frame_locator(P.plot_frames(read)).orderBy("index").collect()
    assert [(r["index"], r.options, r.contents, r.group_no) for r in found] == [(1, 5, 1, 1), (2, 0, 1, None), (3, 3, 3, 2)]
    assert ["a（b）", "az"] == [r.text for r in P.source_items(read).collect()][-2:]
    md = {r.page: r for r in story_markdown(pages, "page", "html", "title", "source", "version").collect()}
    assert md[1].choice_group_count == 2 and md[1].dialogue_count == 5 and md[2].dialogue_count == 0


@pytest.mark.parametrize("raw, text", [("é".encode(), "é"), ("﻿é".encode(), "é"), ("翁法罗斯".encode("gb18030"), "翁法罗斯"), (b"", "")])
def test_decoding(spark, raw, text):
    frame = spark.createDataFrame([(bytearray(raw),)], "content binary")
    assert frame.select(IO.decoded(F.col("content"))).first()[0] == text


def test_markdown_pairs_over_blanks(spark):
    lines = [("d", k + 1, x) for k, x in enumerate(["星", "", "hi", "", "穹", "", "- no", "丹恒", "星", "bye"])]
    frame = spark.createDataFrame(lines, "source string, line_no int, line string")
    got = [r.line for r in L.repair_markdown_pairs(frame).orderBy("line_no").collect()]
    assert got == ["- **星**：hi", "", "穹", "", "- no", "丹恒", "- **星**：bye"]


def test_usual_themes(spark):
    lines = spark.createDataFrame([("p", k, x) for k, x in enumerate(["  轮回  的 朋友", "plain", "不是"] + ["记忆"] * 12)], "source string, line_no int, line string")
    got = S.theme_anchors(lines).collect()
    assert {(r.theme, r.anchor) for r in got if r.line_no < 3} == {("世界观要点", "轮回 的 朋友"), ("关系变化", "轮回 的 朋友"), ("易错点/待复核点", "不是")}
    assert sum(r.theme == "世界观要点" for r in got) == 10


def test_long_chain_is_followed_to_its_end(spark):
    nodes = spark.range(110).select(F.concat(F.lit("p"), "id").alias("url"), F.lit("in_range").alias("version_status"))
    edges = spark.range(109).select(F.concat(F.lit("p"), "id").alias("from"), F.concat(F.lit("p"), F.col("id") + 1).alias("to"), F.lit("next_task").alias("type"))
    seeds = nodes.filter("url = 'p0'").select("url")
    got = {r.url: r.hop for r in G.link_closure(seeds, edges.coalesce(1), nodes.coalesce(1), ["next_task"], lambda df: save(df.coalesce(1)), scratch(spark, "visited")).collect()}
    assert got == {f"p{k}": k for k in range(110)}
    with pytest.raises(ValueError, match="beyond 2 hops"):
        G.link_closure(seeds, edges, nodes, ["next_task"], save, scratch(spark, "visited"), max_hops=2)


def story(spark, pages, columns="page int, html string, title string, source string, version string"):
    frame = spark.createDataFrame(pages, columns)
    return {r.page: r for r in story_markdown(frame, "page", "html", "title", "source", "version").collect()}


def test_rendered_pages_are_mended(spark):
    """A lone speaker and the line after it are one line; nested branches are indented and numbered by themselves."""
    choice = '<div class="plotFrame"><div class="plotOptions">{0}</div><div class="plotOptions"></div><div class="content">{1}</div></div>'
    html = "<h2><span class='mw-headline'>剧情内容</span></h2><p>丹恒</p><p>hello</p>tail<ul>x<li>a：b<div>c</div></li><p>no</p></ul>" + choice.format("one", "<p>星：s</p>" + choice.format("in", "<p>t</p>")) + choice.format("two", "")
    got = story(spark, [(1, html, None, "dir/page.html", None)])[1]
    assert list(got.lines)[8:] == [
        "", "- **丹恒**：hello", "", "- **a**：bc", "", "> 选项组 1：2 个选项", "", "- 选项 1（选项）：one", "  - 回复：", "    - **星**：s", "    > 选项组 1：2 个选项", "    - 选项 1（选项）：in", "      - 回复：",
        "        t", "    - 选项 2（选项）：(空选项)", "      - 回复：未在 HTML 中找到对应 content 块", "- 选项 2（选项）：(空选项)", "  - 回复：未在 HTML 中找到对应 content 块", "",
        "> 选项组 2：2 个选项", "", "- 选项 1（选项）：two", "  - 回复：无额外文本", "- 选项 2（选项）：(空选项)", "  - 回复：未在 HTML 中找到对应 content 块",
    ]
    assert got.lines[0] == "# page" and (got.dialogue_count, got.choice_group_count) == (2, 2)


def test_deep_and_bad_pages(spark, monkeypatch):
    """A page 5,000 deep is read like any other; one that can't be read is a row of status error."""
    deep = "<div>" * 5000 + "<p>a：b</p>" + "</div>" * 5000
    pages = [(1, deep, "t", "s", "3.0"), (2, "<p>a：b</p>", "t", "s", "3.0"), (3, None, "t", "s", None)]
    got = story(spark, pages)
    assert got[1].dialogue_count == got[2].dialogue_count == 1 and got[3].dialogue_count == 0
    assert P.main_content(deep) == "a：b" and P.visible(deep).strip() == "a：b"
    frame = spark.createDataFrame(pages, "page int, html string, title string, source string, version string")
    read = P.read_pages(frame, "page", "html")
    broken = read.withColumn("error", F.when(F.col("page") == 2, F.lit("ValueError: x")))
    md = story_markdown(frame.filter("page <> 2"), "page", "html", "title", "source", "version")
    report = V.page_reports(broken, md)
    assert {r.page: (r.status, r.source_items) for r in report.collect()} == {1: ("pass", 1), 2: ("error", None), 3: ("pass", 0)}
    named = report.withColumns({"title": F.lit("T|x"), "version": F.lit("3"), "html": F.lit("h"), "markdown": F.lit("m"), "coverage": F.lit("c.md")})
    lines = {(r.part, r.place): r.line for r in IO.coverage_summary(named, "page").collect()}
    assert lines[1, 0] == "- 页面数：3" and lines[4, 2] == "| 2 | 3 | `error` | T\\|x | - | - | - | [c.md](c.md) |" and lines[6, 2] == "- `error` 002 T|x：ValueError: x"
    assert lines[2, 1] == "- `error`：1" and lines[2, 2] == "- `pass`：2" and (6, 0) not in lines and V.batch_failed(named)
    calm = named.filter("status = 'pass'")
    assert not V.batch_failed(calm) and [r.line for r in IO.coverage_summary(calm, "page").filter("part = 6").collect()] == ["- 未发现异常页。"]
    text = {r.page: r.text for r in IO.coverage_report_markdown(named, V.COUNTS).collect()}
    assert "| `source_items` | 1 |" in text[1] and "| `source_items` | - |" in text[2] and text[1].endswith("\n".join(["- 未发现额外文本组。", *IO.NOTES]))


def test_report_lists(spark):
    html = "<p>kept</p><p>lost</p><p>lost</p>"
    frame = spark.createDataFrame([(1, html, "t", "s", "3.0")], "page int, html string, title string, source string, version string")
    md = story_markdown(frame, "page", "html", "title", "source", "version").withColumn("lines", F.array(F.lit("kept"), F.lit("lost"), F.lit("- new")))
    r = V.page_reports(P.read_pages(frame, "page", "html"), md).first()
    assert (r.status, r.missing_groups, r.extra_groups) == ("fail", 1, 1)
    assert [(m.text, m.path, m.expected, m.observed) for m in r.missing] == [("lost", "剧情内容", 2, 1)] and [(e.kind, e.text) for e in r.extra] == [("markdown_text", "new")]


def test_order_and_numbers_of_pages(spark):
    old = spark.createDataFrame([("b", 0, "1"), ("a", 1, "2")], "url string, pos long, local_path string")
    new = spark.createDataFrame([("c", 0, "x/7_c.html"), ("a", 1, None)], "url string, pos long, local_path string")
    got = G.upsert_in_order(old, new, ["url"])
    assert sorted(tuple(r) for r in got.select("pos", "url", "local_path").collect()) == [(0, "b", "1"), (1, "a", "2"), (2, "c", "x/7_c.html")]
    assert G.next_page_index(got) == 8 and G.next_page_index(old) == 1 and G.next_page_index(old.limit(0)) == 1


def test_links_by_expression_and_helper(spark):
    rows = [("/sr/a", "https://w/x/y"), ("/sr/a;p", "https://w/x/y"), ("/sr/a?q=1#f", "https://w/"), ("../sr/b", "https://w/x/y"), ("#x", "https://w/"), ("/out", "https://w/"), ("https://v/sr/a", "https://w/"), ("//w/sr/c", "https://w/"), ("/sr/./d", "https://w/"), (None, "https://w/"), ("/sr/e", "https://u/")]
    frame = spark.createDataFrame(rows, "h string, b string")
    got = [r[0] for r in frame.select(T.resolver("w", "/sr/")(F.col("h"), F.col("b"))).collect()]
    assert got == ["https://w/sr/a", "https://w/sr/a", "https://w/sr/a?q=1", "https://w/sr/b", None, None, None, "https://w/sr/c", "https://w/sr/d", None, None]


def test_ties_in_zh_hans_order(spark):
    names = spark.createDataFrame([("p", n) for n in ["星", "阿", "丹", "b", "a"]], "source string, speaker string")
    assert [r.speaker for r in S.speaker_stats(names).orderBy("place").collect()] == ["阿", "丹", "星", "a", "b"]


def test_repeated_pages_are_pages_of_their_own(spark):
    """Rows that repeat an id, or have none, are rendered each from their own HTML."""
    talk = "<h3>大世界对话</h3>"
    pages = [(1, "<p>a：one</p>", "t", "s", "3.0"), (1, "<p>b：two</p><p>c：three</p>", "u", "s", "3.1"), (None, "<p>d：four</p>", "v", "s", None), (None, None, "w", "s", None)]
    frame = spark.createDataFrame([(*p, 7) for p in pages], "page int, html string, title string, source string, version string, row int")
    got = sorted((str(r.page), r.lines[0], [x for x in r.lines if x.startswith("- **")], r.dialogue_count) for r in story_markdown(frame, "page", "html", "title", "source", "version").collect())
    assert got == [("1", "# t", ["- **a**：one"], 1), ("1", "# u", ["- **b**：two", "- **c**：three"], 2), ("None", "# v", ["- **d**：four"], 1), ("None", "# w", [], 0)]
    profiles = frame.withColumn("html", F.concat(F.lit(talk), "html"))
    told = sorted((str(r.page), r.lines[-1]) for r in profile_markdown(profiles, "page", "html", "title", "source", "version").filter("error IS NULL").collect())
    assert [t for t, _ in told] == ["1", "1", "None"] and told[0][1].startswith("<!-- parser_stats: title=t;") and told[1][1].startswith("<!-- parser_stats: title=u;")


def test_pages_are_read_once_for_their_markdown(spark):
    """Pages with and without an error come from one reading, which takes no inventory."""
    told = "<h3>大世界对话</h3><p>a：one</p>"
    frame = spark.createDataFrame([(1, told, "t", "s", "3.0"), (1, "<p>b：two</p>", "u", "s", None), (None, "<p>c</p>", "v", "s", None)], "page int, html string, title string, source string, version string")
    for render in (story_markdown, profile_markdown):
        plan = render(frame, "page", "html", "title", "source", "version")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "items#" not in plan
    got = profile_markdown(frame, "page", "html", "title", "source", "version").collect()
    assert sorted((str(r.page), r.lines is None, r.dialogue_count, r.choice_group_count, r.error or "") for r in got) == [("1", False, 1, 0, ""), ("1", True, 0, 0, "no heading 大世界对话"), ("None", True, 0, 0, "no heading 大世界对话")]
    whole, blocks = (P.read_pages(frame, "page", "html", items=x).select("page", "blocks", "error").collect() for x in (True, False))
    assert whole == blocks and len(whole) == 3


RFC_3986 = {
    "g": "/b/c/g", "./g": "/b/c/g", "g/": "/b/c/g/", "/g": "/g", "//g": "g", "?y": "/b/c/d?y", "g?y": "/b/c/g?y", "g#s": "/b/c/g", "g?y#s": "/b/c/g?y", "g;x": "/b/c/g", "": "/b/c/d?q", ".": "/b/c/", "./": "/b/c/",
    "..": "/b/", "../": "/b/", "../g": "/b/g", "../..": "/", "../../": "/", "../../g": "/g", "../../../g": "/g", "../../../../g": "/g", "/./g": "/g", "/../g": "/g", "g.": "/b/c/g.", ".g": "/b/c/.g", "g..": "/b/c/g..",
    "..g": "/b/c/..g", "./../g": "/b/g", "./g/.": "/b/c/g/", "g/./h": "/b/c/g/h", "g/../h": "/b/c/h", "g?y/./x": "/b/c/g?y/./x", "g?y/../x": "/b/c/g?y/../x", "http:g": "/b/c/g",
}


def test_references_of_the_rfc(spark):
    """The standard's examples, without Python in the plan; what the standard library says of odd ones."""
    frame = spark.createDataFrame([(h,) for h in RFC_3986], "h string")
    done = frame.select("h", T.resolver(None, "")(F.col("h"), F.lit("http://a/b/c/d;p?q")).alias("url"))
    assert "Python" not in done._jdf.queryExecution().executedPlan().toString()
    assert {r.h: r.url for r in done.collect()} == {h: "http://g" if h == "//g" else f"http://a{p}" for h, p in RFC_3986.items()}
    bases = ["https://w/x/y", "https://w", "https://w/", "https://w/a//b/", "http://w:80/a;q/b;p?z=1#f"]
    hrefs = [*RFC_3986, " /g ", "\t/g\n", "a\nb/c", "x//y/../z", "//v/../k;p?q", "https://v/./k", "HTTPS://v/k", "/a;b/c;d", ";p", "/[x]", "//[::1]/k", "//[bad/k", "/é?ü", "%2e%2e/g", "a:b", "/a?b?c", "?", "/g?", "//", "/a/b/../../../c/"]

    def usual(href, base):
        if href.startswith("#"):
            return None
        try:
            x = urlparse(urljoin(base, href))
        except ValueError:
            return None
        return urlunparse((x.scheme, x.netloc, x.path, "", x.query, "")) if x.netloc and x.path.startswith("/") else None

    pairs = spark.createDataFrame([(h, b) for h in hrefs for b in bases], "h string, b string")
    got = {(r.h, r.b): r.url for r in pairs.select("h", "b", T.resolver(None, "/")(F.col("h"), F.col("b")).alias("url")).collect()}
    assert got == {(h, b): usual(h, b) for h in hrefs for b in bases}


def test_character_references(spark):
    """All names with and without what follows, numbers, broken references and random mixtures read as the standard
    library reads them, without Python in the plan; numbers too long for it are no characters."""
    texts = ["&" + n for n in html5] + [f"x&{n}y&" for n in html5]
    texts += [f"&#{n}" for n in range(700)] + [f"a&#x{n:X};b" for n in [*range(0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFEFF, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000]]
    texts += ["", "&", "&&amp;&", "&amp;lt;", "&#" + "9" * 400 + ";", "&#000000000065;", "&#xFFFFFFFFFFFFFFFFFF", "&#X41;&#x;&#;", "&notit;&notin;", "& amp;", "&" + "a" * 50 + ";", "&lt\n&gt", "&😀😀;", "&;"]
    parts, dice = ["&", "&#", "#x", "amp", ";", "lt", "19", "f", "G", " ", "\n", "not", "in", "<", "é"], random.Random(1)
    texts += ["".join(dice.choice(parts) for _ in range(dice.randrange(30))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    done = frame.select("t", T.html_unescape(F.col("t")).alias("read"))
    assert "Python" not in done._jdf.queryExecution().executedPlan().toString()
    assert {r.t: r.read for r in done.collect()} == {None: None} | {t: html.unescape(t) for t in texts}
    assert values(spark, ["&#" + "9" * 5000 + ";."], T.html_unescape) == [("\ufffd.",)]


def test_rows_of_a_page_with_many_items(spark):
    """They leave the helper in pieces; all parts are those of the arrays."""
    many = "<p>a：b</p>" * 30_000
    choice = '<div class="plotFrame"><div class="plotOptions">o</div><div class="content"><p>a：b</p></div></div>'
    said = '<div class="messageContent"><div class="NM-Container"><div class="SenderName">x</div><div class="MessageLeft">y</div></div></div>'
    frame = spark.createDataFrame([(1, many, 0), (1, choice + said, 0), (None, "<p>c：d</p>" + choice, 0), (2, None, 0)], "page int, html string, pos int").coalesce(1)
    read = save(P.read_pages(frame, "page", "html"))
    wanted = {"items": P.source_items(read), "frames": P.plot_frames(read), "choices": P.choice_rows(read).drop("marker"), "messages": P.message_lines(read)}
    for part, want in wanted.items():
        got = P.page_rows(frame, "page", "html", part, rows=700)
        got = got if "pos" in want.columns else got.drop("pos")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert wanted["items"].count() > 30_000
