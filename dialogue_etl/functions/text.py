"""Scalar text functions as column expressions.

Java's `\\s` is ASCII unless (?U) is given, and its `.` stops at more line ends than (?d) does; both flags are set
where the semantics ask for Unicode white space or for plain line feeds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogue_etl.functions.references import bound, html_unescape

# Words and patterns of the transcript format.
UI_WORDS = ["编辑", "折叠", "展开", "收起", "返回顶部", "目录", "更多"]
IMAGE_LINE = "(?i)^.*\\.(?:png|jpg|jpeg|gif|webp|svg)$"
INLINE_IMAGES = [
    # Tried once a run of letters, at its start or after an image: from inside the run it finds nothing more.
    "(?iU)(?:\\G|(?<![\\w\\-\\u4e00-\\u9fff]))[\\w\\-\\u4e00-\\u9fff]+头像(?:-\\d+)?\\.(?:png|jpg|jpeg|gif|webp)",
    "(?i)图标-位置\\.(?:png|jpg|jpeg|gif|webp)",
    "(?i)短信-警告\\.(?:png|jpg|jpeg|gif|webp)",
]
#: What a line holds that INLINE_IMAGES or choice_markup() changes; on other lines their patterns aren't tried.
MARKS = ["头像", "图标-位置", "短信-警告", "剧情选项-图标-"]
META_PREFIXES = ["所属版本", "任务描述", "出场人物"]
HEADINGS = ["剧情内容", "剧情梗概", "过场动画"]
EXTRA_HEADING = "额外对话"
DEFAULT_SPEAKERS = ["开拓者", "星", "穹", "帕姆", "姬子", "瓦尔特", "丹恒", "三月七", "黑天鹅", "星期日", "白厄", "缇宝", "万敌", "遐蝶", "阿格莱雅", "那刻夏", "风堇", "赛飞儿", "黄泉", "卡芙卡", "流萤"]
SENTENCE_ENDS = ["。", "！", "？", "…", "」", "）"]
CHOICE = "(?d)^\\[choice:([^\\]]+)\\](?U:\\s*)(.*)$"


#: Unicode white space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Unicode white space off both ends."""
    return F.btrim(text, F.lit(SPACES))


def plain_spaces(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\u00a0"), F.lit(" ")), F.lit("\u3000"), F.lit(" "))


def clean_text(text: Column, unescape: bool = True) -> Column:
    x = plain_spaces(html_unescape(text) if unescape else text)
    return strip(F.regexp_replace(F.regexp_replace(x, "[ \\t\\r\\f\\x0b]+", " "), "\\n+", "\n"))


def match_key(text: Column, unescape: bool = True) -> Column:
    """clean_text without any white space and with full-width colons: what coverage compares by."""
    return F.replace(F.regexp_replace(html_unescape(text) if unescape else text, "(?U)[\\s\\x1c-\\x1f]+", ""), F.lit(":"), F.lit("："))


def choice_markup(line: Column) -> Column:
    """剧情选项-图标-<kind>.png text -> [choice:<kind>] text"""
    pattern = "(?d)^剧情选项-图标-([^.\\s]+)\\.png(?U:\\s*)(.*)$"
    kind, text = F.regexp_extract(line, pattern, 1), strip(F.regexp_extract(line, pattern, 2))
    marked = F.concat(F.lit("[choice:"), kind, F.lit("]"))
    return F.when(line.rlike(pattern), F.when(text == "", marked).otherwise(F.concat(marked, F.lit(" "), text))).otherwise(line)


def _single_spaces(line: Column) -> Column:
    """Runs of spaces and tabs as one space; a single space is no match."""
    return F.regexp_replace(line, "\\t[ \\t]*| [ \\t]+", " ")


def clean_line(raw: Column) -> Column:
    line = plain = strip(raw)
    for pattern in INLINE_IMAGES:
        line = F.regexp_replace(line, pattern, "")
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | raw.contains(mark)
    return F.when(marked, strip(_single_spaces(choice_markup(line)))).otherwise(_single_spaces(plain))


def is_dropped(line: Column) -> Column:
    return (line == "") | line.isin(UI_WORDS) | line.rlike(IMAGE_LINE)


def choice_kind(line: Column) -> Column:
    return F.when(line.rlike(CHOICE), strip(F.regexp_extract(line, CHOICE, 1)))


def choice_text(line: Column) -> Column:
    return F.when(line.rlike(CHOICE), strip(F.regexp_extract(line, CHOICE, 2)))


def spoken(line: Column) -> Column:
    """struct(name, text) of a spoken line, else null: at most 32 characters before the first colon. No pattern is
    tried, as most lines have no colon."""
    narrow, wide = F.instr(line, ":"), F.instr(line, "：")
    at = F.least(F.when(narrow > 0, narrow), F.when(wide > 0, wide))
    name = strip(F.substring(line, F.lit(1), at - 1))
    rest = F.ltrim(F.substring(line, at + 1, F.length(line)), F.lit(SPACES))
    text = strip(rest)
    good = (at > 1) & (at <= 33) & (name != "") & (text != "") & ~name.contains("\n") & ~name.startswith("[choice") & ~F.regexp_replace(rest, "\\n$", "").contains("\n")
    return F.when(good, F.struct(name.alias("name"), text.alias("text")))


def speaker_name(line: Column) -> Column:
    return spoken(line)["name"]


def speaker_text(line: Column) -> Column:
    return spoken(line)["text"]


def any_prefix(line: Column, prefixes: list[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | line.startswith(p)
    return out


def line_kind(line: Column, said: Column | None = None) -> Column:
    """choice, dialogue, meta, heading or text; said is spoken(line), where it is known."""
    return (
        F.when(line.rlike(CHOICE), "choice")
        .when((spoken(line) if said is None else said).isNotNull(), "dialogue")
        .when(any_prefix(line, META_PREFIXES), "meta")
        .when(line.isin(HEADINGS) | line.startswith(EXTRA_HEADING), "heading")
        .otherwise("text")
    )


def line_text(line: Column, said: Column | None = None) -> Column:
    return F.coalesce(choice_text(line), (spoken(line) if said is None else said)["text"], line)


def is_standalone_speaker(line: Column, hinted: Column) -> Column:
    """hinted: whether the line is one of the document's speaker names."""
    out = hinted & ~line.isin(HEADINGS) & ~any_prefix(line, META_PREFIXES) & ~line.startswith("[choice:") & (F.length(line) <= 16)
    return out & ~line.rlike("[:：，。？！；、]|[。！？…」）]$") & line.rlike("[\\u4e00-\\u9fffA-Za-z]")


def is_dialogue_payload(line: Column, hinted: Column) -> Column:
    return (line != "") & ~line.startswith("[choice:") & ~line.isin(HEADINGS) & ~any_prefix(line, META_PREFIXES) & ~is_standalone_speaker(line, hinted)


def strip_tags(text: Column) -> Column:
    return strip(html_unescape(F.regexp_replace(text, "<[^>]+>", "")))


def looks_like_html(text: Column) -> Column:
    return F.substring(text, 1, 4096).rlike("(?i)<(?:html|body|div|span|p|table|script|article)\\b")


def _none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def page_title(page: Column, site_suffix: str = "_BWIKI") -> Column:
    patterns = ["(?is)<meta\\s+property=[\"']og:title[\"']\\s+content=[\"']([^\"']+)[\"']", "(?is)<h1[^>]*id=[\"']firstHeading[\"'][^>]*>(.*?)</h1>", "(?is)<title[^>]*>(.*?)</title>"]
    found = [_none_if_empty(strip(F.regexp_replace(strip_tags(F.regexp_extract(page, p, 1)), f"{site_suffix}.*$", ""))) for p in patterns]
    return F.coalesce(*found, F.lit(""))


def infobox_field(page: Column, field: str) -> Column:
    cell = F.regexp_extract(page, f"(?is)<th[^>]*>\\s*\\Q{field}\\E\\s*</th>\\s*<td[^>]*>(.*?)</td>", 1)
    return _none_if_empty(strip(F.regexp_replace(strip_tags(cell), "(?U)\\s+", " ")))


def page_source_url(page: Column, page_prefix: str) -> Column:
    """og:url, else the canonical link, else the wgPageName under page_prefix."""
    og = _none_if_empty(F.regexp_extract(page, "(?i)<meta\\s+property=[\"']og:url[\"']\\s+content=[\"']([^\"']+)[\"']", 1))
    canonical = _none_if_empty(F.regexp_extract(page, "(?i)<link\\s+rel=[\"']canonical[\"']\\s+href=[\"']([^\"']+)[\"']", 1))
    name = _none_if_empty(F.regexp_extract(page, "\"wgPageName\"\\s*:\\s*\"([^\"]+)\"", 1))
    return F.coalesce(html_unescape(F.coalesce(og, canonical)), F.concat(F.lit(page_prefix), F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))))


def normalize_url(url: Column) -> Column:
    """Without parameters of the last path segment and without fragment."""
    return F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "^([^?]*/[^?;/]*);[^?]*", "$1")


#: Parts of a reference: scheme, host with port and user, path, query.
REFERENCE = "(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#.*)?$"
GOOD_HOST = "^[^\\[\\]]*(?:\\[[0-9A-Fa-f:.]+\\](?::\\d*)?)?$"


def _folded(segments: Column) -> Column:
    """A path's segments with . and .. taken out from the left, as one path."""
    none = F.array().cast("array<string>")
    step = F.aggregate(segments, none, lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x)))
    path = F.array_join(F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(step, F.lit(""))).otherwise(step), "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def resolver(host: str | None, path_prefix: str):
    """A function (href, base) -> absolute URL, null for fragments and for other hosts or paths.

    References are joined as browsers do, by expressions only: white space before it and line ends inside go, dot
    segments are folded, parameters of the last segment and fragments are dropped. path_prefix starts with '/'; a
    reference of another scheme needs a host; a host in bad brackets gives null.
    """

    def split(x: Column) -> Column:
        """The parts of reference and base, each computed once."""
        plain = F.regexp_replace(F.regexp_replace(x["href"], "^[\\x00-\\x20]+", ""), "[\\t\\r\\n]", "")
        names = ["scheme", "netloc", "raw", "query"]
        parts = [F.regexp_extract(plain, REFERENCE, k).alias(n) for k, n in enumerate(names, 1)]
        return F.struct((~x["href"].startswith("#")).alias("open"), *parts, *[F.regexp_extract(x["base"], REFERENCE, k).alias(f"b_{n}") for k, n in enumerate(names, 1)])

    def join(x: Column) -> Column:
        scheme, netloc, raw, query, b_netloc, b_raw, b_query = (x[n] for n in ("scheme", "netloc", "raw", "query", "b_netloc", "b_raw", "b_query"))
        scheme, b_scheme = F.lower(scheme), F.lower(x["b_scheme"])
        path, b_path = (F.regexp_replace(p, ";[^/]*$", "") for p in (raw, b_raw))
        # The base's folder and the reference's segments, without the empty ones in between.
        b_parts = F.split(b_raw, "/")
        folder = F.when(F.element_at(b_parts, -1) == "", b_parts).otherwise(F.slice(b_parts, F.lit(1), F.greatest(F.size(b_parts) - 1, F.lit(0))))
        below = bound(F.concat(folder, F.split(path, "/")), lambda p: F.concat(F.slice(p, 1, 1), F.filter(F.slice(p, F.lit(2), F.greatest(F.size(p) - 2, F.lit(0))), lambda y: y != ""), F.slice(p, -1, 1)))
        joined = F.when((path == "") & (raw == ""), b_path).otherwise(bound(F.when(path.startswith("/"), F.split(path, "/")).otherwise(below), _folded))
        away = netloc != ""  # a host of its own
        own = F.when((raw == "") & (query == ""), b_query).otherwise(query)
        return F.struct(
            (x["open"] & (away | (scheme == "") | (scheme == b_scheme))).alias("known"),
            F.when(scheme == "", b_scheme).otherwise(scheme).alias("scheme"),
            F.when(away, netloc).otherwise(b_netloc).alias("host"),
            F.when(away, path).otherwise(joined).alias("path"),
            F.when(away, query).otherwise(own).alias("query"),
        )

    def write(x: Column) -> Column:
        good = x["known"] & x["path"].startswith(path_prefix) & x["host"].rlike(GOOD_HOST) & (x["host"] != "")
        if host is not None:
            good &= x["host"] == host
        return F.when(good, F.concat(x["scheme"], F.lit("://"), x["host"], x["path"], F.when(x["query"] != "", F.concat(F.lit("?"), x["query"])).otherwise(F.lit(""))))

    def resolve(href: Column, base: Column) -> Column:
        return bound(F.struct(href.alias("href"), base.alias("base")), lambda x: bound(split(x), lambda y: bound(join(y), write)))

    return resolve


def version_parts(version: Column) -> Column:
    """The first dotted number as integers; null without one."""
    found = F.regexp_extract(version, "\\d+(?:\\.\\d+)*", 0)
    return F.when(found != "", F.transform(F.split(found, "\\."), lambda x: x.try_cast("long")))


def version_key(version: Column, width: int = 6) -> Column:
    """Parts padded with zeros to one length, so that arrays compare as versions do: 3 = 3.0."""
    parts = version_parts(version)
    return F.slice(F.concat(parts, F.array_repeat(F.lit(0).cast("long"), width)), 1, F.greatest(F.lit(width), F.size(parts)))


def classify_version(version: Column, low: Column, high: Column) -> Column:
    """low <= version < high; a null bound is open."""
    v, a, z = version_key(version), version_key(low), version_key(high)
    return F.when(v.isNull(), "version_unknown").when(a.isNotNull() & (v < a), "skipped_by_min_version").when(z.isNotNull() & (v >= z), "skipped_by_max_version").otherwise("in_range")


def safe_file_name(name: Column, longest: int = 100, squeeze: bool = True) -> Column:
    out = F.regexp_replace(name, "[^\\p{L}\\p{N}\\-_.]", "_")
    if squeeze:
        out = F.regexp_replace(out, "_+", "_")
    return F.substring(F.regexp_replace(out, "^[._]+|[._]+$", ""), 1, longest)


def cache_name(url: Column) -> Column:
    return F.concat(F.substring(F.regexp_replace(url, "[^a-zA-Z0-9._-]+", "_"), 1, 180), F.lit(".html"))


def page_stem(index: Column, version: Column, title: Column) -> Column:
    return F.concat_ws("_", F.format_string("%03d", index), version, safe_file_name(title))


def markdown_plain_text(text: Column) -> Column:
    for pattern, to in [("(?s)<!--.*?-->", ""), ("\\*\\*([^*]+)\\*\\*[：:]", "$1："), ("(?m)^\\s*[-*]\\s+", ""), ("(?m)^\\s*>\\s+", ""), ("(?m)^#{1,6}\\s*", ""), ("`([^`]+)`", "$1")]:
        text = F.regexp_replace(text, pattern, to)
    return text


def is_skipped_markdown(line: Column) -> Column:
    fixed = line.isin("", ">", "›", "## 剧情内容", "- 回复：", "回复：")
    return fixed | any_prefix(line, ["<!--", "# ", "> Generated", "> 选项组", "- Source:", "- Version:"]) | line.endswith("回复：无额外文本") | line.contains("回复：未在 HTML 中找到对应 content 块")


#: Kind and pattern of a Markdown line's payload; the first that matches counts.
MARKDOWN_ITEMS = [("markdown_dialogue_text", "^-\\s+\\*\\*[^*]+\\*\\*[：:]\\s*(.+)$"), ("markdown_option", "^-\\s+选项\\s+\\d+（[^）]*）：(.+)$"), ("markdown_heading", "^#{2,6}\\s+(.+)$"), ("markdown_text", "^-\\s+(.+)$")]


def markdown_item(line: Column) -> Column:
    """struct(kind, text) of a stripped Markdown line."""
    kind, text = F.lit("markdown_text"), F.regexp_replace(line, "^\\s*>\\s+", "")
    for name, pattern in reversed(MARKDOWN_ITEMS):
        kind = F.when(line.rlike(pattern), F.lit(name)).otherwise(kind)
        text = F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1)).otherwise(text)
    return F.struct(kind.alias("kind"), text.alias("text"))


def snippet(text: Column, longest: int = 130) -> Column:
    clean = strip(F.regexp_replace(text, "(?U)\\s+", " "))
    return F.when(F.length(clean) > longest, F.concat(F.substring(clean, 1, longest), F.lit("..."))).otherwise(clean)


def strip_bracketed(text: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(text, "\\([^)]*\\)", ""), "（[^）]*）", "")
    return strip(F.regexp_replace(out, "(?U)\\s+", " "))


def map_or_self(value: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[value], value) if pairs else value


def parse_cast(line: Column, prefix: str = "出场人物") -> Column:
    """Distinct names after the prefix, in order."""
    rest = F.when(line.startswith(prefix), F.substring(line, len(prefix) + 1, 1 << 30)).otherwise(line)
    return F.array_distinct(F.filter(F.split(rest, "(?U)\\s+"), lambda x: x != ""))


def source_title(index: Column, value: Column) -> Column:
    path = F.regexp_replace(F.regexp_replace(value, "^[a-zA-Z]+://[^/?#]*", ""), "[?#].*$", "")
    leaf = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    host = F.regexp_extract(value, "^[a-zA-Z]+://([^/?#]*)", 1)
    return F.concat(F.format_string("%02d", index), F.lit(" "), F.when(leaf == "", host).otherwise(F.url_decode(leaf)))


def content_charset(header: Column) -> Column:
    return F.coalesce(_none_if_empty(F.regexp_extract(header, "(?i)charset=([\\w\\-]+)", 1)), F.lit("utf-8"))
