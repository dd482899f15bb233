"""Queries of ordered lines, dialogue, summaries and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialogue_etl.functions import text as T
from dialogue_etl.operators import dialogue as D
from dialogue_etl.operators import evidence as E
from dialogue_etl.operators import lines as L
from dialogue_etl.operators import summary as S
from dialogue_etl.operators.scan import with_neighbours
from dialogue_etl.plans.shared import GRAPH, TRANSCRIPT, graph_nodes, query, save, table, transcripts
from dialogue_etl.sources import io as IO

C = F.col
DOC_LINES = "SELECT doc_id AS source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents"


def doc_lines(spark, sf):
    return L.numbered_lines(table(spark, sf, "documents"), "doc_id", "text")


def typed(spark, sf):
    return L.normalized(transcripts(spark, sf), unescape=False)


@query("d1_numbered_lines", f"SELECT source AS doc_id, CAST(max(line_no) AS INTEGER) AS lines, md5(string_agg(line, '|' ORDER BY line_no)) AS digest FROM ({DOC_LINES}) GROUP BY source")
def d1(spark, sf):
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "|")
    return doc_lines(spark, sf).groupBy(C("source").alias("doc_id")).agg(F.max("line_no").alias("lines"), F.md5(joined).alias("digest"))


@query(
    "d2_drop_consecutive_duplicates",
    f"SELECT source AS doc_id, count(*) AS kept FROM (SELECT source, x, lag(x) OVER (PARTITION BY source ORDER BY line_no) AS b FROM (SELECT source, line_no, trim(regexp_replace(line, '[ \\t]+', ' ', 'g')) AS x FROM ({DOC_LINES})) WHERE x <> '' AND NOT regexp_matches(x, '(?i)\\.(png|jpg|jpeg|gif|webp|svg)$')) WHERE b IS DISTINCT FROM x GROUP BY source",
)
def d2(spark, sf):
    return L.drop_consecutive_duplicates(L.kept_lines(doc_lines(spark, sf))).groupBy(C("source").alias("doc_id")).agg(F.count("*").alias("kept"))


SPEAKS = "'^([^:：]{1,32})[:：]\\s*(.+)$'"


@query(
    "d3_speaker_hints",
    TRANSCRIPT + f"""SELECT DISTINCT source, name FROM (SELECT source, unnest(['user', 'assistant', 'system', 'Extra']) AS name FROM head
    UNION ALL SELECT source, unnest({T.DEFAULT_SPEAKERS}) FROM head
    UNION ALL SELECT source, trim(regexp_extract(trim(raw), {SPEAKS}, 1)) FROM raw WHERE turn >= 0 AND regexp_matches(trim(raw), {SPEAKS})) WHERE name <> ''""",
)
def d3(spark, sf):
    """All names of each document: its cast, everyone who speaks in it, the known ones and an extra one."""
    lines = L.drop_consecutive_duplicates(L.kept_lines(L.numbered_lines(transcripts(spark, sf), unescape=False)))
    return L.speaker_hints(lines, [" Extra ", ""])


@query("d4_repair_speaker_pairs", TRANSCRIPT + "SELECT source, line_no, speaker || '：' || text AS line FROM said WHERE turn % 3 = 2")
def d4(spark, sf):
    lines = L.drop_consecutive_duplicates(L.kept_lines(L.numbered_lines(transcripts(spark, sf), unescape=False)))
    return L.repair_speaker_pairs(L.with_hint_flag(lines)).filter("merged").select("source", "line_no", "line")


@query(
    "d5_repair_markdown_pairs",
    """WITH t AS (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM conversations),
    x AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) AS n, line FROM (SELECT conv_id, turn, k + 1 AS k, l AS line FROM t UNION ALL SELECT conv_id, turn, unnest([0, 1]), unnest([role, '']) FROM conversations)),
    g AS (SELECT *, sum(CASE WHEN line <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY n) AS g FROM x),
    f AS (SELECT conv_id, g, n, line, line IN ('user', 'assistant', 'system') AS known, trim(line) <> '' AND NOT regexp_matches(trim(line), '^(#|-|>|<!--)') AND trim(line) NOT IN ('user', 'assistant', 'system') AS good FROM g WHERE line <> ''),
    s AS (SELECT *, known AND coalesce(lead(good) OVER w, false) AS starts, lead(line) OVER w AS following FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
    e AS (SELECT *, coalesce(lag(starts) OVER (PARTITION BY conv_id ORDER BY n), false) AS taken FROM s),
    o AS (SELECT conv_id, n, CASE WHEN starts THEN '- **' || trim(line) || '**：' || trim(following) ELSE line END AS line FROM e WHERE NOT taken UNION ALL SELECT g.conv_id, g.n, '' FROM g LEFT JOIN s ON s.conv_id = g.conv_id AND s.g = g.g WHERE g.line = '' AND NOT coalesce(s.starts, false))
    SELECT conv_id AS source, count(*) AS lines, md5(string_agg(line, '|' ORDER BY n)) AS digest FROM o GROUP BY conv_id""",
)
def d5(spark, sf):
    """Every turn as its role on a line of its own, a blank line and the turn's text."""
    turns = table(spark, sf, "conversations").filter("text IS NOT NULL")
    rows = turns.select(C("conv_id").alias("source"), "turn", F.posexplode(F.concat(F.array("role", F.lit("")), F.split("text", "\n"))).alias("k", "line"))
    rows = L.renumber(rows, ["source"], ["turn", "k"], "line_no").select("source", "line_no", "line")
    done = L.repair_markdown_pairs(rows, ["user", "assistant", "system"])
    return L.joined_text(done, ["source"], "line_no", "line").select("source", F.size(F.split("text", "\n")).cast("long").alias("lines"), F.md5(F.replace("text", F.lit("\n"), F.lit("|"))).alias("digest"))


@query(
    "d6_build_sections",
    TRANSCRIPT + "SELECT source, CAST(1 AS INTEGER) AS section_no, '剧情内容' AS title, CAST(1 AS INTEGER) AS start_line, '3.' || (conv_id % 8) AS version, 'task ' || conv_id AS description, 'user,assistant,system' AS cast_list FROM head WHERE sub = 1",
)
def d6(spark, sf):
    return L.build_sections(typed(spark, sf)).withColumn("cast_list", F.array_join("cast", ",")).drop("cast")


@query(
    "d7_section_for_line",
    "SELECT event_id, (SELECT max(p.ts) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts) AS last_purchase FROM events e",
)
def d7(spark, sf):
    events = table(spark, sf, "events")
    points = events.filter("event_type = 'purchase'").select("user_id", "ts", C("ts").alias("last_purchase"))
    return L.as_of(events.select("user_id", "ts", "event_id"), points, ["user_id"], "ts", "last_purchase").select("event_id", "last_purchase")


@query(
    "d7b_section_of_line",
    "SELECT source, CAST(2 * r AS INTEGER) AS line_no, 'Version 4.' || turn || ' section ' || r AS title FROM (SELECT conv_id AS source, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations)",
)
def d7b(spark, sf):
    """A section for every turn, and what is said under it looked up in the table of sections."""
    turns = L.renumber(table(spark, sf, "conversations").select(C("conv_id").alias("source"), "turn", "role"), ["source"], ["turn"], "r")
    both = F.array(F.concat(F.lit("所属版本 4."), "turn"), F.concat("role", F.lit("：said")))
    lines = L.classified(turns.select("source", "r", F.posexplode(both).alias("k", "line")).select("source", (2 * C("r") - 1 + C("k")).alias("line_no"), "line"))
    points = L.build_sections(lines).select("source", C("start_line").alias("line_no"), "title")
    return L.as_of(lines.select("source", "line_no", "speaker"), points, ["source"], "line_no", "title").filter("speaker IS NOT NULL").select("source", "line_no", "title")


@query("d8_renumber_groups", "SELECT conv_id, turn, printf('%03d-plot-%04d', conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)) AS group_id FROM conversations WHERE role = 'user'")
def d8(spark, sf):
    rows = L.renumber(table(spark, sf, "conversations").filter("role = 'user'"), ["conv_id"], ["turn"])
    return rows.select("conv_id", "turn", F.format_string("%03d-plot-%04d", "conv_id", "group_no").alias("group_id"))


@query(
    "d9_tidy_lines",
    f"""WITH l AS (SELECT source, line_no, line = '' AS blank, regexp_replace(line, '\\s+$', '') AS line FROM ({DOC_LINES})),
    k AS (SELECT source, line_no, line, min(CASE WHEN line <> '' THEN line_no END) OVER (PARTITION BY source) AS a, max(CASE WHEN line <> '' THEN line_no END) OVER (PARTITION BY source) AS z FROM (SELECT *, lag(blank) OVER (PARTITION BY source ORDER BY line_no) AS b FROM l) WHERE NOT (blank AND coalesce(b, false)))
    SELECT source AS doc_id, md5(string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM k WHERE line_no BETWEEN a AND z GROUP BY source""",
)
def d9(spark, sf):
    return L.joined_text(L.tidy_lines(doc_lines(spark, sf)), ["source"], "line_no", "line").select(C("source").alias("doc_id"), F.md5("text").alias("digest"))


@query(
    "d11_segmented_scan",
    """WITH e AS (SELECT row_number() OVER (ORDER BY event_id) AS n, event_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS v FROM events)
    SELECT event_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after, last_value(v IGNORE NULLS) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_value,
    first_value(v IGNORE NULLS) OVER (ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_value, CAST(count(v) OVER (ORDER BY n) AS BIGINT) AS so_far, max(v) OVER () AS most FROM e WINDOW w AS (ORDER BY n)""",
)
def d11(spark, sf):
    """All events as one long document, of which a task sees a thousand lines at a time."""
    lines = table(spark, sf, "events").select(F.lit("log").alias("source"), (C("event_id") + 1).alias("line_no"), "event_id", "event_type", F.when(C("event_type") == "purchase", C("value")).alias("v"))
    wanted = {"before": ("before", C("event_type")), "after": ("after", C("event_type")), "last_value": ("last_before", C("v")), "next_value": ("first_after", C("v")), "so_far": ("sum", C("v").isNotNull().cast("long")), "most": ("greatest", C("v"))}
    return with_neighbours(lines, wanted, segment=1000).drop("source", "line_no", "event_type", "v")


@query("f1_extract_dialogue", TRANSCRIPT + "SELECT source, line_no, speaker, text, '剧情内容' AS section_title, '3.' || (conv_id % 8) AS version FROM said WHERE speaker = 'user'")
def f1(spark, sf):
    return D.extract_dialogue(typed(spark, sf), ["user"])


@query("f2_dialogue_pipeline", TRANSCRIPT + "SELECT version, speaker, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM (SELECT '3.' || (conv_id % 8) AS version, speaker, text FROM said) GROUP BY version, speaker")
def f2(spark, sf):
    """HTML pages to dialogue rows: visible text, numbered lines, repair, sections, extraction."""
    from dialogue_etl.functions.pages import visible_text

    escaped = F.replace(F.replace("text", F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    pages = transcripts(spark, sf).select("source", F.concat(F.lit("<html><script>x</script><body><p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")), F.lit("</p></body></html>")).alias("html"))
    docs = pages.select("source", F.when(T.looks_like_html(C("html")), visible_text(C("html"))).otherwise(C("html")).alias("text"))
    return D.extract_dialogue(L.normalized(docs, unescape=False)).groupBy("version", "speaker").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("f3_kind_counts", TRANSCRIPT + "SELECT source, count(*) AS n_dialogue, CAST(0 AS BIGINT) AS n_choice, CAST(3 AS BIGINT) AS n_meta, CAST(1 AS BIGINT) AS n_heading, CAST(0 AS BIGINT) AS n_text FROM said GROUP BY source")
def f3(spark, sf):
    return D.kind_counts(typed(spark, sf))


@query(
    "a7_lines_to_text",
    TRANSCRIPT + f"SELECT source, md5('{IO.PARSED}## ' || upper(source) || chr(10) || chr(10) || '- Source: ' || source || chr(10) || '- Source type: text' || chr(10) || '- Parsed: 2024' || chr(10) || '- Sections: 1' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM (SELECT source, line_no, line FROM head UNION ALL SELECT source, line_no, speaker || '：' || text FROM said) GROUP BY source",
)
def a7(spark, sf):
    lines = typed(spark, sf)
    sources = lines.select("source").distinct().select("source", F.upper("source").alias("title"), F.lit("text").alias("kind"))
    return IO.parsed_documents(lines, sources, "2024").select("source", F.md5("text").alias("digest"))


@query("e9_bind_task_metadata", TRANSCRIPT + "SELECT source, line_no, CASE WHEN conv_id % 2 = 0 THEN 'Task ' || conv_id END AS task_title, CASE WHEN conv_id % 2 = 0 THEN '3.' || (conv_id % 8) END AS task_version FROM said")
def e9(spark, sf):
    conv = table(spark, sf, "conversations").filter("conv_id % 2 = 0").select("conv_id").distinct()
    tasks = conv.select(F.concat(F.lit("conv-"), "conv_id").alias("source"), F.concat(F.lit("Task "), "conv_id").alias("task_title"), F.concat(F.lit("3."), C("conv_id") % 8).alias("task_version"))
    return D.bind_metadata(D.extract_dialogue(typed(spark, sf)), tasks).select("source", "line_no", "task_title", "task_version")


# --- summaries over rendered Markdown: one file a conversation, one dialogue line a text line ---

MARKDOWN = """
WITH src AS (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM conversations),
body AS (SELECT conv_id, turn, k, CASE WHEN turn % 4 = 3 AND k = 1 THEN '### Part ' || turn WHEN turn % 4 = 2 AND k = 1 THEN '> 选项组 ' || turn || '：2 个选项' ELSE '- **' || role || '**：' || trim(l) END AS line FROM src WHERE trim(l) <> '' OR k = 1),
md AS (SELECT conv_id AS source, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) AS line_no, line FROM (SELECT * FROM body UNION ALL SELECT DISTINCT conv_id, -1, 1, '# Story ' || conv_id FROM conversations UNION ALL SELECT DISTINCT conv_id, -1, 2, '- Version: 3.' || (conv_id % 8) FROM conversations WHERE conv_id % 5 <> 0 UNION ALL SELECT DISTINCT conv_id, -1, 3, '## 剧情内容' FROM conversations)),
who AS (SELECT source, regexp_extract(line, '^- \\*\\*([^*]+)\\*\\*：', 1) AS speaker, count(*) AS n FROM md WHERE regexp_matches(line, '^- \\*\\*[^*]+\\*\\*：') GROUP BY 1, 2),
ranked AS (SELECT source, speaker, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, speaker) AS place FROM who)
"""


def markdown_lines(spark, sf):
    """(source, line_no, line): each conversation as a Markdown file."""
    conv = table(spark, sf, "conversations").filter("text IS NOT NULL")
    lines = conv.select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("k", "l")).filter("trim(l) <> '' OR k = 0")
    first = C("k") == 0
    line = F.when((C("turn") % 4 == 3) & first, F.concat(F.lit("### Part "), "turn")).when((C("turn") % 4 == 2) & first, F.concat(F.lit("> 选项组 "), "turn", F.lit("：2 个选项"))).otherwise(F.concat(F.lit("- **"), "role", F.lit("**："), F.trim("l")))
    body = F.array_sort(F.collect_list(F.struct("turn", "k", line.alias("line"))))
    head = F.array_compact(F.array(F.concat(F.lit("# Story "), "conv_id"), F.when(C("conv_id") % 5 != 0, F.concat(F.lit("- Version: 3."), C("conv_id") % 8)), F.lit("## 剧情内容")))
    files = lines.groupBy("conv_id").agg(body.alias("b")).select(C("conv_id").alias("source"), F.concat(head, F.transform("b", lambda x: x["line"])).alias("lines"))
    return files.select("source", F.posexplode("lines").alias("p", "line")).select("source", (C("p") + 1).alias("line_no"), "line")


@query("h1_page_header", "SELECT DISTINCT conv_id AS source, 'Story ' || conv_id AS title, CASE WHEN conv_id % 5 <> 0 THEN '3.' || (conv_id % 8) ELSE 'unknown' END AS version, '未记录' AS source_path FROM conversations")
def h1(spark, sf):
    return S.page_header(markdown_lines(spark, sf))


@query("h2_speaker_stats", MARKDOWN + "SELECT source, speaker, n, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 12")
def h2(spark, sf):
    return S.speaker_stats(S.markdown_speakers(markdown_lines(spark, sf)))


@query("h3_key_speakers", MARKDOWN + "SELECT m.source, coalesce(s, '未识别') AS speakers FROM (SELECT DISTINCT source FROM md) m LEFT JOIN (SELECT source, string_agg(speaker, '、' ORDER BY place) AS s FROM ranked WHERE place <= 5 GROUP BY source) r ON m.source = r.source")
def h3(spark, sf):
    lines = markdown_lines(spark, sf)
    return S.key_speakers(S.speaker_stats(S.markdown_speakers(lines)), lines)


@query("h4_section_headings", MARKDOWN + "SELECT source, 'L' || line_no || ': H3 ' || substr(line, 5) AS heading, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY line_no) AS place FROM md WHERE line LIKE '### %') WHERE place <= 16")
def h4(spark, sf):
    return S.section_headings(markdown_lines(spark, sf))


THEMES = {"place": "with|from|pour|von", "change": "tion|ción|ung", "check": "not|nicht|pas|que"}


@query(
    "h5_theme_anchors",
    "WITH l AS (" + DOC_LINES + "), s AS (SELECT source, line_no, line, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS x FROM l), h AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS theme, * FROM s WHERE regexp_matches(line, '{p}') AND x <> ''" for n, p in THEMES.items())
    + ") SELECT source, theme, CAST(line_no AS INTEGER) AS line_no, CASE WHEN length(x) > 130 THEN substr(x, 1, 130) || '...' ELSE x END AS anchor, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY source, theme ORDER BY line_no) AS place FROM h) WHERE place <= 10",
)
def h5(spark, sf):
    return S.theme_anchors(doc_lines(spark, sf), THEMES)


@query("h6_page_line_counts", MARKDOWN + "SELECT source, count(*) FILTER (WHERE regexp_matches(line, '^- \\*\\*[^*]+\\*\\*：')) AS dialogue_lines, count(*) FILTER (WHERE line LIKE '> 选项组 %') AS choice_groups FROM md GROUP BY source")
def h6(spark, sf):
    return S.line_counts(markdown_lines(spark, sf))


SUMMARY = MARKDOWN + "SELECT m.source, printf('%03d', m.source) AS number, 'Story ' || m.source AS title, CASE WHEN m.source % 5 <> 0 THEN '3.' || (m.source % 8) ELSE 'unknown' END AS version, 'summaries/' || m.source || '.md' AS link, coalesce(s, '未识别') AS speakers FROM (SELECT DISTINCT source FROM md) m LEFT JOIN (SELECT source, string_agg(speaker, '、' ORDER BY place) AS s FROM ranked WHERE place <= 5 GROUP BY source) r ON m.source = r.source"


def summary_index(spark, sf):
    lines = markdown_lines(spark, sf)
    rows = S.page_header(lines).join(S.key_speakers(S.speaker_stats(S.markdown_speakers(lines)), lines), "source")
    return rows.select("source", F.format_string("%03d", "source").alias("number"), "title", "version", F.concat(F.lit("summaries/"), "source", F.lit(".md")).alias("link"), "speakers")


@query("h7_summary_index", SUMMARY)
def h7(spark, sf):
    return summary_index(spark, sf).orderBy(F.collate("link", "zh_Hans_CHN"))


# --- evidence ---

CITED = """
WITH l AS (SELECT doc_id AS source, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no FROM documents),
cites AS (SELECT source, line_no, 'docs/' || (source // 2) || '.md' AS path, CAST(1 + (source + 7 * line_no) % 40 AS INTEGER) AS target_line FROM l WHERE line_no % 2 = 1
 UNION ALL SELECT source, line_no, 'docs/missing' || source || '.md', NULL FROM l WHERE line_no % 2 = 1 AND source % 9 = 0
 UNION ALL SELECT source, line_no, '/abs/' || source || '.md', 4 FROM l WHERE line_no % 2 = 1 AND source % 7 = 0),
files AS (SELECT 'docs/' || doc_id || '.md' AS path, max(len(string_split(text, chr(10)))) AS n_lines FROM documents GROUP BY doc_id)
"""


def cited_lines(spark, sf):
    """Every line of the documents; odd ones cite lines of other documents, missing files and absolute paths."""
    docs = table(spark, sf, "documents").select(C("doc_id").alias("source"), F.posexplode(F.split(F.replace("text", F.lit("`"), F.lit("'")), "\n")).alias("p", "own"))
    line_no = C("p") + 1
    one = F.concat(F.lit(" see `docs/"), F.expr("source div 2"), F.lit(".md:"), 1 + (C("source") + 7 * line_no) % 40, F.lit("` `verbatim` `code`"))
    two = F.when(C("source") % 9 == 0, F.concat(F.lit(" and `docs/missing"), "source", F.lit(".md` `inference`"))).otherwise(F.lit(""))
    three = F.when(C("source") % 7 == 0, F.concat(F.lit(" `/abs/"), "source", F.lit(".md:4`"))).otherwise(F.lit(""))
    return docs.select("source", line_no.alias("line_no"), F.when(line_no % 2 == 1, F.concat("own", one, two, three)).otherwise(C("own")).alias("line"))


@query("i1_extract_citations", CITED + "SELECT source, line_no, path, coalesce(target_line, 0) AS target_line FROM cites")
def i1(spark, sf):
    return E.citations(cited_lines(spark, sf)).fillna({"target_line": 0})


@query(
    "i2_resolve_citations",
    CITED + "SELECT c.source, c.line_no, c.path, coalesce(c.target_line, 0) AS target_line, CASE WHEN c.path LIKE '/%' THEN 'absolute' WHEN f.n_lines IS NULL THEN 'file' ELSE 'line' END AS reason FROM cites c LEFT JOIN files f ON c.path = f.path WHERE c.path LIKE '/%' OR f.n_lines IS NULL OR c.target_line > f.n_lines",
)
def i2(spark, sf):
    files = table(spark, sf, "documents").groupBy(F.concat(F.lit("docs/"), "doc_id", F.lit(".md")).alias("path")).agg(F.max(F.size(F.split("text", "\n"))).alias("n_lines"))
    return E.unresolved(E.citations(cited_lines(spark, sf)), files).fillna({"target_line": 0})


@query("i3_evidence_grades", CITED + "SELECT source, count(*) FILTER (WHERE line_no % 2 = 1) AS verbatim, CAST(0 AS BIGINT) AS artifact, CAST(0 AS BIGINT) AS impression, count(*) FILTER (WHERE line_no % 2 = 1 AND source % 9 = 0) AS inference FROM l GROUP BY source")
def i3(spark, sf):
    return E.evidence_grades(cited_lines(spark, sf))


@query(
    "i4_phase_tagging",
    GRAPH + "SELECT page_id, CASE WHEN page_id % 12 < 2 THEN 'early' WHEN page_id % 12 = 2 THEN 'netherworld' WHEN page_id % 12 < 5 THEN 'post_3.2' ELSE 'late' END AS phase, CAST(CASE WHEN page_id % 12 < 2 THEN 0 WHEN page_id % 12 = 2 THEN 1 WHEN page_id % 12 < 5 THEN 2 ELSE 3 END AS INTEGER) AS phase_rank FROM pg",
)
def i4(spark, sf):
    return E.phase_tagged(graph_nodes(spark, sf)).select("page_id", "phase", "phase_rank")


@query(
    "i4b_phase_intervals",
    GRAPH + """, ph AS (SELECT * FROM (VALUES ('early', 0, 0, 2), ('turn', 1, 1, 4), ('all', 2, 0, 8), ('late', 3, 7, 99), ('none', 4, 5, 5)) AS t(phase, phase_rank, low, high))
    SELECT page_id, phase, CAST(phase_rank AS INTEGER) AS phase_rank FROM pg JOIN ph ON page_id % 12 >= low AND page_id % 12 < high WHERE phase_rank <= 2""",
)
def i4b(spark, sf):
    """Pages with all phases that their version lies in, as far as the phase `all`; phases overlap, one is empty."""
    phases = E.phase_table(spark, [("early", None, "3.2"), ("turn", "3.1", "3.4"), ("all", "3", "3.8"), ("late", "3.7", None), ("none", "3.5", "3.5.0")])
    tagged = E.with_phases(graph_nodes(spark, sf), phases, save)
    return E.up_to_phase(tagged, phases, "all").select("page_id", "phase", "phase_rank")


@query("i5_exclude_sources", "SELECT coalesce(source, '-') AS source, count(*) AS n FROM documents WHERE source IS NULL OR source NOT IN ('src0', 'src3') GROUP BY source")
def i5(spark, sf):
    docs = table(spark, sf, "documents")
    return E.exclude_sources(docs, docs.filter(C("source").isin("src0", "src3")).select("source").distinct()).groupBy(F.coalesce("source", F.lit("-")).alias("source")).agg(F.count("*").alias("n"))


@query("i6_labelled_catalog", "SELECT lang AS label, min(source || '-' || doc_id) AS text, '【' || lang || '】' || min(source || '-' || doc_id) || '.wav' AS name FROM documents WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY lang")
def i6(spark, sf):
    name = F.when(C("doc_id") % 5 != 0, F.concat(F.lit("【"), "lang", F.lit("】"), "source", F.lit("-"), "doc_id", F.lit(".wav"))).otherwise(F.concat("source", F.lit(".wav")))
    return E.labelled_catalog(table(spark, sf, "documents").select(name.alias("name"))).orderBy("label")
