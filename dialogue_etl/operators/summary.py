"""Navigation summaries of Markdown files: headers, speakers, headings, theme anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_etl.functions import text as T

NOT_SPEAKERS = ["旁白", "系统", "选项", "奖励", "获得物品"]
NO_TITLE, NO_VERSION, NO_SOURCE, NO_SPEAKER = "未识别标题", "unknown", "未记录", "未识别"
# The usual themes and their patterns.
THEMES = {
    "世界观要点": "翁法罗斯|轮回|火种|泰坦|半神|再创世|权杖|铁墓|毁灭|负世|岁月|记忆|忘却|流光忆庭|神权|命途|冥界|冥河|死亡|塞纳托斯|玻吕|浮黎|博识尊",
    "关系变化": "伙伴|同伴|朋友|信任|保护|牺牲|告别|重逢|拥抱|体温|愿望|承诺|谢谢|抱歉|对不起|一起|同行|开拓者|丹恒|三月七|长夜月|昔涟|白厄|遐蝶|阿格莱雅|刻律德菈|海瑟音|来古士|赞达尔",
    "遐蝶 roleplay 相关信息": "遐蝶|死亡|冥河|冥界|塞纳托斯|玻吕|入殓|哀地里亚|奥赫玛|阿格莱雅|拥抱|体温|安提灵|缇安|缇宝|万敌|白厄|花海|灵魂",
    "易错点/待复核点": "不是|并非|不复存在|真相|误会|混淆|欺骗|篡改|忘却|无法|只有|敌人|代价|牺牲|我不是|她不是|这件事，从来没有发生过",
}
DIALOGUE_LINE = "^(?U:\\s*)-(?U:\\s+)\\*\\*(.+?)\\*\\*："


def page_header(lines: DataFrame) -> DataFrame:
    """(source, title, version, source_path): the first line of each form, or a fixed word."""
    out = []
    for name, pattern, none in (("title", "^#(?U:\\s+)(.+?)(?U:\\s*)$", NO_TITLE), ("version", "^(?U:\\s*)-(?U:\\s*)Version:(?U:\\s*)(.+?)(?U:\\s*)$", NO_VERSION), ("source_path", "^(?U:\\s*)-(?U:\\s*)Source:(?U:\\s*)(.+?)(?U:\\s*)$", NO_SOURCE)):
        hit = F.col("line").rlike(pattern)
        out.append(F.coalesce(F.min_by(F.when(hit, T.strip(F.regexp_extract("line", pattern, 1))), F.when(hit, F.col("line_no"))), F.lit(none)).alias(name))
    return lines.groupBy("source").agg(*out)


def speaker_stats(names: DataFrame, top: int | None = 12) -> DataFrame:
    """(source, speaker, n, place) of rows (source, speaker), most frequent first, ties in zh-Hans order."""
    counted = names.filter(F.col("speaker").isNotNull() & ~F.col("speaker").isin(NOT_SPEAKERS)).groupBy("source", "speaker").agg(F.count("*").alias("n"))
    ranked = counted.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), F.collate("speaker", "zh_Hans"), "speaker")))
    return ranked if top is None else ranked.filter(F.col("place") <= top)


def markdown_speakers(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("line").rlike(DIALOGUE_LINE)).select("source", T.strip(F.regexp_extract("line", DIALOGUE_LINE, 1)).alias("speaker"))


def key_speakers(stats: DataFrame, pages: DataFrame, top: int = 5) -> DataFrame:
    """(source, speakers): the leading names in order, or a fixed word for pages without any."""
    listed = stats.filter(F.col("place") <= top).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("place", "speaker"))).alias("s"))
    joined = F.array_join(F.transform("s", lambda x: x["speaker"]), "、")
    return pages.select("source").distinct().join(listed, "source", "left").select("source", F.coalesce(joined, F.lit(NO_SPEAKER)).alias("speakers"))


def section_headings(lines: DataFrame, top: int = 16) -> DataFrame:
    """(source, place, heading) of the first headings of level 2 to 4, as L<line>: H<level> title."""
    pattern = "^(#{2,4})(?U:\\s+)(.+?)(?U:\\s*)$"
    title = T.strip(F.regexp_extract("line", pattern, 2))
    found = lines.filter(F.col("line").rlike(pattern)).filter(title != "剧情内容")
    label = F.concat(F.lit("L"), "line_no", F.lit(": H"), F.length(F.regexp_extract("line", pattern, 1)), F.lit(" "), title)
    rows = found.select("source", label.alias("heading"), F.row_number().over(Window.partitionBy("source").orderBy("line_no")).alias("place"))
    return rows.filter(F.col("place") <= top)


def theme_anchors(lines: DataFrame, themes: dict[str, str] | None = None, top: int = 10) -> DataFrame:
    """(source, theme, place, line_no, anchor): for each theme the first lines that match its pattern.

    A line may hit several themes; the themes are tested in one pass, and the row limit of each group is
    applied before the shuffle by Spark's window group limit.
    """
    hits = F.array_compact(F.array(*[F.when(F.col("line").rlike(p), F.lit(name)) for name, p in (themes or THEMES).items()]))
    rows = lines.select("source", "line_no", "line", F.explode(hits).alias("theme")).filter(T.strip(F.col("line")) != "")
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("source", "theme").orderBy("line_no"))).filter(F.col("place") <= top)
    return rows.select("source", "line_no", T.snippet(F.col("line")).alias("anchor"), "theme", "place")


def line_counts(lines: DataFrame) -> DataFrame:
    """(source, dialogue_lines, choice_groups) of rendered Markdown."""
    return lines.groupBy("source").agg(F.count_if(F.col("line").rlike(DIALOGUE_LINE)).alias("dialogue_lines"), F.count_if(F.col("line").rlike("^>(?U:\\s+)选项组(?U:\\s+)\\d+")).alias("choice_groups"))


def summary_documents(lines: DataFrame, themes: dict[str, str] | None = None) -> DataFrame:
    """(source, text): each file's summary with its facts, leading speakers, headings and anchors of every theme."""
    named = list((themes or THEMES).items())
    none = F.array().cast("array<string>")

    def listed(rows: DataFrame, line: Column, name: str, order: str) -> DataFrame:
        return rows.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x["l"]).alias(name))

    speakers = listed(speaker_stats(markdown_speakers(lines)), F.concat(F.lit("- "), "speaker", F.lit("："), "n", F.lit(" 行")), "speakers", "place")
    headings = listed(section_headings(lines), F.concat(F.lit("- "), "heading"), "headings", "place")
    anchors = theme_anchors(lines, themes)
    found = anchors.groupBy("source").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("theme") == t, F.struct("line_no", "anchor")))), lambda x: F.concat(F.lit("- L"), x["line_no"], F.lit(": "), x["anchor"])).alias(f"theme{k}") for k, (t, _) in enumerate(named)])
    rows = page_header(lines).join(line_counts(lines), "source")
    for part in (speakers, headings, found):
        rows = rows.join(part, "source", "left")

    def block(title: str, items: str, empty: str) -> list[Column]:
        return [F.array(F.lit(f"## {title}"), F.lit("")), F.when(F.size(F.coalesce(items, none)) > 0, F.col(items)).otherwise(F.array(F.lit(empty))), F.array(F.lit(""))]

    facts = [F.concat(F.lit("# "), "title"), F.lit(""), F.lit("## 基本信息"), F.lit("")]
    facts += [F.concat(F.lit(f"- {name}："), F.col(c).cast("string")) for name, c in (("原始静态页", "source_path"), ("所属版本", "version"), ("章节名", "title"), ("对话行数", "dialogue_lines"), ("选项组数", "choice_groups"))]
    parts = [F.array(*facts, F.lit("")), *block("关键角色", "speakers", "- 未自动识别到对话角色；需要人工阅读原文。"), *block("章节结构索引", "headings", "- 未自动识别到章节结构。")]
    for k, (theme, _) in enumerate(named):
        parts += block(theme, f"theme{k}", "- 未自动抽取到明显锚点；需要人工阅读原文确认。")
    return rows.select("source", F.rtrim(F.array_join(F.concat(*parts), "\n"), F.lit("\n")).alias("text"))
