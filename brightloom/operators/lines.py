"""Records from the lines of a document: sections, key/value lines, education, training
and work entries.

Windows run per document. A document's lines come from one text value, so a window holds
what already fitted in one row. Records that span rows of a table (turns of a
conversation) go through ``running_totals`` instead, whose groups may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.functions.text import extract_year
from brightloom.operators.ordering import running_totals

# Section headers in the order they are tried, and line patterns.
SECTIONS: list[tuple[str, str]] = [
    ("BACKGROUND", r"(?i)^BACKGROUND$"),
    ("FORMAL_EDUCATION", r"(?i)^FORMAL\s+EDUCATION$"),
    ("NON_FORMAL_EDUCATION", r"(?i)^NON[-–]?\s*FORMAL\s*/\s*INFORMAL\s+EDUCATION"),
    ("TECHNICAL_SKILL", r"(?i)^TECHNICAL\s+SKILL"),
    ("OTHER_SKILLS", r"(?i)^Other\s+skills"),
    ("WORKING_EXPERIENCES", r"(?i)^WORKING\s+EXPERIENCES?$"),
    ("PROJECT_EXPERIENCE", r"(?i)^PROJECT\s+EXPERIENCE$"),
]
INSTITUTION = r"^(.+?)\s+\(([^)]*)\)\s+(\d{4})\s*[-–]\s*(\d{4}|\w+)\s*$"
DEGREE = r"^(.+?)\s+\(([^)]+)\)\s*$"
TRAINING_DATES = r"^([A-Za-z]{2,9}\.?\s*\d{4})\s*[-–]\s*([A-Za-z]{2,9}\.?\s*\d{4}|[A-Za-z]+)\s*$"
TRAINING_PROVIDER = r"(?i)^On\s+(.+)$"
JOB_LABEL = r"(?i)^Job\s+description\s*:?\s*$"
TITLE = r"^(.+?)\s+[-–]\s+(.+)$"
PROJECT_TITLE = r"^(.+?)\s*[-–,]\s*(.+)$"
PROJECT_LABELS = {
    "role": r"(?i)^Role\s*:", "description": r"(?i)^Description\s*:", "responsibility": r"(?i)^Responsibilit(?:y|ies)\s*:",
    "tools": r"(?i)^Tools?\s*:", "team": r"(?i)^Team\s+members?\s*:",
}
KEY_VALUES = r"^(.+?)\s*:\s*(.*)$"


def explode_lines(df: DataFrame, key: str, text: str, separator: str = "\n") -> DataFrame:
    return df.select(key, F.posexplode(F.split(text, separator)).alias("line_no", "line"))


def _per_doc(key: str):
    return Window.partitionBy(key).orderBy("line_no")


def tag_sections(lines: DataFrame, key: str, sections: list[tuple[str, str]] = SECTIONS) -> DataFrame:
    """Each line with the section its last header opened; header lines are marked."""
    header = F.coalesce(*[F.when(F.col("line").rlike(p), F.lit(name)) for name, p in sections])
    upto = _per_doc(key).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("_h", header).withColumns({
        "section": F.last("_h", True).over(upto), "is_header": F.col("_h").isNotNull(),
    }).drop("_h")


def key_values(lines: DataFrame, keep: list[str]) -> DataFrame:
    """``key: v1, v2`` lines as (category, values); lines without a value give nothing."""
    parts = F.split(F.regexp_extract("line", KEY_VALUES, 2), "[,，]")
    values = F.filter(F.transform(parts, lambda v: F.regexp_replace(F.trim(v), r"^:\s*", "")), lambda v: v != "")
    category = F.trim(F.regexp_extract("line", KEY_VALUES, 1))
    return lines.filter(F.col("line").rlike(KEY_VALUES)).select(*keep, category.alias("category"), values.alias("values")).filter(
        (F.col("category") != "") & (F.size("values") > 0))


def _odd_in_run(flag: Column, key: str) -> tuple[dict[str, Column], Column]:
    """In a run of flagged lines every second one is taken up by the line before it."""
    w = _per_doc(key)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    marks = {"_flag": F.coalesce(flag, F.lit(False)), "_run": F.sum((~F.coalesce(flag, F.lit(False))).cast("int")).over(upto)}
    place = F.row_number().over(Window.partitionBy(key, "_run", "_flag").orderBy("line_no"))
    return marks, F.col("_flag") & (place % 2 == 1)


def education(tagged: DataFrame, key: str) -> DataFrame:
    """Institution line and the degree line under it."""
    marks, start = _odd_in_run(
        (F.col("section") == "FORMAL_EDUCATION") & ~F.col("is_header") & F.col("line").rlike(INSTITUTION), key)
    w = _per_doc(key)
    nxt = F.when(~F.lead("is_header").over(w), F.lead("line").over(w))
    rows = tagged.withColumns(marks).withColumns({"_start": start, "_next": nxt}).filter("_start")

    def part(i: int) -> Column:
        return F.trim(F.regexp_extract("line", INSTITUTION, i))

    paired = F.col("_next").rlike(DEGREE)
    return rows.select(
        key, "line_no", part(1).alias("institution"), F.concat_ws("-", part(3), part(4)).alias("year"),
        F.coalesce(F.when(paired, F.trim(F.regexp_extract("_next", DEGREE, 1))).otherwise(F.trim("_next")), F.lit("")).alias("degree"),
        F.coalesce(F.when(paired, F.trim(F.regexp_extract("_next", DEGREE, 2))), F.lit("")).alias("major"))


def _records(tagged: DataFrame, key: str, section: str, start: Column) -> DataFrame:
    """Lines of a section grouped under their start line: (key, rec, pos, line, …)."""
    inside = tagged.filter((F.col("section") == section))
    # a header inside ends the record before it: lines before the next start are dropped
    upto = _per_doc(key).rowsBetween(Window.unboundedPreceding, 0)
    numbered = inside.withColumn("_s", (start & ~F.col("is_header")).cast("int")).withColumns({
        "rec": F.sum("_s").over(upto), "_block": F.sum(F.col("is_header").cast("int")).over(upto)})
    first_block = F.first("_block").over(Window.partitionBy(key, "rec").orderBy("line_no"))
    pos = F.row_number().over(Window.partitionBy(key, "rec").orderBy("line_no"))
    return numbered.withColumns({"_b": first_block, "pos": pos}).filter(
        (F.col("rec") > 0) & (F.col("_block") == F.col("_b")) & ~F.col("is_header")).drop("_s", "_b", "_block")


def trainings(tagged: DataFrame, key: str) -> DataFrame:
    """Date line, then name lines and an ``On <provider>`` line, up to the next date."""
    rec = _records(tagged, key, "NON_FORMAL_EDUCATION", F.col("line").rlike(TRAINING_DATES))
    is_on = F.col("line").rlike(TRAINING_PROVIDER)
    body = F.col("pos") > 1
    name = F.array_sort(F.collect_list(F.when(body & ~is_on, F.struct("pos", "line"))))
    head = F.max(F.when(F.col("pos") == 1, F.col("line")))
    provider = F.max_by(F.regexp_extract("line", TRAINING_PROVIDER, 1), F.when(body & is_on, F.col("pos")))
    out = rec.groupBy(key, "rec").agg(
        F.array_join(F.transform(name, lambda x: x["line"]), " ").alias("name"),
        F.coalesce(F.when(F.max((body & is_on).cast("int")) == 1, F.trim(provider)), F.lit("")).alias("provider"), head.alias("_head"))
    end, begin = (extract_year(F.regexp_extract("_head", TRAINING_DATES, i)) for i in (2, 1))
    return out.filter("name <> ''").select(
        key, "rec", "name", "provider", F.when(end != "", end).otherwise(begin).alias("year"))


def work_entries(tagged: DataFrame, key: str) -> DataFrame:
    """Period line, title line, then bullets up to the next period. The lists hold the
    lines of one document's entry."""
    period = F.col("line").rlike(r"\b\d{4}\b") & F.col("line").rlike("[-–]")
    marks, start = _odd_in_run((F.col("section") == "WORKING_EXPERIENCES") & ~F.col("is_header") & period, key)
    marked = tagged.withColumns(marks).withColumn("_start", start).drop("_flag", "_run")
    rec = _records(marked, key, "WORKING_EXPERIENCES", F.col("_start"))
    title = F.max(F.when(F.col("pos") == 2, F.col("line")))
    bullets = F.array_sort(F.collect_list(F.when((F.col("pos") > 2) & ~F.col("line").rlike(JOB_LABEL), F.struct("pos", "line"))))
    out = rec.groupBy(key, "rec").agg(
        F.max(F.when(F.col("pos") == 1, F.col("line"))).alias("period"), title.alias("_t"),
        F.transform(bullets, lambda x: x["line"]).alias("bullets")).filter("_t IS NOT NULL")
    split = F.col("_t").rlike(TITLE)
    rest = F.regexp_extract("_t", TITLE, 2)
    return out.select(
        key, "rec", "period",
        F.when(split, F.trim(F.regexp_extract("_t", TITLE, 1))).otherwise(F.col("_t")).alias("position"),
        F.when(split, F.trim(F.regexp_extract(rest, "^([^,]*)", 1))).otherwise("").alias("company"),
        F.when(split, F.trim(F.regexp_extract(rest, "^[^,]*,(.+)$", 1))).otherwise("").alias("location"), "bullets")


def row_records(rows: DataFrame, key: str, order: str, start: Column, measures: dict[str, Column]) -> DataFrame:
    """Rows of a table grouped under their start row, folded to ``measures``. Rows before
    the first start have no record."""
    numbered = running_totals(rows.withColumn("_s", start.cast("int")), [F.col(order)], {"rec": "_s"}, [key])
    return numbered.filter("rec > 0").groupBy(key, "rec").agg(*[c.alias(n) for n, c in measures.items()])


def _looks_like_period(line: Column) -> Column:
    return line.rlike(r"\b\d{4}\b") & line.rlike("[-–]")


def project_records(df: DataFrame, key: str, lines: str, sections: list[tuple[str, str]] = SECTIONS) -> DataFrame:
    """Projects from the array of a document's lines: (key, position, name, client, period,
    role, responsibility, tools).

    The array is read once from front to back inside its row; what is carried along is the
    open section, the open project and the finished ones, so lines are neither exploded nor
    shuffled. In the project section a title line (two parts around a dash or comma) opens a
    project; then come a period and labelled lines in any order; another line with a dash
    closes the project and may open the next; any other line goes on with the description. A
    header ends project and section. Null lines are skipped; null arrays have no projects.
    """
    texts = ["name", "client", "period", "role", "description", "responsibility", "tools"]

    def told(line: Column) -> Column:
        header = F.coalesce(*[F.when(line.rlike(p), F.lit(name)) for name, p in sections])
        label = F.coalesce(*[F.when(line.rlike(p), F.lit(name)) for name, p in PROJECT_LABELS.items()])
        return F.struct(line.alias("line"), header.alias("header"), label.alias("label"), line.rlike("[-–]").alias("dash"),
                        _looks_like_period(line).alias("period"), line.rlike(PROJECT_TITLE).alias("title"),
                        F.trim(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1)).alias("value"))

    blank = F.struct(*[F.lit("").alias(c) for c in texts])
    none = F.array().cast(f"array<struct<{','.join(f'{c}:string' for c in texts)}>>")
    start = F.struct(F.lit(None).cast("string").alias("section"), F.lit(False).alias("open"), blank.alias("now"), none.alias("done"))

    def step(acc: Column, x: Column) -> Column:
        now, is_open = acc["now"], acc["open"]
        inside = x["header"].isNull() & acc["section"].eqNullSafe(F.lit("PROJECT_EXPERIENCE"))
        labelled = inside & x["label"].isNotNull()
        takes_period = inside & is_open & ~labelled & x["period"] & (now["period"] == "")
        turns = inside & ~labelled & ~takes_period & (~is_open | x["dash"])  # the project, if any, is over
        opens = turns & x["title"]
        goes_on = inside & is_open & ~labelled & ~takes_period & ~turns
        closes = is_open & (turns | x["header"].isNotNull())
        fields = {
            "name": F.when(opens, F.trim(F.regexp_extract(x["line"], PROJECT_TITLE, 1))),
            "client": F.when(opens, F.trim(F.regexp_extract(x["line"], PROJECT_TITLE, 2))),
            "period": F.when(opens, "").when(takes_period, x["line"]),
            "description": F.when(opens, "").when(goes_on, F.when(now["description"] == "", x["line"]).otherwise(F.concat(now["description"], F.lit(" "), x["line"]))),
        }
        for c in texts:
            filled = fields.get(c, F.when(opens, ""))
            if c in PROJECT_LABELS:
                filled = filled.when(labelled & is_open & (x["label"] == c), x["value"])
            fields[c] = filled.otherwise(now[c])
        return F.struct(
            F.coalesce(x["header"], acc["section"]).alias("section"), F.when(closes | turns, opens).otherwise(is_open).alias("open"),
            F.struct(*[fields[c].alias(c) for c in texts]).alias("now"),
            F.when(closes, F.array_append(acc["done"], now)).otherwise(acc["done"]).alias("done"))

    def finish(acc: Column) -> Column:
        return F.when(acc["open"], F.array_append(acc["done"], acc["now"])).otherwise(acc["done"])

    known = F.transform(F.filter(lines, lambda x: x.isNotNull()), told)
    found = df.select(key, F.aggregate(known, start, step, finish).alias("found"))
    rows = found.select(key, F.posexplode("found").alias("at", "p"))
    whole = F.concat_ws(" ", *[F.nullif(F.col(f"p.{c}"), F.lit("")) for c in ("description", "responsibility")])
    return rows.select(key, (F.col("at") + 1).alias("position"), "p.name", "p.client", "p.period", "p.role", whole.alias("responsibility"), "p.tools")
