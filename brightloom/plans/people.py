"""People records, nested lists and text, from customers, orders, documents and turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions import text as tx
from brightloom.functions.periods import parse_period
from brightloom.operators import lines as ln
from brightloom.operators import people as pp
from brightloom.plans.registry import Tables, query

DOC_LINES = "ls AS (SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"
NORM = r"trim(strip_accents(regexp_replace(regexp_replace(regexp_replace(lower({0}), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'), '[.,/#!$%^&*;:{{}}=\-_`~()]', '', 'g')))"


@query("text_normalize_name", f"WITH {DOC_LINES} SELECT doc_id, line_no, {NORM.format('line')} AS name_key FROM ls")
def _(t):
    return ln.explode_lines(t.documents, "doc_id", "text").select("doc_id", "line_no", tx.normalize_name(F.col("line")).alias("name_key"))


@query("text_helpers", """SELECT o_orderkey, concat_ws(' | ', nullif(trim(o_orderpriority), ''), CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, c_name) AS joined,
  upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS titled, CASE WHEN length(c_name) <= 12 THEN c_name ELSE substr(c_name, 1, 11) || '…' END AS shortened,
  CAST(year(o_orderdate) AS VARCHAR) AS found_year, monthname(o_orderdate) || ', ' || year(o_orderdate) AS updated
FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return df.select(
        "o_orderkey", tx.join_non_empty([F.col("o_orderpriority"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.lit(" "), F.col("c_name")], " | ").alias("joined"),
        tx.title_case(F.lower("c_mktsegment")).alias("titled"), tx.truncate(F.col("c_name"), 12).alias("shortened"),
        tx.extract_year(F.concat(F.lit("ordered "), F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("found_year"),
        tx.month_year(F.col("o_orderdate")).alias("updated"))


ID_MONTHS = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]


def period_texts(t: Tables) -> DataFrame:
    """Order dates written as periods in several forms."""
    d = F.col("o_orderdate")
    month = F.element_at(F.array(*[F.lit(m) for m in ID_MONTHS]), F.month(d))
    later = F.element_at(F.array(*[F.lit(m) for m in ID_MONTHS]), F.month(F.add_months(d, 2)))
    year = F.year(d).cast("string")
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", "  ")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(month, F.lit(" "), year, F.lit(" – "), later))
        .when(F.col("o_orderstatus") == "O", F.concat(F.date_format(d, "MMM yyyy"), F.lit(" – Now")))
        .when(F.col("o_orderstatus") == "F", F.concat(month, F.lit(" "), year, F.lit(" — "), later, F.lit(". "), F.year(F.add_months(d, 2)).cast("string")))
        .otherwise(F.concat(year, F.lit(" - "), (F.year(d) + 2).cast("string")))
    )
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", text.alias("period"))


@query("text_period_parse", """
WITH d AS (SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS s, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(o_orderdate + INTERVAL 2 MONTH AS DATE) AS l FROM orders)
SELECT o_orderkey, CASE WHEN p = '5-LOW' THEN NULL WHEN p = '4-NOT SPECIFIED' OR s IN ('O', 'F') THEN make_date(y, m, 1) ELSE make_date(y, 1, 1) END AS start_date,
  CASE WHEN p = '5-LOW' THEN NULL WHEN p = '4-NOT SPECIFIED' THEN make_date(y, CAST(month(l) AS INTEGER), 1) WHEN s = 'O' THEN NULL WHEN s = 'F' THEN CAST(date_trunc('month', l) AS DATE) ELSE make_date(y + 2, 1, 1) END AS end_date,
  p NOT IN ('5-LOW', '4-NOT SPECIFIED') AND s = 'O' AS is_ongoing FROM d""", days=["start_date", "end_date"])
def _(t):
    return period_texts(t).select("o_orderkey", parse_period(F.col("period")).alias("p")).select("o_orderkey", "p.*")


AS_OF = "2002-01-01"


@query("cv_years", f"""WITH s AS (SELECT o_custkey, min(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' OR o_orderstatus IN ('O', 'F') THEN date_trunc('month', o_orderdate) ELSE date_trunc('year', o_orderdate) END)
  FILTER (WHERE o_orderpriority <> '5-LOW') AS d FROM orders GROUP BY 1)
SELECT o_custkey, CAST(floor(date_diff('day', CAST(d AS DATE), DATE '{AS_OF}') / 365.25) AS BIGINT) AS years FROM s""")
def _(t):
    return pp.years_of_experience(period_texts(t), "o_custkey", "period", F.lit(AS_OF).cast("date"))


@query("cv_infer_provider", f"""WITH {DOC_LINES} SELECT doc_id, line_no, CASE WHEN length(trim(line)) <= 40 AND NOT regexp_matches(line, '[.!?]') THEN trim(line) ELSE '' END AS provider FROM ls""")
def _(t):
    return ln.explode_lines(t.documents, "doc_id", "text").select("doc_id", "line_no", tx.infer_provider(F.col("line")).alias("provider"))


@query("cv_priority_merge", f"""
WITH f AS (SELECT * FROM customer WHERE c_acctbal > 4000), o AS (SELECT * FROM customer WHERE c_nationkey <= 12)
SELECT {NORM.format('c.c_name')} AS person, coalesce(f.c_name, c.c_name) AS name, CASE WHEN f.c_custkey IS NOT NULL THEN 'form' ELSE 'folder' END AS name_source,
  coalesce(CASE WHEN f.c_mktsegment <> 'BUILDING' THEN f.c_mktsegment END, 'former ' || o.c_mktsegment, '-') AS position,
  CASE WHEN f.c_mktsegment <> 'BUILDING' THEN 'form' WHEN o.c_custkey IS NOT NULL THEN 'existing_cv' ELSE 'default' END AS position_source,
  coalesce(CASE WHEN o.c_acctbal > 0 THEN 'English' END, 'Indonesian') AS languages, CASE WHEN o.c_acctbal > 0 THEN 'existing_cv' ELSE 'default' END AS languages_source
FROM customer c LEFT JOIN f USING (c_custkey) LEFT JOIN o USING (c_custkey)""")
def _(t):
    c = t.customer
    folder = c.select(F.concat(F.lit(" "), F.upper("c_name")).alias("key"), F.col("c_name").alias("name"))
    form = c.filter("c_acctbal > 4000").select(F.concat(F.col("c_name"), F.lit(".")).alias("key"), F.col("c_name").alias("name"),
                                               F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment")).alias("position"))
    old = c.filter("c_nationkey <= 12").select(F.col("c_name").alias("key"), F.concat(F.lit("former "), "c_mktsegment").alias("position"),
                                               F.when(F.col("c_acctbal") > 0, "English").otherwise("").alias("languages"))
    return pp.priority_merge({"folder": (folder, "key"), "form": (form, "key"), "existing_cv": (old, "key")}, {
        "name": pp.FieldRule(("form", "folder", "existing_cv")),
        "position": pp.FieldRule(("form", "existing_cv"), "-"),
        "languages": pp.FieldRule(("form", "existing_cv"), "Indonesian"),
    })


def trainings(t: Tables, sheet: bool) -> DataFrame:
    """Lines with flag A stand for the sheet, all others for the form."""
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    return t.lineitem.filter((F.col("l_returnflag") == "A") == sheet).join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_suppkey", F.col("p_name").alias("name"), F.year("l_shipdate").alias("year"), F.col("p_brand").alias("provider"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("pos"))


@query("cv_training_dedupe", """
WITH u AS (SELECT l_suppkey, p_name AS name, CAST(year(l_shipdate) AS VARCHAR) AS y, p_brand AS provider, l_returnflag = 'A' AS src, l_orderkey, l_linenumber, l_partkey, l_quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_suppkey, name AS name_key, y AS year, CASE WHEN src THEN name || ' Certificate' ELSE name END AS name, provider, CASE WHEN src THEN 'certification' ELSE 'training' END AS type
FROM (SELECT l_suppkey, CASE WHEN src THEN name || ' certificate' ELSE name END AS k, * FROM u) QUALIFY row_number() OVER (PARTITION BY l_suppkey, k, y ORDER BY src, l_orderkey, l_linenumber, l_partkey, l_quantity) = 1""".replace(
    "name AS name_key", "k AS name_key"))
def _(t):
    form = trainings(t, False).withColumn("name", F.concat(F.lit("  "), F.upper("name")))
    sheet = trainings(t, True).select("l_suppkey", F.concat("name", F.lit(" Certificate")).alias("name"), "year", F.col("provider").alias("output"), "pos")
    out = pp.merge_trainings(form, sheet, "l_suppkey")
    return out.withColumn("name", F.when(F.col("type") == "training", F.lower(F.trim("name"))).otherwise(F.col("name")))


@query("cv_project_order", """
WITH p AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 90 DAY AS DATE) END AS end_date, o_orderstatus = 'O' AS is_ongoing FROM orders)
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY is_ongoing DESC, coalesce(end_date, start_date) * 1 DESC, start_date DESC, o_orderkey) AS position FROM
  (SELECT o_custkey, o_orderkey, is_ongoing, date_diff('day', DATE '1970-01-01', CASE WHEN is_ongoing THEN DATE '1970-01-01' ELSE coalesce(end_date, start_date) END) AS end_date, date_diff('day', DATE '1970-01-01', start_date) AS start_date FROM p)""")
def _(t):
    p = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("start_date"),
                        F.when(F.col("o_orderstatus") == "F", F.date_add(F.to_date("o_orderdate"), 90)).alias("end_date"),
                        (F.col("o_orderstatus") == "O").alias("is_ongoing"))
    return pp.order_projects(p, "o_custkey", ["o_orderkey"]).select("o_custkey", "o_orderkey", "position")


HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query("cv_best_candidate", f"""
WITH c AS (SELECT {HOST} AS host, url, split_part(url, ':', 1) AS kind, page_id, CASE WHEN url LIKE '%/en/%' THEN 'form' WHEN regexp_matches(url, '/(fr|de)/') THEN 'existing_cv' END AS role FROM pages WHERE url NOT LIKE '%#top%')
SELECT host, role, url, kind FROM c WHERE role IS NOT NULL QUALIFY row_number() OVER (PARTITION BY host, role ORDER BY kind <> 'https', page_id) = 1""")
def _(t):
    files = t.pages.select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), "url", F.split("url", ":")[0].alias("kind"), "page_id")
    return pp.best_candidates(files, "host", "url", "kind", "page_id", "https", form="/en/", cv="/(fr|de)/", identity="#top")


@query("cv_additive_sync", """
SELECT c_name AS name, c_acctbal > 0 AS flag FROM customer WHERE c_nationkey < 10
UNION ALL SELECT ' ' || upper(c_name), false FROM customer WHERE c_nationkey >= 10""")
def _(t):
    existing = t.customer.filter("c_nationkey < 10").select(F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("flag"))
    found = t.customer.select(F.concat(F.lit(" "), F.upper("c_name")).alias("name"))
    return pp.additive_sync(existing, found, "name", "flag")


@query("cv_run_summary", """
WITH r AS (SELECT CASE WHEN o.k IS NULL THEN 'SKIPPED' WHEN c_acctbal < 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN o.k IS NOT NULL AND c_acctbal < 0 THEN 'negative balance for ' || c_name END AS error FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON o.k = c_custkey)
SELECT status, count(*) AS items, min(error) AS first_error FROM r GROUP BY status""")
def _(t):
    has = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    c = t.customer.join(has, "c_custkey", "left")
    bad = F.col("has").isNotNull() & (F.col("c_acctbal") < 0)
    return pp.run_summary(c.select(
        F.when(F.col("has").isNull(), "SKIPPED").when(F.col("c_acctbal") < 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(bad, F.concat(F.lit("negative balance for "), "c_name")).alias("error")))


# Items as a sheet has them: texts, some of which cannot be read.
RUN_TEXTS = {
    "balance_text": "CASE WHEN c_custkey % 11 = 0 THEN 'n/a ' || c_name WHEN c_custkey % 17 <> 3 THEN CAST(c_acctbal AS STRING) END",
    "since_text": "CASE WHEN c_custkey % 13 = 0 THEN '2020-13-01' ELSE '2020-0' || CAST(1 + c_custkey % 9 AS STRING) || '-15' END",
}
RUN_LOG = f"""r AS (SELECT c_name, {', '.join(f'{x} AS {n}' for n, x in RUN_TEXTS.items())}, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS skip FROM customer),
e AS (SELECT *, nullif(concat_ws('; ', CASE WHEN balance_text IS NOT NULL AND TRY_CAST(balance_text AS DOUBLE) IS NULL THEN 'balance: cannot read ''' || balance_text || ''' as double' END,
  CASE WHEN TRY_CAST(since_text AS DATE) IS NULL THEN 'since: cannot read ''' || since_text || ''' as date' END, CASE WHEN balance_text IS NULL THEN 'balance: missing' END), '') AS err FROM r),
log AS (SELECT c_name, CASE WHEN skip THEN 'SKIPPED' WHEN err IS NOT NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN NOT skip THEN err END AS error,
  CASE WHEN NOT skip AND err IS NULL THEN TRY_CAST(balance_text AS DOUBLE) END AS balance, CASE WHEN NOT skip AND err IS NULL THEN TRY_CAST(since_text AS DATE) END AS since FROM e)"""


def run_log(t: Tables) -> DataFrame:
    has = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    items = t.customer.join(has, "c_custkey", "left").select("c_name", "has", *[F.expr(x).alias(n) for n, x in RUN_TEXTS.items()])
    return pp.run_items(items, "c_name", F.col("has").isNull(), {"balance": ("balance_text", "double"), "since": ("since_text", "date")}, ["balance"])


@query("cv_run_items", f"WITH {RUN_LOG} SELECT * FROM log", days=["since"])
def _(t):
    return run_log(t)


@query("cv_run_counts", f"WITH {RUN_LOG} SELECT status, count(*) AS items, min(error) AS first_error FROM log GROUP BY status")
def _(t):
    return pp.run_summary(run_log(t))


@query("log_retention", "SELECT event_id, event_type, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 2000")
def _(t):
    return pp.retain_newest(t.events, [F.desc("ts"), F.desc("event_id")]).select("event_id", "event_type", "user_id")


@query("cv_group_unpivot", """
SELECT l_orderkey, l_linenumber AS group_no, CAST(min(l_partkey) AS VARCHAR) AS name, CAST(max(CAST(l_quantity AS INTEGER)) AS VARCHAR) AS quantity, any_value(CASE WHEN l_linenumber <= 3 THEN 'x' END) AS mark
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def _(t):
    # A wide sheet: id, then one (item, quantity[, mark]) block per line number.
    aggs, headers = [], ["Order"]
    for n in range(1, 8):
        here = F.col("l_linenumber") == n
        aggs += [F.min(F.when(here, F.col("l_partkey"))).alias(f"Item {n}"), F.max(F.when(here, F.col("l_quantity").cast("int"))).alias(f"Quantity ({n})")]
        headers += [f"Item {n}", f"Quantity ({n})"]
        if n <= 3:
            aggs.append(F.max(F.when(here, "x")).alias(f"Mark {n}"))
            headers.append(f"Mark {n}")
    wide = t.lineitem.groupBy("l_orderkey").agg(*aggs)
    groups = pp.detect_groups(headers, r"^Item\s+\d", {"name": r"^Item", "quantity": r"^Quantity", "mark": r"^Mark"})
    return pp.unpivot_groups(wide, ["l_orderkey"], groups)


CHOSEN = ["The", "And", "La", "De", "Of"]
SKILLS = ["the", "la", "und", "of the"]
NESTED_SQL = f"""n AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_extract(x, '^(\\w+)', 1)), lambda x: list_contains({CHOSEN}, x)) AS projects,
  list_filter(list_transform(string_split(text, chr(10)), lambda x: {{'category': regexp_extract(x, '^(\\w+)', 1), 'vals': list_filter(list_transform(string_split(x, ','), lambda y: trim(y)), lambda y: list_contains({SKILLS}, y))}}), lambda g: len(g.vals) > 0) AS skills FROM documents)"""


def nested(t: Tables) -> DataFrame:
    """Each document's lines as nested entries."""
    ls = F.split("text", "\n")
    first = r"^([A-Za-z0-9_]+)"
    return t.documents.select(
        "doc_id", F.transform(ls, lambda x: F.struct(F.regexp_extract(x, first, 1).alias("name"), F.length(x).alias("size"))).alias("projects"),
        F.transform(ls, lambda x: F.struct(F.regexp_extract(x, first, 1).alias("category"), F.transform(F.split(x, ","), lambda y: F.trim(y)).alias("values"))).alias("skills"),
        F.array().cast("array<struct<name:string>>").alias("trainings"))


@query("cv_nested_filter", f"WITH {NESTED_SQL} SELECT doc_id, CAST(len(projects) AS INTEGER) AS projects, array_to_string(projects, ',') AS project_names, CAST(len(skills) AS INTEGER) AS skill_groups FROM n")
def _(t):
    kept = pp.select_nested(nested(t), CHOSEN, SKILLS, [])
    return kept.select("doc_id", F.size("projects").alias("projects"), F.array_join("projects.name", ",").alias("project_names"), F.size("skills").alias("skill_groups"))


@query("cv_flat_skills", f"WITH {NESTED_SQL}, g AS (SELECT doc_id, unnest(skills) AS s FROM n) SELECT doc_id, s.category AS category, unnest(s.vals) AS skill FROM g")
def _(t):
    return pp.flatten_skills(pp.select_nested(nested(t), skills=SKILLS), "doc_id")


HEADERS = [("LONG", "^The "), ("LIST", "^(And|Of) "), ("END", "^(Was|Is) ")]


@query("cv_section_lines", f"""WITH {DOC_LINES}, h AS (SELECT *, CASE WHEN regexp_matches(line, '^The ') THEN 'LONG' WHEN regexp_matches(line, '^(And|Of) ') THEN 'LIST' WHEN regexp_matches(line, '^(Was|Is) ') THEN 'END' END AS h FROM ls)
SELECT doc_id, line_no, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section, h IS NOT NULL AS is_header FROM h""")
def _(t):
    return ln.tag_sections(ln.explode_lines(t.documents, "doc_id", "text"), "doc_id", HEADERS).select("doc_id", "line_no", "section", "is_header")


@query("cv_key_values", """
WITH k AS (SELECT page_id, unnest(regexp_extract_all(html, '([a-z]+="[^"]*")', 1)) AS line FROM pages), v AS (
SELECT page_id, split_part(line, '=', 1) AS category, list_filter(list_transform(string_split(replace(split_part(line, '"', 2), '/', ','), ','), lambda x: trim(x)), lambda x: x <> '') AS vals FROM k)
SELECT page_id, category, array_to_string(vals, '|') AS "values", count(*) AS n FROM v WHERE len(vals) > 0 GROUP BY ALL""")
def _(t):
    attrs = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('([a-z]+="[^"]*")'), 1)).alias("a"))
    lines = attrs.select("page_id", F.concat(F.regexp_extract("a", "^([a-z]+)=", 1), F.lit(" : "), F.translate(F.regexp_extract("a", '"([^"]*)"', 1), "/", ",")).alias("line"))
    return ln.key_values(lines, ["page_id"]).groupBy("page_id", "category", F.array_join("values", "|").alias("values")).agg(F.count(F.lit(1)).alias("n"))


@query("cv_line_records", """
WITH r AS (SELECT conv_id, turn, role, text, sum(CAST(role = 'user' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn) AS rec FROM conversations)
SELECT conv_id, CAST(rec AS BIGINT) AS rec, arg_min(text, turn) AS question, count(*) - 1 AS answers, CAST(sum(length(text)) AS BIGINT) AS chars, max(turn) AS last_turn
FROM r WHERE rec > 0 GROUP BY conv_id, rec""")
def _(t):
    return ln.row_records(t.conversations, "conv_id", "turn", F.col("role") == "user", {
        "question": F.min_by("text", "turn"), "answers": F.count(F.lit(1)) - 1, "chars": F.sum(F.length("text")), "last_turn": F.max("turn")})


def cv_texts(t: Tables) -> DataFrame:
    """A short CV per customer, written from the table's values."""
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", F.array(
            F.lit("BACKGROUND"), F.concat(F.lit("Name: "), name), F.lit("FORMAL EDUCATION"),
            F.concat("n_name", F.lit(" ("), "r_name", F.lit(") 2001 - 2005")),
            F.when(F.col("c_acctbal") > 0, F.concat(seg, F.lit(" ("), name, F.lit(")"))).otherwise(seg),
            F.lit("NON-FORMAL/INFORMAL EDUCATION"), F.lit("Mar 2010 - Apr 2011"), F.concat(seg, F.lit(" course")), F.lit("On Spark Academy"), F.lit("part two"),
            F.lit("May 2012 – Sekarang"), name, F.lit("WORKING EXPERIENCES"), F.lit("Jan 2013 – Now"),
            F.concat(seg, F.lit(" – "), "n_name", F.lit(", "), "r_name"), F.lit("Job description:"), F.concat(F.lit("served "), name), F.lit("closed books"),
            F.lit("2007 - 2012"), F.concat(F.lit("Clerk "), name),
        ).alias("ls")).select("c_custkey", F.posexplode("ls").alias("line_no", "line"))


@query("cv_education", """SELECT c_custkey, n_name AS institution, '2001-2005' AS year, c_mktsegment AS degree, CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END AS major
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    return ln.education(ln.tag_sections(cv_texts(t), "c_custkey"), "c_custkey").drop("line_no")


@query("cv_trainings", """SELECT c_custkey, 1::BIGINT AS rec, c_mktsegment || ' course part two' AS name, 'Spark Academy' AS provider, '2011' AS year FROM customer
UNION ALL SELECT c_custkey, 2, c_name, '', '2012' FROM customer""")
def _(t):
    return ln.trainings(ln.tag_sections(cv_texts(t), "c_custkey"), "c_custkey")


@query("cv_work", """SELECT c_custkey, 1::BIGINT AS rec, 'Jan 2013 – Now' AS period, c_mktsegment AS position, n_name AS company, r_name AS location, 'served ' || c_name || '; closed books' AS bullets
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT c_custkey, 2, '2007 - 2012', 'Clerk ' || c_name, '', '', '' FROM customer""")
def _(t):
    return ln.work_entries(ln.tag_sections(cv_texts(t), "c_custkey"), "c_custkey").withColumn("bullets", F.array_join("bullets", "; "))


#: Lines of a CV by the customer's values; both engines read these expressions. Null lines are left out.
CV_LINES = [
    "'BACKGROUND'", "'Name: ' || c_name", "CASE WHEN c_custkey % 7 <> 0 THEN 'PROJECT EXPERIENCE' END",
    "c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' – ' ELSE ', ' END || c_name", "CASE WHEN c_custkey % 3 <> 0 THEN 'Mar 2017 – Now' END",
    "CASE WHEN c_custkey % 4 <> 1 THEN 'Role : lead - ' || c_name END", "CASE WHEN c_acctbal > 3000 THEN 'Description: in ' || c_mktsegment END",
    "CASE WHEN c_acctbal < 6000 THEN 'kept ' || c_name || ' going' END", "CASE WHEN c_custkey % 5 = 0 THEN 'Team Members: 4' END",
    "CASE WHEN c_custkey % 3 = 1 THEN 'Responsibilities: all of ' || c_mktsegment END", "CASE WHEN c_custkey % 10 <> 4 THEN 'tools: Spark, SQL' END",
    "CASE WHEN c_custkey % 2 = 1 THEN 'Second one - client ' || c_mktsegment END", "CASE WHEN c_custkey % 6 = 5 THEN '2010 - 2014' END",
    "CASE WHEN c_custkey % 6 = 5 THEN '2015 - 2016' END", "CASE WHEN c_custkey % 9 = 2 THEN '- ' END", "CASE WHEN c_custkey % 9 = 2 THEN 'stray line' END",
    "CASE WHEN c_custkey % 4 <> 2 THEN 'TECHNICAL SKILL' END", "'Spark - very good'", "CASE WHEN c_custkey % 8 = 3 THEN 'Project  Experience' END",
    "CASE WHEN c_custkey % 8 = 3 THEN 'Back again, client' END",
]


def _either(patterns) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(line, '{p}') THEN '{name}'" for name, p in patterns) + " END"


# The rules again, line by line: what a line does hangs on the state that the lines before it left.
PROJECTS = f"""WITH RECURSIVE cv AS (SELECT c_custkey, list_filter([{', '.join(CV_LINES)}], lambda x: x IS NOT NULL) AS ls FROM customer),
l AS (SELECT c_custkey, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM cv),
k AS (SELECT *, {_either(ln.SECTIONS)} AS header, {_either(ln.PROJECT_LABELS.items())} AS label, regexp_matches(line, '[-–]') AS dash, regexp_matches(line, '{ln.PROJECT_TITLE}') AS title,
  regexp_matches(line, '\\b\\d{{4}}\\b') AND regexp_matches(line, '[-–]') AS dated FROM l),
s AS (SELECT c_custkey, 0::BIGINT AS n, ''::VARCHAR AS section, false AS op, false AS has, 0 AS rec, ''::VARCHAR AS act FROM cv UNION ALL
  SELECT c_custkey, n, section, CASE act WHEN 'head' THEN false WHEN 'turn' THEN title ELSE op END, CASE act WHEN 'turn' THEN false WHEN 'period' THEN true ELSE has END,
    CASE WHEN act = 'turn' AND title THEN rec + 1 ELSE rec END, CASE WHEN act = 'turn' AND title THEN 'open' WHEN act IN ('period', 'text', 'label') AND op THEN act ELSE '' END
  FROM (SELECT k.c_custkey, k.n, coalesce(header, section) AS section, op, has, rec, title, CASE WHEN header IS NOT NULL THEN 'head' WHEN section <> 'PROJECT_EXPERIENCE' THEN '' WHEN label IS NOT NULL THEN 'label'
    WHEN op AND NOT has AND dated THEN 'period' WHEN NOT op OR dash THEN 'turn' ELSE 'text' END AS act FROM s JOIN k ON k.c_custkey = s.c_custkey AND k.n = s.n + 1)),
a AS (SELECT c_custkey, n, rec, act, line, label, trim(substr(line, strpos(line, ':') + 1)) AS value FROM s JOIN k USING (c_custkey, n) WHERE act <> '')
SELECT c_custkey, CAST(rec AS INTEGER) AS position, max(CASE WHEN act = 'open' THEN trim(regexp_extract(line, '{ln.PROJECT_TITLE}', 1)) END) AS name, max(CASE WHEN act = 'open' THEN trim(regexp_extract(line, '{ln.PROJECT_TITLE}', 2)) END) AS client,
  coalesce(max(CASE WHEN act = 'period' THEN line END), '') AS period, coalesce(max(CASE WHEN act = 'label' AND label = 'role' THEN value END), '') AS role,
  coalesce(string_agg(CASE WHEN act = 'text' THEN line WHEN act = 'label' AND label IN ('description', 'responsibility') THEN value END, ' ' ORDER BY coalesce(label, '') = 'responsibility', n), '') AS responsibility,
  coalesce(max(CASE WHEN act = 'label' AND label = 'tools' THEN value END), '') AS tools
FROM a GROUP BY c_custkey, rec"""


@query("cv_projects", PROJECTS)
def _(t):
    texts = t.customer.select("c_custkey", F.array(*[F.expr(x) for x in CV_LINES]).alias("lines"))
    return ln.project_records(texts, "c_custkey", "lines")
