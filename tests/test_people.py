from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from brightloom.functions import text as tx
from brightloom.functions.periods import full_years, parse_period
from brightloom.operators import lines as ln
from brightloom.operators import people as pp


@pytest.mark.parametrize("text, want", [
    ("Mar 2017 – Now", (date(2017, 3, 1), None, True)),
    ("Maret 2020 – September 2020", (date(2020, 3, 1), date(2020, 9, 1), False)),
    ("Juli 2025 - Sekarang", (date(2025, 7, 1), None, True)),
    ("2010 - 2014", (date(2010, 1, 1), date(2014, 1, 1), False)),
    ("Sept. 2013 – Jan 2014", (date(2013, 9, 1), date(2014, 1, 1), False)),
    ("May 2025 – August", (date(2025, 5, 1), date(2025, 8, 1), False)),
    ("", (None, None, False)), (None, (None, None, False)), ("soon", (None, None, False)),
])
def test_periods(frame, text, want):
    assert tuple(frame([(text,)], "t string").select(parse_period(F.col("t")).alias("p")).select("p.*").first()) == want


def test_years(frame):
    df = frame([("a", "Mar 2017 – Now"), ("a", "2010 - 2014"), ("b", "?")], "who string, period string")
    got = pp.years_of_experience(df, "who", "period", F.lit("2020-06-01").cast("date"))
    assert rows(got, "who") == [("a", 10), ("b", None)]
    assert frame([(date(2019, 6, 2),)], "d date").select(full_years(F.col("d"), F.lit("2020-06-01").cast("date"))).first()[0] == 0


def test_text(frame):
    df = frame([("  José   ÁLVAREZ-Núñez. ",), (None,), ("a - b",)], "n string")
    assert [r[0] for r in df.select(tx.normalize_name(F.col("n"))).collect()] == ["jose alvareznunez", "", "a  b"]
    one = frame([("hello wOrld-x été", "Financial 2026 plan 12345", "Acme Academy")], "a string, b string, c string")
    r = one.select(tx.title_case(F.col("a")), tx.truncate(F.col("a"), 6), tx.extract_year(F.col("b")), tx.extract_year(F.col("c")),
                   tx.infer_provider(F.col("c")), tx.infer_provider(F.lit("It was fun.")),
                   tx.join_non_empty([F.lit(" x "), F.lit(" "), F.lit(None).cast("string"), F.lit("y")], "/"),
                   tx.month_year(F.lit("2026-05-23").cast("date"))).first()
    assert tuple(r) == ("Hello WOrld-X éTé", "hello…", "2026", "", "Acme Academy", "", "x/y", "May, 2026")


def test_priority(frame):
    form = frame([("Ann Lee", "Ann Lee", " ")], "k string, name string, position string")
    old = frame([("ann  lee.", "Analyst"), ("Bob", "Clerk")], "k string, position string")
    got = {r["person"]: r for r in pp.priority_merge({"form": (form, "k"), "old": (old, "k")}, {
        "name": pp.FieldRule(("form",), "-"), "position": pp.FieldRule(("form", "old"), "-")}).collect()}
    assert (got["ann lee"]["position"], got["ann lee"]["position_source"]) == ("Analyst", "old")
    assert (got["bob"]["name"], got["bob"]["name_source"]) == ("-", "default")


def test_trainings_keep_the_form_entry(frame):
    form = frame([("p", "Data  Course", "2020", "Org", 1)], "who string, name string, year string, provider string, pos int")
    sheet = frame([("p", "data course", "2020", "Skills gained. Many!", 1), ("p", "SQL Certification", "2021", "Vendor", 2)],
                  "who string, name string, year string, output string, pos int")
    got = rows(pp.merge_trainings(form, sheet, "who").select("name", "year", "provider", "type"), "year")
    assert got == [("Data  Course", "2020", "Org", "training"), ("SQL Certification", "2021", "Vendor", "certification")]


def test_project_order(frame):
    df = frame([("p", "old", date(2010, 1, 1), date(2011, 1, 1), False), ("p", "late start", date(2015, 1, 1), date(2016, 1, 1), False),
                ("p", "early start", date(2012, 1, 1), date(2016, 1, 1), False), ("p", "open", date(2009, 1, 1), None, True)],
               "who string, name string, start_date date, end_date date, is_ongoing boolean")
    got = [r["name"] for r in pp.order_projects(df, "who", ["name"]).orderBy("position").collect()]
    assert got == ["open", "late start", "early start", "old"]


def test_files_and_sync(frame):
    files = frame([("f", "KTP employee form.pdf", "gdoc", 1), ("f", "Employee Form.docx", "docx", 2), ("f", "employee form", "gdoc", 3),
                   ("f", "My CV.docx", "docx", 4), ("f", "curriculum vitae.docx", "docx", 5)], "o string, n string, k string, pos int")
    got = {r["role"]: r["n"] for r in pp.best_candidates(files, "o", "n", "k", "pos", "gdoc").collect()}
    assert got == {"form": "employee form", "existing_cv": "My CV.docx"}
    have = frame([("Ann Lee", True)], "name string, flag boolean")
    more = frame([(" ANN  lee",), ("Bob",)], "name string")
    assert rows(pp.additive_sync(have, more, "name", "flag"), "name") == [("Ann Lee", True), ("Bob", False)]


def test_wide_groups(frame):
    headers = ["Nama lengkap", "Nama klien", "Nama project", "Peran Kamu", "Nama klien", "Nama project", "Peran Kamu", "Nama Training / Sertifikasi", "Tahun Training"]
    groups = pp.detect_groups(headers, r"^Nama\s+klien$", {"client": r"^Nama\s+klien$", "name": r"^Nama\s+project$", "role": r"^Peran"}, stop="Nama Training")
    assert groups == [{"client": 1, "name": 2, "role": 3}, {"client": 4, "name": 5, "role": 6}]
    df = frame([("ann", "c1", "p1", "dev", "c2", " ", "", "t", "2020")], ", ".join(f"c{i} string" for i in range(9)))
    assert rows(pp.unpivot_groups(df, ["c0"], groups).select("c0", "group_no", "name", "role")) == [("ann", 1, "p1", "dev")]


CV = """Name: Ann
BACKGROUND
Name: Ann Lee
FORMAL EDUCATION
STATE UNIVERSITY (Bandung) 2001 - 2005
Bachelor (Physics)
CITY COLLEGE (Jakarta) 1998 – 2001
Diploma
NON-FORMAL/INFORMAL EDUCATION
Mar 2010 - Apr 2011
Spark course
On Data Academy
part two
May 2012 – Sekarang
TECHNICAL SKILL
Languages: Python, SQL , : R
BI Tools:
WORKING EXPERIENCES
Jan 2013 – Now
Engineer – Acme, Jakarta, Indonesia
Job description:
built things
2007 - 2012
Clerk"""


def test_cv_lines(frame):
    lines = ln.explode_lines(frame([("a", CV)], "doc string, text string"), "doc", "text")
    tagged = ln.tag_sections(lines, "doc").cache()
    assert tagged.filter("section IS NULL").count() == 1 and tagged.filter("is_header").count() == 5
    edu = rows(ln.education(tagged, "doc").select("institution", "year", "degree", "major", "line_no"), "line_no")
    assert [e[:4] for e in edu] == [("STATE UNIVERSITY", "2001-2005", "Bachelor", "Physics"), ("CITY COLLEGE", "1998-2001", "Diploma", "")]
    assert rows(ln.trainings(tagged, "doc").select("name", "provider", "year")) == [("Spark course part two", "Data Academy", "2011")]
    skills = ln.key_values(tagged.filter("section = 'TECHNICAL_SKILL' AND NOT is_header"), ["doc"])
    assert rows(skills) == [("a", "Languages", ["Python", "SQL", "R"])]
    work = rows(ln.work_entries(tagged, "doc").select("period", "position", "company", "location", "bullets", "rec"), "rec")
    assert [w[:5] for w in work] == [("Jan 2013 – Now", "Engineer", "Acme", "Jakarta, Indonesia", ["built things"]), ("2007 - 2012", "Clerk", "", "", [])]


def test_institution_line_taken_as_degree(frame):
    text = "FORMAL EDUCATION\nA U (X) 2001 - 2005\nB U (Y) 2005 - 2009\nC U (Z) 2009 - 2010"
    tagged = ln.tag_sections(ln.explode_lines(frame([(1, text)], "d int, t string"), "d", "t"), "d")
    assert rows(ln.education(tagged, "d").select("institution", "degree", "line_no"), "line_no") == [("A U", "B U (Y) 2005 - 2009", 1), ("C U", "", 3)]


def test_nested_selection(frame):
    df = frame([(1, [("a", 1), ("b", 2)], [("x", ["p", "q"]), ("y", ["r"])], [("t",)])],
               "id int, projects array<struct<name:string,n:int>>, skills array<struct<category:string,values:array<string>>>, trainings array<struct<name:string>>")
    r = pp.select_nested(df, ["b"], ["q"], []).first()
    assert [p["name"] for p in r["projects"]] == ["b"] and [(g["category"], g["values"]) for g in r["skills"]] == [("x", ["q"])] and r["trainings"] == []
    assert pp.select_nested(df).first() == df.first()
    assert rows(pp.flatten_skills(df, "id"), "skill") == [(1, "x", "p"), (1, "x", "q"), (1, "y", "r")]


def test_batch_outcome(frame):
    df = frame([("a", "SUCCESS", None), ("b", "FAILED", "no folder"), ("c", "FAILED", "bad date")], "who string, status string, error string")
    assert rows(pp.run_summary(df), "status") == [("FAILED", 2, "bad date"), ("SUCCESS", 1, None)]
    assert [r["who"] for r in pp.retain_newest(df, [F.desc("who")], 2).collect()] == ["c", "b"]


def test_projects_are_read_by_one_pass(frame):
    lines = [
        "Title - before any section", "PROJECT EXPERIENCE", "no title here", "Dam – Water Board", "Mar 2017 – Now", "Role: lead - acting", "first words", "Description : set anew",
        "more words", None, "Responsibility: all", "Tool: Spark", "Team members: 3", "Road, City", "2001 - 2002", "2003 - 2004", "Role:", "- ", "lost", "Bridge, Town",
        "TECHNICAL SKILL", "Spark - good", "project experience", "Last - one",
    ]
    df = frame([(1, lines), (2, []), (3, None), (4, ["PROJECT EXPERIENCE"])], "id int, ls array<string>")
    out = ln.project_records(df, "id", "ls")
    got = [tuple(r) for r in out.orderBy("id", "position").collect()]
    assert got == [
        # a comma opens a project only where none is open, so the road goes on with the dam
        (1, 1, "Dam", "Water Board", "Mar 2017 – Now", "lead - acting", "set anew more words Road, City all", "Spark"),
        (1, 2, "2001", "2002", "2003 - 2004", "", "", ""),
        (1, 3, "Bridge", "Town", "", "", "", ""),
        (1, 4, "Last", "one", "", "", "", ""),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_one_bad_item_does_not_stop_a_run(frame):
    df = frame([("a", "1.5", "2020-01-02", None), ("b", "x", "2020-13-01", None), ("c", "y", None, True), ("d", None, "2020-01-02", False)], "item string, n string, d string, skip boolean")
    log = pp.run_items(df, "item", F.col("skip"), {"number": ("n", "double"), "day": ("d", "date")}, ["number"])
    assert rows(log, "item") == [
        ("a", "SUCCESS", None, 1.5, date(2020, 1, 2)), ("b", "FAILED", "number: cannot read 'x' as double; day: cannot read '2020-13-01' as date", None, None),
        ("c", "SKIPPED", None, None, None), ("d", "FAILED", "number: missing", None, None)]
    assert rows(pp.run_summary(log), "status") == [("FAILED", 2, "number: cannot read 'x' as double; day: cannot read '2020-13-01' as date"), ("SKIPPED", 1, None), ("SUCCESS", 1, None)]
