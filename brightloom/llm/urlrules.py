"""Verdicts on page addresses by pattern rules, found through their rarest literal token.

A rule is a regular expression over host and path, with the literal tokens (runs of ASCII
letters and digits) that every match contains as whole tokens. The corpus counts how often
each of the rules' tokens occurs in addresses; a rule is filed under its rarest one. An
address looks up its own tokens, which gives its candidate rules, and only those run their
regular expression. Rules without a token are candidates everywhere.

Site rules, written host/path, fit the host and all subdomains where the path starts with
theirs; the longest wins. Where none fits, the listed patterns decide: one match blocks, no
match allows.

Every distinct address is judged once and joined back, so repeated pages and a host with a
third of all pages cost no more; the rules are a table, and Spark broadcasts their index only
when it is small. A null address or one without :// has empty host and path and matches
nothing. Repeated rows each get a row, an empty table gives none, other columns pass by.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"

# Words that, as part of a host's label, mark sites not wanted in training data.
UNWANTED = (
    "ads adserver adult banner bet betting casino clickbait crack doubleclick escort gambling hentai jackpot keygen loan "
    "lottery malware nude payday phishing pills poker popup porn proxy sex slots spam torrent track tracker tracking viagra "
    "warez webcam win xxx"
).split()


@dataclass(frozen=True)
class Rule:
    """``site`` rules carry their text; patterns have none."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    site: bool = False


def site_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    path = slash + path
    whole = re.findall(TOKEN, host) + [m[0] for m in re.finditer(TOKEN, path) if m.end() < len(path)]
    return Rule(text, verdict, rf"^(?:[^/]*\.)?{_plain(host)}{_plain(path)}", tuple(whole), True)


def _plain(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def word_rule(word: str) -> Rule:
    """Blocks hosts that have ``word`` between dots, hyphens or the ends."""
    return Rule(word, "block", rf"^(?:[^/]*[.\-])?{word}(?:[.\-][^/]*)?(?:/|$)", (word,))


PATTERNS = tuple(word_rule(w) for w in UNWANTED)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.concat("host", "path"), F.lit(f"({TOKEN})")))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule with the one token it is filed under; the empty token is in every address."""
    named = rules.select("id", F.explode("tokens").alias("token"))
    seen = urls.select(F.explode(_tokens()).alias("token")).join(named.select("token").distinct(), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("found"))
    rare = named.join(counts, "token", "left").groupBy("id").agg(F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "token")).alias("rare"))
    return rules.join(rare, "id", "left").select("id", "name", "verdict", "regex", "site", F.coalesce("rare.token", F.lit("")).alias("token"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per page: page_id, host, path, rule (of a site, else null), verdict, pattern
    (the first listed one that matched, where no site rule did)."""
    spark = pages.sparkSession
    schema = "id int, name string, verdict string, regex string, tokens array<string>, site boolean"
    table = spark.createDataFrame([(i, r.name, r.verdict, r.regex, list(r.tokens), r.site) for i, r in enumerate(rules)], schema)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    urls = rows.select("host", "path").distinct()
    looked = urls.withColumn("token", F.explode(F.array_union(_tokens(), F.array(F.lit("")))))
    hits = looked.join(rule_index(urls, table), "token").filter(F.expr("rlike(concat(host, path), regex)"))
    best = hits.groupBy("host", "path").agg(
        F.max(F.when(F.col("site"), F.struct(F.length("name").alias("long"), "name", "verdict"))).alias("won"),
        F.min(F.when(~F.col("site"), F.struct("id", "name", "verdict"))).alias("met"),
    )
    out = rows.join(best.withColumnsRenamed({"host": "_host", "path": "_path"}), (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return out.select(
        "page_id", "host", "path", F.col("won.name").alias("rule"),
        F.coalesce("won.verdict", "met.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("won").isNull(), F.col("met.name")).alias("pattern"),
    )
