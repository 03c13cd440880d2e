"""Sources, sinks, reference tables and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.operators import names, sales
from brightloom.operators.quality import union_all
from brightloom.plans.flood import FORECAST, forecast
from brightloom.plans.indices import nation_years
from brightloom.plans.registry import Tables, query
from brightloom.plans.retail import PART_RULES, SALES, staged
from brightloom.session import stage as frozen
from brightloom.sources import files, manifest
from brightloom.streaming import batches
from brightloom.streaming import events as ev


@query("src_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = files.scratch(t.spark, "customer_csv")
    files.export_csv(t.customer, path)
    return files.read_csv(t.spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


NY = """ny AS (SELECT n_name AS entity, n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


@query("src_composite_key_decode", f"WITH {NY} SELECT entity, year, orders FROM ny")
def _(t):
    per = nation_years(t, F.count(F.lit(1)).alias("orders")).join(
        t.nation.select(F.col("n_name").alias("entity"), "n_nationkey", "n_regionkey"), "entity")
    # The payload of the statistics service: regions, years and a key to value map, one
    # document per world region (bounded by its nations x years).
    doc = per.groupBy("n_regionkey").agg(F.to_json(F.struct(
        F.array_distinct(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("val"), F.concat(F.lit("<b>"), "entity", F.lit("</b>")).alias("label")))).alias("vervar"),
        F.array_distinct(F.collect_list(F.struct((F.col("year") - 1900).cast("string").alias("val"), F.col("year").cast("string").alias("label")))).alias("tahun"),
        F.map_from_entries(F.collect_list(F.struct(
            F.concat(F.col("n_nationkey").cast("string"), F.lit("192"), F.lit("434"), (F.col("year") - 1900).cast("string"), F.lit("62")), F.col("orders").cast("double")))).alias("datacontent"),
    )).alias("payload"))
    return files.decode_key_map(doc, "payload", "orders", "192", "434", "62")


@query("src_geojson_flatten", "SELECT n_name AS name, n_nationkey AS code, n_regionkey AS region FROM nation")
def _(t):
    props = F.struct(
        F.when(F.col("n_regionkey") < 3, F.col("n_name")).alias("NAME_1"), F.when(F.col("n_regionkey") >= 3, F.col("n_name")).alias("Propinsi"),
        F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("region"))
    collections = t.nation.groupBy("n_regionkey").agg(F.collect_list(F.struct(F.lit("Feature").alias("type"), props.alias("properties"))).alias("features"))
    path = files.scratch(t.spark, "features")
    files.export_json(collections.select(F.lit("FeatureCollection").alias("type"), "features"), path)
    back = t.spark.read.schema("features array<struct<properties struct<NAME_1:string,Propinsi:string,code:int,region:int>>>").json(path)
    return files.flatten_features(back, {"code": "code", "region": "region"}, ["NAME_1", "Propinsi"])


@query("src_page_union_search", "SELECT p_partkey AS var_id, p_name AS title FROM part WHERE lower(p_name) LIKE '%ring%'")
def _(t):
    pages = t.part.groupBy(F.floor(F.col("p_partkey") / 100).alias("page")).agg(
        F.collect_list(F.struct(F.col("p_partkey").alias("var_id"), F.col("p_name").alias("title"))).alias("data"))
    path = files.scratch(t.spark, "pages")
    files.export_json(pages, path)
    return files.search_pages(t.spark, path, "page long, data array<struct<var_id long, title string>>", "data", "title", "RING")


@query("src_crosstab_melt", """SELECT o_orderstatus AS category, n_name AS entity, round(CAST(count(*) AS DOUBLE) / 7, 4) AS rate, 2024 AS year FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def _(t):
    nations = [r["n_name"] for r in t.nation.select("n_name").distinct().orderBy("n_name").collect()]  # the header cells
    cells = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("o_orderstatus").alias("category")).pivot("n_name", nations).agg(F.count(F.lit(1)) / 7)
    )
    path = files.scratch(t.spark, "crosstab")
    files.export_csv(cells, path)
    sheet = files.read_csv(t.spark, path, "category string, " + ", ".join(f"`{n}` string" for n in nations))
    return files.melt_crosstab(sheet, "category", "entity", "rate", 2024)


@query("src_crosstab_repeats", """SELECT n_name AS entity, count(*) AS n FROM (SELECT DISTINCT n_name, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1 HAVING count(*) > 1""")
def _(t):
    cells = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderstatus", F.col("n_name").alias("entity")).distinct())
    return files.repeated_entities(cells, "entity")


@query("src_percent_parse", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * 100, 1) AS discount_pct FROM lineitem")
def _(t):
    text = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(
        F.lit(" "), F.translate(F.format_string("%.1f", F.col("l_discount") * 100), ".", ","), F.lit("%")).alias("Discount (%) of line"))
    col = files.find_column(text.columns, "discount")
    return text.select("l_orderkey", "l_linenumber", "l_partkey", files.parse_percent(F.col(f"`{col}`")).alias("discount_pct"))


ALIASES = "al AS (SELECT 'Nation_' || n_nationkey AS canonical_name, r_name || '/' || n_nationkey AS variant FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query("ref_variant_lookup", f"""WITH {ALIASES}, c AS (SELECT upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS canonical_name, n_nationkey AS code FROM nation WHERE n_nationkey <> 9999),
v AS (SELECT canonical_name, code, canonical_name AS variant FROM c UNION ALL SELECT canonical_name, code, variant FROM c JOIN al USING (canonical_name))
SELECT lower(trim(variant)) AS name_key, canonical_name FROM v""")
def _(t):
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    aliases = n.select(F.initcap("n_name").alias("canonical_name"), F.concat_ws("/", "r_name", "n_nationkey").alias("variant"))
    return names.variant_map(names.build_variants(t.nation, "n_nationkey", "n_name", aliases), "code")


@query("ref_last_n_periods", """WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS m FROM orders ORDER BY m DESC LIMIT 3) SELECT count(*) AS periods, min(m) || ':' || max(m) AS period_range FROM m""")
def _(t):
    return names.last_periods(t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("m")), "m", 3)


@query("ref_crosswalk", """SELECT n_name AS entity, coalesce(CASE WHEN n > 5 THEN 'N' || n_nationkey END, 'R' || n_regionkey) AS code
FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey""")
def _(t):
    entities = t.nation.select(F.col("n_name").alias("entity"))
    many = t.supplier.groupBy("s_nationkey").count().filter("count > 5")
    own = t.nation.join(many, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("entity"), F.concat(F.lit("N"), "n_nationkey").alias("code"))
    parents = t.nation.select(F.col("n_name").alias("entity"), F.concat(F.lit("R"), "n_regionkey").alias("parent_target"))
    return names.crosswalk(entities, "entity", own, parents, "code")


@query("snk_star_parquet", f"""WITH {SALES} SELECT 'fact_sales_stage' AS table_name, count(*) AS n FROM clean UNION ALL SELECT 'dim_store', count(*) FROM dim_store
UNION ALL SELECT 'dim_product', count(*) FROM dim_product UNION ALL SELECT 'dim_date', count(DISTINCT CAST(invoice_ts AS DATE)) FROM clean""")
def _(t):
    star = sales.star_schema(staged(t), PART_RULES)
    folder = files.scratch(t.spark, "star")
    files.write_star(star, folder)
    back = files.read_star(t.spark, folder, list(star))
    return union_all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n, df in back.items()])


@query("snk_versioned_path")
def _(t):
    from datetime import datetime, timezone

    base = files.scratch(t.spark, "versions")
    for day in (1, 2):
        files.write_version(t.nation.withColumn("day", F.lit(day)), base, "nation", datetime(2024, 1, day, tzinfo=timezone.utc))
    return t.spark.read.parquet(f"{base}/nation").groupBy(F.col("run_ts").cast("string").alias("run_ts")).agg(F.count(F.lit(1)).alias("rows"), F.max("day").alias("day"))


@query("snk_manifest_rows")
def _(t):
    base = files.scratch(t.spark, "ingest")
    for name in ("nation", "customer"):
        df = getattr(t, name)
        files.export_csv(df, f"{base}/{name}")
        manifest.append(manifest.file_entries(t.spark, f"{base}/{name}", name, "v1", "tables", "", df.count(), len(df.columns)), f"{base}/manifest")
    return t.spark.read.json(f"{base}/manifest").select("dataset", "dataset_version", "sha256", "rows", "columns", "bytes", "fetch_status", "validation_status")


@query("manifest_latest", "SELECT event_type AS dataset, event_id, user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    e = t.events.select(F.col("event_type").alias("dataset"), "ts", "event_id", "user_id", "value")
    return manifest.latest(e, "dataset", ["ts", "event_id"]).select("dataset", "event_id", "user_id", "value")


@query("manifest_inventory", """WITH l AS (SELECT event_type, event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1),
m AS (SELECT DISTINCT event_type AS dataset FROM events UNION ALL SELECT DISTINCT lang FROM documents)
SELECT dataset, coalesce(CAST(event_id AS VARCHAR), 'not yet fetched') AS version, coalesce(CAST(user_id AS VARCHAR), 'not yet fetched') AS fetched_by FROM m LEFT JOIN l ON event_type = dataset""")
def _(t):
    e = t.events.select(F.col("event_type").alias("dataset"), "ts", "event_id", "user_id")
    known = t.events.select(F.col("event_type").alias("dataset")).distinct().unionByName(t.documents.select(F.col("lang").alias("dataset")).distinct())
    return manifest.inventory(known, manifest.latest(e, "dataset", ["ts", "event_id"]), "dataset", {"version": F.col("event_id"), "fetched_by": F.col("user_id")})


@query("snk_json_nested", f"""WITH {FORECAST} SELECT area, max(probability) FILTER (WHERE horizon = 6) AS prob_6h, max(probability) FILTER (WHERE horizon = 24) AS prob_24h,
  max(risk_level) FILTER (WHERE horizon = 12) AS level_12h, any_value(population) AS population FROM fc GROUP BY area""")
def _(t):
    record = forecast(t).groupBy("area").agg(F.max("population").alias("population"), F.struct(*[
        F.max(F.when(F.col("horizon") == h, F.struct("probability", "risk_level"))).alias(f"{h}h") for h in (6, 12, 24)]).alias("predictions"))
    path = files.scratch(t.spark, "forecast")
    files.export_json(record, path)
    back = t.spark.read.schema("area string, population long, predictions struct<`6h` struct<probability double, risk_level string>, "
                               "`12h` struct<probability double, risk_level string>, `24h` struct<probability double, risk_level string>>").json(path)
    return back.select("area", F.col("predictions.6h.probability").alias("prob_6h"), F.col("predictions.24h.probability").alias("prob_24h"),
                       F.col("predictions.12h.risk_level").alias("level_12h"), "population")


@query("land_partitioned", "SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
def _(t):
    path = files.scratch(t.spark, "landing")
    files.land(t.events, path, F.to_date("ts"))
    return t.spark.read.parquet(path).filter(F.col("date").between("2024-01-10", "2024-01-12")).select("event_id", "user_id", "event_type", "value")


STEPS = ["view", "click", "signup", "purchase"]


@query("stream_funnel_tumbling", """WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, event_type, count(*) AS events FROM events, m WHERE event_type <> 'error'
  AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY ALL""")
def _(t):
    schema = t.events.schema
    stream = ev.event_stream(t.spark, t.folder, schema, "ts", "events.parquet")
    counts = ev.funnel_counts(ev.once_only(stream, "event_id", "ts", "10 minutes"), "ts", "event_type", STEPS, "1 hour")
    out = files.scratch(t.spark, "funnel")
    ev.run_available(counts, out, f"{out}-checkpoint")
    back = t.spark.read.schema("window_start timestamp, window_end timestamp, event_type string, events long").parquet(out)
    return back.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "events")


@query("stream_dedup_sink", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    landing = files.scratch(t.spark, "twice")
    t.events.unionByName(t.events).write.parquet(landing)
    stream = ev.once_only(ev.event_stream(t.spark, landing, t.events.schema, "ts"), "event_id", "ts", "10 minutes")
    out = files.scratch(t.spark, "once")
    ev.run_available(stream, out, f"{out}-checkpoint")
    ev.run_available(stream, out, f"{out}-checkpoint")  # a replay adds nothing
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


ARRIVALS = """e AS (SELECT *, epoch_us(ts) AS u FROM events), r AS (SELECT min(u) AS lo, max(u) AS hi FROM e),
a AS (SELECT event_id, event_type, value, u, least(2, (3 * (u - lo)) // (hi - lo + 1)) + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS b FROM e, r),
l AS (SELECT * FROM a UNION ALL SELECT event_id, event_type, value, u, b + 1 FROM a WHERE event_id % 13 = 0 AND b < 3),
x AS (SELECT b, max(u) AS top FROM l GROUP BY b), w AS (SELECT y.b, (SELECT max(top) FROM x WHERE x.b < y.b) - 86400000000 AS mark FROM x y),
j AS (SELECT l.*, coalesce(u < mark, false) AS late FROM l JOIN w USING (b)),
k AS (SELECT *, NOT late AND row_number() OVER (PARTITION BY event_id, late ORDER BY b) > 1 AS again FROM j)"""


def arrivals(t: Tables) -> batches.Sink:
    """All events in four batches: thirds of the time span, some rows one batch later, some
    in two batches; then the third batch comes once more."""
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    micros = F.unix_micros("ts")
    lo, hi = events.agg(F.min(micros)).scalar(), events.agg(F.max(micros)).scalar()
    third = F.least(F.lit(2), F.floor((micros - lo) * 3 / (hi - lo + 1)))
    own = events.withColumn("b", (third + F.when(F.col("event_id") % 17 == 0, 1).otherwise(0)).cast("int"))
    landed = frozen(own.unionByName(own.filter("event_id % 13 = 0 AND b < 3").withColumn("b", F.col("b") + 1)))
    folder = files.scratch(t.spark, "arrivals")
    sink = batches.Sink(f"{folder}/out", events.schema, "event_id", "ts", "1 day")
    for b in range(4):
        landed.filter(F.col("b") == b).drop("b").write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        sink.run(stream, f"{folder}/checkpoint")
    sink.keep(landed.filter("b = 2").drop("b"), 2)
    return sink


@query("stream_batch_ledger", f"""WITH {ARRIVALS} SELECT CAST(b AS BIGINT) AS batch, count(*) AS n_rows, 0::BIGINT AS unplaced, count(*) FILTER (late) AS late,
  count(*) FILTER (again) AS repeated, count(*) FILTER (NOT late AND NOT again) AS kept FROM k GROUP BY b""")
def _(t):
    return arrivals(t).ledger(t.spark).drop("latest")


@query("stream_batch_target", f"WITH {ARRIVALS} SELECT event_id, event_type, value FROM k WHERE NOT late AND NOT again")
def _(t):
    return arrivals(t).target(t.spark).select("event_id", "event_type", "value")
