"""Queries of name repair, sketches, drifting documents and drifting layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from barrio.operators import names, sketches
from barrio.operators.aggregates import incident_merge, incident_partial
from barrio.operators.label import CLASS_PROBABILITIES, class_of
from barrio.operators.normalize import INCIDENT_TYPES
from barrio.operators.quality import observed_write, read_json_checked, split_checked
from barrio.operators.unify import unified_model
from barrio.operators.variants import flatten_variants
from barrio.plans import area_year as ay
from barrio.plans import docs, sql
from barrio.plans.catalog import query, rounded
from barrio.plans.queries_format import _METRICS, FLAT_PRICES
from barrio.plans.tables import table
from barrio.session import scratch_path
from barrio.sources.layouts import read_layouts

# ------------------------------------------------------------------ area names

# one row in ten of each kind; the digits of a nation's name stay
PLANTED_SQL = """
  CASE o.o_orderkey % 10 WHEN 0 THEN upper(n.n_name) WHEN 1 THEN replace(n.n_name, 'a', 'á')
       WHEN 2 THEN substr(n.n_name, 1, 1) || substr(n.n_name, 3)
       WHEN 3 THEN substr(n.n_name, 2, 1) || substr(n.n_name, 1, 1) || substr(n.n_name, 3)
       WHEN 4 THEN 'Elsewhere ' || CAST(o.o_orderkey % 3 AS VARCHAR) WHEN 5 THEN '  ' || n.n_name || ' '
       ELSE n.n_name END"""


def _planted():
    n, k = F.col("n_name"), F.col("o_orderkey") % 10
    return (F.when(k == 0, F.upper(n)).when(k == 1, F.replace(n, F.lit("a"), F.lit("á")))
            .when(k == 2, F.concat(F.substring(n, 1, 1), F.expr("substring(n_name, 3)")))
            .when(k == 3, F.concat(F.substring(n, 2, 1), F.substring(n, 1, 1), F.expr("substring(n_name, 3)")))
            .when(k == 4, F.concat(F.lit("Elsewhere "), (F.col("o_orderkey") % 3).cast("string")))
            .when(k == 5, F.concat(F.lit("  "), n, F.lit(" "))).otherwise(n))


def _named_incidents(spark, d):
    """Incident rows with the area as it was written down."""
    orders = table(spark, d, "orders").filter(
        (F.col("o_orderpriority") == ay.INCIDENT_PRIORITY)
        & (F.col("o_orderdate") >= F.lit(ay.INCIDENTS_FROM).cast("timestamp_ntz")))
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    status = F.col("o_orderstatus")
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(_planted().alias("neighborhood_name"), F.col("n_nationkey").alias("neighborhood_code"),
                    F.year("o_orderdate").alias("year"),
                    F.nullif(F.floor(F.col("o_totalprice") / ay.VICTIM_UNIT), F.lit(0)).cast("bigint").alias("num_victims"),
                    (status == "F").cast("bigint").alias("num_deaths"),
                    F.when(status == "O", F.lit(1).cast("bigint")).alias("num_minor_injuries"),
                    F.when(status == "P", F.lit(1).cast("bigint")).alias("num_serious_injuries")))


NAMES_SQL = f"""
  WITH found AS (
    SELECT name, count(*) AS rows, lower(trim(name)) AS key, lower(strip_accents(trim(name))) AS fold FROM (
      SELECT {PLANTED_SQL} AS name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderdate >= TIMESTAMP '1997-01-01') p GROUP BY name),
  known AS (SELECT DISTINCT n_name AS area, lower(trim(n_name)) AS key FROM nation),
  pairs AS (
    SELECT f.name, k.area, levenshtein(f.fold, k.key) AS edits, f.key = k.key AS exact, f.fold = k.key AS folded,
           least(3, length(f.fold) // 4) AS allowed
    FROM found f CROSS JOIN known k),
  best AS (
    SELECT name, arg_min(area, (edits, area)) AS area, min(edits) AS edits, bool_or(exact) AS exact, bool_or(folded) AS folded,
           count(*) FILTER (WHERE edits = low) AS n_best
    FROM (SELECT *, min(edits) OVER (PARTITION BY name) AS low FROM pairs WHERE edits <= allowed) p GROUP BY name)
  SELECT f.name, b.area, CASE WHEN b.exact THEN 'exact' WHEN b.folded THEN 'folded' WHEN b.area IS NOT NULL THEN 'edited'
                              ELSE 'unmatched' END AS how,
         CAST(b.edits AS INTEGER) AS edits, CAST(coalesce(b.n_best, 0) AS INTEGER) AS n_best, f.rows
  FROM found f LEFT JOIN best b USING (name)
"""


@query("repaired_areas", NAMES_SQL)
def repaired_areas(spark, d):
    """Incident areas with planted misspellings, and what each was taken for."""
    known = table(spark, d, "nation").select(F.col("n_name").alias("name"))
    _, report = names.repaired(_named_incidents(spark, d), known)
    return report


@query("unified_repaired", sql.round_cols(
    sql.UNIFIED.replace("AND o.o_orderdate >= TIMESTAMP '1997-01-01'",
                        "AND o.o_orderdate >= TIMESTAMP '1997-01-01' AND o.o_orderkey % 10 <> 4"),
    ["average_antiquity_cultural_sites", "average_price_per_square_meter"]))
def unified_repaired(spark, d):
    """J-1..J-3 + P8: incidents under misspelt areas join once these are repaired;
    only the rows of unknown places are missing."""
    measures = ["num_victims", "num_deaths", "num_minor_injuries", "num_serious_injuries"]
    rows = _named_incidents(spark, d)
    # a row a name and year before anything is joined
    part = incident_partial(rows.select("neighborhood_name", "neighborhood_code", "year", *measures),
                            ["neighborhood_name", "year"])
    known = table(spark, d, "nation").select(F.col("n_name").alias("name"))
    repaired, _ = names.repaired(part, known)
    keyed = repaired.where(F.col("neighborhood_name").isNotNull()).withColumn(
        "join_neigh", F.lower(F.trim("neighborhood_name")))
    incidents = incident_merge(keyed, ["join_neigh", "year"])
    return rounded(unified_model(ay.price_groups(spark, d), incidents, ay.site_groups(spark, d)))

# -------------------------------------------------------------------- sketches


@query("sketched_cuts", f"""
  SELECT p AS probability, (SELECT count(l_quantity) FROM lineitem WHERE l_quantity <> 0) AS rows, TRUE AS within_error
  FROM (VALUES {', '.join(f'({p}::DOUBLE)' for p in CLASS_PROBABILITIES)}) t(p)
""")
def sketched_cuts(spark, d):
    """A5/M1: sketches of unit prices are stored by year and merged; the cuts' exact
    ranks among all rows lie within twice the published error."""
    li = table(spark, d, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.try_divide("l_extendedprice", "l_quantity").alias("price"))
    path = scratch_path(spark, "price-sketches")
    sketches.sketches(li, ["year"], "price").write.partitionBy("year").parquet(path)
    cuts = sketches.sketch_cuts(spark.read.parquet(path))
    below = li.where("price IS NOT NULL").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg((F.col("price") < c).cast("double")).alias(f"lt{i}") for i, c in enumerate(cuts)],
        *[F.avg((F.col("price") <= c).cast("double")).alias(f"le{i}") for i, c in enumerate(cuts)])
    error = 2 * sketches.rank_error()
    each = F.explode(F.array(*[F.struct(
        F.lit(p).alias("probability"), ((F.col(f"lt{i}") - error <= p) & (F.col(f"le{i}") + error >= p)).alias("within_error"))
        for i, p in enumerate(CLASS_PROBABILITIES)])).alias("c")
    return below.select(each, "rows").select("c.probability", "rows", "c.within_error")


@query("sketched_classes", """
  SELECT 'classes' AS what, TRUE AS near_terciles, count(*) AS rows FROM lineitem WHERE l_quantity <> 0
""")
def sketched_classes(spark, d):
    """M1: rows labelled by cuts of merged sketches fall into classes of the shares asked for."""
    li = table(spark, d, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.try_divide("l_extendedprice", "l_quantity").alias("price"))
    path = scratch_path(spark, "class-sketches")
    sketches.sketches(li, ["year"], "price").write.parquet(path)
    cuts = sketches.sketch_cuts(spark.read.parquet(path))
    share = li.where("price IS NOT NULL").withColumn("c", class_of(F.col("price"), cuts)).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"))
    wanted = [CLASS_PROBABILITIES[0], CLASS_PROBABILITIES[1] - CLASS_PROBABILITIES[0], 1 - CLASS_PROBABILITIES[1]]
    off = F.abs(F.col("n") / F.col("rows") - F.element_at(F.array(*map(F.lit, wanted)), F.col("c").cast("int") + 1))
    total = share.agg(F.sum("n").alias("rows"), F.collect_list(F.struct("c", "n")).alias("each"))
    flat = total.select("rows", F.explode("each").alias("e")).select("rows", "e.*")
    return flat.groupBy(F.lit("classes").alias("what"), "rows").agg(
        (F.max(off) <= 4 * sketches.rank_error()).alias("near_terciles"))

# ---------------------------------------------------------- drifting documents


@query("variant_flatten", f"""
  SELECT * EXCLUDE ({', '.join(_METRICS)}), {', '.join(f"{sql.sround(m, 4)} AS {m}" for m in _METRICS if m != 'diff_price_per_meter')},
         CASE WHEN neighborhood_id % 3 = 2 THEN NULL ELSE {sql.sround('diff_price_per_meter', 4)} END AS diff_price_per_meter
  FROM ({FLAT_PRICES.format(where='')}) q
""")
def variant_flatten(spark, d):
    """Price documents land in three shapes (as they are; with renamed
    fields; with numbers as text and a field missing) and flatten to typed rows."""
    p = docs.price_docs(spark, d)
    shape = F.col("_id") % 3
    plain = F.to_json(F.struct(*[F.col(f"`{c}`") for c in p.columns]))
    renamed = F.to_json(F.struct(
        F.col("_id").alias("id"), "district_id", "district_name", F.col("`neigh_name `").alias("neigh_name"),
        F.transform("info", lambda e: F.struct(
            e["year"].alias("Year"), e["PerMeter"].alias("per_meter"), e["Amount"].alias("amount"),
            e["usedAmount"].alias("used_amount"), e["diffAmount"].alias("diff_amount"),
            e["diffPerMeter"].alias("diff_per_meter"))).alias("history")))
    retyped = F.to_json(F.struct(
        F.col("_id").cast("string").alias("_id"), F.col("district_id").cast("string").alias("district_id"),
        "district_name", F.col("`neigh_name `"),
        F.transform("info", lambda e: F.struct(
            e["year"].cast("string").alias("year"), *[e[c].cast("string").alias(c) for c in
                                                      ("PerMeter", "Amount", "usedAmount", "diffAmount")])).alias("info")))
    path = scratch_path(spark, "variant-docs")
    p.select(F.when(shape == 1, renamed).when(shape == 2, retyped).otherwise(plain).alias("value")).write.text(path)
    return rounded(flatten_variants(spark.read.text(path)))


@query("observed_quality", """
  SELECT rule, CAST(rows AS BIGINT) AS rows FROM (
    SELECT 'rows' AS rule, count(*) AS rows FROM events
    UNION ALL SELECT 'malformed', count(*) FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'missing', count(*) FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'small_value', count(*) FROM events WHERE event_type NOT IN ('error', 'signup') AND value < 10
    UNION ALL SELECT 'landed', count(*) FROM events WHERE event_type NOT IN ('error', 'signup')) q
""")
def observed_quality(spark, d):
    """Q1-Q3: the load counts its rows by rule while it writes them; the landed rows
    are counted from what was written."""
    e = table(spark, d, "events")
    full = F.to_json(F.struct(*e.columns))
    no_id = F.to_json(F.struct(*[c for c in e.columns if c != "event_id"]))
    root = scratch_path(spark, "observed")
    e.select(F.when(F.col("event_type") == "error", F.substring(full, 1, 25))
             .when(F.col("event_type") == "signup", no_id).otherwise(full).alias("value")).write.text(f"{root}/landing")
    checked = read_json_checked(spark, f"{root}/landing", e.schema, required=["event_id"])
    status = F.col("status")
    counts = observed_write(checked, {
        "malformed": status == "malformed", "missing": status == "missing",
        "small_value": (status == "ok") & (F.col("value") < 10)},
        lambda df: df.write.partitionBy("status").parquet(f"{root}/loaded"))
    good, _ = split_checked(spark.read.parquet(f"{root}/loaded"))
    rows = spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "rule string, rows bigint")
    return rows.unionByName(good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("landed").alias("rule"), "rows"))

# ------------------------------------------------------------ drifting layouts

LAYOUTS = 1000


@query("layouts_one_scan", """
  SELECT CAST(o_orderkey AS VARCHAR) AS expedient_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(NULL AS INTEGER) AS district_id, CAST(NULL AS VARCHAR) AS district_name,
         CAST(o_custkey AS INTEGER) AS neighborhood_id, o_orderpriority || ', said; "so"' AS neighborhood_name,
         CAST(nullif(floor(o_totalprice / 100000.0), 0) AS BIGINT) AS num_victims,
         CAST(NULL AS BIGINT) AS num_deaths, CAST(NULL AS BIGINT) AS num_minor_injuries,
         CAST(NULL AS BIGINT) AS num_serious_injuries,
         CASE WHEN o_orderkey % 1000 % 4 <> 3 THEN 'x' || CAST(o_orderkey % 7 AS VARCHAR) END AS extra
  FROM orders WHERE o_orderkey % 1000 % 50 <> 49
""")
def layouts_one_scan(spark, d):
    """A thousand layouts (delimiters, column orders, spellings, own
    columns, years in cells or folders; some without the key) in one plan."""
    o = table(spark, d, "orders")
    key, layout = F.col("o_orderkey"), F.col("layout")
    o = o.withColumn("layout", key % LAYOUTS).withColumn("year", F.year("o_orderdate"))
    # a folder's year is the layout's where the cells have none
    o = o.withColumn("folder", F.when(layout % 4 == 3, F.col("year")).otherwise(0))
    sep = F.when(layout % 2 == 0, F.lit(";")).otherwise(F.lit(","))
    quoted = F.concat(F.lit('"'), F.replace(F.concat("o_orderpriority", F.lit(', said; "so"')), F.lit('"'), F.lit('\\"')),
                      F.lit('"'))
    cells = {
        "id": (F.when(layout % 50 == 49, "Nobody").when(layout % 3 == 0, "Numero_expedient").when(
            layout % 3 == 1, "Número d'expedient").otherwise("Nmero d expedient"), key.cast("string")),
        "code": (F.when(layout % 2 == 0, "Codi_barri").otherwise("Codi barri"), F.col("o_custkey").cast("string")),
        "name": (F.lit("Nom_barri"), quoted),
        "victims": (F.lit("Numero_victimes"), F.coalesce(
            F.nullif(F.floor(F.col("o_totalprice") / ay.VICTIM_UNIT), F.lit(0)).cast("string"), F.lit(""))),
        "own": (F.when(layout % 4 == 3, "unused").otherwise(F.concat(F.lit("own_"), layout.cast("string"))),
                F.concat(F.lit("x"), (key % 7).cast("string"))),
        "year": (F.when(layout % 4 == 3, "nothing").otherwise("NK_Any"),
                 F.when(layout % 4 == 3, "").otherwise(F.col("year").cast("string"))),
    }

    def line(part: int):
        values = F.array(*[c[part] for c in cells.values()])
        turn = (layout % len(cells)).cast("int")
        turned = F.concat(F.slice(values, turn + 1, F.lit(len(cells))), F.slice(values, F.lit(1), turn))
        return F.array_join(turned, "\0")

    def separated(text):
        return F.replace(text, F.lit("\0"), sep)

    heads = o.groupBy("layout", "folder").agg(F.lit(0).alias("at")).withColumn("value", separated(line(0)))
    lines = o.select("layout", "folder", F.lit(1).alias("at"), separated(line(1)).alias("value"))
    root = scratch_path(spark, "layouts")
    files = heads.select("layout", "folder", "at", "value").unionByName(lines)
    (files.repartition("layout", "folder").sortWithinPartitions("layout", "folder", "at")
     .withColumn("dir", F.col("layout")).select("dir", F.col("folder").alias("year"), "value")
     .write.partitionBy("dir", "year").text(root))
    got = read_layouts(spark, root, name_pattern=None, folder_pattern=r"year=(\d{4})", pattern="*.txt")
    own = F.get(F.map_values(F.map_filter("others", lambda k, _: F.startswith(k, F.lit("own_")))), F.lit(0))
    return got.data.select(*INCIDENT_TYPES, own.alias("extra"))
