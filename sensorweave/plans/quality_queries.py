"""Data quality (clamp, violations, kinematics) and graph path queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.telemetry import clamp
from ..operators import patterns as PT
from ..operators import rdf as RD
from ..sources.tables import read_table
from .graph_build import seed_edges
from .proxy import telemetry, with_telemetry
from .rdf_queries import constraints_sql, kb_triples, triple_store
from .registry import register

def effective_limits(constraints: DataFrame | None) -> dict[str, tuple[float, float]]:
    """Clamp limits per governed property.

    Start from the fixed defaults; a constraint row overrides them, with the
    reference's effective rule that force and torque are clamped to +/- max.
    The constraints are aggregated to one row, whatever their number.
    """
    limits = dict(fixed.DEFAULT_LIMITS)
    if constraints is None:
        return limits
    stated = constraints.agg(*[F.max(F.when(F.col("property") == p, F.col(c))).alias(f"{p}_{c}")
                               for p in limits for c in ("min", "max")]).first()
    for p, (lo, hi) in limits.items():
        hi = stated[f"{p}_max"] if stated[f"{p}_max"] is not None else hi
        if p in ("hasForce", "hasTorque"):
            lo = -hi
        elif stated[f"{p}_min"] is not None:
            lo = stated[f"{p}_min"]
        limits[p] = (lo, hi)
    return limits


_KB_LIMITS: dict[str, dict[str, tuple[float, float]]] = {}


def kb_limits(spark: SparkSession) -> dict[str, tuple[float, float]]:
    """The reference's flow: strict extraction over the ontology (finds no rows on
    this KB), falling back to the defaults.  The ontology is fixed, so the result is
    computed once per application."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no driver context (Spark Connect)
        app = spark.conf.get("spark.app.id", "")
    if app not in _KB_LIMITS:
        _KB_LIMITS[app] = effective_limits(
            RD.fold_constraints(RD.restriction_ranges(kb_triples(spark), strict=True)))
    return dict(_KB_LIMITS[app])


def _numeric(col: str):
    c = F.col(col)
    return c.try_cast("double") if col == "environment_humidity" else c


def clamp_columns(df: DataFrame, limits: dict[str, tuple[float, float]], keep=("event_id",)) -> DataFrame:
    """Every governed column clamped into its range, in one projection."""
    gov = {c: p for p, cols in fixed.PROPERTY_COLUMNS.items() for c in cols}
    out = [F.col(k) for k in keep]
    for c, p in gov.items():
        lo, hi = limits[p]
        out.append(F.round(clamp(_numeric(c), lo, hi), 6).alias(c))
    return df.select(*out)


def violations(df: DataFrame, constraints: DataFrame, keep=("event_id",)) -> DataFrame:
    """D3: one row per (record, column) outside the range that the ontology states for its property.

    ``constraints`` are the extracted rows (property, min, max), joined to the values;
    AQE broadcasts them where they measure small, as an ontology's ranges do.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("property"), _numeric(c).alias("value"))
             for p, cols in fixed.PROPERTY_COLUMNS.items() for c in cols]
    values = df.select(*keep, F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    stated = constraints.select("property", F.col("min").alias("lo"), F.col("max").alias("hi"))
    return (values.join(stated, "property").filter((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi")))
            .select(*keep, "column", "property", F.round("value", 6).alias("value"), "lo", "hi"))


def _limits_sql_case(limits) -> dict[str, str]:
    gov = {c: p for p, cols in fixed.PROPERTY_COLUMNS.items() for c in cols}
    out = {}
    for c, p in gov.items():
        lo, hi = limits[p]
        v = f"TRY_CAST({c} AS DOUBLE)" if c == "environment_humidity" else c
        out[c] = f"round(least(greatest({v}, CAST({lo} AS DOUBLE)), CAST({hi} AS DOUBLE)), 6)"
    return out


def _clamp_sql() -> str:
    cols = _limits_sql_case(fixed.DEFAULT_LIMITS)
    return with_telemetry("SELECT event_id, " + ", ".join(f"{e} AS {c}" for c, e in cols.items())
                          + " FROM telemetry")


@register("clamp_to_constraints", headline=True, sql=_clamp_sql())
def clamp_to_constraints(spark, sf_dir):
    return clamp_columns(telemetry(spark, sf_dir), kb_limits(spark))


def clamp_by_rows(df: DataFrame, constraints: DataFrame, keep=("event_id",)) -> DataFrame:
    """X8 / D2 with the limits that the extraction found: its rows (property, min, max) reach the values as one joined row.

    Where a property is not stated the default holds; force and torque are clamped to +/- their stated max.
    """
    gov = {c: p for p, cols in fixed.PROPERTY_COLUMNS.items() for c in cols}
    stated = constraints.agg(*[F.max(F.when(F.col("property") == p, F.col(c))).alias(f"_{p}_{c}")
                               for p in fixed.DEFAULT_LIMITS for c in ("min", "max")])
    out = [F.col(k) for k in keep]
    for c, p in gov.items():
        lo, hi = fixed.DEFAULT_LIMITS[p]
        top = F.coalesce(F.col(f"_{p}_max"), F.lit(hi))
        low = -top if p in ("hasForce", "hasTorque") else F.coalesce(F.col(f"_{p}_min"), F.lit(lo))
        out.append(F.round(F.least(F.greatest(_numeric(c), low), top), 6).alias(c))
    return df.join(F.broadcast(stated)).select(*out)


@register("clamp_to_extracted", sql=_clamp_sql())
def clamp_to_extracted(spark, sf_dir):
    """Readings clamped to the ranges that the extraction without ``owl:onDatatype`` finds in the stored triples."""
    t = triple_store(spark, sf_dir)
    return clamp_by_rows(telemetry(spark, sf_dir), RD.property_ranges(t))


@register("clamp_prices_to_extracted", sql=f"""
SELECT o_orderkey, least(greatest(o_totalprice, c.min), c.max) AS price, o_totalprice > c.max AS lowered
FROM orders JOIN ({constraints_sql(False)}) AS c ON c.property = 'hasPriority_' || replace(o_orderpriority, ' ', '_')""")
def clamp_prices_to_extracted(spark, sf_dir):
    """Order prices clamped to the range that the triples state for the order's priority: limits that only the
    extraction knows, joined by property."""
    t = triple_store(spark, sf_dir)
    stated = RD.property_ranges(t)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    own = orders.withColumn("property", F.concat(F.lit("hasPriority_"), F.translate("o_orderpriority", " ", "_")))
    return own.join(stated, "property").select("o_orderkey", clamp(F.col("o_totalprice"), F.col("min"), F.col("max")).alias("price"),
                                               (F.col("o_totalprice") > F.col("max")).alias("lowered"))


def _violations_sql() -> str:
    parts = []
    ranges = {prop: (float(lo.replace("−", "-")), float(hi)) for _, prop, lo, hi in fixed.KB_RESTRICTIONS}
    for p, cols in fixed.PROPERTY_COLUMNS.items():
        lo, hi = ranges[p]
        for c in cols:
            v = f"TRY_CAST({c} AS DOUBLE)" if c == "environment_humidity" else c
            parts.append(f"SELECT event_id, '{c}' AS \"column\", '{p}' AS property, round({v}, 6) AS value, "
                         f"CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi FROM telemetry "
                         f"WHERE {v} < {lo} OR {v} > {hi}")
    return with_telemetry("\nUNION ALL\n".join(parts))


@register("constraint_violations", sql=_violations_sql())
def constraint_violations(spark, sf_dir):
    """Values outside the ranges that the ontology states (not the wider clamp limits)."""
    stated = RD.fold_constraints(RD.restriction_ranges(kb_triples(spark)))
    return violations(telemetry(spark, sf_dir), stated)


# --- X9 / X10 / A15: kinematics derived from the joint angle --------------------------------------
def derive(df: DataFrame, limits: dict[str, tuple[float, float]], keep=("event_id",)) -> DataFrame:
    a_lo, a_hi = limits["hasJointAngle"]
    f_lo, f_hi = limits["hasForce"]
    t_lo, t_hi = limits["hasTorque"]
    c_lo, c_hi = limits["hasCurrent"]
    angle = clamp(F.col("joint_angle"), a_lo, a_hi)
    base = df.select(*keep, angle.alias("angle"))
    r = F.radians("angle")
    pos = base.select(*keep, "angle", F.cos(r).alias("px"), F.sin(r).alias("py"),
                      (F.sin(r) / F.lit(2.0)).alias("pz"))
    forces = {a: clamp(F.col(f"p{a}") * F.lit(10.0), f_lo, f_hi) for a in "xyz"}
    torque = clamp(F.col("angle") * F.lit(0.1), t_lo, t_hi)
    step = pos.select(*keep, "px", "py", "pz", *[forces[a].alias(f"f{a}") for a in "xyz"],
                      torque.alias("tq"))
    norm = F.sqrt(F.col("fx") * F.col("fx") + F.col("fy") * F.col("fy") + F.col("fz") * F.col("fz"))
    r6 = lambda c, n: F.round(c, 6).alias(n)
    return step.select(
        *keep, r6(F.col("px"), "position_x"), r6(F.col("py"), "position_y"), r6(F.col("pz"), "position_z"),
        r6(F.col("fx"), "force_x"), r6(F.col("fy"), "force_y"), r6(F.col("fz"), "force_z"),
        r6(F.col("tq"), "torque"), r6(clamp(norm * F.lit(0.1), c_lo, c_hi), "current"),
        r6(F.sqrt(F.col("px") * F.col("px") + F.col("py") * F.col("py")) * F.lit(0.1), "velocity"))


def _kinematics_sql() -> str:
    L = fixed.DEFAULT_LIMITS
    (alo, ahi), (flo, fhi), (tlo, thi), (clo, chi) = (L["hasJointAngle"], L["hasForce"],
                                                      L["hasTorque"], L["hasCurrent"])
    return with_telemetry(f"""
SELECT event_id, round(px, 6) + 0e0 AS position_x, round(py, 6) + 0e0 AS position_y,
  round(pz, 6) + 0e0 AS position_z, round(fx, 6) + 0e0 AS force_x, round(fy, 6) + 0e0 AS force_y,
  round(fz, 6) + 0e0 AS force_z, round(tq, 6) + 0e0 AS torque,
  round(least(greatest(sqrt(fx * fx + fy * fy + fz * fz) * 0.1e0, {clo}), {chi}), 6) AS current,
  round(sqrt(px * px + py * py) * 0.1e0, 6) AS velocity
FROM (SELECT event_id, px, py, pz,
        least(greatest(px * 10e0, {flo}), {fhi}) AS fx, least(greatest(py * 10e0, {flo}), {fhi}) AS fy,
        least(greatest(pz * 10e0, {flo}), {fhi}) AS fz, least(greatest(angle * 0.1e0, {tlo}), {thi}) AS tq
      FROM (SELECT event_id, angle, cos(radians(angle)) AS px, sin(radians(angle)) AS py,
                   sin(radians(angle)) / 2e0 AS pz
            FROM (SELECT event_id, least(greatest(joint_angle, {alo}), {ahi}) AS angle FROM telemetry) a) b) c""")


@register("derive_kinematics", sql=_kinematics_sql())
def derive_kinematics(spark, sf_dir):
    return derive(telemetry(spark, sf_dir), kb_limits(spark))


# --- U1 / J10: typed edges and bounded variable-length paths ---------------------------------------
HIER_TYPES = {"region_nation": "HAS_LOCATION", "nation_supplier": "HAS_A"}


def path_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the five report types: the seed topology plus region -> nation ->
    supplier links from the tables.  Node ids are 'Label:name'."""
    seed = (seed_edges(spark).filter(F.col("type").isin(fixed.PATH_EDGE_TYPES))
            .select("type", F.concat_ws(":", "src_label", "src_name").alias("src"),
                    F.concat_ws(":", "dst_label", "dst_name").alias("dst")))
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    rn = nation.select(F.lit(HIER_TYPES["region_nation"]).alias("type"),
                       F.concat(F.lit("Region:"), F.col("n_regionkey").cast("string")).alias("src"),
                       F.concat(F.lit("Nation:"), F.col("n_nationkey").cast("string")).alias("dst"))
    ns = supp.select(F.lit(HIER_TYPES["nation_supplier"]).alias("type"),
                     F.concat(F.lit("Nation:"), F.col("s_nationkey").cast("string")).alias("src"),
                     F.concat(F.lit("Supplier:"), F.col("s_suppkey").cast("string")).alias("dst"))
    return seed.unionByName(rn).unionByName(ns)


def _edges_sql() -> str:
    rows = [(t, f"{sl}:{sn}", f"{dl}:{dn}") for t, sl, sn, dl, dn in fixed.SEED_EDGES
            if t in fixed.PATH_EDGE_TYPES]
    vals = ", ".join(f"('{t}', '{s}', '{d}')" for t, s, d in rows)
    return f"""edges AS (
  SELECT * FROM (VALUES {vals}) v(type, src, dst)
  UNION ALL SELECT '{HIER_TYPES["region_nation"]}', 'Region:' || n_regionkey, 'Nation:' || n_nationkey FROM nation
  UNION ALL SELECT '{HIER_TYPES["nation_supplier"]}', 'Nation:' || s_nationkey, 'Supplier:' || s_suppkey FROM supplier),
e AS (SELECT type, src, dst, type || '|' || src || '|' || dst AS id FROM edges)"""


@register("edges_union", sql="WITH " + _edges_sql() + "\nSELECT type, src, dst FROM edges")
def edges_union(spark, sf_dir):
    # each table is one typed edge source, scanned once
    return path_edges(spark, sf_dir).select("type", "src", "dst")


@register("path_1_to_3", headline=True, sql="WITH " + _edges_sql() + """
SELECT 1 AS hops, src AS start, dst AS "end", src || '->' || dst AS path, type AS types FROM e
UNION ALL
SELECT 2, e1.src, e2.dst, e1.src || '->' || e1.dst || '->' || e2.dst, e1.type || ',' || e2.type
FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e1.id <> e2.id
UNION ALL
SELECT 3, e1.src, e3.dst, e1.src || '->' || e1.dst || '->' || e2.dst || '->' || e3.dst,
       e1.type || ',' || e2.type || ',' || e3.type
FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e1.id <> e2.id
JOIN e e3 ON e2.dst = e3.src AND e3.id <> e1.id AND e3.id <> e2.id""")
def path_1_to_3(spark, sf_dir):
    """Every path of 1..3 edges over the five edge types (the dashboard showed 25)."""
    e = path_edges(spark, sf_dir)
    e = e.withColumn("edge_id", F.concat_ws("|", "type", "src", "dst"))
    return PT.paths_up_to(e, 3)


@register("path_counts", sql="WITH " + _edges_sql() + """
SELECT 1 AS hops, src AS start, dst AS "end", count(*) AS n FROM e GROUP BY ALL
UNION ALL
SELECT 2, e1.src, e2.dst, count(*) FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e1.id <> e2.id GROUP BY ALL
UNION ALL
SELECT 3, e1.src, e3.dst, count(*) FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e1.id <> e2.id
JOIN e e3 ON e2.dst = e3.src AND e3.id <> e1.id AND e3.id <> e2.id GROUP BY ALL""")
def path_counts(spark, sf_dir):
    """The number of paths of 1..3 edges by endpoint pair, from products of edge counts."""
    return PT.path_counts(path_edges(spark, sf_dir))


@register("path_preview", sql="WITH " + _edges_sql() + """
SELECT * FROM (
  SELECT 1 AS hops, src AS start, dst AS "end", src || '->' || dst AS path, type AS types FROM e
  UNION ALL
  SELECT 2, e1.src, e2.dst, e1.src || '->' || e1.dst || '->' || e2.dst, e1.type || ',' || e2.type
  FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e1.id <> e2.id
  UNION ALL
  SELECT 3, e1.src, e3.dst, e1.src || '->' || e1.dst || '->' || e2.dst || '->' || e3.dst,
         e1.type || ',' || e2.type || ',' || e3.type
  FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e1.id <> e2.id
  JOIN e e3 ON e2.dst = e3.src AND e3.id <> e1.id AND e3.id <> e2.id) x
ORDER BY hops, path, types LIMIT 25""")
def path_preview(spark, sf_dir, limit: int = 25):
    """The dashboard's preview: the first ``limit`` paths in a total order."""
    return path_1_to_3(spark, sf_dir).orderBy("hops", "path", "types").limit(limit)
