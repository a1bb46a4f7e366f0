"""The driver's tables seen as the tables of a model fleet, for Spark and, as CTEs, for DuckDB.

A face is an order with three or more lines, its corners the lines in the order (line number, part, supplier), a
vertex a part, a model a twentieth of the customers, a mesh an order priority.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stereobate.operators.topology import DEALT, dealt

#: Lines of one task where each is spread over many cells and sorted there, so that nothing is spilled.
FEW = 10_000
LEVELS = [("L0", 0.0), ("L1", 2.0), ("L2", 4.0), ("L3", 6.0), ("L4", 8.0), ("L5", 10.0)]
# First and last material id of each group.
MATERIAL_RANGES = [("facade", 1, 5), ("reveal", 6, 10), ("opening", 11, 15), ("glass", 16, 20), ("roof", 21, 25), ("ground", 26, 30), ("decor", 31, 35)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vid, x, y, z``"""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vid"), (F.col("p_size") * 0.25).alias("x"), (F.col("p_partkey") % 16 * 0.25).alias("y"), F.floor((F.col("p_retailprice") - 900) / 10).cast("double").alias("z"))


def corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_id, mesh, face_id, corner, vid, material``: one row for each corner of a face."""
    lines = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey")
    owner = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 20).alias("model_id"), F.col("o_orderpriority").alias("mesh"))
    face = Window.partitionBy("l_orderkey")
    placed = lines.withColumn("n", F.count("*").over(face)).withColumn("corner", (F.row_number().over(face.orderBy("l_linenumber", "l_partkey", "l_suppkey")) - 1).cast("long")).where("n >= 3")
    return placed.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select("model_id", "mesh", F.col("l_orderkey").alias("face_id"), "corner", F.col("l_partkey").alias("vid"), (F.col("l_suppkey") % 36).alias("material"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``corners`` with ``x, y, z``."""
    return corners(spark, sf_dir).join(vertices(spark, sf_dir), "vid")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_id, face_id, x0, x1, y0, y1, z0, z1``: the bounding box of each face."""
    ends = [f(c).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))]
    return points(spark, sf_dir).groupBy("model_id", "face_id").agg(*ends)


def levels(spark: SparkSession) -> DataFrame:
    """``level, elev``: the fixed storeys."""
    return spark.createDataFrame(LEVELS, "level string, elev double")


def material_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MATERIAL_RANGES, "material_group string, first_id long, last_id long")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``face_id, seq, lo, hi``: the lines of an order as intervals on one line."""
    order = Window.partitionBy("l_orderkey").orderBy("l_quantity", "l_discount", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("face_id"), F.row_number().over(order).cast("long").alias("seq"), F.col("l_quantity").alias("lo"), (F.col("l_quantity") + F.round(F.col("l_discount") * 100)).alias("hi"))


def panels(spark: SparkSession, sf_dir: str, by: str = "model_id", each: int = DEALT) -> DataFrame:
    """``model_id, face_id, part, kind, axis, x0, x1, y0, y1, z0, z1``: each line as an axis-parallel rectangle on a quarter grid.

    256 orders make a model, so that a model's density is the same at every size. ``axis`` 0, 1, 2: the plane is x, y, z.
    Lines are dealt over tasks by model or by part, ``each`` a task, so groups and windows whose keys hold it find their rows in place.
    Dealt by ``pair`` an even model lies with the odd one after it, and the column comes along.
    """
    order = Window.partitionBy(*dict.fromkeys([by, "model_id", "part"])).orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    c = F.col
    read = table(spark, sf_dir, "lineitem").select(F.floor(c("l_orderkey") / 256).alias("model_id"), c("l_orderkey").alias("part"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    if by == "pair":
        read = read.withColumn("pair", F.floor(c("model_id") / 2))
    lines = dealt(read, by, each=each).withColumn("seq", F.row_number().over(order).cast("long"))
    at = {"p": c("l_partkey") % 24 * 0.25, "u": F.floor("l_extendedprice") % 32 * 0.25, "v": F.floor(c("l_extendedprice") / 32) % 32 * 0.25}
    size = {"w": 0.25 + F.floor("l_quantity") % 4 * 0.25, "h": 0.25 + c("l_suppkey") % 4 * 0.25}
    more = ["pair"] if by == "pair" else []
    p = lines.select(*more, "model_id", (c("part") * 100 + c("seq")).alias("face_id"), "part", (c("l_suppkey") % 36).alias("kind"), (c("seq") % 3).cast("int").alias("axis"), *[v.cast("double").alias(k) for k, v in (at | size).items()])
    u, v, flat = (c("u"), c("u") + c("w")), (c("v"), c("v") + c("h")), (c("p"), c("p"))
    runs = {"x": (flat, u, u), "y": (u, flat, v), "z": (v, v, flat)}  # along each axis, for planes x, y, z
    ends = [F.when(c("axis") == 0, on_x[i]).when(c("axis") == 1, on_y[i]).otherwise(on_z[i]).alias(f"{k}{i}") for k, (on_x, on_y, on_z) in runs.items() for i in (0, 1)]
    return p.select(*more, "model_id", "face_id", "part", "kind", "axis", *ends)


def panel_faces(spark: SparkSession, sf_dir: str, each: int = DEALT, by: str = "model_id") -> DataFrame:
    """``panels`` with ``pts``, the corners in turn."""
    c = F.col
    at = lambda x, y, z: F.struct(c(x).alias("x"), c(y).alias("y"), c(z).alias("z"))
    rings = [[("x0", "y0", "z0"), ("x0", "y1", "z0"), ("x0", "y1", "z1"), ("x0", "y0", "z1")], [("x0", "y0", "z0"), ("x1", "y0", "z0"), ("x1", "y0", "z1"), ("x0", "y0", "z1")], [("x0", "y0", "z0"), ("x1", "y0", "z0"), ("x1", "y1", "z0"), ("x0", "y1", "z0")]]
    ring = [F.array(*[at(*p) for p in r]) for r in rings]
    return panels(spark, sf_dir, by, each).withColumn("pts", F.when(c("axis") == 0, ring[0]).when(c("axis") == 1, ring[1]).otherwise(ring[2]))


def model_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_id, level, elev``: each panel model's own storeys; those of odd models stand a quarter higher."""
    listed = F.array(*[F.struct(F.lit(n).alias("level"), F.lit(e).alias("elev")) for n, e in LEVELS])
    models = panels(spark, sf_dir).select("model_id").distinct()
    return models.select("model_id", F.explode(listed).alias("l")).select("model_id", "l.level", (F.col("l.elev") + F.col("model_id") % 2 * 0.25).alias("elev"))


def plan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_id, face_id, px, py, qx, qy``: upright panels seen from above."""
    return panels(spark, sf_dir).where("axis < 2").select("model_id", "face_id", F.col("x0").alias("px"), F.col("y0").alias("py"), F.col("x1").alias("qx"), F.col("y1").alias("qy"))


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_id, stage, name, status``: events as findings."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "fail").when(kind == "click", "review").when(kind == "view", "not_run").otherwise("pass")
    return table(spark, sf_dir, "events").select((F.col("event_id") % 7).alias("model_id"), (F.col("user_id") % 17).alias("stage"), kind.alias("name"), status.alias("status"), "event_id")


_CTE = {
    "vertices": "SELECT p_partkey AS vid, p_size * 0.25::DOUBLE AS x, (p_partkey % 16) * 0.25::DOUBLE AS y, floor((p_retailprice - 900) / 10) AS z FROM part",
    "corners": """SELECT o_custkey % 20 AS model_id, o_orderpriority AS mesh, l_orderkey AS face_id,
                         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS corner, l_partkey AS vid, l_suppkey % 36 AS material
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey QUALIFY count(*) OVER (PARTITION BY l_orderkey) >= 3""",
    "points": "SELECT c.*, v.x, v.y, v.z FROM corners c JOIN vertices v USING (vid)",
    "boxes": "SELECT model_id, face_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM points GROUP BY ALL",
    "levels": "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {e}::DOUBLE)" for n, e in LEVELS) + ") t(level, elev)",
    "ranges": "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {a}, {b})" for n, a, b in MATERIAL_RANGES) + ") t(material_group, first_id, last_id)",
    "intervals": """SELECT l_orderkey AS face_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_discount, l_partkey, l_suppkey, l_extendedprice) AS seq,
                           l_quantity AS lo, l_quantity + round(l_discount * 100) AS hi FROM lineitem""",
    "findings": """SELECT event_id % 7 AS model_id, user_id % 17 AS stage, event_type AS name,
                          CASE event_type WHEN 'error' THEN 'fail' WHEN 'click' THEN 'review' WHEN 'view' THEN 'not_run' ELSE 'pass' END AS status, event_id FROM events""",
    "panels": """SELECT model_id, face_id, part, kind, axis, CASE axis WHEN 0 THEN p ELSE u END AS x0, CASE axis WHEN 0 THEN p ELSE u + w END AS x1,
                        CASE axis WHEN 0 THEN u WHEN 1 THEN p ELSE v END AS y0, CASE axis WHEN 0 THEN u + w WHEN 1 THEN p ELSE v + h END AS y1,
                        CASE axis WHEN 2 THEN p ELSE v END AS z0, CASE axis WHEN 2 THEN p ELSE v + h END AS z1
                 FROM (SELECT l_orderkey // 256 AS model_id, l_orderkey * 100 + seq AS face_id, l_orderkey AS part, l_suppkey % 36 AS kind, (seq % 3)::INT AS axis,
                              (l_partkey % 24) * 0.25::DOUBLE AS p, floor(l_extendedprice)::BIGINT % 32 * 0.25::DOUBLE AS u, floor(l_extendedprice / 32)::BIGINT % 32 * 0.25::DOUBLE AS v,
                              0.25::DOUBLE + floor(l_quantity)::BIGINT % 4 * 0.25::DOUBLE AS w, 0.25::DOUBLE + l_suppkey % 4 * 0.25::DOUBLE AS h
                       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS seq FROM lineitem))""",
    "model_levels": "SELECT model_id, level, elev + model_id % 2 * 0.25::DOUBLE AS elev FROM (SELECT DISTINCT model_id FROM panels), levels",
    "plan_segments": "SELECT model_id, face_id, x0 AS px, y0 AS py, x1 AS qx, y1 AS qy FROM panels WHERE axis < 2",
    "panel_sides": """SELECT model_id, face_id, c[1] AS ax, c[2] AS ay, c[3] AS az, d[1] AS bx, d[2] AS by_, d[3] AS bz FROM (
                        SELECT model_id, face_id, r[i] AS c, r[i % 4 + 1] AS d FROM (
                          SELECT model_id, face_id, CASE axis WHEN 0 THEN [[x0,y0,z0],[x0,y1,z0],[x0,y1,z1],[x0,y0,z1]] WHEN 1 THEN [[x0,y0,z0],[x1,y0,z0],[x1,y0,z1],[x0,y0,z1]]
                                 ELSE [[x0,y0,z0],[x1,y0,z0],[x1,y1,z0],[x0,y1,z0]] END AS r FROM panels), range(1, 5) t(i))""",
    "open_sides": """SELECT model_id, min(face_id) AS face_id, p[1] AS ax, p[2] AS ay, p[3] AS az, q[1] AS bx, q[2] AS by_, q[3] AS bz
                     FROM (SELECT model_id, face_id, least([ax,ay,az],[bx,by_,bz]) AS p, greatest([ax,ay,az],[bx,by_,bz]) AS q FROM panel_sides) GROUP BY model_id, p, q HAVING count(*) = 1""",
    "edges": """SELECT model_id, face_id, vid AS a, coalesce(lead(vid) OVER w, first_value(vid) OVER w) AS b, material FROM corners WINDOW w AS (PARTITION BY face_id ORDER BY corner)""",
    "tris": """SELECT model_id, face_id, tri, a, b, c, material FROM (
                 SELECT model_id, face_id, corner - 1 AS tri, first_value(vid) OVER w AS a, lag(vid) OVER w AS b, vid AS c, first_value(material) OVER w AS material, corner
                 FROM corners WINDOW w AS (PARTITION BY face_id ORDER BY corner)) WHERE corner >= 2""",
    "tri_points": """SELECT t.*, p.x AS ax, p.y AS ay, p.z AS az, q.x AS bx, q.y AS by_, q.z AS bz, r.x AS cx, r.y AS cy, r.z AS cz
                     FROM tris t JOIN vertices p ON t.a = p.vid JOIN vertices q ON t.b = q.vid JOIN vertices r ON t.c = r.vid""",
}
_NEEDS = {"model_levels": ["panels", "levels"], "plan_segments": ["panels"], "panel_sides": ["panels"], "open_sides": ["panel_sides"], "points": ["corners", "vertices"], "boxes": ["points"], "edges": ["corners"], "tris": ["corners"], "tri_points": ["tris", "vertices"]}


def with_(*names: str) -> str:
    """A WITH clause of the named views and what they need; a query's own CTEs may follow after a comma."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in _NEEDS.get(name, []):
            add(x)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTE[n]})" for n in order)


#: Spark's setting by which a join shuffles rows again that are dealt by some of its columns only.
REDEAL = "spark.sql.requireAllClusterKeysForCoPartition"


def placed(spark: SparkSession, here: bool) -> None:
    """Have joins on a model and more columns find their rows where they are dealt by model (``here``), or leave that to Spark.

    Read when a plan is made, so it holds until the next query of the session is asked for; results are the same.
    """
    if here:
        spark.conf.set(REDEAL, "false")
    elif REDEAL not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.unset(REDEAL)


class Registry:
    """Queries and their SQL, filled by the modules of ``plans``."""

    def __init__(self):
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, here: bool = False):
        """``here``: the query's large tables are all dealt by model, and its joins stay there (``placed``)."""

        def keep(f):
            @wraps(f)
            def asked(spark, sf):
                placed(spark, here)
                return f(spark, sf)

            self.queries[name] = asked
            if sql is not None:
                self.sql[name] = sql
            return f

        return keep
