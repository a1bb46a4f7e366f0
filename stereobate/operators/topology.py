"""Vertices, edges, faces and parts of meshes as tables. Keys: ``model_id``, ``face_id``; corners run from 0."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stereobate.functions.exprs import cell, corner, cross, dot, length, minus


def face_corners(tris: DataFrame, vertices: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Triangles (a, b, c) with the coordinates of their corners: ax .. cz. With ``counted`` each join is ``dealt`` by its number."""
    out = tris
    for k in "abc":
        if counted is not None:
            out = dealt(out, k, counted=counted)
        side = vertices.select(F.col("vid").alias(k), *[F.col(c).alias(f"{k}{c}") for c in "xyz"])
        out = out.join(side, k)
    return out


def triangulate(corners: DataFrame) -> DataFrame:
    """Polygons to a fan of triangles round the first corner: ``model_id, face_id, tri, a, b, c, material``."""
    order = Window.partitionBy("face_id").orderBy("corner")
    fan = corners.select("model_id", "face_id", "corner", F.first("vid").over(order).alias("a"), F.lag("vid").over(order).alias("b"), F.col("vid").alias("c"), F.first("material").over(order).alias("material"))
    return fan.where("corner >= 2").select("model_id", "face_id", (F.col("corner") - 1).cast("long").alias("tri"), "a", "b", "c", "material")


def edges(corners: DataFrame) -> DataFrame:
    """Directed sides of the faces, the last corner closing to the first: ``model_id, face_id, a, b, material``."""
    order = Window.partitionBy("face_id").orderBy("corner")
    nxt = F.coalesce(F.lead("vid").over(order), F.first("vid").over(order))
    return corners.select("model_id", "face_id", F.col("vid").alias("a"), nxt.alias("b"), "material")


def weld(vertices: DataFrame, weld_m: float) -> DataFrame:
    """``vid, weld_id``: vertices of one grid cell take the cell's smallest id."""
    cells = [cell(F.col(c), weld_m).alias(f"c{c}") for c in "xyz"]
    placed = vertices.select("vid", *cells)
    ids = placed.groupBy("cx", "cy", "cz").agg(F.min("vid").alias("weld_id"))
    return placed.join(ids, ["cx", "cy", "cz"]).select("vid", "weld_id")


def weld_robust(vertices: DataFrame, weld_m: float) -> DataFrame:
    """``vid, weld_id`` on eight grids, each shifted by half a cell in some axes.

    Points within half a cell meet on at least one grid. Chains of meeting points are one vertex unless they grow
    wider than ``weld_m``; those fall back to the plain grid.
    """
    grids = []
    for shift in range(8):
        cells = [cell(F.col(c) + (weld_m / 2 if shift >> i & 1 else 0.0), weld_m).alias(f"c{c}") for i, c in enumerate("xyz")]
        placed = vertices.select("vid", *cells)
        first = placed.groupBy("cx", "cy", "cz").agg(F.min("vid").alias("first"))
        grids.append(placed.join(first, ["cx", "cy", "cz"]).select(F.col("vid").alias("a"), F.col("first").alias("b")))
    label = components(vertices.select(F.col("vid").alias("node")), reduce(DataFrame.unionByName, grids))
    joined = vertices.join(label.withColumnRenamed("node", "vid"), "vid")
    wide = joined.groupBy("component").agg(F.greatest(*[F.max(c) - F.min(c) for c in "xyz"]).alias("width"))
    plain = weld(vertices, weld_m)
    out = joined.join(wide, "component").join(plain, "vid")
    return out.select("vid", F.when(F.col("width") <= weld_m, F.col("component")).otherwise(F.col("weld_id")).alias("weld_id"))


def edge_uses(sides: DataFrame, welded: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Undirected edges and how many sides use them: ``model_id, a, b, uses, winding``.

    ``winding`` is 0 where the sides run in both directions equally often. A side whose ends weld to one vertex still
    counts, as the edge (a, a). With ``counted`` joins and groups are ``dealt`` by its number.
    """
    if welded is not None:
        for end in "ab":
            if counted is not None:
                sides = dealt(sides, end, counted=counted)
            sides = sides.join(welded.select(F.col("vid").alias(end), F.col("weld_id").alias(f"w{end}")), end)
        sides = sides.drop("a", "b").withColumnsRenamed({"wa": "a", "wb": "b"})
    low, high = F.least("a", "b"), F.greatest("a", "b")
    sense = F.when(F.col("a") < F.col("b"), 1).when(F.col("a") > F.col("b"), -1).otherwise(0)
    uses = sides.select("model_id", low.alias("a"), high.alias("b"), sense.alias("sense"))
    if counted is not None:
        uses = dealt(uses, "model_id", "a", "b", counted=counted)
    return uses.groupBy("model_id", "a", "b").agg(F.count("*").alias("uses"), F.sum("sense").alias("winding"))


def edge_gate(uses: DataFrame, most_boundary: int = 0) -> DataFrame:
    """Boundary, manifold and non-manifold edges of each model, and the verdict."""
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    u = F.col("uses")
    out = uses.groupBy("model_id").agg(n(u == 1).alias("boundary"), n(u == 2).alias("manifold"), n(u > 2).alias("non_manifold"))
    return out.withColumn("status", F.when((F.col("non_manifold") == 0) & (F.col("boundary") <= most_boundary), "pass").otherwise("fail"))


def checkpoint_folder(spark: SparkSession, folder: str | None = None) -> None:
    """Have a reliable checkpoint folder set: the session's own, ``folder``, or the one that ``spark.checkpoint.dir`` names."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = folder or context.getConf().get("spark.checkpoint.dir")
        if shared is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            import tempfile

            shared = tempfile.mkdtemp(prefix="stereobate-")  # a local session has one machine only
        context.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: no lineage, no constraints to carry on, known sizes."""
    spark = df.sparkSession
    checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of one task, where they are dealt over tasks by a key.
DEALT = 50_000


def dealt(rows: DataFrame, *by: str, counted: DataFrame | None = None, each: int = DEALT) -> DataFrame:
    """The rows dealt over tasks by ``by``, as many tasks as their counted number asks for, whatever the session's setting.

    Groups, windows and joins whose keys hold ``by`` find their rows in place, so that no second shuffle follows. ``counted``
    is a table with about as many rows that is cheaper to count; a task gets about ``each`` of them.
    """
    n = (rows if counted is None else counted).count()
    return rows.repartition(max(1, -(-n // each)), *by)


SALTS = 8


def _salted(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """``pairs(u, v)`` with ``m`` of ``low(u, m)``; the neighbours of one ``u`` are dealt over SALTS tasks."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    return salted.join(low.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["u", "salt"]).drop("salt")


#: Links of one ``within`` up to this number are settled in one task; those of a larger one by rounds.
LOCAL_LINKS = 500_000


def _forests(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links (g, a, b) in the order of g -> ``g, u, v, whole``: each node and the least it reaches, ``most`` links of a g at a time.

    Of a g that is settled at once, nodes that are the least themselves are left out.
    """
    parent: dict[int, int] = {}
    out: tuple[list, list, list, list] = ([], [], [], [])
    group, held, split = None, 0, False

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def settle(whole: bool) -> None:
        for x in list(parent):
            if (least := find(x)) != x or not whole:
                out[0].append(group), out[1].append(x), out[2].append(least), out[3].append(whole)
        parent.clear()

    def rows() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.bool_())], ["g", "u", "v", "whole"])
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for g, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if g != group:
                settle(not split)
                group, held, split = g, 0, False
            elif held == most:
                held, split = 0, True
                settle(False)
            held += 1
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(out[0]) > 50_000:
            yield rows()
    settle(not split)
    yield rows()


def roots(links: DataFrame, folder: str | None = None, most: int = LOCAL_LINKS) -> DataFrame:
    """``links(g, a, b)`` of whole numbers, where no two ``g`` share nodes -> ``g, node, root``: the smallest node that each reaches.

    Nodes that reach no smaller one are left out. The links of a g of up to ``most`` are settled where they lie if they are
    dealt by g, else after one shuffle; only larger ones go on to the rounds of ``components``.
    """
    # The window has the links of a g beside each other; its column is read so that it is not left out.
    place = F.row_number().over(Window.partitionBy("g").orderBy("a"))
    lying = links.where("a <> b").select("g", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).withColumn("n", place)
    forests = cut(lying.mapInArrow(lambda batches: _forests(batches, most), "g long, u long, v long, whole boolean"))
    done = forests.where("whole").select("g", F.col("u").alias("node"), F.col("v").alias("root"))
    rest = forests.where("not whole").select("g", F.col("u").alias("a"), F.col("v").alias("b"))
    if rest.isEmpty():
        return done
    ends = rest.select("g", F.col("a").alias("node")).distinct()
    return done.unionByName(ends.join(components(ends.select("node"), rest.select("a", "b"), folder), "node").select("g", "node", F.col("component").alias("root")))


def components(nodes: DataFrame, links: DataFrame, folder: str | None = None, within: str | None = None, most: int = LOCAL_LINKS) -> DataFrame:
    """``nodes(node)``, ``links(a, b)`` -> ``node, component``: the smallest node that can be reached.

    Star contraction: every round hangs the larger neighbours of a node on its least neighbour, then the smaller
    ones. The rounds grow with the logarithm of the chain length, not with the length, and lineage is cut by
    ``checkpoint`` (reliable, in the shared checkpoint folder) after each. Joins on a hub are salted by its neighbour.

    ``within`` names a column of ``links`` (a model) whose values share no nodes, where ids are whole numbers: those of up
    to ``most`` links are settled where they lie, after one shuffle; only larger ones go on to the rounds.
    """
    checkpoint_folder(nodes.sparkSession, folder)
    if within is not None:
        done = roots(links.select(F.col(within).alias("g"), "a", "b"), folder, most)
        return nodes.select("node").distinct().join(done.select("node", "root"), "node", "left").select("node", F.coalesce("root", "node").alias("component"))
    at = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    seen = None
    while True:
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _salted(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _salted(large, low).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        at = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
    return nodes.select("node").distinct().join(at.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def tri_measures(tris: DataFrame) -> DataFrame:
    """Area, unit normal z, slope in degrees, centroid and extent in z of triangles with corner coordinates."""
    a, b, c = corner("a"), corner("b"), corner("c")
    n = cross(minus(b, a), minus(c, a))
    size = length(n)
    nz = F.when(size > 0, n[2] / size)
    return tris.withColumns({
        "area": size / 2, "nz": nz, "slope": F.degrees(F.acos(F.greatest(F.least(F.abs(nz), F.lit(1.0)), F.lit(0.0)))),
        "mx": (a[0] + b[0] + c[0]) / 3, "my": (a[1] + b[1] + c[1]) / 3, "mz": (a[2] + b[2] + c[2]) / 3,
        "zmin": F.least(a[2], b[2], c[2]), "zmax": F.greatest(a[2], b[2], c[2]),
    })


def face_measures(points: DataFrame) -> DataFrame:
    """Newell area vector, area and zero-area flag of polygons: ``model_id, face_id, corners, nx, ny, nz, area, flat``."""
    order = Window.partitionBy("face_id").orderBy("corner")
    nxt = {c: F.coalesce(F.lead(c).over(order), F.first(c).over(order)) for c in "xyz"}
    sides = points.select("model_id", "face_id", *"xyz", *[v.alias(f"{c}2") for c, v in nxt.items()])
    col = F.col
    newell = {"nx": (col("y") - col("y2")) * (col("z") + col("z2")), "ny": (col("z") - col("z2")) * (col("x") + col("x2")), "nz": (col("x") - col("x2")) * (col("y") + col("y2"))}
    out = sides.groupBy("model_id", "face_id").agg(F.count("*").alias("corners"), *[(F.sum(v) / 2).alias(k) for k, v in newell.items()])
    area = F.sqrt(col("nx") ** 2 + col("ny") ** 2 + col("nz") ** 2)
    return out.withColumn("area", area).withColumn("flat", F.col("area") < 1e-9)


def project_dominant(measures: DataFrame) -> DataFrame:
    """The axis to drop for a 2-D view of each face: that of the largest normal component, x before y before z."""
    x, y, z = (F.abs(F.col(f"n{c}")) for c in "xyz")
    return measures.withColumn("drop_axis", F.when((x >= y) & (x >= z), "x").when(y >= z, "y").otherwise("z"))


def canonical_faces(corners: DataFrame) -> DataFrame:
    """``model_id, face_id, loop``: the corner loop turned to its least start, of both directions the lesser."""
    loops = corners.groupBy("model_id", "face_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("corner", "vid"))), lambda s: s["vid"]).alias("loop"))
    turns = lambda a: F.transform(F.sequence(F.lit(1), F.size(a)), lambda i: F.concat(F.slice(a, i, F.size(a) - i + 1), F.slice(a, F.lit(1), i - 1)))
    return loops.withColumn("loop", F.array_min(F.concat(turns(F.col("loop")), turns(F.reverse("loop")))))


def duplicate_faces(corners: DataFrame) -> DataFrame:
    """Loops that more than one face of a model has: ``model_id, corners, copies, first_face``."""
    same = canonical_faces(corners).groupBy("model_id", "loop").agg(F.count("*").alias("copies"), F.min("face_id").alias("first_face"))
    return same.where("copies > 1").select("model_id", F.size("loop").cast("long").alias("corners"), "copies", "first_face")


def duplicate_vertices(vertices: DataFrame) -> DataFrame:
    """Places that more than one vertex has."""
    return vertices.groupBy("x", "y", "z").agg(F.count("*").alias("copies"), F.min("vid").alias("first_vid")).where("copies > 1")


def geometry_key(points: DataFrame, unit: float = 0.001) -> DataFrame:
    """``model_id, face_id, key``: sha-1 of the loop in millimetres from the box's low corner, winding kept."""
    face = Window.partitionBy("face_id")
    local = points.select("model_id", "face_id", "corner", *[F.bround((F.col(c) - F.min(c).over(face)) / unit).cast("long").alias(c) for c in "xyz"])
    place = F.format_string("%d,%d,%d", *"xyz")
    loops = local.groupBy("model_id", "face_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("corner", place.alias("place")))), lambda s: s["place"]).alias("p"))
    turns = F.transform(F.sequence(F.lit(1), F.size("p")), lambda i: F.array_join(F.concat(F.slice("p", i, F.size("p") - i + 1), F.slice("p", F.lit(1), i - 1)), ";"))
    return loops.select("model_id", "face_id", F.sha1(F.array_min(turns)).alias("key"))


def mesh_inventory(corners: DataFrame, vertices: DataFrame) -> DataFrame:
    """One row for each mesh: faces, corners, triangles, used vertices, boundary, multi-face and degenerate sides, extents."""
    by = ["model_id", "mesh"]
    located = corners.join(vertices, "vid")
    base = located.groupBy(*by).agg(F.countDistinct("face_id").alias("faces"), F.count("*").alias("corners"), F.countDistinct("vid").alias("used_vertices"), *[F.min(c).alias(f"{c}min") for c in "xyz"], *[F.max(c).alias(f"{c}max") for c in "xyz"])
    order = Window.partitionBy("face_id").orderBy("corner")
    sides = corners.select(*by, F.col("vid").alias("a"), F.coalesce(F.lead("vid").over(order), F.first("vid").over(order)).alias("b"))
    uses = sides.groupBy(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("n"))
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    kinds = uses.groupBy(*by).agg(n(F.col("n") == 1).alias("boundary"), n(F.col("n") > 2).alias("multi_face"), n(F.col("a") == F.col("b")).alias("degenerate"))
    return base.withColumn("triangles", F.col("corners") - 2 * F.col("faces")).join(kinds, by)


def interface_edges(sides: DataFrame) -> DataFrame:
    """Edges that faces of two or more materials share: ``model_id, low, high, edges``."""
    owned = sides.groupBy("model_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("material").alias("low"), F.max("material").alias("high")).where("low <> high")
    return owned.groupBy("model_id", "low", "high").agg(F.count("*").alias("edges"))


#: Sides opposite to a vertex up to this number are joined to fans within its row; those of a busier vertex by ``components``.
LOCAL_SIDES = 256


def fan_vertices(tris: DataFrame, local_sides: int = LOCAL_SIDES, counted: DataFrame | None = None) -> DataFrame:
    """Vertices round which the triangles of a model form more than one fan: ``model_id, vid, fans``.

    Every triangle at a vertex links the two other corners; fans are the components of those links. They are local to
    the vertex, so no graph over the whole fleet is needed, but for vertices that more than ``local_sides`` links meet. With
    ``counted`` the links are ``dealt`` by vertex and its number.
    """
    turn = lambda v, p, q: F.struct(F.col(v).alias("vid"), F.least(p, q).alias("p"), F.greatest(p, q).alias("q"))
    links = tris.select("model_id", F.explode(F.array(turn("a", "b", "c"), turn("b", "c", "a"), turn("c", "a", "b"))).alias("s")).select("model_id", "s.*").where("vid <> p and vid <> q and p <> q")
    if counted is not None:
        links = dealt(links, "model_id", "vid", counted=counted)
    # A window, not a join with the counts: the links of a vertex stay where the distinct of it has put them.
    sized = links.distinct().withColumn("n", F.count("*").over(Window.partitionBy("model_id", "vid"))).where("n > 1")

    few = sized.where(F.col("n") <= local_sides).groupBy("model_id", "vid").agg(F.collect_list(F.array("p", "q")).alias("sides"))
    apart = lambda fans, s: F.filter(fans, lambda f: ~F.arrays_overlap(f, s))
    grown = lambda fans, s: F.array_distinct(F.concat(s, F.flatten(F.filter(fans, lambda f: F.arrays_overlap(f, s)))))
    joined = F.aggregate("sides", F.expr("cast(array() as array<array<bigint>>)"), lambda fans, s: F.concat(apart(fans, s), F.array(grown(fans, s))))
    local = few.select("model_id", "vid", F.size(joined).cast("long").alias("fans"))

    many = sized.where(F.col("n") > local_sides).select("model_id", "vid", "p", "q")
    if many.isEmpty():
        return local.where("fans > 1")
    node = lambda c: F.xxhash64("model_id", "vid", c)
    ends = many.select("model_id", "vid", F.explode(F.array("p", "q")).alias("x")).distinct().withColumn("node", node("x"))
    label = components(ends.select("node"), many.select(node("p").alias("a"), node("q").alias("b")))
    busy = ends.join(label, "node").groupBy("model_id", "vid").agg(F.countDistinct("component").alias("fans"))
    return local.unionByName(busy).where("fans > 1")


def dominant_planes(tris: DataFrame, min_area: float, counted: DataFrame | None = None) -> DataFrame:
    """Axis-parallel planes that hold at least ``min_area``: ``model_id, axis, coordinate, area, faces``. With ``counted`` the
    triangles are ``dealt`` by face and its number."""
    a, b, c = corner("a"), corner("b"), corner("c")
    n = cross(minus(b, a), minus(c, a))
    size = length(n)
    sized = tris.select("model_id", "face_id", *[x.alias(f"n{i}") for i, x in enumerate(n)], *[x.alias(f"a{i}") for i, x in enumerate(a)], size.alias("size")).where("size > 0")
    # At most one axis is that close to the normal, so the triangles are read once.
    lying = F.coalesce(*[F.when(F.abs(F.col(f"n{i}")) > 0.999 * F.col("size"), F.struct(F.lit(axis).alias("axis"), F.bround(F.col(f"a{i}"), 2).alias("coordinate"))) for i, axis in enumerate("xyz")])
    flats = sized.select("model_id", "face_id", lying.alias("on"), (F.col("size") / 2).alias("area")).where("on is not null").select("model_id", "face_id", "on.*", "area")
    if counted is not None:
        flats = dealt(flats, "face_id", counted=counted)
    of_face = flats.groupBy("model_id", "axis", "coordinate", "face_id").agg(F.sum("area").alias("area"))
    out = of_face.groupBy("model_id", "axis", "coordinate").agg(F.sum("area").alias("area"), F.count("face_id").alias("faces"))
    return out.where(F.col("area") >= min_area)


def section(tris: DataFrame, z: float, clear: float = 1e-4) -> DataFrame:
    """Segments where triangles with corner coordinates cross the height z; the cut moves up by ``clear`` off vertices.

    ``model_id, face_id, tri, x0, y0, x1, y1``; the segment runs from the lower-numbered crossing side on.
    """
    a, b, c = corner("a"), corner("b"), corner("c")
    near = F.least(*[F.abs(p[2] - z) for p in (a, b, c)]) < clear
    moved = tris.groupBy("model_id").agg(F.max(near).alias("near"))
    at = F.when(F.col("near"), F.lit(z + clear)).otherwise(F.lit(z))
    cut = tris.join(moved, "model_id").withColumn("cut", at)
    h = F.col("cut")
    cut = cut.where((F.least(a[2], b[2], c[2]) < h) & (F.greatest(a[2], b[2], c[2]) > h))

    def cross_at(p, q):
        t = (h - p[2]) / (q[2] - p[2])
        return F.when((p[2] < h) != (q[2] < h), F.struct((p[0] + t * (q[0] - p[0])).alias("x"), (p[1] + t * (q[1] - p[1])).alias("y")))

    ends = F.filter(F.array(cross_at(a, b), cross_at(b, c), cross_at(c, a)), lambda s: s.isNotNull())
    return cut.withColumn("ends", ends).select("model_id", "face_id", "tri", F.col("ends")[0]["x"].alias("x0"), F.col("ends")[0]["y"].alias("y0"), F.col("ends")[1]["x"].alias("x1"), F.col("ends")[1]["y"].alias("y1"))


def plan_cells(tris: DataFrame, size: float) -> DataFrame:
    """Plan cells whose centre a triangle covers from above: ``model_id, i, j`` (distinct). Each triangle is cut into its box's cells."""
    a, b, c = corner("a"), corner("b"), corner("c")
    lo = lambda k: F.floor(F.least(a[k], b[k], c[k]) / size - 0.5).cast("int")
    hi = lambda k: F.ceil(F.greatest(a[k], b[k], c[k]) / size - 0.5).cast("int")
    cells = tris.withColumn("i", F.explode(F.sequence(lo(0), hi(0)))).withColumn("j", F.explode(F.sequence(lo(1), hi(1))))
    x, y = (F.col("i") + 0.5) * size, (F.col("j") + 0.5) * size
    side = lambda p, q: (q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0])
    d = [side(a, b), side(b, c), side(c, a)]
    twice = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    inside = (F.abs(twice) > 1e-12) & ((F.least(*d) >= 0) | (F.greatest(*d) <= 0))
    return cells.where(inside).select("model_id", "i", "j").distinct()


__all__ = ["canonical_faces", "checkpoint_folder", "components", "cut", "dealt", "dominant_planes", "dot", "duplicate_faces", "duplicate_vertices", "edge_gate", "edge_uses", "edges", "face_corners", "face_measures", "fan_vertices", "geometry_key", "interface_edges", "mesh_inventory", "plan_cells", "project_dominant", "roots", "section", "tri_measures", "triangulate", "weld", "weld_robust"]
