"""Embedding near-dedup: spherical k-means cells, exact links.

Unit vectors are assigned to the nearest of a few centroids, fitted on a
bounded sample.  Two vectors at cosine t or more are at most
r = sqrt(2 - 2 t) apart, so a vector y whose home cell is h can be linked with
a home member of cell c only if y.h - y.c <= r |h - c|: for those c, y also
visits the cell.  A pair from two cells meets in the lower-numbered one, a
pair from one cell at home; no link is lost, whatever the centroids are.

Equal vectors are compared once, with their number.  Within a label and cell,
rows are dealt to blocks of bounded size, each pair of blocks is one group of
cosine products, and a group returns link counts and a spanning star of each
class found, never the pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import batches, cut, rows_of
from acctrecon.llm.components import components

COSINE = 0.98
#: Vectors that the centroids are fitted on, at most; vectors of one label
#: planned for a cell; cells, at most.
SAMPLE = 8192
CELL = 256
CELLS = 512
ROUNDS = 10
#: Bounds of a block's rows; between them it is the mean group's size.
BLOCK = (256, 4096)
_ROW = "part string, kind int, block int, node long, copies long, unit binary"


def unit_vector(values) -> np.ndarray | None:
    """The unit vector in double precision; None if it can link to nothing."""
    if values is None or any(v is None for v in values):
        return None
    x = np.array(values, dtype=np.float64)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        scale = np.abs(x).max(initial=0)
        if not np.isfinite(scale) or scale == 0:
            return None
        x = x / scale
        return x / np.sqrt(x @ x)


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, unit, same): same tells equal linkable vectors."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()),
                        ("unit", pa.binary()), ("same", pa.binary())])

    def run(stream):
        def rows():
            for vec, label, values in rows_of(stream):
                u = unit_vector(values) if label is not None and vec is not None else None
                if u is None:
                    yield vec, label, None, None, None
                else:
                    raw = np.asarray(values, dtype="<f8") + 0.0  # -0 is 0
                    data = f"{label}|".encode() + raw.tobytes()
                    yield vec, label, len(u), u.astype("<f8").tobytes(), hashlib.blake2b(data, digest_size=16).digest()
        yield from batches(rows(), schema, lambda r: len(r[3] or b"") + 64)

    return (vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding")
            .mapInArrow(run, "vec_id long, label string, dim int, unit binary, same binary"))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors; the first k distinct ones start."""
    c = np.unique(x[:4 * k], axis=0)[:k].copy()
    for _ in range(rounds):
        home = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.sqrt((total * total).sum(axis=1))
        c[norm > 0] = total[norm > 0] / norm[norm > 0][:, None]
    return c


def fit_cells(units: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for each dimension found in a sample of ``SAMPLE`` rows; so
    many that a cell has ``CELL`` vectors of the largest label, as vectors are
    compared within labels, but two of them at least."""
    largest = units.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    got = units.orderBy(F.xxhash64("same"), "same").limit(SAMPLE).select("dim", "unit").collect()
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.dim, []).append(np.frombuffer(r.unit))
    k = min(CELLS, max(2, -(-largest // CELL)), SAMPLE // 16)
    return {d: spherical_kmeans(np.array(v), min(k, len(v))) for d, v in by.items()}


def placed(units: DataFrame, cells: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """Each vector at home and in the cells that it visits: part, home (0 or
    1 for a visit), node, copies, unit."""
    # slack for rounding: a visit too many costs time, never a result
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
    apart = {d: np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T))) for d, c in cells.items()}
    schema = pa.schema([("part", pa.string()), ("visit", pa.int32()), ("node", pa.int64()),
                        ("copies", pa.int64()), ("unit", pa.binary())])

    def dealt_to(dim, held):
        x = np.frombuffer(b"".join([r[4] for r in held])).reshape(len(held), dim)
        y = x @ cells[dim].T
        home = y.argmax(axis=1)
        gap = y[np.arange(len(x)), home][:, None] - y
        visits = (gap <= reach * apart[dim][home] + 1e-6) & (np.arange(y.shape[1]) < home[:, None])
        for (node, label, _, copies, unit), h, row in zip(held, home.tolist(), visits):
            yield f"{dim}|{h}|{label}", 0, node, copies, unit
            for c in np.flatnonzero(row).tolist():
                yield f"{dim}|{c}|{label}", 1, node, copies, unit

    def run(stream):
        def rows():
            held: dict[int, list] = {}
            for row in rows_of(stream):
                if row[2] not in cells:
                    yield f"{row[2]}|0|{row[1]}", 0, row[0], row[3], row[4]
                    continue
                same = held.setdefault(row[2], [])
                same.append(row)
                if len(same) == 512:
                    yield from dealt_to(row[2], same)
                    same.clear()
            for dim, same in held.items():
                if same:
                    yield from dealt_to(dim, same)
        yield from batches(rows(), schema, lambda r: len(r[4]) + 96)

    return (units.select("node", "label", "dim", "copies", "unit")
            .mapInArrow(run, "part string, visit int, node long, copies long, unit binary"))


def dealt(rows: DataFrame) -> DataFrame:
    """The rows in each group of two blocks: part, left and right block,
    side.  Home blocks meet each other and the visiting blocks."""
    sizes = cut(rows.groupBy("part").agg(F.sum(1 - F.col("visit")).alias("homes"), F.sum("visit").alias("visits"))
                .where("homes > 0"), "sizes")
    mean = sizes.agg(F.avg("homes")).first()[0] or 1
    block = int(min(BLOCK[1], max(BLOCK[0], mean)))
    n = {c: F.ceil(F.col(c) / block).cast("int") for c in ("homes", "visits")}
    sized = (rows.join(sizes.select("part", n["homes"].alias("nh"), n["visits"].alias("nv")), "part")
             .withColumn("b", F.pmod(F.xxhash64("node"), F.when(F.col("visit") == 1, F.col("nv"))
                                     .otherwise(F.col("nh"))).cast("int")))
    every = lambda to, make: F.transform(F.sequence(F.lit(0), to - 1), make)
    none = F.array().cast("array<struct<left:int,right:int,visits:int,side:int>>")

    def group(left, right, visits, side):
        return F.struct(left.cast("int").alias("left"), right.cast("int").alias("right"),
                        F.lit(visits).alias("visits"), side.cast("int").alias("side"))

    at_home = every(F.col("nh"), lambda o: group(F.least(o, F.col("b")), F.greatest(o, F.col("b")), 0,
                                                 (F.col("b") > o).cast("int")))
    meets = F.when(F.col("nv") > 0, every(F.greatest("nv", F.lit(1)),
                                          lambda o: group(F.col("b"), o, 1, F.lit(0)))).otherwise(none)
    visits = every(F.col("nh"), lambda o: group(o, F.col("b"), 1, F.lit(1)))
    groups = F.when(F.col("visit") == 1, visits).otherwise(F.concat(at_home, meets))
    return (sized.select("part", "node", "copies", "unit", F.explode(groups).alias("g"))
            .select(F.concat_ws("|", "g.left", "g.right", "g.visits", "part").alias("part"), "g.side",
                    "node", "copies", "unit"))


def compared(rows: DataFrame, cosine: float) -> DataFrame:
    """(node, links, star): partial counts of linked other vectors, and a
    node of the same class to link to."""
    def compare(table):
        side = table["side"].to_numpy()
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy().astype(np.float64)
        x = np.frombuffer(b"".join(table["unit"].to_pylist())).reshape(len(node), -1)
        order = np.argsort(node, kind="stable")
        side, node, copies, x = side[order], node[order], copies[order], x[order]
        alone = not side.any()
        a = np.arange(len(node)) if alone else np.flatnonzero(side == 0)
        b = a if alone else np.flatnonzero(side == 1)
        links, star = np.zeros(len(node)), np.arange(len(node))
        step = max(1, (1 << 22) // max(1, len(b)))
        blocks = []
        for at in range(0, len(a), step):
            m = x[a[at:at + step]] @ x[b].T >= cosine
            if alone:
                m[np.arange(len(m)), at + np.arange(len(m))] = False
            links[a[at:at + step]] += m @ copies[b]
            if not alone:
                links[b] += copies[a[at:at + step]] @ m
            if m.any():
                blocks.append((a[at:at + step], m))
        while blocks:  # the smallest row of each class moves along its links
            old = star.copy()
            for rows_a, m in blocks:
                hit = m.any(axis=1)
                low = np.where(m[hit], star[b][None, :], len(star)).min(axis=1)
                star[rows_a[hit]] = np.minimum(star[rows_a[hit]], low)
                hit = m.any(axis=0)
                low = np.where(m[:, hit], star[rows_a][:, None], len(star)).min(axis=0)
                star[b[hit]] = np.minimum(star[b[hit]], low)
            star = star[star]
            if (star == old).all():
                break
        found = np.flatnonzero(links > 0)
        return pa.table({"node": node[found], "links": links[found].astype(np.int64), "star": node[star[found]]})

    return rows.groupBy("part").applyInArrow(compare, "node long, links long, star long")


def embedding_near_dedup(vectors: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id,
    n_links (other vectors at ``cosine`` or more with an equal label),
    component_id (smallest vec_id that links reach), kept (vec_id =
    component_id).

    Vectors that are null, empty, zero or hold null or non-finite components,
    and those with a null label or vec_id, link with nothing; vectors of
    different length do not link.  Rows that repeat a vec_id are vectors of
    their own that link with each other.  Other columns are not read; an empty
    table gives an empty result.
    """
    rows = cut(prepared(vectors), "vectors")
    # a vec_id can have several vectors, so each gets a number of its own,
    # which stays as it was written
    units = cut(rows.where("same is not null").groupBy("same")
                .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"),
                     F.first("dim").alias("dim"), F.first("unit").alias("unit"))
                .withColumn("node", F.monotonically_increasing_id()), "units")
    cells = fit_cells(units)
    found = cut(compared(dealt(placed(units, cells, cosine)), cosine), "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("star").alias("b")))
    known = cut(units.select(F.col("same").alias("_s"), "node", "copies", "least")
                .join(counts, "node", "left").join(classes, "node", "left")
                .select("_s", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least",
                        F.col("component").alias("class")), "known")
    least = (known.where("class is not null").groupBy("class").agg(F.min("least").alias("component"))
             .select(F.col("class").alias("_c"), "component"))
    # vectors that link with no other one are a class of their own
    known = (known.where("class is not null").join(least, F.col("class") == F.col("_c"))
             .select("_s", "n_links", "component")
             .union(known.where("class is null").select("_s", "n_links", "least")))
    return (rows.select("vec_id", "same").join(known, F.col("same") == F.col("_s"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
