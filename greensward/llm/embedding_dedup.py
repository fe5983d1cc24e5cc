"""Near duplicates among embeddings of one label, by flat graphs over clusters of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.llm.flat_graph import all_pairs, k_means, lowest_labels, near_pairs, nearest
from greensward.operators.graph import connected_components
from greensward.plans.scratch import Scratch

#: Vectors of a cell about, centres of a group at most and their numbers in all, sampled vectors for each centre, bisectors held against the link radius.
CELL, MAX_CENTRES, CENTRE_VALUES, PER_CENTRE, BISECTORS = 1500, 4096, 1 << 20, 16, 4
#: Larger cells are cut into blocks of half so many vectors; vectors dealt to centres at a time.
MAX_GROUP, DEAL = 4096, 8192
#: Queries of the audit: classes that hold an id that this number divides, each against all vectors of its label. The recall that stops the widening of graphs and beams, and the one below which groups are finished exactly.
AUDIT_EVERY, RECALL, LEAST_RECALL, WIDTHS = 100, 0.97, 0.9, (1, 2, 4)
#: Queries and vectors of a block of the audit.
AUDIT_QUERIES, AUDIT_VECTORS = 2048, 16384

NODE = ["part", "c1", "c2", "home", "id", "copies", "v"]


def unit_vector(v: Column) -> Column:
    """The vector scaled to length 1 in double precision; null if it is null or zero or holds nulls or non-finite components."""

    @F.arrow_udf("array<double>")
    def unit(v: pa.Array) -> pa.Array:
        out: list[np.ndarray | None] = []
        for x in v:
            d = np.array(x.as_py() or [], np.float64)  # nulls become NaN
            top = np.abs(d).max(initial=0.0)
            d = d / top if 0 < top < np.inf else None
            out.append(None if d is None else d / np.sqrt((d * d).sum()))
        return pa.array(out, pa.list_(pa.float64()))

    return unit(v)


def embedding_components(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audit_recall``, a row for each row of ``vectors``.

    Vectors with the same label and length are linked when their cosine is
    found to be ``least`` or more. Equal vectors are one node with a count, so
    any number of copies costs one vector. The vectors of a large label live in
    the nearest of its cells, and of a large cell in the nearest of its own
    cells (``_split``); they visit every cell of a smaller number that the link
    radius can reach, so each pair in range shares one group. There overlapping
    shards are built into robust-pruned graphs, their adjacency lists united,
    and searched from medoids (``flat_graph``). Every pair that is found is
    verified in double precision and counts for both its ends.

    ``audit_recall`` is the share of the audited queries' links, by brute force
    against all vectors of their label, that the search has found (1 if there
    are none), the same in every row. Below ``RECALL`` the search is done again
    with wider lists and beams, twice at most; if it is below ``LEAST_RECALL``
    then, the groups are finished by products of all their pairs, so less is
    never returned.

    Vectors without a label, null, zero, or with null or non-finite components,
    and rows with a null id, have no links and are components of their own.
    ``kept`` is ``vec_id = component_id``. Empty tables give empty results;
    other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    v = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[label].alias("label"), vectors[embedding].alias("raw"))
    v = v.withColumn("v", F.when(F.col("label").isNotNull() & F.col("vec_id").isNotNull(), unit_vector(F.col("raw"))))
    v = v.withColumn("part", F.struct("label", F.size("v").alias("dim")))
    rows = v.select("vec_id", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")).alias("a"), F.when(F.col("v").isNotNull(), F.xxhash64("v", "label", F.lit(1))).alias("b"))
    nodes = v.where("v is not null").groupBy(F.xxhash64("label", "v").alias("a"), F.xxhash64("v", "label", F.lit(1)).alias("b"))
    asked = F.max(F.col("vec_id") % AUDIT_EVERY == 0).alias("asked")
    nodes = scratch.put(nodes.agg(F.min("vec_id").alias("id"), asked, F.count(F.lit(1)).alias("copies"), F.first("part").alias("part"), F.first("v").alias("v")), "nodes")
    # numbers of their own, since one vec_id may stand on several vectors
    nodes = scratch.put(nodes.withColumnRenamed("id", "first").withColumn("id", F.monotonically_increasing_id()), "numbered")
    placed = nodes.select("part", F.lit(0).alias("c1"), F.lit(0).alias("c2"), F.lit(True).alias("home"), "id", "copies", "v")
    placed = _split(_split(placed, "c1", ["part"], least, scratch), "c2", ["part", "c1"], least, scratch)
    true = scratch.put(_true_links(nodes, least, scratch), "true")
    for width in (*WIDTHS, None):
        found = scratch.put(_search(placed, least, width, scratch), "found")
        links = scratch.put(found.groupBy("id").agg(F.sum("links").alias("links")), "links")
        got = true.join(links, "id", "left").agg(F.sum(F.coalesce("links", F.lit(0))).alias("got"), F.sum("true").alias("true")).first()
        recall = got.got / got.true if got.true else 1.0
        if recall >= (LEAST_RECALL if width == WIDTHS[-1] else RECALL):
            break
    roots = connected_components(found.where("root <> id").select(F.col("id").alias("src"), F.col("root").alias("dst")), scratch=scratch)
    known = nodes.select(F.col("a").alias("ka"), F.col("b").alias("kb"), "id", "first", "copies").join(links, "id", "left").join(roots, "id", "left")
    known = scratch.put(known.withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1).where("links > 0"), "linked")
    lowest = known.where("component is not null").groupBy("component").agg(F.min("first").alias("low"))
    known = scratch.put(known.join(lowest, "component", "left").select("ka", "kb", "links", F.coalesce("low", "first").alias("root")), "known")
    scratch.keep(known)
    out = rows.join(scratch.small(known), (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    return out.withColumns({"kept": F.col("vec_id").eqNullSafe(F.col("component_id")), "audit_recall": F.lit(float(recall))})


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    v = column.combine_chunks()
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def reach(x: np.ndarray, centres: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and whether a point within ``radius`` of the row can have each centre as its nearest.

    Such a point lies on the centre's side of its bisector with any other
    centre, so the row lies no further than ``radius`` beyond that bisector.
    The bisectors with the ``BISECTORS`` nearest centres are looked at.
    """
    sim = x @ centres.T
    top = nearest(x, centres, BISECTORS)
    inside = np.ones(sim.shape, bool)
    rows = np.arange(len(x))
    for c in top.T:
        apart = np.sqrt(np.maximum(2 - 2 * (centres[c] @ centres.T), 1e-12))
        inside &= sim[rows, c][:, None] - sim <= (radius + 1e-9) * apart
    return top[:, 0], inside


def merged(centres: np.ndarray, least: float) -> np.ndarray:
    """For each centre the smallest one that it joins over steps of at least ``least``."""
    low = np.arange(len(centres))
    for i in range(len(centres)):
        for t in np.unique(low[np.flatnonzero(centres @ centres[i] >= least)]):
            a, b = sorted((low[i], t))
            low[low == b] = a
    return low


def _split(placed: DataFrame, into: str, by: list[str], least: float, scratch: Scratch) -> DataFrame:
    """Deal groups of more than ``2 * CELL`` vectors out to cells: the column ``into`` gets their numbers.

    Centres are fitted in a task for each group, to a sample of at most
    ``PER_CENTRE`` vectors for each; a group has at most ``MAX_CENTRES`` of
    them, and a second split of its cells brings as many again. Centres that
    lie within the link radius of each other are one cell. A vector at home
    stays in its nearest cell and visits those before it that the radius can
    reach; a visitor visits all of these.
    """
    dim = F.col("part.dim")
    most = F.greatest(F.lit(1), F.least(F.lit(MAX_CENTRES), F.floor(F.lit(CENTRE_VALUES) / dim)))
    sizes = placed.groupBy(*by).agg(F.count_if("home").alias("m"), F.count(F.lit(1)).alias("all")).where(F.col("m") > 2 * CELL)
    sizes = sizes.withColumns({"k": F.least(F.ceil(F.col("m") / CELL), most), "deals": F.ceil(F.col("all") / DEAL).cast("int")})
    sizes = scratch.put(sizes, "sizes")
    if sizes.isEmpty():
        return placed
    large = scratch.small(sizes)
    share = F.least(F.lit(1.0), PER_CENTRE * F.col("k") / F.col("m")) * (1 << 30)
    sample = placed.where("home").join(large, by).where(F.pmod(F.xxhash64("id", F.lit(into)), F.lit(1 << 30)) < share)

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        x = _stack(table.column("v"))[order]
        c = k_means(x, min(len(x), table.column("k")[0].as_py()))
        return table.slice(0, 1).select([*by, "deals"]).append_column("centres", pa.array([c.tobytes()], pa.binary()))

    schema = placed.select(*by).schema.add("deals", "integer").add("centres", "binary")
    fitted = scratch.put(sample.select(*by, "k", "deals", "id", "v").groupBy(*by).applyInArrow(fit, schema), "centres")
    fitted = fitted.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
    rows = placed.join(large.select(*by, "deals"), by).withColumn("deal", F.pmod(F.xxhash64("id", F.lit(3)), F.col("deals")).cast("int"))
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))

    def near(rows: pa.Table, centres: pa.Table) -> pa.Table:
        rows = rows.select(NODE).combine_chunks()
        if not rows.num_rows:
            return rows
        x, at_home = _stack(rows.column("v")), rows.column("home").to_numpy()
        c = np.frombuffer(centres.column("centres")[0].as_py()).reshape(-1, x.shape[1])
        numbers, where = np.unique(merged(c, least), return_inverse=True)
        index, home, cell = [], [], []
        for s in range(0, len(x), 512):
            top, inside = reach(x[s : s + 512], c, radius)
            cells = np.zeros((len(top), len(numbers)), bool)
            q, j = np.nonzero(inside)
            cells[q, where[j]] = True
            mine, here = where[top], at_home[s : s + 512]
            cells &= ~here[:, None] | (np.arange(len(numbers)) < mine[:, None])
            q, j = np.nonzero(cells)
            h = np.flatnonzero(here)
            index += [s + h, s + q]
            home += [np.ones(len(h), bool), np.zeros(len(q), bool)]
            cell += [numbers[mine[h]], numbers[j]]
        rows = rows.take(pa.array(np.concatenate(index)))
        rows = rows.set_column(NODE.index("home"), "home", pa.array(np.concatenate(home)))
        return rows.set_column(NODE.index(into), into, pa.array(np.concatenate(cell), pa.int32()))

    def deal(rows: pa.Table, centres: pa.Table) -> pa.Table:
        return near(rows, centres)

    moved = rows.select(*NODE, "deal").groupBy(*by, "deal").cogroup(fitted.groupBy(*by, "deal")).applyInArrow(deal, placed.select(NODE).schema)
    rest = placed.join(large.select(*by), by, "left_anti").select(NODE)
    return scratch.put(rest.unionByName(moved), f"cells-{into}")


def _search(placed: DataFrame, least: float, width: int | None, scratch: Scratch) -> DataFrame:
    """For each group a row with the links of each node there and the smallest node that they lead to.

    Without a ``width`` the pairs of a group come from products of all its vectors.

    A group holds a block ``i`` of a cell's own nodes, as the index, and a block
    ``j`` of own nodes or, for ``j >= nb``, of visitors that query it. Each pair
    in range meets in one group alone, which counts it for both ends.
    """
    by = ["part", "c1", "c2"]
    blocks = lambda n: F.when(n > MAX_GROUP, F.ceil(n / (MAX_GROUP / 2))).otherwise(F.signum(n)).cast("int")
    sizes = placed.groupBy(*by).agg(blocks(F.count_if("home")).alias("nb"), blocks(F.count_if(~F.col("home"))).alias("ng"))
    sizes = scratch.small(scratch.put(sizes.where("nb > 0"), "blocks"))
    each = placed.join(sizes, by)
    own = each.where("home").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    own = own.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") + F.col("ng") - 1)).alias("o"))
    own = own.withColumns({"i": F.when(F.col("o") < F.col("nb"), F.least("blk", "o")).otherwise(F.col("blk")), "j": F.greatest("blk", "o")})
    visit = each.where("not home").withColumns({"blk": F.lit(-1), "j": F.col("nb") + F.pmod(F.xxhash64("id"), F.col("ng")).cast("int")})
    visit = visit.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    fields = [*by, "i", "j", "blk", "id", "copies", "v"]

    def search(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        ids, copies, blk = (table.column(c).to_numpy()[order] for c in ("id", "copies", "blk"))
        x = _stack(table.column("v"))[order]
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        inside = blk == i
        at, out = np.flatnonzero(inside), np.flatnonzero(~inside)
        if i == j:
            a, b = near_pairs(x, None, least, width) if width else all_pairs(x, None, least)
        elif len(at) and len(out):
            a, b = near_pairs(x[at], x[out], least, width) if width else all_pairs(x[at], x[out], least)
            a, b = at[a], out[b]
        else:
            a = b = np.zeros(0, np.int64)
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        root = ids[lowest_labels(len(ids), a, b)]
        keep = links > 0
        return pa.table({"id": pa.array(ids[keep], pa.int64()), "links": pa.array(links[keep].astype(np.int64)), "root": pa.array(root[keep], pa.int64())})

    return own.select(fields).unionByName(visit.select(fields)).groupBy(*by, "i", "j").applyInArrow(search, "id bigint, links bigint, root bigint")


def _true_links(nodes: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """``id, true``: how many rows of other nodes each query is linked with, by brute force against all nodes of its label.

    Queries are the nodes that are ``asked``. A task holds a block of them and
    one of the nodes of their label.
    """
    blocks = lambda n, most: F.greatest(F.ceil(n / most), F.lit(1)).cast("int")
    sizes = nodes.groupBy("part").agg(blocks(F.count_if("asked"), AUDIT_QUERIES).alias("nq"), blocks(F.count(F.lit(1)), AUDIT_VECTORS).alias("nv"), F.max("asked").alias("any"))
    sizes = scratch.small(scratch.put(sizes.where("any").drop("any"), "audit"))
    each = nodes.join(sizes, "part").select("part", "id", "copies", "asked", "v", "nq", "nv")
    mine = lambda n: F.pmod(F.xxhash64("id", F.lit(7)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pick = lambda d, *names: d.select(*[F.col(c).alias(c) for c in names])
    queries = pick(each.where("asked").withColumn("i", mine("nq")).withColumn("j", every("nv")), "part", "i", "j", "id", "v")
    against = pick(each.withColumn("j", mine("nv")).withColumn("i", every("nq")), "part", "i", "j", "id", "copies", "v")

    def count(asked: pa.Table, all_: pa.Table) -> pa.Table:
        if not asked.num_rows or not all_.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        who, ids, copies = asked.column("id").to_numpy(), all_.column("id").to_numpy(), all_.column("copies").to_numpy()
        y, x, n = _stack(asked.column("v")), _stack(all_.column("v")), np.zeros(len(who), np.int64)
        for s in range(0, len(ids), 4096):
            hit = (y @ x[s : s + 4096].T >= least) & (who[:, None] != ids[None, s : s + 4096])
            n += hit @ copies[s : s + 4096]
        return pa.table({"id": pa.array(who), "n": pa.array(n)})

    keys = ["part", "i", "j"]
    counted = queries.groupBy(*keys).cogroup(against.groupBy(*keys)).applyInArrow(count, "id bigint, n bigint")
    return counted.groupBy("id").agg(F.sum("n").alias("true"))


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
