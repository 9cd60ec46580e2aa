"""Association of sources with objects in time order.

The survey walks through the exposures of a field in time order and, inside an exposure,
through its detectors.  All sources of such a batch are compared with the current mean
positions of the objects: every pair within the radius is a merge, every source without a
pair starts an object.  That looks sequential, but it is local:

* A source can only join an object that has a member within twice the radius (the mean is a
  weighted mean of the members, and one of the last members lies within one radius of it).
  So sky cells of that size, joined with their occupied neighbours, form groups that never
  interact; groups are worked on independently.
* In a group whose bounding box is smaller than the radius every source matches every object,
  so the result is known without a walk: the first batch starts the objects and all later
  sources join all of them.  This is the normal case for point sources and is a plain join.
* Other groups are walked in numpy, many groups of a partition at once, and by dependency levels: parts of batches that
  lie apart are matched together (see ``walk``).  A group with more than ``max_group_rows`` rows is first cut again with
  finer cells; what is still too large is walked over the cluster in rounds of many levels, tile by tile of the sky, each with what lies around it.

Object ids are the ids of the sources that start them, so a repeated run gives the same ids.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import angular_separation, chord2_limit, unit_vector, wrap_ra
from ..functions.healpix import coarser, healpix_nested
from ..session import cut_lineage, discard, shared_folder
from .components import connected_components
from .objects import object_statistics, ra_offset
from .spatial import MARGIN_DEG, MIN_CELL_DEG, POLE_DEG, cell_of, sky_join_all_pairs, with_touched_cells, zone_of
from .walk import STEPS as CELL_STEPS
from .walk import cell_keys, cell_size, directions, halo, walk, walk_rows

MERGE_SCHEMA = "field long, aid long, sid long"
BATCH = ("mjdobs", "expid", "sca")


def sky_groups(points: DataFrame, link_deg: float, pos=("ra", "dec"), cell: float = 2.0) -> DataFrame:
    """Add ``grp`` so that points closer than ``link_deg`` always share a group.

    ``cell`` is the size of a cell in units of the link: large cells are cheap, small ones follow
    the points more closely where the sky is crowded.

    Only occupied cells take part in the graph, each once with the box of its points, so a hot
    position costs as much as any other.  Groups may be larger than needed, never smaller.
    """
    h = cell * link_deg * (1 + 1e-6)

    def node(z: Column, c: Column) -> Column:
        return z * (1 << 32) + c

    zone = zone_of(pos[1], h)
    keyed = points.withColumn("__node", node(zone, cell_of(pos[0], zone, h)))
    ra, dec = pos
    # each occupied cell as a circle around the box of its points
    box = keyed.groupBy("__node").agg(F.min(ra).alias("r0"), F.max(ra).alias("r1"), F.min(dec).alias("d0"), F.max(dec).alias("d1"))
    wide = (F.col("r1") - F.col("r0")) / 2 * F.cos(F.radians(F.least(F.abs("d0"), F.abs("d1"))))
    high = (F.col("d1") - F.col("d0")) / 2
    cells = cut_lineage(box.select(F.col("__node").alias("src"), ((F.col("r0") + F.col("r1")) / 2).alias("a_ra"),
                                   ((F.col("d0") + F.col("d1")) / 2).alias("a_dec"),
                                   (F.sqrt(wide * wide + high * high) * (1 + 1e-6)).alias("a_size")))
    other = cells.toDF("dst", "b_ra", "b_dec", "b_size")
    near = with_touched_cells(cells.withColumn("__reach", F.col("a_size") + link_deg), "a_ra", "a_dec", "__reach", h, "__z", "__c")
    near = near.withColumn("dst", node(F.col("__z"), F.col("__c"))).filter("src <> dst").drop("__z", "__c", "__reach")
    gap = angular_separation("a_ra", "a_dec", "b_ra", "b_dec")
    edges = near.join(other, "dst").filter(gap <= (F.col("a_size") + F.col("b_size") + link_deg) * (1 + 1e-9) + MARGIN_DEG)
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    labels = connected_components(cells.select(F.col("src").alias("node")), both).select(F.col("node").alias("__node"), F.col("label").alias("grp"))
    # both sides grow with the data: never broadcast either
    return keyed.join(labels.hint("merge"), "__node").drop("__node")


def _numbered(c: dict[str, np.ndarray]) -> np.ndarray:
    """The number of each row's batch within its group; rows are in order of field, grp, rank and batch."""
    n = len(c["sid"])
    new_group = np.ones(n, bool)
    new_group[1:] = (np.diff(c["field"]) != 0) | (np.diff(c["grp"]) != 0)
    new_batch = new_group.copy()
    for name in ("rank", *BATCH):
        new_batch[1:] |= c[name][1:] != c[name][:-1]
    number = np.cumsum(new_batch)
    first = np.flatnonzero(new_group)
    return number - np.repeat(number[first], np.diff(np.append(first, n)))


def _walk(radius_deg: float):
    """The walk over a partition sorted by group, rank and batch, as a function of Arrow batches.

    Whole groups are taken together, ``WALK_ROWS`` rows or a little more at once, so memory does not grow with the partition.
    """
    limit = chord2_limit(radius_deg)

    def groups(pdf: pd.DataFrame) -> pd.DataFrame:
        c = {name: pdf[name].to_numpy() for name in pdf.columns}
        field, aid, sid, _ = walk(c["rank"], c["field"], _numbered(c), c["sid"], c["ra"], c["dec"], c["weight"], limit)
        return pd.DataFrame({"field": field, "aid": aid, "sid": sid})

    def run(batches):
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) < WALK_ROWS:
                continue
            pdf = pd.concat(held, ignore_index=True)
            last = (pdf["field"] == pdf["field"].iloc[-1]) & (pdf["grp"] == pdf["grp"].iloc[-1])  # may go on in the next batch
            held = [pdf[last]]
            if not last.all():
                yield groups(pdf[~last])
        if sum(map(len, held)):
            yield groups(pd.concat(held, ignore_index=True))

    return run


WALK_ROWS = 200_000  # rows of a partition of the walk


COMPACT_ROUNDS = 16  # rounds after which the objects are written as one table again


def _with_cells(radius_deg: float):
    size = cell_size(chord2_limit(radius_deg))

    def run(batches):
        for pdf in batches:
            pdf["cell"] = cell_keys(*directions(pdf["ra"].to_numpy(), pdf["dec"].to_numpy()), size)
            yield pdf

    return run


def _dealt_levels(batches):
    """The level of each cell of each batch (field, grp, cells); rows come group by group, in order of time.

    One number is held for every cell that the group has met.
    """
    last: dict[int, int] = {}
    group = None
    for pdf in batches:
        steps = []
        for field, grp, cells in zip(pdf["field"], pdf["grp"], pdf["cells"]):
            if (field, grp) != group:
                group, last = (field, grp), {}
            near = (np.asarray(cells)[:, None] + CELL_STEPS).tolist()
            level = dict(zip(cells.tolist(), (max(last.get(k, 0) for k in row) for row in near)))
            touching = [(c, k) for c, row in zip(cells.tolist(), near) for k in row if k != c and k in level]
            while touching and any(level[k] > level[c] for c, k in touching):  # parts of a batch that touch share their level
                for c, k in touching:
                    level[c] = max(level[c], level[k])
            level = {c: v + 1 for c, v in level.items()}
            last.update(level)
            steps.append([level[c] for c in cells.tolist()])
        yield pdf.assign(steps=steps)


def dependency_levels(rows: DataFrame, radius_deg: float) -> DataFrame:
    """``rows`` (field, grp, mjdobs, expid, sca, ra, dec, ...) with ``step``: rows of one step can be matched at once, after all steps before.

    See ``walk``: a step is one more than the highest of the earlier batches in the row's cell and those next to it.  Cells and batches
    of a group pass through one task, as numbers only and one batch at a time.
    """
    placed = cut_lineage(rows.mapInPandas(_with_cells(radius_deg), rows.withColumn("cell", F.lit(0).cast("long")).schema))
    keys = ["field", "grp", *BATCH]
    batches = placed.groupBy(*keys).agg(F.collect_set("cell").alias("cells"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batches.schema)
    dealt = batches.repartition("field", "grp").sortWithinPartitions(*keys).mapInPandas(_dealt_levels, f"{kinds}, steps array<int>")
    dealt = dealt.select(*keys, F.explode(F.arrays_zip("cells", "steps")).alias("c")).select(*keys, F.col("c.cells").alias("cell"), F.col("c.steps").alias("step"))
    return placed.join(dealt, [*keys, "cell"]).drop("cell")


def _walk_on_cluster(rows: DataFrame, radius_deg: float) -> DataFrame:
    """The walk over groups too large for one task: by tiles of the sky, many levels a round, or where tiles are too crowded by single levels.

    Groups with an id that is missing or stands twice always go level by level, where objects of one id are one.
    """
    leveled = cut_lineage(dependency_levels(rows.filter("rank > 0").select("field", "grp", *BATCH, "sid", "ra", "dec"), radius_deg))
    known = rows.filter("rank = 0").select("field", "grp", F.col("sid").alias("aid"), "ra", "dec", "weight")
    odd = rows.groupBy("sid").agg(F.count("*").alias("n"), F.collect_set(F.struct("field", "grp")).alias("g")).filter("n > 1 OR sid IS NULL")
    odd = cut_lineage(odd.select(F.explode("g").alias("g")).select("g.*").distinct())
    parts, merges = [(known, leveled, False)], []
    if odd.take(1):
        parts = [(known.join(odd, ["field", "grp"], how), leveled.join(odd, ["field", "grp"], how), by_level)
                 for how, by_level in (("left_anti", False), ("left_semi", True))]
    for objects, sources, by_level in parts:
        last = sources.agg(F.max("step").alias("m")).first()["m"]
        if last is None:
            continue
        height = 0 if by_level else _slab_height(sources, radius_deg, last)
        merges.append(_walk_by_tiles(objects, sources, radius_deg, last, height) if height else _walk_by_levels(objects, sources, radius_deg, last))
    discard(leveled, odd)
    return reduce(DataFrame.unionByName, merges) if merges else rows.sparkSession.createDataFrame([], MERGE_SCHEMA)


SLABS = (32, 16, 8, 4, 2, 1)  # levels that a round of tiles may take
TILE_CELLS = 4  # cells along a tile for each level of a round
TILE_ROWS = 1_000_000  # rows of a tile and its surroundings in one round


def _tile_places(radius_deg: float, side: int, reach: int = 0) -> list[Column]:
    """The tile of a position shifted by ``reach`` cells, in three dimensions."""
    size = cell_size(chord2_limit(radius_deg))
    return [F.floor((F.floor(v / size) + reach) / side) for v in unit_vector("ra", "dec")]


def _slab_height(leveled: DataFrame, radius_deg: float, last: int) -> int:
    """The most levels that a round can take so that no tile with its surroundings has over ``TILE_ROWS`` rows; 0 if one level is too many."""
    for height in SLABS:
        if height // 2 >= last:
            continue
        side = TILE_CELLS * height
        tile = [c.alias(f"t{i}") for i, c in enumerate(_tile_places(radius_deg, side))]
        counts = leveled.groupBy("field", F.floor((F.col("step") - 1) / height).alias("slab"), *tile).agg(F.count("*").alias("n"))
        around = (-(-2 * halo(height) // side) + 1) ** 2  # tiles that a tile and its surroundings touch, on a surface
        if counts.agg(F.max("n").alias("n")).first()["n"] * around <= TILE_ROWS:
            return height
    return 0


TILE_SCHEMA = "rank int, field long, aid long, sid long, ra double, dec double, weight double"
NO_ID = -(1 << 63)  # stands for a missing id inside the walk


def _tile_walk(radius_deg: float):
    """The walk over a partition sorted by tile, rank, step and id, so that sums do not depend on the tile; whole tiles are taken together as in ``_walk``."""
    limit = chord2_limit(radius_deg)
    place = ["field", "t0", "t1", "t2"]

    def tiles(pdf: pd.DataFrame) -> pd.DataFrame:
        tile = np.cumsum((pdf[place] != pdf[place].shift()).any(axis=1).to_numpy())
        used = np.bincount(tile, pdf["own"])[tile] > 0  # others only surround
        c = {name: pdf[name].to_numpy()[used] for name in pdf.columns}
        source, aid, objects, start = walk_rows(c["rank"], tile[used], c["step"], c["sid"], c["ra"], c["dec"], c["weight"], limit, leveled=True)
        mine, kept, n = c["own"][source], np.flatnonzero(c["own"][start]), objects.n
        source, aid = source[mine], aid[mine]
        merges = pd.DataFrame({"rank": 1, "field": c["field"][source], "aid": aid, "sid": c["sid"][source], "ra": 0.0, "dec": 0.0, "weight": 0.0})
        left = pd.DataFrame({"rank": 0, "field": c["field"][start[kept]], "aid": objects.id[:n][kept], "sid": NO_ID, "ra": objects.ra[:n][kept],
                             "dec": objects.dec[:n][kept], "weight": objects.weight[:n][kept]})
        return pd.concat([merges, left], ignore_index=True)

    def run(batches):
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) < WALK_ROWS:
                continue
            pdf = pd.concat(held, ignore_index=True)
            last = (pdf[place] == pdf[place].iloc[-1]).all(axis=1)  # may go on in the next batch
            held = [pdf[last]]
            if not last.all():
                yield tiles(pdf[~last])
        if sum(map(len, held)):
            yield tiles(pd.concat(held, ignore_index=True))

    return run


def _walk_by_tiles(known: DataFrame, leveled: DataFrame, radius_deg: float, last: int, height: int) -> DataFrame:
    """The walk in rounds of ``height`` levels.  What such a round does in a tile of the sky depends on rows and objects at most ``halo``
    cells around it only, so every tile is walked by itself, together with these.  It keeps the merges of its own sources, and the
    objects that were its own before; a round writes all objects.
    """
    spark, folder = leveled.sparkSession, f"{shared_folder(leveled.sparkSession)}/skycat-{uuid.uuid4().hex}"
    slab = F.floor((F.col("step") - 1) / height).cast("int")
    sources = leveled.select("field", F.coalesce("sid", F.lit(NO_ID)).alias("sid"), "ra", "dec", (F.col("step") - slab * height).alias("step"), slab.alias("slab"))
    sources.hint("rebalance", "slab").write.partitionBy("slab").parquet(f"{folder}/levels")
    rounds, side, reach = -(-last // height), TILE_CELLS * height, halo(height)
    parts = max(spark.sparkContext.defaultParallelism, leveled.count() // (rounds * WALK_ROWS))
    tile = ["t0", "t1", "t2"]
    state = cut_lineage(known.select("field", F.coalesce("aid", F.lit(NO_ID)).alias("aid"), "ra", "dec", "weight"))
    for k in range(rounds):
        batch = spark.read.schema("field long, sid long, ra double, dec double, step int").parquet(f"{folder}/levels/slab={k}")
        met = state.select(F.lit(0).alias("rank"), "field", F.col("aid").alias("sid"), "ra", "dec", "weight", F.lit(0).alias("step")).unionByName(
            batch.select(F.lit(1).alias("rank"), "field", "sid", "ra", "dec", F.lit(1.0).alias("weight"), "step"))
        spans = zip(tile, _tile_places(radius_deg, side), _tile_places(radius_deg, side, -reach), _tile_places(radius_deg, side, reach))
        met = met.withColumns({f"{t}_{what}": c for t, *columns in spans for what, c in zip(("own", "low", "high"), columns)})
        for t in tile:
            met = met.withColumn(t, F.explode(F.sequence(f"{t}_low", f"{t}_high")))
        own = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"{t}_own") for t in tile])
        met = met.select("rank", "field", "sid", "ra", "dec", "weight", "step", own.alias("own"), *tile)
        ordered = met.repartition(parts, "field", *tile).sortWithinPartitions("field", *tile, "rank", "step", "sid", "ra", "dec")
        done = ordered.mapInPandas(_tile_walk(radius_deg), TILE_SCHEMA)
        done.write.partitionBy("rank").parquet(f"{folder}/done/slab={k}")
        discard(state)
        path = f"{folder}/done/slab={k}/rank=0"
        state = spark.read.schema("field long, aid long, ra double, dec double, weight double").parquet(path)
        state._skycat_table = path
    discard(state)
    merges = spark.read.schema(MERGE_SCHEMA).parquet(*[f"{folder}/done/slab={k}/rank=1" for k in range(rounds)])
    return merges.select("field", *[F.nullif(c, F.lit(NO_ID)).alias(c) for c in ("aid", "sid")])


def _walk_by_levels(known: DataFrame, leveled: DataFrame, radius_deg: float, last: int) -> DataFrame:
    """The walk level by level: in round k all parts of batches of level k, of every large group at once, by a positional join.

    Groups never interact, and neither do parts of one level, so there are as many rounds as the longest chain of dependent parts,
    however many batches and groups there are.  Parts are stored by round, and a round reads its own only.  A round writes the
    objects that it moves or starts; after some rounds they are put together again.  Merges are written once, by round.
    """
    spark, folder = leveled.sparkSession, f"{shared_folder(leveled.sparkSession)}/skycat-{uuid.uuid4().hex}"
    leveled.select("field", "grp", "sid", "ra", "dec", "step").hint("rebalance", "step").write.partitionBy("step").parquet(f"{folder}/batches")
    names = ["field", "grp", "aid", "ra", "dec", "weight"]
    base = cut_lineage(known)
    changed: list[DataFrame] = []

    def current() -> DataFrame:
        if not changed:
            return base
        stacked = reduce(DataFrame.unionByName, [df.withColumn("no", F.lit(i)) for i, df in enumerate(changed)])
        newest = stacked.groupBy("aid").agg(F.max_by(F.struct(*names), "no").alias("o")).select("o.*")
        return base.join(newest.select("aid"), "aid", "left_anti").select(names).unionByName(newest)

    for step in range(1, last + 1):
        batch = spark.read.parquet(f"{folder}/batches/step={step}")
        state = current()
        objects = state.select(F.col("field").alias("o_field"), F.col("grp").alias("o_grp"), "aid", F.col("ra").alias("o_ra"), F.col("dec").alias("o_dec"),
                               F.col("weight").alias("o_weight"))
        pairs = cut_lineage(sky_join_all_pairs(batch, objects, radius_deg, ("ra", "dec"), ("o_ra", "o_dec"),
                                               on=[("field", "o_field"), ("grp", "o_grp")], distance=None)
                            .select("field", "grp", "aid", "sid", "o_ra", "o_dec", "o_weight", ra_offset(F.col("ra"), F.col("o_ra")).alias("dra"),
                                    (F.col("dec") - F.col("o_dec")).alias("ddec")))
        fresh = batch.join(pairs.select("sid"), "sid", "left_anti")
        new = fresh.select("field", F.col("sid").alias("aid"), "sid").unionByName(pairs.select("field", "aid", "sid"))
        new.write.parquet(f"{folder}/merges/step={step}")
        n = F.col("o_weight") + F.col("k")
        moved = pairs.groupBy("field", "grp", "aid", "o_ra", "o_dec", "o_weight").agg(
            F.sum("dra").alias("dra"), F.sum("ddec").alias("ddec"), F.count("*").alias("k")).select(
            "field", "grp", "aid", wrap_ra(F.col("o_ra") + F.col("dra") / n).alias("ra"), (F.col("o_dec") + F.col("ddec") / n).alias("dec"),
            n.cast("double").alias("weight"))
        started = fresh.select("field", "grp", F.col("sid").alias("aid"), "ra", "dec", F.lit(1.0).alias("weight"))
        changed.append(cut_lineage(moved.unionByName(started)))
        discard(pairs)
        if len(changed) == COMPACT_ROUNDS:
            whole = cut_lineage(current())
            discard(base, *changed)
            base, changed = whole, []
    discard(base, *changed)
    return spark.read.schema(MERGE_SCHEMA).parquet(*[f"{folder}/merges/step={k}" for k in range(1, last + 1)])


def associate_within_field(sources: DataFrame, radius_deg: float, objects: DataFrame | None = None,
                           max_group_rows: int = 1_000_000) -> DataFrame:
    """Merges (field, aid, sid) of clean sources with objects of their own field.

    ``sources``: sid, field, expid, sca, mjdobs, ra, dec.  ``objects`` (field, aid, meanra,
    meandec, nsources) are the objects of earlier runs; merges are only returned for the given
    sources.
    """
    rows = sources.select(F.lit(1).alias("rank"), F.col("field").cast("long").alias("field"), F.col("sid").cast("long").alias("sid"),
                          F.col("expid").cast("long").alias("expid"), F.col("sca").cast("int").alias("sca"),
                          F.col("mjdobs").cast("double").alias("mjdobs"), F.col("ra").cast("double").alias("ra"),
                          F.col("dec").cast("double").alias("dec"), F.lit(1.0).alias("weight"))
    if objects is not None:
        known = objects.select(F.lit(0).alias("rank"), F.col("field").cast("long").alias("field"), F.col("aid").cast("long").alias("sid"),
                               F.lit(-1).cast("long").alias("expid"), F.lit(0).alias("sca"), F.lit(float("-inf")).alias("mjdobs"),
                               F.col("meanra").alias("ra"), F.col("meandec").alias("dec"), F.col("nsources").cast("double").alias("weight"))
        rows = rows.unionByName(known)
    return _solve(rows, radius_deg, max_group_rows, COARSE_CELL)


COARSE_CELL, FINE_CELL = 2.0, 0.5  # cell sizes in units of the link, for all and for large groups


def _solve(rows: DataFrame, radius_deg: float, max_group_rows: int, cell: float) -> DataFrame:
    """Merges of rows (rank, field, sid, expid, sca, mjdobs, ra, dec, weight), group by group."""
    rows = cut_lineage(sky_groups(rows, 2.0 * radius_deg, cell=cell))

    x, y, z = unit_vector("ra", "dec")
    first = F.min(F.struct("rank", *BATCH))
    span = sum((F.pow(F.max(c) - F.min(c), 2) for c in (y, z)), F.pow(F.max(x) - F.min(x), 2))
    kind = (F.when(F.col("span") <= chord2_limit(radius_deg) * (1 - 1e-6), "compact")
            .when(F.col("n") <= max_group_rows, "walk").otherwise("large"))
    groups = rows.groupBy("field", "grp").agg(F.count("*").alias("n"), first.alias("first"), span.alias("span"))
    groups = cut_lineage(groups.select("field", "grp", "first", "n", kind.alias("kind")))
    kinds = {r["kind"]: r["n"] for r in groups.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # at most three rows
    rows = rows.join(groups.drop("n"), ["field", "grp"])

    # compact groups: the first batch (or the known objects) are the objects
    compact = rows.filter("kind = 'compact'")
    is_seed = F.struct("rank", *BATCH) == F.col("first")
    seeds = compact.filter(is_seed)
    joined = compact.filter(~is_seed).select("field", "grp", "sid").join(
        seeds.select("field", "grp", F.col("sid").alias("aid")), ["field", "grp"])
    own = seeds.filter("rank = 1").select("field", F.col("sid").alias("aid"), "sid")
    result = own.unionByName(joined.select("field", "aid", "sid"))

    if "walk" in kinds:
        # partitions by rows, not bytes: this step is heavy in processor time, so adaptive
        # execution must not merge its partitions
        parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kinds["walk"] // WALK_ROWS))
        ordered = (rows.filter("kind = 'walk'").drop("first", "kind").repartition(parts, "field", "grp")
                   .sortWithinPartitions("field", "grp", "rank", *BATCH, "sid"))
        result = result.unionByName(ordered.mapInPandas(_walk(radius_deg), MERGE_SCHEMA))
    if "large" in kinds:
        large = cut_lineage(rows.filter("kind = 'large'").drop("first", "kind"))
        if cell > FINE_CELL:
            # a crowded area may only have run together in the coarse cells
            rest = _solve(large.drop("grp"), radius_deg, max_group_rows, FINE_CELL)
        else:
            rest = _walk_on_cluster(large, radius_deg)
        result = result.unionByName(rest)
    return result


def build_objects(merges: DataFrame, sources: DataFrame) -> DataFrame:
    """Object table of an association: first position and flux, mean position, count, pixels.

    The id of an object is the id of the source that started it.
    """
    start = sources.select(F.col("sid").alias("aid"), F.col("ra").alias("ra0"), F.col("dec").alias("dec0"),
                           F.col("fluxfit").alias("flux0"), "field")
    out = start.join(object_statistics(merges, sources, None), "aid").withColumn("hp9", healpix_nested("ra0", "dec0", 9))
    return out.withColumn("hp6", coarser(F.col("hp9"), 3))


def associate_across_fields(objects: DataFrame, sources: DataFrame, neighbors: DataFrame, radius_deg: float) -> DataFrame:
    """Merges of objects with clean sources of neighbouring fields: one bulk join.

    ``objects``: aid, field, meanra, meandec; ``neighbors``: rtid, neighbor.  The pair of
    fields is checked on the few positional pairs that cross a border.
    """
    a = sources.select("sid", F.col("field").alias("source_field"), "ra", "dec")
    b = objects.select("aid", "field", "meanra", "meandec")
    pairs = sky_join_all_pairs(a, b, radius_deg, ("ra", "dec"), ("meanra", "meandec"), repeat="right", distance=None,
                               keep=F.col("field") != F.col("source_field"))
    border = neighbors.select(F.col("rtid").alias("field"), F.col("neighbor").alias("source_field"))
    return pairs.join(border, ["field", "source_field"], "left_semi").select("field", "aid", "sid")


def association_pairs_once(objects: DataFrame, sources: DataFrame, radius_deg: float,
                           object_pos=("ra0", "dec0")) -> tuple[DataFrame, DataFrame]:
    """All (aid, sid) pairs for one snapshot of the objects, and the sources without a pair."""
    # Spark sees the size of the objects' files, not of the rows and cells they become: it would collect them in the driver
    b = objects.select("aid", F.col(object_pos[0]).alias("__ora"), F.col(object_pos[1]).alias("__odec")).hint("merge")
    pairs = sky_join_all_pairs(sources, b, radius_deg, right_pos=("__ora", "__odec"), distance=None).select("aid", "sid")
    unmatched = sky_join_all_pairs(sources, b.select("__ora", "__odec"), radius_deg, right_pos=("__ora", "__odec"), how="left_anti")
    return pairs, unmatched


def friends_of_friends(points: DataFrame, key: str, link_deg: float, pos=("ra", "dec")) -> DataFrame:
    """(key, group): points linked by chains of steps of at most ``link_deg``.

    Points of a small cell are friends anyway, so the graph has one node per occupied cell.
    Two cells are linked when one pair of their points is close enough; equal positions are
    taken once.  The outermost points of each cell make the first links; all points are only compared
    where cells of different groups are left next to each other, so crowded groups are not paired out.
    The group id is the smallest key in it.
    """
    # cell diagonal below the link: side link / 1.5 leaves room for the curvature of a zone
    h = link_deg / 1.5
    zone = zone_of(pos[1], h)
    ring = F.abs(zone * h - 90.0) > POLE_DEG - h  # ring cells are wide: such points stand alone
    # a node is a cell, or a position by its number in the table that is written here
    node = F.when(ring, -F.monotonically_increasing_id() - 1).otherwise(zone * (1 << 32) + cell_of(pos[0], zone, h))
    spots = cut_lineage(points.select(*pos).distinct().select(node.alias("node"), *pos))
    keyed = points.select(key, *pos).join(spots, list(pos))

    def edges(points: DataFrame, radius: float, *, own: str) -> DataFrame:
        """Pairs of different ``own`` that have points within the radius."""
        left = points.select(F.col(own).alias("src"), F.col(pos[0]).alias("a_ra"), F.col(pos[1]).alias("a_dec"))
        right = points.select(F.col(own).alias("dst"), F.col(pos[0]).alias("b_ra"), F.col(pos[1]).alias("b_dec"))
        return sky_join_all_pairs(left, right, radius, ("a_ra", "a_dec"), ("b_ra", "b_dec"), distance=None, keep=F.col("src") != F.col("dst"),
                                  cell_deg=MIN_CELL_DEG if radius == link_deg else None).select("src", "dst").distinct()

    # the outermost points of each cell link most cells, however many points there are in them
    spot = F.struct(*pos)
    outer = [f(spot, c) for f in (F.min_by, F.max_by) for c in pos]
    outer = spots.groupBy("node").agg(F.array_distinct(F.array(*outer)).alias("o")).select("node", F.explode("o").alias("o")).select("node", "o.*")
    outer = cut_lineage(outer)
    labels = cut_lineage(connected_components(outer.select("node").distinct(), edges(outer, link_deg, own="node")))
    # points of different groups can only be close in cells with points of another group around: two cells' diagonals and a link away
    one = outer.groupBy("node").agg(F.min(spot).alias("o")).join(labels, "node").select("label", "node", "o.*")
    there = one.select(F.col("label").alias("b_label"), F.col(pos[0]).alias("b_ra"), F.col(pos[1]).alias("b_dec"))
    border = sky_join_all_pairs(one, there, 3.0 * link_deg, pos, ("b_ra", "b_dec"), distance=None, keep=F.col("label") != F.col("b_label"))
    rest = cut_lineage(spots.join(border.select("node", "label").distinct(), "node").select("label", *pos))
    groups = connected_components(labels.select(F.col("label").alias("node")).distinct(), edges(rest, link_deg, own="label"))
    labels = labels.join(groups.select(F.col("node").alias("label"), F.col("label").alias("whole")), "label").select("node", F.col("whole").alias("label"))
    labelled = keyed.join(labels, "node")
    names = labelled.groupBy("label").agg(F.min(key).alias("group"))
    return labelled.join(names, "label").select(key, "group")
