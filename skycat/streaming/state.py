"""Association of a stream with keyed state.

Every field of the sky is a key of the state store.  Its objects are held by sky cell, a map entry for each occupied cell, so a micro-batch
reads and writes only the cells that its sources touch, however many objects the field has: an object out of reach of all
sources of a micro-batch can neither match nor move.  A field's work in a micro-batch is the walk by dependency
levels over those objects and the new sources.  The state is Spark's own, so a restart goes on from the last finished micro-batch.

Objects that are not seen for ``horizon_days`` leave the state by an event-time timer of their field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.geometry import chord2_limit
from ..operators.walk import cell_keys, directions, walk

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MERGES = "field long, aid long, sid long"
OBJECT = np.dtype([("aid", "<i8"), ("ra", "<f8"), ("dec", "<f8"), ("n", "<f8"), ("last", "<f8"), ("ra0", "<f8"), ("dec0", "<f8"), ("flux0", "<f8")])
STATE_RADII = 64.0  # edge of a state cell in radii: most sources touch one
DAY_MS = 86_400_000
MJD_OF_EPOCH = 40587.0
_CORNERS = np.array([(i, j, k) for i in (-1, 1) for j in (-1, 1) for k in (-1, 1)], float)


class FieldAssociation(StatefulProcessor):
    """Merges of the arriving sources of a field; the state holds its objects."""

    def __init__(self, radius_deg: float, horizon_days: float | None = None):
        self.limit = chord2_limit(radius_deg)
        self.reach = float(np.sqrt(self.limit)) * (1 + 1e-9) + 1e-15
        self.size = STATE_RADII * self.reach
        self.horizon = horizon_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("objects", "cell long", "objects binary")

    def _load(self, cell: int) -> np.ndarray:
        found = self.cells.getValue((cell,)) if self.cells.exists() and self.cells.containsKey((cell,)) else None
        return np.zeros(0, OBJECT) if found is None else np.frombuffer(bytes(found[0]), OBJECT)

    def _store(self, cell: int, objects: np.ndarray) -> None:
        if len(objects):
            self.cells.updateValue((cell,), (objects.tobytes(),))
        else:
            self.cells.removeKey((cell,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        new = new[new["flags"] == 0].sort_values(["mjdobs", "expid", "sca", "sid"], ignore_index=True)
        if not len(new):
            return
        ra, dec, mjd = (new[c].to_numpy(float) for c in ("ra", "dec", "mjdobs"))
        at = directions(ra, dec)
        # the cells that the circles around the sources can touch
        around = at[:, :, None] + self.reach * _CORNERS.T[:, None, :]
        touched = np.unique(cell_keys(*around.reshape(3, -1), self.size))
        held = {int(c): self._load(int(c)) for c in touched}
        old = np.concatenate(list(held.values())) if held else np.zeros(0, OBJECT)
        if self.horizon is not None:
            old = old[old["last"] >= mjd.min() - self.horizon]
        field = np.full(len(old) + len(new), int(key[0]))
        batch = new[["mjdobs", "expid", "sca"]].ne(new[["mjdobs", "expid", "sca"]].shift()).any(axis=1).cumsum().to_numpy()
        sid = np.concatenate([old["aid"], new["sid"].to_numpy(np.int64)])
        rank = np.concatenate([np.zeros(len(old), np.int64), np.ones(len(new), np.int64)])
        merged_field, aid, source, objects = walk(rank, field, np.concatenate([np.zeros(len(old), np.int64), batch]), sid, np.concatenate([old["ra"], ra]),
                                                  np.concatenate([old["dec"], dec]), np.concatenate([old["n"], np.ones(len(new))]), self.limit)
        self._write_back(new, old, held, objects, aid, source, mjd)
        if self.horizon is not None:
            self.handle.registerTimer(int((mjd.max() + self.horizon - MJD_OF_EPOCH) * DAY_MS) + DAY_MS)
        yield pd.DataFrame({"field": merged_field, "aid": aid, "sid": source})

    def _write_back(self, new, old, held, objects, aid, source, mjd) -> None:
        """Store the cells whose objects have changed."""
        now = np.zeros(objects.n, OBJECT)
        now["aid"], now["ra"], now["dec"], now["n"] = objects.id[:objects.n], objects.ra[:objects.n], objects.dec[:objects.n], objects.weight[:objects.n]
        for name in ("last", "ra0", "dec0", "flux0"):
            now[name][:len(old)] = old[name]
        # what started in this micro-batch, by its first source
        row = pd.Series(np.arange(len(new)), new["sid"].to_numpy())
        first = row.loc[now["aid"][len(old):]].to_numpy()
        now["ra0"][len(old):], now["dec0"][len(old):] = new["ra"].to_numpy(float)[first], new["dec"].to_numpy(float)[first]
        now["flux0"][len(old):] = new["fluxfit"].to_numpy(float)[first] if "fluxfit" in new else np.nan
        seen = pd.Series(mjd[row.loc[source].to_numpy()]).groupby(aid).max()
        latest = pd.Series(now["aid"]).map(seen).to_numpy(float)
        now["last"] = np.fmax(np.where(np.arange(len(now)) < len(old), now["last"], -np.inf), latest)
        cell = cell_keys(*directions(now["ra"], now["dec"]), self.size)
        for c in np.unique(np.concatenate([cell, np.fromiter(held, np.int64, len(held))])).tolist():
            mine = now[cell == c]
            if c not in held:  # an object has moved into a cell out of reach of the sources
                mine = np.concatenate([self._load(c), mine])
                self._store(c, mine)
            elif mine.tobytes() != held[c].tobytes():
                self._store(c, mine)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bar = expiredTimerInfo.getExpiryTimeInMs() / DAY_MS + MJD_OF_EPOCH - 1 - self.horizon
        for cell in [c[0] for c in self.cells.keys()]:
            objects = self._load(cell)
            kept = objects[objects["last"] > bar]
            if len(kept) < len(objects):
                self._store(cell, kept)
        yield from ()

    def close(self) -> None:
        pass


def associate_with_state(sources: DataFrame, folder: str, radius_deg: float, horizon_days: float | None = None, time: str = "dateobs",
                         late: str = "0 seconds") -> StreamingQuery:
    """Attach arriving clean sources to objects or start new ones; merges (field, aid, sid) go to ``folder``/merges, the state is beside them.

    ``sources``: sid, field, expid, sca, mjdobs, ra, dec, flags, and fluxfit if objects shall have it.  Micro-batches come in order of
    time, as the survey's nights do.  Without ``horizon_days`` objects stay for ever, and the merges are those of
    ``associate_within_field`` over all sources.  With it, ``time`` (a timestamp) drives the timers; rows later than ``late`` are lost.
    The query takes what is there and ends; another call goes on from its state.
    """
    columns = ["sid", "field", "expid", "sca", "mjdobs", "ra", "dec", "flags"] + [c for c in ("fluxfit",) if c in sources.columns]
    if horizon_days is not None:
        sources = sources.withWatermark(time, late)
        columns.append(time)
    keyed = sources.select(*columns).withColumn("field", F.col("field").cast("long")).groupBy("field")
    merges = keyed.transformWithStateInPandas(FieldAssociation(radius_deg, horizon_days), MERGES, "Append", "None" if horizon_days is None else "EventTime")
    conf = sources.sparkSession.conf
    name = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STORE)  # map state and timers need this store; a query keeps the settings it starts with
    try:
        return (merges.writeStream.format("parquet").option("path", f"{folder}/merges").option("checkpointLocation", f"{folder}/_state")
                .outputMode("append").trigger(availableNow=True).start())
    finally:
        conf.set(name, before) if before else conf.unset(name)


def state_objects(spark: SparkSession, folder: str) -> DataFrame:
    """field, aid, meanra, meandec, nsources, last_mjd, ra0, dec0, flux0 of the objects in the state of ``associate_with_state``."""
    rows = (spark.read.format("statestore").option("stateVarName", "objects").option("path", f"{folder}/_state").load()
            .select(F.col("key.field").alias("field"), F.col("user_map_value.objects").alias("objects")))

    def unpack(batches):
        for pdf in batches:
            for field, raw in zip(pdf["field"], pdf["objects"]):
                o = np.frombuffer(bytes(raw), OBJECT)
                yield pd.DataFrame({"field": field, "aid": o["aid"], "meanra": o["ra"], "meandec": o["dec"], "nsources": o["n"].astype(np.int64),
                                    "last_mjd": o["last"], "ra0": o["ra0"], "dec0": o["dec0"], "flux0": o["flux0"]})

    return rows.mapInPandas(unpack, "field long, aid long, meanra double, meandec double, nsources long, last_mjd double, ra0 double, dec0 double, flux0 double")
