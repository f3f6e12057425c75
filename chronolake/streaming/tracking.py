"""What there is to do, kept over a stream: change detection, sentinel backfill, stale scans and failure counters.

Arrivals are rows (package, seq, kind, version, ok, measured, build, at):

* ``seen``: the package is in the universe, with its latest version (null: archived only);
* ``gone``: it isn't any more;
* ``result``: an attempt on a version. One that went well (ok) is stored, with whether the sentinel was measured and
  which build made it, and clears the package's failures; one that didn't is counted.

State is kept by package: its latest and its last analysed version, for each analysed version whether the
sentinel is missing and the build, the failure counter. A batch gives the rows of the packages that it touches, which replace
those of the table of states; the pools of work are filters over that table, the shard is taken from their union. Each
equals what the batch operators find in all arrivals so far, whatever batches they came in, and after a restart.

Arrivals of a package are taken in the order of ``seq`` within a batch, and batches one after the other. A row without a
package or of another kind is ignored. The number of versions of one package is what its state grows with.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chronolake.operators import incremental
from chronolake.sources.archive import read_table, replace_packages, write_table
from chronolake.sources.shared import written
from chronolake.streaming.upserts import _exists

ARRIVAL = "package string, seq long, kind string, version string, ok boolean, measured boolean, build string, at string"
STATE = "package string, in_universe boolean, latest_version string, analysed boolean, version string, n_missing long, builds array<string>, consecutive_failures int, last_attempt string"
_OWN = "in_universe boolean, latest_version string, analysed boolean, version string, consecutive_failures int, last_attempt string"


def _text(x) -> str | None:
    return None if x is None or x != x else str(x)


class Tracker(StatefulProcessor):
    """One package's arrivals, in order, on to its state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.own = handle.getValueState("own", _OWN)
        self.versions = handle.getMapState("versions", "version string", "measured boolean, build string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values("seq", kind="stable")  # one package's, in one batch
        inside, latest, analysed, version, failures, last = self.own.get() if self.own.exists() else (False, None, False, None, 0, None)
        for r in arrived.itertuples(index=False):
            if r.kind == "seen":
                inside, latest = True, _text(r.version)
            elif r.kind == "gone":
                inside, latest = False, None
            elif r.kind == "result" and r.ok is not None and bool(r.ok):
                analysed, version, failures, last = True, _text(r.version), 0, None
                self.versions.updateValue((version or "",), (bool(r.measured), _text(r.build)))
            elif r.kind == "result":
                failures, last = failures + 1, _text(r.at)
        self.own.update((inside, latest, analysed, version, failures, last))
        known = list(self.versions.values())
        missing = sum(not m for m, _ in known)
        builds = sorted({b or "" for _, b in known})
        out = pd.DataFrame({"package": [key[0]], "in_universe": [inside], "latest_version": [latest], "analysed": [analysed], "version": [version], "n_missing": [missing], "builds": [builds], "consecutive_failures": [failures], "last_attempt": [last]})
        yield out.astype({"latest_version": object, "version": object, "last_attempt": object})

    def close(self) -> None:
        pass


def tracked(arrivals: DataFrame) -> DataFrame:
    """The states that each batch of a stream of arrivals leads to."""
    known = arrivals.filter("package is not null and kind in ('seen', 'gone', 'result')")
    return known.groupBy("package").transformWithStateInPandas(statefulProcessor=Tracker(), outputStructType=STATE, outputMode="Update", timeMode="None")


def run(arrivals: DataFrame, table: str, checkpoint: str, buckets: int = 16):
    """Takes what has arrived into the table of states, and stops. The session's state store must be RocksDB."""
    spark = arrivals.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def store(batch: DataFrame, _: int) -> None:
        own = written(batch, "states")  # state is read and changed once
        if _exists(spark, table):
            replace_packages(spark, table, own, ["package"], buckets=buckets)
        else:
            write_table(own, table, buckets=buckets)

    query = tracked(arrivals).writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def states(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, table)


def _able(states: DataFrame, least: int) -> DataFrame:
    return states.filter(F.col("in_universe") & (F.col("consecutive_failures") < least))


def to_analyse(states: DataFrame, least: int = incremental.PERMANENT) -> DataFrame:
    """Never analysed, or live with another version than the analysed one."""
    moved = F.col("latest_version").isNotNull() & ~F.col("latest_version").eqNullSafe(F.col("version"))
    return _able(states, least).filter(~F.col("analysed") | moved).select("package")


def to_backfill(states: DataFrame, least: int = incremental.PERMANENT) -> DataFrame:
    """Some analysed version lacks the sentinel."""
    return _able(states, least).filter("n_missing > 0").select("package")


def stale(states: DataFrame, build: str | None, least: int = incremental.PERMANENT) -> DataFrame:
    """Some analysed version was made by another build than the current one, or by an unknown one; none, if the current one
    isn't known."""
    if build is None:
        return states.limit(0).select("package")
    return _able(states, least).filter(F.exists("builds", lambda b: b != build)).select("package")


def failures(states: DataFrame) -> DataFrame:
    return states.filter("consecutive_failures > 0").select("package", "consecutive_failures", "last_attempt")


def next_shard(states: DataFrame, size: int, build: str | None = None, least: int = incremental.PERMANENT) -> DataFrame:
    """The first ``size`` packages of all pools."""
    return incremental.shard([to_analyse(states, least), to_backfill(states, least), stale(states, build, least)], size)
