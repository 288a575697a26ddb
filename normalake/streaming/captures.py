"""Captures as keyed streams: the append log, the holding area, freshness.

Each step keeps its own state by key (``applyInPandasWithState``), so state is
split over tasks, kept in the state store and resumed from the checkpoint by
the next run.  Rows of a key come in frames; what a step remembers of a key is
said with it.  Keys of the append log and of the holding area are dealt to
GROUPS groups, so a call of Python serves many keys and the number of calls
does not grow with theirs; a group's state is an Arrow table.  Whether a row
counts as late depends on what earlier micro-batches brought, as it does in the
order in which captures arrive.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from normalake.operators.captures import KEY
from normalake.sources.tables import unique_folder

#: The rows of one source are held in so many groups, so that no source loads one task.
HELD_IN = 16
#: Groups of keys; a checkpoint is resumed with the number it was made with. A
#: group's state and its rows of a micro-batch must fit a task: more for more.
GROUPS = 512
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_NORMS = pa.schema([("norm", pa.binary()), ("newest", pa.string())])
_CONTENTS = pa.schema([("content", pa.binary())])
_KNOWN = pa.schema([("of", pa.binary()), ("tipo", pa.string()), ("numero", pa.string()), ("since", pa.int64())])
_HELD = pa.schema([("of", pa.binary()), ("row", pa.string()), ("time", pa.int64())])
#: A time that is null, as NaT is in numpy.
_NEVER = np.iinfo(np.int64).min


def _us(at: pd.Series) -> np.ndarray:
    return (at - pd.Timestamp(0)).to_numpy().astype("timedelta64[us]").astype(np.int64)


def _name(*columns: str | Column) -> Column:
    """128 bits of SHA-256 that name these values."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.array(*columns)), 256)), 1, 16)


def _packed(df: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_pandas(df, schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes | None, schema: pa.Schema) -> pd.DataFrame:
    return (pa.ipc.open_stream(bytes(data)).read_all() if data else schema.empty_table()).to_pandas()


def append_log(captures: DataFrame, at: str = "captured_at", then: str | None = None) -> DataFrame:
    """A stream of captures (KEY, source, at, ...) -> the rows that the append
    log takes, newest wins. Captures of a norm (KEY without the content, for
    those without a number also the source) that are older than one which an
    earlier batch brought are refused; of equal contents, also within a batch,
    the earliest is taken, once for all runs; of one time the least by the
    number ``then``, if given. A capture without a time is the oldest. State: a
    norm's newest time and the contents it has, by name."""
    norm = [k for k in KEY if k != "sha256"]
    rows = captures.select(*[F.coalesce(k, F.lit("")).alias(k) for k in KEY], F.coalesce(at, F.lit("")).alias("_at"), F.coalesce("source", F.lit("")).alias("_source"), (F.col(then) if then else F.lit(0)).cast("long").alias("_then"), F.to_json(F.struct(*captures.columns), _JSON).alias("_row"))
    rows = rows.withColumn("_of", F.when(F.col("numero") == "", F.col("_source")).otherwise(""))
    rows = rows.select(_name(*norm, "_of").alias("_norm"), _name(*norm, "_of", "sha256").alias("_content"), "_at", "_then", "_row")

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        norms, contents = (_unpacked(data, schema) for data, schema in zip(state.get if state.exists else (None, None), (_NORMS, _CONTENTS)))
        newest = dict(zip(norms["norm"], norms["newest"]))
        top, parts = dict(newest), []
        for f in frames:
            f = f[np.array([t >= newest.get(k, "") for k, t in zip(f["_norm"], f["_at"])], bool)]
            for k, t in f.groupby("_norm")["_at"].max().items():
                top[k] = max(t, top.get(k, ""))
            parts.append(f[~f["_content"].isin(contents["content"])])
        found = pd.concat(parts).sort_values(["_at", "_then", "_row"]).drop_duplicates("_content")
        contents = pd.DataFrame({"content": [*contents["content"], *found["_content"]]})
        state.update((_packed(pd.DataFrame({"norm": list(top), "newest": list(top.values())}), _NORMS), _packed(contents, _CONTENTS)))
        yield found[["_row"]]

    taken = rows.withColumn("_group", F.pmod(F.xxhash64("_norm"), F.lit(GROUPS))).groupBy("_group").applyInPandasWithState(step, "_row string", "norms binary, contents binary", "append", GroupStateTimeout.NoTimeout)
    return taken.select(F.from_json("_row", captures.schema, _JSON).alias("r")).select("r.*")


def promoted(holding: DataFrame, identities: DataFrame, horizon: datetime.timedelta, late: str) -> DataFrame:
    """Streams holding (source, at, ...), rows that wait for an identity, and
    identities (source, at, tipo, numero) -> holding's columns, tipo, numero,
    decision. A row is ``promoted`` as soon as it and an identity of its source
    are there, unless the identity is more than the horizon later; such rows,
    and those whose time to wait is over by the watermark, go out as
    ``expired``, without one. What has not gone out is still held. The identity
    of a source that came first stays, of one batch the earliest. Times that
    are null never come to an end. State: the rows held, and known identities."""
    held = holding.drop("tipo", "numero")
    limit = round(horizon / datetime.timedelta(microseconds=1))
    none = F.lit(None).cast("string")
    part = F.pmod(F.xxhash64(*held.columns), F.lit(HELD_IN)).cast("int")
    rows = held.withWatermark("at", late).select("source", part.alias("_s"), "at", none.alias("tipo"), none.alias("numero"), F.to_json(F.struct(*held.columns), _JSON).alias("_row"))
    known = identities.withWatermark("at", late).select("source", F.explode(F.sequence(F.lit(0), F.lit(HELD_IN - 1))).alias("_s"), "at", F.col("tipo").cast("string").alias("tipo"), F.col("numero").cast("string").alias("numero"), none.alias("_row"))
    every = rows.union(known).select(F.pmod(F.xxhash64("source", "_s"), F.lit(GROUPS)).alias("_group"), _name("source", F.col("_s").cast("string")).alias("_of"), "at", "tipo", "numero", "_row")

    def out(some: pd.DataFrame, decision: str) -> pd.DataFrame:
        ids = some[["tipo", "numero"]] if decision == "promoted" else pd.DataFrame(None, some.index, ["tipo", "numero"], object)
        return pd.DataFrame({"_row": some["row"], "tipo": ids["tipo"], "numero": ids["numero"], "decision": decision})

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, waiting = (_unpacked(data, schema) for data, schema in zip(state.get if state.exists else (None, None), (_KNOWN, _HELD)))
        if not state.hasTimedOut:
            f = pd.concat(frames)
            f = f.assign(time=_us(f["at"]))
            new = f[f["_row"].isna()].sort_values(["at", "tipo", "numero"]).drop_duplicates("_of")
            new = new[~new["_of"].isin(ids["of"])].rename(columns={"_of": "of", "time": "since"})
            ids = pd.concat([ids, new[_KNOWN.names]])
            some = f[~f["_row"].isna()].rename(columns={"_of": "of", "_row": "row"})
            waiting = pd.concat([waiting, some[_HELD.names]])
        met = waiting.merge(ids, "left", "of", indicator="_met")
        there = (met["_met"] == "both").to_numpy()
        ok = there & (met["since"].fillna(0).astype(np.int64) <= met["time"] + limit).to_numpy()
        now = state.getCurrentWatermarkMs()
        over = ~there & ((met["time"] != _NEVER) & (met["time"] + limit < now * 1000)).to_numpy()
        yield out(met[ok], "promoted")
        yield out(met[over | there & ~ok], "expired")
        waiting = met[~there & ~over]
        if ids.empty and waiting.empty:
            if state.exists:
                state.remove()
            return
        state.update((_packed(ids, _KNOWN), _packed(waiting[_HELD.names], _HELD)))
        times = waiting["time"][waiting["time"] != _NEVER]
        if len(times):
            state.setTimeoutTimestamp(max((int(times.min()) + limit) // 1000, now) + 1)

    found = every.groupBy("_group").applyInPandasWithState(step, "_row string, tipo string, numero string, decision string", "known binary, held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.from_json("_row", held.schema, _JSON).alias("r"), "tipo", "numero", "decision").select("r.*", "tipo", "numero", "decision")


def fresh(requests: DataFrame, key: str, horizon: datetime.timedelta, late: str) -> DataFrame:
    """A stream of requests (key, at, ...) -> those for which a new snapshot is
    taken: the first of a key, and any more than the horizon after its last
    snapshot. All others have one that is fresh enough. Requests behind the
    watermark are dropped. State: a key's last snapshot, until the watermark is
    past its horizon, as whatever comes then takes a new one anyway."""
    limit = int(horizon.total_seconds() * 1000)
    rows = requests.withWatermark("at", late).select(F.col(key).alias("_key"), "at", F.to_json(F.struct(*requests.columns), _JSON).alias("_row"))

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        f = pd.concat([x[["at", "_row"]] for x in frames]).sort_values(["at", "_row"])
        times = (f["at"] - pd.Timestamp(0)).to_numpy().astype("timedelta64[us]").astype(np.int64)
        taken, i = [], 0 if last is None else int(np.searchsorted(times, last + limit * 1000, side="right"))
        while i < len(times):
            taken.append(i)
            last = int(times[i])
            i = int(np.searchsorted(times, last + limit * 1000, side="right"))
        state.update((last,))
        state.setTimeoutTimestamp(max(last // 1000 + limit, state.getCurrentWatermarkMs()) + 1)
        yield f.iloc[taken][["_row"]]

    found = rows.groupBy("_key").applyInPandasWithState(step, "_row string", "last long", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.from_json("_row", requests.schema, _JSON).alias("r")).select("r.*")


def in_runs(spark: SparkSession, parts: list[dict[str, DataFrame]], step: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    """What a streaming step gives out over several runs. Before each run, rows
    of each named input arrive as files; a run takes what is there
    (availableNow), stops, and the next one resumes from its checkpoint."""
    where = unique_folder(spark, "runs")
    schemas = {name: df.schema for name, df in parts[0].items()}
    out: StructType | None = None

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/out/{number}")

    for part in parts:
        for name, df in part.items():
            df.write.mode("append").parquet(f"{where}/in/{name}")
        result = step({name: spark.readStream.schema(schema).parquet(f"{where}/in/{name}") for name, schema in schemas.items()})
        out = result.schema
        result.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out).parquet(f"{where}/out/*")
