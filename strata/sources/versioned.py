"""SCD2 history on plain files without MERGE.

Layout under ``root`` (any Hadoop filesystem the cluster shares)::

    data/version=v<commit>/kind=closed/    versions closed by that commit
    data/version=v<commit>/kind=gone/      closed versions of earlier commits it withdraws
    data/version=v<commit>/kind=current/   open versions (of the buckets it touches) after it
    loads/version=v<commit>/               the rows that commit was given
    _commits/<commit>                      marker, created last: what the commit holds

A commit is named ``<sequence>.<load time>.<epoch>``. The log of commits, not
the load time alone, says what has been applied:

* a load newer than all others closes and opens versions of its own keys;
* rows of the newest load time that come in another micro-batch (another
  epoch) are merged into it, the winner per (key, load) by the load's order;
* an epoch that is already committed is a replay and changes nothing;
* a past load is refused and counted, or (``late="merge"``) it splits the
  intervals it falls in: the version that covers it is cut, the next time the
  key was seen starts a version again, and equal neighbours are merged. Any
  order of loads gives the history of the sorted order.

A commit reads the open versions of the buckets its keys fall in, and only for
past loads the closed versions from the load time on and the stored loads, both
of its own keys. The keys of the batch are the side that is broadcast when Spark
measures it as small: the current set is not exchanged then. With ``buckets``
over 1 only touched buckets are read and written again. A failed commit leaves
no marker, so readers keep the old state, and its rerun gets a folder of its own.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from strata.functions.exprs import names
from strata.operators import scd2
from strata.operators.dedup import latest

_FMT = "%Y%m%d%H%M%S%f"
LOAD = "_load"  # the load time in stored loads


def version_of(load_time: dt.datetime) -> str:
    return load_time.strftime(_FMT)


@dataclass(frozen=True)
class Commit:
    """One entry of the log; ``held`` are rows per kind, ``buckets`` the touched ones (None: all)."""

    seq: int
    load: str
    epoch: str
    held: dict = field(default_factory=dict)
    buckets: tuple | None = None
    schema: str = ""

    @property
    def name(self) -> str:
        return f"{self.seq:08d}.{self.load}.{self.epoch}"


class _Versioned:
    """Log of commits and version folders on a Hadoop filesystem."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, rel: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rel}")

    def _fs(self, p):
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _markers(self) -> list[str]:
        p = self._path("_commits")
        fs = self._fs(p)
        if not fs.exists(p):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith("."))

    def commits(self) -> list[Commit]:
        """All commits in the order they were made."""
        found = []
        for name in self._markers():
            p = self._path(f"_commits/{name}")
            stream = self._fs(p).open(p)
            try:
                held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            seq, load, epoch = name.split(".", 2)
            buckets = held["buckets"]
            found.append(Commit(int(seq), load, epoch, held["held"], None if buckets is None else tuple(buckets), held["schema"]))
        return found

    def version(self) -> str | None:
        """Newest committed load time, or None for an empty table."""
        return max((n.split(".")[1] for n in self._markers()), default=None)

    def has_epoch(self, epoch: str | None) -> bool:
        return epoch is not None and any(n.split(".", 2)[2] == epoch for n in self._markers())

    def is_late(self, load_time: dt.datetime, epoch: str | None = None) -> bool:
        """True when ``load_time`` is before the newest load, or is that load
        and no new epoch says that more of it has come."""
        newest, v = self.version(), version_of(load_time)
        return newest is not None and (v < newest or (v == newest and (epoch is None or self.has_epoch(epoch))))

    def _next(self, load: str, epoch: str | None) -> Commit:
        """A commit to be: a name of its own, also after a crash (``load`` without an epoch)."""
        done = self._markers()
        return Commit(int(done[-1].split(".")[0]) + 1 if done else 0, load, epoch or f"load-{uuid.uuid4().hex[:12]}")

    def _commit(self, c: Commit) -> None:
        p = self._path(f"_commits/{c.name}")
        fs = self._fs(p)
        fs.mkdirs(self._path("_commits"))
        text = json.dumps({"held": c.held, "buckets": c.buckets, "schema": c.schema})
        tmp = self._path(f"_commits/.{c.name}")
        out = fs.create(tmp, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(tmp, p):  # readers see the whole marker or none
            raise RuntimeError(f"{self.root}: commit {c.name} could not be made")

    def _version_dir(self, c: Commit) -> str:
        return f"{self.root}/data/version=v{c.name}"

    def _drop(self, commits: Sequence[Commit], suffix: str) -> list[str]:
        """Delete ``data/version=v<commit>/<suffix>`` of these commits."""
        removed = []
        for c in commits:
            target = self._path(f"data/version=v{c.name}{suffix}")
            fs = self._fs(target)
            if fs.exists(target):
                fs.delete(target, True)
                removed.append(c.name)
        return removed


class VersionedTable(_Versioned):
    """A table replaced as a whole per load, readable while the next one is written.

    Each load writes a folder of its own and then commits; readers see the
    newest commit. Used for models that read their own previous state (the
    newest-row table reads itself for its high-water mark and merge), which a
    plain overwrite of the same path cannot do.
    """

    def read(self) -> DataFrame | None:
        done = self.commits()
        if not done:
            return None
        return (self.spark.read.schema(T.StructType.fromJson(json.loads(done[-1].schema)))
                .parquet(self._version_dir(done[-1])))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions (each is a full copy)."""
        if keep < 1:
            raise ValueError("keep at least the committed version")
        return self._drop(self.commits()[:-keep], "")

    def write(self, df: DataFrame, load_time: dt.datetime, epoch: str | None = None, past: bool = False) -> int:
        """Write and commit ``df`` as the table after ``load_time``.

        A load that is late (see :meth:`is_late`) is refused, unless ``past``
        says that ``df`` has taken it in. A committed version is never
        rewritten: it may be the input of the very DataFrame being written.
        """
        from strata.sources.tables import overwrite
        if self.has_epoch(epoch) or (not past and self.is_late(load_time, epoch)):
            raise ValueError(f"{self.root}: version {version_of(load_time)} is not newer than {self.version()}")
        c = self._next(version_of(load_time), epoch)
        n = overwrite(df, self._version_dir(c))
        self._commit(Commit(c.seq, c.load, c.epoch, {"rows": n}, None, df.schema.json()))
        return n


class VersionedHistory(_Versioned):
    """One SCD2 table: closed versions by commit, the open ones in full or by bucket.

    ``order`` ranks rows of one (key, load), best first, over columns of the
    loads; without it the row that came last wins.
    """

    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str],
                 tracked: str | Sequence[str], columns: Sequence[str],
                 order: Sequence[Column] = (), buckets: int = 1):
        super().__init__(spark, root)
        self.keys, self.tracked, self.columns = names(key), names(tracked), list(columns)
        self.order, self.buckets = list(order), buckets

    # -- reads ----------------------------------------------------------------
    @property
    def _cols(self) -> list[str]:
        return [*self.columns, scd2.VALID_FROM, scd2.VALID_TO, scd2.IS_CURRENT]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _rows(self, done: Sequence[Commit], kind: str) -> DataFrame:
        """Rows of one kind of these commits, with the number of their commit."""
        schema = T.StructType.fromJson(json.loads(done[-1].schema))
        paths = [f"{self._version_dir(c)}/kind={kind}" for c in done if c.held.get(kind)]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_seq", T.IntegerType())]))
        version = F.regexp_extract(F.col("version"), r"^v(\d+)\.", 1).cast("int")
        whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        return (self.spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*paths)
                .select(*self._cols, version.alias("_seq")))

    def _open(self, done: Sequence[Commit], wanted: set[int] | None = None) -> DataFrame | None:
        """Open versions of the ``wanted`` buckets (None: all) from the newest commit of each."""
        if not done:
            return None
        left = set(range(self.buckets)) if wanted is None else set(wanted)
        paths = []
        for c in reversed(done):
            mine = left if c.buckets is None else left & set(c.buckets)
            if mine and c.held.get("current"):
                where = f"{self._version_dir(c)}/kind=current"
                if self.buckets == 1:
                    paths.append(where)
                else:
                    for b in sorted(mine):
                        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{where}/bucket={b}")
                        if self._fs(p).exists(p):
                            paths.append(f"{where}/bucket={b}")
            left = left - mine
            if not left:
                break
        schema = T.StructType.fromJson(json.loads(done[-1].schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _closed(self, done: Sequence[Commit]) -> DataFrame:
        """Closed versions of all commits without those a later commit withdrew."""
        closed = self._rows(done, "closed")
        if not any(c.held.get("gone") for c in done):
            return closed
        at = [*self.keys, scd2.VALID_FROM]
        gone = (self._rows(done, "gone").groupBy(*at).agg(F.max("_seq").alias("s"))
                .select(F.struct(*at, "s").alias("_g")))
        on = F.col("_g.s") > F.col("_seq")
        for c in at:
            on = on & F.col(c).eqNullSafe(F.col(f"_g.{c}"))
        return closed.join(gone, on, "left_anti")

    def current(self) -> DataFrame | None:
        """Open versions of the committed state (None when nothing is committed)."""
        return self._open(self.commits())

    def read(self) -> DataFrame | None:
        """Whole history of the committed state."""
        done = self.commits()
        if not done:
            return None
        return self._open(done).select(*self._cols).unionByName(self._closed(done).select(*self._cols))

    # -- writes ---------------------------------------------------------------
    def _write(self, rows: DataFrame, c: Commit, hit: Sequence[int] | None, loads: DataFrame | None) -> dict:
        """``rows`` (history columns, kind), and the rows of the load, then the marker."""
        seen = Observation(f"scd2_{uuid.uuid4().hex}")
        new_open = (F.col("kind") == "current") & F.col("_new")
        counted = rows.observe(seen, *[F.count_if(F.col("kind") == k).alias(k) for k in ("closed", "gone", "current")],
                               F.count_if(new_open).alias("opened")).drop("_new")
        parts = ["kind"]
        if self.buckets > 1:
            counted, parts = counted.withColumn("bucket", self._bucket()), ["kind", "bucket"]
        counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(self._version_dir(c))
        if loads is not None:
            loads.write.mode("overwrite").parquet(f"{self.root}/loads/version=v{c.name}")
        m = {k: int(seen.get.get(k, 0)) for k in ("closed", "gone", "current", "opened")}
        schema = T.StructType([f for f in rows.schema.fields if f.name in self._cols])
        held = {**m, "loads": 0 if loads is None else 1}
        self._commit(Commit(c.seq, c.load, c.epoch, held, None if hit is None else tuple(hit), schema.json()))
        return {"version": c.load, "closed": m["closed"], "opened": m["opened"], "current": m["current"],
                "withdrawn": m["gone"]}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete open sets that nothing reads any more.

        Each commit writes the open versions of its buckets; only the newest
        copy of a bucket is ever read, so older copies are dead weight. Closed
        versions and stored loads are never deleted. ``keep >= 2`` leaves what
        the previous commits read for readers that resolved them just before
        the latest one.
        """
        if keep < 1:
            raise ValueError("keep at least the committed version")
        done, every = self.commits(), set(range(self.buckets))
        covered, removed = set(), []
        for i in range(len(done) - 1, -1, -1):
            mine = every if done[i].buckets is None else set(done[i].buckets)
            if i < len(done) - keep and mine <= covered:
                removed += self._drop([done[i]], "/kind=current")
            if i <= len(done) - keep:  # what the oldest kept commit can read
                covered |= mine
        return removed[::-1]

    def bootstrap(self, history: DataFrame, load_time: dt.datetime) -> dict:
        """Store an initial history (e.g. from :func:`scd2.build`) as load ``load_time``.
        Loads up to that time are late for good: their rows are not stored."""
        if self.version() is not None:
            raise ValueError(f"{self.root} already holds version {self.version()}")
        kind = F.when(F.col(scd2.IS_CURRENT), F.lit("current")).otherwise(F.lit("closed"))
        rows = history.select(*self._cols).withColumns({"kind": kind, "_new": F.lit(True)})
        return self._write(rows, self._next(version_of(load_time), "bootstrap"), None, None)

    def apply_load(self, batch: DataFrame, load_time: dt.datetime, null_safe: bool = True,
                   late: str = "refuse", epoch: str | None = None) -> dict:
        """One load: ``batch`` holds at most one row per key (the load's newest rows)."""
        stamped = batch.withColumn("load_time", F.lit(load_time).cast("timestamp_ntz"))
        if not null_safe:  # the three-valued comparison knows no one-pass form
            if self.is_late(load_time):
                return {"version": self.version(), "late": True, "closed": 0, "opened": 0, "current": None}
            out = scd2.apply_batch(self.current(), stamped, self.keys, self.tracked, self.columns, "load_time", False)
            kind = F.when(F.col(scd2.IS_CURRENT), F.lit("current")).otherwise(F.lit("closed"))
            return self._write(out.select(*self._cols).withColumns(
                {"kind": kind, "_new": F.col(scd2.VALID_FROM) == F.lit(load_time)}),
                self._next(version_of(load_time), epoch), None, stamped.withColumnRenamed("load_time", LOAD))
        return self.apply_loads(stamped, "load_time", late=late, epoch=epoch)

    def apply_loads(self, log: DataFrame, load_col: str = "load_time", tiebreak: Sequence[str] = (),
                    late: str = "refuse", epoch: str | None = None) -> dict:
        """Several loads at once (a micro-batch, a backfill, a past day).

        ``late``: what happens to rows before the newest load, ``refuse`` or
        ``merge``. Rows at the newest load time count as late too, unless
        ``epoch`` (or ``merge``) says that they are more of that load. The
        result has the number of refused rows in ``late_rows``.
        """
        if late not in ("refuse", "merge"):
            raise ValueError(f"late: {late}")
        prev, done = self.version(), self.commits()
        nothing = {"version": prev, "late": True, "closed": 0, "opened": 0, "current": None, "late_rows": 0}
        if self.has_epoch(epoch):
            return {**nothing, "replay": True}
        log = log.withColumn(load_col, F.col(load_col).cast("timestamp_ntz"))
        refused = self._refused(done, prev, load_col, late, epoch)
        span = log.agg(F.min(F.when(~refused, F.col(load_col))).alias("low"), F.max(F.when(~refused, F.col(load_col))).alias("high"),
                       F.count_if(refused).alias("late")).first()
        if span["high"] is None:
            return {**nothing, "late_rows": span["late"]}
        given = log.where(~refused).withColumnRenamed(load_col, LOAD)
        c = self._next(version_of(span["high"]), epoch)
        if prev is None or version_of(span["low"]) > prev:
            observed, past = given, None
        else:
            observed = self._between(given, done, span["low"]).persist()  # read by several joins and jobs
            past = span["low"]
        try:
            rows, hit = self._changes(observed, done, past, list(tiebreak))
            return {**self._write(rows, c, hit, given), "late_rows": span["late"]}
        finally:
            if past is not None:
                observed.unpersist()

    def _refused(self, done: Sequence[Commit], prev: str | None, load_col: str, late: str, epoch: str | None) -> Column:
        t = F.col(load_col)
        if prev is None:
            return t.isNull()
        newest = F.lit(dt.datetime.strptime(prev, _FMT)).cast("timestamp_ntz")
        first = dt.datetime.strptime(done[0].load, _FMT)
        if late == "merge":  # what came before the stored loads can't be placed
            return t.isNull() if done[0].epoch != "bootstrap" else t.isNull() | (t <= F.lit(first).cast("timestamp_ntz"))
        more = epoch is not None and done[-1].epoch != "bootstrap"
        return t.isNull() | (t < newest if more else t <= newest)

    def _between(self, given: DataFrame, done: Sequence[Commit], low: dt.datetime) -> DataFrame:
        """The rows of ``given`` that win their (key, load), each followed by the
        next row in which its key was seen; columns LOAD, ``_mine`` and the rest."""
        stored = [c for c in done if c.held.get("loads")]
        mine = given.withColumns({"_seq": F.lit(1 << 30), "_mine": F.lit(True)})
        if stored:
            paths = [f"{self.root}/loads/version=v{c.name}" for c in stored]
            version = F.regexp_extract(F.col("version"), r"^v(\d+)\.", 1).cast("int")
            schema = T.StructType([*given.schema.fields, T.StructField("version", T.StringType())])
            seen = (self.spark.read.schema(schema).option("basePath", f"{self.root}/loads").parquet(*paths)
                    .where(F.col(LOAD) >= F.lit(low).cast("timestamp_ntz"))
                    .withColumns({"_seq": version, "_mine": F.lit(False)}).drop("version"))
            mine = mine.unionByName(_of_keys(seen, given, self.keys, "left_semi"))
        best = latest(mine, [*self.keys, LOAD], [*self.order, F.col("_seq").desc()])
        w = Window.partitionBy(*self.keys).orderBy(LOAD)
        after = F.coalesce(F.lag("_mine").over(w), F.lit(False))
        return best.withColumn("_next", after).where(F.col("_mine") | F.col("_next")).drop("_seq", "_next")

    def _changes(self, observed: DataFrame, done: Sequence[Commit], past: dt.datetime | None,
                 tiebreak: list[str]) -> tuple[DataFrame, list[int] | None]:
        """What the commit writes (history columns, kind, _new) and the buckets it touches."""
        hit = None
        if self.buckets > 1:
            hit = sorted(r[0] for r in observed.select(self._bucket().alias("b")).distinct().collect())
        time = F.col(LOAD).alias(scd2.VALID_FROM)
        extra = [F.col(t) for t in tiebreak]
        seen = observed.select(*self.columns, time, *extra, (F.lit(2) if past is None else F.when(F.col("_mine"), F.lit(2)).otherwise(F.lit(0))
                                                             ).alias("_src"))
        current = self._open(done, None if hit is None else set(hit))
        if current is None:
            fresh = scd2.build(seen, self.keys, self.tracked, self.columns, scd2.VALID_FROM, ["_src", *tiebreak], hot=None)
            kind = F.when(F.col(scd2.IS_CURRENT), F.lit("current")).otherwise(F.lit("closed"))
            return fresh.withColumns({"kind": kind, "_new": F.lit(True)}), None
        mine = _of_keys(current, observed, self.keys, "left_semi").select(*self._cols)
        rest = _of_keys(current, observed, self.keys, "left_anti").select(*self._cols)
        before = mine
        if past is not None:
            later = F.col(scd2.VALID_TO) >= F.lit(past).cast("timestamp_ntz")
            closed = _of_keys(self._closed(done).where(later), observed, self.keys, "left_semi").select(*self._cols)
            before = mine.unionByName(closed)
        # Versions are rows in which their key was seen; a row of this load at the same time takes their place.
        seeds = before.select(*self.columns, scd2.VALID_FROM, *[F.lit(None).cast(observed.schema[t].dataType).alias(t) for t in tiebreak],
                              F.lit(1).alias("_src"))
        both = seeds.unionByName(seen)
        if past is not None:
            both = latest(both, [*self.keys, scd2.VALID_FROM], [F.col("_src").desc()])
        after = scd2.build(both, self.keys, self.tracked, self.columns, scd2.VALID_FROM, ["_src", *tiebreak], hot=None).select(*self._cols)
        loads = [r[0] for r in observed.where(F.lit(True) if past is None else F.col("_mine")).select(LOAD).distinct().limit(1000).collect()]
        fresh = F.col(scd2.VALID_FROM).isin(loads) if len(loads) < 1000 else F.lit(True)
        open_, shut = after.where(F.col(scd2.IS_CURRENT)), after.where(~F.col(scd2.IS_CURRENT))
        out = (rest.withColumns({"kind": F.lit("current"), "_new": F.lit(False)})
               .unionByName(open_.withColumns({"kind": F.lit("current"), "_new": fresh})))
        if past is None:
            return out.unionByName(shut.withColumns({"kind": F.lit("closed"), "_new": F.lit(False)})), hit
        was = before.where(~F.col(scd2.IS_CURRENT))
        out = out.unionByName(shut.exceptAll(was).withColumns({"kind": F.lit("closed"), "_new": F.lit(False)}))
        return out.unionByName(was.exceptAll(shut).withColumns({"kind": F.lit("gone"), "_new": F.lit(False)})), hit


def _of_keys(rows: DataFrame, batch: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or isn't (``left_anti``) in the batch; NULL is a key."""
    side = batch.select(F.struct(*keys).alias("_b"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b.{k}"))
    return rows.join(side, on, how)


def apply_loads(current: DataFrame | None, log: DataFrame, key: str | Sequence[str],
                tracked: str | Sequence[str], columns: Sequence[str], load_col: str = "load_time",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Open rows after several loads, plus the rows those loads closed.

    The current set enters as the first observation of each key (at its
    ``valid_from``), the loads follow in time order, and the one-pass
    builder (:func:`scd2.build`) does the rest. Equal to applying the loads
    one by one (null-safe comparison, one row per key and load).
    """
    keys, tracked = names(key), names(tracked)
    tb = list(tiebreak)
    log_rows = log.select(*columns, F.col(load_col).cast("timestamp_ntz").alias("_load"),
                          *[F.col(c) for c in tb], F.lit(1).alias("_src"))
    if current is None:
        rows = log_rows
    else:
        seed = current.select(*columns, F.col(scd2.VALID_FROM).alias("_load"),
                              *[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in tb],
                              F.lit(0).alias("_src"))
        rows = seed.unionByName(log_rows)
    return scd2.build(rows, keys, tracked, columns, "_load", tiebreak=["_src", *tb])
