"""A versioned Parquet warehouse: S2 (staging refresh), S3 (scan), S4 (append
from query) and S6 (snapshot replace) without an in-place UPDATE.

Every write goes to a new directory (a *segment*) and is invisible until the
run commits: ``commit`` puts one small manifest file in place, atomically,
that names the segments of every table. Of two writers of one version one
fails. Readers list the versions and read the newest manifest. A run that
fails or is given up removes its segments; a plan never overwrites a path it
reads. Facts append one segment per load (partitioned by month); staging is
replaced by a new segment.

Tables that change row by row (an employee dimension) are split by ranges of
their key. The bounds of the ranges are chosen at the first write, at
quantiles of the keys, and kept in the manifest with the folder of every
range: a load reads the ranges its keys fall in, writes those that hold a
change anew and leaves the others where they are.

The root may be any Hadoop file system path the cluster shares.
"""

from __future__ import annotations

import copy
import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import shuffle_partitions
from lodestar.sources import files

MANIFEST = "_manifest"
KEY_RANGE = "keyrange"
SAMPLE_PER_RANGE = 200


def _manifest(root: str, version: int) -> str:
    return f"{root}/{MANIFEST}/{version:010d}.json"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, version: int | None = None,
                 new: bool = False):
        """Open the newest committed version, or ``version`` (read-only
        time travel to an earlier commit). ``new=True`` starts an empty
        warehouse at a fresh root without looking for a manifest."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.version, self.tables = (0, {}) if new else self._load_manifest(version)

    # -- manifest -----------------------------------------------------------
    def _load_manifest(self, version: int | None = None):
        known = [int(n[:-5]) for n in files.names(self.spark, f"{self.root}/{MANIFEST}")
                 if n[:-5].isdigit() and n.endswith(".json")]
        if version is None:
            if not known:
                return 0, {}
            version = max(known)
        elif version not in known:
            if not version:
                return 0, {}
            raise KeyError(f"warehouse {self.root} has no version {version}")
        text = self.spark.read.text(_manifest(self.root, version), wholetext=True).first()[0]
        return version, json.loads(text)["tables"]

    def refresh(self) -> "Warehouse":
        self.version, self.tables = self._load_manifest()
        return self

    # -- reads --------------------------------------------------------------
    def table_names(self) -> list:
        return sorted(self.tables)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        return _read(self.spark, self.root, self.tables, name, schema)

    def transaction(self) -> "Transaction":
        return Transaction(self)

    def row_count(self, name: str) -> int | None:
        return _stat(self.tables, name, "rows")

    def max_key(self, name: str) -> int | None:
        return _stat(self.tables, name, "max_key")


def range_of(key: Column, bounds: list) -> Column:
    """How many of the rising bounds are at or below the key, by halving."""
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(bounds[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))

    return among(0, len(bounds))


def key_bounds(df: DataFrame, key: str, ranges: int, rows: int) -> list:
    """Bounds that cut the keys into about equal ranges, from a sample of
    about ``SAMPLE_PER_RANGE`` keys a range of the ``rows`` (exact whole
    numbers: doubles do not tell large ids apart)."""
    if ranges < 2:
        return []
    share = SAMPLE_PER_RANGE * ranges / max(rows, 1)
    keys = df.select(key).where(F.col(key).isNotNull())
    found = sorted(r[0] for r in (keys.sample(share, seed=1) if share < 1 else keys).collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _stat(tables, name, field):
    """Statistics kept in the manifest at write time (no job to read them)."""
    entry = tables.get(name)
    if entry is None:
        return 0
    return entry.get(field)


def _read(spark, root, tables, name, schema=None) -> DataFrame:
    entry = tables.get(name)
    if entry is None:
        if schema is None:
            raise KeyError(f"table {name!r} does not exist in the warehouse")
        return spark.createDataFrame([], schema)
    stored = T.StructType.fromJson(json.loads(entry["schema"]))
    if not entry["segments"]:
        return spark.createDataFrame([], stored)
    df = (spark.read.schema(stored).option("basePath", f"{root}/{name}")
          .parquet(*entry["segments"]))
    return df.select(stored.fieldNames())


class Transaction:
    """Writes segments; nothing is visible to other readers until commit.
    Reads inside the transaction see its own writes."""

    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.spark = wh.spark
        self.tables = copy.deepcopy(wh.tables)
        self.metrics: dict = {}
        self._written: list = []
        # Independent loads may write different tables from several threads;
        # the bookkeeping below is guarded, the Spark writes run concurrently.
        self._lock = threading.Lock()

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        return _read(self.spark, self.wh.root, self.tables, name, schema)

    def row_count(self, name: str) -> int | None:
        return _stat(self.tables, name, "rows")

    def max_key(self, name: str) -> int | None:
        return _stat(self.tables, name, "max_key")

    def _segment(self, name: str) -> str:
        return f"{self.wh.root}/{name}/seg=s{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame, mode: str = "append",
              partition_by=None, observe=None, drop=(), key_col: str | None = None) -> dict:
        """Write ``df`` as a new segment of ``name``.

        ``mode``: ``append`` adds the segment, ``overwrite`` replaces all.
        ``observe``: extra aggregate Columns collected while writing (no
        second pass); ``rows`` is always collected, and ``max_key`` when
        ``key_col`` is given - both kept in the manifest. ``drop``: marker
        columns removed after observing.
        """
        path = self._segment(name)
        self._written.append(path)
        obs = Observation(f"w_{uuid.uuid4().hex[:8]}")
        exprs = [F.count(F.lit(1)).alias("rows")] + list(observe or [])
        if key_col:
            exprs.append(F.max(key_col).alias("max_key"))
        out = df.observe(obs, *exprs)
        if drop:
            out = out.drop(*drop)
        writer = out.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        metrics = {k: (v if v is not None else 0) for k, v in obs.get.items()}
        schema = out.schema
        if not metrics["rows"]:
            files.remove(self.spark, path)
        with self._lock:
            return self._record(name, path, mode, partition_by, key_col, metrics, schema)

    def _record(self, name, path, mode, partition_by, key_col, metrics, schema) -> dict:
        entry = self.tables.setdefault(
            name, {"segments": [], "schema": schema.json(), "partition_by": partition_by or [],
                   "rows": 0, "max_key": 0})
        entry["schema"] = schema.json()
        if mode == "overwrite":
            entry["segments"] = []
            entry["rows"] = 0
            entry["max_key"] = 0
        elif mode != "append":
            raise ValueError(f"mode must be append or overwrite, not {mode!r}")
        if metrics["rows"] > 0:
            entry["segments"].append(path)
        if entry.get("rows") is not None:
            entry["rows"] = entry["rows"] + int(metrics["rows"])
        if key_col and entry.get("max_key") is not None:
            entry["max_key"] = max(int(entry["max_key"]), int(metrics.get("max_key") or 0))
        else:
            entry["max_key"] = None
        self.metrics[name] = metrics
        return metrics

    def bounds(self, name: str) -> list | None:
        """The range bounds of a table split by key; None before its first write."""
        return self.tables.get(name, {}).get("bounds")

    def read_ranges(self, name: str, ranges, schema: T.StructType | None = None) -> DataFrame:
        """The rows of some key ranges."""
        entry = self.tables.get(name)
        if entry is None:
            return self.read(name, schema)
        ends = tuple(f"/{KEY_RANGE}={r}" for r in ranges)
        part = entry | {"segments": [s for s in entry["segments"] if s.endswith(ends)] if ends else []}
        return _read(self.spark, self.wh.root, {name: part}, name, schema)

    def last_segment(self, name: str) -> DataFrame | None:
        """What this transaction appended to ``name`` last, if anything."""
        entry = self.tables.get(name)
        if not entry or not entry["segments"] or entry["segments"][-1] not in self._written:
            return None
        part = entry | {"segments": entry["segments"][-1:]}
        return _read(self.spark, self.wh.root, {name: part}, name)

    def write_ranges(self, name: str, df: DataFrame, key: str, bounds: list, touched=None,
                     split: tuple | None = None, observe=None, drop=()) -> dict:
        """Write key ranges of ``name`` anew: ``df`` has all their rows, of
        all ranges or of those ``touched``; other ranges stay where they are.

        ``split``: (column, value replaced, value kept): rows with the second
        value replace the ranges' rows of that value, rows with the third are
        appended (SCD2: current against history)."""
        path = self._segment(name)
        self._written.append(path)
        rows = df.withColumn(KEY_RANGE, range_of(F.col(key), bounds))
        by = [split[0], KEY_RANGE] if split else [KEY_RANGE]
        place = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in by])
        exprs = [F.count(F.lit(1)).alias("rows"), F.collect_set(place).alias("places")]
        if split:
            exprs += [F.count_if(F.col(split[0]) == split[1]).alias("replaced"),
                      F.count_if(F.col(split[0]) == split[2]).alias("appended")]
        obs = Observation(f"w_{uuid.uuid4().hex[:8]}")
        out = rows.observe(obs, *(exprs + list(observe or []))).drop(*drop)
        if bounds:  # few files a range, however many tasks there are
            tasks = shuffle_partitions(self.spark)
            salt = F.pmod(F.xxhash64(key), F.lit(max(1, tasks // (len(bounds) + 1))))
            out = out.repartition(tasks, *by, salt)
        out.write.mode("errorifexists").partitionBy(*by).parquet(path)
        metrics = {k: (v if v is not None else 0) for k, v in obs.get.items()}
        places = sorted(metrics.pop("places") or [])
        if not metrics["rows"]:
            files.remove(self.spark, path)
        schema = T.StructType([f for f in out.schema if f.name != KEY_RANGE])
        with self._lock:
            entry = self.tables.setdefault(name, {"segments": [], "partition_by": by})
            first = f"{split[0]}={split[1]}/" if split else ""
            gone = tuple(f"/{first}{KEY_RANGE}={r}" for r in (range(len(bounds) + 1) if touched is None else touched))
            entry |= {"schema": schema.json(), "bounds": bounds, "rows": None, "max_key": None,
                      "segments": [s for s in entry["segments"] if not s.endswith(gone)]
                      + [f"{path}/{p}" for p in places]}
            self.tables[name] = entry
            self.metrics[name] = metrics
        return metrics

    def unchanged(self, name: str, **metrics) -> dict:
        """Note that a load leaves ``name`` as it is."""
        with self._lock:
            self.metrics[name] = {"rows": 0, **metrics}
        return self.metrics[name]

    def commit(self) -> int:
        version = self.wh.version + 1
        text = json.dumps({"version": version, "tables": self.tables}, sort_keys=True)
        if not files.publish(self.spark, _manifest(self.wh.root, version), text):
            self.abandon()
            raise RuntimeError(f"version {version} of {self.wh.root} was committed by another run")
        self.wh.version, self.wh.tables = version, copy.deepcopy(self.tables)
        return version

    def abandon(self) -> None:
        """Remove what this transaction wrote."""
        for path in self._written:
            files.remove(self.spark, path)
        self._written = []
