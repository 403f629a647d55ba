"""The result tables behind one manifest: a load of days becomes visible as a whole or not at all.

Layout under the store's root::

    data/<table>/load=<id>/broad_dt=<day>/...    rows of one load, never changed
    filters/<table>/load=<id>/...                its key filters (module ``keys``)
    manifest/<version>.json                      which load each day of each table is read from

A load writes its rows and filters aside, checks them, and then publishes the next version: one
small file, put in place by a rename that fails if the version exists. Readers take the newest
version (or any earlier one), so a load that fails half-way, before either write or between the
two, leaves the days as they were; its files are named by no version and ``remove_unnamed``
clears them. Two loads at once: the later one to publish takes the other's version as its base,
unless both replaced a day, which is refused.

The report's key must be unique over the whole table, not only within a load. Days that
stay are checked through the manifest's ranges and the filters; only those that may hold a
key of the load are read.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockout import schemas
from stockout.sinks.keys import StoredDay, day_filters, days_that_may_hold, filter_bits, overlapping_days
from stockout.sinks.tables import ALL_DAYS, KeyViolation, report_rows, snapshot_rows
from stockout.stage import write_stage

REPORT, SNAPSHOT, AUDIT = "soldout_report", "soldout_snapshot", "load_audit"
#: Keys that must be unique over all days; the snapshot's key holds the day itself.
WHOLE_TABLE_KEYS = {REPORT: schemas.REPORT_KEY}


class CommitConflict(RuntimeError):
    pass


@dataclass(frozen=True)
class DayEntry:
    """One day of one table: the load it is read from, its rows, and its keys' range and filter size
    (0 bits: no filter)."""

    load: str
    rows: int
    low: int = 0
    high: int = 0
    n_bits: int = 0


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    loaded_at: float = 0.0
    changed: tuple[str, ...] = ()
    tables: dict[str, dict[str, DayEntry]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    fingerprints: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "loaded_at": self.loaded_at, "changed": list(self.changed),
                           "schemas": self.schemas, "fingerprints": self.fingerprints, "metrics": self.metrics,
                           "tables": {t: {d: asdict(e) for d, e in sorted(days.items())} for t, days in sorted(self.tables.items())}})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["version"], raw["loaded_at"], tuple(raw["changed"]),
                        {t: {d: DayEntry(**e) for d, e in days.items()} for t, days in raw["tables"].items()},
                        raw["schemas"], raw["fingerprints"], raw["metrics"])


class ResultStore:
    """The two result tables under ``root``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        #: Days whose keys the last load read for its check.
        self.days_read: tuple[str, ...] = ()

    # -- small files -------------------------------------------------------------------
    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("manifest").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place = self._path(folder)
        fs = self._files()
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("manifest") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version, or the given one; an empty one where nothing was loaded."""
        known = self.versions()
        if version is None:
            if not known:
                return Manifest()
            version = known[-1]
        if version not in known:
            raise ValueError(f"no version {version} among {known[:1]}..{known[-1:]}")
        stream = self._files().open(self._path(f"manifest/{version:010d}.json"))
        try:
            return Manifest.from_json(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> bool:
        """Put a version in place; False if it exists already."""
        aside = self._path(f"manifest/_{uuid.uuid4().hex}")
        fs, gateway = self._files(), self.spark.sparkContext._gateway
        stream = fs.create(aside, False)
        stream.write(bytearray(manifest.to_json().encode()))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        options = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, self._path(f"manifest/{manifest.version:010d}.json"), options)
        except Exception as e:  # the bridge has one class for all Java errors
            fs.delete(aside, False)
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True

    # -- reading -----------------------------------------------------------------------
    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The days of ``table`` as of a version (the newest, or the given one)."""
        manifest = self.manifest(version)
        if table not in manifest.schemas:
            raise ValueError(f"{table} was never loaded under {self.root}")
        schema = StructType.fromJson(manifest.schemas[table])
        entries = {d: e for d, e in manifest.tables[table].items() if e.rows}
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self._stored("data", table, entries).select([F.col(f.name).cast(f.dataType) for f in schema.fields])

    def report(self, version: int | None = None) -> DataFrame:
        return self.read(REPORT, version)

    def snapshot(self, version: int | None = None) -> DataFrame:
        return self.read(SNAPSHOT, version)

    def audit(self, version: int | None = None) -> DataFrame:
        return self.read(AUDIT, version)

    def _stored(self, kind: str, table: str, entries: dict[str, DayEntry]) -> DataFrame:
        base = f"{self.root}/{kind}/{table}"
        paths = [f"{base}/load={e.load}/broad_dt={day}" for day, e in sorted(entries.items())]
        # The day's type is guessed from its folder names.
        return self.spark.read.option("basePath", base).parquet(*paths).withColumn("broad_dt", F.col("broad_dt").cast("string"))

    # -- loading -----------------------------------------------------------------------
    def load(self, report: DataFrame, snapshot: DataFrame, days: tuple[str, ...] | str, audit: DataFrame | None = None,
             fingerprints: dict[str, str] | None = None) -> Manifest:
        """Replace ``days`` (ALL_DAYS: the whole store) in all tables by one version. Days asked for
        that have no rows become empty; rows of other days are an error. ``audit``: rows by day on what
        was left out; ``fingerprints``: by day, what it was computed from (``plans.backfill``).

        Rows and nulls by column are counted while the tables are written and kept in the version."""
        base = self.manifest()
        load = uuid.uuid4().hex
        given = {REPORT: report, SNAPSHOT: snapshot} | ({} if audit is None else {AUDIT: audit})
        staged, metrics = {}, {}
        for table, rows in given.items():
            counted = Observation()
            nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in rows.columns]
            staged[table] = write_stage(rows.observe(counted, F.count(F.lit(1)).alias("rows"), *nulls), table)
            metrics[table] = {k: int(v) for k, v in counted.get.items()}
        staged[REPORT], staged[SNAPSHOT] = report_rows(staged[REPORT]), snapshot_rows(staged[SNAPSHOT])
        found = {t: self._days_of(df, t) for t, df in staged.items()}
        asked = set().union(*found.values()) if days == ALL_DAYS else set(days)
        for table, entries in found.items():
            if set(entries) - asked:
                raise ValueError(f"{table}: rows of days that were not asked for: {sorted(set(entries) - asked)}")
        stays = {} if days == ALL_DAYS else {d: e for d, e in base.tables.get(REPORT, {}).items() if d not in asked}
        self._check_whole_table(staged[REPORT], found[REPORT], stays)
        entries = {t: self._write(df, t, load, found[t]) for t, df in staged.items()}
        kinds = {t: df.schema.jsonValue() for t, df in staged.items()}
        return self._commit(base, entries, asked, days == ALL_DAYS, kinds, fingerprints or {}, metrics)

    def _days_of(self, rows: DataFrame, table: str) -> dict[str, DayEntry]:
        """Per day of a load: its rows and, where the key spans the table, its range and filter size."""
        key = WHOLE_TABLE_KEYS.get(table)
        extent = [F.min(key[0]).alias("low"), F.max(key[0]).alias("high")] if key else []
        out = {}
        for r in rows.groupBy("broad_dt").agg(F.count("*").alias("n"), *extent).collect():  # one row a day
            out[r["broad_dt"]] = DayEntry("", r["n"], r["low"], r["high"], filter_bits(r["n"])) if key else DayEntry("", r["n"])
        return out

    def _write(self, rows: DataFrame, table: str, load: str, found: dict[str, DayEntry]) -> dict[str, DayEntry]:
        rows.write.partitionBy("broad_dt").parquet(f"{self.root}/data/{table}/load={load}")
        key = WHOLE_TABLE_KEYS.get(table)
        if key and found:
            filters = day_filters(rows, key, {d: e.n_bits for d, e in found.items()})
            filters.write.partitionBy("broad_dt").parquet(f"{self.root}/filters/{table}/load={load}")
        return {d: DayEntry(load, e.rows, e.low, e.high, e.n_bits) for d, e in found.items()}

    def _check_whole_table(self, report: DataFrame, found: dict[str, DayEntry], stays: dict[str, DayEntry]) -> None:
        """Refuse a load with a key that a day which stays, or another day of the load, has too."""
        self.days_read = ()
        key = WHOLE_TABLE_KEYS[REPORT]
        several = report.groupBy(*key).agg(F.count_distinct("broad_dt").alias("n")).where(F.col("n") > 1)
        clashes = several.limit(5).collect()
        if not clashes and found and stays:
            clashes = self.clashing_keys(report, found, stays).limit(5).collect()
        if clashes:
            raise KeyViolation(f"{REPORT}: keys of more than one day, such as {[tuple(r[k] for k in key) for r in clashes]}")

    def clashing_keys(self, report: DataFrame, found: dict[str, DayEntry] | None = None,
                      stays: dict[str, DayEntry] | None = None) -> DataFrame:
        """Rows (key..., broad_dt) of stored days that hold a key of ``report`` under another day."""
        key = WHOLE_TABLE_KEYS[REPORT]
        if found is None:
            found = self._days_of(report, REPORT)
        if stays is None:
            stays = {d: e for d, e in self.manifest().tables.get(REPORT, {}).items() if d not in found}
        stored = {d: StoredDay(e.low, e.high, e.n_bits) for d, e in stays.items() if e.rows}
        may_hold: list[str] = []
        if found and (near := overlapping_days(stored, min(e.low for e in found.values()), max(e.high for e in found.values()))):
            filters = self._stored("filters", REPORT, {d: stays[d] for d in near}).select("broad_dt", "word", "bits")
            may_hold = days_that_may_hold(report, key, filters, {d: stored[d] for d in near})
        self.days_read = tuple(may_hold)
        if not may_hold:
            return report.select(*key, "broad_dt").where("false")
        held = self._stored("data", REPORT, {d: stays[d] for d in may_hold}).select(*key, "broad_dt")
        return held.join(report.select(*key).distinct(), list(key), "left_semi")

    def _commit(self, base: Manifest, entries: dict[str, dict[str, DayEntry]], asked: set[str], whole: bool,
                kinds: dict[str, dict], fingerprints: dict[str, str], metrics: dict[str, dict[str, int]]) -> Manifest:
        while True:
            now = self.manifest()
            since = [self.manifest(v) for v in self.versions() if v > base.version]
            if whole and since or any(set(m.changed) & asked for m in since):
                raise CommitConflict(f"days changed since version {base.version}")
            tables = {t: {} if whole else {d: e for d, e in now.tables.get(t, {}).items() if d not in asked}
                      for t in {*entries, *now.tables}}
            for t, days in entries.items():
                tables[t].update(days)
            prints = {d: v for d, v in now.fingerprints.items() if not whole and d not in asked}
            new = Manifest(now.version + 1, time.time(), tuple(sorted(asked)), tables, {**now.schemas, **kinds},
                           {**prints, **fingerprints}, metrics)
            if since:
                self._recheck(entries[REPORT], since, new)
            if self._publish(new):
                return new

    def _recheck(self, mine: dict[str, DayEntry], since: list[Manifest], new: Manifest) -> None:
        """The whole-table check against days that were loaded in between."""
        came = set().union(*(m.changed for m in since))
        stays = {d: e for d, e in new.tables[REPORT].items() if d in came and d not in mine}
        if stays and mine:
            if not self.clashing_keys(self._stored("data", REPORT, mine), mine, stays).isEmpty():
                raise KeyViolation(f"{REPORT}: keys of days that were loaded at the same time")

    # -- upkeep ------------------------------------------------------------------------
    def remove_unnamed(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete loads that no version names and that are older than a load may take."""
        named = {e.load for v in self.versions() for days in self.manifest(v).tables.values() for e in days.values()}
        fs, gone = self._files(), []
        before = (time.time() - older_than_hours * 3600) * 1000
        for kind in ("data", "filters"):
            for table in (REPORT, SNAPSHOT, AUDIT):
                for name in self._names(f"{kind}/{table}"):
                    place = self._path(f"{kind}/{table}/{name}")
                    if name.startswith("load=") and name[5:] not in named and fs.getFileStatus(place).getModificationTime() < before:
                        fs.delete(place, True)
                        gone.append(f"{kind}/{table}/{name}")
        return gone
