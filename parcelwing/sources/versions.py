"""Tables kept as versions: folders that are written once, and one small file per version that names them.

A version becomes visible when its file is moved into place under a number that
was free, so a refresh that ends early leaves the old table, and two refreshes
at once cannot both succeed. A reader is pinned to the folders of the version it
opened. A table that is laid out by day may take single days from a new folder
and keep the others where they are. The file also carries what was learnt while
the data were written: figures, crowded keys, the last source version applied.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

VERSIONS, DATA, WRITE = "_versions", "data", "write"
FILES_PER_DAY = 4


class Files:
    """The few file operations that a pointer needs, on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file, whole or not at all; fails if the name is taken."""
        draft = self._path(f"{path}.{os.urandom(4).hex()}.draft")
        stream = self.fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf)
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 1)
        none[0] = options.NONE
        try:
            context.rename(draft, self._path(path), none)
        except Exception:
            self.fs.delete(draft, False)
            raise

    def remove(self, folder: str) -> None:
        self.fs.delete(self._path(folder), True)


@dataclass(frozen=True)
class Write:
    """One folder of a version, and the days in it that a later folder has replaced."""

    name: str
    without: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    number: int
    schema: str
    writes: tuple[Write, ...]
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """Data that are written but not part of a version yet."""

    write: str
    schema: str
    based_on: int
    notes: dict


class Conflict(Exception):
    """Another refresh has published a version since this one began."""


class VersionedTable:
    """A table below `path`. With `ts` and `day` it is laid out by the calendar day of the timestamp `ts`."""

    def __init__(self, spark: SparkSession, path: str, ts: str | None = None, day: str | None = None):
        self.spark, self.path, self.ts, self.day = spark, path.rstrip("/"), ts, day
        self.files = Files(spark, path)

    # --- versions ---------------------------------------------------------------
    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.path}/{VERSIONS}") if n.endswith(".json")]

    def version(self, number: int | None = None) -> Version:
        known = self.numbers()
        if not known or number is not None and number not in known:
            raise FileNotFoundError(f"{self.path} has no version {'' if number is None else number}")
        told = json.loads(self.files.read(self._file(known[-1] if number is None else number)))
        writes = tuple(Write(w["name"], tuple(w["without"])) for w in told["writes"])
        return Version(told["number"], told["schema"], writes, told["notes"])

    def exists(self) -> bool:
        return bool(self.numbers())

    def _file(self, number: int) -> str:
        return f"{self.path}/{VERSIONS}/{number:010d}.json"

    # --- writing ----------------------------------------------------------------
    def stage(self, df: DataFrame, notes: dict | None = None) -> Staged:
        """Write the rows to a folder of their own; nobody reads them before `publish`."""
        known = self.numbers()
        write = os.urandom(6).hex()
        folder = f"{self.path}/{DATA}/{WRITE}={write}"
        if self.day:
            spread = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if kind != "variant"]), F.lit(FILES_PER_DAY))
            dated = df.withColumn(self.day, F.to_date(self.ts))
            # at most FILES_PER_DAY files a day, and a crowded day is still spread over tasks
            dated.repartition(F.col(self.day), spread).write.partitionBy(self.day).parquet(folder)
        else:
            df.write.parquet(folder)
        return Staged(write, df.schema.json(), known[-1] if known else 0, notes or {})

    def publish(self, staged: Staged, days: list[dt.date | None] | None = None) -> Version:
        """Make staged data the new version; with `days`, these days of it in place of the old ones.

        A day among `days` without staged rows becomes empty.
        """
        kept: tuple[Write, ...] = ()
        notes = staged.notes
        if days is not None:
            old = self.version(staged.based_on)
            gone = tuple(str(day) for day in days)
            kept = tuple(replace(w, without=tuple(sorted({*w.without, *gone}))) for w in old.writes)
            notes = old.notes | notes
        version = Version(staged.based_on + 1, staged.schema, (*kept, Write(staged.write)), notes)
        if version.number in self.numbers():
            raise Conflict(f"{self.path}: version {version.number} exists")
        try:
            self.files.create(self._file(version.number), json.dumps(asdict(version)))
        except Exception as error:
            if version.number in self.numbers():
                raise Conflict(f"{self.path}: version {version.number} exists") from error
            raise
        return version

    def replace(self, df: DataFrame, notes: dict | None = None) -> Version:
        return self.publish(self.stage(df, notes))

    def replace_days(self, df: DataFrame, days: list[dt.date | None], notes: dict | None = None) -> Version:
        """New rows for whole days; df holds rows of these days only."""
        return self.publish(self.stage(df, notes), days)

    def expire(self, keep: int = 2) -> None:
        """Forget all but the newest versions and the folders that only they name."""
        numbers = self.numbers()
        needed = {w.name for n in numbers[-keep:] for w in self.version(n).writes}
        for number in numbers[:-keep]:
            for write in self.version(number).writes:
                if write.name not in needed:
                    self.files.remove(f"{self.path}/{DATA}/{WRITE}={write.name}")
            self.files.remove(self._file(number))

    # --- reading ----------------------------------------------------------------
    def _stored(self, version: Version) -> DataFrame:
        """Rows with the folder columns; filters on them choose folders before a file is opened."""
        schema = StructType.fromJson(json.loads(version.schema))
        folders = [f"{self.path}/{DATA}/{WRITE}={w.name}" for w in version.writes]
        if not self.day:
            return self.spark.read.schema(schema).parquet(*folders)
        full = StructType([*schema.fields, StructField(WRITE, StringType()), StructField(self.day, DateType())])
        # an empty write has no folder for any day
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/{DATA}").parquet(*folders)

        def valid(write: Write) -> Column:
            here = F.col(WRITE) == write.name
            days = [dt.date.fromisoformat(d) for d in write.without if d != "None"]
            if days:
                here &= F.col(self.day).isNull() | ~F.col(self.day).isin(days)
            return here & F.col(self.day).isNotNull() if "None" in write.without else here

        if len(version.writes) == 1 and not version.writes[0].without:
            return rows
        return rows.filter(reduce(Column.__or__, map(valid, version.writes)))

    def read(self, number: int | None = None) -> DataFrame:
        """The columns as they were written; the frame stays with its version whatever is published later."""
        version = self.version(number)
        return self._stored(version).select(*StructType.fromJson(json.loads(version.schema)).names)

    def read_days(self, start: dt.date | None, end: dt.date | None, number: int | None = None) -> DataFrame:
        """Rows of the calendar days start..end; only their folders are opened."""
        version = self.version(number)
        rows = self._stored(version)
        if start is not None:
            rows = rows.filter(F.col(self.day) >= F.lit(start))
        if end is not None:
            rows = rows.filter(F.col(self.day) <= F.lit(end))
        return rows.select(*StructType.fromJson(json.loads(version.schema)).names)

    def read_staged(self, staged: Staged) -> DataFrame:
        """Staged rows, before they are published."""
        version = Version(0, staged.schema, (Write(staged.write),))
        return self._stored(version).select(*StructType.fromJson(json.loads(staged.schema)).names)

    def read_day_set(self, days: list[dt.date | None], number: int | None = None) -> DataFrame:
        """Rows of these calendar days, None for rows without one; only their folders are opened."""
        version = self.version(number)
        dated = [day for day in days if day is not None]
        wanted = F.col(self.day).isin(dated) if dated else F.lit(False)
        if None in days:
            wanted |= F.col(self.day).isNull()
        rows = self._stored(version).filter(wanted)
        return rows.select(*StructType.fromJson(json.loads(version.schema)).names)

    def read_days_of(self, days: DataFrame, number: int | None = None) -> DataFrame:
        """Rows of the days in a one-column table; Spark prunes the folders at run time."""
        version = self.version(number)
        wanted = days.select(F.to_date(days.columns[0]).alias(self.day)).distinct()
        rows = self._stored(version).join(wanted, self.day, "left_semi")
        return rows.select(*StructType.fromJson(json.loads(version.schema)).names)
