"""A keyed table on shared storage: versions of hash buckets, merged bucket by bucket.

Rows lie in hash buckets of the key, sorted by it, each bucket in a folder of its own. A
merge reads the buckets that its changes touch, writes them to fresh folders and then makes
the new version visible by one small file, put in place under a name that must not exist
yet. So readers see the old rows or the new ones, one that has planned before goes on with
the old ones, a merge that stops half-way leaves the table as it was, and of two writers at
once the second starts anew from what the first has made. What no version of the last
``grace`` seconds refers to is removed by later writers.

The number of buckets follows the rows by linear hashing: once there are more than
``bucket_rows`` rows a bucket, the next buckets in order are split, and only those are
rewritten. A get reads the buckets of its keys alone, and a few keys reach the scan as a
filter, for its statistics and Bloom filters.

A version holds the table's columns and definition too. Columns can be added later, or made
wider; rows written before have nulls there, or are widened when read.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn import store
from cairn.operators import mutate
from cairn.schema import WIDENING, ColumnDef, TableDef, type_name

#: Buckets of a small table, and rows of a bucket of a large one.
LEAST_BUCKETS, BUCKET_ROWS = 64, 2_000_000
#: Seconds that replaced rows stay readable, and times that a writer starts anew behind another.
GRACE, ATTEMPTS = 3600, 8
#: Seconds more after which a folder that no version refers to is taken for that of a writer that has stopped.
ABANDONED = 24 * 3600
#: Keys of a get that are given to the scan as a filter.
FEW_KEYS = 10


@dataclass(frozen=True)
class Version:
    """What the table is: ``at`` has for each bucket the place of its folder in ``folders``, or -1 where it has no rows;
    ``held`` is the number of buckets that were written to each folder, some of which may have been replaced since."""

    number: int
    start: int
    bucket_rows: int
    key: list[str]
    schema: dict
    folders: list[str] = field(default_factory=list)
    held: list[int] = field(default_factory=list)
    at: list[int] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    applied: dict[str, int] = field(default_factory=dict)
    definition: str | None = None

    @property
    def buckets(self) -> int:
        return len(self.at)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    def folder(self, bucket: int) -> str | None:
        return f"{self.folders[self.at[bucket]]}/_bucket={bucket}" if self.at[bucket] >= 0 else None

    def with_written(self, folder: str, counts: dict[int, int], touched: Sequence[int], buckets: int) -> Version:
        """The next version: the touched buckets come from ``folder``."""
        names, held = [*self.folders, folder], [*self.held, sum(n > 0 for n in counts.values())]
        at = [*self.at, *[-1] * (buckets - self.buckets)]
        rows = [*self.rows, *[0] * (buckets - self.buckets)]
        for b in touched:
            at[b], rows[b] = len(names) - 1 if counts.get(b) else -1, counts.get(b, 0)
        used = sorted({a for a in at if a >= 0})
        place = {a: k for k, a in enumerate(used)}
        return replace(self, number=self.number + 1, folders=[names[a] for a in used], held=[held[a] for a in used], at=[place[a] if a >= 0 else -1 for a in at], rows=rows)

    def places(self, buckets: Sequence[int] | None) -> tuple[list[str], list[str]]:
        """What to read for some buckets, or for all: the largest folder of which every bucket is wanted, and the other buckets one by one."""
        wanted = [b for b in (range(self.buckets) if buckets is None else buckets) if self.at[b] >= 0]
        count = Counter(self.at[b] for b in wanted)
        whole = max((a for a, n in count.items() if n == self.held[a]), key=lambda a: count[a], default=-1)
        return [self.folders[whole]] if whole >= 0 else [], [self.folder(b) for b in wanted if self.at[b] != whole]


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int | None = None, bucket_rows: int = BUCKET_ROWS, grace: float = GRACE) -> None:
        """``buckets``: those that ``create`` starts with; where the table exists it must be what it started with, or None."""
        self.spark, self.path, self.key, self._asked, self._bucket_rows, self.grace = spark, path.rstrip("/"), list(key), buckets, bucket_rows, grace

    # versions

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in store.names(self.spark, f"{self.path}/_versions") if n.endswith(".json"))

    def _file(self, number: int) -> str:
        return f"{self.path}/_versions/{number:010d}.json"

    def version(self, number: int | None = None) -> Version:
        """The newest version, or an older one that is still kept."""
        for _ in range(ATTEMPTS):
            numbers = self._numbers()
            if not numbers:
                raise ValueError(f"no keyed table at {self.path}")
            text = store.read_text(self.spark, self._file(numbers[-1] if number is None else number))
            if text is not None:
                found = Version(**json.loads(text))
                if self._asked not in (None, found.start):
                    raise ValueError(f"the table at {self.path} started with {found.start} buckets, not {self._asked}")
                return found
            if number is not None:
                break
        raise ValueError(f"no version {number} of the table at {self.path}")

    def _publish(self, version: Version) -> bool:
        """Make a version visible unless another writer has made one of that number."""
        return store.create(self.spark, self._file(version.number), json.dumps(asdict(version)))

    @property
    def buckets(self) -> int:
        """The number of buckets now."""
        return self.version().buckets

    def schema(self) -> T.StructType:
        return self.version().struct()

    def definition(self) -> TableDef:
        return TableDef.from_json(self.version().definition)

    # buckets

    def _bucket(self, version: Version, buckets: int | None = None) -> Column:
        """Linear hashing: modulo twice the largest power below the number of buckets, or that power where this bucket does not exist yet."""
        n = buckets or version.buckets
        low = version.start
        while 2 * low <= n:
            low *= 2
        types = {f.name: f.dataType for f in version.struct()}
        hashed = F.xxhash64(*[F.col(k).cast(types[k]) for k in self.key])
        wide = F.pmod(hashed, F.lit(2 * low))
        return F.when(wide < n, wide).otherwise(F.pmod(hashed, F.lit(low))).cast("int")

    @staticmethod
    def _parent(version: Version, bucket: int) -> int:
        """The bucket of this version from which a later one is split."""
        while bucket >= version.buckets:
            low = version.start
            while 2 * low <= bucket:
                low *= 2
            bucket -= low
        return bucket

    def _touched(self, rows: DataFrame, version: Version) -> list[int]:
        return sorted(r[0] for r in rows.select(self._bucket(version).alias("b")).distinct().collect())

    def _stored(self, version: Version, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of some buckets, or of all; only their folders are listed."""
        schema = version.struct()
        found = [self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in paths]).select(*[F.col(f"`{n}`") for n in schema.names]) for paths in version.places(buckets) if paths]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, version: Version, touched: Sequence[int], buckets: int) -> Version | None:
        """Write the touched buckets to a fresh folder and publish the version that refers to it; None if another writer was first."""
        folder = f"{version.number + 1:010d}-{uuid.uuid4().hex}"
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in version.struct()]
        out = rows.select(*columns, self._bucket(version, buckets).alias("_bucket")).repartition("_bucket").sortWithinPartitions("_bucket", *self.key)
        writer = out.write.partitionBy("_bucket")
        for k in self.key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer.parquet(f"{self.path}/{folder}")
        written = T.StructType([*version.struct(), T.StructField("_bucket", T.IntegerType())])
        counts = {r["_bucket"]: r["count"] for r in self.spark.read.schema(written).parquet(f"{self.path}/{folder}").groupBy("_bucket").count().collect()}
        made = version.with_written(folder, counts, touched, buckets)
        if self._publish(made):
            return made
        store.remove(self.spark, f"{self.path}/{folder}")
        return None

    # reading

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an older one that is still kept."""
        return self._stored(self.version(number))

    def get(self, keys: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """A row for each request, as ``scan.get``; only the buckets of the requested keys are read."""
        from cairn.operators.scan import get

        version = self.version()
        touched = self._touched(keys, version)
        rows = self._stored(version, touched)
        if len(touched) <= FEW_KEYS and len(few := keys.select(*self.key).distinct().limit(FEW_KEYS + 1).collect()) <= FEW_KEYS:
            for k in self.key:
                rows = rows.where(F.col(k).isin([r[k] for r in few]))
        return get(rows, keys, self.key, columns)

    # writing

    def create(self, rows: DataFrame, definition: TableDef | None = None) -> None:
        """Write the table anew; readers of an older one at this path go on with its rows."""
        buckets = self._asked or max(LEAST_BUCKETS, -(-rows.count() // self._bucket_rows))
        schema = json.loads(T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]).json())
        last = max(self._numbers(), default=-1)
        empty = Version(last, buckets, self._bucket_rows, self.key, schema, at=[-1] * buckets, rows=[0] * buckets, definition=definition.to_json() if definition else None)
        if not self._write(rows, empty, range(buckets), buckets):
            raise RuntimeError(f"another writer has changed the table at {self.path}")
        self.vacuum()

    def _evolved(self, version: Version, columns: Sequence[T.StructField]) -> Version:
        """The version with columns that it lacks, and with those made wider that may be; other types are an error."""
        known, wide, new = version.struct(), {}, []
        for f in columns:
            if f.name not in known.names:
                new.append(T.StructField(f.name, f.dataType))
                continue
            old = known[f.name].dataType
            if (old.simpleString(), f.dataType.simpleString()) in WIDENING and f.name not in self.key:
                wide[f.name] = f.dataType
            elif old != f.dataType and (f.dataType.simpleString(), old.simpleString()) not in WIDENING:
                raise ValueError(f"columns of another type: {[f.name]}")
        if not new and not wide:
            return version
        schema = T.StructType([*[T.StructField(f.name, wide.get(f.name, f.dataType)) for f in known], *new])
        return replace(version, schema=json.loads(schema.json()), definition=self._redefined(version, wide, new))

    @staticmethod
    def _redefined(version: Version, wide: dict[str, T.DataType], new: Sequence[T.StructField]) -> str | None:
        """The definition with the columns that are added or made wider."""
        if version.definition is None:
            return None
        told = TableDef.from_json(version.definition)
        for c in told.columns:
            c.type = type_name(wide[c.name]) if c.name in wide else c.type
        told.columns += [ColumnDef(f.name, type_name(f.dataType)) for f in new]
        return told.to_json()

    def add_columns(self, columns: Sequence[T.StructField]) -> None:
        """Add columns that the table lacks, or make columns wider; a column of the same name and another type is an error."""
        for _ in range(ATTEMPTS):
            version = self.version()
            made = self._evolved(version, columns)
            if made is version or self._publish(replace(made, number=version.number + 1)):
                return
        raise RuntimeError(f"other writers keep changing the table at {self.path}")

    def merge(self, changes: DataFrame, evolve: bool = False, once: tuple[str, int] | None = None, **how) -> None:
        """Apply a log of changes, as ``mutate.apply_mutations`` does.

        With ``evolve`` new and wider columns of the log become the table's. ``once`` names a writer and the number of its
        batch: a batch whose number is not above the writer's last one is left out, so a batch that comes again changes nothing.
        """
        extra = [f for f in changes.schema if f.name not in ("_seq", "_op", "_set")] if evolve else []
        self._rewrite(changes, lambda base: mutate.apply_mutations(base, changes, self.key, **how), extra, once)

    def check_and_put(self, changes: DataFrame, column: str, operator: str, value: str | None = None, null_as: str | None = None, once: tuple[str, int] | None = None) -> None:
        """``mutate.check_and_put``; a change with a null in the key, or a delete that compares a null of its own, is an error."""
        if value is None and operator in mutate.OPERATORS and column in changes.columns:
            changes = mutate.checked_log(changes, self.key, column, operator, value)
        self._rewrite(changes, lambda base: mutate.check_and_put(base, changes, self.key, column, operator, value, null_as), once=once)

    def expression_upsert(self, changes: DataFrame, set_: dict[str, str] | None = None, where: str | None = None, once: tuple[str, int] | None = None) -> None:
        self._rewrite(changes, lambda base: mutate.expression_upsert(base, changes, self.key, set_, where), once=once)

    def _rewrite(self, changes: DataFrame, apply: Callable[[DataFrame], DataFrame], extra: Sequence[T.StructField] = (), once: tuple[str, int] | None = None) -> None:
        for _ in range(ATTEMPTS):
            version = self.version()
            if once and version.applied.get(once[0], -1) >= once[1]:
                return
            evolved = self._evolved(version, extra)
            touched = self._touched(changes, version)
            if once:
                evolved = replace(evolved, applied={**version.applied, once[0]: once[1]})
            if not touched:
                if evolved is version or self._publish(replace(evolved, number=version.number + 1)):
                    return
                continue
            made = self._write(apply(self._stored(evolved, touched)), evolved, touched, version.buckets)
            if made:
                self._grow(made)
                self.vacuum()
                return
        raise RuntimeError(f"other writers keep changing the table at {self.path}")

    def _grow(self, version: Version) -> None:
        """Split as many buckets as the rows ask for; where another writer comes first, the next merge does it."""
        buckets = max(version.buckets, -(-sum(version.rows) // version.bucket_rows))
        if buckets > version.buckets:
            parents = sorted({self._parent(version, b) for b in range(version.buckets, buckets)})
            self._write(self._stored(version, parents), version, [*parents, *range(version.buckets, buckets)], buckets)

    def vacuum(self, grace: float | None = None) -> None:
        """Remove what no version has referred to for ``grace`` seconds: older versions' buckets, and folders that never became visible."""
        limit = store.now(self.spark) - 1000 * (self.grace if grace is None else grace)
        changed = store.modified(self.spark, f"{self.path}/_versions")
        numbers = self._numbers()
        old = [n for n, later in zip(numbers, numbers[1:], strict=False) if changed.get(f"{later:010d}.json", limit) < limit]
        read = lambda n: Version(**json.loads(store.read_text(self.spark, self._file(n)) or "null") or {"number": n, "start": 1, "bucket_rows": 1, "key": [], "schema": {}})
        if old:
            current = [read(n) for n in numbers[len(old) :]]
            kept, used = {f for v in current for b in range(v.buckets) if (f := v.folder(b))}, {name for v in current for name in v.folders}
            for n in old:
                v = read(n)
                for gone in (set(v.folders) - used) | {f for b in range(v.buckets) if (f := v.folder(b)) and f not in kept and f.partition("/")[0] in used}:
                    store.remove(self.spark, f"{self.path}/{gone}")
                store.remove(self.spark, self._file(n))
        stale = limit if grace is not None else limit - ABANDONED * 1000
        folders = {name: at for name, at in store.modified(self.spark, self.path).items() if name != "_versions" and at < stale}
        if folders:
            used = {name for n in self._numbers() for name in read(n).folders}
            for name in folders.keys() - used:
                store.remove(self.spark, f"{self.path}/{name}")


def overwrite_partition(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that the rows belong to, and no other."""
    df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(partition).parquet(path)
