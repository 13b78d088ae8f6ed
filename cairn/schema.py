"""Table definitions, the type map, write-time widening and DDL."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Warehouse type names and the Spark types that hold them.
SCALARS: dict[str, T.DataType] = {
    "smallint": T.ShortType(), "int2": T.ShortType(), "tinyint": T.ShortType(), "smallserial": T.ShortType(),
    "int": T.IntegerType(), "int4": T.IntegerType(), "integer": T.IntegerType(), "serial": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(), "bigserial": T.LongType(),
    "float4": T.FloatType(), "real": T.FloatType(), "float8": T.DoubleType(), "double precision": T.DoubleType(),
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(), "date": T.DateType(),
    "bytea": T.BinaryType(), "roaringbitmap": T.BinaryType(),
    "text": T.StringType(), "varchar": T.StringType(), "char": T.StringType(), "json": T.StringType(), "jsonb": T.StringType(),
    "time": T.StringType(), "timetz": T.StringType(), "interval": T.StringType(), "inet": T.StringType(), "oid": T.StringType(),
    "uuid": T.StringType(), "bit": T.StringType(), "varbit": T.StringType(), "geography": T.StringType(), "geometry": T.StringType(),
}
ARRAYS = ("int4", "int8", "float4", "float8", "bool", "text", "int", "bigint", "boolean")
SERIAL = ("smallserial", "serial", "bigserial")
#: Casts that a write may make when types differ and strict checking is off; any scalar may become text.
WIDENING = {("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double")}


def spark_type(name: str) -> T.DataType:
    """The Spark type of a warehouse type name such as ``numeric(10,2)`` or ``int4[]``."""
    low = name.strip().lower()
    if low.endswith("[]") or low.startswith("_"):
        inner = low[:-2] if low.endswith("[]") else low[1:]
        if inner not in ARRAYS:
            raise ValueError(f"arrays of {inner} are not supported")
        return T.ArrayType(SCALARS[inner])
    if found := re.fullmatch(r"(?:numeric|decimal)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?", low):
        return T.DecimalType(int(found[1] or 38), int(found[2] or (0 if found[1] else 18)))
    base = re.sub(r"\s*\(.*\)", "", low)
    if base not in SCALARS:
        raise ValueError(f"type {name} is not supported")
    return SCALARS[base]


#: The warehouse type that a column gets which a table gains from its data.
_NAMES = {
    "smallint": "smallint", "int": "int", "bigint": "bigint", "float": "float4", "double": "float8", "boolean": "bool", "string": "text",
    "binary": "bytea", "date": "date", "timestamp": "timestamptz", "timestamp_ntz": "timestamp",
}


def type_name(kind: T.DataType) -> str:
    """The warehouse type name of a Spark type; the inverse of ``spark_type`` for the types that columns have."""
    if isinstance(kind, T.ArrayType):
        name = ({"int": "int4", "bigint": "int8"}.get(kind.elementType.simpleString()) or type_name(kind.elementType)) + "[]"
        spark_type(name)  # an error where there are no arrays of it
        return name
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    if kind.simpleString() not in _NAMES:
        raise ValueError(f"type {kind.simpleString()} is not supported")
    return _NAMES[kind.simpleString()]


@dataclass
class ColumnDef:
    name: str
    type: str
    nullable: bool = True
    default: str | None = None
    generated: bool = False
    comment: str | None = None

    @property
    def is_serial(self) -> bool:
        return self.type.lower() in SERIAL

    @property
    def length(self) -> int | None:
        found = re.fullmatch(r"(?:var)?char\s*\((\d+)\)", self.type.strip().lower())
        return int(found[1]) if found else None


@dataclass
class TableDef:
    """What a table is: columns, keys and layout."""

    name: str
    columns: list[ColumnDef]
    primary_key: list[str] = field(default_factory=list)
    distribution_key: list[str] = field(default_factory=list)
    clustering_key: list[str] = field(default_factory=list)
    partition_column: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    comment: str | None = None

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError("a column name appears twice")
        for key in (self.primary_key, self.distribution_key, [re.sub(r":(asc|desc)$", "", k) for k in self.clustering_key], [self.partition_column] if self.partition_column else []):
            if missing := [k for k in key if k not in names]:
                raise ValueError(f"no such columns: {missing}")
        if nullable := [c.name for c in self.columns if c.name in self.primary_key and c.nullable]:
            raise ValueError(f"primary key columns must not be null: {nullable}")
        if self.partition_column and self.primary_key and self.partition_column not in self.primary_key:
            raise ValueError("the partition column must be part of the primary key")

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, spark_type(c.type), c.nullable, {"comment": c.comment} if c.comment else None) for c in self.columns])

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> TableDef:
        raw = json.loads(text)
        return cls(**raw | {"columns": [ColumnDef(**c) for c in raw["columns"]]})

    def ddl(self, using: str = "parquet") -> str:
        """CREATE TABLE with partitioning, comments and properties; keys are kept as properties."""
        tick = lambda n: "`" + n.replace("`", "``") + "`"
        text = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
        columns = ", ".join(
            f"{tick(c.name)} {spark_type(c.type).simpleString()}{'' if c.nullable else ' NOT NULL'}{f' COMMENT {text(c.comment)}' if c.comment else ''}" for c in self.columns)
        properties = {"primary_key": ",".join(self.primary_key), "distribution_key": ",".join(self.distribution_key), "clustering_key": ",".join(self.clustering_key)} | self.properties
        shown = ", ".join(f"{text(k)} = {text(v)}" for k, v in properties.items() if v)
        return (
            f"CREATE TABLE {'.'.join(map(tick, self.name.split('.')))} ({columns}) USING {using}"
            + (f" PARTITIONED BY ({tick(self.partition_column)})" if self.partition_column else "")
            + (f" COMMENT {text(self.comment)}" if self.comment else "") + (f" TBLPROPERTIES ({shown})" if shown else ""))


def widen(df: DataFrame, target: T.StructType, strict: bool = False) -> DataFrame:
    """Cast the columns of a frame to a table's types where the rules of a write allow it."""
    have = dict(df.dtypes)
    out: list[Column] = []
    for f in target:
        if f.name not in have:
            raise ValueError(f"column {f.name} is missing")
        source, wanted = have[f.name], f.dataType.simpleString()
        scalar = not source.startswith(("array", "struct", "map", "binary"))
        if source != wanted and (strict or not ((source, wanted) in WIDENING or wanted == "string" and scalar)):
            raise TypeError(f"column {f.name}: {source} cannot be written as {wanted}")
        out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    return df.select(out)
