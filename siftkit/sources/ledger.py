"""Tables replaced and appended by batch, with a commit ledger.

A load writes the rows of many batches in one partitioned job and only then
adds their numbers to the ledger. Readers take the batches that the ledger names, so
what a failed load left behind is never seen, and a repeated load writes only
what is missing. A replacing load starts a new generation; readers
see the last one, and the old one until the new one is committed. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import materialize

LEDGER = "generation int, load string, file string, batch string, n_rows long"
_WIDER = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "int"), ("tinyint", "bigint"),
          ("float", "double"), ("int", "double"), ("date", "timestamp")}


class SchemaMismatch(ValueError):
    """The rows do not fit the table's columns."""


class BatchLoaded(ValueError):
    """A batch of the append is in the table already."""


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name, in its order; types may widen without loss, nothing else is changed."""
    have = {f.name: f for f in df.schema.fields}
    missing, extra = [f.name for f in schema if f.name not in have], [c for c in have if c not in schema.names]
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unknown columns {extra}")
    for f in schema:
        a, b = have[f.name].dataType.simpleString(), f.dataType.simpleString()
        if a != b and (a, b) not in _WIDER:
            raise SchemaMismatch(f"column {f.name} is {a}, the table has {b}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


class BatchTable:
    """Rows of ``schema`` in batches named by ``batch_col``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, batch_col: str):
        self.spark, self.path, self.schema, self.batch_col = spark, path.rstrip("/"), schema, batch_col

    def _name(self) -> Column:
        """The batch of a row as a folder name that is never empty."""
        return F.coalesce(F.concat(F.lit("v"), F.col(self.batch_col).cast("string")), F.lit("null"))

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def ledger(self) -> DataFrame:
        """The committed batches of the last generation."""
        if not self._exists(f"{self.path}/ledger"):
            return self.spark.createDataFrame([], LEDGER)
        every = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")
        return every.where(F.col("generation") == every.select(F.max("generation")).scalar())

    def write(self, df: DataFrame, load: str) -> str:
        """Write the batches of a load in one job, not yet visible; returns the name to commit."""
        name = f"{load}-{uuid.uuid4().hex}"
        rows = conform(df, self.schema).withColumn("__batch", self._name())
        # rows of a batch are dealt over tasks by row, so a hot batch has no single writer
        rows.write.partitionBy("__batch").parquet(f"{self.path}/data/__file={name}")
        return name

    def commit(self, name: str, load: str, replace: bool = False, batches: DataFrame | None = None) -> None:
        """Add the written batches (or those listed in ``batches``) to the ledger, in one small write."""
        seen = self.ledger().agg(F.max("generation")).first()[0]
        generation = 0 if seen is None else seen + (1 if replace else 0)
        written = (self.spark.read.option("basePath", f"{self.path}/data").schema(self._stored_schema())
                   .parquet(f"{self.path}/data/__file={name}").groupBy("__batch").agg(F.count(F.lit(1)).alias("n_rows")))
        if batches is not None:
            written = written.join(batches.select(self._name().alias("__batch")).distinct(),
                                   "__batch", "left_semi")
        written.select(F.lit(generation).alias("generation"), F.lit(load).alias("load"), F.lit(name).alias("file"),
                       F.col("__batch").alias("batch"), "n_rows").write.mode("append").parquet(f"{self.path}/ledger")

    def _stored_schema(self) -> StructType:
        return StructType(list(self.schema.fields)).add("__file", "string").add("__batch", "string")

    def replace(self, df: DataFrame, load: str) -> None:
        """S3: create or replace. Readers see the old rows until the new ones are committed."""
        self.commit(self.write(df, load), load, replace=True)

    def append(self, df: DataFrame, load: str) -> None:
        """Append whole batches; refused, before anything is written, if one is loaded already."""
        rows = conform(df, self.schema)
        mine = rows.select(self._name().alias("batch")).distinct()
        again = mine.join(self.ledger(), "batch", "left_semi").first()
        if again is not None:
            raise BatchLoaded(f"batch {again['batch']} is loaded already")
        self.commit(self.write(rows, load), load)

    def missing(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose batches are not committed (a resumed load works on these)."""
        done = self.ledger().select(F.col("batch").alias("__done"))
        return df.join(done, self._name() == F.col("__done"), "left_anti")

    def resume(self, df: DataFrame, load: str) -> None:
        """Load what is missing. The missing rows are stored first, so the ledger is read once."""
        self.append(materialize(self.missing(df), "missing"), load)

    def read(self) -> DataFrame:
        """Committed rows with the load that brought them; the ledger prunes files and batches at run time."""
        ledger = self.ledger()
        if not self._exists(f"{self.path}/data"):
            return self.spark.createDataFrame([], StructType(list(self.schema.fields)).add("load", "string"))
        rows = self.spark.read.schema(self._stored_schema()).parquet(f"{self.path}/data")
        keys = ledger.select("load", F.col("file").alias("__file"), F.col("batch").alias("__batch"))
        return rows.join(keys, ["__file", "__batch"]).select(*self.schema.names, "load")


# ------------------------------------------------------------------ CSV
CSV_NULL = "\\N"
_CSV = {"quote": '"', "escape": '"', "nullValue": CSV_NULL, "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false", "header": "true", "lineSep": "\n"}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that reads back as it was: quotes doubled, line ends inside quotes, nulls as ``\\N``, empty strings as quotes."""
    df.write.options(**_CSV).option("emptyValue", '""').csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, rejected: str = "rejected") -> DataFrame:
    """Rows of :func:`write_csv` under ``schema``; a row that does not fit has its text in ``rejected`` (else null).

    Values with line ends make files unsplittable, so writers should keep files of a block's size.
    """
    full = StructType(list(schema.fields)).add(rejected, "string")
    return (spark.read.schema(full).options(**_CSV).option("emptyValue", "").option("multiLine", "true")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rejected).csv(path))
