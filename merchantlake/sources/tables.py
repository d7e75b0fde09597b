"""Reading and writing tables."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantlake import contract as C
from merchantlake.operators.reuse import store
from merchantlake.sources import publish

#: Formats whose tables are plain folders of files. Others replace their tables by themselves.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text")


class StorageError(RuntimeError):
    """A layer table could not be opened."""


class DataQualityError(ValueError):
    """A table breaks a quality limit."""


class Gate:
    """A limit for the share of nulls of some columns, counted while a table is written: no scan of its own.

    An empty table passes. Columns the table does not have are an error.
    """

    def __init__(self, columns: tuple[str, ...] | list[str], limit: float = C.MAX_NULL_RATIO, label: str = ""):
        self.columns, self.limit, self.label = list(columns), limit, label
        self._watched: DataFrame | None = None
        self._seen: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, whose rows are counted by the action that comes next."""
        self._seen = Observation()
        nulls = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(self.columns)]
        self._watched = df.observe(self._seen, F.count(F.lit(1)).alias("n"), *nulls)
        return self._watched

    def count(self) -> None:
        """Count now, for tables that cannot be judged after they were written."""
        self._watched.write.format("noop").mode("overwrite").save()

    def ratios(self) -> dict[str, float]:
        counts = self._seen.get
        return {c: counts[f"n{i}"] / counts["n"] if counts["n"] else 0.0 for i, c in enumerate(self.columns)}

    def check(self) -> None:
        bad = {c: r for c, r in self.ratios().items() if r > self.limit}
        if bad:
            text = ", ".join(f"column {c} null ratio {r:.4f}" for c, r in bad.items())
            raise DataQualityError(f"{self.label}: {text} exceeds {self.limit}")


def read_transactions(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet folder, file or glob; several are read as one table by column names. Sub-folders may name a partition."""
    frames = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_merchants(spark: SparkSession, path: str, schema: T.StructType | None = C.MERCHANTS) -> DataFrame:
    """CSV with a header, as ``read_csv`` types it; ``schema=None`` infers."""
    if schema is None:
        return _csv(spark).option("inferSchema", True).csv(path)
    return read_csv(spark, path, schema)[0]


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("positiveInf", "inf").option("negativeInf", "-inf")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """A CSV table, and findings about values that do not fit its schema. The file is read once.

    Columns are matched by name and typed by ``schema``; declared types make ``inf`` a number. The pass that reads the file
    stores every value as it is and counts, beside it, the values that a declared type cannot hold. A column with such
    values is widened, from whole numbers to doubles or else to text, when the stored rows are read: no value is lost.
    Columns the schema does not know are text. Findings: column_name, declared, n_misfits, kept_as and first_misfit.
    """
    text = _csv(spark).csv(path)
    declared = {f.name: f.dataType for f in schema.fields if f.name in text.columns and f.dataType != T.StringType()}

    def misfit(column: str, kind: T.DataType | str) -> Column:
        return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()

    seen = Observation()
    if declared:
        counts = {f"{what}{i}": F.count_if(misfit(c, kind)) for i, (c, k) in enumerate(declared.items()) for what, kind in (("declared", k), ("double", "double"))}
        firsts = {f"first{i}": F.min(F.when(misfit(c, k), F.col(c))) for i, (c, k) in enumerate(declared.items())}
        text = text.observe(seen, *[x.alias(name) for name, x in {**counts, **firsts}.items()])
    stored = store(text, "csv")
    found = seen.get if declared else {}
    kinds, findings = {}, []
    for i, (c, kind) in enumerate(declared.items()):
        if found[f"declared{i}"]:
            kinds[c] = T.StringType() if found[f"double{i}"] else T.DoubleType()
            findings.append((c, kind.simpleString(), found[f"declared{i}"], kinds[c].simpleString(), found[f"first{i}"]))
        else:
            kinds[c] = kind
    typed = stored.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()}) if kinds else stored
    return typed, spark.createDataFrame(findings, "column_name string, declared string, n_misfits bigint, kept_as string, first_misfit string")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer table; one that a killed run left beside its place is put there first."""
    if fmt in FILE_FORMATS:
        folders = publish.Folders(spark)
        if publish.needs_recovery(folders, path):
            publish.recover(folders, path)
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as failure:
        raise StorageError(f"cannot read the table at {path}") from failure


def write_table(
    df: DataFrame, path: str, *, small: bool = False, partition_by: tuple[str, ...] = (), fmt: str = "parquet",
    cluster_by: tuple[str | Column, ...] = (), gate: Gate | None = None,
) -> None:
    """Replace the table at ``path``, whole or not at all.

    ``small`` results, bounded by their meaning, get one file. ``cluster_by`` sorts rows into ranges, for readers that filter.
    ``gate`` is judged on what the write counts as it passes; a table that fails is not published.
    """
    if cluster_by:
        df = publish.clustered(df, cluster_by)
    if gate:
        df = gate.watch(df)
    frame = df.coalesce(1) if small else df

    def write(target: str) -> None:
        writer = frame.write.mode("overwrite").format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(target)

    if fmt in FILE_FORMATS:
        publish.replace_table(df.sparkSession, path, write, gate and gate.check)
    else:
        # Such a table keeps its versions: it is judged before it is written.
        if gate:
            gate.count()
            gate.check()
        write(path)


def write_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...], *, only: list[dict] | None = None, fmt: str = "parquet",
    cluster_by: tuple[str | Column, ...] = (), gate: Gate | None = None,
) -> list[str]:
    """Replace the partitions that ``df`` has rows of, each whole or not at all, and leave the others alone.

    ``only`` names partitions that ``df`` stands for; those without rows go. Returns the folders that were replaced.
    """
    if fmt not in FILE_FORMATS:
        raise ValueError(f"partitions are replaced one by one in {FILE_FORMATS} only, not in {fmt}")
    frame = publish.clustered(df, (*partition_by, *cluster_by))
    frame = gate.watch(frame) if gate else frame

    def write(target: str) -> None:
        frame.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(target)

    wanted = None if only is None else [publish.partition_folder(**values) for values in only]
    return publish.replace_partitions(df.sparkSession, path, len(partition_by), write, wanted, gate and gate.check)


def write_report(df: DataFrame, path: str, fmt: str) -> None:
    """CSV (with header, text as it is) or JSON for people and tools outside Spark."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.save(path)


def with_lineage(df: DataFrame, source: str, ingested_at: str | None = None, by_file: bool = False) -> DataFrame:
    """When (ISO-8601, UTC, fixed once per run) and from where the rows came: ``source``, or the file of each row."""
    stamp = ingested_at or datetime.now(timezone.utc).isoformat()
    origin = F.col("_metadata.file_path") if by_file else F.lit(source)
    return df.withColumns({"_ingested_at": F.lit(stamp), "_bronze_source": origin})
