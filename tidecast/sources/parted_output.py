"""Output in parts that can be written again, with a manifest that says what must be there.

A table lies in one folder per value of its part column (a run date, a day). Writing replaces
the parts that are written and leaves the others alone, so a repeated run leaves one copy. The
manifest holds, per part, the number of rows and the sums of some columns, and is written last:
a reader compares and refuses what it does not cover. A part without rows is one with 0 rows in
the manifest; files that an earlier run left for it are not read.

Manifest rows are few (one per part and run) and lie beside the data, in ``_manifest``, which
Spark skips when it reads the folder. One writer at a time is assumed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidecast.session import cut_lineage

# Sums of doubles differ in their last digits with the order of summation.
TOLERANCE = 1e-9


class IncompleteOutput(ValueError):
    """The files do not hold what the manifest says."""


def _manifest_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}/_manifest"


def _save(df: DataFrame, part: str, folder: str, kind: str, **options: str) -> None:
    # Rows of a part go together, and a large part is split: few files, no hot task.
    (
        df.hint("rebalance", part)
        .write.partitionBy(part)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .format(kind)
        .save(folder)
    )


def totals(df: DataFrame, part: str, sums: list[str]) -> DataFrame:
    """Rows, and sums of the named columns, per part. Sums are kept in one column as a map."""
    names = F.array(*[F.lit(s) for s in sums]) if sums else F.array().cast("array<string>")
    values = [F.coalesce(F.sum(F.col(s).cast("double")), F.lit(0.0)) for s in sums]
    added = F.array(*values) if sums else F.array().cast("array<double>")
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("n_rows"), F.map_from_arrays(names, added).alias("sums")
    )


def write_parts(
    df: DataFrame,
    folder: str,
    part: str,
    parts: list[date] | None = None,
    sums: list[str] = (),
    kind: str = "parquet",
    **options: str,
) -> DataFrame:
    """Write the parts of ``df`` in place of those there, then their manifest rows.

    ``parts`` names parts that this run answers for even where it has no rows for them. The
    rows are checkpointed first, so that data and manifest come from the same ones.
    """
    rows = cut_lineage(df)
    made = totals(rows, part, list(sums))
    if parts:
        kinds = f"{part} {rows.schema[part].dataType.simpleString()}"
        named = df.sparkSession.createDataFrame([(p,) for p in parts], kinds)
        nothing = F.expr("map()").cast("map<string, double>")
        made = named.join(made, part, "left").select(
            part,
            F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
            F.coalesce("sums", nothing).alias("sums"),
        ).unionByName(made.join(named, part, "left_anti"))
    # Few rows, each replaced by the next run of its part.
    made = cut_lineage(made.coalesce(1))
    _save(rows, part, folder, kind, **options)
    _save(made, part, _manifest_folder(folder), "parquet")
    return made


def read_manifest(spark: SparkSession, folder: str, part: str, part_type: str = "date") -> DataFrame:
    """(part, n_rows, sums) of everything written so far."""
    schema = f"n_rows long, sums map<string, double>, {part} {part_type}"
    return spark.read.schema(schema).parquet(_manifest_folder(folder))


def read_parts(
    spark: SparkSession,
    folder: str,
    part: str,
    schema: str,
    where: Column | None = None,
    check: bool = True,
    kind: str = "parquet",
    part_type: str = "date",
    **options: str,
) -> DataFrame:
    """The rows that the manifest covers; ``where`` is a condition on the part column.

    With ``check`` each part is counted and added up first, and one that differs from the
    manifest, or that the manifest does not know, raises ``IncompleteOutput``. Only parts that
    meet ``where`` are looked at.
    """
    manifest = read_manifest(spark, folder, part, part_type)
    data = spark.read.schema(f"{schema}, {part} {part_type}").options(**options).format(kind).load(folder)
    if where is not None:
        manifest, data = manifest.where(where), data.where(where)
    known = manifest.where("n_rows > 0").select(part)
    if check:
        wrong = differences(data, manifest, part)
        if wrong:
            raise IncompleteOutput(f"{folder}: {'; '.join(wrong)}")
    return data.join(known, part, "left_semi")


def differences(data: DataFrame, manifest: DataFrame, part: str) -> list[str]:
    """What is wrong with the parts, in words; the first few."""
    names = [r["name"] for r in manifest.select(F.explode(F.map_keys("sums")).alias("name")).distinct().collect()]
    there = totals(data, part, sorted(names)).withColumnsRenamed({"n_rows": "n_there", "sums": "sums_there"})
    emptied = (F.col("n_rows") == 0) & F.col("n_rows").isNotNull()
    far = F.exists(
        F.map_entries("sums"),
        lambda e: F.abs(F.element_at("sums_there", e["key"]) - e["value"])
        > TOLERANCE * F.greatest(F.abs(e["value"]), F.lit(1.0)),
    )
    what = (
        F.when(F.col("n_rows").isNull(), "not in the manifest")
        .when(F.coalesce("n_there", F.lit(0)) != F.col("n_rows"),
              F.concat(F.coalesce("n_there", F.lit(0)).cast("string"), F.lit(" rows instead of "), F.col("n_rows").cast("string")))
        .when(far, "other sums")
    )
    both = manifest.join(there, part, "full").where(~F.coalesce(emptied, F.lit(False)))
    wrong = both.select(part, what.alias("what")).where("what is not null").orderBy(part).limit(5)
    return [f"{r[part]}: {r['what']}" for r in wrong.collect()]
