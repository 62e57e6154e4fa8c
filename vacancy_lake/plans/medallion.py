"""The whole run: raw records to Silver, quality gate, Gold, and a row that tells how it went."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import is_blank
from ..operators import gold, ingest, quality, silver
from ..sources import io

#: Columns whose blank values are counted as Silver is written.
COUNTED_BLANKS = ("title", "company", "location_clean", "normalized_role", "deadline")
#: A row for each run.  ``rejected_by`` and ``blanks`` map a reason or column to its rows.
RUN = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("started", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("exit_code", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("good", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("rejected_by", T.MapType(T.StringType(), T.LongType())),
        T.StructField("blanks", T.MapType(T.StringType(), T.LongType())),
    ]
)


@dataclass
class Run:
    silver: DataFrame
    results: DataFrame
    exit_code: int
    gold: dict[str, DataFrame] | None
    counts: dict = field(default_factory=dict)


def observed(checked: DataFrame, seen: Observation) -> DataFrame:
    """``checked`` counting its rows, rejected rows by reason, and blanks of good rows as it is written."""
    good = F.col("reject_reason").isNull()
    blank = {c: is_blank(F.col(c)) for c in COUNTED_BLANKS}
    return checked.observe(
        seen,
        F.count("*").alias("rows"),
        F.count_if(good).alias("good"),
        *[F.count_if(F.col("reject_reason") == r).alias(f"r{k}") for k, r in enumerate(silver.REASONS)],
        *[F.count_if(good & b).alias(f"b{k}") for k, b in enumerate(blank.values())],
    )


def counts_of(seen: Observation) -> dict:
    found = seen.get
    return {
        "rows": found["rows"],
        "good": found["good"],
        "rejected": found["rows"] - found["good"],
        "rejected_by": {r: found[f"r{k}"] for k, r in enumerate(silver.REASONS)},
        "blanks": {c: found[f"b{k}"] for k, c in enumerate(COUNTED_BLANKS)},
    }


def runs(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all runs that wrote below ``out``."""
    return spark.read.schema(RUN).parquet(f"{out}/runs")


def run(
    listed: DataFrame,
    detail: DataFrame,
    text: DataFrame,
    out: str,
    as_of: Column | None = None,
    stop_on_error: bool = True,
) -> Run:
    """Merges the three sources, writes Silver and rejects, checks the written table and, if the gate
    lets it through or ``stop_on_error`` is false, writes Gold.

    Good and rejected rows are counted in the pass that writes them.  A row about the run is appended to
    ``runs``, also when it fails; its status is ``success``, ``stopped`` by the gate, or ``failed``.
    """
    spark = listed.sparkSession
    about = {"run": uuid.uuid4().hex, "started": time.time(), "status": "failed", "exit_code": 1}
    try:
        done = _run(listed, detail, text, out, as_of, stop_on_error, about)
        about |= {"status": "success" if done.gold is not None else "stopped", "exit_code": done.exit_code}
        return done
    except Exception as e:
        about["error"] = f"{type(e).__name__}: {e}"[:1000]
        raise
    finally:
        about["seconds"] = time.time() - about["started"]
        spark.createDataFrame([tuple(about.get(n) for n in RUN.names)], RUN).coalesce(1).write.mode("append").parquet(f"{out}/runs")


def _run(listed: DataFrame, detail: DataFrame, text: DataFrame, out: str, as_of: Column | None, stop_on_error: bool, about: dict) -> Run:
    spark, seen = listed.sparkSession, Observation()
    merged = ingest.fill_defaults(ingest.merge_sources(listed, detail, text))
    # One pass: good and rejected rows go to folders of one table, and everything after reads those.
    checked = observed(silver.normalised(merged), seen).withColumn("rejected", F.col("reject_reason").isNotNull())
    checked.write.mode("overwrite").partitionBy("rejected").parquet(f"{out}/silver.parquet")
    counts = counts_of(seen)
    about |= counts
    written = spark.read.schema(checked.schema).parquet(f"{out}/silver.parquet")
    written.filter("rejected").drop("rejected").write.mode("overwrite").parquet(f"{out}/rejects.parquet")
    table = written.filter("NOT rejected").select(*schemas.SILVER.names)
    if not counts["good"]:
        raise ValueError("no good record")
    results = quality.run_stages(table, quality.stages(as_of if as_of is not None else F.current_timestamp()))
    code = quality.gate(results).first().exit_code
    if code and stop_on_error:
        return Run(table, results, code, None, counts)
    tables = gold.build_gold(table)
    io.write_gold(tables, f"{out}/gold")
    return Run(table, results, code, tables, counts)
