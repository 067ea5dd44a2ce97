"""What the jobs share: the command line, settings, logs, and where registered runs put their files."""

from __future__ import annotations

import argparse
import json
import logging
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spatialfeat.shipping import ship

HERE = Path(__file__).resolve().parent


def settings(name: str, own: str | None = None, **over) -> dict:
    """The job's own config file, with those of another one and single settings in their place; unknown names are an error."""
    found = json.loads((HERE / f"{name}.json").read_text(encoding="utf-8"))
    given = (json.loads(Path(own).read_text(encoding="utf-8")) if own else {}) | over
    if unknown := sorted(set(given) - set(found)):
        raise KeyError(f"no such settings: {unknown}")
    return found | given


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table by its path; the ending names the format, Parquet where it is none of them."""
    ending = path.rstrip("/").rpartition(".")[2].lower()
    return spark.read.format(ending if ending in ("orc", "json", "csv") else "parquet").load(path)


def mapped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The columns of a job from SQL expressions over a table."""
    return df.select(*(F.expr(e).alias(c) for c, e in columns.items()))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder below spark.checkpoint.dir that nothing else has; where that is unset, in a session on one machine, below a folder of its own."""
    sc = spark.sparkContext
    place = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not place:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        place = tempfile.mkdtemp(prefix="spatialfeat-")
        sc.setCheckpointDir(place)
    return f"{place.rstrip('/')}/jobs/{name}-{uuid.uuid4().hex}"


def main(name: str, run: Callable, arguments: list[str]) -> None:
    """python -m jobs.NAME INPUT OUTPUT [--config FILE]"""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}")
    parser.add_argument("input", help="path of the table to read; any file system that Spark knows")
    parser.add_argument("output", help="folder to write to")
    parser.add_argument("--config", help="JSON file whose settings replace those of the job's own")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        ship(spark)
        run(spark, given.input, given.output, settings(name, given.config))
    finally:
        spark.stop()
