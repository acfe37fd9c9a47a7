"""Helpers shared by the text operators (nothing outside ``llm`` imports this package)."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.session import materialize

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
# A side whose rows are counted or whose size is fixed by a parameter is broadcast up to this size.
BROADCAST_BYTES = 64 << 20


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable for the session's Python workers, once a session.

    The maps of the operators are pickled by reference, so that workers keep their caches between tasks.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import periodlens
    root = Path(periodlens.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="periodlens-")) / "periodlens.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other code point stays as it is."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table, and a plan that uses it twice does not
    compute it twice.
    """
    return materialize(df, name)
