"""CSV sink for the reviews feed (K1) and per-run archive layout (K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import date_text
from .specs import FeedSpec


def as_csv_text(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Render every spec column as text the reader round-trips:
    dates ``yyyy-MM-dd`` (NULL -> ''), booleans ``true``/``false``,
    integers in decimal, NULL text -> ''."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for csv_name, _, target in spec.columns:
        t = types.get(target)
        c = F.col(target)
        if isinstance(t, T.DateType):
            c = date_text(c)
        elif t is None:
            c = F.lit("")
        else:
            c = F.coalesce(c.cast("string"), F.lit(""))
        cols.append(c.alias(csv_name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, spec: FeedSpec, mode: str = "overwrite") -> None:
    """Header line + RFC 4180 quoting (quotes doubled), empty fields unquoted."""
    out = as_csv_text(df, spec)
    w = (out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
         .option("quoteAll", False).option("emptyValue", "").option("nullValue", ""))
    w.csv(path)


def archive(df: DataFrame, root: str, spec: FeedSpec, run_tag: str, branch: str = "branch_id") -> None:
    """Write a run's rows under ``<root>/archive_branch=<b>/run=<tag>/`` so a later
    bootstrap (recursive read) replays every archived run. A retried run replaces the
    folders that it writes, and no others."""
    out = as_csv_text(df, spec).withColumn("archive_branch", F.col(branch)).withColumn("run", F.lit(run_tag))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("archive_branch", "run")
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("emptyValue", "").option("nullValue", "").csv(root))
