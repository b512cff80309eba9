"""Wide exports: blank cells, one parse."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import csv as C


def test_blank_cells_read_as_their_parsers_say(spark):
    """cells that are skipped as blank get what the pattern-matching parser makes of a blank."""
    raw = spark.createDataFrame([("",), (None,), ("  ",), ("7",), ("��",)], "v string")
    for parser, parse in C._PARSERS.items():
        got = raw.select(C.parse_value(F.col("v"), parser, "runs").alias("a"), parse(F.regexp_replace(F.coalesce("v", F.lit("")), "\\x{FFFD}+", "?")).alias("b"))
        assert got.where("NOT (a <=> b)").count() == 0, parser


def test_an_export_is_parsed_once(spark, tmp_path, monkeypatch):
    """items, headers and marks are made from stored typed rows, not from the text again."""
    from tidemark.plans import jobs as J
    from tidemark.sources.specs import TRANSACTIONS
    names = [n for n, _, _ in TRANSACTIONS.columns]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + "\n".join(f"t{k},i{k},b" + "," * (len(names) - 3) for k in range(5)) + "\n")
    seen, land = [], J.land_transactions
    monkeypatch.setattr(J, "land_transactions", lambda spark, rows, *a, **k: seen.append(rows) or land(spark, rows, *a, **k))
    J.transactions_import(spark, str(tmp_path), scratch_path(spark, "t-hub"), "r1", dt.date(2024, 1, 1))
    assert "regexp" not in seen[0]._jdf.queryExecution().optimizedPlan().toString().lower() and seen[0].count() == 5
