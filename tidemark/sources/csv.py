"""Lenient CSV feeds (S1-S6, P4, P5, A12): header-bound, whole-file quarantine.

One distributed pass reads every file with an explicit all-string schema
(``multiLine`` for quoted newlines, doubled-quote escapes, PERMISSIVE with a
corrupt-record column) and stages the raw records to Parquet under the
checkpoint root, so the CSV is parsed once and row ids are stable:

* the first record of each file is its header; names are lower-cased and
  trimmed, a repeated name binds to its last position, a missing column
  reads as blank -- files with different column orders or sets are bound by
  name, never by position;
* a record whose field count differs from its header's makes the whole file
  bad; bad files (and files with no header) are quarantined, the others load;
* ``seq = (file path, record id)`` gives the sequential file order used by
  the newest-wins tie rules.

No file list, header or row passes through the driver; the only driver-side
value is the widest header seen (to widen the staging schema if needed).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators.joins import join_small
from ..session import reliable_checkpoint, scratch_path
from .specs import FeedSpec

DEFAULT_WIDTH = 64
# Files above this size are read by many tasks (see :func:`parallel_records`), others by one each.
LARGE_FILE = 128 << 20
# Files above this size too, where they are so few that most tasks would wait for them.
LARGE_OF_FEW = 32 << 20
# Bytes of large files for a task that orders their lines or joins those of a record.
PART_BYTES = 8 << 20
# Records of a staged file.
STAGED_ROWS = 100_000
# Most lines of one record in a large file; a file with a longer one has a stray quote.
MAX_RECORD_LINES = 10_000
# A record whose quotes stand around whole fields only (doubled inside), so that the
# parity of quotes tells which line breaks are inside a field.
_REGULAR_RE = r'^(?:"[^"]*+(?:""[^"]*+)*+"|[^",\r\n]*+)(?:,(?:"[^"]*+(?:""[^"]*+)*+"|[^",\r\n]*+))*+$'
# Matches one quoted field (doubled quotes inside) without backtracking.
_QUOTED_RE = r'"[^"]*+(?:""[^"]*+)*+"'


@dataclass
class CsvBatch:
    rows: DataFrame  # typed rows of good files, with _file and _row
    bad_files: DataFrame  # _file, reason
    files: DataFrame  # _file, n_records, header_width, ok


def raw_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)]
                        + [T.StructField("_corrupt", T.StringType())])


def csv_options(reader, width: int, glob: str | None, quoted_newlines: bool = True):
    """All-string CSV reader. ``quoted_newlines=False`` (feeds known to have
    no line breaks inside quotes) lets Spark split large files across tasks;
    the default parses a file as a whole (one task per file)."""
    r = (reader.schema(raw_schema(width))
         .option("header", False).option("multiLine", quoted_newlines)
         .option("quote", '"').option("escape", '"')
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
         .option("encoding", "UTF-8").option("recursiveFileLookup", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("maxColumns", max(20480, 2 * width)))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r


def records(df: DataFrame, width: int, with_ids: bool = True) -> DataFrame:
    """Raw scan -> ``_file, _rid, _f (array of fields), _corrupt``.

    ``_rid = (split start offset, row id)`` orders the records of a file: a
    split is read sequentially by one task, and splits of a file order by
    their start offset. Streaming sources add it per micro-batch
    (``with_ids=False`` here, :func:`with_record_ids` later).
    """
    out = df.select(F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_blk"),
                    F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("_f"),
                    "_corrupt")
    return with_record_ids(out) if with_ids else out


def with_record_ids(recs: DataFrame) -> DataFrame:
    rid = F.struct(F.col("_blk").alias("blk"), F.monotonically_increasing_id().alias("row"))
    return recs.withColumn("_rid", rid).drop("_blk")


def _raw_scan(spark: SparkSession, path, width: int, glob: str | None, quoted_newlines: bool = True, at_most: int | None = None) -> DataFrame:
    """Records of the files, or of those of ``at_most`` bytes (the listing leaves the others out)."""
    paths = [path] if isinstance(path, str) else list(path)
    scan = csv_options(spark.read, width, glob, quoted_newlines).csv(paths)
    return records(scan if at_most is None else scan.where(F.col("_metadata.file_size") <= at_most), width)


def _field_count(width: int) -> Column:
    """Fields of a record: the schema width when it parsed cleanly, otherwise
    counted from the raw text (commas outside quoted fields + 1)."""
    stripped = F.regexp_replace(F.col("_corrupt"), _QUOTED_RE, "")
    return F.when(F.col("_corrupt").isNull(), F.lit(width)).otherwise(
        F.size(F.split(stripped, ",")))


def stage_records(spark: SparkSession, recs: DataFrame) -> DataFrame:
    """Persist raw records once (Parquet under the checkpoint root): the CSV is
    parsed a single time, row ids become stable, and lineage is cut. A task that reads one
    long file writes several, so that what follows has a task for each."""
    out = scratch_path(spark, "csv-stage")
    recs.write.option("maxRecordsPerFile", STAGED_ROWS).parquet(out)
    return spark.read.parquet(out)


def file_table(staged: DataFrame, width: int) -> DataFrame:
    """One row per file from a single aggregate over the staged records:
    header record id and fields, header width, record count, and whether every
    record has the header's field count. Checkpointed (small: one row per
    file) so the widest-header check, the quarantine and the header binding
    all reuse it without another pass over the records."""
    rec = staged.select("_file", "_rid", "_f", _field_count(width).alias("_n"))
    t = rec.groupBy("_file").agg(
        F.min("_rid").alias("_hdr_rid"), F.min_by("_f", "_rid").alias("_h"),
        F.min_by("_n", "_rid").alias("header_width"), F.count(F.lit(1)).alias("n_records"),
        F.min("_n").alias("_min_n"), F.max("_n").alias("_max_n"))
    ok = (F.col("_min_n") == F.col("header_width")) & (F.col("_max_n") == F.col("header_width"))
    return reliable_checkpoint(t.select("_file", "_hdr_rid", "_h", "header_width", "n_records", ok.alias("ok")))


def _listed(spark: SparkSession, path, glob: str | None) -> DataFrame:
    """(path, length) of the files."""
    paths = [path] if isinstance(path, str) else list(path)
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(paths).select("path", "length")


def large_size(spark: SparkSession, path, glob: str | None, size: int) -> int:
    """The size above which a file is read by many tasks: ``size``, or less where a file takes over
    twice a core's share of all bytes and the others would wait for its one task."""
    share = (_listed(spark, path, glob).agg(F.sum("length")).first()[0] or 0) // spark.sparkContext.defaultParallelism
    return min(size, max(LARGE_OF_FEW, 2 * share))


def large_files(spark: SparkSession, path, glob: str | None, size: int) -> list[str]:
    """Files above ``size``, from a listing alone; there are few of them by their size."""
    return sorted(x[0] for x in _listed(spark, path, glob).where(F.col("length") > size).select("path").collect())


def _parts(spark: SparkSession, files: Sequence[str]) -> int:
    """Tasks for the lines of ``files``: one for each ``PART_BYTES``."""
    size = spark.read.format("binaryFile").load(list(files)).agg(F.sum("length")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))


def _joined_lines(spark: SparkSession, files: Sequence[str], lines: DataFrame, ending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of lines of which some have an odd number of quotes, and the files with a record that
    is never closed or too long."""
    # tasks grow with the files, so that none holds more of them as they grow; a split is in one task
    parts = _parts(spark, files)
    lines = lines.repartition(parts, "_file", "blk")

    split = Window.partitionBy("_file", "blk").orderBy("row")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("_file").orderBy("blk")
    # one row per split
    splits = lines.groupBy("_file", "blk").agg(F.sum("odd").alias("odds"))
    carried = splits.withColumn("carry", F.coalesce(F.sum("odds").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)
    told = join_small(lines, carried.select("_file", "blk", "carry"), on=["_file", "blk"], how="inner")
    starts = (F.coalesce(F.sum("odd").over(before), F.lit(0)) + F.col("carry")) % 2 == 0
    told = told.withColumn("start", F.when(starts, F.struct("blk", "row")))
    told = told.withColumn("rid", F.last("start", ignorenulls=True).over(split))
    # a split may begin within a record of an earlier one
    last = told.groupBy("_file", "blk").agg(F.max("start").alias("s"))
    last = last.withColumn("earlier", F.last("s", ignorenulls=True).over(file.rowsBetween(Window.unboundedPreceding, -1)))
    told = join_small(told, last.select("_file", "blk", "earlier"), on=["_file", "blk"], how="inner")
    told = told.withColumn("rid", F.coalesce("rid", "earlier"))
    told = join_small(told, ending, on="_file", how="inner").withColumn("final", F.struct("blk", "row") == F.col("last"))
    ends = (F.col("odd") == 0) == F.col("start").isNotNull()  # the record ends with this line
    whole = told.where(F.col("start").isNotNull() & ends).select("_file", "rid", "line", "crlf", "final")
    pieces = told.where(~(F.col("start").isNotNull() & ends)).repartition(parts, "_file", "rid")
    sizes = pieces.groupBy("_file", "rid").agg(F.count("*").alias("n"), F.max(F.struct("blk", "row", ends.alias("ends"))).alias("end"))
    sizes = sizes.withColumn("closed", F.col("end.ends")).select("_file", "rid", "n", "closed")
    kept = sizes.where((F.col("n") <= MAX_RECORD_LINES) & F.col("closed"))
    joined = (pieces.join(kept, on=["_file", "rid"], how="inner").groupBy("_file", "rid", "crlf")
              .agg(F.max("final").alias("final"), F.array_sort(F.collect_list(F.struct("blk", "row", "line"))).alias("l")))
    joined = joined.select("_file", "rid", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("line"), "crlf", "final")
    unclosed = sizes.where((F.col("n") > MAX_RECORD_LINES) | ~F.col("closed")).select("_file").distinct()
    return whole.unionByName(joined), unclosed


def parallel_records(spark: SparkSession, files: Sequence[str], width: int) -> tuple[DataFrame, list[str]]:
    """Records of large files, each read by many tasks although fields may hold line breaks.

    Lines are read in splits. A line break is inside a field if an odd number of quotes stands
    before it, so the lines of a split are numbered by the quotes before them and the splits of
    a file carry their parity on (a row per split). Lines that continue a record are joined
    to it; only they are grouped. Returns the records and the files for which that does not hold:
    a quote within an unquoted field, one never closed, or a record of over
    ``MAX_RECORD_LINES`` lines. Those are read as a whole, as small files are.
    """
    lines = spark.read.option("lineSep", "\n").text(list(files))
    lines = lines.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("blk"),
                         F.monotonically_increasing_id().alias("row"), F.make_valid_utf8("value").alias("line"))
    lines = lines.withColumn("odd", (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2)
    out = scratch_path(spark, "csv-lines")
    lines.write.parquet(out)
    stored = spark.read.parquet(out)
    # the first line's end is that of all records; one row per file
    place = F.struct("blk", "row")
    ending = stored.groupBy("_file").agg(F.min_by(F.endswith("line", F.lit("\r")), place).alias("crlf"), F.max(place).alias("last"))
    ending = reliable_checkpoint(ending)
    # where every line has its quotes in pairs, each is a record: nothing is carried on or joined
    broken = {r[0] for r in stored.where("odd = 1").select("_file").distinct().collect()}  # some of ``files``
    told = join_small(stored.where(~F.col("_file").isin(sorted(broken))), ending, on="_file", how="inner")
    records = told.select("_file", place.alias("rid"), "line", "crlf", (place == F.col("last")).alias("final"))
    unclosed = None
    if broken:
        joined, unclosed = _joined_lines(spark, files, stored.where(F.col("_file").isin(sorted(broken))), ending)
        records = records.unionByName(joined)
    ended = F.endswith("line", F.lit("\r")) | F.col("final") | ~F.col("crlf")
    # line breaks within fields become \n where \r\n ends the records, as when a file is read as a whole
    text = F.when(F.col("crlf"), F.replace(F.regexp_replace("line", "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("line"))
    records = records.select("_file", "rid", text.alias("line"), ended.alias("ended")).where("line <> ''")
    out = scratch_path(spark, "csv-records")
    records.withColumn("regular", F.col("ended") & F.col("line").rlike(_REGULAR_RE)).write.parquet(out)
    records = spark.read.parquet(out)
    bad = records.where("NOT regular").select("_file").distinct()
    irregular = sorted({r[0] for r in (bad if unclosed is None else bad.union(unclosed)).collect()})  # some of ``files``
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxColumns": str(max(20480, 2 * width))}
    parsed = records.where(~F.col("_file").isin(irregular)).withColumn("r", F.from_csv("line", raw_schema(width).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options))
    recs = parsed.select("_file", F.array(*[F.col("r")[f"_c{i}"] for i in range(width)]).alias("_f"), F.col("r._corrupt").alias("_corrupt"),
                         F.col("rid").alias("_rid"))
    return recs, irregular


def stage(spark: SparkSession, path, glob: str | None = "*.csv", width: int = DEFAULT_WIDTH,
          quoted_newlines: bool = True, large: int = LARGE_FILE) -> tuple[DataFrame, int, DataFrame]:
    """Parse every file once and persist raw records to the checkpoint root.

    Returns the staged records (``_file, _rid, _f, _corrupt``), the width
    used and the per-file table. When a header is wider than the staging
    schema the scan is repeated once with room for it (the widest header is
    the only value brought to the driver). Files above ``large`` bytes are read by many tasks,
    smaller ones too where they are few (:func:`large_size`).
    """
    if quoted_newlines:
        large = large_size(spark, path, glob, large)
    big = large_files(spark, path, glob, large) if quoted_newlines else []
    while True:
        if big:
            recs, irregular = parallel_records(spark, big, width)
            recs = recs.unionByName(_raw_scan(spark, path, width, glob, at_most=large))
            if irregular:
                recs = recs.unionByName(_raw_scan(spark, [unquote(f) for f in irregular], width, None))
        else:
            recs = _raw_scan(spark, path, width, glob, quoted_newlines)
        staged = stage_records(spark, recs)
        files = file_table(staged, width)
        widest = int(files.agg(F.max("header_width")).collect()[0][0] or 0)
        if widest <= width:
            return staged, width, files
        width = widest * 2


def file_report(files: DataFrame) -> DataFrame:
    """Per file: record count, header width and whether every record matches it."""
    return files.select("_file", "n_records", "header_width", "ok")


def _headers(files: DataFrame, spec: FeedSpec) -> DataFrame:
    """One row per file: its header record id and, for every spec column, the
    1-based position of that name in the normalised header (last duplicate
    wins; NULL when the file lacks the column). Computed once per file, so a
    data row only does ``element_at`` lookups."""
    h = F.transform(F.col("_h"), lambda x: F.lower(S.trim_space(x)))
    cols = []
    for i, (csv_name, _, _) in enumerate(spec.columns):
        rpos = F.array_position(F.reverse(h), F.lit(csv_name))
        cols.append(F.when(rpos > 0, (F.size(h) - rpos + 1).cast("int")).alias(f"_p{i}"))
    return files.select("_file", "_hdr_rid", *cols)


_PARSERS = {
    "text": lambda c: S.text(c),
    "double0": lambda c: S.lenient_double(c, 0.0),
    "double?": lambda c: S.lenient_double(c, None),
    "int0": lambda c: S.lenient_long(c, 0, "clamp"),
    "int0s": lambda c: S.lenient_long(c, 0, "default"),
    "int?": lambda c: S.lenient_long(c, None, "default"),
    "bool": S.lenient_bool,
    "date": S.lenient_date,
    "date3": S.lenient_date3,
    "clock": S.lenient_clock,
    "ts": S.lenient_ts,
    # wall-clock timestamp without zone (driver-table round trips)
    "ts_ntz": lambda c: F.when(S.trim_space(c) != "", S.trim_space(c).try_cast("timestamp_ntz")),
    "long?": lambda c: S.lenient_long(c, None, "default"),
}


# What the parsers make of a blank cell; of the others it is NULL.
_BLANKS = {"text": F.lit, "double0": lambda _: F.lit(0.0), "int0": lambda _: F.lit(0).cast("long"),
           "int0s": lambda _: F.lit(0).cast("long"), "bool": lambda _: F.lit(False)}


def parse_value(raw: Column, parser: str, clean: str) -> Column:
    """A typed cell. Most cells of a wide export are blank: for those no pattern is tried."""
    cell = S.clean_text(raw, "runs") if clean == "runs" else raw
    blank = _BLANKS.get(parser, lambda _: F.lit(None))("")
    return F.when(raw != "", _PARSERS[parser](cell)).otherwise(blank)


def bind_columns(records: DataFrame, spec: FeedSpec) -> DataFrame:
    """Typed projection of the spec from name-bound raw fields (``_p<i>`` are
    the per-file positions joined from :func:`_headers`)."""
    cols = [parse_value(F.try_element_at(F.col("_f"), F.col(f"_p{i}")), parser, spec.clean).alias(target)
            for i, (_, parser, target) in enumerate(spec.columns)]
    return records.select("_file", "_rid", *cols)


def read_csv_dir(spark: SparkSession, path, spec: FeedSpec, on_bad_file: str = "skip",
                 glob: str | None = "*.csv", width: int | None = None, quoted_newlines: bool = True,
                 large: int = LARGE_FILE) -> CsvBatch:
    """Read a directory (or list) of CSV exports of one feed.

    ``on_bad_file='skip'``: bad files are reported and left out, the others
    load. ``'fail'``: the first bad file (lexical order) raises. Empty files
    produce no records and are skipped. Rows with a blank key are dropped.
    """
    staged, w, files = stage(spark, path, glob, width or len(spec.columns), quoted_newlines, large)
    return load_staged(staged, w, spec, on_bad_file, files)


def load_staged(staged: DataFrame, w: int, spec: FeedSpec, on_bad_file: str = "skip",
                files: DataFrame | None = None) -> CsvBatch:
    """Header binding, quarantine and typing of staged records."""
    table = files if files is not None else file_table(staged, w)
    files = file_report(table)
    bad = files.where(~F.col("ok")).select("_file", F.lit("field count differs from header").alias("reason"))
    if on_bad_file == "fail":
        first_bad = bad.orderBy("_file").limit(1).collect()
        if first_bad:
            raise ValueError(f"bad CSV file {first_bad[0]['_file']}: {first_bad[0]['reason']}")
    heads = _headers(table, spec)
    # one row per file: broadcast when small, so one huge file is not one partition
    good = join_small(join_small(staged, bad.select("_file"), on="_file", how="left_anti"),
                      heads, on="_file", how="inner")
    body = good.where(F.col("_rid") != F.col("_hdr_rid"))
    typed = bind_columns(body, spec)
    for k in spec.key:
        typed = typed.where(F.col(k) != "")
    return CsvBatch(rows=typed.withColumnRenamed("_rid", "_row"), bad_files=bad, files=files)


def import_counts(batch: CsvBatch, key: str) -> DataFrame:
    """Run metrics per file (A12): records, loaded rows, distinct keys."""
    loaded = batch.rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.count_distinct(key).alias("n_keys"))
    return (batch.files.join(loaded, on="_file", how="left")
            .select("_file", F.greatest(F.col("n_records") - 1, F.lit(0)).alias("n_records"),
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_keys", F.lit(0)).alias("n_keys"),
                    "ok"))


def items_and_headers(rows: DataFrame, version: str = "source_updated_at",
                      header_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Transactions feed -> (items, headers): items 1:1, headers newest per
    ``transaction_id`` with the sequential-file tie rule (A1, W6)."""
    from ..operators.latest import file_order, latest_by_key
    headers = latest_by_key(rows, ["transaction_id"], order=file_order(version, "_file", "_row"))
    if header_cols:
        headers = headers.select(*header_cols)
    return rows, headers
