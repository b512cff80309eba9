"""Versioned tables with one numbered manifest per run.

Open-source Spark has no ``MERGE INTO`` for Parquet and overwriting the path
being read destroys it, so every run writes what it changed to folders of its
own, ``<root>/<table>/v=<run>-<attempt>/``, and then commits a manifest naming the
files of *every* table. Readers resolve tables through the newest manifest, so the
tables of a run (header + items, clients + marks, products + stock + history) become
visible together or not at all, and a failed run leaves only unreferenced files
behind. A run whose manifest exists is not written again, so a retried job is
idempotent and never touches files that readers see.

Manifests are numbered and a number can be created once. A run starts from one
manifest, and when it commits and others have committed since, it goes on top of
theirs if they wrote no table that it wrote or read; otherwise it fails with
:class:`Conflict` and nothing of it is visible. :func:`committing` starts such a run anew.

A key-bucketed table is changed in one of two ways. ``merges`` rewrite the buckets
that a batch touches; best when a batch falls into few of them. ``deltas`` append the
batch's rows as one more part, with the rule by which the part changes the table, and
readers apply it: the cost of a run is that of its batch, however many buckets its keys
fall into. After some parts the buckets that they touch are rewritten once (compaction).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, row_bytes
from ..operators.merge import DROP, GIVEN, OP, PUT, SEQ, MergeRule
from . import files as FS

MANIFESTS, INDEXES = "_manifests", "_index"
#: Runs that a manifest remembers, so that a retry of one of them changes nothing.
RECENT = 5000
#: Delta parts of a table, and their rows, beyond which a commit compacts it.
MAX_DELTAS, MAX_DELTA_ROWS = 8, 50_000_000
_BUCKET, _SLOT = "_bucket", "_slot"


class Conflict(RuntimeError):
    """Another run has changed a table that this run read or wrote. Nothing was committed."""


class Tables(Mapping):
    """The tables of a manifest by name. What a table consists of, which for a bucketed one is a
    path per bucket, stands in a file of its own and is read when it is asked for."""

    def __init__(self, spark: SparkSession | None = None, refs: dict | None = None):
        self.spark, self.refs, self._read = spark, refs or {}, {}

    def __getitem__(self, name: str):
        ref = self.refs[name]
        if "index" not in ref:
            return ref["path"]
        if name not in self._read:
            self._read[name] = _manifest(self.spark, ref["index"])
        return self._read[name]

    def __contains__(self, name) -> bool:
        return name in self.refs

    def __iter__(self):
        return iter(self.refs)

    def __len__(self) -> int:
        return len(self.refs)

    def __eq__(self, other) -> bool:
        return isinstance(other, Tables) and self.refs == other.refs

    __hash__ = None


@dataclass(frozen=True)
class Snapshot:
    """The hub as of one manifest (number 0: none yet)."""
    number: int = 0
    tables: Tables = field(default_factory=Tables)
    recent: dict = field(default_factory=dict)


def _manifest_dir(root: str) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}"


def _numbers(spark: SparkSession, root: str) -> dict[int, str]:
    """``{number: manifest file}``, from a listing alone: no manifest is read. Only a missing
    folder counts as "none"; any other failure is raised."""
    try:
        found = spark.read.text(_manifest_dir(root)).inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {int(f.split("/")[-1].split(".")[0]): f for f in found}


def _manifest(spark: SparkSession, file: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(file).collect()))


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The newest manifest. Pass it on as ``at`` to everything that one run reads and writes,
    so that the run sees one state and its commit knows what it was built on."""
    found = _numbers(spark, root)
    if not found:
        return Snapshot()
    doc = _manifest(spark, found[max(found)])
    return Snapshot(doc["number"], Tables(spark, doc["tables"]), doc["recent"])


def latest_manifest(spark: SparkSession, root: str) -> dict:
    """``{table: entry}`` of the newest manifest ({} when none)."""
    return dict(snapshot(spark, root).tables)


def committed(spark: SparkSession, root: str, run: str) -> dict | None:
    """The tables as ``run`` left them, or None while it is not committed."""
    now = snapshot(spark, root)
    if run not in now.recent:
        return None
    file = _numbers(spark, root).get(now.recent[run])
    return dict(Tables(spark, _manifest(spark, file)["tables"]) if file else now.tables)


def _attempt(root: str, name: str, run: str) -> str:
    """A fresh folder for this attempt at ``run``."""
    return f"{root}/{name}/v={run}-{uuid.uuid4().hex[:8]}"


def _commit(spark: SparkSession, root: str, run: str, changes: dict, at: Snapshot, reads: Iterable[str] = ()) -> dict:
    """Commit ``changes`` ({table: entry}) made from ``at``, on top of what others have committed
    since, unless they wrote a table among ``changes`` or ``reads``. Returns all tables."""
    mine = {*changes, *reads}
    refs = {name: _indexed(spark, root, run, name, entry) for name, entry in changes.items()}
    while True:
        found = _numbers(spark, root)
        number, tables, recent = at.number, at.tables.refs, at.recent
        for number in sorted(n for n in found if n > at.number):
            doc = _manifest(spark, found[number])
            if doc["run"] == run:
                return dict(Tables(spark, doc["tables"]))
            clash = mine & set(doc["wrote"])
            if clash:
                raise Conflict(f"run {run}: run {doc['run']} has changed {', '.join(sorted(clash))} since")
            tables, recent = doc["tables"], doc["recent"]
        number, tables = number + 1, {**tables, **refs}
        recent = dict(sorted({**recent, run: number}.items(), key=lambda x: x[1])[-RECENT:])
        doc = {"number": number, "run": run, "wrote": sorted(changes), "tables": tables, "recent": recent}
        if FS.create_exclusive(spark, f"{_manifest_dir(root)}/{number:012d}.json", json.dumps(doc, sort_keys=True)):
            return dict(Tables(spark, tables))


def _indexed(spark: SparkSession, root: str, run: str, name: str, entry) -> dict:
    """What the manifest says of a table: its path, or the file that tells its parts."""
    if isinstance(entry, str):
        return {"path": entry}
    path = f"{root}/{name}/{INDEXES}/{run}-{uuid.uuid4().hex[:8]}.json"
    FS.create_exclusive(spark, path, json.dumps(entry, sort_keys=True))
    return {"index": path}


def committing(work: Callable[[], object], attempts: int = 5):
    """The result of ``work``, a run from its first read to its commit, started anew when another
    run changed what it had read."""
    for left in range(attempts - 1, -1, -1):
        try:
            return work()
        except Conflict:
            if not left:
                raise


def publish(spark: SparkSession, root: str, run: str, tables: dict[str, DataFrame], at: Snapshot | None = None,
            reads: Iterable[str] = ()) -> dict:
    """Write the given tables as version ``run`` and commit one manifest.

    Tables not in ``tables`` keep the version of the previous manifest. ``at`` is the snapshot
    that the tables were made from (default: the newest), ``reads`` names what was read of it.
    """
    root = root.rstrip("/")
    at = at or snapshot(spark, root)
    if run in at.recent:
        return committed(spark, root, run)
    changes = {}
    for name, df in tables.items():
        changes[name] = _attempt(root, name, run)
        df.write.parquet(changes[name])
    return _commit(spark, root, run, changes, at, reads)


# ---------------------------------------------------------------- reading
def _schema(entry: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))


def _read(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _read_entry(spark: SparkSession, entry, only: set[int] | None = None) -> DataFrame:
    """A table, or of a bucketed one the buckets in ``only``."""
    if isinstance(entry, str):
        return spark.read.parquet(entry)
    schema = _schema(entry)
    if "parts" in entry:
        return _read(spark, schema, entry["parts"])
    if "days" in entry:
        return _read(spark, schema, [p for paths in entry["days"].values() for p in paths])
    if entry.get("deltas"):
        return _with_deltas(spark, entry, only)
    return _read(spark, schema, [p for b, p in entry["buckets"].items() if only is None or int(b) in only])


def _with_deltas(spark: SparkSession, entry: dict, only: set[int] | None, to_write: bool = False) -> DataFrame:
    """Buckets that no part touches are read as they are; of the others, rows whose key no part
    has pass by, if the parts are small enough to tell by a broadcast, and the rest is resolved.

    With ``to_write`` ``only`` are touched buckets, and rows too many for a broadcast are shuffled
    once, by bucket, and come with the column ``_bucket`` and in its order."""
    schema, rule, columns = _schema(entry), MergeRule.of(entry["rule"]), _schema(entry).names
    touched = {b for d in entry["deltas"] for b in d["buckets"] if only is None or b in only}
    clean = _read(spark, schema, [p for b, p in entry["buckets"].items() if int(b) not in touched and (only is None or int(b) in only)])
    base = _read(spark, schema, [p for b, p in entry["buckets"].items() if int(b) in touched])
    if not touched:
        return clean
    partial = [c for c in columns if any(c not in d["columns"] for d in entry["deltas"])
               and c not in rule.insert_only and c != rule.created_col]
    all_bits = (1 << len(partial)) - 1
    if len(partial) > 62:
        raise ValueError(f"{len(partial)} columns are missing in some change; at most 62 can be")
    changes = None
    for seq, d in enumerate(entry["deltas"], 1):
        part = _read(spark, T.StructType([f for f in schema if f.name in d["columns"] or f.name in rule.keys]
                                         + [T.StructField(OP, T.StringType()), T.StructField(_BUCKET, T.IntegerType())]), [d["path"]])
        if only is not None:
            part = part.where(F.col(_BUCKET).isin(sorted(touched)))
        bits = sum(1 << k for k, c in enumerate(partial) if c in d["columns"])
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in part.columns]
        part = part.select("*", *lacking, F.lit(seq).alias(SEQ), F.lit(bits).cast("long").alias(GIVEN)).select(*columns, OP, SEQ, GIVEN)
        changes = part if changes is None else changes.unionByName(part)
    own = [F.lit(PUT).alias(OP), F.lit(0).alias(SEQ), F.lit(all_bits).cast("long").alias(GIVEN)]
    keys = changes.select(*rule.keys)
    rows = sum(d["rows"] for d in entry["deltas"])
    if rows <= DEFAULT_MAX_ROWS and rows * row_bytes(keys) <= DEFAULT_MAX_BYTES:  # rows were counted when written
        keys = F.broadcast(keys.distinct())
        clean = clean.unionByName(base.join(keys, list(rule.keys), "left_anti").select(*columns))
        base = base.join(keys, list(rule.keys), "left_semi").select(*columns)
    elif to_write:
        rows = _by_bucket(base.select("*", *own).unionByName(changes), entry)
        return rule.resolve(rows, columns, partial, within=[_BUCKET, _SLOT]).drop(_SLOT)
    return clean.unionByName(rule.resolve(base.select("*", *own).unionByName(changes), columns, partial))


def read_table(spark: SparkSession, root: str, name: str, at: Snapshot | None = None) -> DataFrame:
    """``name`` as of the snapshot ``at`` (default: the newest)."""
    m = (at or snapshot(spark, root)).tables
    if name not in m:
        raise KeyError(f"table {name} has no published version under {root}")
    return _read_entry(spark, m[name])


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _buckets_of(df: DataFrame, entry: dict) -> set[int]:
    """The buckets of the keys in ``df``: at most ``n`` integers."""
    return {r[0] for r in df.select(bucket_of(entry["keys"], entry["n"]).alias("b")).distinct().collect()}


def read_touched(spark: SparkSession, root: str, name: str, keys_df: DataFrame, at: Snapshot | None = None) -> DataFrame:
    """The part of a table that can hold the keys in ``keys_df``: for a
    key-bucketed table only the buckets those keys hash to are read (partition
    pruning by path; at most ``N`` bucket ids are collected); a plain table is
    read whole."""
    entry = (at or snapshot(spark, root)).tables[name]
    if not isinstance(entry, dict) or "buckets" not in entry:
        return _read_entry(spark, entry)
    return _read_entry(spark, entry, _buckets_of(keys_df, entry))


# ---------------------------------------------------------------- key-bucketed tables
def _by_bucket(rows: DataFrame, entry: dict) -> DataFrame:
    """``rows`` with ``_bucket`` and ``_slot``, shuffled so that a slot is a task's: a bucket has as many
    as there are shuffle partitions for each bucket, so that slots are even as far as keys are."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, parts // entry["n"])
    slot = F.col(_BUCKET) * each + F.pmod(F.hash(*entry["keys"]), F.lit(each))
    rows = rows.withColumn(_BUCKET, bucket_of(entry["keys"], entry["n"])).withColumn(_SLOT, F.pmod(slot, F.lit(parts)))
    return rows.repartitionById(parts, _SLOT)


def _write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    if _BUCKET not in df.columns:
        # rebalance: AQE sizes the output tasks (splits big buckets, packs small ones)
        df = df.withColumn(_BUCKET, bucket_of(keys, buckets)).hint("rebalance", _BUCKET)
    df.write.mode("overwrite").partitionBy(_BUCKET).parquet(path)


def _bucket_ids(spark: SparkSession, path: str) -> list[int]:
    """The buckets that were written to ``path``."""
    return sorted(int(n.split("=")[1]) for n, _, _ in FS.folders(spark, path) if n.startswith(f"{_BUCKET}="))


def publish_bucketed(spark: SparkSession, root: str, run: str, name: str, df: DataFrame,
                     keys: Sequence[str], buckets: int = 256, rule: MergeRule | None = None) -> dict:
    """First version of a key-bucketed table (all buckets written)."""
    root = root.rstrip("/")
    at = snapshot(spark, root)
    if run in at.recent:
        return committed(spark, root, run)
    return _commit(spark, root, run, {name: _first_entry(spark, root, run, name, df, keys, buckets, rule)}, at)


def _merge_entry(spark: SparkSession, root: str, run: str, name: str, entry: dict, source: DataFrame,
                 merge_fn) -> tuple[dict, int]:
    """Rewrite the buckets of ``name`` that ``source`` touches; returns the new
    manifest entry (untouched buckets keep their files) and the touched count."""
    touched = _buckets_of(source, entry)
    target = _read_entry(spark, entry, touched)
    return _rewritten(spark, root, run, name, entry, merge_fn(target, source), touched), len(touched)


def _rewritten(spark: SparkSession, root: str, run: str, name: str, entry: dict, rows: DataFrame, touched: set[int]) -> dict:
    """The entry with ``rows`` as all there is in the ``touched`` buckets; of the delta parts
    those stay that touch others."""
    path = _attempt(root, name, run)
    _write_buckets(rows, path, entry["keys"], entry["n"])
    buckets = {b: p for b, p in entry["buckets"].items() if int(b) not in touched}
    buckets.update({str(b): f"{path}/{_BUCKET}={b}" for b in _bucket_ids(spark, path)})
    entry = dict(entry, buckets=buckets)
    if entry.get("deltas"):
        left = [dict(d, buckets=[b for b in d["buckets"] if b not in touched]) for d in entry["deltas"]]
        entry["deltas"] = [d for d in left if d["buckets"]]
    return entry


def _first_entry(spark: SparkSession, root: str, run: str, name: str, df: DataFrame, keys, buckets: int,
                 rule: MergeRule | None = None) -> dict:
    path = _attempt(root, name, run)
    _write_buckets(df, path, keys, buckets)
    entry = {"keys": list(keys), "n": buckets, "schema": df.schema.json(),
             "buckets": {str(b): f"{path}/{_BUCKET}={b}" for b in _bucket_ids(spark, path)}}
    return dict(entry, rule=rule.as_dict()) if rule else entry


def _appended(spark: SparkSession, root: str, run: str, name: str, entry: dict, change: DataFrame, rule: MergeRule) -> dict:
    """The entry with one more delta part: the rows of ``change`` and nothing else is written,
    in order of their buckets so that a read of few buckets skips most of it."""
    if entry.get("rule") and MergeRule.of(entry["rule"]) != rule:
        raise ValueError(f"table {name} is changed by {entry['rule']}, not by {rule}")
    path = _attempt(root, name, run)
    rows = change.withColumn(_BUCKET, bucket_of(entry["keys"], entry["n"]))
    # not by ranges, whose bounds would take a run of the batch for themselves
    rows.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, *entry["keys"]).write.parquet(path)
    counts = spark.read.schema(f"{_BUCKET} int").parquet(path).groupBy(_BUCKET).count().collect()  # at most n rows
    if not counts:
        return entry
    part = {"path": path, "run": run, "rows": sum(r[1] for r in counts), "buckets": sorted(r[0] for r in counts),
            "columns": [c for c in change.columns if c != OP]}
    return dict(entry, rule=rule.as_dict(), deltas=[*entry.get("deltas", []), part])


def _compacted(spark: SparkSession, root: str, run: str, name: str, entry: dict) -> dict:
    touched = {b for d in entry.get("deltas", []) for b in d["buckets"]}
    return _rewritten(spark, root, run, name, entry, _with_deltas(spark, entry, touched, to_write=True), touched) if touched else entry


def compact(spark: SparkSession, root: str, run: str, name: str) -> dict:
    """Rewrites the buckets of ``name`` that delta parts touch, with the parts applied. Rows stay
    the same. Returns how many buckets were rewritten."""
    root = root.rstrip("/")
    at = snapshot(spark, root)
    entry = at.tables[name]
    touched = {b for d in entry.get("deltas", []) for b in d["buckets"]}
    if run not in at.recent and touched:
        _commit(spark, root, run, {name: _compacted(spark, root, run, name, entry)}, at)
    return {"rewritten": len(touched)}


@dataclass(frozen=True)
class Delta:
    """A batch (unique by key) for a table changed by ``rule``; ``like`` has the table's columns
    and is what a table that does not exist yet starts from."""
    rule: MergeRule
    source: DataFrame
    like: DataFrame
    run_ts: object = None


# ---------------------------------------------------------------- references
class Orphans(ValueError):
    """A strict import whose rows name parents that do not exist."""


@dataclass(frozen=True)
class Reference:
    """Rows of ``child`` name a row of ``parent`` by ``on``: {child's column: parent's key column}."""
    child: str
    parent: str
    on: tuple[tuple[str, str], ...]


def missing_parents(spark: SparkSession, root: str, batch: DataFrame, ref: Reference, at: Snapshot, also: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` (of ``ref.child``) whose parent is neither stored nor in ``also``, the
    parents of the same run. Of a parent table bucketed by that key only the buckets of the
    batch's own references are read. A NULL reference names no parent and is not missing one.
    """
    names = [c for c, _ in ref.on]
    keys = batch.select(*[F.col(c).alias(p) for c, p in ref.on]).dropna().distinct()
    parents = [p for _, p in ref.on]
    known = None
    if ref.parent in at.tables:
        entry = at.tables[ref.parent]
        pruned = isinstance(entry, dict) and entry.get("keys") == parents
        known = _read_entry(spark, entry, _buckets_of(keys, entry) if pruned else None).select(*parents)
    if also is not None:
        known = also.select(*parents) if known is None else known.unionByName(also.select(*parents))
    lost = keys if known is None else keys.join(known, parents, "left_anti")
    return batch.join(lost.select(*[F.col(p).alias(c) for c, p in ref.on]), names, "left_semi")


def _orphans(spark: SparkSession, root: str, run: str, sources: dict[str, DataFrame], refs: Sequence[Reference], at: Snapshot,
             on_orphan: str) -> DataFrame | None:
    """Rows (run, child, parent, reference) that name no parent, or None without any."""
    from ..session import reliable_checkpoint
    if on_orphan not in ("report", "fail"):
        raise ValueError("on_orphan must be 'report' or 'fail'")
    found = None
    for ref in refs:
        if ref.child in sources:
            rows = missing_parents(spark, root, sources[ref.child], ref, at, sources.get(ref.parent))
            rows = rows.groupBy(F.to_json(F.struct(*[F.col(c) for c, _ in ref.on])).alias("reference")).agg(F.count("*").alias("n_rows"))
            rows = rows.select(F.lit(run).alias("run"), F.lit(ref.child).alias("child"), F.lit(ref.parent).alias("parent"), "reference", "n_rows")
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        return None
    found = reliable_checkpoint(found)
    first = found.limit(1).collect()
    if first and on_orphan == "fail":
        raise Orphans(f"run {run}: {first[0]['child']} names {first[0]['parent']} {first[0]['reference']}, which does not exist")
    return found if first else None


def upsert_tables(spark: SparkSession, root: str, run: str, merges: dict, extra: dict[str, DataFrame] | None = None,
                  buckets: int = 256, appends: dict[str, DataFrame] | None = None, deltas: dict[str, Delta] | None = None,
                  at: Snapshot | None = None, reads: Iterable[str] = (), max_deltas: int = MAX_DELTAS,
                  max_delta_rows: int = MAX_DELTA_ROWS, days: dict | None = None, refs: Sequence[Reference] = (),
                  on_orphan: str = "report") -> dict:
    """Changes of several tables committed under ONE manifest (header + items + marks are
    visible together or not at all). A run that is committed already changes nothing.

    * ``merges`` maps table -> ``(keys, source, merge_fn, empty_target)``: an
      existing bucketed table rewrites only the buckets its batch touches
      (``merge_fn(target_part, source)``); a new table is written as
      ``merge_fn(empty_target, source)`` in ``buckets`` buckets;
    * ``deltas`` maps table -> :class:`Delta`: the batch is appended as a delta part. Beyond
      ``max_deltas`` parts or ``max_delta_rows`` rows in them the table is compacted in this run;
    * ``extra`` are plain tables, written whole;
    * ``appends`` are append-only tables: the run's rows become one more part, which the
      manifest adds to those before;
    * ``days`` are entries of tables by day, see :func:`tidemark.sources.days.changed_days`.

    ``refs`` are checked before the commit: rows of a batch whose parent is neither stored nor
    in this run's batch of parents are added to the table ``orphans`` with the run, or with
    ``on_orphan='fail'`` raise :class:`Orphans`, and nothing of the run is visible.

    Returns the number of buckets that the run rewrote, or that its delta part touches, by table.
    """
    from ..session import reliable_checkpoint
    root = root.rstrip("/")
    at = at or snapshot(spark, root)
    if run in at.recent:
        return dict.fromkeys([*merges, *(deltas or {})], 0)
    changes, touched = {}, {}
    sources = {**{n: m[1] for n, m in merges.items()}, **{n: d.source for n, d in (deltas or {}).items()}}
    lost = _orphans(spark, root, run, sources, refs, at, on_orphan)
    if lost is not None:
        appends = {**(appends or {}), "orphans": lost}
    for name, (keys, source, merge_fn, empty_target) in merges.items():
        entry = at.tables.get(name)
        if isinstance(entry, dict):
            # the batch is read twice (touched buckets, merge): materialise it once
            changes[name], touched[name] = _merge_entry(spark, root, run, name, entry, reliable_checkpoint(source),
                                                        merge_fn)
        else:
            base = spark.read.parquet(entry) if isinstance(entry, str) else empty_target
            changes[name] = _first_entry(spark, root, run, name, merge_fn(base, source), keys, buckets)
            touched[name] = len(changes[name]["buckets"])
    for name, d in (deltas or {}).items():
        entry = at.tables.get(name)
        if not isinstance(entry, dict):
            base = spark.read.parquet(entry) if isinstance(entry, str) else d.like.limit(0)
            changes[name] = _first_entry(spark, root, run, name, d.rule.apply(base, d.source, d.run_ts), d.rule.keys, buckets, d.rule)
            touched[name] = len(changes[name]["buckets"])
            continue
        before = len(entry.get("deltas", []))
        entry = _appended(spark, root, run, name, entry, d.rule.change(d.source, _schema(entry).names, d.run_ts), d.rule)
        touched[name] = len(entry["deltas"][-1]["buckets"]) if len(entry.get("deltas", [])) > before else 0
        parts = entry.get("deltas", [])
        if len(parts) > max_deltas or sum(p["rows"] for p in parts) > max_delta_rows:
            entry = _compacted(spark, root, run, name, entry)
        changes[name] = entry
    for tname, df in (extra or {}).items():
        changes[tname] = _attempt(root, tname, run)
        df.write.parquet(changes[tname])
    for tname, df in (appends or {}).items():
        tpath = _attempt(root, tname, run)
        df.write.parquet(tpath)
        changes[tname] = {"parts": [*at.tables.get(tname, {"parts": []})["parts"], tpath], "schema": df.schema.json()}
    changes.update(days or {})
    _commit(spark, root, run, changes, at, {*reads, *[r.parent for r in refs]})
    return touched


def merge_into(spark: SparkSession, root: str, run: str, name: str, source: DataFrame, merge_fn,
               extra: dict[str, DataFrame] | None = None) -> dict:
    """Copy-on-write merge of a batch into one key-bucketed table.

    Only buckets the batch touches are read (by path: partition pruning), merged
    with ``merge_fn(target_part, source)`` and rewritten; the manifest keeps the
    untouched buckets pointing at their existing files. ``extra`` tables (e.g.
    the high-water marks) are published in the same manifest, atomically.
    """
    root = root.rstrip("/")
    entry = latest_manifest(spark, root)[name]
    touched = upsert_tables(spark, root, run, {name: (entry["keys"], source, merge_fn, None)}, extra)
    return {"touched": touched[name], "buckets": len(latest_manifest(spark, root)[name]["buckets"])}


# ---------------------------------------------------------------- deletes and key updates on stored tables
def _tombstones(spark: SparkSession, root: str, run: str, name: str, entry: dict, keys: DataFrame) -> dict:
    """The entry with a delta part that drops the keys."""
    rule = MergeRule.of(entry["rule"]) if entry.get("rule") else MergeRule(tuple(entry["keys"]), "always")
    return _appended(spark, root, run, name, entry, keys.select(*entry["keys"]).distinct().withColumn(OP, F.lit(DROP)), rule)


def cascade_delete(spark: SparkSession, root: str, run: str, parent: str, gone: DataFrame, children: Sequence[tuple[str, str, dict]] = ()) -> dict:
    """Deletes the rows of the stored table ``parent`` whose keys are in ``gone``, and their children.

    ``children`` are (table, parent table, {column: parent's column}), a parent before its
    children; a child's own children may follow it. Only keys are written: each table gets a
    delta part of tombstones and all parts are committed together. Returns the number of keys
    dropped by table.
    """
    from ..session import reliable_checkpoint
    root = root.rstrip("/")
    at = snapshot(spark, root)
    if run in at.recent:
        return {}
    rows = _read_entry(spark, at.tables[parent], _buckets_of(gone, at.tables[parent]))
    dropped = {parent: reliable_checkpoint(rows.join(gone.select(*at.tables[parent]["keys"]).distinct(), at.tables[parent]["keys"], "left_semi"))}
    for child, of, on in children:
        lost = dropped[of].select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
        found = _read_entry(spark, at.tables[child]).join(lost, list(on), "left_semi")
        found = reliable_checkpoint(found)
        dropped[child] = dropped[child].unionByName(found) if child in dropped else found
    return _dropped(spark, root, run, at, dropped, {})


def _dropped(spark, root, run, at, dropped: dict[str, DataFrame], anew: dict[str, DataFrame]) -> dict:
    """Commits tombstones for ``dropped`` and then the rows ``anew`` as they are."""
    changes, counts = {}, {}
    for name, rows in dropped.items():
        entry = _tombstones(spark, root, run, name, at.tables[name], rows)
        added = len(entry.get("deltas", [])) > len(at.tables[name].get("deltas", []))
        counts[name] = entry["deltas"][-1]["rows"] if added else 0
        if name in anew and added:
            entry = _appended(spark, root, run, name, entry, anew[name].withColumn(OP, F.lit(PUT)), MergeRule.of(entry["rule"]))
        if added:
            changes[name] = entry if len(entry["deltas"]) <= MAX_DELTAS else _compacted(spark, root, run, name, entry)
    _commit(spark, root, run, changes, at, reads=dropped)
    return counts


def cascade_rekey(spark: SparkSession, root: str, run: str, parent: str, key: str, key_map: DataFrame,
                  children: Sequence[tuple[str, str]] = (), old: str = "old_key", new: str = "new_key") -> dict:
    """Gives rows of the stored table ``parent`` new values of ``key`` and their children, listed
    as (table, column), the same in that column; everything else about a row stays.

    A changed row is dropped and put back under its new key, so no version or guard holds it up.
    ``key_map`` (old_key, new_key) must be unique on both and must not move a row onto a
    key that stays in use; that fails and changes nothing. Returns the number of rows by table.
    """
    from ..operators.latest import assert_unique
    from ..session import reliable_checkpoint
    root = root.rstrip("/")
    at = snapshot(spark, root)
    if run in at.recent:
        return {}
    moves = reliable_checkpoint(key_map.select(F.col(old).alias("_old"), F.col(new).alias("_new")).where("NOT (_old <=> _new)"))
    assert_unique(moves, ["_old"], "key map")
    assert_unique(moves, ["_new"], "key map")
    dropped, anew = {}, {}
    for table, column in [(parent, key), *children]:
        entry = at.tables[table]
        rows = _read_entry(spark, entry)
        hit = reliable_checkpoint(rows.join(moves, rows[column] == moves["_old"], "inner"))
        if table == parent:
            stay = rows.join(moves, rows[key] == moves["_old"], "left_anti")
            taken = stay.join(hit.select(F.col("_new").alias(key)), key, "left_semi").limit(1).collect()
            if taken:
                raise ValueError(f"{table}: key {taken[0][key]!r} is in use")
        dropped[table] = hit.select(*rows.columns)
        anew[table] = hit.select(*[F.col("_new").alias(c) if c == column else F.col(c) for c in rows.columns])
    return _dropped(spark, root, run, at, dropped, anew)


# ---------------------------------------------------------------- lookups
def find(spark: SparkSession, root: str, name: str, key_values: dict, at: Snapshot | None = None) -> DataFrame:
    """Row(s) of a stored table for a key: of a table bucketed by that key one bucket is read."""
    entry = (at or snapshot(spark, root)).tables[name]
    if isinstance(entry, dict) and "buckets" in entry and set(entry["keys"]) == set(key_values):
        types = {f.name: f.dataType for f in _schema(entry)}
        key = spark.range(1).select(*[F.lit(key_values[k]).cast(types[k]).alias(k) for k in entry["keys"]])
        return lookup(_read_entry(spark, entry, _buckets_of(key, entry)), key_values)
    return lookup(_read_entry(spark, entry), key_values)


def lookup(df: DataFrame, key_values: dict) -> DataFrame:
    """Row(s) for a key (unique key -> at most one row); pushed to the scan."""
    cond = None
    for k, v in key_values.items():
        e = F.col(k) == F.lit(v)
        cond = e if cond is None else cond & e
    return df.where(cond)


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """``First`` semantics: the row with the smallest key."""
    return df.orderBy(F.col(key).asc()).limit(1)


# ---------------------------------------------------------------- retention
def _paths(entry) -> list[str]:
    """All paths that an entry names."""
    if isinstance(entry, str):
        return [entry]
    return [*entry.get("parts", []), *entry.get("buckets", {}).values(), *[d["path"] for d in entry.get("deltas", [])],
            *[p for paths in entry.get("days", {}).values() for p in paths]]


def expire(spark: SparkSession, root: str, keep: int = 10, grace_hours: float = 24.0) -> dict:
    """Removes manifests before the last ``keep`` and the version folders that none of the kept
    ones reaches. Folders changed within ``grace_hours`` stay, as they may belong to a run that
    has not committed yet; choose it above the longest run. Readers of the kept manifests are
    not touched. Returns the numbers of manifests and folders removed.
    """
    if keep < 1:
        raise ValueError("keep at least one manifest")
    root = root.rstrip("/")
    found = _numbers(spark, root)
    kept = sorted(found)[-keep:]
    used, tables = set(), set()
    for number in kept:
        refs = _manifest(spark, found[number])["tables"]
        used.update(FS.plain(r["index"]) for r in refs.values() if "index" in r)
        for name, entry in Tables(spark, refs).items():
            tables.add(name)
            used.update(p[:p.index("/v=")] + "/v=" + p.split("/v=", 1)[1].split("/")[0] for p in map(FS.plain, _paths(entry)))
    for number in sorted(found)[:-keep]:
        tables.update(_manifest(spark, found[number])["tables"])
    before = (time.time() - grace_hours * 3600) * 1000
    old = lambda listed: [path for _, path, changed in listed if changed <= before and FS.plain(path) not in used]
    gone = [p for t in sorted(tables) for p in old(x for x in FS.folders(spark, f"{root}/{t}") if x[0].startswith("v="))]
    told = [p for t in sorted(tables) for p in old(FS.files(spark, f"{root}/{t}/{INDEXES}"))]
    for path in [*[found[n] for n in sorted(found)[:-keep]], *told, *gone]:  # first what names the others
        FS.remove(spark, path)
    return {"manifests": len(found) - len(kept), "folders": len(gone)}
