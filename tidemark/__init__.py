"""tidemark: incremental ingestion and entity history on Spark DataFrames.

Lenient typed ingest -> latest-per-key -> guarded merge -> high-water marks
-> change history -> daily last value, all expressed as DataFrame plans.

Entry points:

* ``tidemark.plans.daily.run_daily`` (or ``python -m tidemark daily``) -- every
  phase of a daily run over landed files;
* ``tidemark.plans.jobs`` -- the individual jobs (imports, products, reviews,
  refresh, bootstrap);
* ``tidemark.streaming.stream`` -- the same imports as Structured Streaming jobs;
* ``tidemark.operators`` / ``tidemark.sources`` / ``tidemark.functions`` -- the
  building blocks (merge, latest_by_key, incremental_window, change_history,
  read_csv_dir, read_pages, lenient_* parsers, ...).
"""

__version__ = "0.1.0"
