"""The registered queries of this subpackage: each applies an operator, with its
production parameters, to a whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """Where the public word vocabulary lies; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_documents

    labels = table(spark, sf_dir, "labels")
    trusted = labels.where((labels.quality == 1) & (labels.toxic == 0))
    return score_documents(table(spark, sf_dir, "documents"), trusted)


@register("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import KINDS, scan_secrets, written

    rows = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *map(count, KINDS[:3]), F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


@register("op5_warc", """
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN top END AS refers_to
FROM (SELECT *, strlen(h) >= 1000 AND page_id <> top AS revisit
      FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages))
""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    rows = read_archives(write_archives(table(spark, sf_dir, "pages")), payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op1_langid")
def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, held_out, identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register("op9_passages", r"""
WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts)),
firsts AS (SELECT w, min(doc_id) AS f FROM windows GROUP BY w HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
  FROM (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE f < doc_id)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
""")
def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .passages import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@register("op4_jaccard", r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
pieces AS (
  SELECT DISTINCT doc_id, sha256(array_to_string(ws[i:i + 3], ' ')) AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM texts WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM pieces GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM pieces a JOIN pieces b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
""")
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import join_similar

    return join_similar(table(spark, sf_dir, "documents"))


@register("op7_leaks")
def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .leaks import find_leaks, prepare

    docs = table(spark, sf_dir, "documents")
    return find_leaks(docs, prepare(docs, table(spark, sf_dir, "benchmark")))


@register("op8_html")
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


@register("op6_private")
def op6_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .private import find_private, fit

    docs = table(spark, sf_dir, "documents")
    return find_private(docs, fit(docs))


@register("op13_interactions", r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         min(doc_id) OVER (PARTITION BY t) AS earliest FROM texts),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
sets AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
  FROM (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
               100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
               regexp_matches(t, '[#$%&*|]') AS d, coalesce(earliest < doc_id, FALSE) AS e FROM split)
  LEFT JOIN marks USING (doc_id) GROUP BY part, a, b, c, d, e),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT v.x || w.x || x.x || y.x || z.x AS o FROM letters v, letters w, letters x, letters y, letters z
  WHERE v.x NOT IN (w.x, x.x, y.x, z.x) AND w.x NOT IN (x.x, y.x, z.x) AND x.x NOT IN (y.x, z.x) AND y.x <> z.x),
gone AS (
  SELECT *, least(CASE WHEN a THEN instr(o, 'A') ELSE 6 END, CASE WHEN b THEN instr(o, 'B') ELSE 6 END, CASE WHEN c THEN instr(o, 'C') ELSE 6 END,
                  CASE WHEN d THEN instr(o, 'D') ELSE 6 END, CASE WHEN e THEN instr(o, 'E') ELSE 6 END) AS cut FROM sets, orders),
told AS (
  SELECT part, o, step, substr(o, step, 1) AS f,
         sum(CASE WHEN cut > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN cut = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN cut < step AND hit THEN n ELSE 0 END) AS redundant, sum(CASE WHEN hit AND others = 0 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN cut = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN cut = step THEN bad ELSE 0 END) AS toxic_lost
  FROM (SELECT *, CASE substr(o, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS hit,
               CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) - 1 AS others
        FROM gone, (SELECT unnest([1, 2, 3, 4, 5]) AS step)) GROUP BY part, o, step)
SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM told
""")
def op13_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .interactions import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def _codes_sql(rounds: int = 6) -> str:
    """Each round measures every entry; the dealt operator measures candidates only."""
    measured = """SELECT vec_id, p, e, d FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS nth FROM (
      SELECT vec_id, c.p, e, sum((x - y) * (x - y)) AS d FROM cut c JOIN {book} b ON c.p = b.p AND c.k = b.k GROUP BY vec_id, c.p, e)) WHERE nth = 1"""
    turns = "".join(f"""
near{r} AS MATERIALIZED ({measured.format(book=f"book{r}")}),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.k, coalesce(m.y, b.y) AS y FROM book{r} b LEFT JOIN (
    SELECT p, e, k, CAST(floor(sum(x) / count(*)) AS BIGINT) AS y FROM cut JOIN near{r} USING (vec_id, p) GROUP BY p, e, k) m
  ON m.p = b.p AND m.e = b.e AND m.k = b.k),""" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, embedding AS v, label FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, i // (n // 8) AS p, i % (n // 8) AS k, CAST(floor(4096 * CAST(v[i + 1] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, v, len(v) AS n, unnest(range(0, len(v))) AS i FROM kept)),
book0 AS MATERIALIZED (
  SELECT p, e, k, x AS y FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16) USING (vec_id)),{turns}
near AS MATERIALIZED ({measured.format(book=f"book{rounds}")}),
coded AS (
  SELECT vec_id, string_agg('0' || substr('0123456789abcdef', CAST(e AS INT) + 1, 1), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, k)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


@register("op11_codes", _codes_sql())
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .codes import compress

    return compress(table(spark, sf_dir, "embeddings"))
