"""Registered queries: one per operator group, each over whole driver tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame, lazy but for the queries
of streams and stored tables, which run their commits while they are built;
``ORACLE[name]`` is DuckDB SQL over the same tables that must give the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsync.config import SyncConfig
from shelfsync.functions.fingerprint import fingerprint, row_text
from shelfsync.functions.text import extract_title, page_title, sanitize
from shelfsync.operators import detect, embed, enrich, merge, quality, report, schedule
from shelfsync.operators.cache import CachedEmbedder, VectorCache
from shelfsync.operators.dedupe import dedupe_keys, dedupe_repeated
from shelfsync.operators.normalize import embedding_text, normalize
from shelfsync.plans import fixtures as fx
from shelfsync.plans import oracle as sql
from shelfsync.plans.sync import FunctionEmbedder, TableEmbedder, outcome
from shelfsync.session import scratch_path
from shelfsync.sources import catalog
from shelfsync.sources.bucketed import BucketedTable
from shelfsync.sources.jdbc import vector_text
from shelfsync.sources.scan import keyed_source, mapped_scan, source_count, spread
from shelfsync.sources.store import TableStore
from shelfsync.streaming.keyed import keyed_changes, latest_changes, write_changes
from shelfsync.streaming.stream import run_stream_to_end, snapshot_stream, write_snapshots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- shared CTEs

def _part_keyed(spark, sf_dir) -> DataFrame:
    return keyed_source(fx.part_source(spark, sf_dir), fx.PART_MAPPING, fx.WS_PART)


def _part_classified(spark, sf_dir, mode: str) -> DataFrame:
    keyed = _part_keyed(spark, sf_dir)
    return detect.classify(keyed, fx.prior_state(keyed), mode, fx.AS_OF, fx.STALE_MINUTES)


PART_CTES = (f"src AS ({sql.PART_SRC}), "
             f"keyed AS ({sql.keyed(fx.PART_MAPPING, sql.PART_TYPES, fx.WS_PART, 'src')}), "
             f"state AS ({sql.prior_state()}), "
             f"cls AS ({sql.classified()})")


WS_SQL = ("SELECT regexp_replace(md5(n_name), '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5') AS id, "
          "n_name AS name FROM nation")


# ---------------------------------------------------------------- S1, S2

@register("scan_mapped", "SELECT p_partkey, p_name, p_retailprice, p_brand, p_size, p_promo, p_rx "
                         f"FROM ({sql.PART_SRC})")
def scan_mapped(spark, sf_dir):
    return mapped_scan(fx.part_source(spark, sf_dir), fx.PART_MAPPING)


@register("source_count", "SELECT count(*) AS total FROM part")
def q_source_count(spark, sf_dir):
    return source_count(fx.table(spark, sf_dir, "part"))


# ---------------------------------------------------------------- F1, F2

@register("row_fingerprint",
          f"WITH src AS ({sql.PART_SRC}) SELECT CAST(p_partkey AS VARCHAR) AS id, "
          f"concat_ws('|', {', '.join(sql.render(c, sql.PART_TYPES[c]) for c in fx.PART_MAPPING.source_columns())}) AS row_text, "
          f"{sql.fingerprint(fx.PART_MAPPING, sql.PART_TYPES)} AS fingerprint FROM src")
def row_fingerprint(spark, sf_dir):
    src = fx.part_source(spark, sf_dir)
    cols = fx.PART_MAPPING.source_columns()
    return src.select(F.col("p_partkey").cast("string").alias("id"),
                      row_text(src, cols).alias("row_text"), fingerprint(src, cols).alias("fingerprint"))


# ---------------------------------------------------------------- D1–D8

def _detect_sql(mode: str) -> str:
    return (f"WITH {PART_CTES} SELECT workspace_id, id, fingerprint, {sql.STATUS} AS status, "
            f"{sql.REASON} AS reason FROM cls WHERE NOT ({sql.SKIP[mode]})")


def _detect(mode: str):
    def run(spark, sf_dir):
        cls = _part_classified(spark, sf_dir, mode)
        return detect.to_process(cls).select("workspace_id", "id", "fingerprint", "status", "reason")
    return run


for _mode in ("quick", "full", "force"):
    register(f"detect_{_mode}", _detect_sql(_mode))(_detect(_mode))


@register("detect_skipped",
          f"WITH {PART_CTES} SELECT workspace_id, id, fingerprint FROM cls WHERE {sql.SKIP['quick']}")
def detect_skipped(spark, sf_dir):
    return detect.skipped(_part_classified(spark, sf_dir, "quick")).select("workspace_id", "id", "fingerprint")


@register("new_rows_anti",
          f"WITH {PART_CTES} SELECT workspace_id, id FROM keyed "
          f"WHERE NOT EXISTS (SELECT 1 FROM state WHERE state.workspace_id = keyed.workspace_id AND state.id = keyed.id)")
def new_rows_anti(spark, sf_dir):
    keyed = _part_keyed(spark, sf_dir)
    return detect.new_rows_anti(keyed, fx.prior_state(keyed)).select("workspace_id", "id")


@register("new_rows",
          f"WITH {PART_CTES} SELECT workspace_id, id FROM cls WHERE NOT ({sql.SKIP['quick']}) AND NOT known")
def q_new_rows(spark, sf_dir):
    return detect.new_rows(_part_classified(spark, sf_dir, "quick")).select("workspace_id", "id")


# ---------------------------------------------------------------- A1

@register("run_summary",
          f"WITH {PART_CTES}, m AS (SELECT *, NOT ({sql.SKIP['quick']}) AS process FROM cls) "
          "SELECT workspace_id, count(*) AS total, "
          "CAST(sum(CASE WHEN process THEN 1 ELSE 0 END) AS BIGINT) AS to_process, "
          "CAST(sum(CASE WHEN process THEN 0 ELSE 1 END) AS BIGINT) AS skipped, "
          "CAST(sum(CASE WHEN process AND NOT known THEN 1 ELSE 0 END) AS BIGINT) AS n_new, "
          "CAST(sum(CASE WHEN process AND known THEN 1 ELSE 0 END) AS BIGINT) AS n_changed, "
          "CAST(sum(CASE WHEN process AND known AND NOT same THEN 1 ELSE 0 END) AS BIGINT) AS n_hash, "
          "CAST(sum(CASE WHEN process AND known AND same THEN 1 ELSE 0 END) AS BIGINT) AS n_stale "
          "FROM m GROUP BY workspace_id")
def run_summary(spark, sf_dir):
    return report.detection_summary(_part_classified(spark, sf_dir, "quick"))


# ---------------------------------------------------------------- P1–P15


CANON = ["workspace_id", "id", *sql.PRODUCT_DATA]


def _norm_part(spark, sf_dir) -> DataFrame:
    return normalize(_part_keyed(spark, sf_dir), fx.AS_OF, keep=("workspace_id", "id"))


def _norm_text(spark, sf_dir) -> DataFrame:
    keyed = keyed_source(fx.text_source(spark, sf_dir), fx.TEXT_MAPPING, fx.WS_TEXT)
    return normalize(keyed, fx.AS_OF, keep=("workspace_id", "id"))


NORM_PART_SQL = (f"WITH src AS ({sql.PART_SRC}), keyed AS ({sql.keyed(fx.PART_MAPPING, sql.PART_TYPES, fx.WS_PART, 'src')}), "
                 f"norm AS ({sql.normalized(fx.PART_MAPPING, sql.PART_TYPES, 'keyed')}) ")
NORM_TEXT_SQL = (f"WITH src AS ({sql.TEXT_SRC}), keyed AS ({sql.keyed(fx.TEXT_MAPPING, sql.TEXT_TYPES, fx.WS_TEXT, 'src')}), "
                 f"norm AS ({sql.normalized(fx.TEXT_MAPPING, sql.TEXT_TYPES, 'keyed')}) ")


@register("sanitize_text", f"SELECT doc_id, {sql.sanitize('text')} AS description FROM documents")
def sanitize_text(spark, sf_dir):
    # Whole documents are heavy rows, and the table is one file.
    docs = spread(fx.table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism)
    return docs.select("doc_id", sanitize(F.col("text")).alias("description"))


@register("price_minor_units", NORM_PART_SQL + "SELECT id, price FROM norm")
def price_minor_units(spark, sf_dir):
    return _norm_part(spark, sf_dir).select("id", "price")


@register("promo_rules", NORM_PART_SQL + "SELECT id, price, promotion_price FROM norm")
def promo_rules(spark, sf_dir):
    return _norm_part(spark, sf_dir).select("id", "price", "promotion_price")


@register("promo_window", NORM_PART_SQL + "SELECT id, promotion_start, promotion_end FROM norm")
def promo_window(spark, sf_dir):
    return _norm_part(spark, sf_dir).select("id", "promotion_start", "promotion_end")


@register("normalize_part", NORM_PART_SQL + f"SELECT {', '.join(CANON)} FROM norm")
def normalize_part(spark, sf_dir):
    return _norm_part(spark, sf_dir).select(*CANON)


@register("coerce_scalars", NORM_TEXT_SQL + f"SELECT {', '.join(CANON)} FROM norm")
def coerce_scalars(spark, sf_dir):
    return _norm_text(spark, sf_dir).select(*CANON)


@register("embedding_text", NORM_TEXT_SQL + "SELECT id, display_name, description, "
          "CASE WHEN display_name <> '' THEN display_name ELSE description END AS embed_text FROM norm")
def q_embedding_text(spark, sf_dir):
    n = _norm_text(spark, sf_dir)
    return n.select("id", "display_name", "description", embedding_text(n).alias("embed_text"))


# ---------------------------------------------------------------- P16–P18, E1–E4

def _lookup(spark, sf_dir) -> DataFrame:
    return enrich.pages_from_html(fx.table(spark, sf_dir, "pages"))


@register("title_extract", f"WITH p AS ({sql.PAGES_SRC}) SELECT code, CASE WHEN regexp_extract(page, '{sql.TITLE_LINE_RE}', 1) <> '' "
          f"THEN {sql.js_trim(f"regexp_extract(page, '{sql.TITLE_LINE_RE}', 1)")} END AS raw_title FROM p")
def title_extract(spark, sf_dir):
    return _lookup(spark, sf_dir).select("code", extract_title(F.col("page")).alias("raw_title"))


@register("title_clean", f"WITH p AS ({sql.PAGES_SRC}) SELECT code, {sql.title_sql('page')} AS title FROM p")
def title_clean(spark, sf_dir):
    return _lookup(spark, sf_dir).select("code", page_title(F.col("page")).alias("title"))


def _part_outcome(spark, sf_dir, mode: str = "quick") -> DataFrame:
    cls = _part_classified(spark, sf_dir, mode)
    proc = normalize(detect.to_process(cls), fx.AS_OF)
    titles = enrich.title_table(_lookup(spark, sf_dir))
    return outcome(proc, titles, TableEmbedder(fx.table(spark, sf_dir, "embeddings"), "id", "vec_id"))


OUTCOME_SQL = f"WITH {PART_CTES}, {sql.outcome_ctes(fx.PART_MAPPING, sql.PART_TYPES, 'quick')} "


@register("title_enrich", OUTCOME_SQL + "SELECT id, status, code, title, display_name FROM outc")
def title_enrich(spark, sf_dir):
    return _part_outcome(spark, sf_dir).select("id", "status", "code", "title", "display_name")


# Fixed rules of the fixture: what stands around a page's title, by page_id % 8.
NOISE = ["{t}", "{t} - Go-UPC", "EAN 7891234 – {t}", "{t} product not found", "ACCESS DENIED", "{t} — new-{t}", "", " EAN 12 -  Go-UPC "]


@register("title_noise", "WITH t AS (SELECT CAST(page_id AS VARCHAR) AS code, page_id % 8 AS k, "
          "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t FROM pages), "
          "p AS (SELECT code, CASE k " + " ".join(f"WHEN {k} THEN 'Title: ' || replace('{n}', '{{t}}', t) || chr(10)" if n else
                                                  f"WHEN {k} THEN 'A title: ' || t || chr(10)" for k, n in enumerate(NOISE))
          + " END AS page FROM t) "
          f"SELECT code, CASE WHEN regexp_extract(page, '{sql.TITLE_LINE_RE}', 1) <> '' THEN "
          f"{sql.js_trim(f"regexp_extract(page, '{sql.TITLE_LINE_RE}', 1)")} END AS raw_title, {sql.title_sql('page')} AS title FROM p")
def title_noise(spark, sf_dir):
    """Titles with site names, barcodes, dashes, rejections, nothing left, or no title line at all."""
    pages = fx.table(spark, sf_dir, "pages")
    t, k = F.regexp_extract("html", enrich.HTML_TITLE_RE, 1), F.col("page_id") % 8
    page = F.lit(None).cast("string")
    for i, n in enumerate(NOISE):
        line = F.concat(F.lit("Title: "), F.replace(F.lit(n), F.lit("{t}"), F.col("t")), F.lit("\n"))
        page = F.when(F.col("k") == i, line if n else F.concat(F.lit("A title: "), F.col("t"), F.lit("\n"))).otherwise(page)
    rows = pages.select(F.col("page_id").cast("string").alias("code"), k.alias("k"), t.alias("t")).withColumn("page", page)
    return rows.select("code", extract_title(F.col("page")).alias("raw_title"), page_title(F.col("page")).alias("title"))


PROC_SQL = (f"WITH {PART_CTES}, proc AS (SELECT *, {sql.STATUS} AS status FROM cls WHERE NOT ({sql.SKIP['quick']})), "
            f"norm AS ({sql.normalized(fx.PART_MAPPING, sql.PART_TYPES, 'proc', keep='workspace_id, id, k, fingerprint, status')}) ")


def _client():
    """A page client that fails for a third of the codes and is refused for
    another (a nested function travels to the tasks by value)."""
    def fetch(code: str) -> str:
        n = int(code)
        if n % 3 == 0:
            raise ValueError("no connection")
        return f"Title: Item {code} - Go-UPC\n" if n % 3 == 1 else "Title: Access denied\n"
    return fetch


@register("client_titles", PROC_SQL + ", looked AS (SELECT *, CASE WHEN status = 'new' AND TRY_CAST(code AS BIGINT) % 3 = 1 "
          "THEN 'Item ' || code END AS title FROM norm) "
          "SELECT id, status, code, title, COALESCE(title, display_name) AS display_name FROM looked")
def client_titles(spark, sf_dir):
    """New rows' titles asked of a client, one call a code; a failed call is no title, not a failed run."""
    rows = normalize(detect.to_process(_part_classified(spark, sf_dir, "quick")), fx.AS_OF)
    return enrich.look_up_titles(rows, enrich.ClientTitles(_client())).select("id", "status", "code", "title", "display_name")


# ---------------------------------------------------------------- M1–M5, D9

def _vec_cols(df: DataFrame) -> list:
    return [F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("embedding_dim"),
            F.when(F.col("embedding").isNotNull(), F.sha2(F.array_join(F.transform(
                "embedding", lambda x: F.floor(x.cast("double") * 1000000).cast("string")), ","), 256)).alias("embedding_sha256")]


@register("embed_join", OUTCOME_SQL + "SELECT id, status, action, CAST(len(embedding) AS INTEGER) AS embedding_dim, "
          f"{sql.VECTOR_DIGEST} AS embedding_sha256 FROM outc")
def embed_join(spark, sf_dir):
    out = _part_outcome(spark, sf_dir)
    return out.select("id", "status", "action", *_vec_cols(out))


@register("embed_batched",
          f"WITH {PART_CTES} SELECT id, {sql.STATUS} AS status, "
          "CASE WHEN known THEN 'update' ELSE 'upsert' END AS action, "
          "CAST(CASE WHEN known THEN NULL ELSE 64 END AS INTEGER) AS embedding_dim "
          f"FROM cls WHERE NOT ({sql.SKIP['quick']})")
def embed_batched(spark, sf_dir):
    """New rows embedded by a batch function in ``mapInPandas`` (50 texts per
    call, distinct texts only); every new row gets a 64-wide vector and is
    upserted, changed rows are data-only updates.  The vector values are
    checked against a plain-Python computation in the tests."""
    cls = _part_classified(spark, sf_dir, "quick")
    proc = normalize(detect.to_process(cls), fx.AS_OF)
    out = outcome(proc, None, FunctionEmbedder(embed.hashing_embedder(64), 50))
    return out.select("id", "status", "action", _vec_cols(out)[0])


def _unsteady():
    """An embedder that fails for a fifth of the texts and gives a short reply for another."""
    def embed_texts(texts: list[str]) -> list:
        if len(texts[0]) % 5 == 0:
            raise ValueError("no answer")
        return [] if len(texts[0]) % 5 == 1 else [[float(len(t)), 0.5] for t in texts]
    return embed_texts


@register("embed_failures", PROC_SQL + ", e AS (SELECT *, length(CASE WHEN display_name <> '' THEN display_name ELSE description END) AS n "
          "FROM norm) SELECT id, status, CASE WHEN status <> 'new' THEN 'update' WHEN n % 5 < 2 THEN 'drop' ELSE 'upsert' END AS action, "
          "CASE WHEN status = 'new' AND n % 5 = 0 THEN 'ValueError: no answer' WHEN status = 'new' AND n % 5 = 1 THEN 'short reply' END "
          "AS embed_error, CAST(CASE WHEN status = 'new' AND n % 5 >= 2 THEN n END AS FLOAT) AS first FROM e")
def embed_failures(spark, sf_dir):
    """One text a call: failed calls and short replies drop their rows to the next run, the rest is paired by position."""
    rows = normalize(detect.to_process(_part_classified(spark, sf_dir, "quick")), fx.AS_OF)
    out = outcome(rows, None, FunctionEmbedder(_unsteady(), 1))
    return out.select("id", "status", "action", "embed_error", F.get("embedding", F.lit(0)).alias("first"))


@register("vector_text", f"SELECT vec_id, CAST(len(embedding) AS INTEGER) AS embedding_dim, {sql.VECTOR_DIGEST} AS embedding_sha256 FROM embeddings")
def q_vector_text(spark, sf_dir):
    """Vectors as the sink's text and read back from it: the digests are those of the vectors themselves."""
    text = fx.table(spark, sf_dir, "embeddings").select("vec_id", vector_text(F.col("embedding")).alias("text"))
    back = text.select("vec_id", F.from_json("text", "array<float>").alias("embedding"))
    return back.select("vec_id", *_vec_cols(back))


# ---------------------------------------------------------------- G1–G5

def _prior_target(spark, sf_dir) -> DataFrame:
    return fx.prior_target(_part_keyed(spark, sf_dir))


def _target_view(df: DataFrame) -> DataFrame:
    return df.select(*CANON, *_vec_cols(df))


MERGE_SQL = OUTCOME_SQL + f", {sql.prior_target_cte(fx.PART_MAPPING, sql.PART_TYPES)} "


@register("upsert_products", MERGE_SQL + sql.target_view(sql.merged_sql("SELECT * FROM outc WHERE action = 'upsert'")))
def upsert_products(spark, sf_dir):
    out = _part_outcome(spark, sf_dir).filter(F.col("action") == "upsert")
    return _target_view(merge.merge_products(_prior_target(spark, sf_dir), out))


@register("update_data_only", MERGE_SQL + sql.target_view(sql.merged_sql("SELECT * FROM outc WHERE action = 'update'")))
def update_data_only(spark, sf_dir):
    out = _part_outcome(spark, sf_dir).filter(F.col("action") == "update")
    return _target_view(merge.merge_products(_prior_target(spark, sf_dir), out))


@register("update_orphans", MERGE_SQL + "SELECT workspace_id, id FROM outc WHERE action = 'update' AND NOT EXISTS "
          "(SELECT 1 FROM tgt WHERE tgt.workspace_id = outc.workspace_id AND tgt.id = outc.id)")
def update_orphans(spark, sf_dir):
    return merge.orphan_updates(_prior_target(spark, sf_dir), _part_outcome(spark, sf_dir)).select("workspace_id", "id")


@register("sync_end_to_end", MERGE_SQL + sql.target_view(sql.merged_sql("SELECT * FROM outc")))
def sync_end_to_end(spark, sf_dir):
    """The whole chain in quick mode: detect, normalise, look up titles,
    embed from the vector table, merge into the prior target."""
    keyed = dedupe_keys(_part_keyed(spark, sf_dir))
    cls = detect.classify(keyed, fx.prior_state(keyed), "quick", fx.AS_OF, fx.STALE_MINUTES)
    proc = normalize(detect.to_process(cls), fx.AS_OF)
    titles = enrich.title_table(_lookup(spark, sf_dir))
    out = outcome(proc, titles, TableEmbedder(fx.table(spark, sf_dir, "embeddings"), "id", "vec_id"))
    return _target_view(merge.merge_products(fx.prior_target(keyed), out))


@register("state_merge", OUTCOME_SQL +
          ", w AS (SELECT workspace_id, id, fingerprint AS w_fp FROM outc WHERE action IN ('upsert', 'update')) "
          "SELECT COALESCE(s.workspace_id, w.workspace_id) AS workspace_id, COALESCE(s.id, w.id) AS id, "
          "CASE WHEN w.w_fp IS NOT NULL THEN w.w_fp ELSE s.s_fp END AS fingerprint, "
          f"CASE WHEN w.w_fp IS NOT NULL THEN {sql.AS_OF_SQL} ELSE s.s_at END AS updated_at "
          "FROM state s FULL OUTER JOIN w ON s.workspace_id = w.workspace_id AND s.id = w.id")
def state_merge(spark, sf_dir):
    keyed = _part_keyed(spark, sf_dir)
    return merge.merge_state(fx.prior_state(keyed), _part_outcome(spark, sf_dir), fx.AS_OF)


@register("merge_bucketed", MERGE_SQL + sql.target_view(sql.merged_sql("SELECT * FROM outc WHERE action = 'upsert'")))
def merge_bucketed(spark, sf_dir):
    """The upserts of ``upsert_products`` into a target bucketed on the merge
    key: only the changes are shuffled, and the next version is read back."""
    prior = BucketedTable.create(_prior_target(spark, sf_dir), scratch_path(spark, "bucketed"), 8)
    merged = prior.merge(_part_outcome(spark, sf_dir).filter(F.col("action") == "upsert"))
    out = _target_view(merged.read())
    for table in (prior, merged):
        table.drop()
    return out


# ---------------------------------------------------------------- S8

# The names of the given tables, and DuckDB's type names in Spark's words.
GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "DATE": "date",
              "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT[]": "array<float>", "TIMESTAMP WITH TIME ZONE": "timestamp"}


@register("catalog_columns", "WITH n AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in GIVEN) + ") "
          "SELECT c.table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position, CASE c.data_type "
          + " ".join(f"WHEN '{d}' THEN '{s}'" for d, s in TYPE_NAMES.items()) + " ELSE c.data_type END AS data_type, n_rows "
          "FROM information_schema.columns c JOIN n ON c.table_name = n.table_name ORDER BY c.table_name, ordinal_position")
def catalog_columns(spark, sf_dir):
    """Tables and columns of a session's catalog (views of the given tables), with each table's rows."""
    views, counts = {}, None
    for name in GIVEN:
        t, views[name] = fx.table(spark, sf_dir, name), f"listed_{uuid.uuid4().hex}_{name}"
        t.createTempView(views[name])
        n = source_count(t).select(F.lit(name).alias("table_name"), F.col("total").alias("n_rows"))
        counts = n if counts is None else counts.unionByName(n)
    found = catalog.columns(spark, list(views.values()))
    for view in views.values():
        spark.catalog.dropTempView(view)
    found = found.withColumn("table_name", F.regexp_extract("table_name", "^listed_[0-9a-f]+_(.*)$", 1))
    return found.join(counts, "table_name").orderBy("table_name", "ordinal_position")


# ---------------------------------------------------------------- T1

DUE_NOW = fx.AS_OF
# Fixed rules of the fixture: which syncs the run log holds (minutes before DUE_NOW), and each workspace's schedule.


def _due_log(spark, sf_dir):
    """A run log over the workspaces of ``nation``: the one of key k had a full run
    120 k minutes ago (none where k % 6 = 0), a quick one 3 k minutes ago where k is odd."""
    ws = quality.workspaces(fx.table(spark, sf_dir, "nation")).select(F.col("id").alias("workspace_id"), "name")
    k = fx.table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("k"))
    ws = ws.join(k, "name").select("workspace_id", "k")

    def at(minutes):
        return detect.ts_literal(DUE_NOW) - F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))

    def log(rows, minutes, mode):
        return rows.select(at(minutes).alias("as_of"), F.array(F.struct("workspace_id", F.lit(mode).alias("mode"))).alias("tenants"))

    runs = log(ws.filter("k % 6 <> 0"), F.col("k") * 120, "full").unionByName(log(ws.filter("k % 2 = 1"), F.col("k") * 3, "quick"))
    plan = ws.select("workspace_id", F.when(F.col("k") % 5 == 0, 0).otherwise(15).alias("quick_minutes"),
                     F.when(F.col("k") % 7 == 0, 0).otherwise(1440).alias("full_minutes"))
    return runs, plan


@register("due_syncs", f"WITH ws AS (SELECT w.id AS workspace_id, n_nationkey AS k FROM ({WS_SQL}) w JOIN nation ON n_name = w.name), "
          "l AS (SELECT workspace_id, k, CASE WHEN k % 6 <> 0 THEN k * 120 END AS f, CASE WHEN k % 2 = 1 THEN k * 3 END AS q, "
          "CASE WHEN k % 5 = 0 THEN 0 ELSE 15 END AS qm, CASE WHEN k % 7 = 0 THEN 0 ELSE 1440 END AS fm FROM ws) "
          "SELECT workspace_id, CASE WHEN f IS NULL THEN 'full' WHEN fm > 0 AND f >= fm THEN 'full' "
          "WHEN qm > 0 AND COALESCE(q, f) >= qm THEN 'quick' END AS mode, "
          f"{sql.AS_OF_SQL} - to_minutes(f) AS last_full, {sql.AS_OF_SQL} - to_minutes(q) AS last_quick FROM l")
def q_due_syncs(spark, sf_dir):
    return schedule.due_syncs(*_due_log(spark, sf_dir), DUE_NOW)


# ---------------------------------------------------------------- M2, M5: vectors kept by content

@register("embed_cached", f"WITH {PART_CTES}, new AS (SELECT id FROM cls WHERE NOT ({sql.SKIP['quick']}) AND NOT known) "
          "SELECT 1 AS run, id, CAST(64 AS INTEGER) AS embedding_dim, false AS cached FROM new "
          "UNION ALL SELECT 2, id, CAST(64 AS INTEGER), true FROM new")
def embed_cached(spark, sf_dir):
    """New rows embedded through the cache, twice: with other prices, and so
    another fingerprint, the second run finds every vector in the cache."""
    cache = VectorCache(spark, scratch_path(spark, "vector-cache"), "hashing-64")
    out = None
    for run in (1, 2):
        src = fx.part_source(spark, sf_dir).withColumn("p_retailprice", F.col("p_retailprice") + run)
        keyed = keyed_source(src, fx.PART_MAPPING, fx.WS_PART)
        cls = detect.classify(keyed, fx.prior_state(keyed), "quick", fx.AS_OF, fx.STALE_MINUTES)
        rows = normalize(detect.new_rows(cls), fx.AS_OF)
        got = CachedEmbedder(embed.hashing_embedder(64), cache).apply(rows)
        got = got.select(F.lit(run).alias("run"), "id", F.size("embedding").alias("embedding_dim"), "cached")
        out = got if out is None else out.unionByName(got)
    return out


# ---------------------------------------------------------------- G6

@register("versions_merge", MERGE_SQL +
          f"SELECT 0 AS version, * FROM ({sql.target_view('SELECT * FROM tgt')}) "
          f"UNION ALL SELECT 1 AS version, * FROM ({sql.target_view(sql.merged_sql('SELECT * FROM outc'))})")
def versions_merge(spark, sf_dir):
    """Two commits, each of all tables at once: what the run before left, and
    the quick sync's changes on top; both read back by their version."""
    store = TableStore(spark, scratch_path(spark, "versions"), 8)
    keyed = _part_keyed(spark, sf_dir)
    before, state = store.with_bucket(fx.prior_target(keyed)), store.with_bucket(fx.prior_state(keyed))
    first = store.begin()
    first.write("target", before)
    first.write("vectors", before)
    first.write("state", state.withColumn("source_order", F.lit(None).cast("bigint")))
    first.publish()
    second = store.begin()
    out = store.with_bucket(_part_outcome(spark, sf_dir))
    staged = scratch_path(spark, "versions-outcome")
    out.write.parquet(staged)
    out = spark.read.parquet(staged)
    ups = out.filter(F.col("action") == "upsert")
    second.write("target", merge.merge_products(store.read("target", 0), out, ("bucket",), with_vectors=False))
    second.write("vectors", merge.merge_vectors(store.read("vectors", 0), ups, ("bucket",)))
    second.write("state", merge.merge_state(store.read("state", 0), out, fx.AS_OF, ("bucket",)))
    second.publish()
    both = [_target_view(store.read_products(v)).select(F.lit(v).alias("version"), "*") for v in (0, 1)]
    return both[0].unionByName(both[1])


@register("run_summary_full", MERGE_SQL +
          ", m AS (SELECT *, NOT (" + sql.SKIP["quick"] + ") AS process FROM cls), "
          "det AS (SELECT workspace_id, count(*) AS total, "
          "CAST(sum(CASE WHEN process THEN 1 ELSE 0 END) AS BIGINT) AS to_process, "
          "CAST(sum(CASE WHEN process THEN 0 ELSE 1 END) AS BIGINT) AS skipped, "
          "CAST(sum(CASE WHEN process AND NOT known THEN 1 ELSE 0 END) AS BIGINT) AS n_new, "
          "CAST(sum(CASE WHEN process AND known THEN 1 ELSE 0 END) AS BIGINT) AS n_changed, "
          "CAST(sum(CASE WHEN process AND known AND NOT same THEN 1 ELSE 0 END) AS BIGINT) AS n_hash, "
          "CAST(sum(CASE WHEN process AND known AND same THEN 1 ELSE 0 END) AS BIGINT) AS n_stale "
          "FROM m GROUP BY workspace_id), "
          "o AS (SELECT workspace_id, CAST(sum(CASE WHEN title IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS lookups_found, "
          "CAST(sum(CASE WHEN action = 'upsert' THEN 1 ELSE 0 END) AS BIGINT) AS with_embedding, "
          "CAST(sum(CASE WHEN action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS data_only, "
          "CAST(sum(CASE WHEN action = 'drop' THEN 1 ELSE 0 END) AS BIGINT) AS embed_failed FROM outc GROUP BY workspace_id), "
          "orph AS (SELECT workspace_id, count(*) AS orphans FROM outc WHERE action = 'update' AND NOT EXISTS "
          "(SELECT 1 FROM tgt WHERE tgt.workspace_id = outc.workspace_id AND tgt.id = outc.id) GROUP BY workspace_id) "
          "SELECT det.*, COALESCE(o.lookups_found, 0) AS lookups_found, COALESCE(o.with_embedding, 0) AS with_embedding, "
          "COALESCE(o.data_only, 0) AS data_only, COALESCE(o.embed_failed, 0) AS embed_failed, "
          "COALESCE(orph.orphans, 0) AS orphans, det.to_process AS processed "
          "FROM det LEFT JOIN o USING (workspace_id) LEFT JOIN orph USING (workspace_id)")
def run_summary_full(spark, sf_dir):
    """A1 in full: every count the run log records, per workspace."""
    keyed = _part_keyed(spark, sf_dir)
    cls = detect.classify(keyed, fx.prior_state(keyed), "quick", fx.AS_OF, fx.STALE_MINUTES)
    proc = normalize(detect.to_process(cls), fx.AS_OF)
    titles = enrich.title_table(_lookup(spark, sf_dir))
    out = outcome(proc, titles, TableEmbedder(fx.table(spark, sf_dir, "embeddings"), "id", "vec_id"))
    return report.run_summary(cls, out, fx.prior_target(keyed))


# ---------------------------------------------------------------- G4

LI_KEYED_SQL = (f"WITH src AS ({sql.LINEITEM_SRC}), "
                f"keyed AS ({sql.keyed(fx.LINEITEM_MAPPING, sql.LINEITEM_TYPES, fx.WS_LINEITEM, 'src')}) ")


def _li_keyed(spark, sf_dir) -> DataFrame:
    return keyed_source(spread(fx.lineitem_source(spark, sf_dir), by=fx.LINEITEM_MAPPING.id), fx.LINEITEM_MAPPING, fx.WS_LINEITEM)


@register("dedupe_keys", LI_KEYED_SQL + "SELECT workspace_id, id, max(fingerprint) AS fingerprint, "
          "arg_max(r_price, fingerprint) AS price_raw, count(*) AS copies FROM keyed GROUP BY workspace_id, id")
def q_dedupe_keys(spark, sf_dir):
    d = dedupe_repeated(_li_keyed(spark, sf_dir), count_col="copies")
    return d.select("workspace_id", "id", "fingerprint", F.col("_r_price").alias("price_raw"), "copies")


# ---------------------------------------------------------------- U1

TENANTS = [(fx.part_source, fx.PART_MAPPING, fx.WS_PART, sql.PART_SRC, sql.PART_TYPES),
           (lambda s, d: fx.table(s, d, "supplier"), fx.SUPPLIER_MAPPING, fx.WS_SUPPLIER, "supplier", sql.SUPPLIER_TYPES),
           (lambda s, d: fx.table(s, d, "customer"), fx.CUSTOMER_MAPPING, fx.WS_CUSTOMER, "customer", sql.CUSTOMER_TYPES)]


def _tenant_union(spark, sf_dir) -> DataFrame:
    parts = [normalize(keyed_source(load(spark, sf_dir), m, ws), fx.AS_OF, keep=("workspace_id", "id"))
             for load, m, ws, _, _ in TENANTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tenant_union_sql() -> str:
    blocks = []
    for _, m, ws, src, types in TENANTS:
        k = f"({sql.keyed(m, types, ws, '(' + src + ')' if src.startswith('SELECT') else src)})"
        blocks.append(f"SELECT {', '.join(CANON)} FROM ({sql.normalized(m, types, k)})")
    return " UNION ALL ".join(blocks)


@register("tenant_union", _tenant_union_sql())
def tenant_union(spark, sf_dir):
    return _tenant_union(spark, sf_dir).select(*CANON)


# ---------------------------------------------------------------- S7, A2, Q1–Q3, S8

@register("workspaces_sorted", WS_SQL + " ORDER BY name")
def workspaces_sorted(spark, sf_dir):
    return quality.workspaces(fx.table(spark, sf_dir, "nation"))


@register("workspace_check",
          f"WITH u AS ({_tenant_union_sql()} UNION ALL SELECT workspace_id, id, NULL, NULL, NULL, NULL, NULL, NULL, "
          f"NULL, NULL, NULL, NULL FROM (SELECT '{fx.WS_LINEITEM}' AS workspace_id, li_key AS id FROM ({sql.LINEITEM_SRC}))), "
          f"d AS ({WS_SQL}) SELECT workspace_id, count(*) AS n_rows, "
          f"regexp_matches(workspace_id, '{quality.UUID_RE}') AS valid_uuid, "
          "bool_or(d.id IS NOT NULL) AS known FROM u LEFT JOIN d ON u.workspace_id = d.id GROUP BY workspace_id")
def workspace_check(spark, sf_dir):
    rows = _tenant_union(spark, sf_dir).select("workspace_id", "id").unionByName(
        fx.lineitem_source(spark, sf_dir).select(F.lit(fx.WS_LINEITEM).alias("workspace_id"), F.col("li_key").alias("id")))
    return quality.workspace_check(rows, quality.workspaces(fx.table(spark, sf_dir, "nation")))


def _dq_sql(mapping, types, ws, src) -> str:
    t = {r: types[c] for r, c in mapping.roles()}
    price = sql.js_number(mapping.price, t["price"])
    if mapping.stock:
        st = sql.js_number(mapping.stock, t["stock"])
        frac = f"(NOT isnan({st}) AND abs({st}) < 2147483648 AND {st} % 1.0 <> 0)"
        big = f"(NOT isnan({st}) AND abs({st}) >= 2147483648)"
    else:
        frac = big = "false"
    desc = sql.sanitize(mapping.description, t["description"])
    inner = (f"SELECT {mapping.id} AS _id, count(*) AS _n, "
             f"sum(CASE WHEN isnan({price}) THEN 1 ELSE 0 END) AS _nan, sum(CASE WHEN {frac} THEN 1 ELSE 0 END) AS _fr, "
             f"sum(CASE WHEN {big} THEN 1 ELSE 0 END) AS _bg, sum(CASE WHEN {desc} = '' THEN 1 ELSE 0 END) AS _em "
             f"FROM ({src}) GROUP BY {mapping.id}")
    return (f"SELECT '{ws}' AS workspace_id, CAST(sum(_n) AS BIGINT) AS total, "
            "CAST(COALESCE(sum(CASE WHEN _id IS NULL THEN _n END), 0) AS BIGINT) AS null_ids, "
            "CAST(COALESCE(sum(CASE WHEN _id IS NOT NULL THEN _n - 1 END), 0) AS BIGINT) AS duplicate_rows, "
            "CAST(sum(CASE WHEN _id IS NOT NULL AND _n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys, "
            "CAST(sum(_nan) AS BIGINT) AS nan_prices, CAST(sum(_fr) AS BIGINT) AS fractional_stock, "
            "CAST(sum(_bg) AS BIGINT) AS stock_out_of_range, CAST(sum(_em) AS BIGINT) AS empty_descriptions "
            f"FROM ({inner})")


DQ_SOURCES = [(fx.part_source, fx.PART_MAPPING, fx.WS_PART, sql.PART_SRC, sql.PART_TYPES),
              (fx.lineitem_source, fx.LINEITEM_MAPPING, fx.WS_LINEITEM, sql.LINEITEM_SRC, sql.LINEITEM_TYPES),
              (fx.text_source, fx.TEXT_MAPPING, fx.WS_TEXT, sql.TEXT_SRC, sql.TEXT_TYPES)]


@register("dq_report", " UNION ALL ".join(_dq_sql(m, t, ws, s) for _, m, ws, s, t in DQ_SOURCES))
def dq_report(spark, sf_dir):
    out = None
    for load, m, ws, _, _ in DQ_SOURCES:
        d = quality.dq_counts(load(spark, sf_dir), m, ws)
        out = d if out is None else out.unionByName(d)
    return out


# Fixed literal rows: the part source's mapped roles, ordinals and types.
PROFILE_ROWS = [("id", "p_partkey", 1, "bigint"), ("description", "p_name", 2, "string"),
                ("code", "p_partkey", 1, "bigint"), ("price", "p_retailprice", 6, "double"),
                ("manufactory", "p_brand", 3, "string"), ("stock", "p_size", 5, "int"),
                ("promotion_price", "p_promo", 7, "double"), ("need_prescription", "p_rx", 8, "int")]


@register("source_profile", " UNION ALL ".join(
    f"SELECT '{r}' AS role, '{c}' AS column_name, {o} AS ordinal_position, '{t}' AS data_type, "
    f"count({c}) AS non_null FROM ({sql.PART_SRC})" for r, c, o, t in PROFILE_ROWS))
def q_source_profile(spark, sf_dir):
    return quality.source_profile(fx.part_source(spark, sf_dir), fx.PART_MAPPING)


# ---------------------------------------------------------------- T1–T3

@register("stream_sync",
          "WITH ev AS (SELECT *, sha256(concat_ws('|', CAST(user_id AS VARCHAR), COALESCE(event_type, ''), "
          f"{sql.render('value', 'dbl')})) AS fp FROM events WHERE user_id IS NOT NULL), "
          "latest AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id "
          "ORDER BY ts DESC NULLS LAST, fp DESC) = 1) "
          f"SELECT '{fx.WS_EVENTS}' AS workspace_id, CAST(user_id AS VARCHAR) AS id, fp AS fingerprint, "
          f"{sql.sanitize('event_type')} AS description, {sql.js_or_empty('event_type', 'str')} AS code, "
          f"{sql.js_number('value', 'dbl')} * 100.0 AS price FROM latest")
def stream_sync(spark, sf_dir):
    """Events replayed as a snapshot stream (4 files, any order) through the
    streaming sync; the final state and target equal the latest snapshot of
    every key."""
    cfg = SyncConfig(fx.WS_EVENTS, fx.EVENTS_MAPPING, mode="full", order_by=fx.EVENTS_ORDER)
    store = run_stream_to_end(spark, fx.table(spark, sf_dir, "events"), scratch_path(spark, "stream"), cfg,
                              embedder=FunctionEmbedder(embed.hashing_embedder(16), 50))
    state = store.read("state").select("workspace_id", "id", "fingerprint")
    target = store.read("target").select("workspace_id", "id", "description", "code", "price")
    return state.join(target, ["workspace_id", "id"])


@register("stream_keyed", ORACLE["stream_sync"])
def stream_keyed(spark, sf_dir):
    """The same events through the stream that keeps each key's state itself:
    the newest change of every key, normalised, is what the sync holds."""
    cfg = SyncConfig(fx.WS_EVENTS, fx.EVENTS_MAPPING, mode="full", order_by=fx.EVENTS_ORDER)
    base, events = scratch_path(spark, "stream"), fx.table(spark, sf_dir, "events")
    write_snapshots(events, f"{base}/in")
    q = write_changes(keyed_changes(snapshot_stream(spark, f"{base}/in", events.schema), cfg), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    rows = latest_changes(spark.read.parquet(f"{base}/out"))
    return (normalize(rows, fx.AS_OF, keep=("workspace_id", "id", "fingerprint"))
            .select("workspace_id", "id", "fingerprint", "description", "code", "price"))
