"""DuckDB SQL that restates each registered query independently of Spark.

These strings are the correctness oracle only: the driver runs them next to
the Spark plans on the same parquet tables.  The helpers build the SQL text
for one mapped source; they mirror the rules in ``shelfsync.functions``.
"""

from __future__ import annotations

from shelfsync.config import ColumnMapping

# Fixed values, written out here so that a wrong pattern in the library shows.
JS_WS = (r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}")
JS_NUMBER_RE = r"^[+-]?(Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)$"
TITLE_LINE_RE = f"(?m)^Title:[{JS_WS}]([^\\n]+)"
TITLE_REJECT_RE = "(?i)Product Not Found|Access denied"
TITLE_NOISE_RE = f"(?i)(EAN[{JS_WS}]*\\d+[{JS_WS}]*[-–—]?[{JS_WS}]*|[-–—]?[{JS_WS}]*Go-UPC[{JS_WS}]*)"
TITLE_DASH_RE = "[-–—]"

AS_OF_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
STALE_SQL = "TIMESTAMP '2023-12-31 23:00:00'"       # AS_OF - 60 minutes
PROMO_END_SQL = "TIMESTAMP '2033-12-29 00:00:00'"    # AS_OF + 3650 days

# Column type classes of the driver tables and derived sources.
PART_TYPES = {"p_partkey": "int", "p_name": "str", "p_brand": "str", "p_type": "str",
              "p_size": "int", "p_retailprice": "dbl", "p_promo": "dbl", "p_rx": "int"}
SUPPLIER_TYPES = {"s_suppkey": "int", "s_name": "str", "s_nationkey": "int", "s_acctbal": "dbl"}
CUSTOMER_TYPES = {"c_custkey": "int", "c_name": "str", "c_nationkey": "int", "c_acctbal": "dbl",
                  "c_mktsegment": "str"}
TEXT_TYPES = {"t_id": "str", "t_desc": "str", "t_code": "int", "t_price": "str", "t_display": "str",
              "t_manu": "str", "t_stock": "str", "t_promo": "str", "t_rx": "str"}

PART_SRC = ("SELECT *, CASE p_partkey % 6 WHEN 0 THEN CAST(NULL AS DOUBLE) WHEN 1 THEN p_retailprice "
            "WHEN 2 THEN 0.0 WHEN 3 THEN p_retailprice - 100 WHEN 4 THEN p_retailprice + 10 "
            "ELSE p_retailprice * 0.5 END AS p_promo, CAST(p_size % 3 AS INTEGER) AS p_rx FROM part")

TEXT_SRC = """SELECT CAST(p_partkey AS VARCHAR) AS t_id, p_name AS t_desc,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE p_partkey * 1000 + 7 END AS t_code,
  CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc'
       WHEN 3 THEN ' ' || CAST(p_retailprice AS VARCHAR) || chr(9)
       WHEN 4 THEN CAST(p_retailprice AS VARCHAR) || 'e0' ELSE CAST(p_retailprice AS VARCHAR) END AS t_price,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand || ' – ' || p_name END AS t_display,
  CASE WHEN p_partkey % 3 = 1 THEN '' ELSE p_brand END AS t_manu,
  CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN 'abc' WHEN 2 THEN NULL ELSE '2.75' END AS t_stock,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(p_retailprice AS VARCHAR) WHEN 2 THEN '0'
       WHEN 3 THEN '12.5' ELSE 'x1' END AS t_promo,
  CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE NULL END AS t_rx
FROM part"""


# All components of a vector, in millionths.
VECTOR_DIGEST = ("CASE WHEN embedding IS NOT NULL THEN sha256(array_to_string("
                 "[CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT) FOR x IN embedding], ',')) END")


def js_trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{JS_WS}]+|[{JS_WS}]+$', '', 'g')"


def render_double(x: str) -> str:
    return (f"(CASE WHEN isnan({x}) THEN 'NaN' WHEN isinf({x}) AND {x} > 0 THEN 'Infinity' "
            f"WHEN isinf({x}) THEN '-Infinity' "
            f"WHEN abs({x}) < 9007199254740992 AND round({x}) = {x} THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END)")


def js_string(x: str, t: str) -> str:
    if t == "str":
        return x
    if t == "int":
        return f"CAST({x} AS VARCHAR)"
    if t == "dbl":
        return render_double(x)
    if t == "bool":
        return f"(CASE WHEN {x} THEN '1' ELSE '0' END)"
    raise ValueError(t)


def render(x: str, t: str) -> str:
    return f"COALESCE({js_string(x, t)}, '')"


def js_number(x: str, t: str) -> str:
    if t in ("int", "dbl"):
        return f"COALESCE(CAST({x} AS DOUBLE), 0.0)"
    if t == "bool":
        return f"(CASE WHEN {x} THEN 1.0 ELSE 0.0 END)"
    tr = js_trim(x)
    return (f"(CASE WHEN {x} IS NULL OR {tr} = '' THEN 0.0 "
            f"WHEN regexp_matches({tr}, '{JS_NUMBER_RE}') THEN TRY_CAST({tr} AS DOUBLE) "
            f"ELSE CAST('NaN' AS DOUBLE) END)")


def is_falsy(x: str, t: str) -> str:
    cond = {"str": f"{x} IS NULL OR {x} = ''",
            "dbl": f"{x} IS NULL OR {x} = 0 OR isnan({x})",
            "int": f"{x} IS NULL OR {x} = 0",
            "bool": f"{x} IS NULL OR NOT {x}"}[t]
    return f"COALESCE(({cond}), true)"


def js_or_empty(x: str, t: str) -> str:
    return f"(CASE WHEN {is_falsy(x, t)} THEN '' ELSE {js_string(x, t)} END)"


def sanitize(x: str, t: str = "str") -> str:
    text = f"COALESCE({x}, '')" if t == "str" else js_or_empty(x, t)
    return (f"trim(regexp_replace(regexp_replace({text}, '[^a-zA-Z0-9{JS_WS}]', '', 'g'), "
            f"'[{JS_WS}]+', ' ', 'g'))")


def fingerprint(mapping: ColumnMapping, types: dict) -> str:
    parts = ", ".join(render(c, types[c]) for c in mapping.source_columns())
    return f"sha256(concat_ws('|', {parts}))"


def keyed(mapping: ColumnMapping, types: dict, workspace: str, src: str) -> str:
    """SELECT list of the keyed source (workspace_id, id, k, fingerprint, r_<role>)."""
    roles = ", ".join(f"{c} AS r_{r}" for r, c in mapping.roles())
    idc = mapping.id
    return (f"SELECT '{workspace}' AS workspace_id, {js_string(idc, types[idc])} AS id, "
            f"TRY_CAST({idc} AS BIGINT) AS k, {fingerprint(mapping, types)} AS fingerprint, {roles} "
            f"FROM {src} WHERE {idc} IS NOT NULL")


def normalized(mapping: ColumnMapping, types: dict, src: str, keep: str = "workspace_id, id") -> str:
    """SELECT producing the canonical product columns from a keyed CTE."""
    t = {r: types[c] for r, c in mapping.roles()}
    price = f"{js_number('r_price', t['price'])} * 100.0"
    promo = (f"{js_number('r_promotion_price', t['promotion_price'])} * 100.0"
             if mapping.promotion_price else "CAST(NULL AS DOUBLE)")
    disp = sanitize("r_display_name", t["display_name"]) if mapping.display_name else "NULL"
    manu = js_or_empty("r_manufactory", t["manufactory"]) if mapping.manufactory else "''"
    if mapping.stock:
        n = js_number("r_stock", t["stock"])
        n0 = f"(CASE WHEN isnan({n}) THEN 0.0 ELSE {n} END)"
        stock = f"(CASE WHEN abs({n0}) < 2147483648 THEN CAST(trunc({n0}) AS INTEGER) END)"
    else:
        stock = "CAST(0 AS INTEGER)"
    if not mapping.need_prescription:
        flag = "false"
    elif t["need_prescription"] == "bool":
        flag = "COALESCE(r_need_prescription, false)"
    elif t["need_prescription"] in ("int", "dbl"):
        flag = "COALESCE(CAST(r_need_prescription AS DOUBLE) = 1, false)"
    else:
        flag = "false"
    inner = (f"SELECT {keep}, {sanitize('r_description', t['description'])} AS description, {disp} AS _display, "
             f"{js_or_empty('r_code', t['code'])} AS code, {manu} AS manufactory, {price} AS price, "
             f"{promo} AS _promo, {stock} AS stock, {flag} AS need_prescription FROM {src}")
    on = "COALESCE(_promo IS NOT NULL AND _promo <> 0 AND NOT isnan(_promo) AND (isnan(price) OR _promo <> price), false)"
    display = "_display" if mapping.display_name else "description"
    return (f"SELECT {keep}, description, {display} AS display_name, code, manufactory, price, "
            f"CASE WHEN {on} THEN _promo END AS promotion_price, "
            f"CASE WHEN {on} THEN {AS_OF_SQL} END AS promotion_start, "
            f"CASE WHEN {on} THEN {PROMO_END_SQL} END AS promotion_end, stock, need_prescription "
            f"FROM ({inner})")


def prior_state(src: str = "keyed") -> str:
    return (f"SELECT workspace_id, id, CASE WHEN k % 7 = 0 THEN 'x' ELSE fingerprint END AS s_fp, "
            f"{AS_OF_SQL} - to_minutes(CAST((k * 13) % 120 AS BIGINT)) AS s_at FROM {src} WHERE k % 5 <> 0")


def classified(src: str = "keyed", state: str = "state") -> str:
    return (f"SELECT {src}.*, {state}.id IS NOT NULL AS known, COALESCE(s_fp = fingerprint, false) AS same, "
            f"COALESCE(s_at > {STALE_SQL}, false) AS fresh FROM {src} LEFT JOIN {state} "
            f"ON {src}.workspace_id = {state}.workspace_id AND {src}.id = {state}.id")


STATUS = "CASE WHEN known THEN 'changed' ELSE 'new' END"
REASON = "CASE WHEN NOT known THEN 'new' WHEN NOT same THEN 'hash' WHEN NOT fresh THEN 'stale' ELSE 'forced' END"
SKIP = {"quick": "known AND fresh AND same", "full": "known AND same", "force": "false"}


def title_sql(page: str) -> str:
    """Looked-up title from page text (extraction, rejection, cleaning)."""
    raw = f"regexp_extract({page}, '{TITLE_LINE_RE}', 1)"
    title = js_trim(raw)
    stripped = js_trim(f"regexp_replace(regexp_replace({title}, '{TITLE_NOISE_RE}', '', 'g'), '{TITLE_DASH_RE}', '', 'g')")
    return (f"(CASE WHEN {raw} <> '' AND NOT regexp_matches({title}, '{TITLE_REJECT_RE}') "
            f"AND {stripped} <> '' THEN {stripped} END)")


LINEITEM_TYPES = {"li_key": "str", "li_desc": "str", "l_orderkey": "int", "l_extendedprice": "dbl",
                  "l_quantity": "dbl"}
LINEITEM_SRC = ("SELECT *, CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS li_key, "
                "'Line ' || CAST(l_linenumber AS VARCHAR) || ' ' || l_returnflag || l_linestatus AS li_desc "
                "FROM lineitem")
PAGES_SRC = ("SELECT CAST(page_id AS VARCHAR) AS code, 'Title: ' || "
             "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) || chr(10) || 'URL Source: ' || "
             "COALESCE(url, '') || chr(10) AS page FROM pages")

PRODUCT_DATA = ["description", "display_name", "code", "manufactory", "price", "promotion_price",
                "promotion_start", "promotion_end", "stock", "need_prescription"]


def titles_cte() -> str:
    return (f"pages_t AS ({PAGES_SRC}), titles AS (SELECT code, min(title) AS title FROM "
            f"(SELECT code, {title_sql('page')} AS title FROM pages_t) WHERE title IS NOT NULL GROUP BY code)")


def outcome_ctes(mapping: ColumnMapping, types: dict, mode: str) -> str:
    """proc → norm → enr → emb → outc, over cls (see classified())."""
    return (f"proc AS (SELECT *, {STATUS} AS status FROM cls WHERE NOT ({SKIP[mode]})), "
            f"norm AS ({normalized(mapping, types, 'proc', keep='workspace_id, id, k, fingerprint, status')}), "
            f"{titles_cte()}, "
            "enr AS (SELECT norm.* REPLACE (CASE WHEN status = 'new' AND titles.title IS NOT NULL "
            "AND titles.title <> '' THEN titles.title ELSE display_name END AS display_name), "
            "CASE WHEN status = 'new' THEN titles.title END AS title FROM norm LEFT JOIN titles ON norm.code = titles.code), "
            "emb AS (SELECT enr.*, CASE WHEN status = 'new' THEN e.embedding END AS embedding FROM enr "
            "LEFT JOIN embeddings e ON enr.status = 'new' AND enr.id = CAST(e.vec_id AS VARCHAR)), "
            "outc AS (SELECT *, CASE WHEN status = 'new' AND embedding IS NOT NULL THEN 'upsert' "
            "WHEN status = 'new' THEN 'drop' ELSE 'update' END AS action FROM emb)")


def prior_target_cte(mapping: ColumnMapping, types: dict) -> str:
    inner = normalized(mapping, types, "(SELECT * FROM keyed WHERE k % 5 <> 0 AND k % 3 <> 0)",
                       keep="workspace_id, id")
    return (f"tgt AS (SELECT * REPLACE (price - 1 AS price, 1.0 AS promotion_price), "
            f"[CAST(CAST(id AS BIGINT) AS FLOAT)] AS embedding FROM ({inner}))")


def merged_sql(changes: str) -> str:
    cols = ", ".join(f"CASE WHEN c.action IS NOT NULL THEN c.{x} ELSE t.{x} END AS {x}" for x in PRODUCT_DATA)
    return (f"SELECT COALESCE(t.workspace_id, c.workspace_id) AS workspace_id, COALESCE(t.id, c.id) AS id, {cols}, "
            "CASE WHEN c.action = 'upsert' THEN c.embedding ELSE t.embedding END AS embedding "
            f"FROM tgt t FULL OUTER JOIN ({changes}) c ON t.workspace_id = c.workspace_id AND t.id = c.id "
            "WHERE t.id IS NOT NULL OR c.action = 'upsert'")


def target_view(src: str) -> str:
    cols = ", ".join(PRODUCT_DATA)
    return (f"SELECT workspace_id, id, {cols}, CAST(len(embedding) AS INTEGER) AS embedding_dim, "
            f"{VECTOR_DIGEST} AS embedding_sha256 FROM ({src})")
