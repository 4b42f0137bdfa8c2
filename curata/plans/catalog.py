"""Registered queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Every query reads the driver tables under ``sf_dir`` (through the stand-ins of
``plans.standins``) over whole tables and whole texts, and returns a lazy
DataFrame.  Computed columns carry the same names in Spark and in SQL.
Timestamps leave as epoch microseconds (``*_us``) so both engines print alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import durations as D
from curata.functions import text as X
from curata.functions.html import main_text
from curata.functions.traces import strip_trace
from curata.operators import dedup, folders
from curata.plans import standins as S
from curata.sources.readers import ledger_keys
from curata.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- SQL helpers
def sql_normalize_url(x: str) -> str:
    """The P1 rewrite chain as nested DuckDB ``regexp_replace``, its patterns written out here."""
    for pattern, repl in [("[?&](utm_[^&]+|fbclid|gclid|mc_[^&]+)=[^&]*", ""), ("[?&]sid=[^&]*", ""), ("/#.*$", ""),
                          ("^http://", "https://"), (r"^https://www\.", "https://"), (r"/\?$", ""), ("/$", ""), (r"\?$", "")]:
        x = f"regexp_replace({x}, '{pattern}', '{repl}', 'g')"
    return f"regexp_replace(lower({x}), '^\\s+|\\s+$', '', 'g')"


def sql_clean(x: str) -> str:
    """P2 in DuckDB."""
    return f"""regexp_replace(trim(replace(
    regexp_replace(regexp_replace(strip_accents(
      regexp_replace({x}, '\\x1B(?:[@-Z\\\\-_]|\\[[0-?]*[ -/]*[@-~])', '', 'g')),
      '[^\\x00-\\x7F]', '', 'g'), '[\\x00-\\x1F\\x7F]', '', 'g'),
    '"', '\'\'')), '\\s+', ' ', 'g')"""


def sql_lines(x: str) -> str:
    """The lines of a text without blank ones, trimmed, runs of spaces squeezed."""
    return f"""array_to_string(list_filter(list_transform(string_split({x}, chr(10)),
      lambda x: regexp_replace(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), ' {{2,}}', ' ', 'g')),
    lambda x: x <> ''), chr(10))"""


def sql_us(x: str) -> str:
    return f"epoch_us({x})"


def us(df: DataFrame, c: str) -> "F.Column":
    return D.epoch_us(F.col(c), df.schema[c].dataType)


# --------------------------------------------------------------------------- folders
@register("folder_counts", S.sql_with("node", "sfi") + """
SELECT n.node_id, n.title, count(s.item_id) AS n_items
FROM node n LEFT JOIN sfi s ON n.node_id = s.node_id
WHERE n.type = 'vfolder' AND n.title ILIKE '%search%'
GROUP BY n.node_id, n.title""")
def q_folder_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return folders.folder_counts(S.node(t), S.membership(t))


@register("folder_ordinals", S.sql_with("node", "sfi") + """
, c AS (SELECT n.node_id, n.title, count(s.item_id) AS n_items
        FROM node n LEFT JOIN sfi s ON n.node_id = s.node_id
        WHERE n.type = 'vfolder' AND n.title ILIKE '%search%'
        GROUP BY n.node_id, n.title)
SELECT row_number() OVER (ORDER BY title, node_id) AS ordinal, node_id, title, n_items FROM c""")
def q_folder_ordinals(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return folders.folder_listing(folders.folder_counts(S.node(t), S.membership(t)))


@register("folder_items", S.sql_with("node", "sfi", "items") + f"""
SELECT s.node_id, n.title, i.item_id, i.source AS url, {sql_us('i.updated')} AS updated_us
FROM sfi s JOIN node n ON n.node_id = s.node_id JOIN items i ON i.item_id = s.item_id
WHERE n.type = 'vfolder' AND n.title ILIKE '%search%'""")
def q_folder_items(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fi = folders.folder_items(folders.saved_searches(S.node(t)), S.membership(t), S.items(t))
    return fi.select("node_id", "title", "item_id", "url", us(fi, "updated").alias("updated_us"))


# --------------------------------------------------------------------------- URL keys and dedup
@register("url_normalized", S.sql_with("items") + f"""
SELECT item_id, source AS url, {sql_normalize_url('source')} AS url_norm FROM items""")
def q_url_normalized(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return S.items(t).select("item_id", F.col("source").alias("url"), X.normalize_url("source").alias("url_norm"))


_SQL_KEEP_FIRST = f"""
, normed AS (
  SELECT s.node_id, i.item_id, i.source AS url, i.updated, {sql_normalize_url('i.source')} AS url_norm
  FROM sfi s JOIN items i ON i.item_id = s.item_id
  WHERE i.source IS NOT NULL AND i.source <> ''),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY node_id, url_norm
                               ORDER BY updated DESC NULLS LAST, item_id) AS rn
  FROM normed WHERE url_norm <> ''),
kept AS (SELECT node_id, url_norm, url, item_id FROM ranked WHERE rn = 1)
"""


def _kept(t: Tables) -> DataFrame:
    fi = S.membership(t).join(S.items(t).withColumnRenamed("source", "url"), "item_id")
    return dedup.keep_first(dedup.with_url_norm(fi), ["node_id"]).select("node_id", "url_norm", "url", "item_id")


@register("url_dedup_keep_first", S.sql_with("sfi", "items") + _SQL_KEEP_FIRST + "SELECT * FROM kept")
def q_url_dedup_keep_first(spark, sf_dir):
    return _kept(Tables(spark, sf_dir))


@register("pending_urls", S.sql_with("sfi", "items", "ledger") + _SQL_KEEP_FIRST + f"""
SELECT k.* FROM kept k
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE {sql_normalize_url('l.url')} = k.url_norm)""")
def q_pending_urls(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return dedup.pending(_kept(t), ledger_keys(S.ledger(t)))


# --------------------------------------------------------------------------- text
# Injected alike on both sides: an ANSI colour sequence, a tab and double quotes.
def _inject():
    return F.concat(F.col("text"), F.lit("\x1b[31m red\x1b[0m\t\"quoted\"  "))
_SQL_INJECT = "text || chr(27) || '[31m red' || chr(27) || '[0m' || chr(9) || '\"quoted\"  '"


@register("text_cleaned", f"SELECT doc_id, {sql_clean(_SQL_INJECT)} AS cleaned FROM documents")
def q_text_cleaned(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", X.clean_text(_inject()).alias("cleaned"))


# (text before, text after, what is left before): around every whole turn, as rows of its own.
_SHAPES = [
    ("<think>\nplan\n</think>\n", "", ""),                         # closed
    ("", "\n<THINK>\nplan\nmore", ""),                            # never closed
    ("<think>x</think>\ngone\na </think> b\n", "", ""),           # the end is looked for from the next line on
    ("Think...\nplan\nDone thinking.\n", "", ""),
    ("thinking...\nplan\ndone thinking.\n", "", ""),
    ("<think>\nthink...\n</think>\ndone thinking.\n", "", "done thinking."),  # a deleted line opens nothing
    ("thinking...\nthink...\ndone thinking.\nstill\ndone thinking.\n", "", ""),  # one range inside another
    ("  Thinking  \n\n a  b \n", "", "a b"),
    ("", "", ""),
]


def _sql_str(x: str) -> str:
    return "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_SQL_TRACE_LEFT = "CASE shape " + " ".join(f"WHEN {i} THEN {_sql_str(left)}" for i, (_, _, left) in enumerate(_SHAPES)) + " END"


@register("trace_removed", f"""
SELECT conv_id, turn, shape,
  concat_ws(chr(10), nullif({_SQL_TRACE_LEFT}, ''), nullif({sql_lines('text')}, '')) AS cleaned
FROM conversations, range(0, {len(_SHAPES)}) s(shape)""")
def q_trace_removed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    shapes = F.array(*[F.struct(F.lit(i).cast("long").alias("shape"), F.lit(b).alias("b"), F.lit(a).alias("a"))
                       for i, (b, a, _) in enumerate(_SHAPES)])
    rows = t.conversations.select("conv_id", "turn", "text", F.explode(shapes).alias("s"))
    return rows.select("conv_id", "turn", "s.shape", strip_trace(F.concat("s.b", "text", "s.a")).alias("cleaned"))


@register("folder_slug", """
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[^\\pL\\pN_]', '_', 'g'), '_+', '_', 'g'),
                              '^_+|_+$', '', 'g') AS slug
FROM documents""")
def q_folder_slug(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", X.slug("text").alias("slug"))


@register("cache_key", "SELECT page_id, url, md5(url) AS url_key FROM pages")
def q_cache_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.pages.select("page_id", "url", X.url_key("url").alias("url_key"))


@register("tagline_cut", """
SELECT doc_id,
  CASE WHEN length(text) > 280 THEN substr(text, 1, 277) || '...' ELSE text END AS tagline,
  substr(text, 1, 2000) AS body, substr(text, 1, 1500) AS prompt_body
FROM documents""")
def q_tagline_cut(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.documents.select(
        "doc_id", X.cut("text").alias("tagline"),
        X.limit_chars("text", X.BODY_LIMIT).alias("body"),
        X.limit_chars("text", X.PROMPT_BODY_LIMIT).alias("prompt_body"))


# Posts: promotion padded and with a link, so strip and the link-free length matter.
@register("post_ready", """
WITH p AS (
  SELECT doc_id,
    regexp_replace('  ' || text || ' https://example.org/' || CAST(doc_id AS VARCHAR) || ' ', '^\\s+|\\s+$', '', 'g') AS promotion,
    'https://example.org/' || CAST(doc_id AS VARCHAR) AS url
  FROM documents)
SELECT doc_id, promotion || chr(10) || url AS post,
  length(regexp_replace(promotion, 'https?://\\S+', '', 'g')) AS link_free_len,
  CASE WHEN length(regexp_replace(promotion, 'https?://\\S+', '', 'g')) <= 257 THEN 'ready' ELSE 'too_long' END AS status
FROM p""")
def q_post_ready(spark, sf_dir):
    from curata.operators.publish import posts
    t = Tables(spark, sf_dir)
    url = F.concat(F.lit(S.EXAMPLE_URL), F.col("doc_id").cast("string"))
    raw = t.documents.select(
        "doc_id", F.concat(F.lit("  "), F.col("text"), F.lit(" "), url, F.lit(" ")).alias("promotion"),
        F.concat(url, F.lit(" ")).alias("url"))
    return posts(raw).select("doc_id", "post", "link_free_len", "status")


# Posts numbered in file order (the order key is the row's position, here doc_id),
# counting rows that fail the length gate too.
@register("post_order", """
SELECT row_number() OVER (ORDER BY doc_id) AS row_num, doc_id,
  CASE WHEN length(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 'https?://\\S+', '', 'g')) <= 257
       THEN 'ready' ELSE 'too_long' END AS status
FROM documents""")
def q_post_order(spark, sf_dir):
    from curata.operators.ordering import ordinal
    from curata.operators.publish import posts
    t = Tables(spark, sf_dir)
    p = posts(t.documents.select("doc_id", F.col("text").alias("promotion"), F.lit("").alias("url")))
    return ordinal(p.select("doc_id", "status"), ["doc_id"], name="row_num")


@register("text_previews", """
SELECT doc_id, substr(text, 1, 50) AS p50, substr(text, 1, 60) AS p60, substr(text, 1, 80) AS p80,
       substr(text, 1, 200) AS p200 FROM documents""")
def q_text_previews(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", *[X.limit_chars("text", n).alias(f"p{n}") for n in (50, 60, 80, 200)])


# --------------------------------------------------------------------------- durations
@register("duration_text", """
WITH d AS (SELECT event_id, value * 1000 AS s FROM events
           UNION ALL SELECT event_id + 1000000000, value FROM events
           UNION ALL SELECT event_id + 2000000000, value * 100000 FROM events),
p AS (SELECT event_id, s,
        CAST(floor((s - s % 604800) / 604800) AS BIGINT) AS w,
        CAST(floor(((s % 604800) - (s % 604800) % 86400) / 86400) AS BIGINT) AS dd,
        CAST(floor(((s % 86400) - (s % 86400) % 3600) / 3600) AS BIGINT) AS h,
        CAST(floor(((s % 3600) - (s % 3600) % 60) / 60) AS BIGINT) AS m,
        CAST(floor(s % 60) AS BIGINT) AS c,
        CAST(round_even((s - floor(s)) * 1000, 0) AS BIGINT) AS ms
      FROM d),
q AS (SELECT *, CASE WHEN ms = 0 THEN CAST(c AS VARCHAR) || 's' ELSE printf('%d.%03ds', c, ms) END AS st FROM p)
SELECT event_id, s AS seconds,
  CASE WHEN w > 0 THEN printf('%dw %dd %dh %dm ', w, dd, h, m) || st
       WHEN dd > 0 THEN printf('%dd %dh %dm ', dd, h, m) || st
       WHEN h > 0 THEN printf('%dh %dm ', h, m) || st
       WHEN m > 0 THEN CASE WHEN c > 0 OR ms > 0 THEN printf('%dm ', m) || st ELSE printf('%dm', m) END
       ELSE st END AS duration
FROM q""")
def q_duration_text(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = t.events
    d = (ev.select("event_id", (F.col("value") * 1000).alias("seconds"))
         .unionByName(ev.select((F.col("event_id") + 1000000000).alias("event_id"), F.col("value").alias("seconds")))
         .unionByName(ev.select((F.col("event_id") + 2000000000).alias("event_id"),
                                (F.col("value") * 100000).alias("seconds"))))
    return d.select("event_id", "seconds", D.duration_text("seconds").alias("duration"))


@register("elapsed_text", """
WITH d AS (SELECT event_id, CAST(floor(value * 1000) AS BIGINT) AS s FROM events)
SELECT event_id, s AS elapsed_s,
  CASE WHEN s // 86400 > 0 THEN printf('%dd %dh %dm %ds', s // 86400, (s % 86400) // 3600, (s % 3600) // 60, s % 60)
       WHEN (s % 86400) // 3600 > 0 THEN printf('%dh %dm %ds', (s % 86400) // 3600, (s % 3600) // 60, s % 60)
       WHEN (s % 3600) // 60 > 0 THEN printf('%dm %ds', (s % 3600) // 60, s % 60)
       ELSE printf('%ds', s % 60) END AS elapsed
FROM d""")
def q_elapsed_text(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.events.select("event_id", F.floor(F.col("value") * 1000).cast("long").alias("elapsed_s"))
    return d.select("event_id", "elapsed_s", D.elapsed_text("elapsed_s").alias("elapsed"))


# --------------------------------------------------------------------------- pages
@register("page_main_text", """
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS inner_html FROM pages),
parts AS (SELECT page_id, list_transform(regexp_split_to_array(inner_html, '<[^>]*>'),
            lambda p: trim(replace(replace(p, '&quot;', '"'), '&amp;', '&'), ' ' || chr(10) || chr(9) || chr(13))) AS ps
          FROM a)
SELECT page_id, substr(array_to_string(ps, ''), 1, 2000) AS main_text FROM parts""")
def q_page_main_text(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.pages.select("page_id", main_text("html").alias("main_text"))


# --------------------------------------------------------------------------- generation replies
# Every event's own reply, and reply shapes as further rows: missing field, malformed
# JSON, null, false, blank text, and a reasoning block with no answer after it.
_REPLIES = ['{"other": 1}', "not json", '{"k": null}', '{"k": false}', '{"k": "  "}', '{"k": "<think>\\nplan\\n</think>\\n"}']


@register("response_parsed", f"""
WITH r AS (SELECT event_id, -1 AS shape, props AS reply FROM events
           UNION ALL SELECT event_id, i, (['{"', '".join(x.replace("'", "''") for x in _REPLIES)}'])[i + 1] FROM events, range(0, {len(_REPLIES)}) s(i)),
j AS (SELECT event_id, shape, CASE WHEN json_valid(reply) AND json_type(reply) = 'OBJECT' THEN reply END AS js FROM r),
v AS (SELECT event_id, shape, json_type(js, '$.k') AS typ, json_extract_string(js, '$.k') AS txt FROM j),
o AS (SELECT event_id, shape,
        typ IS NOT NULL AND typ <> 'NULL' AND NOT (typ = 'BOOLEAN' AND txt = 'false') AS ok,
        CASE WHEN strpos(txt, '<think>') > 0 THEN ''
             ELSE array_to_string(list_filter(list_transform(string_split(txt, chr(10)),
                    lambda x: regexp_replace(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), ' {{2,}}', ' ', 'g')),
                    lambda x: x <> ''), chr(10)) END AS cleaned
      FROM v)
SELECT event_id, shape,
  CASE WHEN NOT ok THEN NULL WHEN cleaned = '' THEN '[Error: No summary generated]' ELSE cleaned END AS response,
  CASE WHEN NOT ok THEN 'invalid_response' WHEN cleaned = '' THEN 'empty' ELSE 'ok' END AS status
FROM o""")
def q_response_parsed(spark, sf_dir):
    from curata.operators.generate import finish_text, parse_response
    t = Tables(spark, sf_dir)
    shapes = F.array(*[F.struct(F.lit(i).cast("long").alias("shape"), F.lit(x).alias("reply"))
                       for i, x in [(-1, None), *enumerate(_REPLIES)]])
    rows = t.events.select("event_id", "props", F.explode(shapes).alias("s"))
    r = rows.select("event_id", "s.shape", parse_response(F.coalesce("s.reply", "props"), "k").alias("r"))
    # One column per stage, so each costly expression is computed once per row.
    r = r.select("event_id", "shape", F.col("r.status").alias("parsed"), strip_trace("r.text").alias("clean"))
    r = r.select("event_id", "shape", "parsed", finish_text("clean").alias("fin"))
    ok = F.col("parsed") == "ok"
    return r.select("event_id", "shape",
                    F.when(ok, F.col("fin.text")).alias("response"),
                    F.when(ok, F.col("fin.status")).otherwise(F.col("parsed")).alias("status"))


# --------------------------------------------------------------------------- publishing
@register("publish_status", """
WITH m AS (SELECT source AS folder, text AS promotion FROM documents
    UNION ALL SELECT source, CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 11 = 0 THEN 'Error: ' || text ELSE 'Reject: ' || text END
      FROM documents WHERE doc_id % 13 = 0 OR doc_id % 11 = 0 OR doc_id % 7 = 0)
SELECT folder, CASE WHEN promotion IS NULL OR promotion = '' OR strpos(promotion, 'Error') > 0 THEN 'error'
                    WHEN starts_with(promotion, 'Reject:') THEN 'rejected' ELSE 'published' END AS status,
       count(*) AS n
FROM m GROUP BY ALL""")
def q_publish_status(spark, sf_dir):
    from curata.operators.publish import classify, run_summary
    t = Tables(spark, sf_dir)
    return run_summary(classify(S.outcome_mix(t)))


@register("model_filter", "SELECT DISTINCT p_name AS model FROM part WHERE NOT regexp_matches(p_name, 'small|old')")
def q_model_filter(spark, sf_dir):
    from curata.operators.generate import filter_models
    return filter_models(S.models(Tables(spark, sf_dir)), S.MODEL_SKIP)


# --------------------------------------------------------------------------- reconcile
_SQL_SIDES = """
, l AS (SELECT '  ' || promotion || ' ' AS promotion, url || ' ' AS url FROM promotions WHERE doc_id % 10 <> 1
        UNION ALL
        SELECT '  ' || promotion || ' ', url || ' ' FROM promotions WHERE doc_id % 10 <> 1 AND doc_id % 3 = 0),
r AS (SELECT promotion, url FROM promotions WHERE doc_id % 10 <> 2),
ls AS (SELECT DISTINCT regexp_replace(promotion, '^\\s+|\\s+$', '', 'g') AS promotion,
                       regexp_replace(url, '^\\s+|\\s+$', '', 'g') AS url FROM l),
rs AS (SELECT DISTINCT regexp_replace(promotion, '^\\s+|\\s+$', '', 'g') AS promotion,
                       regexp_replace(url, '^\\s+|\\s+$', '', 'g') AS url FROM r),
sides AS (SELECT CASE WHEN ls.url IS NOT NULL AND rs.url IS NOT NULL THEN 'both'
                      WHEN ls.url IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side,
                 coalesce(ls.promotion, rs.promotion) AS promotion, coalesce(ls.url, rs.url) AS url
          FROM ls FULL JOIN rs ON ls.promotion IS NOT DISTINCT FROM rs.promotion AND ls.url IS NOT DISTINCT FROM rs.url)
"""


@register("reconcile_sides", S.sql_with("promotions") + _SQL_SIDES + "SELECT * FROM sides")
def q_reconcile_sides(spark, sf_dir):
    from curata.operators.reconcile import reconcile
    return reconcile(*S.reconcile_sides(Tables(spark, sf_dir)))


@register("reconcile_changes", S.sql_with("promotions") + _SQL_SIDES + "SELECT * FROM sides")
def q_reconcile_changes(spark, sf_dir):
    """X1 by bucket digests: texts are exchanged only where the sides differ."""
    from curata.operators.reconcile import reconcile_by_bucket
    return reconcile_by_bucket(*S.reconcile_sides(Tables(spark, sf_dir)))


@register("reconcile_summary", S.sql_with("promotions") + _SQL_SIDES + """
SELECT (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
  count(*) FILTER (WHERE side = 'left_only') AS left_only,
  count(*) FILTER (WHERE side = 'right_only') AS right_only,
  count(*) FILTER (WHERE side = 'both') AS matching,
  count(*) FILTER (WHERE side <> 'both') = 0 AND (SELECT count(*) FROM l) > 0 AS identical
FROM sides""")
def q_reconcile_summary(spark, sf_dir):
    from curata.operators.reconcile import verdict
    return verdict(*S.reconcile_sides(Tables(spark, sf_dir)))


@register("reconcile_sample", S.sql_with("promotions") + _SQL_SIDES + """
, ranked AS (SELECT side, promotion, url,
               row_number() OVER (PARTITION BY side ORDER BY promotion, url) AS ordinal,
               count(*) OVER (PARTITION BY side) AS total
             FROM sides WHERE side <> 'both')
SELECT side, ordinal, substr(promotion, 1, 50) AS promotion, substr(url, 1, 50) AS url,
       greatest(total - 5, 0) AS n_more
FROM ranked WHERE ordinal <= 5""")
def q_reconcile_sample(spark, sf_dir):
    from curata.operators.reconcile import reconcile, sample
    return sample(reconcile(*S.reconcile_sides(Tables(spark, sf_dir))))


@register("duplicate_keys", """
SELECT 'https://example.org/' || CAST(doc_id // 2 AS VARCHAR) AS url, lang AS folder_name, count(*) AS n
FROM documents GROUP BY ALL HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    from curata.operators.reconcile import duplicate_keys
    t = Tables(spark, sf_dir)
    load = t.documents.select(
        F.concat(F.lit(S.EXAMPLE_URL), F.expr("doc_id div 2").cast("string")).alias("url"),
        F.col("lang").alias("folder_name"))
    return duplicate_keys(load)


# --------------------------------------------------------------------------- cache and repeats
@register("cache_state", f"""
WITH c AS (SELECT md5(p.url) AS url_key, f.fetched_at
           FROM (SELECT user_id, min(ts) AS fetched_at FROM events GROUP BY user_id) f
           JOIN pages p ON p.page_id = f.user_id),
j AS (SELECT a.page_id, a.url, md5(a.url) AS url_key,
        (epoch_us(TIMESTAMP '{S.NOW}') // 1000000 - epoch_us(c.fetched_at) // 1000000) // 3600 AS age_h
      FROM pages a LEFT JOIN c ON c.url_key = md5(a.url))
SELECT page_id, url, url_key, age_h,
  CASE WHEN age_h IS NULL THEN 'miss' WHEN age_h < 24 THEN 'fresh' ELSE 'stale' END AS cache,
  CASE WHEN age_h IS NULL THEN 'fetch' WHEN age_h < 24 THEN 'repeated' ELSE 'refresh' END AS action
FROM j""")
def q_cache_state(spark, sf_dir):
    from curata.operators.repeats import cache_state
    t = Tables(spark, sf_dir)
    st = cache_state(t.pages.select("page_id", "url"), S.cache(t), S.NOW)
    return st.select("page_id", "url", "url_key", "age_h", "cache", "action")


@register("repeat_suppressed", """
WITH RECURSIVE e AS (
  SELECT event_id, user_id, event_type, ts,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events),
walk AS (
  SELECT user_id, event_type, rn, event_id, ts, ts AS anchor, true AS kept FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.event_type, e.rn, e.event_id, e.ts,
         CASE WHEN epoch_us(e.ts) - epoch_us(w.anchor) >= 86400000000 THEN e.ts ELSE w.anchor END,
         epoch_us(e.ts) - epoch_us(w.anchor) >= 86400000000
  FROM walk w JOIN e ON e.user_id = w.user_id AND e.event_type = w.event_type AND e.rn = w.rn + 1)
SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us FROM walk WHERE kept""")
def q_repeat_suppressed(spark, sf_dir):
    from curata.operators.repeats import suppress_repeats
    t = Tables(spark, sf_dir)
    ev = t.events.select("event_id", "user_id", "event_type", "ts")
    kept = suppress_repeats(ev, ["user_id", "event_type"], "ts", "event_id")
    return kept.select("event_id", "user_id", "event_type", us(kept, "ts").alias("ts_us"))


# --------------------------------------------------------------------------- E1 end to end
_SQL_BODY = """list_transform(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>'),
            lambda p: trim(replace(replace(p, '&quot;', '"'), '&amp;', '&'), ' ' || chr(10) || chr(9) || chr(13)))"""


_SQL_CURATED = S.sql_with("node", "sfi", "items", "ledger", "fetched") + f"""
, normed AS (
  SELECT s.node_id, n.title, i.item_id, i.page_id, i.source AS url, i.updated,
         {sql_normalize_url('i.source')} AS url_norm
  FROM sfi s JOIN node n ON n.node_id = s.node_id JOIN items i ON i.item_id = s.item_id
  WHERE n.type = 'vfolder' AND n.title ILIKE '%search%' AND i.source IS NOT NULL AND i.source <> ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY node_id, url_norm ORDER BY updated DESC NULLS LAST, item_id) AS rn
           FROM normed WHERE url_norm <> ''),
todo AS (SELECT * FROM ranked k WHERE rn = 1
         AND NOT EXISTS (SELECT 1 FROM ledger l WHERE {sql_normalize_url('l.url')} = k.url_norm)),
first AS (SELECT *, row_number() OVER (PARTITION BY url_norm ORDER BY title, node_id) AS nth FROM todo),
art AS (SELECT t.*, CASE WHEN p.page_id IS NOT NULL THEN array_to_string({_SQL_BODY}, '') END AS body
        FROM first t LEFT JOIN fetched p ON p.page_id = t.page_id WHERE nth = 1),
gen AS (SELECT *, CASE WHEN body IS NULL THEN ''
                       WHEN length(body) % 11 = 0 THEN 'Error: generation failed'
                       WHEN length(body) % 7 = 0 THEN 'Reject: not news'
                       ELSE 'Summary ' || substr(md5(body), 1, 12) || ' of ' || CAST(length(body) AS VARCHAR)
                            || ' characters.' END AS promotion
        FROM art),
done AS (SELECT *, CASE WHEN body IS NULL THEN 'failed' WHEN strpos(promotion, 'Error') > 0 THEN 'error' WHEN starts_with(promotion, 'Reject:') THEN 'rejected'
       ELSE 'published' END AS status FROM gen)"""

_SQL_CURATED_ROWS = _SQL_CURATED + """
SELECT node_id, title, item_id, url, url_norm, promotion, status, length(promotion) AS n_chars, length(promotion) > 257 AS over_length
FROM done
UNION ALL
SELECT f.node_id, f.title, f.item_id, f.url, f.url_norm, NULL,
  CASE WHEN d.status = 'published' THEN 'already_published' ELSE 'deferred' END, NULL, NULL
FROM first f JOIN done d ON d.url_norm = f.url_norm WHERE f.nth > 1"""


@register("curated_batch", _SQL_CURATED_ROWS)
def q_curated_batch(spark, sf_dir):
    from curata.plans.curate import curate, digest_generator
    t = Tables(spark, sf_dir)
    out = curate(S.node(t), S.membership(t), S.items(t), S.ledger(t), S.fetched(t), digest_generator)
    return out.select("node_id", "title", "item_id", "url", "url_norm", "promotion", "status",
                      F.col("n_chars").cast("long").alias("n_chars"), "over_length")


# --------------------------------------------------------------------------- stream forms in the gate
def _scratch(spark: SparkSession, name: str) -> str:
    import uuid
    from curata.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/curata-{name}-{uuid.uuid4().hex}"


def _batches(spark, events: DataFrame, batch, n: int, base: str) -> DataFrame:
    """Events as a file stream of ``n`` micro-batches, one file each, in the order of ``batch``."""
    staged = events.select("event_id", "user_id", "event_type", "ts")
    for b in range(n):  # written one after another: the source takes files by age
        staged.where(batch == b).coalesce(1).write.parquet(f"{base}/in/b={b}")
    return spark.readStream.schema(staged.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")


def _t1(spark, src: DataFrame, base: str) -> DataFrame:
    from curata.streaming.repeats import start_repeats_stream
    q = start_repeats_stream(src, ["user_id", "event_type"], "ts", "event_id", f"{base}/out",
                             f"{base}/state", f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    kept = spark.read.parquet(f"{base}/out").where("status = 'passed'")
    return kept.select("event_id", "user_id", "event_type", us(kept, "ts").alias("ts_us"))


@register("repeat_suppressed_stream", ORACLE["repeat_suppressed"])
def q_repeat_suppressed_stream(spark, sf_dir):
    """T1 as a stream of three micro-batches in event time: the same rows as in one batch."""
    t = Tables(spark, sf_dir)
    base = _scratch(spark, "t1-stream")
    t_us = us(t.events, "ts")
    a, b = t.events.select(t_us.alias("t")).agg(F.percentile_approx("t", [0.33, 0.66])).first()[0]
    batch = F.when(t_us <= a, 0).when(t_us <= b, 1).otherwise(2)
    return _t1(spark, _batches(spark, t.events, batch, 3, base), base)


# Arrival order: the batches one after another, (time, id) inside each; a row before the
# anchor or less than 24 h after it is a repeat.
@register("repeat_suppressed_arrivals", ORACLE["repeat_suppressed"].replace("ORDER BY ts, event_id", "ORDER BY event_id % 3, ts, event_id"))
def q_repeat_suppressed_arrivals(spark, sf_dir):
    """T1 as a stream of three micro-batches that each span all of the time: most rows come late."""
    t = Tables(spark, sf_dir)
    base = _scratch(spark, "t1-arrivals")
    return _t1(spark, _batches(spark, t.events, F.pmod(F.col("event_id"), F.lit(3)), 3, base), base)


@register("repeat_suppressed_state_stream", ORACLE["repeat_suppressed"])
def q_repeat_suppressed_state_stream(spark, sf_dir):
    """T1 as a stream without keyed state: foreachBatch runs the batch algorithm per
    micro-batch and keeps the anchors in a versioned table (skew-safe per batch)."""
    t = Tables(spark, sf_dir)
    # A glob, so the file source lists the one file (a plain file path is taken as its base folder).
    src = (spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events.parque[t]")
           .select("event_id", "user_id", "event_type", "ts"))
    return _t1(spark, src, _scratch(spark, "t1-state"))


def _seeded_ledger(spark, t: Tables, path: str) -> None:
    from curata.sources.sinks import append_ledger
    append_ledger(S.ledger(t).select(F.lit(None).cast("string").alias("promotion"), "url",
                                     F.lit(None).cast("string").alias("folder_name"),
                                     F.lit(None).cast("double").alias("duration_s"), F.lit(None).cast("string").alias("worker"),
                                     X.normalize_url("url").alias("url_norm")), path)


def _body_from(pages: DataFrame):
    """The fetch stand-in: page table, spread, then main text; an article without a page has no body."""
    spread = pages.sparkSession.sparkContext.defaultParallelism

    def body(todo: DataFrame) -> DataFrame:
        return (todo.join(pages.select("page_id", "html"), "page_id", "left").repartition(spread, F.xxhash64("title", "url_norm"))
                .withColumn("body", F.when(F.col("html").isNotNull(), main_text("html", limit=None))).drop("html"))
    return body


@register("published_ledger", _SQL_CURATED.replace("LEFT JOIN fetched p", "LEFT JOIN pages p")
          + "SELECT promotion, url, title AS folder_name FROM done WHERE status = 'published'")
def q_published_ledger(spark, sf_dir):
    """T2 + S7: the incremental publishing step run twice over the saved-search
    articles, with all pages, against a seeded ledger; the second run must add nothing."""
    from curata.operators.folders import folder_items, saved_searches
    from curata.plans.curate import digest_generator
    from curata.streaming.publish import process_batch
    t = Tables(spark, sf_dir)
    base = _scratch(spark, "t2")
    ledger_path, results_path = f"{base}/ledger", f"{base}/results"
    _seeded_ledger(spark, t, ledger_path)
    fi = folder_items(saved_searches(S.node(t)), S.membership(t), S.items(t))
    body = _body_from(t.pages)
    process_batch(fi, 0, ledger_path, results_path, digest_generator, prepare=body)
    process_batch(fi, 1, ledger_path, results_path, digest_generator, prepare=body)
    led = spark.read.parquet(ledger_path)
    return led.where(F.col("promotion").isNotNull()).select("promotion", "url", "folder_name")


# What the first batch leaves unpublished comes up in the second, which has no articles of its
# own and finds every page.
@register("published_retries", _SQL_CURATED + f"""
, later AS (SELECT d.url_norm, d.title, length(array_to_string({_SQL_BODY}, '')) AS n
            FROM done d JOIN pages p ON p.page_id = d.page_id WHERE d.status <> 'published')
SELECT 0 AS batch_id, url_norm, title, status FROM done
UNION ALL
SELECT 1, url_norm, title, CASE WHEN n % 11 = 0 THEN 'error' WHEN n % 7 = 0 THEN 'rejected' ELSE 'published' END FROM later""")
def q_published_retries(spark, sf_dir):
    """T2 with its retry table, as a stream of two micro-batches."""
    from curata.operators.folders import folder_items, saved_searches
    from curata.plans.curate import digest_generator
    from curata.streaming.publish import process_batch
    t = Tables(spark, sf_dir)
    base = _scratch(spark, "t2-retries")
    _seeded_ledger(spark, t, f"{base}/ledger")
    fi = folder_items(saved_searches(S.node(t)), S.membership(t), S.items(t))
    for batch, (rows, pages) in enumerate([(fi, S.fetched(t)), (fi.where(F.lit(False)), t.pages)]):
        process_batch(rows, batch, f"{base}/ledger", f"{base}/results", digest_generator, prepare=_body_from(pages), retry_path=f"{base}/retries")
    return spark.read.parquet(f"{base}/results").select("batch_id", "url_norm", "title", "status")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


from curata.plans import roundtrips  # noqa: E402, F401 - registers its queries here
