"""Queries on landed pages, documents and printed figures."""

from pyspark.sql import functions as F

from ..functions import facts, numbers as num, text as tx
from ..operators.extract import carry_header, first_yielding as first_of_kind, quarantine as route, outer_elements
from ..operators.ordered import carry_last, first_per_key
from ..sources import landed
from .q_joins import WS_SQL, norm_sql
from .registry import query

def chrome_sql(c: str) -> str:
    """Comments, then each element by its own name, removed in turn."""
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', '', 'g')"
    for name in ("script", "style", "nav", "footer", "header", "aside"):
        c = f"regexp_replace({c}, '(?is)<{name}\\b.*?</{name}\\s*>', '', 'g')"
    return c


def collapse_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS_SQL}+', ' ', 'g'))"


def unescape_sql(c: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        c = f"replace({c}, '{a}', '{b}')"
    return c


@query(
    "scan_pages",
    f"""SELECT page_id, {unescape_sql(collapse_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title,
  octet_length(encode(html)) AS n_bytes FROM pages""",
)
def scan_pages(t):
    return t.pages.select(
        "page_id", tx.page_title(F.col("html")).alias("title"), F.octet_length("html").cast("bigint").alias("n_bytes")
    )


@query(
    "page_admissible",
    """SELECT page_id, octet_length(encode(html)) > 5000 AS ok,
  CASE WHEN NOT octet_length(encode(html)) > 5000 THEN 'inadmissible_response' END AS note FROM pages""",
)
def page_admissible(t):
    return landed.admissibility(t.pages, "html", landed.ARTICLE_MIN_BYTES).select("page_id", "ok", "note")


ANCHOR = r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'


@query(
    "listing_items",
    f"""WITH m AS (
  SELECT page_id, unnest(regexp_extract_all(html, '{ANCHOR}', 1)) AS id, unnest(regexp_extract_all(html, '{ANCHOR}', 2)) AS title,
    CAST(unnest(range(len(regexp_extract_all(html, '{ANCHOR}', 1)))) AS INTEGER) AS pos FROM pages)
SELECT page_id, pos, id, {collapse_sql("regexp_replace(title, '(?s)<[^>]*>', ' ', 'g')")} AS title FROM m QUALIFY row_number() OVER (PARTITION BY page_id, id ORDER BY pos) = 1""",
)
def listing_items(t):
    return landed.listing_items(t.pages, ["page_id"], "html", ANCHOR)


@query(
    "listing_merge",
    f"""WITH m AS (
  SELECT page_id, unnest(regexp_extract_all(html, '{ANCHOR}', 1)) AS id, unnest(regexp_extract_all(html, '{ANCHOR}', 2)) AS title,
    CAST(unnest(range(len(regexp_extract_all(html, '{ANCHOR}', 1)))) AS INTEGER) AS pos FROM pages)
SELECT page_id, pos, id, {collapse_sql("regexp_replace(title, '(?s)<[^>]*>', ' ', 'g')")} AS title FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY page_id, pos) = 1""",
)
def listing_merge(t):
    """Listings of all pages as one search: the first title of an id wins overall."""
    m = landed.listing_items(t.pages, ["page_id"], "html", ANCHOR)
    return first_per_key(m, ["id"], [F.col("page_id"), F.col("pos")])


@query(
    "json_props",
    """SELECT event_id, unnest(json_keys(props)) AS field, json_extract_string(props, '$.k') AS printed FROM events""",
)
def json_props(t):
    fields = F.from_json("props", "map<string,string>")
    return t.events.select("event_id", F.explode(fields).alias("field", "printed"))


@query(
    "json_round_trip",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS notes FROM events""",
)
def json_round_trip(t):
    p = F.from_json("props", "k bigint")
    return t.events.select(
        "event_id", p["k"].alias("k"), F.to_json(F.struct("event_type", p["k"].alias("k"))).alias("notes")
    )


MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "lineitems_long",
    """WITH w AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS obs_month, """
    + ", ".join(f"CAST(sum(CAST({m} AS DECIMAL(20,4))) AS DOUBLE) AS {m}" for m in MEASURES)
    + """ FROM lineitem GROUP BY 1)
SELECT obs_month, line_code, value FROM w UNPIVOT (value FOR line_code IN (l_quantity, l_extendedprice, l_discount, l_tax))""",
)
def lineitems_long(t):
    w = t.lineitem.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("obs_month")).agg(
        *[F.sum(num.money(F.col(m))).cast("double").alias(m) for m in MEASURES]
    )
    return landed.to_long(w, ["obs_month"], MEASURES)


@query(
    "lineitems_wide",
    """SELECT l_orderkey, """
    + ", ".join(
        f"CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) FILTER (l_returnflag = '{f}') AS DOUBLE) AS {f}" for f in "ANR"
    )
    + " FROM lineitem GROUP BY 1",
)
def lineitems_wide(t):
    long = t.lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("line_code")).agg(
        F.sum(num.money(F.col("l_extendedprice"))).cast("double").alias("value")
    )
    return landed.to_wide(long, ["l_orderkey"], "ANR")


FAMILIES = (("daily", r"/[a-z]{2}/(\d{2})(\d)(?:\D|$)"), ("monthly", r"/[a-z]{2}/(\d{2})(\d{2})(?:\D|$)"))


@query(
    "title_period",
    """WITH f AS (
  SELECT page_id, url, CASE WHEN regexp_matches(url, '/[a-z]{2}/(\\d{2})(\\d)(?:\\D|$)') THEN 'daily'
    WHEN regexp_matches(url, '/[a-z]{2}/(\\d{2})(\\d{2})(?:\\D|$)') THEN 'monthly' END AS family,
    coalesce(nullif(regexp_extract(url, '/[a-z]{2}/(\\d{2})(\\d)(?:\\D|$)', 1), ''), regexp_extract(url, '/[a-z]{2}/(\\d{2})(\\d{2})(?:\\D|$)', 1)) AS y,
    coalesce(nullif(regexp_extract(url, '/[a-z]{2}/(\\d{2})(\\d)(?:\\D|$)', 2), ''), regexp_extract(url, '/[a-z]{2}/(\\d{2})(\\d{2})(?:\\D|$)', 2)) AS m FROM pages)
SELECT page_id, family, try_cast((CAST(y AS INTEGER) + 1911) || '-' || lpad(m, 2, '0') || '-01' AS DATE) AS reference_month
FROM f WHERE family IS NOT NULL""",
)
def title_period(t):
    return landed.titled_periods(t.pages, "url", FAMILIES).select("page_id", "family", "reference_month")


URL_SQL = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)"


@query(
    "url_parts",
    f"""SELECT page_id, regexp_extract(url, '{URL_SQL}', 1) AS host,
  (regexp_extract(url, '{URL_SQL}', 1) = 'example.com' OR ends_with(regexp_extract(url, '{URL_SQL}', 1), '.example.com')) AS in_suffix,
  split_part(split_part(rtrim(url, '/'), '/', -1), '.', 1) AS source_id,
  substring(regexp_replace(regexp_replace(url, '^.*?//', ''), '[^A-Za-z0-9]+', '_', 'g'), 1, 120) AS safe_key,
  rtrim(url, '/') = url AS no_slash FROM pages""",
)
def url_parts(t):
    u = F.col("url")
    host = tx.url_host(u)
    return t.pages.select(
        "page_id",
        host.alias("host"),
        tx.host_has_suffix(host, "example.com").alias("in_suffix"),
        tx.url_last_id(u).alias("source_id"),
        tx.url_safe_key(u).alias("safe_key"),
        (F.rtrim(u, F.lit("/")) == u).alias("no_slash"),
    )


@query(
    "content_hash",
    """SELECT sha256(text) AS content_sha256, left(sha256(text), 16) AS short_hash, count(*) AS n_docs, min(doc_id) AS first_doc
FROM documents GROUP BY 1, 2""",
)
def content_hash(t):
    h = t.documents.select("doc_id", tx.content_hash(F.col("text")).alias("content_sha256"))
    return (
        h.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
        .withColumn("short_hash", F.substring("content_sha256", 1, 16))
    )


PARAGRAPH_SQL = unescape_sql(collapse_sql("regexp_replace(piece, '(?s)<[^>]*>', ' ', 'g')"))


@query(
    "page_paragraphs",
    f"""WITH pieces AS (
  SELECT page_id, unnest(regexp_split_to_array({chrome_sql('html')}, '(?i)<p(?:\\s[^>]*)?>')[2:]) AS piece FROM pages),
p AS (SELECT page_id, {PARAGRAPH_SQL} AS paragraph FROM pieces)
SELECT page_id, paragraph, count(*) AS n FROM p WHERE paragraph <> '' GROUP BY 1, 2""",
)
def page_paragraphs(t):
    p = t.pages.select("page_id", F.explode(tx.page_paragraphs(F.col("html"))).alias("paragraph"))
    return p.groupBy("page_id", "paragraph").agg(F.count(F.lit(1)).alias("n"))


@query(
    "header_carry_forward",
    f"""WITH b AS (
  SELECT page_id, unnest(list_transform(cut, lambda x: regexp_replace(x, '(?is)</(h1|li|p)\\b.*$', ''))) AS block, unnest(range(len(cut))) AS pos
  FROM (SELECT page_id, string_split(regexp_replace(html, '(?i)<(h1|li|p)\\b', chr(1) || '<\\1', 'g'), chr(1))[2:] AS cut
  FROM (SELECT page_id, regexp_replace(html, '(?is)<(script|style)\\b.*?</(script|style)>|<!--.*?-->', '', 'g') AS html FROM pages))),
k AS (
  SELECT page_id, pos, {collapse_sql("regexp_replace(block, '(?s)<[^>]*>', ' ', 'g')")} AS txt, block NOT ILIKE '<p%' AS is_header FROM b),
l AS (
  SELECT *, CASE WHEN is_header AND contains(txt, 'th') THEN 'en' WHEN is_header AND contains(txt, 'ou') THEN 'fr' END AS kw FROM k),
c AS (SELECT *, last_value(kw IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos) AS kind FROM l)
SELECT page_id, CAST(pos AS INTEGER) AS pos, kind FROM c WHERE NOT is_header""",
)
def header_carry_forward(t):
    clean = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->", "")
    blocks = t.pages.select(
        "page_id", F.posexplode(F.regexp_extract_all(clean, F.lit(r"(?is)<(?:h1|li|p)\b[^>]*>.*?(?=</?(?:h1|li|p)\b|\z)"), F.lit(0))).alias("pos", "block")
    ).withColumn("txt", tx.collapse_ws(tx.strip_tags(F.col("block"))))
    out = carry_header(
        blocks, ["page_id"], "pos", "txt", ~F.lower("block").startswith("<p"), [("th", "en"), ("ou", "fr")]
    )
    return out.filter(~F.col("is_header")).select("page_id", "pos", "kind")


@query(
    "event_header",
    """SELECT event_id, user_id, event_type,
  last_value(CASE WHEN event_type IN ('signup', 'error') THEN event_type END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kind FROM events""",
)
def event_header(t):
    """An event belongs to the nearest signup or error of its user before it."""
    e = t.events.select("event_id", "user_id", "event_type", "ts")
    out = carry_last(
        e, ["user_id"], ["ts", "event_id"], F.col("event_type").isin("signup", "error"), ["event_type"],
        F.date_trunc("hour", F.col("ts")),
    )
    return out.select("event_id", "user_id", "event_type", F.col("last_event_type").alias("kind"))


NUMERIC_SQL = r"^[（(]?[-－]?[0-9,]+(?:\.[0-9]+)?[)）]?$"


@query(
    "first_yielding",
    f"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
c AS (
  SELECT doc_id, pos, CASE WHEN contains(line, '@') THEN 'contact' WHEN contains(line, 'de') THEN 'romance' ELSE 'other' END AS kind,
    list_filter(string_split(line, ' '), lambda x: regexp_matches(x, '{NUMERIC_SQL}')) AS nums FROM l)
SELECT doc_id, kind, CAST(pos AS INTEGER) AS pos, CAST(len(nums) AS INTEGER) AS n_figures FROM c WHERE len(nums) > 0
QUALIFY row_number() OVER (PARTITION BY doc_id, kind ORDER BY pos) = 1""",
)
def first_yielding(t):
    kind = [("@", "contact"), ("de", "romance")]
    return first_of_kind(t.documents, ["doc_id"], F.split("text", "\n"), kind, "other").select(
        "doc_id", "kind", "pos", "n_figures"
    )


@query(
    "quarantine",
    """SELECT doc_id, CASE WHEN n_chars < 300 THEN 'body too short' WHEN NOT regexp_matches(text, '[0-9]') THEN 'no figure'
  WHEN lang NOT IN ('en', 'fr') THEN 'language not handled' END AS reject_reason FROM documents""",
)
def quarantine(t):
    return route(
        t.documents,
        [
            (F.col("n_chars") < 300, "body too short"),
            (~F.col("text").rlike("[0-9]"), "no figure"),
            (~F.col("lang").isin("en", "fr"), "language not handled"),
        ],
    ).select("doc_id", "reject_reason")


LABELS = (("hot", "thermal"), ("cold", "thermal"), ("ring", "fastener"), ("bolt", "fastener"), ("red", "colour"))
PREFIXES = {"ECO": "low", "STA": "mid", "PRO": "mid"}


@query(
    "classify_label",
    "SELECT p_partkey, CASE "
    + " ".join(f"WHEN contains(p_name, '{k}') THEN '{v}'" for k, v in LABELS)
    + " END AS label, CASE left(p_type, 3) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PREFIXES.items())
    + " END AS tier FROM part",
)
def classify_label(t):
    return t.part.select(
        "p_partkey",
        facts.first_label(F.col("p_name"), LABELS).alias("label"),
        facts.prefix_label(F.col("p_type"), PREFIXES).alias("tier"),
    )


@query(
    "squash_ws",
    f"""SELECT doc_id, length(regexp_replace(text, '{WS_SQL}+', '', 'g')) AS n, md5(regexp_replace(text, '{WS_SQL}+', '', 'g')) AS digest
FROM documents""",
)
def squash_ws(t):
    d = t.documents.select("doc_id", tx.squash_ws(F.col("text")).alias("s"))
    return d.select("doc_id", F.length("s").cast("bigint").alias("n"), F.md5("s").alias("digest"))


PARSE_SQL = f"""WITH tok AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents),
t AS (
  SELECT doc_id, token, regexp_replace(regexp_replace(token, '{WS_SQL}+', '', 'g'), '[,，]', '', 'g') AS s
  FROM tok),
i AS (SELECT *, regexp_replace(s, '^[（(](.*)[）)]$', '\\1') AS inn FROM t),
d AS (SELECT *, regexp_replace(inn, '^[-－負]', '') AS dig FROM i),
v AS (SELECT *, CASE WHEN regexp_matches(dig, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') THEN try_cast(dig AS DECIMAL(28,6)) END AS x FROM d)
SELECT doc_id, token, count(*) AS n,
  CAST(max(CASE WHEN inn <> s OR dig <> inn THEN -x ELSE x END) AS DOUBLE) AS value FROM v GROUP BY 1, 2"""


@query("parse_number", PARSE_SQL)
def parse_number(t):
    """Words are counted within their row; only rows that share their id meet in a shuffle of words."""
    docs = t.documents.select("doc_id", "text")
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(F.col("doc_id").alias("shared_id"))
    same = F.col("doc_id").eqNullSafe(F.col("shared_id"))
    alone = tx.counted_parts(docs.join(shared, same, "left_anti"), ["doc_id"], F.split("text", " "), "token")
    several = tx.counted_parts(docs.join(shared, same, "left_semi"), ["doc_id"], F.split("text", " "), "token")
    n = alone.unionByName(several.groupBy("doc_id", "token").agg(F.sum("n").alias("n")))
    return n.withColumn("value", num.parse_number(F.col("token")).cast("double"))


@query(
    "numeric_cells",
    f"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
c AS (
  SELECT doc_id, pos, list_filter(string_split(line, ' '), lambda x: regexp_matches(x, '{NUMERIC_SQL}') OR x IN ('-', '－', '—')) AS cells FROM l),
n AS (
  SELECT doc_id, pos, len(cells) AS n_cells, list_transform(cells, lambda x: CASE WHEN regexp_matches(x, '^[（(]') OR regexp_matches(x, '^[（(]?[-－]') THEN -1 ELSE 1 END
    * try_cast(regexp_replace(x, '[（()）,－-]', '', 'g') AS DECIMAL(28,6))) AS v FROM c WHERE len(cells) > 0)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(n_cells AS INTEGER) AS n_cells, CAST(v[1] AS DOUBLE) AS first_value,
  CAST(CASE WHEN n_cells >= 2 THEN v[2] END AS DOUBLE) AS second_value FROM n""",
)
def numeric_cells(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = lines.withColumn("v", num.numeric_cells(F.split("line", " "))).filter(F.size("v") > 0)
    three = num.pad_three(F.col("v"))
    return rows.select(
        "doc_id", "pos", F.size("v").alias("n_cells"), F.get("v", 0).cast("double").alias("first_value"),
        three["b"].cast("double").alias("second_value"),
    )


@query(
    "scale_units",
    """WITH p AS (
  SELECT o_orderkey, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders)
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN (v // 1000) || 'K' WHEN 'O' THEN (v // 100000) || 'M' || (v % 100000) || 'K' ELSE (v % 100) || '%' END AS printed,
  CAST(CASE o_orderstatus WHEN 'F' THEN (v // 1000) * 1000 WHEN 'O' THEN (v // 100000) * 1000000 + (v % 100000) * 1000 ELSE CAST((v % 100) AS DOUBLE) / 100 END AS DOUBLE) AS value
FROM p""",
)
def scale_units(t):
    v = F.floor("o_totalprice").cast("bigint")

    def text(c):
        return c.cast("string")

    def whole(c, by):
        return F.floor(c / by).cast("bigint").cast("string")

    printed = (
        F.when(F.col("o_orderstatus") == "F", F.concat(whole(v, 1000), F.lit("K")))
        .when(F.col("o_orderstatus") == "O", F.concat(whole(v, 100000), F.lit("M"), text(v % 100000), F.lit("K")))
        .otherwise(F.concat(text(v % 100), F.lit("%")))
    )
    o = t.orders.select("o_orderkey", printed.alias("printed"))
    return o.withColumn("value", num.scale_units(F.col("printed"), "fraction", {"M": 1_000_000, "K": 1000}, "U").cast("double"))


@query(
    "decimal_text",
    """WITH d AS (SELECT o_orderkey, CAST(CAST(o_totalprice - 200000 AS DECIMAL(20,4)) AS VARCHAR) AS s FROM orders)
SELECT o_orderkey, CASE WHEN contains(s, '.') THEN regexp_replace(s, '\\.?0+$', '') ELSE s END AS txt FROM d""",
)
def decimal_text(t):
    d = (F.col("o_totalprice") - 200000).cast("decimal(20,4)")
    return t.orders.select("o_orderkey", num.decimal_text(d).alias("txt"))


SPECS = (
    facts.FactSpec("first_octet", r"([0-9]{1,3})\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    facts.FactSpec("account", r"([0-9]{16})"),
    facts.FactSpec("line_number", r"(\+1|-) \(([0-9]{3})\)", 2, 100, 1, {"+1": -1}),
    facts.FactSpec("mail_number", r"([a-z]+)\.([0-9]+)@mail[0-9]", 2, unless="th"),
)


@query(
    "extract_facts",
    r"""WITH d AS (
  SELECT doc_id, regexp_extract(text, '([0-9]{1,3})\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}', 1) AS a, regexp_extract(text, '([0-9]{16})', 1) AS b,
    regexp_extract(text, '(\+1|-) \(([0-9]{3})\)', 2) AS c, regexp_extract(text, '(\+1|-) \(([0-9]{3})\)', 1) AS cs,
    regexp_extract(text, '([a-z]+)\.([0-9]+)@mail[0-9]', 2) AS e, regexp_extract(text, '([a-z]+)\.([0-9]+)@mail[0-9]', 0) AS ep FROM documents)
SELECT doc_id, CAST(try_cast(a AS DECIMAL(20,4)) AS DOUBLE) AS first_octet, CAST(try_cast(b AS DECIMAL(20,4)) AS DOUBLE) AS account,
  CAST(try_cast(c AS DECIMAL(20,4)) * CASE WHEN cs = '+1' THEN -100 ELSE 100 END AS DOUBLE) AS line_number,
  CASE WHEN contains(ep, 'th') THEN NULL ELSE CAST(try_cast(e AS DECIMAL(20,4)) AS DOUBLE) END AS mail_number,
  CAST(coalesce(try_cast(a AS DECIMAL(20,4)), -try_cast(b AS DECIMAL(20,4))) AS DOUBLE) AS with_fallback,
  concat_ws('; ', CASE WHEN a = '' THEN 'address not found' END, CASE WHEN contains(ep, 'th') THEN 'mail number suppressed' END) AS warnings
FROM d""",
)
def extract_facts(t):
    got = facts.extract_facts(t.documents, F.col("text"), SPECS)
    w = facts.warnings_array(
        [
            (F.col("first_octet").isNull(), "address not found"),
            (facts.phrase_of("mail_number").contains("th"), "mail number suppressed"),
        ]
    )
    return got.select(
        "doc_id",
        *[F.col(s.name).cast("double").alias(s.name) for s in SPECS],
        F.coalesce(F.col("first_octet"), -F.col("account")).cast("double").alias("with_fallback"),
        F.array_join(w, "; ").alias("warnings"),
    )


@query(
    "parse_bound",
    """WITH b AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN '>' WHEN 'click' THEN '<=' WHEN 'error' THEN '約' ELSE '' END || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '%' AS printed, event_type, value FROM events)
SELECT event_id, printed, CASE event_type WHEN 'view' THEN '>' WHEN 'click' THEN '<=' WHEN 'error' THEN '約' END AS bound,
  CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS value FROM b""",
)
def parse_bound(t):
    op = (
        F.when(F.col("event_type") == "view", ">").when(F.col("event_type") == "click", "<=")
        .when(F.col("event_type") == "error", "約").otherwise("")
    )
    printed = F.concat(op, F.col("value").cast("decimal(10,2)").cast("string"), F.lit("%"))
    e = t.events.select("event_id", printed.alias("printed"))
    return e.select(
        "event_id", "printed", num.bound_operator(F.col("printed")).alias("bound"),
        num.bound_value(F.col("printed")).cast("double").alias("value"),
    )


@query(
    "expected_status",
    """WITH p AS (
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) * 6 AS status, CASE WHEN event_type = 'error' THEN 300 END AS expect,
    CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS tier FROM events)
SELECT event_id, status, CASE WHEN expect IS NOT NULL THEN status = expect ELSE status >= 200 AND status < 400 END AS ok
FROM p WHERE tier <= 3""",
)
def expected_status(t):
    tier = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    p = t.events.select(
        "event_id",
        (F.from_json("props", "k bigint")["k"] * 6).alias("status"),
        F.when(F.col("event_type") == "error", F.lit(300)).alias("expect"),
        tier.alias("tier"),
    ).filter(F.col("tier") <= 3)
    return p.select("event_id", "status", landed.status_expected(F.col("status"), F.col("expect")).alias("ok"))


@query(
    "literal_boundary",
    f"""WITH d AS (
  SELECT doc_id, {norm_sql('text')} AS t, CAST(n_chars % 100 AS VARCHAR) AS v, text FROM documents)
SELECT doc_id, CASE WHEN v = '0' THEN contains(text, '0') ELSE contains(t, v) END AS plain,
  CASE WHEN v = '0' THEN contains(text, '0') ELSE regexp_matches(t, '(?:^|[^0-9.])' || v || '(?:$|[^0-9])') END AS bounded FROM d""",
)
def literal_boundary(t):
    d = t.documents.select(
        "doc_id", "text", (F.col("n_chars") % 100).cast("string").alias("printed"), tx.text_norm(F.col("text")).alias("norm")
    )
    args = (F.col("printed"), F.col("text"))
    return d.select(
        "doc_id",
        tx.literal_in_text(*args, normalised=F.col("norm")).alias("plain"),
        tx.literal_in_text(*args, boundary=True, normalised=F.col("norm")).alias("bounded"),
    )


_NESTED = ("nav", "ul", "article", "div")


@query(
    "outer_tables",
    r"""WITH h AS (SELECT page_id, regexp_replace(html, '<(/?)(nav|ul|article|div)\b', '<\1table', 'g') AS html FROM pages),
m AS (SELECT page_id, string_split(regexp_replace(regexp_replace(html, '(<table\b)', chr(1) || '\1', 'g'), '(</table>)', '\1' || chr(1), 'g'), chr(1)) AS ps FROM h),
p AS (SELECT page_id, unnest(range(len(ps))) AS no, unnest(ps) AS piece FROM m),
t AS (SELECT *, CASE WHEN piece LIKE '<table%' THEN 1 ELSE 0 END AS o, CASE WHEN piece LIKE '%</table>' THEN 1 ELSE 0 END AS c FROM p),
n AS (SELECT *, sum(o - c) OVER w AS net FROM t WINDOW w AS (PARTITION BY page_id ORDER BY no)),
a AS (SELECT *, net - least(0, min(net) OVER (PARTITION BY page_id ORDER BY no)) AS after FROM n),
b AS (SELECT *, coalesce(lag(after) OVER (PARTITION BY page_id ORDER BY no), 0) AS before FROM a),
e AS (SELECT *, before + o AS level, sum(CASE WHEN o = 1 AND before = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY no) AS element_no FROM b)
SELECT page_id, CAST(element_no AS BIGINT) AS element_no, CAST(count(DISTINCT level) AS INTEGER) AS n_layers, sha256(string_agg(piece, '' ORDER BY no)) AS html_sha256,
  CAST(sum(length(piece)) FILTER (level = 1) AS INTEGER) AS own_chars
FROM e WHERE level > 0 GROUP BY 1, 2""",
)
def outer_tables(t):
    """Outermost elements of pages whose containers are read as tables, and what lies in them besides inner ones."""
    named = F.regexp_replace("html", rf"<(/?)({'|'.join(_NESTED)})\b", "<$1table")
    found = outer_elements(t.pages.select("page_id", named.alias("html")), "page_id", "html", "table")
    return found.select(
        "page_id", "element_no", F.size("layers").alias("n_layers"), F.sha2(F.col("html").cast("binary"), 256).alias("html_sha256"),
        F.length(F.element_at("layers", 1)).alias("own_chars"),
    )
