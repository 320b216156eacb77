"""SQL for DuckDB that gives what each query gives, written from the rules and not from the plans."""

from shopgrain import fixed_values as V
from workload import tables as W
from workload.queries import (
    EVENT_KEY,
    ITEM_LIMIT,
    LINE_KEY,
    LINE_ORDER,
    PAGE_LIMIT,
    PAGE_STEP,
    UNNUMBERED,
)

WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]"
)


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({columns}))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def blank_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def slug(x: str) -> str:
    joined = f"regexp_replace(lower({strip(x)}), '{WS}+', '_', 'g')"
    return f"regexp_replace({joined}, '[^a-z0-9_]+', '', 'g')"


def table_name(x: str) -> str:
    clean = strip(f"coalesce({x}, '')")
    words = f"regexp_replace(lower({clean}), '[^a-z0-9]+', '_', 'g')"
    base = f"coalesce(nullif(trim({words}, '_'), ''), '{V.FALLBACK_TABLE}')"
    digit = f"regexp_matches({base}, '^[0-9]')"
    return f"substr(CASE WHEN {digit} THEN 't_' || {base} ELSE {base} END, 1, 63)"


def sheet_base(x: str) -> str:
    clean = strip(f"coalesce({x}, '')")
    legal = rf"regexp_replace({clean}, '[:\\/?*\[\]]+', ' ', 'g')"
    squeezed = f"regexp_replace({legal}, '{WS}+', ' ', 'g')"
    return f"substr(coalesce({blank_null(squeezed)}, '{V.FALLBACK_SHEET}'), 1, 31)"


def label(text: str, rows) -> str:
    """CASE over the dictionary; a miss gives the text."""
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in rows)
    return f"coalesce(CASE {slug(text)} {whens} END, {text})"


def translated(text: str) -> str:
    whens = " ".join(
        f"WHEN {_text(k.strip())} THEN {blank_null(_text(v))}"
        for k, v in W.TRANSLATIONS
        if v is not None
    )
    key = blank_null(text)
    return f"coalesce(CASE {key} {whens} END, {key}, {text})"


def converted(price: str, rate: float | None) -> str:
    if rate is None:
        return f"CAST(round({price}, 2) AS DECIMAL(18,2))"
    return f"CAST(round({price} * CAST('{rate}' AS DECIMAL(18,6)), 2) AS DECIMAL(18,2))"


def dash(source: str, by: str) -> str:
    return f"""SELECT {by} AS category, count(title) AS item_count,
        CASE WHEN count(price) > 0 THEN CAST(sum(price) AS DOUBLE) / count(price) END AS avg_price,
        CAST(sum(CASE WHEN low_stock THEN 1 ELSE 0 END) AS BIGINT) AS low_stock_count
        FROM {source} GROUP BY {by}"""


RATING_WORD_BY_SIZE = " ".join(
    f"WHEN {i} THEN '{w}'" for i, w in enumerate(["Zero", *V.RATING_NUMBERS])
)
RATING_NUMBER = " ".join(f"WHEN '{w}' THEN {n}" for w, n in V.RATING_NUMBERS.items())
RATING_WORDS = ", ".join(f"'{w}'" for w in V.RATING_NUMBERS)

OFFERS = f"""offers AS (
    SELECT p_partkey AS ord,
        CASE WHEN p_partkey % 23 = 0 THEN NULL
             ELSE chr(160) || ' ' || p_name || chr(9) END AS title,
        CASE WHEN p_partkey % 29 = 0 THEN 'n/a'
             WHEN p_partkey % 7 = 0
             THEN '£' || replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',')
             ELSE '£' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_text,
        'star-rating ' || CASE p_size % 6 {RATING_WORD_BY_SIZE} END AS rating_class,
        CASE WHEN p_partkey % 31 = 0 THEN 'Out of stock'
             ELSE 'In stock' || chr(10) || '(' || (p_size % 20) || ' available)'
        END AS availability,
        CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_type END AS category,
        CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN ''
             ELSE 'catalogue/part-' || p_partkey END AS url,
        CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN ''
             ELSE 'catalogue/' || replace(p_name, ' ', '-') || '/' || p_brand END AS shared_url
    FROM part)"""

PRICE_TEXT = strip("replace(replace(price_text, '£', ''), ',', '.')")
RECORDS = rf"""{OFFERS}, records AS (
    SELECT ord, url, shared_url, {blank_null("title")} AS title_src,
        CASE WHEN regexp_full_match({PRICE_TEXT}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)')
             THEN TRY_CAST({PRICE_TEXT} AS DECIMAL(18,4)) END AS price_src,
        list_filter(string_split_regex(rating_class, '\s+'), lambda w: w IN ({RATING_WORDS}))[1]
            AS rating_word,
        {blank_null("availability")} AS availability,
        TRY_CAST(nullif(regexp_extract(availability, '\(([0-9]+)\s+available\)', 1), '') AS BIGINT)
            AS stock,
        {blank_null("category")} AS category
    FROM offers), rated AS (
    SELECT *, CAST(CASE rating_word {RATING_NUMBER} END AS INTEGER) AS rating,
        coalesce(stock < 5, false) AS low_stock FROM records)"""

ITEMS = f"""{RECORDS}, items AS (
    SELECT *, {translated("title_src")} AS title, {converted("price_src", W.RATE)} AS price,
        {label("category", W.LABELS)} AS category_label
    FROM rated)"""

SHOP = f"""{OFFERS.replace("' || chr(10) || '(", " (")}, {RECORDS[len(OFFERS) + 2 :]}, shop AS (
    SELECT * REPLACE (category || ' & Co' AS category,
        '{W.SHOP_ROOT}part-' || ord || '/index.html' AS url) FROM rated), items AS (
    SELECT * REPLACE (ord + 1 AS ord), {translated("title_src")} AS title,
        {converted("price_src", W.RATE)} AS price,
        {label("category", W.LABELS)} AS category_label FROM shop)"""

ITEM_COLUMNS = """title, title_src, CAST(price AS DOUBLE) AS price,
    CAST(price_src AS DOUBLE) AS price_src, rating_word, rating, availability, stock, low_stock,
    category, category_label, url, ord"""


def sheets(source: str, column: str) -> str:
    """CTEs that end in ``named(label, sheet)``: made names draw from lists of free numbers."""
    ctes = f"""labels AS (
        SELECT DISTINCT {column} AS label FROM {source} WHERE {strip(column)} <> ''), bases AS (
        SELECT label, {sheet_base("label")} AS base FROM labels), firsts AS (
        SELECT label, base, base IN ('{V.ALL_SHEET}', '{V.DASHBOARD_SHEET}')
            OR label <> min(label) OVER (PARTITION BY base) AS clash FROM bases), kept AS (
        SELECT label, base AS sheet FROM firsts WHERE NOT clash), rest2 AS (
        SELECT label, base FROM firsts WHERE clash)"""
    rounds = (2, 3, 4)
    for d in rounds:
        low, high, stem = 2 if d == 2 else 10 ** (d - 1), 10**d, f"substr(base, 1, {30 - d})"
        ctes += f""", want{d} AS (
        SELECT label, base, {stem} AS stem, row_number() OVER (PARTITION BY {stem} ORDER BY label)
            AS r FROM rest{d}), free{d} AS (
        SELECT stem, n, row_number() OVER (PARTITION BY stem ORDER BY n) AS r
        FROM (SELECT DISTINCT stem FROM want{d}) CROSS JOIN range({low}, {high}) t(n)
        WHERE stem || '_' || n NOT IN (SELECT sheet FROM kept)), made{d} AS (
        SELECT label, w.stem || '_' || n AS sheet FROM want{d} w JOIN free{d} USING (stem, r)),
        rest{d + 1} AS (SELECT label, base FROM want{d} ANTI JOIN made{d} USING (label))"""
    made = " ".join(f"UNION ALL SELECT * FROM made{d}" for d in rounds)
    return f"{ctes}, named AS (SELECT * FROM kept {made})"


EVENTS = f"""e AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        ts < TIMESTAMP '{W.CUT}' AS early FROM events)"""
EVENT_ITEMS = f"""{EVENTS}, event_items AS (
    SELECT early, event_type AS title, CAST(value AS DECIMAL(18,2)) AS price, k < 5 AS low_stock,
        user_id || ' ' || k AS category FROM e)"""
STAMP = W.RUN_TS.isoformat(sep=" ")
NEXT_STAMP = W.RUN_TS.replace(day=W.RUN_TS.day + 1).isoformat(sep=" ")
UPSERTED = f"""WITH {EVENT_ITEMS}, old AS ({dash("(SELECT * FROM event_items WHERE early)", "category")}),
    new AS ({dash("(SELECT * FROM event_items WHERE NOT early)", "category")})
    SELECT *, TIMESTAMP '{NEXT_STAMP}' AS collected_at FROM new
    UNION ALL
    SELECT *, TIMESTAMP '{STAMP}' FROM old WHERE category NOT IN (SELECT category FROM new)"""

ORIGIN = "regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1)"
NAV = f"""nav AS (
    SELECT page_id AS page_no, url AS page_url, {ORIGIN} AS origin,
        list_filter(regexp_extract_all(html, '<li><a href="([^"]*)"', 1), lambda h: h <> '')
            AS hrefs
    FROM pages), links AS (
    SELECT page_no, page_url, CAST(i AS INTEGER) AS pos, origin || hrefs[i + 1] AS url
    FROM (SELECT *, unnest(range(len(hrefs))) AS i FROM nav)), ordered AS (
    SELECT page_no, page_url, pos, row_number() OVER (ORDER BY page_no, pos) AS ord, url
    FROM links)"""


def shown(x: str) -> str:
    """Element text: tags gone, whitespace squeezed, the given pages' references decoded."""
    bare = rf"regexp_replace(regexp_replace({x}, '{WS}+', ' ', 'g'), '<[^>]*>', '', 'g')"
    for name, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        bare = f"replace({bare}, '{name}', '{char}')"
    return blank_null(bare)


def progress(run: str, rate_line: str, max_items: int, max_pages: int) -> str:
    keep = []
    if max_pages:
        keep.append(f"visit <= {max_pages}")
    if max_items:
        keep.append(f"before < {max_items}")
    where = f"WHERE {' AND '.join(keep)}" if keep else ""
    stop = f"'{V.NO_NEXT_PAGE_LINE}'"
    if max_pages:
        stop = f"CASE WHEN max(visit) >= {max_pages} THEN '{V.PAGE_LIMIT_LINE % max_pages}' ELSE {stop} END"
    if max_items:
        stop = f"CASE WHEN max(before + links) >= {max_items} THEN '{V.ITEM_LIMIT_LINE % max_items}' ELSE {stop} END"
    return f"""SELECT 0 AS seq, '{rate_line}' AS line, '{run}' AS run
        UNION ALL
        SELECT visit, printf('{V.PROGRESS_LINE}', visit, links, before), '{run}'
        FROM placed {where}
        UNION ALL
        SELECT max(visit) + 1, {stop}, '{run}' FROM placed {where}"""


def capture_line(limit: str) -> str:
    return f"""printf('{V.CAPTURE_LINE}', n, {limit}, coalesce(nullif(title, ''), 'N/A'),
        coalesce('R$ ' || CAST(price AS VARCHAR), 'N/A'), coalesce(CAST(rating AS VARCHAR), 'N/A'),
        coalesce(nullif(rating_word, ''), 'N/A'),
        {strip("replace(coalesce(nullif(availability, ''), 'N/A'), chr(10), ' ')")},
        coalesce(CAST(stock AS VARCHAR), 'N/A'), CASE WHEN low_stock THEN 'SIM' ELSE 'NAO' END,
        coalesce(nullif(category, ''), 'N/A'))"""


LINES = """lines AS (
    SELECT p_type, p_name AS title, CAST(l_extendedprice AS DECIMAL(18,4)) AS price_src,
        CAST(l_quantity AS BIGINT) < 5 AS low_stock
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

LINE_REST = [c for c in LINE_ORDER if c not in LINE_KEY]

# Keyed items of the sync queries: one row per (table, item), with duplicate urls.
ROUTED = f"""{ITEMS}, {sheets("items", "category_label")}, keyed AS (
    SELECT items.* REPLACE (shared_url AS url), sheet FROM items
    LEFT JOIN named ON category_label = label
    WHERE shared_url <> ''), routed AS (
    SELECT 'catalog.items_' || {table_name(_text(V.ALL_SHEET))} AS table_name, 0 AS route, *
    FROM keyed
    UNION ALL
    SELECT 'catalog.items_' || {table_name("sheet")}, 1, * FROM keyed WHERE sheet IS NOT NULL),
    ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY table_name, url ORDER BY route, category_label NULLS FIRST, ord) AS n
    FROM routed)"""

DASH_TABLE = "'catalog.items_' || " + table_name(_text(V.DASHBOARD_SHEET))

ORACLE = {
    "dashboard_part": f"""WITH {RECORDS}, priced AS (
        SELECT *, title_src AS title, {converted("price_src", None)} AS price FROM rated)
        {dash("priced", "category")} ORDER BY item_count DESC, category NULLS LAST""",
    "dashboard_offers": f"""WITH {LINES}, priced AS (
        SELECT *, {converted("price_src", W.RATE)} AS price,
            {label("p_type", W.LABELS)} AS category_label FROM lines)
        {dash("priced", "category_label")} ORDER BY item_count DESC, category NULLS LAST""",
    "dashboard_offers_salted": f"""WITH {LINES}, priced AS (
        SELECT *, {converted("price_src", None)} AS price FROM lines) {dash("priced", "p_type")}""",
    "clean_items": f"""WITH {RECORDS}
        SELECT ord, url, title_src, CAST(price_src AS DOUBLE) AS price_src, rating_word, rating,
            availability, stock, low_stock, category FROM rated""",
    "enriched_items": f"WITH {ITEMS} SELECT {ITEM_COLUMNS} FROM items",
    "label_lookup": f"""SELECT p_partkey, p_type, p_brand,
        {label("p_type", W.LABELS)} AS type_label, {label("p_brand", W.LABELS)} AS brand_label,
        {slug("p_brand")} AS brand_key FROM part""",
    "label_lookup_builtin": f"""WITH c AS (
        SELECT p_partkey, list_value({", ".join(_text(c) for c in W.SHOP_CATEGORIES)})
            [p_size % {len(W.SHOP_CATEGORIES)} + 1] AS category FROM part)
        SELECT *, {label("category", V.CATEGORY_LABELS.items())} AS category_label FROM c""",
    "translate_titles": f"""WITH {OFFERS} SELECT ord, title AS src, {translated("title")} AS title,
        title AS title_off FROM offers""",
    "translation_requests": f"""WITH {OFFERS}, keys AS (
        SELECT DISTINCT {blank_null("title")} AS key FROM offers WHERE {blank_null("title")} <> '')
        SELECT key, replace(url_encode(key), '%2F', '/') AS query FROM keys
        WHERE key NOT IN ({", ".join(_text(k.strip()) for k, _ in W.TRANSLATIONS)})""",
    "convert_prices": f"""WITH {RECORDS} SELECT ord, CAST(price_src AS DOUBLE) AS price_src,
        CAST({converted("price_src", W.RATE)} AS DOUBLE) AS online,
        CAST({converted("price_src", 7.25)} AS DOUBLE) AS fixed,
        CAST({converted("price_src", None)} AS DOUBLE) AS none FROM rated""",
    "format_prices": f"""WITH {ITEMS} SELECT ord,
        coalesce('R$ ' || CAST(price AS VARCHAR), 'N/A') AS price_text,
        coalesce('£ ' || CAST(CAST(price_src AS DECIMAL(18,2)) AS VARCHAR), 'N/A') AS source_text,
        coalesce(CAST(stock AS VARCHAR), 'N/A') AS stock_text,
        CASE WHEN low_stock THEN 'SIM' ELSE 'NAO' END AS low_text,
        coalesce(nullif(title, ''), 'N/A') AS title_text,
        replace(coalesce(nullif(availability, ''), 'N/A'), chr(10), ' ') AS availability_text
        FROM items""",
    "capture_report": f"""WITH {ITEMS}, numbered AS (
        SELECT *, row_number() OVER (ORDER BY ord) AS n FROM items)
        SELECT n AS ord, {capture_line("n")} AS line, {capture_line(str(ITEM_LIMIT))}
            AS line_of_limit FROM numbered""",
    "page_fields": rf"""SELECT page_id,
        {shown("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS h1,
        {shown("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")} AS page_title,
        {shown("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")} AS ad,
        CAST(NULL AS VARCHAR) AS no_such_text,
        nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
        nullif(regexp_extract(html, '<meta charset="([^"]*)"', 1), '') AS charset FROM pages""",
    "page_links": f"WITH {NAV} SELECT page_no, pos, url FROM links",
    "page_link_order": f"WITH {NAV} SELECT * FROM ordered",
    "page_link_limit": f"""WITH {NAV.replace("FROM pages)", f"FROM pages WHERE page_id % 10 <> {UNNUMBERED})")}, visits AS (
        SELECT page_no, row_number() OVER (ORDER BY page_no) AS visit FROM nav), runs AS (
        SELECT *, 'pages' AS run FROM ordered WHERE ord <= {100 * ITEM_LIMIT}
            AND page_no IN (SELECT page_no FROM visits WHERE visit <= {PAGE_LIMIT})
        UNION ALL
        SELECT *, 'items' FROM ordered WHERE ord <= {ITEM_LIMIT}
            AND page_no IN (SELECT page_no FROM visits WHERE visit <= {100 * PAGE_LIMIT}))
        SELECT * REPLACE (page_no * {PAGE_STEP} AS page_no) FROM runs""",
    "shop_items": f"WITH {SHOP} SELECT {ITEM_COLUMNS} FROM items",
    "whole_run": f"""WITH {SHOP}, {sheets("items", "category_label")}, placed AS (
        SELECT category_label, url, sheet FROM items LEFT JOIN named ON category_label = label), routed AS (
        SELECT 'catalog.items_' || {table_name(_text(V.ALL_SHEET))} AS table_name, url FROM placed
        UNION ALL
        SELECT 'catalog.items_' || {table_name("sheet")}, url FROM placed WHERE sheet IS NOT NULL)
        SELECT 'sheet' AS kind, '{V.ALL_SHEET}' AS name, count(*) AS rows, count(*) AS added FROM items
        UNION ALL
        SELECT 'sheet', '{V.DASHBOARD_SHEET}', count(*), count(*)
        FROM (SELECT DISTINCT category_label FROM items)
        UNION ALL
        SELECT 'sheet', sheet, count(*), count(*) FROM placed WHERE sheet IS NOT NULL GROUP BY sheet
        UNION ALL
        SELECT 'table', table_name, count(*), count(DISTINCT url) FROM routed GROUP BY table_name
        UNION ALL
        SELECT 'table', {DASH_TABLE}, count(DISTINCT category_label), count(DISTINCT category_label)
        FROM items""",
    "chain_walk": """WITH RECURSIVE walk AS (
        SELECT conv_id, turn, conv_id || ':' || turn AS start, CAST(0 AS BIGINT) AS hop
        FROM conversations WHERE turn = 0
        UNION ALL
        SELECT c.conv_id, c.turn, start, hop + 1 FROM walk w
        JOIN conversations c ON c.conv_id = w.conv_id AND c.turn = w.turn + 1)
        SELECT start, conv_id || ':' || turn AS node, hop FROM walk""",
    "capture_ordinal": """WITH d AS (
        SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS page_no,
            ts, event_id FROM events)
        SELECT page_no, event_id, row_number() OVER (ORDER BY page_no, ts, event_id) AS ord FROM d""",
    "progress_report": f"""WITH c AS (
        SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS page_no, count(*) AS links
        FROM events GROUP BY 1), placed AS (
        SELECT links, row_number() OVER (ORDER BY page_no) AS visit, CAST(coalesce(sum(links) OVER (
            ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
            AS before FROM c)
        {progress("whole", V.RATE_LINE % "6.5355", 0, 0)} UNION ALL
        {progress("pages", V.NO_RATE_LINE, 0, 7)} UNION ALL
        {progress("items", V.RATE_LINE % "6.5355", 500, 25)}""",
    "json_path": f"""WITH {EVENTS} SELECT event_id, k,
        CASE WHEN k % 3 = 0 AND k > 0 THEN CAST(k AS DOUBLE) END AS rate,
        CASE WHEN k % 4 IN (2, 3) THEN event_type END AS answer FROM e""",
    "payload_tables": f"""WITH {EVENTS} SELECT event_type, event_type || '-' AS translated,
        count(*) AS n, CAST((SELECT max(k) FROM e) AS DOUBLE) AS rate FROM e GROUP BY event_type""",
    "quote_keys": """SELECT key, replace(url_encode(key), '%2F', '/') AS quoted FROM (
        SELECT DISTINCT p_name AS key FROM part UNION ALL SELECT url FROM pages)""",
    "sync_router": f"""WITH {ROUTED}, offered AS (
        SELECT table_name, count(*) AS attempted, count(*) FILTER (n = 1) AS inserted, max(route)
            AS route FROM ranked GROUP BY table_name), dashes AS (
        SELECT count(DISTINCT category_label) AS n FROM items)
        SELECT table_name, attempted, inserted, 1 AS run FROM offered
        UNION ALL
        SELECT table_name, CASE WHEN route = 0 THEN 0 ELSE attempted END, 0, 2 FROM offered
        UNION ALL SELECT {DASH_TABLE}, n, n, 1 FROM dashes
        UNION ALL SELECT {DASH_TABLE}, n, 0, 2 FROM dashes""",
    "stored_items": f"""WITH {ROUTED}
        SELECT ord AS id, title, title_src, CAST(price AS DOUBLE) AS price,
            CAST(price_src AS DOUBLE) AS price_src, rating_word, rating, availability, stock,
            low_stock, category, url, TIMESTAMP '{STAMP}' AS collected_at, table_name
        FROM ranked WHERE n = 1""",
    "first_wins": f"""SELECT * EXCLUDE (n) FROM (
        SELECT *, row_number() OVER (PARTITION BY {", ".join(LINE_KEY)}
            ORDER BY {", ".join(LINE_REST)}) AS n,
            count(*) OVER (PARTITION BY {", ".join(LINE_KEY)}) AS copies FROM lineitem)
        WHERE n = 1""",
    "new_rows": f"""WITH {EVENTS} SELECT * EXCLUDE (early) FROM e WHERE NOT early
        AND (user_id, k) NOT IN (SELECT (user_id, k) FROM e WHERE early)""",
    "existing_rows": f"""WITH {EVENTS} SELECT * EXCLUDE (early) FROM e WHERE NOT early
        AND (user_id, k) IN (SELECT (user_id, k) FROM e WHERE early)""",
    "append_if_absent": f"""WITH {EVENTS}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) AS n FROM e)
        SELECT (SELECT max(event_id) FROM ranked WHERE n = 1 AND early) + event_id AS id,
            * EXCLUDE (n, early), TIMESTAMP '{STAMP}' AS collected_at,
            strftime(TIMESTAMP '{STAMP}', '%Y%m%d_%H%M%S') AS stamp
        FROM ranked WHERE n = 1 AND NOT early""",
    "upsert_dashboard": UPSERTED,
    "evolve_union": f"""WITH {ITEMS} SELECT {ITEM_COLUMNS} FROM (
        SELECT * REPLACE (CASE WHEN NOT low_stock THEN title_src END AS title_src,
            CASE WHEN NOT low_stock THEN price_src END AS price_src) FROM items)""",
    "category_fanout": f"""WITH {ITEMS}, {sheets("items", "category_label")}, counts AS (
        SELECT '{V.ALL_SHEET}' AS sheet, count(*) AS rows FROM items
        UNION ALL
        SELECT '{V.DASHBOARD_SHEET}', count(*) FROM (SELECT DISTINCT category_label FROM items)
        UNION ALL
        SELECT sheet, count(*) FROM items JOIN named ON category_label = label GROUP BY sheet)
        SELECT *, 'catalog_{W.RUN_TS:%Y%m%d_%H%M%S}' AS run FROM counts""",
    "empty_run": f"SELECT '{V.EMPTY_RUN_MESSAGE}' AS message, 'empty' AS run",
    "stream_ingest": f"""SELECT * EXCLUDE (n) FROM (
        SELECT *, row_number() OVER (PARTITION BY {", ".join(EVENT_KEY)} ORDER BY ts, event_id) AS n
        FROM events) WHERE n = 1""",
    "stream_first_seen": f"SELECT DISTINCT {', '.join(EVENT_KEY)} FROM events",
    "stream_dashboard": UPSERTED,
}

ORACLE["stream_offers"] = ORACLE["stored_items"]
ORACLE["stream_state"] = ORACLE["stream_first_seen"]
ORACLE["stored_pages"] = rf"""SELECT * REPLACE (CASE WHEN charset = 'utf-8' AND page_id % 2 = 0
        AND page_id NOT IN (SELECT page_id FROM pages WHERE regexp_matches(html, '[^\x00-\x7f\xa0-\xff]'))
        THEN 'iso-8859-1' ELSE charset END AS charset) FROM ({ORACLE["page_fields"]})"""
ORACLE["sheet_rows"] = f"""WITH {ITEMS}, {sheets("items", "category_label")}
    SELECT sheet, row_number() OVER (PARTITION BY sheet ORDER BY ord) AS row, ord, url
    FROM items JOIN named ON category_label = label"""
ORACLE["stream_new_checkpoint"] = ORACLE["stream_ingest"]

SHEET_CATEGORIES = """cats AS (
    SELECT p_partkey, CASE p_size WHEN 1 THEN 'Todos' WHEN 2 THEN 'Painel' WHEN 3 THEN '   '
        WHEN 4 THEN 'a:b/[c]*d?e' WHEN 5 THEN NULL
        WHEN 6 THEN 'Todos_2' WHEN 7 THEN 'Everything for every househo_2'
        WHEN 8 THEN 'Everything for every househ_105'
        ELSE CASE WHEN p_size BETWEEN 9 AND 14
                THEN 'Everything for every household ' || p_partkey
                ELSE 'Shop/' || p_name || ' [' || p_type || ']: ' || p_brand END END AS category_label
    FROM part)"""
ORACLE["sheet_names"] = f"""WITH {SHEET_CATEGORIES}, {sheets("cats", "category_label")}
    SELECT label AS category_label, sheet FROM named ORDER BY label"""
ORACLE["table_names"] = f"""WITH {SHEET_CATEGORIES}, names AS (
    SELECT url AS name FROM pages
    UNION ALL SELECT * FROM (SELECT DISTINCT category_label FROM cats))
    SELECT name, {table_name("name")} AS table_name,
        'catalog.items_' || {table_name("name")} AS qualified, {sheet_base("name")} AS sheet_base
    FROM names"""
