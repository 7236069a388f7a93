"""Queries for scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators.sequence import number_rows
from factloom.session import new_folder
from factloom.sources import records as R
from factloom.sources import delimited as D
from factloom.sources import pages as G
from factloom.sources import snapshots as SN
from factloom.sources import store as T
from factloom.suite.registry import query, table

CSV_NAMES = D.header_names("﻿ key, %status ,price,note,status", ",")


@query(
    "src01_delimited_scan",
    """
    WITH v AS (
      SELECT o_orderkey AS row_number, 1 AS pos, 'key' AS name, CAST(o_orderkey AS VARCHAR) AS text, CAST(o_orderkey AS DOUBLE) AS num FROM orders
      UNION ALL SELECT o_orderkey, 3, 'price', '$' || CAST(o_totalprice AS VARCHAR), o_totalprice FROM orders
      UNION ALL SELECT o_orderkey, 4, 'note', o_orderpriority || ', "quoted"', NULL FROM orders
      UNION ALL SELECT o_orderkey, 5, 'status', CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, NULL FROM orders)
    SELECT *, CASE WHEN text IS NULL THEN 'empty' WHEN num IS NOT NULL THEN 'number' ELSE 'text' END AS kind FROM v""",
)
def src01(spark, sf):
    status = F.col("o_orderstatus")
    line = F.concat(
        F.concat_ws(
            ",",
            F.col("o_orderkey").cast("string"),
            F.lit(" x "),
            F.concat(F.lit("$"), F.col("o_totalprice").cast("string")),
            F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""quoted"""')),
        ),
        F.when(status == "P", "")
        .when(status == "F", F.concat(F.lit(","), status, F.lit(",surplus")))
        .otherwise(F.concat(F.lit(","), status)),
    )
    lines = table(spark, sf, "orders", heavy=True).select(
        F.col("o_orderkey").alias("row_number"), line.alias("line")
    )
    rows = D.parse_delimited(lines, ["row_number"], CSV_NAMES)
    return rows.select("row_number", F.inline("values"))


@query(
    "src02_json_tables",
    """
    WITH b AS (SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS u, json_extract_string(props, '$.k') AS k FROM events)
    SELECT event_id, 'objects' AS form, 1::BIGINT AS row_number, 1 AS position, 'k' AS name, k AS value FROM b
    UNION ALL SELECT event_id, 'objects', 1, 2, 'type', event_type FROM b
    UNION ALL SELECT event_id, 'objects', 2, 1, 'k', u FROM b
    UNION ALL SELECT event_id, 'objects', 2, 2, 'type', NULL FROM b
    UNION ALL SELECT event_id, 'arrays', 2, 1, 'user', u FROM b
    UNION ALL SELECT event_id, 'arrays', 2, 2, 'k', k FROM b""",
)
def src02(spark, sf):
    events = table(spark, sf, "events")
    k = F.regexp_extract("props", r"([0-9]+)", 1)
    user = F.col("user_id").cast("string")
    objects = F.concat(
        F.lit('[{"k":'), k, F.lit(',"type":"'), "event_type", F.lit('"},{"k":"'), user, F.lit('","extra":1}]')
    )
    arrays = F.concat(F.lit('[["user","k"],["'), user, F.lit('",'), k, F.lit("]]"))
    docs = events.select("event_id", objects.alias("objects"), arrays.alias("arrays"))
    return D.json_object_rows(
        docs.withColumn("form", F.lit("objects")), ["event_id", "form"], "objects"
    ).unionByName(
        D.json_array_rows(
            docs.withColumn("form", F.lit("arrays")), ["event_id", "form"], "arrays"
        )
    )


@query(
    "src03_json_lines",
    """
    SELECT '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"'
      || CASE WHEN o_orderstatus <> 'P' THEN ',"o_orderstatus":"' || o_orderstatus || '"' ELSE '' END || '}' AS value,
      o_orderkey AS back FROM orders""",
)
def src03(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    lines = D.to_json_lines(orders)
    parsed = F.from_json("value", orders.schema.simpleString(), {"mode": "FAILFAST"})
    return lines.withColumn("back", parsed["o_orderkey"])


@query(
    "src04_html_tables",
    """
    SELECT o_orderkey, 1::BIGINT AS sheet, 1::BIGINT AS "row", c AS col, 'Order & price' AS text, NULL::DOUBLE AS num FROM orders, range(1, 3) t(c)
    UNION ALL SELECT o_orderkey, 1, 2, 1, o_orderpriority, NULL FROM orders
    UNION ALL SELECT o_orderkey, 1, 2, 2, '1,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), 1000.0 + o_orderkey % 1000 FROM orders
    UNION ALL SELECT o_orderkey, 2, 1, 1, o_orderstatus, NULL FROM orders""",
)
def src04_tables(spark, sf):
    body = F.concat(
        F.lit("<p>t</p><table><tr><th colspan='2'>Order &amp;<br>price</th></tr><tr><td>"),
        "o_orderpriority",
        F.lit("</td><td> 1,"),
        F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"),
        F.lit("</td><td></td></tr><tr><td> </td></tr></table><table><tr><td>"),
        "o_orderstatus",
        F.lit("</td></tr></table>"),
    )
    pages = table(spark, sf, "orders", heavy=True).select("o_orderkey", body.alias("html"))
    return G.page_cells(G.page_pieces(pages, "o_orderkey", "html"))


@query("src04_html_blocks")
def src04_blocks(spark, sf):
    return G.page_blocks(G.page_pieces(table(spark, sf, "pages", heavy=True), "page_id", "html"))


@query(
    "src05_embedded_payload",
    r"""
    WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
      regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages)
    SELECT page_id, nullif(title, '') AS payload, CASE WHEN title = '' THEN 'missing_payload' END AS issue, nullif(lang, '') AS lang FROM t""",
)
def src05(spark, sf):
    pages = table(spark, sf, "pages", heavy=True).withColumn(
        "lang", F.nullif(F.regexp_extract("html", '<html lang="([a-z]+)"', 1), F.lit(""))
    )
    return G.payload(pages, ["page_id", "lang"], "html", "<title>([^<]*)</title>")


@query(
    "src06_landed_rows",
    """
    SELECT o_orderkey, '{"o_orderkey":"' || o_orderkey || '","o_orderpriority":"' || o_orderpriority || '","o_totalprice":"'
      || CAST(o_totalprice AS VARCHAR) || '"}' AS values_json FROM orders""",
)
def src06(spark, sf):
    return D.landed_rows(
        table(spark, sf, "orders"),
        ["o_orderkey"],
        ["o_orderkey", "o_orderpriority", "o_totalprice"],
    )


SQL_LINES = r"""
lines0 AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines1 AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS line_number, len(parts) AS n FROM lines0),
lines AS (SELECT doc_id, line_number, line FROM lines1 WHERE line <> '' OR line_number < n)"""


@query("src07_text_lines", f"WITH {SQL_LINES} SELECT * FROM lines")
def src07(spark, sf):
    return D.text_lines(table(spark, sf, "documents", heavy=True), ["doc_id"], "text")


@query(
    "wn03_line_context",
    rf"""
    WITH {SQL_LINES}, c AS (SELECT doc_id, line_number, trim(regexp_replace(line, '[\s' || chr(160) || chr(8239) || ']+', ' ', 'g')) AS line FROM lines)
    SELECT doc_id, line_number, line, string_agg(line, ' ') OVER (PARTITION BY doc_id ORDER BY line_number
      ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS context FROM c WHERE line <> ''""",
)
def wn03(spark, sf):
    return G.context_lines(table(spark, sf, "documents", heavy=True), ["doc_id"], "text")


@query("src08_number_mentions")
def src08(spark, sf):
    lines = G.context_lines(table(spark, sf, "documents", heavy=True), ["doc_id"], "text")
    return G.number_mentions(
        lines, ["doc_id", "line_number", "line", "context"], "line"
    )


@query(
    "src10_export_order",
    """
    WITH u AS (SELECT 'orders' AS table_name, o_orderkey AS key FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer
      UNION ALL SELECT 'part', p_partkey FROM part)
    SELECT table_name, key, row_number() OVER (PARTITION BY table_name ORDER BY key) AS position, count(*) OVER (PARTITION BY table_name) AS row_count FROM u""",
)
def src10(spark, sf):
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    rows = None
    for name, key in keys.items():
        part = table(spark, sf, name).select(
            F.lit(name).alias("table_name"), F.col(key).alias("key")
        )
        rows = part if rows is None else rows.unionByName(part)
    counts = rows.groupBy("table_name").agg(F.count("*").alias("row_count"))
    return number_rows(rows, ["table_name"], "key", "position").join(
        counts, "table_name"
    )


@query(
    "src11_upsert",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS price,
      CASE WHEN o_orderpriority = '1-URGENT' THEN CASE WHEN o_orderstatus = 'P' THEN 'inserted' ELSE 'updated' END
        WHEN o_orderstatus = 'P' THEN 'inserted' ELSE 'kept' END AS state
    FROM orders""",
)
def src11(spark, sf):
    orders = table(spark, sf, "orders")
    opened = F.col("o_orderstatus") == "P"
    target = orders.filter(~opened).select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.lit("kept").alias("state")
    )
    source = orders.filter(opened | (F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey",
        (-F.col("o_totalprice")).alias("price"),
        F.when(opened, "inserted").otherwise("updated").alias("state"),
    )
    return T.upsert(target, source, ["o_orderkey"])


@query(
    "src11_upsert_dry_run",
    """
    SELECT count(*) FILTER (o_orderstatus = 'P') AS inserted, count(*) FILTER (o_orderstatus <> 'P') AS updated
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'""",
)
def src11_dry(spark, sf):
    orders = table(spark, sf, "orders")
    opened = F.col("o_orderstatus") == "P"
    source = orders.filter(opened | (F.col("o_orderpriority") == "1-URGENT"))
    return T.upsert_counts(orders.filter(~opened), source, ["o_orderkey"])


@query(
    "jn23_replace_and_prune",
    """
    SELECT p_partkey, p_brand, p_type, 'stored' AS state FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 45)
    UNION ALL SELECT p_partkey, p_brand, p_type, 'loaded' FROM part WHERE p_size > 45""",
)
def jn23(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    stored = part.drop("p_size").withColumn("state", F.lit("stored"))
    loaded = part.filter("p_size > 45").drop("p_size").withColumn("state", F.lit("loaded"))
    return T.replace_scope(stored, loaded, "p_partkey", ["p_brand"])


# --- written files ---------------------------------------------------------------
#: Orders of a written file, by key.
PER_FILE = 50_000


def written(lines, label):
    """Write ``part, at, line`` as one text file per part, in the order of ``at``."""
    path = new_folder(lines.sparkSession, "files") + f"/{label}"
    ordered = lines.repartition("part").sortWithinPartitions("part", "at")
    ordered.select("part", "line").write.partitionBy("part").text(path)
    return path


def numbered_part(rows, keep):
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("bigint")
    return rows.select(part.alias("part"), *keep)


def delimited_files(spark, sf):
    """Records over several lines, blank and short ones, under two headers."""
    key = F.col("o_orderkey")
    part = F.floor(key / PER_FILE)
    orders = table(spark, sf, "orders").withColumn("part", part)
    broken = F.concat(F.lit('"'), "o_orderpriority", F.lit('\nsecond ""line"""'))
    note = F.when(key % 5 == 0, broken).otherwise(F.concat(F.lit('"x, '), "o_orderstatus", F.lit('"')))
    first = F.when(F.col("part") % 2 == 0, key.cast("string")).otherwise(note)
    second = F.when(F.col("part") % 2 == 0, note).otherwise(key.cast("string"))
    price = F.when(key % 7 == 0, "").otherwise(F.concat(F.lit(",$"), F.col("o_totalprice").cast("string")))
    blank = F.when(key % 11 == 0, "\n").otherwise("")
    body = orders.select(
        "part", key.alias("at"), F.concat(first, F.lit(","), second, price, blank).alias("line")
    )
    header = F.when(F.col("part") % 2 == 0, "\ufeffid,note,price").otherwise(" %note ,id,price")
    heads = orders.select("part").distinct().select("part", F.lit(-1).cast("bigint").alias("at"), header.alias("line"))
    return written(body.unionByName(heads), "orders.csv")


SQL_FILE_RECORDS = rf"""
o AS (SELECT *, o_orderkey // {PER_FILE} AS part FROM orders),
r AS (SELECT *, 2 + coalesce(sum(CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 1 END) OVER (PARTITION BY part ORDER BY o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS row_number,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority || chr(10) || 'second "line"' ELSE 'x, ' || o_orderstatus END AS note FROM o),
t AS (
  SELECT part, CAST(row_number AS BIGINT) AS row_number, 'id' AS name, CAST(o_orderkey AS VARCHAR) AS text, CAST(o_orderkey AS DOUBLE) AS num FROM r
  UNION ALL SELECT part, CAST(row_number AS BIGINT), 'note', note, NULL FROM r
  UNION ALL SELECT part, CAST(row_number AS BIGINT), 'price', CASE WHEN o_orderkey % 7 <> 0 THEN '$' || CAST(o_totalprice AS VARCHAR) END,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END FROM r
  UNION ALL SELECT part, CAST(row_number + 1 AS BIGINT), name, NULL, NULL FROM r, (VALUES ('id'), ('note'), ('price')) n(name) WHERE o_orderkey % 11 = 0)"""


@query(
    "src01_delimited_files",
    f"""
    WITH {SQL_FILE_RECORDS}
    SELECT part, row_number, name, text, num, CASE WHEN text IS NULL THEN 'empty' WHEN num IS NULL THEN 'text' ELSE 'number' END AS kind FROM t""",
)
def src01_files(spark, sf):
    rows = D.read_delimited(spark, delimited_files(spark, sf))
    return numbered_part(rows, ["row_number", F.inline("values")]).drop("pos")


def json_files(spark, sf):
    """One array per file; some items are of another shape or no JSON at all."""
    key = F.col("o_orderkey")
    item = (
        F.when(key % 13 == 0, "{bad}")
        .when(key % 17 == 0, "5")
        .otherwise(
            F.concat(
                F.lit('{"id":'), key.cast("string"), F.lit(',"note":"[\\"'), "o_orderpriority", F.lit('\\",{","more":'),
                F.when(key % 2 == 0, "null").otherwise("[1,2]"), F.lit("}"),
            )
        )
    )
    orders = table(spark, sf, "orders").withColumn("part", F.floor(key / PER_FILE))
    body = orders.select("part", key.alias("at"), F.concat(F.lit(","), item).alias("line"))
    parts = orders.select("part").distinct()
    first = parts.select("part", F.lit(-1).cast("bigint").alias("at"), F.lit('[{"note": "a", "%no ": 0}').alias("line"))
    last = parts.select("part", F.lit(2**62).alias("at"), F.lit(" ]").alias("line"))
    return written(body.unionByName(first).unionByName(last), "orders.json")


SQL_FILE_ITEMS = f"""
i AS (SELECT *, o_orderkey // {PER_FILE} AS part, 1 + row_number() OVER (PARTITION BY o_orderkey // {PER_FILE} ORDER BY o_orderkey) AS item FROM orders)"""


@query(
    "src02_json_files",
    rf"""
    WITH {SQL_FILE_ITEMS}, g AS (SELECT * FROM i WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0)
    SELECT part, item AS row_number, 'note' AS name, '["' || o_orderpriority || '",{{' AS text, NULL::DOUBLE AS num, NULL::VARCHAR AS code FROM g
    UNION ALL SELECT part, item, 'no', NULL, NULL, NULL FROM g
    UNION ALL SELECT DISTINCT part, 1::BIGINT, 'note', 'a', NULL::DOUBLE, NULL FROM i
    UNION ALL SELECT DISTINCT part, 1::BIGINT, 'no', '0', 0::DOUBLE, NULL FROM i
    UNION ALL SELECT part, item, NULL, NULL, NULL, CASE WHEN o_orderkey % 13 = 0 THEN 'not_json' ELSE 'row_shape' END FROM i
      WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0""",
)
def src02_files(spark, sf):
    items, left_open = R.json_items(spark, json_files(spark, sf))
    rows, issues = R.table_rows(items, ["file"])
    found = numbered_part(rows, ["row_number", "name", "text", "num", F.lit(None).cast("string").alias("code")])
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("name", "string"), ("text", "string"), ("num", "double"))]
    faults = numbered_part(
        issues.unionByName(left_open), [F.col("item").alias("row_number"), *nothing, "code"]
    )
    return found.unionByName(faults)


@query(
    "src06_landed_files",
    rf"""
    WITH {SQL_FILE_RECORDS}, {SQL_FILE_ITEMS},
    c AS (SELECT part, row_number, max(text) FILTER (name = 'id') AS id, max(text) FILTER (name = 'note') AS note, max(text) FILTER (name = 'price') AS price
      FROM t GROUP BY part, row_number),
    q AS (SELECT part, row_number, 'csv' AS form,
      CASE WHEN part % 2 = 0 THEN '{{"id":' || coalesce('"' || id || '"', 'null') || ',"note":' || coalesce(to_json(note), 'null')
        ELSE '{{"note":' || coalesce(to_json(note), 'null') || ',"id":' || coalesce('"' || id || '"', 'null') END
      || ',"price":' || coalesce('"' || price || '"', 'null') || '}}' AS values_json FROM c)
    SELECT part, row_number - 1 AS row_number, form, values_json FROM q
    UNION ALL SELECT part, item, 'json', '{{"note":' || to_json('["' || o_orderpriority || '",{{') || ',"no":null,"id":"' || o_orderkey || '","more":'
      || CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE '"[1,2]"' END || '}}' FROM i WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
    UNION ALL SELECT DISTINCT part, 1::BIGINT, 'json', '{{"note":"a","no":"0","id":null,"more":null}}' FROM i""",
)
def src06_files(spark, sf):
    found = None
    for form, write in (("csv", delimited_files), ("json", json_files)):
        rows = D.land_file(spark, write(spark, sf))
        rows = numbered_part(rows, ["row_number", F.lit(form).alias("form"), "values_json"])
        found = rows if found is None else found.unionByName(rows)
    return found


@query(
    "src11_stored_upsert",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS price,
      CASE WHEN o_orderstatus = 'P' THEN 'inserted' WHEN o_orderpriority = '1-URGENT' THEN 'updated' ELSE 'kept' END AS state,
      3::BIGINT AS version
    FROM orders""",
)
def src11_stored(spark, sf):
    """Three loads into one stored table: rows, replacements, new rows."""
    orders = table(spark, sf, "orders")
    opened, urgent = F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "1-URGENT"
    row = lambda sign, state: ["o_orderkey", (sign * F.col("o_totalprice")).alias("price"), F.lit(state).alias("state")]
    stored = SN.Snapshots(spark, new_folder(spark, "upsert"), ["o_orderkey"], 16)
    stored.load(orders.filter(~opened).select(*row(1, "kept")))
    stored.load(orders.filter(~opened & urgent).select(*row(-1, "updated")))
    version = stored.load(orders.filter(opened).select(*row(-1, "inserted")))
    return stored.read().withColumn("version", F.lit(version).cast("bigint"))
