"""Queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import bands as B
from factloom.functions import scalars as S
from factloom.suite.registry import (
    query,
    sql_finite,
    table,
)

SQL_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

SQL_LITERALS = """
SELECT CASE substr(o_orderpriority, 1, 1)
    WHEN '1' THEN '$' || CAST(o_orderkey AS VARCHAR) || ',' || '250'
    WHEN '2' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
    WHEN '3' THEN '0' || CAST(o_orderkey AS VARCHAR)
    WHEN '4' THEN CASE o_orderstatus WHEN 'F' THEN '1_000' WHEN 'O' THEN '1d' ELSE '--5' END
    ELSE CASE o_orderstatus WHEN 'F' THEN 'nan' WHEN 'O' THEN '-1.5e3' ELSE ' ' END
  END AS token FROM orders
"""


def mixed_literals(spark, sf):
    """Number-like and not-number-like text derived from the orders."""
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    digit = F.substring("o_orderpriority", 1, 1)
    token = (
        F.when(digit == "1", F.concat(F.lit("$"), key, F.lit(",250")))
        .when(digit == "2", F.concat(F.lit(" "), key, F.lit(" ")))
        .when(digit == "3", F.concat(F.lit("0"), key))
        .when(
            digit == "4",
            F.when(status == "F", "1_000").when(status == "O", "1d").otherwise("--5"),
        )
        .otherwise(
            F.when(status == "F", "nan").when(status == "O", "-1.5e3").otherwise(" ")
        )
    )
    return table(spark, sf, "orders").select(token.alias("token"))


@query(
    "fn01_typed_scalar",
    rf"""
    WITH tokens AS (
      SELECT unnest(string_split(text, ' ')) AS token FROM documents
      UNION ALL {SQL_LITERALS}),
    counted AS (SELECT token, count(*) AS n FROM tokens GROUP BY token),
    stripped AS (SELECT token, n, {SQL_STRIP.format('token')} AS t FROM counted),
    bare AS (SELECT token, n, t, regexp_replace(t, '[$,]', '', 'g') AS b FROM stripped),
    typed AS (SELECT token, n, t,
      CASE WHEN NOT contains(t, '_') THEN {sql_finite('b')} END AS num FROM bare)
    SELECT token, n, CASE WHEN t <> '' THEN t END AS text, num,
      CASE WHEN t = '' THEN 'empty' WHEN num IS NOT NULL THEN 'number' ELSE 'text' END AS kind
    FROM typed""",
)
def fn01(spark, sf):
    words = table(spark, sf, "documents", heavy=True).select(
        F.explode(F.split("text", " ")).alias("token")
    )
    counted = (
        words.unionByName(mixed_literals(spark, sf))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    scalar = S.typed_scalar(F.col("token"))
    return counted.withColumn("s", scalar).select("token", "n", "s.*")


@query(
    "fn02_scaled_number",
    rf"""
    WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey,
      CASE l_returnflag
        WHEN 'A' THEN '£' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' million'
        WHEN 'N' THEN '$1,' || lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 3, '0') || '.5bn'
        ELSE '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' Thousand' END AS mention
      FROM lineitem)
    SELECT mention, count(*) AS n, CAST(max(CASE
        WHEN mention LIKE '%million' THEN CAST(regexp_extract(mention, '[0-9]+') AS DOUBLE) * 1e6
        WHEN mention LIKE '%bn' THEN CAST(replace(regexp_extract(mention, '[0-9,.]+'), ',', '') AS DOUBLE) * 1e9
        ELSE CAST(regexp_extract(mention, '-[0-9]+') AS DOUBLE) * 1e3 END) AS DOUBLE) AS value
    FROM m GROUP BY mention""",
)
def fn02(spark, sf):
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    mention = (
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(F.lit("£"), quantity, F.lit(" million")),
        )
        .when(
            F.col("l_returnflag") == "N",
            F.concat(F.lit("$1,"), F.lpad(quantity, 3, "0"), F.lit(".5bn")),
        )
        .otherwise(F.concat(F.lit("-"), quantity, F.lit(" Thousand")))
    )
    return (
        table(spark, sf, "lineitem")
        .groupBy(mention.alias("mention"))
        .agg(F.count("*").alias("n"))
        .withColumn("value", S.scaled_number(F.col("mention")))
    )


@query(
    "fn03_kind_tags",
    """
    WITH t AS (SELECT event_id, CASE event_type
        WHEN 'signup' THEN 'true' WHEN 'view' THEN CAST(user_id AS VARCHAR)
        WHEN 'click' THEN CAST(value AS VARCHAR) WHEN 'error' THEN 'null'
        ELSE '"' || event_type || '"' END AS token, event_type FROM events)
    SELECT event_id, token,
      CASE event_type WHEN 'signup' THEN 'boolean' WHEN 'view' THEN 'integer'
        WHEN 'click' THEN 'number' WHEN 'error' THEN NULL ELSE 'string' END AS value_type,
      CASE event_type WHEN 'signup' THEN 'boolean' WHEN 'view' THEN 'number'
        WHEN 'click' THEN 'number' WHEN 'error' THEN 'empty' ELSE 'text' END AS kind,
      CASE event_type WHEN 'view' THEN CAST(user_id AS DOUBLE) WHEN 'click' THEN value END AS twin
    FROM t JOIN (SELECT event_id, user_id, value FROM events) USING (event_id)""",
)
def fn03(spark, sf):
    kind = F.col("event_type")
    token = (
        F.when(kind == "signup", "true")
        .when(kind == "view", F.col("user_id").cast("string"))
        .when(kind == "click", F.col("value").cast("string"))
        .when(kind == "error", "null")
        .otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    )
    tag = S.json_value_type(F.col("token"))
    return (
        table(spark, sf, "events")
        .select("event_id", token.alias("token"))
        .withColumn("value_type", tag)
        .withColumn("kind", S.cell_kind(F.col("value_type")))
        .withColumn("twin", S.numeric_twin(F.col("token"), F.col("value_type")))
    )


@query(
    "fn04_numeric_twin",
    rf"""
    WITH l AS (SELECT token, count(*) AS n FROM ({SQL_LITERALS}) GROUP BY token),
    c AS (SELECT token, n, replace(trim(token), ',', '') AS b FROM l)
    SELECT token, n, {sql_finite('b')} AS lenient FROM c""",
)
def fn04(spark, sf):
    counted = mixed_literals(spark, sf).groupBy("token").agg(F.count("*").alias("n"))
    return counted.withColumn("lenient", S.number_or_null(F.col("token")))


@query(
    "fn05_normalize_name",
    r"""
    WITH n AS (SELECT p_brand || ' (' || p_type || ')' || p_name || 'Total%' AS raw, count(*) AS n
      FROM part GROUP BY 1)
    SELECT raw, n, lower(regexp_replace(regexp_replace(
        regexp_replace(raw, '([a-z0-9])([A-Z])', '\1_\2', 'g'),
        '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS normalized FROM n""",
)
def fn05(spark, sf):
    raw = F.concat(
        "p_brand", F.lit(" ("), "p_type", F.lit(")"), "p_name", F.lit("Total%")
    )
    return (
        table(spark, sf, "part")
        .groupBy(raw.alias("raw"))
        .agg(F.count("*").alias("n"))
        .withColumn("normalized", S.normalize_name(F.col("raw")))
    )


@query(
    "fn06_semantic_candidates",
    r"""
    WITH p AS (SELECT DISTINCT p_brand || '.' || p_type || ':' || p_name || '#' || p_type AS name FROM part),
    c AS (SELECT name, unnest([name] || regexp_split_to_array(name, '[.#/:]')) AS part,
      generate_subscripts([name] || regexp_split_to_array(name, '[.#/:]'), 1) AS pos FROM p),
    d AS (SELECT name, regexp_replace(lower(part), '[^a-z0-9]+', '', 'g') AS candidate, min(pos) AS pos
      FROM c GROUP BY 1, 2)
    SELECT name, string_agg(candidate, '|' ORDER BY pos) AS candidates
    FROM d WHERE candidate <> '' GROUP BY name""",
)
def fn06(spark, sf):
    name = F.concat_ws(
        "#", F.concat_ws(":", F.concat_ws(".", "p_brand", "p_type"), "p_name"), "p_type"
    )
    return (
        table(spark, sf, "part")
        .select(name.alias("name"))
        .distinct()
        .withColumn(
            "candidates", F.array_join(S.semantic_candidates(F.col("name")), "|")
        )
    )


@query(
    "fn07_concept_leaf",
    r"""
    SELECT page_id, url,
      regexp_extract(regexp_extract(regexp_extract(regexp_extract(
        url, '[^#]*$'), '[^/]*$'), '[^.]*$'), '[^:]*$') AS leaf FROM pages""",
)
def fn07(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", "url", S.concept_leaf(F.col("url")).alias("leaf")
    )


@query(
    "fn09_column_letters",
    r"""
    WITH RECURSIVE k AS (SELECT DISTINCT o_custkey + 1 AS n FROM orders),
    steps AS (SELECT n, n AS rest, '' AS letters FROM k
      UNION ALL SELECT n, (rest - 1) // 26, chr(CAST(65 + (rest - 1) % 26 AS INTEGER)) || letters FROM steps WHERE rest > 0),
    a AS (SELECT n, letters FROM steps WHERE rest = 0)
    SELECT n, letters, n AS back, lower(letters) || CAST(n AS VARCHAR) AS address,
      letters AS address_column, n AS address_row FROM a""",
)
def fn09(spark, sf):
    numbered = (
        table(spark, sf, "orders")
        .select((F.col("o_custkey") + 1).alias("n"))
        .distinct()
        .withColumn("letters", S.column_letters(F.col("n")))
    )
    return (
        numbered.withColumn("back", S.column_number(F.col("letters")))
        .withColumn("address", F.concat(F.lower("letters"), F.col("n").cast("string")))
        .withColumn("split", S.split_address(F.col("address")))
        .select(
            "n",
            "letters",
            "back",
            "address",
            F.col("split.column").alias("address_column"),
            F.col("split.row").alias("address_row"),
        )
    )


@query(
    "fn10_split_address",
    r"""
    WITH a AS (SELECT DISTINCT replace(p_brand, '#', '') || CASE WHEN p_size > 25 THEN '' ELSE 'x' END AS address FROM part)
    SELECT address,
      CASE WHEN regexp_full_match(address, '[A-Za-z]+[0-9]+') THEN upper(regexp_extract(address, '^[A-Za-z]+')) END AS col,
      CASE WHEN regexp_full_match(address, '[A-Za-z]+[0-9]+') THEN CAST(regexp_extract(address, '[0-9]+$') AS BIGINT) END AS row
    FROM a""",
)
def fn10(spark, sf):
    address = F.concat(
        F.replace("p_brand", F.lit("#"), F.lit("")),
        F.when(F.col("p_size") > 25, "").otherwise("x"),
    )
    return (
        table(spark, sf, "part")
        .select(address.alias("address"))
        .distinct()
        .withColumn("s", S.split_address(F.col("address")))
        .select("address", F.col("s.column").alias("col"), F.col("s.row").alias("row"))
    )


@query(
    "fn11_scale_value",
    rf"""
    WITH v AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS num,
        CASE WHEN event_type = 'error' THEN props WHEN event_type = 'click' THEN NULL ELSE CAST(value AS VARCHAR) END AS text,
        CASE WHEN user_id > 75 THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END AS scale FROM events),
    s AS (SELECT *, num * scale AS scaled FROM v)
    SELECT event_id, round(scaled, 4) AS scaled, scaled = floor(scaled) AS whole,
      CASE WHEN num IS NULL AND scale <> 1 THEN 'nonnumeric_value' END AS error,
      CASE WHEN num IS NULL AND scale = 1 THEN text END AS passed FROM s""",
)
def fn11(spark, sf):
    error_row = F.col("event_type") == "error"
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(~error_row, F.col("value")).alias("num"),
        F.when(error_row, F.col("props"))
        .when(F.col("event_type") != "click", F.col("value").cast("string"))
        .alias("text"),
        F.when(F.col("user_id") > 75, 1000.0).otherwise(1.0).alias("scale"),
    )
    scaled = S.scale_value(F.col("num"), F.col("text"), F.col("scale"))
    return rows.withColumn("s", scaled).select(
        "event_id",
        F.round("s.num", 4).alias("scaled"),
        (F.col("s.num") == F.floor("s.num")).alias("whole"),
        F.col("s.error").alias("error"),
        F.when(F.col("num").isNull(), F.col("s.text")).alias("passed"),
    )


@query(
    "fn12_month_period",
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS period,
      CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS code,
      CAST(NULL AS VARCHAR) AS unknown, count(*) AS n
    FROM orders GROUP BY 1, 2""",
)
def fn12(spark, sf):
    named = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "MMMM").alias("month"),
        S.month_code(F.col("o_orderdate")).alias("code"),
    )
    return (
        named.groupBy(
            S.month_period(F.col("year"), F.col("month")).alias("period"),
            "code",
            S.month_period(F.col("year"), F.lower("month")).alias("unknown"),
        )
        .agg(F.count("*").alias("n"))
        .select("period", "code", "unknown", "n")
    )


@query(
    "fn13_academic_year",
    """
    SELECT CAST(year(o_orderdate) AS VARCHAR) || CASE o_orderstatus WHEN 'F' THEN '-' WHEN 'O' THEN '/' ELSE ' ' END
        || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS label,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) + 1 AS BIGINT) END AS year_end,
      count(*) AS n FROM orders GROUP BY 1, 2""",
)
def fn13(spark, sf):
    year = F.year("o_orderdate")
    mark = (
        F.when(F.col("o_orderstatus") == "F", "-")
        .when(F.col("o_orderstatus") == "O", "/")
        .otherwise(" ")
    )
    label = F.concat(
        year.cast("string"), mark, F.lpad(((year + 1) % 100).cast("string"), 2, "0")
    )
    return (
        table(spark, sf, "orders")
        .groupBy(label.alias("label"))
        .agg(F.count("*").alias("n"))
        .withColumn("year_end", S.academic_year_end(F.col("label")))
    )


def sql_age_labels() -> str:
    return """
      SELECT p_partkey, p_size AS a, CASE p_type
        WHEN 'ECONOMY' THEN 'Aged ' || CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 4 AS VARCHAR)
        WHEN 'STANDARD' THEN 'Female ' || CAST(p_size AS VARCHAR) || ' and ' || CAST(p_size + 1 AS VARCHAR) || ' years'
        WHEN 'PROMO' THEN 'Age ' || CAST(p_size AS VARCHAR) || ' and over'
        WHEN 'SMALL' THEN CAST(p_size AS VARCHAR)
        WHEN 'LARGE' THEN 'aged ' || CAST(p_size AS VARCHAR) || ' years'
        ELSE 'Pop ' || CAST(p_size AS VARCHAR) END AS label, p_type FROM part"""


def age_labels(spark, sf):
    size = F.col("p_size").cast("string")
    kind = F.col("p_type")

    def up(step):
        return (F.col("p_size") + step).cast("string")

    label = (
        F.when(kind == "ECONOMY", F.concat(F.lit("Aged "), size, F.lit("-"), up(4)))
        .when(
            kind == "STANDARD",
            F.concat(F.lit("Female "), size, F.lit(" and "), up(1), F.lit(" years")),
        )
        .when(kind == "PROMO", F.concat(F.lit("Age "), size, F.lit(" and over")))
        .when(kind == "SMALL", size)
        .when(kind == "LARGE", F.concat(F.lit("aged "), size, F.lit(" years")))
        .otherwise(F.concat(F.lit("Pop "), size))
    )
    return table(spark, sf, "part").select("p_partkey", "p_type", label.alias("label"))


@query(
    "fn14_age_band",
    f"""
    SELECT p_partkey, label,
      CASE WHEN p_type IN ('ECONOMY','STANDARD','PROMO','SMALL','LARGE') THEN CAST(a AS BIGINT) END AS lo,
      CAST(CASE p_type WHEN 'ECONOMY' THEN a + 5 WHEN 'STANDARD' THEN a + 2
        WHEN 'SMALL' THEN a + 1 WHEN 'LARGE' THEN a + 1 END AS BIGINT) AS hi
    FROM ({sql_age_labels()})""",
)
def fn14(spark, sf):
    return (
        age_labels(spark, sf)
        .withColumn("band", B.age_band(F.col("label")))
        .select("p_partkey", "label", "band.lo", "band.hi")
    )


SQL_INCOME_LABEL = """CASE WHEN o_totalprice < 1000 THEN 'under_1k'
  WHEN o_totalprice < 50000 THEN '1k_to_50k' WHEN o_totalprice < 150000 THEN '50k_to_150k'
  WHEN o_totalprice < 300000 THEN '0.15m_to_300k' WHEN o_totalprice < 400000 THEN 'all'
  WHEN o_totalprice < 450000 THEN 'odd_to_even' ELSE '450k_plus' END"""


def income_label():
    price = F.col("o_totalprice")
    return (
        F.when(price < 1000, "under_1k")
        .when(price < 50000, "1k_to_50k")
        .when(price < 150000, "50k_to_150k")
        .when(price < 300000, "0.15m_to_300k")
        .when(price < 400000, "all")
        .when(price < 450000, "odd_to_even")
        .otherwise("450k_plus")
    )


@query(
    "fn15_income_bounds",
    f"""
    WITH l AS (SELECT {SQL_INCOME_LABEL} AS label, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT * FROM (VALUES ('under_1k', NULL::DOUBLE, 1000::DOUBLE, true), ('1k_to_50k', 1000, 50000, true),
      ('50k_to_150k', 50000, 150000, true), ('0.15m_to_300k', 150000, 300000, true),
      ('all', NULL, NULL, true), ('odd_to_even', NULL, NULL, false), ('450k_plus', 450000, NULL, true)) v(label, lo, hi, known))
    SELECT l.label, n, lo, hi, known, known AND label NOT IN ('all', 'under_1k') AND lo >= 50000 AND coalesce(hi <= 300000, false) AS inside
    FROM l JOIN b USING (label)""",
)
def fn15(spark, sf):
    outer = F.struct(F.lit(50000.0).alias("lo"), F.lit(300000.0).alias("hi"))
    return (
        table(spark, sf, "orders")
        .groupBy(income_label().alias("label"))
        .agg(F.count("*").alias("n"))
        .withColumn("band", B.income_bounds(F.col("label")))
        .select(
            "label",
            "n",
            "band.lo",
            "band.hi",
            F.col("band").isNotNull().alias("known"),
            B.band_contains(outer, F.col("band")).alias("inside"),
        )
    )


@query(
    "fn16_coded_bands",
    """
    WITH c AS (SELECT * FROM (VALUES (0,'all',NULL::DOUBLE,NULL::DOUBLE),(1,'under_1',NULL,1),(2,'1_to_10k',1,10000),
      (3,'10k_to_25k',10000,25000),(4,'25k_to_50k',25000,50000),(5,'50k_to_75k',50000,75000),
      (6,'75k_to_100k',75000,100000),(7,'100k_to_200k',100000,200000),(8,'200k_to_500k',200000,500000),
      (9,'500k_to_1m',500000,1000000),(10,'1m_plus',1000000,NULL)) v(code, label, lo, hi))
    SELECT p_size, count(*) AS n, label, lo, hi,
      CASE WHEN p_size BETWEEN 1 AND 4 THEN CAST(p_size - 1 AS INTEGER) END AS children
    FROM part LEFT JOIN c ON code = p_size GROUP BY p_size, label, lo, hi""",
)
def fn16(spark, sf):
    code = F.concat(F.lit(" n5966"), F.col("p_size").cast("string"))
    return (
        table(spark, sf, "part")
        .groupBy("p_size")
        .agg(F.count("*").alias("n"))
        .withColumn("band", B.income_code_band(F.col("p_size").cast("string")))
        .select("p_size", "n", "band.*", B.child_count(code).alias("children"))
    )


@query(
    "fn17_padded_codes",
    """
    SELECT n_nationkey, '0400000US' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geography_id,
      lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, CAST(NULL AS VARCHAR) AS no_code FROM nation""",
)
def fn17(spark, sf):
    ident = S.padded_code(F.col("n_nationkey"), 2, "0400000US")
    return (
        table(spark, sf, "nation")
        .select("n_nationkey", ident.alias("geography_id"))
        .withColumn("code", S.geography_code(F.col("geography_id")))
        .withColumn("no_code", S.geography_code(F.concat("geography_id", F.lit("x"))))
    )


@query(
    "fn18_slugs",
    r"""
    WITH p AS (SELECT DISTINCT p_brand || ', (' || p_name || ')' AS raw, p_type FROM part),
    d AS (SELECT raw, p_type, regexp_replace(regexp_replace(lower(raw), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS dash FROM p)
    SELECT raw, p_type, dash, replace(dash, '-', '_') AS path,
      regexp_replace(replace(lower(p_type || '/' || replace(raw, ' ', '_')), '__', '_'), '[(),]', '', 'g') AS stable FROM d""",
)
def fn18(spark, sf):
    raw = F.concat("p_brand", F.lit(", ("), "p_name", F.lit(")"))
    return (
        table(spark, sf, "part")
        .select(raw.alias("raw"), "p_type")
        .distinct()
        .withColumn("dash", S.dash_slug(F.col("raw")))
        .withColumn("path", S.path_slug(F.col("raw")))
        .withColumn("stable", S.stable_slug(F.col("p_type"), F.lit(""), F.col("raw")))
    )


@query(
    "fn19_first_year",
    r"""
    WITH t AS (SELECT doc_id, lower(text) || ' fy' || CAST(1890 + n_chars % 160 AS VARCHAR) || ' ty2001' AS body FROM documents),
    k AS (SELECT doc_id, unnest(regexp_split_to_array(body, '[^a-z0-9]+')) AS token,
        generate_subscripts(regexp_split_to_array(body, '[^a-z0-9]+'), 1) AS pos FROM t),
    y AS (SELECT doc_id, pos, regexp_extract(token, '[0-9]{4}$') AS year FROM k
      WHERE regexp_full_match(token, '(fy|ty)?(19|20)[0-9]{2}'))
    SELECT doc_id, arg_min(year, pos) AS year FROM y WHERE CAST(year AS INTEGER) BETWEEN 1900 AND 2035 GROUP BY doc_id""",
)
def fn19(spark, sf):
    body = F.concat(
        "text",
        F.lit(" fy"),
        (1890 + F.col("n_chars") % 160).cast("string"),
        F.lit(" ty2001"),
    )
    return table(spark, sf, "documents", heavy=True).select(
        "doc_id", S.first_year(body).alias("year")
    )


KEYWORD_RULES = [
    ("greeting", ["^est ", "bonjour"]),
    ("short", ["=."]),
    ("licence", ["license", "copyright"]),
    ("article", [" the ", " der ", " la ", " el "]),
]


@query(
    "fn20_keyword_class",
    """
    SELECT doc_id, CASE
      WHEN lower(text) LIKE 'est %' OR contains(lower(text), 'bonjour') THEN 'greeting'
      WHEN lower(text) = '.' THEN 'short'
      WHEN contains(lower(text), 'license') OR contains(lower(text), 'copyright') THEN 'licence'
      WHEN contains(lower(text), ' the ') OR contains(lower(text), ' der ') OR contains(lower(text), ' la ')
        OR contains(lower(text), ' el ') THEN 'article' ELSE 'other' END AS class FROM documents""",
)
def fn20(spark, sf):
    return table(spark, sf, "documents", heavy=True).select(
        "doc_id",
        S.keyword_class(F.lower("text"), KEYWORD_RULES, "other").alias("class"),
    )


@query(
    "fn21_half_even",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
      CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS halves,
      CAST(round_even(l_quantity * 500, 0) AS BIGINT) AS money, CAST(NULL AS BIGINT) AS footnote FROM lineitem""",
)
def fn21(spark, sf):
    half = (F.col("l_quantity") / 2).cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        S.rounded_count(half).alias("halves"),
        S.rounded_count(F.concat(F.lit("$"), half), 1000).alias("money"),
        S.rounded_count(F.concat(F.lit("["), half, F.lit("]"))).alias("footnote"),
    )


@query(
    "fn22_clean_space",
    r"""
    SELECT doc_id, trim(regexp_replace(text || chr(160) || '  x' || chr(8239), '[\s' || chr(160) || chr(8239) || ']+', ' ', 'g')) AS clean
    FROM documents""",
)
def fn22(spark, sf):
    raw = F.concat("text", F.lit("   x "))
    return table(spark, sf, "documents", heavy=True).select(
        "doc_id", S.clean_space(raw).alias("clean")
    )


@query(
    "fn23_month_code",
    """
    SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS period, count(*) AS n
    FROM lineitem GROUP BY 1""",
)
def fn23(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy(S.month_code(F.col("l_shipdate")).alias("period"))
        .agg(F.count("*").alias("n"))
    )




def sql_loose(left: str, right: str) -> str:
    def num(x: str) -> str:
        return sql_finite(f"replace(trim({x}), ',', '')")

    return (
        f"(CASE WHEN {num(left)} IS NOT NULL AND {num(right)} IS NOT NULL "
        f"THEN {num(left)} = {num(right)} ELSE {left} IS NOT DISTINCT FROM {right} END)"
    )


@query(
    "fn24_loose_equal",
    f"""
    WITH v AS (SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS a,
      CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
        WHEN 'N' THEN '1,' || l_linestatus ELSE NULL END AS b FROM lineitem)
    SELECT l_orderkey, l_partkey, l_linenumber, a, b, {sql_loose('a', 'b')} AS equal FROM v""",
)
def fn24(spark, sf):
    other = F.when(
        F.col("l_returnflag") == "A", F.col("l_quantity").cast("bigint").cast("string")
    ).when(F.col("l_returnflag") == "N", F.concat(F.lit("1,"), "l_linestatus"))
    return (
        table(spark, sf, "lineitem")
        .select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            F.col("l_quantity").cast("string").alias("a"),
            other.alias("b"),
        )
        .withColumn("equal", S.loose_equal(F.col("a"), F.col("b")))
    )


@query(
    "fn25_operator_match",
    f"""
    WITH v AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_totalprice AS VARCHAR) END AS source,
      CASE o_orderpriority WHEN '1-URGENT' THEN '>=' WHEN '2-HIGH' THEN '<' WHEN '3-MEDIUM' THEN '=='
        WHEN '4-NOT SPECIFIED' THEN '!=' ELSE 'in' END AS op,
      CASE o_orderpriority WHEN '1-URGENT' THEN '200,000' WHEN '2-HIGH' THEN '100000.50' WHEN '3-MEDIUM' THEN '3-MEDIUM'
        WHEN '4-NOT SPECIFIED' THEN '4-NOT SPECIFIED' ELSE '4-NOT SPECIFIED|5-LOW' END AS expected FROM orders),
    m AS (SELECT *, {sql_finite("source")} AS num FROM v)
    SELECT o_orderkey, op, expected, source, CASE op WHEN '==' THEN source = expected WHEN '!=' THEN source <> expected
      WHEN 'in' THEN source IN ('4-NOT SPECIFIED', '5-LOW') WHEN '>=' THEN coalesce(num >= 200000, false)
      ELSE coalesce(num < 100000.5, false) END AS ok FROM m""",
)
def fn25(spark, sf):
    priority = F.col("o_orderpriority")
    op = (
        F.when(priority == "1-URGENT", ">=")
        .when(priority == "2-HIGH", "<")
        .when(priority == "3-MEDIUM", "==")
        .when(priority == "4-NOT SPECIFIED", "!=")
        .otherwise("in")
    )
    expected = (
        F.when(priority == "1-URGENT", "200,000")
        .when(priority == "2-HIGH", "100000.50")
        .when(priority == "3-MEDIUM", "3-MEDIUM")
        .when(priority == "4-NOT SPECIFIED", "4-NOT SPECIFIED")
        .otherwise("4-NOT SPECIFIED|5-LOW")
    )
    source = F.when(F.col("o_orderstatus") == "P", priority).otherwise(
        F.col("o_totalprice").cast("string")
    )
    return (
        table(spark, sf, "orders")
        .select(
            "o_orderkey",
            op.alias("op"),
            expected.alias("expected"),
            source.alias("source"),
        )
        .withColumn(
            "ok", S.operator_match(F.col("source"), F.col("op"), F.col("expected"))
        )
    )


@query(
    "fn26_source_specific",
    """
    SELECT p_partkey, p_brand || CASE WHEN p_size > 25 THEN '.' WHEN p_size > 12 THEN ':' ELSE '' END || p_type AS variable,
      p_size > 12 AND p_type <> 'PROMO' AS specific FROM part""",
)
def fn26(spark, sf):
    mark = F.when(F.col("p_size") > 25, ".").when(F.col("p_size") > 12, ":").otherwise("")
    source = F.when(F.col("p_type") != "PROMO", F.col("p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat("p_brand", mark, "p_type").alias("variable"),
        S.is_source_specific(source, F.concat("p_brand", mark, "p_type")).alias(
            "specific"
        ),
    )


@query(
    "fn27_iso_dates",
    """
    WITH d AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
        WHEN 'O' THEN strftime(o_orderdate, '%Y-%m') || '-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_text,
      strftime(o_orderdate, '%Y-%m') || '-15' AS end_text FROM orders),
    p AS (SELECT *, CASE WHEN regexp_full_match(start_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(start_text AS DATE) END AS s,
      TRY_CAST(end_text AS DATE) AS e FROM d)
    SELECT o_orderkey, start_text, s IS NOT NULL AS valid, coalesce(s > e, false) AS reversed FROM p""",
)
def fn27(spark, sf):
    start = (
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(
            F.col("o_orderstatus") == "O",
            F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-31")),
        )
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    end = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-15"))
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", start.alias("start_text"), end.alias("end_text"))
        .select(
            "o_orderkey",
            "start_text",
            S.iso_date(F.col("start_text")).isNotNull().alias("valid"),
            F.coalesce(
                S.iso_date(F.col("start_text")) > S.iso_date(F.col("end_text")),
                F.lit(False),
            ).alias("reversed"),
        )
    )


@query(
    "fn28_content_path",
    """
    SELECT p_partkey, 'raw/' || replace(p_brand, '#', '/') || '/' || p_type || '/' || CAST(2000 + p_size AS VARCHAR)
      || '/' || sha256(p_name) || '/' || p_name || '.csv' AS path FROM part""",
)
def fn28(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        S.content_path(
            F.lit("/raw/"),
            F.concat(F.lit("/"), F.replace("p_brand", F.lit("#"), F.lit("/"))),
            F.col("p_type"),
            2000 + F.col("p_size"),
            F.sha2("p_name", 256),
            F.concat(F.lit("in/"), "p_name", F.lit(".csv")),
        ).alias("path"),
    )
