"""The given tables as logical landing tables: plain selects, in Spark and in SQL alike.

``Tables`` reads the Parquet files; every property is the Spark form of the SQL text of the same
name below.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# SQL forms, used as common table expressions by the comparison queries.
ALERTS = """
alerts AS (
  SELECT event_id AS id,
         CASE WHEN event_id % 997 = 0 THEN NULL ELSE CAST(user_id % 26 AS VARCHAR) || ' ' END AS department_code,
         ' ' || coalesce(n_name, 'inconnu') AS department_name,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 ELSE 5 END AS INTEGER) AS phenomenon_id,
         event_type AS phenomenon_name,
         ts AS begin_time,
         ts + to_hours(CAST(event_id % 48 AS INTEGER)) AS end_time,
         CAST(event_id % 4 + 1 AS INTEGER) AS color_id,
         CASE event_id % 4 WHEN 0 THEN 'vert' WHEN 1 THEN 'jaune' WHEN 2 THEN 'orange' ELSE 'rouge' END AS color_name,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(event_id % 4 + 1 AS INTEGER) END AS color_level,
         CASE event_id % 4 WHEN 0 THEN '#31a354' WHEN 1 THEN '#fff600' WHEN 2 THEN '#ffb82b' ELSE '#cc0000' END AS color_hex,
         ts AS extracted_at, CAST(ts AS DATE) AS extraction_date, ts AS created_at
  FROM events LEFT JOIN nation ON CAST(user_id % 26 AS INTEGER) = n_nationkey)"""

PROFILES = """
commune_profiles AS (
  SELECT o_custkey * 10000 + year(o_orderdate) AS id,
         ' ' || CAST(o_custkey AS VARCHAR) AS insee_code, c_name AS commune,
         lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS code_postal,
         CASE WHEN n_nationkey = 0 THEN '2A' ELSE CAST(n_nationkey AS VARCHAR) END AS department_code,
         n_name AS department_name, r_name AS region,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS INTEGER) AS naturels_count,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS INTEGER) AS technologiques_count,
         CAST(count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS INTEGER) AS total_risks,
         CAST(max(o_orderkey % 4) FILTER (WHERE o_orderstatus = 'F') AS INTEGER) AS max_severity_naturels,
         CAST(max(o_orderkey % 4) FILTER (WHERE o_orderstatus = 'O') AS INTEGER) AS max_severity_technologiques,
         bool_or(o_orderpriority = '1-URGENT') AS seisme_present,
         CAST(max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey % 4 END) AS INTEGER) AS seisme_severity,
         bool_or(o_orderpriority = '2-HIGH') AS rga_present,
         CAST(max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey % 4 END) AS INTEGER) AS rga_severity,
         bool_or(o_orderpriority = '3-MEDIUM') AS radon_present,
         CAST(max(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderkey % 4 END) AS INTEGER) AS radon_severity,
         bool_or(o_orderpriority = '5-LOW') AS inondation_present,
         CAST(max(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey % 4 END) AS INTEGER) AS inondation_severity,
         bool_or(o_totalprice > 400000) AS icpe_present,
         bool_or(o_totalprice > 450000) AS nucleaire_present,
         CAST(make_date(year(o_orderdate), 1, 1) AS TIMESTAMP) AS extracted_at,
         make_date(year(o_orderdate), 1, 1) AS extraction_date,
         CAST(make_date(year(o_orderdate), 1, 1) AS TIMESTAMP) AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY o_custkey, year(o_orderdate), c_name, n_nationkey, n_name, r_name)"""

DETAILS = """
risk_details AS (
  SELECT min(l_orderkey * 10 + l_linenumber) AS id,
         CAST(o_custkey AS VARCHAR) || ' ' AS insee_code,
         CASE l_linestatus WHEN 'O' THEN 'naturel' ELSE 'technologique' END AS risk_category,
         l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS risk_key,
         ' Risk ' || l_returnflag || CAST(l_linenumber AS VARCHAR) AS risk_libelle,
         CASE WHEN max(l_quantity) > 45 THEN NULL ELSE bool_or(l_discount >= 0.05) END AS present,
         CASE max(l_orderkey % 4) WHEN 3 THEN 'Risque Important' WHEN 2 THEN 'Modéré' WHEN 1 THEN 'faible' ELSE '' END AS statut_commune,
         CASE WHEN min(l_orderkey % 3) = 0 THEN 'Existant ' ELSE '' END AS statut_adresse,
         CASE max(l_orderkey % 4) WHEN 3 THEN 'eleve' WHEN 2 THEN 'modere' WHEN 1 THEN 'faible' ELSE 'inconnu' END AS severity_label,
         CAST(max(l_orderkey % 4) AS INTEGER) AS severity_score,
         CAST(make_date(year(o_orderdate), 1, 1) AS TIMESTAMP) AS extracted_at,
         make_date(year(o_orderdate), 1, 1) AS extraction_date,
         CAST(make_date(year(o_orderdate), 1, 1) AS TIMESTAMP) AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, year(o_orderdate), l_linestatus, l_returnflag, l_linenumber)"""

BOOKS = """
books AS (
  SELECT p_partkey AS id, ' ' || CAST(p_partkey AS VARCHAR) || ' ' AS upc, p_name || ' ' AS title,
         p_size * 1.5::DOUBLE AS price, p_size * 1.75::DOUBLE AS price_incl_tax, p_size * 0.25::DOUBLE AS tax,
         ' In stock (' || CAST(p_partkey % 23 AS VARCHAR) || ' available)' AS availability,
         CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_partkey % 23 AS INTEGER) END AS stock_count,
         CAST(nullif(p_partkey % 6, 0) AS INTEGER) AS star_rating,
         p_type || '-' || lower(p_brand) || ' ' AS category,
         p_name || ', ' || p_brand AS description,
         'https://books.example/media/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
         'https://books.example/catalogue/' || CAST(p_partkey AS VARCHAR) || '/index.html' AS product_url,
         TIMESTAMP '2024-01-07 03:00:00' AS extracted_at, DATE '2024-01-07' AS extraction_date,
         TIMESTAMP '2024-01-07 03:00:00' AS created_at
  FROM part)"""

QUOTES = """
quotes AS (
  SELECT doc_id AS id, substr(sha256(text || '|' || source || ' ' || upper(lang) || '.'), 1, 16) AS quote_hash,
         ' ' || text AS text, source || ' ' || upper(lang) || '.' AS author_name,
         CASE WHEN doc_id % 50 = 0 THEN NULL
              ELSE replace(replace(source || ' ' || upper(lang) || '.', ' ', '-'), '.', '') END AS author_slug,
         '["' || lang || '"]' AS tags,
         TIMESTAMP '2024-01-07 05:00:00' AS extracted_at, DATE '2024-01-07' AS extraction_date,
         TIMESTAMP '2024-01-07 05:00:00' AS created_at
  FROM documents)"""

AUTHORS = """
authors AS (
  SELECT min(d.doc_id) AS id, replace(replace(source || ' ' || upper(lang) || '.', ' ', '-'), '.', '') AS slug,
         source || ' ' || upper(lang) || '.' AS name,
         'day ' || CAST(min(d.doc_id) AS VARCHAR) AS born_date, 'in ' || upper(lang) AS born_location,
         'Author of ' || CAST(count(*) AS VARCHAR) || ' texts' AS description,
         TIMESTAMP '2024-01-07 05:00:00' AS extracted_at, DATE '2024-01-07' AS extraction_date,
         TIMESTAMP '2024-01-07 05:00:00' AS created_at
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 1
  GROUP BY source, lang)"""

# Authors that no quote names, one per market segment, so that outer joins have a left-only side.
MORE_AUTHORS = """
more_authors AS (
  SELECT DISTINCT c_mktsegment AS author_slug, c_mktsegment AS author_name,
         CAST(NULL AS VARCHAR) AS author_born_date, CAST(NULL AS VARCHAR) AS author_born_location
  FROM customer)"""

METRICS = """
run_metrics AS (
  SELECT event_type AS source, event_type || '_ingestion' AS dag_id, CAST(ts AS DATE) AS run_date,
         count(*) AS items_extracted, count(*) FILTER (WHERE value <= 100) AS items_loaded,
         count(*) FILTER (WHERE value > 100) AS errors
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""


def _when(column, pairs, default):
    chain = F
    for value, label in pairs:
        chain = chain.when(column == value, F.lit(label))
    return chain.otherwise(F.lit(default) if not hasattr(default, "_jc") else default)


def spread(df: DataFrame) -> DataFrame:
    """Rows of one small file over all cores, before raw documents are made of them."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


# Lines that one task sums at most, if they spread evenly, and lines from which their join is not sorted.
LINES_PER_TASK = 500_000
MANY_LINES = 10_000_000


class Tables:
    """The given tables, and the landing tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def alerts(self) -> DataFrame:
        event, code = F.col("event_id"), (F.col("user_id") % 26).cast("int")
        rows = self.events.join(self.nation, code == F.col("n_nationkey"), "left")
        bucket = event % 4
        return rows.select(
            event.alias("id"),
            F.when(event % 997 != 0, F.concat(code.cast("string"), F.lit(" "))).alias("department_code"),
            F.concat(F.lit(" "), F.coalesce("n_name", F.lit("inconnu"))).alias("department_name"),
            _when(F.col("event_type"), [("click", 1), ("error", 2), ("purchase", 3), ("signup", 4)], 5).alias("phenomenon_id"),
            F.col("event_type").alias("phenomenon_name"),
            F.col("ts").alias("begin_time"),
            (F.col("ts") + F.make_dt_interval(hours=(event % 48).cast("int"))).alias("end_time"),
            (bucket + 1).cast("int").alias("color_id"),
            _when(bucket, [(0, "vert"), (1, "jaune"), (2, "orange")], "rouge").alias("color_name"),
            F.when(event % 101 != 0, (bucket + 1).cast("int")).alias("color_level"),
            _when(bucket, [(0, "#31a354"), (1, "#fff600"), (2, "#ffb82b")], "#cc0000").alias("color_hex"),
            F.col("ts").alias("extracted_at"),
            F.to_date("ts").alias("extraction_date"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def commune_profiles(self) -> DataFrame:
        # Orders are summed per customer and year before the dimension joins.
        year, score = F.year("o_orderdate"), F.col("o_orderkey") % 4

        def worst(condition):
            return F.max(F.when(condition, score)).cast("int")

        priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        measures = [
            F.count_if(status == "F").cast("int").alias("naturels_count"),
            F.count_if(status == "O").cast("int").alias("technologiques_count"),
            F.count_if(status.isin("F", "O")).cast("int").alias("total_risks"),
            worst(status == "F").alias("max_severity_naturels"),
            worst(status == "O").alias("max_severity_technologiques"),
        ]
        for stem, level in [("seisme", "1-URGENT"), ("rga", "2-HIGH"), ("radon", "3-MEDIUM"), ("inondation", "5-LOW")]:
            measures += [
                F.bool_or(priority == level).alias(f"{stem}_present"),
                worst(priority == level).alias(f"{stem}_severity"),
            ]
        measures += [
            F.bool_or(F.col("o_totalprice") > 400000).alias("icpe_present"),
            F.bool_or(F.col("o_totalprice") > 450000).alias("nucleaire_present"),
        ]
        per_year = self.orders.groupBy("o_custkey", year.alias("year")).agg(*measures)
        joined = (
            per_year.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
        day = F.make_date("year", F.lit(1), F.lit(1))
        return joined.select(
            (F.col("o_custkey") * 10000 + F.col("year")).alias("id"),
            F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("insee_code"),
            F.col("c_name").alias("commune"),
            F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("code_postal"),
            F.when(F.col("n_nationkey") == 0, "2A").otherwise(F.col("n_nationkey").cast("string")).alias("department_code"),
            F.col("n_name").alias("department_name"),
            F.col("r_name").alias("region"),
            *[c for c in per_year.columns if c not in ("o_custkey", "year")],
            day.cast("timestamp_ntz").alias("extracted_at"),
            day.alias("extraction_date"),
            day.cast("timestamp_ntz").alias("created_at"),
        )

    @cached_property
    def risk_details(self) -> DataFrame:
        # Nearly every group is one line, so lines are dealt out by group before they are summed: to sum them in the
        # tasks that read them takes a map of nearly all their lines, and saves nothing.
        group = ["o_custkey", "year", "l_linestatus", "l_returnflag", "l_linenumber"]
        lines, worst, day = self.lineitem, F.col("worst"), F.make_date("year", F.lit(1), F.lit(1))
        n = lines.count()
        orders = self.orders.hint("shuffle_hash") if n > MANY_LINES else self.orders
        rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.year("o_orderdate").alias("year"), *[c for c in group if c != "year"], "l_orderkey", "l_quantity", "l_discount"
        )
        tasks = max(self.spark.sparkContext.defaultParallelism, 1 + n // LINES_PER_TASK)
        grouped = rows.repartition(tasks, *group).groupBy(*group).agg(
            F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.max("l_quantity").alias("quantity"),
            F.bool_or(F.col("l_discount") >= 0.05).alias("discounted"),
            F.max(F.col("l_orderkey") % 4).cast("int").alias("worst"),
            F.min(F.col("l_orderkey") % 3).alias("third"),
        )
        number = F.col("l_linenumber").cast("string")
        return grouped.select(
            "id",
            F.concat(F.col("o_custkey").cast("string"), F.lit(" ")).alias("insee_code"),
            F.when(F.col("l_linestatus") == "O", "naturel").otherwise("technologique").alias("risk_category"),
            F.concat("l_returnflag", "l_linestatus", number).alias("risk_key"),
            F.concat(F.lit(" Risk "), "l_returnflag", number).alias("risk_libelle"),
            F.when(~(F.col("quantity") > 45), F.col("discounted")).alias("present"),
            _when(worst, [(3, "Risque Important"), (2, "Modéré"), (1, "faible")], "").alias("statut_commune"),
            F.when(F.col("third") == 0, "Existant ").otherwise("").alias("statut_adresse"),
            _when(worst, [(3, "eleve"), (2, "modere"), (1, "faible")], "inconnu").alias("severity_label"),
            worst.alias("severity_score"),
            day.cast("timestamp_ntz").alias("extracted_at"),
            day.alias("extraction_date"),
            day.cast("timestamp_ntz").alias("created_at"),
        )

    @cached_property
    def books(self) -> DataFrame:
        key = F.col("p_partkey")
        stamp = F.lit("2024-01-07 03:00:00").cast("timestamp_ntz")
        return self.part.select(
            key.alias("id"),
            F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("upc"),
            F.concat("p_name", F.lit(" ")).alias("title"),
            (F.col("p_size") * 1.5).alias("price"),
            (F.col("p_size") * 1.75).alias("price_incl_tax"),
            (F.col("p_size") * 0.25).alias("tax"),
            F.concat(F.lit(" In stock ("), (key % 23).cast("string"), F.lit(" available)")).alias("availability"),
            F.when(key % 29 != 0, (key % 23).cast("int")).alias("stock_count"),
            F.nullif(key % 6, F.lit(0)).cast("int").alias("star_rating"),
            F.concat("p_type", F.lit("-"), F.lower("p_brand"), F.lit(" ")).alias("category"),
            F.concat("p_name", F.lit(", "), "p_brand").alias("description"),
            F.concat(F.lit("https://books.example/media/"), key.cast("string"), F.lit(".jpg")).alias("image_url"),
            F.concat(F.lit("https://books.example/catalogue/"), key.cast("string"), F.lit("/index.html")).alias("product_url"),
            stamp.alias("extracted_at"),
            F.lit("2024-01-07").cast("date").alias("extraction_date"),
            stamp.alias("created_at"),
        )

    @staticmethod
    def _author() -> tuple:
        name = F.concat("source", F.lit(" "), F.upper("lang"), F.lit("."))
        return name, F.translate(name, " .", "-")

    @cached_property
    def quotes(self) -> DataFrame:
        name, slug = self._author()
        stamp = F.lit("2024-01-07 05:00:00").cast("timestamp_ntz")
        return self.documents.select(
            F.col("doc_id").alias("id"),
            F.left(F.sha2(F.concat("text", F.lit("|"), name), 256), F.lit(16)).alias("quote_hash"),
            F.concat(F.lit(" "), "text").alias("text"),
            name.alias("author_name"),
            F.when(F.col("doc_id") % 50 != 0, slug).alias("author_slug"),
            F.concat(F.lit('["'), "lang", F.lit('"]')).alias("tags"),
            stamp.alias("extracted_at"),
            F.lit("2024-01-07").cast("date").alias("extraction_date"),
            stamp.alias("created_at"),
        )

    @cached_property
    def authors(self) -> DataFrame:
        name, slug = self._author()
        stamp = F.lit("2024-01-07 05:00:00").cast("timestamp_ntz")
        toxic = self.labels.where("toxic = 1").select("doc_id")
        grouped = (
            self.documents.select("doc_id", "source", "lang")
            .join(toxic, "doc_id")
            .groupBy("source", "lang")
            .agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
        )
        return grouped.select(
            "id",
            slug.alias("slug"),
            name.alias("name"),
            F.concat(F.lit("day "), F.col("id").cast("string")).alias("born_date"),
            F.concat(F.lit("in "), F.upper("lang")).alias("born_location"),
            F.concat(F.lit("Author of "), F.col("n").cast("string"), F.lit(" texts")).alias("description"),
            stamp.alias("extracted_at"),
            F.lit("2024-01-07").cast("date").alias("extraction_date"),
            stamp.alias("created_at"),
        )

    @cached_property
    def more_authors(self) -> DataFrame:
        return self.customer.select(
            F.col("c_mktsegment").alias("author_slug"),
            F.col("c_mktsegment").alias("author_name"),
            F.lit(None).cast("string").alias("author_born_date"),
            F.lit(None).cast("string").alias("author_born_location"),
        ).distinct()

    @cached_property
    def run_metrics(self) -> DataFrame:
        return self.events.groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("run_date")).agg(
            F.count("*").alias("items_extracted"),
            F.count_if(F.col("value") <= 100).alias("items_loaded"),
            F.count_if(F.col("value") > 100).alias("errors"),
        ).withColumn("dag_id", F.concat("source", F.lit("_ingestion")))
