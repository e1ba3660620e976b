"""The given star tables seen as the case-research domain: courts, judges, acts, sections, cases, batches, history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Domain:
    """Domain tables over one folder of Parquet tables. Every method is a plan; nothing is cached."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def courts(self) -> DataFrame:
        key = F.col("n_nationkey").cast("long")
        return self.raw("nation").select(key.alias("court_id"), F.col("n_name").alias("court_name"), F.when(key % 8 != 0, F.concat(F.lit("N"), key.cast("string"))).alias("court_code"))

    def judges(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("judge_id"), F.col("s_name").alias("full_name"))

    def acts(self) -> DataFrame:
        number = F.substring("p_brand", 7, 9).cast("long")
        acts = self.raw("part").select(number.alias("act_id"), "p_brand").distinct()
        return acts.select(
            "act_id", F.concat("p_brand", F.lit(" Act")).alias("act_name"), F.when(F.col("act_id") % 2 == 0, (F.col("act_id") + 1900).cast("int")).alias("act_year"), F.concat(F.lit("B"), F.col("act_id").cast("string")).alias("short_code")
        )

    def sections(self) -> DataFrame:
        suffix = F.when(F.col("p_type") == "ECONOMY", "A").when(F.col("p_type") == "PROMO", "(1)").when(F.col("p_type") == "SMALL", "-B").otherwise("")
        return self.raw("part").select(
            F.col("p_partkey").alias("section_id"), F.substring("p_brand", 7, 9).cast("long").alias("act_id"), F.concat(F.col("p_size").cast("string"), suffix).alias("section_number"), F.col("p_size").alias("size"), F.col("p_type").alias("kind")
        )

    @staticmethod
    def _numbered(names: DataFrame, column: str, id_name: str) -> DataFrame:
        """Closed vocabularies of a handful of names, numbered in their order."""
        listed = names.select(F.col(column).alias("name")).distinct().agg(F.array_sort(F.collect_list("name")).alias("names"))
        return listed.select(F.posexplode("names").alias("n", "name")).select((F.col("n") + 1).cast("long").alias(id_name), "name")

    def industries(self) -> DataFrame:
        return self._numbered(self.raw("customer"), "c_mktsegment", "industry_id")

    def ministries(self) -> DataFrame:
        return self._numbered(self.raw("part"), "p_type", "ministry_id")

    def lines(self) -> DataFrame:
        """One row per case and order line: judge, section with its number, its act and ministry."""
        sections = self.sections().join(F.broadcast(self.ministries().withColumnRenamed("name", "kind")), "kind")
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_suppkey").alias("judge_id"), F.col("l_partkey").alias("section_id"))
        return lines.join(sections, "section_id").select("case_id", "judge_id", "section_id", "act_id", "size", "ministry_id", "section_number")

    def named_lines(self) -> DataFrame:
        """What the id arrays of a case are gathered from, a row per line: judge, section, its ministry, and the act where the case names it itself."""
        return self.lines().select("case_id", "judge_id", "section_id", "ministry_id", "act_id", "section_number", F.when(F.col("size") <= 25, F.col("act_id")).alias("named_act"))

    def with_arrays(self, cases: DataFrame) -> DataFrame:
        """cases with their id arrays, never null, sorted and distinct. Only the lines of these cases are gathered."""
        ids = lambda c: F.array_sort(F.collect_set(c))
        arrays = self.lines().groupBy("case_id").agg(
            ids("judge_id").alias("bench"), ids("section_id").alias("sections"), ids(F.when(F.col("size") <= 25, F.col("act_id"))).alias("acts"), ids("ministry_id").alias("ministries")
        )
        none = F.array().cast("array<bigint>")
        return cases.join(arrays, "case_id", "left").withColumns({c: F.coalesce(c, none) for c in ("bench", "sections", "acts", "ministries")})

    def cases(self, text: bool = False) -> DataFrame:
        """The flat fact table with its id arrays, never null, sorted and distinct. text: with the judgment's text."""
        return self.with_arrays(self.flat(text))

    def flat(self, text: bool = False) -> DataFrame:
        """The fact table without what has to be gathered from its lines."""
        industry = F.broadcast(self.industries().select(F.col("name").alias("c_mktsegment"), "industry_id"))
        customer = self.raw("customer").join(industry, "c_mktsegment").join(F.broadcast(self.raw("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        k, year = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
        s = k.cast("string")
        number = (
            F.when(k % 4 == 0, F.concat(F.lit("Civil Appeal No. "), s, F.lit(" of "), year))
            .when(k % 4 == 1, F.concat(F.lit("Crl.A. No.-"), F.lpad(s, 6, "0"), F.lit(" - "), year))
            .when(k % 4 == 2, F.concat(F.lit("SLP(C) No. "), s, F.lit("/"), year))
            .otherwise(F.concat(F.lit("Misc "), s))
        )
        base = (
            self.raw("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                k.alias("case_id"), F.col("c_nationkey").cast("long").alias("court_id"), F.col("c_name").alias("petitioner"), F.concat(F.lit("State of "), "n_name").alias("respondent"),
                F.concat("c_name", F.lit(" Vs State of "), "n_name").alias("party_raw"), number.alias("case_number"),
                F.when(k % 7 != 0, F.to_date("o_orderdate")).alias("judgment_date"),
                F.when(F.col("o_orderstatus") == "F", "Dismissed").when(F.col("o_orderstatus") == "O", "Allowed").alias("disposition"),
                F.element_at(F.create_map(*[F.lit(x) for x in ("1", "Petitioner", "2", "Respondent", "3", "Partly", "4", "Neither")]), F.substring("o_orderpriority", 1, 1)).alias("favouring_party"),
                F.when(k % 10 == 0, "NOT_PUBLISHED").when(k % 10 == 1, "DOWNLOAD_FAILED").otherwise("AVAILABLE").alias("judgment_status"),
                F.when(k % 5 != 0, F.concat(year, F.lit(" INSC "), s)).alias("neutral_citation"), F.col("o_orderdate").alias("created_at"),
                F.array("industry_id").alias("industries"),
            )
        )
        if not text:
            return base
        return base.join(self.raw("documents").select(F.col("doc_id").alias("case_id"), "text"), "case_id", "left")

    def events(self) -> DataFrame:
        """Batch events and log lines: batch_id, log_id, kind, at, details, n."""
        kind = F.element_at(F.create_map(*[F.lit(x) for x in ("signup", "STARTED", "view", "HEARTBEAT", "error", "FAILED", "purchase", "COMPLETED", "click", "LOG")]), F.col("event_type"))
        return self.raw("events").select(
            F.col("user_id").alias("batch_id"), F.col("event_id").alias("log_id"), kind.alias("kind"), F.col("ts").alias("at"), F.col("props").alias("details"), F.get_json_object("props", "$.k").cast("int").alias("n")
        )

    def history(self) -> DataFrame:
        """Search history as it was entered, repeats included."""
        return self.raw("events").select(
            F.col("event_id").alias("entry_id"), "user_id", F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k")).alias("query"), F.col("ts").alias("created_at")
        )

    def items(self) -> DataFrame:
        """Batch items as they were discovered, with repeated keys: batch_id, item_key, position, status, amount."""
        status = F.when(F.col("l_returnflag") == "A", "DONE").when(F.col("l_returnflag") == "R", "FAILED").otherwise("PENDING")
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("batch_id"), F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("item_key"), F.col("l_orderkey").alias("case_id"),
            F.col("l_partkey").alias("part_id"), status.alias("status"), F.col("l_linestatus").alias("flag"), F.col("l_linenumber").alias("position"), F.col("l_shipdate").alias("at"),
        )

    def batches(self) -> DataFrame:
        """One batch per order: court, status, request and finish time, heartbeat, counters, actor."""
        k = F.col("o_orderkey")
        status = (
            F.when(k % 9 == 0, "QUEUED").when(k % 9 == 1, "RUNNING").when(k % 9 == 2, "CANCELLED").when(k % 9 == 3, "RATE_LIMITED").when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "FAILED").otherwise("SOURCE_BLOCKED")
        )
        days = (k % 30).cast("int")
        asked = F.expr("timestamp_ntz '2024-01-01 00:00:00'") + F.make_dt_interval(days, (k % 24).cast("int"), (k % 60).cast("int"))
        return self.raw("orders").join(self.raw("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
            k.alias("batch_id"), F.col("c_nationkey").cast("long").alias("court_id"), status.alias("status"), asked.alias("requested_at"),
            F.when(k % 9 > 3, asked + F.make_dt_interval(F.lit(0), F.lit(0), (k % 500).cast("int"))).alias("finished_at"),
            F.when(k % 9 == 1, asked + F.make_dt_interval(F.lit(0), F.lit(0), (k % 7).cast("int"))).alias("heartbeat_at"),
            (k % 50).cast("int").alias("promoted"), F.when(k % 6 != 0, F.col("o_custkey") % 10).alias("started_by"), (k % 4 == 0).alias("cancel_requested"), (k % 3 == 0).alias("discovered"),
            F.to_date("o_orderdate").alias("from_date"), F.date_add(F.to_date("o_orderdate"), (k % 40).cast("int")).alias("to_date"),
        )


# The same tables in DuckDB SQL; a query's SQL names those that it uses and gets them as CTEs.
CTES = {
    "courts": "SELECT CAST(n_nationkey AS BIGINT) court_id, n_name court_name, CASE WHEN n_nationkey % 8 <> 0 THEN 'N' || n_nationkey END court_code FROM nation",
    "judges": "SELECT s_suppkey judge_id, s_name full_name FROM supplier",
    "acts": "SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) act_id, p_brand || ' Act' act_name, CASE WHEN CAST(substr(p_brand, 7) AS BIGINT) % 2 = 0 THEN CAST(1900 + CAST(substr(p_brand, 7) AS BIGINT) AS INTEGER) END act_year, 'B' || substr(p_brand, 7) short_code FROM part",
    "sections": "SELECT p_partkey section_id, CAST(substr(p_brand, 7) AS BIGINT) act_id, CAST(p_size AS VARCHAR) || CASE p_type WHEN 'ECONOMY' THEN 'A' WHEN 'PROMO' THEN '(1)' WHEN 'SMALL' THEN '-B' ELSE '' END section_number, p_size size, p_type kind FROM part",
    "industries": "SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) industry_id, name FROM (SELECT DISTINCT c_mktsegment name FROM customer) x",
    "ministries": "SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) ministry_id, name FROM (SELECT DISTINCT p_type name FROM part) x",
    "lines": "SELECT l_orderkey case_id, l_suppkey judge_id, section_id, act_id, size, ministry_id FROM lineitem JOIN sections ON l_partkey = section_id JOIN ministries ON name = kind",
    "cases": """SELECT o_orderkey case_id, CAST(c_nationkey AS BIGINT) court_id, c_name petitioner, 'State of ' || n_name respondent, c_name || ' Vs State of ' || n_name party_raw,
        CASE o_orderkey % 4 WHEN 0 THEN 'Civil Appeal No. ' || o_orderkey || ' of ' || year(o_orderdate) WHEN 1 THEN 'Crl.A. No.-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') || ' - ' || year(o_orderdate) WHEN 2 THEN 'SLP(C) No. ' || o_orderkey || '/' || year(o_orderdate) ELSE 'Misc ' || o_orderkey END case_number,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END judgment_date, CASE o_orderstatus WHEN 'F' THEN 'Dismissed' WHEN 'O' THEN 'Allowed' END disposition,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Petitioner' WHEN '2' THEN 'Respondent' WHEN '3' THEN 'Partly' WHEN '4' THEN 'Neither' END favouring_party,
        CASE o_orderkey % 10 WHEN 0 THEN 'NOT_PUBLISHED' WHEN 1 THEN 'DOWNLOAD_FAILED' ELSE 'AVAILABLE' END judgment_status,
        CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) || ' INSC ' || o_orderkey END neutral_citation, o_orderdate created_at, industry_id
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey JOIN industries ON name = c_mktsegment""",
    "case_bench": "SELECT DISTINCT case_id, judge_id FROM lines",
    "case_sections": "SELECT DISTINCT case_id, section_id FROM lines",
    "case_acts": "SELECT DISTINCT case_id, act_id FROM lines WHERE size <= 25",
    "case_ministries": "SELECT DISTINCT case_id, ministry_id FROM lines",
    "log_events": "SELECT user_id batch_id, event_id log_id, CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'view' THEN 'HEARTBEAT' WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' ELSE 'LOG' END kind, ts AS \"at\", props details, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) n FROM events",
    "history": "SELECT event_id entry_id, user_id, event_type || ' ' || regexp_extract(props, '([0-9]+)', 1) query, ts created_at FROM events",
    "items": "SELECT l_suppkey batch_id, l_orderkey || '/' || l_linenumber item_key, l_orderkey case_id, l_partkey part_id, CASE l_returnflag WHEN 'A' THEN 'DONE' WHEN 'R' THEN 'FAILED' ELSE 'PENDING' END status, l_linestatus flag, l_linenumber \"position\", l_shipdate AS \"at\" FROM lineitem",
    "batches": """SELECT o_orderkey batch_id, CAST(c_nationkey AS BIGINT) court_id,
        CASE WHEN o_orderkey % 9 = 0 THEN 'QUEUED' WHEN o_orderkey % 9 = 1 THEN 'RUNNING' WHEN o_orderkey % 9 = 2 THEN 'CANCELLED' WHEN o_orderkey % 9 = 3 THEN 'RATE_LIMITED' WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE 'SOURCE_BLOCKED' END status,
        asked requested_at, CASE WHEN o_orderkey % 9 > 3 THEN asked + to_minutes(CAST(o_orderkey % 500 AS INTEGER)) END finished_at, CASE WHEN o_orderkey % 9 = 1 THEN asked + to_minutes(CAST(o_orderkey % 7 AS INTEGER)) END heartbeat_at,
        CAST(o_orderkey % 50 AS INTEGER) promoted, CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey % 10 END started_by, o_orderkey % 4 = 0 cancel_requested, o_orderkey % 3 = 0 discovered,
        CAST(o_orderdate AS DATE) from_date, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS DATE) to_date
        FROM (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 30 AS INTEGER)) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) asked FROM orders) o JOIN customer ON o_custkey = c_custkey""",
}
