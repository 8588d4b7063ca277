"""The shared test tables seen as patients, practices, drug issues, observations and codelists.

Each view is stated twice, for Spark and as SQL text for the check in another engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import fits, patient_semi
from ..operators.keyfilter import early_codes, early_filter
from ..sources.tables import materialise

STUDY_START, STUDY_END = "1996-01-01", "2000-12-31"
ROLL_START, ROLL_END = "2024-01-05", "2024-01-25"
# Medication and condition columns of the research dataset.
MEDICATIONS = (
    "oral_steroids", "diuretics", "angiotension_receptor_blockers", "ace_inhibitors", "calcium_channel_blockers",
    "beta_blockers", "fibrates", "fusidic_acid", "colchicine", "cyclosporin", "hiv_hcv_protease_inhibitors",
)
CONDITIONS = (
    "hypertension", "hypothyroid", "hyperthyroid", "asthma", "diabetes", "copd", "atrial_fibrillation",
    "atherosclerotic", "smoke", "alcohol",
)
FIRST_MEDICATION_SIZE, FIRST_CONDITION_BRAND = 10, 11
BANDS = {"1": (53000.0, 95000.0), "2": (40000.0, 80000.0)}
ACCEPTED, CONVERT, TARGET = (276,), {155: 1.5}, 276
MEASURE_LOW, MEASURE_HIGH, MEASURE_UNIT = 20000.0, 90000.0, "kg/m2"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# Codes that some even-numbered parts of one size have in ``rare_observation``; other parts keep the brand.
RARE = {"excluded": 30, "moderate": 31, "severe": 32, "measured": 33}
RARE_CODE = "CASE " + " ".join(f"WHEN p_size = {size} AND p_partkey % 2 = 0 THEN '{code}'" for code, size in RARE.items()) + " ELSE p_brand END"
TREATMENTS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5}


_SCHEMAS: dict[str, StructType] = {}


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._listed: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """A shared table; its schema is looked up in the file once and stated from then on."""
        path = f"{self.dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def patient(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS patid", "c_nationkey AS pracid",
            "CASE WHEN c_custkey % 97 = 0 THEN '3' ELSE CAST(1 + c_custkey % 2 AS STRING) END AS gender",
            "CAST(1930 + c_custkey % 70 AS INT) AS yob",
            "CASE WHEN c_custkey % 4 <> 0 THEN CAST(1 + c_custkey % 12 AS INT) END AS mob",
            "CASE WHEN c_custkey % 11 = 0 THEN DATE '1999-12-31' END AS emis_ddate",
            "date_add(DATE '1994-06-01', CAST(c_custkey % 700 AS INT)) AS regstartdate",
            "CASE WHEN c_custkey % 5 = 0 THEN DATE '2000-06-30' END AS regenddate",
            "CASE WHEN c_custkey % 10 = 0 THEN '0' ELSE '1' END AS acceptable",
        )

    @cached_property
    def practice(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).selectExpr("n_nationkey AS pracid", "r_name AS region")

    @cached_property
    def _orders(self) -> DataFrame:
        return self.table("orders").selectExpr("o_orderkey", "o_custkey AS patid", "CAST(o_orderdate AS DATE) AS enterdate")

    @cached_property
    def _lines(self) -> DataFrame:
        return self.table("lineitem")

    def of_patients(self, keys: DataFrame) -> Views:
        """The same views where drug issues and observations are made from the orders of the given patients only.

        Their orders are stored, and lines of other orders are dropped by a filter of order keys before the join.
        """
        mine = Views(self.spark, self.dir)
        mine._orders = materialise(patient_semi(self._orders, keys))
        mine._lines = early_filter(self._lines, mine._orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
        mine._listed = self._listed
        return mine

    def of_codes(self, lists: DataFrame) -> Views:
        """The same views for work that asks for listed codes only: most observations of other codes are left out.

        Their parts are found before lines meet them. Where those fit they are broadcast, else lines are reduced by a filter of
        their keys, so that the table of all lines is never shuffled for the parts. An operator still has to pick the codes.
        """
        mine = Views(self.spark, self.dir)
        mine._orders, mine._lines, mine._listed = self._orders, self._lines, lists.select("code")
        return mine

    @cached_property
    def drug_issue(self) -> DataFrame:
        # Worked out before the join and only picked after it: a semi join on a patient or code then moves below the join.
        lines = self._lines.selectExpr(
            "l_orderkey", "l_partkey AS prodcodeid", "CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS issuedate",
            "CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INT) END AS duration",
        )
        return lines.join(self._orders, F.col("l_orderkey") == F.col("o_orderkey")).select("patid", "prodcodeid", "issuedate", "enterdate", "duration")

    @cached_property
    def observation(self) -> DataFrame:
        return self._observed("p_brand")

    @cached_property
    def rare_observation(self) -> DataFrame:
        """Observations, some of which have one of the rare codes instead of the brand."""
        return self._observed(RARE_CODE)

    def rare_list(self, name: str, code: str) -> DataFrame:
        rows = self.table("part").selectExpr(f"{RARE_CODE} AS code").filter(F.col("code") == code)
        return rows.select(F.lit(name).alias("list_name"), "code", F.col("code").alias("term"))

    def _observed(self, code: str) -> DataFrame:
        lines = self._lines.selectExpr(
            "l_orderkey", "l_partkey", "CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS obsdate", "l_extendedprice AS value",
            "CASE l_returnflag WHEN 'R' THEN '276' WHEN 'A' THEN '155' ELSE '9' END AS numunitid",
        )
        parts = self.table("part").selectExpr("p_partkey", f"{code} AS medcodeid")
        if self._listed is not None:
            parts = early_codes(parts, self._listed, "medcodeid")
            if fits(parts):
                parts = F.broadcast(parts)
            else:
                lines = early_filter(lines, parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")
        return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
            self._orders, F.col("l_orderkey") == F.col("o_orderkey")
        ).select("patid", "medcodeid", "obsdate", "enterdate", "value", "numunitid")

    @cached_property
    def roll_event(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id AS PatientIdentifier", "event_type AS CodeId", "CAST(ts AS DATE) AS EffectiveDate",
            "CASE WHEN event_id % 10 <> 0 THEN value END AS Value",
        )

    def _drug_list(self, name: str, condition: str) -> DataFrame:
        return self.table("part").filter(condition).select(
            F.lit(name).alias("list_name"), F.col("p_partkey").alias("code"), F.col("p_type").alias("term")
        )

    @cached_property
    def exposure_codes(self) -> DataFrame:
        return self._drug_list("exposure", "p_size <= 2")

    @cached_property
    def exclusion_codes(self) -> DataFrame:
        return self._drug_list("exclusion", "p_size = 30")

    @cached_property
    def medication_lists(self) -> DataFrame:
        names = F.array(*[F.lit(m) for m in MEDICATIONS])
        last = FIRST_MEDICATION_SIZE + len(MEDICATIONS) - 1
        return self.table("part").filter(F.col("p_size").between(FIRST_MEDICATION_SIZE, last)).select(
            F.get(names, F.col("p_size") - FIRST_MEDICATION_SIZE).alias("list_name"),
            F.col("p_partkey").alias("code"), F.col("p_type").alias("term"),
        )

    @cached_property
    def brands(self) -> DataFrame:
        """Brands as codes, one row per part: lists hold each code many times over, as the operators must allow."""
        return self.table("part").select(F.col("p_brand").alias("code"), F.col("p_brand").alias("term"))

    def brand_list(self, name: str, *numbers: int) -> DataFrame:
        wanted = [f"Brand#{n}" for n in numbers]
        return self.brands.filter(F.col("code").isin(wanted)).select(F.lit(name).alias("list_name"), "code", "term")

    @cached_property
    def condition_lists(self) -> DataFrame:
        names = F.array(*[F.lit(c) for c in CONDITIONS])
        number = F.substring("code", 7, 2).cast("int")
        return self.brands.filter(number.between(FIRST_CONDITION_BRAND, FIRST_CONDITION_BRAND + len(CONDITIONS) - 1)).select(
            F.get(names, number - FIRST_CONDITION_BRAND).alias("list_name"), "code", "term"
        )

    @cached_property
    def units(self) -> DataFrame:
        """Unit dictionary, an entry for each region: 276 and 155 are kg/m2, 9 and others are not."""
        return self.table("region").selectExpr(
            "CASE r_regionkey WHEN 0 THEN 276 WHEN 1 THEN 155 WHEN 2 THEN 9 ELSE CAST(900 + r_regionkey AS INT) END AS numunitid",
            "CASE WHEN r_regionkey >= 2 THEN 'mmol/L' ELSE 'kg/m2' END AS Description",
        )

    @cached_property
    def ethnicity(self) -> DataFrame:
        return self.table("customer").filter("c_custkey % 13 <> 0").selectExpr(
            "c_custkey AS patid", "CAST(1 + c_nationkey % 6 AS STRING) AS ethnic_6"
        )

    @cached_property
    def roll_patient(self) -> DataFrame:
        """Demographics of the roll-up events' users, taken from the customers of the same number."""
        return self.table("customer").selectExpr(
            "c_custkey AS PatientIdentifier", "CASE WHEN c_custkey % 10 = 0 THEN '0' ELSE '1' END AS IsAcceptable",
            "CAST(1 + c_custkey % 2 AS INT) AS Sex", "CAST(1930 + c_custkey % 70 AS INT) AS YearOfBirth",
            "CASE WHEN c_custkey % 11 = 0 THEN DATE '2024-01-20' END AS DateOfDeath",
        )


def _case(column: str, names, first: int) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {first + i} THEN '{n}'" for i, n in enumerate(names)) + " END"


_LAST_MEDICATION = FIRST_MEDICATION_SIZE + len(MEDICATIONS) - 1
_LAST_CONDITION = FIRST_CONDITION_BRAND + len(CONDITIONS) - 1

SQL_VIEWS = {
    "patient": """SELECT c_custkey AS patid, c_nationkey AS pracid,
        CASE WHEN c_custkey % 97 = 0 THEN '3' ELSE CAST(1 + c_custkey % 2 AS VARCHAR) END AS gender,
        CAST(1930 + c_custkey % 70 AS INTEGER) AS yob,
        CASE WHEN c_custkey % 4 <> 0 THEN CAST(1 + c_custkey % 12 AS INTEGER) END AS mob,
        CASE WHEN c_custkey % 11 = 0 THEN DATE '1999-12-31' END AS emis_ddate,
        DATE '1994-06-01' + CAST(c_custkey % 700 AS INTEGER) AS regstartdate,
        CASE WHEN c_custkey % 5 = 0 THEN DATE '2000-06-30' END AS regenddate,
        CASE WHEN c_custkey % 10 = 0 THEN '0' ELSE '1' END AS acceptable FROM customer""",
    "practice": "SELECT n_nationkey AS pracid, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "drug_issue": """SELECT o_custkey AS patid, l_partkey AS prodcodeid,
        CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS issuedate,
        CAST(o_orderdate AS DATE) AS enterdate,
        CASE WHEN l_returnflag <> 'N' THEN CAST(trunc(l_quantity) AS INTEGER) END AS duration
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "observation": """SELECT o_custkey AS patid, p_brand AS medcodeid,
        CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS obsdate,
        CAST(o_orderdate AS DATE) AS enterdate, l_extendedprice AS value,
        CASE l_returnflag WHEN 'R' THEN '276' WHEN 'A' THEN '155' ELSE '9' END AS numunitid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "roll_event": """SELECT user_id AS PatientIdentifier, event_type AS CodeId, CAST(ts AS DATE) AS EffectiveDate,
        CASE WHEN event_id % 10 <> 0 THEN value END AS Value FROM events""",
    "roll_patient": """SELECT c_custkey AS PatientIdentifier, CASE WHEN c_custkey % 10 = 0 THEN '0' ELSE '1' END AS IsAcceptable,
        CAST(1 + c_custkey % 2 AS INTEGER) AS Sex, CAST(1930 + c_custkey % 70 AS INTEGER) AS YearOfBirth,
        CASE WHEN c_custkey % 11 = 0 THEN DATE '2024-01-20' END AS DateOfDeath FROM customer""",
    "exposure_codes": "SELECT p_partkey AS code, p_type AS term FROM part WHERE p_size <= 2",
    "exclusion_codes": "SELECT p_partkey AS code, p_type AS term FROM part WHERE p_size = 30",
    "medication_lists": f"""SELECT {_case("p_size", MEDICATIONS, FIRST_MEDICATION_SIZE)} AS list_name, p_partkey AS code, p_type AS term
        FROM part WHERE p_size BETWEEN {FIRST_MEDICATION_SIZE} AND {_LAST_MEDICATION}""",
    "brands": "SELECT DISTINCT p_brand AS code FROM part",
    "condition_lists": f"""SELECT {_case("CAST(substr(code, 7) AS INTEGER)", CONDITIONS, FIRST_CONDITION_BRAND)} AS list_name, code
        FROM brands WHERE CAST(substr(code, 7) AS INTEGER) BETWEEN {FIRST_CONDITION_BRAND} AND {_LAST_CONDITION}""",
    "units": """SELECT CASE r_regionkey WHEN 0 THEN 276 WHEN 1 THEN 155 WHEN 2 THEN 9 ELSE CAST(900 + r_regionkey AS INTEGER) END AS numunitid,
        CASE WHEN r_regionkey >= 2 THEN 'mmol/L' ELSE 'kg/m2' END AS Description FROM region""",
    "ethnicity": "SELECT c_custkey AS patid, CAST(1 + c_nationkey % 6 AS VARCHAR) AS ethnic_6 FROM customer WHERE c_custkey % 13 <> 0",
}


def with_views(select: str, **more: str) -> str:
    """SQL text whose WITH clause states the views, then ``more``, then the query itself."""
    parts = ", ".join(f"{name} AS ({sql})" for name, sql in {**SQL_VIEWS, **more}.items())
    return f"WITH {parts} {select}"
