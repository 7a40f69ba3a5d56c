"""The model tables derived from the sample star schema (orders, line items, suppliers, events).

An order plays a proposal, a line item a stage, a contact and a gift, a supplier a fundraiser, a
customer a donor. All expressions are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeline.functions.fiscal import fiscal_year

DONOR_BASE = 1_000_000
MONEY = "decimal(18,2)"


def _int(column: str) -> Column:
    return F.col(column).cast("long")


def _donor(column: str) -> Column:
    return _int(column) + DONOR_BASE


def _text(column: Column) -> Column:
    return column.cast("string")


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _pair(column: str) -> Column:
    """The even member of an even-odd pair: 6 and 7 give 6."""
    return _int(column) - _int(column) % 2


class SampleTables:
    """Reads the star schema in ``folder`` and offers each model table as a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}
        self._files: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._files[name]

    def __getitem__(self, name: str) -> DataFrame:
        """A model table by name, built when first asked for."""
        if name not in self._built:
            self._built[name] = getattr(self, name)()
        return self._built[name]

    def proposal(self) -> DataFrame:
        key, day = _int("o_orderkey"), F.to_date("o_orderdate")
        price = F.col("o_totalprice").cast(MONEY)
        finished, zero = F.col("o_orderstatus") == "F", F.lit(0).cast(MONEY)
        stage = (
            F.when(F.col("o_orderstatus") == "O", "QU")
            .when(F.col("o_orderstatus") == "P", "SP")
            .when(key % 5 == 0, "CN")
            .when(key % 5 == 1, "TD")
            .when(key % 5 == 2, "DQ")
            .when(key % 5 == 3, "NR")
            .otherwise("RP")
        )
        inactive = finished | ((F.col("o_orderstatus") == "O") & (key % 7 == 0))
        unit = _text(_int("o_custkey") % 5)
        # some proposals are shared with the partner of the donor's household
        partners = F.when(key % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        orders = self._read("orders").withColumn("partner", F.explode(partners))
        return orders.select(
            key.alias("proposal_id"),
            _donor("o_custkey").bitwiseXOR(F.col("partner").cast("long")).alias("entity_id"),
            _donor("o_custkey").alias("summary_entity_id"),
            _pair("o_custkey").alias("prospect_id"),
            F.when((F.col("partner") == 1) | (key % 13 == 4), "N").otherwise("Y").alias("primary_ind"),
            F.lit(1).alias("primary_ind_cnt"),
            F.when(inactive, "N").otherwise("Y").alias("active_ind"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "ESP").otherwise("MG").alias(
                "proposal_type"
            ),
            stage.alias("stage_code"),
            stage.alias("stage_desc"),
            _text(key % 9).alias("stage_rank_code"),
            day.alias("start_dt"),
            F.when(finished, F.date_add(day, (30 + key % 300).cast("int"))).alias("stop_dt"),
            F.when(key % 4 != 0, F.date_add(day, (180 + key % 90).cast("int"))).alias(
                "expected_date"
            ),
            F.when((key % 3 != 0) & (key % 8 != 5), F.date_add(day, (key % 120).cast("int"))).alias(
                "initial_contribution_dt"
            ),
            F.when(key % 9 == 0, zero).otherwise(price).alias("original_ask_amt"),
            F.when((key % 3 == 0) | (key % 8 == 6), zero).otherwise(price).alias("ask_amt"),
            F.when(finished & ((key % 5 == 4) | (key % 4 == 2)), price)
            .otherwise(zero)
            .alias("granted_amt"),
            F.concat(F.lit("Plan "), _text(key)).alias("proposal_title"),
            _text(key % 3).alias("program_code"),
            F.concat(F.lit("Program "), _text(key % 3)).alias("program_desc"),
            unit.alias("unit_code"),
            F.concat(F.lit("Unit "), unit).alias("unit_desc"),
            F.concat(F.lit("R"), _text(key)).alias("crm_id"),
            F.date_add(day, (key % 50).cast("int")).alias("proposal_stage_begin_dt"),
        )

    def assignment(self) -> DataFrame:
        shipped = F.to_date("l_shipdate")
        lines = (
            self._read("lineitem")
            .groupBy(_int("l_orderkey").alias("order_id"), _int("l_suppkey").alias("person"))
            .agg(
                F.min(shipped).alias("first_day"),
                F.max(shipped).alias("last_day"),
                F.bool_or(F.col("l_linestatus") == "O").alias("is_open"),
            )
        )
        people = self._read("supplier").select(
            _int("s_suppkey").alias("person"), "s_name", _int("s_nationkey").alias("nation")
        )
        orders = self._read("orders").select(
            _int("o_orderkey").alias("order_id"), _int("o_custkey").alias("o_custkey")
        )
        office = _text(
            F.when(F.col("person") % 3 == 0, (F.col("nation") + F.col("order_id")) % 5).otherwise(
                F.col("nation") % 5
            )
        )
        described = F.concat(F.lit("Unit "), office)
        return (
            lines.join(orders, "order_id")
            .join(people, "person")
            .select(
                (F.col("order_id") * 100_000 + F.col("person")).alias("assignment_id"),
                F.col("person").alias("assignment_entity_id"),
                F.col("order_id").alias("proposal_id"),
                _pair("o_custkey").alias("prospect_id"),
                _donor("o_custkey").alias("entity_id"),
                F.concat(F.lit("F"), _text(F.col("nation"))).alias("assignment_first_name"),
                F.col("s_name").alias("assignment_last_name"),
                F.when((F.col("order_id") + F.col("person")) % 11 == 4, "AD")
                .otherwise("DO")
                .alias("assignment_type"),
                F.when(F.col("is_open"), "Y").otherwise("N").alias("active_ind"),
                office.alias("office_code"),
                described.alias("office_desc"),
                _text(F.col("person") % 4).alias("program_code"),
                F.concat(F.lit("Program "), _text(F.col("person") % 4)).alias("program_desc"),
                office.alias("unit_code"),
                described.alias("unit_desc"),
                F.col("first_day").alias("start_date"),
                F.when(~F.col("is_open"), F.date_add("last_day", 365)).alias("stop_date"),
            )
        )

    def stage(self) -> DataFrame:
        line = F.col("l_linenumber")
        codes = F.array(*[F.lit(c) for c in ("QU", "CU", "PD", "SP", "GS", "DQ", "TD")])
        return (
            self._read("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.min(F.to_date("l_shipdate")).alias("stage_date"))
            .select(
                (_int("l_orderkey") * 8 + line).alias("proposal_stage_id"),
                _int("l_orderkey").alias("proposal_id"),
                F.element_at(codes, line).alias("stage_code"),
                "stage_date",
            )
        )

    def stage_history(self) -> DataFrame:
        """Stage history played by the event stream."""
        kind = F.col("event_type")
        code = (
            F.when(kind == "signup", "QU")
            .when(kind == "view", "CU")
            .when(kind == "click", "PD")
            .when(kind == "purchase", "SP")
            .otherwise("CN")
        )
        order = (
            F.when(kind == "signup", 1)
            .when(kind == "view", 2)
            .when(kind == "click", 3)
            .when(kind == "purchase", 4)
            .otherwise(0)
        )
        moment = F.col("ts").cast("timestamp")
        return self._read("events").select(
            _int("user_id").alias("d_proposal_key"),
            _int("user_id").alias("proposal_id"),
            _int("event_id").alias("stage_id"),
            code.alias("stage_code"),
            code.alias("stage_desc"),
            order.alias("move_order"),
            F.when(kind == "click", 0).otherwise(order).alias("qu_move_order"),
            order.alias("stage_adv_order"),
            moment.alias("stage_date"),
            moment.alias("record_effective_date"),
            F.when(_int("event_id") % 50 == 0, F.lit("2024-06-01").cast("timestamp"))
            .otherwise(F.lit("9999-12-31").cast("timestamp"))
            .alias("record_expire_date"),
        )

    def stage_history_lines(self) -> DataFrame:
        """Stage history of the proposals themselves, from the same line items as ``stage``."""
        stage, line = self["stage"], F.col("proposal_stage_id") % 8
        moment = F.col("stage_date").cast("timestamp")
        return stage.select(
            F.col("proposal_id").alias("d_proposal_key"),
            "proposal_id",
            F.col("proposal_stage_id").alias("stage_id"),
            "stage_code",
            F.col("stage_code").alias("stage_desc"),
            line.cast("int").alias("move_order"),
            F.when(F.col("stage_code").isin("DQ", "TD"), 0)
            .otherwise(line.cast("int"))
            .alias("qu_move_order"),
            line.cast("int").alias("stage_adv_order"),
            moment.alias("stage_date"),
            moment.alias("record_effective_date"),
            F.when(F.col("proposal_stage_id") % 50 == 0, F.lit("2001-06-01").cast("timestamp"))
            .otherwise(F.lit("9999-12-31").cast("timestamp"))
            .alias("record_expire_date"),
        )

    def contact(self) -> DataFrame:
        lines = self._read("lineitem").select(
            _int("l_orderkey").alias("order_id"),
            _int("l_partkey").alias("part"),
            _int("l_suppkey").alias("person"),
            _int("l_linenumber").alias("line"),
            "l_returnflag",
            "l_linestatus",
            F.to_date("l_shipdate").alias("contact_date"),
        )
        orders = self._read("orders").select(
            _int("o_orderkey").alias("order_id"), _int("o_custkey").alias("o_custkey")
        )
        kind = (
            F.when(F.col("l_returnflag") == "A", "V")
            .when(F.col("l_returnflag") == "R", "VIR")
            .otherwise("E")
        )
        attitude = F.when(F.col("l_linestatus") == "O", "Y").otherwise("N")
        unit = _text(F.col("part") % 5)
        return lines.join(orders, "order_id").select(
            (F.col("order_id") * 8 + F.col("line")).alias("report_id"),
            "contact_date",
            kind.alias("contact_type"),
            kind.alias("contact_type_desc"),
            _none("string").alias("contact_purpose_code"),
            _none("string").alias("contact_purpose_desc"),
            attitude.alias("contact_attitude_code"),
            attitude.alias("contact_attitude_desc"),
            _donor("o_custkey").alias("contact_entity_id"),
            F.when(F.col("line") % 2 == 1, F.col("part") % 100 + DONOR_BASE).alias(
                "contact_alt_entity_id"
            ),
            F.when(F.col("line") != 7, F.col("person")).alias("contact_credit_entity_id"),
            (F.col("part") % 10).alias("author_entity_id"),
            _text(F.col("person") % 5).alias("contact_credit_unit_code"),
            unit.alias("unit_code"),
            F.concat(F.lit("Unit "), unit).alias("unit_desc"),
        )

    def entity(self) -> DataFrame:
        key, donor = _int("c_custkey"), _donor("c_custkey")
        segment = F.col("c_mktsegment")
        donors = self._read("customer").select(
            donor.alias("entity_id"),
            (_pair("c_custkey") + DONOR_BASE).alias("hh_corp_entity_id"),
            F.col("c_name").alias("report_name"),
            F.lit("A").alias("record_status_code"),
            F.when(key % 2 == 1, donor - 1).alias("spouse_entity_id"),
            F.substring(segment, 1, 1).alias("capacity_rating_code"),
            segment.alias("capacity_rating_desc"),
            F.col("c_name").alias("last_name"),
            F.when(donor % 5 != 0, segment).alias("first_name"),
            F.when(donor % 3 != 0, segment).alias("middle_name"),
            F.when(donor % 7 == 0, "Jr").alias("pers_suffix"),
            F.when(donor % 11 == 0, "PhD").alias("prof_suffix"),
        )
        staff = self._read("supplier").select(
            _int("s_suppkey").alias("entity_id"),
            _int("s_suppkey").alias("hh_corp_entity_id"),
            F.col("s_name").alias("report_name"),
            F.lit("A").alias("record_status_code"),
            _none("long").alias("spouse_entity_id"),
            _none("string").alias("capacity_rating_code"),
            _none("string").alias("capacity_rating_desc"),
            F.col("s_name").alias("last_name"),
            *[
                _none("string").alias(n)
                for n in ("first_name", "middle_name", "pers_suffix", "prof_suffix")
            ],
        )
        return donors.unionByName(staff)

    def prospect(self) -> DataFrame:
        sixth = _int("c_custkey") % 6
        return self._read("customer").select(
            _pair("c_custkey").alias("prospect_id"),
            _donor("c_custkey").alias("entity_id"),
            F.concat(F.lit("Prospect "), _text(_pair("c_custkey"))).alias("prospect_name"),
            F.when(sixth == 0, "Y").when(sixth <= 3, "N").alias("prospect_entity_primary_ind"),
            F.when(sixth == 5, "N").otherwise("Y").alias("active_ind"),
            (_int("c_custkey") % 2).cast("int").alias("active_ind_cnt"),
            F.date_add(F.lit("1995-01-01").cast("date"), sixth.cast("int")).alias("start_date"),
            F.when(sixth == 5, F.lit("1999-12-31").cast("date")).alias("stop_date"),
            _none("date").alias("expected_date"),
            F.concat(F.lit("X"), _text(_int("c_custkey"))).alias("crm_id"),
        )

    def date_dim(self) -> DataFrame:
        days = "sequence(date'1995-01-01', date'2003-06-30', interval 1 day)"
        return self.spark.range(1).select(F.explode(F.expr(days)).alias("calendar_dt")).select(
            "calendar_dt", fiscal_year(F.col("calendar_dt")).alias("fiscal_yr")
        )

    def goal(self) -> DataFrame:
        k, person, year = F.col("k"), F.col("person"), F.col("fiscal_year")
        role = (
            F.when((F.col("nation") + k) % 3 == 0, "Major Gift")
            .when((F.col("nation") + k) % 3 == 1, "Annual")
            .otherwise("Planned")
        )
        return (
            self._read("supplier")
            .select(_int("s_suppkey").alias("person"), _int("s_nationkey").alias("nation"))
            .withColumn("fiscal_year", F.explode(F.sequence(F.lit(1995), F.lit(2002))))
            .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
            .filter((k == 0) | (person % 4 == 0))
            .select(
                person.alias("entity_id"),
                year.alias("fiscal_year"),
                role.alias("fundraiser_role"),
                F.when(k == 0, "Y").when(person % 8 != 0, "N").alias("active"),
                F.date_add(F.make_date(year - 1, F.lit(7), F.lit(1)), k).alias("created_date"),
            )
        )

    def record_type(self) -> DataFrame:
        person = _int("s_suppkey")
        first = F.when(person % 10 == 9, "SX").otherwise("SF")
        codes = F.when(person % 2 == 0, F.array(first, F.lit("AL"))).otherwise(F.array(first))
        return self._read("supplier").select(
            person.alias("entity_id"), F.explode(codes).alias("record_type_code")
        )

    def gift(self) -> DataFrame:
        lines = self._read("lineitem").select(
            _int("l_orderkey").alias("proposal_id"), "l_shipdate", "l_returnflag", "l_extendedprice"
        )
        orders = self._read("orders").select(
            _int("o_orderkey").alias("proposal_id"), _donor("o_custkey").alias("donor_entity_id_nbr")
        )
        return lines.join(orders, "proposal_id").select(
            "proposal_id",
            "donor_entity_id_nbr",
            F.to_date("l_shipdate").alias("gift_credit_dt"),
            F.when(F.col("l_returnflag") == "N", "N").otherwise("Y").alias("pledged_basis_flg"),
            F.col("l_extendedprice").cast(MONEY).alias("transaction_credited_amt"),
        )

    def dated_assignment(self) -> DataFrame:
        return self["assignment"].select(
            "proposal_id",
            F.col("assignment_entity_id").alias("assigned_to_entity_id_nbr"),
            F.col("start_date").alias("assignment_begin_dt"),
            F.col("stop_date").alias("assignment_end_dt"),
            F.col("office_code").alias("office_assigned_to_cd"),
        )

    def proposal_summary(self) -> DataFrame:
        return self._read("orders").select(
            _int("o_orderkey").alias("proposal_id"),
            F.concat(F.lit("(Unit "), _text(_int("o_orderkey") % 5), F.lit(") DO")).alias(
                "proposal_assignments"
            ),
        )

    def entity_prospect_summary(self) -> DataFrame:
        nation = _text(_int("c_nationkey"))
        return self._read("customer").select(
            _donor("c_custkey").alias("entity_id"),
            F.col("c_mktsegment").alias("capacity_rating_desc"),
            F.when(_int("c_custkey") % 4 != 0, F.concat(F.lit("Mgr"), nation)).alias(
                "primary_manager_last_nm"
            ),
            F.concat(F.lit("M"), nation).alias("primary_manager_first_nm"),
        )
