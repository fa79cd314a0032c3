"""Registers into one schema, and one reason for every dropped row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions import register as reg
from rosterforge.functions import text as tx
from rosterforge.operators.ordering import mark_first

# Sources in the order in which they claim duplicates.
SOURCE_RANK = {"TX": 0, "WA": 1}


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _coordinate(rows: DataFrame, raw: Column) -> Column:
    """Null where the coordinate, or the whole line (`_broken` of a scan), cannot be read."""
    value = reg.parse_coordinate(raw)
    return F.when(~F.col("_broken"), value) if "_broken" in rows.columns else value


def standardize_tx(raw: DataFrame) -> DataFrame:
    """Register with a Y/N status flag and a ready full address."""
    geo = F.col("location_address_geo")
    status = F.when(F.col("temporarily_closed") == "YES", reg.TEMPORARILY_CLOSED).otherwise(
        reg.status_from_flag(F.col("operation_status"))
    )
    return raw.select(
        F.concat(F.lit("TX-"), F.coalesce("operation_id", F.lit("UNKNOWN"))).alias("id"),
        F.lit("TX").alias("source_state"),
        tx.key_value_text(F.col("_raw")).alias("original_record"),
        tx.normalize_name(F.col("operation_name")).alias("name"),
        reg.normalize_type(F.col("operation_type")).alias("type"),
        status.alias("status"),
        reg.normalize_date(F.col("issuance_date")).alias("license_date"),
        F.struct(
            _filled("location_address").alias("full"),
            _filled("address_line").alias("street"),
            _filled("city").alias("city"),
            _filled("state").alias("state"),
            _filled("zipcode").alias("zip"),
            _coordinate(raw, geo["latitude"]).alias("latitude"),
            _coordinate(raw, geo["longitude"]).alias("longitude"),
        ).alias("address"),
        F.struct(
            reg.normalize_phone(F.col("phone_number")).alias("phone"),
            reg.normalize_email(F.col("email_address")).alias("email"),
            F.col("website_address").alias("website"),
            F.col("administrator_director_name").alias("director_name"),
        ).alias("contact"),
        reg.parse_capacity(F.col("total_capacity")).alias("capacity"),
        F.col("licensed_to_serve_ages").alias("ages_served"),
        F.struct(
            F.col("hours_of_operation").alias("hours"), F.col("days_of_operation").alias("days")
        ).alias("schedule"),
        F.lit(SOURCE_RANK["TX"]).alias("_source"),
        "_ord",
    )


def standardize_wa(raw: DataFrame) -> DataFrame:
    """Register with a worded status and an address in parts."""
    street, city, state, code = (
        _filled(c) for c in ("physicalstreetaddress", "physicalcity", "physicalstate", "physicalzip")
    )
    first_age, last_age = _filled("startingage"), _filled("endingage")
    return raw.select(
        F.concat(F.lit("WA-"), F.coalesce("wacompassid", F.lit("UNKNOWN"))).alias("id"),
        F.lit("WA").alias("source_state"),
        tx.key_value_text(F.col("_raw")).alias("original_record"),
        tx.normalize_name(
            tx.first_filled(F.col("doingbusinessas"), F.col("providername"))
        ).alias("name"),
        reg.normalize_type(F.col("facilitytypegeneric")).alias("type"),
        reg.status_from_words(F.col("latestoperatingstatus")).alias("status"),
        reg.normalize_date(F.col("initiallicensedate")).alias("license_date"),
        F.struct(
            F.concat(street, F.lit(", "), city, F.lit(", "), state, F.lit(" "), code).alias("full"),
            street.alias("street"),
            city.alias("city"),
            state.alias("state"),
            code.alias("zip"),
            _coordinate(raw, F.col("physciallatitude")).alias("latitude"),
            _coordinate(raw, F.col("physicallongitude")).alias("longitude"),
        ).alias("address"),
        F.struct(
            reg.normalize_phone(F.col("primarycontactphonenumber")).alias("phone"),
            reg.normalize_email(F.col("primarycontactemail")).alias("email"),
            _null_text().alias("website"),
            F.col("primarycontactpersonname").alias("director_name"),
        ).alias("contact"),
        reg.parse_capacity(F.col("licensecapacity")).alias("capacity"),
        F.when(
            (first_age != "") | (last_age != ""), F.concat(first_age, F.lit(" - "), last_age)
        ).alias("ages_served"),
        F.struct(_null_text().alias("hours"), _null_text().alias("days")).alias("schedule"),
        F.lit(SOURCE_RANK["WA"]).alias("_source"),
        "_ord",
    )


STANDARDIZERS = {"TX": standardize_tx, "WA": standardize_wa}


def union_registers(registers: dict[str, DataFrame]) -> DataFrame:
    """All standardised rows of the given registers, as a bag."""
    parts = [STANDARDIZERS[code](raw) for code, raw in registers.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@dataclass(frozen=True)
class LocationFilter:
    """Optional location filters; ``state`` ``ALL`` means none."""

    city: str | None = None
    state: str | None = None
    zip: str | None = None

    def wants(self, code: str) -> bool:
        return not self.state or self.state.upper() in ("ALL", code)

    def reason(self, address: Column) -> Column:
        """First location test that fails, else null."""
        reason = F.when(F.lit(False), _null_text())
        if self.city:
            same = tx.fold_lower(address["city"]) == self.city.strip().lower()
            reason = reason.when(~F.coalesce(same, F.lit(False)), "filtered_city")
        if self.state and self.state.upper() != "ALL":
            same = tx.fold_upper(address["state"]) == self.state.strip().upper()
            reason = reason.when(~F.coalesce(same, F.lit(False)), "filtered_state")
        if self.zip:
            inside = address["zip"].startswith(self.zip.strip()) & ~tx.is_blank(address["zip"])
            reason = reason.when(~F.coalesce(inside, F.lit(False)), "filtered_zip")
        return reason.otherwise(_null_text())


def rule_reason(where: LocationFilter | None = None) -> Column:
    """First row-level test a unified row fails, else null (duplicates apart)."""
    contact, address = F.col("contact"), F.col("address")
    located = (where or LocationFilter()).reason(address)
    unreachable = (
        tx.is_blank(contact["phone"]) & tx.is_blank(contact["email"]) & tx.is_blank(contact["website"])
    )
    # a line that is no JSON object, or a coordinate that is no number
    broken = address["latitude"].isNull() | address["longitude"].isNull()
    return (
        F.when(broken, "processing_error")
        .when(F.col("type").isin(fixed.EXCLUDED_TYPES), "filtered_type")
        .when(tx.contains_any(F.lower("name"), fixed.EXCLUDED_NAME_WORDS), "filtered_keyword")
        .when(F.col("capacity") == 0, "filtered_capacity")
        .when(unreachable, "filtered_contact")
        .when(tx.is_blank(F.col("name")) | (F.col("name") == fixed.UNKNOWN_NAME), "missing_name")
        .when(tx.is_blank(address["full"]), "missing_address")
        .when(located.isNotNull(), located)
        .when(F.coalesce(F.col("status") != reg.ACTIVE, F.lit(True)), "inactive")
    )


def with_drop_reason(unified: DataFrame, where: LocationFilter | None = None) -> DataFrame:
    """Unified rows with their one `drop_reason`; kept rows have none.

    Only rows that pass every row-level test can claim a (name, address)
    fingerprint, the first of them in source and file order.
    """
    tested = unified.withColumn("_rule", rule_reason(where)).withColumn(
        "_pos", F.struct("_source", "_ord")
    )
    candidates = tested.where(F.col("_rule").isNull()).select(
        "_pos", "name", F.col("address.full").alias("full")
    )
    winners = mark_first(candidates, [F.col("name"), F.col("full")], "_pos", ["_pos"], "_first")
    claims = winners.where("_first").select("_pos", "_first")
    reason = F.coalesce(F.col("_rule"), F.when(F.col("_first").isNull(), F.lit("duplicate")))
    return (
        tested.join(claims, "_pos", "left")
        .withColumn("drop_reason", reason)
        .drop("_rule", "_first", "_pos")
    )


def split_drops(reasoned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept unified rows, and one ledger row per dropped row."""
    kept = reasoned.where(F.col("drop_reason").isNull()).drop("drop_reason")
    drops = reasoned.where(F.col("drop_reason").isNotNull()).select(
        "id", "source_state", F.lit("unify").alias("step"), F.col("drop_reason").alias("reason"), "_ord"
    )
    return kept, drops


def drop_counts(drops: DataFrame, with_zeros: bool = True) -> DataFrame:
    """Rows per reason, either for every known reason or for those that occur."""
    counted = drops.groupBy("reason").agg(F.count("*").alias("rows"))
    if not with_zeros:
        return counted.orderBy("reason")
    reasons = F.explode(F.array(*[F.lit(r) for r in fixed.DROP_REASONS]))
    known = drops.sparkSession.range(1).select(reasons.alias("reason"))
    return known.join(counted, "reason", "left").select(
        "reason", F.coalesce("rows", F.lit(0)).cast("long").alias("rows")
    )


def ingestion_rows(unified: DataFrame, batch_id: str, fetched_at: str) -> DataFrame:
    """Rows of the ingestion table: nested fields as JSON text, nulls kept."""
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"}).alias(c)
    return unified.select(
        F.col("id").alias("daycare_id"),
        "source_state", "original_record", "name", "type", "status", "license_date",
        text("address"), text("contact"), "capacity", "ages_served", text("schedule"),
        F.lit(batch_id).alias("ingestion_batch_id"),
        F.lit(fetched_at).alias("api_fetch_timestamp"),
    )
