"""Declared schemas of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, S)


# Register with Y/N status flags and one full address field.
RAW_TX = struct(
    **strings(
        "operation_id", "operation_name", "operation_type", "operation_status",
        "temporarily_closed", "issuance_date", "location_address", "address_line",
        "city", "state", "zipcode",
    ),
    location_address_geo=struct(**strings("latitude", "longitude")),
    **strings(
        "phone_number", "email_address", "website_address", "administrator_director_name",
        "total_capacity", "licensed_to_serve_ages", "hours_of_operation", "days_of_operation",
    ),
)

# Register with worded status and address parts; `physciallatitude` is how
# the register itself spells the field.
RAW_WA = struct(
    **strings(
        "wacompassid", "doingbusinessas", "providername", "facilitytypegeneric",
        "latestoperatingstatus", "initiallicensedate", "physicalstreetaddress",
        "physicalcity", "physicalstate", "physicalzip", "physciallatitude",
        "physicallongitude", "primarycontactphonenumber", "primarycontactemail",
        "primarycontactpersonname", "licensecapacity", "startingage", "endingage",
    )
)

ADDRESS = struct(**strings("full", "street", "city", "state", "zip"), latitude=D, longitude=D)
CONTACT = struct(**strings("phone", "email", "website", "director_name"))
SCHEDULE = struct(**strings("hours", "days"))

UNIFIED = struct(
    **strings("id", "source_state", "original_record", "name", "type", "status", "license_date"),
    address=ADDRESS,
    contact=CONTACT,
    capacity=L,
    ages_served=S,
    schedule=SCHEDULE,
)

REVIEW = struct(author_name=S, rating=I, text=S, time=L)
PLACE_REPLY = struct(
    **strings("place_id", "name", "business_status", "url", "formatted_address",
              "formatted_phone_number", "website"),
    rating=D,
    user_ratings_total=I,
    geometry=struct(location=struct(lat=D, lng=D)),
    photos=T.ArrayType(S),
    reviews=T.ArrayType(
        struct(author_name=S, rating=I, text=S, time=L, relative_time_description=S)
    ),
    opening_hours=S,
)
PLACE = struct(
    **strings("query_md5", "status", "reason", "searched_query"),
    metadata=struct(query_name=S, found_name=S),
    **strings("place_id", "name", "business_status", "google_maps_url", "address"),
    contact=struct(phone=S, website=S),
    rating=struct(stars=D, count=I),
    reviews=T.ArrayType(REVIEW),
    photos=T.ArrayType(S),
    operating_hours=S,
    street_view_metadata=struct(lat=D, lng=D),
    street_view_path=S,
)

OPERATIONAL_INFO = struct(
    years_in_operation=S, philosophy=S, languages=T.ArrayType(S), ages_served=S,
    pricing_mentions=S, waitlist_info=S, hours=S, meals=S, facilities=T.ArrayType(S),
)
VERIFIED_SOURCE = struct(url=S, title=S, source_name=S)
RESEARCH_REPLY = struct(
    safety_summary=S, reputation_summary=S, staff_summary=S, operational_info=OPERATIONAL_INFO
)
RESEARCH = struct(
    daycare_id=S,
    safety_summary=S, reputation_summary=S, staff_summary=S,
    operational_info=OPERATIONAL_INFO,
    verified_sources=T.ArrayType(VERIFIED_SOURCE),
    status=S, error=S, raw=S,
)

PART_SCORE = struct(score=I, improvement_tip=S)
SYNTHESIS_REPLY = struct(
    marketing_content=struct(headline=S, sub_headline=S, description=S),
    structured_data=struct(
        program_type=S, availability_status=S, min_age_months=I, max_age_months=I,
        meals_provided=B, snacks_provided=B, price_start=I, price_end=I,
        teacher_student_ratio=S, cameras=B, secure_entry=B, certifications=T.ArrayType(S),
    ),
    search_tags=T.ArrayType(S),
    insider_insight=struct(
        sentiment_summary=S, atmosphere=S, red_flags=T.ArrayType(S), parent_tips=T.ArrayType(S)
    ),
    media_selection=struct(best_thumbnail_path=S, selection_reason=S),
    ranking=struct(
        trust_score=I,
        trust_score_explanation=S,
        score_breakdown=struct(
            safety_and_transparency=PART_SCORE, facility_environment=PART_SCORE,
            teacher_quality=PART_SCORE, parent_reputation=PART_SCORE,
        ),
        ranking_tier=S,
    ),
)

MODEL_REPLY = struct(
    daycare_id=S, step=S, input_md5=S, reply=S, input_tokens=L, output_tokens=L, error=S,
    chunks=T.ArrayType(struct(uri=S, title=S)), called_at=T.TimestampType(),
)
SITE_MANIFEST = struct(
    domain=S, root_url=S, timestamp=D, pages_crawled=I, pages_successful=I, assets_found=I, website_active=B
)
REFINED_SITE = struct(
    domain=S, verified_images=T.ArrayType(S), pdf_assets=T.ArrayType(S), body=S,
    website_active=B, raw_stats=struct(original_images=L, original_text_files=L),
)
STARTER = struct(id=L, name=S, value=L)
