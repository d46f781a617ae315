"""FHIR documents and OMOP tables derived from the given relational tables.

See FIXTURES.md, part B. All frames are lazy and grow with the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.schemas import PERSON_ID_URL
from medloom.sources.readers import read_parquet_table

AS_OF = "2025-01-01"
INGESTED_AT = "2025-01-01T00:00:00Z"
ORGANIZATIONS = 5

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name, columns or None)


def spread(df: DataFrame) -> DataFrame:
    """Give a small table, stored as a few splits, to all cores; a large one is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _iso(ts: Column) -> Column:
    return F.date_format(ts, _ISO)


def _minutes_after(ts: str, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), F.col(ts))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _pick(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _organization() -> Column:
    return F.concat(F.lit("org-"), (F.col("c_nationkey") % ORGANIZATIONS).cast("string"))


def _coding(code: Column, display: Column | None = None, system: str | None = None) -> Column:
    parts = [code.alias("code")]
    if display is not None:
        parts.append(display.alias("display"))
    if system:
        parts.append(F.lit(system).alias("system"))
    return F.array(F.struct(*parts))


def _concept(*args, **kwargs) -> Column:
    return F.struct(_coding(*args, **kwargs).alias("coding"))


def _reference(prefix: str, id_: Column, display: Column | None = None) -> Column:
    parts = [F.concat(F.lit(prefix + "/"), id_).alias("reference")]
    if display is not None:
        parts.append(display.alias("display"))
    return F.struct(*parts)


def birth_date(key: str = "c_custkey") -> Column:
    return F.date_add(F.lit("1920-01-01").cast("date"), ((F.col(key) * 37) % 36500).cast("int"))


def patient_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, value`` with one Patient per customer."""
    customer = (
        spread(table(spark, sf_dir, "customer"))
        .join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        .join(
            table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
    )
    key, text = F.col("c_custkey"), _text("c_custkey")
    mrn = F.struct(
        F.lit("urn:mrn").alias("system"),
        F.concat(F.lit("MRN"), text).alias("value"),
        _concept(F.lit("MR")).alias("type"),
    )
    no_type = F.lit(None).cast("struct<coding:array<struct<code:string>>>").alias("type")
    ssn = F.struct(
        F.lit("http://hl7.org/fhir/sid/us-SSN").alias("system"),
        F.lpad(text, 9, "0").alias("value"),
        no_type,
    )
    other = F.struct(F.lit("urn:plan").alias("system"), F.col("c_mktsegment").alias("value"), no_type)
    name = F.array(
        F.struct(
            F.lit("official").alias("use"),
            F.col("c_name").alias("family"),
            F.array("c_mktsegment").alias("given"),
        )
    )
    address = F.array(
        F.struct(
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad(text, 5, "0").alias("postalCode"),
            F.lit("US").alias("country"),
        )
    )
    body = F.struct(
        F.lit("Patient").alias("resourceType"),
        text.alias("id"),
        F.when(key % 11 != 0, F.col("c_acctbal") >= 0).alias("active"),
        _pick(key % 4, "male", "female", "other", "unknown").alias("gender"),
        birth_date().cast("string").alias("birthDate"),
        F.when(key % 10 == 0, "2024-06-01T00:00:00Z").alias("deceasedDateTime"),
        F.array(mrn, ssn, other).alias("identifier"),
        F.when(key % 7 != 0, name).alias("name"),
        address.alias("address"),
        F.when(
            key % 3 == 0, F.array(F.struct(_concept(F.lit("en")).alias("language")))
        ).alias("communication"),
        F.when(key % 13 != 0, F.struct(F.lit("synthetic").alias("source"))).alias("meta"),
        _reference("Organization", _organization()).alias("managingOrganization"),
        F.array(F.struct(F.lit(PERSON_ID_URL).alias("url"), key.alias("valueInteger"))).alias(
            "extension"
        ),
    )
    return customer.select(text.alias("id"), F.to_json(body).alias("value"))


def encounter_status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "O", "in-progress")
        .when(F.col("o_orderstatus") == "F", "finished")
        .otherwise("planned")
    )


def encounter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, value`` with one Encounter per order."""
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders = spread(table(spark, sf_dir, "orders")).join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    key = F.col("o_orderkey")
    priority = F.col("o_orderpriority").substr(1, 1)
    class_ = F.struct(
        F.when(priority == "1", "EMER").when(priority == "2", "IMP").otherwise("AMB").alias("code"),
        F.when(priority == "1", "emergency")
        .when(priority == "2", "inpatient")
        .otherwise("ambulatory")
        .alias("display"),
    )
    start = _minutes_after("o_orderdate", key % 60)
    end = _minutes_after("o_orderdate", key % 60 + (key % 72) * 50)
    kind = (key % 3).cast("string")
    reason = (key % 4).cast("string")
    practitioner = (key % 50).cast("string")
    place = (key % 20).cast("string")
    body = F.struct(
        F.lit("Encounter").alias("resourceType"),
        _text("o_orderkey").alias("id"),
        encounter_status().alias("status"),
        class_.alias("class"),
        _reference(
            "Patient", _text("o_custkey"), F.concat(F.lit("Patient "), _text("o_custkey"))
        ).alias("subject"),
        F.struct(
            _iso(start).alias("start"),
            F.when(F.col("o_orderstatus") != "O", _iso(end)).alias("end"),
        ).alias("period"),
        F.array(
            _concept(
                F.concat(F.lit("T"), kind), F.concat(F.lit("Type "), kind), "http://snomed.info/sct"
            )
        ).alias("type"),
        _reference("Organization", _organization(), F.lit("Clinic")).alias("serviceProvider"),
        F.when(
            key % 6 != 0,
            F.array(_concept(F.concat(F.lit("R"), reason), F.concat(F.lit("Reason "), reason))),
        ).alias("reasonCode"),
        F.array(
            F.struct(
                _reference(
                    "Practitioner", practitioner, F.concat(F.lit("Dr "), practitioner)
                ).alias("individual")
            )
        ).alias("participant"),
        F.array(
            F.struct(
                _reference("Location", place, F.concat(F.lit("Ward "), place)).alias("location")
            )
        ).alias("location"),
    )
    return orders.select(_text("o_orderkey").alias("id"), F.to_json(body).alias("value"))


def observation_id() -> Column:
    """Unique over lineitem at every scale; no double is printed."""
    return F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    )


CATEGORIES = (
    "vital-signs",
    "laboratory",
    "imaging",
    "procedure",
    "survey",
    "exam",
    "therapy",
    "activity",
    "social-history",
)


def observation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, value`` with one Observation per line item."""
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    lines = spread(table(spark, sf_dir, "lineitem")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    code = F.col("l_partkey") % 3
    group = (F.col("l_partkey") + F.col("l_suppkey")) % 9
    value = F.col("l_linenumber") % 4
    # Most ranges have both bounds, some only one.
    bound = F.col("l_suppkey") % 10
    ranged, has_low, has_high = bound % 5 != 0, bound != 7, bound != 3
    period = F.col("l_partkey") % 10 == 0
    category = _pick(group, *CATEGORIES)
    # Picked, not made of each row's code: changing the case of so many texts takes long.
    shown_category = _pick(group, *[c.upper() for c in CATEGORIES])
    flag = F.when(F.col("l_returnflag") == "R", "H").when(F.col("l_returnflag") == "A", "L")
    quantity = F.struct(
        F.col("l_quantity").alias("value"),
        F.lit("mg/dL").alias("unit"),
        F.lit("http://unitsofmeasure.org").alias("system"),
        F.lit("mg/dL").alias("code"),
    )
    shown = F.concat(F.lit("Flag "), "l_returnflag")
    day = _iso(F.col("l_shipdate"))
    next_day = _iso(F.timestamp_add("DAY", F.lit(1), F.col("l_shipdate")))
    body = F.struct(
        F.lit("Observation").alias("resourceType"),
        observation_id().alias("id"),
        F.when(F.col("l_linestatus") == "F", "final").otherwise("preliminary").alias("status"),
        F.struct(F.array(F.struct(_organization().alias("code"))).alias("tag")).alias("meta"),
        F.array(_concept(category, shown_category, "urn:category")).alias("category"),
        _concept(
            _pick(code, "2339-0", "8867-4", "39156-5"),
            _pick(code, "Glucose", "Heart rate", "BMI"),
            "http://loinc.org",
        ).alias("code"),
        _reference("Patient", _text("o_custkey")).alias("subject"),
        _reference("Encounter", _text("l_orderkey")).alias("encounter"),
        F.when(~period, day).alias("effectiveDateTime"),
        F.when(period, F.struct(day.alias("start"), next_day.alias("end"))).alias(
            "effectivePeriod"
        ),
        next_day.alias("issued"),
        F.when(value == 0, quantity).alias("valueQuantity"),
        F.when(value == 1, F.col("l_returnflag")).alias("valueString"),
        F.when(value == 2, F.col("l_linestatus") == "F").alias("valueBoolean"),
        F.when(value == 3, _concept(F.col("l_returnflag"), shown)).alias("valueCodeableConcept"),
        F.when(
            ranged,
            F.array(
                F.struct(
                    F.when(
                        has_low, F.struct(F.lit(10.0).alias("value"), F.lit("mg/dL").alias("unit"))
                    ).alias("low"),
                    F.when(has_high, F.struct(F.lit(40.0).alias("value"))).alias("high"),
                )
            ),
        ).alias("referenceRange"),
        F.when(flag.isNotNull(), F.array(_concept(flag, F.concat(F.lit("Flag "), flag)))).alias(
            "interpretation"
        ),
        F.array(
            _reference(
                "Practitioner", _text("l_suppkey"), F.concat(F.lit("Dr "), _text("l_suppkey"))
            )
        ).alias("performer"),
    )
    return lines.select(observation_id().alias("id"), F.to_json(body).alias("value"))


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = birth_date()
    key = F.col("c_custkey")
    gender = key % 4
    return table(spark, sf_dir, "customer").select(
        key.alias("person_id"),
        F.when(gender == 0, 8507).when(gender == 1, 8532).otherwise(0).cast("bigint").alias(
            "gender_concept_id"
        ),
        F.year(born).cast("bigint").alias("year_of_birth"),
        F.month(born).cast("bigint").alias("month_of_birth"),
        F.dayofmonth(born).cast("bigint").alias("day_of_birth"),
        born.cast("string").alias("birth_datetime"),
        (F.lit(8515) + F.col("c_nationkey") % 3).cast("bigint").alias("race_concept_id"),
        F.lit(38003564).cast("bigint").alias("ethnicity_concept_id"),
        F.col("c_name").alias("person_source_value"),
        _pick(gender, "male", "female", "other", "unknown").alias("gender_source_value"),
        F.lit("none").alias("race_source_value"),
        F.lit("none").alias("ethnicity_source_value"),
        F.lit(INGESTED_AT).alias("ingestion_timestamp"),
    )


def condition_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    concept = (
        F.when(key % 4 == 0, 201826)
        .when(key % 4 == 1, 320128)
        .when(key % 4 == 2, 317009)
        .otherwise(201254)
    )
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        _text("o_orderkey").alias("condition_occurrence_id"),
        F.col("o_custkey").alias("person_id"),
        concept.cast("bigint").alias("condition_concept_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("condition_start_date"),
        _iso(F.col("o_orderdate")).alias("condition_start_datetime"),
        F.lit(32020).cast("bigint").alias("condition_type_concept_id"),
        F.when(key % 5 != 0, key).alias("visit_occurrence_id"),
    )


def measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    code = F.col("l_partkey") % 3
    concept = F.when(code == 0, 3004501).when(code == 1, 3012888).otherwise(3038553)
    return lines.select(
        observation_id().alias("measurement_id"),
        F.col("o_custkey").alias("person_id"),
        concept.cast("bigint").alias("measurement_concept_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("measurement_date"),
        _iso(F.col("l_shipdate")).alias("measurement_datetime"),
        F.lit(44818702).cast("bigint").alias("measurement_type_concept_id"),
        F.col("l_quantity").alias("value_as_number"),
        F.lit(8840).cast("bigint").alias("unit_concept_id"),
        F.col("l_orderkey").alias("visit_occurrence_id"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ingestion(table(spark, sf_dir, "events"))


def with_ingestion(events: DataFrame) -> DataFrame:
    """Events with an ingestion time and, read as job events, a job status."""
    status = (
        F.when(F.col("event_type").isin("view", "signup"), "accepted")
        .when(F.col("event_type") == "click", "processing")
        .when(F.col("event_type") == "purchase", "completed")
        .otherwise("failed")
    )
    return events.select(
        "event_id",
        "ts",
        "event_type",
        "value",
        F.timestamp_add("SECOND", (F.col("event_id") % 600).cast("int"), F.col("ts")).alias(
            "ingested_at"
        ),
        F.concat(F.lit("job-"), _text("user_id")).alias("job_id"),
        status.alias("status"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pipeline run per event; an ``error`` event is a failed run."""
    seconds = (F.col("event_id") % 1500).cast("int")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), _text("event_id")).alias("run_id"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("ended_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
    )


def bundle_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One webhook request per order; six in twenty break one rule each."""
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders = spread(table(spark, sf_dir, "orders")).join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    key = F.col("o_orderkey")
    order, cust = _text("o_orderkey"), _text("o_custkey")

    def entry(type_: str | None, id_: Column) -> Column:
        head = f'"resourceType":"{type_}",' if type_ else ""
        return F.concat(F.lit('{"resource":{' + head + '"id":"'), id_, F.lit('"}}'))

    entries = F.concat_ws(
        ",",
        entry("Patient", cust),
        entry("Encounter", order),
        F.when(key % 3 == 0, entry("Observation", F.concat(order, F.lit("-a")))),
        F.when(key % 3 == 0, entry("Observation", F.concat(order, F.lit("-b")))),
        F.when(key % 7 == 0, entry(None, order)),
    )
    kind = _pick(key % 5, "transaction", "batch", "collection", "message", "document")

    def bundle(resource: str, type_: Column, inner: Column) -> Column:
        return F.concat(
            F.lit('{"resourceType":"' + resource + '","type":"'),
            type_,
            F.lit('","entry":['),
            inner,
            F.lit("]}"),
        )

    fault = key % 20
    body = (
        F.when(fault == 1, "")
        .when(fault == 2, F.concat(F.lit("{broken "), order))
        .when(fault == 3, bundle("Patient", kind, entries))
        .when(fault == 4, bundle("Bundle", F.lit("searchset"), entries))
        .when(fault == 5, bundle("Bundle", kind, F.lit("")))
        .when(fault == 6, bundle("Bundle", kind, F.concat(entries, F.lit(',{"fullUrl":"x"}'))))
        .otherwise(bundle("Bundle", kind, entries))
    )
    return orders.select(
        F.concat(F.lit("req-"), order).alias("request_id"),
        _organization().alias("organization_id"),
        F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate")).alias(
            "requested_at"
        ),
        body.alias("body"),
    )


def upload_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload request per order, with odd names, types and lifetimes."""
    key, order = F.col("o_orderkey"), _text("o_orderkey")
    name = (
        F.when(key % 5 == 0, None)
        .when(key % 5 == 1, F.concat(F.lit("lab report #"), order, F.lit(".json")))
        .when(key % 5 == 2, F.concat(F.repeat(F.lit("a"), 98), F.lit("__"), order))
        .when(key % 5 == 3, F.lit("__ä__"))
        .otherwise(F.concat(F.lit("../etc/"), order, F.lit("_")))
    )
    kind = (
        F.when(key % 6 == 0, None)
        .when(key % 6 == 1, "application/fhir+json")
        .when(key % 6 == 2, "application/json")
        .when(key % 6 == 3, "application/fhir+ndjson")
        .when(key % 6 == 4, "application/x-ndjson")
        .otherwise("text/plain")
    )
    lifetime = F.when(key % 8 == 0, None).when(key % 8 == 1, 59).when(key % 8 == 2, 86401)
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(
        F.concat(F.lit("upload-"), order).alias("upload_id"),
        name.alias("filename"),
        kind.alias("content_type"),
        lifetime.otherwise((60 + key % 86000).cast("int")).alias("expires_in"),
        F.col("o_orderdate").alias("requested_at"),
    )


def upload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One uploaded object per order; some lack metadata, some the tenant altogether."""
    key, order = F.col("o_orderkey"), _text("o_orderkey")
    tenant = F.concat(F.lit("org-"), (key % 5).cast("string"))
    object_key = (
        F.when(key % 9 == 0, F.concat(F.lit("incoming/"), order, F.lit(".json")))
        .when(key % 2 == 0, F.concat(F.lit("incoming/fhir/"), tenant, F.lit("/2024/u"), order, F.lit(".json")))
        .otherwise(F.concat(F.lit("incoming/fhir/"), tenant, F.lit("/2024/u"), order, F.lit(".ndjson")))
    )
    return table(spark, sf_dir, "orders", "o_orderkey").select(
        object_key.alias("object_key"),
        F.when(key % 4 == 0, F.concat(F.lit("meta-"), tenant)).alias("meta_organization_id"),
        F.when(key % 3 == 0, F.concat(F.lit("upload-"), order)).alias("meta_upload_id"),
        key.alias("size"),
    )


# Keys are dealt to this many files until each holds LINES_PER_FILE lines, then to as many more.
FILES = 12
LINES_PER_FILE = 100_000


def ndjson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient documents as lines of uploaded files: ``file_no, c_custkey, value``.

    The key alone decides file and defects. Every file begins with two blank lines; in one of four
    files every other line is good.
    """
    docs = patient_documents(spark, sf_dir).withColumn("c_custkey", F.col("id").cast("bigint"))
    key, round_ = F.col("c_custkey"), FILES * LINES_PER_FILE
    file_no = key % FILES + FILES * F.floor(key / round_)
    clean = file_no % 4 == 3
    line = (
        F.when(~clean & (key % 23 == 1), "bad_json")
        .when(~clean & (key % 29 == 1), "[1]")
        .when(~clean & (key % 31 == 1), F.concat(F.lit('{"id":"'), F.col("id"), F.lit('"}')))
        .when((key % 37 == 1) | (key % round_ < 2 * FILES), "  ")
        .when(~clean & (key % 41 == 1), F.concat(F.col("value"), F.lit(" trailing")))
        .otherwise(F.col("value"))
    )
    return docs.select(file_no.alias("file_no"), "c_custkey", line.alias("value"))


def uploaded_lines(docs: DataFrame) -> DataFrame:
    """``value``: all documents as lines, with a broken or a blank line after some of them."""
    dice = F.pmod(F.xxhash64("id"), F.lit(97))
    more = F.when(dice == 0, '{"resourceType":').when(dice == 1, " ").when(dice == 2, "[]")
    lines = docs.select(F.explode(F.array("value", more)).alias("value"))
    return lines.where("value IS NOT NULL")
