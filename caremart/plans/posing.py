"""General purpose tables in the role of clinical and claim feeds.

Orders and their lines pose as medical claims, events as pharmacy claims,
conversations as clinical documents: deterministic column expressions over
whole tables, so every operator can be run and checked on any such data set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.functions.casts import conform
from caremart.operators.cda import MEDICATION_SECTION, PROBLEM_SECTION, RXNORM
from caremart.schemas import MEDICAL_CSV, PHARMACY_CSV
from caremart.sources.tables import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _mdy(day: Column) -> Column:
    return F.concat_ws("/", F.month(day), F.dayofmonth(day), F.year(day))


def _shuffles(lines: DataFrame) -> bool:
    """Whether a join is one that moves both of its sides, as Spark plans it."""
    return "SortMergeJoin" in lines._jdf.queryExecution().sparkPlan().toString()


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their orders, which pose as medical claim lines.

    For who reads them several times. Where orders are too many to be
    broadcast, the join is stored once: each of the readers would shuffle both
    tables by itself, next to what it shuffles afterwards.
    """
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return staged(lines, "order-lines") if _shuffles(lines) else lines


def medical_claims(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Raw medical claim lines, all text, with the flaws real files have; ``lines`` may be ``order_lines``."""
    if lines is None:
        orders = table(spark, sf_dir, "orders")
        lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ship, placed = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    number, finished = F.col("l_linenumber"), F.col("o_orderstatus") == "F"
    rows = lines.select(
        _text("l_partkey").alias("SequenceNumber"),
        _text("l_orderkey").alias("ClaimID"),
        _text("l_linenumber").alias("LineNum"),
        F.concat(F.lit("C"), F.col("o_orderstatus")).alias("ContractID"),
        _text("o_custkey").alias("MemberID"),
        _mdy(ship).alias("FromDate"),
        # Some dates exist in no calendar.
        F.when(number == 7, "13/40/2020").otherwise(_mdy(F.date_add(ship, number))).alias("ToDate"),
        F.when(finished, _mdy(placed)).alias("AdmitDate"),
        F.when(finished & (F.col("l_linestatus") == "O"), _mdy(F.date_add(placed, 5))).alias(
            "DischDate"
        ),
        F.when(number == 1, "2020-01-02").otherwise(_mdy(F.date_add(ship, 30))).alias("PaidDate"),
        F.lpad(_text("l_suppkey"), 4, "0").alias("RevCode"),
        F.concat(F.lit("H"), _text("l_partkey")).alias("HCPCS"),
        F.nullif("l_returnflag", F.lit("N")).alias("Modifier"),
        F.col("l_linestatus").alias("Modifier2"),
        _text("l_linenumber").alias("srcPOS"),
        _text("l_linenumber").alias("POS"),
        F.lit("x1").alias("srcSpecialty"),
        F.when(number != 5, _text("l_suppkey")).alias("ProviderID"),
        F.lit("").alias("BillType"),
        F.substring("o_orderpriority", 1, 1).alias("AdmitSource"),
        F.col("o_orderpriority").alias("AdmitType"),
        _text("l_extendedprice").alias("Billed"),
        _text("l_extendedprice").alias("Allowed"),
        F.when(number == 6, "abc").otherwise(_text("l_extendedprice")).alias("Paid"),
        _text("l_discount").alias("COB"),
        _text("l_tax").alias("Copay"),
        F.lit("0").alias("Coinsurance"),
        _text("l_quantity").alias("Deductible"),
        F.when(number != 3, _text("l_tax")).alias("PatientPay"),
        F.when(F.col("l_returnflag") == "R", _text("l_linenumber")).alias("Days"),
        F.lit("0.1").alias("Units"),
        F.lit("10").alias("ICDVersion"),
        F.when(finished, _text("l_linenumber")).alias("DischargeStatus"),
        F.when(finished, F.concat(F.lit("A"), F.col("l_returnflag"))).alias("AdmitDiag"),
        F.concat(F.lit("D"), F.col("l_returnflag"), F.col("l_linestatus")).alias("ICDDiag1"),
        F.when(number > 3, F.col("o_orderstatus")).alias("ICDDiag3"),
        F.when(number > 5, F.lit("Z99")).alias("ICDDiag30"),
        F.when(finished, F.concat(F.lit("P"), F.col("l_linestatus"))).alias("ICDProc1"),
        F.when(number == 2, F.col("l_returnflag")).alias("ICDProc2"),
        F.when(number > 4, F.lit("0XYZ")).alias("ICDProc10"),
        _text("l_tax").alias("UserDefNum3"),
        F.date_format(ship, "yyyyMM").alias("YearMo"),
        _text("l_quantity").alias("MR_Units_Days"),
        F.col("l_linestatus").alias("LOB"),
        F.year(ship).cast("string").alias("Year"),
    )
    return conform(rows, MEDICAL_CSV)


def pharmacy_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pharmacy claims, all text."""
    day = F.to_date("ts")
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        _text("event_id").alias("SequenceNumber"),
        _text("event_id").alias("ClaimID"),
        kind.alias("ContractID"),
        _text("user_id").alias("MemberID"),
        _mdy(day).alias("FromDate"),
        F.when(kind != "error", _mdy(F.date_add(day, 10))).alias("PaidDate"),
        F.concat(F.lit("N"), _text("user_id")).alias("NDC"),
        F.when(kind != "view", _text("user_id")).alias("ProviderID"),
        _text("value").alias("IngredientCost"),
        F.lit("1.5").alias("DispensingFee"),
        _text("value").alias("Billed"),
        _text("value").alias("Allowed"),
        _text("value").alias("Paid"),
        F.lit("0").alias("COB"),
        F.when(kind != "click", F.lit("2.25")).alias("Copay"),
        F.lit("0.5").alias("Coinsurance"),
        F.lit("n/a").alias("MR_Paid"),
        F.lit("0").alias("Deductible"),
        F.lit("3").alias("PatientPay"),
        F.lit("1.5").alias("Units"),
        F.dayofmonth(day).cast("string").alias("DaysSupply"),
        F.lit("30.5").alias("QuantityDispensed"),
        F.get_json_object("props", "$.k").alias("MR_Scripts_30Day"),
        F.date_format(day, "yyyyMM").alias("YearMo"),
        F.lit("7").alias("UserDefNum3"),
    )
    return conform(rows, PHARMACY_CSV)


#: What names the files that ``write_claim_files`` writes.
CLAIM_FILES = "*.csv.gz"
# A compressed file is read by one task.
_LINES_A_FILE = 250_000


def write_claim_files(rows: DataFrame, folder: str) -> None:
    """Raw claims as delimited files with a header, packed as feeds are sent: most cells of a line are empty."""
    packed = rows.write.option("maxRecordsPerFile", _LINES_A_FILE).option("zlib.compress.level", "BEST_SPEED")
    packed.csv(folder, header=True, compression="gzip")


def _escaped(value: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def _tag(name: str, body: Column | str, **attributes: Column | str) -> Column:
    parts = [F.lit(f"<{name}")]
    for key, value in attributes.items():
        parts += [F.lit(f' {key}="'), F.lit(value) if isinstance(value, str) else value, F.lit('"')]
    body = F.lit(body) if isinstance(body, str) else body
    return F.concat(*parts, F.lit(">"), body, F.lit(f"</{name}>"))


def documents(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Clinical documents, one per conversation turn, one entry per text line.

    A conversation is the patient. What users say becomes problems, what others
    say medications. No grouping: a document is built from its own row. Turns
    are ``spread`` over all cores first where the table lies in few pieces and
    a document costs much, as a file of its own does.
    """
    turns = table(spark, sf_dir, "conversations")
    if spread:
        turns = turns.repartition(spark.sparkContext.defaultParallelism, "conv_id", "turn")
    conv, turn = F.col("conv_id"), F.col("turn")
    lines = F.transform(
        F.split(F.col("text"), "\n"),
        lambda line, i: F.struct(_escaped(line).alias("line"), i.cast("string").alias("i")),
    )
    is_user = F.col("role") == "user"

    def author(i: Column) -> Column:
        person = _tag("assignedPerson", _tag("name", F.concat(
            _tag("given", "Dr"), _tag("family", F.concat(F.lit("Fam"), i)))))
        who = _tag("assignedAuthor", F.concat(
            _tag("id", "", root="2.16.840.1.113883.4.6", extension=F.concat(F.lit("npi"), i)),
            person))
        return _tag("author", F.concat(_tag("time", "", value="20210203"), who))

    def problem(e: Column) -> Column:
        value = _tag("value", "", code=F.concat(F.lit("c"), e["i"]), codeSystem="2.16.840.1",
                     codeSystemName="SYS", displayName=e["line"])
        period = _tag("effectiveTime", _tag("low", "", value="20190101"))
        observation = _tag("observation", F.concat(period, value, author(e["i"])))
        act = _tag("act", F.concat(
            _tag("code", "", code="CONC", displayName="Concern"),
            _tag("statusCode", "", code="active"),
            _tag("entryRelationship", observation)))
        return _tag("entry", act)

    def medication(e: Column) -> Column:
        material = _tag("manufacturedMaterial", F.concat(
            _tag("code", _tag("translation", "", codeSystem=RXNORM, code=F.concat(F.lit("rx"), e["i"]))),
            _tag("name", e["line"])))
        consumable = _tag("consumable", _tag("manufacturedProduct", material))
        body = F.concat(
            _tag("effectiveTime", F.concat(
                _tag("low", "", value="20200102"), _tag("high", "", value="20200103040506"))),
            _tag("routeCode", "", code="PO", displayName="Oral"),
            _tag("doseQuantity", "", value="1.5", unit="mg"),
            consumable,
            _tag("entryRelationship", _tag("supply", F.concat(
                _tag("repeatNumber", "", value="2"), _tag("quantity", "", value="30")))))
        return _tag("entry", _tag("substanceAdministration", body))

    def section(template: str, entries: Column) -> Column:
        return _tag("component", _tag("section", F.concat(
            _tag("templateId", "", root=template), entries)))

    header = F.concat(
        _tag("code", "", code="34133-9", displayName="Summary"),
        _tag("title", F.concat(F.lit("Turn "), turn.cast("string"))),
        _tag("effectiveTime", "", value=F.concat(
            F.lit("202001"), F.lpad((turn % 28 + 1).cast("string"), 2, "0"), F.lit("030405"))),
    )
    patient = _tag("patient", F.concat(
        _tag("name", F.concat(
            _tag("given", "Pat"), _tag("family", F.concat(F.lit("F"), conv.cast("string"))))),
        _tag("administrativeGenderCode", "", code="F", displayName=F.when(
            conv % 2 == 0, "Female").otherwise("Male")),
        # Every seventh turn contradicts the others.
        _tag("birthTime", "", value=F.when(turn % 7 == 6, "19610203").otherwise("19600102")),
        _tag("raceCode", "", displayName=F.concat(F.lit("Race"), (turn % 3).cast("string"))),
        _tag("languageCommunication", _tag("languageCode", "", code="en")),
    ))
    role = _tag("patientRole", F.concat(
        _tag("addr", F.concat(
            _tag("city", F.concat(F.lit("City"), (conv % 5).cast("string"))),
            _tag("postalCode", F.when(turn % 2 == 0, "01234").otherwise("12345-6789")))),
        _tag("telecom", "", use="HP", value=F.concat(F.lit("tel:"), conv.cast("string"))),
        patient,
        _tag("providerOrganization", F.concat(
            _tag("name", F.concat(F.lit("Org"), (conv % 4).cast("string"))),
            _tag("addr", _tag("postalCode", "02345")))),
    ))
    performer = _tag("documentationOf", _tag("serviceEvent", _tag("performer", _tag(
        "assignedEntity", _tag("assignedPerson", _tag("name", F.concat(
            _tag("given", "P"), _tag("family", F.concat(F.lit("Q"), (turn % 4).cast("string"))))))))))
    body = F.when(
        is_user, section(PROBLEM_SECTION, F.array_join(F.transform(lines, problem), ""))
    ).otherwise(section(MEDICATION_SECTION, F.array_join(F.transform(lines, medication), "")))
    xml = F.concat(
        F.lit('<ClinicalDocument xmlns="urn:hl7-org:v3">'),
        header,
        _tag("recordTarget", role),
        performer,
        _tag("component", _tag("structuredBody", body)),
        F.lit("</ClinicalDocument>"),
    )
    return turns.select(
        conv.cast("string").alias("patient_id"),
        F.concat_ws("-", conv.cast("string"), turn.cast("string")).alias("document_id"),
        xml.alias("xml_string"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change feed on users: errors delete, the rest upserts."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_type").alias("last_event"),
        F.col("value").alias("last_value"),
        F.struct("ts", "event_id").alias("at"),
        F.col("ts").alias("_commit_timestamp"),
        F.when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "signup", "insert")
        .otherwise("update_postimage")
        .alias("_change_type"),
    )


def write_document_files(docs: DataFrame, folder: str) -> None:
    """One file per document, ``<patient>_<document>_ccda.xml``, written by the tasks.

    A repeated task writes the same files again. Columns read: ``patient_id``,
    ``document_id``, ``xml_string``; rows without any of them are left out.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        uri = "file:///" + re.sub("^file:/*", "", folder) if folder.startswith("file:") else folder
        files, home = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
        files.create_dir(home, recursive=True)
        for batch in batches:
            names = []
            for patient, document, text in zip(*(column.to_pylist() for column in batch.columns)):
                names.append(f"{patient}_{document}_ccda.xml")
                with files.open_output_stream(f"{home}/{names[-1]}") as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file_name"])

    rows = docs.select("patient_id", "document_id", "xml_string").dropna()
    rows.mapInArrow(write, "file_name string").write.format("noop").mode("overwrite").save()
