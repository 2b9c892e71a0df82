import pytest
from pyspark.sql import functions as F

from caremart import schemas
from caremart.operators import claims
from caremart.plans import lakehouse
from caremart.session import fresh_folder, shared_folder
from caremart.sources import delimited, tables
from caremart.sources.documents import read_documents
from caremart.sources.manifest import read_manifest, url_manifest
from caremart.streaming import ingest

LAYOUT = schemas.ddl("a string, b string, c string")

FILES = {
    "plain.csv": "a,b,c\n1,2,3\n4,,6\n",
    "reordered, extra [1].csv": 'c,"extra, col",a,b\n3,x,1,2\n6,,4,5\n',
    "missing.csv": "b,a\n2,1\n",
    "case.csv": "A,b,c\nupper,2,3\n",
    "bom.csv": "﻿a,b,c\n7,8,9\n",
    "short.csv": "a,b,c\n1,2\n1,2,3,4\n",
    "twice.csv": "a,a,b\n1,second,2\n",
    "empty.csv": "",
    "header only.csv": "a,b,c\n",
    "other.txt": "a,b,c\nno,no,no\n",
}


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, content in FILES.items():
        (source / name).write_text(content, encoding="utf-8")
    return source


def as_set(df):
    return {tuple(r) for r in df.select("a", "b", "c", "_rescued_data").collect()}


WANT = {
    ("1", "2", "3", None), ("4", None, "6", None),
    ("1", "2", "3", '{"extra, col":"x"}'), ("4", "5", "6", None),
    ("1", "2", None, None), (None, "2", "3", '{"A":"upper"}'), ("7", "8", "9", None),
    ("1", "2", None, '{"_corrupt_record":"1,2"}'), ("1", "2", "3", '{"_corrupt_record":"1,2,3,4"}'),
    ("1", "2", None, '{"a":"second"}'),
}


@pytest.mark.parametrize("scan", [False, True], ids=["peek", "scan"])
def test_rescued_csv(spark, folder, scan):
    files = delimited.list_files(spark, str(folder))
    df = delimited.read_csv_rescued(spark, files, LAYOUT, scan_headers=scan)
    assert as_set(df) == WANT
    clean, audit = delimited.split_rescued(df)
    assert clean.count() + audit.count() == df.count() and audit.count() == 5


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b,c\n"two\nlines","say ""hi""",3\n')
    files = delimited.list_files(spark, str(tmp_path))
    df = delimited.read_csv_rescued(spark, files, LAYOUT, multi_line=True)
    assert as_set(df) == {("two\nlines", 'say "hi"', "3", None)}


def test_no_files(spark, tmp_path):
    files = delimited.list_files(spark, str(tmp_path)).filter(F.lit(False))
    assert delimited.read_csv_rescued(spark, files, LAYOUT).count() == 0


def run(spark, source, work, **options):
    assert ingest.ingest_csv(
        spark, str(source), f"{work}/bronze", f"{work}/checkpoint", LAYOUT, timeout=120, **options)


def test_stream_takes_each_file_once(spark, folder, tmp_path):
    work = tmp_path / "out"
    run(spark, folder, work)
    run(spark, folder, work)
    landed = ingest.read_landed(spark, f"{work}/bronze")
    assert as_set(landed) == WANT and landed.count() == len(WANT)
    assert landed.filter("created_at is null").count() == 0
    (folder / "late.csv").write_text("c,b,a\nz,y,x\n")
    run(spark, folder, work)
    landed = ingest.read_landed(spark, f"{work}/bronze")
    assert as_set(landed) == WANT | {("x", "y", "z", None)} and landed.count() == len(WANT) + 1


def test_small_batches_give_the_same_rows(spark, folder, tmp_path):
    run(spark, folder, tmp_path / "many", max_files=2)
    landed = spark.read.parquet(f"{tmp_path}/many/bronze")
    assert landed.select("batch_id").distinct().count() > 1
    assert as_set(landed) == WANT and landed.count() == len(WANT)


def test_reset_lands_again_and_silver_does_not_notice(spark, tmp_path):
    source, work = tmp_path / "claims", tmp_path / "work"
    source.mkdir()
    (source / "m.csv").write_text("ClaimID,LineNum,Billed\nc,1,2.5\nc,2,x\n")

    def land():
        ingest.ingest_csv(spark, str(source), f"{work}/bronze", f"{work}/checkpoint",
                          schemas.MEDICAL_CSV, timeout=120)
        bronze = ingest.read_landed(
            spark, f"{work}/bronze", schemas.LAYERS["bronze"]["medical_claims"])
        silver = claims.claim_lines(claims.typed_lines(bronze))
        return bronze.count(), sorted(map(repr, silver.collect()))

    first = land()
    ingest.reset_ingest(spark, f"{work}/checkpoint")
    second = land()
    assert (first[0], second[0]) == (2, 4)
    assert first[1] == second[1] and len(first[1]) == 2


def test_schema_grows(spark, tmp_path):
    source, work = tmp_path / "in", tmp_path / "work"
    source.mkdir()
    place = f"{work}/schema"
    assert delimited.load_schema(spark, place) is None
    (source / "1.csv").write_text("a,b,c\n1,2,3\n")
    run(spark, source, work, schema_location=place)
    (source / "2.csv").write_text("a,new\n4,n\n")
    run(spark, source, work, schema_location=place)
    assert delimited.load_schema(spark, place).fieldNames() == ["a", "b", "c", "new"]
    landed = ingest.read_landed(spark, f"{work}/bronze")
    assert sorted((r.a, r.c, r.new, r._rescued_data) for r in landed.collect()) == [
        ("1", "3", None, None), ("4", None, "n", None)]


def test_documents_batch_and_stream(spark, tmp_path):
    source, work = tmp_path / "docs", tmp_path / "work"
    source.mkdir()
    (source / "p1_d1_x.xml").write_text("<a>é</a>", encoding="utf-8")
    (source / "p2.xml").write_text("<b/>")
    (source / "p4_d[4].xml").write_text("<c/>")
    (source / "p3_d3.txt").write_text("no")
    batch = read_documents(spark, str(source))
    assert batch.columns == schemas.BRONZE_DOCUMENTS.fieldNames()
    for _ in range(2):
        assert ingest.ingest_documents(
            spark, str(source), f"{work}/bronze", f"{work}/checkpoint", timeout=120)
    landed = ingest.read_landed(spark, f"{work}/bronze", schemas.BRONZE_DOCUMENTS)
    want = [("p1", "d1", 9, "p1_d1_x.xml", "<a>é</a>"), ("p2.xml", None, 4, "p2.xml", "<b/>"),
            ("p4", "d%5B4%5D.xml", 4, "p4_d%5B4%5D.xml", "<c/>")]
    names = ["patient_id", "document_id", "file_size_bytes", "file_name", "xml_string"]
    for df in (batch, landed):
        assert sorted(tuple(r) for r in df.select(*names).collect()) == want


def test_manifest(spark, tmp_path, both_modes):
    (tmp_path / "m.csv").write_text(
        "pre_signed_urls\nhttps://h.example/a/b/p1/p1_d1.xml?sig=/x/y\nhttps://h.example/a\nnot a url\n")
    rows = url_manifest(read_manifest(spark, str(tmp_path / "m.csv"))).collect()
    assert [(r.patient_id, r.file_name) for r in rows] == [
        ("p1", "p1_d1.xml"), (None, None), (None, None)]


def test_shared_folder_is_the_session_s(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_tables(spark):
    names = tables.ensure_tables(spark, "gold", "gold_t")
    tables.ensure_tables(spark, "gold", "gold_t")
    assert len(names) == 7 and spark.table("gold_t.cost").schema == schemas.COST
    person = spark.createDataFrame([("p",), ("q",)], "person_id string")
    rows = lakehouse.conform(person, schemas.PERSON)
    tables.overwrite_table(rows, "gold_t.person", ["person_id"])
    held = spark.table("gold_t.person")
    # From itself, and readers of the old version keep it.
    tables.overwrite_table(held.filter("person_id = 'p'"), "gold_t.person")
    assert [r.person_id for r in spark.table("gold_t.person").collect()] == ["p"]
    assert held.count() == 2
    tables.append_table(rows.select(*reversed(rows.columns)), "gold_t.person")
    assert sorted(r.person_id for r in spark.table("gold_t.person").collect()) == ["p", "p", "q"]
    tables.overwrite_table(person, "gold_t.person")
    assert spark.table("gold_t.person").columns == ["person_id"]
    tables.drop_table(spark, "gold_t.person")
    assert not spark.catalog.tableExists("gold_t.person")


def test_clustered_rows_stay_whole(spark):
    # One key holds a third of all rows.
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as person_id")
    out = tables.clustered(df, ["person_id"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_document_refresh_adds_and_repeats(spark):
    from tests.test_cda import PROBLEM_SECTION, act, document, section

    layout = "patient_id string, document_id string, xml_string string"
    first = spark.createDataFrame([("p", "d1", document(section(PROBLEM_SECTION, act())))], layout)
    second = first.unionByName(
        spark.createDataFrame([("p", "d2", document(section(PROBLEM_SECTION, act())))], layout))
    spark.sql("CREATE DATABASE silver_t")
    for docs in (first, second, second):
        lakehouse.refresh_silver_documents(spark, docs, "silver_t")
    for table in ("ccda_docs_patient", "ccda_docs_problem"):
        got = sorted(r.document_id for r in spark.table(f"silver_t.{table}").collect())
        assert got == ["d1", "d2"]


def test_what_is_set_aside_is_stored_once(spark):
    from tests.test_cda import PROBLEM_SECTION, act, document, section

    layout = "patient_id string, document_id string, xml_string string"
    good = document(section(PROBLEM_SECTION, act()))
    docs = spark.createDataFrame(
        [("p", "d1", good), ("p", "d2", "<cut"), ("p", "d3", "<foo/>"), ("p", "d4", None),
         ("p", "d5", " "), ("p", None, good)], layout)
    spark.sql("CREATE DATABASE silver_q")
    for _ in range(3):
        lakehouse.refresh_silver_documents(spark, docs, "silver_q")
    aside = spark.table("silver_q.quarantine_documents").collect()
    assert sorted((r.document_id or "", r.reason) for r in aside) == [
        ("", "no document id"), ("d2", "malformed"), ("d3", "not a clinical document"),
        ("d4", "empty"), ("d5", "empty")]
    assert [r.document_id for r in spark.table("silver_q.ccda_docs_patient").collect()] == ["d1"]
