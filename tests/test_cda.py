import xml.etree.ElementTree as ElementTree
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caremart.operators import cda
from caremart.operators.cda import MEDICATION_SECTION, PROBLEM_SECTION, RXNORM
from caremart.plans.lakehouse import silver_documents

HEADER = """
<code code="34133-9" displayName="Summary"/><title>T</title>
<effectiveTime value="20200102030405"/>
<recordTarget><patientRole>
 <addr><streetAddressLine>1 A St</streetAddressLine><city>X</city><state>MA</state>
  <postalCode>01234</postalCode><country>US</country></addr>
 <telecom use="HP" value="tel:1"/><telecom use="MC" value="tel:2"/>
 <patient><name><given>A</given><given qualifier="CL">Second</given><family>B</family></name>
  <administrativeGenderCode code="F" displayName="Female"/><birthTime value="19600102"/>
  <maritalStatusCode code="M" displayName="Married"/>
  <religiousAffiliationCode displayName="Rel"/><raceCode displayName="R"/>
  <sdtc:raceCode displayName="Other"/><ethnicGroupCode displayName="E"/>
  <languageCommunication><languageCode code="en"/></languageCommunication></patient>
 <providerOrganization><name>Org</name><telecom value="tel:3"/>
  <addr><city>Y</city><postalCode>02345</postalCode></addr></providerOrganization>
</patientRole></recordTarget>
<documentationOf><serviceEvent><performer><assignedEntity><assignedPerson>
 <name><given>P</given><family>Q</family></name></assignedPerson></assignedEntity></performer>
</serviceEvent></documentationOf>
"""

AUTHOR = """<author><time value="20210203"/><assignedAuthor>
<id root="1.2" extension="no"/><id root="2.16.840.1.113883.4.6" extension="npi1"/>
<assignedPerson><name><given>Doc</given><family>Tor</family></name></assignedPerson>
</assignedAuthor></author>"""


def document(*sections, header=HEADER):
    body = "".join(f"<component>{s}</component>" for s in sections)
    return (
        '<ClinicalDocument xmlns="urn:hl7-org:v3" xmlns:sdtc="urn:hl7-org:sdtc">'
        f"{header}<component><structuredBody>{body}</structuredBody></component>"
        "</ClinicalDocument>"
    )


def section(template, *entries, extra=""):
    inner = "".join(f"<entry>{e}</entry>" for e in entries)
    return (
        f'<section><templateId root="9.9"/><templateId root="{template}"/>{inner}{extra}</section>'
    )


def act(value='<value code="I10" codeSystem="S" codeSystemName="N" displayName="D"/>', author=""):
    return (
        '<act><code code="CONC" displayName="Concern"/><statusCode code="active"/>'
        "<entryRelationship><observation>"
        f'<effectiveTime><low value="20190101"/><high value="2019"/></effectiveTime>{value}{author}'
        "</observation></entryRelationship></act>"
    )


def administration(material, author=""):
    return (
        '<substanceAdministration><effectiveTime><low value="20200101"/></effectiveTime>'
        '<effectiveTime><period value="6"/></effectiveTime>'
        '<routeCode code="PO" displayName="Oral"/><doseQuantity value="1.5" unit="mg"/>'
        f"<consumable><manufacturedProduct><manufacturedMaterial>{material}"
        "</manufacturedMaterial></manufacturedProduct></consumable>"
        '<entryRelationship><supply><quantity value="thirty"/><repeatNumber value="2"/></supply>'
        f"</entryRelationship>{author}</substanceAdministration>"
    )


@pytest.fixture
def parse(spark):
    def run(*xml, **options):
        rows = [("p", str(i), x) for i, x in enumerate(xml)]
        docs = spark.createDataFrame(rows, "patient_id string, document_id string, xml_string string")
        found = cda.parse_documents(docs, **options).collect()
        return sorted(found, key=lambda r: int(r.document_id))

    return run


# Where a document reader finds the header fields: path, then attribute or text.
PATHS = {
    "document_title": ("title", None),
    "patient_fname": ("recordTarget/patientRole/patient/name/given", None),
    "patient_lname": ("recordTarget/patientRole/patient/name/family", None),
    "gender_code": ("recordTarget/patientRole/patient/administrativeGenderCode", "code"),
    "gender": ("recordTarget/patientRole/patient/administrativeGenderCode", "displayName"),
    "race": ("recordTarget/patientRole/patient/raceCode", "displayName"),
    "ethnicity": ("recordTarget/patientRole/patient/ethnicGroupCode", "displayName"),
    "birth_time": ("recordTarget/patientRole/patient/birthTime", "value"),
    "street_address": ("recordTarget/patientRole/addr/streetAddressLine", None),
    "city": ("recordTarget/patientRole/addr/city", None),
    "state": ("recordTarget/patientRole/addr/state", None),
    "country": ("recordTarget/patientRole/addr/country", None),
    "home_phone": ("recordTarget/patientRole/telecom[@use='HP']", "value"),
    "mobile_phone": ("recordTarget/patientRole/telecom[@use='MC']", "value"),
    "marital_code": ("recordTarget/patientRole/patient/maritalStatusCode", "code"),
    "marital_status": ("recordTarget/patientRole/patient/maritalStatusCode", "displayName"),
    "religion": ("recordTarget/patientRole/patient/religiousAffiliationCode", "displayName"),
    "provider_org": ("recordTarget/patientRole/providerOrganization/name", None),
    "provider_phone": ("recordTarget/patientRole/providerOrganization/telecom", "value"),
    "provider_address": (
        "recordTarget/patientRole/providerOrganization/addr/streetAddressLine", None),
    "provider_city": ("recordTarget/patientRole/providerOrganization/addr/city", None),
}


def reader_view(xml):
    root = ElementTree.fromstring(xml)
    view = {}
    for field, (path, attribute) in PATHS.items():
        steps = "/".join(f"{{urn:hl7-org:v3}}{step}" for step in path.split("/"))
        node = root.find(steps)
        if node is None:
            view[field] = None
        else:
            view[field] = node.get(attribute) if attribute else node.text
    return view


HEADERS = {
    "full": HEADER,
    "empty": "",
    "two addresses": HEADER.replace("<addr><street", "<addr><state>ZZ</state></addr><addr><street"),
    "empty title": HEADER.replace("<title>T</title>", "<title/>"),
    "blanks": HEADER.replace("<title>T</title>", "<title> T &amp; U </title>"),
    "no name": HEADER.replace("<given>A</given>", ""),
}


@pytest.mark.parametrize("header", HEADERS.values(), ids=HEADERS.keys())
def test_header_matches_a_document_reader(parse, header):
    xml = document(header=header)
    (row,) = parse(xml)
    got = row.asDict()
    assert {f: got[f] for f in PATHS} == reader_view(xml)


def test_header_typed_fields(parse, both_modes):
    (row,) = parse(document())
    assert row.document_type == "Summary"
    assert row.effective_time == datetime(2020, 1, 2, 3, 4, 5)
    assert row.birth_date == datetime(1960, 1, 2)
    assert (row.zip_code, row.provider_zip_code, row.language) == (1234, 2345, "en")
    assert (row.provider_fname, row.provider_lname) == ("P", "Q")
    assert (row.problems, row.medications) == ([], [])


def test_bad_leaf_does_not_harm_the_rest(parse, both_modes):
    (row,) = parse(document(header=HEADER.replace("01234", "12345-6789")))
    assert row.zip_code is None
    assert (row.country, row.provider_zip_code, row.provider_lname) == ("US", 2345, "Q")


def test_problem(parse, both_modes):
    (row,) = parse(document(section(PROBLEM_SECTION, act(author=AUTHOR))))
    (problem,) = row.problems
    assert problem.asDict() == {
        "concern_type_code": "CONC", "concern_type_name": "Concern", "problem_status": "active",
        "condition_concept_id": "S", "condition_concept_value": "N",
        "condition_start_date": datetime(2019, 1, 1), "condition_end_date": None,
        "condition_type_concept_id": "CCDA_XML_DOCS", "condition_source_value": "I10",
        "condition_source_concept_id": "D", "provider_id": "npi1", "provider_fname": "Doc",
        "provider_lname": "Tor", "provider_entry_date": datetime(2021, 2, 3),
    }
    assert row.medications == []


def test_no_information_is_skipped(parse):
    skipped = act('<value nullFlavor="NI"/>')
    kept = act('<value nullFlavor="UNK"/>')
    (row,) = parse(document(section(PROBLEM_SECTION, skipped, kept, act())))
    assert [p.condition_source_value for p in row.problems] == [None, "I10"]


def test_problem_translation_is_all_or_nothing(parse):
    partial = (
        '<value code="I10" codeSystem="S" codeSystemName="N">'
        '<translation code="T1" codeSystem="TS"/><translation code="T2"/></value>'
    )
    without = '<value code="I10" codeSystem="S" codeSystemName="N"/>'
    (row,) = parse(document(section(PROBLEM_SECTION, act(partial), act(without))))
    names = ["condition_source_value", "condition_concept_id", "condition_concept_value",
             "condition_source_concept_id"]
    assert [tuple(p[n] for n in names) for p in row.problems] == [
        ("T1", "TS", None, None), ("I10", "S", "N", None)]


def test_act_without_observation(parse):
    (row,) = parse(document(section(PROBLEM_SECTION, "<act><code code='x'/></act>")))
    (problem,) = row.problems
    assert problem.concern_type_code == "x" and problem.condition_source_value is None


def test_medication_fallbacks(parse, both_modes):
    own = '<code code="c" codeSystem="s" codeSystemName="n" displayName="d"/>'
    rxnorm = (
        '<code displayName="own"><translation codeSystem="x" code="x1" codeSystemName="xn"/>'
        f'<translation codeSystem="{RXNORM}" code="r1" displayName="rd"/></code>'
    )
    other = '<code><translation codeSystem="x" code="x1"/></code><name>Named</name>'
    named = "<name>Only a name</name>"
    (row,) = parse(document(section(
        MEDICATION_SECTION, *[administration(m) for m in (own, rxnorm, other, named, "")])))
    names = ["drug_concept_id", "drug_concept_value", "drug_source_value", "drug_source_concept_id"]
    assert [tuple(m[n] for n in names) for m in row.medications] == [
        ("s", "n", "d", "c"),
        (RXNORM, "xn", "own", "r1"),
        ("x", None, "Named", "x1"),
        (None, None, "Only a name", None),
    ]
    first = row.medications[0]
    assert (first.dose_unit_source_value, first.dose_unit_concept_id) == (1.5, "mg")
    assert (first.drug_supply_quantity, first.drug_supply_refill) == (None, 2.0)
    assert first.drug_exposure_start_date == datetime(2020, 1, 1)


def test_sections_in_sections(parse):
    coded = '<value code="{}" codeSystem="S" codeSystemName="N" displayName="D"/>'
    inner = section(PROBLEM_SECTION, act(coded.format("inner")))
    outer = section(
        PROBLEM_SECTION, act(coded.format("outer")), extra=f"<component>{inner}</component>")
    last = section(PROBLEM_SECTION, act(coded.format("last")))
    other = section("1.1", act(coded.format("ignored")), extra=f"<component>{inner}</component>")
    (row,) = parse(document(outer, last, other))
    codes = [p.condition_source_value for p in row.problems]
    assert codes == ["outer", "inner", "last", "inner"]


@pytest.mark.parametrize("depth", [1, 4, 5, 7])
def test_sections_of_any_depth(parse, depth):
    nested = section(PROBLEM_SECTION, act())
    for _ in range(depth - 1):
        nested = section("1.1", extra=f"<component>{nested}</component>")
    (row,) = parse(document(nested))
    assert [p.condition_source_value for p in row.problems] == ["I10"]


def test_any_child_makes_a_material(parse):
    meds = [administration(x) for x in ("<vendorNote/>", "text only", "", "<name>n</name>")]
    (row,) = parse(document(section(MEDICATION_SECTION, *meds)))
    assert [m.drug_source_value for m in row.medications] == [None, "n"]


@pytest.mark.parametrize("prefix", ["h", "h-7", "h.7", "_x"])
def test_all_prefixes(parse, prefix):
    whole = document(section(PROBLEM_SECTION, act()))
    prefixed = (
        whole.replace("<", f"<{prefix}:").replace(f"<{prefix}:/", f"</{prefix}:")
        .replace(f"<{prefix}:sdtc:", "<sdtc:").replace('xmlns="', f'xmlns:{prefix}="')
    )
    plain, same = parse(whole, prefixed)
    assert plain.asDict() | {"document_id": "1"} == same.asDict()


def test_prefixed_and_malformed(parse):
    whole = document(section(PROBLEM_SECTION, act()))
    prefixed = (
        whole.replace("<", "<h:").replace("<h:/", "</h:").replace("<h:sdtc:", "<sdtc:")
        .replace('xmlns="', 'xmlns:h="')
    )
    plain, same, broken = parse(whole, prefixed, whole[:-9])
    assert plain.asDict() | {"document_id": "1"} == same.asDict()
    assert plain.malformed is None and broken.malformed == whole[:-9]
    assert broken.problems == [] and broken.document_title is None


def test_last_entry_as_provider(parse):
    meds = section(MEDICATION_SECTION, administration("<name>n</name>", AUTHOR))
    problems = section(PROBLEM_SECTION, act(author=AUTHOR.replace("Doc", "First")), act())
    with_author, without, none = parse(
        document(problems, meds), document(meds, problems), document(), provider="last_entry")
    assert (with_author.provider_fname, with_author.provider_lname) == ("Doc", "Tor")
    assert (without.provider_fname, without.provider_lname) == (None, None)
    assert (none.provider_fname, none.provider_lname) == ("P", "Q")


def test_tables_and_incremental_runs(spark):
    xml = document(
        section(PROBLEM_SECTION, act(), act()),
        section(MEDICATION_SECTION, administration("<name>n</name>")),
    )
    layout = "patient_id string, document_id string, xml_string string"
    docs = spark.createDataFrame(
        [("p", "d1", xml), ("p", "d2", document()), ("q", "d3", "<broken")], layout)
    tables, bad = silver_documents(docs)
    patients = {r.document_id: r for r in tables["ccda_docs_patient"].collect()}
    assert set(patients) == {"d1", "d2"}
    assert (patients["d1"].problem_count, patients["d1"].medication_count) == (2, 1)
    assert (patients["d2"].problem_count, patients["d2"].medication_count) == (0, 0)
    # Equal problems of one document are one row.
    assert tables["ccda_docs_problem"].count() == 1
    assert tables["ccda_docs_medication"].count() == 1
    assert [r.document_id for r in bad.collect()] == ["d3"]
    again, _ = silver_documents(docs, tables["ccda_docs_patient"].select("document_id"))
    assert again["ccda_docs_patient"].count() == 0


def test_one_parse_and_no_python(spark):
    docs = spark.createDataFrame(
        [("p", "d", "<x/>")], "patient_id string, document_id string, xml_string string")
    parsed = cda.parse_documents(docs)
    for df in (cda.doc_patients(parsed), cda.doc_problems(parsed), cda.doc_medications(parsed)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # One call per namespace variant, of which one runs per document.
        assert plan.count("from_xml(") == 2
        assert "Python" not in plan


def _texts(spark, *xmls):
    return spark.createDataFrame([("p", str(k), x) for k, x in enumerate(xmls)], "patient_id string, document_id string, xml_string string")


def test_any_depth_of_sections(spark):
    def deep(n):
        inner = section(PROBLEM_SECTION, act())
        for k in range(n):
            inner = f'<section n="{k}>{k}"><text>t{k}</text><component>{inner}</component><section/><title>after</title></section>'
        return document(inner)

    depths = [0, 1, 2, 7, 40, 200]
    found = {r.document_id: r for r in cda.doc_patients(cda.parse_documents(_texts(spark, *map(deep, depths)))).collect()}
    assert [found[str(k)].problem_count for k in range(len(depths))] == [1] * len(depths)


def test_order_of_lifted_sections(spark):
    xml = ("<a><section i='1'>x<section i='2'>y<section i='3'>z</section>y2</section><section i='4'>w</section>x2</section>m"
           "<section i='5'>v</section>end</a>")
    flat = _texts(spark, xml).select(cda.flat_sections(F.col("xml_string"))).first()[0]
    assert flat == ("<a><section i='1'>xx2</section><section i='2'>yy2</section><section i='3'>z</section><section i='4'>w</section>m"
                    "<section i='5'>v</section>end</a>")


def test_the_plan_does_not_depend_on_the_documents(spark):
    def size(*xmls):
        before = spark.sparkContext.statusTracker().getJobIdsForGroup()
        plan = cda.parse_documents(_texts(spark, *xmls))._jdf.queryExecution().optimizedPlan().toString()
        assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
        return len(plan)

    assert size(document(section(PROBLEM_SECTION, act()))) == size("<section>" * 500)


def test_unclosed_sections_harm_no_other_document(spark):
    good = document(section(PROBLEM_SECTION, act()))
    bad = good.replace("<structuredBody>", "<structuredBody>" + "<section>" * 1000)
    parsed = cda.parse_documents(_texts(spark, good, bad, good.replace("</section>", "</section></section>", 1)))
    rows = {r.document_id: r for r in parsed.select("document_id", "malformed", F.size("problems").alias("n")).collect()}
    assert rows["0"].malformed is None and rows["0"].n == 1
    assert rows["1"].malformed == bad and rows["2"].malformed is not None


def test_code_time_and_title_stand_first_anywhere(spark):
    header = HEADER.replace('<code code="34133-9" displayName="Summary"/><title>T</title>', "").replace(
        '<effectiveTime value="20200102030405"/>', "")
    inner = ('<section><!-- <title>in a comment</title> --><title a="1>2">A &amp; <![CDATA[<b>]]></title>'
             "<code displayName='S &lt; T' code='34133-9'/><effectiveTime value=\"20210304\"/></section>")
    later = '<section><title>later</title><code code="34133-9" displayName="later"/><effectiveTime value="20190101"/></section>'
    empty = "<section><title/><effectiveTime/></section>"
    rows = cda.doc_patients(cda.parse_documents(_texts(
        spark, document(inner, later, header=header), document(empty, later, header=header), document(header=header)))).collect()
    first, second, third = sorted(rows, key=lambda r: r.document_id)
    assert (first.document_title, first.document_type, str(first.effective_time)[:10]) == ("A & <b>", "S < T", "2021-03-04")
    assert (second.document_title, second.effective_time, second.document_type) == (None, None, "later")
    assert (third.document_title, third.document_type, third.effective_time) == (None, None, None)


def test_sections_that_do_not_all_close_are_not_taken_apart(spark):
    texts = ["<section>" * 1000, "<a><section><section></section></a>", "<section><section></section></section>",
             "<section></section><section></section>", "<section><x:section a='>'></x:section></section>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, xml string")
    found = rows.select("i", cda.nested_sections(F.col("xml")).alias("nested")).orderBy("i").collect()
    assert [r["nested"] for r in found] == [False, False, True, False, True]
