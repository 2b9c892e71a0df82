"""Clinical documents: XML text to patient, problem and medication rows.

One ``from_xml`` per document with a schema in which every element is an
array; a field is then "the first node at a path", as a document reader would
ask for it. Leaves are text and are typed afterwards with tolerant casts: a
typed leaf with bad text would take the rest of its document down with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremart.functions.dates import cda_timestamp
from caremart.functions.ids import hash_id
from caremart.functions.numbers import text_to_fraction, text_to_int
from caremart.schemas import (
    DOCUMENT_FIELDS,
    MEDICATION_FIELDS,
    PROBLEM_FIELDS,
)

# Identifiers of the clinical document standard.
SUMMARY_DOCUMENT_CODE = "34133-9"
PROBLEM_SECTION = "2.16.840.1.113883.10.20.22.2.5.1"
MEDICATION_SECTION = "2.16.840.1.113883.10.20.22.2.1.1"
NATIONAL_PROVIDER_ID = "2.16.840.1.113883.4.6"
RXNORM = "2.16.840.1.113883.6.88"
NO_INFORMATION = "NI"
PROBLEM_TYPE_CONCEPT = "CCDA_XML_DOCS"

# Why a document is set aside, and the columns that are kept of it.
MALFORMED, NOT_CLINICAL = "malformed", "not a clinical document"
NO_TEXT, NO_ID = "empty", "no document id"
QUARANTINE = ["patient_id", "document_id", "reason", "malformed"]

_TEXT = T.ArrayType(T.StringType())
_WILDCARD = "any_other"
# Holds copies of what counts wherever in a document it stands first.
_FOUND = "firstFound"

# Pieces of patterns for tags: a prefix, and attributes whose values may hold a ">".
_PREFIX = r"(?:[^\s<>/!?:]+:)?"
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"<]*"|'[^'<]*')*+"""


def _element(*attributes: str, **children: T.DataType) -> T.ArrayType:
    """Schema of a repeatable element with attributes and child elements."""
    fields = [T.StructField(f"_{a}", T.StringType()) for a in attributes]
    fields += [T.StructField(name, kind) for name, kind in children.items()]
    return T.ArrayType(T.StructType(fields))


def _document_schema() -> T.StructType:
    value = _element("value")
    person_name = _element(given=_TEXT, family=_TEXT)
    address = _element(
        streetAddressLine=_TEXT, city=_TEXT, state=_TEXT, postalCode=_TEXT, country=_TEXT
    )
    period = _element("value", low=value, high=value)
    author = _element(
        time=value,
        assignedAuthor=_element(
            id=_element("root", "extension"),
            assignedPerson=_element(name=person_name),
        ),
    )
    coded = ("code", "codeSystem", "codeSystemName", "displayName")
    translation = _element(*coded)
    observation = _element(
        effectiveTime=period,
        value=_element(*coded, "nullFlavor", translation=translation),
        author=author,
    )
    act = _element(
        code=_element("code", "displayName"),
        statusCode=_element("code"),
        entryRelationship=_element(observation=observation),
    )
    # The wildcard takes every other child, since "has a child" is a test below.
    material = _element(
        code=_element(*coded, translation=translation),
        name=_TEXT,
        **{_WILDCARD: _TEXT},
    )
    administration = _element(
        effectiveTime=period,
        routeCode=_element("code", "displayName"),
        doseQuantity=_element("value", "unit"),
        consumable=_element(manufacturedProduct=_element(manufacturedMaterial=material)),
        author=author,
        entryRelationship=_element(supply=_element(quantity=value, repeatNumber=value)),
    )
    content = {
        "templateId": _element("root"),
        "entry": _element(act=act, substanceAdministration=administration),
    }
    section = _element(**content)

    patient = _element(
        name=person_name,
        administrativeGenderCode=_element("code", "displayName"),
        birthTime=value,
        maritalStatusCode=_element("code", "displayName"),
        religiousAffiliationCode=_element("displayName"),
        raceCode=_element("displayName"),
        ethnicGroupCode=_element("displayName"),
        languageCommunication=_element(languageCode=_element("code")),
    )
    role = _element(
        addr=address,
        telecom=_element("use", "value"),
        patient=patient,
        providerOrganization=_element(name=_TEXT, telecom=_element("value"), addr=address),
    )
    performer = _element(assignedEntity=_element(assignedPerson=_element(name=person_name)))
    root = _element(
        **{_FOUND: _element(code=_element("displayName"), title=_TEXT, effectiveTime=_element("value"))},
        recordTarget=_element(patientRole=role),
        documentationOf=_element(serviceEvent=_element(performer=performer)),
        component=_element(
            structuredBody=_element(component=_element(section=section)),
        ),
    )
    return T.StructType(
        root.elementType.fields + [T.StructField("_corrupt_record", T.StringType())]
    )


_XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "wildcardColName": _WILDCARD,
    "ignoreSurroundingSpaces": "false",
}


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it.

    Columns that stand for expressions are put in their places by the
    optimizer, each time they are named; a variable of a function is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def plain_markup(xml: Column) -> Column:
    """Document text without comments, and with marked character data as escaped text."""
    xml = F.when(xml.contains("<!--"), F.regexp_replace(xml, r"(?s)<!--.*?-->", "")).otherwise(xml)

    def escaped(part: Column, i: Column) -> Column:
        end = F.instr(part, "]]>")
        data = F.replace(F.replace(F.substring(part, F.lit(1), end - 1), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when((i > 0) & (end > 0), F.concat(data, F.substring(part, end + 3, F.length(part)))).otherwise(
            F.when(i > 0, F.concat(F.lit("<![CDATA["), part)).otherwise(part))

    parts = F.transform(F.split(xml, r"<!\[CDATA\["), escaped)
    return F.when(xml.contains("<![CDATA["), F.array_join(parts, "")).otherwise(xml)


def nested_sections(xml: Column) -> Column:
    """Whether a section opens before the one before it has closed, and as many close as open.

    Sections that do not all close can not be put in order: their text stays
    as it is, and is not taken apart to find that out.
    """
    tags = F.regexp_extract_all(xml, F.lit(rf"</?{_PREFIX}section(?=[\s>]){_ATTRIBUTES}>"), F.lit(0))
    marks = F.transform(
        tags, lambda t: F.when(t.startswith("</"), ")").when(t.endswith("/>"), "").otherwise("(")
    )
    def nested(found: Column) -> Column:
        opened, closed = (F.length(F.replace(found, F.lit(other), F.lit(""))) for other in ")(")
        return F.contains(found, F.lit("((")) & (opened == closed)

    return _bound(F.array_join(marks, ""), nested)


def flat_sections(xml: Column) -> Column:
    """Document text in which no section lies in another one.

    The text is cut at section tags. A stack of the open sections tells whose
    piece each one is, and sections follow each other in the order in which
    they open, each with its own pieces. So one schema of one level reads any
    depth. A text whose section tags do not match stays as it is.
    """
    pieces = F.transform(
        F.split(xml, rf"(?=</?{_PREFIX}section[\s>])"),
        lambda p, i: F.struct(i.cast("int").alias("i"), p.alias("text")),
    )

    def piece(of: Column, at: Column, text: Column) -> Column:
        return F.struct(of.cast("int").alias("of"), at.cast("int").alias("at"), text.alias("text"))

    def state(open_: Column, out: Column, good: Column) -> Column:
        return F.struct(open_.alias("open"), out.alias("out"), good.alias("good"))

    def step(a: Column, x: Column) -> Column:
        # Between sections a piece is its own, after all that have opened by then.
        inner = lambda open_: F.coalesce(F.try_element_at(open_, F.lit(-1)), x["i"])
        outer = F.slice(a["open"], F.lit(1), F.greatest(F.size(a["open"]) - 1, F.lit(0)))
        end = F.instr(x["text"], ">")
        tag, rest = F.substring(x["text"], F.lit(1), end), F.substring(x["text"], end + 1, F.length(x["text"]))
        closes = x["text"].startswith("</")
        empty = x["text"].rlike(rf"^<{_PREFIX}section{_ATTRIBUTES}(?<=/)>")
        return (
            F.when(closes, state(
                outer,
                F.concat(a["out"], F.array(piece(inner(a["open"]), 2 * x["i"], tag), piece(inner(outer), 2 * x["i"] + 1, rest))),
                a["good"] & (F.size(a["open"]) > 0)))
            .when(empty, state(a["open"], F.concat(a["out"], F.array(piece(inner(a["open"]), 2 * x["i"], x["text"]))), a["good"]))
            .otherwise(state(
                F.concat(a["open"], F.array(x["i"])),
                F.concat(a["out"], F.array(piece(x["i"], 2 * x["i"], x["text"]))), a["good"]))
        )

    nothing = F.array().cast("array<int>")
    first = F.array(piece(F.lit(-1), F.lit(0), F.get(pieces, F.lit(0))["text"]))
    return F.aggregate(
        F.slice(pieces, F.lit(2), F.size(pieces)),
        state(nothing, first, F.lit(True)),
        step,
        lambda a: F.when(
            a["good"] & (F.size(a["open"]) == 0), F.array_join(F.transform(F.array_sort(a["out"]), lambda p: p["text"]), "")
        ),
    )


def with_first_found(xml: Column) -> Column:
    """Document text with copies of the summary code, the time and the title that stand first in it.

    They count wherever they are, in sections too; the copies stand at one
    place, so that the parse that reads the rest reads them as well.
    """
    prefixed = _prefixed(xml)

    def cut(pattern: str) -> Column:
        """First match; in a document with prefixes an element may have any."""
        return F.when(
            prefixed, F.regexp_extract(xml, pattern.replace("<~", f"<{_PREFIX}").replace("</~", f"</{_PREFIX}"), 0)
        ).otherwise(F.regexp_extract(xml, pattern.replace("<~", "<").replace("</~", "</"), 0))

    def empty(tag: Column) -> Column:
        """A start tag as an element without content."""
        return F.when(tag != "", F.concat(F.regexp_replace(tag, r"/?>$", ""), F.lit("/>"))).otherwise("")

    value = f"""(?:"{SUMMARY_DOCUMENT_CODE}"|'{SUMMARY_DOCUMENT_CODE}')"""
    before = r"""(?:[^<>"']*(?:"[^"<]*"|'[^'<]*'))*?[^<>"']*?(?<=\s)"""
    code = empty(cut(rf"<~code(?=\s){before}code\s*=\s*{value}{_ATTRIBUTES}>"))
    time = empty(cut(rf"<~effectiveTime(?=[\s>/]){_ATTRIBUTES}>"))
    title = cut(rf"(?s)<~title(?=[\s>/]){_ATTRIBUTES}(?:(?<=/)>|>.*?</~title\s*>)")
    root = F.regexp_extract(xml, rf"(?s)^.*?<{_PREFIX}ClinicalDocument(?=[\s>]){_ATTRIBUTES}(?<!/)>", 0)
    found = F.concat(F.lit(f"<{_FOUND}>"), code, time, title, F.lit(f"</{_FOUND}>"))
    return F.when(root != "", F.concat(root, found, F.substring(xml, F.length(root) + 1, F.length(xml)))).otherwise(xml)


def _prefixed(xml: Column) -> Column:
    return xml.rlike(r"<[^\s<>/!?:]+:ClinicalDocument[\s>/]")


def read_cda(xml: Column) -> Column:
    """Parse document text, prepared by the functions above, into the document struct.

    Prefixed documents need namespace stripping; the others must not have it,
    because it would fold extension elements into the standard ones.
    """
    schema = _document_schema()
    return F.when(
        _prefixed(xml), F.from_xml(xml, schema, {**_XML_OPTIONS, "ignoreNamespace": "true"})
    ).otherwise(F.from_xml(xml, schema, _XML_OPTIONS))


def nodes(start: Column, path: str) -> Column:
    """Array of all nodes at ``path`` below an array of nodes, document order.

    ``flatten`` gives NULL as soon as one inner array is NULL, so absent
    children leave first.
    """
    for step in path.split("/"):
        start = F.flatten(F.array_compact(start[step]))
    return start


def first(start: Column, path: str) -> Column:
    return F.get(nodes(start, path), F.lit(0))


def text(start: Column, path: str) -> Column:
    """Text of the first node; an empty element counts as absent."""
    return F.nullif(first(start, path), F.lit(""))


def attribute(start: Column, path: str, name: str) -> Column:
    return first(start, path)[f"_{name}"]


def _having(found: Column, name: str, *wanted: str) -> Column:
    """Nodes whose attribute equals one of ``wanted``."""
    return F.filter(found, lambda n: n[f"_{name}"].isin(*wanted))


def _one(node: Column) -> Column:
    """A node as the one-element array that ``nodes`` walks from."""
    return F.array(node)


def _author_fields(owner: Column) -> dict[str, Column]:
    """Provider of an entry; ``owner`` is an array of one entry node."""
    author = "author/assignedAuthor"
    ids = _having(nodes(owner, f"{author}/id"), "root", NATIONAL_PROVIDER_ID)
    return {
        "provider_id": F.get(ids, F.lit(0))["_extension"],
        "provider_fname": text(owner, f"{author}/assignedPerson/name/given"),
        "provider_lname": text(owner, f"{author}/assignedPerson/name/family"),
        "provider_entry_date": cda_timestamp(attribute(owner, "author/time", "value")),
    }


def _struct(fields: dict[str, Column], schema: T.StructType) -> Column:
    def typed(field: T.StructField) -> Column:
        column = fields[field.name]
        if isinstance(field.dataType, T.FloatType):
            column = text_to_fraction(column, "float")
        return column.alias(field.name)

    return F.struct(*[typed(f) for f in schema.fields])


def _problem(act: Column) -> Column:
    observation = _one(first(_one(act), "entryRelationship/observation"))
    value = first(observation, "value")
    translations = nodes(observation, "value/translation")
    names = ["codeSystem", "codeSystemName", "code", "displayName"]
    incomplete = value[f"_{names[0]}"].isNull()
    for name in names[1:]:
        incomplete = incomplete | value[f"_{name}"].isNull()
    # One missing attribute hands all four over to the first translation.
    replaced = incomplete & (F.coalesce(F.size(translations), F.lit(0)) > 0)
    concept = {
        name: F.when(replaced, F.get(translations, F.lit(0))[f"_{name}"]).otherwise(
            value[f"_{name}"]
        )
        for name in names
    }
    owner = _one(act)
    return _struct(
        {
            "concern_type_code": attribute(owner, "code", "code"),
            "concern_type_name": attribute(owner, "code", "displayName"),
            "problem_status": attribute(owner, "statusCode", "code"),
            "condition_concept_id": concept["codeSystem"],
            "condition_concept_value": concept["codeSystemName"],
            "condition_start_date": cda_timestamp(
                attribute(observation, "effectiveTime/low", "value")
            ),
            "condition_end_date": cda_timestamp(
                attribute(observation, "effectiveTime/high", "value")
            ),
            "condition_type_concept_id": F.lit(PROBLEM_TYPE_CONCEPT),
            "condition_source_value": concept["code"],
            "condition_source_concept_id": concept["displayName"],
            **_author_fields(observation),
        },
        PROBLEM_FIELDS,
    )


_MATERIAL = "consumable/manufacturedProduct/manufacturedMaterial"


def _has_child(material: Column) -> Column:
    found = [material[child].isNotNull() for child in ("code", "name", _WILDCARD)]
    return found[0] | found[1] | found[2]


def _medication(administration: Column) -> Column:
    owner = _one(administration)
    material = _one(first(owner, _MATERIAL))
    code = _one(first(material, "code"))
    translations = nodes(code, "translation")
    rxnorm = F.get(_having(translations, "codeSystem", RXNORM), F.lit(0))

    def concept(name: str) -> Column:
        """Each attribute falls back on its own, unlike a problem's."""
        return F.coalesce(
            F.get(code, F.lit(0))[f"_{name}"],
            rxnorm[f"_{name}"],
            F.get(translations, F.lit(0))[f"_{name}"],
        )

    supply = "entryRelationship/supply"
    return _struct(
        {
            "drug_concept_id": concept("codeSystem"),
            "drug_concept_value": concept("codeSystemName"),
            # The name is looked up across all materials of the entry.
            "drug_source_value": F.coalesce(
                concept("displayName"), text(owner, f"{_MATERIAL}/name")
            ),
            "drug_source_concept_id": concept("code"),
            "drug_exposure_start_date": cda_timestamp(
                attribute(owner, "effectiveTime/low", "value")
            ),
            "drug_exposure_end_date": cda_timestamp(
                attribute(owner, "effectiveTime/high", "value")
            ),
            "dose_unit_concept_id": attribute(owner, "doseQuantity", "unit"),
            "dose_unit_source_value": attribute(owner, "doseQuantity", "value"),
            "route_concept_id": attribute(owner, "routeCode", "code"),
            "route_source_value": attribute(owner, "routeCode", "displayName"),
            "drug_supply_quantity": attribute(owner, f"{supply}/quantity", "value"),
            "drug_supply_refill": attribute(owner, f"{supply}/repeatNumber", "value"),
            **_author_fields(owner),
        },
        MEDICATION_FIELDS,
    )


def _routed(section: Column, template: str, entries: Callable[[Column], Column]) -> Column:
    """``entries`` of a section that carries ``template``, else an empty array."""
    carries = F.exists(section["templateId"], lambda t: t["_root"] == template)
    found = entries(_one(section))
    return F.when(carries & found.isNotNull(), found).otherwise(F.filter(found, lambda _: F.lit(False)))


def _problem_acts(section: Column) -> Column:
    def informative(act: Column) -> Column:
        flavor = attribute(_one(act), "entryRelationship/observation/value", "nullFlavor")
        return flavor.isNull() | (flavor != NO_INFORMATION)

    return F.filter(nodes(section, "entry/act"), informative)


def _administrations(section: Column) -> Column:
    return F.filter(
        nodes(section, "entry/substanceAdministration"),
        lambda a: F.coalesce(_has_child(first(_one(a), _MATERIAL)), F.lit(False)),
    )


def _sections(cda: Column) -> Column:
    """Sections of the body in document order."""
    return nodes(_one(cda), "component/structuredBody/component/section")


def _document_columns() -> dict[str, Column]:
    """The scalar fields, from the ``cda`` and ``role`` columns."""
    cda, role = F.array("cda"), F.col("role")
    patient, org = F.col("patient"), F.col("organization")
    phones = nodes(role, "telecom")

    def phone(use: str) -> Column:
        return F.get(_having(phones, "use", use), F.lit(0))["_value"]

    performer = "documentationOf/serviceEvent/performer/assignedEntity/assignedPerson/name"
    birth_time = attribute(patient, "birthTime", "value")
    return {
        "document_type": attribute(cda, f"{_FOUND}/code", "displayName"),
        "effective_time": cda_timestamp(attribute(cda, f"{_FOUND}/effectiveTime", "value")),
        "document_title": text(cda, f"{_FOUND}/title"),
        "patient_fname": text(patient, "name/given"),
        "patient_lname": text(patient, "name/family"),
        "gender_code": attribute(patient, "administrativeGenderCode", "code"),
        "gender": attribute(patient, "administrativeGenderCode", "displayName"),
        "race": attribute(patient, "raceCode", "displayName"),
        "ethnicity": attribute(patient, "ethnicGroupCode", "displayName"),
        "birth_time": birth_time,
        "birth_date": cda_timestamp(birth_time),
        "street_address": text(role, "addr/streetAddressLine"),
        "city": text(role, "addr/city"),
        "state": text(role, "addr/state"),
        "zip_code": text(role, "addr/postalCode"),
        "country": text(role, "addr/country"),
        "home_phone": phone("HP"),
        "mobile_phone": phone("MC"),
        "marital_code": attribute(patient, "maritalStatusCode", "code"),
        "marital_status": attribute(patient, "maritalStatusCode", "displayName"),
        "religion": attribute(patient, "religiousAffiliationCode", "displayName"),
        "language": attribute(patient, "languageCommunication/languageCode", "code"),
        "provider_fname": text(cda, f"{performer}/given"),
        "provider_lname": text(cda, f"{performer}/family"),
        "provider_org": text(org, "name"),
        "provider_phone": attribute(org, "telecom", "value"),
        "provider_address": text(org, "addr/streetAddressLine"),
        "provider_city": text(org, "addr/city"),
        "provider_state": text(org, "addr/state"),
        "provider_zip_code": text(org, "addr/postalCode"),
        "provider_country": text(org, "addr/country"),
    }


def parse_documents(docs: DataFrame, provider: str = "performer") -> DataFrame:
    """Parse ``xml_string`` of ``patient_id, document_id, xml_string`` rows.

    Gives the document fields, the ``problems`` and ``medications`` arrays and
    ``malformed`` (NULL, or the text that is not well-formed XML).

    ``provider`` says who a document's provider is: its ``performer``, or the
    author of its ``last_entry`` where it has entries, for results equal to
    tables built that way.

    Sections may lie in sections, however deep. Whatever a document is, it is
    judged by itself: neither the plan nor other documents depend on it.
    """
    if provider not in ("performer", "last_entry"):
        raise ValueError("provider must be 'performer' or 'last_entry'")
    keys = ["patient_id", "document_id"]
    # Stepwise projections keep each parse and lookup single: the optimizer
    # does not merge a costly column into several uses of it.
    text = _bound(F.col("xml_string"), plain_markup)
    text = _bound(text, lambda x: F.when(nested_sections(x), F.coalesce(flat_sections(x), x)).otherwise(x))
    text = _bound(text, with_first_found)
    parsed = docs.select(*keys, "xml_string", _bound(text, read_cda).alias("cda"))
    parts = parsed.select(
        *keys,
        "xml_string",
        "cda",
        nodes(F.array("cda"), "recordTarget/patientRole").alias("role"),
        _sections(F.col("cda")).alias("sections"),
    ).select(
        "*",
        nodes(F.col("role"), "patient").alias("patient"),
        nodes(F.col("role"), "providerOrganization").alias("organization"),
        F.transform(
            "sections",
            lambda s: F.struct(
                F.transform(_routed(s, PROBLEM_SECTION, _problem_acts), _problem).alias("problems"),
                F.transform(
                    _routed(s, MEDICATION_SECTION, _administrations), _medication
                ).alias("medications"),
            ),
        ).alias("entries"),
    )
    fields = _document_columns()
    columns = []
    for field in DOCUMENT_FIELDS.fields:
        column = fields[field.name]
        if isinstance(field.dataType, T.IntegerType):
            column = text_to_int(column)
        columns.append(column.alias(field.name))
    out = parts.select(
        *keys,
        *columns,
        nodes(F.col("entries"), "problems").alias("problems"),
        nodes(F.col("entries"), "medications").alias("medications"),
        F.when(F.col("cda._corrupt_record").isNotNull(), F.col("xml_string")).alias("malformed"),
        *([_last_author().alias("last_author")] if provider == "last_entry" else []),
    )
    if provider == "last_entry":
        for part in ("provider_fname", "provider_lname"):
            out = out.withColumn(
                part,
                F.when(F.col("last_author").isNotNull(), F.col(f"last_author.{part}")).otherwise(
                    F.col(part)
                ),
            )
        out = out.drop("last_author")
    return out


def _last_author() -> Column:
    def authors(entries: Column) -> Column:
        return F.transform(
            entries,
            lambda e: F.struct(
                e["provider_fname"].alias("provider_fname"),
                e["provider_lname"].alias("provider_lname"),
            ),
        )

    ordered = F.flatten(
        F.transform(
            "entries", lambda s: F.concat(authors(s["problems"]), authors(s["medications"]))
        )
    )
    return F.try_element_at(ordered, F.lit(-1))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(well-formed documents, quarantine)`` of parsed documents."""
    good = parsed.filter(F.col("malformed").isNull()).drop("malformed")
    bad = parsed.filter(F.col("malformed").isNotNull()).select(
        "patient_id", "document_id", "malformed"
    )
    return good, bad


def split_usable(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clinical documents, quarantine)``, the latter with a ``reason``.

    Text that is no XML is malformed; XML in which none of the fields and no
    entry was found is no clinical document.
    """
    empty = (F.coalesce(F.size("problems"), F.lit(0)) == 0) & (
        F.coalesce(F.size("medications"), F.lit(0)) == 0
    )
    for name in DOCUMENT_FIELDS.fieldNames():
        empty = empty & F.col(name).isNull()
    reason = F.when(F.col("malformed").isNotNull(), MALFORMED).when(empty, NOT_CLINICAL)
    judged = parsed.withColumn("reason", reason)
    return (
        judged.filter(F.col("reason").isNull()).drop("malformed", "reason"),
        judged.filter(F.col("reason").isNotNull()).select(*QUARANTINE),
    )


def only_new(docs: DataFrame, seen: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows of ``docs`` whose key is not in ``seen``.

    The right side is reduced to its distinct keys first, so a key that
    repeats there costs one row in the shuffle.
    """
    return docs.join(seen.select(key).distinct(), key, "left_anti")


def doc_patients(parsed: DataFrame) -> DataFrame:
    """One row per document with its entry counts."""
    return parsed.select(
        "patient_id",
        "document_id",
        *DOCUMENT_FIELDS.fieldNames(),
        F.coalesce(F.size("problems"), F.lit(0)).alias("problem_count"),
        F.coalesce(F.size("medications"), F.lit(0)).alias("medication_count"),
    ).distinct()


def _entries(parsed: DataFrame, array: str, schema: T.StructType, id_name: str) -> DataFrame:
    # The outer form with a test on the position: a plain explode makes the
    # optimizer push "array is not empty" below the parse, which would then run
    # twice per document.
    rows = (
        parsed.select("patient_id", "document_id", F.posexplode_outer(array).alias("pos", "entry"))
        .filter(F.col("pos").isNotNull())
        .select("patient_id", "document_id", "entry.*")
        .distinct()
    )
    names = ["patient_id", "document_id", *schema.fieldNames()]
    return rows.select(hash_id(*names).alias(id_name), *names)


def doc_problems(parsed: DataFrame) -> DataFrame:
    return _entries(parsed, "problems", PROBLEM_FIELDS, "problem_id")


def doc_medications(parsed: DataFrame) -> DataFrame:
    return _entries(parsed, "medications", MEDICATION_FIELDS, "medication_id")
