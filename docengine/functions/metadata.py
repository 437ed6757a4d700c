"""Typed metadata documents: a Variant column, and a view with types that keeps what doesn't fit.

A model's document is text that may miss fields, add others, or hold a word where a number belongs.
``as_variant`` keeps it as it is, ``typed`` reads the known fields by their kinds, null where a
field is absent, and ``misfit`` names the fields that are set but of another kind, so nothing is
lost without a trace.  Both prompts' layouts are read; the older one's names are brought to the newer's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Field names of the two prompts' documents, in their order, and the kinds of their values.
FIELDS: dict[str, dict[str, str]] = {
    "document_metadata": {
        "language_detected": "list", "state": "string", "electoral_roll_year": "int", "revision_type": "string", "qualifying_date": "string", "publication_date": "string",
        "roll_type": "string", "roll_identification": "string", "total_pages": "int", "page_number_current": "int",
    },
    "constituency_details": {
        "assembly_constituency_number": "int", "assembly_constituency_name": "string", "assembly_reservation_status": "string", "parliamentary_constituency_number": "int",
        "parliamentary_constituency_name": "string", "parliamentary_reservation_status": "string", "part_number": "int",
    },
    "administrative_address": {
        "town_or_village": "string", "ward_number": "string", "post_office": "string", "police_station": "string", "taluk_or_block": "string", "subdivision": "string", "district": "string", "pin_code": "string",
    },
    "part_and_polling_details": {
        "sections": "sections", "polling_station_number": "int", "polling_station_name": "string", "polling_station_address": "string", "polling_station_type": "string", "auxiliary_polling_station_count": "int",
    },
    "detailed_elector_summary": {"serial_number_range": "range", "mother_roll": "counts", "additions": "counts", "deletions": "counts", "gender_modification_difference": "counts", "net_total": "counts"},
    "modifications_info": {"roll_type": "string", "roll_identification": "string", "total_modifications": "int"},
    "authority_verification": {"designation": "string", "signature_present": "boolean"},
}
#: Where the older prompt's document keeps a field of the newer one.
OLDER: dict[str, str] = {
    "document_metadata.publication_date": "document_metadata.publicationation_date", "document_metadata.roll_identification": "document_metadata.roll_identification_text",
    "document_metadata.page_number_current": "document_metadata.page_number",
    **{f"constituency_details.{f}": f"constituency.{f}" for f in FIELDS["constituency_details"] if f != "part_number"}, "constituency_details.part_number": "part_details.part_number",
    **{f"administrative_address.{f}": f"administrative_details.{f}" for f in FIELDS["administrative_address"] if f != "taluk_or_block"}, "administrative_address.taluk_or_block": "administrative_details.block_or_taluk",
    "part_and_polling_details.sections": "part_details.sections", **{f"part_and_polling_details.{f}": f"polling_station.{f}" for f in FIELDS["part_and_polling_details"] if f != "sections"},
    "detailed_elector_summary.serial_number_range.start": "elector_summary.serial_number_start", "detailed_elector_summary.serial_number_range.end": "elector_summary.serial_number_end",
    **{f"detailed_elector_summary.net_total.{k}": f"elector_summary.{k}_electors" for k in ("male", "female", "third_gender", "total")},
    "authority_verification.designation": "authority.authority_designation", "authority_verification.signature_present": "authority.signature_present",
}
COUNTS = ("male", "female", "third_gender", "total")


def leaves() -> dict[str, str]:
    """Path and kind of every field that holds one value; counts and ranges are taken apart."""
    out = {}
    for group, fields in FIELDS.items():
        for name, kind in fields.items():
            below = {"counts": COUNTS, "range": ("start", "end")}.get(kind)
            out |= {f"{group}.{name}.{x}": "int" for x in below} if below else {f"{group}.{name}": kind}
    return out


def as_variant(document: Column) -> Column:
    """The document as a Variant; null where the text is no JSON."""
    return F.try_parse_json(document)


def _places(path: str) -> list[str]:
    """Where a field stands: in the newer layout, then in the older one."""
    return [path, OLDER[path]] if path in OLDER else [path]


def _objects() -> list[str]:
    """The objects that hold fields in either layout, outer ones first."""
    held = {p.rsplit(".", 1)[0] for path in leaves() for p in _places(path)}
    return sorted(held | {o.split(".")[0] for o in held}, key=lambda o: (o.count("."), o))


def _value(objects: dict[str, Column], path: str) -> Column:
    """A field's raw value: where the newer layout has it, else where the older one does; JSON null counts as absent."""
    found = [F.try_variant_get(objects[o], f"$.{name}", "variant") for o, name in (p.rsplit(".", 1) for p in _places(path))]
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in found])


def _as(kind: str, value: Column) -> Column:
    """A value in its kind, null if it does not fit.

    Numbers may be printed as text, with separators of thousands; truth values may be words; text is
    taken from any plain value.  A language may stand alone or in a list.
    """
    text = F.try_variant_get(value, "$", "string")
    shape = F.schema_of_variant(value)
    plain = ~shape.startswith("OBJECT") & ~shape.startswith("ARRAY")
    if kind == "int":
        digits = F.regexp_replace(F.trim(text), r"(?<=\d),(?=\d)", "")
        return F.when(plain & digits.rlike(r"^[+-]?\d{1,18}(?:\.0+)?$"), F.regexp_replace(digits, r"\.0+$", "").cast("long"))
    if kind == "boolean":
        word = F.lower(F.trim(text))
        return F.when(plain & word.isin("true", "yes", "1"), True).when(plain & word.isin("false", "no", "0"), False)
    if kind == "list":
        return F.when(plain, F.array(text)).when(shape.startswith("ARRAY"), F.try_variant_get(value, "$", "array<string>"))
    if kind == "sections":
        return F.when(shape.startswith("ARRAY"), F.try_variant_get(value, "$", "array<struct<section_number:string,section_name:string>>"))
    return F.when(plain, text)


def typed(rows: DataFrame, document: str = "document") -> DataFrame:
    """``rows`` with parsed, a struct for each group of fields, and misfit.

    ``parsed`` is false for text that is no JSON; all fields are then null.  ``misfit`` lists in
    order the paths whose value is of another kind than the field, with that value as JSON.
    The document stays beside them, so a rejected value can be looked at.

    A document has few of the objects that hold fields, so these are looked up first: the fields of
    an absent one cost a test for null instead of a way through the document.
    """
    doc, paths = "_doc", leaves()
    names = {p: f"_v{i}" for i, p in enumerate(paths)}
    out = rows.withColumn(doc, as_variant(F.col(document)))
    objects: dict[str, Column] = {}
    for i, o in enumerate(_objects()):
        outer, _, name = o.rpartition(".")
        out = out.withColumn(f"_o{i}", F.try_variant_get(objects[outer] if outer else F.col(doc), f"$.{name}", "variant"))
        objects[o] = F.col(f"_o{i}")
    out = out.withColumns({names[p]: _value(objects, p) for p in paths})
    cast = {p: _as(kind, F.col(names[p])) for p, kind in paths.items()}
    out = out.withColumns({f"{names[p]}c": c for p, c in cast.items()})
    groups = {}
    for group, fields in FIELDS.items():
        members = []
        for name, kind in fields.items():
            below = {"counts": COUNTS, "range": ("start", "end")}.get(kind)
            if below:
                members.append(F.struct(*[F.col(f"{names[f'{group}.{name}.{x}']}c").alias(x) for x in below]).alias(name))
            else:
                members.append(F.col(f"{names[f'{group}.{name}']}c").alias(name))
        groups[group] = F.struct(*members)
    bad = [F.when(F.col(names[p]).isNotNull() & F.col(f"{names[p]}c").isNull(), F.struct(F.lit(p).alias("path"), F.to_json(names[p]).alias("value"))) for p in paths]
    out = out.withColumns({"parsed": F.col(doc).isNotNull(), **groups, "misfit": F.filter(F.array(*bad), lambda x: x.isNotNull())})
    return out.drop(doc, *[f"_o{i}" for i in range(len(objects))], *names.values(), *[f"{n}c" for n in names.values()])


def common_shape(rows: DataFrame, document: str = "document") -> DataFrame:
    """One row: the schema that all documents fit, merged by aggregation, and the number of documents that are no JSON."""
    doc = as_variant(F.col(document))
    return rows.agg(F.schema_of_variant_agg(doc).alias("shape"), F.count_if(doc.isNull()).alias("unparsed"))
