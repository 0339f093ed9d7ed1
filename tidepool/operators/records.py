"""Metadata records as rows.

One nested record per dataset is assembled with ``struct``/``transform``;
optional sections are null (and therefore absent from ``to_json``/``to_xml``)
when their inputs are missing. Validation parses many documents at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import fixed
from tidepool.functions.text import present

WORLD = {"west_lon": -180.0, "east_lon": 180.0, "south_lat": -90.0, "north_lat": 90.0}
STANDARD_NAME = "ISO 19115-2"
STANDARD_VERSION = "ISO 19115-2:2009(E)"


def keywords_text(theme: Column, place: Column) -> Column:
    """Theme then place keywords joined by ``, ``; null when there are none."""
    allk = F.concat(F.coalesce(theme, F.array().cast("array<string>")), F.coalesce(place, F.array().cast("array<string>")))
    return F.when(F.size(allk) > 0, F.array_join(allk, ", "))


def assemble(df: DataFrame) -> DataFrame:
    """M1 + M2 + M3 + P12: one record struct per input row.

    Input columns (all optional but ``dataset_id``): ``title, abstract, purpose, doi, language, character_set,
    hierarchy_level, topic_category, progress, date_stamp, contact_name, organisation, contact_email,
    contact_role, contact_orcid, curator_name, curator_organisation, curator_email, theme_keywords,
    place_keywords, instrument_keywords, license_name, license_url, west_lon, east_lon, south_lat, north_lat, crs,
    begin, end, distribution_name, distribution_url, funding_agency, funding_award, lineage_statement,
    steps (array<string>), platform, platform_description, instruments (array<string>)``. What is missing or blank
    takes the value of ``fixed.RECORD_DEFAULTS``, or is empty text; sections without content are null.
    """
    cols = set(df.columns)

    def c(name, default=None, dtype="string"):
        v = F.col(name) if name in cols else F.lit(None).cast(dtype)
        if dtype == "string":
            v = present(v)
            default = fixed.RECORD_DEFAULTS.get(name, "") if default is None else default
        return F.coalesce(v, F.lit(default).cast(dtype)) if default is not None else v

    theme = c("theme_keywords", dtype="array<string>")
    place = c("place_keywords", dtype="array<string>")
    has_theme = F.coalesce(F.size(theme) > 0, F.lit(False))
    has_place = F.coalesce(F.size(place) > 0, F.lit(False))
    bbox = F.struct(*[c(k, v, "double").alias(k) for k, v in WORLD.items()])
    steps = c("steps", dtype="array<string>")
    instruments = c("instruments", dtype="array<string>")
    platform, doi, license_name, begin, end, funder = (
        present(F.col(x)) if x in cols else F.lit(None).cast("string")
        for x in ("platform", "doi", "license_name", "begin", "end", "funding_agency"))
    words = c("instrument_keywords", dtype="array<string>")
    statement = present(F.col("lineage_statement")) if "lineage_statement" in cols else F.lit(None).cast("string")

    def party(prefix, *more):
        return F.struct(c(f"{prefix}_name").alias("individualName"),
                        c("organisation" if prefix == "contact" else f"{prefix}_organisation").alias("organisationName"),
                        c(f"{prefix}_email").alias("email"), *more)

    ident = F.struct(
        F.struct(c("title").alias("title"), c("date_stamp", "1970-01-01").alias("date"),
                 F.when(doi.isNotNull(), F.struct(doi.alias("code"))).alias("identifier")).alias("citation"),
        c("abstract").alias("abstract"), c("purpose").alias("purpose"), c("progress").alias("status"),
        F.when(has_theme, F.struct(F.lit("theme").alias("type"), theme.alias("keyword"))).alias("descriptiveKeywords"),
        F.when(has_place, F.struct(F.lit("place").alias("type"), place.alias("keyword"))).alias("placeKeywords"),
        F.when(F.size(words) > 0, F.struct(F.lit("instrument").alias("type"), words.alias("keyword"))).alias("instrumentKeywords"),
        F.when(license_name.isNotNull(), F.struct(license_name.alias("license"), c("license_url").alias("url")))
        .alias("resourceConstraints"),
        c("topic_category").alias("topicCategory"),
        F.when(funder.isNotNull(), F.struct(funder.alias("agency"), c("funding_award").alias("award"))).alias("funding"),
        F.struct(
            bbox.alias("geographicElement"),
            F.when(begin.isNotNull() & end.isNotNull(), F.struct(begin.alias("begin"), end.alias("end")))
            .alias("temporalElement"),
        ).alias("extent"),
    )
    has_steps = F.coalesce(F.size(steps) > 0, F.lit(False))
    record = F.struct(
        F.coalesce(doi, F.lit(fixed.RECORD_DEFAULTS["file_identifier"])).alias("fileIdentifier"),
        c("language").alias("language"), c("character_set").alias("characterSet"), c("hierarchy_level").alias("hierarchyLevel"),
        party("contact", c("contact_role").alias("role"), c("contact_orcid").alias("orcid")).alias("contact"),
        party("curator").alias("curator"),
        c("date_stamp", "1970-01-01").alias("dateStamp"),
        F.lit(STANDARD_NAME).alias("metadataStandardName"),
        F.lit(STANDARD_VERSION).alias("metadataStandardVersion"),
        c("crs").alias("referenceSystem"),
        ident.alias("identificationInfo"),
        F.struct(c("distribution_name").alias("distributor"), c("distribution_url").alias("url")).alias("distributionInfo"),
        F.when(has_steps | statement.isNotNull(), F.struct(
            c("lineage_statement").alias("statement"),
            F.when(has_steps, F.transform(steps, lambda s, i: F.struct((i + 1).alias("step"), s.alias("description"))))
            .alias("processStep"))).alias("lineage"),
        F.when(platform.isNotNull() | F.coalesce(F.size(instruments) > 0, F.lit(False)),
               F.struct(platform.alias("platform"), c("platform_description").alias("description"),
                        instruments.alias("instrument"))).alias("acquisitionInformation"),
    )
    return df.select("dataset_id", record.alias("record"), keywords_text(theme, place).alias("keywords_text"))


def to_xml_text(record: Column) -> Column:
    """Render a record as XML text (escaped; root element ``MD_Metadata``)."""
    return F.to_xml(record, {"rowTag": "MD_Metadata"})


def validate_xml(docs: DataFrame, key: str, text: str) -> DataFrame:
    """M4 + X2 + X3: well-formedness, then the four required elements, one row per document.

    Malformed text is found by ``from_xml`` with a corrupt-record column;
    ``xpath_boolean`` only runs on well-formed rows (it would fail the job).
    Element tests ignore namespace prefixes (``local-name()``).
    """
    parsed = F.from_xml(F.col(text), "_corrupt_record string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    d = docs.select(key, text, parsed["_corrupt_record"].isNull().alias("well_formed"))
    # One XPath evaluation per document: a bit per required element.
    mask = " + ".join(f"{1 << i} * number(boolean(//*[local-name()='{el}']))"
                      for i, el in enumerate(fixed.REQUIRED_ELEMENTS))
    bits = F.expr(f'xpath_int({text}, "{mask}")')
    missing = F.array_compact(F.array(*[
        F.when(F.shiftright(F.col("_bits"), i) % 2 == 0, F.lit(el)) for i, el in enumerate(fixed.REQUIRED_ELEMENTS)
    ]))
    out = d.withColumn("_bits", F.when(F.col("well_formed"), bits)).withColumn(
        "errors", F.when(F.col("well_formed"), missing).otherwise(F.array(F.lit("not well-formed XML"))))
    return out.select(key, "well_formed", (F.size("errors") == 0).alias("valid"),
                      F.array_join("errors", "; ").alias("errors"), F.size("errors").alias("error_count"))
