"""Standard-vocabulary mapping and attributed export (J-5, W3, A19, P13, P16, S12, S13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed
from tidepool.functions.numeric import fill_number
from tidepool.functions.text import fill_text

VOCAB_SCHEMA = (
    "priority int, key string, standard_name string, long_name string, units string, valid_min double, "
    "valid_max double, axis string, positive string, comment string"
)


def vocabulary_table(spark: SparkSession) -> DataFrame:
    """The fixed 10-entry vocabulary as a table, ``priority`` = map order."""
    return spark.createDataFrame([(i, *row) for i, row in enumerate(fixed.VOCABULARY)], VOCAB_SCHEMA)


def vocabulary_priority(name: Column) -> Column:
    """J-5 + W3: priority of the first vocabulary key contained in the name (null if none).

    The name is lower-cased with spaces as ``_``; keys are tested in map order,
    so ``phosphate`` maps to pH and ``plate`` to nothing. A CASE chain over ten
    literal keys, not a join.
    """
    n = F.regexp_replace(F.lower(name), " ", "_")
    expr = None
    for i, row in enumerate(fixed.VOCABULARY):
        cond = n.contains(row[0])
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def match_vocabulary(columns: DataFrame, name_col: str = "name") -> DataFrame:
    """Attach vocabulary attributes; unmatched names keep ``standard_name = ''`` (left join)."""
    voc = vocabulary_table(columns.sparkSession)
    c = columns.withColumn("priority", vocabulary_priority(F.col(name_col)))
    j = c.join(F.broadcast(voc), on="priority", how="left")
    return j.withColumn("standard_name", F.coalesce(F.col("standard_name"), F.lit("")))


def export_observations(df: DataFrame, path: str, partition_by: list[str] | None = None) -> dict:
    """S12 + P13 + P15 + P16: write typed observations with per-column vocabulary metadata.

    Numbers are encoded with the fill value, text with ``''``; the attributes
    travel in ``StructField.metadata`` (kept by Parquet). Returns the column
    plan (O(columns), driver side).
    """
    voc = {i: row for i, row in enumerate(fixed.VOCABULARY)}
    cols, plan = [], {}
    keys = set(partition_by or [])
    for f in df.schema.fields:
        name = f.name
        if name in keys:
            cols.append(F.col(name))
            continue
        lname = name.lower().replace(" ", "_")
        numeric = isinstance(f.dataType, T.NumericType)
        hit = next((i for i, row in voc.items() if row[0] in lname), None) if numeric else None
        md = {"long_name": name}
        if hit is not None:
            key, sn, ln, units, vmin, vmax, axis, positive, comment = voc[hit]
            md |= {k: v for k, v in dict(standard_name=sn, long_name=ln, units=units, valid_min=vmin, valid_max=vmax,
                                          axis=axis, positive=positive, comment=comment).items() if v is not None}
            if vmin is not None and vmax is not None:
                md["valid_range"] = [float(vmin), float(vmax)]
        if numeric:
            md["_FillValue"] = fixed.FILL_NUMBER
            cols.append(fill_number(F.col(name)).alias(name, metadata=md))
        else:
            cols.append(fill_text(F.col(name)).alias(name, metadata=md))
        plan[name] = md.get("standard_name", "")
    w = df.select(*cols).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return plan


def verify_export(spark: SparkSession, source: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows written per file against rows read back; a missing or empty output fails."""
    src = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_source"))
    back = spark.read.parquet(path).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_written"))
    j = src.join(back, on=keys, how="left")
    return j.select(*keys, "rows_source", F.coalesce(F.col("rows_written"), F.lit(0)).alias("rows_written"),
                    (F.coalesce(F.col("rows_written"), F.lit(0)) == F.col("rows_source")).alias("ok"))


class ExportFailed(RuntimeError):
    """Some output of an export is missing, empty or short."""


def raise_if_failed(verified: DataFrame, keys: list[str], shown: int = 20) -> None:
    """Raise :class:`ExportFailed` if any output of :func:`verify_export` is not ``ok``; the message names ``shown`` of them."""
    bad = verified.where("NOT ok")
    some = bad.orderBy(*keys).limit(shown).collect()
    if some:
        text = "; ".join(f"{', '.join(str(r[k]) for k in keys)}: {r['rows_written']} of {r['rows_source']} rows" for r in some)
        raise ExportFailed(f"{bad.count()} outputs failed: {text}")


def column_attributes(spark: SparkSession, path: str) -> DataFrame:
    """S12 read back: ``(column, attribute, value)`` of the columns of a written export, lists as JSON. O(columns)."""
    import json

    rows = [(f.name, k, v if isinstance(v, str) else json.dumps(v))
            for f in spark.read.parquet(path).schema.fields for k, v in (f.metadata or {}).items()]
    return spark.createDataFrame(rows, "column string, attribute string, value string")


def global_attributes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """P13 + A16 as rows ``keys + (attribute, value)``: every other column of ``rows`` that is not null."""
    names = [c for c in rows.columns if c not in keys]
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in names])
    return rows.select(*keys, F.explode(pairs).alias("a")).select(*keys, "a.*").where("value IS NOT NULL")


# --- Fixed values: global attributes written with every export --------------
GLOBAL_ATTRIBUTE_DEFAULTS = {
    "Conventions": "CF-1.8, ACDD-1.3",
    "title": "Untitled Dataset",
    "summary": "",
    "id": "",
    "naming_authority": "",
    "source": "in-situ observations",
    "processing_level": "quality-controlled",
    "creator_type": "person",
    "publisher_name": "Scientific Data Repository",
    "publisher_url": "",
    "publisher_type": "institution",
    "product_version": "1.0.0",
    "featureType": "profile",
    "cdm_data_type": "Profile",
    "license": "CC-BY-4.0",
    "keywords_vocabulary": "GCMD Science Keywords",
}


def dataset_attributes(rows: DataFrame) -> DataFrame:
    """P13 + J1: one flat attribute row per dataset, configured values or defaults.

    Input columns (optional): ``title, abstract, doi, naming_authority, organisation, contact_name,
    contact_email, publisher_name, publisher_url, project, version,
    license_name, theme_keywords, place_keywords``. Clock values (creation and
    history stamps) are left to the writer, never part of compared output.
    """
    from tidepool.operators.records import keywords_text

    cols = set(rows.columns)
    d = GLOBAL_ATTRIBUTE_DEFAULTS

    def cfg(name, default):
        v = F.col(name).cast("string") if name in cols else F.lit(None).cast("string")
        return F.coalesce(v, F.lit(default))

    theme = F.col("theme_keywords") if "theme_keywords" in cols else F.lit(None).cast("array<string>")
    place = F.col("place_keywords") if "place_keywords" in cols else F.lit(None).cast("array<string>")
    kw = keywords_text(theme, place)
    return rows.select(
        "dataset_id",
        F.lit(d["Conventions"]).alias("Conventions"),
        cfg("title", d["title"]).alias("title"),
        cfg("abstract", d["summary"]).alias("summary"),
        cfg("doi", d["id"]).alias("id"),
        cfg("naming_authority", d["naming_authority"]).alias("naming_authority"),
        F.lit(d["source"]).alias("source"),
        F.lit(d["processing_level"]).alias("processing_level"),
        cfg("organisation", "").alias("institution"),
        cfg("contact_name", "").alias("creator_name"),
        cfg("contact_email", "").alias("creator_email"),
        F.lit(d["creator_type"]).alias("creator_type"),
        cfg("publisher_name", d["publisher_name"]).alias("publisher_name"),
        cfg("publisher_url", d["publisher_url"]).alias("publisher_url"),
        F.lit(d["publisher_type"]).alias("publisher_type"),
        cfg("project", "").alias("project"),
        cfg("version", d["product_version"]).alias("product_version"),
        F.lit(d["featureType"]).alias("featureType"),
        F.lit(d["cdm_data_type"]).alias("cdm_data_type"),
        cfg("license_name", d["license"]).alias("license"),
        kw.alias("keywords"),
        F.when(kw.isNotNull(), F.lit(d["keywords_vocabulary"])).alias("keywords_vocabulary"),
    )
