"""Fixed values that must equal the reference's for results to agree.

They are stated once, in natural order, as plain data. Everything else in the
library derives from them with DataFrame expressions.
"""

from __future__ import annotations

# --- Fixed values: column-role keywords (substring, lower case) -------------
TIME_KEYWORDS_TRANSFORM = ("date", "time", "timestamp")
TIME_KEYWORDS_PROFILE = ("date", "time", "timestamp", "datetime")
TIME_KEYWORDS_EXPORT = ("date", "time")
LAT_KEYWORD = "lat"
LON_KEYWORD = "lon"
DEPTH_KEYWORD = "depth"

# --- Fixed values: text tokens read as missing by a default CSV reader ------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- Fixed values: year bounds for a plausible time column ------------------
MIN_PLAUSIBLE_YEAR = 1900
MAX_PLAUSIBLE_YEAR = 2100

# --- Fixed values: quality grade thresholds ----------------------------------
# (grade, min completeness %, max duplicate % (exclusive, None = must be 0),
#  max outlier % of cells (exclusive, None = no limit))
GRADE_RULES = (
    ("A", 98.0, 0.0, 1.0),
    ("B", 95.0, 1.0, 3.0),
    ("C", 90.0, 5.0, None),
)
NOTE_COMPLETENESS_BELOW = 95.0
NOTE_OUTLIERS_ABOVE_PCT = 2.0
OUTLIER_IQR_FACTOR = 1.5
LARGE_GAP_FACTOR = 3.0

# --- Fixed values: standard vocabulary, matched by substring in map order ----
# (key, standard_name, long_name, units, valid_min, valid_max, axis, positive, comment)
VOCABULARY = (
    ("temperature", "sea_water_temperature", "Sea Water Temperature", "degree_Celsius", -2.0, 40.0, None, None, None),
    ("salinity", "sea_water_practical_salinity", "Sea Water Practical Salinity", "1", 0.0, 42.0, None, None,
     "Practical salinity on PSS-78 scale"),
    ("dissolved_oxygen", "mass_concentration_of_oxygen_in_sea_water", "Dissolved Oxygen Concentration", "mg L-1",
     0.0, 15.0, None, None, None),
    ("ph", "sea_water_ph_reported_on_total_scale", "Sea Water pH (Total Scale)", "1", 7.0, 9.0, None, None, None),
    ("total_alkalinity", "sea_water_alkalinity_expressed_as_mole_equivalent", "Total Alkalinity", "umol kg-1",
     2000.0, 2600.0, None, None, None),
    ("no3", "mole_concentration_of_nitrate_in_sea_water", "Nitrate Concentration", "umol L-1", 0.0, 50.0,
     None, None, None),
    ("po4", "mole_concentration_of_phosphate_in_sea_water", "Phosphate Concentration", "umol L-1", 0.0, 5.0,
     None, None, None),
    ("depth", "depth", "Depth Below Sea Surface", "m", 0.0, 11000.0, "Z", "down", None),
    ("latitude", "latitude", "Latitude", "degrees_north", -90.0, 90.0, "Y", None, None),
    ("longitude", "longitude", "Longitude", "degrees_east", -180.0, 180.0, "X", None, None),
)

# --- Fixed values: roles of archive paths, by prefix ------------------------
ROLES = (
    ("raw/", "raw_data"),
    ("processed/", "processed_data"),
    ("metadata/", "metadata"),
    ("docs/", "documentation"),
    ("logs/", "provenance"),
)
OTHER_ROLE = "other"
CHECKSUM_DIRS = ("raw", "processed", "metadata", "docs")
SKIP_FILES = ("checksums.sha256", "manifest.json", "FAIR_AUDIT.md")
PACKAGE_DIRS = ("raw", "processed", "metadata", "docs", "logs")

# --- Fixed values: what a metadata record says where the configuration is silent ---
RECORD_DEFAULTS = {
    "file_identifier": "PENDING",
    "language": "eng",
    "character_set": "utf8",
    "hierarchy_level": "dataset",
    "title": "Untitled Dataset",
    "abstract": "",
    "purpose": "Archive-ready dataset prepared for scientific data repository submission.",
    "topic_category": "oceans",
    "progress": "completed",
    "contact_role": "principalInvestigator",
    "crs": "EPSG:4326",
    "distribution_name": "Scientific Data Repository",
}

# --- Fixed values: MIME type by file extension (common subset) --------------
MIME_TYPES = (
    ("csv", "text/csv"),
    ("json", "application/json"),
    ("xml", "application/xml"),
    ("txt", "text/plain"),
    ("md", "text/markdown"),
    ("html", "text/html"),
    ("htm", "text/html"),
    ("nc", "application/x-netcdf"),
    ("xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    ("xls", "application/vnd.ms-excel"),
    ("pdf", "application/pdf"),
    ("zip", "application/zip"),
    ("tar", "application/x-tar"),
    ("tgz", "application/x-tar"),
)
# Suffixes of compression: the type is that of what is compressed.
COMPRESSIONS = ("gz", "bz2", "xz", "br", "Z")
DEFAULT_DATA_MIME = "application/octet-stream"
DEFAULT_LOG_MIME = "text/plain"

# --- Fixed values: findability / access / interoperability / reuse rules ----
# (id, letter, name, description)
AUDIT_RULES = (
    ("F1", "Findable", "Globally unique identifier", "Dataset has a DOI or persistent identifier"),
    ("F2", "Findable", "Rich metadata", "ISO 19115-2 XML metadata file exists"),
    ("F3", "Findable", "Metadata includes identifier", "Metadata XML contains the dataset identifier"),
    ("F4", "Findable", "Registered in searchable resource", "Package structured for repository submission"),
    ("A1", "Accessible", "Retrievable by identifier", "Distribution/access information documented"),
    ("A1.1", "Accessible", "Open protocol", "Access via HTTPS (open, free, universal)"),
    ("A1.2", "Accessible", "Auth where necessary", "Access constraints documented if applicable"),
    ("A2", "Accessible", "Metadata persistence", "Metadata is self-contained and persists independently"),
    ("I1", "Interoperable", "Formal shared language", "Data in standard formats (CSV, NetCDF)"),
    ("I2", "Interoperable", "FAIR vocabularies", "Uses controlled vocabularies (GCMD, CF conventions)"),
    ("I3", "Interoperable", "Qualified references", "References to related datasets or publications"),
    ("R1", "Reusable", "Plurality of attributes", "Data described with multiple relevant attributes"),
    ("R1.1", "Reusable", "Clear license", "Data released under a clear, accessible license"),
    ("R1.2", "Reusable", "Detailed provenance", "Processing log and transformation provenance present"),
    ("R1.3", "Reusable", "Community standards", "Meets ISO 19115-2 and domain standards"),
)
# Markers looked for in the metadata text by the rules above
AUDIT_MARKERS = {
    "identifier": "fileIdentifier",
    "distribution": "distributionInfo",
    "constraints": "resourceConstraints",
    "keywords": "descriptiveKeywords",
    "citation": "citation",
    "rich": ("title", "abstract", "keyword", "extent"),
    "standard": "19115",
}
PENDING_DOI = "PENDING"
STANDALONE_METADATA_MIN_BYTES = 500
STANDARD_EXTENSIONS = (".csv", ".nc", ".netcdf", ".json")

# --- Fixed values: artefacts a finished package must hold -------------------
REQUIRED_ARTEFACTS = (
    ("raw", "Raw data directory"),
    ("processed", "Processed data directory"),
    ("metadata/iso19115-2.xml", "ISO 19115-2 metadata"),
    ("logs/validation_report.json", "Validation report"),
)
METADATA_PATH = "metadata/iso19115-2.xml"
PROVENANCE_PATH = "logs/provenance.jsonl"

# --- Fixed values: elements a metadata record must contain ------------------
REQUIRED_ELEMENTS = ("fileIdentifier", "contact", "dateStamp", "identificationInfo")

# --- Fixed values: output formats --------------------------------------------
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_DATE = "yyyy-MM-dd"
FILL_NUMBER = -999.0
FILL_TEXT = ""
SUMMARY_DETAIL_CHARS = 100
