"""Values a run depends on. All of them can be passed to the jobs as parameters instead."""

# --- Fixed values: they must match the feed, the taxonomy and the published documents ---

# Requirement weights: from 10 a requirement is a must; a nice-to-have counts as 5.
MUST_HAVE_WEIGHT = 10
NICE_TO_HAVE_WEIGHT = 5

# Phrases that mark an ad as open to remote work, compared in lower case.
REMOTE_PHRASES = [
    "arbeta på distans",
    "arbete på distans",
    "jobba på distans",
    "arbeta hemifrån",
    "arbetar hemifrån",
    "jobba hemifrån",
    "jobb hemifrån",
    "remote work",
    "jobba tryggt hemifrån",
]

# Working-hours concepts that imply a scope of work.
FULL_TIME_CONCEPTS = ["6YE1_gAC_R2G"]
PART_TIME_CONCEPTS = ["947z_JGS_Uk2", "hGCt_6Ni_XPz"]

# Country used when an address names none.
DEFAULT_COUNTRY_CODE = "199"
DEFAULT_COUNTRY_CONCEPT = "i46j_HmG_v64"
DEFAULT_COUNTRY_NAME = "Sverige"

# Contact type shown for a union representative.
UNION_CONTACT_TYPE = "Facklig representant"

# Least prediction a candidate needs, per source type.
CANDIDATE_THRESHOLDS = {
    "occupations": 0.8,
    "competencies": 0.5,
    "geos": 0.7,
    "traits": 0.5,
}
# Source types whose candidates are also kept when they stand in the headline (sentence 0).
HEADLINE_TYPES = ["occupations", "geos"]
# Source type -> name of the keyword list in the published document.
KEYWORD_LISTS = {
    "occupations": "occupation",
    "competencies": "skill",
    "traits": "trait",
    "geos": "location",
}
# Lists joined into the compound list, in this order.
COMPOUND_LISTS = ["occupation", "skill", "location"]

# Character handling before tokens are cut: removed characters, and those turned into a space.
TOKEN_DROP_CHARS = ".:!"
TOKEN_SPACE_CHARS = ", "
# Gram lengths.
WORD_GRAMS = (3, 30)
LABEL_GRAMS = (1, 10)
SHINGLE_SIZES = (2, 3)
# Longest keyword kept in the exact-match column.
KEYWORD_MAX_LENGTH = 256

# Null defaults of the view over removed ads: such a row passes any date filter.
REMOVED_FROM_DATE = "1970-01-01"
REMOVED_TO_DATE = "2100-12-31"

# A new snapshot must hold at least this share of the live ads of the current one.
NEW_SNAPSHOT_SHARE = 0.8

# Names of published views, by suffix.
READ_SUFFIX = "_read"
WRITE_SUFFIX = "_write"
STREAM_SUFFIX = "_stream"
DELETED_SUFFIX = "_deleted"

# Slot of a raw ad -> taxonomy type its coded value is looked up under.
SLOT_TYPES = {
    "yrkesroll": "occupation-name",
    "kompetens": "skill",
    "sprak": "language",
    "anstallningstyp": "employment-type",
    "lonetyp": "wage-type",
    "varaktighet": "employment-duration",
    "arbetstidstyp": "worktime-extent",
    "korkort": "driving-licence",
    "kommun": "municipality",
    "lan": "region",
    "land": "country",
    "utbildningsinriktning": "sun-education-field",
    "utbildningsniva": "sun-education-level",
}
# Families looked up over three levels at once; the lowest level that knows the id answers.
TYPE_FAMILIES = {
    "sun-education-field": [
        "sun-education-field-1", "sun-education-field-2", "sun-education-field-3"],
    "sun-education-level": [
        "sun-education-level-1", "sun-education-level-2", "sun-education-level-3"],
}

# Zone in which feed times are shown as local dates.
LOCAL_ZONE = "Europe/Stockholm"

# --- Tuning ---

# Batches of a table after which an import folds them into a new base.
FOLD_AFTER = 48

# Largest size, planned and in memory, of a side that may be sent to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes of files from which one task counts words or grams per document.
SLICE_BYTES = 512 * 1024
# Files below this size are not asked for their number of rows.
UNCOUNTED_BYTES = 256 * 1024
# Buckets of ids that landed bodies are kept in, per day. A landing folder has one number for good.
BODY_BUCKETS = 64
# Largest table of codes, in memory, that goes to the ads as one value.
IN_PLACE_BYTES = 64 * 1024 * 1024
# A key with this share of the rows is joined apart from the others where no side fits above.
HOT_KEY_SHARE = 0.005
# Left sides planned below this size are not searched for hot keys: one task can hold any of them.
SKEW_CHECK_BYTES = 1024 * 1024 * 1024
