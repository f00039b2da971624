"""The older flat form of the jobs, and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.fixtures import ctes, frame
from checks.registry import query
from streetloom.functions import address, similarity, text
from streetloom.operators import cleaning, geocode, tables
from streetloom.plans import older

_RAW = """select ordinal, url, name, street, locality, postal_code as "postalCode", region, country, po_box as "postOfficeBoxNumber" from d11"""
RAW = ctes("d11", raw=_RAW)


def rows(spark, sf):
    return frame(spark, sf, "d11").withColumnsRenamed(
        {"postal_code": "postalCode", "po_box": "postOfficeBoxNumber"}
    )


def one_column(name: str, column: str, function, oracle: str):
    """A query that applies one text function to one column of the flat rows."""

    @query(name, RAW + f"select ordinal, {oracle} as result from raw")
    def run(spark, sf):
        return rows(spark, sf).select("ordinal", function(F.col(column)).alias("result"))


_SLASH = "replace(name, chr(92) || '/', '/')"
_ESCAPE = "replace({}, chr(92) || 'u00e9', 'é')"
_ENTITY = "replace(replace({}, '&amp;', '&'), '&#038;', '&')"

one_column("unescape_slashes", "name", text.unescape_slashes, _SLASH)
one_column("unicode_unescape", "name", text.unicode_unescape, _ESCAPE.format("name"))
one_column("html_unescape", "name", text.html_unescape, _ENTITY.format("name"))
one_column("blank_to_null", "name", text.blank_to_null, "case when trim(name) <> '' then name end")
one_column(
    "whitespace_clean",
    "street",
    text.clean_whitespace,
    "nullif(trim(replace(street, chr(10), ' ')), '')",
)
one_column(
    "collapse_first_space",
    "street",
    text.collapse_first_space,
    r"regexp_replace(replace(street, chr(10), ' '), '^(\S*)\s+', '\1 ')",
)
one_column("url_netloc", "url", address.url_netloc, "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)")


@query(
    "clean_strings",
    RAW
    + f"""select ordinal, nullif(trim(replace({_ENTITY.format(_ESCAPE.format(_SLASH))}, chr(10), ' ')), '') as name,
 nullif(trim(replace(street, chr(10), ' ')), '') as street from raw""",
)
def clean_strings(spark, sf):
    return cleaning.clean_strings(rows(spark, sf).select("ordinal", "name", "street"), ["name", "street"])


@query("url_netloc_pages", "select page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as netloc from pages")
def url_netloc_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return pages.select("page_id", address.url_netloc(F.col("url")).alias("netloc"))


@query(
    "require_alnum",
    RAW + r"select ordinal, street, locality from raw where regexp_matches(street, '[\p{L}\p{N}]') and regexp_matches(locality, '[\p{L}\p{N}]')",
)
def require_alnum(spark, sf):
    usable = text.has_alnum(F.col("street")) & text.has_alnum(F.col("locality"))
    return rows(spark, sf).where(usable).select("ordinal", "street", "locality")


_KEYS = 'name, street, locality, "postalCode", region, country'


@query(
    "dedupe_keep_first",
    RAW + f"select {_KEYS}, arg_min(url, ordinal) as url, min(ordinal) as ordinal from raw group by all",
)
def dedupe_keep_first(spark, sf):
    return tables.dedupe_keep_first(
        rows(spark, sf).drop("postOfficeBoxNumber"), ignore=["url"], order=["ordinal"]
    )


def _clean(c: str) -> str:
    plain = f"replace({c}, chr(92) || '/', '/')"
    full = _ENTITY.format(_ESCAPE.format(plain))
    blank = f"case when trim({full}) <> '' then {full} end"
    return rf"regexp_replace(replace({blank}, chr(10), ' '), '^(\S*)\s+', '\1 ')"


_CLEANED = (
    "select ordinal, url, "
    + ", ".join(f"{_clean(c)} as {c}" for c in _KEYS.split(", "))
    + r" from raw where regexp_matches(street, '[\p{L}\p{N}]') and regexp_matches(locality, '[\p{L}\p{N}]')"
)
_CLEAN = f"select {_KEYS}, arg_min(url, ordinal) as url, min(ordinal) as ordinal from cleaned group by all"
CLEAN = ctes("d11", raw=_RAW, cleaned=_CLEANED, clean=_CLEAN)


@query("legacy_clean", CLEAN + "select * from clean")
def legacy_clean(spark, sf):
    return older.clean_rows(rows(spark, sf), ["ordinal"])


@query(
    "clean_counts",
    CLEAN + """select 'clean:count_before' as stage, count(*) as "rows" from raw union all select 'clean:count_after', count(*) from clean""",
)
def clean_counts(spark, sf):
    return older.clean_counts(rows(spark, sf), ["ordinal"])


@query(
    "address_hash",
    RAW + """select ordinal, md5(concat_ws(',', name, street, locality, "postalCode", country, region)) as hash from raw""",
)
def address_hash(spark, sf):
    return rows(spark, sf).select("ordinal", address.address_key(*map(F.col, older.KEY_COLUMNS)).alias("hash"))


@query(
    "address_text",
    RAW + """select ordinal, concat_ws(chr(10), coalesce(name, 'None'), coalesce(street, 'None'),
 coalesce(locality, 'None') || ', ' || coalesce("postalCode", 'None'), coalesce(region, 'None'), coalesce(country, 'None')) as address from raw""",
)
def address_text(spark, sf):
    parts = ["name", "street", "locality", "postalCode", "region", "country"]
    return rows(spark, sf).select("ordinal", address.address_text(*map(F.col, parts)).alias("address"))


@query(
    "flatten_lists",
    RAW + """select ordinal, unnest([name, street]) as value from raw""",
)
def flatten_lists(spark, sf):
    parts = F.array(F.struct(F.col("name").alias("value")), F.struct(F.col("street").alias("value")))
    listed = rows(spark, sf).select("ordinal", parts.alias("parts"))
    return older.flatten_lists(listed, "parts")


@query("select_existing", RAW + """select name, street, "postalCode", locality, country, region, url from raw""")
def select_existing(spark, sf):
    return tables.select_existing(rows(spark, sf), older.KEPT_COLUMNS)


# ---- look-up answers -------------------------------------------------------------------

_PARTS = [
    "house_number", "road", "postcode", "country", "country_code", "city", "town", "village",
    "county", "state", "state_district",
]
_ADDRESSES = """select row_id as join_index, concat('https://example.org/', cast(row_id as varchar)) as url, name,
 road || coalesce(' ' || house_number, '') as street, locality, postcode as "postalCode", region,
 case when row_id % 3 = 0 then country_code else country end as country from d2"""
_ANSWERS = (
    'select join_index, osm_id as "osm:osm_id", osm_type as "osm:osm_type", lat as "osm:lat", lon as "osm:lon", '
    'name as "osm:name", place_rank as "osm:place_rank", wikidata, '
    + ", ".join(f'{p} as "osm:address:{p}"' for p in _PARTS)
    + " from d12"
)
ANSWERS = ctes("d2", "d12", addresses=_ADDRESSES, answers=_ANSWERS)


def addresses(spark, sf):
    d2 = frame(spark, sf, "d2")
    return d2.select(
        F.col("row_id").alias("join_index"),
        F.concat(F.lit("https://example.org/"), "row_id").alias("url"),
        "name",
        F.concat("road", F.coalesce(F.concat(F.lit(" "), "house_number"), F.lit(""))).alias("street"),
        "locality",
        F.col("postcode").alias("postalCode"),
        "region",
        F.when(F.col("row_id") % 3 == 0, F.col("country_code")).otherwise(F.col("country")).alias("country"),
    )


def answers(spark, sf):
    return frame(spark, sf, "d12").select(
        "join_index", "osm_id", "osm_type", "lat", "lon", "name", "place_rank",
        F.struct("wikidata").alias("extratags"),
        F.struct(*_PARTS).alias("address"),
    )


@query("prefix_columns", ANSWERS + "select * from answers")
def prefix_columns(spark, sf):
    prefixed = geocode.prefix_answers(answers(spark, sf))
    return prefixed.withColumn("wikidata", F.col("`osm:extratags`.wikidata")).drop("osm:extratags")


@query("join_by_index", ANSWERS + "select a.*, o.* exclude (join_index) from addresses a join answers o on a.join_index = o.join_index")
def join_by_index(spark, sf):
    joined = geocode.join_by_index(addresses(spark, sf), answers(spark, sf))
    return joined.withColumn("wikidata", F.col("`osm:extratags`.wikidata")).drop("osm:extratags")


@query(
    "wikidata_url",
    ctes("d12") + """select join_index, 'https://www.wikidata.org/wiki/' || wikidata as "osm:wikidata" from d12""",
)
def wikidata_url(spark, sf):
    prefixed = geocode.prefix_answers(answers(spark, sf)).select("join_index", "osm:extratags")
    return older.unpack_wikidata(prefixed)


@query(
    "typed_columns",
    ctes("d12") + """select join_index, osm_type as "osm:osm_type", cast(lat as double) as "osm:lat", cast(lon as double) as "osm:lon" from d12""",
)
def typed_columns(spark, sf):
    prefixed = geocode.prefix_answers(answers(spark, sf))
    return older.typed_columns(prefixed.select("join_index", "osm:osm_type", "osm:lat", "osm:lon"))


def _nearest(q: str, candidates: list[str]) -> str:
    options = f"list_filter([{', '.join(candidates)}], lambda c: c is not null)"
    scored = f"list_transform({options}, lambda c, i: {{'d': damerau_levenshtein({q}, c), 'i': i, 'c': c}})"
    return f"case when {q} is null then {options}[1] else list_min({scored}).c end"


def _nearest_of(q: str, preferred: list[str], backup: list[str]) -> str:
    return f"coalesce(nullif({_nearest(q, preferred)}, ''), {_nearest(q, backup)})"


@query(
    "nearest_candidate",
    ctes("d8") + f"select row_id, locality, {_nearest_of('locality', ['city', 'town'], ['village', 'county'])} as nearest from d8",
)
def nearest_candidate(spark, sf):
    near = similarity.nearest_candidate(
        F.col("locality"), [F.col("city"), F.col("town")], [F.col("village"), F.col("county")]
    )
    return frame(spark, sf, "d8").select("row_id", "locality", near.alias("nearest"))


_KEPT = [
    "name", "osm:name", "street", "osm:address:house_number", "osm:address:road", "postalCode",
    "osm:address:postcode", "locality", "osm:address:city", "osm:address:town",
    "osm:address:village", "country", "osm:address:country", "osm:address:country_code", "region",
    "osm:address:state", "osm:address:county", "osm:address:state_district", "url", "osm:osm_id",
    "osm:osm_type", "osm:place_rank", "osm:lat", "osm:lon",
]
_CHANGED = {
    "osm:name": """nullif("osm:name", '')""",
    "osm:lat": 'cast("osm:lat" as double)',
    "osm:lon": 'cast("osm:lon" as double)',
}


def _quoted(*names: str) -> list[str]:
    return [f'"osm:address:{n}"' for n in names]


@query(
    "align_validated",
    ctes("d2", "d12", addresses=_ADDRESSES, answers=_ANSWERS,
         joined="select a.*, o.* exclude (join_index) from addresses a join answers o on a.join_index = o.join_index")
    + "select "
    + ", ".join(f'{_CHANGED.get(c, chr(34) + c + chr(34))} as "{c}"' for c in _KEPT)
    + f""", md5(concat_ws(',', name, street, locality, "postalCode", country, region)) as hash,
 'https://www.wikidata.org/wiki/' || wikidata as "osm:wikidata",
 {sql.road('street')} as "parsed:road", {sql.house('street')} as "parsed:house_number",
 {sql.country_code('country')} as country_code,
 {_nearest_of('locality', _quoted('city', 'town'), _quoted('village', 'county'))} as "clean:locality",
 {_nearest_of('region', _quoted('state'), _quoted('county', 'state_district'))} as "clean:region"
from joined where "osm:osm_id" is not null""",
)
def align_validated(spark, sf):
    return older.align_validated(geocode.join_by_index(addresses(spark, sf), answers(spark, sf)))
