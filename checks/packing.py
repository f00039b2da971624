"""From triples to the published data set."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.fixtures import ctes, frame, triples
from checks.registry import query
from streetloom import scratch_path
from streetloom.functions import address
from streetloom.operators import pairs, tables
from streetloom.plans import pack
from streetloom.schemas import PAIR_COLUMNS, TARGET_COLUMNS
from streetloom.sources import distinct, files

_FLAT = """select row_id, cast(row_id % 4 as varchar) as section, q_name as name, q_street as street, q_city as city, q_state as state,
 q_country as country, q_postalcode as postalcode, t_name as target_name, t_street as target_street,
 t_housenumber as target_house, t_city as target_city, t_state as target_state, t_country as target_country,
 t_postcode as target_postalcode, t_country_code as target_countrycode from d7 where has_osm"""
_PACKED = f"""select row_id, section, name, {sql.road('street')} as street, {sql.house('street')} as house, city, postalcode,
 state, country, {sql.country_code('country')} as countrycode, {', '.join(TARGET_COLUMNS)}
from flat where street is not null or city is not null or postalcode is not null"""
_ALL = ", ".join([*PAIR_COLUMNS, *TARGET_COLUMNS])
_KNOWN = " and ".join(f"{c} is not null" for c in TARGET_COLUMNS)
_DATASET = f"select distinct {_ALL} from packed where {_KNOWN}"
_NUMBERED = (
    "select row_number() over (order by md5(concat_ws(chr(31), "
    + ", ".join(f"coalesce('=' || {c}, '-')" for c in [*PAIR_COLUMNS, *TARGET_COLUMNS])
    + f"))) - 1 as row_id, {_ALL} from dataset"
)
FLAT = ctes("d7", flat=_FLAT)
PACKED = ctes("d7", flat=_FLAT, packed=_PACKED)
DATASET = ctes("d7", flat=_FLAT, packed=_PACKED, dataset=_DATASET, numbered=_NUMBERED)


@query("flatten_pairs", FLAT + "select * from flat")
def flatten_pairs(spark, sf):
    return pairs.flatten_pairs(triples(spark, sf))


@query(
    "any_key_present",
    FLAT + "select * from flat where street is not null or city is not null or postalcode is not null",
)
def any_key_present(spark, sf):
    return pairs.any_key_present(flatten_pairs(spark, sf))


@query(
    "split_street",
    FLAT + f"select row_id, section, {sql.road('street')} as road, {sql.house('street')} as house from flat",
)
def split_street(spark, sf):
    parts = address.split_street(F.col("street"))
    return flatten_pairs(spark, sf).select("row_id", "section", parts.alias("p")).select(
        "row_id", "section", "p.road", "p.house"
    )


@query(
    "country_code",
    FLAT + f"select row_id, country, {sql.country_code('country')} as countrycode from flat",
)
def country_code(spark, sf):
    return pairs.add_country_code(flatten_pairs(spark, sf)).select("row_id", "country", "countrycode")


@query("pack_sections", PACKED + f"select distinct section, {_ALL} from packed")
def pack_sections(spark, sf):
    where = scratch_path(spark, "sections")
    files.write_sections(pack.pack_sections(triples(spark, sf).drop("row_id")), where)
    return files.read_sections(spark, where)


@query("pack_dataset", DATASET + "select * from dataset")
def pack_dataset(spark, sf):
    where = scratch_path(spark, "dataset")
    files.write_dataset(pack.pack_dataset(triples(spark, sf)), where)
    return files.read_dataset(spark, where)


@query("pack_incremental", DATASET + f"select row_id, {_ALL} from numbered")
def pack_incremental(spark, sf):
    """Two runs, the second over all triples: only what the first had not is added."""
    pool, found = scratch_path(spark, "pool"), triples(spark, sf)
    distinct.create(spark, pool, 8)
    for part in (found.where("row_id % 3 > 0"), found):
        pack.extend(spark, part, pool)
    return pack.pool_dataset(spark, pool)


def numbered(spark, sf):
    return tables.with_row_id(pack.pack_dataset(triples(spark, sf)))


@query("export_values", DATASET + f"select row_id, {', '.join(PAIR_COLUMNS)} from numbered")
def export_values(spark, sf):
    where = scratch_path(spark, "values")
    files.write_csv(pairs.value_table(numbered(spark, sf)), where)
    return files.read_csv(spark, where, PAIR_COLUMNS)


@query(
    "export_targets",
    DATASET + "select row_id, " + ", ".join(f"target_{c} as {c}" for c in PAIR_COLUMNS) + " from numbered",
)
def export_targets(spark, sf):
    where = scratch_path(spark, "targets")
    files.write_csv(pairs.target_table(numbered(spark, sf)), where)
    return files.read_csv(spark, where, PAIR_COLUMNS)


@query("dataset_variant_named", DATASET + f"select {_ALL} from numbered where row_id < 240")
def dataset_variant_named(spark, sf):
    packed = pairs.pack_pairs(triples(spark, sf).select("osm", "address_query"))
    return pack.dataset_variant(packed, named=True, size=240)


_FIRST_NAMES = {
    "name": "name", "house": "house_number", "street": "road", "postalcode": "postcode",
    "city": "locality", "state": "region", "country": "country", "countrycode": "country_code",
}
_FIRST = ", ".join(
    f"{p}{old} as {p}{new}" for p in ("", "target_") for old, new in _FIRST_NAMES.items()
)


def _sample(name, rows):
    @query(f"dataset_sample_{name}", DATASET + f"select {_FIRST} from numbered where row_id < {rows}")
    def sample(spark, sf):
        packed = pairs.pack_pairs(triples(spark, sf).select("osm", "address_query"))
        return pack.first_version(pack.dataset_variant(packed, size=name))

    return sample


dataset_sample_2k = _sample("2k", 2_400)
dataset_sample_24k = _sample("24k", 24_000)
dataset_sample_240k = _sample("240k", 240_000)


@query(
    "dataset_variant_noname",
    PACKED
    + f"select distinct {', '.join(c for c in [*PAIR_COLUMNS, *TARGET_COLUMNS] if 'name' not in c)} from packed where "
    + " and ".join(f"{c} is not null" for c in TARGET_COLUMNS if c != "target_name"),
)
def dataset_variant_noname(spark, sf):
    packed = pairs.pack_pairs(triples(spark, sf).select("osm", "address_query"))
    return pack.dataset_variant(packed, named=False)


@query(
    "row_index",
    ctes("d2")
    + "select row_id, country_code, row_number() over (partition by country_code order by row_id) - 1 as row_index from d2",
)
def row_index(spark, sf):
    numbered_rows = frame(spark, sf, "d2").select("row_id", "country_code")
    return tables.row_index(numbered_rows, "row_id", ["country_code"], width=100)
