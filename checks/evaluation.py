"""Error classes and repair measures."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from checks import sql
from checks.fixtures import COLUMNS, ctes, derived, frame
from checks.registry import query
from streetloom import scratch_path
from streetloom.functions import similarity
from streetloom.operators import errors, repair, tables
from streetloom.sources import files

CELLS = ctes("d1", "d2", cells=sql.cells())
CLASSED = ctes("d1", "d2", cells=sql.cells(), classed=sql.CLASSED)


def pairs(spark, sf):
    return errors.pair_join(frame(spark, sf, "d2"), frame(spark, sf, "d1"))


@query(
    "pair_join",
    ctes("d1", "d2")
    + "select d.*, "
    + ", ".join(f"t.{c} as true_{c}" for c in COLUMNS)
    + " from d2 d join d1 t on d.row_id = t.row_id",
)
def pair_join(spark, sf):
    return pairs(spark, sf)


@query(
    "error_classes",
    ctes("d1", "d2")
    + "select d.row_id, "
    + ", ".join(f"{sql.error_class(f'd.{c}', f't.{c}')} as {c}" for c in COLUMNS)
    + " from d2 d join d1 t on d.row_id = t.row_id",
)
def error_classes(spark, sf):
    return errors.error_classes(pairs(spark, sf))


# The usual abbreviations, and one word of its own for every customer.
_ALIAS_ROWS = " union all ".join(
    [f"select '{t}' as token, '{w}' as word" for t, words in sql.ALIASES.items() for w in words]
    + ["select concat('zz', cast(row_id as varchar(20))), concat('yy', cast(row_id as varchar(20))) from d1"]
)


@query("error_classes_table", CLASSED + "select row_id, column_name, errortype from classed")
def error_classes_table(spark, sf):
    return errors.cell_errors_by_table(pairs(spark, sf), derived(spark, sf, "d1", aliases=_ALIAS_ROWS))


@query(
    "error_counts_long",
    CLASSED + "select column_name, errortype, count(*) as len from classed group by all",
)
def error_counts_long(spark, sf):
    return errors.error_counts(errors.cell_errors(pairs(spark, sf)))


@query(
    "error_matrix",
    CLASSED
    + "select column_name, "
    + ", ".join(
        f"""count(*) filter (errortype = '{c}') as "{c}",
 count(*) filter (errortype = '{c}') / count(*) as "{c} share\""""
        for c in sql.CLASSES
    )
    + " from classed group by column_name",
)
def error_matrix(spark, sf):
    return errors.error_matrix(errors.cell_errors(pairs(spark, sf)))


@query(
    "error_type_totals",
    CLASSED
    + "select c.errortype, count(k.row_id) as total, "
    + "count(k.row_id) / (select count(*) from classed) as share from (values "
    + ", ".join(f"('{c}')" for c in sql.CLASSES)
    + ") c(errortype) left join classed k on k.errortype = c.errortype group by c.errortype",
)
def error_type_totals(spark, sf):
    return errors.error_type_totals(errors.cell_errors(pairs(spark, sf)))


@query(
    "field_match_counts",
    CLASSED
    + """select column_name as "column", count(*) filter (errortype = 'match') as "match",
 count(*) filter (errortype <> 'match') as mismatch,
 count(*) filter (errortype = 'match') / count(*) as match_percentage,
 count(*) filter (errortype <> 'match') / count(*) as mismatch_percentage
from classed group by column_name""",
)
def field_match_counts(spark, sf):
    return errors.field_match_counts(errors.cell_errors(pairs(spark, sf)))


@query(
    "cell_accuracy",
    CELLS
    + """select count(*) filter (value = truth) as correct_cells,
 count(*) - count(*) filter (value = truth) as error_cells, count(*) as total_cells,
 count(*) filter (value = truth) / count(*) as accuracy,
 1 - count(*) filter (value = truth) / count(*) as error_rate from cells""",
)
def cell_accuracy(spark, sf):
    return errors.cell_accuracy(pairs(spark, sf))


@query(
    "drilldown_error_class",
    CLASSED
    + """select row_id, value as road, truth as "target:road" from classed
where column_name = 'road' and errortype = 'synonym'""",
)
def drilldown_error_class(spark, sf):
    both = pairs(spark, sf)
    return errors.drilldown(both, errors.error_classes(both), "road", "synonym")


@query(
    "typo_pairs",
    CELLS
    + """select row_id, column_name, value, truth from cells
where value is not null and damerau_levenshtein(value, truth) between 1 and 2""",
)
def typo_pairs(spark, sf):
    near = similarity.within_two_edits(F.col("value"), F.col("truth"))
    return errors.cells(pairs(spark, sf)).where("value is not null and value <> truth").where(near)


@query(
    "token_subset",
    CELLS
    + f"""select row_id, column_name, value, truth from cells
where value is not null and {sql.subset('value', 'truth')}""",
)
def token_subset(spark, sf):
    inside = similarity.token_subset(F.col("value"), F.col("truth"))
    return errors.cells(pairs(spark, sf)).where("value is not null").where(inside)


@query(
    "lowercase_all",
    ctes("d2") + "select row_id, " + ", ".join(f"lower({c}) as {c}" for c in COLUMNS) + " from d2",
)
def lowercase_all(spark, sf):
    return tables.lowercase_all(frame(spark, sf, "d2"))


@query(
    "repair_table_normalise",
    ctes("d2")
    + "select row_id, "
    + ", ".join(f"nullif(coalesce({c}, '_nan_'), '_nan_') as {c}" for c in COLUMNS)
    + " from d2",
)
def repair_table_normalise(spark, sf):
    stored = frame(spark, sf, "d2").withColumn("_tid_", F.col("row_id"))
    return repair.normalise_repair_table(stored.na.fill("_nan_"))


def updates(spark, sf):
    return frame(spark, sf, "d6").selectExpr("ord", "row_no as row", "col_no as col", "value")


_LAST = """select row_no, col_no, arg_max(value, ord) as value from d6 group by all"""
_REPAIRED = "select d.row_id, " + ", ".join(
    f"case when u{i}.row_no is not null then u{i}.value else d.{c} end as {c}"
    if i in (2, 4)
    else f"d.{c}"
    for i, c in enumerate(COLUMNS)
) + """ from d2 d left join last u2 on u2.row_no = d.row_id and u2.col_no = 2
left join last u4 on u4.row_no = d.row_id and u4.col_no = 4"""
_TRIPLE_CELLS = " union all ".join(
    f"select d.row_id, '{c}' as column_name, d.{c} as dirty, r.{c} as repaired, t.{c} as truth "
    f"from d2 d join repaired r on r.row_id = d.row_id join d1 t on t.row_id = d.row_id"
    for c in COLUMNS
)
REPAIR = ctes("d1", "d2", "d6", last=_LAST, repaired=_REPAIRED, cells=_TRIPLE_CELLS)
_CHANGED = "coalesce(dirty, 'null') <> coalesce(repaired, 'null')"


@query(
    "cell_updates_last_wins",
    ctes("d6", last=_LAST) + """select row_no as "row", col_no as col, value from last""",
)
def cell_updates_last_wins(spark, sf):
    return repair.last_updates(updates(spark, sf))


@query(
    "cell_updates_json",
    ctes("d6") + """select row_no as "row", col_no as col, value,
 row_number() over (partition by row_no % 7 order by ord, col_no) - 1 as ord from d6""",
)
def cell_updates_json(spark, sf):
    """Seven files of one JSON list each, read by splits of a few hundred elements."""

    def as_list(batches):
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        comma = ""
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [comma + text]})
                comma = ","
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    element = F.to_json(F.struct(F.col("row_no").alias("row"), F.col("col_no").alias("col"), "value"))
    lists = frame(spark, sf, "d6").repartitionById(7, (F.col("row_no") % 7).cast("int"))
    lists = lists.sortWithinPartitions("ord", "col_no").select(element.alias("value"))
    where = scratch_path(spark, "cells")
    lists.mapInArrow(as_list, "value string").write.text(where)
    return files.read_cell_updates(spark, where).select("row", "col", "value", "ord")


@query("apply_cell_updates", REPAIR + "select * from repaired")
def apply_cell_updates(spark, sf):
    return repair.apply_cell_updates(frame(spark, sf, "d2"), updates(spark, sf))


def repaired_triples(spark, sf):
    return repair.repair_triples(
        frame(spark, sf, "d1"), frame(spark, sf, "d2"), apply_cell_updates(spark, sf)
    )


@query("changed_cells", REPAIR + f"select row_id, column_name, dirty, repaired, truth from cells where {_CHANGED}")
def changed_cells(spark, sf):
    return repair.changed_cells(repaired_triples(spark, sf))


_COUNTS = f"""count(*) filter ({_CHANGED}) as changed,
 count(*) filter ({_CHANGED} and repaired is not distinct from truth) as correct,
 count(*) filter (truth <> dirty) as errors,
 count(*) filter ({_CHANGED} and truth <> dirty) as changed_errors"""
_RATES = """correct / changed as "precision", changed_errors / errors as recall,
 2 * ((correct / changed) * (changed_errors / errors)) / (correct / changed + changed_errors / errors) as f1"""
_EDR_COUNTS = """count(*) filter (dirty <> truth or dirty is null or truth is null) as errors_before,
 count(*) filter (repaired <> truth or repaired is null or truth is null) as errors_after"""


@query(
    "repair_metrics",
    REPAIR + f"select *, {_RATES} from (select {_COUNTS} from cells)",
)
def repair_metrics(spark, sf):
    return repair.repair_metrics(repaired_triples(spark, sf))


@query(
    "repair_edr",
    REPAIR
    + f"select *, (errors_before - errors_after) / errors_before as edr from (select {_EDR_COUNTS} from cells)",
)
def repair_edr(spark, sf):
    return repair.error_distance(repaired_triples(spark, sf))


_TOOLS = " union all ".join(
    f"select 'updates' as tool, false as fold, d.row_id, d.{c} as dirty, r.{c} as repaired, t.{c} as truth "
    f"from d2 d join repaired r on r.row_id = d.row_id join d1 t on t.row_id = d.row_id "
    f"union all select 'folding', true, d.row_id, d.{c}, case when d.row_id % 2 = 0 then lower(t.{c}) else d.{c} end, t.{c} "
    f"from d2 d join d1 t on t.row_id = d.row_id"
    for c in COLUMNS
)
_FOLDED = """select tool, case when fold then lower(dirty) else dirty end as dirty,
 case when fold then lower(repaired) else repaired end as repaired,
 case when fold then lower(truth) else truth end as truth from tools"""


@query(
    "repair_report",
    ctes("d1", "d2", "d6", last=_LAST, repaired=_REPAIRED, tools=_TOOLS, folded=_FOLDED)
    + f"""select 'customers' as dataset, q.tool, "precision", recall, f1, edr from
(select tool, {_RATES} from (select tool, {_COUNTS} from folded group by tool)) q join
(select tool, (errors_before - errors_after) / errors_before as edr from (select tool, {_EDR_COUNTS} from tools group by tool)) e
on q.tool = e.tool""",
)
def repair_report(spark, sf):
    truth, dirty = frame(spark, sf, "d1"), frame(spark, sf, "d2")
    by_updates = apply_cell_updates(spark, sf).withColumn("tool", F.lit("updates"))
    both = errors.pair_join(dirty, truth)
    folding = both.select(
        "row_id",
        *[
            F.when(F.col("row_id") % 2 == 0, F.lower(f"true_{c}")).otherwise(F.col(c)).alias(c)
            for c in COLUMNS
        ],
        F.lit("folding").alias("tool"),
    )
    repairs = by_updates.unionByName(folding)
    return repair.repair_report(truth, dirty, repairs, "customers", ["folding"])


_BLANKED = "select row_id, case when row_id % 17 = 0 then '' when row_id % 17 = 1 then name || chr(10) || chr(92) || 'n' when row_id % 17 = 2 then chr(92) || 'N' else name end as name, " + ", ".join(
    COLUMNS[1:]
) + " from d2"


@query(
    "csv_pair_roundtrip",
    ctes("d1", "d2", blanked=_BLANKED)
    + "select d.*, "
    + ", ".join(f"t.{c} as true_{c}" for c in COLUMNS)
    + " from blanked d join d1 t on d.row_id = t.row_id",
)
def csv_pair_roundtrip(spark, sf):
    dirty = frame(spark, sf, "d2").withColumn(
        "name",
        F.when(F.col("row_id") % 17 == 0, "")
        .when(F.col("row_id") % 17 == 1, F.concat("name", F.lit("\n\\n")))
        .when(F.col("row_id") % 17 == 2, "\\N")
        .otherwise(F.col("name")),
    )
    where = scratch_path(spark, "csv")
    files.write_csv(dirty, f"{where}/values")
    files.write_csv(frame(spark, sf, "d1"), f"{where}/targets")
    return errors.pair_join(
        files.read_csv(spark, f"{where}/values", COLUMNS),
        files.read_csv(spark, f"{where}/targets", COLUMNS),
    )
