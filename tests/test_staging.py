from dataclasses import replace

from pyspark.sql import functions as F

from ratescope.config import PipelineConfig
from ratescope.operators.reshape import unpivot_payers, wide_groups
from ratescope.plans import staging
from ratescope.schemas import STAGED_RATE_COLUMNS
from ratescope.sources.pages import default_procedure_codes
from ratescope.sources.price_csv import read_price_csv
from ratescope.sources.price_json import price_json_items
from ratescope.workload import files
from tests import fixtures as fx

CFG = PipelineConfig()
ALL = replace(CFG, procedure_scope="all", silver_code_types=None)
PLAIN = [c for c in STAGED_RATE_COLUMNS if c not in ("source_key", "_source_file", "_run_id")]


def staged(spark, tmp_path, cfg):
    codes = default_procedure_codes(spark)
    run = F.lit("r")
    tall = read_price_csv(spark, [fx.write(tmp_path, "tall.csv", fx.TALL)])[1].withColumn("_run_id", run)
    wide = read_price_csv(spark, [fx.write(tmp_path, "wide.csv", fx.WIDE)])[1].withColumn("_run_id", run)
    items = price_json_items(spark, [fx.write(tmp_path, "p.json", fx.price_json())]).withColumn("_run_id", run)
    return (
        staging.stage_tall_csv(tall, codes, "tall", (1, 2), True, cfg),
        staging.stage_wide_csv(wide, codes, "wide", (1, 2), cfg),
        staging.stage_json_items(items, codes, "json", cfg),
    )


def rows(df, columns=PLAIN):
    return sorted(tuple(str(r[c]) for c in columns) for r in df.select(*columns).collect())


def test_layouts_agree(spark, tmp_path):
    tall, wide, nested = staged(spark, tmp_path, CFG)
    assert tall.columns == wide.columns == nested.columns == list(STAGED_RATE_COLUMNS)
    assert len(rows(tall)) == 4
    assert rows(tall) == rows(wide)
    # JSON has no modifiers and may state an estimated amount.
    shared = [c for c in PLAIN if c not in ("modifiers", "estimated_amount")]
    assert rows(tall, shared) == rows(nested, shared)
    assert [r["estimated_amount"] for r in nested.filter("payer_name = 'Gov'").collect()] == [3.0]


def test_values(spark, tmp_path):
    tall = staged(spark, tmp_path, CFG)[0]
    knee = tall.filter("code = '27447' and payer_name = 'Aetna'").first()
    assert (knee["item_codes"], knee["negotiated_dollar"], knee["procedure_label"]) == ("CDM:K1|CPT:27447", 20000.5, "KNEE")
    # A dollar text that is no number stays a line, without any rate.
    odd = tall.filter("payer_name = 'Gov'").first()
    assert (odd["negotiated_dollar"], odd["negotiated_percentage"], odd["negotiated_algorithm"]) == (None, None, None)
    assert tall.filter("code = '27130'").first()["modifiers"] == "52"


def test_scope_all_keeps_every_code(spark, tmp_path):
    tall, wide, nested = staged(spark, tmp_path, ALL)
    assert tall.count() == wide.count() == 10
    codes = {r["code"] for r in nested.select("code").distinct().collect()}
    assert codes == {"27447", "K1", "27130", "H1"}
    # The unquoted number is a code in scope all, and is dropped before parsing in featured scope.
    assert nested.filter("item_description = 'unquoted'").count() == 1
    assert staged(spark, tmp_path, CFG)[2].filter("item_description = 'unquoted'").count() == 0


def test_wide_names():
    groups = wide_groups([
        "standard_charge|gross", "standard_charge|negotiated_dollar", "standard_charge|A|negotiated_dollar",
        "standard_charge|A|B|negotiated_dollar", "standard_charge|A|B|C|methodology", "Standard_charge|A|B|methodology",
    ])
    assert groups == {
        ("A", "B"): {"dollar_raw": "standard_charge|A|B|negotiated_dollar"},
        ("A", "B|C"): {"methodology_raw": "standard_charge|A|B|C|methodology"},
    }


def test_no_payer_columns_give_one_null_row(spark):
    long = unpivot_payers(spark.createDataFrame([("x",)], "description string"))
    assert [tuple(r) for r in long.collect()] == [("x", None, None, None, None, None, None)]


def test_a_wide_line_is_what_its_cells_make(spark):
    """One filled set between commas is the line of all cells, for rows that fit a set and rows that fit none."""
    line = dict(
        l_linenumber=1, l_extendedprice=10.5, l_discount=0.05, l_tax=0.02, l_returnflag="R", l_linestatus="O",
        p_name='a "b", c', p_brand="x", p_type="SMALL", p_size=4,
    )
    rows = spark.createDataFrame([
        line | {"l_quantity": q, "c_custkey": key, "c_mktsegment": segment}
        for q in (1.0, 2.0, 3.0, 4.0, 7.0) for key in (7, 9, -3, None) for segment in (*files.SEGMENTS, "OTHER", None)
    ], "l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
       "p_name string, p_brand string, p_type string, p_size int, l_quantity double, c_custkey bigint, c_mktsegment string")
    items, groups = {"description": F.col("p_name")}, files._wide_groups()
    mine = lambda segment, k, cell: F.when((F.col("c_mktsegment") == segment) & (F.col("c_custkey") % 7 == k), cell)
    whole = items | {name: mine(segment, k, cell) for segment, k, cells in groups for name, cell in cells.items()}
    made = rows.select(files._csv_line(whole).alias("whole"), files._wide_line(items, groups).alias("line"))
    assert [r["line"] for r in made.collect()] == [r["whole"] for r in made.collect()]
