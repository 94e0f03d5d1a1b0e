"""Changes of order lines and their totals."""

from pyspark.sql import functions as F

from streamtally.operators import cdc
from streamtally.sources import tables

LINES = [(1, "F", "R", 10.0), (7, "F", "N", 20.25), (9, "O", "N", 5.5), (9, "O", "R", 1.0), (3, None, "A", 2.0), (None, "F", None, 4.0), (2, "F", "N", None)]


def _folder(spark, path):
    rows = spark.createDataFrame(LINES, "l_suppkey long, l_linestatus string, l_returnflag string, l_extendedprice double")
    rows.write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _side(image):
    return image and (image.supplier, image.amount and str(image.amount))


def test_line_changes_by_step(spark, tmp_path):
    got = {}
    for r in tables.line_changes(spark, _folder(spark, tmp_path)).collect():
        got.setdefault((r.step, r.op), []).append((_side(r.before), _side(r.after)))
    assert {k: sorted(v, key=repr) for k, v in got.items()} == {
        (1, "c"): sorted(
            [(None, (s, a)) for s, a in [("S-1", "10.00"), ("S-7", "20.25"), ("S-9", "5.50"), ("S-9", "1.00"), ("S-3", "2.00"), (None, "4.00"), ("S-2", None)]],
            key=repr,
        ),
        (2, "u"): sorted(
            [(("S-1", "10.00"), ("S-2", "11.00")), (("S-7", "20.25"), ("S-8", "21.25")), ((None, "4.00"), (None, "5.00")), (("S-2", None), ("S-3", None))],
            key=repr,
        ),
        (3, "d"): sorted([(("S-2", "11.00"), None), (("S-9", "1.00"), None)], key=repr),
        (4, "d"): sorted([(("S-8", "21.25"), None), (("S-9", "5.50"), None)], key=repr),
    }


def test_one_step_reads_the_lines_once_and_computes_no_other(spark, tmp_path):
    changes = tables.line_changes(spark, _folder(spark, tmp_path))
    plan = changes.where(F.col("step") == 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Generate" not in plan and "Union" not in plan
    totals = cdc.running_totals(changes, ["supplier"], "amount")
    assert "lambda" not in totals._jdf.queryExecution().optimizedPlan().toString()


def test_signed_amounts_of_missing_sides(spark):
    image = "struct<g:string,amount:int>"
    rows = [(None, None), (("a", 3), None), (None, ("b", None)), (("a", 3), ("b", 4))]
    got = cdc.signed_amounts(spark.createDataFrame(rows, f"before {image}, after {image}"), ["g"], "amount")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("a", -3, -1), ("b", None, 1), ("a", -3, -1), ("b", 4, 1)], key=repr
    )
